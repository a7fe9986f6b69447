import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F, types as T

from riskspark.operators import encode
from riskspark.plans import scoring, training
from riskspark.plans.catalog import DOC_LAYOUT
from riskspark.session import materialize, scratch_path
from riskspark.sources import payload
from riskspark.sources.files import settings
from riskspark.streaming.scoring import either_layout, read_arrivals, score_stream


@pytest.fixture(scope="module")
def people(spark):
    """Applicants whose risk depends on amount and savings."""
    rng = np.random.default_rng(11)
    n = 1500
    frame = pd.DataFrame(
        {
            "id": range(n),
            "age": rng.integers(19, 75, n),
            "sex": rng.choice(["male", "female"], n),
            "job": rng.integers(0, 4, n),
            "housing": rng.choice(["own", "rent", "free"], n),
            "saving_accounts": rng.choice(["little", "rich", None], n),
            "checking_account": rng.choice(["little", "moderate", None], n),
            "credit_amount": rng.integers(250, 18000, n),
            "duration": rng.integers(4, 73, n),
            "purpose": rng.choice(["car", "radio/TV", "education"], n),
        }
    )
    logit = 2.5 - frame.credit_amount / 6000 - 1.2 * (frame.saving_accounts == "little") + rng.logistic(0, 0.7, n)
    frame["target"] = np.where(logit > 0, "good risk", "bad risk")
    frame.loc[5, "target"] = "ERROR"
    return materialize(spark.createDataFrame(frame), "people")


@pytest.fixture(scope="module")
def run(people):
    return training.train_and_evaluate(people, "id")


def newton(x, y, w, c=1.0):
    """Minimum of c * weighted log loss + |coef|^2 / 2 with a free intercept."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    penalty = np.diag([1.0] * x.shape[1] + [0.0])
    beta = np.zeros(x1.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-x1 @ beta))
        grad = c * x1.T @ (w * (p - y)) + penalty @ beta
        beta -= np.linalg.solve(c * (x1 * (w * p * (1 - p))[:, None]).T @ x1 + penalty, grad)
    return beta


def test_logistic_matches_a_newton_solve(run):
    binned = run.model
    rows = binned.transform(run.train).select(vector_to_array("features").alias("x"), "label").toPandas()
    x, y = np.vstack(rows.x), rows.label.to_numpy()
    w = np.where(y == 1, len(y) / (2 * (y == 1).sum()), len(y) / (2 * (y == 0).sum()))
    beta = newton(x, y, w)
    classifier = run.model.stages[-1]
    # Balanced classes make the optimum in the one-hot directions unique through the penalty.
    np.testing.assert_allclose(np.r_[classifier.coefficients.toArray(), classifier.intercept], beta, atol=2e-5)


def test_report_is_useful_and_whole(run, people):
    got = {(r.label, r.metric): r.value for r in run.report.collect()}
    assert got[("roc_auc", "roc_auc")] > 0.75 and got[("0", "recall")] > 0.6
    assert run.train.count() + run.test.count() == 1499
    assert got[("macro avg", "support")] == run.test.count() == 300


def test_merged_rows_keep_every_row(run):
    merged = training.merged_rows(run.test, run.model)
    assert merged.agg(F.sum("n")).first()[0] == 300


def test_class_weights(spark):
    df = spark.createDataFrame([(0,), (1,), (1,), (1,)], "y int")
    assert {r.y: r.weight for r in training.class_weights(df, "y").collect()} == {0: 2.0, 1: 4 / 6}


def test_balance_raises_recall_of_the_rare_class(people):
    recall = {}
    for balance in (True, False):
        report = training.train_and_evaluate(people, "id", balance=balance).report
        recall[balance] = report.where("label = '0' and metric = 'recall'").first().value
    assert recall[True] > recall[False]


def test_saved_model_scores_the_same_in_batch_and_stream(spark, people, run):
    path = scratch_path(spark, "model")
    scoring.save_model(run.model, path)
    batch = scoring.score(people, scoring.load_model(path), ["id"])
    folder, out = scratch_path(spark, "arrivals"), scratch_path(spark, "scored")
    people.repartition(4).write.parquet(folder)
    arrivals = read_arrivals(spark, folder, people.schema, files_per_batch=1)
    score_stream(arrivals, scoring.load_model(path), ["id"], out, scratch_path(spark, "state")).awaitTermination()
    streamed = spark.read.parquet(out)
    rows = lambda d: sorted((r.id, r.y_prob, r.y_pred) for r in d.select("id", "y_prob", "y_pred").collect())
    assert rows(batch) == rows(streamed) and len(rows(batch)) == 1500
    assert batch.where("(y_prob > 0.5) <> (y_pred = 1)").isEmpty()


def test_saved_outputs_agree_with_the_report(spark, run):
    folder = scratch_path(spark, "run")
    training.save_run(run, "id", folder)
    rows = spark.read.parquet(f"{folder}/predictions")
    figures = {(r.label, r.metric): r for r in spark.read.parquet(f"{folder}/metrics").collect()}
    accuracy = rows.where("y_true = y_pred").count() / rows.count()
    assert accuracy == pytest.approx(figures[("accuracy", "accuracy")].value) and rows.count() == 300
    # Row by row and on merged rows the AUC is the same.
    auc = training.roc_auc(rows).first().auc
    assert auc == pytest.approx(figures[("roc_auc", "roc_auc")].value, abs=1e-12)
    assert figures[("roc_auc", "roc_auc")].text == f"{auc:.4f}"


def test_refit_edges_per_request(people, run):
    rows = people.withColumn("request_id", (F.col("id") < 1000).cast("int"))
    got = scoring.score(rows, run.model, ["id"], edges="refit", request_id="request_id")
    assert got.count() == 1500
    with pytest.raises(ValueError, match="edges"):
        scoring.score(rows, run.model, ["id"], edges="other")
    with pytest.raises(KeyError, match="purpose"):
        scoring.score(rows.drop("purpose"), run.model, ["id"])


def test_obvious_cases_over_requests(spark, run):
    header = "Age,Sex,Job,Housing,Saving accounts,Checking account,Credit amount,Duration,Purpose\n"
    body = header + "25,male,0,rent,little,little,17000,48,radio/TV\n58,female,2,own,rich,moderate,900,6,car\n"
    requests = spark.createDataFrame(
        [("a", "text/csv", body), ("b", "text/plain", body)], "request_id string, content_type string, body string"
    )
    answers = {r.request_id: r.body for r in scoring.score_requests(requests, run.model).collect()}
    assert payload.JSON_TYPE and answers["a"] == "[0,1]" and answers["b"] == "unsupported content type: text/plain"


def test_trees(people):
    report = training.train_and_evaluate(people, "id", algorithm="trees", rounds=5).report
    assert report.where("label = 'roc_auc'").first().value > 0.7


def test_encoder_order_unseen_and_null(spark):
    df = spark.createDataFrame([(1, "b", 10), (2, "a", 2)], "id int, c string, j int")
    encoder = encode.fit_encoder(df, ["c", "j"])
    assert encode.feature_names(encoder) == [("c", "a"), ("c", "b"), ("j", "2"), ("j", "10")]
    new = spark.createDataFrame([(1, "b", 10), (2, "z", 2), (3, None, None)], "id int, c string, j int")
    got = {r.id: r.v for r in encoder.transform(new).select("id", vector_to_array("features").alias("v")).collect()}
    assert got == {1: [0, 1, 0, 1], 2: [0, 0, 1, 0], 3: [0, 0, 0, 0]}
    assert {r.feature: r.n_unseen for r in encode.unseen_counts(new, encoder).collect()} == {"c": 1, "j": 0}
    with pytest.raises(ValueError, match="too many"):
        encode.fit_encoder(df, ["c"], max_categories=1)


def test_every_block_of_the_layout_sums_to_one(run):
    names = encode.feature_names(run.model)
    assert [c for c, _ in names] == sorted((c for c, _ in names), key=training.APPLICANT_LAYOUT.features.index)
    assert [v for c, v in names if c == "credit_bin"] == ["high", "low", "mid-high", "mid-low"]
    cells = encode.feature_cells(run.model.transform(run.train), "id", run.model)
    assert cells.groupBy("id", "feature").count().where("count <> 1").isEmpty()
    assert DOC_LAYOUT.features[0] == "lang"


@pytest.mark.parametrize("folder", [True, False])
def test_a_stream_reads_a_file_and_a_folder_of_files(spark, people, tmp_path, folder):
    path = str(tmp_path / "people.parquet")
    people.repartition(3).write.parquet(path) if folder else people.toPandas().to_parquet(path)
    arrivals = read_arrivals(spark, either_layout(path), people.schema)
    query = arrivals.select("id").writeStream.format("memory").queryName(f"seen_{folder}").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table(f"seen_{folder}").count() == people.count() > 0


def test_code_for_parsing_and_scoring_requests_is_small_enough_to_be_compiled(spark, run):
    """The JVM interprets methods of over 8,000 bytes; the stage that parses and scores has one method for its rows."""
    requests = spark.createDataFrame([(1, "text/csv", "")], "request_id int, content_type string, body string")
    rows = payload.parse_csv_bodies(requests, "request_id").where("error is null")
    with settings(spark, spark_sql_adaptive_enabled="false"):
        plans = [scoring.score_requests(requests, run.model), scoring.score(rows, run.model, ["request_id", "pos"])]
        debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
        for plan in plans:
            codes = debug.codegenStringSeq(plan._jdf.queryExecution().executedPlan())
            sizes = [codes.apply(i)._3().maxMethodCodeSize() for i in range(codes.size())]
            assert 0 < max(sizes) < 8000


def test_fields_of_request_bodies_by_header_with_nulls_and_short_lines(spark):
    names = {"A": "a", "B": "b", "C": "c"}
    schema = T.StructType([T.StructField("c", T.IntegerType()), T.StructField("a", T.StringType())])
    body = 'C,spare,B,A\n1.0,x,y,"p, ""q"""\nNA,x,y, null \n1.5,x\n"2",x,y,'
    requests = spark.createDataFrame([(1, "text/csv", body), (2, "text/csv", "A,B\n1,2"), (None, "text/csv", None)],
                                     "request_id int, content_type string, body string")
    got = {tuple(r) for r in payload.parse_csv_bodies(requests, "request_id", schema, names).collect()}
    assert got == {(1, 0, None, 1, 'p, "q"'), (1, 1, None, None, None), (1, 2, None, None, None), (1, 3, None, 2, None),
                   (2, 0, "missing columns: C", None, None), (None, None, "empty body", None, None)}
