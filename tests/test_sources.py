import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F, types as T

from riskspark.operators import joins
from riskspark.schema import APPLICANT, DESCRIBED
from riskspark.session import scratch_path
from riskspark.sources import files, payload

# Fixed value: the header of the applicant files.
HEADER = "Age,Sex,Job,Housing,Saving accounts,Checking account,Credit amount,Duration,Purpose"


def test_csv_by_name_with_null_tokens(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        "Sex,Age,Purpose,Extra,Saving accounts\nmale,21,\"radio, \"\"TV\"\"\",1,NA\nfemale,x,None,2, \nmale,30.0,car,3,little\n"
    )
    rows = files.read_table_csv(spark, str(tmp_path / "a.csv"), APPLICANT).collect()
    assert [tuple(r) for r in rows] == [
        (21, "male", None, 'radio, "TV"'), (None, "female", None, None), (30, "male", "little", "car")
    ]


def test_csv_round_trip_with_line_breaks(spark):
    df = spark.createDataFrame([(1, 'a "b"\nc, d'), (2, None), (3, "\\x")], "age long, description string")
    path = scratch_path(spark, "csv")
    files.write_table_csv(df, path)
    back = files.read_table_csv(spark, path, DESCRIBED, multiline=True)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    assert spark.read.option("header", True).csv(path).columns[0] == "Age"


def test_read_or_empty(spark):
    schema = spark.range(1).schema
    assert files.read_or_empty(spark, scratch_path(spark, "none"), schema).count() == 0


def test_publish_and_predictions(spark):
    df = spark.createDataFrame([(1, 1, 0, 0.25)], "id long, y_true int, y_pred int, y_prob double")
    path = scratch_path(spark, "out")
    files.publish(df, path)
    files.publish(df, path)
    assert spark.read.parquet(path).count() == 1
    csv = scratch_path(spark, "preds")
    files.write_predictions(df, csv, "id", fmt="csv")
    assert "0.25" in "".join(p.read_text() for p in Path(csv.removeprefix("file:")).glob("part-*"))


def bodies(spark, *rows):
    return spark.createDataFrame(list(rows), "request_id string, content_type string, body string")


def test_payload_columns_by_name_and_quotes(spark):
    titles = HEADER.split(",")
    body = ",".join(titles[::-1]) + "\n"
    body += '"boat, ""small""",7,4321,rich,some,own,3,female,44\r\ngarden,11,98,,NA,rent,2,male,\n'
    rows = payload.parse_csv_bodies(bodies(spark, ("r", "text/csv", body)), "request_id").orderBy("pos").collect()
    assert [(r.pos, r.age, r.purpose, r.saving_accounts, r.credit_amount, r.error) for r in rows] == [
        (0, 44, 'boat, "small"', "some", 4321, None), (1, None, "garden", None, 98, None)
    ]


def test_payload_lines_of_any_width_read_the_same_quoted_or_not(spark):
    spare = [f"extra {i}" for i in range(200)]
    cells = ["44", "female", "3", "own", "some", "rich", "4321", "7", "boat"]
    body = lambda first: ",".join(spare + HEADER.split(",")) + "\n" + ",".join([first, *spare[1:], *cells]) + "\n"
    got = payload.parse_csv_bodies(
        bodies(spark, ("a", "text/csv", body("x")), ("b", "text/csv", body('"x, ""y"""'))), "request_id").collect()
    assert len(got) == 2 and tuple(got[0])[1:] == tuple(got[1])[1:]
    assert (got[0].age, got[0].credit_amount, got[0].purpose) == (44, 4321, "boat")


def test_fields_of_a_line(spark):
    lines = ["", ",", 'a,,"b,c","d""e","",f', '"a"', '"' + 'x""' * 30_000 + '"', '"""a"""', '"open,x']
    want = [[""], ["", ""], ["a", "", "b,c", 'd"e', "", "f"], ["a"], ['x"' * 30_000], ['"a"'], ["open,x"]]
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    assert [r[0] for r in df.select(payload.csv_fields(F.col("line"))).collect()] == want


def test_answers_must_match_the_rows(spark):
    rows = spark.createDataFrame([("a", 0), ("a", 1), ("b", 0)], "request_id string, pos int")
    answers = lambda *x: spark.createDataFrame(list(x), "request_id string, body string")
    good = payload.attach_predictions(rows, answers(("a", "[1,0]"), ("b", "[1]")), "request_id").collect()
    assert sorted(map(tuple, good)) == [("a", 0, 1), ("a", 1, 0), ("b", 0, 1)]
    with pytest.raises(Exception, match="fewer answers"):
        payload.attach_predictions(rows, answers(("a", "[1]"), ("b", "[1]")), "request_id").collect()
    with pytest.raises(Exception, match="more answers"):
        payload.attach_predictions(rows, answers(("a", "[1,0,1]"), ("b", "[1]")), "request_id").collect()
    left = payload.attach_predictions(rows, answers(("a", "[1]")), "request_id", missing="null").collect()
    assert sorted(map(tuple, left), key=str) == [("a", 0, 1), ("a", 1, None), ("b", 0, None)]


def test_whole_numbers_are_exact(spark):
    texts = ["9007199254740993", "-3", "1.0", "1.7", "x", "9223372036854775808", " 5 ", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(files.whole_number(F.col("t"), T.LongType())).collect()]
    assert got == [9007199254740993, -3, 1, None, None, None, 5, None]


def test_columns_go_by_name_in_every_file(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b\n1,x\n")
    (tmp_path / "y.csv").write_text("b,a\ny,2\n")
    (tmp_path / "z.csv").write_text("a\n3\n")
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    rows = files.read_table_csv(spark, str(tmp_path), schema, {}).collect()
    assert sorted(map(tuple, rows)) == [(1, "x"), (2, "y"), (3, None)]


def test_white_space_of_texts_is_kept(spark):
    df = spark.createDataFrame([("  a b  ",)], "description string")
    path = scratch_path(spark, "blanks")
    files.write_table_csv(df, path, {})
    assert [r[0] for r in files.read_table_csv(spark, path, df.schema, {}).collect()] == ["  a b  "]


def test_payload_errors_do_not_fail_the_batch(spark):
    good = HEADER + "\n21,male,0,rent,unknown,little,12000,48,car\n"
    rows = payload.parse_csv_bodies(
        bodies(spark, ("a", "text/csv", good), ("b", "application/xml", good), ("c", "text/csv", "Age\n1\n2\n3\n"), ("d", "text/csv", "")),
        "request_id",
    ).collect()
    errors = {r.request_id: r.error for r in rows}
    assert len(rows) == 4 and errors["a"] is None
    assert errors["b"] == "unsupported content type: application/xml" and errors["d"] == "empty body"
    assert errors["c"].startswith("missing columns: Sex, Job")


def test_bodies_and_responses_round_trip(spark):
    df = spark.range(30).select(
        (F.col("id") % 4).alias("request_id"), "id", (F.col("id") * 2).alias("age"), F.lit('a,"b"').alias("purpose"),
    )
    names = {"Age": "age", "Purpose": "purpose"}
    rows = payload.parse_csv_bodies(payload.csv_bodies(df, "request_id", "id", names), "request_id", names=names)
    got = {(r.request_id, r.pos): (r.age, r.purpose) for r in rows.collect()}
    assert got == {(i % 4, i // 4): (2 * i, 'a,"b"') for i in range(30)}
    scored = rows.withColumn("prediction", (F.col("age") > 20).cast("int"))
    answers = payload.responses(scored, "request_id")
    assert json.loads(answers.where("request_id = 1").first().body) == [int(2 * i > 20) for i in range(1, 30, 4)]
    attached = payload.attach_predictions(rows.drop("prediction"), answers, "request_id")
    assert all(r.prediction == int(r.age > 20) for r in attached.collect()) and attached.count() == 30
    text = payload.responses(scored, "request_id", payload.CSV_TYPE).where("request_id = 0").first().body
    assert text.splitlines() == ["prediction", *[str(int(2 * i > 20)) for i in range(0, 30, 4)]]
    with pytest.raises(ValueError, match="unsupported"):
        payload.responses(scored, "request_id", "text/html")


def test_joins_by_key(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    twice = spark.createDataFrame([(1, "x"), (1, "y")], "k int, w string")
    with pytest.raises(ValueError, match="not unique"):
        joins.attach(left, twice, "k")
    with pytest.raises(KeyError, match="m, n"):
        joins.require_columns(left, ["k", "m", "n"])
    fixed = joins.update_rows(left, spark.createDataFrame([(2, "z"), (9, "q")], "k int, v string"), "k", ["v"])
    assert sorted(map(tuple, fixed.collect())) == [(1, "a"), (2, "z")]
    small = joins.join_small(left, spark.createDataFrame([(2, 5)], "k int, n int"), ["k"], "left")
    assert sorted(map(tuple, small.collect())) == [(1, "a", None), (2, "b", 5)]


def test_payload_fields_with_line_breaks(spark):
    names = {"a": "a", "b\nc": "b"}
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    texts = ["x\ny", 'say ""no""\r\n', "\n\n", "plain", '""', ',\n""']
    body = 'a,"b\nc"\r\n' + "".join(f'{i},"{t}"\r\n' for i, t in enumerate(texts)) + '\n\r7,end'
    got = payload.parse_csv_bodies(bodies(spark, ("r", "text/csv", body)), "request_id", schema, names).orderBy("pos").collect()
    assert [(r.a, r.b) for r in got] == [(i, t.replace('""', '"')) for i, t in enumerate(texts)] + [(7, "end")]


def test_bodies_with_line_breaks_round_trip(spark):
    rows = [(i, 1, f'line "{i}"\nnext, {i}\r') for i in range(20)]
    df = spark.createDataFrame(rows, "id long, request_id int, description string")
    names = {"Id": "id", "Description": "description"}
    schema = df.select("id", "description").schema
    got = payload.parse_csv_bodies(payload.csv_bodies(df, "request_id", "id", names), "request_id", schema, names)
    assert sorted((r.id, 1, r.description) for r in got.collect()) == rows


def test_header_probe_reads_first_lines_only(spark, tmp_path):
    for name in ("a", "b", "c"):
        (tmp_path / f"{name}.csv").write_text(("x,y\n" if name < "c" else "y,x\n") + "1,2\n" * 50_000)
    (tmp_path / "empty.csv").write_text("")
    found = sorted(sorted(f.rsplit("/", 1)[1] for f in g) for g in files._files_by_header(spark, str(tmp_path)))
    assert found == [["a.csv", "b.csv"], ["c.csv"]]


def test_payload_places_only_for_returned_columns(spark, capsys):
    """Wide bodies: a place for each of the other columns would go with every row."""
    titles = HEADER.split(",")
    names = {**{f"spare {i}": f"spare_{i}" for i in range(3)}, **payload.APPLICANT_COLUMNS}
    body = ",".join(["spare 0", "spare 1", "spare 2", *titles]) + '\n"a ""b"", c",,x' + ",44" * len(titles) + "\n"
    rows = payload.parse_csv_bodies(bodies(spark, ("r", "text/csv", body)), "request_id", names=names)
    rows.explain(True)
    assert "spare_1" not in capsys.readouterr().out
    assert [(r.pos, r.age, r.error) for r in rows.collect()] == [(0, 44, None)]
