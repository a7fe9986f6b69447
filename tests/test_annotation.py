import pytest
from pyspark.sql import functions as F

from riskspark.functions import labels, text
from riskspark.plans import annotation, pacing
from riskspark.plans.annotation import Calls
from riskspark.session import scratch_path

FAST = Calls(attempts=3, wait=(0.0, 0.0))
ONCE = Calls(attempts=1)


def refusing(*bad):
    """A client that refuses some prompts for good."""

    def factory():
        def client(prompts):
            if any(p in bad for p in prompts):
                raise RuntimeError("refused")
            return [f"<{p}>" for p in prompts]

        return client

    return factory


def flaky(times):
    def factory():
        left = {"n": times}

        def client(prompts):
            if left["n"]:
                left["n"] -= 1
                raise RuntimeError("busy")
            return [f"<{p}>" for p in prompts]

        return client

    return factory


@pytest.fixture(scope="module")
def prompts(spark):
    return spark.range(40).select("id", F.concat(F.lit("p"), F.col("id").cast("string")).alias("prompt"))


def by_id(df):
    return {r.id: r for r in df.collect()}


def test_retry_then_answer_and_give_up(spark):
    one = spark.createDataFrame([(1, "a")], "id long, prompt string")
    got = annotation.annotate(one, "id", "prompt", flaky(2), FAST).first()
    assert (got.text, got.status, got.error, got.attempts) == ("<a>", "ok", None, 3)
    got = annotation.annotate(one, "id", "prompt", flaky(9), FAST).first()
    assert (got.text, got.status, got.error, got.attempts) == (None, "error", "busy", 3)


def test_a_bad_prompt_does_not_spoil_its_batch(prompts):
    got = by_id(annotation.annotate(prompts, "id", "prompt", refusing("p7"), Calls(attempts=1, batch=10, in_flight=2)))
    assert len(got) == 40 and {i for i, r in got.items() if r.status == "error"} == {7}
    assert all(r.text == f"<p{i}>" for i, r in got.items() if i != 7)


def test_pacing_bounds_the_rate(spark):
    import time

    rows = spark.range(6).select("id", F.lit("x").alias("prompt"))
    start = time.time()
    annotation.annotate(rows, "id", "prompt", refusing(), Calls(attempts=1, in_flight=2, rate=4)).collect()
    assert time.time() - start >= 3 * 2 / 4 - 2 / 4  # the first call of each partition need not wait


def test_a_total_rate_needs_a_number_of_callers():
    with pytest.raises(ValueError, match="in_flight"):
        Calls(rate=1)


def test_pace_counts_the_time_a_call_takes(monkeypatch):
    now, slept = [100.0], []
    monkeypatch.setattr(pacing.time, "monotonic", lambda: now[0])

    def sleep(seconds):
        slept.append(seconds)
        now[0] += seconds

    monkeypatch.setattr(pacing.time, "sleep", sleep)
    pace = pacing.Pace(2.0)
    for call in (0.5, 3.0, 0.5):
        pace.wait()
        now[0] += call
    assert slept == [1.5]


def test_shares_are_even_and_whole():
    assert pacing.shares([9, 9, 9], 9) == [3, 3, 3]
    assert pacing.shares([1, 0, 9], 8) == [1, 0, 7]  # what one does not want goes to the others
    assert pacing.shares([2, 2], 9) == [2, 2]
    assert pacing.shares([], 4) == [] and pacing.shares([3, 3], 0) == [0, 0]
    turns = [pacing.shares([5, 5, 5], 1, turn) for turn in range(3)]
    assert sorted(t.index(1) for t in turns) == [0, 1, 2]
    for wants in ([0, 3, 8, 1], [4], [7, 7, 0, 2, 2]):
        for budget in range(25):
            got = pacing.shares(wants, budget)
            assert sum(got) == min(budget, sum(wants)) and all(0 <= g <= w for g, w in zip(got, wants))


def stamping(seconds=0.0):
    """A client whose answers are the times at which they were asked for."""
    import time

    def factory():
        def client(prompts):
            at = time.time()
            time.sleep(seconds)
            return [repr(at)] * len(prompts)

        return client

    return factory


def shared_times(spark, lanes, client, calls):
    """Times of the calls of lanes with so many prompts each."""
    sizes = spark.createDataFrame(list(enumerate(lanes)), "lane int, n int")
    rows = sizes.selectExpr("lane", "explode(sequence(1, n)) AS nth").selectExpr("lane", "lane * 100000L + nth AS id", "'x' AS prompt")
    rows = rows.repartitionById(len(lanes), F.col("lane"))
    got = annotation._answers(rows, "id", "prompt", client, calls, None, ("lane",)).collect()
    assert len({r.id for r in got}) == len(got) == sum(lanes)
    return sorted((float(r.text), r.lane) for r in got)


def test_callers_of_unequal_length_keep_the_total_rate(spark):
    calls = Calls(attempts=1, in_flight=4, rate=40, shared=True, round_seconds=1.0)
    times = shared_times(spark, [5, 5, 10, 380], stamping(), calls)
    # The three short lanes end early; a fixed part of a quarter would need 38 s for the last lane.
    rate = (len(times) - 1) / (times[-1][0] - times[0][0])
    assert 36 <= rate <= 44
    for start, _ in times:
        assert sum(start <= t < start + 2 for t, _ in times) <= 2 * 40 * 1.1


def test_a_slow_caller_does_not_hold_back_the_others(spark):
    def factory():
        import time

        from pyspark import TaskContext

        slow = TaskContext.get().partitionId() == 0

        def client(prompts):
            at = time.time()
            time.sleep(0.4 if slow else 0.0)
            return [repr(at)] * len(prompts)

        return client

    calls = Calls(attempts=1, in_flight=3, rate=30, shared=True, round_seconds=1.0)
    times = shared_times(spark, [8, 60, 60], factory, calls)
    fast = [t for t, lane in times if lane]
    assert (len(fast) - 1) / (fast[-1] - fast[0]) > 20


def test_retries_come_out_of_the_shared_rate_and_empty_lanes_are_met(spark):
    calls = Calls(attempts=3, wait=(0.0, 0.0), in_flight=3, rate=1000, shared=True, round_seconds=0.2)
    one = spark.createDataFrame([(1, "a")], "id long, prompt string")
    [got] = annotation.annotate(one, "id", "prompt", flaky(2), calls).collect()
    assert (got.text, got.attempts) == ("<a>", 3)
    assert annotation.annotate(one.where("id < 0"), "id", "prompt", flaky(2), calls).count() == 0
    with pytest.raises(ValueError, match="rate"):
        Calls(in_flight=2, shared=True)


def test_a_saved_run_with_a_shared_rate(spark, prompts):
    calls = Calls(attempts=1, in_flight=2, rate=1e6, shared=True, round_seconds=0.1)
    out = annotation.run_annotation(prompts, "id", "prompt", refusing("p3"), scratch_path(spark, "shared"), calls, chunk_rows=10)
    assert {i for i, r in by_id(out.latest()).items() if r.status == "error"} == {3}
    assert out.latest().count() == 40


def test_resume_equals_one_run(spark, prompts):
    path, whole = scratch_path(spark, "resume"), scratch_path(spark, "whole")
    part = annotation.run_annotation(prompts.where("id % 3 = 0"), "id", "prompt", refusing("p3"), path, ONCE, chunk_rows=8)
    done = part.rows().count()
    assert 0 < done < 40
    resumed = annotation.run_annotation(prompts, "id", "prompt", refusing("p3"), path, ONCE, chunk_rows=8)
    once = annotation.run_annotation(prompts, "id", "prompt", refusing("p3"), whole, ONCE, chunk_rows=8)
    assert resumed.rows().count() == 40
    assert by_id(resumed.latest()) == by_id(once.latest())
    log = once.log()
    assert tuple(log.agg(F.sum("rows"), F.sum("errors")).first()) == (40, 1) and 1 < log.count() <= 5
    for local_rows in (1, 1000):
        last = annotation.progress(log, 40, local_rows).orderBy(F.desc("chunk")).first()
        assert (last.rows_done, last.rows_left) == (40, 0)
    # Nothing is left, so nothing is asked again.
    annotation.run_annotation(prompts, "id", "prompt", refusing("p3"), path, ONCE, chunk_rows=8)
    assert resumed.rows().count() == 40


def jobs_of(spark, group, run):
    """Jobs that ``run`` starts."""
    spark.sparkContext.setJobGroup(group, group)
    try:
        run()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_the_number_of_jobs_does_not_grow_with_the_chunks(spark):
    def run(rows, calls=ONCE, **more):
        many = spark.range(rows).select("id", F.concat(F.lit("p"), F.col("id").cast("string")).alias("prompt"))
        path = scratch_path(spark, "jobs")
        out = {}
        n = jobs_of(spark, f"jobs-{path[-8:]}", lambda: out.setdefault("t", annotation.run_annotation(
            many, "id", "prompt", refusing("p3"), path, calls, chunk_rows=8, **more)))
        assert out["t"].rows().count() == rows and out["t"].latest().count() == rows
        return n, out["t"].manifest().count()

    (few, chunks), (many, more_chunks) = run(40), run(800)
    assert 4 <= chunks <= 5 and 90 <= more_chunks <= 100 and many <= few + 2
    lanes = Calls(attempts=1, in_flight=3)
    (few, _), (many, chunks) = run(200, lanes, jobs=4), run(800, lanes, jobs=4)
    assert many <= few + 2 and chunks == 12


def test_a_killed_run_keeps_its_finished_chunks(spark, prompts, tmp_path):
    """Every chunk but the one with the fatal prompt is saved, although the job fails; then only that one is asked again."""
    asked = tmp_path / "asked"

    def deadly(fatal):
        def factory():
            def client(texts):
                import os
                import time

                with open(asked, "a") as f:
                    f.write("".join(t + "\n" for t in texts))
                if fatal in texts:
                    time.sleep(4)  # the others end meanwhile
                    os._exit(1)
                return [f"<{t}>" for t in texts]

            return client

        return factory

    path = scratch_path(spark, "killed")
    with pytest.raises(Exception, match="(?i)worker|abort"):
        annotation.run_annotation(prompts, "id", "prompt", deadly("p7"), path, ONCE, chunk_rows=8)
    table = annotation.AnnotationTable(spark, path, prompts.schema["id"])
    assert table.rows().count() == 0  # nothing is named yet
    table.commit()
    saved = table.rows().count()
    assert 0 < saved < 40 and table.rows().where("id = 7").isEmpty()
    asked.write_text("")
    out = annotation.run_annotation(prompts, "id", "prompt", deadly("none"), path, ONCE, chunk_rows=8)
    assert len(asked.read_text().split()) == 40 - saved
    whole = annotation.run_annotation(prompts, "id", "prompt", refusing(), scratch_path(spark, "whole"), ONCE, chunk_rows=8)
    assert by_id(out.latest()) == by_id(whole.latest()) and out.rows().count() == 40


def test_files_without_a_name_in_the_manifest_are_not_read(spark, prompts):
    path = scratch_path(spark, "unnamed")
    out = annotation.run_annotation(prompts.where("id < 20"), "id", "prompt", refusing(), path, ONCE, chunk_rows=8)
    strays = out.rows().withColumn("text", F.lit("stray")).withColumn("chunk", F.lit(77))
    out.write(strays, "999-other", 0)
    assert out.rows().count() == 20 and out.latest().where("text = 'stray'").isEmpty()


def test_repair_pass_asks_only_failed_rows(spark, prompts):
    out = annotation.run_annotation(
        prompts, "id", "prompt", refusing("p3", "p4"), scratch_path(spark, "repair"), ONCE, chunk_rows=20
    )
    annotation.repair(out, prompts, "prompt", refusing("p4"), pass_no=1)
    latest = by_id(out.latest())
    assert out.rows().count() == 41
    assert latest[3].text == "<p3>" and latest[4].status == "error" and len(latest) == 40
    annotation.repair(out, prompts, "prompt", refusing(), pass_no=2, accept=F.col("text") != "<p9>")
    assert out.rows().count() == 43 and out.latest().where("status = 'error'").isEmpty()


def test_calls_are_counted_on_the_way(spark, prompts):
    counters = annotation.Counters(spark)
    annotation.annotate(prompts, "id", "prompt", refusing("p3", "p4"), ONCE, counters).collect()
    assert counters.values() == (40, 2)


def test_label_repair_policy(spark):
    labelled = spark.createDataFrame(
        [(1, "good risk"), (2, "ERROR"), (3, "ERROR"), (4, "ERROR")], "id long, target string"
    )
    rows = spark.createDataFrame([(i, f"p{i}") for i in range(1, 5)], "id long, prompt string")

    def factory():
        answers = {"p2": " Good Risk\n", "p3": "moderate risk"}

        def client(prompts):
            return [answers[p] for p in prompts]

        return client

    fixed = annotation.repair_labels(labelled, "id", rows, "prompt", factory)
    assert {r.id: r.target for r in fixed.collect()} == {1: "good risk", 2: "good risk", 3: "bad risk", 4: "ERROR"}


def test_description_repair_covers_both_error_forms(spark):
    described = spark.createDataFrame(
        [(1, "fine"), (2, "ERROR"), (3, "ERROR: busy"), (4, "ERROR")], "id long, description string"
    )
    rows = spark.createDataFrame([(i, f"p{i}") for i in range(1, 5)], "id long, prompt string")
    fixed = annotation.repair_descriptions(described, "id", rows, "prompt", refusing("p4"))
    assert {r.id: r.description for r in fixed.collect()} == {1: "fine", 2: "<p2>", 3: "<p3>", 4: "ERROR"}


def test_export_texts(prompts):
    answers = annotation.annotate(prompts.where("id < 2"), "id", "prompt", refusing("p1"), ONCE)
    assert {r.id: r.t for r in annotation.export_text(answers, "id", "t").collect()} == {0: "<p0>", 1: "ERROR"}
    assert annotation.export_text(answers, "id", "t", True).where("id = 1").first().t == "ERROR: refused"


def test_progress(spark):
    log = spark.createDataFrame([(1, 20, 10.0), (2, 20, 30.0)], "chunk int, rows long, seconds double")
    rows = annotation.progress(log, 100).orderBy("chunk").collect()
    assert (rows[1].rows_done, rows[1].rows_left, rows[1].avg_seconds, rows[1].eta_minutes) == (40, 60, 1.0, 1.0)


def test_label_texts(spark):
    raw = [" Good Risk ", "BAD RISK", "moderate risk", None, " good risk \n"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(raw)], "id int, v string")
    got = [r.l for r in df.select("id", labels.normalise_label(F.col("v")).alias("l")).orderBy("id").collect()]
    assert got == ["good risk", "bad risk", "ERROR", "ERROR", "good risk"]


def test_gate(spark):
    df = spark.createDataFrame([("good risk",), ("ERROR",), (None,), ("bad risk",)], "target string")
    clean, quarantine = labels.training_gate(df)
    assert sorted(r.label for r in clean.collect()) == [0, 1] and quarantine.count() == 2
    with pytest.raises(ValueError, match="target"):
        labels.training_gate(df, on_error="fail")
    counts = labels.run_counters(df, "target", ["good risk"]).first()
    assert tuple(counts) == (4, 2, 1)


def test_prompt_and_request(spark):
    import json

    df = spark.createDataFrame(
        [(21, "male", 0, "rent", None, "little", 12000, 48, 'radio "TV"')],
        "age int, sex string, job int, housing string, saving_accounts string, checking_account string, "
        "credit_amount int, duration int, purpose string",
    )
    row = df.select(
        text.describe_prompt().alias("p"),
        text.request_body(text.describe_prompt(), **text.DESCRIBE_LIMITS).alias("b"),
        text.response_text(F.lit('{"content": []}')).alias("none"),
    ).first()
    assert row.p.endswith('- Saving accounts: nan\n- Checking account: little\n- Credit amount: 12000\n- Duration: 48\n- Purpose: radio "TV"')
    body = json.loads(row.b)
    assert body["messages"] == [{"role": "user", "content": row.p}] and (body["max_tokens"], body["temperature"]) == (250, 0.7)
    assert row.none is None
