"""Row annotation through a caller-supplied model client, with retry, pacing, checkpoints, resume and repair.

``client_factory()`` returns a callable ``client(prompts: list[str]) -> list[str]``; it is built once per partition on
the executor. Answers are keyed and the latest pass of a key counts, so a repeated task or a restarted job never mixes rows
up.

Answers are saved by chunk, many chunks in a job. A task answers one chunk and its file moves to its place when the task
ends, not when the job does. A manifest names the chunks that count; readers take those only. After an interruption the
next run first adds the chunks that had been finished to the manifest, then asks for what is still open. (On stores whose
committer publishes files at the end of a job only, that end is what is saved.)
"""

from __future__ import annotations

import random
import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ..functions.labels import normalise_label
from ..operators.joins import update_rows
from ..operators.ordering import LOCAL_ROWS, ordered
from ..schema import BAD, ERROR, LABELS
from ..session import materialize
from ..sources.files import read_or_empty
from .pacing import ROUND, Pace, SharedPace, barrier_pace

Client = Callable[[list[str]], list[str]]
#: Rows wanted in a chunk; an interruption loses the chunks that are being answered.
CHUNK_ROWS = 10_000
#: Most jobs of a run, however many rows there are.
JOBS = 64


@dataclass(frozen=True)
class Calls:
    """How the client is called.

    ``in_flight`` partitions call at the same time, as many as the prompts have if it is not given; ``rate`` is the
    total number of calls per second over all of them and needs ``in_flight``; ``wait`` bounds the random pause before
    another attempt.

    Each caller has an equal part of ``rate``, unless ``shared`` is set: then the callers are tasks of a barrier stage
    that meet every ``round_seconds``, and calls that one of them has no use for are made by the others. A barrier stage
    needs ``in_flight`` free cores at once and no dynamic allocation, its answers have to be written or collected whole
    (no ``first`` or ``limit``), and a lost task repeats the job's others as well: with ``run_annotation`` that is the
    chunks of one job.
    """

    attempts: int = 3
    wait: tuple[float, float] = (0.5, 1.5)
    in_flight: int | None = None
    rate: float | None = None
    batch: int = 1
    shared: bool = False
    round_seconds: float = ROUND

    def __post_init__(self):
        if self.rate and not self.in_flight:
            raise ValueError("a total rate can only be kept with in_flight given")
        if self.shared and not self.rate:
            raise ValueError("callers can only share a rate that is given")


class Counters:
    """Answered and failed rows of a running job, to be read on the driver at any time.

    A repeated task counts again, so the answers themselves are the record; these figures are for watching.
    """

    def __init__(self, spark: SparkSession):
        self.done, self.failed = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)

    def values(self) -> tuple[int, int]:
        return self.done.value, self.failed.value


ONE_TRY = Calls(attempts=1)
MANIFEST = T.StructType(
    [
        T.StructField("attempt", T.StringType()),
        T.StructField("job", T.IntegerType()),
        T.StructField("chunk", T.IntegerType()),
        T.StructField("pass_no", T.IntegerType()),
        T.StructField("rows", T.LongType()),
        T.StructField("errors", T.LongType()),
        T.StructField("finished", T.DoubleType()),
    ]
)


def result_schema(key: T.StructField) -> T.StructType:
    return T.StructType(
        [
            T.StructField(key.name, key.dataType),
            T.StructField("text", T.StringType()),
            T.StructField("status", T.StringType()),
            T.StructField("error", T.StringType()),
            T.StructField("attempts", T.IntegerType()),
        ]
    )


def annotate(
    prompts: DataFrame, key: str, prompt: str, client_factory: Callable[[], Client], calls: Calls = Calls(),
    counters: Counters | None = None,
) -> DataFrame:
    """(key, text, status, error, attempts) per row; a row that keeps failing has status ``error`` and no text."""
    rows = prompts.select(key, prompt)
    if calls.in_flight:
        rows = rows.repartition(calls.in_flight)
    return _answers(rows, key, prompt, client_factory, calls, counters)


def _answers(
    rows: DataFrame, key: str, prompt: str, client_factory: Callable[[], Client], calls: Calls,
    counters: Counters | None = None, also: tuple[str, ...] = (),
) -> DataFrame:
    """Answers of the rows where they lie, with further columns of theirs."""
    done, failed = (counters.done, counters.failed) if counters else (None, None)
    gap = calls.in_flight / calls.rate if calls.rate else 0.0

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = client_factory()
        pace = barrier_pace(calls.rate, calls.round_seconds) if calls.shared else Pace(gap)
        for frame, ahead in _with_next(batches):
            keys, texts = frame[key].tolist(), frame[prompt].tolist()
            answers = []
            for start in range(0, len(texts), calls.batch):
                waiting = -(-(len(texts) - start + ahead) // calls.batch)
                answers.extend(_answer(client, texts[start : start + calls.batch], calls, pace, waiting))
            if done is not None:
                done.add(len(answers))
                failed.add(sum(a[1] is not None for a in answers))
            yield pd.DataFrame(
                {
                    key: pd.Series(keys, dtype=frame[key].dtype),
                    "text": pd.Series([a[0] for a in answers], dtype=object),
                    "status": pd.Series(["ok" if a[1] is None else "error" for a in answers], dtype=object),
                    "error": pd.Series([a[1] for a in answers], dtype=object),
                    "attempts": pd.Series([a[2] for a in answers], dtype="int32"),
                    **{c: frame[c] for c in also},
                }
            )
        pace.end()

    schema = T.StructType([*result_schema(rows.schema[key]), *[rows.schema[c] for c in also]])
    return rows.mapInPandas(run, schema, barrier=calls.shared)


def _with_next(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, int]]:
    """Each frame with the number of rows of the next one."""
    frames = iter(frames)
    frame = next(frames, None)
    while frame is not None:
        ahead = next(frames, None)
        yield frame, 0 if ahead is None else len(ahead)
        frame = ahead


def _answer(
    client: Client, texts: list[str], calls: Calls, pace: Pace | SharedPace, waiting: int = 1,
) -> list[tuple[str | None, str | None, int]]:
    """(text, error, attempts) per prompt; a failing batch is retried prompt by prompt.

    ``waiting`` is the number of calls that the caller knows of, this one included.
    """
    if len(texts) > 1:
        try:
            pace.wait(waiting)
            answers = client(texts)
            if len(answers) == len(texts):
                return [(a, None, 1) for a in answers]
        except Exception:  # noqa: BLE001 - any client failure is handled below, one prompt at a time
            pass
        return [r for t in texts for r in _answer(client, [t], calls, pace, waiting)]
    message = ""
    for attempt in range(1, calls.attempts + 1):
        try:
            pace.wait(waiting)
            return [(client(texts)[0], None, attempt)]
        except Exception as failure:  # noqa: BLE001 - the message is recorded with the row
            message = str(failure)
            if attempt < calls.attempts:
                time.sleep(random.uniform(*calls.wait))
    return [(None, message, calls.attempts)]


class AnnotationTable:
    """The answers of one job: folders of attempts, and the manifest that says which of their chunks count."""

    def __init__(self, spark: SparkSession, path: str, key: T.StructField):
        self.spark, self.path, self.key = spark, path.rstrip("/"), key.name
        self.schema = T.StructType(
            result_schema(key).fields
            + [T.StructField("pass_no", T.IntegerType()), T.StructField("chunk", T.IntegerType())]
        )
        self.placed = T.StructType([*self.schema, T.StructField("attempt", T.StringType()), T.StructField("job", T.IntegerType())])

    def manifest(self) -> DataFrame:
        """(attempt, job, chunk, pass_no, rows, errors, finished): the chunks that count."""
        return read_or_empty(self.spark, f"{self.path}_manifest", MANIFEST)

    def _files(self) -> DataFrame:
        return read_or_empty(self.spark, self.path, self.placed)

    def rows(self) -> DataFrame:
        # One row per chunk; read anew each time, as another run may have added some.
        named = self.manifest().select("attempt", "job", "chunk").distinct()
        return self._files().join(named, ["attempt", "job", "chunk"], "left_semi").select(*self.schema.names)

    def latest(self) -> DataFrame:
        """One answer per key: the one of the last pass."""
        fields = ("text", "status", "error", "attempts")
        newest = F.max_by(F.struct(*fields), F.struct("pass_no", "chunk")).alias("_last")
        return self.rows().groupBy(self.key).agg(newest).select(self.key, "_last.*")

    def write(self, answers: DataFrame, attempt: str, job: int) -> None:
        """``answers`` with pass_no and chunk, a file for each task, in place as soon as its task has ended."""
        now = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}
        answers.select(*self.schema.names).write.options(**now).mode("append").parquet(f"{self.path}/attempt={attempt}/job={job}")

    def commit(self, attempt: str | None = None, job: int | None = None) -> None:
        """Name the finished chunks that the manifest does not name yet: of one job, or of all that were interrupted."""
        files = self._files()
        if attempt is not None:
            files = files.where((F.col("attempt") == attempt) & (F.col("job") == job))
        if not files.columns or files.isEmpty():
            return
        finished = F.max(F.col("_metadata.file_modification_time").cast("double"))
        found = files.groupBy("attempt", "job", "chunk", "pass_no").agg(
            F.count(F.lit(1)).alias("rows"), F.count_if(F.col("status") == "error").alias("errors"), finished.alias("finished"))
        new = found.join(self.manifest().select("attempt", "job", "chunk"), ["attempt", "job", "chunk"], "left_anti")
        new.select(*MANIFEST.names).coalesce(1).write.mode("append").parquet(f"{self.path}_manifest")

    def append(self, answers: DataFrame, pass_no: int, chunk: int | Column) -> None:
        chunk = F.lit(chunk) if isinstance(chunk, int) else chunk
        attempt = _new_attempt()
        self.write(answers.withColumns({"pass_no": F.lit(pass_no), "chunk": chunk.cast("int")}), attempt, 0)
        self.commit(attempt, 0)

    def log(self) -> DataFrame:
        """The run log: (chunk, rows, errors, seconds) per chunk of a first pass, in the order in which they ended.

        ``seconds`` is the time since the chunk before ended, or since the attempt began, so the sum is the time taken.
        """
        ended = self.manifest().where("pass_no = 0")
        order = Window.partitionBy("attempt").orderBy("finished", "job", "chunk")
        began = F.substring_index("attempt", "-", 1).cast("double") / 1000
        each = ended.select("attempt", "rows", "errors", F.row_number().over(order).alias("nth"), F.greatest(
            F.lit(0.0), F.col("finished") - F.coalesce(F.lag("finished").over(order), began)).alias("seconds"))
        # One row per attempt.
        before = Window.orderBy("attempt").rowsBetween(Window.unboundedPreceding, -1)
        offsets = each.groupBy("attempt").agg(F.count(F.lit(1)).alias("n")).select(
            "attempt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
        return each.join(offsets, "attempt").select((F.col("before") + F.col("nth") - 1).cast("int").alias("chunk"), "rows", "errors", "seconds")


def _new_attempt() -> str:
    """Names sort by time: milliseconds since 1970, then letters of no meaning."""
    return f"{int(time.time() * 1000):015d}-{uuid.uuid4().hex[:12]}"


def run_annotation(
    prompts: DataFrame,
    key: str,
    prompt: str,
    client_factory: Callable[[], Client],
    path: str,
    calls: Calls = Calls(),
    chunk_rows: int = CHUNK_ROWS,
    jobs: int = JOBS,
    counters: Counters | None = None,
) -> AnnotationTable:
    """Annotate the rows that have no answer yet, saving each chunk of about ``chunk_rows`` rows when it is done.

    Chunks are hash ranges of the key. Without ``in_flight`` one job holds all chunks. With it a job holds one chunk for
    each caller, and there are as many jobs as the rows need, but no more than ``jobs``; beyond that the chunks are larger.
    Calling again after an interruption goes on with the rows still open.
    """
    spark = prompts.sparkSession
    out = AnnotationTable(spark, path, prompts.schema[key])
    out.commit()
    waiting = prompts.select(key, prompt).join(out.rows().select(key), key, "left_anti")
    waiting = materialize(waiting, "prompts")
    wanted = max(1, -(-waiting.count() // chunk_rows))
    lanes = calls.in_flight or wanted
    rounds = max(1, min(jobs, -(-wanted // lanes)))
    chunk = F.pmod(F.xxhash64(key), F.lit(lanes * rounds)).cast("int")
    cut = waiting.select(key, prompt, F.lit(0).alias("pass_no"), chunk.alias("chunk"))
    attempt = _new_attempt()
    for job in range(rounds):
        # Chunk by chunk to the tasks: the number is the task's own, so a task has one chunk.
        rows = cut.where(F.col("chunk") % rounds == job).repartitionById(lanes, F.floor(F.col("chunk") / rounds).cast("int"))
        out.write(_answers(rows, key, prompt, client_factory, calls, counters, ("pass_no", "chunk")), attempt, job)
        out.commit(attempt, job)
    return out


def repair(
    out: AnnotationTable, prompts: DataFrame, prompt: str, client_factory: Callable[[], Client],
    pass_no: int, calls: Calls = ONE_TRY, accept: Column | None = None,
) -> AnnotationTable:
    """Ask again for the rows whose latest answer failed, or is not accepted; a further failure changes nothing."""
    latest = out.latest()
    bad = F.col("status") == "error"
    if accept is not None:
        bad = bad | ~F.coalesce(accept, F.lit(False))
    again = materialize(prompts.select(out.key, prompt).join(latest.where(bad).select(out.key), out.key), "repair")
    answers = materialize(annotate(again, out.key, prompt, client_factory, calls), "repair-answers")
    fixed = answers.where("status = 'ok'")
    out.append(fixed, pass_no, F.lit(-pass_no))
    return out


def export_text(answers: DataFrame, key: str, column: str, with_message: bool = False) -> DataFrame:
    """(key, column) with the sentinel in place of failed answers, optionally followed by the message."""
    failed = F.concat(F.lit(f"{ERROR}: "), "error") if with_message else F.lit(ERROR)
    return answers.select(key, F.when(F.col("status") == "ok", F.col("text")).otherwise(failed).alias(column))


def label_answers(answers: DataFrame, key: str, column: str = "target") -> DataFrame:
    """(key, column): validated labels of a classification run, the sentinel for anything else."""
    label = normalise_label(F.when(F.col("status") == "ok", F.col("text")))
    return answers.select(key, label.alias(column))


def repair_labels(
    labelled: DataFrame, key: str, prompts: DataFrame, prompt: str, client_factory: Callable[[], Client],
    calls: Calls = ONE_TRY, column: str = "target", second_choice: str = BAD,
) -> DataFrame:
    """``labelled`` with its error rows classified once more.

    An allowed label is taken, another unexpected answer becomes ``second_choice``, a failed call stays an error.
    """
    failed = labelled.where(F.col(column) == ERROR).select(key)
    again = prompts.select(key, prompt).join(failed, key)
    answers = materialize(annotate(again, key, prompt, client_factory, calls), "label-repair")
    label = normalise_label(F.col("text"), LABELS, second_choice)
    fixes = answers.where("status = 'ok'").select(key, label.alias(column))
    return update_rows(labelled, fixes, key, [column])


def repair_descriptions(
    described: DataFrame, key: str, prompts: DataFrame, prompt: str, client_factory: Callable[[], Client],
    calls: Calls = ONE_TRY, column: str = "description",
) -> DataFrame:
    """``described`` with its error rows asked once more; a failed call leaves the row as it is."""
    failed = described.where((F.col(column) == ERROR) | F.col(column).startswith(f"{ERROR}:")).select(key)
    again = prompts.select(key, prompt).join(failed, key)
    answers = materialize(annotate(again, key, prompt, client_factory, calls), "description-repair")
    fixes = answers.where("status = 'ok'").select(key, F.col("text").alias(column))
    return update_rows(described, fixes, key, [column])


def progress(log: DataFrame, total_rows: int | Column, local_rows: int = LOCAL_ROWS) -> DataFrame:
    """Running state after each chunk of a run log (chunk, rows, seconds): one row per chunk.

    (chunk, rows_done, rows_left, elapsed, avg_seconds, eta_minutes)
    """
    total = F.lit(total_rows) if isinstance(total_rows, int) else total_rows
    state = ordered(log.select("chunk", "rows", "seconds"), ["chunk"], local_rows=local_rows).scan(
        sums={"rows_done": "rows", "elapsed": "seconds"}).withColumn("elapsed", F.col("elapsed").cast("double"))
    average = F.try_divide(F.col("elapsed"), F.col("rows_done").cast("double"))
    left = total - F.col("rows_done")
    return state.select(
        "chunk", "rows_done", left.alias("rows_left"), "elapsed", average.alias("avg_seconds"),
        F.round(average * left / 60, 1).alias("eta_minutes"),
    )
