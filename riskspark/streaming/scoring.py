"""Scoring of arriving rows with a saved model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.streaming import StreamingQuery

from ..plans.scoring import score
from ..plans.training import APPLICANT_LAYOUT, Layout


def read_arrivals(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", files_per_batch: int | None = None,
) -> DataFrame:
    """Rows of the files that arrive at ``path``, which may hold glob patterns."""
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def either_layout(path: str) -> str:
    """``path`` as a pattern that a stream reads whether it is one file or a folder of part files."""
    return f"{path[:-1]}[{path[-1]}]"


def score_stream(
    arrivals: DataFrame, model: PipelineModel, keys: Sequence[str], out: str, checkpoint: str,
    layout: Layout = APPLICANT_LAYOUT, available_now: bool = True,
) -> StreamingQuery:
    """Append scored rows to a Parquet table; the checkpoint makes a restart go on where it stopped.

    Stateless: every row is binned with the frozen edges of the model.
    """
    scored = score(arrivals, model, keys, layout)
    writer = scored.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(out)
