"""Batch scoring of raw rows with a saved model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from ..operators.binning import bin_by_group
from ..operators.joins import require_columns
from ..session import materialize
from ..sources import payload
from .training import APPLICANT_LAYOUT, Layout, predictions


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def raw_columns(layout: Layout = APPLICANT_LAYOUT) -> list[str]:
    return [*[c for c in layout.features if c not in layout.bins.values()], *layout.bins]


def score(
    df: DataFrame, model: PipelineModel, keys: Sequence[str], layout: Layout = APPLICANT_LAYOUT,
    edges: str = "frozen", request_id: str | None = None, duplicates: str = "raise",
) -> DataFrame:
    """(keys..., y_prob, y_pred) for raw rows, batch or streaming.

    ``edges="frozen"`` bins with the edges of the training rows. ``edges="refit"`` recomputes them inside every
    request (batch only); ``duplicates`` says what a request with repeated edges does.
    """
    needed = [*keys, *([request_id] if request_id and request_id not in keys else []), *raw_columns(layout)]
    rows = require_columns(df, needed).fillna(dict(layout.fill))
    if edges == "refit":
        rows = bin_by_group(rows, [request_id], dict(layout.bins), layout.bin_labels, duplicates)
        model = PipelineModel(model.stages[1:])
    elif edges != "frozen":
        raise ValueError("edges must be 'frozen' or 'refit'")
    return predictions(model.transform(rows), *keys)


def score_requests(
    requests: DataFrame, model: PipelineModel, layout: Layout = APPLICANT_LAYOUT, accept: str = payload.JSON_TYPE,
    edges: str = "frozen", duplicates: str = "raise",
) -> DataFrame:
    """Answer CSV requests: (request_id, content_type, body); rejected requests get their error as body.

    ``edges="refit"`` bins every request by its own edges.
    """
    rows = payload.parse_csv_bodies(requests, "request_id")
    if edges == "refit":
        rows = materialize(rows, "request-rows")  # the edges read them more than once
    scored = score(rows.where("error is null"), model, ["request_id", "pos"], layout, edges, "request_id", duplicates)
    answers = payload.responses(scored.withColumnRenamed("y_pred", "prediction"), "request_id", accept)
    rejected = rows.where("error is not null").selectExpr("request_id", "'text/plain' as content_type", "error as body")
    return answers.unionByName(rejected)
