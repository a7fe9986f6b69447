"""Scoring requests and responses: CSV bodies in, JSON or CSV bodies out.

A body is one row of a table (request_id, content_type, body). Rows of a body are numbered, so answers are matched
by (request_id, pos) and never by the order rows happen to arrive in.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..schema import APPLICANT, APPLICANT_COLUMNS
from .files import cast_texts, null_tokens

CSV_TYPE = "text/csv"
JSON_TYPE = "application/json"
# Stands for a field's end while a line is taken apart; no character of any text.
FIELD_END = "\uffff"
# Stands for a record's end while a body is taken apart; no character of any text either.
RECORD_END = "\ufffe"


def csv_line(columns: Sequence[Column]) -> Column:
    """One CSV line; fields with a comma, quote or line break are quoted."""
    def field(c: Column) -> Column:
        text = F.coalesce(c.cast("string"), F.lit(""))
        quoted = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
        special = text.contains(",") | text.contains('"') | text.contains("\r") | text.contains("\n")
        return F.when(special, quoted).otherwise(text)

    return F.concat_ws(",", *[field(c) for c in columns])


def _cells(line: Column) -> Column:
    """The fields of one CSV line, in which ``FIELD_END`` stands for a comma inside quotes if the line has quotes.

    Cut at the quotes, every second piece stands inside quotes. Between them, an empty piece is a doubled quote and
    a comma ends a field. A quote that is not closed goes on to the end of the line.
    """
    def joined(pieces: Column) -> Column:
        def plain(piece: Column, i: Column) -> Column:
            doubled = (piece == "") & (i > 0) & (i < F.size(pieces) - 1)
            inside = F.when(piece.contains(","), F.replace(piece, F.lit(","), F.lit(FIELD_END))).otherwise(piece)
            return F.when(i % 2 == 1, inside).when(doubled, F.lit('"')).otherwise(piece)

        return F.array_join(F.transform(pieces, plain), "")

    # The pieces are the one element of an array, so that they are cut once and not again for each doubled quote.
    marked = F.get(F.transform(F.array(F.split(line, '"')), joined), F.lit(0))
    return F.split(F.when(line.contains('"'), marked).otherwise(line), ",")


def _cell(line: Column, cell: Column) -> Column:
    """A field as it is in the text, from one of ``_cells``."""
    return F.when(line.contains('"'), F.replace(cell, F.lit(FIELD_END), F.lit(","))).otherwise(cell)


def csv_fields(line: Column) -> Column:
    """The fields of one CSV line, however many there are; a quote inside a quoted field is doubled."""
    return F.transform(_cells(line), lambda cell: _cell(line, cell))


def csv_records(body: Column) -> Column:
    """The records of a CSV body: line breaks inside quotes belong to a field, the others end records.

    Cut at the quotes, every second piece stands inside quotes, so a piece's place is the state it is read in. A quote
    that is not closed goes on to the end of the body. Empty lines are no records.
    """
    def ended(text: Column, end: str) -> Column:
        # A break of two characters ends a record twice, and the empty record between is none.
        once = F.when(text.contains("\r"), F.replace(text, F.lit("\r"), F.lit(end))).otherwise(text)
        return once if end == "\n" else F.replace(once, F.lit("\n"), F.lit(end))

    plain = F.split(ended(body, "\n"), "\n")

    def cut(pieces: Column) -> Column:
        marked = F.transform(pieces, lambda piece, i: F.when(i % 2 == 1, piece).otherwise(ended(piece, RECORD_END)))
        broken = F.filter(pieces, lambda piece, i: (i % 2 == 1) & (piece.contains("\n") | piece.contains("\r")))
        return F.when(F.size(broken) == 0, plain).otherwise(F.split(F.array_join(marked, '"'), RECORD_END))

    quoted = F.get(F.transform(F.array(F.split(body, '"')), cut), F.lit(0))
    return F.filter(F.when(body.contains('"'), quoted).otherwise(plain), lambda record: record != "")


def csv_bodies(
    df: DataFrame, request_id: str, order: str, names: Mapping[str, str] = APPLICANT_COLUMNS
) -> DataFrame:
    """(request_id, content_type, body): the rows of each request as CSV text with a header, in ``order``.

    A request is one message, so its size must be bounded by the way ``request_id`` is chosen.
    """
    line = csv_line([F.col(c) for c in names.values()])
    header = ",".join(names)
    # Lines are made before they are grouped: an aggregate would evaluate them without generated code.
    lines = df.select(F.col(request_id), F.struct(F.col(order), line.alias("line")).alias("_row"))
    return lines.groupBy(request_id).agg(F.array_sort(F.collect_list("_row")).alias("_rows")).select(
        request_id,
        F.lit(CSV_TYPE).alias("content_type"),
        F.concat(F.lit(header + "\n"), F.concat_ws("\n", F.col("_rows.line")), F.lit("\n")).alias("body"),
    )


def parse_csv_bodies(
    requests: DataFrame,
    request_id: str,
    schema: T.StructType = APPLICANT,
    names: Mapping[str, str] = APPLICANT_COLUMNS,
) -> DataFrame:
    """(request_id, pos, error, columns...): rows of every body, columns taken by header name.

    A body of another content type or without a needed column gives one row with ``error`` set instead of failing
    the whole batch. Quoted fields, those of the header too, may hold line breaks.
    """
    lines = csv_records(F.col("body"))

    bodies = requests.select(request_id, "content_type", lines.alias("_lines"))
    header = F.transform(csv_fields(F.get("_lines", F.lit(0))), lambda title: F.trim(title))
    bodies = bodies.withColumn("_header", header)
    wanted = T.StructType([f for f in schema if f.name in names.values()])
    # Looked up once per body, not once per line, and only for the columns that are returned.
    titles = {name: title for title, name in names.items()}
    places = F.array(*[F.array_position("_header", titles[f.name]).cast("int") for f in wanted]).cast("array<int>")
    absent = F.array_except(F.array(*[F.lit(n) for n in names]), F.col("_header"))
    rows = bodies.select(
        request_id, "content_type", places.alias("_places"), absent.alias("_absent"),
        F.posexplode_outer(F.slice("_lines", 2, F.greatest(F.size("_lines") - 1, F.lit(0)))).alias("pos", "_line"),
    )
    error = (
        F.when(F.col("content_type") != CSV_TYPE, F.concat(F.lit("unsupported content type: "), "content_type"))
        .when(F.col("_line").isNull(), F.lit("empty body"))
        .when(F.size("_absent") > 0, F.concat(F.lit("missing columns: "), F.array_join("_absent", ", ")))
    )
    rows = rows.withColumns({"error": error, "_cells": _cells(F.col("_line"))})
    # All fields by one expression: with one for each, the code that Spark generates for parsing and scoring in one stage
    # passes 8,000 bytes a method, which the JVM does not compile.
    cells = F.transform("_places", lambda place: _cell(F.col("_line"), F.get("_cells", place - 1)))
    rows = rows.select(request_id, "pos", "error", F.when(F.col("error").isNull(), F.transform(cells, lambda text: null_tokens(text))).alias("_texts"))
    texts = rows.select(request_id, "pos", "error", *[F.get("_texts", F.lit(i)).alias(f.name) for i, f in enumerate(wanted)])
    out = cast_texts(texts, wanted, keep=[request_id, "pos", "error"])
    # One error row per rejected body, not one per line.
    return out.where(F.col("error").isNull() | (F.coalesce("pos", F.lit(0)) == 0))


def responses(predictions: DataFrame, request_id: str, accept: str = JSON_TYPE, value: str = "prediction") -> DataFrame:
    """(request_id, content_type, body): predictions of each request in row order."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("pos", value))), lambda r: r[value])
    if accept == JSON_TYPE:
        body = F.to_json(F.col("_values"))
    elif accept == CSV_TYPE:
        body = F.concat(F.lit(value + "\n"), F.array_join(F.col("_values").cast("array<string>"), "\n"), F.lit("\n"))
    else:
        raise ValueError(f"unsupported response type: {accept}")
    return predictions.groupBy(request_id).agg(ordered.alias("_values")).select(
        request_id, F.lit(accept).alias("content_type"), body.alias("body")
    )


def parse_json_responses(answers: DataFrame, request_id: str, value: str = "prediction") -> DataFrame:
    """(request_id, pos, prediction) from JSON arrays."""
    return answers.select(request_id, F.posexplode(F.from_json("body", "array<int>")).alias("pos", value))


def attach_predictions(
    rows: DataFrame, answers: DataFrame, request_id: str, missing: str = "raise", value: str = "prediction"
) -> DataFrame:
    """Join parsed responses to the rows of their requests by (request_id, pos); every row stays.

    A row without an answer, or an answer without a row, fails the job; with ``missing="null"`` the former gets null
    and the latter is left out.
    """
    if missing not in ("raise", "null"):
        raise ValueError("missing must be 'raise' or 'null'")
    found = parse_json_responses(answers, request_id, value)
    if missing == "null":
        return rows.join(found, [request_id, "pos"], "left")
    both = rows.withColumn("_row", F.lit(True)).join(found.withColumn("_answer", F.lit(True)), [request_id, "pos"], "full")
    where = F.concat(F.lit("request "), F.coalesce(F.col(request_id).cast("string"), F.lit("null")))
    checked = (
        F.when(F.col("_row").isNull(), F.raise_error(F.concat(where, F.lit(" has more answers than rows"))).cast("int"))
        .when(F.col("_answer").isNull(), F.raise_error(F.concat(where, F.lit(" has fewer answers than rows"))).cast("int"))
        .otherwise(F.col(value))
    )
    return both.withColumn(value, checked).drop("_row", "_answer")
