"""Registered queries over the driver tables, each with the SQL that must give the same rows where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import labels, text
from ..operators import binning, curvature, dictionary, distribution, encode, joins, metrics, profile, split
from ..schema import (
    APPLICANT, APPLICANT_COLUMNS, BIN_COLUMNS, BIN_LABELS, DISPLAY_BIN_LABELS, FEATURES, FILL_UNKNOWN, LABELLED, LABELS,
)
from ..operators.boosting import NewtonTrees
from ..session import materialize, scratch_path
from ..sources import files, payload, quoted_csv, versions
from ..sources.tables import applicants, labelled_docs, numbers_as_whole, table
from ..streaming.scoring import either_layout, read_arrivals, score_stream as start_scoring
from . import annotation, scoring, scripted, training

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return register


# ---------------------------------------------------------------- views, in SQL

V1 = """v1 AS (
  SELECT d.doc_id AS row_id, n_chars AS amount, lang, source, text AS description,
         CASE WHEN quality = 1 THEN 'good risk' ELSE 'bad risk' END AS target
  FROM documents d JOIN labels l ON l.doc_id = d.doc_id)"""

V2 = """v2 AS (
  SELECT o_orderkey AS row_id, c_nationkey AS request_id, o_totalprice AS credit_amount, c_acctbal AS balance,
         coalesce(quantity, 0) AS duration,
         CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex,
         c_nationkey % 4 AS job,
         CASE c_custkey % 3 WHEN 0 THEN 'own' WHEN 1 THEN 'rent' ELSE 'free' END AS housing,
         nullif(o_orderpriority, '4-NOT SPECIFIED') AS saving_accounts,
         CASE WHEN c_acctbal < 0 THEN 'little' WHEN c_acctbal < 5000 THEN 'moderate'
              WHEN c_acctbal < 9000 THEN 'rich' END AS checking_account,
         c_mktsegment AS purpose,
         CASE WHEN o_orderstatus = 'F' THEN 'bad risk' ELSE 'good risk' END AS target
  FROM orders JOIN customer ON o_custkey = c_custkey
  LEFT JOIN (SELECT l_orderkey, sum(l_quantity) AS quantity FROM lineitem GROUP BY 1) q ON l_orderkey = o_orderkey)"""

V3 = V2 + """, v3 AS (
  SELECT * REPLACE (CAST(floor(credit_amount) AS BIGINT) AS credit_amount, CAST(floor(duration) AS BIGINT) AS duration),
         CAST(floor(abs(balance)) AS BIGINT) % 47 + 19 AS age
  FROM v2)"""

NUMERIC = ("credit_amount", "balance", "duration")
CATEGORICAL = ("sex", "job", "housing", "saving_accounts", "checking_account", "purpose")
NINE = tuple(APPLICANT.fieldNames())
DOC_LAYOUT = training.Layout(
    bins={"amount": "amount_bin"},
    bin_labels={"amount": ("low", "mid-low", "mid-high", "high")},
    features=("lang", "source", "amount_bin"),
    fill={},
)


def whole_applicants(spark: SparkSession, folder: str) -> DataFrame:
    """The applicants with whole numbers and the columns of an applicant file."""
    return numbers_as_whole(applicants(spark, folder)).select("row_id", "request_id", *NINE, "target")


def _union(template: str, columns) -> str:
    return " UNION ALL ".join(template.format(c=c) for c in columns)


def rounded(df: DataFrame, *columns: str, digits: int = 4) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# ---------------------------------------------------------------- profiling

_INFO_TYPES = {"row_id": "bigint", "credit_amount": "double", "job": "int", "saving_accounts": "string",
               "checking_account": "string", "purpose": "string"}


@query(f"WITH {V2} " + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, '{t}' AS dtype, count(*) AS n_rows, count({c}) AS n_non_null FROM v2"
    for c, t in _INFO_TYPES.items()))
def frame_info(spark, folder):
    return profile.frame_info(applicants(spark, folder, duration=False).select(*_INFO_TYPES))


@query(f"WITH {V2} " + _union(
    "SELECT '{c}' AS feature, count(*) - count({c}) AS n_null FROM v2", [*CATEGORICAL, *NUMERIC]))
def null_profile(spark, folder):
    return profile.null_counts(applicants(spark, folder), [*CATEGORICAL, *NUMERIC])


@query(f"""WITH {V2}, c AS (SELECT saving_accounts AS value, count(*) AS n FROM v2
  WHERE saving_accounts IS NOT NULL GROUP BY 1)
  SELECT value, n, CAST(n AS DOUBLE) / CAST((SELECT sum(n) FROM c) AS DOUBLE) AS proportion FROM c""")
def value_share(spark, folder):
    return profile.value_share(applicants(spark, folder, duration=False), "saving_accounts").orderBy(F.desc("n"), "value")


@query(f"""WITH {V2}, c AS (SELECT target AS value, count(*) AS n FROM v2 GROUP BY 1)
  SELECT value, n, CAST(n AS DOUBLE) / CAST((SELECT sum(n) FROM c) AS DOUBLE) AS proportion FROM c""")
def target_share(spark, folder):
    return profile.value_share(applicants(spark, folder, duration=False), "target")


@query(f"WITH {V2} " + _union(
    """SELECT '{c}' AS feature, count({c}) AS "count", round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
       min({c}) AS min, round(quantile_cont({c}, 0.25), 4) AS p25, round(quantile_cont({c}, 0.5), 4) AS p50,
       round(quantile_cont({c}, 0.75), 4) AS p75, max({c}) AS max FROM v2""", NUMERIC))
def describe_numeric(spark, folder):
    rows = materialize(applicants(spark, folder).select(*NUMERIC), "numeric")
    return rounded(profile.describe_numeric(rows, NUMERIC), "mean", "std", "p25", "p50", "p75")


@query(f"WITH {V2} " + _union(
    "SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value, count(*) AS n FROM v2 GROUP BY 2", CATEGORICAL))
def value_counts_all(spark, folder):
    return profile.by_frequency(profile.value_counts(applicants(spark, folder, duration=False), CATEGORICAL))


@query(f"WITH {V2} " + _union(
    "SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value, count(*) AS n FROM v2 GROUP BY 2", ("job", "housing")))
def category_counts(spark, folder):
    return profile.value_counts(applicants(spark, folder, duration=False), ["job", "housing"])


_HISTOGRAM = """WITH r AS (SELECT min(c_acctbal) AS lo, max(c_acctbal) AS hi, (max(c_acctbal) - min(c_acctbal)) / 20 AS w
  FROM customer),
  g AS (SELECT c_acctbal AS x, lo, hi, w, CAST(least(floor((c_acctbal - lo) / w), 19) AS INTEGER) AS b FROM customer, r),
  e AS (SELECT CASE WHEN b > 0 AND x < lo + b * w THEN b - 1
                    WHEN b < 19 AND x >= lo + (b + 1) * w THEN b + 1 ELSE b END AS bin FROM g)
  SELECT CAST(i AS INTEGER) AS bin, round(lo + i * w, 4) AS lo,
         round(CASE WHEN i = 19 THEN hi ELSE lo + (i + 1) * w END, 4) AS hi,
         (SELECT count(*) FROM e WHERE e.bin = i) AS n
  FROM range(20) t(i), r"""


@query(_HISTOGRAM)
def histogram_20(spark, folder):
    return rounded(profile.histogram(table(spark, folder, "customer"), "c_acctbal", 20), "lo", "hi")


@query("""WITH r AS (SELECT min(c_acctbal) AS lo, max(c_acctbal) AS hi, count(*) AS n,
    stddev_samp(c_acctbal) * pow(count(*), -0.2) AS h FROM customer),
  p AS (SELECT i, lo + i * ((hi - lo) / 199) AS x, lo, hi, h FROM range(200) t(i), r)
  SELECT CAST(i AS INTEGER) AS point, round(x, 4) AS x,
    round((SELECT sum(exp(-0.5 * pow((c_acctbal - p.x) / p.h, 2))) FROM customer)
      * (hi - lo) / 20 / (h * sqrt(2 * pi())), 4) AS y
  FROM p""")
def kde_grid(spark, folder):
    return rounded(profile.kde(table(spark, folder, "customer"), "c_acctbal"), "x", "y")


_BOX = f"""WITH {V2}, long AS (
    SELECT row_id, target, 'credit_amount' AS feature, credit_amount AS value FROM v2
    UNION ALL SELECT row_id, target, 'duration', duration FROM v2),
  q AS (SELECT target, feature, count(*) AS n, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS med,
          quantile_cont(value, 0.75) AS q3 FROM long GROUP BY ALL),
  f AS (SELECT long.*, n, q1, med, q3,
          value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
        FROM long JOIN q USING (target, feature)) """


@query(_BOX + """SELECT target, feature, n, round(q1, 4) AS q1, round(med, 4) AS med, round(q3, 4) AS q3,
    round(least(min(value) FILTER (inside), q1), 4) AS whislo,
    round(greatest(max(value) FILTER (inside), q3), 4) AS whishi, count(*) FILTER (NOT inside) AS n_outliers
  FROM f GROUP BY target, feature, n, q1, med, q3""")
def box_stats(spark, folder):
    rows = materialize(applicants(spark, folder).select("target", "credit_amount", "duration"), "box")
    stats = profile.box_stats(rows, "target", ["credit_amount", "duration"])
    return rounded(stats, "q1", "med", "q3", "whislo", "whishi")


@query(ORACLES["box_stats"])
def box_stats_narrowed(spark, folder):
    rows = materialize(applicants(spark, folder).select("target", "credit_amount", "duration"), "box")
    stats = profile.box_stats(rows, "target", ["credit_amount", "duration"], local_rows=200)
    return rounded(stats, "q1", "med", "q3", "whislo", "whishi")


@query(_BOX + "SELECT row_id, target, feature, value FROM f WHERE NOT inside")
def box_outliers(spark, folder):
    rows = materialize(applicants(spark, folder).select("row_id", "target", "credit_amount", "duration"), "box")
    return profile.box_outliers(rows, "row_id", "target", ["credit_amount", "duration"])


# ---------------------------------------------------------------- conditional distributions

_COND = """SELECT '{c}' AS feature, value, target, n, CAST(n AS DOUBLE) / CAST(sum(n) OVER (PARTITION BY value) AS DOUBLE)
  AS share FROM (SELECT CAST({c} AS VARCHAR) AS value, target, count(*) AS n FROM {src} WHERE {c} IS NOT NULL
  GROUP BY 1, 2)"""


@query(f"""WITH {V3}, f AS (SELECT * REPLACE (coalesce(saving_accounts, 'unknown') AS saving_accounts,
    coalesce(checking_account, 'unknown') AS checking_account) FROM v3) """
       + " UNION ALL ".join(_COND.format(c=c, src="f") for c in NINE))
def cond_distribution_filled(spark, folder):
    rows = whole_applicants(spark, folder).fillna(FILL_UNKNOWN)
    return distribution.conditional_distribution(rows, "target", NINE, classes=LABELS)


@query(f"WITH {V3} " + " UNION ALL ".join(_COND.format(c=c, src="v3") for c in NINE))
def cond_distribution_dropna(spark, folder):
    return distribution.conditional_distribution(whole_applicants(spark, folder), "target", NINE, classes=LABELS)


# ---------------------------------------------------------------- quantile bins

_EDGES = ", ".join(f"quantile_cont({{c}}, {p})" for p in (0, 0.25, 0.5, 0.75, 1))


@query(f"WITH {V2} " + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, count({c}) AS n, " + ", ".join(
        f"round(quantile_cont({c}, {p}), 4) AS e{i}" for i, p in enumerate((0, 0.25, 0.5, 0.75, 1))) + " FROM v2"
    for c in NUMERIC))
def quantile_edges(spark, folder):
    rows = materialize(applicants(spark, folder).select(*NUMERIC), "numeric")
    found = binning.exact_quantiles(rows, NUMERIC, binning.QUARTILES)
    return found.select("feature", "n", *[F.round(F.col("edges")[i], 4).alias(f"e{i}") for i in range(5)])


@query(ORACLES["quantile_edges"])
def quantile_edges_narrowed(spark, folder):
    """The way of groups that are too large for one task, with a limit far below the rows of any data set."""
    rows = materialize(applicants(spark, folder).select(*NUMERIC), "numeric")
    found = binning.exact_quantiles(rows, NUMERIC, binning.QUARTILES, local_rows=200)
    return found.select("feature", "n", *[F.round(F.col("edges")[i], 4).alias(f"e{i}") for i in range(5)])


@query(f"""WITH {V2}, e AS (SELECT quantile_cont(credit_amount, [0, 0.25, 0.5, 0.75, 1]) AS q FROM v2)
  SELECT CAST(i AS INTEGER) AS ordinal, ['Low', 'Mid-Low', 'Mid-High', 'High'][i + 1] AS label,
    round(CASE WHEN i = 0 THEN round(q[1], 3) - 0.001 ELSE round(q[i + 1], 3) END, 3) AS lo,
    round(q[i + 2], 3) AS hi, false AS lo_inclusive
  FROM range(4) t(i), e""")
def bin_intervals(spark, folder):
    rows = materialize(applicants(spark, folder, duration=False).select("credit_amount"), "numeric")
    return binning.bin_intervals(rows, "credit_amount", DISPLAY_BIN_LABELS).orderBy("lo")


def _case(column: str, labels_: tuple, edge: str) -> str:
    low, mid_low, mid_high, high = labels_
    return (f"CASE WHEN {column} <= {edge.format(1)} THEN '{low}' WHEN {column} <= {edge.format(2)} THEN '{mid_low}' "
            f"WHEN {column} <= {edge.format(3)} THEN '{mid_high}' WHEN {column} IS NOT NULL THEN '{high}' END")


def _edge_cte(source: str, columns, by: str = "") -> str:
    cells = ", ".join(f"quantile_cont({c}, {p}) AS {c}_{i}" for c in columns for i, p in ((1, .25), (2, .5), (3, .75)))
    return f"SELECT {by + ', ' if by else ''}{cells} FROM {source}" + (f" GROUP BY {by}" if by else "")


_BINNED = ", ".join(f"{_case(c, BIN_LABELS[c], c + '_{}')} AS {BIN_COLUMNS[c]}" for c in BIN_COLUMNS)


@query(f"""WITH {V3}, e AS ({_edge_cte('v3', BIN_COLUMNS)})
  SELECT row_id, sex, job, housing, saving_accounts, checking_account, purpose, {_BINNED} FROM v3, e""")
def quantile_bins(spark, folder):
    rows = materialize(whole_applicants(spark, folder), "applicants")
    return training.fit_binner(rows).transform(rows).select("row_id", *FEATURES)


@query(f"""WITH {V3}, e AS ({_edge_cte('v3', BIN_COLUMNS, 'request_id')})
  SELECT row_id, request_id, {_BINNED} FROM v3 JOIN e USING (request_id)""")
def grouped_bins_per_request(spark, folder):
    rows = materialize(whole_applicants(spark, folder).select("row_id", "request_id", *BIN_COLUMNS), "applicants")
    binned = binning.bin_by_group(rows, ["request_id"], BIN_COLUMNS, BIN_LABELS, duplicates="keep")
    return binned.select("row_id", "request_id", *BIN_COLUMNS.values())


@query(ORACLES["grouped_bins_per_request"])
def grouped_bins_narrowed(spark, folder):
    rows = materialize(whole_applicants(spark, folder).select("row_id", "request_id", *BIN_COLUMNS), "applicants")
    binned = binning.bin_by_group(rows, ["request_id"], BIN_COLUMNS, BIN_LABELS, duplicates="keep", local_rows=100)
    return binned.select("row_id", "request_id", *BIN_COLUMNS.values())


@query(f"""WITH {V3}, r AS (SELECT * REPLACE (nullif(request_id, 3) AS request_id) FROM v3),
  e AS ({_edge_cte('r', BIN_COLUMNS, 'request_id')})
  SELECT row_id, r.request_id, {_BINNED} FROM r JOIN e ON r.request_id IS NOT DISTINCT FROM e.request_id""")
def grouped_bins_null_request(spark, folder):
    rows = whole_applicants(spark, folder).select("row_id", "request_id", *BIN_COLUMNS)
    rows = materialize(rows.withColumn("request_id", F.nullif("request_id", F.lit(3))), "applicants")
    binned = binning.bin_by_group(rows, ["request_id"], BIN_COLUMNS, BIN_LABELS, duplicates="keep")
    return binned.select("row_id", "request_id", *BIN_COLUMNS.values())


_CREDIT_BINS = f"""WITH {V2}, e AS ({_edge_cte('v2', ['credit_amount'])}),
  b AS (SELECT credit_amount, target, {_case('credit_amount', DISPLAY_BIN_LABELS, 'credit_amount_{}')} AS bin FROM v2, e) """


def _credit_bins(spark, folder):
    rows = applicants(spark, folder, duration=False).select("credit_amount", "target")
    rows = materialize(rows, "credit")
    binner = binning.QuantileBinner(
        inputCols=["credit_amount"], outputCols=["bin"], labels=[list(DISPLAY_BIN_LABELS)])
    return binner.fit(rows).transform(rows)


@query(_CREDIT_BINS + "SELECT bin, count(*) AS n, round(avg(credit_amount), 4) AS mean FROM b GROUP BY 1")
def bin_mean(spark, folder):
    return rounded(distribution.group_mean(_credit_bins(spark, folder), "bin", "credit_amount"), "mean")


@query(_CREDIT_BINS + """SELECT bin, target, n, CAST(n AS DOUBLE) / CAST(sum(n) OVER (PARTITION BY bin) AS DOUBLE) AS share
  FROM (SELECT bin, target, count(*) AS n FROM b GROUP BY 1, 2)""")
def bin_target_share(spark, folder):
    return distribution.group_share(_credit_bins(spark, folder), "bin", "target")


# ---------------------------------------------------------------- split, weights, encoding

_QUOTAS = """counts AS (SELECT {label} AS label, count(*) AS n FROM {src} GROUP BY 1),
  t AS (SELECT CAST(sum(n) AS BIGINT) AS total, (CAST(sum(n) AS BIGINT) + 4) // 5 AS n_test FROM counts),
  fl AS (SELECT label, n, n * (total - n_test) // total AS fl, n * (total - n_test) % total AS rest,
           total - n_test AS n_train FROM counts, t),
  quotas AS (SELECT label, n, fl + CASE WHEN row_number() OVER (ORDER BY rest DESC, label)
           <= n_train - sum(fl) OVER () THEN 1 ELSE 0 END AS n_train FROM fl)"""
_SPLIT = """SELECT v.*, row_number() OVER (PARTITION BY v.{label} ORDER BY md5('42:' || row_id), row_id) <= n - n_train
  AS is_test FROM {src} v JOIN quotas ON quotas.label = v.{label}"""


@query(f"""WITH {V2}, o AS (SELECT row_id, o_orderstatus AS label FROM v2 JOIN orders ON o_orderkey = row_id),
  {_QUOTAS.format(label='label', src='o')} {_SPLIT.format(label='label', src='o')}""")
def stratified_split(spark, folder):
    rows = table(spark, folder, "orders").join(
        table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey")
    ).select(F.col("o_orderkey").alias("row_id"), F.col("o_orderstatus").alias("label"))
    return split.stratified_split(materialize(rows, "orders"), "row_id", "label")


@query(f"""WITH {V2}, {_QUOTAS.format(label='target', src='v2')}
  SELECT label AS target, n, CAST(n_train AS BIGINT) AS n_train, CAST(n - n_train AS BIGINT) AS n_test FROM quotas""")
def split_quotas(spark, folder):
    counts = applicants(spark, folder, duration=False).groupBy("target").agg(F.count(F.lit(1)).alias("n"))
    return split.class_quotas(counts, "target", 0.2)


@query(f"""WITH {V1}, c AS (SELECT target, count(*) AS n FROM v1 GROUP BY 1)
  SELECT target, n, CAST((SELECT sum(n) FROM c) AS DOUBLE) / (CAST((SELECT count(*) FROM c) AS DOUBLE) * n) AS weight
  FROM c""")
def class_weights(spark, folder):
    return training.class_weights(labelled_docs(spark, folder), "target")


_DOC_BINS = f"""WITH {V1}, e AS ({_edge_cte('v1', ['amount'])}),
  b AS (SELECT row_id, lang, source, {_case('amount', DOC_LAYOUT.bin_labels['amount'], 'amount_{}')} AS amount_bin,
          CASE WHEN target = 'good risk' THEN 1 ELSE 0 END AS label FROM v1, e),
  cells AS (SELECT row_id, 1 AS block, 'lang' AS feature, lang AS category, label FROM b
    UNION ALL SELECT row_id, 2, 'source', source, label FROM b
    UNION ALL SELECT row_id, 3, 'amount_bin', amount_bin, label FROM b),
  pos AS (SELECT block, feature, category, CAST(row_number() OVER (ORDER BY block, category) - 1 AS INTEGER) AS position
    FROM (SELECT DISTINCT block, feature, category FROM cells)) """


def _doc_features(spark, folder):
    rows = labelled_docs(spark, folder).withColumn("label", labels.map_values(F.col("target")))
    rows = materialize(rows.drop("description"), "docs")
    features, _ = training.fit_features(rows, DOC_LAYOUT)
    return rows, features, encode.drop_helpers(features.transform(rows))


@query(_DOC_BINS + """SELECT row_id, position, feature, category, CAST(1 AS DOUBLE) AS value
  FROM cells JOIN pos USING (block, feature, category)""")
def one_hot_matrix(spark, folder):
    _, features, encoded = _doc_features(spark, folder)
    return encode.feature_cells(encoded, "row_id", features)


@query(_DOC_BINS + """SELECT row_id, position, feature, category, CAST(1 AS DOUBLE) AS value, label
  FROM cells JOIN pos USING (block, feature, category)""")
def matrix_csv_round_trip(spark, folder):
    _, features, encoded = _doc_features(spark, folder)
    width, path = len(encode.feature_names(features)), scratch_path(spark, "matrix")
    files.write_matrix_csv(encoded, path, width, key="row_id")
    back = files.read_matrix_csv(spark, path, width, key="row_id")
    return encode.feature_cells(back, "row_id", features, keep=["label"])


_WIDE = ["o_orderpriority", "o_custkey", "o_orderdate"]
_DICTIONARY = """WITH cells AS (SELECT o_orderkey AS row_id, 0 AS block, 'o_orderpriority' AS feature, NULL AS whole,
      o_orderpriority AS category FROM orders
    UNION ALL SELECT o_orderkey, 1, 'o_custkey', o_custkey, CAST(o_custkey AS VARCHAR) FROM orders
    UNION ALL SELECT o_orderkey, 2, 'o_orderdate', NULL, strftime(o_orderdate, '%Y-%m-%d') FROM orders),
  dict AS (SELECT row_number() OVER (ORDER BY block, whole, category) - 1 AS position, block, feature, category, n
    FROM (SELECT block, feature, whole, category, count(*) AS n FROM cells WHERE category IS NOT NULL GROUP BY ALL)) """


def _wide_orders(spark, folder):
    orders = table(spark, folder, "orders")
    return materialize(orders.select(F.col("o_orderkey").alias("row_id"), "o_orderpriority", "o_custkey", F.date_format(
        "o_orderdate", "yyyy-MM-dd").alias("o_orderdate")), "orders")


@query(_DICTIONARY + "SELECT position, block, feature, category, n FROM dict")
def category_dictionary(spark, folder):
    """Positions of all categories of three columns; ranges far below the number of categories."""
    return dictionary.build_dictionary(_wide_orders(spark, folder), _WIDE, local_rows=500)


@query(_DICTIONARY + """SELECT row_id, string_agg(CAST(position AS VARCHAR), ',' ORDER BY position) AS indices
  FROM cells JOIN dict USING (block, feature, category) GROUP BY row_id""")
def one_hot_by_dictionary(spark, folder):
    orders = _wide_orders(spark, folder)
    coded = dictionary.encode(orders, "row_id", dictionary.build_dictionary(orders, _WIDE), _WIDE)
    return coded.select("row_id", F.array_join("indices", ",").alias("indices"))


@query(f"""WITH {V1}, s AS (SELECT * FROM v1) SELECT 'lang' AS feature, count(*) AS n_unseen FROM v1
    WHERE lang NOT IN (SELECT lang FROM s WHERE source < 'src15')
  UNION ALL SELECT 'source', count(*) FROM v1 WHERE source NOT IN (SELECT source FROM s WHERE source < 'src15')""")
def unseen_categories(spark, folder):
    rows = materialize(labelled_docs(spark, folder).select("lang", "source"), "docs")
    encoder = encode.fit_encoder(rows.where("source < 'src15'"), ["lang", "source"])
    return encode.unseen_counts(rows, encoder)


_TRAIN_COUNTS = f"""WITH {V3}, f AS (SELECT * REPLACE (coalesce(saving_accounts, 'unknown') AS saving_accounts,
    coalesce(checking_account, 'unknown') AS checking_account), CASE WHEN target = 'good risk' THEN 1 ELSE 0 END AS label
    FROM v3),
  {_QUOTAS.format(label='label', src='f')}, s AS ({_SPLIT.format(label='label', src='f')}),
  tr AS (SELECT * FROM s WHERE NOT is_test), e AS ({_edge_cte('tr', BIN_COLUMNS)})
  SELECT sex, job, housing, saving_accounts, checking_account, purpose, {_BINNED}, label, is_test, count(*) AS n
  FROM s, e GROUP BY ALL"""


@query(_TRAIN_COUNTS)
def training_counts(spark, folder):
    train, test = training.prepare(whole_applicants(spark, folder), "row_id")
    binner = training.fit_binner(train)
    sides = [d.withColumn("is_test", F.lit(flag)) for d, flag in ((train, False), (test, True))]  # a folder each
    return encode.collapse(binner.transform(sides[0].unionByName(sides[1])), [*FEATURES, "label", "is_test"])


# ---------------------------------------------------------------- metrics

_SCORED = f"""WITH {V2}, s AS (SELECT row_id, CASE WHEN target = 'good risk' THEN 1 ELSE 0 END AS y_true,
    CASE WHEN balance > 4500 THEN 1 ELSE 0 END AS y_pred, balance AS y_prob FROM v2)"""


def _scored(spark, folder):
    return applicants(spark, folder, duration=False).select(
        "row_id", labels.map_values(F.col("target")).alias("y_true"),
        text.class_at(F.col("balance"), 4500).alias("y_pred"), F.col("balance").alias("y_prob"),
    )


@query(_SCORED + """ SELECT a.y AS y_true, b.y AS y_pred, (SELECT count(*) FROM s WHERE y_true = a.y AND y_pred = b.y) AS n
  FROM (VALUES (0), (1)) a(y), (VALUES (0), (1)) b(y)""")
def confusion(spark, folder):
    return metrics.confusion(_scored(spark, folder))


_REPORT = _SCORED + """, c AS (SELECT y AS label, CAST(sum(CASE WHEN y_true = y AND y_pred = y THEN 1 ELSE 0 END) AS DOUBLE) AS tp,
    sum(CASE WHEN y_pred = y THEN 1 ELSE 0 END) AS predicted, sum(CASE WHEN y_true = y THEN 1 ELSE 0 END) AS support
    FROM s, (VALUES (0), (1)) l(y) GROUP BY 1),
  m AS (SELECT CAST(label AS VARCHAR) AS label, coalesce(tp / nullif(predicted, 0), 0) AS precision,
    coalesce(tp / nullif(support, 0), 0) AS recall, coalesce(2 * tp / nullif(support + predicted, 0), 0) AS f1_score,
    CAST(support AS DOUBLE) AS support FROM c),
  a AS (SELECT * FROM m
    UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1_score), sum(support) FROM m
    UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
      sum(f1_score * support) / sum(support), sum(support) FROM m),
  r AS (SELECT label, metric, value FROM a UNPIVOT (value FOR metric IN (precision, recall, f1_score, support))
    UNION ALL SELECT 'accuracy', 'accuracy', avg(CAST(y_true = y_pred AS INTEGER)) FROM s) """


@query(_REPORT + "SELECT label, metric, round(value, 6) AS value FROM r")
def class_report(spark, folder):
    return rounded(metrics.classification_report(_scored(spark, folder)), "value", digits=6)


@query(_REPORT + "SELECT label, metric, printf('%.4f', value) AS text FROM r")
def report_text(spark, folder):
    return training.report_text(metrics.classification_report(_scored(spark, folder)))


_BY_SCORE = _SCORED + """, g AS (SELECT y_prob, CAST(sum(y_true) AS BIGINT) AS pos, CAST(sum(1 - y_true) AS BIGINT) AS neg
    FROM s GROUP BY 1) """


@query(_BY_SCORE + """, u AS (SELECT pos, neg, sum(neg) OVER (ORDER BY y_prob) AS upto FROM g)
  SELECT CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg,
    CAST(sum(pos * (2 * upto - neg)) AS DOUBLE) / (2.0::DOUBLE * CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)) AS auc
  FROM u""")
def roc_auc(spark, folder):
    return metrics.roc_auc(_scored(spark, folder))


_CURVE = _BY_SCORE + """, u AS (SELECT y_prob, pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp,
    lag(pos) OVER w AS before, lead(pos) OVER w AS next_pos, lead(neg) OVER w AS next_neg FROM g
    WINDOW w AS (ORDER BY y_prob DESC)),
  t AS (SELECT CAST(sum(pos) AS DOUBLE) AS p, CAST(sum(neg) AS DOUBLE) AS n FROM g),
  k AS (SELECT y_prob AS threshold, CAST(fp AS DOUBLE) / n AS fpr, CAST(tp AS DOUBLE) / p AS tpr FROM u, t
    WHERE {keep}
    UNION ALL SELECT NULL, 0, 0) """
_KEEP = "before IS NULL OR next_pos IS NULL OR next_pos <> pos OR next_neg <> neg"


def _finite(curve: DataFrame) -> DataFrame:
    return curve.withColumn("threshold", F.when(F.col("threshold") != float("inf"), F.col("threshold")))


@query(_CURVE.format(keep=_KEEP) + "SELECT * FROM k")
def roc_curve(spark, folder):
    return _finite(metrics.roc_curve(_scored(spark, folder)))


@query(_CURVE.format(keep="true") + "SELECT * FROM k")
def roc_curve_all_points(spark, folder):
    return _finite(metrics.roc_curve(_scored(spark, folder), drop_intermediate=False))


@query(_CURVE.format(keep=_KEEP) + """, z AS (SELECT fpr, tpr, lag(fpr) OVER w AS x0, lag(tpr) OVER w AS y0 FROM k
    WINDOW w AS (ORDER BY fpr, tpr))
  SELECT round(sum((fpr - x0) * (tpr + y0) / 2), 9) AS area FROM z""")
def curve_area(spark, folder):
    return rounded(metrics.curve_area(metrics.roc_curve(_scored(spark, folder))), "area", digits=9)


@query(ORACLES["roc_auc"])
def roc_auc_ranges(spark, folder):
    """The way of score tables that are too large for one task, with a limit far below the number of scores."""
    return metrics.roc_auc(_scored(spark, folder), local_rows=40)


@query(ORACLES["roc_curve"])
def roc_curve_ranges(spark, folder):
    return _finite(metrics.roc_curve(_scored(spark, folder), local_rows=40))


@query(ORACLES["curve_area"])
def curve_area_ranges(spark, folder):
    curve = metrics.roc_curve(_scored(spark, folder), local_rows=40)
    return rounded(metrics.curve_area(curve, local_rows=40), "area", digits=9)


# ---------------------------------------------------------------- texts and labels


def _sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


_DESCRIBE_SQL = f"{_sql_text(text.DESCRIBE_PROMPT)} || " + " || chr(10) || ".join(
    f"'- {title}: ' || coalesce(CAST({name} AS VARCHAR), 'nan')" for title, name in text.DESCRIBE_FIELDS)
_CLASSIFY_SQL = "{} || coalesce(description, 'nan') || {}".format(*map(_sql_text, text.CLASSIFY_PROMPT.split("{}")))


@query(f"WITH {V3} SELECT row_id, {_DESCRIBE_SQL} AS prompt FROM v3")
def describe_prompts(spark, folder):
    return whole_applicants(spark, folder).select("row_id", text.describe_prompt().alias("prompt"))


@query(f"WITH {V1} SELECT row_id, {_CLASSIFY_SQL} AS prompt FROM v1")
def classify_prompts(spark, folder):
    return labelled_docs(spark, folder).select("row_id", text.classify_prompt(F.col("description")).alias("prompt"))


@query(f"""WITH {V3} SELECT row_id, 'user' AS role, {_DESCRIBE_SQL} AS content, 250 AS max_tokens,
  CAST(0.7 AS DOUBLE) AS temperature, {_sql_text(text.REQUEST_VERSION[1])} AS version FROM v3""")
def request_json(spark, folder):
    name = text.REQUEST_VERSION[0]
    shape = f"{name} string, messages array<struct<role string, content string>>, max_tokens int, temperature double"
    body = text.request_body(text.describe_prompt(), **text.DESCRIBE_LIMITS)
    parsed = whole_applicants(spark, folder).select("row_id", F.from_json(body, shape).alias("r"))
    message = F.get("r.messages", F.lit(0))
    return parsed.select(
        "row_id", message["role"].alias("role"), message["content"].alias("content"), "r.max_tokens", "r.temperature",
        F.col(f"r.{name}").alias("version"),
    )


@query("SELECT doc_id, text FROM documents")
def response_extract(spark, folder):
    docs = table(spark, folder, "documents")
    return docs.select("doc_id", text.response_text(text.response_body(F.col("text"))).alias("text"))


@query("SELECT doc_id, substr(text, 1, 200) AS preview FROM documents")
def payload_preview(spark, folder):
    return table(spark, folder, "documents").select("doc_id", text.preview(F.col("text")).alias("preview"))


# Noisy answers made from the event types.
_NOISY = {"click": "  Good Risk ", "error": "\tBAD RISK\n", "view": "good risk", "signup": "moderate risk"}
_NOISY_SQL = "CASE event_type " + " ".join(
    f"WHEN '{k}' THEN {_sql_text(v)}" for k, v in _NOISY.items()) + " END"


def _answers(spark, folder):
    answer = F.coalesce(*[F.when(F.col("event_type") == k, F.lit(v)) for k, v in _NOISY.items()])
    return table(spark, folder, "events").select("event_id", "event_type", answer.alias("answer"))


@query("""SELECT event_id, CASE event_type WHEN 'click' THEN 'good risk' WHEN 'view' THEN 'good risk'
    WHEN 'error' THEN 'bad risk' ELSE 'ERROR' END AS label,
  CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 1 WHEN 'error' THEN 0 END AS class,
  CASE WHEN event_type IN ('click', 'view', 'error') THEN 'ok' ELSE 'error' END AS status FROM events""")
def label_normalise(spark, folder):
    label = labels.normalise_label(F.col("answer"))
    return _answers(spark, folder).select("event_id", label.alias("label")).select(
        "event_id", "label", labels.map_values(F.col("label")).alias("class"), labels.status_of(F.col("label")).alias("status")
    )


@query(f"""WITH {V2} SELECT row_id, coalesce(saving_accounts, 'unknown') AS saving_accounts,
    coalesce(checking_account, 'unknown') AS checking_account, CASE target WHEN 'good risk' THEN 1 WHEN 'bad risk' THEN 0 END
    AS label FROM v2""")
def fill_and_map(spark, folder):
    rows = applicants(spark, folder, duration=False).fillna(FILL_UNKNOWN)
    rows = joins.require_columns(rows, ["row_id", "saving_accounts", "checking_account", "target"])
    return rows.withColumn("label", labels.map_values(F.col("target"))).drop("target")


@query("""SELECT event_type IN ('click', 'view', 'error') AS clean, event_type, count(*) AS n FROM events GROUP BY 1, 2""")
def training_gate(spark, folder):
    rows = _answers(spark, folder).withColumn("target", labels.normalise_label(F.col("answer")))
    clean, quarantine = labels.training_gate(rows)
    both = clean.drop("label").withColumn("clean", F.lit(True)).unionByName(quarantine.withColumn("clean", F.lit(False)))
    return both.groupBy("clean", "event_type").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT count(*) AS n_rows, count(*) FILTER (event_type = 'error') AS n_errors,
  count(*) FILTER (event_type NOT IN ('error', 'click', 'view')) AS n_unexpected FROM events""")
def run_counters(spark, folder):
    result = (
        F.when(F.col("event_type") == "error", F.lit("ERROR: busy"))
        .when(F.col("event_type") == "click", F.lit("good risk"))
        .when(F.col("event_type") == "view", F.lit("bad risk"))
        .otherwise(F.lit("moderate risk"))
    )
    return labels.run_counters(table(spark, folder, "events").select(result.alias("result")), "result", LABELS)


@query("""WITH c AS (SELECT event_id // 500 AS chunk, count(*) AS rows, max(ts) - min(ts) AS took FROM events GROUP BY 1),
  u AS (SELECT chunk, CAST(sum(rows) OVER w AS BIGINT) AS rows_done,
      sum(CAST(epoch_us(took) AS BIGINT)) OVER w AS us FROM (SELECT chunk, rows, took FROM c) WINDOW w AS (ORDER BY chunk)),
  p AS (SELECT chunk, rows_done, (SELECT count(*) FROM events) - rows_done AS rows_left,
    CAST(us AS DOUBLE) / CAST(1000000 AS DOUBLE) AS elapsed FROM u)
  SELECT chunk, rows_done, rows_left, elapsed, elapsed / rows_done AS avg_seconds,
    round(elapsed / rows_done * rows_left / 60, 1) AS eta_minutes FROM p""")
def run_progress(spark, folder):
    log = materialize(_run_log(spark, folder), "run-log")
    return annotation.progress(log, log.agg(F.sum("rows")).scalar())


def _run_log(spark, folder):
    took = "max(ts) - min(ts)"
    parts = {"DAY": 86400, "HOUR": 3600, "MINUTE": 60, "SECOND": 1}
    seconds = " + ".join(f"extract({p} FROM took) * {s}" for p, s in parts.items())
    return (
        table(spark, folder, "events")
        .groupBy(F.expr("event_id div 500").alias("chunk"))
        .agg(F.count(F.lit(1)).alias("rows"), F.expr(took).alias("took"))
        .withColumn("seconds", F.expr(f"cast({seconds} as decimal(18,6))"))
    )


@query(ORACLES["run_progress"])
def run_progress_ranges(spark, folder):
    log = materialize(_run_log(spark, folder), "run-log")
    return annotation.progress(log, log.agg(F.sum("rows")).scalar(), local_rows=3)


# ---------------------------------------------------------------- key updates

@query("""SELECT o_orderkey AS row_id, coalesce(CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'fixed' END,
    o_orderpriority) AS note FROM orders""")
def point_update(spark, folder):
    rows = table(spark, folder, "orders").select(F.col("o_orderkey").alias("row_id"), F.col("o_orderpriority").alias("note"))
    fixes = rows.where("note = '4-NOT SPECIFIED'").select("row_id", F.lit("fixed").alias("note"))
    return joins.update_rows(rows, fixes, "row_id", ["note"])


@query("SELECT d.doc_id, lang, quality FROM documents d JOIN labels l ON d.doc_id = l.doc_id")
def attach_column(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "lang")
    return joins.attach(docs, table(spark, folder, "labels").select("doc_id", "quality"), "doc_id")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 100")
def first_rows(spark, folder):
    return joins.head_rows(table(spark, folder, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", 100)


# ---------------------------------------------------------------- files and payloads

@query(f"WITH {V3} SELECT {', '.join(NINE)}, target FROM v3")
def csv_round_trip(spark, folder):
    path = scratch_path(spark, "csv")
    files.write_table_csv(whole_applicants(spark, folder).drop("row_id", "request_id"), path)
    return files.read_table_csv(spark, path, LABELLED)


@query("SELECT doc_id, CASE WHEN text IN ('', 'NA', 'None', 'null', 'nan') THEN NULL ELSE text END AS text FROM documents")
def csv_text_round_trip(spark, folder):
    path = scratch_path(spark, "texts")
    docs = table(spark, folder, "documents").select("doc_id", "text")
    files.write_table_csv(docs, path, {})
    schema = docs.schema
    return files.read_table_csv(spark, path, schema, {}, multiline=True)


@query("SELECT 9007199254740993 + o_orderkey AS wide_key, o_custkey AS key FROM orders")
def csv_wide_keys(spark, folder):
    """Keys beyond 2 ** 53, which a double would round."""
    path = scratch_path(spark, "wide")
    rows = table(spark, folder, "orders").select(
        (F.lit(9007199254740993) + F.col("o_orderkey")).alias("wide_key"), F.col("o_custkey").cast("bigint").alias("key"))
    files.write_table_csv(rows, path, {})
    return files.read_table_csv(spark, path, rows.schema, {})


@query("SELECT doc_id, '  ' || text || ' ' AS text FROM documents")
def csv_padded_texts(spark, folder):
    path = scratch_path(spark, "padded")
    docs = table(spark, folder, "documents").select("doc_id", F.concat(F.lit("  "), "text", F.lit(" ")).alias("text"))
    files.write_table_csv(docs, path, {})
    return files.read_table_csv(spark, path, docs.schema, {}, multiline=True)


@query("SELECT doc_id, lang, n_chars FROM documents UNION ALL SELECT doc_id, lang, n_chars FROM documents "
       "UNION ALL SELECT doc_id, NULL, n_chars FROM documents")
def csv_mixed_headers(spark, folder):
    """Three sets of files in one folder: the same columns in two orders, and one column missing."""
    path = scratch_path(spark, "mixed")
    docs = table(spark, folder, "documents")
    for columns in (("doc_id", "lang", "n_chars"), ("n_chars", "doc_id", "lang"), ("n_chars", "doc_id")):
        files.write_table_csv(docs.select(*columns), path, {}, mode="append")
    return files.read_table_csv(spark, path, docs.select("doc_id", "lang", "n_chars").schema, {})


@query("""SELECT doc_id, lang, chr(10) || text || chr(10) || '"' || lang || '",' || chr(10) AS text FROM documents
    WHERE text IS NOT NULL AND lang IS NOT NULL""")
def csv_quoted_splits(spark, folder):
    """Texts with line breaks and quotes, read from splits of 64 KB."""
    path = scratch_path(spark, "quoted")
    docs = table(spark, folder, "documents").where("text IS NOT NULL AND lang IS NOT NULL").select(
        "doc_id", "lang", F.concat(F.lit("\n"), "text", F.lit('\n"'), "lang", F.lit('",\n')).alias("text"))
    files.write_table_csv(docs, path, {})
    with files.settings(spark, spark_sql_files_maxPartitionBytes=1 << 16, spark_sql_files_openCostInBytes=1 << 14):
        return quoted_csv.read_quoted_csv(spark, path, docs.schema, {})


@query("SELECT doc_id, text FROM documents")
def publish_round_trip(spark, folder):
    """Published twice: the second time takes the place of the first."""
    path, docs = scratch_path(spark, "published"), table(spark, folder, "documents").select("doc_id", "text")
    files.publish(docs.where("doc_id < 0"), path)
    files.publish(docs, path)
    return spark.read.parquet(path)


@query("""SELECT CAST(1 AS BIGINT) AS version, doc_id, text FROM documents WHERE doc_id % 2 = 0
  UNION ALL SELECT 2, doc_id, text FROM documents""")
def publish_versions(spark, folder):
    """Two published versions; a reader that resolved the first keeps its rows when the second counts."""
    root, docs = scratch_path(spark, "versions"), table(spark, folder, "documents").select("doc_id", "text")
    versions.publish_version(docs.where("doc_id % 2 = 0"), root)
    first = versions.read_version(spark, root)
    second = versions.publish_version(docs, root)
    numbered = lambda rows, n: rows.select(F.lit(n).cast("bigint").alias("version"), "doc_id", "text")
    return numbered(first, second.number - 1).unionByName(numbered(versions.read_version(spark, root), second.number))


@query(_SCORED + " SELECT row_id, y_true, y_pred, y_prob FROM s")
def predictions_round_trip(spark, folder):
    path = scratch_path(spark, "predictions")
    files.write_predictions(_scored(spark, folder), path, "row_id", fmt="csv")
    schema = "row_id bigint, y_true int, y_pred int, y_prob double"
    return spark.read.options(header=True).schema(schema).csv(path)


def _requests(spark, folder):
    """Requests of at most 256 applicants each: the request number is a range of the unique row id."""
    rows = numbers_as_whole(applicants(spark, folder)).withColumn("request_id", F.expr("row_id div 256"))
    return rows.select("row_id", "request_id", *NINE, "balance")


_NUMBERED = f"""WITH {V3}, n AS (SELECT *, row_id // 256 AS request, CAST(row_number() OVER (PARTITION BY row_id // 256
    ORDER BY row_id) - 1 AS INTEGER) AS pos FROM v3) """


@query(_NUMBERED + f"SELECT request AS request_id, pos, {', '.join(NINE)} FROM n")
def csv_payload_scan(spark, folder):
    bodies = payload.csv_bodies(_requests(spark, folder), "request_id", "row_id")
    return payload.parse_csv_bodies(bodies, "request_id").drop("error")


@query(_NUMBERED + f"SELECT request AS request_id, pos, {', '.join(NINE)} FROM n")
def csv_payload_wide_quoted(spark, folder):
    """Bodies of 209 columns whose first field is quoted."""
    rows = _requests(spark, folder)
    spare = {f"spare {i}": f"spare_{i}" for i in range(200)}
    rows = rows.withColumns({v: F.lit('a "b", c' if v == "spare_0" else v) for v in spare.values()})
    bodies = payload.csv_bodies(rows, "request_id", "row_id", {**spare, **APPLICANT_COLUMNS})
    return payload.parse_csv_bodies(bodies, "request_id").drop("error")


@query("""SELECT doc_id // 64 AS request_id, CAST(row_number() OVER (PARTITION BY doc_id // 64 ORDER BY doc_id) - 1 AS INTEGER) AS pos,
    doc_id, chr(10) || text || chr(13) || chr(10) || '"' AS text FROM documents WHERE text IS NOT NULL""")
def csv_payload_multiline(spark, folder):
    """Bodies whose quoted texts hold line breaks and quotes of their own."""
    docs = table(spark, folder, "documents").where("text IS NOT NULL").select(
        F.expr("doc_id div 64").alias("request_id"), "doc_id", F.concat(F.lit("\n"), "text", F.lit('\r\n"')).alias("text"))
    names = {"doc id": "doc_id", "the\ntext": "text"}
    bodies = payload.csv_bodies(docs, "request_id", "doc_id", {"doc id": "doc_id", "text": "text"})
    # The header's own line break stands in the bodies as a quoted field.
    bodies = bodies.withColumn("body", F.regexp_replace("body", "^doc id,text", 'doc id,"the\ntext"'))
    return payload.parse_csv_bodies(bodies, "request_id", docs.select("doc_id", "text").schema, names).drop("error")


def _answered(spark, folder):
    bodies = payload.csv_bodies(_requests(spark, folder), "request_id", "row_id")
    rows = payload.parse_csv_bodies(bodies, "request_id")
    return rows.withColumn("prediction", text.class_at(F.col("credit_amount"), 250_000))


_JSON_SQL = """SELECT request AS request_id, '[' || string_agg(CASE WHEN credit_amount > 250000 THEN '1' ELSE '0' END, ','
  ORDER BY pos) || ']' AS body FROM n GROUP BY 1"""


@query(_NUMBERED + _JSON_SQL)
def json_response(spark, folder):
    return payload.responses(_answered(spark, folder), "request_id").select("request_id", "body")


@query(_NUMBERED + """SELECT request AS request_id, 'prediction' || chr(10) || string_agg(CASE WHEN credit_amount > 250000
  THEN '1' ELSE '0' END, chr(10) ORDER BY pos) || chr(10) AS body FROM n GROUP BY 1""")
def csv_response(spark, folder):
    return payload.responses(_answered(spark, folder), "request_id", payload.CSV_TYPE).select("request_id", "body")


@query(_NUMBERED + f"""SELECT request AS request_id, pos, {', '.join(NINE)},
  CASE WHEN credit_amount > 250000 THEN 1 ELSE 0 END AS prediction FROM n""")
def response_attach(spark, folder):
    rows = materialize(_answered(spark, folder), "answered")
    answers = payload.responses(rows, "request_id")
    return payload.attach_predictions(rows.drop("prediction", "error"), answers, "request_id")


# ---------------------------------------------------------------- annotation

QUICK = annotation.Calls(attempts=3, wait=(0.0, 0.0))
ONCE = annotation.Calls(attempts=1, wait=(0.0, 0.0))


def _client(rules, flaky=0):
    return lambda: scripted.ScriptedClient(rules, flaky)


def _describe_rows(spark, folder):
    rows = numbers_as_whole(applicants(spark, folder))
    return rows.select("row_id", text.describe_prompt().alias("prompt"))


def _classify_rows(spark, folder):
    return labelled_docs(spark, folder).select("row_id", text.classify_prompt(F.col("description")).alias("prompt"))


_LENGTH_1 = f"WITH {V1}, p AS (SELECT row_id, length({_CLASSIFY_SQL}) AS n FROM v1) "
_LENGTH_2 = f"WITH {V3}, p AS (SELECT row_id, length({_DESCRIBE_SQL}) AS n FROM v3) "
_LABEL_SQL = """CASE WHEN n % 11 = 0 OR n % 7 = 0 THEN 'ERROR' WHEN n % 3 = 0 THEN 'bad risk' ELSE 'good risk' END"""


@query(_LENGTH_2 + """SELECT row_id, CASE WHEN n % 11 = 0 THEN 'ERROR' ELSE 'A text of ' || n || ' characters.' END
  AS description FROM p""")
def annotate_describe(spark, folder):
    answers = annotation.annotate(_describe_rows(spark, folder), "row_id", "prompt", _client(scripted.DESCRIBE_FIRST), ONCE)
    return annotation.export_text(answers, "row_id", "description")


@query(_LENGTH_1 + f"SELECT row_id, {_LABEL_SQL} AS target FROM p")
def annotate_classify(spark, folder):
    answers = annotation.annotate(_classify_rows(spark, folder), "row_id", "prompt", _client(scripted.FIRST_PASS), ONCE)
    return annotation.label_answers(answers, "row_id")


@query(_LENGTH_1 + f"SELECT row_id, {_LABEL_SQL} AS target FROM p")
def annotate_shared_rate(spark, folder):
    """Callers that share a total rate; its calls per second are far above what the callers make."""
    shared = annotation.Calls(attempts=1, wait=(0.0, 0.0), in_flight=2, rate=1e7, shared=True, round_seconds=0.1)
    answers = annotation.annotate(_classify_rows(spark, folder), "row_id", "prompt", _client(scripted.FIRST_PASS), shared)
    # A barrier stage runs whole, so its answers are written before they are looked at.
    return annotation.label_answers(materialize(answers, "answers"), "row_id")


@query(_LENGTH_1 + """SELECT row_id, CASE WHEN n % 11 = 0 THEN 'ERROR: refused' WHEN n % 7 = 0 THEN 'moderate risk'
    WHEN n % 3 = 0 THEN ' Bad Risk' || chr(10) ELSE 'Good Risk' END AS answer,
  CASE WHEN n % 11 = 0 OR n % 5 = 0 THEN 3 ELSE 1 END AS attempts FROM p""")
def annotate_retry(spark, folder):
    rows = _classify_rows(spark, folder)
    answers = annotation.annotate(rows, "row_id", "prompt", _client(scripted.FIRST_PASS, flaky=5), QUICK)
    answers = materialize(answers, "answers")
    texts = annotation.export_text(answers, "row_id", "answer", with_message=True)
    return texts.join(answers.select("row_id", "attempts"), "row_id")


@query(_LENGTH_1 + f"SELECT row_id, {_LABEL_SQL} AS target FROM p")
def annotate_resume(spark, folder):
    rows, path = _classify_rows(spark, folder), scratch_path(spark, "annotation")
    job = ("row_id", "prompt", _client(scripted.FIRST_PASS), path, ONCE)
    # An interrupted run: half of the keys have their answers.
    annotation.run_annotation(rows.where(F.xxhash64("row_id") % 2 == 0), *job)
    return annotation.label_answers(annotation.run_annotation(rows, *job).latest(), "row_id")


@query(_LENGTH_2 + """SELECT row_id, CASE WHEN n % 22 = 0 THEN 'ERROR' WHEN n % 11 = 0 THEN 'A second text of ' || n ||
  ' characters.' ELSE 'A text of ' || n || ' characters.' END AS description FROM p""")
def repair_descriptions(spark, folder):
    rows = materialize(_describe_rows(spark, folder), "prompts")
    first = annotation.annotate(rows, "row_id", "prompt", _client(scripted.DESCRIBE_FIRST), ONCE)
    first = materialize(annotation.export_text(first, "row_id", "description"), "described")
    return annotation.repair_descriptions(first, "row_id", rows, "prompt", _client(scripted.DESCRIBE_SECOND), ONCE)


@query(_LENGTH_1 + """SELECT row_id, CASE WHEN n % 22 = 0 THEN 'ERROR' WHEN n % 11 = 0 THEN 'good risk'
  WHEN n % 7 = 0 THEN 'bad risk' WHEN n % 3 = 0 THEN 'bad risk' ELSE 'good risk' END AS target FROM p""")
def repair_labels(spark, folder):
    rows = materialize(_classify_rows(spark, folder), "prompts")
    first = annotation.annotate(rows, "row_id", "prompt", _client(scripted.FIRST_PASS), ONCE)
    first = materialize(annotation.label_answers(first, "row_id"), "labelled")
    return annotation.repair_labels(first, "row_id", rows, "prompt", _client(scripted.SECOND_PASS), ONCE)


# ---------------------------------------------------------------- models

def _doc_rows(spark, folder):
    return labelled_docs(spark, folder).drop("description")


def _doc_run(spark, folder, algorithm="logistic", **options):
    return training.train_and_evaluate(_doc_rows(spark, folder), "row_id", DOC_LAYOUT, algorithm, **options)


def _doc_fit(spark, folder, algorithm="logistic", **options):
    return training.fit(_doc_rows(spark, folder), "row_id", DOC_LAYOUT, algorithm, **options)


@query(_DOC_BINS + """, c AS (SELECT row_id, position AS i, label FROM cells JOIN pos USING (block, feature, category)
    UNION ALL SELECT row_id, (SELECT count(*) FROM pos), label FROM b)
  SELECT CAST(x.i AS INTEGER) AS i, CAST(y.i AS INTEGER) AS j, CAST(count(*) AS DOUBLE) / 4 AS value
    FROM c x JOIN c y ON x.row_id = y.row_id AND x.i <= y.i GROUP BY 1, 2
  UNION ALL SELECT CAST(i AS INTEGER), -1, CAST(sum(label) AS DOUBLE) - CAST(count(*) AS DOUBLE) / 2 FROM c GROUP BY 1
  UNION ALL SELECT -2, -2, round(CAST(count(*) AS DOUBLE) * ln(2), 6) FROM b""")
def logistic_curvature(spark, folder):
    """Curvature, gradient and loss of the logistic loss where all coefficients are zero."""
    rows = labelled_docs(spark, folder).withColumn("label", labels.map_values(F.col("target")))
    features, merged = training.fit_features(materialize(rows.drop("description"), "docs"), DOC_LAYOUT)
    sums = curvature.curvature_sums(merged, [0.0] * (len(encode.feature_names(features)) + 1))
    return sums.withColumn("value", F.round("value", 6))


@query()
def train_logreg_eval(spark, folder):
    return _doc_run(spark, folder).report


@query()
def train_gbt_eval(spark, folder):
    return _doc_run(spark, folder, "trees").report


@query()
def applicant_risk_report(spark, folder):
    """The whole flow on nine applicant columns: gate, split, bin, encode, fit, evaluate."""
    return training.train_and_evaluate(whole_applicants(spark, folder), "row_id").report


def _arriving(spark, folder):
    return table(spark, folder, "documents").select(F.col("doc_id").alias("row_id"), "lang", "source", F.col("n_chars").alias("amount"))


@query()
def score_batch(spark, folder):
    model, path = _doc_fit(spark, folder).model, scratch_path(spark, "model")
    scoring.save_model(model, path)
    return scoring.score(_arriving(spark, folder), scoring.load_model(path), ["row_id"], DOC_LAYOUT)


@query()
def score_refit(spark, folder):
    """Scores with bins recomputed inside every request, a request being the applicants of one nation."""
    rows = materialize(whole_applicants(spark, folder), "applicants")
    model = training.fit(rows, "row_id").model
    return scoring.score(rows, model, ["row_id"], edges="refit", request_id="request_id", duplicates="keep")


def _with_target(spark, folder, rows):
    """Written request rows with their targets, which the order's status tells."""
    status = table(spark, folder, "orders").select(F.col("o_orderkey").alias("row_id"), "o_orderstatus")
    target = F.when(F.col("o_orderstatus") == "F", LABELS[1]).otherwise(LABELS[0])
    return rows.join(status, "row_id").withColumn("target", target)


@query()
def score_csv_requests(spark, folder):
    rows = materialize(_requests(spark, folder), "requests")
    model = training.fit(_with_target(spark, folder, rows), "row_id").model
    return scoring.score_requests(payload.csv_bodies(rows, "request_id", "row_id"), model)


@query()
def score_stream(spark, folder):
    return _streamed(spark, folder, _doc_fit(spark, folder).model)


def _streamed(spark, folder, model):
    schema = table(spark, folder, "documents").schema
    arrivals = read_arrivals(spark, either_layout(f"{folder}/documents.parquet"), schema).select(
        F.col("doc_id").alias("row_id"), "lang", "source", F.col("n_chars").alias("amount")
    )
    out = scratch_path(spark, "stream")
    start_scoring(arrivals, model, ["row_id"], out, scratch_path(spark, "stream-state"), DOC_LAYOUT).awaitTermination()
    return spark.read.schema("row_id bigint, y_prob double, y_pred int").parquet(out)


# ---------------------------------------------------------------- models, where SQL knows the answer

_DOC_SPLIT = f"""f AS (SELECT *, CASE WHEN target = 'good risk' THEN 1 ELSE 0 END AS label FROM v1),
  {_QUOTAS.format(label='label', src='f')}, s AS ({_SPLIT.format(label='label', src='f')}),
  tr AS (SELECT * FROM s WHERE NOT is_test)"""
_SUPPORTS = "SELECT CAST(label AS VARCHAR) AS label, CAST(n - n_train AS DOUBLE) AS support FROM quotas"


def _supports(report: DataFrame) -> DataFrame:
    return report.where("metric = 'support' AND label IN ('0', '1')").select("label", F.col("value").alias("support"))


_ZERO_GRADIENT = f"""WITH {V1}, {_DOC_SPLIT}, e AS ({_edge_cte('tr', ['amount'])}),
  b AS (SELECT lang, source, {_case('amount', DOC_LAYOUT.bin_labels['amount'], 'amount_{}')} AS amount_bin FROM tr, e)
  SELECT DISTINCT 'lang' AS feature, lang AS category, CAST(0 AS DOUBLE) AS gradient FROM b
  UNION SELECT 'source', source, 0 FROM b UNION SELECT 'amount_bin', amount_bin, 0 FROM b"""


def _zero(gradient: DataFrame) -> DataFrame:
    size = F.col("gradient")
    return gradient.withColumn("gradient", F.when(F.abs(size) < 1e-3, 0.0).otherwise(size))


@query(_ZERO_GRADIENT)
def logistic_gradient(spark, folder):
    """The gradient of the penalised loss at the fitted coefficients, which is zero at the optimum only."""
    done = _doc_fit(spark, folder)
    names = encode.category_table(spark, done.features)
    return _zero(training.gradient(done.merged, done.classifier, names))


@query(_ZERO_GRADIENT)
def logistic_from_matrix(spark, folder):
    """Fitted from the headerless matrix instead of raw rows."""
    done = _doc_fit(spark, folder)
    names, path = encode.category_table(spark, done.features), scratch_path(spark, "train-matrix")
    width = len(encode.feature_names(done.features))
    files.write_matrix_csv(done.features.transform(done.train), path, width)
    rows = files.read_matrix_csv(spark, path, width).withColumn("n", F.lit(1))
    return _zero(training.gradient(rows, training.fit_logistic(rows), names))


@query(f"WITH {V1}, {_DOC_SPLIT} {_SUPPORTS}")
def held_out_supports(spark, folder):
    return _supports(_doc_run(spark, folder).report)


@query("SELECT doc_id AS row_id, true AS same FROM documents")
def score_agreement(spark, folder):
    """Per row: the saved model, the fitted one and the stream give one probability, and its class is that at 0.5."""
    model, path = _doc_fit(spark, folder).model, scratch_path(spark, "model")
    scoring.save_model(model, path)
    rows = _arriving(spark, folder)
    ways = (scoring.score(rows, model, ["row_id"], DOC_LAYOUT),
            scoring.score(rows, scoring.load_model(path), ["row_id"], DOC_LAYOUT), _streamed(spark, folder, model))
    every = None
    for i, scored in enumerate(ways):
        part = scored.select("row_id", F.col("y_prob").alias(f"p{i}"), F.col("y_pred").alias(f"c{i}"))
        every = part if every is None else every.join(part, "row_id", "full")
    probabilities = (F.col("p0") == F.col("p1")) & (F.col("p0") == F.col("p2"))
    classes = [F.col(f"c{i}") == (F.col("p0") > 0.5).cast("int") for i in range(3)]
    return every.select("row_id", F.coalesce(probabilities & classes[0] & classes[1] & classes[2], F.lit(False)).alias("same"))


@query(f"""WITH {V1}, {_DOC_SPLIT} SELECT label, metric, CAST(0 AS DOUBLE) AS difference
  FROM (VALUES ('0'), ('1'), ('macro avg'), ('weighted avg')) l(label),
       (VALUES ('precision'), ('recall'), ('f1_score'), ('support')) m(metric)
  UNION ALL SELECT 'accuracy', 'accuracy', 0 UNION ALL SELECT 'roc_auc', 'roc_auc', 0""")
def tree_report_by_row(spark, folder):
    """Figures of boosted trees on merged rows less those on single rows."""
    run = _doc_run(spark, folder, "trees", rounds=5)
    single = run.features.transform(run.test).withColumn("n", F.lit(1))
    other = training.evaluate(single, run.classifier).withColumnRenamed("value", "single")
    gap = F.round(F.abs(F.col("value") - F.col("single")), 9)
    return run.report.join(other, ["label", "metric"], "full").select("label", "metric", gap.alias("difference"))


@query("SELECT CAST(i AS INTEGER) AS round, true AS sound FROM range(1, 21) t(i)")
def tree_round_aucs(spark, folder):
    """Validation AUC after each boosting round; the last one is that of the report."""
    run = _doc_run(spark, folder, "trees")
    aucs = training.round_aucs(training.merged_rows(run.test, run.features, DOC_LAYOUT), run.classifier)
    final = run.report.where("metric = 'roc_auc'").select("value").scalar()
    sound = F.col("auc").between(0, 1) & ((F.col("round") < 20) | (F.abs(F.col("auc") - final) < 1e-9))
    return aucs.select("round", F.coalesce(sound, F.lit(False)).alias("sound"))


_LANGS = ("de", "en", "es", "fr")


def _split_rows(spark, folder):
    """(features, label) of the labelled documents: hundreds of characters up to 200, and one column per language."""
    docs = table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id").where("quality IS NOT NULL")
    size = F.least(F.floor(F.col("n_chars") / 100), F.lit(200)).cast("double")
    langs = [(F.col("lang") == x).cast("double") for x in _LANGS]
    return docs.select(F.array(size, *langs).alias("features"), F.col("quality").cast("int").alias("label"))


@query("""WITH d AS (SELECT quality AS y, [least(n_chars // 100, 200)::DOUBLE, (lang = 'de')::INT, (lang = 'en')::INT,
      (lang = 'es')::INT, (lang = 'fr')::INT] AS x FROM documents JOIN labels USING (doc_id) WHERE quality IS NOT NULL),
  c AS (SELECT y, f, x[f + 1] AS v FROM d, (SELECT unnest(range(0, 5)) AS f)),
  b AS (SELECT f, v, sum(0.5 - y) AS g, sum(0.25) AS h FROM c WHERE v IS NOT NULL GROUP BY 1, 2),
  m AS (SELECT f, g0 AS g_none, h0 AS h_none FROM (SELECT f, sum(0.5 - y) AS g0, sum(0.25) AS h0 FROM c WHERE v IS NULL GROUP BY 1)),
  t AS (SELECT sum(0.5 - y)::DOUBLE AS g_all, sum(0.25)::DOUBLE AS h_all FROM d),
  s AS (SELECT b.f, (lag(v) OVER w + v) / 2 AS cut, (sum(g) OVER w - g)::DOUBLE AS g_low, (sum(h) OVER w - h)::DOUBLE AS h_low
    FROM b WINDOW w AS (PARTITION BY f ORDER BY v)),
  k AS (SELECT s.f, cut, missing_left, g_low + CASE WHEN missing_left THEN coalesce(g_none, 0) ELSE 0 END::DOUBLE AS gl,
      h_low + CASE WHEN missing_left THEN coalesce(h_none, 0) ELSE 0 END::DOUBLE AS hl
    FROM s LEFT JOIN m USING (f), (SELECT unnest([false, true]) AS missing_left) WHERE cut IS NOT NULL),
  r AS (SELECT *, gl * gl / (hl + 1) + (g_all - gl) * (g_all - gl) / (h_all - hl + 1) - g_all * g_all / (h_all + 1) AS gain FROM k, t
    WHERE hl >= 1 AND h_all - hl >= 1)
  SELECT f::INT AS feature, cut, missing_left, round(gain, 6) AS gain, round(-0.1 * gl / (hl + 1), 9) AS left_value,
    round(-0.1 * (g_all - gl) / (h_all - hl + 1), 9) AS right_value FROM r WHERE gain > 1e-6
  ORDER BY r.gain DESC, f, cut, missing_left LIMIT 1""")
def newton_first_split(spark, folder):
    """The root of the first second-order tree, and the values of its two leaves."""
    model = NewtonTrees(rounds=1, depth=1).fit(_split_rows(spark, folder))
    nodes = model.tree_table(spark)
    value = lambda i: F.max(F.when(F.col("node") == i, F.round("value", 9)))
    root = lambda c: F.max(F.when(F.col("node") == 1, F.col(c)))
    return nodes.agg(
        root("feature").alias("feature"), root("cut").alias("cut"), root("missing_left").alias("missing_left"),
        F.round(root("gain"), 6).alias("gain"), value(2).alias("left_value"), value(3).alias("right_value"),
    ).where("feature IS NOT NULL")


@query("SELECT CAST(i AS INTEGER) AS round, true AS sound FROM range(1, 6) t(i)")
def newton_round_aucs(spark, folder):
    """Validation AUC of second-order trees after each round; the last one is that of the report."""
    run = _doc_run(spark, folder, "newton", rounds=5)
    aucs = training.round_aucs(training.merged_rows(run.test, run.features, DOC_LAYOUT), run.classifier)
    final = run.report.where("metric = 'roc_auc'").select("value").scalar()
    sound = F.col("auc").between(0, 1) & ((F.col("round") < 5) | (F.abs(F.col("auc") - final) < 1e-9))
    return aucs.select("round", F.coalesce(sound, F.lit(False)).alias("sound"))


@query(_NUMBERED + "SELECT request AS request_id, count(*) AS answers FROM n GROUP BY 1")
def score_requests_refit(spark, folder):
    """CSV requests answered with bins of their own; one answer per row."""
    rows = materialize(_requests(spark, folder), "requests")
    model = training.fit(_with_target(spark, folder, rows), "row_id").model
    bodies = payload.csv_bodies(rows, "request_id", "row_id")
    answers = scoring.score_requests(bodies, model, edges="refit", duplicates="keep")
    size = F.size(F.from_json("body", "array<int>")).cast("bigint")
    return answers.select("request_id", size.alias("answers"))


_CHAIN = f"""WITH {V1}, {V1.replace('v1 AS', 'w1 AS')}, p AS (SELECT row_id, length({_CLASSIFY_SQL}) AS len FROM w1),
  f AS (SELECT v1.* EXCLUDE (target), CASE WHEN len % 11 = 0 THEN 1 WHEN len % 7 = 0 THEN 0 WHEN len % 3 = 0 THEN 0 ELSE 1 END
      AS label FROM v1 JOIN p ON v1.row_id = p.row_id WHERE len % 22 <> 0),
  {_QUOTAS.format(label='label', src='f')}"""


@query(f"{_CHAIN} {_SUPPORTS}")
def annotate_to_train(spark, folder):
    """Classify, repair the failed labels, set aside what still fails, train and evaluate, in one plan."""
    docs = materialize(labelled_docs(spark, folder).withColumn(
        "prompt", text.classify_prompt(F.col("description"))).drop("description", "target"), "docs")
    prompts = docs.select("row_id", "prompt")
    first = annotation.annotate(prompts, "row_id", "prompt", _client(scripted.FIRST_PASS), ONCE)
    first = materialize(annotation.label_answers(first, "row_id"), "labelled")
    fixed = annotation.repair_labels(first, "row_id", prompts, "prompt", _client(scripted.SECOND_PASS), ONCE)
    rows = docs.drop("prompt").join(fixed, "row_id")
    return _supports(training.train_and_evaluate(rows, "row_id", DOC_LAYOUT).report)


@query(_LENGTH_1 + "SELECT count(*) AS rows, count(*) FILTER (n % 11 = 0) AS failed FROM p")
def annotate_counters(spark, folder):
    """Completed and failed calls, counted while the answers are written."""
    counters = annotation.Counters(spark)
    rows = _classify_rows(spark, folder)
    materialize(annotation.annotate(rows, "row_id", "prompt", _client(scripted.FIRST_PASS), ONCE, counters), "answers")
    return spark.createDataFrame([counters.values()], "rows bigint, failed bigint")
