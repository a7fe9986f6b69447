"""Second-order boosted trees on the logistic loss, grown from histograms.

Feature values are cut once into bins, between all distinct values of a feature if there are at most ``max_bins`` of them, else
at its exact quantiles, and rows with equal bins are merged. A level of a tree is one aggregation: gradient and Hessian sums
per (node, feature, bin), combined on the map side. A row sends only the bins that are not the feature's most frequent one;
the sums of that bin are the node's totals less all others. So a one-hot block of any width costs one cell a row. The best
split of each node is found by running sums over the bins; one row per node goes to the driver.

Gains are ``GL^2/(HL+l2) + GR^2/(HR+l2) - G^2/(H+l2)`` and a leaf is ``-eta * G/(H+l2)``. Values below a cut go left; rows
without a value go to the side with the larger gain, right if neither is better. Among equal gains the first feature and the
lowest cut win. Gradients are summed as whole numbers (fixed point), so neither the order of rows nor repeated tasks nor the
number of partitions change a bit of the model.
"""

from __future__ import annotations

import json
import math
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import Bucketizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize
from .quantiles import exact_quantiles

#: Sums stay below this many bits.
SUM_BITS, MOST_BITS = 61, 40
#: A split must gain more than this.
LEAST_GAIN = 1e-6


@dataclass(frozen=True)
class Node:
    """A node of a tree; children of ``i`` are ``2 i`` and ``2 i + 1``. A leaf has no feature."""

    node: int
    grad: float
    cover: float
    value: float
    feature: int | None = None
    cut: float | None = None
    missing_left: bool = False
    gain: float = 0.0


def values(df: DataFrame, features: str) -> Column:
    """The features as an array of doubles."""
    kind = df.schema[features].dataType
    return vector_to_array(features) if isinstance(kind, VectorUDT) else F.col(features).cast("array<double>")


def cut_points(df: DataFrame, features: str, max_bins: int) -> list[list[float]]:
    """Ascending cuts of each feature: halfway between its distinct values, or at quantiles where these are too many."""
    cells = df.select(F.posexplode(values(df, features)).alias("feature", "value")).where("value is not null and not isnan(value)")
    # Distinct values are wanted up to a limit only: a fixed number of them is kept per feature while rows are merged.
    first = Window.partitionBy("feature").orderBy("value")
    few = cells.distinct().withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= max_bins + 1)
    width = df.select(F.max(F.size(values(df, features)))).first()[0] or 0
    found = {r.feature: sorted(r.vals) for r in few.groupBy("feature").agg(F.collect_list("value").alias("vals")).collect()}
    wide = [f for f, v in found.items() if len(v) > max_bins]
    if wide:
        names = {f: f"x{f}" for f in wide}
        table = df.select(*[F.get(values(df, features), F.lit(f)).alias(c) for f, c in names.items()])
        probs = [i / max_bins for i in range(1, max_bins)]
        quantiles = {r.feature: r.edges for r in exact_quantiles(materialize(table, "wide-features"), list(names.values()), probs).collect()}
    # Rows below a cut go left, so a cut at the lowest value would cut nothing off.
    return [sorted({q for q in quantiles[f"x{f}"] if q > found[f][0]}) if f in wide
            else [(a + b) / 2 for a, b in zip(found.get(f, []), found.get(f, [])[1:])] for f in range(width)]


def binned(df: DataFrame, features: str, cuts: Sequence[Sequence[float]], label: str, weight: str | None) -> DataFrame:
    """(bins, label, n): rows with equal bins and label as one. A value's bin is the number of cuts at or below it, or -1."""
    x = values(df, features)
    n = F.col(weight).cast("double") if weight else F.lit(1.0)
    table = df.select(F.col(label).cast("int").alias("label"), n.alias("n"), *[F.get(x, F.lit(i)).alias(f"x{i}") for i in range(len(cuts))])
    long = [i for i, c in enumerate(cuts) if len(c) > 1]
    if long:
        table = Bucketizer(
            splitsArray=[[-math.inf, *cuts[i], math.inf] for i in long], inputCols=[f"x{i}" for i in long],
            outputCols=[f"b{i}" for i in long], handleInvalid="keep").transform(table)

    def bin_of(i: int) -> Column:
        cell = F.col(f"x{i}")
        place = F.col(f"b{i}").cast("int") if len(cuts[i]) > 1 else F.when(cell >= cuts[i][0], 1).otherwise(0) if cuts[i] else F.lit(0)
        return F.when(cell.isNull() | F.isnan(cell), -1).otherwise(place)

    bins = F.array(*[bin_of(i) for i in range(len(cuts))]).cast("array<int>")
    return table.select(bins.alias("bins"), "label", "n").groupBy("bins", "label").agg(F.sum("n").alias("n"))


def _usual_bins(rows: DataFrame) -> list[int]:
    """The most frequent bin of each feature."""
    counts = rows.select("n", F.posexplode("bins").alias("feature", "bin")).groupBy("feature", "bin").agg(F.sum("n").alias("n"))
    best = counts.where("bin >= 0").groupBy("feature").agg(F.max(F.struct("n", (-F.col("bin")).alias("bin"))).alias("top"))
    usual = {r.feature: -r.bin for r in best.select("feature", "top.bin").collect()}
    width = max(usual, default=-1) + 1
    return [usual.get(i, 0) for i in range(width)]


def _node_of(splits: Mapping[int, tuple[int, int, bool]], node: int = 1) -> Column:
    """The node in which a row stands, from the splits made so far: (feature, last bin on the left, missing go left)."""
    if node not in splits:
        return F.lit(node)
    feature, last, missing_left = splits[node]
    b = F.get(F.col("bins"), F.lit(feature))
    left = (b <= last) if missing_left else (b >= 0) & (b <= last)
    return F.when(left, _node_of(splits, 2 * node)).otherwise(_node_of(splits, 2 * node + 1))


def _histogram(rows: DataFrame, usual: Sequence[int]) -> tuple[DataFrame, DataFrame]:
    """((node, feature, bin, g, h), (node, g_all, h_all)) of rows (node, bins, g, h), usual bins completed from the totals."""
    default = F.lit(list(usual))
    cells = F.filter(F.transform("bins", lambda b, i: F.struct(i.alias("feature"), b.alias("bin"))),
                     lambda c: c["bin"] != F.get(default, c["feature"]))
    whole = F.struct(F.lit(-1).alias("feature"), F.lit(-1).alias("bin"))
    sums = materialize(
        rows.select("node", "g", "h", F.inline(F.concat(F.array(whole), cells))).groupBy("node", "feature", "bin")
        .agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.count("*").alias("rows")), "histogram")
    total = sums.where("feature < 0").select("node", F.col("g").alias("g_all"), F.col("h").alias("h_all"), F.col("rows").alias("rows_all"))
    sent = sums.where("feature >= 0")
    known = sent.groupBy("node", "feature").agg(*[F.sum(c).alias(f"{c}_sent") for c in ("g", "h", "rows")])
    every = total.select("*", F.posexplode(default).alias("feature", "bin"))
    rest = every.join(known, ["node", "feature"], "left").select(
        "node", "feature", "bin", *[(F.col(f"{c}_all") - F.coalesce(f"{c}_sent", F.lit(0))).alias(c) for c in ("g", "h", "rows")])
    return sent.unionByName(rest.where("rows > 0")), total


def best_splits(rows: DataFrame, usual: Sequence[int], unit: float, l2: float, least_cover: float, least_gain: float) -> DataFrame:
    """One row per node: g_all, h_all and the best (gain, feature, bin, missing_left, g_left, h_left), which may be null."""
    cells, total = _histogram(rows, usual)
    upto = Window.partitionBy("node", "feature").orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    missing = F.when(F.col("bin") < 0, F.col("g")), F.when(F.col("bin") < 0, F.col("h"))
    whole = Window.partitionBy("node", "feature")
    running = cells.select(
        "node", "feature", "bin", *[F.coalesce(F.max(m).over(whole), F.lit(0)).alias(c) for m, c in zip(missing, ("g_none", "h_none"))],
        F.sum("g").over(upto).alias("g_upto"), F.sum("h").over(upto).alias("h_upto"), F.sum("rows").over(upto).alias("rows_upto"))
    placed = running.where("bin >= 0").join(total, "node").where("rows_upto < rows_all")
    real = lambda c: c.cast("double") / F.lit(unit)
    sides = F.array(F.struct(F.lit(False).alias("missing_left"), (F.col("g_upto") - F.col("g_none")).alias("g_left"), (F.col("h_upto") - F.col("h_none")).alias("h_left")),
                    F.struct(F.lit(True).alias("missing_left"), F.col("g_upto").alias("g_left"), F.col("h_upto").alias("h_left")))
    tried = placed.select("node", "feature", "bin", "g_all", "h_all", F.inline(sides))
    g, h, gl, hl = (real(F.col(c)) for c in ("g_all", "h_all", "g_left", "h_left"))
    gr, hr = real(F.col("g_all") - F.col("g_left")), real(F.col("h_all") - F.col("h_left"))
    gain = gl * gl / (hl + l2) + gr * gr / (hr + l2) - g * g / (h + l2)
    chosen = tried.withColumn("gain", gain).where((hl >= least_cover) & (hr >= least_cover) & (F.col("gain") > least_gain))
    best = chosen.groupBy("node").agg(F.max(F.struct(
        "gain", (-F.col("feature")).alias("feature"), (-F.col("bin")).alias("bin"), (~F.col("missing_left")).alias("right"),
        "g_left", "h_left")).alias("best"))
    return total.join(best, "node", "left").select(
        "node", "g_all", "h_all", F.col("best.gain").alias("gain"), (-F.col("best.feature")).alias("feature"),
        (-F.col("best.bin")).alias("bin"), (~F.col("best.right")).alias("missing_left"), "best.g_left", "best.h_left")


def _grown(rows: DataFrame, usual, cuts, unit: float, depth: int, eta: float, l2: float, least_cover: float,
           least_gain: float) -> tuple[list[Node], dict[int, tuple[int, int, bool]]]:
    """One tree on rows (bins, g, h)."""
    splits: dict[int, tuple[int, int, bool]] = {}
    nodes: dict[int, Node] = {}
    leaf = lambda i, g, h: Node(i, g / unit, h / unit, -eta * (g / unit) / (h / unit + l2))
    open_nodes = [1]
    for level in range(max(1, depth)):
        standing = rows.withColumn("node", _node_of(splits)).where(F.col("node").isin(open_nodes))
        open_nodes = []
        for r in best_splits(standing, usual, unit, l2, least_cover, least_gain).collect():  # at most 2 ** level rows
            nodes[r.node] = leaf(r.node, r.g_all, r.h_all)
            if r.gain is None or level >= depth:
                continue
            splits[r.node] = (r.feature, r.bin, r.missing_left)
            nodes[r.node] = Node(r.node, r.g_all / unit, r.h_all / unit, 0.0, r.feature, cuts[r.feature][r.bin], r.missing_left, r.gain)
            nodes[2 * r.node] = leaf(2 * r.node, r.g_left, r.h_left)
            nodes[2 * r.node + 1] = leaf(2 * r.node + 1, r.g_all - r.g_left, r.h_all - r.h_left)
            open_nodes += [2 * r.node, 2 * r.node + 1]
        if not open_nodes:
            break
    return [nodes[i] for i in sorted(nodes)], splits


def _by_node(nodes: Mapping[int, Node], node: Column) -> Column:
    leaves = [n for n in nodes.values() if n.feature is None]
    found = F.when(F.lit(False), F.lit(0.0))
    for n in leaves:
        found = found.when(node == n.node, F.lit(n.value))
    return found


def fit_nodes(df: DataFrame, features: str, label: str, weight: str | None, rounds: int, depth: int, eta: float, l2: float,
              least_cover: float, least_gain: float, max_bins: int) -> list[list[Node]]:
    """The trees, one list of nodes per round."""
    cuts = cut_points(df, features, max_bins)
    rows = materialize(binned(df, features, cuts, label, weight).withColumn("margin", F.lit(0.0)), "binned")
    total = rows.agg(F.sum("n")).first()[0] or 0.0
    if not total:
        raise ValueError("no rows to fit")
    bits = min(MOST_BITS, SUM_BITS - max(0, math.ceil(math.log2(total))))
    unit, usual = float(2**bits), _usual_bins(rows)
    usual += [0] * (len(cuts) - len(usual))
    trees = []
    for _ in range(rounds):
        p = 1 / (1 + F.exp(-F.col("margin")))
        whole = lambda c: F.round(c * F.col("n") * unit).cast("bigint")
        steep = rows.withColumn("p", p).select("bins", "label", "n", "margin", whole(F.col("p") - F.col("label")).alias("g"), whole(F.col("p") * (1 - F.col("p"))).alias("h"))
        nodes, splits = _grown(steep, usual, cuts, unit, depth, eta, l2, least_cover, least_gain)
        trees.append(nodes)
        step = _by_node({n.node: n for n in nodes}, _node_of(splits))
        rows = materialize(rows.withColumn("margin", F.col("margin") + step), "margins")
    return trees


class _TreeParams(Params):
    featuresCol = Param(Params._dummy(), "featuresCol", "vector or array of the features", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "0 or 1", TypeConverters.toString)
    weightCol = Param(Params._dummy(), "weightCol", "rows that a row stands for", TypeConverters.toString)
    rounds = Param(Params._dummy(), "rounds", "number of trees", TypeConverters.toInt)
    depth = Param(Params._dummy(), "depth", "levels of splits", TypeConverters.toInt)
    eta = Param(Params._dummy(), "eta", "shrinkage of a leaf", TypeConverters.toFloat)
    l2 = Param(Params._dummy(), "l2", "penalty on leaves", TypeConverters.toFloat)
    leastCover = Param(Params._dummy(), "leastCover", "least Hessian sum of a child", TypeConverters.toFloat)
    leastGain = Param(Params._dummy(), "leastGain", "a split must gain more", TypeConverters.toFloat)
    maxBins = Param(Params._dummy(), "maxBins", "most bins of a feature", TypeConverters.toInt)


class NewtonTrees(Estimator, _TreeParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fits ``NewtonTreesModel``; null and NaN feature values are missing."""

    @keyword_only
    def __init__(self, *, featuresCol=None, labelCol=None, weightCol=None, rounds=None, depth=None, eta=None, l2=None,
                 leastCover=None, leastGain=None, maxBins=None):
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label", rounds=20, depth=3, eta=0.1, l2=1.0, leastCover=1.0,
                         leastGain=LEAST_GAIN, maxBins=256)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> NewtonTreesModel:
        of = self.getOrDefault
        trees = fit_nodes(
            dataset, of(self.featuresCol), of(self.labelCol), of(self.weightCol) if self.isDefined(self.weightCol) else None,
            of(self.rounds), of(self.depth), of(self.eta), of(self.l2), of(self.leastCover), of(self.leastGain), of(self.maxBins))
        model = NewtonTreesModel()
        return model._set(featuresCol=of(self.featuresCol), trees=json.dumps([[asdict(n) for n in t] for t in trees]))


class NewtonTreesModel(Model, _TreeParams, DefaultParamsReadable, DefaultParamsWritable):
    trees = Param(Params._dummy(), "trees", "the nodes of all trees as JSON", TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(featuresCol="features", trees="[]")

    def nodes(self) -> list[list[Node]]:
        return [[Node(**n) for n in t] for t in json.loads(self.getOrDefault(self.trees))]

    def _steps(self, dataset: DataFrame) -> list[Column]:
        """What each tree adds to a row's margin."""
        x = values(dataset, self.getOrDefault(self.featuresCol))

        def reached(nodes: dict[int, Node], i: int) -> Column:
            n = nodes[i]
            if n.feature is None:
                return F.lit(n.value)
            cell = F.get(x, F.lit(n.feature))
            none = cell.isNull() | F.isnan(cell)
            left = none | (cell < n.cut) if n.missing_left else ~none & (cell < n.cut)
            return F.when(left, reached(nodes, 2 * i)).otherwise(reached(nodes, 2 * i + 1))

        return [reached({n.node: n for n in t}, 1) for t in self.nodes()]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        # As an array that is added up: a chain of additions would nest as deep as there are trees.
        steps = self._steps(dataset)
        margin = F.aggregate(F.array(*steps), F.lit(0.0), lambda a, b: a + b) if steps else F.lit(0.0)
        p = 1 / (1 + F.exp(-F.col("margin")))
        return dataset.withColumn("margin", margin).withColumn("probability", array_to_vector(F.array(1 - p, p))).withColumn(
            "prediction", (p >= 0.5).cast("double"))

    def round_margins(self, dataset: DataFrame, *keep: str) -> DataFrame:
        """(keep..., round, score): each row's margin after each round."""
        upto = F.aggregate(
            F.array(*self._steps(dataset)), F.array().cast("array<double>"),
            lambda done, step: F.concat(done, F.array(F.coalesce(F.get(done, F.size(done) - 1), F.lit(0.0)) + step)))
        return dataset.select(*keep, F.posexplode(upto).alias("round", "score")).withColumn("round", F.col("round") + 1)

    def tree_table(self, spark) -> DataFrame:
        """(round, node, feature, cut, missing_left, gain, cover, value): one row per node."""
        rows = [(i, n.node, n.feature, n.cut, n.missing_left, n.gain, n.cover, n.value) for i, t in enumerate(self.nodes(), 1) for n in t]
        return spark.createDataFrame(rows, "round int, node int, feature int, cut double, missing_left boolean, gain double, cover double, value double")
