"""Boosted ranking trees with a list-wise objective, as DataFrame jobs.

The training table has one row per user, holding the user's candidates (as many as the longest list, 50 here) as an array
with label, binned features and running score. Users without a positive are in no pair and have no AP: they have no row
(the features' quantiles count them too). A boosting round is

1. one narrow pass that sorts each array by score and computes, for every pair of a positive and a negative, the
   logistic loss gradient weighted by what swapping the two would change in AP@k; no shuffle, as a user is a row;
2. one histogram aggregate a tree level: sums of gradient and curvature by (node, feature, bin), which every task adds up
   before it sends them, so a round sends ``nodes x features x bins`` rows a task whatever the number of candidates;
3. the best cut of each node, by a window over the histogram; only the cuts reach the driver.

Gradients are summed in fixed-point units, so trees do not depend on partitioning. A model is a table of tree nodes: it is
stored and read as Parquet and applied as a column expression. Rounds are validated by MAP@k on the users of one fold and stop
when ``patience`` rounds have brought no gain.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from covisit_spark.operators.features import FEATURES
from covisit_spark.sources import sinks

UNIT = 1_000_000_000
DEFAULTS = {
    "rounds": 499,
    "learning_rate": 0.1,
    "max_depth": 6,
    "max_leaves": 50,
    "min_rows": 100,
    "bins": 64,
    "sigma": 1.0,
    "l2": 0.001,
    "k": 20,
    "patience": 50,
}
MODEL_SCHEMA = "tree int, node int, feature string, threshold double, value double, gain double"


@dataclass
class RankModel:
    """Trees as {node: (feature, threshold, gain) or value}, the root being node 1 and the children of n 2n and 2n + 1."""

    features: list[str]
    trees: list[dict] = field(default_factory=list)
    curve: list[float] = field(default_factory=list)

    def rows(self) -> list[tuple]:
        out = []
        for t, tree in enumerate(self.trees):
            for node, x in tree.items():
                out.append((t, node, x[0], float(x[1]), None, float(x[2])) if isinstance(x, tuple) else (t, node, None, None, float(x), None))
        return out

    @classmethod
    def from_rows(cls, features: Sequence[str], rows, curve: Sequence[float] = ()) -> RankModel:
        trees: dict[int, dict] = {}
        for r in rows:
            trees.setdefault(r["tree"], {})[r["node"]] = r["value"] if r["feature"] is None else (r["feature"], r["threshold"], r["gain"])
        return cls(list(features), [trees[t] for t in sorted(trees)], list(curve))

    def importance(self) -> list[tuple[str, float]]:
        """Total gain of the cuts on each feature as a share of all, best first."""
        gains = dict.fromkeys(self.features, 0.0)
        for tree in self.trees:
            for x in tree.values():
                if isinstance(x, tuple):
                    gains[x[0]] += x[2]
        total = sum(gains.values()) or 1.0
        return sorted(((f, g / total) for f, g in gains.items()), key=lambda x: (-x[1], x[0]))


def save_model(spark: SparkSession, model: RankModel, path: str) -> None:
    """Write the nodes of ``model`` as a Parquet table, with its feature list and curve beside every node of the first tree."""
    notes = json.dumps({"features": model.features, "curve": model.curve})
    nodes = spark.createDataFrame(model.rows(), MODEL_SCHEMA)
    nodes.withColumn("notes", F.when(F.col("tree") == 0, F.lit(notes))).coalesce(1).write.mode("overwrite").parquet(path)


def load_model(spark: SparkSession, path: str) -> RankModel:
    rows = spark.read.parquet(path).orderBy("tree", "node").collect()
    notes = json.loads(next(r["notes"] for r in rows if r["notes"] is not None))
    return RankModel.from_rows(notes["features"], rows, notes["curve"])


# --- applying trees ----------------------------------------------------------
def _route(tree: Mapping, node: int, right, leaf) -> Column:
    """Walk ``tree`` from ``node``: ``right(feature, threshold)`` says where a row goes, ``leaf(node)`` what it gets."""
    x = tree.get(node)
    if not isinstance(x, tuple):
        return leaf(node)
    # a null feature is no more than any threshold
    return F.when(right(x[0], x[1]), _route(tree, 2 * node + 1, right, leaf)).otherwise(_route(tree, 2 * node, right, leaf))


def tree_value(tree: Mapping) -> Column:
    """The value that ``tree`` gives to a row of features."""
    return _route(tree, 1, lambda f, t: F.col(f).cast("double") > F.lit(float(t)), lambda n: F.lit(float(tree.get(n, 0.0))))


def raw_score(model: RankModel, rounds: int | None = None) -> Column:
    """Sum of the first ``rounds`` trees, in their order."""
    values = [tree_value(t) for t in model.trees[:rounds]]
    return F.aggregate(F.array(*values), F.lit(0.0), lambda a, x: a + x) if values else F.lit(0.0)


def score(models: Sequence[RankModel], frame: DataFrame) -> DataFrame:
    """``frame`` with ``score``, the mean over ``models``."""
    total = F.lit(0.0)
    for m in models:
        total = total + raw_score(m)
    return frame.withColumn("score", total / F.lit(float(len(models))))


def score_stored(spark: SparkSession, paths: Sequence[str], frame: DataFrame) -> DataFrame:
    """Score with models stored by an earlier session: the mean of all."""
    return score([load_model(spark, p) for p in paths], frame)


# --- list-wise gradients -----------------------------------------------------
def _tie(c: Column) -> Column:
    return F.when(c > 0, c).otherwise(F.lit(1 << 30))


def _order(c: Column) -> Column:
    """Array of candidates by score, best first; ties as in the ranked lists."""
    keyed = F.transform(c, lambda x: F.struct((-x["score"]).alias("s"), x["tie"].alias("t"), x["item"].alias("i"), x.alias("x")))
    return F.transform(F.array_sort(keyed), lambda x: x["x"])


def average_precision(ordered: Column, k: int) -> Column:
    """AP@k of an array of candidates in order, in units of 1e-9 by integer division; null without positives."""
    start = F.struct(F.lit(0).cast("long").alias("rank"), F.lit(0).cast("long").alias("hits"), F.lit(0).cast("long").alias("units"))

    def step(a: Column, x: Column) -> Column:
        rank, hits = a["rank"] + 1, a["hits"] + x["y"]
        gain = F.when((x["y"] == 1) & (rank <= k), F.floor(hits * UNIT / rank)).otherwise(F.lit(0))
        return F.struct(rank.alias("rank"), hits.cast("long").alias("hits"), (a["units"] + gain.cast("long")).alias("units"))

    return F.aggregate(ordered, start, step, lambda a: F.when(a["hits"] > 0, F.floor(a["units"] / F.least(a["hits"], F.lit(k)))))


def _swaps(ordered: Column, k: int) -> Column:
    """Each candidate in order with its rank ``r``, positives up to it ``h``, and sum of 1 / rank over those within k, ``w``."""
    empty = F.array().cast("array<struct<r:int,y:int,h:int,w:double>>")

    def step(a: Column, x: Column) -> Column:
        last = F.try_element_at(a, F.lit(-1))
        first = F.size(a) == 0
        r = F.size(a) + 1
        h = F.when(first, F.lit(0)).otherwise(last["h"]) + x["y"]
        w = F.when(first, F.lit(0.0)).otherwise(last["w"]) + F.when((x["y"] == 1) & (r <= k), F.lit(1.0) / r).otherwise(F.lit(0.0))
        return F.concat(a, F.array(F.struct(r.alias("r"), x["y"].cast("int").alias("y"), h.cast("int").alias("h"), w.alias("w"))))

    return F.aggregate(ordered, empty, step)


def swap_change(p: Column, n: Column, positives: Column, k: int) -> Column:
    """|change| in AP@k if a positive ``p`` and a negative ``n`` (with r, h, w) traded places."""
    ahead = p["r"] < n["r"]
    a, b = F.least(p["r"], n["r"]), F.greatest(p["r"], n["r"])
    # with the positive in the front place, and without
    hits_a = F.when(ahead, p["h"]).otherwise(n["h"] + 1)
    w_a = F.when(ahead, p["w"]).otherwise(n["w"])
    w_b = F.when(ahead, n["w"]).otherwise(p["w"] - F.when(p["r"] <= k, F.lit(1.0) / p["r"]).otherwise(F.lit(0.0)))
    hits_b = F.when(ahead, n["h"]).otherwise(p["h"])
    front = F.when(a <= k, hits_a / a).otherwise(F.lit(0.0))
    back = F.when(b <= k, hits_b / b).otherwise(F.lit(0.0))
    return (front + (w_b - w_a) - back) / F.least(positives, F.lit(k))


def with_gradients(groups: DataFrame, k: int, sigma: float) -> DataFrame:
    """``groups`` (user, fold, c) with ``c`` in order and fixed-point ``g`` and ``h`` in every candidate.

    Every pair of a positive and a negative of a user counts: at most (length of the list / 2) ** 2 pairs.
    """
    placed = groups.withColumn("c", _order(F.col("c"))).withColumn("at", _swaps(F.col("c"), k))
    paired = placed.withColumn("z", F.arrays_zip("c", "at"))
    positives = F.col("at")[F.size("at") - 1]["h"]

    def one(z: Column) -> Column:
        def part(o: Column) -> Column:
            p_first = z["at"]["y"] == 1
            pos = lambda f: F.when(p_first, z["at"][f]).otherwise(o["at"][f])
            neg = lambda f: F.when(p_first, o["at"][f]).otherwise(z["at"][f])
            p, n = ({f: side(f) for f in ("r", "h", "w")} for side in (pos, neg))
            gap = (z["c"]["score"] - o["c"]["score"]) * F.when(p_first, F.lit(sigma)).otherwise(F.lit(-sigma))
            rho = F.lit(1.0) / (F.lit(1.0) + F.exp(F.least(gap, F.lit(500.0))))
            weight = swap_change(p, n, positives, k)
            sign = F.when(p_first, F.lit(1.0)).otherwise(F.lit(-1.0))
            return F.struct((sign * sigma * weight * rho).alias("g"), (sigma * sigma * weight * rho * (1 - rho)).alias("h"))

        others = F.filter("z", lambda o: o["at"]["y"] != z["at"]["y"])
        zero = F.struct(F.lit(0).cast("long").alias("g"), F.lit(0).cast("long").alias("h"))
        units = lambda x: F.round(x * UNIT).cast("long")
        return F.aggregate(
            F.transform(others, part), zero, lambda a, x: F.struct((a["g"] + units(x["g"])).alias("g"), (a["h"] + units(x["h"])).alias("h"))
        )

    return paired.withColumn("d", F.transform("z", one)).select("user", "fold", "c", "d")


# --- training ----------------------------------------------------------------
def thresholds(frame: DataFrame, features: Sequence[str], bins: int) -> dict[str, list[float]]:
    """At most ``bins`` - 1 distinct quantiles of each feature, from one aggregate."""
    at = [i / bins for i in range(1, bins)]
    row = frame.agg(*[F.percentile_approx(F.col(f).cast("double"), at, 10 * bins).alias(f) for f in features]).first()
    return {f: sorted(set(row[f] or [])) for f in features}


def grouped(frame: DataFrame, target: str, cuts: Mapping[str, Sequence[float]]) -> DataFrame:
    """(user, fold, c): one row a user with a positive, ``c`` its candidates with label ``y``, feature ``bins`` and ``score`` 0."""

    def bin_of(f: str) -> Column:
        if not cuts[f]:
            return F.lit(0)
        limits = F.array(*[F.lit(float(t)) for t in cuts[f]])
        return F.size(F.filter(limits, lambda t: F.col(f).cast("double") > t))

    one = F.struct(
        F.col("item"), _tie(F.col("origOrder")).cast("int").alias("tie"), F.col(target).cast("int").alias("y"),
        F.array(*[bin_of(f) for f in cuts]).alias("bins"), F.lit(0.0).alias("score"),
    )
    # the users first: features are binned, and lists made, of those with a positive only
    users = frame.where(F.col(target) == 1).select(F.col("user").alias("_user"), F.col("fold").alias("_fold")).distinct()
    same = F.col("user").eqNullSafe(F.col("_user")) & F.col("fold").eqNullSafe(F.col("_fold"))
    return frame.join(users, same, "left_semi").groupBy("user", "fold").agg(F.collect_list(one).alias("c"))


def histogram(rows: DataFrame, tree: Mapping, frontier: Sequence[int], order: Mapping[str, int]) -> DataFrame:
    """(node, f, b, g, h, n) over ``rows`` (bins, g, h) for the nodes of ``frontier``."""
    node = _route(tree, 1, lambda f, b: F.get("bins", F.lit(order[f])) > F.lit(int(b)), lambda n: F.lit(n))
    placed = rows.select(node.alias("node"), "bins", "g", "h").where(F.col("node").isin(list(frontier)))
    each = placed.select("node", F.posexplode("bins").alias("f", "b"), "g", "h")
    return each.groupBy("node", "f", "b").agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.count(F.lit(1)).alias("n"))


def best_cuts(hist: DataFrame, min_rows: int, l2: float) -> list:
    """One row a node: its best cut (least feature and bin on ties), null without one, and the sums of the node."""
    upto = Window.partitionBy("node", "f").orderBy("b")
    every = Window.partitionBy("node", "f")
    sums = hist.select(
        "node", "f", "b",
        *[F.sum(c).over(upto).alias(f"{c}l") for c in "ghn"],
        *[F.sum(c).over(every).alias(c) for c in "ghn"],
    )
    unit = F.lit(float(UNIT))
    part = lambda g, h: (g / unit) * (g / unit) / (h / unit + F.lit(l2))
    gain = part(F.col("gl"), F.col("hl")) + part(F.col("g") - F.col("gl"), F.col("h") - F.col("hl")) - part(F.col("g"), F.col("h"))
    allowed = (F.col("nl") >= min_rows) & (F.col("n") - F.col("nl") >= min_rows)
    cut = sums.withColumn("gain", F.when(allowed, gain))
    best = Window.partitionBy("node").orderBy(F.col("gain").desc_nulls_last(), "f", "b")
    return cut.withColumn("k", F.row_number().over(best)).where("k = 1").select("node", "f", "b", "gain", "g", "h").collect()


def grow_tree(rows: DataFrame, features: Sequence[str], p: Mapping) -> dict:
    """One tree over bins: {node: (feature, bin, gain) or value}. One histogram job a level."""
    order = {f: i for i, f in enumerate(features)}
    tree: dict = {}
    frontier, leaves = [1], 1
    for depth in range(p["max_depth"] + 1):
        found = best_cuts(histogram(rows, tree, frontier, order), p["min_rows"], p["l2"])
        frontier = []
        for r in sorted(found, key=lambda r: (-(r["gain"] or 0.0), r["node"])):
            if r["gain"] is not None and r["gain"] > 1e-12 and depth < p["max_depth"] and leaves < p["max_leaves"]:
                tree[r["node"]] = (features[r["f"]], r["b"], r["gain"])
                frontier += [2 * r["node"], 2 * r["node"] + 1]
                leaves += 1
            else:
                tree[r["node"]] = p["learning_rate"] * (r["g"] / UNIT) / (r["h"] / UNIT + p["l2"])
        if not frontier:
            break
    return tree


def _adder(tree: Mapping, order: Mapping[str, int]):
    """A function that adds the value of ``tree``, over bins, to a candidate's score."""

    def add(x: Column) -> Column:
        value = _route(tree, 1, lambda f, b: F.get(x["bins"], F.lit(order[f])) > F.lit(int(b)), lambda n: F.lit(float(tree[n])))
        return x.withField("score", x["score"] + value)

    return add


def mean_ap(groups: DataFrame, k: int) -> float:
    row = groups.select(average_precision(_order(F.col("c")), k).alias("ap")).agg(F.sum("ap").alias("s"), F.count("ap").alias("n")).first()
    return (row["s"] or 0) / UNIT / row["n"] if row["n"] else 0.0


def train(
    frame: DataFrame, target: str, features: Sequence[str] | None = None, valid_fold: int = 0, params: Mapping | None = None
) -> RankModel:
    """Boost trees on the users outside ``valid_fold``; the curve is MAP@k of the users in it after each round.

    Each round is written as a table in the shared folder and the one before it removed, so a lost executor costs
    one round at most.
    """
    p = {**DEFAULTS, **(params or {})}
    unknown = set(p) - set(DEFAULTS)
    if unknown:
        raise ValueError(f"unknown parameters: {sorted(unknown)}")
    spark = frame.sparkSession
    feats = list(features or [c for c in FEATURES if c in frame.columns])
    fitted = F.col("fold") != valid_fold
    cuts = thresholds(frame.where(fitted), feats, p["bins"])
    order = {f: i for i, f in enumerate(feats)}
    model = RankModel(feats)
    name = f"rank-{spark.sparkContext.applicationId}-{id(model):x}"
    groups, before = sinks.write_table(grouped(frame, target, cuts), f"{name}/start"), None
    best, best_round, last = -1.0, 0, f"{name}/start"
    for t in range(p["rounds"]):
        now = f"{name}/{t}"
        stepped = sinks.write_table(with_gradients(groups, p["k"], p["sigma"]), now)
        sinks.drop_table(spark, last)
        rows = stepped.where(fitted).select(F.explode(F.arrays_zip("c", "d")).alias("z")).select("z.c.bins", "z.d.g", "z.d.h").where("h > 0")
        tree = grow_tree(rows, feats, p)
        if not tree:  # no user of the training folds has both kinds of candidates
            before = now
            break
        model.trees.append({n: (x[0], cuts[x[0]][x[1]], x[2]) if isinstance(x, tuple) else x for n, x in tree.items()})
        groups = stepped.select("user", "fold", F.transform("c", _adder(tree, order)).alias("c"))
        model.curve.append(mean_ap(groups.where(~fitted), p["k"]))
        last = before = now
        if model.curve[-1] > best:
            best, best_round = model.curve[-1], t
        elif t - best_round >= p["patience"]:
            break
    if before:
        sinks.drop_table(spark, before)
    return model


def train_folds(frame: DataFrame, target: str, num_avg: int, features: Sequence[str] | None = None, params: Mapping | None = None) -> list[RankModel]:
    """``num_avg`` models; model ``f`` is validated on fold ``f``."""
    return [train(frame, target, features, f, params) for f in range(num_avg)]


# --- curves ------------------------------------------------------------------
def curve(model: RankModel, frame: DataFrame, target: str, k: int = 20) -> DataFrame:
    """(round, n_users, map) for every round of ``model``, from one pass over ``frame``.

    Each row carries its running sums over the trees; a user's candidates are ordered once a round.
    """
    values = F.array(*[tree_value(t) for t in model.trees])
    running = F.aggregate(values, F.array().cast("array<double>"), lambda a, x: F.concat(a, F.array(F.when(F.size(a) == 0, x).otherwise(F.try_element_at(a, F.lit(-1)) + x))))
    one = F.struct("item", _tie(F.col("origOrder")).alias("tie"), F.col(target).cast("int").alias("y"), running.alias("sums"))
    users = frame.groupBy("user").agg(F.collect_list(one).alias("c"))
    rounds = users.select("c", F.explode(F.sequence(F.lit(0), F.lit(len(model.trees) - 1))).alias("t"))
    at = F.transform("c", lambda x: F.struct(x["item"].alias("item"), x["tie"].alias("tie"), x["y"].alias("y"), F.get(x["sums"], F.col("t")).alias("score")))
    scored = rounds.select((F.col("t") + 1).alias("round"), average_precision(_order(at), k).alias("ap"))
    total = scored.groupBy("round").agg(F.count("ap").alias("n_users"), F.sum("ap").alias("s")).where("n_users > 0")
    mean = F.col("s").cast("double") / F.col("n_users").cast("double") / F.lit(float(UNIT))
    return total.select("round", "n_users", mean.alias("map"))


def last_mean(values: Sequence[float], n: int = 20) -> float:
    """Mean of the last ``n`` values of a curve; 0 for an empty one."""
    tail = list(values)[-n:]
    return sum(tail) / len(tail) if tail else 0.0
