"""The list-wise ranker: gradients against brute force, trees on a separable case, stored models, curves."""

import math
import random

import pytest
from pyspark.sql import functions as F

from covisit_spark.operators import lambdarank as lr
from covisit_spark.operators import ranker as rk


def ap(labels, k):
    hits = total = 0
    for r, y in enumerate(labels, 1):
        hits += y
        if y and r <= k:
            total += hits / r
    return total / min(sum(labels), k)


def brute_gradients(cands, k, sigma):
    """Swap every pair of unlike labels and measure the change."""
    order = sorted(cands, key=lambda c: (-c["score"], c["tie"], c["item"]))
    labels = [c["y"] for c in order]
    out = {c["item"]: [0.0, 0.0] for c in order}
    for i, p in enumerate(order):
        for j, n in enumerate(order):
            if p["y"] == 1 and n["y"] == 0:
                other = labels[:]
                other[i], other[j] = 0, 1
                weight = abs(ap(labels, k) - ap(other, k))
                rho = 1 / (1 + math.exp(sigma * (p["score"] - n["score"])))
                for item, sign in ((p["item"], 1), (n["item"], -1)):
                    out[item][0] += sign * sigma * weight * rho
                    out[item][1] += sigma * sigma * weight * rho * (1 - rho)
    return out


def groups_of(seed, users=12):
    rnd = random.Random(seed)
    rows = []
    for u in range(users):
        n = rnd.choice([1, 2, 5, 20, 50])
        rows.append((u, 0, [(i, rnd.choice([1, 2, 3]), int(rnd.random() < [0, 0.1, 0.5, 1][u % 4]), [0], rnd.choice([0.0, 0.5, -0.25, rnd.random()])) for i in range(n)]))
    return rows


SCHEMA = "user long, fold int, c array<struct<item:int,tie:int,y:int,bins:array<int>,score:double>>"


@pytest.mark.parametrize("k", [3, 20])
def test_gradients_equal_brute_force(spark, k):
    rows = groups_of(k)
    for r in lr.with_gradients(spark.createDataFrame(rows, SCHEMA), k, 1.5).collect():
        want = brute_gradients([c.asDict() for c in r["c"]], k, 1.5)
        for c, d in zip(r["c"], r["d"], strict=True):
            assert d["g"] / lr.UNIT == pytest.approx(want[c["item"]][0], abs=1e-6)
            assert d["h"] / lr.UNIT == pytest.approx(want[c["item"]][1], abs=1e-6)


def test_average_precision(spark):
    rows = groups_of(5)
    df = spark.createDataFrame(rows, SCHEMA)
    for r in df.select("c", lr.average_precision(lr._order(F.col("c")), 7).alias("ap")).collect():
        labels = [c["y"] for c in sorted(r["c"], key=lambda c: (-c["score"], c["tie"], c["item"]))]
        assert (r["ap"] is None) if not sum(labels) else r["ap"] / lr.UNIT == pytest.approx(ap(labels, 7), abs=1e-7)


def frame_of(spark, users=60, n=12, seed=0):
    """The positive is the candidate with the most ``x`` of its user, whatever the user's level and the list order."""
    rnd = random.Random(seed)
    rows = []
    for u in range(users):
        level = rnd.choice([0, 50])
        xs = [rnd.random() for _ in range(n)]
        best = max(range(n), key=lambda i: xs[i])
        for i, x in enumerate(xs):
            rows.append((u, i, i + 1, 20 * x + level * 0, float(rnd.random()), int(i == best), u % 5))
    return spark.createDataFrame(rows, "user long, item int, origOrder int, x double, noise double, carts int, fold int")


PARAMS = {"rounds": 8, "max_depth": 2, "min_rows": 5, "learning_rate": 0.3, "patience": 3}


@pytest.fixture(scope="module")
def fitted(spark):
    frame = frame_of(spark).cache()
    return frame, lr.train(frame, "carts", ["x", "noise"], 0, PARAMS)


def test_beats_the_given_order_and_the_pointwise_model(spark, fitted):
    frame, model = fitted
    held = frame.where("fold = 0")
    mean = lambda df: rk.map_at_k(rk.rank_top(df, 20), held, "carts", 20).first()["map"]
    listwise = mean(lr.score([model], held))
    point = rk.train_ranker(frame, "carts", ["x", "noise"], 0, {"maxIter": 8, "maxDepth": 2, "minInstancesPerNode": 5})
    assert listwise > mean(held.withColumn("score", -F.col("origOrder"))) + 0.2
    assert listwise >= mean(rk.score([point], held))
    assert model.importance()[0][0] == "x" and sum(g for _, g in model.importance()) == pytest.approx(1.0)


def test_curve_is_the_training_curve_and_map_of_each_prefix(spark, fitted):
    frame, model = fitted
    held = frame.where("fold = 0")
    rows = {r["round"]: r["map"] for r in lr.curve(model, held, "carts", 20).collect()}
    assert [rows[t + 1] for t in range(len(model.trees))] == pytest.approx(model.curve)
    some = held.withColumn("score", lr.raw_score(model, 2))
    assert rows[2] == pytest.approx(rk.map_at_k(rk.rank_top(some, 20), held, "carts", 20).first()["map"], abs=1e-8)
    assert lr.last_mean(model.curve, 3) == pytest.approx(sum(model.curve[-3:]) / 3) and lr.last_mean([]) == 0.0


def test_training_does_not_depend_on_partitions(spark, fitted):
    frame, model = fitted
    again = lr.train(frame.repartition(7), "carts", ["x", "noise"], 0, {**PARAMS, "rounds": 2})
    assert again.trees == model.trees[:2]


def test_stops_after_rounds_without_gain(spark):
    frame = frame_of(spark, 20).withColumn("x", F.lit(1.0))
    model = lr.train(frame, "carts", ["x"], 0, {**PARAMS, "rounds": 30, "patience": 2})
    assert len(model.trees) == 3 and len(set(model.curve)) == 1


def test_stored_models_score_alike_in_another_session(spark, fitted, tmp_path):
    frame, model = fitted
    other = lr.RankModel(["x", "noise"], model.trees[:1], [0.5])
    for name, m in (("a", model), ("b", other)):
        lr.save_model(spark, m, f"{tmp_path}/{name}")
    fresh = spark.newSession()
    assert lr.load_model(fresh, f"{tmp_path}/a") == model
    a, b = (dict(lr.score([m], frame).select(F.struct("user", "item"), "score").collect()) for m in (model, other))
    both = lr.score_stored(spark, [f"{tmp_path}/a", f"{tmp_path}/b"], frame).select(F.struct("user", "item"), "score").collect()
    assert all(s == pytest.approx((a[k] + b[k]) / 2) for k, s in both)


def test_null_features_go_left_and_one_kind_of_label_gives_no_tree(spark):
    df = spark.createDataFrame([(None,), (1.0,), (3.0,)], "x double")
    assert [r[0] for r in df.select(lr.tree_value({1: ("x", 2.0, 1.0), 2: -1.0, 3: 1.0})).collect()] == [-1.0, -1.0, 1.0]
    assert lr.train(frame_of(spark, 10).withColumn("carts", F.lit(0)), "carts", ["x"], 0, PARAMS).trees == []
    with pytest.raises(ValueError, match="unknown"):
        lr.train(frame_of(spark, 2), "carts", ["x"], 0, {"depth": 3})
