"""Similarity links inside buckets, and connected groups, as DataFrame jobs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from covisit_spark.llm.common import discard, stage


def ordered_pairs(df: DataFrame, x: str, y: str) -> DataFrame:
    """Distinct (a, b) with a < b."""
    return (
        df.where(F.col(x) != F.col(y))
        .select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))
        .distinct()
    )


def _mark(edges: DataFrame) -> tuple[int, int]:
    r = edges.agg(F.count("*").alias("n"), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 40))).alias("h")).first()
    return r["n"], r["h"] or 0


def components(edges: DataFrame) -> DataFrame:
    """(id, component): the least id of the connected group of every id in ``edges`` (a, b).

    Alternating large-star and small-star steps; each round hooks nodes to the least neighbour known and is
    written as a table, so that a lost executor repeats one round at most. Ends when a round changes nothing.
    """
    now = stage(ordered_pairs(edges, "a", "b").select(F.col("b").alias("a"), F.col("a").alias("b")), "edges")
    mark = _mark(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        hooked = large.join(least, "a")
        small = (
            hooked.where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(hooked.select("a", F.col("m").alias("b")))
            .distinct()
        )
        before, was = mark, now
        now = stage(small, "edges")
        discard(was)
        mark = _mark(now)
        if mark == before:
            break
    ids = now.select(F.col("a").alias("id"), F.col("b").alias("component"))
    out = ids.unionByName(now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
    out.stage_path = now.stage_path
    return out


def linked(
    buckets: DataFrame,
    content: Callable[[DataFrame], DataFrame],
    same: Callable[[DataFrame, DataFrame], DataFrame],
    common: Callable[[DataFrame, DataFrame], DataFrame],
    size_ratio: float,
    may: Callable[[str, str], Column],
    first_share: int = 8,
    rounds: int = 1,
) -> DataFrame:
    """Pairs (a, b), verified or implied by verified ones, that connect all that pairs inside the buckets connect.

    ``buckets`` has (bucket, id), both longs; rows may repeat. ``content(ids)`` gives what ids are compared by, once for all ids
    that share a bucket; ``same(pairs, content)`` keeps the true ones of pairs (a, b). The two of a bucket of two are
    a pair, once however many buckets they share. In larger ones members are held
    against the leader of their bucket, the one that meets most others over all those buckets: first in one bucket
    of ``first_share``, then in the others where member and leader are not in one group yet. Where a bucket then still holds several
    groups, each member outside its largest group is held against every member of the others that can be similar to
    it: ``common(ids, content)`` gives (id, size, common, sketch), no id sharing more than its ``common`` with any other of
    ``ids``, what two share must be ``size_ratio`` of what they have together, and ``may("", "2")`` is false only of
    two whose columns, with these endings, tell that they are not similar. So no pair of
    a bucket is left out unless its two ends are connected already, and a bucket of copies of one text costs
    one pair a member.
    """
    # most buckets hold one id, however often: they go before anything else is counted
    own = Window.partitionBy("bucket")
    several = buckets.select("bucket", "id", F.min("id").over(own).alias("x"), F.max("id").over(own).alias("y")).where("x < y")
    met = stage(several.select("bucket", "id").distinct(), "met")
    counted = met.groupBy("bucket").agg(F.count("*").alias("n"), F.min("id").alias("a"), F.max("id").alias("b"))
    counted = stage(counted, "counted")
    held = stage(content(met.select("id").distinct()), "content")
    two = counted.where("n = 2").select("a", "b").distinct()
    shared = stage(met.join(counted.where("n > 2").select("bucket", "n"), "bucket"), "shared")
    discard(met)
    # the text that others are copies of meets more of them than a copy does; ties go to the least id
    weight = shared.groupBy("id").agg(F.sum("n").alias("met"))
    ranked = shared.join(weight, "id")
    most = ranked.groupBy("bucket").agg(F.max("met").alias("met"))
    heads = ranked.join(most, ["bucket", "met"]).groupBy("bucket").agg(F.min("id").alias("leader"))
    members = stage(shared.join(heads, "bucket"), "members")
    discard(shared)
    first = F.pmod(F.xxhash64(F.lit(1), "bucket"), F.lit(first_share)) == 0
    pairs = ordered_pairs(members.where(first), "id", "leader").unionByName(two).distinct()
    links = stage(same(pairs, held), "links")
    discard(counted)
    groups = components(links)
    # the groups known stand for the links that made them, so few rounds are left to do
    links = _stars(groups)
    apart = _open(members, groups)
    for k in range(rounds + 1):
        if k == 0:
            heads = apart.select("bucket", F.col("leader").alias("head")).distinct()
        else:  # another member of each bucket, the least under a mask
            mask = F.xxhash64(F.lit(k), "bucket")
            heads = apart.groupBy("bucket").agg(F.min(F.col("id").bitwiseXOR(mask)).alias("m"))
            heads = heads.select("bucket", F.col("m").bitwiseXOR(mask).alias("head"))
        of_head = apart.join(heads, "bucket").where(F.col("id") == F.col("head"))
        met = apart.join(of_head.select("bucket", "head", F.col("component").alias("of_head")), "bucket")
        more = stage(same(ordered_pairs(met.where(F.col("component") != F.col("of_head")), "id", "head"), held), "links")
        if not more.isEmpty():
            groups = components(links.unionByName(more))
            links = _stars(groups)
            apart = _open(apart.drop("component", "main"), groups)
    bounds = stage(common(apart.select("id").distinct(), held), "bounds")
    rest = apart.where(F.col("id") != F.col("leader")).join(bounds, "id")
    outside = rest.where(F.col("component") != F.col("main"))
    others = rest.select(
        "bucket",
        F.col("id").alias("id2"),
        F.col("size").alias("size2"),
        F.col("common").alias("common2"),
        F.col("sketch").alias("sketch2"),
        F.col("component").alias("component2"),
        (F.col("component") == F.col("main")).alias("in_main"),
    )
    shared = F.least("common", "common2")
    fits = shared >= size_ratio * (F.col("size") + F.col("size2") - shared) - 1e-9
    pairs = outside.join(others, "bucket").where(
        (F.col("component") != F.col("component2")) & (F.col("in_main") | (F.col("id") < F.col("id2"))) & fits & may("", "2")
    )
    out = stage(links.unionByName(same(ordered_pairs(pairs, "id", "id2"), held)), "linked")
    discard(members, held, apart, bounds)
    return out


def _stars(groups: DataFrame) -> DataFrame:
    """(a, b): the least id of each group and each other one."""
    return groups.where(F.col("id") != F.col("component")).select(F.col("component").alias("a"), F.col("id").alias("b"))


def _open(members: DataFrame, groups: DataFrame) -> DataFrame:
    """The members of buckets that hold several groups, with their ``component`` and the bucket's largest, ``main``."""
    placed = members.join(groups, "id", "left")
    placed = stage(placed.withColumn("component", F.coalesce("component", "id")), "placed")
    counted = placed.groupBy("bucket", "component").agg(F.count("*").alias("c"))
    mixed = (
        counted.groupBy("bucket")
        .agg(F.max(F.struct("c", "component"))["component"].alias("main"), F.count("*").alias("groups"))
        .where("groups > 1")
        .drop("groups")
    )
    return stage(placed.join(mixed, "bucket"), "open")
