"""Merkle dataset manifest: a content-addressed store of digest-to-children records and its descent.

Every row is a leaf; per source the leaves in order of document id are the base of a tree whose nodes hash
runs of ``FAN`` digests, and the subroots in order of source are the base of one more tree. The store keeps, level
by level, one record for each digest with the digests under it. Proofs come from the store alone: all
leaf requests start at the root and go down by the base-``FAN`` digits of their rank; a record met
gives the child that the digit names and, as a segment of the path, the children that it does not. Requests
that share a prefix of digits travel as one row, so a level costs one join of as many rows as it has nodes. The
segments, top first, are reversed for the proof.

Ranks come from one range sort: a row's place in its part plus what earlier parts hold of its source, so
a source of any size is ranked by all tasks. ``SPAN_LEVELS`` levels are hashed in one shuffle, from groups of
``FAN ** SPAN_LEVELS`` digests at most.

Defined results: nulls are hashed as ``-`` and come first in every order; a repeated row is a leaf of its own (rows with
one id are ordered by their digests); texts may be empty or of any length; an empty table has no rows;
without an id a row is not tampered with; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from covisit_spark.llm.common import small_batches, stage

FAN = 3
SPAN_LEVELS = 6
HEX = 64
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def digest(text: Column) -> Column:
    """Lowercase hex sha256."""
    return F.sha2(text.cast("binary"), 256)


def _field(value: Column) -> Column:
    s = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def leaf(text: Column) -> Column:
    """The leaf digest of a row that has ``text`` in its place of the text."""
    return digest(F.concat(*[_field(text if c == "text" else F.col(c)) for c in FIELDS]))


def tampered(doc_id: Column, text: Column) -> Column:
    """The text without its line ends where 2 divides the id's crc32, else as it is."""
    hit = F.crc32(doc_id.cast("string").cast("binary")) % 2 == 0
    return F.when(hit, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)


def ranked(df: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """``df`` with ``idx``, the place from 0 of each row in its group (nulls first), written as a table.

    ``order`` must tell all rows apart. No task holds more than a part of the range sort, however large a group is.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c).asc_nulls_first() for c in [*group, *order]]
    placed = df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id())
    placed = stage(placed, name).withColumn("_part", F.shiftright("_at", 33))
    same = [F.struct(*[F.col(c) for c in group]).alias("_group")] if group else [F.lit(0).alias("_group")]
    held = placed.select("_part", "_at", *same).groupBy("_part", "_group").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    # one row a part and group in it: a group is in consecutive parts, so this has parts + groups rows at most
    w = Window.partitionBy("_group").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = held.select("_part", "_group", "_first", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_before"))
    before = before.withColumnRenamed("_part", "_p").withColumnRenamed("_group", "_g")
    keyed = placed.withColumn("_group", same[0])
    joined = keyed.join(before, (F.col("_part") == F.col("_p")) & F.col("_group").eqNullSafe(F.col("_g")))
    return joined.select(*df.columns, (F.col("_at") - F.col("_first") + F.col("_before")).alias("idx"))


def _hash_groups(batches: Iterator) -> Iterator:
    """Nodes over each group's sorted digests: up to ``SPAN_LEVELS`` levels, while its tree has several nodes."""
    import pyarrow as pa

    for b in batches:
        out = {"tree": [], "count": [], "level": [], "idx": [], "digest": [], "children": []}
        for tree, g, count, run in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True):
            # a tree with one node has ended: it is its own root
            rows = [(0, 0, run[0], None)] if count == 1 else []
            here, left = run, count
            for level in range(1, SPAN_LEVELS + 1):
                if left == 1:
                    break
                under = ["".join(here[i : i + FAN]) for i in range(0, len(here), FAN)]
                here = [hashlib.sha256(c.encode()).hexdigest() for c in under]
                first = g * FAN ** (SPAN_LEVELS - level)
                rows += [(level, first + i, d, c) for i, (d, c) in enumerate(zip(here, under, strict=True))]
                left = -(-left // FAN)
            for level, idx, d, c in rows:
                for name, value in zip(out, (tree, count, level, idx, d, c), strict=True):
                    out[name].append(value)
        types = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.string())
        yield pa.RecordBatch.from_pydict(out, pa.schema(list(zip(out, types, strict=True))))


def build(leaves: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """(store, roots) of the trees over ``leaves`` (tree, idx, digest).

    ``store`` is (level, digest, children), ``children`` being the digests under a node one after the other;
    ``roots`` is (tree, digest, height), the height of a lone leaf being 0.
    """
    span = FAN**SPAN_LEVELS
    small_batches(leaves.sparkSession)
    base, low, stores, roots = leaves.select("tree", "idx", "digest"), 0, [], []
    sizes = stage(base.groupBy("tree").agg(F.count("*").alias("count")), f"{name}-sizes")
    while not sizes.isEmpty():
        groups = (
            base.groupBy("tree", F.floor(F.col("idx") / span).alias("g"))
            .agg(F.array_sort(F.collect_list(F.struct("idx", "digest"))).alias("run"))
            .join(sizes, "tree")
            .select("tree", "g", "count", "run.digest")
        )
        schema = "tree long, count long, level int, idx long, digest string, children string"
        made = stage(groups.mapInArrow(_hash_groups, schema), f"{name}-nodes", by="level")
        stores.append(made.where("level > 0").select((F.col("level") + low).alias("level"), "digest", "children"))
        # a tree ends at its only level of one node: the least with FAN ** level leaves or more
        height = F.lit(SPAN_LEVELS + 1)
        for k in range(SPAN_LEVELS, -1, -1):
            height = F.when(F.col("count") <= FAN**k, F.lit(k)).otherwise(height)
        roots.append(made.where(F.col("level") == height).select("tree", "digest", (F.col("level") + low).alias("height")))
        base = made.where((F.col("level") == SPAN_LEVELS) & (F.col("count") > span)).select("tree", "idx", "digest")
        sizes = sizes.where(F.col("count") > span).select("tree", F.ceil(F.col("count") / span).alias("count"))
        low += SPAN_LEVELS
    store = reduce(DataFrame.unionByName, stores) if stores else _none(leaves, "level int, digest string, children string")
    return store, stage(reduce(DataFrame.unionByName, roots) if roots else _none(leaves, "tree long, digest string, height int"), f"{name}-roots")


def _none(like: DataFrame, schema: str) -> DataFrame:
    return like.sparkSession.createDataFrame([], schema)


def _segment() -> Column:
    """The children that ``digit`` does not name, before and after the one that it names."""
    return F.struct(
        F.expr(f"substring(children, 1, digit * {HEX})").alias("left"),
        F.expr(f"substring(children, digit * {HEX} + {HEX} + 1)").alias("right"),
    )


def descend(store: DataFrame, starts: DataFrame, name: str) -> DataFrame:
    """(tree, run, children, path) of the lowest nodes under ``starts`` (tree, digest, height, path).

    ``path`` holds a (left, right) segment for each level passed, top first: the siblings before and after the
    child taken. A start of height 0 is a leaf already and comes back with null children.
    """
    begin = starts.select("tree", F.lit(0).cast("long").alias("idx"), "digest", "path", "height")
    lone = begin.where("height = 0").select("tree", F.col("idx").alias("run"), F.lit(None).cast("string").alias("children"), "path")
    highest = starts.agg(F.max("height")).first()[0] or 0
    front = None
    for level in range(highest, 0, -1):
        at = begin.where(F.col("height") == level).drop("height")
        front = at if front is None else front.unionByName(at)
        # equal nodes, which only repeated rows make, are one record
        same = Window.partitionBy("digest").orderBy("digest")
        records = store.where(F.col("level") == level).select("digest", "children", F.row_number().over(same).alias("k")).where("k = 1")
        met = front.join(records.drop("k"), "digest")
        if level == 1:
            lone = met.select("tree", F.col("idx").alias("run"), "children", "path").unionByName(lone)
            break
        digits = F.sequence(F.lit(0), (F.length("children") / HEX).cast("int") - 1)
        taken = met.select("tree", "idx", "children", "path", F.explode(digits).alias("digit"))
        front = taken.select(
            "tree",
            (F.col("idx") * FAN + F.col("digit")).alias("idx"),
            F.expr(f"substring(children, digit * {HEX} + 1, {HEX})").alias("digest"),
            F.concat("path", F.array(_segment())).alias("path"),
        )
        if (highest - level) % SPAN_LEVELS == SPAN_LEVELS - 1:
            front = stage(front, f"{name}-front")
    return lone


def paths(requests: DataFrame, nodes: DataFrame) -> DataFrame:
    """``requests``, with (tree, idx), and their whole ``path``: the last digit picks the leaf in its run."""
    at = requests.withColumn("run", F.floor(F.col("idx") / FAN)).withColumn("digit", (F.col("idx") % FAN).cast("int"))
    met = at.join(nodes, ["tree", "run"])
    whole = F.when(F.col("children").isNull(), F.col("path")).otherwise(F.concat("path", F.array(_segment())))
    return met.select(*requests.columns, whole.alias("path"))


def manifest(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row of ``docs``."""
    text = F.col("text")
    rows = docs.select(*FIELDS)
    leaves = rows.select("doc_id", "source", leaf(text).alias("leaf"), leaf(tampered(F.col("doc_id"), text)).alias("folded"))
    # a number for each row, so that the range sort can split rows that are equal
    leaves = stage(leaves.withColumn("row_no", F.monotonically_increasing_id()), "leaves")
    placed = ranked(leaves, ["source"], ["doc_id", "leaf", "row_no"], "ranked-leaves")
    sources = ranked(leaves.select("source").distinct(), [], ["source"], "ranked-sources").select("source", F.col("idx").alias("tree"))
    sources = stage(sources, "trees").withColumnRenamed("source", "_source")
    placed = stage(
        placed.join(sources, F.col("source").eqNullSafe(F.col("_source"))).select("tree", "idx", "doc_id", "leaf", "folded"), "placed"
    )
    store, subroots = build(placed.select("tree", "idx", F.col("leaf").alias("digest")), "merkle")
    top = subroots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("idx"), "digest", "height")
    top_store, root = build(top, "merkle-top")
    nowhere = F.array().cast("array<struct<left:string,right:string>>")
    reached = paths(top, descend(top_store, root.withColumn("path", nowhere), "merkle-top"))
    starts = stage(reached.select(F.col("idx").alias("tree"), "digest", "height", "path"), "starts")
    asked = paths(placed, descend(store, starts, "merkle")).join(starts.select("tree", F.col("digest").alias("subroot")), "tree")
    upward = F.reverse("path")
    proof = F.array_join(F.transform(upward, lambda s: F.concat(s["left"], s["right"])), "")
    folded = F.aggregate(upward, F.col("folded"), lambda under, s: digest(F.concat(s["left"], under, s["right"])))
    out = asked.withColumn("root", root.select("digest").scalar())
    return out.select(
        "doc_id", "leaf", "subroot", "root", digest(proof).alias("proof_sha256"), folded.alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
