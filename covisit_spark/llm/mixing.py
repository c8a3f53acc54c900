"""Mixing sources to target weights: iterative proportional fitting of token weights, then sampling.

Documents are counted into cells of source, language and topic. The cells' token weights are raked in
turn to the target share of each source, language and topic until no share moves; a cell's
weight over its tokens, times one constant, is the probability with which each of its documents is
kept, at most one. The constant makes the expected number of tokens ``keep_fraction`` of all. Draws are hashes
of id and text, so a run can be repeated.

Only cells are raked; their number is that of the combinations, not of documents. The topic of a text is the
group, of ``TOPICS`` by hash, that most of its longer words fall into.

Defined results: null source or language are a category of their own; null and empty texts have no
tokens and topic -1, and their cells are kept with probability ``keep_fraction``; repeated rows are drawn
alike; targets of categories that do not occur are left out and the others scaled up.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from covisit_spark.llm.common import small_batches, stage, words

TOPICS, LONG_WORD = 8, 6
DIMENSIONS = ["mix_source", "mix_lang", "mix_topic"]
ADDED = ["n_tokens", "topic", "probability", "sampled"]
NONE = "(none)"


def annotate(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``docs`` as fields of ``given``, with n_tokens, the three dimensions, and the draw in [0, 1)."""
    small_batches(docs.sparkSession)
    text = F.col("text")
    held = docs.select(
        F.struct(*[F.col(c) for c in keep]).alias("given"),
        F.coalesce("source", F.lit(NONE)).alias("mix_source"),
        F.coalesce("lang", F.lit(NONE)).alias("mix_lang"),
        (F.pmod(F.xxhash64(F.lit(4), "doc_id", text), F.lit(1 << 30)) / float(1 << 30)).alias("mix_draw"),
        F.transform(
            words(text), lambda w: F.when(F.length(w) >= LONG_WORD, F.pmod(F.xxhash64(w), F.lit(TOPICS))).otherwise(-1).cast("int")
        ).alias("mix_words"),
    )
    names = [f for f in held.schema.fields if f.name != "mix_words"]
    schema = T.StructType([*names, T.StructField("n_tokens", T.LongType()), T.StructField("mix_topic", T.IntegerType())])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        for b in batches:
            column = b.column(b.num_columns - 1)
            lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
            group = column.flatten().to_numpy(zero_copy_only=False)
            own = np.repeat(np.arange(len(lengths)), lengths)
            cells = np.bincount((own * TOPICS + group)[group >= 0], minlength=len(lengths) * TOPICS).reshape(-1, TOPICS)
            topic = np.where(cells.sum(1) > 0, cells.argmax(1) if len(cells) else 0, -1)
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(lengths, pa.int64()), pa.array(topic, pa.int32())], names=schema.names
            )

    return held.mapInArrow(run, schema)


def tempered(cells: DataFrame, dimension: str, power: float) -> DataFrame:
    """Target shares of a dimension: its token shares to the given power, scaled to one."""
    raised = cells.groupBy(dimension).agg(F.pow(F.sum("tokens"), F.lit(power)).alias("t"))
    total = raised.agg(F.sum("t").alias("all"))
    return raised.select(dimension, F.try_divide(F.col("t"), total.scalar()).alias("share"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], sweeps: int = 12, tolerance: float = 1e-6) -> DataFrame:
    """``cells`` with ``weight``: tokens scaled until the shares of every dimension are the targets.

    ``targets`` has (dimension, share) for each dimension. Each round of two sweeps is written as a table.
    """
    now = cells.withColumn("weight", F.col("tokens").cast("double"))
    for d, t in targets.items():
        now = now.join(t.select(d, F.col("share").alias(f"goal_{d}")), d, "left")
    goals = {d: F.coalesce(f"goal_{d}", F.lit(0.0)) for d in targets}
    now = stage(now.select(*cells.columns, "weight", *[g.alias(f"goal_{d}") for d, g in goals.items()]), "mix-cells")
    for _ in range(0, sweeps, 2):
        start = now.withColumn("before", F.col("weight"))
        for d in [*targets, *targets]:
            sums = F.sum("weight").over(Window.partitionBy(d))
            start = start.withColumn("weight", F.when(sums > 0, F.col("weight") * F.col(f"goal_{d}") / sums).otherwise(0.0))
        done = stage(start, "mix-cells")
        r = done.agg(F.sum("weight").alias("w"), F.sum("before").alias("b")).first()
        moved = F.max(F.abs(F.col("weight") / F.lit(r["w"] or 1.0) - F.col("before") / F.lit(r["b"] or 1.0)))
        now, change = done.drop("before"), done.agg(moved).first()[0] or 0.0
        if change < tolerance:
            break
    return now


def probabilities(raked: DataFrame, keep_fraction: float) -> DataFrame:
    """``raked`` cells with ``probability``: min(1, c x weight / tokens), c so that the expected tokens are the wanted ones.

    Cells at probability one are set aside and c is found anew, until no further cell reaches one.
    """
    rate = F.try_divide(F.col("weight"), F.col("tokens"))
    full = raked.where("tokens > 0")
    r = full.agg(F.sum("tokens").alias("n"), F.sum("weight").alias("w")).first()
    wanted, c = keep_fraction * (r["n"] or 0), 0.0
    if r["w"]:
        c = wanted / r["w"]
    for _ in range(50):
        over = rate * F.lit(c) >= 1
        s = full.agg(
            F.sum(F.when(over, F.col("tokens"))).alias("n"), F.sum(F.when(~over, F.col("weight"))).alias("w")
        ).first()
        if not s["n"] or not s["w"]:
            break
        better = (wanted - s["n"]) / s["w"]
        if better <= c * (1 + 1e-12):
            break
        c = better
    p = F.when(F.col("tokens") > 0, F.least(F.lit(1.0), rate * F.lit(c))).otherwise(F.lit(keep_fraction))
    return raked.withColumn("probability", p)


def mix(
    docs: DataFrame,
    keep: list[str],
    targets: dict[str, DataFrame] | None = None,
    power: float = 0.7,
    keep_fraction: float = 0.5,
) -> DataFrame:
    """The columns ``keep`` of ``docs`` with n_tokens, topic, ``probability`` and ``sampled``, over all rows.

    Columns of ``keep`` with one of these four names are replaced; other names clash with nothing. ``targets`` gives (category, share) per dimension; by default token shares to the power ``power``.
    """
    held = stage(annotate(docs, keep), "mix-documents")
    cells = stage(held.groupBy(*DIMENSIONS).agg(F.sum("n_tokens").alias("tokens")), "mix-cells")
    goals = targets or {d: tempered(cells, d, power) for d in DIMENSIONS}
    placed = stage(probabilities(rake(cells, goals), keep_fraction).select(*DIMENSIONS, "probability"), "mix-probabilities")
    out = held.join(placed, DIMENSIONS)
    kept: list[Column] = [F.col("given")[c].alias(c) for c in keep if c not in ADDED]
    return out.select(
        *kept, "n_tokens", F.col("mix_topic").alias("topic"), "probability", (F.col("mix_draw") < F.col("probability")).alias("sampled")
    )
