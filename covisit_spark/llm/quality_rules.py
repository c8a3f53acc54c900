"""Quality rules: a learned decision list over statistics of whole texts.

The statistics are built-in column expressions. Sequential covering learns, from labelled
documents, an ordered list of threshold conjunctions that mark bad documents: each rule is grown by
the literal of the best information gain on one part of the labelled rows and cut back to its best
prefix on the other part; a rule that is not precise enough there ends the list. The list becomes one
``CASE WHEN`` expression. Learning runs as small aggregate jobs over the table of statistics.

Defined results: a null, empty or blank text has no words and fails the base rules; rows with a null
``doc_id`` are judged like others but never learned from; repeated rows are judged each; with no
labelled rows, or labels of one kind, the list is empty and only the base rules decide.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covisit_spark.llm.common import bounded_sample, labelled, stage, words

# A blank line has only these characters; symbols that are counted.
WORD_CHAR = "[^\\x20\\x09-\\x0D]"
NOT_SYMBOL = "[^#*$%&|<>]+"
WINDOW = 5

FEATURES = {
    "f_words": lambda: F.col("n_words").cast("double"),
    "f_word_chars": lambda: _share("word_chars", "n_words"),
    "f_symbols": lambda: _share("n_symbols", "n_words"),
    "f_upper": lambda: _share("n_upper", "word_chars"),
    "f_marks": lambda: _share("n_marks", "n_words"),
    "f_dup_lines": lambda: _share("n_dup_lines", "n_lines"),
    "f_repeats": lambda: _share("n_repeat_words", "n_words"),
    "f_line_words": lambda: _share("n_words", "n_lines"),
}


@dataclass(frozen=True)
class Literal:
    """One threshold test: ``feature >= value`` or ``feature <= value``."""

    feature: str
    at_least: bool
    value: float

    def column(self) -> Column:
        c = F.col(self.feature)
        return c >= F.lit(self.value) if self.at_least else c <= F.lit(self.value)

    def text(self) -> str:
        return f"{self.feature[2:]} {'>=' if self.at_least else '<='} {self.value:.4g}"


def _share(part: str, whole: str) -> Column:
    return F.when(F.col(whole) > 0, F.col(part).cast("double") / F.col(whole)).otherwise(F.lit(0.0))


def _repeat_words(windows: Column) -> Column:
    """Words inside windows that occur twice or more, from the hashes of the windows in order.

    Sorting (hash, position) puts equal windows side by side; their positions in order are then
    walked once, each adding the words that the one before does not cover.
    """
    pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def among(s: Column) -> Column:
        twice = F.filter(
            s,
            lambda x, i: x["h"].eqNullSafe(F.get(s, i - 1)["h"]) | x["h"].eqNullSafe(F.get(s, i + 1)["h"]),
        )
        return F.sort_array(F.transform(twice, lambda x: x["i"]))

    # a one-element array binds the sorted pairs once, instead of once per use
    positions = F.transform(F.array(pairs), among)[0]
    start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(
        positions,
        start,
        lambda acc, p: F.struct(
            p.alias("last"), (acc["n"] + F.least(F.lit(WINDOW), p - acc["last"])).cast("long").alias("n")
        ),
        lambda acc: acc["n"],
    )


def text_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_upper, n_marks)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select("doc_id", text.alias("text"))
    split = base.select(
        "doc_id",
        "text",
        words(F.col("text")).alias("w"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD_CHAR)).alias("lines"),
    )
    hashed = split.select(
        "doc_id",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", NOT_SYMBOL, "")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("lines").cast("long").alias("n_lines"),
        F.length(F.regexp_replace("text", "[^A-Z]+", "")).cast("long").alias("n_upper"),
        F.length(F.regexp_replace("text", "[^!?]+", "")).cast("long").alias("n_marks"),
        F.transform("w", lambda x: F.xxhash64(x)).alias("h"),
    )
    h = F.col("h")
    windows = F.when(
        F.size(h) >= WINDOW,
        F.transform(
            F.sequence(F.lit(0), F.size(h) - WINDOW),
            lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    wide = hashed.withColumn("win", windows).drop("h")
    repeated = F.when(
        F.size(F.array_distinct("win")) < F.size("win"), _repeat_words(F.col("win"))
    ).otherwise(F.lit(0).cast("long"))
    return wide.withColumn("n_repeat_words", repeated).drop("win")


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)


def with_features(stats: DataFrame) -> DataFrame:
    return stats.select("*", *[make().alias(name) for name, make in FEATURES.items()])


def _counts(rows: DataFrame, columns: list[Column]) -> list[tuple[int, int]]:
    """(bad, good) rows under each of a few conditions, in one aggregate."""
    sums = []
    for k, c in enumerate(columns):
        for y in (0, 1):
            sums.append(F.coalesce(F.sum(F.when(c & (F.col("y") == y), 1)), F.lit(0)).alias(f"c{k}_{y}"))
    r = rows.agg(*sums).first()
    return [(r[f"c{k}_0"], r[f"c{k}_1"]) for k in range(len(columns))]


def _cuts(rows: DataFrame, bins: int) -> dict[str, list[float]]:
    """Thresholds per feature: quantiles of the bad and of the good rows."""
    shares = [k / bins for k in range(1, bins)] + [0.99, 0.01]
    got = rows.groupBy("y").agg(*[F.percentile_approx(f, shares, 10_000).alias(f) for f in FEATURES]).collect()
    return {f: sorted({v for r in got for v in r[f] or []}) for f in FEATURES}


def _best_literal(rows: DataFrame, cuts: dict[str, list[float]]) -> tuple[Literal | None, int, int]:
    """The literal of the highest gain on ``rows``: one job over (feature, bin) counts, bins x features rows."""
    entries = []
    for f, values in cuts.items():
        edges = F.array(*[F.lit(float(v)) for v in values])
        # a value's bin: how many thresholds it reaches, and how many it exceeds
        c = F.col(f)
        reach = F.size(F.filter(edges, lambda v: c >= v))  # noqa: B023 - used at once
        exceed = F.size(F.filter(edges, lambda v: c > v))  # noqa: B023
        entries.append(F.struct(F.lit(f).alias("f"), reach.alias("reach"), exceed.alias("exceed")))
    cells = (
        rows.select("y", F.explode(F.array(*entries)).alias("e"))
        .groupBy("e.f", "e.reach", "e.exceed")
        .agg(F.sum(1 - F.col("y")).alias("bad"), F.sum("y").alias("good"))
        .collect()
    )
    bad = sum(r["bad"] for r in cells if r["f"] == next(iter(cuts)))
    good = sum(r["good"] for r in cells if r["f"] == next(iter(cuts)))
    if not bad or not good:
        return None, bad, good
    before, best, best_gain = math.log2(bad / (bad + good)), None, 0.0
    for f, values in cuts.items():
        own = [r for r in cells if r["f"] == f]
        for k, v in enumerate(values):
            for at_least in (True, False):
                hit = [r for r in own if (r["reach"] > k if at_least else r["exceed"] <= k)]
                b, g = sum(r["bad"] for r in hit), sum(r["good"] for r in hit)
                if b and (gain := b * (math.log2(b / (b + g)) - before)) > best_gain + 1e-9:
                    best, best_gain = Literal(f, at_least, float(v)), gain
    return best, bad, good


def all_of(rule: list[Literal]) -> Column:
    c = rule[0].column()
    for x in rule[1:]:
        c = c & x.column()
    return c


def learn_rules(
    train: DataFrame,
    max_rules: int = 6,
    max_literals: int = 3,
    min_precision: float = 0.9,
    bins: int = 20,
) -> list[list[Literal]]:
    """Ordered rules that mark bad rows of ``train`` (features and ``y``: 1 good, 0 bad).

    One third of the rows, by a hash of the id, prunes; the others grow.
    """
    part = F.pmod(F.xxhash64(F.lit(17), F.col("doc_id")), F.lit(3))
    grow, prune = train.where(part != 0), train.where(part == 0)
    cuts = {f: v for f, v in _cuts(train, bins).items() if v}
    rules: list[list[Literal]] = []
    while cuts and len(rules) < max_rules:
        rule: list[Literal] = []
        left = grow
        while len(rule) < max_literals:
            literal, _, good = _best_literal(left, cuts)
            if literal is None or not good:
                break
            rule.append(literal)
            left = left.where(literal.column())
        if not rule:
            break
        found = _counts(prune, [all_of(rule[: k + 1]) for k in range(len(rule))])
        score = [(b - g) / (b + g) if b + g else -1.0 for b, g in found]
        keep = max(range(len(rule)), key=lambda k: (score[k], -k))
        b, g = found[keep]
        if not b or b / (b + g) < min_precision:
            break
        rules.append(rule[: keep + 1])
        covered = all_of(rules[-1])
        grow, prune = grow.where(~covered), prune.where(~covered)
    return rules


def verdict(rules: list[list[Literal]]) -> Column:
    """The decision list as one expression: the text of the first rule that holds, else null."""
    c = F.lit(None).cast("string")
    for k in reversed(range(len(rules))):
        c = F.when(all_of(rules[k]), F.lit(" and ".join(x.text() for x in rules[k]))).otherwise(c)
    return c


def judge(docs: DataFrame, labels: DataFrame, max_train_rows: int = 200_000, **learn) -> DataFrame:
    """Statistics, base rules and the learned list over every document.

    ``max_train_rows`` bounds the labelled rows that the list is learned from. Returns the columns
    of ``text_statistics`` with ``base_failed``, ``rule`` (null if none holds) and ``kept``.
    """
    stats = stage(with_features(text_statistics(docs)), "quality-stats")
    train = bounded_sample(labelled(labels, "quality"), max_train_rows).join(
        stats.where(F.col("doc_id").isNotNull()), "doc_id"
    )
    train = stage(train.where(~base_failed()), "quality-train")
    rules = learn_rules(train, **learn)
    out = stats.withColumn("base_failed", base_failed()).withColumn("rule", verdict(rules))
    return out.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
