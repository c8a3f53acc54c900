"""Secret scan: fixed patterns, and character Markov models for secrets without a keyword.

Two bigram models over one alphabet, one of random strings and one of ordinary identifiers, are
counted from labelled tokens: the values that the patterns find in all documents are random strings; of the
other tokens, those made up like words, identifiers and numbers are ordinary,
and the rest, which may be secrets, have no label. A token of 16 or more characters in any text whose mean
log-likelihood ratio passes a threshold is a further span. The models are counted from one half of the tokens
and the threshold, above nearly all ordinary ones, from the other. All of it is built-in column expressions.

Defined results: a null text is read as empty and has no spans; repeated rows are scanned each; with an
empty table, or texts without secrets, the random model is the uniform one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covisit_spark.llm.common import stage

# The patterns of the base kinds, in their order.
ASSIGN = "((?i:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]+"
ASSIGN_MIN, ACCESS_MIN, HEX_MIN = 12, 18, 16
KINDS = ["assign", "access", "hex", "markov"]

# a run that is too short for a kind holds no shorter start that is long enough, so the least
# length can stand in the pattern; not so for assign, where another keyword may follow inside
ACCESS_LONG = f"AKIA[A-Z0-9]{{{ACCESS_MIN - 4},}}"
HEX_LONG = f"[0-9a-f]{{{HEX_MIN},}}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
TOKEN_MIN = 16
TOKEN = f"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{TOKEN_MIN},}}+"
# Runs of letters with the case of words, and of digits that no letter follows.
ORDINARY = "^(?:[A-Z]?[a-z]{2,}+|[A-Z]{2,}+|[A-Za-z](?![A-Za-z])|[0-9]++(?![A-Za-z])|[+/_=-])++$"
SPAN = "array<struct<s:int,k:int,e:int>>"


def find_spans(text: Column, pattern: str, kind: int, keep=None, group: int = 0) -> Column:
    """Spans (s, k, e) of the matches of ``pattern``, in code points, end exclusive.

    The pieces between the matches and the matches themselves are walked together, adding lengths.
    ``keep(x)`` tests group ``group`` of each match.
    """
    found = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"),
    )
    none = F.array().cast(SPAN)
    walked = F.aggregate(
        F.filter(found, lambda x: x["hit"].isNotNull()),
        F.struct(F.lit(0).alias("at"), none.alias("out")),
        lambda acc, x: F.struct(
            (acc["at"] + F.length(x["gap"]) + F.length(x["hit"])).alias("at"),
            F.concat(
                acc["out"],
                F.when(
                    F.lit(True) if keep is None else keep(x["value"]),
                    F.array(
                        F.struct(
                            (acc["at"] + F.length(x["gap"])).alias("s"),
                            F.lit(kind).alias("k"),
                            (acc["at"] + F.length(x["gap"]) + F.length(x["hit"])).alias("e"),
                        )
                    ),
                ).otherwise(none),
            ).alias("out"),
        ),
        lambda acc: acc["out"],
    )
    return F.when(text.rlike(pattern), walked.cast(SPAN)).otherwise(none)


def base_spans(text: Column) -> list[Column]:
    return [
        find_spans(text, ASSIGN, 0, lambda v: F.length(v) >= ASSIGN_MIN, group=2),
        find_spans(text, ACCESS_LONG, 1),
        find_spans(text, HEX_LONG, 2),
    ]


def span_text(spans: Column) -> Column:
    """``kind:start:end`` by start, then kind, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            F.sort_array(spans),
            lambda x: F.concat_ws(":", F.get(names, x["k"]), x["s"].cast("string"), x["e"].cast("string")),
        ),
        ",",
    )


def labelled_tokens(docs: DataFrame) -> DataFrame:
    """(token, random, half): the distinct labelled tokens of all documents.

    Tokens that no pattern finds and that are not made up like ``ORDINARY`` ones are left out: secrets
    without a keyword are among them, and as ordinary tokens they would teach the models to pass them.
    """
    text = F.col("text")
    hits = F.concat(
        F.filter(F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2)), lambda v: F.length(v) >= ASSIGN_MIN),
        F.regexp_extract_all(text, F.lit(ACCESS_LONG), F.lit(0)),
        F.regexp_extract_all(text, F.lit(HEX_LONG), F.lit(0)),
    )
    rest = F.regexp_extract_all(text, F.lit(f"[{ALPHABET[:-1]}-]{{4,}}"), F.lit(0))
    both = docs.where(text.isNotNull()).select(
        F.explode(
            F.concat(
                F.transform(hits, lambda t: F.struct(t.alias("token"), F.lit(1).alias("random"))),
                F.transform(rest, lambda t: F.struct(t.alias("token"), F.lit(0).alias("random"))),
            )
        ).alias("x")
    )
    tokens = both.groupBy(F.col("x.token").alias("token")).agg(F.max("x.random").alias("random"))
    known = tokens.where((F.col("random") == 1) | F.col("token").rlike(ORDINARY))
    return known.withColumn("half", F.pmod(F.xxhash64(F.lit(10), "token"), F.lit(2)))


def _place(c: Column) -> Column:
    return F.instr(F.lit(ALPHABET), c) - 1


def fit_models(tokens: DataFrame, uniform_share: float = 0.5) -> list[float]:
    """Log-likelihood ratio of each pair of characters, row by row: the two models' add-one estimates.

    The random model is mixed with the uniform one, so that it knows alphabets that the tokens lack.
    The driver gets one count per pair of characters and label.
    """
    n = len(ALPHABET)
    pairs = tokens.where(F.length("token") > 1).select(
        "random",
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.length("token") - 1),
                lambda i: _place(F.substr(F.col("token"), i, F.lit(1))) * n
                + _place(F.substr(F.col("token"), i + 1, F.lit(1))),
            )
        ).alias("pair"),
    )
    import math

    count = {0: [1.0] * (n * n), 1: [1.0] * (n * n)}
    for r in pairs.groupBy("random", "pair").count().collect():
        if 0 <= r["pair"] < n * n:
            count[r["random"]][r["pair"]] += r["count"]
    table = []
    for a in range(n):
        rows = {y: count[y][a * n : (a + 1) * n] for y in (0, 1)}
        total = {y: sum(rows[y]) for y in (0, 1)}
        for b in range(n):
            random = uniform_share / n + (1 - uniform_share) * rows[1][b] / total[1]
            table.append(round(math.log(random / (rows[0][b] / total[0])), 4))
    return table


def mean_ratio(token: Column, table: Column) -> Column:
    """Mean log-likelihood ratio of a token's pairs of characters; above 0: rather random."""
    n = len(ALPHABET)
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(token) - 1),
        F.lit(0.0),
        lambda acc, i: acc
        + F.coalesce(
            F.get(
                table,
                _place(F.substr(token, i, F.lit(1))) * n + _place(F.substr(token, i + 1, F.lit(1))),
            ),
            F.lit(0.0),
        ),
    )
    return total / (F.length(token) - 1)


def literal_table(table: list[float]) -> Column:
    """The table as one constant array."""
    return F.split(F.lit(",".join(map(str, table))), ",").cast("array<double>")


def fit_threshold(tokens: DataFrame, table: list[float], share: float = 0.99, least: float = 0.5) -> float:
    """The ratio that ``share`` of the ordinary tokens stay under, ``least`` at least."""
    ordinary = tokens.where((F.col("random") == 0) & (F.length("token") >= TOKEN_MIN))
    r = ordinary.agg(F.percentile_approx(mean_ratio(F.col("token"), literal_table(table)), share, 100_000).alias("q"))
    q = r.first()["q"]
    return max(least, q if q is not None else least)


def scan(docs: DataFrame) -> DataFrame:
    """Spans of secrets in every whole text, by models and a threshold counted from the tokens of all documents.

    Returns doc_id, ``base`` and ``extra`` (arrays of spans; extra ones overlap no base span).
    """
    tokens = stage(labelled_tokens(docs), "secret-tokens")
    table = fit_models(tokens.where("half = 0"))
    limit = fit_threshold(tokens.where("half = 1"), table)
    text = F.col("text")
    found = docs.select("doc_id", F.coalesce(text, F.lit("")).alias("text"))
    found = found.select("doc_id", "text", F.concat(*base_spans(text)).cast(SPAN).alias("base"))
    ratios = literal_table(table)
    more = find_spans(text, TOKEN, 3, lambda v: mean_ratio(v, ratios) > F.lit(limit))
    found = found.select("doc_id", "base", more.alias("more"))
    free = F.filter(
        "more",
        lambda m: ~F.exists("base", lambda b: (b["s"] < m["e"]) & (m["s"] < b["e"])),
    )
    return found.select("doc_id", "base", free.alias("extra"))
