"""URL filter: rules, then a list of canonical URLs behind a blocked Bloom filter.

The listed URLs are hashed into blocks of 512 bits (eight longs a block), built by one aggregate per
block. Every distinct canonical URL is looked up in the one block that its hash names; only possible hits
go on to the exact hash join with the list, which removes the false positives.

Defined results: null urls and urls without ``://`` have an empty host and path, no rule and no
canonical form, and are allowed; repeated rows are judged each; an empty list blocks nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The rules as (host, path, verdict).
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = "(?s)^.*?://([^/?#]*)([^?#]*)(\\?[^#]*)?"
# Query parameters that do not name a page.
TRACKING = "^(utm_[a-z]+|ref|fbclid|gclid|sessionid)(=|$)"
BITS_PER_URL, BLOCK_BITS, PROBES = 12, 512, 6


def host(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), PARTS, 1), UPPER, LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), PARTS, 2)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule text, verdict) of the longest rule that fits; null if none does."""
    text, says = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        text, says = F.when(fits, F.lit(h + p)).otherwise(text), F.when(fits, F.lit(v)).otherwise(says)
    return text, says


def canonical(url: Column) -> Column:
    """One form for the spellings of a page's address; null without a host.

    Drops scheme, ``www.`` and ``m.``, default ports, fragment, tracking parameters and a slash at the
    end; sorts the other parameters.
    """
    u = F.coalesce(url, F.lit(""))
    bare = F.regexp_replace(F.regexp_replace(host(u), ":(80|443)$", ""), "^(www|m)\\.", "")
    where = F.regexp_replace(path(u), "/+$", "")
    given = F.split(F.substring(F.regexp_extract(u, PARTS, 3), 2, 1 << 30), "&")
    query = F.array_join(F.sort_array(F.filter(given, lambda x: (x != "") & ~x.rlike(TRACKING))), "&")
    full = F.concat(bare, where, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")))
    return F.when(bare != "", full)


def _probe_bits(url: Column) -> list[Column]:
    """The bits of a URL inside its block, by double hashing."""
    a, b = F.xxhash64(F.lit(1), url), F.xxhash64(F.lit(2), url)
    return [F.pmod(F.pmod(a, F.lit(1 << 31)) + F.pmod(b, F.lit(1 << 31)) * F.lit(k), F.lit(BLOCK_BITS)).cast("int") for k in range(PROBES)]


def _block(url: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(3), url), F.lit(blocks))


def _word(bits: list[Column], w: int) -> Column:
    """The bits that fall into long ``w`` of a block, as a mask."""
    mask = F.lit(0).cast("long")
    for b in bits:
        one = F.expr("1L")
        mask = mask.bitwiseOR(F.when(F.floor(b / 64) == w, F.call_function("shiftleft", one, b % 64)).otherwise(F.lit(0).cast("long")))
    return mask


def bloom_filter(listed: DataFrame, blocks: int) -> DataFrame:
    """(block, w0 .. w7) from the listed canonical URLs (column ``canonical``)."""
    bits = [f"p{k}" for k in range(PROBES)]
    placed = listed.select(
        _block(F.col("canonical"), blocks).alias("block"),
        *[c.alias(n) for c, n in zip(_probe_bits(F.col("canonical")), bits, strict=True)],
    )
    masks = placed.select("block", *[_word([F.col(n) for n in bits], w).alias(f"w{w}") for w in range(8)])
    return masks.groupBy("block").agg(*[F.bit_or(f"w{w}").alias(f"w{w}") for w in range(8)])


def listed_hits(urls: DataFrame, listed: DataFrame) -> DataFrame:
    """The distinct ``canonical`` of ``urls`` that ``listed`` has: Bloom filter, then exact join.

    The joins carry no hint: the filter is 12 bits and the list one row a listed URL, and the engine
    broadcasts them only below its own measured limit.
    """
    names = listed.where(F.col("canonical").isNotNull()).select("canonical").distinct()
    blocks = max(1, -(-names.count() * BITS_PER_URL // BLOCK_BITS))
    bits = [f"p{k}" for k in range(PROBES)]
    probed = (
        urls.where(F.col("canonical").isNotNull())
        .select("canonical")
        .distinct()
        .select(
            "canonical",
            _block(F.col("canonical"), blocks).alias("block"),
            *[c.alias(n) for c, n in zip(_probe_bits(F.col("canonical")), bits, strict=True)],
        )
    )
    held = probed.join(bloom_filter(names, blocks), "block")
    for w in range(8):
        need = _word([F.col(n) for n in bits], w)
        held = held.where(F.col(f"w{w}").bitwiseAND(need) == need)
    return held.select("canonical").join(names, "canonical", "left_semi")


def filter_urls(pages: DataFrame, listed: DataFrame, rules=RULES) -> DataFrame:
    """Host, path, rule and verdict of every row of ``pages`` (columns ``page_id``, ``url``).

    ``listed`` has the blocked canonical URLs in ``canonical``. The rule decides where one fits;
    else a listed URL is blocked and any other allowed.
    """
    judged = pages.select(
        "page_id",
        host(F.col("url")).alias("host"),
        path(F.col("url")).alias("path"),
        canonical(F.col("url")).alias("canonical"),
    )
    hits = listed_hits(judged, listed).withColumn("listed", F.lit(True))
    out = judged.join(hits, "canonical", "left").withColumn("listed", F.coalesce("listed", F.lit(False)))
    text, says = rule_of(F.col("host"), F.col("path"), rules)
    return out.select(
        "page_id",
        "host",
        "path",
        text.alias("rule"),
        F.coalesce(says, F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        "canonical",
        "listed",
    )
