"""Phrase collocation mining: multikey three-way quicksort of suffix pointers, routed by leading words.

Every word of a piece starts a suffix, cut after ``DEPTH`` words. A task takes texts in chunks of about
``CHUNK_BYTES``, points at their suffixes, deals the pointers by their leading word, and splits each part again and again
into the pointers whose next word is before, equal to or after that of a pivot, the equal ones moving on to the next
word. All parts of a chunk are split at once, in numpy. The size of an equal part is the number of suffixes with its
words; parts of one pointer are not split further. So a chunk sends each distinct suffix once, with its count.

Suffixes are routed by their two leading words to buckets of about ``BUCKET_BYTES`` of text, where the same
quicksort, now over counted suffixes, gives global counts and abandons all parts under the least count. A pair of
words that a chunk holds ``HOT`` times or more would make a hot bucket: such a chunk routes the pair's suffixes by three
words instead and sends the pair's total to the bucket of the pair. There, what other chunks sent of that pair
is counted without abandoning, and one sum over what all buckets found joins both parts. So a bucket gets less than
``HOT`` suffixes a pair and chunk, however frequent the pair is. A chunk sends a bucket one row, which lists its suffixes.

Words travel as 64-bit hashes, with each chunk's words and their counts beside them; every hash is checked to name
one word only, and if ever one does not, all is done again under another seed. Counts and products are exact.

Defined results: null texts are empty; a null ``lang`` is ``und``; rows count one by one, repeated or without an id; a long
text is cut only between pieces; no text or no frequent phrase gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from covisit_spark.llm.common import small_batches, stage
from covisit_spark.llm.near_dedup import GOLDEN, mix

# Characters that end a piece, and those between words.
PIECE_ENDS = ".,;:!?\n\x0b\x0c\r"
WORD_ENDS = " \t"
DEPTH = 3
LEAST = 10
COVERED = 50
TOP = 2000
CHUNK_BYTES = 4 << 20
BUCKET_BYTES = 1 << 20
HOT = 64
# Kinds of rows: suffixes by two words, suffixes of hot pairs by three, totals of hot pairs, words, words of a language, two
# words of one hash.
SUFFIX, SPREAD, PAIR, WORD, LANG, CLASH = range(6)
ROW = "bucket int, kind array<tinyint>, h1 array<long>, h2 array<long>, h3 array<long>, c array<int>, word array<string>, word_c array<int>"
FOUND = "kind int, h1 long, h2 long, h3 long, c long, name string"


def _tables() -> tuple[np.ndarray, np.ndarray]:
    kind = np.zeros(256, np.uint8)
    kind[list(WORD_ENDS.encode())] = 1
    kind[list(PIECE_ENDS.encode())] = 2
    low = np.arange(256, dtype=np.uint8)
    low[ord("A") : ord("Z") + 1] += 32
    return kind, low


def tokens(text: np.ndarray, starts: np.ndarray):
    """(words as an Arrow array, piece of each word, text of each word); ``starts`` is where each text begins in ``text``."""
    import pyarrow as pa

    kinds, low = _tables()
    kind = kinds[text]
    inside = kind == 0
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    real = starts[starts < len(text)]
    begins[real] = inside[real]
    at = np.flatnonzero(begins)
    letters = np.ascontiguousarray(low[text[inside]])
    before = np.cumsum(inside)
    offsets = np.append(before[at] - 1, len(letters)) if len(at) else np.zeros(1, np.int64)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(letters)])
    ends = kind == 2
    ends[real] = True
    piece = np.cumsum(ends)[at]
    return words, piece, np.searchsorted(starts, at, side="right") - 1


def quicksort(keys: np.ndarray, order: np.ndarray, sizes: np.ndarray, least: int = 1, weight: np.ndarray | None = None) -> list[tuple]:
    """Multikey three-way quicksort, all parts at once: [(kind, heads, words, weights)] of the parts found.

    ``keys[d]`` holds each suffix's word d, 0 beyond its end; ``order`` the pointers part by part, the parts, which agree
    in their leading word, being of ``sizes``. Parts under ``least`` in weight are abandoned. An ``equal`` part agrees
    in that many words, and so do the suffixes of an ``ended`` part, which have no more. Parts of one pointer are not split:
    ``single``, with the number of words that are told already.
    """
    depths = np.ones(len(sizes), np.int64)
    found = []
    while len(sizes):
        begin = np.cumsum(sizes) - sizes
        lone = sizes == 1
        if lone.any():
            one = order[begin[lone]]
            found.append(("single", one, depths[lone], np.ones(len(one), np.int64) if weight is None else weight[one]))
            order, sizes, depths = order[np.repeat(~lone, sizes)], sizes[~lone], depths[~lone]
            if not len(sizes):
                break
            begin = np.cumsum(sizes) - sizes
        part = np.repeat(np.arange(len(sizes)), sizes)
        here = keys[depths[part], order]
        pivot = here[begin + sizes // 2]
        against = pivot[part]
        side = (here > against).astype(np.int8) - (here < against)
        more = []
        for which in (-1, 1, 0):
            at = np.flatnonzero(side == which)
            chosen, of = order[at], part[at]
            n = np.bincount(of, minlength=len(sizes))
            w = n if weight is None else np.bincount(of, weight[chosen], len(sizes)).astype(np.int64)
            keep, depth = (n > 0) & (w >= least), depths
            if which == 0:
                first, ended = chosen[np.cumsum(n) - n], pivot == 0
                stop, on = keep & ended, keep & ~ended
                found.append(("ended", first[stop], depths[stop], w[stop]))
                found.append(("equal", first[on], depths[on] + 1, w[on]))
                keep, depth = on & (depths + 1 < len(keys)), depths + 1
            more.append((chosen[keep[of]], n[keep], depth[keep]))
        order, sizes, depths = (np.concatenate(x) for x in zip(*more, strict=True))
    return found


def _parts(first_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pointers dealt by their leading word: (order, sizes)."""
    order = np.argsort(first_keys, kind="stable")
    ordered = first_keys[order]
    cuts = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(order) else np.zeros(0, np.int64)
    return order, np.diff(np.append(cuts, len(order)))


def _joined(found: list[tuple], kind: str) -> tuple[np.ndarray, ...]:
    chosen = [f[1:] for f in found if f[0] == kind]
    return tuple(np.concatenate(x) for x in zip(*chosen, strict=True)) if chosen else (np.zeros(0, np.int64),) * 3


def _route(*hashes: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        out = np.zeros(len(hashes[0]), np.uint64)
        for h in hashes:
            out = mix(out * GOLDEN + h.view(np.uint64))
    return out


def _hash(name: bytes, seed: int) -> int:
    """Hash of a language and word; 0 stands for no word."""
    import xxhash

    return xxhash.xxh3_64_intdigest(name, seed) or 1


def _lists(buckets: np.ndarray, of: np.ndarray, order: np.ndarray, *columns):
    """One list a bucket of each column's values, which belong to the buckets ``of``."""
    import pyarrow as pa

    offsets = pa.array(np.append(np.searchsorted(of[order], buckets), len(of)).astype(np.int32))
    chosen = [c.take(pa.array(order)) if isinstance(c, pa.Array) else pa.array(c[order]) for c in columns]
    return [pa.ListArray.from_arrays(offsets, c) for c in chosen]


def suffix_rows(text: np.ndarray, starts: np.ndarray, langs: list[str], buckets: int, seed: int, hot: int):
    """One chunk's distinct suffixes of two words or more, totals of its hot pairs, and words: a row of lists a bucket."""
    import pyarrow as pa

    words, piece, owner = tokens(text, starts)
    coded = words.dictionary_encode()
    names, lang_index = coded.dictionary.to_pylist(), {}
    lang_of = np.array([lang_index.setdefault(x, len(lang_index)) for x in langs], np.int64)
    lex, code = np.unique(lang_of[owner] * max(1, len(names)) + coded.indices.to_numpy().astype(np.int64), return_inverse=True)
    lang_names = [x.encode() for x in lang_index]
    named = [lang_names[x // len(names)] + b"\t" + names[x % len(names)] for x in lex.tolist()]
    hashes = np.array([0] + [_hash(x, seed) for x in named], np.uint64).view(np.int64)
    n = len(code)
    keys = np.zeros((DEPTH, n), np.int32)
    for d in range(DEPTH):
        stop = max(0, n - d)
        keys[d, :stop] = np.where(piece[d:] == piece[:stop], code[d:] + 1, 0)
    found = quicksort(keys, *_parts(keys[0]))
    heads, depth, weight = _joined(found, "equal")
    leaf, pairs = depth == DEPTH, (depth == 2) & (weight >= hot)
    end_heads, end_words, end_weight = _joined(found, "ended")
    one, _, one_weight = _joined(found, "single")
    suffix = np.concatenate([heads[leaf], end_heads[end_words >= 2], one])
    count = np.concatenate([weight[leaf], end_weight[end_words >= 2], one_weight])
    two = keys[1, suffix] != 0
    suffix, count = suffix[two], count[two]
    total = heads[pairs]
    route = _route(hashes[keys[0, suffix]], hashes[keys[1, suffix]])
    pair_route = _route(hashes[keys[0, total]], hashes[keys[1, total]])
    spread = np.isin(route, pair_route)
    # what ends after a hot pair is in the pair's total
    real = ~spread | (keys[2, suffix] != 0)
    suffix, count, spread, route = suffix[real], count[real], spread[real], route[real]
    route[spread] = _route(*(hashes[keys[d, suffix[spread]]] for d in range(DEPTH)))
    suffix, count = np.concatenate([suffix, total]), np.concatenate([count, weight[pairs]]).astype(np.int32)
    kind = np.concatenate([np.where(spread, SPREAD, SUFFIX), np.full(len(total), PAIR)]).astype(np.int8)
    h = [hashes[keys[d, suffix]] for d in range(DEPTH)]
    h[2][kind == PAIR] = 0
    bucket = _bucket(np.concatenate([route, pair_route]), buckets)
    word_bucket = _bucket(_route(hashes[1:]), buckets)
    filled = np.unique(np.concatenate([bucket, word_bucket]))
    lists = _lists(filled, bucket, np.argsort(bucket, kind="stable"), kind, *h, count)
    own = np.bincount(code, minlength=len(named)).astype(np.int32)
    texts = pa.array([x.decode() for x in named], pa.string())
    lists += _lists(filled, word_bucket, np.argsort(word_bucket, kind="stable"), texts, own)
    return pa.RecordBatch.from_arrays([pa.array(filled), *lists], names=["bucket", "kind", "h1", "h2", "h3", "c", "word", "word_c"])


def _bucket(route: np.ndarray, buckets: int) -> np.ndarray:
    return (route % np.uint64(buckets)).astype(np.int32)


def _chunks(batches: Iterator, limit: int) -> Iterator[tuple[list[bytes], list[str]]]:
    """Texts and their languages, about ``limit`` bytes at a time; long texts are cut where a piece ends."""
    ends = re.compile(b"[" + re.escape(PIECE_ENDS.encode()) + b"]")
    texts, langs, size = [], [], 0
    for b in batches:
        for text, lang in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            data, begin = text.encode(), 0
            while begin < len(data):
                end = len(data)
                if end - begin > limit:
                    found = ends.search(data, begin + limit)
                    end = found.end() if found else end
                texts.append(data[begin:end])
                langs.append(lang)
                size += end - begin
                begin = end
                if size >= limit:
                    yield texts, langs
                    texts, langs, size = [], [], 0
    if texts:
        yield texts, langs


def _suffixes(buckets: int, seed: int, hot: int, limit: int):
    def run(batches: Iterator) -> Iterator:
        for texts, langs in _chunks(batches, limit):
            lengths = np.array([len(t) for t in texts])
            joined = np.frombuffer(b"".join(texts), np.uint8)
            yield suffix_rows(joined, np.cumsum(lengths) - lengths, langs, buckets, seed, hot)

    return run


def _count(least: int, seed: int):
    """Counts of one bucket: frequent words and phrases, and all that it holds of hot pairs and of languages."""

    def words(names, c) -> list[tuple]:
        import pyarrow as pa

        mine = pa.table({"name": names, "c": c}).group_by("name").aggregate([("c", "sum")])
        names, c = mine["name"].to_pylist(), mine["c_sum"].to_numpy()
        h = np.array([_hash(x.encode(), seed) for x in names], np.uint64).view(np.int64)
        totals: dict[str, int] = {}
        for name, k in zip(names, c.tolist(), strict=True):
            lang = name.rpartition("\t")[0]
            totals[lang] = totals.get(lang, 0) + k
        out = [(LANG, 0, 0, 0, k, lang) for lang, k in totals.items()]
        if len(np.unique(h)) < len(h):
            out.append((CLASH, 0, 0, 0, 0, None))
        return out + [(WORD, int(h[i]), 0, 0, int(c[i]), names[i]) for i in np.flatnonzero(c >= least)]

    def phrases(h: np.ndarray, c: np.ndarray, floor: int, words: tuple) -> list[np.ndarray]:
        """Rows (h1, h2, h3, count) of the parts of 2 or 3 words of at least (``words``) this weight."""
        order, sizes = _parts(h[0])
        found = quicksort(h, order, sizes, floor, c)
        heads, depth, weight = _joined(found, "equal")
        one, told, own = _joined(found, "single")
        length = (h[:, one] != 0).sum(0)
        out = []
        for d in (2, 3):
            part = (depth == d) & (weight >= words[d - 2])
            alone = (told < d) & (length >= d) & (own >= words[d - 2])
            head, w = np.concatenate([heads[part], one[alone]]), np.concatenate([weight[part], own[alone]])
            out.append(np.stack([h[0, head], h[1, head], h[2, head] if d == 3 else np.zeros(len(head), np.int64), w]))
        return out

    def run(rows):
        import pyarrow as pa

        flat = {x: pa.chunked_array([y.flatten() for y in rows[x].chunks], rows[x].type.value_type) for x in rows.column_names[1:]}
        told = words(flat["word"], flat["word_c"])
        kind, c = flat["kind"].to_numpy(), flat["c"].to_numpy().astype(np.int64)
        h = np.stack([flat[x].to_numpy() for x in ("h1", "h2", "h3")])
        pair = _route(h[0], h[1])
        near = (kind == SUFFIX) | (kind == PAIR)
        hot = near & np.isin(pair, pair[kind == PAIR])
        never = np.iinfo(np.int64).max
        parts = []
        for mine, floor, of in ((near & ~hot, least, (least, least)), (hot, 1, (least, 1)), (kind == SPREAD, 1, (never, 1))):
            parts += phrases(np.ascontiguousarray(h[:, mine]), c[mine], floor, of)
        p = np.concatenate(parts, axis=1)
        cols = [list(x) for x in zip(*told, strict=True)] if told else [[]] * 6
        kinds = np.concatenate([np.array(cols[0], np.int32), np.full(p.shape[1], SUFFIX, np.int32)])
        longs = [pa.array(np.concatenate([np.array(x, np.int64), y])) for x, y in zip(cols[1:5], p, strict=True)]
        names = pa.concat_arrays([pa.array(cols[5], pa.string()), pa.nulls(p.shape[1], pa.string())])
        return pa.Table.from_arrays([pa.array(kinds), *longs, names], names=["kind", "h1", "h2", "h3", "c", "name"])

    return run


def counts(docs: DataFrame, least: int = LEAST, hot: int = HOT, chunk: int = CHUNK_BYTES, bucket: int = BUCKET_BYTES) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(words, phrases, totals): (h, lang, word, f), (h1, h2, h3, a), (lang, n); words and phrases of ``least`` occurrences or more."""
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"), F.coalesce("lang", F.lit("und")).alias("lang"))
    small_batches(docs.sparkSession)
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = -(-size // bucket) + 1
    seed = 0
    while True:
        rows = texts.mapInArrow(_suffixes(buckets, seed, hot, chunk), ROW)
        found = stage(rows.groupBy("bucket").applyInArrow(_count(least, seed), FOUND), "phrase-counts")
        if found.where(F.col("kind") == CLASH).isEmpty():
            break
        seed += 1
    named = found.where(F.col("kind") == WORD)
    words = named.select(
        F.col("h1").alias("h"),
        F.regexp_extract("name", r"(?s)^(.*)\t[^\t]*$", 1).alias("lang"),
        F.substring_index("name", "\t", -1).alias("word"),
        F.col("c").alias("f"),
    )
    phrases = found.where(F.col("kind") == SUFFIX).groupBy("h1", "h2", "h3").agg(F.sum("c").alias("a")).where(F.col("a") >= least)
    totals = found.where(F.col("kind") == LANG).groupBy(F.col("name").alias("lang")).agg(F.sum("c").alias("n"))
    return words, stage(phrases, "phrases"), totals


def _score(a: str, left: str, right: str) -> Column:
    """floor(1000000 * a * a / (left * right)), in decimals of 38 digits."""
    return F.expr(
        f"(cast({a} as decimal(18,0)) * cast({a} as decimal(18,0)) * cast(1000000 as decimal(7,0)))"
        f" div (cast({left} as decimal(18,0)) * cast({right} as decimal(18,0)))"
    )


def collocations(docs: DataFrame, least: int = LEAST, covered: int = COVERED, top: int = TOP, **settings) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``top`` phrases of each language."""
    words, phrases, totals = counts(docs, least, **settings)

    def word(k: int) -> DataFrame:
        lang = [F.col("lang")] if k == 1 else []
        return words.select(F.col("h").alias(f"h{k}"), *lang, F.col("word").alias(f"w{k}"), F.col("f").alias(f"f{k}"))

    def pair(i: int, j: int) -> DataFrame:
        return pairs.select(F.col("h1").alias(f"h{i}"), F.col("h2").alias(f"h{j}"), F.col("a").alias(f"f{i}{j}"))

    pairs, triples = phrases.where("h3 = 0").drop("h3"), phrases.where("h3 <> 0")
    # the most frequent three words around each pair
    around = triples.select("h1", "h2", "a").unionByName(triples.select(F.col("h2").alias("h1"), F.col("h3").alias("h2"), "a"))
    widest = around.groupBy("h1", "h2").agg(F.max("a").alias("longer"))
    free = pairs.join(widest, ["h1", "h2"], "left").where(F.coalesce(100 * F.col("longer") < covered * F.col("a"), F.lit(True)))
    two = free.join(word(1), "h1").join(word(2), "h2")
    two = two.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", F.col("f1").alias("l"), F.col("f2").alias("r"), _score("a", "f1", "f2").alias("score"))
    three = triples.join(word(1), "h1").join(word(2), "h2").join(word(3), "h3").join(pair(1, 2), ["h1", "h2"]).join(pair(2, 3), ["h2", "h3"])
    cuts = three.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", "f1", "f23", "f12", "f3", _score("a", "f1", "f23").alias("s1"), _score("a", "f12", "f3").alias("s2"))
    first = F.col("s1") <= F.col("s2")
    three = cuts.select(
        "lang", "phrase", "a", F.when(first, F.col("f1")).otherwise(F.col("f12")).alias("l"), F.when(first, F.col("f23")).otherwise(F.col("f3")).alias("r"), F.least("s1", "s2").alias("score")
    )
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    placed = two.unionByName(three).withColumn("rank", F.row_number().over(best).cast("long")).where(F.col("rank") <= top)
    return placed.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
