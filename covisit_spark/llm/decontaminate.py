"""Benchmark decontamination by latent semantic retrieval.

Texts are words in lower case, hashed into ``DIMS`` terms; idf counts every document. A randomised SVD, run
as distributed passes over the TF-IDF vectors of the benchmark and of all passages, gives
latent directions: one for ``ITEMS_A_DIRECTION`` items, between ``RANK`` and ``MOST_RANK``. They are damped by
the passages' variance along them, so that the words all texts share do not make everything alike. Every passage of every
document (windows of two blocks of ``BLOCK`` words, each overlapping the next by one block, up to the end of the
text) is projected and compared with all items by cosine, both sides normalised in the latent space; a candidate counts if the longest common subsequence with the item, around the passage, has
``VERBATIM`` of its words, or ``PARAPHRASE`` of them and the words of the item's answer. The answer is its last
sentence, or its last ``ANSWER`` words where it has but one.

Defined results: null and empty texts, and items of fewer than ``LEAST`` words, match nothing; rows with a null
``doc_id`` are searched too and give hits with a null id; repeated rows and items give one hit a
(doc_id, item_id); with an empty table there is no hit.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from covisit_spark.llm.common import small_batches, stage

DIMS, RANK, BLOCK = 1 << 15, 96, 16
COSINE, VERBATIM, PARAPHRASE, ANSWER, LEAST = 0.3, 0.7, 0.5, 5, 5
# Directions grow with the items of a pass, which has its own: fewer lose items among the others.
MOST_RANK, ITEMS_A_DIRECTION, ITEMS_PER_PASS = 256, 4, 4_000
# Columns of the tables of words around a passage.
NEAR = 1 << 13
# Bits that tell which words a block or an item has; wider windows around a passage would set most of them.
BITS = 1024
# Rows of vectors that are worked on at a time, few enough for a core's cache.
CACHED = 256
# Texts whose terms are told apart at a time, in a table that a core's cache holds.
TOGETHER = 16
# Words that one task of a pass adds up before it sends its sums, and terms a row of them.
PART_WORDS, TERMS_A_ROW = 1 << 24, 256


def terms(text: Column) -> Column:
    """Hashes of the words of a text: runs of letters and digits, in lower case."""
    split = F.split(F.lower(F.coalesce(text, F.lit(""))), "[^\\p{L}\\p{N}]+")
    return F.transform(F.filter(split, lambda w: w != ""), lambda w: F.xxhash64(w))


def _flat(column) -> tuple[np.ndarray, np.ndarray]:
    import pyarrow.compute as pc

    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    return column.flatten().to_numpy(zero_copy_only=False), lengths


def dims_of(words: np.ndarray) -> np.ndarray:
    return (words & (DIMS - 1)).astype(np.int64)


def distinct_terms(words: np.ndarray, lengths: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The terms of texts laid end to end, each once a text; ``last`` has ``TOGETHER * DIMS`` places of any content."""
    d, ends, out = dims_of(words), np.append(0, np.cumsum(lengths)), []
    for a in range(0, len(lengths), TOGETHER):
        some = lengths[a : a + TOGETHER]
        part = d[ends[a] : ends[a + len(some)]]
        # of the words of one term in one text, the one that is written last finds itself again
        at, nth = np.repeat(np.arange(len(some)) * DIMS, some) + part, np.arange(len(part))
        last[at] = nth
        out.append(part[last[at] == nth])
    return np.concatenate(out) if out else d


def document_counts(hashed: DataFrame) -> tuple[np.ndarray, int, int, int]:
    """In how many documents each term occurs, and the numbers of documents, blocks and words: DIMS sums reach the driver."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        total, sizes, last = np.zeros(DIMS, np.int64), np.zeros(3, np.int64), np.zeros(TOGETHER * DIMS, np.int64)
        for b in batches:
            words, lengths = _flat(b.column(1))
            total += np.bincount(distinct_terms(words, lengths, last), minlength=DIMS)
            sizes += len(lengths), np.sum(-(-lengths // BLOCK)), len(words)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(some, [-1, -2, -3]), pa.int32()), pa.array(np.append(total[some], sizes), pa.int64())], names=["term", "n"]
        )

    got = hashed.mapInArrow(run, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    term, n = got["term"].to_numpy(), got["n"].to_numpy()
    df, sizes = np.zeros(DIMS), np.zeros(3, np.int64)
    df[term[term >= 0]] = n[term >= 0]
    sizes[-1 - term[term < 0]] = n[term < 0]
    return df, *sizes.tolist()


def block_sums(words: np.ndarray, lengths: np.ndarray, table: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sums over blocks of words of ``table`` rows and of squared weights; (sums, squares, text, block's first word).

    Words are laid out as (block, place); places after a text's end point at a row of zeros, which a ``table`` for
    many calls has already (:func:`with_zeros`).
    """
    blocks = np.maximum(-(-lengths // BLOCK), 1)
    own = np.repeat(np.arange(len(lengths)), blocks)
    nth = np.arange(len(own)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    place = (nth * BLOCK)[:, None] + np.arange(BLOCK)
    at = (np.cumsum(lengths) - lengths)[own][:, None] + place
    d = np.where(place < lengths[own][:, None], np.append(dims_of(words), DIMS)[np.minimum(at, len(words))], DIMS)
    rows, squared = table if len(table) > DIMS else with_zeros(table), np.append(weight.astype(np.float64) ** 2, 0.0)
    sums = np.empty((len(d), table.shape[1]), rows.dtype)
    for a in range(0, len(d), CACHED):
        part, out = d[a : a + CACHED].T, sums[a : a + CACHED]
        rows.take(part[0], axis=0, out=out, mode="clip")
        for k in range(1, BLOCK):
            out += rows.take(part[k], axis=0, mode="clip")
    return sums, squared[d].sum(1), own, nth * BLOCK


def with_zeros(table: np.ndarray) -> np.ndarray:
    """``table`` and a last row of zeros."""
    return np.vstack([table, np.zeros_like(table[:1])])


def passages(sums: np.ndarray, squares: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of two blocks (one where a text has one): (vectors, squared norms, first block)."""
    n = len(own)
    alone = np.ones(n, bool)
    alone[1:] &= own[1:] != own[:-1]
    alone[:-1] &= own[:-1] != own[1:]
    first = np.flatnonzero(np.append(own[1:] == own[:-1], False) | alone) if n else np.zeros(0, np.int64)
    nxt = np.minimum(first + 1, max(n - 1, 0))
    two = (~alone[first])[:, None]
    vectors = sums.take(first, axis=0)
    for a in range(0, len(first), CACHED):
        some = slice(a, a + CACHED)
        vectors[some] += sums.take(nxt[some], axis=0) * two[some]
    return vectors, squares[first] + squares[nxt] * two[:, 0], first


def sums_by_term(d: np.ndarray, block: np.ndarray, per: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct terms of ``d``, and for each the sum of the rows of ``per`` that ``block`` names for its words."""
    order = np.argsort(d.astype(np.uint16), kind="stable")
    ds, rows = d[order], block[order]
    heads = np.flatnonzero(np.append(True, ds[1:] != ds[:-1]))
    counts = np.diff(np.append(heads, len(ds)))
    # most frequent first: those are added up one by one, the others together, their j-th words at a time
    by = np.argsort(-counts, kind="stable")
    heads, counts = heads[by], counts[by]
    sums = per.take(rows[heads], axis=0)
    single = int((counts > 32).sum())
    for i in range(single):
        sums[i] = per.take(rows[heads[i] : heads[i] + counts[i]], axis=0).sum(0)
    for j in range(1, 32):
        some = slice(single, int((counts > j).sum()))
        sums[some] += per.take(rows[heads[some] + j], axis=0)
    return ds[heads], sums


def svd_pass(texts: DataFrame, weight: np.ndarray, q: np.ndarray, back: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """One pass over the passages of ``texts`` (w, f): (A'AQ, zeros unless ``back``; (AQ)'(AQ)).

    Rows of A are unit vectors times ``f``. Tasks emit partial sums of ``TERMS_A_ROW`` terms at a time, which are
    added one after the other, in a fixed order, per block of terms.
    """
    spark = texts.sparkSession
    shared = spark.sparkContext.broadcast((weight.astype(np.float32), q.astype(np.float32, copy=False)))
    width = TERMS_A_ROW

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        w, basis = shared.value
        scaled = with_zeros(basis * w[:, None])
        out, gram, seen = np.zeros(basis.shape, np.float32), np.zeros((basis.shape[1],) * 2), False
        for b in batches:
            words, lengths = _flat(b.column(0))
            if not len(words):
                continue
            factor = b.column(1).to_numpy(zero_copy_only=False).astype(np.float32)
            sums, squares, own, _ = block_sums(words, lengths, scaled, w)
            y, norms, first = passages(sums, squares, own)
            norm = (factor[own[first]] / np.sqrt(np.maximum(norms, 1e-12)))[:, None].astype(np.float32)
            y *= norm
            gram += y.T @ y
            seen = True
            if not back:
                continue
            # back to the words: each block gets the vectors of the passages it is part of
            y *= norm
            per = np.zeros_like(sums)
            per[first] = y
            two = np.flatnonzero((first + 1 < len(own)) & (own[np.minimum(first + 1, len(own) - 1)] == own[first]))
            per[first[two] + 1] += y[two]
            at = np.repeat(np.arange(len(lengths)), lengths)
            place = np.arange(len(words)) - (np.cumsum(lengths) - lengths)[at]
            count = np.maximum(-(-lengths // BLOCK), 1)
            block = (np.cumsum(count) - count)[at] + place // BLOCK
            term, added = sums_by_term(dims_of(words), block, per)
            for a in range(0, len(term), CACHED):
                t = term[a : a + CACHED]
                out[t] += added[a : a + CACHED] * w[t][:, None]
        if seen:
            some = [a for a in range(0, DIMS, width) if back and out[a : a + width].any()]
            parts = [out[a : a + width].tobytes() for a in some] + [gram.astype(np.float32).tobytes()]
            task = pa.array([TaskContext.get().partitionId()] * len(parts), pa.int32())
            rows = pa.array([a // width for a in some] + [DIMS // width], pa.int32())
            yield pa.RecordBatch.from_arrays([rows, task, pa.array(parts, pa.binary())], names=["part", "task", "data"])

    def add(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def done(part: int, total: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([total.astype(np.float32).tobytes()], pa.binary())], names=["part", "data"]
            )

        now, total = None, None
        for b in batches:
            for part, data in zip(b.column(0).to_pylist(), b.column(2), strict=True):
                x = np.frombuffer(data.as_buffer(), np.float32)
                if part == now:
                    total += x
                    continue
                if now is not None:
                    yield done(now, total)
                now, total = part, x.astype(np.float64)
        if now is not None:
            yield done(now, total)

    partial = texts.mapInArrow(run, "part int, task int, data binary")
    sums = partial.repartition("part").sortWithinPartitions("part", "task").mapInArrow(add, "part int, data binary")
    y, gram = np.zeros(q.shape, np.float32), np.zeros((q.shape[1],) * 2, np.float32)
    for r in sums.collect():
        at = r["part"] * width
        if at < DIMS:
            y[at : at + width] = np.frombuffer(r["data"], np.float32).reshape(width, -1)
        else:
            gram[:] = np.frombuffer(r["data"], np.float32).reshape(gram.shape)
    shared.destroy()
    return y, gram


def turned(y: np.ndarray, by: np.ndarray) -> np.ndarray:
    """``y @ by`` in place of ``y``, some rows at a time: the driver holds no second array of that size."""
    for a in range(0, len(y), 4096):
        y[a : a + 4096] = y[a : a + 4096] @ by
    return y


def orthonormal(y: np.ndarray) -> np.ndarray:
    """Orthonormal columns with the span of those of ``y``, in its place; zeros for what they have too many.

    By the columns' inner products, in double precision and twice: once leaves those nearly dependent askew.
    """
    for _ in range(2):
        inner = np.zeros((y.shape[1],) * 2)
        for a in range(0, len(y), 4096):
            part = y[a : a + 4096].astype(np.float64)
            inner += part.T @ part
        values, turn = np.linalg.eigh(inner)
        real = values > 1e-11 * max(values[-1], 1e-30)
        turned(y, np.where(real, turn / np.sqrt(np.where(real, values, 1.0)), 0.0))
    return y


def fit_directions(
    hashed: DataFrame, bench: DataFrame, weight: np.ndarray, blocks: int, words: int, rank: int | None = None, rounds: int = 2
) -> np.ndarray:
    """Right singular vectors (DIMS x rank) by randomised subspace iteration, damped by the variance of passages.

    Each axis is divided by the root of the documents' sum of squares along it plus their mean: what all
    passages share weighs no more than the rest, weak axes are not blown up. The benchmark does not damp.

    The passes read the benchmark and every document (``blocks`` blocks, ``words`` words in all), in parts of
    about ``PART_WORDS`` words, one for each core at least: what is added per block of terms is a small share of them.
    """
    items = max(1, bench.count())
    rank = min(MOST_RANK, max(RANK, items // ITEMS_A_DIRECTION)) if rank is None else rank
    parts = max(hashed.sparkSession.sparkContext.defaultParallelism, -(-words // PART_WORDS))
    docs = hashed.select("w", F.lit(1.0).alias("f")).coalesce(parts)
    # the benchmark's rows weigh as much as all others together
    own = bench.select("w", F.lit(float(np.sqrt(max(blocks, 1) / items))).alias("f")).coalesce(1).persist()
    # single precision, each changed in place: the driver's largest arrays
    q = orthonormal(np.random.default_rng(0).standard_normal((DIMS, rank), np.float32))
    both = docs.unionByName(own)
    for _ in range(rounds):
        q = orthonormal(svd_pass(both, weight, q)[0])
    own.unpersist()
    values, turn = np.linalg.eigh(svd_pass(docs, weight, q, back=False)[1].astype(np.float64))
    values = np.maximum(values, 0)
    damped = turn / np.sqrt(values + max(values.mean(), 1e-12))
    return turned(q, damped[:, np.argsort(-values)])


def common_words(item: dict[int, int], n: int, words: list[int]) -> int:
    """Length of the longest common subsequence, one bit a word of the item: ``item`` has each word's places."""
    full = (1 << n) - 1
    v = full
    for w in words:
        m = item.get(w)
        if m:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return n - v.bit_count()


def places(words: list[int]) -> dict[int, int]:
    out: dict[int, int] = {}
    for k, w in enumerate(words):
        out[w] = out.get(w, 0) | 1 << k
    return out


def word_bits(words: np.ndarray, block: np.ndarray, n: int) -> np.ndarray:
    """Which of ``BITS`` classes of words each of ``n`` blocks has, 64 to a number; ``block`` ascends."""
    out, kind = np.zeros((n, BITS // 64), np.uint64), (words & (BITS - 1)).astype(np.int64)
    for a in range(0, n, 4096):
        b = min(n, a + 4096)
        low, high = np.searchsorted(block, (a, b))
        seen = np.zeros((b - a, BITS), bool)
        seen[block[low:high] - a, kind[low:high]] = True
        out[a:b] = np.packbits(seen, axis=1).view(np.uint64)
    return out


class Items:
    """A block of benchmark items: their words, answers and latent vectors."""

    def __init__(self, ids: list, words: list[list[int]], answers: list[list[int]], scaled: np.ndarray):
        """``scaled``: the directions, times the weight of each term."""
        self.ids, self.words, self.answers = ids, words, answers
        self.vectors = np.zeros((len(ids), scaled.shape[1]), np.float32)
        for k, w in enumerate(words):
            x = scaled[dims_of(np.array(w, np.int64))].sum(0)
            self.vectors[k] = x / max(float(np.linalg.norm(x)), 1e-9)
        self.counts = [Counter(w) for w in words]
        self.places = [places(w) for w in self.words]
        self.answer_places = [places(w) for w in self.answers]
        self.lengths = np.array([len(w) for w in words], np.int64)
        flat = np.array([x for w in words for x in w], np.int64)
        self.bits = word_bits(flat, np.repeat(np.arange(len(words)), self.lengths), len(words))
        # classes of length, each with the words of its items, filled up with a column that is never set
        self.size = np.ceil(np.log2(np.maximum(self.lengths, 1))).astype(np.int64)
        self.row, self.tables = np.zeros(len(words), np.int64), {}
        for z in np.unique(self.size):
            own = np.flatnonzero(self.size == z)
            self.row[own] = np.arange(len(own))
            table = np.full((len(own), self.lengths[own].max()), NEAR + 1, np.int64)
            for k, i in enumerate(own):
                table[k, : self.lengths[i]] = np.array(words[i], np.int64) & (NEAR - 1)
            self.tables[int(z)] = table


def may_have(bits: np.ndarray, own: np.ndarray, block: np.ndarray, item: np.ndarray, items: Items, share: float) -> np.ndarray:
    """Which candidates (passage at ``block``, item) the bits of the blocks around the passage allow ``share`` of the item's words.

    A class of words that the item has and none of these blocks is a word of it at least that the text lacks there, so
    none that :func:`may_share` lets pass is left out. ``own`` names the text of each block.
    """
    out = np.ones(len(item), bool)
    for z, table in items.tables.items():
        reach, some = table.shape[1], np.flatnonzero(items.size[item] == z)
        if 2 * (reach + BLOCK) > BITS or not len(some):
            continue
        place, row = np.unique(block[some], return_inverse=True)
        low, high = np.searchsorted(own, own[place]), np.searchsorted(own, own[place], side="right") - 1
        near, away = bits[place], -(-reach // BLOCK)
        for k in range(-away, away + 2):
            near |= bits[np.clip(place + k, low, high)]
        for a in range(0, len(some), 1 << 13):
            part = some[a : a + (1 << 13)]
            lacks = np.bitwise_count(items.bits[item[part]] & ~near[row[a : a + (1 << 13)]]).sum(1, dtype=np.int64)
            n = items.lengths[item[part]]
            out[part] = n - lacks >= share * n
    return out


def may_share(words: np.ndarray, low: np.ndarray, high: np.ndarray, at: np.ndarray, item: np.ndarray, items: Items, share: float) -> np.ndarray:
    """Which candidates may share ``share`` of the item's words with the text around the passage; none that does is left out.

    A candidate is the passage at word ``at`` of ``words`` (sorted), in a text from ``low`` to ``high``, and an item.
    """
    out = np.zeros(len(item), bool)
    short = (words & (NEAR - 1)).astype(np.int64)
    for z, table in items.tables.items():
        own = np.flatnonzero(items.size[item] == z)
        if not len(own):
            continue
        reach = table.shape[1]
        place, head, row = np.unique(at[own], return_index=True, return_inverse=True)
        head, step = own[head], int(np.clip((1 << 17) // (2 * reach + 2 * BLOCK), 1, 256))
        seen = np.zeros((step, NEAR + 2), bool)
        bounds = np.searchsorted(row, np.arange(0, len(place) + step, step))
        for k, a in enumerate(range(0, len(place), step)):
            here, some = head[a : a + step], own[bounds[k] : bounds[k + 1]]
            x = (place[a : a + step] - reach)[:, None] + np.arange(2 * reach + 2 * BLOCK)
            inside = (x >= low[here][:, None]) & (x < high[here][:, None])
            x = np.where(inside, short[np.clip(x, 0, len(short) - 1)], NEAR)
            r = np.arange(len(here))[:, None]
            seen[r, x] = True
            for b in range(0, len(some), 1 << 14):
                i, p = item[some[b : b + (1 << 14)]], row[bounds[k] + b : min(bounds[k] + b + (1 << 14), bounds[k + 1])] - a
                shared = seen[p[:, None], table[items.row[i]]].sum(1)
                out[some[b : b + (1 << 14)]] = shared >= share * items.lengths[i]
            seen[r, x] = False
    return out


def hits_in(words: np.ndarray, lengths: np.ndarray, items: Items, weight: np.ndarray, scaled: np.ndarray, limits: tuple) -> list[tuple]:
    """(text, item, word, cosine, share, answer) of every confirmed match; the best one a text and item."""
    cosine, verbatim, paraphrase = limits
    sums, squares, own, word = block_sums(words, lengths, scaled, weight)
    best: dict[tuple[int, int], tuple] = {}
    x, _, first = passages(sums, squares, own)
    starts = np.cumsum(lengths) - lengths
    # as many words as each block has
    sizes = np.minimum(lengths[own] - word, BLOCK)
    bits = word_bits(words, np.repeat(np.arange(len(own)), sizes), len(own))
    for a in range(0, len(first), 4096):
        part = x[a : a + 4096] / np.maximum(np.linalg.norm(x[a : a + 4096], axis=1), 1e-9)[:, None]
        c = part @ items.vectors.T
        of, item = np.divmod(np.flatnonzero(c.ravel() >= cosine), c.shape[1])
        may = may_have(bits, own, first[a + of], item, items, paraphrase)
        of, item = of[may], item[may]
        f, t = first[a + of], own[first[a + of]]
        may = may_share(words, starts[t], starts[t] + lengths[t], starts[t] + word[f], item, items, paraphrase)
        for p, i in zip(of[may].tolist(), item[may].tolist(), strict=True):
            f = first[a + p]
            t, at, n = int(own[f]), int(word[f]), len(items.words[i])
            lo, hi = max(0, at - n), min(int(lengths[t]), at + 2 * BLOCK + n)
            near = words[starts[t] + lo : starts[t] + hi].tolist()
            # words of the item that the passage lacks bound the subsequence from above
            if sum(items.counts[i][w] for w in items.counts[i].keys() & set(near)) < paraphrase * n:
                continue
            share = common_words(items.places[i], n, near) / n
            if share < paraphrase or (t, i) in best and best[t, i][1] >= share:
                continue
            answer = items.answers[i]
            found = common_words(items.answer_places[i], len(answer), near) == len(answer)
            if share >= verbatim or found:
                best[t, i] = (float(c[p, i]), share, found, at)
    return [(t, items.ids[i], v[3], v[0], v[1], v[2]) for (t, i), v in best.items()]


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    cosine: float = COSINE,
    verbatim: float = VERBATIM,
    paraphrase: float = PARAPHRASE,
) -> DataFrame:
    """(doc_id, item_id, word, cosine, lcs_share, has_answer): the benchmark items that each document holds.

    Idf, directions, projection and search cover all documents. Items are searched in blocks of ``ITEMS_PER_PASS``,
    each with directions of its own, fitted by three passes over the documents, and a pass that searches them.
    """
    spark = docs.sparkSession
    small_batches(spark, 256)
    # words are split and hashed once for the counts, the directions and the search
    hashed = stage(docs.select("doc_id", terms(F.col("text")).alias("w")), "terms")
    sentences = F.filter(F.split(F.coalesce("text", F.lit("")), "[.!?]+\\s*"), lambda x: x.rlike("[\\p{L}\\p{N}]"))
    last = F.when(F.size(sentences) > 1, terms(F.element_at(sentences, -1)))
    bench = benchmark.where(F.col("item_id").isNotNull()).select(
        "item_id", terms(F.col("text")).alias("w"), F.coalesce(last, F.array().cast("array<bigint>")).alias("last")
    )
    bench = bench.where(F.size("w") >= LEAST)
    tail = F.slice("w", F.greatest(F.size("w") - ANSWER + 1, F.lit(1)), F.lit(ANSWER))
    bench = bench.withColumn("answer", F.when(F.size("last") >= 3, F.col("last")).otherwise(tail)).drop("last")
    df, n, blocks, words = document_counts(hashed)
    weight = (np.log((1 + n) / (1 + df)) + 0.05).astype(np.float32)
    passes = max(1, -(-bench.count() // ITEMS_PER_PASS))
    out = None
    for k in range(passes):
        some = bench.where(F.pmod(F.xxhash64("item_id"), F.lit(passes)) == k)
        scaled = fit_directions(hashed, some, weight, blocks, words)
        scaled *= weight[:, None]
        rows = some.orderBy("item_id", "w").collect()
        items = [r["item_id"] for r in rows], [list(r["w"]) for r in rows], [list(r["answer"]) for r in rows]
        hits = _search(hashed, items, bench.schema["item_id"].dataType, weight, scaled, (cosine, verbatim, paraphrase))
        out = hits if out is None else out.unionByName(hits)
    return out.groupBy("doc_id", "item_id").agg(
        F.min("word").alias("word"),
        F.max("cosine").alias("cosine"),
        F.max("lcs_share").alias("lcs_share"),
        F.max("has_answer").alias("has_answer"),
    )


def _search(hashed: DataFrame, items: tuple, id_type: DataType, weight: np.ndarray, scaled: np.ndarray, limits: tuple) -> DataFrame:
    shared = hashed.sparkSession.sparkContext.broadcast((weight, scaled.astype(np.float32, copy=False), items))
    kinds = {f.name: f.dataType.simpleString() for f in hashed.schema.fields}

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        w, table, given = shared.value
        own, table = Items(*given, table), with_zeros(table)
        for b in batches:
            words, lengths = _flat(b.column(1))
            found = hits_in(words, lengths, own, w, table, limits) if len(words) and own.ids else []
            text = pa.array([x[0] for x in found], pa.int64())
            cols = [pa.array([x[k] for x in found], t) for k, t in ((1, to_arrow_type(id_type)), (2, pa.int64()), (3, pa.float64()), (4, pa.float64()), (5, pa.bool_()))]
            yield pa.RecordBatch.from_arrays([b.column(0).take(text), *cols], names=["doc_id", "item_id", "word", "cosine", "lcs_share", "has_answer"])

    return hashed.mapInArrow(
        run, f"doc_id {kinds['doc_id']}, item_id {id_type.simpleString()}, word long, cosine double, lcs_share double, has_answer boolean"
    )
