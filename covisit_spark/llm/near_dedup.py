"""MinHash near-dedup: DartMinHash signatures of weighted shingles, banded joining, exact check.

A document is the multiset of its five-word shingles, a shingle's weight the number of times it occurs.
Darts are thrown into the (weight, rank) plane of each element, one on average in each unit cell, all
from hashes of element and cell; those under the element's weight and under a rank limit of about
(k ln k + 2k) / total weight are the document's. A hash deals each dart to one of k coordinates, and each
coordinate keeps the dart of the lowest rank: two documents agree there with probability of their weighted
Jaccard similarity. Documents that agree in a band of coordinates meet in a bucket; candidates are
checked exactly.

Copies (the same words in the same order) are one class before any signature is compared. Defined
results: null, empty and blank texts have no words and are copies of each other; texts of one to four
words are one shingle; rows with a null ``doc_id`` take no part (class null); a repeated row gets its
document's class.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covisit_spark.llm.common import small_batches, stage, word_hashes
from covisit_spark.llm.links import components, linked

SHINGLE, BANDS, ROWS, THRESHOLD = 5, 26, 5, 0.8
# Longs of a text's sketch: the parity of its number of shingles in each of 64 times as many classes.
SKETCH = 16
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def unit(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(11)).astype(np.float64) * 2.0**-53


def poisson_steps() -> np.ndarray:
    """Distribution function of the number of darts in a unit cell."""
    p, total, out = np.exp(-1.0), 0.0, []
    for k in range(1, 20):
        total += p
        out.append(total)
        p /= k
    return np.array(out)


def shingles(words: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of texts laid end to end, and the text of each."""
    words = words.astype(np.uint64)
    ends = np.cumsum(lengths)
    own = np.repeat(np.arange(len(lengths)), lengths)
    h = np.zeros(len(words), np.uint64)
    for k in range(SHINGLE):  # words after a short text's end count as none
        w = np.zeros(len(words), np.uint64)
        stop = max(0, len(words) - k)
        w[:stop] = words[k:]
        if k:
            w[np.arange(len(words)) + k >= ends[own]] = 0
        h = mix(h * GOLDEN + w + np.uint64(k + 1))
    place = np.arange(len(words)) - (ends - lengths)[own]
    real = place < np.maximum(lengths - SHINGLE + 1, 1)[own]
    return h[real], own[real]


def weighted(h: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (element, text, weight): how often each shingle occurs in its text."""
    order = np.lexsort((h, own))
    h, own = h[order], own[order]
    new = np.append(True, (h[1:] != h[:-1]) | (own[1:] != own[:-1])) if len(h) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    return h[at], own[at], np.diff(np.append(at, len(h))).astype(np.float64)


def throw(element: np.ndarray, own: np.ndarray, weight: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All darts under each element's weight and its text's rank limit: (text, id, rank)."""
    steps = poisson_steps()
    top = limit[own]
    texts, ids, ranks = [], [], []
    with np.errstate(over="ignore"):
        for v in range(64):
            low_w = 2.0**v - 1
            heavy = np.flatnonzero(weight > low_w)
            if not len(heavy):
                break
            for r in range(64):
                low_r = 2.0**r - 1
                e = heavy[top[heavy] > low_r]
                if not len(e):
                    break
                wide, high = 2.0 ** (v - r), 2.0 ** (r - v)
                across = np.minimum(2**r, np.ceil((weight[e] - low_w) / wide)).astype(np.int64)
                up = np.minimum(2**v, np.ceil((top[e] - low_r) / high)).astype(np.int64)
                cells = across * up
                which = np.repeat(np.arange(len(e)), cells)
                cell = np.arange(len(which)) - np.repeat(np.cumsum(cells) - cells, cells)
                w, q = np.divmod(cell, up[which])
                seed = mix(element[e][which] + np.uint64(v * 64 + r + 1) * GOLDEN)
                seed = mix(seed + w.astype(np.uint64) * GOLDEN)
                seed = mix(seed + q.astype(np.uint64) * GOLDEN + np.uint64(1))
                count = np.searchsorted(steps, unit(seed), side="right")
                for j in range(int(count.max(initial=0))):
                    hit = np.flatnonzero(count > j)
                    dart = mix(seed[hit] + np.uint64(j + 1) * GOLDEN)
                    x = low_w + (w[hit] + unit(mix(dart + np.uint64(1)))) * wide
                    y = low_r + (q[hit] + unit(mix(dart + np.uint64(2)))) * high
                    own_e = e[which[hit]]
                    good = (x < weight[own_e]) & (y < top[own_e])
                    texts.append(own[own_e[good]])
                    ids.append(dart[good])
                    ranks.append(y[good])
    if not texts:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0)
    return np.concatenate(texts), np.concatenate(ids), np.concatenate(ranks)


def dart_signatures(element: np.ndarray, own: np.ndarray, weight: np.ndarray, n: int, k: int) -> np.ndarray:
    """(n, k) dart ids; texts without elements keep zeros. Texts with an empty coordinate are thrown at again, twice as high."""
    out = np.zeros((n, k), np.uint64)
    total = np.bincount(own, weight, n)
    darts = k * np.log(k) + 2 * k
    todo = np.flatnonzero(total > 0)
    while len(todo):
        limit = np.zeros(n)
        limit[todo] = darts / total[todo]
        mine = limit[own] > 0
        text, dart, rank = throw(element[mine], own[mine], weight[mine], limit)
        coordinate = (mix(dart + np.uint64(7)) % np.uint64(k)).astype(np.int64)
        slot = text * k + coordinate
        order = np.lexsort((dart, rank, slot))
        first = order[np.append(True, slot[order][1:] != slot[order][:-1])] if len(order) else order
        full = np.zeros((n, k), bool)
        full[text[first], coordinate[first]] = True
        done = todo[full[todo].all(1)]
        keep = np.zeros(n, bool)
        keep[done] = True
        use = first[keep[text[first]]]
        out[text[use], coordinate[use]] = dart[use]
        todo = np.setdiff1d(todo, done)
        darts *= 2
    return out


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    h = np.zeros((len(signature), bands), np.uint64) + np.arange(1, bands + 1, dtype=np.uint64) * GOLDEN
    for r in range(rows):
        h = mix(h * GOLDEN + signature[:, r * bands : (r + 1) * bands])
    return h.astype(np.int64)


def _flat(column) -> tuple[np.ndarray, np.ndarray]:
    import pyarrow.compute as pc

    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    return column.flatten().to_numpy(zero_copy_only=False), lengths


def signatures(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, copy, bands): a digest of the word sequence, and the band keys (empty without words)."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            words, lengths = _flat(b.column(1))
            ends = np.cumsum(lengths)
            copies = [hashlib.md5(words[e - n : e].tobytes()).digest() for e, n in zip(ends, lengths, strict=True)]
            element, own, weight = weighted(*shingles(words, lengths))
            keys = band_keys(dart_signatures(element, own, weight, len(lengths), bands * rows), bands, rows)
            lists = [k.tolist() if n else [] for k, n in zip(keys, lengths, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(copies, pa.binary()), pa.array(lists, pa.list_(pa.int64()))], names=["doc_id", "copy", "bands"]
            )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", word_hashes(F.col("text")).alias("w")).mapInArrow(
        run, f"doc_id {id_type}, copy binary, bands array<bigint>"
    )


def parities(h: np.ndarray, own: np.ndarray, n: int) -> np.ndarray:
    """(n, SKETCH) longs: a bit for each class of elements, set if a text has an odd number of it.

    An element that only one of two texts has changes one bit, so they have at least as many of these as bits that differ.
    """
    classes = SKETCH * 64
    slot = own.astype(np.int64) * classes + (mix(h.astype(np.uint64) + GOLDEN) % np.uint64(classes)).astype(np.int64)
    odd = np.zeros(n * classes, np.uint8)
    slots, times = np.unique(slot, return_counts=True)
    odd[slots] = times & 1
    return np.packbits(odd).view(np.int64).reshape(n, SKETCH)


def may_be_similar(threshold: float) -> Callable[[str, str], Column]:
    """False of two texts of (size, sketch) whose similarity is under ``threshold`` for certain."""

    def may(x: str, y: str) -> Column:
        bits = [F.get(f"sketch{x}", F.lit(k)).bitwiseXOR(F.get(f"sketch{y}", F.lit(k))) for k in range(SKETCH)]
        differ = sum((F.bit_count(b) for b in bits), F.lit(0))
        # of n in both lists, at most i = (n - differ) / 2 are shared; the similarity is i / (n - i)
        n = F.col(f"size{x}") + F.col(f"size{y}")
        return n - differ >= threshold * (n + differ) - 1e-9

    return may


def shingle_sets(docs: DataFrame) -> DataFrame:
    """(id, s, sketch): the multiset of shingles as a set, the j-th copy of a shingle being an element of its own."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            words, lengths = _flat(b.column(1))
            element, own, weight = weighted(*shingles(words, lengths))
            copies = weight.astype(np.int64)
            at = np.repeat(np.arange(len(element)), copies)
            j = np.arange(len(at)) - np.repeat(np.cumsum(copies) - copies, copies)
            h = mix(element[at] + j.astype(np.uint64) * GOLDEN).astype(np.int64)
            sizes = np.bincount(own[at], minlength=len(lengths))
            s = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), pa.array(h))
            bits = pa.ListArray.from_arrays(pa.array(np.arange(len(lengths) + 1) * SKETCH, pa.int32()), pa.array(parities(h, own[at], len(lengths)).ravel()))
            yield pa.RecordBatch.from_arrays([b.column(0), s, bits], names=["id", "s", "sketch"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", word_hashes(F.col("text")).alias("w")).mapInArrow(run, f"id {id_type}, s array<bigint>, sketch array<bigint>")


def candidate_sets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, s) of the documents named by ``ids``; the texts are shuffled once, by a plan of one form at any size."""
    wanted = ids.select(F.col("id").alias("doc_id")).hint("shuffle_hash")
    return shingle_sets(docs.join(wanted, "doc_id", "left_semi").dropDuplicates(["doc_id"]))


def common_parts(ids: DataFrame, sets: DataFrame) -> DataFrame:
    """(id, size, common, sketch): the number of shingles, and of those that another one of ``ids`` has too."""
    own = sets.join(ids, "id", "left_semi")
    alone = (
        own.select("id", F.explode("s").alias("x"))
        .groupBy("x")
        .agg(F.count("*").alias("n"), F.min("id").alias("id"))
        .where("n = 1")
        .groupBy("id")
        .agg(F.count("*").alias("alone"))
    )
    size = F.size("s")
    return own.join(alone, "id", "left").select(
        "id", size.alias("size"), (size - F.coalesce("alone", F.lit(0))).alias("common"), "sketch"
    )


def similar(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) of ids whose weighted Jaccard similarity is ``threshold`` or more."""
    both = pairs.join(sets.select(F.col("id").alias("a"), F.col("s").alias("sa")), "a").join(
        sets.select(F.col("id").alias("b"), F.col("s").alias("sb")), "b"
    )
    shared = F.size(F.array_intersect("sa", "sb"))
    found = both.select("a", "b", shared.alias("i"), (F.size("sa") + F.size("sb")).alias("n"))
    return found.where(F.col("i") >= threshold * (F.col("n") - F.col("i")) - 1e-9).select("a", "b")


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, class_id) for every row of ``docs``: the least document id of the connected group."""
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = stage(signatures(given, bands, rows), "signatures")
    known = signed.where(F.col("doc_id").isNotNull())
    texts = stage(known.groupBy("copy").agg(F.min("doc_id").alias("id"), F.first("bands").alias("bands")), "copies")
    buckets = texts.select("id", F.explode("bands").alias("bucket")).distinct()
    links = linked(
        buckets,
        lambda ids: candidate_sets(given, ids),
        lambda pairs, sets: similar(pairs, sets, threshold),
        common_parts,
        threshold,
        may_be_similar(threshold),
    )
    groups = components(links)
    classes = texts.select("copy", "id").join(groups, "id", "left").select("copy", F.coalesce("component", "id").alias("class_id"))
    out = known.select("doc_id", "copy").join(classes, "copy").select("doc_id", "class_id")
    none = signed.where(F.col("doc_id").isNull())
    return out.unionByName(none.select("doc_id", F.col("doc_id").alias("class_id")))


def keep_one(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` with one document of each class, that of the least id; rows without an id all stay."""
    classes = near_duplicates(docs, **settings)
    first = classes.where(F.col("doc_id") == F.col("class_id")).select("doc_id").distinct()
    kept = docs.join(first, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return kept.unionByName(docs.where(F.col("doc_id").isNull()))
