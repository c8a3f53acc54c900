"""Quality classifier: a byte-level convolutional network in numpy.

Filters of ``WIDTH`` bytes over one-hot bytes are tables of weights, so a convolution is a few table
look-ups. The responses over a text are max-pooled in chunks of two segments, each overlapping the next
by one segment, up to the end of the text; the means and the maxima of the chunks' features enter one
logistic unit. Trained with Adam on the driver from a bounded, stratified sample of labelled rows; every
whole text is scored in Arrow batches on the executors.

Defined results: null and empty texts are scored as a run of padding; repeated rows get equal scores;
rows with a null ``doc_id`` are scored but never learned from; without labels of both kinds every score is
the share of good labels (0.5 with none). Scores depend on the text alone.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from covisit_spark.llm.common import fold, labelled, small_batches

WIDTH, FILTERS, SEGMENT = 4, 16, 128
PAD = 0


def segments(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all texts end to end, and where segments start: (bytes, starts, document of each, first of each).

    Each text is padded to a whole number of segments, two at least, with room for ``WIDTH - 1`` pad bytes.
    """
    raw = [(t or "").encode("utf-8", "replace") for t in texts]
    counts = np.array([max(2, -(-(len(b) + WIDTH - 1) // SEGMENT)) for b in raw], dtype=np.int64)
    data = b"".join(b + bytes(int(n) * SEGMENT - len(b)) for b, n in zip(raw, counts, strict=True)) + bytes(WIDTH - 1)
    first = np.concatenate([[0], np.cumsum(counts)[:-1]])
    return np.frombuffer(data, np.uint8), np.arange(counts.sum()) * SEGMENT, np.repeat(np.arange(len(raw)), counts), first


def text_ends(doc: np.ndarray) -> np.ndarray:
    """The last segment of each text: its last places are padding that looks into the next text."""
    return np.flatnonzero(np.append(doc[1:] != doc[:-1], True))


def convolve(data: np.ndarray, weights: np.ndarray, doc: np.ndarray, block: int = 1 << 12) -> np.ndarray:
    """Largest response of each filter in each segment; bounded memory by blocks of segments."""
    n, ends = len(doc), text_ends(doc)
    out = np.empty((n, FILTERS), np.float32)
    for a in range(0, n, block):
        b = min(n, a + block)
        part = data[a * SEGMENT : b * SEGMENT + WIDTH - 1]
        m = (b - a) * SEGMENT
        y = weights[0].take(part[:m], axis=0)
        for k in range(1, WIDTH):
            y += weights[k].take(part[k : k + m], axis=0)
        y = y.reshape(b - a, SEGMENT, FILTERS)
        y[ends[(ends >= a) & (ends < b)] - a, SEGMENT - WIDTH + 1 :] = -np.inf
        out[a:b] = y.max(axis=1)
    return out


def pooled(seg: np.ndarray, doc: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Chunk maxima (segments s and s+1 of one text), and per text their number and row range."""
    inside = np.flatnonzero(doc[:-1] == doc[1:])
    chunk = np.maximum(seg[inside], seg[inside + 1])
    starts = first - np.arange(len(first))  # one chunk fewer than segments in each text before
    return chunk, starts, inside


def features(chunk: np.ndarray, starts: np.ndarray, bias: np.ndarray) -> np.ndarray:
    act = np.maximum(chunk + bias, 0)
    size = np.diff(np.append(starts, len(chunk)))[:, None]
    return np.concatenate([np.add.reduceat(act, starts, axis=0) / size, np.maximum.reduceat(act, starts, axis=0)], axis=1)


class Network:
    """Filter tables, their biases, and the logistic unit."""

    def __init__(self, seed: int = 0):
        r = np.random.default_rng(seed)
        self.w = r.normal(0, 0.15, (WIDTH, 256, FILTERS)).astype(np.float32)
        self.b = np.zeros(FILTERS, np.float32)
        self.v = r.normal(0, 0.3, 2 * FILTERS).astype(np.float32)
        self.c = np.zeros(1, np.float32)
        self.prior: float | None = None

    def score(self, texts: list[str | None]) -> np.ndarray:
        if self.prior is not None:
            return np.full(len(texts), self.prior)
        if not texts:
            return np.zeros(0)
        data, _, doc, first = segments(texts)
        chunk, starts, _ = pooled(convolve(data, self.w, doc), doc, first)
        z = features(chunk, starts, self.b) @ self.v + self.c
        return 1 / (1 + np.exp(-np.clip(z.astype(np.float64), -30, 30)))

    def gradients(self, texts: list[str], y: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
        data, at, doc, first = segments(texts)
        n = len(at)
        resp = self.w[0].take(data[: n * SEGMENT], axis=0)
        for k in range(1, WIDTH):
            resp += self.w[k].take(data[k : k + n * SEGMENT], axis=0)
        resp = resp.reshape(n, SEGMENT, FILTERS)
        resp[text_ends(doc), SEGMENT - WIDTH + 1 :] = -np.inf
        place = resp.argmax(axis=1)
        seg = np.take_along_axis(resp, place[:, None], axis=1)[:, 0]
        chunk, starts, inside = pooled(seg, doc, first)
        x = features(chunk, starts, self.b)
        p = 1 / (1 + np.exp(-np.clip(x @ self.v + self.c, -30, 30)))
        dz = (p - y) * weight / weight.sum()
        size = np.diff(np.append(starts, len(chunk)))
        of = np.repeat(np.arange(len(texts)), size)
        act = np.maximum(chunk + self.b, 0)
        top = act == x[of, FILTERS:]
        dact = (dz / size)[of, None] * self.v[:FILTERS] + dz[of, None] * self.v[FILTERS:] * top
        dact *= act > 0
        # to the segment that holds the chunk's maximum, and there to the place of it
        late = seg[inside + 1] > seg[inside]
        dseg = np.zeros_like(seg)
        np.add.at(dseg, inside, np.where(late, 0, dact))
        np.add.at(dseg, inside + 1, np.where(late, dact, 0))
        dw = np.zeros_like(self.w)
        s, f = np.nonzero(dseg)
        for k in range(WIDTH):
            np.add.at(dw[k], (data[at[s] + place[s, f] + k], f), dseg[s, f])
        return [dw + 1e-4 * self.w, dact.sum(0), x.T @ dz + 1e-3 * self.v, np.array([dz.sum()])]


def train(texts: list[str], y: np.ndarray, epochs: int = 12, batch: int = 48, rate: float = 0.02, seed: int = 0, least_steps: int = 300) -> Network:
    """Adam on the logistic loss, both classes with the same total weight; few rows are gone over more often."""
    net = Network(seed)
    if len(set(y.tolist())) < 2:
        net.prior = float(y.mean()) if len(y) else 0.5
        return net
    weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum())).astype(np.float32)
    params = [net.w, net.b, net.v, net.c]
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    r, t = np.random.default_rng(seed), 0
    epochs = max(epochs, -(-least_steps // -(-len(y) // batch)))
    steps = epochs * -(-len(y) // batch)
    for _ in range(epochs):
        order = r.permutation(len(y))
        for a in range(0, len(y), batch):
            own = order[a : a + batch]
            t += 1
            pace = rate * (1 - t / (steps + 1))
            for p, g, mi, vi in zip(params, net.gradients([texts[i] for i in own], y[own], weight[own]), m, v, strict=True):
                mi += 0.1 * (g - mi)
                vi += 0.01 * (g * g - vi)
                p -= pace * (mi / (1 - 0.9**t)) / (np.sqrt(vi / (1 - 0.99**t)) + 1e-7)
    return net


def training_rows(docs: DataFrame, labels: DataFrame, per_class: int, max_chars: int) -> tuple[list[str], np.ndarray]:
    """At most ``per_class`` labelled texts of each label, not of the held-out fold, by hash order.

    For fitting only, a text longer than ``max_chars`` is represented by eight pieces of that length in all,
    spaced evenly over it: the driver gets 2 x per_class x max_chars characters at most.
    """
    usable = labelled(labels, "quality").where(fold(F.col("doc_id")) != 2)
    ranked = []
    for y in (0, 1):
        ranked.append(usable.where(F.col("y") == y).orderBy(F.xxhash64(F.lit(5), "doc_id"), "doc_id").limit(per_class))
    chosen = ranked[0].unionByName(ranked[1])
    text, piece = F.coalesce(F.col("text"), F.lit("")), max_chars // 8
    step = ((F.length(text) - piece) / 7).cast("int")
    spaced = F.concat(*[F.substr(text, step * k + 1, F.lit(piece)) for k in range(8)])
    rows = (
        docs.select("doc_id", F.when(F.length(text) > max_chars, spaced).otherwise(text).alias("text"))
        .join(chosen, "doc_id")
        .groupBy("doc_id")
        .agg(F.min("text").alias("text"), F.min("y").alias("y"))
        .orderBy("doc_id")
        .collect()
    )
    return [r["text"] for r in rows], np.array([r["y"] for r in rows], np.float32)


def _packed(net: Network) -> bytes:
    out = io.BytesIO()
    np.savez(out, w=net.w, b=net.b, v=net.v, c=net.c, prior=np.array(-1.0 if net.prior is None else net.prior))
    return out.getvalue()


def _unpacked(data: bytes) -> Network:
    net, got = Network(), np.load(io.BytesIO(data))
    net.w, net.b, net.v, net.c = (got[k] for k in "wbvc")
    net.prior = float(got["prior"]) if got["prior"] >= 0 else None
    return net


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 1_200, max_chars: int = 4_096) -> Network:
    return train(*training_rows(docs, labels, per_class, max_chars))


def score(docs: DataFrame, net: Network, keep: list[str] | None = None, name: str = "quality_score") -> DataFrame:
    """``docs`` with the score as column ``name``, in place of one of that name; ``keep`` names the columns to carry along (all by default)."""
    small_batches(docs.sparkSession)
    kept = docs.select(*[c for c in (keep if keep is not None else docs.columns) if c != name])
    if "text" not in kept.columns:
        kept = kept.withColumn("text", docs["text"])
    schema = T.StructType([*kept.schema.fields, T.StructField(name, T.DoubleType())])
    data = _packed(net)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        model = _unpacked(data)
        for b in batches:
            s = model.score(b.column(b.schema.get_field_index("text")).to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s, pa.float64())], names=[*b.schema.names, name])

    return kept.mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, **fit_args) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    net = fit(docs, labels, **fit_args)
    return score(docs, net, ["doc_id", "text"]).select(
        "doc_id",
        (fold(F.col("doc_id")) == 2).alias("held_out"),
        F.col("quality_score").alias("score"),
        (F.col("quality_score") >= threshold).cast("int").alias("predicted"),
    )


def accuracy(y: np.ndarray, predicted: np.ndarray) -> float:
    return float(pd.Series(y == predicted).mean())
