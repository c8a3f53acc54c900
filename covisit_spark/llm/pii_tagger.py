"""Personal data: fixed patterns, and a character BiLSTM with CRF transitions in numpy.

The patterns find the base spans. The tagger learns from labelled spans (those that the patterns find in
a bounded sample of documents) and adds spans that look alike and that the patterns miss. Windows of ``WINDOW``
characters start every half window over the whole text; each is decoded on its own, a character
takes its tag from the window in whose middle half it lies, and runs of one tag, over all windows, are spans.
Every kind holds a digit or an ``@``, which a span must have: so only windows in reach of such a character can
hold part of a span, and only those are decoded.

Defined results: a null text is read as empty and has no spans; repeated rows are scanned each; where
the sample has no base span the tagger is not trained and adds nothing. Offsets are code points.
"""

from __future__ import annotations

import hashlib
import io
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covisit_spark.llm.common import bounded_sample, small_batches

# The kinds in their order, and their patterns written so that no start is tried twice.
KINDS = ["email", "ip", "card", "phone"]
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
TRIGGER = re.compile(r"[0-9@]")

WINDOW, HIDDEN, TAGS, CHARS = 64, 12, 5, 130
REACH = 2 * WINDOW


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Each ``@`` with a domain after it, and the run of local characters before it."""
    out, end = [], 0
    for m in DOMAIN.finditer(text):
        a = m.start()
        while a > end and text[a - 1] in LOCAL:
            a -= 1
        if a < m.start():
            out.append((a, m.end()))
            end = m.end()
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the patterns' spans, sorted."""
    out = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    if not TRIGGER.search(text):
        return out
    for m in IP.finditer(text):
        # a run of over 9 digits may still be a small number with zeros before it
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def codes(text: str) -> np.ndarray:
    """Character classes: ASCII as it is, any other letter 128, padding 129."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.minimum(c, 128).astype(np.uint8)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


class Tagger:
    """One LSTM each way over one-hot characters, a linear layer to tags, and CRF transitions."""

    def __init__(self, seed: int = 0):
        r = np.random.default_rng(seed)
        h = HIDDEN
        self.p = {}
        for d in "fb":
            self.p["x" + d] = r.normal(0, 0.2, (CHARS, 4 * h))
            self.p["u" + d] = r.normal(0, 0.2, (h, 4 * h))
            self.p["x" + d][:, h : 2 * h] += 0.5  # remember at first
        self.p["o"] = r.normal(0, 0.2, (2 * h, TAGS))
        self.p["c"] = np.zeros(TAGS)
        self.p["t"] = np.zeros((TAGS, TAGS))
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}
        self.trained = False

    def _pass(self, x: np.ndarray, d: str, keep: bool) -> tuple[np.ndarray, list]:
        """Hidden states (time, batch, h) of one direction; with ``keep`` also what the way back needs."""
        n, time = x.shape
        h, hs, kept = HIDDEN, np.empty((time, n, HIDDEN), np.float32), []
        s, c = np.zeros((n, h), np.float32), np.zeros((n, h), np.float32)
        for t in range(time) if d == "f" else reversed(range(time)):
            z = self.p["x" + d].take(x[:, t], axis=0) + s @ self.p["u" + d]
            g = _sigmoid(z[:, : 3 * h])
            a = np.tanh(z[:, 3 * h :])
            before = (s, c)
            c = g[:, h : 2 * h] * c + g[:, :h] * a
            tc = np.tanh(c)
            s = g[:, 2 * h :] * tc
            hs[t] = s
            if keep:
                kept.append((t, g, a, tc, *before))
        return hs, kept

    def emissions(self, x: np.ndarray) -> np.ndarray:
        f, b = self._pass(x, "f", False)[0], self._pass(x, "b", False)[0]
        h = HIDDEN
        return f @ self.p["o"][:h] + b @ self.p["o"][h:] + self.p["c"]

    def decode(self, x: np.ndarray) -> np.ndarray:
        """The best tag path of each window (Viterbi)."""
        e = self.emissions(x)
        time, n, _ = e.shape
        back = np.empty((time, n, TAGS), np.int8)
        s = e[0]
        for t in range(1, time):
            m = s[:, :, None] + self.p["t"]
            back[t] = m.argmax(1)
            s = m.max(1) + e[t]
        out = np.empty((n, time), np.int8)
        out[:, -1] = s.argmax(1)
        for t in range(time - 1, 0, -1):
            out[:, t - 1] = back[t][np.arange(n), out[:, t]]
        return out

    def gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean negative log-likelihood of the tag paths ``y``."""
        p, h = self.p, HIDDEN
        (f, kf), (b, kb) = self._pass(x, "f", True), self._pass(x, "b", True)
        e = f @ p["o"][:h] + b @ p["o"][h:] + p["c"]
        time, n, _ = e.shape

        def lse(m, axis):
            top = m.max(axis, keepdims=True)
            return (top + np.log(np.exp(m - top).sum(axis, keepdims=True))).squeeze(axis)

        fw, bw = [e[0]], [np.zeros((n, TAGS), np.float32)]
        for t in range(1, time):
            fw.append(lse(fw[-1][:, :, None] + p["t"], 1) + e[t])
            bw.append(lse(p["t"] + (e[time - t] + bw[-1])[:, None, :], 2))
        bw = bw[::-1]
        z = lse(fw[-1], 1)
        rows = np.arange(n)
        g = {k: np.zeros_like(v) for k, v in p.items()}
        de = np.exp(np.stack(fw) + np.stack(bw) - z[None, :, None])
        for t in range(time):
            de[t, rows, y[:, t]] -= 1
            if t:
                pair = np.exp(fw[t - 1][:, :, None] + p["t"] + (e[t] + bw[t])[:, None, :] - z[:, None, None])
                g["t"] += pair.sum(0)
                np.add.at(g["t"], (y[:, t - 1], y[:, t]), -1)
        de /= n
        g["t"] /= n
        g["c"] = de.sum((0, 1))
        for d, hs, kept, part in (("f", f, kf, slice(0, h)), ("b", b, kb, slice(h, 2 * h))):
            g["o"][part] = np.einsum("tnh,tnk->hk", hs, de)
            dh = de @ p["o"][part].T
            ds, dc = np.zeros((n, h), np.float32), np.zeros((n, h), np.float32)
            for t, gate, a, tc, s0, c0 in reversed(kept):
                ds = ds + dh[t]
                i, fo, o = gate[:, :h], gate[:, h : 2 * h], gate[:, 2 * h :]
                dc = dc + ds * o * (1 - tc * tc)
                dz = np.concatenate(
                    [dc * a * i * (1 - i), dc * c0 * fo * (1 - fo), ds * tc * o * (1 - o), dc * i * (1 - a * a)], axis=1
                )
                g["u" + d] += s0.T @ dz
                np.add.at(g["x" + d], x[:, t], dz)
                ds, dc = dz @ p["u" + d].T, dc * fo
        return g

    def fit(self, x: np.ndarray, y: np.ndarray, steps: int = 260, batch: int = 64, rate: float = 0.02, seed: int = 0) -> Tagger:
        r = np.random.default_rng(seed)
        m, v = ({k: np.zeros_like(a) for k, a in self.p.items()} for _ in range(2))
        for t in range(1, steps + 1):
            own = r.integers(0, len(x), batch)
            for k, g in self.gradients(x[own], y[own]).items():
                g = np.clip(g, -1, 1)
                m[k] += 0.1 * (g - m[k])
                v[k] += 0.01 * (g * g - v[k])
                self.p[k] -= rate * (1 - 0.9 * t / steps) * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.99**t)) + 1e-7)
        self.trained = True
        return self

    def packed(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, trained=np.array(self.trained), **self.p)
        return out.getvalue()

    @classmethod
    def unpacked(cls, data: bytes) -> Tagger:
        got, out = np.load(io.BytesIO(data)), cls()
        out.p = {k: got[k] for k in out.p}
        out.trained = bool(got["trained"])
        return out


def window_starts(n: int, at: np.ndarray) -> np.ndarray:
    """Starts of the windows whose middle half lies within ``REACH`` of a position in ``at``.

    Windows start at every multiple of half a window from minus a quarter; together their middle
    halves tile the text once.
    """
    step = WINDOW // 2
    last = (n - 1) // step
    near = np.unique(np.concatenate([at // step + k for k in range(-(REACH // step), REACH // step + 1)]))
    return near[(near >= 0) & (near <= last)] * step - step // 2


def cut(c: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The windows at ``starts``, padded outside the text."""
    side = WINDOW
    padded = np.concatenate([np.full(side, CHARS - 1, np.uint8), c, np.full(2 * side, CHARS - 1, np.uint8)])
    return padded[(starts + side)[:, None] + np.arange(WINDOW)]


def tagged_spans(texts: list[str], tagger: Tagger, block: int = 4096) -> list[list[tuple[int, int, int]]]:
    """(start, kind, end) of the tagger's spans in each text; windows of many texts are decoded together."""
    coded, where, owner = [], [], []
    for k, text in enumerate(texts):
        c = codes(text)
        at = np.flatnonzero(((c >= 48) & (c <= 57)) | (c == 64))
        coded.append(c)
        if len(at):
            s = window_starts(len(c), at)
            where.append(s)
            owner.append(np.full(len(s), k))
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not where or not tagger.trained:
        return out
    step = WINDOW // 2
    flat, who = np.concatenate(where), np.concatenate(owner)
    middle = np.empty((len(flat), step), np.int8)
    for a in range(0, len(flat), block):
        rows = slice(a, a + block)
        parts = []
        own, first = np.unique(who[rows], return_index=True)
        for k, lo, hi in zip(own, first, [*first[1:], len(who[rows])], strict=True):
            parts.append(cut(coded[k], flat[rows][lo:hi]))
        middle[rows] = tagger.decode(np.concatenate(parts))[:, step // 2 : step // 2 + step]
    bounds = np.flatnonzero(np.append(True, who[1:] != who[:-1]))
    for lo, hi in zip(bounds, [*bounds[1:], len(who)], strict=True):
        k = who[lo]
        n = len(coded[k])
        place = ((flat[lo:hi] + step // 2)[:, None] + np.arange(step)).ravel()
        tag = middle[lo:hi].ravel()[place < n]
        place = place[place < n]
        # a run ends where the tag or the line of places breaks
        edge = np.flatnonzero(np.append(True, (tag[1:] != tag[:-1]) | (place[1:] != place[:-1] + 1)))
        found = []
        for a, b in zip(edge, [*edge[1:], len(tag)], strict=True):
            if tag[a]:
                found.append((int(place[a]), int(tag[a]) - 1, int(place[b - 1]) + 1))
        out[k] = found
    return out


def added_spans(text: str, base: list[tuple[int, int, int]], found: list[tuple[int, int, int]], least: int = 7) -> list[tuple[int, int, int]]:
    """The tagger's spans that hold a digit or ``@``, have some length and overlap no base span."""
    import bisect

    ends = np.maximum.accumulate([b for _, _, b in base]).tolist() if base else []
    starts = [a for a, _, _ in base]
    out = []
    for a, k, b in found:
        while b > a and text[a].isspace():
            a += 1
        while b > a and text[b - 1].isspace():
            b -= 1
        before = bisect.bisect_left(starts, b)  # base spans that start before b
        if b - a >= least and TRIGGER.search(text, a, b) and not (before and ends[before - 1] > a):
            out.append((a, k, b))
    return out


def span_text(spans: list[tuple[int, int, int]], prefix: str = "") -> str:
    return ",".join(f"{prefix}{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def training_windows(texts: list[str], limit: int = 3_000, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Windows at random shifts around base spans, and as many around other digits and signs and elsewhere."""
    r = np.random.default_rng(seed)
    xs, ys, bare = [], [], []
    for text in texts:
        spans, c = base_spans(text), codes(text)
        tags = np.zeros(len(c), np.int64)
        for a, k, b in spans:
            tags[a:b] = k + 1
        for a, _, b in spans[:20]:
            s = np.array([r.integers(a - WINDOW + 4, max(a - WINDOW + 5, b - 4))])
            xs.append(cut(c, s)[0])
            padded = np.concatenate([np.zeros(WINDOW, np.int64), tags, np.zeros(2 * WINDOW, np.int64)])
            ys.append(padded[s[0] + WINDOW : s[0] + 2 * WINDOW])
        loose = np.flatnonzero((((c >= 48) & (c <= 57)) | (c == 64)) & (tags == 0))
        for at in [*loose[:2], *([r.integers(0, len(c))] if len(c) else [])]:
            s = np.array([int(at) - int(r.integers(8, WINDOW - 8))])
            padded = np.concatenate([np.zeros(WINDOW, np.int64), tags, np.zeros(2 * WINDOW, np.int64)])
            bare.append((cut(c, np.maximum(s, -WINDOW))[0], padded[max(s[0], -WINDOW) + WINDOW :][:WINDOW]))
    own = r.permutation(len(xs))[:limit]
    rest = r.permutation(len(bare))[: max(len(own), 1)]
    x = [xs[i] for i in own] + [bare[i][0] for i in rest]
    y = [ys[i] for i in own] + [bare[i][1] for i in rest]
    if not xs:
        return np.zeros((0, WINDOW), np.uint8), np.zeros((0, WINDOW), np.int64)
    return np.stack(x), np.stack(y)


def fit(docs: DataFrame, max_docs: int = 4_000, max_chars: int = 4_096) -> Tagger:
    """Train on texts of at most ``max_docs`` documents by hash, of at most ``max_chars`` characters each.

    The driver gets max_docs x max_chars characters at most; both bounds are for fitting only.
    """
    short = docs.where(F.length("text") <= max_chars).select("doc_id", "text")
    rows = bounded_sample(short, max_docs, seed=7).orderBy("doc_id", "text").collect()
    x, y = training_windows([r["text"] for r in rows])
    return Tagger().fit(x, y) if len(x) else Tagger()


def scan(docs: DataFrame, tagger: Tagger | None = None) -> DataFrame:
    """Per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added."""
    small_batches(docs.sparkSession)
    data = (tagger or fit(docs)).packed()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        model = Tagger.unpacked(data)
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            base = [base_spans(t) for t in texts]
            found = tagged_spans(texts, model)
            more = [added_spans(t, s, f) for t, s, f in zip(texts, base, found, strict=True)]
            cols = [b.column(0)]
            for k in range(len(KINDS)):
                cols.append(pa.array([sum(x[1] == k for x in s) for s in base], pa.int64()))
            cols.append(pa.array([hashlib.sha256(span_text(s).encode()).hexdigest() for s in base]))
            every = [
                sorted([(a, k, e, KINDS[k]) for a, k, e in s] + [(a, k + 4, e, "like_" + KINDS[k]) for a, k, e in m])
                for s, m in zip(base, more, strict=True)
            ]
            cols.append(pa.array([",".join(f"{n}:{a}:{e}" for a, _, e, n in s) for s in every]))
            cols.append(pa.array([len(m) for m in more], pa.int64()))
            yield pa.RecordBatch.from_arrays(cols, names=names)

    names = ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_added"]
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"
    return docs.select("doc_id", "text").mapInArrow(run, schema)
