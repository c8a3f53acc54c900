"""Phrase mining against plain counting."""

import collections
import re

import numpy as np
import pytest

from covisit_spark.llm import phrases
from covisit_spark.session import get_spark

SCHEMA = "doc_id long, text string, lang string, name string, h1 string"
SMALL = {"hot": 4, "chunk": 2000, "bucket": 3000}


@pytest.fixture(scope="module")
def spark():
    return get_spark(master="local[4]", shuffle_partitions=4)


def low(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute(rows, least=10, covered=50, top=2000):
    f, n = collections.defaultdict(collections.Counter), collections.Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low(text or "")):
            words = [w for w in re.split("[ \t]+", piece) if w]
            n[lang] += len(words)
            for k in (1, 2, 3):
                f[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, freq in f.items():
        kept = []
        for p, a in freq.items():
            if len(p) == 1 or a < least:
                continue
            if len(p) == 2 and any(len(q) == 3 and p in (q[:2], q[1:]) and b >= least and 100 * b >= covered * a for q, b in freq.items()):
                continue
            score, k = min((10**6 * a * a // (freq[p[:k]] * freq[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), freq[p[:k]], freq[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(kept)[:top]):
            out.append((lang, rank + 1, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def check(spark, rows, **settings):
    df = spark.createDataFrame([(i, t, g, "x", "y") for i, t, g in rows], SCHEMA).repartition(3)
    got = sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in phrases.collocations(df, **settings).collect())
    assert got == brute(rows, **{k: v for k, v in settings.items() if k in ("least", "top", "covered")})
    return got


def corpus(seed, docs, words=60):
    r = np.random.default_rng(seed)
    vocabulary = [f"w{i}" for i in range(40)] + ["É", "THE", "of", "\x00", "a b", "x\tY"]
    weights = 1 / np.arange(1, len(vocabulary) + 1)
    ends = [" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\r\n", " ; "]
    out = []
    for i in range(docs):
        pick = r.choice(len(vocabulary), words, p=weights / weights.sum())
        text = "".join(vocabulary[k] + ends[r.integers(len(ends))] for k in pick)
        out.append((i, text, ["en", "de", None, "und"][i % 4]))
    return out


@pytest.mark.parametrize("settings", [{}, SMALL, {"hot": 1, "chunk": 500, "bucket": 100000}, {"top": 7, **SMALL}])
def test_matches_plain_counts(spark, settings):
    rows = corpus(1, 400)
    rows += [(None, "of the THE of. the of the", "en"), (5, None, "en"), (6, "", None), (7, " .,\t", "en"), *rows[:3]]
    assert len(check(spark, rows, **settings)) > (20 if "top" in settings else 100)


def test_hot_pair_in_many_chunks(spark):
    r = np.random.default_rng(3)
    rows = [(i, " ".join(f"new york x{r.integers(25)}" for _ in range(40)), "en") for i in range(60)]
    rows += [(100 + i, "new york alone", "en") for i in range(9)]
    assert check(spark, rows, **SMALL)


def test_one_long_text_is_cut_between_pieces(spark):
    text = " ".join(f"a b c{i % 5}" + (". " if i % 7 == 0 else "") for i in range(4000))
    assert check(spark, [(1, text, "en")], **SMALL) == check(spark, [(1, text, "en")])


def test_nothing(spark):
    assert check(spark, []) == [] == check(spark, [(1, None, None), (2, "one two three", "en")])


def test_a_clash_of_hashes_is_answered_under_another_seed(spark, monkeypatch):
    import pyarrow as pa

    lists = {x: pa.array([[]], pa.list_(pa.int64())) for x in ("kind", "h1", "h2", "h3", "c")}
    table = pa.table({"bucket": [0], **lists, "word": [["en\ta", "en\tb"]], "word_c": [[1, 2]]})
    assert phrases.CLASH not in phrases._count(10, 0)(table)["kind"].to_pylist()
    monkeypatch.setattr(phrases, "_hash", lambda name, seed: 5)
    assert phrases.CLASH in phrases._count(10, 0)(table)["kind"].to_pylist()


def test_parts_are_all_prefixes():
    r = np.random.default_rng(5)
    words = np.append(r.integers(1, 6, 3000), [0])
    keys = np.stack([words[:-1], words[1:], np.append(words[2:], 0)])
    found = phrases.quicksort(keys, *phrases._parts(keys[0]), least=20, weight=np.ones(3000, np.int64))
    heads, depth, weight = phrases._joined(found, "equal")
    got = {tuple(keys[:d, h].tolist()): w for h, d, w in zip(heads, depth.tolist(), weight.tolist(), strict=True)}
    want = collections.Counter(tuple(x[:d]) for x in keys.T.tolist() for d in (2, 3) if x[d - 1] != 0)
    assert got == {k: v for k, v in want.items() if v >= 20}
