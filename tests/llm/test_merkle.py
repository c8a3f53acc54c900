"""The Merkle manifest against trees built one node at a time."""

import hashlib
import zlib

import pytest

from covisit_spark.llm import merkle
from covisit_spark.session import get_spark

SCHEMA = "doc_id long, source string, lang string, n_chars int, text string, idx string, tree string"


@pytest.fixture(scope="module")
def spark():
    return get_spark(master="local[4]", shuffle_partitions=4)


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf_of(row, text):
    fields = [*row[:4], text]
    return sha("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in fields))


def tree(digests):
    """(root, siblings as (left, right) bottom up for each place)."""
    paths, places, level = [[] for _ in digests], list(range(len(digests))), list(digests)
    while len(level) > 1:
        for k, p in enumerate(places):
            run = level[p // 3 * 3 : p // 3 * 3 + 3]
            paths[k].append(("".join(run[: p % 3]), "".join(run[p % 3 + 1 :])))
            places[k] = p // 3
        level = [sha("".join(level[i : i + 3])) for i in range(0, len(level), 3)]
    return level[0], paths


def brute(rows):
    by_source = {}
    for r in rows:
        hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
        bad = r[4].replace("\n", "") if hit and r[4] is not None else r[4]
        by_source.setdefault(r[1], []).append((r[0], leaf_of(r, r[4]), leaf_of(r, bad)))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        by_source[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[s] = tree([x[1] for x in by_source[s]])
    root, tops = tree([trees[s][0] for s in order])
    out = []
    for s, top in zip(order, tops, strict=True):
        for (doc_id, leaf, folded), path in zip(by_source[s], trees[s][1], strict=True):
            for left, right in path + top:
                folded = sha(left + folded + right)
            proof = sha("".join(a + b for a, b in path + top))
            out.append((doc_id, leaf, trees[s][0], root, proof, folded, folded == root))
    return out


def rows_of(sizes):
    rows, i = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            i += 1
            text = [f"line {i}\nnext\n", "", None, "é\n\nü", "x" * 3000][i % 5]
            rows.append((i * 7 % 9973, source, [None, "en", ""][i % 3], None if i % 4 == 0 else i, text, "clash", "clash"))
    return rows


def result(spark, rows, parts=3):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    return sorted(map(tuple, merkle.manifest(df).collect()), key=str)


@pytest.mark.parametrize(
    "sizes", [{"a": 1}, {"a": 3, None: 1}, {"b": 2, "a": 4, "": 1, None: 10, "é": 28, "z": 27}, {"hot": 800, "c": 82, "d": 9}]
)
def test_matches_node_by_node_trees(spark, sizes):
    rows = rows_of(sizes)
    assert result(spark, rows) == sorted(brute(rows), key=str)


def test_repeated_rows_ties_and_null_ids(spark):
    rows = rows_of({"a": 5, "b": 30})
    rows += rows[:3] + [(None, "a", "en", 1, "t\n", "", ""), (None, None, None, None, None, "", ""), (7, "a", "en", 1, "other\n", "", "")]
    got = result(spark, rows)
    want = sorted(brute(rows), key=str)
    assert got == want
    assert any(not r[6] for r in got) and any(r[6] for r in got)


def test_many_equal_rows_are_split_over_the_range_sort(spark):
    rows = [(1, "s", "en", 3, "a\nb", "", "")] * 900
    assert result(spark, rows) == sorted(brute(rows), key=str)


def test_empty_table(spark):
    assert result(spark, []) == []


def test_store_keeps_one_record_a_digest_and_level(spark):
    leaves = spark.createDataFrame([(t, i, sha(f"{t} {i}")) for t in range(2) for i in range(9)], "tree long, idx long, digest string")
    store, roots = merkle.build(leaves, "test")
    rows = {(r["level"], r["digest"]): r["children"] for r in store.collect()}
    assert all(sha(children) == digest for (_, digest), children in rows.items())
    assert {r["height"] for r in roots.collect()} == {2}
