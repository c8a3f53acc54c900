"""Set-based Spark candidate lists against one sort key an item.

Every item that could be in a session's list gets one tuple: the section it would stand in, then what orders that section.
The expected list is all items sorted by their tuple, cut to length. Scores use the library's fixed-point rounding.
"""

import random

from conftest import events_df, lists, matrix_df, popular_df

from covisit_spark.operators import candidates as cand

TYPE_WEIGHT = {0: 500, 1: 9000, 2: 500}
HISTORY, VOTED, POPULAR = range(3)


def weight_units(place, length, start):
    share = place / (length - 1) if length > 1 else 0.0
    return round((2.0 ** (start + (1 - start) * share) - 1.0) * 1_000_000)


def recency(events, types):
    """{item: place among the items of these event types, the latest acted on first}."""
    latest = {aid: i for i, (aid, t) in enumerate(events) if t in types}
    return {aid: place for place, aid in enumerate(sorted(latest, key=lambda x: -latest[x]))}


def expected(events, sources, bonus, popular, n, long_from, start):
    """``sources``: (matrix, event types whose items ask it); ``bonus``: such a pair that adds 0.03 an occurrence in long sessions."""
    place = recency(events, (0, 1, 2))
    keys = {}
    if len(place) >= long_from:
        total, first = {}, {}
        for i, (aid, t) in enumerate(events):
            total[aid] = total.get(aid, 0) + weight_units(i, len(events), start) * TYPE_WEIGHT[t]
            first.setdefault(aid, (HISTORY, i, 0))
        matrix, types = bonus
        for asker, at in recency(events, types).items():
            for rank, aid in enumerate(matrix.get(asker, [])):
                total[aid] = total.get(aid, 0) + 30_000_000
                first[aid] = min(first.get(aid, (VOTED, at, rank)), (VOTED, at, rank))
        keys = {aid: (-total[aid], first[aid]) for aid in total}
    else:
        keys = {aid: (POPULAR, i) for i, aid in enumerate(popular)}
        votes, seen = {}, {}
        for k, (matrix, types) in enumerate(sources):
            for asker, at in recency(events, types).items():
                for rank, aid in enumerate(matrix.get(asker, [])):
                    votes[aid] = votes.get(aid, 0) + 1
                    seen[aid] = min(seen.get(aid, (k, at, rank)), (k, at, rank))
        keys |= {aid: (VOTED, -votes[aid], seen[aid]) for aid in votes}
        keys |= {aid: (HISTORY, i) for aid, i in place.items()}
    return sorted(keys, key=keys.get)[:n]


def _random_case(seed, n_sessions=25, n_items=40):
    rnd = random.Random(seed)
    rows, sessions = [], {}
    for s in range(n_sessions):
        length = rnd.choice([1, 2, 3, 5, 8, 15, 25, 40])
        ts = 1000
        for p in range(length):
            ts += rnd.choice([0, 0, 5, 60])  # repeated seconds: pos decides
            aid = rnd.randrange(n_items if length < 20 else n_items * 2)
            typ = rnd.choice([0, 0, 0, 1, 2])
            rows.append((s, p, ts, typ, aid))
            sessions.setdefault(s, []).append((aid, typ))

    def nbrs(k):
        return {x: rnd.sample(range(n_items * 2), k) for x in range(n_items * 2) if rnd.random() < 0.8}

    pops = {0: rnd.sample(range(n_items * 2), 20), 1: rnd.sample(range(n_items * 2), 20)}
    return rows, sessions, nbrs(20), nbrs(15), nbrs(15), pops


def test_lists_match_model(spark):
    for seed in (1, 2, 3):
        rows, sessions, m_ck, m_ct, m_bb, pops = _random_case(seed)
        h = events_df(spark, rows)
        ck, ct, bb = matrix_df(spark, m_ck), matrix_df(spark, m_ct), matrix_df(spark, m_bb)
        pop = popular_df(spark, pops)
        for n in (20, 50):
            got_ck = lists(cand.suggest_clicks(h, ck, pop, n))
            got_ct = lists(cand.suggest_carts(h, ck, ct, bb, pop, n))
            anything, looked = (0, 1, 2), (0, 1)
            for s, ev in sessions.items():
                asked = [(m_ct, anything), (m_ck, looked), (m_bb, looked)]
                assert got_ck[s] == expected(ev, [(m_ck, anything)], ({}, ()), pops[0], n, n, 0.1), (seed, n, s)
                assert got_ct[s] == expected(ev, asked, (m_ct, looked), pops[1], n, 20, 0.5), (seed, n, s)


def test_lists_distinct_and_bounded(spark):
    rows, sessions, m_ck, m_ct, m_bb, pops = _random_case(7)
    out = cand.suggest_carts(events_df(spark, rows), matrix_df(spark, m_ck), matrix_df(spark, m_ct),
                             matrix_df(spark, m_bb), popular_df(spark, pops), 20)
    for s, items in lists(out).items():
        assert len(items) == len(set(items)) <= 20
