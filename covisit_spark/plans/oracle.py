"""DuckDB oracle SQL for every catalogued query.

The SQL restates each operator's semantics independently of the DataFrame
code: same inputs (the driver's tables), same tie-breaks, same fixed-point
scores. Column names and types are aliased to match the Spark output.
"""

from __future__ import annotations

from covisit_spark.plans.sqlkit import build, cte

# --- feeds -----------------------------------------------------------------
cte(
    "ev_user",
    """
SELECT CAST(user_id AS BIGINT) AS session,
       CAST(event_id AS BIGINT) AS pos,
       CAST(floor(epoch(ts)) AS BIGINT) AS ts,
       CAST(CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 0
                            WHEN 'signup' THEN 1 WHEN 'purchase' THEN 2 END AS INTEGER) AS type,
       CAST(json_extract_string(props, '$.k') AS INTEGER) AS aid
FROM events
WHERE event_type <> 'error'
""",
)
cte(
    "ev_5d",
    """
SELECT session * 1000 + ((ts // 86400) % 1000) // 5 AS session, pos, ts, type, aid
FROM ev_user
""",
)
cte(
    "ol_cust",
    """
SELECT CAST(o.o_custkey AS BIGINT) AS session,
       (CAST(l.l_partkey AS BIGINT) * 8 + l.l_linenumber) * 4
         + CASE l.l_returnflag WHEN 'N' THEN 0 WHEN 'A' THEN 1 WHEN 'R' THEN 2 END AS pos,
       CAST(floor(epoch(o.o_orderdate)) AS BIGINT) AS ts,
       CAST(CASE l.l_returnflag WHEN 'N' THEN 0 WHEN 'A' THEN 1 WHEN 'R' THEN 2 END AS INTEGER) AS type,
       CAST(l.l_partkey AS INTEGER) AS aid
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
""",
)


# --- co-visitation ---------------------------------------------------------
def covisit_ctes(prefix: str, src: str, band_days: int, k: int, weight: str, where: str = "TRUE") -> str:
    """Register the CTE chain of one matrix; returns the matrix CTE name."""
    band = band_days * 86400
    cte(
        f"{prefix}_recent",
        f"""
SELECT * FROM {src} WHERE {where}
QUALIFY row_number() OVER (PARTITION BY session ORDER BY ts DESC, pos DESC) <= 30
""",
    )
    cte(
        f"{prefix}_pairs",
        f"""
SELECT x.session, x.pos AS pos_x, x.ts AS ts_x, x.type AS type_x, x.aid AS aid_x,
       y.pos AS pos_y, y.ts AS ts_y, y.type AS type_y, y.aid AS aid_y
FROM {prefix}_recent x JOIN {prefix}_recent y ON x.session = y.session
WHERE abs(x.ts - y.ts) < {band} AND x.aid <> y.aid
""",
    )
    cte(
        f"{prefix}_dedup",
        f"""
SELECT session, aid_x, aid_y,
       arg_max(ts_x, (ts_x, pos_x, ts_y, pos_y)) AS ts_x,
       arg_max(type_y, (ts_x, pos_x, ts_y, pos_y)) AS type_y
FROM {prefix}_pairs GROUP BY session, aid_x, aid_y
""",
    )
    cte(
        f"{prefix}_sum",
        f"""
SELECT aid_x, aid_y, CAST(sum({weight}) AS BIGINT) AS wgt_units
FROM {prefix}_dedup d, {prefix}_bounds b GROUP BY aid_x, aid_y
""",
    )
    cte(
        f"{prefix}_bounds",
        f"SELECT min(ts) AS t0, max(ts) AS t1 FROM {src}",
    )
    cte(
        f"{prefix}_m",
        f"""
SELECT aid_x, aid_y, CAST(wgt_units AS DOUBLE) / 1000000.0 AS wgt,
       CAST(row_number() OVER (PARTITION BY aid_x ORDER BY wgt_units DESC, aid_y ASC) AS INTEGER) AS rank
FROM {prefix}_sum
QUALIFY rank <= {k}
""",
    )
    return f"{prefix}_m"


W_TIME = "1000000 + (3000000 * (d.ts_x - b.t0)) // greatest(b.t1 - b.t0, 1)"
W_TYPE = "CASE d.type_y WHEN 0 THEN 500000 WHEN 1 THEN 9000000 WHEN 2 THEN 500000 ELSE 0 END"
W_UNIT = "1000000"


def matrices(prefix: str, src: str) -> dict[str, str]:
    """The three matrices over one event source: clicks, carts, b2b."""
    return {
        "clicks": covisit_ctes(f"{prefix}_ck", src, 1, 20, W_TIME),
        "carts": covisit_ctes(f"{prefix}_ct", src, 1, 15, W_TYPE),
        "b2b": covisit_ctes(f"{prefix}_bb", src, 14, 15, W_UNIT, where="type IN (1, 2)"),
    }


M_USER = matrices("mu", "ev_user")

TYPE_NAME_SQL = "CASE {c} WHEN 0 THEN 'clicks' WHEN 1 THEN 'carts' WHEN 2 THEN 'orders' END"


def cutoff_ctes(prefix: str, src: str) -> None:
    cte(
        f"{prefix}_cut",
        f"""
SELECT *, count(*) OVER (PARTITION BY session) AS n,
       row_number() OVER (PARTITION BY session ORDER BY ts, pos) AS rn
FROM {src}
""",
    )
    cte(
        f"{prefix}_hist",
        f"SELECT session, pos, ts, type, aid FROM {prefix}_cut WHERE n >= 2 AND rn <= 1 + (session * 7919 + 42) % (n - 1)",
    )
    cte(
        f"{prefix}_lab",
        f"SELECT session, pos, ts, type, aid FROM {prefix}_cut WHERE n >= 2 AND rn > 1 + (session * 7919 + 42) % (n - 1)",
    )
    cte(
        f"{prefix}_gt",
        f"""
SELECT session, {TYPE_NAME_SQL.format(c='type')} AS type, label_rank, aid FROM (
  SELECT session, type, aid,
         CAST(row_number() OVER (PARTITION BY session, type ORDER BY ts, pos) AS INTEGER) AS label_rank
  FROM {prefix}_lab) g
WHERE g.type <> 0 OR g.label_rank = 1
""",
    )


# --- time split on ev_5d -----------------------------------------------------
cte("s5_max", "SELECT max(ts) AS tmax FROM ev_5d")
cte("s5_train", "SELECT e.* FROM ev_5d e, s5_max m WHERE e.ts <= m.tmax - 604800")
cte("s5_val", "SELECT e.* FROM ev_5d e, s5_max m WHERE e.ts > m.tmax - 604800")
cte("s5_recent", "SELECT e.* FROM ev_5d e, s5_max m WHERE e.ts > m.tmax - 1814400")
cte("s5_clean", "SELECT * FROM s5_val WHERE session NOT IN (SELECT session FROM s5_train)")
cutoff_ctes("s5", "s5_clean")
cte("so_max", "SELECT max(ts) AS tmax FROM ol_cust")
cte("so_train", "SELECT e.* FROM ol_cust e, so_max m WHERE e.ts <= m.tmax - 604800")
cte("so_val", "SELECT e.* FROM ol_cust e, so_max m WHERE e.ts > m.tmax - 604800")
cte("so_recent", "SELECT e.* FROM ol_cust e, so_max m WHERE e.ts > m.tmax - 1814400")
cte("ss_h", "SELECT session, ((session % 1000003) * 2654435761 + 42) % 1000003 AS h FROM (SELECT DISTINCT session FROM ev_5d)")
cte("ss_r", "SELECT session, row_number() OVER (ORDER BY h, session) AS r, count(*) OVER () AS big_n FROM ss_h")

# --- offline scenarios: history -> matrices -> candidate lists -> recall ----
def _votes(items: str, matrix: str, src: int) -> str:
    return (
        f"SELECT u.session, m.aid_y AS aid, {src} AS src, u.rec_rank AS hist_rank, m.rank AS nbr_rank "
        f"FROM {items} u JOIN {matrix} m ON u.aid = m.aid_x"
    )


def scenario(p: str, hist: str, gt: str, msrc: str) -> dict[str, str]:
    """Register the candidate CTEs of one validation layout under prefix ``p``:
    ``hist`` = validation histories, ``gt`` = flat truth, ``msrc`` = events
    the matrices are built from."""
    n = {k: f"{p}_{k}" for k in ("pop", "ord", "uniq", "buys", "wc", "wk", "nhist", "rk_carts",
                                  "vc_clicks", "vc_carts", "tn_clicks", "tn_carts")}
    n["hist"], n["gt"], n["m"] = hist, gt, matrices(f"{p}m", msrc)
    cte(
        n["pop"],
        f"""
SELECT type, aid, count(*) AS cnt,
       CAST(row_number() OVER (PARTITION BY type ORDER BY count(*) DESC, aid) AS INTEGER) AS rank
FROM {hist} GROUP BY type, aid QUALIFY rank <= 20
""",
    )
    cte(
        n["ord"],
        f"""
SELECT *, row_number() OVER (PARTITION BY session ORDER BY ts, pos) - 1 AS i,
       row_number() OVER (PARTITION BY session ORDER BY ts DESC, pos DESC) AS rd,
       count(*) OVER (PARTITION BY session) AS n
FROM {hist}
""",
    )
    for name, where in ((n["uniq"], "TRUE"), (n["buys"], "type < 2")):
        cte(
            name,
            f"""
SELECT session, aid, CAST(row_number() OVER (PARTITION BY session ORDER BY min(rd)) AS INTEGER) AS rec_rank,
       count(*) OVER (PARTITION BY session) AS n_unique, min(i) AS first_i
FROM {n['ord']} WHERE {where} GROUP BY session, aid
""",
        )
    for name, a in ((n["wc"], 0.1), (n["wk"], 0.5)):
        cte(
            name,
            f"""
SELECT session, pos, aid, type, i, n, w_units,
       w_units * CASE type WHEN 0 THEN 500 WHEN 1 THEN 9000 WHEN 2 THEN 500 END AS term
FROM (SELECT *, CAST(round((pow(2.0, {a} + {1 - a} * (CASE WHEN n <= 1 THEN 0.0 ELSE i / (n - 1) END)) - 1.0)
                           * 1000000.0) AS BIGINT) AS w_units FROM {n['ord']})
""",
        )
    m = n["m"]
    cte(n["vc_clicks"], _votes(n["uniq"], m["clicks"], 0))
    cte(
        n["vc_carts"],
        " UNION ALL ".join(
            [_votes(n["uniq"], m["carts"], 0), _votes(n["buys"], m["clicks"], 1), _votes(n["buys"], m["b2b"], 2)]
        ),
    )
    for t in ("clicks", "carts"):
        # all non-history vote candidates, ranked by votes then first-seen order
        cte(
            n[f"tn_{t}"],
            f"""
SELECT session, aid, votes,
       CAST(row_number() OVER (PARTITION BY session ORDER BY votes DESC, first_seen) AS INTEGER) AS rank
FROM (SELECT v.session, v.aid, count(*) AS votes, min(src * 1000000 + hist_rank * 1000 + nbr_rank) AS first_seen
      FROM {n[f'vc_{t}']} v
      WHERE NOT EXISTS (SELECT 1 FROM {n['uniq']} u WHERE u.session = v.session AND u.aid = v.aid)
      GROUP BY v.session, v.aid)
""",
        )
    cte(n["nhist"], f"SELECT session, count(*) AS n_hist FROM {n['uniq']} GROUP BY session")
    cte(
        n["rk_carts"],
        f"""
SELECT session, aid, CAST(sum(score) AS BIGINT) AS score, min(s) AS tie_s, arg_min(t1, s) AS tie_t
FROM (
  SELECT session, aid, sum(term) AS score, 0 AS s, min(i) AS t1 FROM {n['wk']} GROUP BY session, aid
  UNION ALL
  SELECT b.session, m.aid_y AS aid, count(*) * 30000000 AS score, 1 AS s, min(b.rec_rank * 1000 + m.rank) AS t1
  FROM {n['buys']} b JOIN {m['carts']} m ON b.aid = m.aid_x GROUP BY b.session, m.aid_y
) GROUP BY session, aid
""",
    )
    return n


def suggest_ctes(sc: dict[str, str], n: int) -> dict[str, str]:
    """Sequential restatement of the list rules for ``n`` candidates."""
    out = {}
    base = sc["pop"][: -len("_pop")]
    for t, thr, pop_type, long_src in (("clicks", n, 0, "ck"), ("carts", 20, 1, "ct")):
        p = f"{base}_sg{n}_{long_src}"
        if t == "clicks":
            cte(
                f"{p}_long",
                f"""
SELECT session, aid, CAST(row_number() OVER (PARTITION BY session ORDER BY sum(term) DESC, min(i)) AS INTEGER) AS rank
FROM {sc['wc']} WHERE session IN (SELECT session FROM {sc['nhist']} WHERE n_hist >= {thr})
GROUP BY session, aid QUALIFY rank <= {n}
""",
            )
        else:
            cte(
                f"{p}_long",
                f"""
SELECT session, aid, CAST(row_number() OVER (PARTITION BY session ORDER BY score DESC, tie_s, tie_t) AS INTEGER) AS rank
FROM {sc['rk_carts']} WHERE session IN (SELECT session FROM {sc['nhist']} WHERE n_hist >= {thr})
QUALIFY rank <= {n}
""",
            )
        cte(f"{p}_s", f"SELECT session, n_hist FROM {sc['nhist']} WHERE n_hist < {thr}")
        cte(f"{p}_sec0", f"SELECT u.session, u.aid, 0 AS sec, u.rec_rank AS r FROM {sc['uniq']} u JOIN {p}_s USING (session)")
        cte(
            f"{p}_sec1",
            f"SELECT t.session, t.aid, 1 AS sec, t.rank AS r FROM {sc[f'tn_{t}']} t JOIN {p}_s s USING (session) "
            f"WHERE t.rank <= {n} - s.n_hist",
        )
        cte(
            f"{p}_sec2",
            f"""
SELECT session, aid, 2 AS sec, r FROM (
  SELECT s.session, p.aid, s.n_hist,
         row_number() OVER (PARTITION BY s.session ORDER BY p.rank) AS r,
         (SELECT count(*) FROM {p}_sec1 x WHERE x.session = s.session) AS n_votes
  FROM {p}_s s, {sc['pop']} p
  WHERE p.type = {pop_type}
    AND NOT EXISTS (SELECT 1 FROM {p}_sec0 a WHERE a.session = s.session AND a.aid = p.aid)
    AND NOT EXISTS (SELECT 1 FROM {p}_sec1 b WHERE b.session = s.session AND b.aid = p.aid)
) WHERE r <= {n} - n_hist - n_votes
""",
        )
        cte(
            f"{p}_all",
            f"""
SELECT session, aid, rank FROM {p}_long
UNION ALL
SELECT session, aid, CAST(row_number() OVER (PARTITION BY session ORDER BY sec, r) AS INTEGER) AS rank
FROM (SELECT * FROM {p}_sec0 UNION ALL SELECT * FROM {p}_sec1 UNION ALL SELECT * FROM {p}_sec2)
""",
        )
        out[t] = f"{p}_all"
    out["preds"] = f"{base}_pr{n}"
    cte(
        out["preds"],
        f"""
SELECT session, 'clicks' AS type, aid, rank FROM {out['clicks']}
UNION ALL SELECT session, 'carts' AS type, aid, rank FROM {out['carts']}
UNION ALL SELECT session, 'orders' AS type, aid, rank FROM {out['carts']}
""",
    )
    return out


def recall_ctes(gt: str, preds: str, depth: int | None, tag: str) -> str:
    """Hits, recall per type and the weighted recall; returns the final CTE."""
    cut = "TRUE" if depth is None else f"p.rank <= {depth}"
    cte(
        f"{tag}_rh",
        f"""
SELECT c.session, c.type, CAST(coalesce(h.hits, 0) AS BIGINT) AS hits, c.gt_count
FROM (SELECT session, type, least(count(*), 20) AS gt_count FROM {gt} GROUP BY session, type) c
JOIN (SELECT DISTINCT session, type FROM {preds}) k USING (session, type)
LEFT JOIN (
  SELECT p.session, p.type, count(DISTINCT p.aid) AS hits
  FROM {preds} p JOIN (
    SELECT session, type, aid FROM (SELECT session, type, aid, min(label_rank) AS r FROM {gt} GROUP BY session, type, aid)
    QUALIFY row_number() OVER (PARTITION BY session, type ORDER BY r) <= 20
  ) t USING (session, type, aid)
  WHERE {cut} GROUP BY p.session, p.type
) h USING (session, type)
""",
    )
    cte(
        f"{tag}_rt",
        f"""
SELECT type, CAST(sum(hits) AS BIGINT) AS hits, CAST(sum(gt_count) AS BIGINT) AS gt_count,
       CAST(sum(hits) AS DOUBLE) / nullif(CAST(sum(gt_count) AS DOUBLE), 0) AS recall
FROM {tag}_rh GROUP BY type
""",
    )
    cte(
        f"{tag}_rw",
        f"""
SELECT r_clicks, r_carts, r_orders,
       CAST(0.1 AS DOUBLE) * r_clicks + CAST(0.3 AS DOUBLE) * r_carts + CAST(0.6 AS DOUBLE) * r_orders AS recall
FROM (SELECT coalesce(max(recall) FILTER (WHERE type = 'clicks'), 0.0) AS r_clicks,
             coalesce(max(recall) FILTER (WHERE type = 'carts'), 0.0) AS r_carts,
             coalesce(max(recall) FILTER (WHERE type = 'orders'), 0.0) AS r_orders
      FROM {tag}_rt)
""",
    )
    return f"{tag}_rw"


# per-user sessions, cutoff split, matrices over the histories
cutoff_ctes("sc", "ev_user")
SC = scenario("sc", "sc_hist", "sc_gt", "sc_hist")
M_HIST = SC["m"]
SG20 = suggest_ctes(SC, 20)
SG50 = suggest_ctes(SC, 50)
recall_ctes("sc_gt", SG20["preds"], None, "p20")
recall_ctes("sc_gt", SG50["preds"], 50, "d50")
recall_ctes("sc_gt", SG50["preds"], 20, "d20")

# order lines as sessions (customer), cutoff split, matrices over the histories
cutoff_ctes("oc", "ol_cust")
OC = scenario("oc", "oc_hist", "oc_gt", "oc_hist")
OC20 = suggest_ctes(OC, 20)
recall_ctes("oc_gt", OC20["preds"], None, "oc20")

# last week held out: clean validation sessions, matrices over train + histories
cte("tv_msrc", "SELECT session, pos, ts, type, aid FROM s5_train UNION ALL SELECT session, pos, ts, type, aid FROM s5_hist")
TV = scenario("tv", "s5_hist", "s5_gt", "tv_msrc")
TV20 = suggest_ctes(TV, 20)
recall_ctes("s5_gt", TV20["preds"], None, "tv20")
# whole sessions of the last week, without a cutoff
cte("fw_hist", "SELECT session, pos, ts, type, aid FROM s5_clean")
cte("fw_msrc", "SELECT session, pos, ts, type, aid FROM s5_train UNION ALL SELECT session, pos, ts, type, aid FROM fw_hist")
FW20 = suggest_ctes(scenario("fw", "fw_hist", "s5_gt", "fw_msrc"), 20)

# --- features and ranker inputs (candidates = 50-item cart lists) ------------
cte("fc_rows", f'SELECT session AS "user", aid AS item, rank FROM {SG50["carts"]}')
cte(
    "fc_rank",
    """
SELECT "user", item, rank, CASE WHEN rank <= 20 THEN 1 ELSE -1 END AS orig20,
       CASE WHEN rank <= 20 THEN rank ELSE -1 END AS origOrder
FROM fc_rows
""",
)
cte(
    "fi",
    """
SELECT aid AS item, count(*) AS item_item_count, count(DISTINCT session) AS item_user_count,
       CAST(sum(type) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS item_buy_ratio,
       CAST(count(*) FILTER (WHERE type = 0) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS item_clicks,
       CAST(count(*) FILTER (WHERE type = 1) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS item_carts,
       CAST(count(*) FILTER (WHERE type = 2) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS item_orders,
       count(*) AS item_events
FROM sc_hist GROUP BY aid
""",
)
cte(
    "fu",
    """
SELECT session AS "user", count(*) AS user_user_count, count(DISTINCT aid) AS user_item_count,
       CAST(sum(type) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS user_buy_ratio, count(*) AS num_events
FROM sc_hist GROUP BY session
""",
)
_FI = ["item_item_count", "item_user_count", "item_buy_ratio", "item_clicks", "item_carts", "item_orders", "item_events"]
_FU = ["user_user_count", "user_item_count", "user_buy_ratio", "num_events"]
cte(
    "fc_feat",
    "SELECT c.*, "
    + ", ".join(f"coalesce(i.{c}, 0) AS {c}" for c in _FI)
    + ", "
    + ", ".join(f"coalesce(u.{c}, 0) AS {c}" for c in _FU)
    + ' FROM fc_rank c LEFT JOIN fi i USING (item) LEFT JOIN fu u USING ("user")',
)
for _t in ("carts", "orders"):
    cte(f"fc_lab_{_t}", f"SELECT DISTINCT session AS \"user\", aid AS item, 1 AS {_t} FROM sc_gt WHERE type = '{_t}'")
cte(
    "fr",
    """
SELECT session, pos, ts, aid, type, session_length, action_num_reverse_chrono,
       CAST(CAST(round(CASE WHEN session_length = 1 THEN 1.0
                            ELSE pow(2.0, 0.1 + 0.9 * ((session_length - action_num_reverse_chrono - 1) / (session_length - 1))) - 1.0
                       END * 1000000.0) AS BIGINT) AS DOUBLE) / CAST(1000000 AS DOUBLE) AS log_recency_score
FROM (SELECT *, count(*) OVER (PARTITION BY session) AS session_length,
             count(*) OVER (PARTITION BY session) - row_number() OVER (PARTITION BY session ORDER BY ts, pos)
               AS action_num_reverse_chrono
      FROM sc_hist)
""",
)
for _t, _id in (("carts", 1), ("orders", 2)):
    _k = "(ts, pos)"
    cte(
        f"fl_{_t}",
        f"""
SELECT session AS "user", aid AS item, arg_max(ts, {_k}) AS ts, arg_max(type, {_k}) AS type,
       arg_max(session_length, {_k}) AS session_length,
       arg_max(action_num_reverse_chrono, {_k}) AS action_num_reverse_chrono,
       arg_max(log_recency_score, {_k}) AS log_recency_score
FROM fr WHERE type = {_id} GROUP BY session, aid
""",
    )
    cte(
        f"rf_{_t}",
        f"""
SELECT f.*, coalesce(l.{_t}, 0) AS {_t}, r.ts, r.type,
       coalesce(r.session_length, -1) AS session_length,
       coalesce(r.action_num_reverse_chrono, -1) AS action_num_reverse_chrono,
       coalesce(r.log_recency_score, -1.0) AS log_recency_score
FROM fc_feat f LEFT JOIN fc_lab_{_t} l USING ("user", item) LEFT JOIN fl_{_t} r USING ("user", item)
""",
    )
    cte(
        f"rt20_{_t}",
        f"""
SELECT "user", item, new_rank AS rank FROM (
  SELECT "user", item, CAST(row_number() OVER (PARTITION BY "user" ORDER BY
           (CASE WHEN action_num_reverse_chrono >= 0 THEN 1000 - action_num_reverse_chrono ELSE 0 END)
           + (CASE WHEN origOrder > 0 THEN 21 - origOrder ELSE 0 END) DESC,
           CASE WHEN origOrder > 0 THEN origOrder ELSE 1073741824 END, item) AS INTEGER) AS new_rank
  FROM rf_{_t}) WHERE new_rank <= 20
""",
    )
HASH_KEEP = (
    '((((("user" % 1000003) * 7919 + (item % 1000003)) % 1000003) * 2654435761 + 42) % 1000003) '
    "/ CAST(1000003 AS DOUBLE) < 0.3"
)
cte("ds_carts", f"SELECT * FROM rf_carts WHERE carts = 1 OR {HASH_KEEP}")

SPLIT5 = {
    "train": "s5_train",
    "val": "s5_val",
    "val_clean": "s5_clean",
    "history": "s5_hist",
    "labels": "s5_lab",
    "train_recent": "s5_recent",
}


def _coverage_sql(pairs: dict) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{k}' AS pair, n_missing, n_a, CAST(100.0 AS DOUBLE) * n_missing / n_a AS pct_missing
FROM (SELECT count(*) FILTER (WHERE aid NOT IN (SELECT aid FROM {b})) AS n_missing, count(*) AS n_a
      FROM (SELECT DISTINCT aid FROM {a}))"""
        for k, (a, b) in pairs.items()
    )


def _tree_sql(tree: dict, node: int = 1) -> str:
    x = tree[node]
    if not isinstance(x, tuple):
        return f"{x:.6f}::DOUBLE"
    return f"CASE WHEN {x[0]}::DOUBLE > {x[1]} THEN {_tree_sql(tree, 2 * node + 1)} ELSE {_tree_sql(tree, 2 * node)} END"


def _curve_sql() -> str:
    """MAP@20 of the running sums of the fixed trees, one SELECT a round."""
    from covisit_spark.plans.catalog import FIXED_TREES

    rounds = " UNION ALL ".join(
        f"SELECT {t + 1} AS round, \"user\", item, carts, origOrder, {' + '.join(_tree_sql(x) for x in FIXED_TREES[: t + 1])} AS score FROM rf_carts"
        for t in range(len(FIXED_TREES))
    )
    return f"""
SELECT round, count(*) AS n_users, CAST(sum(ap_units) AS DOUBLE) / CAST(count(*) AS DOUBLE) / CAST(1000000000 AS DOUBLE) AS map
FROM (
  SELECT round, "user", coalesce(sum((hits * 1000000000) // rank) FILTER (WHERE carts = 1 AND rank <= 20), 0) // least(max(hits), 20) AS ap_units
  FROM (
    SELECT *, sum(carts) OVER (PARTITION BY round, "user" ORDER BY rank) AS hits
    FROM (
      SELECT *, row_number() OVER (PARTITION BY round, "user" ORDER BY score DESC,
               CASE WHEN origOrder > 0 THEN origOrder ELSE 1073741824 END, item) AS rank
      FROM ({rounds})
    )
  ) GROUP BY round, "user" HAVING max(hits) > 0
) GROUP BY round
"""


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    ev = "session, pos, ts, type, aid"
    # A
    q["events_canonical"] = build(f"SELECT {ev} FROM ev_user")
    q["flatten_sessions"] = build(
        """
SELECT session, (pos // 64) * 64 + row_number() OVER (PARTITION BY session, pos // 64 ORDER BY pos) - 1 AS pos,
       ts, type, aid
FROM ev_user
"""
    )
    q["event_type_encode"] = build(
        f"SELECT pos, {TYPE_NAME_SQL.format(c='type')} AS type_name, type FROM ev_user"
    )
    q["events_union"] = build(f"SELECT {ev} FROM s5_train UNION ALL SELECT {ev} FROM s5_hist")
    q["submission_format"] = build(
        f"""
SELECT CAST(session AS VARCHAR) || '_' || type AS session_type,
       string_agg(CAST(aid AS VARCHAR), ' ' ORDER BY rank) AS labels
FROM {SG20['preds']} GROUP BY session, type
"""
    )
    # B
    q["event_time_range"] = build(
        """
SELECT t_min, t_max, t_max - t_min AS span_s, CAST(t_max - t_min AS DOUBLE) / 86400.0 AS span_days, aid_min, aid_max
FROM (SELECT min(ts) AS t_min, max(ts) AS t_max, min(aid) AS aid_min, max(aid) AS aid_max FROM ev_user)
"""
    )
    q["split_profile"] = build(
        " UNION ALL ".join(
            f"SELECT '{k}' AS part, count(*) AS n_rows, count(DISTINCT session) AS n_sessions FROM {v}"
            for k, v in SPLIT5.items()
        )
    )
    pairs = {
        "val_not_in_train": ("s5_clean", "s5_train"),
        "labels_not_in_train": ("s5_lab", "s5_train"),
        "history_not_in_train": ("s5_hist", "s5_train"),
        "val_not_in_recent": ("s5_val", "s5_recent"),
    }
    q["aid_coverage"] = build(_coverage_sql(pairs))
    order_pairs = {
        "train_not_in_val": ("so_train", "so_val"),
        "val_not_in_train": ("so_val", "so_train"),
        "train_not_in_recent": ("so_train", "so_recent"),
        "recent_not_in_val": ("so_recent", "so_val"),
    }
    q["aid_coverage_orders"] = build(_coverage_sql(order_pairs))
    q["session_overlap"] = build(
        "SELECT count(*) AS n_overlap FROM (SELECT DISTINCT session FROM s5_train INTERSECT SELECT DISTINCT session FROM s5_val)"
    )
    # C
    q["time_split"] = build(
        f"SELECT e.session, e.pos, e.ts, e.type, e.aid, CASE WHEN e.ts > m.tmax - 604800 THEN 'val' ELSE 'train' END AS part "
        f"FROM ev_5d e, s5_max m"
    )
    q["train_recent_weeks"] = build(f"SELECT {ev} FROM s5_recent")
    q["val_clean"] = build(f"SELECT {ev} FROM s5_clean")
    q["val_history"] = build(f"SELECT {ev} FROM s5_hist")
    q["val_labels"] = build(f"SELECT {ev} FROM s5_lab")
    q["session_cutoffs"] = build(
        "SELECT session, n, 1 + (session * 7919 + 42) % (n - 1) AS cutoff FROM s5_cut WHERE n >= 2 AND rn = 1"
    )
    q["ground_truth"] = build("SELECT session, type, label_rank, aid FROM s5_gt")
    q["session_sample"] = build(
        """
SELECT session, frac FROM ss_r, (SELECT CAST(unnest([0.05, 0.1, 0.25, 0.5, 1.0]) AS DOUBLE) AS frac) f
WHERE r <= round_even(frac * big_n, 0)
"""
    )
    q["session_lists"] = build(
        """
SELECT session, CAST((rn - 1) // 4 AS INTEGER) AS chunk,
       string_agg(CAST(aid AS VARCHAR), ' ' ORDER BY rn) AS aids,
       string_agg(CAST(type AS VARCHAR), ' ' ORDER BY rn) AS types
FROM (SELECT *, row_number() OVER (PARTITION BY session ORDER BY ts, pos) AS rn FROM s5_hist)
GROUP BY session, (rn - 1) // 4
"""
    )
    q["val_subset"] = build(
        f"SELECT {ev} FROM ev_5d WHERE session IN (SELECT session FROM ss_r WHERE r <= round_even(CAST(0.25 AS DOUBLE) * big_n, 0))"
    )
    # D
    q["recent_events"] = build(f"SELECT {ev} FROM mu_ck_recent")
    q["session_pairs"] = build(
        "SELECT session, aid_x, aid_y, pos_x, pos_y, ts_x, ts_y, type_x, type_y FROM mu_ck_pairs"
    )
    q["session_pairs_distinct"] = build("SELECT session, aid_x, aid_y, ts_x, type_y FROM mu_ck_dedup")
    q["covisit_clicks"] = build(f"SELECT aid_x, aid_y, wgt, rank FROM {M_USER['clicks']}")
    q["covisit_carts"] = build(f"SELECT aid_x, aid_y, wgt, rank FROM {M_USER['carts']}")
    q["covisit_b2b"] = build(f"SELECT aid_x, aid_y, wgt, rank FROM {M_USER['b2b']}")
    q["covisit_lists"] = build(
        f"""
SELECT aid_x, string_agg(CAST(aid_y AS VARCHAR), ' ' ORDER BY rank) AS neighbours
FROM {M_USER['clicks']} GROUP BY aid_x
"""
    )
    q["covisit_pair_weights"] = build(
        f"""
SELECT aid_x, aid_y, CAST(sum({W_TIME}) AS BIGINT) AS clicks_units, CAST(sum({W_TYPE}) AS BIGINT) AS carts_units
FROM mu_ck_dedup d, mu_ck_bounds b GROUP BY aid_x, aid_y
"""
    )
    m_ol = covisit_ctes("mo_bb", "ol_cust", 14, 15, W_UNIT, where="type IN (1, 2)")
    q["covisit_b2b_orders"] = build(f"SELECT aid_x, aid_y, wgt, rank FROM {m_ol}")
    # E
    q["popular_items"] = build("SELECT type, aid, cnt, rank FROM sc_pop")
    q["history_unique"] = build("SELECT session, aid, rec_rank, n_unique FROM sc_uniq")
    q["history_weights"] = build("SELECT session, pos, aid, type, i, n, w_units, term FROM sc_wc")
    q["rerank_history_clicks"] = build(
        "SELECT session, aid, CAST(sum(term) AS BIGINT) AS score FROM sc_wc GROUP BY session, aid"
    )
    q["rerank_history_carts"] = build(f"SELECT session, aid, score FROM {SC['rk_carts']}")
    q["candidate_votes_clicks"] = build(f"SELECT session, aid, src, hist_rank, nbr_rank FROM {SC['vc_clicks']}")
    q["candidate_votes_carts"] = build(f"SELECT session, aid, src, hist_rank, nbr_rank FROM {SC['vc_carts']}")
    for t in ("clicks", "carts"):
        q[f"candidate_topn_{t}"] = build(
            f"SELECT t.session, t.aid, t.votes, t.rank FROM {SC[f'tn_{t}']} t JOIN sc_nhist h USING (session) "
            f"WHERE t.rank <= 20 - h.n_hist"
        )
    q["suggest_clicks"] = build(f"SELECT session, aid, rank FROM {SG20['clicks']}")
    q["suggest_carts"] = build(f"SELECT session, aid, rank FROM {SG20['carts']}")
    q["candidates_top20"] = build(f"SELECT session, type, aid, rank FROM {SG50['preds']} WHERE rank <= 20")
    q["predictions_all"] = build(f"SELECT session, type, aid, rank FROM {SG20['preds']}")
    # H
    q["recall_hits"] = build("SELECT session, type, hits, gt_count FROM p20_rh")
    q["recall_by_type"] = build("SELECT type, hits, gt_count, recall FROM p20_rt")
    q["weighted_recall"] = build("SELECT r_clicks, r_carts, r_orders, recall FROM p20_rw")
    q["recall_at_depths"] = build(
        "SELECT 50 AS depth, * FROM d50_rw UNION ALL SELECT 20 AS depth, * FROM d20_rw"
    )
    q["predictions_orders"] = build(f"SELECT session, type, aid, rank FROM {OC20['preds']}")
    q["weighted_recall_orders"] = build("SELECT r_clicks, r_carts, r_orders, recall FROM oc20_rw")
    q["predictions_time_split"] = build(f"SELECT session, type, aid, rank FROM {TV20['preds']}")
    q["predictions_full_sessions"] = build(f"SELECT session, type, aid, rank FROM {FW20['preds']}")
    q["submission_full_sessions"] = build(
        f"""
SELECT CAST(session AS VARCHAR) || '_' || type AS session_type,
       string_agg(CAST(aid AS VARCHAR), ' ' ORDER BY rank) AS labels
FROM {FW20['preds']} GROUP BY session, type
"""
    )
    q["weighted_recall_time_split"] = build("SELECT r_clicks, r_carts, r_orders, recall FROM tv20_rw")
    # F
    q["candidate_rows"] = build('SELECT "user", item, rank FROM fc_rows')
    q["candidate_rank_feats"] = build('SELECT "user", item, rank, orig20, origOrder FROM fc_rank')
    q["item_features"] = build("SELECT * FROM fi")
    q["user_features"] = build("SELECT * FROM fu")
    q["candidate_features"] = build("SELECT * FROM fc_feat")
    q["candidate_labels"] = build(
        'SELECT r."user", r.item, r.rank, coalesce(l.carts, 0) AS carts FROM fc_rows r LEFT JOIN fc_lab_carts l USING ("user", item)'
    )
    q["recency_features"] = build(
        "SELECT session, pos, aid, type, session_length, action_num_reverse_chrono, log_recency_score FROM fr"
    )
    q["last_typed_event"] = build("SELECT * FROM fl_carts")
    q["ranker_frame"] = build("SELECT * FROM rf_carts")
    q["ranker_frame_orders"] = build("SELECT * FROM rf_orders")
    q["downsample_negatives"] = build('SELECT "user", item, carts FROM ds_carts')
    q["label_density"] = build(
        " UNION ALL ".join(
            f"SELECT '{st}' AS stage, count(*) AS n_rows, CAST(sum(carts) AS BIGINT) AS n_pos, "
            f"CAST(sum(carts) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS density FROM {src}"
            for st, src in (("before", "rf_carts"), ("after", "ds_carts"))
        )
    )
    # G
    q["group_folds"] = build('SELECT DISTINCT "user", CAST(("user" * 7919 + 42) % 5 AS INTEGER) AS fold FROM rf_carts')
    q["group_sizes"] = build(
        'SELECT "user", CAST(("user" * 7919 + 42) % 5 AS INTEGER) AS fold, count(*) AS n_rows FROM rf_carts GROUP BY "user"'
    )
    q["rank_top20"] = build('SELECT "user", item, rank FROM rt20_carts')
    q["map_at_20"] = build(
        """
SELECT count(*) AS n_users, CAST(sum(ap_units) AS DOUBLE) / CAST(count(*) AS DOUBLE) / CAST(1000000000 AS DOUBLE) AS map
FROM (
  SELECT n."user", coalesce(p.sp, 0) // least(n.np, 20) AS ap_units
  FROM (SELECT "user", sum(carts) AS np FROM rf_carts GROUP BY "user" HAVING sum(carts) > 0) n
  LEFT JOIN (
    SELECT "user", sum((cum * 1000000000) // rank) AS sp FROM (
      SELECT r."user", r.rank, coalesce(f.carts, 0) AS hit,
             sum(coalesce(f.carts, 0)) OVER (PARTITION BY r."user" ORDER BY r.rank) AS cum
      FROM rt20_carts r LEFT JOIN rf_carts f USING ("user", item)
    ) WHERE hit = 1 GROUP BY "user"
  ) p USING ("user")
)
"""
    )
    q["map_at_20_by_round"] = build(_curve_sql())
    q["predictions_ranked"] = build(
        f"""
SELECT session, 'clicks' AS type, aid, rank FROM {SG20['clicks']}
UNION ALL SELECT "user" AS session, 'carts' AS type, item AS aid, rank FROM rt20_carts
UNION ALL SELECT "user" AS session, 'orders' AS type, item AS aid, rank FROM rt20_orders
"""
    )
    return q
