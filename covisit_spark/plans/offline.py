"""End-to-end offline flow over one feed, built lazily.

``Offline`` wires the operators the way the recommendation pipeline uses
them: cutoff split of every session into history and labels, three
co-visitation matrices over the training events plus the history (never the
label rows), popular items, candidate lists, predictions for the three
targets and ground truth.

Two validation layouts:

* ``time_split=False``: every session of the feed is a validation session;
  the matrices see only the histories.
* ``time_split=True``: the last week is held out; its sessions that do not
  occur earlier are the validation sessions, and the matrices and item
  features are built from the earlier weeks plus the validation histories.
Attributes are cached per instance, so a query that uses a matrix twice
shares one subplan (Spark reuses the exchange).
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from covisit_spark.operators import candidates as cand
from covisit_spark.operators import covisit as cv
from covisit_spark.operators import split
from covisit_spark.sources import sinks
from covisit_spark.sources.feeds import load_feed

# a stage table of another version of this flow is not read
STAGE_VERSION = 3
# neighbours an item in the clicks and carts matrices
MATRIX_SIZES = {"clicks_units": 20, "carts_units": 15}


class Offline:
    """Lazy pipeline over one feed.

    With ``materialize=True`` (the default) the stage outputs that several
    consumers read - history, labels, the three matrices, popular items, lists - are
    written once as Parquet tables under ``spark.checkpoint.dir`` and read
    back: this cuts the lineage (a lost executor recomputes from the table,
    not from the raw log) and lets every downstream query reuse them. Tables
    are written build-if-absent under a key of the input files (paths, sizes,
    times), the layout and ``train``: a later application reuses them, changed
    files give new ones, and :meth:`drop_old_versions` removes what is stale.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, feed: str = "ev_user", num_cands: int = 20,
                 events: DataFrame | None = None, materialize: bool = True, time_split: bool = False,
                 train: DataFrame | None = None, cutoff: bool = True):
        self.cutoff = cutoff
        self.spark = spark
        self.sf_dir = sf_dir
        self.num_cands = num_cands
        self.materialize = materialize and events is None
        raw = events if events is not None else load_feed(spark, sf_dir, feed)
        self.train = train
        if time_split:
            self.train, val = split.time_split(raw)
            raw = split.remove_overlap(val, self.train)
        self.events = raw
        layout = ("ts" if time_split else "all") + ("" if cutoff else "-full")
        place = hashlib.sha1(sf_dir.encode()).hexdigest()[:10]
        self._set = f"offline/{feed}-{layout}-{place}"
        # the feed's files, and a train frame of its own: its plan and its files
        own = () if train is None else (train.semanticHash(), sinks.fingerprint(train))
        self._version = sinks.fingerprint(raw, STAGE_VERSION, layout, *own) if self.materialize else ""
        self._prefix = f"{self._set}/{self._version}"

    def drop_old_versions(self) -> list[str]:
        """Remove the stage tables of this feed and path that were built from other files or parameters; their keys."""
        return sinks.drop_versions(self.spark, self._set, self._version)

    def _table(self, name: str, build: Callable[[], DataFrame], partition_by: list[str] | None = None) -> DataFrame:
        if not self.materialize:
            return build()
        path = sinks.table_path(self.spark, f"{self._prefix}/{name}")
        return sinks.build_if_absent(self.spark, path, build, partition_by=partition_by)

    @cached_property
    def _cut(self) -> DataFrame:
        """Events with their cutoff, written partitioned by ``part`` (``h``
        history / ``l`` labels) so that history readers prune the label files."""

        def build() -> DataFrame:
            c = split.with_cutoff(self.events)
            return c.withColumn("part", F.when(F.col("rn") <= F.col("cutoff"), F.lit("h")).otherwise(F.lit("l")))

        return self._table("cutoff", build, partition_by=["part"])

    @cached_property
    def history(self) -> DataFrame:
        """The events that predictions start from: up to each session's cutoff,
        or, with ``cutoff=False`` (sessions to predict for, without labels),
        whole sessions, those of one event included."""
        if not self.cutoff:
            return self._table("events", lambda: self.events)
        return self._cut.where(F.col("part") == "h").select(*self.events.columns)

    @cached_property
    def labels(self) -> DataFrame:
        if not self.cutoff:
            raise ValueError("whole sessions have no labels: build Offline with cutoff=True to evaluate")
        return self._cut.where(F.col("part") == "l").select(*self.events.columns)

    @cached_property
    def matrix_source(self) -> DataFrame:
        """Events the matrices and item features are built from: the training
        events (if any) plus the validation histories - never the labels."""
        if self.train is None:
            return self.history
        return self.train.select(*self.events.columns).unionByName(self.history)

    @cached_property
    def top_pairs(self) -> DataFrame:
        """The 1-day pairs of the clicks and carts matrices, from one pair pass; at most 35 an item are stored."""

        def build() -> DataFrame:
            sums = cv.pair_weights(self.matrix_source)
            if self.materialize:  # the shuffles of the sums are gone when those of the rankings are made
                sums = sinks.write_table(sums, scratch)
            return cv.top_pairs(sums, MATRIX_SIZES)

        scratch = f"{self._prefix}/pair_sums.{uuid.uuid4().hex}"
        pairs = self._table("top_pairs_1d", build)
        if self.materialize:
            sinks.drop_table(self.spark, scratch)
        return pairs

    @cached_property
    def clicks_matrix(self) -> DataFrame:
        return cv.matrix_of(self.top_pairs, "clicks_units", MATRIX_SIZES["clicks_units"])

    @cached_property
    def carts_matrix(self) -> DataFrame:
        return cv.matrix_of(self.top_pairs, "carts_units", MATRIX_SIZES["carts_units"])

    @cached_property
    def b2b_matrix(self) -> DataFrame:
        return self._table("covisit_b2b", lambda: cv.covisit_b2b(self.matrix_source))

    @cached_property
    def popular(self) -> DataFrame:
        return self._table("popular", lambda: cand.popular_items(self.history))

    @cached_property
    def items(self) -> DataFrame:
        """Per ``(session, item)`` ranks and scores of the history."""
        return self._table("session_items", lambda: cand.session_items(self.history, bound_by=self.events))

    def clicks(self, n: int | None = None) -> DataFrame:
        n = n or self.num_cands
        return self._table(
            f"clicks_{n}", lambda: cand.suggest_clicks(self.history, self.clicks_matrix, self.popular, n, items=self.items)
        )

    def carts(self, n: int | None = None) -> DataFrame:
        """Candidates for carts and orders, as of :func:`suggest_carts`; the lists of short sessions are a table, so that
        a query over all holds the shuffles of the long ones only."""
        n = n or self.num_cands
        m = self.clicks_matrix, self.carts_matrix, self.b2b_matrix
        short = self._table(f"carts_short_{n}", lambda: cand.short_carts(self.items, *m, self.popular, n))
        return cand.long_carts(self.items, self.carts_matrix, n).unionByName(short)

    def predictions(self, n: int | None = None) -> DataFrame:
        return cand.assemble_predictions(self.clicks(n), self.carts(n))

    def stored_predictions(self, n: int | None = None) -> DataFrame:
        """:meth:`predictions` from stored lists, dealt by session: a query that reads them more than once makes none of
        them again and holds none of their shuffles."""
        n = n or self.num_cands
        carts = self._table(f"carts_{n}", lambda: self.carts(n))
        return sinks.spread(cand.assemble_predictions(self.clicks(n), carts), "session", self.items)

    @cached_property
    def truth(self) -> DataFrame:
        return self._table("truth", lambda: split.ground_truth(self.labels))

    # --- ranker inputs -------------------------------------------------------
    def candidate_frame(self, target: str = "carts", n: int = 50, with_labels: bool = True) -> DataFrame:
        """Cart candidates (the list used for carts and orders) with rank,
        item, user and recency features and the 0/1 label of ``target``."""
        from covisit_spark.operators import features as ft

        cands = ft.rank_features(ft.candidate_rows(self.carts(n)))
        f = ft.candidate_features(cands, ft.item_features(self.matrix_source), ft.user_features(self.history))
        if with_labels:
            f = ft.candidate_labels(f, self.truth, target)
        last = ft.last_typed_event(ft.recency_features(self.history, bound_by=self.events), target)
        return ft.ranker_frame(f, last)

    def ranker_inputs(self, target: str, n: int = 50) -> DataFrame:
        """Candidate frame with folds, materialised (several models read it)."""
        from covisit_spark.operators import ranker as rk

        return self._table(f"ranker_frame_{target}_{n}", lambda: rk.group_folds(self.candidate_frame(target, n)))


def build_matrices(spark: SparkSession, events: DataFrame, out_dir: str) -> dict[str, DataFrame]:
    """Build the three co-visitation matrices from ``events`` and store them
    as Parquet tables ``out_dir/{clicks,carts,b2b}/<key>``, the key standing for the
    input files and the plan of ``events``; a table that is already complete is
    read instead of rebuilt. Returns the tables read back."""
    out = out_dir.rstrip("/")
    key = sinks.fingerprint(events, STAGE_VERSION, events.semanticHash())
    # clicks and carts are two rankings of one table of pairs
    pairs = sinks.build_if_absent(spark, f"{out}/pairs/{key}", lambda: cv.top_pairs(cv.pair_weights(events), MATRIX_SIZES))
    builders = {
        "clicks": lambda: cv.matrix_of(pairs, "clicks_units", MATRIX_SIZES["clicks_units"]),
        "carts": lambda: cv.matrix_of(pairs, "carts_units", MATRIX_SIZES["carts_units"]),
        "b2b": lambda: cv.covisit_b2b(events),
    }
    return {name: sinks.build_if_absent(spark, f"{out}/{name}/{key}", build) for name, build in builders.items()}


def ranker_sweep(
    offline: Offline,
    grid: list[dict],
    targets: tuple[str, ...] = ("carts", "orders"),
    num_avg: int = 1,
    neg_frac: float = 0.3,
) -> DataFrame:
    """Train and evaluate one ranker per target and configuration.

    Per configuration: for each target, ``num_avg`` models (model ``f``
    validates on fold ``f``) are trained on the down-sampled frame, their
    mean score re-ranks the 50 candidates to 20, and MAP@20 is the mean over the
    models, each on its validation fold; the re-ranked carts/orders lists replace the co-visitation
    lists and the weighted recall is computed. Returns one row per
    configuration (the loop runs Spark jobs; only metrics reach the driver).
    """
    from pyspark.sql import functions as F

    from covisit_spark.operators import evaluate as ev
    from covisit_spark.operators import features as ft
    from covisit_spark.operators import ranker as rk

    spark = offline.spark
    clicks = offline.clicks(20).select("session", F.lit("clicks").alias("type"), "aid", "rank")
    rows = []
    for i, cfg in enumerate(grid):
        lists, maps = [clicks], {}
        for target in targets:
            frame = offline.ranker_inputs(target)
            train = ft.downsample_negatives(frame, target, neg_frac)
            models = [rk.train_ranker(train, target, valid_fold=f, params=cfg) for f in range(num_avg)]
            ranked = rk.rank_top(rk.score(models, frame), 20)
            # each model is measured on the users of its own validation fold, which it has not trained on
            held = [frame.where(F.col("fold") == f) for f in range(num_avg)]
            per_fold = [
                rk.map_at_k(rk.rank_top(rk.score([m], h), 20), h, target, 20).first()["map"] or 0.0
                for m, h in zip(models, held, strict=True)
            ]
            maps[target] = sum(per_fold) / len(per_fold)
            lists.append(
                ranked.select(F.col("user").alias("session"), F.lit(target).alias("type"), F.col("item").alias("aid"), "rank")
            )
        preds = lists[0]
        for extra in lists[1:]:
            preds = preds.unionByName(extra)
        r = ev.weighted_recall(ev.recall_by_type(ev.recall_hits(preds, offline.truth))).first()
        rows.append(
            (i, str(sorted(cfg.items())), float(r.r_clicks), float(r.r_carts), float(r.r_orders), float(r.recall),
             float(maps.get("carts") or 0.0), float(maps.get("orders") or 0.0))
        )
    return spark.createDataFrame(
        rows,
        "config_id int, params string, r_clicks double, r_carts double, r_orders double, recall double, "
        "map_carts double, map_orders double",
    )
