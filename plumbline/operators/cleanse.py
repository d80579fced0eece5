"""Cleansing chain, test-set corruption and audit of event tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as V
from ..sources.sampling import Family, key_hash, nth_smallest, picked
from .checks import EventRules
from .duplicates import duplicate_counts


def _stages(events: DataFrame, cfg: EventRules):
    """Distinct rows with their copy count, the conditions of the steps, and the transactions to dedupe."""
    c = F.col
    distinct = events.groupBy(*events.columns).agg(F.count("*").alias("_copies"))
    is_txn = F.coalesce(c("event") == cfg.transaction, F.lit(False))
    bad_txn = is_txn & c("transactionid").isNull()
    valid = F.coalesce(c("event").isin(*cfg.valid_events), F.lit(False))
    in_window = F.coalesce(c(cfg.time).between(F.lit(cfg.window_start), F.lit(cfg.window_end)), F.lit(False))
    txns = distinct.filter(is_txn & c("transactionid").isNotNull() & valid)
    return distinct, is_txn, bad_txn, valid, in_window, txns


def clean(events: DataFrame, cfg: EventRules) -> DataFrame:
    """Full-row dedupe, drop id-less transactions and unknown events, first row per
    transaction id, observation window.

    The first transaction of an id is the minimum of a (time, tie, rest) struct, rows
    without time last: an aggregation, so an id that holds a large share of the rows is
    reduced map-side instead of being sorted in one window partition.
    """
    distinct, is_txn, _, valid, in_window, txns = _stages(events, cfg)
    lead = [cfg.time] + ([cfg.tie] if cfg.tie else [])
    rest = [x for x in events.columns if x not in lead]
    row = F.struct(F.col(cfg.time).isNull().alias("_untimed"), *lead, *rest)
    firsts = txns.groupBy("transactionid").agg(F.min(row).alias("row"))
    browsing = distinct.filter(valid & ~is_txn & in_window).select(*events.columns)
    return browsing.unionByName(firsts.select("row.*").filter(in_window).select(*events.columns))


def clean_audit(events: DataFrame, cfg: EventRules) -> DataFrame:
    """Rows removed by each cleansing step, in step order.

    Only the time of an id's first transaction matters here, so a plain minimum will do.
    """
    c = F.col
    distinct, is_txn, bad_txn, valid, in_window, txns = _stages(events, cfg)
    firsts = txns.groupBy("transactionid").agg(F.min(cfg.time).alias(cfg.time), F.count("*").alias("_members"))

    def steps(df, *items):
        rows = [F.struct(F.lit(n).alias("step_no"), F.lit(name).alias("step"), c(col).alias("rows_removed")) for n, name, col in items]
        return df.select(F.inline(F.array(*rows)))

    one = steps(
        distinct.agg(
            F.coalesce(F.sum(c("_copies") - 1), F.lit(0)).alias("dup"), F.count_if(bad_txn).alias("no_id"),
            F.count_if(~bad_txn & ~valid).alias("bad_event"), F.count_if(valid & ~is_txn & ~in_window).alias("outside")),
        (1, "duplicate_rows", "dup"), (2, "txn_without_id", "no_id"), (3, "invalid_event", "bad_event"), (5, "out_of_window", "outside"))
    two = steps(
        firsts.agg(F.coalesce(F.sum(c("_members") - 1), F.lit(0)).alias("dup"), F.count_if(~in_window).alias("outside")),
        (4, "duplicate_txn_id", "dup"), (5, "out_of_window", "outside"))
    return one.unionByName(two).groupBy("step_no", "step").agg(F.sum("rows_removed").alias("rows_removed"))


class Corruptor:
    """Seeded defects for building test sets of known quality.

    Rows are picked by the hash of the unique integer ``key``, never by ``rand()``: a
    re-run, another partitioning or a recomputed task picks the same rows. Every defect
    is a row-wise expression, so a whole tier is one pass over the clean set ``base``.
    A count ("150 rows") becomes the n-th smallest (hash, key) of the base. These are looked
    up by two jobs over the base, for all counts of all tiers at once; give a base that was
    written once, not one that is computed anew each time.
    """

    #: extra rows, extra transactions and moved times of each tier
    TIER_COUNTS = {"light": (150, 0, 0), "moderate": (250, 100, 200), "severe": (700, 400, 700)}
    ROWS, TRANSACTIONS, TIMES = 5, 6, 8  # seeds of the counted defects

    def __init__(self, base: DataFrame, key: str, cfg: EventRules, out_of_window=V.OUT_OF_WINDOW_MS):
        self.base, self.key, self.cfg, self.out_of_window = base, key, cfg, out_of_window
        self._marks: dict[tuple[int, bool, int], tuple | None] = {}

    def select(self, wanted: list[tuple[int, bool, int]]) -> None:
        """Look up the marks of (seed, transactions only, number of rows), all in the same two jobs."""
        missing = [w for w in dict.fromkeys(wanted) if w not in self._marks and w[2] > 0]
        families = {}
        for seed, only, n in missing:
            where = F.col("event") == self.cfg.transaction if only else None
            families.setdefault((seed, only), Family(key_hash(F.col(self.key), seed), [], where)).sizes.append(n)
        found = nth_smallest(self.base, list(families.values()), self.key) if families else []
        for (seed, only), marks in zip(families, found):
            self._marks.update({(seed, only, n): mark for n, mark in marks.items()})

    def _share(self, seed: int, share: float) -> Column:
        return picked(key_hash(F.col(self.key), seed), share)

    def _first(self, seed: int, n: int, only: bool = False) -> Column:
        """True for the n keys with the smallest hash among the rows, or the transactions, of the base."""
        if n <= 0:
            return F.lit(False)
        self.select([(seed, only, n)])
        mark = self._marks[seed, only, n]
        if mark is None:
            return F.lit(True)  # fewer rows than that
        h, key = key_hash(F.col(self.key), seed), F.col(self.key).cast("long")
        return (h < mark[0]) | ((h == mark[0]) & (key <= mark[1]))

    def _replace(self, df, column, cond, value):
        return df.withColumn(column, F.when(cond, value).otherwise(F.col(column)))

    def null_visitors(self, df, share, seed=1):
        return self._replace(df, "visitorid", self._share(seed, share), F.lit(None))

    def null_items(self, df, share, seed=2):
        return self._replace(df, "itemid", self._share(seed, share), F.lit(None))

    def null_transaction_ids(self, df, share, seed=3):
        hit = (F.col("event") == self.cfg.transaction) & self._share(seed, share)
        return self._replace(df, "transactionid", hit, F.lit(None))

    def ids_on_views(self, df, share, seed=4):
        hit = (F.col("event") == "view") & self._share(seed, share)
        return self._replace(df, "transactionid", hit, F.format_string("FAKE_TXN_%06d", F.col(self.key)))

    def _repeat(self, df, extra: Column):
        return df.withColumn("_copy", F.explode(F.sequence(F.lit(0), extra.cast("int")))).drop("_copy")

    def duplicate_rows(self, df, n, seed=ROWS):
        """Append one copy of n rows."""
        return self._repeat(df, self._first(seed, n))

    def duplicate_transactions(self, df, n, seed=TRANSACTIONS):
        """Append one copy of n transaction rows."""
        hit = F.coalesce(F.col("event") == self.cfg.transaction, F.lit(False)) & self._first(seed, n, only=True)
        return self._repeat(df, hit)

    def invalid_events(self, df, share, seed=7, values=V.INVALID_EVENT_SAMPLES):
        choice = F.element_at(F.array(*[F.lit(v) for v in values]), (F.pmod(F.col(self.key), F.lit(len(values))) + 1).cast("int"))
        return self._replace(df, "event", self._share(seed, share), choice)

    def out_of_range_times(self, df, n, seed=TIMES):
        """Move the time of n rows out of the window."""
        return self._replace(df, self.cfg.time, self._first(seed, n), F.lit(self.out_of_window))

    def unknown_items(self, df, share, seed=9):
        fake = F.lit(9_000_000) + F.pmod(key_hash(F.col(self.key), seed + 1), F.lit(999_999))
        return self._replace(df, "itemid", self._share(seed, share), fake.cast("long"))

    # ---- tiers: each is built from the clean set
    def light(self, df):
        rows, _, _ = self.TIER_COUNTS["light"]
        df = self.null_visitors(df, 0.005)
        df = self.duplicate_rows(df, rows)
        return self.invalid_events(df, 0.005)

    def moderate(self, df):
        rows, txns, times = self.TIER_COUNTS["moderate"]
        df = self.null_visitors(df, 0.010)
        df = self.null_transaction_ids(df, 0.015)
        df = self.duplicate_rows(df, rows)
        df = self.duplicate_transactions(df, txns)
        df = self.invalid_events(df, 0.008)
        return self.out_of_range_times(df, times)

    def severe(self, df):
        rows, txns, times = self.TIER_COUNTS["severe"]
        df = self.null_visitors(df, 0.04)
        df = self.null_items(df, 0.025)
        df = self.null_transaction_ids(df, 0.05)
        df = self.ids_on_views(df, 0.015)
        df = self.duplicate_rows(df, rows)
        df = self.duplicate_transactions(df, txns)
        df = self.invalid_events(df, 0.025)
        df = self.out_of_range_times(df, times)
        return self.unknown_items(df, 0.06)

    def tiers(self) -> DataFrame:
        """All four tiers of the clean set in one frame with a ``tier`` column."""
        counts = self.TIER_COUNTS.values()
        self.select([(seed, seed == self.TRANSACTIONS, row[i]) for row in counts for i, seed in enumerate((self.ROWS, self.TRANSACTIONS, self.TIMES))])
        out = self.base.withColumn("tier", F.lit("clean"))
        for name in ("light", "moderate", "severe"):
            out = out.unionByName(getattr(self, name)(self.base).withColumn("tier", F.lit(name)))
        return out


def audit(events: DataFrame, cfg: EventRules, by: list[str]) -> DataFrame:
    """Defect counters per group: one fused scan plus two per-key counts."""
    c = F.col
    is_txn = F.coalesce(c("event") == cfg.transaction, F.lit(False))
    fused = events.groupBy(*by).agg(
        F.count("*").alias("total_rows"),
        F.count_if(c("visitorid").isNull()).alias("null_visitorid"),
        F.count_if(c("itemid").isNull()).alias("null_itemid"),
        F.count_if(F.coalesce(~c("event").isin(*cfg.valid_events), F.lit(False))).alias("invalid_events"),
        F.count_if(is_txn).alias("transaction_rows"),
        F.count_if(is_txn & c("transactionid").isNull()).alias("txn_without_id"),
        F.count_if(F.coalesce(~c(cfg.time).between(F.lit(cfg.window_start), F.lit(cfg.window_end)), F.lit(False))).alias("out_of_range"),
    )
    dup_rows = duplicate_counts(events, by).select(*by, c("_extra").alias("duplicate_rows"))
    ids = events.filter(is_txn & c("transactionid").isNotNull()).groupBy(*by, "transactionid").agg(F.count("*").alias("_n"))
    dup_ids = ids.groupBy(*by).agg(F.sum(c("_n") - 1).alias("duplicate_txn_ids"))
    out = fused.join(dup_rows, by).join(dup_ids, by, "left")
    return out.withColumn("duplicate_txn_ids", F.coalesce("duplicate_txn_ids", F.lit(0)))
