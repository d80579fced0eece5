"""The sixteen event-quality checks as a handful of fused Spark jobs.

Shape of the work for a table of any size:

* every row-level check, the latest timestamp and the set of active days come from
  ONE scan: counters grouped by calendar day, combined on the map side, so the
  shuffle carries (batches x days) rows;
* the keyed checks (duplicate ids, duplicate rows, first event per visitor, orphan
  items) count per key first, all in one shuffle of tagged keys where one data set is
  checked. Rows of a hot key collapse before the shuffle and no window or collected
  group ever holds the raw rows of a key;
* reference tables are joined after that reduction and without broadcast hints, so
  Spark picks broadcast or shuffled joins from their measured size.

``by`` adds batch keys, so many datasets or days are checked in one job.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixed_values as V
from ..functions.exprs import event_date, percent, small_table, wall_micros
from .duplicates import duplicate_counts, fingerprint, members

ALL_CHECKS = tuple(c[0] for c in V.EVENT_CHECKS)
_DAILY = ("COMP-001", "COMP-002", "COMP-003", "COMP-004", "VALID-001", "VALID-002", "VALID-003",
          "CONS-001", "CONS-002", "FRESH-001", "FRESH-002")
_KEYED = ("UNIQ-001", "UNIQ-002", "CONS-003", "RI-001")


@dataclass(frozen=True)
class EventRules:
    """Parameters of the event checks; the window bounds are both inclusive."""

    window_start: Any = V.WINDOW_START_MS
    window_end: Any = V.WINDOW_END_MS
    valid_events: tuple = V.VALID_EVENTS
    browse_events: tuple = V.BROWSE_EVENTS
    transaction: str = V.TRANSACTION
    gap_days: int = V.GAP_ALERT_DAYS
    time: str = "timestamp"
    tie: str | None = None  # breaks equal timestamps in the first-event check


def row_conditions(cfg: EventRules) -> dict[str, Column]:
    """Failing-row predicate of every row-level check (never null)."""
    c = F.col
    event, ts = c("event"), c(cfg.time)
    is_txn = F.coalesce(event == cfg.transaction, F.lit(False))
    no_id = is_txn & c("transactionid").isNull()
    return {
        "COMP-001": c("visitorid").isNull(),
        "COMP-002": c("itemid").isNull(),
        "COMP-003": event.isNull(),
        "COMP-004": no_id,
        "VALID-001": F.coalesce(~event.isin(*cfg.valid_events), F.lit(False)),
        "VALID-002": F.coalesce(~ts.between(F.lit(cfg.window_start), F.lit(cfg.window_end)), F.lit(False)),
        "VALID-003": F.coalesce(c("itemid") <= 0, F.lit(False)),
        "CONS-001": no_id,
        "CONS-002": F.coalesce(event.isin(*cfg.browse_events), F.lit(False)) & c("transactionid").isNotNull(),
    }


def _finding(rule: str, total: Column, failed: Column, gap: Column | None = None) -> Column:
    gap = F.lit(None) if gap is None else gap
    return F.struct(
        F.lit(rule).alias("rule_id"), total.cast("long").alias("total_records"),
        failed.cast("long").alias("failed_records"), gap.cast("int").alias("gap_days"))


def _day_text(moment) -> Column:
    """A window bound as a date: epoch milliseconds or a timestamp."""
    value = moment if isinstance(moment, Column) else F.lit(moment)
    if not isinstance(moment, Column) and isinstance(moment, (int, float)):
        value = F.timestamp_millis(F.lit(int(moment)))
    return F.date_format(value, "yyyy-MM-dd")


def _described(found: DataFrame, cfg: EventRules) -> DataFrame:
    """Add position, text, dimension and severity of each rule; texts name the parameters in use."""
    rows = [(i, *c) for i, c in enumerate(V.EVENT_CHECKS, 1)]
    ddl = "ordinal INT, rule_id STRING, rule_desc STRING, dimension STRING, severity STRING"
    told = found.join(small_table(found.sparkSession, ddl, rows), "rule_id")
    head, tail = V.WINDOW_TEXT
    window = F.concat(F.lit(head), _day_text(cfg.window_start), F.lit(" to "), _day_text(cfg.window_end), F.lit(tail))
    gap = F.lit(V.GAP_TEXT.format(days=cfg.gap_days))
    events = F.lit(V.ALLOWED_TEXT + ", ".join(cfg.valid_events))
    rule = F.col("rule_id")
    return told.withColumn("rule_desc", F.when(rule == "VALID-002", window).when(rule == "FRESH-002", gap).when(rule == "VALID-001", events).otherwise(F.col("rule_desc")))


def _rows(df: DataFrame, by: list[str], findings: list[Column]) -> DataFrame:
    return df.select(*by, F.inline(F.array(*findings)))


def daily_counters(events: DataFrame, cfg: EventRules, by: list[str], rules) -> DataFrame:
    """Additive counters per (batch, calendar day): the single fused scan."""
    cond = row_conditions(cfg)
    is_txn = F.coalesce(F.col("event") == cfg.transaction, F.lit(False))
    is_browse = F.coalesce(F.col("event").isin(*cfg.browse_events), F.lit(False))
    aggs = [F.count("*").alias("n_rows")]
    if {"COMP-004", "CONS-001"} & set(rules):
        aggs.append(F.count_if(is_txn).alias("n_txn"))
    if "CONS-002" in rules:
        aggs.append(F.count_if(is_browse).alias("n_browse"))
    if "FRESH-001" in rules:
        aggs.append(F.max(cfg.time).alias("latest"))
    aggs += [F.count_if(cond[r]).alias(f"bad_{r}") for r in rules if r in cond and r != "CONS-001"]
    if "CONS-001" in rules and "COMP-004" not in rules:
        aggs.append(F.count_if(cond["CONS-001"]).alias("bad_COMP-004"))
    return events.groupBy(*by, event_date(events, cfg.time).alias("_day")).agg(*aggs)


def _daily_findings(events, cfg, by, rules, extra=()) -> DataFrame:
    days = daily_counters(events, cfg, by, rules)
    aggs = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in days.columns if c.startswith(("n_", "bad_"))]
    if "FRESH-001" in rules:
        aggs.append(F.max("latest").alias("latest"))
    if "FRESH-002" in rules:
        # only active days are sorted: one row per day and batch
        prev = F.lag("_day").over(Window.partitionBy(*by).orderBy("_day"))
        days = days.withColumn("_idle", F.when(F.col("_day").isNotNull(), F.date_diff("_day", prev) - 1))
        aggs += [
            F.coalesce(F.max("_idle"), F.lit(0)).alias("longest"),
            F.coalesce(F.date_diff(F.max("_day"), F.min("_day")) + 1, F.lit(1)).alias("span"),
        ]
    totals = days.groupBy(*by).agg(*aggs)
    c = F.col
    found = []
    for rule in rules:
        if rule == "FRESH-001":
            stale = F.coalesce(~c("latest").between(F.lit(cfg.window_start), F.lit(cfg.window_end)), F.lit(True))
            found.append(_finding(rule, F.lit(1), stale.cast("long")))
        elif rule == "FRESH-002":
            alert = F.when(c("longest") >= cfg.gap_days, c("longest")).otherwise(0)
            found.append(_finding(rule, c("span"), alert, c("longest")))
        else:
            total = {"COMP-004": "n_txn", "CONS-001": "n_txn", "CONS-002": "n_browse"}.get(rule, "n_rows")
            bad = "bad_COMP-004" if rule == "CONS-001" else f"bad_{rule}"
            found.append(_finding(rule, c(total), c(bad)))
    return _rows(totals, by, [*found, *extra])


def _duplicate_ids(events, cfg, by) -> DataFrame:
    # rows that are no transaction with an id share one null key, so no batch gets lost
    counted = F.when(F.col("event") == cfg.transaction, F.col("transactionid"))
    per_id = events.groupBy(*by, counted.alias("_id")).agg(F.count(counted).alias("n"))
    # every member of a repeated id counts
    agg = per_id.groupBy(*by).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("t"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("f"),
    )
    return _rows(agg, by, [_finding("UNIQ-001", F.col("t"), F.col("f"))])


def _duplicate_rows(events, by) -> DataFrame:
    # nulls are equal; only the extra copies count
    return _rows(duplicate_counts(events, by), by, [_finding("UNIQ-002", F.col("_rows"), F.col("_extra"))])


#: multiplier that puts a time before any 64-bit tie, and the times (beyond any calendar) it holds for
_TIE_RANGE, _TIME_BOUND = str(1 << 64), 5 * 10**18


def _moment(cfg: EventRules, events: DataFrame) -> Column:
    """Time, then tie, as one number: its minimum is kept in place by a hash aggregation."""
    kind = events.schema[cfg.time].dataType
    time = F.col(cfg.time) if isinstance(kind, T.IntegralType) else wall_micros(F.col(cfg.time))
    if cfg.tie is None:
        return time.cast("decimal(38,0)")
    bounded = F.greatest(F.least(time, F.lit(_TIME_BOUND)), F.lit(-_TIME_BOUND)).cast("decimal(19,0)")
    tie = F.coalesce(F.col(cfg.tie).cast("long"), F.lit((1 << 63) - 1)).cast("decimal(19,0)")
    # the bounds pass over nulls; an event without time has no moment
    return F.when(time.isNotNull(), (bounded * F.lit(_TIE_RANGE).cast("decimal(20,0)") + tie).cast("decimal(38,0)"))


def _can_fuse(events: DataFrame, cfg: EventRules) -> bool:
    timed = isinstance(events.schema[cfg.time].dataType, (T.IntegralType, T.TimestampType, T.TimestampNTZType))
    return timed and (cfg.tie is None or isinstance(events.schema[cfg.tie].dataType, T.IntegralType))


def _keyed_findings(events: DataFrame, items: DataFrame | None, cfg: EventRules, rules: list[str]) -> DataFrame:
    """The keyed checks of one data set from one shuffle of tagged keys.

    A row gives one (check, key) pair per check: its transaction id, its fingerprint, its
    visitor and its item; the catalog adds its items as known. One aggregation counts all of
    them, so the events are scanned once here instead of once per check. Rows with repeated
    fingerprints are then verified as full rows (see ``duplicates``), from the same shuffle.
    """
    c = F.col
    txn = F.coalesce(c("event") == cfg.transaction, F.lit(False))
    moment = _moment(cfg, events)

    def key(rule: str, where: Column | None = None, number=None, second=None, text=None, timed=None, txn_at=None, other_at=None) -> Column:
        fields = (("rule", F.lit(ALL_CHECKS.index(rule)), "int"), ("a", number, "bigint"), ("b", second, "bigint"), ("text", text, "string"), ("rows", F.lit(1), "int"),
                  ("timed", timed, "int"), ("txn_at", txn_at, "decimal(38,0)"), ("other_at", other_at, "decimal(38,0)"))
        row = F.struct(*[(F.lit(None) if v is None else v).cast(t).alias(n) for n, v, t in fields])
        return row if where is None else F.when(where, row)

    def plain(column: str) -> dict:
        """An id as a number, or as text if it is none."""
        return {"number": c(column)} if isinstance(events.schema[column].dataType, T.IntegralType) else {"text": c(column).cast("string")}

    keys = []
    if "UNIQ-001" in rules:
        keys.append(key("UNIQ-001", txn & c("transactionid").isNotNull(), text=c("transactionid").cast("string")))
    if "UNIQ-002" in rules:
        first, second = fingerprint(events.columns)
        keys.append(key("UNIQ-002", number=first, second=second))
    if "CONS-003" in rules:
        other = c("event").isNotNull() & ~txn
        keys.append(key("CONS-003", **plain("visitorid"), timed=c(cfg.time).isNotNull(), txn_at=F.when(txn, moment), other_at=F.when(other, moment)))
    if "RI-001" in rules:
        keys.append(key("RI-001", **plain("itemid")))
    tagged = events.select(F.explode(F.array_compact(F.array(*keys))).alias("_key")).select("_key.*")
    if "RI-001" in rules:
        known = key("RI-001", **plain("itemid")).withField("rows", F.lit(0))
        tagged = tagged.unionByName(items.filter(c("itemid").isNotNull()).select(c("itemid").cast(events.schema["itemid"].dataType)).select(known.alias("_key")).select("_key.*"))
    of = {r: c("rule") == ALL_CHECKS.index(r) for r in rules}
    per_key = tagged.groupBy("rule", "a", "b", "text").agg(
        F.sum("rows").alias("n"), F.sum("timed").alias("timed"), F.min("txn_at").alias("txn_at"), F.min("other_at").alias("other_at"), F.count_if(c("rows") == 0).alias("known"),
        F.count("b").alias("prints"))
    named = c("a").isNotNull() | c("text").isNotNull()

    def total(rule: str, where: Column | None = None, what: Column | None = None) -> Column:
        return F.coalesce(F.sum(F.when(of[rule] if where is None else of[rule] & where, c("n") if what is None else what)), F.lit(0))

    aggs, found = {}, []
    if "UNIQ-001" in rules:
        aggs |= {"t1": total("UNIQ-001"), "f1": total("UNIQ-001", c("n") > 1)}
        found.append(_finding("UNIQ-001", c("t1"), c("f1")))
    if "UNIQ-002" in rules:
        # a fingerprint has no other measure; asking for all of them, and for no key, lets this use and the totals share one shuffle
        print_only = (c("prints") > 0) & (c("known") == 0) & c("timed").isNull() & c("txn_at").isNull() & c("other_at").isNull()
        again = per_key.filter((c("n") > 1) & print_only).select(F.coalesce("a", F.lit(0)).alias("_fp_a"), F.coalesce("b", F.lit(0)).alias("_fp_b"))
        extra = members(events, again).agg(F.coalesce(F.sum(c("_n") - 1), F.lit(0)))
        aggs["t2"] = F.coalesce(F.sum(F.when(c("prints") > 0, c("n"))), F.lit(0))
        found.append(_finding("UNIQ-002", c("t2"), extra.scalar()))
    if "CONS-003" in rules:
        first = named & c("txn_at").isNotNull() & (c("other_at").isNull() | (c("txn_at") < c("other_at")))
        aggs |= {"t3": total("CONS-003"), "v3": total("CONS-003", named & (c("timed") > 0), F.lit(1)), "f3": total("CONS-003", first, F.lit(1))}
        found.append(_finding("CONS-003", F.when(c("v3") > 0, c("v3")).otherwise(c("t3")), c("f3")))
    if "RI-001" in rules:
        aggs |= {"t4": total("RI-001"), "f4": total("RI-001", named & (c("known") == 0))}
        found.append(_finding("RI-001", c("t4"), c("f4")))
    return _rows(per_key.agg(*[a.alias(n) for n, a in aggs.items()]), [], found)


def _first_events(events, cfg, by) -> DataFrame:
    """Visitors whose first non-null event is a transaction.

    Two minima per visitor decide all visitors but those whose first transaction and
    first other event share a timestamp. The minima are plain timestamps, so this stays
    a hash aggregation with map-side combine (a minimum of structs would sort the rows).
    With ``tie`` set, the rows at the shared timestamp of these few visitors settle the
    order. Both uses of the per-visitor table read the same shuffle; when no visitor is
    tied, the runtime finds the join empty and skips its scan.
    """
    c = F.col
    txn = c("event") == cfg.transaction
    other = c("event").isNotNull() & ~txn
    keys = [*by, "visitorid"]
    # rows without a visitor are one group, so the same pass counts all rows
    per_visitor = events.groupBy(*keys).agg(
        F.count("*").alias("n"), F.count(cfg.time).alias("timed"),
        F.min(F.when(txn, c(cfg.time))).alias("txn_at"), F.min(F.when(other, c(cfg.time))).alias("other_at"))
    named = c("visitorid").isNotNull()
    sure = named & c("txn_at").isNotNull() & (c("other_at").isNull() | (c("txn_at") < c("other_at")))
    agg = per_visitor.groupBy(*by).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count_if(named & (c("timed") > 0)).alias("visitors"), F.count_if(sure).alias("f"))
    if cfg.tie:
        ties = per_visitor.filter(named & (c("txn_at") == c("other_at"))).select(*keys, c("txn_at").alias(cfg.time))
        settled = (
            events.filter(c("event").isNotNull()).select(*keys, cfg.time, cfg.tie, "event")
            .join(ties, [*keys, cfg.time])
            .groupBy(*keys).agg((F.min(F.when(txn, c(cfg.tie))) < F.min(F.when(other, c(cfg.tie)))).alias("first"))
            .groupBy(*by).agg(F.count_if("first").alias("f2"))
        )
        if by:
            agg = agg.join(settled, by, "left").withColumn("f", c("f") + F.coalesce("f2", F.lit(0)))
        else:
            agg = agg.withColumn("f", c("f") + settled.scalar())
    # without any valid visitor the check counts the rows and finds nothing
    total = F.when(c("visitors") > 0, c("visitors")).otherwise(c("rows"))
    return _rows(agg, by, [_finding("CONS-003", total, c("f"))])


def _orphan_items(events, items, by) -> DataFrame:
    per_item = events.groupBy(*by, "itemid").agg(F.count("*").alias("n"))
    known = items.filter(F.col("itemid").isNotNull()).select("itemid").distinct().withColumn("_known", F.lit(True))
    agg = per_item.join(known, "itemid", "left").groupBy(*by).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("t"),
        F.coalesce(F.sum(F.when(F.col("itemid").isNotNull() & F.col("_known").isNull(), F.col("n"))), F.lit(0)).alias("f"),
    )
    return _rows(agg, by, [_finding("RI-001", F.col("t"), F.col("f"))])


def _orphan_categories(items, categories) -> DataFrame:
    per_category = items.filter(F.col("categoryid").isNotNull()).groupBy("categoryid").agg(F.count("*").alias("n"))
    known = categories.filter(F.col("categoryid").isNotNull()).select("categoryid").distinct().withColumn("_known", F.lit(True))
    agg = per_category.join(known, "categoryid", "left").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("t"),
        F.coalesce(F.sum(F.when(F.col("_known").isNull(), F.col("n"))), F.lit(0)).alias("f"),
    )
    return _rows(agg, [], [_finding("RI-002", F.col("t"), F.col("f"))])


def run_checks(
    events: DataFrame,
    items: DataFrame | None = None,
    categories: DataFrame | None = None,
    cfg: EventRules = EventRules(),
    run_id: str | None = None,
    rules=ALL_CHECKS,
    by=(),
) -> DataFrame:
    """One row per check (and batch), in rule order by ``ordinal``.

    Columns: ``by`` keys, run_id (when given), ordinal, rule_id, rule_desc, dimension,
    severity, status, total_records, failed_records, failure_pct, gap_days.
    """
    by, rules = list(by), list(rules)
    parts = []
    daily = [r for r in rules if r in _DAILY]
    extra = []
    if "RI-002" in rules:
        orphans = _orphan_categories(items, categories)
        if by:
            # the same for every batch: two scalars on each batch's row
            extra = [_finding("RI-002", orphans.select("total_records").scalar(), orphans.select("failed_records").scalar())]
        else:
            parts.append(orphans)
    if daily:
        parts.append(_daily_findings(events, cfg, by, daily, extra))
    elif extra:
        parts.append(_rows(events.select(*by).distinct(), by, extra))
    keyed = [r for r in _KEYED if r in rules]
    if len(keyed) > 1 and not by and _can_fuse(events, cfg):
        parts.append(_keyed_findings(events, items, cfg, keyed))
        keyed = []
    if "UNIQ-001" in keyed:
        parts.append(_duplicate_ids(events, cfg, by))
    if "UNIQ-002" in keyed:
        parts.append(_duplicate_rows(events, by))
    if "CONS-003" in keyed:
        parts.append(_first_events(events, cfg, by))
    if "RI-001" in keyed:
        parts.append(_orphan_items(events, items, by))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    found = graded(_described(found, cfg))
    if run_id is not None:
        found = found.withColumn("run_id", F.lit(run_id))
    return found


def graded(found: DataFrame) -> DataFrame:
    """Add failure percentage and PASS / FAIL / WARN."""
    c = F.col
    status = (
        F.when(c("failed_records") == 0, "PASS")
        .when(c("severity").isin("critical", "high"), "FAIL")
        .otherwise("WARN")
    )
    return found.withColumn("failure_pct", percent(c("failed_records"), c("total_records"), 4)).withColumn("status", status)


SAMPLE_BUCKETS = (4096, 64, 1)


def failing_samples(events: DataFrame, per_rule: int, cfg: EventRules, order: list[str], buckets: tuple = SAMPLE_BUCKETS) -> DataFrame:
    """First ``per_rule`` failing rows of every row-level check, by ``order``.

    A row is tagged with all rules it fails in one pass. The best rows are picked inside
    hashed buckets of a rule first, and then of their winners in ever fewer buckets, so no
    window holds all failing rows of a rule whatever ``per_rule`` is; small numbers are
    limited before the shuffle as well.
    """
    cond = row_conditions(cfg)
    tags = F.array_compact(F.array(*[F.when(cond[r], F.lit(r)) for r in cond]))
    best = events.select("*", F.explode(tags).alias("rule_id")).withColumn("_hash", F.xxhash64(*order))
    for count in buckets:
        w = Window.partitionBy("rule_id", F.pmod("_hash", F.lit(count))).orderBy(*order) if count > 1 else Window.partitionBy("rule_id").orderBy(*order)
        best = best.withColumn("sample_no", F.row_number().over(w)).filter(F.col("sample_no") <= per_rule)
    return best.drop("_hash")
