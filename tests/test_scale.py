"""Results do not depend on partitioning, and a key with a third of the rows changes nothing."""

import collections
import random

import pytest
from pyspark.sql import functions as F

from plumbline.operators import cleanse, duplicates, rules
from plumbline.operators.checks import run_checks
from plumbline.sources import catalog, sampling, store
from registry import event_data
from registry.core import table
from registry.event_queries import _checks
from registry.governance_data import Governance


def canon(df):
    cols = sorted(df.columns)
    return collections.Counter(tuple(str(r[c]) for c in cols) for r in df.select(*cols).collect())


@pytest.mark.parametrize("n", [1, 37])
def test_checks_do_not_depend_on_partitioning(spark, sf, n):
    base = event_data.dirty_events(spark, sf)
    assert canon(_checks(spark, sf, events=base.repartition(n))) == canon(_checks(spark, sf))


@pytest.mark.parametrize("n", [1, 37])
def test_governance_does_not_depend_on_partitioning(spark, sf, n):
    class Shuffled(Governance):
        def table(self, name):
            return super().table(name).repartition(n)

    a, b = Governance(spark, sf), Shuffled(spark, sf)
    for name in ("tests", "watchlist", "exceptions", "trust"):
        assert canon(getattr(a, name)) == canon(getattr(b, name)), name


@pytest.mark.parametrize("n", [0, 1, 17, 400, 5000])
def test_exact_sample_size_and_content(spark, sf, n):
    e = table(spark, sf, "events").select("event_id", "user_id")
    h = sampling.key_hash(F.col("event_id"))
    want = [r.event_id for r in e.orderBy(h, "event_id").limit(n).collect()] if n else []
    for parts in (1, 9):
        got = sampling.exact_sample(e.repartition(parts), n, h, ["event_id"])
        assert sorted(r.event_id for r in got.collect()) == sorted(want)


def test_exact_sample_with_repeated_rows_and_hash_collisions(spark):
    df = spark.range(300).select((F.col("id") % 5).alias("k"))
    assert sampling.exact_sample(df, 123, sampling.key_hash(F.col("k")), ["k"]).count() == 123


# ---- hot keys: one key holds a third of the rows
@pytest.fixture(scope="module")
def hot_rows():
    rnd = random.Random(7)
    rows = []
    for i in range(6000):
        hot = i % 3 == 0
        visitor = 1 if hot else rnd.randrange(2, 400)
        event = rnd.choice(["view", "addtocart", "transaction", "click", None])
        tid = ("T-hot" if hot else f"T{rnd.randrange(500)}") if event == "transaction" and rnd.random() < 0.9 else None
        rows.append((i, 1430438400000 + rnd.randrange(0, 40) * 3_600_000, visitor, event, 10 if hot else rnd.randrange(1, 60), tid))
    return rows + rows[:600:3]


EVENT_DDL = "event_id bigint, timestamp bigint, visitorid bigint, event string, itemid bigint, transactionid string"


def test_keyed_checks_with_a_hot_key_equal_brute_force(spark, hot_rows):
    from plumbline.operators.checks import EventRules

    df = spark.createDataFrame(hot_rows, EVENT_DDL).repartition(8)
    items = spark.createDataFrame([(i, 1.0) for i in range(1, 50)], "itemid bigint, categoryid double")
    got = {r.rule_id: (r.total_records, r.failed_records) for r in run_checks(df, items, cfg=EventRules(tie="event_id"), rules=["UNIQ-001", "UNIQ-002", "CONS-003", "RI-001"]).collect()}
    ids = collections.Counter(r[5] for r in hot_rows if r[3] == "transaction" and r[5])
    copies = collections.Counter(hot_rows)
    first = {}
    for r in sorted(hot_rows, key=lambda r: (r[1], r[0])):
        if r[3] is not None:
            first.setdefault(r[2], r[3])
    assert got == {
        "UNIQ-001": (sum(ids.values()), sum(n for n in ids.values() if n > 1)),
        "UNIQ-002": (len(hot_rows), len(hot_rows) - len(copies)),
        "CONS-003": (len({r[2] for r in hot_rows}), sum(e == "transaction" for e in first.values())),
        "RI-001": (len(hot_rows), sum(r[4] >= 50 for r in hot_rows)),
    }


def test_clean_with_a_hot_transaction_id(spark, hot_rows):
    from plumbline.operators.checks import EventRules

    cfg = EventRules(tie="event_id")
    df = spark.createDataFrame(hot_rows, EVENT_DDL).repartition(8)
    kept, seen = [], set()
    for r in sorted(set(hot_rows), key=lambda r: (r[1], r[0])):
        if r[3] in ("view", "addtocart"):
            kept.append(r)
        elif r[3] == "transaction" and r[5] and r[5] not in seen:
            seen.add(r[5])
            kept.append(r)
    got = cleanse.clean(df, cfg)
    assert sorted(tuple(r) for r in got.collect()) == sorted(kept)
    removed = sum(r.rows_removed for r in cleanse.clean_audit(df, cfg).collect())
    assert removed == len(hot_rows) - len(kept)


def test_a_transaction_without_time_is_not_kept_over_a_timed_one(spark):
    from plumbline.operators.checks import EventRules

    rows = [(1, None, 1, "transaction", 1, "T"), (2, 1430438400000, 1, "transaction", 1, "T"), (3, None, 1, "transaction", 1, "U")]
    df = spark.createDataFrame(rows, EVENT_DDL)
    cfg = EventRules(tie="event_id")
    assert [r.event_id for r in cleanse.clean(df, cfg).collect()] == [2]
    assert {r.step: r.rows_removed for r in cleanse.clean_audit(df, cfg).collect() if r.rows_removed} == {"duplicate_txn_id": 1, "out_of_window": 1}


@pytest.mark.parametrize("limit", [60, 900, 3600, 86400])
def test_steady_arrival_equals_row_by_row(spark, limit):
    rnd = random.Random(limit)
    rows = [("hot" if i % 3 == 0 else f"k{i % 7}", rnd.randrange(0, 200_000)) for i in range(2000)]
    df = spark.createDataFrame(rows, "k string, s bigint").select("k", F.timestamp_seconds("s").cast("timestamp_ntz").alias("t"))
    by_key = collections.defaultdict(list)
    for k, s in rows:
        by_key[k].append(s)
    total = fail = 0
    for times in by_key.values():
        times.sort()
        total += len(times) - 1
        fail += sum(b - a > limit for a, b in zip(times, times[1:]))
    for block in (1, 3, rules.BLOCK_SLICES):  # times are handed over at every edge, some, none
        r = rules.steady_arrival("TIME-002", df, [F.col("k")], "t", limit, block).first()
        assert (r.total_records, r.fail_count) == (total, fail)


def test_arrivals_of_one_key_use_all_tasks(spark):
    df = spark.range(0, 600_000, 1, 6).select(F.lit("hot").alias("k"), F.timestamp_seconds(F.col("id") * 61).cast("timestamp_ntz").alias("t"))
    df = df.unionByName(spark.createDataFrame([("hot", None), ("cold", None)], "k string, t timestamp_ntz"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        blocks = rules.arrival_blocks(df, [F.col("k")], "t", 60).withColumn("task", F.spark_partition_id())
        loads = [r["count"] for r in blocks.groupBy("task").count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(loads) == 4 and max(loads) < 2 * min(loads)  # the session has four shuffle partitions
    r = rules.steady_arrival("TIME-002", df, [F.col("k")], "t", 60).first()
    assert (r.total_records, r.fail_count) == (599_999, 599_999)


def test_latest_value_of_an_item_with_a_long_history(spark):
    rows = [(i % 97, 1 if i % 3 == 0 else i % 40, "categoryid" if i % 2 else "available", f"{i}.0") for i in range(3000)]
    df = spark.createDataFrame(rows, "timestamp bigint, itemid bigint, property string, value string").repartition(6)
    want = {}
    for t, item, prop, v in rows:
        if prop == "categoryid":
            want[item] = max(want.get(item, (-1, "")), (t, v))
    got = {r.itemid: r.categoryid for r in catalog.item_catalog(df).collect()}
    assert got == {k: float(v[1]) for k, v in want.items()}


def test_relationship_kinds(spark):
    def frame(*keys):
        return spark.createDataFrame([(k,) for k in keys], "k bigint")

    kinds = {name: store.relationship(a, "k", b, "k", name).first() for name, a, b in (
        ("1-1", frame(1, 2), frame(1, 2, 3)), ("n-1", frame(1, 1, 9), frame(1, 2)), ("1-n", frame(1), frame(1, 1)), ("n-n", frame(1, 1), frame(1, 1)))}
    assert [kinds[k].cardinality for k in ("1-1", "n-1", "1-n", "n-n")] == ["one-to-one", "many-to-one", "one-to-many", "many-to-many"]
    assert kinds["n-1"].orphan_rows == 1


# ---- fingerprints, picks, samples
@pytest.mark.parametrize("marks", [
    duplicates.fingerprint,
    lambda columns: (F.lit(1).cast("bigint"), F.lit(1).cast("bigint")),  # every row collides
    lambda columns: (F.pmod(F.xxhash64(*columns), F.lit(5)), F.lit(0).cast("bigint")),
])
def test_duplicate_counts_are_exact_whatever_collides(spark, hot_rows, marks):
    df = spark.createDataFrame(hot_rows + hot_rows[:40], EVENT_DDL).repartition(8)
    copies = collections.Counter(hot_rows + hot_rows[:40])
    got = duplicates.duplicate_counts(df, [], marks).first()
    assert (got._rows, got._extra) == (sum(copies.values()), sum(n - 1 for n in copies.values()))
    by = {r.event: (r._rows, r._extra) for r in duplicates.duplicate_counts(df, ["event"], marks).collect()}
    for event in {r[3] for r in copies}:
        own = [n for r, n in copies.items() if r[3] == event]
        assert by[event] == (sum(own), sum(n - 1 for n in own))


def test_rows_that_differ_by_where_a_null_stands_are_no_copies(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None), ("a", None), (None, None)], "x string, y string")
    assert tuple(duplicates.duplicate_counts(df, []).first()) == (4, 1)
    assert duplicates.with_fingerprint(df).select("_fp_a", "_fp_b").distinct().count() == 3
    assert tuple(duplicates.duplicate_counts(df.limit(0), []).first()) == (0, 0)


@pytest.mark.parametrize("tie", [None, "event_id"])
def test_fused_checks_equal_single_checks(spark, hot_rows, tie):
    from plumbline.operators.checks import EventRules

    rows = hot_rows + [(9_001 + i, None if i % 2 else 1430438400000, None if i == 2 else 700 + i, ["transaction", "view", None][i % 3], None, None) for i in range(9)]
    rows += [(-5, 1430438400000, 800, "transaction", 1, "N"), (-6, 1430438400000, 800, "view", 1, None), (9_100, (1 << 62), 801, "transaction", 1, "F")]
    df = spark.createDataFrame(rows, EVENT_DDL).repartition(8)
    items = spark.createDataFrame([(i, 1.0) for i in [*range(1, 50), 3, None]], "itemid bigint, categoryid double")
    keyed = ["UNIQ-001", "UNIQ-002", "CONS-003", "RI-001"]
    cfg = EventRules(tie=tie)
    for frame in (df, df.limit(0)):
        one = {r: run_checks(frame, items, cfg=cfg, rules=[r]).first() for r in keyed}
        for rules_ in (keyed, keyed[:2], keyed[2:]):
            for r in run_checks(frame, items, cfg=cfg, rules=rules_).collect():
                assert (r.total_records, r.failed_records) == (one[r.rule_id].total_records, one[r.rule_id].failed_records), r.rule_id


def test_marks_of_many_sizes(spark):
    df = spark.range(5_000).withColumn("odd", F.col("id") % 2 == 1).repartition(7)
    families = [sampling.Family(sampling.key_hash(F.col("id"), seed), [1, 17, 400, 9_999], where) for seed, where in ((1, None), (2, F.col("odd")), (3, F.lit(False)))]
    got = sampling.nth_smallest(df, families, "id")
    for seed, marks, where in ((1, got[0], lambda i: True), (2, got[1], lambda i: i % 2 == 1)):
        order = sorted((r.h, r.id) for r in df.select("id", sampling.key_hash(F.col("id"), seed).alias("h")).collect() if where(r.id))
        assert marks == {n: order[n - 1] if n <= len(order) else None for n in (1, 17, 400, 9_999)}
    assert got[2] == {1: None, 17: None, 400: None, 9_999: None}


def test_large_samples_are_picked_in_levels(spark, hot_rows):
    from plumbline.operators import checks
    from plumbline.operators.checks import EventRules

    df = spark.createDataFrame(hot_rows, EVENT_DDL).repartition(8)
    cfg = EventRules()
    bad = sorted({r[0] for r in hot_rows if r[3] == "transaction" and r[5] is None})
    for per_rule in (3, 5_000):
        got = checks.failing_samples(df.dropDuplicates(["event_id"]), per_rule, cfg, ["event_id"]).filter("rule_id = 'COMP-004'").orderBy("sample_no").collect()
        assert [(r.sample_no, r.event_id) for r in got] == list(enumerate(bad, 1))[:per_rule]
    # the first level hands on at most per_rule rows of each bucket
    first = checks.failing_samples(df, 5, cfg, ["event_id"], buckets=(16,)).groupBy("rule_id", F.pmod(F.xxhash64("event_id"), F.lit(16)).alias("b")).count()
    assert max(r["count"] for r in first.collect()) <= 5
