"""Shape of the physical plans: what must not appear, and what must be pruned."""

import pathlib
import re

import plumbline
from registry import QUERIES


def plan(spark, sf, name):
    return QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()


def test_library_code_stays_on_dataframes():
    root = pathlib.Path(plumbline.__file__).parent
    for f in root.rglob("*.py"):
        if f.parent.name == "llm":
            continue  # training-data operators may use Arrow batches in their tasks
        text = f.read_text()
        for banned in ("localCheckpoint", ".rdd", "crossJoin", ".collect()", "toPandas", "broadcast(", "udf("):
            assert banned not in text, f"{banned} in {f.name}"


def test_row_checks_share_one_scan(spark, sf):
    p = plan(spark, sf, "c17_result_row")
    assert p.count("FileScan parquet") == 1
    assert "hashpartitioning(_groupingexpression" in p  # grouped by day before the global sum


def test_control_tests_scan_the_fact_once_and_reduce_before_the_join(spark, sf):
    p = plan(spark, sf, "g05_control_tests")
    assert p.count("events.parquet") == 1
    fact = p[: p.index("events.parquet")]
    assert fact.rindex("partial_count") > fact.index("Join")  # the partial count is below the join
    assert re.search(r"ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,value:double,props:string>", p)


def test_projection_and_filter_reach_the_scan(spark, sf):
    p = plan(spark, sf, "rule_cons004_product_code_cross_dataset_consistency")
    assert "ReadSchema: struct<l_partkey:bigint>" in p
    p = plan(spark, sf, "rule_cons001_customer_account_referential_integrity")
    assert "ReadSchema: struct<o_custkey:bigint>" in p and "ReadSchema: struct<c_custkey:bigint>" in p


def test_samples_are_limited_before_the_shuffle(spark, sf):
    p = plan(spark, sf, "c19_failing_samples")
    assert "WindowGroupLimit" in p and p.rindex("WindowGroupLimit") > p.index("Exchange hashpartitioning(rule_id")


def test_latest_run_is_a_top_one(spark, sf):
    assert "TakeOrderedAndProject(limit=1" in plan(spark, sf, "q03_latest_run")


def test_large_parents_are_joined_by_shuffle(spark, sf):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(spark, sf, "rule_cons002_transaction_account_consistency")
        assert "BroadcastHashJoin" not in p and "SortMergeJoin" in p
        assert "BroadcastHashJoin" not in plan(spark, sf, "g05_control_tests")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def scans_of_events(spark, sf, name):
    """Scans of the events in the static plan, what is reused counted once."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return sum("FileScan" in line and "events.parquet" in line for line in plan(spark, sf, name).split("\n"))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_all_checks_take_three_scans(spark, sf):
    # row-level checks; tagged keys of the four keyed checks; rows whose fingerprint comes again
    assert scans_of_events(spark, sf, "c18_all_checks") <= 3
    assert scans_of_events(spark, sf, "a08_full_run") <= 3


def test_picks_by_count_do_not_multiply_scans(spark, sf):
    for name in ("s04_exact_sample", "k08_duplicate_rows", "k09_duplicate_txns", "k11_out_of_range_times"):
        assert scans_of_events(spark, sf, name) <= 4, name


def test_tiers_scan_the_clean_set_twice_to_pick(spark, sf, monkeypatch):
    from plumbline.operators import cleanse
    from registry import event_queries as ev

    looked = []
    found = cleanse.nth_smallest
    monkeypatch.setattr(cleanse, "nth_smallest", lambda df, families, key: looked.append(sum(len(f.sizes) for f in families)) or found(df, families, key))
    ev.tiers(spark, sf)
    assert looked == [7]  # all sizes of all tiers in one look-up: a histogram and a ranking


def test_duplicate_rows_travel_as_fingerprints(spark, sf):
    p = plan(spark, sf, "c06_dup_rows")
    keys = re.findall(r"partial_count[^\n]*", p)
    assert any("_fp_a" in k and "transactionid" not in k for k in keys)
    assert "Exchange hashpartitioning(_fp_a" in p
