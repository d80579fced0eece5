"""Readers, result store, full refresh, working folder."""

import datetime as dt

import duckdb
import pytest
from oracle_check import compare
from pyspark.sql import functions as F

from plumbline import schemas
from plumbline.operators import runs
from plumbline.plans import event_quality, governance
from plumbline.session import settle, shared_folder
from plumbline.sources import readers, sampling, store
from registry import ORACLES, QUERIES, event_data
from registry.governance_data import Governance


def write(path, text):
    path.write_text(text)
    return str(path)


def test_csv_types_and_blanks(spark, tmp_path):
    f = write(tmp_path / "e.csv", " timestamp,visitorid ,event,itemid,transactionid\n1430438401000.0,12.0,view,,\n,x,transaction,9223372036854775807,T1\n")
    rows = readers.load_events(spark, full=f).collect()
    assert [tuple(r) for r in rows] == [(1430438401000, 12, "view", None, None), (None, None, "transaction", 9223372036854775807, "T1")]


def test_a_folder_of_files_with_columns_in_different_orders(spark, tmp_path):
    folder = tmp_path / "parts one"
    folder.mkdir()
    write(folder / "a.csv", "categoryid,parentid\n2,20\n")
    write(folder / "b.csv", " parentid ,categoryid\n30,3\n")
    write(folder / "c.csv", "")
    import gzip

    (folder / "d.csv.gz").write_bytes(gzip.compress(b"\xef\xbb\xbf\"parentid\",note,categoryid\n40,x,4\n"))
    rows = readers.load_category_tree(spark, str(folder)).collect()
    assert sorted(tuple(r) for r in rows) == [(2, 20), (3, 30), (4, 40)]
    write(folder / "e.csv", "categoryid,other\n1,1\n")
    with pytest.raises(ValueError, match="parentid"):
        readers.load_category_tree(spark, str(folder))


def test_time_sums_of_property_parts_beyond_64_bits(spark, tmp_path):
    i = F.col("id")
    times = F.when(i % 3 == 0, "1995-03-01 00:00:00.001").when(i % 3 == 1, "9999-12-30 23:59:59").otherwise("9999-12-31 23:59:59.999")
    spark.range(120_000).select(
        (i % 70).alias("l_partkey"), (i % 5).alias("l_suppkey"), (i % 20).cast("double").alias("l_quantity"),
        F.when(i % 2 == 0, "R").otherwise("N").alias("l_returnflag"), times.cast("timestamp_ntz").alias("l_shipdate"),
    ).write.parquet(str(tmp_path / "lineitem.parquet"))
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW lineitem AS SELECT * FROM read_parquet('{tmp_path}/lineitem.parquet/*.parquet')")
        df = QUERIES["s02_csv_property_parts"](spark, str(tmp_path))
        assert compare(df, con, ORACLES["s02_csv_property_parts"]) is None
    sums = [int(r.time_sum) for r in df.collect()]
    assert len(sums) == 2 and min(sums) >= 2**63


def test_event_path_choice(spark, tmp_path):
    head = "timestamp,visitorid,event,itemid,transactionid\n"
    full, sample, own = (write(tmp_path / n, head + f"1,{i},view,1,\n") for i, n in enumerate(("full.csv", "sample.csv", "own.csv")))
    pick = lambda **kw: readers.load_events(spark, full=full, sample=sample, **kw).first().visitorid
    assert (pick(), pick(use_sample=False), pick(path=own)) == (1, 0, 2)


def test_store_is_idempotent_per_run(spark, sf, tmp_path):
    st = store.ResultStore(spark, str(tmp_path / "wh"))
    assert runs.latest_run(st.read("dq_summary"), st.read("dq_run_log")).count() == 0
    e = event_data.dirty_events(spark, sf)
    args = (e, event_data.item_catalog(spark, sf), event_data.category_tree(spark, sf))
    for day in (1, 2):
        results, summary = event_quality.run(*args, f"set-{day}", st, event_data.dirty_rules(), dt.datetime(2024, 1, day))
        st.append_results(results)  # a repeated write adds nothing
        st.append_summary(summary)
    assert (st.read("dq_run_log").count(), st.read("dq_results").count(), st.read("dq_summary").count()) == (2, 32, 2)
    newest = runs.latest_run(st.read("dq_summary"), st.read("dq_run_log")).first()
    assert newest.dataset_name == "set-2" and newest.total_records == e.count()
    assert [r.dataset_name for r in runs.run_log_newest_first(st.read("dq_run_log")).collect()] == ["set-2", "set-1"]
    assert [r.dataset_name for r in runs.all_summaries(st.read("dq_summary"), st.read("dq_run_log")).collect()] == ["set-1", "set-2"]
    one = runs.results_of_run(st.read("dq_results"), newest.run_id)
    assert one.count() == 16
    scan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_id" in scan  # only the run's folder is read


def test_missing_dimension_scores_are_stored_as_100(spark, tmp_path):
    st = store.ResultStore(spark, str(tmp_path / "wh"))
    row = spark.createDataFrame([("R1", "d", dt.datetime(2024, 1, 1), 90.0, "Good", 1, 0, 0, 0, 0, 0, 0, 75.0)],
                                "run_id string, dataset_name string, run_timestamp timestamp, quality_score double, status string, pass_count int, fail_count int, warn_count int, critical_failures int, high_failures int, medium_failures int, low_failures int, score_completeness double")
    st.append_summary(row)
    r = st.read("dq_summary").first()
    assert (r.score_completeness, r.score_uniqueness, r.score_freshness) == (75.0, 100.0, 100.0)


def test_full_refresh_replaces_and_partitions(spark, sf, tmp_path):
    for _ in range(2):
        tables = governance.refresh(Governance(spark, sf), str(tmp_path / "gov"))
    fresh = Governance(spark, sf)
    assert tables["control_test_results"].count() == fresh.tests.count()
    assert tables["domain_trust_scores"].orderBy("domain").collect() == fresh.trust.orderBy("domain").collect()
    assert (tmp_path / "gov" / "control_test_results" / "test_date=2024-01-30").exists()


def test_empty_tables_keep_their_schema(spark, tmp_path):
    df = spark.createDataFrame([], schemas.TESTS)
    store.refresh_tables({"t": df}, str(tmp_path))
    assert spark.read.parquet(str(tmp_path / "t")).dtypes == df.dtypes


def test_type_check(spark):
    df = spark.createDataFrame([("a", "2024-01-01")], "test_id string, test_date string")
    want = schemas.struct("test_id STRING, test_date DATE")
    bad = store.type_mismatches(spark, {"t": df}, {"t": want}).collect()
    assert [(r.column_name, r.expected, r.actual) for r in bad] == [("test_date", "date", "string")]


def test_saved_sample_is_reused_unless_forced(spark, tmp_path):
    df, path = spark.range(1000), str(tmp_path / "s")
    h = sampling.key_hash(F.col("id"))
    assert sampling.saved_sample(df, path, 50, h, ["id"]).count() == 50
    assert sampling.saved_sample(df, path, 80, h, ["id"]).count() == 50
    assert sampling.saved_sample(df, path, 80, h, ["id"], force=True).count() == 80


class FakeSession:
    """Settings only: spark.checkpoint.dir cannot change in a running session."""

    def __init__(self, master, folder):
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: folder if key == "spark.checkpoint.dir" else default)})
        self.sparkContext = type("Context", (), {"master": master})


def test_working_folder_follows_the_session_setting():
    one, two = (shared_folder(FakeSession("yarn", "hdfs://shared/ck/"), "x") for _ in range(2))
    assert one.startswith("hdfs://shared/ck/x-") and one != two


def test_settled_table_is_read_back(spark):
    df = settle(spark.range(5), "five")
    assert df.count() == 5 and df.inputFiles()[0].endswith(".parquet")


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077"])
def test_a_cluster_needs_a_shared_folder(master):
    with pytest.raises(ValueError):
        shared_folder(FakeSession(master, None), "x")
