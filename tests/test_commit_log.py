"""Writers at the same time, writers that stop, versions, compaction."""

import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F

from plumbline.sources import commit_log, store
from plumbline.sources.commit_log import CommitLog, Snapshot


def runs(spark, *ids, total=1):
    rows = [(i, dt.datetime(2024, 1, 1), "events", total, "COMPLETED") for i in ids]
    return spark.createDataFrame(rows, "run_id string, run_timestamp timestamp, dataset_name string, total_records bigint, status string")


def together(*work):
    """Run all at once; every writer has read its snapshot before any of them publishes."""
    failed = []

    def guarded(f):
        try:
            f()
        except Exception as e:  # noqa: BLE001
            failed.append(e)

    threads = [threading.Thread(target=guarded, args=(f,)) for f in work]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not failed, failed


@pytest.fixture
def at_once(monkeypatch):
    """All writers stand before their first number at the same time."""
    gate, plain = threading.Barrier(3, timeout=60), CommitLog.publish
    first = threading.local()

    def publish(self, *args):
        if not hasattr(first, "done"):
            first.done = True
            gate.wait()
        return plain(self, *args)

    monkeypatch.setattr(CommitLog, "publish", publish)


def test_writers_at_the_same_time_store_a_run_once(spark, tmp_path, at_once):
    st = store.ResultStore(spark, str(tmp_path / "wh"))
    together(*[lambda n=n: st.append_run_log(runs(spark, "same", f"own-{n}", total=n)) for n in range(3)])
    rows = st.read("dq_run_log").collect()
    assert sorted(r.run_id for r in rows) == ["own-0", "own-1", "own-2", "same"]
    # whoever came first stored it
    assert st.log("dq_run_log").versions() == [0, 1, 2]


def test_writers_of_one_run_only(spark, tmp_path, at_once):
    st = store.ResultStore(spark, str(tmp_path / "wh"))
    together(*[lambda n=n: st.append_run_log(runs(spark, "same", total=n)) for n in range(3)])
    assert st.read("dq_run_log").count() == 1 and st.log("dq_run_log").versions() == [0]


def test_a_writer_that_stops_leaves_nothing_visible(spark, tmp_path, monkeypatch):
    st = store.ResultStore(spark, str(tmp_path / "wh"))
    st.append_run_log(runs(spark, "a"))

    def stop(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(CommitLog, "publish", stop)
        with pytest.raises(RuntimeError):
            st.append_run_log(runs(spark, "b"))
    assert [r.run_id for r in st.read("dq_run_log").collect()] == ["a"]
    assert len(list((tmp_path / "wh" / "dq_run_log" / "data").iterdir())) == 2
    st.append_run_log(runs(spark, "b"))  # the retry stores it
    log = st.log("dq_run_log")
    assert log.vacuum(3600) == [] and len(log.vacuum(0)) == 1
    assert sorted(r.run_id for r in st.read("dq_run_log").collect()) == ["a", "b"]


def test_versions_snapshots_and_compaction(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(commit_log, "SNAPSHOT", 3)
    st = store.ResultStore(spark, str(tmp_path / "wh"))
    for i in range(5):
        st.append_run_log(runs(spark, f"r{i}"))
    st.append_run_log(runs(spark, "r1", total=9))  # adds nothing, so no version
    log = st.log("dq_run_log")
    assert log.versions() == [0, 1, 2, 3, 4] and len(log.snapshot().folders) == 5
    assert [st.read("dq_run_log", v).count() for v in (0, 2, 4)] == [1, 3, 5]
    assert st.compact("dq_run_log")
    assert len(log.snapshot().folders) == 1 and st.read("dq_run_log").count() == 5
    assert st.read("dq_run_log", 3).count() == 4  # older versions stay readable
    assert st.read("dq_run_log").filter(F.col("total_records") == 1).count() == 5
    st.append_run_log(runs(spark, "r5"))
    assert st.read("dq_run_log").count() == 6


def test_compaction_gives_way_to_a_writer(spark, tmp_path, monkeypatch):
    st = store.ResultStore(spark, str(tmp_path / "wh"))
    for i in range(2):
        st.append_run_log(runs(spark, f"r{i}"))
    plain = store.ResultStore._stage

    def staged(self, log, table, rows):
        out = plain(self, log, table, rows)
        monkeypatch.setattr(store.ResultStore, "_stage", plain)
        st.append_run_log(runs(spark, "late"))
        return out

    monkeypatch.setattr(store.ResultStore, "_stage", staged)
    assert not st.compact("dq_run_log")
    assert sorted(r.run_id for r in st.read("dq_run_log").collect()) == ["late", "r0", "r1"]


def test_a_number_is_given_once_by_link_and_by_rename(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "t"))
    assert log.publish(Snapshot(-1, ()), ["data/a"]) and not log.publish(Snapshot(-1, ()), ["data/b"])
    assert log.snapshot() == Snapshot(0, ("data/a",))
    assert log._rename("_log/.one", "_log/x", "1") and not log._rename("_log/.two", "_log/x", "2")
    assert not [n for n in log._names("_log") if n.startswith(".one") or n.startswith(".two") or n.startswith(".draft")]
