"""Word vectors beside a direct count; held-out accuracy; odd rows."""

import numpy as np

from plumbline.llm import quality as Q


def test_contexts_equal_a_direct_count(spark):
    texts = ["The cat sat!! on the mat", "", None, "cat Cat CAT 12,5 é", "x"] * 3
    index, want = Q.index_vectors(), np.zeros((Q.BUCKETS, Q.DIM), np.int64)
    for t in texts:
        ids = [b for w in (t or "").encode().split() for b in Q.buckets(w)]
        for i, a in enumerate(ids):
            for j in range(max(0, i - Q.WINDOW), min(len(ids), i + Q.WINDOW + 1)):
                if i != j:
                    want[a] += index[ids[j]]
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    got = np.zeros_like(want).reshape(-1, Q.BLOCK, Q.DIM)
    for r in Q.contexts(df).collect():
        got[r.block] += np.frombuffer(r.sums, np.int64).reshape(Q.BLOCK, Q.DIM)
    assert (got.reshape(want.shape) == want).all()


def test_held_out_quality_and_reruns(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    made = Q.classify(docs, labels)
    rows = made.join(labels, "doc_id").filter("held_out").collect()
    good, bad = ([r.score for r in rows if r.quality == q] for q in (1, 0))
    assert np.mean([(g > b) + (g == b) / 2 for g in good for b in bad]) > 0.9
    assert np.mean([r.predicted == 1 for r in rows if r.quality == 1]) > 0.95
    first = {r.doc_id: round(r.score, 9) for r in made.collect()}
    assert first == {r.doc_id: round(r.score, 9) for r in Q.classify(docs.repartition(5), labels.repartition(3)).collect()}


def test_odd_rows(spark, sf):
    docs = spark.createDataFrame([(1, None, 1.0), (2, "", 2.0), (None, "the cat", 3.0), (3, "a b " * 100_000, 4.0), (3, "x", 5.0)], "doc_id bigint, text string, score double")
    labels = spark.createDataFrame([(1, 1, 0), (3, 0, 1), (3, 1, 1), (9, None, None)], "doc_id bigint, quality int, toxic int")
    rows = Q.classify(docs, labels).collect()
    assert len(rows) == 5 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert [r.held_out for r in rows if r.doc_id is None] == [True]
    none = Q.classify(docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert Q.classify(docs.limit(0), labels).count() == 0
