"""Groups beside a plain computation, with frequent and rare texts."""

import hashlib
import random
import re
from collections import Counter

from plumbline.llm import exact_dedup as X


def normal(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def rows_with_copies():
    rng = random.Random(2)
    texts = ["hot"] * 300 + ["HOT"] * 100 + [f"t{rng.randint(0, 150)}" for _ in range(500)] + [None, "", "É", "é", "x" * 200_000, "X" * 200_000]
    rng.shuffle(texts)
    return [(i, t) for i, t in enumerate(texts)]


def test_assignment_equals_the_definition(spark):
    rows = rows_with_copies()
    docs = spark.createDataFrame([(*r, "a", 1) for r in rows], "doc_id bigint, text string, digest_ string, row_ int").repartition(5)
    size, last = Counter(normal(t) for _, t in rows), {}
    for i, t in rows:
        last[normal(t)] = max(i, last.get(normal(t), i))
    want = {(i, last[normal(t)], size[normal(t)], i == last[normal(t)], hashlib.sha256(normal(t).encode()).digest()) for i, t in rows}
    for counters in (1, 4, 1024):
        got = {(r.doc_id, r.keep_id, r.group_size, r.kept, bytes(r.digest_)) for r in X.assign(docs.select("doc_id", "text"), counters).collect()}
        assert got == want
    kept = X.deduplicate(docs.drop("digest_"), 4)
    assert kept.columns == ["doc_id", "text", "row_"]
    assert sorted(r.doc_id for r in kept.collect()) == sorted(last.values())


def test_frequent_digests_are_never_missed_and_few(spark):
    rng = random.Random(5)
    values = [b"a"] * 400 + [b"b"] * 150 + [bytes([rng.randint(0, 255), rng.randint(0, 255)]) for _ in range(450)]
    rng.shuffle(values)
    df = spark.createDataFrame([(v,) for v in values], "digest_ binary").repartition(7)
    got = {bytes(r.digest_) for r in X.frequent(df, len(values), 19).collect()}
    assert {b"a", b"b"} <= got and len(got) <= 20


def test_rows_that_repeat_and_null_ids(spark):
    docs = spark.createDataFrame([(1, "x"), (1, "x"), (None, "X"), (None, "y"), (None, "y"), (2, "z"), (2, "w")], "doc_id bigint, text string")
    rows = X.assign(docs).collect()
    assert len(rows) == 7 and Counter(r.kept for r in rows) == {True: 4, False: 3}
    assert sorted((r.text for r in X.deduplicate(docs).collect())) == ["w", "x", "y", "z"]
    assert X.assign(docs.limit(0)).count() == 0 and X.deduplicate(docs.limit(0)).count() == 0
