"""Targets beside the resharing loop they come from; exact budgets; the mix itself."""

import re
from collections import defaultdict

import pytest

from plumbline.llm import mixing as M


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def targets(sizes):
    """Reshare what is above twice the size until nothing is."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    target, free, left = {}, set(names), 1.5 * sum(sizes.values())
    while free:
        level = left / sum(weight[s] for s in free)
        over = [s for s in free if level * weight[s] > 2 * sizes[s]]
        if not over:
            target |= {s: level * weight[s] for s in free}
            break
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
            free.discard(s)
    return target


@pytest.mark.parametrize("per_slice", [3, 50_000])
def test_targets_and_budgets(spark, sf, per_slice):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    odd = spark.createDataFrame([(-1, "a b  c", None), (-2, None, "src0"), (None, "d\te", "é"), (-3, "x " * 20_000, "z")], "doc_id bigint, text string, source string")
    docs = docs.select("doc_id", "text", "source").unionByName(odd)
    sizes, size_of = defaultdict(int), {}
    for r in docs.collect():
        size_of[r.doc_id] = words(r.text)
        sizes[r.source] += words(r.text)
    want, taken = targets(sizes), defaultdict(int)
    rows = M.mix(docs, rows_per_slice=per_slice).collect()
    for r in rows:
        assert r.size == size_of[r.doc_id] and r.source_size == sizes[r.source] and 0 <= r.taken <= 2 * r.size
        assert r.target == pytest.approx(want[r.source], rel=1e-9)
        taken[r.source] += r.taken
    assert all(taken[s] == int(t + 1e-9) for s, t in want.items())
    assert sorted(map(str, rows)) == sorted(map(str, M.mix(docs.repartition(7), rows_per_slice=per_slice).collect()))
    # the mix: as many words as planned, whole texts but for one document per source
    got = defaultdict(int)
    texts = {r.doc_id: r.text for r in docs.collect()}
    cut = defaultdict(int)
    for r in M.sample_text(docs, rows_per_slice=per_slice).collect():
        got[r.doc_id] += words(r.text)
        if r.text != texts[r.doc_id]:
            cut[r.source] += 1
            assert texts[r.doc_id].startswith(r.text)
    assert got == {r.doc_id: r.taken for r in rows if r.taken or not r.size}
    assert all(n <= 1 for n in cut.values())


def test_empty_and_wordless_tables(spark):
    docs = spark.createDataFrame([(1, " ", "a"), (2, None, None)], "doc_id bigint, text string, source string")
    assert {(r.doc_id, r.size, r.target, r.taken) for r in M.mix(docs).collect()} == {(1, 0, 0.0, 0), (2, 0, 0.0, 0)}
    assert M.mix(docs.limit(0)).count() == 0
    twice = spark.createDataFrame([(1, "a b c", "s"), (1, "a b c", "s")], "doc_id bigint, text string, source string")
    assert sum(r.taken for r in M.mix(twice).collect()) == 9
    assert sum(words(r.text) for r in M.sample_text(twice).collect()) == 9 + 1  # rows alike share words evenly, rounded up
