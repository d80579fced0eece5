"""Fingerprints and components beside a plain computation."""

import re

import numpy as np
import xxhash

from plumbline.llm import simhash


def plain(rows):
    """doc_id -> (fingerprint, component) by comparing all pairs."""
    fps = []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        grams = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
        hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
        fps.append(sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes)))
    label = list(range(len(rows)))
    changed = True
    array = np.array(fps, np.uint64)
    near = [np.flatnonzero(np.bitwise_count(array ^ f) <= 4) for f in array]
    while changed:
        changed = False
        for i, js in enumerate(near):
            low = min(label[j] for j in js)
            if low < label[i]:
                label[i], changed = low, True
    least = {}
    for (doc, _), c in zip(rows, label):
        least[c] = min(doc, least.get(c, doc))
    return sorted((doc, f"{f:016x}", least[c]) for (doc, _), f, c in zip(rows, fps, label))


def found(df):
    return sorted((r.doc_id, f"{r.fp & (2**64 - 1):016x}", r.component_id) for r in df.collect())


def test_documents_equal_the_plain_computation(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = plain(rows)
    assert found(simhash.near_duplicates(docs)) == want
    # crowded places are split, and more blocks give the same links
    assert found(simhash.near_duplicates(docs, split_above=3)) == want
    assert found(simhash.near_duplicates(docs, per_place=0.001)) == want


def test_links_miss_nothing_between_random_neighbours(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 60, dtype=np.uint64)
    fps = set(map(int, base))
    for b in base:
        for k in range(40):
            flips = rng.choice(64, rng.integers(1, 7), replace=False)
            fps.add(int(b ^ np.bitwise_or.reduce(np.uint64(1) << flips.astype(np.uint64))))
    fps = np.array(sorted(fps), np.uint64)
    df = spark.createDataFrame([(int(v),) for v in fps.view(np.int64)], "fp bigint")
    roots = {r.node: r.root for r in simhash.components(simhash.links(df, len(fps))).collect()}
    signed = fps.view(np.int64)
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= 4):
            if i != j:
                assert roots.get(int(signed[i]), int(signed[i])) == roots.get(int(signed[j]), int(signed[j]))


def test_edges_of_the_input(spark):
    rows = [(1, None), (2, ""), (3, " \t"), (4, "one two"), (None, "ONE  two"), (4, "one two"), (5, "a b c d e"), (6, "a b c d e")]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id bigint, text string, fp string, root bigint")
    got = {(r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert got == {(1, 1), (2, 1), (3, 1), (4, 4), (None, 4), (5, 5), (6, 5)}
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 4, 5]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_long_text(spark):
    long = " ".join(f"w{i}" for i in range(200_000))
    assert simhash.fingerprint(simhash.shingle_hashes(long.encode())) != 0
    assert simhash.fingerprint(np.empty(0, np.uint64)) == 0
