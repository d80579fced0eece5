"""The manifest beside a plain tree, with small blocks, hot sources, nulls and rows that repeat."""

import hashlib
import random
import zlib
from collections import Counter

from plumbline.llm import merkle

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string, tree bigint, leaves int"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def plain_tree(digests, run):
    """The root, and for every leaf the runs of its path as (before, after)."""
    paths, level, owners = [[] for _ in digests], list(digests), [[i] for i in range(len(digests))]
    while len(level) > 1:
        up, groups = [], []
        for k in range(0, len(level), run):
            part = level[k:k + run]
            for j in range(len(part)):
                for leaf in owners[k + j]:
                    paths[leaf].append(("".join(part[:j]), "".join(part[j + 1:])))
            up.append(h(*part))
            groups.append([leaf for o in owners[k:k + run] for leaf in o])
        level, owners = up, groups
    return level[0], paths


def plain(rows, run=3):
    def leaf(r, text):
        return h(*(field(v) for v in (r[0], r[1], r[2], r[3], text)))

    by_source = {}
    for r in rows:
        by_source.setdefault(r[1], []).append(r)
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees, subroots = {}, []
    for s in names:
        own = sorted(by_source[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[4])))
        subroot, paths = plain_tree([leaf(r, r[4]) for r in own], run)
        trees[s] = own, paths
        subroots.append(subroot)
    root, tops = plain_tree(subroots, run)
    out = []
    for s, subroot, top in zip(names, subroots, tops):
        for r, path in zip(*trees[s]):
            text = r[4]
            if text is not None and zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 2 == 0:
                text = text.replace("\n", "")
            folded = leaf(r, text)
            for a, b in path + top:
                folded = h(a, folded, b)
            out.append((r[0], leaf(r, r[4]), subroot, root, h(*(a + b for a, b in path + top)), folded, folded == root))
    return Counter(out)


def found(spark, rows, **parameters):
    docs = spark.createDataFrame([(*r, 5, 6) for r in rows], SCHEMA).repartition(3)
    return Counter(tuple(r) for r in merkle.manifest(docs, **parameters).collect())


def some_rows(n, seed=3):
    rng = random.Random(seed)
    rows = [(i, rng.choice(["hot"] * 6 + ["b", "é", None, "lone"]) if i else "only", rng.choice(["en", None]), rng.choice([None, 5]), f"t{i}\nx" * (i % 3)) for i in range(n)]
    odd = [(None, None, None, None, None), (None, "b", None, None, "a\nb"), (7, "b", "en", 1, "x\ny"), (7, "b", "en", 1, "x\ny"), (7, "b", "en", 2, ""), (10 ** 12, "b", "en", 1, "é\n" * 300_000)]
    return rows + odd


def test_equals_a_plain_tree(spark):
    rows = some_rows(140)
    want = plain(rows)
    # blocks of 9 leaves, few broadcast nodes: several stages and a shuffled part
    assert found(spark, rows, levels=2, hot=3) == want
    assert {v[-1] for v in want} == {True, False}


def test_one_row_one_source_and_none(spark):
    for rows in ([(1, "a", "en", 1, "x\n")], [(i, f"s{i % 20:03}", None, None, f"\n{i}") for i in range(28)]):
        assert found(spark, rows, levels=2) == plain(rows)
    assert found(spark, []) == Counter()
