"""Repeated strings beside a table of all strings, for each way a trigger can go."""

import hashlib
import random
from collections import Counter

import numpy as np

from plumbline.llm import queries
from plumbline.llm import repeats as R

SCHEMA = "doc_id bigint, text string, mark int, trigger int"


def plain(rows, length=100):
    """Contract by definition; ``rows`` are (doc_id, text)."""
    raw = [(d, (t or "").encode()) for d, t in rows]
    first = {}
    for d, t in raw:
        d = -(1 << 63) if d is None else d
        for i in range(len(t) - length + 1):
            s = t[i:i + length]
            first[s] = min(first.get(s, (d, i)), (d, i))
    out = []
    for d, t in raw:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if first[t[i:i + length]] < (-(1 << 63) if d is None else d, i):
                gone[i:i + length] = b"\x01" * length
        spans = sum(gone[i] and not (i and gone[i - 1]) for i in range(len(t)))
        out.append((d, len(t), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(t, gone) if not g)).hexdigest()))
    return Counter(out)


def found(docs, **parameters):
    return Counter(tuple(r) for r in queries.repeat_digests(R.without_repeats(docs, **parameters)).collect())


def some_rows(seed=4):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefgh é") for _ in range(rng.randint(2, 9))) for _ in range(400)]

    def text(n):
        return " ".join(rng.choice(words) for _ in range(n))

    passage, line = text(60), "this line stands in very many of the documents, and it is longer than one hundred bytes, surely it is."
    rows = []
    for i in range(80):
        t = text(rng.randint(5, 120))
        if i % 3 == 0:
            t += "\n" + line + str(i)
        if i % 7 == 0:
            t = passage + t[: i * 3]
        if i % 11 == 0 and rows:
            t = rows[-1][1]
        if i % 13 == 0 and rows:
            t = rows[-2][1].replace(words[1], words[2], 1) + "!"
        rows.append((i * 3, t))
    return rows


ODD = [(1, None), (2, ""), (4, "x" * 99), (5, "x" * 100), (7, "x" * 101), (8, "ab" * 3_000), (10, "\0" * 250), (None, "x" * 150), (11, "\0" * 120 + "a" * 20)]


def check(spark, rows, **parameters):
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA).repartition(3)
    want = Counter({(None if k[0] == -(1 << 63) else k[0], *k[1:]): n for k, n in plain(rows).items()})
    assert found(docs, **parameters) == want
    return want


def test_equals_the_definition(spark):
    rows = some_rows()
    want = check(spark, rows + ODD)
    assert sum(k[2] > 0 for k in want) > 30 and sum(k[2] == 0 for k in want) > 10


def test_spread_and_crowded_triggers(spark, monkeypatch):
    rows = some_rows(5) + [(9_000 + i, f"{i * i}: " + "the same words stand here in the middle of every one of them, " * 2 + f"{i}") for i in range(40)]
    check(spark, rows + ODD, crowded=3)

    def every(keyed, *_):
        return spark.range(1).selectExpr("id as heavy").limit(0).unionByName(R.places(keyed).filter("trigger is not null").selectExpr("trigger as heavy").distinct())

    monkeypatch.setattr(R, "heavy_triggers", every)
    check(spark, rows)
    check(spark, rows, crowded=2)


def test_rows_that_repeat(spark):
    a, b = some_rows(6)[0][1] * 3, some_rows(7)[0][1] * 3
    check(spark, [(1, a), (1, a), (1, a + b), (2, b), (None, b), (None, b), (1, b + a)])
    check(spark, [])


def test_frequent_triggers_are_found(spark):
    rows = [(i, "the same one hundred bytes or more stand in every one of these many documents " * 2 + str(i)) for i in range(4_000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(2)
    laid = "".join(t for _, t in rows).encode()
    trigger, _, _ = R.parse(np.frombuffer(laid, np.uint8), np.cumsum([len(t) for _, t in rows]))
    count = Counter(trigger.view(np.int64).tolist())
    got = {r.heavy for r in R.heavy_triggers(R._keyed(docs), heavy=20).collect()}
    often = {t for t, n in count.items() if n * 20 > 3 * len(trigger)}
    assert often and often <= got and len(got) <= 20


def test_a_parse_covers_every_string_once_and_by_content():
    rng = random.Random(1)
    body = bytes(rng.choice(b"abc ") for _ in range(3_000))
    texts = [body, body[500:900], b"z" * 300, b"", b"q" * 99]
    raw, ends = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([len(t) for t in texts])
    trigger, first, count = R.parse(raw, ends)
    inside = [i + k for i, c in zip(first.tolist(), count.tolist()) for k in range(c)]
    starts = [0, *ends.tolist()]
    assert inside == [p for s, e in zip(starts, ends.tolist()) for p in range(s, e - 99)]
    by_string = {}
    for t, i, c in zip(trigger.tolist(), first.tolist(), count.tolist()):
        assert 1 <= c <= 69
        for p in range(i, i + c):
            assert by_string.setdefault(bytes(raw[p:p + 100]), t) == t
