"""Cross-entropies beside a recursive Kneser-Ney model; accuracy on held-out documents."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.llm import language_id as L


class Plain:
    """Interpolated Kneser-Ney, from its definition."""

    def __init__(self, words, order):
        self.order = order
        full = Counter()
        for w in words:
            line = L.BORDER + w + L.BORDER
            full.update(line[max(0, e - order):e] for e in range(2, len(line) + 1))
        self.counts = {k: Counter({g: n for g, n in full.items() if len(g) == k}) for k in range(1, order + 1)}
        for k in range(order, 1, -1):
            for g in self.counts[k]:
                self.counts[k - 1][g[1:]] += 1

    def p(self, gram):
        if not gram:
            return L.UNSEEN
        table = self.counts[len(gram)]
        followers = {g: n for g, n in table.items() if g[:-1] == gram[:-1]}
        below = self.p(gram[1:])
        if not followers:
            return below
        sizes = Counter(table.values())
        less = sizes[1] / (sizes[1] + 2 * sizes[2]) if sizes[1] and sizes[2] else 0.5
        total = sum(followers.values())
        return max(followers.get(gram, 0) - less, 0) / total + less * len(followers) / total * below

    def bits(self, text):
        words, logs, n = L.words_in(text), 0.0, 0
        for w in words:
            line = L.BORDER + w + L.BORDER
            for e in range(2, len(line) + 1):
                logs += math.log2(self.p(line[max(0, e - self.order):e]))
                n += 1
        return -logs / n


@pytest.mark.parametrize("order", [1, 2, 3, 5])
def test_entropies_equal_the_definition(spark, order):
    texts = {"aa": "the cat that sat there then ran at the rat", "bb": "das ist das haus und die maus", "cc": "été là où élan"}
    rows = spark.createDataFrame([(k, v) for k, v in texts.items()], "lang string, text string")
    counts = {}
    for r in L.gram_counts(rows, order).collect():
        counts.setdefault(r.lang, {})[r.gram] = r.n
    made = L.Identifier(counts, order)
    tests = ["the hat", "haus maus katze", "là-bas où", "x", "Thetha12 cat", "日本 the"]
    bits, sizes = made.entropies(tests)
    for i, t in enumerate(tests):
        assert sizes[i] == sum(len(w) + 1 for w in L.words_in(t))
        for m, lang in enumerate(made.langs):
            assert bits[i, m] == pytest.approx(Plain(L.words_in(texts[lang]), order).bits(t))


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = L.identify(docs).join(docs, "doc_id").filter("held_out").select("lang", "lang_pred", "score", "rejected").collect()
    right = np.array([r.lang == r.lang_pred for r in rows])
    assert right.mean() > 0.97
    assert sum(r.rejected for r in rows) <= 0.01 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_rows_and_foreign_text(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")
    model = L.fit(docs)
    odd = [(1, None), (2, ""), (3, "123 !!"), (4, "щуча жыве пад вадою и ловит рыбу " * 20), (None, "the thing and that " * 3)]
    rows = spark.createDataFrame([(*r, "x", 7) for r in odd], "doc_id bigint, text string, score string, lang_pred int")
    out = L.predict(rows, model)
    got = {r.doc_id: (r.lang_pred_, r.lang_score_, r.lang_rejected_) for r in out.collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0, True)
    assert got[4][2] and got[None][0] == "en" and not got[None][2]
    assert L.predict(rows.limit(0), model).count() == 0
    none = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in L.identify(none).collect()} == {"und"}
    assert L.identify(docs.limit(0)).count() == 0
    long = spark.createDataFrame([(1, "the thing and that " * 50_000)], "doc_id bigint, text string")
    assert L.predict(long, model).first().lang_pred_ == "en"


@pytest.mark.parametrize("out", ["de", "en", "es", "fr"])
def test_a_language_left_out_is_rejected(spark, out):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("text is not null")
    model = L.fit(docs.filter(L.learned_rows(F.col("doc_id")) & (F.col("lang") != out)))
    rows = L.predict(docs.filter(F.col("lang") == out).orderBy("doc_id").limit(100), model).collect()
    assert sum(r.lang_rejected_ for r in rows) >= 0.95 * len(rows)
    own = L.predict(docs.filter(F.col("lang") != out), model).collect()
    # some of these have passages in the language left out
    assert sum(r.lang_rejected_ for r in own) <= 0.02 * len(own)


def test_bounds_follow_the_quantile_and_not_single_outliers():
    rng = np.random.default_rng(3)
    many = rng.exponential(0.1, 50_000)
    assert np.mean(many > L.highest(many)) == pytest.approx(L.FALSE_REJECTS, rel=0.1)
    few = rng.exponential(0.1, 200)
    assert L.highest(np.append(few, 100.0)) < 1.5 * L.highest(few)
    made = L.Identifier({"aa": {"a": 1}, "bb": {"b": 1}}, 1)
    made.bound([(0, 2.0 + x, 600, True) for x in few])
    assert np.isfinite(made.bounds).all()  # also of the language without a document apart
