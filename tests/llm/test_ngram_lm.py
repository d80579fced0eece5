"""Scores beside a plain model with dictionaries; the probabilities add up to one."""

import math
import re
import zlib
from collections import Counter

import pytest

from plumbline.llm import ngram_lm


def tokens(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), "</s>"]


class Plain:
    def __init__(self, texts, order, mu):
        self.order, self.mu, self.grams = order, mu, Counter()
        for t in texts:
            line = ("<s>", *tokens(t))
            for k in range(1, order + 1):
                self.grams.update(line[i:i + k] for i in range(len(line) - k + 1))
        single = {g[0]: c for g, c in self.grams.items() if len(g) == 1 and g[0] != "<s>"}
        self.count, self.n, self.v = single, sum(single.values()), len(single)
        ones, twos = (sum(c == k for c in single.values()) for k in (1, 2))
        self.less = ones / (ones + 2 * twos) if ones and twos else 0.5

    def p(self, word, context):
        if not context:
            if not self.n:
                return 1.0
            c = self.count.get(word, 0)
            return (c - self.less) / self.n if c else self.less * self.v / self.n
        c = self.grams.get(context, 0)
        return (self.grams.get((*context, word), 0) + self.mu * self.p(word, context[1:])) / (c + self.mu)

    def score(self, text):
        line = ("<s>", *tokens(text))
        return sum(math.log10(self.p(line[i], line[max(0, i - self.order + 1):i])) for i in range(1, len(line)))


def held(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 10 == 0


def check(spark, rows, order, mu, **sizes):
    docs = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id bigint, text string, score double")
    model = Plain([t for i, t in rows if not held(i)], order, mu)
    got = sorted(ngram_lm.score(docs, order=order, mu=mu, **sizes).collect(), key=lambda r: (str(r.doc_id), r.n_tokens, r.score))
    want = sorted(rows, key=lambda r: (str(r[0]), len(tokens(r[1])), model.score(r[1])))
    assert len(got) == len(want)
    for r, (doc_id, text) in zip(got, want):
        line = tokens(text)
        floor = math.log10(model.n + 0.1 * (model.v + 1))
        base = sum(math.log10(model.count.get(w, 0) + 0.1) - floor for w in line)
        assert (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (doc_id, held(doc_id), len(line), sum(w in model.count for w in line), model.n)
        assert r.base_score == pytest.approx(base, abs=1e-6) and r.score == pytest.approx(model.score(text), abs=1e-6)


ROWS = [(i, t) for i, t in enumerate(["the cat sat", "The cat  ran\taway", "", None, "a dog sat on the cat", "zebra the cat sat on", "É é the", "the the the the"] * 3)] + [(None, "the cat"), (5, "a dog sat on the cat")]


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_equal_the_plain_model(spark, order):
    check(spark, ROWS, order, 3.0, chunk_bytes=300, tokens_per_part=20)


def test_documents_equal_the_plain_model(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    check(spark, rows, 2, 100.0, chunk_bytes=100_000)


def test_probabilities_add_up(spark):
    texts = [t for i, t in ROWS if not held(i)]
    model = Plain(texts, 2, 3.0)
    words = [*model.count, "never-seen"]
    for context in [(), ("the",), ("<s>",), ("never-seen",), ("cat",)]:
        assert sum(model.p(w, context) for w in words) == pytest.approx(1.0)


def test_empty_table_and_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(None, "one two")], "doc_id bigint, text string")
    row = ngram_lm.score(docs).first()
    assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens, row.score) == (True, 3, 0, 0, 0.0)
    assert ngram_lm.score(docs.limit(0)).count() == 0
