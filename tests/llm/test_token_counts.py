"""Counts beside the library."""

import random

import numpy as np
import public_tokenizers as P
import pytest
import regex
from tokenizers import Tokenizer

from plumbline.llm import token_counts

PATH = P.path("byte_bpe_50k.json")
PARTS = ["the", " of", "tion", "é", "ß", "  ", "\n", "'s", "'re", "'ll", "'v", "'r", "'l", "ll", "e", "123", "!!", "\t", "日本", "😀", " a", "zx",
         " ", "<|endoftext|>", "aaaa", "　", "'", "\x1c", "\x85", "\x00", "thtiong"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def counter():
    return token_counts.token_counter(PATH)


def expected(library, texts):
    return [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_counts_equal_the_library(library, counter):
    rng = random.Random(1)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 40))) for _ in range(2000)]
    texts += ["", "a" * 5000, " " * 3000, "<|endoftext|>", "the quick " * 3000]
    assert counter.counts(texts).tolist() == expected(library, texts)


def test_every_character(library, counter):
    chars = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{c}1{c} {c}!{c}" for c in chars[i:i + 2000]) for i in range(0, len(chars), 2000)]
    assert counter.counts(texts).tolist() == expected(library, texts)


def test_split_equals_the_pattern_over_chunk_borders(counter):
    rng = random.Random(2)
    text = "".join(rng.choice(PARTS) for _ in range(6000))
    splitter = counter.splitter
    kinds = np.append(splitter.kinds[[ord(c) for c in text]], token_counts.END)
    assert splitter.starts(kinds).tolist() == [m.start() for m in regex.finditer(P.PATTERN, text)]


def test_a_full_table_begins_anew(library):
    small = token_counts.TokenCounter(PATH)
    small.counter.most = 40
    rng = random.Random(3)
    texts = ["".join(rng.choice(PARTS) for _ in range(30)) for _ in range(60)]
    assert small.counts(texts).tolist() == expected(library, texts)
    assert len(small.counter.states) < 4000


def test_query_columns_and_odd_rows(spark, library):
    rows = [(1, None, 1), (2, "", 2), (None, "Ünï <|endoftext|> x", 3), (3, "a " * 600, 4), (3, "a " * 600, 4)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens int")
    got = {(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.count_tokens(docs, PATH).collect()}
    texts = [t or "" for _, t, _ in rows]
    assert got == {(r[0], len(t.encode()), n, n > 512) for r, t, n in zip(rows, texts, expected(library, texts))}
    assert token_counts.count_tokens(docs.limit(0), PATH).count() == 0
