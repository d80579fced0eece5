"""Encoding beside the library, appends and edits beside encoding anew."""

import base64
import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken

from plumbline.llm import byte_bpe

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def merges():
    return byte_bpe.load(PATH)


def text(rng, length):
    parts = ["the", " of", "tion", "é", "ß", "  ", "\n", "'s", "'re", "123", "!!", "\t", "日本", "😀", " a", "zx", " ", "<|endoftext|>", "aaaa", " ", "'"]
    return "".join(rng.choice(parts) for _ in range(length))


def test_texts_equal_the_library(library, merges, sf, spark):
    rng = random.Random(3)
    made = byte_bpe.Encoder(merges, P.PATTERN)
    texts = [text(rng, rng.randint(0, 60)) for _ in range(2000)] + ["", "a" * 3000, " " * 500, "ab" * 900 + "\n" * 40]
    texts += [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").limit(150).collect()]
    for t in texts:
        ids = made.ids(t)
        assert list(memoryview(ids).cast("I")) == library.encode_ordinary(t)
        assert made.text(ids) == t.encode()


def test_every_character_is_split_as_in_the_library(library, merges):
    made = byte_bpe.Encoder(merges, P.PATTERN)
    for start in range(0, 0x110000, 4096):
        chars = [chr(c) for c in range(start, start + 4096) if not 0xD800 <= c < 0xE000]
        t = "".join(f"a{c}1{c} {c}!{c}" for c in chars)
        assert list(memoryview(made.ids(t)).cast("I")) == library.encode_ordinary(t)


def test_appends_and_edits_equal_encoding_anew(merges):
    rng = random.Random(4)
    letters = "the of tion aa zz on er in ré ß".split()
    for _ in range(200):
        piece = "".join(rng.choice(letters) for _ in range(rng.randint(1, 200))).encode()
        table = byte_bpe.PrefixTable(merges, piece[:3])
        for i in range(3, len(piece), 5):
            table.append(piece[i:i + 5])
        assert table.last == byte_bpe.PrefixTable(merges, piece).last
        for _ in range(4):
            a = rng.randint(0, len(table.piece))
            b = rng.randint(a, min(len(table.piece), a + 6))
            new = rng.choice(letters).encode()[: rng.randint(0, 4)]
            table.edit(a, b, new)
            assert table.last == byte_bpe.PrefixTable(merges, table.piece).last
        at = rng.randint(0, len(table.piece))
        assert table.tokens(at) == byte_bpe.PrefixTable(merges, table.piece[:at]).tokens()


def test_query_columns_and_odd_rows(spark, library):
    rows = [(1, None, "x"), (2, "", "y"), (None, "Hello world's  end\n", "z"), (3, "Ünï", None), (3, "Ünï", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, token_ids string")
    got = sorted(((r.doc_id, *r[1:]) for r in byte_bpe.digests(docs, PATH, P.PATTERN).collect()), key=str)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = []
    for doc_id, t, _ in rows:
        ids = library.encode_ordinary(t or "")
        want.append((doc_id, len(ids), sha(b"".join(i.to_bytes(4, "little") for i in ids)), sha((t or "").encode())))
    assert got == sorted(want, key=str)
    assert byte_bpe.digests(docs.limit(0), PATH, P.PATTERN).count() == 0
