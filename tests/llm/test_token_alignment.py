"""Alignment beside a token-by-token computation with the libraries, in one part and in many small ones."""

import hashlib
import json
from collections import Counter, defaultdict

import public_tokenizers as P
import sentencepiece
from tokenizers import Tokenizer

from plumbline.llm import queries
from plumbline.llm import token_alignment as T


def plain(rows):
    a = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [x for x in range(256) if x not in printable]
    letter = {chr(x): x for x in printable} | {chr(256 + k): x for k, x in enumerate(rest)}
    entries = {i: t for t, i in json.load(open(P.path("byte_bpe_50k.json"), encoding="utf-8"))["model"]["vocab"].items()}

    def bytes_b(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if piece.startswith("<0x") else piece.replace("▁", " ").encode()

    pairs, docs = Counter(), []
    for doc_id, text in rows:
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        whole = (" " + text).encode() if text else b""
        raw_a, raw_b = [bytes(letter[c] for c in entries[i]) for i in ids_a], [bytes_b(i) for i in ids_b]
        if not text or b"".join(raw_a) != whole or b"".join(raw_b) != whole:
            docs.append((doc_id, [], [], [], []))
            continue
        links, groups, i, j, end_a, end_b = [], [], 0, 0, len(raw_a[0]), len(raw_b[0])
        group = ([ids_a[0]], [ids_b[0]])
        while True:
            links.append((ids_a[i], ids_b[j]))
            if end_a == end_b:
                groups.append(group)
                i, j = i + 1, j + 1
                if i == len(ids_a):
                    break
                end_a, end_b = end_a + len(raw_a[i]), end_b + len(raw_b[j])
                group = ([ids_a[i]], [ids_b[j]])
            elif end_a < end_b:
                i += 1
                end_a += len(raw_a[i])
                group[0].append(ids_a[i])
            else:
                j += 1
                end_b += len(raw_b[j])
                group[1].append(ids_b[j])
        pairs.update(links)
        docs.append((doc_id, ids_a, ids_b, groups, links))
    most = defaultdict(int)
    for (_, y), n in pairs.items():
        most[y] = max(most[y], n)
    out = []
    for doc_id, ids_a, ids_b, groups, links in docs:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((doc_id, len(ids_a), len(ids_b), len(groups), len(links), sum(pairs[p] == most[p[1]] for p in links), sum(pairs[p] for p in links),
                    hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return Counter(out)


def found(docs, **parameters):
    return Counter(tuple(r) for r in T.align(docs, P.path("byte_bpe_50k.json"), P.PATTERN, P.path("piece_bpe_32k.model"), **parameters).collect())


ODD = [(1, None), (2, ""), (3, " "), (4, "a"), (5, "<|endoftext|> <s>hello</s>"), (6, "a▁b"), (7, "x 　y  z\t\n\n"), (None, "same text"), (None, "same text"),
       (8, "\U0001f600\U0001f9d1‍\U0001f680 naïve й̆"), (9, "naﬁve ①"), (10, "word " * 30_000), (11, "\x00\x01"), (12, "aaaa" * 2_000)]


def test_equals_a_plain_computation(spark):
    rows = ODD + [(100 + i, f"the {i} cats and élèves of the house, number {i * 7}." * (i % 4)) for i in range(60)]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id bigint, text string, part int, spill int").repartition(4)
    want = plain(rows)
    assert found(docs) == want
    # many spills, parts that are split and parts that are not
    assert found(docs, spill=600, heavy=200, parts=8) == want
    assert found(docs.limit(0)) == Counter()


def test_over_the_documents_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert Counter(tuple(r) for r in queries.op12_alignment(spark, sf).collect()) == plain([(r.doc_id, r.text) for r in docs.collect()])


def test_packed_arrays_come_back():
    import numpy as np

    for arrays in ([np.array([], int)], [np.array([0, 1, 1 << 40]), np.array([255, 256]), np.arange(5)]):
        assert [x.tolist() for x in T.unpack(T.pack(*arrays))] == [x.tolist() for x in arrays]
