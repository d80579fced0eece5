"""Every stage on its own input, and the run as a whole, beside plain computations."""

import hashlib

import public_tokenizers as P
from test_simhash import plain

import corpus_pipeline
from plumbline.llm import byte_bpe, language_id, mixing
from plumbline.llm.common import settle


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    odd = [(900_001, "щуча жыве пад вадою " * 30, "xx", "src1", 9), (900_002, None, None, None, None), (900_003, "12 34", "en", "src1", 5)]
    docs = settle(docs.unionByName(spark.createDataFrame(odd, docs.schema)), "test")
    columns, kept = docs.columns, docs
    for (name, stage), check in zip(corpus_pipeline.STAGES, (identified, copies, near_copies, mix, encode)):
        out = settle(stage(spark, kept, sf), name)
        check(kept.collect(), out.collect())
        if stage is not corpus_pipeline.encoded:
            assert out.columns == columns
        kept = out


def identified(before, after):
    kept = {r.doc_id for r in after}
    gone = {r.doc_id for r in before} - kept
    assert {900_002, 900_003} <= gone and len(gone) <= 5  # learned "xx" from 900,001 or not
    assert all(language_id.words_in(r.text) for r in after)


def copies(before, after):
    best = {}
    for r in before:
        key = "".join(c.lower() if "A" <= c <= "Z" else c for c in r.text or "")
        best[key] = max(r.doc_id, best.get(key, r.doc_id))
    assert sorted(r.doc_id for r in after) == sorted(best.values())


def near_copies(before, after):
    want = {component for _, _, component in plain([(r.doc_id, r.text) for r in before])}
    assert sorted(r.doc_id for r in after) == sorted(want)


def mix(before, after):
    texts = {r.doc_id: r.text for r in before}
    assert {r.doc_id for r in after} <= set(texts)
    assert all(texts[r.doc_id].startswith(r.text) for r in after)
    total = sum(len(r.text.split()) for r in before)
    assert abs(sum(len(r.text.split()) for r in after) - 1.5 * total) <= 0.02 * total
    assert mixing.SHARE == 1.5


def encode(before, after):
    made = byte_bpe.Encoder(byte_bpe.load(P.path("byte_bpe_50k.tiktoken")), P.PATTERN)
    want = sorted((r.doc_id, hashlib.sha256(made.ids(r.text)).hexdigest(), hashlib.sha256(r.text.encode()).hexdigest()) for r in before)
    assert sorted((r.doc_id, r.ids_sha256, r.decoded_sha256) for r in after) == want


def test_run_agrees_with_itself_and_keeps_clean_documents(spark, sf):
    first = sorted((r.doc_id, r.n_tokens, r.ids_sha256) for r in corpus_pipeline.run(spark, sf).collect())
    assert first == sorted((r.doc_id, r.n_tokens, r.ids_sha256) for r in corpus_pipeline.run(spark, sf).collect())
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert corpus_pipeline.identified(spark, docs, sf).count() >= 0.99 * docs.count()
