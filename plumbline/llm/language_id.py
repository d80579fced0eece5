"""Language identification by interpolated Kneser-Ney character models.

Each language has a model of the characters of its words (lower-cased letters between word
borders): interpolated Kneser-Ney of order ``ORDER``, the lower orders with continuation
counts, stored as sorted arrays of n-gram hashes beside their probabilities and of context
hashes beside their backoff weights. A text has the language of lowest cross-entropy per
character. Its score is that language's share of the calibrated posterior. Texts without
letters, and null texts, are ``und`` with score 0.

Rejection: a text is ``rejected`` (written in no learned language) when its cross-entropy, every
run of ``RUN`` words under the language it fits best, is above the bound of the text's language
and length class. Passages in several learned languages therefore do not count as foreign. The bounds come from the
documents set apart from the counts, whole and as pieces of the least length of each class:
what that cross-entropy exceeds the language's median by has, per class,
the bound as its quantile at ``1 - FALSE_REJECTS``. A language with under ``ENOUGH`` texts in a
class takes the quantile over all languages; with under ``ENOUGH`` of those too, it is carried on
from the upper fifth by an exponential tail: the mean excess, each at most ten times the median
(so single outliers do not move it), at its upper confidence bound of two standard errors.

The models are fitted on a bounded sample: per language about ``per_language`` documents (hash
of the id under a threshold from the language's count), whole texts. Everything else reads all
rows. There is one model per language, sent to every task: made for hundreds of languages. Ties go to the language first by code point. A null language or id is not
learned from; repeated rows are predicted one by one. With nothing to learn from every text is
``und``. Other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bytes_of, free_names, id_remainder, mix64, settle, slices

ORDER = 5
PER_LANGUAGE = 2_000
APART = 5  # one sampled document in so many calibrates
FALSE_REJECTS = 0.002  # share of texts in a learned language that may be rejected
ENOUGH = 2_500  # texts whose quantile at 1 - FALSE_REJECTS does not hang on a few
LENGTHS = np.array([0, 32, 128, 512])  # least characters of each length class
RUN = 8  # words judged together, so that a text in several learned languages stays
LEAST = 12  # characters of the pieces of the first class
UNSEEN = 1.0 / 65536  # the uniform distribution below order 1
BORDER = "\x00"
STEP = np.uint64(0x9E3779B97F4A7C15)
LETTERS = re.compile(r"[^\W\d_]+")
TEXT_AT_ONCE = 1 << 20


def words_in(text: str) -> list[str]:
    return LETTERS.findall(text.lower())


def sample(docs: DataFrame, per_language: int) -> DataFrame:
    """About ``per_language`` rows of each language: text, lang, apart."""
    key = F.pmod(F.xxhash64(F.lit(11), F.col("doc_id").cast("string")), F.lit(1 << 40))
    counts = docs.groupBy("lang").agg(F.count(F.lit(1)).alias("rows_"))
    bound = F.lit(float(1 << 40)) * per_language / F.col("rows_")
    # one row per language, as there is one model per language
    return docs.join(F.broadcast(counts), "lang").filter(key.cast("double") < bound).select("text", "lang", (key % APART == 0).alias("apart"))


def gram_counts(rows: DataFrame, order: int) -> DataFrame:
    """lang, gram, count: every n-gram of the full order and those at word beginnings."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[str, Counter] = defaultdict(Counter)
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), bytes_of(batch.column("text"))):
                words[lang].update(words_in(text.decode()))
        for lang, held in words.items():
            grams: Counter = Counter()
            for word, n in held.items():
                line = BORDER + word + BORDER
                for end in range(2, len(line) + 1):
                    grams[line[max(0, end - order):end]] += n
            yield pa.RecordBatch.from_pydict({"lang": [lang] * len(grams), "gram": list(grams), "n": list(grams.values())},
                                             pa.schema([("lang", pa.string()), ("gram", pa.string()), ("n", pa.int64())]))

    counted = rows.select("lang", "text").mapInArrow(run, "lang string, gram string, n bigint")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def hash_gram(gram: str) -> int:
    value = np.uint64(0)
    for c in gram:
        value = mix64(np.array([value * STEP + np.uint64(ord(c) + 1)]))[0]
    return int(value)


class Model:
    """One language: per order, sorted hashes of n-grams and contexts beside their values."""

    def __init__(self, counts: dict[str, int], order: int):
        """``counts``: n-grams of the full order, shorter ones where a word begins."""
        self.order = order
        tables: list[dict[str, int]] = [dict() for _ in range(order + 1)]
        for gram, n in counts.items():
            tables[len(gram)][gram] = tables[len(gram)].get(gram, 0) + n
        for k in range(order, 1, -1):
            # continuation counts: the different characters before; what begins a word keeps its count
            for gram in tables[k]:
                tables[k - 1][gram[1:]] = tables[k - 1].get(gram[1:], 0) + 1
        self.grams, self.contexts = [], []
        shorter: dict[str, float] = {}
        for k in range(1, order + 1):
            table = tables[k]
            twos = Counter(table.values())
            less = twos[1] / (twos[1] + 2 * twos[2]) if twos[1] and twos[2] else 0.5
            sums, kinds = Counter(), Counter()
            for gram, n in table.items():
                sums[gram[:-1]] += n
                kinds[gram[:-1]] += 1
            back = {c: less * kinds[c] / sums[c] for c in sums}
            p = {g: (n - less) / sums[g[:-1]] + back[g[:-1]] * (shorter.get(g[1:], UNSEEN) if k > 1 else UNSEEN) for g, n in table.items()}
            self.grams.append(_sorted(p))
            self.contexts.append(_sorted(back))
            shorter = p

    def logs(self, windows: list[np.ndarray], contexts: list[np.ndarray]) -> np.ndarray:
        """log2 probability per window: ``windows[k]`` hashes its last k + 1 characters (0: fewer are there)."""
        p = np.full(len(windows[0]), UNSEEN)
        for k in range(self.order):
            found, value = _lookup(self.grams[k], windows[k])
            known, back = _lookup(self.contexts[k], contexts[k])
            p = np.where(found, value, np.where(known, back * p, p))
        return np.log2(p)


def _sorted(values: dict[str, float]) -> tuple[np.ndarray, np.ndarray]:
    grams = list(values)
    longest = len(grams[0]) if grams else 0
    points = np.array([[ord(c) for c in g] for g in grams], np.uint64).reshape(len(grams), longest)
    hashes = np.zeros(len(grams), np.uint64)
    for column in points.T:
        hashes = mix64(hashes * STEP + column + np.uint64(1))
    order = np.argsort(hashes)
    return hashes[order], np.array(list(values.values()))[order]


def _lookup(table: tuple[np.ndarray, np.ndarray], hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys, values = table
    if not len(keys):
        return np.zeros(len(hashes), bool), np.zeros(len(hashes))
    at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
    return keys[at] == hashes, values[at]


class Identifier:
    def __init__(self, counts: dict[str, dict[str, int]], order: int):
        self.langs, self.order = sorted(counts, key=lambda s: s.encode()), order
        self.models = [Model(counts[lang], order) for lang in self.langs]
        self.sharp = 1.0
        self.bounds = np.full((len(self.langs), len(LENGTHS)), np.inf)

    def _word_logs(self, words: list[str]) -> np.ndarray:
        """log2 probability of each word under each language."""
        order = self.order
        line = BORDER.join(words) + BORDER
        points = np.frombuffer((BORDER + line).encode("utf-32-le"), "<u4").astype(np.uint64)
        n = len(points)
        border = points == 0
        since = np.arange(n) - np.maximum.accumulate(np.where(border, np.arange(n), 0))
        since[border] = np.concatenate([[0], np.diff(np.flatnonzero(border))])  # a closing border belongs to its word
        windows, contexts = [], []
        for k in range(order + 1):  # hashes of the last k characters before each place, and with it
            value = np.zeros(n, np.uint64)
            for back in range(k, 0, -1):
                shifted = np.concatenate([np.zeros(min(back, n), np.uint64), points[:-back]]) if back < n else np.zeros(n, np.uint64)
                value = mix64(value * STEP + shifted + np.uint64(1))
            if k < order:
                contexts.append(np.where(since >= k, value, 0) if k else value)
                windows.append(np.where(since >= k, mix64(value * STEP + points + np.uint64(1)), 0))
        keys = windows[0].copy()
        for w in windows[1:]:
            keys = mix64(keys * STEP ^ w)
        _, first, at = np.unique(keys[1:], return_index=True, return_inverse=True)
        first = first + 1
        ends = np.flatnonzero(border)[1:]
        starts = np.concatenate([[0], ends[:-1]])
        out = np.empty((len(words), len(self.models)))
        for m, model in enumerate(self.models):
            logs = model.logs([w[first] for w in windows], [c[first] for c in contexts])[at]
            out[:, m] = np.add.reduceat(logs, starts)
        return out

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Bits per character of each text under each language, and the characters."""
        return self.measures(texts)[:2]

    def measures(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The entropies, and the bits per character with every run of words under its best language."""
        index: dict[str, int] = {}
        rows = [[index.setdefault(w, len(index)) for w in words_in(t)] for t in texts]
        lengths = np.array([len(w) + 1 for w in index], np.int64)
        out, sizes, fit = np.zeros((len(texts), len(self.models))), np.zeros(len(texts), np.int64), np.zeros(len(texts))
        if index and self.models:
            logs = self._word_logs(list(index))
            for i, row in enumerate(rows):
                if row:
                    sizes[i] = lengths[row].sum()
                    runs = np.add.reduceat(logs[row], np.arange(0, len(row), RUN), axis=0)
                    out[i], fit[i] = -runs.sum(axis=0) / sizes[i], -runs.max(axis=1).sum() / sizes[i]
        elif index:
            sizes = np.array([lengths[row].sum() if row else 0 for row in rows])
        return out, sizes, fit

    def calibrate(self, bits: np.ndarray, sizes: np.ndarray, langs: list[str]) -> None:
        """Sharpness of the posterior."""
        own = np.array([self.langs.index(lang) for lang in langs], int)
        ok = sizes > 0
        bits, sizes, own = bits[ok], sizes[ok], own[ok]
        if not len(own):
            return
        margin = (bits - bits.min(axis=1, keepdims=True)) * np.sqrt(sizes)[:, None]
        trials = np.geomspace(0.01, 10, 40)
        loss = [-np.mean(np.log(np.maximum(_posterior(margin, s)[np.arange(len(own)), own], 1e-12))) for s in trials]
        self.sharp = float(trials[int(np.argmin(loss))])

    def bound(self, texts: list[tuple[int, float, int, bool]]) -> None:
        """Bounds of rejection from (own language, bits per character by runs, characters, whole document)."""
        rows = [t for t in texts if t[2] > 0]
        own, bits, sizes, whole = (np.array(c) for c in zip(*rows)) if rows else (np.empty(0),) * 4
        medians, above = np.full(len(self.langs), np.nan), [[np.empty(0)] * len(LENGTHS) for _ in self.langs]
        for m in range(len(self.langs)):
            mine = own == m
            if not (mine & whole).any():
                continue
            medians[m] = np.median(bits[mine & whole])
            kinds = length_class(sizes[mine])
            for c in range(len(LENGTHS)):
                above[m][c] = bits[mine][kinds == c] - medians[m]
        if np.isnan(medians).all():
            return
        medians = np.where(np.isnan(medians), np.nanmax(medians), medians)  # no document apart
        for c in range(len(LENGTHS)):
            pooled = np.concatenate([a[c] for a in above])
            if not len(pooled):
                pooled = np.concatenate([x for a in above for x in a])
            for m in range(len(self.langs)):
                self.bounds[m, c] = medians[m] + highest(above[m][c] if len(above[m][c]) >= ENOUGH else pooled)

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and rejection of each text."""
        bits, sizes, fit = self.measures(texts)
        score, rejected = np.zeros(len(texts)), np.ones(len(texts), bool)
        names = ["und"] * len(texts)
        rows = np.flatnonzero(sizes > 0) if self.models else []
        if len(rows):
            best = bits[rows].argmin(axis=1)
            margin = (bits[rows] - bits[rows].min(axis=1, keepdims=True)) * np.sqrt(sizes[rows])[:, None]
            score[rows] = _posterior(margin, self.sharp)[np.arange(len(rows)), best]
            rejected[rows] = fit[rows] > self.bounds[best, length_class(sizes[rows])]
            for i, m in zip(rows.tolist(), best.tolist()):
                names[i] = self.langs[m]
        return names, score, rejected


def length_class(sizes: np.ndarray) -> np.ndarray:
    return np.searchsorted(LENGTHS, sizes, side="right") - 1


def highest(above: np.ndarray) -> float:
    """The quantile at ``1 - FALSE_REJECTS``; of few values, by the tail beyond their upper fifth."""
    if len(above) >= ENOUGH:
        return float(np.quantile(above, 1 - FALSE_REJECTS))
    start = np.quantile(above, 0.8)
    beyond = above[above > start] - start
    scale = np.minimum(beyond, 10 * np.median(beyond)).mean() * (1 + 2 / np.sqrt(len(beyond))) if len(beyond) else 0.0
    return float(start + max(scale, 0.05) * np.log(0.2 / FALSE_REJECTS))


def pieces(text: str) -> list[str]:
    """Words from the middle of a text, one piece of the least length of each class that the text reaches."""
    words = words_in(text)
    ends = np.cumsum([len(w) + 1 for w in words])
    out = []
    for least in [LEAST, *LENGTHS[1:]]:
        if not len(ends) or ends[-1] <= least:
            break
        first = int(np.searchsorted(ends, (ends[-1] - least) // 2))
        last = int(np.searchsorted(ends, (ends[first - 1] if first else 0) + least))
        out.append(" ".join(words[first:last + 1]))
    return out


def _posterior(margin: np.ndarray, sharp: float) -> np.ndarray:
    weights = np.exp(-sharp * margin)
    return weights / weights.sum(axis=1, keepdims=True)


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE, order: int = ORDER) -> Identifier:
    """Models from rows with text, lang and doc_id; the sample bounds what reaches the driver."""
    learned = docs.filter("text is not null and lang is not null and doc_id is not null").select("doc_id", "text", "lang")
    rows = settle(sample(learned, per_language), "language-sample")
    counts: dict[str, dict[str, int]] = defaultdict(dict)
    table = gram_counts(rows.filter("not apart"), order).toArrow()
    for lang, gram, n in zip(*(table.column(c).to_pylist() for c in ("lang", "gram", "n"))):
        counts[lang][gram] = n
    made = Identifier(counts, order)
    model = docs.sparkSession.sparkContext.broadcast(made)
    langs = made.langs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", TEXT_AT_ONCE):
            texts = [t.decode() for t in bytes_of(batch.column("text"))]
            parts = [pieces(t) for t in texts]
            bits, sizes, fit = model.value.measures([*texts, *(p for ps in parts for p in ps)])
            cut, ends = len(texts), np.cumsum([0, *(len(ps) for ps in parts)])
            per_row = lambda values: [values[a:b] for a, b in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang"), pa.array(list(bits[:cut]), pa.list_(pa.float64())), pa.array(sizes[:cut]), pa.array(fit[:cut]),
                 pa.array(per_row(fit[cut:]), pa.list_(pa.float64())), pa.array(per_row(sizes[cut:]), pa.list_(pa.int64()))],
                ["lang", "bits", "n", "fit", "part_fit", "part_n"])

    known = F.col("lang").isin(langs) if langs else F.lit(False)
    table = rows.filter(F.col("apart") & known).select("lang", "text").mapInArrow(
        run, "lang string, bits array<double>, n bigint, fit double, part_fit array<double>, part_n array<bigint>").toArrow()
    if table.num_rows:
        made.calibrate(np.array(table.column("bits").to_pylist()), table.column("n").to_numpy(), table.column("lang").to_pylist())
        own, fit, n, part_fit, part_n = (table.column(c).to_pylist() for c in ("lang", "fit", "n", "part_fit", "part_n"))
        own = [langs.index(lang) for lang in own]
        texts = [(m, f, k, True) for m, f, k in zip(own, fit, n)]
        texts += [(m, f, k, False) for m, fs, ks in zip(own, part_fit, part_n) for f, k in zip(fs, ks)]
        made.bound(texts)
    return made


NAMES = ("lang_pred_", "lang_score_", "lang_rejected_")


def predict(docs: DataFrame, model: Identifier, names: tuple | list = NAMES) -> DataFrame:
    """``docs`` with the predicted language, its score and whether it is rejected, under ``names``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, "text", TEXT_AT_ONCE):
            langs, score, rejected = shared.value.predict([t.decode() for t in bytes_of(rows.column("text"))])
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(langs, pa.string()), pa.array(score), pa.array(rejected)], [*rows.schema.names, *names])

    schema = docs.select("*", F.lit("").alias(names[0]), F.lit(0.0).alias(names[1]), F.lit(True).alias(names[2])).schema
    return docs.mapInArrow(run, schema)


def keep_learned(docs: DataFrame, model: Identifier) -> DataFrame:
    """The documents that are not rejected, ``lang`` as predicted; further columns, whatever their names, are carried."""
    pred, score, rejected = free_names(docs, *NAMES)
    rows = predict(docs, model, (pred, score, rejected)).filter(~F.col(rejected))
    return rows.select(*[F.col(pred).alias("lang") if c == "lang" else F.col(c) for c in docs.columns])


def learned_rows(doc_id: Column) -> Column:
    return id_remainder(doc_id, 3) != 1


def identify(docs: DataFrame, per_language: int = PER_LANGUAGE, order: int = ORDER) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected of every document."""
    model = fit(docs.filter(learned_rows(F.col("doc_id"))), per_language, order)
    rows = predict(docs.select("doc_id", "text"), model)
    return rows.select("doc_id", (~learned_rows(F.col("doc_id"))).alias("held_out"), F.col("lang_pred_").alias("lang_pred"),
                       F.col("lang_score_").alias("score"), F.col("lang_rejected_").alias("rejected"))
