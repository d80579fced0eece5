"""Removal of repeated byte strings by prefix-free parsing and suffix arrays.

A byte goes if it lies in a string of ``LENGTH`` bytes that also starts earlier in the corpus:
in a smaller doc_id, or in the same document further ahead.

Parsing: a rolling hash runs over every ``GRAM`` bytes, and the least hash in a string of
``LENGTH`` bytes (the leftmost, if several) is its trigger. Strings that share a trigger follow
one another and make a phrase: the stretch from the first to the end of the last of them. Where
a string's trigger lies depends on its own bytes only, so equal strings lie at the same place of
phrases with equal triggers, and no string lies in two phrases. The usual triggers (hash a
multiple of p) leave strings without any, and phrases without bound; here a phrase has fewer than
two times ``LENGTH`` bytes. The dictionary is the distinct phrases, the parse their places.

Corpus order: of a phrase that repeats, every place but the first goes whole. First places are
compared only where their trigger has other phrases too: the strings of those phrases are sorted
(the suffix array of that part of the dictionary, to a depth of ``LENGTH``), and of equal ones all
but the first in the order of the parse go. So text that does not repeat is dropped after one
sort, and text that repeats often is compared once per distinct phrase.

Spread: places are shuffled by trigger and swept in order with one row of memory. A task first
settles what repeats inside its own slice of text, so a passage with a third of all rows arrives
as one row per slice. Triggers with over 3 / ``HEAVY`` of all places (at most ``HEAVY`` of them are
broadcast) are spread by phrase. A trigger with more than ``CROWDED`` distinct phrases is taken
apart into its strings, which are grouped by a 128-bit hash with partial sums. Phrases of one
trigger are told apart by 64-bit hashes.

A null text counts as empty; texts under ``LENGTH`` bytes stay whole. A null doc_id comes before
all others. Rows that share a doc_id are one document in this order, so of rows that repeat
wholly none is the earlier one. Further columns are not read. An empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bytes_of, mix64, settle, slices

LENGTH = 100
GRAM = 32  # a power of two
HEAVY = 2_000
CROWDED = 1_024
BLOCK_ROWS = 2_000
TEXT_AT_ONCE = 2 << 20
SMALLEST = -(1 << 63)
BASE = 0x9E3779B97F4A7C15
LETTERS = mix64(np.arange(1, 257, dtype=np.uint64))


def gram_hashes(raw: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A hash of every ``gram`` bytes, by doubling."""
    found, base = LETTERS[raw], np.uint64(BASE)
    size = 1
    while size < gram:
        found = found[:-size] * base + found[size:]
        with np.errstate(over="ignore"):
            base = base * base
        size *= 2
    return mix64(found)


def parse(raw: np.ndarray, ends: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Phrases of texts laid end to end: hash of the trigger, first string, number of strings."""
    none = np.empty(0, np.int64)
    if len(raw) < length:
        return none.view(np.uint64), none, none
    hashes = gram_hashes(raw, gram)
    keys = hashes & np.uint64(0xFFFFFFFF00000000) | np.arange(len(hashes), dtype=np.uint64)
    width, size = length - gram + 1, 1
    least = keys
    while size * 2 <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if width > size:
        least = np.minimum(least[:len(least) - (width - size)], least[width - size:])
    trigger = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    sizes = np.diff(ends, prepend=0)
    inside = np.flatnonzero(np.arange(len(trigger)) + length <= np.repeat(ends, sizes)[:len(trigger)])
    if not len(inside):
        return none.view(np.uint64), none, none
    at = trigger[inside]
    new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (np.diff(inside) != 1)]))
    return hashes[at[new]], inside[new], np.diff(np.append(new, len(inside)))


PLACES = pa.schema([("trigger", pa.int64()), ("phrase", pa.int64()), ("doc", pa.int64()), ("mark", pa.int64()), ("at", pa.int64())])
PLACES_SQL = "trigger bigint, phrase bigint, doc bigint, mark bigint, at bigint"


def _keyed(docs: DataFrame) -> DataFrame:
    """doc (order), mark (hash of the text: with doc the key of a row) and text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(SMALLEST)).alias("doc"), F.xxhash64(text).alias("mark"), text.alias("text"))


def _later(keys: list[np.ndarray], doc: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Which rows share all keys with a row that comes earlier."""
    order = np.lexsort([start, doc, *keys])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for key in keys:
        ranked = key[order]
        new[1:] |= ranked[1:] != ranked[:-1]
    first = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    out = np.empty(len(order), bool)
    out[order] = (doc[order] > doc[first]) | (start[order] > start[first])
    return out


def _laid(batch: pa.RecordBatch) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    texts = bytes_of(batch.column("text"))
    ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
    return b"".join(texts), ends, batch.column("doc").to_numpy(), batch.column("mark").to_numpy()


def places(keyed: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """trigger, phrase, doc, mark, at (first string * 256 + strings); trigger is null where the phrase came earlier in the slice."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in slices(batches, "text", TEXT_AT_ONCE):
            data, ends, doc, mark = _laid(batch)
            trigger, first, count = parse(np.frombuffer(data, np.uint8), ends, length, gram)
            if not len(first):
                continue
            phrase = np.fromiter((digest(data[i:j]) for i, j in zip(first.tolist(), (first + count + length - 1).tolist())), np.uint64, len(first))
            row = np.searchsorted(ends, first, "right")
            start = first - np.concatenate([[0], ends])[row]
            trigger, phrase = trigger.view(np.int64), phrase.view(np.int64)
            again = _later([phrase, trigger], doc[row], start)
            yield pa.RecordBatch.from_arrays(
                [pa.array(trigger, mask=again), pa.array(phrase), pa.array(doc[row]), pa.array(mark[row]), pa.array(start << 8 | count)], schema=PLACES)

    return keyed.mapInArrow(run, PLACES_SQL)


def heavy_triggers(keyed: DataFrame, length: int = LENGTH, gram: int = GRAM, heavy: int = HEAVY) -> DataFrame:
    """At most ``heavy`` triggers, with all that hold over 3 / ``heavy`` of all places.

    A slice leaves out triggers up to 2 / ``heavy`` of its own places, so sums are short by no
    more than that share, and those that still exceed 1 / ``heavy`` are fewer than ``heavy``.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", TEXT_AT_ONCE):
            data, ends, _, _ = _laid(batch)
            trigger, _, _ = parse(np.frombuffer(data, np.uint8), ends, length, gram)
            found, count = np.unique(trigger.view(np.int64), return_counts=True)
            often = count * heavy > 2 * max(len(trigger), 32 * heavy)
            yield pa.RecordBatch.from_pydict({"trigger": [None, *found[often].tolist()], "rows": [len(trigger), *count[often].tolist()]},
                                             pa.schema([("trigger", pa.int64()), ("rows", pa.int64())]))

    summed = settle(keyed.mapInArrow(run, "trigger bigint, rows bigint").groupBy("trigger").agg(F.sum("rows").alias("rows")), "triggers")
    total = summed.filter("trigger is null").select(F.col("rows").alias("total"))
    return summed.join(F.broadcast(total), F.col("rows") * heavy > F.col("total")).filter("trigger is not null").select(F.col("trigger").alias("heavy"))


def sweep(found: DataFrame) -> DataFrame:
    """doc, mark, at, trigger of places in order: removed ones (trigger null), and first places that meet other phrases."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trigger_, phrase_, doc_, at_ = None, None, 0, 0  # the first place of the phrase that is open
        waiting: tuple | None = None  # first place of a trigger that has had one phrase only

        for batch in batches:
            if not batch.num_rows:
                continue
            trigger, phrase, doc, mark, at = (batch.column(c) for c in PLACES.names)
            seen = trigger.is_null().to_numpy(zero_copy_only=False)
            spread = batch.column("spread").to_numpy(zero_copy_only=False) != 0
            trigger = trigger.fill_null(0).to_numpy()
            phrase, doc, mark, at = (x.to_numpy() for x in (phrase, doc, mark, at))
            n = len(at)
            new_t, new_p = np.ones(n, bool), np.ones(n, bool)
            new_t[1:] = (trigger[1:] != trigger[:-1]) | seen[:-1]
            new_p[1:] = new_t[1:] | (phrase[1:] != phrase[:-1])
            new_t[0] = seen[0] or trigger_ != trigger[0]
            new_p[0] = new_t[0] or phrase_ != phrase[0]
            first = np.maximum.accumulate(np.where(new_p, np.arange(n), -1))
            lead_doc, lead_at = np.where(first < 0, doc_, doc[first]), np.where(first < 0, at_, at[first])
            gone = seen | ~new_p & ((doc > lead_doc) | (at >> 8 > lead_at >> 8))
            # distinct phrases per trigger; the first one may go on from the batch before
            group = np.cumsum(new_t)
            phrases = np.bincount(group, weights=new_p & ~seen, minlength=group[-1] + 1)
            goes_on = not new_t[0]
            if goes_on:
                phrases[0] += 1 if waiting is not None else 2
            many = (phrases > 1)[group]
            tied = ~new_p & ~gone
            is_open = ~gone & (many | spread | tied)
            rows = [(doc[k], mark[k], at[k], trigger[k]) for k in (is_open, gone)]
            null = [np.zeros(int(is_open.sum()), bool), np.ones(int(gone.sum()), bool)]
            columns = [np.concatenate(c) for c in zip(*rows)]
            early = []
            if goes_on and waiting is not None and phrases[0] > 1:
                early, waiting = [waiting], None
            if not goes_on:
                waiting = None
            if group[-1] > 0 and phrases[-1] == 1:  # the last trigger may go on
                k = int(np.flatnonzero(new_t)[-1])
                waiting = None if spread[k] or seen[k] else (doc[k], mark[k], at[k], trigger[k])
            elif group[-1] > 0:
                waiting = None
            trigger_, phrase_, doc_, at_ = (None if seen[-1] else trigger[-1]), phrase[-1], lead_doc[-1], lead_at[-1]
            if early:
                columns = [np.append(c, e) for c, e in zip(columns, early[0])]
                null.append(np.zeros(1, bool))
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c) for c in columns[:3]), pa.array(columns[3], mask=np.concatenate(null))], ["doc", "mark", "at", "trigger"])

    return found.mapInArrow(run, "doc bigint, mark bigint, at bigint, trigger bigint")


STRETCHES = pa.schema([("trigger", pa.int64()), ("body", pa.binary()), ("high", pa.int64()), ("low", pa.int64()), ("doc", pa.int64()), ("mark", pa.int64()), ("at", pa.int64())])


def stretches(keyed: DataFrame, wanted: DataFrame, length: int = LENGTH) -> DataFrame:
    """The bytes of phrases to be compared, or, for crowded triggers, hashes of their strings.

    Rows: phrases (trigger, body), strings (high, low: the hash) and strings that came earlier in
    the slice (neither). ``wanted`` has doc, mark and phrases (at, trigger, crowded).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = xxhash.xxh3_128_digest
        for batch in slices(batches, "text", TEXT_AT_ONCE):
            texts, doc, mark = bytes_of(batch.column("text")), batch.column("doc").to_numpy(), batch.column("mark").to_numpy()
            lists = batch.column("phrases")
            flat, row = lists.flatten(), np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            at, trigger, crowded = (flat.field(k).to_numpy(zero_copy_only=False) for k in range(3))
            phrases = np.flatnonzero(~crowded)
            start, count = at >> 8, at & 255
            bodies = [texts[r][i:i + c + length - 1] for r, i, c in zip(row[phrases].tolist(), start[phrases].tolist(), count[phrases].tolist())]
            none = pa.nulls(len(phrases), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(trigger[phrases]), pa.array(bodies, pa.binary()), none, none, pa.array(doc[row[phrases]]), pa.array(mark[row[phrases]]), pa.array(at[phrases])], schema=STRETCHES)
            some = np.flatnonzero(crowded)
            if not len(some):
                continue
            owner = np.repeat(row[some], count[some])
            begin = np.repeat(start[some] - np.cumsum(count[some]) + count[some], count[some]) + np.arange(count[some].sum())
            key = np.frombuffer(b"".join(hashed(texts[r][i:i + length]) for r, i in zip(owner.tolist(), begin.tolist())), np.int64).reshape(-1, 2)
            again = _later([key[:, 0], key[:, 1]], doc[owner], begin)
            n = len(owner)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()), pa.array(key[:, 0], mask=again), pa.array(key[:, 1], mask=again), pa.array(doc[owner]), pa.array(mark[owner]), pa.array(begin << 8 | 1)],
                schema=STRETCHES)

    same = (keyed["doc"] == wanted["doc_"]) & (keyed["mark"] == wanted["mark_"])
    joined = keyed.join(wanted, same).dropDuplicates(["doc", "mark"]).select("doc", "mark", "text", "phrases")
    return joined.mapInArrow(run, "trigger bigint, body binary, high bigint, low bigint, doc bigint, mark bigint, at bigint")


def repeated(bodies: list[bytes], doc: np.ndarray, start: np.ndarray, count: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Strings of some phrases that came earlier: phrase, first string, number of strings in a row.

    The suffix array of the phrases, to the depth of a string; equal strings are neighbours in
    it, and the first of them in the order of the parse stays.
    """
    owner = np.repeat(np.arange(len(bodies)), count)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    offsets = np.cumsum([len(b) for b in bodies]) - [len(b) for b in bodies]
    laid = np.frombuffer(b"".join(bodies), np.uint8)
    strings = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(laid, length)[offsets[owner] + inside]).view(f"S{length}")[:, 0]
    order = np.argsort(strings, kind="stable")
    ranked = strings[order]
    new = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    _, place = np.unique(np.rec.fromarrays([doc[owner], start[owner] + inside]), return_inverse=True)
    first = np.repeat(np.minimum.reduceat(place[order], new), np.diff(np.append(new, len(order))))
    gone = np.empty(len(order), bool)
    gone[order] = place[order] > first
    at = np.flatnonzero(gone)
    runs = np.flatnonzero(np.concatenate([[True], (np.diff(at) != 1) | (owner[at[1:]] != owner[at[:-1]])])) if len(at) else at
    return owner[at[runs]], inside[at[runs]], np.diff(np.append(runs, len(at)))


def compare(found: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc, mark, at of repeated strings, from phrases in the order of their triggers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(table: pa.Table) -> pa.RecordBatch:
            doc, mark, at = (table.column(c).to_numpy() for c in ("doc", "mark", "at"))
            phrase, inside, count = repeated(table.column("body").to_pylist(), doc, at >> 8, at & 255, length)
            return pa.RecordBatch.from_pydict({"doc": doc[phrase], "mark": mark[phrase], "at": (at[phrase] >> 8) + inside << 8 | count})

        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            if sum(b.num_rows for b in held) < BLOCK_ROWS:
                continue
            whole = pa.Table.from_batches(held)
            last = whole.column("trigger")[-1].as_py()
            cut = int(np.searchsorted(whole.column("trigger").to_numpy(), last))
            for i, j in _blocks(whole.column("trigger").to_numpy()[:cut]):
                yield done(whole.slice(i, j - i))
            held = whole.slice(cut).combine_chunks().to_batches()
        if held:
            yield done(pa.Table.from_batches(held))

    return found.mapInArrow(run, "doc bigint, mark bigint, at bigint")


def _blocks(trigger: np.ndarray) -> Iterator[tuple[int, int]]:
    """Whole triggers, about ``BLOCK_ROWS`` rows together."""
    edges = [*np.flatnonzero(np.concatenate([[True], trigger[1:] != trigger[:-1]])).tolist(), len(trigger)] if len(trigger) else [0]
    i = 0
    for j in edges[1:]:
        if j - i >= BLOCK_ROWS or j == len(trigger):
            yield i, j
            i = j


def removed(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, heavy: int = HEAVY, crowded: int = CROWDED) -> DataFrame:
    """doc, mark, at: strings that came earlier (first string * 256 + strings in a row)."""
    if not gram <= length <= gram + 254:
        raise ValueError("a phrase has 1 to 255 strings")
    keyed = _keyed(docs)
    spread = F.broadcast(heavy_triggers(keyed, length, gram, heavy))
    found = places(keyed, length, gram)
    found = found.join(spread, found["trigger"] == spread["heavy"], "left")
    salt = F.when(F.col("trigger").isNull(), F.xxhash64("doc", "at")).when(F.col("heavy").isNotNull(), F.col("phrase")).otherwise(0)
    found = found.select(*PLACES.names, F.when(F.col("heavy").isNotNull(), 1).otherwise(0).alias("spread"), salt.alias("salt"))
    ordered = found.repartition("trigger", "salt").sortWithinPartitions("trigger", "phrase", "doc", "at").drop("salt")
    swept = settle(sweep(ordered), "swept")
    met = swept.filter("trigger is not null")
    many = met.groupBy("trigger").agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > crowded).select("trigger", F.lit(True).alias("crowded"))
    listed = met.join(many, "trigger", "left").groupBy("doc", "mark").agg(
        F.collect_set(F.struct("at", "trigger", F.coalesce("crowded", F.lit(False)).alias("crowded"))).alias("phrases"))
    wanted = listed.select(F.col("doc").alias("doc_"), F.col("mark").alias("mark_"), "phrases")
    taken = settle(stretches(keyed, wanted, length), "stretches")
    phrases = taken.filter("trigger is not null").select("trigger", "body", "doc", "mark", "at")
    compared = compare(phrases.repartition("trigger").sortWithinPartitions("trigger", "doc", "at"), length)
    strings = taken.filter("high is not null")
    place = F.struct("doc", "at")
    firsts = strings.groupBy("high", "low").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    apart = strings.join(firsts, ["high", "low"]).filter(place > F.col("first")).select("doc", "mark", "at")
    inside = taken.filter("trigger is null and high is null").select("doc", "mark", "at")
    return swept.filter("trigger is null").select("doc", "mark", "at").unionByName(compared).unionByName(apart).unionByName(inside)


def without_repeats(docs: DataFrame, length: int = LENGTH, **parameters) -> DataFrame:
    """One row per document: doc_id, n_bytes, spans (start and end of every removed run), kept (the other bytes)."""
    gone = removed(docs, length, **parameters).groupBy("doc", "mark").agg(F.collect_set("at").alias("gone"))
    gone = gone.select(F.col("doc").alias("doc_"), F.col("mark").alias("mark_"), "gone")
    keyed = _keyed(docs.select("doc_id", "text")).drop("text")
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("doc", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(SMALLEST))).withColumn("mark", F.xxhash64("text"))
    joined = rows.join(gone, (rows["doc"] == gone["doc_"]) & (rows["mark"] == gone["mark_"]), "left").select("doc_id", "text", "gone")
    schema = docs.select("doc_id", F.lit(0).cast("bigint").alias("n_bytes"), F.lit(None).cast("array<struct<start:bigint,end:bigint>>").alias("spans"), F.lit(b"").alias("kept")).schema
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", TEXT_AT_ONCE):
            texts, spans, kept = bytes_of(batch.column("text")), [], []
            for text, at in zip(texts, batch.column("gone").to_pylist()):
                runs: list[list[int]] = []
                for one in sorted(at or ()):
                    start, end = one >> 8, (one >> 8) + (one & 255) + length - 1
                    if runs and start <= runs[-1][1]:
                        runs[-1][1] = max(end, runs[-1][1])
                    else:
                        runs.append([start, end])
                edges = [0, *(e for r in runs for e in r), len(text)]
                kept.append(b"".join(text[i:j] for i, j in zip(edges[::2], edges[1::2])))
                spans.append([{"start": i, "end": j} for i, j in runs])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()), pa.array(spans, span), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "spans", "kept"])

    return joined.mapInArrow(run, schema)
