"""Merkle manifest of a dataset, and proofs that climb it by a recursive query.

A document is a leaf: the SHA-256 of doc_id, source, lang, n_chars and text, each ``-`` if null,
else its length in UTF-8 bytes, a colon and the value. The leaves of a source ascend by doc_id;
every ``RUN`` neighbours are hashed into a node of the next level, until one node, the subroot,
is left. The subroots in order of their sources (null first, by UTF-8 bytes) are joined in the
same way into the root.

Built levels are stored as node rows that name their parent. A link spans ``LEVELS`` levels: the
row of a node holds, level by level, the siblings before and after its path, so a climb takes a
seventh of the steps. A recursive query then ascends from every leaf at once: it folds the
(possibly tampered) hash with the siblings of the row it stands on and goes on at the parent.
Siblings are appended to the proof in the same way; as those above a block are the same for all
its leaves, that query starts once per block, and a leaf puts its own siblings before them.

Leaves are numbered by a range sort: numbers inside a range, and one running sum over the sizes
of the ranges, so a source with a third of all rows is many ranges. A block of a tree is at most
``RUN ** LEVELS`` nodes. Nodes with more than ``1 / HOT`` of all leaves below them (at most
``HOT`` a stage, whatever the input) are broadcast; all others are met by a shuffle.

Null fields are ``-``; a null source is a source of its own, the first; a null doc_id comes first
in its source and counts as empty text where the checksum decides on tampering. Rows that share
a doc_id are in the order of their leaves; equal rows are leaves of their own. A column that the
table lacks is null; further columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import id_remainder, settle

RUN = 3
LEVELS = 7
HOT = 2_000
TOP = -1  # the tree over the subroots
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_hash(docs: DataFrame, **instead: Column) -> Column:
    """The hash of a row, some of its fields replaced."""
    def field(name: str) -> Column:
        value = instead.get(name, F.col(name) if name in docs.columns else F.lit(None)).cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*[field(n) for n in FIELDS]), 256)


def numbered(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` and their place in the order, ``index`` from 0, without one task that sees them all."""
    marked = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at_", F.monotonically_increasing_id())
    marked = settle(marked, "ordered")
    part, inside = F.shiftright("at_", 33), F.col("at_").bitwiseAND(F.lit((1 << 33) - 1))
    before = Window.orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    ranges = marked.groupBy(part.alias("part_")).agg(F.count(F.lit(1)).alias("rows_"))
    ranges = ranges.select("part_", F.coalesce(F.sum("rows_").over(before), F.lit(0)).alias("before_"))
    joined = marked.withColumn("part_", part).join(ranges, "part_")
    return joined.withColumn("index", F.col("before_") + inside).drop("part_", "before_", "at_")


def _block(run: int, levels: int):
    """A function that climbs ``levels`` levels of one block of a tree."""
    def climb(group: pa.Table) -> pa.Table:
        group = group.sort_by("pos").drop_columns("block")
        n, count, level, width = group.column("n")[0].as_py(), group.num_rows, group.column("digest").to_pylist(), 1
        before, after = [[] for _ in range(count)], [[] for _ in range(count)]
        for _ in range(sum(n > run ** k for k in range(levels))):
            for i in range(count):
                at = i // width
                start = at - at % run
                before[i].append("".join(level[start:at]))
                after[i].append("".join(level[at + 1:start + run]))
            level = [hashlib.sha256("".join(level[k:k + run]).encode()).hexdigest() for k in range(0, len(level), run)]
            width *= run
        for name, values in (("before", before), ("after", after)):
            group = group.append_column(name, pa.array(values, pa.list_(pa.string())))
        group = group.append_column("head", pa.array([level[0]] + [None] * (count - 1), pa.string()))
        return group.append_column("below", pa.array([sum(group.column("leaves").to_pylist())] * count, pa.int64()))

    return climb


def _name(tree: Column, stage: int, pos: Column) -> Column:
    return F.concat_ws("/", tree.cast("string"), F.lit(str(stage)), pos.cast("string"))


def grow(nodes: DataFrame, above: Column, run: int = RUN, levels: int = LEVELS) -> tuple[list[DataFrame], DataFrame]:
    """Node rows stage by stage, and the last node of each tree (tree, digest, leaves).

    ``nodes``: tree, pos, digest, n (nodes of the tree), leaves (below the node); further columns
    are carried by the first stage. A node row adds name, parent (``above`` where the tree ends),
    before and after (the siblings level by level).
    """
    stages, ends, width = [], [], run ** levels
    while True:
        block = F.floor(F.col("pos") / width)
        more = [F.lit(None).cast(t).alias(n) for n, t in (("before", "array<string>"), ("after", "array<string>"), ("head", "string"), ("below", "bigint"))]
        schema = nodes.select("*", *more).schema
        built = settle(nodes.withColumn("block", block).groupBy("tree", "block").applyInArrow(_block(run, levels), schema), "nodes")
        stage = len(stages)
        parent = F.when(F.col("n") > width, _name(F.col("tree"), stage + 1, block)).otherwise(above)
        stages.append(built.select(_name(F.col("tree"), stage, F.col("pos")).alias("name"), parent.alias("parent"), *nodes.columns, "before", "after"))
        heads = built.filter("head is not null").select(
            "tree", block.alias("pos"), F.col("head").alias("digest"), F.ceil(F.col("n") / width).alias("n"), F.col("below").alias("leaves"))
        ends.append(heads.filter("n = 1").drop("pos", "n"))
        nodes = heads.filter("n > 1")
        if nodes.isEmpty():
            return stages, reduce(DataFrame.unionByName, ends)


def _fold(start: str, before: str = "before", after: str = "after") -> str:
    return f"aggregate(zip_with({before}, {after}, (b, a) -> struct(b, a)), {start}, (h, s) -> sha2(concat(s.b, h, s.a), 256))"


PART = "unhex(array_join(zip_with(before, after, (b, a) -> concat(b, a)), ''))"


def climb(starts: DataFrame, lower: DataFrame, upper: DataFrame, proofs: bool) -> DataFrame:
    """name, folded, subroot (of the tree it leaves), proof (siblings as bytes) of every start, at the root.

    ``starts``: name, at (where it stands), folded. ``lower`` and ``upper`` hold the node rows;
    ``upper`` is bounded and broadcast, ``lower`` is None where nothing is left.
    """
    spark = starts.sparkSession
    here = {c: f"coalesce(u.{c}, l.{c})" if lower is not None else f"u.{c}" for c in ("name", "parent", "before", "after", "part", "subroot")}
    proof = f"concat(c.proof, {here['part']})" if proofs else "c.proof"
    query = f"""
    WITH RECURSIVE climb(name, at, folded, subroot, proof) AS (
      SELECT name, at, folded, CAST(NULL AS STRING), CAST('' AS BINARY) FROM {{starts}}
      UNION ALL
      SELECT /*+ BROADCAST(u) */ c.name, {here["parent"]}, {_fold("c.folded", here["before"], here["after"])}, coalesce(c.subroot, {here["subroot"]}), {proof}
      FROM climb c {"LEFT JOIN {lower} l ON c.at = l.name" if lower is not None else ""} LEFT JOIN {{upper}} u ON c.at = u.name
      WHERE {here["name"]} IS NOT NULL)
    SELECT name, folded, subroot, proof FROM climb WHERE at IS NULL"""
    limit = "spark.sql.cteRecursionRowLimit"  # by default a million rows over all steps
    before = spark.conf.get(limit, None)
    spark.conf.set(limit, "-1")
    try:
        return settle(spark.sql(query, starts=starts, upper=upper, **({"lower": lower} if lower is not None else {})), "climb")
    finally:
        spark.conf.unset(limit) if before is None else spark.conf.set(limit, before)


def manifest(docs: DataFrame, run: int = RUN, levels: int = LEVELS, hot: int = HOT) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified."""
    text = F.col("text").cast("string")
    moved = (id_remainder(F.col("doc_id"), 2) == 0) & F.contains(text, F.lit("\n"))
    rows = settle(docs.select(
        "doc_id", "source", leaf_hash(docs).alias("digest"),
        F.when(moved, leaf_hash(docs, text=F.replace(text, F.lit("\n")))).alias("tampered")), "leaves")
    rows = numbered(rows, "source", "doc_id", "digest")
    sources = numbered(rows.groupBy("source").agg(F.min("index").alias("start"), F.count(F.lit(1)).alias("n")), "start")
    sources = sources.select(F.col("source").alias("source_"), "start", "n", F.col("index").alias("tree"))
    placed = rows.join(sources, rows["source"].eqNullSafe(sources["source_"])).select(
        "tree", (F.col("index") - F.col("start")).alias("pos"), "digest", "n", F.lit(1).cast("bigint").alias("leaves"), "doc_id", "tampered")
    stages, subroots = grow(placed, _name(F.lit(TOP), 0, F.col("tree")), run, levels)
    top = F.lit(TOP).cast("bigint").alias("tree")
    top_stages, root = grow(subroots.select(top, F.col("tree").alias("pos"), "digest", F.lit(subroots.count()).cast("bigint").alias("n"), "leaves"), F.lit(None).cast("string"), run, levels)
    end = root.first()
    columns = ["name", "parent", "before", "after", "leaves", F.expr(PART).alias("part")]
    above = [s.select(*columns, F.lit(None).cast("string").alias("subroot")) for s in stages[1:] + top_stages[1:]]
    above = settle(reduce(DataFrame.unionByName, [top_stages[0].select(*columns, F.col("digest").alias("subroot")), *above]), "above")
    bound = max(1.0, (end.leaves if end else 0) / hot)  # so that a stage has at most ``hot`` nodes of this size
    lower, upper = above.filter(F.col("leaves") < bound), above.filter(F.col("leaves") >= bound)
    lower = None if lower.isEmpty() else lower
    folded = F.expr(_fold("coalesce(tampered, digest)"))
    leaves = climb(stages[0].select("name", F.col("parent").alias("at"), folded.alias("folded")), lower, upper, proofs=False)
    # all leaves of a block have the siblings above it in common
    blocks = climb(stages[0].groupBy(F.col("parent").alias("name")).agg(F.first("parent").alias("at"), F.lit("").alias("folded")), lower, upper, proofs=True)
    own = stages[0].select("name", F.col("parent").alias("block_"), "doc_id", "digest", F.expr(PART).alias("own"))
    joined = own.join(leaves.select("name", F.col("folded").alias("folded_root")), "name")
    joined = joined.join(blocks.select(F.col("name").alias("block_"), "subroot", "proof"), "block_")
    expected = F.lit(end and end.digest).cast("string")
    return joined.select(
        "doc_id", F.col("digest").alias("leaf"), "subroot", expected.alias("root"),
        F.sha2(F.lower(F.hex(F.concat("own", "proof"))).cast("binary"), 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == expected).alias("verified"))
