"""Typed scans of the event, item-property and category files."""

from __future__ import annotations

import csv
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas

# texts that usual CSV readers take for null
NULL_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def _scan(spark: SparkSession, paths: list[str], header: tuple, schema: T.StructType, required, tokens) -> DataFrame:
    """Files that share one header: columns by name, fields converted one by one."""
    missing = [c for c in required if c not in header]
    if missing:
        raise ValueError(f"columns {missing} are missing in {paths[0]}, which has {list(header)}")
    text = T.StructType([T.StructField(c, T.StringType()) for c in header])
    df = spark.read.schema(text).option("header", True).option("enforceSchema", True).csv(paths)
    out = []
    for field in schema.fields:
        if field.name not in header:
            out.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        raw = F.col(f"`{field.name}`")
        value = F.when(~F.trim(raw).isin(*tokens), raw)
        if isinstance(field.dataType, T.LongType):
            # plain integers keep all 19 digits; only the "12.0" spelling goes through double
            value = F.trim(value)
            value = F.coalesce(value.try_cast("bigint"), value.try_cast("double").try_cast("bigint"))
        elif not isinstance(field.dataType, T.StringType):
            value = F.trim(value).try_cast(field.dataType)
        out.append(value.alias(field.name))
    return df.select(*out)


def read_table(spark: SparkSession, paths, schema: T.StructType, fmt: str = "csv", required=None, null_tokens=NULL_TOKENS) -> DataFrame:
    """Scan one or many files with a declared schema; columns are found by their header names.

    Every file may have its own order of columns, also inside one folder: the files are grouped
    by their first lines, each group is one scan and the scans are united by name. Header names
    may be quoted and are trimmed. ``required`` columns (by default all) must be in every file
    that has a header, else a ValueError; files without any line hold no rows.

    Numeric fields may be written as ``12`` or ``12.0`` (files that went through a
    floating-point column), so a CSV is scanned as text and each field converted with
    ``try_cast``: an unreadable number becomes null instead of failing the job. Fields
    that equal a null token after trimming are null.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    if fmt != "csv":
        df = spark.read.schema(schema).format(fmt).load(paths)
        return df.toDF(*[c.strip() for c in df.columns])
    required = schema.fieldNames() if required is None else required
    groups = files_by_header(spark, paths)
    if len(groups) == 1:
        groups = {header: paths for header in groups}  # one kind of file: scan the paths as given
    out = None
    for header, files in groups.items():
        part = _scan(spark, files, header, schema, required, null_tokens)
        out = part if out is None else out.unionByName(part)
    return out


def files_by_header(spark: SparkSession, paths: list[str], at_once: int = 16) -> dict[tuple, list[str]]:
    """The files under some paths, grouped by the column names of their first lines.

    Like the listing of the files this is the driver's: it opens each file for one line, many at
    a time, in any store Spark reads from. Files without a line are left out; if none has one,
    all are one group without columns.
    """
    files = spark.read.text(paths).inputFiles()  # as URIs
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def header(file: str) -> tuple[str, tuple]:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
        stream = path.getFileSystem(conf).open(path)
        lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8"))
        try:
            line = lines.readLine()
        finally:
            lines.close()
        return path.toString(), () if line is None else tuple(n.strip().strip("\ufeff").strip('"') for n in next(csv.reader([line])))

    groups: dict[tuple, list[str]] = {}
    with ThreadPoolExecutor(at_once) as pool:
        for file, names in pool.map(header, files):
            groups.setdefault(names, []).append(file)
    if len(groups) > 1:
        groups.pop((), None)
    return groups or {(): paths}


def load_events(spark: SparkSession, full: str, sample: str | None = None, path: str | None = None, use_sample: bool = True) -> DataFrame:
    """Events from an explicit path, else the saved sample, else the full file."""
    target = path or (sample if use_sample and sample else full)
    return read_table(spark, target, schemas.EVENTS)


def load_item_properties(spark: SparkSession, parts) -> DataFrame:
    """All property parts as one scan."""
    return read_table(spark, parts, schemas.ITEM_PROPERTIES)


def load_category_tree(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, schemas.CATEGORY_TREE)
