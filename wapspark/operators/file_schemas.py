"""Schema drift over a table's files.

A table that many writers append to holds files of several schemas, and a read
fails or loses columns only when it meets them. ``file_schemas`` reads the
footers in tasks, dealt over the cluster by file, nested fields included;
``file_schema_drift`` merges them and gives a row for each path that isn't the
same in all files:

* ``missing``: files that have the path's parent don't have the path;
* ``widened``: the types are widenings of one another; the widest holds all;
* ``conflict``: no type holds all values of the others.

Schemas are merged by partial aggregates: each task hands on one row for each of
its distinct (path, type), however many files it read, so no path's rows grow
with the files. The driver sees no footer.

Defined results: where a path is missing its children are not reported, too, as
a file without the parent doesn't count for them; a repeated column name of a
file counts once; nullability is recorded, not compared (as in O5); an empty
file of no rows counts as a file; files whose schemas agree give no rows.
"""

from __future__ import annotations

import io
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "file string, n_rows long, path string, parent string, type string, nullable boolean"
FILES_PER_TASK = 256
ROOT = ""

# Types from narrow to wide (fixed values: the names of the columnar format).
WIDENING = [["int8", "int16", "int32", "int64"], ["float", "double"],
            ["int8", "int16", "int32", "double"], ["date32[day]", "timestamp[us]"],
            ["string", "large_string"], ["binary", "large_binary"]]
NESTED = ["struct", "list", "map"]
DECIMAL = r"^decimal128\((\d+), (\d+)\)$"
MAX_DIGITS = 38


def _quoted(name: str) -> str:
    return name if re.fullmatch(r"\w+", name) else "`" + name.replace("`", "``") + "`"


def _walk(field: pa.Field, parent: str, name: str | None = None) -> Iterator[tuple]:
    """(path, parent, type, nullable) of a field and all within it."""
    path = (f"{parent}." if parent else "") + (name or _quoted(field.name))
    kind = field.type
    if pa.types.is_struct(kind):
        yield path, parent, "struct", field.nullable
        for i in range(kind.num_fields):
            yield from _walk(kind.field(i), path)
    elif pa.types.is_map(kind):
        yield path, parent, "map", field.nullable
        yield from _walk(kind.key_field, path, "key")
        yield from _walk(kind.item_field, path, "value")
    elif pa.types.is_list(kind) or pa.types.is_large_list(kind):
        yield path, parent, "list", field.nullable
        yield from _walk(kind.value_field, path, "element")
    else:
        yield path, parent, str(kind), field.nullable


def _source(path: str, content: bytes | None):
    if content is not None:
        return io.BytesIO(content), None
    store, name = pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
    return name, store


def file_schemas(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    """One row per file and path of its schema, and one for the file itself
    (path and parent empty, type ``struct``).

    Tasks open the footers by themselves. For a store that only Spark reads,
    ``whole_files`` passes the files' bytes through Spark (each below 2 GB)."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "*.parquet").load(path))
    files = files.select("path", *(["content"] if whole_files else []))

    def footers(batches):
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                source, store = _source(r["path"], r.get("content"))
                footer = pq.read_metadata(source, filesystem=store)
                n, seen = footer.num_rows, set()
                rows.append((r["path"], n, ROOT, None, "struct", False))
                for field in footer.schema.to_arrow_schema():
                    for at, parent, kind, nullable in _walk(field, ROOT):
                        if at not in seen:
                            seen.add(at)
                            rows.append((r["path"], n, at, parent, kind, nullable))
            names = ["file", "n_rows", "path", "parent", "type", "nullable"]
            kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(zip(*rows), kinds)], names=names)

    if not whole_files:
        # Names are small: a partition of the listing may hold many footers.
        tasks = max(spark.sparkContext.defaultParallelism, -(-files.count() // FILES_PER_TASK))
        files = files.repartition(tasks, "path")
    return files.mapInArrow(footers, SCHEMA)


def _widest(types: Column) -> Column:
    """The type among ``types`` (or a decimal) that holds all, or null."""
    out = F.when(F.size(types) == 1, types[0])
    for line in WIDENING:
        known = F.array(*map(F.lit, line))
        widest = F.array_max(F.transform(types, lambda t: F.array_position(known, t)))
        out = out.when(F.forall(types, lambda t: F.array_contains(known, t)),
                       F.element_at(known, widest.cast("int")))
    digits = [F.array_max(F.transform(types, f)) for f in (
        lambda t: (F.regexp_extract(t, DECIMAL, 1).cast("int")
                   - F.regexp_extract(t, DECIMAL, 2).cast("int")),
        lambda t: F.regexp_extract(t, DECIMAL, 2).cast("int"))]
    return out.when(F.forall(types, lambda t: t.rlike(DECIMAL)) & (digits[0] + digits[1] <= MAX_DIGITS),
                    F.format_string("decimal128(%d, %d)", digits[0] + digits[1], digits[1]))


def file_schema_drift(schemas: DataFrame) -> DataFrame:
    """Per changed path: ``change`` (missing, widened or conflict, joined by a
    plus where two hold), ``types`` (comma-joined, ordered), ``merged_type``
    (null in a conflict), and the files and rows with the path (``n_files``,
    ``n_rows``) and with its parent but without it (``lacking_files``,
    ``lacking_rows``)."""
    typed = schemas.groupBy("path", "parent", "type").agg(
        F.count(F.lit(1)).alias("files"), F.sum("n_rows").alias("rows"))
    merged = typed.groupBy("path", "parent").agg(
        F.array_sort(F.collect_set("type")).alias("types"),
        F.sum("files").alias("n_files"), F.sum("rows").alias("n_rows"))
    # A file may have a child only where its parent is nested.
    around = typed.filter(F.col("type").isin(NESTED)).groupBy(F.col("path").alias("parent")).agg(
        F.sum("files").alias("all_files"), F.sum("rows").alias("all_rows"))
    merged = merged.join(around, "parent").withColumns({
        "merged_type": _widest(F.col("types")),
        "lacking_files": F.col("all_files") - F.col("n_files"),
        "lacking_rows": F.col("all_rows") - F.col("n_rows")})
    change = F.concat_ws("+", F.when(F.col("lacking_files") > 0, "missing"),
                         F.when(F.col("merged_type").isNull(), "conflict").when(
                             F.size("types") > 1, "widened"))
    return merged.withColumn("change", change).filter("change <> ''").select(
        "path", "change", F.array_join("types", ",").alias("types"), "merged_type",
        "n_files", "n_rows", "lacking_files", "lacking_rows")
