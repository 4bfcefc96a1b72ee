"""What the training-data operators share: whole-text scans, folds and tables in the cluster's shared folder."""

from __future__ import annotations

import ctypes
import math
from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..sources.scratch import discard, hadoop_path, materialize, new_path, scratch, shared_dir  # noqa: F401  the operators take them from here
from .words import slices

WORD = r"[^\x20\x09-\x0D]+"


def bounded_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Arrow batches of at most ``rows`` rows where the session has Spark's default of 10,000: rows here hold whole texts."""
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)


def release() -> None:
    """Gives a worker process's free memory back to the system: workers stay for later tasks, and their memory counts meanwhile."""
    pa.set_memory_pool(pa.system_memory_pool())
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # no glibc
        pass


def fold(id_col: str, k: int) -> Column:
    """crc32 of the id as text, modulo k; null ids take part as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % k


def kept_type(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def schema_of(df: DataFrame, carried: Iterable[str], fields: str) -> T.StructType:
    """Carried columns with their types, then the fields of a DDL text; a field of a carried column's name gets a trailing underscore."""
    carried, found = list(carried), T._parse_datatype_string(fields).fields
    named = [T.StructField(name, f.dataType) for name, f in zip(free_names([f.name for f in found], carried), found)]
    return T.StructType([T.StructField(c, kept_type(df, c)) for c in carried] + named)


def scan_texts(df: DataFrame, carried: list[str], text_col: str, fields: str, make: Callable[[], Callable[[pa.Array], list]], limit: int = 1 << 20) -> DataFrame:
    """One output row per input row: the carried columns and what ``make()(texts)`` returns as one array a field.

    ``make`` runs once in each task.  Texts come in pieces of about ``limit`` bytes, always whole.  A text column that is carried
    travels once.
    """
    out = schema_of(df, carried, fields)
    names = out.fieldNames()
    at = carried.index(text_col) if text_col in carried else len(carried)

    def run(batches):
        release()
        work = make()
        for batch in batches:
            texts = batch.column(at)
            for row, piece in slices(texts, limit):
                kept = [batch.column(i).slice(row, len(piece)) for i in range(len(carried))]
                yield pa.RecordBatch.from_arrays(kept + [x if isinstance(x, pa.Array) else pa.array(x) for x in work(piece)], names=names)
        release()

    extra = [] if text_col in carried else [F.col(text_col).cast("string").alias("__text")]
    return df.select(*[F.col(c) for c in carried], *extra).mapInArrow(run, out)


def free_names(names: Iterable[str], taken: Iterable[str]) -> list[str]:
    """The names, each with so many trailing underscores that it differs from all that are taken, in any case of letters."""
    taken = {x.lower() for x in taken}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def with_id(out: DataFrame, id_col: str, inner: str = "__id") -> DataFrame:
    """The frame with its id under the caller's name; another column of that name gets a trailing underscore."""
    others = [c for c in out.columns if c != inner]
    names = dict(zip(others, free_names(others, [id_col])))
    return out.select(*[F.col(c).alias(id_col if c == inner else names[c]) for c in out.columns])


def lookup(rows: DataFrame, table: DataFrame, on: list[str], share: int = 1000) -> DataFrame:
    """Rows of a written table joined with a table of one row a key, none of it null.  Keys with more than 1/``share`` of the rows, fewer than ``share`` of them, meet a
    broadcast table of as many rows, so no task gets such a group; the rest is shuffled."""
    heavy = materialize(rows.groupBy(*on).count().where(F.col("count") * share > F.lit(rows.count())).select(*on), "heavy")
    light = rows.join(F.broadcast(heavy), on, "left_anti").join(table, on)
    return light.unionByName(rows.join(F.broadcast(table.join(F.broadcast(heavy), on, "left_semi")), on))


def text_volume(df: DataFrame, text_col: str) -> int:
    """Bytes of all texts: one aggregate over the text column."""
    return df.agg(F.coalesce(F.sum(F.octet_length(F.col(text_col))), F.lit(0)).alias("n")).first()["n"]


def parts_for(volume: int, each: int, least: int) -> int:
    return max(least, math.ceil(volume / each))
