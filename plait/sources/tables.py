"""Snapshot tables: scans, first-wins and latest-wins writes, patches and counts as plans over whole frames.

A snapshot is a new version of a table; ``publish`` writes it beside the old one and hands back a frame over the new files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F, types as T

from .scratch import materialize


def publish(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def publish_counted(df: DataFrame, path: str, **counters: Column) -> tuple[DataFrame, dict[str, int]]:
    """The published frame, and counters (aggregates over its rows) that are observed while it is written, so they cost no job of their own."""
    seen = Observation()
    out = publish(df.observe(seen, *[c.alias(name) for name, c in counters.items()]), path)
    return out, {name: value or 0 for name, value in seen.get.items()}


def latest(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The newest version of a table under a root: ``versions/NAME-STAMP`` or ``run-STAMP/NAME``, else ``NAME``.  A run counts once its last table, the feed, is written, so its
    tables are always those of one moment."""
    files = spark._jvm.org.apache.hadoop.fs.Path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    found = {}
    for pattern in (f"{root}/versions/{name}-*", f"{root}/run-*/{name}"):
        for status in files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(pattern)) or []:
            path = status.getPath().toString()
            found[path.rpartition(f"{name}-")[2] if "/versions/" in path else path.split("/run-")[-1].partition("/")[0]] = path
    whole = lambda path: files.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS"))
    done = {stamp: path for stamp, path in found.items() if whole(path) and ("/versions/" in path or whole(f"{path.rpartition('/')[0]}/feed"))}
    return spark.read.parquet(done[max(done)] if done else f"{root}/{name}")


def first_wins(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row a key: the first in the given order (dropDuplicates knows no order)."""
    ranked = df.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where("__n = 1").drop("__n")


def head_limit(df: DataFrame, keys: list[str], order: list[Column], most: Column | int) -> DataFrame:
    """The first ``most`` rows of each key."""
    limit = most if isinstance(most, Column) else F.lit(most)
    ranked = df.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("__n") <= limit).drop("__n")


def only_new(rows: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows whose key the other table lacks."""
    return rows.join(known.select(key).distinct(), key, "left_anti")


def having(rows: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """Rows whose key is among the wanted ones: what an IN list asks for."""
    return rows.join(wanted.select(key), key, "left_semi")


def insert_ignore(table: DataFrame, rows: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """The table with those new rows whose key it lacks, the first of each key."""
    return table.unionByName(only_new(first_wins(rows, [key], order), table, key))


def replaced(table: DataFrame, rows: DataFrame, keys: str | list[str]) -> DataFrame:
    """The table with the rows in place of theirs, columns of either side included."""
    keys = [keys] if isinstance(keys, str) else keys
    return table.join(rows.select(*keys), keys, "left_anti").unionByName(rows, allowMissingColumns=True)


def upsert(table: DataFrame, rows: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """The table with the rows put in place of theirs; of several new rows with one key the first in ``order`` counts."""
    rows = rows.select(*table.columns)
    return replaced(table, first_wins(rows, keys, order) if order else rows, keys)


def patch(table: DataFrame, delta: DataFrame, key: str, columns: list[str], flag: str = "__hit") -> DataFrame:
    """The table with ``columns`` taken from the delta's row of the same key, nulls included."""
    given = delta.select(key, *[F.col(c).alias(f"__{c}") for c in columns], F.lit(True).alias(flag))
    joined = table.join(given, key, "left")
    picked = [F.when(F.col(flag), F.col(f"__{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in table.columns]
    return joined.select(*picked)


def page_after(table: DataFrame, key: str, last, size: int) -> DataFrame:
    """One page of a keyset scan; a top-k, so nothing but ``size`` rows a task is sorted."""
    rows = table if last is None else table.where(F.col(key) > last)
    return rows.orderBy(key).limit(size)


def pages_of(table: DataFrame, key: str, size: int):
    """All rows in pages by key, one at a time on the driver: the next page begins after the last key, a page that is not full ends the scan."""
    last = None
    while True:
        rows = page_after(table, key, last, size).collect()
        if rows:
            yield rows
        if len(rows) < size:
            return
        last = rows[-1][key]


def paged(table: DataFrame, key: str, size: int) -> DataFrame:
    """Each row with the number of its page in a keyset scan: what ``pages_of`` hands out one page after the other, without a row on the driver.

    Rows are dealt into ranges of the key, whose counts tell where each range begins; within a range rows are numbered by a window.
    """
    order = F.col(key).asc_nulls_last()
    ranges = materialize(table.repartitionByRange(order).withColumn("__range", F.spark_partition_id()), "ranges")
    counts = ranges.groupBy("__range").agg(F.count(F.lit(1)).alias("__rows"))
    begins = counts.select("__range", (F.sum("__rows").over(Window.orderBy("__range")) - F.col("__rows")).alias("__first"))  # one row a range
    place = F.col("__first") + F.row_number().over(Window.partitionBy("__range").orderBy(order)) - 1
    return ranges.join(F.broadcast(begins), "__range").withColumn("page", F.floor(place / size).cast("long")).drop("__range", "__first")


def count_rows(table: DataFrame, test: Column | None = None) -> int:
    return (table if test is None else table.where(test)).count()


def scrub_nul(df: DataFrame) -> DataFrame:
    """Every string of every column, nested ones and map keys included, without U+0000."""

    def clean(c: Column, kind: T.DataType) -> Column:
        if isinstance(kind, T.StringType):
            return F.replace(c, F.lit("\0"), F.lit(""))
        if isinstance(kind, T.ArrayType) and _holds_text(kind):
            return F.transform(c, lambda x: clean(x, kind.elementType))
        if isinstance(kind, T.MapType) and _holds_text(kind):
            return F.map_from_entries(F.transform(F.map_entries(c), lambda e: F.struct(clean(e["key"], kind.keyType), clean(e["value"], kind.valueType))))
        if isinstance(kind, T.StructType) and _holds_text(kind):
            return F.when(c.isNotNull(), F.struct(*[clean(c[f.name], f.dataType).alias(f.name) for f in kind.fields]))
        return c

    return df.select(*[clean(F.col(f.name), f.dataType).alias(f.name) for f in df.schema.fields])


def _holds_text(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _holds_text(kind.elementType)
    if isinstance(kind, T.MapType):
        return _holds_text(kind.keyType) or _holds_text(kind.valueType)
    if isinstance(kind, T.StructType):
        return any(_holds_text(f.dataType) for f in kind.fields)
    return isinstance(kind, T.StringType)


def write_tsv(df: DataFrame, path: str, order: list[str]) -> None:
    """One tab-separated file with a header, sorted; for reports of bounded size."""
    df.orderBy(*order).coalesce(1).write.mode("overwrite").option("sep", "\t").option("header", True).csv(path)


def register_views(spark: SparkSession, root: str, names: list[str]) -> None:
    """Published tables as temporary views, for queries in SQL."""
    for name in names:
        spark.read.parquet(f"{root}/{name}").createOrReplaceTempView(name)


def read_parquet(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")
