"""Exact duplicates by a persistent index of digests, bucketed and sorted by digest.

A ``DigestIndex`` is a folder of segments.  A segment has one row for each digest that it was the first to bring, bucketed and sorted by digest, one file a
bucket.  ``add`` groups the digests of a batch (partial aggregates, so the copies of a text meet as one row a task), writes them in the index's buckets and holds them
against every segment by sort-merge joins, bucket by bucket, without exchange or sort.  What the anti-join leaves is new and appended as a segment with the document that
stays; of the others the segment only counts the copies.  A segment is written aside and renamed when it is whole, and a batch whose name the index knows is passed over, so a
lost executor costs its tasks and a lost driver the batch; one writer at a time.  ``compact`` merges all segments into one.

What stays: a text that an earlier batch brought stays with that batch's document; of equal texts in one batch the row with the largest id stays, null ids
last.  ``deduplicate`` therefore adds a table in parts of falling ids.

Texts are equal when identical after lower-casing A-Z; their SHA-256 stands for them.  Defined results: a null text is an empty one, and all empty texts are equal; of
rows with one id and equal texts one stays; a group of null ids only has a null keep_id and one row that stays; an empty table gives an empty table; very long texts are hashed whole, one
at a time; other columns are ignored, whatever their names; a result column whose name is the id column's gets a trailing underscore.
"""

from __future__ import annotations

import contextlib
import hashlib
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import free_names, hadoop_path, kept_type, lookup, materialize, scan_texts
from .words import text_bytes

#: Digests a bucket of the index: about 200 MB.
BUCKET_ROWS = 4_000_000
_ORDERED = "spark.sql.legacy.bucketedTableScan.outputOrdering"


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, digest, n): the distinct rows of a table by id and digest, and how often each stands."""

    def make():
        def run(texts: pa.Array) -> list:
            raw, at = text_bytes(texts)
            return [pa.array([hashlib.sha256(raw[a:b].tobytes().lower()).digest() for a, b in zip(at[:-1], at[1:])], pa.binary())]  # bytes.lower knows A-Z only

        return run

    rows = scan_texts(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")), ["id"], "text", "digest binary", make)
    return rows.groupBy("id", "digest").agg(F.count(F.lit(1)).alias("n"))


class DigestIndex:
    """The index in ``folder``, on a file system that all machines share; a new one if nothing is there."""

    def __init__(self, spark: SparkSession, folder: str, id_type: str = "bigint", buckets: int = 8):
        self.spark, self.folder, self.id_type = spark, folder.rstrip("/"), id_type
        self._tables: dict[str, DataFrame] = {}
        names = self._names()
        self.buckets = int(names[0].rsplit("-b", 1)[1]) if names else buckets

    def _names(self) -> list[str]:
        """Names of the finished segments, in order: segment-NUMBER-BATCH-bBUCKETS."""
        files, top = hadoop_path(self.spark, self.folder)
        return sorted(name for x in files.listStatus(top) if (name := x.getPath().getName()).startswith("segment-")) if files.exists(top) else []

    def _live(self) -> list[str]:
        names = self._names()
        merged = [i for i, name in enumerate(names) if name.split("-")[2] == "merged"]
        return names[merged[-1] :] if merged else names

    def batches(self) -> set[str]:
        return {name.split("-")[2] for name in self._names()} - {"merged"}

    def _table(self, path: str, fields: str) -> DataFrame:
        """A bucketed table that stands at a path, in the session's catalog."""
        if path not in self._tables:
            name = f"plait_{uuid.uuid4().hex}"
            self.spark.sql(f"CREATE TABLE {name} ({fields}) USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{path}'")
            self._tables[path] = self.spark.table(name)
        return self._tables[path]

    def first(self, name: str) -> DataFrame:
        return self._table(f"{self.folder}/{name}/first", f"digest binary, keep_id {self.id_type}, copies bigint")

    def again(self, name: str) -> DataFrame:
        return self._table(f"{self.folder}/{name}/again", "digest binary, copies bigint")

    def entries(self) -> DataFrame:
        """(digest, keep_id, copies) of every text of the index."""
        rows = [x for name in self._live() for x in (self.first(name), self.again(name).withColumn("keep_id", F.lit(None).cast(self.id_type)))]
        out = rows[0] if rows else self.spark.createDataFrame([], f"digest binary, keep_id {self.id_type}, copies bigint")
        for more in rows[1:]:
            out = out.unionByName(more)
        return out.groupBy("digest").agg(F.max("keep_id").alias("keep_id"), F.sum("copies").alias("copies"))

    def _write(self, rows: DataFrame, path: str) -> None:
        name = f"plait_{uuid.uuid4().hex}"
        rows.repartition(self.buckets, "digest").write.format("parquet").bucketBy(self.buckets, "digest").sortBy("digest").option("path", path).saveAsTable(name)
        self.spark.sql(f"DROP TABLE {name}")  # the files stay

    @contextlib.contextmanager
    def _segment(self, batch: str):
        """A folder to write in, which becomes the next segment if all goes well and goes if not."""
        at = int(self._names()[-1].split("-")[1]) + 1 if self._names() else 0
        files, aside = hadoop_path(self.spark, f"{self.folder}/pending-{uuid.uuid4().hex}")
        ordered = self.spark.conf.get(_ORDERED)
        self.spark.conf.set(_ORDERED, "true")  # one sorted file a bucket is read as sorted
        try:
            yield str(aside)
            if not files.rename(aside, hadoop_path(self.spark, f"{self.folder}/segment-{at:06d}-{batch}-b{self.buckets}")[1]):
                raise OSError(f"{aside} could not be renamed")
        finally:
            self.spark.conf.set(_ORDERED, ordered)
            files.delete(aside, True)

    def add(self, rows: DataFrame, batch: str) -> None:
        """Appends the new digests of (id, digest, n) rows, a batch of the given name (letters and digits)."""
        if not batch.isalnum() or batch == "merged":
            raise ValueError(f"a batch is named by letters and digits: {batch}")
        if batch in self.batches():
            return
        with self._segment(batch) as path:
            self._write(rows.groupBy("digest").agg(F.max("id").alias("keep_id"), F.sum("n").alias("copies")), f"{path}/incoming")
            incoming = self._table(f"{path}/incoming", f"digest binary, keep_id {self.id_type}, copies bigint")
            new, known = incoming, []
            for name in self._live():
                held = self.first(name).select("digest").hint("merge")
                new = new.join(held, "digest", "left_anti")
                known.append(incoming.join(held, "digest", "left_semi").select("digest", "copies"))
            again = known[0] if known else incoming.where("false").select("digest", "copies")
            for more in known[1:]:
                again = again.unionByName(more)
            self._write(new, f"{path}/first")
            self._write(again, f"{path}/again")
            files, done = hadoop_path(self.spark, f"{path}/incoming")
            files.delete(done, True)

    def compact(self) -> None:
        """All segments as one; the old ones keep their names and lose their rows."""
        old = self._live()
        if len(old) < 2:
            return
        with self._segment("merged") as path:
            self._write(self.entries(), f"{path}/first")
            self._write(self.again(old[0]).where("false"), f"{path}/again")
        for name in old:
            for part in ("first", "again"):
                files, gone = hadoop_path(self.spark, f"{self.folder}/{name}/{part}")
                files.delete(gone, True)

    def resolve(self, rows: DataFrame) -> DataFrame:
        """(id, keep_id, group_size, kept, digest) for each row that stands in (id, digest, n), a written table whose digests the index has."""
        found = lookup(rows, self.entries(), ["digest"])
        stays = F.col("id").eqNullSafe(F.col("keep_id"))
        each = found.withColumn("block", F.explode(F.expr("sequence(0, n - 1, 10000)"))).withColumn("at", F.explode(F.expr("sequence(block, least(block + 9999, n - 1))")))
        return each.select("id", "keep_id", F.col("copies").alias("group_size"), (stays & (F.col("at") == 0)).alias("kept"), "digest")


def deduplicate(docs: DataFrame, index: DigestIndex, batch: str = "all", parts: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the id, keep_id, group_size, kept, text_sha256.  The table is added in ``parts`` of falling ids, which are numbers, so that of equal texts
    that the index did not have the largest id stays."""
    rows = materialize(digests(docs, id_col, text_col), "digests")
    cuts = sorted(set(rows.approxQuantile("id", [i / parts for i in range(1, parts)], 0.01)), reverse=True) if parts > 1 else []
    rest = F.lit(True)
    for i, cut in enumerate(cuts):
        index.add(rows.where(rest & (F.col("id") > F.lit(cut))), f"{batch}{i}")
        rest = rest & F.coalesce(F.col("id") <= F.lit(cut), F.lit(True))
    index.add(rows.where(rest), f"{batch}{len(cuts)}")
    keep_id, size, kept, sha = free_names(("keep_id", "group_size", "kept", "text_sha256"), [id_col])
    out = index.resolve(rows)
    return out.select(F.col("id").alias(id_col), F.col("keep_id").alias(keep_id), F.col("group_size").alias(size), F.col("kept").alias(kept), F.lower(F.hex("digest")).alias(sha))


def index_for(docs: DataFrame, folder: str, id_col: str = "doc_id") -> DigestIndex:
    """An index in a folder with buckets for so many rows."""
    return DigestIndex(docs.sparkSession, folder, kept_type(docs, id_col).simpleString(), max(8, -(-docs.count() // BUCKET_ROWS)))
