"""N-gram Jaccard self-join by a grouped prefix join, and the components of its links.

1. Each document becomes the set of its distinct 5-word shingles (ASCII lower case), as 64-bit hashes.
2. A census (census.py) classes every shingle by its document frequency.  Ordered by (class, hash), rare ones first, a
   document of n shingles can only reach similarity t with one that shares a shingle of its prefix, the first
   n - ceil(t n) + 1.  Shingles seen once lead to nobody: a document whose prefix has only such is done.
3. Equal sets are one node.  Nodes with the same prefix and size are one group; groups meet in an inverted index over
   the shared prefix shingles, pass the size and position filters, and are expanded to member pairs, whose exact
   similarity is computed from the whole texts.  The groups of a frequent shingle meet in blocks, where member pairs also pass parity bitmaps.
4. So that a group of thousands of near copies is not compared with itself pair by pair, a first round links each node
   to one node of each of its minimum-hash neighbourhoods, the one whose shingles are the most frequent, as those of the
   text are from which the others were copied; the inverted index then only pairs groups of different
   components, which is all that components can still depend on.  No link between components is lost.

A text is sent once for each pair in which it is compared with a more central one, which is sent once to each chunk of its pairs.
Ids must be numbers, or texts of numbers.  Fully equal rows share a bucket of the census.

Defined results: null or empty texts, or texts without words, have an empty set and link with nothing; fewer words
than a shingle are one shingle; equal texts, repeated rows included, share a component; a null id takes part but never
is a component's name unless all ids of the component are null; an empty table gives an empty table; other columns are
ignored, whatever their names, and a result column of the id column's name gets a trailing underscore.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import census
from .common import materialize, release, scratch, text_volume, with_id
from .components import components
from .words import Words, mix, rolled, signed


@dataclass(frozen=True)
class Settings:
    shingle: int = 5
    percent: int = 80
    bucket_bytes: int = 4 << 20
    shard_keys: int = 500_000
    least_parts: int = 64
    key_bytes: int = 3
    neighbourhoods: int = 4
    hot: int = 64
    block: int = 1024
    chunk: int = 512
    members: int = 32
    bitmap_words: int = 16


def shingle_sets(texts: pa.Array, k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words = Words(texts, lower=True)
    hashes = words.hashes()
    run = rolled(hashes, k) if len(hashes) >= k else hashes[:0]
    out = []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if b - a >= k:
            out.append(np.unique(run[a : b - k + 1]))
        else:
            out.append(rolled(hashes[a:b], b - a) if b > a else hashes[:0])
    return out


def parity_bitmap(shingles: np.ndarray, words: int) -> bytes:
    """Each bit is the parity of the shingles that hash to it: sets that differ in d shingles differ in at most d bits."""
    bits = np.bincount((mix(shingles + np.uint64(99)) % np.uint64(64 * words)).astype(np.int64), minlength=64 * words) & 1
    return np.packbits(bits.astype(np.uint8)).tobytes()


def least_overlap(n, percent: int):
    """The smallest intersection with which a set of n can reach the similarity."""
    return -(-n * percent // 100)


def _distinct(sets: list[np.ndarray], keys: census.Keys) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(keys.codes(np.concatenate([*sets, np.zeros(0, np.uint64)])), return_counts=True)


def _identity(s: np.ndarray) -> bytes:
    """128 bits that depend on the set alone."""
    one, two = mix(s + np.uint64(0x5851F42D4C957F2D)), mix(s ^ np.uint64(0x14057B7EF767814F))
    return np.array([one.sum(dtype=np.uint64), two.sum(dtype=np.uint64) + np.uint64(len(s))], np.uint64).tobytes()


NODES = "id long, n_shingles long, node binary, text string, n int, grp binary, tokens array<long>, places array<int>, near array<long>, bits binary, known double"


def _surveyed(docs: DataFrame, s: Settings) -> DataFrame:
    """Per document its set's identity; for the first of each set in a bucket that may have links also text and prefix."""
    volume = text_volume(docs, "text")
    buckets, parts = census.sizes(volume, s.bucket_bytes, s.shard_keys, s.least_parts)
    keys = census.Keys(parts(volume // 6), s.key_bytes)
    dealt = docs.select("id", "text", census.bucket_of(buckets, "id", "text").alias("bucket"))

    def first(table: pa.Table) -> pa.Table:
        codes, counts = _distinct(shingle_sets(table.column("text"), s.shingle), keys)
        out = census.blobs(table.column("bucket")[0].as_py(), codes, counts, keys)
        release()
        return out

    def second(table: pa.Table, verdict: pa.Table) -> pa.Table:
        sets = shingle_sets(table.column("text"), s.shingle)
        codes, _ = _distinct(sets, keys)
        classes = census.classes(verdict, codes, keys)
        texts = table.column("text").combine_chunks()
        rows, seen = [], set()
        for i, got in enumerate(sets):
            n, node = len(got), _identity(got) if len(got) else None
            blank = (n, node, None, None, None, None, None, None, None, None)
            if not n or node in seen:
                rows.append(blank)
                continue
            seen.add(node)
            held = classes[np.searchsorted(codes, keys.codes(got))]
            reach = n - least_overlap(n, s.percent) + 1
            if np.count_nonzero(held == 0) >= reach:
                rows.append(blank)
                continue
            order = np.lexsort((got, held))[:reach]
            prefix, shared = got[order], held[order] > 0
            group = _identity(np.append(prefix, np.uint64(n)))
            common = got[held > 0]
            near = [int(signed(common[mix(common + np.uint64(7919 * j + 1)).argmin()][None])[0]) for j in range(s.neighbourhoods)]
            rows.append((n, node, texts[i].as_py(), n, group, signed(prefix[shared]).tolist(), np.flatnonzero(shared).tolist(), near, parity_bitmap(got, s.bitmap_words), float(held.mean())))
        cols = list(zip(*rows))
        kinds = (pa.int64(), pa.binary(), pa.string(), pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.binary(), pa.float64())
        names = ("n_shingles", "node", "text", "n", "grp", "tokens", "places", "near", "bits", "known")
        release()
        return pa.table({"id": table.column("id")} | {name: pa.array(c, kind) for name, c, kind in zip(names, cols, kinds)})

    told = census.verdicts(dealt.groupBy("bucket").applyInArrow(first, census.BLOBS), keys)

    return dealt.groupBy("bucket").cogroup(told.groupBy("bucket")).applyInArrow(second, NODES)


def _linked(pairs: DataFrame, nodes: DataFrame, s: Settings) -> DataFrame:
    """Those of the distinct pairs (hub, node) whose whole texts have the similarity, as (a, b), a < b.

    A hub's pairs are cut into chunks; a chunk's rows stand together in a task, the hub's own text first, and stream through it.
    """
    texts = nodes.select("node", "text")
    many = pairs.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / s.chunk).cast("int").alias("chunks"))
    dealt = pairs.join(many, "hub").withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")).drop("chunks")
    ones = dealt.join(texts, "node").select("hub", "chunk", "node", "text")
    hubs = many.select("hub", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk")).join(texts.toDF("hub", "text"), "hub")
    rows = hubs.select("hub", "chunk", F.lit(None).cast("binary").alias("node"), "text").unionByName(ones)
    rows = rows.repartition("hub", "chunk").sortWithinPartitions("hub", "chunk", F.col("node").asc_nulls_first())

    def check(batches):
        centre = np.zeros(0, np.uint64)
        for batch in batches:
            for row in range(0, batch.num_rows, 256):
                part = batch.slice(row, 256)
                ok = []
                for mine, own in zip(shingle_sets(part.column(3), s.shingle), part.column(2).is_null().to_pylist()):
                    if own:
                        centre = mine
                        ok.append(False)
                        continue
                    same = len(np.intersect1d(mine, centre, assume_unique=True))
                    ok.append(100 * same >= s.percent * (len(mine) + len(centre) - same) and same > 0)
                yield part.select([0, 2]).filter(pa.array(ok, pa.bool_()))

    return rows.mapInArrow(check, "hub binary, node binary").select(F.least("hub", "node").alias("a"), F.greatest("hub", "node").alias("b"))


def _rest(nodes: DataFrame, comp: DataFrame, s: Settings) -> DataFrame:
    """Pairs of nodes in different components that share a prefix shingle and pass the filters."""
    labelled = nodes.select("node", "n", "grp", "tokens", "places", "bits").join(comp, "node", "left").withColumn("comp", F.coalesce("root", "node"))
    labelled = materialize(labelled.drop("root"), "labelled")
    entries = lambda df, *c: df.select(*c, F.explode(F.arrays_zip("tokens", "places")).alias("e")).select(*c, F.col("e.tokens").alias("token"), F.col("e.places").alias("place"))
    counts = entries(labelled, "comp").groupBy("token", "comp").agg(F.count(F.lit(1)).alias("c"))
    sizes = counts.groupBy("token").agg(F.count(F.lit(1)).alias("comps"), F.sum("c").alias("held"), F.max("c").alias("most"), F.max_by("comp", F.struct("c", "comp")).alias("main")).where("comps > 1")
    sizes = materialize(sizes.select("token", "held", (F.col("held") - F.col("most")).alias("strangers"), "main"), "meeting")
    return _cold(labelled, entries, sizes.where(F.col("held") <= s.hot), s).unionByName(_hot(labelled, entries, sizes.where(F.col("held") > s.hot), s)).distinct()


def _cold(labelled: DataFrame, entries, sizes: DataFrame, s: Settings) -> DataFrame:
    """Group pairs from the inverted index, expanded to members; a shingle has at most ``hot`` nodes, so a row meets at most that many."""
    groups = labelled.groupBy("grp", "comp").agg(F.first("n").alias("n"), F.first("tokens").alias("tokens"), F.first("places").alias("places"))
    meeting = entries(groups, "grp", "comp", "n").join(sizes.select("token", "main"), "token")
    left = meeting.where("comp <> main").select("token", *[F.col(c).alias(f"l_{c}") for c in ("grp", "comp", "n", "place")])
    room = F.least(F.col("n") - F.col("place"), F.col("l_n") - F.col("l_place"))  # shingles that both still can share
    enough = room * F.lit(100 + s.percent) >= F.lit(s.percent) * (F.col("n") + F.col("l_n"))
    met = (
        left.join(meeting, "token")
        .where((F.col("comp") != F.col("l_comp")) & (100 * F.least("n", "l_n") >= s.percent * F.greatest("n", "l_n")) & enough)
        .select("l_grp", "l_comp", "grp", "comp")
        .distinct()
    )
    members = labelled.select("grp", "comp", "node")
    pairs = met.join(members.toDF("l_grp", "l_comp", "a0"), ["l_grp", "l_comp"]).join(members.toDF("grp", "comp", "b0"), ["grp", "comp"])
    return pairs.select(F.least("a0", "b0").alias("a"), F.greatest("a0", "b0").alias("b"))


def size_band(n: str, percent: int) -> Column:
    """The band of a set's size: two sets whose sizes allow a similarity of ``percent`` lie in one band or in neighbours."""
    return F.floor(F.log(F.col(n).cast("double")) / math.log(100.01 / percent)).cast("int")


def _hot(labelled: DataFrame, entries, sizes: DataFrame, s: Settings) -> DataFrame:
    """The groups of a frequent shingle in blocks.  Only what lies outside the shingle's largest component need be compared, with all: blocks of
    such strangers meet blocks in a task, which returns the member pairs that sizes, places and bitmaps leave.  Blocks hold sets of about one size (``size_band``), and only
    those of a band and its neighbours meet, since sets further apart cannot be that similar.  A group is cut into parts by its number of nodes."""
    held = F.struct("node", "bits")
    large = labelled.groupBy("grp", "comp").count().where(F.col("count") > s.members * s.block).select("grp", "comp", F.ceil(F.col("count") / s.block).alias("parts"))
    large = materialize(large, "large")  # empty as a rule, and then nothing is shuffled to meet it
    parted = labelled.join(large, ["grp", "comp"], "left").withColumn("part", F.pmod(F.xxhash64("node"), F.coalesce("parts", F.lit(s.members).cast("long"))))
    groups = parted.groupBy("grp", "comp", "part").agg(F.first("n").alias("n"), F.first("tokens").alias("tokens"), F.first("places").alias("places"), F.collect_list(held).alias("members"))
    banded = entries(labelled, "comp", "n").join(sizes.select("token", "main").hint("merge"), "token").withColumn("band", size_band("n", s.percent))
    banded = banded.groupBy("token", "main", "band").agg(F.ceil(F.count(F.lit(1)) / s.block).cast("int").alias("blocks"), F.ceil(F.count_if(F.col("comp") != F.col("main")) / s.block).cast("int").alias("others"))
    counted = banded.groupBy("token", "main").agg(F.map_from_entries(F.collect_list(F.struct("band", F.struct("blocks", "others")))).alias("bands"))  # as many as bands
    rows = entries(groups, "grp", "part", "comp", "n", "members").join(counted.hint("merge"), "token").withColumn("band", size_band("n", s.percent))  # by the same plan at every size
    own = lambda count: F.pmod(F.xxhash64("grp", "part"), F.col("bands")[F.col("band")][count]).cast("int")

    def near(count: str) -> Column:
        """(band, block) of all blocks of the row's band and its neighbours."""
        blocks = lambda band: F.coalesce(F.try_element_at("bands", band)[count], F.lit(0))
        listed = lambda band: F.transform(F.filter(F.sequence(F.lit(0), F.greatest(blocks(band) - 1, F.lit(0))), lambda i: i < blocks(band)), lambda i: F.struct(band.alias("band"), i.alias("block")))
        return F.explode(F.concat(*[listed(F.col("band") + d) for d in (-1, 0, 1)]))

    columns = ["token", "x", "y", "stranger", "comp", "n", "place", "members"]
    one = rows.withColumns({"x": F.struct("band", own("blocks").alias("block")), "stranger": F.lit(False)}).withColumn("y", near("others")).select(*columns)
    two = rows.where("comp <> main").withColumns({"y": F.struct("band", own("others").alias("block")), "stranger": F.lit(True)}).withColumn("x", near("blocks")).select(*columns)

    def meet(table: pa.Table) -> pa.Table:
        stranger = table.column("stranger").to_numpy(zero_copy_only=False)
        n, place = table.column("n").to_numpy().astype(np.int64), table.column("place").to_numpy().astype(np.int64)
        comp = table.column("comp").combine_chunks().dictionary_encode().indices.to_numpy()
        lists = table.column("members").combine_chunks()
        first, flat = lists.offsets.to_numpy(), lists.values
        node, bits = flat.field("node"), np.frombuffer(b"".join(flat.field("bits").to_pylist()), np.uint64).reshape(len(flat), -1)
        first, count = first - first[0], np.diff(first)
        found_a, found_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        left, right = np.flatnonzero(stranger), np.flatnonzero(~stranger)
        for at in range(0, len(left), 64):
            i, j = left[at : at + 64, None], right[None, :]
            room = np.minimum(n[i] - place[i], n[j] - place[j])
            ok = (comp[i] != comp[j]) & (100 * np.minimum(n[i], n[j]) >= s.percent * np.maximum(n[i], n[j])) & (room * (100 + s.percent) >= s.percent * (n[i] + n[j]))
            g, h = np.nonzero(ok)
            g, h = i[g, 0], j[0, h]
            each = count[g] * count[h]  # members of both groups
            pair = np.repeat(np.arange(len(g)), each)
            k = np.arange(len(pair)) - np.repeat(np.cumsum(each) - each, each)
            a, b = first[g[pair]] + k // count[h[pair]], first[h[pair]] + k % count[h[pair]]
            sizes = n[g[pair]] + n[h[pair]]
            apart = np.bitwise_count(bits[a] ^ bits[b]).sum(axis=1, dtype=np.int64)
            most = (sizes - apart) // 2  # shared shingles at best
            good = most * (100 + s.percent) >= s.percent * sizes
            found_a.append(a[good])
            found_b.append(b[good])
        return pa.table({"p": node.take(pa.array(np.concatenate(found_a))), "q": node.take(pa.array(np.concatenate(found_b)))})

    return one.unionByName(two).groupBy("token", "x", "y").applyInArrow(meet, "p binary, q binary").select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b"))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()) -> DataFrame:
    """Per document n_shingles and component_id, the least id reachable by links (itself included)."""
    s = settings
    with scratch(docs.sparkSession) as keep:
        rows = materialize(_surveyed(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")), s), "survey")
        held = F.struct("text", "n", "grp", "tokens", "places", "near", "bits", "known")
        nodes = rows.where("n is not null").groupBy("node").agg(F.min_by(held, F.struct(F.length("text"), F.xxhash64("text"))).alias("h")).select("node", "h.*")
        nodes = materialize(nodes, "nodes")
        near = nodes.select("node", "known", F.explode(F.array_distinct("near")).alias("key"))
        heads = near.groupBy("key").agg(F.max_by("node", F.struct("known", "node")).alias("hub"))
        pairs = near.join(heads, "key").where("node <> hub").select("hub", "node").distinct()
        links = materialize(_linked(pairs, nodes, s), "links")
        comp = components(links, "first")
        met = materialize(_rest(nodes, comp, s).toDF("hub", "node"), "pairs")
        more = _linked(met, nodes, s)
        at = lambda c: comp.select(F.col("node").alias(c), F.col("root").alias(f"r{c}"))
        bridges = more.join(at("a"), "a", "left").join(at("b"), "b", "left").select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))
        above = components(bridges, "final").toDF("root", "top")  # of the components' roots
        named = rows.where("node is not null").groupBy("node").agg(F.min("id").alias("least"))
        roots = named.join(comp, "node", "left").withColumn("root", F.coalesce("root", "node")).join(above, "root", "left").withColumn("root", F.coalesce("top", "root")).drop("top")
        names = roots.groupBy("root").agg(F.min("least").alias("component_id"))
        by_node = materialize(roots.select("node", "root").join(names, "root").select("node", "component_id"), "names")
        keep(rows, by_node)
    out = rows.select("id", "n_shingles", "node").join(by_node, "node", "left")
    return with_id(out.select(F.col("id").alias("__id"), "n_shingles", F.coalesce("component_id", "id").alias("component_id")), id_col)
