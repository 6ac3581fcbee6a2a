"""Near-duplicates by an LSH forest over MinHash signatures, with every link confirmed on full shingle sets.

1. A document becomes the set of its hashed word shingles and a signature of TREES * DEPTH minimum hashes. Documents
   of equal sets are one class from here on, stood for by the smallest identifier.
2. The forest: every tree orders all classes by its own DEPTH hashes. In an order, the rows with the longest common
   prefix stand next to each other, so a row's NEIGHBOURS predecessors are its candidates: in a sparse region of an
   order they reach down to a prefix of a single hash. Rows that agree in REGION hashes are a region, and all of its
   rows are candidates of each other: in the order as far as WINDOW rows back, and of longer regions in a second pass,
   by blocks, those of different clusters (see 3). Orders are range-partitioned by whole paths, so that a dense region
   spreads over tasks; rows at the cuts meet in the second pass too.
3. Candidates whose signatures agree enough (LOOSE) chain up to clusters. A cluster is more than a component: two
   documents can be in it that no order has brought together, and most of its pairs may be no links.
4. Links: clusters are dealt to blocks of BLOCK classes, and each block's sets are intersected exactly. A few classes
   of a cluster are in all of its blocks. Clusters of more than a block are then dealt anew: each component found so
   far that fills a block gets blocks of its own, small ones share, and blocks meet each other, except those of one
   component. So a group of copies costs little more than its size, and a document that is close
   to a single one of thousands is still compared with all of them.
5. Components of the confirmed links.

Defined results: a null or blank text has the empty set, links with nothing and stays. A text of fewer words than a
shingle has one shingle, all of its words. Rows with a null identifier have no component, link with nothing and stay.
Rows of equal identifier are one document: its texts are linked (an empty one stays alone). Other columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bpe import chunks
from tidemark.llm.common import Scratch, skew_join, small_batches, written
from tidemark.llm.components import components, forest
from tidemark.llm.words import hold, release, words_of

TREES = 16
DEPTH = 8
#: Rows before a row, in each order, that are its candidates from a prefix of one hash on.
NEIGHBOURS = 4
#: Hashes that the rows of a region share. A pair at 0.8 shares them in none of the trees with a probability of 1e-5.
REGION = 3
#: Rows before a row that are its candidates within a region; longer regions get a second pass.
WINDOW = 64
#: Rows of a region's block in that pass.
REGION_ROWS = 2048
#: Estimated similarity of a candidate that joins a cluster, as far below the threshold as 4 standard errors and more.
LOOSE_BELOW = 0.17
#: Classes of a block.
BLOCK = 64
#: Classes of a cluster that all of its blocks hold, on average.
PIVOTS = 8
#: Bytes of text made into sets at a time.
CHUNK_BYTES = 1_000_000

_HASHES = TREES * DEPTH
_rng = np.random.default_rng(20)
_ODD = _rng.integers(0, 2**31, _HASHES, np.uint32) * np.uint32(2) + np.uint32(1)
_XOR = _rng.integers(0, 2**32, _HASHES, np.uint32)
_M = np.uint64(0x9E3779B97F4A7C15)

_SIGNED = "doc_id long, n_shingles long, key binary, sig binary"
_SETS = "doc_id long, key binary, shingles binary"


def shingle_sets(texts: pa.Array, words: int) -> list[np.ndarray]:
    """Of every text the sorted distinct hashes of its shingles, 64 bits each."""
    codes, starts, distinct = words_of(pc.ascii_lower(texts))
    each = np.array([xxhash.xxh3_64_intdigest(w) for w in distinct.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()], np.uint64)[codes]
    long = np.zeros(len(each), np.uint64)  # at the place of its first word, each shingle of so many words
    if len(each) >= words:
        long = _folded([each[k : len(each) - words + 1 + k] for k in range(words)])
    out = []
    for start, end in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
        if end - start >= words:
            out.append(_distinct(long[start : end - words + 1]))
        else:
            out.append(_folded([each[k : k + 1] for k in range(start, end)]) if end > start else each[:0])
    return out


def _folded(parts: list[np.ndarray]) -> np.ndarray:
    """Hashes of rows of hashes, in their order."""
    h = np.full(len(parts[0]), np.uint64(len(parts)))
    for part in parts:
        h = (h ^ part) * _M
        h ^= h >> np.uint64(29)
    return h


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    new = np.ones(len(values), bool)
    np.not_equal(values[1:], values[:-1], out=new[1:])
    return values[new]


def shingle_hashes(text: str, words: int) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles."""
    return shingle_sets(pa.array([text], pa.string()), words)[0]


def signature(shingles: np.ndarray) -> np.ndarray:
    """Minimum of each hash function over the shingles."""
    out = np.full(_HASHES, 2**32 - 1, np.uint32)
    for k in range(0, len(shingles), 4096):
        x = (shingles[k : k + 4096] >> np.uint64(32)).astype(np.uint32)[:, None]
        for i in range(0, _HASHES, 32):
            out[i : i + 32] = np.minimum(out[i : i + 32], ((x ^ _XOR[i : i + 32]) * _ODD[i : i + 32]).min(axis=0))
    return out


def _pack(shingles: np.ndarray) -> bytes:
    return shingles.astype("<u8").tobytes()


def _unpack(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<u8")


def features(docs: DataFrame, words: int, id_col: str, text_col: str, sets: bool = False) -> DataFrame:
    """Number of shingles, a key of the set, and the signature of every row; or, with sets, the key and the set itself."""

    def run(batches):
        hold()  # what another operator keeps
        for batch in batches:
            for part in chunks(batch, most=CHUNK_BYTES):
                found = shingle_sets(part["text"], words)
                packed = [_pack(s) for s in found]
                keys = pa.array([hashlib.blake2b(p, digest_size=16).digest() for p in packed], pa.binary())
                if sets:
                    yield pa.RecordBatch.from_arrays([part["doc_id"], keys, pa.array(packed, pa.binary())], ["doc_id", "key", "shingles"])
                else:
                    sigs = pa.array([signature(s).astype(">u4").tobytes() for s in found], pa.binary())
                    yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array([len(s) for s in found], pa.int64()), keys, sigs], ["doc_id", "n_shingles", "key", "sig"])
            release()

    rows = small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(run, _SETS if sets else _SIGNED)


# -- the forest ------------------------------------------------------------------------------------------------------

_ENTRY = "tree int, path binary, doc_id long, n_shingles long, small binary"
_FOUND = "a long, b long, cut long, tail boolean, tree int, path binary, n_shingles long, small binary"
_FOUND_SCHEMA = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("cut", pa.int64()), ("tail", pa.bool_()), ("tree", pa.int32()), ("path", pa.binary()), ("n_shingles", pa.int64()), ("small", pa.binary())])


def entries(classes: DataFrame) -> DataFrame:
    """A row per tree and class: the tree's path, and a small signature of 4 bits per hash."""

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            sig = np.frombuffer(b"".join(batch["sig"].to_pylist()), ">u4").reshape(n, _HASHES).astype(np.uint32)
            bits = (sig & 15).astype(np.uint8)
            small = [x.tobytes() for x in bits[:, ::2] << 4 | bits[:, 1::2]]
            for tree in range(TREES):
                paths = [x.tobytes() for x in np.ascontiguousarray(sig[:, tree * DEPTH : (tree + 1) * DEPTH].astype(">u4"))]
                yield pa.RecordBatch.from_arrays([pa.array([tree] * n, pa.int32()), pa.array(paths, pa.binary()), batch["doc_id"], batch["n_shingles"], pa.array(small, pa.binary())], ["tree", "path", "doc_id", "n_shingles", "small"])

    return classes.mapInArrow(run, _ENTRY)


def _runs(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The paths of ordered rows as numbers, and each row's region, counted from 0."""
    n = rows.num_rows
    paths = np.frombuffer(b"".join(rows["path"].to_pylist()), ">u4").reshape(n, -1)
    tree = rows["tree"].to_numpy()
    new = (tree[1:] != tree[:-1]) | (paths[1:, :REGION] != paths[:-1, :REGION]).any(axis=1)
    return paths, np.concatenate([np.zeros(min(n, 1), np.int64), np.cumsum(new)])


def _close(x: np.ndarray, y: np.ndarray, percent: int) -> np.ndarray:
    """Which of these small signatures, row by row, look similar."""
    differ = x ^ y
    same = ((differ & 15) == 0).sum(axis=1) + ((differ >> 4) == 0).sum(axis=1)
    return (same / _HASHES - 1 / 16) * 16 / 15 >= percent / 100 - LOOSE_BELOW


def _neighbour_pairs(rows: pa.Table, first: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Candidates among ordered rows: each row from `first` on with its predecessors."""
    n = rows.num_rows
    tree, ids, size = (rows[c].to_numpy() for c in ("tree", "doc_id", "n_shingles"))
    paths, run = _runs(rows)
    root = paths[:, 0]
    small = np.frombuffer(b"".join(rows["small"].to_pylist()), np.uint8).reshape(n, _HASHES // 2)
    a, b, rest = [], [], np.arange(first, n)
    for back in range(1, WINDOW + 1):
        i = rest = rest[rest >= back]
        if back > NEIGHBOURS:
            i = rest = rest[run[rest] == run[rest - back]]
        if not len(rest):
            break
        j = i - back
        # a common prefix of one hash at least, and sizes that allow the similarity
        ok = (tree[i] == tree[j]) & (root[i] == root[j]) & (ids[i] != ids[j])
        ok &= 100 * np.minimum(size[i], size[j]) >= percent * np.maximum(size[i], size[j])
        i, j = i[ok], j[ok]
        close = _close(small[i], small[j], percent)
        a.append(np.maximum(ids[i[close]], ids[j[close]]))
        b.append(np.minimum(ids[i[close]], ids[j[close]]))
    return (np.concatenate(a), np.concatenate(b)) if a else (ids[:0], ids[:0])


def _found(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    n = len(a)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), *(pa.nulls(n, f.type) for f in list(_FOUND_SCHEMA)[2:])], schema=_FOUND_SCHEMA)


def _cut_rows(rows: pa.Table, cut: int | None, tail: bool) -> pa.RecordBatch:
    """Rows for the pass over cuts, or, without a cut, for that over regions."""
    n = rows.num_rows
    column = lambda c: rows[c].combine_chunks() if isinstance(rows[c], pa.ChunkedArray) else rows[c]
    return pa.RecordBatch.from_arrays([column("doc_id"), pa.nulls(n, pa.int64()), pa.array([cut] * n, pa.int64()), pa.array([tail] * n, pa.bool_()), column("tree"), column("path"), column("n_shingles"), column("small")], schema=_FOUND_SCHEMA)


class _Regions:
    """Rows of the regions of an order that the window doesn't cover, or that a partition's ends may cut."""

    def __init__(self):
        self.held, self.sent, self.started = None, None, False

    def add(self, rows: pa.Table) -> pa.Table:
        """The rows to send of those so far; the last region is held until it ends or is long."""
        rows = rows if self.held is None else pa.concat_tables([self.held, rows])
        if not rows.num_rows:
            return rows
        _, run = _runs(rows)
        keys = [(t, p[: 4 * REGION]) for t, p in zip(rows["tree"].take([0, rows.num_rows - 1]).to_pylist(), rows["path"].take([0, rows.num_rows - 1]).to_pylist(), strict=True)]
        send = np.bincount(run) > WINDOW + 1
        send[0] |= not self.started or keys[0] == self.sent
        whole = len(send) > 1 or keys[0] == self.sent or send[-1] and np.sum(run == run[-1]) > WINDOW + 1
        if not whole:  # the partition's first region, which is still short
            self.held = rows
            return rows.slice(0, 0)
        self.started = True
        last = len(send) - 1
        self.sent = keys[1] if send[last] else None
        self.held = None if send[last] else rows.filter(pa.array(run == last))
        return rows.filter(pa.array(send[run]))

    def end(self) -> pa.Table | None:
        return self.held


def candidate_pairs(classes: DataFrame, percent: int, tmp: Scratch) -> tuple[DataFrame, DataFrame]:
    """(a, b), a > b, that join classes that are neighbours in some order and look similar; and the rows of long or cut regions."""

    def run(batches):
        part, held, regions = TaskContext.get().partitionId(), None, _Regions()
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            if held is None:
                yield _cut_rows(rows.slice(0, NEIGHBOURS), part, False)
                joined, first = rows, 0
            else:
                joined, first = pa.concat_tables([held, rows]), held.num_rows
            yield _found(*forest(*_neighbour_pairs(joined, first, percent)))
            held = joined.slice(max(0, joined.num_rows - WINDOW))
            yield _cut_rows(regions.add(rows), None, False)
        if held is not None:
            yield _cut_rows(held.slice(max(0, held.num_rows - NEIGHBOURS)), part + 1, True)
        if regions.end() is not None:
            yield _cut_rows(regions.end(), None, False)

    def across(table: pa.Table) -> pa.Table:
        order = table.sort_by([("tail", "descending"), ("tree", "ascending"), ("path", "ascending"), ("a", "ascending")])
        first = int(np.sum(order["tail"].to_numpy()))
        a, b = _neighbour_pairs(order.rename_columns(["doc_id", *order.column_names[1:]]), first, percent)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    ordered = entries(classes).repartitionByRange("tree", "path", "doc_id").sortWithinPartitions("tree", "path", "doc_id")
    found = tmp.written(ordered.mapInArrow(run, _FOUND), "forest")
    inside = found.filter(F.col("b").isNotNull()).select("a", "b")
    cuts = found.filter(F.col("cut").isNotNull()).groupBy("cut").applyInArrow(across, "a long, b long")
    regions = found.filter(F.col("b").isNull() & F.col("cut").isNull())
    return inside.unionByName(cuts), regions.select("tree", F.expr(f"substring(path, 1, {4 * REGION})").alias("path"), F.col("a").alias("doc_id"), "n_shingles", "small")


def _region_block(table: pa.Table, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Candidates of different clusters among the rows of a region, or of two of its blocks."""
    table = table.sort_by("n_shingles")
    ids, size, cluster = (table[c].to_numpy() for c in ("doc_id", "n_shingles", "cluster"))
    part = table["part"].to_numpy()
    crossing = len(np.unique(part)) > 1
    small = np.frombuffer(b"".join(table["small"].to_pylist()), np.uint8).reshape(len(ids), _HASHES // 2)
    end = np.searchsorted(percent * size, 100 * size, "right")
    a, b = [], []
    for i in range(len(ids)):
        j = np.arange(i + 1, end[i])
        j = j[(cluster[j] != cluster[i]) & (not crossing or part[j] != part[i])]
        j = j[_close(small[j], small[i], percent)]
        a.append(ids[j])
        b.append(np.full(len(j), ids[i]))
    return forest(np.concatenate(a), np.concatenate(b))


def region_pairs(rows: DataFrame, cluster: DataFrame, percent: int) -> DataFrame:
    """(a, b), a > b, that join classes of different clusters so far that share a region and look similar; rows is a written table."""

    def run(table: pa.Table) -> pa.Table:
        a, b = _region_block(table, percent)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    region = ["tree", "path"]
    rows = rows.join(cluster, F.col("doc_id") == F.col("node"), "left").select(*rows.columns, F.coalesce("label", "doc_id").alias("cluster"))
    sizes = rows.groupBy(*region).agg(F.count("*").alias("rows"), F.min("cluster").alias("low"), F.max("cluster").alias("high"))
    sizes = sizes.filter("low != high").select(*region, "rows")
    rows = skew_join(rows, sizes, region, "rows", rows.count()).withColumn("parts", F.ceil(F.col("rows") / REGION_ROWS))
    rows = rows.withColumn("part", F.pmod(F.xxhash64(F.lit("region"), "doc_id"), "parts").cast("long"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    rows = rows.select(*region, F.least("part", "other").alias("p"), F.greatest("part", "other").alias("q"), "part", "doc_id", "n_shingles", "small", "cluster")
    return rows.groupBy(*region, "p", "q").applyInArrow(run, "a long, b long")


# -- links -----------------------------------------------------------------------------------------------------------


def links(ids: np.ndarray, sets: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of positions whose sets have 100 * intersection >= percent * union, by exact counts."""
    n = len(sets)
    size = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(n), size)
    flat = np.concatenate(sets) if n else np.zeros(0, np.uint64)
    _, column, counts = np.unique(flat, return_inverse=True, return_counts=True)
    shared = counts[column] > 1  # what only one set has is in no intersection
    owner, column = owner[shared], np.unique(column[shared], return_inverse=True)[1]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    both = np.zeros((n, n), np.float32)
    width = 4096
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        lo, hi = np.searchsorted(column, [start, start + width])
        dense = np.zeros((n, width), np.float32)
        dense[owner[lo:hi], column[lo:hi] - start] = 1
        both += dense @ dense.T
    both = both.astype(np.int64)
    union = size[:, None] + size[None, :] - both
    i, j = np.nonzero(np.triu((100 * both >= percent * union) & (both > 0), 1))
    return i, j


def _linked(dealt: DataFrame, keys: list[str], percent: int) -> DataFrame:
    """Confirmed links within each group of rows (doc_id, shingles), as edges to the smallest identifier linked."""

    def run(table: pa.Table) -> pa.Table:
        ids = table["doc_id"].to_numpy()
        i, j = links(ids, [_unpack(x) for x in table["shingles"].to_pylist()], percent)
        a, b = forest(ids[i], ids[j]) if len(i) else (ids[:0], ids[:0])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return dealt.groupBy(*keys).applyInArrow(run, "a long, b long")


def _dealt(sets: DataFrame, parts: Column) -> Column:
    """A block number by hash, for groups that hold `parts` rows."""
    return F.pmod(F.xxhash64("doc_id"), F.ceil(parts / BLOCK)).cast("long")


def near_links(sets_of: Callable[[DataFrame], DataFrame], classes: DataFrame, percent: int, keep: Scratch) -> DataFrame:
    """(node, label): components of confirmed links between classes, written in `keep`; sets_of gives the sets of the rows with some identifiers."""
    with Scratch(classes.sparkSession) as tmp:
        return _near_links(sets_of, classes, percent, tmp, keep)


def _near_links(sets_of: Callable[[DataFrame], DataFrame], classes: DataFrame, percent: int, tmp: Scratch, keep: Scratch) -> DataFrame:
    with Scratch(classes.sparkSession) as forest_tables:
        near, regions = candidate_pairs(classes, percent, forest_tables)
        cluster = components(near, "clusters", tmp)
        more = forest_tables.written(region_pairs(regions, cluster, percent), "regions")
        if not more.isEmpty():
            cluster = components(cluster.select(F.col("node").alias("a"), F.col("label").alias("b")).unionByName(more), "clusters", tmp)
    members = cluster.select(F.col("node").alias("doc_id"), F.col("label").alias("cluster")).unionByName(cluster.select(F.col("label").alias("doc_id"), F.col("label").alias("cluster")).distinct())
    sizes = members.groupBy("cluster").agg(F.count("*").alias("size"))
    members = tmp.written(skew_join(members, sizes, ["cluster"], "size", members.count()), "members")
    keyed = members.join(classes.select("doc_id", "key"), "doc_id")
    sets = sets_of(members.select("doc_id")).join(keyed, ["doc_id", "key"]).dropDuplicates(["doc_id", "key"]).select("doc_id", "cluster", "size", "shingles")
    sets = tmp.written(sets.withColumn("block", _dealt(sets, F.col("size"))), "cluster-sets")
    # blocks of a cluster; some of its classes, PIVOTS on average, are in all of them, so that blocks of one component find out
    blocks = F.ceil(F.col("size") / BLOCK)
    pivot = (blocks > 1) & (F.pmod(F.xxhash64(F.lit("pivot"), "doc_id"), F.ceil(F.col("size") / PIVOTS)) == 0)
    others = F.filter(F.sequence(F.lit(0).cast("long"), blocks - 1), lambda b: b != F.col("block"))
    copies = sets.filter(pivot).select("doc_id", "cluster", "shingles", F.explode(others).alias("block"))
    first = tmp.written(_linked(sets.select("doc_id", "cluster", "shingles", "block").unionByName(copies), ["cluster", "block"], percent), "links")
    large = sets.filter(F.col("size") > BLOCK)
    if large.isEmpty():
        return components(first, keep=keep)
    # what is left in clusters of several blocks: classes of different components that have met in no block
    label = components(first, "labels", tmp)
    large = large.select("doc_id", "cluster", "size", "shingles").join(label, F.col("doc_id") == F.col("node"), "left")
    large = large.select("doc_id", "cluster", "size", "shingles", F.coalesce("label", "doc_id").alias("label"))
    of_label = large.groupBy("cluster", "label").agg(F.count("*").alias("own"))
    of_label = tmp.written(of_label, "label-sizes")
    # a component that fills blocks has blocks of its own, and no pair within it is looked at again; the small ones share
    pooled = of_label.filter(F.col("own") < BLOCK).groupBy("cluster").agg(F.sum("own").alias("pool"))
    of_label = of_label.join(pooled, "cluster", "left").select("label", F.when(F.col("own") >= BLOCK, F.col("label")).otherwise(-1).alias("group"), F.when(F.col("own") >= BLOCK, F.col("own")).otherwise(F.col("pool")).alias("parts"), "own")
    large = skew_join(large, of_label, ["label"], "own", sets.count())
    large = tmp.written(large.select("doc_id", "cluster", "shingles", "group", _dealt(large, F.col("parts")).alias("block")), "large-clusters")
    block = tmp.written(large.groupBy("cluster", "group", "block").agg(F.count("*").alias("rows")), "blocks")
    one = block.select("cluster", F.col("group").alias("g"), F.col("block").alias("p"))
    two = block.select("cluster", F.col("group").alias("h"), F.col("block").alias("q"))
    # a row for each BLOCK classes on both sides; of a component's own blocks no two meet
    pairs = one.join(two, "cluster").filter((F.struct("g", "p") <= F.struct("h", "q")) & ((F.col("g") != F.col("h")) | (F.col("g") == -1)))
    pairs = tmp.written(pairs, "block-pairs")
    same = (F.col("g") == F.col("h")) & (F.col("p") == F.col("q"))
    sides = pairs.select("*", F.col("g").alias("group"), F.col("p").alias("block")).unionByName(pairs.filter(~same).select("*", F.col("h").alias("group"), F.col("q").alias("block")))
    tiles = large.join(sides, ["cluster", "group", "block"])
    second = _linked(tiles.select("cluster", "g", "p", "h", "q", "doc_id", "shingles"), ["cluster", "g", "p", "h", "q"], percent)
    return components(first.unionByName(second), keep=keep)


def near_dedup(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's doc_id, n_shingles, component_id (the smallest doc_id that links reach) and kept (it is that one).

    The result is a written table; all else that is written on the way is deleted.
    """
    with Scratch(docs.sparkSession) as tmp:
        return written(_near_dedup(docs, words, percent, id_col, text_col, tmp), "near-dedup")


def _near_dedup(docs: DataFrame, words: int, percent: int, id_col: str, text_col: str, tmp: Scratch) -> DataFrame:
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = tmp.written(features(texts, words, "doc_id", "text"), "signatures")
    rows = found.select("doc_id", "n_shingles", "key").filter(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    groups = tmp.written(rows.groupBy("key").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")), "classes")
    named = groups.select(F.col("first").alias("doc_id"), "key")
    classes = tmp.written(found.select("doc_id", "n_shingles", "key", "sig").join(named, ["doc_id", "key"]).dropDuplicates(["doc_id", "key"]), "class-signatures")
    # sets are made again for the rows in clusters alone: less than keeping those of all rows
    label = near_links(lambda ids: features(texts.join(ids, "doc_id", "left_semi"), words, "doc_id", "text", sets=True), classes, percent, tmp)
    # rows that share an identifier but not the text are one document: their classes are linked
    repeated = rows.groupBy("doc_id").agg(F.min("key").alias("one"), F.max("key").alias("two")).filter("one != two")
    if not repeated.isEmpty():
        several = rows.join(repeated.select("doc_id"), "doc_id", "left_semi").select("doc_id", "key").distinct()
        several = several.join(groups, "key").select("doc_id", "first")
        least = several.groupBy("doc_id").agg(F.min("first").alias("b"))
        same = several.join(least, "doc_id").select(F.col("first").alias("a"), "b")
        edges = label.select(F.col("node").alias("a"), F.col("label").alias("b")).unionByName(same)
        label = components(edges, keep=tmp)
    component = groups.join(label, F.col("first") == F.col("node"), "left").select("key", "n", F.coalesce("label", "first").alias("component_id"))
    linked = skew_join(found.select("doc_id", "n_shingles", "key").filter(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)), component, ["key"], "n", rows.count())
    alone = found.filter(F.col("doc_id").isNull() | (F.col("n_shingles") == 0)).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    out = linked.select("doc_id", "n_shingles", F.least("component_id", "doc_id").alias("component_id")).unionByName(alone)
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
