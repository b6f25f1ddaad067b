"""Exact Jaccard join on word n-grams.

Documents become sorted arrays of shingle hashes; equal sets are one class from then on. A count sketch over all
documents says how common each shingle is, and every set is ordered from its rarest shingle to its commonest: two
similar sets share one of their first few shingles, whatever the order, so those are the keys by which they meet, and
what many documents have in common is hardly ever a key. The documents of a key, sorted by size into tiles, are compared by hashed
bitmaps: bits that only one of two has bound their overlap from above. Pairs that pass connect documents into families,
and inside a family's tiles such pairs are verified by exact intersection of the sorted arrays. Both steps leave out
pairs already known to be connected and return what connects a tile, so nothing is capped and no list of pairs is made.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.llm.common import few_rows_a_batch, materialise
from ledgerflow.llm.components import components, join_ids

_MIX1, _MIX2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_ODD = [np.uint64(pow(0x9E3779B97F4A7C15, k, 1 << 64) | 1) for k in range(1, 65)]
#: Counters of the sketch, as a power of two, and the counters that travel in one row.
SKETCH_BITS, BLOCK_BITS = 24, 18


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * _MIX1
    h = (h ^ (h >> np.uint64(33))) * _MIX2
    return h ^ (h >> np.uint64(33))


def shingle_set(text: str, n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's runs of n words; of all words if there are fewer.

    A-Z are lower-cased; words are what ASCII white space separates."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    w = pd.util.hash_array(np.array(words, dtype=object), categorize=len(words) > 5_000)
    size = min(n, len(words))
    with np.errstate(over="ignore"):
        total = np.full(len(words) - size + 1, size, np.uint64)
        for k in range(size):
            total += mixed(w[k : len(words) - size + 1 + k] * _ODD[k % 64] + np.uint64(k))
        return np.unique(mixed(total))


def counters(hashes: np.ndarray) -> np.ndarray:
    """The sketch's counter of each shingle."""
    return (hashes >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def prefix_keys(hashes: np.ndarray, percent: int, ranks: np.ndarray) -> np.ndarray:
    """The first shingles of a set in order of rank (one of 0...255 for each counter of the sketch), then hash.

    Sets with a Jaccard index of at least percent / 100 overlap in at least percent / 100 of either, so their first
    common shingle has at most 1 - percent / 100 of either before it: one of these keys is in both."""
    n = len(hashes)
    take = n - (percent * n + 99) // 100 + 1
    if not n or take >= n:
        return hashes
    place = ranks[counters(hashes)].astype(np.uint64) << np.uint64(56) | hashes >> np.uint64(8)
    return hashes[np.argpartition(place, take - 1)[:take]]


def packed_counts(at: np.ndarray, counts: np.ndarray) -> bytes:
    """The counters of a block that aren't 0: the steps from place to place and the values, byte by byte of a number."""
    numbers = np.concatenate((np.diff(at, prepend=0), counts)).astype("<u4")
    return zlib.compress(numbers.view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def unpacked(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    numbers = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(4, -1).T.copy().view("<u4").ravel().astype(np.int64)
    n = len(numbers) // 2
    return np.cumsum(numbers[:n]), numbers[n:]


class Sketch:
    """Counts of a task's shingles by counter: 64 MB, however many there are; a count beyond 2^32 - 1 stops there."""

    def __init__(self, most: int = 500_000):
        self.counts, self.fresh, self.held, self.most = np.zeros(1 << SKETCH_BITS, np.uint32), [], 0, most

    def add(self, hashes: np.ndarray) -> None:
        self.fresh.append(counters(hashes).astype(np.int32))
        self.held += len(hashes)
        if self.held > self.most:
            self.settle()

    def settle(self) -> None:
        if self.fresh:
            at, n = np.unique(np.concatenate(self.fresh), return_counts=True)
            self.counts[at] = np.minimum(self.counts[at] + n, (1 << 32) - 1)
            self.fresh, self.held = [], 0

    def blocks(self) -> Iterator[tuple[int, bytes]]:
        """Each block that has any, with its packed counters."""
        self.settle()
        for block, counts in enumerate(self.counts.reshape(-1, 1 << BLOCK_BITS)):
            at = np.flatnonzero(counts)
            if len(at):
                yield block, packed_counts(at, counts[at])


def packed_ranks(pieces: DataFrame) -> dict[int, bytes]:
    """A rank for each counter from the pieces (block, piece, counts) of all tasks: eight steps for each doubling.

    Pieces are summed up in a tree, 64 at a time, so what a task holds doesn't grow with the number of tasks. What comes
    to the driver, and goes on from there, is each block that has any, packed: at most one byte a counter, whatever the
    input. Only the tasks unpack it (unpacked_ranks)."""

    def total(table: pa.Table) -> np.ndarray:
        sums = np.zeros(1 << BLOCK_BITS, np.int64)
        for packed in table.column("counts"):
            at, counts = unpacked(packed.as_py())
            sums[at] += counts
        return sums

    def add_up(table: pa.Table) -> pa.Table:
        sums = np.minimum(total(table), (1 << 32) - 1)
        at = np.flatnonzero(sums)
        return pa.table({"block": table.column("block")[:1], "piece": table.column("piece")[:1], "counts": pa.array([packed_counts(at, sums[at])], pa.binary())})

    def rank(table: pa.Table) -> pa.Table:
        steps = np.minimum(255, 8 * np.log2(total(table) + 1.0)).astype(np.uint8)
        return pa.table({"block": table.column("block")[:1], "ranks": pa.array([zlib.compress(steps.tobytes(), 1)], pa.binary())})

    some = pieces
    for share in (64, 64**2, 64**3):  # as far as 16 million tasks
        some = some.groupBy("block", F.floor(F.col("piece") / share).alias("share")).applyInArrow(add_up, "block int, piece int, counts binary")
    return {row["block"]: bytes(row["ranks"]) for row in some.groupBy("block").applyInArrow(rank, "block int, ranks binary").collect()}


def unpacked_ranks(packed: dict[int, bytes]) -> np.ndarray:
    ranks = np.zeros(1 << SKETCH_BITS, np.uint8)
    for block, steps in packed.items():
        ranks[block << BLOCK_BITS : (block + 1) << BLOCK_BITS] = np.frombuffer(zlib.decompress(steps), np.uint8)
    return ranks


def sketch_ranks(pieces: DataFrame) -> np.ndarray:
    return unpacked_ranks(packed_ranks(pieces))


def bitmap(hashes: np.ndarray, bits: int) -> np.ndarray:
    flags = np.zeros(bits, bool)
    flags[(hashes & np.uint64(bits - 1)).astype(np.int64)] = True
    return np.packbits(flags, bitorder="little").view(np.uint64)


def bitmap_bits(size: int, each: int = 2, most: int = 8192) -> int:
    """A power of two, about `each` bits a shingle."""
    return min(most, max(128, 1 << (each * size - 1).bit_length()))


def folded(maps: list[np.ndarray]) -> np.ndarray:
    """Bitmaps as rows of the shortest one's width: a longer one's halves are put together until it fits."""
    width = min(len(m) for m in maps)
    return np.stack([np.bitwise_or.reduce(m.reshape(-1, width), axis=0) for m in maps])


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted arrays without repeats."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int(np.count_nonzero(b[at] == a))


def tile_links(sizes: np.ndarray, maps: np.ndarray, sides: np.ndarray, percent: int, sets: list[np.ndarray] | None = None, known: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Positions of pairs that may be similar, or are if sets are given; enough of them to connect all such pairs.

    Rows are in order of size. sides: 0 and 1 for the two tiles, of which only pairs across are compared; all pairs
    are if there is only one side. known: a number for each row; rows with the same one are connected already."""
    found, across = [], sides.min() != sides.max()
    own = np.arange(len(sizes)) if known is None else np.unique(known, return_inverse=True)[1]
    root = list(range(len(sizes)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    last = np.searchsorted(sizes * percent, 100 * sizes, side="right")  # up to there sets aren't too large
    for i in range(len(sizes)):
        others = np.arange(i + 1, last[i])
        others = others[own[others] != own[i]]
        if across:
            others = others[sides[others] != sides[i]]
        if not len(others):
            continue
        mine, theirs = maps[i], maps[others]
        bound = np.minimum(sizes[i] - np.bitwise_count(mine & ~theirs).sum(1, dtype=np.int64), sizes[others] - np.bitwise_count(theirs & ~mine).sum(1, dtype=np.int64))
        passed = np.flatnonzero(bound * (100 + percent) >= percent * (sizes[i] + sizes[others]))
        for j in others[passed[np.argsort(-bound[passed], kind="stable")]].tolist():
            a, b = find(own[i]), find(own[j])
            if a != b and (sets is None or overlap(sets[i], sets[j]) * (100 + percent) >= percent * (sizes[i] + sizes[j])):
                root[max(a, b)] = min(a, b)
                found.append((i, j))
    return found


def group_links(table: pa.Table, percent: int, exact: bool) -> pa.Table:
    """The links inside a group of families: by bitmaps (column map), or exact by sorted hashes (column hashes)."""
    families, ids, sides, known = (table.column(c).to_numpy() for c in ("family", "doc_id", "side", "known"))
    if exact:
        hashes = table.column("hashes").combine_chunks()
        flat, ends = hashes.values.to_numpy().view(np.uint64), hashes.offsets.to_numpy()
        sizes = np.diff(ends).astype(np.int64)
    else:
        sizes, stored = table.column("n").to_numpy(), table.column("map").to_pylist()
    order = np.lexsort((ids, sizes, families))
    a, b = [], []
    for own in np.split(order, np.flatnonzero(np.diff(families[order])) + 1):
        if len(own) < 2:
            continue
        sets = [flat[ends[i] : ends[i + 1]] for i in own] if exact else None
        maps = [bitmap(x, bitmap_bits(int(sizes[own[-1]]), 4, 4096)) for x in sets] if exact else [np.frombuffer(stored[i], np.uint64) for i in own]
        for i, j in tile_links(sizes[own], folded(maps), sides[own], percent, sets, known[own]):
            a.append(int(ids[own[i]]))
            b.append(int(ids[own[j]]))
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, tile_docs: int = 500, tile_shingles: int = 2_000_000, pack_docs: int = 500) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of docs (doc_id, text).

    Two documents link if the Jaccard index of their sets of `words`-word shingles is at least percent / 100;
    component_id is the smallest doc_id reachable by links. A text of fewer words is one shingle; null texts and texts
    without words are empty and link with nothing. Texts are read whole. A null doc_id gets a null component and links
    with nothing. Repeated rows come back as often as they are there. Rows that share an id but not the text are one
    document that links with whatever one of its texts links with. An empty table gives an empty result."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Size, digest and bitmap of each row; after the last one, the task's piece of the sketch."""
        names = ["doc_id", "n", "name", "map", "block", "piece", "counts"]
        sketch = Sketch()
        for batch in batches:
            for at in range(0, batch.num_rows, 1_000):
                part = batch.slice(at, 1_000)
                sets = [shingle_set(value.as_py(), words) for value in part.column(1)]
                sizes = [len(s) for s in sets]
                digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
                maps = [bitmap(s, bitmap_bits(len(s))).tobytes() for s in sets]
                sketch.add(np.concatenate(sets))
                none = [pa.nulls(len(sets), t) for t in (pa.int32(), pa.int32(), pa.binary())]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(maps, pa.binary()), *none], names)
        piece = TaskContext.get().partitionId()
        for block, packed in sketch.blocks():
            none = [pa.nulls(1, t) for t in (pa.int64(), pa.int64(), pa.binary(), pa.binary())]
            yield pa.RecordBatch.from_arrays([*none, pa.array([block], pa.int32()), pa.array([piece], pa.int32()), pa.array([packed], pa.binary())], names)

    with few_rows_a_batch(rows.sparkSession):
        both = materialise(rows.mapInArrow(describe, "doc_id long, n long, name binary, map binary, block int, piece int, counts binary"), "described")
    described = both.where("block is null")
    # which tells the texts of an id apart; repeated rows count once.
    known = described.where("n > 0 and doc_id is not null").withColumn("which", F.xxhash64("name"))
    again = materialise(known.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("doc_id"), "again")
    repeats = not again.isEmpty()
    if repeats:
        known = materialise(known.dropDuplicates(["doc_id", "which"]), "several")
    # What joins by a key that many rows may have is read from tables on both sides, so that Spark can split the key.
    classes = known.groupBy("name").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("copies")).where("copies > 1").select("name", "first")
    classes = materialise(classes, "classes")
    copies = materialise(known.select("doc_id", "which", "name").join(classes, "name").where("doc_id <> first").select("doc_id", "which", "first"), "copies")

    packed = rows.sparkSession.sparkContext.broadcast(packed_ranks(both.where("block is not null").select("block", "piece", "counts")))

    def keys_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = unpacked_ranks(packed.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 1_000):
                part = batch.slice(at, 1_000)
                sets = [shingle_set(value.as_py(), words) for value in part.column(1)]
                sizes = [len(s) for s in sets]
                digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
                keys = [prefix_keys(s, percent, ranks).view(np.int64) for s in sets]
                offsets = np.concatenate(([0], np.cumsum([len(k) for k in keys]))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(keys)))], ["doc_id", "n", "name", "keys"])

    keyed = rows.where("doc_id is not null").mapInArrow(keys_of, "doc_id long, n long, name binary, keys array<long>").where("n > 0").select("doc_id", F.xxhash64("name").alias("which"), "n", "keys")
    if repeats:
        keyed = keyed.dropDuplicates(["doc_id", "which"])
    with few_rows_a_batch(rows.sparkSession):
        keyed = materialise(join_ids(keyed, copies.select("doc_id", "which"), ["doc_id", "which"], "left_anti"), "keyed")
    packed.destroy()  # else the driver and the executors keep it for the whole join
    own = ["doc_id", "which", "n"] if repeats else ["doc_id", "n"]
    each = keyed.select(*own, F.explode("keys").alias("key"))
    # Most keys have one document. The others' rows are found by a shuffle at any size, in which Spark splits a hot key.
    often = materialise(each.groupBy("key").count().where("count > 1").select("key"), "often")
    shared = materialise(each.join(often.hint("merge"), "key", "left_semi"), "shared")
    # Copies with few changes share many keys; of keys with the same documents one is enough.
    alike = shared.groupBy("key").agg(F.count(F.lit(1)).alias("docs"), *[F.bit_xor(F.xxhash64(*own, F.lit(i))).alias(f"who_{i}") for i in (1, 2)])
    once = materialise(alike.groupBy("docs", "who_1", "who_2").agg(F.min("key").alias("key")).select("key"), "once")
    met = join_ids(shared, once, "key", "left_semi").select("doc_id", F.col("key").alias("family"), "n")
    close = family_tiles(met.distinct() if repeats else met, tile_docs, tile_shingles)
    families = tile_components(close, known.select("doc_id", "n", "map"), percent, pack_docs, tile_shingles, False)

    sized = families.join(known.select("doc_id", "n").distinct() if repeats else known.select("doc_id", "n"), families.node == F.col("doc_id")).select("doc_id", F.col("component").alias("family"), "n")
    tiles = family_tiles(sized, tile_docs, tile_shingles)

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                sets = [shingle_set(x.as_py(), words).view(np.int64) for x in part.column(1)]
                offsets = np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(sets)))], ["doc_id", "hashes"])

    sources = rows.where("doc_id is not null")
    if repeats:
        sources = join_ids(sources, again, "doc_id", "left_anti").unionByName(join_ids(sources, again, "doc_id", "left_semi").distinct())
    members = join_ids(sources, tiles.select("doc_id").distinct(), "doc_id", "left_semi").mapInArrow(sets_of, "doc_id long, hashes array<long>")
    extra = join_ids(copies, again, "doc_id", "left_semi").select(F.col("doc_id").alias("a"), F.col("first").alias("b")) if repeats else None
    linked = tile_components(tiles, members, percent, pack_docs, tile_shingles, True, extra)  # an id of several texts also links what they are copies of
    roots = linked.select(F.col("node").alias("first"), "component")
    joined = copies.join(roots, "first", "left").select("doc_id", F.coalesce("component", "first").alias("component"))
    placed = joined.unionByName(linked.select(F.col("node").alias("doc_id"), "component")).groupBy("doc_id").agg(F.min("component").alias("component"))
    out = described.select("doc_id", F.col("n").alias("n_shingles")).join(placed, "doc_id", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def tile_components(tiles: DataFrame, payload: DataFrame, percent: int, pack_docs: int, tile_shingles: int, exact: bool, extra: DataFrame | None = None) -> DataFrame:
    """node, component of the documents of tiles (doc_id, family, tile, n) that bitmaps or, if exact, sets connect.

    payload: doc_id and map or hashes. First each tile is compared with itself and the next one. Other pairs of tiles
    are compared only where that hasn't connected all documents of both, so a family of near copies takes work in
    proportion to its size. extra: more links (a, b)."""
    tiles = materialise(tiles, "tiles")
    columns = ["pack", "one", "other", "family", "side", "known", "doc_id", "hashes" if exact else "map", *([] if exact else ["n"])]

    def links(places: DataFrame) -> DataFrame:
        held = places.join(payload.hint("merge"), "doc_id").select(*columns)  # one plan at any size
        return held.groupBy("pack", "one", "other").applyInArrow(lambda t: group_links(t, percent, exact), "a long, b long")

    fresh = tiles.withColumn("known", F.col("doc_id"))
    near = links(tile_pairs(fresh, percent, pack_docs, tile_shingles, True))
    done = components(near.unionByName(extra) if extra is not None else near)
    if tiles.where("tile > 1").isEmpty():
        return done
    large = materialise(tiles.where("tile > 1").select("family").distinct(), "large")
    rest = join_ids(tiles, large, "family", "left_semi").join(done.select(F.col("node").alias("doc_id"), "component"), "doc_id", "left")
    rest = materialise(rest.select("doc_id", "family", "tile", "n", F.coalesce("component", "doc_id").alias("known")), "rest")
    far = links(tile_pairs(rest, percent, pack_docs, tile_shingles, False))
    return components(far.unionByName(done.select(F.col("node").alias("a"), F.col("component").alias("b"))))


def family_tiles(sized: DataFrame, tile_docs: int, tile_shingles: int) -> DataFrame:
    """doc_id, family, n -> the same with tile: documents of a family in order of size, cut where a tile is full.

    Only the distinct sizes of a family that fills more than a tile are put in order; documents of one size are dealt
    along their stretch by a hash of doc_id, so no task gathers a family."""
    load = F.lit(1.0 / tile_docs) + F.col("n") / F.lit(float(tile_shingles))
    sized = materialise(sized, "sized")
    large = materialise(sized.groupBy("family").agg(F.sum(load).alias("load")).where("load > 1").select("family"), "large")
    if large.isEmpty():
        return sized.withColumn("tile", F.lit(0))
    small = join_ids(sized, large, "family", "left_anti").withColumn("tile", F.lit(0))
    many = join_ids(sized, large, "family", "left_semi")
    before = Window.partitionBy("family").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    counts = many.groupBy("family", "n").agg(F.count(F.lit(1)).alias("docs"))
    starts = counts.select("family", "n", (load * F.col("docs")).alias("length")).withColumn("start", F.coalesce(F.sum("length").over(before), F.lit(0.0)))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / F.lit(1 << 30)
    placed = many.join(materialise(starts, "starts"), ["family", "n"]).withColumn("tile", F.floor(F.col("start") + F.col("length") * place).cast("int"))
    return small.unionByName(placed.select("doc_id", "family", "n", "tile"))


def tile_pairs(tiles: DataFrame, percent: int, pack_docs: int, tile_shingles: int, near: bool) -> DataFrame:
    """doc_id, known, family, side, and pack, one, other: the pairs of tiles that a document takes part in.

    near: only a tile with itself and with the next one; else all other pairs but those whose documents have one
    `known` in common. Tiles whose sizes are too far apart are not paired. Families of one tile are dealt into packs
    of about pack_docs documents, or fewer long ones."""
    held = ["doc_id", "known", "family"]
    large = materialise(tiles.where("tile > 0").select("family").distinct(), "large")
    single, paired = tiles, None
    if not large.isEmpty():
        single = join_ids(tiles, large, "family", "left_anti")
        several = join_ids(tiles, large, "family", "left_semi")
        of_tile = several.groupBy("family", "tile").agg(F.min("n").alias("low"), F.max("n").alias("high"), F.min("known").alias("least"), F.max("known").alias("most"))
        of_tile = materialise(of_tile, "of-tile")
        one, other = (of_tile.select("family", *[F.col(c).alias(f"{side}_{c}") for c in ("tile", "low", "high", "least", "most")]) for side in ("one", "other"))
        apart = F.col("other_tile") - F.col("one_tile")
        if near:  # by the tile's number: work in proportion to the tiles
            met = one.join(other.withColumn("one_tile", F.explode(F.array("other_tile", F.col("other_tile") - 1))), ["family", "one_tile"])
        else:
            met = one.join(other, "family").where((apart > 1) & (F.greatest("one_most", "other_most") != F.least("one_least", "other_least")))
        pairs = met.where(F.col("other_low") * percent <= F.col("one_high") * 100).select("family", F.col("one_tile").alias("one"), F.col("other_tile").alias("other"))
        ends = pairs.select("family", "one", "other", F.col("one").alias("tile"), F.lit(0).alias("side")).unionByName(pairs.where("one < other").select("family", "one", "other", F.col("other").alias("tile"), F.lit(1).alias("side")))
        paired = several.join(materialise(ends, "ends"), ["family", "tile"]).select(*held, "side", F.col("family").alias("pack"), "one", "other")
        if not near:
            return paired
    load = single.agg(F.sum(F.lit(1.0 / pack_docs) + F.col("n") * F.lit(4.0 / tile_shingles))).first()[0] or 0.0
    pack = (-1 - F.pmod(F.xxhash64("family"), F.lit(max(1, int(load) + 1)))).alias("pack")
    packed = single.select(*held, F.lit(0).alias("side"), pack, F.lit(0).alias("one"), F.lit(0).alias("other"))
    return packed.unionByName(paired) if paired is not None else packed
