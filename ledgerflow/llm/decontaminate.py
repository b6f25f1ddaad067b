"""Benchmark decontamination by the q-gram lemma.

Benchmark texts are cut into overlapping windows, long and short. A window of m characters with at most k edits shares
at least m - q + 1 - k * q of its q-grams with the text, on diagonals no more than k apart. Each text is read once, as
an array of characters: where a stretch of it holds too few benchmark q-grams it is passed over; in what is left, shared q-grams
are counted in overlapping bands of diagonals, and bands that meet the bound are verified by banded alignment.
A benchmark that makes one block of windows goes to the tasks, and documents are not shuffled. A larger one is first
told by a table of flags of bounded size: what of a text may match at all is compared with all blocks in one shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import materialise

REGIONS = "array<struct<item_id:long,start:int,end:int,edits:int>>"
_MIX = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0x100000001B3)
_WORD = re.compile(r"\S+")
#: Windows that are aligned with a text at once, at most.
ALIGNED = 2_000
#: Shared q-grams, with each place where they stand in a window, that are counted at once, about.
PAIRS = 500_000
#: Flags of q-grams, at most, as a power of two, and those that travel in one row.
FLAG_BITS, PART_BITS = 27, 18
#: Characters of texts that a task compares with a block of windows, about, and of one piece of a text.
SUSPECTS, PIECE = 16_000_000, 20_000


def flat(text: str | None) -> str:
    """Lower case, with one space between words: benchmark and documents alike go through this and nothing else.

    White space is Unicode's, so no-break and ideographic spaces separate words too."""
    return " ".join((text or "").lower().split())


def windows(benchmark: DataFrame, length: int, step: int, part: int, part_step: int) -> DataFrame:
    """item_id, window: the text's windows of `length` and of `part` characters, the last ones ending with it.

    A shorter text is one window."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                own = flat(text)
                starts = [(min(at, max(0, len(own) - size)), size) for size, by in ((length, step), (part, part_step)) for at in range(0, max(1, len(own) - size + by), by)]
                found = sorted({own[at : at + size] for at, size in starts} - {""})
                yield pa.RecordBatch.from_arrays([pa.array([item.as_py()] * len(found), pa.int64()), pa.array(found, pa.string())], ["item_id", "window"])

    return benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).mapInArrow(cut, "item_id long, window string")


def characters(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def gram_hashes(chars: np.ndarray, q: int) -> np.ndarray:
    """A hash of each run of q characters."""
    n = len(chars) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, at, power, width, done = np.zeros(n, np.uint64), chars.astype(np.uint64), _BASE, 1, 0
    with np.errstate(over="ignore"):
        while True:  # at: hashes of runs of `width`; q's binary digits say which are put together
            if q & width:
                out = out * power + at[done : done + n]
                done += width
            if width * 2 > q:
                return (out ^ (out >> np.uint64(29))) * _MIX
            at = at[: len(at) - width] * power + at[width:]
            power, width = power * power, width * 2


@dataclass
class Index:
    """q-grams of a block of windows: hashes in order, and for each the (window, place) pairs where it stands."""

    q: int
    #: For each window the items that it stands in.
    items: list[list[int]]
    texts: list[np.ndarray]
    strings: list[str]
    edits: np.ndarray
    need: np.ndarray
    hashes: np.ndarray
    starts: np.ndarray
    owners: np.ndarray
    places: np.ndarray
    table: np.ndarray
    shift: np.uint64
    limits: list[tuple[int, int]]
    #: Windows of fewer than q characters, looked for as they are, and how many words they have.
    short: dict[str, list[int]]
    short_words: list[int]


def budget(length: int, q: int, edit_rate: float) -> tuple[int, int]:
    """Edits that a window may have, and the shared q-grams that it then has at least.

    A short window allows fewer edits, so that the lemma still asks for a shared q-gram."""
    k = max(0, min(int(edit_rate * length), (length - q) // q))
    return k, length - q + 1 - k * q


def stretch_limits(lengths: list[int], q: int, edit_rate: float) -> list[tuple[int, int]]:
    """For windows of about one length: the hits that each needs at least, and the characters they lie in at most."""
    alike: dict[int, list[tuple[int, int]]] = {}
    for m in lengths:
        k, need = budget(m, q, edit_rate)
        alike.setdefault(m.bit_length(), []).append((need, m + k))
    return [(min(n for n, _ in of), max(span for _, span in of)) for of in alike.values()]


def build_index(rows: list[tuple[int, str]], q: int, edit_rate: float) -> Index | None:
    by_text: dict[str, list[int]] = {}
    for item, text in rows:
        by_text.setdefault(text, []).append(item)
    kept = [(items, characters(text), *budget(len(text), q, edit_rate), text) for text, items in by_text.items() if len(text) >= q]
    short = {text: items for text, items in by_text.items() if 0 < len(text) < q}
    lengths = sorted({text.count(" ") + 1 for text in short})
    if not kept:
        none = np.zeros(0, np.int64)
        return Index(q, [], [], [], none, none, none.astype(np.uint64), none, none, none, none.astype(bool), np.uint64(0), [], short, lengths) if short else None
    hashes = [gram_hashes(c, q) for _, c, *_ in kept]
    owners = np.repeat(np.arange(len(kept)), [len(h) for h in hashes])
    places = np.concatenate([np.arange(len(h)) for h in hashes])
    every = np.concatenate(hashes)
    order = np.argsort(every, kind="stable")
    unique, starts = np.unique(every[order], return_index=True)
    bits = max(16, min(24, int(np.log2(len(unique) + 1)) + 6))
    shift = np.uint64(64 - bits)
    table = np.zeros(1 << bits, bool)
    table[(unique >> shift).astype(np.int64)] = True
    edits, need = np.array([x[2] for x in kept]), np.array([x[3] for x in kept])
    limits = stretch_limits(sorted({len(x[1]) for x in kept}), q, edit_rate)
    return Index(q, [x[0] for x in kept], [x[1] for x in kept], [x[4] for x in kept], edits, need, unique, np.append(starts, len(every)), owners[order], places[order], table, shift, limits, short, lengths)


def dense_hits(at: np.ndarray, limits: list[tuple[int, int]]) -> np.ndarray:
    """Which hits have a stretch around them, as long as windows of one length may fill, that holds enough for them."""
    mark = np.zeros(len(at) + 1, np.int64)
    for least, span in limits:
        if len(at) >= least:
            ahead = np.searchsorted(at, at + span, side="right") - np.arange(len(at))
            full = np.flatnonzero(ahead >= least)
            np.add.at(mark, full, 1)
            np.add.at(mark, full + ahead[full], -1)
    return np.cumsum(mark)[:-1] > 0


def candidate_bands(index: Index, chars: np.ndarray) -> Iterator[list[tuple[int, int]]]:
    """Lists of (window, first diagonal) of each band that shares enough q-grams with a window.

    About PAIRS pairs of places are counted at a time: a stretch of the text for each list, which overlap by the
    longest that a window may fill, so each band is whole in one of them."""
    h = gram_hashes(chars, index.q)
    if not len(h) or not index.items:
        return
    at = np.flatnonzero(index.table[(h >> index.shift).astype(np.int64)])
    if not len(at):
        return
    slot = np.searchsorted(index.hashes, h[at])
    slot[slot == len(index.hashes)] = 0
    real = index.hashes[slot] == h[at]
    at, slot = at[real], slot[real]
    stays = dense_hits(at, index.limits)
    at, slot = at[stays], slot[stays]
    counts = index.starts[slot + 1] - index.starts[slot]
    before = np.concatenate(([0], np.cumsum(counts)))
    reach = max((span for _, span in index.limits), default=0)
    begin = 0
    while begin < len(at):
        end = max(int(np.searchsorted(before, before[begin] + PAIRS, side="right")) - 1, int(np.searchsorted(at, at[begin] + 2 * reach, side="right")))
        yield bands_of(index, at[begin:end], slot[begin:end], counts[begin:end])
        begin = len(at) if end >= len(at) else int(np.searchsorted(at, at[end - 1] - reach, side="right"))


def bands_of(index: Index, at: np.ndarray, slot: np.ndarray, counts: np.ndarray) -> list[tuple[int, int]]:
    total = int(counts.sum())
    first = np.repeat(index.starts[slot] - np.concatenate(([0], np.cumsum(counts)[:-1])), counts)
    pairs = first + np.arange(total)
    owner, diagonal = index.owners[pairs], np.repeat(at, counts) - index.places[pairs]
    band = diagonal // (index.edits[owner] + 1)
    # Bands are two widths wide and begin at every width, so each run of `width` diagonals lies in one of them.
    owners, number = np.flatnonzero(np.bincount(owner)), np.zeros(len(index.items), np.int64)
    number[owners] = np.arange(len(owners))
    low, width = int(band.min()) - 1, int(band.max() - band.min()) + 2
    key = number[owner] * width + (band - low)
    if len(owners) * width <= 8 * total + 100_000:
        n = np.bincount(key, minlength=len(owners) * width + 1)
        n = n[:-1] + n[1:]  # those of a band and of the next one; the first column of an owner is empty
        key = np.flatnonzero(n)
        n = n[key]
    else:
        key, n = np.unique(np.concatenate((key, key - 1)), return_counts=True)
    owner, band = owners[key // width], key % width + low
    good = n >= index.need[owner]
    return [(int(w), int(b) * (int(index.edits[w]) + 1)) for w, b in zip(owner[good], band[good], strict=True)]


def banded_edits(patterns: np.ndarray, chars: np.ndarray, low: np.ndarray, width: int, most: int) -> list[tuple[int, int, int] | None]:
    """For each row of patterns, (edits, start, end) of its best alignment with a stretch of chars, if within `most`.

    Only cells on the diagonals low ... low + width - 1 of a row are filled. Ties go to the earliest end."""
    cells, length = np.arange(width), patterns.shape[1]
    big = length + most + 2
    # cost[r, d]: patterns[r, :i] against chars up to i + low[r] + d; begun[r, d]: where that alignment starts
    rows, ends = np.arange(len(patterns)), low[:, None] + cells
    cost = np.where((ends >= 0) & (ends <= len(chars)), 0, big)
    begun = ends.copy()
    for i in range(length):
        ends = ends + 1
        inside = (ends >= 1) & (ends <= len(chars))
        same = inside & (chars[np.clip(ends - 1, 0, len(chars) - 1)] == patterns[rows, i][:, None])
        step = np.where(inside, cost + ~same, big)
        skip = np.pad(cost[:, 1:], ((0, 0), (0, 1)), constant_values=big) + 1  # a pattern character without a counterpart
        take = skip < step
        new = np.where(take, skip, step)
        new_begun = np.where(take, np.pad(begun[:, 1:], ((0, 0), (0, 1))), begun)
        new = np.where((ends >= 0) & (ends <= len(chars)), new, big)
        # characters of the text without a counterpart: from the left, one edit each
        lowered = np.minimum.accumulate(new - cells, axis=1)
        better = lowered + cells < new
        if better.any():
            source = np.maximum.accumulate(np.where(new - cells == lowered, cells, -1), axis=1)
            new_begun = np.where(better, np.take_along_axis(new_begun, source, 1), new_begun)
            new = np.where(better, lowered + cells, new)
        alive = new.min(1) <= most
        rows, ends, cost, begun = (rows, ends, new, new_begun) if alive.all() else (rows[alive], ends[alive], new[alive], new_begun[alive])
        if not len(rows):
            break
    out: list[tuple[int, int, int] | None] = [None] * len(patterns)
    for r, d, c, start in zip(rows, cost.argmin(1), cost, begun, strict=True):
        out[r] = int(c[d]), int(start[d]), int(length + low[r] + d)
    return out


def merged(regions: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Regions (item, start, end, edits) of an item that overlap become one, with the fewest edits of them."""
    out: list[tuple[int, int, int, int]] = []
    for item, start, end, edits in sorted(regions, key=lambda r: (r[0] is None, r[0] or 0, *r[1:])):
        if out and out[-1][0] == item and start < out[-1][2]:
            out[-1] = item, out[-1][1], max(end, out[-1][2]), min(edits, out[-1][3])
        else:
            out.append((item, start, end, edits))
    return out


def find_regions(index: Index, text: str, whole: bool = True) -> list[tuple[int, int, int, int]]:
    """(item_id, start, end, edits) of the verified regions of a flat text; places count its characters.

    Windows shorter than a q-gram are looked for if the text is whole: a piece may begin or end inside a word."""
    chars = characters(text)
    found: list[tuple[int, int, int, int]] = []
    for bands in candidate_bands(index, chars):
        found = merged(found + verified(index, text, chars, bands)) if bands else found
    if index.short and whole:
        for start, end in short_runs(text, index.short_words):
            found += [(item, start, end, 0) for item in index.short.get(text[start:end], ())]
    return found


def verified(index: Index, text: str, chars: np.ndarray, bands: list[tuple[int, int]]) -> list[tuple[int, int, int, int]]:
    """Windows and their bands by alignment; an exact copy needs none."""
    found: set[tuple[int, int, int, int]] = set()
    todo: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for w, low in bands:
        k, m = int(index.edits[w]), len(index.texts[w])
        start = text.find(index.strings[w], max(0, low), max(0, low + 2 * k + 1 + m))
        if start >= 0:
            found.update((item, start, start + m, 0) for item in index.items[w])
        else:
            todo.setdefault((m, k), []).append((w, low))
    for (_, k), some in todo.items():  # windows of one length are aligned together
        for at in range(0, len(some), ALIGNED):
            part = some[at : at + ALIGNED]
            hits = banded_edits(np.stack([index.texts[w] for w, _ in part]), chars, np.array([low for _, low in part]), 2 * (k + 1), k)
            found.update((item, start, end, edits) for (w, _), hit in zip(part, hits, strict=True) if hit for edits, start, end in [hit] for item in index.items[w])
    return list(found)


def short_runs(text: str, counts: list[int]) -> Iterator[tuple[int, int]]:
    """Start and end of each run of so many words."""
    words = text.split(" ")
    begins = np.cumsum([0] + [len(w) + 1 for w in words]).tolist()
    for n in counts:
        for i in range(len(words) - n + 1):
            yield begins[i], begins[i + n] - 1


def spans_in_text(text: str, regions: list[tuple[int, int, int, int]]) -> list[dict]:
    """Regions of the flat text as spans of the words of the text itself."""
    words = [m.span() for m in _WORD.finditer(text)]
    ends = np.cumsum([len(text[a:b].lower()) + 1 for a, b in words])
    at = lambda place: min(int(np.searchsorted(ends, place, side="right")), len(words) - 1)
    return [{"item_id": i, "start": words[at(s)][0], "end": words[at(max(s, e - 1))][1], "edits": k} for i, s, e, k in regions]


def contaminated_regions(
    docs: DataFrame, benchmark: DataFrame, q: int = 8, edit_rate: float = 0.08, window: int = 100, step: int = 50, block_windows: int = 20_000, text_col: str = "text",
    part: int = 50, part_step: int = 10,
) -> DataFrame:
    """docs with the regions that match a window of benchmark (item_id, text) within edit_rate edits a character.

    Adds n_regions, items (sorted, distinct) and regions in order: item, span in the text, edits; columns of docs with these
    names give way. Matches of an item's windows that overlap are one region, with the edits of the best of them.
    Texts are compared in lower case with white space collapsed. Items shorter than q characters are
    found where their words stand as they are. Every row of docs comes back once; null and empty texts, and any text if the benchmark is empty,
    have no regions. The long windows allow edits to be bunched; the short ones find a leak of a part of an item: a
    verbatim stretch of an item of at least part + part_step - 1 characters (59) holds a whole short window and is
    found for certain, wherever it begins. A shorter stretch of a longer item may be missed. Texts that repeat a word of
    the benchmark over and over are counted a stretch at a time, so memory doesn't grow with their length. One block of
    windows, about block_windows, is what the driver and each task hold of the benchmark; of a larger benchmark the
    driver sees flags alone, and the stages are the same for any number of blocks."""
    kept = docs.drop("n_regions", "items", "regions")
    cut = materialise(windows(benchmark, window, step, part, part_step).distinct(), "windows")
    blocks = -(-cut.count() // block_windows)
    if blocks > 1:
        found = in_blocks(kept, cut, blocks, q, edit_rate, text_col)
    else:
        found = kept.withColumn("regions", F.array().cast(REGIONS))
        index = build_index([(r["item_id"], r["window"]) for r in cut.orderBy("item_id", "window").collect()], q, edit_rate)
        if index:
            found = with_regions(found, text_col, lambda text, _: find_regions(index, flat(text)))
    items = F.array_sort(F.array_distinct(F.transform("regions", lambda r: r.item_id)))
    return found.select(*[c for c in found.columns if c != "regions"], F.size("regions").alias("n_regions"), items.alias("items"), F.array_sort("regions").alias("regions"))


def with_regions(docs: DataFrame, text_col: str, find: Callable[[str, list], list[tuple[int, int, int, int]]]) -> DataFrame:
    """docs with column regions replaced: find gets the text and the regions there, and gives regions of the flat text."""
    text_at, regions_at = docs.columns.index(text_col), docs.columns.index("regions")

    def one(text: str | None, before: list | None) -> list:
        regions = find(text, before or []) if text else []
        return spans_in_text(text, regions) if regions else []

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(batch.columns)
            lists = [one(x.as_py(), y.as_py()) for x, y in zip(columns[text_at], columns[regions_at], strict=True)]
            columns[regions_at] = pa.array(lists, columns[regions_at].type)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return docs.mapInArrow(scan, docs.schema)


def run_hash(chars: np.ndarray) -> int:
    """A hash of a text shorter than a q-gram."""
    return int(gram_hashes(chars, len(chars))[0])


def gram_flags(cut: DataFrame, q: int, bits: int) -> np.ndarray:
    """2^bits flags, eight in a byte: set where a q-gram of a window, or a window shorter than that, has its hash."""

    def flag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(1 << bits >> 3, np.uint8)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                chars = characters(text)
                h = gram_hashes(chars, min(q, len(chars))) >> np.uint64(64 - bits)
                np.bitwise_or.at(own, (h >> np.uint64(3)).astype(np.int64), np.uint8(1) << (h & np.uint64(7)).astype(np.uint8))
        parts = own.reshape(-1, min(len(own), 1 << PART_BITS >> 3))
        for n in np.flatnonzero(parts.any(axis=1)).tolist():
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int32()), pa.array([parts[n].tobytes()], pa.binary())], ["part", "flags"])

    def either(table: pa.Table) -> pa.Table:
        total = np.zeros(len(table.column("flags")[0].as_py()), np.uint8)
        for piece in table.column("flags"):
            total |= np.frombuffer(piece.as_py(), np.uint8)
        return pa.table({"part": table.column("part")[:1], "flags": pa.array([total.tobytes()], pa.binary())})

    flags = np.zeros(1 << bits >> 3, np.uint8)
    for row in cut.select("window").mapInArrow(flag, "part int, flags binary").groupBy("part").applyInArrow(either, "part int, flags binary").collect():
        flags[row["part"] * len(row["flags"]) : (row["part"] + 1) * len(row["flags"])] = np.frombuffer(row["flags"], np.uint8)
    return flags


def flagged(flags: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = h >> np.uint64(64 - (len(flags).bit_length() + 2))
    return flags[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1 > 0


def suspects(text: str, flags: np.ndarray, q: int, limits: list[tuple[int, int]], short_words: list[int]) -> list[tuple[int, int]]:
    """Stretches of a flat text in which windows may stand, in pieces that overlap by more than a window may fill."""
    chars = characters(text)
    at = np.flatnonzero(flagged(flags, gram_hashes(chars, q)))
    at = at[dense_hits(at, limits)] if len(at) else at
    reach = 3 * max((span for _, span in limits), default=0) + q
    found = []
    for some in np.split(at, np.flatnonzero(np.diff(at) > reach) + 1) if len(at) else []:
        low, high = max(0, int(some[0]) - reach), min(len(text), int(some[-1]) + reach)
        found += [(a, min(high, a + PIECE + reach)) for a in range(low, max(low + 1, high - reach), PIECE)]
    runs = ((a, b) for a, b in short_runs(text, short_words) if 0 < b - a < q)
    return found + [(a, b) for a, b in runs if flagged(flags, np.array([run_hash(chars[a:b])], np.uint64))[0]]


def in_blocks(docs: DataFrame, cut: DataFrame, blocks: int, q: int, edit_rate: float, text_col: str) -> DataFrame:
    """docs with regions, for a benchmark of several blocks of windows.

    Regions follow from a text alone, so equal texts are compared once and their rows find the regions by the text's
    digest. Stretches that may match meet each block of windows; no task holds more than a block and SUSPECTS characters."""
    lengths = [r["m"] for r in cut.select(F.length("window").alias("m")).distinct().collect()]  # no more than a window is long
    limits = stretch_limits(sorted(m for m in lengths if m >= q), q, edit_rate)
    few = cut.where(F.length("window") < q).select((F.length("window") - F.length(F.replace("window", F.lit(" "))) + 1).alias("n")).distinct()
    short_words = sorted(r["n"] for r in few.collect())  # no more than q
    bits = max(PART_BITS, min(FLAG_BITS, int(cut.count()).bit_length() + 8))
    flags = docs.sparkSession.sparkContext.broadcast(gram_flags(cut, q, bits))
    key = F.sha2(F.col(text_col).cast("string"), 256).alias("_text_key")

    def suspect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for digest, text in zip(batch.column(0), batch.column(1), strict=True):
                own = flat(text.as_py())
                for a, b in suspects(own, flags.value, q, limits, short_words) if own else []:
                    yield pa.RecordBatch.from_arrays([pa.array([digest.as_py()]), pa.array([a], pa.int32()), pa.array([own[a:b]])], ["_text_key", "at", "piece"])

    pieces = docs.select(key, F.col(text_col).cast("string").alias("text")).where("text <> ''").mapInArrow(suspect, "_text_key string, at int, piece string")
    pieces = materialise(pieces.dropDuplicates(["_text_key", "at", "piece"]), "suspects")
    salts = int((pieces.agg(F.sum(F.length("piece"))).first()[0] or 0) // SUSPECTS) + 1
    left = cut.select("item_id", "window", F.pmod(F.xxhash64("window"), F.lit(blocks)).alias("block"), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    right = pieces.select("*", F.pmod(F.xxhash64("_text_key", "at"), F.lit(salts)).cast("int").alias("salt"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"))

    def compare(block: pa.Table, texts: pa.Table) -> pa.Table:
        names, rows = ("_text_key", "item_id", "start", "end", "edits"), []
        index = build_index(list(zip(block.column("item_id").to_pylist(), block.column("window").to_pylist(), strict=True)), q, edit_rate) if block.num_rows and texts.num_rows else None
        for digest, at, piece in zip(*[texts.column(c) for c in ("_text_key", "at", "piece")], strict=True) if index else []:
            rows += [(digest.as_py(), item, a + at.as_py(), b + at.as_py(), k) for item, a, b, k in merged(find_regions(index, piece.as_py(), len(piece.as_py()) < q))]
        kinds = (pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
        return pa.table({name: pa.array([r[i] for r in rows], kind) for i, (name, kind) in enumerate(zip(names, kinds, strict=True))})

    by = lambda df: df.groupBy("block", "salt")
    hits = by(left).cogroup(by(right)).applyInArrow(compare, "_text_key string, item_id long, start int, end int, edits int")
    regions = materialise(hits.groupBy("_text_key").agg(F.collect_set(F.struct("item_id", "start", "end", "edits")).alias("regions")), "regions")
    joined = docs.withColumn("_text_key", key).join(regions, "_text_key", "left").select(*docs.columns, F.col("regions").cast(REGIONS).alias("regions"))
    return with_regions(joined, text_col, lambda _, before: merged([(r["item_id"], r["start"], r["end"], r["edits"]) for r in before]))
