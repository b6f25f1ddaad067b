"""Fuzzy search for short licence notices.

Each notice, as lower-case words joined by one space, is cut into one more piece than it may have edits. At least one
piece of any match is then free of edits, so an automaton over all pieces finds every candidate; the regex library's
bounded-error matching verifies the candidates and says where they begin and end. All work is a map over the rows.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The words of a notice, its label, and the edits (characters) that a match may have.
BASE_NOTICES = (("mit license", "mit", 1), ("apache license", "apache", 1), ("general public license", "gpl", 2))
MORE_NOTICES = (
    ("released under the mit license", "mit", 3),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit", 7),
    ("licensed under the apache license version 2 0", "apache", 4),
    ("licensed under the gnu general public license", "gpl", 4),
    ("gnu lesser general public license", "lgpl", 3),
    ("mozilla public license", "mpl", 2),
    ("licensed under cc by nc", "cc-by-nc", 1),
    ("licensed under cc by sa", "cc-by-sa", 1),
    ("creative commons attribution", "cc-by", 2),
    ("all rights reserved", "proprietary", 2),
    ("redistribution and use in source and binary forms", "bsd", 4),
)
# Short words of notices that may be edited; others of up to three letters name the licence.
FUNCTION_WORDS = ("a", "all", "and", "any", "in", "is", "of", "the", "to", "use", "0", "2")
# End of the fixed values.

_WORD = re.compile("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")
_UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPANS = "array<struct<label:string,notice:string,start:int,end:int,first_word:int,n_words:int,edits:int,exact:boolean>>"


@lru_cache(maxsize=4)
def _searcher(notices: tuple):
    """The automaton over all pieces, with (notice, place of the piece in it) for each; each notice's names and pattern."""
    import ahocorasick
    import regex

    seeds: dict[str, list[tuple[int, int]]] = {}
    patterns = []
    for i, (notice, _, edits) in enumerate(notices):
        if len(notice) <= edits:
            raise ValueError(f"{edits} edits allow the notice {notice!r} to vanish")
        for k in range(edits + 1):
            start, end = len(notice) * k // (edits + 1), len(notice) * (k + 1) // (edits + 1)
            seeds.setdefault(notice[start:end], []).append((i, start))
        names = {w for w in notice.split() if len(w) <= 3 and w not in FUNCTION_WORDS}
        patterns.append((names, regex.compile(f"(?b)(?<![^ ])(?:{regex.escape(notice, literal_spaces=True)}){{e<={edits}}}(?![^ ])")))
    automaton = ahocorasick.Automaton()
    for seed, places in seeds.items():
        automaton.add_word(seed, (len(seed), tuple(places)))
    automaton.make_automaton()
    return automaton, patterns


def scan_text(text: str, notices: tuple) -> tuple[int, list[tuple]]:
    """Number of words, and (notice number, first word, words, edits) of each match, in order."""
    words = _WORD.findall(text.translate(_UPPER))
    flat = " ".join(words)
    automaton, patterns = _searcher(notices)
    at: dict[int, set[int]] = {}
    for end, (length, places) in automaton.iter(flat):
        for i, offset in places:
            at.setdefault(i, set()).add(end + 1 - length - offset)
    found = set()
    for i, starts in at.items():
        notice, _, edits = notices[i]
        for start in starts:
            end = start + len(notice)
            if start >= 0 and flat.startswith(notice, start) and flat[start - 1 : start] in ("", " ") and flat[end : end + 1] in ("", " "):
                found.add((i, start, end, 0))
                continue
            # The window ends where words do, as search() doesn't look behind its end.
            low = flat.rfind(" ", 0, max(0, start - edits)) + 1
            high = flat.find(" ", min(len(flat), end + edits))
            names, pattern = patterns[i]
            if (m := pattern.search(flat, low, high if high >= 0 else len(flat))) and names <= set(m.group().split()):
                found.add((i, m.start(), m.end(), sum(m.fuzzy_counts)))
    matches = []
    begins = list(accumulate((len(w) + 1 for w in words), initial=0)) if found else []
    for i, start, end, edits in sorted(found, key=lambda x: (x[1], x[0], x[2])):
        first = bisect_right(begins, start) - 1
        matches.append((i, first, bisect_left(begins, end) - first, edits))
    return len(words), matches


def license_scan(docs: DataFrame, notices: tuple = BASE_NOTICES + MORE_NOTICES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_words and matches for every row of docs.

    notices: (words joined by one space, label, edits). A match begins and ends with whole words, and holds the words of
    up to three letters that name the licence as they are (mit, not it; nc, not nd). start and end count
    characters of the text itself; first_word counts words from 0. exact: the notice's words stand there as they are.
    Null and empty texts have no words and no matches. Repeated rows, null ids and other columns are let through or
    ignored, and an empty table gives an empty result."""
    notices = tuple(map(tuple, notices))
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    kind = pa.list_(pa.struct([("label", pa.string()), ("notice", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("first_word", pa.int32()), ("n_words", pa.int32()), ("edits", pa.int32()), ("exact", pa.bool_())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, spans = [], []
            for value in batch.column(1):
                text = value.as_py()
                n, matches = scan_text(text, notices)
                counts.append(n)
                own = []
                if matches:
                    places = [m.span() for m in _WORD.finditer(text.translate(_UPPER))]
                    for i, first, length, edits in matches:
                        own.append({"label": notices[i][1], "notice": notices[i][0], "start": places[first][0], "end": places[first + length - 1][1], "first_word": first, "n_words": length, "edits": edits, "exact": edits == 0})
                spans.append(own)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(spans, kind)], ["id", "n_words", "matches"])

    out = rows.mapInArrow(scan, f"id {rows.schema['id'].dataType.simpleString()}, n_words long, matches {SPANS}")
    return out.select(F.col("id").alias(id_col), "n_words", "matches")


def license_digest(scanned: DataFrame, base: tuple = BASE_NOTICES) -> DataFrame:
    """The matches of license_scan as columns: places and labels of the base notices, all labels, and a score.

    The score is the best match's share of characters without edits: 1 for an exact notice, 0 for none."""
    names = [x[0] for x in base]
    base_at = F.filter("matches", lambda m: m.exact & m.notice.isin(names))
    labels = lambda c: F.array_join(F.array_sort(F.array_distinct(F.transform(c, lambda m: m.label))), ",")
    return scanned.withColumn("base", base_at).select(
        *[c for c in scanned.columns if c != "matches"],
        F.size("base").cast("long").alias("n_base"),
        F.array_min(F.transform("base", lambda m: m.first_word)).cast("long").alias("first_word"),
        F.array_max(F.transform("base", lambda m: m.first_word)).cast("long").alias("last_word"),
        labels("base").alias("base_labels"),
        labels("matches").alias("labels"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: 1 - m.edits / F.greatest(F.length(m.notice), m.edits))), F.lit(0.0)).cast("double").alias("score"),
    )
