"""Filter interaction audit: which filter removes what, in every order that filters may be applied in.

What a document fails is a bit mask, so a table shrinks to counts by part and mask. The step at which an order removes
a mask is a min-plus product: the mask matrix (0 where a filter fails, infinity elsewhere) is combined with the
position matrix of the orders (their inverse permutations) by minimum. Removals, losses and redundancies of all orders
are then counts scattered to these steps.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# The filters in order of their bits, and what they ask of a text.
FILTERS = "ABCDE"
LEAST_WORDS = 200
LEAST_DISTINCT_PERCENT = 50
MOST_CAPITALS_PERCENT = 3
SYMBOLS = b"#$%&*|"
# End of the fixed values.
CAPITALS = bytes(range(65, 91))
REPORT = "part string, filter_order string, step int, filter string, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def text_mask(text: str) -> tuple[int, bytes]:
    """Bits of the filters A to D that a text fails by itself, and the digest that equal texts share."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()  # of bytes: splits at the six ASCII white-space characters and nowhere else
    fails = (
        len(words) < LEAST_WORDS,
        100 * len(set(words)) < LEAST_DISTINCT_PERCENT * len(words),
        100 * (len(data) - len(data.translate(None, CAPITALS))) > MOST_CAPITALS_PERCENT * len(text),
        len(data.translate(None, SYMBOLS)) < len(data),
    )
    return sum(fail << bit for bit, fail in enumerate(fails)), hashlib.sha256(data).digest()


def document_masks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """id, part, mask (filters A to D) and digest for every row of docs; a null text or part is an empty one."""
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), empty(part_col).alias("part"), empty(text_col).alias("text"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [text_mask(value.as_py()) for value in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([m for m, _ in found], pa.int32()), pa.array([d for _, d in found], pa.binary())], ["id", "part", "mask", "digest"])

    return rows.mapInArrow(judge, f"id {rows.schema['id'].dataType.simpleString()}, part string, mask int, digest binary")


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, n, good, toxic: documents of a part that fail exactly these filters, and those labelled good or toxic.

    Filter E fails a document if its text is that of any smaller id. Copies of a text differ in nothing but id, part
    and labels, so they are counted by these before anything is compared: of each such group only the rows of its
    smallest id can pass, and a text of any number of copies is a few rows. A null id is neither smaller nor larger
    than others, and has no labels. Of several labels of an id the higher counts."""
    rows = document_masks(docs).groupBy("id", "part", "mask", "digest").agg(F.count(F.lit(1)).alias("n"))
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("id")).agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    # Rows without an id have no partner; a join would send all of them to one task.
    named = rows.where("id is not null").join(marks, "id", "left").fillna(0, ["good", "toxic"])
    rows = named.unionByName(rows.where("id is null").withColumns({"good": F.lit(0), "toxic": F.lit(0)}))
    known = F.col("id").isNotNull()
    groups = rows.groupBy("digest", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"), F.sum(F.when(known, 0).otherwise(F.col("n"))).alias("unnamed"), F.min(F.when(known, F.struct("id", "n"))).alias("low")
    )
    lowest = F.min("low.id").over(Window.partitionBy("digest"))
    first = F.col("unnamed") + F.when(F.col("low.id") == lowest, F.col("low.n")).otherwise(0)
    bit = 1 << FILTERS.index("E")
    either = F.explode(F.array(F.struct(F.col("mask"), F.col("first").alias("n")), F.struct((F.col("mask") + bit).alias("mask"), (F.col("n") - F.col("first")).alias("n"))))
    dealt = groups.withColumn("first", F.coalesce(first, F.lit(0))).select("part", "good", "toxic", either.alias("x")).where("x.n > 0")
    return dealt.groupBy("part", F.col("x.mask").alias("mask")).agg(F.sum("x.n").alias("n"), F.sum(F.col("x.n") * F.col("good")).alias("good"), F.sum(F.col("x.n") * F.col("toxic")).alias("toxic"))


@lru_cache(maxsize=4)
def removal_steps(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Orders (order x step -> filter), positions (filter x order -> step) and removal steps (mask x order) of n filters.

    Steps count from 1; n + 1 stands for infinity: nothing removes the mask."""
    orders = np.array(list(permutations(range(n))))
    positions = np.argsort(orders, axis=1).T + 1
    masks = np.where(np.arange(1 << n)[:, None] >> np.arange(n) & 1, 0, n + 1)
    steps = np.full((1 << n, len(orders)), n + 1)
    for f in range(n):
        np.minimum(steps, masks[:, f, None] + positions[None, f], out=steps)
    return orders, positions, steps


def audit(counts: np.ndarray, filters: str = FILTERS) -> pd.DataFrame:
    """One row for each order and step, from counts of documents (n, good, toxic) x mask."""
    n = len(filters)
    orders, positions, steps = removal_steps(n)
    every = np.arange(len(orders))
    gone = np.zeros((3, len(orders), n + 2), np.int64)  # by measure, order, step
    for measure, weights in zip(gone, counts, strict=True):
        np.add.at(measure, (np.broadcast_to(every, steps.shape), steps), weights[:, None])
    removed, good, toxic = gone[:, :, 1 : n + 1]
    failing = np.array([counts[0][np.arange(1 << n) >> f & 1 == 1].sum() for f in range(n)])
    shapley = np.array([removed[every, positions[f] - 1].sum() for f in range(n)])
    names = np.array(list(filters))
    return pd.DataFrame(
        {
            "filter_order": np.repeat(["".join(names[o]) for o in orders], n),
            "step": np.tile(np.arange(1, n + 1, dtype=np.int32), len(orders)),
            "filter": names[orders].ravel(),
            "kept": (counts[0].sum() - removed.cumsum(1)).ravel(),
            "removed": removed.ravel(),
            "redundant": (failing[orders] - removed).ravel(),
            "unique_fails": counts[0][1 << orders].ravel(),
            "good_lost": good.ravel(),
            "toxic_lost": toxic.ravel(),
            "shapley": shapley[orders].ravel(),
        }
    )


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """What each filter does at each step of each of the 120 orders, by part (lang): a row each, zeros included.

    docs: doc_id, text, lang; labels: doc_id, quality, toxic; other columns are ignored. Null and empty texts have no
    words and fail A (and E beside another one); repeated rows count as often as they come; an empty table has no
    parts. A part comes to a task as at most 32 counts."""
    size = 1 << len(FILTERS)
    parts = mask_counts(docs, labels).groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("counts"))

    def report(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part, found in batch.itertuples(index=False):
                counts = np.zeros((3, size), np.int64)
                for row in found:
                    counts[:, row["mask"]] = row["n"], row["good"], row["toxic"]
                rows = audit(counts)
                rows.insert(0, "part", part)
                yield rows

    return parts.mapInPandas(report, REPORT)
