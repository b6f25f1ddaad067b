"""Mixing sources to target weights.

Every document gets a hash-random key; documents of a source are sorted by it in ranges of the key space, token
counts are summed per range, the ranges' sums are summed up over the (few) ranges of a source, and a running sum
inside each range gives every document its exact place. The cut lies at the source's budget, to the token; a budget
above the source's size repeats whole epochs first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.llm.common import materialise, word_count
from ledgerflow.llm.components import BROADCAST_ROWS


def source_targets(sources: DataFrame, weights: tuple[float, ...] = (1, 2, 3), max_epochs: int = 3) -> DataFrame:
    """source_key, source, source_size -> the same with weight and target.

    Sources by code point, null last, get the weights in turn. Targets share the total by weight; one that would
    exceed max_epochs times its source's size stops there, and the excess is shared by weight among the others until
    none is above. One row a source, so the windows over all rows stay small."""
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    rows = sources.withColumn("weight", w).withColumn("cap", F.col("source_size") * F.lit(float(max_epochs)))
    # In the order of cap / weight, the first sources stop at their caps and the rest share what is left.
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    before, after = by_ratio.rowsBetween(Window.unboundedPreceding, -1), by_ratio.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    rows = rows.withColumn("level", left / F.sum("weight").over(after))
    rows = rows.withColumn("level", F.min(F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.struct(F.col("cap") / F.col("weight"), "level"))).over(everything)["level"])
    return rows.select("source_key", "source", "source_size", "weight", F.least("cap", F.coalesce(F.col("level") * F.col("weight"), F.col("cap"))).alias("target"))


def mix(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), max_epochs: int = 3, seed: str = "mix", range_rows: int = 2_000) -> DataFrame:
    """doc_id, source, size -> doc_id, source, size, source_size, target, epochs, taken.

    taken: tokens of the document that the mix takes, repeats counted: epochs times the whole document, and in the
    last, partial epoch the part of it that lies before the cut. The sum over a source is its target, rounded. Keys
    are digests of seed and doc_id, so reruns agree; rows with equal ids are ordered by size, and equal rows in any
    order, which changes nothing in the result. A null size counts 0, a null source is a source of its own, a null
    doc_id is hashed as such. range_rows: documents in a range of keys, on average."""
    rows = docs.select("doc_id", "source", F.coalesce("size", F.lit(0)).cast("long").alias("size"))
    rows = rows.withColumn("source_key", source_key())
    rows = materialise(rows, "sizes")
    sources = rows.groupBy("source_key").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    ranges = F.ceil(F.col("n") / range_rows).cast("long")
    targets = source_targets(sources.select("source_key", "source", "source_size"), weights, max_epochs)
    targets = targets.drop("source").join(sources.select("source_key", ranges.alias("ranges")), "source_key")
    targets = materialise(targets, "targets")
    # A place in [0, 2^32) by the key's first digits; ranges of equal width hold about equally many documents.
    keyed = rows.join(targets, "source_key").withColumn("key", hash_key(seed))
    keyed = keyed.withColumn("range", F.floor(F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * F.col("ranges") / F.lit(1 << 32)).cast("int"))
    sums = rows_before(keyed)
    # Rows equal in id and size, such as those without an id, have one place: they are one row, with a count, while they are ordered.
    same = keyed.groupBy("source_key", "range", "key", "doc_id", "size").agg(F.count(F.lit(1)).alias("rows"), *[F.first(c).alias(c) for c in ("source", "source_size", "target")])
    inside = Window.partitionBy("source_key", "range").orderBy("key", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = same.join(sums, ["source_key", "range"]).withColumn("first", F.col("offset") + F.coalesce(F.sum(F.col("size") * F.col("rows")).over(inside), F.lit(0)))
    placed = placed.withColumn("nth", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rows") - 1))).withColumn("start", F.col("first") + F.col("nth") * F.col("size"))
    budget = F.floor(F.col("target") + 0.5).cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    rest = F.col("budget") - F.col("epochs") * F.col("source_size") - F.col("start")
    return (
        placed.withColumn("budget", budget)
        .withColumn("epochs", epochs)
        .select("doc_id", "source", "size", "source_size", "target", "epochs", (F.col("epochs") * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest))).alias("taken"))
    )


def source_key() -> Column:
    return F.concat(F.when(F.col("source").isNull(), "-").otherwise("+"), F.coalesce("source", F.lit("")))


def hash_key(seed: str) -> Column:
    return F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))


def mix_documents(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), max_epochs: int = 3, seed: str = "mix") -> DataFrame:
    """docs (doc_id, source, text, any more) plus size in words, target, epochs and taken, as mix() takes them.

    Texts are not moved: a source has one cut in the order of keys and sizes, and each row lies before, behind or at
    it. Rows at the cut are equal in id and size; they get equal parts, rounded down, of what mix() takes of them.
    Columns of docs named like a result give way."""
    made = ["size", "target", "epochs", "taken"]
    own = docs.drop(*made).withColumn("size", word_count(F.col("text")))
    mixed = mix(own.select("doc_id", "source", "size"), weights, max_epochs, seed).withColumn("extra", F.col("taken") - F.col("epochs") * F.col("size"))
    place = F.struct(hash_key(seed).alias("key"), "size")
    placed = materialise(mixed.select(source_key().alias("mix_source"), place.alias("mix_place"), "extra", "target", "epochs"), "mixed")
    cuts = placed.groupBy("mix_source").agg(F.max(F.when(F.col("extra") > 0, F.col("mix_place"))).alias("mix_cut"), F.first("target").alias("target"), F.first("epochs").alias("epochs"))
    cuts = materialise(cuts, "cuts")
    small = cuts.count() <= BROADCAST_ROWS
    few = F.broadcast(cuts) if small else cuts
    at_cut = placed.join(few.select("mix_source", "mix_cut"), "mix_source").where("mix_place = mix_cut").groupBy("mix_source").agg(F.floor(F.sum("extra") / F.count(F.lit(1))).alias("mix_rest"))
    cuts = cuts.join(at_cut, "mix_source", "left")
    joined = own.withColumn("mix_source", source_key()).join(F.broadcast(cuts) if small else cuts, "mix_source").withColumn("mix_place", place)
    extra = F.when(F.col("mix_place") < F.col("mix_cut"), F.col("size")).when(F.col("mix_place") == F.col("mix_cut"), F.col("mix_rest")).otherwise(0)
    taken = (F.col("epochs") * F.col("size") + extra).cast("long").alias("taken")
    return joined.select(*[c for c in docs.columns if c not in made], "size", "target", "epochs", taken)


def rows_before(keyed: DataFrame) -> DataFrame:
    """source_key, range, offset: tokens in the earlier ranges of the source."""
    sums = keyed.groupBy("source_key", "range").agg(F.sum("size").alias("in_range"))
    earlier = Window.partitionBy("source_key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select("source_key", "range", F.coalesce(F.sum("in_range").over(earlier), F.lit(0)).alias("offset"))
