"""Exact k nearest binary codes by incremental multi-index hashing.

Codes are cut into segments and indexed by each segment's value. A code that differs from the query in at most
m * (r + 1) - 1 bits differs in at most r bits in one of the m segments, so once all segments have been probed up to
radius r, every code within that distance is known. The radius grows until the k-th verified distance is covered.
Equal codes are searched once, whatever their number.
"""

from __future__ import annotations

from itertools import combinations
from math import ceil, log2

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.llm.common import materialise

BITS = 64


def sign_code(vector: Column) -> Column:
    """64-bit code of a vector: bit i is set if component i, plus any i + 64, i + 128, ..., is above 0; null for null.

    Missing, null and NaN components count 0."""
    part = lambda i: F.aggregate(F.filter(vector, lambda x, at: (at % BITS == i) & x.isNotNull() & ~F.isnan(x)), F.lit(0.0), lambda a, x: a + x)
    one = lambda i: F.call_function("shiftleft", F.lit(1).cast("long"), i)
    component = lambda i: F.when(F.size(vector) <= BITS, F.nanvl(F.coalesce(F.get(vector, i).cast("double"), F.lit(0.0)), F.lit(0.0))).otherwise(part(i))
    bits = F.aggregate(F.sequence(F.lit(0), F.lit(BITS - 1)), F.lit(0).cast("long"), lambda acc, i: acc.bitwiseOR(F.when(component(i) > 0, one(i)).otherwise(F.lit(0).cast("long"))))
    return F.when(vector.isNotNull(), bits)


def segments_for(n: int) -> list[tuple[int, int]]:
    """(first bit, bits) of each segment: at most log2(n) bits in each, so that a probe finds a code or a few."""
    m = max(1, min(BITS // 4, ceil(BITS / log2(max(16, n)))))
    cuts = [BITS * j // m for j in range(m + 1)]
    return list(zip(cuts, (b - a for a, b in zip(cuts, cuts[1:], strict=False)), strict=False))


def segment(code: Column, first: int, bits: int) -> Column:
    return F.shiftrightunsigned(code, first).bitwiseAND(F.lit((1 << bits) - 1).cast("long"))


def nearest_codes(index: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """For each row of queries (id, code), its k nearest rows of index (id, code) by Hamming distance.

    Returns query_id, rank from 1, neighbour_id, distance. Ties go to the smaller id, null ids last. A query's own id
    is not its neighbour. Rows with a null code are not found and find nothing; rows equal in id and code count once;
    one id with several codes is found by each. With fewer than k other rows all of them are returned. Other columns
    are ignored; empty tables give an empty result."""
    spark = index.sparkSession
    points = index.select("id", "code").where("code is not null").distinct()
    asked = queries.select(F.col("id").alias("query_id"), F.col("code").alias("asked")).where("asked is not null").distinct()
    # The codes of a query's own id are left out in the end: so many more are wanted.
    own = points.join(asked.select(F.col("query_id").alias("id")).distinct(), "id", "left_semi").groupBy("id").count()
    want = k + max(1, own.agg(F.max("count")).first()[0] or 0)
    by_id = Window.partitionBy("code").orderBy(F.col("id").isNull(), "id")
    members = materialise(points.withColumn("place", F.row_number().over(by_id)).where(F.col("place") <= want), "members")
    codes = members.groupBy("code").agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("n"))
    codes = materialise(codes, "codes")
    n_codes = codes.count()
    segs = segments_for(n_codes)
    table = codes.select("code", "low", "n", F.posexplode(F.array(*[segment(F.col("code"), a, b) for a, b in segs])).alias("seg", "value"))
    # bound: distance of the last of `want` codes found so far; what lies beyond it can't be among the nearest
    active = materialise(asked.select("asked").distinct().withColumn("bound", F.lit(BITS)), "asked")
    best = spark.createDataFrame([], "asked long, code long, low long, n long, distance int")
    done, longest = [], max(b for _, b in segs)
    diff = F.col("asked").bitwiseXOR(F.col("code"))
    for radius in range(longest + 1):
        masks = [[sum(1 << i for i in bits) for bits in combinations(range(b), radius)] for _, b in segs]
        probes = active.select("asked", "bound", F.posexplode(F.array(*[segment(F.col("asked"), a, b) for a, b in segs])).alias("seg", "own"))
        flips = F.element_at(F.array(*[F.array(*[F.lit(x) for x in m]).cast("array<long>") for m in masks]), F.col("seg") + 1) if max(map(len, masks)) <= 256 else None
        if flips is None:  # long lists of masks travel as a table of fixed size
            listed = spark.createDataFrame([(s, m) for s, m in enumerate(masks)], "mask_seg int, masks array<long>")
            probes = probes.join(F.broadcast(listed), F.col("seg") == F.col("mask_seg"))
            flips = F.col("masks")
        probes = probes.select("asked", "bound", "seg", F.explode(flips).alias("mask"), "own").select("asked", "bound", "seg", F.col("own").bitwiseXOR(F.col("mask")).alias("probe"))
        # A pair turns up in the first of the segments in which the codes differ least, and nowhere else.
        bits_apart = [F.bit_count(segment(diff, a, b)) for a, b in segs]
        first = F.least(*bits_apart) if len(bits_apart) > 1 else bits_apart[0]
        where = F.coalesce(*[F.when(x == radius, F.lit(i)) for i, x in enumerate(bits_apart)])
        found = probes.join(table, (probes.seg == table.seg) & (probes.probe == table.value) & (first == radius) & (where == probes.seg) & (F.bit_count(diff) <= F.col("bound")))
        found = found.select("asked", "code", "low", "n", F.bit_count(diff).cast("int").alias("distance"))
        nearest = Window.partitionBy("asked").orderBy("distance", F.col("low").isNull(), "low", "code")
        best = best.unionByName(found).withColumn("place", F.row_number().over(nearest)).where(F.col("place") <= want).drop("place")
        best = materialise(best, "best")
        covered = len(segs) * (radius + 1) - 1
        state = best.groupBy("asked").agg(
            F.sum(F.when(F.col("distance") <= covered, F.col("n")).otherwise(0)).alias("sure"), F.when(F.count(F.lit(1)) >= want, F.max("distance")).otherwise(BITS).alias("far")
        )
        finished = F.lit(radius >= longest) | (F.coalesce("sure", F.lit(0)) >= want)
        marked = materialise(active.join(state, "asked", "left").select("asked", F.coalesce("far", "bound").alias("bound"), finished.alias("finished")), "marked")
        done.append(best.join(marked.where("finished"), "asked", "left_semi"))
        active = marked.where("not finished").select("asked", "bound")
        best = best.join(active, "asked", "left_semi")
        if not active.limit(1).count():
            break
    result = done[0]
    for part in done[1:]:
        result = result.unionByName(part)
    in_order = lambda key: Window.partitionBy(key).orderBy("distance", F.col("id").isNull(), "id")
    ids = result.select("asked", "code", "distance").join(members.select("code", "id"), "code")
    ids = ids.withColumn("place", F.row_number().over(in_order("asked"))).where(F.col("place") <= want).select("asked", "id", "distance")
    pairs = asked.join(ids, "asked").where(~F.col("id").eqNullSafe(F.col("query_id")))
    ranked = pairs.withColumn("rank", F.row_number().over(in_order(F.struct("query_id", "asked"))))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias("neighbour_id"), "distance")
