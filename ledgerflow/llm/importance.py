"""Importance resampling towards a target distribution.

A tokenizers pre-tokeniser, an untrained Split by a regex, returns the words of an ASCII-lowered text with their
offsets. Windows of neighbouring offsets are the features; the CRC of a feature's bytes names its bucket. Histograms of
the buckets over all documents and over the target texts give each bucket a gain, a document's weight is the mean gain
of its features, and Gumbel noise from a digest of its id turns weights into a draw without replacement.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import islice
from math import floor, log
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.llm.common import materialise

# Words, the numbers of words in a feature, buckets, the share drawn and the words that a drawn document has at least.
WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LONGEST = 2
BUCKETS = 10_000
PERCENT = 25
LEAST_WORDS = 20
SEED = "7"
# End of the fixed values.
#: Characters that are split at once, about; texts are cut between words, so the cuts change nothing.
PIECE = 8_192
_BETWEEN = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]")
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """text in pieces of about size characters that end where no word goes on."""
    at = 0
    while at < len(text):
        gap = _BETWEEN.search(text, at + size)
        end = gap.start() if gap else len(text)
        yield text[at:end]
        at = end


def splitter():
    from tokenizers import Regex, pre_tokenizers

    return pre_tokenizers.Split(Regex(WORDS), "removed", invert=True)


def feature_buckets(text: str, split, longest: int = LONGEST, buckets: int = BUCKETS) -> tuple[int, np.ndarray]:
    """Number of words, and the bucket of each run of 1 to `longest` consecutive words, repeats included.

    A window of offsets slides over the words; the CRC of a longer run goes on from that of the run without its last
    word, behind one space. The last words of a piece are carried into the next one."""
    text = text.encode("utf-8", "surrogatepass").translate(_LOWER).decode("utf-8", "surrogatepass")
    found, carried, n = [], [], 0
    for piece in pieces(text):
        offsets = [span for _, span in split.pre_tokenize_str(piece)]
        words = carried + [b" " + piece[start:end].encode("utf-8", "surrogatepass") for start, end in offsets]
        n += len(offsets)
        old = len(carried)
        runs = [crc32(memoryview(w)[1:]) for w in words]
        found.append(runs[old:])
        for length in range(2, longest + 1):
            runs = list(map(crc32, islice(words, length - 1, None), runs))
            found.append(runs[max(0, old - length + 1) :])
        carried = words[len(words) - min(longest - 1, len(words)) :]
    return n, (np.concatenate([np.array(x, np.uint32) for x in found]) % np.uint32(buckets)).astype(np.uint16) if found else np.zeros(0, np.uint16)


def features(docs: DataFrame, id_col: str | None = "doc_id", text_col: str = "text", longest: int = LONGEST, buckets: int = BUCKETS) -> DataFrame:
    """id, n_words and buckets (two bytes a feature) for every row of docs; none for null and empty texts."""
    if buckets > 1 << 16:
        raise ValueError("a bucket must fit two bytes")
    own = F.col(id_col) if id_col else F.lit(None).cast("long")
    rows = docs.select(own.alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = splitter()
        for batch in batches:
            counts, found = [], []
            for value in batch.column(1):
                n, own = feature_buckets(value.as_py(), split, longest, buckets)
                counts.append(n)
                found.append(own.astype("<u2").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(found, pa.binary())], ["id", "n_words", "buckets"])

    return rows.mapInArrow(take, f"id {rows.schema['id'].dataType.simpleString()}, n_words long, buckets binary")


def histogram(found: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features in each bucket. A task adds up its own rows; what comes to the driver is one row a bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for value in batch.column(0):
                total += np.bincount(np.frombuffer(value.as_buffer(), "<u2"), minlength=buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen], pa.int64())], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for row in found.select("buckets").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * log) of how much likelier a bucket is in the target than in the corpus, both smoothed by one."""
    s_all, t_all = int(corpus.sum()) + len(corpus), int(target.sum()) + len(target)
    return np.array([floor(1000 * log(float((t + 1) * s_all) / float((s + 1) * t_all))) for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def noise(id_: object, seed: str = SEED) -> int:
    """Gumbel noise in thousandths, the same at each run; a null id is hashed as an empty one."""
    h = int(hashlib.sha256(f"{seed}:{'' if id_ is None else id_}".encode()).hexdigest()[:8], 16)
    return floor(-1000 * log(-log((h + 0.5) / 4294967296)))


def scores(found: DataFrame, gains: np.ndarray, seed: str = SEED) -> DataFrame:
    """id, n_words, n_features, weight and score of features(): one look-up and one sum a document."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, weights = [], []
            for value in batch.column(2):
                own = np.frombuffer(value.as_buffer(), "<u2")
                sizes.append(len(own))
                weights.append(int(gains[own].sum()) // len(own) if len(own) else 0)
            total = [w + noise(i, seed) for w, i in zip(weights, batch.column(0).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array(x, pa.int64()) for x in (sizes, weights, total)]], ["id", "n_words", "n_features", "weight", "score"])

    return found.mapInArrow(score, f"id {found.schema['id'].dataType.simpleString()}, n_words long, n_features long, weight long, score long")


def draw(scored: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """scored with rank: 1, 2, 3, ... for the highest scores among rows of least_words words, null for all others.

    floor(percent * rows / 100) rows are drawn; ties go to the smaller id, null ids last. Scores are whole numbers of a
    few ten thousand values at most (thousandths of logarithms of counts and of 32 bits), so a count by score, summed up
    from the top, says where each score's ranks begin. Only rows that reach the last drawn score are then ordered,
    each score by itself; rows equal in everything are one row with a count until then."""
    fit = F.col("n_words") >= least_words
    by_score = materialise(scored.where(fit).groupBy("score").agg(F.count(F.lit(1)).alias("rows")), "scores")
    most = percent * (by_score.agg(F.sum("rows")).first()[0] or 0) // 100
    above = F.sum("rows").over(Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1))
    starts = materialise(by_score.select("score", F.coalesce(above, F.lit(0)).alias("above")).where(F.col("above") < most), "starts")
    lowest = starts.agg(F.min("score")).first()[0]
    out = [*scored.columns, F.lit(None).cast("long").alias("rank")]
    if lowest is None:
        return scored.select(*out)
    reached = fit & (F.col("score") >= lowest)
    equal = scored.where(reached).groupBy(*scored.columns).agg(F.count(F.lit(1)).alias("copies"))
    order = Window.partitionBy("score").orderBy(F.col("id").asc_nulls_last(), "n_features", "n_words", "weight")
    placed = equal.join(F.broadcast(starts), "score").withColumn("last", F.col("above") + F.sum("copies").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    ranked = placed.withColumn("rank", F.explode(F.sequence(F.col("last") - F.col("copies") + 1, F.col("last"))))
    ranked = ranked.select(*scored.columns, F.when(F.col("rank") <= most, F.col("rank")).alias("rank"))
    return ranked.unionByName(scored.where(~F.coalesce(reached, F.lit(False))).select(*out))


def importance_resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: str = SEED, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """id, n_words, n_features, weight, score and rank for every row of docs, drawn towards the texts of target.

    Texts are read once, whole and in pieces of bounded size; what the second pass needs of them, two bytes a feature,
    is written to the shared folder. Null and empty texts have no features, weigh 0 and aren't drawn. Repeated rows are
    drawn as often as they rank, a null id is one more id, an empty target gives every bucket the gain of an unseen
    one, an empty table an empty result; other columns are ignored."""
    found = materialise(features(docs, id_col, text_col), "features")
    gains = bucket_gains(histogram(found), histogram(features(target, None, text_col)))
    scored = materialise(scores(found, gains, seed), "scored")
    return draw(scored, percent, least_words).withColumnRenamed("id", id_col)
