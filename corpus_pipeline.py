"""A corpus pipeline over `documents`: toxic documents go, near duplicates and benchmark leaks go, the rest is mixed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.llm import decontaminate, mixing, ngram_join, toxicity
from ledgerflow.llm.common import materialise, table
from ledgerflow.llm.components import join_ids

#: Labelled documents that the toxicity chain is fitted on, at most about.
TOXIC_SAMPLE = 20_000


def aside(docs: DataFrame) -> DataFrame:
    """docs with names for all columns but text that can't clash with an operator's."""
    return docs.toDF(*[c if c == "text" else f"own_{i}" for i, c in enumerate(docs.columns)])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain doesn't call toxic.

    Each row is judged by itself, so repeated rows go or stay together; null and empty texts stay."""
    chain = toxicity.toxicity_chain(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"), TOXIC_SAMPLE)
    made = [f"{x}_{c}" for c in chain.categories for x in ("p", "is")]
    return chain.predict(aside(docs)).where("not is_toxic").drop(*made).toDF(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group linked by a Jaccard index of 0.8 on five-word shingles.

    Of rows that share an id one stays, that of the smallest digest of text and then of columns, so reruns agree;
    documents without words or without an id are kept."""
    groups = ngram_join.near_duplicates(docs.select("doc_id", "text"), words=5, percent=80)
    groups = materialise(groups, "groups")
    kept = join_ids(docs, groups.where("component_id <> doc_id").select("doc_id").distinct(), "doc_id", "left_anti")
    repeated = groups.where("doc_id is not null and n_shingles > 0").groupBy("doc_id").count().where("count > 1").select("doc_id")
    if repeated.isEmpty():
        return kept
    return join_ids(kept, repeated, "doc_id", "left_anti").unionByName(one_row(join_ids(kept, repeated, "doc_id", "left_semi")))


def one_row(docs: DataFrame) -> DataFrame:
    """One row for each id; repeats are compared within each task before they move."""
    order = F.struct(F.sha2(F.coalesce("text", F.lit("")), 256), F.to_json(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")])))
    return docs.groupBy("doc_id").agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in docs.columns]), order).alias("own")).select("own.*")


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a region of a benchmark text. Each row is judged by itself; null and empty texts stay."""
    found = decontaminate.contaminated_regions(aside(docs), table(spark, sf_dir, "benchmark"))
    return found.where("n_regions = 0").drop("n_regions", "items", "regions").toDF(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of which the mix takes some, with all their columns, and size, target, epochs and the words taken.

    Null and empty texts have no words, so the mix takes none of them; a null source is one more source. Rows that
    share an id and a size are taken alike."""
    return mixing.mix_documents(docs).where("taken > 0")


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("source_mixing", mix_sources),
]
#: A fitted model, edit distances and shingle sets decide; tests hold the stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's rows are written to the shared folder and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
