"""Toxicity by classifier chains.

One linear model for each category, in order; the one that decides comes last. A later model also sees the earlier categories' probabilities; while it
is trained these come from models that haven't seen the row (out of fold), so that it meets the same kind of input as
later, in use. Models are fitted on a bounded sample of labelled rows; scoring is a map over all rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import materialise

PREFIXES = (4, 5)
#: Rows for each task that fits a model, about.
FIT_ROWS = 20_000


def terms(text: Column) -> Column:
    """Distinct lower-case words of a text, and their beginnings, marked by a star."""
    words = F.array_distinct(F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != ""))
    starts = [F.transform(F.filter(words, lambda w: F.length(w) >= n), lambda w: F.concat(F.substring(w, 1, n), F.lit("*"))) for n in PREFIXES]  # noqa: B023
    return F.concat(words, F.array_distinct(F.concat(*starts)))


def select_terms(rows: DataFrame, label: str, most: int, folds: int) -> list[list[str]]:
    """For each fold the terms chosen without its rows (terms, fold, label), and last those chosen on all rows.

    Chosen are the `most` terms whose document shares differ most between label 1 and 0, by z-score; ties by code
    point. Terms are counted once, by fold; what is left out is subtracted."""
    n = lambda f, y: F.count(F.when((F.col("fold") == f) & (F.col(label) == y), 1)).alias(f"n{f}_{y}")
    cells = [n(f, y) for f in range(folds) for y in (0, 1)]
    total = rows.agg(*cells).first()
    counts = materialise(rows.select("fold", label, F.explode("terms").alias("term")).groupBy("term").agg(*cells), "toxic-terms")
    chosen = []
    for held in [*range(folds), None]:
        used = [f for f in range(folds) if f != held]
        b, a = (float(sum(total[f"n{f}_{y}"] for f in used)) for y in (0, 1))
        q, p = (reduce(lambda x, y: x + y, [F.col(f"n{f}_{y}") for f in used]) for y in (0, 1))
        if not a or not b:
            chosen.append([])
            continue
        share = (p + q) / (a + b)
        z = (p / a - q / b) / F.sqrt(share * (1 - share) * (1 / a + 1 / b) + 1e-12)
        ranked = counts.where(p + q >= 5).select("term", F.abs(z).alias("z")).where("z > 5").orderBy(F.desc("z"), "term").limit(most)
        chosen.append([r["term"] for r in ranked.collect()])
    return chosen


class Constant:
    """Stands in for a model where the sample has one class only."""

    def __init__(self, p: float):
        self.p = p

    def score(self, df: DataFrame, name: str) -> DataFrame:
        return df.withColumn(name, F.lit(self.p))


class Linear:
    def __init__(self, model, inputs: list[str]):
        self.model, self.inputs = model, inputs

    def score(self, df: DataFrame, name: str) -> DataFrame:
        ready = VectorAssembler(inputCols=self.inputs, outputCol="x_in").transform(df)
        out = self.model.transform(ready)
        return out.withColumn(name, vector_to_array("x_p")[1]).drop("x_in", "x_raw", "x_p", "x_class")


def fit(rows: DataFrame, n: int, inputs: list[str], penalty: float = 0.002):
    """A logistic regression of x_label on inputs over about n rows, weighted by x_weight.

    Each of its steps is a Spark job, of which the driver keeps a record and broadcasts; with few tasks it has few stages."""
    ready = VectorAssembler(inputCols=inputs, outputCol="x_in").transform(rows).select("x_in", "x_label", "x_weight").coalesce(max(4, n // FIT_ROWS))
    return LogisticRegression(
        featuresCol="x_in", labelCol="x_label", weightCol="x_weight", rawPredictionCol="x_raw", probabilityCol="x_p", predictionCol="x_class", regParam=penalty, maxIter=25, standardization=False
    ).fit(ready)


def fit_one(rows: DataFrame, label: str, inputs: list[str], counts: tuple[int, int]) -> Constant | Linear:
    """counts: rows of label 0 and 1."""
    if not all(counts):
        return Constant(float(counts[1] > 0))
    ready = rows.where(F.col(label).isNotNull()).withColumns({"x_label": F.col(label).cast("double"), "x_weight": F.lit(1.0)})
    return Linear(fit(ready, sum(counts), inputs), inputs)


def score_folds(vectors: DataFrame, category: str, earlier: list[str], counts: list[tuple[int, int]]) -> DataFrame:
    """vectors plus p_<category> by the model of all folds but the row's own.

    The folds' models are fitted together: each has inputs of its own, which are 0 in the others' rows, and its rows
    weigh as much as the others' in all, so the sum of their losses and penalties is least where each of them is."""
    name, live = f"p_{category}", [f for f, n in enumerate(counts) if all(n)]
    p = F.lit(None).cast("double")
    for f, n in enumerate(counts):
        p = F.when(F.col("fold") == f, F.lit(float(n[1] > 0))).otherwise(p)
    if not live:
        return vectors.withColumn(name, p)
    at = lambda f, c: F.when(F.col("block") == f, F.col(c)).otherwise(0.0)
    own = {f"x_{c}_{f}": at(f, c) for c in earlier for f in live} | {f"x_one_{f}": (F.col("block") == f).cast("double") for f in live}
    total = sum(sum(counts[f]) for f in live)
    each = [F.struct(F.lit(f).alias("block"), F.col(f"x_terms_{f}").alias("x_own"), F.col(f"{category}_{f}").cast("double").alias("x_label"), F.lit(total / len(live) / sum(counts[f])).alias("x_weight")) for f in live]
    stacked = vectors.select("fold", *earlier, F.explode(F.array(*each)).alias("x")).select("fold", *earlier, "x.*").where("block <> fold and x_label is not null")
    model = Linear(fit(stacked.withColumns(own), total, ["x_own", *own], 0.002 / len(live)), ["x_own", *own])
    terms_of = F.col(f"x_terms_{live[0]}")
    for f in live[1:]:
        terms_of = F.when(F.col("fold") == f, F.col(f"x_terms_{f}")).otherwise(terms_of)
    scored = model.score(vectors.withColumns({"block": F.col("fold"), "x_own": terms_of}).withColumns(own), "x_live")
    return scored.withColumn(name, F.when(F.col("fold").isin(live), F.col("x_live")).otherwise(p)).drop("block", "x_own", "x_live", *own)


class Chain:
    """categories, a model and a threshold for each, and the terms they look at."""

    def __init__(self, categories: list[str], vocabulary: list[str], models: list, thresholds: list[float]):
        self.categories, self.vocabulary, self.models, self.thresholds = categories, vocabulary, models, thresholds

    def predict(self, docs: DataFrame, text_col: str = "text") -> DataFrame:
        """docs plus p_<category> and is_<category> for each category; is_<category> is p >= its threshold.

        Every row comes back once. Null and empty texts have no terms and get what the models say of those; very long
        texts are read whole. Columns of docs that are named like a result give way to it; others keep any name."""
        own = [f"{x}_{c}" for c in self.categories for x in ("p", "is")]
        kept = [c for c in docs.columns if c.lower() not in own]
        aside = [f"own_{i}" for i in range(len(kept))]  # out of the way of the models' columns
        out = with_vectors(docs.select(*[F.col(f"`{c}`").alias(a) for c, a in zip(kept, aside, strict=True)], terms(F.col(text_col).cast("string")).alias("terms")), self.vocabulary).drop("terms")
        for c, model in zip(self.categories, self.models, strict=True):
            out = model.score(out, f"p_{c}")
        return out.select(
            *[F.col(a).alias(c) for c, a in zip(kept, aside, strict=True)], *[f"p_{c}" for c in self.categories], *[(F.col(f"p_{c}") >= t).alias(f"is_{c}") for c, t in zip(self.categories, self.thresholds, strict=True)]
        )


def with_vectors(df: DataFrame, vocabulary: list[str], name: str = "x_terms", terms_col: str = "terms") -> DataFrame:
    """df plus a vector of 0 and 1: which of the vocabulary are among its terms."""
    return CountVectorizerModel.from_vocabulary(vocabulary or ["\x00"], inputCol=terms_col, outputCol=name).setBinary(True).transform(df)


def best_threshold(scored: DataFrame, p: str, label: str) -> float:
    """The threshold of the best F1 out of fold, in steps of 0.05 from 0.3 on; of equals the one nearest to 0.5."""
    grid = [round(0.05 * i, 2) for i in range(6, 19)]
    sums = [F.count(F.when((F.col(p) >= t) & (F.col(label) == y), 1)).alias(f"n{i}_{y}") for i, t in enumerate(grid) for y in (0, 1)]
    got = scored.agg(F.count(F.when(F.col(label) == 1, 1)).alias("positive"), *sums).first()
    f1 = lambda i: 2 * got[f"n{i}_1"] / max(1, got[f"n{i}_1"] + got[f"n{i}_0"] + got["positive"])
    return grid[max(range(len(grid)), key=lambda i: (round(f1(i), 6), -abs(grid[i] - 0.5)))]


def toxicity_labels(labels: DataFrame) -> DataFrame:
    """doc_id, poor, toxic: the categories of the tables' labels, poor being what isn't of quality."""
    return labels.select("doc_id", (1 - F.col("quality").cast("int")).alias("poor"), "toxic")


def toxicity_chain(docs: DataFrame, labels: DataFrame, max_rows: int) -> Chain:
    """The chain poor, dense, toxic, fitted on at most about max_rows of the labelled docs (doc_id, text).

    labels: doc_id, quality, toxic, of which each may be null. p_toxic uses p_poor and p_dense."""
    return train_chain(labelled_sample(docs, toxicity_labels(labels), max_rows), ["poor", "toxic"], dense="toxic")


def labelled_sample(docs: DataFrame, labels: DataFrame, max_rows: int, seed: int = 11) -> DataFrame:
    """Rows of docs with their labels, at most about max_rows, drawn by a hash of doc_id.

    The drawn labels, bounded by max_rows, are what is broadcast; texts stay where they are. A doc_id that is labelled
    several times has the larger of its labels. Columns of docs that are named like one of labels give way to it."""
    one = labels.where("doc_id is not null").groupBy("doc_id").agg(*[F.max(c).alias(c) for c in labels.columns if c != "doc_id"])
    share = 1.1 * max_rows / max(1, one.count())
    place = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 30)) / F.lit(1 << 30)
    docs = docs.drop(*[c for c in labels.columns if c != "doc_id"])
    return docs.join(F.broadcast(one.where(place < share).orderBy(place, "doc_id").limit(max_rows)), "doc_id")


def train_chain(sample: DataFrame, categories: list[str], folds: int = 3, max_terms: int = 2_000, dense: str | None = None, seed: int = 11) -> Chain:
    """A chain fitted on sample (doc_id, text, a column of 0/1 for each category; null: not labelled).

    dense: a category in front of which `dense` is put: its rows whose share of its terms among their words is at
    least the median of such rows. A category with one class only gets that class as its constant probability; an empty
    sample gives 0.

    What a row's out-of-fold probability rests on, its terms, the category `dense` and the model, is made without the
    rows of its fold."""
    rows = sample.select("doc_id", *categories, F.coalesce(F.col("text"), F.lit("")).alias("text"))
    fold = F.pmod(F.xxhash64("doc_id", F.lit(seed + 1)), F.lit(folds)).cast("int")
    rows = materialise(rows.select("doc_id", *categories, terms(F.col("text")).alias("terms"), fold.alias("fold")), "toxic-sample")
    chosen = {c: select_terms(rows, c, max_terms, folds) for c in categories}
    labels, order = [f"{c}_{f}" for c in categories for f in range(folds + 1)], list(categories)
    wide = rows.select("doc_id", "fold", "terms", *[F.col(c).alias(f"{c}_{f}") for c in categories for f in range(folds + 1)])
    # All that depends on labels is made without fold f; the last time on all rows. Terms of a fold are told apart by its number.
    own = [sorted(set().union(*(chosen[c][f] for c in categories))) for f in range(folds + 1)]
    tagged = [f"{f}:{t}" for f in range(folds) for t in own[f]]
    for f in range(folds):
        wide = with_vectors(wide.withColumn("tagged", F.transform("terms", lambda t: F.concat(F.lit(f"{f}:"), t))), tagged, f"x_terms_{f}", "tagged").drop("tagged")  # noqa: B023
    wide = with_vectors(wide, own[folds], f"x_terms_{folds}")
    if dense:
        labels += [f"dense_{f}" for f in range(folds + 1)]
        order.insert(order.index(dense), "dense")
        wide = with_density(wide, dense, chosen[dense])
    vectors = materialise(wide.select("doc_id", "fold", *labels, *[f"x_terms_{f}" for f in range(folds + 1)]), "toxic-vectors")
    classes = vectors.agg(*[F.count(F.when((F.col("fold") != f) & (F.col(f"{c}_{f}") == y), 1)).alias(f"{c}_{f}_{y}") for c in order for f in range(folds + 1) for y in (0, 1)]).first()
    earlier, models, thresholds = [], [], []
    for c in order:
        *counts, every = [(classes[f"{c}_{f}_0"], classes[f"{c}_{f}_1"]) for f in range(folds + 1)]
        final = fit_one(vectors, f"{c}_{folds}", [f"x_terms_{folds}", *earlier], every)
        vectors = materialise(score_folds(vectors, c, earlier, counts), "toxic-folds")
        models.append(final if isinstance(final, Constant) else Linear(final.model, ["x_terms", *earlier]))
        thresholds.append(best_threshold(vectors, f"p_{c}", f"{c}_{folds}"))
        earlier = [*earlier, f"p_{c}"]
    return Chain(order, own[folds], models, thresholds)


def with_density(rows: DataFrame, category: str, own_terms: list[list[str]]) -> DataFrame:
    """rows plus dense_<f> for each fold f and one number more: 1 for those of the category (column <category>_<f>) that
    hold the terms own_terms[f] most densely, 0 for others, null where it is null.

    Densely is at least as densely as the median of the category's rows without those of fold f."""
    scored, middle = rows, []
    for f, some in enumerate(own_terms):
        hits = F.size(F.filter(vector_to_array("x_some"), lambda x: x > 0))
        scored = with_vectors(scored, some, "x_some").withColumn(f"density_{f}", hits / F.greatest(F.size("terms"), F.lit(1))).drop("x_some")
        middle.append(F.percentile(F.when((F.col(f"{category}_{f}") == 1) & (F.col("fold") != f), F.col(f"density_{f}")), 0.5).alias(f"middle_{f}"))
    found = scored.agg(*middle).first()
    for f in range(len(own_terms)):
        least = found[f"middle_{f}"]
        is_dense = (F.col(f"{category}_{f}") == 1) & (F.col(f"density_{f}") >= F.lit(least if least is not None else 0.0))
        scored = scored.withColumn(f"dense_{f}", F.when(F.col(f"{category}_{f}").isNotNull(), is_dense.cast("int")))
    return scored.drop(*[f"density_{f}" for f in range(len(own_terms))])
