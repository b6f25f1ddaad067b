"""The pipeline's stages on planted cases, and its whole run."""

import random

import pytest

pytest.importorskip("public_tokenizers")
import corpus_pipeline  # noqa: E402

from .test_llm import brute_components, words_of  # noqa: E402


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(12)
    vocabulary = ["".join(rng.choices("abcdefghij", k=rng.randrange(2, 9))) for _ in range(2000)]
    text = lambda n: " ".join(rng.choices(vocabulary, k=n))
    bench = [(i, text(40)) for i in range(5)]
    docs, labels = [], []
    for i in range(400):
        t, toxic = text(rng.choice([30, 120, 400])), int(i % 10 == 3)
        if toxic:
            t += " " + " ".join(rng.choices(["idiot", "scum", "moron"], k=3))
        docs.append((i, t, "en", f"s{i % 4}", len(t)))
        labels.append((i, 1, toxic))
    for i, (source, change) in enumerate([(0, 0), (0, 1), (1, 1), (2, 60)]):
        w = docs[source][1].split()
        for _ in range(change):
            w[rng.randrange(len(w))] = "changed"
        docs.append((400 + i, " ".join(w), "en", "s1", 0))
    docs += [(500 + i, text(50) + " " + b[1].upper() + " " + text(9), "en", "s2", 0) for i, b in enumerate(bench)]
    docs += [(600, None, "en", None, 0), (601, "", None, "s1", 0), (None, text(30), "en", "s1", 0), (8, docs[8][1], "en", "s0", 0)]
    folder = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, docs


def ids(df):
    return sorted((r["doc_id"] for r in df.collect()), key=str)


def test_stages_do_what_they_say(spark, corpus):
    folder, docs = corpus
    df = spark.read.parquet(f"{folder}/documents.parquet")
    kept = corpus_pipeline.drop_toxic(spark, df, folder)
    assert kept.columns == df.columns and set(ids(df)) - set(ids(kept)) == {i for i in range(400) if i % 10 == 3}
    once = corpus_pipeline.drop_near_duplicates(spark, df, folder)
    parts = brute_components([(d[0], d[1]) for d in docs], 5, 80)
    assert once.columns == df.columns and ids(once) == sorted([i for i, (_, c) in parts.items() if c == i] + [None], key=str)
    clean = corpus_pipeline.drop_benchmark_leaks(spark, df, folder)
    assert clean.columns == df.columns and set(ids(df)) - set(ids(clean)) == set(range(500, 505))
    mixed = corpus_pipeline.mix_sources(spark, df, folder).collect()
    assert sum(r["taken"] for r in mixed) == pytest.approx(sum(len(words_of(d[1])) for d in docs), abs=5)


def test_whole_run(spark, corpus):
    folder, docs = corpus
    result = corpus_pipeline.run(spark, folder)
    assert result.columns == ["doc_id", "text", "lang", "source", "n_chars", "size", "target", "epochs", "taken"]
    texts = {d[0]: d[1] for d in docs}
    rows = result.collect()
    assert all(r["text"] == texts[r["doc_id"]] and 0 < r["taken"] <= 3 * r["size"] for r in rows)
    got = {r["doc_id"] for r in rows}
    assert got and not got & {3, 13, 400, 500, 504} and got <= {d[0] for d in docs}
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_jaccard_join", "benchmark_decontamination", "source_mixing"]


def test_of_rows_with_one_id_the_same_stays_at_each_run(spark):
    rows = [(1, f"text number {n}", "x") for n in range(30)] + [(1, None, "y"), (2, "alone", None), (2, "alone", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `odd.name` string")
    runs = [sorted(map(repr, map(tuple, corpus_pipeline.one_row(docs.repartition(n, "text")).collect()))) for n in (1, 3, 7)]
    assert runs[0] == runs[1] == runs[2] and len(runs[0]) == 2
