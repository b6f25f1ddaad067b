"""Each operator against brute force, and in the cases that break things: nulls, empty and long texts, ties, repeats,
empty tables, clashing columns."""

import hashlib
import random
import re
import tracemalloc
from math import log2
from types import SimpleNamespace

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")
from ledgerflow.llm import chat_format, common, components, decontaminate, hamming_search, license_scan, mixing, ngram_join, queries, token_counts, toxicity, url_filter, warc  # noqa: E402
from ledgerflow.llm.common import word_count  # noqa: E402

from ..compare import canonical, duck  # noqa: E402

DOCS = "doc_id long, text string, source string"


# ---- registered queries
@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_oracle(spark, data, name):
    got, want = queries.QUERIES[name](spark, data).toPandas(), duck(data).execute(queries.ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and canonical(got) == canonical(want)


def test_intermediates_can_be_cleared(spark):
    df = common.materialise(spark.range(3), "cleared")
    assert df.count() == 3
    common.clear(spark)
    with pytest.raises(Exception, match="cleared-"):
        df.count()


def test_a_cluster_needs_a_shared_folder():
    nowhere = SimpleNamespace(get=lambda *_: None)
    context = SimpleNamespace(getConf=lambda: nowhere, master="spark://host:7077", applicationId="app")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.shared_dir(SimpleNamespace(conf=nowhere, sparkContext=context))


# ---- 1
def codes(spark, rows):
    return spark.createDataFrame(rows, "id long, code long, extra string")


def test_nearest_codes_equal_brute_force(spark):
    rng = random.Random(3)
    base = [rng.getrandbits(64) - (1 << 63) for _ in range(40)]
    rows = [(i, base[i % 40] ^ (1 << rng.randrange(62)) if i % 3 else base[i % 40], "x") for i in range(300)] + [(900, None, "x"), (None, base[0], "x"), (7, base[7 % 40] ^ 2, "x")]
    index = codes(spark, rows)
    got = {(r["query_id"], r["rank"]): (r["neighbour_id"], r["distance"]) for r in hamming_search.nearest_codes(index, index.where("id % 50 = 0 or id = 900"), 5).collect()}
    distinct = {(i, c) for i, c, _ in rows if c is not None}
    for q, c in [(i, c) for i, c in distinct if i is not None and i % 50 == 0]:
        near = sorted(((bin((c ^ d) & (1 << 64) - 1).count("1"), i is None, i or 0, i) for i, d in distinct if i != q))[:5]
        assert [got[q, k + 1] for k in range(5)] == [(x[3], x[0]) for x in near]
    assert not any(q == 900 for q, _ in got)


def test_nearest_codes_of_an_id_with_several_codes(spark):
    rows = [(0, c, "x") for c in range(6)] + [(i, 1 << (i % 60), "x") for i in range(1, 40)]
    index = codes(spark, rows)
    got = hamming_search.nearest_codes(index, index.where("id = 0"), 10).collect()
    assert len(got) == 60 and not any(r["neighbour_id"] == 0 for r in got)


def test_nearest_codes_of_few_rows_and_none(spark):
    two = codes(spark, [(0, 5, "x"), (100, -6, "x")])
    got = hamming_search.nearest_codes(two, two, 10).collect()
    assert {(r["query_id"], r["neighbour_id"], r["distance"]) for r in got} == {(0, 100, 64), (100, 0, 64)}
    assert hamming_search.nearest_codes(two.limit(0), two.limit(0), 3).count() == 0


def test_sign_code(spark):
    df = spark.createDataFrame([([1.0, -1.0] * 32,), ([0.5],), (None,), ([None, float("nan"), 2.0],), ([1.0] * 64 + [-2.0],)], "v array<float>")
    got = [r[0] for r in df.select(hamming_search.sign_code(F.col("v"))).collect()]
    assert got[0] == 0x5555555555555555 and got[1] == 1 and got[2] is None and got[3] == 4 and got[4] == -2


# ---- 2
def words_of(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")) if w]


def shingles(text, n):
    w = words_of(text)
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def brute_components(rows, n, percent):
    sets, up = {i: shingles(t, n) for i, t in rows if i is not None}, {i: i for i, _ in rows if i is not None}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                up[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80), (1, 60)])
def test_join_equals_brute_force(spark, n, percent):
    rng = random.Random(n)
    vocabulary = [f"w{i}" for i in range(300)]
    passage = " ".join(rng.choices(vocabulary, k=40))
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, "one"), (4, "ONE"), (5, "one two"), (6, "one two"), (7, "İx ×"), (None, "one two")]
    for k in range(160):
        base = rng.choices(vocabulary, k=rng.choice([4, 9, 25, 60, 200]))
        for _ in range(rng.choice([1, 1, 4])):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 5])):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            rows.append((10 + len(rows), rng.choice([" ", "\n"]).join(w) + (" " + passage if k % 4 == 0 else "")))
    df = spark.createDataFrame([(i, t, "s") for i, t in rows], "doc_id long, text string, name string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.near_duplicates(df, n, percent, tile_docs=7, pack_docs=20).collect()}
    assert got.pop(None)[1] is None
    assert got == brute_components(rows, n, percent)


def test_join_takes_repeats_and_nothing(spark):
    df = spark.createDataFrame([(5, "a b c d e f"), (5, "a b c d e f"), (3, "a b c d e f"), (3, "x y z")], "doc_id long, text string")
    assert sorted((r["doc_id"], r["component_id"]) for r in ngram_join.near_duplicates(df).collect()) == [(3, 3), (3, 3), (5, 3), (5, 3)]
    assert ngram_join.near_duplicates(df.limit(0)).count() == 0


def test_join_of_a_table_with_itself(spark):
    rng = random.Random(5)
    rows = []
    for _ in range(30):
        base = rng.choices([f"w{i}" for i in range(300)], k=60)
        for _ in range(2):
            w = list(base)
            w[rng.randrange(len(w))] = "other"
            rows.append((len(rows), " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = ngram_join.near_duplicates(df.unionByName(df), 3, 80).collect()
    want = brute_components(rows, 3, 80)
    assert len({c for _, c in want.values()}) == 30
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == sorted((i, *x) for i, x in want.items() for _ in range(2))


def test_join_of_ids_with_several_texts(spark):
    rng = random.Random(6)
    texts = [rng.choices([f"w{i}" for i in range(300)], k=n) for n in (40, 40, 41, 400, 40)]
    a, b, c, d, e = (" ".join(t) for t in texts)
    near = lambda t: " ".join([*t.split()[:-1], "other"])
    # 5 is a copy of 3 and near 9; 7 is a copy of 6 and of 12; 2 is near 6 and, by a long text, near 21
    rows = [(3, a), (5, a), (5, near(b)), (9, b), (6, c), (7, c), (7, e), (12, e), (2, near(c)), (2, near(d)), (21, d), (5, a)]
    got = ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 80, tile_docs=2).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {3: 3, 5: 3, 9: 3, 6: 2, 7: 2, 12: 2, 2: 2, 21: 2}
    assert sorted((r["doc_id"], r["n_shingles"]) for r in got) == sorted((i, len(shingles(t, 3))) for i, t in rows)


@settings(max_examples=60, deadline=None)
@given(st.integers(2, 400), st.integers(0, 40), st.integers(0, 2**32), st.sampled_from([50, 80, 90, 95]))
def test_similar_sets_share_a_key(size, changes, seed, percent):
    rng = np.random.default_rng(seed)
    a = np.unique(rng.integers(0, 2**64, size, dtype=np.uint64))
    keep = a[rng.permutation(len(a))[: max(1, len(a) - changes // 2)]]
    b = np.unique(np.concatenate((keep, rng.integers(0, 2**64, changes - changes // 2, dtype=np.uint64))))
    both = len(np.intersect1d(a, b))
    if 100 * both >= percent * (len(a) + len(b) - both) and not np.array_equal(a, b):
        ranks = np.tile(rng.integers(0, 9, 1 << 16, dtype=np.uint8), 1 << ngram_join.SKETCH_BITS - 16)
        assert set(ngram_join.prefix_keys(a, percent, ranks).tolist()) & set(ngram_join.prefix_keys(b, percent, ranks).tolist())


def test_sketch_counts_what_it_saw():
    rng = np.random.default_rng(2)
    sketch, want = ngram_join.Sketch(most=1000), np.zeros(1 << ngram_join.SKETCH_BITS, np.int64)
    for n in (0, 5, 700, 3000, 1):
        hashes = rng.integers(0, 2**64, n, dtype=np.uint64) >> np.uint64(rng.integers(0, 45)) << np.uint64(3)
        sketch.add(hashes)
        want += np.bincount(ngram_join.counters(hashes), minlength=len(want))
    got = np.zeros_like(want)
    for block, packed in sketch.blocks():
        at, counts = ngram_join.unpacked(packed)
        got[at + (block << ngram_join.BLOCK_BITS)] += counts
    assert np.array_equal(got, want) and list(ngram_join.Sketch().blocks()) == []


def test_unrelated_sets_and_a_shared_passage_give_no_common_key():
    rng = np.random.default_rng(1)
    passage = rng.integers(0, 2**64, 48, dtype=np.uint64)
    for size in (20, 100, 1000):
        sets = [np.unique(np.concatenate((rng.integers(0, 2**64, size, dtype=np.uint64), passage if k % 3 == 0 else passage[:0]))) for k in range(1000)]
        counts = np.bincount(ngram_join.counters(np.concatenate(sets)), minlength=1 << ngram_join.SKETCH_BITS)
        ranks = np.minimum(255, 8 * np.log2(counts + 1.0)).astype(np.uint8)
        keys = np.unique(np.concatenate([ngram_join.prefix_keys(s, 80, ranks) for s in sets]), return_counts=True)[1]
        assert keys.max() == 1


def test_large_families_take_no_pair_of_tiles_twice(spark):
    rng = random.Random(9)
    base = rng.choices([f"w{i}" for i in range(300)], k=80)
    rows = [(k, " ".join([*base[:40], f"x{k}", *base[41:]])) for k in range(120)] + [(500, " ".join([*base[:30], *["y"] * 4, *base[34:]]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.near_duplicates(df, 3, 80, tile_docs=10, pack_docs=20).collect()}
    assert got == brute_components(rows, 3, 80)


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 400), (400, 500), (7, 7)], "a long, b long")
    got = {r["node"]: r["component"] for r in components.components(edges).collect()}
    assert got == {**{i: 0 for i in range(201)}, 400: 400, 500: 400}
    assert components.components(edges.limit(0)).count() == 0


# ---- 3
MESSAGES = "tree long, node long, parent long, role string, text string, score double"


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="<[\\/]>sINSTROLE \n", max_size=30))
def test_escape_is_reversible(text):
    escaped = re.sub(r"([<\[\\])", r"\1\\", text)
    assert chat_format.unescape(escaped) == text
    assert not any(m in escaped for pair in chat_format.MARKS.values() for m in pair)


def test_best_branch_of_a_tree(spark):
    rows = [(1, 1, None, "user", "q", 0.0), (1, 2, 1, "assistant", "bad", 1.0), (1, 3, 1, "assistant", "good </s>", 2.0), (1, 4, 3, "user", None, None), (1, 5, 2, "tool[x]", "t", 0.5), (2, 1, 9, "system", "orphan", 1.0), (3, 1, 2, "user", "cycle", 1.0), (3, 2, 1, "user", "cycle", 1.0), (None, 1, None, None, "n", 1.0)]
    got = {(r["tree"], r["path"]): r for r in chat_format.format_chats(spark.createDataFrame(rows, MESSAGES), per_tree=2).collect()}
    assert set(got) == {(1, 1), (1, 2), (2, 1), (None, 1)}
    assert chat_format.parse(got[1, 1]["formatted"]) == [("user", "q"), ("assistant", "good </s>"), ("user", "")]
    assert chat_format.parse(got[1, 2]["formatted"]) == [("user", "q"), ("assistant", "bad"), ("tool[x]", "t")]
    assert chat_format.parse(got[None, 1]["formatted"]) == [("", "n")]
    (span,) = got[1, 1]["loss_spans"]
    assert chat_format.unescape(got[1, 1]["formatted"][span["start"] : span["end"]]) == "good </s>"


def test_branches_equal_brute_force(spark):
    rng = random.Random(21)
    rows, want = [], set()
    for tree in range(12):
        n = rng.choice([1, 2, 9, 40])
        parent = {i: rng.choice([None, 99, *range(i)]) if i == 0 or rng.random() < 0.1 else rng.randrange(max(0, i - 4), i) for i in range(n)}
        score = {i: rng.choice([None, 0.0, 0.5, 1.0]) for i in range(n)}
        rows += [(tree, i, parent[i], "user", str(i), score[i]) for i in range(n)]
        paths = []
        for leaf in set(range(n)) - set(parent.values()):
            path = [leaf]
            while parent[path[-1]] is not None and parent[path[-1]] < n:
                path.append(parent[path[-1]])
            paths.append((-sum(score[i] or 0.0 for i in path), leaf, path[::-1]))
        for rank, (_, _, path) in enumerate(sorted(paths)[:3], 1):
            want |= {(tree, rank, node, place) for place, node in enumerate(path)}
    got = chat_format.best_paths(spark.createDataFrame(rows, MESSAGES), per_tree=3)
    assert {tuple(r) for r in got.select("tree", "path", "node", "position").collect()} == want


def test_deep_tree_and_empty_table(spark):
    deep = spark.createDataFrame([(1, i, i - 1 if i else None, "user", str(i), 1.0) for i in range(100)], MESSAGES)
    got = chat_format.format_chats(deep).first()
    assert [t for _, t in chat_format.parse(got["formatted"])] == [str(i) for i in range(100)]
    assert chat_format.format_chats(deep.limit(0)).count() == 0


def test_conversation_digests(spark, data):
    got = {r["conv_id"]: r for r in queries.op3_chat_format(spark, data).collect()}
    turns = {}
    for r in duck(data).execute("select conv_id, role, coalesce(text, '') from conversations order by conv_id, turn, role, text").fetchall():
        turns.setdefault(r[0], []).append(r[1:])
    turns[-1] = [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert set(got) == set(turns)
    for c, own in turns.items():
        loss = "".join(t for r, t in own if r == "assistant")
        assert (got[c]["n_turns"], got[c]["turns_sha256"], got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(own), sha("".join(f"{r}\n{t}\n" for r, t in own)), len(loss), sha(loss))


# ---- 4
def test_rules_and_parts(spark):
    rows = [("http://A.Net/x", "a.net", "/x", "net/"), ("https://b.example.NET/en/1?q", "b.example.net", "/en/1", "example.net/en/"), ("http://example.com/de/", "example.com", "/de/", "example.com/de/"), ("http://notexample.com/de/", "notexample.com", "/de/", None),
            ("http://x.net", "x.net", "", None), ("http://x.org#/fr/", "x.org", "", None), ("a://b://c", "b:", "//c", None), ("no scheme", "", "", None), (None, "", "", None), ("://", "", "", None)]
    df = spark.createDataFrame([(i, r[0]) for i, r in enumerate(rows)], "i int, url string").withColumns({"host": url_filter.host_of(F.col("url")), "path": url_filter.path_of(F.col("url"))})
    got = df.withColumn("rule", url_filter.rule_for(F.col("host"), F.col("path"), queries.URL_RULES)[0]).orderBy("i").collect()
    assert [(r["url"], r["host"], r["path"], r["rule"]) for r in got] == rows


def test_trees_learn_from_labelled_urls(spark):
    rng = random.Random(5)
    word = lambda n: "".join(rng.choices("abcdefgh", k=n))
    bad = lambda: f"http://{word(5)}-{word(4)}.{word(3)}.example.org/{rng.randrange(10**9)}?a={rng.randrange(10**6)}&b=2&c=3"
    good = lambda: f"https://{word(6)}.example.org/{word(4)}/{word(5)}.html"
    rows = [(i, bad() if i % 2 else good(), i % 2) for i in range(600)] + [(900, None, None), (901, "x", None)]
    df = spark.createDataFrame(rows, "page_id int, url string, label int")
    model = url_filter.train(df.where("page_id < 400"), trees=4)
    judged = url_filter.filter_urls(df.withColumn("verdict", F.lit("old")), (), model)
    held = judged.where("page_id between 400 and 599").select("label", "verdict").collect()
    assert sum((r["verdict"] == "block") == (r["label"] == 1) for r in held) >= 0.95 * len(held)
    assert judged.count() == 602 and judged.where("verdict is null").count() == 0
    assert url_filter.filter_urls(df.limit(0), (), model).count() == 0
    assert url_filter.train(df.limit(0), trees=1).rate == 0.5


def test_verdicts_on_all_pages(spark, data):
    """Host, path and rule of every page by plain Python; a hot URL doesn't break the bound of the sample."""
    rows = spark.read.parquet(f"{data}/pages.parquet").select("page_id", "url").collect()
    got = {r["page_id"]: r for r in queries.op4_url_filter(spark, data).collect()}
    assert len(got) == len(rows)
    wrong = 0
    for page, url in rows:
        _, there, rest = (url or "").partition("://")
        host, path = re.match(r"([^/?#]*)([^?#]*)", rest if there else "", re.DOTALL).groups()
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
        fits = [(rule, v) for v, rule in queries.URL_RULES for name, _, tail in [rule.partition("/")] if (host == name or host.endswith("." + name)) and path.startswith("/" + tail)]
        rule, verdict = max(fits, key=lambda x: len(x[0]), default=(None, None))
        r = got[page]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert verdict is None or r["verdict"] == verdict
        wrong += verdict is None and (r["verdict"] == "block") != bool(set(re.split("[.-]", host)) & set(queries.BLOCK_WORDS))
    assert wrong <= 0.02 * len(rows)
    hot = spark.range(3000).select(F.lit("http://a-b.example.com/x").alias("url"), F.col("id").alias("key"), (F.col("id") % 2).alias("label"))
    assert url_filter.train(hot, max_rows=300, trees=1).rate == 0.5


def test_trees_find_hosts_of_words_they_were_not_told(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url")
    host = url_filter.host_of(F.col("url"))
    known, hidden = url_filter.listed(host, ("casino", "bets", "spam", "pills")), url_filter.listed(host, ("ads", "adult"))
    model = url_filter.train(pages.where(~hidden).select("url", known.cast("int").alias("label")), trees=6)
    found = url_filter.filter_urls(pages.where(hidden), (), model)
    assert found.where("verdict = 'block'").count() >= 0.8 * found.count() > 0


def test_entropy(spark):
    texts = ["", "aaaa", "ab", "http://x.org/?q=1"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(url_filter.entropy(F.col("t"))).collect()]
    want = [-sum(t.count(c) / len(t) * log2(t.count(c) / len(t)) for c in set(t)) if t else 0.0 for t in texts]
    assert got == pytest.approx(want)


# ---- 5
def test_archives_round_trip(spark, tmp_path):
    long, tricky = "long é " * 9000, "WARC/1.1\r\n\r\n0\r\n\r\n"
    rows = [(1, "http://a", long), (2, "http://b\nc", tricky), (3, None, tricky), (4, "u", None), (5, "u", ""), (6, "u", tricky), (None, "n", "only"), (6, "z", tricky), (None, "n", "only"), (7, "u", long + "!")]
    df = spark.createDataFrame(rows, "capture_id long, url string, html string").withColumn("payload", F.encode("html", "UTF-8"))
    at = warc.write_archives(df, str(tmp_path / "w"), segment_bytes=5000, chunk_bytes=1000, records_per_file=3)
    records = warc.read_archives(spark, at)
    assert records.where("record_type = 'continuation'").count() > 10
    whole = warc.reassemble(records).collect()
    assert len(whole) == len(rows) and len({r["record_id"] for r in whole}) == len(rows)
    ids = {r["record_id"] for r in whole if r["record_type"] == "response"}
    assert all(r["refers_to"] in ids for r in whole if r["record_type"] == "revisit")
    number = lambda x: x and (x.split(":")[2], x.split(":")[4])
    got = {number(r["record_id"]): r for r in whole}
    assert {k: (r["record_type"], r["status"], number(r["refers_to"])) for k, r in got.items()} == {
        ("1", "0"): ("response", "ok", None), ("2", "0"): ("revisit", "ok", ("6", "0")), ("3", "0"): ("revisit", "ok", ("6", "0")), ("4", "0"): ("revisit", "ok", ("5", "0")), ("5", "0"): ("response", "ok", None),
        ("6", "0"): ("response", "ok", None), ("6", "1"): ("revisit", "ok", ("6", "0")), ("", "0"): ("response", "ok", None), ("", "1"): ("revisit", "ok", ("", "0")), ("7", "0"): ("response", "ok", None),
    }
    assert got["1", "0"]["payload"] == long.encode() and got["6", "0"]["payload"] == tricky.encode() and got["5", "0"]["payload"] == b""
    broken = records.where("not (record_type = 'continuation' and segment = 3)")
    assert {r["status"] for r in warc.reassemble(broken).collect() if r["record_id"].split(":")[2] in "17" and r["record_id"].split(":")[2]} == {"missing segment"}
    short = records.withColumn("total_length", F.col("total_length") + 1)
    assert "wrong total length" in {r["status"] for r in warc.reassemble(short).collect()}
    few = warc.read_archives(spark, warc.write_archives(df, str(tmp_path / "x"), min_revisit_bytes=10**6)).where("record_type <> 'continuation'")
    assert few.where("record_type = 'revisit'").count() == 0 and few.select("record_id").distinct().count() == len(rows)


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=300), st.integers(1, 50))
def test_chunked_framing(payload, chunk):
    framed = warc.chunked(payload, chunk)
    assert warc.unchunked(framed) == payload
    with pytest.raises(ValueError):
        warc.unchunked(framed[:-6] if payload else b"")


# ---- 6
def brute_edits(pattern, text):
    """Least edits between pattern and any stretch of text."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j - 1] + (p != t), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def warc_record(kind, rid, block, length=None, **fields):
    head = {"WARC-Type": kind, "WARC-Record-ID": f"<{rid}>", **{k.replace("_", "-"): v for k, v in fields.items()}, "Content-Length": len(block) if length is None else length}
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()).encode() + b"\r\n" + block + b"\r\n\r\n"


def test_damaged_archives_lose_nothing_silently(spark, tmp_path):
    http = b"HTTP/1.1 200 OK\r\n\r\nbody"
    part = lambda n, block, **more: warc_record("response" if n == 1 else "continuation", f"s{n}", block, WARC_Segment_Number=n, WARC_Segment_Origin_ID="<s1>", **more)
    twice = lambda n, block, **more: warc_record("response" if n == 1 else "continuation", f"d{n}{block[:1]}", block, WARC_Segment_Number=n, WARC_Segment_Origin_ID="<d1>", **more)
    (tmp_path / "a.warc").write_bytes(
        warc_record("response", "good", http) + warc_record("response", "text", http, "many") + warc_record("response", "minus", http, "-4") + warc_record("response", "none", http, "") + warc_record("response", "after", http)
        + part(1, http[:9]) + part(2, http[9:], WARC_Segment_Total_Length=len(http)) + part(2, http[9:], WARC_Segment_Total_Length=len(http))
        + twice(1, http[:9]) + twice(2, http[9:], WARC_Segment_Total_Length=len(http)) + twice(2, http[9:-1] + b"?", WARC_Segment_Total_Length=len(http))
        + warc_record("response", "cut", http)[:-8]
    )
    got = {r["record_id"]: (r["payload"], r["status"]) for r in warc.reassemble(warc.read_archives(spark, str(tmp_path))).collect()}
    whole = (bytearray(b"body"), "ok")
    assert got == {"good": whole, "after": whole, "s1": whole, "text": (None, "malformed length"), "minus": (None, "malformed length"), "none": (None, "malformed length"), "d1": (None, "two segments of one number"), "cut": (None, "cut off")}


def test_many_segments_are_joined_once(spark, tmp_path):
    payload = bytes(range(256)) * 8000
    df = spark.createDataFrame([(1, "http://a/", payload)], "capture_id long, url string, payload binary")
    whole = warc.reassemble(warc.read_archives(spark, warc.write_archives(df, str(tmp_path / "w"), segment_bytes=300))).first()
    assert whole["status"] == "ok" and bytes(whole["payload"]) == payload


def test_mixing_rows_without_ids(spark):
    """Rows equal in id and size share a place, however many there are; the mix is cut to the word."""
    rows = [(None, "a", 7)] * 500 + [(i, "a", 5) for i in range(40)] + [(3, "a", 5)] * 9 + [(100 + i, "b", 11) for i in range(30)] + [(None, None, 0)] * 3
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string, size long"), range_rows=10).collect()
    assert len(got) == len(rows)
    for source in ("a", "b"):
        mine = [r for r in got if r["source"] == source]
        assert sum(r["taken"] for r in mine) == int(mine[0]["target"] + 0.5) and all(0 <= r["taken"] <= 3 * r["size"] for r in mine)


def test_sketches_of_many_tasks_add_up(spark):
    rng = np.random.default_rng(5)
    rows, want = [], np.zeros(1 << ngram_join.SKETCH_BITS, np.int64)
    for piece in [*range(200), 5_000, 300_000, 300_001]:
        sketch = ngram_join.Sketch()
        hashes = rng.integers(0, 1 << 63, 50, np.uint64) * np.uint64(2)
        sketch.add(np.concatenate((hashes[:5].repeat(3), hashes)))
        np.add.at(want, ngram_join.counters(np.concatenate((hashes[:5].repeat(3), hashes))), 1)
        rows += [(block, piece, bytearray(packed)) for block, packed in sketch.blocks()]
    got = ngram_join.sketch_ranks(spark.createDataFrame(rows, "block int, piece int, counts binary"))
    assert (got == np.minimum(255, 8 * np.log2(want + 1.0)).astype(np.uint8)).all() and len(rows) > 2_000


@pytest.mark.parametrize("near", [True, False])
def test_pairs_of_tiles_equal_brute_force(spark, near):
    rng = random.Random(6)
    rows = []
    for family, tiles in ((1, 9), (2, 2), (3, 1), (4, 30)):
        for tile in range(tiles):
            rows += [(len(rows) + i, family, tile, 10 * tile + 20 + i, rng.choice([7, len(rows) + i])) for i in range(3)]
    frame = spark.createDataFrame(rows, "doc_id long, family long, tile int, n long, known long")
    got = {(r["doc_id"], r["pack"], r["one"], r["other"], r["side"]) for r in ngram_join.tile_pairs(frame, 80, 500, 2_000_000, near).collect() if r["pack"] >= 0}
    want = set()
    for family in (1, 2, 4):
        of = {t: [r for r in rows if r[1] == family and r[2] == t] for t in {r[2] for r in rows if r[1] == family}}
        for a in of:
            for b in of:
                both = of[a] + of[b]
                wanted = 0 <= b - a <= 1 if near else b - a > 1 and len({r[4] for r in both}) > 1
                if wanted and min(r[3] for r in of[b]) * 80 <= max(r[3] for r in of[a]) * 100:
                    want |= {(r[0], family, a, b, side) for side, t in ((0, a), (1, b)) if side == 0 or a < b for r in of[t]}
    assert got == want


def test_regions_equal_brute_force():
    rng = random.Random(8)
    text = lambda n: "".join(rng.choices("abcdefg ", k=n)).strip()
    items = [(i, decontaminate_flat(text(60))) for i in range(12)]
    index = decontaminate.build_index(items, 6, 0.08)
    for k in range(120):
        item, pattern = items[k % 12]
        s = list(pattern)
        for _ in range(rng.randrange(9)):
            p = rng.randrange(len(s))
            s[p : p + 1] = rng.choice([[], ["x"], [s[p], "y"]])
        doc = decontaminate_flat(text(80) + " " + "".join(s) + " " + text(50))
        found = {i for i, *_ in decontaminate.find_regions(index, doc)}
        allowed = {i: int(index.edits[n]) for n, (i, _) in enumerate(items)}
        assert found == {i for i, p in items if brute_edits(p, doc) <= allowed[i]}


def decontaminate_flat(text):
    return " ".join(text.lower().split())


def test_leaks_with_other_spaces_and_short_items(spark):
    rng = random.Random(3)
    words = lambda n, gap=" ": gap.join("".join(rng.choices("abcdefghij\u00e9\u4e2d", k=6)) for _ in range(n))
    items = [(1, words(20, "\u00a0")), (2, words(20, "\u3000")), (3, words(18).replace(" ", "\u2009 ", 3)), (4, "a b"), (5, "b\u00a0C"), (6, "xyz"), (7, " \u3000 "), (None, words(20, "\x1f"))]
    rows = [(i, f"{words(5)} {t} {words(5)}") for i, t in enumerate(t for _, t in items[:3])] + [(3, items[0][1]), (4, items[1][1].replace("\u3000", " ")), (5, "x a\u3000B c xyzz"), (6, "xyz"), (7, "xyzxyz \u00a0"), (8, items[7][1]), (9, f"{items[0][1]} {items[7][1]} xyz")]
    docs, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for block in (20_000, 3):
        got = {r["doc_id"]: r for r in decontaminate.contaminated_regions(docs, bench, block_windows=block).collect()}
        assert {k: r["items"] for k, r in got.items()} == {0: [1], 1: [2], 2: [3], 3: [1], 4: [2], 5: [4, 5], 6: [6], 7: [], 8: [None], 9: [1, 6, None]}
        assert [(rows[5][1][r["start"] : r["end"]], r["edits"]) for r in got[5]["regions"]] == [("a\u3000B", 0), ("B c", 0)]
    assert decontaminate.contaminated_regions(docs, bench.where("item_id = 6")).where("n_regions > 0").count() == 2


def test_leaks_are_found_and_placed(spark):
    rng = random.Random(2)
    words = lambda n: " ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(n))
    items = [(1, words(40)), (2, words(9)), (3, "tiny"), (4, None), (5, "")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    leak = items[0][1].upper().replace(" ", " \n", 5)
    rows = [(0, words(20) + " " + leak + " " + words(3), "k"), (1, words(300), "k"), (2, None, "k"), (3, "", "k"), (4, items[1][1][:-3] + "xyz", "k"), (None, leak, "k"), (0, words(20), "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, items string")
    for block in (20_000, 2):
        got = decontaminate.contaminated_regions(docs, bench, block_windows=block).collect()
        assert [(r["doc_id"], r["items"], r["n_regions"] > 0) for r in got] == [(0, [1], True), (1, [], False), (2, [], False), (3, [], False), (4, [2], True), (None, [1], True), (0, [], False)]
    first = got[0]["regions"]
    assert all(rows[0][1][r["start"] : r["end"]].lower().split()[1] in items[0][1] for r in first)
    assert decontaminate.contaminated_regions(docs, bench.limit(0)).where("n_regions > 0").count() == 0
    assert decontaminate.contaminated_regions(docs.limit(0), bench).count() == 0


def test_parts_of_an_item_are_found_at_all_offsets(spark):
    rng = random.Random(4)
    words = lambda n: " ".join("".join(rng.choices("abcdefghij", k=5)) for _ in range(n))
    item = words(66)[:394]
    around = words(12)
    # 59 characters are found for certain; of 61, one may be a space at either end
    rows = [(at, f"{around} {item[at : at + n].strip()} {around}", n) for n in (61, 70, 105) for at in range(len(item) - n + 1)]
    docs = spark.createDataFrame([*rows, (-1, words(200), 0)], "doc_id long, text string, n long")
    got = decontaminate.contaminated_regions(docs, spark.createDataFrame([(1, item), (2, words(66))], "item_id long, text string")).collect()
    assert [(r["doc_id"], r["n"]) for r in got if r["items"] != [1]] == [(-1, 0)]


def test_leaks_equal_brute_force_over_windows_in_one_and_in_many_blocks(spark):
    rng = random.Random(11)
    text = lambda n: decontaminate_flat("".join(rng.choices("abcdefg ", k=n)))
    items = [(i, text(rng.choice([30, 60, 90]))) for i in range(9)] + [(9, "gag"), (10, "a b"), (None, text(60))]
    docs = [(0, None), (1, ""), (2, "x gag y"), (3, "xgag"), (None, items[4][1])]
    for k in range(60):
        s = list(items[k % 9][1])
        for _ in range(rng.randrange(8)):
            p = rng.randrange(len(s))
            s[p : p + 1] = rng.choice([[], ["x"], [s[p], "y"]])
        docs.append((k // 2, f"{text(70)} {''.join(s)} {text(40)}"))
    docs += [docs[8]] * 3 + [(99, docs[9][1])]
    size, step, part, by, q, rate = 60, 30, 30, 10, 6, 0.08

    def cuts(t):
        return {t[min(at, max(0, len(t) - m)) :][:m] for m, b in ((size, step), (part, by)) for at in range(0, max(1, len(t) - m + b), b)} - {""}

    def holds(w, t):
        if len(w) < q:
            return f" {w} " in f" {t} "
        return brute_edits(w, t) <= decontaminate.budget(len(w), q, rate)[0]

    flat = {t: decontaminate_flat(t or "") for _, t in docs}
    order = lambda found: sorted(found, key=lambda i: (i is not None, i or 0))
    want = sorted((str(d), str(t), order(i for i, x in items if any(holds(w, flat[t]) for w in cuts(decontaminate_flat(x))))) for d, t in docs)
    frame, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for block in (20_000, 20):
        rows = decontaminate.contaminated_regions(frame, bench, q, rate, size, step, block, "text", part, by).collect()
        assert sorted((str(r["doc_id"]), str(r["text"]), order(r["items"])) for r in rows) == want
        for r in rows:
            assert r["n_regions"] == len(r["regions"]) and all(0 <= x["start"] < x["end"] <= len(r["text"]) for x in r["regions"])


def test_stages_and_regions_of_a_benchmark_in_many_blocks(spark):
    rng = random.Random(12)
    words = lambda n: " ".join("".join(rng.choices("abcdefghijklmno", k=6)) for _ in range(n))
    items = [(i, words(30)) for i in range(300)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    far = words(9_000)  # more than a piece, with a leak across its end
    docs = [(i, f"{words(40)} {items[i * 7][1]} {words(20)}") for i in range(40)] + [(50, words(200)), (51, f"{far[:19_950]} {items[5][1]} {far} {items[6][1]}")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    results, plans = [], []
    for block in (100_000, 1_000, 100):
        found = decontaminate.contaminated_regions(frame, bench, block_windows=block)
        results.append({r["doc_id"]: [(x["item_id"], x["start"], x["end"], x["edits"]) for x in r["regions"]] for r in found.collect()})
        plans.append(found._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow"))
    assert {d: {i for i, *_ in r} for d, r in results[0].items()} == {**{i: {i * 7} for i in range(40)}, 50: set(), 51: {5, 6}}
    assert results[0] == results[1] == results[2] and plans[1] == plans[2]


def test_a_text_that_repeats_a_word_of_the_benchmark_takes_bounded_memory():
    item = ("ha " * 120).strip()
    index = decontaminate.build_index([(1, item[at : at + m]) for m in (100, 50) for at in range(0, len(item) - m, 10)], 8, 0.08)
    peaks = []
    for n in (20_000, 80_000):
        tracemalloc.start()
        ((item_id, start, end, edits),) = decontaminate.find_regions(index, ("ha " * n).strip())
        assert (item_id, start, edits) == (1, 0, 0) and 3 * n - 4 < end < 3 * n  # one copy a band, so the last ones may be left out
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert peaks[1] < 100e6 and peaks[1] < peaks[0] + 20e6  # a text of four times the length


# ---- 7
PIECE = public_tokenizers.path("piece_bpe_32k.model")


def test_counts_equal_the_library(spark, data):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    texts = ["", None, " ", "  a  b ", "</s> <s> x", "\n\n a\u00a0b\u3000c", "x" * 5000, ("word  two " * 3000) + "end ", " " * 300, "é\x00ï ▁ ▁▁a", "a " * 2000]
    texts += [r[0] for r in duck(data).execute("select text from documents").fetchall()]
    df = spark.createDataFrame([(i, t, 9) for i, t in enumerate(texts)], "doc_id long, text string, n_tokens int")
    want = [(i, len((t or "").encode()), n := len(model.encode(t or "")), n > 4096) for i, t in enumerate(texts)]
    for split in (1 << 15, 50):
        got = token_counts.token_counts(df, PIECE, split_chars=split, batch_bytes=3000).orderBy("doc_id").collect()
        assert [tuple(r) for r in got] == want
    assert token_counts.token_counts(df.limit(0), PIECE).count() == 0


def test_counts_of_a_json_vocabulary(spark):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    model, texts = Tokenizer.from_file(path), ["", "hello  world <|endoftext|>", "a b " * 100]
    got = token_counts.token_counts(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), path).orderBy("doc_id").collect()
    assert [r["n_tokens"] for r in got] == [len(model.encode(t, add_special_tokens=False).ids) for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abth .,\n\t\u00a0\u3000\u2581\u00e9\u0301\u4e2d\u56fd<s/>\x00", max_size=120) | st.text(max_size=80), st.integers(1, 12))
def test_split_texts_count_as_whole_ones(text, most):
    model, _ = token_counts._sentencepiece(PIECE)
    assert token_counts.count_batch([text], PIECE, 50, most) == [len(model.encode(text))]


def test_long_texts_with_odd_spaces_and_without_any(spark):
    rng = random.Random(7)
    model, boundaries = token_counts._sentencepiece(PIECE)
    texts = ["".join(rng.choices(["word", "the", "ing", " ", " ", " \u2581", "\u2581 ", "\u00a0", "\t"], k=12_000)) for _ in range(40)]
    texts += ["".join(rng.choices("thequickbrownfox", k=200_000)), "\u4e2d\u56fd" * 60_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.token_counts(df, PIECE).collect()}
    assert got == {i: len(model.encode(t)) for i, t in enumerate(texts)}
    assert len(token_counts.split_text(texts[-2], 1 << 15, boundaries)) > 4  # a text without spaces is cut too


# ---- 8
def test_mix_meets_its_targets(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice(["a", "a", "a", "b", "c", None, "é", "z"]), rng.choice([0, 1, 5, 50, 700])) for i in range(800)] + [(None, "b", 3), (5, "b", 3), (5, "b", 3), (900, "empty", 0), (901, "b", None)]
    df = spark.createDataFrame(rows, "doc_id long, source string, size long").withColumn("taken", F.lit("x"))
    got = mixing.mix(df, range_rows=50).collect()
    assert len(got) == len(rows) and sorted(map(str, got)) == sorted(map(str, mixing.mix(df.repartition(7), range_rows=50).collect()))
    sizes = {}
    for _, s, n in rows:
        sizes[s] = sizes.get(s, 0) + (n or 0)
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    weights, stopped, total = {s: 1 + i % 3 for i, s in enumerate(names)}, set(), sum(sizes.values())
    while True:
        left = total - sum(3 * sizes[s] for s in stopped)
        rest = sum(w for s, w in weights.items() if s not in stopped)
        targets = {s: 3 * sizes[s] if s in stopped else left * weights[s] / rest for s in names}
        over = {s for s in names if s not in stopped and targets[s] > 3 * sizes[s]}
        if not over:
            break
        stopped |= over
    for s in names:
        own = [r for r in got if r["source"] == s]
        assert all(r["target"] == pytest.approx(targets[s]) and r["source_size"] == sizes[s] and 0 <= r["taken"] <= 3 * r["size"] for r in own)
        assert sum(r["taken"] for r in own) == int(targets[s] + 0.5)
    assert mixing.mix(df.limit(0)).count() == 0


def test_mixed_documents_are_those_of_the_mix(spark):
    rng = random.Random(8)
    rows = [(i, rng.choice(["a", "a", "b", None]), "w " * rng.choice([0, 1, 5, 50, 300]), "clash") for i in range(500)] + [(None, "b", "x y z", "clash"), (900, "c", None, "clash")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, taken string")
    got = mixing.mix_documents(docs)
    assert got.columns == ["doc_id", "source", "text", "size", "target", "epochs", "taken"]
    want = mixing.mix(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")))
    columns = ["doc_id", "source", "size", "target", "epochs", "taken"]
    assert sorted(map(str, got.select(columns).collect())) == sorted(map(str, want.select(columns).collect()))
    twice = mixing.mix_documents(docs.unionByName(docs)).collect()
    assert len(twice) == 2 * len(rows)
    assert all(sum(r["taken"] for r in twice if r["source"] == s) <= next(r["target"] for r in twice if r["source"] == s) + 1 for s in ("a", "b", None))


def test_word_count(spark):
    texts = [None, "", " ", "a", "a\tb\x0bc\u00a0d", "\x1fx y\n"]
    assert [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(word_count(F.col("t"))).collect()] == [len(words_of(t)) for t in texts]


# ---- 9
def brute_base(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    places = [(i, label) for phrase, label in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")) for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    return len(words), len(places), min((i for i, _ in places), default=None), max((i for i, _ in places), default=None), ",".join(sorted({x for _, x in places}))


def test_license_places_equal_brute_force(spark, data):
    rng = random.Random(6)
    pool = ["mit", "MIT", "license", "apache", "general", "public", "gnu", "x", "é", "licence", "summit", "licenses", "-", "\n", "license.", "(MIT"]
    texts = [None, "", "...", "MIT--License", "mit license mit license", "summit license", "mit licenses", "×mit license"] + [" ".join(rng.choices(pool, k=rng.randrange(30))) for _ in range(300)]
    texts += [r[0] for r in duck(data).execute("select text from documents").fetchall()]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, matches int")
    got = license_scan.license_digest(license_scan.license_scan(df)).orderBy("doc_id").collect()
    for t, r in zip(texts, got, strict=True):
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute_base(t), t
        assert set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(","))) and 0 <= r["score"] <= 1
    assert license_scan.license_scan(df.limit(0)).count() == 0


def test_license_spans_with_edits(spark):
    text = "Éa! Relaesed under the M.I.T-free MIT  Lisense. Licensed under the Apach License, Version 2.0"
    (r,) = license_scan.license_scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    found = {m["notice"]: (text[m["start"] : m["end"]], m["edits"], m["exact"]) for m in r["matches"]}
    assert found["mit license"] == ("MIT  Lisense", 1, False)
    assert found["licensed under the apache license version 2 0"] == ("Licensed under the Apach License, Version 2.0", 1, False)
    with pytest.raises(ValueError):
        license_scan.scan_text("x", (("ab", "l", 2),))


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = _next_row(row, i, x, b)
    return row[-1]


def _next_row(row, i, x, b):
    new = [i]
    for j, y in enumerate(b, 1):
        new.append(min(row[j - 1] + (x != y), row[j] + 1, new[j - 1] + 1))
    return new


def test_fuzzy_notices_equal_brute_force():
    rng = random.Random(12)
    notices = (("mit license", "mit", 1), ("apache license", "apache", 1), ("under cc by nc", "nc", 1), ("gnu public license", "gpl", 3))
    spoil = lambda w: w if rng.random() < 0.6 else (w[: (k := rng.randrange(len(w)))] + rng.choice(["", "q", w[k] + "z"]) + w[k + 1 :])
    hits = 0
    for _ in range(400):
        words = []
        while len(words) < 12:
            words += [spoil(w) for w in rng.choice(notices)[0].split()] + rng.choices(["it", "nd", "other", "license", "words"], k=rng.randrange(3))
        words = [w for w in words if w]
        _, got = license_scan.scan_text(" ".join(words), notices)
        want = set()
        for n, (notice, _, edits) in enumerate(notices):
            names = {w for w in notice.split() if len(w) <= 3}
            for i in range(len(words)):
                for j in range(i + 1, min(len(words), i + 7) + 1):
                    if names <= set(words[i:j]) and distance(notice, " ".join(words[i:j])) <= edits:
                        want.add((n, i, j))
        # every match is one, and every match's place is reported, itself or a better one that overlaps it
        assert all((n, i, i + k) in want for n, i, k, _ in got)
        assert all(any(n == m and i < f + k and f < j for m, f, k, _ in got) for n, i, j in want)
        hits += len(want)
    assert hits > 500


# ---- 10
def toxic_sample(spark, n=600, seed=1):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("klmnopqr", k=rng.randrange(2, 8))) for _ in range(400)]
    rows = []
    for i in range(n):
        w = rng.choices(vocabulary, k=rng.choice([5, 40, 300]))
        toxic = i % 5 == 0
        if toxic:
            for _ in range(max(1, len(w) // 20)):
                w[rng.randrange(len(w))] = rng.choice(["idiot", "scum", f"dumkopf{rng.choice(vocabulary)}"])
        rows.append((i, " ".join(w), int(toxic), None if i % 7 else int(toxic and i % 2), 1.0))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int, insult int, p_toxic double")


def test_chain_on_held_out_documents(spark):
    df = toxic_sample(spark)
    chain = toxicity.train_chain(df.where("doc_id < 400"), ["insult", "toxic"], dense="toxic")
    assert chain.categories == ["insult", "dense", "toxic"] and chain.models[2].inputs == ["x_terms", "p_insult", "p_dense"]
    held = chain.predict(df.where("doc_id >= 400")).select("toxic", "is_toxic").collect()
    assert sum(r["is_toxic"] == (r["toxic"] == 1) for r in held) >= 0.97 * len(held)
    odd = spark.createDataFrame([(1, None), (1, None), (None, ""), (2, "klm " * 30_000)], "doc_id long, text string")
    got = chain.predict(odd).collect()
    assert len(got) == 4 and not any(r["is_toxic"] for r in got)
    assert chain.predict(odd.limit(0)).count() == 0


def test_chain_equals_numpy(spark):
    """Folds, out-of-fold inputs and models again in NumPy; and what the last model makes of the links before it."""
    df = toxic_sample(spark, 300)
    chain = toxicity.train_chain(df, ["insult", "toxic"], folds=3, dense="toxic")
    rows = df.withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit(12)), F.lit(3))).orderBy("doc_id").collect()
    fold = np.array([r["fold"] for r in rows])
    words = [set(r["text"].lower().split()) for r in rows]
    held = [w | {x[:n] + "*" for x in w for n in (4, 5) if len(x) >= n} for w in words]
    given = {c: np.array([np.nan if r[c] is None else r[c] for r in rows], float) for c in ("insult", "toxic")}

    def choose(c, use):
        y, found = given[c], []
        a, b = (use & (y == 1)).sum(), (use & (y == 0)).sum()
        for t in set().union(*held):
            has = np.array([t in h for h in held])
            p, q = (has & use & (y == 1)).sum(), (has & use & (y == 0)).sum()
            share = (p + q) / (a + b)
            if p + q >= 5 and abs(p / a - q / b) / np.sqrt(share * (1 - share) * (1 / a + 1 / b) + 1e-12) > 5:
                found.append(t)
        return sorted(found)

    def features(use):
        """What is seen without the rows that aren't used: the terms' columns, and the labels."""
        own = choose("toxic", use)
        names = sorted({*choose("insult", use), *own})
        density = np.array([len(set(own) & h) / max(1, len(h)) for h in held])
        y = given["toxic"] == 1
        dense = (y & (density >= np.quantile(density[y & use], 0.5))).astype(float)
        return names, np.array([[t in h for t in names] for h in held], float), {**given, "dense": dense}

    whole = features(fold >= 0)
    assert whole[0] == chain.vocabulary
    without_fold = [features(fold != f) for f in range(3)]

    def fit(x, y):
        x, y = x[~np.isnan(y)], y[~np.isnan(y)]
        if len(set(y)) < 2:
            return lambda z: np.full(len(z), y[0] if len(y) else 0.0)
        x1, w = np.c_[x, np.ones(len(x))], np.zeros(x.shape[1] + 1)
        penalty = np.diag([0.002] * x.shape[1] + [0.0])
        for _ in range(50):
            p = 1 / (1 + np.exp(-x1 @ w))
            w = w - np.linalg.solve(x1.T @ (x1 * (p * (1 - p))[:, None]) / len(x) + penalty + 1e-9 * np.eye(len(w)), x1.T @ (p - y) / len(x) + penalty @ w)
        return lambda z: 1 / (1 + np.exp(-np.c_[z, np.ones(len(z))] @ w))

    earlier, use, want = np.zeros((len(rows), 0)), whole[1], {}
    for c in chain.categories:
        oof = np.zeros(len(rows))
        for f in range(3):
            x, y = np.c_[without_fold[f][1], earlier], without_fold[f][2][c]
            oof[fold == f] = fit(x[fold != f], y[fold != f])(x[fold == f])
        want[c] = fit(np.c_[whole[1], earlier], whole[2][c])(use)
        earlier, use = np.c_[earlier, oof], np.c_[use, want[c]]
    got = chain.predict(df.drop("p_toxic")).orderBy("doc_id").collect()
    for c in chain.categories:
        assert np.abs(np.array([r[f"p_{c}"] for r in got]) - want[c]).max() < 0.05
    cut = toxicity.Chain(chain.categories, chain.vocabulary, [toxicity.Constant(0.0), toxicity.Constant(0.0), chain.models[2]], chain.thresholds)
    without = cut.predict(df.drop("p_toxic")).orderBy("doc_id").collect()
    assert max(abs(a["p_toxic"] - b["p_toxic"]) for a, b in zip(got, without, strict=True)) > 0.05


def test_chain_without_examples(spark):
    df = toxic_sample(spark, 40)
    clean = toxicity.train_chain(df.where("toxic = 0"), ["toxic"])
    assert {r["p_toxic"] for r in clean.predict(df).collect()} == {0.0}
    empty = toxicity.train_chain(df.limit(0), ["toxic"])
    assert not any(r["is_toxic"] for r in empty.predict(df).collect())


def test_terms_are_chosen_without_the_fold(spark):
    """A word that marks the toxic rows of fold 0 alone is no term where fold 0 is left out."""
    rows = [(f, y, ["same", "marks0"] if y and f == 0 else ["same", "marks"] if y else ["same"]) for f in range(3) for y in (0, 1) for _ in range(40)]
    df = spark.createDataFrame(rows, "fold int, toxic int, terms array<string>")
    assert toxicity.select_terms(df, "toxic", 10, 3) == [["marks"], ["marks", "marks0"], ["marks", "marks0"], ["marks", "marks0"]]
    assert toxicity.select_terms(df, "toxic", 1, 3)[3] == ["marks"] and toxicity.select_terms(df.where("toxic = 0"), "toxic", 10, 3) == [[]] * 4


def test_labelled_sample_is_bounded(spark):
    df = toxic_sample(spark)
    labels = df.select("doc_id", "toxic")
    draw = lambda marks: {(r["doc_id"], r["toxic"]) for r in toxicity.labelled_sample(df.select("doc_id", "text"), marks, 100).collect()}
    got = draw(labels)
    assert 50 < len(got) <= 100 and got == draw(labels.repartition(7)) == draw(labels.unionByName(labels.withColumn("toxic", F.lit(0))))
    assert sorted(toxicity.labelled_sample(df.select("doc_id", "text"), labels, 100).columns) == ["doc_id", "text", "toxic"]
