"""Top-k search and Jaccard join against brute force; language id and quality on held-out rows; the pipeline."""

from collections import Counter, defaultdict

import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from bazaar.llm import jaccard_join, language_id, line_dedup, packing, quality, topk_search
from bazaar.llm.common import materialize
from bazaar.llm.registry import ORACLE, QUERIES, vocabulary
from tests.llm.conftest import PROSE, docs_frame, python_rows, rows_of, with_clashes

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ---- top-k search

def vectors_frame(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    return df.withColumn("score", F.lit(1)).withColumn("rank", F.lit(2)).withColumn("d", F.lit("x"))


def brute_top(rows, k, every):
    fine = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = Counter()
    for q, v in {(i, tuple(v)) for i, v in fine if i % every == 0}:
        best = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in fine if i != q)[:k]
        for rank, (s, i) in enumerate(best, 1):
            out[(q, rank, i, -s)] += 1
    return out


@pytest.mark.parametrize("query_block,rows_,pivots", [(4096, 4096, 32), (3, 16, 4)])
def test_top_k(spark, query_block, rows_, pivots):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(5, 12))
    data = [(i, [float(x) for x in (centres[i % 5] + rng.normal(size=12) * 0.3)]) for i in range(1, 260)]
    data += [(1000 + i, data[0][1]) for i in range(60)]  # one very common vector, with ties
    data += [(2000, None), (2010, [1.0, None] + [0.0] * 10), (2020, [float("nan")] * 12), (None, data[3][1]),
             (2030, [float("inf")] + [0.0] * 11), (2040, [0.5, 0.25]), (2050, []), (30, data[29][1]), (31, data[7][1]),
             (2060, [0.0] * 12), (-10, [-x for x in data[5][1]])]
    got = topk_search.top_k(vectors_frame(spark, data), F.col("vec_id") % 10 == 0, k=10, pivots=pivots, rows=rows_,
                            query_block=query_block, sample_rows=40)
    assert Counter(tuple(r[c] for c in ("query_id", "rank", "vec_id", "score")) for r in got.collect()) == brute_top(
        data, 10, 10)


def test_top_k_few_none_and_huge(spark):
    few = [(0, [1.0, 2.0]), (1, [0.5, -1.0]), (2, [3.0, 1.0])]
    run = lambda rows: Counter(tuple(r) for r in topk_search.top_k(
        vectors_frame(spark, rows), F.col("vec_id") % 2 == 0, k=10).select(
            "query_id", "rank", "vec_id", "score").collect())
    assert run(few) == brute_top(few, 10, 2)
    assert run([(1, [1.0])]) == Counter() == run([(4, None)])
    assert run([(4, [1.0])]) == Counter()
    big = [(0, [3e5, 1.0]), (1, [2.5e5, 7.0]), (2, [-3e5, 2.0]), (3, [1.0, 1.0])]  # sums beyond 2 ** 53
    assert run(big) == brute_top(big, 10, 2)
    over = run([(0, [1e12]), (1, [1e12]), (2, [-1e12])])
    assert over[(0, 1, 1, 2 ** 63 - 1)] == 1 and over[(0, 2, 2, -2 ** 63)] == 1
    empty = vectors_frame(spark, [(1, [1.0])]).filter("vec_id < 0")
    assert topk_search.top_k(empty, F.lit(True)).count() == 0


# ---- Jaccard join

def sets_of(rows, n):
    out = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        out.append({tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    return out


def brute_components(rows, n, percent):
    sets = sets_of(rows, n)
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                up[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [(d, len(sets[i]), least.get(find(i))) for i, (d, _) in enumerate(rows)]


@pytest.fixture(scope="module")
def near(spark, nasty):
    """Families of near copies around the bound, a common passage, chains."""
    rng = np.random.default_rng(11)
    vocabulary_ = ["".join("aeiou"[i // 5 ** k % 5] + "lmnrst"[i // 6 ** k % 6] for k in range(4)) for i in range(4000)]
    passage = list(rng.choice(vocabulary_, 60))
    rows, d = [], 5000
    for family in range(25):
        base = list(rng.choice(vocabulary_, int(rng.integers(4, 120))))
        for _ in range(int(rng.integers(1, 9)) if family else 60):
            own = list(base)
            for k in np.flatnonzero(rng.random(len(own)) < rng.choice([0, 0.005, 0.02, 0.03])):
                own[k] = str(rng.choice(vocabulary_))
            if rng.random() < 0.3:
                own += passage
            rows.append((d, " ".join(own)))
            d += 1
    chain = list(rng.choice(vocabulary_, 200))
    for k in range(30):
        rows.append((d + k, " ".join(chain[k * 3:k * 3 + 110])))
    order = rng.permutation(len(rows))
    return nasty.unionByName(docs_frame(spark, [rows[i] for i in order]))


@pytest.mark.parametrize("n,percent,block,group", [(4, 85, 1024, 20_000), (5, 80, 8, 5)])
def test_jaccard_components(spark, near, empty, monkeypatch, n, percent, block, group):
    monkeypatch.setattr(jaccard_join, "GROUP", group)
    got = jaccard_join.components(with_clashes(near), n=n, percent=percent, block=block)
    want = brute_components(python_rows(near), n, percent)
    assert len({c for _, _, c in want}) < len(want) - 50
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got.collect()) == Counter(want)
    assert jaccard_join.components(empty, n=n, percent=percent).count() == 0


@pytest.mark.parametrize("percent", [50, 80, 85, 99, 100])
def test_names_keep_sizes_that_can_link_in_reach(percent):
    for size in [*range(1, 3000), 10 ** 5, 10 ** 6 + 1, 2 ** 31 - 1]:
        least = -(-percent * size // 100)  # the smallest set that may link with one of this size
        gap = (jaccard_join._short(b"\xff" * 32, size) >> 56) - (jaccard_join._short(b"\0" * 32, least) >> 56)
        assert 0 <= gap <= jaccard_join._reach(percent)


def test_nodes_meet_within_runs_of_near_sizes(spark):
    def name(size, k):
        return jaccard_join._short(bytes([k]) * 32, size)
    sizes = {"a": 100, "b": 117, "c": 136, "d": 400, "e": 9000}  # a, b, c are a chain; d and e stand alone
    names = {k: name(n, i) for i, (k, n) in enumerate(sizes.items())}
    rows = [(names[k], 7, 1, 0) for k in "abcde"] + [(names["d"], 7, 1, 0)] + [(names["e"], 8, 2, 0)]
    met = jaccard_join._meeting(spark.createDataFrame(rows, "s long, token long, salts int, part int"), 85)
    assert {(r["s"], r["token"], r["lead"]) for r in met.collect()} == (
        {(names[k], 7, names["a"]) for k in "abc"} | {(names["e"], 8, names["e"])})  # salted windows keep all


def test_representatives(near, empty):
    frame = with_clashes(near)
    got = jaccard_join.representatives(frame, n=5, percent=80)
    assert got.columns == frame.columns
    rows = python_rows(near)
    want = Counter()
    for (d, t), (_, n, c) in zip(rows, brute_components(rows, 5, 80)):
        if n == 0 or c is None:
            want[(d, t)] += 1
        elif d == c:
            want[(d, t)] = 1
    assert Counter((r["doc_id"], r["text"]) for r in got.collect()) == want
    assert jaccard_join.representatives(empty).count() == 0


def test_trie_join_is_exact():
    rng = np.random.default_rng(1)
    for _ in range(40):
        bases = [rng.choice(500, rng.integers(1, 60), replace=False) for _ in range(4)]

        def make():
            b = bases[rng.integers(4)]
            kept = b[rng.random(len(b)) > rng.choice([0, .03, .1])]
            return np.unique(np.r_[kept, rng.integers(1000, 10 ** 6, rng.integers(0, 4))]).astype(np.uint64)
        left, right = ([x for x in (make() for _ in range(20)) if len(x)] for _ in range(2))
        want = {(i, j) for i, x in enumerate(left) for j, y in enumerate(right)
                if 100 * len(np.intersect1d(x, y)) >= 85 * len(np.union1d(x, y))}
        got = jaccard_join.trie_join(left, right, 85)
        assert len(got) == len(set(got)) and set(got) == want


def test_connected_chain_and_star(spark):
    edges = [(i, i + 1) for i in range(64)] + [(1000, 1000 + i) for i in range(1, 50)] + [(7, 7)]
    got = {r["node"]: r["root"] for r in jaccard_join.connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 65)} | {1000 + i: 1000 for i in range(1, 50)}


# ---- language id

def test_language_id_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language_id.identify(docs, language_id.crc_held_out("doc_id", 5))
    both = got.join(docs.select("doc_id", "lang"), "doc_id").filter("held_out")
    n, right = both.count(), both.filter("lang = lang_pred").count()
    assert n > 100 and right >= 0.98 * n
    assert got.filter("score < 0 or score > 1 or score is null").count() == 0


def test_language_id_learns_only_from_its_fold(spark):
    import zlib
    french = "le chat est sur la table et le chien est dans la maison avec les enfants"
    rows = [(i, PROSE if i % 2 else french, ("en" if i % 2 else "fr") if zlib.crc32(str(i).encode()) % 5 else "wrong")
            for i in range(200)]
    got = language_id.identify(docs_frame(spark, rows), language_id.crc_held_out("doc_id", 5))
    assert {r["lang_pred"] for r in got.collect()} == {"en", "fr"}


def test_language_id_defined_cases(spark, nasty, empty):
    frame = with_clashes(nasty)
    got = rows_of(language_id.identify(frame, language_id.crc_held_out("doc_id", 5)))
    assert len(got) == nasty.count()
    by = defaultdict(set)
    for r in got:
        by[r["doc_id"]].add((r["lang_pred"], r["score"]))
    assert all(by[i] == {("und", 0.0)} for i in (4, 5, 6, 13))
    assert by[1] == by[2] and {p for p, _ in by[1]} == {"en"}
    none = language_id.identify(nasty.withColumn("lang", F.lit(None).cast("string")), F.lit(False))
    assert {(r["lang_pred"], r["score"]) for r in none.collect()} == {("und", 0.0)}
    assert language_id.identify(empty, F.lit(False)).count() == 0


def test_presence_is_whole_whatever_the_stretch(monkeypatch):
    text = "Straße, ünïcode and more: " * 30 + "qzx"
    whole = language_id.presence(text)
    monkeypatch.setattr(language_id, "STRETCH", 7)
    assert (language_id.presence(text) == whole).all()
    assert not language_id.presence("").any() and language_id.presence("a").sum() == 1


# ---- quality

def test_quality_without_labels_agrees_with_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = quality.classify(docs).join(labels, "doc_id")
    good, bad = got.filter("quality = 1"), got.filter("quality = 0")
    assert good.filter("keep").count() >= 0.99 * good.count()
    assert bad.filter("not keep").count() >= 0.97 * bad.count()


def test_quality_defined_cases(nasty, empty):
    frame = with_clashes(nasty)
    got = rows_of(quality.classify(frame))
    assert len(got) == nasty.count()
    by = defaultdict(list)
    for r in got:
        by[r["doc_id"]].append((r["score"], r["keep"]))
    assert all(by[i] == [(0.0, False)] for i in (4, 5, 6))
    assert by[1] == by[2] and len(by[11]) == 2 and by[11][0] == by[11][1]
    assert all(0 <= s <= 1 for v in by.values() for s, _ in v)
    kept = quality.kept(frame)
    assert kept.columns == frame.columns
    assert kept.count() == sum(r["keep"] for r in got)
    assert quality.classify(empty).count() == 0 and quality.kept(empty).count() == 0


def test_expectation_maximisation_recovers_accuracies():
    rng = np.random.default_rng(2)
    n, k = 20_000, len(quality.LABELLERS)
    good = rng.random(n) < 0.8
    right = rng.uniform(0.75, 0.97, k)
    says = np.where(rng.random((n, k)) < right, good[:, None], ~good[:, None]).astype(int)
    says[rng.random((n, k)) < 0.2] = quality.NONE
    patterns = (says * 3 ** np.arange(k - 1, -1, -1)).sum(axis=1)
    q, table, share = quality.posteriors(Counter(patterns.tolist()))
    assert share == pytest.approx(0.8, abs=0.02)
    assert np.allclose(table[quality.GOOD, :, quality.GOOD], right, atol=0.03)
    assert np.mean((np.array([q[p] for p in patterns.tolist()]) >= 0.5) == good) > 0.97


def test_features_are_whole_whatever_the_stretch(monkeypatch):
    text = PROSE * 20 + "!!"
    whole = quality.features(text)
    monkeypatch.setattr(quality, "STRETCH", 11)
    assert np.allclose(quality.features(text), whole)


# ---- the pipeline and the registry

def test_pipeline_stages(spark, near):
    docs = near
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, materialize(stage(spark, docs, ""), "test-stage")
        if name != "packing":
            assert docs.schema == near.schema
        a, b = Counter(map(tuple, before.collect())), Counter(map(tuple, docs.collect()))
        if name == "quality":
            assert not b - a and sum(b.values()) > 0.9 * near.filter("trim(text) <> ''").count()
        elif name == "line_dedup":
            assert sum(a.values()) == sum(b.values())
        elif name == "near_duplicates":
            rows = python_rows(before)
            want = brute_components(rows, 5, 80)
            assert sum(b.values()) == len({c for _, n, c in want if n}) + sum(n == 0 for _, n, _ in want)
        elif name == "mixing":
            assert not set(b) - set(a) and max(b[x] / a[x] for x in b) <= 2
        else:
            starts = sum(v for x, v in b.items() if x[1] == 0)
            assert starts == sum(a.values())


def test_pipeline_of_nothing(spark, empty):
    docs = empty
    for _, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, ""), "test-empty")
        assert docs.count() == 0


def test_registry_names():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11))
    assert set(ORACLE) <= set(QUERIES)
    import __spark_entry__ as entry
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_match_their_sql(spark, name):
    import duckdb
    from tools.oracle_check import rows_key, type_diffs
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    df = QUERIES[name](spark, sf)
    cur = con.execute(ORACLE[name])
    names = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(names) and type_diffs(df.schema, cur.description) == []
    assert rows_key(df.columns, [tuple(r) for r in df.collect()]) == rows_key(names, cur.fetchall())
