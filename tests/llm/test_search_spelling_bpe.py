"""Lexical search, spelling variants and byte-level BPE against brute force and the library."""

import base64
import hashlib
import math
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from bazaar.llm import byte_bpe, lexical_search, spelling
from bazaar.llm.registry import vocabulary
from tests.llm.conftest import PROSE, docs_frame, python_rows, rows_of, with_clashes

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ---- lexical search

def terms_of(text):
    out = re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", (text or "").translate(LOWER))
    return out


def ranked_brute(rows, items, k):
    held = [(i, Counter(terms_of(t)), len(terms_of(t))) for i, t in rows]
    n_docs, all_terms = sum(n > 0 for _, _, n in held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c, n in held:
            m = 25 + 75 * n * n_docs // all_terms if all_terms else 25
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in terms_of(text) if t in c)
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scores)[:k], 1)]
    return out


def ranked(df):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in rows_of(df)), key=str)


@pytest.fixture(scope="module")
def searched(spark):
    """Texts of few words, so that terms are frequent and ties common; groups of equal texts."""
    rnd = random.Random(5)
    words = ["sea", "Sun", "moon", "tide", "ünder", "42", "don", "t", "rain", "cloud", "wind", "fog"]
    rows = [(i, " ".join(rnd.choices(words, weights=range(1, 13), k=rnd.randint(0, 40)))) for i in range(700)]
    rows += [(1000 + i, "moon tide moon, fog!") for i in range(40)]
    items = [(i, " ".join(rnd.choices(words, k=rnd.randint(1, 9)))) for i in range(25)]
    items += [(90, None), (91, ""), (92, "..."), (93, "unheard"), (94, "moon moon tide"), (94, "sun"), (95, "fog"), (95, "fog")]
    return rows, items


def items_frame(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def test_search_equals_brute_force(spark, searched):
    rows, items = searched
    got = ranked(lexical_search.rank(docs_frame(spark, rows), items_frame(spark, items)))
    assert got == sorted(ranked_brute(rows, list(dict.fromkeys(items)), 10), key=str)


def test_search_in_blocks_of_items(spark, searched):
    rows, items = searched
    want = {r for r in ranked_brute(rows, list(dict.fromkeys(items)), 3)}
    got = lexical_search.rank(docs_frame(spark, rows).repartition(3), items_frame(spark, items), k=3, block_bytes=400)
    assert set(ranked(got)) == want


def test_segment_search_equals_exhaustive_scores(monkeypatch):
    rnd = np.random.default_rng(3)
    monkeypatch.setattr(lexical_search, "LEAF", 4)
    for trial in range(60):
        monkeypatch.setattr(lexical_search, "TAKEN", int(rnd.integers(1, 9)))
        n_docs, n_terms, k = int(rnd.integers(1, 200)), int(rnd.integers(1, 12)), int(rnd.integers(1, 12))
        impact = rnd.integers(0, 6, (n_docs, n_terms)) * (rnd.random((n_docs, n_terms)) < 0.5)
        doc, term = np.nonzero(impact)
        if not len(doc):
            continue
        shuffled = rnd.permutation(len(doc))
        s = lexical_search.Segment(doc[shuffled], term[shuffled], impact[doc, term][shuffled].astype(np.int64), n_docs, n_terms)
        terms = rnd.permutation(n_terms)[:int(rnd.integers(1, n_terms + 1))]
        weights = rnd.integers(0, 4, len(terms))
        scores = (impact[:, terms] * weights).sum(axis=1)
        floor = int(rnd.integers(1, 8))
        want = sorted(((-x, d) for d, x in enumerate(scores.tolist()) if x >= floor))[:k]
        docs, found = s.search(terms, weights, k, floor)
        assert list(zip((-found).tolist(), docs.tolist())) == want


def test_segment_maxima_are_exact():
    rnd = np.random.default_rng(4)
    doc, term = np.nonzero(rnd.random((90, 5)) < 0.7)
    impact = rnd.integers(1, 50, len(doc))
    s = lexical_search.Segment(doc, term, impact, 90, 5)
    for t in range(5):
        a, b = int(s.start[t]), int(s.start[t + 1])
        for _ in range(40):
            lo, hi = sorted(rnd.integers(a, b + 1, 2).tolist())
            if lo < hi:
                at = int(s.largest(np.array([lo]), np.array([hi]))[0])
                assert lo <= at < hi and s.impact[at] == s.impact[lo:hi].max()


def test_search_skips_most_of_a_long_list():
    """One document holds all rare terms: its interval decides, the others' bounds never reach it."""
    n = 100_000
    doc = np.concatenate([np.arange(n), [777, 777]])
    term = np.concatenate([np.zeros(n, dtype=np.int64), [1, 2]])
    impact = np.concatenate([np.ones(n, dtype=np.int64), [1000, 1000]])
    s = lexical_search.Segment(doc, term, impact, n, 3)
    seen = []
    s_add = np.add.at

    def count(a, i, v):
        seen.append(len(v))
        return s_add(a, i, v)
    lexical_search.np.add.at, old = count, lexical_search.np.add.at
    try:
        docs, scores = s.search(np.arange(3), np.ones(3, dtype=np.int64), 1, 1)
    finally:
        lexical_search.np.add.at = old
    assert docs.tolist() == [777] and scores.tolist() == [2001] and sum(seen) <= 4 * lexical_search.LEAF


def test_search_nasty_clashing_and_empty(spark, nasty, empty):
    items = items_frame(spark, [(1, PROSE), (2, "today 中文 straße"), (3, "one two x")])
    got = ranked(lexical_search.rank(with_clashes(nasty), with_clashes(items)))
    want = ranked_brute(python_rows(nasty), [(1, PROSE), (2, "today 中文 straße"), (3, "one two x")], 10)
    assert got == sorted(want, key=str)
    assert lexical_search.rank(empty, items).count() == 0
    assert lexical_search.rank(nasty, items.limit(0)).count() == 0


def test_long_texts_are_counted_whole(monkeypatch):
    text = "Ab cd, " * 1000 + "é"
    whole = lexical_search.term_counts(text)
    monkeypatch.setattr(lexical_search, "LONG", 10)
    assert lexical_search.term_counts(text) == whole == {"ab": 1000, "cd": 1000, "é": 1}


# ---- spelling variants

def words_brute(rows, min_len=6, min_count=5, one_in=199):
    n = Counter()
    for i, t in rows:
        for r in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            r = r.translate(LOWER)
            if i is not None and (h := zlib.crc32(f"{i}:{r}".encode())) % one_in == 0:
                r = r[:h % len(r)] + r[h % len(r) + 1:]
            n[r] += 1
    return {w: c for w, c in n.items() if len(w) >= min_len and c >= min_count}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def variants_brute(counts, factor=5):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= factor * counts[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w
    return sorted((w, form[w] or "", root(w), counts[w], len(near[w]), counts[form[w]] if form[w] else 0) for w in counts)


def variant_rows(df):
    return sorted((r["word"], r["form"] or "", r["root"], r["n"], r["n_near"], r["form_n"] or 0) for r in rows_of(df))


@pytest.fixture(scope="module")
def spelled(spark):
    """Words over three letters, so that neighbours abound; chains of forms; letters beyond ASCII."""
    rnd = random.Random(11)
    text = []
    for i in range(300):
        words = ["".join(rnd.choices("abé", k=rnd.randint(5, 7))) for _ in range(40)]
        words += ["keeper"] * 40 + ["keepers"] * 7 + ["Keepèr"] * (i % 3 == 0) + ["kepers"] * (i % 40 == 0)
        rnd.shuffle(words)
        text.append((i, " ".join(words)))
    text += [(7000 + i, "straßenbahn x " + "y" * 300 + " " + "y" * 301 + " " + "z" + "y" * 300) for i in range(5)]
    return text


@pytest.mark.parametrize("block, chars", [(512, 1 << 20), (8, 1 << 20), (1000, 200)])
def test_variants_equal_brute_force(spark, spelled, block, chars):
    got = variant_rows(spelling.variants(docs_frame(spark, spelled), block=block, block_chars=chars))
    want = variants_brute(words_brute(spelled))
    assert [tuple(x if not isinstance(x, str) else hash(x) for x in r) for r in got] == \
        [tuple(x if not isinstance(x, str) else hash(x) for x in r) for r in want]
    assert any(r[2] not in (r[0], r[1]) for r in got)  # a chain of two forms


def test_lists_find_all_pairs(monkeypatch):
    rnd = random.Random(2)
    for together in (7, 4096):
        monkeypatch.setattr(spelling, "TOGETHER", together)
        sizes = [1, 2, 3, 5, 7, 0]
        lists = [sorted({"".join(rnd.choices("abc", k=rnd.choice((k, k + 1)))) for _ in range(90)}) for k in sizes]
        starts = np.cumsum([0, *map(len, lists)])[:-1]
        words = [w for x in lists for w in x]
        got = [p for i, j, d in spelling.near_in_lists(words, starts, np.array(sizes)) for p in zip(i, j, d)]
        want = set()
        for s, k, x in zip(starts, sizes, lists):
            for i, a in enumerate(x):
                for j, b in enumerate(x):
                    if len(a) == k and one_edit(a, b):
                        want.add((s + i, s + j, next((h for h in range(k) if a[h] != b[h]), k)))
        assert len(got) == len(set(got)) and set(got) == want


def test_blocks_stay_small_and_hold_each_pair_once(spark):
    words = [f"{'abcdefgh'[a]}{'abcdefgh'[b]}{'abcdefgh'[c]}tion" for a in range(8) for b in range(8) for c in range(8)]
    frame = spark.createDataFrame([(w, 5) for w in words], "word string, n long")
    blocks = spelling.blocks_of(frame, block=20)
    sizes = blocks.groupBy("key", "size", "before", "after").count()
    # what shares all but one code point cannot be split; the alphabet bounds it
    assert sizes.filter("count > 20 and size - before - after > 1").isEmpty()
    held = defaultdict(list)
    for r in blocks.collect():
        held[r["key"]].append(r)
    seen = Counter()
    for rows in held.values():
        for x in rows:
            for y in rows:
                if x["word"] < y["word"] and min(len(x["word"]), len(y["word"])) == x["size"] and one_edit(x["word"], y["word"]):
                    first = next(k for k, (s, t) in enumerate(zip(x["word"] + " ", y["word"] + "_")) if s != t)
                    seen[x["word"], y["word"]] += x["before"] <= first < x["until"]
    assert seen == {(x, y): 1 for x in words for y in words if x < y and one_edit(x, y)}


def test_variants_nasty_clashing_and_empty(spark, nasty, empty):
    long = [(900 + i, f"{'y' * 20_000} {'y' * 20_001} {'y' * 9_000}z{'y' * 11_000}") for i in range(5)]
    got = variant_rows(spelling.variants(docs_frame(nasty.sparkSession, long)))
    assert [(len(r[0]), r[4]) for r in got] == [(20_000, 2), (20_001, 2), (20_001, 2)]
    doubled = nasty.unionByName(nasty).unionByName(nasty).unionByName(nasty).unionByName(nasty)
    got = variant_rows(spelling.variants(with_clashes(doubled)))
    assert got == variants_brute(words_brute(python_rows(doubled)))
    assert spelling.variants(empty).count() == 0


def test_words_lose_the_code_point_that_their_hash_names(spark):
    rows = [(i, "wonderful Ärgernis") for i in range(2000)]
    got = {r["word"]: r["n"] for r in rows_of(spelling.word_counts(docs_frame(spark, rows), 6, 1, 199, "doc_id", "text"))}
    assert got == words_brute(rows, min_count=1) and len(got) > 2


# ---- byte-level BPE

@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    import tiktoken
    path = vocabulary("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return path, public_tokenizers.PATTERN, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN,
                                                               mergeable_ranks=ranks, special_tokens={})


def packed(ids):
    return struct.pack(f"<{len(ids)}I", *ids)


def test_bpe_equals_the_library(spark, nasty, library):
    path, pattern, lib = library
    strange = docs_frame(spark, [(100, "<|endoftext|> it's▁ ﬁ\x00\x01 ١٢٣ ²½ 🎉🎉"), (101, "a" * 5000), (102, " \n\n \t x  "),
                                 (103, "日本語のテキスト。"), (104, "don't WE'LL they've"), (105, "  x\u0085y")])
    df = with_clashes(nasty.unionByName(strange))
    got = Counter(tuple(r) for r in byte_bpe.round_trips(df, path, pattern).collect())
    want = Counter()
    for i, t in python_rows(df):
        ids = packed(e := lib.encode_ordinary(t or ""))
        want[i, len(e), hashlib.sha256(ids).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()] += 1
    assert got == want


def test_bpe_encodes_and_decodes_columns(spark, nasty, empty, library):
    path, pattern, lib = library
    rows = byte_bpe.decoded(byte_bpe.encoded(nasty, path, pattern), path, pattern).collect()
    want = Counter((i, packed(lib.encode_ordinary(t or "")), (t or "").encode()) for i, t in python_rows(nasty))
    assert Counter((r["doc_id"], bytes(r["ids"]), bytes(r["decoded"])) for r in rows) == want
    none = spark.createDataFrame([(None,)], "ids binary")
    assert byte_bpe.decoded(none, path, pattern).first()["decoded"] is None
    assert byte_bpe.round_trips(empty, path, pattern).count() == 0
    assert byte_bpe.encoded(empty, path, pattern).count() == 0


def test_bpe_model_is_the_vocabulary(library):
    path, pattern, lib = library
    c = byte_bpe.Codec(path, pattern)
    assert c.bytes_of == [lib.decode_single_token_bytes(i) for i in range(lib.n_vocab)]
    rnd = random.Random(9)
    for _ in range(300):  # the model alone merges as the library does, also what is no whole entry
        x = "".join(rnd.choices(["e", "in", "g", "the", "q", "é", "中", "1"], k=rnd.randint(1, 30)))
        assert c.model.encode(byte_bpe.spelled(x.encode())) == lib._encode_single_piece(x.encode())


def test_bpe_long_texts_and_full_cache(library, monkeypatch):
    path, pattern, lib = library
    monkeypatch.setattr(byte_bpe, "LONG", 100)
    monkeypatch.setattr(byte_bpe, "CACHE", 5)
    c = byte_bpe.Codec(path, pattern)
    texts = [PROSE, "short one", PROSE + " " + "w" * 500, "", "another short one"] * 3
    assert [packed(lib.encode_ordinary(t)) for t in texts] == list(c.encode_batch(texts))


def test_bpe_patterns_and_bad_rank_files(tmp_dir):
    assert byte_bpe.written_out(r"\p{Lu}x") is None and byte_bpe.written_out(r"[^\s\P{L}]") is None
    assert re.compile(byte_bpe.written_out(r" ?\p{L}+|[^\s\p{L}]")).findall("ab é!") == ["ab", " é", "!"]
    for lines in ([b"a"], [bytes([b]) for b in range(255)]):
        with open(tmp_dir + "/bad", "wb") as f:
            f.writelines(base64.b64encode(x) + f" {k}\n".encode() for k, x in enumerate(lines))
        with pytest.raises(ValueError):
            byte_bpe.read_ranks(tmp_dir + "/bad")
