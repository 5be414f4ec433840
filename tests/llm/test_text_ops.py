"""Sharding, line dedup, exact dedup, mixing, token counts and packing against brute force."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from bazaar.llm import exact_dedup, line_dedup, mixing, packing, sharding, token_counts, wordhash
from bazaar.llm.registry import vocabulary
from tests.llm.conftest import PROSE, docs_frame, python_rows, rows_of, with_clashes

SPACES = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(x):
    return (x is None, x)


# ---- sharding

def test_sharding_law_and_slots(nasty):
    got = rows_of(sharding.shard_documents(with_clashes(nasty), sharding.topology(40), sharding.topology(41)))
    assert len(got) == nasty.count()
    want = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in python_rows(nasty))
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    by = defaultdict(list)
    for r in got:
        by[r["shard"]].append(r["slot"])
        assert r["grown_shard"] in (r["shard"], 40) and 0 <= r["shard"] < 40
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert len({r["shard"] for r in got if r["doc_id"] == 11}) == 1


def test_sharding_is_even_and_growth_takes_rows_only_into_itself(spark):
    ids = spark.range(20_000)
    for n in (40, 43):
        a, b = sharding.topology(n), sharding.topology(n + 1)
        moved = ids.select(sharding.place(F.col("id"), a).alias("a"), sharding.place(F.col("id"), b).alias("b"))
        counts = {(r["a"], r["b"]): r["count"] for r in moved.groupBy("a", "b").count().collect()}
        assert all(x == y or y == n for x, y in counts)
        new = sum(v for (x, y), v in counts.items() if x != y)
        assert 0.6 * 20_000 / (n + 1) < new < 1.5 * 20_000 / (n + 1)
        assert max(v for (x, y), v in counts.items() if x == y) < 1.4 * 20_000 / n


def test_sharding_weights_confine_movement(spark):
    a = sharding.topology(16, base=16)
    b = [x._replace(weight=3.0) if x.shard == 5 else x for x in a]  # shard 5: region r0, rack k1
    ids = spark.range(5_000)
    moved = ids.select(sharding.place(F.col("id"), a).alias("a"), sharding.place(F.col("id"), b).alias("b")).filter(
        "a <> b").collect()
    region = {x.shard: x.region for x in a}
    assert moved and all(region[r["b"]] == "r0" for r in moved)
    zero = [x._replace(weight=0.0) if x.shard == 5 else x for x in a]
    assert ids.select(sharding.place(F.col("id"), zero).alias("s")).filter("s = 5").count() == 0


def test_sharding_empty_and_written(spark, empty, nasty, tmp_dir):
    assert sharding.shard_documents(empty, sharding.topology(40), sharding.topology(41)).count() == 0
    sharding.write_shards(nasty, sharding.topology(4, base=4), tmp_dir + "/shards")
    back = spark.read.parquet(tmp_dir + "/shards")
    assert back.count() == nasty.count() and back.select("__llm_shard").distinct().count() <= 4


# ---- line dedup

def lines_brute(rows, min_len=40, min_docs=5):
    held = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            k = line.strip(SPACES).translate(LOWER)
            if len(k) >= min_len:
                held[k].add(i)
    keeper = {k: max((i for i in v if i is not None), default=None) for k, v in held.items() if len(v) >= min_docs}
    out = []
    for i, t in rows:
        ls = (t or "").split("\n")
        stay = [x for x in ls if (k := x.strip(SPACES).translate(LOWER)) not in keeper or i == keeper[k]]
        out.append((i, len(ls), len(ls) - len(stay), hashlib.sha256("\n".join(stay).encode()).hexdigest()))
    return Counter(out)


def test_line_dedup(spark, nasty, empty):
    shared = "A line of more than forty characters that many documents hold"
    accent = "É" * 20 + "é" * 25
    more = [(100 + i, f"own {i}\n {shared.upper()}\t\nend\n{shared}" + ("\n" + accent) * (i < 4)) for i in range(40)]
    more += [(200, f"{shared}\n" * 70 + "z"), (None, shared), (201, accent.lower())]
    both = nasty.unionByName(docs_frame(spark, more))
    got = rows_of(line_dedup.line_dedup(with_clashes(both)))
    assert Counter((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept_sha256"]) for r in got) == lines_brute(
        python_rows(both))
    assert line_dedup.line_dedup(empty).count() == 0
    cut = line_dedup.deduped(with_clashes(both))
    assert cut.columns == with_clashes(both).columns
    assert Counter(hashlib.sha256((r["text"] or "").encode()).hexdigest() for r in cut.collect()) == Counter(
        r["kept_sha256"] for r in got)


def test_line_dedup_bitmaps_are_sparse(spark):
    shared = "x" * 50
    docs = docs_frame(spark, [(i, "\n".join([*(f"short {k}" for k in range(100)), shared])) for i in range(6)])
    maps = {r["doc"]: r["dropped"] for r in line_dedup.keep_bitmaps(docs).collect()}
    assert maps == {i: {100 // 32: 1 << 100 % 32} for i in range(5)}


# ---- exact dedup

@pytest.mark.parametrize("cells", [1 << 12, exact_dedup.CELLS])
def test_exact_dedup(nasty, empty, cells):
    got = rows_of(exact_dedup.exact_dedup(with_clashes(nasty), cells=cells))
    groups = defaultdict(list)
    for i, t in python_rows(nasty):
        bare = re.sub(f"[{SPACES}]+", "", t or "")
        groups[hashlib.sha256(bare.encode()).hexdigest()].append((-len(t or ""), *key(i)))
    want = Counter()
    for h, rows in groups.items():
        keep = min(rows, key=lambda r: (r[0], r[1], r[2] if r[2] is not None else 0))
        for r in rows:
            want[(r[2], keep[2], len(rows), h)] += 1
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got) == want
    kept = Counter(r["text_sha256"] for r in got if r["kept"])
    assert set(kept) == set(groups) and set(kept.values()) == {1}
    assert all(r["doc_id"] == r["keep_id"] for r in got if r["kept"])
    assert exact_dedup.exact_dedup(empty).count() == 0


# ---- mixing

def test_targets_reshare(spark):
    rows = [("b", 1000), ("a", 10), ("c", 300), (None, 50), ("d", 0)]
    got = {r["source"]: r["target"] for r in mixing.targets(
        spark.createDataFrame(rows, "source string, source_size long")).collect()}
    size = dict(rows)
    weight = {"a": 5.0, "b": 2.0, "c": 1.0, "d": 5.0, None: 2.0}
    target, left, free = {}, 1.5 * sum(size.values()), set(size)
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 2 * size[s]}
        if not over:
            target |= {s: level * weight[s] for s in free}
            break
        target |= {s: 2.0 * size[s] for s in over}
        left -= sum(2 * size[s] for s in over)
        free -= over
    assert got == pytest.approx(target)


def test_mixing(spark, nasty, empty):
    rows = [(1000 + i, " ".join(["w"] * (1 + i % 37)), "en", f"s{i % 4}" if i % 3 else "hot") for i in range(3000)]
    both = nasty.unionByName(docs_frame(spark, rows))
    frame = with_clashes(both)
    got = rows_of(mixing.mix(frame))
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, _ in python_rows(both))
    again = rows_of(mixing.mix(frame.repartition(7)))
    order = lambda rs: sorted((tuple(map(str, r.values())) for r in rs))
    assert order(got) == order(again)
    by = defaultdict(list)
    for r in got:
        assert 0 <= r["taken"] <= 2 * r["size"]
        by[(r["source_size"], r["target"])].append(r)
    for (size, target), rs in by.items():
        assert sum(r["size"] for r in rs) == size and target <= 2 * size
        assert abs(sum(r["taken"] for r in rs) - target) <= max(r["size"] for r in rs) + 1
    assert sum(t for _, t in by) == pytest.approx(1.5 * sum(s for s, _ in by))
    taken = mixing.mixed(frame)
    assert taken.columns == frame.columns
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    total = defaultdict(int)
    for r in taken.select("source", "text").collect():
        total[r["source"]] += words(r["text"])
    own = {s: [0, 0] for s in total}
    for r in both.select("source", "text").collect():
        own.setdefault(r["source"], [0, 0])[0] += words(r["text"])
        own[r["source"]][1] = max(own[r["source"]][1], words(r["text"]))
    aim = {size: t for size, t in by}
    assert all(abs(total[s] - aim[n]) <= most + 1 for s, (n, most) in own.items())
    assert mixing.mix(empty).count() == 0 and mixing.mixed(empty).count() == 0


# ---- tokens

ODD = ["", "A<|endoftext|>b <|startoftext|> c", "HÉé  \n\n x", "中文 Test 'll I'LL", "   ", "\x1c\x1d x y", "’s DON'T 12345 a1",
       "x y", "İstanbul ΣΑΣ", "ǅ Ŀ l·l ß ẞ ŉ", "é ͅ", "a" * 5000, "don't we'll  they've\t\tI'm\n", "½²³ 1½"]


def test_token_counts_equal_the_library(spark, nasty, empty):
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    docs = nasty.unionByName(docs_frame(spark, [(500 + i, t) for i, t in enumerate(ODD)]))
    got = rows_of(token_counts.token_counts(with_clashes(docs), vocabulary("byte_bpe_50k.json"), limit=40))
    want = Counter()
    for i, t in python_rows(docs):
        n = len(lib.encode(t or "", add_special_tokens=False).ids)
        want[(i, len((t or "").encode()), n, n > 40)] += 1
    assert Counter(tuple(r[c] for c in ("doc_id", "n_bytes", "n_tokens", "over_limit")) for r in got) == want
    assert token_counts.token_counts(empty, vocabulary("byte_bpe_50k.json")).count() == 0


def test_whole_tokens_are_proved(monkeypatch):
    c = token_counts.Counter(vocabulary("byte_bpe_50k.json"))
    assert len(c.whole) > 40_000
    monkeypatch.setattr(token_counts, "LONG", 10)  # the streaming path
    monkeypatch.setattr(token_counts, "CACHE", 3)  # a cache that overflows
    for t in ODD:
        assert c.count(t) == len(c.lib.encode(t, add_special_tokens=False).ids)


# ---- packing

def test_encoder_equals_the_library(monkeypatch):
    e = packing.Encoder(vocabulary("word_bpe_49k.json"))
    ids = lambda t: np.array(e.lib.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes()
    assert [e.ids(t) for t in [*ODD, PROSE]] == [ids(t) for t in [*ODD, PROSE]]
    monkeypatch.setattr(packing, "STRETCH", 10)
    monkeypatch.setattr(packing, "CACHE", 3)
    assert [e.ids(t) for t in [*ODD, PROSE]] == [ids(t) for t in [*ODD, PROSE]]


def test_best_two_fit():
    # greedy fills 6 + 3 and leaves 1; in place of the 3, 2 + 2 close the gap
    assert packing.best_two_fit(np.array([6, 3, 2, 2]), 10).tolist() == [0, 1, 0, 0]
    rng = np.random.default_rng(5)
    for size in (10, 64, 2048):
        lengths = rng.integers(1, size + 1, 700)
        bins = packing.best_two_fit(lengths, size)
        fill = np.bincount(bins, weights=lengths)
        assert fill.max() <= size and fill.min() > 0
        assert len(fill) <= 1.05 * max(lengths.sum() / size, (lengths > size / 2).sum()) + 1
    assert packing.best_two_fit(np.array([], dtype=np.int64), 5).tolist() == []


@pytest.mark.parametrize("length,batch", [(64, 30_000), (64, 7), (1, 100)])
def test_packing(spark, nasty, empty, length, batch):
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    small = nasty.filter("doc_id is null or doc_id <> 9") if length == 1 else nasty
    frame = with_clashes(small)
    got = rows_of(packing.packed_documents(frame, vocabulary("word_bpe_49k.json"), length=length, batch=batch))
    want = Counter()
    for i, t in python_rows(small):
        ids = np.array([*lib.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4")
        for k in range(0, len(ids), length):
            own = ids[k:k + length]
            want[(i, k // length, k, len(own), zlib.crc32(own.tobytes()))] += 1
    assert Counter(tuple(r[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")) for r in got) == want
    by = defaultdict(list)
    for r in got:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for ps in by.values():
        at = 0
        for offset, n in sorted(ps):
            assert offset == at
            at += n
        assert at <= length
    if batch > 100:
        assert len(by) <= 1.1 * sum(r["length"] for r in got) / length + 1
    assert packing.packed_documents(empty, vocabulary("word_bpe_49k.json")).count() == 0


def test_sequences_hold_the_ids(nasty):
    got = rows_of(packing.sequences(nasty.filter("doc_id < 9"), vocabulary("word_bpe_49k.json"), length=32))
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    parts = defaultdict(dict)
    for r in got:
        ids = np.frombuffer(r["ids"], dtype="<u4")
        assert len(ids) == r["n_tokens"] <= 32
        for p in r["pieces"]:
            parts[p["doc_id"]][p["piece"]] = ids[p["offset"]:p["offset"] + p["length"]]
    for i, t in python_rows(nasty.filter("doc_id < 9")):
        own = np.concatenate([parts[i][k] for k in sorted(parts[i])])
        assert own.tolist() == [*lib.encode(t or "", add_special_tokens=False).ids, 0]


# ---- word hashes

def test_word_hashes(monkeypatch):
    text = "The  quick\tBROWN fox\n\x0bjumps. É é Z" * 9
    words = re.findall(r"[^\x20\x09-\x0D]+", text.translate(LOWER))
    h = wordhash.words(wordhash.folded(text))
    assert len(h) == len(words)
    assert len(set(h.tolist())) == len(set(words))
    assert len({(a, b) for a, b in zip(words, h.tolist())}) == len(set(words))
    monkeypatch.setattr(wordhash, "STRETCH", 16)
    assert (wordhash.words(wordhash.folded(text)) == h).all()
    sets = {tuple(words[i:i + 4]) for i in range(len(words) - 3)}
    assert len(wordhash.shingle_set(text, 4)) == len(sets)
    assert len(wordhash.shingle_set("a b", 4)) == 1 and len(wordhash.shingle_set(" \n", 4)) == 0
    assert wordhash.shingle_set("a b", 4)[0] != wordhash.shingle_set("a b c", 4)[0]
