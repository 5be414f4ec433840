"""N-gram Jaccard self-join with prefix trees, and the components that its links form.

A document is the set of its distinct hashed word n-grams. Equal sets are one node from
the start. Two nodes link when 100 * |x & y| >= percent * |x | y|.

1. One global order of n-grams: by a count in a fixed array of `CELLS` counters (rare first), ties by
   hash. The counters cover all documents; collisions shift the order, never the result.
2. Sets that link share `SHARED` of their first |x| - ceil(t |x|) + `SHARED` n-grams in any global order
   (as many as a small set can hold). Only these prefixes are shuffled, as pairs of numbers. A node that
   shares fewer of them with others, all others together, links with nothing and leaves. The nodes
   left that share a prefix n-gram join the group of the smallest node that has it, so that the groups of many
   shared n-grams coincide. A node's name begins with its size class: the nodes of one n-gram are sorted by name
   and cut wherever two sizes in a row are too far apart to link, and what stands alone there has not met
   anybody. The windows over frequent n-grams are salted by their counters.
3. Each group is cut along its set sizes into blocks of about `BLOCK` sets and `BLOCK_NGRAMS` n-grams. Pairs of
   blocks whose sizes can link are one task each, neighbours first; pairs that their links have connected
   wholly are not compared. In a task the sets of one block, ordered by frequency within the task, form a trie; all sets
   of the other descend it together, so that a shared path adds to the overlaps once; a set leaves a
   subtree as soon as its overlap and what may still come cannot reach the bound. A task
   returns a forest of the links it found, at most one per node, so no link between
   components is lost and a group of copies never turns into all its pairs.
4. Components by alternating large and small stars, each round written out.

The prefixes and the sets are made from the texts where they are needed and never stored; a Bloom filter
of fixed size lets only the sets through whose nodes have a group.

Defined cases: of fewer than n words the whole sequence is the one n-gram; null, empty and blank texts have
the empty set and link with nothing; very long texts are read whole; repeated rows and equal texts link; a null id is larger than any
other, and a component of null ids only has a null component_id; an empty table gives an empty result; extra
columns are not read by `components`, and `representatives` returns them unchanged.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bazaar.llm import wordhash
from bazaar.llm.common import bounded_batches, drop_rows, mark_of, materialize, text_or_empty
from bazaar.llm.exact_dedup import bloom, may_hold

CELLS = 1 << 24
SLICE = 1 << 18
BLOCK = 1024
#: N-grams of a block: 8 MB of hashes.
BLOCK_NGRAMS = 1 << 20
SHARED = 20
#: A window over one n-gram holds about this many rows; more frequent n-grams are salted.
GROUP = 20_000
#: Size classes an octave, in a node's name: 32 octaves fill its first 8 bits.
CLASSES = 8


def _cell(shingles: np.ndarray, cells: int) -> np.ndarray:
    return (shingles >> np.uint64(64 - cells.bit_length() + 1)).astype(np.int64)


def signature(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=32).digest()


def _short(sig: bytes, size: int) -> int:
    """The name of a node while candidates are sought: 8 bits of the size's logarithm, 56 bits of the signature.
    Names rise with the size class. Different sets that share a name only become candidates together."""
    size_class = min(int(CLASSES * math.log2(size)), 255) - 128
    return (size_class << 56) + int.from_bytes(sig[:7], "little")


def _reach(percent: int) -> int:
    """How many size classes apart two sets that link can be."""
    return math.ceil(CLASSES * math.log2(100 / percent) + 1e-6)


def _rough(counts: np.ndarray) -> np.ndarray:
    """Counts as bytes, in steps of an eighth of a power of two."""
    return np.minimum(np.rint(8 * np.log2(counts + 1.0)), 255).astype(np.uint8)


def _sign_and_count(n: int, cells: int, part: int):
    """Of each text (id as a string, th, text): size and signature of its set; at the end the n-gram counters."""
    columns = ["id", "th", "n", "h", "s", "slice", "small", "cell", "count"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = np.zeros(cells, dtype=np.int32)
        for b in batches:
            sets = [wordhash.shingle_set(t, n) for t in b["text"]]
            if not sets:
                continue
            at, times = np.unique(_cell(np.concatenate(sets), cells), return_counts=True)
            own[at] = np.minimum(own[at] + times.astype(np.int64), 2 ** 31 - 1)
            sigs = [signature(x) if len(x) else None for x in sets]
            yield pd.DataFrame({"id": b["id"], "th": b["th"], "n": np.array([len(x) for x in sets], dtype=np.int64),
                                "h": pd.Series(sigs, dtype="object"),
                                "s": pd.Series([_short(g, len(x)) if g else 0 for g, x in zip(sigs, sets)], dtype="int64"),
                                "slice": -1, "small": None, "cell": None, "count": None})[columns]
        for k in range(0, cells, part):
            piece = own[k:k + part]
            if piece.any():
                big = np.flatnonzero(piece > 254)
                yield pd.DataFrame({"id": [None], "th": [0], "n": [0], "h": [None], "s": [0], "slice": [k // part],
                                    "small": [zlib.compress(np.minimum(piece, 255).astype(np.uint8).tobytes(), 1)],
                                    "cell": [big.astype(np.int32)], "count": [piece[big]]})[columns]
    return run


def _merge_counts(part: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for k, small, cell, count in zip(b["slice"], b["small"], b["cell"], b["count"]):
                own = np.frombuffer(zlib.decompress(small), dtype=np.uint8).astype(np.int64)
                own[np.asarray(cell, dtype=np.int64)] = np.asarray(count, dtype=np.int64)
                sums[k] = sums[k] + own if k in sums else own
        if sums:
            yield pd.DataFrame({"slice": list(sums), "rough": [_rough(v).tobytes() for v in sums.values()]})
    return run


def signed(docs: DataFrame, n: int, cells: int = CELLS) -> tuple[DataFrame, np.ndarray]:
    """A written table (__llm_id, __llm_th, n, h, s) of all rows, and the counters of all documents' n-grams
    as `cells` bytes (see `_rough`), never more."""
    part = min(SLICE, cells)
    kind = ("id string, th long, n long, h binary, s long, slice int, small binary, cell array<int>, "
            "count array<int>")
    # pandas would turn an id column with nulls into floats: ids pass as text
    texts = docs.select(F.col("__llm_id").cast("string").alias("id"), F.col("__llm_th").alias("th"), "text")
    both = materialize(texts.mapInPandas(_sign_and_count(n, cells, part), kind), "op6-signed")
    pieces = both.filter("slice >= 0").select("slice", "small", "cell", "count").repartition("slice")
    out = np.zeros(cells, dtype=np.uint8)
    for k, piece in pieces.mapInPandas(_merge_counts(part), "slice int, rough binary").collect():
        out[k * part:(k + 1) * part] = np.frombuffer(piece, dtype=np.uint8)
    rows = both.filter("slice < 0").select(
        F.col("id").cast(docs.schema["__llm_id"].dataType).alias("__llm_id"), F.col("th").alias("__llm_th"),
        "n", "h", "s")
    return rows, out


def _needed(size: int, percent: int) -> int:
    """ceil(t * size): the least overlap of a set of this size with one that it links with."""
    return (percent * size + 99) // 100


def _prefixes(docs: DataFrame, counts, n: int, percent: int) -> DataFrame:
    """(s, token, salts, part): each text's prefix n-grams, over how many windows each n-gram is dealt and to which
    of them the text's node goes."""

    @F.pandas_udf("s long, token array<long>, salts array<int>")
    def prefixed(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        cells = len(counts.value)
        salts = (np.exp2(np.arange(256) / 8) / GROUP).astype(np.int32) + 1
        for texts in parts:
            names, tokens, dealt = [], [], []
            for t in texts:
                x = wordhash.shingle_set(t, n)
                c = counts.value[_cell(x, cells)]
                least = _needed(len(x), percent)
                first = np.argsort(c, kind="stable")[:len(x) - least + min(SHARED, least)]
                names.append(_short(signature(x), len(x)) if len(x) else 0)
                tokens.append(x[first].view(np.int64))
                dealt.append(salts[c[first]])
            yield pd.DataFrame({"s": np.array(names, dtype=np.int64), "token": pd.Series(tokens, dtype="object"),
                                "salts": pd.Series(dealt, dtype="object")})

    made = docs.select(prefixed("text").alias("p"))
    rows = made.select("p.s", F.explode(F.arrays_zip("p.token", "p.salts")).alias("x")).select(
        "s", F.col("x.token").alias("token"), F.col("x.salts").alias("salts"))
    return rows.withColumn("part", F.pmod(F.xxhash64("s"), F.col("salts")))


def _meeting(rows: DataFrame, percent: int) -> DataFrame:
    """The rows (s, token, salts, part) whose n-gram another node of a near size has, with the smallest node of their run.

    A run is a stretch of the window's nodes, by name, without a gap in the size classes that no link can cross.
    """
    along = Window.partitionBy("token", "part").orderBy("s")
    gap = F.shiftright("s", 56) - F.shiftright(F.lag("s").over(along), 56) > _reach(percent)
    cut = rows.withColumn("gap", F.when(gap, 1).otherwise(0))
    runs = cut.withColumn("run", F.sum("gap").over(along)).drop("gap")
    own = Window.partitionBy("token", "part", "run")
    return (runs.withColumn("lead", F.min("s").over(own)).withColumn("last", F.max("s").over(own))
            .filter("lead <> last or salts > 1").drop("last", "run"))


def _groups(nodes: DataFrame, prefixes: DataFrame, percent: int) -> DataFrame:
    """(grp, node): the nodes that share a prefix n-gram, by the smallest of them."""
    # rows of copies are equal and share a window, so that telling them once needs no further shuffle
    met = materialize(_meeting(prefixes, percent).drop("lead").distinct(), "op6-met")
    # a partner holds at least ceil(t * ceil(t * n)) n-grams of its own overlap, and shares as many up to SHARED
    least = F.ceil(F.lit(percent) * F.ceil(F.lit(percent) * F.col("n") / 100) / 100)
    for _ in range(2):
        shares = met.groupBy("s").agg(F.count(F.lit(1)).alias("shares"))
        able = nodes.select("s", F.least(F.lit(SHARED), least).alias("need")).join(shares, "s").filter(
            "shares >= need").select("s").distinct()
        able_rows = met.join(materialize(able, "op6-able"), "s", "left_semi")
        met = materialize(_meeting(able_rows, percent).drop("lead"), "op6-met")
    led = materialize(_meeting(met, percent), "op6-led")
    plain = led.filter("salts = 1").select(F.col("lead").alias("grp"), "s")
    hot = led.filter("salts > 1")
    tops = hot.groupBy("token").agg(F.min("lead").alias("grp"), F.max("s").alias("last")).filter("grp <> last")
    both = plain.unionByName(hot.join(materialize(tops.select("token", "grp"), "op6-tops"), "token").select("grp", "s"))
    return both.distinct().join(nodes.select("s", "node"), "s").select("grp", "node")


class _Forest:
    """Union-find that remembers the smallest member."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        root = x
        while self.up.get(root, root) != root:
            root = self.up[root]
        while self.up.get(x, x) != root:
            self.up[x], x = root, self.up[x]
        return root

    def link(self, x: int, y: int) -> None:
        a, b = self.find(x), self.find(y)
        if a != b:
            self.up[max(a, b)] = min(a, b)
            self.up.setdefault(min(a, b), min(a, b))


def trie_join(left: list[np.ndarray], right: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """All (i, j) with left[i] and right[j] similar enough. Sets are arrays of distinct numbers.

    N-grams of one set only cannot overlap and count by the sizes alone. The others are ranked, frequent ones
    first; the left sets, sorted as rank lists, are a trie whose nodes are stretches of the sorted order.
    """
    sizes = [np.array([len(s) for s in side], dtype=np.int64) for side in (left, right)]
    if not len(left) or not len(right):
        return []
    tokens, inverse, seen = np.unique(np.concatenate([*left, *right]), return_inverse=True, return_counts=True)
    rank = np.empty(len(tokens), dtype=np.int64)
    rank[np.argsort(-seen, kind="stable")] = np.arange(len(tokens))
    shared = int((seen > 1).sum())
    ranked, at = [], 0
    for s in (*left, *right):
        r = np.sort(rank[inverse[at:at + len(s)]])
        ranked.append(r[:np.searchsorted(r, shared)])
        at += len(s)
    paths, probes = ranked[:len(left)], ranked[len(left):]
    order = sorted(range(len(paths)), key=lambda i: paths[i].astype(">u4").tobytes())
    paths = [paths[i] for i in order]
    n_left, n_right = sizes[0][order], sizes[1]
    long_left = np.array([len(p) for p in paths])
    long_right = np.array([len(p) for p in probes])
    # postings: for each n-gram the probes that hold it
    flat = np.concatenate(probes) if len(probes) else np.empty(0, dtype=np.int64)
    owner = np.repeat(np.arange(len(probes)), long_right)
    by = np.argsort(flat, kind="stable")
    owner, bounds = owner[by], np.searchsorted(flat[by], np.arange(shared + 1))
    out: list[tuple[int, int]] = []

    def need(least_left: int, of: np.ndarray) -> np.ndarray:
        """The overlap that a set of at least this size needs with each probe."""
        return -(-percent * (least_left + n_right[of]) // (100 + percent))

    def common(a: np.ndarray, b: np.ndarray, depth: int) -> int:
        m = min(len(a), len(b))
        differs = np.flatnonzero(a[depth:m] != b[depth:m])
        return depth + int(differs[0]) if len(differs) else m

    def overlap(tokens_: np.ndarray, so_far: np.ndarray) -> np.ndarray:
        if not len(tokens_):
            return so_far
        hits = np.concatenate([owner[bounds[k]:bounds[k + 1]] for k in tokens_])
        return so_far + np.bincount(hits, minlength=len(probes))

    stack = [(0, len(paths), 0, np.zeros(len(probes), dtype=np.int64), np.arange(len(probes)))]
    while stack:
        lo, hi, depth, have, active = stack.pop()
        end = common(paths[lo], paths[hi - 1], depth) if hi - lo > 1 else len(paths[lo])
        have = overlap(paths[lo][depth:end], have)
        left_over = np.minimum(long_left[lo:hi].max() - end, long_right[active] - have[active])
        sizes_lo, sizes_hi = n_left[lo:hi].min(), n_left[lo:hi].max()
        alive = ((have[active] + left_over >= need(sizes_lo, active))
                 & (100 * n_right[active] >= percent * sizes_lo) & (100 * sizes_hi >= percent * n_right[active]))
        active = active[alive]
        if not len(active):
            continue
        while lo < hi and long_left[lo] == end:  # paths that end here
            o = have[active]
            ok = 100 * o >= percent * (n_left[lo] + n_right[active] - o)
            out += [(order[lo], int(j)) for j in active[ok]]
            lo += 1
        if lo < hi:
            heads = np.array([paths[i][end] for i in range(lo, hi)])
            cuts = [lo, *(lo + 1 + np.flatnonzero(heads[1:] != heads[:-1])), hi]
            stack += [(a, b, end, have, active) for a, b in zip(cuts, cuts[1:])]
    return out


def _join_blocks(percent: int):
    """For rows (grp, i, j, own, node, set) sorted by (grp, i, j): the forest of each block pair's links."""

    def forest(rows: list[tuple]) -> list[tuple[int, int]]:
        i, j = rows[0][1], rows[0][2]
        nodes = [[r[4] for r in rows if r[3] == k] for k in (i, j)]
        sets = [[np.frombuffer(r[5], dtype=np.uint64) for r in rows if r[3] == k] for k in (i, j)]
        f = _Forest()
        for a, b in trie_join(sets[0], sets[1], percent):
            if nodes[0][a] != nodes[1][b]:
                f.link(nodes[0][a], nodes[1][b])
        return [(x, f.find(x)) for x in f.up if f.find(x) != x]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows: list[tuple] = []
        out: list[tuple[int, int]] = []
        for b in batches:
            for row in b.itertuples(index=False, name=None):
                if rows and rows[0][:3] != row[:3]:
                    out += forest(rows)
                    rows = []
                rows.append(row)
            if len(out) > 10_000:
                yield pd.DataFrame(out, columns=["a", "b"])
                out = []
        if rows:
            out += forest(rows)
        yield pd.DataFrame(out, columns=["a", "b"]).astype("int64")
    return run


def _blocks(members: DataFrame, block: int) -> DataFrame:
    """(grp, node, n, own): the nodes (grp, node, n) of each group of more than one in blocks that rise with the set size.

    A block has about `block` sets and `BLOCK_NGRAMS` n-grams at most (a larger set is a block of its own). No task holds a
    group: the sets of one size are counted, the counts summed along the sizes, and a hash spreads
    equal sizes over their stretch.
    """
    load = F.greatest(F.lit(1.0 / block), F.col("n") / F.lit(float(BLOCK_NGRAMS)))
    sizes = members.groupBy("grp", "n").agg(F.count(F.lit(1)).alias("c")).withColumn("load", F.col("c") * load)
    along = Window.partitionBy("grp").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("base", F.coalesce(F.sum("load").over(along), F.lit(0.0)))
    sizes = sizes.withColumn("all", F.sum("c").over(Window.partitionBy("grp"))).filter("all > 1").drop("all", "c")
    share = F.shiftrightunsigned(F.xxhash64("node"), 11).cast("double") / F.lit(float(2 ** 53))
    # both sides plain shuffles, so that Spark can split a hot group
    return members.join(materialize(sizes, "op6-sizes"), ["grp", "n"]).withColumn(
        "own", F.floor(F.col("base") + F.col("load") * share).cast("int")).select("grp", "node", "n", "own")


def _pairs(blocks: DataFrame, percent: int) -> DataFrame:
    """(grp, i, j, i <= j): pairs of blocks with sizes that can link."""
    ranges = materialize(blocks.groupBy("grp", "own").agg(F.min("n").alias("least"), F.max("n").alias("most")), "op6-ranges")
    i = ranges.select("grp", F.col("own").alias("i"), F.col("most").alias("most_i"))
    j = ranges.select("grp", F.col("own").alias("j"), F.col("least").alias("least_j"))
    return i.join(j, "grp").filter((F.col("i") <= F.col("j")) & (100 * F.col("most_i") >= percent * F.col("least_j"))
                                   ).select("grp", "i", "j")


def _compare(docs: DataFrame, nodes: DataFrame, blocks: DataFrame, pairs: DataFrame, n: int, percent: int) -> DataFrame:
    """(a, b), a > b: a written forest of the links between the sets of each pair of blocks."""
    one = blocks.join(pairs, (blocks["grp"] == pairs["grp"]) & (blocks["own"] == pairs["i"]))
    two = blocks.join(pairs.filter("i < j"), (blocks["grp"] == pairs["grp"]) & (blocks["own"] == pairs["j"]))
    placed = one.select(blocks["grp"], "node", "own", "i", "j").unionByName(
        two.select(blocks["grp"], "node", "own", "i", "j"))
    placed = materialize(placed.join(nodes.select("node", "h"), "node"), "op6-placed")
    filt = docs.sparkSession.sparkContext.broadcast(bloom(placed.select("h").distinct(), "once"))

    def sets_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            sets = [wordhash.shingle_set(t, n) for t in b["text"]]
            sets = [x for x in sets if len(x)]
            sigs = pd.Series([signature(x) for x in sets], dtype="object")
            some = np.flatnonzero(may_hold(filt.value, sigs))
            yield pd.DataFrame({"h": [sigs[k] for k in some], "set": [sets[k].tobytes() for k in some]})

    made = docs.select("text").mapInPandas(sets_of, "h binary, set binary")
    # copies have one node: their set is kept once, map-side first; the join needs no further shuffle of the sets
    own = made.groupBy("h").agg(F.first("set").alias("set"))
    rows = (placed.join(own, "h").select("grp", "i", "j", "own", "node", "set")
            .repartition("grp", "i", "j").sortWithinPartitions("grp", "i", "j"))
    return materialize(rows.mapInPandas(_join_blocks(percent), "a long, b long").distinct(), "op6-links")


def _links(docs: DataFrame, nodes: DataFrame, prefixes: DataFrame, n: int, percent: int, block: int) -> DataFrame:
    """(a, b), a > b: verified links that connect all linked nodes.

    Blocks of neighbouring sizes are compared first. Of the other pairs of blocks those remain whose nodes
    are not all connected by then: a family of near copies is connected along its sizes, so its pairs are few.
    """
    members = materialize(_groups(nodes, prefixes, percent).join(nodes.select("node", "n"), "node"), "op6-members")
    blocks = materialize(_blocks(members, block), "op6-blocks")
    pairs = materialize(_pairs(blocks, percent), "op6-pairs")
    links = _compare(docs, nodes, blocks, pairs.filter("j - i <= 1"), n, percent)
    far = pairs.filter("j - i > 1")
    if far.isEmpty():
        return links
    roots = materialize(connected(links), "op6-roots")
    rooted = blocks.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    whole = materialize(rooted.groupBy("grp", "own").agg(F.min("root").alias("r"), F.max("root").alias("top"))
                        .filter("r = top").drop("top"), "op6-whole")
    done = far.join(whole.select("grp", F.col("own").alias("i"), F.col("r").alias("r_i")), ["grp", "i"]).join(
        whole.select("grp", F.col("own").alias("j"), F.col("r").alias("r_j")), ["grp", "j"]).filter("r_i = r_j")
    left = materialize(far.join(done.select("grp", "i", "j"), ["grp", "i", "j"], "left_anti"), "op6-pairs")
    if left.isEmpty():
        return links
    return links.unionByName(_compare(docs, nodes, blocks, left, n, percent)).distinct()


def connected(links: DataFrame) -> DataFrame:
    """(node, root) of all nodes with a link; root is the smallest node of the component."""
    edges = materialize(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                        .distinct(), "op6-edges")

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.col("a").cast("decimal(38,0)")
                     + F.col("b"))).first())

    before = None
    while (now := state(edges)) != before:
        before = now
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = materialize(large.filter("a <> b").distinct(), "op6-large")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").filter("b <> m").select(
            F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b"))
        small = small.unionByName(least.select("a", F.col("m").alias("b")))
        edges = materialize(small.distinct(), "op6-small")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _solve(docs: DataFrame, n: int, percent: int, id_col: str, text_col: str, block: int) -> DataFrame:
    """A written table (__llm_id, __llm_th, n, component_id) of all rows."""
    spark = docs.sparkSession
    bounded_batches(spark, 256)
    slim = docs.select(*mark_of(id_col, text_col), text_or_empty(text_col).alias("text"))
    rows, counters = signed(slim, n)
    counts = spark.sparkContext.broadcast(counters)
    rows = materialize(rows.withColumn("uid", F.monotonically_increasing_id()), "op6-rows")
    filled = rows.filter("n > 0")
    nodes = materialize(filled.groupBy("h").agg(F.min("uid").alias("node"), F.min("__llm_id").alias("least"),
                                                F.first("s").alias("s"), F.first("n").alias("n")), "op6-nodes")
    links = _links(slim, nodes, _prefixes(slim, counts, n, percent), n, percent, block)
    roots = materialize(connected(links), "op6-roots")
    own = nodes.select("h", "node", "least").join(roots, "node", "left").withColumn(
        "root", F.coalesce("root", "node"))
    own = materialize(own, "op6-own")
    least = materialize(own.groupBy("root").agg(F.min("least").alias("component_id")), "op6-least")
    named = materialize(own.join(least, "root").select("h", "component_id"), "op6-named")
    linked = filled.join(named, "h").select("__llm_id", "__llm_th", "n", "uid", "component_id")
    empty = rows.filter("n = 0").select("__llm_id", "__llm_th", "n", "uid", F.col("__llm_id").alias("component_id"))
    return linked.unionByName(empty)


def components(docs: DataFrame, n: int = 4, percent: int = 85, id_col: str = "doc_id", text_col: str = "text",
               block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id for every row."""
    return _solve(docs, n, percent, id_col, text_col, block).select(
        F.col("__llm_id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id")


def representatives(docs: DataFrame, n: int = 4, percent: int = 85, id_col: str = "doc_id", text_col: str = "text",
                    block: int = BLOCK) -> DataFrame:
    """The rows of `docs`, all columns, without those that link to a smaller id: one of each component stays.

    Documents without words all stay; of rows with the component's id one stays, and of nothing but null ids all.
    """
    rows = materialize(_solve(docs, n, percent, id_col, text_col, block), "op6-rows")
    whole = (F.col("n") == 0) | F.col("component_id").isNull()
    own = rows.filter(~whole & (F.col("__llm_id") == F.col("component_id")))
    nth = F.row_number().over(Window.partitionBy("component_id").orderBy("uid"))
    kept = (rows.filter(whole).withColumn("kept", F.lit(True))
            .unionByName(own.withColumn("kept", nth == 1)))
    marks = (kept.groupBy("__llm_id", "__llm_th").agg(F.sum(F.col("kept").cast("long")).alias("__llm_copies")))
    total = rows.groupBy("__llm_id", "__llm_th").agg(F.count(F.lit(1)).alias("__llm_rows"))
    marks = marks.select(F.col("__llm_id").alias("i"), F.col("__llm_th").alias("t"), "__llm_copies")
    lost = total.join(marks, F.col("__llm_id").eqNullSafe(F.col("i")) & (F.col("__llm_th") == F.col("t")), "left")
    lost = lost.withColumn("__llm_copies", F.coalesce("__llm_copies", F.lit(0))).filter("__llm_copies < __llm_rows")
    return drop_rows(docs, materialize(lost.drop("i", "t"), "op6-lost"), id_col, text_col)


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN []
                      WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
                      ELSE list_distinct(list_transform(range(1, len(ws) - 2),
                               lambda i: array_to_string(ws[CAST(i AS INTEGER):CAST(i AS INTEGER) + 3], ' '))) END AS ss
  FROM w),
e AS (SELECT doc_id, md5(unnest(ss)) AS g FROM s),
o AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM e a JOIN e b USING (g)
      WHERE a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM o JOIN s p ON p.doc_id = x JOIN s q ON q.doc_id = y
      WHERE 100 * k >= 85 * (len(p.ss) + len(q.ss) - k)),
both_ways AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
reach(x, y) AS (SELECT doc_id, doc_id FROM s UNION SELECT r.x, b.y FROM reach r JOIN both_ways b ON b.x = r.y)
SELECT s.doc_id, CAST(len(ss) AS BIGINT) AS n_shingles, c.component_id
FROM s JOIN (SELECT x, min(y) AS component_id FROM reach GROUP BY x) c ON c.x = s.doc_id
"""
