"""Ranked lexical search: best-first document intervals over range-maximum tables of the posting lists.

1. The texts are read once for a block of items: every document's number of terms, and of the block's terms
   that it holds the counts. That forward list is written; N, L and the document frequencies come from it.
2. Every task turns its part of the forward list into segments of at most `SEGMENT` postings (a longer
   document is a segment of its own). A segment numbers its documents by id and holds one
   posting list per term with each posting's impact, and over the lists a sparse table that answers range-maximum
   queries: where in a stretch of a list the largest impact lies.
3. An item starts with the interval of all of a segment's documents. Every interval knows its stretch of each term's
   list; the sum of the stretches' weighted maxima bounds every score inside. The intervals of the best
   bounds are taken first, `TAKEN` at a time, and split at the document of their largest single impact, which is scored;
   intervals of at most `LEAF` postings are scored as a whole. The search ends where no bound reaches the k-th best
   score, that of earlier segments of the task included.
4. The k best of a segment are candidates. The largest k-th score of any segment is a floor for
   all; what reaches it is ranked.

Scores are whole numbers and every bound is exact, so the result is. Items go in blocks of about
`BLOCK_BYTES` of text, drawn by hash: a block's terms and items are what is broadcast.

Defined cases: a null, empty or term-less text counts as no document; a null or term-less item has no rows; rows
that share an id are ranked each; a null id comes after all others on ties; equal item rows are asked once, rows
of one item id with different texts apart; fewer than k documents above 0 are all returned; texts
of any length are read whole, long ones match by match; extra columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bazaar.llm.common import LOWER, UPPER, bounded_batches, materialize, text_or_empty

#: Fixed value: what a term is, after A-Z are lower-cased.
TERM = "[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+"
BLOCK_BYTES = 16 << 20
SEGMENT = 1 << 20
LEAF = 2048
TAKEN = 16
LONG = 1 << 20

_TERM = re.compile(TERM)
_LOWER = str.maketrans(UPPER, LOWER)


def term_counts(text: str) -> Counter:
    """How often each term occurs in a text."""
    text = text.translate(_LOWER)
    if len(text) > LONG:
        return Counter(m.group() for m in _TERM.finditer(text))
    return Counter(_TERM.findall(text))


class Item(NamedTuple):
    """An item's terms, as numbers, and how often it holds each."""
    number: int
    terms: np.ndarray
    times: np.ndarray


def forward_list(docs: DataFrame, numbers, id_col: str, text_col: str) -> DataFrame:
    """(id, n, terms, tf): each row's number of terms; of the broadcast terms those it holds, and how often."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = numbers.value
        for batch in batches:
            n, held, tf, ends = [], [], [], [0]
            for text in batch.column(1):
                counts = term_counts(text.as_py())
                n.append(counts.total())
                mine = [(number[t], c) for t, c in counts.items() if t in number]
                held += [t for t, _ in mine]
                tf += [c for _, c in mine]
                ends.append(len(held))
            at = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.ListArray.from_arrays(at, pa.array(held, pa.int32())),
                 pa.ListArray.from_arrays(at, pa.array(tf, pa.int64()))], ["id", "n", "terms", "tf"])

    slim = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    kind = f"id {slim.schema['id'].dataType.simpleString()}, n long, terms array<int>, tf array<long>"
    return slim.mapInArrow(run, kind)


class Segment:
    """The posting lists of some documents, in the order of their ids, with a range-maximum table."""

    def __init__(self, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, n_docs: int, n_terms: int):
        order = np.lexsort((doc, term))
        self.n_docs = n_docs
        self.doc, self.impact = doc[order], impact[order]
        self.place = term[order].astype(np.int64) * n_docs + self.doc
        self.start = np.searchsorted(term[order], np.arange(n_terms + 1))
        longest = int(np.diff(self.start).max(initial=1))
        # level j holds for every posting the place of the largest impact among it and its next 2^j - 1; lists stand
        # end to end, and a stretch within one list never meets another's postings
        self.table = np.empty((longest.bit_length(), len(doc)), dtype=np.int32)
        self.table[0] = np.arange(len(doc))
        for j in range(1, len(self.table)):
            half = 1 << (j - 1)
            a, b = self.table[j - 1][:-half], self.table[j - 1][half:]
            self.table[j] = self.table[j - 1]
            self.table[j][:len(a)] = np.where(self.impact[a] >= self.impact[b], a, b)

    def largest(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Where the largest impact of each stretch [lo, hi) lies (anywhere, where the stretch is empty)."""
        level = np.frexp(np.maximum(hi - lo, 1).astype(np.float64))[1] - 1
        a = self.table[level, np.minimum(lo, len(self.doc) - 1)]
        b = self.table[level, np.maximum(hi - (1 << level), 0)]
        return np.where(self.impact[a] >= self.impact[b], a, b)

    def search(self, terms: np.ndarray, weights: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores of the k best that reach `floor` (at least 1), best first, ties to the smaller document."""
        lo, hi = self.start[terms], self.start[terms + 1]
        some = (hi > lo) & (weights > 0)
        terms, weights, lo, hi = terms[some], weights[some], lo[some], hi[some]
        top: list[tuple[int, int]] = []  # a heap of (score, -document)
        if not len(terms):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        keys = terms.astype(np.int64) * self.n_docs

        def offer(docs: np.ndarray, scores: np.ndarray) -> None:
            least = top[0][0] if len(top) == k else floor
            for d, s in zip(*(x[scores >= least].tolist() for x in (docs, scores))):
                if len(top) < k:
                    heapq.heappush(top, (s, -d))
                else:
                    heapq.heappushpop(top, (s, -d))

        def hopeless(bound: int, first: int) -> bool:
            return bound < floor or (len(top) == k and (bound, -first) < top[0])

        def score_all(lo: np.ndarray, hi: np.ndarray) -> None:
            """Score every document of the intervals whose stretches are the rows of lo and hi."""
            size = (hi - lo).ravel()
            at = np.arange(size.sum()) + np.repeat(lo.ravel() - (np.cumsum(size) - size), size)
            worth = self.impact[at] * np.repeat(np.broadcast_to(weights, lo.shape).ravel(), size)
            docs, own = np.unique(self.doc[at], return_inverse=True)
            scores = np.zeros(len(docs), dtype=np.int64)
            np.add.at(scores, own, worth)
            offer(docs, scores)

        first = int((self.impact[self.largest(lo, hi)] * weights).sum())
        waiting = [(-first, 0, lo, hi)]
        while waiting:
            taken, small = [], []
            while waiting and len(taken) + len(small) < TAKEN:
                bound, begin, lo, hi = heapq.heappop(waiting)
                if hopeless(-bound, begin):
                    continue
                (small if (hi - lo).sum() <= LEAF else taken).append((begin, lo, hi))
            if small:
                score_all(np.array([x[1] for x in small]), np.array([x[2] for x in small]))
            if not taken:
                continue
            lo, hi = np.array([x[1] for x in taken]), np.array([x[2] for x in taken])
            best = self.largest(lo, hi)
            value = np.where(hi > lo, self.impact[best] * weights, -1)
            row = np.arange(len(taken))
            split = self.doc[best[row, value.argmax(axis=1)]].astype(np.int64)
            mid = np.clip(np.searchsorted(self.place, keys + split[:, None]), lo, hi)
            there = (mid < hi) & (self.doc[np.minimum(mid, len(self.doc) - 1)] == split[:, None])
            offer(split, (np.where(there, self.impact[np.minimum(mid, len(self.doc) - 1)], 0) * weights).sum(axis=1))
            los, his = np.concatenate([lo, mid + there]), np.concatenate([mid, hi])
            begins = [x[0] for x in taken] + (split + 1).tolist()
            bounds = np.where(his > los, self.impact[self.largest(los, his)], 0) * weights
            for i, bound in enumerate(bounds.sum(axis=1).tolist()):
                if bound > 0 and not hopeless(bound, begins[i]):
                    # the document breaks ties, so that heaps never compare arrays: intervals never share their first one
                    heapq.heappush(waiting, (-bound, begins[i], los[i], his[i]))
        top.sort(key=lambda x: (-x[0], -x[1]))
        return np.array([-d for _, d in top], dtype=np.int64), np.array([s for s, _ in top], dtype=np.int64)


def _search_task(share, k: int):
    """For rows of the forward list: each segment's candidates (q, id, score) and its k-th score, where it has k."""
    def segment(rows: list[pa.Table], block: dict) -> pa.RecordBatch | None:
        rows = pa.concat_tables(rows).combine_chunks()
        # nulls last: they lose ties
        rows = rows.take(pc.sort_indices(rows, sort_keys=[("id", "ascending")], null_placement="at_end"))
        lists, tfs = rows["terms"].combine_chunks(), rows["tf"].combine_chunks()
        doc = np.repeat(np.arange(len(rows)), np.diff(lists.offsets.to_numpy()))
        term = lists.flatten().to_numpy(zero_copy_only=False)
        tf = tfs.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        m = 25 + 75 * rows["n"].to_numpy().astype(np.int64) * block["docs"] // block["all"]
        s = Segment(doc, term, 1_000_000_000 * tf // (1000 * tf + 8 * m[doc]), len(rows), len(block["weight"]))
        numbers, docs, scores, floors = [], [], [], []
        for item in block["items"]:
            floor = block["floor"].get(item.number, 1)
            d, score = s.search(item.terms, block["weight"][item.terms] * item.times, k, floor)
            own = int(score[-1]) if len(score) == k else 0
            if own > floor:
                block["floor"][item.number] = own
            numbers.append(np.full(len(d), item.number))
            docs.append(d)
            scores.append(score)
            floors.append(np.full(len(d), own))
        at = np.concatenate(docs)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(numbers), pa.int64()), rows["id"].combine_chunks().take(pa.array(at)),
             pa.array(np.concatenate(scores), pa.int64()), pa.array(np.concatenate(floors), pa.int64())],
            ["q", "id", "score", "floor"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = {**share.value, "floor": {}}
        held, size = [], 0
        for batch in batches:
            ends = batch.column(2).offsets.to_numpy()
            ends = ends - ends[0]
            begin = 0
            while begin < len(batch):
                # as many rows as still fit, at least one
                end = max(begin + 1, int(np.searchsorted(ends, ends[begin] + SEGMENT - size, side="right")) - 1)
                held.append(pa.Table.from_batches([batch.slice(begin, end - begin)]))
                size += int(ends[end] - ends[begin])
                begin = end
                if begin < len(batch) or size >= SEGMENT:
                    yield segment(held, block)
                    held, size = [], 0
        if held:
            yield segment(held, block)
    return run


def _block(docs: DataFrame, items: DataFrame, k: int, id_col: str, text_col: str) -> DataFrame:
    """(q, doc_id, score) that may be among the k best of the items (q, text): a block of a bounded size."""
    spark = docs.sparkSession
    numbers: dict[str, int] = {}
    asked = []
    for q, text in items.collect():
        counts = term_counts(text)
        terms = [numbers.setdefault(t, len(numbers)) for t in counts]
        if terms:
            asked.append(Item(q, np.array(terms, dtype=np.int64), np.array(list(counts.values()), dtype=np.int64)))
    listed = materialize(forward_list(docs, spark.sparkContext.broadcast(numbers), id_col, text_col), "op11-forward")
    n_docs, n_terms = listed.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(numbers), dtype=np.int64)
    for t, n in listed.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
        df[t] = n
    weight = np.floor(1000 * np.log((2.0 * n_docs + 2) / (2.0 * df + 1))).astype(np.int64)
    share = spark.sparkContext.broadcast({"items": asked, "weight": weight, "docs": n_docs, "all": max(n_terms, 1)})
    kind = f"q long, id {listed.schema['id'].dataType.simpleString()}, score long, floor long"
    found = materialize(listed.filter(F.size("terms") > 0).mapInArrow(_search_task(share, k), kind), "op11-found")
    floors = found.groupBy("q").agg(F.max("floor").alias("least"))
    # a row per item of the block
    return found.join(F.broadcast(floors), "q").filter("score >= least").select("q", F.col("id").alias("doc_id"), "score")


def rank(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
         item_id: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the k documents of each item with the highest scores above 0."""
    bounded_batches(docs.sparkSession)
    asked = items.select(F.col(item_id).alias("item_id"), F.col(item_text).cast("string").alias("text"))
    asked = asked.filter(F.length("text") > 0).distinct().withColumn("q", F.monotonically_increasing_id())
    asked = materialize(asked, "op11-items")
    total = asked.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = int(-(-total // block_bytes)) or 1
    parts = [_block(docs, asked.filter(F.pmod(F.xxhash64("q"), F.lit(blocks)) == b).select("q", "text"), k, id_col,
                    text_col) for b in range(blocks)]
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    order = Window.partitionBy("q").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return best.join(asked.select("q", "item_id"), "q").select("item_id", "rank", "doc_id", "score")


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents WHERE text IS NOT NULL),
totals AS (SELECT count(*) AS big_n, sum(len(ts)) AS big_l FROM d WHERE len(ts) > 0),
tf AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(ts) AS t FROM d) GROUP BY ALL),
df AS (SELECT t, count(*) AS df FROM tf GROUP BY t),
q AS (
  SELECT item_id, t, count(*) AS times
  FROM (SELECT item_id, unnest(regexp_extract_all(
                 translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark)
  GROUP BY ALL),
worth AS (
  SELECT item_id, tf.r,
         times * CAST(floor(1000 * ln((2.0::DOUBLE * big_n + 2) / (2.0::DOUBLE * df + 1))) AS BIGINT)
           * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * len(ts) * big_n) // big_l))) AS x
  FROM q JOIN df USING (t) JOIN tf USING (t) JOIN d ON d.r = tf.r, totals),
scored AS (SELECT item_id, r, CAST(sum(x) AS BIGINT) AS score FROM worth GROUP BY ALL HAVING sum(x) > 0)
SELECT item_id, CAST(row_number() OVER w AS INTEGER) AS rank, doc_id, score
FROM scored JOIN d USING (r)
WINDOW w AS (PARTITION BY item_id ORDER BY score DESC, doc_id)
QUALIFY row_number() OVER w <= 10
"""
