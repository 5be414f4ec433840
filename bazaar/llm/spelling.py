"""Spelling variants: words within one edit, by dynamic programming along sorted lists.

1. Every run of letters is cut out of the texts by column expressions and counted; counts are combined before they are
   shuffled, so a frequent word moves as one row per task.
2. The words of length L and L + 1 are a block. A block of more than `BLOCK` words (or `BLOCK_CHARS`
   code points that they do not share) is halved by what its words share: of two words within one edit, either the first or the second half of
   what the block does not share yet is equal. So its words go to two lists of blocks, one by the first half
   and one by the second. That goes on until every block is small; blocks whose words differ in two
   code points at most are bounded by the alphabet. A pair belongs to the one block that its first difference points to.
3. The words of a block are sorted. The edit matrix of a word against the whole list has a band of three cells,
   and a row of it depends on the list word's prefix only: it is computed once for all
   adjacent words that share the prefix (their LCP says so), and once its cells all exceed one edit the whole
   range of words with that prefix is skipped. The matrices of all words of many blocks advance together,
   one prefix length after the other.
4. A task sends per word its number of near words and the best of them, never the pairs. The words' best near words
   are their forms; roots follow the forms by pointer doubling, as counts grow fivefold along them.

Defined cases: a null or empty text has no runs; a null id deletes no code point; texts and words of any length are
taken whole; equal rows count each; ties between near words go to the smaller in code-point order; extra
columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaar.llm.common import ascii_lower, materialize, text_or_empty

#: Fixed value: the letters of a run.
LETTERS = "A-Za-zÀ-ÿ"
BLOCK = 512
BLOCK_CHARS = 1 << 20
#: How many words' matrices advance at once, and how many code points the lists of a step have when padded.
TOGETHER = 4096
CELLS = 1 << 22


def word_counts(docs: DataFrame, min_len: int, min_count: int, one_in: int, id_col: str, text_col: str) -> DataFrame:
    """(word, n) of the words of at least `min_len` code points that occur `min_count` times.

    One in `one_in` occurrences, as the CRC-32 of id and run decides, has lost the code point that it points to.
    """
    # runs that are shorter before the deletion are so after it
    runs = F.regexp_extract_all(ascii_lower(text_or_empty(text_col)), F.lit(f"[{LETTERS}]{{{min_len},}}"), F.lit(0))
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.explode(runs).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = F.pmod(F.col("h"), F.char_length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    words = rows.withColumn("h", h).select(
        F.when(F.pmod("h", F.lit(one_in)) == 0, cut).otherwise(F.col("run")).alias("word"))
    counts = words.filter(F.char_length("word") >= min_len).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.col("n") >= min_count)


def _key(size: Column, before: Column, after: Column) -> Column:
    """The block of a word: its class, and the `before` first and `after` last code points that it shares."""
    return F.xxhash64(size, before, after, F.substring("word", F.lit(1), before),
                      F.substring("word", F.char_length("word") - after + 1, after))


def blocks_of(words: DataFrame, block: int = BLOCK, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(key, size, before, after, until, word, n): each word once per block it is in.

    `size` is the smaller length of the block's words. All share their `before` first and `after` last code points. A
    pair is looked for in the block where its first difference lies from `before` to below `until`.
    """
    sizes = F.array(F.char_length("word") - 1, F.char_length("word"))
    rows = words.select("word", "n", F.explode(sizes).alias("size"), F.lit(0).alias("before"), F.lit(0).alias("after"),
                        F.lit(2 ** 31 - 1).alias("until"))
    rows = materialize(rows.withColumn("key", _key(*map(F.col, ("size", "before", "after")))), "op12-blocks")
    done = []
    while True:
        apart = F.col("size") - F.col("before") - F.col("after")
        large = rows.groupBy("key", "size", "before", "after").agg(F.count(F.lit(1)).alias("c")).filter(
            (apart > 1) & (F.col("c") > 1) & ((F.col("c") > block) | (F.col("c") * apart > block_chars)))
        large = large.select("key").distinct()
        large = materialize(large, "op12-large")
        if large.isEmpty():
            done.append(rows)
            break
        done.append(rows.join(large, "key", "left_anti"))
        turned = rows.join(large, "key", "left_semi").withColumn("half", F.floor(apart / 2).cast("int"))
        first = turned.withColumn("before", F.col("before") + F.col("half")).filter("before < until")
        # the difference lies within the first half: what follows it is shared
        second = turned.withColumn("until", F.least("until", F.col("before") + F.col("half"))).withColumn(
            "after", F.col("after") + F.col("half"))
        rows = first.unionByName(second).drop("half", "key")
        rows = rows.withColumn("key", _key(*map(F.col, ("size", "before", "after"))))
        rows = materialize(rows.select(*done[0].columns), "op12-blocks")
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d.select(*out.columns))
    return out


def near_in_lists(words: list[str], starts: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Arrays (i, j, d): words[i] has its list's size, words[j] of the same list is one edit away, d is where they differ first.

    `words` holds sorted lists end to end, `starts` where each begins; the words of list k have `sizes[k]` or one code point
    more. Pairs of equal length come both ways.
    """
    length = np.array([len(w) for w in words])
    m, width = len(words), int(length.max(initial=0)) + 1
    code = np.zeros((m, width + 1), dtype=np.uint32)
    code[np.arange(width + 1) < length[:, None]] = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
    lcp = np.zeros(m, dtype=np.int64)
    lcp[1:] = np.logical_and.accumulate((code[1:] == code[:-1]) & (code[1:] > 0), axis=1).sum(axis=1)
    lcp[starts] = -1
    own = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, m)))
    asked = np.flatnonzero(length == sizes[own])
    # for each prefix length: where a range of words with an equal prefix begins, and which of them go on
    ranges = [np.append(np.flatnonzero(lcp < depth), m) for depth in range(width)]
    longer = [np.flatnonzero((lcp < depth + 1) & (length > depth)) for depth in range(width)]
    for part in np.split(asked, range(TOGETHER, len(asked), TOGETHER)):
        size = length[part]
        query = np.zeros((len(part), width + 3), dtype=np.uint32)  # column j + 1 holds code point j
        query[:, 1:width + 2] = code[part]
        # the band of row 0: cells -1, 0 and 1; all words of a list share the empty prefix
        q, lo = np.arange(len(part)), starts[own[part]]
        left, here, right = (np.full(len(part), x, dtype=np.int8) for x in (2, 0, 1))
        for depth in range(width):
            if not len(q):
                break
            # words that end here stand first in their range, more than once only if they are equal
            ends = np.flatnonzero((length[lo] == depth) & (np.abs(depth - size[q]) <= 1))
            if len(ends):
                past = depth - size[q[ends]]
                cell = np.where(past < 0, right[ends], np.where(past == 0, here[ends], left[ends]))
                hit = ends[cell == 1]
                i, j = part[q[hit]], lo[hit]
                yield i, j, (code[i] != code[j]).argmax(axis=1)
            hi = ranges[depth][np.searchsorted(ranges[depth], lo, side="right")]
            first, last = np.searchsorted(longer[depth], lo), np.searchsorted(longer[depth], hi)
            times = last - first
            up = np.repeat(np.arange(len(q)), times)
            child = longer[depth][np.arange(len(up)) - np.repeat(np.cumsum(times) - times - first, times)]
            c, row = code[child, depth], q[up]
            a = np.minimum(left[up] + (c != query[row, depth]), here[up] + 1)
            b = np.minimum(np.minimum(here[up] + (c != query[row, depth + 1]), right[up] + 1), a + 1)
            d = np.minimum(right[up] + (c != query[row, depth + 2]), b + 1)
            alive = (a < 2) | (b < 2) | (d < 2)
            q, lo = row[alive], child[alive]
            left, here, right = (np.minimum(x[alive], 2).astype(np.int8) for x in (a, b, d))


def _near_of_blocks(rows: pa.Table) -> pa.RecordBatch:
    """(word, near, best_n, best): per word and block the near words that the block answers for. `rows` are whole blocks."""
    key, size, before, after, until, n = (rows[c].to_numpy() for c in ("key", "size", "before", "after", "until", "n"))
    words = rows["word"].to_pylist()
    # equal ends do not change the distance, so the lists hold what stands between them
    middle = [w[b:len(w) - a] for w, b, a in zip(words, before.tolist(), after.tolist())]
    order = sorted(range(len(words)), key=list(zip(key.tolist(), middle)).__getitem__)
    at = np.array(order)
    starts = np.append(0, np.flatnonzero(np.diff(key[at])) + 1)
    sizes = (size - before - after)[at[starts]]
    # a block is named by a hash: only words whose ends are equal indeed make a pair
    seen: dict[tuple, int] = {}
    ends = np.array([seen.setdefault((w[:b], w[len(w) - a:]), len(seen))
                     for w, b, a in zip(words, before.tolist(), after.tolist())])
    rank = np.empty(len(words), dtype=np.int64)
    rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    length = np.array([len(w) for w in words])
    found = [(np.empty(0, np.int64),) * 2]
    for i, j, differs in near_in_lists([middle[k] for k in order], starts, sizes):
        i, j = at[i], at[j]
        # equal lengths come both ways: the smaller word's way counts
        ok = (ends[i] == ends[j]) & (before[i] + differs < until[i]) & ((length[i] < length[j]) | (rank[i] < rank[j]))
        found.append((i[ok], j[ok]))
    i, j = (np.concatenate(x) for x in zip(*found))
    x, y = np.concatenate([i, j]), np.concatenate([j, i])
    by = np.lexsort((rank[y], -n[y], x))
    x, y = x[by], y[by]
    first = np.flatnonzero(np.append(True, x[1:] != x[:-1])) if len(x) else np.empty(0, np.int64)
    near = np.diff(np.append(first, len(x)))
    return pa.RecordBatch.from_arrays(
        [pa.array([words[k] for k in x[first]], pa.string()), pa.array(near, pa.int64()), pa.array(n[y[first]], pa.int64()),
         pa.array([words[k] for k in y[first]], pa.string())], ["word", "near", "best_n", "best"])


def _in_steps(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """Whole blocks, answered for together as long as they fit."""
    key = rows["key"].to_numpy()
    starts = np.append(0, np.flatnonzero(np.diff(key)) + 1)
    ends = np.append(starts[1:], len(key))
    apart = pc.subtract(pc.utf8_length(rows["word"]), pc.add(rows["before"], rows["after"])).to_numpy()
    widest = np.maximum.reduceat(apart, starts)
    begin, width = 0, 0
    for lo, hi, w in zip(starts.tolist(), ends.tolist(), widest.tolist()):
        if lo > begin and (hi - begin > 2 * TOGETHER or (hi - begin) * max(width, w) > CELLS):
            yield _near_of_blocks(rows.slice(begin, lo - begin))
            begin, width = lo, 0
        width = max(width, w)
    yield _near_of_blocks(rows.slice(begin))


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For rows sorted by key: the near words that the blocks answer for, streaming over the blocks."""
    rest: pa.Table | None = None
    for batch in batches:
        new = pa.Table.from_batches([batch])
        rest = new if rest is None else pa.concat_tables([rest, new])
        change = np.flatnonzero(np.diff(rest["key"].to_numpy())) + 1
        if len(change) and change[-1] >= TOGETHER:
            yield from _in_steps(rest.slice(0, int(change[-1])))
            rest = rest.slice(int(change[-1]))
    if rest is not None and len(rest):
        yield from _in_steps(rest)


def near_words(words: DataFrame, block: int = BLOCK, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(word, n, n_near, form, form_n): for each of the words (word, n) its near words, and the best."""
    rows = blocks_of(words, block, block_chars).repartition("key").sortWithinPartitions("key")
    parts = rows.mapInArrow(_near, "word string, near long, best_n long, best string")
    own = words.select("word", "n", F.lit(0).cast("long").alias("near"), F.lit(None).cast("long").alias("best_n"),
                       F.lit(None).cast("string").alias("best"))
    every = own.unionByName(parts.withColumn("n", F.lit(None).cast("long")), allowMissingColumns=True)
    best = F.min(F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("m"), "best")))
    return (every.groupBy("word").agg(F.max("n").alias("n"), F.sum("near").alias("n_near"), best.alias("b"))
            .select("word", "n", "n_near", F.col("b.best").alias("form"), (-F.col("b.m")).alias("form_n")))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words (word, form): each follows forms to the last."""
    up = materialize(forms.select("word", F.col("form").alias("root")), "op12-roots")
    while True:
        higher = up.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = materialize(up.join(higher, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "op12-roots")
        up = step.select("word", "root")
        if step.filter("moved").isEmpty():
            return up


def variants(docs: DataFrame, min_len: int = 6, min_count: int = 5, one_in: int = 199, factor: int = 5,
             id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK,
             block_chars: int = BLOCK_CHARS) -> DataFrame:
    """word, form, root, n, n_near, form_n of every distinct word."""
    words = materialize(word_counts(docs, min_len, min_count, one_in, id_col, text_col), "op12-words")
    near = near_words(words, block, block_chars)
    better = F.col("form_n") >= factor * F.col("n")
    near = materialize(near.withColumns({c: F.when(better, F.col(c)) for c in ("form", "form_n")}), "op12-near")
    roots = _roots(near.filter(F.col("form").isNotNull()))
    return near.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


SQL = r"""
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce([n] || range(8)::BIGINT[],
                          lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)
              ORDER BY n) AS tab
  FROM (SELECT unnest(range(256))::BIGINT AS n)),
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run FROM documents),
counted AS (SELECT doc_id, run, count(*) AS times FROM runs GROUP BY ALL),
bytes AS (SELECT doc_id, run, times, hex(encode(doc_id || ':' || run)) AS x FROM counted WHERE length(run) >= 6),
hashed AS (
  SELECT run, times,
         xor(4294967295, list_reduce([4294967295::BIGINT] || list_transform(range(0, length(x), 2),
                 lambda i: ('0x' || substr(x, CAST(i AS INTEGER) + 1, 2))::BIGINT),
             lambda c, b: xor(tab[(xor(c, b) & 255) + 1], c >> 8))) AS h
  FROM bytes, crc_table),
words AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, CAST(h % length(run) AS INTEGER))
                                    || substr(run, CAST(h % length(run) AS INTEGER) + 2) ELSE run END AS word,
         CAST(sum(times) AS BIGINT) AS n
  FROM hashed GROUP BY 1 HAVING sum(times) >= 5),
v AS (SELECT word, n FROM words WHERE length(word) >= 6),
cut AS (
  SELECT word, n, i, substr(word, 1, CAST(i AS INTEGER)) || substr(word, CAST(i AS INTEGER) + 2) AS rest
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM v)),
pairs AS (
  SELECT a.word AS x, b.word AS y FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT c.word, v.word FROM cut c JOIN v ON v.word = c.rest
  UNION SELECT v.word, c.word FROM cut c JOIN v ON v.word = c.rest),
best AS (
  SELECT x AS word, count(*) OVER (PARTITION BY x) AS n_near, y, v.n AS y_n
  FROM pairs JOIN v ON v.word = pairs.y
  QUALIFY row_number() OVER (PARTITION BY x ORDER BY v.n DESC, y) = 1),
formed AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN y_n >= 5 * n THEN y END AS form,
         CASE WHEN y_n >= 5 * n THEN y_n END AS form_n
  FROM v LEFT JOIN best USING (word)),
climb(word, root) AS (
  SELECT word, word FROM formed
  UNION ALL SELECT c.word, f.form FROM climb c JOIN formed f ON f.word = c.root WHERE f.form IS NOT NULL)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n
FROM formed f JOIN climb c USING (word) JOIN formed t ON t.word = c.root
WHERE t.form IS NULL
"""
