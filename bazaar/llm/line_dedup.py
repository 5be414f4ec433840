"""Line dedup over range-partitioned hashes, with keep bitmaps instead of text.

Lines of at least `min_len` code points (stripped, A-Z lower-cased) become rows (128-bit
hash, document, position); their text is left behind. Hashes of fewer than `min_docs`
rows go first, after a count that is combined before it is shuffled. The rest is
range-partitioned by (hash, slice of the document's hash), so a hot line is spread over
`SLICES` ranges, and sorted within by document, largest first, and position. Streaming
along that order, the first row of each run is its first occurrence; the runs of a
hash (at most `SLICES`) give its number of documents and the largest of them.

Every other document loses the line. What leaves the shuffle is, per document, the compressed bitmap
of dropped positions: words of 32 positions, only those that are not zero. Documents without a bitmap pass by
the join, told by a filter sized by the bitmaps; the texts of the others move once, to meet theirs.

DataFrame functions only.

Defined cases: null and empty texts are one empty line; a null id is one document,
smaller than all others; rows that share an id count as one document, and each keeps its
own positions; an empty table gives an empty result; extra columns are not read by
`line_dedup`, and `deduped` returns them unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaar.llm.common import SPACE, ascii_lower, materialize, may_be_marked, text_or_empty

SLICES = 64
WORD = 32


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(SPACE)))


def split_lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _long_lines(docs: DataFrame, id_col: str, text_col: str, min_len: int) -> DataFrame:
    """(h1, h2, doc, th, pos) of the lines that are long enough; th tells rows of one id apart."""
    text = text_or_empty(text_col)
    rows = docs.select(F.col(id_col).alias("doc"), F.xxhash64(text).alias("th"),
                       F.posexplode(split_lines(text)).alias("pos", "line"))
    rows = rows.filter(F.char_length("line") >= min_len).withColumn("key", line_key(F.col("line")))
    rows = rows.filter(F.char_length("key") >= min_len)
    return rows.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), F.col("key")).alias("h2"),
                       "doc", "th", "pos")


def keep_bitmaps(docs: DataFrame, min_len: int = 40, min_docs: int = 5, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(doc, th, dropped): the dropped lines of each document that loses any, as a map from the number
    of a word to its 32 bits; words without a dropped line are absent."""
    lines = materialize(_long_lines(docs, id_col, text_col, min_len), "op4-lines")
    often = (lines.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_docs)
             .select("h1", "h2"))
    hits = materialize(lines.join(materialize(often, "op4-often"), ["h1", "h2"], "left_semi"), "op4-hits")
    sliced = hits.withColumn("slice", F.pmod(F.xxhash64("doc"), F.lit(SLICES)))
    ranged = sliced.repartitionByRange("h1", "h2", "slice")
    run = Window.partitionBy("h1", "h2", "slice").orderBy(F.col("doc").desc_nulls_last(), F.col("th"), F.col("pos"))
    # equal neighbours are rows of one document: a new document begins where the id changes
    starts = (ranged.withColumn("first", F.row_number().over(run) == 1)
              .withColumn("new", F.col("first") | ~F.col("doc").eqNullSafe(F.lag("doc").over(run))))
    runs = starts.groupBy("h1", "h2", "slice").agg(F.sum(F.col("new").cast("long")).alias("docs"),
                                                   F.max(F.when(F.col("first"), F.col("doc"))).alias("first_doc"))
    common = (runs.groupBy("h1", "h2").agg(F.sum("docs").alias("docs"), F.max("first_doc").alias("keeper"))
              .filter(F.col("docs") >= min_docs).select("h1", "h2", "keeper"))
    lost = (hits.join(materialize(common, "op4-common"), ["h1", "h2"])
            .filter(F.col("doc").isNull() | (F.col("doc") < F.col("keeper"))))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("pos") % WORD).cast("int"))
    words = lost.groupBy("doc", "th", F.floor(F.col("pos") / WORD).cast("int").alias("word")).agg(
        F.bit_or(bit).alias("bits"))
    return words.groupBy("doc", "th").agg(
        F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("dropped"))


def _with_kept(docs: DataFrame, id_col: str, text_col: str, min_len: int, min_docs: int) -> DataFrame:
    """`docs` with __llm_lines (number), __llm_kept (lines that stay, null: all of them)."""
    bitmaps = materialize(keep_bitmaps(docs, min_len, min_docs, id_col, text_col), "op4-bitmaps").select(
        F.col("doc").alias("__llm_id"), F.col("th").alias("__llm_th"), F.col("dropped").alias("__llm_dropped"))
    text = text_or_empty(text_col)
    flagged = may_be_marked(docs, bitmaps, id_col, text_col, "__llm_maybe")
    whole = flagged.filter(~F.col("__llm_maybe")).withColumn(
        "__llm_dropped", F.lit(None).cast(bitmaps.schema["__llm_dropped"].dataType))
    # the same join at every size: bitmaps grow with the documents
    met = flagged.filter("__llm_maybe").join(bitmaps.hint("merge"), F.col(id_col).eqNullSafe(F.col("__llm_id"))
                                             & (F.xxhash64(text) == F.col("__llm_th")), "left")
    joined = whole.unionByName(met.drop("__llm_id", "__llm_th"))

    def stays(_: Column, i: Column) -> Column:
        bits = F.coalesce(F.element_at("__llm_dropped", F.floor(i / WORD).cast("int")), F.lit(0).cast("long"))
        return F.call_function("shiftright", bits, i % WORD).bitwiseAND(F.lit(1)) == 0

    return (joined
            .withColumn("__llm_lines", F.size(split_lines(text)).cast("long"))
            .withColumn("__llm_kept", F.when(F.col("__llm_dropped").isNotNull(), F.filter(split_lines(text), stays)))
            .drop("__llm_dropped", "__llm_maybe"))


def line_dedup(docs: DataFrame, min_len: int = 40, min_docs: int = 5, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """doc_id, n_lines (before dropping), n_dropped, kept_sha256 for every row."""
    out = _with_kept(docs.select(id_col, text_col), id_col, text_col, min_len, min_docs)
    kept = F.when(F.col("__llm_kept").isNull(), text_or_empty(text_col)).otherwise(
        F.array_join("__llm_kept", "\n"))
    lost = F.when(F.col("__llm_kept").isNull(), F.lit(0)).otherwise(F.col("__llm_lines") - F.size("__llm_kept"))
    return out.select(F.col(id_col).alias("doc_id"), F.col("__llm_lines").alias("n_lines"),
                      lost.cast("long").alias("n_dropped"),
                      F.sha2(kept.cast("binary"), 256).alias("kept_sha256"))


def deduped(docs: DataFrame, min_len: int = 40, min_docs: int = 5, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """`docs`, all columns, with the dropped lines cut out of the text."""
    out = _with_kept(docs, id_col, text_col, min_len, min_docs)
    text = F.when(F.col("__llm_kept").isNull(), F.col(text_col)).otherwise(F.array_join("__llm_kept", "\n"))
    return out.withColumn(text_col, text).select(*[F.col(f"`{c}`") for c in docs.columns])


SQL = r"""
WITH lines AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
pos AS (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM lines),
keyed AS (
  SELECT doc_id, i, ls[i] AS line,
         translate(trim(ls[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM pos),
common AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT doc_id, i, line, coalesce(doc_id < keeper, false) AS lost FROM keyed LEFT JOIN common USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT lost), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
