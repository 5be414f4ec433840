"""Mixing sources to target weights by systematic sampling.

A source's target is its weight's share of the wanted size, at most `cap` times its own
size; what is over goes to the other sources by weight until none is above (the level at
which min(cap, level * weight) adds up, found over the table of sources).

Within a source every document expects target / size copies. Those are prefix-summed
along the documents in the order of their size, one offset drawn from the source's name is added, and a document is
emitted once per integer boundary that its stretch crosses: at most ceil(cap) times. As
neighbours have like sizes, the taken size misses the target by less than about one
document.

No source is ever gathered in one task: ranks come from fine buckets (source, size, hash of id) and
the buckets' counts. Only the table of sources, one row each, meets in one window.

Defined cases: null source is a source of its own, after all others; null or empty text
has size 0 and is taken 0 words; a table without words has targets 0; repeated rows are
rows of their own; an empty table gives an empty result; extra columns are not read by
`mix`, and `mixed` returns them unchanged.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaar.llm.common import gapless, hash52, mark_of, materialize, take_rows, text_or_empty, unit_draw

WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def targets(sources: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5,
            cap: float = 2.0) -> DataFrame:
    """`sources` (source, source_size) with `target`."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.row_number().over(order) - 1) % len(weights) + 1)
    s = sources.withColumn("w", weight).withColumn("top", F.lit(float(cap)) * F.col("source_size"))
    by_room = Window.orderBy(F.col("top") / F.col("w"), F.col("source").asc_nulls_last())
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()

    def so_far(c: str) -> Column:
        return F.coalesce(F.sum(c).over(before), F.lit(0.0))

    s = s.withColumn("level", (F.lit(float(share)) * F.sum("source_size").over(everything) - so_far("top"))
                     / (F.sum("w").over(everything) - so_far("w")))
    s = s.withColumn("level", F.max(F.when(F.col("level") <= F.col("top") / F.col("w"), F.col("level")))
                     .over(everything))
    return s.select("source", "source_size", F.least(F.col("top"), F.col("level") * F.col("w")).alias("target"))


def _copies(docs: DataFrame, weights, share, cap, seed: str) -> DataFrame:
    """`docs` (source, size, key, and more) with source_size, target and copies. Stable input is needed."""
    per_source = docs.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    aims = materialize(targets(per_source, weights, share, cap), "op8-targets")
    ranked = gapless(docs.withColumn("bucket", hash52(F.lit(seed), F.col("key")) % 64), ["source"],
                     ["size", "bucket"], [F.col("key")], "rank",
                     coarse=F.floor(8 * F.log2(F.col("size") + F.lit(1.0))))
    # the table of sources is joined without a hint: Spark broadcasts it while it is small, and splits a hot
    # source of the rows where it is not
    aims = aims.select(F.col("source").alias("__llm_source"), "source_size", "target")
    both = ranked.join(aims, F.col("source").eqNullSafe(F.col("__llm_source"))).drop("__llm_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    offset = unit_draw(F.lit(seed), F.col("source"))
    crossed = (F.floor(rate * (F.col("rank") + 1).cast("double") + offset)
               - F.floor(rate * F.col("rank").cast("double") + offset))
    return both.withColumn("copies", F.when(F.col("size") > 0, crossed).otherwise(F.lit(0)).cast("long"))


def mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, cap: float = 2.0,
        seed: str = "mix", id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, size, source_size, target, taken (words the mix takes, repeats counted) and copies."""
    sized = materialize(docs.select(F.col(id_col).alias("key"), F.col(source_col).alias("source"),
                                    words(text_or_empty(text_col)).alias("size")), "op8-sized")
    out = _copies(sized, weights, share, cap, seed)
    return out.select(F.col("key").alias("doc_id"), "size", "source_size", "target",
                      (F.col("copies") * F.col("size")).alias("taken"), "copies")


def mixed(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, cap: float = 2.0,
          seed: str = "mix", id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: every row of `docs`, with all its columns, as often as it is emitted.

    Rows are told apart by (id, source, hash of the text); rows equal in all three are numbered together and
    each gets its copies.
    """
    sized = materialize(docs.select(*mark_of(id_col, text_col), F.col(source_col).alias("source"),
                                    words(text_or_empty(text_col)).alias("size")), "op8-sized")
    key = F.concat_ws("|", F.col("__llm_id").cast("string"), F.col("__llm_th").cast("string"))
    plan = _copies(sized.withColumn("key", key), weights, share, cap, seed)
    marks = (plan.groupBy("__llm_id", "__llm_th", F.col("source").alias("__llm_0"))
             .agg(F.sum("copies").alias("__llm_copies"), F.count(F.lit(1)).alias("__llm_rows"))
             .filter("__llm_copies > 0"))
    return take_rows(docs, materialize(marks, "op8-copies"), id_col, text_col, source_col)


SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
s1 AS (
  SELECT *, 2.0::DOUBLE * source_size AS room,
         [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w
  FROM s0),
s2 AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(room) OVER b, 0))
            / (sum(w) OVER () - coalesce(sum(w) OVER b, 0)) AS level
  FROM s1 WINDOW b AS (ORDER BY room / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s3 AS (
  SELECT source, source_size,
         least(room, w * (SELECT max(level) FROM s2 x WHERE x.level <= x.room / x.w)) AS target
  FROM s2),
r AS (
  SELECT d.*, source_size, target,
         CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
         row_number() OVER (PARTITION BY d.source ORDER BY size,
             (('0x' || substr(md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13))::BIGINT) % 64,
             doc_id) - 1 AS k,
         ((('0x' || substr(md5('mix|' || coalesce(d.source, 'null')), 1, 13))::BIGINT) + 0.5::DOUBLE)
             / 4503599627370496.0::DOUBLE AS u
  FROM d JOIN s3 ON d.source IS NOT DISTINCT FROM s3.source),
c AS (
  SELECT *, CASE WHEN size > 0 THEN CAST(floor(rate * (k + 1)::DOUBLE + u) - floor(rate * k::DOUBLE + u) AS BIGINT)
                 ELSE 0 END AS copies
  FROM r)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, copies * size AS taken, copies FROM c
"""
