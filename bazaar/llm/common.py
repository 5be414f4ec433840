"""Helpers shared by the corpus operators.

Columns that an operator adds only for itself start with ``__llm_``, so extra
columns of the caller's table never clash with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bazaar.session import materialize, scratch_path

__all__ = ["SPACE", "UPPER", "LOWER", "ascii_lower", "bounded_batches", "drop_rows", "gapless", "hash52", "hash_sample",
           "level_quotas", "mark_of", "materialize", "may_be_marked", "scratch_path", "table", "take_rows",
           "text_or_empty", "unit_draw"]

#: Bits of one row of a filter, and the most that a filter has (32 MB).
BITMAP = 1 << 15
FILTER_BITS = 1 << 28

#: The white space of the contracts: space and the five ASCII control characters 9-13.
SPACE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col: str = "text") -> Column:
    """The text as a string, null as the empty string."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only. `lower` also maps other alphabets, so it serves pure ASCII alone."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def hash52(*parts: Column) -> Column:
    """The first 52 bits of an MD5 over the parts joined by '|' (null: the word null), as a long.

    MD5 rather than xxhash64, so that other engines can reproduce the draw.
    """
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")


def unit_draw(*parts: Column) -> Column:
    """A number strictly between 0 and 1 that only the parts decide."""
    return (hash52(*parts).cast("double") + F.lit(0.5)) / F.lit(float(2 ** 52))


def gapless(df: DataFrame, group: list[str], bucket: list[str], order: list[Column], out: str,
            coarse: Column) -> DataFrame:
    """Add `out`: positions 0, 1, 2, ... within each group, ordered by bucket and then `order`.

    No task ever holds a whole group, nor all of its buckets: rows are numbered within
    (group, bucket); the counts of the buckets before are summed up within stretches of buckets, and
    those of the stretches before within the group. `coarse` names a bucket's stretch, a few hundred at most in a group,
    and rises with the buckets. `df` is read twice, so it must be stable (a
    written table), and `bucket` must be fine enough for one task each.
    """
    keys = [*group, *bucket]
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__llm_n")).withColumn("__llm_c", coarse)

    def summed_before(w) -> Column:
        return F.coalesce(F.sum("__llm_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    stretches = counts.groupBy(*group, "__llm_c").agg(F.sum("__llm_n").alias("__llm_n"))
    stretches = stretches.select(*[F.col(g).alias(f"__llm_g{i}") for i, g in enumerate(group)],
                                 F.col("__llm_c").alias("__llm_d"),
                                 summed_before(Window.partitionBy(*group).orderBy("__llm_c")).alias("__llm_base"))
    fine = counts.withColumn("__llm_fine", summed_before(Window.partitionBy(*group, "__llm_c").orderBy(*bucket)))
    there = F.col("__llm_c") == F.col("__llm_d")
    for i, g in enumerate(group):
        there = there & F.col(g).eqNullSafe(F.col(f"__llm_g{i}"))
    starts = fine.join(stretches, there).select(*[F.col(k).alias(f"__llm_k{i}") for i, k in enumerate(keys)],
                                                (F.col("__llm_base") + F.col("__llm_fine")).alias("__llm_start"))
    within = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("long") - 1
    numbered = df.withColumn("__llm_within", within)
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__llm_k{i}"))
    return (numbered.join(starts, same).withColumn(out, F.col("__llm_start") + F.col("__llm_within"))
            .drop("__llm_start", "__llm_within", *[f"__llm_k{i}" for i in range(len(keys))]))


def mark_of(id_col: str, text_col: str) -> list[Column]:
    """What tells rows apart where a plan made without the texts meets the rows again: id and a hash of the text."""
    return [F.col(id_col).alias("__llm_id"), F.xxhash64(text_or_empty(text_col)).alias("__llm_th")]


def take_rows(docs: DataFrame, marks: DataFrame, id_col: str, text_col: str, *more: str) -> DataFrame:
    """The rows of `docs`, all columns, as often as `marks` says.

    `marks` is a written table (__llm_id, __llm_th, [the columns `more` as __llm_0, ...,] __llm_copies, __llm_rows):
    the copies that the __llm_rows rows of a mark have in all. Equal rows share them; the first ones get one more.
    """
    same = F.col(id_col).eqNullSafe(F.col("__llm_id")) & (F.xxhash64(text_or_empty(text_col)) == F.col("__llm_th"))
    keys = ["__llm_id", "__llm_th"]
    for i, c in enumerate(more):
        same = same & F.col(c).eqNullSafe(F.col(f"__llm_{i}"))
        keys.append(f"__llm_{i}")
    alone = docs.join(marks.filter("__llm_rows = 1"), same).withColumn("__llm_times", F.col("__llm_copies"))
    again = docs.join(marks.filter("__llm_rows > 1"), same)
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])))
    each = F.floor(F.col("__llm_copies") / F.col("__llm_rows"))
    again = again.withColumn("__llm_times", each + F.when(
        nth <= F.col("__llm_copies") - each * F.col("__llm_rows"), 1).otherwise(0))
    both = alone.unionByName(again).filter("__llm_times > 0")
    return (both.withColumn("__llm_copy", F.explode(F.sequence(F.lit(1), F.col("__llm_times").cast("int"))))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))


def may_be_marked(docs: DataFrame, marks: DataFrame, id_col: str, text_col: str, out: str,
                  most_bits: int = FILTER_BITS) -> DataFrame:
    """`docs` with the boolean `out`: false only for rows whose mark is surely not among `marks` (__llm_id, __llm_th).

    A bit per hash, 16 to 32 bits a mark and at most `most_bits`, in rows of `BITMAP` bits that are broadcast. Rows that
    are not marked can so pass by a join, and their texts need not move. A fuller filter lets more rows through, no other.
    """
    n = marks.count()
    bits = min(max(BITMAP, 1 << (16 * n).bit_length()), most_bits)

    def cell(*parts: Column) -> Column:
        return F.pmod(F.xxhash64(*parts), F.lit(bits))

    at = cell(F.col("__llm_id"), F.col("__llm_th"))
    rows = marks.groupBy(F.floor(at / BITMAP).alias("__llm_bucket")).agg(
        F.bitmap_construct_agg(at % BITMAP).alias("__llm_bits"))
    own = docs.withColumn("__llm_cell", cell(F.col(id_col), F.xxhash64(text_or_empty(text_col))))
    found = own.join(F.broadcast(rows), F.floor(F.col("__llm_cell") / BITMAP) == F.col("__llm_bucket"), "left")
    spot = F.col("__llm_cell") % BITMAP
    byte = F.conv(F.hex(F.substring("__llm_bits", F.floor(spot / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.call_function("shiftright", byte, (spot % 8).cast("int")).bitwiseAND(F.lit(1)) == 1
    return found.withColumn(out, F.coalesce(hit, F.lit(False))).drop("__llm_cell", "__llm_bucket", "__llm_bits")


def drop_rows(docs: DataFrame, marks: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of `docs` without those that `marks` takes away; the texts of rows without a mark do not move.

    `marks` is a written table (__llm_id, __llm_th, __llm_copies, __llm_rows) of the marks that lose rows: of the
    __llm_rows rows of a mark __llm_copies stay.
    """
    flagged = may_be_marked(docs, marks, id_col, text_col, "__llm_maybe")
    stay = flagged.filter(~F.col("__llm_maybe")).drop("__llm_maybe")
    met = flagged.filter("__llm_maybe").join(
        marks, F.col(id_col).eqNullSafe(F.col("__llm_id")) & (F.xxhash64(text_or_empty(text_col)) == F.col("__llm_th")), "left")
    nth = F.row_number().over(Window.partitionBy("__llm_id", "__llm_th").orderBy(
        F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])))
    some = met.filter("__llm_copies > 0").withColumn("__llm_nth", nth).filter(F.col("__llm_nth") <= F.col("__llm_copies"))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return (stay.select(*columns).unionByName(met.filter("__llm_th is null").select(*columns))
            .unionByName(some.select(*columns)))


def level_quotas(counts: dict, total: int, most: int | None = None) -> dict:
    """How many of each group's rows to draw: alike for all, at most what a group has (and `most`), `total` in all."""
    out, left = {}, total
    for i, (g, n) in enumerate(sorted(counts.items(), key=lambda x: (x[1], str(x[0])))):
        out[g] = min(n, left // (len(counts) - i), n if most is None else most)
        left -= out[g]
    return out


def hash_sample(rows: DataFrame, group: str, draw: str, counts: dict, quotas: dict) -> DataFrame:
    """The rows whose 64-bit hash `draw` falls into their group's share, about `quotas` rows of each.

    A filter, without a window or a shuffle: no group is gathered. There are as many groups as the caller has
    brought to the driver, a bounded number, so their shares are broadcast.
    """
    shares = rows.sparkSession.createDataFrame([(g, quotas[g] / n) for g, n in counts.items() if quotas[g]],
                                               f"__llm_g {rows.schema[group].dataType.simpleString()}, __llm_s double")
    at = F.shiftrightunsigned(draw, 11).cast("double") / F.lit(float(2 ** 53))
    return (rows.join(F.broadcast(shares), F.col(group) == F.col("__llm_g"))
            .filter(at < F.col("__llm_s")).drop("__llm_g", "__llm_s"))


def bounded_batches(spark: SparkSession, rows: int = 500) -> None:
    """Let no Arrow batch hold more rows than this, as texts may be very long.

    A smaller setting of the session stays.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))
