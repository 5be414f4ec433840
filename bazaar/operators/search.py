"""Explorer operators: free-text search over rows, by a scan or by a kept index, and keyed selection sets."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bazaar.session import materialize
from bazaar.sources import folders as fs
from bazaar.sources.sinks import write_table


def search_pattern(term: str) -> str:
    """Case-insensitive match of `term` at a word start: the text start or after a
    character that is neither a letter nor a hyphen."""
    return r"(?iu)(?:^|[^\p{L}-])" + re.escape(term)


def _text(df: DataFrame, columns: Sequence[str]) -> Column:
    kinds = dict(df.dtypes)
    shown = [F.col(c).try_cast("decimal(38,9)") if kinds[c] in ("double", "float") else F.col(c) for c in columns]
    return F.concat_ws("\n", *[F.coalesce(c.cast("string"), F.lit("")) for c in shown])


def search_filter(df: DataFrame, query: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Keep rows where every whitespace-separated term starts a word in some column.

    The columns are joined into one text per row and each term becomes an `rlike`
    (regex-escaped), so the filter is a single codegen'd predicate. Doubles are searched by their
    plain decimal text with 9 places.
    """
    terms = [t for t in query.split() if t]
    if not terms:
        return df
    text = _text(df, list(columns or df.columns))
    cond = None
    for t in terms:
        c = text.rlike(search_pattern(t))
        cond = c if cond is None else (cond & c)
    return df.where(cond)


# --- word-start index -----------------------------------------------------------------

#: Code points of a word start that the index holds.
START = 3
#: Buckets of the indexed rows: a constant of the stored table.
ROW_BUCKETS = 64
# The characters outside ASCII that match an ASCII letter when case is ignored (long s, dotless
# and dotted i, the Kelvin sign), and those letters.
_LIKE_ASCII, _ASCII = "\u017f\u0131\u0130\u212a", "siik"


def folded(c: Column) -> Column:
    """Texts that match when case is ignored have equal folds: A-Z lower-cased, all other letters as one."""
    ascii_letters = F.regexp_replace(F.translate(c, _LIKE_ASCII, _ASCII), r"[^\x00-\x7F]", "\ufffd")
    return F.lower(ascii_letters)


def word_starts(text: Column) -> Column:
    """The distinct folded starts of at most START code points, up to the next blank, at every place where
    `search_pattern` lets a term begin."""
    at = r"(?<![\p{L}-])(?=(\S{1,%d}))" % START
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(at), F.lit(1)), folded))


def build_search_index(df: DataFrame, path: str, key: str = "item_name", columns: Sequence[str] | None = None) -> None:
    """Index the rows of `df` by the word starts of their columns, in place of an earlier index at `path`.

    `postings` (start, hash of the key) are sorted by start, so that a probe skips row groups, and a frequent start is
    spread over files. `rows` are the rows themselves, in buckets of the hash. A NULL key is a key like others.
    Both are laid out in ranges, which takes two looks at each: `df` is worked out once, its rows and their starts are
    written ahead of that.
    """
    rows = materialize(df.withColumn("_hash", F.xxhash64(key)), "search-rows", "zstd")
    starts = rows.select("_hash", F.explode(word_starts(_text(df, list(columns or df.columns)))).alias("start")).distinct()
    starts = materialize(starts, "search-starts", "zstd")
    rows = rows.withColumn("_bucket", F.pmod("_hash", F.lit(ROW_BUCKETS)).cast("int"))

    def write(out: str) -> None:
        write_table(starts, f"{out}/postings", cluster_by=["start", "_hash"], dynamic=False)
        write_table(rows, f"{out}/rows", ["_bucket"], ["_hash"], dynamic=False)
        write_table(rows.limit(0), f"{out}/schema", dynamic=False)  # partitions without a row have no file to tell it
    fs.swap_table(df.sparkSession, path, write)


def search_candidates(spark: SparkSession, path: str, terms: Sequence[str]) -> DataFrame:
    """Keys (`_hash`, `_bucket`) that hold a start of every term: one read of the postings of those starts."""
    probes = spark.range(1).select(*[F.substring(folded(F.lit(t)), 1, START) for t in terms]).first()
    met = [F.col("start") == p if len(p) == START else F.col("start").startswith(p) for p in dict.fromkeys(probes)]
    some = met[0]
    for c in met[1:]:
        some = some | c
    postings = spark.read.schema("_hash bigint, start string").parquet(f"{path}/postings")
    per_key = postings.where(some).groupBy("_hash").agg(*[F.max(c).alias(f"_m{i}") for i, c in enumerate(met)])
    for i in range(len(met)):
        per_key = per_key.where(F.col(f"_m{i}"))
    return per_key.select("_hash", F.pmod("_hash", F.lit(ROW_BUCKETS)).cast("int").alias("_bucket"))


def search_indexed(spark: SparkSession, path: str, query: str, columns: Sequence[str] | None = None) -> DataFrame:
    """`search_filter` over the indexed rows, with the columns that the index was built on (or fewer).

    The postings name candidates, whose rows alone meet the regular expressions; buckets without a candidate are
    not read where the candidates are few enough to be broadcast (decided by their size at run time).
    """
    rows = spark.read.schema(spark.read.parquet(f"{path}/schema").schema).parquet(f"{path}/rows")
    shown = [c for c in rows.columns if c not in ("_hash", "_bucket")]
    terms = [t for t in query.split() if t]
    if not terms:
        return rows.select(*shown)
    found = rows.join(search_candidates(spark, path, terms), ["_hash", "_bucket"], "left_semi")
    return search_filter(found.select(*shown), query, columns)


# --- selections -----------------------------------------------------------------------

def current_selection(changes: DataFrame, key: str = "item_name", seq: str = "seq",
                      action: str = "action") -> DataFrame:
    """Selected keys from a log of (key, seq, action in {'add','remove'}): last change wins.

    A top-1 per key (partial WindowGroupLimit before the shuffle), then removals dropped.
    """
    w = Window.partitionBy(key).orderBy(F.col(seq).desc())
    last = changes.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") == 1).drop("__rn")
    return last.where(F.col(action) == "add").select(key)


def apply_selection(df: DataFrame, selection: DataFrame, key: str = "item_name") -> DataFrame:
    """Rows whose key is selected (semi-join: no duplication, right side only probed)."""
    return df.join(selection.select(key), key, "left_semi")
