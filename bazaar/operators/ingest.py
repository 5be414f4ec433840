"""Record-level ingest: listing pages -> typed raw rows; listing pages -> price series.

All of it is column expressions: the regex, the JSON parse, the reverse
take-while over the embedded series and the per-item validation run as
higher-order functions inside one projection per page, then `inline` emits the
points. No Python per row, no collect; one page is one row.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaar import schemas
from bazaar.functions.scalar import col_of
from bazaar.session import materialize_at

# The series is the JavaScript variable `line1` embedded in the page;
# each point is [date text, price, volume text] and the first 11 characters of the
# date text are the day, written like "Nov 05 2024".
SERIES_PATTERN = r"var line1=([^;]+);"
DAY_CHARS = 11
DAY_FORMAT = "MMM d yyyy"
HOUR_CHARS = 14
HOUR_FORMAT = "MMM d yyyy HH"
DEFAULT_MARK = _dt.datetime(1970, 1, 1)

# Fields dropped from every listing record before load.
REDUNDANT_TOP = ("name", "hash_name", "app_icon", "app_name")
REDUNDANT_ASSET = ("name", "market_name", "appid", "icon_url")

# Fetch outcome per HTTP status; only 200 can yield rows, 404 is a warning.
OUTCOME_OK = "ok"
OUTCOMES = {429: "rate_limited", 403: "forbidden", 404: "not_found"}
OUTCOME_OTHER = "failed"


# --- listing records ----------------------------------------------------------------

def explode_results(pages: DataFrame, results: str = "results") -> DataFrame:
    """API result pages -> one row per listing record (the `results` array)."""
    return explode_once(pages.select(F.col(results).alias("__rs")), "__rs", "__r").select("__r.*")


def explode_once(df: DataFrame, array: str, item: str, pos: str = "__at") -> DataFrame:
    """`posexplode` of a column, whose expression is worked out once per row.

    Ahead of a plain explode Spark asks whether the array has elements, and works a parsed array out again for each of
    those questions; the outer form is not asked, and its row for a missing or empty array, which alone has no
    position, is dropped.
    """
    rest = [F.col(f"`{c}`") for c in df.columns if c != array]
    return df.select(*rest, F.posexplode_outer(array).alias(pos, item)).where(F.col(pos).isNotNull())


def parse_results_pages(pages_text: DataFrame, body: str = "body", place: tuple[str, str] | None = None) -> DataFrame:
    """JSON text of result pages -> records, with the declared page schema.

    `place` names two more columns that tell records apart: the page (its `page_no`, else a hash of its
    text) and the record's position in it.
    """
    page = F.col("page_no").cast("string") if "page_no" in pages_text.columns else F.sha2(F.col(body), 256)
    parsed = pages_text.select(page.alias("__page"), F.from_json(F.col(body), schemas.RESULTS_PAGE).alias("__p"))
    if place is None:
        return explode_results(parsed.select("__p.*"))
    placed = explode_once(parsed.select("__page", F.col("__p.results").alias("__rs")), "__rs", "__r", "__pos")
    return placed.select(F.col("__page").alias(place[0]), F.col("__pos").alias(place[1]), "__r.*")


def first_pages(pages_text: DataFrame, limit: int) -> DataFrame:
    """The listing pages numbered 1 to `limit`, chosen before any page is parsed."""
    return pages_text.where(F.col("page_no") <= int(limit))


def stamp_snapshot(df: DataFrame, run_ts: _dt.datetime, name: str = "snapshot_timestamp") -> DataFrame:
    """One batch-wide timestamp, evaluated once on the driver (not per row or per task)."""
    return df.withColumn(name, F.lit(run_ts).cast(T.TimestampType()))


def prune_redundant(df: DataFrame, top: Sequence[str] = REDUNDANT_TOP, asset: Sequence[str] = REDUNDANT_ASSET,
                    struct: str = "asset_description") -> DataFrame:
    """Drop duplicated / constant fields; absent fields are ignored."""
    out = df.drop(*[c for c in top if c in df.columns])
    if struct in out.columns:
        st = out.schema[struct].dataType
        if isinstance(st, T.StructType):
            present = [f for f in asset if f in st.fieldNames()]
            if present and len(present) < len(st.fields):
                out = out.withColumn(struct, F.col(struct).dropFields(*present))
            elif present:  # dropping every field: an empty object stays an empty object
                out = out.withColumn(struct, F.when(F.col(struct).isNull(), F.lit(None))
                                     .otherwise(F.struct()))
    return out


def flatten_struct(df: DataFrame, sep: str = "__") -> DataFrame:
    """Nested structs -> `parent__child` columns (recursively); a NULL struct gives NULL leaves."""
    def leaves(dt: T.DataType, path: list[str]):
        if isinstance(dt, T.StructType) and len(dt.fields) > 0:
            for f in dt.fields:
                yield from leaves(f.dataType, path + [f.name])
        else:
            yield path

    cols = []
    for f in df.schema.fields:
        for p in leaves(f.dataType, [f.name]):
            ref = F.col(".".join(f"`{x}`" for x in p))
            cols.append(ref.alias(sep.join(p)))
    return df.select(*cols)


def add_load_metadata(df: DataFrame, load_id: str, key_cols: Sequence[str]) -> DataFrame:
    """`_dlt_load_id` per batch, `_dlt_id` per row (deterministic hash of the row key + load)."""
    parts = [F.lit(load_id)] + [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key_cols]
    return (df.withColumn("_dlt_load_id", F.lit(load_id))
              .withColumn("_dlt_id", F.sha2(F.concat_ws("\u0001", *parts), 256)))


def guard_missing_key(df: DataFrame, key: str = "market_hash_name") -> DataFrame:
    """Rows without a (non-empty) key yield nothing."""
    return df.where(F.coalesce(F.col(key), F.lit("")) != "")


# --- listing pages: fetch outcome and series extraction -------------------------------

def page_outcome(status="status") -> Column:
    s = col_of(status)
    out = F.when(s == 200, F.lit(OUTCOME_OK))
    for code, label in OUTCOMES.items():
        out = out.when(s == code, F.lit(label))
    return out.otherwise(F.lit(OUTCOME_OTHER))


def outcome_severity(status="status") -> Column:
    s = col_of(status)
    return F.when(s == 200, F.lit("info")).when(s == 404, F.lit("warning")).otherwise(F.lit("error"))


def extract_series_text(body="body") -> Column:
    """First match of the series variable; NULL when absent."""
    return F.nullif(F.regexp_extract(col_of(body), SERIES_PATTERN, 1), F.lit(""))


def parse_series_json(text) -> Column:
    """JSON text -> array<array<string>> (numbers come back as text); bad JSON -> NULL."""
    return F.from_json(col_of(text), T.ArrayType(T.ArrayType(T.StringType())))


def parse_point_date(text, grain: str = "day") -> Column:
    """Day (or hour) of a point's date text; NULL when it does not parse."""
    n, fmt = (DAY_CHARS, DAY_FORMAT) if grain == "day" else (HOUR_CHARS, HOUR_FORMAT)
    return F.try_to_timestamp(F.substring(col_of(text), 1, n), F.lit(fmt))


def parse_point_price(text) -> Column:
    return col_of(text).try_cast(schemas.MONEY)


def parse_point_volume(text) -> Column:
    return col_of(text).try_cast(T.LongType())


def _typed_point(p: Column, grain: str) -> Column:
    return F.struct(parse_point_date(F.get(p, 0), grain).alias("date"),
                    parse_point_price(F.get(p, 1)).alias("price"),
                    parse_point_volume(F.get(p, 2)).alias("volume"))


def _point_ok(t: Column) -> Column:
    return t["date"].isNotNull() & t["price"].isNotNull() & t["volume"].isNotNull()


def typed_points(points: Column, grain: str = "day", newest_first: bool = True) -> Column:
    """array<array<string>> -> array<struct<date, price, volume>> (NULL where unparseable)."""
    src = F.reverse(points) if newest_first else points
    return F.transform(src, lambda p: _typed_point(p, grain))


def stop_position(typed_newest_first: Column, mark: Column) -> Column:
    """1-based position of the first point at or before the mark; 0 when none."""
    return F.array_position(F.transform(typed_newest_first, lambda t: t["date"] <= mark), F.lit(True))


def take_before(typed_newest_first: Column, stop: Column) -> Column:
    return F.when(stop == 0, typed_newest_first).otherwise(
        F.slice(typed_newest_first, F.lit(1), (stop - 1).cast("int")))


def all_points_ok(taken: Column) -> Column:
    return F.forall(taken, _point_ok)


@dataclass
class Extracted:
    records: DataFrame      # typed price records (market_hash_name, date, price, volume)
    errors: DataFrame       # one row per failed page: market_hash_name, reason
    outcomes: DataFrame     # per page: market_hash_name, status, outcome, severity, has_series
    pages: DataFrame        # per page: key, status, has_series, mark, taken points, ok flag (a written table)
    pages_path: str         # its folder, which may be deleted once all of these have been read


def extract_price_history(pages: DataFrame, state: DataFrame | None = None, grain: str = "day",
                          mode: str = "take_while", isolate: str = "key",
                          key: str = "market_hash_name") -> Extracted:
    """Listing pages (key, status, body) -> price records, error rows and outcomes.

    * only status 200 pages with a series yield rows; no match yields nothing and no error;
    * per-key mark from `state` (key, last_seen) — default 1970-01-01 — keeps points
      strictly newer than the mark (`mode="take_while"`: stop at the first old point
      from the newest end; `mode="filter"`: plain filter);
    * a page whose JSON does not parse, or with any reached point whose date, price
      or volume does not parse, yields no rows and one error row; with
      `isolate="key"` every page of that key is dropped in this batch, so its state is
      not advanced; other keys are unaffected.

    The archive is read and parsed once: the judged pages are written to the shared
    folder, and outcomes, errors and records are read from there. Keys with a failed page are taken out by an
    anti-join on the distinct failed keys, so no key's pages ever meet in one task.
    """
    p = guard_missing_key(pages, key)
    text = F.when(F.col("status") == 200, extract_series_text("body"))
    p = p.select(F.col(key), F.col("status"), text.alias("__txt"))
    p = p.select(key, "status", F.col("__txt").isNotNull().alias("has_series"), parse_series_json("__txt").alias("__pts"))
    if state is not None:
        st = state.select(F.col(key), F.col("last_seen").cast(T.TimestampType()).alias("__mark"))
        p = p.join(st, key, "left")
    else:
        p = p.withColumn("__mark", F.lit(None).cast(T.TimestampType()))
    mark = F.coalesce(F.col("__mark"), F.lit(DEFAULT_MARK).cast(T.TimestampType()))
    # Stacked projections: each expensive array is computed once and referenced by name
    # afterwards (Catalyst keeps projections apart when collapsing them would evaluate
    # a non-cheap expression twice).
    own = [key, "status", "has_series"]
    base = p.select(*own, mark.alias("mark"), (F.col("has_series") & F.col("__pts").isNull()).alias("bad_json"),
                    typed_points(F.col("__pts"), grain, newest_first=(mode == "take_while")).alias("typed"))
    if mode == "take_while":
        base = base.withColumn("stop", stop_position(F.col("typed"), F.col("mark")))
        typed = base.select(*own, "mark", "bad_json", take_before(F.col("typed"), F.col("stop")).alias("points"))
    else:
        typed = base.select(*own, "mark", "bad_json", F.filter(
            "typed", lambda t: t["date"].isNull() | (t["date"] > F.col("mark"))).alias("points"))
    fine = ~F.col("has_series") | (~F.col("bad_json") & F.coalesce(all_points_ok(F.col("points")), F.lit(False)))
    judged, path = materialize_at(typed.select(*own, "mark", "bad_json", "points", fine.alias("ok")), "judged-pages", "zstd")
    outcomes = judged.select(key, "status", page_outcome("status").alias("outcome"),
                             outcome_severity("status").alias("severity"), "has_series")
    failed = judged.where(~F.col("ok"))
    errors = failed.select(F.col(key), F.when(F.col("bad_json"), F.lit("bad_json")).otherwise(F.lit("bad_point"))
                           .alias("reason"))
    good = judged.where(F.col("ok") & F.col("has_series"))
    if isolate == "key":
        good = good.join(failed.select(key).distinct(), key, "left_anti")
    records = good.select(F.col(key), F.inline("points")).select(
        F.col(key).alias("market_hash_name"), F.col("date"), F.col("price"), F.col("volume"))
    return Extracted(records=records, errors=errors, outcomes=outcomes, pages=judged, pages_path=path)


def advance_state(state: DataFrame | None, records: DataFrame, key: str = "market_hash_name",
                  as_type: T.DataType = T.DateType()) -> DataFrame:
    """New per-key mark = max(date) of emitted records, merged with the old state.

    Only keys that emitted move; the merge is a union + group-by max (partial
    aggregation before the shuffle), so it never holds a key's rows in one task.
    """
    new = records.groupBy(F.col(key)).agg(F.max("date").cast(as_type).alias("last_seen"))
    if state is None:
        return new
    old = state.select(F.col(key), F.col("last_seen").cast(as_type).alias("last_seen"))
    return old.unionByName(new).groupBy(key).agg(F.max("last_seen").alias("last_seen"))


def outcome_counts(outcomes: DataFrame) -> DataFrame:
    return outcomes.groupBy("outcome", "severity").agg(F.count(F.lit(1)).alias("pages"))
