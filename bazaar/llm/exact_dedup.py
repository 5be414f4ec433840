"""Exact dedup by two-pass Bloom filtering.

Pass one hashes every text and counts the hashes' cells in a Bloom filter with
saturating counters 0, 1, 2. A hash occurs once for certain if one of its cells is
below 2. Pass two tests every hash: certain singles pass straight through, and only
the possibly repeated rows (id, length, hash; never a text) are shuffled and grouped
by the whole hash, so the filter decides what moves and never what is equal.

The filter has a fixed number of cells (`CELLS`, 4 MB as a bit map), whatever the
input: a fuller filter only lets more rows through to the shuffle. Each task writes
its own counters in slices; slices are merged slice by slice, streaming, so neither
a task nor the driver holds more than one filter.

Defined cases: a null text counts as the empty text; texts are equal if equal without
``[\\x20\\x09-\\x0D]``; an empty table gives an empty result; of rows that tie in length the
smallest id stays (null ids last), and of rows that tie in id too exactly one stays.
Extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaar.llm.common import materialize, text_or_empty

CELLS = 1 << 25
SLICE = 1 << 18
PROBES = 3


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n, h, uid): id, code points of the text, SHA-256 without white space, a row number."""
    text = text_or_empty(text_col)
    bare = F.regexp_replace(text, r"[\x20\x09-\x0D]+", "")
    return docs.select(F.col(id_col).alias("doc_id"), F.char_length(text).cast("long").alias("n"),
                       F.unhex(F.sha2(bare.cast("binary"), 256)).alias("h"),
                       F.monotonically_increasing_id().alias("uid"))


def _cells(hashes: pd.Series, cells: int) -> np.ndarray:
    words = np.frombuffer(b"".join(hashes), dtype="<u8").reshape(len(hashes), -1)
    return (words[:, :PROBES] & np.uint64(cells - 1)).astype(np.int64)


def _count_cells(cells: int, part: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = np.zeros(cells, dtype=np.uint8)
        for b in batches:
            if len(b):
                at, n = np.unique(_cells(b["h"], cells), return_counts=True)
                seen[at] = np.minimum(seen[at] + np.minimum(n, 2), 2)
        for k in range(0, cells, part):
            piece = seen[k:k + part]
            if piece.any():
                yield pd.DataFrame({"slice": [k // part],
                                    "once": [zlib.compress(np.packbits(piece >= 1).tobytes(), 1)],
                                    "twice": [zlib.compress(np.packbits(piece >= 2).tobytes(), 1)]})
    return run


def _merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    once: dict[int, np.ndarray] = {}
    twice: dict[int, np.ndarray] = {}
    for b in batches:
        for k, x, y in zip(b["slice"], b["once"], b["twice"]):
            one, two = (np.frombuffer(zlib.decompress(v), dtype=np.uint8) for v in (x, y))
            if k in once:
                twice[k] = twice[k] | two | (once[k] & one)
                once[k] = once[k] | one
            else:
                once[k], twice[k] = one, two
    if once:
        yield pd.DataFrame({"slice": list(once), "once": [v.tobytes() for v in once.values()],
                            "twice": [v.tobytes() for v in twice.values()]})


def bloom(hashed: DataFrame, which: str = "twice", cells: int = CELLS, part: int = SLICE) -> bytes:
    """The bit map of the cells that one row at least (`once`) or two (`twice`) hit: `cells` / 8 bytes, never more.

    `hashed` has the hashes, of 24 bytes or more in steps of 8, in the column `h`.
    """
    part = min(part, cells)
    kind = "slice int, once binary, twice binary"
    pieces = hashed.select("h").mapInPandas(_count_cells(cells, part), kind)
    merged = pieces.repartition("slice").mapInPandas(_merge, kind).select("slice", which).collect()
    bits = bytearray(cells // 8)
    for k, piece in merged:
        bits[k * (part // 8):(k + 1) * (part // 8)] = piece
    return bytes(bits)


def may_hold(bits: bytes, hashes: pd.Series, cells: int = CELLS) -> np.ndarray:
    """For each hash, whether all its cells are set."""
    if not len(hashes):
        return np.zeros(0, dtype=bool)
    at = _cells(hashes, cells)
    own = np.frombuffer(bits, dtype=np.uint8)
    return ((own[at >> 3] >> (7 - (at & 7))) & 1).all(axis=1)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", cells: int = CELLS) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256 (hex)."""
    spark = docs.sparkSession
    hashed = materialize(digests(docs, id_col, text_col), "op5-digests")
    filt = spark.sparkContext.broadcast(bloom(hashed, "twice", cells))

    @F.pandas_udf("boolean")
    def maybe_repeated(h: pd.Series) -> pd.Series:
        return pd.Series(may_hold(filt.value, h, cells))

    flagged = hashed.withColumn("rep", maybe_repeated("h"))
    sha = F.lower(F.hex("h")).alias("text_sha256")
    singles = flagged.filter(~F.col("rep")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), sha)
    rows = flagged.filter("rep").drop("rep")
    rank = F.struct((-F.col("n")).alias("a"), F.col("doc_id").isNull().alias("b"), F.col("doc_id").alias("c"),
                    F.col("uid").alias("d"))
    # the summary is written first: a join of two plain shuffles is one that Spark can split at a hot hash
    groups = materialize(rows.groupBy("h").agg(F.min(rank).alias("w"), F.count(F.lit(1)).alias("group_size")),
                         "op5-groups")
    repeats = rows.join(groups, "h").select(
        "doc_id", F.col("w.c").alias("keep_id"), F.col("group_size").cast("long").alias("group_size"),
        (F.col("uid") == F.col("w.d")).alias("kept"), sha)
    return singles.unionByName(repeats)


SQL = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) = 1 AS kept,
       text_sha256
FROM t
"""
