"""Sharding by a hierarchical weighted hash tree.

A topology is a tree of regions, racks and shards; an inner node weighs the sum of its
shards. A key descends it: at each level every child draws -ln(u) / weight, u a hash
of key and child, and the smallest draw wins. A child's draw depends on the key and its own
name and weight alone, so a change of weights moves rows only into or out of the
subtrees whose weights change.

A tree grows by a region of its own for each new shard (`grow`): only that region's
draw is new, so a row stays or moves into the new shard (the law `key`).

DataFrame functions only. Slots (positions within a shard) are counted within 4096 hash
buckets of each shard and offset by the buckets' counts, so that no task holds a
shard.

Defined cases: a null key is a key of its own; a null text has size 16 and the CRC-32 of
no bytes; repeated rows get slots of their own; an empty table gives an empty result;
children of weight 0 take no rows; extra columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaar.llm.common import gapless, materialize, text_or_empty, unit_draw


class Leaf(NamedTuple):
    region: str
    rack: str
    shard: int
    weight: float = 1.0


def topology(n_shards: int, base: int = 40, per_rack: int = 4, racks: int = 2) -> list[Leaf]:
    """The tree that `n_shards` decides: up to `base` shards in regions of `racks` racks with
    `per_rack` shards each; every later shard is a region of its own."""
    leaves = [Leaf(f"r{s // (per_rack * racks)}", f"k{s // per_rack}", s) for s in range(min(n_shards, base))]
    for _ in range(base, n_shards):
        leaves = grow(leaves)
    return leaves


def grow(leaves: list[Leaf], weight: float = 1.0) -> list[Leaf]:
    """One more shard, in a region of its own: every other subtree keeps its weight."""
    new = max((x.shard for x in leaves), default=-1) + 1
    return [*leaves, Leaf(f"r+{new}", f"k+{new}", new, weight)]


def _nest(leaves: list[Leaf]) -> Column:
    """The tree as an array literal: region (name, weight, racks (name, weight, shards (name, weight, id)))."""
    tree: dict[str, dict[str, list[Leaf]]] = defaultdict(lambda: defaultdict(list))
    for x in leaves:
        if x.weight > 0:
            tree[x.region][x.rack].append(x)
    if not tree:
        raise ValueError("a topology needs a shard with a weight above 0")

    def node(name: str, weight: float, rest: Column) -> Column:
        return F.struct(F.lit(name).alias("name"), F.lit(float(weight)).alias("w"), rest.alias("below"))

    regions = []
    for r, by_rack in tree.items():
        racks = [node(k, sum(x.weight for x in xs),
                      F.array(*[node(f"s{x.shard}", x.weight, F.lit(x.shard)) for x in xs]))
                 for k, xs in by_rack.items()]
        regions.append(node(r, sum(x.weight for xs in by_rack.values() for x in xs), F.array(*racks)))
    return F.array(*regions)


def _descend(key: Column, children: Column) -> Column:
    """What lies below the child with the smallest weighted draw."""
    drawn = F.transform(children, lambda c: F.struct(
        (-F.log(unit_draw(key, c["name"])) / c["w"]).alias("draw"), c["name"].alias("name"),
        c["below"].alias("below")))
    return F.array_min(drawn)["below"]


def place(key: Column, leaves: list[Leaf]) -> Column:
    """The shard of a key: one draw among regions, one among racks, one among shards."""
    return _descend(key, _descend(key, _descend(key, _nest(leaves))))


def shard_documents(docs: DataFrame, leaves: list[Leaf], grown: list[Leaf] | None = None, id_col: str = "doc_id",
                    text_col: str = "text", buckets_hex: int = 3) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard (where a grown tree puts the row)."""
    text = text_or_empty(text_col)
    key = F.col(id_col)
    size, crc = F.octet_length(text).cast("long") + 16, F.crc32(text.cast("binary"))
    grown_shard = place(key, grown) if grown else F.lit(None)
    bucket = F.substring(F.md5(F.concat_ws("|", F.lit("slot"), F.coalesce(key.cast("string"), F.lit("null")),
                                           F.col("text_crc32").cast("string"), F.col("size").cast("string"))),
                         1, buckets_hex)
    placed = materialize(
        docs.select(key.alias("doc_id"), size.alias("size"), crc.alias("text_crc32"),
                    place(key, leaves).cast("int").alias("shard"), grown_shard.cast("int").alias("grown_shard"))
        .withColumn("bucket", bucket), "op2-placed")
    slotted = gapless(placed, ["shard"], ["bucket"], [F.col("doc_id"), F.col("text_crc32"), F.col("size")], "slot",
                      coarse=F.substring("bucket", 1, 1))
    return slotted.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                          F.col("slot").cast("long").alias("slot"), "grown_shard")


def write_shards(docs: DataFrame, leaves: list[Leaf], path: str, id_col: str = "doc_id") -> None:
    """Write the rows with all their columns as Parquet, one folder `__llm_shard=N` per shard."""
    (docs.withColumn("__llm_shard", place(F.col(id_col), leaves)).write.mode("overwrite")
     .partitionBy("__llm_shard").parquet(path))


def sql(leaves: list[Leaf], grown: list[Leaf]) -> str:
    """DuckDB SQL for `shard_documents`: ranks the children of each level by their draws; the CRC-32 is
    folded over the bytes with the table that the polynomial's bit rule gives."""
    def rows(tree: list[Leaf], which: int) -> list[str]:
        total_r: dict[str, float] = defaultdict(float)
        total_k: dict[str, float] = defaultdict(float)
        for x in tree:
            total_r[x.region] += x.weight
            total_k[x.rack] += x.weight
        return [f"({which}, '{x.region}', {total_r[x.region]}, '{x.rack}', {total_k[x.rack]}, {x.shard}, {x.weight})"
                for x in tree]

    def draw(name: str, weight: str) -> str:
        return (f"-ln((('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || '|' || {name}), 1, 13))"
                f"::BIGINT + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE) / {weight}::DOUBLE")

    leaf_rows = ", ".join([*rows(leaves, 0), *rows(grown, 1)])
    return f"""
WITH tree(which, region, wr, rack, wk, shard, ws) AS (VALUES {leaf_rows}),
drawn AS (
  SELECT doc_id, which, shard, {draw("region", "wr")} AS dr, {draw("rack", "wk")} AS dk,
         {draw("'s' || shard", "ws")} AS ds
  FROM (SELECT DISTINCT doc_id FROM documents), tree),
best AS (
  SELECT doc_id, which, shard FROM drawn
  QUALIFY row_number() OVER (PARTITION BY doc_id, which ORDER BY dr, dk, ds) = 1),
bytes AS (
  SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
crc_table AS (
  SELECT list(list_reduce([n] || range(8)::BIGINT[],
                          lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)
              ORDER BY n) AS tab
  FROM (SELECT unnest(range(256))::BIGINT AS n)),
sized AS (
  SELECT r, doc_id, length(h) // 2 + 16 AS size,
         xor(4294967295, list_reduce([4294967295::BIGINT] || list_transform(range(0, length(h), 2),
                 lambda i: ('0x' || substr(h, CAST(i AS INTEGER) + 1, 2))::BIGINT),
             lambda c, b: xor(tab[(xor(c, b) & 255) + 1], c >> 8))) AS text_crc32
  FROM bytes, crc_table)
SELECT s.doc_id, s.size, s.text_crc32, 'key' AS law, CAST(a.shard AS INTEGER) AS shard,
       row_number() OVER (PARTITION BY a.shard
                          ORDER BY substr(md5('slot|' || coalesce(CAST(s.doc_id AS VARCHAR), 'null') || '|'
                                              || s.text_crc32 || '|' || s.size), 1, 3),
                                   s.doc_id NULLS FIRST, s.text_crc32, s.size) - 1 AS slot,
       CAST(b.shard AS INTEGER) AS grown_shard
FROM sized s
JOIN best a ON a.which = 0 AND a.doc_id IS NOT DISTINCT FROM s.doc_id
JOIN best b ON b.which = 1 AND b.doc_id IS NOT DISTINCT FROM s.doc_id
"""
