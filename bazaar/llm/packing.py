"""Best-two-fit packing of documents into token sequences.

Documents become pieces: only those longer than a sequence are cut, into full pieces and
a rest. Full pieces are sequences by themselves. The rests are packed in batches of
bounded size, dealt by a hash of the document, one Spark task per batch: a bin is filled
greedily, longest fitting piece first; then its smallest piece is taken out and
the two unpacked pieces that fill the widened gap most tightly take its place, if they fill the bin better.

A batch holds about `batch` pieces, so it loses at most one half-filled sequence in thousands;
the number of batches follows from the number of pieces, at every size by the same
rule. Tasks see lengths and ids only.

Token ids come from the `tokenizers` library, pre-token by pre-token through a bounded
cache, for texts of plain characters (see `token_counts`) without a special string; all
other texts go to the library as a whole.

Defined cases: null text is empty, and a document without tokens is its end id alone;
an id that occurs on several rows is a document each time (such rows share a batch, and
`row` tells them apart); an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaar.llm.common import bounded_batches, materialize, text_or_empty
from bazaar.llm.token_counts import LETTERS, NUMBERS, PLAIN, symbols

#: The pre-token pattern of the word vocabulary, over plain texts in lower case.
PRE_TOKEN = rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{NUMBERS}]|[^\s{LETTERS}{NUMBERS}]+"
CACHE = 500_000
STRETCH = 1 << 20


class _Words(dict):
    """Token ids (little-endian 32-bit) by pre-token, merged by the library once and kept for a while."""

    def __init__(self, merge):
        super().__init__()
        self.merge = merge

    def __missing__(self, word: str) -> bytes:
        ids = np.array([t.id for t in self.merge(symbols(word))], dtype="<u4").tobytes()
        if len(self) >= CACHE:
            self.clear()
        if len(word) <= 64:
            self[word] = ids
        return ids


class Encoder:
    """Ids of whole texts for a lower-casing word vocabulary."""

    def __init__(self, path: str):
        import json

        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.lib.no_truncation()
        self.lib.no_padding()
        self.specials = [t["content"] for t in json.loads(self.lib.to_str()).get("added_tokens", [])]
        self.find = re.compile(PRE_TOKEN)
        self.odd = re.compile(f"[^{PLAIN}]")
        self.words = _Words(self.lib.model.tokenize)

    def ids(self, text: str) -> bytes:
        low = text.lower()
        if self.odd.search(text) or self.odd.search(low) or any(s in text for s in self.specials):
            return np.array(self.lib.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        if len(low) > STRETCH:
            return b"".join(self.words[m.group()] for m in self.find.finditer(low))
        return b"".join(map(self.words.__getitem__, self.find.findall(low)))


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def pieces(docs: DataFrame, path: str, length: int = 2048, end: int = 0, id_col: str = "doc_id",
           text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(doc_id, row, piece, start, length, ids_crc32) of every document, with the ids themselves if asked for."""
    bounded_batches(docs.sparkSession)
    close = np.array([end], dtype="<u4").tobytes()
    kind = "array<struct<start:bigint,length:bigint,ids_crc32:bigint" + (",ids:binary>>" if with_ids else ">>")

    @F.pandas_udf(kind)
    def cut(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoder(path)
        for texts in parts:
            out = []
            for t in texts:
                ids = enc.ids(t) + close
                some = []
                for at in range(0, len(ids), 4 * length):
                    own = ids[at:at + 4 * length]
                    x = {"start": at // 4, "length": len(own) // 4, "ids_crc32": zlib.crc32(own)}
                    some.append(x | {"ids": own} if with_ids else x)
                out.append(some)
            yield pd.Series(out, dtype="object")

    cols = ["p.start", "p.length", "p.ids_crc32", *(["p.ids"] if with_ids else [])]
    return (docs.select(F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("row"),
                        cut(text_or_empty(text_col)).alias("ps"))
            .select("doc_id", "row", F.posexplode("ps").alias("piece", "p"))
            .select("doc_id", "row", "piece", *cols))


def best_two_fit(lengths: np.ndarray, size: int) -> np.ndarray:
    """The bin of each length (1 .. size), bins counted from 0, in order of the lengths given.

    Lengths are handled by their counts, so that one step costs as much as there are different lengths.
    """
    stacks: list[list[int]] = [[] for _ in range(size + 1)]
    for i in range(len(lengths) - 1, -1, -1):
        stacks[lengths[i]].append(i)
    count = np.array([len(s) for s in stacks], dtype=np.int64)
    bins = np.full(len(lengths), -1, dtype=np.int64)
    n = 0
    fits = np.nonzero(count)[0]  # different lengths that are left, ascending

    def take(k: int) -> int:
        nonlocal fits
        count[k] -= 1
        if not count[k]:
            fits = fits[fits != k]
        return k

    while len(fits):
        gap, own = size, []
        while gap:  # greedy: the longest that fits
            at = np.searchsorted(fits, gap, side="right") - 1
            if at < 0:
                break
            own.append(take(int(fits[at])))
            gap -= own[-1]
        if gap and len(fits) and len(own) > 1:
            small = own[-1]  # greedy filling takes pieces in falling order
            wide = gap + small
            # the best pair (a <= b) with a + b <= wide: for every a the longest b that fits
            a = fits[fits <= wide // 2]
            if len(a):
                at = np.searchsorted(fits, wide - a, side="right") - 1
                b = fits[at]
                sums = np.where((b > a) | ((b == a) & (count[a] > 1)), a + b, 0)
                # where b is a itself and alone, a shorter partner is below a, and that pair is found from its side
                best = int(sums.argmax())
                if sums[best] > small:
                    own.pop()
                    count[small] += 1
                    if count[small] == 1:
                        fits = np.insert(fits, np.searchsorted(fits, small), small)
                    own += [take(int(b[best])), take(int(a[best]))]
        for k in own:
            bins[stacks[k].pop()] = n
        n += 1
    return bins


def pack(cut: DataFrame, length: int = 2048, batch: int = 30_000) -> DataFrame:
    """`cut` (pieces, stable) with sequence_id and offset."""
    full = cut.filter(F.col("length") == length)
    rest = cut.filter(F.col("length") < length)
    n = rest.count()
    batches = n // batch + 1
    # pandas would turn an id column with nulls into floats: ids pass as text
    kinds = {f.name: f.dataType.simpleString() for f in cut.schema.fields}
    dealt = rest.withColumn("b", F.pmod(F.xxhash64("doc_id", "row"), F.lit(batches))).withColumn(
        "doc_id", F.col("doc_id").cast("string"))

    def fill(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "row"], ascending=[False, True], kind="stable", ignore_index=True)
        bins = best_two_fit(frame["length"].to_numpy(dtype=np.int64), length)
        order = np.argsort(bins, kind="stable")
        sizes, of = frame["length"].to_numpy()[order], bins[order]
        ends = np.cumsum(sizes)
        first = np.r_[True, of[1:] != of[:-1]]
        offset = np.empty(len(frame), dtype=np.int64)
        offset[order] = ends - sizes - np.maximum.accumulate(np.where(first, ends - sizes, 0))
        return frame.assign(sequence_id=bins * batches + frame["b"], offset=offset).drop(columns="b")

    kind = ", ".join(f"{c} {'string' if c == 'doc_id' else k}" for c, k in kinds.items())
    packed = dealt.groupBy("b").applyInPandas(fill, f"{kind}, sequence_id long, offset long").withColumn(
        "doc_id", F.col("doc_id").cast(kinds["doc_id"]))
    # sequences of one full piece get negative numbers: neither kind needs the other's count
    alone = full.withColumn("sequence_id", -1 - F.monotonically_increasing_id()).withColumn(
        "offset", F.lit(0).cast("long"))
    return packed.unionByName(alone)


def packed_documents(docs: DataFrame, path: str, length: int = 2048, end: int = 0, id_col: str = "doc_id",
                     text_col: str = "text", batch: int = 30_000) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    cut = materialize(pieces(docs, path, length, end, id_col, text_col), "op9-pieces")
    return pack(cut, length, batch).select("doc_id", F.col("piece").cast("int").alias("piece"), "start", "length",
                                           "ids_crc32", "sequence_id", "offset")


def sequences(docs: DataFrame, path: str, length: int = 2048, end: int = 0, id_col: str = "doc_id",
              text_col: str = "text", batch: int = 30_000) -> DataFrame:
    """The sequences themselves: sequence_id, n_tokens, pieces (doc_id, piece, offset, length) and ids (binary)."""
    cut = materialize(pieces(docs, path, length, end, id_col, text_col, with_ids=True), "op9-sequences")
    placed = pack(cut.drop("ids"), length, batch).select("row", "piece", "doc_id", "length", "sequence_id", "offset")
    both = placed.join(cut.select("row", "piece", "ids"), ["row", "piece"])
    # a sequence holds at most `length` pieces of one token each
    one = both.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"),
        F.array_sort(F.collect_list(F.struct("offset", "doc_id", "piece", "length", "ids"))).alias("ps"))
    return one.select("sequence_id", "n_tokens",
                      F.transform("ps", lambda p: p.dropFields("ids")).alias("pieces"),
                      F.expr("aggregate(ps, cast('' as binary), (a, p) -> a || p.ids)").alias("ids"))
