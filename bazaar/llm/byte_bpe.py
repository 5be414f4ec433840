"""Byte-level BPE by a sentencepiece model that is serialised from the vocabulary itself.

A rank file lists a vocabulary of byte strings with their ranks. Each of its entries becomes one piece of a
sentencepiece BPE model: its bytes spelled as one symbol per byte, its score the negative rank, so that the
library merges the pair of the lowest rank first, leftmost among equals. The model's normalisation
is the identity: no dummy prefix, no white space removed or escaped. Pieces stand in the order of their ranks
and the unknown piece comes last, so piece ids are ranks. Nothing is trained.

A text is cut by the pre-token pattern. A pre-token that is an entry as a whole is that entry; the others are
spelled in byte symbols and encoded by the model, those of a batch of texts in one call. Results of short pre-tokens
are kept in a cache of bounded size. Decoding is the inverse mapping: the pieces of the ids, spelled back to bytes.

Defined cases: a null or empty text has no ids; texts of any length are encoded whole, the pattern running over them
match by match; extra columns are not read; repeated rows give repeated results; an empty table gives an
empty result. A rank file whose ranks are not 0, 1, 2, ..., or that lacks one of the 256 single bytes, is refused.
Letters and numbers are those of the installed `regex` package's Unicode tables; texts of characters on which all
tables agree are cut by the same pattern with its classes written out.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from array import array
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaar.llm.common import bounded_batches, text_or_empty
from bazaar.llm.token_counts import LETTERS, NUMBERS, PLAIN, SYMBOLS, symbols

CACHE = 500_000
#: Pre-tokens of more characters are encoded anew each time.
SHORT = 64
#: Of longer texts the pre-tokens are never listed as a whole.
LONG = 1 << 20

# Fixed values of the model format: wire types, field numbers and enum values.
VARINT, BYTES, FIXED32 = 0, 2, 5
PIECES, TRAINER, NORMALIZER = 1, 2, 3
PIECE, SCORE, TYPE, UNKNOWN = 1, 2, 3, 2
MODEL_TYPE, BPE, VOCAB_SIZE = 3, 2, 4
NAME, DUMMY_PREFIX, EXTRA_SPACES, ESCAPE_SPACES = 1, 3, 4, 5


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value: int | float | bytes) -> bytes:
    """One field: whole numbers as varints, floats in 32 bits, bytes with their length."""
    if isinstance(value, float):
        return _varint(number << 3 | FIXED32) + struct.pack("<f", value)
    if isinstance(value, int):
        return _varint(number << 3 | VARINT) + _varint(value)
    return _varint(number << 3 | BYTES) + _varint(len(value)) + value


def read_ranks(path: str) -> list[bytes]:
    """The entries of a rank file (base64 and rank per line), by rank."""
    with open(path, "rb") as f:
        pairs = sorted((int(rank), base64.b64decode(entry)) for entry, rank in (line.split() for line in f if line.strip()))
    if [r for r, _ in pairs] != list(range(len(pairs))) or {bytes([b]) for b in range(256)} - {e for _, e in pairs}:
        raise ValueError(f"{path}: ranks must be 0, 1, 2, ... and every single byte an entry")
    return [e for _, e in pairs]


def spelled(entry: bytes) -> str:
    """A byte string with one symbol per byte."""
    return entry.decode("latin-1").translate(SYMBOLS)


def model_proto(entries: list[bytes]) -> bytes:
    """The serialised sentencepiece model of a vocabulary in the order of its ranks."""
    out = [_field(PIECES, _field(PIECE, spelled(e).encode()) + _field(SCORE, float(-rank)))
           for rank, e in enumerate(entries)]
    out.append(_field(PIECES, _field(PIECE, b"<unk>") + _field(SCORE, 0.0) + _field(TYPE, UNKNOWN)))
    out.append(_field(TRAINER, _field(MODEL_TYPE, BPE) + _field(VOCAB_SIZE, len(entries) + 1)))
    out.append(_field(NORMALIZER, _field(NAME, b"identity") + _field(DUMMY_PREFIX, 0) + _field(EXTRA_SPACES, 0)
                      + _field(ESCAPE_SPACES, 0)))
    return b"".join(out)


def written_out(pattern: str) -> str | None:
    """A pattern with the letters and numbers of PLAIN in place of their Unicode classes; None where others are left."""
    out, inside = [], False
    for part in re.findall(r"\\p\{[LN]\}|\\.|.", pattern, re.DOTALL):
        inside = part == "[" or (inside and part != "]")
        listed = {r"\p{L}": LETTERS, r"\p{N}": NUMBERS}.get(part)
        out.append(part if listed is None else listed if inside else f"[{listed}]")
    made = "".join(out)
    return None if "\\p" in made.lower() else made


class _Seen(dict):
    """Ids by pre-token, little-endian in 32 bits each; long ones are not kept."""

    def __init__(self, of):
        super().__init__()
        self.of = of

    def __missing__(self, token: str) -> bytes:
        got = self.of([token])[0]
        if len(token) <= SHORT:
            self[token] = got
        return got


class Codec:
    """Encodes and decodes with one rank file and one pre-token pattern."""

    def __init__(self, path: str, pattern: str):
        import sentencepiece

        entries = read_ranks(path)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model_proto(entries))
        back = {symbol: byte for byte, symbol in SYMBOLS.items()}
        pieces = (self.model.id_to_piece(i) for i in range(len(entries)))
        self.bytes_of = [p.translate(back).encode("latin-1") for p in pieces]
        self.whole = {e: struct.pack("<I", rank) for rank, e in enumerate(entries)}
        self.any = regex.compile(pattern)
        plain = written_out(pattern)
        self.plain = re.compile(plain) if plain else None
        self.odd = re.compile(f"[^{PLAIN}]")
        self.seen = _Seen(self._ids)

    def _ids(self, tokens: list[str]) -> list[bytes]:
        """The ids of pre-tokens, little-endian in 32 bits each."""
        out = [self.whole.get(t.encode()) for t in tokens]
        rest = [k for k, ids in enumerate(out) if ids is None]
        for k, ids in zip(rest, self.model.encode([symbols(tokens[k]) for k in rest], num_threads=1)):
            out[k] = array("I", ids).tobytes()
        return out

    def _pattern(self, text: str):
        return self.any if self.plain is None or self.odd.search(text) else self.plain

    def encode(self, text: str) -> bytes:
        """The ids of a text, little-endian in 32 bits each."""
        return b"".join([self.seen[m.group()] for m in self._pattern(text).finditer(text)])

    def encode_batch(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text. Long texts are cut on their own, the others' new pre-tokens encoded together."""
        if len(self.seen) > CACHE:
            self.seen.clear()
        cut = [[] if len(t) > LONG else self._pattern(t).findall(t) for t in texts]
        got = [list(map(self.seen.get, c)) for c in cut]
        new = {t for c, g in zip(cut, got) if None in g for t, ids in zip(c, g) if ids is None}
        new = [t for t in new if len(t) <= SHORT]
        self.seen.update(zip(new, self._ids(new)))
        for t, c, g in zip(texts, cut, got):
            if len(t) > LONG:
                yield self.encode(t)
            else:
                yield b"".join(map(self.seen.__getitem__, c) if None in g else g)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, array("I", ids)))


_CODECS: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """One codec per worker process, vocabulary file and pattern."""
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = Codec(path, pattern)
    return _CODECS[path, pattern]


def encoded(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (binary: little-endian unsigned 32-bit numbers) of every row."""
    bounded_batches(docs.sparkSession)

    @F.arrow_udf("binary")
    def ids(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        c = codec(path, pattern)
        for texts in parts:
            yield pa.array(list(c.encode_batch(texts.to_pylist())), pa.binary())

    return docs.select(F.col(id_col).alias("doc_id"), ids(text_or_empty(text_col)).alias("ids"))


def decoded(rows: DataFrame, path: str, pattern: str, ids_col: str = "ids") -> DataFrame:
    """`rows` with `decoded`, the bytes (binary) that the ids stand for; null ids decode to null."""
    bounded_batches(rows.sparkSession)

    @F.arrow_udf("binary")
    def back(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        c = codec(path, pattern)
        for ids in parts:
            yield pa.array([None if x.as_py() is None else c.decode(x.as_py()) for x in ids], pa.binary())

    return rows.withColumn("decoded", back(F.col(ids_col)))


def round_trips(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row: the text encoded, and its ids decoded again.

    Only the digests leave the Python workers.
    """
    bounded_batches(docs.sparkSession)

    @F.arrow_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digest(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        c = codec(path, pattern)
        for texts in parts:
            n, encoded_, decoded_ = [], [], []
            for ids in c.encode_batch(texts.to_pylist()):
                n.append(len(ids) // 4)
                encoded_.append(hashlib.sha256(ids).hexdigest())
                decoded_.append(hashlib.sha256(c.decode(ids)).hexdigest())
            yield pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(encoded_, pa.string()),
                                              pa.array(decoded_, pa.string())],
                                             ["n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col(id_col).alias("doc_id"), digest(text_or_empty(text_col)).alias("d")).select("doc_id", "d.*")
