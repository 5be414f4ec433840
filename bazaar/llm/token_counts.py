"""Token counts with a whole-token shortcut.

Offline (once per worker and vocabulary) it is proved which vocabulary strings the
library encodes alone as exactly one token: each candidate is split by the pre-token
pattern into itself and encoded by the library into its own id. In a text, pre-tokens
found among them count 1 each; only the rest is merged, by the library, pre-token by
pre-token, and remembered in a cache of bounded size.

Byte-pair merges never cross a pre-token, so the sum is the library's count for the
whole text. Special strings are cut out by the library before the pattern runs, and other
alphabets depend on its Unicode tables: texts that hold a special string or any character
outside ASCII, the Latin blocks and general punctuation go to the library as a whole.

Defined cases: a null text counts as empty (0 bytes, 0 tokens); texts of any length are
counted whole, the pattern streaming over them; extra columns are not read; repeated
rows give repeated results; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaar.llm.common import bounded_batches, text_or_empty

#: The letters and numbers among PLAIN.
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
NUMBERS = "0-9²³¹¼½¾"
#: The pre-token pattern of the byte-level vocabulary, over plain texts.
PRE_TOKEN = (rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^\s{LETTERS}{NUMBERS}]+"
             r"|\s+(?!\S)|\s+")
#: Characters for which every Unicode version of the last decade agrees on letters, numbers and spaces.
PLAIN = "\t\n\r\x20-\x7e\xa1-\xac\xae-ɏ‐-‧‰-⁞€"
CACHE = 600_000
LONG = 1 << 20


def byte_symbols() -> dict[int, int]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the rest for 256, 257, ..."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return {b: b if b in own else next(rest) for b in range(256)}


SYMBOLS = byte_symbols()


def symbols(token: str) -> str:
    """A pre-token as the vocabulary spells it: one symbol per UTF-8 byte."""
    return token.encode().decode("latin-1").translate(SYMBOLS)


class _Seen(dict):
    """Tokens by pre-token: 1 for the whole ones; the rest is merged by the library once and kept for a while."""

    def __init__(self, whole: set[str], merge):
        super().__init__(dict.fromkeys(whole, 1))
        self.whole, self.merge = whole, merge

    def __missing__(self, token: str) -> int:
        n = len(self.merge(symbols(token)))
        if len(self) >= len(self.whole) + CACHE:
            self.clear()
            self.update(dict.fromkeys(self.whole, 1))
        if len(token) <= 64:
            self[token] = n
        return n


class Counter:
    """Counts tokens for one byte-level vocabulary file of the `tokenizers` library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.lib.no_truncation()
        self.lib.no_padding()
        spec = json.loads(self.lib.to_str())
        self.specials = [t["content"] for t in spec.get("added_tokens", [])]
        self.find = re.compile(PRE_TOKEN)
        self.odd = re.compile(f"[^{PLAIN}]")
        self.whole = self._prove(spec)
        self.seen = _Seen(self.whole, self.lib.model.tokenize)

    def _prove(self, spec: dict) -> set[str]:
        """Vocabulary strings that are one pre-token and that the library encodes as one token."""
        ids = sorted(spec["model"]["vocab"].values())
        texts = [x for x in self.lib.decode_batch([[i] for i in ids], skip_special_tokens=False)
                 if x and "�" not in x and x not in self.specials and not self.odd.search(x)]
        texts = [x for x in texts if self.find.findall(x) == [x]]
        return {x for x, e in zip(texts, self.lib.encode_batch(texts, add_special_tokens=False)) if len(e.ids) == 1}

    def plain(self, text: str) -> bool:
        return not self.odd.search(text) and not any(s in text for s in self.specials)

    def count(self, text: str) -> int:
        if not self.plain(text):
            return len(self.lib.encode(text, add_special_tokens=False).ids)
        if len(text) > LONG:
            return sum(self.seen[m.group()] for m in self.find.finditer(text))
        return sum(map(self.seen.__getitem__, self.find.findall(text)))


_COUNTERS: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    """One counter per worker process and vocabulary file."""
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(path)
    return _COUNTERS[path]


def token_counts(docs: DataFrame, path: str, limit: int = 512, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit for every row.

    `path` names a vocabulary file that every executor has at that place.
    """
    bounded_batches(docs.sparkSession)

    @F.pandas_udf("long")
    def tokens(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        c = counter(path)
        for texts in parts:
            yield pd.Series([c.count(t) for t in texts], dtype="int64")

    text = text_or_empty(text_col)
    out = docs.select(F.col(id_col).alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"),
                      tokens(text).alias("n_tokens"))
    return out.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
