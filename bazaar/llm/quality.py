"""Quality classification from weak labels.

Heuristic labellers each vote good, bad or abstain on the whole text. The votes of all
documents, counted by pattern (at most 3 ^ labellers rows), go through an
expectation-maximisation that estimates how often each labeller, when it votes, is right on
good and on bad documents, without any given label. The posteriors label a bounded, hash-drawn sample, on
which a logistic scorer over hashed features of the text is fitted; it scores every
document, and those below the threshold are rejected.

Features: frequencies of hashed 4-grams of character kinds, and how many words and
word triples repeat, in steps.

Defined cases: a null, empty or blank text has no words and is rejected with score 0 (its weak label
is 0); with one class only in the sample every other document is kept if the posteriors
say good; repeated rows are scored alike; null ids are ids; an empty table gives an empty
result; extra columns are not read by `classify`, and `kept` returns them unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaar.llm import wordhash
from bazaar.llm.common import SPACE, bounded_batches, hash_sample, level_quotas, materialize, text_or_empty

BAD, GOOD, NONE = 0, 1, 2
#: Where the estimation starts: P(vote bad, vote good) of a labeller on bad and on good documents, as most
#: labellers know one kind of junk only and seldom see it in good text; and the share of good documents.
START = np.array([[0.4, 0.6], [0.05, 0.95]])
SHARE = 0.7
GRAMS = 1 << 11
STEPS = 16
DIM = GRAMS + 5 * STEPS
STRETCH = 1 << 20

#: Kinds of bytes: upper, lower, digit, space, line feed, bytes of other letters, and every sign by itself.
_KIND = np.zeros(256, dtype=np.uint64)
for _b in range(256):
    _c = chr(_b)
    _KIND[_b] = (1 if _c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" else 2 if _c in "abcdefghijklmnopqrstuvwxyz" else
                 3 if _c in "0123456789" else 5 if _c == "\n" else 4 if _c in SPACE else 2 if _b >= 128 else 6 + _b)
_SIGN = np.array([chr(b) in "#$%&*+/<=>@[\\]^_`{|}~!" for b in range(256)])
_BLANK = np.array([chr(b) in SPACE for b in range(256)])
_END = np.array([chr(b) in ".?!:;" for b in range(256)])


def facts(text: str) -> dict[str, float]:
    """What the labellers look at."""
    data = text.encode("utf-8", "surrogatepass")
    h = wordhash.words(data.lower())
    codes = np.frombuffer(data, dtype=np.uint8)
    counts = np.bincount(codes, minlength=256)
    kinds = np.bincount(_KIND.astype(np.int64), weights=counts, minlength=16)
    letters, n = kinds[1] + kinds[2], len(h)
    triples = wordhash.ngrams(h, 3)
    blank = _BLANK[codes]
    lone = _SIGN[codes[1:-1]] & blank[:-2] & blank[2:] if len(codes) > 2 else np.zeros(0)
    return {
        "words": n,
        "caps": kinds[1] / max(letters, 1),
        "signs": counts[_SIGN].sum() / max(counts.sum() - kinds[4] - kinds[5], 1),
        "lone": lone.sum() / max(n, 1),
        "letters": letters / max(counts.sum() - kinds[4] - kinds[5], 1),
        "same": float((h[1:] == h[:-1]).mean()) if n > 1 else 0.0,
        "again": 1 - len(np.unique(triples)) / len(triples) if n > 3 else 0.0,
        "length": (counts.sum() - kinds[4] - kinds[5]) / max(n, 1),
        "ends": counts[_END].sum() / max(n, 1),
    }


def _between(x: float, good: float, bad: float) -> int:
    """Good up to one bound, bad from the other, else no vote."""
    return GOOD if x <= good else BAD if x >= bad else NONE


#: The labellers: what they look at and their bounds.
LABELLERS = (
    ("capitals", lambda f: _between(f["caps"], 0.2, 0.4)),
    ("signs", lambda f: _between(f["signs"], 0.01, 0.04)),
    ("lone signs", lambda f: _between(f["lone"], 0.02, 0.1)),
    ("letters", lambda f: _between(1 - f["letters"], 0.1, 0.2)),
    ("stutter", lambda f: _between(f["same"], 0.02, 0.1) if f["words"] >= 20 else NONE),
    ("loops", lambda f: _between(f["again"], 0.1, 0.35) if f["words"] >= 20 else NONE),
    ("word length", lambda f: _between(abs(f["length"] - 6), 2.5, 6)),
    ("sentences", lambda f: NONE if f["words"] < 20 else _between(abs(np.log(max(f["ends"], 1e-3) / 0.1)), 1.2, 2.2)),
)


def votes(text: str) -> int:
    """The labellers' votes as one number in base 3; -1 for a text without words."""
    f = facts(text)
    if not f["words"]:
        return -1
    out = 0
    for _, labeller in LABELLERS:
        out = out * 3 + labeller(f)
    return out


def posteriors(counts: dict[int, int], rounds: int = 200) -> tuple[dict[int, float], np.ndarray, float]:
    """P(good) for each pattern, the labellers' P(vote | class), and the share of good documents.

    Votes are taken as independent within a class; an abstention says nothing. The start, which also tells which of
    the two classes is the good one, is `START`; it stays as a prior of two votes.
    """
    patterns = sorted(p for p in counts if p >= 0)
    n = len(LABELLERS)
    table = np.repeat(START[:, None, :], n, axis=1)
    if not patterns:
        return {-1: 0.0}, table, SHARE
    digits = np.array([[p // 3 ** (n - 1 - j) % 3 for j in range(n)] for p in patterns])
    weight = np.array([counts[p] for p in patterns], dtype=float)

    def expected(share: float) -> np.ndarray:
        log = [sum(np.log(table[y, :, v]) @ (digits == v).T for v in (BAD, GOOD)) for y in (BAD, GOOD)]
        return 1 / (1 + np.exp(-np.clip(log[GOOD] - log[BAD] + np.log(share / (1 - share)), -500, 500)))

    share = SHARE
    q = expected(share)
    for _ in range(rounds):
        share = float(np.clip((weight * q).sum() / weight.sum(), 0.01, 0.99))
        for y, own in ((BAD, weight * (1 - q)), (GOOD, weight * q)):
            for v in (BAD, GOOD):
                table[y, :, v] = ((digits == v) * own[:, None]).sum(axis=0) + 2 * START[y, v]
            table[y] /= table[y].sum(axis=1, keepdims=True)
        q = expected(share)
    return {-1: 0.0} | dict(zip(patterns, q.tolist())), table, share


def features(text: str) -> np.ndarray:
    """Hashed features of the whole text: root frequencies of 4-grams of kinds, and steps of repetition."""
    data = text.encode("utf-8", "surrogatepass")
    out = np.zeros(DIM, dtype=np.float64)
    for at in range(0, len(data), STRETCH):
        k = _KIND[np.frombuffer(data[max(0, at - 3):at + STRETCH], dtype=np.uint8)]
        if len(k) >= 4:
            g = ((k[:-3] * np.uint64(263) + k[1:-2]) * np.uint64(263) + k[2:-1]) * np.uint64(263) + k[3:]
            h = (g * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - GRAMS.bit_length() + 1)
            out[:GRAMS] += np.bincount(h.astype(np.int64), minlength=GRAMS)
    out = np.sqrt(out / max(len(data), 1))
    f = facts(text)
    for i, x in enumerate((f["same"], f["again"], f["caps"], f["signs"], f["lone"])):
        # a step for each bound passed, so that a linear scorer can bend
        out[GRAMS + i * STEPS:GRAMS + i * STEPS + int(np.ceil(np.sqrt(x) * STEPS))] = 0.25
    return out.astype(np.float32)


def fit(x: np.ndarray, soft: np.ndarray, rounds: int = 200, ridge: float = 1e-3) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels, classes weighted alike, by full-batch Adam."""
    w, b = np.zeros(x.shape[1], dtype=np.float32), 0.0
    if not len(x):
        return w, 0.0
    mass = np.array([(1 - soft).sum(), soft.sum()])
    weight = soft / max(mass[1], 1e-9) + (1 - soft) / max(mass[0], 1e-9)
    weight /= weight.sum()
    flipped = np.ascontiguousarray(x.T)
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for t in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30)))
        err = weight * (p - soft)
        g, gb = flipped @ err.astype(np.float32) + ridge * w, err.sum()
        m, v, mb, vb = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g, 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        c1, c2 = 1 - 0.9 ** t, 1 - 0.999 ** t
        w = (w - 0.1 * (m / c1) / (np.sqrt(v / c2) + 1e-9)).astype(np.float32)
        b = b - 0.1 * (mb / c1) / (np.sqrt(vb / c2) + 1e-9)
    return w, float(b)


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = 3000):
    """The scorer (weights, bias) and the posteriors by pattern.

    The votes of all rows are counted; at most `sample_rows` texts, as many weakly good as weakly bad ones where
    there are, lend their features (8 KB each, whatever their length) to the fit.
    """
    spark = docs.sparkSession
    bounded_batches(spark, 256)
    text = text_or_empty(text_col)

    @F.pandas_udf("int")
    def pattern(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            yield pd.Series([votes(t) for t in texts], dtype="int32")

    rows = docs.select(F.xxhash64(F.col(id_col), text).alias("draw"), text.alias("text"))
    voted = materialize(rows.select("draw", pattern("text").alias("pattern")), "op7-votes")
    counts = {r["pattern"]: r["n"] for r in voted.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).collect()}
    q, _, _ = posteriors(counts)
    # each pattern lends as equal a share as it can, so that rare kinds of junk are seen
    quotas: dict[int, int] = {}
    for good in (True, False):
        quotas |= level_quotas({p: n for p, n in counts.items() if p >= 0 and (q[p] >= 0.5) == good}, sample_rows // 2)
    own = {p: counts[p] for p in quotas}
    drawn = (hash_sample(voted, "pattern", "draw", own, quotas).dropDuplicates(["draw"])
             .orderBy("draw").limit(sample_rows))

    def features_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"draw": b["draw"], "pattern": b["pattern"],
                                "x": [features(t).astype(np.float16).tobytes() for t in b["text"]]})

    # at most sample_rows pairs of numbers: a bounded broadcast
    sample = rows.join(F.broadcast(drawn), "draw").dropDuplicates(["draw"])
    got = sample.mapInPandas(features_of, "draw long, pattern int, x binary").collect()
    got.sort(key=lambda r: r["draw"])
    x = np.frombuffer(b"".join(bytes(r["x"]) for r in got), dtype=np.float16).reshape(-1, DIM).astype(np.float32)
    soft = np.array([q[r["pattern"]] for r in got])
    return fit(x, soft), q


def score(docs: DataFrame, model, text_col: str = "text", batch: int = 128) -> Column:
    """A column with the scorer's P(good), 0 for texts without words."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        w, b = sent.value
        for texts in parts:
            out = []
            for lo, hi in pairwise([*range(0, len(texts), batch), len(texts)]):
                x = np.stack([features(t) for t in texts.iloc[lo:hi]])
                out.append(1 / (1 + np.exp(-np.clip((x @ w + b).astype(np.float64), -30, 30))))
            yield pd.Series(np.concatenate(out) if out else np.empty(0))

    text = text_or_empty(text_col)
    return F.when(F.length(F.btrim(text, F.lit(SPACE))) > 0, scored(text)).otherwise(F.lit(0.0))


def classify(docs: DataFrame, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text",
             sample_rows: int = 3000) -> DataFrame:
    """doc_id, score, keep for every row."""
    model, _ = train(docs, id_col, text_col, sample_rows)
    out = docs.select(F.col(id_col).alias("doc_id"), score(docs, model, text_col).alias("score"))
    return out.withColumn("keep", F.col("score") >= threshold)


def kept(docs: DataFrame, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text",
         sample_rows: int = 3000) -> DataFrame:
    """The rows of `docs`, all columns, that the scorer does not reject."""
    model, _ = train(docs, id_col, text_col, sample_rows)
    return (docs.withColumn("__llm_score", score(docs, model, text_col))
            .filter(F.col("__llm_score") >= threshold).drop("__llm_score"))
