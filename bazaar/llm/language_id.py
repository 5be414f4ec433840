"""Language identification with a string kernel.

The blended-spectrum presence kernel of two texts counts the 1- to `N`-grams of characters that
both hold, divided by the geometric mean of what each holds. N-grams are hashed
to `DIM` presences. `landmarks` labelled texts span a Nyström approximation of the
kernel; on it a one-versus-rest kernel ridge regression is solved in closed form.
Texts are scored batch by batch: presences times landmark presences, normalised, times one weight matrix.

Fitting reads a bounded sample: about `per_class` texts of a language, at most `train_rows` in all,
drawn by a hash of id and text; what leaves the executors for each is its presence bit map (4 KB),
whatever its length. Every text is read and scored whole.

Defined cases: null text or text without a letter: `und`, score 0; null labels are not
learnt from; with no labelled text every prediction is `und`, score 0; with one language
every text gets it; ties go to the label that sorts first; repeated rows are scored alike; an empty table
gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaar.llm.common import bounded_batches, hash_sample, level_quotas, text_or_empty

N = 3
DIM = 1 << 15
STRETCH = 1 << 20
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)


def presence(text: str) -> np.ndarray:
    """Which of the `DIM` hashed n-grams the lower-cased text holds, as booleans."""
    out = np.zeros(DIM, dtype=bool)
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    shift = np.uint64(64 - DIM.bit_length() + 1)
    for at in range(0, len(codes), STRETCH):
        c = codes[max(0, at - N + 1):at + STRETCH].astype(np.uint64) + np.uint64(1)
        gram = np.zeros(len(c), dtype=np.uint64)
        for n in range(N):
            if n >= len(c):
                break
            gram = (gram[:len(c) - n] + c[n:]) * _MIX[n]
            out[(gram ^ (gram >> np.uint64(29))) * _MIX[0] >> shift] = True
    return out


class Model(NamedTuple):
    labels: list[str]
    landmarks: bytes  # packed presences, DIM bits each
    weights: np.ndarray  # landmarks x labels
    bias: np.ndarray


def _kernel(x: np.ndarray, z: np.ndarray) -> np.ndarray:
    """Normalised presence kernel of the rows of x and z (float32 0/1)."""
    size = np.sqrt(np.maximum(x.sum(axis=1), 1))[:, None] * np.sqrt(np.maximum(z.sum(axis=1), 1))[None, :]
    return (x @ z.T) / size


def _unpack(packed: bytes) -> np.ndarray:
    return np.unpackbits(np.frombuffer(packed, dtype=np.uint8)).reshape(-1, DIM).astype(np.float32)


def fit(packed: list[bytes], labels: list[str], landmarks: int = 64, ridge: float = 1e-3) -> Model | None:
    """Nyström features of the sample and one ridge regression per label, classes weighted alike."""
    names = sorted(set(labels))
    if not names:
        return None
    y = np.array([names.index(v) for v in labels])
    # landmarks: round robin over the labels, in the order given
    nth = pd.Series(y).groupby(y).cumcount().to_numpy()
    chosen = np.lexsort((y, nth))[:landmarks]
    z_bits = b"".join(packed[i] for i in chosen)
    z = _unpack(z_bits)
    k = np.concatenate([_kernel(_unpack(b"".join(packed[i:i + 256])), z) for i in range(0, len(packed), 256)])
    values, vectors = np.linalg.eigh(_kernel(z, z).astype(np.float64))
    keep = values > 1e-6 * values.max()
    to_features = vectors[:, keep] / np.sqrt(values[keep])
    phi = k.astype(np.float64) @ to_features
    target = np.where(y[:, None] == np.arange(len(names)), 1.0, -1.0)
    w = 1.0 / np.bincount(y)[y]
    w /= w.sum()
    mean, bias = w @ phi, w @ target
    centred = phi - mean
    a = (centred * w[:, None]).T @ centred
    solved = np.linalg.solve(a + ridge * np.trace(a) / len(a) * np.eye(len(a)) + 1e-12 * np.eye(len(a)),
                             (centred * w[:, None]).T @ (target - bias))
    return Model(names, z_bits, (to_features @ solved).astype(np.float32),
                 (bias - mean @ solved).astype(np.float32))


def _presences(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        yield pd.DataFrame({"label": b["label"], "draw": b["draw"],
                            "bits": [np.packbits(presence(t)).tobytes() for t in b["text"]]})


def train(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang",
          per_class: int = 400, train_rows: int = 2400, landmarks: int = 64) -> Model | None:
    """Fit on a hash-drawn sample of the rows with `learn` true, a label and a letter in the text."""
    text, draw = text_or_empty(text_col), F.xxhash64(F.col(id_col), text_or_empty(text_col))
    rows = docs.filter(learn & F.col(label_col).isNotNull() & text.rlike(r"\p{L}")).select(
        F.col(label_col).cast("string").alias("label"), draw.alias("draw"), text.alias("text"))
    # a table with more labels than the sample has rows: the most frequent ones are learnt
    counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
              .orderBy(F.desc("n"), "label").limit(train_rows).collect()}
    if not counts:
        return None
    drawn = (hash_sample(rows.select("label", "draw"), "label", "draw", counts,
                         level_quotas(counts, train_rows, per_class))
             .dropDuplicates(["label", "draw"]).orderBy("draw", "label").limit(train_rows))
    # at most train_rows labels and numbers: a bounded broadcast
    sample = rows.join(F.broadcast(drawn), ["label", "draw"]).dropDuplicates(["label", "draw"])
    kept = sample.mapInPandas(_presences, "label string, draw long, bits binary").collect()
    kept.sort(key=lambda r: (r["draw"], r["label"]))
    return fit([bytes(r["bits"]) for r in kept], [r["label"] for r in kept], landmarks)


def predict(docs: DataFrame, model: Model | None, text_col: str = "text", batch: int = 64) -> Column:
    """A column (lang_pred, score) for the text column."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def classify(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = sent.value
        z = _unpack(m.landmarks) if m else None
        for texts in parts:
            pred, score = [], []
            for i in range(0, len(texts) if m else 0, batch):
                some = texts.iloc[i:i + batch]
                x = np.empty((len(some), DIM), dtype=np.float32)
                for r, t in enumerate(some):
                    x[r] = presence(t)
                margin = _kernel(x, z) @ m.weights + m.bias
                best = margin.argmax(axis=1)
                pred += [m.labels[k] for k in best]
                score += list(np.clip((margin[np.arange(len(best)), best] + 1) / 2, 0, 1))
            if not m:
                pred, score = ["und"] * len(texts), [0.0] * len(texts)
            yield pd.DataFrame({"lang_pred": pred, "score": np.array(score, dtype=float)})

    return classify(text_or_empty(text_col))


def identify(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "lang", **sample) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row; learns from the rows that are not held out."""
    bounded_batches(docs.sparkSession, 256)
    model = train(docs, ~held_out, id_col, text_col, label_col, **sample)
    letters = text_or_empty(text_col).rlike(r"\p{L}")
    out = docs.select(F.col(id_col).alias("doc_id"), held_out.alias("held_out"), letters.alias("__llm_letters"),
                      predict(docs, model, text_col).alias("__llm_p"))
    return out.select("doc_id", "held_out",
                      F.when(F.col("__llm_letters"), F.col("__llm_p.lang_pred")).otherwise("und").alias("lang_pred"),
                      F.when(F.col("__llm_letters"), F.col("__llm_p.score")).otherwise(0.0).alias("score"))


def crc_held_out(id_col: str = "doc_id", folds: int = 5) -> Column:
    """True where the CRC-32 of the id's text leaves 0; a null id is never held out."""
    crc = F.crc32(F.col(id_col).cast("string").cast("binary"))
    return F.coalesce(crc % folds == 0, F.lit(False))
