"""Language ID: sparse multinomial logistic regression on TF-IDF character n-grams.

Trained by follow-the-regularised-leader with elastic-net penalties on a bounded sample of labelled rows (PER_LANGUAGE
a language); document frequencies are counted over all training rows; a temperature fitted on a part of the sample
that FTRL did not see calibrates the scores. Only text is an input of a prediction.

The sample and its order come from a hash of the text. Where lang has more than MOST_LANGUAGES values, those of the most
rows are learned (ties: the smaller value), which bounds the model; rows of the others are predicted like all rows.

Letters are lower-cased, all else is one space; n-grams of 1 to 3 characters are hashed into 2**BITS features.

Defined cases: null text or one without a letter is 'und' with score 0; without any labelled row every text is; texts
of any length are taken whole; of languages that tie the first by name is predicted; null ids count as the empty string; an empty table gives an empty result; repeated rows are scored alike; other columns
are ignored.
"""

from __future__ import annotations

import functools
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS, ORDERS = 16, 3
SIZE = 1 << BITS
#: Features of a text that are sorted rather than counted in a table of SIZE; both give the same.
SORTED = 2048
#: Sampled training rows of a language, and the most languages that are learned.
PER_LANGUAGE, MOST_LANGUAGES = 1500, 256
#: FTRL: learning rate, its offset, the L1 and L2 penalties, passes.
ALPHA, BETA, L1, L2, PASSES = 0.5, 1.0, 0.02, 0.01, 3
UNKNOWN = "und"


@functools.lru_cache(1)
def _letters() -> np.ndarray:
    table = np.zeros(0x110000, bool)
    for block in range(0, 0x110000, 0x100):
        if not 0xD800 <= block < 0xE000:
            table[block : block + 0x100] = [chr(c).isalpha() for c in range(block, block + 0x100)]
    return table


def feature_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-gram features of a text and their counts; none without a letter."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), np.uint32)
    letter = _letters()[points]
    if not letter.any():
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    points = np.where(letter, points, 32).astype(np.uint64)
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    points = np.concatenate([[np.uint64(32)], points[keep], [np.uint64(32)]])
    features, h = [], np.zeros(len(points), np.uint64)
    for n in range(ORDERS):
        if len(points) <= n:
            break
        h = (h[: len(points) - n] if n == 0 else h[:-1]) * np.uint64(0x9E3779B97F4A7C15) + points[n:] + np.uint64(n + 1)
        mixed = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        features.append((mixed >> np.uint64(64 - BITS)).astype(np.int64))
    features = np.concatenate(features)
    if len(features) < SORTED:
        ids, counts = np.unique(features, return_counts=True)
    else:
        counts = np.bincount(features, minlength=SIZE)
        ids = np.flatnonzero(counts)
        counts = counts[ids]
    return ids.astype(np.int32), counts.astype(np.int32)


def weigh(ids: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = (1 + np.log(counts)) * idf[ids]
    return x / max(float(np.sqrt(x @ x)), 1e-12)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max())
    return e / e.sum()


class Ftrl:
    """FTRL-proximal with one coordinate for each feature and class."""

    def __init__(self, classes: int, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2):
        self.z, self.n = np.zeros((SIZE, classes)), np.zeros((SIZE, classes))
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, ids=slice(None)) -> np.ndarray:
        z, n = self.z[ids], self.n[ids]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - self.l1, 0)
        return -shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)

    def learn(self, ids: np.ndarray, x: np.ndarray, label: int) -> None:
        w = self.weights(ids)
        error = softmax(x @ w)
        error[label] -= 1
        g = np.outer(x, error)
        n = self.n[ids]
        grown = n + g * g
        self.z[ids] += g - (np.sqrt(grown) - np.sqrt(n)) / self.alpha * w
        self.n[ids] = grown


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least log loss, by golden-section search over its logarithm.

    Labels are smoothed by one error in len(labels) + 1, so that a sample without errors doesn't make scores certain.
    """
    smooth = 1 / (len(labels) + 1)

    def loss(t: float) -> float:
        z = logits / np.exp(t)
        z = z - z.max(axis=1, keepdims=True)
        wanted = (1 - smooth) * z[np.arange(len(z)), labels] + smooth * z.mean(axis=1)
        return float((np.log(np.exp(z).sum(axis=1)) - wanted).mean())

    lo, hi, g = np.log(0.02), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = hi - g * (hi - lo), lo + g * (hi - lo)
        lo, hi = (lo, b) if loss(a) < loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def train(ids: list[np.ndarray], counts: list[np.ndarray], labels: np.ndarray, classes: int, idf: np.ndarray) -> tuple[np.ndarray, float]:
    """(weights, temperature) from feature counts and class numbers, in a fixed pseudo-random order."""
    order = np.random.default_rng(5).permutation(len(labels))
    held = order[: len(order) // 5] if len(order) >= 10 else order[:0]
    learned = order[len(held) :]
    model = Ftrl(classes)
    for _ in range(PASSES):
        for i in learned:
            model.learn(ids[i], weigh(ids[i], counts[i], idf), int(labels[i]))
    w = model.weights()
    if not len(held):
        return w, 1.0
    logits = np.stack([weigh(ids[i], counts[i], idf) @ w[ids[i]] for i in held])
    return w, temperature(logits, labels[held])


def _document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    def count(batches):
        df, n = np.zeros(SIZE, np.int64), 0
        for batch in batches:
            for text in batch.column(0):
                ids, _ = feature_counts(text.as_py())
                df[ids] += 1
                n += len(ids) > 0
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1), pa.int64()), pa.array(np.append(df[at], n), pa.int64())], names=["feature", "df"])

    rows = texts.mapInArrow(count, "feature long, df long").groupBy("feature").agg(F.sum("df").alias("df")).toPandas()  # SIZE rows at most
    df = np.zeros(SIZE + 1)
    df[rows["feature"]] = rows["df"]
    return df[:SIZE], int(df[SIZE])


def held_out(ident: F.Column) -> F.Column:
    return F.crc32(F.coalesce(ident.cast("string"), F.lit(""))) % 5 == 0


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray, np.ndarray, float] | None:
    """(languages, weights, idf, temperature), learned from the labelled rows that are not held out."""
    spark = docs.sparkSession
    rows = docs.where(F.col(lang_col).isNotNull() & ~held_out(F.col(id_col))).select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"), F.xxhash64(text_col).alias("h"))
    most = rows.where(F.col("text").rlike(r"\p{L}")).groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LANGUAGES)
    sizes = sorted((r[0], r[1]) for r in most.collect())
    if not sizes:
        return None
    names = [x for x, _ in sizes]
    df, n = _document_frequencies(rows.select("text"))
    idf = np.log((1 + n) / (1 + df)) + 1
    shares = F.create_map(*[F.lit(x) for name, size in sizes for x in (name, float(min(1.0, PER_LANGUAGE / size)))])
    part = F.pmod(F.col("h"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    sample = rows.where((part < F.coalesce(shares[F.col("lang")], F.lit(0.0))) & F.col("text").rlike(r"\p{L}")).select("h", "lang", "text")

    def count(batches):
        for batch in batches:
            found = [feature_counts(x.as_py()) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([i.tobytes() for i, _ in found], pa.binary()), pa.array([c.tobytes() for _, c in found], pa.binary())], names=["h", "lang", "ids", "counts"])

    def learn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["h", "lang"])
        number = {x: i for i, x in enumerate(names)}
        w, t = train([np.frombuffer(x, np.int32) for x in pdf["ids"]], [np.frombuffer(x, np.int32) for x in pdf["counts"]], pdf["lang"].map(number).to_numpy(), len(names), idf)
        return pd.DataFrame({"weights": [w.astype(np.float32).tobytes()], "temperature": [t]})

    # One task learns: PER_LANGUAGE * MOST_LANGUAGES rows of features at most.
    counted = sample.mapInArrow(count, "h long, lang string, ids binary, counts binary")
    model = counted.groupBy(F.lit(0).alias("one")).applyInPandas(learn, "weights binary, temperature double").first()
    return names, np.frombuffer(model[0], np.float32).reshape(SIZE, len(names)), idf, model[1]


def language_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score: one row for each row of docs."""
    model = fit(docs, id_col, text_col, lang_col)

    def predict(batches):
        for batch in batches:
            langs, scores = [], []
            for text in batch.column(2):
                ids, counts = feature_counts(text.as_py())
                if model is None or not len(ids):
                    langs.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                names, w, idf, t = model
                p = softmax(weigh(ids, counts, idf) @ w[ids] / t)
                best = int(p.argmax())
                langs.append(names[best])
                scores.append(float(p[best]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).try_cast("long").alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).alias("text"))
    return rows.mapInArrow(predict, "doc_id long, held_out boolean, lang_pred string, score double")
