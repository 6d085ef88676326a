"""Speaker clustering of window embeddings: spectral clustering of each recording, in NumPy."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_SPEAKERS, MAX_SPEAKERS, KEPT_SHARE = 2, 10, 0.30
#: Windows of one recording whose similarities are held at once; those of a longer one are made anew, in blocks of
#: rows, for each step of an eigensolver. Either way all windows are clustered.
MOST_WINDOWS = 4000
#: Similarities of one block of rows; residual, relative to the largest degree, at which an eigenvector is found;
#: most vectors that the eigensolver holds.
BLOCK, PRECISION, BASIS = 4_000_000, 1e-9, 240


def speakers_wanted(number: int | None = None, least: int | None = None, most: int | None = None) -> int:
    """The given number, else the least number of speakers within the bounds."""
    least, most = least if least is not None else MIN_SPEAKERS, most if most is not None else MAX_SPEAKERS
    return number if number is not None else min(most, max(least, 2))


def _k_means(x: np.ndarray, k: int, rounds: int = 50) -> np.ndarray:
    """Labels by Lloyd's method from farthest-point starts, so that reruns agree."""
    chosen = [int(np.argmax((x**2).sum(axis=1)))]
    while len(chosen) < k:
        far = np.min([((x - x[c]) ** 2).sum(axis=1) for c in chosen], axis=0)
        chosen.append(int(far.argmax()))
    centres = x[chosen]
    labels = np.zeros(len(x), int)
    for _ in range(rounds):
        new = ((x[:, None, :] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
        centres = np.stack([x[new == c].mean(axis=0) if (new == c).any() else centres[c] for c in range(k)])
        if (new == labels).all():
            break
        labels = new
    return labels


def spectral_labels(x: np.ndarray, k: int, kept: float = KEPT_SHARE) -> np.ndarray:
    """Cluster numbers in order of first appearance, from the unnormalised Laplacian of pruned cosine similarities."""
    unit = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    n = len(x)
    dropped = min(max(int(n * (1 - kept)), 0), n - min(n, 6))
    vectors = _held(unit, dropped) if n <= MOST_WINDOWS else _smallest(*_blocked(unit, dropped), min(k, n))
    labels = _k_means(vectors[:, : min(k, n)], min(k, n))
    _, first, inverse = np.unique(labels, return_index=True, return_inverse=True)
    return np.argsort(np.argsort(first))[inverse]


def _held(unit: np.ndarray, dropped: int) -> np.ndarray:
    """Eigenvectors of the Laplacian, those of the smallest eigenvalues first, from the whole matrix."""
    similar = unit @ unit.T
    if dropped:
        low = np.argsort(similar, axis=1, kind="stable")[:, :dropped]
        np.put_along_axis(similar, low, 0.0, axis=1)
    similar = (similar + similar.T) / 2
    np.fill_diagonal(similar, 0)
    weights = np.abs(similar)
    return np.linalg.eigh(np.diag(weights.sum(axis=1)) - similar)[1]


def _blocked(unit: np.ndarray, dropped: int):
    """(product of the Laplacian of _held with vectors, degrees), with a block of similarities in memory at a time."""
    if not np.isfinite(unit).all():
        raise np.linalg.LinAlgError("embeddings are not finite")
    n, rows = len(unit), max(1, BLOCK // len(unit))
    # A row drops what is below its bound, and of what equals it the columns to its last one: the first of stable order.
    bound, last, degrees = np.full(n, -np.inf), np.full(n, -1), np.zeros(n)

    def pruned(a: int) -> np.ndarray:
        own = slice(a, min(a + rows, n))
        s = unit[own] @ unit.T
        if dropped and np.isneginf(bound[a]):
            bound[own] = np.partition(s, dropped - 1, axis=1)[:, dropped - 1]
            equal = s == bound[own, None]
            left = dropped - (s < bound[own, None]).sum(axis=1)
            last[own] = (np.cumsum(equal, axis=1, dtype=np.int32) >= left[:, None]).argmax(axis=1)
        out = s < bound[own, None]
        tie, column = np.nonzero(s == bound[own, None])
        gone = column <= last[own][tie]
        out[tie[gone], column[gone]] = True
        s[out] = 0
        s[np.arange(len(s)), np.arange(own.start, own.stop)] = 0
        return s

    for a in range(0, n, rows):
        weights = np.abs(pruned(a))
        degrees[a : a + rows] += weights.sum(axis=1) / 2
        degrees += weights.sum(axis=0) / 2

    def product(v: np.ndarray) -> np.ndarray:
        out = degrees[:, None] * v
        for a in range(0, n, rows):
            s = pruned(a)
            out[a : a + rows] -= s @ v / 2
            out -= s.T @ v[a : a + rows] / 2
        return out

    return product, degrees


def _smallest(product, degrees: np.ndarray, k: int) -> np.ndarray:
    """The k eigenvectors of the smallest eigenvalues, by block Lanczos with full orthogonalisation and restarts.

    Blocks are wider than k, so that equal eigenvalues (parts without links between them) are all found.
    """
    n, wide = len(degrees), min(k + 3, len(degrees))
    basis, image = np.zeros((n, 0)), np.zeros((n, 0))
    block, scale = np.random.default_rng(0).standard_normal((n, wide)), max(float(degrees.max()), 1e-12)
    while True:
        for _ in range(2):
            block = np.linalg.qr(block - basis @ (basis.T @ block))[0]
        basis, image = np.hstack([basis, block]), np.hstack([image, product(block)])
        inner = basis.T @ image
        values, turn = np.linalg.eigh((inner + inner.T) / 2)
        vectors, moved = basis @ turn[:, :k], image @ turn[:, :k]
        if np.linalg.norm(moved - vectors * values[:k], axis=0).max() <= PRECISION * scale or basis.shape[1] + wide > n:
            return vectors
        block = image[:, -wide:]
        if basis.shape[1] + wide > max(BASIS, 8 * wide):
            low = turn[:, : 4 * wide]
            block, basis, image = block - basis @ (basis.T @ block), basis @ low, image @ low


def cluster_speakers(windows: DataFrame, number: int | None = None, least: int | None = None, most: int | None = None, strict: bool = False) -> DataFrame:
    """recording_id, ord, speaker ("spk<n>") of windows (recording_id, ord, embedding).

    A recording of fewer windows than speakers at least has one speaker, so that it doesn't stop the others; strict
    makes it an error.
    """
    k, enough = speakers_wanted(number, least, most), max(2, least if least is not None else MIN_SPEAKERS)

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ord")
        if len(pdf) < enough:
            if strict:
                raise ValueError(f"{len(pdf)} windows are too few to cluster")
            return pd.DataFrame({"recording_id": pdf["recording_id"], "ord": pdf["ord"], "speaker": ["spk0"] * len(pdf)})
        x = np.stack([np.asarray(v, float) for v in pdf["embedding"]])
        labels = spectral_labels(x, k)
        return pd.DataFrame({"recording_id": pdf["recording_id"], "ord": pdf["ord"], "speaker": [f"spk{i}" for i in labels]})

    kind = dict(windows.dtypes)["recording_id"]
    return windows.select("recording_id", F.col("ord").cast("long").alias("ord"), "embedding").groupBy("recording_id").applyInPandas(work, f"recording_id {kind}, ord long, speaker string")
