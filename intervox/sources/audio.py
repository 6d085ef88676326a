"""Audio: decoding in Arrow batches, by signature, and what decides whether a file must be normalised.

PCM WAV, also compressed as a whole by Zstandard, needs no library; other formats are decoded by what is registered for
them, or by a public library that is there.
"""

from __future__ import annotations

import importlib
import io
import wave
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import path_stem, path_suffix

RATE = 16000
#: Samples of one output row: recordings are many rows, never one unbounded array.
PIECE = RATE * 30


def decode_wav(content: bytes) -> tuple[np.ndarray, int, int]:
    """(samples [frames, channels] in -1 to 1, rate, channels) of PCM WAV bytes."""
    with wave.open(io.BytesIO(content)) as f:
        rate, channels, width = f.getframerate(), f.getnchannels(), f.getsampwidth()
        raw = f.readframes(f.getnframes())
    if width == 1:
        x = (np.frombuffer(raw, np.uint8).astype(np.float32) - 128) / 128
    elif width == 3:
        b = np.frombuffer(raw, np.uint8).reshape(-1, 3).astype(np.int32)
        x = ((b[:, 0] | b[:, 1] << 8 | b[:, 2] << 16) ^ 0x800000).astype(np.float32) / 0x800000 - 1
    else:
        x = np.frombuffer(raw, {2: "<i2", 4: "<i4"}[width]).astype(np.float32) / float(1 << (8 * width - 1))
    return x.reshape(-1, channels), rate, channels


def _by_library(content: bytes) -> tuple[np.ndarray, int, int]:
    """Any format that a public decoding library on this machine takes."""
    for name in ("soundfile", "torchaudio"):
        try:
            library = importlib.import_module(name)
        except ImportError:
            continue
        if name == "soundfile":
            x, rate = library.read(io.BytesIO(content), dtype="float32", always_2d=True)
        else:
            x, rate = library.load(io.BytesIO(content))
            x = x.numpy().T
        return x, rate, x.shape[1]
    raise ValueError("not PCM WAV, and no decoder is registered or installed for it")


def compressed(content: bytes) -> bytes:
    """A file's bytes in a Zstandard frame: sound that repeats or is silent crosses processes as a small part of its bytes."""
    return pa.compress(content, codec="zstd", asbytes=True)


def _of_compressed(content: bytes) -> tuple[np.ndarray, int, int]:
    with pa.CompressedInputStream(pa.BufferReader(content), "zstd") as f:
        return decode(f.read())


Decoder = Callable[[bytes], tuple[np.ndarray, int, int]]
#: Decoders by the bytes that a format's files begin with; the longest that fits is used.
DECODERS: dict[bytes, Decoder] = {b"RIFF": decode_wav, b"\x28\xb5\x2f\xfd": _of_compressed, b"": _by_library}


def decode(content: bytes) -> tuple[np.ndarray, int, int]:
    """(samples [frames, channels] in -1 to 1, rate, channels) of a file's bytes."""
    return DECODERS[max((x for x in DECODERS if content.startswith(x)), key=len)](content)


def header(content: bytes) -> tuple[int, int, float]:
    """(rate, channels, seconds); of PCM WAV without decoding its samples."""
    if DECODERS[max((x for x in DECODERS if content.startswith(x)), key=len)] is decode_wav:
        with wave.open(io.BytesIO(content)) as f:
            return f.getframerate(), f.getnchannels(), f.getnframes() / f.getframerate()
    x, rate, channels = decode(content)
    return rate, channels, len(x) / rate


def from_arrays(rows: DataFrame, rate: int = RATE) -> DataFrame:
    """recording_id, content of recordings that are arrays already: recording_id, samples (array, or array of channels)."""
    nested = dict(rows.dtypes)["samples"].startswith("array<array")

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            mono = [np.mean([np.asarray(c, np.float32) for c in x], axis=0) if nested else np.asarray(x, np.float32) for x in pdf["samples"]]
            yield pd.DataFrame({"recording_id": pdf["recording_id"], "content": [encode_wav(x, rate) for x in mono]})

    return rows.select(F.col("recording_id").cast("string").alias("recording_id"), "samples").mapInPandas(work, "recording_id string, content binary")


def pcm(samples: np.ndarray) -> bytes:
    """16-bit little-endian bytes of samples in -1 to 1."""
    return (np.clip(samples, -1, 1) * 32767).astype("<i2").tobytes()


def encode_wav(samples: np.ndarray | bytes, rate: int = RATE) -> bytes:
    """16-bit mono PCM WAV bytes of samples in -1 to 1, or of their bytes by pcm."""
    out = io.BytesIO()
    with wave.open(out, "wb") as f:
        f.setnchannels(1)
        f.setsampwidth(2)
        f.setframerate(rate)
        f.writeframes(samples if isinstance(samples, bytes) else pcm(samples))
    return out.getvalue()


def mono_at(samples: np.ndarray, rate: int, wanted: int = RATE) -> np.ndarray:
    """The channels' mean, resampled linearly where the rate differs; to a lower rate after a windowed-sinc low-pass."""
    mono = samples[:, 0] if samples.shape[1] == 1 else samples.mean(axis=1)
    if rate == wanted or not len(mono):
        return mono
    if wanted < rate:
        half = 16 * -(-rate // wanted)
        at = np.arange(-half, half + 1)
        taps = np.sinc(at * 0.9 * wanted / rate) * np.hanning(len(at) + 2)[1:-1]
        mono = np.convolve(np.pad(mono, half, mode="edge"), taps / taps.sum(), mode="valid")
    n = int(round(len(mono) * wanted / rate))
    return np.interp(np.arange(n) * rate / wanted, np.arange(len(mono)), mono).astype(np.float32)


def read_audio(spark: SparkSession, path: str, glob: str | None = "*.wav") -> DataFrame:
    """recording_id (the path), content."""
    files = spark.read.format("binaryFile")
    files = (files.option("pathGlobFilter", glob) if glob else files).load(path)
    return files.select(F.col("path").alias("recording_id"), "content")


def probe(audio: DataFrame) -> DataFrame:
    """recording_id, stem, rate, channels, duration (seconds), needs_normalising."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [header(x) for x in pdf["content"]]
            yield pd.DataFrame({"recording_id": pdf["recording_id"], "rate": [x[0] for x in found], "channels": [x[1] for x in found], "duration": [x[2] for x in found]})

    rows = audio.select("recording_id", "content").mapInPandas(work, "recording_id string, rate int, channels int, duration double")
    odd = (F.col("rate") != RATE) | (F.col("channels") != 1) | (F.lower(path_suffix(F.col("recording_id"))) != ".wav")
    return rows.select("recording_id", path_stem(F.col("recording_id")).alias("stem"), "rate", "channels", "duration", odd.alias("needs_normalising"))


def load_mono(audio: DataFrame, rate: int = RATE, piece: int = PIECE) -> DataFrame:
    """recording_id, piece, samples (array<float>): mono at the rate, in pieces of bounded length."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for name, content in zip(pdf["recording_id"], pdf["content"]):
                x, own, _ = decode(content)
                x = mono_at(x, own, rate)
                for k in range(0, max(len(x), 1), piece):
                    yield pd.DataFrame({"recording_id": [name], "piece": [k // piece], "samples": [x[k : k + piece]]})

    return audio.select("recording_id", "content").mapInPandas(work, "recording_id string, piece int, samples array<float>")


def normalise(audio: DataFrame, rate: int = RATE) -> DataFrame:
    """recording_id, content: mono WAV bytes at the rate; bytes that are so already stay as they are."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for content in pdf["content"]:
                x, own, channels = decode(content)
                out.append(content if own == rate and channels == 1 and content[:4] == b"RIFF" else encode_wav(mono_at(x, own, rate), rate))
            yield pd.DataFrame({"recording_id": pdf["recording_id"], "content": out})

    return audio.select("recording_id", "content").mapInPandas(work, "recording_id string, content binary")


def cut(samples: np.ndarray, start: float, end: float, rate: int = RATE, least: int = 400) -> tuple[np.ndarray, int]:
    """The samples of a segment, padded with zeros to `least`, and their true number."""
    x = samples[int(start * rate) : int(end * rate)]
    return np.pad(x, (0, max(0, least - len(x)))), len(x)
