"""Registries of models: voice activity, diarization, transcription and emissions.

A provider is what a factory makes of its options; it loads once a Python worker. A detector gives (start, end, speaker)
rows of one recording's samples, a transcriber TEXT rows of its clips, an emitter the log probabilities of one clip's
frames over its `vocabulary`. The ones that come with the package need no weights; those of public libraries are in
`adapters` and work where the library and its weights are there; others are registered by name.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .operators.clustering import spectral_labels, speakers_wanted
from .operators.intervals import MERGE_THRESHOLD, MIN_DURATION, post_process
from .sources.audio import RATE, cut, decode, mono_at

Rows = list[tuple[float, float, str | None]]
Detector = Callable[..., Rows]


class Registry:
    """Named factories; names don't depend on case, and unknown ones are errors."""

    def __init__(self, kind: str):
        self.kind, self.known = kind, {}

    def register(self, name: str, factory: Callable[..., Detector]) -> None:
        self.known[name.lower()] = factory

    def create(self, name: str, **options) -> Detector:
        if name.lower() not in self.known:
            raise ValueError(f"unknown {self.kind} method {name!r}; known: {', '.join(sorted(self.known))}")
        return self.known[name.lower()](**options)


VAD, DIARIZATION = Registry("VAD"), Registry("diarization")
TRANSCRIPTION, EMISSION = Registry("transcription"), Registry("emission")
WORDS = "array<struct<word:string,start:double,end:double,probability:double>>"
TEXT = f"ord long, start double, end double, text string, avg_logprob double, compression_ratio double, no_speech_prob double, words {WORDS}, language string, language_probability double"


def merged(options: dict | None, overrides: dict | None) -> dict:
    """Nested options, with those of overrides in place of theirs."""
    out = dict(options or {})
    for k, v in (overrides or {}).items():
        out[k] = merged(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out


def device(requested: str) -> str:
    """The device asked for, or cpu where that is cuda and there is none."""
    if requested != "cuda":
        return requested
    try:
        import torch

        return "cuda" if torch.cuda.is_available() else "cpu"
    except Exception:  # a library that can't load has no device either
        return "cpu"


def energy_vad(frame: float = 0.02, level: float = 0.02) -> Detector:
    """Frames whose root mean square is at least level, as segments without a speaker."""

    def detect(samples: np.ndarray, rate: int = RATE, **_) -> Rows:
        step = max(1, int(frame * rate))
        n = len(samples) // step
        frames, loud = samples[: n * step].reshape(n, step), np.zeros(n, bool)
        for a in range(0, n, 512):  # squares that stay in the processor's memory
            loud[a : a + 512] = np.sqrt((frames[a : a + 512] ** 2).mean(axis=1)) >= level
        edge = np.flatnonzero(np.diff(np.r_[False, loud, False].astype(np.int8)))
        return [(a * step / rate, b * step / rate, None) for a, b in zip(edge[::2], edge[1::2])]

    return detect


def band_diarization(window: float = 1.5, hop: float = 0.75, bands: int = 16, need_speech: bool = False, **vad) -> Detector:
    """Windows of loud audio, clustered by the shares of their spectrum's bands.

    Without speech there are no rows, so that a silent recording doesn't stop the others; need_speech makes it an error.
    """
    active = energy_vad(**vad)

    def detect(samples: np.ndarray, rate: int = RATE, num_speakers=None, min_speakers=None, max_speakers=None, **_) -> Rows:
        spans, found = [], []
        for start, end, _ in active(samples, rate):
            t = start
            while t + window <= end + 1e-6:
                part = np.abs(np.fft.rfft(samples[int(round(t * rate)) : int(round((t + window) * rate))]))
                found.append([x.mean() for x in np.array_split(part, bands)])
                spans.append((t, t + window))
                t += hop
        if need_speech and not spans:
            raise RuntimeError("no speech was detected")
        if len(found) < 2:
            return [(a, b, "spk0") for a, b in spans]
        labels = spectral_labels(np.asarray(found), speakers_wanted(num_speakers, min_speakers, max_speakers))
        return [(a, b, f"spk{i}") for (a, b), i in zip(spans, labels)]

    return detect


VAD.register("energy", energy_vad)
DIARIZATION.register("bands", band_diarization)


_loaded: dict[str, object] = {}


def _provider(kind: str, factory: Callable[..., object], options: dict):
    """The provider of these options in this process, made at its first use."""
    key = f"{kind}/{factory.__module__}.{factory.__qualname__}/{sorted(options.items(), key=str)}"
    if key not in _loaded:
        _loaded[key] = factory(**options)
    return _loaded[key]


def provider(registry: Registry, method: str, options: dict | None = None):
    """The provider of a method; an unknown name or option is an error at once."""
    if method.lower() not in registry.known:
        return registry.create(method)
    return _provider(registry.kind, registry.known[method.lower()], options or {})


def _detect(audio: DataFrame, registry: Registry, method: str, params: dict | None, **call) -> DataFrame:
    options = dict(params or {})
    call = merged({k: v for k, v in call.items() if v is not None}, options.pop("pipeline_params", None))
    registry.create(method, **options)
    kind, factory = registry.kind, registry.known[method.lower()]

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        detect = _provider(kind, factory, options)
        for pdf in batches:
            for name, content in zip(pdf["recording_id"], pdf["content"]):
                x, rate, _ = decode(content)
                rows = sorted(detect(mono_at(x, rate), RATE, **call), key=lambda r: r[0])
                yield pd.DataFrame([(name, i, *r) for i, r in enumerate(rows)], columns=["recording_id", "ord", "start", "end", "speaker"])

    return audio.select("recording_id", "content").mapInPandas(work, "recording_id string, ord long, start double, end double, speaker string")


def detect_speech(audio: DataFrame, method: str = "energy", params: dict | None = None, least: float = MIN_DURATION, threshold: float = MERGE_THRESHOLD) -> DataFrame:
    """Speech segments of each recording: merged, filtered and split."""
    return post_process(_detect(audio, VAD, method, params), least, threshold)


def diarize(audio: DataFrame, method: str = "bands", params: dict | None = None, num_speakers: int | None = None, min_speakers: int | None = None, max_speakers: int | None = None) -> DataFrame:
    """Speaker turns of each recording."""
    return _detect(audio, DIARIZATION, method, params, num_speakers=num_speakers, min_speakers=min_speakers, max_speakers=max_speakers)


def _with_clips(audio: DataFrame, clips: DataFrame) -> DataFrame:
    """recording_id, content, clips (ord, start, end) in order."""
    of = clips.groupBy("recording_id").agg(F.sort_array(F.collect_list(F.struct("ord", "start", "end"))).alias("clips"))
    return audio.select("recording_id", "content").join(of, "recording_id")


def transcribe(audio: DataFrame, clips: DataFrame | None, method: str, params: dict | None = None, **call) -> DataFrame:
    """recording_id and TEXT: the segments that a transcriber hears in the clips of each recording, or in all of it.

    A transcriber(samples, rate, clips, **call) gives dicts; what they lack is null. ord numbers them by recording.
    """
    provider(TRANSCRIPTION, method, params)
    factory, options = TRANSCRIPTION.known[method.lower()], dict(params or {})
    call = {k: v for k, v in call.items() if v is not None}
    whole = F.array().cast("array<struct<ord:bigint,start:double,end:double>>")
    rows = _with_clips(audio, clips) if clips is not None else audio.select("recording_id", "content", whole.alias("clips"))
    names = [x.split()[0] for x in "recording_id x, ord x, start x, end x, text x, avg_logprob x, compression_ratio x, no_speech_prob x, words x, language x, language_probability x".split(", ")]

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hear = _provider("transcription", factory, options)
        for pdf in batches:
            for name, content, own in zip(pdf["recording_id"], pdf["content"], pdf["clips"]):
                x, rate, _ = decode(content)
                spans = [(c["start"], c["end"]) for c in own]
                found = hear(mono_at(x, rate), RATE, spans or None, **call)
                yield pd.DataFrame([{"recording_id": name, "ord": i} | r for i, r in enumerate(found)], columns=names)

    return rows.mapInPandas(work, f"recording_id string, {TEXT}")


def emissions(audio: DataFrame, segments: DataFrame, method: str, params: dict | None = None) -> DataFrame:
    """recording_id, ord, emission (frames by vocabulary) of each segment; clips too short for a model are padded."""
    provider(EMISSION, method, params)
    factory, options = EMISSION.known[method.lower()], dict(params or {})

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        emit = _provider("emission", factory, options)
        for pdf in batches:
            for name, content, own in zip(pdf["recording_id"], pdf["content"], pdf["clips"]):
                x, rate, _ = decode(content)
                x = mono_at(x, rate)
                for c in own:
                    if c["start"] * RATE < len(x):
                        samples, n = cut(x, c["start"], c["end"])
                        yield pd.DataFrame({"recording_id": [name], "ord": [c["ord"]], "emission": [[list(map(float, f)) for f in emit(samples, n)]]})

    return _with_clips(audio, segments).mapInPandas(work, "recording_id string, ord long, emission array<array<double>>")


def _register_adapters() -> None:
    from . import adapters

    for registry, methods in ((VAD, adapters.VAD), (DIARIZATION, adapters.DIARIZATION), (TRANSCRIPTION, adapters.TRANSCRIPTION), (EMISSION, adapters.EMISSION)):
        for name, factory in methods.items():
            registry.register(name, factory)


_register_adapters()
