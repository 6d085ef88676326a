"""Providers over public libraries, each imported when the provider is made.

Their weights come from where the library has them; none is part of this package, so these run only where they are.
"""

from __future__ import annotations

import os
import tempfile

import numpy as np

from .operators.clustering import spectral_labels, speakers_wanted
from .sources.audio import RATE, encode_wav


def _device(requested: str) -> str:
    from .providers import device

    return device(requested)


def _tensor(samples: np.ndarray):
    import torch

    return torch.from_numpy(np.ascontiguousarray(samples, np.float32))


def _in_file(samples: np.ndarray, rate: int, use):
    """use(path) of a WAV file that this process alone reads, and that goes at once."""
    with tempfile.TemporaryDirectory() as folder:
        path = os.path.join(folder, "audio.wav")
        with open(path, "wb") as f:
            f.write(encode_wav(samples, rate))
        return use(path)


# ------------------------------------------------------------ voice activity


def pyannote_vad(vad_model: str = "pyannote/voice-activity-detection", hf_token: str | None = None, device: str = "cpu", **params):
    from pyannote.audio import Pipeline

    pipeline = Pipeline.from_pretrained(vad_model, token=hf_token)
    if params:
        pipeline.instantiate(params)

    def detect(samples, rate=RATE, **_):
        found = pipeline({"waveform": _tensor(samples)[None, :], "sample_rate": rate})
        return [(x.start, x.end, None) for x in found.get_timeline().support()]

    return detect


def silero_vad(device: str = "cpu", hf_token: str | None = None, **params):
    from silero_vad import get_speech_timestamps, load_silero_vad

    model = load_silero_vad()

    def detect(samples, rate=RATE, **_):
        return [(x["start"] / rate, x["end"] / rate, None) for x in get_speech_timestamps(_tensor(samples), model, sampling_rate=rate, **params)]

    return detect


def _speechbrain_speech(vad_model, vad_savedir, device):
    from speechbrain.inference.VAD import VAD

    return VAD.from_hparams(source=vad_model, savedir=vad_savedir, run_opts={"device": _device(device)})


#: Public models and thresholds of this method.
_SPEECHBRAIN = {"activation_th": 0.5, "deactivation_th": 0.25, "len_th": 0.2, "close_th": 0.2}
_SPEECHBRAIN_VAD, _SPEECHBRAIN_SPEAKERS = "speechbrain/vad-crdnn-libriparty", "speechbrain/spkrec-ecapa-voxceleb"


def speechbrain_vad(vad_model: str = _SPEECHBRAIN_VAD, vad_savedir: str = "pretrained_sb_vad", device: str = "cpu", hf_token: str | None = None, **params):
    model, thresholds = _speechbrain_speech(vad_model, vad_savedir, device), _SPEECHBRAIN | params

    def detect(samples, rate=RATE, **_):
        return [(float(a), float(b), None) for a, b in _in_file(samples, rate, lambda path: model.get_speech_segments(path, **thresholds))]

    return detect


# ----------------------------------------------------------------- diarization


def pyannote_diarization(model: str = "pyannote/speaker-diarization-community-1", hf_token: str | None = None, device: str = "cpu"):
    import torch
    from pyannote.audio import Pipeline

    pipeline = Pipeline.from_pretrained(model, token=hf_token)
    pipeline.to(torch.device(_device(device)))

    def detect(samples, rate=RATE, **call):
        found = pipeline({"waveform": _tensor(samples)[None, :], "sample_rate": rate}, **call)
        return [(turn.start, turn.end, speaker) for turn, _, speaker in getattr(found, "speaker_diarization", found).itertracks(yield_label=True)]

    return detect


def speechbrain_diarization(vad_model: str = _SPEECHBRAIN_VAD, vad_savedir: str = "pretrained_sb_vad", speaker_model: str = _SPEECHBRAIN_SPEAKERS, speaker_savedir: str = "pretrained_sb_spk", window: float = 1.5, hop: float = 0.75, device: str = "cpu", hf_token: str | None = None, need_speech: bool = False, **params):
    """Speech, an embedding of each window of it, and their clusters; need_speech makes a silent recording an error."""
    from speechbrain.inference.speaker import EncoderClassifier

    active = speechbrain_vad(vad_model, vad_savedir, device, **params)
    encoder = EncoderClassifier.from_hparams(source=speaker_model, savedir=speaker_savedir, run_opts={"device": _device(device)})

    def detect(samples, rate=RATE, num_speakers=None, min_speakers=None, max_speakers=None, **_):
        spans = []
        for start, end, _ in active(samples, rate):
            n = int((end - start + 1e-6 - window) // hop) + 1 if end - start + 1e-6 >= window else 0
            spans += [(start + hop * k, start + hop * k + window) for k in range(n)]
        if len(spans) < 2:
            if need_speech:
                raise RuntimeError("no speech was detected, or too little of it")
            return [(a, b, "spk0") for a, b in spans]
        parts = [encoder.encode_batch(_tensor(samples[int(a * rate) : int(b * rate)])[None, :]).squeeze().detach().cpu().numpy() for a, b in spans]
        labels = spectral_labels(np.asarray(parts, float), speakers_wanted(num_speakers, min_speakers, max_speakers))
        return [(a, b, f"spk{i}") for (a, b), i in zip(spans, labels)]

    return detect


# --------------------------------------------------- transcription and emissions


def whisper(model: str = "large-v3", device: str = "cpu", compute_type: str = "float32", batch_size: int | None = None):
    """Speech to text; with a batch size the clips are transcribed in batches."""
    from faster_whisper import BatchedInferencePipeline, WhisperModel

    base = WhisperModel(model, device=_device(device), compute_type=compute_type)
    used = BatchedInferencePipeline(model=base) if batch_size else base

    def hear(samples, rate=RATE, clips=None, **call):
        if batch_size:
            call |= {"batch_size": batch_size}
        if clips:
            call["clip_timestamps"] = [{"start": a, "end": b} for a, b in clips] if batch_size else [x for clip in clips for x in clip]
        else:
            call["vad_filter"] = False
        found, info = used.transcribe(np.asarray(samples, np.float32), **call)
        for x in found:
            words = [{"word": w.word, "start": w.start, "end": w.end, "probability": w.probability} for w in x.words or ()]
            yield {"start": x.start, "end": x.end, "text": x.text, "avg_logprob": x.avg_logprob, "compression_ratio": x.compression_ratio, "no_speech_prob": x.no_speech_prob, "words": words or None, "language": info.language, "language_probability": info.language_probability}

    return hear


class _Emitter:
    def __init__(self, vocabulary: dict[str, int], emit):
        self.vocabulary, self.emit = vocabulary, emit

    def __call__(self, samples: np.ndarray, n: int):
        return self.emit(samples, n)


def wav2vec2(language: str | None = None, model: str | None = None, device: str = "cpu"):
    """Log probabilities of a public alignment model, by its language or its name."""
    import torch

    from .sources.models import HUB, TORCH

    name, where = model or TORCH.get(language) or HUB.get(language), _device(device)
    if name is None:
        raise ValueError(f"no alignment model for {language}")
    if name in TORCH.values() or name.isupper():
        import torchaudio

        bundle = getattr(torchaudio.pipelines, name)
        net, vocabulary = bundle.get_model().to(where).eval(), {x.lower(): i for i, x in enumerate(bundle.get_labels())}
        run = lambda x, n: net(x, lengths=n)[0]
    else:
        from transformers import Wav2Vec2ForCTC, Wav2Vec2Processor

        net = Wav2Vec2ForCTC.from_pretrained(name).to(where).eval()
        vocabulary = {x.lower(): i for x, i in Wav2Vec2Processor.from_pretrained(name).tokenizer.get_vocab().items()}
        run = lambda x, n: net(x).logits

    def emit(samples, n):
        with torch.inference_mode():
            lengths = torch.as_tensor([n], device=where) if n < len(samples) else None
            return torch.log_softmax(run(_tensor(samples)[None, :].to(where), lengths), dim=-1)[0].cpu().numpy()

    return _Emitter(vocabulary, emit)


VAD = {"pyannote": pyannote_vad, "silero": silero_vad, "speechbrain": speechbrain_vad}
DIARIZATION = {"pyannote": pyannote_diarization, "speechbrain": speechbrain_diarization}
TRANSCRIPTION = {"whisper": whisper}
EMISSION = {"wav2vec2": wav2vec2}
