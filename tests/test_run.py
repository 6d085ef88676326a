"""Whole runs, from audio to subtitles, logs and results, with a transcriber and emissions that read what the audio says.

A sign is 20 ms at a level of its own and 20 ms of silence, so that speech, text and times are known.
"""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from intervox import cli, providers
from intervox.plans import canonical, transcription
from intervox.plans.transcription import Config
from intervox.sources import audio

SIGNS = canonical.VOCABULARY
STEP = 320


def say(text):
    """Samples of a text: two frames a sign."""
    ids = np.asarray([SIGNS[x.replace(" ", "|")] for x in text])
    return np.stack([(ids + 1) / 40, np.zeros(len(ids))], axis=1).repeat(STEP, axis=1).reshape(-1)


def fakes():
    """Factories of a transcriber and an emitter; closures, so that workers get them whole."""
    signs, step = dict(SIGNS), STEP

    def levels(samples):
        n = len(samples) // step
        return np.round(samples[: n * step].reshape(n, step).mean(axis=1) * 40).astype(int) - 1

    def transcriber():
        of = {i: x.replace("|", " ") for x, i in signs.items()}

        def hear(samples, rate, clips=None, language=None, **call):
            for a, b in clips or [(0.0, len(samples) / rate)]:
                found = levels(samples[int(round(a * rate)) : int(round(b * rate))])
                text = "".join(of[x] for x in found if x >= 0)
                yield {"start": a, "end": b, "text": f" {text} ", "avg_logprob": -0.5, "language": language or "en", "words": [{"word": text, "start": a, "end": b, "probability": 0.9}]}

        return hear

    def emitter(language=None):
        class Emit:
            vocabulary = signs

            def __call__(self, samples, n):
                found = levels(samples)
                out = np.full((len(found) + 1, len(signs)), -6.0)
                out[np.arange(len(found)), np.maximum(found, 0)] = -0.1
                out[-1, 0] = -0.1
                return out

        return Emit()

    def diarizer():
        return lambda samples, rate, **call: [(0.0, 2.5, "spk0"), (2.5, len(samples) / rate, "spk1")]

    return transcriber, emitter, diarizer


@pytest.fixture
def said(tmp_path, monkeypatch):
    """A folder with two recordings; a fake transcriber and emitter are registered."""
    transcriber, emitter, diarizer = fakes()
    monkeypatch.setitem(providers.DIARIZATION.known, "fake", diarizer)
    monkeypatch.setitem(providers.TRANSCRIPTION.known, "fake", transcriber)
    monkeypatch.setitem(providers.EMISSION.known, "fake", emitter)
    folder = tmp_path / "audio"
    folder.mkdir()
    gap = np.zeros(16000)
    for name, parts in (("one", ["the first words of all", "some more of them here"]), ("two", ["another recording"])):
        whole = np.concatenate([x for p in parts for x in (gap, say(p))] + [gap])
        (folder / f"{name}.wav").write_bytes(audio.encode_wav(whole))
    return folder


CONFIG = Config(transcription_method="fake", emission_method="fake", language="en", use_diarization=True, diarization_method="fake")


def test_run_files(spark, said, tmp_path):
    rows = transcription.run_files(spark, str(said), str(tmp_path / "out"), CONFIG).collect()
    got = {r["recording_id"].rsplit("/", 1)[1]: r for r in rows}
    assert sorted(got) == ["one.wav", "two.wav"]
    one = got["one.wav"]
    assert [s["text"] for s in one["final_segments"]] == ["the first words of all", "some more of them here"]
    assert [w["word"] for w in one["final_segments"][0]["words"]] == ["the", "first", "words", "of", "all"]
    for s in one["final_segments"]:
        times = [x for w in s["words"] for x in (w["start"], w["end"])]
        assert times == sorted(times) and s["start"] <= times[0] and times[-1] <= s["end"] + 0.05 and s["speaker"] == ("spk0" if s["start"] < 2 else "spk1")
        # A word of n letters lasts 40 ms a letter, within a frame or two of the emissions.
        assert all(abs(w["end"] - w["start"] - 0.04 * len(w["word"])) < 0.08 for w in s["words"])
    assert one["language"] == "en" and one["vad_diarization"]["num_speakers"] >= 1 and len(one["vad_diarization"]["segments"]) == 2
    assert "[spk" in one["srt_content"] and "another recording" in got["two.wav"]["srt_content"]
    assert json.loads(one["config"])["emission_method"] == "fake" and "hf_token" not in json.loads(one["config"])
    assert {x.name for x in (tmp_path / "out").iterdir()} == {"srt", "logs", "results"}
    logs = {x.name for run in (tmp_path / "out" / "logs").iterdir() for x in run.iterdir()}
    assert logs == {"transcription", "vad_diarization", "alignment", "speaker_alignment"}


def test_alignment_can_be_off_and_words_stay(spark, said):
    segments, _ = transcription.transcribe_files(spark, str(said), None, Config(transcription_method="fake", use_alignment=False, use_vad=False))
    rows = segments.collect()
    assert len(rows) == 2 and all(r["words"][0]["probability"] == 0.9 and r["words"][0]["word"] == r["text"] for r in rows)
    segments, _ = transcription.transcribe_files(spark, str(said), None, Config(transcription_method="fake", use_alignment=False, word_timestamps=False))
    assert "words" not in segments.columns


def test_languages_without_a_model_stay_as_they_are(spark, said):
    config = Config(transcription_method="fake", language="xx")
    segments = transcription.heard(audio.read_audio(spark, str(said)), None, Config(transcription_method="fake"))
    segments = segments.withColumn("language", F.lit("xx"))
    got = transcription.align_languages(audio.read_audio(spark, str(said)), segments, Config()).collect()
    assert len(got) == 2 and all(r["words"][0]["score"] == 0.9 for r in got) and config.language == "xx"


def test_commands(spark, said, tmp_path, capsys):
    out = str(tmp_path / "run")
    assert cli.main(["transcribe", str(said), "-o", out, "--transcription-method", "fake", "--emission-method", "fake", "-l", "en", "--no-vad", "--diarization", "--diarization-method", "fake"]) == 0
    assert "recordings: 2, segments: 3, languages: en" in capsys.readouterr().out
    cues = tmp_path / "cues"
    cues.mkdir()
    (cues / "two.srt").write_text("1\n00:00:01,000 --> 00:00:01,680\n[SPEAKER_1] another recording\n")
    assert cli.main(["align", str(said), str(cues), "-o", str(tmp_path / "aligned"), "-l", "en", "--emission-method", "fake"]) == 0
    assert "segments: 1, words: 2" in capsys.readouterr().out
    words = spark.read.parquet(str(tmp_path / "aligned" / "segments")).first()["words"]
    assert [w["word"] for w in words] == ["another", "recording"] and abs(words[1]["start"] - 1.32) < 0.06
    with pytest.raises(SystemExit, match="not found"):
        cli.main(["align", str(said), str(tmp_path / "none"), "-o", out])


def test_diarization_implies_voice_activity():
    args = cli.parser().parse_args(["segments", "x", "-o", "y", "--no-vad", "--diarization", "--vad-params", '{"level": 0.1}'])
    config = cli.config_of(args)
    assert config.use_vad and config.use_diarization and config.vad_params == {"level": 0.1} and config.min_speakers == 2


def test_sentences_words_and_characters_together(spark):
    text = "Ab cd. Ef? gh"
    vocabulary = {x: i for i, x in enumerate(["<pad>", "|", *"abcdefgh"])}
    ids = [vocabulary.get(x.lower().replace(" ", "|"), 2) for x in text]
    frames = np.full((2 * len(ids) + 1, len(vocabulary)), -6.0)
    frames[np.arange(len(ids)) * 2 + 1, ids] = frames[::2, 0] = -0.1
    segments = spark.createDataFrame([("r", 0, 0.0, 2.6, text), ("r", 1, 3.0, 4.0, "  ")], "recording_id string, ord long, start double, end double, text string")
    emissions = spark.createDataFrame([("r", 0, frames.tolist())], "recording_id string, ord long, emission array<array<double>>")
    got = transcription.align_sentences(segments, emissions, vocabulary, chars=True).orderBy("ord", "sentence").collect()
    assert [(r["ord"], r["text"]) for r in got] == [(0, "Ab cd."), (0, "Ef?"), (0, "gh"), (1, "  ")]
    assert [[w["word"] for w in r["words"]] for r in got[:3]] == [["Ab", "cd."], ["Ef?"], ["gh"]] and got[3]["words"] == []
    assert "".join(c["char"] for c in got[0]["chars"]).strip() == "Ab cd." and got[0]["chars"][0]["start"] is not None
    assert all(a["end"] <= b["end"] for a, b in zip(got[:2], got[1:3]))
    assert "chars" not in transcription.align_sentences(segments, emissions, vocabulary).columns


def test_options_merge_and_devices_fall_back(monkeypatch):
    assert providers.merged({"a": {"b": 1, "c": 2}, "d": 3}, {"a": {"b": 9}, "e": 4}) == {"a": {"b": 9, "c": 2}, "d": 3, "e": 4}
    assert providers.merged(None, None) == {} and providers.device("cpu") == "cpu" and providers.device("cuda") in ("cuda", "cpu")
    with pytest.raises(ValueError, match="unknown VAD method 'none'; known: energy, pyannote, silero, speechbrain"):
        providers.provider(providers.VAD, "none")


def test_pipeline_params_override_the_call(spark, said, monkeypatch):
    def factory():
        return lambda samples, rate, **call: [(2.0, 3.0, "late"), (0.0, 1.0, f"speakers {call.get('num_speakers')}")]

    monkeypatch.setitem(providers.DIARIZATION.known, "told", factory)
    rows = providers.diarize(audio.read_audio(spark, str(said)), "told", {"pipeline_params": {"num_speakers": 7}}, num_speakers=2).where("ord = 0").collect()
    assert {r["speaker"] for r in rows} == {"speakers 7"}


def test_silence_is_no_speech_or_an_error():
    silent = np.zeros(32000, np.float32)
    assert providers.band_diarization()(silent) == []
    with pytest.raises(RuntimeError, match="no speech"):
        providers.band_diarization(need_speech=True)(silent)


def test_decoders_by_signature(spark, tmp_path, monkeypatch):
    monkeypatch.setitem(audio.DECODERS, b"TONE", lambda content: (np.ones((int(content[4:]), 1), np.float32), 16000, 1))
    (tmp_path / "a.tone").write_bytes(b"TONE32000")
    x, rate, channels = audio.decode(b"TONE100")
    assert len(x) == 100 and (rate, channels) == (16000, 1) and audio.header(b"TONE32000") == (16000, 1, 2.0)
    wav = audio.encode_wav(np.zeros(8000))
    assert audio.header(wav) == (16000, 1, 0.5) and len(audio.decode(wav)[0]) == 8000


def test_recordings_from_arrays(spark):
    rows = spark.createDataFrame([("a", [0.5] * 1600), ("b", [0.0] * 800)], "recording_id string, samples array<double>")
    got = {r["recording_id"]: (r["rate"], r["duration"]) for r in audio.probe(audio.from_arrays(rows)).collect()}
    assert got == {"a": (16000, 0.1), "b": (16000, 0.05)}
    two = spark.createDataFrame([("c", [[0.5] * 1600, [0.1] * 1600])], "recording_id string, samples array<array<double>>")
    x = audio.decode(audio.from_arrays(two).first()["content"])[0]
    assert abs(float(x.mean()) - 0.3) < 1e-3


def test_resampling_does_not_alias():
    t = np.arange(48000) / 48000
    high = np.sin(2 * np.pi * 15000 * t)[:, None].astype(np.float32)
    low = np.sin(2 * np.pi * 440 * t)[:, None].astype(np.float32)
    assert np.abs(audio.mono_at(high, 48000)[200:-200]).max() < 0.05 and np.abs(audio.mono_at(low, 48000)).max() > 0.95
    assert len(audio.mono_at(high, 48000)) == 16000
