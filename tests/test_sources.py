import json
import wave

import numpy as np
import pytest
from pyspark.sql import functions as F

from intervox import providers
from intervox.operators import clustering
from intervox.operators.clustering import spectral_labels, speakers_wanted
from intervox.plans.transcription import Config, clip_plan, outputs, speech, transcribe_files
from intervox.sources import audio, logs, models, rttm, srt

SEGMENTS = "recording_id string, ord long, start double, end double, speaker string, text string"


def test_rttm_lines(spark):
    lines = ["# comment", "", "SPEAKER r 1 5.0 1.5 <NA> <NA> b <NA> <NA>", "SPEAKER r 1 1.0 2.0 <NA> <NA> a <NA>", "SPEAKER r 1 1 1 x x", "SPEAKER q 1 0 1 <NA> <NA> z <NA>", "LEXEME r 1 0 1 <NA> <NA> z <NA>"]
    df = spark.createDataFrame([(x, i) for i, x in enumerate(lines)], "value string, line_no int")
    got = rttm.parse_rttm(df, "r").orderBy("ord").collect()
    assert [(r["start"], r["end"], r["speaker"]) for r in got] == [(1.0, 3.0, "a"), (5.0, 6.5, "b")]
    assert rttm.parse_rttm(df).count() == 3


def test_rttm_files(spark, tmp_path):
    for name in ("x.rttm", "talk.rttm"):
        (tmp_path / name).write_text(f"SPEAKER {name} 1 0 1 <NA> <NA> a <NA>\n")
    assert rttm.pick_rttm(spark, str(tmp_path), "x").endswith("/x.rttm")
    assert rttm.pick_rttm(spark, str(tmp_path), "none").endswith("/talk.rttm")
    assert rttm.read_rttm(spark, str(tmp_path)).count() == 2
    (tmp_path / "empty").mkdir()
    with pytest.raises(FileNotFoundError):
        rttm.pick_rttm(spark, str(tmp_path / "empty"), "x")


def test_srt_round_trip(spark, tmp_path):
    rows = [("r", 0, 1.001, 4.35, "SPEAKER_1", "hello"), ("r", 1, 5.0, 6.0, None, "  "), ("r", 2, 400000.0, 400001.5, "x", "[SPEAKER_2] [note] two\nlines"), ("r", 3, 7.0, 8.0, "x", "[only]")]
    df = spark.createDataFrame(rows, SEGMENTS)
    text = srt.srt_text(df).first()["srt"]
    assert "00:00:01,000 --> 00:00:04,350" in text and "[SPEAKER_1] hello" in text and "111:06:40,000" in text
    srt.write_srt(df, str(tmp_path / "srt"))
    got = srt.read_srt(spark, str(tmp_path / "srt")).orderBy("ord").collect()
    # At most two labels go: the speaker's and one that the text had.
    assert [(r["start"], r["text"]) for r in got] == [(1.0, "hello"), (400000.0, "[SPEAKER_2] [note] two\nlines"), (7.0, "[only]")]


@pytest.mark.parametrize("text, left", [("[SPEAKER_1] [x] a", "a"), ("[x] [SPEAKER_1] a", "[SPEAKER_1] a"), ("[x]", ""), (" a ", "a")])
def test_labels(spark, text, left):
    from intervox.functions.text import without_labels

    assert spark.range(1).select(without_labels(F.lit(text))).first()[0] == left


def test_logs(spark):
    df = spark.createDataFrame([("r", 0, 0.0, 1.0, None, "a"), ("r", 1, 1.0, 3.0, "s", "b")], SEGMENTS)
    vad = json.loads(logs.vad_log(df).first()["log"])
    assert vad["segments"][0] == {"start": 0.0, "end": 1.0, "speaker": None} and vad["num_speakers"] == 1
    said = json.loads(logs.transcript_log(df, "en").first()["log"])
    assert list(said["segments"][0]) == ["text", "start", "end", "avg_logprob", "no_speech_prob", "compression_ratio", "speaker"] and [x["speaker"] for x in said["segments"]] == [None, "s"]
    speakers = json.loads(logs.speaker_log(df).first()["log"])
    assert speakers["speaker_statistics"] == {"null": {"total_duration": 1.0, "segment_count": 1}, "s": {"total_duration": 2.0, "segment_count": 1}}
    aligned = df.withColumn("words", F.expr("array(named_struct('word', 'a', 'start', 0.0d, 'end', 1.0d, 'score', cast(null as double)))"))
    log = json.loads(logs.alignment_log(aligned).first()["log"])
    assert log["segments"][0]["words"] == [{"word": "a", "start": 0.0, "end": 1.0}] and len(log["word_segments"]) == 2
    assert "avg_alignment_score" not in log["segment_confidences"][0] and log["segment_confidences"][0]["word_count"] == 1
    line = json.loads(logs.manifest(df.select(F.col("recording_id").alias("audio_filepath"))).first()["value"])
    assert len(line) == 8 and line["duration"] is None and line["offset"] == 0


def wav(path, rate, channels, seconds, width=2):
    t = np.arange(int(rate * seconds)) / rate
    x = (0.5 * np.sin(2 * np.pi * 200 * t) * (2 ** (8 * width - 1) - 1)).astype({2: "<i2", 4: "<i4"}[width])
    with wave.open(str(path), "wb") as f:
        f.setnchannels(channels)
        f.setsampwidth(width)
        f.setframerate(rate)
        f.writeframes(np.repeat(x, channels).tobytes())


def test_audio(spark, tmp_path):
    wav(tmp_path / "a.wav", 16000, 1, 2.0)
    wav(tmp_path / "b.wav", 8000, 2, 1.0, 4)
    files = audio.read_audio(spark, str(tmp_path))
    got = {r["stem"]: r for r in audio.probe(files).collect()}
    assert not got["a"]["needs_normalising"] and got["b"]["needs_normalising"] and got["b"]["duration"] == 1.0
    again = {r["stem"]: r for r in audio.probe(audio.normalise(files)).collect()}
    assert (again["b"]["rate"], again["b"]["channels"]) == (16000, 1)
    pieces = audio.load_mono(files, piece=16000).groupBy("recording_id").agg(F.count("*").alias("n"), F.sum(F.size("samples")).alias("s")).collect()
    assert sorted((r["n"], r["s"]) for r in pieces) == [(1, 16000), (2, 32000)]
    padded, true = audio.cut(np.zeros(16000, np.float32), 0.5, 0.51)
    assert (len(padded), true) == (400, 160)


def test_registries():
    with pytest.raises(ValueError):
        providers.VAD.create("none")
    providers.VAD.register("Mine", lambda: lambda samples, rate, **_: [(0.0, 1.0, None)])
    assert providers.VAD.create("mine")(None, 16000) == [(0.0, 1.0, None)]


def test_run(spark, tmp_path):
    wav(tmp_path / "a.wav", 16000, 1, 4.0)
    files = audio.read_audio(spark, str(tmp_path))
    config = Config(use_diarization=True, num_speakers=2, hf_token="secret")
    found = speech(files, config).collect()
    assert [(r["start"], r["end"], r["speaker"]) for r in found] == [(0.0, 4.0, "spk0")]
    assert "secret" not in str(config.public()) and "secret" not in repr(config)
    said = lambda files, clips, config: clips.withColumn("text", F.lit(" hi "))
    final, labelled = transcribe_files(spark, str(tmp_path), said, config)
    assert [(r["text"], r["speaker"]) for r in final.collect()] == [("hi", "spk0")]
    assert outputs(final, config, str(tmp_path / "out"), labelled)
    assert clip_plan(files, None, Config()) is None
    assert clip_plan(files, None, Config(batch_size=2)).first()["end"] == 3.99
    assert speech(files, Config(use_vad=False)) is None


def test_silence_has_no_rows(spark):
    files = spark.createDataFrame([("s", bytearray(audio.encode_wav(np.zeros(16000))))], "recording_id string, content binary")
    assert providers.detect_speech(files).count() == 0 and providers.diarize(files).count() == 0


def test_models(spark):
    df = spark.createDataFrame([("en",), ("ja",), ("xx",), (None,)], "lang string")
    got = {r["lang"]: r["model_source"] for r in models.with_model(df).collect()}
    assert got == {"en": "torch", "ja": "hub", "xx": None, None: None}
    assert {r["model"] for r in models.with_model(df, override="m").collect()} == {"m"}
    with pytest.raises(Exception, match="no alignment model"):
        models.with_model(df, strict=True).collect()


def test_clustering():
    rng = np.random.default_rng(0)
    centres = np.eye(3)[[0, 1, 2, 0, 1] * 8] * 5
    labels = spectral_labels(centres + rng.normal(0, 0.05, centres.shape), 3)
    assert labels.tolist() == [0, 1, 2, 0, 1] * 8
    assert [speakers_wanted(4), speakers_wanted(), speakers_wanted(None, 3, 2), speakers_wanted(None, 1)] == [4, 2, 2, 2]


def test_command_line(spark, tmp_path):
    from intervox.cli import main

    wav(tmp_path / "a.wav", 16000, 1, 2.0)
    assert main(["segments", str(tmp_path), "-o", str(tmp_path / "out")]) == 0
    with pytest.raises(SystemExit):
        main(["segments", str(tmp_path / "none"), "-o", "x"])


def test_a_recording_beyond_the_held_windows_is_clustered_whole(spark):
    n = clustering.MOST_WINDOWS + 200
    who = np.arange(n) * 2 // n
    who[np.setdiff1d(np.arange(n), np.linspace(0, n - 1, clustering.MOST_WINDOWS).astype(int))] = 2  # heard only between evenly spaced windows
    x = np.eye(3, 8)[who] * 6 + np.random.default_rng(4).standard_normal((n, 8)) * 0.3
    rows = spark.createDataFrame([("r", i, v.tolist()) for i, v in enumerate(x)], "recording_id string, ord long, embedding array<double>")
    got = [r["speaker"] for r in clustering.cluster_speakers(rows, number=3).orderBy("ord").collect()]
    assert len(set(zip(who.tolist(), got))) == 3 and len(set(got)) == 3


@pytest.mark.parametrize("kind", ["apart", "ties", "random"])
def test_blocks_cluster_as_the_whole_matrix_does(monkeypatch, kind):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((300, 16))
    if kind != "random":
        x = np.eye(3, 16)[np.arange(300) % 7 % 3] * 6 + x * 0.5
    if kind == "ties":
        x = np.repeat(x[::10], 10, axis=0)
    whole = spectral_labels(x, 3)
    monkeypatch.setattr(clustering, "MOST_WINDOWS", 50)
    monkeypatch.setattr(clustering, "BLOCK", 300 * 64)
    assert (spectral_labels(x, 3) == whole).all()


def test_run_keeps_the_words_and_aligns(spark, tmp_path):
    wav(tmp_path / "a.wav", 16000, 1, 4.0)
    vocabulary = {"<pad>": 0, "|": 1, "h": 2, "i": 3}
    word = F.array(F.struct(F.lit("hi").alias("word"), F.lit(0.5).alias("start"), F.lit(1.0).alias("end"), F.lit(0.9).alias("probability")))
    said = lambda files, clips, config: clips.withColumn("text", F.lit(" hi ")).withColumn("words", word)
    frames = np.full((5, 4), -6.0)
    frames[np.arange(5), [0, 2, 0, 3, 0]] = -0.1
    emitter = lambda files, segments, config: segments.select("recording_id", "ord").withColumn("emission", F.lit(json.dumps(frames.tolist()))).withColumn("emission", F.from_json("emission", "array<array<double>>"))
    plain = transcribe_files(spark, str(tmp_path), said, Config())[0].first()
    assert plain["words"][0]["probability"] == 0.9
    assert "words" not in transcribe_files(spark, str(tmp_path), said, Config(word_timestamps=False))[0].columns
    aligned = transcribe_files(spark, str(tmp_path), said, Config(), emitter, vocabulary)[0].first()
    assert [w["word"] for w in aligned["words"]] == ["hi"] and aligned["words"][0]["score"] is not None
    off = transcribe_files(spark, str(tmp_path), said, Config(use_alignment=False), emitter, vocabulary)[0].first()
    assert off["words"][0]["probability"] == 0.9


def test_one_short_recording_does_not_stop_the_others(spark):
    rows = spark.createDataFrame([(0, 0, [1.0, 0.0]), *[(1, i, [float(i % 2), 1.0 - i % 2]) for i in range(8)]], "recording_id long, ord long, embedding array<double>")
    got = {(r["recording_id"], r["ord"]): r["speaker"] for r in clustering.cluster_speakers(rows, number=2).collect()}
    assert got[0, 0] == "spk0" and got[1, 0] == got[1, 2] != got[1, 1] == got[1, 3]
    with pytest.raises(Exception, match="too few"):
        clustering.cluster_speakers(rows, number=2, strict=True).collect()


def test_compressed_wav_is_decoded():
    x = np.sin(np.arange(4000)) / 2
    plain, packed = audio.encode_wav(x), audio.compressed(audio.encode_wav(audio.pcm(x)))
    assert (audio.decode(packed)[0] == audio.decode(plain)[0]).all() and audio.header(packed) == audio.header(plain)
