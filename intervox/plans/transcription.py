"""The whole run as one plan: speech and speakers, a transcript, alignment, speakers of segments, subtitles and logs."""

from __future__ import annotations

import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import path_stem, strip
from ..operators import ctc, intervals, words
from ..providers import EMISSION, WORDS, detect_speech, diarize, emissions, provider, transcribe
from ..sources import logs, models, srt
from ..sources.audio import probe, read_audio


@dataclass(frozen=True)
class Config:
    """Options of a run; secrets are never part of results."""

    whisper_model: str = "large-v3"
    device: str = "cpu"
    compute_type: str = "float32"
    use_vad: bool = True
    use_diarization: bool = False
    vad_method: str = "energy"
    vad_params: dict | None = None
    diarization_method: str = "bands"
    diarization_params: dict | None = None
    num_speakers: int | None = None
    min_speakers: int | None = None
    max_speakers: int | None = None
    vad_min_duration: float = intervals.MIN_DURATION
    vad_merge_threshold: float = intervals.MERGE_THRESHOLD
    language: str | None = None
    task: str = "transcribe"
    beam_size: int = 5
    batch_size: int | None = None
    word_timestamps: bool = True
    log_progress: bool = False
    use_alignment: bool = True
    alignment_model: str | None = None
    include_speaker_labels: bool = True
    transcription_method: str = "whisper"
    transcription_params: dict | None = None
    emission_method: str = "wav2vec2"
    emission_params: dict | None = None
    hf_token: str | None = field(default=None, repr=False)

    def public(self) -> dict:
        return {k: v for k, v in asdict(self).items() if k != "hf_token"}


def run_id(spark: SparkSession) -> str:
    """The time to the second, and a suffix that tells runs of one second apart."""
    now = spark.range(1).select(F.date_format(F.current_timestamp(), "yyyyMMdd_HHmmss")).first()[0]
    return f"{now}_{uuid.uuid4().hex[:8]}"


def speech(audio: DataFrame, config: Config) -> DataFrame | None:
    """Segments to transcribe, with speakers if the run diarizes; None if it does neither."""
    if not (config.use_vad or config.use_diarization):
        return None
    vad = detect_speech(audio, config.vad_method, config.vad_params, config.vad_min_duration, config.vad_merge_threshold) if config.use_vad else None
    turns = diarize(audio, config.diarization_method, config.diarization_params, config.num_speakers, config.min_speakers, config.max_speakers) if config.use_diarization else None
    return intervals.combine(vad, turns)[0]


def clip_plan(audio: DataFrame, segments: DataFrame | None, config: Config) -> DataFrame | None:
    """recording_id, ord, start, end to transcribe: the segments, else fixed chunks if batched, else None for whole files."""
    if segments is not None:
        return segments.select("recording_id", "ord", "start", "end")
    if config.batch_size is None:
        return None
    chunks = intervals.trim_last_chunk(intervals.fixed_chunks(probe(audio)))
    return chunks.select("recording_id", F.col("k").alias("ord"), "start", "end")


def transcript(rows: DataFrame, timestamps: bool = True) -> DataFrame:
    """A provider's segments with stripped text, and its words if they are asked for; missing columns are null."""
    kinds = {"avg_logprob": "double", "compression_ratio": "double", "no_speech_prob": "double", "language": "string", "language_probability": "double"}
    kinds |= {"words": WORDS} if timestamps and "words" in rows.columns else {}
    extra = [(F.col(c) if c in rows.columns else F.lit(None)).cast(t).alias(c) for c, t in kinds.items()]
    return rows.select("recording_id", "ord", "start", "end", strip(F.col("text")).alias("text"), *extra)


def heard(audio: DataFrame, clips: DataFrame | None, config: Config, transcriber=None) -> DataFrame:
    """The transcript of the clips, by transcriber(audio, clips, config) or the method that config names."""
    if transcriber is not None:
        rows = transcriber(audio, clips, config)
    else:
        params = {"model": config.whisper_model, "device": config.device, "compute_type": config.compute_type, "batch_size": config.batch_size} if config.transcription_method == "whisper" else {}
        call = {"language": config.language, "task": config.task, "beam_size": config.beam_size, "word_timestamps": config.word_timestamps, "log_progress": config.log_progress}
        rows = transcribe(audio, clips, config.transcription_method, params | (config.transcription_params or {}), **call)
    rows = transcript(rows, config.word_timestamps)
    return rows.withColumn("language", F.lit(config.language)) if config.language else rows


def timed_characters(segments: DataFrame, emissions: DataFrame, vocabulary: Column, blank: int = 0, spaced: bool = True, beam: int | None = None) -> DataFrame:
    """keys, seg_start, seg_end, cdx, char, word_idx, start, end, score of all characters of segments that have a path.

    Arrays stay within a segment's row until each character has its time; then rows are small, and dealt by segment,
    so that words, fills and arrays of a segment need no other shuffle.
    """
    keys, text = ["recording_id", "ord"], F.col("text")
    rows = segments.where(F.length("text") > 0).select(
        *keys, F.col("start").alias("seg_start"), F.col("end").alias("seg_end"), "text", words.leading_blanks(text).alias("lead"), words.clean_tokens(text, vocabulary, spaced).alias("tokens")
    )
    # Emissions are far larger than what they are estimated at, so neither side is broadcast; nor are words, below.
    found = ctc.align_runs(rows.hint("merge").join(emissions.select(*keys, "emission"), keys), blank, beam).where("runs is not null")
    at = lambda x: ctc.frame_to_time(x, F.col("frames"), F.col("seg_start"), F.col("seg_end"))
    # A path takes every token in turn, so the run of token k is run k, of the inner character k.
    run = lambda i: F.get("runs", F.when(i >= F.col("lead"), i - F.col("lead")))
    one = lambda x, i: F.struct(x["char"].alias("char"), x["word_idx"].alias("word_idx"), run(i).alias("run"))
    rows = found.select(*keys, "seg_start", "seg_end", "frames", F.transform(words.numbered_characters(text, spaced), one).alias("_c"))
    rows = rows.repartition(*keys).select(*keys, "seg_start", "seg_end", "frames", F.posexplode("_c").alias("cdx", "_c"))
    return rows.select(*keys, "seg_start", "seg_end", "cdx", "_c.char", "_c.word_idx", at(F.col("_c.run.start")).alias("start"), at(F.col("_c.run.end")).alias("end"), F.round("_c.run.score", 3).alias("score"))


def align(segments: DataFrame, emissions: DataFrame, vocabulary: dict[str, int], durations: DataFrame | None = None, language: str = "de", beam: int | None = None) -> DataFrame:
    """segments with words (word, start, end, score), by CTC alignment of their text to emissions (recording_id, ord, emission).

    Segments that start at or after the recording's end, have no characters to align, or no path, have no words.
    """
    keys, spaced = ["recording_id", "ord"], language not in words.UNSPACED
    known = F.create_map(*[F.lit(x) for pair in vocabulary.items() for x in pair])
    rows = segments if durations is None else segments.join(durations.select("recording_id", F.col("duration").alias("_d")), "recording_id", "left").where(F.col("_d").isNull() | (F.col("start") < F.col("_d"))).drop("_d")
    timed = timed_characters(rows, emissions, known, ctc.blank_id(vocabulary, last=beam is not None), spaced, beam)
    rolled = words.interpolate(words.word_rollup(timed, [*keys, "seg_start", "seg_end"]), [*keys, "seg_start", "seg_end"])
    return segments.hint("merge").join(words.word_arrays(rolled, keys), keys, "left").withColumn("words", F.coalesce("words", F.array().cast("array<struct<word:string,start:double,end:double,score:double>>")))


def align_sentences(segments: DataFrame, emissions: DataFrame, vocabulary: dict[str, int], language: str = "en", beam: int | None = 2, chars: bool = False) -> DataFrame:
    """recording_id, ord, sentence, start, end, text, words and, if asked for, chars: segments cut into aligned sentences.

    Sentences without times take the nearest one's; those of equal times become one. Segments without a path stay whole,
    without words.
    """
    keys, spaced = ["recording_id", "ord"], language not in words.UNSPACED
    known = F.create_map(*[F.lit(x) for pair in vocabulary.items() for x in pair])
    timed = timed_characters(segments, emissions, known, ctc.blank_id(vocabulary, last=beam is not None), spaced, beam)
    said, own = segments.select(*keys, "text"), [*keys, "sentence"]
    rows = words.sentence_rollup(timed, said, keys, language)
    rows = rows.hint("merge").join(words.word_arrays(words.sentence_words(timed, said, keys, language), own), own, "left")
    if chars:
        inside = words.sentence_characters(words.sentence_spans(said, keys, language), keys).hint("merge").join(timed, [*keys, "cdx"])
        of = F.sort_array(F.collect_list(F.struct("cdx", "char", "start", "end", "score")))
        rows = rows.hint("merge").join(inside.groupBy(*own).agg(F.transform(of, lambda x: x.dropFields("cdx")).alias("chars")), own, "left")
    for c in ("start", "end"):
        rows = words.nearest_fill(rows, keys, "sentence", c)
    rows = words.merge_same_times(rows, keys, spaced)
    left = segments.hint("merge").join(timed.select(*keys).distinct(), keys, "left_anti").select(*keys, "start", "end", "text", F.lit(0).alias("sentence"))
    return rows.unionByName(left, allowMissingColumns=True).withColumn("words", F.coalesce("words", F.array().cast(dict(rows.dtypes)["words"])))


def align_languages(audio: DataFrame, segments: DataFrame, config: Config, emitter=None, vocabulary: dict[str, int] | None = None) -> DataFrame:
    """segments with aligned words in place of the transcriber's, each by the model of its language.

    A language without a model leaves its segments as they are. With emitter(audio, segments, config) all go by that
    and its vocabulary.
    """
    durations = probe(audio)
    if emitter is not None:
        return align(segments.drop("words"), emitter(audio, segments, config), vocabulary, durations, **({"language": config.language} if config.language else {}))
    own = config.emission_method == "wav2vec2" and not config.alignment_model
    # Languages with a model are a fixed few; segments in others stay.
    present = [config.language] if config.language else sorted(r[0] for r in segments.where(F.col("language").isin(*models.TORCH, *models.HUB) if own else F.col("language").isNotNull()).select("language").distinct().collect())
    plain = "array<struct<word:string,start:double,end:double,score:double>>"
    as_said = F.transform("words", lambda w: F.struct(w["word"].alias("word"), w["start"].alias("start"), w["end"].alias("end"), w["probability"].alias("score"))) if "words" in segments.columns else F.lit(None).cast(plain)
    out = segments.where(~F.coalesce(F.col("language").isin(*present), F.lit(False)) if present else F.lit(True)).withColumn("words", as_said)
    for language in present:
        params = {"language": language, "model": config.alignment_model, "device": config.device} if config.emission_method == "wav2vec2" else {}
        params |= config.emission_params or {}
        mine = segments.drop("words").where(F.col("language") == language)
        found = emissions(audio, mine, config.emission_method, params)
        out = out.unionByName(align(mine, found, provider(EMISSION, config.emission_method, params).vocabulary, durations, language))
    return out


def finish(segments: DataFrame, speakers: DataFrame | None, config: Config) -> DataFrame:
    """The final segments: with the speaker of the labelled segment that overlaps longest, if the run diarizes."""
    if speakers is None or not config.use_diarization:
        return segments
    labelled = speakers.select("recording_id", "ord", "start", "end", "speaker")
    return intervals.assign_speakers(segments, labelled)


def result_rows(segments: DataFrame, config: Config, speakers: DataFrame | None = None, transcribed: DataFrame | None = None, srt_path: str | None = None, log_dir: str | None = None) -> DataFrame:
    """One row a recording: language, transcription, vad_diarization, final_segments, srt_content, where files are, and the options."""

    def of(rows: DataFrame, columns: list[str], name: str) -> DataFrame:
        item = F.struct("ord", F.struct(*[c for c in columns if c in rows.columns]).alias("x"))
        return rows.groupBy("recording_id").agg(F.transform(F.sort_array(F.collect_list(item)), lambda y: y["x"]).alias(name))

    said = transcribed if transcribed is not None else segments
    rows = of(said, ["ord", "start", "end", "text", "avg_logprob", "compression_ratio", "no_speech_prob"], "transcription")
    if "language" in said.columns:
        rows = rows.join(said.groupBy("recording_id").agg(F.min_by("language", "ord").alias("language"), F.min_by("language_probability", "ord").alias("language_probability")), "recording_id")
    if speakers is not None:
        turns = of(speakers, ["start", "end", "speaker"], "turns").join(intervals.speaker_count(speakers), "recording_id")
        rows = rows.join(turns.select("recording_id", F.struct(F.col("turns").alias("segments"), "num_speakers").alias("vad_diarization")), "recording_id", "full")
    rows = rows.join(of(segments, ["start", "end", "text", "speaker", "words", "avg_logprob"], "final_segments"), "recording_id", "left")
    rows = rows.join(srt.srt_text(segments, config.include_speaker_labels and config.use_diarization).withColumnRenamed("srt", "srt_content"), "recording_id", "left")
    public = F.to_json(F.create_map(*[F.lit(str(x)) for pair in config.public().items() for x in pair]))
    return rows.withColumns({"srt_path": F.lit(srt_path).cast("string"), "log_dir": F.lit(log_dir).cast("string"), "config": public})


def outputs(segments: DataFrame, config: Config, folder: str, speakers: DataFrame | None = None, save_logs: bool = True) -> str:
    """Write the subtitles and, in a folder of the run, the logs; returns the run's id."""
    ident = run_id(segments.sparkSession)
    srt.write_srt(segments, f"{folder}/srt", config.include_speaker_labels and config.use_diarization)
    if save_logs:
        logs.write_logs(logs.transcript_log(segments.drop("speaker"), config.language), f"{folder}/logs/{ident}/transcription")
        if speakers is not None:
            logs.write_logs(logs.vad_log(speakers), f"{folder}/logs/{ident}/vad_diarization")
        if "words" in segments.columns and "score" in dict(segments.dtypes)["words"]:
            logs.write_logs(logs.alignment_log(segments), f"{folder}/logs/{ident}/alignment")
        if config.use_diarization and "speaker" in segments.columns:
            logs.write_logs(logs.speaker_log(segments), f"{folder}/logs/{ident}/speaker_alignment")
    return ident


def realign_srt(spark: SparkSession, srt_path: str, emissions: DataFrame, vocabulary: dict[str, int], language: str = "de") -> DataFrame:
    """Cues of SRT files, aligned to emissions; cue times stay as they are."""
    return align(srt.read_srt(spark, srt_path), emissions, vocabulary, language=language)


def realign_files(spark: SparkSession, audio_path: str, srt_path: str, config: Config | None = None, emitter=None, vocabulary: dict[str, int] | None = None) -> DataFrame:
    """Cues of SRT files aligned to the audio files of the same stem; recording_id is the audio's."""
    config = config or Config(language="de")
    audio = read_audio(spark, audio_path, None)
    stems = probe(audio).select(F.col("recording_id").alias("_audio"), "stem")
    cues = srt.read_srt(spark, srt_path).withColumn("stem", path_stem(F.col("recording_id")))
    cues = cues.join(stems, "stem").select(F.col("_audio").alias("recording_id"), "ord", "start", "end", "text", F.lit(config.language).alias("language"))
    return align_languages(audio, cues, config, emitter, vocabulary)


def transcribe_files(spark: SparkSession, path: str, transcriber=None, config: Config | None = None, emitter=None, vocabulary: dict[str, int] | None = None) -> tuple[DataFrame, DataFrame | None]:
    """(final segments, labelled speech) of audio files, by config's methods or what is given in their place.

    transcriber(audio, clips, config) gives segment rows; emitter(audio, segments, config) recording_id, ord and
    emission over the vocabulary. Unless config.use_alignment is off, the segments' words are those of the alignment.
    """
    config = config or Config()
    audio = read_audio(spark, path, None)
    labelled = speech(audio, config)
    segments = heard(audio, clip_plan(audio, labelled, config), config, transcriber)
    if config.use_alignment and (emitter is not None or transcriber is None or config.emission_params):
        segments = align_languages(audio, segments, config, emitter, vocabulary)
    return finish(segments, labelled, config), labelled


def run_files(spark: SparkSession, path: str, folder: str, config: Config | None = None, transcriber=None, emitter=None, vocabulary: dict[str, int] | None = None, save_logs: bool = True) -> DataFrame:
    """Transcribe, align, label and write subtitles, logs and results under folder; the result row of each recording."""
    config = config or Config()
    segments, labelled = transcribe_files(spark, path, transcriber, config, emitter, vocabulary)
    # Models run once: what follows reads what they gave.
    ident = run_id(spark)
    kept = f"{folder}/results/{ident}"
    segments.write.parquet(f"{kept}/segments")
    segments = spark.read.parquet(f"{kept}/segments")
    if labelled is not None:
        labelled.write.parquet(f"{kept}/speech")
        labelled = spark.read.parquet(f"{kept}/speech")
    logged = outputs(segments, config, folder, labelled, save_logs)
    result_rows(segments, config, labelled, None, f"{folder}/srt", f"{folder}/logs/{logged}" if save_logs else None).write.parquet(f"{kept}/runs")
    return spark.read.parquet(f"{kept}/runs")
