"""JSON logs and manifests of results, as columns and as files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import json_dropping_nulls, json_keeping_nulls
from ..operators.intervals import speaker_statistics
from ..operators.words import confidence


def _ordered(item: Column) -> Column:
    return F.transform(F.sort_array(F.collect_list(F.struct(F.col("ord"), item.alias("item")))), lambda x: x["item"])


def _nullable(df: DataFrame, names: dict[str, str]) -> list[Column]:
    return [(F.col(n) if n in df.columns else F.lit(None)).cast(t).alias(n) for n, t in names.items()]


def vad_log(segments: DataFrame, files: str = "recording_id") -> DataFrame:
    """recording_id, log: segments with null speakers kept, the number of speakers, the file."""
    item = F.struct("start", "end", "speaker")
    rows = segments.groupBy("recording_id").agg(_ordered(item).alias("segments"), F.count_distinct(F.when(F.col("speaker") != "", F.col("speaker"))).alias("num_speakers"))
    return rows.select("recording_id", json_keeping_nulls(F.struct("segments", "num_speakers", F.col(files).cast("string").alias("audio_file"))).alias("log"))


TRANSCRIPT = {"text": "string", "start": "double", "end": "double", "avg_logprob": "double", "no_speech_prob": "double", "compression_ratio": "double", "speaker": "string"}


def transcript_log(segments: DataFrame, language: str | None = None) -> DataFrame:
    """recording_id, log: seven fields a segment, missing ones null."""
    item = F.struct(*_nullable(segments, TRANSCRIPT))
    rows = segments.groupBy("recording_id").agg(_ordered(item).alias("segments"))
    whole = F.struct(F.col("recording_id").cast("string").alias("audio_file"), F.lit(language).cast("string").alias("language"), "segments")
    return rows.select("recording_id", json_keeping_nulls(whole).alias("log"))


def alignment_log(segments: DataFrame) -> DataFrame:
    """recording_id, log: aligned segments and words without nulls, and each segment's confidence."""
    item = F.struct(*[c for c in ("text", "start", "end", "words", "speaker", "avg_logprob") if c in segments.columns])
    sure = F.struct("text", "start", "end", confidence(F.col("words")).alias("avg_alignment_score"), F.size("words").alias("word_count"))
    rows = segments.groupBy("recording_id").agg(_ordered(item).alias("segments"), _ordered(sure).alias("segment_confidences"))
    words = F.flatten(F.transform("segments", lambda s: s["words"])).alias("word_segments")
    return rows.select("recording_id", json_dropping_nulls(F.struct("segments", words, F.col("recording_id").cast("string").alias("audio_file"), "segment_confidences")).alias("log"))


def speaker_log(segments: DataFrame) -> DataFrame:
    """recording_id, log: the segments and the statistics of each speaker; a null speaker is named null."""
    item = F.struct(*_nullable(segments, {"text": "string", "start": "double", "end": "double", "speaker": "string"}))
    rows = segments.groupBy("recording_id").agg(_ordered(item).alias("segments"))
    entry = F.struct(F.coalesce("speaker", F.lit("null")).alias("key"), F.struct("total_duration", "segment_count").alias("value"))
    stats = speaker_statistics(segments, ("recording_id", "speaker")).groupBy("recording_id").agg(F.map_from_entries(F.sort_array(F.collect_list(entry))).alias("speaker_statistics"))
    return rows.join(stats, "recording_id").select("recording_id", json_keeping_nulls(F.struct("segments", "speaker_statistics")).alias("log"))


def manifest(recordings: DataFrame, path: str = "audio_filepath", num_speakers: int | None = None) -> DataFrame:
    """value: one JSON line a recording, nulls kept."""
    none = F.lit(None).cast("string")
    fields = [F.col(path).cast("string").alias("audio_filepath"), F.lit(0).alias("offset"), F.lit(None).cast("double").alias("duration"), F.lit("infer").alias("label"), F.lit("-").alias("text")]
    fields += [F.lit(num_speakers).cast("int").alias("num_speakers"), none.alias("rttm_filepath"), none.alias("uem_filepath")]
    return recordings.select(json_keeping_nulls(F.struct(*fields)).alias("value"))


def write_logs(logs: DataFrame, folder: str) -> None:
    """One folder recording_id=<id> with the log for each recording."""
    logs.select("recording_id", F.col("log").alias("value")).write.mode("overwrite").partitionBy("recording_id").text(folder)
