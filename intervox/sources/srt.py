"""SRT subtitles: reading cues and writing them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import milliseconds, srt_time, strip, without_labels

TIME = r"(\d+):(\d+):(\d+)[,.](\d+)"
CUE = rf"(?s)^\s*(?:\d+\s*\n)?\s*{TIME}\s*-->\s*{TIME}[^\n]*\n?(.*)$"


def _seconds(cue: Column, first: int) -> Column:
    part = lambda i: F.regexp_extract(cue, CUE, first + i).cast("long")
    return ((part(0) * 60 + part(1)) * 60 + part(2)) + part(3) / 1000.0


def parse_srt(files: DataFrame, content: str = "value", keys: tuple[str, ...] = ()) -> DataFrame:
    """keys, ord, start, end, text of the cues of whole SRT texts; leading labels are taken off, blank cues dropped."""
    blocks = F.split(F.regexp_replace(F.col(content), "\r\n?", "\n"), r"\n[ \t]*\n(?=\s*(?:\d+\s*\n)?\s*\d+:\d+:\d+[,.]\d+\s*-->)")
    cues = files.select(*keys, F.posexplode(blocks).alias("ord", "cue")).where(F.col("cue").rlike(CUE))
    milli = lambda first: F.round(_seconds(F.col("cue"), first), 3)
    rows = cues.select(*keys, "ord", milli(1).alias("start"), milli(5).alias("end"), without_labels(F.regexp_extract("cue", CUE, 9)).alias("text"))
    return rows.where(F.length("text") > 0)


def read_srt(spark: SparkSession, path: str) -> DataFrame:
    """recording_id (the file's path), ord, start, end, text."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("recording_id"), "value")
    return parse_srt(files, keys=("recording_id",))


def cues(segments: DataFrame, include_speaker: bool = True) -> DataFrame:
    """recording_id, cue_no (from 1), cue: the text of each cue; blank segments have none."""
    text = strip(F.col("text"))
    rows = segments.withColumn("_t", text).where(F.length("_t") > 0)
    if include_speaker and "speaker" in segments.columns:
        rows = rows.withColumn("_t", F.when(F.col("speaker") != "", F.concat(F.lit("["), "speaker", F.lit("] "), "_t")).otherwise(F.col("_t")))
    number = F.row_number().over(Window.partitionBy("recording_id").orderBy("ord"))
    times = F.concat(srt_time(milliseconds(F.col("start"))), F.lit(" --> "), srt_time(milliseconds(F.col("end"))))
    return rows.withColumn("cue_no", number).select("recording_id", "cue_no", F.concat_ws("\n", F.col("cue_no").cast("string"), times, F.col("_t")).alias("cue"))


def srt_text(segments: DataFrame, include_speaker: bool = True) -> DataFrame:
    """recording_id, srt: the whole subtitle text of each recording."""
    rows = cues(segments, include_speaker).groupBy("recording_id").agg(F.sort_array(F.collect_list(F.struct("cue_no", "cue"))).alias("c"))
    return rows.select("recording_id", F.concat(F.array_join(F.transform("c", lambda x: x["cue"]), "\n\n"), F.lit("\n")).alias("srt"))


def write_srt(segments: DataFrame, folder: str, include_speaker: bool = True) -> None:
    """One folder recording_id=<id> with the subtitle text for each recording."""
    # The writer ends the line that is the whole text, so the text's own last line end goes.
    value = F.expr("left(srt, length(srt) - 1)").alias("value")
    srt_text(segments, include_speaker).select("recording_id", value).write.mode("overwrite").partitionBy("recording_id").text(folder)
