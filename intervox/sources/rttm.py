"""RTTM lines: SPEAKER <recording> <channel> <start> <duration> <NA> <NA> <speaker> <NA> ..."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import strip


def parse_rttm(lines: DataFrame, uri: str | None = None, value: str = "value", keys: tuple[str, ...] = ()) -> DataFrame:
    """recording_id, ord, start, end, speaker of the SPEAKER lines of nine fields or more, by start.

    Blank lines and lines with # are skipped; uri keeps one recording. Lines of equal start keep the order of the
    column line_no where there is one.
    """
    parts = F.split(strip(F.col(value)), r"\s+")
    rows = lines.withColumn("_p", parts).where(~F.col(value).rlike(r"^\s*(#|$)") & (F.size("_p") >= 9) & (F.get("_p", F.lit(0)) == "SPEAKER"))
    if uri:
        rows = rows.where(F.get("_p", F.lit(1)) == uri)
    at = lambda i: F.get("_p", F.lit(i))
    line = F.col("line_no") if "line_no" in lines.columns else F.monotonically_increasing_id()
    rows = rows.select(*keys, at(1).alias("recording_id"), line.alias("_line"), at(3).cast("double").alias("start"), (at(3).cast("double") + at(4).cast("double")).alias("end"), at(7).alias("speaker"))
    order = Window.partitionBy(*keys, "recording_id").orderBy("start", "_line")
    return rows.withColumn("ord", F.row_number().over(order) - 1).select(*keys, "recording_id", "ord", "start", "end", "speaker")


def read_rttm(spark: SparkSession, path: str, uri: str | None = None) -> DataFrame:
    return parse_rttm(spark.read.text(path).withColumn("file", F.col("_metadata.file_path")), uri)


def pick_rttm(spark: SparkSession, folder: str, stem: str) -> str:
    """The first .rttm file of a folder whose name has the stem, else the first; an error without any."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.rttm").option("recursiveFileLookup", "true").load(folder).select("path")
    name = F.regexp_extract("path", r"([^/]*)\.rttm$", 1)
    first = files.orderBy((name != stem).cast("int"), "path").limit(1).collect()
    if not first:
        raise FileNotFoundError(f"no RTTM file in {folder}")
    return first[0][0]


def rttm_line(recording: Column, start: Column, end: Column, speaker: Column) -> Column:
    return F.concat_ws(" ", F.lit("SPEAKER"), recording.cast("string"), F.lit("1"), start.cast("string"), (end - start).cast("string"), F.lit("<NA>"), F.lit("<NA>"), speaker, F.lit("<NA>"), F.lit("<NA>"))
