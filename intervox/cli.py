"""Command line: transcription with speakers and alignment, speech segments, and alignment of transcripts that are there."""

from __future__ import annotations

import argparse
import json
import os

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .plans.transcription import Config, outputs, realign_files, run_files, speech
from .sources import logs, srt
from .sources.audio import probe, read_audio


def _detection(p: argparse.ArgumentParser) -> None:
    p.add_argument("--no-vad", dest="vad", action="store_false", help="no voice activity detection (diarization implies it)")
    p.add_argument("--vad-method", default="energy")
    p.add_argument("--vad-params", type=json.loads, help="a JSON object")
    p.add_argument("--diarization", action="store_true")
    p.add_argument("--diarization-method", default="bands")
    p.add_argument("--diarization-params", type=json.loads, help="a JSON object")
    p.add_argument("-n", "--num-speakers", type=int)
    p.add_argument("--min-speakers", type=int, default=2)
    p.add_argument("--max-speakers", type=int)


def _models(p: argparse.ArgumentParser) -> None:
    p.add_argument("--alignment-model")
    p.add_argument("--emission-method", default="wav2vec2")
    p.add_argument("--emission-params", type=json.loads, help="a JSON object")
    p.add_argument("--device", choices=["cuda", "cpu"], default="cpu")
    p.add_argument("--no-logs", action="store_true")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="intervox", description="Timed segments of speech on Spark")
    sub = p.add_subparsers(dest="command", required=True)
    audio = sub.add_parser("segments", help="speech segments, with speakers if asked")
    audio.add_argument("path")
    audio.add_argument("-o", "--output", required=True)
    _detection(audio)
    whole = sub.add_parser("transcribe", help="audio to subtitles with words, speakers and logs")
    whole.add_argument("path")
    whole.add_argument("-o", "--output", "--output-dir", default="outputs")
    whole.add_argument("-m", "--model", default="large-v3")
    whole.add_argument("-l", "--language", help="detected if not given")
    whole.add_argument("--task", choices=["transcribe", "translate"], default="transcribe")
    whole.add_argument("--transcription-method", default="whisper")
    whole.add_argument("--transcription-params", type=json.loads, help="a JSON object")
    whole.add_argument("--batch-size", type=int)
    whole.add_argument("--compute-type", choices=["float16", "float32", "int8"])
    whole.add_argument("--log-progress", action="store_true")
    whole.add_argument("--no-alignment", action="store_true")
    whole.add_argument("--no-speaker-labels", action="store_true")
    whole.add_argument("--hf-token", default=os.environ.get("HF_TOKEN"))
    _detection(whole)
    _models(whole)
    align = sub.add_parser("align", help="subtitles aligned to the audio files of their names")
    align.add_argument("path")
    align.add_argument("srt")
    align.add_argument("-o", "--output", required=True)
    align.add_argument("-l", "--language", default="de")
    _models(align)
    text = sub.add_parser("srt", help="subtitles to rows, labels taken off, and back")
    text.add_argument("path")
    text.add_argument("-o", "--output", required=True)
    text.add_argument("--no-speaker-labels", action="store_true")
    text.add_argument("--no-logs", action="store_true")
    return p


def config_of(args: argparse.Namespace) -> Config:
    """The options of a command, by the names that Config has for them."""
    given = {k: v for k, v in vars(args).items() if k in Config.__dataclass_fields__ and v is not None}
    if hasattr(args, "vad"):
        given |= {"use_vad": args.vad or args.diarization, "use_diarization": args.diarization}
    if args.command == "transcribe":
        given |= {"whisper_model": args.model, "use_alignment": not args.no_alignment, "include_speaker_labels": not args.no_speaker_labels}
    return Config(**given)


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    for path in (args.path, getattr(args, "srt", args.path)):
        if "://" not in path and not os.path.exists(path):
            raise SystemExit(f"not found: {path}")
    spark = SparkSession.builder.getOrCreate()
    if args.command == "segments":
        config = config_of(args)
        audio = read_audio(spark, args.path)
        found = speech(audio, config)
        if found is None:
            raise SystemExit("neither speech nor speakers were asked for")
        logs.write_logs(logs.vad_log(found), args.output)
        for r in probe(audio).orderBy("recording_id").limit(20).collect():
            print(f"{r['stem']}: {r['duration']:.1f}s")
    elif args.command == "transcribe":
        done = run_files(spark, args.path, args.output, config_of(args), save_logs=not args.no_logs)
        found = done.agg(F.count("*"), F.sum(F.size("final_segments")), F.concat_ws(",", F.collect_set("language")), F.first("srt_path"), F.first("log_dir")).first()
        print(f"recordings: {found[0]}, segments: {found[1]}, languages: {found[2]}\nsrt: {found[3]}" + (f"\nlogs: {found[4]}" if found[4] else ""))
    elif args.command == "align":
        rows = realign_files(spark, args.path, args.srt, config_of(args))
        rows.write.parquet(f"{args.output}/segments")
        rows = spark.read.parquet(f"{args.output}/segments")
        srt.write_srt(rows, f"{args.output}/srt", include_speaker=False)
        if not args.no_logs:
            logs.write_logs(logs.alignment_log(rows), f"{args.output}/logs")
        print(f"segments: {rows.count()}, words: {rows.agg(F.sum(F.size('words'))).first()[0] or 0}\nsrt: {args.output}/srt")
    else:
        rows = srt.read_srt(spark, args.path)
        outputs(rows, Config(use_diarization=not args.no_speaker_labels), args.output, save_logs=not args.no_logs)
        print(f"segments: {rows.count()}")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
