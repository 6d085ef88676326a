"""Exact dedup: a static binary-fuse filter per immutable snapshot screens the digests of an incoming batch.

Digests that the filter passes join the snapshot's exact buckets, where the bytes of the texts are compared;
duplicates within the batch are grouped on their own. Text that the filter rules out never meets the snapshot.

Defined cases: a null text counts as empty; of equal texts the row with the largest doc_id stays (null doc_ids
are below all others); of rows equal in doc_id and text exactly one stays; texts of any length are compared whole; an
empty table gives an empty result; other columns of the input are ignored. Two different texts with one SHA-256 stop the job with an error.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, mix64, only_kept, written

#: Distinct digests of a snapshot or batch that share one filter.
KEYS_PER_FILTER = 200_000


# ------------------------------------------------------ binary fuse filters


def _slots(keys: np.ndarray, seed: int, segment: int, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The three slots of each key, in neighbouring segments, and its fingerprint."""
    h = mix64(keys + np.uint64(seed))
    first = ((h >> np.uint64(32)) * np.uint64(count * segment)) >> np.uint64(32)
    low = np.uint64(segment - 1)
    second = (first + np.uint64(segment)) ^ ((h >> np.uint64(18)) & low)
    third = (first + np.uint64(2 * segment)) ^ (h & low)
    return first.astype(np.int64), second.astype(np.int64), third.astype(np.int64), (h ^ (h >> np.uint64(40))).astype(np.uint8)


def build_filter(keys: np.ndarray) -> tuple[int, int, int, bytes]:
    """(seed, segment length, segment count, fingerprints) of a three-wise binary fuse filter over distinct keys."""
    keys = np.unique(keys.astype(np.uint64))
    n = max(2, len(keys))
    segment = 1 << max(2, int(np.log(n) / np.log(3.33) + 2.25))
    factor = max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(n))
    count = max(1, int(np.ceil(n * factor / segment)))
    for attempt in range(100):
        seed = (attempt + 1) * 0x2545F4914F6CDD1D & (1 << 63) - 1
        *slots, mark = _slots(keys, seed, segment, count)
        slots = np.stack(slots)
        size = (count + 2) * segment
        flat, owner = slots.ravel(), np.tile(np.arange(len(keys)), 3)
        degree = np.bincount(flat, minlength=size)
        together = np.zeros(size, np.int64)  # xor of the keys' numbers in a slot: at degree 1 the key itself
        np.bitwise_xor.at(together, flat, owner)
        rounds, left, ready = [], len(keys), np.flatnonzero(degree == 1)
        while len(ready):
            peeled, at = np.unique(together[ready], return_index=True)
            rounds.append((peeled, ready[at]))
            left -= len(peeled)
            touched = slots[:, peeled].ravel()
            np.subtract.at(degree, touched, 1)
            np.bitwise_xor.at(together, touched, np.tile(peeled, 3))
            ready = np.unique(touched)
            ready = ready[degree[ready] == 1]
        if left == 0:
            table = np.zeros(size, np.uint8)
            for peeled, at in reversed(rounds):
                a, b, c = slots[:, peeled]
                table[at] = mark[peeled] ^ table[a] ^ table[b] ^ table[c] ^ table[at]
            return seed, segment, count, table.tobytes()
        count += max(1, count // 50)
    raise RuntimeError("a binary fuse filter could not be built")


def may_contain(keys: np.ndarray, seed: int, segment: int, count: int, table: bytes) -> np.ndarray:
    """False only for keys that the filter was not built over."""
    fingerprints = np.frombuffer(table, np.uint8)
    a, b, c, mark = _slots(keys.astype(np.uint64), seed, segment, count)
    return mark == (fingerprints[a] ^ fingerprints[b] ^ fingerprints[c])


def _keys(digests: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(bytes(x)[:8] for x in digests), np.uint64)


# ------------------------------------------------------------- the operator


@dataclass
class Snapshot:
    """An immutable snapshot: its exact buckets (digest, text, keep_id, n), its filters and their number."""

    buckets: DataFrame
    filters: DataFrame
    n_filters: int


def _digested(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).try_cast("long").alias("doc_id"), text.alias("text"), F.unhex(F.sha2(text, 256)).alias("digest"))


def _grouped(rows: DataFrame) -> DataFrame:
    """One row for each text: texts are compared whole, and each task combines its copies before the shuffle."""
    return rows.groupBy("digest", "text").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("n"))


def _filter_no(n: int):
    return F.pmod(F.xxhash64("digest"), F.lit(n))


def build_snapshot(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", expected_batch: int = 0) -> Snapshot:
    """Freeze documents into exact buckets and binary fuse filters, written to the shared folder."""
    buckets = written(_grouped(_digested(docs, id_col, text_col)), "buckets")
    n = max(1, -(-max(buckets.count(), expected_batch) // KEYS_PER_FILTER))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        seed, segment, count, table = build_filter(_keys(pdf["digest"]))
        return pd.DataFrame({"filter_no": pdf["filter_no"].iloc[:1], "seed": [seed], "segment": [segment], "segments": [count], "fingerprints": [table]})

    keyed = buckets.select("digest", _filter_no(n).alias("filter_no"))
    filters = keyed.groupBy("filter_no").applyInPandas(build, "filter_no long, seed long, segment long, segments long, fingerprints binary")
    return Snapshot(buckets, written(filters, "filters"), n)


def screen(digests: DataFrame, snapshot: Snapshot) -> DataFrame:
    """Those rows of digests (digest, ...) that the snapshot's filters pass."""
    schema = "digest binary"

    def probe(key, pdf: pd.DataFrame, fil: pd.DataFrame) -> pd.DataFrame:
        if fil.empty or pdf.empty:
            return pdf[["digest"]].iloc[:0]
        x = fil.iloc[0]
        return pdf.loc[may_contain(_keys(pdf["digest"]), int(x.seed), int(x.segment), int(x.segments), x.fingerprints), ["digest"]]

    keyed = digests.select("digest", _filter_no(snapshot.n_filters).alias("filter_no"))
    return keyed.groupBy("filter_no").cogroup(snapshot.filters.groupBy("filter_no")).applyInPandas(probe, schema)


def dedup_batch(batch: DataFrame, snapshot: Snapshot, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(digest, keep_id, n) of each text of batch and snapshot together."""
    fresh = written(_grouped(_digested(batch, id_col, text_col)), "batch")
    passed = screen(fresh, snapshot)
    met = (
        fresh.join(passed, "digest", "left_semi").alias("b")
        .join(snapshot.buckets.alias("s"), (F.col("b.digest") == F.col("s.digest")) & (F.col("b.text") == F.col("s.text")))
        .select("b.digest", F.col("s.keep_id").alias("keep_id"), F.col("s.n").alias("n"))
    )
    mine = fresh.select("digest", "keep_id", "n", F.lit(1).alias("texts"))
    theirs = snapshot.buckets.select("digest", "keep_id", "n", F.lit(1).alias("texts"))
    # A text of both sides is counted in both; met takes one of its two rows away again.
    return (
        mine.unionByName(theirs).unionByName(met.select("digest", F.lit(None).cast("long").alias("keep_id"), F.lit(0).cast("long").alias("n"), F.lit(-1).alias("texts")))
        .groupBy("digest")
        .agg(F.max("keep_id").alias("keep_id"), F.sum("n").alias("n"), F.sum("texts").alias("texts"))
        .select("digest", "keep_id", F.when(F.col("texts") > 1, F.raise_error(F.lit("two texts share one SHA-256"))).otherwise(F.col("n")).alias("n"))
    )


def exact_dedup(docs: DataFrame, arrived: F.Column | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row for each row of docs.

    arrived tells the incoming batch from the snapshot that is already there (null: it is there); by default a document
    is incoming where the CRC-32 of its id is odd, so that copies fall on both sides and within each.
    """
    arrived = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 2 == 1 if arrived is None else F.coalesce(arrived, F.lit(False))
    # Filters are as many as either side asks for, so that a large batch doesn't meet a small snapshot in one task.
    with only_kept([]) as keep:
        snapshot = build_snapshot(docs.where(~arrived), id_col, text_col, expected_batch=docs.where(arrived).count())
        keep.append(groups := written(dedup_batch(docs.where(arrived), snapshot, id_col, text_col), "groups"))
    rows = _digested(docs, id_col, text_col).groupBy("doc_id", "digest").agg(F.count("*").alias("copies"))
    return (
        rows.alias("r").join(groups.alias("g").hint("merge"), F.col("r.digest") == F.col("g.digest"))
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
        .select(
            F.col("r.doc_id").alias("doc_id"),
            F.col("keep_id"),
            F.col("n").alias("group_size"),
            (F.col("r.doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
            F.lower(F.hex(F.col("r.digest"))).alias("text_sha256"),
        )
    )


def keep_first_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that exact_dedup keeps, with all their columns."""
    key = lambda ident, digest: F.concat_ws(":", digest, F.coalesce(ident.cast("string"), F.lit("null")))
    name = fresh(docs, "_key")
    kept = exact_dedup(docs, None, id_col, text_col).where("kept").select(key(F.col("doc_id"), F.col("text_sha256")).alias(name))
    rows = docs.withColumn(name, key(F.col(id_col).try_cast("long"), F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)))
    return rows.join(kept, name, "left_semi").dropDuplicates([name]).drop(name)
