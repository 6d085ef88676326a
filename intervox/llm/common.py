"""Shared helpers of the training-data operators: shared tables, Arrow text buffers, rolling hashes."""

from __future__ import annotations

import contextlib
import functools
import tempfile
import threading
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one vectorised step takes at once; a longer text is a step of its own.
SLICE_BYTES = 1 << 20

_own_dir: list[str] = []
_scopes = threading.local()  # of this thread alone: other threads' tables are not ours to discard


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or in local mode one of our own."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    if not _own_dir:
        _own_dir.append("file://" + tempfile.mkdtemp(prefix="intervox-"))
    return _own_dir[0]


def written(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts the lineage and survives lost executors."""
    path = f"{shared_dir(df.sparkSession)}/intervox-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_to = path
    for scope in getattr(_scopes, "open", ()):
        scope.append(out)
    return out


@contextlib.contextmanager
def only_kept(keep: list[DataFrame]):
    """Of the tables that are written within, those put into keep stay; the others are discarded at the end."""
    made: list[DataFrame] = []
    around = getattr(_scopes, "open", ())
    _scopes.open = (*around, made)
    try:
        yield keep
    finally:
        _scopes.open = around
    discard(*[x for x in made if not any(x is y for y in keep)])


def discard(*tables: DataFrame) -> None:
    """Delete tables that written() gave and that nothing still to be computed reads; other frames stay."""
    for x in tables:
        if path := x.__dict__.pop("written_to", None):
            jvm, conf = x.sparkSession._jvm, x.sparkSession._jsparkSession.sessionState().newHadoopConf()
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(conf).delete(target, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df has not."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def join_small(left: DataFrame, right: DataFrame, on: list[str], how: str, max_rows: int = 100_000) -> DataFrame:
    """Join with a written narrow table: broadcast only where its counted rows are within max_rows."""
    if right.count() <= max_rows:
        return left.join(F.broadcast(right), on, how)
    return left.join(right.hint("merge"), on, how)


# ---------------------------------------------------------------- Arrow texts


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offset of each row; null counts as empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES):
    """Row ranges (first, last) of at most limit bytes, or of one row."""
    n, row = len(offsets) - 1, 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield row, min(end, n)
        row = end


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def word_bounds(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word (a run of bytes other than 20, 09-0D), and the words before each row."""
    inside = ~_SPACE[raw]
    cut = np.zeros(len(raw) + 1, bool)
    cut[offsets] = True
    before = np.zeros(len(raw), bool)
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | cut[:-1]))
    after = np.zeros(len(raw), bool)
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets, "left")


_BASE, _U64 = 0x9E3779B97F4A7C15, (1 << 64) - 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@functools.lru_cache(4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(n, _BASE, np.uint64)
    down = np.full(n, _BASE_INVERSE, np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes, from prefix sums of a polynomial modulo 2**64."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    n = max(SLICE_BYTES + (1 << 18), 1 << int(len(raw)).bit_length()) if len(raw) > SLICE_BYTES else SLICE_BYTES + (1 << 18)
    up, down = _powers(n)
    prefix = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE[raw] * up[: len(raw)], out=prefix[1:])
    return mix64((prefix[ends] - prefix[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of the k words from each position on (len(words) - k + 1 of them)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out = out * np.uint64(0xD6E8FEB86659FD93) + words[i : i + n]
    return mix64(out)


def sorted_groups(batches, keys: list[str]):
    """pa.Table of each run of equal keys in batches that come sorted by them; a run may span batches."""
    open_parts: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        change = np.zeros(batch.num_rows, bool)
        change[0] = not open_parts or any(open_parts[-1].column(k)[-1] != batch.column(k)[0] for k in keys)
        for k in keys:
            x = batch.column(k).to_numpy(zero_copy_only=False)
            change[1:] |= x[1:] != x[:-1]
        cuts = [*np.flatnonzero(change).tolist(), batch.num_rows]
        if not change[0]:
            cuts = [0, *cuts]
        elif open_parts:
            yield pa.Table.from_batches(open_parts)
            open_parts = []
        for a, b in zip(cuts[:-2], cuts[1:-1]):
            yield pa.Table.from_batches([*open_parts, batch.slice(a, b - a)])
            open_parts = []
        open_parts.append(batch.slice(cuts[-2], cuts[-1] - cuts[-2]))
    if open_parts:
        yield pa.Table.from_batches(open_parts)


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of edges (a, b): the smallest node of its connected component.

    Each round points every node to its smallest neighbour and contracts the edges by that; the tables of a round are
    written; beyond join_small's bound hot nodes are joined by sort-merge, whose skewed keys Spark splits.
    """
    steps = []
    edges = written(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "edges")
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("label"))
        steps.append(step := written(step, "step"))
        moved = join_small(edges, step.select(F.col("node").alias("a"), F.col("label").alias("to_a")), ["a"], "inner")
        moved = join_small(moved, step.select(F.col("node").alias("b"), F.col("label").alias("to_b")), ["b"], "inner")
        moved = moved.select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b"))
        done, edges = edges, written(moved.where("a < b").distinct(), "edges")
        discard(done)
        if edges.isEmpty():
            discard(edges)
            break
    labels = steps[0]
    for step in steps[1:]:
        nxt = step.select(F.col("node").alias("label"), F.col("label").alias("next"))
        done, labels = labels, written(join_small(labels, nxt, ["label"], "left").select("node", F.coalesce("next", "label").alias("label")), "labels")
        discard(done, step)
    return labels
