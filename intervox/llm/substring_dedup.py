"""Substring dedup by prefix-partitioned suffix trees over words.

The suffixes of all texts, word by word, are split into memory-sized groups. A suffix is dealt by the pair of words of
smallest hash among its first WINDOW words, its anchor, so that equal suffixes meet, neighbouring suffixes mostly share
a group and travel as one stretch of words, and no suffix carries words of its own. The prefix that deals is of
variable length: an anchor that very many suffixes share gives way to rarer ones, and where all pairs of a suffix are
that frequent, its whole first WINDOW words deal it.

Within a group the suffixes are sorted by their words: words are numbered, and the ranks of prefixes of one, two, four
and at last WINDOW words follow from each other. Neighbours that agree in WINDOW words lie under one internal node of
that depth or more. A node's suffixes in documents after its smallest doc_id start a repeated window; neighbouring
ones make up the maximal repeats, whose words are removed. Hashes only choose groups; words are compared as they are.

A chunk of a task does so first for its own suffixes and ships those of its smallest document for each node alone, so
that a passage in a third of all documents is one stretch a chunk, not a long group.

Defined cases: null text has no words; texts shorter than the window lose none; texts of any length are taken whole;
rows with a null doc_id neither remove nor lose words; rows that repeat a doc_id don't remove each other's words and are
told apart by their text; of equal windows in several documents, those of the smallest doc_id stay; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import gram_hashes, mix64, partitions, slices, sorted_groups, text_buffers, word_bounds, word_hashes
from .mixing import word_count

WINDOW = 13
#: Words of an anchor.
ANCHOR = 2
#: Suffixes of one group on the average; words that a task handles at once; words of one bucket of documents.
GROUP, CHUNK, BUCKET = 900_000, 600_000, 1_000_000
#: The most anchors that are called frequent (a table of 8 bytes each), and the most partitions of a shuffle.
MOST_FREQUENT, MOST_PARTITIONS = 1 << 20, 1 << 17
NO_ID = -(1 << 63)
BLANK = 0x20


def _numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rank of each key among the distinct keys, and how often each of those occurs."""
    order = np.argsort(keys)
    ranked = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    out = np.empty(len(keys), np.int32)
    out[order] = np.cumsum(new, dtype=np.int32) - 1
    return out, np.diff(np.append(np.flatnonzero(new), len(keys)))


def late_windows(codes: np.ndarray, at: np.ndarray, ids: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Which of the suffixes that start at `at` lie under an internal node of depth `window` that has a smaller id.

    codes are the numbers of words; suffixes with a prefix of their own leave the sort as soon as it shows.
    """
    late = np.zeros(len(at), bool)
    if len(at) < 2:
        return late
    ranks, step = codes, 1
    counts = np.bincount(ranks)
    pair = lambda a, b: a * np.int64(len(counts)) + b
    while 2 * step <= min(window, 4):
        ranks, counts = _numbered(pair(ranks[: len(ranks) - step], ranks[step:]))
        step *= 2
    shared = counts[ranks] > 1
    offsets = [*range(0, window - step, step), window - step]
    on = np.flatnonzero(np.logical_and.reduce([shared[at + o] for o in offsets]))
    if not len(on):
        return late
    key = ranks[at[on]]
    for o in offsets[1:]:
        key, n = _numbered(pair(key, ranks[at[on] + o]))
        more = n[key] > 1
        on, key = on[more], key[more]
        if not len(on):
            return late
    order = np.argsort(key, kind="stable")
    cut = np.flatnonzero(np.diff(key[order], prepend=-1) != 0)
    least = np.minimum.reduceat(ids[on][order], cut)
    late[on[order]] = ids[on][order] > np.repeat(least, np.diff(np.append(cut, len(on))))
    return late


def _encoded(data: np.ndarray, offsets: np.ndarray) -> pa.DictionaryArray:
    """Words, each with the blank after it, as numbers into their distinct words."""
    words = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)])
    return words.dictionary_encode()


def _gathered(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The bytes of data from each start to its end, one after the other."""
    n = ends - starts
    return data[np.arange(int(n.sum())) + np.repeat(starts - (np.cumsum(n) - n), n)]


class Chunk:
    """Words of some documents, one after the other with a blank after each, and the documents' windows."""

    def __init__(self, ids: np.ndarray, tags: np.ndarray, counts: np.ndarray, lengths: np.ndarray, data: np.ndarray, window: int):
        self.ids, self.tags, self.data, self.window = ids, tags, data, window
        self.offsets = np.append(0, np.cumsum(lengths))
        encoded = _encoded(data, self.offsets)
        self.codes = encoded.indices.to_numpy()
        raw, at = text_buffers(encoded.dictionary.cast(pa.large_binary()).view(pa.large_string()))
        self.hashes = word_hashes(raw, at[:-1], at[1:] - 1)[self.codes]
        first, n = np.cumsum(counts) - counts, counts - window + 1
        self.doc = np.repeat(np.arange(len(n)), n)
        self.pos = np.arange(len(self.doc)) - np.repeat(np.cumsum(n) - n, n)
        self.at = first[self.doc] + self.pos


def chunks(batches, window: int = WINDOW, most: int = CHUNK):
    """Chunks of (doc_id, tag, text) batches; rows without an id or with too few words have no windows."""
    parts, held = [], 0
    for batch in batches:
        own = batch.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False)
        tag = batch.column(1).to_numpy(zero_copy_only=False)
        raw, offsets = text_buffers(batch.column(2))
        for first, last in slices(offsets):
            part, at = raw[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
            starts, ends, before = word_bounds(part, at)
            counts = np.diff(before)
            keep = (counts >= window) & (own[first:last] != NO_ID)
            if not keep.any():
                continue
            word = np.repeat(keep, counts)
            starts, ends = starts[word], ends[word]
            data = np.append(part, np.uint8(BLANK))
            data = _gathered(data, starts, ends + 1)
            data[np.cumsum(ends + 1 - starts) - 1] = BLANK
            parts.append((own[first:last][keep], tag[first:last][keep], counts[keep], ends + 1 - starts, data))
            held += len(starts)
            if held >= most:
                yield Chunk(*(np.concatenate(x) for x in zip(*parts)), window)
                parts, held = [], 0
    if parts:
        yield Chunk(*(np.concatenate(x) for x in zip(*parts)), window)


# ------------------------------------------------------------------- prefixes


def frequent_anchors(rows: DataFrame, total: int, group: int, window: int = WINDOW) -> np.ndarray:
    """Sorted hashes of the word pairs that `group` places or more hold, or one of MOST_FREQUENT parts of all if that is more.

    So there are at most MOST_FREQUENT of them, at any size of the input. Chunks name those that they hold half as often
    as that asks for, and twice; the table only balances groups, results don't depend on it.
    """
    least = max(group, -(-total // MOST_FREQUENT))

    def count(batches):
        for chunk in chunks(batches, window):
            _, at, n = np.unique(pairs := gram_hashes(chunk.hashes, ANCHOR), return_index=True, return_counts=True)
            often = n >= max(2, least * len(pairs) / (2 * total))
            yield pa.RecordBatch.from_pydict({"anchor": pairs[at[often]].view(np.int64), "n": n[often].astype(np.int64)})

    found = rows.mapInArrow(count, "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    return np.sort(found.select("anchor").toPandas()["anchor"].to_numpy(np.int64).view(np.uint64))


def prefixes(chunk: Chunk, frequent: np.ndarray) -> np.ndarray:
    """The hash of the prefix that deals each of the chunk's windows: its rarest anchor, or all its words."""
    rank = pairs = gram_hashes(chunk.hashes, ANCHOR)
    top = np.uint64(1 << 63)
    rank = pairs >> np.uint64(1)
    if len(frequent):
        often = frequent[np.minimum(np.searchsorted(frequent, pairs), len(frequent) - 1)] == pairs
        rank = np.where(often, rank | top, rank)
    # The smallest of the window's pairs, from the smallest of 2, 4, ... of them.
    wide, n = 1, chunk.window - ANCHOR + 1
    while 2 * wide <= n:
        rank = np.minimum(rank[: len(rank) - wide], rank[wide:])
        wide *= 2
    least = np.minimum(rank[chunk.at], rank[chunk.at + n - wide])
    if not len(frequent):
        return least
    return np.where(least >= top, gram_hashes(chunk.hashes, chunk.window)[chunk.at], least)


# ---------------------------------------------- packed records and their codec

_CODEC = pa.Codec("zstd", compression_level=1)
_PARTS = [("ids", np.int64), ("tags", np.uint16), ("pos", np.uint32), ("n", np.uint32)]
_FIELDS = "grp long, bucket long, runs long, size long, payload binary"
_NAMES = ["grp", "bucket", "runs", "size", "payload"]


def pack_runs(ids: np.ndarray, tags: np.ndarray, pos: np.ndarray, n: np.ndarray, data: np.ndarray | None = None) -> tuple[int, int, bytes]:
    """(runs, bytes, payload) of runs of windows: their document, first position, number, and the words if they travel."""
    parts = [np.diff(ids, prepend=np.int64(0)).astype(np.int64), tags.astype(np.uint16), pos.astype(np.uint32), n.astype(np.uint32)]
    whole = b"".join([x.tobytes() for x in parts] + ([data.tobytes()] if data is not None else []))
    return len(ids), len(whole), _CODEC.compress(whole, asbytes=True)


def unpack_runs(runs: int, size: int, payload) -> list[np.ndarray]:
    """ids, tags, pos, n and the words of pack_runs."""
    whole, at, out = _CODEC.decompress(payload, decompressed_size=size), 0, []
    for _, kind in _PARTS:
        out.append(np.frombuffer(whole, kind, runs, at))
        at += runs * np.dtype(kind).itemsize
    return [np.cumsum(out[0]), *out[1:], np.frombuffer(whole, np.uint8, offset=at) if at < size else np.zeros(0, np.uint8)]


def pack_texts(column: pa.Array) -> tuple[list[int], list[bytes | None]]:
    """The size of each text and its packed bytes, null where it is."""
    texts = [x.as_buffer() if x.is_valid else None for x in column]
    return [x.size if x is not None else 0 for x in texts], [_CODEC.compress(x, asbytes=True) if x is not None else None for x in texts]


def unpack_text(size: int, packed) -> bytes:
    return _CODEC.decompress(packed, size, asbytes=True)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * len(_NAMES)
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, [pa.int64()] * 4 + [pa.binary()])], names=_NAMES)


def _cuts(*keys: np.ndarray) -> np.ndarray:
    """Where a run of equal keys begins."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = np.logical_or.reduce([x[1:] != x[:-1] for x in keys])
    return np.flatnonzero(new)


def bucket_numbers(ids: np.ndarray, buckets: int) -> np.ndarray:
    return (mix64(ids.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)


def _flagged(ids: np.ndarray, tags: np.ndarray, pos: np.ndarray, buckets: int, groups: int) -> list[tuple]:
    """A row for each bucket of the flagged windows' documents, with their runs."""
    if not len(ids):
        return []
    bucket = bucket_numbers(ids, buckets)
    order = np.lexsort((pos, tags, ids, bucket))
    ids, tags, pos, bucket = ids[order].astype(np.int64), tags[order], pos[order].astype(np.int64), bucket[order]
    first = _cuts(ids, tags, pos - np.arange(len(pos)))
    n = np.diff(np.append(first, len(ids)))
    ids, tags, pos, bucket = ids[first], tags[first], pos[first], bucket[first]
    cut = _cuts(bucket)
    return [(int(bucket[a]) % groups, int(bucket[a]), *pack_runs(ids[a:b], tags[a:b], pos[a:b], n[a:b])) for a, b in zip(cut, [*cut[1:], len(ids)])]


# ------------------------------------------------------------- the operator


def repeated_windows(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", group: int = GROUP) -> tuple[DataFrame, int]:
    """(bucket, runs, size, payload): packed places of all repeated windows by bucket; and the number of buckets."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).try_cast("long").alias("doc_id"), _tag(text_col).alias("tag"), F.col(text_col).alias("text"))
    total = max(1, rows.agg(F.sum(word_count(F.col("text")))).first()[0] or 0)
    groups, buckets = max(partitions(spark), -(-total // group)), -(-total // BUCKET)
    frequent = frequent_anchors(rows, total, group, window)

    def ship(batches):
        for chunk in chunks(batches, window):
            ids, tags = chunk.ids[chunk.doc], chunk.tags[chunk.doc]
            late = late_windows(chunk.codes, chunk.at, ids, window)
            out = _flagged(ids[late], tags[late], chunk.pos[late], buckets, groups)
            kept = np.flatnonzero(~late)
            prefix = prefixes(chunk, frequent)[kept]
            first = _cuts(prefix, kept - np.arange(len(kept)), chunk.doc[kept])
            n, grp = np.diff(np.append(first, len(kept))), (mix64(prefix[first]) % np.uint64(groups)).astype(np.int64)
            order = np.argsort(grp, kind="stable")
            own, n, grp = kept[first][order], n[order], grp[order]
            cut = _cuts(grp)
            for a, b in zip(cut, [*cut[1:], len(own)]):
                x, m = own[a:b], n[a:b]
                words = _gathered(chunk.data, chunk.offsets[chunk.at[x]], chunk.offsets[chunk.at[x] + m + window - 1])
                out.append((int(grp[a]), None, *pack_runs(ids[x], tags[x], chunk.pos[x], m, words)))
            for a in range(0, len(out), 64):
                yield _rows(out[a : a + 64])

    def meet(batches):
        for table in sorted_groups(batches, ["grp"]):
            for batch in table.filter(pc.is_valid(table["bucket"])).to_batches():
                yield batch
            table = table.filter(pc.is_null(table["bucket"]))
            if not table.num_rows:
                continue
            parts = [unpack_runs(*x) for x in zip(table["runs"].to_pylist(), table["size"].to_pylist(), (x.as_buffer() for x in table["payload"]))]
            ids, tags, pos, n, data = (np.concatenate(x) for x in zip(*parts))
            codes = _encoded(data, np.append(0, np.flatnonzero(data == BLANK) + 1)).indices.to_numpy()
            n, words = n.astype(np.int64), n.astype(np.int64) + window - 1
            inside = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            run = np.repeat(np.arange(len(n)), n)
            late = late_windows(codes, (np.cumsum(words) - words)[run] + inside, ids[run], window)
            run = run[late]
            yield _rows(_flagged(ids[run], tags[run], pos[run] + inside[late], buckets, groups))

    # One group a task, and no task with several by chance, up to MOST_PARTITIONS groups.
    tasks = min(groups, MOST_PARTITIONS)
    shipped = rows.mapInArrow(ship, _FIELDS).repartitionById(tasks, (F.col("grp") % tasks).cast("int")).sortWithinPartitions("grp")
    return shipped.mapInArrow(meet, _FIELDS).drop("grp"), buckets


def _tag(text_col: str) -> F.Column:
    return F.pmod(F.xxhash64(text_col), F.lit(1 << 16)).cast("int")


def _covered(first: np.ndarray, n: np.ndarray, words: int, window: int) -> np.ndarray:
    """Which of a document's words the runs of n windows from each first one cover."""
    edge = np.zeros(words + 1, np.int64)
    np.add.at(edge, first, 1)
    np.add.at(edge, np.minimum(first + n + window - 1, words), -1)
    return np.cumsum(edge[:words]) > 0


def _by_document(docs: DataFrame, work, schema: str, window: int, id_col: str, text_col: str, group: int) -> DataFrame:
    """work(doc_id, words, covered) -> rows, over every document with its covered words."""
    flagged, buckets = repeated_windows(docs, window, id_col, text_col, group)
    names = [x.split()[0] for x in schema.split(", ")]
    types = pa.schema([(n, {"long": pa.int64(), "string": pa.string()}[x.split()[1]]) for n, x in zip(names, schema.split(", "))])

    def number(batches):
        for batch in batches:
            # Rows without an id have no flags to meet, and go anywhere.
            ids = pc.coalesce(batch.column(0), batch.column(1).cast(pa.int64()))
            bucket = bucket_numbers(ids.to_numpy(zero_copy_only=False), buckets)
            size, packed = pack_texts(batch.column(2))
            yield pa.RecordBatch.from_arrays([pa.array(bucket), *batch.columns[:2], pa.array(size, pa.int64()), pa.array(packed, pa.binary())], names=["bucket", "doc_id", "tag", "size", "packed"])

    rows = docs.select(F.col(id_col).try_cast("long").alias("doc_id"), _tag(text_col).alias("tag"), F.col(text_col).alias("text"))
    rows = rows.mapInArrow(number, "bucket long, doc_id long, tag int, size long, packed binary")

    def finish(own: pa.Table, flags: pa.Table) -> pa.Table:
        places: dict[tuple[int, int], list[tuple[np.ndarray, np.ndarray]]] = {}
        for x in zip(*[flags[c].to_pylist() for c in ("runs", "size", "payload")]):
            ids, tags, pos, n, _ = unpack_runs(*x)
            cut = _cuts(ids, tags)
            for a, b in zip(cut, [*cut[1:], len(ids)]):
                places.setdefault((int(ids[a]), int(tags[a])), []).append((pos[a:b], n[a:b]))
        out = []
        for doc_id, tag, size, packed in zip(own["doc_id"], own["tag"], own["size"].to_pylist(), own["packed"]):
            words = unpack_text(size, packed.as_buffer()).split() if packed.is_valid else []
            found = places.get((doc_id.as_py(), tag.as_py()))
            covered = np.zeros(len(words), bool)
            if found:
                covered = _covered(*(np.concatenate(x).astype(np.int64) for x in zip(*found)), len(words), window)
            out += work(doc_id.as_py(), words, covered)
        return pa.Table.from_pydict({n: [x[i] for x in out] for i, n in enumerate(names)}, schema=types)

    return rows.groupBy("bucket").cogroup(flagged.groupBy("bucket")).applyInArrow(finish, schema)


def substring_dedup(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", group: int = GROUP) -> DataFrame:
    """doc_id, n_words, n_removed, text (kept words joined by one space): one row for each row of docs."""

    def kept(doc_id, words, covered):
        left = [w for w, c in zip(words, covered) if not c] if covered.any() else words
        return [(doc_id, len(words), len(words) - len(left), b" ".join(left).decode())]

    return _by_document(docs, kept, "doc_id long, n_words long, n_removed long, text string", window, id_col, text_col, group)


def substring_digests(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", group: int = GROUP) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256: as substring_dedup, with the digest of the kept text in its place."""

    def kept(doc_id, words, covered):
        left = [w for w, c in zip(words, covered) if not c] if covered.any() else words
        return [(doc_id, len(words), len(words) - len(left), hashlib.sha256(b" ".join(left)).hexdigest())]

    return _by_document(docs, kept, "doc_id long, n_words long, n_removed long, kept_sha256 string", window, id_col, text_col, group)


def maximal_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", group: int = GROUP) -> DataFrame:
    """doc_id, first_word, n_words: the runs of words that repeat a document of smaller doc_id."""

    def spans(doc_id, words, covered):
        edge = np.flatnonzero(np.diff(np.r_[False, covered, False].astype(np.int8)))
        return [(doc_id, int(a), int(b - a)) for a, b in zip(edge[::2], edge[1::2])]

    return _by_document(docs, spans, "doc_id long, first_word long, n_words long", window, id_col, text_col, group)
