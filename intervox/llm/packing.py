"""Packing: shortest-pack-first over the length histogram of tokenised documents.

Documents longer than a sequence are cut into full sequences and a rest. The lengths of all rests form a histogram of
at most `capacity` bins; shortest-pack-first places the lengths, longest first, into packing patterns with counts,
and the patterns are joined back to the rests by their rank within a length. Ranks come from counts of bounded
chunks, so that no length is ranked in one task.

Defined cases: null text counts as empty, an empty document is its end id alone; texts of any length are cut into pieces
of capacity and a rest; repeated rows are packed as often as they occur; pieces of equal length are in the order of
doc_id, start and text within a chunk, and rows equal in all of these are interchangeable; rows without a doc_id are
packed too; special-token strings in a text are ordinary text; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import functools
import re
import struct
import unicodedata
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions, written

CAPACITY, END_ID = 2048, 1
#: Word pieces whose ids a worker remembers (twice, new ones and those before), the longest of them in characters, and
#: rows of one ranking chunk.
REMEMBERED, LONGEST, CHUNK = 400_000, 64, 20_000

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, row_key long"


def _plain() -> re.Pattern:
    """Matches a character for which Python's re and the tokenizer's pattern may differ on letter, number or space.

    Both agree where the character's category has been the same since Unicode 3.2 and is what re takes it for.
    """
    odd, first = [], None
    for c in range(0x10000):
        x = chr(c)
        kind, old = unicodedata.category(x), unicodedata.ucd_3_2_0.category(x)
        seen = "L" if x.isalpha() else "N" if x.isdecimal() else "A" if x.isalnum() else "S" if x.isspace() else ""
        real = kind[0] if kind[0] in "LN" else "S" if kind[0] == "Z" or c in (9, 10, 11, 12, 13, 0x85) else ""
        if (kind != old or seen != real or kind in ("Cs", "Cn")) == (first is None):
            if first is None:
                first = c
            else:
                odd.append((first, c - 1))
                first = None
    odd.append((first if first is not None else 0x10000, 0x10FFFF))
    return re.compile("[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in odd) + "]")


class Encoder:
    """Ids of a byte-level BPE tokenizer, remembered for each piece that its own pattern cuts a text into.

    A text with a character on which Python's re may differ from that pattern goes through the tokenizer whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.odd = _plain().search
        self.pieces = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+").findall
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        # The model works on printable characters that stand for bytes, as byte-level BPE defines them.
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        hidden = [b for b in range(256) if b not in shown]
        self.letters = dict(zip(shown, shown)) | {b: 0x100 + i for i, b in enumerate(hidden)}
        self.blank = chr(self.letters[0x20])

    def _learn(self, piece: str) -> bytes:
        if (ids := self.before.get(piece)) is None:
            if piece.isascii() and piece.isprintable():
                letters = piece.replace(" ", self.blank)
            else:
                letters = piece.encode().decode("latin-1").translate(self.letters)
            ids = struct.pack(f"<{len(found)}I", *found) if (found := [x.id for x in self.tokenizer.model.tokenize(letters)]) else b""
        if len(piece) <= LONGEST:
            if len(self.known) >= REMEMBERED:
                # What was used since the last time stays at hand; the rest goes.
                self.before = dict(self.known)
                self.known.clear()
            self.known[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Little-endian 32-bit ids."""
        if self.odd(text):
            return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        pieces, known = self.pieces(text), self.known.get
        found = list(map(known, pieces))
        if None in found:
            found = [ids or known(x) or self._learn(x) for x, ids in zip(pieces, found)]
        return b"".join(found)


@functools.lru_cache(1)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def tokenized_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, row_key: each document cut into full pieces and a rest."""
    end = np.asarray([END_ID], "<u4").tobytes()

    def cut(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encode = _encoder(tokenizer_path).encode
        for batch in batches:
            out = [[] for _ in range(6)]
            for doc_id, text, row_key in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                ids = encode(text.as_py() or "") + end
                n = len(ids) // 4
                for start in range(0, n, capacity):
                    piece = ids[4 * start : 4 * (start + capacity)]
                    for column, x in zip(out, (doc_id, start, len(piece) // 4, zlib.crc32(piece), n, row_key)):
                        column.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "row_key"])

    rows = docs.select(F.col(id_col).try_cast("long"), F.col(text_col), F.xxhash64(F.col(text_col)))
    return rows.mapInArrow(cut, PIECES)


def shortest_pack_first(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[int]]]:
    """(count, lengths) patterns, lengths longest first: each length goes to the open pack with the most room.

    Every step closes a length or uses a pattern up, so there are at most about two patterns for each length and room.
    """
    open_packs: dict[int, list[tuple[int, list[int]]]] = defaultdict(list)
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        room = capacity
        while left and room >= length:
            while not open_packs[room] and room >= length:
                room -= 1
            if room < length:
                break
            count, lengths = open_packs[room].pop()
            used = min(left, count)
            if count > used:
                open_packs[room].append((count - used, lengths))
            open_packs[room - length].append((used, [*lengths, length]))
            left -= used
        while left:
            each = capacity // length
            whole, rest = divmod(left, each)
            if whole:
                open_packs[capacity - each * length].append((whole, [length] * each))
                left = rest
            else:
                open_packs[capacity - rest * length].append((1, [length] * rest))
                left = 0
    return [x for packs in open_packs.values() for x in packs]


def slots(patterns: list[tuple[int, list[int]]], first_sequence: int = 0) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, end rank, first sequence, offset) of each place of each pattern."""
    out, rank, sequence = [], defaultdict(int), first_sequence
    for count, lengths in patterns:
        offset = 0
        for length in lengths:
            out.append((length, rank[length], rank[length] + count, sequence, offset))
            rank[length] += count
            offset += length
        sequence += count
    return out


def ranked(pieces: DataFrame) -> DataFrame:
    """pieces with rank, from 0, within their length; chunks of bounded size are ranked, then offset by counts."""
    spark = pieces.sparkSession
    # Repeated rows are one row with a number until they have ranks, so that none of them makes a chunk larger.
    pieces = pieces.groupBy(*pieces.columns).agg(F.count("*").alias("times"))
    n = max(partitions(spark), -(-pieces.count() // CHUNK))
    order = Window.partitionBy("chunk", "length").orderBy("doc_id", "start", "row_key")
    chunk = F.pmod(F.xxhash64("doc_id", "start", "row_key"), F.lit(n)).cast("int")
    inside = pieces.withColumn("chunk", chunk).withColumn("inside", F.sum("times").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("times"))
    counts = pieces.groupBy(chunk.alias("chunk"), "length").agg(F.sum("times").alias("n"))
    before = Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    ranked = inside.join(starts, ["chunk", "length"]).withColumn("rank", F.col("inside") + F.col("before"))
    ranked = ranked.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("times") - 1))).withColumn("rank", F.col("rank") + F.col("copy"))
    return ranked.drop("chunk", "inside", "before", "times", "copy")


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset: one row for each piece."""
    spark = docs.sparkSession
    pieces = written(tokenized_pieces(docs, tokenizer_path, capacity, id_col, text_col), "pieces")
    histogram = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}  # capacity rows at most
    full = histogram.pop(capacity, 0)
    places = [(capacity, 0, full, 0, 0)] * (full > 0) + slots(shortest_pack_first(histogram, capacity), full)
    # A few thousand rows: their number depends on the capacity alone.
    places = spark.createDataFrame(places, "p_length long, first long, last long, sequence long, offset long")
    fits = (F.col("length") == F.col("p_length")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("last"))
    return ranked(pieces).join(F.broadcast(places), fits).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("sequence") + F.col("rank") - F.col("first")).alias("sequence_id"), "offset"
    )
