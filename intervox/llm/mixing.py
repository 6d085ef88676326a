"""Mixing sources to target weights by cube-method balanced sampling.

Every document of a source has the same rate: target of the source over its size. The whole part of the rate is
taken as whole copies; the fraction is an inclusion probability that the cube method rounds to 0 or 1. Its flight
moves the probabilities of three units at a time through the null space of the two constraints (units and words of
the source), in groups of bounded size; what each group leaves undecided, two units at most, meets in the next, smaller
round, until one group a source is left, whose last units are landed next to the target.

Rows equal in doc_id, text and source are one unit of so many copies: of n copies at probability p the whole part of
n * p is taken once more for sure, and what is left over is the unit's own probability in the flight.

Targets are found over the table of sources: their weights by rank, and the level at which sources below three times
their size meet the whole, by Newton's method on a sum that grouped queries give; there may be any number of sources.

Defined cases: a null text has size 0; texts of any length are counted whole; null sources form the last source; a
document of size 0 takes no words; ties among sizes are in the order of doc_id (null ones last) and text; repeated rows
are so many rows of the result; an empty table gives an empty result; other columns are ignored, or kept by
mixed_documents, where repeated rows may differ in them.
"""

from __future__ import annotations

import itertools
import random

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, fresh, join_small, only_kept, written

#: Units of one flight group, and the most copies of a document.
GROUP, MOST_COPIES = 4096, 3
WEIGHTS = (1, 2, 3)


def word_count(text: F.Column) -> F.Column:
    """Runs of bytes other than 20, 09-0D; null has none."""
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: float = MOST_COPIES) -> DataFrame:
    """src (its rank), source, source_size, target of (source, source_size): shares of all by weight, none above cap times its size."""
    ordered = sizes.orderBy(F.col("source").isNull(), "source").select("source", "source_size", F.monotonically_increasing_id().alias("at"))
    ordered = written(ordered, "sources")
    # The number holds the sorted partition and the place in it; there are no more partitions than tasks.
    part = F.shiftright("at", 33)
    counts = ordered.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    before = counts.withColumn("before", F.sum("n").over(Window.orderBy("part")) - F.col("n")).drop("n")
    ranked = ordered.withColumn("part", part).join(F.broadcast(before), "part").select("source", "source_size", (F.col("before") + F.col("at") - F.shiftleft("part", 33)).alias("src"))
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), (F.col("src") % len(weights)).cast("int"))
    ranked = written(ranked.withColumn("weight", weight), "ranked")
    whole, level = ranked.agg(F.sum("source_size")).first()[0] or 0, 0.0
    while whole:
        # Sources that the level fills stay full at any higher one, so that it only rises, to the one at which all add up.
        full = F.lit(level) * F.col("weight") >= cap * F.col("source_size")
        taken, open_weight = ranked.agg(F.sum(F.when(full, cap * F.col("source_size"))), F.sum(F.when(~full, F.col("weight")))).first()
        if not open_weight:
            break
        raised = (whole - (taken or 0)) / open_weight
        if raised <= level:
            break
        level = raised
    return ranked.select("src", "source", "source_size", F.least(cap * F.col("source_size").cast("double"), F.lit(level) * F.col("weight")).alias("target"))


def flight(p: list[float], size: list[float], rng: random.Random) -> list[int]:
    """Move the probabilities p in place, keeping their sum and the sum of p * size; returns the undecided positions."""
    waiting: list[int] = []
    for i in range(len(p)):
        if 1e-9 < p[i] < 1 - 1e-9:
            waiting.append(i)
        else:
            p[i] = float(round(p[i]))
        while len(waiting) == 3:
            a, b, c = waiting
            u = (size[b] - size[c], size[c] - size[a], size[a] - size[b])
            if u == (0, 0, 0):
                u = (1.0, -1.0, 0.0)
            up = min((1 - p[k]) / x if x > 0 else p[k] / -x for k, x in zip(waiting, u) if x)
            down = min(p[k] / x if x > 0 else (1 - p[k]) / -x for k, x in zip(waiting, u) if x)
            step = up if rng.random() * (up + down) < down else -down
            for k, x in zip(waiting, u):
                p[k] = min(1.0, max(0.0, p[k] + step * x))
            rest = [k for k in waiting if 1e-9 < p[k] < 1 - 1e-9]
            for k in waiting:
                if k not in rest:
                    p[k] = float(round(p[k]))
            waiting = rest
    return waiting


def land(p: list[float], size: list[float], waiting: list[int]) -> None:
    """Decide the last documents of a source so that its words come nearest to what the probabilities promised."""
    wanted = sum(p[k] * size[k] for k in waiting)
    best = min(itertools.product((0, 1), repeat=len(waiting)), key=lambda take: (abs(sum(t * size[k] for t, k in zip(take, waiting)) - wanted), take))
    for t, k in zip(best, waiting):
        p[k] = float(t)


def _round(units: DataFrame, last: bool) -> DataFrame:
    def fly(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "row_key", "size"], na_position="last", kind="stable")
        p, size = pdf["p"].tolist(), pdf["size"].astype(float).tolist()
        waiting = flight(p, size, random.Random(f"{key[0]}/{key[1]}/{len(p)}"))
        if last:
            land(p, size, waiting)
        return pdf.assign(p=p)[["src", "doc_id", "row_key", "size", "p"]]

    return units.groupBy("src", "grp").applyInPandas(fly, "src long, doc_id long, row_key long, size long, p double")


def cube_sample(units: DataFrame, group: int = GROUP) -> DataFrame:
    """(src, doc_id, row_key, size, p) with p in [0, 1] -> the same rows with p 0 or 1, sums of p and p * size kept by src."""
    undecided, decided, level = units, None, 0
    while True:
        counts = written(undecided.groupBy("src").agg(F.count("*").alias("n")), "counts")
        last = (counts.agg(F.max("n")).first()[0] or 0) <= group
        groups = F.ceil(F.col("n") / F.lit(group // 2)).cast("long")
        grp = F.lit(0).cast("long") if last else F.pmod(F.xxhash64("doc_id", "row_key", F.lit(level)), groups)
        flown = written(_round(join_small(undecided, counts, ["src"], "inner").withColumn("grp", grp), last), f"flight{level}")
        discard(counts)
        done = flown.where("p = 0 or p = 1")
        decided = done if decided is None else decided.unionByName(done)
        if last:
            return decided
        undecided, level = flown.where("p > 0 and p < 1"), level + 1


def decided_units(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """doc_id, row_key, source, size, n (rows), source_size, target, whole, extra: all n rows are taken `whole` times, `extra` of them once more."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).try_cast("long").alias("doc_id"), F.xxhash64(text).alias("row_key"), F.col(source_col).cast("string").alias("source"), word_count(text).alias("size"))
    units = written(rows.groupBy("doc_id", "row_key", "source", "size").agg(F.count("*").alias("n")), "units")
    goals = written(source_targets(units.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), weights), "goals")
    key = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit(""))
    units = join_small(units.withColumn("src_key", key), goals.select(key.alias("src_key"), "src", "source_size", "target"), ["src_key"], "inner").drop("src_key")
    rate = F.when(F.col("source_size") > 0, F.least(F.lit(float(MOST_COPIES)), F.col("target") / F.col("source_size"))).otherwise(F.lit(0.0))
    units = units.withColumn("whole", F.floor(rate + 1e-12).cast("int"))
    more = F.greatest(F.lit(0.0), rate - F.col("whole")) * F.col("n")
    units = written(units.withColumn("sure", F.floor(more + 1e-12).cast("long")).withColumn("p", F.greatest(F.lit(0.0), more - F.col("sure"))), "rated")
    chosen = cube_sample(units.select("src", "doc_id", "row_key", "size", "p")).select(F.col("src").alias("c_src"), F.col("doc_id").alias("c_id"), F.col("row_key").alias("c_key"), F.col("size").alias("c_size"), F.col("p").cast("long").alias("one"))
    same = (F.col("src") == F.col("c_src")) & F.col("doc_id").eqNullSafe(F.col("c_id")) & (F.col("row_key") == F.col("c_key")) & (F.col("size") == F.col("c_size"))
    return units.join(chosen, same).select("doc_id", "row_key", "source", "size", "n", "source_size", "target", "whole", (F.col("sure") + F.col("one")).alias("extra"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """doc_id, row_key, source, size, source_size, target, copies, taken for each row of docs.

    row_key tells rows of one doc_id apart by their text; rows equal in doc_id, text and source may differ in copies by one.
    """
    units = decided_units(docs, id_col, text_col, source_col, weights)
    rows = units.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    copies = F.col("whole") + F.when(F.col("copy") <= F.col("extra"), 1).otherwise(0)
    return rows.select("doc_id", "row_key", "source", "size", "source_size", "target", copies.alias("copies"), (F.col("size") * copies).alias("taken"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of docs, each as often as the mix takes it."""
    key = lambda ident, row, src: F.concat_ws(":", F.coalesce(ident.cast("string"), F.lit("null")), row.cast("string"), F.coalesce(src, F.lit("\0")))
    name, n, whole, extra, times = (fresh(docs, x) for x in ("_key", "_n", "_whole", "_extra", "_times"))
    with only_kept([]) as keep:
        units = decided_units(docs, id_col, text_col, source_col).where("whole * n + extra > 0")
        keep.append(units := written(units.select(key(F.col("doc_id"), F.col("row_key"), F.col("source")).alias(name), F.col("n").alias(n), F.col("whole").alias(whole), F.col("extra").alias(extra)), "taken"))
    keyed = docs.withColumn(name, key(F.col(id_col).try_cast("long"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))), F.col(source_col)))
    rows = keyed.join(units, name)
    out = rows.where(F.col(n) == 1).withColumn(times, (F.col(whole) + F.col(extra)).cast("int"))
    if not units.where(F.col(n) > 1).isEmpty():
        # Repeated rows are counted, by all their columns, before they are numbered: equal ones are one row there.
        many = fresh(docs, "_count")
        several = rows.where(F.col(n) > 1).groupBy(*docs.columns, name, n, whole, extra).agg(F.count("*").alias(many))
        order = Window.partitionBy(name).orderBy(F.xxhash64(*[c for c, t in docs.dtypes if "map" not in t]))
        before = F.coalesce(F.sum(many).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        more = F.greatest(F.lit(0), F.least(F.col(many), F.col(extra) - before))
        several = several.withColumn(times, (F.col(many) * F.col(whole) + more).cast("int")).drop(many)
        out = out.unionByName(several.select(*out.columns))
    return out.where(F.col(times) > 0).withColumn(times, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*docs.columns)
