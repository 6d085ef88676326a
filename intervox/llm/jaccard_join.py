"""N-gram Jaccard join by chosen paths.

Texts are sets of hashed word 5-grams. In each run a set goes down a tree: at the root it enters the children of those
of its tokens that the run's hash samples, 1 / (threshold * size) of them, so that similar sets meet in a child with a
known chance. Buckets of at most SMALL sets are brute-forced; larger ones are split again, to DEPTH, with SPLIT times
as many samples, so that a pair that met meets again. Runs repeat until a pair at the threshold, of any two sizes, is
met with the target recall in buckets of every depth. Members of a bucket are compared by one-permutation minhash
sketches well below the threshold, and linked along a spanning forest of what passes; the candidate groups so found are
verified by exact Jaccard, whole group against whole group, in tiles of TILE sets where they are large.

Equal texts are one set throughout (their copies share class and links), so no pairs of copies are made. No bucket or
group is cut: buckets are worked in pairs of parts of PART sets, and large groups in pairs of tiles, which are tasks'
work alike. In a bucket that stays over SMALL at the last level a set within LEADER of a leader of its part is left to
it first, and the leaders go on (Jaccard distance is a metric, so leaders of a pair at the threshold are 0.6 alike, and
candidates link down to LINK).

Defined cases: null text counts as empty; a text of one to four words is one shingle; a text without words has none
and no links; texts of any length are taken whole; rows that repeat a doc_id or have none are told apart by their text;
equal rows share the class; of equal smallest doc_ids either row may stand for a class, by the digest of its text; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, discard, fresh, gram_hashes, join_small, mix64, only_kept, partitions, slices, sorted_groups, text_buffers, word_bounds, word_hashes, written

WORDS, THRESHOLD, RECALL = 5, 0.8, 0.9999
#: Levels of a tree, and how many times 1 / (threshold * size) are sampled below the first.
DEPTH, SPLIT = 3, 3.0
#: Sets of a bucket that are compared pair by pair: half a CPU second for the largest, against texts read again and sent down.
SMALL = 4096
#: Sketch bins; estimates from which sets are linked, and from which one can be left to its leader.
BINS, LINK, LEADER = 128, 0.45, 0.9
#: Sets of one bucket part, and of one verification tile.
PART, TILE = 1024, 256


def survival(depth: int = DEPTH, split: float = SPLIT) -> float:
    """The chance that a pair at the threshold meets in a bucket of the last level of one run's tree.

    The pair whose smaller set lies within the larger one shares the fewest samples, one at the root and `split` at a
    node on the average; all other pairs share more.
    """
    met = 1.0
    for _ in range(depth - 1):
        met = 1 - math.exp(-split * met)
    return 1 - math.exp(-met)


def runs_for(recall: float = RECALL) -> int:
    """Runs until a pair at the threshold meets in buckets of every depth with the wanted chance."""
    return math.ceil(math.log(1 - recall) / math.log(1 - survival()))


def shingles(words: np.ndarray, k: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of a text's word k-grams; of all its words, if fewer."""
    if len(words) >= k:
        return np.unique(gram_hashes(words, k))
    return gram_hashes(words, len(words)) if len(words) else np.zeros(0, np.uint64)


def text_shingles(column: pa.Array):
    """The shingles of each text of an Arrow string column."""
    raw, offsets = text_buffers(column)
    for first, last in slices(offsets):
        at = offsets[first : last + 1] - offsets[first]
        part = raw[offsets[first] : offsets[last]]
        starts, ends, before = word_bounds(part, at)
        hashed = word_hashes(part, starts, ends)
        for a, b in zip(before[:-1], before[1:]):
            yield shingles(hashed[a:b])


_EDGES = (np.arange(BINS + 1, dtype=object) << (64 - BINS.bit_length() + 1))[:-1].astype(np.uint64)


def sketch(tokens: np.ndarray) -> bytes:
    """One-permutation minhash of sorted tokens: a byte for each of BINS ranges, 0 where the range is empty."""
    at = np.searchsorted(tokens, _EDGES)
    found = at < np.append(at[1:], len(tokens))
    out = np.zeros(BINS, np.uint8)
    out[found] = (mix64(tokens[at[found]]) % np.uint64(255) + np.uint64(1)).astype(np.uint8)
    return out.tobytes()


def alike(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity of each sketch of a to each of b."""
    full_a, full_b = (a > 0).astype(np.float32), (b > 0).astype(np.float32)
    either = full_a.sum(axis=1)[:, None] + full_b.sum(axis=1)[None, :] - full_a @ full_b.T
    bins, equal = np.ascontiguousarray(b.T), np.empty((len(a), len(b)), np.uint8)
    for i, x in enumerate(a):
        equal[i] = (bins == x[:, None]).view(np.uint8).sum(axis=0, dtype=np.uint8)
    # Bins that are empty in both are equal, but no match.
    return (equal - (a.shape[1] - either)) / np.maximum(either, 1)


def chosen_children(tokens: np.ndarray, nodes: np.ndarray, rate: float) -> np.ndarray:
    """The children of tree nodes that a set enters: rate / size of its tokens are sampled at each node."""
    limit = np.uint64(min(2**64 - 1, int(2**64 * rate / max(1, len(tokens)))))
    out = []
    for node in nodes:
        picked = mix64(tokens ^ node)
        out.append(mix64(picked[picked <= limit] + node))
    return np.unique(np.concatenate(out)) if out else np.zeros(0, np.uint64)


def roots(runs: int) -> np.ndarray:
    return mix64(np.arange(1, runs + 1, dtype=np.uint64))


def _first_of(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest label reachable over the pairs a, b."""
    while True:
        low = np.minimum(labels[a], labels[b])
        new = labels.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = np.minimum(new, new[new])
        if (new == labels).all():
            return labels
        labels = new


def link_bucket(sketches: np.ndarray, link: float = LINK, leader: float = LEADER) -> tuple[np.ndarray, np.ndarray]:
    """(component number of each row, numbers of the leaders) of the sets of one bucket.

    Each leader is compared to all rows that are left; rows within `leader` of it need no comparison of their own.
    """
    near, left, leaders, pairs = alike(sketches, sketches), np.arange(len(sketches)), [], []
    while len(left):
        first, left = left[0], left[1:]
        leaders.append(first)
        s = near[first, left]
        linked = left[s >= link]
        pairs.append(np.stack([np.full(len(linked), first), linked]))
        left = left[s < leader]
    a, b = np.concatenate(pairs, axis=1) if pairs else np.zeros((2, 0), int)
    return _first_of(np.arange(len(sketches)), a, b), np.asarray(leaders)


def _digested(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).try_cast("long").alias("doc_id"), text.alias("text"), F.unhex(F.sha2(text, 256)).alias("digest"))


def _sets(rows: DataFrame, runs: int) -> DataFrame:
    """One row for each text with words: rep (a number of its own), digest, doc_id (smallest), sketch, paths of the first level."""
    texts = rows.groupBy("digest", "text").agg(F.min("doc_id").alias("doc_id"))

    def describe(batches):
        for batch in batches:
            keep, marks, paths = [], [], []
            for i, tokens in enumerate(text_shingles(batch.column(1))):
                if len(tokens):
                    keep.append(i)
                    marks.append(sketch(tokens))
                    paths.append(chosen_children(tokens, roots(runs), 1 / THRESHOLD))
            picked = batch.take(pa.array(keep, pa.int64()))
            at = np.cumsum([0, *map(len, paths)]).astype(np.int32)
            flat = np.concatenate([np.zeros(0, np.uint64), *paths]).view(np.int64)
            yield pa.RecordBatch.from_arrays([picked.column(0), picked.column(2), pa.array(marks, pa.binary()), pa.ListArray.from_arrays(pa.array(at), pa.array(flat))], names=["digest", "doc_id", "sketch", "paths"])

    described = texts.mapInArrow(describe, "digest binary, doc_id long, sketch binary, paths array<bigint>")
    # Numbers of rows of a written table: they stay as they are once it is there.
    return written(described.select(F.monotonically_increasing_id().alias("rep"), "*"), "sets")


def _texts(rows: DataFrame, wanted: DataFrame, most_rows: int = 100_000) -> DataFrame:
    """wanted (rep, digest, doc_id, ...) with the text of each, one row a rep whatever number of copies there are."""
    wanted = wanted.select(*[F.col(c).alias(f"_{c}") for c in wanted.columns])
    wanted = F.broadcast(wanted) if wanted.count() <= most_rows else wanted.hint("merge")
    found = rows.join(wanted, (F.col("digest") == F.col("_digest")) & F.col("doc_id").eqNullSafe(F.col("_doc_id")))
    more = [c for c in wanted.columns if c not in ("_digest", "_doc_id")]
    return found.groupBy(*more).agg(F.first("text").alias("text")).select(*[F.col(c).alias(c[1:]) for c in more], "text")


def _buckets(sets: DataFrame, rows: DataFrame) -> DataFrame:
    """(path, n, rep): the buckets to brute-force, of at least two sets each."""
    found, brute = sets.select("rep", F.explode("paths").alias("path")), None
    for level in range(1, DEPTH + 1):
        counts = written(found.groupBy("path").agg(F.count("*").alias("n")).where("n > 1"), "counts")
        shared = written(join_small(found, counts, ["path"], "inner").select("path", "n", "rep"), f"shared{level}")
        discard(counts)
        last = level == DEPTH or shared.where(F.col("n") > SMALL).isEmpty()
        done = shared if last else shared.where(F.col("n") <= SMALL)
        brute = done if brute is None else brute.unionByName(done)
        if last:
            return brute
        found = _split(shared.where(F.col("n") > SMALL), sets, rows)


def _split(large: DataFrame, sets: DataFrame, rows: DataFrame) -> DataFrame:
    """(rep, path): the children that the members of large buckets (path, rep) enter."""
    nodes = written(large.groupBy("rep").agg(F.collect_list("path").alias("nodes")), "nodes")  # a set's own paths, some tens
    wanted = written(sets.select("rep", "digest", "doc_id").join(nodes, "rep", "left_semi"), "large")

    def descend(batches):
        for batch in batches:
            found = [chosen_children(tokens, nodes.values.to_numpy().view(np.uint64), SPLIT / THRESHOLD) for nodes, tokens in zip(batch.column(1), text_shingles(batch.column(2)))]
            rep = np.repeat(batch.column(0).to_numpy(), [len(x) for x in found])
            yield pa.RecordBatch.from_pydict({"rep": rep, "path": np.concatenate([np.zeros(0, np.uint64), *found]).view(np.int64)})

    return written(join_small(_texts(rows, wanted), nodes, ["rep"], "inner").select("rep", "nodes", "text").mapInArrow(descend, "rep long, path long"), "children")


def link_parts(a: np.ndarray, b: np.ndarray, link: float = LINK) -> tuple[np.ndarray, np.ndarray]:
    """Rows of sketches a and rows of sketches b whose links, with those within a and within b, connect what the two parts hold.

    Components within a part are found again and count as one, so that few links are left to tell.
    """
    own = [link_bucket(x, link, leader=2.0)[0] for x in (a, b)]
    labels = np.concatenate([own[0], own[1] + len(a)])
    rows, others, across = [], [], alike(a, b) >= link
    for i in np.flatnonzero(across.any(axis=1)):
        near = np.flatnonzero(across[i]) + len(a)
        if len(near := near[labels[near] != labels[i]]):
            at = np.unique(labels[near], return_index=True)
            rows += [i] * len(at[0])
            others += (near[at[1]] - len(a)).tolist()
            joined = np.isin(labels, [labels[i], *at[0]])
            labels[joined] = labels[joined].min()
    return np.asarray(rows, int), np.asarray(others, int)


def _marks(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """reps in order, and their sketches."""
    rep, marks = group["rep"].to_numpy(), np.frombuffer(b"".join(group["sketch"].to_pylist()), np.uint8).reshape(-1, BINS)
    order = np.argsort(rep, kind="stable")
    return rep[order], marks[order]


def _dealt(rows: DataFrame, group: str, part: str) -> DataFrame:
    """rows with equal group and part in one task: the pairs (low, high) of a group's parts go to tasks one after the other."""
    n = partitions(rows.sparkSession)
    place = F.col("high").cast("long") * (F.col("high") + 1) / 2 + F.col("low")
    task = F.pmod(F.pmod(F.xxhash64(group), F.lit(n)) + place.cast("long"), F.lit(n)).cast("int")
    return rows.repartitionById(n, task).sortWithinPartitions(group, part)


def _leaders(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(a, b) links to the leaders of the parts of buckets (path, n, rep, sketch), and the leaders as such rows, with n theirs."""
    parts = F.ceil(F.col("n") / F.lit(PART)).cast("int")
    rows = rows.withColumn("part", F.pmod(F.xxhash64("rep"), parts).cast("int"))

    def work(batches):
        for group in sorted_groups(batches, ["path", "part"]):
            rep, marks = _marks(group)
            to, leaders = link_bucket(marks)
            linked, path = np.flatnonzero(to != np.arange(len(to))), group["path"][0].as_py()
            yield pa.RecordBatch.from_pydict({"path": pa.nulls(len(linked), pa.int64()), "a": rep[to[linked]], "b": rep[linked], "sketch": pa.nulls(len(linked), pa.binary())})
            yield pa.RecordBatch.from_pydict({"path": pa.array([path] * len(leaders), pa.int64()), "a": rep[leaders], "b": rep[leaders], "sketch": pa.array([marks[i].tobytes() for i in leaders], pa.binary())})

    dealt = rows.select("path", "part", "rep", "sketch").repartition(partitions(rows.sparkSession), "path", "part").sortWithinPartitions("path", "part")
    found = written(dealt.mapInArrow(work, "path long, a long, b long, sketch binary"), "leaders")
    left = found.where("path is not null").select("path", F.col("a").alias("rep"), "sketch")
    sizes = written(left.groupBy("path").agg(F.count("*").alias("n")), "sizes")
    return found.where("path is null").select("a", "b"), join_small(left, sizes, ["path"], "inner")


def _candidate_links(buckets: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b): links along a spanning forest of each bucket's sketch graph."""
    marks, links = sets.select("rep", "sketch"), None
    large = buckets.where(F.col("n") > SMALL)
    rows = buckets.where(F.col("n") <= SMALL).join(marks, "rep").select("path", "n", "rep", "sketch")
    if not large.isEmpty():
        links, left = _leaders(large.join(marks, "rep"))
        rows = rows.unionByName(left.select(rows.columns))
    parts = F.ceil(F.col("n") / F.lit(PART)).cast("int")
    rows = rows.withColumn("mine", F.pmod(F.xxhash64("rep", F.lit(1)), parts).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
    rows = rows.withColumn("low", F.least("mine", "other")).withColumn("high", F.greatest("mine", "other"))
    rows = rows.withColumn("part", F.col("low") * parts + F.col("high")).select("path", "part", "low", "high", "mine", "rep", "sketch")

    def work(batches):
        for group in sorted_groups(batches, ["path", "part"]):
            if group.num_rows < 2:
                continue
            first, second = group["low"][0].as_py(), group["high"][0].as_py()
            if first == second:
                rep, own = _marks(group)
                to, _ = link_bucket(own, leader=2.0)
                b = np.flatnonzero(to != np.arange(len(to)))
                a, b = rep[to[b]], rep[b]
            else:
                mine = group["mine"].to_numpy()
                (rep, own), (others, theirs) = (_marks(group.filter(pa.array(mine == x))) for x in (first, second))
                a, b = link_parts(own, theirs)
                a, b = rep[a], others[b]
            yield pa.RecordBatch.from_pydict({"a": a, "b": b})

    found = written(_dealt(rows, "path", "part").mapInArrow(work, "a long, b long"), "links")
    return found if links is None else found.unionByName(links)


def jaccard_pairs(tokens: list[np.ndarray], threshold: float = THRESHOLD, block: int = 8192) -> tuple[np.ndarray, np.ndarray]:
    """Pairs a < b of sets whose exact Jaccard similarity is at least the threshold."""
    m, sizes = len(tokens), np.asarray([len(x) for x in tokens])
    owner = np.repeat(np.arange(m), sizes)
    _, token, counts = np.unique(np.concatenate(tokens), return_inverse=True, return_counts=True)
    shared = counts[token] > 1
    number = np.cumsum(counts > 1) - 1
    owner, token = owner[shared], number[token[shared]]
    order = np.argsort(token, kind="stable")
    owner, token = owner[order], token[order]
    both = np.zeros((m, m), np.float32)
    for first in range(0, int(token[-1]) + 1 if len(token) else 0, block):
        a, b = np.searchsorted(token, [first, first + block])
        x = np.zeros((m, block), np.float32)
        x[owner[a:b], token[a:b] - first] = 1
        both += x @ x.T
    union = sizes[:, None] + sizes[None, :] - both
    return np.nonzero(np.triu(both >= threshold * union - 1e-6, 1))


def _verified(groups: DataFrame, sets: DataFrame, texts: DataFrame) -> DataFrame:
    """(rep, label, links, tiled): exact links of each set within its candidate group."""
    sizes = written(groups.groupBy("label").agg(F.count("*").alias("n")), "sizes")
    members = join_small(groups, sizes, ["label"], "inner").withColumn("tiles", F.ceil(F.col("n") / F.lit(TILE)).cast("int"))
    members = members.withColumn("mine", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int")).select(F.col("node").alias("rep"), "label", "tiles", "mine")
    members = written(members.join(sets.select("rep", "digest", "doc_id"), "rep"), "members")
    rows = _texts(texts, members).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    rows = rows.withColumn("low", F.least("mine", "other")).withColumn("high", F.greatest("mine", "other"))
    rows = rows.withColumn("tile", F.col("low") * F.col("tiles") + F.col("high")).select("label", "tile", "low", "high", "tiles", "mine", "rep", "text")

    def verify(batches):
        for group in sorted_groups(batches, ["label", "tile"]):
            if group.num_rows < 2:
                continue
            group = group.sort_by("rep")
            rep = group["rep"].to_numpy()
            mine, tiles, across = group["mine"].to_numpy(), group["tiles"][0].as_py(), group["low"][0].as_py() != group["high"][0].as_py()
            a, b = jaccard_pairs(list(text_shingles(group["text"].combine_chunks())))
            if across:
                apart = mine[a] != mine[b]
                a, b = a[apart], b[apart]
            if not len(a):
                continue
            to = _first_of(np.arange(len(rep)), a, b)
            links = np.bincount(np.concatenate([a, b]), minlength=len(rep))
            some = np.flatnonzero(links)
            yield pa.RecordBatch.from_pydict({"rep": rep[some], "label": rep[to[some]], "links": links[some], "tiled": pa.array([tiles > 1] * len(some))})

    return written(_dealt(rows, "label", "tile").mapInArrow(verify, "rep long, label long, links long, tiled boolean"), "verified")


def jaccard_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", recall: float = RECALL) -> DataFrame:
    """doc_id, class_id, n_links, n_copies, row_digest, class_key: one row for each row of docs.

    class_id is the smallest doc_id of the documents that links and equality connect; n_links counts the other texts
    within the threshold of the document's text, n_copies the rows of its text. class_key tells classes apart also where
    doc_ids are null or repeat and several classes have one class_id; it is null for a text without words, a class by itself.
    """
    rows = _digested(docs, id_col, text_col)
    with only_kept([]) as kept:
        sets = _sets(rows, runs_for(recall))
        with only_kept([]) as keep:
            keep.append(groups := components(_candidate_links(_buckets(sets, rows), sets)))
        with only_kept([]) as keep:
            keep.append(verified := _verified(groups, sets, rows))
        classes = verified.groupBy("rep").agg(F.min("label").alias("label"), F.sum("links").alias("links"), F.max("tiled").alias("tiled"))
        if not verified.where("tiled").isEmpty():
            joined = components(verified.where("tiled").select(F.col("rep").alias("a"), F.col("label").alias("b")))
            joined = joined.select(F.col("node").alias("rep"), F.col("label").alias("whole"))
            classes = join_small(classes, joined, ["rep"], "left").withColumn("label", F.coalesce("whole", "label"))
        classes = written(classes.select("rep", "label", "links"), "classes")
        members = join_small(sets.select("digest", "doc_id", "rep"), classes, ["rep"], "left")
        # Only classes of several texts need the smallest of their doc_ids; a text alone has its own.
        least = written(members.where("label is not null").groupBy("label").agg(F.min("doc_id").alias("least")), "least")
        members = join_small(members, least, ["label"], "left")
        class_id = F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.col("least"))
        members = written(members.select("digest", class_id.alias("class_id"), F.coalesce("label", "rep").alias("class_key"), "links"), "members")
        copies = rows.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n_copies"))
        kept.append(texts := written(join_small(copies, members, ["digest"], "left").select("digest", F.coalesce("class_id", "first_id").alias("class_id"), F.coalesce("links", F.lit(0)).alias("n_links"), "n_copies", "class_key"), "texts"))
    return join_small(rows.select("doc_id", "digest"), texts, ["digest"], "inner").select("doc_id", "class_id", "n_links", "n_copies", F.col("digest").alias("row_digest"), "class_key")


def one_of_each_class(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs with one row of each class, that of the smallest doc_id, with all their columns."""
    kept = jaccard_classes(docs, id_col, text_col).where(F.col("doc_id").eqNullSafe(F.col("class_id")))
    key = lambda ident, digest: F.concat_ws(":", F.hex(digest), F.coalesce(ident.cast("string"), F.lit("null")))
    name = fresh(docs, "_key")
    wordless = F.when(F.col("class_key").isNull(), F.col("row_digest"))
    kept = kept.groupBy("class_key", wordless).agg(F.min(key(F.col("doc_id"), F.col("row_digest"))).alias(name)).select(name)
    rows = docs.withColumn(name, key(F.col(id_col).try_cast("long"), F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256))))
    return rows.join(kept, name, "left_semi").dropDuplicates([name]).drop(name)
