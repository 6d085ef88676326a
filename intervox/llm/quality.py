"""Quality classifier: hierarchical empirical Bayes over documents, paths and hosts.

A logistic model gives each document its evidence, from text statistics and from its words: their log odds in good and
bad labelled documents, by hashed word (LEXICON of them), where a labelled document's own words are left out when it is
fitted on. The labels that have a document are found first; of those a bounded sample in the order of a hash (LABELLED)
trains the model. All documents' evidence is then averaged by host and by path: Beta priors fitted by moments shrink
sparse paths toward their host and sparse hosts toward the global mean. The site's posterior replaces the global prior
odds in the document's odds; a document's own evidence is left out of its site's.

Sums are grouped aggregates that tasks combine first, so a hot host is one row a task. The site table is broadcast only
where its counted rows are within join_small's bound, else joined by sort-merge with skewed hosts split.

Defined cases: a text without words (null, empty, blank) scores 0 and is rejected; texts of any length are taken whole;
null hosts and paths count as ''; without labels of both classes all texts with words score the labels' mean, or 1
without labels; labels of no document, of a null doc_id or of another quality than 0 and 1 are ignored; a document with
both qualities counts as both; a score at the threshold is kept; repeated rows count as often as they occur; an empty
table gives an empty result; other columns are kept or ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, join_small, only_kept, slices, text_buffers, word_bounds, word_hashes, written

#: Labels that the document model is fitted on, at most; numbers that words are hashed into.
LABELLED, LEXICON = 20_000, 1 << 16
THRESHOLD = 0.5
#: Evidence is held within these log odds.
MOST_EVIDENCE = 12.0
SYMBOLS = "|*%$#&@^~<>{}[]\\/=+_`"
FEATURES = ["symbols", "bangs", "digits", "capitals", "repeats", "alike", "letters", "word_length", "words", "good_words", "bad_words"]

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(x) for x in SYMBOLS]] = True


class Lexicon:
    """How many good and bad labelled documents hold each hashed word, and the log odds that follow."""

    def __init__(self, bad: np.ndarray | None = None, good: np.ndarray | None = None, documents: tuple[float, float] = (0.0, 0.0)):
        self.seen = [np.zeros(LEXICON) if x is None else x.astype(float) for x in (bad, good)]
        self.documents = documents

    def odds(self, numbers: np.ndarray, own: np.ndarray | None = None) -> np.ndarray:
        """Log odds of words by their numbers; own is the class of the labelled document that each is from, left out."""
        share = []
        for k in (0, 1):
            out = 0.0 if own is None else (own == k).astype(float)
            share.append((np.maximum(self.seen[k][numbers] - out, 0) + 1) / (self.documents[k] - out + 2))
        return np.log(share[1]) - np.log(share[0])


def distinct_words(hashed: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hashed numbers of each text's distinct words, and how many the texts have."""
    found = [np.unique(hashed[a:b] & np.uint64(LEXICON - 1)) for a, b in zip(before[:-1], before[1:])]
    return np.concatenate([np.zeros(0, np.uint64), *found]).astype(np.int64), np.asarray([len(x) for x in found], np.int64)


def text_features(column: pa.Array, lexicon: Lexicon, own: np.ndarray | None = None) -> np.ndarray:
    """A row of FEATURES for each text; shares enter as log(1 + 1000 x), so that a few junk lines in a long text show."""
    raw, offsets = text_buffers(column)
    out = np.zeros((len(offsets) - 1, len(FEATURES)), np.float32)
    for first, last in slices(offsets):
        part, at = raw[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        starts, ends, before = word_bounds(part, at)
        hashed = word_hashes(part, starts, ends)
        same = np.r_[False, hashed[1:] == hashed[:-1]] if len(hashed) else np.zeros(0, bool)
        same[before[:-1][before[:-1] < len(same)]] = False
        total = lambda hit, cut=at: np.diff(np.r_[0, np.cumsum(hit)][cut])
        follows = (part & 0xC0) == 0x80
        accented = np.r_[False, part[:-1] == 0xC3] & (part >= 0x80) & (part <= 0x9E) & (part != 0x97)
        chars = np.maximum(total(~follows), 1)
        n = np.diff(before)
        numbers, distinct = distinct_words(hashed, before)
        odds = lexicon.odds(numbers, None if own is None else np.repeat(own[first:last], distinct))
        bounds, some = np.r_[0, np.cumsum(distinct)], np.maximum(distinct, 1)
        often = np.maximum(n, 1)
        letter = ((part | 0x20) >= 0x61) & ((part | 0x20) <= 0x7A) | (part >= 0xC0)
        log = lambda x: np.log1p(1000 * x)
        columns = (
            log(total(_SYMBOL[part]) / chars),
            log(total((part == 0x21) | (part == 0x3F)) / chars),
            log(total((part >= 0x30) & (part <= 0x39)) / chars),
            log(total((part >= 0x41) & (part <= 0x5A) | accented) / chars),
            log(total(same, before) / often),
            log(np.maximum(n - distinct, 0) / often),
            total(letter) / chars,
            np.log1p(chars / often),
            np.log1p(n),
            total(np.maximum(odds, 0), bounds) / some,
            total(np.maximum(-odds, 0), bounds) / some,
        )
        out[first:last] = np.stack(columns, axis=1)
    return out


def fit_logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(coefficients with the intercept first, means, scales) by Newton's method on standardised columns; a row counts n times."""
    mean = np.average(x, axis=0, weights=n)
    scale = np.sqrt(np.average((x - mean) ** 2, axis=0, weights=n))
    scale[scale < 1e-9] = 1.0
    a = np.hstack([np.ones((len(x), 1)), (x - mean) / scale])
    penalty = ridge * n.sum() * np.r_[1e-6, np.ones(x.shape[1])]
    w = np.zeros(a.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        gradient = a.T @ (n * (p - y)) + penalty * w
        hessian = (a * (n * (p * (1 - p) + 1e-9))[:, None]).T @ a + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w, mean, scale


def labelled_texts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", labelled: int = LABELLED) -> DataFrame:
    """(good, text) of the rows of docs that the sampled labels name, written; labels without a document take no part."""
    good = labels.select(F.col("doc_id").try_cast("long").alias("doc_id"), F.col("quality").try_cast("int").alias("good")).where("good in (0, 1) and doc_id is not null").distinct()
    named = good.join(docs.select(F.col(id_col).try_cast("long").alias("doc_id")), "doc_id", "left_semi")
    sample = written(named.orderBy(F.xxhash64("doc_id", "good"), "doc_id", "good").limit(labelled), "sample")
    texts = docs.select(F.col(id_col).try_cast("long").alias("doc_id"), F.col(text_col).alias("text")).join(F.broadcast(sample), "doc_id")
    return written(texts.select("good", "text"), "labelled")


def fit_lexicon(texts: DataFrame) -> Lexicon:
    """The lexicon of (good, text) rows, from grouped counts: two numbers for each hashed word at most reach the driver."""

    def count(batches):
        seen, documents = np.zeros((2, LEXICON), np.int64), np.zeros(2, np.int64)
        for batch in batches:
            own = batch.column(0).to_numpy().astype(np.int64)
            raw, offsets = text_buffers(batch.column(1))
            for first, last in slices(offsets):
                starts, ends, before = word_bounds(part := raw[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
                numbers, n = distinct_words(word_hashes(part, starts, ends), before)
                np.add.at(seen, (np.repeat(own[first:last], n), numbers), 1)
            documents += np.bincount(own, minlength=2)
        good, number = np.nonzero(seen)
        yield pa.RecordBatch.from_pydict({"good": np.r_[good, 0, 1], "number": np.r_[number, -1, -1], "n": np.r_[seen[good, number], documents]})

    rows = texts.mapInArrow(count, "good long, number long, n long").groupBy("good", "number").agg(F.sum("n").alias("n")).toPandas()
    words = rows[rows["number"] >= 0]
    seen = np.zeros((2, LEXICON))
    seen[words["good"], words["number"]] = words["n"]
    documents = rows[rows["number"] < 0].set_index("good")["n"].to_dict()
    return Lexicon(seen[0], seen[1], (documents.get(0, 0), documents.get(1, 0)))


def document_model(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", labelled: int = LABELLED) -> tuple[Lexicon, F.Column]:
    """The lexicon, and the column of a document's log odds of good quality over the columns FEATURES."""
    texts = labelled_texts(docs, labels, id_col, text_col, labelled)
    lexicon = fit_lexicon(texts)
    if min(lexicon.documents) == 0:
        share = lexicon.documents[1] / sum(lexicon.documents) if sum(lexicon.documents) else 1.0
        return lexicon, F.lit(float(np.clip(_logit(share), -MOST_EVIDENCE, MOST_EVIDENCE)))

    def describe(batches):
        for batch in batches:
            own = batch.column(0).to_numpy().astype(np.int64)
            x = text_features(batch.column(1), lexicon, own)
            yield pa.RecordBatch.from_arrays([pa.array(own), *[pa.array(x[:, i]) for i in range(len(FEATURES))]], names=["good", *FEATURES])

    kinds = f"good long, {', '.join(f'{x} float' for x in FEATURES)}"
    rows = texts.mapInArrow(describe, kinds).groupBy("good", *FEATURES).agg(F.count("*").alias("n")).toPandas()
    rows = rows.sort_values(["good", *FEATURES])
    w, mean, scale = fit_logistic(rows[FEATURES].to_numpy(float), rows["good"].to_numpy(float), rows["n"].to_numpy(float))
    odds = F.lit(float(w[0]))
    for c, m, s, name in zip(w[1:], mean, scale, FEATURES):
        odds = odds + F.lit(float(c / s)) * (F.col(name) - F.lit(float(m)))
    return lexicon, F.greatest(F.lit(-MOST_EVIDENCE), F.least(F.lit(MOST_EVIDENCE), odds))


def _logit(p: float) -> float:
    p = min(max(p, 1e-6), 1 - 1e-6)
    return math.log(p / (1 - p))


def _strength(groups: DataFrame, mean: F.Column) -> float:
    """Pseudo-count of the Beta prior over groups (n, s) about mean, by moments of their means."""
    m = F.col("s") / F.col("n")
    r = groups.where("n >= 2").agg(
        F.sum("n").alias("n"), F.count("*").alias("k"), F.sum(F.col("n") * (m - mean) ** 2).alias("between"), F.sum(mean * (1 - mean)).alias("within"), F.sum(mean * (1 - mean) * F.col("n")).alias("total")
    ).first()
    if not r["n"] or r["k"] < 2:
        return 10.0
    spread, noise = r["between"] / r["n"], r["within"] / r["n"]
    variance = max(spread - noise, 1e-6)
    return min(max(r["total"] / r["n"] / variance - 1, 1.0), 1e4)


def described(docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", path_col: str = "lang") -> DataFrame:
    """doc_id, row_key, host, path, n_words and FEATURES of each row of docs, written: the one pass over all texts."""
    site = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((host_col, "host"), (path_col, "path"))]
    names = ["doc_id", "row_key", "host", "path"]

    def describe(batches):
        for batch in batches:
            x = text_features(batch.column(4), lexicon)
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], *[pa.array(x[:, i]) for i in range(len(FEATURES))]], names=[*names, *FEATURES])

    rows = docs.select(F.col(id_col).try_cast("long").alias("doc_id"), F.xxhash64(text_col).alias("row_key"), *site, F.col(text_col).alias("text"))
    return written(rows.mapInArrow(describe, f"doc_id long, row_key long, host string, path string, {', '.join(f'{x} float' for x in FEATURES)}"), "described")


def scored(docs: DataFrame, labels: DataFrame, **cols) -> DataFrame:
    """doc_id, row_key, host, path, doc_score, host_score, path_score, score: one row for each row of docs."""
    with only_kept([]):
        lexicon, evidence = document_model(docs, labels, **{k: v for k, v in cols.items() if k in ("id_col", "text_col")})
    rows = described(docs, lexicon, **cols)
    rows = rows.withColumn("odds", F.when(F.col("words") > 0, evidence).otherwise(F.lit(-MOST_EVIDENCE)))
    p = 1 / (1 + F.exp(-F.col("odds")))
    paths = written(rows.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum(p).alias("s")), "paths")
    whole = paths.agg(F.sum("n"), F.sum("s")).first()
    mu = min(max((whole[1] or 0.0) / max(whole[0] or 0, 1), 1e-3), 1 - 1e-3)
    hosts = written(paths.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("s").alias("host_s")), "hosts")
    k_host = _strength(hosts.select(F.col("host_n").alias("n"), F.col("host_s").alias("s")), F.lit(mu))
    sites = paths.join(hosts.hint("merge"), "host")
    k_path = _strength(sites, (k_host * mu + F.col("host_s")) / (k_host + F.col("host_n")))
    rows = join_small(rows, written(sites, "sites"), ["host", "path"], "inner").withColumn("doc_score", p)
    host = (k_host * mu + F.greatest(F.lit(0.0), F.col("host_s") - F.col("doc_score"))) / (k_host + F.col("host_n") - 1)
    rows = rows.withColumn("host_score", host)
    path = (k_path * F.col("host_score") + F.greatest(F.lit(0.0), F.col("s") - F.col("doc_score"))) / (k_path + F.col("n") - 1)
    rows = rows.withColumn("path_score", F.least(F.lit(1 - 1e-6), F.greatest(F.lit(1e-6), path)))
    shift = F.ln(F.col("path_score") / (1 - F.col("path_score"))) - F.lit(_logit(mu))
    score = F.when(F.col("words") > 0, 1 / (1 + F.exp(-(F.col("odds") + shift)))).otherwise(F.lit(0.0))
    return rows.withColumn("score", score).select("doc_id", "row_key", "host", "path", "doc_score", "host_score", "path_score", "score")


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **cols) -> DataFrame:
    """doc_id, doc_score, host_score, path_score, score, keep: one row for each row of docs."""
    return scored(docs, labels, **cols).select("doc_id", "doc_score", "host_score", "path_score", "score", (F.col("score") >= threshold).alias("keep"))


def good_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", path_col: str = "lang") -> DataFrame:
    """The rows of docs that the classifier keeps, with all their columns."""
    key = lambda *parts: F.concat_ws("\0", *[F.coalesce(x.cast("string"), F.lit("null")) for x in parts])
    site = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (host_col, path_col)]
    good = scored(docs, labels, id_col=id_col, text_col=text_col, host_col=host_col, path_col=path_col).where(F.col("score") >= threshold)
    name = fresh(docs, "_key")
    good = good.select(key(F.col("doc_id"), F.col("row_key"), F.col("host"), F.col("path")).alias(name))
    return docs.withColumn(name, key(F.col(id_col).try_cast("long"), F.xxhash64(text_col), *site)).join(good, name, "left_semi").drop(name)
