"""The llm queries against their SQL, and the stages of the corpus pipeline against brute-force versions."""

import random
from collections import Counter

import pytest
from oracle import check

import corpus_pipeline
from intervox.llm import queries
from intervox.llm.common import table, written


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, sf_dir, name):
    check(spark, sf_dir, queries.queries()[name], queries.oracle_sql()[name])


def test_language_accuracy_on_held_out_documents(spark, sf_dir):
    langs = {r["doc_id"]: r["lang"] for r in table(spark, sf_dir, "documents").collect()}
    held = [r for r in queries.op5_language_id(spark, sf_dir).collect() if r["held_out"]]
    assert sum(r["lang_pred"] == langs[r["doc_id"]] for r in held) / len(held) > 0.95


def test_stages(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    labels = {r["doc_id"]: r["quality"] for r in table(spark, sf_dir, "labels").collect()}
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        seen.append(written(stage(spark, seen[-1], sf_dir), "test"))
        assert seen[-1].columns == docs.columns
    first, good, unique, apart, mixed = [x.collect() for x in seen]
    kept = {r["doc_id"] for r in good}
    assert all((i in kept) for i, q in labels.items() if q == 1)
    assert sum(i in kept for i, q in labels.items() if q == 0) <= 0.1 * sum(q == 0 for q in labels.values())
    largest = {}
    for r in good:
        largest[r["text"]] = max(r["doc_id"], largest.get(r["text"], -1))
    assert {r["doc_id"] for r in unique} == set(largest.values()) and len(unique) == len(largest)
    from test_operators import WORD, brute_classes, brute_targets

    classes = brute_classes([r["text"] for r in unique], [r["doc_id"] for r in unique])
    assert {r["doc_id"] for r in apart} == {c for c, _ in classes.values()}
    times = Counter(r["doc_id"] for r in mixed)
    assert set(times) <= {r["doc_id"] for r in apart} and max(times.values()) <= 3
    whole, largest, taken = Counter(), Counter(), Counter()
    for r in apart:
        n = len(WORD.findall(r["text"] or ""))
        whole[r["source"]] += n
        largest[r["source"]] = max(n, largest[r["source"]])
        taken[r["source"]] += n * times[r["doc_id"]]
    goal = brute_targets(dict(whole))
    assert all(abs(taken[s] - goal[s]) <= largest[s] for s in goal)
    from intervox.llm import quality

    scores = quality.quality_scores(docs, table(spark, sf_dir, "labels")).collect()
    assert kept == {r["doc_id"] for r in scores if r["score"] >= quality.THRESHOLD}
    pieces = corpus_pipeline.STAGES[-1][1](spark, seen[-1], sf_dir).collect()
    assert Counter(r["doc_id"] for r in pieces if r["start"] == 0) == times


def odd_tables(spark, folder, rows):
    """documents with other columns of clashing names, and labels, as tables of a folder."""
    kind = "doc_id long, text string, lang string, source string, n_chars long, _key string, size long, digest binary, rep string"
    spark.createDataFrame([(i, t, g, s, 1, "k", 2, b"d", "r") for i, t, g, s in rows], kind).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (2, 0, 0), (None, 1, 0), (4, None, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")


@pytest.mark.parametrize("empty", [False, True])
def test_run_on_odd_and_empty_tables(spark, tmp_path, empty):
    rng = random.Random(4)
    long = " ".join(f"t{rng.randrange(10**6)}" for _ in range(30_000))
    near = long.replace(" ", "  ", 5)
    plain = [" ".join(f"w{rng.randrange(999)}" for _ in range(30)) for _ in range(6)]
    rows = [(1, plain[0], "en", "a"), (2, "$$$ %%% $$$ ***", None, None), (3, None, "en", "a"), (3, "", None, "b"), (None, plain[1], "de", None), (None, plain[2], "de", None)]
    rows += [(None, plain[2], "de", None), (7, plain[3], "en", "a"), (7, plain[4], "en", "b"), (7, plain[4], "en", "b"), (9, long, "en", "a"), (10, near, "en", "b"), (11, "  ", "en", "a")]
    odd_tables(spark, tmp_path, [] if empty else rows)
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, str(tmp_path)), "odd")
        assert docs.columns[:3] == ["doc_id", "text", "lang"] and len(docs.columns) == 9
        seen.append(Counter((r["doc_id"], (r["text"] or "")[:40], len(r["text"] or "")) for r in docs.collect()))
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    if empty:
        assert not out and not any(seen)
        return
    texts = [t for _, t, *_ in rows if t in [*plain[:5], long, near]]
    assert sorted(n for k, n in seen[0].items()) == sorted(Counter((i, t) for i, t, *_ in rows if t in texts).values())
    assert set(seen[1].values()) == {1} and len(seen[1]) == 7
    assert set(seen[2].values()) == {1} and len(seen[2]) == 6 and sum(n > 10_000 for _, _, n in seen[2]) == 1
    assert set(seen[3]) <= set(seen[2]) and max(seen[3].values()) <= 3
    assert Counter(r["doc_id"] for r in out if r["start"] == 0) == Counter(i for (i, _, _), n in seen[3].items() for _ in range(n))


def test_run_has_rows(spark, sf_dir):
    assert corpus_pipeline.run(spark, sf_dir).count() > 0 and corpus_pipeline.ORACLE_SQL is None
