"""Each operator against a brute-force version, and its defined cases: nulls, empty and long texts, ties, repeated
rows, empty tables, other columns with clashing names."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from intervox.llm import common, exact_dedup, jaccard_join, language_id, license_scan, line_dedup, mixing, packing, quality, substring_dedup, topk_search
from intervox.llm.queries import tokenizer_path

CLASH = "doc_id long, text string, lang string, source string, n_chars long, keep_id string, size string, digest string, word string, label string, _key string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def documents(spark, texts, ids=None, langs=None, sources=None):
    """Documents with other columns whose names operators use inside."""
    n = len(texts)
    ids, langs, sources = ids or list(range(n)), langs or ["en"] * n, sources or ["s"] * n
    return spark.createDataFrame([(i, t, g, s, 1, "a", "b", "c", "d", "e", "f") for i, t, g, s in zip(ids, texts, langs, sources)], CLASH)


def words(rng, n, size=400):
    return [f"w{rng.randint(0, size)}" for _ in range(n)]


@pytest.fixture(scope="module")
def texts():
    """Copies, near copies, shared passages, nulls, empty, blank and long texts."""
    rng = random.Random(11)
    passage, out = words(rng, 30, 5000), [None, "", "  ", "a", "a b c d", None]
    for k in range(40):
        base = words(rng, rng.randint(5, 300), 3000)
        if k % 3 == 0:
            at = rng.randint(0, len(base))
            base[at:at] = passage[: rng.randint(10, 30)]
        out.append(" ".join(base))
        for _ in range(k % 4):
            near = list(base)
            for _ in range(rng.randint(0, 3)):
                near[rng.randrange(len(near))] = "changed"
            out.append(("\n" if rng.random() < 0.3 else " ").join(near))
    out += [" ".join(words(rng, 40_000)), out[10], "é ü\tx\x0bß 日本 " * 5]
    return out


# ------------------------------------------------------------- shared helpers


def test_word_bounds_and_hashes():
    import pyarrow as pa

    rows = ["a bc", None, "", " d\x0be ", "é\tbc", "x" * 3]
    raw, offsets = common.text_buffers(pa.array(rows).slice(0))
    starts, ends, before = common.word_bounds(raw, offsets)
    found = [bytes(raw[a:b]).decode() for a, b in zip(starts, ends)]
    assert found == ["a", "bc", "d", "e", "é", "bc", "xxx"] and before.tolist() == [0, 2, 2, 2, 4, 6, 7]
    h = common.word_hashes(raw, starts, ends)
    assert h[1] == h[5] and len(set(h.tolist())) == 6
    raw, offsets = common.text_buffers(pa.array(rows).slice(3))
    assert len(common.word_bounds(raw, offsets)[0]) == 5


def test_tables_between_are_discarded(spark, tmp_path, monkeypatch):
    """Of what an operator writes, only what its result still reads is left in the shared folder."""
    monkeypatch.setattr(common, "shared_dir", lambda spark: f"file://{tmp_path}")
    df = documents(spark, ["a b c d e f", "a b c d e f g", "x y", "x y", None] * 3, ids=list(range(15)))
    left = {}
    for name, run in (("op6", jaccard_join.jaccard_classes), ("op2", exact_dedup.exact_dedup), ("op10", mixing.mixed_documents)):
        out, before = run(df), len(list(tmp_path.iterdir()))
        assert out.count() >= 15 or name == "op10"
        left[name] = before
    assert left == {"op6": 1, "op2": 2, "op10": 3}
    with common.only_kept([]) as keep:
        keep.append(common.written(df.select("doc_id"), "one"))
        other = common.written(df.select("doc_id"), "two")
    assert keep[0].count() == 15 and not hasattr(other, "written_to") and len(list(tmp_path.iterdir())) == 4


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(30)]
    label = {x: x for e in edges if e[0] != e[1] for x in e}
    for _ in label:
        for a, b in edges:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    got = {r[0]: r[1] for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == label


# ------------------------------------------------------------------ 1 line dedup


def test_line_dedup(spark):
    rows = [(i, "http://h.example/x", f"<p>Menu</p><div>own {i}</div><!-- <p>no</p> --><script>x</script>Menu") for i in range(4)]
    rows += [(4, "http://h.example/x", None), (5, None, "<p>Menu</p>"), (6, "http://one.example/", "<p>a</p><p>a</p>"), (6, "http://one.example/", "<p>a</p><p>a</p>"), (7, "x", "")]
    df = spark.createDataFrame([(*r, "c") for r in rows], "page_id long, url string, html string, host string")
    got = defaultdict(list)
    for r in line_dedup.line_dedup(df).collect():
        got[r["page_id"]].append((r["host"], r["n_lines"], r["n_removed"], r["text"]))
    assert got[0] == [("h.example", 3, 2, "own 0")] and got[4] == [("h.example", 0, 0, "")]
    assert got[5] == [("", 1, 0, "Menu")] and got[6] == [("one.example", 2, 0, "a\na")] * 2 and got[7] == [("", 0, 0, "")]
    assert line_dedup.line_dedup(df.limit(0)).count() == 0


def test_line_dedup_of_long_pages_and_ties(spark):
    """A page of 100,000 lines; a line in exactly the ratio of a host's pages stays, one in more goes."""
    rows = [(i if i else None, f"https://t.example/{i}", "<p>own%d</p>" % i + "<p>three</p>" * (i < 3) + "<p>four</p>" * (i < 4)) for i in range(10)]
    rows.append((99, "https://long.example/", "".join(f"<li>line {i}</li>" for i in range(100_000))))
    got = {r["page_id"]: r for r in line_dedup.line_dedup(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[None]["text"] == "own0\nthree" and got[3]["text"] == "own3" and got[3]["n_removed"] == 1
    assert got[99]["n_lines"] == 100_000 and got[99]["n_removed"] == 0


def test_line_dedup_joins_without_broadcast(spark, sf_dir, monkeypatch):
    pages = common.table(spark, sf_dir, "pages")
    want = sorted(map(tuple, line_dedup.line_dedup(pages).collect()))
    monkeypatch.setattr(line_dedup, "BROADCAST_LINES", 0)
    assert sorted(map(tuple, line_dedup.line_dedup(pages).collect())) == want


# ----------------------------------------------------------------- 2 exact dedup


def test_fuse_filter_has_no_false_negatives():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 10, 1000, 50_000):
        keys = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        built = exact_dedup.build_filter(keys)
        assert exact_dedup.may_contain(keys, *built).all()
        if n >= 1000:
            assert exact_dedup.may_contain(rng.integers(0, 2**63, 100_000, dtype=np.uint64), *built).mean() < 0.01
            assert len(built[3]) < 1.6 * n + 1000


@pytest.mark.parametrize("arrived", [None, "all", "none"])
def test_exact_dedup(spark, texts, arrived):
    df = documents(spark, texts)
    rule = None if arrived is None else F.lit(arrived == "all")
    groups = defaultdict(list)
    for i, t in enumerate(texts):
        groups[t or ""].append(i)
    got = {r["doc_id"]: r for r in exact_dedup.exact_dedup(df, rule).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        own = groups[t or ""]
        assert tuple(got[i]) == (i, max(own), len(own), i == max(own), hashlib.sha256((t or "").encode()).hexdigest())


def test_unknown_arrival_is_the_snapshot(spark):
    df = documents(spark, ["a", "a", "b", "c"], ids=[1, 2, 3, 4])
    arrived = F.when(F.col("doc_id") == 1, True).when(F.col("doc_id") == 3, False)
    got = sorted((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.exact_dedup(df, arrived).collect())
    assert got == [(1, 2, 2, False), (2, 2, 2, True), (3, 3, 1, True), (4, 4, 1, True)]


def test_filters_are_as_many_as_a_large_batch_asks_for(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "KEYS_PER_FILTER", 10)
    df = documents(spark, [f"t{i % 70}" for i in range(100)])
    assert exact_dedup.build_snapshot(df.limit(5), expected_batch=95).n_filters == 10
    got = exact_dedup.exact_dedup(df, F.col("doc_id") >= 5).collect()
    assert sum(r["kept"] for r in got) == 70 and all(r["group_size"] == (2 if r["doc_id"] % 70 < 30 else 1) for r in got)


def test_exact_dedup_odd_rows(spark):
    df = documents(spark, ["a", "a", "a", "b", "a"], ids=[1, 1, None, None, 0])
    got = sorted((repr(r["doc_id"]), repr(r["keep_id"]), r["group_size"], r["kept"]) for r in exact_dedup.exact_dedup(df).collect())
    assert got == [("0", "1", 4, False), ("1", "1", 4, False), ("1", "1", 4, True), ("None", "1", 4, False), ("None", "None", 1, True)]
    kept = exact_dedup.keep_first_copies(df)
    assert kept.columns == df.columns and sorted((repr(r["doc_id"]), r["text"]) for r in kept.collect()) == [("1", "a"), ("None", "b")]
    assert exact_dedup.exact_dedup(df.limit(0)).count() == 0


# ----------------------------------------------------------------- 3 top-k search


@pytest.mark.parametrize("shard, block", [(1 << 22, 4096), (40 * 8, 3)])
def test_top_k(spark, monkeypatch, shard, block):
    monkeypatch.setattr(topk_search, "SHARD", shard)
    monkeypatch.setattr(topk_search, "BLOCK", block)
    rng = np.random.default_rng(3)
    x = rng.normal(0, 0.3, (300, 8)).round(2)
    x[50:60] = x[50]  # ties
    rows = [(i, [float(v) for v in r], 1) for i, r in enumerate(x)]
    rows += [rows[20], rows[25], rows[25]]  # repeated rows are vectors of their own, of candidates as of queries
    rows += [(300, None, 1), (301, [float("nan")] * 8, 1), (302, [1.0, None], 1), (303, [float("inf")] * 8, 1), (304, [], 1), (305, [9.0], 1), (None, [1.0] * 8, 1), rows[7]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int")
    got = defaultdict(list)
    for r in topk_search.top_k(df, F.col("vec_id") % 25 == 0).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    again = [20, 25, 25, 7]
    q = np.vstack([np.floor(256 * x), np.floor(256 * x[again]), np.r_[256 * 9, np.zeros(7)][None]]).astype(int)
    ids = [*range(300), *again, 305]
    assert sorted(got) == list(range(0, 300, 25))
    for i in got:
        want = sorted((-int(q[k] @ q[i]), j) for k, j in enumerate(ids) if k != i)[:5]
        times = 3 if i == 25 else 1
        assert sorted(got[i]) == sorted([(j, -s) for s, j in want] * times)
        if times == 1:
            assert got[i] == [(j, -s) for s, j in want]


def test_top_k_stops_early_and_small_tables(spark):
    rng = np.random.default_rng(4)
    x = np.r_[rng.normal(0, 0.05, (3000, 16)), np.ones((6, 16))]
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    out = topk_search.top_k(df, F.col("vec_id") == 3000)
    assert {r["vec_id"] for r in out.collect()} == {3001, 3002, 3003, 3004, 3005} and out.first()["processed"] < 0.6
    assert topk_search.top_k(df.limit(3), F.col("vec_id") == 0).count() == 2
    assert topk_search.top_k(df.limit(1), F.col("vec_id") == 0).count() == topk_search.top_k(df.limit(0), F.lit(True)).count() == 0


# ----------------------------------------------------------------- 4 license scan


def test_license_scan(spark):
    mit = next(t for n, t in license_scan.TEMPLATES if t.startswith("permission is hereby"))
    rows = [
        "Released under the MIT License. mit-license",
        "see the GNU General Public License and the Apache  License",
        "Licensed under CC BY-NC 4.0.",
        "x " * 50 + mit.upper().replace("CHARGE", "cost") + " y" * 2000,
        "nothing about licenses here",
        None,
        "",
        "MİT license",
        "licensed under the " * 30,
    ]
    got = {r["doc_id"]: r for r in license_scan.license_scan(documents(spark, rows)).collect()}
    assert tuple(got[0])[1:] == (7, 2, 3, 5, "mit", "mit", 1.0)
    assert tuple(got[1])[1:7] == (10, 2, 3, 8, "apache,gpl", "apache,gpl")
    assert (got[2]["n_base"], got[2]["first_word"], got[2]["labels"], got[2]["score"]) == (0, None, "cc-by-nc", 1.0)
    assert got[3]["labels"] == "mit" and got[3]["n_base"] == 0 and 0.6 <= got[3]["score"] < 1
    for i in (4, 5, 6, 7, 8):
        assert (got[i]["n_base"], got[i]["labels"], got[i]["score"] < 0.6) == (0, "", True)
    assert got[5]["n_words"] == got[6]["n_words"] == 0 and got[7]["n_words"] == 2
    span = license_scan.license_spans(documents(spark, rows)).where("doc_id = 3").first()
    assert span["first_word"] == 50 and span["last_word"] == 50 + len(mit.split()) - 1
    twice = documents(spark, rows[:1] * 2, ids=[1, 1])
    assert [r["n_base"] for r in license_scan.license_scan(twice).collect()] == [2, 2]
    assert license_scan.license_scan(twice.limit(0)).count() == 0


def test_license_families(spark):
    """Each license of a family by its own word, whole license texts, and names that are no license."""
    whole = {label: max((t for n, t in license_scan.TEMPLATES if n == label), key=len) for label in ("mit", "isc", "bsd", "zlib", "apache")}
    rows = [
        ("a novel released under the MIT Press imprint", ""),
        ("Text under CC BY-NC-SA 4.0.", "cc-by-nc-sa"),
        ("CC BY 4.0, not CC BY-ND 4.0", "cc-by,cc-by-nd"),
        ("ISC License. " + whole["isc"].replace("software is provided", 'Software is provided "').title(), "isc"),
        ("1. " + whole["bsd"].replace("met redistributions", "met: 1. redistributions").replace("disclaimer redistributions", "disclaimer. 2. redistributions"), "bsd"),
        (whole["zlib"], "zlib"),
        ("x " + whole["mit"][400:] + " y", "mit"),
        ("under the GNU Lesser General Public License", "gpl,lgpl"),
        ("licensed under the Apache Software terms, version 2.0", ""),
    ]
    got = {r["doc_id"]: r["labels"] for r in license_scan.license_scan(documents(spark, [t for t, _ in rows])).collect()}
    assert [got[i] for i in range(len(rows))] == [x for _, x in rows]


def test_license_scan_of_rows_without_ids(spark):
    df = documents(spark, ["under the mit license", "under the mit license", "nothing", "x " * 50_000 + "apache license"], ids=[None, None, None, 3])
    got = sorted((r["n_words"], r["labels"]) for r in license_scan.license_scan(df).collect())
    assert got == [(1, ""), (4, "mit"), (4, "mit"), (50_002, "apache")]


# ------------------------------------------------------------------ 5 language ID


def test_language_id(spark):
    rng = random.Random(5)
    roots = {"aa": "the of and ing tion ble", "bb": "der ung sch keit lich ein", "cc": "que ment eux oir aux tre"}
    rows, langs = [], []
    for k in range(300):
        lang = sorted(roots)[k % 3]
        rows.append(" ".join("".join(rng.choice(roots[lang].split()) for _ in range(2)) for _ in range(rng.randint(3, 60))))
        langs.append(lang if k % 7 else None)
    rows += [None, "", "123 !!", rows[0]]
    langs += ["aa", "aa", "aa", "bb"]
    got = {r["doc_id"]: r for r in language_id.language_id(documents(spark, rows, langs=langs)).collect()}
    held = [i for i in got if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sorted(held) == sorted(i for i, r in got.items() if r["held_out"]) and len(got) == 304
    right = [got[i]["lang_pred"] == sorted(roots)[i % 3] for i in held if i < 300]
    assert sum(right) / len(right) > 0.97 and all(0 <= r["score"] <= 1 for r in got.values())
    assert [got[i]["lang_pred"] for i in (300, 301, 302)] == ["und"] * 3 and got[303]["lang_pred"] == got[0]["lang_pred"]
    none = documents(spark, ["abc", None], langs=[None, None], ids=[None, 5])
    none = none.withColumn("lang", F.lit(None).cast("string"))
    assert {(r["lang_pred"], r["score"]) for r in language_id.language_id(none).collect()} == {("und", 0.0)}
    assert language_id.language_id(none.limit(0)).count() == 0


def test_more_languages_than_the_model_learns(spark, monkeypatch):
    monkeypatch.setattr(language_id, "MOST_LANGUAGES", 3)
    rows = [(f"word{k % 5} " * 20, f"l{k % 5}") for k in range(100)] + [("dirty value", f"x{k}") for k in range(30)]
    got = {r["lang_pred"] for r in language_id.language_id(documents(spark, [t for t, _ in rows], langs=[g for _, g in rows])).collect()}
    assert len(got) <= 3 and got <= {f"l{k}" for k in range(5)}


def test_ids_take_no_part_in_learning(spark):
    """The same texts under other ids of the same parts give the same predictions and scores."""
    rng = random.Random(15)
    texts = [" ".join(rng.choice(["der", "die", "und", "ung"] if k % 2 else ["the", "and", "ing", "of"]) for _ in range(20 + k)) for k in range(120)]
    texts.append("very long " * 60_000)
    first = [i for i in range(2000) if zlib.crc32(str(i).encode()) % 5][: len(texts)]
    then = [i for i in range(5000, 9000) if zlib.crc32(str(i).encode()) % 5][: len(texts)]
    langs = ["de" if k % 2 else "en" for k in range(120)] + ["en"]
    told = [{t: (r["lang_pred"], r["score"]) for r, t in ((r, dict(zip(ids, texts))[r["doc_id"]]) for r in language_id.language_id(documents(spark, texts, ids, langs)).collect())} for ids in (first, then)]
    assert told[0] == told[1]


def test_temperature_softens_what_is_too_sure():
    rng = np.random.default_rng(0)
    labels = rng.integers(0, 2, 2000)
    logits = np.zeros((2000, 2))
    logits[np.arange(2000), np.where(rng.random(2000) < 0.7, labels, 1 - labels)] = 10.0
    assert abs(1 / (1 + np.exp(-10 / language_id.temperature(logits, labels))) - 0.7) < 0.02


def test_ftrl_is_sparse():
    rng = np.random.default_rng(1)
    ids = [np.r_[i % 2, rng.choice(np.arange(2, 2000), 30, replace=False)].astype(np.int32) for i in range(400)]
    w, _ = language_id.train(ids, [np.ones(31, np.int32)] * 400, np.arange(400) % 2, 2, np.ones(language_id.SIZE))
    assert w[0, 0] > 0 > w[0, 1] and (w == 0).mean() > 0.97


# ----------------------------------------------------------------- 6 Jaccard join


def shingle_set(text):
    w = WORD.findall(text or "")
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute_classes(texts, ids):
    sets = {t: shingle_set(t) for t in {t or "" for t in texts}}
    names = sorted(sets)
    links = {t: [u for u in names if u != t and sets[t] and sets[u] and len(sets[t] & sets[u]) >= 0.8 * len(sets[t] | sets[u]) - 1e-9] for t in names}
    first = {t: min(i for i, x in zip(ids, texts) if (x or "") == t) for t in names}
    label = dict(first)
    for _ in names:
        for t in names:
            for u in links[t]:
                label[t] = label[u] = min(label[t], label[u])
    return {i: (label[t or ""], len(links[t or ""])) for i, t in zip(ids, texts)}


@pytest.mark.parametrize("small, part, tile", [(64, 20_000, 256), (2, 3, 2)])
def test_jaccard_classes(spark, texts, monkeypatch, small, part, tile):
    for name, x in (("SMALL", small), ("PART", part), ("TILE", tile)):
        monkeypatch.setattr(jaccard_join, name, x)
    ids = random.Random(1).sample(range(1000), len(texts))
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in jaccard_join.jaccard_classes(documents(spark, texts, ids)).collect()}
    assert got == brute_classes(texts, ids)


def test_split_buckets_keep_the_recall():
    """Pairs at the threshold, where every bucket above the last level counts as large: the share that meets in one of
    the runs of production is the target, for sets of equal size and for one set within the other."""
    rng = np.random.default_rng(17)
    fresh = lambda n: rng.integers(0, 2**63, n, dtype=np.uint64)
    runs, pairs, singles = jaccard_join.runs_for(), 400, []
    for common_, own_a, own_b in ((16, 2, 2), (80, 10, 10), (80, 0, 20), (400, 50, 50), (400, 0, 100)):
        met, once = 0, 0
        for _ in range(pairs):
            both = fresh(common_)
            a, b = np.append(both, fresh(own_a)), np.append(both, fresh(own_b))
            assert len(both) / (common_ + own_a + own_b) == 0.8
            shared = None
            for level in range(jaccard_join.DEPTH):
                at, rate = (jaccard_join.roots(runs), 1 / 0.8) if level == 0 else (shared, jaccard_join.SPLIT / 0.8)
                shared = np.intersect1d(jaccard_join.chosen_children(a, at, rate), jaccard_join.chosen_children(b, at, rate))
            met += len(shared) > 0
            shared = None
            for level in range(jaccard_join.DEPTH):
                at, rate = (jaccard_join.roots(1), 1 / 0.8) if level == 0 else (shared, jaccard_join.SPLIT / 0.8)
                shared = np.intersect1d(jaccard_join.chosen_children(a, at, rate), jaccard_join.chosen_children(b, at, rate))
            once += len(shared) > 0
        assert met >= pairs - 1
        singles.append(once / pairs)
    assert min(singles) > jaccard_join.survival() - 0.1


def test_hot_tokens_split_and_lose_no_link(spark, monkeypatch):
    """A passage that all texts share makes hot buckets at every level; the pairs among them are found as by brute force."""
    monkeypatch.setattr(jaccard_join, "SMALL", 8)
    rng = random.Random(21)
    passage, texts = words(rng, 16, 10_000), []
    for i in range(300):
        own = words(rng, 60, 100_000)
        near = [*own[:-1], f"last{i}"]
        texts += [" ".join(passage + own), " ".join(passage + near)]
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in jaccard_join.jaccard_classes(documents(spark, texts)).collect()}
    assert got == {i: (i - i % 2, 1) for i in range(600)}


def test_whole_classes_of_texts_of_the_same_words(spark, monkeypatch):
    """Sets that are equal never split: their buckets are worked in parts, and all pairs of different texts are links."""
    for name, x in (("SMALL", 4), ("PART", 7), ("TILE", 5)):
        monkeypatch.setattr(jaccard_join, name, x)
    texts = ["one two three" + " " * i for i in range(40)] + ["four five"]
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in jaccard_join.jaccard_classes(documents(spark, texts)).collect()}
    assert got == {i: (0, 39) for i in range(40)} | {40: (40, 0)}


def test_jaccard_large_group(spark):
    rng = random.Random(8)
    base = words(rng, 120, 10_000)
    texts = []
    for i in range(400):
        t = list(base)
        t[rng.randrange(120)] = f"x{i}"
        texts.append(" ".join(t))
    got = jaccard_join.jaccard_classes(documents(spark, texts)).collect()
    want = brute_classes(texts, range(400))
    assert {r["doc_id"]: (r["class_id"], r["n_links"]) for r in got} == want


def test_jaccard_odd_rows(spark):
    long = " ".join(f"t{i}" for i in range(60))
    df = documents(spark, [long, long + " end", long, "a b", None, "other words in here now", long], ids=[5, 5, None, 5, 5, None, 9])
    got = jaccard_join.jaccard_classes(df).collect()
    assert len(got) == 7 and sum(r["n_links"] == 1 for r in got) == 4
    one = jaccard_join.one_of_each_class(df)
    assert one.columns == df.columns and Counter(r["text"] in (long, long + " end") for r in one.collect())[True] == 1
    assert jaccard_join.jaccard_classes(df.limit(0)).count() == 0


def test_unrelated_texts_stay_where_ids_are_null_or_repeat(spark):
    long = " ".join(f"t{i}" for i in range(60))
    alone = ["a b", "other words in here now", "some more words that are alone", "nothing like the rest of these", "  ", None]
    df = documents(spark, [long, long + " end", long, *alone, "a b", "last of all these texts"], ids=[5, 5, None, 5, None, None, 5, None, 5, 5, 7])
    one = Counter(r["text"] for r in jaccard_join.one_of_each_class(df).collect())
    assert one.pop(long, 0) + one.pop(long + " end", 0) == 1
    assert one == Counter([*alone, "last of all these texts"])
    keys = {r["class_key"] for r in jaccard_join.jaccard_classes(df).where("class_key is not null").collect()}
    assert len(keys) == 6


def test_linking_through_leaders_keeps_groups_whole():
    rng = np.random.default_rng(3)
    base = np.sort(rng.integers(0, 2**63, 300, dtype=np.uint64))
    sets = []
    for _ in range(60):
        own = base.copy()
        own[rng.choice(300, 10, replace=False)] = rng.integers(0, 2**63, 10, dtype=np.uint64)
        sets.append(np.unique(own))
    marks = np.stack([np.frombuffer(jaccard_join.sketch(s), np.uint8) for s in [*sets, np.unique(rng.integers(0, 2**63, 300, dtype=np.uint64))]])
    to, leaders = jaccard_join.link_bucket(marks)
    assert set(to[:60]) == {0} and to[60] == 60 and len(leaders) < 61


def test_links_of_two_parts_connect_them():
    """Links within each part and between them make the components that all pairs of sketches make."""
    rng = np.random.default_rng(5)
    bases = [np.sort(rng.integers(0, 2**63, 200, dtype=np.uint64)) for _ in range(12)]
    sets = []
    for _ in range(90):
        own = bases[rng.integers(12)].copy()
        own[rng.choice(200, 25, replace=False)] = rng.integers(0, 2**63, 25, dtype=np.uint64)
        sets.append(np.unique(own))
    marks = np.stack([np.frombuffer(jaccard_join.sketch(s), np.uint8) for s in sets])
    whole, _ = jaccard_join.link_bucket(marks, leader=2.0)
    a, b = jaccard_join.link_parts(marks[:50], marks[50:])
    pairs = [(i, j) for part, off in ((marks[:50], 0), (marks[50:], 50)) for i, j in enumerate(jaccard_join.link_bucket(part, leader=2.0)[0] + off, off)]
    pairs += [*zip(a, b + 50)]
    got = jaccard_join._first_of(np.arange(90), *np.asarray(pairs).T)
    assert got.tolist() == whole.tolist() and len(a) < 30


# --------------------------------------------------------------- 7 substring dedup


def brute_substrings(texts, ids, window=13):
    seen = {}
    split = [WORD.findall(t or "") for t in texts]
    for i, w in zip(ids, split):
        for p in range(len(w) - window + 1):
            if i is not None:
                g = tuple(w[p : p + window])
                seen[g] = min(i, seen.get(g, i))
    for i, w in zip(ids, split):
        gone = set()
        for p in range(len(w) - window + 1):
            if i is not None and seen[tuple(w[p : p + window])] < i:
                gone |= set(range(p, p + window))
        left = " ".join(x for p, x in enumerate(w) if p not in gone)
        yield i, len(w), len(gone), hashlib.sha256(left.encode()).hexdigest()


@pytest.mark.parametrize("group, chunk, bucket", [(substring_dedup.GROUP, 1_000_000, 1_000_000), (30, 500, 700)])
def test_substring_digests(spark, texts, monkeypatch, group, chunk, bucket):
    monkeypatch.setattr(substring_dedup, "BUCKET", bucket)
    monkeypatch.setattr(substring_dedup.chunks, "__defaults__", (13, chunk))
    rng = random.Random(3)
    ids = rng.sample(range(1000), len(texts) - 2) + [None, 7000]
    texts = [*texts, "the the the " * 20, "the the the " * 30, " ".join(["one two"] * 40), "x " + " ".join(["one two"] * 30)]
    ids += [7001, 7002, 7003, 7004]
    got = substring_dedup.substring_digests(documents(spark, texts, ids), group=group).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, brute_substrings(texts, ids)))


@pytest.mark.parametrize("size", [2, 30])
def test_nodes_equal_brute_force(size):
    """Suffix ranks against all windows as tuples, over random words of a small and a larger vocabulary."""
    rng = np.random.default_rng(size)
    for window in (2, 3, 5, 8, 13):
        codes, ids = rng.integers(0, size, 600), np.repeat(rng.permutation(6), 100)
        codes[350:390] = codes[20:60]
        at = np.concatenate([np.arange(k * 100, (k + 1) * 100 - window + 1) for k in range(6)])
        least = {}
        for p in at:
            g = tuple(codes[p : p + window])
            least[g] = min(ids[p], least.get(g, 99))
        want = [ids[p] > least[tuple(codes[p : p + window])] for p in at]
        assert substring_dedup.late_windows(codes, at, ids[at], window).tolist() == want


def test_words_decide_where_hashes_collide(spark, texts, monkeypatch):
    """With one hash for all words every suffix has the same anchor; the result rests on the words and is the same."""
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array([1, 2, 3], pa.int64()), "tag": pa.array([0, 0, 0], pa.int32()), "text": ["a b c d e f", "z b c d e f", "a b c q e f"]})
    monkeypatch.setattr(substring_dedup, "word_hashes", lambda raw, starts, ends: np.ones(len(starts), np.uint64))
    chunk = next(substring_dedup.chunks([batch], 5))
    assert len(set(substring_dedup.prefixes(chunk, np.zeros(0, np.uint64)).tolist())) == 1
    assert substring_dedup.late_windows(chunk.codes, chunk.at, chunk.ids[chunk.doc], 5).tolist() == [False, False, False, True, False, False]


def test_substring_other_forms(spark):
    shared = " ".join(f"s{i}" for i in range(60))
    df = documents(spark, ["a " + shared, shared + " b\nc", shared, shared + " x"], ids=[1, 2, 3, 3])
    kept = {r["text"] for r in substring_dedup.substring_dedup(df).collect()}
    assert kept == {"a " + shared, "b c", "", "x"}
    assert [tuple(r) for r in substring_dedup.maximal_repeats(df).where("doc_id = 2").collect()] == [(2, 0, 60)]
    assert substring_dedup.substring_digests(df.limit(0)).count() == 0


def test_frequent_anchors_give_way(spark):
    rng = random.Random(9)
    texts = [" ".join(["the", "same"] * 10 + words(rng, 200)) for _ in range(30)]
    df = documents(spark, texts).select("doc_id", F.lit(0).alias("tag"), "text")
    frequent = substring_dedup.frequent_anchors(df, 30 * 220, 200)
    assert len(frequent) == 2  # the same, same the
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array([1], pa.int64()), "tag": pa.array([0], pa.int32()), "text": texts[:1]})
    chunk = next(substring_dedup.chunks([batch]))
    dealt = substring_dedup.prefixes(chunk, frequent)
    assert len(set(dealt[:8].tolist())) == 2 and len(set(dealt[8:].tolist())) < 0.35 * len(dealt)


def test_runs_travel_whole():
    ids, tags, pos, n = np.asarray([5, -9, 1 << 60]), np.asarray([1, 65535, 0]), np.asarray([0, 7, 1 << 31]), np.asarray([1, 2, 70_000])
    data = np.frombuffer(b"a bc ", np.uint8)
    got = substring_dedup.unpack_runs(*substring_dedup.pack_runs(ids, tags, pos, n, data))
    assert [x.tolist() for x in got] == [x.tolist() for x in (ids, tags, pos, n, data)]


# ----------------------------------------------------------------------- 8 packing


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    t.encode_special_tokens = True
    return t


ODD = ["it's  we'll\n\n x\t\t", "<|endoftext|>", "a²b ½ 日本 😀_x__ y", "\x1c \x85   x", "١٢٣ 12a", "ſ'S don't", None, ""]


def test_packing_is_an_exact_round_trip(spark, texts, tokenizer):
    texts = texts + ODD
    df = documents(spark, texts)
    rows = packing.pack(df, tokenizer_path()).collect()
    by = defaultdict(list)
    for r in rows:
        by[r["doc_id"]].append(r)
    for i, t in enumerate(texts):
        ids = np.asarray(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        at = 0
        for r in sorted(by[i], key=lambda r: r["start"]):
            part = ids[r["start"] : r["start"] + r["length"]]
            assert r["start"] == at and r["length"] == len(part) > 0 and r["doc_tokens"] == len(ids) and r["ids_crc32"] == zlib.crc32(part.tobytes())
            at += r["length"]
        assert at == len(ids)
    gapless(rows)


def test_encoder_equals_the_tokenizer(tokenizer, monkeypatch):
    """Random texts of letters, digits, signs, quotes and blanks, with a memory that is full again and again."""
    monkeypatch.setattr(packing, "REMEMBERED", 40)
    encoder, rng = packing.Encoder(tokenizer_path()), random.Random(31)
    for k in range(4000):
        alphabet = ["ab cd  ef", "a's 't l'll \n", "é1 2ü,.", "x\t\r\u00a0 \n\n y", "Wörter und, Zeichen. Noch\nmehr 12"][k % 5]
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40)))
        if k % 3 == 0:
            text = " ".join(text.split())
        got = np.frombuffer(encoder.encode(text), "<u4").tolist()
        assert got == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def gapless(rows, capacity=2048):
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert sorted(sequences) == list(range(len(sequences)))
    return len(sequences)


def test_packing_pads_little_and_keeps_repeated_rows(spark):
    rng = random.Random(6)
    texts = [" ".join(words(rng, int(rng.expovariate(1 / 300)) + 1)) for _ in range(800)]
    rows = packing.pack(documents(spark, texts * 2, ids=[*range(800)] * 2), tokenizer_path()).collect()
    used = sum(r["length"] for r in rows)
    assert gapless(rows) <= 1.02 * used / 2048 + 1
    assert Counter((r["doc_id"], r["start"]) for r in rows).most_common()[-1][1] == 2
    assert packing.pack(documents(spark, texts).limit(0), tokenizer_path()).count() == 0


def test_many_equal_rows_are_ranked_as_one(spark):
    """A thousand equal rows, rows without ids and an empty text each get a place of their own."""
    df = documents(spark, ["same text here"] * 1000 + ["other"] * 3 + [None, "word " * 30_000], ids=[5] * 1000 + [None] * 3 + [6, 7])
    rows = packing.pack(df, tokenizer_path()).collect()
    gapless(rows)
    assert Counter(r["doc_id"] for r in rows if r["start"] == 0) == {5: 1000, None: 3, 6: 1, 7: 1}
    assert len({(r["sequence_id"], r["offset"]) for r in rows}) == len(rows)


def test_ids_that_are_no_numbers_count_as_null(spark):
    rows = [("7", "a b c"), ("x7", "a b c"), ("", "d e f"), (None, "g h i")]
    df = spark.createDataFrame([(*r, "en", "s") for r in rows], "doc_id string, text string, lang string, source string")
    labels = spark.createDataFrame([("7", 1), ("zz", 0)], "doc_id string, quality int")
    want = Counter([7, None, None, None])
    assert Counter(r["doc_id"] for r in exact_dedup.exact_dedup(df).collect()) == want
    assert sorted(r["text"] for r in exact_dedup.keep_first_copies(df).collect()) == ["a b c", "d e f", "g h i"]
    assert Counter(r["doc_id"] for r in license_scan.license_scan(df).collect()) == want
    assert Counter(r["doc_id"] for r in language_id.language_id(df).collect()) == want
    assert Counter(r["doc_id"] for r in jaccard_join.jaccard_classes(df).collect()) == want
    assert jaccard_join.one_of_each_class(df).count() == 3
    assert Counter(r["doc_id"] for r in substring_dedup.substring_digests(df).collect()) == want
    assert Counter(r["doc_id"] for r in packing.pack(df, tokenizer_path()).collect()) == want
    assert Counter(r["doc_id"] for r in mixing.mix(df).collect()) == want
    assert quality.good_documents(df, labels).count() == 4 and Counter(r["doc_id"] for r in quality.quality_scores(df, labels).collect()) == want


def test_shortest_pack_first_places_everything():
    rng = random.Random(7)
    for _ in range(50):
        histogram = Counter(rng.randint(1, 100) for _ in range(rng.randint(1, 300)))
        placed = Counter()
        for count, lengths in packing.shortest_pack_first(histogram, 100):
            assert sum(lengths) <= 100 and count > 0 and lengths == sorted(lengths, reverse=True)
            for x in lengths:
                placed[x] += count
        assert placed == histogram


# ----------------------------------------------------------------------- 9 quality


def test_quality(spark, sf_dir):
    docs, labels = common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels")
    got = {r["doc_id"]: r for r in quality.quality_scores(docs, labels).collect()}
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got.values())
    assert sum(got[i]["keep"] == (q == 1) for i, q in truth.items()) / len(truth) > 0.95
    assert all(got[i]["keep"] for i, q in truth.items() if q == 1)


def test_quality_of_held_out_labels(spark):
    """Fitted on half of the labels, the classifier is right on the other half; planted copies on both sides are left out."""
    docs, labels = common.table(spark, "/root/testdata/sf0.01", "documents"), common.table(spark, "/root/testdata/sf0.01", "labels")
    fitted = labels.where("crc32(cast(doc_id as string)) % 2 = 0")
    got = {r["doc_id"]: r["keep"] for r in quality.quality_scores(docs, fitted).collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    known = {texts[r["doc_id"]] for r in fitted.collect()}
    held = [(r["doc_id"], r["quality"]) for r in labels.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 2 and texts[r["doc_id"]] not in known]
    right = [got[i] == (q == 1) for i, q in held]
    assert len(held) > 100 and sum(right) / len(right) > 0.95 and all(got[i] for i, q in held if q == 1)


def test_quality_words_tell_what_statistics_do_not(spark):
    rng = random.Random(12)
    kinds = [[f"ga{a}{b}" for a in "abcde" for b in "fghij"], [f"ba{a}{b}" for a in "abcde" for b in "fghij"]]
    df = documents(spark, [" ".join(rng.choice(kinds[k % 2]) for _ in range(60)) for k in range(400)])
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(200)], "doc_id long, quality int")
    assert all(r["keep"] == (r["doc_id"] % 2 == 0) for r in quality.quality_scores(df, labels).where("doc_id >= 200").collect())


def test_quality_sample_is_of_labels_that_have_documents(spark, sf_dir):
    """Labels of documents that are elsewhere, a thousand times as many as those at hand, change nothing."""
    docs, labels = common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels").select("doc_id", "quality")
    others = spark.range(10_000_000, 10_087_000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    want = sorted(map(tuple, quality.quality_scores(docs, labels).collect()))
    assert sorted(map(tuple, quality.quality_scores(docs, labels.unionByName(others)).collect())) == want


def test_quality_posterior_equals_brute_force(spark, sf_dir):
    docs, labels = common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels")
    rows = quality.scored(docs, labels).where("doc_score > 0.00001").toPandas()
    everything = quality.scored(docs, labels).toPandas()
    sums = lambda by: everything.groupby(by)["doc_score"].agg(["size", "sum"])
    hosts, paths = sums(["host"]), sums(["host", "path"])
    mu = min(max(everything["doc_score"].mean(), 1e-3), 1 - 1e-3)

    def strength(n, s, mean):
        n, s, mean = (np.asarray(x, float)[np.asarray(n) >= 2] for x in (n, s, mean))
        if len(n) < 2:
            return 10.0
        noise = (mean * (1 - mean)).sum() / n.sum()
        variance = max((n * (s / n - mean) ** 2).sum() / n.sum() - noise, 1e-6)
        return min(max((mean * (1 - mean) * n).sum() / n.sum() / variance - 1, 1.0), 1e4)

    k_host = strength(hosts["size"], hosts["sum"], [mu] * len(hosts))
    of = hosts.loc[[h for h, _ in paths.index]]
    k_path = strength(paths["size"], paths["sum"], (k_host * mu + of["sum"].to_numpy()) / (k_host + of["size"].to_numpy()))
    for r in rows.itertuples():
        n, s = hosts.loc[r.host]
        host = (k_host * mu + s - r.doc_score) / (k_host + n - 1)
        n, s = paths.loc[(r.host, r.path)]
        path = (k_path * host + s - r.doc_score) / (k_path + n - 1)
        odds = math.log(r.doc_score / (1 - r.doc_score)) + math.log(path / (1 - path)) - math.log(mu / (1 - mu))
        assert abs(r.host_score - host) < 1e-6 and abs(r.path_score - path) < 1e-6 and abs(r.score - 1 / (1 + math.exp(-odds))) < 1e-5


def test_quality_odd_rows(spark):
    labels = spark.createDataFrame([(0, 1, 0), (1, 0, 0), (1, None, 0), (None, 1, 0), (99, 1, 0), (3, 1, 0), (4, 0, 1)], "doc_id long, quality int, toxic int")
    df = documents(spark, ["good words here", "$$$ %%% ***", None, "fine text again", "### $$$ x", "", "  ", "good words here"], sources=["s", None, "s", "t", None, "s", "s", "s"], langs=["en", None] * 4)
    rows = sorted((r["doc_id"], r["keep"]) for r in quality.quality_scores(df, labels).collect())
    assert rows == [(0, True), (1, False), (2, False), (3, True), (4, False), (5, False), (6, False), (7, True)]
    kept = quality.good_documents(df, labels)
    assert kept.columns == df.columns and sorted(r["doc_id"] for r in kept.collect()) == [0, 3, 7]
    assert {r["keep"] for r in quality.quality_scores(df, labels.limit(0)).where("doc_id in (0, 1, 3)").collect()} == {True}
    assert quality.quality_scores(df.limit(0), labels).count() == 0


def test_sparse_sites_shrink(spark):
    rows = [("junk $$$ %%%", "bad")] * 60 + [("good words in a row", "fine")] * 200 + [("middling * text with words", "bad"), ("middling * text with words", "fine")]
    df = documents(spark, [t for t, _ in rows], sources=[s for _, s in rows])
    labels = spark.createDataFrame([(i, 0 if i < 60 else 1) for i in range(0, 260, 2)], "doc_id long, quality int")
    got = {r["doc_id"]: r for r in quality.quality_scores(df, labels).collect()}
    assert got[260]["host_score"] < 0.2 < 0.8 < got[261]["host_score"] and got[260]["score"] < got[261]["score"]


# ------------------------------------------------------------------------ 10 mixing


def brute_targets(sizes, weights=(1, 2, 3), cap=3):
    """The level at which the sources' targets add up to the whole, by bisection."""
    ordered = sorted(sizes, key=lambda x: (x is None, (x or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(ordered)}
    whole, low, high = sum(sizes.values()), 0.0, 3.0 * sum(sizes.values()) + 1
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if sum(min(cap * n, mid * weight[s]) for s, n in sizes.items()) < whole else (low, mid)
    return {s: min(cap * n, high * weight[s]) for s, n in sizes.items()}


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 10}, {"a": 100, "b": 1, "c": 0, None: 50}, {"b": 0}, {}, {f"s{i}": i * i for i in range(500)}, {"z": 7, "é": 9, "\U0001f600": 80, "": 2, None: 1}])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(df).collect()}
    want = brute_targets(sizes)
    assert got.keys() == sizes.keys() and all(abs(got[s] - want[s]) < 1e-6 * (1 + want[s]) for s in sizes)


def test_any_number_of_sources(spark):
    """100,001 sources of a document each don't stop the job, and hold their targets' level."""
    rows = spark.range(100_001).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text"), F.format_string("s%06d", "id").alias("source"))
    goals = mixing.source_targets(rows.groupBy("source").agg(F.lit(3).cast("long").alias("source_size")))
    got = goals.agg(F.count("*"), F.sum("target"), F.min("target"), F.max("target")).first()
    assert got[0] == 100_001 and abs(got[1] - 300_003) < 1e-3 and abs(3 * got[2] - got[3]) < 1e-9


@pytest.mark.parametrize("group", [4096, 16])
def test_mixing(spark, monkeypatch, group):
    """Sizes, targets and the words taken, against targets found apart and within one document's words of them."""
    monkeypatch.setattr(mixing.cube_sample, "__defaults__", (group,))
    rng = random.Random(10)
    texts = [" ".join(words(rng, rng.choice([0, 1, 5, 40, 300]))) for _ in range(600)] + [None, "a\tb\x0bc", "big " * 5000]
    sources = [rng.choice(["a", "b", "b", "b", "c", None]) for _ in texts]
    df = documents(spark, texts, sources=sources)
    rows = mixing.mix(df).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, mixing.mix(df).collect())) and len(rows) == len(texts)
    size = [len(WORD.findall(t or "")) for t in texts]
    whole, largest, taken = defaultdict(int), defaultdict(int), defaultdict(int)
    for s, n in zip(sources, size):
        whole[s], largest[s] = whole[s] + n, max(largest[s], n)
    goal = brute_targets(whole)
    for r in rows:
        s = sources[r["doc_id"]]
        assert (r["source"], r["size"], r["source_size"]) == (s, size[r["doc_id"]], whole[s]) and r["taken"] == r["size"] * r["copies"] <= 3 * r["size"]
        assert abs(r["target"] - goal[s]) < 1e-6 * (1 + goal[s])
        taken[s] += r["taken"]
    assert all(abs(taken[s] - goal[s]) <= largest[s] for s in goal)
    expanded = mixing.mixed_documents(df)
    assert expanded.columns == df.columns
    times = Counter(r["doc_id"] for r in expanded.collect())
    assert all(times[r["doc_id"]] == r["copies"] for r in rows)


def test_repeated_rows_meet_the_target(spark):
    """A thousand equal rows are units that can be taken a different number of times."""
    df = documents(spark, ["a b c d e"] * 1000 + [f"w{i} x y z" for i in range(700)], ids=[7] * 1000 + [*range(100, 800)], sources=["a"] * 1000 + ["b"] * 700)
    goal = brute_targets({"a": 5000, "b": 2800})
    rows, taken = mixing.mix(df).collect(), defaultdict(int)
    for r in rows:
        taken[r["source"]] += r["taken"]
    assert len(rows) == 1700 and all(abs(taken[s] - goal[s]) <= 5 for s in goal)
    expanded = Counter(r["source"] for r in mixing.mixed_documents(df.withColumn("lang", F.col("doc_id").cast("string"))).collect())
    assert expanded == {"a": taken["a"] // 5, "b": taken["b"] // 4}


def test_flight_keeps_totals():
    rng = random.Random(1)
    size = [float(rng.randint(0, 50)) for _ in range(500)]
    p = [0.3] * 500
    waiting = mixing.flight(p, size, rng)
    assert len(waiting) <= 2 and abs(sum(p) - 150) < 1e-6 and abs(sum(a * b for a, b in zip(p, size)) - 0.3 * sum(size)) < 1e-6
    mixing.land(p, size, waiting)
    assert set(p) <= {0.0, 1.0}


def test_mixing_odd_rows(spark):
    df = documents(spark, ["a b", "a b", "c", None], ids=[1, 1, None, 2], sources=["x", "x", None, "x"])
    assert len(mixing.mix(df).collect()) == 4 and mixing.mixed_documents(df).count() >= 1
    assert mixing.mix(df.limit(0)).count() == 0
