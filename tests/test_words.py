import random
import time

import pytest
from pyspark.sql import functions as F

from intervox.operators import words as w
from intervox.plans import canonical, transcription

KEYS = ["id"]


def frame(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")


@pytest.mark.parametrize("text", ["  ab c ", "a  b", "x\ty z", " hi ", "İa", "a😀b", "", "   ", "q!"])
def test_clean_characters(spark, text):
    vocabulary = canonical.VOCABULARY
    expected, lead = [], len(text) - len(text.lstrip())
    for i, ch in enumerate(text):
        if lead <= i <= len(text) - (len(text) - len(text.rstrip())) - 1:
            low = ch.lower().replace(" ", "|")
            expected.append((i, low if low in vocabulary else "*", vocabulary.get(low, -1)))
    got = w.clean_characters(w.characters(frame(spark, [text]), KEYS), canonical.vocabulary()).orderBy("cdx").collect()
    assert [(r["cdx"], r["clean"], r["token"]) for r in got] == expected


def test_word_numbers_equal_the_loop(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choice("ab  ") for _ in range(rng.randint(1, 12))) for _ in range(200)]
    got = {(r["id"], r["cdx"]): r["word_idx"] for r in w.characters(frame(spark, texts), KEYS).collect()}
    assert len(got) == sum(map(len, texts))
    for i, text in enumerate(texts):
        n = 0
        for k in range(len(text)):
            assert got[i, k] == n
            n += k == len(text) - 1 or text[k + 1] == " "


def test_unspaced_languages_count_characters(spark):
    rows = w.characters(frame(spark, ["日本 語"]), KEYS, spaced=False)
    assert [r["word_idx"] for r in rows.orderBy("cdx").collect()] == [0, 1, 2, 3]


def test_interpolation_equals_the_loop(spark):
    rng = random.Random(6)
    rows, expected = [], []
    for i in range(60):
        words = [[None, None] if rng.random() < 0.4 else [rng.choice([0.0, 1.0, 2.5]), rng.choice([0.0, 3.0, 4.5])] for _ in range(rng.randint(1, 7))]
        rows += [(i, k, a, b, 10.0, 20.0) for k, (a, b) in enumerate(words)]
        for k, x in enumerate(words):
            if x[0] is None:
                before = next((words[j][1] for j in range(k - 1, -1, -1) if words[j][1]), 10.0)
                after = next((words[j][0] for j in range(k + 1, len(words)) if words[j][0]), 20.0)
                x[:] = [before, after]
        expected += [(i, k, *x) for k, x in enumerate(words)]
    df = spark.createDataFrame(rows, "id int, word_idx int, start double, end double, seg_start double, seg_end double")
    got = w.interpolate(df, KEYS).orderBy("id", "word_idx").collect()
    assert [(r["id"], r["word_idx"], r["start"], r["end"]) for r in got] == expected


def test_words_of_a_very_long_text(spark):
    """Work is linear in the text: 300,000 characters and 60,000 words and sentences in one row end in seconds."""
    segments = frame(spark, ["abc. " * 60_000])
    chars = w.characters(segments, KEYS).select("id", "cdx", "char", "word_idx", F.when(F.col("cdx") % 7 > 0, F.col("cdx") * 1.0).alias("start"), (F.col("cdx") + 1.0).alias("end"), F.lit(0.5).alias("score"))
    began = time.time()
    rolled = w.word_rollup(chars, KEYS).withColumns({"seg_start": F.lit(0.0), "seg_end": F.lit(1e6)})
    assert w.interpolate(rolled, KEYS).where("start is not null and word = 'abc.'").count() == 60_000
    assert w.nearest_fill(rolled, KEYS, "word_idx", "start").where("start is not null").count() == 60_000
    assert w.sentence_rollup(chars, segments, KEYS).where("text = 'abc.'").count() == 60_000
    assert time.time() - began < 60


@pytest.mark.parametrize("scores, mean", [([0.5, None, 0.0, 1.0], 0.75), ([0.0, None], None), ([], None)])
def test_confidence(spark, scores, mean):
    df = spark.createDataFrame([([(s,) for s in scores],)], "words array<struct<score:double>>")
    assert df.select(w.confidence(F.col("words"))).first()[0] == mean


def test_sentence_characters_share_the_border(spark):
    segments = frame(spark, ["Ab. Cd"])
    chars = w.characters(segments, KEYS).select("id", "cdx", "char", F.col("cdx").cast("double").alias("start"), (F.col("cdx") + 1.0).alias("end"))
    got = w.sentence_rollup(chars, segments, KEYS).orderBy("sentence").collect()
    assert [(r["text"], r["start"], r["end"]) for r in got] == [("Ab.", 0.0, 3.0), ("Cd", 4.0, 6.0)]


def test_sentences_within_rows_equal_the_join(spark):
    rng = random.Random(7)
    texts = ["".join(rng.choice("ab  .!?)'\"\n\té😀") for _ in range(rng.randint(1, 40))) for _ in range(300)] + ["", None, "   ", "...", " a", "a. ", "no stop"]
    segments, has = frame(spark, texts), lambda i, x: (i % 5 != 0) & (x != "b")
    chars = w.characters(segments, KEYS).withColumns({c: F.when(has(F.col("cdx"), F.col("char")), F.col("cdx") + k) for c, k in (("start", 0.0), ("end", 1.0))})
    of = lambda k: F.transform(F.split("text", ""), lambda x, i: F.when(has(i, x), i + k))
    timed = segments.withColumns({"starts": of(0.0), "ends": of(1.0)})
    got = w.sentence_rollup_within(timed, KEYS)
    want = w.sentence_rollup(chars, segments, KEYS)
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect())) != []


def test_sentences_within_a_very_long_row(spark):
    """Work is linear in the text, as in test_words_of_a_very_long_text."""
    segments = frame(spark, ["abc. " * 60_000]).withColumns({c: F.sequence(F.lit(k), F.lit(299_999 + k)).cast("array<double>") for c, k in (("starts", 0), ("ends", 1))})
    began = time.time()
    assert w.sentence_rollup_within(segments, KEYS).where("text = 'abc.' and start = 5 * sentence and end = start + 4").count() == 60_000
    assert time.time() - began < 30


@pytest.mark.parametrize(
    "language, text, sentences",
    [
        ("en", "Mr. Smith paid 3.14 to J. Doe. He left!", ["Mr. Smith paid 3.14 to J. Doe.", "He left!"]),
        ("en", "no stop at all", ["no stop at all"]),
        ("en", "Ask Dr. Who", ["Ask Dr. Who"]),
        ("en", "See Dr.", ["See Dr."]),
        ("de", "Das gilt z.B. hier, bzw. dort. Ja?! Gut.", ["Das gilt z.B. hier, bzw. dort.", "Ja?!", "Gut."]),
        ("fr", "M. Dupont dort. (Oui.) Mme. Roy non", ["M. Dupont dort.", "(Oui.)", "Mme. Roy non"]),
        ("xx", "Mrs. A... and B. Then", ["Mrs. A...", "and B. Then"]),
        (None, "Mr. Smith.", ["Mr.", "Smith."]),
        ("en", "", []),
    ],
)
def test_sentences_by_language(spark, language, text, sentences):
    rows = w.sentence_spans(frame(spark, [text]), KEYS, language).orderBy("sentence").collect()
    assert [r["sentence_text"] for r in rows] == sentences and all(text[r["s"] : r["e"]] == r["sentence_text"] for r in rows)


def test_sentences_of_a_long_text_without_stops(spark):
    rows = w.sentence_spans(frame(spark, ["word Mr. " * 20_000 + "x " * 100_000]), KEYS, "en").collect()
    assert len(rows) == 1 and rows[0]["e"] == 379_999


def test_merge_same_times(spark):
    df = spark.createDataFrame([(0, 0, "a", 1.0, 2.0), (0, 1, "b", 1.0, 2.0), (0, 2, "c", None, 2.0)], "id int, sentence int, text string, start double, end double")
    assert [r["text"] for r in w.merge_same_times(df, KEYS).collect()] == ["a b"]
    assert [r["text"] for r in w.merge_same_times(df, KEYS, spaced=False).collect()] == ["ab"]


def test_merge_same_times_concatenates_words(spark):
    word = "array<struct<word:string>>"
    df = spark.createDataFrame([(0, 1, "b", 1.0, 2.0, [("b",)]), (0, 0, "a", 1.0, 2.0, [("a",)]), (0, 2, "c", 3.0, 4.0, None)], f"id int, sentence int, text string, start double, end double, words {word}")
    got = {r["text"]: [x["word"] for x in r["words"]] for r in w.merge_same_times(df, KEYS).collect()}
    assert got == {"a b": ["a", "b"], "c": []}


def test_nearest_fill(spark):
    df = spark.createDataFrame([(0, i, v) for i, v in enumerate([None, 1.0, None, None, 4.0, None])], "id int, o int, v double")
    assert [r["v"] for r in w.nearest_fill(df, KEYS, "o", "v").orderBy("o").collect()] == [1.0, 1.0, 1.0, 4.0, 4.0, 4.0]


def test_align_places_words(spark):
    vocabulary = {"<pad>": 0, "|": 1, "a": 2, "b": 3}
    ids, frames = [2, 1, 3], []
    for k in [0, 2, 0, 1, 0, 3, 0]:
        frames.append([-0.1 if i == k else -5.0 for i in range(4)])
    segments = spark.createDataFrame([("r", 0, 1.0, 7.0, " a b "), ("r", 1, 99.0, 100.0, "a"), ("r", 2, 2.0, 3.0, "  "), ("r", 3, 2.0, 3.0, "ababababab")], "recording_id string, ord int, start double, end double, text string")
    emissions = spark.createDataFrame([("r", i, frames) for i in range(4)], "recording_id string, ord int, emission array<array<double>>")
    durations = spark.createDataFrame([("r", 50.0)], "recording_id string, duration double")
    got = {r["ord"]: r["words"] for r in transcription.align(segments, emissions, vocabulary, durations, "en").collect()}
    assert [x["word"] for x in got[0]] == ["a", "b"] and got[1] == got[2] == got[3] == []
    assert got[0][0]["start"] < got[0][0]["end"] <= got[0][1]["start"] <= 7.0
