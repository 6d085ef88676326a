"""Characters, words, sentences and segments of texts: segments are (segment keys, text), one row each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import leading_blanks, strip, trailing_blanks, truthy

#: Languages written without spaces; the sign for a space and for a character outside the vocabulary.
UNSPACED = ("ja", "zh")
SPACE, WILD = "|", "*"
SENTENCE = r"[^.!?]*[.!?]+[\"')\]]*|[^.!?]+"
#: Common abbreviations by language, whose full stop ends no sentence.
ABBREVIATIONS = {
    "en": "Mr Mrs Ms Dr Prof St Jr Sr vs etc e.g i.e No Inc Ltd Co Corp Gen Col Capt Lt Sgt Rev Hon Fig approx",
    "de": "Dr Prof Hr Fr Nr z.B d.h u.a usw bzw ca evtl ggf vgl Str Abs Art inkl Jh Mio Mrd St",
    "fr": "M MM Mme Mlle Dr Pr St Ste etc p.ex cf av apr env no fig",
    "es": "Sr Sra Srta Dr Dra Prof Ud Uds etc p.ej núm pág aprox EE.UU",
    "it": "Sig Dott Prof Ing Avv ecc es pag art n",
    "nl": "dhr mevr dr prof bijv enz o.a d.w.z nr blz ca",
    "pt": "Sr Sra Dr Dra Prof etc p.ex pág n aprox",
}


def abbreviation_at_end(language: str) -> str:
    """The pattern of a text that ends with an abbreviation of the language (English ones if it has no list) or an initial."""
    known = "|".join(x.replace(".", r"\.") for x in ABBREVIATIONS.get(language, ABBREVIATIONS["en"]).split())
    return rf"(?<![\p{{L}}.])(?:{known}|\p{{Lu}})\.$"


def numbered_characters(text: Column, spaced: bool = True) -> Column:
    """array<struct<char, word_idx>> of a text, in one pass; word_idx is the character's word.

    A space belongs to the word after it, but one that opens the text opens no word; unspaced, each character is a word.
    """
    if not spaced:
        return F.transform(F.split(text, ""), lambda x, i: F.struct(x.alias("char"), i.alias("word_idx")))
    first = F.when(F.startswith(text, F.lit(" ")), 1).otherwise(0)
    pieces = F.transform(F.split(text, " "), lambda x, k: F.when(k == 0, x).otherwise(F.concat(F.lit(" "), x)))
    # Only the piece before a first space can be empty; it has no characters.
    one = lambda x, k: F.transform(F.split(x, ""), lambda y: F.struct(y.alias("char"), F.greatest(k - first, F.lit(0)).alias("word_idx")))
    return F.filter(F.flatten(F.transform(pieces, one)), lambda x: x["char"] != "")


def characters(segments: DataFrame, keys: list[str], spaced: bool = True) -> DataFrame:
    """keys, lead, last, cdx, char, word_idx: one row for each character; empty texts have none.

    lead and last bound the characters between the outer blanks (last is the first one after them); rows carry no text.
    """
    # Two steps: what stands beside a generator in one select is found again for each of its rows.
    rows = segments.where(F.length("text") > 0).select(
        *keys,
        leading_blanks(F.col("text")).alias("lead"),
        (F.length("text") - trailing_blanks(F.col("text"))).alias("last"),
        numbered_characters(F.col("text"), spaced).alias("_c"),
    )
    return rows.select(*keys, "lead", "last", F.posexplode("_c").alias("cdx", "_c")).select(*keys, "lead", "last", "cdx", "_c.char", "_c.word_idx")


def clean_sign(char: Column, vocabulary: Column, spaced: bool = True) -> Column:
    """A character as the vocabulary has it, else WILD."""
    low = F.lower(char)
    low = F.replace(low, F.lit(" "), F.lit(SPACE)) if spaced else low
    return F.when(F.map_contains_key(vocabulary, low), low).otherwise(F.lit(WILD))


def token_of(sign: Column, vocabulary: Column) -> Column:
    return F.coalesce(F.element_at(vocabulary, sign), F.lit(-1))


def clean_characters(chars: DataFrame, vocabulary: Column, spaced: bool = True) -> DataFrame:
    """Characters between the outer blanks, as the vocabulary has them: clean (or WILD) and token (or -1)."""
    rows = chars.where((F.col("cdx") >= F.col("lead")) & (F.col("cdx") < F.col("last")))
    return rows.withColumn("clean", clean_sign(F.col("char"), vocabulary, spaced)).withColumn("token", token_of(F.col("clean"), vocabulary))


def clean_tokens(text: Column, vocabulary: Column, spaced: bool = True) -> Column:
    """array<int>: the tokens of clean_characters, within the row."""
    lead = leading_blanks(text)
    inner = F.slice(F.split(text, ""), lead + 1, F.greatest(F.lit(0), F.length(text) - trailing_blanks(text) - lead))
    return F.transform(inner, lambda x: token_of(clean_sign(x, vocabulary, spaced), vocabulary))


def _joined(column: str = "char", order: str = "cdx") -> Column:
    return F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(order, column))), lambda x: x[column]), "")


def word_rollup(chars: DataFrame, keys: list[str]) -> DataFrame:
    """keys, word_idx, word, start, end, score of chars (cdx, char, word_idx, start, end, score).

    Spaces give no times and no score; null times and scores are skipped; words that are blank are dropped.
    """
    inked = lambda c: F.when(F.col("char") != " ", F.col(c))
    words = chars.groupBy(*keys, "word_idx").agg(
        strip(_joined()).alias("word"), F.min(inked("start")).alias("start"), F.max(inked("end")).alias("end"), F.round(F.avg(inked("score")), 3).alias("score")
    )
    return words.where(F.length("word") > 0)


def interpolate(words: DataFrame, keys: list[str]) -> DataFrame:
    """Words without a start get the previous word's end, else seg_start, and the next word's start, else seg_end.

    Zero counts as missing there; ends filled on the way serve the words after them.
    """
    # Both windows run up to the row before, one of them backward: a frame that ends with the partition is quadratic.
    before = Window.partitionBy(*keys).orderBy("word_idx").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(*keys).orderBy(F.desc("word_idx")).rowsBetween(Window.unboundedPreceding, -1)
    real = lambda c: F.when(F.col(c) != 0, F.col(c))
    lacks = F.col("start").isNull()
    words = words.withColumn("_end", F.when(lacks, F.coalesce(F.last(real("start"), True).over(after), F.col("seg_end"))).otherwise(F.col("end")))
    start = F.when(lacks, F.coalesce(F.last(real("_end"), True).over(before), F.col("seg_start"))).otherwise(F.col("start"))
    return words.withColumn("_start", start).withColumn("start", F.col("_start")).withColumn("end", F.col("_end")).drop("_start", "_end")


def word_arrays(words: DataFrame, keys: list[str]) -> DataFrame:
    """keys, words: the word rows of each segment as an array in order."""
    fields = F.struct("word_idx", "word", "start", "end", "score")
    rows = words.groupBy(*keys).agg(F.sort_array(F.collect_list(fields)).alias("_w"))
    return rows.select(*keys, F.transform("_w", lambda x: x.dropFields("word_idx")).alias("words"))


def word_segments(segments: DataFrame, keys: list[str]) -> DataFrame:
    """The words of all segments, one row each."""
    return segments.select(*keys, F.posexplode("words").alias("word_no", "w")).select(*keys, "word_no", "w.*")


def confidence(words: Column) -> Column:
    """Mean of the scores that are neither null nor zero; null without any."""
    scores = F.transform(F.filter(words, lambda w: truthy(w["score"])), lambda w: w["score"])
    return F.when(F.size(scores) > 0, F.aggregate(scores, F.lit(0.0), lambda a, x: a + x) / F.size(scores))


def _pieces(text: Column) -> Column:
    """array<string>: the sentences of a text with the blanks around them, so that together they are the text."""
    return F.filter(F.regexp_extract_all(text, F.lit(SENTENCE), F.lit(0)), lambda x: F.length(x) > 0)


def sentence_spans(segments: DataFrame, keys: list[str], language: str | None = None) -> DataFrame:
    """keys, sentence, s, e, n_chars, sentence_text of segments (keys, text): each sentence's characters s to e, e not included.

    A sentence ends with a run of . ! ? and what closes it, or with the text; its outer blanks aren't part of it. With a
    language, its abbreviations, initials and stops before anything but a blank end none.
    """
    rows = segments.select(*keys, F.length("text").alias("n_chars"), _pieces(F.col("text")).alias("_p"))
    rows = rows.select(*keys, "n_chars", F.posexplode("_p").alias("_i", "_p"))
    order = Window.partitionBy(*keys).orderBy("_i")
    if language is not None:
        before = [F.coalesce(F.lag("_p", k).over(order), F.lit("")) for k in (2, 1)]
        goes_on = F.concat(*before, F.col("_p")).rlike(abbreviation_at_end(language)) | F.lead("_p").over(order).rlike(r"^\S")
        ended = rows.withColumn("_ends", F.when(goes_on, 0).otherwise(1))
        whole = ended.withColumn("_whole", F.coalesce(F.sum("_ends").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_i", "_p"))), lambda x: x["_p"]), "")
        rows = whole.groupBy(*keys, "n_chars", "_whole").agg(F.min("_i").alias("_i"), joined.alias("_p"))
    pos = F.coalesce(F.sum(F.length("_p")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    lead = F.length("_p") - F.length(F.regexp_replace("_p", r"^\s+", ""))
    last = F.length(F.regexp_replace("_p", r"\s+$", ""))
    rows = rows.select(*keys, "n_chars", "_i", (pos + lead).cast("int").alias("s"), (pos + last).cast("int").alias("e"), F.substring(F.col("_p"), lead + 1, last - lead).alias("sentence_text"))
    return rows.where("e > s").withColumn("sentence", F.row_number().over(order) - 1).select(*keys, "sentence", "s", "e", "n_chars", "sentence_text")


def sentence_characters(spans: DataFrame, keys: list[str]) -> DataFrame:
    """keys, sentence, cdx of sentence_spans: characters s to e, e included, so that the one after a sentence belongs to both.

    Meant for an equi-join with characters; rows carry no text. Joins of what is made by generators name sort-merge: their
    size is estimated from the tables they come from, so they would be broadcast, through the driver, at any size.
    """
    return spans.select(*keys, "sentence", F.explode(F.sequence(F.col("s"), F.least(F.col("e"), F.col("n_chars") - 1))).alias("cdx"))


def sentence_rollup(chars: DataFrame, segments: DataFrame, keys: list[str], language: str | None = None) -> DataFrame:
    """keys, sentence, text, start, end of chars (keys, cdx, char, start, end).

    The end skips spaces. A sentence without times has null.
    """
    spans = sentence_spans(segments, keys, language)
    rows = sentence_characters(spans, keys).hint("merge").join(chars.select(*keys, "cdx", "char", "start", "end"), [*keys, "cdx"])
    times = rows.groupBy(*keys, "sentence").agg(F.min("start").alias("start"), F.max(F.when(F.col("char") != " ", F.col("end"))).alias("end"))
    return times.hint("merge").join(spans.select(*keys, "sentence", F.col("sentence_text").alias("text")), [*keys, "sentence"]).select(*keys, "sentence", "text", "start", "end")


def sentence_rollup_within(segments: DataFrame, keys: list[str]) -> DataFrame:
    """sentence_rollup of segments (keys, text, starts, ends), whose arrays of doubles have all characters of the text in order.

    Each row is rolled up by itself, so that no row of a character is made or sent.
    """
    inked = F.zip_with(F.split("text", ""), "ends", lambda x, end: F.when(x != " ", end))
    rows = segments.select(*keys, "starts", inked.alias("ends"), _pieces(F.col("text")).alias("_p"))
    # Where each piece begins: the places of characters that are the first of theirs, since sums over an array's head are quadratic.
    inside = F.flatten(F.transform("_p", lambda p: F.sequence(F.lit(0), F.length(p) - 1)))
    begins = F.array_remove(F.transform(inside, lambda k, i: F.when(k == 0, i).otherwise(-1)), -1)

    def placed(p: Column, begin: Column) -> Column:
        s, e = begin + F.length(p) - F.length(F.regexp_replace(p, r"^\s+", "")), begin + F.length(F.regexp_replace(p, r"\s+$", ""))
        return F.struct(s.alias("s"), e.alias("e"), begin.alias("begin"), p.alias("piece"))

    def timed(x: Column) -> Column:
        # The character after a sentence belongs to both, as in sentence_characters.
        own = lambda c: F.slice(c, x["s"] + 1, F.least(x["e"] + 1, F.size(c)) - x["s"])
        text = F.substring(x["piece"], x["s"] - x["begin"] + 1, x["e"] - x["s"])
        return F.struct(text.alias("text"), F.array_min(own("starts")).alias("start"), F.array_max(own("ends")).alias("end"))

    found = F.filter(F.zip_with("_p", begins, placed), lambda x: x["e"] > x["s"])
    # The generator takes the expression: a column of its own would be filtered by size, and found twice.
    return rows.select(*keys, F.posexplode(F.transform(found, timed)).alias("sentence", "_s")).select(*keys, "sentence", "_s.*")


def sentence_words(chars: DataFrame, segments: DataFrame, keys: list[str], language: str | None = None) -> DataFrame:
    """keys, sentence, word_idx, word, start, end, score: words rolled up within each sentence's characters."""
    rows = sentence_characters(sentence_spans(segments, keys, language), keys).hint("merge").join(chars, [*keys, "cdx"])
    return word_rollup(rows, [*keys, "sentence"])


def nearest_fill(rows: DataFrame, keys: list[str], order: str, column: str) -> DataFrame:
    """Nulls of column take the nearest value by order, the one before on ties; without any they stay null."""
    before = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    after = Window.partitionBy(*keys).orderBy(F.desc(order)).rowsBetween(Window.unboundedPreceding, 0)
    value, place = F.col(column), F.when(F.col(column).isNotNull(), F.col(order))
    rows = rows.withColumn("_b", F.last(value, True).over(before)).withColumn("_bo", F.last(place, True).over(before))
    rows = rows.withColumn("_a", F.last(value, True).over(after)).withColumn("_ao", F.last(place, True).over(after))
    nearer = F.col("_b").isNotNull() & (F.col("_a").isNull() | (F.col(order) - F.col("_bo") <= F.col("_ao") - F.col(order)))
    return rows.withColumn(column, F.when(nearer, F.col("_b")).otherwise(F.col("_a"))).drop("_a", "_b", "_ao", "_bo")


def merge_same_times(sentences: DataFrame, keys: list[str], spaced: bool = True) -> DataFrame:
    """Sentences with equal start and end become one, texts joined and words (if there) concatenated in order; rows without times are dropped."""
    more = [c for c in ("words", "chars") if c in sentences.columns]
    parts = F.sort_array(F.collect_list(F.struct("sentence", "text", *more)))
    rows = sentences.where(F.col("start").isNotNull() & F.col("end").isNotNull())
    rows = rows.groupBy(*keys, "start", "end").agg(parts.alias("_p"))
    text = F.array_join(F.transform("_p", lambda x: x["text"]), " " if spaced else "")
    listed = lambda c: F.flatten(F.filter(F.transform("_p", lambda x: x[c]), lambda x: x.isNotNull())).alias(c)
    return rows.select(*keys, "start", "end", text.alias("text"), F.get("_p", F.lit(0))["sentence"].alias("sentence"), *map(listed, more))
