"""License scan by diagonal voting, in DataFrame code throughout.

All rolling word k-gram hashes of the texts are joined to the positions of those grams in the license templates. A
match votes for the diagonal (document position minus template position); votes are aggregated by document, template
and diagonal; neighbouring diagonals merge into spans; a span is verified by the share of its template that it covers:
all of a short one (so that the word which tells licenses of a family apart must be there), most of a longer one, or a
long dense part of a whole license text.

The template table is fixed (some two thousand grams), so it is broadcast; keys are documents, so no key is hot.

Defined cases: null text counts as empty and has no words; texts of any length are scanned whole; a template shorter
than k words has no grams; labels that tie all count; rows equal in doc_id and text, or with a null doc_id, have the
same result where their texts are equal, each its own row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

K = 3
#: Neighbouring diagonals: at most so many words shifted and so many apart.
SHIFT, GAP = 2, 8
#: A span is verified if it covers so much of its template, or holds so many grams as densely; a template of at most
#: SHORT grams must be covered whole.
COVERAGE, LONG_SPAN, SHORT = 0.6, 12, 8

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Phrases that name a license, and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Texts, sentences and notices of public licenses, and their labels.
TEMPLATES = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness in no event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license"),
    ("gpl", "licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for more details you should have received a copy of the gnu general public license along with this program"),
    ("lgpl", "gnu lesser general public license"),
    ("agpl", "gnu affero general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions the origin of this software must not be misrepresented you must not claim that you wrote the original software if you use this software in a product an acknowledgment in the product documentation would be appreciated but is not required altered source versions must be plainly marked as such and must not be misrepresented as being the original software this notice may not be removed or altered from any source distribution"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("cc-by", "cc by 4 0"),
    ("cc-by-sa", "cc by sa 4 0"),
    ("cc-by-nc", "cc by nc 4 0"),
    ("cc-by-nd", "cc by nd 4 0"),
    ("cc-by-nc-sa", "cc by nc sa 4 0"),
    ("cc-by-nc-nd", "cc by nc nd 4 0"),
    ("cc-by", "creative commons attribution 4 0 international license"),
    ("cc-by-sa", "creative commons attribution sharealike 4 0 international license"),
    ("cc-by-nc", "creative commons attribution noncommercial 4 0 international license"),
    ("cc0", "to the extent possible under law the author has dedicated all copyright and related rights to the public domain"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("unlicense", "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means"),
]


def words_of(text: F.Column) -> F.Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lowered, NO_WORD), "")


def template_grams(spark: SparkSession, templates=TEMPLATES, k: int = K) -> DataFrame:
    """gram (hash), template, label, t_pos, t_grams: a fixed number of rows."""
    rows = []
    for i, (label, text) in enumerate(templates):
        words = [x for x in re.split(NO_WORD, text.lower()) if x]
        rows += [(i, label, p, len(words) - k + 1, words[p : p + k]) for p in range(len(words) - k + 1)]
    df = spark.createDataFrame(rows, "template int, label string, t_pos int, t_grams int, words array<string>")
    return df.select(F.xxhash64(*[F.col("words")[i] for i in range(k)]).alias("gram"), "template", "label", "t_pos", "t_grams")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).try_cast("long").alias("doc_id"), F.xxhash64(text_col).alias("row_key"), F.col(text_col).alias("text"))


def license_spans(docs: DataFrame, templates=TEMPLATES, k: int = K, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, row_key, label, template, first_word, last_word, matched, coverage: the verified spans."""
    words = F.col("words")
    grams = F.transform(F.sequence(F.lit(0), F.size(words) - k), lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(k)]))
    rows = _keyed(docs, id_col, text_col).withColumn("words", words_of(F.col("text"))).where(F.size("words") >= k)
    rows = rows.select("doc_id", "row_key", F.posexplode(grams).alias("d_pos", "gram"))
    votes = rows.join(F.broadcast(template_grams(docs.sparkSession, templates, k)), "gram")
    diagonal = ["doc_id", "row_key", "template", "label", "t_grams", (F.col("d_pos") - F.col("t_pos")).alias("diagonal")]
    votes = votes.groupBy(*diagonal).agg(F.min("d_pos").alias("lo"), F.max("d_pos").alias("hi"), F.collect_set("t_pos").alias("hits"))
    along = Window.partitionBy("doc_id", "row_key", "template").orderBy("lo", "diagonal")
    apart = (F.abs(F.col("diagonal") - F.lag("diagonal").over(along)) > SHIFT) | (F.col("lo") - F.lag("hi").over(along) > GAP)
    votes = votes.withColumn("apart", F.coalesce(apart, F.lit(True)).cast("int")).withColumn("span", F.sum("apart").over(along))
    spans = votes.groupBy("doc_id", "row_key", "template", "label", "t_grams", "span").agg(
        F.min("lo").alias("first_word"), F.max("hi").alias("last"), F.size(F.array_distinct(F.flatten(F.collect_list("hits")))).alias("matched")
    )
    covers = F.col("matched") / F.col("t_grams")
    dense = (F.col("matched") >= LONG_SPAN) & (F.col("matched") >= COVERAGE * (F.col("last") - F.col("first_word") + 1))
    needed = F.when(F.col("t_grams") <= SHORT, 1.0).otherwise(COVERAGE)
    return spans.where((covers >= needed) | dense).select(
        "doc_id", "row_key", "label", "template", F.col("first_word").cast("long"), (F.col("last") + k - 1).cast("long").alias("last_word"), "matched", covers.alias("coverage")
    )


def base_places(words: F.Column, lowered: F.Column, phrases: dict[str, str] = PHRASES) -> F.Column:
    """array<struct<place, label>>: every place where a phrase's words stand consecutively."""

    def places(phrase: str, label: str) -> F.Column:
        parts = phrase.split(" ")
        stands = lambda i: reduce(and_, [F.get(words, i + j) == x for j, x in enumerate(parts)])
        found = F.filter(F.sequence(F.lit(0), F.size(words)), stands)
        return F.transform(found, lambda i: F.struct(i.cast("long").alias("place"), F.lit(label).alias("label")))

    out = [places(*x) for x in phrases.items()]
    none = F.array().cast("array<struct<place:bigint,label:string>>")
    may = reduce(or_, [F.contains(lowered, F.lit(x)) for x in sorted({p.split(" ")[-1] for p in phrases})])
    return F.when(may, F.concat(*out)).otherwise(none)


def license_scan(docs: DataFrame, templates=TEMPLATES, phrases: dict[str, str] = PHRASES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score: one row for each row of docs."""
    spans = license_spans(docs, templates, K, id_col, text_col)
    found = spans.groupBy(F.col("doc_id").alias("f_id"), F.col("row_key").alias("f_key")).agg(F.collect_set("label").alias("found"), F.max("coverage").alias("coverage"))
    rows = _keyed(docs, id_col, text_col).withColumn("words", words_of(F.col("text")))
    lowered = F.translate(F.coalesce(F.col("text"), F.lit("")), UPPER, LOWER)
    rows = rows.select("doc_id", "row_key", F.size("words").cast("long").alias("n_words"), base_places(F.col("words"), lowered, phrases).alias("base"))
    rows = rows.join(found, F.col("doc_id").eqNullSafe(F.col("f_id")) & (F.col("row_key") == F.col("f_key")), "left")
    places, base_labels = F.col("base.place"), F.array_distinct(F.col("base.label"))
    labels = F.array_union(base_labels, F.coalesce(F.col("found"), F.array().cast("array<string>")))
    return rows.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(places).alias("first_word"),
        F.array_max(places).alias("last_word"),
        F.array_join(F.array_sort(base_labels), ",").alias("base_labels"),
        F.array_join(F.array_sort(labels), ",").alias("labels"),
        F.when(F.size("base") > 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.coalesce(F.col("coverage"), F.lit(0.0)))).alias("score"),
    )
