"""Licence scan with a positional rare-token index, in DataFrame functions only.

A template is a notice, of which some phrases are mandatory. Every text is read once: the places
of its licence words, the words of any template, are stored as a table. Everything else is joins
with two small tables, so the work follows the places and not the number of templates:

* postings (word, template, place): each template's INDEX_WORDS mandatory words with the highest IDF
  over all documents. A file that holds a notice holds all its mandatory words, so these are the
  rarest licence words that it shares with the template.
* expected (template, place, word, mandatory): all words of the templates.

A start in a text is a candidate if the postings of all index words of a template meet there, that is
if each stands at its place relative to the start. Its expected words are then looked up among the
places: all mandatory ones must stand, and at least ``percent`` of all. As index words are
mandatory, the index loses no notice.

Base templates are phrases that are mandatory as a whole; every place of theirs counts.
The score of a document is the greatest share of a template found in it, 0 without any.

Words are maximal runs of ASCII letters and digits and of all other characters beyond ASCII;
only A-Z are compared without case.

Cases: a NULL or empty text has no words, no labels (empty strings) and score 0; repeated
rows give repeated results; a NULL id is passed through; an empty table gives no rows; other
columns are not read. Very long texts are scanned whole.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postloom.llm.store import keep

PERCENT = 80
INDEX_WORDS = 3


@dataclass(frozen=True)
class Template:
    """Words in braces are the mandatory phrases."""

    label: str
    notice: str
    base: bool = False

    def words(self) -> list[tuple[str, bool]]:
        out, must = [], False
        for word in self.notice.split():
            must = must or word.startswith("{")
            out.append((word.strip("{}"), must))
            must = must and not word.endswith("}")
        return out


# The phrases and labels of the contract.
BASE = (
    Template("gpl", "{gnu general public license}", True),
    Template("apache", "{apache license}", True),
    Template("cc-by", "{cc by}", True),
    Template("mit", "{mit license}", True),
)
# Opening words of common notices.
NOTICES = (
    Template("gpl-3.0", "{gnu general public license version 3}"),
    Template("gpl-2.0", "{gnu general public license version 2}"),
    Template("gpl-notice", "this program is {free software} you can redistribute it and or modify it under the terms of the {gnu general public license}"),
    Template("apache-2.0", "licensed under the {apache license version 2 0}"),
    Template("mit", "{permission is hereby granted free of charge} to any person obtaining a copy of this software and associated documentation files"),
    Template("mit-release", "released under the {mit license}"),
    Template("bsd", "{redistribution and use in source and binary forms} with or without modification are permitted provided that the following conditions are met"),
    Template("isc", "{permission to use copy modify and or distribute} this software for any purpose with or without fee is hereby granted"),
    Template("mpl-2.0", "this source code form is subject to the terms of the {mozilla public license} v 2 0"),
    Template("cc-by-nc", "licensed under {cc by nc}"),
    Template("cc-by-sa", "licensed under {cc by sa}"),
    Template("creative-commons", "this work is licensed under a {creative commons} attribution"),
    Template("unlicense", "this is free and {unencumbered software released into the public domain}"),
    # Whole permission notices.
    Template(
        "mit-text",
        "{permission is hereby granted free of charge} to any person obtaining a copy of this software and associated documentation files "
        "the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish "
        "distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to "
        "the following conditions the above copyright notice and this permission notice shall be included in all copies or "
        "{substantial portions of the software}",
    ),
    Template(
        "isc-text",
        "{permission to use copy modify and or distribute} this software for any purpose with or without fee is hereby granted provided that "
        "the above copyright notice and this permission notice {appear in all copies}",
    ),
    Template(
        "bsd-2-text",
        "{redistribution and use in source and binary forms} with or without modification are permitted provided that the following conditions "
        "are met 1 redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer 2 "
        "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the "
        "documentation and or {other materials provided with the distribution}",
    ),
)
TEMPLATES = BASE + NOTICES


def words_of(text: Column) -> Column:
    """Words in lower case. The Kelvin sign is the one character whose lower case would be an ASCII letter."""
    plain = F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("Å"))
    return F.array_remove(F.split(F.lower(plain), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def _table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A table of the templates; bounded by them, so it may be broadcast."""
    names = [field.split()[0] for field in schema.split(", ")]
    listed = F.from_json(F.lit(json.dumps([dict(zip(names, row)) for row in rows])), f"array<struct<{schema.replace(' ', ':').replace(',:', ',')}>>")
    return F.broadcast(spark.range(1).select(F.explode(listed).alias("r")).select("r.*"))


def places(docs: DataFrame, vocabulary: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, pos, word, id, n_words), stored: a line per place of a word of the vocabulary, and one per
    document with neither place nor word but id and number of words. Texts are read once."""
    words = docs.select(
        F.col(id_col).alias("id"), words_of(F.col(text_col)).alias("words"), F.monotonically_increasing_id().alias("row")
    )
    ahead = F.concat(F.array(F.lit(None).cast("string")), F.col("words"))
    each = words.select("row", "id", F.size("words").cast("bigint").alias("n_words"), F.posexplode(ahead).alias("at", "word"))
    kept = each.filter((F.col("at") == 0) | F.col("word").isin(vocabulary))
    document = F.col("at") == 0
    return keep(
        kept.select(
            "row", F.when(~document, F.col("at") - 1).alias("pos"), "word",
            F.when(document, F.col("id")).alias("id"), F.when(document, F.col("n_words")).alias("n_words"),
        ),
        "licence-places",
    )


def document_frequency(standing: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """In how many documents each word of the vocabulary stands; one row per word comes back."""
    present = standing.filter(F.col("word").isin(vocabulary)).select("row", "word").distinct()
    return {r["word"]: r["count"] for r in present.groupBy("word").count().collect()}


def rarest(templates: tuple[Template, ...], frequency: dict[str, int], documents: int, count: int = INDEX_WORDS) -> list[tuple[int, str, int]]:
    """Postings (template, word, place) of each template's mandatory words of highest IDF."""
    idf = lambda word: math.log((1 + documents) / (1 + frequency.get(word, 0)))
    out = []
    for number, template in enumerate(templates):
        must = [(word, place) for place, (word, needed) in enumerate(template.words()) if needed]
        must.sort(key=lambda x: (-idf(x[0]), x[1]))
        out += [(number, word, place) for word, place in must[:count]]
    return out


def candidates(standing: DataFrame, postings: list[tuple[int, str, int]]) -> DataFrame:
    """(row, template, start): where the postings of all index words of a template meet."""
    spark = standing.sparkSession
    needed: dict[int, int] = {}
    for number, _, _ in postings:
        needed[number] = needed.get(number, 0) + 1
    index = _table(spark, [(*p, needed[p[0]]) for p in postings], "template int, word string, place int, needed int")
    posted = standing.join(index, "word").select("row", "template", (F.col("pos") - F.col("place")).alias("start"), "needed")
    met = posted.groupBy("row", "template", "start", "needed").agg(F.count(F.lit(1)).alias("met"))
    return met.filter(F.col("met") == F.col("needed")).select("row", "template", "start")


def verify(standing: DataFrame, found: DataFrame, templates: tuple[Template, ...], percent: int) -> DataFrame:
    """(row, template, start, share) of the places whose phrases and share of words are right."""
    spark = standing.sparkSession
    words = [(n, place, word, must) for n, t in enumerate(templates) for place, (word, must) in enumerate(t.words())]
    sizes = {n: (len(t.words()), sum(must for _, must in t.words())) for n, t in enumerate(templates)}
    expected = _table(spark, [(*w, *sizes[w[0]]) for w in words], "template int, place int, word string, must boolean, size int, musts int")
    wanted = found.join(expected, "template").select(
        "row", "template", "start", (F.col("start") + F.col("place")).alias("pos"), "word", "must", "size", "musts"
    )
    # Only texts with a candidate are looked into again; a place and its word are found together.
    near = standing.join(found.select("row").distinct(), "row", "left_semi").select("row", "pos", "word")
    right = wanted.join(near, ["row", "pos", "word"]).groupBy("row", "template", "start", "size", "musts").agg(
        F.count(F.lit(1)).alias("good"), F.count_if("must").alias("phrases")
    )
    whole = (F.col("phrases") == F.col("musts")) & (100 * F.col("good") >= percent * F.col("size"))
    return right.filter(whole).select("row", "template", "start", (F.col("good") / F.col("size")).alias("share"))


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Documents and finds.

    Documents: (row, id, n_words), one for every row. Finds: (row, template, label, base,
    start, end, share), a row per notice or phrase, ``start`` and ``end`` counted in words.
    """
    stored = places(docs, sorted({w for t in templates for w, _ in t.words()}), id_col, text_col)
    documents = stored.filter("pos IS NULL").select("row", "id", "n_words")
    standing = stored.filter("pos IS NOT NULL").select("row", "pos", "word")
    mandatory = sorted({w for t in templates for w, needed in t.words() if needed})
    postings = rarest(templates, document_frequency(standing, mandatory), documents.count())
    found = verify(standing, keep(candidates(standing, postings), "licence-candidates"), templates, percent)
    named = _table(docs.sparkSession, [(n, t.label, t.base, len(t.words())) for n, t in enumerate(templates)], "template int, label string, base boolean, size int")
    finds = found.join(named, "template").select(
        "row", "template", "label", "base", F.col("start").cast("bigint").alias("start"),
        (F.col("start") + F.col("size")).cast("bigint").alias("end"), "share",
    )
    return documents, keep(finds, "licence-finds")


def digest(documents: DataFrame, finds: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per document: counts and places of base phrases, labels, and the score."""
    base = F.when(F.col("base"), F.col("start"))
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    summed = finds.groupBy(F.col("row").alias("r")).agg(
        F.count(base).alias("n_base"), F.min(base).alias("first_word"), F.max(base).alias("last_word"),
        joined(F.when(F.col("base"), F.col("label"))).alias("base_labels"), joined(F.col("label")).alias("labels"),
        F.max("share").alias("score"),
    )
    none = F.lit("")
    return documents.join(summed, F.col("row") == F.col("r"), "left").select(
        F.col("id").alias(id_col), "n_words", F.coalesce("n_base", F.lit(0).cast("bigint")).alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", none).alias("base_labels"), F.coalesce("labels", none).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
