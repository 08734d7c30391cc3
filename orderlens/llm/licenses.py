"""Licence notices by a positional rare-token index, in DataFrame functions only.

The index holds, for every word of every licence template, where it stands in the template. The
document frequencies of these words are counted over all documents. A document looks up, for each
template, the ``RARE_WORDS`` of its words that have the highest inverse document frequency among those of
the template; every occurrence of such a word proposes a place where the template would begin (its
position minus that in the template), and the proposals are intersected: a place is accepted if the
rare words that agree on it carry at least ``LEAST_SUPPORT`` of the weight that the document's rare
words have in the template, and there are at least two of them, and if every mandatory key phrase of the template stands word by word within
``SLACK`` words of where the template puts it. One aggregation by (document, template, start) does this.

The texts are scanned once. Of each document the set of its licence words is kept, and its words only
if all key phrases of some template stand in it; no other document can be accepted. The tables of
words and templates are fixed and small.

Base labels are places where a phrase's words stand one after the other; the method adds to them.
The score is the share of a template's weight found at the best accepted place (at most 1), 0.5 for
a base phrase alone, and 0 without any label. Defined results: a null or empty text has no words, no
places and no labels. Repeated rows and null ids are judged like any row. Other columns play no
part. An empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm.common import let, stored
from orderlens.session import broadcast_if_small

RARE_WORDS = 8
LEAST_SUPPORT = 0.6
SLACK = 3

# Phrases whose words must stand one after the other, and their labels.
BASE_PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
# Label, wording (lower case, words only) and mandatory key phrases of each template.
TEMPLATES = [
    ("mit", "released under the mit license", ["mit license"]),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and "
        "associated documentation files to deal in the software without restriction",
        ["permission is hereby granted", "free of charge"],
    ),
    ("apache-2.0", "licensed under the apache license version 2 0", ["apache license"]),
    ("gpl-3.0", "licensed under the gnu general public license version 3", ["general public license", "version 3"]),
    (
        "gpl",
        "you can redistribute it and or modify it under the terms of the gnu general public license",
        ["general public license"],
    ),
    ("lgpl", "under the terms of the gnu lesser general public license", ["lesser general public license"]),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", ["cc by nc"]),
    ("cc-by-4.0", "licensed under cc by 4 0", ["cc by 4 0"]),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", ["cc by sa"]),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted",
        ["source and binary forms"],
    ),
    (
        "mpl-2.0",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        ["mozilla public license"],
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without "
        "fee is hereby granted",
        ["with or without fee"],
    ),
    (
        "unlicense",
        "this is free and unencumbered software released into the public domain",
        ["unencumbered software"],
    ),
    ("reserved", "all rights reserved", ["all rights reserved"]),
]
# Words are runs of digits, lower-case letters and anything beyond ASCII.
NOT_WORD = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"

VOCABULARY = sorted({w for _, wording, _ in TEMPLATES for w in wording.split()})
KEY_PHRASES = sorted({key for _, _, keys in TEMPLATES for key in keys})


def licence_words(text: Column) -> Column:
    """The words of a text after lower-casing A-Z."""
    # lower() also turns these two letters (Kelvin sign, dotted capital I) into ASCII ones.
    body = F.translate(F.coalesce(text, F.lit("")), "Kİ", "éé")
    plain = F.when(F.contains(text, F.lit("K")) | F.contains(text, F.lit("İ")), body).otherwise(F.coalesce(text, F.lit("")))
    return F.array_remove(F.split(F.lower(plain), NOT_WORD), "")


def _literal(words: list[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])


def _rarest(ordered: Column, template: tuple[str, str, list[str]]) -> Column:
    """The first ``RARE_WORDS`` of a document's ordered licence words that the template has."""
    return F.slice(F.array_intersect(ordered, _literal(sorted(set(template[1].split())))), 1, RARE_WORDS)


def _possible(joined: Column) -> Column:
    """Whether all key phrases of some template stand somewhere."""
    together = sorted({tuple(keys) for _, _, keys in TEMPLATES})
    has = lambda key: F.contains(joined, F.lit(f" {key} "))
    return reduce(lambda a, b: a | b, [reduce(lambda a, b: a & b, map(has, keys)) for keys in together])


def _phrase_starts(words: Column, joined: Column, phrase: str) -> Column:
    parts = phrase.split()
    empty = F.array().cast("array<int>")

    def here(word: Column, i: Column) -> Column:
        rest = [F.get(words, i + k) == part for k, part in enumerate(parts) if k]
        return F.when(reduce(lambda a, b: a & b, rest, word == parts[0]), i)

    found = F.filter(F.transform(words, here), lambda x: x.isNotNull())
    return F.when(F.contains(joined, F.lit(f" {phrase} ")), found).otherwise(empty)


def _scan(docs: DataFrame, text: str, key: str) -> DataFrame:
    """One row per document: counts, base places, licence words; words and key places where needed."""

    def facts(words: Column) -> Column:
        def of(joined: Column) -> Column:
            starts = [_phrase_starts(words, joined, p).alias(label) for p, label in BASE_PHRASES.items()]
            keys = F.array(*[_phrase_starts(words, joined, k) for k in KEY_PHRASES])
            return F.struct(
                F.size(words).cast("long").alias("n_words"),
                F.struct(*starts).alias("base"),
                F.array_intersect(words, _literal(VOCABULARY)).alias("present"),
                F.when(_possible(joined), F.struct(words.alias("words"), keys.alias("keys"))).alias("body"),
            )

        return let(F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" ")), of)

    scanned = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(key).alias("key"),
        let(licence_words(F.col(text)), facts).alias("f"),
    ).select("row", "key", "f.*")
    return stored(scanned)


def _inline(spark: SparkSession, rows: list[Column]) -> DataFrame:
    return spark.range(1).select(F.inline(F.array(*rows)))


def _postings(spark: SparkSession) -> DataFrame:
    rows = [
        F.struct(F.lit(w).alias("word"), F.lit(t).alias("template"), F.lit(i).alias("t_at"))
        for t, (_, wording, _) in enumerate(TEMPLATES)
        for i, w in enumerate(wording.split())
    ]
    return _inline(spark, rows)


def _key_phrases(spark: SparkSession) -> DataFrame:
    """Key phrases by number: template, place in it, and a bit of its own within the template."""
    rows = []
    for t, (_, wording, keys) in enumerate(TEMPLATES):
        words = wording.split()
        for bit, key in enumerate(keys):
            parts = key.split()
            at = next(i for i in range(len(words)) if words[i : i + len(parts)] == parts)
            rows.append(
                F.struct(
                    F.lit(KEY_PHRASES.index(key)).alias("phrase"),
                    F.lit(t).alias("template"),
                    F.lit(at).alias("k_at"),
                    F.lit(1 << bit).alias("bit"),
                )
            )
    return _inline(spark, rows)


def _labels(spark: SparkSession) -> DataFrame:
    """Template, its label and the bits of all its key phrases."""
    rows = [
        F.struct(F.lit(t).alias("template"), F.lit(label).alias("label"), F.lit((1 << len(keys)) - 1).alias("all_bits"))
        for t, (label, _, keys) in enumerate(TEMPLATES)
    ]
    return _inline(spark, rows)


def _accepted(scanned: DataFrame) -> DataFrame:
    """``row``, the method's labels and the best share of a template."""
    spark = scanned.sparkSession
    frequency = (
        scanned.select(F.explode("present").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    )
    total = scanned.agg(F.count(F.lit(1)).alias("n")).scalar()
    words = _inline(spark, [F.struct(F.lit(w).alias("word")) for w in VOCABULARY])
    weights = stored(
        words.join(frequency, "word", "left").select(
            "word", (F.log((total + 1) / (F.coalesce("df", F.lit(0)) + 1)) + 0.01).alias("weight")
        )
    )
    as_map = weights.agg(F.map_from_entries(F.collect_list(F.struct("word", "weight")))).scalar()
    full = (
        _postings(spark).join(F.broadcast(weights), "word").groupBy("template").agg(F.sum("weight").alias("full"))
    )
    by_weight = F.array_sort(
        F.transform("present", lambda w: F.struct((-F.col("_map")[w]).alias("w"), w.alias("word")))
    )
    candidates = scanned.where("body is not null").withColumn("_map", as_map)
    # The rarest words of each template by its number: another notice takes none of its places.
    candidates = candidates.select(
        "row", "body", let(by_weight["word"], lambda ordered: F.array(*[_rarest(ordered, t) for t in TEMPLATES])).alias("rare")
    )
    postings = F.broadcast(_postings(spark).join(F.broadcast(weights), "word"))
    is_rare = F.array_contains(F.get("rare", F.col("template")), F.col("word"))
    # What a document's rare words weigh in each template.
    possible = (
        candidates.select("row", "rare", F.explode(F.array_distinct(F.flatten("rare"))).alias("word"))
        .join(postings, "word")
        .where(is_rare)
        .groupBy("row", "template")
        .agg(F.sum("weight").alias("possible"))
    )
    # Where rare words, and key phrases give or take the slack, would have each template begin.
    by_words = (
        candidates.select("row", "rare", F.posexplode("body.words").alias("at", "word"))
        .where(F.array_contains(F.flatten("rare"), F.col("word")))
        .join(postings, "word")
        .where(is_rare)
        .select("row", "template", (F.col("at") - F.col("t_at")).alias("start"), "weight", F.lit(0).alias("bit"))
    )
    by_keys = (
        candidates.select("row", F.posexplode("body.keys").alias("phrase", "places"))
        .select("row", "phrase", F.explode("places").alias("at"))
        .join(F.broadcast(_key_phrases(spark)), "phrase")
        .select("row", "template", (F.col("at") - F.col("k_at")).alias("middle"), "bit")
        .select(
            "row",
            "template",
            F.explode(F.sequence(F.col("middle") - SLACK, F.col("middle") + SLACK)).alias("start"),
            F.lit(None).cast("double").alias("weight"),
            "bit",
        )
    )
    supported = (
        by_words.unionByName(by_keys)
        .groupBy("row", "template", "start")
        .agg(
            F.sum("weight").alias("found"),
            F.count("weight").alias("agreeing"),
            F.bit_or("bit").alias("bits"),
        )
        .where("agreeing > 1")
        .join(F.broadcast(_labels(spark)), "template")
        .where("bits = all_bits")
        .join(possible, ["row", "template"])
        .where(F.col("found") >= LEAST_SUPPORT * F.col("possible"))
        .join(F.broadcast(full), "template")
    )
    return supported.groupBy("row").agg(
        F.collect_set("label").alias("found_labels"), F.max(F.col("found") / F.col("full")).alias("share")
    )


def scan(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row: key, ``n_words``, ``n_base``, first and last base place, labels and ``score``."""
    scanned = _scan(docs, text, key)
    found = stored(_accepted(scanned))
    starts = F.flatten(F.array(*[F.col("base")[label] for label in BASE_PHRASES.values()]))
    base = F.array_compact(
        F.array(*[F.when(F.size(F.col("base")[x]) > 0, F.lit(x)) for x in sorted(BASE_PHRASES.values())])
    )
    rows = scanned.select("row", "key", "n_words", starts.alias("starts"), base.alias("base_set")).join(
        broadcast_if_small(found), "row", "left"
    )
    labels = F.array_sort(
        F.array_union("base_set", F.coalesce("found_labels", F.array().cast("array<string>")))
    )
    score = F.when(F.col("share").isNotNull(), F.least("share", F.lit(1.0))).when(
        F.size("base_set") > 0, F.lit(0.5)
    )
    return rows.select(
        F.col("key").alias(key),
        "n_words",
        F.size("starts").cast("long").alias("n_base"),
        F.array_min("starts").cast("long").alias("first_word"),
        F.array_max("starts").cast("long").alias("last_word"),
        F.array_join("base_set", ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.coalesce(score, F.lit(0.0)).alias("score"),
    )
