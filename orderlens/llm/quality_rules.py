"""Quality rules by distribution divergence, in DataFrame functions only.

Each document's histogram of character classes and its histogram of common words are compared with
the reference of its language by the Jensen-Shannon distance (base 2, from 0 to 1). The references
are counted over all documents: per language the totals of each character class, and the
``COMMON_WORDS`` most frequent words with their counts, everything else being one class "other".

A short text is away from its reference by chance alone, in bits by about 1 / (8 ln 2) for each class
and word. So what is allowed of the word distance is, squared, a share of the distance of a text with
no common word of its language, and that much more. As this hides the lack of common words in short
texts, their share in the text is also held against that of the reference.

The texts are scanned twice: once for the word counts (combined inside the map tasks, and of these
only the leading words of each task are shuffled), once for the figures of each document, which are
stored as a small table. A document never leaves its task.

Defined results: a null text is an empty one. An empty text has zero words and fails the base rule.
A null language is a language of its own. A language with fewer than ``min_reference_words`` words
gives no reference, and its documents are judged by the base rule alone. Repeated rows are judged
one by one. Other columns play no part. Words of a text are told apart by a 64-bit hash of three
words, so two different windows of one text coincide with a chance of 2^-64 a pair.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm.common import WHITE_SPACE, WORD_GAP, let, stored, words_of
from orderlens.session import broadcast_if_small

COMMON_WORDS = 32
# Fields of the table by hash in which a word's place among the common words is looked up.
FIELDS = 512
SYMBOLS = "#*$%&|<>"
CLASSES = ("upper", "lower", "digit", "space", "symbol", "rest")


@dataclass(frozen=True)
class Rules:
    """Thresholds; a histogram is compared only if the document is long enough to have one."""

    min_words: int = 50
    max_repeat_percent: int = 50
    min_class_chars: int = 200
    max_class_distance: float = 0.28
    min_histogram_words: int = 50
    max_word_distance: float = 0.43
    # Allowed to a text of any length, as a share of the distance of a text with no common word,
    # and how often what chance is expected to add.
    long_word_share: float = 0.6
    chance_factor: float = 1.25
    # A text lacks common words below this share of the reference's share of them, where the
    # reference makes at least so many be expected.
    least_common_share: float = 0.1
    min_expected_common: int = 10
    min_reference_words: int = 5_000


def _length_without(text: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(text, pattern, ""))


def _repeated_words(words: Column) -> Column:
    """Words that stand in a three-word window found at least twice."""

    def covered(windows: Column) -> Column:
        # Sorted by hash, equal windows are neighbours. sort_array() compares without a lambda function.
        ordered = F.sort_array(
            F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        )

        def starts(s: Column) -> Column:
            last = F.size(s) - 1
            twins = F.filter(
                F.transform(
                    s,
                    lambda x, i: F.when(
                        ((i > 0) & (F.get(s, i - 1)["h"] == x["h"]))
                        | ((i < last) & (F.get(s, i + 1)["h"] == x["h"])),
                        x["i"],
                    ),
                ),
                lambda x: x.isNotNull(),
            )
            return let(
                twins,
                lambda t: F.size(
                    F.array_distinct(
                        F.concat(t, F.transform(t, lambda x: x + 1), F.transform(t, lambda x: x + 2))
                    )
                ),
            )

        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(
            let(ordered, starts)
        )

    # The last two "windows" are shorter and so hash unlike any other.
    hashes = let(
        words,
        lambda w: F.transform(w, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2))),
    )
    return let(words, lambda w: F.when(F.size(w) < 4, F.lit(0)).otherwise(let(hashes, covered)))


def _duplicate_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.btrim(x, F.lit(WHITE_SPACE))) > 0)
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))


def common_words(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """Per language: its most common words in order, their counts, and the count of all words."""
    counted = (
        docs.select(
            F.col(lang).alias("lang"),
            F.explode(F.split(F.coalesce(F.col(text), F.lit("")), WORD_GAP)).alias("word"),
        )
        .where("word != ''")
        .groupBy("lang", "word")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # The place that the words of a hash have: 0 if there is none, -1 if there are several.
    field = lambda w: F.pmod(F.hash(w), F.lit(FIELDS))
    taken = let(F.transform("top_words", field), lambda fields: F.transform(
        F.sequence(F.lit(0), F.lit(FIELDS - 1)),
        lambda k: F.when(
            F.size(F.filter(fields, lambda x: x == k)) > 1, F.lit(-1)
        ).otherwise(F.array_position(fields, k).cast("int")),
    ))
    # Each task passes on the leading words it has seen, not all words of a language.
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))
    return (
        counted.withColumn("rank", rank)
        .where(F.col("rank") <= COMMON_WORDS)
        .groupBy(F.col("lang").alias("ref_lang"))
        .agg(
            F.array_sort(F.collect_list(F.struct("rank", "word", "n"))).alias("top"),
        )
        .select(
            "ref_lang",
            F.col("top.word").alias("top_words"),
            F.col("top.n").alias("top_counts"),
        )
        .withColumn("fields", taken)
    )


def _distance(mine: Column, theirs: Column) -> Column:
    """Jensen-Shannon distance of two arrays of counts; null if either is missing or all zero."""
    total = lambda x: F.aggregate(x, F.lit(0.0), lambda s, v: s + v)

    def term(part: Column, both: Column) -> Column:
        return F.when(part > 0, part * F.log2(2 * part / both)).otherwise(0.0)

    def divergence(sums: Column) -> Column:
        shares = F.zip_with(
            mine, theirs, lambda x, y: F.struct((x / sums["a"]).alias("p"), (y / sums["b"]).alias("q"))
        )
        both = lambda x: term(x["p"], x["p"] + x["q"]) + term(x["q"], x["p"] + x["q"])
        return F.aggregate(shares, F.lit(0.0), lambda s, x: s + both(x)) / 2

    sums = F.struct(total(mine).alias("a"), total(theirs).alias("b"))
    value = let(sums, lambda s: F.when((s["a"] > 0) & (s["b"] > 0), divergence(s)))
    return let(value, lambda v: F.sqrt(F.greatest(F.lit(0.0), F.when(v < 1, v).otherwise(v * 0 + 1))))


def _figures(docs: DataFrame, text: str, lang: str, keep: list[str]) -> DataFrame:
    """All counts of a document; ``docs`` carries the common words of its language."""
    body = F.coalesce(F.col(text), F.lit(""))

    def letter(x: Column, place: Column) -> Column:
        found = F.char(F.lit(48) + F.array_position(F.col("top_words"), x))
        return (
            F.when(place == 0, F.lit("0"))
            .when(place < 0, found)
            .when(F.get("top_words", place - 1) == x, F.char(F.lit(48) + place))
            .otherwise(F.lit("0"))
        )

    # One letter for each word: its place among the common words, or "0".
    def places(w: Column) -> Column:
        of_fields = F.transform(w, lambda x: F.get("fields", F.pmod(F.hash(x), F.lit(FIELDS))))
        coded = let(
            of_fields,
            lambda at: F.array_join(F.transform(w, lambda x, i: letter(x, F.get(at, i))), ""),
        )
        ranks = F.sequence(F.lit(1), F.lit(COMMON_WORDS))
        each = let(
            F.replace(coded, F.lit("0"), F.lit("")),
            lambda c: F.transform(
                ranks,
                lambda k: (F.length(c) - F.length(F.replace(c, F.char(k + 48), F.lit("")))).cast("double"),
            ),
        )
        return F.when(F.col("top_words").isNotNull(), each)

    of_words = let(
        words_of(body),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            _repeated_words(w).cast("long").alias("n_repeat_words"),
            places(w).alias("places"),
        ),
    )
    n = F.length(body)
    symbols = _length_without(body, f"[^{SYMBOLS}]+")
    upper = _length_without(body, "\\P{Lu}+")
    lower = _length_without(body, "\\P{Ll}+")
    digit = _length_without(body, "[^0-9]+")
    table = docs.select(
        *keep,
        F.col(lang).alias("ref_lang"),
        symbols.cast("long").alias("n_symbols"),
        _duplicate_lines(body).cast("long").alias("n_dup_lines"),
        n.cast("long").alias("_n"),
        upper.cast("long").alias("upper"),
        lower.cast("long").alias("lower"),
        digit.cast("long").alias("digit"),
        of_words.alias("_w"),
    )
    return table.select(
        *keep,
        "ref_lang",
        F.col("_w.n_words").alias("n_words"),
        F.col("_w.word_chars").alias("word_chars"),
        "n_symbols",
        "n_dup_lines",
        F.col("_w.n_repeat_words").alias("n_repeat_words"),
        "upper",
        "lower",
        "digit",
        (F.col("_n") - F.col("_w.word_chars")).alias("space"),
        F.col("n_symbols").alias("symbol"),
        (
            F.col("_w.word_chars") - F.col("upper") - F.col("lower") - F.col("digit") - F.col("n_symbols")
        ).alias("rest"),
        F.col("_w.places").alias("places"),
    )


def judge(
    docs: DataFrame,
    rules: Rules = Rules(),
    text: str = "text",
    lang: str = "lang",
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """One row per document: the columns of ``keep``, the counts, both distances and the verdict."""
    words = stored(common_words(docs, text, lang))
    words = broadcast_if_small(words)
    source = docs.select(*{*keep, text, lang})
    figures = stored(
        _figures(
            source.join(words, source[lang].eqNullSafe(words["ref_lang"]), "left").drop("ref_lang"),
            text,
            lang,
            list(keep),
        )
    )
    # Per language one row, so its class totals and common words are as small as the word table.
    classes = figures.groupBy("ref_lang").agg(
        F.sum("n_words").alias("all_words"), *[F.sum(c).alias(f"ref_{c}") for c in CLASSES]
    )
    reference = words.join(classes, words["ref_lang"].eqNullSafe(classes["ref_lang"])).drop(
        classes["ref_lang"]
    )
    known = F.coalesce(F.col("all_words"), F.lit(0)) >= rules.min_reference_words
    joined = figures.join(
        broadcast_if_small(stored(reference)).withColumnRenamed("ref_lang", "lang_of_reference"),
        F.col("ref_lang").eqNullSafe(F.col("lang_of_reference")),
        "left",
    )
    class_distance = _distance(
        F.array(*[F.col(c).cast("double") for c in CLASSES]),
        F.array(*[F.col(f"ref_{c}").cast("double") for c in CLASSES]),
    )

    def with_others(counts: Column, everything: str) -> Column:
        others = F.col(everything) - F.aggregate(counts, F.lit(0.0), lambda s, v: s + v)
        return F.concat(counts, F.array(others))

    # A language with fewer common words than that has zeros in their places.
    padding = F.array_repeat(F.lit(0.0), F.lit(COMMON_WORDS) - F.size("top_counts"))
    theirs = F.concat(F.transform("top_counts", lambda x: x.cast("double")), padding)
    word_distance = _distance(with_others(F.col("places"), "n_words"), with_others(theirs, "all_words"))
    base_failed = (F.col("n_words") < rules.min_words) | (
        100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words")
    )
    n_chars = F.col("word_chars") + F.col("space")
    by_chance = rules.chance_factor * COMMON_WORDS / (8 * math.log(2)) / F.col("n_words")
    added = lambda x: F.aggregate(x, F.lit(0.0), lambda s, v: s + v)
    common, every = added(theirs), F.col("all_words").cast("double")
    without = _distance(F.array(F.lit(0.0), F.lit(1.0)), F.array(common, every - common))
    most_words = F.least(
        F.lit(rules.max_word_distance), F.sqrt(F.pow(rules.long_word_share * without, F.lit(2)) + by_chance)
    )
    expected = F.col("n_words") * common / every
    lacks_common = (expected >= rules.min_expected_common) & (
        added(F.col("places")) < rules.least_common_share * expected
    )
    diverges = (
        (n_chars >= rules.min_class_chars) & (F.col("class_distance") > rules.max_class_distance)
    ) | (
        (F.col("n_words") >= rules.min_histogram_words)
        & ((F.col("word_distance") > most_words) | (known & lacks_common))
    )
    return (
        joined.withColumn("class_distance", F.when(known, class_distance))
        .withColumn("word_distance", F.when(known, word_distance))
        .select(
            *keep,
            "n_words",
            "word_chars",
            "n_symbols",
            "n_dup_lines",
            "n_repeat_words",
            base_failed.alias("base_failed"),
            (~base_failed & ~F.coalesce(diverges, F.lit(False))).alias("kept"),
            "class_distance",
            "word_distance",
        )
    )


def keep_good(docs: DataFrame, rules: Rules = Rules(), text: str = "text", lang: str = "lang") -> DataFrame:
    """The documents that pass, all columns. A document needs no id to be judged."""
    row = "_quality_row"
    numbered = stored(docs.withColumn(row, F.monotonically_increasing_id()))
    failed = stored(judge(numbered, rules, text, lang, (row,)).where("not kept").select(row))
    return numbered.join(broadcast_if_small(failed), row, "left_anti").select(*docs.columns)
