"""Benchmark decontamination by template canonicalisation, in DataFrame functions only.

A word is stripped of signs at its ends and lower-cased; numbers, numbers with a unit and units become
typed placeholders. A text is then read twice: word by word (*plain* reading: names stay lower-case
words), and with every run of names (a capital followed by small letters) as one placeholder (*typed*
reading). Every window of ``WINDOW`` entries of the plain reading, and every window of the typed one
that holds a name, is hashed and joined with the windows of the benchmark items.

Matches of one text and item that lie on one diagonal (place in the text minus place in the item) form
a run. Runs on neighbouring diagonals, at most ``2 * drift`` apart, are chained, so words put in or left
out and names of another length do not part them (drift: ``LEAST_DRIFT`` and a quarter of the item's
words). A chain whose windows cover ``LEAST_COVERAGE`` of the item's words is a candidate, and its text is
read again. Its runs are taken from the longest; one counts only if the fillers of its slots, with those
of the runs taken before, correspond one to one (each filler of the item to one of the text, and back),
and what is taken must still cover ``LEAST_COVERAGE``, and ``LEAST_WORDS`` words or all of a shorter item.
So an item is found verbatim, in other case, with other numbers and names, with single words replaced,
put in or left out, and as the larger part of it, but not by filling its slots at random.

A leak is a property of the text, so texts are told apart by 128 bits of hash and copies are looked at
once; no row number is needed. The windows of a document never leave its task unless an item has them
too; what is gathered per text and item is bounded by the item's windows. The item table and the leaks
are broadcast if a count shows them small, and joined by shuffle otherwise.

Defined results: null or empty texts match nothing. Items of fewer than ``WINDOW`` words, and windows
with fewer than two entries that are no placeholders, are no evidence; an item without evidence is
never found. Repeated rows and items are reported for each. A null id is reported as null. Other
columns play no part. Empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import WHITE_SPACE, WORD_GAP, let, stored
from orderlens.session import broadcast_if_small

WINDOW = 5
LEAST_COVERAGE = 0.65
LEAST_WORDS = 8
LEAST_DRIFT = 3

# Signs stripped from the ends of a word, and units.
SIGNS = ".,;:!?\"'()[]{}<>*#%&$|_~`/\\-–—“”‘’«»¿¡"
UNITS = (
    "mm|cm|m|km|in|inch|inches|ft|feet|yard|yards|mile|miles|g|kg|mg|lb|lbs|oz|pound|pounds|ml|l|liter|liters|"
    "litre|litres|second|seconds|sec|minute|minutes|min|hour|hours|day|days|week|weeks|month|months|year|years|"
    "dollar|dollars|cent|cents|euro|euros|percent|mph|kmh"
)
# "in" is a unit only next to a number, and a rule that looks at the word alone leaves it a word.
_UNIT_WORDS = [u for u in UNITS.split("|") if u != "in"]
_NUMBER = "^[+-]?[0-9][0-9.,]*(?:st|nd|rd|th)?$"
_NUMBER_UNIT = f"^[0-9][0-9.,]*(?:{UNITS})$"
_NAME = "^\\p{Lu}\\p{Ll}+$"
# An odd code stands for a name: any word's code is a hash whose lowest bit tells names from others.
_ANY_NAME = 1
# White space with the signs around it. Most places begin no gap and are left at the first look; a run
# of signs is read once, however long it is.
_SIGN = f"[{''.join(c if c.isalnum() else chr(92) + c for c in SIGNS)}]"
_GAP = f"(?![A-Za-z])(?:{_SIGN}(?<!{_SIGN}{{2}}){_SIGN}*+)?+{WORD_GAP}{_SIGN}*+"
_TEXT_HASHES = ["text_hash_1", "text_hash_2"]


def _joined(text: Column) -> Column:
    """The words of a text, stripped of signs and parted by single spaces; null if it has no words."""
    trimmed = F.btrim(text, F.lit(WHITE_SPACE))
    return F.when(trimmed != "", F.regexp_replace(F.btrim(trimmed, F.lit(SIGNS)), _GAP, " "))


def _stripped(text: Column) -> Column:
    return F.coalesce(F.split(_joined(text), " "), F.array().cast("array<string>"))


def _plain(low: Column) -> Column:
    """The placeholder of a stripped word in lower case that is a number or unit, or the word itself."""
    # Digits and their signs sort before the colon, so other words meet no pattern.
    return (
        F.when(
            (low < ":") & low.rlike("^[+-]?[0-9]"),
            F.when(low.rlike(_NUMBER), F.lit("<number>")).when(low.rlike(_NUMBER_UNIT), F.lit("<quantity>")).otherwise(low),
        )
        .when(low.isin(_UNIT_WORDS), F.lit("<unit>"))
        .otherwise(low)
    )


def _is_name(code: Column) -> Column:
    return code.bitwiseAND(F.lit(1)) == 1


def _code(word: Column, low: Column) -> Column:
    name = F.when((word != low) & word.rlike(_NAME), F.lit(1)).otherwise(F.lit(0))
    return F.xxhash64(_plain(low)).bitwiseAND(F.lit(-2)) + name


def _joined_codes(joined: Column) -> Column:
    """A hash of each word's plain entry, odd for names. No stripped word holds a space."""
    # The whole text is lower-cased at once, which is faster than word by word.
    return F.zip_with(F.split(joined, " "), F.split(F.lower(joined), " "), _code)


def _codes(words: Column) -> Column:
    return let(F.array_join(words, " "), _joined_codes)


def _starts(codes: Column) -> Column:
    """Where the entries of the typed reading begin: at every word but a name that follows a name."""
    return F.filter(
        F.transform(codes, lambda _, i: i),
        lambda i: ~(_is_name(F.get(codes, i)) & F.coalesce(_is_name(F.get(codes, i - 1)), F.lit(False))),
    )


def _plain_entry(code: Column) -> Column:
    return code.bitwiseAND(F.lit(-2))


def _typed_entry(code: Column) -> Column:
    return F.when(_is_name(code), F.lit(_ANY_NAME).cast("long")).otherwise(code)


def _window_hash(entries: list[Column], reading: Column) -> Column:
    return F.xxhash64(*entries, reading)


def _any_name(entries: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, [e == _ANY_NAME for e in entries])


def _hashed_windows(codes: Column, starts: Column, plain: Column, typed: Column) -> Column:
    """Hash, first entry (those of the typed reading follow the plain ones) and first word of each window.

    Typed windows without a name are null: no item asks for those.
    """

    def of(entries: Column, reading: int, first: Column, place: Callable[[Column], Column]) -> Column:
        def window(x: Column, i: Column) -> Column:
            of_window = [x, *(F.get(entries, i + k) for k in range(1, WINDOW))]
            made = F.struct(
                _window_hash(of_window, F.lit(reading)).alias("hash"),
                (first + i).alias("entry"),
                place(i).alias("place"),
            )
            return F.when(_any_name(of_window), made) if reading else made

        return F.transform(F.slice(entries, 1, F.greatest(F.size(entries) - (WINDOW - 1), F.lit(0))), window)

    return F.concat(of(plain, 0, F.lit(0), lambda i: i), of(typed, 1, F.size(codes), lambda i: F.get(starts, i)))


def _windows(words: Column) -> Column:
    def of_codes(codes: Column, starts: Column) -> Column:
        plain = F.transform(codes, _plain_entry)
        typed = F.transform(starts, lambda s: _typed_entry(F.get(codes, s)))
        return let(plain, lambda p: let(typed, lambda t: _hashed_windows(codes, starts, p, t)))

    return let(_codes(words), lambda c: let(_starts(c), lambda s: of_codes(c, s)))


def _document_windows(docs: DataFrame, text: str) -> DataFrame:
    """The windows of ``_windows`` as rows, each with the hashes of its text.

    Only codes are made as arrays. A row per place comes first and its window is hashed after that, so
    the hashing and the join that follows are compiled; a function of an array is interpreted.
    """
    codes, starts, entry = F.col("codes"), F.col("starts"), F.col("entry")
    n = F.size(codes)
    places = (
        docs.select(*_text_hashes(text), _joined(F.col(text)).alias("joined"))
        .select(*_TEXT_HASHES, _joined_codes(F.col("joined")).alias("codes"))
        .select("*", _starts(codes).alias("starts"))
        # The typed reading has an entry at least, so the last place is not before the first.
        .select("*", F.explode(F.when(n >= WINDOW, F.sequence(F.lit(0), n + F.size(starts) - WINDOW))).alias("entry"))
    )
    plain = [_plain_entry(F.get(codes, entry + k)) for k in range(WINDOW)]
    typed = [_typed_entry(F.get(codes, F.get(starts, entry - n + k))) for k in range(WINDOW)]
    # No window lies in both readings.
    return places.where((entry <= n - WINDOW) | ((entry >= n) & _any_name(typed))).select(
        *_TEXT_HASHES,
        F.when(entry < n, _window_hash(plain, F.lit(0))).otherwise(_window_hash(typed, F.lit(1))).alias("hash"),
        "entry",
        F.when(entry < n, entry).otherwise(F.get(starts, entry - n)).alias("place"),
    )


def _entries(words: Column) -> Column:
    """Both readings, plain then typed: template, filler, first word and end of each entry."""

    def plain(words: Column) -> Column:
        return F.transform(
            words,
            lambda w, i: F.struct(_plain(F.lower(w)).alias("t"), F.lower(w).alias("filler"), i.alias("at"), (i + 1).alias("upto")),
        )

    def typed(words: Column, starts: Column) -> Column:
        def entry(s: Column, k: Column) -> Column:
            end = F.coalesce(F.get(starts, k + 1), F.size(words))
            return F.struct(
                F.when(F.get(words, s).rlike(_NAME), F.lit("<name>")).otherwise(_plain(F.lower(F.get(words, s)))).alias("t"),
                F.lower(F.array_join(F.slice(words, s + 1, end - s), " ")).alias("filler"),
                s.alias("at"),
                end.alias("upto"),
            )

        return F.transform(starts, entry)

    return let(words, lambda w: F.concat(plain(w), let(let(_codes(w), _starts), lambda s: typed(w, s))))


def _is_slot(entry: Column) -> Column:
    # Signs are stripped, so only placeholders begin with one.
    return entry["t"].startswith("<")


def _covered(windows: Column) -> Column:
    """How many words of the item lie in any of the windows."""
    return F.size(
        F.array_distinct(F.flatten(F.transform(windows, lambda w: F.sequence(w["at"], w["upto"] - 1))))
    )


def _items(benchmark: DataFrame, item: str, text: str) -> DataFrame:
    """Items with their entries, the windows that count, ``size`` (words in them), ``need`` and ``drift``."""
    split = benchmark.select(F.col(item).alias("item"), _stripped(F.col(text)).alias("words"))
    read = stored(
        split.where(F.size("words") >= WINDOW).select(
            "item", F.size("words").alias("n"), _entries(F.col("words")).alias("entries"), _windows(F.col("words")).alias("found")
        )
    )
    slots = lambda w: sum(
        F.when(_is_slot(F.get("entries", w["entry"] + k)), 1).otherwise(0) for k in range(WINDOW)
    )
    # A typed window without a name says what the plain one says.
    named = lambda w: (w["entry"] < F.col("n")) | F.exists(
        F.slice("entries", w["entry"] + 1, WINDOW), lambda e: e["t"] == "<name>"
    )
    spans = F.transform(
        F.filter("found", lambda w: (slots(w) <= WINDOW - 2) & named(w)),
        lambda w: F.struct(
            w["hash"].alias("hash"),
            w["entry"].alias("mine"),
            w["place"].alias("at"),
            F.get("entries", w["entry"] + (WINDOW - 1))["upto"].alias("upto"),
        ),
    )
    sized = read.withColumn("windows", spans).where(F.size("windows") > 0).withColumn("size", _covered(F.col("windows")))
    return stored(
        sized.select(
            "item",
            "n",
            "entries",
            "windows",
            "size",
            F.greatest(
                F.ceil(LEAST_COVERAGE * F.col("size")).cast("int"), F.least(F.col("size"), F.lit(LEAST_WORDS))
            ).alias("need"),
            (F.lit(LEAST_DRIFT) + F.floor(F.col("n") / 4)).cast("int").alias("drift"),
            F.monotonically_increasing_id().alias("item_row"),
        )
    )


def _text_hashes(text: str, names: list[str] = _TEXT_HASHES) -> list[Column]:
    return [F.xxhash64(F.col(text)).alias(names[0]), F.xxhash64(F.lit(1), F.col(text)).alias(names[1])]


def _chains(docs: DataFrame, items: DataFrame, text: str) -> DataFrame:
    """Per text, item and band of diagonals: the runs of matching windows, if they cover enough."""
    wanted = items.select("item_row", "n", "need", "drift", F.inline("windows"))
    window = F.struct("mine", F.col("entry").alias("other"), "at", "upto")
    runs = (
        _document_windows(docs, text)
        .join(broadcast_if_small(wanted), "hash")
        .groupBy(
            *_TEXT_HASHES,
            "item_row",
            (F.col("mine") >= F.col("n")).alias("typed"),
            (F.col("place") - F.col("at")).alias("start"),
        )
        .agg(F.collect_set(window).alias("windows"), F.max("need").alias("need"), F.max("drift").alias("drift"))
    )
    # A band is two drifts wide and they overlap by one, so runs up to a drift apart share one.
    band = F.floor(F.col("start") / F.col("drift"))
    run = F.struct((-F.size("windows")).alias("order"), "typed", "start", "windows")
    return (
        runs.withColumn("band", F.explode(F.array(band, band - 1)))
        .groupBy(*_TEXT_HASHES, "item_row", "band")
        .agg(F.collect_list(run).alias("runs"), F.max("need").alias("need"))
        .where(_covered(F.flatten("runs.windows")) >= F.col("need"))
        .select(*_TEXT_HASHES, "item_row", F.array_sort("runs").alias("runs"))
    )


def _taken(runs: Column, mine: Column, other: Column) -> Column:
    """Fold of the runs, longest first: the windows and slots of those that agree with one another."""

    def one_to_one(slots: Column) -> Column:
        pairs = F.array_distinct(F.transform(slots, lambda s: F.struct(s["mine"].alias("mine"), s["other"].alias("other"))))
        return let(
            pairs,
            lambda p: (F.size(p) == F.size(F.array_distinct(p["mine"]))) & (F.size(p) == F.size(F.array_distinct(p["other"]))),
        )

    def slots_of(windows: Column) -> Column:
        def of_window(w: Column) -> Column:
            places = F.array(*[F.lit(k) for k in range(WINDOW)])
            slots = F.filter(places, lambda k: _is_slot(F.get(mine, w["mine"] + k)))
            return F.transform(
                slots,
                lambda k: F.struct(
                    F.get(mine, w["mine"] + k)["at"].alias("at"),
                    F.get(mine, w["mine"] + k)["filler"].alias("mine"),
                    F.get(other, w["other"] + k)["filler"].alias("other"),
                ),
            )

        return F.flatten(F.transform(windows, of_window))

    def equal(w: Column) -> Column:
        """Equal entries, not only equal hashes."""
        same = F.lit(True)
        for k in range(WINDOW):
            same = same & F.get(mine, w["mine"] + k)["t"].eqNullSafe(F.get(other, w["other"] + k)["t"])
        return same

    def take(so_far: Column, run: Column) -> Column:
        return let(
            F.filter(run["windows"], equal),
            lambda windows: let(
                F.array_union(so_far["slots"], slots_of(windows)),
                lambda slots: F.when(
                    one_to_one(slots),
                    F.struct(F.concat(so_far["windows"], windows).alias("windows"), slots.alias("slots")),
                ).otherwise(so_far),
            ),
        )

    nothing = F.struct(
        F.array().cast("array<struct<mine:int,other:int,at:int,upto:int>>").alias("windows"),
        F.array().cast("array<struct<at:int,mine:string,other:string>>").alias("slots"),
    )
    return F.aggregate(runs, nothing, take)


def _leaks(docs: DataFrame, benchmark: DataFrame, text: str, item: str, item_text: str) -> DataFrame:
    """Text hashes, item, ``coverage``, ``start_word`` and ``n_changed``, one row per text and item row."""
    items = _items(benchmark, item, item_text)
    chains = stored(_chains(docs, items, text))
    texts = stored(chains.select(*_TEXT_HASHES).distinct())
    hashed = docs.select(F.col(text).alias("text"), *_text_hashes(text))
    suspects = stored(
        hashed.join(broadcast_if_small(texts), _TEXT_HASHES, "left_semi")
        .dropDuplicates(_TEXT_HASHES)
        .select(*_TEXT_HASHES, _entries(_stripped(F.col("text"))).alias("theirs"))
    )
    met = (
        chains.join(suspects, _TEXT_HASHES)
        .join(broadcast_if_small(items.select("item_row", "item", "entries", "size", "need")), "item_row")
        .withColumn("taken", _taken(F.col("runs"), F.col("entries"), F.col("theirs")))
    )
    changed = F.filter("taken.slots", lambda s: s["mine"] != s["other"])
    checked = stored(
        met.select(
            *_TEXT_HASHES,
            "item_row",
            "item",
            "size",
            "need",
            _covered(F.col("taken.windows")).alias("covered"),
            F.array_min(F.transform("taken.windows", lambda w: F.get("theirs", w["other"])["at"])).alias("start_word"),
            F.size(F.array_distinct(F.transform(changed, lambda s: s["at"]))).alias("n_changed"),
        )
    ).where("covered >= need")
    # One best place per text and item.
    leak = F.struct("item", (F.col("covered") / F.col("size")).alias("coverage"), "start_word", "n_changed")
    best = checked.groupBy(*_TEXT_HASHES, "item_row").agg(
        F.max_by(leak, F.struct("covered", -F.col("n_changed"), -F.col("start_word"))).alias("leak")
    )
    return stored(best.select(*_TEXT_HASHES, "leak.*"))


def find_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    item: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """Key, item, ``coverage``, ``start_word`` and ``n_changed`` (slots filled differently) of each leak."""
    leaks = _leaks(docs, benchmark, text, item, item_text)
    rows = docs.select(F.col(key).alias("key"), *_text_hashes(text))
    return rows.join(broadcast_if_small(leaks), _TEXT_HASHES).select(
        F.col("key").alias(key), F.col("item").alias(item), "coverage", "start_word", "n_changed"
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents, all columns, without those that leak an item. A row needs no id."""
    hidden = [f"_leak_{n}" for n in _TEXT_HASHES]
    leaks = _leaks(docs, benchmark, text, "item_id", "text")
    gone = stored(leaks.select(*[F.col(n).alias(h) for n, h in zip(_TEXT_HASHES, hidden, strict=True)]).distinct())
    hashed = docs.select("*", *_text_hashes(text, hidden))
    return hashed.join(broadcast_if_small(gone), hidden, "left_anti").select(*docs.columns)
