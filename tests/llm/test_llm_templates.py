"""Template decontamination: recall on changed items, and equality with a plain matcher."""

import random
import re
from collections import defaultdict

import pytest

from orderlens.llm import decontaminate
from orderlens.llm.decontaminate import LEAST_COVERAGE, LEAST_DRIFT, LEAST_WORDS, SIGNS, UNITS, WINDOW

NAME = re.compile(r"[A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ]+")
FILLER = "quite ordinary words of some document that has nothing at all to hide from anybody who reads".split()


def _plain(word):
    low = word.lower()
    if re.match("[+-]?[0-9]", word):
        if re.fullmatch("[+-]?[0-9][0-9.,]*(?:st|nd|rd|th)?", low):
            return "<number>"
        return "<quantity>" if re.fullmatch(f"[0-9][0-9.,]*(?:{UNITS})", low) else low
    return "<unit>" if low in UNITS.split("|") and low != "in" else low


def _readings(text):
    """Both readings as lists of (template, filler, first word, end)."""
    words = [w.strip(SIGNS) for w in (text or "").split()]
    plain = [(_plain(w), w.lower(), i, i + 1) for i, w in enumerate(words)]
    typed = []
    for i, w in enumerate(words):
        if NAME.fullmatch(w) and typed and typed[-1][0] == "<name>":
            typed[-1] = ("<name>", f"{typed[-1][1]} {w.lower()}", typed[-1][2], i + 1)
        else:
            typed.append(("<name>" if NAME.fullmatch(w) else _plain(w), w.lower(), i, i + 1))
    return plain, typed


def _windows(reading):
    return [reading[i : i + WINDOW] for i in range(len(reading) - WINDOW + 1)]


def _words_in(windows):
    return {p for w in windows for p in range(w[0][2], w[-1][3])}


def _one_to_one(slots):
    pairs = {(mine, other) for _, mine, other in slots}
    return len(pairs) == len({m for m, _ in pairs}) == len({o for _, o in pairs})


def plain_matcher(text, item):
    """(covered share, changed slots) of the best place, or None."""
    runs, counted = defaultdict(list), []
    for typed, (mine, other) in enumerate(zip(_readings(item), _readings(text), strict=True)):
        for a in _windows(mine):
            names = [e for e in a if e[0] == "<name>"]
            if sum(e[0].startswith("<") for e in a) > WINDOW - 2 or (typed and not names):
                continue
            counted.append(a)
            for b in _windows(other):
                if [e[0] for e in a] == [e[0] for e in b]:
                    runs[typed, b[0][2] - a[0][2]].append((a, b))
    size, n = len(_words_in(counted)), len((item or "").split())
    need, drift = max(-int(-LEAST_COVERAGE * size // 1), min(size, LEAST_WORDS)), LEAST_DRIFT + n // 4
    best = None
    for band in {start // drift - i for _, start in runs for i in (0, 1)}:
        chain = [(-len(set(map(str, ws))), typed, start, ws) for (typed, start), ws in runs.items() if start // drift - band in (0, 1)]
        taken, slots = [], set()
        for *_, ws in sorted(chain, key=lambda c: c[:3]):
            more = slots | {(x[2], x[1], y[1]) for a, b in ws for x, y in zip(a, b, strict=True) if x[0].startswith("<")}
            if _one_to_one(more):
                taken, slots = taken + [a for a, _ in ws], more
        covered = len(_words_in(taken))
        if size and covered >= need:
            changed = len({at for at, mine, other in slots if mine != other})
            best = max(best or (0, 0), (covered / size, -changed))
    return best and (best[0], -best[1])


def _two_word_names(text):
    words = []
    for w in text.split():
        core = w.strip(SIGNS)
        words.append(w.replace(core, f"{core} Q{core.lower()}") if NAME.fullmatch(core) else w)
    return " ".join(words)


def variations(text):
    words = text.split()
    half = len(words) // 2
    return {
        "verbatim": text,
        "other numbers": re.sub("[0-9]+", lambda m: str(int(m[0]) + 7), text),
        "lower case": text.lower(),
        "upper case": text.upper(),
        "one word replaced": " ".join([*words[:half], "zzz", *words[half + 1 :]]),
        "one word put in": " ".join([*words[:half], "zzz", *words[half:]]),
        "one word left out": " ".join([*words[:half], *words[half + 1 :]]),
        "first three quarters": " ".join(words[: len(words) * 3 // 4]),
        "names of two words": _two_word_names(text),
    }


def test_recall_on_changed_items(spark):
    """Nine variations of every item of the largest given table, between words that no item has."""
    chance = random.Random(3)
    items = spark.read.parquet("/root/testdata/sf0.1/benchmark.parquet")
    rows, made_of = [], {}
    for item in items.collect():
        for kind, text in variations(item["text"]).items():
            made_of[len(rows)] = (kind, item["item_id"])
            around = [" ".join(chance.choices(FILLER, k=30)) for _ in range(2)]
            rows.append((len(rows), f"{around[0]} {text} {around[1]}"))
    for _ in range(200):
        rows.append((len(rows), " ".join(chance.choices(FILLER, k=80))))
    found = decontaminate.find_contaminated(spark.createDataFrame(rows, "doc_id long, text string"), items)
    caught = defaultdict(set)
    for r in found.collect():
        # Nothing but the item a text was made of.
        kind, item = made_of[r["doc_id"]]
        assert item == r["item_id"]
        caught[kind].add(item)
    assert set(caught) == set(variations("a b"))
    assert min(map(len, caught.values())) >= 0.9 * items.count()


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_a_plain_matcher(spark, seed):
    chance = random.Random(seed)
    words = "the train from to leaves with 5 7 12km miles day Anna Bert Carla Rome Paris, runs and slow".split()
    items = [" ".join(chance.choices(words, k=chance.choice([3, 5, 8, 14, 25]))) for _ in range(30)]
    texts = [None, "", "-- --"]
    for _ in range(60):
        parts = []
        for _ in range(chance.randint(1, 3)):
            copy = chance.choice(items).split()
            rename = dict(zip(words, chance.sample(words, len(words)), strict=True)) if chance.random() < 0.3 else {}
            copy = [rename.get(w, w) if w[0].isupper() or w[0].isdigit() else w for w in copy]
            for _ in range(chance.choice([0, 0, 1, 2])):
                at = chance.randrange(len(copy))
                copy[at : at + chance.choice([0, 1])] = chance.choices(words, k=chance.choice([0, 1]))
                copy = copy or ["x"]
            parts.append(" ".join(copy).upper() if chance.random() < 0.1 else " ".join(copy))
        texts.append(" zz ".join(parts))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    table = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    found = {
        (r["doc_id"], r["item_id"]): (r["coverage"], r["n_changed"])
        for r in decontaminate.find_contaminated(docs, table).collect()
    }
    expected = {
        (d, i): match for d, t in enumerate(texts) for i, u in enumerate(items) if (match := plain_matcher(t, u))
    }
    assert len(expected) > 40 and any(changed for _, changed in expected.values())
    assert found == expected


def test_rows_without_ids_repeated_rows_and_a_very_long_text(spark):
    item = "A train from Paris leaves at 9 and travels 120 km before it meets the slow train that Anna drives"
    long = " ".join(FILLER * 4000)
    texts = [item, item, item, f"{long} {item} {long}", long, None]
    docs = spark.createDataFrame(
        [(i, t, "x") for i, t in zip([None, None, 4, 5, 5, None], texts, strict=True)],
        "doc_id long, text string, text_hash_1 string",
    )
    table = spark.createDataFrame([(1, item), (1, item)], "item_id long, text string")
    rows = decontaminate.find_contaminated(docs, table).collect()
    # Each row is reported once for each item row.
    assert sorted(str(r["doc_id"]) for r in rows) == ["4"] * 2 + ["5"] * 2 + ["None"] * 4
    left = decontaminate.remove_contaminated(docs, table)
    assert left.columns == docs.columns
    assert [(r["doc_id"], r["text"]) for r in left.orderBy("doc_id").collect()] == [(None, None), (5, long)]


def test_typed_windows_without_a_name_are_not_made(spark):
    texts = ["one two three four five six seven", "one two Three Four five six seven eight", "a b", "", "A Bob c d e f g h i j k"]
    words = [t.split() for t in texts]
    df = spark.createDataFrame([(w,) for w in words], "words array<string>")
    found = [r[0] for r in df.select(decontaminate._windows(decontaminate.F.col("words"))).collect()]
    for mine, of in zip(words, found, strict=True):
        plain = max(0, len(mine) - 4)
        assert [(w["entry"], w["place"]) for w in of[:plain]] == [(i, i) for i in range(plain)]
        named = [len(w) > 1 and w[0].isupper() and w[1:].islower() for w in mine]
        starts = [i for i in range(len(mine)) if not (named[i] and i and named[i - 1])]
        typed = [
            (len(mine) + k, starts[k]) if any(named[i] for i in starts[k : k + 5]) else None
            for k in range(max(0, len(starts) - 4))
        ]
        assert [w and (w["entry"], w["place"]) for w in of[plain:]] == typed


def test_windows_of_documents_are_hashed_as_rows(spark):
    """No function of an array hashes a window of a document: such functions are not compiled."""
    docs = spark.createDataFrame([("One two Three 4 km five six seven",)], "text string")
    items = decontaminate._items(docs.selectExpr("1 item_id", "text"), "item_id", "text")
    plan = decontaminate._chains(docs, items, "text")._jdf.queryExecution().optimizedPlan().toString()
    generated = [line for line in plan.splitlines() if "Generate " in line]
    assert len(generated) >= 3
    assert not any("xxhash64" in line for line in generated)


def test_windows_as_rows_and_in_arrays_are_equal(spark):
    odd = ["One Two three 4 km Five six Seven eight", "a b", "", None, "--", " a -- b. Anna Bert c d e ", "A b c d e"]
    docs = spark.createDataFrame([(t,) for t in odd], "text string")
    rows = decontaminate._document_windows(docs, "text")
    made = decontaminate.F.inline(decontaminate._windows(decontaminate._stripped(docs.text)))
    arrays = docs.select(*decontaminate._text_hashes("text"), made.alias("hash", "entry", "place")).where("hash is not null")
    assert rows.count() > 10
    assert sorted(rows.collect()) == sorted(arrays.collect())


def test_words_and_the_signs_at_their_ends(spark):
    dashes = "-" * 200_000
    texts = [None, "", " \t", "--", "-- --", "a --", "-- a", " a-- --b -- c--d.\n\n“e” ¿f?\x0b", "\u00a0g h\u2014"]
    texts.append(f"{dashes} a{dashes}b {dashes}")
    texts += ["".join(random.Random(i).choices("aB9é字 \t\r-.(“¿", k=60)) for i in range(300)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    found = [r[0] for r in df.select(decontaminate._stripped(df.text)).collect()]
    assert found == [[w.strip(SIGNS) for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")] for t in texts]
