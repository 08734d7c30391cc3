"""Vector codes, languages of mixed text and cross-tokenizer alignment, against brute force."""

import hashlib
import random
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest

from orderlens.llm import language_spans, queries, token_alignment, vector_codes
from orderlens.llm.queries import public_tokenizer

SF = "/root/testdata/sf0.001"
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = "key row label error codes whole pairs times pair best language item n text_to_map n_a".split()


def clash(df):
    return df.selectExpr("*", *[f"'other' AS {c}" for c in CLASHING if c not in df.columns])


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


# ---- vector codes ----


def test_walsh_hadamard_is_in_sequency_order_and_keeps_distances():
    for size in (1, 2, 4, 8, 16):
        changes = [int((np.diff(row) != 0).sum()) for row in vector_codes.walsh_hadamard(np.eye(size, dtype=np.int64)).T]
        assert changes == list(range(size))
    rng = np.random.default_rng(3)
    a, b = rng.integers(-5000, 5000, (2, 40, 6))
    gap = vector_codes.walsh_hadamard(a) - vector_codes.walsh_hadamard(b)
    assert ((gap**2).sum(axis=1) == 8 * ((a - b) ** 2).sum(axis=1)).all()


@pytest.mark.parametrize("width", [1, 2, 3, 8, 13])
def test_nearest_entries_equal_brute_force_with_ties(width):
    rng = np.random.default_rng(width)
    for spread in (2, 5, 1 << 20):
        rows, entries = rng.integers(-spread, spread, (200, width)), rng.integers(-spread, spread, (16, width))
        gap = ((rows[:, None] - entries[None]) ** 2).sum(axis=2)
        best, least = vector_codes.nearest(
            vector_codes.walsh_hadamard(rows), vector_codes.walsh_hadamard(entries)
        )
        assert (best == gap.argmin(axis=1)).all()
        assert (least == gap.min(axis=1)).all()


def test_vector_codes_equal_sql(spark):
    got = queries.op11_integer_walsh_codes(spark, SF).collect()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    want = con.execute(queries.ORACLE["op11_integer_walsh_codes"]).fetchall()
    columns = [d[0] for d in con.description]
    assert sorted(tuple(r[c] for c in columns) for r in got) == sorted(want)


@pytest.mark.parametrize("extra", [False, True])
def test_vector_codes_of_odd_rows(spark, extra):
    nan, inf = float("nan"), float("inf")
    vectors = [(i, [i / 10.0, -i / 7.0, 0.25, 1.0], i % 2) for i in range(20)]
    odd = [(100, None, 1), (101, [nan] * 4, 1), (102, [inf, 0.0, 0.0, 0.0], 1), (103, [None, 1.0, 1.0, 1.0], 1)]
    short = [(104, [0.5], None), (105, [], None), (None, [1.0] * 4, None), (3, [0.3, -3 / 7.0, 0.25, 1.0], 1)]
    huge = [(106, [1e30, -1e30, 0.0, 0.0], 7)]
    df = spark.createDataFrame(vectors + odd + short + huge, "vec_id long, embedding array<double>, label int")
    df = clash(df) if extra else df
    coded, books = vector_codes.compress(df, parts=2, entries=4, rounds=3)
    rows = vector_codes.digest(coded, books).collect()
    assert len(rows) == 25
    assert books.entries.shape == (2, 4, 2)
    codes = Counter((r["vec_id"], r["code"]) for r in rows)
    assert max(n for (k, _), n in codes.items() if k == 3) == 2
    assert len({r["label_error"] for r in rows if r["vec_id"] in (104, 105, None)}) == 1
    assert len({r["codebooks_sha256"] for r in rows}) == 1


def test_vector_codes_of_nothing(spark):
    schema = "vec_id long, embedding array<float>, label int"
    for rows in ([], [(1, None, 2)]):
        coded, books = vector_codes.compress(spark.createDataFrame(rows, schema))
        assert vector_codes.digest(coded, books).count() == 0


# ---- languages ----


def brute_path_value(scores, penalty):
    value = scores[0].copy()
    for row in scores[1:]:
        value = np.maximum(value, value.max() - penalty) + row
    return value.max()


def test_paths_are_as_good_as_those_of_a_plain_viterbi():
    rng = np.random.default_rng(1)
    for _ in range(200):
        sizes = rng.integers(1, 9, rng.integers(1, 6))
        scores = -rng.integers(0, 9, (sizes.sum(), rng.integers(1, 5))).astype(np.int64)
        penalty = int(rng.integers(1, 10))
        labels = language_spans.best_paths(scores, sizes, penalty)
        at = 0
        for n in sizes:
            mine, path = scores[at : at + n], labels[at : at + n]
            value = mine[np.arange(n), path].sum() - penalty * (np.diff(path) != 0).sum()
            assert value == brute_path_value(mine, penalty)
            at += n


def test_words_and_their_grams_equal_plain_code():
    tokens = ["it's", "Ünïcode42x", "Привет,мир", "été", "--", "中文ab", "İ"]
    words = language_spans.words_in(tokens)
    assert words.token.tolist() == [0, 0, 1, 1, 2, 2, 3, 5, 5, 6]
    assert words.letters.tolist() == [2, 1, 7, 1, 6, 3, 3, 2, 2, 1]
    assert [language_spans.NAMES[s] for s in words.script.tolist()][4:9] == ["Cyrillic", "Cyrillic", "Latin", "Han", "Latin"]
    # n letters in marks: n + 2 characters hold n, n + 1, n, n - 1 grams of 1 to 4 characters.
    grams = np.bincount(words.of_word)
    assert grams.tolist() == [n + (n + 1) + n + (n - 1) for n in words.letters.tolist()]
    # Equal words have equal grams wherever they stand.
    again = language_spans.words_in(["xx", "it's"])
    one = sorted(words.bucket[words.of_word == 0].tolist())
    assert sorted(again.bucket[again.of_word == 1].tolist()) == one


SAMPLES = {
    "en": "the house of the king is there and that is what they thought with this one",
    "de": "das haus der könig ist dort und nicht was sie mit diesem einen dachten schön",
    "ru": "это дом короля и он там что они думали об этом",
    "bg": "това е къщата на краля и той е там какво мислеха за това",
}


def corpus(spark, extra=False):
    rows = [(i, text, lang, None, 0) for i, (lang, text) in enumerate(list(SAMPLES.items()) * 40)]
    df = spark.createDataFrame(rows, DOCUMENTS)
    return clash(df) if extra else df


def test_scripts_narrow_and_spans_follow_the_languages(spark):
    model = language_spans.learn(corpus(spark))
    assert model.languages == sorted(SAMPLES)
    mixed = SAMPLES["en"] + " 12 -- " + SAMPLES["de"] + "\n" + SAMPLES["bg"]
    spans = language_spans.spans_of(mixed, model)
    assert [x[2] for x in spans] == ["en", "de", "bg"]
    assert mixed[spans[0][0] : spans[0][1]] == SAMPLES["en"] + " 12 --"
    assert mixed[spans[1][0] : spans[1][1]] == SAMPLES["de"]
    assert mixed[spans[2][0] : spans[2][1]] == SAMPLES["bg"]
    # A Cyrillic word can't be English, whatever stands around it.
    labels = language_spans.label_words([SAMPLES["en"] + " дом " + SAMPLES["en"]], model)
    scores = model.scores(language_spans.words_in(["дом"]))
    assert scores[0][model.languages.index("en")] < -language_spans.CLIP * language_spans.UNIT
    assert len(labels.label) == len(SAMPLES["en"].split()) * 2 + 1


@pytest.mark.parametrize("extra", [False, True])
def test_languages_of_odd_rows(spark, extra):
    model = language_spans.learn(corpus(spark, extra))
    texts = [None, "", " \n\t", "42 -- !", "the", "x" * 30_000, "das haus " * 30_000, "؀́", "日本"]
    rows = [(i, t, None, None, 0) for i, t in enumerate(texts)] + [(4, "the", "en", "", 3), (None, "das haus", "", "", 0)]
    df = spark.createDataFrame(rows, DOCUMENTS)
    got = language_spans.predict(clash(df) if extra else df, model).collect()
    assert len(got) == len(rows)
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in got}
    assert [found[i] for i in (0, 1, 2, 3, 7)] == [("und", 0.0)] * 5
    assert (found[4][0], found[6][0], found[None][0]) == ("en", "de", "de")
    assert all(0 <= r["score"] <= 1 for r in got)
    assert not [r for r in got if r["doc_id"] is None][0]["held_out"]


def test_nothing_learned_and_empty_tables(spark):
    empty = spark.createDataFrame([], DOCUMENTS)
    model = language_spans.learn(empty)
    assert model.languages == []
    assert language_spans.predict(empty, model).count() == 0
    rows = language_spans.predict(spark.createDataFrame([(1, "the", "en", "", 3)], DOCUMENTS), model).collect()
    assert [(r["lang_pred"], r["score"]) for r in rows] == [("und", 0.0)]
    assert language_spans.find_spans(empty, model).count() == 0


def test_counts_do_not_depend_on_partitions(spark):
    docs = corpus(spark)
    one, many = language_spans.learn(docs.coalesce(1)), language_spans.learn(docs.repartition(7))
    assert np.array_equal(one.bucket, many.bucket) and np.array_equal(one.by_length, many.by_length)


def test_held_out_accuracy_of_languages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lang = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    rows = [r for r in language_spans.predict_languages(docs).collect() if r["held_out"]]
    assert len(rows) > 150
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in rows) >= 0.98 * len(rows)


# ---- alignment ----


@pytest.fixture(scope="module")
def tokenizers():
    return token_alignment.Tokenizers(
        public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    )


def brute_alignment(text, tk):
    """Counts, groups and links of one text, byte by byte."""
    if not text:
        return None
    a = tk.a.encode(" " + text, add_special_tokens=False).ids
    b = tk.b.encode(text)
    whole = (" " + text).encode()
    if b"".join(tk.bytes_a[i] for i in a) != whole or b"".join(tk.bytes_b[i] for i in b) != whole:
        return None
    owner_a = [k for k, i in enumerate(a) for _ in tk.bytes_a[i]]
    owner_b = [k for k, i in enumerate(b) for _ in tk.bytes_b[i]]
    groups, now_a, now_b = [], [], []
    for at in range(len(whole)):
        now_a.append(owner_a[at])
        now_b.append(owner_b[at])
        last = at + 1 == len(whole)
        if last or (owner_a[at] != owner_a[at + 1] and owner_b[at] != owner_b[at + 1]):
            groups.append(
                ",".join(str(a[k]) for k in dict.fromkeys(now_a)) + "|" + ",".join(str(b[k]) for k in dict.fromkeys(now_b))
            )
            now_a, now_b = [], []
    pairs = Counter((a[x], b[y]) for x, y in set(zip(owner_a, owner_b, strict=True)))
    return len(a), len(b), groups, pairs


PARTS = ["a", "b ", " ", "é", "中", "ab", "th", "\x00", "\n", "=", "- ", "  ", "0", " the", "\U0001f600", "<s>", "'s"]
PARTS += ["\t", "\x85", "\xa0", "don't ", "ﬁ", "\x1c", " ", "<|endoftext|>"]


def odd_texts():
    random.seed(3)
    texts = ["".join(random.choices(PARTS, k=random.choice([1, 3, 10, 60]))) for _ in range(300)]
    fixed = [None, "", " ", "  a", "a  ", " a b ", "a ▁ b", "▁", "x" * 5000, "a b " * 8000, "the the the"]
    return fixed + texts


@pytest.mark.parametrize("extra", [False, True])
@pytest.mark.parametrize("broadcast_pairs", [0, 1_000_000])
def test_alignment_equals_brute_force(spark, tokenizers, extra, broadcast_pairs):
    texts = odd_texts()
    rows = [(i, t, None, None, 0) for i, t in enumerate(texts)]
    rows += [(len(rows) - 1, texts[-1], "x", "", 0), (None, "no id here", None, None, 0)]
    df = spark.createDataFrame(rows, DOCUMENTS)
    got = token_alignment.align_corpus(
        clash(df) if extra else df,
        public_tokenizer("byte_bpe_50k.json"),
        public_tokenizer("piece_bpe_32k.model"),
        pieces=32_000,
        broadcast_pairs=broadcast_pairs,
    ).collect()
    expected = [(r[0], brute_alignment(r[1], tokenizers)) for r in rows]
    held = Counter(pair for _, e in expected if e for pair in e[3])
    most = {}
    for (a, _), n in held.items():
        most[a] = max(n, most.get(a, 0))
    want = Counter()
    for key, e in expected:
        if e is None:
            want[(key, 0, 0, 0, 0, 0, 0, "")] += 1
            continue
        n_a, n_b, groups, pairs = e
        best = sum(n for p, n in pairs.items() if held[p] == most[p[0]])
        total = sum(n * held[p] for p, n in pairs.items())
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        want[(key, n_a, n_b, len(groups), sum(pairs.values()), best, total, digest)] += 1
    columns = "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256".split()
    assert Counter(tuple(r[c] for c in columns) for r in got) == want


def test_common_ends_of_random_lists():
    random.seed(8)
    for _ in range(500):
        last = random.randint(1, 60)
        a = sorted(random.sample(range(1, last + 1), random.randint(0, last - 1) or 1) + [last])
        b = sorted(random.sample(range(1, last + 1), random.randint(0, last - 1) or 1) + [last])
        a, b = sorted(set(a)), sorted(set(b))
        both = sorted(set(a) & set(b))
        got = token_alignment.common_ends(a, b)
        assert got[0].tolist() == [a.index(x) + 1 for x in both]
        assert got[1].tolist() == [b.index(x) + 1 for x in both]
        links = token_alignment.links(np.array(a), np.array(b))
        spans = lambda ends: list(zip([0, *ends[:-1]], ends, strict=True))
        overlap = [(i, j) for i, (s, e) in enumerate(spans(a)) for j, (t, u) in enumerate(spans(b)) if s < u and t < e]
        assert list(zip(links[0].tolist(), links[1].tolist(), strict=True)) == overlap


def test_alignment_of_an_empty_table(spark):
    empty = spark.createDataFrame([], DOCUMENTS)
    files = public_tokenizer("byte_bpe_50k.json"), public_tokenizer("piece_bpe_32k.model")
    assert token_alignment.align_corpus(empty, *files, pieces=32_000).count() == 0
