"""Operators that work on one text at a time, against the libraries and plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from orderlens.llm import licenses, packing, pii, quality_rules, token_counts, toxicity
from orderlens.llm.queries import public_tokenizer

# Texts that any operator must take: null, empty, blank, tiny, long, repeated, odd characters.
ODD = [
    None,
    "",
    "   \n\t ",
    "one",
    "two words",
    "the same three words the same three words the same three words",
    "line\nline\nother\n\nline",
    "x" * 3000,
    "a b " * 5000,
    "Été İstanbul Kelvin ΣΣ \U0001f600 中文 \x00 ﬁ",
    "mail a.b@c.example.com, 10.0.0.1, 4111 1111 1111 1111 and +1 (555) 123-4567.",
    "Licensed under CC BY-NC 4.0. cc by cc by. ALL RIGHTS RESERVED.",
    "<s> <|endoftext|> </s> ▁▁ it's",
    "1.2.3.4.5.6.7.8 999.1.1.1 @ @a a@b a@b.c.",
]


def documents(spark, texts, extra=False):
    rows = [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[5], (None, "no id here", None, None, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    if extra:
        clashing = "key row node score shard slot length start piece size spans words n word kind place".split()
        for name in clashing:
            df = df.selectExpr("*", f"'other' AS {name}")
    return df


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


EMPTY = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("extra", [False, True])
def test_token_counts_equal_the_library(spark, extra):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = token_counts.count_tokens(
        documents(spark, ODD, extra), public_tokenizer("piece_bpe_32k.model"), limit=100
    )
    assert got.count() == len(ODD) + 2
    rows = by_id(got)
    for i, text in enumerate(ODD):
        n = len(model.encode(text or ""))
        assert (rows[i]["n_bytes"], rows[i]["n_tokens"]) == (len((text or "").encode()), n)
        assert rows[i]["over_limit"] == (n > 100)


def test_token_counts_of_random_and_very_long_pieces():
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    counter = token_counts.Counter(token_counts.Merges(path))
    random.seed(5)
    parts = ["a", "b", " ", "▁", "é", "中", "ab", "th", "\x00", "\n", "=", "-", "  ", "0", "the ", "\U0001f600"]
    texts = ["".join(random.choices(parts, k=random.choice([1, 5, 60, 700]))) for _ in range(300)]
    texts += ["a" * 4000, "=" * 2000, " " * 1500, "ab" * 1500, "-a" * 800]
    assert counter(texts) == [len(x) for x in model.encode(texts)]


def test_pieces_and_packing(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    docs = documents(spark, ODD, True)
    rows = packing.pack_documents(docs, public_tokenizer("word_bpe_49k.json"), capacity=64).collect()
    texts = {**dict(enumerate(ODD)), None: "no id here"}
    expected = Counter()
    for key, text in [*texts.items(), (5, ODD[5])]:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        for piece, at in enumerate(range(0, len(ids), 64)):
            part = ids[at : at + 64]
            expected[key, piece, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == expected
    for sequence in {r["sequence_id"] for r in rows}:
        end = 0
        for r in sorted((r for r in rows if r["sequence_id"] == sequence), key=lambda r: r["offset"]):
            assert r["offset"] == end
            end += r["length"]
        assert end <= 64


def test_packing_an_empty_table(spark):
    empty = spark.createDataFrame([], EMPTY)
    assert packing.pack_documents(empty, public_tokenizer("word_bpe_49k.json")).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_best_two_fit_places_everything_and_wastes_little(seed):
    random.seed(seed)
    counts = Counter(random.choice([3, 7, random.randint(1, 60), random.randint(30, 100)]) for _ in range(3000))
    plan = packing.best_two_fit(counts, 100)
    filled = Counter()
    ranks = Counter()
    for first, length, sequence, copies, offset in zip(
        plan.first, plan.length, plan.sequence, plan.copies, plan.offset, strict=True
    ):
        assert first == ranks[length]
        ranks[length] += copies
        for c in range(copies):
            filled[sequence + c] += length
        assert offset + length <= 100
    assert ranks == counts and max(filled.values()) <= 100
    assert plan.sequences <= 1.02 * math.ceil(sum(k * n for k, n in counts.items()) / 100) + 1


def test_replacement_takes_two_that_fit_more_tightly():
    # Greedy takes 60 then 30 and leaves 10; 21 and 19 fill what 30 and the rest would.
    plan = packing.best_two_fit({60: 1, 30: 1, 21: 1, 19: 1}, 100)
    first = [int(x) for x, s in zip(plan.length, plan.sequence, strict=True) if s == 0]
    assert sorted(first) == [19, 21, 60]


def _quality(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {k + j for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_quality_counts_and_verdicts(spark):
    random.seed(1)
    vocabulary = ["the", "of", "and", "to", "in"] * 6 + [f"word{chr(97 + i)}" for i in range(26)]
    clean = [" ".join(random.choices(vocabulary, k=150)) for _ in range(400)]
    shout = [" ".join(w.upper() + "!!" for w in random.choices(vocabulary, k=150)) for _ in range(3)]
    signs = [" ".join(w + "%%%" for w in random.choices(vocabulary, k=150)) for _ in range(3)]
    texts = ODD + clean + shout + signs
    rows = quality_rules.judge(documents(spark, texts, True)).collect()
    assert len(rows) == len(texts) + 2
    for r in rows:
        if r["doc_id"] is None:
            continue
        expected = _quality(texts[r["doc_id"]] or "")
        assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == expected
        n, repeated = expected[0], expected[4]
        assert r["base_failed"] == (n < 50 or 100 * repeated > 50 * n)
    kept = {r["doc_id"] for r in rows if r["kept"]}
    first = len(ODD)
    assert {first + i for i in range(400)} <= kept
    assert not kept & {first + 400 + i for i in range(6)}


def test_quality_rejects_texts_that_lack_common_words(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    good = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").where("quality = 1").select("doc_id")
    random.seed(6)
    letters = "abcdefghijklmnopqrstuvwxyz"
    gibberish = [" ".join("".join(random.choices(letters, k=7)) for _ in range(n)) for n in (60, 150, 600)]
    dots = [" ".join("".join(random.choices(".,;:!?-", k=5)) for _ in range(n)) for n in (60, 150, 600)]
    added = [(-1 - i, t, "en") for i, t in enumerate(gibberish + dots)]
    # Sound texts under the name of a language they are not in.
    sound = docs.join(good, "doc_id").where("size(split(text, ' ')) > 400")
    other = {"en": "de", "de": "es", "es": "fr", "fr": "en"}
    for i, r in enumerate(r for lang in other for r in sound.where(f"lang = '{lang}'").orderBy("doc_id").take(2)):
        added.append((-100 - i, r["text"], other[r["lang"]]))
    both = docs.unionByName(spark.createDataFrame(added, docs.schema))
    rows = quality_rules.judge(both).collect()
    assert len(added) > 10
    assert not [r for r in rows if r["doc_id"] < 0 and (r["base_failed"] or r["kept"])]
    kept = {r["doc_id"] for r in rows if r["kept"] or r["base_failed"]}
    assert {r["doc_id"] for r in good.collect()} <= kept


def test_quality_of_an_empty_table_and_kept_columns(spark):
    assert quality_rules.judge(spark.createDataFrame([], EMPTY)).count() == 0
    docs = documents(spark, ODD, True)
    assert quality_rules.keep_good(docs).columns == docs.columns


def test_licences_equal_brute_force(spark):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    texts = ODD + [
        "Some text.\nReleased under the MIT License.",
        "This work is licensed under the GNU General Public License, version 3.",
        "mit and license and apache but no notice",
        "Licensed under the Apache License, Version 2.0. More. All rights reserved.",
    ]
    rows = by_id(licenses.scan(documents(spark, texts, True)))
    for i, text in enumerate(texts):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(lower))
        starts, labels = [], set()
        for phrase, label in licenses.BASE_PHRASES.items():
            parts = phrase.split()
            here = [k for k in range(len(words)) if words[k : k + len(parts)] == parts]
            starts += here
            labels |= {label} if here else set()
        r = rows[i]
        assert (r["n_words"], r["n_base"], r["base_labels"]) == (len(words), len(starts), ",".join(sorted(labels)))
        assert (r["first_word"], r["last_word"]) == ((min(starts), max(starts)) if starts else (None, None))
        assert labels <= set(r["labels"].split(",")) | set() if labels else True
        assert 0 <= r["score"] <= 1
    found = {i - len(ODD): rows[i]["labels"] for i in range(len(ODD), len(texts))}
    assert found == {0: "mit", 1: "gpl,gpl-3.0", 2: "", 3: "apache-2.0,reserved"}
    assert licenses.scan(spark.createDataFrame([], EMPTY)).count() == 0


def test_several_licences_in_one_text(spark):
    wording = {}
    for label, words, _ in licenses.TEMPLATES:
        wording[label] = max(wording.get(label, ""), words, key=len)
    pairs = [("mit", "apache-2.0"), ("isc", "apache-2.0"), ("mit", "bsd"), ("bsd", "cc-by-4.0"), ("isc", "mpl-2.0")]
    texts = [f"{wording[a]}. And here: {wording[b]}." for a, b in pairs]
    texts += [f"{wording['bsd']}; {wording['apache-2.0']}; {wording['cc-by-4.0']}", "\n".join(w for _, w, _ in licenses.TEMPLATES)]
    rows = by_id(licenses.scan(documents(spark, [*texts, *["plain words of no licence"] * 20])))
    for i, pair in enumerate(pairs):
        assert set(pair) <= set(rows[i]["labels"].split(",")), pair
    assert {"bsd", "apache-2.0", "cc-by-4.0"} <= set(rows[len(pairs)]["labels"].split(","))
    assert {label for label, _, _ in licenses.TEMPLATES} <= set(rows[len(pairs) + 1]["labels"].split(","))


def _base(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    spans = [("email", m) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    ips = re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
    spans += [("ip", m) for m in ips if all(int(x) <= 255 for x in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        if 13 <= len(digits(m.group())) <= 19 and pii.luhn(digits(m.group())):
            spans.append(("card", m))
    phones = re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
    spans += [("phone", m) for m in phones if 9 <= len(digits(m.group())) <= 15]
    return [(k, m.start(), m.end()) for k, m in spans]


def test_base_spans_equal_the_plain_patterns():
    random.seed(2)
    parts = ["a", "@", ".", "b.c", "1", "12", "255", "300", "4111111111111111", " ", "-", "+", "(", ")", "é", "+1 (555) 123-4567", "x@y.z"]
    for _ in range(3000):
        text = "".join(random.choices(parts, k=random.randint(1, 25)))
        assert pii.base_spans(text) == _base(text), text


def test_personal_data_rows(spark):
    texts = ODD + ['key token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" end', "card 1234567890123456 is none"] * 3
    found = pii.digest(pii.find_personal_data(documents(spark, texts, True)))
    rows = by_id(found)
    for i, text in enumerate(texts):
        base = _base(text or "")
        written = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert rows[i]["base_sha256"] == hashlib.sha256(written.encode()).hexdigest()
        assert set(filter(None, written.split(","))) <= set(rows[i]["spans"].split(","))
    assert rows[len(ODD)]["spans"].startswith("secret:13:53")
    assert rows[len(ODD) + 1]["spans"] == ""
    empty = pii.find_personal_data(spark.createDataFrame([], EMPTY))
    assert pii.digest(empty).count() == 0


def test_masking_replaces_spans_and_nothing_else(spark):
    docs = documents(spark, ODD, True)
    masked = pii.mask(docs)
    assert masked.columns == docs.columns
    rows = by_id(masked)
    assert rows[10]["text"] == "mail [EMAIL], [IP], [CARD] and [PHONE]."
    assert rows[10]["n_chars"] == len(rows[10]["text"])
    assert rows[0]["text"] is None and rows[7]["text"] == ODD[7]


def test_masking_leaves_nothing_of_overlapping_spans(spark):
    texts = [
        "see 1.2.3.4-max@firma.de now",
        "+4915112345678-max@firma.de",
        "mail 4111 1111 1111 1111-max@firma.de, 10.0.0.1.",
        "1.2.3.4-a@firma.de b@c.example.com",
        "",
        None,
    ]
    docs = documents(spark, texts)
    masked = by_id(pii.mask(docs))
    found = by_id(pii.find_personal_data(docs))
    for i, text in enumerate(texts):
        # Pieces of the text that no span holds, with one mark for each run that spans hold.
        covered = {k for s in found[i]["spans"] for k in range(s["start"], s["end"])}
        outside = "".join("\0" if k in covered else c for k, c in enumerate(text or ""))
        plain = re.sub(r"\[(EMAIL|IP|CARD|PHONE|ID|SECRET)\]", "\0", masked[i]["text"] or "")
        assert re.sub("\0+", "\0", plain) == re.sub("\0+", "\0", outside)
        assert masked[i]["n_chars"] == len(masked[i]["text"] or "")
    assert masked[0]["text"] == "see [EMAIL] now" and masked[1]["text"] == "[EMAIL]"
    assert masked[3]["text"] == "[EMAIL] [EMAIL]"


def test_reliabilities_prefer_what_most_labelers_say():
    votes = np.array([[1, 1, 1, 1, 1], [0, -1, -1, 0, -1]])
    likely = pii.reliabilities(np.array([2, 2]), votes, np.array([100, 100]))
    assert likely[0] > 0.95 and likely[1] < 0.05


def test_toxicity_generalises_to_unseen_misspellings(spark):
    random.seed(3)
    plain = ["then", "and", "river", "stone", "walks", "over", "bright", "meadow", "quiet", "house"]
    rude = ["stupidhead", "stupidly", "stupids", "stupid"]
    texts = [" ".join(random.choices(plain, k=40) + (random.choices(rude, k=3) if i % 4 == 0 else [])) for i in range(600)]
    labels = [(i, int(i % 4 == 0)) for i in range(600)] + [(700, None), (None, 1)]
    texts += ["", " ".join(plain * 4 + ["stupiid", "stup1d", "stupidd"]), " ".join(plain * 4)]
    docs = documents(spark, texts, True)
    rows = by_id(toxicity.score_toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int")))
    right = [rows[i]["predicted"] == int(i % 4 == 0) for i in range(600) if rows[i]["held_out"]]
    assert sum(right) >= 0.98 * len(right)
    for i in range(600):
        assert rows[i]["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1)
    assert rows[601]["score"] > rows[602]["score"] and rows[601]["score"] > 0.5
    assert 0 <= rows[600]["score"] <= 1


def test_toxicity_without_labels_or_documents(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    rows = toxicity.score_toxicity(documents(spark, ODD), none).collect()
    assert {r["predicted"] for r in rows} == {0}
    assert toxicity.score_toxicity(spark.createDataFrame([], EMPTY), none).count() == 0


def test_common_words_are_looked_up_by_hash(spark, monkeypatch):
    texts = [(f"d{i}", " ".join(f"w{k}" for k in range(60) for _ in range(1 + (k * 7 + i) % 5)) + " the The th", "en") for i in range(4)]
    docs = spark.createDataFrame([*texts, ("e", None, "en"), ("f", "w1 w2 w1", None)], "doc_id string, text string, lang string")
    found = {}
    # With few fields all words share theirs with others; with very many none does.
    for fields in (2, quality_rules.FIELDS, 1 << 16):
        monkeypatch.setattr(quality_rules, "FIELDS", fields)
        words = quality_rules.common_words(docs)
        assert {len(r["fields"]) for r in words.collect()} == {fields}
        joined = docs.join(words, docs["lang"].eqNullSafe(words["ref_lang"]), "left").drop("ref_lang")
        figures = quality_rules._figures(joined, "text", "lang", ["doc_id"]).collect()
        found[fields] = {r["doc_id"]: r["places"] for r in figures}
    tops = {r["ref_lang"]: r["top_words"] for r in quality_rules.common_words(docs).collect()}
    for doc_id, text, lang in [*texts, ("e", "", "en"), ("f", "w1 w2 w1", None)]:
        top = [*tops[lang], *[None] * quality_rules.COMMON_WORDS][: quality_rules.COMMON_WORDS]
        assert {tuple(f[doc_id]) for f in found.values()} == {tuple(float(text.split().count(w)) for w in top)}
