"""Operators that compare documents or lay tables out, against brute force and SQL."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from orderlens.llm import decontaminate, near_duplicates, sharding, warc
from orderlens.llm.components import components
from orderlens.llm.queries import ORACLE, QUERIES

EMPTY = "doc_id long, text string, lang string, source string, n_chars long"
BASE = "/root/testdata/sf0.001"


def documents(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, "en", f"s{n % 3}", len(t or "")) for n, (i, t) in enumerate(zip(ids, texts, strict=True))]
    df = spark.createDataFrame(rows, EMPTY)
    for name in "key row node bucket shard slot tie place start item component".split():
        df = df.selectExpr("*", f"'other' AS {name}")
    return df


def _sets(text, k):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - min(k, len(words)) + 1))


def _components(ids, texts, k):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    sets = [_sets(t, k) for t in texts]
    for a in range(len(ids)):
        root(ids[a])
        for b in range(a):
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                first, second = sorted((root(ids[a]), root(ids[b])))
                parent[second] = first
    return {i: root(i) for i in ids}, dict(zip(ids, map(len, sets), strict=True))


def near_corpus(seed):
    """Groups around an original with few to many edits, copies, short and empty texts."""
    random.seed(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = [None, "", " \n", "One", "one", "one two", "ONE  two", "one two three"]
    for _ in range(8):
        original = random.choices(vocabulary, k=random.choice([20, 60, 200]))
        for _ in range(14):
            edited = list(original)
            for _ in range(random.randint(0, len(original) // 8)):
                edited[random.randrange(len(edited))] = random.choice(vocabulary)
            texts.append(" ".join(edited))
        texts += [texts[-1], texts[-1].upper()]
    return texts


@pytest.mark.parametrize("words", [2, 5])
def test_near_duplicates_equal_brute_force(spark, words):
    texts = near_corpus(words)
    ids = random.Random(4).sample(range(10_000), len(texts))
    found = near_duplicates.find_near_duplicates(documents(spark, texts, ids), words, 80).collect()
    component, sizes = _components(ids, texts, words)
    assert {r["doc_id"]: r["component_id"] for r in found} == component
    assert {r["doc_id"]: r["n_shingles"] for r in found} == sizes
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


def test_near_duplicates_with_repeated_and_missing_ids(spark):
    text = "a b c d e f g h"
    docs = documents(spark, [text, text, text, "z y x", None], [3, 3, None, None, 8])
    rows = Counter((r["doc_id"], r["component_id"], r["kept"]) for r in near_duplicates.find_near_duplicates(docs).collect())
    assert rows == {(3, 3, True): 2, (None, 3, False): 1, (None, None, True): 1, (8, 8, True): 1}
    kept = near_duplicates.keep_one_each(docs)
    assert kept.columns == docs.columns
    assert Counter(r["doc_id"] for r in kept.collect())[3] == 1
    assert near_duplicates.find_near_duplicates(spark.createDataFrame([], EMPTY)).count() == 0


def test_one_row_of_each_group_stays_whatever_the_ids(spark):
    text, other = "a b c d e f g h", "another text that shares an id with the first one"
    texts = [text, other, text, text, "no id twice over here", "no id twice over here", None, "", "x y z"]
    docs = documents(spark, texts, [3, 3, 3, 1, None, None, None, 8, None])
    kept = near_duplicates.keep_one_each(docs)
    assert kept.columns == docs.columns
    assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == Counter(
        [(1, text), (3, other), (None, "no id twice over here"), (None, None), (8, ""), (None, "x y z")]
    )
    assert near_duplicates.keep_one_each(docs.limit(0)).count() == 0


def test_sketch_agreement_follows_similarity():
    random_numbers = np.random.default_rng(1)
    for share in (0.2, 0.5, 0.8):
        agree = []
        for _ in range(40):
            x = random_numbers.integers(0, 2**63, 600, dtype=np.uint64)
            common = int(600 * 2 * share / (1 + share))
            y = np.concatenate([x[:common], random_numbers.integers(0, 2**63, 600 - common, dtype=np.uint64)])
            a, b = near_duplicates.sketch(x), near_duplicates.sketch(y)
            agree.append((a == b).mean())
        assert abs(np.mean(agree) - share) < 0.03
    few = near_duplicates.sketch(np.array([5], dtype=np.uint64))
    assert len(few) == near_duplicates.BINS and (few != 0xFFFFFFFFFFFFFFFF).all()


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(1000, 1000 + i) for i in range(1, 30)] + [(7, 7)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{1000 + i: 1000 for i in range(30)}}


ITEM = "A train from Paris leaves at 9 and travels 120 km before it meets the slow train that Anna drives to Paris again"


def test_decontamination_finds_copies_and_other_parameters(spark):
    filler = "some quite ordinary words of a document that has nothing to hide"
    other = ITEM.replace("Paris", "Rome").replace("Anna", "Maria").replace("9", "17").replace("120", "95")
    unequal = ITEM.replace("Paris", "Rome", 1).replace("Anna", "Maria")
    texts = [
        f"{filler} {ITEM} {filler}", f"{filler}\n{other}. {filler}", f"{filler} {unequal} {filler}", filler, ITEM[:50],
        None, "", ITEM, " ".join([ITEM] * 3), filler * 300,
    ]
    items = spark.createDataFrame([(1, ITEM), (2, "too short"), (3, None), (4, "Anna Bella Carla Dora Emma")], "item_id long, text string")
    rows = decontaminate.find_contaminated(documents(spark, texts), items).collect()
    assert sorted((r["doc_id"], r["item_id"], r["n_changed"]) for r in rows) == [
        (0, 1, 0), (1, 1, 5), (7, 1, 0), (8, 1, 0),
    ]
    docs = documents(spark, [*texts, None], [*range(len(texts)), None])
    left = decontaminate.remove_contaminated(docs, items)
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] or -1 for r in left.collect()) == [-1, 2, 3, 4, 5, 6, 9]
    assert decontaminate.find_contaminated(spark.createDataFrame([], EMPTY), items).count() == 0
    assert decontaminate.find_contaminated(docs, items.limit(0)).count() == 0


def test_decontamination_looks_at_every_place_of_an_item(spark):
    unequal = ITEM.replace("Paris", "Rome", 1).replace("Anna", "Maria")
    texts = [f"{unequal} {ITEM}", f"{unequal} and {unequal} then {ITEM} and {unequal}", f"{unequal} {unequal}", f"{ITEM} {unequal}"]
    items = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    docs = documents(spark, [*texts, unequal, ITEM], [0, 1, 2, 3, 4, 4])
    rows = decontaminate.find_contaminated(docs, items).collect()
    size = len(ITEM.split())
    assert sorted((r["doc_id"], r["start_word"], r["n_changed"]) for r in rows) == [
        (0, size, 0), (1, 2 * size + 2, 0), (3, 0, 0), (4, 0, 0),
    ]
    left = decontaminate.remove_contaminated(docs, items)
    assert sorted((r["doc_id"], r["text"]) for r in left.collect()) == [(2, texts[2]), (4, unequal)]


def test_decontamination_equals_substring_search_on_the_given_tables(spark):
    docs = spark.read.parquet(f"{BASE}/documents.parquet").collect()
    items = spark.read.parquet(f"{BASE}/benchmark.parquet").collect()
    exact = {(d["doc_id"], i["item_id"]) for d in docs for i in items if d["text"] and i["text"] in d["text"]}
    rows = QUERIES["op2_template_decontamination"](spark, BASE).collect()
    assert {(r["doc_id"], r["item_id"]) for r in rows} == exact


@pytest.mark.parametrize("shards", [1, 3, 24])
def test_shards_are_even_and_keep_groups(spark, shards):
    random.seed(shards)
    texts = ["x" * random.randint(0, 400) + str(i) for i in range(1500)]
    texts += [f"copy {i}" * 5 for i in range(40) for _ in range(3)] + ["the hot one " * 8] * 800 + [None, ""]
    rows = sharding.shard(documents(spark, texts), shards).collect()
    assert len(rows) == len(texts)
    sizes, slots, of_text = Counter(), defaultdict(list), defaultdict(set)
    for r in rows:
        text = texts[r["doc_id"]] or ""
        assert (r["size"], r["text_crc32"]) == (len(text.encode()) + 8, zlib.crc32(text.encode()))
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        of_text[text].add(r["shard"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len(sizes) == shards and max(sizes.values()) <= 1.1 * sum(sizes.values()) / shards
    split = [t for t, s in of_text.items() if len(s) > 1 and not t.startswith("the hot")]
    assert not split


def test_sharding_an_empty_table_and_a_bad_number(spark):
    assert sharding.shard(spark.createDataFrame([], EMPTY), 24).count() == 0
    with pytest.raises(ValueError):
        sharding.shard(spark.createDataFrame([], EMPTY), 0)


def pages(spark):
    big = "<p>" + "content " * 300
    rows = [
        (1, "https://Blog.Example.com/a?b=1#c", big), (5, "http://example.org", big), (9, None, big),
        (2, "not a url", None), (3, "", ""), (4, "https://x.example.net:8080/é \n", "short"), (6, "https://x.example.net/", "short"),
        (7, "http://u@h.example.com/p", "é" * 600), (7, "http://u@h.example.com/p", "é" * 600), (None, "http://n.example.com", big),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return df.selectExpr("*", "'other' AS page", "'other' AS digest", "'other' AS start")


def test_archives_round_trip(spark, monkeypatch):
    import hashlib

    monkeypatch.setattr(warc, "LINES_PER_BLOCK", 2)
    source = pages(spark)
    rows = warc.round_trip(source).collect()
    expected = Counter()
    for r in source.collect():
        body = (r["html"] or "").encode()
        target = {1: 9, 5: 9, None: 9}.get(r["page_id"]) if len(body) > 1000 else None
        kind = "response" if target is None else "revisit"
        expected[r["page_id"], len(body), hashlib.sha1(body).hexdigest(), kind, target] += 1
    assert Counter(tuple(r) for r in rows) == expected
    assert warc.round_trip(source.limit(0)).count() == 0


def test_index_finds_every_capture_and_nothing_else(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "LINES_PER_BLOCK", 3)
    rows = [(f"com,host{i % 7})/{i % 5}", i % 11, "a", i, 1) for i in range(200)]
    captures = spark.createDataFrame(rows, "surt string, page long, archive string, start long, length long")
    folder = f"file://{tmp_path}"
    index = warc.build_index(captures, folder)
    reader = warc.IndexReader(folder, [(r["first_surt"], r["first_page"], r["file"]) for r in index.collect()])
    for surt, page in {(r[0], r[1]) for r in rows}:
        assert sorted(x[3] for x in reader.find(surt, page)) == sorted(r[3] for r in rows if r[:2] == (surt, page))
    assert list(reader.find("com,host9)/0", 1)) == list(reader.find("", None)) == []


def test_reversed_host_keys():
    assert warc.reversed_host_key("https://Blog.example.com/a?b#c") == "com,example,blog)/a?b"
    assert warc.reversed_host_key("http://example.org?q=1") == "org,example)?q=1"
    assert warc.reversed_host_key(None) == ")"


def test_registered_names_and_the_sql_of_the_archives(spark):
    duckdb = pytest.importorskip("duckdb")
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    database = duckdb.connect()
    database.execute(f"CREATE VIEW pages AS SELECT * FROM '{BASE}/pages.parquet'")
    expected = database.execute(ORACLE["op4_capture_index"]).fetchall()
    got = QUERIES["op4_capture_index"](spark, BASE)
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(str, expected)) == sorted(str(tuple(r)) for r in got.select(*names).collect())


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{BASE}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        path = f"{tmp_path}/{name}"
        stage(spark, before, BASE).write.parquet(path)
        after = spark.read.parquet(path)
        if name != "pack":
            assert after.columns == docs.columns
            now = {r["doc_id"]: r["text"] for r in after.collect()}
        if name == "near_duplicates":
            kept_before = {r["doc_id"] for r in before.collect()}
            component, _ = _components(sorted(kept_before), [texts[i] for i in sorted(kept_before)], 5)
            assert set(now) == set(component.values())
        if name == "decontaminate":
            items = [r["text"] for r in spark.read.parquet(f"{BASE}/benchmark.parquet").collect()]
            assert set(now) == {r["doc_id"] for r in before.collect() if not any(i in r["text"] for i in items)}
        before = after
    assert {r["doc_id"] for r in before.collect()} == set(now)
