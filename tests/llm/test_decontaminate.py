"""Contaminated documents against edit distance over every stretch."""

import random

import numpy as np

from courtline.llm import decontaminate as dc
from courtline.llm.neardup import Words


def test_recall_of_edited_copies():
    for words, edits in ((35, 0), (35, 3), (12, 1), (60, 6)):
        assert dc.recall(words, edits, trials=60) >= 0.98


def test_edit_distance_of_stretches():
    rng = np.random.default_rng(4)

    def plain(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a):
            new = [i + 1]
            for j, y in enumerate(b):
                new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
            row = new
        return row[-1]
    for _ in range(60):
        item, text = rng.integers(0, 4, rng.integers(1, 7)), rng.integers(0, 4, rng.integers(0, 9))
        best = min(plain(item, text[a:b]) for a in range(len(text) + 1) for b in range(a, len(text) + 1))
        got = dc.verify(item, text, 0, len(text), len(item))
        assert got[0] == best == plain(item, text[got[1]:got[2]])


def test_documents_that_hold_items(spark):
    rng = random.Random(8)
    word = lambda: "w%d" % rng.randrange(3000)
    items = [(k, " ".join(word() for _ in range(rng.randrange(8, 50)))) for k in range(30)] + [(90, "too short"), (91, None)]
    noise = lambda n: " ".join(word() for _ in range(n))
    rows, want = [], set()
    for k in range(30):
        words = items[k][1].split()
        for _ in range(len(words) // 10):
            words[rng.randrange(len(words))] = word()
        rows.append((k, f"{noise(40)} {' '.join(words).title()}. {noise(30)}"))
        want.add((k, k))
        rows.append((100 + k, noise(120) + " too short" + noise(3)))
        rows.append((300 + k, noise(k) + " too Short, " + noise(3)))
        want.add((300 + k, 90))
        rows.append((200 + k, " ".join(items[k][1].split()[: len(words) // 2])))  # half an item is none
    rows += [(500, None), (501, ""), (502, items[3][1]), (502, items[3][1]), (None, items[4][1]), (503, noise(40_000) + " " + items[5][1])]
    want |= {(502, 3), (None, 4), (503, 5)}
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, item_id int").repartition(3)
    bench = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, doc_id string")
    got = dc.contaminated(docs, bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and len(got) == len(want) + 1
    texts = {r[0]: r[1] for r in rows}
    exact = next(r for r in got if r.doc_id == 503)
    assert texts[503][exact.first_char:exact.last_char] == items[5][1] and exact.distance == 0
    clean = dc.clean_documents(docs, bench)
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.collect()} == {r[0] for r in rows} - {d for d, _ in want}
    none = spark.createDataFrame([], "doc_id long, text string")
    assert dc.contaminated(none, bench).count() == 0 and dc.contaminated(docs, bench.limit(0)).count() == 0
    assert dc.clean_documents(docs, bench.limit(0)).count() == len(rows)


def test_blocks_of_items_find_the_same(spark, monkeypatch):
    rows = [(k, " ".join(f"a{k}b{j}" for j in range(12))) for k in range(9)]
    bench = spark.createDataFrame(rows, "item_id long, text string")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(dc, "BLOCK_ITEMS", 4)
    assert {(r.doc_id, r.item_id) for r in dc.contaminated(docs, bench).collect()} == {(k, k) for k in range(9)}
    assert dc.word_hashes("Ab,c-d É", Words()).tolist() == dc.word_hashes("aB c d  É!", Words()).tolist()


def test_short_items_and_scripts_without_spaces(spark):
    items = [(1, "你好世界今天天气很好"), (2, "早安"), (3, "one"), (4, "ราตรีสวัสดิ์"), (5, "!!"), (6, "a b c d"), (7, "a b c d")]
    rows = [(1, "他说你好世界今天天气很好吧"), (2, "他说你好世界今天天气真好吧"), (3, "早 安"), (4, "安早"), (5, "x one"), (6, "someone"), (7, "ราตรีสวัสดิ์"),
            (8, "A, b. c (d)"), (9, "a b"), (10, "c d"), (11, "")]
    bench, docs = spark.createDataFrame(items, "item_id long, text string"), spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = dc.contaminated(docs, bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(1, 1), (2, 1), (3, 2), (5, 3), (7, 4), (8, 6), (8, 7)} and len(got) == 7
    spans = {(r.doc_id, r.item_id): rows[r.doc_id - 1][1][r.first_char:r.last_char] for r in got}
    assert spans[1, 1] == items[0][1] and spans[3, 2] == "早 安" and spans[8, 6] == "A, b. c (d"
    assert {r.doc_id for r in dc.clean_documents(docs, bench).collect()} == {4, 6, 9, 10, 11}


def test_recall_at_the_allowed_distance_for_all_lengths():
    for words, trials in ((15, 60), (60, 60), (120, 40), (250, 30), (500, 20)):
        assert dc.recall(words, int(dc.SHARE * words), trials=trials) >= 0.95


def test_query_against_every_stretch(spark):
    """All pairs of documents and items by edit distance to every stretch: no false find, distances least, hardly a miss."""
    rng = random.Random(17)
    vocabulary = [f"v{k}" for k in range(400)]
    some = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = {k: some(n) for k, n in enumerate([1, 2, 3, 4, 5, 7, 9, 12, 15, 20, 25, 30, 40, 59, 61, 90, 130])}
    docs = {}
    for d in range(160):
        item = list(items[rng.choice(list(items))])
        for _ in range(rng.randrange(int(0.3 * len(item)) + 2)):  # up to and beyond the allowed distance
            at, kind = rng.randrange(len(item) + 1), rng.randrange(3)
            item[at:at + (kind != 0)] = [] if kind == 1 else some(1)
        docs[d] = some(rng.randrange(60)) + item + some(rng.randrange(60))
    want = {}
    for d, text in docs.items():
        for k, item in items.items():
            row = [0] * (len(text) + 1)
            for i, x in enumerate(item):
                new = [i + 1]
                for j, y in enumerate(text):
                    new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
                row = new
            if min(row) <= int(dc.SHARE * len(item)):
                want[d, k] = min(row)
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in items.items()], "item_id long, text string")
    table = spark.createDataFrame([(d, " ".join(w)) for d, w in docs.items()], "doc_id long, text string").repartition(3)
    rows = dc.contaminated(table, bench).collect()
    got = {(r.doc_id, r.item_id): r.distance for r in rows}
    assert len(got) == len(rows) and set(got) <= set(want) and all(got[x] == want[x] for x in got)
    assert len(want) > 120 and len(got) >= 0.98 * len(want)
    assert {x for x in want if len(items[x[1]]) < dc.MIN_WORDS} <= set(got)  # short items are never missed
    for r in rows:  # the reported stretch has the reported distance
        stretch = docs[r.doc_id][r.first_word:r.last_word]
        assert dc.verify(np.array([hash(w) for w in items[r.item_id]]), np.array([hash(w) for w in stretch]), 0, len(stretch), 99)[0] == r.distance
