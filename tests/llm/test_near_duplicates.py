"""Near-duplicate groups against all pairs, and the pieces they are made of."""

import random
from collections import Counter, defaultdict

import numpy as np

from courtline.llm import neardup
from courtline.llm.components import components


def brute(rows, percent=85):
    sets, links = {}, defaultdict(list)
    for doc, text in rows:
        words = (text or "").encode().lower().split()
        n = max(1, len(words) - 4)
        sets.setdefault(doc, []).append({tuple(words[k:k + 5]) for k in range(n)} if words else set())
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if any(100 * len(x & y) >= percent * len(x | y) > 0 for x in sets[a] for y in sets[b]):
                links[a].append(b)
                links[b].append(a)
    out = {}
    for a in ids:
        if a not in out:
            group, todo = {a}, [a]
            while todo:
                new = [x for x in links[todo.pop()] if x not in group]
                group.update(new)
                todo += new
            out.update({x: min(group) for x in group})
    return out, sets


def corpus():
    rng = random.Random(5)
    word = lambda: "w%d" % rng.randrange(400)
    rows, doc = [], 0
    for _ in range(25):
        base = [word() for _ in range(rng.randrange(6, 160))]
        for _ in range(rng.choice([1, 1, 2, 9])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 5])):
                copy[rng.randrange(len(copy))] = word()
            rows.append((doc, " ".join(copy)))
            doc += 1
    hub = [word() for _ in range(150)]  # a group of spokes that are like the hub and hardly like each other
    for k in range(60):
        spoke = list(hub)
        for at in rng.sample(range(150), rng.randrange(0, 9)):
            spoke[at] = word()
        rows.append((1000 + k, " ".join(spoke)))
    return rows + [(2000, "A b c"), (2001, "a B  c"), (2002, "a b"), (2003, ""), (2004, None), (2005, " \n\t"), (2006, "")]


def test_groups_equal_all_pairs(spark):
    rows = corpus()
    random.Random(1).shuffle(rows)
    want, sets = brute(rows)
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.component_id, r.n_shingles, r.kept) == (want[r.doc_id], len(sets[r.doc_id][0]), r.doc_id == want[r.doc_id])


def test_odd_rows(spark):
    long = " ".join(f"x{i}" for i in range(60_000))
    rows = [(1, "a b c d e f", 1), (1, "a b c d e f", 2), (None, "a b c d e f", 3), (3, long, 4), (2, long + " y", 5),
            (4, "p q r s t u", 6), (4, long, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id int")
    got = sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in neardup.near_duplicates(docs).collect())
    # the rows of doc 4 are one vertex, which joins 2 and 3
    assert got == sorted([(1, 1, True), (1, 1, True), (-1, -1, True), (3, 2, False), (2, 2, True), (4, 2, False), (4, 2, False)])
    kept = neardup.one_of_each(docs)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == {1: 1, None: 1, 2: 1}
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert neardup.near_duplicates(empty).count() == 0 and neardup.one_of_each(empty).count() == 0


def test_superminhash_estimates_and_is_stepwise_equal():
    rng = np.random.default_rng(2)
    pool = rng.integers(1, 1 << 62, 400).astype(np.uint64)
    a, b = np.sort(pool[:300]), np.sort(pool[100:])
    both = neardup.superminhash(np.concatenate([a, b]), np.array([0, 300, 600]))
    assert abs((both[0] == both[1]).mean() - 200 / 400) < 0.15
    assert (neardup.superminhash(a, np.array([0, 300]))[0] == both[0]).all()
    one = neardup.superminhash(pool[:1], np.array([0, 1]))[0]  # one element fills all places, one step each
    assert sorted(np.floor(one).astype(int)) == list(range(neardup.SLOTS))


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 160)] + [(5, 5), (200, 201)]
    random.Random(3).shuffle(links)
    df = spark.createDataFrame(links + [(None, 3)], "u long, v long").repartition(4)
    got = {r.id: r.component for r in components(df).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, **{i: 100 for i in range(100, 160)}, 200: 200, 201: 200}


def test_texts_reach_python_in_short_batches(spark, monkeypatch):
    def short(step):
        def checked(batches):
            def each():
                for b in batches:
                    assert len(b) <= 1_000
                    yield b
            return step(each())
        return checked
    for step in ("_signed", "_spread"):
        monkeypatch.setattr(neardup, step, short(getattr(neardup, step)))
    linked = neardup._linked
    monkeypatch.setattr(neardup, "_linked", lambda percent: short(linked(percent)))
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    rows = [(i, " ".join(f"w{i // 2}_{j}" for j in range(30)) + " more" * (i % 2)) for i in range(3_000)]
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: i - i % 2 for i in range(3_000)}
    assert spark.conf.get(key) == before
