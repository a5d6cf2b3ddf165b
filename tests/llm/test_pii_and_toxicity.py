"""Personal data and toxicity: base spans by their patterns, trained parts by held-out results."""

import hashlib
import random
import re
import time
import zlib

import numpy as np
import pytest

from courtline.llm import pii, toxicity

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m.group())
            double = [sum(divmod(2 * int(c), 10)) if k % 2 else int(c) for k, c in enumerate(reversed(d))]
            good = {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                    "card": 16 <= len(d) <= 19 and sum(double) % 10 == 0, "phone": 8 <= len(d) <= 15}[kind]
            if good:
                out.append((kind, *m.span()))
    return out


@pytest.fixture(scope="module")
def tagger():
    t = pii.Tagger()
    t.fit(*pii.training_windows(["the and of to in is on by"], made=900))
    return t


def test_base_spans_follow_the_patterns():
    rng = random.Random(3)
    bits = list("0123456789") * 2 + list(" .-+()@@a_%é\n") + ["4111111111111111", "1.2.3.4", "a@b.co", "+1 (212) 555-0000", "0000000000000000"]
    for _ in range(4000):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(30)))
        assert pii.base_spans(text) == plain(text), text


def test_long_runs_take_linear_time():
    begin = time.time()
    for text in ("1" * 300_000, "a" * 300_000 + "@", "@" * 300_000, "1." * 150_000, "+1" * 150_000, "+1" + "(" * 300_000, "a@" * 150_000):
        pii.base_spans(text)
    assert time.time() - begin < 20


def test_gradients_are_those_of_the_loss():
    t, rng = pii.Tagger(), np.random.default_rng(0)
    x, y = rng.integers(0, 98, (3, 9)), rng.integers(0, len(pii.TAGS), (3, 9))
    _, grads = t.gradients(x, y)
    for k, g in grads.items():
        at = (x[0, 0], 1) if k == "E" else tuple(int(rng.integers(n)) for n in g.shape)
        kept, loss = t.p[k][at], []
        for step in (1e-5, -1e-5):
            t.p[k][at] = kept + step
            loss.append(t.gradients(x, y)[0])
        t.p[k][at] = kept
        assert abs((loss[0] - loss[1]) / 2e-5 - g[at]) < 1e-5


def test_the_tagger_adds_what_the_patterns_miss(tagger):
    rng = np.random.default_rng(77)
    texts, want = [], []
    for _ in range(200):
        a, b, c = ("".join(map(str, rng.integers(0, 10, n))) for n in (3, 3, 4))
        value = rng.choice([f"({a}) {b}-{c}", f"{a}-{b}-{c}"])
        texts.append(f"so it was {value} that she had")
        want.append(("phone", 10, 10 + len(value)))
    got = pii.added_spans(texts, [pii.base_spans(t) for t in texts], tagger)
    assert np.mean([w in g for w, g in zip(want, got)]) > 0.9
    clean = ["chapter 12 of 1984 and 3.14 in 2024-01-05", "no data", "", "version 1.2.3"]
    assert pii.added_spans(clean, [pii.base_spans(t) for t in clean], tagger) == [[], [], [], []]


def test_rows_and_masks(spark, tagger):
    texts = ["", None, "mail a.b@c.org now", "x 10.0.0.1, +1 (212) 555-0000 and 4111 1111 1111 1111 é a@b.co", "long " * 30_000 + "q@r.st", "none"]
    rows = [(k, t, 7, "p") for k, t in enumerate(texts)] + [(None, texts[2], 7, "p"), (2, texts[2], 7, "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, spans string").repartition(2)
    out = pii.find(docs, tagger).collect()
    assert len(out) == len(rows)
    for r in out:
        text = (texts[2] if r.doc_id is None else texts[r.doc_id]) or ""
        base = plain(text)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for k, _, _ in base) for x in pii.KINDS]
        line = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert set(filter(None, line.split(","))) <= set(r.spans.split(","))
    masks = pii.mask(docs, tagger)
    assert masks.columns == docs.columns
    by = {(r.doc_id, r.spans): r for r in masks.collect()}
    assert by[2, "q"].text == "mail [EMAIL] now" and by[2, "q"].n_chars == 16 and by[1, "p"].text is None
    assert by[3, "p"].text == "x [IP], [PHONE] and [CARD] é [EMAIL]"
    assert pii.find(docs.limit(0)).count() == 0 and pii.mask(docs.limit(0), tagger).count() == 0


def segments(w, at=0):
    best = max(((sum(w[i:j]), i, j) for i in range(len(w)) for j in range(i + 1, len(w) + 1)), key=lambda x: (round(x[0], 9), x[1] - x[2]), default=(0,))
    if best[0] <= 1e-9:
        return []
    s, i, j = best
    return segments(w[:i], at) + [(s, at + i, at + j)] + segments(w[j:], at + j)


def test_all_maximal_segments():
    rng = random.Random(0)
    for _ in range(400):
        w = [rng.choice([1.5, 2.25, -1.1, -0.7, -3.3, 0.6]) for _ in range(rng.randrange(14))]
        got, want = toxicity.segments(np.array(w)), segments(w)
        assert [(round(s, 6), a, b) for s, a, b in got] == [(round(s, 6), a, b) for s, a, b in want]


def test_held_out_documents(spark):
    rng = random.Random(6)
    word = lambda: "w%d" % int(rng.paretovariate(0.6))
    rude = ["blorg", "snarf", "grubble", "zonk"]
    rows, labels = [], []
    for k in range(700):
        bad = k % 5 == 0
        words = [word() for _ in range(rng.randrange(5, 150))]
        for _ in range(bad * max(2, len(words) // 12)):
            words.insert(rng.randrange(len(words)), rng.choice(rude))
        rows.append((k, " ".join(words), "x"))
        labels.append((k, int(bad)))
    rows += [(9000, "", "x"), (9001, None, "x"), (None, "snarf blorg zonk", "x"), (1, rows[1][1], "x"), (9002, "w1 " * 50_000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic string").repartition(3)
    marks = spark.createDataFrame(labels + [(9000, None), (3, 0)], "doc_id long, toxic int")
    out = toxicity.toxic(docs, marks).collect()
    truth = dict(labels)
    assert len(out) == len(rows)
    held = [(r.predicted, truth[r.doc_id]) for r in out if r.held_out and r.doc_id in truth]
    assert len(held) > 90 and np.mean([a == b for a, b in held]) > 0.97
    for r in out:
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        if r.doc_id in (9000, 9001, 9002):
            assert r.predicted == 0 and r.passages == ""
    texts = {r[0]: r[1] for r in rows}
    shown = next(r for r in out if r.doc_id in truth and r.passages)
    a, b = map(int, shown.passages.split(",")[0].split(":"))
    assert any(x in texts[shown.doc_id][a:b] for x in rude)
    assert toxicity.toxic(docs.limit(0), marks).count() == 0
    assert {r.predicted for r in toxicity.toxic(docs, marks.limit(0)).collect()} == {0}
