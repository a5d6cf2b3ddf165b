"""The pipeline's rows against a brute-force version of all five stages on a small table."""

import random
import re
import statistics
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from courtline.llm import pii, quality

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words_of(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]


def measures(text):
    w = words_of(text)
    lines = [x for x in text.split("\n") if words_of(x)]
    grams = [tuple(w[k:k + 8]) for k in range(len(w) - 7)]
    often = Counter(grams)
    repeated = {k + j for k, g in enumerate(grams) if often[g] > 1 for j in range(8)}
    chars, upper = len("".join(w)), sum(c.isupper() for c in text)
    per = lambda a, b: a / b if b else 0.0
    base_failed = len(w) < 20 or 100 * len(repeated) > 30 * len(w)
    return base_failed, {"symbols_per_word": per(sum(c in quality.SYMBOLS for c in text), len(w)), "upper_share": per(upper, chars),
                         "dup_line_share": per(len(lines) - len(set(lines)), len(lines)), "repeat_share": per(len(repeated), len(w)),
                         "word_length": per(chars, len(w))}


def quality_rules(rows):
    found = [measures(r[1] or "") for r in rows]
    kept = []
    for m in quality.SPREAD:
        v = sorted(x[m] for _, x in found)  # all rows are of one cell
        q = statistics.quantiles(v, n=4, method="inclusive")
        fence = q[2] + quality.FENCE * max(q[2] - q[0], quality.SPREAD[m])
        for _, x in found:  # the sketch knows a quantile to within five percent: no row lies that near
            assert not 0.8 * fence < x[m] < 1.2 * fence
            x[m] = x[m] > fence
    for r, (failed, above) in zip(rows, found):
        if not failed and not any(above.values()):
            kept.append(r)
    return kept


def near_duplicates(rows):
    def shingles(text):
        w = [x.decode() for x in (text or "").encode().lower().split()]
        return {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    vertices = sorted({r[:2] for r in rows if r[0] is not None})
    sets = {v: shingles(v[1]) for v in vertices}
    group = {v: v for v in vertices}

    def root(v):
        while group[v] != v:
            v = group[v]
        return v
    for i, u in enumerate(vertices):
        for v in vertices[:i]:
            both = len(sets[u] & sets[v])
            if sets[u] and sets[v] and 100 * both >= 80 * (len(sets[u]) + len(sets[v]) - both):
                a, b = sorted((root(u), root(v)))
                group[b] = a
    out = [r for r in rows if r[0] is None]
    return out + [next(r for r in rows if r[:2] == v) for v in vertices if root(v) == v]


def holds(text, item):
    norm = lambda t: [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in t)) if w]
    a, b = norm(item), norm(text or "")
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row) <= len(a) // 5


def pieces(rows):
    tokenizers, public = pytest.importorskip("tokenizers"), pytest.importorskip("public_tokenizers")
    t = tokenizers.Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    out = Counter()
    for doc, text, *_ in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids + [0]
        for s in range(0, len(ids), 1024):
            part = np.array(ids[s:s + 1024], "<u4")
            out[doc, s, len(part), zlib.crc32(part.tobytes()), len(ids)] += 1
    return out


def table():
    rng = random.Random(12)
    vocabulary = ["".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randrange(2, 9))) for _ in range(600)]
    some = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(k, some(rng.randrange(14, 40))) for k in range(6)]
    rows = [(k, some(rng.randrange(40, 90))) for k in range(90)]
    rows += [(100, some(12)), (101, some(9) + (" " + some(8)) * 4), (102, some(40) + " ##" * 60), (103, "\n".join(["one line again"] * 9 + [some(30)])),
             (104, some(60).upper()), (105, None), (106, ""), (None, some(50)), (None, None)]
    near = lambda text, n: " ".join("swap" + w if k in range(20, 20 + n) else w for k, w in enumerate(text.split()))
    long = some(120)
    rows += [(110, long), (111, near(long, 1)), (112, near(long, 12)), (113, rows[3][1]), (2, some(55)), (4, rows[4][1]), (114, near(near(long, 1), 3))]
    hit = items[2][1].split()
    hit[3] = "other"
    rows += [(120, f"{some(30)} {items[0][1]} {some(10)}"), (121, f"{some(30)} {' '.join(hit)}. {some(10)}"),
             (122, f"{some(30)} {' '.join(items[4][1].split()[:8])} {some(30)}")]
    rows += [(130, f"{some(25)} write to jo.doe@mail.example.org or +1 (212) 555-0142 {some(9)}"), (131, f"{some(20)} at 10.1.200.33 {some(20)}"),
             (132, f"{some(1500)} 4111 1111 1111 1111 {some(600)}")]
    return items, [(i, t, "en", "web", None if t is None else len(t)) for i, t in rows]


def test_run_is_the_brute_force_one(spark, tmp_path):
    items, rows = table()
    spark.createDataFrame(rows, SCHEMA).repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = quality_rules(rows)
    assert len(rows) - len(kept) == 8  # those planted to fail, and the texts without words
    apart = near_duplicates(kept)
    clean = [r for r in apart if not any(holds(r[1], item) for _, item in items)]
    assert {r[0] for r in apart} - {r[0] for r in clean} == {120, 121}
    masked = [(i, pii.masked(t, pii.base_spans(t)), *r) for i, t, *r in clean]
    assert sum("[" in t for _, t, *_ in masked) == 3
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in out) == pieces(masked)
    held = defaultdict(list)
    for r in out:
        held[r.sequence_id].append((r.offset, r.length))
    for spans in held.values():
        assert [a for a, _ in sorted(spans)] == [sum(n for _, n in sorted(spans)[:k]) for k in range(len(spans))]
        assert sum(n for _, n in spans) <= 1024
    assert sorted(held) == list(range(len(held)))
    assert (len(held) - 1) * 1024 < 1.05 * sum(r.length for r in out)  # little padding
