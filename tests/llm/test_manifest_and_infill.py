"""Merkle proofs and fill-in-middle cuts against plain versions."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np

from courtline.llm import infill, merkle

ODD = ["", None, "ABC", "abc", "é中😀", "<P>x", "a<S>", "<M>", "<", "<P", "x" * 3000, "é" * 2000 + "a" * 2000 + "中" * 2000, "𐍈á\0"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def table(spark, seed, n, langs):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        lang = rng.choice(langs)
        rows.append((rng.choice([k, k, 7, 2**60 + 1, 2**60 + 3, None]), rng.choice(ODD + [f"Text {k} É"]), lang, rng.choice(["s", None, "t:1"]), rng.choice([None, k])))
    rows += rows[:5]
    schema = "doc_id long, text string, lang string, source string, n_chars long, hash string, tree string, idx long, output string, first int"
    return rows, spark.createDataFrame([(*r, "h", "t", 1, "o", 2) for r in rows], schema).repartition(5)


def leaf(doc_id, text, lang, source, n_chars):
    return sha("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in (doc_id, source, lang, n_chars, text)))


def climb(nodes):
    """The last hash and, per node, its siblings (left, right) by level."""
    ways, groups = [[] for _ in nodes], [[k] for k in range(len(nodes))]
    while len(nodes) > 1:
        up, joined = [], []
        for a in range(0, len(nodes), 8):
            run = nodes[a:a + 8]
            for j in range(len(run)):
                for k in groups[a + j]:
                    ways[k].append(("".join(run[:j]), "".join(run[j + 1:])))
            up.append(sha("".join(run)))
            joined.append([k for g in groups[a:a + 8] for k in g])
        nodes, groups = up, joined
    return nodes[0], ways


def plain_manifest(rows):
    trees = {}
    for r in rows:
        text = r[1]
        if text is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0:
            text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        trees.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf(*r), leaf(r[0], text, *r[2:])))
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    subs = {x: climb([r[2] for r in sorted(trees[x])]) for x in langs}
    root, above = climb([subs[x][0] for x in langs])
    out = Counter()
    for x, top in zip(langs, above):
        for r, way in zip(sorted(trees[x]), subs[x][1]):
            acc = r[3]
            for left, right in way + top:
                acc = sha(left + acc + right)
            out[r[1] if r[0] else None, r[2], subs[x][0], root, sha("".join(a + b for a, b in way + top)), acc, acc == root] += 1
    return out


def test_manifest_is_the_plain_one(spark):
    for seed, n, langs in ((1, 700, ["en"] * 8 + ["de", "", None, "zh", "Ω"]), (2, 40, [f"l{k}" for k in range(30)] + [None]), (3, 9, ["en"]), (4, 1, [None])):
        rows, docs = table(spark, seed, n, langs)
        rows, docs = (rows[:1], docs.limit(1)) if n == 1 else (rows, docs)
        if n == 1:
            rows = [tuple(docs.select("doc_id", "text", "lang", "source", "n_chars").first())]
            docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
        out = merkle.proofs(docs).collect()
        got = Counter((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in out)
        assert got == plain_manifest(rows)
        if n > 100:
            assert {r.verified for r in out} == {True, False}
    assert merkle.proofs(docs.limit(0)).count() == 0


def test_proofs_need_no_window_over_a_language(spark):
    _, docs = table(spark, 1, 50, ["en"])
    plan = merkle.proofs(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan and "Python" not in plan


def test_rank_index_is_exact():
    rng = random.Random(4)
    for k in range(60):
        alphabet = rng.choice(["a", "aé", "中a", "😀", "aé中😀", "a" * 50 + "😀"])
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(9000)))
        if k % 3 == 0:
            text += "a" * rng.randrange(5000) + "中" * rng.randrange(5000)
        index = infill.RankIndex(np.frombuffer(text.encode(), np.uint8), block=rng.choice([64, 1000, 1 << 20]))
        want = np.cumsum([0] + [len(c.encode()) for c in text])
        assert index.n == len(text) and len(index.residuals) == len(text) + 1
        assert [index.offset(i) for i in range(len(text) + 1)] == want.tolist()
    assert len(infill.RankIndex(np.full(100_000, 97, np.uint8)).ranks) == 2  # one line, and the end
    assert np.abs(index.residuals.astype(int)).max() <= infill.ERROR


def test_cuts_are_the_plain_ones(spark):
    rows, docs = table(spark, 9, 400, ["en"])
    want = Counter()
    for doc_id, text, *_ in rows:
        t = text or ""
        d = sha(f"1:{'' if doc_id is None else doc_id}")
        h = [int(d[8 * k:8 * k + 8], 16) for k in range(4)]
        a, b = sorted((h[0] % (len(t) + 1), h[1] % (len(t) + 1)))
        p, m, s = t[:a], t[a:b], t[b:]
        if not t or any(x in t for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
            form, out = "plain", t
        else:
            form, out = ("spm", f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < 20 else ("psm", f"<P>{p}<S>{s}<M>{m}")
        cut = form != "plain"
        want[doc_id, len(t), form, a if cut else None, b - a if cut else None, sha(out), sha(t)] += 1
    got = infill.infill_digests(docs).collect()
    assert Counter((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output_sha256, r.restored_sha256) for r in got) == want
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert infill.infill_digests(docs.limit(0)).count() == 0
