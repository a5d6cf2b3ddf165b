"""Quality rules and license passages against plain Python."""

import re
from collections import Counter

from courtline.llm import licenses, quality

SPACE, WORD = re.compile(r"[^\x20\x09-\x0D]+"), re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

TEXTS = ["", None, " \n\t ", "one two", "a b c d e f g h a b c d e f g h", "x " * 40, "l1 a\nl1 a\n\nl2\nl1 a\n \n ", "é| #$ * % & < >",
         " nbsp wide " * 12, "a b c d e f g h i " * 3 + "z", " ".join(f"w{i}" for i in range(40_000)),
         " ".join(f"w{i % 9}" for i in range(100)), "MIT License mit  license, CC-BY cc by 4.0 x", "Apache License " * 3,
         "GNU\nGeneral. Public,License", "İ K mit Licensé", "Permission is hereby granted, free of charge, to any kind person obtaining a "
         "copy of this software and associated documentation files (the"]


def counts(text):
    text = text or ""
    words = SPACE.findall(text)
    windows = [tuple(words[k:k + 8]) for k in range(len(words) - 7)]
    often = Counter(windows)
    held = {k + j for k, w in enumerate(windows) if often[w] > 1 for j in range(8)}
    lines = [x for x in text.split("\n") if SPACE.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(held))


def test_counts(spark):
    docs = spark.createDataFrame([(k, t, "en", None, 1) for k, t in enumerate(TEXTS)],
                                 "doc_id long, text string, lang string, source string, n_words int")
    for r in quality.quality(docs).collect():
        c = counts(TEXTS[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == c, r
        assert r.base_failed == (c[0] < 20 or 100 * c[4] > 30 * c[0]) and not (r.kept and r.base_failed)


def test_fences_follow_the_cell(spark):
    plain = lambda k: " ".join(f"word{(k * 31 + j * j) % 977}" for j in range(30))
    rows = [(k, plain(k), "en", "a") for k in range(120)] + [(200 + k, plain(k).replace(" ", " # "), "xx", "b") for k in range(120)]
    rows += [(500, plain(3).replace(" ", " # "), "en", "a"), (501, plain(4).upper(), "en", "a"), (502, plain(5), "en", "rare"),
             (503, plain(6), None, None), (None, plain(7), "en", "a"), (0, plain(0), "en", "a")]
    docs = spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, lang string, source string, kept string")
    out = quality.quality(docs).collect()
    gone = {r.doc_id for r in out if not r.kept}
    assert len(out) == len(rows) and gone == {500, 501}  # symbols are usual in the other cell
    kept = quality.kept_documents(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r[0] for r in rows if r[0] is not None and r[0] not in gone)
    assert quality.quality(docs.limit(0)).count() == 0 and quality.kept_documents(docs.limit(0)).count() == 0


def test_merged_sketches_equal_the_sketch_of_all(spark):
    df = spark.createDataFrame([(str(k % 3), str(k % 7), float(k % 50)) for k in range(500)], "lang string, source string, x double")
    cells = quality.sketch(df, ["lang", "source"], ["x"])
    as_set = lambda d: {tuple(r) for r in d.select("lang", "measure", "bucket", "n").collect()}
    assert as_set(quality.merged(cells, ["lang"])) == as_set(quality.sketch(df, ["lang"], ["x"]))
    for r in quality.quantiles(quality.merged(cells, []), []).collect():
        assert abs(r.q25 - 12) <= 1 and abs(r.q75 - 37) <= 2


def places(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    hits = [(k, label) for phrase, label in licenses.PHRASES.items() for k in range(len(words))
            if words[k:k + len(phrase.split())] == phrase.split()]
    at = [k for k, _ in hits]
    return len(words), len(hits), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in hits}))


def test_license_places(spark):
    docs = spark.createDataFrame([(k, t, "x") for k, t in enumerate(TEXTS)] + [(None, "mit license", "x")], "doc_id long, text string, label string")
    out = licenses.licenses(docs).collect()
    assert len(out) == len(TEXTS) + 1
    for r in out:
        text = "mit license" if r.doc_id is None else TEXTS[r.doc_id]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == places(text)
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    by = {r.doc_id: r for r in out}
    assert by[len(TEXTS) - 1].labels == "mit" and by[len(TEXTS) - 1].base_labels == ""  # a word more on the way
    assert licenses.licenses(docs.limit(0)).count() == 0


def test_diagonals_give_the_passage(spark):
    text = "intro words here " + licenses.TEMPLATES[11][1].replace("binary", "binary or other") + " and more"
    docs = spark.createDataFrame([(1, text), (2, "redistribution and use in source code are fun")], "doc_id long, text string")
    (r,) = licenses.passages(docs).collect()
    assert (r.doc_id, r.label, r.first_word) == (1, "bsd", 3) and r.cover >= licenses.COVER
