"""Ids beyond 2 ** 53 beside null ones come out of every operator as they went in; rows of one id are judged by their texts."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from courtline.llm import (chat, decontaminate, infill, licenses, merkle, neardup, packing, pii, quality, substrings, toxicity,
                           warc, webtext)

IDS = [2 ** 60 + 1, 2 ** 60 + 3, None]
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def sentence(seed, n=40):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, sentence(k) + " mail a@b.cd", "en", "s", 3) for k, i in enumerate(IDS)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1)


def ids(df, column="doc_id"):
    return Counter(r[0] for r in df.select(column).collect())


@pytest.mark.parametrize("run", [
    lambda s, d: pii.find(d, pii.Tagger()), lambda s, d: neardup.near_duplicates(d), lambda s, d: licenses.licenses(d),
    lambda s, d: quality.quality(d), lambda s, d: packing.pack(d), lambda s, d: substrings.repeated_substrings(d),
    lambda s, d: merkle.proofs(d), lambda s, d: infill.infill_digests(d),
    lambda s, d: toxicity.toxic(d, s.createDataFrame([(2 ** 60 + 1, 0), (2 ** 60 + 3, 1)], "doc_id long, toxic int")),
    lambda s, d: decontaminate.contaminated(d, s.createDataFrame([(2 ** 60 + 7, r.text) for r in d.collect()] + [(None, "none of it is here")],
                                                                 "item_id long, text string")),
], ids=["pii", "neardup", "licenses", "quality", "packing", "substrings", "merkle", "infill", "toxicity", "decontaminate"])
def test_document_ids(spark, docs, run):
    out = run(spark, docs)
    assert ids(out) == Counter(IDS)
    if "item_id" in out.columns:
        assert ids(out, "item_id") == Counter([2 ** 60 + 7] * 3)
    if "component_id" in out.columns:
        assert ids(out, "component_id") == Counter(IDS)


def test_page_and_conversation_ids(spark):
    html = "<article><p>" + sentence(1, 300) + "</p></article>"
    pages = spark.createDataFrame([(i, "http://h/x", html) for i in [*IDS, 2 ** 60 + 5]], "page_id long, url string, html string").coalesce(1)
    assert ids(webtext.main_text(pages), "page_id") == Counter([*IDS, 2 ** 60 + 5])
    out = {r.page_id: r.refers_to for r in warc.archived(pages).collect()}
    assert out == {2 ** 60 + 1: 2 ** 60 + 5, 2 ** 60 + 3: 2 ** 60 + 5, None: None, 2 ** 60 + 5: None}
    rows = spark.createDataFrame([(i, 0, "user", "x") for i in IDS], "conv_id long, turn long, role string, text string").coalesce(1)
    assert ids(chat.chat_digests(rows), "conv_id") == Counter(IDS)


def test_pipeline_keeps_ids(spark, docs, tmp_path):
    spark.createDataFrame([(1, "an item that nothing here holds at all")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    current = docs
    for name, stage in corpus_pipeline.STAGES:
        current = stage(spark, current, str(tmp_path))
        if name != "packing":
            assert current.columns == docs.columns
    assert set(ids(current)) == set(IDS)


def test_licenses_judge_each_row(spark):
    holds = " ".join(licenses.TEMPLATES[0][1].split())
    rows = [(5, holds), (5, "nothing " * 30), (None, holds), (6, None), (7, holds)]
    out = licenses.licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    label = licenses.TEMPLATES[0][0]
    assert sorted((r.doc_id or 0, label in r.labels.split(",")) for r in out) == [(0, True), (5, False), (5, True), (6, False), (7, True)]
    found = licenses.passages(spark.createDataFrame(rows, "doc_id long, text string")).filter(F.col("label") == label)
    assert ids(found.select("doc_id").distinct()) == Counter([5, 7, None])


def test_a_repeated_id_keeps_the_links_of_all_its_texts(spark):
    a, b = sentence(10, 200), sentence(11, 200)
    near = lambda t: t.replace(" pi ", " pie ", 1)
    rows = [(10, a), (10, b), (11, near(a)), (12, near(b)), (13, sentence(12, 200)), (None, a), (10, None), (10, a), (2, b), (3, sentence(13, 200))]
    out = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert len(out) == len(rows)
    assert {(r.doc_id, r.component_id, r.kept) for r in out} == {
        (10, 2, False), (11, 2, False), (12, 2, False), (2, 2, True), (13, 13, True), (3, 3, True), (None, None, True)}
    assert Counter(r.n_shingles > 0 for r in out if r.doc_id == 10) == Counter([True, True, True, False])


def test_signature_of_a_long_text_in_slices():
    import numpy as np
    items = neardup.mixed(np.arange(5000, dtype=np.uint64))
    at = np.array([0, len(items)])
    assert (neardup._sliced(items, at, 700) == neardup.superminhash(items, at)).all()
