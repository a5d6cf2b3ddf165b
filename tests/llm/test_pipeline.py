"""The stages: each keeps the columns, its decision takes effect, and clean documents stay."""

import corpus_pipeline
from courtline.llm.shared import documents
from tests.conftest import SF_SMALL


def test_stages_in_order(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "decontamination", "personal_data", "packing"]
    docs = documents(spark, SF_SMALL)
    columns, seen = docs.columns, [docs.count()]
    extra = "Call +1 (212) 555-0000 or a@b.co " + " ".join(f"own{k}" for k in range(60))
    item = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").first()["text"]
    planted = [(900_000, extra, "en", "src0", len(extra)), (900_001, extra, "en", "src0", len(extra)),
               (900_002, "fresh words here " + item + " " + " ".join(f"q{k}" for k in range(40)), "en", "src0", 1), (900_003, None, "en", "src0", 0)]
    docs = docs.union(spark.createDataFrame(planted, docs.schema))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_SMALL).persist()
        assert docs.columns == columns
        seen.append(docs.count())
        ids = {r.doc_id for r in docs.filter("doc_id >= 900000").select("doc_id").collect()}
        assert ids == {"quality_rules": {900_000, 900_001, 900_002}, "near_duplicates": {900_000, 900_002}}.get(name, {900_000})
    text = docs.filter("doc_id = 900000").first()
    assert text["text"].startswith("Call [PHONE] or [EMAIL] own0") and text["n_chars"] == len(text["text"])
    assert seen[-1] > 0.5 * seen[0]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL)
    assert packed.select("doc_id").distinct().count() == seen[-1]


def test_stages_take_empty_documents(spark):
    docs = documents(spark, SF_SMALL).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF_SMALL).count() == 0


def test_near_copies_between_080_and_085_go(spark):
    words = [f"n{k}" for k in range(110)]  # two words changed: 96 of 116 shingles are shared, 0.83
    copy = [f"other{k}" if k in (30, 70) else w for k, w in enumerate(words)]
    far = [f"far{k}" if k in (30, 50, 70) else w for k, w in enumerate(copy)]  # 0.75 and less
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(copy)), (3, " ".join(far))], "doc_id long, text string")
    assert {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, SF_SMALL).collect()} == {1, 3}


def test_rows_are_judged_by_their_own_text(spark):
    own = lambda k: " ".join(f"r{k}_{j}" for j in range(40))
    rows = [(None, own(0)), (7, own(1)), (7, "too short"), (8, own(2)), (8, own(3)), (8, own(3)), (9, own(2) + " more"), (10, own(4))]
    docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    clean = corpus_pipeline.quality_rules(spark, docs, SF_SMALL)
    assert clean.columns == docs.columns
    assert sorted(r.text for r in clean.collect()) == sorted(t for _, t in rows if t != "too short")
    kept = corpus_pipeline.near_duplicates(spark, clean, SF_SMALL)
    assert kept.columns == docs.columns
    got = [(r.doc_id, r.text) for r in kept.collect()]
    near = [x for x in got if x[1].startswith("r2_")]  # one of rows 8 and 9, which are like each other
    assert len(near) == 1 and sorted(t for _, t in got if not t.startswith("r2_")) == sorted([own(0), own(1), own(3), own(4)])
    assert {i for i, t in got if t == own(3)} == {8}
