"""Quality rules with adaptive thresholds (operator 7), in DataFrame functions only.

Each document is measured in one pass.  The measures of a (language, source) cell go into a
mergeable quantile sketch: counts per logarithmic bucket, so a quantile is known to within
``GAMMA`` of its value whatever the order in which partial sketches merge.  A cell with fewer
than ``MIN_CELL`` documents takes the merged sketch of its language, and a language with fewer
takes that of the corpus.  A document goes if it fails the base rules or if a measure lies above
the fence ``q75 + FENCE * max(q75 - q25, spread)`` of its cell.

Defined cases: a null text is empty (no words, so the base rules fail); a null language or source
is a cell of its own; repeated rows count as often as they occur and each gets its row; columns
beyond the ones read are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtline.llm.shared import saved

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
GAMMA = 1.05
MIN_CELL = 50
FENCE = 3.0

#: The measures that have a fence, and the least spread each is taken to have.
SPREAD = {"symbols_per_word": 0.1, "upper_share": 0.1, "dup_line_share": 0.2, "repeat_share": 0.1,
          "word_length": 3.0}


def _covered_by_repeats(grams: Column) -> Column:
    """Words that lie in a window whose hash occurs twice or more, from the windows' hashes."""
    tagged = F.array_sort(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def starts(s: Column) -> Column:
        hit = F.transform(s, lambda x, i: F.when(
            (x["h"] == F.get(s, i - 1)["h"]) | (x["h"] == F.get(s, i + 1)["h"]), x["i"]))
        return F.array_sort(F.filter(hit, lambda p: p.isNotNull()))

    def cover(p: Column) -> Column:
        parts = F.transform(p, lambda x, i: F.least(
            F.lit(WINDOW), F.coalesce(F.get(p, i + 1) - x, F.lit(WINDOW))))
        return F.aggregate(parts, F.lit(0).cast("long"), lambda a, x: a + x)

    # a one-element array binds its value to a name, so that it is computed once
    bind = lambda value, f: F.get(F.transform(F.array(value), f), F.lit(0))
    return bind(tagged, lambda s: bind(starts(s), cover))


def _paired(hashes: Column, step: int) -> Column:
    """Of each window hash and the one ``step`` places on; too short an array gives an empty one."""
    n = F.greatest(F.size(hashes) - step, F.lit(0))
    return F.zip_with(F.slice(hashes, F.lit(1), n), F.slice(hashes, F.lit(step + 1), n), lambda a, b: F.xxhash64(a, b))


def measured(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns of ``docs`` with the base counts and the two further counts."""
    t = F.coalesce(F.col("text"), F.lit(""))
    df = docs.select(*keep, t.alias("__t"))
    df = df.withColumn("__w", F.array_remove(F.split("__t", SPACE), ""))
    df = df.withColumn("__h", F.transform("__w", lambda w: F.xxhash64(w)))
    marks = F.regexp_replace("__t", rf"[^{SYMBOLS}\p{{Lu}}]+", "")  # the symbols and the capitals, in place
    df = df.select(
        *keep, "__h", F.size("__w").cast("long").alias("n_words"),
        F.length(F.array_join("__w", "")).cast("long").alias("word_chars"),
        F.filter(F.split("__t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("__lines"),
        marks.alias("__marks"))
    df = df.withColumn("n_symbols", F.length(F.regexp_replace("__marks", r"\p{Lu}+", "")).cast("long")) \
        .withColumn("n_upper", F.length("__marks") - F.col("n_symbols")).drop("__marks")
    for name, source, step in (("__h2", "__h", 1), ("__h4", "__h2", 2), ("__g", "__h4", 4)):
        df = df.withColumn(name, _paired(F.col(source), step))  # hashes of windows of twice the length
    repeats = F.when(F.size("__g") > F.size(F.array_distinct("__g")), _covered_by_repeats(F.col("__g")))
    return df.select(
        *keep, "n_words", "word_chars", "n_symbols", "n_upper",
        F.size("__lines").cast("long").alias("n_lines"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(repeats, F.lit(0)).cast("long").alias("n_repeat_words"))


def _shares(df: DataFrame) -> DataFrame:
    per = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))
    return df.withColumns({
        "symbols_per_word": per("n_symbols", "n_words"), "upper_share": per("n_upper", "word_chars"),
        "dup_line_share": per("n_dup_lines", "n_lines"), "repeat_share": per("n_repeat_words", "n_words"),
        "word_length": per("word_chars", "n_words")})


def sketch(df: DataFrame, by: list[str], measures: list[str]) -> DataFrame:
    """Per cell and measure the documents in each logarithmic bucket (``MIN`` for zero)."""
    bucket = F.when(F.col("value") > 0, F.ceil(F.log("value") / F.log(F.lit(GAMMA)))).otherwise(F.lit(-10**6))
    tall = df.select(*by, F.explode(F.array(*[
        F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("value")) for m in measures])).alias("m"))
    tall = tall.select(*by, "m.measure", "m.value")
    return tall.groupBy(*by, "measure", bucket.cast("long").alias("bucket")).agg(F.count("*").alias("n"))


def merged(cells: DataFrame, by: list[str]) -> DataFrame:
    """Sketches merge by adding the counts of a bucket."""
    return cells.groupBy(*by, "measure", "bucket").agg(F.sum("n").alias("n"))


def quantiles(cells: DataFrame, by: list[str]) -> DataFrame:
    """q25 and q75 of every sketch and the documents in it.  A sketch has a bounded number of
    buckets (some hundreds between the least and the largest double met), so its counts are
    gathered in one ordered array."""
    s = cells.groupBy(*by, "measure").agg(
        F.array_sort(F.collect_list(F.struct("bucket", "n"))).alias("b"), F.sum("n").alias("docs"))

    def at(q: float) -> Column:
        found = F.aggregate(
            "b", F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast("long").alias("at")),
            lambda a, x: F.struct(
                (a["seen"] + x["n"]).alias("seen"),
                F.when(a["at"].isNull() & ((a["seen"] + x["n"]) >= F.lit(q) * F.col("docs")), x["bucket"])
                .otherwise(a["at"]).alias("at")))["at"]
        return F.when(found == -10**6, F.lit(0.0)).otherwise(F.pow(F.lit(GAMMA), found))

    return s.select(*by, "measure", "docs", at(0.25).alias("q25"), at(0.75).alias("q75"))


def fences(cells: DataFrame, measures: dict[str, float] = SPREAD) -> DataFrame:
    """One row per (lang, source): an upper fence for each measure."""
    spread = F.create_map(*[F.lit(x) for m, v in measures.items() for x in (m, v)])

    def fenced(df: DataFrame, by: list[str], name: str) -> DataFrame:
        fence = F.col("q75") + FENCE * F.greatest(F.col("q75") - F.col("q25"), spread[F.col("measure")])
        return df.select(*by, "measure", "docs", fence.alias(name))

    cell = fenced(quantiles(cells, ["lang", "source"]), ["lang", "source"], "own")
    by_lang = fenced(quantiles(merged(cells, ["lang"]), ["lang"]), ["lang"], "of_lang") \
        .withColumnRenamed("docs", "lang_docs").withColumnRenamed("lang", "lang_")
    whole = fenced(quantiles(merged(cells, []), []), [], "of_all").drop("docs").withColumnRenamed("measure", "measure_")
    out = cell.join(by_lang.withColumnRenamed("measure", "m_"),
                    cell.lang.eqNullSafe(F.col("lang_")) & (cell.measure == F.col("m_")))
    out = out.join(whole, out.measure == F.col("measure_"))
    fence = F.when(F.col("docs") >= MIN_CELL, F.col("own")) \
        .when(F.col("lang_docs") >= MIN_CELL, F.col("of_lang")).otherwise(F.col("of_all"))
    return out.groupBy("lang", "source").agg(*[
        F.max(F.when(F.col("measure") == m, fence)).alias(f"max_{m}") for m in measures])


def _judged(docs: DataFrame, keep: list[str], tag: str) -> DataFrame:
    """``keep`` columns, lang and source among them, the measures, base_failed and kept of each row of ``docs``."""
    base_failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    table = saved(_shares(measured(docs, keep)).withColumn("base_failed", base_failed), tag)
    limits = fences(sketch(table, ["lang", "source"], list(SPREAD))) \
        .withColumnRenamed("lang", "lang_").withColumnRenamed("source", "source_")
    judged = table.join(limits, table.lang.eqNullSafe(F.col("lang_")) & table.source.eqNullSafe(F.col("source_")), "left")
    above = F.lit(False)
    for m in SPREAD:
        above = above | F.coalesce(F.col(m) > F.col(f"max_{m}"), F.lit(False))
    return judged.withColumn("kept", ~F.col("base_failed") & ~above)


def quality(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, the base counts, base_failed, kept (see the module's text)."""
    return _judged(docs, ["doc_id", "lang", "source"], "quality").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", *SPREAD)


def kept_rows(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns, each judged by its own text whatever its doc_id."""
    rows = docs.select(F.struct(*docs.columns).alias("row"), "text", "lang", "source")
    return _judged(rows, ["row", "lang", "source"], "quality-rows").filter("kept").select("row.*")


def kept_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose document is kept, with their columns.

    A document is known by doc_id; rows with a null doc_id stay out of the join and go, as
    nothing can refer to them.  Rows that repeat a doc_id stay if each of them is kept.
    """
    verdict = quality(docs).groupBy("doc_id").agg(F.min("kept").alias("__kept")).filter("__kept").select("doc_id")
    return docs.join(verdict, "doc_id", "left_semi").select(*docs.columns)
