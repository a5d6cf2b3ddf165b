"""Near-duplicate groups by SuperMinHash (operator 5).

A document's set holds its distinct five-word shingles (the whole sequence as one where it has
fewer words).  Steps:

1. SuperMinHash signature of every set.  Each shingle walks a random permutation of the ``SLOTS``
   places and offers ``step + uniform`` to the place it meets, so the values of different
   places are correlated and vary less than independent ones.  A document stops as soon as no later
   step can lower any of its places.
2. Equal sets are one class, stood for by its smallest doc_id; only these go on.
3. Banding: ``BANDS`` bands of ``ROWS`` places.  In each bucket every member is paired with the
   bucket's smallest id only.  Pairs are checked on full sets, and links grouped by union-find.
4. Members of buckets that still hold several groups are gone over again, exactly: their shingles are
   ordered from the rarest, and two sets that reach the similarity must share one of their first few.
   Pairs of different groups meet on such shingles, and only if what follows in both orders is long
   enough; so edited copies, whose first shingles are their own, make no pairs with each other.
   Signatures that agree in under ``LEAST_AGREE`` places are left out (at 0.85 that is 8 deviations away,
   at the 0.8 of the pipeline 6).  So no link between different texts is lost except by banding, which misses a
   pair at 0.85 with probability (1 - 0.85 ** ROWS) ** BANDS, about 1e-5, and one at 0.8 with 4e-4.

Defined cases: null and wordless texts have an empty set and no link; an empty table gives an empty
result; rows that repeat a doc_id are one vertex, linked by any of their texts, and each get their row; a row with a null doc_id
is linked with nothing, keeps null as its component and is kept; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtline.llm.components import components
from courtline.llm.shared import exact, opaque, saved, short_batches, small_enough, text_of

SHINGLE = 5
SLOTS, ROWS = 100, 5
BANDS = SLOTS // ROWS
LEAST_AGREE = 55
BROADCAST_IDS = 1_000_000  # 8 MB of ids

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * _M1
    x = x ^ (x >> np.uint64(33))
    x = x * _M2
    return x ^ (x >> np.uint64(33))


class Words(dict):
    """64-bit hashes of words as they are met; emptied when it has grown too large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 100_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def shingles(text: str | None, hashes: Words, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a text, A-Z in lower case."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = max(1, len(h) - size + 1)
    out = np.full(n, len(h) if len(h) < size else 0, np.uint64)
    for k in range(min(size, len(h))):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + h[k:k + n])
    return np.unique(out)


def superminhash(items: np.ndarray, starts: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """Signatures (one row of ``slots`` floats each) of the sets ``items[starts[i]:starts[i+1]]``.

    All sets advance one permutation step at a time.  Step j adds j to a value in [0, 1), so a
    set whose places are all at most j + 1 is final and its elements stop.
    """
    sets = len(starts) - 1
    best = np.full((sets, slots), np.inf)
    owner = np.repeat(np.arange(sets), np.diff(starts))
    state, perm = items.astype(np.uint64), np.tile(np.arange(slots, dtype=np.uint8), (len(items), 1))
    for j in range(slots):
        if not len(owner):
            break
        row = np.arange(len(owner))
        state = mixed(state + np.uint64(0x9E3779B97F4A7C15))
        r = (state >> np.uint64(11)).astype(np.float64) * 2.0 ** -53
        state = mixed(state + np.uint64(0xD1B54A32D192ED03))
        k = j + (state % np.uint64(slots - j)).astype(np.int64)
        place = perm[row, k]
        perm[row, k] = perm[:, j]
        perm[:, j] = place
        at = owner * slots + place
        np.minimum.at(best.reshape(-1), at, j + r)
        going = best.max(axis=1) > j + 1
        on = going[owner]
        owner, state, perm = owner[on], state[on], perm[on]
    return best


def _sliced(items: np.ndarray, starts: np.ndarray, most: int = 200_000) -> np.ndarray:
    """``superminhash``; a set of more than ``most`` items in slices, of whose signatures each slot's least value counts."""
    if len(starts) != 2 or len(items) <= most:
        return superminhash(items, starts)
    best = None
    for at in range(0, len(items), most):
        part = items[at:at + most]
        sig = superminhash(part, np.array([0, len(part)]))
        best = sig if best is None else np.minimum(best, sig)
    return best


def _signed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    hashes = Words()
    for b in batches:
        ids, texts = b["doc_id"].tolist(), b["text"].tolist()
        at = 0
        while at < len(ids):  # as many documents at a time as have some 100,000 shingles
            part, total = [], 0
            while at < len(ids) and (not part or total < 100_000):
                part.append((ids[at], shingles(texts[at], hashes)))
                total += len(part[-1][1])
                at += 1
            sets = [s for _, s in part]
            starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)
            sig = mixed(_sliced(np.concatenate(sets), starts).view(np.uint64))
            bands = np.zeros((len(sets), BANDS), np.uint64)
            for r in range(ROWS):
                bands = mixed(bands * np.uint64(0x9E3779B97F4A7C15) + sig[:, r::ROWS])
            yield pd.DataFrame({
                "doc_id": [i for i, _ in part],
                "n_shingles": [len(s) for s in sets],
                "print": [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets],
                "bands": [x.view(np.int64) for x in bands],
                "sig": [(x & np.uint64(0xFFFF)).astype("<u2").tobytes() for x in sig]})


SIGNED = "doc_id string, n_shingles long, print binary, bands array<long>, sig binary"


def signed(docs: DataFrame) -> DataFrame:
    """Signature table: doc_id, set size, a 128-bit print of the set, band keys, the signature."""
    with short_batches(docs.sparkSession):
        return saved(exact(opaque(text_of(docs), "doc_id").mapInPandas(_signed, SIGNED), "doc_id"), "signatures")


def _linked(percent: int):
    def linked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, last, held = Words(), None, None
        for b in batches:
            good = np.zeros(len(b), bool)
            for i, (u, tu, tv) in enumerate(zip(b["u"].tolist(), b["text_u"].tolist(), b["text_v"].tolist())):
                if u != last:
                    last, held = u, shingles(tu, hashes)
                other = shingles(tv, hashes)
                both = len(np.intersect1d(held, other, assume_unique=True))
                good[i] = 100 * both >= percent * (len(held) + len(other) - both) > 0
            yield b.loc[good, ["u", "v"]]
    return linked


def _texts(docs: DataFrame, ids: DataFrame, tag: str) -> DataFrame:
    """doc_id and text of the documents in ``ids`` (column doc_id, distinct); other texts do not travel."""
    if small_enough(ids, BROADCAST_IDS):
        ids = F.broadcast(ids)
    return saved(text_of(docs).join(ids, "doc_id", "left_semi").dropDuplicates(["doc_id"]), tag)


def _verified(pairs: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets reach the similarity."""
    pairs = saved(pairs.distinct(), "pairs")
    ids = pairs.select(F.col("u").alias("doc_id")).union(pairs.select(F.col("v").alias("doc_id"))).distinct()
    texts = _texts(docs, ids, "pair-texts")
    tu = texts.select(F.col("doc_id").alias("u"), F.col("text").alias("text_u"))
    tv = texts.select(F.col("doc_id").alias("v"), F.col("text").alias("text_v"))
    with short_batches(docs.sparkSession):
        return saved(pairs.join(tv, "v").join(tu, "u").select("u", "v", "text_u", "text_v")
                     .mapInPandas(_linked(percent), "u long, v long"), "links")


def _spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    hashes = Words()
    for b in batches:
        for doc, text in zip(b["doc_id"].tolist(), b["text"].tolist()):
            found = shingles(text, hashes).view(np.int64)
            yield pd.DataFrame({"rep": np.full(len(found), doc), "shingle": found})


def _agreeing(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        if len(b):
            u = np.frombuffer(b"".join(b["sig_u"]), "<u2").reshape(-1, SLOTS)
            v = np.frombuffer(b"".join(b["sig_v"]), "<u2").reshape(-1, SLOTS)
            yield b.loc[(u == v).sum(axis=1) >= LEAST_AGREE, ["u", "v"]]


def _rest(rows: DataFrame, groups: DataFrame, reps: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """Pairs of different groups, both in a bucket of several groups, that may be similar enough (prefix filter)."""
    rows = rows.join(groups, rows.rep == groups.id, "left").drop("id").withColumn("component", F.coalesce("component", "rep"))
    several = rows.groupBy("band", "key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi")
    several = saved(several.select("band", "key"), "open-buckets")  # written first: see below
    members = saved(rows.join(several, ["band", "key"], "left_semi")
                    .select("rep", "component").distinct(), "open-members")
    with short_batches(docs.sparkSession):
        spread = saved(_texts(docs, members.select(F.col("rep").alias("doc_id")), "open-texts")
                       .mapInPandas(_spread, "rep long, shingle long"), "open-shingles")
    # counts and groups that rows are joined back to are written first, so that Spark can split the join of a hot key
    often = saved(spread.groupBy("shingle").agg(F.count("*").alias("c")), "open-counts")
    ordered = spread.join(often, "shingle").groupBy("rep").agg(F.array_sort(F.collect_list(F.struct("c", "shingle"))).alias("s"))
    n = F.size("s")
    first = n - F.ceil(F.lit(percent) * n / 100) + 1  # one of so many is shared
    tokens = ordered.select("rep", n.alias("n"), F.posexplode(F.slice("s", F.lit(1), first.cast("int"))).alias("at", "x")) \
        .filter("x.c > 1").join(members, "rep").select("rep", "component", (F.col("n") - F.col("at")).alias("left"), "n", F.col("x.shingle").alias("shingle"))
    tokens = saved(tokens, "open-tokens")
    shared = saved(tokens.groupBy("shingle").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
                   .filter("lo < hi").drop("hi"), "open-shared")
    tokens = tokens.join(shared, "shingle")
    # the members of a shingle's first group need no pairs with each other
    u, v = (tokens.select("shingle", "lo", *[F.col(c).alias(f"{c}_{side}") for c in ("rep", "component", "left", "n")]) for side in "uv")
    least = F.least("left_u", "left_v")
    pairs = u.filter("component_u <> lo").join(v.drop("lo"), "shingle").filter(
        (F.col("component_u") != F.col("component_v")) & ((F.col("component_v") == F.col("lo")) | (F.col("rep_u") < F.col("rep_v")))
        & (100 * least >= percent * (F.col("n_u") + F.col("n_v") - least)))
    pairs = pairs.select(F.least("rep_u", "rep_v").alias("u"), F.greatest("rep_u", "rep_v").alias("v")).distinct()
    sig = reps.select("doc_id", "sig")
    pairs = pairs.join(sig.withColumnsRenamed({"doc_id": "u", "sig": "sig_u"}), "u") \
        .join(sig.withColumnsRenamed({"doc_id": "v", "sig": "sig_v"}), "v")
    return pairs.select("u", "v", "sig_u", "sig_v").mapInPandas(_agreeing, "u long, v long")


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, kept (see the module's text).

    A doc_id with several texts links what any of them is linked with: its texts are vertices of their own
    while groups are formed, and groups that share a doc_id are one.
    """
    several = _repeated_ids(docs)
    if several is None:
        return _grouped(docs, percent)
    found = saved(_grouped(_own_vertices(docs, several), percent).select(F.col("doc_id").alias("vertex"), "n_shingles", "component_id"), "vertices")
    own = saved(_own_vertices(docs, several).select(F.col("doc_id").alias("vertex"), F.col("__own").alias("doc_id"))
                .filter("vertex is not null").distinct(), "vertex-ids")
    if small_enough(own, BROADCAST_IDS):
        own = F.broadcast(own)
    rows = saved(found.join(own, "vertex", "left").select("doc_id", "n_shingles", F.col("component_id").alias("component")), "own-ids")
    member = saved(rows.filter("doc_id is not null").groupBy("doc_id").agg(F.min("component").alias("lo"), F.max("component").alias("hi")), "id-groups")
    split = rows.join(member.filter("lo < hi").select("doc_id", "lo"), "doc_id")
    merged = saved(components(split.select(F.col("component").alias("u"), F.col("lo").alias("v")).filter("u <> v")), "merged-groups")
    member = member.join(merged, member.lo == merged.id, "left").select("doc_id", F.coalesce(merged.component, member.lo).alias("group"))
    # a group is known by its smallest doc_id, which may not be its smallest vertex
    least = member.groupBy("group").agg(F.min("doc_id").alias("component_id"))
    ids = saved(member, "merged-ids").join(saved(least, "least-ids"), "group").select("doc_id", "component_id")
    out = rows.select("doc_id", "n_shingles").join(saved(ids, "ids-of-groups"), "doc_id", "left")
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def _repeated_ids(docs: DataFrame) -> DataFrame | None:
    """The doc_ids that occur with several texts, with the least hash of these; None if there are none."""
    mark = F.xxhash64(F.coalesce("text", F.lit("")))
    several = docs.filter("doc_id is not null").groupBy("doc_id").agg(F.min(mark).alias("__first"), F.max(mark).alias("__last")) \
        .filter("__first < __last").select(F.col("doc_id").alias("__id"), "__first")
    several = saved(several, "repeated-ids")
    return several if several.limit(1).count() else None


def _own_vertices(docs: DataFrame, several: DataFrame) -> DataFrame:
    """``docs`` with a doc_id for each text of a repeated one, and the given ids as ``__own``.

    The text with the least hash keeps the doc_id; the others are known by a 63-bit hash of id and text.
    """
    if small_enough(several, BROADCAST_IDS):
        several = F.broadcast(several)
    mark = F.xxhash64(F.coalesce("text", F.lit("")))
    other = F.xxhash64("doc_id", mark).bitwiseAND(F.lit(2 ** 63 - 1))
    return docs.join(several, docs.doc_id == F.col("__id"), "left").withColumn("__own", F.col("doc_id")) \
        .withColumn("doc_id", F.when(mark > F.col("__first"), other).otherwise(F.col("doc_id"))).drop("__id", "__first")


def _grouped(docs: DataFrame, percent: int) -> DataFrame:
    """``near_duplicates`` where each doc_id has one text."""
    table = signed(docs)
    named = table.filter("doc_id is not null and print is not null")
    classes = named.groupBy("print").agg(F.min_by(F.struct("doc_id", "n_shingles", "bands", "sig"), "doc_id").alias("r"))
    reps = saved(classes.select("r.*", "print"), "classes")
    rows = reps.select(F.col("doc_id").alias("rep"), F.col("n_shingles").alias("n"), F.posexplode("bands").alias("band", "key"))
    buckets = rows.groupBy("band", "key").agg(F.min("rep").alias("u"), F.count("*").alias("members")).filter("members > 1")
    buckets = saved(buckets.select("band", "key", "u"), "pivots")
    rows = saved(rows.join(buckets, ["band", "key"]), "buckets")
    stars = rows.filter("u <> rep").select("u", F.col("rep").alias("v"))
    links = _verified(stars, docs, percent)
    groups = saved(components(links), "groups")
    rest = _rest(rows.drop("u"), groups, reps, docs, percent)
    more = _verified(rest, docs, percent)
    if more.limit(1).count():
        groups = components(links.union(more))
    same = named.select("doc_id", "print").join(reps.select("print", F.col("doc_id").alias("rep")), "print")
    joined = same.join(groups, same.rep == groups.id, "left").select(
        F.col("doc_id"), F.coalesce("component", "rep").alias("component"))
    member = joined.groupBy("doc_id").agg(F.min("component").alias("lo"))  # rows repeat
    found = member.select("doc_id", F.col("lo").alias("component_id"))
    out = table.select("doc_id", "n_shingles").join(found, "doc_id", "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def one_of_each(docs: DataFrame, percent: int = 85) -> DataFrame:
    """The rows of ``docs`` that stand for their group, one per doc_id (the least by its columns); null ids stay."""
    kept = near_duplicates(docs.filter("doc_id is not null"), percent).filter("kept").select("doc_id").distinct()
    known = docs.join(kept, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(F.struct(*docs.columns)).alias("__row"))
    return known.select(*[F.col("__row")[c].alias(c) for c in docs.columns]).union(docs.filter("doc_id is null").select(*docs.columns))


def one_of_each_text(docs: DataFrame, percent: int = 85) -> DataFrame:
    """As ``one_of_each``, but rows of one doc_id with different texts are vertices of their own."""
    several = _repeated_ids(docs)
    if several is None:
        return one_of_each(docs, percent)
    kept = one_of_each(_own_vertices(docs, several), percent)
    return kept.select(*[F.col("__own").alias(c) if c == "doc_id" else F.col(c) for c in docs.columns])
