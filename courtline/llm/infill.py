"""Fill-in-middle transformation with a learned rank index (operator 13).

A text is cut at two code points, and to cut its UTF-8 bytes the byte offset of each cut is needed.  The index learns
the rank -> offset function of all boundaries between code points: segments of a straight line are fitted, each
as long as a line through its first boundary stays within ``ERROR`` bytes of every boundary of it (the cone of slopes
that still fit, narrowed boundary by boundary).  A cut is predicted by its segment, and the stored residual of
its boundary (a byte each) makes the prediction exact.  A text of one-byte code points is one segment.

Boundaries are taken a block of ``BLOCK`` bytes at a time, so besides the text itself an index holds a byte for each
code point and a few numbers for each segment.

Defined cases: a null text is empty, and an empty text is plain; a null doc_id draws its cuts as the empty string
does; rows with one doc_id draw the same numbers, each on its own length; texts with a marker are plain; texts are cut
whole, however long; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtline.llm.shared import ship

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_FROM, SPM_BELOW = 90, 20  # of a hundred
ERROR = 100  # a residual fits a signed byte
BLOCK = 1 << 20


class RankIndex:
    """Byte offsets of the boundaries between code points by rank: segments and residuals."""

    def __init__(self, data: np.ndarray, block: int = BLOCK):
        ranks, offsets, slopes, residuals, seen = [], [], [], [], 0
        for at in range(0, len(data), block):
            # ranks seen, seen + 1, ...: the offsets at which a code point begins
            starts = np.flatnonzero((data[at:at + block] & 0xC0) != 0x80) + at
            self._fit(starts, seen, ranks, offsets, slopes, residuals)
            seen += len(starts)
        self._fit(np.array([len(data)]), seen, ranks, offsets, slopes, residuals)  # the boundary behind the last one
        self.n = seen
        self.ranks, self.offsets = np.array(ranks, np.int64), np.array(offsets, np.int64)
        self.slopes, self.residuals = np.array(slopes), np.concatenate(residuals)

    @staticmethod
    def _fit(starts: np.ndarray, seen: int, ranks: list, offsets: list, slopes: list, residuals: list) -> None:
        first, reach = 0, 1024
        while first < len(starts):
            low, high, end = 0.0, np.inf, first + 1
            while end < len(starts):  # widen the segment by chunks while some slope fits all of it
                chunk = starts[end:end + reach]
                x = np.arange(end - first, end - first + len(chunk))
                y = chunk - starts[first]
                lows = np.maximum.accumulate(np.maximum((y - ERROR + 1) / x, low))
                highs = np.minimum.accumulate(np.minimum((y + ERROR - 1) / x, high))
                bad = np.flatnonzero(lows > highs)
                good = bad[0] if len(bad) else len(chunk)
                if good:
                    low, high, end = lows[good - 1], highs[good - 1], end + int(good)
                reach = min(2 * reach, 1 << 18) if not len(bad) else max(1024, reach // 2)
                if len(bad):
                    break
            slope = (low + high) / 2 if end - first > 1 else 1.0
            ranks.append(seen + first)
            offsets.append(starts[first])
            slopes.append(slope)
            line = np.floor(slope * np.arange(end - first)).astype(np.int64)
            residuals.append((starts[first:end] - starts[first] - line).astype(np.int8))
            first = end

    def offset(self, rank: int) -> int:
        """The byte offset of boundary ``rank``: predicted by its segment, corrected by its residual."""
        k = int(np.searchsorted(self.ranks, rank, "right")) - 1
        return int(self.offsets[k]) + int(np.floor(self.slopes[k] * (rank - self.ranks[k]))) + int(self.residuals[rank])


def drawn(n: Column, doc_id: Column) -> dict[str, Column]:
    """The cuts and the form's draws of a text of ``n`` code points."""
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h1, h2, h3, h4 = (F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4))
    a, b = h1 % (n + 1), h2 % (n + 1)
    return {"first": F.least(a, b), "second": F.greatest(a, b), "is_plain": h3 % 100 >= PLAIN_FROM, "is_spm": h4 % 100 < SPM_BELOW}


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cuts the texts of the rows that are not plain and puts the parts in the order of their form."""
    for batch in batches:
        kept, out, size, begun = batch.drop_columns(["text"]), [], 0, 0

        def done(end: int) -> pa.RecordBatch:
            rows = kept.slice(begun, end - begun)
            return pa.RecordBatch.from_arrays([*rows.columns, pa.array(out, pa.binary()).cast(pa.string())], [*rows.schema.names, "output"])

        texts = batch.column("text").cast(pa.binary()).to_pylist()
        for k, (form, a, b, raw) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("form", "first", "second")), texts)):
            if form == "plain":
                out.append(raw)
            else:
                index = RankIndex(np.frombuffer(raw, np.uint8))
                p, q = index.offset(a), index.offset(b)
                parts = {PREFIX: raw[:p], MIDDLE: raw[p:q], SUFFIX: raw[q:]}
                order = (PREFIX, SUFFIX, MIDDLE) if form == "psm" else (SUFFIX, PREFIX, MIDDLE)
                out.append(b"".join(m.encode() + parts[m] for m in order))
            size += len(raw)
            if size > 4_000_000:
                yield done(k + 1)
                out, size, begun = [], 0, k + 1
        if out:
            yield done(len(kept))


def infilled(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n, form (plain, psm or spm), prefix_chars, middle_chars (null if plain) and output."""
    ship(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.select("doc_id", "text", F.length("text").cast("long").alias("n"))
    draws = drawn(F.col("n"), F.col("doc_id"))
    marked = (F.col("n") == 0) | F.col("text").contains(PREFIX) | F.col("text").contains(SUFFIX) | F.col("text").contains(MIDDLE)
    form = F.when(marked | draws["is_plain"], "plain").when(draws["is_spm"], "spm").otherwise("psm")
    rows = texts.select("doc_id", "n", form.alias("form"), draws["first"].alias("first"), draws["second"].alias("second"), "text")
    out = rows.mapInArrow(_cut, "doc_id long, n long, form string, first long, second long, output string")
    cut = F.col("form") != "plain"
    return out.select("doc_id", "n", "form", F.when(cut, F.col("first")).alias("prefix_chars"),
                      F.when(cut, F.col("second") - F.col("first")).alias("middle_chars"), "output")


def restored(output: Column, form: Column) -> Column:
    """The text that an output of that form was made of.  A cut text holds no marker, so the markers part it."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    return F.when(form == "plain", output).when(form == "psm", F.concat(parts[1], parts[3], parts[2])) \
        .otherwise(F.concat(parts[2], parts[3], parts[1]))


def infill_digests(docs: DataFrame) -> DataFrame:
    """The outputs and the texts restored from them, as digests."""
    return infilled(docs).select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                                 F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))
