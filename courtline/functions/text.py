"""Text cleaning expressions: blank handling and accent folding.

Accent folding replaces a database extension.  The single-character part of the map is
generated by a rule (Unicode canonical decomposition of the Latin blocks, keeping the
ASCII base letter); letters that have no decomposition are listed as fixed values.
Both parts run JVM-side as ``translate`` + ``replace`` so the expression stays inside
whole-stage codegen.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: letters that neither decompose nor carry their base in their name --
FOLD_SINGLE_FIXED = {"Ð": "D", "ð": "d", "ı": "i", "Ŋ": "N", "ŋ": "n"}
FOLD_MULTI_FIXED = {
    "ß": "ss", "Æ": "AE", "æ": "ae", "Œ": "OE", "œ": "oe", "Þ": "TH", "þ": "th",
    "Ĳ": "IJ", "ĳ": "ij",
}

# Every Latin block beyond ASCII: Latin-1 Supplement to Extended-B, IPA Extensions, Extended
# Additional, Extended-C and Extended-D.
_LATIN_BLOCKS = ((0x00C0, 0x02B0), (0x1E00, 0x1F00), (0x2C60, 0x2C80), (0xA720, 0xA800))
_NAMED = re.compile(r"LATIN (CAPITAL|SMALL) LETTER ([A-Z])(?: WITH .*)?")


def _base_letter(ch: str) -> str | None:
    """The letter under a Latin one: by decomposition, or by its name ("... LETTER L WITH STROKE")."""
    base = unicodedata.normalize("NFD", ch)[0]
    if base.isascii() and base.isalpha():
        return base
    if base != ch:  # what is left of an accented ligature is spelled out later
        return base if base in FOLD_MULTI_FIXED else _base_letter(base)
    named = _NAMED.fullmatch(unicodedata.name(ch, ""))
    return (named[2] if named[1] == "CAPITAL" else named[2].lower()) if named else None


@lru_cache(maxsize=1)
def fold_translation() -> tuple[str, str]:
    """(from_chars, to_chars) for ``translate``: rule-generated plus fixed singles."""
    src, dst = [], []
    for block in _LATIN_BLOCKS:
        for ch in map(chr, range(*block)):
            if base := _base_letter(ch):
                src.append(ch)
                dst.append(base)
    for ch, repl in FOLD_SINGLE_FIXED.items():
        if ch not in src:
            src.append(ch)
            dst.append(repl)
    return "".join(src), "".join(dst)


def fold_accents_py(s: str | None) -> str | None:
    """Pure-Python reference of :func:`fold_accents`, for tests."""
    if s is None:
        return None
    src, dst = fold_translation()
    s = s.translate(str.maketrans(src, dst))
    for k, v in FOLD_MULTI_FIXED.items():
        s = s.replace(k, v)
    return s


def fold_accents(col: Column | str) -> Column:
    """Fold accented Latin letters to ASCII (the warehouse's UNACCENT)."""
    c = F.col(col) if isinstance(col, str) else col
    src, dst = fold_translation()
    out = F.translate(c, src, dst)
    for k, v in FOLD_MULTI_FIXED.items():
        out = F.replace(out, F.lit(k), F.lit(v))
    return out


def blank_to_null(col: Column | str) -> Column:
    """``NULLIF(TRIM(x), '')``: trim spaces, then treat the empty string as missing."""
    c = F.col(col) if isinstance(col, str) else col
    return F.nullif(F.trim(c), F.lit(""))


# ---- fixed values: country spellings normalised to the lookup's names ---------------
COUNTRY_RENAMES = {
    "México": "Mexico",
    "DRC": "Democratic Republic of the Congo",
    "Macedonia": "North Macedonia",
}


def normalise_country(col: Column | str) -> Column:
    c = blank_to_null(col)
    out = None
    for raw, clean in COUNTRY_RENAMES.items():
        same = F.equal_null(c, F.lit(raw))  # a function, as views are written out as SQL
        out = F.when(same, F.lit(clean)) if out is None else out.when(same, F.lit(clean))
    return out.otherwise(c)


def jersey_list(col: Column | str) -> Column:
    """``NULLIF(REPLACE(TRIM(j), '-', ', '), '')``: '3-33' becomes '3, 33'."""
    c = F.col(col) if isinstance(col, str) else col
    return F.nullif(F.replace(F.trim(c), F.lit("-"), F.lit(", ")), F.lit(""))
