"""String column expressions: Unicode-aware strip, the ingredient tokenizer and its rules.

All are built-in Spark expressions (whole-stage codegen, no Python in the task).
Regex texts are written in the subset Java regex and RE2 read the same way, so the
DuckDB oracle can use the very same pattern strings.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sheen.functions.constants import INGREDIENT_DELIMITERS

# Whitespace as Python's ``str.isspace`` defines it, spelt out: Spark's ``trim`` strips
# blanks only, Java's ``\s`` is ASCII, RE2's ``\s`` lacks \v.
WS = (r"[\t\n\x{0b}\f\r\x{1c}-\x{1f} \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
      r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")

STRIP_RE = f"^{WS}+|{WS}+$"
#: The characters of ``WS``.
WS_CHARS = ("\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200b)))
            + "\u2028\u2029\u202f\u205f\u3000")


def _portable(py_regex: str) -> str:
    """Python-regex text -> Java/RE2 text with the explicit whitespace class."""
    return py_regex.replace(r"\s", WS)


INGREDIENT_SPLIT_RE = "|".join(_portable(d) for d in INGREDIENT_DELIMITERS)


def _by_first() -> str:
    """The alternation with its alternatives gathered by their first character, each kind in the given
    order: it matches the same, and most places of a text fail on one look at their character."""
    kinds: dict[str, list[str]] = {}
    for d in INGREDIENT_DELIMITERS:
        first = WS if d.startswith((r"\s", r"\n", r"\t")) else d[:2] if d.startswith("\\") else d[0]
        kinds.setdefault(first, []).append(_portable(d))
    firsts = "".join(f.strip("[]") if f == WS else f.replace("-", r"\-") for f in kinds)
    return f"(?=[{firsts}])(?:" + "|".join(f"(?={f})(?:{'|'.join(some)})" for f, some in kinds.items()) + ")"


#: For Java only: RE2 knows no lookahead.
FAST_SPLIT_RE = _by_first()



def ustrip(c: Column) -> Column:
    """Strip leading/trailing Unicode whitespace (Python ``str.strip()``)."""
    return F.btrim(c, F.lit(WS_CHARS))


def water_rule(t: Column) -> Column:
    return F.when(t.contains("water") & ~t.contains("water-binding"), F.lit("water")).otherwise(t)


def oil_rule(t: Column) -> Column:
    return F.when(t.contains(" oil") & ~t.contains("mineral oil"), F.lit("oil")).otherwise(t)


def extract_rule(t: Column) -> Column:
    return F.when(t.contains(" extract"), F.lit("extract")).otherwise(t)


def split_ingredients(c: Column) -> Column:
    """Lower-case and split on the ordered delimiter alternation (empties kept). Every delimiter
    becomes a comma, one of them, first: Spark reads the pattern of a split anew for each row."""
    return F.split(F.regexp_replace(F.lower(c), FAST_SPLIT_RE, ","), ",", -1)


def strip_tokens(arr: Column) -> Column:
    """Lower, strip and drop empty pieces."""
    return F.filter(F.transform(arr, lambda t: ustrip(F.lower(t))), lambda t: t != "")


def ingredient_tokens(c: Column, min_len: int = 4) -> Column:
    """The full token rule chain, in order: split, strip, water, oil, extract, length.

    A missing text gives an empty list (the source turns it into the string
    'nan', which the length rule then removes).
    """
    toks = strip_tokens(split_ingredients(c))
    toks = F.transform(toks, water_rule)
    toks = F.transform(toks, oil_rule)
    toks = F.transform(toks, extract_rule)
    toks = F.filter(toks, lambda t: F.length(t) >= min_len)
    return F.coalesce(toks, F.array().cast("array<string>"))


def consonant_key(t: Column) -> Column:
    """Deterministic stand-in group key used by SQL-checked group operators: the
    token with vowels and blanks removed, so spelling variants such as
    retinol/retinal share a key."""
    return F.regexp_replace(t, "[aeiouy ]", "")
