"""Text and number columns: trimming, decimals, folded names, canonical number text."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as `str.strip` sees it.
BLANKS = r"[\s   -     　\u0085\u001c-\u001f]+"
DECIMAL = r"^[+-]?([0-9]+(_[0-9]+)*([.]([0-9]+(_[0-9]+)*)?)?|[.][0-9]+(_[0-9]+)*)([eE][+-]?[0-9]+)?$"


def clean(value: Column) -> Column:
    """Trimmed text, '' for null."""
    return F.regexp_replace(F.coalesce(value.cast("string"), F.lit("")), f"^{BLANKS}|{BLANKS}$", "")


def is_blank(value: Column) -> Column:
    return clean(value) == ""


def parse_decimal(value: Column) -> Column:
    """Number of a text with spaces and a decimal comma; null if it is none. nan and inf are numbers, as in `float`."""
    text = F.regexp_replace(F.regexp_replace(clean(value), "[  ]", ""), ",", ".")
    plain = F.when(text.rlike(DECIMAL), F.regexp_replace(text, "_", "").try_cast("double"))
    word = F.lower(F.regexp_extract(text, r"^[+-]?([A-Za-z]+)$", 1))
    sign = F.when(text.startswith("-"), F.lit(-1.0)).otherwise(F.lit(1.0))
    return F.when(word == "nan", F.lit(float("nan"))).when(word.isin("inf", "infinity"), sign * F.lit(float("inf"))).otherwise(plain)


def _foldings() -> tuple[dict[str, str], dict[str, str]]:
    """What lower-case characters decompose to beside marks and other characters that a name drops: one letter or digit, and several."""
    single, several = {}, {}
    for code in (*range(0xA0, 0xD800), *range(0xF900, 0x30000)):
        parts = unicodedata.normalize("NFKD", chr(code))
        folded = re.sub("[^a-z0-9]+", " ", "".join(c for c in parts if not unicodedata.combining(c)))
        if parts != chr(code) and folded.strip():
            (single if len(folded) == 1 else several)[chr(code)] = folded
    return single, several


_SINGLE, _SEVERAL = _foldings()
_MARKS = "[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in ((0x300, 0x36F), (0x483, 0x487), (0x1AB0, 0x1ACE), (0x1DC0, 0x1DFF), (0x20D0, 0x20DC))) + "]"
#: As one text, which is parsed at once; a Column for each entry would take seconds.
_SEVERAL_SQL = f"map({', '.join(f"'{k}', '{v}'" for k, v in sorted(_SEVERAL.items()))})"
#: Stands for a character of several letters in the first pass; a text that holds it anyhow is only looked at more closely.
_MARKER = "\ue000"


def normalize_name(value: Column) -> Column:
    """Lower case, compatibility decomposition without marks, runs of all but a-z and 0-9 as one space, trimmed.

    Letters without a decomposition, such as l with stroke, are dropped.
    """
    lower = F.lower(F.coalesce(value, F.lit("")))
    single, letters = "".join(_SINGLE), "".join(_SINGLE.values())
    # Most texts are ASCII. One pass over the others folds single letters and marks ligatures and the like, which few texts have.
    marked = F.translate(lower, single + "".join(_SEVERAL), letters + _MARKER * len(_SEVERAL))
    several = F.expr(_SEVERAL_SQL)
    spelled = F.array_join(F.transform(F.split(lower, ""), lambda c: F.when(c > "\x7f", F.coalesce(several[c], c)).otherwise(c)), "")
    # The lambda's variable is computed once, though it is used twice.
    once = F.get(F.transform(F.array(marked), lambda m: F.when(m.contains(_MARKER), F.translate(spelled, single, letters)).otherwise(m)), F.lit(0))
    folded = F.when(lower.rlike(r"[^\x00-\x7f]"), F.regexp_replace(once, _MARKS, "")).otherwise(lower)
    return F.trim(F.regexp_replace(folded, "[^a-z0-9]+", " "))


def names_equal(a: Column, b: Column) -> Column:
    return (normalize_name(a) != "") & (normalize_name(a) == normalize_name(b))


def number_text(value: Column, digits: int = 12) -> Column:
    """Text with so many significant digits and no trailing zeros, for numbers from 1e-4 to below 10^digits; others as the engine casts them."""
    size = F.abs(value)
    whole = F.greatest(F.floor(F.log10(F.when(size > 0, size).otherwise(1.0))).cast("int") + 1, F.lit(-3))
    places = F.greatest(F.lit(digits) - whole, F.lit(0))
    shown = F.call_function("format_number", value, places)
    text = F.regexp_replace(F.regexp_replace(shown, ",", ""), r"(\.[0-9]*?)0+$", "$1")
    text = F.regexp_replace(text, r"\.$", "")
    usual = (size < 10.0**digits) & ((size >= 1e-4) | (size == 0))
    return F.when(usual, F.when(text == "-0", "0").otherwise(text)).otherwise(value.cast("string"))


def truncated(value: Column, length: int = 254) -> Column:
    return F.substring(F.coalesce(value.cast("string"), F.lit("")), 1, length)


def markdown_cell(value: Column) -> Column:
    text = F.replace(F.replace(clean(value), F.lit("|"), F.lit("\\|")), F.lit("\n"), F.lit("<br>"))
    return F.when(text == "", "-").otherwise(text)


def joined_values(values: Column) -> Column:
    """Distinct trimmed non-blank values in order, joined by ';'; null if there are none."""
    kept = F.array_distinct(F.filter(F.transform(values, clean), lambda v: v != ""))
    return F.when(F.size(kept) > 0, F.array_join(kept, ";"))


def is_url_like(value: Column) -> Column:
    return F.instr(value, "://") > 0


def is_http_url(value: Column) -> Column:
    """A scheme of http or https and something for a host."""
    return value.rlike(r"^(?i:https?)://[^/?#]+")


def positive_int(value: Column) -> Column:
    number = value.cast("string").try_cast("double")
    return F.when(number >= 1, F.floor(number).cast("long"))
