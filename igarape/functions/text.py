"""Text expressions. All are built-in functions, so they stay in the JVM."""

from __future__ import annotations

import sys
import unicodedata
from functools import reduce
from itertools import chain
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _folding_tables() -> tuple[str, str, dict[str, str]]:
    """Compatibility decomposition without combining marks, worked out by rule over the whole code range.

    Only composed Hangul syllables are left as they are; they have no marks. Returns one-to-one
    source and target texts plus the characters that become several.
    """
    source, target, several = [], [], {}
    for point in chain(range(0x80, 0xAC00), range(0xE000, sys.maxunicode + 1)):
        char = chr(point)
        if not unicodedata.decomposition(char):
            continue
        base = "".join(
            c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c)
        )
        if base == char or not base:
            continue
        if len(base) == 1:
            source.append(char)
            target.append(base)
        else:
            several[char] = base
    return "".join(source), "".join(target), several


_FOLD_FROM, _FOLD_TO, _FOLD_SEVERAL = _folding_tables()
_COMBINING = "".join(chr(p) for p in range(0x0300, sys.maxunicode + 1) if unicodedata.combining(chr(p)))
_NON_ASCII = r"[^\x00-\x7F]"
_BEYOND_COMMON = r"[^\x00-\x7F\u00C0-\u0131]"


def _class_of(chars) -> str:
    """A regex class of characters beyond ASCII, as ranges; ASCII is ruled out before they are gone through."""
    ranges: list[list[int]] = []
    for point in sorted(map(ord, chars)):
        if ranges and point == ranges[-1][1] + 1:
            ranges[-1][1] = point
        else:
            ranges.append([point, point])
    return r"[\x{80}-\x{10FFFF}&&[" + "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in ranges) + "]]"


_SEVERAL = _class_of(_FOLD_SEVERAL)
# All but ASCII letters, digits, underscores and blanks. Written out, as the negated class takes five times as long.
_NOT_COMPACT = r"[\x00-\x1F!-/:-@\[-^`{-\x{10FFFF}]"


def strip_accents(value: Column | str) -> Column:
    """Drop combining marks after compatibility decomposition; other scripts are kept."""
    text = as_column(value)
    # Marks come last in the source and have no target, so they are deleted.
    folded = F.translate(text, _FOLD_FROM + _COMBINING, _FOLD_TO)
    # Each character that becomes several is found first, so the look-ups are as many as those.
    sources, targets = (F.split(F.lit("\x01".join(x)), "\x01") for x in (_FOLD_SEVERAL, _FOLD_SEVERAL.values()))
    table = F.map_from_arrays(sources, targets)
    found = F.regexp_extract_all(folded, F.lit(f"({_SEVERAL})"), F.lit(1))
    between = F.split(folded, _SEVERAL, -1)
    written = F.zip_with(between, found, lambda text, char: F.concat(text, F.coalesce(F.try_element_at(table, char), F.lit(""))))
    expanded = F.when(folded.rlike(_SEVERAL), F.array_join(written, "")).otherwise(folded)
    # Plain ASCII (as many bytes as characters) is returned as it is, and text whose other
    # characters are common accented letters skips the characters that become several.
    return (
        F.when(F.octet_length(text) == F.length(text), text)
        .when(text.rlike(_BEYOND_COMMON), expanded)
        .otherwise(folded)
    )


def to_ascii(value: Column | str) -> Column:
    """Accent-free text with every remaining non-ASCII character removed."""
    return F.regexp_replace(strip_accents(value), _NON_ASCII, "")


def upper_ascii(value: Column | str) -> Column:
    return F.upper(to_ascii(value))


def normalise_signs(value: Column | str) -> Column:
    """Write single-character comparison signs in ASCII, so that folding keeps them."""
    text = F.translate(as_column(value), "＜＞", "<>")
    return F.replace(F.replace(text, F.lit("≤"), F.lit("<=")), F.lit("≥"), F.lit(">="))


def _underscored(text: Column) -> Column:
    return F.btrim(F.regexp_replace(text, "[^a-z0-9]+", "_"), F.lit("_"))


def operator_slug(value: Column | str) -> Column:
    """Slug in which comparison signs and % survive as words."""
    text = F.lower(to_ascii(value))
    for sign, word in ((">=", "gte"), ("<=", "lte"), ("<", "lt"), (">", "gt"), ("=", "eq"), ("%", "pct")):
        text = F.replace(text, F.lit(sign), F.lit(f" {word} "))
    return _underscored(text)


def label_slug(value: Column | str) -> Column:
    """Slug of a header label."""
    return _underscored(strip_accents(F.lower(as_column(value))))


def compact_slug(value: Column | str) -> Column:
    """Slug that deletes all but letters, digits, underscores and blanks, and joins words by underscores."""
    text = F.lower(F.regexp_replace(strip_accents(value), _NOT_COMPACT, ""))
    return F.btrim(F.regexp_replace(text, " +", "_"), F.lit("_"))


def clean_label(value: Column | str) -> Column:
    """Header text on one line, without surrounding blanks and dashes."""
    return F.btrim(F.translate(as_column(value), "\n", " "), F.lit(" -"))


def blank_to_null(value: Column | str) -> Column:
    return F.nullif(F.trim(as_column(value)), F.lit(""))


def zero_fill(value: Column | str, width: int) -> Column:
    """Left-pad with zeros; longer text is kept whole (lpad alone would cut it)."""
    text = as_column(value)
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def digits_only(value: Column | str) -> Column:
    return F.regexp_replace(as_column(value), "[^0-9]", "")


def padded_code(value: Column | str) -> Column:
    """Digits of a code: the first seven, or at least six by zero-filling; NULL counts as empty."""
    digits = digits_only(F.coalesce(as_column(value), F.lit("")))
    return zero_fill(F.left(digits, F.lit(7)), 6)


def padded_code_or_null(value: Column | str) -> Column:
    """As padded_code, but a value without digits gives NULL."""
    digits = F.nullif(digits_only(value), F.lit(""))
    return zero_fill(F.left(digits, F.lit(7)), 6)


def code_run(value: Column | str) -> Column:
    """The first run of six or seven digits, else NULL."""
    return F.nullif(F.regexp_extract(as_column(value), r"(\d{6,7})", 1), F.lit(""))


def repair_mojibake(value: Column | str) -> Column:
    """Undo UTF-8 read as Latin-1; text that does not re-decode is kept."""
    text = as_column(value)
    redecoded = F.try_validate_utf8(F.encode(text, "iso-8859-1").cast("string"))
    return F.when(
        text.rlike(r"^[\x00-\xFF]*$"), F.coalesce(redecoded, text)
    ).otherwise(text)


def diagnosis_code(value: Column | str) -> Column:
    """Trimmed upper-case code without dots; NULL becomes empty."""
    text = F.coalesce(as_column(value), F.lit(""))
    return F.replace(F.upper(F.trim(text)), F.lit("."), F.lit(""))


def starts_with_any(value: Column | str, prefixes: list[str]) -> Column:
    text = as_column(value)
    return reduce(or_, [text.startswith(p) for p in prefixes])


def contains_any(value: Column | str, tokens: list[str]) -> Column:
    text = as_column(value)
    return reduce(or_, [text.contains(t) for t in tokens])


def alias_or_self(value: Column | str, aliases: dict[str, str]) -> Column:
    """Look `value` up in a small fixed alias table; unknown values are kept."""
    text = as_column(value)
    table = F.create_map(*[F.lit(x) for pair in aliases.items() for x in pair])
    return F.coalesce(F.try_element_at(table, text), text)


def indicator_code(value: Column | str) -> Column:
    """Number as an indicator code: one decimal, a trailing zero decimal removed."""
    return F.regexp_replace(F.format_string("%.1f", as_column(value)), r"\.0$", "")
