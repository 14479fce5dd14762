"""Scalar text expressions: normalisation, dates, delimited lists, markers, token estimate."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from boardsmith.functions.util import as_col

# Python's str.isspace() set, so trimming and collapsing agree with the
# reference's re.sub(r"\s+") / str.strip() on any input.
WS_CLASS = r"[\t\n\x0B\f\r\x1C-\x1F \x85\u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]"

# Relative-date markers ("minutes ago", "hours ago") mapped to the as-of day.
RELATIVE_MARKERS = ("분전", "시간전")

# The "no comments" marker and the list separator written between items.
NONE_MARKER = "없음"
LIST_SEP = "; "


# The same set as plain characters, for ``trim(BOTH <set> FROM s)`` (no regex needed).
WS_CHARS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200B)) + "\u2028\u2029\u202f\u205f\u3000"


def py_strip(c) -> Column:
    """``str.strip()``: remove leading/trailing whitespace of the full Unicode set."""
    return F.trim(as_col(c), F.lit(WS_CHARS))


def normalize_text(c) -> Column:
    """H1: collapse whitespace, trim, delete ``<any char> ,``, ``..``->``.``, ``. .``->``.``, trim.

    Each replace is single-pass, left to right, like Python's ``str.replace`` and ``re.sub``
    (``a....b`` -> ``a..b``).
    """
    s = py_strip(F.regexp_replace(as_col(c), f"{WS_CLASS}+", " "))
    s = F.regexp_replace(s, ". ,", "")
    s = F.replace(s, F.lit(".."), F.lit("."))
    s = F.replace(s, F.lit(". ."), F.lit("."))
    s = F.replace(s, F.lit("\n"), F.lit(""))
    return py_strip(s)


def relative_date(c, asof) -> Column:
    """H2: a relative date ("5분전", "3시간전") becomes the as-of day ``yyyy-MM-dd``; others pass."""
    c = as_col(c)
    asof_day = F.date_format(as_col(asof) if not isinstance(asof, str) else F.lit(asof).cast("timestamp"), "yyyy-MM-dd")
    cond = None
    for m in RELATIVE_MARKERS:
        part = F.contains(c, F.lit(m))
        cond = part if cond is None else (cond | part)
    return F.when(cond, asof_day).otherwise(c)


def split_list(c, sep: str = ";") -> Column:
    """H3: split on ``sep``, trim each item, drop blanks; null in -> null out."""
    parts = F.split(as_col(c), _regex_literal(sep))
    return F.filter(F.transform(parts, lambda x: py_strip(x)), lambda x: x != F.lit(""))


def join_list(c, sep: str = LIST_SEP) -> Column:
    """H4: ``'; '.join(list)``; an empty list gives ``''``, null stays null."""
    return F.array_join(as_col(c), sep)


def strip_marker(c) -> Column:
    """H8: strip one leading list mark (``-``) or number (``12.``) and the spaces after it; other marks stay, as in the reference."""
    return F.regexp_replace(as_col(c), r"^\s*(?:-|[0-9]+[.])\s*", "")


def none_marker(c) -> Column:
    """Comments text -> array; ``''``, ``없음`` and null mean no comments (empty array)."""
    c = as_col(c)
    return F.when(c.isNull() | (py_strip(c) == "") | (py_strip(c) == NONE_MARKER), F.array().cast("array<string>")).otherwise(
        F.filter(split_list(c, ";"), lambda x: x != F.lit(NONE_MARKER))
    )


# Token-estimate pattern (letters run, up to three digits, or one other
# non-space character), standing in for a byte-pair tokenizer that is not available offline.
TOKEN_PATTERN = r"[A-Za-z]+|[0-9]{1,3}|[^\sA-Za-z0-9]"


def token_estimate(c) -> Column:
    """B11 helper: estimated token count of a text (an estimate, not the cl100k count)."""
    return F.regexp_count(F.coalesce(as_col(c), F.lit("")), F.lit(TOKEN_PATTERN)).cast("bigint")


def _regex_literal(sep: str) -> str:
    import re

    return re.escape(sep)
