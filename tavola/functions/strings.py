"""Text clean-up expressions (all JVM-side, no Python UDF).

Every function takes and returns a ``Column``; null in gives null out unless
stated otherwise.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tavola.functions.util import as_col

DASH = " - "


def split_first(c, sep: str = DASH) -> tuple[Column, Column]:
    """STR-01: split into exactly two parts on the first ``sep``.

    A value without the separator gives (value, null).
    """
    parts = F.split(as_col(c), re.escape(sep), 2)
    return F.get(parts, 0), F.get(parts, 1)


def split_parts(c, n: int, sep: str = DASH) -> list[Column]:
    """STR-02: split on every ``sep`` and take the first ``n`` pieces."""
    parts = F.split(as_col(c), re.escape(sep))
    return [F.get(parts, i) for i in range(n)]


def last_part(c, sep: str = DASH) -> Column:
    """STR-03: the piece after the last ``sep`` (the whole text if none)."""
    return F.element_at(F.split(as_col(c), re.escape(sep)), -1)


def split_last(c, sep: str = DASH) -> tuple[Column, Column]:
    """STR-04: split on the *last* ``sep``; no separator gives (text, null)."""
    c = as_col(c)
    pat = "^(.*)" + re.escape(sep) + "(.*)$"
    has = c.contains(sep)
    return (F.when(has, F.regexp_extract(c, pat, 1)).otherwise(c),
            F.when(has, F.regexp_extract(c, pat, 2)))


def collapse_two_dashes(c) -> Column:
    """STR-05 part: replace everything up to and including the second " -"
    with "-" (``'A - B - C'`` becomes ``'- C'``); other values are unchanged."""
    return F.regexp_replace(as_col(c), r"^(?:.*?( -)){2}", "-")


def replace_literals(c, fixes: dict[str, str]) -> Column:
    """STR-05 part: literal substring replacements, applied in order."""
    out = as_col(c)
    for old, new in fixes.items():
        out = F.replace(out, F.lit(old), F.lit(new))
    return out


def fold_accents(c) -> Column:
    """STR-05 part: strip diacritics (É -> E) with a translate table."""
    src = "ÀÁÂÃÄÅàáâãäåÈÉÊËèéêëÌÍÎÏìíîïÒÓÔÕÖòóôõöÙÚÛÜùúûüÑñÇç"
    dst = "AAAAAAaaaaaaEEEEeeeeIIIIiiiiOOOOOoooooUUUUuuuuNnCc"
    return F.translate(as_col(c), src, dst)


def strip_prefix_words(c, words: Iterable[str]) -> Column:
    """STR-06: remove a leading ``word - `` for any of ``words``, then trim."""
    alt = "|".join(re.escape(w) for w in words)
    return F.trim(F.regexp_replace(as_col(c), rf"^(?:{alt})\s*-\s*", ""))


def strip_modifiers(c, leading: Iterable[str], trailing: Iterable[str]) -> Column:
    """STR-07: drop one leading modifier word (followed by blanks) and one
    trailing modifier word (preceded by blanks)."""
    pre = "|".join(re.escape(w) for w in leading)
    post = "|".join(re.escape(w) for w in trailing)
    out = F.regexp_replace(as_col(c), rf"^({pre})\s+", "")
    return F.regexp_replace(out, rf"\s+({post})$", "")


def extract_int(c) -> Column:
    """STR-08: first run of digits as an integer (``'Period 01'`` -> 1)."""
    digits = F.regexp_extract(as_col(c), r"(\d+)", 1)
    return F.when(digits != "", digits.try_cast("int"))


def parse_money(c) -> Column:
    """STR-09/10: ``'(1,234.50)'`` -> -1234.5; commas dropped, parentheses
    mean negative; text that is not a number gives null."""
    s = F.trim(as_col(c).cast("string"))
    s = F.regexp_replace(s, ",", "")
    s = F.regexp_replace(s, r"^\((.*)\)$", "-$1")
    s = F.regexp_replace(s, r"\$", "")
    return s.try_cast("double")


def strip(c) -> Column:
    """STR-11: trim every whitespace character (tabs too), not only blanks."""
    return F.regexp_replace(as_col(c), r"^\s+|\s+$", "")


def title_case(c) -> Column:
    """STR-12: capitalise the first letter after any non-letter, like Python's
    ``str.title`` (``'add-on'`` -> ``'Add-On'``); ``initcap`` only looks at
    blanks."""
    pieces = F.split(F.lower(as_col(c)), "(?<=[^a-z])")
    return F.array_join(F.transform(pieces, lambda x: F.initcap(x)), "")


def path_join(sep: str, *cols) -> Column:
    """STR-13: ``concat_ws`` that skips nulls (``'A > B'``)."""
    return F.concat_ws(sep, *[as_col(c) for c in cols])


def default_text(c, value: str) -> Column:
    """STR-15: null (or missing) text replaced with a default."""
    return F.coalesce(as_col(c), F.lit(value))


def any_pattern(c, patterns: Iterable[str]) -> Column:
    """True when any regex matches; null input gives null."""
    combined = "|".join(f"(?:{p})" for p in patterns)
    return as_col(c).rlike(combined)


def is_paren_negative(c) -> Column:
    """FLT-10 predicate: a value written as ``(x)`` (a return)."""
    return as_col(c).rlike(r"^\((.+)\)")
