"""Text helpers as Spark column expressions (JVM-side, codegen'd, no UDFs)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Word characters in the Python ``re`` sense (Unicode letters, digits, underscore).
WORD_CHAR = r"[\p{L}\p{N}_]"

_REGEX_SPECIAL = set(".^$*+?()[]{}|\\-/")


def java_regex(py_pattern: str, ignore_case: bool = False) -> str:
    """Python ``re`` pattern -> Java pattern with Python's Unicode classes.

    ``(?U)`` (UNICODE_CHARACTER_CLASS) makes ``\\s \\w \\d \\b`` Unicode-aware in
    Java, as they are in Python 3; ``(?i)`` together with it folds Unicode case.
    """
    flags = "iU" if ignore_case else "U"
    return f"(?{flags}){py_pattern}"


def escape_literal(text: str) -> str:
    """Backslash-escape regex metacharacters (portable across Java and RE2)."""
    return "".join("\\" + c if c in _REGEX_SPECIAL else c for c in text)


def whole_word_any(aliases: list[str]) -> str:
    """Java pattern: any alias, bounded by non-word characters on both sides.

    Equivalent to Python ``\\b<alias>\\b`` for aliases that start and end
    with word characters, with the boundary spelled out so that it does not
    depend on the JDK's ``\\b`` definition.
    """
    alts = "|".join(escape_literal(a) for a in aliases)
    return f"(?<!{WORD_CHAR})(?:{alts})(?!{WORD_CHAR})"


def py_strip(col: Column) -> Column:
    """Python ``str.strip()``: drop Unicode whitespace at both ends."""
    return F.regexp_replace(col, r"(?U)^\s+|\s+$", "")


def py_title(col: Column) -> Column:
    """Python ``str.title()`` for letter runs: upper first letter of every run
    of letters, lower the rest (``sidi-slimane`` -> ``Sidi-Slimane``)."""
    runs = F.regexp_extract_all(col, F.lit(r"\p{L}+|[^\p{L}]+"), F.lit(0))
    titled = F.transform(
        runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.lower(F.substring(r, 2, 2147483647)))
    )
    return F.array_join(titled, "")


def contains_any(col: Column, needles: list[str]) -> Column:
    """OR of plain substring tests (``any(x in s for x in needles)``)."""
    cond = F.lit(False)
    for n in needles:
        cond = cond | F.contains(col, F.lit(n))
    return cond


def ilike_any(col: Column, needles: list[str]) -> Column:
    """Case-blind substring test over several needles (SQL ``ILIKE '%x%'`` ORed)."""
    cond = F.lit(False)
    for n in needles:
        cond = cond | col.ilike("%" + n.replace("%", r"\%").replace("_", r"\_") + "%")
    return cond


def round_half_up(col: Column, digits: int = 0) -> Column:
    """Round a double half-up to ``digits`` decimals, as a double.

    Written as ``floor(x * 10^d + 0.5) / 10^d`` so that the result is
    bit-identical across engines (engines disagree on ROUND for doubles).
    """
    scale = float(10 ** digits)
    return F.floor(col.cast("double") * scale + F.lit(0.5)) / F.lit(scale)


def python_regex_ok(pattern: str) -> str:
    """Validate a Python pattern early (fail at plan-build time, not in tasks)."""
    re.compile(pattern)
    return pattern


def truncate_text(col: Column, width: int = 50, mark: str = "...") -> Column:
    """Text longer than ``width`` characters -> first ``width`` + ``mark``."""
    return F.when(F.length(col) > width, F.concat(F.substring(col, 1, width), F.lit(mark))).otherwise(col)


def signed_thousands(col: Column) -> Column:
    """Signed number with thousands separators and no decimals (``+1,500`` /
    ``-250``); NULL stays NULL."""
    rounded = F.floor(col.cast("double") + F.lit(0.5))
    text = F.format_number(F.abs(rounded), 0)
    return F.when(col.isNull(), F.lit(None)).when(rounded >= 0, F.concat(F.lit("+"), text)) \
        .otherwise(F.concat(F.lit("-"), text))


def percent_text(part: Column, whole: Column) -> Column:
    """``round(part * 100 / whole)`` as ``"NN%"``; ``N/A`` when ``whole`` is 0."""
    pct = F.floor(part.cast("double") * F.lit(100.0) / whole.cast("double") + F.lit(0.5)).cast("bigint")
    return F.when(whole > 0, F.concat(pct.cast("string"), F.lit("%"))).otherwise(F.lit("N/A"))


def chart_label(col: Column, replacements=(("Développeur ", "Dev. "), ("Chef de Projet IT", "Chef Proj. IT"))) -> Column:
    """Short chart label: literal replacements applied in order."""
    out = col
    for old, new in replacements:
        out = F.replace(out, F.lit(old), F.lit(new))
    return out


def family_label(col: Column) -> Column:
    """``data_engineering`` -> ``Data Engineering``."""
    return F.initcap(F.replace(col, F.lit("_"), F.lit(" ")))
