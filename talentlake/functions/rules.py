"""Ordered rule lists compiled into one CASE WHEN column expression."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from talentlake.functions.text import contains_any, java_regex, python_regex_ok


def leading_literals(pattern: str) -> list[str] | None:
    """The letters that each top-level alternative of a pattern begins with, which every
    match of it contains; None where an alternative begins otherwise."""
    parts, depth = [""], 0
    for c in pattern:
        depth += (c in "([") - (c in ")]")
        if c == "|" and not depth:
            parts.append("")
        else:
            parts[-1] += c
    out = []
    for part in parts:
        literal = re.match(r"[^\W\d_]*", part)[0]
        if part[len(literal):len(literal) + 1] in ("?", "*", "{"):   # the last letter may be missing
            literal = literal[:-1]
        if not literal:
            return None
        out.append(literal)
    return out


@dataclass(frozen=True)
class RuleSet:
    """``(python_regex, label)`` rules applied to a text column.

    policy="first": the first matching rule decides (``for ...: return``).
    policy="last":  every rule is applied and overwrites, so the last
                    matching rule decides; compiled as a CASE in reverse order.
    """

    rules: Sequence[tuple[str, str]]
    policy: str = "first"
    default: str | None = None
    ignore_case: bool = False

    def __post_init__(self):
        if self.policy not in ("first", "last"):
            raise ValueError(f"policy must be 'first' or 'last', got {self.policy!r}")
        for pattern, _ in self.rules:
            python_regex_ok(pattern)

    def ordered(self) -> list[tuple[str, str]]:
        return list(self.rules) if self.policy == "first" else list(reversed(self.rules))

    def label(self, text: Column) -> Column:
        """Label of the deciding rule, or ``default`` when none matches."""
        ordered = self.ordered()
        if not ordered:
            return F.lit(self.default)
        expr = None
        for pattern, label in ordered:
            cond = self.test(text, pattern)
            expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
        return expr.otherwise(F.lit(self.default))

    def matched(self, text: Column) -> Column:
        """True when any rule matches."""
        cond = F.lit(False)
        for pattern, _ in self.rules:
            cond = cond | self.test(text, pattern)
        return cond

    def test(self, text: Column, pattern: str) -> Column:
        """The pattern's regex, run only where a byte-level test finds one of the
        literals that its matches begin with (case-blind rules have no such test)."""
        found = text.rlike(java_regex(pattern, self.ignore_case))
        literals = None if self.ignore_case else leading_literals(pattern)
        return contains_any(text, literals) & found if literals else found
