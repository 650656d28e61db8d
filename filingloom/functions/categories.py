"""Rule-based categories."""

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

from filingloom.functions.text import strip
from filingloom.rules import CATEGORY_RULES, DEFAULT_CATEGORY, REPORT_CODES, Rule


def folded(text: Column) -> Column:
    """Text as rules see it: lower-cased, with the long s as an s."""
    return F.replace(F.lower(text), F.lit("\u017f"), F.lit("s"))


def matches(text: Column, pattern: str) -> Column:
    """Case-insensitive search in folded text; NULL text matches nothing.

    Plain words are looked up without regular expressions. A lower-case ASCII pattern needs no
    case-insensitive matching in folded text.
    """
    words = pattern.split("|")
    if all(re.fullmatch("[a-z0-9 ]+", word) for word in words):
        found = reduce(Column.__or__, [text.contains(word) for word in words])
    elif pattern.isascii() and pattern == pattern.lower():
        found = text.rlike(pattern)
    else:
        found = text.rlike(f"(?iu){pattern}")
    return F.coalesce(found, F.lit(False))


def category(
    descriptor: Column,
    headline: Column,
    body: Column,
    rules: Sequence[Rule] = CATEGORY_RULES,
    default: str = DEFAULT_CATEGORY,
) -> Column:
    """The descriptor if it names a category exactly, else the first rule that matches.

    ``headline`` and ``body`` are folded texts.
    """
    known = strip(descriptor)
    chain = F.when(known.isin([rule.category for rule in rules]), known)
    for rule in rules:
        tests = [
            matches(text, pattern)
            for text, pattern in ((headline, rule.headline), (body, rule.body))
            if pattern
        ]
        if tests:
            hit = tests[0] if len(tests) == 1 else tests[0] | tests[1]
            chain = chain.when(hit, F.lit(rule.category))
    return chain.otherwise(F.lit(default))


def report_code(category: Column, codes: dict[str, str] = REPORT_CODES) -> Column:
    """Short code of a report category, NULL for any other."""
    chain = F.lit(None).cast("string")
    for name, code in codes.items():
        chain = F.when(category == name, F.lit(code)).otherwise(chain)
    return chain
