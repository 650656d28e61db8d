"""Categories from a table of rules, for hundreds of them.

A chain of one search per rule costs every text as many searches as there are rules. Here all plain words
of the table are one pattern, folded into a trie, that is searched at every place of a text; it gives the
longest word there, and shorter words that begin alike are known from the table. Rules that are true
regular expressions share one search that says whether any of them can match; only texts where it does are
searched rule by rule.
"""

import re
import zlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from filingloom.functions.categories import folded, matches
from filingloom.functions.text import strip
from filingloom.operators.shape import optional
from filingloom.rules import DEFAULT_CATEGORY, Rule

# A rule table is configuration; a longer one is refused, for it becomes part of the plan.
MAX_RULES = 10_000
_NONE = 2**31 - 1


def trie_pattern(words: Sequence[str]) -> str:
    """A regular expression that matches the longest of some plain words at a place."""
    root: dict = {}
    for word in words:
        node = root
        for letter in word:
            node = node.setdefault(letter, {})
        node[""] = {}

    def build(node: dict) -> str:
        run = ""
        while len(node) == 1 and "" not in node:
            (letter, node), = node.items()
            run += letter
        branches = [letter + build(after) for letter, after in sorted(node.items()) if letter]
        if not branches:
            return run
        return f"{run}(?:{'|'.join(branches)}){'?' if '' in node else ''}"

    return build(root)


def ordered_rules(table: DataFrame) -> list[Rule]:
    """Rules of a table (precedence, category, headline, body), least precedence first.

    Equal precedences go by category, headline and body. A table of more than ``MAX_RULES`` is refused.
    """
    order = ["precedence", "category", "headline", "body"]
    rows = table.select(*order).orderBy(*order).limit(MAX_RULES + 1).collect()
    if len(rows) > MAX_RULES:
        raise ValueError(f"a rule table has at most {MAX_RULES} rules")
    return [Rule(r["category"], r["headline"], r["body"]) for r in rows]


def _plain_words(pattern: str) -> list[str] | None:
    """The words of a pattern that is nothing but words between bars."""
    words = pattern.split("|")
    return words if all(re.fullmatch("[a-z0-9 ]+", word) for word in words) else None


def _rank_of(words: dict[str, int]) -> Column:
    """Function from a found word to the least rank among it and the words it begins with.

    The map is cut into small ones by a checksum of the word, as looking up a map is a linear search.
    """
    size = len(words) // 4 + 1
    maps: list[dict[str, int]] = [{"": _NONE} for _ in range(size)]
    for word in words:
        heads = (word[:n] for n in range(1, len(word) + 1))
        best = min(words[head] for head in heads if head in words)
        maps[zlib.crc32(word.encode()) % size][word] = best
    table = F.array(*[F.create_map(*[F.lit(x) for pair in own.items() for x in pair]) for own in maps])
    return lambda word: F.element_at(F.get(table, (F.crc32(word.cast("binary")) % size).cast("int")), word)


def first_rank(text: Column, patterns: Sequence[str | None]) -> Column:
    """Index of the first pattern found in folded text; a number beyond all where there is none."""
    words: dict[str, int] = {}
    others: list[tuple[int, str]] = []
    for rank, pattern in enumerate(patterns):
        if not pattern:
            continue
        plain = _plain_words(pattern)
        if plain is None:
            others.append((rank, pattern))
        for word in plain or ():
            words.setdefault(word, rank)
    none = F.lit(_NONE)
    ranks = [none, none]
    if words:
        found = F.array_distinct(F.regexp_extract_all(text, F.lit(f"(?=({trie_pattern(list(words))}))"), F.lit(1)))
        ranks.append(F.coalesce(F.array_min(F.transform(found, _rank_of(words))), none))
    if others:
        chain = F.when(~matches(text, "|".join(f"(?:{p})" for _, p in others)), none)
        for rank, pattern in others:
            chain = chain.when(matches(text, pattern), F.lit(rank))
        ranks.append(chain.otherwise(none))
    return F.least(*ranks)


def categorise_by_table(
    df: DataFrame,
    rules: DataFrame,
    descriptor: str = "Descriptor",
    headline: str = "HeadLine",
    body: str = "NewsBody",
    default: str = DEFAULT_CATEGORY,
    into: str = "category",
) -> DataFrame:
    """``categorise`` with the rules of a table: precedence, category, headline, body.

    The descriptor wins if it names a category exactly, then the rule of least precedence that is found in
    the headline or the body, then the default. NULL patterns and NULL texts match nothing; an empty table
    leaves descriptors out and gives the default everywhere.
    """
    own = ordered_rules(rules)
    if not own:
        return df.withColumn(into, F.lit(default))
    texts = {"_headline": headline, "_body": body}
    folds = df.withColumns({name: folded(optional(df, text)) for name, text in texts.items()})
    rank = F.least(
        first_rank(F.col("_headline"), [rule.headline for rule in own]),
        first_rank(F.col("_body"), [rule.body for rule in own]),
    )
    known = strip(optional(df, descriptor))
    names = F.array(*[F.lit(rule.category) for rule in own])
    found = F.when(known.isin(sorted({rule.category for rule in own})), known).otherwise(
        F.coalesce(F.get(names, F.col("_rank")), F.lit(default))
    )
    return folds.withColumn("_rank", rank).withColumn(into, found).drop(*texts, "_rank")
