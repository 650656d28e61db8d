import random

import pytest
from pyspark.sql import functions as F

from filingloom.operators.announcements import categorise
from filingloom.operators import rule_table
from filingloom.operators.rule_table import categorise_by_table, ordered_rules, trie_pattern
from filingloom.rules import CATEGORY_RULES, Rule

COLUMNS = "precedence long, category string, headline string, body string"


def table(spark, rules):
    return spark.createDataFrame([(i, *rule) for i, rule in enumerate(rules)], COLUMNS)


def test_trie_takes_the_longest(spark):
    words = ["a", "ab", "abcd", "abx", "b c", "c"]
    text = spark.range(1).select(F.lit("abc abcd xabx b c").alias("t"))
    found = text.select(F.regexp_extract_all("t", F.lit(f"(?=({trie_pattern(words)}))"), F.lit(1))).first()[0]
    assert found == ["ab", "c", "abcd", "c", "abx", "b c", "c"]


def test_same_as_a_chain_of_rules(spark):
    rng = random.Random(3)
    bits = ["a", "ab", "abc", "bc", "b c", "ca", "c", "x1", "aa"]
    rules = [Rule(f"r{i}", "|".join(rng.sample(bits, 2)) + rng.choice(("b", "", "b+", "$")), rng.choice((None, "ca|x1x", "A+x"))) for i in range(40)]
    rules.append(Rule("nothing"))
    rows = [(i, rng.choice((None, " r3 ", "other")), *("".join(rng.choices("abcx1 Aſ", k=rng.randrange(9))) for _ in "ab")) for i in range(300)]
    rows.append((300, None, None, None))
    df = spark.createDataFrame(rows, "id long, Descriptor string, HeadLine string, NewsBody string")
    for own in (rules, rules[::-1], CATEGORY_RULES, [Rule("only", body="c[a]")]):
        expected = categorise(df, own).collect()
        got = categorise_by_table(df, table(spark, own)).collect()
        assert sorted(map(str, got)) == sorted(map(str, expected))


def test_order_empty_tables_and_bound(spark, monkeypatch):
    rules = spark.createDataFrame([(2, "late", "a", None), (1, "z", "a", None), (1, "b", "a", None)], COLUMNS)
    assert [r.category for r in ordered_rules(rules)] == ["b", "z", "late"]
    df = spark.createDataFrame([("x a",), (None,)], "HeadLine string")
    got = [r["category"] for r in categorise_by_table(df, rules).collect()]
    assert got == ["b", "General"]
    assert {r["category"] for r in categorise_by_table(df, rules.limit(0)).collect()} == {"General"}
    assert categorise_by_table(df.limit(0), rules).count() == 0
    monkeypatch.setattr(rule_table, "MAX_RULES", 2)
    with pytest.raises(ValueError):
        ordered_rules(rules)
