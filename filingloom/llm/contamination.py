"""Benchmark decontamination with a positional inverted index of the training words.

The index stores the postings (word, document, place) of every training word that some benchmark window
has, so it also tells how often each of them occurs. Windows are looked up from their rarest word on: its
posting list gives candidates, places where the window may lie. The lists of the second and the third
rarest word are intersected with them, adjusted by the offsets between the words, and what is left with
the lists of all other words. A list is met at its offset for an exact phrase and within ``distance``
places of the rarest word, in any order, for a proximity match; a phrase is always a proximity match, so
one pass from list to list finds both.

Everything is DataFrame expressions. The text is read twice (postings, document lengths). Lists are met by
document, word and block of places, so a word that fills a long document meets few candidates at a time.
Rare lists are short, and candidates are few when the long lists come: then the documents and blocks that
still matter are sent to the long lists, if they are measured to be few enough, so that the lists stay where
they are. Compared is the exact form of a word, which lowers A-Z alone.

Defined cases: NULL text and NULL items have no words; an item with fewer words than a window is one
window, an item without words none; rows that repeat an id or a whole row are answered each, from their
own text; items that repeat an id count as one item; an empty table on either side gives no hits; other
columns pass through.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from filingloom.llm.common import BROADCAST_BYTES, LOWER, UPPER, broadcast_if_small
from filingloom.sinks.workspace import checkpointed, scratch

WIDTH = 13
#: Words are ASCII letters and digits and everything beyond ASCII; this is what lies between them.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WITHIN = BETWEEN.replace("[", "[^", 1)
#: A document is contaminated if at least one word in this many is hit.
ONE_IN = 20
KEY = ("doc_id", "_text_hash")


def raw_words(text: Column) -> Column:
    """Words of a text in order, in their own case; an empty string may stand first and last."""
    return F.split(F.coalesce(text, F.lit("")), BETWEEN)


def count_words(text: Column) -> Column:
    """How many words a text has: each becomes one letter, and what lies between them goes."""
    marks = F.regexp_replace(F.coalesce(text, F.lit("")), WITHIN, "a")
    return F.char_length(F.regexp_replace(marks, BETWEEN, "")).cast("long")


def lowered(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def exact(word: Column) -> Column:
    """A word with A-Z lowered; a word of ASCII alone takes the faster way."""
    return F.when(F.octet_length(word) == F.char_length(word), F.lower(word)).otherwise(lowered(word))


def windows(items: DataFrame, width: int = WIDTH) -> DataFrame:
    """(item_id, start, words): every run of ``width`` words of an item, or all of a shorter one."""
    found = F.filter(raw_words(lowered(F.col("text"))), lambda w: w != "")
    words = items.select("item_id", found.alias("w")).filter(F.size("w") > 0)
    last = F.greatest(F.size("w") - width, F.lit(0))
    starts = words.select("item_id", "w", F.explode(F.sequence(F.lit(0), last)).alias("start"))
    return starts.select("item_id", "start", F.slice("w", F.col("start") + 1, F.lit(width)).alias("words"))


def _documents(docs: DataFrame) -> DataFrame:
    """Rows under a key of their own: the id and a hash of the text; equal rows share it."""
    return docs.select("doc_id", F.xxhash64("text").alias("_text_hash"), "text")


def numbered(wins: DataFrame) -> DataFrame:
    """(win, words, items): each different window once, with the ids, as text, of the items that have it."""
    ids = F.collect_set(F.coalesce(F.col("item_id").cast("string"), F.lit("")))
    once = wins.groupBy("words").agg(ids.alias("items"))
    return checkpointed(once.select(F.monotonically_increasing_id().alias("win"), "words", "items"))


def postings(docs: DataFrame, words: DataFrame) -> DataFrame:
    """The index: (word, doc_id, _text_hash, place) for every occurrence of one of ``words`` (one row each)."""
    spread = _documents(docs).select(*KEY, F.posexplode(raw_words(F.col("text"))).alias("place", "raw"))
    own = spread.select(exact(F.col("raw")).alias("word"), *KEY, "place")
    return own.join(broadcast_if_small(words, "word"), "word")


def ranked(wins: DataFrame, index: DataFrame) -> DataFrame:
    """(win, word, offset, rank, first, n): the words of each window, ``rank`` 0 the rarest of the training words.

    ``first`` is the offset of that rarest word, ``n`` the words of the window. Windows with a word that
    never occurs are left out.
    """
    counts = checkpointed(index.groupBy("word").agg(F.count("*").alias("_n")))
    placed = wins.select("win", F.size("words").alias("n"), F.posexplode("words").alias("offset", "word"))
    rated = placed.join(counts, "word").groupBy("win", "n").agg(
        F.sort_array(F.collect_list(F.struct("_n", "offset", "word"))).alias("order")
    )
    whole = rated.filter(F.size("order") == F.col("n")).withColumn("first", F.col("order")[0]["offset"])
    spread = whole.select("win", "n", "first", F.posexplode("order").alias("rank", "own"))
    return checkpointed(spread.select("win", "own.word", "own.offset", "rank", "first", "n"))


def _renamed(df: DataFrame, mark: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{mark}{c}") for c in df.columns])


def _same(names: tuple[str, ...], mark: str) -> Column:
    """Equal, NULL ids included, in columns of two sides, one of them renamed."""
    return reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"{mark}{c}")) for c in names])


def _met(cands: DataFrame, index: DataFrame, terms: DataFrame, reach: int, distance: int) -> DataFrame:
    """Candidates whose window's ``terms`` all lie within reach, in any order.

    ``phrase`` stays true if each is at its offset, ``close`` if each is within ``distance``. Windows
    without a row in ``terms`` keep their candidates.
    """
    size = reach + 1
    through = cands.join(broadcast_if_small(terms.select("win").distinct()), "win", "left_anti")
    asked = cands.join(broadcast_if_small(terms.select("win").distinct()), "win", "left_semi")
    blocks = F.explode(F.sequence(F.floor((F.col("at") - reach) / size), F.floor((F.col("at") + reach) / size)))
    asked = asked.withColumn("block", blocks)
    words = terms.select("word").distinct()
    lists = index.join(broadcast_if_small(words, "word"), "word", "left_semi")
    lists = lists.select("word", *KEY, "place", F.floor(F.col("place") / size).alias("block"))
    spots = checkpointed(asked.select(*KEY, "block").distinct())
    if spots.count() * 16 * len(spots.columns) <= BROADCAST_BYTES:
        lists = lists.join(F.broadcast(_renamed(spots, "of_")), _same((*KEY, "block"), "of_"), "left_semi")
    gap = F.col("in_place") - F.col("at")
    here = asked.join(_renamed(lists, "in_"), _same((*KEY, "block"), "in_") & (F.abs(gap) <= reach))
    shifts = terms.select("win", "word", (F.col("offset") - F.col("first")).alias("shift"))
    pairs = here.withColumnRenamed("in_word", "word").join(broadcast_if_small(shifts, "word"), ["win", "word"])
    met = pairs.groupBy("win", *KEY, "at", "phrase", "close").agg(
        F.collect_set("word").alias("_words"),
        F.collect_set(F.when(F.abs(gap) <= distance, F.col("word"))).alias("_close"),
        F.collect_set(F.when(gap == F.col("shift"), F.col("shift"))).alias("_shifts"),
    )
    needs = terms.groupBy("win").agg(F.count_distinct("word").alias("_n_words"), F.count("*").alias("_n_shifts"))
    kept = met.join(broadcast_if_small(needs), "win").filter(F.size("_words") == F.col("_n_words"))
    told = kept.select(
        "win",
        *KEY,
        "at",
        (F.col("phrase") & (F.size("_shifts") == F.col("_n_shifts"))).alias("phrase"),
        (F.col("close") & (F.size("_close") == F.col("_n_words"))).alias("close"),
    )
    return checkpointed(through.unionByName(told).filter("phrase or close"))


def matches(index: DataFrame, terms: DataFrame, width: int = WIDTH, distance: int = WIDTH - 1) -> DataFrame:
    """(win, doc_id, _text_hash, at, phrase, close, place, n): where windows occur.

    ``at`` is a place of the window's rarest word. ``phrase``: the window stands there word by word, from
    ``place`` on; ``close``: each of its words is at most ``distance`` places from ``at``. ``terms`` are
    those of :func:`ranked`.
    """
    reach = max(distance, width - 1)
    rarest = broadcast_if_small(terms.filter("rank = 0").select("win", "word"), "word")
    found = index.join(rarest, "word").select("win", *KEY, F.col("place").alias("at")).distinct()
    cands = checkpointed(found.withColumns({"phrase": F.lit(True), "close": F.lit(True)}))
    for ranks in ("rank = 1", "rank = 2", "rank > 2"):
        cands = _met(cands, index, terms.filter(ranks), reach, distance)
    own = broadcast_if_small(terms.filter("rank = 0").select("win", "first", "n"))
    return cands.join(own, "win").withColumn("place", F.col("at") - F.col("first")).drop("first")


def _covered(found: DataFrame, wins: DataFrame) -> DataFrame:
    """Per document: words inside any phrase, the items with one, and how many items have a proximity match.

    Phrases of a document are ordered by place; each adds the words past the furthest end so far.
    """
    whole = found.filter("phrase")
    places = whole.groupBy(*KEY, "place").agg(F.max(F.col("place") + F.col("n")).alias("end"))
    order = Window.partitionBy(*KEY).orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.coalesce(F.max("end").over(order), F.lit(0))
    fresh = F.greatest(F.col("end") - F.greatest(F.col("place"), reached), F.lit(0))
    hit = places.withColumn("fresh", fresh).groupBy(*KEY).agg(F.sum("fresh").alias("n_hit"))
    met = found.groupBy(*KEY, "win").agg(F.bool_or("phrase").alias("phrase"), F.bool_or("close").alias("close"))
    named = met.join(broadcast_if_small(wins.select("win", "items")), "win")
    ids = named.select(*KEY, "phrase", "close", F.explode("items").alias("item"))
    each = ids.groupBy(*KEY, "item").agg(F.bool_or("phrase").alias("phrase"), F.bool_or("close").alias("close"))
    items = each.groupBy(F.col("doc_id").alias("_id"), F.col("_text_hash").alias("_hash")).agg(
        F.sort_array(F.collect_list(F.when(F.col("phrase"), F.col("item")))).alias("items"),
        F.count_if("close").alias("n_near"),
    )
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_text_hash") == F.col("_hash"))
    return items.join(hit, same, "left").select(F.col("_id"), F.col("_hash"), "n_hit", "items", "n_near")


def contaminated(docs: DataFrame, items: DataFrame, width: int = WIDTH, distance: int = WIDTH - 1) -> DataFrame:
    """Every row without its text, with n_words, n_hit, items, n_near and ``contaminated``.

    ``items`` lists the ids, as text and in order, of the items with an occurring window; ``n_near`` counts
    the items of which some window has all its words within ``distance`` places of its rarest one.
    """
    wins = numbered(windows(items, width))
    words = checkpointed(wins.select(F.explode("words").alias("word")).distinct())
    with scratch(postings(docs, words), "postings") as index:
        hits = checkpointed(_covered(matches(index, ranked(wins, index), width, distance), wins))
    own = ["n_words", "n_hit", "items", "n_near", "contaminated"]
    kept = [c for c in docs.columns if c not in own and c != "text"]
    rows = docs.select(*kept, F.xxhash64("text").alias("_text_hash"), count_words(F.col("text")).alias("n_words"))
    marks = broadcast_if_small(hits, "items")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_text_hash") == F.col("_hash"))
    found = rows.join(marks, same, "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return found.select(
        *kept,
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        ((n_hit > 0) & (ONE_IN * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def clean(docs: DataFrame, items: DataFrame, width: int = WIDTH) -> DataFrame:
    """The rows of ``docs`` that are not contaminated."""
    keyed = docs.select("doc_id", "text")
    marks = contaminated(keyed.withColumn("_h", F.xxhash64("text")), items, width).filter("contaminated")
    gone = broadcast_if_small(checkpointed(marks.select(F.col("doc_id").alias("_gone_id"), "_h").distinct()))
    same = F.col("doc_id").eqNullSafe(F.col("_gone_id")) & (F.xxhash64("text") == F.col("_h"))
    return docs.join(gone, same, "left_anti")
