"""Spelling variant grouping: a relational trie frontier over the words of a corpus.

Words meet in two tries, one of words and one of reversed words. A state is a word, how far it is read,
a node (a prefix that words share) and the edits made, none or one. Level by level all states are joined
with the edges that leave their nodes; the edges of a level are counted from the words that are still
there without an edit. Along an edge a state without an edit goes on if the next code point agrees, and
otherwise may spend its edit: the code point is replaced, or it is left out. A state with an edit goes
on only if the next code point agrees, and the one behind it follows somewhere. One-edit states that end
where a word ends are neighbours. Of a pair the longer word finds the other, or of equal ones that with
the lesser code point, and the pair is returned both ways.

Two words one edit apart agree up to the edit and behind it, so in one of the tries they part in the
second half of either. Words therefore enter at half their length, where nodes have few words, and no
level has all words at one node. A node with at most two words is not opened: its words are compared
directly. So the number of levels is the longest stretch, counted from the middle of words, that three
words share, and a word that is long alone costs no levels.

A word's form is its neighbour with the most occurrences, if it has at least ``RATIO`` times as many;
following forms to the last gives the root, by doubling: a chain has few steps, as numbers grow each time.

Defined cases: NULL and empty texts have no words; a NULL id counts as the empty text; rows that repeat
count each; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from filingloom.llm.common import LOWER, UPPER, broadcast_if_small
from filingloom.sinks.workspace import staged

#: A run of letters: Latin, with those of the Latin-1 range.
LETTERS = r"[A-Za-zÀ-ÿ]+"
SHORTEST, FEWEST, RATIO = 6, 5, 5
#: Nodes of so many words are not opened: the least and the greatest word of a node are known from counting.
LEAF = 2


def runs_of(text: Column) -> Column:
    """The runs of letters of a text, A-Z in lower case."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(LETTERS), F.lit(0))


def with_slips(word: Column, doc_id: Column, one_in: int) -> Column:
    """A word as it counts in a document: in one of ``one_in`` cases a code point is left out."""
    draw = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), word).cast("binary"))
    at = (draw % F.char_length(word)).cast("int")
    cut = F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.char_length(word)))
    return F.when(draw % one_in == 0, cut).otherwise(word)


def vocabulary(docs: DataFrame, one_in: int | None = None, shortest: int = SHORTEST, fewest: int = FEWEST) -> DataFrame:
    """(word, n): words of ``shortest`` code points or more that occur ``fewest`` times or more.

    ``one_in`` leaves out code points as :func:`with_slips` does.
    """
    words = docs.select("doc_id", F.explode(runs_of(F.col("text"))).alias("word"))
    words = words.filter(F.char_length("word") >= shortest)
    if one_in:
        words = words.select(with_slips(F.col("word"), F.col("doc_id"), one_in).alias("word"))
        words = words.filter(F.char_length("word") >= shortest)
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= fewest)


def _at(word: str, place: Column) -> Column:
    """The code point at a place counted from 0; empty behind the end."""
    return F.substring(F.col(word), place + 1, F.lit(1))


def _after(word: str, place: Column) -> Column:
    return F.substring(F.col(word), place + 1, F.char_length(word))


def one_edit(a: str, b: str) -> Column:
    """Whether two different words are one inserted, deleted or replaced code point apart; linear in their lengths."""
    alike = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: F.coalesce(x == y, F.lit(False)))
    parting = F.array_position(alike, False).cast("int") - 1
    here, behind = (lambda w: _after(w, parting)), (lambda w: _after(w, parting + 1))
    return (behind(a) == behind(b)) | (behind(a) == here(b)) | (here(a) == behind(b))


def _level(states: DataFrame, depth: int) -> tuple[DataFrame, DataFrame]:
    """Join all states at one depth with the edges there: (states one level deeper, pairs found)."""
    own = states.filter((F.col("edits") == 0) & (F.char_length("word") > depth))
    edges = own.groupBy("side", "node", _at("word", F.lit(depth)).alias("letter")).agg(
        F.count("*").alias("n"),
        F.min("word").alias("low"),
        F.max("word").alias("high"),
        F.collect_set(_at("word", F.lit(depth + 1))).alias("next"),  # no more than the letters there are
    )
    # At most one row per letter and node on the right, so no key is crowded there.
    met = states.join(edges.hint("shuffle_hash"), ["side", "node"])
    size, place, letter = F.char_length("word"), F.col("place"), F.col("letter")
    agrees = letter == _at("word", place)
    may_edit = (F.col("edits") == 0) & (place < size) & (F.lit(depth) >= F.floor(size / 2))

    def to(when: Column, place: Column, edits: Column) -> Column:
        return F.when(when, F.struct(place.cast("int").alias("place"), edits.cast("int").alias("edits")))

    moves = F.array(
        to(agrees, place + 1, F.col("edits")),
        to(may_edit & (letter > _at("word", place)), place + 1, F.lit(1)),  # another code point in its place
        to(may_edit & ~agrees & (letter == _at("word", place + 1)), place + 2, F.lit(1)),  # it is left out
    )
    moved = met.select(
        "side", "word", F.concat("node", "letter").alias("node"), "n", "low", "high", "next", F.explode(F.array_compact(moves)).alias("m")
    ).select("side", "word", "node", "n", "low", "high", "next", "m.place", "m.edits")
    edited, open_, ends = F.col("edits") == 1, F.col("n") > LEAF, F.col("low") == F.col("node")
    deeper = F.lit(depth + 1)
    rest = _after("word", F.col("place"))
    # Two words at a node, neither with an edit: the row of the lesser one compares them.
    first_of_two = ~edited & (F.col("n") == LEAF) & (F.col("word") == F.col("low"))
    near = F.array(
        F.when(edited & ~open_ & (_after("low", deeper) == rest), F.col("low")),
        F.when(edited & ~open_ & (F.col("low") != F.col("high")) & (_after("high", deeper) == rest), F.col("high")),
        F.when(edited & open_ & ends & (rest == ""), F.col("node")),
        F.when(~edited & open_ & ends & (size == depth + 2), F.col("node")),
        F.when(first_of_two, F.when(one_edit("low", "high"), F.col("high"))),
    )
    # Until all words of about its length have entered, a word alone at its node is still needed.
    early = ~edited & (F.lit(depth) < F.floor((size + 1) / 2))
    goes_on = F.when(edited, open_ & (rest != "") & F.array_contains("next", _at("word", F.col("place")))).otherwise(open_ | early)
    told = moved.select("side", "word", "place", "node", "edits", F.array_compact(near).alias("near"), goes_on.alias("goes_on"))
    # A written table, as size estimates of a checkpoint multiply from level to level.
    kept = staged(told.filter(F.col("goes_on") | (F.size("near") > 0)), "states")
    pairs = kept.filter(F.size("near") > 0).select("side", "word", F.explode("near").alias("near"))
    return kept.filter("goes_on").select("side", "word", "place", "node", "edits"), pairs


def neighbours(words: DataFrame) -> DataFrame:
    """(word, near): all pairs of different words one inserted, deleted or replaced code point apart.

    ``words`` has one row per word, and no empty one. Both directions are returned.
    """
    sides = [F.struct(F.lit(s).alias("side"), w.alias("word")) for s, w in enumerate((F.col("word"), F.reverse("word")))]
    both = words.select(F.explode(F.array(*sides)).alias("w"))
    size = F.char_length("word")
    entering = staged(both.select("w.side", "w.word").withColumn("depth", F.floor((size - 1) / 2).cast("int")), "entering")
    depths = sorted(r["depth"] for r in entering.select("depth").distinct().collect())
    states, found, depth = None, None, None
    while depths or states is not None:
        depth = depths[0] if states is None else depth + 1
        new = entering.filter(F.col("depth") == depth).select(
            "side", "word", F.lit(depth).alias("place"), F.substring("word", F.lit(1), F.lit(depth)).alias("node"), F.lit(0).alias("edits")
        )
        if depths and depths[0] == depth:
            depths.pop(0)
            states = new if states is None else states.unionByName(new)
        states, pairs = _level(states, depth)
        found = pairs if found is None else found.unionAll(pairs)
        if states.isEmpty():
            states = None
    if found is None:
        return words.select("word", F.col("word").alias("near")).filter(F.lit(False))
    one, other = (F.when(F.col("side") == 0, F.col(c)).otherwise(F.reverse(c)) for c in ("word", "near"))
    both_ways = F.array(*(F.struct(a.alias("word"), b.alias("near")) for a, b in ((one, other), (other, one))))
    return found.select(F.explode(both_ways).alias("p")).select("p.word", "p.near").distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): follow ``form`` from each word of (word, form) to the last; no chain may be a ring."""
    held = staged(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = held.select(F.col("word").alias("_word"), F.col("root").alias("_root"))
        met = held.join(further, held["root"] == further["_word"], "left")
        more = F.col("_root").isNotNull().alias("_more")
        moved = staged(met.select("word", F.coalesce("_root", "root").alias("root"), more), "roots")
        held = moved.drop("_more")
        if moved.filter("_more").isEmpty():
            return held


def grouped(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, n) with ``n_near``, ``form``, ``form_n`` and ``root``."""
    held = staged(words.select("word", "n"), "words")
    pairs = staged(neighbours(held.select("word")), "neighbours")
    counts = held.select(F.col("word").alias("near"), F.col("n").alias("_n"))
    best = F.min(F.struct((-F.col("_n")).alias("less"), "near")).alias("best")
    near = pairs.join(broadcast_if_small(counts, "near"), "near").groupBy("word").agg(F.count("*").alias("n_near"), best)
    told = staged(
        held.join(near, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(-F.col("best.less") >= ratio * F.col("n"), F.struct(F.col("best.near").alias("form"), (-F.col("best.less")).alias("n"))).alias("f"),
        ),
        "forms",
    )
    rooted = roots(told.filter("f is not null").select("word", "f.form"))
    return told.join(rooted, "word", "left").select(
        "word", "n", "n_near", F.col("f.form").alias("form"), F.col("f.n").alias("form_n"), F.coalesce("root", "word").alias("root")
    )
