"""SimHash near-duplicates: fingerprints, bit-sliced comparison within shared bands, components.

Equal fingerprints are one node. Two fingerprints that differ in at most two of 64 bits agree on at
least two of four 16-bit bands, so all nodes that share a pair of bands meet in one group and nothing
else needs comparing. In a group, bit planes hold one bit of 64 fingerprints per machine word; a
carry-save counter adds up, plane by plane, in how many bits each of them differs from a query, and a
block is abandoned when all its fingerprints are beyond the radius. A group gives its inner components
as stars, never its pairs; groups beyond ``GROUP`` nodes are cut into chunks that meet two by two.

Defined cases: NULL text has no words; a text without words has fingerprint zero and is linked like any
other; fewer words than a shingle make one shingle; rows with a NULL id take part, and a component
whose ids are all NULL has a NULL id; rows that repeat are one component; an empty table gives no rows;
other columns pass through.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from filingloom.llm.common import broadcast_if_small
from filingloom.sinks.workspace import checkpointed

SHINGLE = 3
RADIUS = 2
BANDS = 4
HASH_SEED = 42
#: Nodes that one task compares with each other at once.
GROUP = 4096
#: Queries times machine words compared at once.
PAIRS = 1 << 15
#: Nodes of groups of up to 64 compared at once.
SMALL = 1 << 14
#: Shingles voted on at once.
SLICE = 1 << 15
_ONES = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: str | None, width: int = SHINGLE) -> int:
    """Majority of the XXH64 bits of all shingles, as an unsigned number."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line, digest = b" ".join(words), xxhash.xxh64_intdigest
    n = max(1, len(words) - width + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words))) + np.arange(len(words))
    starts = [0, *(ends[: n - 1] + 1).tolist()]
    stops = ends[-n:].tolist()
    votes = np.zeros(64, np.int64)
    for at in range(0, n, SLICE):
        part = zip(starts[at : at + SLICE], stops[at : at + SLICE])
        hashes = np.fromiter((digest(line[a:b], HASH_SEED) for a, b in part), np.uint64)
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    chosen = np.packbits(votes * 2 > n, bitorder="little")
    return int(chosen.view("<u8")[0])


def with_fingerprint(docs: DataFrame, column: str = "fingerprint", width: int = SHINGLE) -> DataFrame:
    """Add the fingerprint as a signed 64-bit number with the same bits."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            found = np.fromiter((fingerprint(t, width) for t in texts), np.uint64, len(texts))
            yield pd.Series(found.view(np.int64), index=texts.index)

    return docs.withColumn(column, F.pandas_udf(run, "long")("text"))


def _bits(prints: np.ndarray) -> np.ndarray:
    """A row of bits per fingerprint, each one or several machine words."""
    rows = prints.reshape(len(prints), -1).astype("<u8")
    return np.unpackbits(rows.view(np.uint8), axis=1, bitorder="little")


def bit_planes(prints: np.ndarray) -> np.ndarray:
    """One row per bit; each machine word holds that bit of 64 fingerprints."""
    padded = np.zeros((-(-len(prints) // 64) * 64, *prints.shape[1:]), np.uint64)
    padded[: len(prints)] = prints
    return np.packbits(_bits(padded).T.copy(), axis=1, bitorder="little").view("<u8")


def near_bits(planes: np.ndarray, word: np.ndarray, queries: np.ndarray, query: np.ndarray, radius: int) -> np.ndarray:
    """For each pair of a machine word and a query: a bit for each of the word's 64 fingerprints.

    A bit is set if the fingerprint differs from the query in at most ``radius`` bits. ``counters[k]``
    is bit k of 64 difference counts and ``over`` marks those past 2 ** len(counters); adding a plane
    is a ripple of half adders over whole words. After each eighth of the planes, pairs in which all 64
    are beyond the radius are abandoned.
    """
    width = max(1, math.ceil(math.log2(radius + 1)))
    asked = np.ascontiguousarray(_bits(queries).T)
    place, out = np.arange(len(word)), np.zeros(len(word), np.uint64)
    counters = [np.zeros(len(word), np.uint64) for _ in range(width)]
    over = np.zeros(len(word), np.uint64)

    def beyond() -> np.ndarray:
        more, equal = over.copy(), np.full(len(over), _ONES)
        for k in reversed(range(width)):
            if radius >> k & 1:
                equal &= counters[k]
            else:
                more |= equal & counters[k]
                equal &= ~counters[k]
        return more

    for bit in range(len(planes)):
        carry = planes[bit, word] ^ np.where(asked[bit, query], _ONES, np.uint64(0))
        for k in range(width):
            counters[k], carry = counters[k] ^ carry, counters[k] & carry
        over |= carry
        if (bit + 1) % (len(planes) // 8) == 0:
            alive = beyond() != _ONES
            if not alive.all():
                word, query, place, over = word[alive], query[alive], place[alive], over[alive]
                counters = [c[alive] for c in counters]
                if not len(word):
                    return out
    out[place] = ~beyond()
    return out


def within(planes: np.ndarray, queries: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """A bit for every fingerprint that is near any of the queries; each query meets every word."""
    word = np.tile(np.arange(planes.shape[1]), len(queries))
    query = np.repeat(np.arange(len(queries)), planes.shape[1])
    near = np.zeros(planes.shape[1], np.uint64)
    np.bitwise_or.at(near, word, near_bits(planes, word, queries, query, radius))
    return near


def small_stars(groups: list[np.ndarray], radius: int = RADIUS) -> list[list[tuple[int, int]]]:
    """:func:`stars` of many groups of at most 64 fingerprints at once; a word holds whole groups."""
    starts, at = [], 0
    for g in groups:
        at += -at % 64 if at % 64 + len(g) > 64 else 0
        starts.append(at)
        at += len(g)
    sizes = np.array([len(g) for g in groups])
    together = np.concatenate(groups)
    place = np.repeat(np.array(starts) - np.cumsum(sizes) + sizes, sizes) + np.arange(len(together))
    padded = np.zeros((at, *together.shape[1:]), np.uint64)
    padded[place] = together
    near = near_bits(bit_planes(padded), place // 64, together, np.arange(len(together)), radius)
    first = np.repeat(np.array(starts), sizes)
    mask = (_ONES >> (np.uint64(64) - sizes.astype(np.uint64))).repeat(sizes)
    near = near >> (first % 64).astype(np.uint64) & mask
    alone = near == np.uint64(1) << (place - first).astype(np.uint64)
    stops = np.cumsum(sizes)
    linked = ~np.logical_and.reduceat(alone, stops - sizes)
    out: list[list[tuple[int, int]]] = [[] for _ in groups]
    for i in np.flatnonzero(linked).tolist():
        n = len(groups[i])
        own, found, unseen = near[stops[i] - n : stops[i]].tolist(), out[i], (1 << n) - 1
        for start in range(n):
            if not unseen >> start & 1:
                continue
            unseen &= ~(1 << start)
            front = [start]
            while front:
                fresh = own[front.pop()] & unseen
                unseen &= ~fresh
                while fresh:
                    k = (fresh & -fresh).bit_length() - 1
                    fresh &= fresh - 1
                    found.append((k, start))
                    front.append(k)
    return out


def stars(prints: np.ndarray, radius: int = RADIUS) -> list[tuple[int, int]]:
    """Join every fingerprint to the first one of its component among ``prints``, by position.

    Breadth first: what a front of queries reaches and no earlier one did is the next front.
    """
    n, planes, found = len(prints), bit_planes(prints), []
    unseen = np.packbits(np.arange(planes.shape[1] * 64) < n, bitorder="little").view("<u8").copy()
    front_size = max(1, PAIRS // planes.shape[1])
    for first in range(n):
        if not int(unseen[first // 64]) >> first % 64 & 1:
            continue
        unseen[first // 64] &= ~(np.uint64(1) << np.uint64(first % 64))
        front = np.array([first])
        while len(front) and unseen.any():
            fresh = np.zeros(len(unseen), np.uint64)
            for at in range(0, len(front), front_size):
                fresh |= within(planes, prints[front[at : at + front_size]], radius) & unseen
            unseen &= ~fresh
            front = np.flatnonzero(np.unpackbits(fresh.view(np.uint8), bitorder="little"))
            found.extend((i, first) for i in front.tolist())
    return found


def links(nodes: DataFrame, radius: int = RADIUS, bands: int = BANDS, group: int = GROUP) -> DataFrame:
    """Edges (a, b) between near fingerprints, enough to connect every pair within the radius.

    ``nodes`` has one row per distinct ``fingerprint``. A group is the fingerprints that agree on
    ``bands - radius`` bands. Its size is counted before anything is gathered; a group of more than
    ``group`` nodes is dealt into chunks, and every two chunks are one task's work.
    """
    if 64 % bands or bands <= radius:
        raise ValueError("bands must divide 64 and be more than the radius")
    width = 64 // bands
    mask = F.lit((1 << width) - 1)
    parts = [F.shiftrightunsigned("fingerprint", width * i).bitwiseAND(mask) for i in range(bands)]
    keys = []
    for n, chosen in enumerate(combinations(range(bands), bands - radius)):
        keys.append(F.struct(F.lit(n).alias("n"), *[parts[i].alias(f"b{k}") for k, i in enumerate(chosen)]))
    return _met(nodes.select("fingerprint", F.explode(F.array(*keys)).alias("band")), radius, group)


def _prints(nodes) -> np.ndarray:
    """Fingerprints as unsigned machine words."""
    return np.asarray(nodes, np.int64).view(np.uint64)


def _met(banded: DataFrame, radius: int, group: int) -> DataFrame:
    """Edges between near fingerprints that share a ``band``."""
    sizes = banded.groupBy("band").agg(F.count("*").alias("n")).filter("n > 1")
    shared = banded.join(sizes, "band")
    chunks = F.ceil(F.col("n") / group)
    own = F.pmod(F.xxhash64("fingerprint", F.lit(7)), chunks)
    # A chunk meets every other one; a pair is named by its smaller and its larger chunk.
    meets = shared.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), chunks - 1)))
    dealt = meets.filter((chunks == 1) | (F.col("own") != F.col("other"))).groupBy(
        "band", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")
    )
    groups = dealt.agg(F.array_sort(F.collect_list("fingerprint")).alias("prints"))

    def compare(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for lists in batches:
            prints = [_prints(own) for own in lists]
            out: list = [None] * len(prints)
            small = [i for i, own in enumerate(prints) if len(own) <= 64]
            while small:
                # Groups that hold SMALL nodes together, and at least one.
                filled = np.cumsum([len(prints[i]) for i in small[:SMALL]])
                n = max(1, int(np.searchsorted(filled, SMALL)))
                part, small = small[:n], small[n:]
                for i, near in zip(part, small_stars([prints[i] for i in part], radius)):
                    out[i] = near
            for i, own in enumerate(lists):
                near = stars(prints[i], radius) if out[i] is None else out[i]
                out[i] = [{"a": own[j], "b": own[k]} for j, k in near]
            yield pd.Series(out, index=lists.index, dtype=object)

    found = F.pandas_udf(compare, "array<struct<a: long, b: long>>")("prints")
    return groups.select(F.explode(found).alias("e")).select("e.a", "e.b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the least node that each node of ``edges`` can reach, by large and small stars.

    Rounds end when the edges no longer change; each round is checkpointed. A node with many
    neighbours is grouped by partial minima and met in joins that adaptive execution can split.
    """

    def state(df: DataFrame):
        return df.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first()

    def star(df: DataFrame, large: bool) -> DataFrame:
        """Join each node's neighbours to the least of them and itself."""
        seen = df.unionAll(df.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else df
        least = _for_join(seen, "u", F.least(F.min("v"), F.first("u")).alias("m"))
        met = seen.join(least, "u")
        moved = met.filter("v > u" if large else "v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        if not large:
            moved = moved.unionAll(least.select("u", F.col("m").alias("v")))
        return moved.filter("u <> v").distinct()

    held = checkpointed(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct())
    before = state(held)
    while before[0]:
        held = checkpointed(star(star(held, True), False))
        now = state(held)
        if now == before:
            break
        before = now
    roots = held.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionAll(held.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def near_duplicates(docs: DataFrame, radius: int = RADIUS, width: int = SHINGLE, root: str | None = None) -> DataFrame:
    """Every row with its ``fingerprint`` (signed) and ``component_id``, the least id it can reach.

    Expects ``doc_id`` and ``text``; the text is read once and left behind. ``root`` names a further
    column, which tells components apart that have no id.
    """
    prints = checkpointed(with_fingerprint(docs, width=width).drop("text"))
    return _named(prints, lambda nodes: links(nodes, radius), root)


def _for_join(df: DataFrame, key: str, *measures) -> DataFrame:
    """One row per key. Its layout serves no join, so a join on the key is laid out anew and a crowded key can be split."""
    return df.groupBy(key, F.xxhash64(key).alias("_spread")).agg(*measures).drop("_spread")


def _named(prints: DataFrame, link, root: str | None = None) -> DataFrame:
    """Add ``component_id`` to rows with a ``fingerprint``, and the component's least fingerprint as ``root``."""
    nodes = checkpointed(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least_id")))
    roots = checkpointed(components(link(nodes.select("fingerprint"))))
    placed = nodes.join(roots, nodes["fingerprint"] == roots["node"], "left").select(
        "fingerprint", "least_id", F.coalesce("root", "fingerprint").alias("root")
    )
    ids = _for_join(placed, "root", F.min("least_id").alias("component_id"))
    named = placed.join(ids, "root").select("fingerprint", "component_id", *([F.col("root").alias(root)] if root else []))
    return prints.drop("component_id").join(named, "fingerprint")


def one_of_each(docs: DataFrame, radius: int = RADIUS, width: int = SHINGLE) -> DataFrame:
    """The rows of ``docs`` without near copies: of each component exactly one row stays.

    It is the row with the least id, NULL last, then the least text hash, then the least other columns.
    Components are those of :func:`near_duplicates`.

    A row is known by its id and a hash of its text, so rows without an id and rows that share one are
    decided each. Which go is decided on narrow rows; whole rows meet that list once.
    """
    key = [F.col("doc_id"), F.xxhash64("text").alias("_hash")]
    found = near_duplicates(docs.select(*key, "text"), radius, width, root="_root")
    keys = checkpointed(found.groupBy("doc_id", "_hash").agg(F.first("_root").alias("_root"), F.count("*").alias("_n")))
    order = F.struct(F.col("doc_id").isNull().alias("_none"), "doc_id", "_hash")
    best = _for_join(keys, "_root", F.min(order).alias("_best"))
    marks = keys.join(best, "_root").select(
        F.col("doc_id").alias("_id"), F.col("_hash").alias("_of"), (order != F.col("_best")).alias("_gone"), (F.col("_n") > 1).alias("_again")
    )
    marks = checkpointed(marks.filter("_gone or _again"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_of"))
    marked = docs.join(broadcast_if_small(marks), same, "left")
    kept = marked.filter(~F.coalesce("_gone", F.lit(False))).drop("_id", "_gone")
    once = kept.filter("_again is null").drop("_again", "_of")
    if marks.filter("_again and not _gone").isEmpty():
        return once
    rest = [c for c, kind in docs.dtypes if c not in ("doc_id", "text") and "map<" not in kind and "variant" not in kind]
    first = Window.partitionBy("doc_id", "_of").orderBy(*(rest or ["_of"]))
    again = kept.filter("_again").withColumn("_place", F.row_number().over(first))
    return once.unionByName(again.filter("_place = 1").drop("_place", "_again", "_of"))
