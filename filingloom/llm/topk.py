"""Exact top-k search by inner product: MaxScore over posting lists of vector components.

Components become integers, floor(64 x). A component's number is a term, and its posting list holds the
rows of a shard where it is not zero. With the highest component in the list, a query weight bounds what
the term can add to a score. Terms of a query stand in falling order of that bound; the essential ones are
the first, up to where all that is left cannot lift a row from nothing to half the score to beat. Their
postings are traversed for all rows. Rows whose sum, with the bound of what is left, still reaches the
score to beat are competitive, and only for them the other terms are probed, one by one, while that holds.
What is left is bounded by the sum of term bounds and by the lengths of both vectors, the lesser of these.

A first shard is searched without a score to beat and gives each query one: the k-th best score there.
The other shards are searched against it. Shards and blocks of queries meet by number, each meeting is one
group of bounded size, and the best rows of all shards are merged, first within each task.

Posting lists of more than ``FULL`` of a shard's rows are held with their gaps as zeros, and those of a
query that are essential are traversed in one matrix product; shorter lists are traversed by row number.

Defined cases: NULL vectors, and vectors with a NULL, NaN or infinite component, take no part; an empty
vector scores 0 with all; of vectors of unequal length the missing components are 0; a query's own row is
every row with its id; rows that repeat are searched and returned each; a row with a NULL id is no query
and stands behind all equal scores; components and scores are 64-bit integers and must fit them; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from filingloom.sinks.workspace import checkpointed

SCALE = 64
TOP = 20
#: Components of one shard and queries of one block, on average: what one group holds in memory.
SHARD_VALUES, BLOCK_VALUES = 1 << 18, 1 << 14
#: A posting list of more than this share of a shard's rows keeps its gaps as zeros.
FULL = 0.25
#: Essential terms go on until what is left is below this share of the score to beat. Any share up to 1 gives the same rows.
SHARE = 0.5
#: Up to here sums of whole numbers are exact as doubles.
EXACT = 2.0**53
#: Stands for a NULL id where rows are compared.
_LAST = int(np.iinfo(np.int64).max)


def whole_components(vector: Column, scale: int = SCALE) -> Column:
    """A vector as integers; NULL if it is NULL or a component is NULL or not finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return F.when(finite, F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long")))


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    """Vectors as rows, shorter ones filled with zeros."""
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


class Shard:
    """Posting lists of a shard's rows and the bounds that follow from them."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray) -> None:
        self.ids, self.rows = ids, rows
        self.high, self.low = rows.max(axis=0, initial=0), rows.min(axis=0, initial=0)
        self.longest = float(np.sqrt((rows.astype(np.float64) ** 2).sum(axis=1).max(initial=0)))
        fill = np.count_nonzero(rows, axis=0)
        self.full = np.flatnonzero(fill > FULL * len(rows))
        self.short = {int(t): (at := np.flatnonzero(rows[:, t]), rows[at, t]) for t in np.flatnonzero((fill > 0) & (fill <= FULL * len(rows)))}

    def search(self, own: np.ndarray, queries: np.ndarray, beat: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, row, score) of each query's best rows, those of at least the score to ``beat``.

        ``own`` has the queries' ids; ``beat`` is minus infinity where nothing is known yet.
        """
        most = np.maximum(np.maximum(queries * self.high, queries * self.low), 0)
        size = float((np.abs(queries).astype(np.float64) @ np.maximum(np.abs(self.high), np.abs(self.low)).astype(np.float64)).max(initial=0))
        kind, slack = (np.float64, 1e-6) if size < EXACT else (np.int64, size * 1e-12)
        order = np.argsort(-most, axis=1, kind="stable")
        ranked = np.take_along_axis(queries, order, 1).astype(np.float64)

        def left(values: np.ndarray) -> np.ndarray:
            sums = np.zeros((len(values), values.shape[1] + 1))
            sums[:, :-1] = np.cumsum(values[:, ::-1], axis=1)[:, ::-1]
            return sums

        by_terms = left(np.take_along_axis(most, order, 1).astype(np.float64))
        by_length = np.sqrt(left(ranked**2)) * self.longest
        rest = np.minimum(by_terms, by_length) * (1 + 1e-9) + slack
        # The first place from which on terms are not essential; every query has one, as nothing is left at the end.
        goal = np.where(np.isfinite(beat), np.maximum(beat * SHARE, 2 * slack), -1.0)
        first = np.argmax(np.concatenate([rest[:, :-1] < goal[:, None], np.ones((len(rest), 1), bool)], axis=1), axis=1)
        sums = self._traverse(queries, order, first, kind)
        reach = sums + rest[np.arange(len(rest)), first][:, None] >= beat[:, None]
        reach &= own[:, None] != self.ids
        query, row = np.nonzero(reach)
        score, place = sums[query, row], first[query]
        done: list[tuple[np.ndarray, ...]] = []
        while len(query):
            ended = place == queries.shape[1]
            if ended.any():
                done.append((query[ended], row[ended], score[ended]))
                query, row, score, place = (x[~ended] for x in (query, row, score, place))
                continue
            term = order[query, place]
            score = score + (queries[query, term] * self.rows[row, term]).astype(kind)
            place = place + 1
            alive = score + rest[query, place] >= beat[query]
            if not alive.all():
                query, row, score, place = (x[alive] for x in (query, row, score, place))
        if not done:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        query, row, score = (np.concatenate(x) for x in zip(*done))
        score = score.astype(np.int64)
        best = np.lexsort((row, self.ids[row], -score, query))
        query, row, score = query[best], row[best], score[best]
        start = np.searchsorted(query, query)
        kept = np.arange(len(query)) - start < k
        return query[kept], row[kept], score[kept]

    def _traverse(self, queries: np.ndarray, order: np.ndarray, first: np.ndarray, kind) -> np.ndarray:
        """Sums over the postings of each query's essential terms, for all rows."""
        rank = np.argsort(order, axis=1)
        weights = np.where(rank < first[:, None], queries, 0).astype(kind)
        sums = weights[:, self.full] @ self.rows[:, self.full].T.astype(kind)
        for term, (rows, values) in self.short.items():
            asked = np.flatnonzero(weights[:, term])
            if len(asked):
                sums[np.ix_(asked, rows)] += weights[asked, term][:, None] * values.astype(kind)
        return sums


def _numbers(df: DataFrame, values: int) -> int:
    """Into how many groups rows are dealt, so that one has about ``values`` components."""
    held = df.agg(F.coalesce(F.sum(F.size("vector") + F.lit(1)), F.lit(0))).first()[0]
    return max(1, -(-held // values))


def _search(rows: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """The best rows of each query in each shard; both sides have a ``shard`` and a ``block``."""

    def meet(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if asked.empty or held.empty:
            return pd.DataFrame({"query": [], "query_id": [], "vec_id": [], "known": [], "score": []})
        width = max(asked["components"].map(len).max(), held["vector"].map(len).max())
        ids, known = held["vec_id"].to_numpy(np.int64), held["known"].to_numpy(bool)
        shard = Shard(ids, _matrix(held["vector"], width))
        beat = asked["beat"].astype(np.float64).fillna(-np.inf).to_numpy()
        own = asked["query_id"].to_numpy(np.int64)
        query, row, score = shard.search(own, _matrix(asked["components"], width), beat, k)
        asked_as = asked["query"].to_numpy()[query]
        return pd.DataFrame({"query": asked_as, "query_id": own[query], "vec_id": ids[row], "known": known[row], "score": score})

    # pandas would hold ids as doubles if one were NULL.
    named = rows.withColumn("known", F.col("vec_id").isNotNull()).withColumn("vec_id", F.coalesce("vec_id", F.lit(_LAST)))
    sides = [df.groupBy("shard", "block") for df in (queries, named)]
    found = sides[0].cogroup(sides[1]).applyInPandas(meet, "query long, query_id long, vec_id long, known boolean, score long")
    return found.withColumn("vec_id", F.when(F.col("known"), F.col("vec_id"))).drop("known")


def _best(found: DataFrame, k: int) -> DataFrame:
    """Merge shards: each query's ``k`` best rows in order, and their ranks."""
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_rows(vectors: DataFrame, asked: Column, k: int = TOP, shard_values: int = SHARD_VALUES, block_values: int = BLOCK_VALUES) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best rows of every row where ``asked`` holds.

    ``vectors`` has ``vec_id`` and ``vector``, an array of longs; NULL vectors take no part.
    """
    rows = checkpointed(vectors.filter("vector is not null").withColumn("_asked", F.coalesce(asked, F.lit(False)) & F.col("vec_id").isNotNull()))
    queries = rows.filter("_asked")
    shards, blocks = _numbers(rows, shard_values), _numbers(queries, block_values)

    def dealt(n: int, seed: int) -> Column:
        return F.pmod(F.xxhash64("vec_id", "vector", F.lit(seed)), F.lit(n)).cast("int")

    def spread(n: int, since: int = 0) -> Column:
        return F.explode(F.sequence(F.lit(since), F.lit(n - 1)))

    held = rows.select("vec_id", "vector", dealt(shards, 1).alias("shard"))
    named = queries.select(
        F.monotonically_increasing_id().alias("query"),
        F.col("vec_id").alias("query_id"),
        F.col("vector").alias("components"),
        dealt(blocks, 2).alias("block"),
    )
    start = named.withColumn("shard", F.lit(0)).withColumn("beat", F.lit(None).cast("long"))
    found = checkpointed(_search(held.filter("shard = 0").withColumn("block", spread(blocks)), start, k))
    if shards > 1:
        beat = _best(found, k).filter(F.col("rank") == k).select("query", F.col("score").alias("beat"))
        told = named.join(beat, "query", "left").withColumn("shard", spread(shards, 1))
        found = found.unionAll(_search(held.filter("shard > 0").withColumn("block", spread(blocks)), told, k))
    return _best(found, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
