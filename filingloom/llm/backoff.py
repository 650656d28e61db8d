"""LM scoring with a weighted backoff automaton.

Training counts of words and word pairs make the model: the state of a word has an arc for every word
seen after it and a failure arc to the root, which has an arc for every word. With p1 the add-one word
probability, an arc of state h weighs log10((c(h w) + M p1(w)) / (c(h) + M)) and its failure arc
log10(M / (c(h) + M)), so each state's probabilities sum to one. A text is scored in one pass from left
to right that carries the state.

The model is never in one place. Documents are dealt into blocks by hash. A block sends the 64-bit
hashes of its distinct words and pairs, with its training counts, to the buckets that own them; a bucket
adds up the counts of all blocks and answers each block with the totals; the block then holds the part
of the automaton that its own texts can reach, and walks it. A frequent word is one entry per block in
its bucket, however often it occurs. Hashes of 64 bits stand for words: two among a billion distinct
words collide with a chance of about 3 in 100.

Defined cases: NULL text is empty and has one token, the end; NULL ids take part (their crc32 is that of
the empty text); rows that repeat are scored, and learned from, each; an empty table gives no rows; with
nothing to learn from every token is unknown; other columns pass through.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from filingloom.llm.common import remainder

#: Pseudo-count of the root at every state.
MASS = 1000.0
#: Bytes of text in a block, and entries (words and pairs of a block) in a bucket, both on average.
BLOCK_BYTES = 4 << 20
BUCKET_ENTRIES = 1_500_000
#: Distinct words that a task holds while it counts the vocabulary.
HELD_WORDS = 400_000
#: The end of a text and its beginning; neither can be a word.
END, BEGIN = b"\n", b" "


def words_of(text: str | None) -> list[bytes]:
    """Words with A-Z lowered; bytes split at ASCII white space only."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def _hashes(words) -> np.ndarray:
    import xxhash

    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(w) for w in words), np.uint64, len(words))


def _pair_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    mixed = first * np.uint64(0x9E3779B97F4A7C15) ^ (second + np.uint64(0x632BE59BD9B4E019)) * np.uint64(0xC2B2AE3D27D4EB4F)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ mixed >> np.uint64(32)


def _cuts(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, int, int]]:
    """(bucket, start, stop) of the ranges of sorted keys that each bucket owns."""
    edges = np.array([(b << 64) // buckets for b in range(1, buckets)], dtype=np.uint64)
    stops = np.concatenate((np.searchsorted(keys, edges), [len(keys)])).tolist()
    start = 0
    for bucket, stop in enumerate(stops):
        if stop > start:
            yield bucket, start, stop
        start = stop


def _pack(values: np.ndarray) -> bytes:
    """Bytes of whole numbers, all lowest bytes first: the high ones are mostly zero and compress."""
    size = values.dtype.itemsize
    return values.view(np.uint8).reshape(-1, size).T.tobytes()


def _unpack(packed: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    planes = np.frombuffer(packed, np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).view(dtype).ravel()


def _pack_sorted(keys: np.ndarray) -> bytes:
    """Sorted keys as steps from one to the next."""
    steps = keys.copy()
    steps[1:] -= keys[:-1]
    return _pack(steps)


def _unpack_sorted(packed: bytes) -> np.ndarray:
    return np.cumsum(_unpack(packed, np.uint64), dtype=np.uint64)


class Block:
    """Tokens of some documents, their distinct words and pairs, and the sorted hashes of both."""

    def __init__(self, texts, learn):
        tokens: list[bytes] = []
        ends = []
        for text in texts:
            tokens += words_of(text)
            tokens.append(END)
            ends.append(len(tokens))
        index = {w: i for i, w in enumerate(dict.fromkeys(tokens))}
        self.ids = np.fromiter(map(index.__getitem__, tokens), np.int64, len(tokens))
        self.ends = np.array(ends, np.int64)
        self.n_words = len(index)
        self.end_id = index.get(END, 0)
        starts = np.concatenate(([0], self.ends[:-1])).astype(np.int64)
        before = np.empty_like(self.ids)
        before[1:] = self.ids[:-1]
        before[starts] = self.n_words  # the state of a beginning
        hashes = np.concatenate((_hashes(list(index)), _hashes([BEGIN])))
        pairs = _pair_hashes(hashes[before], hashes[self.ids])
        pair_keys, at, place = np.unique(pairs, return_index=True, return_inverse=True)
        self.pair_arcs = before[at] * self.n_words + self.ids[at]
        learned = np.repeat(np.asarray(learn, bool), np.diff(self.ends, prepend=0))
        counts = (
            np.bincount(self.ids[learned], minlength=self.n_words),
            np.bincount(place[learned], minlength=len(pair_keys)),
        )
        keys = np.concatenate((hashes[:-1], pair_keys))
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]
        self.counts = np.concatenate(counts)[self.order]


def vocabulary(docs: DataFrame, learn: Column, buckets: int) -> tuple[int, int]:
    """Number of training tokens and of distinct ones, ends included.

    Tasks send hashes of the distinct words they have met; each bucket counts those it owns.
    """

    def collect(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: set[bytes] = set()
        tokens = 0

        def rows() -> pd.DataFrame:
            keys = np.unique(_hashes(held))
            cut = [(b, _pack_sorted(keys[i:j])) for b, i, j in _cuts(keys, buckets)]
            frame = pd.DataFrame(cut, columns=["bucket", "keys"])
            frame["tokens"] = [tokens, *[0] * (len(frame) - 1)] if len(frame) else []
            return frame

        for batch in batches:
            for text in batch.text:
                words = words_of(text)
                tokens += len(words) + 1
                held.update(words)
                held.add(END)
                if len(held) >= HELD_WORDS:
                    yield rows()
                    held, tokens = set(), 0
        if held:
            yield rows()

    def count(frame: pd.DataFrame) -> pd.DataFrame:
        keys = np.concatenate([_unpack_sorted(k) for k in frame["keys"]])
        return pd.DataFrame({"words": [len(np.unique(keys))], "tokens": [int(frame.tokens.sum())]})

    parts = docs.filter(learn).select("text").mapInPandas(collect, "bucket int, keys binary, tokens long")
    counted = parts.groupBy("bucket").applyInPandas(count, "words long, tokens long")
    zero = F.lit(0)
    found = counted.agg(F.coalesce(F.sum("tokens"), zero), F.coalesce(F.sum("words"), zero)).first()
    return int(found[0]), int(found[1])


def _requests(buckets: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        block = Block(frame.text, ~frame._held)
        counts = block.counts.astype(np.uint32)
        cuts = _cuts(block.keys, buckets)
        out = [(b, _pack_sorted(block.keys[i:j]), _pack(counts[i:j])) for b, i, j in cuts]
        found = pd.DataFrame(out, columns=["bucket", "keys", "counts"])
        found["_block"] = frame._block.iloc[0]
        return found[["_block", "bucket", "keys", "counts"]]

    return run


def _totals(frame: pd.DataFrame) -> pd.DataFrame:
    keys = np.concatenate([_unpack_sorted(k) for k in frame["keys"]])
    counts = np.concatenate([_unpack(c, np.uint32) for c in frame["counts"]])
    unique, place = np.unique(keys, return_inverse=True)
    totals = np.bincount(place, weights=counts, minlength=len(unique)).astype(np.uint64)[place]
    stops = np.cumsum([len(k) // 8 for k in frame["keys"]])
    parts = [_pack(t) for t in np.split(totals, stops[:-1])]
    return pd.DataFrame({"_block": frame._block, "bucket": frame.bucket, "totals": parts})


def walk(block: Block, totals: np.ndarray, tokens: int, words: int, mass: float) -> pd.DataFrame:
    """Score the documents of a block: n_tokens, n_known, base_score and score, in their order."""
    counts = np.empty(len(totals), np.float64)
    counts[block.order] = totals
    seen, pair_seen = counts[: block.n_words], counts[block.n_words :]
    chance = (seen + 1) / (tokens + 1 * (words + 1))
    root = np.log10(chance)
    # Every text begins once and ends once, so beginnings are as many as ends.
    state_count = np.append(seen, seen[block.end_id] if block.n_words else 0.0)
    fail = np.log10(mass / (state_count + mass)).tolist()
    real = pair_seen > 0
    state, word = np.divmod(block.pair_arcs[real], block.n_words)
    weight = np.log10((pair_seen[real] + mass * chance[word]) / (state_count[state] + mass))
    arcs = dict(zip(block.pair_arcs[real].tolist(), weight.tolist()))
    out, at, step, begin, roots = [], 0, block.n_words, block.n_words, root.tolist()
    known = (seen > 0).tolist()
    for stop in block.ends.tolist():
        state, total, base, n_known = begin, 0.0, [], 0
        for token in block.ids[at:stop].tolist():
            arc = arcs.get(state * step + token)
            if arc is None:
                total += fail[state] + roots[token]
            else:
                total += arc
            base.append(roots[token])
            n_known += known[token]
            state = token
        out.append((stop - at, n_known, math.fsum(base), total))
        at = stop
    return pd.DataFrame(out, columns=["n_tokens", "n_known", "base_score", "score"])


def scored(docs: DataFrame, learn: Column, mass: float = MASS) -> DataFrame:
    """Every row without its text, with n_tokens, n_known, train_tokens, base_score and score.

    ``learn`` says from which rows to learn. Texts are shuffled once, by block; both sides of the
    exchange of counts read that shuffle.
    """
    own = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]
    kept = [c for c in docs.columns if c != "text" and c not in own]
    text = F.coalesce("text", F.lit(""))
    size = docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    blocks = 1 + size // BLOCK_BYTES
    buckets = 1 + size // (6 * BUCKET_ENTRIES)
    tokens, words = vocabulary(docs, learn, buckets)
    # Columns that pass through travel as JSON, so that NULLs do not change their types on the way.
    row = F.to_json(F.struct(*[F.col(c) for c in kept])) if kept else F.lit("{}")
    blocked = docs.select(
        F.pmod(F.xxhash64(text, row), F.lit(blocks)).alias("_block"),
        F.coalesce(~learn, F.lit(True)).alias("_held"),
        row.alias("_row"),
        text.alias("text"),
    )
    requests = blocked.groupBy("_block").applyInPandas(
        _requests(buckets), "_block long, bucket int, keys binary, counts binary"
    )
    totals = requests.groupBy("bucket").applyInPandas(_totals, "_block long, bucket int, totals binary")

    def score(frame: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        block = Block(frame.text, ~frame._held)
        parts = [_unpack(t, np.uint64) for t in answers.sort_values("bucket").totals]
        found = walk(block, np.concatenate(parts), tokens, words, mass)
        return found.assign(_row=frame._row.to_numpy())

    schema = "n_tokens long, n_known long, base_score double, score double, _row string"
    found = blocked.groupBy("_block").cogroup(totals.groupBy("_block")).applyInPandas(score, schema)
    fields = F.from_json("_row", docs.select(*kept).schema).alias("_kept") if kept else F.lit(None).alias("_kept")
    return found.select(fields, *own[:2], F.lit(tokens).cast("long").alias("train_tokens"), *own[3:]).select(
        *[f"_kept.`{c}`" for c in kept], *own
    )


def held_out(divisor: int = 7, value: int = 2) -> Column:
    """Whether a document is kept from learning."""
    return remainder(F.col("doc_id"), divisor) == value
