"""Language identification by error-correcting output codes.

Every language has a codeword. One binary classifier per bit, over hashed character n-grams, answers
for a text with a real number; the language is the one whose codeword has the least loss, each bit
weighted by how well its classifier separates the training texts. A second codeword about as near
makes the answer ambiguous.

Learning reads labelled texts only: the classifiers are fitted on a sample of at most about
``rows_per_language`` rows of each language, chosen by a hash of the id. Predictions read every text
whole, in slices.

Defined cases: NULL text or text without a letter is ``und`` with score 0; without any labelled text
every answer is ``und``; a single language is the answer for every text with a letter; rows that repeat
are answered alike; an empty table gives no rows; other columns pass through.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from filingloom.llm.common import remainder
from filingloom.sinks.workspace import checkpointed

UND = "und"
BUCKETS = 1 << 15
ROWS_PER_LANGUAGE = 1_500
#: Weight of the prior in the n-gram shares of a language, in counts per bucket.
PRIOR = 0.5
#: Loss by which the second codeword must be worse for a clear answer, as a share of all bit weights.
CLEAR = 0.005
#: Sharpness of the score.
SHARPNESS = 12.0
#: Letters handled at once.
SLICE = 1 << 16

ANSWER = T.StructType(
    [
        T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("ambiguous", T.BooleanType()),
    ]
)


def codewords(n: int) -> np.ndarray:
    """One row of bits per language, far from all others.

    Up to five languages: every split of the languages into two parts, once. More: the best of some
    drawn codes, by least distance of two rows and without columns that split nothing.
    """
    if n <= 5:
        splits = [[1] + [(k >> i) & 1 for i in range(n - 1)] for k in range(2 ** (n - 1) - 1)]
        return np.array(splits, dtype=np.int8).reshape(-1, n).T
    bits, rng, best, least = 8 * math.ceil(math.log2(n)), np.random.default_rng(20), None, -1
    for _ in range(200):
        drawn = rng.integers(0, 2, (n, bits), dtype=np.int8)
        drawn = drawn[:, (drawn.min(0) == 0) & (drawn.max(0) == 1)]
        gram = drawn.astype(np.int32)
        distance = gram @ (1 - gram).T
        distance = distance + distance.T
        np.fill_diagonal(distance, bits)
        if distance.min() > least:
            best, least = drawn, distance.min()
    return best


@lru_cache(maxsize=1)
def _is_letter() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def gram_slices(text: str) -> Iterator[np.ndarray]:
    """Buckets of the letter 1-, 2- and 3-grams of a text, a slice at a time.

    Other signs count as word borders, a run of them as one; a border stands at both ends. The last
    two codes of a slice begin the next one, so every three neighbours are met once.
    """
    held = np.zeros(1, np.uint32)
    for start in range(0, len(text), SLICE):
        part = text[start : start + SLICE].lower().encode("utf-32-le", "surrogatepass")
        codes = np.frombuffer(part, np.uint32)
        codes = np.concatenate((held, np.where(_is_letter()[codes], codes, np.uint32(0))))
        codes = codes[np.flatnonzero((codes != 0) | (np.concatenate(([1], codes[:-1])) != 0))]
        if start + SLICE >= len(text) and codes[-1]:
            codes = np.concatenate((codes, np.zeros(1, np.uint32)))
        if len(codes) > 2:
            yield _buckets(codes[:-2], codes[1:-1], codes[2:])
        held = codes[-2:]


def _buckets(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    """The letter in the middle, the pair that it begins, and all three."""
    one = b * np.uint32(0x9E3779B1)
    two = one ^ (c * np.uint32(0x85EBCA77) + np.uint32(0x3C6EF372))
    three = two * np.uint32(0xC2B2AE3D) ^ (a * np.uint32(0x27D4EB2F) + np.uint32(0x165667B1))
    grams = np.concatenate((one[b != 0], two, three))
    grams ^= grams >> np.uint32(15)
    grams *= np.uint32(0x2C1B3C6D)
    return (grams >> np.uint32(17)).astype(np.int32)


@dataclass(frozen=True)
class Model:
    """Languages, their codewords, the classifiers' weights, and scale, shift and trust of each bit."""

    languages: tuple[str, ...]
    code: np.ndarray
    weights: np.ndarray
    scale: np.ndarray
    shift: np.ndarray
    trust: np.ndarray

    def response(self, text: str) -> np.ndarray | None:
        """Mean weight of the text's n-grams for every bit; None without a letter."""
        total, n = np.zeros(self.weights.shape[1]), 0
        for grams in gram_slices(text):
            total += self.weights[grams].sum(axis=0, dtype=np.float64)
            n += len(grams)
        return total / n if n else None

    def answer(self, text: str | None) -> tuple[str, float, bool]:
        found = self.response(text) if text and self.languages else None
        if found is None:
            return UND, 0.0, False
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False
        margins = np.clip(found * self.scale + self.shift, -4, 4)
        signs = 2.0 * self.code - 1.0
        loss = (np.log1p(np.exp(-2 * signs * margins)) * self.trust).sum(axis=1) / self.trust.sum()
        order = np.argsort(loss, kind="stable")
        shares = np.exp(-SHARPNESS * (loss - loss[order[0]]))
        clear = loss[order[1]] - loss[order[0]] > CLEAR
        return self.languages[order[0]], float(shares[order[0]] / shares.sum()), not clear


def _sample(labelled: DataFrame, languages: dict[str, int], rows: int) -> DataFrame:
    """At most about ``rows`` rows of each language, chosen by a hash of the id."""
    rates = F.create_map(*[F.lit(x) for lang, n in languages.items() for x in (lang, min(1.0, rows / n))])
    draw = F.pmod(F.xxhash64("doc_id", F.lit("language sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return labelled.filter(draw < F.element_at(rates, F.col("lang"))).select("lang", "text")


def fit(docs: DataFrame, learn: Column, rows_per_language: int = ROWS_PER_LANGUAGE) -> Model:
    """Fit on the rows of (doc_id, text, lang) for which ``learn`` holds and ``lang`` is known.

    Rows per language are counted first. Of the sample, tasks add up n-gram counts, so the driver gets
    one count per language and bucket, and then mean and spread of each classifier's responses.
    """
    labelled = docs.filter(learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        empty = np.zeros((0, 0))
        return Model((), empty, empty, empty, empty, empty)
    sample = checkpointed(_sample(labelled, sizes, rows_per_language))
    names = sorted(sizes)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.lang, batch.text):
                own = held.setdefault(lang, np.zeros(BUCKETS, np.int64))
                for grams in gram_slices(text):
                    own += np.bincount(grams, minlength=BUCKETS)
        for lang, own in held.items():
            at = np.flatnonzero(own)
            yield pd.DataFrame({"lang": lang, "bucket": at.astype(np.int32), "n": own[at]})

    counts = np.zeros((len(names), BUCKETS))
    summed = sample.mapInPandas(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    for lang, own in summed.toPandas().groupby("lang"):
        counts[names.index(lang), own.bucket] = own.n
    seen = np.flatnonzero(counts.sum(axis=1))
    names, counts = [names[i] for i in seen], counts[seen]
    if len(names) < 2:
        empty = np.zeros((len(names), 0))
        return Model(tuple(names), empty, np.zeros((BUCKETS, 1), np.float32), empty, empty, empty)

    shares = (counts + PRIOR) / (counts + PRIOR).sum(axis=1, keepdims=True)
    code = codewords(len(names))
    inside = (code.T @ shares) / code.sum(axis=0)[:, None]
    outside = ((1 - code).T @ shares) / (1 - code).sum(axis=0)[:, None]
    weights = np.ascontiguousarray(np.log(inside / outside).T, dtype=np.float32)
    bits = code.shape[1]
    plain = Model(tuple(names), code, weights, np.ones(bits), np.zeros(bits), np.ones(bits))

    def respond(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, list] = {}
        for batch in batches:
            for lang, text in zip(batch.lang, batch.text):
                if (found := plain.response(text)) is not None:
                    own = held.setdefault(lang, [0, np.zeros(bits), np.zeros(bits)])
                    own[0] += 1
                    own[1] += found
                    own[2] += found * found
        for lang, (n, total, squares) in held.items():
            yield pd.DataFrame({"lang": lang, "bit": range(bits), "n": n, "total": total, "squares": squares})

    moments = (
        sample.mapInPandas(respond, "lang string, bit int, n long, total double, squares double")
        .groupBy("lang", "bit")
        .agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.sum("squares").alias("squares"))
        .toPandas()
    )
    mean, spread = np.zeros((len(names), bits)), np.zeros((len(names), bits))
    for r in moments.itertuples(index=False):
        i = names.index(r.lang)
        mean[i, r.bit] = r.total / r.n
        spread[i, r.bit] = max(r.squares / r.n - mean[i, r.bit] ** 2, 0.0)
    on = (code * mean).sum(axis=0) / code.sum(axis=0)
    off = ((1 - code) * mean).sum(axis=0) / (1 - code).sum(axis=0)
    gap = np.maximum(on - off, 1e-6)
    # Trust: one less twice the error of two normal classes at this gap and spread.
    deviation = np.sqrt(spread.mean(axis=0)) + 1e-6
    trust = np.array([math.erf(g / d / 2 / math.sqrt(2)) for g, d in zip(gap, deviation)]) + 1e-3
    return Model(tuple(names), code, weights, 2 / gap, -(on + off) / gap, trust)


def with_language(docs: DataFrame, model: Model) -> DataFrame:
    """Add ``lang_pred``, ``score`` and ``ambiguous`` from the text alone."""

    def tell(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([model.answer(t) for t in texts], columns=ANSWER.names, index=texts.index)

    own = ANSWER.names
    told = docs.drop(*own).withColumn("_answer", F.pandas_udf(tell, ANSWER)("text"))
    return told.select(*[c for c in docs.columns if c not in own], *[f"_answer.{n}" for n in own])


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` whose language is told and clear, with their columns as they were."""
    told = docs.select("*", F.struct("*").alias("_row"))
    found = with_language(told, model)
    return found.filter((F.col("lang_pred") != UND) & ~F.col("ambiguous")).select("_row.*")


def held_out(divisor: int = 4, value: int = 2) -> Column:
    """Whether a document is kept from learning."""
    return remainder(F.col("doc_id"), divisor) == value
