"""Quality rules: text statistics, plain limits, and robust outliers per language and source.

Statistics of each text become a vector. For every language and source a minimum-covariance-determinant
estimate is found by concentration steps: from medians and quartile ranges on, each step takes the
rows nearest to the last estimate, at least ``SUBSET`` of the group, and their mean and covariance make
the next one, until the determinants stop falling. Rows far from the estimate by Mahalanobis distance
are rejected.

Everything is DataFrame expressions. Rows are never sorted or gathered by group: distances are counted
in fixed bins together with the sums that mean and covariance need, so a step is one aggregation with
partial sums and a group is a few hundred bins wherever its rows lie.

Groups of fewer than ``LEAST_ROWS`` rows are pooled, by language first and then all together; a pool
that is still smaller gives no verdict. Defined cases: NULL text has no words and fails the base rule;
NULL languages and sources are groups of their own; repeated rows count each; an empty table gives no
rows; other columns pass through.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from filingloom.llm.common import WORD, broadcast_if_small
from filingloom.sinks.workspace import checkpointed

SYMBOLS = r"[#*$%&|<>]"
REPEAT = 8
LEAST_WORDS, MOST_REPEATED = 20, 30

#: Vector entries: length, word length, and shares of symbols, repeated lines and repeated words.
FEATURES = ("f_length", "f_word", "f_symbols", "f_lines", "f_repeats")
#: No entry's deviation counts as less than this.
FLOORS = (0.3, 0.03, 0.1, 0.2, 0.5)
LEAST_ROWS = 50
SUBSET = 0.75
STEPS = 6
#: Median of a chi-square with five degrees of freedom, and the limit. Mean word lengths of short texts
#: vary more than those of their group, so the limit is well above the 1e-6 tail of 37.
MEDIAN, LIMIT = 4.351, 60.0
#: Width of the bins of an entry, and bins per unit of log(1 + squared distance).
GRID, FINE = 0.01, 50


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once per row."""
    return F.transform(F.array(value), body)[0]


def _words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def _head(items: Column, drop: int | Column) -> Column:
    return F.slice(items, F.lit(1), F.greatest(F.size(items) - drop, F.lit(0)))


def _tail(items: Column, drop: int) -> Column:
    return F.slice(items, F.lit(1 + drop), F.greatest(F.size(items) - drop, F.lit(0)))


def repeated_words(words: Column, width: int = REPEAT) -> Column:
    """Words inside windows of ``width`` words that occur twice or more; ``width`` is a power of two.

    A window is its 64-bit hash, built from hashes of its halves. Texts whose windows all differ stop
    there. In the others windows are sorted by hash, equal neighbours give their places, and the
    places in order give the words covered.
    """

    def pair(size: int, hashes: Column) -> Column:
        if size == width:
            return hashes
        merged = let(hashes, lambda h: F.zip_with(_head(h, size), _tail(h, size), lambda a, b: F.xxhash64(a, b)))
        return pair(size * 2, merged)

    windows = pair(1, F.transform(words, lambda w: F.xxhash64(w)))

    def covered(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        none = F.array().cast("array<int>")
        equal = let(
            placed,
            lambda p: F.zip_with(
                _head(p, 1), _tail(p, 1), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])).otherwise(none)
            ),
        )
        places = F.sort_array(F.array_distinct(F.flatten(equal)))
        start = F.struct(F.lit(0).alias("n"), F.lit(-width).alias("last"))
        return F.aggregate(
            places,
            start,
            lambda acc, i: F.struct(
                (acc["n"] + F.least(F.lit(width), i - acc["last"])).alias("n"), i.alias("last")
            ),
            lambda acc: acc["n"],
        )

    counted = let(
        windows, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(F.lit(0))
    )
    return counted.cast("long")


def with_statistics(docs: DataFrame) -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD))
    words = _words(text)
    own = {
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.char_length(F.regexp_replace(text, r"[\x20\x09-\x0D]+", "")).cast("long"),
        "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)).cast("long"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": repeated_words(F.col("_words")),
    }
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    kept = docs.drop(*own, "base_failed", "distance", "kept")
    return kept.withColumn("_words", words).select(*kept.columns, *[c.alias(n) for n, c in own.items()]).withColumn("base_failed", failed)


def with_features(rows: DataFrame) -> DataFrame:
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    vector = (
        F.log(n),
        F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n),
        F.log1p(20 * F.col("n_symbols") / n),
        F.log1p(20 * F.col("n_dup_lines") / n),
        F.log1p(20 * F.col("n_repeat_words") / n),
    )
    return rows.withColumns(dict(zip(FEATURES, vector)))


def _group_of(rows: DataFrame) -> DataFrame:
    """(_lang, _source, _group): the name of the group that judges each language and source; NULL for none."""
    counts = rows.groupBy("lang", "source").agg(F.count("*").alias("n"))
    small = F.col("n") < LEAST_ROWS
    of_lang = F.sum(F.when(small, F.col("n"))).over(Window.partitionBy("lang"))
    pooled = counts.withColumn("_lang_rows", of_lang)
    rest = F.when(small & (F.col("_lang_rows") < LEAST_ROWS), F.col("n"))
    total = pooled.agg(F.coalesce(F.sum(rest), F.lit(0)).alias("_rest"))
    name = (
        F.when(~small, F.to_json(F.struct(F.lit(0).alias("level"), "lang", "source")))
        .when(F.col("_lang_rows") >= LEAST_ROWS, F.to_json(F.struct(F.lit(1).alias("level"), "lang")))
        .when(F.lit(total.first()[0]) >= LEAST_ROWS, F.lit("all"))
    )
    return pooled.select(F.col("lang").alias("_lang"), F.col("source").alias("_source"), name.alias("_group"))


def _start(rows: DataFrame) -> DataFrame:
    """Medians and quartile ranges of every group: centre and a diagonal covariance.

    Entries are counted on a grid; a quantile is the first grid point that its share does not pass.
    """
    entries = F.posexplode(F.array(*[F.floor(F.col(f) / GRID).cast("int") for f in FEATURES])).alias("k", "bin")
    bins = rows.select("_group", entries).groupBy("_group", "k", "bin").agg(F.count("*").alias("n"))
    group = Window.partitionBy("_group", "k")
    to = F.sum("n").over(group.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))
    share = bins.withColumn("share", to / F.sum("n").over(group))
    at = {q: (F.min(F.when(F.col("share") >= q, F.col("bin"))) + 0.5) * GRID for q in (0.25, 0.5, 0.75)}
    spread = (at[0.75] - at[0.25]) / 1.349
    marks = share.groupBy("_group", "k").agg(at[0.5].alias("centre"), spread.alias("spread"))
    wide = marks.groupBy("_group").agg(
        *[F.max(F.when(F.col("k") == k, F.col("centre"))).alias(f"m{k}") for k in range(len(FEATURES))],
        *[F.max(F.when(F.col("k") == k, F.col("spread") ** 2)).alias(f"c{k}{k}") for k in range(len(FEATURES))],
    )
    zero = {f"c{i}{j}": F.lit(0.0) for i in range(len(FEATURES)) for j in range(i)}
    return _inverted(wide.withColumns(zero).withColumn("scale", F.lit(1.0)))


def _inverted(estimates: DataFrame) -> DataFrame:
    """Add the inverse covariance ``p{i}{j}`` and ``logdet``, by Cholesky factors of each group's matrix.

    Diagonal entries are raised to the floors first.
    """
    size = range(len(FEATURES))
    df = estimates.withColumns({f"c{i}{i}": F.greatest(F.col(f"c{i}{i}"), F.lit(FLOORS[i] ** 2)) * (1 + 1e-6) for i in size})
    for j in size:
        for i in size[j:]:
            done = reduce(lambda x, k: x - F.col(f"l{i}{k}") * F.col(f"l{j}{k}"), range(j), F.col(f"c{i}{j}"))
            pivot = F.sqrt(F.greatest(done, F.lit(FLOORS[j] ** 2 * 1e-6)))
            df = df.withColumn(f"l{i}{j}", pivot if i == j else done / F.col(f"l{j}{j}"))
    for j in size:
        for i in size[j:]:
            sums = reduce(lambda x, k: x - F.col(f"l{i}{k}") * F.col(f"v{k}{j}"), range(j, i), F.lit(1.0 if i == j else 0.0))
            df = df.withColumn(f"v{i}{j}", sums / F.col(f"l{i}{i}"))
    inverse = {
        f"p{i}{j}": sum((F.col(f"v{k}{i}") * F.col(f"v{k}{j}") for k in size[i:]), F.lit(0.0)) for i in size for j in range(i + 1)
    }
    logdet = 2 * sum((F.log(f"l{i}{i}") for i in size), F.lit(0.0))
    keep = ["_group", "scale", *[f"m{i}" for i in size], *inverse, "logdet"]
    return df.withColumns(inverse).withColumn("logdet", logdet).select(*keep)


def _distance() -> Column:
    """Squared Mahalanobis distance of a row from its group's estimate."""
    z = [F.col(f) - F.col(f"m{i}") for i, f in enumerate(FEATURES)]
    terms = [(1 if i == j else 2) * F.col(f"p{i}{j}") * z[i] * z[j] for i in range(len(z)) for j in range(i + 1)]
    return F.greatest(sum(terms[1:], terms[0]), F.lit(0.0))


def _step(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """One concentration step: the estimate from the nearest rows of each group.

    ``scale`` makes the median distance of the *previous* estimate that of a chi-square.
    """
    size = range(len(FEATURES))
    judged = rows.join(broadcast_if_small(estimates, "_group"), "_group")
    # Entries relative to the centre keep the sums of products small.
    z = {f"z{i}": F.col(f) - F.col(f"m{i}") for i, f in enumerate(FEATURES)}
    near = judged.withColumns(z).withColumn("bin", F.floor(F.log1p(_distance()) * FINE).cast("int"))
    sums = {f"s{i}": F.sum(f"z{i}") for i in size}
    sums |= {f"q{i}{j}": F.sum(F.col(f"z{i}") * F.col(f"z{j}")) for i in size for j in range(i + 1)}
    centre = {f"m{i}": F.first(f"m{i}") for i in size}
    bins = near.groupBy("_group", "bin").agg(F.count("*").alias("n"), *[c.alias(k) for k, c in (sums | centre).items()])
    group = Window.partitionBy("_group")
    total = F.sum("n").over(group)
    before = F.sum("n").over(group.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    ranked = bins.withColumn("inside", before < SUBSET * total).withColumn("lower", before < 0.5 * total)
    chosen = ranked.groupBy("_group").agg(
        F.sum(F.when(F.col("inside"), F.col("n"))).alias("n"),
        *[F.sum(F.when(F.col("inside"), F.col(k))).alias(k) for k in sums],
        *[F.first(k).alias(k) for k in centre],
        F.max(F.when(F.col("lower"), F.expm1((F.col("bin") + 1) / F.lit(float(FINE))))).alias("middle"),
    )
    mean = {i: F.col(f"s{i}") / F.col("n") for i in size}
    fitted = chosen.select(
        "_group",
        F.greatest(F.col("middle") / MEDIAN, F.lit(1.0)).alias("scale"),
        *[(F.col(f"m{i}") + mean[i]).alias(f"m{i}") for i in size],
        *[(F.col(f"q{i}{j}") / F.col("n") - mean[i] * mean[j]).alias(f"c{i}{j}") for i in size for j in range(i + 1)],
    )
    return _inverted(fitted)


def estimates(rows: DataFrame, steps: int = STEPS) -> DataFrame:
    """Estimates of all groups of ``rows`` (features and ``_group``); the last step gives the scale alone."""
    held = checkpointed(_start(rows))
    for _ in range(steps):
        found = checkpointed(_step(rows, held))
        both = found.select("_group", F.col("logdet").alias("now")).join(held.select("_group", "logdet"), "_group")
        falls = both.filter(F.col("now") < F.col("logdet") - 1e-3).isEmpty()
        held = found
        if falls:
            break
    scale = _step(rows, held).select("_group", F.col("scale").alias("_scale"))
    return checkpointed(held.join(scale, "_group").withColumn("scale", F.col("_scale")).drop("_scale"))


def judged(docs: DataFrame, limit: float = LIMIT) -> DataFrame:
    """Every row without its text, with statistics, base_failed, ``distance`` and ``kept``.

    Estimates come from the rows that pass the base rule; ``distance`` is the scaled squared distance,
    NULL for rows that fail it and where no group is large enough.
    """
    narrow = checkpointed(with_features(with_statistics(docs).drop("text")))
    passed = narrow.filter(~F.col("base_failed"))
    groups = broadcast_if_small(checkpointed(_group_of(passed)), "_lang", "_source", "_group")

    def grouped(rows: DataFrame) -> DataFrame:
        same = F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
        return rows.join(groups, same, "left").drop("_lang", "_source")

    learned = checkpointed(grouped(passed).filter("_group is not null").select("_group", *FEATURES))
    fitted = broadcast_if_small(estimates(learned), "_group")
    found = grouped(narrow).join(fitted, "_group", "left")
    distance = F.when(~F.col("base_failed"), _distance() / F.col("scale"))
    columns = [c for c in narrow.columns if c not in FEATURES]
    told = found.withColumn("distance", distance).select(*columns, "distance")
    return told.withColumn("kept", ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= limit))
