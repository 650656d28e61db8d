"""Operators on small tables, with the traps written out."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from filingloom.operators import announcements as ann
from filingloom.operators import counts, keys, numbering, reports, shape
from filingloom.operators.master import company_master
from filingloom.schemas import COMPANY_MASTER, REPORTS
from filingloom.sinks import workspace
from filingloom.sources.stored import empty_table

RAW = (
    "ingest_seq long, AttachmentName string, SCRIP_CD string, Tradedate string, "
    "Descriptor string, HeadLine string, NewsBody string, ATTACHMENTURL string"
)


def raw(spark, *rows):
    """(seq, attachment, code, date, headline) with the rest filled in."""
    full = [(s, a, c, d, None, h, f" Body {s} ", f"u{s}") for s, a, c, d, h in rows]
    return spark.createDataFrame(full, RAW)


def small_master(spark):
    rows = [("1", "N1", "One", "INE1", 5.0, 1), ("2", "", " Two ", None, 5.0, 2)]
    return company_master(spark.createDataFrame(rows, COMPANY_MASTER))


# --- company master ---------------------------------------------------------------------------


def test_company_master_traps(spark):
    rows = [
        ("1", "NSE1", " One\t", "INE1", 1.0, 1),
        ("2", "", "Two", "INE2", 1.0, 2),
        ("3", None, None, None, 1.0, 3),
        (" 04 ", "N4", "Four", "INE4", 1.0, 4),
        (None, "N5", "Five", "INE5", 1.0, 5),
        ("6", "N6", "Six", "INE6", 0.0, 6),
        ("7", "N7", "Seven", "INE7", None, 7),
        ("8", "N8", "Eight", "XIN9Y", 1.0, 8),
        ("9", "N9", "Nine PARTLY PAID", "INE9", 1.0, 9),
        ("10", "N10", "Ten partlypaid", "INE10", 1.0, 10),
        ("11", "N11", "Eleven partly  paid", "INE11", 1.0, 11),
        ("abc", "N12", "Twelve", "INE12", 1.0, 12),
        ("500325.0", "N13", "Thirteen", "INE13", 1.0, 13),
        ("14", "OLD", "Old", "INEOLD", 1.0, 14),
        ("14", "NEW", "New", "INENEW", 1.0, 15),
        ("14", "BAD", "Bad", "IN9", 1.0, 16),
    ]
    out = company_master(spark.createDataFrame(rows, COMPANY_MASTER)).collect()
    got = {r.SCRIP_CD: (r.company, tuple(r.symbolmap)) for r in out}
    assert got == {
        "1": ("INE1", ("NSE1", 1, "One", "NSE1")),
        "2": ("INE2", ("", 2, "Two", "2")),
        "3": (None, (None, 3, "", "3")),
        "4": ("INE4", ("N4", 4, "Four", "N4")),
        "11": ("INE11", ("N11", 11, "Eleven partly  paid", "N11")),
        "14": ("INENEW", ("NEW", 14, "New", "NEW")),
    }


# --- cleaning ---------------------------------------------------------------------------------

GOOD, BAD = "1/9/2025 10:11:12", "30/02/2025 10:00:00"


def test_clean_traps(spark):
    rows = raw(
        spark,
        (1, " a.pdf ", " 1 ", GOOD, "Credit RATING"),
        (2, "b.PDF", "1", GOOD, "x"),
        (3, "c.pdf.xml", "1", GOOD, "x"),
        (4, "d.pdf", "01", GOOD, "x"),
        (5, "e.pdf", "3", GOOD, "x"),
        (6, "f.pdf", "2", BAD, "x"),
        (7, None, "1", GOOD, "x"),
        (8, "g.pdf", None, GOOD, "x"),
        (9, "h.pdf", "2", GOOD, None),
        (10, "known.pdf", "2", GOOD, "x"),
        (11, ".pdf", "1", GOOD, "x"),
    )
    known = spark.createDataFrame([("known",), ("known",), (None,)], "news_id string")
    out = ann.clean_announcements(rows, small_master(spark), known).collect()
    got = {r.news_id: (r.company, r.Tradedate, r.HeadLine, r.NewsBody, r.category) for r in out}
    at = "2025-09-01 10:11:12"
    assert got == {
        "a": ("INE1", at, "credit rating", "body 1", "Credit Rating"),
        "h": (None, at, None, "body 9", "General"),
        "": ("INE1", at, "x", "body 11", "General"),
    }


def test_first_row_before_and_after_parsing(spark):
    rows = raw(
        spark,
        (1, "a.pdf", "9", GOOD, "unknown company"),
        (2, "a.pdf", "1", BAD, "bad date"),
        (3, "a.pdf", "1", GOOD, "Third"),
        (4, "a.pdf", "2", GOOD, "fourth"),
    )
    master = small_master(spark)
    assert ann.clean_announcements(rows, master).count() == 0
    out = ann.clean_announcements(rows, master, dedup="after_parse", preserve_case=True).collect()
    assert [(r.ingest_seq, r.HeadLine, r.NewsBody) for r in out] == [(3, "Third", "Body 3")]
    with pytest.raises(ValueError):
        ann.clean_announcements(rows, master, dedup="never")


def test_categorise_without_text_columns(spark):
    df = spark.createDataFrame([("Annual Report",)], "Descriptor string")
    assert ann.categorise(df).first().category == "Annual Report"


# --- keys -------------------------------------------------------------------------------------


@pytest.fixture
def copies(spark):
    """Half of all rows share one key; some have none."""
    row = F.col("id")
    key = F.when(row % 2 == 0, "hot").when(row % 31 == 0, None).otherwise((row % 97).cast("string"))
    return spark.range(3000).select(
        key.alias("news_id"), (row * 7919 % 3001).alias("row_id"), row.alias("v")
    )


def by_key(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r.news_id].append(r)
    return {k: sorted(g, key=lambda r: r.row_id) for k, g in groups.items()}


def test_first_and_last_per_key(copies):
    groups = by_key(copies.collect())
    first = {r.news_id: r.row_id for r in keys.keep_first(copies, "news_id", ["row_id"]).collect()}
    assert first == {k: g[0].row_id for k, g in groups.items()}
    last = {r.news_id: r.row_id for r in keys.keep_last(copies, "news_id", ["row_id"]).collect()}
    assert last == {k: g[-1].row_id for k, g in groups.items()}


def test_surplus_against_brute_force(spark, copies):
    groups = by_key(copies.collect())
    surplus = {r.row_id for k, g in groups.items() if k is not None for r in g[1:]}
    assert {r.row_id for r in keys.surplus_rows(copies).collect()} == surplus
    everything = {r.row_id for g in groups.values() for r in g}
    assert {r.row_id for r in keys.without_surplus(copies).collect()} == everything - surplus
    dup = {r.news_id: (r.n_rows, r.keep_id) for r in keys.duplicate_groups(copies).collect()}
    assert dup == {k: (len(g), g[0].row_id) for k, g in groups.items() if len(g) > 1}

    ids = spark.createDataFrame([("hot",), ("5",), ("5",), ("absent",)], "news_id string")
    listed = {r.row_id for k in ("hot", "5") for r in groups[k][1:]}
    assert {r.row_id for r in keys.surplus_rows(copies, ids).collect()} == listed
    assert {r.row_id for r in keys.without_surplus(copies, ids).collect()} == everything - listed


def test_exclusion_keeps_null_keys_and_ignores_repeats(spark, copies):
    known = spark.createDataFrame([("hot",), ("hot",), (None,)], "news_id string")
    for narrow in (False, True):
        left = keys.without_keys(copies, known, "news_id", narrow_first=narrow).collect()
        assert sorted(r.v for r in left) == sorted(
            r.v for r in copies.collect() if r.news_id != "hot"
        )
    assert {r.news_id for r in keys.distinct_keys(copies, "news_id").collect()} >= {"hot", "1"}
    assert "" not in {r.news_id for r in keys.distinct_keys(copies, "news_id").collect()}


# --- numbering --------------------------------------------------------------------------------


@pytest.fixture
def skewed(spark):
    """One group with more than a third of the rows, all at one time; many small groups."""
    row = F.col("id")
    hot = row % 5 < 2
    return spark.range(5000).select(
        F.when(hot, "hot").when(row % 101 == 0, None).otherwise((row % 211).cast("string")).alias("g"),
        F.when(hot, 0).otherwise(row * 31 % 17).alias("t"),
        F.sha2(row.cast("string"), 256).alias("id"),
    )


def expected_numbers(rows, start):
    groups = defaultdict(list)
    for r in rows:
        if r.g is not None:
            groups[r.g].append((r.t, r.id))
    return {
        (g, id): start.get(g, 0) + i
        for g, members in groups.items()
        for i, (_, id) in enumerate(sorted(members), 1)
    }


@pytest.mark.parametrize("limit", [10, 300, 10_000])
@pytest.mark.parametrize("broadcast_rows", [0, 100])
def test_numbers_do_not_depend_on_the_way(spark, skewed, limit, broadcast_rows, monkeypatch):
    monkeypatch.setattr(workspace, "MAX_BROADCAST_ROWS", broadcast_rows)
    start = spark.createDataFrame([("hot", 7), ("3", 2), ("absent", 9)], "g string, n long")
    out = numbering.number_within(skewed, "g", ["t", "id"], start, max_group_rows=limit)
    got = {(r.g, r.id): r["count"] for r in out.collect()}
    assert got == expected_numbers(skewed.collect(), {"hot": 7, "3": 2})
    assert dict(out.dtypes)["count"] == "bigint"


def test_known_small_input_skips_the_sizes(spark, skewed):
    options = {"max_group_rows": 5000, "rows_at_most": 5000}
    out = numbering.number_within(skewed, "g", ["t", "id"], **options)
    assert {(r.g, r.id): r["count"] for r in out.collect()} == expected_numbers(skewed.collect(), {})


def test_spread_groups_use_many_tasks(spark, skewed):
    hot = skewed.where("g = 'hot'")
    out = numbering.number_within(hot, "g", ["t", "id"], max_group_rows=100)
    sizes = out.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) > 1 and max(r["count"] for r in sizes) < 2000


@pytest.mark.parametrize("taken", [None, 5])
def test_a_small_limit_makes_no_task_per_few_rows(spark, taken):
    rows = spark.range(600).select(F.lit("hot").alias("g"), "id")
    start = None if taken is None else spark.createDataFrame([("hot", taken)], "g string, n long")
    out = numbering.number_within(rows, "g", ["id"], start, max_group_rows=2)
    assert out.rdd.getNumPartitions() <= 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sorted((r.id, r["count"]) for r in out.collect()) == [(k, k + 1 + (taken or 0)) for k in range(600)]


def test_parts_grow_with_the_rows_once_they_are_many(spark):
    most = numbering.MAX_GROUP_ROWS
    assert numbering._parts(spark, 100 * most, 100) == numbering._parts(spark, 100 * most, most) == 200


# --- reports ----------------------------------------------------------------------------------


def announcements(spark, *rows):
    df = spark.createDataFrame(rows, "news_id string, company string, category string, t string")
    return df.select("*", F.col("t").cast("timestamp_ntz").alias("dt")).drop("t")


def stored_reports(spark, *rows):
    df = spark.createDataFrame(
        rows, "report_id string, news_id string, report_type string, dt_tm string"
    )
    missing = [f for f in REPORTS.fields if f.name not in df.columns]
    return df.select(
        "*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing]
    ).select(REPORTS.fieldNames())


def test_reports_continue_after_stored_ones(spark):
    rows = announcements(
        spark,
        ("n1", "C", "Credit Rating", "2025-02-10 10:00:00"),
        ("n3", "C", "Credit Rating", "2025-02-11 10:00:00"),
        ("n2", "C", "Credit Rating", "2025-02-11 10:00:00"),
        ("n4", "C", "Annual Report", "2025-02-11 10:00:00"),
        ("n5", None, "Annual Report", "2025-02-11 10:00:00"),
        ("n6", "C", "General", "2025-02-11 10:00:00"),
        ("n7", "C", "Credit Rating", "2025-04-01 00:00:00"),
        ("old", "C", "Credit Rating", "2025-02-01 00:00:00"),
    )
    before = stored_reports(
        spark,
        ("C_CR_FY2025Q3_1", "old", "Credit Rating", "2025-02-01 00:00:00"),
        ("C_CR_FY2025Q3_1", "again", "Credit Rating", "2025-02-01 00:00:00"),
        ("C_CR_FY2025Q3_9", "other", "Credit Rating", "2025-01-01 00:00:00"),
        ("", "none", "Credit Rating", "2025-01-01 00:00:00"),
        ("C_AR_FY2025Q3_1", "n1", "Annual Report", "2025-01-01 00:00:00"),
    )

    def ids(**options):
        out = reports.build_reports(rows, before, "2025-05-01 00:00:00", **options)
        return {r.news_id: (r.report_id, r.Year, r.Qtr, r["count"]) for r in out.collect()}

    # Numbers follow the highest stored one, which removals leave above the count.
    assert ids() == {
        "n1": ("C_CR_FY2025Q3_10", 2024, "Q3", 10),
        "n2": ("C_CR_FY2025Q3_11", 2024, "Q3", 11),
        "n3": ("C_CR_FY2025Q3_12", 2024, "Q3", 12),
        "n4": ("C_AR_FY2025Q3_2", 2024, "Q3", 2),
        "n7": ("C_CR_FY2025Q4_1", 2024, "Q4", 1),
    }
    assert ids(literal_count=True) == {
        "n1": ("C_CR_FY2025Q3_3", 2024, "Q3", 3),
        "n2": ("C_CR_FY2025Q3_4", 2024, "Q3", 4),
        "n3": ("C_CR_FY2025Q3_5", 2024, "Q3", 5),
        "n4": ("C_AR_FY2025Q3_2", 2024, "Q3", 2),
        "n7": ("C_CR_FY2025Q4_1", 2024, "Q4", 1),
    }
    assert ids(since="2025-02-01 00:00:00")["n1"][3] == 2
    assert ids(literal_no_op=True, literal_count=True)["old"][0] == "C_CR_FY2025Q3_3"


def test_report_ids_are_contiguous(spark):
    row = F.col("id")
    rows = spark.range(2000).select(
        row.cast("string").alias("news_id"),
        (row % 7).cast("string").alias("company"),
        F.lit("Annual Report").alias("category"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(hours=(row % 5000))).alias("dt"),
    )
    out = reports.build_reports(rows, empty_table(spark, REPORTS), max_group_rows=50)
    per_base = defaultdict(list)
    for r in out.collect():
        base, number = r.report_id.rsplit("_", 1)
        per_base[base].append(int(number))
        assert int(number) == r["count"]
    assert sum(map(len, per_base.values())) == 2000
    assert all(sorted(n) == list(range(1, len(n) + 1)) for n in per_base.values())


# --- shape and counts -------------------------------------------------------------------------


def test_optional_default_and_flatten(spark):
    df = spark.createDataFrame([(1, ("x", (2,)))], "a int, `b.c` struct<d:string,e:struct<f:int>>")
    flat = shape.flatten(df)
    assert flat.columns == ["a", "b.c.d", "b.c.e.f"] and flat.collect()[0] == (1, "x", 2)
    assert df.select(shape.optional(df, "gone", "bigint").alias("g")).dtypes == [("g", "bigint")]
    assert shape.with_default(df, "category", "General").first().category == "General"
    assert shape.with_default(df, "a", 9).first().a == 1


def test_insert_metrics_counts_repeats(spark):
    batch = spark.createDataFrame([("a",), ("a",), ("b",), ("c",)], "news_id string")
    before = spark.createDataFrame([("b",), ("b",)], "news_id string")
    assert tuple(counts.insert_metrics(batch, before).first()) == (4, 2, 2)
    assert tuple(counts.insert_metrics(batch.limit(0), before).first()) == (0, 0, 0)


@pytest.mark.parametrize("limit", [2, 5, numbering.MAX_GROUP_ROWS])
def test_given_numbers_stay_and_do_not_count(spark, limit):
    """Rows with a number keep it, whichever way their group is numbered."""
    rows = [("big", 1, 7), ("big", 2, None), ("big", 3, 2), ("big", 4, None), ("big", 5, None), ("big", 6, 9)]
    rows += [("small", 7, None), ("kept", 8, 4), (None, 9, 1)]
    df = spark.createDataFrame(rows, "g string, id int, had bigint")
    start = spark.createDataFrame([("big", 9), ("kept", 4)], "g string, n long")
    out = numbering.number_within(df, "g", ["id"], start, max_group_rows=limit, given="had")
    assert {r.id: r["count"] for r in out.collect()} == {1: 7, 2: 10, 3: 2, 4: 11, 5: 12, 6: 9, 7: 1, 8: 4}


def test_own_reports_keep_number_and_id(spark):
    """Also where a news id was reported under two base ids, or the stored id is not spelled from the number."""
    dt = F.lit("2025-08-01").cast("timestamp_ntz")
    news = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "news_id string").select(
        "news_id", F.lit("C").alias("company"), F.lit("Credit Rating").alias("category"), dt.alias("dt")
    )
    own = spark.createDataFrame(
        [("a", "C_CR_FY2025Q1_07", 7), ("a", "D_CR_FY2025Q1_1", 1), ("b", "D_CR_FY2025Q1_2", 2), (None, "x_1", 1)],
        "news_id string, report_id string, count bigint",
    ).withColumn("report_type", F.lit("Credit Rating"))
    made = reports.build_reports(news, empty_table(spark, REPORTS), "2025-08-10 00:00:00", own=own)
    found = {r.news_id: (r["count"], r.report_id) for r in made.collect()}
    assert found["a"] == (7, "C_CR_FY2025Q1_07")
    assert {found[k] for k in ("b", "c", None)} == {(n, f"C_CR_FY2025Q1_{n}") for n in (8, 9, 10)}
