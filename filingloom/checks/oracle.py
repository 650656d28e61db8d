"""DuckDB SQL for the registered queries, written from the description of each operator."""

from filingloom.checks.fixtures import AS_OF, EVENTS_AS_OF, LATE_DAYS, STREAM_DAYS

# Building blocks: name -> (the blocks it needs, its SELECT).
BLOCKS: dict[str, tuple[list[str], str]] = {
    "a": (
        [],
        """
        SELECT o_orderkey AS ingest_seq,
          ' ' || base || ext AS "AttachmentName",
          CAST(500000 + o_custkey AS VARCHAR) AS "SCRIP_CD",
          CASE WHEN o_orderkey % 23 = 0 THEN 'n/a'
               ELSE strftime(o_orderdate + to_seconds(o_orderkey * 37 % 86400), '%d/%m/%Y %H:%M:%S')
          END AS "Tradedate",
          CASE o_orderkey % 11 WHEN 0 THEN 'Annual Report' WHEN 1 THEN ' Credit Rating '
               WHEN 2 THEN 'annual report' END AS "Descriptor",
          CASE left(o_orderpriority, 1)
               WHEN '1' THEN 'Investor PRESENTATION'
               WHEN '2' THEN 'Intimation of Credit Rating'
               WHEN '3' THEN 'Transcript of Conference Call'
               WHEN '4' THEN 'Board Meeting'
               ELSE 'Annual Report presentation' END AS "HeadLine",
          '  Body ' || o_orderkey || ' ' AS "NewsBody",
          'https://example.org/' || base || ext AS "ATTACHMENTURL",
          o_orderstatus
        FROM (SELECT *,
                CAST(o_orderkey - CAST(o_orderkey % 10 = 9 AS INT) AS VARCHAR) AS base,
                CASE WHEN o_orderkey % 17 = 0 THEN '.xml' WHEN o_orderkey % 19 = 0 THEN '.PDF'
                     ELSE '.pdf' END AS ext
              FROM orders)""",
    ),
    "m": (
        [],
        """
        SELECT CASE WHEN c_custkey % 13 = 0 THEN NULL
                    ELSE CAST(500000 + c_custkey AS VARCHAR) END AS bsecode,
          CASE WHEN c_custkey % 3 = 0 THEN NULL WHEN c_custkey % 5 = 0 THEN ''
               ELSE 'SYM' || c_custkey END AS nsesymbol,
          trim(c_name) || CASE WHEN c_custkey % 7 = 0 THEN ' Partly Paid' ELSE '' END AS companyname,
          CASE WHEN c_custkey % 9 = 0 THEN 'IN9' ELSE 'INE' END
            || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS isin,
          c_acctbal AS mcap, c_custkey AS load_seq
        FROM customer""",
    ),
    "valid": (
        ["m"],
        """
        SELECT * FROM m
        WHERE bsecode IS NOT NULL AND mcap > 0
          AND NOT contains(isin, 'IN9')
          AND NOT regexp_matches(lower(companyname), 'partly ?paid')""",
    ),
    "master": (
        ["valid"],
        """
        SELECT bsecode AS "SCRIP_CD", isin AS company, nsesymbol AS nse,
          CAST(bsecode AS BIGINT) AS bse, companyname AS company_name,
          CASE WHEN nsesymbol <> '' THEN nsesymbol ELSE bsecode END AS selected
        FROM valid""",
    ),
    "pdf": (
        ["a"],
        """
        SELECT * REPLACE (trim("AttachmentName") AS "AttachmentName"),
          regexp_extract(trim("AttachmentName"), '^(.*)[.]pdf$', 1) AS news_id
        FROM a WHERE trim("AttachmentName") LIKE '%.pdf'""",
    ),
    "listed": (["pdf", "master"], 'SELECT * FROM pdf JOIN master USING ("SCRIP_CD")'),
    "firsts": (
        ["listed"],
        """
        SELECT l.* FROM listed l
        JOIN (SELECT news_id, min(ingest_seq) AS ingest_seq FROM listed GROUP BY news_id)
        USING (news_id, ingest_seq)""",
    ),
    "dated": (
        ["firsts"],
        """
        SELECT *, try_strptime("Tradedate", '%d/%m/%Y %H:%M:%S') AS dt
        FROM firsts WHERE "Tradedate" <> 'n/a'""",
    ),
    "clean": (
        ["dated"],
        """
        SELECT * REPLACE (
            strftime(dt, '%Y-%m-%d %H:%M:%S') AS "Tradedate",
            trim("Descriptor") AS "Descriptor",
            trim(lower("HeadLine")) AS "HeadLine",
            trim(lower("NewsBody")) AS "NewsBody"),
          CASE
            WHEN trim("Descriptor") IN ('Investor Presentation', 'Annual Report', 'Credit Rating',
                                        'Earnings Call Transcript') THEN trim("Descriptor")
            WHEN "HeadLine" ILIKE '%presentation%' THEN 'Investor Presentation'
            WHEN "HeadLine" ILIKE '%annual report%' THEN 'Annual Report'
            WHEN "HeadLine" ILIKE '%credit rating%' THEN 'Credit Rating'
            WHEN "HeadLine" ILIKE '%earnings call%' OR "HeadLine" ILIKE '%conference call%'
              OR "HeadLine" ILIKE '%transcript%' THEN 'Earnings Call Transcript'
            ELSE 'General' END AS category
        FROM dated""",
    ),
    "finished": (
        [],
        """SELECT CAST(o_orderkey AS VARCHAR) AS news_id FROM orders WHERE o_orderstatus = 'F'""",
    ),
    # What the earlier run saw: the same chain over the finished orders.
    "e_firsts": (
        ["listed"],
        """
        SELECT l.* FROM listed l
        JOIN (SELECT news_id, min(ingest_seq) AS ingest_seq FROM listed
              WHERE o_orderstatus = 'F' GROUP BY news_id)
        USING (news_id, ingest_seq)""",
    ),
}


def _same_chain(block: str, source: str, target: str) -> tuple[list[str], str]:
    """A block over another source."""
    needs, text = BLOCKS[block]
    return [target], text.replace(f"FROM {source}", f"FROM {target}")


def _reports(source: str) -> tuple[list[str], str]:
    """Base ids and calendar parts of the report candidates."""
    return (
        [source],
        f"""
        SELECT *, company || '_' || code || '_FY' || cal_year || qtr AS base_id
        FROM (SELECT *, year(dt) AS cal_year,
                CASE quarter(dt) WHEN 1 THEN 'Q3' WHEN 2 THEN 'Q4' WHEN 3 THEN 'Q1' ELSE 'Q2' END
                  AS qtr,
                CASE category WHEN 'Investor Presentation' THEN 'IP' WHEN 'Annual Report' THEN 'AR'
                  WHEN 'Credit Rating' THEN 'CR' ELSE 'ECT' END AS code
              FROM {source} WHERE category <> 'General')""",
    )


def _numbered(source: str, taken: str | None = None) -> tuple[list[str], str]:
    start = f"coalesce((SELECT count(*) FROM {taken} t WHERE t.base_id = s.base_id), 0) + " if taken else ""
    return (
        [source] + ([taken] if taken else []),
        f"""
        SELECT *, base_id || '_' || n AS report_id
        FROM (SELECT s.*, {start}row_number() OVER (PARTITION BY base_id ORDER BY dt, news_id) AS n
              FROM {source} s)""",
    )


BLOCKS["e_dated"] = _same_chain("dated", "firsts", "e_firsts")
BLOCKS["e_clean"] = _same_chain("clean", "dated", "e_dated")
BLOCKS["e_based"] = _reports("e_clean")
BLOCKS["e_reports"] = _numbered("e_based")
BLOCKS["based"] = _reports("clean")
BLOCKS["numbered"] = _numbered("based")
# The stream takes the first row with a good date.
BLOCKS["s_firsts"] = (
    ["listed"],
    """
    SELECT * FROM listed WHERE "Tradedate" <> 'n/a'
    QUALIFY row_number() OVER (PARTITION BY news_id ORDER BY ingest_seq) = 1""",
)
BLOCKS["s_dated"] = _same_chain("dated", "firsts", "s_firsts")
BLOCKS["s_clean"] = _same_chain("clean", "dated", "s_dated")
BLOCKS["s_based"] = _reports("s_clean")
BLOCKS["s_numbered"] = _numbered("s_based")
BLOCKS["fresh_ann"] = (
    ["clean", "finished"],
    "SELECT * FROM clean WHERE news_id NOT IN (SELECT news_id FROM finished)",
)
BLOCKS["fresh_based_all"] = _reports("fresh_ann")
BLOCKS["fresh_based"] = (
    ["fresh_based_all", "e_reports"],
    """
    SELECT * FROM fresh_based_all f
    WHERE NOT EXISTS (SELECT 1 FROM e_reports e
                      WHERE e.news_id = f.news_id AND e.category = f.category)""",
)
BLOCKS["fresh"] = _numbered("fresh_based", "e_reports")
# Second of two batches: everything the first has not stored.
BLOCKS["second_ann"] = (
    ["clean", "e_clean"],
    "SELECT * FROM clean WHERE news_id NOT IN (SELECT news_id FROM e_clean)",
)
BLOCKS["second_based"] = _reports("second_ann")
BLOCKS["second"] = _numbered("second_based", "e_reports")
BLOCKS["copies"] = (
    ["numbered"],
    """
    SELECT *, 2 * CAST(news_id AS BIGINT) AS row_id FROM numbered
    UNION ALL
    SELECT *, 2 * CAST(news_id AS BIGINT) + 1 AS row_id FROM numbered
    WHERE CAST(news_id AS BIGINT) IN
      (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')""",
)
# Every other stored report is gone; numbers go on after the highest left.
BLOCKS["e_even"] = (["e_reports"], "SELECT * FROM e_reports WHERE n % 2 = 0")
BLOCKS["left_based"] = (
    ["fresh_based_all", "e_even"],
    """
    SELECT * FROM fresh_based_all f
    WHERE NOT EXISTS (SELECT 1 FROM e_even e
                      WHERE e.news_id = f.news_id AND e.category = f.category)""",
)
# A stream in three parts with a window: the first row in time with a good date.
BLOCKS["w_firsts"] = (
    ["listed"],
    f"""
    SELECT *, floor(ingest_seq * 3 / ((SELECT max(o_orderkey) FROM orders) + 1)) AS part FROM listed
    WHERE "Tradedate" <> 'n/a' AND strptime("Tradedate", '%d/%m/%Y %H:%M:%S') >=
      date_trunc('day', TIMESTAMP '{AS_OF}' - INTERVAL {STREAM_DAYS - 1} DAY)
    QUALIFY row_number() OVER (PARTITION BY news_id ORDER BY ingest_seq) = 1""",
)
BLOCKS["w_dated"] = _same_chain("dated", "firsts", "w_firsts")
BLOCKS["w_clean"] = _same_chain("clean", "dated", "w_dated")
BLOCKS["w_based"] = _reports("w_clean")
BLOCKS["w_numbered"] = (
    ["w_based"],
    """
    SELECT *, base_id || '_' || n AS report_id
    FROM (SELECT *, row_number() OVER (PARTITION BY base_id ORDER BY part, dt, news_id) AS n
          FROM w_based)""",
)
# A stream in three parts by event time: ids seen in an earlier part are dropped, then late rows.
BLOCKS["x_seen"] = (
    ["a"],
    """
    SELECT * FROM (
      SELECT ingest_seq, ingest_seq % 3 AS part,
        CASE WHEN "Tradedate" <> 'n/a' THEN strptime("Tradedate", '%d/%m/%Y %H:%M:%S') END AS dt,
        CASE WHEN "Tradedate" <> 'n/a' AND "AttachmentName" LIKE '%.pdf' THEN "AttachmentName"
             ELSE 'row ' || ingest_seq END AS seen
      FROM a)
    QUALIFY row_number() OVER (PARTITION BY seen ORDER BY part) = 1""",
)
BLOCKS["x_told"] = (
    ["x_seen"],
    f"""
    SELECT x.*, coalesce(x.dt < high - INTERVAL {LATE_DAYS} DAY, FALSE) AS late
    FROM x_seen x LEFT JOIN (SELECT p.part, max(f.dt) FILTER (f.dt <= TIMESTAMP '{AS_OF}') AS high
                             FROM (VALUES (1), (2)) p(part) JOIN x_seen f ON f.part < p.part GROUP BY p.part) m USING (part)""",
)
BLOCKS["x_firsts"] = (
    ["listed", "x_told"],
    """SELECT l.* FROM listed l JOIN x_told x USING (ingest_seq) WHERE NOT late AND dt IS NOT NULL""",
)
BLOCKS["x_dated"] = _same_chain("dated", "firsts", "x_firsts")
BLOCKS["x_clean"] = _same_chain("clean", "dated", "x_dated")
BLOCKS["replies"] = (
    [],
    """
    SELECT event_id AS reply_id, event_id, user_id, event_type,
      strftime(ts, '%Y%m%d') AS tradedt,
      CASE WHEN day(ts) % 7 = 0 THEN 'http_error'
           WHEN day(ts) % 5 = 0 THEN 'no_record'
           WHEN day(ts) % 11 = 0 THEN 'unexpected_object'
           WHEN day(ts) % 13 = 0 THEN 'unexpected_type'
           WHEN day(ts) % 17 = 0 THEN 'unparseable'
           ELSE 'ok' END AS status_class
    FROM events""",
)
BLOCKS["reply_records"] = (
    ["replies"],
    """
    SELECT reply_id, tradedt, CAST(0 AS BIGINT) AS position, event_id, user_id, event_type
    FROM replies WHERE status_class = 'ok' AND event_type <> 'error'
    UNION ALL
    SELECT reply_id, tradedt, CAST(1 AS BIGINT), event_id, CAST(NULL AS BIGINT), 'copy'
    FROM replies WHERE status_class = 'ok' AND event_type <> 'error'""",
)
BLOCKS["spelled"] = (
    [],
    """
    SELECT event_id, user_id, date_trunc('second', ts) AS at,
      CASE WHEN event_id % 29 = 0 THEN 'bad'
           WHEN event_id % 8 = 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
           WHEN event_id % 8 = 1 THEN strftime(ts, '%Y-%m-%d')
           WHEN event_id % 8 = 2 THEN strftime(ts, '%d/%m/%Y %H:%M:%S')
           WHEN event_id % 8 = 3 THEN strftime(ts, '%d/%m/%Y')
           WHEN event_id % 8 = 4 THEN strftime(ts, '%Y%m%d')
           WHEN event_id % 8 = 5 THEN strftime(ts, '%d-%m-%Y')
           WHEN event_id % 8 = 6 THEN strftime(ts, '%d-%m-%Y %H:%M:%S')
           ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS spelled,
      CASE WHEN event_id % 29 = 0 THEN NULL
           WHEN event_id % 8 IN (1, 3, 4, 5) THEN date_trunc('day', ts)
           ELSE date_trunc('second', ts) END AS meant
    FROM events""",
)
BLOCKS["cursors"] = (
    ["spelled"],
    f"""
    SELECT user_id, spelled AS cursor,
      CASE WHEN meant >= window_start THEN meant ELSE window_start END AS start, today
    FROM (SELECT *, CAST(TIMESTAMP '{EVENTS_AS_OF}' AS DATE)::TIMESTAMP AS today,
            CAST(TIMESTAMP '{EVENTS_AS_OF}' AS DATE)::TIMESTAMP - INTERVAL 4 DAY AS window_start
          FROM spelled
          WHERE event_id IN (SELECT max(event_id) FROM events GROUP BY user_id))""",
)
BLOCKS["live_literal"] = (
    ["cursors"],
    """
    SELECT user_id, cursor, start AS request_ts FROM cursors WHERE start > today
    UNION ALL
    SELECT user_id, cursor, unnest(generate_series(start, today, INTERVAL 1 DAY))
    FROM cursors WHERE start <= today""",
)
BLOCKS["live"] = (
    ["cursors"],
    """
    SELECT user_id, cursor, start AS request_ts FROM cursors WHERE start > today
    UNION ALL
    SELECT user_id, cursor, unnest(generate_series(date_trunc('day', start), today, INTERVAL 1 DAY))
    FROM cursors WHERE start <= today""",
)
BLOCKS["nation_rows"] = (
    [],
    """
    SELECT o_orderkey, o_orderstatus, o_orderdate,
      'N' || c_nationkey || '_FY' || year(o_orderdate) ||
      CASE WHEN month(o_orderdate) <= 3 THEN 'Q3' WHEN month(o_orderdate) <= 6 THEN 'Q4'
           WHEN month(o_orderdate) <= 9 THEN 'Q1' ELSE 'Q2' END AS base_id
    FROM orders JOIN customer ON o_custkey = c_custkey""",
)
BLOCKS["nation_numbered"] = (
    ["nation_rows"],
    """
    SELECT o_orderkey, r.base_id,
      coalesce(taken, 0) + row_number() OVER (PARTITION BY r.base_id ORDER BY o_orderdate, o_orderkey)
        AS "count"
    FROM nation_rows r
    LEFT JOIN (SELECT base_id, count(*) AS taken FROM nation_rows
               WHERE o_orderstatus = 'F' GROUP BY base_id) t ON t.base_id = r.base_id
    WHERE o_orderstatus <> 'F'""",
)


def _sql(body: str, *needs: str) -> str:
    """A query with the blocks it needs, each once and in order."""
    order: list[str] = []

    def add(name: str) -> None:
        for need in BLOCKS[name][0]:
            add(need)
        if name not in order:
            order.append(name)

    for name in needs:
        add(name)
    blocks = ", ".join(f"{name} AS ({BLOCKS[name][1]})" for name in order)
    return f"WITH {blocks} {body}" if order else body


_WHITESPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

_REPORT_COLUMNS = f"""
    company, nse, bse, company_name, selected, news_id,
    strftime(dt, '%Y%m%d') AS datecode,
    cal_year - CAST(month(dt) <= 6 AS INT) AS "Year", qtr AS "Qtr", "Tradedate" AS dt_tm,
    "ATTACHMENTURL" AS url, report_id, "NewsBody" AS report_line, n AS "count",
    '{AS_OF}' AS document_date, category AS report_type"""

_LIVE_RENDERED = "user_id, cursor, strftime(request_ts, '%Y-%m-%d %H:%M:%S') AS request_ts"

_CLAMP = """
    SELECT o_orderkey,
      strftime(least(f, t), '%Y-%m-%d %H:%M:%S') AS from_dt,
      strftime(greatest(f, t), '%Y-%m-%d %H:%M:%S') AS to_dt
    FROM (SELECT o_orderkey,
            CASE WHEN wanted_from IS NULL OR wanted_from < lo OR wanted_from > hi THEN lo
                 ELSE wanted_from END AS f,
            CASE WHEN wanted_to IS NULL OR wanted_to < lo OR wanted_to > hi THEN hi
                 ELSE wanted_to END AS t
          FROM (SELECT o_orderkey, TIMESTAMP '1996-03-01' AS lo, TIMESTAMP '2000-10-31' AS hi,
                  CASE WHEN o_orderstatus <> 'P' THEN filed END AS wanted_from,
                  CASE WHEN o_orderpriority <> '5-LOW'
                       THEN filed + to_hours(CAST(floor(o_totalprice % 5000) AS INT) - 2000) END
                    AS wanted_to
                FROM (SELECT *, o_orderdate + to_seconds(o_orderkey * 37 % 86400) AS filed FROM orders)))"""

ORACLE = {
    "src_announcements": _sql(
        'SELECT ingest_seq AS order_seq, * EXCLUDE (ingest_seq, o_orderstatus) FROM a', "a"
    ),
    "response_triage": _sql(
        """SELECT reply_id, tradedt, status_class,
             CAST(CASE WHEN status_class = 'ok' AND event_type <> 'error' THEN 2 ELSE 0 END AS BIGINT)
               AS n_records FROM replies""",
        "replies",
    ),
    "response_records": _sql("SELECT * FROM reply_records", "reply_records"),
    "per_day_counts": _sql(
        """SELECT tradedt, count(*) AS n, 0 AS is_total FROM reply_records GROUP BY tradedt
           UNION ALL SELECT NULL, count(*), 1 FROM reply_records""",
        "reply_records",
    ),
    "date_spine_hist": """
        SELECT strftime(unnest(generate_series(lo, hi, INTERVAL 1 DAY)), '%Y-%m-%d %H:%M:%S')
          AS request_ts
        FROM (SELECT min(o_orderdate) AS lo,
                max(o_orderdate + to_seconds(o_orderkey * 37 % 86400)) AS hi FROM orders)""",
    "range_clamp": _CLAMP,
    "date_spine_live": _sql(f"SELECT {_LIVE_RENDERED} FROM live", "live"),
    "date_spine_live_literal": _sql(f"SELECT {_LIVE_RENDERED} FROM live_literal", "live_literal"),
    "request_plan": _sql(
        """SELECT user_id, strftime(request_ts, '%Y%m%d') AS tradedt,
             strftime(request_ts, '%H') AS hr, strftime(request_ts, '%M') AS min,
             strftime(request_ts, '%S') AS sec FROM live_literal""",
        "live_literal",
    ),
    "backfill_gaps": _sql(
        """SELECT strftime(d, '%Y%m%d') AS tradedt, '00' AS hr, '00' AS min, '00' AS sec
           FROM (SELECT unnest(generate_series(date_trunc('day', min(ts)), date_trunc('day', max(ts)),
                   INTERVAL 1 DAY)) AS d FROM events)
           WHERE strftime(d, '%Y%m%d') NOT IN (SELECT tradedt FROM reply_records)""",
        "reply_records",
    ),
    "retry_plan": _sql(
        f"""SELECT * FROM (WITH r AS (SELECT e.tradedt, v.ts, e.event_id, status_class = 'ok' AND e.event_type <> 'error' AS good
                     FROM replies e JOIN events v USING (event_id)),
             k AS (SELECT tradedt, ts, good FROM r
                   UNION ALL SELECT tradedt || '-' || (event_id % 97), ts, good FROM r),
             p AS (SELECT strftime(unnest(generate_series(date_trunc('day', min(ts)), date_trunc('day', max(ts)),
                     INTERVAL 1 DAY)), '%Y%m%d') AS tradedt FROM events
                   UNION ALL SELECT DISTINCT tradedt || '-' || (event_id % 97) FROM r),
             w AS (SELECT *, count(*) FILTER (WHERE good) OVER (PARTITION BY tradedt ORDER BY ts
                     ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS wins FROM k),
             g AS (SELECT tradedt, count(*) FILTER (WHERE wins = 0) AS attempts, max(ts) AS last FROM w GROUP BY tradedt),
             n AS (SELECT p.tradedt, attempts, CASE WHEN attempts BETWEEN 1 AND 2
                     THEN last + to_seconds(CASE attempts WHEN 1 THEN 2 ELSE 4 END) END AS next
                   FROM p LEFT JOIN g USING (tradedt))
           SELECT tradedt, coalesce(attempts, 0) AS attempts, strftime(next, '%Y-%m-%d %H:%M:%S') AS not_before,
             CASE WHEN attempts IS NULL THEN 'new' WHEN attempts = 0 THEN 'done' WHEN attempts >= 3 THEN 'given_up'
                  WHEN next > TIMESTAMP '{EVENTS_AS_OF}' THEN 'waiting' ELSE 'due' END AS state FROM n)""",
        "replies",
    ),
    "cursor_log": """
        SELECT event_id, strftime(last_value(moved IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING
            AND 1 PRECEDING), '%Y-%m-%d %H:%M:%S') AS cursor_before,
          strftime(last_value(moved IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING
            AND CURRENT ROW), '%Y-%m-%d %H:%M:%S') AS cursor_after
        FROM (SELECT *, CASE WHEN event_type = 'purchase' THEN date_trunc('minute', ts) END AS moved FROM events)
        WINDOW w AS (PARTITION BY user_id ORDER BY ts)""",
    "union_days": _sql(
        """SELECT * REPLACE (
             CASE WHEN o_orderstatus = 'O' THEN NULL ELSE "ATTACHMENTURL" END AS "ATTACHMENTURL",
             CASE WHEN o_orderstatus = 'P' THEN NULL ELSE "Descriptor" END AS "Descriptor")
           FROM a""",
        "a",
    ),
    "company_master": _sql("SELECT * FROM master", "master"),
    "master_last_wins": _sql(
        """SELECT CAST(code AS VARCHAR) AS "SCRIP_CD", isin AS company, nsesymbol AS nse, code AS bse,
             companyname AS company_name,
             coalesce(nullif(nsesymbol, ''), CAST(code AS VARCHAR)) AS selected
           FROM (SELECT *, load_seq // 3 + 500000 AS code FROM m)
           WHERE mcap > 0 AND isin NOT LIKE '%IN9%' AND companyname NOT ILIKE '%partly paid%'
           QUALIFY load_seq = max(load_seq) OVER (PARTITION BY code)""",
        "m",
    ),
    "existing_news_ids": _sql(
        "SELECT DISTINCT news_id FROM clean WHERE dt >= TIMESTAMP '1998-01-15'", "clean"
    ),
    "existing_report_ids": _sql(
        """SELECT DISTINCT report_id FROM numbered
           WHERE category = 'Credit Rating' AND dt >= TIMESTAMP '1998-01-15'""",
        "numbered",
    ),
    "recheck_scan": _sql(
        f"""SELECT news_id, company, category, "Tradedate" FROM clean
            WHERE category <> 'General'
              AND dt >= date_trunc('day', TIMESTAMP '{AS_OF}' - INTERVAL 400 DAY)""",
        "clean",
    ),
    "semi_by_ids": _sql(
        """SELECT row_id, news_id FROM copies WHERE news_id IN
             (SELECT CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderpriority = '1-URGENT')""",
        "copies",
    ),
    "flatten_json": """
        SELECT event_id, event_type AS "detail.kind",
          CAST(json_extract(props, '$.k') AS BIGINT) AS "detail.props.k" FROM events""",
    "flatten_props": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
    "flatten_mixed": """
        SELECT event_id, CASE WHEN is_object THEN user_id END AS "user.id",
          CASE WHEN is_object THEN event_type END AS "user.detail.kind",
          CASE WHEN is_object AND event_id % 7 = 0 THEN '"high"' WHEN is_object THEN (event_id % 4)::VARCHAR END AS level,
          CASE WHEN is_object AND event_id % 3 = 0 THEN event_type || '|x' END AS tags,
          CASE WHEN is_object AND event_id % 5 <> 0 THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS "extra.k"
        FROM (SELECT *, event_id % 11 <> 0 AS is_object FROM events)""",
    "append_new_only": _sql(
        """SELECT news_id, "SCRIP_CD", ingest_seq FROM pdf
           QUALIFY row_number() OVER (PARTITION BY news_id
             ORDER BY CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END, ingest_seq) = 1""",
        "pdf",
    ),
    "insert_metrics": _sql(
        """SELECT CAST(total AS BIGINT) AS total, inserted, CAST(total - inserted AS BIGINT) AS duplicates
           FROM (SELECT count(*) AS total,
                   count(DISTINCT CASE WHEN news_id NOT IN (SELECT news_id FROM finished)
                                       THEN news_id END) AS inserted FROM pdf)""",
        "pdf",
        "finished",
    ),
    "jsonl_archive": _sql(
        """SELECT ingest_seq, news_id, "HeadLine" FROM pdf
           QUALIFY row_number() OVER (PARTITION BY news_id
             ORDER BY CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END, ingest_seq) = 1""",
        "pdf",
    ),
    "pdf_filter": _sql('SELECT ingest_seq, "AttachmentName", news_id FROM pdf', "pdf"),
    "url_suffix": """
        SELECT page_id, address,
          array_to_string(string_split(address, '/')[:-2], '/') AS parent
        FROM (SELECT page_id, left(url, length(url) - 4) AS address FROM pages
              WHERE url LIKE '%#top')""",
    "known_company": _sql(
        'SELECT ingest_seq, "SCRIP_CD" FROM a WHERE "SCRIP_CD" IN (SELECT bsecode FROM valid)',
        "a",
        "valid",
    ),
    "drop_bad_dates": _sql(
        """SELECT ingest_seq,
             strftime(try_strptime("Tradedate", '%d/%m/%Y %H:%M:%S'), '%Y-%m-%d %H:%M:%S')
               AS "Tradedate"
           FROM a WHERE try_strptime("Tradedate", '%d/%m/%Y %H:%M:%S') IS NOT NULL""",
        "a",
    ),
    "report_candidates": _sql(
        "SELECT news_id, category FROM clean WHERE category <> 'General'", "clean"
    ),
    "trim_all_strings": _sql(
        """SELECT * REPLACE (trim("AttachmentName") AS "AttachmentName",
             trim("Descriptor") AS "Descriptor", trim("NewsBody") AS "NewsBody") FROM a""",
        "a",
    ),
    "trim_documents": f'SELECT doc_id, trim(text, {_WHITESPACE}) AS text FROM documents',
    "parse_tradedate": _sql(
        """SELECT ingest_seq,
             strftime(try_strptime("Tradedate", '%d/%m/%Y %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS trade_ts
           FROM a""",
        "a",
    ),
    "parse_multi_format": _sql(
        "SELECT event_id, spelled, strftime(meant, '%Y-%m-%d %H:%M:%S') AS parsed FROM spelled",
        "spelled",
    ),
    "datecode": "SELECT event_id, strftime(ts, '%Y%m%d') AS datecode FROM events",
    "fiscal_calendar": """
        SELECT o_orderkey, month(o_orderdate) AS cal_month, year(o_orderdate) AS cal_year,
          'Q' || ((quarter(o_orderdate) + 1) % 4 + 1) AS fin_qtr,
          year(o_orderdate - INTERVAL 6 MONTH) AS fin_year
        FROM orders""",
    "bucketize": """
        SELECT o_orderkey,
          CASE WHEN o_totalprice <= 0 OR o_totalprice > 300000 THEN NULL
               WHEN o_totalprice <= 1000 THEN 'tiny' WHEN o_totalprice <= 50000 THEN 'small'
               WHEN o_totalprice <= 150000 THEN 'middle' ELSE 'large' END AS bucket
        FROM orders""",
    "enrich_company": _sql(
        """SELECT ingest_seq, "SCRIP_CD", company, nse, bse, company_name, selected
           FROM a JOIN master USING ("SCRIP_CD")""",
        "a",
        "master",
    ),
    "new_announcements": _sql(
        """SELECT ingest_seq, news_id FROM pdf
           WHERE news_id NOT IN (SELECT news_id FROM finished)""",
        "pdf",
        "finished",
    ),
    "new_reports": _sql(
        """SELECT news_id, category FROM clean c WHERE category <> 'General'
             AND NOT EXISTS (SELECT 1 FROM e_reports e
                             WHERE e.news_id = c.news_id AND e.category = c.category)""",
        "clean",
        "e_reports",
    ),
    "ids_difference": _sql(
        "SELECT news_id FROM pdf EXCEPT SELECT news_id FROM finished", "pdf", "finished"
    ),
    "dedup_first": _sql(
        """SELECT ingest_seq, news_id, "SCRIP_CD" FROM pdf
           QUALIFY ingest_seq = min(ingest_seq) OVER (PARTITION BY news_id)""",
        "pdf",
    ),
    "dedup_documents": """
        SELECT doc_id, lang, source, n_chars FROM documents
        WHERE doc_id IN (SELECT min(doc_id) FROM documents GROUP BY text)""",
    "duplicate_groups": _sql(
        """SELECT news_id, count(*) AS n_rows, min(row_id) AS keep_id FROM copies
           GROUP BY news_id HAVING count(*) > 1""",
        "copies",
    ),
    "duplicates_to_delete": _sql(
        """SELECT row_id, news_id, report_id FROM copies
           QUALIFY row_number() OVER (PARTITION BY news_id ORDER BY row_id) > 1""",
        "copies",
    ),
    "duplicates_kept": _sql(
        """SELECT row_id, news_id, report_id FROM copies
           QUALIFY row_number() OVER (PARTITION BY news_id ORDER BY row_id) = 1""",
        "copies",
    ),
    "duplicates_of_listed_ids": _sql(
        """SELECT row_id, news_id FROM copies
           QUALIFY row_number() OVER (PARTITION BY news_id ORDER BY row_id) = 1
             OR CAST(news_id AS BIGINT) NOT IN
                (SELECT o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey
                 WHERE c_mktsegment = 'BUILDING')""",
        "copies",
    ),
    "remove_duplicates": _sql(
        """SELECT min(row_id) AS row_id, news_id, report_id FROM copies
           GROUP BY news_id, report_id""",
        "copies",
    ),
    "categorise": _sql(
        """SELECT ingest_seq,
             CASE WHEN ingest_seq % 11 = 0 THEN 'Annual Report'
                  WHEN ingest_seq % 11 = 1 THEN 'Credit Rating'
                  WHEN regexp_matches("HeadLine", '(?i)presentation') THEN 'Investor Presentation'
                  WHEN regexp_matches("HeadLine", '(?i)annual report') THEN 'Annual Report'
                  WHEN regexp_matches("HeadLine", '(?i)credit rating') THEN 'Credit Rating'
                  WHEN regexp_matches("HeadLine", '(?i)earnings call|conference call|transcript')
                    THEN 'Earnings Call Transcript'
                  ELSE 'General' END AS category
           FROM a""",
        "a",
    ),
    "categorise_documents": """
        SELECT doc_id,
          CASE WHEN regexp_matches(text, '(?i)licen[cs]e|copyright') THEN 'Licence'
               WHEN regexp_matches(text, '(?i)@[a-z]+[.]|phone|e-mail') THEN 'Contact'
               WHEN regexp_matches(text, '(?i)[a-z]{14}') THEN 'Long words'
               WHEN regexp_matches(text, '(?i) the ') OR contains(source, 'src1') THEN 'The'
               ELSE 'Other' END AS category
        FROM documents""",
    "categorise_by_rule_table": """
        WITH words AS (
          SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]{5,}')) AS w FROM benchmark),
        rules AS (SELECT w, row_number() OVER (ORDER BY length(w) DESC, w) AS precedence FROM words),
        hits AS (
          SELECT doc_id, min_by(w, precedence) AS w
          FROM documents JOIN rules ON contains(lower(text), w) GROUP BY doc_id)
        SELECT d.doc_id,
          CASE WHEN regexp_matches(text, '(?i)@[a-z]+[.]|phone|e-mail') THEN 'Contact'
               WHEN regexp_matches(text, '(?i)licen[cs]e|copyright') THEN 'Licence'
               WHEN h.w IS NOT NULL THEN 'word ' || h.w
               WHEN regexp_matches(text, '(?i)[a-z]{14}') THEN 'Long words'
               WHEN regexp_matches(text, '(?i) the ') OR contains(source, 'src1') THEN 'The'
               ELSE 'Other' END AS category
        FROM documents d LEFT JOIN hits h USING (doc_id)""",
    "category_counts": _sql("SELECT category, count(*) AS n FROM clean GROUP BY category", "clean"),
    "clean_announcements": _sql(
        """SELECT ingest_seq, news_id, "SCRIP_CD", company, selected, "Tradedate", "Descriptor",
             "HeadLine", "NewsBody", category FROM fresh_ann""",
        "fresh_ann",
    ),
    "clean_after_parse": _sql(
        """SELECT ingest_seq, news_id,
             strftime(try_strptime("Tradedate", '%d/%m/%Y %H:%M:%S'), '%Y-%m-%d %H:%M:%S')
               AS "Tradedate",
             trim("Descriptor") AS "Descriptor", "HeadLine", trim("NewsBody") AS "NewsBody",
             CASE WHEN ingest_seq % 11 = 0 THEN 'Annual Report'
                  WHEN ingest_seq % 11 = 1 THEN 'Credit Rating'
                  WHEN "HeadLine" ILIKE '%presentation%' THEN 'Investor Presentation'
                  WHEN "HeadLine" ILIKE '%credit rating%' THEN 'Credit Rating'
                  WHEN "HeadLine" ILIKE '%transcript%' THEN 'Earnings Call Transcript'
                  ELSE 'General' END AS category
           FROM (SELECT * FROM listed WHERE "Tradedate" <> 'n/a'
                 QUALIFY row_number() OVER (PARTITION BY news_id ORDER BY ingest_seq) = 1)
           WHERE news_id NOT IN (SELECT news_id FROM finished)""",
        "listed",
        "finished",
    ),
    "base_report_id": _sql(
        "SELECT news_id, code, base_id AS base_report_id FROM based", "based"
    ),
    "report_id_prefix": _sql("SELECT report_id, base_id AS prefix FROM numbered", "numbered"),
    "existing_counts": _sql(
        "SELECT base_id AS base_report_id, count(*) AS n FROM numbered GROUP BY base_id", "numbered"
    ),
    "existing_counts_since": _sql(
        """SELECT base_id AS base_report_id, count(*) AS n FROM numbered
           WHERE dt >= TIMESTAMP '1998-02-15' GROUP BY base_id""",
        "numbered",
    ),
    "report_numbering": _sql("SELECT * FROM nation_numbered", "nation_numbered"),
    "report_numbering_spread": """
        SELECT o_orderkey, o_orderpriority,
          row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey) AS "count"
        FROM orders""",
    "report_numbering_spread_started": """
        SELECT o_orderkey, o_orderpriority,
          (SELECT count(*) FROM orders f WHERE f.o_orderstatus = 'F'
             AND f.o_orderpriority = o.o_orderpriority)
            + row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey) AS "count"
        FROM orders o WHERE o_orderstatus <> 'F'""",
    "compact_store": _sql(
        """SELECT news_id, report_id, category AS report_type, n AS "count" FROM e_reports
           UNION ALL SELECT news_id, report_id, category, n FROM second""",
        "e_reports",
        "second",
    ),
    "reports_full": _sql(f"SELECT {_REPORT_COLUMNS} FROM numbered", "numbered"),
    "reports_continued": _sql(f"SELECT {_REPORT_COLUMNS} FROM fresh", "fresh"),
    "maintained_counts": _sql(
        """SELECT regexp_replace(report_id, '_[^_]*$', '') AS base_report_id, count(*) AS n
           FROM (SELECT report_id FROM e_reports UNION ALL SELECT report_id FROM second)
           GROUP BY 1""",
        "e_reports",
        "second",
    ),
    "ingest_batches": _sql(
        """SELECT news_id, report_id, category AS report_type, n AS "count", 'run-1' AS batch
           FROM e_reports
           UNION ALL
           SELECT news_id, report_id, category, n, 'run-2' FROM second""",
        "e_reports",
        "second",
    ),
    "recheck_reports": _sql(
        f"""SELECT news_id, base_id || '_' || "count" AS report_id, "count" FROM (
              SELECT s.news_id, s.base_id,
                (SELECT count(*) FROM e_reports e WHERE e.base_id = s.base_id)
                  + row_number() OVER (PARTITION BY s.base_id ORDER BY s.dt, s.news_id) AS "count"
              FROM second_based s
              WHERE s.dt >= date_trunc('day', TIMESTAMP '{AS_OF}' - INTERVAL 400 DAY))""",
        "second_based",
        "e_reports",
    ),
    "src_rejects": """
        SELECT CASE o_orderkey % 7 WHEN 0 THEN left(line, length(line) - 5)
                 WHEN 1 THEN CAST(o_orderkey AS VARCHAR) WHEN 2 THEN line || ' x'
                 WHEN 3 THEN '[' || line || ']' ELSE line END AS record,
          CAST(o_orderkey % 7 > 3 AS INT) AS good
        FROM (SELECT o_orderkey, '{"order_seq":' || o_orderkey || ',"AttachmentName":" ' ||
                CAST(o_orderkey - CAST(o_orderkey % 10 = 9 AS INT) AS VARCHAR) ||
                CASE WHEN o_orderkey % 17 = 0 THEN '.xml' WHEN o_orderkey % 19 = 0 THEN '.PDF'
                     ELSE '.pdf' END || '"}' AS line
              FROM orders)""",
    "response_rejects": """
        WITH e AS (SELECT event_id, '{"event_id":' || event_id || ',"event_type":"' || event_type || '"}'
                     AS record FROM events)
        SELECT event_id AS reply_id, CAST(1 AS BIGINT) AS position, 'no_object' AS reason, '7' AS text
        FROM e WHERE event_id % 6 = 0
        UNION ALL
        SELECT event_id, 2, 'no_object', '"' || event_id || '"' FROM e WHERE event_id % 6 = 0
        UNION ALL
        SELECT event_id, NULL, 'unparseable', '[' || record || '] tail' FROM e WHERE event_id % 6 = 1
        UNION ALL
        SELECT event_id, NULL, 'unparseable', '[' || record || ',{"event_id"' FROM e WHERE event_id % 6 = 2
        UNION ALL
        SELECT event_id, NULL, 'unparseable', replace('[' || record || ']', '"', chr(39)) FROM e
        WHERE event_id % 6 = 3
        UNION ALL
        SELECT event_id, NULL, 'unexpected_object', record FROM e WHERE event_id % 6 = 5""",
    "response_mixed": """
        SELECT event_id AS reply_id, CAST(p AS BIGINT) AS position, event_id, event_type
        FROM events, (VALUES (0), (1)) t(p)
        WHERE event_id % 6 = 4 OR (event_id % 6 = 0 AND p = 0)""",
    "stored_announcements": _sql(
        """SELECT news_id, "SCRIP_CD", company, selected, "Tradedate", "HeadLine", category,
             o_orderstatus AS status FROM clean""",
        "clean",
    ),
    "run_metrics": _sql(
        """SELECT (SELECT count(*) FROM a) AS offered,
             (SELECT count(*) FROM a) - (SELECT count(*) FROM pdf) AS no_attachment,
             (SELECT count(*) FROM pdf) - (SELECT count(*) FROM listed) AS unknown_company,
             (SELECT count(*) FROM listed WHERE "Tradedate" = 'n/a') AS bad_date,
             (SELECT count(*) - count(DISTINCT news_id) FROM listed) AS repeated,
             (SELECT count(DISTINCT news_id) FROM listed
              WHERE news_id IN (SELECT news_id FROM finished)) AS stored_before""",
        "listed",
        "finished",
    ),
    "archived_run": _sql(
        """SELECT DISTINCT news_id, 'normal' AS data_type FROM pdf
           UNION ALL SELECT news_id, 'filter' FROM clean""",
        "clean",
    ),
    "batch_rerun": _sql(
        """SELECT news_id, company, category, "Tradedate", 'run' AS batch FROM e_clean""", "e_clean"
    ),
    "numbers_after_removal": _sql(
        """SELECT news_id, base_id || '_' || "count" AS report_id, "count", category AS report_type
           FROM (SELECT s.*,
                   coalesce((SELECT greatest(count(*), max(n)) FROM e_even e
                             WHERE e.base_id = s.base_id), 0)
                     + row_number() OVER (PARTITION BY base_id ORDER BY dt, news_id) AS "count"
                 FROM left_based s)""",
        "left_based",
        "e_even",
    ),
    "recheck_all_history": _sql('SELECT news_id, report_id, n AS "count" FROM second', "second"),
    "stream_batches": _sql(
        """SELECT c.news_id, c.company, c.category, c."Tradedate", report_id,
             r.category AS report_type, n AS "count"
           FROM w_clean c LEFT JOIN w_numbered r USING (news_id)""",
        "w_clean",
        "w_numbered",
    ),
    "stream_late": _sql(
        f"""SELECT ingest_seq AS order_seq FROM a WHERE "Tradedate" <> 'n/a'
              AND strptime("Tradedate", '%d/%m/%Y %H:%M:%S') <
                date_trunc('day', TIMESTAMP '{AS_OF}' - INTERVAL {STREAM_DAYS - 1} DAY)""",
        "a",
    ),
    "stream_event_time": _sql(
        """SELECT ingest_seq AS order_seq, 'stored' AS kind FROM x_clean
           UNION ALL SELECT ingest_seq, 'late' FROM x_told WHERE late""",
        "x_clean",
        "x_told",
    ),
    "stream_ingest": _sql(
        """SELECT news_id, report_id, category AS report_type, n AS "count", "Tradedate" AS dt_tm
           FROM s_numbered""",
        "s_numbered",
    ),
}
ORACLE["src_array_layout"] = ORACLE["src_big_arrays"] = ORACLE["src_announcements"]
ORACLE["rerun_after_later_batch"] = ORACLE["ingest_batches"]
ORACLE["new_announcements_narrow"] = ORACLE["new_announcements"]
