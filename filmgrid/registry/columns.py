"""Single-row expressions over whole tables: text, dates, numbers, nested values, HTML."""

from __future__ import annotations

from pyspark.sql import functions as F

from filmgrid.functions import dates, html, nested, numbers, text
from filmgrid.operators import calendar, reshape
from filmgrid.plans import cleaning
from filmgrid.registry import Query
from filmgrid.registry.views import chart, ship_day, table
from filmgrid.sources import readers

SPACES = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"


def _strip_sql(value):
    return f"regexp_replace({value}, '^{SPACES}+|{SPACES}+$', '', 'g')"


def _title_sql(value):
    return f"lower(regexp_replace({_strip_sql(value)}, '[^\\p{{L}}\\p{{N}}_]+', ' ', 'g'))"


def title_normalised_documents(spark, folder):
    return table(spark, folder, "documents").select("doc_id", text.normalise_title(F.col("text")).alias("title_cleaned"))


def text_stripped(spark, folder):
    padded = F.concat(F.lit(" \t \n"), "text", F.lit("　 \r\n"))
    return table(spark, folder, "conversations").select("conv_id", "turn", text.strip(padded).alias("stripped"))


def page_titles(spark, folder):
    title = F.get(html.element_texts(F.col("html"), "title"), F.lit(0))
    return table(spark, folder, "pages").select("page_id", text.normalise_title(title).alias("title_cleaned"))


def html_list_items(spark, folder):
    items = F.posexplode(html.element_texts(F.col("html"), "li")).alias("position", "item")
    return table(spark, folder, "pages").select("page_id", items)


_PLAIN = r"replace(replace(regexp_replace({}, '(?s)<!--.*?-->|<[^>]*>', '', 'g'), '&amp;', '&'), chr(10), '')"


def chart_pages(spark, folder):
    """One small chart page per order, as a chart site would mark it up."""
    day = F.col("o_orderdate").cast("date")
    year, week = F.year(day), F.weekofyear(day)
    cell = lambda value: F.concat(F.lit("<td>"), value, F.lit("</td>"))
    page = F.concat(
        F.lit('<html><body><table class="other"><tr><th>Release</th></tr><tr><td>1</td><td>2</td><td>3</td></tr></table>'),
        F.lit('<!-- chart --><table class="a-bordered mojo-body-table scroll">\n<tr><th>Rank</th><th class="a-hidden hidden">LW'),
        # Gross comes twice, of which the last counts
        F.lit("</th><th>Release\n</th><th>Gross</th><th>Gross</th><th>Theaters</th><th>Weeks</th></tr>\n<tr>"),
        cell(F.col("o_custkey").cast("string")),
        F.lit('<td class="hidden">-</td>'),
        cell(F.concat(F.lit('<a href="/release/">'), F.col("o_orderpriority"), F.lit(" &amp; Co &#39;s &#9999999;&#xD800;\n</a>"))),
        cell(F.lit("none")),
        cell(F.concat(F.lit("$"), F.format_number(F.floor("o_totalprice"), 0))),
        # a table inside of a cell, whose rows are none of the chart's
        cell(F.concat(F.lit("<table><tr><td>"), F.col("o_orderkey").cast("string"), F.lit("</td><td></td><td></td></tr><tr></tr></table>"))),
        F.lit("<td>-</td></tr><tr><td>9</td><td>too short</td></tr></table></body></html>"),
    )
    url = F.format_string("https://charts.example.com/weekly/%dW%02d/?ref_=x", year, week)
    # one task may read a whole file, and a page costs far more than its order; so the orders are dealt out
    dealt = table(spark, folder, "orders").repartition(4 * spark.sparkContext.defaultParallelism)
    return dealt.select(url.alias("url"), page.alias("html"))


def chart_rows_from_html(spark, folder):
    return readers.weekly_chart(chart_pages(spark, folder))


def rerelease_flag(spark, folder):
    return chart(spark, folder).select("l_orderkey", "Release", text.is_rerelease(F.col("Release")).alias("is_rerelease"))


def chart_numbers(spark, folder):
    return chart(spark, folder).select(
        "l_orderkey",
        F.col("Rank").alias("rank"),
        text.parse_money(F.col("Gross")).alias("gross"),
        text.parse_count(F.col("Theaters")).alias("theaters"),
        text.parse_weeks(F.col("Weeks")).alias("weeks"),
    )


def display_forms(spark, folder):
    price = F.col("o_totalprice")
    return table(spark, folder, "orders").select(
        "o_orderkey",
        text.as_usd(price).alias("usd"),
        text.as_rating(price / 10000).alias("rating"),
        text.as_count(price).alias("count"),
        text.week_label(F.weekofyear("o_orderdate")).alias("week"),
        text.compact_date(F.col("o_orderdate").cast("date").cast("string")).alias("day"),
    )


def list_text(spark, folder):
    """Lists written as text read back, joined, and their first tokens."""
    words = F.split("p_name", " ")
    listed = F.concat(F.lit("['"), F.array_join(words, "', '"), F.lit("', \"it's\", 'a \\'b\\'']"))
    back = text.parse_string_list(listed)
    return table(spark, folder, "part").select(
        "p_partkey",
        text.join_list(back).alias("joined"),
        F.size(back).alias("n"),
        text.first_token(F.concat_ws("__", "p_name", "p_brand"), "__").alias("token"),
        text.contains_ignoring_case(F.upper("p_name"), "Ring").alias("has_ring"),
    )


def date_parts(spark, folder):
    day = ship_day()
    window = dates.update_window(day, 3)
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        dates.sunday_week(day).alias("sunday"),
        dates.last_sunday(day).alias("sunday_before"),
        dates.likely_release(day, F.col("l_linenumber")).alias("likely_release"),
        dates.days_apart(day, F.lit("1998-06-01").cast("date")).alias("days"),
        dates.first_friday(F.year(day)).alias("first_friday"),
        dates.last_date(F.year(day)).alias("last_date"),
        dates.iso_week(day).alias("iso_week"),
        window["start"].alias("window_start"),
        window["end"].alias("window_end"),
        dates.parse_date(F.when(F.col("l_linenumber") == 1, "").otherwise(day.cast("string"))).alias("parsed"),
    )


def number_forms(spark, folder):
    written = F.when(F.col("o_orderkey") % 3 == 0, "n/a").otherwise(F.col("o_totalprice").cast("string"))
    price = numbers.to_number(written)
    cost = F.when(F.col("o_orderkey") % 5 == 0, 0.0).otherwise(F.col("o_custkey").cast("double"))
    return table(spark, folder, "orders").select(
        "o_orderkey",
        price.alias("price"),
        numbers.zero_to_null(cost).alias("cost"),
        numbers.profit(price, cost).alias("profit"),
        F.round(numbers.return_on_budget(price, cost), 6).alias("roi"),
        numbers.round_half_even(F.col("o_custkey") / 2).cast("bigint").alias("half"),
        numbers.as_id(F.col("o_custkey").cast("double")).alias("custkey"),
        numbers.as_category(F.col("o_custkey")).alias("category"),
        numbers.flag_unless_false(F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderkey") % 2 == 0)).alias("flag"),
        numbers.yes_no(F.when(F.col("o_orderstatus") == "O", "Yes").otherwise("No")).alias("is_open"),
    )


def predict_interval(spark, folder):
    guess = F.col("o_totalprice") * 100
    return table(spark, folder, "orders").select(
        "o_orderkey",
        numbers.interval_low(guess).alias("lower_bound"),
        numbers.interval_high(guess).alias("upper_bound"),
    )


def json_props(spark, folder):
    value = F.from_json("props", "k BIGINT")["k"]
    again = F.to_json(F.struct(value.alias("k"), F.col("event_type").alias("t")))
    return table(spark, folder, "events").select("event_id", value.alias("k"), again.alias("record"))


def json_structs(spark, folder):
    """Records with a nested statistics object, flattened."""
    record = F.to_json(
        F.struct(
            F.col("event_type").alias("id"),
            F.struct(
                F.col("user_id").cast("string").alias("viewCount"), F.col("event_id").cast("string").alias("likeCount")
            ).alias("statistics"),
        )
    )
    parsed = F.from_json(record, "id STRING, statistics STRUCT<viewCount: STRING, likeCount: STRING, commentCount: STRING>")
    records = table(spark, folder, "events").select(parsed.alias("r")).select("r.*")
    return cleaning.flatten_youtube(records)


def exploded_videos(spark, folder):
    """Array of structs to rows with the structs' fields; null elements are dropped."""
    size = F.col("p_size")
    videos = F.slice(
        F.array(
            F.struct(F.concat(F.lit("a"), "p_partkey").alias("key"), F.lit("YouTube").alias("site")),
            F.lit(None).cast("struct<key:string,site:string>"),
            F.struct(F.concat(F.lit("b"), "p_partkey").alias("key"), F.lit("Vimeo").alias("site")),
        ),
        F.lit(1),
        size % 4,
    )
    rows = table(spark, folder, "part").select("p_partkey", videos.alias("videos"))
    return reshape.explode_structs(rows, ["p_partkey"], "videos")


def _years(spark, folder):
    """The years the shop shipped in."""
    return table(spark, folder, "lineitem").select(F.year(ship_day()).alias("year")).distinct()


def chart_calendar(spark, folder):
    return calendar.weeks_of(_years(spark, folder))


def chart_calendar_legacy(spark, folder):
    return calendar.weeks_of(_years(spark, folder), legacy_year=True)


def _ordered_weeks(spark, folder):
    day = F.col("o_orderdate").cast("date")
    return table(spark, folder, "orders").select("o_orderkey", F.year(day).alias("y"), F.weekofyear(day).alias("w"), day.alias("day"))


def trailing_weeks(spark, folder):
    weeks = _ordered_weeks(spark, folder)
    return weeks.select("o_orderkey", F.inline(calendar.trailing_weeks(F.col("y"), F.col("w"))))


def weeks_to_reload(spark, folder):
    weeks = _ordered_weeks(spark, folder)
    return weeks.select("o_orderkey", F.inline(calendar.weeks_to_reload(F.col("y") - F.col("o_orderkey") % 2, F.col("day"))))


def weeks_to_load(spark, folder):
    weeks = _ordered_weeks(spark, folder)
    return weeks.select("o_orderkey", F.size(calendar.weeks_to_load(F.col("y"), F.col("day"))).alias("n"))


def batch_validity(spark, folder):
    weeks = _ordered_weeks(spark, folder)
    year = F.col("y") + F.col("o_orderkey") % 40 - 20
    reason = calendar.check_batch(year.cast("int"), F.col("w"), F.col("day"))
    return weeks.select(
        "o_orderkey",
        reason.alias("reason"),
        calendar.is_year(year, F.col("day")).alias("year_ok"),
        calendar.is_month((F.col("o_orderkey") % 15).cast("int")).alias("month_ok"),
        calendar.is_week((F.col("o_orderkey") % 60).cast("int")).alias("week_ok"),
    )


D = "CAST(l_shipdate AS DATE)"
FRIDAY = "DATE '1970-01-02' + CAST(7 * ceil(date_diff('day', DATE '1970-01-02', make_date(y, 1, 1)) / 7.0) AS INTEGER)"
FIRST_FRIDAY = FRIDAY.replace("make_date(y,", f"make_date(CAST(year({D}) AS INTEGER),")
CALENDAR = f"""WITH y AS (SELECT DISTINCT CAST(year(l_shipdate) AS INTEGER) AS y FROM lineitem),
c AS (SELECT y AS year, CAST(unnest(range(1, 53)) AS INTEGER) AS week, {FRIDAY} AS f FROM y),
e AS (SELECT year, week, CAST(f + 6 + 7 * (week - 1) AS DATE) AS week_end_date FROM c)
"""
WEEKS = """WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, CAST(year(o_orderdate) AS INTEGER) AS y,
                  CAST(weekofyear(CAST(o_orderdate AS DATE)) AS INTEGER) AS w FROM orders)
"""


QUERIES = {
    "title_normalised_documents": Query(
        title_normalised_documents, f"SELECT doc_id, {_title_sql('text')} AS title_cleaned FROM documents"
    ),
    "text_stripped": Query(
        text_stripped,
        f"""SELECT conv_id, turn, {_strip_sql("(' ' || chr(9) || chr(160) || chr(10) || text || chr(12288) || ' ' || chr(13) || chr(10))")} AS stripped
FROM conversations""",
    ),
    "page_titles": Query(
        page_titles,
        f"""SELECT page_id, {_title_sql(_PLAIN.format("regexp_extract(html, '(?is)<title[^>]*>.*?</title[ ]*>')"))} AS title_cleaned
FROM pages""",
    ),
    "html_list_items": Query(
        html_list_items,
        f"""WITH i AS (SELECT page_id, regexp_extract_all(html, '(?is)<li\\b[^>]*>.*?</li\\s*>') AS items FROM pages),
u AS (SELECT page_id, unnest(range(0, len(items))) AS position, unnest(items) AS item FROM i)
SELECT page_id, CAST(position AS INTEGER) AS position, {_PLAIN.format("item")} AS item FROM u""",
    ),
    "chart_rows_from_html": Query(
        chart_rows_from_html,
        """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(weekofyear(CAST(o_orderdate AS DATE)) AS INTEGER) AS week,
       o_orderpriority || ' & Co ''s ' || chr(65533) || chr(65533) AS "Release", o_custkey AS "Rank",
       '$' || format('{:,}', CAST(floor(o_totalprice) AS BIGINT)) AS "Gross",
       CAST(o_orderkey AS VARCHAR) AS "Theaters", '-' AS "Weeks"
FROM orders""",
    ),
    "rerelease_flag": Query(
        rerelease_flag,
        """SELECT l_orderkey,
       CASE l_orderkey % 7 WHEN 0 THEN p_name || ' 20th Anniversary' WHEN 1 THEN '  ' || upper(p_name) || '? '
            WHEN 2 THEN p_name || ' (2021 Re-release)' WHEN 3 THEN p_name || ' 4K Restoration'
            WHEN 4 THEN ' ' || array_to_string([upper(w[1]) || lower(w[2:]) for w in string_split(p_name, ' ')], ' - ') || '  '
            ELSE p_name END AS "Release",
       CASE WHEN l_orderkey % 7 IN (0, 2, 3) THEN 1 ELSE 0 END AS is_rerelease
FROM lineitem JOIN part ON p_partkey = l_partkey""",
    ),
    "chart_numbers": Query(
        chart_numbers,
        """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS rank, CAST(floor(l_extendedprice) AS BIGINT) AS gross,
       CASE WHEN l_quantity < 5 THEN 0 ELSE CAST(l_quantity * 100 AS BIGINT) END AS theaters,
       CASE WHEN CAST(round(l_tax * 100) AS INTEGER) = 8 THEN 0 ELSE CAST(round(l_tax * 100) AS INTEGER) END AS weeks
FROM lineitem""",
    ),
    "display_forms": Query(
        display_forms,
        """SELECT o_orderkey, '$' || format('{:,.2f}', o_totalprice) AS usd, format('{:.1f}', o_totalprice / 10000) AS rating,
       format('{:,.0f}', o_totalprice) AS count, lpad(CAST(weekofyear(CAST(o_orderdate AS DATE)) AS VARCHAR), 2, '0') AS week,
       strftime(CAST(o_orderdate AS DATE), '%Y%m%d') AS day FROM orders""",
    ),
    "list_text": Query(
        list_text,
        """SELECT p_partkey, replace(p_name, ' ', ', ') || ', it''s, a ''b''' AS joined, CAST(len(string_split(p_name, ' ')) AS INTEGER) + 2 AS n,
       p_name AS token, contains(p_name, 'ring') AS has_ring FROM part""",
    ),
    "date_parts": Query(
        date_parts,
        f"""SELECT l_orderkey, l_linenumber, CAST({D} + CAST((7 - dayofweek({D})) % 7 AS INTEGER) AS DATE) AS sunday,
       CAST({D} - CAST(dayofweek({D}) AS INTEGER) AS DATE) AS sunday_before,
       CAST({D} - (l_linenumber + 1) * 7 AS DATE) AS likely_release,
       CAST(abs(date_diff('day', DATE '1998-06-01', {D})) AS INTEGER) AS days,
       CAST({FIRST_FRIDAY} AS DATE) AS first_friday,
       make_date(CAST(year({D}) AS INTEGER), 12, 31) AS last_date, CAST(weekofyear({D}) AS INTEGER) AS iso_week,
       CAST({D} - 7 - INTERVAL 3 MONTH AS DATE) AS window_start, CAST({D} - INTERVAL 3 MONTH AS DATE) AS window_end,
       CASE WHEN l_linenumber <> 1 THEN {D} END AS parsed
FROM lineitem""",
    ),
    "number_forms": Query(
        number_forms,
        """WITH o AS (SELECT *, CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice END AS p,
                  CASE WHEN o_orderkey % 5 = 0 THEN 0.0 ELSE CAST(o_custkey AS DOUBLE) END AS c FROM orders)
SELECT o_orderkey, p AS price, nullif(c, 0) AS cost, p - c AS profit, round((p - c) / nullif(c, 0), 6) AS roi,
       CAST(round_even(o_custkey / 2, 0) AS BIGINT) AS half, o_custkey AS custkey, CAST(o_custkey AS VARCHAR) AS category,
       CASE WHEN o_orderkey % 4 <> 0 AND o_orderkey % 2 <> 0 THEN 0 ELSE 1 END AS flag,
       CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS is_open FROM o""",
    ),
    "predict_interval": Query(
        predict_interval,
        """SELECT o_orderkey, round_even(greatest(1.0, o_totalprice * 100 - 10847621.34), 2) AS lower_bound,
       round_even(o_totalprice * 100 + 10847621.34, 2) AS upper_bound FROM orders""",
    ),
    "json_props": Query(
        json_props,
        """SELECT event_id, k, '{"k":' || k || ',"t":"' || event_type || '"}' AS record
FROM (SELECT *, CAST(regexp_extract(props, '"k":\\s*(-?\\d+)', 1) AS BIGINT) AS k FROM events)""",
    ),
    "json_structs": Query(
        json_structs,
        """SELECT event_type AS id, CAST(user_id AS DOUBLE) AS "viewCount", CAST(event_id AS DOUBLE) AS "likeCount",
       CAST(NULL AS DOUBLE) AS "commentCount" FROM events""",
    ),
    "exploded_videos": Query(
        exploded_videos,
        """SELECT p_partkey, 'a' || p_partkey AS key, 'YouTube' AS site FROM part WHERE p_size % 4 >= 1
UNION ALL SELECT p_partkey, 'b' || p_partkey, 'Vimeo' FROM part WHERE p_size % 4 = 3""",
    ),
    "chart_calendar": Query(chart_calendar, CALENDAR + "SELECT year, week, week_end_date FROM e"),
    "chart_calendar_legacy": Query(
        chart_calendar_legacy,
        CALENDAR + "SELECT CAST(year(week_end_date) AS INTEGER) AS year, week, week_end_date FROM e",
    ),
    "trailing_weeks": Query(
        trailing_weeks,
        WEEKS
        + """, k AS (SELECT o_orderkey, y, w - CAST(unnest([2, 3, 4, 5]) AS INTEGER) AS n FROM o)
SELECT o_orderkey, CASE WHEN n < 1 THEN y - 1 ELSE y END AS year, CASE WHEN n < 1 THEN n + 52 ELSE n END AS week FROM k""",
    ),
    "weeks_to_reload": Query(
        weeks_to_reload,
        WEEKS
        + """, b AS (SELECT o_orderkey, y - CAST(o_orderkey % 2 AS INTEGER) AS year,
                 CASE WHEN o_orderkey % 2 = 1 THEN 49 ELSE greatest(1, w - 5) END AS f,
                 CASE WHEN o_orderkey % 2 = 1 THEN 52 ELSE least(52, w - 2) END AS t FROM o)
SELECT o_orderkey, CAST(year AS INTEGER) AS year, CAST(unnest(range(f, t + 1)) AS INTEGER) AS week FROM b""",
    ),
    "weeks_to_load": Query(weeks_to_load, WEEKS + "SELECT o_orderkey, CAST(greatest(0, w - 2) AS INTEGER) AS n FROM o"),
    "batch_validity": Query(
        batch_validity,
        WEEKS
        + """, b AS (SELECT *, y + o_orderkey % 40 - 20 AS x,
       CAST(strftime(day, '%U') AS INTEGER) AS u FROM o)
SELECT o_orderkey, CASE WHEN x < 1982 THEN 'no charts before 1982' WHEN w > 52 THEN 'week above 52'
       WHEN x > y THEN 'year in the future' WHEN x = y AND w > u - 1 THEN 'week not closed yet' END AS reason,
       x > 1982 AND x < y AS year_ok, o_orderkey % 15 BETWEEN 1 AND 12 AS month_ok,
       o_orderkey % 60 BETWEEN 1 AND 52 AS week_ok FROM b""",
    ),
}
