"""Registered queries: every operator on the supplied tables, with the SQL that must agree."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.functions import (
    cut_binary,
    flag_to_double,
    identify_missing,
    month_on_common_year,
    to_timestamp,
    within_dates,
)
from quillon.operators import cleaning, describe, evaluate, features, outliers, summaries, windows
from quillon.operators.knn import NearestNeighbours
from quillon.operators.spatial import aggregate_in_areas
from quillon.plans import credit, crime, funding
from quillon.plans.views import PROJECTS_SQL, SCORES_SQL, kept_projects, projects, rounded, scores, table
from quillon.session import Scratch, materialize, spread
from quillon.sources import (
    BLOCK_CODES,
    BLOCK_MEASURES,
    PROFILE_COLUMNS,
    load_reports,
    read_csv,
    transform_block_stats,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(sql: str | None = None) -> Callable[[Query], Query]:
    def keep(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql:
            ORACLE[function.__name__] = sql
        return function

    return keep


# --- counts, shares, changes ----------------------------------------------------------------------

@register("""
WITH c AS (SELECT CAST(year(o_orderdate) AS INT) AS year, count(*) AS n FROM orders GROUP BY 1)
SELECT year, n, round((n - lag(n) OVER (ORDER BY year)) * 100.0 / lag(n) OVER (ORDER BY year), 6) AS pct_change FROM c
""")
def yearly_change(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return rounded(summaries.summarize_yearly(orders, F.year("o_orderdate")))


@register("""
SELECT o_orderpriority, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS percentage
FROM orders GROUP BY 1
""")
def field_share(spark, sf_dir):
    return rounded(summaries.summarize_on_field(table(spark, sf_dir, "orders"), "o_orderpriority"))


@register("""
SELECT event_type, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share
FROM events WHERE value > 100 GROUP BY 1
""")
def conditional_share(spark, sf_dir):
    return rounded(summaries.conditional_share(table(spark, sf_dir, "events"), F.col("value") > 100, "event_type"))


@register("""
SELECT round(avg(CAST(event_type IN ('click', 'view') AS INT)), 6) AS share_first,
       round(avg(CAST(event_type IN ('error') AS INT)), 6) AS share_second,
       round(avg(CAST(event_type IN ('click', 'view') AS INT)) - avg(CAST(event_type IN ('error') AS INT)), 6) AS difference
FROM events WHERE value > 100
""")
def share_difference(spark, sf_dir):
    return rounded(summaries.share_difference(
        table(spark, sf_dir, "events"), F.col("value") > 100, "event_type", ["click", "view"], ["error"]))


@register("""
SELECT event_type, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share
FROM events WHERE value > 100 AND event_type IN ('click', 'view') GROUP BY 1
""")
def posterior_share(spark, sf_dir):
    return rounded(summaries.posterior_share(
        table(spark, sf_dir, "events"), F.col("value") > 100, "event_type", ["click", "view"]))


@register("""
SELECT CAST(make_date(1900, month(o_orderdate), 1) AS VARCHAR) AS month, CAST(year(o_orderdate) AS INT) AS year,
       count(*) AS counts FROM orders GROUP BY 1, 2
""")
def month_year_counts(spark, sf_dir):
    monthly = summaries.summarize_monthly(table(spark, sf_dir, "orders"), "o_orderdate")
    return monthly.withColumn("month", F.col("month").cast("string"))


@register("""
SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS counts FROM events GROUP BY 1, 2
""")
def daily_type_counts(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_type").agg(
        F.count(F.lit(1)).alias("counts"))


CHANGES_SQL = """
c AS (SELECT n_name AS nation, count(*) FILTER (year(o_orderdate) = 1996) AS n_1996,
             count(*) FILTER (year(o_orderdate) = 1997) AS n_1997
      FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1),
d AS (SELECT *, n_1997 - n_1996 AS change FROM c)
"""


def _nation_changes(spark, sf_dir):
    reports = (
        table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .select(F.year("o_orderdate").alias("year"), F.col("c_nationkey").cast("string").alias("code")))
    areas = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("string").alias("area_number"), F.col("n_name").alias("community"))
    named = summaries.link_reports_neighborhoods(reports, areas, "code").withColumnRenamed("code", "nation")
    return summaries.summarize_yoy_change(named, "nation", 1996, 1997)


@register(f"WITH {CHANGES_SQL} SELECT * FROM d")
def yoy_change(spark, sf_dir):
    return _nation_changes(spark, sf_dir)


@register(f"WITH {CHANGES_SQL} SELECT * FROM d ORDER BY change DESC, nation LIMIT 5")
def yoy_top5_up(spark, sf_dir):
    return summaries.largest_changes(_nation_changes(spark, sf_dir), "nation")


@register(f"WITH {CHANGES_SQL} SELECT * FROM d ORDER BY change, nation LIMIT 5")
def yoy_top5_down(spark, sf_dir):
    return summaries.largest_changes(_nation_changes(spark, sf_dir), "nation", increases=False)


@register("""
SELECT CAST(year(o_orderdate) AS INT) AS year, count(*) AS n,
       round((count(*) - lag(count(*)) OVER (ORDER BY year(o_orderdate))) * 100.0
             / lag(count(*)) OVER (ORDER BY year(o_orderdate)), 6) AS pct_change
FROM orders
WHERE (o_orderdate >= '1996-06-29' AND o_orderdate < '1996-07-27')
   OR (o_orderdate >= '1998-06-29' AND o_orderdate < '1998-07-27')
GROUP BY year(o_orderdate)
""")
def date_window_change(spark, sf_dir):
    reports = table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    windows = [("1996-06-29", "1996-07-27"), ("1998-06-29", "1998-07-27")]
    return rounded(crime.compare_windows(reports, windows, "o_orderdate"))


@register("""
SELECT CAST(year(o_orderdate) AS INT) AS year, count(*) AS n,
       round((count(*) - lag(count(*)) OVER (ORDER BY year(o_orderdate))) * 100.0
             / lag(count(*)) OVER (ORDER BY year(o_orderdate)), 6) AS pct_change
FROM orders
WHERE (o_orderdate >= '1996-01-01' AND o_orderdate < '1996-07-27')
   OR (o_orderdate >= '1998-01-01' AND o_orderdate < '1998-07-27')
GROUP BY year(o_orderdate)
""")
def year_to_date_change(spark, sf_dir):
    reports = table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    return rounded(crime.compare_year_to_date(reports, {1996: "1996-07-27", 1998: "1998-07-27"}, "o_orderdate"))


# --- areas and blocks -----------------------------------------------------------------------------

def _area_reports(spark, sf_dir):
    """Line items as reports: the supplier's nation is the area code. Region 0 is left off the area list."""
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").cast("string").alias("community_area"))
    reports = table(spark, sf_dir, "lineitem").join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    areas = table(spark, sf_dir, "nation").where(F.col("n_regionkey") != 0).select(
        F.col("n_nationkey").cast("string").alias("area_number"), F.col("n_name").alias("community"))
    return summaries.link_reports_neighborhoods(reports, areas), areas


AREA_COUNTS_SQL = """
a AS (SELECT n_name AS community, n_nationkey FROM nation WHERE n_regionkey <> 0),
r AS (SELECT community AS community_area, l_returnflag, l_suppkey FROM lineitem
      JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN a ON s_nationkey = n_nationkey),
c AS (SELECT community_area, count(*) AS n FROM r WHERE community_area IS NOT NULL GROUP BY 1)
"""


@register(f"WITH {AREA_COUNTS_SQL} SELECT community_area, l_returnflag, count(*) AS n FROM r GROUP BY 1, 2")
def area_lookup(spark, sf_dir):
    reports, _ = _area_reports(spark, sf_dir)
    return reports.groupBy("community_area", "l_returnflag").agg(F.count(F.lit(1)).alias("n"))


@register(f"""
WITH {AREA_COUNTS_SQL}
SELECT community_area AS community, n AS counts, CAST(n_nationkey AS VARCHAR) AS area_number,
       min(n) OVER () AS scale_min, max(n) OVER () AS scale_max
FROM c JOIN a ON community_area = community
""")
def area_counts_bounds(spark, sf_dir):
    reports, areas = _area_reports(spark, sf_dir)
    return summaries.map_neighborhood_stats(reports, areas)


@register(f"""
WITH {AREA_COUNTS_SQL}
SELECT 'n' AS "column", count(n) AS count, round(avg(n), 4) AS mean, round(stddev_samp(n), 4) AS std,
       CAST(min(n) AS DOUBLE) AS min, quantile_cont(n, 0.25) AS p25, quantile_cont(n, 0.5) AS p50,
       quantile_cont(n, 0.75) AS p75, CAST(max(n) AS DOUBLE) AS max FROM c
""")
def area_description(spark, sf_dir):
    reports, _ = _area_reports(spark, sf_dir)
    return rounded(summaries.summarize_neighborhoods(reports)["description"], 4)


@register(f"""
WITH {AREA_COUNTS_SQL},
b AS (SELECT range AS bin FROM range(-1, 33)),
h AS (SELECT CASE WHEN n < 0 THEN -1 WHEN n > 32000 THEN 32 ELSE least(CAST(floor(n / 1000) AS BIGINT), 31) END AS bin, count(*) AS n FROM c GROUP BY 1)
SELECT bin, CASE WHEN bin >= 0 THEN bin * 1000.0::DOUBLE END AS bin_start,
       CASE WHEN bin < 32 THEN (bin + 1) * 1000.0::DOUBLE END AS bin_end, coalesce(n, 0) AS n
FROM b LEFT JOIN h USING (bin)
""")
def area_histogram(spark, sf_dir):
    reports, _ = _area_reports(spark, sf_dir)
    return summaries.neighborhood_distribution(reports)


def _block_reports(spark, sf_dir):
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("geoid10"))
    return table(spark, sf_dir, "lineitem").join(suppliers, F.col("l_suppkey") == F.col("s_suppkey")).withColumnRenamed(
        "l_suppkey", "block")


BLOCKS_SQL = """
b AS (SELECT l_suppkey AS block, s_nationkey AS geoid10,
             count(*) FILTER (l_returnflag = 'A') AS A, count(*) FILTER (l_returnflag = 'N') AS N,
             count(*) FILTER (l_returnflag = 'R') AS R
      FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2)
"""


@register(f"WITH {BLOCKS_SQL} SELECT * FROM b")
def block_pivot(spark, sf_dir):
    return summaries.summarize_by_block(_block_reports(spark, sf_dir), "l_returnflag", ["A", "N", "R"])


@register(f"""
WITH {BLOCKS_SQL},
s AS (SELECT c_nationkey AS geoid10, avg(c_acctbal) AS income, CAST(count(*) AS DOUBLE) AS people FROM customer GROUP BY 1),
l AS (SELECT income, people FROM b LEFT JOIN s USING (geoid10) WHERE R >= 200),
u AS (SELECT 'income' AS "column", income AS v FROM l UNION ALL SELECT 'people', people FROM l)
SELECT "column", count(v) AS count, round(avg(v), 4) AS mean, round(stddev_samp(v), 4) AS std, round(min(v), 4) AS min,
       round(quantile_cont(v, 0.25), 4) AS p25, round(quantile_cont(v, 0.5), 4) AS p50,
       round(quantile_cont(v, 0.75), 4) AS p75, round(max(v), 4) AS max
FROM u GROUP BY 1
""")
def block_profile(spark, sf_dir):
    by_block = summaries.summarize_by_block(_block_reports(spark, sf_dir), "l_returnflag", ["A", "N", "R"])
    stats = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("geoid10")).agg(
        F.avg("c_acctbal").alias("income"), F.count(F.lit(1)).cast("double").alias("people"))
    return rounded(summaries.describe_blocks(by_block.where(F.col("R") >= 200), stats, ["income", "people"]), 4)


AREAS_SQL = """
areas AS (SELECT s_suppkey AS area, (s_suppkey * 37) % 900 AS x0, (s_suppkey * 61) % 90 AS y0,
                 5 + s_suppkey % 40 AS w, 1 + s_suppkey % 7 AS h FROM supplier),
pts AS (SELECT l_orderkey, l_linenumber, floor(l_extendedprice / 100) AS x, l_quantity + floor(l_discount * 100) / 2 AS y
        FROM lineitem WHERE l_returnflag <> 'R')
"""


@register(f"""
WITH {AREAS_SQL}
SELECT area, count(*) AS n, min(l_orderkey) AS first_order, max(l_linenumber) AS last_line
FROM pts JOIN areas ON x > x0 AND x < x0 + w AND y > y0 AND y < y0 + h GROUP BY 1
""")
def point_in_polygon(spark, sf_dir):
    """Rectangles made from suppliers, points from line items; many points lie exactly on an edge."""
    key = F.col("s_suppkey")
    x0, y0 = (key * 37 % 900).cast("double"), (key * 61 % 90).cast("double")
    x1, y1 = x0 + 5 + key % 40, y0 + 1 + key % 7

    def corner(x, y):
        return F.struct(x.alias("x"), y.alias("y"))

    blocks = table(spark, sf_dir, "supplier").select(
        key.alias("geoid10"),
        F.array(F.array(corner(x0, y0), corner(x1, y0), corner(x1, y1), corner(x0, y1))).alias("the_geom"))
    placed = F.col("l_returnflag") != "R"
    points = spread(table(spark, sf_dir, "lineitem")).select(
        "l_orderkey", "l_linenumber",
        F.when(placed, F.floor(F.col("l_extendedprice") / 100).cast("double")).alias("longitude"),
        (F.col("l_quantity") + F.floor(F.col("l_discount") * 100) / 2).alias("latitude"))
    measures = {
        "n": (F.count(F.lit(1)), F.sum), "first_order": (F.min("l_orderkey"), F.min), "last_line": (F.max("l_linenumber"), F.max)}
    found = aggregate_in_areas(points, blocks, measures)
    return found.groupBy(F.col("geoid10").alias("area")).agg(
        F.sum("n").alias("n"), F.min("first_order").alias("first_order"), F.max("last_line").cast("int").alias("last_line"))


STATS_SQL = """
SELECT concat('17', lpad(CAST(c_nationkey AS VARCHAR), 3, '0'), c_mktsegment, CAST(c_custkey AS VARCHAR)) AS geoid10,
       round(w * 100.0 / s, 6) AS white_pct, round(b * 100.0 / s, 6) AS black_pct, round(h * 100.0 / hs, 6) AS hispanic_pct,
       round((m + m + m + m) * 100.0 / s, 6) AS degree_pct, income
FROM (SELECT *, CAST(c_custkey % 50 AS DOUBLE) AS w, CAST(c_custkey % 30 AS DOUBLE) AS b,
             nullif(CAST(c_custkey % 90 AS DOUBLE), 0) AS s, CAST(c_custkey % 20 AS DOUBLE) AS h, 80.0::DOUBLE AS hs,
             CAST(c_custkey % 10 AS DOUBLE) AS m, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS income FROM customer)
"""


@register(STATS_SQL)
def sentinel_percentages(spark, sf_dir):
    """Customers as block statistics; a negative balance stands for 'no estimate'."""
    key = F.col("c_custkey")
    values = {
        "Race sample": key % 90, "White alone": key % 50, "Black alone": key % 30, "Hispanic or Latino sample": F.lit(80),
        "Hispanic or Latino": key % 20, "Education sample": key % 90, "Bachelor's": key % 10, "Master's": key % 10,
        "Professional": key % 10, "PhD": key % 10,
    }
    income = F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).otherwise(-666666666.0)
    codes = [F.lit("17"), F.lpad(F.col("c_nationkey").cast("string"), 3, "0"), F.col("c_mktsegment"), key.cast("string")]
    raw = table(spark, sf_dir, "customer").select(
        *[v.cast("double").alias(n) for n, v in values.items()],
        income.alias(BLOCK_MEASURES["B19301_001E"]),
        *[c.alias(n) for n, c in zip(BLOCK_CODES, codes, strict=True)])
    names = ["white_pct", "black_pct", "hispanic_pct", "degree_pct", "income"]
    stats = transform_block_stats(raw).withColumnsRenamed(dict(zip(PROFILE_COLUMNS, names, strict=True)))
    return rounded(stats.select("geoid10", *names))


# --- summaries ------------------------------------------------------------------------------------

def describe_sql(source: str, columns: list[str], group: str | None = None) -> str:
    key = f"{group}, " if group else ""
    parts = " UNION ALL ".join(f"SELECT {key}'{c}' AS \"column\", CAST({c} AS DOUBLE) AS v FROM {source}" for c in columns)
    where = f"WHERE {group} IS NOT NULL" if group else ""
    return f"""
    SELECT {key}"column", count(v) AS count, round(avg(v), 4) AS mean, round(stddev_samp(v), 4) AS std,
           round(min(v), 4) AS min, round(quantile_cont(v, 0.25), 4) AS p25, round(quantile_cont(v, 0.5), 4) AS p50,
           round(quantile_cont(v, 0.75), 4) AS p75, round(max(v), 4) AS max
    FROM ({parts}) {where} GROUP BY {key}"column"
    """


LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register(describe_sql("lineitem", LINE_NUMBERS))
def describe_all(spark, sf_dir):
    return rounded(describe.summarize_data(table(spark, sf_dir, "lineitem"), agg_cols=LINE_NUMBERS), 4)


@register(f"WITH {PROJECTS_SQL}, p AS (SELECT state, days AS daystofullfunding, price FROM projects) "
          + describe_sql("p", ["daystofullfunding", "price"], "state"))
def describe_by_group(spark, sf_dir):
    return rounded(describe.summarize_data(projects(spark, sf_dir), ["state"], [funding.DAYS, "price"]), 4)


@register(f"WITH {PROJECTS_SQL}, p AS (SELECT grade, resource, days AS daystofullfunding FROM projects) " + """
SELECT grade, resource, 'daystofullfunding' AS "column", count(v) AS count, round(avg(v), 4) AS mean,
       round(stddev_samp(v), 4) AS std, round(min(v), 4) AS min, round(quantile_cont(v, 0.25), 4) AS p25,
       round(quantile_cont(v, 0.5), 4) AS p50, round(quantile_cont(v, 0.75), 4) AS p75, round(max(v), 4) AS max
FROM (SELECT grade, resource, CAST(daystofullfunding AS DOUBLE) AS v FROM p) GROUP BY 1, 2
""")
def describe_by_two_groups(spark, sf_dir):
    return rounded(describe.summarize_data(projects(spark, sf_dir), ["grade", "resource"], [funding.DAYS]), 4)


@register("""
SELECT l_returnflag, "column", round(avg(v), 6) AS mean FROM (
  SELECT l_returnflag, 'l_quantity' AS "column", l_quantity AS v FROM lineitem
  UNION ALL SELECT l_returnflag, 'l_discount', l_discount FROM lineitem) GROUP BY 1, 2
""")
def group_means(spark, sf_dir):
    return rounded(describe.group_means(table(spark, sf_dir, "lineitem"), ["l_returnflag"], ["l_quantity", "l_discount"]))


@register("WITH c AS (SELECT o_custkey, count(*) AS obs_per_o_custkey FROM orders GROUP BY 1) "
          + describe_sql("c", ["obs_per_o_custkey"]))
def per_category_describe(spark, sf_dir):
    return rounded(describe.count_per_categorical(table(spark, sf_dir, "orders"), "o_custkey"), 4)


@register(f"""
WITH {PROJECTS_SQL}
SELECT count(*) AS n_projects, count(*) FILTER (days <= 60) AS n_funded_on_time,
       round(count(*) FILTER (days <= 60) * 100.0 / count(*), 6) AS pct_funded_on_time FROM projects
""")
def general_statistics(spark, sf_dir):
    return rounded(funding.general_statistics(projects(spark, sf_dir)))


@register(f"""
WITH {PROJECTS_SQL}
SELECT 'teacher' AS "column", count(DISTINCT teacher) AS n_distinct FROM projects
UNION ALL SELECT 'state', count(DISTINCT state) FROM projects
UNION ALL SELECT 'funded', count(DISTINCT funded) FROM projects
""")
def distinct_values(spark, sf_dir):
    return describe.distinct_counts(projects(spark, sf_dir), ["teacher", "state", "funded"])


@register(f"""
WITH {PROJECTS_SQL}, m AS (
  SELECT 'funded' AS "column", count(*) FILTER (funded IS NULL) AS n_missing, count(*) AS n FROM projects
  UNION ALL SELECT 'daystofullfunding', count(*) FILTER (days IS NULL), count(*) FROM projects
  UNION ALL SELECT 'price', count(*) FILTER (price IS NULL), count(*) FROM projects
  UNION ALL SELECT 'state', count(*) FILTER (state IS NULL), count(*) FROM projects)
SELECT "column", n_missing, round(n_missing * 100.0 / n, 6) AS pct_missing FROM m
""")
def missing_report(spark, sf_dir):
    return rounded(describe.report_n_missing(
        projects(spark, sf_dir).select("funded", funding.DAYS, "price", "state")))


@register(f"""
WITH {PROJECTS_SQL},
v AS (SELECT price, balance, CAST(days AS DOUBLE) AS daystofullfunding, CAST(late AS DOUBLE) AS late FROM projects
      WHERE price IS NOT NULL AND balance IS NOT NULL AND days IS NOT NULL)
""" + " UNION ALL ".join(
    f"SELECT '{a}' AS variable_a, '{b}' AS variable_b, round(corr({a}, {b}), 6) AS correlation FROM v"
    for a in ("price", "balance", "daystofullfunding", "late") for b in ("price", "balance", "daystofullfunding", "late")))
def corr_matrix(spark, sf_dir):
    p = projects(spark, sf_dir).withColumnRenamed(funding.LATE, "late")
    return rounded(describe.pw_correlate(p, ["price", "balance", funding.DAYS, "late"]))


@register("""
WITH b AS (SELECT range AS bin FROM range(-1, 26)),
h AS (SELECT CASE WHEN value < 0 THEN -1 WHEN value > 500 THEN 25 ELSE least(CAST(floor(value / 20) AS BIGINT), 24) END AS bin, count(*) AS n
      FROM events WHERE value IS NOT NULL GROUP BY 1)
SELECT bin, CASE WHEN bin >= 0 THEN CAST(bin * 20 AS DOUBLE) END AS bin_start,
       CASE WHEN bin < 25 THEN CAST((bin + 1) * 20 AS DOUBLE) END AS bin_end, coalesce(n, 0) AS n
FROM b LEFT JOIN h USING (bin)
""")
def histogram_fixed(spark, sf_dir):
    return describe.fixed_histogram(table(spark, sf_dir, "events"), "value", 0, 500, 20)


@register("""
WITH s AS (SELECT count(*) AS n, min(value) AS lo, max(value) AS hi, quantile_cont(value, 0.25) AS q1,
                  quantile_cont(value, 0.75) AS q3 FROM events),
k AS (SELECT *, least(50, CAST(ceil((hi - lo) / (2 * (q3 - q1) / pow(n, 1.0 / 3))) AS BIGINT)) AS bins FROM s),
w AS (SELECT *, (hi - lo) / bins AS w FROM k),
h AS (SELECT least(CAST(floor((value - lo) / w) AS BIGINT), bins - 1) AS bin, count(*) AS n FROM events, w GROUP BY 1)
SELECT b.range AS bin, round(lo + b.range * w, 6) AS bin_start, round(lo + (b.range + 1) * w, 6) AS bin_end,
       coalesce(h.n, 0) AS n
FROM w, range(50) b LEFT JOIN h ON h.bin = b.range WHERE b.range < w.bins
""")
def histogram_automatic(spark, sf_dir):
    return rounded(describe.histogram(table(spark, sf_dir, "events"), "value"))


@register("""
WITH q AS (SELECT quantile_cont(value, 0.25) AS p25, quantile_cont(value, 0.5) AS p50, quantile_cont(value, 0.75) AS p75 FROM events),
f AS (SELECT *, p25 - 1.5 * (p75 - p25) AS lo, p75 + 1.5 * (p75 - p25) AS hi FROM q)
SELECT count(*) AS count, min(value) AS min, round(first(p25), 6) AS p25, round(first(p50), 6) AS p50,
       round(first(p75), 6) AS p75, max(value) AS max, min(value) FILTER (value BETWEEN lo AND hi) AS whisker_low,
       max(value) FILTER (value BETWEEN lo AND hi) AS whisker_high,
       count(*) FILTER (value NOT BETWEEN lo AND hi) AS n_outliers
FROM events, f
""")
def boxplot_stats(spark, sf_dir):
    return rounded(describe.box_plot(table(spark, sf_dir, "events"), "value"))


@register("SELECT lang, count(*) AS n FROM documents WHERE lang IS NOT NULL GROUP BY 1")
def distribution_categorical(spark, sf_dir):
    return describe.distribution(table(spark, sf_dir, "documents"), "lang")["counts"]


# --- outliers -------------------------------------------------------------------------------------

OUTLIER_SQL = """
q AS (SELECT quantile_cont(value, 0.25) AS v1, quantile_cont(value, 0.75) AS v3, quantile_cont(user_id, 0.25) AS u1,
             quantile_cont(user_id, 0.75) AS u3 FROM events),
o AS (SELECT event_id, (value < v1 - 1.5 * (v3 - v1) OR value > v3 + 1.5 * (v3 - v1)) AS value,
             (user_id < u1 - 1.5 * (u3 - u1) OR user_id > u3 + 1.5 * (u3 - u1)) AS user_id FROM events, q),
r AS (SELECT event_id, value, user_id, CAST(value AS BIGINT) + CAST(user_id AS BIGINT) AS count_outlier FROM o)
"""


def _outliers(spark, sf_dir):
    return outliers.find_outliers(table(spark, sf_dir, "events"), key="event_id")


@register(f"WITH {OUTLIER_SQL} SELECT *, count_outlier * 50.0::DOUBLE AS pct_outlier FROM r")
def outlier_rows(spark, sf_dir):
    return _outliers(spark, sf_dir)


@register(f"WITH {OUTLIER_SQL} SELECT count_outlier, count(*) AS n FROM r GROUP BY 1")
def outlier_histogram(spark, sf_dir):
    return outliers.outlier_histogram(_outliers(spark, sf_dir))


@register(f"""
WITH {OUTLIER_SQL} SELECT 'value' AS "column", count(*) FILTER (value) AS n_outliers FROM r
UNION ALL SELECT 'user_id', count(*) FILTER (user_id) FROM r
""")
def outliers_per_column(spark, sf_dir):
    return outliers.outliers_per_column(_outliers(spark, sf_dir), "event_id")


# --- cleaning and features ------------------------------------------------------------------------

GAPS_SQL = PROJECTS_SQL + """,
g AS (SELECT projectid, days AS daystofullfunding, nullif(resource, 'F') AS resource,
             CASE WHEN price < 400000 THEN price END AS price, nullif(grade, '5-LOW') AS grade FROM projects),
modes AS (
  SELECT (SELECT resource FROM g WHERE resource IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS m_resource,
         (SELECT grade FROM g WHERE grade IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS m_grade,
         (SELECT daystofullfunding FROM g WHERE daystofullfunding IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS m_days,
         (SELECT median(daystofullfunding) FROM g) AS med_days, (SELECT median(price) FROM g) AS med_price,
         (SELECT avg(price) FROM g) AS avg_price)
"""


def _gaps(spark, sf_dir):
    """Projects with missing values in four columns."""
    return projects(spark, sf_dir).select(
        "projectid", funding.DAYS, F.nullif("resource", F.lit("F")).alias("resource"),
        F.when(F.col("price") < 400000, F.col("price")).alias("price"), F.nullif("grade", F.lit("5-LOW")).alias("grade"))


@register(f"""
WITH {GAPS_SQL}
SELECT projectid, CAST(coalesce(daystofullfunding, med_days) AS DOUBLE) AS daystofullfunding,
       coalesce(resource, m_resource) AS resource, round(coalesce(price, med_price), 4) AS price,
       coalesce(grade, m_grade) AS grade, daystofullfunding IS NULL AS daystofullfunding_missing,
       resource IS NULL AS resource_missing, price IS NULL AS price_missing, grade IS NULL AS grade_missing
FROM g, modes
""")
def impute_default(spark, sf_dir):
    filled = cleaning.preprocess_data(
        materialize(_gaps(spark, sf_dir)), columns=[funding.DAYS, "resource", "price", "grade"])
    return rounded(filled, 4)


@register(f"""
WITH {GAPS_SQL}
SELECT projectid, coalesce(daystofullfunding, m_days) AS daystofullfunding, coalesce(resource, 'N/A') AS resource,
       round(coalesce(price, avg_price), 4) AS price, coalesce(grade, 'none given') AS grade FROM g, modes
""")
def impute_methods(spark, sf_dir):
    filled = cleaning.preprocess_data(
        materialize(_gaps(spark, sf_dir)), {funding.DAYS: "mode", "resource": "manual", "price": "mean", "grade": "manual"},
        {"grade": "none given"}, columns=[funding.DAYS, "resource", "price", "grade"], flags=False)
    return rounded(filled, 4)


@register(f"""
WITH {GAPS_SQL}
SELECT projectid, daystofullfunding IS NULL AS daystofullfunding_missing, price IS NULL AS price_missing FROM g
""")
def missing_flags(spark, sf_dir):
    flagged = identify_missing(_gaps(spark, sf_dir), [funding.DAYS, "price"])
    return flagged.select("projectid", f"{funding.DAYS}_missing", "price_missing")


SPLIT_MONTHS, SPLIT_GAP_DAYS = 6, 60

SPLITS_SQL = f"""
span AS (SELECT min(posted) AS a, max(posted) AS z FROM projects),
bounds AS (SELECT CAST(range + 1 AS INT) AS split_id,
                  a + INTERVAL {SPLIT_MONTHS} MONTH + to_months(CAST({SPLIT_MONTHS} * range AS INT)) AS s,
                  a + INTERVAL {SPLIT_MONTHS} MONTH + to_months(CAST({SPLIT_MONTHS} * (range + 1) AS INT)) AS e
           FROM span, range(200) WHERE s < z),
member AS (SELECT p.*, split_id, 'test' AS role FROM projects p JOIN bounds ON posted >= s AND posted < e
           UNION ALL
           SELECT p.*, split_id, 'train' FROM projects p JOIN bounds ON posted < s - INTERVAL {SPLIT_GAP_DAYS} DAY)
"""


def _windows(spark, sf_dir, *columns):
    """The rolling splits of the projects, with the columns a query needs."""
    return windows.temporal_windows(
        kept_projects(spark, sf_dir, "posted", *columns), "posted", {"months": SPLIT_MONTHS}, {"days": SPLIT_GAP_DAYS})


SPLIT_SUMMARY = """
SELECT split_id, role, count(*) AS n, strftime(min(posted), '%Y-%m-%d') AS first_day,
       strftime(max(posted), '%Y-%m-%d') AS last_day, count(*) FILTER (late) AS n_late FROM member GROUP BY 1, 2
"""


def _split_summary(placed):
    found = placed.states({
        "n": (F.count(F.lit(1)), "sum"), "first": (F.min("posted"), "min"), "last": (F.max("posted"), "max"),
        "n_late": (F.count_if(F.col(funding.LATE)), "sum")})
    return found.select(
        "split_id", "role", "n", F.date_format("first", "yyyy-MM-dd").alias("first_day"), F.date_format("last", "yyyy-MM-dd").alias("last_day"), "n_late")


@register(f"WITH {PROJECTS_SQL}, {SPLITS_SQL} {SPLIT_SUMMARY}")
def temporal_splits_summary(spark, sf_dir):
    return _split_summary(_windows(spark, sf_dir, funding.LATE))


@register(f"""
WITH {PROJECTS_SQL},
span AS (SELECT min(posted) AS a, max(posted) AS z FROM projects),
w AS (SELECT CAST(range AS INT) AS i, a + to_months(CAST(12 * range AS INT)) AS s, a + to_months(CAST(12 * (range + 1) AS INT)) AS e
      FROM span, range(100) WHERE s < z),
placed AS (SELECT p.*, i FROM projects p JOIN w ON posted >= s AND posted < e),
member AS (SELECT posted, late, i AS split_id, 'test' AS role FROM placed WHERE i >= 1
           UNION ALL SELECT posted, late, w.i, 'train' FROM placed JOIN w ON w.i >= 1 AND placed.i < w.i)
{SPLIT_SUMMARY}
""")
def temporal_splits_v2(spark, sf_dir):
    return _split_summary(windows.consecutive_windows(
        kept_projects(spark, sf_dir, "posted", funding.LATE), "posted", {"months": 12}))


@register(f"""
WITH {PROJECTS_SQL}, {SPLITS_SQL},
med AS (SELECT split_id, role, median(days) AS m FROM member GROUP BY 1, 2)
SELECT split_id, role, count(*) AS n, count(*) FILTER (days IS NULL) AS n_filled,
       round(sum(coalesce(days, m)), 4) AS total FROM member JOIN med USING (split_id, role) GROUP BY 1, 2
""")
def impute_per_split(spark, sf_dir):
    found = windows.imputed_summary(_windows(spark, sf_dir, funding.DAYS), [funding.DAYS], Scratch(spark))
    return rounded(found.select("split_id", "role", "n", "n_filled", "total"), 4)


def edges_sql(count: int) -> str:
    inner = ", ".join(f"quantile_cont(value, {i / count!r}::DOUBLE)" for i in range(count + 1))
    return f"e AS (SELECT list_sort(list_distinct([{inner}])) AS edges FROM events)"


@register(f"""
WITH {edges_sql(10)}
SELECT greatest(1, len([x for x in edges if x < value])) AS value_bin, count(*) AS n, min(value) AS lo, max(value) AS hi
FROM events, e GROUP BY 1
""")
def quantile_bins(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("original", F.col("value"))
    cut = features.cut_variable(events, "value", 10)
    return cut.groupBy(F.col("value_bin").cast("bigint").alias("value_bin")).agg(
        F.count(F.lit(1)).alias("n"), F.min("original").alias("lo"), F.max("original").alias("hi"))


@register("""
SELECT CASE WHEN l_quantity BETWEEN 5 AND 10 THEN 'few' WHEN l_quantity > 10 AND l_quantity <= 30 THEN 'some'
            WHEN l_quantity > 30 AND l_quantity <= 45 THEN 'many' END AS l_quantity, count(*) AS n FROM lineitem GROUP BY 1
""")
def edge_bins(spark, sf_dir):
    cut = features.cut_variable(table(spark, sf_dir, "lineitem"), "l_quantity", [5, 10, 30, 45], ["few", "some", "many"])
    return cut.groupBy("l_quantity").agg(F.count(F.lit(1)).alias("n"))


@register("""
SELECT CASE WHEN l_quantity >= 5 AND l_quantity < 10 THEN '[5.0, 10.0)' WHEN l_quantity >= 10 AND l_quantity < 30 THEN '[10.0, 30.0)'
            WHEN l_quantity >= 30 AND l_quantity < 45 THEN '[30.0, 45.0)' END AS l_quantity, count(*) AS n FROM lineitem GROUP BY 1
""")
def edge_bins_left(spark, sf_dir):
    cut = features.cut_variable(table(spark, sf_dir, "lineitem"), "l_quantity", [5, 10, 30, 45], closed="left")
    return cut.groupBy("l_quantity").agg(F.count(F.lit(1)).alias("n"))


@register(f"""
WITH {PROJECTS_SQL}, {SPLITS_SQL},
e AS (SELECT split_id, [{', '.join(f'quantile_cont(price, {i / 4}::DOUBLE)' for i in range(5))}] AS edges
      FROM member WHERE role = 'train' GROUP BY 1)
SELECT split_id, role, 'q' || least(4, greatest(1, len([x for x in edges if x < price]))) AS price, count(*) AS n
FROM member JOIN e USING (split_id) GROUP BY 1, 2, 3
""")
def fitted_bins(spark, sf_dir):
    found = windows.bin_counts(_windows(spark, sf_dir, "price"), "price", 4, Scratch(spark))
    return found.select("split_id", "role", features.bin_label(F.col("bin"), F.array(), ["q1", "q2", "q3", "q4"]).alias("price"), "n")


@register(f"""
WITH {GAPS_SQL} SELECT projectid, coalesce(resource = 'O', false) AS "resource_O", coalesce(resource = 'P', false) AS "resource_P" FROM g
""")
def dummies_flag(spark, sf_dir):
    return features.create_dummies(_gaps(spark, sf_dir).select("projectid", "resource"), "resource")


@register(f"""
WITH {GAPS_SQL} SELECT projectid, resource = 'O' AS "resource_O", resource = 'P' AS "resource_P" FROM g
""")
def dummies_null(spark, sf_dir):
    return features.create_dummies(_gaps(spark, sf_dir).select("projectid", "resource"), "resource", missing="null")


@register(f"""
WITH {GAPS_SQL} SELECT projectid, CAST(coalesce(resource = 'O', false) AS INT) AS "resource_O",
  CAST(coalesce(resource = 'P', false) AS INT) AS "resource_P", CAST(resource IS NULL AS INT) AS resource_nan,
  CAST(coalesce(grade = '1-URGENT', false) AS INT) AS "grade_1_URGENT", CAST(coalesce(grade = '2-HIGH', false) AS INT) AS "grade_2_HIGH",
  CAST(coalesce(grade = '3-MEDIUM', false) AS INT) AS "grade_3_MEDIUM",
  CAST(coalesce(grade = '4-NOT SPECIFIED', false) AS INT) AS "grade_4_NOT_SPECIFIED", CAST(grade IS NULL AS INT) AS grade_nan
FROM g
""")
def dummies_int(spark, sf_dir):
    return features.create_dummies_many(
        _gaps(spark, sf_dir).select("projectid", "resource", "grade"), ["resource", "grade"], dummy_na=True)


@register("""
WITH c AS (SELECT o_custkey, row_number() OVER (ORDER BY count(*) DESC, CAST(o_custkey AS VARCHAR)) - 1 AS dummy FROM orders GROUP BY 1)
SELECT o_orderkey, dummy FROM orders JOIN c USING (o_custkey)
""")
def dummies_sparse(spark, sf_dir):
    """A column with too many values for columns of their own: which entry of the sparse vector is 1."""
    encoded = features.sparse_dummies(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), ["o_custkey"], keep_index=True)
    return encoded.select("o_orderkey", F.col("o_custkey_index").cast("bigint").alias("dummy"))


@register(f"""
WITH {PROJECTS_SQL}, {SPLITS_SQL}, r AS (SELECT split_id, max(price) AS a, min(price) AS b FROM member WHERE role = 'train' GROUP BY 1)
SELECT split_id, role, round(min((2 * price - (a + b)) / (a - b)), 6) AS lo, round(max((2 * price - (a + b)) / (a - b)), 6) AS hi,
       round(avg((2 * price - (a + b)) / (a - b)), 6) AS mean FROM member JOIN r USING (split_id) GROUP BY 1, 2
""")
def minmax_scale(spark, sf_dir):
    return rounded(windows.scaled_summary(_windows(spark, sf_dir, "price"), ["price"]).drop("column"))


@register("""
SELECT l_orderkey, l_linenumber, round((2 * l_extendedprice - (a + b)) / (a - b), 6) AS l_extendedprice
FROM lineitem, (SELECT max(l_extendedprice) AS a, min(l_extendedprice) AS b FROM lineitem)
""")
def minmax_scale_all(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return rounded(features.scale_variable_minmax(lines, "l_extendedprice"))


@register(f"""
WITH {PROJECTS_SQL}, {SPLITS_SQL},
c AS (SELECT split_id, teacher, count(*) FILTER (role = 'train') AS t, count(*) AS a FROM member GROUP BY 1, 2)
SELECT split_id, role, sum(CASE WHEN role = 'train' THEN t ELSE a END)::BIGINT AS total,
       max(CASE WHEN role = 'train' THEN t ELSE a END) AS most FROM member JOIN c USING (split_id, teacher) GROUP BY 1, 2
""")
def occurrence_counts(spark, sf_dir):
    return windows.occurrence_summary(_windows(spark, sf_dir, "teacher"), "teacher")


@register("SELECT o_orderkey, count(*) OVER (PARTITION BY o_custkey) AS o_custkey_n_occur FROM orders")
def occurrence_counts_all(spark, sf_dir):
    counted = features.generate_n_occurrences(
        table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), "o_custkey", spread_on=["o_orderkey"])
    return counted.select("o_orderkey", "o_custkey_n_occur")


@register(f"""
WITH {PROJECTS_SQL}
SELECT projectid, days AS daystofullfunding, late AS not_fully_funded_60days, price > 250000 AS expensive,
       coalesce(balance >= 0, false) AS in_credit, CAST(resource = 'F' AS DOUBLE) AS finished FROM projects
""")
def labels_and_cuts(spark, sf_dir):
    return projects(spark, sf_dir).select(
        "projectid", funding.DAYS, funding.LATE, cut_binary(F.col("price"), 250000).alias("expensive"),
        cut_binary(F.col("balance"), 0, or_equal_to=True).alias("in_credit"),
        flag_to_double(F.col("resource"), "F").alias("finished"))


@register("""
SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS at, CAST(month(ts) AS INT) AS month,
       event_type = 'click' AND ts >= '2024-01-10' AND ts < '2024-01-20' AS wanted FROM events
""")
def parsed_dates(spark, sf_dir):
    """Timestamps written as text and parsed back."""
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    parsed = table(spark, sf_dir, "events").withColumn("at", to_timestamp(text))
    return parsed.select(
        "event_id", F.date_format("at", "yyyy-MM-dd HH:mm:ss").alias("at"),
        F.month(month_on_common_year(F.col("at"))).alias("month"),
        ((F.col("event_type") == "click") & within_dates(F.col("at"), ("2024-01-10", "2024-01-20"))).alias("wanted"))


# --- evaluation -----------------------------------------------------------------------------------

def topk_sql(tie_order: str, thresholds: list[float]) -> str:
    listed = ", ".join(f"{t!r}::DOUBLE" for t in thresholds)
    return SCORES_SQL + f""",
    t AS (SELECT unnest([{listed}]) AS threshold),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY year ORDER BY score DESC, {tie_order}, projectid) AS r,
                      count(*) OVER (PARTITION BY year) AS n FROM scores),
    k AS (SELECT year, threshold, count(*) AS n, sum(late) AS p, count(*) FILTER (r <= floor(threshold * n)) AS predicted,
                 coalesce(sum(late) FILTER (r <= floor(threshold * n)), 0) AS tp
          FROM ranked, t GROUP BY 1, 2),
    m AS (SELECT year, threshold, (n - p - predicted + 2 * tp) / n AS accuracy,
                 CASE WHEN predicted = 0 THEN 0 ELSE tp / predicted END AS "precision",
                 CASE WHEN p = 0 THEN 0 ELSE tp / p END AS recall,
                 CASE WHEN predicted + p = 0 THEN 0 ELSE 2 * tp / (predicted + p) END AS f1,
                 (CASE WHEN p = 0 THEN NULL ELSE tp / p END + 1 - CASE WHEN n = p THEN NULL ELSE (predicted - tp) / (n - p) END) / 2 AS auc_last
          FROM k)"""


AUC_SQL = """
pairs AS (SELECT year, score, count(*) AS n, sum(late) AS pos FROM scores GROUP BY 1, 2),
below AS (SELECT *, coalesce(sum(n - pos) OVER (PARTITION BY year ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below FROM pairs),
auc AS (SELECT year, sum(pos * (neg_below + (n - pos) / 2.0)) / nullif(sum(pos) * sum(n - pos), 0) AS auc_roc FROM below GROUP BY 1)
"""


def metrics_sql(tie_order: str) -> str:
    long = " UNION ALL ".join(
        f"SELECT year, '{name}' AS metric, threshold, round(CAST({source} AS DOUBLE), 6) AS value FROM m"
        for name, source in (("accuracy", "accuracy"), ("precision", '"precision"'), ("recall", "recall"), ("f1", "f1")))
    return f"""
    WITH {topk_sql(tie_order, evaluate.THRESHOLDS)}, {AUC_SQL} {long}
    UNION ALL SELECT year, 'auc_roc', NULL, round(CAST(auc_roc AS DOUBLE), 6) FROM auc
    UNION ALL SELECT year, 'auc_at_last_threshold', NULL, round(CAST(auc_last AS DOUBLE), 6) FROM m WHERE threshold = 0.5
    """


def _metrics(spark, sf_dir, tie_breaker):
    return rounded(evaluate.evaluate_classifier(
        scores(spark, sf_dir), "score", "late", key="projectid", tie_breaker=tie_breaker, by=["year"]))


@register(metrics_sql("late"))
def topk_metrics_pessimistic(spark, sf_dir):
    return _metrics(spark, sf_dir, "pessimistic")


@register(metrics_sql("late DESC"))
def topk_metrics_optimistic(spark, sf_dir):
    return _metrics(spark, sf_dir, "optimistic")


@register(f"""
WITH {topk_sql("late", evaluate.curve_thresholds())}
SELECT year, round(threshold, 6) AS threshold, round(CAST("precision" AS DOUBLE), 6) AS "precision",
       round(CAST(recall AS DOUBLE), 6) AS recall FROM m
""")
def topk_curve(spark, sf_dir):
    return rounded(evaluate.precision_recall_at_shares(
        scores(spark, sf_dir), "score", "late", key="projectid", tie_breaker="pessimistic", by=["year"]))


@register(f"""
WITH {PROJECTS_SQL},
r AS (SELECT projectid, price, late, metro, row_number() OVER (PARTITION BY metro ORDER BY price DESC, projectid) AS r,
             count(*) OVER (PARTITION BY metro) AS n FROM projects)
SELECT metro, projectid, price, late, r <= floor(0.1::DOUBLE * n) AS prediction FROM r
""")
def topk_predictions(spark, sf_dir):
    rows = projects(spark, sf_dir).select("metro", "projectid", "price", F.col(funding.LATE).alias("late"))
    return evaluate.predict_target_class(rows, "projectid", "price", 0.1, "random", by=["metro"])


@register(f"""
WITH {topk_sql("late", [0.05, 0.3])}
SELECT year, threshold, n, CAST(p AS BIGINT) AS p, predicted FROM k
""")
def topk_random_counts(spark, sf_dir):
    """Seeded random ties: which tied rows are taken differs from SQL, how many does not."""
    rows = scores(spark, sf_dir)
    pieces = [
        evaluate.predict_target_class(rows, "projectid", "score", t, "random", seed=5, by=["year"]).groupBy("year").agg(
            F.lit(t).alias("threshold"), F.count(F.lit(1)).alias("n"), F.count_if("late").alias("p"),
            F.count_if("prediction").alias("predicted"))
        for t in (0.05, 0.3)
    ]
    return pieces[0].unionByName(pieces[1])


def tied_sql(tie_order: str) -> str:
    return f"""
    WITH {topk_sql(tie_order, [0.1])},
    r AS (SELECT year, score, late, r <= floor(0.1::DOUBLE * n) AS prediction FROM ranked)
    SELECT year, score, late, prediction, count(*) AS n FROM r GROUP BY ALL
    """


def _tied_predictions(spark, sf_dir, tie_breaker):
    """Which of the tied rows of a class are taken is the hash's choice; how many is not."""
    rows = scores(spark, sf_dir).withColumns({"late": F.col("late").cast("int"), "k": F.lit("unused"), "pos": F.lit(True)})
    marked = evaluate.predict_target_class(rows, "projectid", "score", 0.1, tie_breaker, "late", by=["year"])
    return marked.groupBy("year", "score", "late", "prediction").agg(F.count(F.lit(1)).alias("n"))


@register(tied_sql("late"))
def topk_predictions_pessimistic(spark, sf_dir):
    return _tied_predictions(spark, sf_dir, "pessimistic")


@register(tied_sql("late DESC"))
def topk_predictions_optimistic(spark, sf_dir):
    return _tied_predictions(spark, sf_dir, "optimistic")


@register()
def topk_metrics_random(spark, sf_dir):
    """No SQL: the seeded hash decides among tied rows."""
    return _metrics(spark, sf_dir, "random")


@register(f"""
WITH {SCORES_SQL},
t AS (SELECT unnest([{", ".join(f"{t!r}::DOUBLE" for t in evaluate.THRESHOLDS)}]) AS threshold,
             unnest([{", ".join(f"{1 - t!r}::DOUBLE" for t in evaluate.THRESHOLDS)}]) AS q),
o AS (SELECT year, score, row_number() OVER (PARTITION BY year ORDER BY score) - 1 AS i,
             count(*) OVER (PARTITION BY year) AS n FROM scores),
c AS (SELECT year, threshold,
             max(score) FILTER (i = floor((n - 1) * q)) + (max(score) FILTER (i = ceil((n - 1) * q))
             - max(score) FILTER (i = floor((n - 1) * q))) * max((n - 1) * q - floor((n - 1) * q)) AS cut
      FROM o, t GROUP BY 1, 2),
k AS (SELECT s.year, threshold, count(*) AS n, sum(late) AS p, count(*) FILTER (score >= cut) AS predicted,
             coalesce(sum(late) FILTER (score >= cut), 0) AS tp FROM scores s JOIN c USING (year) GROUP BY 1, 2)
SELECT year, threshold, 'accuracy' AS metric, round(CAST((n - p - predicted + 2 * tp) / n AS DOUBLE), 6) AS value FROM k
UNION ALL SELECT year, threshold, 'precision', round(CAST(tp / predicted AS DOUBLE), 6) FROM k
UNION ALL SELECT year, threshold, 'recall', round(CAST(CASE WHEN p = 0 THEN 0 ELSE tp / p END AS DOUBLE), 6) FROM k
UNION ALL SELECT year, threshold, 'f1', round(CAST(2 * tp / (predicted + p) AS DOUBLE), 6) FROM k
""")
def quantile_metrics_v2(spark, sf_dir):
    return rounded(evaluate.quantile_metrics(scores(spark, sf_dir), "score", "late", by=["year"]))


@register(f"WITH {SCORES_SQL}, {AUC_SQL} SELECT year, round(CAST(auc_roc AS DOUBLE), 6) AS auc_roc FROM auc")
def auc_exact(spark, sf_dir):
    return rounded(evaluate.auc_roc(scores(spark, sf_dir), "score", "late", by=["year"]))


@register(f"""
WITH {SCORES_SQL},
c AS (SELECT year, score, count(*) AS n, sum(late) AS p FROM scores GROUP BY 1, 2),
r AS (SELECT year, score, sum(n) OVER w AS n, sum(p) OVER w AS tp, sum(p) OVER (PARTITION BY year) AS p
      FROM c WINDOW w AS (PARTITION BY year ORDER BY score DESC))
SELECT year, score, round(CAST(tp / n AS DOUBLE), 6) AS "precision",
       round(CAST(CASE WHEN p = 0 THEN 0 ELSE tp / p END AS DOUBLE), 6) AS recall FROM r
""")
def pr_curve(spark, sf_dir):
    return rounded(evaluate.precision_recall_curve(scores(spark, sf_dir), "score", "late", by=["year"]))


@register(f"WITH {PROJECTS_SQL}, {SPLITS_SQL} SELECT split_id, role, round(avg(CAST(late AS INT)), 6) AS baseline FROM member GROUP BY 1, 2")
def positive_share(spark, sf_dir):
    return rounded(windows.baseline(_windows(spark, sf_dir, funding.LATE), funding.LATE))


# --- models ---------------------------------------------------------------------------------------

@register("""
WITH v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
train AS (SELECT * FROM v WHERE vec_id % 2 = 0), test AS (SELECT * FROM v WHERE vec_id % 2 = 1),
d AS (SELECT q.vec_id, CAST(t.label < 5 AS INT) AS pos,
             row_number() OVER (PARTITION BY q.vec_id ORDER BY list_distance(q.e, t.e), t.vec_id) AS r
      FROM test q, train t)
SELECT vec_id, round(avg(pos), 6) AS score FROM d WHERE r <= 5 GROUP BY 1
""")
def knn_scores(spark, sf_dir):
    """Every odd row is scored by its five nearest even rows: a train and a test set that cover the table."""
    vectors = table(spark, sf_dir, "embeddings").select(
        "vec_id", "embedding", (F.col("label") < 5).cast("int").alias("positive"))
    train = vectors.where(F.col("vec_id") % 2 == 0)
    test = vectors.where(F.col("vec_id") % 2 == 1).select("vec_id", "embedding")
    found = NearestNeighbours(train, "vec_id", "embedding", "positive", 5).score(test)
    return rounded(found.select("vec_id", "score"))


GRID_SPECS = [
    {"model": "dt", "name": "tree", "criterion": "entropy", "max_depth": 3},
    {"model": "lr", "name": "logistic l2", "penalty": "l2", "C": 1.0},
    {"model": "lr", "name": "logistic l1", "penalty": "l1", "C": 1.0, "max_iter": 300},
    {"model": "svc", "name": "support vectors", "C": 0.75, "max_iter": 50},
    {"model": "rf", "name": "forest", "criterion": "entropy", "n_estimators": 10, "max_depth": 8},
    {"model": "bagging", "name": "bagging", "n_estimators": 5, "max_depth": 8},
    {"model": "boosting", "name": "boosting", "n_estimators": 5},
    {"model": "knn", "name": "neighbours", "n_neighbors": 5},
    {"model": "dummy", "name": "baseline", "strategy": "most_frequent"},
]

PIPELINE_FEATURES = {
    "n_occur_cols": ["teacher"], "scale_cols": ["price", "balance", "teacher_n_occur"], "bin_cols": {},
    "dummy_cols": ["grade", "resource", "poverty", "state", "metro"], "binary_cut_cols": {},
    "drop_cols": ["teacher", "funded", "daystofullfunding"],
}


@register()
def model_grid_results(spark, sf_dir):
    """No SQL: trained models. All model types on three splits, evaluated in one table."""
    metrics = funding.apply_pipeline(
        kept_projects(spark, sf_dir, "*"), {"methods": {"resource": "manual"}, "manual_vals": {"resource": "N/A"}},
        PIPELINE_FEATURES, GRID_SPECS, key="projectid", date_col="posted", time_length={"months": 24})
    return rounded(evaluate.results_table(metrics))


@register()
def earlier_pipeline_results(spark, sf_dir):
    """No SQL: trained models. The earlier pipeline: cleaned before splitting, quantile cut-offs."""
    specs = [{"model": "dt", "criterion": "entropy", "max_depth": 5}, {"model": "lr"},
             {"model": "dummy", "strategy": "most_frequent"}]
    metrics = funding.apply_earlier_pipeline(
        kept_projects(spark, sf_dir, "*"), specs, date_col="posted", manual_fill=["resource"], deciles=["price", "balance"],
        categories=["grade", "resource", "poverty", "metro", "state"], unused=["teacher", "funded", funding.DAYS],
        time_length={"months": 24})
    return rounded(evaluate.results_table(metrics))


@register()
def credit_tree_accuracy(spark, sf_dir):
    """No SQL: one decision tree on binned and dummy-coded columns, scored on its own training rows."""
    people = projects(spark, sf_dir).select(
        "projectid", F.col(funding.LATE).cast("double").alias("distress"), "metro", "price", "balance",
        (F.col("teacher") % 3).cast("double").alias("late_payments"))
    return rounded(credit.build_and_score(
        people, "distress", "projectid", group="metro", quantile_bins={"price": 20, "balance": 10},
        late_counts=["late_payments"]))


# --- sources --------------------------------------------------------------------------------------

@register("SELECT doc_id, text, lang, source, n_chars FROM documents")
def csv_documents(spark, sf_dir):
    """Texts with quotes, separators and line breaks, written as CSV and read back."""
    path = Scratch(spark).path("documents")
    writer = table(spark, sf_dir, "documents").write.option("header", True).option("escape", '"').option("quoteAll", True)
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return read_csv(spark, path, col_types={"doc_id": "bigint", "n_chars": "bigint"}, index_col="doc_id")


@register("""
SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) AS date, CAST(year(o_orderdate) AS INT) AS year,
       o_totalprice AS latitude, CAST(NULL AS DOUBLE) AS longitude FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 1998
""")
def loaded_reports(spark, sf_dir):
    """Event records with texts for dates and numbers, written out and loaded for three years."""
    path = Scratch(spark).path("reports")
    table(spark, sf_dir, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("date"), F.year("o_orderdate").alias("year"),
        F.col("o_totalprice").cast("string").alias("latitude"), F.lit("NaN").alias("longitude")).write.parquet(path)
    return load_reports(spark, path, 1996, 1998)
