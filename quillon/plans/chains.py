"""Registered queries of whole chains: sources read back, the block profile from points to summary, features, and facts about models."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.operators import cleaning, evaluate, features, summaries, windows
from quillon.operators.models import FEATURES, SCORE, generate_classifiers, predict_target_probability
from quillon.plans import crime, funding
from quillon.plans.catalog import AREAS_SQL, GAPS_SQL, GRID_SPECS, SPLITS_SQL, _gaps, _windows, register
from quillon.plans.grid import score_grid
from quillon.plans.views import PROJECTS_SQL, kept_projects, projects, rounded, table
from quillon.session import Scratch, materialize, spread
from quillon.sources import (
    BACHELORS, BLACK, BLOCK_CODES, BLOCK_MEASURES, HISPANIC, INCOME, NO_ESTIMATE, PROFILE_COLUMNS, WHITE, load_areas, load_block_stats, load_blocks,
    transform_block_stats, write_table)

# --- pivots of any number of values -----------------------------------------------------------------


@register("""
WITH c AS (SELECT o_orderpriority, o_orderstatus, o_custkey, count(*) AS n FROM orders GROUP BY 1, 2, 3)
SELECT o_orderpriority, o_orderstatus, count(*) AS n_values, string_agg(o_custkey || ':' || n, ',' ORDER BY o_custkey) AS counts,
       coalesce(max(n) FILTER (o_custkey = 7), 0) AS of_seven FROM c GROUP BY 1, 2
""")
def block_pivot_map(spark, sf_dir):
    """A pivot over all customers, as a map in the order of the values."""
    found = summaries.map_by_block(table(spark, sf_dir, "orders"), "o_custkey", ("o_orderpriority", "o_orderstatus"))
    text = F.transform(F.map_entries("counts"), lambda e: F.concat(e["key"].cast("string"), F.lit(":"), e["value"].cast("string")))
    return found.select(
        "o_orderpriority", "o_orderstatus", F.size("counts").cast("bigint").alias("n_values"), F.array_join(text, ",").alias("counts"),
        summaries.count_of(F.col("counts"), F.lit(7).cast(found.schema["counts"].dataType.keyType)).alias("of_seven"))


@register("SELECT o_orderpriority, o_custkey, count(*) AS n FROM orders WHERE o_orderpriority IS NOT NULL AND o_custkey IS NOT NULL GROUP BY 1, 2")
def block_counts_long(spark, sf_dir):
    return summaries.count_by_block(table(spark, sf_dir, "orders"), "o_custkey", ("o_orderpriority",))


# --- sources read back ------------------------------------------------------------------------------

def _square(key, size):
    """GeoJSON of a square, its first corner at a place made from the key."""
    x, y = (key * 37 % 900).cast("string"), (key * 61 % 90).cast("string")
    x2, y2 = (key * 37 % 900 + size).cast("string"), (key * 61 % 90 + size).cast("string")
    corners = [(x, y), (x2, y), (x2, y2), (x, y2), (x, y)]
    return F.concat(F.lit("[["), F.concat_ws(",", *[F.concat(F.lit("["), a, F.lit(","), b, F.lit("]")) for a, b in corners]), F.lit("]]"))


def _geometry(key):
    polygon = F.concat(F.lit('{"type":"Polygon","coordinates":'), _square(key, 5), F.lit("}"))
    several = F.concat(F.lit('{"type":"MultiPolygon","coordinates":['), _square(key, 5), F.lit(","), _square(key + 1, 2), F.lit("]}"))
    return F.when(key % 3 == 0, several).otherwise(polygon)


def _shape(areas: DataFrame) -> list:
    first = F.col("the_geom")[0][0]
    points = F.aggregate(F.transform("the_geom", lambda ring: F.size(ring)), F.lit(0), lambda a, b: a + b)
    return [F.size("the_geom").cast("bigint").alias("n_rings"), points.cast("bigint").alias("n_points"), first["x"].alias("x"), first["y"].alias("y")]


SHAPE_SQL = """CASE WHEN s_suppkey % 3 = 0 THEN 2 ELSE 1 END AS n_rings, CASE WHEN s_suppkey % 3 = 0 THEN 10 ELSE 5 END AS n_points,
  CAST((s_suppkey * 37) % 900 AS DOUBLE) AS x, CAST((s_suppkey * 61) % 90 AS DOUBLE) AS y FROM supplier"""


@register(f"SELECT CAST(s_suppkey AS VARCHAR) AS area_number, s_name AS community, {SHAPE_SQL}")
def loaded_areas(spark, sf_dir):
    """Areas written as JSON lines, with the number under either spelling, and loaded."""
    path, key = Scratch(spark).path("areas"), F.col("s_suppkey")
    number = [F.when((key % 2 == 0) == even, key.cast("string")).alias(n) for n, even in (("area_numbe", True), ("area_number", False))]
    write_table(table(spark, sf_dir, "supplier").select(*number, F.col("s_name").alias("community"), _geometry(key).alias("the_geom")), path, "json")
    areas = load_areas(spark, path)
    return areas.select("area_number", "community", *_shape(areas))


@register(f"SELECT left(lpad(CAST(s_suppkey AS VARCHAR), 12, '1'), 9) AS geoid10, {SHAPE_SQL}")
def loaded_blocks(spark, sf_dir):
    """Census blocks written as JSON lines and loaded; a block's group is its id without the last three characters."""
    path, key = Scratch(spark).path("blocks"), F.col("s_suppkey")
    write_table(table(spark, sf_dir, "supplier").select(F.lpad(key.cast("string"), 12, "1").alias("geoid10"), _geometry(key).alias("the_geom")), path, "json")
    blocks = load_blocks(spark, path)
    return blocks.select("geoid10", *_shape(blocks))


@register("""
WITH m AS (SELECT c_custkey, c_nationkey, c_mktsegment, CAST(c_custkey % 50 + 1 AS DOUBLE) AS s, CASE WHEN c_custkey % 7 <> 0 THEN CAST(c_custkey % 40 AS DOUBLE) END AS w,
  CAST(c_custkey % 13 AS DOUBLE) AS b, CAST(c_custkey % 9 AS DOUBLE) AS h, CASE WHEN c_custkey % 11 <> 0 THEN c_acctbal END AS income FROM customer)
SELECT concat(c_nationkey, c_mktsegment, '00', c_custkey) AS geoid10, round(w * 100 / s, 6) AS white, round(b * 100 / s, 6) AS black,
  round(h * 100 / s, 6) AS hispanic, round(4 * h * 100 / s, 6) AS degree, round(income, 6) AS income FROM m
""")
def loaded_block_stats(spark, sf_dir):
    """Census measures written as CSV, codes for missing ones included, and loaded with their percentages."""
    key, path = F.col("c_custkey"), Scratch(spark).path("stats")
    none = F.lit(float(NO_ESTIMATE))
    measures = {
        "Race sample": key % 50 + 1, "White alone": F.when(key % 7 == 0, none).otherwise(key % 40), "Black alone": key % 13,
        "Hispanic or Latino sample": key % 50 + 1, "Hispanic or Latino": key % 9, "Education sample": key % 50 + 1, INCOME: F.when(key % 11 == 0, none).otherwise(F.col("c_acctbal"))}
    columns = [measures.get(label, key % 9).cast("double").alias(code) for code, label in BLOCK_MEASURES.items()]
    codes = dict(zip(BLOCK_CODES, (F.col("c_nationkey"), F.col("c_mktsegment"), F.lit("00"), key), strict=True))
    write_table(table(spark, sf_dir, "customer").select(*columns, *[v.cast("string").alias(c) for c, v in codes.items()]), path, "csv")
    names = {WHITE: "white", BLACK: "black", HISPANIC: "hispanic", BACHELORS: "degree", INCOME: "income"}
    return rounded(load_block_stats(spark, path).select("geoid10", *[F.col(f"`{c}`").alias(n) for c, n in names.items()]))


@register("SELECT o_orderstatus, o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus IS NOT NULL")
def written_table(spark, sf_dir):
    """A table written in parts by a column and read back."""
    path = Scratch(spark).path("written")
    write_table(table(spark, sf_dir, "orders").select("o_orderstatus", "o_orderkey", "o_custkey", "o_totalprice"), path, partition_by=["o_orderstatus"])
    return spark.read.parquet(path).select("o_orderstatus", "o_orderkey", "o_custkey", "o_totalprice")


# --- the block profile from points to summary ---------------------------------------------------------

PROFILE_SQL = """
  SELECT s_suppkey AS geoid10, (s_suppkey % 40) * 100.0 / (s_suppkey % 50 + 1) AS white, (s_suppkey % 13) * 100.0 / (s_suppkey % 50 + 1) AS black,
    (s_suppkey % 9) * 100.0 / (s_suppkey % 50 + 1) AS hispanic, 4 * (s_suppkey % 9) * 100.0 / (s_suppkey % 50 + 1) AS degree, CAST(s_acctbal AS DOUBLE) AS income FROM supplier"""


@register(f"""
WITH {AREAS_SQL}, stats AS ({PROFILE_SQL}),
placed AS (SELECT l_suppkey AS block, l_returnflag AS type, floor(l_extendedprice / 100) AS x, l_quantity + floor(l_discount * 100) / 2 AS y
           FROM lineitem WHERE l_returnflag IN ('A', 'N')),
l AS (SELECT block, area AS geoid10, type FROM placed JOIN areas ON x > x0 AND x < x0 + w AND y > y0 AND y < y0 + h),
b AS (SELECT DISTINCT block, geoid10, type FROM l),
v AS (UNPIVOT (SELECT type, white, black, hispanic, degree, income FROM b JOIN stats USING (geoid10)) ON white, black, hispanic, degree, income INTO NAME measure VALUE v)
SELECT type, measure, count(v) AS count, round(avg(v), 4) AS mean, round(stddev_samp(v), 4) AS std, round(min(v), 4) AS min, round(quantile_cont(v, 0.25), 4) AS p25,
  round(quantile_cont(v, 0.5), 4) AS p50, round(quantile_cont(v, 0.75), 4) AS p75, round(max(v), 4) AS max FROM v GROUP BY 1, 2
""")
def block_profile_chain(spark, sf_dir):
    """Points joined to areas, counted per block and type, and the measures of the blocks with a point of each type."""
    key = F.col("s_suppkey")
    x0, y0 = (key * 37 % 900).cast("double"), (key * 61 % 90).cast("double")
    x1, y1 = x0 + 5 + key % 40, y0 + 1 + key % 7

    def corner(x, y):
        return F.struct(x.alias("x"), y.alias("y"))

    suppliers = table(spark, sf_dir, "supplier")
    areas = suppliers.select(key.alias("geoid10"), F.array(F.array(corner(x0, y0), corner(x1, y0), corner(x1, y1), corner(x0, y1))).alias("the_geom"))
    reports = spread(table(spark, sf_dir, "lineitem").where("l_returnflag <> 'R'")).select(
        F.col("l_suppkey").alias("block"), F.col("l_returnflag").alias("primary_type"), F.floor(F.col("l_extendedprice") / 100).cast("double").alias("longitude"),
        (F.col("l_quantity") + F.floor(F.col("l_discount") * 100) / 2).alias("latitude"))
    sample = key % 50 + 1
    values = {"Race sample": sample, "White alone": key % 40, "Black alone": key % 13, "Hispanic or Latino sample": sample, "Hispanic or Latino": key % 9,
              "Education sample": sample, INCOME: F.col("s_acctbal")}
    measured = suppliers.select(
        key, *[values.get(label, key % 9).cast("double").alias(label) for label in BLOCK_MEASURES.values()], *[F.lit("").alias(c) for c in BLOCK_CODES])
    stats = transform_block_stats(measured).select(F.col("s_suppkey").alias("geoid10"), *[F.col(f"`{c}`") for c in PROFILE_COLUMNS])
    found = crime.block_profile(reports, areas, stats, ["A", "N"])
    labels = F.create_map(*[F.lit(x) for pair in zip(PROFILE_COLUMNS, ("white", "black", "hispanic", "degree", "income"), strict=True) for x in pair])
    parts = [t.select(F.lit(kind).alias("type"), labels[F.col("column")].alias("measure"), *[c for c in t.columns if c != "column"]) for kind, t in found.items()]
    return rounded(reduce(DataFrame.unionByName, parts), 4)


# --- cleaning, features, results ------------------------------------------------------------------------

@register(f"""
WITH {GAPS_SQL}
SELECT projectid, CAST(coalesce(daystofullfunding, med_days) AS DOUBLE) AS daystofullfunding, coalesce(resource, m_resource) AS resource,
  round(coalesce(price, med_price), 4) AS price, coalesce(grade, m_grade) AS grade FROM g, modes
""")
def replaced_missing(spark, sf_dir):
    filled = cleaning.replace_missing(materialize(_gaps(spark, sf_dir)), [funding.DAYS, "resource", "price", "grade"])
    return rounded(filled, 4)


@register(f"""
WITH {PROJECTS_SQL}, {SPLITS_SQL}, s AS (SELECT * FROM member WHERE split_id = 4),
c AS (SELECT teacher, count(*) FILTER (role = 'train') AS t, count(*) AS a FROM s GROUP BY 1),
r AS (SELECT max(price) AS a, min(price) AS b, max(balance) AS ba, min(balance) AS bb FROM s WHERE role = 'train'),
e AS (SELECT [quantile_cont(balance, 0.0), quantile_cont(balance, 1 / 3::DOUBLE), quantile_cont(balance, 2 / 3::DOUBLE), quantile_cont(balance, 1.0)] AS edges FROM s WHERE role = 'train')
SELECT projectid, role, CASE WHEN role = 'train' THEN t ELSE c.a END AS teacher_n_occur, round((2 * price - (r.a + r.b)) / (r.a - r.b), 6) AS price,
  'b' || least(3, greatest(1, len([x for x in edges if x < balance]))) AS balance, CAST(resource = 'O' AND EXISTS (SELECT 1 FROM s WHERE role = 'train' AND resource = 'O') AS BOOLEAN) AS "resource_O"
FROM s JOIN c USING (teacher), r, e
""")
def split_features(spark, sf_dir):
    """The feature table of one split before any fit: counts, scaling, fitted bins, dummies."""
    placed = _windows(spark, sf_dir, "projectid", "teacher", "price", "balance", "resource").kept(Scratch(spark))
    built = features.generate_features(
        placed.split(4).drop("posted"), ["teacher"], ["price"], {"balance": {"bins": 3, "labels": ["b1", "b2", "b3"]}}, ["resource"], drop_cols=["teacher"],
        spread_on=["projectid"], keep_categories=True)
    flagged = features.split_dummies(built, ["resource"])
    return rounded(flagged.select("projectid", "role", "teacher_n_occur", "price", "balance", "resource_O"))


@register(f"""
WITH {PROJECTS_SQL}, {SPLITS_SQL}, b AS (SELECT role, split_id, avg(CAST(late AS INT)) AS v FROM member WHERE split_id BETWEEN 2 AND 5 GROUP BY 1, 2)
SELECT role AS metric, round(max(v) FILTER (split_id = 2), 6) AS "2", round(max(v) FILTER (split_id = 3), 6) AS "3", round(max(v) FILTER (split_id = 4), 6) AS "4",
  round(max(v) FILTER (split_id = 5), 6) AS "5" FROM b GROUP BY 1
""")
def results_by_split(spark, sf_dir):
    """A results table: metrics in rows, the splits asked for in columns."""
    shares = windows.baseline(_windows(spark, sf_dir, funding.LATE), funding.LATE)
    metrics = shares.select(F.col("role").alias("metric"), "split_id", F.col("baseline").alias("value"))
    return rounded(evaluate.results_table(metrics, splits=[2, 3, 4, 5]))


@register(f"""
WITH {PROJECTS_SQL} SELECT CAST(year(posted) AS INT) AS year, round(avg(CAST((CAST(price > 150000 AS INT) = CAST(late AS INT)) AS INT)), 6) AS accuracy FROM projects GROUP BY 1
""")
def class_accuracy(spark, sf_dir):
    rows = projects(spark, sf_dir).select(F.year("posted").alias("year"), (F.col("price") > 150000).cast("int").alias("said"), F.col(funding.LATE).cast("int").alias("late"))
    return rounded(evaluate.accuracy(rows, "said", "late", ["year"]))


# --- facts about models -----------------------------------------------------------------------------------

MODEL_NAMES = ", ".join(f"('{spec['name']}')" for spec in GRID_SPECS)


@register(f"""
WITH {PROJECTS_SQL}, test AS (SELECT projectid FROM projects WHERE projectid % 4 = 0)
SELECT model, (SELECT count(*) FROM test) AS n_scores, (SELECT count(DISTINCT projectid) FROM test) AS n_keys, true AS in_range, true AS ordered
FROM (VALUES {MODEL_NAMES}) m(model)
""")
def model_facts(spark, sf_dir):
    """Every model type on a label that the price decides: one score a key, scores in range, and late projects before others on average.

    The dummy model gives every row one score, so that its means are equal.
    """
    rows = materialize(projects(spark, sf_dir).select("projectid", F.col("price").cast("double").alias("price"), F.coalesce("balance", F.lit(0.0)).alias("balance")))
    label = (F.col("price") > 150_000).cast("int").alias("label")
    ready = materialize(rows.select("projectid", label, array_to_vector(F.array(F.col("price") / 100_000, F.col("balance") / 10_000)).alias(FEATURES)))
    train, test = ready.where("projectid % 4 <> 0"), ready.where("projectid % 4 = 0")
    parts = []
    for spec, model in zip(GRID_SPECS, generate_classifiers(train, GRID_SPECS, "label", "projectid"), strict=True):
        scored = predict_target_probability(model, test)
        free = spec["model"] == "svc"  # a decision value
        inside = F.col(SCORE).isNotNull() & ~F.isnan(SCORE) & (F.lit(free) | F.col(SCORE).between(0, 1))
        means = [F.avg(F.when(F.col("label") == v, F.col(SCORE))) for v in (1, 0)]
        order = means[0] == means[1] if spec["model"] == "dummy" else means[0] > means[1]
        parts.append(scored.agg(
            F.count(SCORE).alias("n_scores"), F.countDistinct("projectid").alias("n_keys"), F.bool_and(inside).alias("in_range"), order.alias("ordered")).select(
            F.lit(spec["name"]).alias("model"), "n_scores", "n_keys", "in_range", "ordered"))
    return reduce(DataFrame.unionByName, parts)


@register(f"""
WITH {PROJECTS_SQL}, {SPLITS_SQL},
both_roles AS (SELECT split_id FROM member GROUP BY 1 HAVING count(DISTINCT role) = 2)
SELECT model_id, split_id, count(*) AS n_scores, count(DISTINCT projectid) AS n_keys, count(*) FILTER (late) AS n_late
FROM member JOIN both_roles USING (split_id), (VALUES (1), (2)) m(model_id) WHERE role = 'test' GROUP BY 1, 2
""")
def grid_scores_per_split(spark, sf_dir):
    """Two specifications over all splits: one score for each row of each test set."""
    placed = windows.temporal_windows(
        kept_projects(spark, sf_dir, "projectid", "posted", "price", "grade", funding.LATE), "posted", {"months": 6}, {"days": 60})
    specs = [{"model": "dummy", "strategy": "most_frequent"}, {"model": "dt", "max_depth": 2}]
    scores = score_grid(placed.without("posted"), specs, funding.LATE, "projectid", ["grade"])
    return scores.groupBy("model_id", "split_id").agg(
        F.count(SCORE).alias("n_scores"), F.countDistinct("projectid").alias("n_keys"), F.sum(funding.LATE).alias("n_late"))
