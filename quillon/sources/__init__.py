"""Loading tables with declared types, and writing results."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillon.functions import column, nan_to_null, percent, replace_sentinel, to_timestamp
from quillon.operators.spatial import RING_TYPE

# Texts that mean "missing" in a CSV file.
MISSING_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "N/A", "NA", "NULL",
    "NaN", "n/a", "nan", "null",
]
# Fixed value: the census code for "no estimate".
NO_ESTIMATE = -666666666

# Census measure codes and their labels.
BLOCK_MEASURES = {
    "B02001_001E": "Race sample",
    "B02001_002E": "White alone",
    "B02001_003E": "Black alone",
    "B03003_001E": "Hispanic or Latino sample",
    "B03003_003E": "Hispanic or Latino",
    "B15003_001E": "Education sample",
    "B15003_022E": "Bachelor's",
    "B15003_023E": "Master's",
    "B15003_024E": "Professional",
    "B15003_025E": "PhD",
    "B19301_001E": "Per Capita Income, last 12 months (2017 inflation adjusted dollars)",
}
BLOCK_CODES = ["state", "county", "tract", "block group"]
# The labels of the derived percentages.
WHITE, BLACK, HISPANIC = "White alone (%)", "Black alone (%)", "Hispanic or Latino (%)"
BACHELORS = "Bachelor's or more (>= 25 y/o) (%)"
INCOME = BLOCK_MEASURES["B19301_001E"]
PROFILE_COLUMNS = [WHITE, BLACK, HISPANIC, BACHELORS, INCOME]

POLYGON = "array<array<array<double>>>"


def read_csv(
    spark: SparkSession, path: str, cols: Sequence[str] | None = None,
    col_types: Mapping[str, str | T.DataType] | None = None, index_col: str | Sequence[str] | None = None,
    multiline: bool = True, bad_rows: str = "error",
) -> DataFrame:
    """Read a CSV file with a header, keeping the wanted columns.

    Quoted fields may hold separators, doubled quotes and, with ``multiline``, line breaks; files without line
    breaks in fields read faster, split into parts, when ``multiline`` is off. Types are declared, never
    inferred: only the header line is read beforehand. Columns without a type are text. Key columns stay
    ordinary columns and come first. Text that cannot be read as the declared type is missing. A row with
    another number of fields than the header is an error, or is left out with ``bad_rows="drop"``.
    """
    if bad_rows not in ("error", "drop"):
        raise ValueError("bad_rows must be error or drop")
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multiline).option("enforceSchema", False)
    header = reader.csv(path).columns
    types = dict(col_types or {})
    keys = [index_col] if isinstance(index_col, str) else list(index_col or [])
    wanted = list(cols) if cols is not None else header
    names = keys + [c for c in wanted if c not in keys]
    unknown = set(names) - set(header)
    if unknown:
        raise ValueError(f"columns not in the file: {sorted(unknown)}")
    torn = "__torn"
    schema = T.StructType([*[T.StructField(c, T.StringType()) for c in header], T.StructField(torn, T.StringType())])
    rows = reader.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", torn).option("columnPruning", False).csv(path)
    if bad_rows == "error":
        # Spark refuses queries on the record column alone, so a count has to name another column too
        message = F.concat_ws(" ", F.lit("row with a wrong number of fields:"), F.col(torn), F.substring(column(header[0]), 1, 0))
        rows = rows.where(F.when(F.col(torn).isNull(), True).otherwise(F.raise_error(message).cast("boolean")))
    else:
        rows = rows.where(F.col(torn).isNull() | (F.length(column(header[0])) < 0))
    texts = {c: F.when(~column(c).isin(MISSING_TEXTS), column(c)) for c in names}
    kinds = {c: _spark_type(types.get(c, "string")) for c in names}
    return nan_to_null(rows.select(*[
        (texts[c] if isinstance(kinds[c], T.StringType) else texts[c].try_cast(kinds[c])).alias(c) for c in names]))


def _spark_type(given) -> T.DataType:
    if isinstance(given, T.DataType):
        return given
    named = {str: "string", float: "double", int: "bigint", bool: "boolean"}
    return T._parse_datatype_string(named.get(given, given))


def load(spark: SparkSession, path: str, fmt: str = "parquet", schema: str | T.StructType | None = None) -> DataFrame:
    """A parquet, ORC, JSON or CSV table."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.load(path)


def load_reports(
    spark: SparkSession, path: str, start_year: int, end_year: int, fmt: str = "parquet",
    schema: str | T.StructType | None = None,
) -> DataFrame:
    """Event records of the years ``start_year`` to ``end_year``, both included.

    The year filter sits on the raw column when it is a number, so columnar files skip row groups.
    """
    raw = load(spark, path, fmt, schema)
    year = column("year")
    if not isinstance(raw.schema["year"].dataType, T.NumericType):
        year = F.try_to_number(year, F.lit("9999")).cast("int")
    wanted = raw.where(year.between(start_year, end_year))
    types = {f.name: f.dataType for f in raw.schema.fields}
    date = column("date").cast("timestamp_ntz")
    if isinstance(types["date"], T.StringType):
        date = to_timestamp(column("date"))
    typed = wanted.withColumns({
        "latitude": column("latitude").try_cast("double"), "longitude": column("longitude").try_cast("double"),
        "year": year.cast("int"), "date": date,
    })
    return nan_to_null(typed)


def rings_from_geojson(text: Column) -> Column:
    """Rings of a GeoJSON Polygon or MultiPolygon given as JSON text."""
    kind = F.get_json_object(text, "$.type")
    coordinates = F.get_json_object(text, "$.coordinates")
    single = F.from_json(coordinates, POLYGON)
    several = F.flatten(F.from_json(coordinates, f"array<{POLYGON}>"))
    rings = F.when(kind == "MultiPolygon", several).when(kind == "Polygon", single)
    points = F.transform(rings, lambda ring: F.transform(ring, lambda p: F.struct(
        F.get(p, 0).alias("x"), F.get(p, 1).alias("y"))))
    return points.cast(RING_TYPE)


def load_areas(spark: SparkSession, path: str) -> DataFrame:
    """Areas from JSON lines: number, name and rings. The source spells the number column ``area_numbe``."""
    raw = load(spark, path, "json", "area_numbe string, area_number string, community string, the_geom string")
    return raw.select(
        F.coalesce("area_numbe", "area_number").alias("area_number"), "community",
        rings_from_geojson(column("the_geom")).alias("the_geom"))


def block_group_id(block_id: Column) -> Column:
    """A census block id without its last three characters is the id of its block group."""
    text = block_id.cast("string")
    return F.left(text, F.greatest(F.length(text) - 3, F.lit(0)))


def load_blocks(spark: SparkSession, path: str) -> DataFrame:
    """Census blocks from JSON lines: the id of the block group and the rings of the block."""
    raw = load(spark, path, "json", "geoid10 string, the_geom string")
    return raw.select(
        block_group_id(column("geoid10")).alias("geoid10"), rings_from_geojson(column("the_geom")).alias("the_geom"))


def load_block_stats(spark: SparkSession, path: str) -> DataFrame:
    """Census measures per block group from a CSV file, labelled and with the derived percentages."""
    names = [*BLOCK_MEASURES, *BLOCK_CODES]
    types = {**dict.fromkeys(BLOCK_MEASURES, "double"), **dict.fromkeys(BLOCK_CODES, "string")}
    raw = read_csv(spark, path, cols=names, col_types=types)
    return transform_block_stats(raw.withColumnsRenamed(BLOCK_MEASURES))


def transform_block_stats(stats: DataFrame) -> DataFrame:
    """Make 'no estimate' missing, build the id, and express counts as percentages of their samples."""
    known = replace_sentinel(stats, NO_ESTIMATE)
    degrees = sum((column(c) for c in ("Bachelor's", "Master's", "Professional", "PhD")), F.lit(0.0))
    return known.withColumns({
        "geoid10": F.concat(*[column(c) for c in BLOCK_CODES]),
        WHITE: percent(column("White alone"), column("Race sample")),
        BLACK: percent(column("Black alone"), column("Race sample")),
        HISPANIC: percent(column("Hispanic or Latino"), column("Hispanic or Latino sample")),
        BACHELORS: percent(degrees, column("Education sample")),
    })


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", mode: str = "error", partition_by: Sequence[str] = (),
) -> None:
    """Write a result table."""
    writer = df.write.format(fmt).mode(mode)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
