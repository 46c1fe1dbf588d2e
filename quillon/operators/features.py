"""Binning, dummies, scaling and occurrence counts: fitted on training rows, applied to all rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillon.functions import as_double, column, cut_binary, safe_name
from quillon.operators.describe import long_numbers
from quillon.operators.joins import lookup
from quillon.operators.params import attach, drop_columns, fetch_bounded
from quillon.operators.ranks import exact_quantiles
from quillon.operators.splits import ROLE, SPLIT

# Beyond this many values a column belongs in a sparse vector, not in boolean columns.
MAX_DUMMIES = 1000


# --- bins -----------------------------------------------------------------------------------------

def quantile_edges(df: DataFrame, bins: Mapping[str, int], by: Sequence[str] = ()) -> DataFrame:
    """Edges of equally filled bins per column: ``by..., column, edges``; equal edges are merged."""
    by = list(by)
    pieces = []
    for count in sorted(set(bins.values())):
        names = [c for c, n in bins.items() if n == count]
        probabilities = [i / count for i in range(count + 1)]
        quantiles = [f"e{i}" for i in range(count + 1)]
        found = exact_quantiles(long_numbers(df, names, by), [*by, "column"], "value", probabilities, quantiles)
        pieces.append(found.select(*by, "column", F.array_distinct(F.array(*quantiles)).alias("edges")))
    edges = pieces[0]
    for piece in pieces[1:]:
        edges = edges.unionByName(piece)
    return edges


def bin_number(value: Column, edges: Column, closed: str = "right", open_ended: bool = False) -> Column:
    """1-based bin of ``value`` between sorted ``edges``; missing outside them.

    ``right``: bins are ``(a, b]`` and the first one also holds its lower edge. ``left``: ``[a, b)``.
    ``open_ended`` stretches the two outer bins to infinity.
    """
    last = F.size(edges) - 1
    if closed == "right":
        position = F.greatest(F.size(F.filter(edges, lambda e: e < value)), F.lit(1))
        inside = value.between(edges[0], edges[last])
    else:
        position = F.greatest(F.size(F.filter(edges, lambda e: e <= value)), F.lit(1))
        inside = (value >= edges[0]) & (value < edges[last])
    if open_ended:
        position = F.least(position, last)
        inside = value.isNotNull()
    return F.when(inside, position)


def bin_label(number: Column, edges: Column, labels: Sequence[str] | None = None, closed: str = "right") -> Column:
    if labels:
        return F.when(number.isNotNull(), F.get(F.array(*[F.lit(str(x)) for x in labels]), number - 1))
    left, right = ("(", "]") if closed == "right" else ("[", ")")
    a, b = F.get(edges, number - 1).cast("string"), F.get(edges, number).cast("string")
    return F.concat(F.lit(left), a, F.lit(", "), b, F.lit(right))


def cut_variable(
    df: DataFrame, name: str, bins: int | Sequence[float], labels: Sequence[str] | None = None,
    closed: str = "right", suffix: str = "_bin",
) -> DataFrame:
    """Replace a number by its bin label and append ``<name>_bin`` with the bin's number.

    An integer asks for equally filled bins, a list gives the edges (values outside become missing).
    """
    edges = fixed_edges(bins) if not isinstance(bins, int) else fit_edges(df, name, bins)
    if labels is not None and len(labels) != max(len(edges) - 1, 0):
        raise ValueError(f"{name} has {len(edges) - 1} bins, got {len(labels)} labels")
    literal = F.array(*[F.lit(float(e)) for e in edges]) if edges else F.array().cast("array<double>")
    number = bin_number(as_double(name), literal, closed)
    return df.withColumn(name + suffix, number).withColumn(
        name, bin_label(column(name + suffix), literal, labels, closed))


def fixed_edges(edges: Sequence[float]) -> list[float]:
    return sorted(float(e) for e in edges)


def fit_edges(df: DataFrame, name: str, bins: int) -> list[float]:
    row = quantile_edges(df, {name: bins}).first()
    return list(row.edges) if row else []


# --- dummies --------------------------------------------------------------------------------------

def frequent_values(df: DataFrame, name: str) -> list | None:
    """Values of a column, most frequent first, equally frequent ones in order; None if there are too many for columns."""
    counts = df.where(column(name).isNotNull()).groupBy(column(name).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    rows = fetch_bounded(counts.orderBy(F.desc("n"), "v"), MAX_DUMMIES)
    return None if rows is None else [r.v for r in rows]


def dummy_names(prefix: str, values: Sequence) -> list[str]:
    """Column names for values; values that look alike once cleaned get a number."""
    names: list[str] = []
    for v in values:
        base = f"{prefix}_{safe_name(v)}"
        name, i = base, 2
        while name in names:
            name, i = f"{base}_{i}", i + 1
        names.append(name)
    return names


def create_dummies(df: DataFrame, name: str, values: Sequence | None = None, missing: str = "false") -> DataFrame:
    """Replace a column by one true/false column per value.

    ``missing='false'`` makes all of them false where the value is missing, ``missing='null'`` leaves
    them missing there. More than ``MAX_DUMMIES`` values become one sparse vector column (``sparse_dummies``).
    """
    values = list(values) if values is not None else frequent_values(df, name)
    if values is None:
        return sparse_dummies(df, [name], missing=missing)
    text = column(name).cast("string")
    flags = [text == F.lit(str(v)) for v in values]
    if missing == "false":
        flags = [F.coalesce(f, F.lit(False)) for f in flags]
    named = [f.alias(n) for f, n in zip(flags, dummy_names(name, values), strict=True)]
    return drop_columns(df.select("*", *named), [name])


def sparse_dummies(
    df: DataFrame, columns: Sequence[str], missing: str = "false", fit_on: DataFrame | None = None, keep_index: bool = False,
) -> DataFrame:
    """Replace each column by a sparse vector ``<name>_dummies`` with an entry per value, for any number of values.

    Entries are in the order of frequency in ``fit_on`` (the table itself by default), equally frequent values
    by text. Other values and missing ones have no entry at 1; with ``missing='null'`` the vector is missing where
    the value is. ``keep_index`` adds the entry's number as ``<name>_index``.
    """
    plain = [f"__value_{i}" for i in range(len(columns))]
    indexed, encoded = [f"__index_{i}" for i in range(len(columns))], [f"__dummies_{i}" for i in range(len(columns))]

    def texts(table: DataFrame) -> DataFrame:
        return table.withColumns({p: column(c).cast("string") for p, c in zip(plain, columns, strict=True)})

    rows = texts(df)
    stages = [
        StringIndexer(inputCols=plain, outputCols=indexed, stringOrderType="frequencyDesc", handleInvalid="keep"),
        OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True)]
    out = Pipeline(stages=stages).fit(texts(df if fit_on is None else fit_on).select(*plain)).transform(rows)
    added = {}
    for name, p, i, d in zip(columns, plain, indexed, encoded, strict=True):
        added[f"{name}_dummies"] = F.when(F.col(p).isNotNull(), F.col(d)) if missing == "null" else F.col(d)
        if keep_index:
            added[f"{name}_index"] = F.when(F.col(p).isNotNull(), F.col(i))
    return out.select(*[column(c) for c in df.columns if c not in columns], *[v.alias(n) for n, v in added.items()])


def create_dummies_many(
    df: DataFrame, columns: Sequence[str], drop_first: bool = False, dummy_na: bool = False,
    prefix: Mapping[str, str] | None = None,
) -> DataFrame:
    """Replace several columns by 0/1 columns, values in sorted order, missing values all 0.

    A column with more than ``MAX_DUMMIES`` values becomes one sparse vector column instead (``sparse_dummies``).
    """
    flags, wide = [], []
    for name in columns:
        found = frequent_values(df, name)
        if found is None:
            wide.append(name)
            if dummy_na:
                flags.append(column(name).isNull().cast("int").alias(f"{(prefix or {}).get(name, name)}_nan"))
            continue
        values = sorted(found)
        kept = values[1:] if drop_first else values
        base = (prefix or {}).get(name, name)
        text = column(name).cast("string")
        flags += [
            F.coalesce(text == F.lit(str(v)), F.lit(False)).cast("int").alias(n)
            for v, n in zip(kept, dummy_names(base, kept), strict=True)
        ]
        if dummy_na:
            flags.append(column(name).isNull().cast("int").alias(f"{base}_nan"))
    out = drop_columns(df.select("*", *flags), [c for c in columns if c not in wide])
    return sparse_dummies(out, wide) if wide else out


def split_dummies(splits: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Dummies over a split table: a split's columns follow the values of its own training rows.

    All splits share one set of columns; a value a split never trained on is false throughout it. A column
    with more than ``MAX_DUMMIES`` values becomes one sparse vector column, with the same rule.
    """
    train = splits.where(F.col(ROLE) == "train")
    out = splits
    for name in columns:
        text = column(name).cast("string")
        found = frequent_values(train, name)
        if found is None:
            out = _split_sparse(out, train, name)
            continue
        values = sorted(str(v) for v in found)
        known = train.where(text.isNotNull()).groupBy(SPLIT).agg(F.collect_set(text).alias("__known"))
        rows = attach(out, [SPLIT], known)
        flags = [
            F.coalesce((text == v) & F.array_contains("__known", v), F.lit(False)).alias(n)
            for v, n in zip(values, dummy_names(name, values), strict=True)
        ]
        out = drop_columns(rows.select("*", *flags), [name, "__known"])
    return out


def _split_sparse(splits: DataFrame, train: DataFrame, name: str) -> DataFrame:
    text = column(name).cast("string")
    known = train.where(text.isNotNull()).groupBy(F.col(SPLIT), text.alias("__text")).agg(F.count(F.lit(1)).alias("__n"))
    rows = lookup(splits.withColumn("__text", text), known, [SPLIT, "__text"], "__n", splits.columns)
    own = [F.when(F.col("__n").isNotNull(), F.col("__text")).alias(c) if c == name else column(c) for c in splits.columns]
    return sparse_dummies(rows.select(*own), [name], fit_on=train)


def sparse_encoder(
    train: DataFrame, categorical: Sequence[str], numeric: Sequence[str], features: str = "features", counts: DataFrame | None = None,
) -> PipelineModel:
    """Fit one sparse feature vector: numbers as they are, categories as dummies of the training values.

    Values unseen in training, and missing ones, have all dummies zero. Made for columns with
    thousands of values; the categories of all columns are counted in one job, by a plain aggregation, which takes a
    fraction of what ``StringIndexer`` takes to gather its hash maps row by row. The most frequent value comes first, then by text.
    ``counts`` (i, v, n) has them if they are known: how often the i-th column has the value v (``category_values``).
    """
    stages: list = []
    inputs = [f"`{c}`" if not c.isidentifier() else c for c in numeric]
    if categorical:
        indexed = [f"{c}__index" for c in categorical]
        encoded = [f"{c}__dummies" for c in categorical]
        if counts is None:
            counts = category_values(train, categorical).groupBy("i", "v").agg(F.count(F.lit(1)).alias("n"))
        # the indexer gives unknown values the last index, which is the one the encoder drops
        stages += [
            *[StringIndexerModel.from_labels(labels, inputCol=c, outputCol=i, handleInvalid="keep")
              for c, i, labels in zip(categorical, indexed, _by_frequency(counts, len(categorical)), strict=True)],
            OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True),
        ]
        inputs += encoded
    stages.append(VectorAssembler(inputCols=inputs, outputCol=features, handleInvalid="error"))
    return Pipeline(stages=stages).fit(train)


def category_values(rows: DataFrame, names: Sequence[str], *keep: str) -> DataFrame:
    """(i, v, keep...): the value of the i-th column of each row as text; missing ones and NaN don't count."""
    def value(name: str) -> Column:
        plain = isinstance(rows.schema[name].dataType, (T.FloatType, T.DoubleType))
        return (F.when(~F.isnan(column(name)), column(name)) if plain else column(name)).cast("string")

    each = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), value(c).alias("v")) for i, c in enumerate(names)]))
    return rows.select(each.alias("e"), *map(column, keep)).select("e.i", "e.v", *map(column, keep)).where("v IS NOT NULL")


def _by_frequency(counts: DataFrame, columns: int) -> list[list[str]]:
    """The values of each column, most frequent first and equally frequent ones by text, as ``StringIndexer`` has them."""
    found: list[list] = [[] for _ in range(columns)]
    for r in counts.select("i", "v", "n").collect():
        found[r["i"]].append((-r["n"], r["v"]))
    return [[v for _, v in sorted(f)] for f in found]


# --- scaling --------------------------------------------------------------------------------------

def minmax(value: Column, a: Column, b: Column) -> Column:
    """``(2x - (a + b)) / (a - b)``: a maps to 1 and b to -1; missing when they are equal."""
    return F.try_divide(2.0 * value - (a + b), a - b)


def scale_variable_minmax(df: DataFrame, name: str, a: float | None = None, b: float | None = None) -> DataFrame:
    """Scale one column between its minimum and maximum, or between the values given."""
    x = as_double(name)
    if a is None or b is None:
        span = df.agg(F.max(x).alias("hi"), F.min(x).alias("lo")).first()
        a = span.hi if a is None else a
        b = span.lo if b is None else b
    hi, lo = F.lit(a).cast("double"), F.lit(b).cast("double")
    return df.withColumn(name, minmax(x, hi, lo))


def split_minmax(splits: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Scale columns by the range of each split's training rows; test values may leave [-1, 1]."""
    train = splits.where(F.col(ROLE) == "train")
    spans = train.groupBy(SPLIT).agg(
        *[F.max(as_double(c)).alias(f"__hi_{c}") for c in columns],
        *[F.min(as_double(c)).alias(f"__lo_{c}") for c in columns],
    )
    rows = attach(splits, [SPLIT], spans)
    scaled = rows.withColumns({c: minmax(as_double(c), column(f"__hi_{c}"), column(f"__lo_{c}")) for c in columns})
    return drop_columns(scaled, [f"__{s}_{c}" for s in ("hi", "lo") for c in columns])


# --- occurrence counts ----------------------------------------------------------------------------

def generate_n_occurrences(
    df: DataFrame, name: str, out: str | None = None, by: Sequence[str] = (), spread_on: Sequence[str] | None = None,
    **lookup_options,
) -> DataFrame:
    """Give each row the number of rows with its value; a missing value has no count."""
    keys = [*by, name]
    out = out or f"{name}_n_occur"
    counts = df.where(column(name).isNotNull()).groupBy(*map(column, keys)).agg(F.count(F.lit(1)).alias(out))
    return lookup(df, counts, keys, out, spread_on or df.columns, **lookup_options)


def split_n_occurrences(
    splits: DataFrame, columns: Sequence[str], spread_on: Sequence[str] | None = None, **lookup_options
) -> DataFrame:
    """Occurrence counts over a split table: training rows count training rows, test rows count both."""
    out = splits
    for name in columns:
        counts = splits.where(column(name).isNotNull()).groupBy(SPLIT, column(name)).agg(
            F.count_if(F.col(ROLE) == "train").alias("__train"), F.count(F.lit(1)).alias("__all"))
        found = lookup(out, counts, [SPLIT, name], "__all", spread_on or splits.columns, **lookup_options)
        n = F.when(F.col(ROLE) == "train", F.col("__train")).otherwise(F.col("__all"))
        out = found.withColumn(f"{name}_n_occur", n).drop("__train", "__all")
    return out


# --- train-fitted bins and the whole sequence -----------------------------------------------------

def split_bins(splits: DataFrame, bins: Mapping[str, Mapping]) -> DataFrame:
    """Replace numbers by bin labels; equally filled bins take their edges from the training rows.

    For those the outer bins reach to infinity, so a test value beyond the training range falls into
    the nearest bin.
    """
    train = splits.where(F.col(ROLE) == "train")
    counted = {c: spec["bins"] for c, spec in bins.items() if isinstance(spec["bins"], int)}
    out = splits
    if counted:
        edges = quantile_edges(train, counted, [SPLIT])
        table = edges.groupBy(SPLIT).agg(
            F.map_from_entries(F.collect_list(F.struct("column", "edges"))).alias("__edges"))
        out = attach(out, [SPLIT], table)
    for name, spec in bins.items():
        fixed = name not in counted
        edges_of = F.array(*[F.lit(e) for e in fixed_edges(spec["bins"])]) if fixed else F.col("__edges")[name]
        # the two outer edges are open in every role once the bins are fitted
        number = bin_number(as_double(name), edges_of, open_ended=not fixed)
        out = out.withColumn("__bin", number).withColumn(
            name, bin_label(F.col("__bin"), edges_of, spec.get("labels"))).drop("__bin")
    return out.drop("__edges")


def generate_features(
    splits: DataFrame, n_occur_cols: Sequence[str] = (), scale_cols: Sequence[str] = (),
    bin_cols: Mapping[str, Mapping] | None = None, dummy_cols: Sequence[str] = (),
    binary_cut_cols: Mapping[str, Mapping] | None = None, drop_cols: Sequence[str] = (),
    spread_on: Sequence[str] | None = None, keep_categories: bool = False,
) -> DataFrame:
    """All feature steps over the split table, in this order: counts, scaling, bins, dummies, cuts, drops.

    Binned columns become dummies too. ``keep_categories`` leaves the columns meant for dummies as
    text, for ``sparse_encoder``.
    """
    out = split_n_occurrences(splits, n_occur_cols, spread_on)
    if scale_cols:
        out = split_minmax(out, scale_cols)
    bins = dict(bin_cols or {})
    if bins:
        out = split_bins(out, bins)
    if not keep_categories:
        out = split_dummies(out, [*dummy_cols, *bins])
    for name, spec in (binary_cut_cols or {}).items():
        out = out.withColumn(name, cut_binary(column(name), **spec))
    return drop_columns(out, drop_cols)
