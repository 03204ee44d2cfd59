"""Outlier capping and nearest-centroid scoring."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwright import names as N
from cartwright.functions import scalars as X

# Quantiles of the cap, and the segments whose plans are capped.
CAP_QUANTILES = (0.01, 0.99)
CAPPED_SEGMENTS = frozenset({"Seg1_5_6", "Seg_6_15_10", "Seg15_plus_9"})

# half the width, in ranks, of the bracket around a quantile; the approximation errs by a tenth of it at most
BRACKET = 0.001
EXACT_ROWS = 100_000

MODEL_SCHEMA = T.StructType([
    T.StructField("model_key", T.StringType(), False),
    T.StructField("features", T.ArrayType(T.StringType()), False),
    T.StructField("mean", T.ArrayType(T.DoubleType()), False),
    T.StructField("scale", T.ArrayType(T.DoubleType()), False),
    T.StructField("centers", T.ArrayType(T.ArrayType(T.DoubleType())), False),
])


@dataclass(frozen=True)
class CentroidModel:
    """A fitted model: feature order, standardisation and centers."""

    key: str
    features: tuple[str, ...]
    mean: tuple[float, ...]
    scale: tuple[float, ...]
    centers: tuple[tuple[float, ...], ...]

    def __post_init__(self):
        width = len(self.features)
        sizes = {len(self.mean), len(self.scale), *map(len, self.centers)}
        if sizes != {width} or not self.centers:
            raise ValueError(f"model {self.key}: feature, scaler and center widths differ")


@dataclass(frozen=True)
class MicroPlan:
    name: str
    source_segments: tuple[str, ...]
    model_key: str
    enabled: bool = field(default=True)

    @property
    def capped(self) -> bool:
        return not CAPPED_SEGMENTS.isdisjoint(self.source_segments)


def load_models(models: DataFrame, keys: Sequence[str]) -> dict[str, CentroidModel]:
    """Models named by the plans; at most one small row per key reaches the driver."""
    wanted = sorted(set(keys))
    named = models.where(F.col("model_key").isin(wanted))
    twice = named.groupBy("model_key").count().where("count > 1").select("model_key").collect()
    if twice:
        raise ValueError(f"model table has several rows for {sorted(r['model_key'] for r in twice)}")
    rows = named.collect()
    found = {
        r["model_key"]: CentroidModel(
            r["model_key"], tuple(r["features"]), tuple(r["mean"]), tuple(r["scale"]),
            tuple(tuple(c) for c in r["centers"]),
        )
        for r in rows
    }
    missing = [k for k in wanted if k not in found]
    if missing:
        raise KeyError(f"models not found: {missing}")
    return found


# -- scoring ----------------------------------------------------------------

def _doubles(values: Sequence[float]) -> str:
    return "array(" + ", ".join(f"{float(v)!r}D" for v in values) + ")"


def nearest_text(vector: str, mean: str, scale: str, centers: str) -> str:
    """SQL text of the index of the closest center after standardising; ties go to the lowest.

    All four are SQL texts of arrays: literals of one model, or columns of a model row next to
    the vector. The standardised vector and the distances are bound by one-element
    ``transform`` calls, so each is computed once per row.
    """
    centered = f"zip_with({vector}, {mean}, (x, m) -> x - m)"
    standard = f"zip_with({centered}, {scale}, (x, s) -> x / IF(s = 0, 1.0D, s))"
    squares = "zip_with(z, c, (a, b) -> (a - b) * (a - b))"
    distances = f"transform({centers}, c -> aggregate({squares}, 0.0D, (total, d) -> total + d))"
    bound = f"get(transform(array({standard}), z -> {distances}), 0)"
    return f"get(transform(array({bound}), ds -> array_position(ds, array_min(ds)) - 1), 0)"


def nearest_center(vector: str, model: CentroidModel) -> Column:
    """Index (as text) of the closest center of one model; ``vector`` is the SQL text of an array of doubles."""
    centers = "array(" + ", ".join(map(_doubles, model.centers)) + ")"
    return F.expr(f"CAST({nearest_text(vector, _doubles(model.mean), _doubles(model.scale), centers)} AS STRING)")


def model_rows(spark: SparkSession, models: Mapping[str, CentroidModel]) -> DataFrame:
    """Models at hand as a model table."""
    rows = [(m.key, list(m.features), list(m.mean), list(m.scale), [list(c) for c in m.centers]) for m in models.values()]
    return spark.createDataFrame(rows, MODEL_SCHEMA)


def used_features(models: DataFrame, plans: Sequence[MicroPlan], available: Collection[str]) -> dict[str, bool]:
    """Features that the models of the plans use, and whether a capped plan does.

    An error if a model is missing, doubled, uneven or needs others. One narrow row per model reaches the driver,
    and as many names as the input has columns.
    """
    keys = sorted({p.model_key for p in plans})
    if not keys:
        return {}
    capped = {p.model_key for p in plans if p.capped}
    wanted = models.sparkSession.createDataFrame([(k, k in capped) for k in keys], "model_key string, _capped boolean")
    named = models.join(wanted, "model_key")
    absent = F.array_except("features", F.array(*[F.lit(f) for f in sorted(available)]).cast("array<string>"))
    even = is_even(F.col("mean"), F.col("scale"), F.col("centers"), F.col("features"))
    found = named.groupBy("model_key").agg(
        F.count(F.lit(1)).alias("rows"), F.min(even).alias("even"),
        F.max(F.when(F.size(absent) > 0, F.array_join(absent, ", "))).alias("absent")).collect()
    missing = sorted(set(keys) - {r["model_key"] for r in found})
    if missing:
        raise KeyError(f"models not found: {missing}")
    for r in sorted(found, key=lambda r: r["model_key"]):
        if r["rows"] > 1:
            raise ValueError(f"model table has several rows for {r['model_key']}")
        if r["absent"] is not None:
            raise KeyError(f"model {r['model_key']} needs features that the input lacks: {r['absent']}")
        if not r["even"]:
            raise ValueError(f"model {r['model_key']}: feature, scaler and center widths differ")
    each = named.select(F.explode("features").alias("feature"), "_capped").groupBy("feature").agg(F.max("_capped").alias("capped"))
    return {r["feature"]: r["capped"] for r in each.orderBy("feature").collect()}


def is_even(mean: Column, scale: Column, centers: Column, features: Column) -> Column:
    """Whether a model row has a center, and all its arrays are as long as its features."""
    width = F.size(features)
    return (F.size(mean) == width) & (F.size(scale) == width) & (F.size(centers) > 0) & F.forall(centers, lambda c: F.size(c) == width)


# -- capping ----------------------------------------------------------------

def numeric_columns(df: DataFrame) -> list[str]:
    """Columns that are capped: numeric, but not the id or the target."""
    return [
        f.name for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in {N.CUSTOMER_ID, N.TARGET}
    ]


def cap_bounds(df: DataFrame, columns: Sequence[str], by: str | None = None) -> DataFrame:
    """Lower and upper quantile of each column, linear interpolation, exact.

    One row per value of ``by``. A first aggregate brackets each quantile with
    approximate ones, whose buffers are bounded. The exact percentile then runs
    over values clamped to the bracket: that leaves the order statistics inside
    it as they are, and its map of distinct values holds the few in the bracket
    only. Columns with up to ``EXACT_ROWS`` values are not clamped.
    """
    value = [F.col(f"`{c}`") for c in columns]
    ends = F.array(*[F.lit(min(1.0, max(0.0, q + side * BRACKET))) for q in CAP_QUANTILES for side in (-1, 1)])
    near = [x for i, v in enumerate(value) for x in (
        F.percentile_approx(v, ends, F.lit(10_000)).alias(f"_near_{i}"), F.count(v).alias(f"_rows_{i}"))]
    if by is None:
        brackets = df.agg(*near).select(F.struct("*").alias("b")).scalar()
        bracketed, of = df.withColumn("_near", brackets), lambda name: F.col(f"_near.{name}")
    else:
        bracketed, of = df.join(F.broadcast(df.groupBy(by).agg(*near)), by), F.col  # a row per value of ``by``

    def clamped(i: int, j: int) -> Column:
        low, high = (F.get(of(f"_near_{i}"), F.lit(2 * j + side)) for side in (0, 1))
        inside = F.when(value[i].isNotNull(), F.least(F.greatest(value[i], low), high))
        return F.when(of(f"_rows_{i}") > EXACT_ROWS, inside).otherwise(value[i])

    aggs = [
        F.array(*[F.percentile(clamped(i, j), F.lit(q)) for j, q in enumerate(CAP_QUANTILES)]).alias(f"_cap_{i}")
        for i in range(len(columns))
    ]
    return (bracketed.groupBy(by) if by else bracketed.groupBy()).agg(*aggs)


def cap_outliers(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Clip numeric columns to their 1 % / 99 % quantiles over the whole frame.

    The bounds are a scalar subquery: computed once, used as constants.
    """
    columns = numeric_columns(df) if columns is None else list(columns)
    bounds = cap_bounds(df, columns).select(F.struct("*").alias("bounds")).scalar()
    ranges = {c: F.col(f"_bounds._cap_{i}") for i, c in enumerate(columns)}
    return df.withColumn("_bounds", bounds).select(*[
        X.clip(F.col(f"`{c}`").cast("double"), F.get(ranges[c], F.lit(0)), F.get(ranges[c], F.lit(1))).alias(c)
        if c in ranges else F.col(f"`{c}`")
        for c in df.columns
    ])


# -- micro-segments ---------------------------------------------------------

def plan_rows(spark: SparkSession, plans: Sequence[MicroPlan]) -> DataFrame:
    """One row per plan and source segment."""
    rows = [(seg, p.name, p.model_key, p.capped) for p in plans for seg in sorted(set(p.source_segments))]
    return spark.createDataFrame(rows, "Segment string, _plan string, model_key string, _capped boolean")


def renamed_columns(columns: Sequence[str], renames: Mapping[str, str]) -> dict[str, str]:
    """Model feature name -> base column, by prefix strip and rename map."""
    out = {}
    for c in columns:
        out[N.feature_name(c, renames)] = c
    return out


def planned_vectors(
    segmented: DataFrame, plans: Sequence[MicroPlan], models: DataFrame, source: Mapping[str, str]
) -> tuple[DataFrame, str]:
    """Customers with each plan that their segment feeds, and the SQL text of that plan's feature vector.

    Plans and models are rows that join the customers on the segment, so the query does not
    grow with them. The columns that any model uses are one array per customer, of which a
    model row picks its features by position; a capped plan clips it to its own quantiles first.
    """
    spark = segmented.sparkSession
    used = used_features(models, plans, source)
    features = list(used)
    if not features:
        return segmented.join(plan_rows(spark, plans), "Segment").drop("Segment"), "CAST(array() AS ARRAY<DOUBLE>)"
    numeric = set(numeric_columns(segmented))
    at = F.transform("features", lambda f: F.array_position(F.array(*map(F.lit, features)).cast("array<string>"), f).cast("int") - 1)
    scoring = plan_rows(spark, plans).join(models, "model_key").select(
        "Segment", "_plan", "model_key", "_capped", at.alias("_at"), F.col("mean").alias("_mean"), F.col("scale").alias("_scale"),
        F.col("centers").alias("_centers")).withColumnRenamed("model_key", "_key")
    rows = segmented.join(scoring, "Segment").drop("Segment")

    raw = f"array({', '.join(f'try_cast(`{source[f]}` AS DOUBLE)' for f in features)})"
    capped = [f for f in features if used[f] and source[f] in numeric]
    if capped:
        bounds = cap_bounds(rows.where("_capped"), [source[f] for f in capped], by="_plan")
        rows = rows.join(F.broadcast(bounds), "_plan", "left")  # one row per capped plan
        ends = ", ".join(f"_cap_{capped.index(f)}" if f in capped else "CAST(NULL AS ARRAY<DOUBLE>)" for f in features)
        # a plan without caps has no ends, and least and greatest pass over them
        raw = f"zip_with({raw}, array({ends}), (v, e) -> IF(v IS NULL, v, least(greatest(v, get(e, 0)), get(e, 1))))"
    filled = f"transform({raw}, v -> coalesce(nanvl(v, 0.0D), 0.0D))"
    return rows, f"get(transform(array({filled}), all -> transform(_at, p -> get(all, p))), 0)"


def micro_segments(
    segmented: DataFrame,
    plans: Sequence[MicroPlan],
    models: DataFrame | Mapping[str, CentroidModel],
    renames: Mapping[str, str],
) -> DataFrame:
    """Score all enabled plans in one pass over customers with their ``Segment``.

    Output: the base columns, ``microcluster`` and ``Segment`` = plan name. ``segmented`` is read
    once for the scores and twice more for the quantiles of capped plans: give a written table.
    """
    plans = [p for p in plans if p.enabled]
    base = [c for c in segmented.columns if c != "Segment"]
    source = renamed_columns(base, renames)
    if not isinstance(models, DataFrame):
        models = model_rows(segmented.sparkSession, models)
    rows, vector = planned_vectors(segmented, plans, models, source)
    label = F.expr(f"CAST({nearest_text(vector, '_mean', '_scale', '_centers')} AS STRING)")
    return rows.select(*[F.col(f"`{c}`") for c in base], label.alias("microcluster"), F.col("_plan").alias("Segment"))


def attach_assignments(base: DataFrame, assignments: DataFrame) -> DataFrame:
    """Features of assigned customers: distinct (id, Segment) joined to the base by id."""
    keys = assignments.select(N.CUSTOMER_ID, "Segment").distinct()
    return keys.join(base, N.CUSTOMER_ID, "left")


def microcluster_sizes(scored: DataFrame) -> DataFrame:
    return scored.groupBy("Segment", "microcluster").agg(F.count(F.lit(1)).alias("customers"))
