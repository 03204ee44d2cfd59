import pytest
from pyspark.sql import functions as F

from cartwright import names as N
from cartwright.operators import centroids as M
from cartwright.operators.fitting import fit_model, fit_models
from cartwright.plans import segmentation as G
from checks import queries as Q
from checks import spec

COLUMNS = f"{N.CUSTOMER_ID} string, {N.TARGET} long, x_count double, b_count double, Segment string"
PLANS = (M.MicroPlan("one", ("Seg1_5_1", "Seg1_5_2"), "m"), M.MicroPlan("two", ("Seg1_5_3",), "n"),
         M.MicroPlan("none", ("Seg1_5_4",), "o"), M.MicroPlan("off", ("Seg1_5_1",), "p", enabled=False))
WANTED = {"m": ["x_count", "bee"], "n": ["x_count"], "o": ["bee"]}
RENAMES = {"b_count": "bee"}


def blobs(spark):
    """Two far groups in one segment pair, constant values in another segment, NULL and NaN as zero."""
    rows = [(f"a{i}", 1, float(i % 5), 3.0, "Seg1_5_1") for i in range(50)]
    rows += [(f"b{i}", 1, 1000.0 + i % 5, 3.0, "Seg1_5_2") for i in range(50)]
    rows += [("c", 1, None, 1.0, "Seg1_5_3"), ("d", 1, float("nan"), 1.0, "Seg1_5_3"), ("e", 1, 0.0, 1.0, "Seg9"), ("f", 1, 0.0, 1.0, None)]
    return spark.createDataFrame(rows, COLUMNS)


def test_fitted_models_score(spark):
    df = blobs(spark)
    models = fit_models(df, PLANS, WANTED, RENAMES, clusters=2)
    loaded = M.load_models(models, ["m", "n"])
    assert models.schema == M.MODEL_SCHEMA and models.count() == 2  # no customers feed the third, the last is off
    assert loaded["m"].mean == pytest.approx((502.0, 3.0)) and loaded["m"].scale[1] == 0.0
    assert len(loaded["n"].centers) == 1  # one distinct vector
    scored = M.micro_segments(df, PLANS[:2], models, RENAMES)
    found = {r[N.CUSTOMER_ID]: r["microcluster"] for r in scored.collect()}
    assert {found[f"a{i}"] for i in range(50)} | {found[f"b{i}"] for i in range(50)} == {"0", "1"}
    assert len({found[f"a{i}"] for i in range(50)}) == 1 and found["c"] == found["d"] == "0"


def test_features_must_be_given_and_known(spark):
    with pytest.raises(KeyError, match="o"):
        fit_models(blobs(spark), PLANS, {"m": ["bee"], "n": ["bee"]}, RENAMES)
    with pytest.raises(KeyError, match="nothing"):
        fit_models(blobs(spark), PLANS, {**WANTED, "o": ["nothing"]}, RENAMES)


def test_no_customers(spark):
    assert fit_models(blobs(spark).limit(0), PLANS, WANTED, RENAMES).collect() == []


def cost(model, vectors):
    """Sum of squared standardised distances to the nearest center."""
    z = [[(x - m) / (s or 1.0) for x, m, s in zip(v, model.mean, model.scale)] for v in vectors]
    return sum(min(sum((a - b) ** 2 for a, b in zip(v, c)) for c in model.centers) for v in z)


def test_fit_beats_the_rule_made_centers(spark):
    """On the vectors of one plan of the grid, after the same standardisation."""
    st = Q.Stage(spark, "/root/testdata/sf0.001")
    columns = [F.expr(e.replace("VARCHAR", "STRING")).alias(c) for c, e in spec.grid_columns().items()]
    segmented = G.segments_with_features(st.table("lineitem").select(*columns), spec.SPEC)
    source = M.renamed_columns([c for c in segmented.columns if c != "Segment"], spec.MICRO_RENAMES)
    rows, vector = M.planned_vectors(segmented, spec.PLANS[:1], M.model_rows(spark, spec.MODELS), source)
    vectors = rows.select(F.expr(vector).alias("vector"))
    fitted = M.CentroidModel(*map(lambda x: tuple(map(tuple, x)) if x and isinstance(x[0], list) else x if isinstance(x, str) else tuple(x),
                                  fit_model(vectors, "m", spec.MODEL_FEATURES, 4, 1, 20)))
    data = [r["vector"] for r in vectors.collect()]
    ruled = next(iter(spec.MODELS.values()))
    rule_made = M.CentroidModel("m", fitted.features, fitted.mean, fitted.scale, ruled.centers)
    assert len(data) > 50 and cost(fitted, data) < 0.8 * cost(rule_made, data)


def test_plan_does_not_grow_with_the_plans(spark):
    """A thousand plans and models: as many nodes as for two, and the same scores."""
    df = spark.createDataFrame([("a", 1, 0.0, 0.0, "Seg1_5_1"), ("b", 1, 9.0, 1.0, "Seg1_5_2")], COLUMNS)

    def scored(n):
        models = {f"m{i}": M.CentroidModel(f"m{i}", ("x_count", "bee"), (0.0, 0.0), (1.0, 0.0), ((0.0, 0.0), (8.0, 0.0), (8.0, 0.0))) for i in range(n)}
        plans = [M.MicroPlan(f"p{i}", ("Seg1_5_1", "Seg1_5_2"), f"m{i}") for i in range(n)]
        return M.micro_segments(df, plans, models, RENAMES)

    nodes = lambda d: d._jdf.queryExecution().analyzed().toString().count("\n")
    many = scored(1000)
    assert nodes(many) == nodes(scored(2))
    assert many.groupBy(N.CUSTOMER_ID, "microcluster").count().orderBy(N.CUSTOMER_ID).collect() == [("a", "0", 1000), ("b", "1", 1000)]


def test_uneven_or_missing_models(spark):
    df = blobs(spark)
    row = ("m", ["x_count"], [0.0], [1.0], [[0.0, 1.0]])
    with pytest.raises(ValueError, match="widths"):
        M.micro_segments(df, PLANS[:1], spark.createDataFrame([row], M.MODEL_SCHEMA), RENAMES)
    with pytest.raises(KeyError, match="not found"):
        M.micro_segments(df, PLANS[:1], spark.createDataFrame([], M.MODEL_SCHEMA), RENAMES)
    good = ("m", ["x_count"], [0.0], [1.0], [[0.0]])
    with pytest.raises(ValueError, match="several"):
        M.micro_segments(df, PLANS[:1], spark.createDataFrame([good, good], M.MODEL_SCHEMA), RENAMES)
