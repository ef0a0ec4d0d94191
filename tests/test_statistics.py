import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ventis.operators import rollups as R
from ventis.operators import statistics as S
from ventis.operators import views as V


@settings(max_examples=12, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.floats(-1e6, 1e6), st.sampled_from([1.0, 2.0])),
                min_size=1, max_size=60))
def test_exact_quantiles_match_numpy(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "a double")
    probabilities = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {r["p"]: r["cuantil"] for r in S.exact_quantiles(df, ["a"], probabilities).collect()}
    present = [v for v in values if v is not None]
    if not present:
        assert got == {}
        return
    expected = np.quantile(present, probabilities)
    np.testing.assert_allclose([got[p] for p in probabilities], expected, rtol=1e-9, atol=1e-9)


def frame(spark, rows=200):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame(rng.normal(size=(rows, 3)), columns=["a", "b", "c"])
    pdf["b"] += pdf["a"]
    pdf.loc[::7, "a"] = np.nan
    pdf.loc[::5, "b"] = np.nan
    df = spark.createDataFrame(pdf).select(*[F.nanvl(c, F.lit(None).cast("double")).alias(c) for c in "abc"])
    return pdf, df.withColumn("vacia", F.lit(None).cast("double"))


def test_describe_matches_pandas(spark):
    pdf, df = frame(spark)
    got = S.describe(df, ["a", "b", "c", "vacia", "ausente"]).toPandas().set_index("variable")
    expected = pdf.describe().T
    assert set(got.index) == set("abc")
    for ours, theirs in zip(["count", "mean", "std", "min", "q25", "q50", "q75", "max"], expected.columns):
        np.testing.assert_allclose(got.loc[list("abc"), ours].astype(float), expected[theirs])


def test_correlation_is_pairwise(spark):
    pdf, df = frame(spark)
    rows = S.correlation_matrix(df, ["a", "b", "c", "vacia"]).collect()
    assert len(rows) == 6
    for r in rows:
        assert r["correlacion"] == pytest.approx(pdf.corr().loc[r["variable_x"], r["variable_y"]])
    with pytest.raises(ValueError):
        S.correlation_matrix(df, ["a"])


def test_correlation_keeps_digits_and_rows(spark):
    """Large offsets, absent values in every task, constants, and a plan that repeats no row."""
    rng = np.random.default_rng(5)
    x = 1e9 + rng.normal(0, 1, 3000)
    y = 0.3 * (x - 1e9) + rng.normal(0, 1, 3000) - 1e7
    z = np.where(np.arange(3000) < 2000, np.nan, rng.normal(0, 1, 3000))
    pdf = pd.DataFrame({"x": x, "y": y, "z": z, "fija": 2.0})
    df = spark.createDataFrame(pdf).withColumn("z", F.nanvl("z", F.lit(None))).repartition(7)
    got = S.correlation_matrix(df, ["x", "y", "z", "fija"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Expand" not in plan
    rows = {(r["variable_x"], r["variable_y"]): r["correlacion"] for r in got.collect()}
    assert len(rows) == 10
    centred = pdf.assign(x=pdf.x - 1e9, y=pdf.y + 1e7).corr()
    for (a, b), value in rows.items():
        if "fija" in (a, b):
            assert value is None
        else:
            assert value == pytest.approx(centred.loc[a, b], abs=1e-7)
    assert S.correlation_matrix(df.limit(0), ["x", "y"]).collect() == []
    endless = df.withColumn("x", F.when(F.rand(1) < 0.01, float("inf")).otherwise(F.col("x")))
    rows = S.correlation_matrix(endless, ["x", "y"]).collect()
    assert {r["correlacion"] is None for r in rows if r["variable_x"] == "x"} == {True}


def test_linear_trend(spark):
    pdf, df = frame(spark)
    row = S.linear_trend(df, "a", "b").first()
    both = pdf.dropna(subset=["a", "b"])
    slope, intercept = np.polyfit(both["a"], both["b"], 1)
    assert row["pendiente"] == pytest.approx(slope) and row["intercepto"] == pytest.approx(intercept)
    flat = S.linear_trend(df.withColumn("a", F.lit(1.0)), "a", "b").first()
    assert flat["pendiente"] is None


def test_quality_summary(spark):
    _, df = frame(spark)
    for options in ({}, {"chunk": 1}):
        rows = {r["columna"]: r for r in S.quality_summary(df, **options).collect()}
        assert rows["a"]["nulos"] == 29 and rows["a"]["porcentaje_nulos"] == 14.5
        assert rows["a"]["valores_unicos"] == 171 and rows["vacia"]["valores_unicos"] == 0
        assert rows["a"]["tipo"] == "double"
    approx = {r["columna"]: r for r in S.quality_summary(df, approx=True).collect()}
    assert approx["a"]["valores_unicos"] == pytest.approx(171, rel=0.1)


def test_histogram_covers_every_row(spark):
    pdf, df = frame(spark)
    rows = S.histogram(df, "c", 30).collect()
    counts, edges = np.histogram(pdf["c"], bins=30)
    assert {r["tramo"]: r["cantidad"] for r in rows} == {i: n for i, n in enumerate(counts) if n}
    constant = S.histogram(df.withColumn("k", F.lit(2.0)), "k").collect()
    assert [(r["tramo"], r["cantidad"]) for r in constant] == [(0, 200)]


def test_small_helpers(spark):
    df = spark.createDataFrame(
        [(1, "x", 5.0), (1, "y", 1.0), (1, "y", None), (1, "x", 2.0), (2, None, 3.0), (None, "x", 9.0)],
        "cluster int, nivel_riesgo string, mp25 double")
    labels = {r["cluster"]: r["etiqueta"] for r in S.modal_label(df.filter("cluster is not null")).collect()}
    assert labels == {1: "x", 2: "Cluster 2"}
    top = S.top_mean(df, "nivel_riesgo", 1).collect()
    assert [(r["nivel_riesgo"], r["mp25_promedio"]) for r in top] == [("x", pytest.approx(16 / 3))]
    with pytest.raises(ValueError):
        S.top_mean(df, "nivel_riesgo", 0)
    assert S.select_numeric(df, ["mp25", "no"]).columns == ["mp25"]
    with pytest.raises(ValueError):
        S.select_numeric(df, ["no"])
    counts = S.value_counts(df, "nivel_riesgo").collect()
    assert (counts[0]["nivel_riesgo"], counts[0]["cantidad"]) == ("x", 3)


def test_risk_distribution_fills_absent_levels(spark):
    df = spark.createDataFrame([("Riesgo crítico",)] * 3 + [("Bajo riesgo",)], "nivel_riesgo string")
    rows = V.risk_distribution(df).collect()
    assert [(r["nivel_riesgo"], r["cantidad_registros"], r["porcentaje"]) for r in rows] == [
        ("Bajo riesgo", 1, 25.0), ("Riesgo moderado", 0, 0.0), ("Riesgo crítico", 3, 75.0)]


def test_norms_and_episodes(star):
    norms = {r["contaminante"]: r["excedencias"] for r in R.norm_exceedance(star).collect()}
    assert norms == {"mp25": 2, "mp10": 1, "so2": 0, "no2": 0}
    rows = {r["comuna"]: r for r in R.episode_counts(star, low_wind=2.0).collect()}
    assert rows["Chillan"]["episodios_criticos"] == 1 and rows["Chillan"]["dias_baja_ventilacion"] == 1
    assert rows["Talca"]["porcentaje_critico"] == 0.0
