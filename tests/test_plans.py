"""Shape of physical plans and behaviour under skew."""

import re

import pytest
from conftest import SMALL, at, plan_of
from pyspark.sql import functions as F

from ventis.operators import features as X
from ventis.operators import joins as J
from ventis.operators import quality as Q
from ventis.operators import views as V
from ventis.operators.filters import MeasurementFilter
from ventis.operators.rollups import mp25_by_comuna
from ventis.plans.catalog import QUERIES
from ventis.plans.oracles import ORACLES
from ventis.session import materialize, shared_dir
from ventis.sources import adapter

MODELS = {"kmeans_assign", "k_sweep", "forecast_eval", "forest_eval", "forecast_24h", "feature_importance"}
# One Arrow pass over the rows takes the moments of all pairs; built-in functions would repeat rows.
ARROW = {"correlation_matrix"}


def test_catalogue_and_sql_cover_each_other():
    assert set(QUERIES) - set(ORACLES) == MODELS
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - MODELS))
def test_plans_stay_in_the_engine(spark, name):
    plan = plan_of(QUERIES[name](spark, SMALL))
    if name not in ARROW:
        assert "Python" not in plan and "InPandas" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_filters_and_columns_reach_the_scan(spark):
    star = adapter.star(spark, SMALL)
    where = MeasurementFilter(fecha_inicio="2024-01-05", mp25_min=5.0, id_estacion=3)
    plan = plan_of(mp25_by_comuna(star, where))
    pushed = next(p for p in re.findall(r"PushedFilters: \[([^\]]*)", plan) if "ts" in p)
    for part in ("GreaterThanOrEqual(ts", "GreaterThanOrEqual(value,5.0)", "EqualTo(user_id,3)"):
        assert part in pushed
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,value:double>" in plan


def test_rollup_aggregates_before_the_join(spark):
    plan = plan_of(mp25_by_comuna(adapter.star(spark, SMALL)))
    partial = plan.index("partial_sum(_suma")
    join = plan.index("HashJoin") if "HashJoin" in plan else plan.index("SortMergeJoin")
    assert partial < join < plan.rindex("partial_sum(")


def test_top_per_key_limits_before_the_shuffle(spark):
    star = adapter.star(spark, SMALL)
    data = J.modeling_dataset(star)
    for df in (X.latest_per_station(data), V.recent_history(data),
               Q.dedupe_first(adapter.faulty_measurements(spark, SMALL), Q.KEY)):
        assert re.search(r"WindowGroupLimit .*Partial", plan_of(df))


def test_no_fact_window_on_a_single_partition(spark):
    for name in ("temporal_split", "cv_folds", "rolling_features", "target_24h", "validate_errors"):
        plan = plan_of(QUERIES[name](spark, SMALL))
        for match in re.finditer(r"Exchange SinglePartition", plan):
            below = plan[match.start():match.start() + 400]
            # Offsets per partition, whole aggregates, or the counts of a prefix index per day.
            days = re.match(r"Exchange SinglePartition[^\n]*\n[ :+-]*HashAggregate\(keys=\[_level0", below)
            assert "_part" in below or "partial_" in below or days, name


SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def no_broadcast(spark):
    """Tables too large to broadcast, small skew limits."""
    before = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for key, value in SKEW_CONF.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def hot(spark):
    """Two thirds of the rows share one station."""
    n = F.col("id")
    return spark.range(0, 60000, 1, 8).select(
        n.alias("_seq"),
        F.when(n % 3 > 0, "HOT").otherwise(F.concat(F.lit("S"), n)).alias("codigo_estacion"),
        F.when(n % 3 > 0, 1).otherwise(n).cast("long").alias("id_estacion"),
        F.lit(at("2026-01-01")).cast("timestamp_ntz").alias("fecha_hora"),
        n.cast("double").alias("mp25"),
        F.sha2(n.cast("string"), 256).alias("relleno"),
    )


def test_duplicates_of_a_hot_key_are_split(spark, no_broadcast):
    flagged = Q.flag_duplicates(hot(spark))
    rows = flagged.groupBy("duplicado").count().collect()
    assert {r["duplicado"]: r["count"] for r in rows} == {True: 39999, False: 20001}
    flagged.collect()
    assert "skew=true" in plan_of(flagged)


def test_star_join_of_a_hot_station_is_split(spark, no_broadcast):
    star = adapter.star(spark, SMALL)
    stations = hot(spark).select("id_estacion").distinct().select(
        "id_estacion", F.lit("x").alias("codigo_unico"), F.lit("t").alias("tipo"),
        F.lit(0.0).alias("latitud"), F.lit(0.0).alias("longitud"), F.lit(3).cast("long").alias("id_comuna"))
    busy = type(star)(star.comunas, materialize(stations, "est"), star.industrias, hot(spark))
    joined = J.star_join(busy)
    assert len(joined.collect()) == 60000
    assert "skew=true" in plan_of(joined)


def test_few_repeated_keys_do_not_shuffle_the_rows(spark):
    flagged = Q.flag_duplicates(hot(spark))
    plan = plan_of(flagged)
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_shared_folder_comes_from_the_session(spark):
    folder = shared_dir(spark)
    assert folder == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    table = materialize(spark.range(3).toDF("x"), "t")
    assert folder.split(":")[-1] in table.inputFiles()[0] and table.count() == 3


@pytest.mark.parametrize("name", ["global_rank", "temporal_split", "split_summary", "cv_folds",
                                  "measurement_page", "target_24h", "rolling_features"])
def test_building_ranks_and_windows_runs_no_job(spark, name):
    group = f"building-{name}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        QUERIES[name](spark, SMALL)
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) == 0
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
