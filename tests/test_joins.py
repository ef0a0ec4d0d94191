import pytest
from conftest import at, plan_of
from pyspark.sql import functions as F

from ventis.operators import ingest as G
from ventis.operators import joins as J
from ventis.operators import ranking as K
from ventis.operators import rollups as R
from ventis.operators.filters import MeasurementFilter, ViewFilter, apply_view
from ventis.plans import etl
from ventis.schemas import MODELING_COLUMNS, OMITTED_COLUMNS, WEATHER
from ventis.sources.writers import write_measurements

STATION_SCHEMA = "id_estacion long, codigo_unico string, tipo string, comuna string"
MAPPING_SCHEMA = "codigo_estacion_raw string, codigo_unico_api string"


def test_weather_keeps_rows_and_matches_nulls(spark, measurements):
    df = measurements({}, {"codigo_estacion": "B", "region": None}, {"comuna": "Otra"}).drop(*WEATHER)
    weather = spark.createDataFrame([
        (at("2026-06-03 12:45"), "Talca", "Maule", 1.0, 2.0, 3.0, 4.0),
        (at("2026-06-03 12:00"), "Talca", None, 5.0, 6.0, 7.0, 8.0),
    ], "fecha_hora timestamp_ntz, comuna string, region string, " + ", ".join(f"{c} double" for c in WEATHER))
    rows = J.join_weather(df, weather).orderBy("_seq").collect()
    assert [r["velocidad_viento"] for r in rows] == [1.0, 5.0, None]


def test_weather_repeats_a_measurement_per_match(spark, measurements):
    weather = spark.createDataFrame(
        [(at("2026-06-03 12:00"), "Talca", "Maule", w, 2.0, 3.0, 4.0) for w in (1.0, 9.0)],
        "fecha_hora timestamp_ntz, comuna string, region string, " + ", ".join(f"{c} double" for c in WEATHER))
    assert J.join_weather(measurements({}), weather).count() == 2


def test_dataset_does_not_fan_out_over_industries(star):
    df = J.modeling_dataset(star)
    rows = {r["codigo_estacion"]: r for r in df.collect()}
    assert df.columns == MODELING_COLUMNS and len(rows) == 2
    assert rows["SEN-TAL-OF-001"]["emision_maxima_permitida"] == 420.0
    assert rows["SEN-CHI-ONG-001"]["categoria_ica"] == "Preemergencia"


def test_filters(star):
    ids = lambda **kw: sorted(
        r[0] for r in J.star_join(star, MeasurementFilter(**kw)).select("id_monitoreo").collect())
    assert ids() == [1, 2]
    assert ids(region="") == [1, 2]
    assert ids(comuna="TAL") == [1]
    assert ids(comuna="t_lca") == [1]
    assert ids(id_comuna=2) == [2] and ids(id_estacion=1) == [1] and ids(id_estacion=0) == []
    assert ids(mp25_min=65.0, mp25_max=65.0) == [1]
    assert ids(fecha_inicio="2026-06-18 06:00:00") == [2]
    assert ids(fecha_fin=at("2026-06-18 00:00:00")) == [1]
    assert ids(tipo_sensor="publico_oficial", region="Maule") == [1]


def test_view_filter_skips_absent_columns(star):
    df = J.modeling_dataset(star)
    view = ViewFilter(regions=["Maule"], risk_levels=["x"], date_start="2026-06-18",
                      date_end="2026-06-18")
    assert apply_view(df, view, "fecha_hora").count() == 1
    assert apply_view(df, ViewFilter(), "no_existe").count() == 2
    alerts = df.withColumn("categoria_predicha", F.col("categoria_ica"))
    assert apply_view(alerts, ViewFilter(alert_categories=["Regular"])).count() == 1


def test_summary_and_rankings(star):
    row = R.general_summary(star).first()
    assert row["comuna_mas_critica"] == "Chillan" and row["mp25_promedio"] == 90.0
    assert (row["total_comunas"], row["total_industrias"], row["total_mediciones"]) == (2, 3, 2)
    assert [r["categoria"] for r in R.critical_comunas(star).collect()] == ["Preemergencia", "Regular"]
    with pytest.raises(ValueError):
        R.critical_comunas(star, limit=0)
    with pytest.raises(ValueError):
        R.sensor_ranking(star, limit=101)


def test_summary_of_an_empty_fact(star):
    empty = type(star)(star.comunas, star.estaciones, star.industrias, star.monitoreo.limit(0))
    row = R.general_summary(empty).first()
    assert row["mp25_promedio"] == 0.0 and row["comuna_mas_critica"] is None


def test_rollup_equals_direct_aggregate_when_a_station_is_hot(spark, star):
    n = F.col("id")
    fact = spark.range(900).select(
        n.alias("id_monitoreo"), F.lit(at("2026-06-18")).cast("timestamp_ntz").alias("fecha_hora"),
        F.when(n % 3 == 0, 2).otherwise(1).cast("long").alias("id_estacion"),
        F.when(n % 10 > 0, (n % 100).cast("double")).alias("mp25"),
    )
    busy = type(star)(star.comunas, star.estaciones, star.industrias, fact)
    direct = J.star_join(busy).groupBy("comuna").agg(
        F.round(F.avg("mp25"), 2).alias("m"), F.count("*").alias("n")).collect()
    rolled = R.mp25_by_comuna(busy).collect()
    assert {(r["comuna"], r["m"], r["n"]) for r in direct} == {
        (r["comuna"], r["mp25_promedio"], r["cantidad_mediciones"]) for r in rolled}


@pytest.mark.parametrize("limit, offset", [(10, 0), (7, 13), (5, 95), (5, 200)])
def test_pages_follow_the_order(ticks, limit, offset):
    df, order = ticks(100), [("fecha_hora", False), ("id_monitoreo", False)]
    ids = lambda d: [r["id_monitoreo"] for r in d.collect()]
    near = ids(K.page(df, order, limit, offset))
    assert near == list(range(99, -1, -1))[offset:offset + limit]


def test_page_bounds(ticks):
    for limit, offset in ((0, 0), (1001, 0), (1, -1)):
        with pytest.raises(ValueError):
            K.page(ticks(5), [("id_monitoreo", True)], limit, offset)


def resolve(spark, measurements, stations, mapping, **change):
    df = measurements({"codigo_estacion": "OF-TAL-001", **change})
    return G.resolve_for_load(
        df, spark.createDataFrame(stations, STATION_SCHEMA),
        spark.createDataFrame(mapping, MAPPING_SCHEMA),
    ).first()


EXACT = (1, "OF-TAL-001", "publico_oficial", "talca")
OTHER = (8, "SEN-TAL-OF-001", "publico_oficial", "Talca")
SECOND = (9, "SEN-TAL-OF-002", "publico_oficial", "Talca")


@pytest.mark.parametrize("stations, mapping, change, expected", [
    ([EXACT, OTHER], [("OF-TAL-001", "SEN-TAL-OF-001")], {}, (1, "exacto_api", None)),
    ([OTHER], [(" OF-TAL-001 ", "SEN-TAL-OF-001")], {}, (8, "mapeo_manual_csv", None)),
    ([OTHER], [], {}, (8, "heuristico_seguro", None)),
    ([OTHER], [], {"comuna": "TALCA "}, (8, "heuristico_seguro", None)),
    ([OTHER], [], {"velocidad_viento": None}, (8, "heuristico_seguro", "clima_requerido_por_api")),
    ([OTHER], [("OF-TAL-001", "GONE")], {},
     (None, "mapeo_manual_csv", "codigo_api_no_disponible")),
    ([OTHER, SECOND], [], {}, (None, "heuristico_seguro", "estacion_ambigua")),
    ([], [], {}, (None, "heuristico_seguro", "estacion_no_encontrada")),
    ([OTHER], [], {"codigo_estacion": "XX"}, (None, "sin_mapeo", "estacion_no_encontrada")),
    ([OTHER], [], {"comuna": None}, (None, "sin_mapeo", "estacion_no_encontrada")),
])
def test_resolution_chain(spark, measurements, stations, mapping, change, expected):
    row = resolve(spark, measurements, stations, mapping, **change)
    assert (row["id_estacion"], row["modo_mapeo"], row["motivo_omision"]) == expected


def test_stored_rows_are_omitted(spark, measurements, star):
    df = measurements({"codigo_estacion": "SEN-TAL-OF-001", "fecha_hora": at("2026-06-18")},
                      {"codigo_estacion": "SEN-TAL-OF-001"})
    stations = star.places().select("id_estacion", "codigo_unico", "tipo", "comuna")
    mapping = spark.createDataFrame([], MAPPING_SCHEMA)
    payload, omitted = G.prepare_load(df, stations, mapping, star.monitoreo)
    assert [r["_seq"] for r in payload.collect()] == [1]
    row = omitted.first()
    assert omitted.columns == OMITTED_COLUMNS and row["motivo_omision"] == "medicion_ya_existente"
    report = G.load_report(payload, omitted, dry_run=False, inserted=1).first()
    assert report["total_con_id_estacion"] == 2 and report["modo"] == "api"


def batch(spark, *rows):
    base = {"fecha_hora": at("2026-06-20"), "id_estacion": 1, "mp25": 1.0, "mp10": 1.0,
            "so2": 1.0, "no2": 1.0, "velocidad_viento": 1.0, "direccion_viento_grados": 1.0,
            "temperatura": 1.0, "humedad": 1.0}
    schema = "indice long, fecha_hora timestamp_ntz, id_estacion long, " + ", ".join(
        f"{c} double" for c in list(base)[2:])
    return spark.createDataFrame(
        [(i, *[{**base, **row}[c] for c in base]) for i, row in enumerate(rows)], schema)


def test_text_payload_names_unreadable_fields(spark, star):
    texts = batch(spark, {}, {}, {}, {"mp10": None}).select(
        "indice", *[F.col(c).cast("string").alias(c) for c in G.INGEST_COLUMNS])
    at_row = {"mp25": (0, "s/d"), "fecha_hora": (1, "ayer"), "so2": (2, "Infinity")}
    broken = texts.withColumns({
        c: F.when(F.col("indice") == i, F.lit(w)).otherwise(F.col(c)) for c, (i, w) in at_row.items()})
    accepted, rejected = G.ingest_batch(
        G.typed_payload(broken), star.estaciones, star.monitoreo)
    assert accepted.count() == 0
    reasons = {r["indice"]: r["motivo"] for r in rejected.collect()}
    assert reasons == {
        0: f"mp25: {G.NUMBER_ERROR}", 1: "fecha_hora: Input should be a valid datetime",
        2: f"so2: {G.NUMBER_ERROR}", 3: "mp10: Field required"}
    # A payload without a column is one whose field is absent.
    bare = G.typed_payload(texts.drop("humedad"))
    assert G.ingest_batch(bare, star.estaciones, star.monitoreo)[1].filter(
        F.col("motivo").contains("humedad: Field required")).count() == 4


def test_error_details_count_each_reason(spark):
    df = spark.createDataFrame(
        [(0, "a: x; b: y"), (1, "a: x"), (2, G.UNKNOWN_STATION + "7"), (3, G.UNKNOWN_STATION + "8")],
        "indice long, motivo string")
    assert {tuple(r) for r in G.error_details(df).collect()} == {
        ("a: x", 2), ("b: y", 1), (G.UNKNOWN_STATION, 2)}
    assert G.error_details(df.limit(0)).count() == 0


def test_bulk_ingest(spark, star):
    df = batch(
        spark, {"mp25": -1.0}, {}, {}, {"id_estacion": 7}, {"fecha_hora": at("2026-06-18")},
        {"humedad": 101.0, "temperatura": -51.0}, {"fecha_hora": None},
    )
    accepted, rejected = G.ingest_batch(df, star.estaciones, star.monitoreo)
    assert [r["indice"] for r in accepted.collect()] == [1]
    assert {r["indice"]: r["motivo"] for r in rejected.collect()} == {
        0: "mp25: Input should be greater than or equal to 0",
        2: G.DUPLICATE_REASON, 3: "No existe estacion con id_estacion=7", 4: G.DUPLICATE_REASON,
        5: "temperatura: Input should be greater than or equal to -50; "
           "humedad: Input should be less than or equal to 100",
        6: "fecha_hora: Field required",
    }
    summary = G.ingest_summary(accepted, rejected).first()
    assert (summary["insertados"], summary["errores"]) == (1, 6)


def test_single_insert(spark, star):
    ok = G.insert_one(batch(spark, {}), star.estaciones, star.monitoreo)
    assert ok.count() == 1
    with pytest.raises(LookupError, match="id_estacion=7"):
        G.insert_one(batch(spark, {"id_estacion": 7}), star.estaciones, star.monitoreo)
    with pytest.raises(ValueError, match="Ya existe"):
        G.insert_one(batch(spark, {"fecha_hora": at("2026-06-18")}), star.estaciones, star.monitoreo)


def test_payload_is_appended_to_its_own_store(spark, star, measurements, tmp_path):
    path = str(tmp_path / "fact")
    write_measurements(star.monitoreo.drop("id_monitoreo"), path)
    store = spark.read.parquet(path)
    df = measurements({"codigo_estacion": "SEN-TAL-OF-001", "fecha_hora": at("2026-06-18")},
                      {"codigo_estacion": "SEN-TAL-OF-001"},
                      {"codigo_estacion": "SEN-CHI-ONG-001", "comuna": "Chillan"})
    stations = star.places().select("id_estacion", "codigo_unico", "tipo", "comuna")
    mapping = spark.createDataFrame([], MAPPING_SCHEMA)
    for inserted, total in ((2, 4), (0, 4)):
        result, rejected = etl.store_payload(
            etl.load(df, stations, mapping, store), star.estaciones, store, path)
        report = result.report.first()
        assert (report["modo"], report["insertados"], report["errores"]) == ("api", inserted, 0)
        assert report["omitidas_por_medicion_ya_existente"] == 3 - inserted
        assert rejected.count() == 0
        store = spark.read.parquet(path)
        assert store.count() == total


def test_insert_absent_and_coverage(spark, star):
    incoming = spark.createDataFrame([("Talca",), ("Nueva",), (None,)], "nombre string")
    rows = J.insert_absent(incoming, star.comunas, ["nombre"]).collect()
    assert {r["nombre"] for r in rows} == {"Nueva", None}
    lonely = type(star)(star.comunas, star.estaciones.filter("id_comuna = 1"), star.industrias, star.monitoreo)
    assert {(r["region"], r["comunas"], r["sensores"]) for r in J.region_coverage(lonely).collect()} == {
        ("Maule", 1, 1), ("Nuble", 1, 0)}


def test_missing_slots(star):
    rows = {tuple(r) for r in J.missing_slots(star).select(
        "id_estacion", "desde", "hasta", "franjas").collect()}
    early, late = at("2026-06-18 00:00"), at("2026-06-18 06:00")
    assert rows == {(1, late, late, 1), (2, early, early, 1)}
    silent = star.monitoreo.filter("id_estacion = 1").unionByName(
        star.monitoreo.filter("id_estacion = 1").withColumn(
            "fecha_hora", F.lit("2026-06-20 13:00").cast("timestamp_ntz")))
    rows = {(r["id_estacion"], r["franjas"]) for r in J.missing_slots(
        type(star)(star.comunas, star.estaciones, star.industrias, silent)).collect()}
    assert rows == {(1, 9), (2, 11)}
    nothing = type(star)(star.comunas, star.estaciones, star.industrias, star.monitoreo.limit(0))
    assert J.missing_slots(nothing).collect() == []


def test_time_bounds_prune_the_folders_of_a_stored_fact(spark, star, tmp_path):
    path = str(tmp_path / "fact")
    write_measurements(star.monitoreo, path)
    stored = spark.read.parquet(path)
    where = MeasurementFilter(fecha_inicio="2026-06-18 00:00", fecha_fin="2026-06-18 23:00")
    found = stored.filter(where.on_fact(stored))
    assert "PartitionFilters: [isnotnull(fecha" in plan_of(found)
    assert found.count() == star.monitoreo.filter(where.on_fact(star.monitoreo)).count()
    known = J.existing_measurements(star.monitoreo, stored)
    assert "dynamicpruning" in plan_of(known)
    assert known.count() == star.monitoreo.count()
    assert J.new_measurements(star.monitoreo, stored).count() == 0


def test_pages_equal_the_sorted_rows_with_nulls_and_mixed_order(spark):
    rows = [(i, None if i % 4 == 0 else i % 3, str(i % 5), i / 7) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, a int, s string, x double")
    for key in ("a", "s", "x"):
        for up, id_up in ((False, False), (True, False), (False, True)):
            sort = [getattr(F.col(c), "asc_nulls_last" if u else "desc_nulls_last")()
                    for c, u in ((key, up), ("id", id_up))]
            whole = [r["id"] for r in df.orderBy(*sort).collect()]
            for offset in (0, 7, 33, 50):
                got = [r["id"] for r in K.page(df, [(key, up), ("id", id_up)], 6, offset).collect()]
                assert got == whole[offset:offset + 6]


def test_page_by_given_cells(spark, tmp_path):
    path = str(tmp_path / "hechos")
    days = spark.range(400).select(
        F.col("id"), F.expr("timestamp_ntz'2026-01-01 00:00:00' + make_dt_interval(0, 6 * id)").alias("t"))
    days.withColumn("fecha", F.to_date("t")).write.partitionBy("fecha").parquet(path)
    stored = spark.read.parquet(path)
    cells = {"t": [F.col("fecha"), F.col("t")]}
    got = K.page(stored, [("t", False), ("id", False)], 5, 203, cells=cells)
    assert [r["id"] for r in got.collect()] == [196, 195, 194, 193, 192]
    assert "BroadcastHashJoin" in plan_of(got)


def test_insert_absent_stores_a_repeated_key_once(spark):
    incoming = spark.createDataFrame([("x", 2), ("x", 1), ("y", 3), (None, 4), (None, 5)], "k string, v int")
    stored = spark.createDataFrame([("y",), (None,)], "k string")
    rows = J.insert_absent(incoming, stored, ["k"], ["v"]).collect()
    assert sorted((r["k"] or "", r["v"]) for r in rows) == [("", 4), ("", 5), ("x", 1)]
