import pytest
from conftest import at
from pyspark.sql import functions as F

from ventis.operators import quality as Q
from ventis.plans import etl
from ventis.schemas import WEATHER

CASES = [
    ({"mp25": -1.0}, "mp25 negativo"),
    ({"so2": None}, "so2 faltante"),
    ({"velocidad_viento": -0.1}, "velocidad_viento negativa"),
    ({"humedad": 101.0}, "humedad fuera de rango"),
    ({"temperatura": 61.0}, "temperatura fuera de rango"),
    ({"direccion_viento_grados": 361.0}, "direccion_viento_grados fuera de rango"),
    ({"fecha_hora": None}, "fecha_hora nula"),
    ({"codigo_estacion": "   "}, "codigo_estacion vacio"),
    ({"comuna": None}, "comuna vacia"),
    ({"region": ""}, "region vacia"),
    ({"fuente_dato": "sensor_privado"}, "fuente_dato invalida"),
    ({"fuente_dato": None}, "fuente_dato invalida"),
    ({"mp25": -1.0, "humedad": 101.0}, "mp25 negativo; humedad fuera de rango"),
]


def test_each_rule(measurements):
    """Every case has its own station, so only its own rule can fire."""
    changes = []
    for i, (change, _) in enumerate(CASES):
        changes.append({"codigo_estacion": f"E{i}", **change})
    _, errors = Q.validate(measurements(*changes))
    found = {row["_seq"]: row["motivo_error"] for row in errors.collect()}
    assert found == {i: reason for i, (_, reason) in enumerate(CASES)}


def test_valid_rows_and_missing_weather(measurements):
    df = measurements({}, {"codigo_estacion": "B", **dict.fromkeys(WEATHER)})
    valid, errors = Q.validate(df)
    assert valid.count() == 2 and errors.count() == 0


def test_first_of_a_repeated_key_is_the_keeper_even_when_invalid(measurements):
    valid, errors = Q.validate(measurements({"mp25": -1.0}, {}, {}))
    assert valid.count() == 0
    reasons = [r["motivo_error"] for r in errors.orderBy("_seq").collect()]
    assert reasons == ["mp25 negativo", Q.DUPLICATE_MESSAGE, Q.DUPLICATE_MESSAGE]


def test_null_keys_equal_each_other(measurements):
    df = measurements({"fecha_hora": None}, {"fecha_hora": None})
    flags = [r["duplicado"] for r in Q.flag_duplicates(df).orderBy("_seq").collect()]
    assert flags == [False, True]


def test_missing_column_is_named(measurements):
    with pytest.raises(ValueError, match="Faltan columnas requeridas.*no2"):
        Q.validate(measurements({}).drop("no2"))


def test_duplicates_of_a_hot_key_match_a_plain_count(spark):
    """A third of the rows share one key."""
    n = F.col("id")
    df = spark.range(3000).select(
        n.alias("_seq"),
        F.when(n % 3 == 0, "HOT").otherwise(F.concat(F.lit("S"), n % 400)).alias("codigo_estacion"),
        F.lit(at("2026-01-01")).cast("timestamp_ntz").alias("fecha_hora"),
    )
    flagged = Q.flag_duplicates(df)
    keys = df.select(*Q.KEY).distinct().count()
    assert flagged.count() == 3000
    assert flagged.filter(~F.col("duplicado")).count() == keys
    first = flagged.filter(~F.col("duplicado") & (F.col("codigo_estacion") == "HOT")).first()
    assert first["_seq"] == 0
    assert Q.dedupe_first(df, Q.KEY).count() == keys


def test_clean_dataset(measurements):
    df = measurements(
        {"mp25": -5.0, "comuna": " Talca ", "humedad": 140.0, "temperatura": -60.0,
         "direccion_viento_grados": 400.0},
        {"mp25": 1.0},
        {"fecha_hora": at("2026-06-01 00:00")},
        {"fecha_hora": None, "codigo_estacion": "Z"},
    )
    rows = Q.clean_dataset(df).collect()
    assert [r["_seq"] for r in rows] == [2, 0, 3]
    first = rows[1]
    assert first["comuna"] == "Talca" and first["dia_semana"] == "Wednesday"
    assert [first[c] for c in ("mp25", "humedad", "temperatura", "direccion_viento_grados")] == [None] * 4
    assert first["mp10"] == 65.0


def test_audit_of_a_sound_star(star):
    rows = {r["regla"]: r["violaciones"] for r in
            Q.constraint_audit(star, regions=["Maule", "Nuble"]).collect()}
    assert len(rows) == 53 and set(rows.values()) == {0}


def test_audit_counts_absent_values_and_repeated_names_in_any_region(star):
    spark = star.comunas.sparkSession
    comunas = star.comunas.unionByName(spark.createDataFrame(
        [(8, "Talca", "Nuble", None, 50.0), (None, None, "Maule", 10, 50.0)], star.comunas.schema))
    stations = star.estaciones.withColumn("id_comuna", F.lit(None).cast("long"))
    rows = {r["regla"]: r["violaciones"] for r in Q.constraint_audit(
        type(star)(comunas, stations, star.industrias, star.monitoreo), ["Maule", "Nuble"]).collect()}
    assert {k: v for k, v in rows.items() if v and k != "estaciones.nn_id_comuna"} == {
        "comunas.uk_nombre": 1, "comunas.nn_poblacion_estimada": 1, "comunas.nn_nombre": 1,
        "comunas.nn_id_comuna": 1}
    assert rows["estaciones.nn_id_comuna"] == star.estaciones.count()


STATIONS = ["RAN", "TAL", "CUR", "CHI", "SCA", "CON", "COR", "HUA"]


def feed(prefix, start_day, odd_dates):
    """32 raw rows: eight stations of one day each, four slots."""
    rows = []
    for i, code in enumerate(STATIONS):
        month, day = (6, start_day + i) if i < 5 else (9, start_day + i + 4)
        for hour in (0, 6, 12, 18):
            stamp = f"2026-{month:02d}-{day:02d} {hour:02d}:00:00"
            if odd_dates and hour == 6:
                stamp = f"{day:02d}/{month:02d}/2026 06:00"
            if odd_dates and hour == 12:
                stamp = f"2026/{month:02d}/{day:02d} 12:00"
            rows.append([stamp, f"{prefix}-{code}-001", "Curico" if hour == 6 else " Curicó ",
                         "Maule", "45,2", "76.3", "15.9", "28.3"])
    return rows


def test_feeds_end_to_end(spark, tmp_path):
    """64 rows in, 60 valid, the four known faults with their row numbers and texts."""
    official, community = feed("OF", 1, False), feed("ONG", 3, True)
    official[30] = list(official[29])       # exact repeat of a row with bad wind direction
    official[31][7] = ""
    community[30][4] = "-3.5"
    weather = [[official[29][0], " Curicó ", "Maule", "2.4", "372", "7.6", "87"],
               [official[0][0], "CURICO", "maule", "1.2", "180", "\"6,1\"", "88"]]
    header = "fecha_hora,codigo_estacion,comuna,region,mp25,mp10,so2,no2"
    quoted = lambda rows: [",".join(f'"{v}"' if "," in v and '"' not in v else v for v in r) for r in rows]
    files = {
        "mediciones_oficiales": [header, *quoted(official)],
        "sensores_comunitarios": [header, *quoted(community)],
        "clima_historico": ["fecha_hora,comuna,region,velocidad_viento,"
                            "direccion_viento_grados,temperatura,humedad", *quoted(weather)],
        "fiscalizacion_industrias": [
            "Nombre Industria,rubro_industrial,comuna,region,emision_maxima_permitida,"
            "fecha_fiscalizacion,observacion",
            "Planta, celulosa  fina ,Talca,Maule,\"420,5\",15/06/2026,"],
    }
    paths = {}
    for name, lines in files.items():
        path = tmp_path / f"{name}.csv"
        path.write_text("\n".join(lines) + "\n", encoding="utf-8")
        paths[name] = str(path)
    stations = spark.createDataFrame(
        [], "id_estacion long, codigo_unico string, tipo string, comuna string")
    mapping = spark.createDataFrame([], "codigo_estacion_raw string, codigo_unico_api string")
    out = str(tmp_path / "out")
    etl.run_etl(spark, paths, out, stations, mapping, date_policy="legacy_dayfirst")

    read = lambda name: spark.read.parquet(f"{out}/{name}")
    assert read("mediciones_limpias").count() == 64
    assert read("mediciones_validas").count() == 60
    errors = read("errores_etl").orderBy("numero_fila").collect()
    assert [(r["numero_fila"], r["motivo_error"]) for r in errors] == [
        (29, "direccion_viento_grados fuera de rango"),
        (30, "direccion_viento_grados fuera de rango; duplicado codigo_estacion+fecha_hora"),
        (31, "no2 faltante"),
        (62, "mp25 negativo"),
    ]
    assert {r["fase"] for r in errors} == {"validate"}
    industry = read("industrias_limpias").first()
    assert industry["rubro_industrial"] == "celulosa fina"
    assert industry["emision_maxima_permitida"] == 420.5
    first = read("mediciones_limpias").filter("codigo_estacion = 'OF-RAN-001'").orderBy("fecha_hora").first()
    assert first["fecha_hora"] == at("2026-01-06 00:00:00") and first["temperatura"] == 6.1
    report = spark.read.option("header", True).csv(f"{out}/reporte_carga_api").first()
    assert report["omitidas_por_estacion_no_encontrada"] == "60"
    assert report["mensaje"] == "No hay mediciones nuevas compatibles para enviar a la API."
    assert read("omitidas_carga_api").count() == 60
