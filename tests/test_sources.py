import json
import re
from dataclasses import replace
from datetime import date

import pytest
from conftest import at
from pyspark.sql import functions as F

from ventis.functions.text import normalize_columns
from ventis.plans import etl
from ventis.schemas import MAPPING_COLUMNS
from ventis.sources import readers, writers
from ventis.sources.star import Star, get_by_id, list_dimension


def write(path, *lines, encoding="utf-8"):
    path.write_bytes(("\n".join(lines) + "\n").encode(encoding))
    return str(path)


def test_missing_and_empty_sources(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="no.csv"):
        readers.read_source(spark, str(tmp_path / "no.csv"), "x")
    for lines in ([], ["a,b"]):
        path = tmp_path / f"e{len(lines)}.csv"
        path.write_text("".join(line + "\n" for line in lines))
        with pytest.raises(ValueError, match="fuente x"):
            readers.read_source(spark, str(path), "x")


def test_rows_are_text_and_keep_file_order(spark, tmp_path):
    for i in range(3):
        write(tmp_path / f"p{i}.csv", "n,comuna", *[f"{i * 100 + j},Ñuble" for j in range(50)])
    df = readers.read_source(spark, str(tmp_path), "x")
    assert dict(df.dtypes)["n"] == "string"
    values = [int(r["n"]) for r in df.orderBy("_seq").collect()]
    assert values == sorted(values) and len(values) == 150
    assert df.filter(F.col("comuna") == "Ñuble").count() == 150


def test_mapping_contract(spark, tmp_path):
    header = ",".join(MAPPING_COLUMNS)
    good = write(tmp_path / "ok.csv", header, " A ,S-1,Talca,Maule,oficial,publico_oficial")
    assert readers.read_station_mapping(spark, good).first()["codigo_estacion_raw"] == "A"
    short = write(tmp_path / "short.csv", "codigo_estacion_raw,comuna", "A,T")
    with pytest.raises(ValueError, match="codigo_unico_api, region"):
        readers.read_station_mapping(spark, short)
    twice = write(tmp_path / "twice.csv", header, *[f"{c},S,T,M,o,p" for c in ("B", "A", " B", "A")])
    with pytest.raises(ValueError, match="2 valores duplicados: A, B$"):
        readers.read_station_mapping(spark, twice)
    latin = write(tmp_path / "latin.csv", header, "A,S,Chillán,M,o,p", encoding="latin-1")
    with pytest.raises(ValueError, match="UTF-8"):
        readers.read_station_mapping(spark, latin)


def test_labeled_reader(spark, tmp_path):
    path = write(tmp_path / "d.csv", "fecha_hora,comuna,mp25",
                 "2026-06-01T00:00:00,ChillÃ¡n,4.5", "mala,Talca,x")
    rows = readers.read_labeled(spark, path).orderBy("comuna").collect()
    assert rows[0]["comuna"] == "Chillán" and rows[0]["mp25"] == 4.5
    assert rows[1]["fecha_hora"] is None and rows[1]["mp25"] is None
    with pytest.raises(Exception, match="fechas invalidas"):
        readers.read_labeled(spark, path, strict_dates=True).collect()


def test_normalize_columns(spark):
    df = spark.createDataFrame([(1, 2)], ["  Fecha Hora ", "MP25"])
    assert normalize_columns(df).columns == ["fecha_hora", "mp25"]


def test_payload_has_no_metadata(measurements, tmp_path, spark):
    df = measurements({}).withColumn("id_estacion", F.lit(8))
    writers.write_payload(df, str(tmp_path / "p"))
    line = json.loads(spark.read.text(str(tmp_path / "p")).first()[0])
    assert list(line) == writers.PAYLOAD_FIELDS and line["mp25"] == 40.0
    text = json.loads(writers.payload_json(df.withColumn("humedad", F.lit(None))).first()[0])
    assert text["fecha_hora"] == "2026-06-03T12:00:00" and text["humedad"] is None


def test_fact_is_partitioned_by_date_and_star_round_trips(star, tmp_path, spark):
    root = str(tmp_path)
    for name in ("comunas", "estaciones", "industrias", "monitoreo"):
        table = {"estaciones": "estaciones_sensores", "industrias": "industrias_fuentes",
                 "monitoreo": "monitoreo_ambiental"}.get(name, name)
        if name == "monitoreo":
            writers.write_measurements(star.monitoreo, f"{root}/{table}")
        else:
            writers.write_table(getattr(star, name), f"{root}/{table}")
    assert (tmp_path / "monitoreo_ambiental" / "fecha=2026-06-18").exists()
    again = Star.read(spark, root)
    assert again.monitoreo.count() == 2
    assert list_dimension(again.industrias, "id_industria").first()["nombre"] == "Industria Talca"
    assert get_by_id(again.comunas, "id_comuna", 99).isEmpty()
    assert again.monitoreo.agg(F.min("fecha_hora")).first()[0] == at("2026-06-18")


def test_a_late_day_replaces_only_its_own_files(star, tmp_path, spark):
    """A second export of two days: a changed one and one that lost its rows."""
    path = str(tmp_path / "dataset")
    more = star.monitoreo.unionByName(star.monitoreo.withColumns({
        "id_monitoreo": F.col("id_monitoreo") + 10,
        "fecha_hora": F.col("fecha_hora") + F.expr("INTERVAL 1 DAY")})).unionByName(
        star.monitoreo.withColumns({
            "id_monitoreo": F.col("id_monitoreo") + 20,
            "fecha_hora": F.col("fecha_hora") + F.expr("INTERVAL 2 DAY")}))
    etl.export_dataset(replace(star, monitoreo=more), path)

    def files(day):
        return {(p, p.stat().st_mtime_ns) for p in (tmp_path / "dataset" / f"fecha={day}").glob("*")}

    before = {day: files(day) for day in ("2026-06-18", "2026-06-19", "2026-06-20")}
    assert all(before.values())
    late = more.filter("id_monitoreo < 20").withColumn(
        "mp25", F.when(F.col("id_monitoreo") == 11, 1.0).otherwise(F.col("mp25") + 5))
    etl.export_dataset(replace(star, monitoreo=late), path, [date(2026, 6, 19), date(2026, 6, 20)])
    assert files("2026-06-18") == before["2026-06-18"]
    assert files("2026-06-19").isdisjoint(before["2026-06-19"]) and not files("2026-06-20")
    rows = spark.read.parquet(path).orderBy("fecha_hora").collect()
    assert [r["mp25"] for r in rows] == [65.0, 115.0, 1.0, 120.0]


def test_an_export_of_days_scans_only_their_folders(star, tmp_path, spark):
    stored = str(tmp_path / "fact")
    writers.write_measurements(star.monitoreo.unionByName(star.monitoreo.withColumn(
        "fecha_hora", F.col("fecha_hora") + F.expr("INTERVAL 1 DAY"))), stored)
    fact = spark.read.parquet(stored)
    wanted = []
    original = etl.write_days

    def seen(df, path, days):
        wanted.append(df._jdf.queryExecution().executedPlan().toString())
        original(df, path, days)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(etl, "write_days", seen)
        etl.export_dataset(replace(star, monitoreo=fact), str(tmp_path / "out"), [date(2026, 6, 19)])
    filters = re.search(r"PartitionFilters: \[([^\]]*)", wanted[0]).group(1)
    assert "fecha" in filters
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
