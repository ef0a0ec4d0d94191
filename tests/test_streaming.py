import json
import os
import shutil
from datetime import date

from conftest import at
from pyspark.sql import functions as F

from ventis.session import _own_folder
from ventis.streaming.ingest import (
    LOG, PAYLOAD_SCHEMA, ingest_stream, read_payloads, stored_measurements, valid_unique_stream,
)
from ventis.streaming.store import stored_on
from ventis.streaming.windows import windowed_ica

FIELDS = {"mp25": 1.0, "mp10": 1.0, "so2": 1.0, "no2": 1.0, "velocidad_viento": 1.0,
          "direccion_viento_grados": 1.0, "temperatura": 1.0, "humedad": 1.0}


def drop(folder, name, *rows):
    folder.mkdir(exist_ok=True)
    lines = [json.dumps({**FIELDS, "id_estacion": 1, **row}) for row in rows]
    (folder / f"{name}.json").write_text("\n".join(lines))


def run(writer):
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    assert query.exception() is None


def test_stream_ingest_equals_batch_rules(spark, star, tmp_path):
    inbox, store, rejects = tmp_path / "in", str(tmp_path / "store"), str(tmp_path / "rej")

    def cycle():
        stream = read_payloads(spark, str(inbox), max_files=1)
        run(ingest_stream(stream, star.estaciones, store, rejects, str(tmp_path / "ckpt")))

    drop(inbox, "a", {"fecha_hora": "2026-06-20T00:00:00", "mp25": -1.0},
         {"fecha_hora": "2026-06-20T00:00:00"}, {"fecha_hora": "2026-06-20T00:00:00"},
         {"fecha_hora": "2026-06-20T06:00:00", "id_estacion": 77})
    cycle()
    # A very late repeat and a new row arrive in later files.
    drop(inbox, "b", {"fecha_hora": "2026-07-20T00:00:00"})
    cycle()
    drop(inbox, "c", {"fecha_hora": "2026-06-20T00:00:00"}, {"fecha_hora": "2026-06-20T12:00:00"})
    cycle()
    rows = spark.read.parquet(store).orderBy("fecha_hora").collect()
    assert [r["fecha_hora"] for r in rows] == [
        at("2026-06-20 00:00"), at("2026-06-20 12:00"), at("2026-07-20 00:00")]
    reasons = sorted(r["motivo"] for r in spark.read.parquet(rejects).collect())
    assert len(reasons) == 4
    assert reasons[0] == "No existe estacion con id_estacion=77"
    assert reasons[-1].startswith("mp25:")


def test_a_repeated_batch_gives_the_same_store(spark, star, tmp_path):
    inbox, store, rejects = tmp_path / "in", str(tmp_path / "store"), str(tmp_path / "rej")
    drop(inbox, "a", {"fecha_hora": "2026-06-20T00:00:00"})
    for attempt in ("one", "two"):
        stream = read_payloads(spark, str(inbox))
        run(ingest_stream(stream, star.estaciones, store, rejects, str(tmp_path / attempt)))
    assert spark.read.parquet(store).count() == 1
    assert spark.read.parquet(rejects).count() == 0


def test_a_batch_touches_only_its_own_days(spark, star, tmp_path):
    """Three batches, a late repeat and a re-run: other days are neither read nor written."""
    inbox, store, rejects = tmp_path / "in", str(tmp_path / "store"), str(tmp_path / "rej")
    assert stored_measurements(spark, store).count() == 0

    def cycle():
        stream = read_payloads(spark, str(inbox), max_files=1)
        run(ingest_stream(stream, star.estaciones, store, rejects, str(tmp_path / "ckpt")))

    def files(day):
        return {(p, p.stat().st_mtime_ns) for p in (tmp_path / "store" / f"fecha={day}").rglob("*.parquet")}

    drop(inbox, "a", {"fecha_hora": "2026-06-20T00:00:00"}, {"fecha_hora": "2026-06-21T00:00:00"})
    cycle()
    drop(inbox, "b", {"fecha_hora": "2026-07-20T00:00:00"})
    cycle()
    before = {day: files(day) for day in ("2026-06-20", "2026-06-21", "2026-07-20")}
    assert all(before.values())
    # The store of the third batch's days: one folder, the others hold unreadable files meanwhile.
    days = [date(2026, 6, 20), date(2027, 1, 1)]
    read = stored_on(spark, store, PAYLOAD_SCHEMA, days)
    assert {p.split("fecha=")[1][:10] for p in read.inputFiles()} == {"2026-06-20"}
    broken = tmp_path / "store" / "fecha=2026-07-20" / "lote=1" / "x.parquet"
    broken.write_text("no parquet")
    drop(inbox, "c", {"fecha_hora": "2026-06-20T00:00:00"}, {"fecha_hora": "2026-06-20T12:00:00"})
    cycle()
    broken.unlink()
    assert files("2026-06-21") == before["2026-06-21"]
    assert files("2026-07-20") == before["2026-07-20"]
    rows = stored_measurements(spark, store).orderBy("fecha_hora").collect()
    assert [(r["fecha_hora"], r["lote"]) for r in rows] == [
        (at("2026-06-20 00:00"), 0), (at("2026-06-20 12:00"), 2), (at("2026-06-21 00:00"), 0),
        (at("2026-07-20 00:00"), 1)]
    assert spark.read.parquet(rejects).filter("lote = 2").count() == 1
    # Intermediate tables went with their batches.
    assert not any(name.startswith("lote") for name in os.listdir(_own_folder(spark).removeprefix("file:")))


def test_a_failed_batch_is_cleared_before_it_runs_again(spark, star, tmp_path):
    """The first attempt wrote its rows and a stray file, but its end was never noted."""
    inbox, store, rejects = tmp_path / "in", str(tmp_path / "store"), str(tmp_path / "rej")
    checkpoint = tmp_path / "ckpt"

    def cycle():
        stream = read_payloads(spark, str(inbox), max_files=1)
        run(ingest_stream(stream, star.estaciones, store, rejects, str(checkpoint)))

    drop(inbox, "a", {"fecha_hora": "2026-06-20T00:00:00"}, {"fecha_hora": "2026-06-21T00:00:00"})
    cycle()
    folder = tmp_path / "store" / "fecha=2026-06-21" / "lote=0"
    shutil.copy(next(folder.glob("*.parquet")), folder / "rest.parquet")
    assert stored_measurements(spark, store).count() == 3
    assert spark.read.json(f"{store}/{LOG}").count() == 2
    for name in os.listdir(checkpoint / "commits"):
        os.remove(checkpoint / "commits" / name)
    cycle()
    assert sorted(r["fecha_hora"] for r in stored_measurements(spark, store).collect()) == [
        at("2026-06-20 00:00"), at("2026-06-21 00:00")]
    assert spark.read.parquet(rejects).count() == 0


def test_watermark_dedup_checks_rules_first(spark, tmp_path):
    inbox = tmp_path / "in"
    drop(inbox, "a", {"fecha_hora": "2026-06-20T00:00:00", "mp25": -1.0},
         {"fecha_hora": "2026-06-20T00:00:00"}, {"fecha_hora": "2026-06-20T00:00:00"})
    unique = valid_unique_stream(read_payloads(spark, str(inbox)))
    run(unique.writeStream.format("parquet").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "ckpt")))
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert [r["mp25"] for r in rows] == [1.0]


def test_live_windows_equal_the_batch_twin(spark, star, tmp_path):
    inbox = tmp_path / "in"
    hours = range(0, 48, 3)
    drop(inbox, "a", *[{"fecha_hora": f"2026-06-{20 + h // 24}T{h % 24:02d}:30:00", "mp25": 10.0 * h,
                        "id_estacion": 1 + h % 2} for h in hours])
    live = windowed_ica(read_payloads(spark, str(inbox)), star.places(), watermark="1 hour")
    run(live.writeStream.outputMode("append").format("parquet").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "ckpt")))
    batch = spark.read.schema(read_payloads(spark, str(inbox)).schema).json(str(inbox))
    twin = windowed_ica(batch, star.places())
    got = {tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    everything = {tuple(r) for r in twin.collect()}
    closed = {tuple(r) for r in twin.filter(F.col("hasta") <= F.lit(at("2026-06-21 20:30"))).collect()}
    assert got == closed and len(everything - got) > 0
