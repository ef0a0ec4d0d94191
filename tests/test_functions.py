import math

import pytest
from conftest import at
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ventis.functions import air, dates, sensors, text
from ventis.functions.numeric import parse_number, round_half_up

X = F.col("x")


def test_normalize_text(one):
    values = ["  a   b ", "", "   ", None, "a\tb c"]
    assert one(values, text.normalize_text("x")) == ["a b", None, None, None, "a b c"]


def test_region_and_comuna_names(one):
    regions = ["Bio Bio", " BIOBÍO ", "nuble", "O HIGGINS", "ohiggins", "Los  Lagos", None]
    assert one(regions, text.normalize_region("x")) == [
        "Biobío", "Biobío", "Ñuble", "O'Higgins", "O'Higgins", "Los Lagos", None]
    comunas = [" Talca ", "CURICO", "chillán", "hualpen", "san  carlos", "Otra", ""]
    assert one(comunas, text.normalize_comuna("x")) == [
        "Talca", "Curicó", "Chillán", "Hualpén", "San Carlos", "Otra", None]


def test_parse_number(one):
    values = ["45,2", " 7 ", "NR", "ausente", "nan", "", None, "abc", "1d", "-3.5", ".5", "1e3", "1_0"]
    assert one(values, parse_number("x")) == [
        45.2, 7.0, None, None, None, None, None, None, None, -3.5, 0.5, 1000.0, None]


def test_parse_date_iso(one):
    values = ["2026-06-01 00:00:00", "03/06/2026 06:00", "2026/06/03 12:00", "2026-06-15",
              "06/15/2026 01:00", "2026-13-01", "nada", "", None]
    assert one(values, dates.parse_date_mixed("x")) == [
        at("2026-06-01"), at("2026-06-03 06:00"), at("2026-06-03 12:00"), at("2026-06-15"),
        at("2026-06-15 01:00"), None, None, None, None]


def test_parse_date_other_forms(one):
    values = ["03/06/26 06:00", "03.06.2026", "20260603", "20260603T061500", "3 June 2026",
              "03/06/2026 6:00 PM", "03-Jun-2026", "June 3, 2026 12:05 am", "3 Sept. 2026",
              "31-Feb-2026", "03/06/98", "03/06/2026 13:00 PM", "3 Junk 2026"]
    assert one(values, dates.parse_date_mixed("x")) == [
        at("2026-06-03 06:00"), at("2026-06-03"), at("2026-06-03"), at("2026-06-03 06:15"),
        at("2026-06-03"), at("2026-06-03 18:00"), at("2026-06-03"), at("2026-06-03 00:05"),
        at("2026-09-03"), None, at("1998-06-03"), None, None]


def test_parse_date_legacy_swaps_when_the_day_can_be_a_month(one):
    values = ["2026-06-01 00:00:00", "2026/06/03 12:00", "03/06/2026 06:00", "2026-06-15 06:00:00"]
    assert one(values, dates.parse_date_mixed("x", "legacy_dayfirst")) == [
        at("2026-01-06"), at("2026-03-06 12:00"), at("2026-06-03 06:00"), at("2026-06-15 06:00")]
    with pytest.raises(ValueError):
        dates.parse_date_mixed("x", "otro")


def test_repair_mojibake(one):
    values = ["ConcepciÃ³n", "Ã\u0091uble", "Chillán", "  a  b ", "Ã€ 漢", "Ã", None]
    assert one(values, text.repair_mojibake("x")) == [
        "Concepción", "Ñuble", "Chillán", "a b", "Ã€ 漢", "Ã", None]


@settings(max_examples=15, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(max_size=12), min_size=1, max_size=20))
def test_repair_matches_the_codec_definition(one, values):
    values = [v for v in values if not any(0xD800 <= ord(c) < 0xE000 for c in v)] or [""]

    def expected(value):
        value = " ".join(value.split())
        if not any(mark in value for mark in "ÃÂâ"):
            return value
        try:
            return value.encode("latin-1").decode("utf-8")
        except UnicodeError:
            return value

    broken = [v.encode("utf-8").decode("latin-1") for v in values]
    everything = values + broken
    assert one(everything, text.repair_mojibake("x")) == [expected(v) for v in everything]


def test_sensor_type(one):
    codes = ["OF-RAN-001", "SEN-TAL-OF-001", "x-of", "ong-1", "SEN-ONG-1", "XONG1", "LOF-1", None]
    assert one(codes, sensors.sensor_type_from_code("x")) == [
        sensors.OFFICIAL, sensors.OFFICIAL, sensors.OFFICIAL, sensors.COMMUNITY,
        sensors.COMMUNITY, None, None, None]
    source = F.lit(None).cast("string")
    assert one(codes, sensors.infer_sensor_type(source, X)) == [
        sensors.OFFICIAL, sensors.OFFICIAL, sensors.UNKNOWN, sensors.COMMUNITY,
        sensors.COMMUNITY, sensors.COMMUNITY, sensors.UNKNOWN, sensors.UNKNOWN]
    assert one(["OF-ONG-1"], sensors.infer_sensor_type(F.lit("oficial"), X)) == [sensors.COMMUNITY]
    assert one(["Z"], sensors.infer_sensor_type(F.lit("comunitaria"), X)) == [sensors.UNKNOWN]


def test_ica_bounds(one):
    values = [0.0, 49.99, 50.0, 79.99, 80.0, 110.0, 169.99, 170.0, -1.0, None]
    assert one(values, air.ica_category(X), "double") == [
        "Buena", "Buena", "Regular", "Regular", "Alerta", "Preemergencia", "Preemergencia",
        "Emergencia", None, None]
    with pytest.raises(PySparkException):
        one([-1.0], air.ica_category(X, strict=True), "double")
    struct = one([90.0], air.classify_ica(X), "double")[0]
    assert struct["color_referencial"] == "naranjo"
    assert struct["mensaje_ciudadano"] == "Evitar actividad fisica intensa al aire libre."


def test_icap_uses_the_worse_scale(one):
    assert one([10.0, 10.0, 60.0, 170.0], air.icap_category(X, F.lit(200.0)), "double") == [
        "Alerta", "Alerta", "Alerta", "Emergencia"]


def test_outlook(one):
    result = one([10.0, None, 500.0], air.citizen_outlook(X), "double")
    assert result == [air.OUTLOOK_SENTENCES["Buena"], air.OUTLOOK_MISSING,
                      air.OUTLOOK_SENTENCES["Emergencia"]]


def test_seasons_and_calendar(one, spark):
    values = ["2026-12-01", "2026-03-01", "2026-06-30", "2026-09-01", None]
    assert one(values, dates.season_of(X.cast("timestamp_ntz"))) == [
        "verano", "otono", "invierno", "primavera", "desconocida"]
    df = spark.createDataFrame([(at("2026-06-01 13:45:10"),)], "fecha_hora timestamp_ntz")
    row = df.select(*[c.alias(n) for n, c in dates.calendar_parts().items()]).first()
    assert (row["anio"], row["mes"], row["dia"], row["hora"], row["dia_semana"]) == (
        2026, 6, 1, 13, "Monday")
    assert df.select(dates.feature_calendar()["dia_semana"]).first()[0] == 0


def test_time_expressions(one):
    values = ["2026-06-01 13:45:10.5", "2026-06-01 23:59:59", "2026-06-01 00:00:00.000007"]
    ts = X.cast("timestamp_ntz")
    assert one(values, dates.hour_floor(ts)) == [
        at("2026-06-01 13:00"), at("2026-06-01 23:00"), at("2026-06-01 00:00")]
    assert one(values, dates.iso_timestamp(ts)) == [
        "2026-06-01T13:45:10.500000", "2026-06-01T23:59:59", "2026-06-01T00:00:00.000007"]
    assert one(values[:1], dates.plus_hours(ts, 24)) == [at("2026-06-02 13:45:10.5")]


def test_hour_floor_ignores_the_session_zone(one, spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Santiago")
    try:
        # 2026-09-06 00:30 does not exist in that zone.
        assert one(["2026-09-06 00:30:00"], dates.hour_floor(X.cast("timestamp_ntz"))) == [
            at("2026-09-06 00:00")]
        assert one(["06/09/2026 00:30"], dates.parse_date_mixed("x")) == [at("2026-09-06 00:30")]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_rounding(one):
    assert one([1.005, 2.675, -1.005, 0.1 + 0.2], round_half_up(X), "double") == [
        1.01, 2.68, -1.01, 0.3]
    assert math.isclose(one([1.23456], round_half_up(X, 4), "double")[0], 1.2346)


def test_infinite_and_huge_values(one):
    from ventis.functions.numeric import parse_number, round_half_up
    assert one(["inf", "-Infinity", "1e999", "1e3"], parse_number("x")) == [None, None, None, 1000.0]
    big = [2e12, 3e20, float("inf"), 1.005, None]
    assert one(big, round_half_up(F.col("x")), "double") == [2e12, 3e20, float("inf"), 1.01, None]
