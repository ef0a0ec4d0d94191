import os
import sys
from datetime import datetime

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ventis import schemas  # noqa: E402
from ventis.session import build_session, drop_materialized  # noqa: E402
from ventis.sources.star import Star  # noqa: E402

SMALL = "/root/testdata/sf0.001"


# Expressions need a running session, also those written at module level in the tests.
SESSION = build_session("tests", "local[4]", {
    "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
    "spark.driver.memory": "6g", "spark.ui.showConsoleProgress": "false",
    "spark.sql.maxMetadataStringLength": "2000",
})
SESSION.sparkContext.setLogLevel("ERROR")


@pytest.fixture(scope="session")
def spark():
    yield SESSION
    SESSION.stop()


@pytest.fixture(scope="module", autouse=True)
def no_tables_of_other_modules(spark):
    """A module's intermediate tables go with it: those that results still read stay until then."""
    yield
    drop_materialized(spark)


@pytest.fixture
def one(spark):
    """Evaluate expressions of one text column ``x`` over values, in order."""
    def run(values, expression, kind="string"):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
        rows = df.select("i", expression.alias("y")).orderBy("i").collect()
        return [row["y"] for row in rows]
    return run


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


MEASUREMENT_SCHEMA = (
    "_seq long, fecha_hora timestamp_ntz, codigo_estacion string, comuna string, region string, "
    + ", ".join(f"{c} double" for c in schemas.POLLUTANTS + schemas.WEATHER)
    + ", fuente_dato string"
)
BASE = {
    "fecha_hora": at("2026-06-03 12:00:00"), "codigo_estacion": "VAL-001", "comuna": "Talca",
    "region": "Maule", "mp25": 40.0, "mp10": 65.0, "so2": 12.0, "no2": 18.0,
    "velocidad_viento": 2.5, "direccion_viento_grados": 180.0, "temperatura": 12.0,
    "humedad": 55.0, "fuente_dato": "oficial",
}


@pytest.fixture
def measurements(spark):
    """Measurements from field changes to one valid row."""
    def build(*changes):
        rows = [
            (i, *[{**BASE, **change}[c] for c in schemas.MEASUREMENT_COLUMNS])
            for i, change in enumerate(changes)
        ]
        return spark.createDataFrame(rows, MEASUREMENT_SCHEMA)
    return build


@pytest.fixture(scope="session")
def star(spark):
    return Star(
        spark.createDataFrame([
            (1, "Talca", "Maule", 250000, 64.2), (2, "Chillan", "Nuble", 198000, 72.8),
        ], schemas.COMUNAS),
        spark.createDataFrame([
            (1, "SEN-TAL-OF-001", "publico_oficial", -35.4264, -71.6554, 1),
            (2, "SEN-CHI-ONG-001", "sensor_comunitario_ong", -36.6152, -72.1185, 2),
        ], schemas.ESTACIONES),
        spark.createDataFrame([
            (1, "Industria Talca", "Celulosa", 420.0, 1),
            (3, "Industria Talca 2", "Agroindustria", 210.0, 1),
            (2, "Industria Chillan", "Calderas industriales", 180.0, 2),
        ], schemas.INDUSTRIAS),
        spark.createDataFrame([
            (1, at("2026-06-18 00:00:00"), 1, 65.0, 110.0, 12.0, 18.0, 2.5, 180.0, 9.0, 70.0),
            (2, at("2026-06-18 06:00:00"), 2, 115.0, 160.0, 20.0, 28.0, 1.5, 90.0, 6.0, 85.0),
        ], schemas.MONITOREO),
    )


@pytest.fixture
def ticks(spark):
    """Series of a few stations of very different sizes, with unique ids."""
    def build(rows=600):
        n = F.col("id")
        return spark.range(rows).select(
            n.alias("id_monitoreo"),
            F.when(n % 3 > 0, "HOT").otherwise(F.concat(F.lit("S"), n % 7)).alias("codigo_estacion"),
            F.concat(F.lit("C"), n % 2).alias("comuna"),
            (F.lit(at("2026-01-01 00:00:00")).cast("timestamp_ntz")
             + F.make_dt_interval(F.lit(0), n * 3)).alias("fecha_hora"),
            ((n * 7919) % 500 / 4.0).alias("mp25"),
            (n % 360).cast("double").alias("direccion_viento_grados"),
        )
    return build


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
