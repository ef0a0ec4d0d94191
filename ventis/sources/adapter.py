"""Star schema and feeds expressed over the test tables.

``events`` plays the measurement fact, ``customer`` the stations, ``nation`` and ``region`` the
municipalities, ``supplier`` the industries. Every frame here is a lazy projection or join of
the whole tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ventis.functions.dates import hour_floor
from ventis.functions.sensors import COMMUNITY, OFFICIAL
from ventis.schemas import POLLUTANTS, WEATHER
from ventis.sources.star import Star


# Known layouts of the test tables; reading with a schema skips the footer-reading job.
LAYOUTS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, "
              "props string",
}


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.schema(LAYOUTS[name]).parquet(f"{root}/{name}.parquet")


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def readings(k: Column, value: Column) -> dict[str, Column]:
    """Measured values derived from an event's ``value`` and its 0..99 counter ``k``."""
    real = k.cast("double")
    return {
        "mp25": value,
        "mp10": value + real,
        "so2": real / 2,
        "no2": real,
        "velocidad_viento": real / 10,
        "direccion_viento_grados": real * 3.6,
        "temperatura": 30 - real / 4,
        "humedad": real,
    }


def monitoreo(spark: SparkSession, root: str) -> DataFrame:
    values = readings(_k(), F.col("value"))
    return table(spark, root, "events").select(
        F.col("event_id").alias("id_monitoreo"),
        F.col("ts").alias("fecha_hora"),
        F.col("user_id").alias("id_estacion"),
        *[values[name].alias(name) for name in POLLUTANTS + WEATHER],
    )


def star(spark: SparkSession, root: str) -> Star:
    nation = table(spark, root, "nation")
    region = table(spark, root, "region")
    key = F.col("n_nationkey").cast("long")
    comunas = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        key.alias("id_comuna"),
        F.col("n_name").alias("nombre"),
        F.col("r_name").alias("region"),
        (100000 + key * 1000).alias("poblacion_estimada"),
        (F.lit(50.0) + key).alias("indice_vulnerabilidad_respiratoria"),
    )
    station = F.col("c_custkey")
    estaciones = table(spark, root, "customer").select(
        station.alias("id_estacion"),
        F.col("c_name").alias("codigo_unico"),
        F.col("c_mktsegment").alias("tipo"),
        (F.lit(-30.0) - station % 10).alias("latitud"),
        (F.lit(-70.0) - station % 5).alias("longitud"),
        F.col("c_nationkey").cast("long").alias("id_comuna"),
    )
    industrias = table(spark, root, "supplier").select(
        F.col("s_suppkey").alias("id_industria"),
        F.col("s_name").alias("nombre"),
        F.concat(F.lit("rubro "), F.col("s_nationkey") % 4).alias("rubro_industrial"),
        F.col("s_acctbal").alias("emision_maxima_permitida"),
        F.col("s_nationkey").cast("long").alias("id_comuna"),
    )
    return Star(comunas, estaciones, industrias, monitoreo(spark, root))


def _located_events(spark: SparkSession, root: str) -> DataFrame:
    places = star(spark, root).places().select("id_estacion", "codigo_unico", "comuna", "region")
    return (
        table(spark, root, "events")
        .withColumn("k", _k())
        .join(places, F.col("user_id") == F.col("id_estacion"))
    )


# Spellings used to make the raw text feed messy.
COMUNA_SPELLINGS = [
    " Talca ", "CURICO", "chillán", "Concepcion", "san  fernando", "Hualpen", "Rancagua",
    "coronel", "San Carlos", "Linares", "  ", "curicó",
]
REGION_SPELLINGS = [
    "Bio Bio", "biobio", " BIOBÍO", "nuble", "Ñuble", "ohiggins", "O HIGGINS", "O'Higgins",
    " maule ", "Los  Lagos", "",
]


def _choose(options: list[str], position: Column) -> Column:
    return F.get(F.array(*[F.lit(item) for item in options]), position % len(options))


def raw_text_feed(spark: SparkSession, root: str) -> DataFrame:
    """Measurements as untyped text: padded names, decimal commas, three date formats."""
    plain = F.col("value").cast("string")
    k = F.col("k")
    variant = F.col("event_id") % 3
    return table(spark, root, "events").withColumn("k", _k()).select(
        F.col("event_id").alias("_seq"),
        F.when(variant == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .when(variant == 1, F.date_format("ts", "dd/MM/yyyy HH:mm"))
        .otherwise(F.date_format("ts", "yyyy/MM/dd HH:mm")).alias("Fecha Hora"),
        F.concat(F.lit("SEN-"), F.col("user_id")).alias("codigo_estacion"),
        _choose(COMUNA_SPELLINGS, k).alias("Comuna"),
        _choose(REGION_SPELLINGS, k).alias("region"),
        F.when(k == 1, "NR").when(k == 2, "").when(k == 3, "ausente").when(k == 4, "1d")
        .when(k % 5 == 0, F.replace(plain, F.lit("."), F.lit(",")))
        .otherwise(F.concat(F.lit(" "), plain)).alias("mp25"),
        (F.col("value") + k).cast("string").alias("mp10"),
        k.cast("string").alias("so2"),
        F.when(k == 5, "nan").otherwise(k.cast("string")).alias("no2"),
    )


def weather(spark: SparkSession, root: str) -> DataFrame:
    """One hourly weather row per municipality, stamped with the following hour."""
    hours = _located_events(spark, root).select(
        "comuna", "region", "k",
        (hour_floor("ts") + F.expr("INTERVAL 1 HOUR")).alias("fecha_hora"),
    )
    mean = F.sum("k") / F.count("k")
    return hours.groupBy("fecha_hora", "comuna", "region").agg(mean.alias("m")).select(
        "fecha_hora", "comuna", "region",
        (F.col("m") / 10).alias("velocidad_viento"),
        (F.col("m") * 3.6).alias("direccion_viento_grados"),
        (30 - F.col("m") / 4).alias("temperatura"),
        F.col("m").alias("humedad"),
    )


def measurements(spark: SparkSession, root: str) -> DataFrame:
    """Typed measurements without weather, one per event."""
    values = readings(F.col("k"), F.col("value"))
    return _located_events(spark, root).select(
        F.col("event_id").alias("_seq"),
        F.col("ts").alias("fecha_hora"),
        F.col("codigo_unico").alias("codigo_estacion"),
        "comuna", "region",
        *[values[name].alias(name) for name in POLLUTANTS],
        F.when(F.col("event_type").isin("click", "view"), "oficial")
        .otherwise("comunitaria").alias("fuente_dato"),
    )


def faulty_measurements(spark: SparkSession, root: str) -> DataFrame:
    """Clean-shaped measurements with every kind of fault, chosen by the event's counter.

    One event in 97 is delivered twice.
    """
    k = F.col("k")
    values = readings(k, F.col("value"))
    copies = F.when(F.col("event_id") % 97 == 0, F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0))
    )
    faults = {
        "mp25": F.when(k == 7, -values["mp25"]).when(k != 8, values["mp25"]),
        "no2": F.when(k != 9, values["no2"]),
        "velocidad_viento": F.when(k == 96, F.lit(-1.0)).when(k != 95, values["velocidad_viento"]),
        "direccion_viento_grados": F.when(k == 98, F.lit(372.0)).otherwise(
            values["direccion_viento_grados"]),
        "temperatura": F.when(k == 97, F.lit(61.5)).otherwise(values["temperatura"]),
        "humedad": F.when(k == 99, F.lit(104.0)).otherwise(values["humedad"]),
    }
    values.update(faults)
    return (
        _located_events(spark, root)
        .withColumn("copia", F.explode(copies))
        .select(
            (F.col("event_id") * 2 + F.col("copia")).alias("_seq"),
            F.when(k != 13, F.col("ts")).alias("fecha_hora"),
            F.when(k == 5, F.lit("   ")).otherwise(F.col("codigo_unico")).alias("codigo_estacion"),
            F.when(k != 6, F.col("comuna")).alias("comuna"),
            F.when(k == 10, F.lit("")).otherwise(F.col("region")).alias("region"),
            *[values[name].alias(name) for name in POLLUTANTS + WEATHER],
            F.when(k == 11, "sensor_privado")
            .when(F.col("event_type").isin("click", "view"), "oficial")
            .otherwise("comunitaria").alias("fuente_dato"),
        )
    )


def station_catalog(spark: SparkSession, root: str) -> DataFrame:
    """Stations of the store for resolution tests: suppliers with a sensor type."""
    places = star(spark, root).comunas.select("id_comuna", F.col("nombre").alias("comuna"))
    kind = F.col("s_suppkey") % 20
    return (
        table(spark, root, "supplier")
        .select(
            F.col("s_suppkey").alias("id_estacion"),
            F.col("s_name").alias("codigo_unico"),
            F.when(kind == 0, OFFICIAL).when(kind == 1, COMMUNITY)
            .otherwise("otro").alias("tipo"),
            F.col("s_nationkey").cast("long").alias("id_comuna"),
        )
        .join(places, "id_comuna")
        .select("id_estacion", "codigo_unico", "tipo", "comuna")
    )


def _supplier_code(number: Column) -> Column:
    return F.concat(F.lit("Supplier#"), F.lpad(number.cast("string"), 9, "0"))


def station_mapping(spark: SparkSession, root: str) -> DataFrame:
    """Hand mapping of raw codes; codes beyond the catalogue point to nothing."""
    number = F.col("c_custkey")
    return table(spark, root, "customer").select(
        F.concat(F.lit("MAN-"), number).alias("codigo_estacion_raw"),
        _supplier_code(number).alias("codigo_unico_api"),
    )


def unresolved_measurements(spark: SparkSession, root: str) -> DataFrame:
    """Valid measurements whose station codes need each step of the resolution chain."""
    step = F.col("k") % 4
    number = F.col("user_id")
    values = readings(F.col("k"), F.col("value"))
    values["humedad"] = F.when(F.col("k") % 10 != 3, values["humedad"])
    return _located_events(spark, root).select(
        F.col("event_id").alias("_seq"),
        F.col("ts").alias("fecha_hora"),
        F.when(step == 0, _supplier_code(number))
        .when(step == 1, F.concat(F.lit(" MAN-"), number))
        .when(step == 2, F.concat(F.lit("OF-"), number))
        .otherwise(F.concat(F.lit("X-ONG-"), number)).alias("codigo_estacion"),
        "comuna", "region",
        *[values[name].alias(name) for name in POLLUTANTS + WEATHER],
        F.lit("oficial").alias("fuente_dato"),
    )


def incoming_batch(spark: SparkSession, root: str) -> DataFrame:
    """Bulk payload: shifted copies of stored readings with faults, strangers and repeats."""
    k = F.col("k")
    values = readings(k, F.col("value"))
    values["mp25"] = F.when(k == 7, -values["mp25"]).when(k != 8, values["mp25"])
    values["humedad"] = F.when(k == 99, F.lit(104.0)).otherwise(values["humedad"])
    copies = F.when(F.col("event_id") % 97 == 0, F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0))
    )
    return (
        table(spark, root, "events").withColumn("k", _k())
        .withColumn("copia", F.explode(copies))
        .select(
            (F.col("event_id") * 2 + F.col("copia")).alias("indice"),
            F.when(k >= 50, F.col("ts") + F.expr("INTERVAL 400 DAYS"))
            .otherwise(F.col("ts")).alias("fecha_hora"),
            F.when(k == 60, F.col("user_id") + 1000000000)
            .otherwise(F.col("user_id")).alias("id_estacion"),
            *[
                F.when((k == 70) & (F.col("copia") == 0), F.lit(None).cast("double"))
                .otherwise(values[name]).alias(name) if name == "so2"
                else values[name].alias(name)
                for name in POLLUTANTS + WEATHER
            ],
        )
    )
