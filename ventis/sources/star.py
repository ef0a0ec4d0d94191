"""The star schema: three dimensions and the measurement fact."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ventis import schemas


@dataclass(frozen=True)
class Star:
    comunas: DataFrame
    estaciones: DataFrame
    industrias: DataFrame
    monitoreo: DataFrame

    @classmethod
    def read(cls, spark: SparkSession, root: str) -> "Star":
        """Tables written as ``root/<table>`` in Parquet."""
        def table(name, schema):
            return spark.read.schema(schema).parquet(f"{root}/{name}")

        return cls(
            table("comunas", schemas.COMUNAS),
            table("estaciones_sensores", schemas.ESTACIONES),
            table("industrias_fuentes", schemas.INDUSTRIAS),
            table("monitoreo_ambiental", schemas.MONITOREO),
        )

    @classmethod
    def read_jdbc(cls, spark: SparkSession, url: str, properties: dict[str, str],
                  partitions: int, lower: int, upper: int) -> "Star":
        """Tables of a relational database; the fact is read in ranges of its key."""
        def table(name):
            return spark.read.jdbc(url, name, properties=properties)

        fact = spark.read.jdbc(
            url, "monitoreo_ambiental", column="id_monitoreo", lowerBound=lower,
            upperBound=upper, numPartitions=partitions, properties=properties,
        )
        return cls(table("comunas"), table("estaciones_sensores"),
                   table("industrias_fuentes"), fact)

    def places(self) -> DataFrame:
        """Stations with their municipality. Joined by size: no forced broadcast."""
        comuna = self.comunas.select(
            "id_comuna", F.col("nombre").alias("comuna"), "region",
            "poblacion_estimada", "indice_vulnerabilidad_respiratoria",
        )
        return self.estaciones.join(comuna, "id_comuna")


def list_dimension(df: DataFrame, key: str) -> DataFrame:
    return df.orderBy(key)


def get_by_id(df: DataFrame, key: str, value: int) -> DataFrame:
    """At most one row; empty when the id is unknown."""
    return df.filter(F.col(key) == value)
