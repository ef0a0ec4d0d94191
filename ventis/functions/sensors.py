"""Sensor type from station code and source."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

OFFICIAL = "publico_oficial"
COMMUNITY = "sensor_comunitario_ong"
UNKNOWN = "sensor_desconocido"


def sensor_type_from_code(code: Column | str) -> Column:
    """Type when a whole code segment says so (``OF`` or ``ONG``), else NULL."""
    upper = F.upper(code)

    def tagged(tag: str) -> Column:
        return upper.startswith(f"{tag}-") | upper.contains(f"-{tag}-") | upper.endswith(f"-{tag}")

    return F.when(tagged("OF"), OFFICIAL).when(tagged("ONG"), COMMUNITY)


def infer_sensor_type(source: Column, code: Column) -> Column:
    """Lenient type from source and code. A community mark wins over an official one."""
    source = F.lower(F.coalesce(source, F.lit("")))
    code = F.upper(F.coalesce(code, F.lit("")))
    community = source.isin("comunitario", COMMUNITY, "ong") | code.contains("ONG")
    official = (
        source.isin("oficial", OFFICIAL) | code.contains("-OF-") | code.startswith("OF-")
    )
    return F.when(community, COMMUNITY).when(official, OFFICIAL).otherwise(UNKNOWN)
