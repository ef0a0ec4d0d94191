"""SQL that states the expected result of each catalogue query over the test tables."""

from __future__ import annotations

from ventis.operators.statistics import CORRELATION_COLUMNS, DESCRIBE_COLUMNS
from ventis.schemas import DETAIL_COLUMNS, MODELING_COLUMNS, POLLUTANTS, WEATHER
from ventis.sources.adapter import COMUNA_SPELLINGS, REGION_SPELLINGS

ORACLES: dict[str, str] = {}

# Fixed values, stated here again so that a wrong constant of the engine shows as a difference.
BOUNDS = [50.0, 80.0, 110.0, 170.0]
CATEGORIES = ["Buena", "Regular", "Alerta", "Preemergencia", "Emergencia"]
ADVICE = [
    "Calidad del aire favorable para actividades al aire libre.",
    "Personas sensibles deberian reducir exposicion prolongada.",
    "Evitar actividad fisica intensa al aire libre.",
    "Reducir actividades al aire libre y priorizar grupos de riesgo.",
    "Permanecer en interiores y evitar exposicion al aire libre.",
]
COLORS = ["verde", "amarillo", "naranjo", "rojo", "morado"]
SENTENCES = [
    "La calidad del aire estimada para las proximas 24 horas se mantiene en niveles bajos de riesgo.",
    "Se espera un aumento moderado de MP2.5. Conviene monitorear la evolucion durante el dia.",
    "El modelo estima un aumento relevante de MP2.5 para las proximas 24 horas.",
    "El modelo estima niveles altos de MP2.5 para las proximas 24 horas. "
    "Esta comuna requiere atencion preventiva.",
    "Se proyectan niveles muy altos de MP2.5 para las proximas 24 horas. "
    "Esta comuna requiere atencion preventiva inmediata.",
]
NO_SENTENCE = "Todavia no hay un pronostico disponible para las proximas 24 horas."
RISK_WEIGHTS = {
    "mp25": 0.45, "mp10": 0.15, "so2": 0.08, "no2": 0.08, "humedad": 0.04,
    "indice_vulnerabilidad_respiratoria": 0.12, "emision_maxima_permitida": 0.04,
    "velocidad_viento": 0.04,
}
DUPLICATE_REASON = "Ya existe una medicion para esa estacion y fecha_hora."
OMISSION_COUNTS = {
    "omitidas_por_estacion_no_encontrada": "estacion_no_encontrada",
    "omitidas_por_estacion_ambigua": "estacion_ambigua",
    "omitidas_por_codigo_api_no_disponible": "codigo_api_no_disponible",
    "omitidas_por_clima_requerido_api": "clima_requerido_por_api",
    "omitidas_por_medicion_ya_existente": "medicion_ya_existente",
}


def rnd(expression: str, digits: int = 4) -> str:
    return f"CAST(ROUND(CAST({expression} AS DECIMAL(18,6)), {digits}) AS DOUBLE)"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _choice(options: list[str], position: str) -> str:
    return f"list_value({', '.join(map(_text, options))})[1 + ({position}) % {len(options)}]"


def level(value: str, results: list[str]) -> str:
    """Air-quality level of a PM2.5 expression; NULL when negative."""
    cases = " ".join(
        f"WHEN {value} < {bound} THEN {_text(result)}" for bound, result in zip(BOUNDS, results)
    )
    return (f"CASE WHEN {value} IS NULL OR {value} < 0 THEN NULL {cases} "
            f"ELSE {_text(results[-1])} END")


def category(value: str) -> str:
    return level(value, CATEGORIES)


def advice(value: str) -> str:
    return level(value, ADVICE)


def color(value: str) -> str:
    return level(value, COLORS)


def outlook(value: str) -> str:
    return f"COALESCE({level(value, SENTENCES)}, {_text(NO_SENTENCE)})"


ALERTS = ", ".join(map(_text, CATEGORIES[2:]))
SEVERITY = "CASE {0} " + " ".join(
    f"WHEN {_text(name)} THEN {i}" for i, name in enumerate(CATEGORIES)
) + " ELSE 999 END"

BASE = f"""
WITH ev AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS r
  FROM events),
med AS (
  SELECT event_id AS id_monitoreo, ts AS fecha_hora, user_id AS id_estacion, value AS mp25,
         value + r AS mp10, r / 2 AS so2, r AS no2, r / 10 AS velocidad_viento,
         r * CAST(3.6 AS DOUBLE) AS direccion_viento_grados, 30 - r / 4 AS temperatura,
         r AS humedad
  FROM ev),
com AS (
  SELECT CAST(n_nationkey AS BIGINT) AS id_comuna, n_name AS nombre, r_name AS region,
         CAST(100000 + 1000 * n_nationkey AS BIGINT) AS poblacion_estimada,
         CAST(50 + n_nationkey AS DOUBLE) AS indice_vulnerabilidad_respiratoria
  FROM nation JOIN region ON n_regionkey = r_regionkey),
est AS (
  SELECT c_custkey AS id_estacion, c_name AS codigo_unico, c_mktsegment AS tipo,
         CAST(-30 - c_custkey % 10 AS DOUBLE) AS latitud,
         CAST(-70 - c_custkey % 5 AS DOUBLE) AS longitud,
         CAST(c_nationkey AS BIGINT) AS id_comuna
  FROM customer),
ind AS (
  SELECT s_suppkey AS id_industria, s_name AS nombre, s_acctbal AS emision_maxima_permitida,
         CAST(s_nationkey AS BIGINT) AS id_comuna
  FROM supplier),
lugar AS (SELECT est.*, com.nombre AS comuna, region, poblacion_estimada,
                 indice_vulnerabilidad_respiratoria
          FROM est JOIN com USING (id_comuna)),
full_med AS (SELECT * FROM med JOIN lugar USING (id_estacion)),
ds AS (
  SELECT id_monitoreo, fecha_hora, comuna, region, codigo_unico AS codigo_estacion,
         tipo AS tipo_sensor, {', '.join(POLLUTANTS + WEATHER)},
         indice_vulnerabilidad_respiratoria, e.emision_maxima_permitida,
         {category('mp25')} AS categoria_ica
  FROM full_med LEFT JOIN (
    SELECT id_comuna, MAX(emision_maxima_permitida) AS emision_maxima_permitida
    FROM ind GROUP BY id_comuna) e USING (id_comuna)),
serie AS (
  SELECT *, LEAD(mp25, 4) OVER w AS mp25_24h_estacion,
         LAG(mp25, 1) OVER w AS lag_1, LAG(mp25, 2) OVER w AS lag_2, LAG(mp25, 3) OVER w AS lag_3,
         AVG(mp25) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS media_3,
         AVG(mp25) OVER (w ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) AS media_6,
         AVG(mp25) OVER (w ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING) AS media_12,
         ROW_NUMBER() OVER (PARTITION BY codigo_estacion
                            ORDER BY fecha_hora DESC, id_monitoreo DESC) AS desde_ultima
  FROM ds WINDOW w AS (PARTITION BY codigo_estacion ORDER BY fecha_hora, id_monitoreo)),
por_comuna AS (
  SELECT comuna, fecha_hora,
         LEAD(AVG(mp25), 4) OVER (PARTITION BY comuna ORDER BY fecha_hora) AS mp25_24h_comuna
  FROM ds GROUP BY comuna, fecha_hora),
objetivo AS (
  SELECT serie.*, mp25_24h_comuna, COALESCE(mp25_24h_estacion, mp25_24h_comuna) AS mp25_24h,
         fecha_hora + INTERVAL 24 HOUR AS fecha_hora_objetivo,
         {rnd('COALESCE(media_3, mp25)', 2)} AS predicho
  FROM serie JOIN por_comuna USING (comuna, fecha_hora)),
evaluacion AS (
  SELECT *, mp25_24h - predicho AS error FROM objetivo WHERE mp25_24h IS NOT NULL),
pronostico AS (
  SELECT *, {category('predicho')} AS categoria FROM objetivo WHERE desde_ultima = 1),
orden AS (
  SELECT id_monitoreo, fecha_hora,
         ROW_NUMBER() OVER (ORDER BY fecha_hora, codigo_estacion, id_monitoreo) - 1 AS posicion,
         COUNT(*) OVER () AS n
  FROM ds),
nivel AS (
  SELECT *, CASE WHEN mp25 < 50 THEN 2 WHEN mp25 < 110 THEN 0 ELSE 1 END AS cluster FROM ds),
perfil AS (
  SELECT cluster, COUNT(*) AS cantidad_registros,
         {', '.join(f'AVG({c}) AS {c}' for c in RISK_WEIGHTS)}
  FROM nivel GROUP BY cluster),
puntaje AS (
  SELECT *, ({' + '.join(
      f"{w} * " + (f"(1 - COALESCE(({c} - MIN({c}) OVER ()) / NULLIF(MAX({c}) OVER () - MIN({c}) OVER (), 0), 0))"
                   if c == 'velocidad_viento' else
                   f"COALESCE(({c} - MIN({c}) OVER ()) / NULLIF(MAX({c}) OVER () - MIN({c}) OVER (), 0), 0)")
      for c, w in RISK_WEIGHTS.items())}) / {sum(RISK_WEIGHTS.values())!r} AS puntaje_riesgo
  FROM perfil),
etiqueta AS (
  SELECT *, list_value('Bajo riesgo', 'Riesgo moderado', 'Riesgo crítico')[
      ROW_NUMBER() OVER (ORDER BY puntaje_riesgo, cluster)] AS nivel_riesgo
  FROM puntaje),
copias AS (
  SELECT *, 0 AS copia FROM ev UNION ALL SELECT *, 1 AS copia FROM ev WHERE event_id % 97 = 0),
falla AS (
  SELECT event_id * 2 + copia AS _seq, CASE WHEN k <> 13 THEN ts END AS fecha_hora,
         CASE WHEN k = 5 THEN '   ' ELSE codigo_unico END AS codigo_estacion,
         CASE WHEN k <> 6 THEN comuna END AS comuna,
         CASE WHEN k = 10 THEN '' ELSE region END AS region,
         CASE WHEN k = 7 THEN -value WHEN k <> 8 THEN value END AS mp25,
         value + r AS mp10, r / 2 AS so2, CASE WHEN k <> 9 THEN r END AS no2,
         CASE WHEN k = 96 THEN -1.0 WHEN k <> 95 THEN r / 10 END AS velocidad_viento,
         CASE WHEN k = 98 THEN 372.0 ELSE r * CAST(3.6 AS DOUBLE) END AS direccion_viento_grados,
         CASE WHEN k = 97 THEN 61.5 ELSE 30 - r / 4 END AS temperatura,
         CASE WHEN k = 99 THEN 104.0 ELSE r END AS humedad,
         CASE WHEN k = 11 THEN 'sensor_privado' WHEN event_type IN ('click', 'view')
              THEN 'oficial' ELSE 'comunitaria' END AS fuente_dato
  FROM copias JOIN lugar ON user_id = id_estacion),
marcada AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY codigo_estacion, fecha_hora ORDER BY _seq) AS vez
  FROM falla),
revisada AS (
  SELECT *, concat_ws('; ',
      CASE WHEN fecha_hora IS NULL THEN 'fecha_hora nula' END,
      CASE WHEN TRIM(COALESCE(codigo_estacion, '')) = '' THEN 'codigo_estacion vacio' END,
      CASE WHEN TRIM(COALESCE(comuna, '')) = '' THEN 'comuna vacia' END,
      CASE WHEN TRIM(COALESCE(region, '')) = '' THEN 'region vacia' END,
      {', '.join(f"CASE WHEN {c} IS NULL THEN '{c} faltante' WHEN {c} < 0 THEN '{c} negativo' END"
                 for c in POLLUTANTS)},
      CASE WHEN velocidad_viento < 0 THEN 'velocidad_viento negativa' END,
      CASE WHEN direccion_viento_grados NOT BETWEEN 0 AND 360
           THEN 'direccion_viento_grados fuera de rango' END,
      CASE WHEN temperatura NOT BETWEEN -50 AND 60 THEN 'temperatura fuera de rango' END,
      CASE WHEN humedad NOT BETWEEN 0 AND 100 THEN 'humedad fuera de rango' END,
      CASE WHEN fuente_dato NOT IN ('oficial', 'comunitaria') THEN 'fuente_dato invalida' END,
      CASE WHEN vez > 1 THEN 'duplicado codigo_estacion+fecha_hora' END
    ) AS motivo_error
  FROM marcada),
catalogo AS (
  SELECT s_suppkey AS id_estacion, s_name AS codigo_unico, nombre AS comuna,
         CASE s_suppkey % 20 WHEN 0 THEN 'publico_oficial' WHEN 1 THEN 'sensor_comunitario_ong'
              ELSE 'otro' END AS tipo
  FROM supplier JOIN com ON s_nationkey = id_comuna),
pendiente AS (
  SELECT event_id AS _seq, ts AS fecha_hora, comuna, region, k,
         CASE k % 4 WHEN 0 THEN 'Supplier#' || lpad(CAST(user_id AS VARCHAR), 9, '0')
              WHEN 1 THEN 'MAN-' || user_id WHEN 2 THEN 'OF-' || user_id
              ELSE 'X-ONG-' || user_id END AS codigo,
         CASE k % 4 WHEN 1 THEN 'Supplier#' || lpad(CAST(user_id AS VARCHAR), 9, '0') END AS destino,
         CASE k % 4 WHEN 2 THEN 'publico_oficial' WHEN 3 THEN 'sensor_comunitario_ong' END AS tipo,
         {', '.join(f'med.{c}' for c in [*POLLUTANTS, *WEATHER[:-1]])},
         CASE WHEN k % 10 <> 3 THEN med.humedad END AS humedad
  FROM ev JOIN lugar ON user_id = id_estacion JOIN med ON id_monitoreo = event_id),
resuelta AS (
  SELECT p.*, COALESCE(x.id_estacion, m.id_estacion, CASE WHEN c.n = 1 THEN c.id END) AS id_final,
         CASE WHEN x.id_estacion IS NOT NULL THEN p.codigo WHEN destino IS NOT NULL THEN destino
              WHEN c.n = 1 THEN c.cod END AS codigo_unico_api,
         CASE WHEN x.id_estacion IS NOT NULL THEN 'exacto_api'
              WHEN destino IS NOT NULL THEN 'mapeo_manual_csv'
              WHEN p.tipo IS NOT NULL THEN 'heuristico_seguro' ELSE 'sin_mapeo' END AS modo_mapeo,
         CASE WHEN x.id_estacion IS NOT NULL THEN NULL
              WHEN destino IS NOT NULL THEN
                CASE WHEN m.id_estacion IS NULL THEN 'codigo_api_no_disponible' END
              WHEN c.n = 1 THEN NULL WHEN c.n > 1 THEN 'estacion_ambigua'
              ELSE 'estacion_no_encontrada' END AS motivo_omision
  FROM pendiente p
  LEFT JOIN catalogo x ON x.codigo_unico = p.codigo
  LEFT JOIN catalogo m ON m.codigo_unico = p.destino
  LEFT JOIN (SELECT comuna, tipo, COUNT(*) AS n, MIN(id_estacion) AS id, MIN(codigo_unico) AS cod
             FROM catalogo GROUP BY comuna, tipo) c ON c.comuna = p.comuna AND c.tipo = p.tipo),
carga AS (
  SELECT *, COALESCE(motivo_omision, CASE WHEN humedad IS NULL THEN 'clima_requerido_por_api' END)
            AS motivo
  FROM resuelta),
lote AS (
  SELECT event_id * 2 + copia AS indice,
         CASE WHEN k >= 50 THEN ts + INTERVAL 400 DAY ELSE ts END AS fecha_hora,
         CASE WHEN k = 60 THEN user_id + 1000000000 ELSE user_id END AS id_estacion,
         CASE WHEN k = 7 THEN -value WHEN k <> 8 THEN value END AS mp25,
         CASE WHEN k = 70 AND copia = 0 THEN NULL ELSE r / 2 END AS so2,
         CASE WHEN k = 99 THEN 104.0 ELSE r END AS humedad
  FROM copias),
lote_campos AS (
  SELECT *, concat_ws('; ',
      CASE WHEN mp25 IS NULL THEN 'mp25: Field required'
           WHEN mp25 < 0 THEN 'mp25: Input should be greater than or equal to 0' END,
      CASE WHEN so2 IS NULL THEN 'so2: Field required' END,
      CASE WHEN humedad > 100 THEN 'humedad: Input should be less than or equal to 100' END
    ) AS error,
    id_estacion IN (SELECT c_custkey FROM customer) AS conocida,
    EXISTS (SELECT 1 FROM events e WHERE e.user_id = id_estacion AND e.ts = fecha_hora) AS guardada
  FROM lote),
lote_turno AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY id_estacion, fecha_hora, error = '' AND conocida
                               ORDER BY indice) AS turno
  FROM lote_campos),
lote_final AS (
  SELECT *, CASE WHEN error <> '' THEN error
                 WHEN NOT conocida THEN 'No existe estacion con id_estacion=' || id_estacion
                 WHEN guardada OR turno > 1 THEN {_text(DUPLICATE_REASON)} END AS motivo
  FROM lote_turno)
"""


def oracle(name: str, sql: str, base: bool = True) -> None:
    ORACLES[name] = (BASE + sql) if base else sql


FILTER = """fecha_hora >= TIMESTAMP '2024-01-03 00:00:00'
  AND fecha_hora <= TIMESTAMP '2024-01-20 12:00:00' AND mp25 >= 5 AND mp25 <= 150
  AND region = 'ASIA' AND LOWER(comuna) LIKE '%nation_1%'"""

# --- dimensions and mapping ---
oracle("dim_stations", "SELECT * FROM est")
oracle("dim_lookup", "SELECT * FROM com WHERE id_comuna = 7")
oracle("mapping_duplicates", """
SELECT c_mktsegment || '-' || c_nationkey AS codigo_estacion_raw, COUNT(*) AS apariciones
FROM customer GROUP BY 1 HAVING COUNT(*) > 1""", base=False)

# --- scalar cleaning ---
_COMUNA = _choice(COMUNA_SPELLINGS, "k")
_REGION = _choice(REGION_SPELLINGS, "k")
_CLEAN = "NULLIF(TRIM(regexp_replace({0}, '\\s+', ' ', 'g')), '')"
_COMUNA_NAME = f"""CASE LOWER({_CLEAN.format(_COMUNA)})
  WHEN 'talca' THEN 'Talca' WHEN 'curico' THEN 'Curicó' WHEN 'curicó' THEN 'Curicó'
  WHEN 'chillán' THEN 'Chillán' WHEN 'concepcion' THEN 'Concepción'
  WHEN 'san fernando' THEN 'San Fernando' WHEN 'hualpen' THEN 'Hualpén'
  WHEN 'rancagua' THEN 'Rancagua' WHEN 'coronel' THEN 'Coronel'
  WHEN 'san carlos' THEN 'San Carlos' ELSE {_CLEAN.format(_COMUNA)} END"""
_REGION_NAME = f"""CASE LOWER({_CLEAN.format(_REGION)})
  WHEN 'bio bio' THEN 'Biobío' WHEN 'biobio' THEN 'Biobío' WHEN 'biobío' THEN 'Biobío'
  WHEN 'nuble' THEN 'Ñuble' WHEN 'ñuble' THEN 'Ñuble' WHEN 'ohiggins' THEN 'O''Higgins'
  WHEN 'o higgins' THEN 'O''Higgins' WHEN 'o''higgins' THEN 'O''Higgins'
  WHEN 'maule' THEN 'Maule' ELSE {_CLEAN.format(_REGION)} END"""
_MP25 = "CASE WHEN k NOT IN (1, 2, 3, 4) THEN value END"
_NO2 = "CASE WHEN k <> 5 THEN r END"
_WHEN = "CASE WHEN event_id % 3 = 0 THEN date_trunc('second', ts) ELSE date_trunc('minute', ts) END"
# Year-day-month reading of a year-first date, when the day can be a month.
_SWAPPED = f"""CASE WHEN event_id % 3 <> 1 AND day(ts) <= 12 THEN
  make_timestamp(year(ts), day(ts), month(ts), 0, 0, 0)
  + ({_WHEN} - date_trunc('day', ts)) ELSE {_WHEN} END"""
oracle("norm_text", f"SELECT event_id AS _seq, {_CLEAN.format(_COMUNA)} AS texto FROM ev")
oracle("norm_region", f"SELECT event_id AS _seq, {_REGION_NAME} AS region FROM ev")
oracle("norm_comuna", f"SELECT event_id AS _seq, {_COMUNA_NAME} AS comuna FROM ev")
oracle("parse_number", f"SELECT event_id AS _seq, {_MP25} AS mp25, {_NO2} AS no2 FROM ev")
oracle("parse_date", f"SELECT event_id AS _seq, {_WHEN} AS iso, {_SWAPPED} AS heredada FROM ev")
oracle("parse_date_formats", """
SELECT event_id AS _seq, CASE WHEN event_id % 7 IN (2, 3, 6) THEN date_trunc('day', ts)
  WHEN event_id % 7 = 5 THEN date_trunc('second', ts)
  ELSE date_trunc('minute', ts) END::TIMESTAMP AS fecha FROM ev""")
oracle("repair_mojibake", f"""
SELECT event_id AS _seq, {_COMUNA_NAME} AS original, {_COMUNA_NAME} AS reparado FROM ev""")
oracle("prepare_measurements", f"""
SELECT event_id AS _seq, {_WHEN} AS fecha_hora, 'SEN-' || user_id AS codigo_estacion,
       {_COMUNA_NAME} AS comuna, {_REGION_NAME} AS region, {_MP25} AS mp25, value + k AS mp10,
       r AS so2, {_NO2} AS no2, fuente_dato
FROM ev, (VALUES ('oficial'), ('comunitaria')) AS f(fuente_dato)""")
_SOURCE = "CASE k % 5 WHEN 0 THEN 'oficial' WHEN 1 THEN 'ong' WHEN 2 THEN 'comunitaria' END"
_LENIENT = f"""CASE WHEN {_SOURCE} = 'ong' OR k % 7 IN (3, 4, 5) THEN 'sensor_comunitario_ong'
  WHEN {_SOURCE} = 'oficial' OR k % 7 IN (0, 1) THEN 'publico_oficial'
  ELSE 'sensor_desconocido' END"""
oracle("sensor_type_strict", """
SELECT event_id, CASE WHEN k % 7 IN (0, 1, 2) THEN 'publico_oficial'
                      WHEN k % 7 IN (3, 4) THEN 'sensor_comunitario_ong' END AS tipo_sensor
FROM ev""")
oracle("sensor_type_lenient", f"SELECT event_id, {_LENIENT} AS tipo_sensor FROM ev")
oracle("fill_context", f"""
SELECT event_id, {_LENIENT} AS tipo_sensor,
       CAST(50 AS DOUBLE) AS indice_vulnerabilidad_respiratoria,
       CASE WHEN k % 3 = 0 THEN value ELSE 200.0 END AS emision_maxima_permitida
FROM ev""")
oracle("classify_ica", f"""
SELECT id_monitoreo, {category('mp25')} AS categoria, {advice('mp25')} AS mensaje_ciudadano,
       {color('mp25')} AS color_referencial FROM med""")
oracle("citizen_outlook", f"""
SELECT id_monitoreo, {outlook('v')} AS mensaje
FROM (SELECT id_monitoreo, CASE WHEN humedad > 3 THEN mp25 END AS v FROM med)""")
oracle("season_mean", f"""
SELECT CASE WHEN month(o_orderdate) IN (12, 1, 2) THEN 'verano'
            WHEN month(o_orderdate) <= 5 THEN 'otono'
            WHEN month(o_orderdate) <= 8 THEN 'invierno' ELSE 'primavera' END AS estacion_del_ano,
       COUNT(*) AS cantidad, {rnd('AVG(o_totalprice)', 2)} AS promedio
FROM orders GROUP BY 1""", base=False)
oracle("calendar_parts", """
SELECT id_monitoreo, CAST(fecha_hora AS DATE) AS fecha, CAST(year(fecha_hora) AS INTEGER) AS anio,
       CAST(month(fecha_hora) AS INTEGER) AS mes, CAST(day(fecha_hora) AS INTEGER) AS dia,
       CAST(hour(fecha_hora) AS INTEGER) AS hora, dayname(fecha_hora) AS dia_semana,
       CAST(isodow(fecha_hora) - 1 AS INTEGER) AS dia_semana_numero FROM med""")
oracle("wind_circular", f"""
SELECT id_monitoreo, {rnd('SIN(radians(direccion_viento_grados))')} AS direccion_viento_sin,
       {rnd('COS(radians(direccion_viento_grados))')} AS direccion_viento_cos FROM med""")

# --- filters and pages ---
_DETAIL = ", ".join(DETAIL_COLUMNS)
_MODELING = ", ".join(["id_monitoreo", *MODELING_COLUMNS])
oracle("filter_measurements", f"SELECT {_DETAIL} FROM full_med WHERE {FILTER}")
oracle("view_filters", f"""
SELECT {_MODELING} FROM ds
WHERE region IN ('ASIA', 'EUROPE') AND tipo_sensor IN ('BUILDING', 'MACHINERY')
  AND fecha_hora >= TIMESTAMP '2024-01-05' AND fecha_hora <= TIMESTAMP '2024-01-09 23:59:59'""")
oracle("filter_options", f"""
SELECT DISTINCT 'region' AS filtro, region AS valor, CAST(0 AS BIGINT) AS prioridad FROM ds
UNION ALL SELECT DISTINCT 'comuna', comuna, 0 FROM ds
UNION ALL SELECT DISTINCT 'tipo_sensor', tipo_sensor, 0 FROM ds
UNION ALL SELECT DISTINCT 'categoria_alerta', categoria,
          CAST({SEVERITY.format('categoria')} AS BIGINT) FROM pronostico""")
oracle("measurement_page", f"""
SELECT {_DETAIL} FROM full_med ORDER BY fecha_hora DESC, id_monitoreo DESC LIMIT 100 OFFSET 50""")
oracle("measurement_by_id", f"SELECT {_DETAIL} FROM full_med WHERE id_monitoreo = 77")

# --- joins ---
oracle("weather_join", f"""
, clima AS (
  SELECT comuna, region, date_trunc('hour', ts) + INTERVAL 1 HOUR AS hora,
         SUM(k) / COUNT(k) AS m
  FROM ev JOIN lugar ON user_id = id_estacion GROUP BY 1, 2, 3)
SELECT event_id AS _seq, ts AS fecha_hora, codigo_unico AS codigo_estacion, l.comuna, l.region,
       value AS mp25, value + r AS mp10, r / 2 AS so2, r AS no2,
       {rnd('m / 10')} AS velocidad_viento,
       {rnd('m * CAST(3.6 AS DOUBLE)')} AS direccion_viento_grados,
       {rnd('30 - m / 4')} AS temperatura, {rnd('m')} AS humedad,
       CASE WHEN event_type IN ('click', 'view') THEN 'oficial' ELSE 'comunitaria' END
         AS fuente_dato
FROM ev JOIN lugar l ON user_id = id_estacion
LEFT JOIN clima c ON c.comuna = l.comuna AND c.region = l.region
                 AND c.hora = date_trunc('hour', ts)""")
oracle("star_join", """
SELECT id_monitoreo, fecha_hora, id_estacion, codigo_unico, comuna, region, mp25 FROM full_med""")
oracle("modeling_dataset", f"SELECT {_MODELING} FROM ds")
oracle("resolve_stations", """
SELECT _seq, id_final AS id_estacion, codigo_unico_api, modo_mapeo, motivo_omision FROM resuelta""")
oracle("new_measurements", """
SELECT indice, id_estacion, fecha_hora FROM lote_campos WHERE NOT guardada""")
oracle("existing_measurements", """
SELECT indice, id_estacion, fecha_hora, 'medicion_ya_existente' AS motivo_omision
FROM lote_campos WHERE guardada""")
oracle("region_coverage", """
SELECT region, COUNT(DISTINCT com.id_comuna) AS comunas, COUNT(DISTINCT id_estacion) AS sensores
FROM com LEFT JOIN est USING (id_comuna) GROUP BY region""")
oracle("missing_slots", """
, franjas AS (SELECT DISTINCT id_estacion,
    time_bucket(INTERVAL 6 HOUR, fecha_hora, TIMESTAMP '2000-01-01') AS franja FROM med),
calendario AS (SELECT UNNEST(generate_series(MIN(franja), MAX(franja), INTERVAL 6 HOUR)) AS franja
               FROM franjas),
faltan AS (SELECT id_estacion, franja FROM est CROSS JOIN calendario
           EXCEPT SELECT id_estacion, franja FROM franjas),
islas AS (SELECT *, franja - ROW_NUMBER() OVER (PARTITION BY id_estacion ORDER BY franja)
                    * INTERVAL 6 HOUR AS isla FROM faltan)
SELECT id_estacion, MIN(franja) AS desde, MAX(franja) AS hasta, COUNT(*) AS franjas
FROM islas GROUP BY id_estacion, isla""")

# --- rollups ---
oracle("general_summary", f"""
SELECT (SELECT COUNT(*) FROM com) AS total_comunas, (SELECT COUNT(*) FROM est) AS total_estaciones,
       (SELECT COUNT(*) FROM ind) AS total_industrias, COUNT(*) AS total_mediciones,
       COALESCE({rnd('AVG(mp25)', 2)}, 0) AS mp25_promedio,
       COALESCE({rnd('MAX(mp25)', 2)}, 0) AS mp25_maximo,
       (SELECT comuna FROM full_med GROUP BY id_comuna, comuna
        ORDER BY AVG(mp25) DESC, comuna LIMIT 1) AS comuna_mas_critica
FROM med""")
_BY_COMUNA = f"""
SELECT comuna, region, {rnd('AVG(mp25)', 2)} AS mp25_promedio, COUNT(*) AS cantidad_mediciones
FROM full_med {{where}} GROUP BY id_comuna, comuna, region"""
oracle("mp25_by_comuna", _BY_COMUNA.format(where=""))
oracle("mp25_by_comuna_filtered", _BY_COMUNA.format(where=f"WHERE {FILTER}"))
oracle("critical_comunas", f"""
SELECT comuna, region, m AS mp25_promedio, x AS mp25_maximo, {category('m')} AS categoria
FROM (SELECT comuna, region, {rnd('AVG(mp25)', 2)} AS m, {rnd('MAX(mp25)', 2)} AS x
      FROM full_med GROUP BY id_comuna, comuna, region
      ORDER BY AVG(mp25) DESC, MAX(mp25) DESC, comuna LIMIT 10)""")
oracle("daily_evolution", f"""
SELECT CAST(fecha_hora AS DATE) AS fecha, comuna, {rnd('AVG(mp25)', 2)} AS mp25_promedio
FROM full_med GROUP BY 1, id_comuna, comuna""")
oracle("ica_by_comuna", f"""
SELECT comuna, region, m AS mp25_promedio, {category('m')} AS categoria,
       {advice('m')} AS mensaje_ciudadano, {color('m')} AS color_referencial
FROM (SELECT comuna, region, {rnd('AVG(mp25)', 2)} AS m FROM full_med
      GROUP BY id_comuna, comuna, region)""")
oracle("sensor_ranking", f"""
SELECT id_estacion, codigo_unico AS codigo_estacion, tipo AS tipo_sensor, comuna,
       {rnd('AVG(mp25)', 2)} AS mp25_promedio, COUNT(*) AS cantidad_mediciones
FROM full_med GROUP BY id_estacion, codigo_unico, tipo, comuna
ORDER BY AVG(mp25) DESC, COUNT(*) DESC, id_estacion LIMIT 20""")


def _rank(keys: str) -> str:
    return f"""
SELECT {keys}, {rnd('AVG(mp25)')} AS mp25_promedio, MAX(mp25) AS mp25_maximo,
       COUNT(mp25) AS cantidad_mediciones
FROM (SELECT *, CAST(fecha_hora AS DATE) AS fecha FROM full_med) GROUP BY {keys}"""


oracle("rank_comuna", _rank("comuna, region"))
oracle("rank_region", _rank("region"))
oracle("critical_days", _rank("fecha"))
oracle("rank_station", _rank("codigo_unico, comuna, tipo"))
oracle("station_daily", f"""
SELECT CAST(fecha_hora AS DATE) AS fecha, id_estacion, {rnd('AVG(mp25)')} AS promedio_diario_mp25,
       MAX(mp25) AS maximo_diario_mp25 FROM med GROUP BY 1, 2""")
oracle("icap_distribution", """
SELECT CASE WHEN mp25 >= 170 OR mp10 >= 330 THEN 'Emergencia'
            WHEN mp25 >= 110 OR mp10 >= 230 THEN 'Preemergencia'
            WHEN mp25 >= 80 OR mp10 >= 180 THEN 'Alerta'
            WHEN mp25 >= 50 OR mp10 >= 130 THEN 'Regular' ELSE 'Buena' END AS categoria_icap,
       COUNT(*) AS cantidad_registros FROM med GROUP BY 1""")
oracle("coverage", """
SELECT COUNT(*) AS filas, MIN(fecha_hora) AS fecha_minima, MAX(fecha_hora) AS fecha_maxima,
       COUNT(DISTINCT region) AS regiones, COUNT(DISTINCT id_comuna) AS comunas,
       COUNT(DISTINCT id_estacion) AS estaciones FROM full_med""")
oracle("episode_counts", f"""
, dias AS (SELECT comuna, region, CAST(fecha_hora AS DATE) AS d, COUNT(*) AS n,
                  COUNT(*) FILTER (WHERE mp25 >= 80) AS c, AVG(velocidad_viento) AS v
           FROM full_med GROUP BY 1, 2, 3)
SELECT comuna, region, CAST(SUM(n) AS BIGINT) AS mediciones,
       CAST(SUM(c) AS BIGINT) AS episodios_criticos,
       {rnd('SUM(c) * CAST(100 AS DOUBLE) / SUM(n)', 2)} AS porcentaje_critico,
       COUNT(*) FILTER (WHERE ROUND(v, 9) < 4.5) AS dias_baja_ventilacion
FROM dias GROUP BY comuna, region""")
oracle("norm_exceedance", """
, dias AS (SELECT AVG(mp25) AS mp25, AVG(mp10) AS mp10, AVG(so2) AS so2, AVG(no2) AS no2
           FROM med GROUP BY id_estacion, CAST(fecha_hora AS DATE)),
pares AS (SELECT 'mp25' AS c, CAST(50 AS DOUBLE) AS n, mp25 AS v FROM dias
          UNION ALL SELECT 'mp10', 130, mp10 FROM dias UNION ALL SELECT 'so2', 150, so2 FROM dias
          UNION ALL SELECT 'no2', 100, no2 FROM dias)
SELECT c AS contaminante, n AS norma_24h, COUNT(v) AS dias_estacion,
       COUNT(*) FILTER (WHERE ROUND(v, 9) > n) AS excedencias FROM pares GROUP BY c, n""")
oracle("critical_share", f"""
SELECT region, comuna, COUNT(mp25) AS cantidad_mediciones, {rnd('AVG(mp25)')} AS mp25_promedio,
       MAX(mp25) AS mp25_maximo,
       {rnd("COUNT(*) FILTER (WHERE categoria_ica = 'Emergencia') * CAST(100 AS DOUBLE) / COUNT(*)", 2)}
         AS porcentaje_critico
FROM ds GROUP BY region, comuna""")

# --- statistics ---
oracle("category_counts", """
SELECT categoria_ica, COUNT(*) AS cantidad FROM ds GROUP BY 1""")
oracle("describe_stats", "\nUNION ALL ".join(
    f"""SELECT '{c}' AS variable, COUNT({c}) AS count, {rnd(f'AVG({c})')} AS mean,
       {rnd(f'stddev_samp({c})')} AS std, CAST(MIN({c}) AS DOUBLE) AS min,
       {', '.join(f"{rnd(f'quantile_cont({c}, {p})')} AS {q}" for q, p in
                  (('q25', 0.25), ('q50', 0.5), ('q75', 0.75)))},
       CAST(MAX({c}) AS DOUBLE) AS max FROM ds""" for c in DESCRIBE_COLUMNS))
oracle("bulk_quantiles", "\nUNION ALL ".join(
    f"SELECT '{c}' AS variable, CAST({p} AS DOUBLE) AS p, "
    f"{rnd(f'quantile_cont({c}, {p})')} AS cuantil FROM lineitem"
    for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax") for p in (0.05, 0.5, 0.95)
), base=False)
_TYPES = {"fecha_hora": "timestamp_ntz", **{c: "string" for c in (
    "codigo_estacion", "comuna", "region", "fuente_dato")}}
oracle("quality_summary", "\nUNION ALL ".join(
    f"""SELECT '{c}' AS columna, '{_TYPES.get(c, 'double')}' AS tipo,
       COUNT(*) FILTER (WHERE {c} IS NULL) AS nulos,
       {rnd(f'COUNT(*) FILTER (WHERE {c} IS NULL) * CAST(100 AS DOUBLE) / COUNT(*)', 2)}
         AS porcentaje_nulos, COUNT(DISTINCT {c}) AS valores_unicos FROM falla"""
    for c in ["fecha_hora", "codigo_estacion", "comuna", "region", *POLLUTANTS, *WEATHER,
              "fuente_dato"]))
oracle("correlation_matrix", "\nUNION ALL ".join(
    f"SELECT '{x}' AS variable_x, '{y}' AS variable_y, {rnd(f'corr({x}, {y})')} AS correlacion FROM ds"
    for i, x in enumerate(CORRELATION_COLUMNS) for y in CORRELATION_COLUMNS[i:]))
oracle("linear_trend", f"""
SELECT COUNT(*) AS filas, {rnd('regr_slope(mp25, humedad)')} AS pendiente,
       {rnd('regr_intercept(mp25, humedad)')} AS intercepto,
       MIN(humedad) AS x_minimo, MAX(humedad) AS x_maximo FROM ds""")
oracle("resample_mean", f"""
SELECT CAST(date_trunc('day', fecha_hora) AS TIMESTAMP) AS fecha_hora, {rnd('AVG(mp25)')} AS mp25
FROM ds GROUP BY 1""")
oracle("top_comunas", f"""
SELECT comuna, {rnd('AVG(mp25)')} AS mp25_promedio FROM ds GROUP BY comuna
ORDER BY AVG(mp25) DESC, comuna LIMIT 15""")
oracle("error_histogram", f"""
, e AS (SELECT ABS(error) AS x FROM evaluacion),
s AS (SELECT MIN(x) AS a, MAX(x) AS b, (MAX(x) - MIN(x)) / 30 AS w FROM e),
t AS (SELECT CAST(LEAST(FLOOR((x - a) / w), 29) AS INTEGER) AS tramo FROM e, s)
SELECT tramo, COUNT(*) AS cantidad, {rnd('MIN(a) + tramo * MIN(w)')} AS desde,
       {rnd('MIN(a) + (tramo + 1) * MIN(w)')} AS hasta
FROM t, s GROUP BY tramo""")
oracle("modal_label", """
SELECT cluster, etiqueta FROM (
  SELECT cluster, tipo_sensor AS etiqueta,
         ROW_NUMBER() OVER (PARTITION BY cluster ORDER BY COUNT(*) DESC, tipo_sensor) AS i
  FROM nivel GROUP BY cluster, tipo_sensor) WHERE i = 1""")

# --- windows and features ---
oracle("duplicate_flag", "SELECT _seq, vez > 1 AS duplicado FROM marcada")
oracle("dedupe_first", """
SELECT _seq, codigo_estacion, fecha_hora FROM marcada WHERE vez = 1""")
oracle("target_24h", """
SELECT id_monitoreo, mp25_24h_estacion, mp25_24h_comuna, mp25_24h, fecha_hora_objetivo
FROM objetivo""")
oracle("lag_features", f"""
SELECT id_monitoreo, lag_1, lag_2, lag_3, {rnd('mp25 - lag_1')} AS delta_mp25 FROM serie""")
oracle("rolling_features", f"""
SELECT id_monitoreo, {rnd('media_3')} AS mp25_promedio_movil_3, {rnd('media_6')} AS rolling_mean_6,
       {rnd('media_12')} AS rolling_mean_12 FROM serie""")
oracle("latest_per_station", """
SELECT codigo_estacion, id_monitoreo, fecha_hora, mp25 FROM serie WHERE desde_ultima = 1""")
_CUT = "CAST(FLOOR(n * CAST(0.8 AS DOUBLE)) AS BIGINT)"
oracle("global_rank", "SELECT id_monitoreo, posicion FROM orden")
oracle("temporal_split", f"""
SELECT id_monitoreo, CASE WHEN posicion < {_CUT} THEN 'train' ELSE 'test' END AS conjunto
FROM orden""")
oracle("split_summary", f"""
SELECT CASE WHEN posicion < {_CUT} THEN 'train' ELSE 'test' END AS dataset, COUNT(*) AS filas,
       MIN(fecha_hora) AS fecha_min, MAX(fecha_hora) AS fecha_max FROM orden GROUP BY 1""")
oracle("cv_folds", """
, f AS (SELECT UNNEST([1, 2, 3]) AS fold),
b AS (SELECT CAST(fold AS INTEGER) AS fold, n - 3 * (n // 4) + (fold - 1) * (n // 4) AS desde,
             n - 3 * (n // 4) + fold * (n // 4) AS hasta
      FROM f, (SELECT MAX(n) AS n FROM orden))
SELECT fold, COUNT(*) FILTER (WHERE posicion < desde) AS filas_train,
       COUNT(*) FILTER (WHERE posicion >= desde AND posicion < hasta) AS filas_valid,
       MIN(fecha_hora) FILTER (WHERE posicion >= desde AND posicion < hasta) AS valid_desde,
       MAX(fecha_hora) FILTER (WHERE posicion >= desde AND posicion < hasta) AS valid_hasta
FROM orden, b GROUP BY fold""")

# --- quality and ingest ---
oracle("validate_valid", """
SELECT _seq, codigo_estacion, fecha_hora, mp25 FROM revisada WHERE motivo_error = ''""")
oracle("validate_errors", """
SELECT _seq, codigo_estacion, fecha_hora, motivo_error, 'validate' AS fase
FROM revisada WHERE motivo_error <> ''""")
oracle("clean_dataset", """
, r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY fecha_hora, TRIM(codigo_estacion)
                                     ORDER BY _seq) AS i FROM falla)
SELECT _seq, fecha_hora, TRIM(codigo_estacion) AS codigo_estacion, TRIM(comuna) AS comuna,
       TRIM(region) AS region, CASE WHEN mp25 >= 0 THEN mp25 END AS mp25, mp10, so2, no2,
       CASE WHEN velocidad_viento >= 0 THEN velocidad_viento END AS velocidad_viento,
       CASE WHEN direccion_viento_grados BETWEEN 0 AND 360 THEN direccion_viento_grados END
         AS direccion_viento_grados,
       CASE WHEN temperatura BETWEEN -50 AND 60 THEN temperatura END AS temperatura,
       CASE WHEN humedad BETWEEN 0 AND 100 THEN humedad END AS humedad, fuente_dato,
       CAST(year(fecha_hora) AS INTEGER) AS anio, CAST(month(fecha_hora) AS INTEGER) AS mes,
       CAST(day(fecha_hora) AS INTEGER) AS dia, CAST(hour(fecha_hora) AS INTEGER) AS hora,
       dayname(fecha_hora) AS dia_semana
FROM r WHERE i = 1""")


def _repeated(table: str, name: str, keys: str, source: str) -> str:
    return (f"SELECT '{table}.{name}' AS regla, CAST(COALESCE(SUM(c - 1), 0) AS BIGINT) AS violaciones "
            f"FROM (SELECT COUNT(*) AS c FROM {source} WHERE {' AND '.join(f'{k} IS NOT NULL' for k in keys.split(', '))} GROUP BY {keys})")


def _check(table: str, name: str, source: str, condition: str) -> str:
    return f"SELECT '{table}.{name}', COUNT(*) FILTER (WHERE {condition}) FROM {source}"


def _orphan(table: str, key: str, source: str, parent: str) -> str:
    return (f"SELECT '{table}.fk_{key}', COUNT(*) FROM {source} "
            f"WHERE {key} NOT IN (SELECT {key} FROM {parent} WHERE {key} IS NOT NULL)")


def _absent(table: str, source: str, columns: str) -> list[str]:
    return [_check(table, f"nn_{c}", source, f"{c} IS NULL") for c in columns.split()]


# The star with faulty copies of some rows.
_FAULTS = """
, fcom AS (SELECT id_comuna, nombre, region, poblacion_estimada, indice_vulnerabilidad_respiratoria FROM com
  UNION ALL SELECT id_comuna + 100, nombre, NULL, -1, 100.5 FROM com WHERE id_comuna % 5 = 0),
fest AS (SELECT id_estacion, codigo_unico, tipo, latitud, longitud, id_comuna FROM est
  UNION ALL SELECT id_estacion, NULL, 'OTRO', 95, longitud,
    CASE WHEN id_estacion % 100 <> 0 THEN id_comuna + 1000 END FROM est WHERE id_estacion % 50 = 0),
find AS (SELECT id_industria, nombre, 'rubro' AS rubro_industrial, emision_maxima_permitida, id_comuna FROM ind
  UNION ALL SELECT NULL, nombre, NULL, -1, id_comuna FROM ind WHERE id_industria % 10 = 0),
fmed AS (SELECT id_monitoreo, fecha_hora, id_estacion, mp25, mp10, so2, no2, velocidad_viento,
    direccion_viento_grados, temperatura, humedad FROM med
  UNION ALL SELECT id_monitoreo, fecha_hora, CASE WHEN id_monitoreo % 200 <> 0 THEN id_estacion END,
    mp25, -0.5, so2, no2, velocidad_viento, direccion_viento_grados, NULL, 101
  FROM med WHERE id_monitoreo % 100 = 0)
"""


oracle("constraint_audit", _FAULTS + "\nUNION ALL ".join([
    _repeated("comunas", "pk", "id_comuna", "fcom"),
    _repeated("comunas", "uk_nombre", "nombre", "fcom"),
    _check("comunas", "poblacion", "fcom", "poblacion_estimada <= 0"),
    _check("comunas", "vulnerabilidad", "fcom",
           "indice_vulnerabilidad_respiratoria NOT BETWEEN 0 AND 100"),
    _check("comunas", "region", "fcom", "region NOT IN ('AFRICA', 'AMERICA', 'ASIA', 'EUROPE')"),
    _repeated("estaciones", "pk", "id_estacion", "fest"),
    _repeated("estaciones", "uk_codigo", "codigo_unico", "fest"),
    _check("estaciones", "latitud", "fest", "latitud NOT BETWEEN -90 AND 90"),
    _check("estaciones", "longitud", "fest", "longitud NOT BETWEEN -180 AND 180"),
    _check("estaciones", "tipo", "fest", "tipo NOT IN ('MACHINERY', 'FURNITURE', 'BUILDING')"),
    _orphan("estaciones", "id_comuna", "fest", "fcom"),
    _repeated("industrias", "pk", "id_industria", "find"),
    _repeated("industrias", "uk_nombre", "nombre", "find"),
    _check("industrias", "emision", "find", "emision_maxima_permitida < 0"),
    _orphan("industrias", "id_comuna", "find", "fcom"),
    _repeated("monitoreo", "pk", "id_monitoreo", "fmed"),
    _repeated("monitoreo", "uk_estacion_fecha", "id_estacion, fecha_hora", "fmed"),
    *[_check("monitoreo", c, "fmed", f"{c} < 0") for c in (*POLLUTANTS, "velocidad_viento")],
    _check("monitoreo", "direccion_viento_grados", "fmed",
           "direccion_viento_grados NOT BETWEEN 0 AND 360"),
    _check("monitoreo", "temperatura", "fmed", "temperatura NOT BETWEEN -50 AND 60"),
    _check("monitoreo", "humedad", "fmed", "humedad NOT BETWEEN 0 AND 100"),
    _orphan("monitoreo", "id_estacion", "fmed", "fest"),
    *_absent("comunas", "fcom", "id_comuna nombre region poblacion_estimada "
             "indice_vulnerabilidad_respiratoria"),
    *_absent("estaciones", "fest", "id_estacion codigo_unico tipo latitud longitud id_comuna"),
    *_absent("industrias", "find", "id_industria nombre rubro_industrial "
             "emision_maxima_permitida id_comuna"),
    *_absent("monitoreo", "fmed", "id_monitoreo fecha_hora id_estacion mp25 mp10 so2 no2 "
             "velocidad_viento direccion_viento_grados temperatura humedad"),
]))
oracle("ingest_accepted", """
SELECT indice, id_estacion, fecha_hora, mp25 FROM lote_final WHERE motivo IS NULL""")
oracle("ingest_rejected", """
SELECT indice, motivo FROM lote_final WHERE motivo IS NOT NULL""")
oracle("ingest_orphans", """
SELECT indice, id_estacion, 'No existe estacion con id_estacion=' || id_estacion AS motivo
FROM lote_campos WHERE NOT conocida""")
oracle("ingest_summary", """
SELECT COUNT(*) FILTER (WHERE motivo IS NULL) AS insertados,
       COUNT(*) FILTER (WHERE motivo IS NOT NULL) AS errores FROM lote_final""")
oracle("load_payload", f"""
SELECT _seq, id_final AS id_estacion, codigo_unico_api, modo_mapeo, {', '.join(POLLUTANTS + WEATHER)}
FROM carga WHERE motivo IS NULL""")
_ISO = ("strftime(fecha_hora, '%Y-%m-%dT%H:%M:%S') || CASE WHEN microsecond(fecha_hora) % 1000000 = 0 "
        "THEN '' ELSE strftime(fecha_hora, '.%f') END")
oracle("payload_json", f"""
SELECT _seq, '{{"fecha_hora":"' || {_ISO} || '","id_estacion":' || id_final
  || {" || ".join(f"',\"{c}\":' || CAST({c} AS VARCHAR)" for c in POLLUTANTS + WEATHER)}
  || '}}' AS medicion
FROM carga WHERE motivo IS NULL""")
oracle("load_omitted", """
SELECT CASE k % 4 WHEN 1 THEN ' ' ELSE '' END || codigo AS codigo_estacion, codigo_unico_api,
       id_final AS id_estacion, comuna, region, 'oficial' AS fuente_dato, fecha_hora,
       motivo AS motivo_omision, modo_mapeo
FROM carga WHERE motivo IS NOT NULL""")
oracle("load_report", f"""
SELECT 'dry-run' AS modo, COUNT(*) FILTER (WHERE motivo IS NULL) AS total_preparadas,
       COUNT(*) FILTER (WHERE motivo IS NULL OR motivo = 'clima_requerido_por_api')
         AS total_con_id_estacion,
       {', '.join(f"COUNT(*) FILTER (WHERE motivo = '{reason}') AS {name}"
                  for name, reason in OMISSION_COUNTS.items())},
       CAST(0 AS BIGINT) AS insertados, CAST(0 AS BIGINT) AS errores,
       'Payload preparado sin envio a API.' AS mensaje,
       'exacto_api>mapeo_manual_csv>heuristico_seguro' AS modo_mapeo, '[]' AS detalle_errores
FROM carga""")
oracle("upsert_absent", """
SELECT MIN(s_suppkey) AS s_suppkey, codigo FROM (
  SELECT s_suppkey, 'Customer#' || lpad(CAST((s_suppkey - s_suppkey % 3) * 20 AS VARCHAR), 9, '0') AS codigo
  FROM supplier) WHERE codigo NOT IN (SELECT c_name FROM customer) GROUP BY codigo""", base=False)

# --- views ---
oracle("prediction_errors", f"""
SELECT fecha_hora AS fecha_hora_base, codigo_estacion, fecha_hora_objetivo, mp25 AS mp25_actual,
       mp25_24h AS mp25_real, predicho AS mp25_predicho, {rnd('error')} AS error,
       {rnd('ABS(error)')} AS error_absoluto, {category('predicho')} AS categoria_predicha,
       {advice('predicho')} AS mensaje_ciudadano, {color('predicho')} AS color_referencial
FROM evaluacion""")
oracle("regression_metrics", f"""
SELECT {rnd('AVG(ABS(error))')} AS mae, {rnd('SQRT(AVG(error * error))')} AS rmse,
       {rnd('1 - AVG(error * error) / var_pop(mp25_24h)')} AS r2 FROM evaluacion""")
oracle("executive_kpis", f"""
SELECT {rnd('AVG(mp25)', 2)} AS mp25_promedio, {rnd('MAX(mp25)', 2)} AS mp25_maximo,
       COUNT(*) AS total_mediciones,
       {rnd(f"COUNT(*) FILTER (WHERE categoria_ica IN ({ALERTS})) * CAST(100 AS DOUBLE) / COUNT(*)", 2)}
         AS porcentaje_alerta,
       (SELECT comuna FROM ds GROUP BY comuna ORDER BY AVG(mp25) DESC, comuna LIMIT 1)
         AS comuna_mas_critica,
       (SELECT {rnd('AVG(predicho)', 2)} FROM pronostico) AS pronostico_promedio,
       (SELECT COUNT(*) FROM pronostico WHERE categoria IN ({ALERTS})) AS alertas_pronosticadas
FROM ds""")
oracle("executive_ranking", f"""
SELECT comuna, region, {rnd('AVG(predicho)')} AS mp25_predicho_24h FROM pronostico
GROUP BY comuna, region ORDER BY AVG(predicho) DESC, comuna LIMIT 12""")
oracle("daily_trend", f"""
SELECT CAST(fecha_hora AS DATE) AS fecha, {rnd('AVG(mp25)')} AS mp25 FROM ds GROUP BY 1""")
oracle("alert_counts", f"""
SELECT categoria, COUNT(*) AS cantidad, CAST({SEVERITY.format('categoria')} AS BIGINT) AS prioridad
FROM pronostico GROUP BY categoria""")
oracle("alert_summary", f"""
SELECT comuna, region, categoria, {rnd('AVG(predicho)')} AS mp25_predicho_24h,
       COUNT(DISTINCT codigo_estacion) AS estaciones
FROM pronostico GROUP BY comuna, region, categoria
ORDER BY AVG(predicho) DESC, comuna, categoria LIMIT 12""")
oracle("citizen_status", f"""
, ultima AS (SELECT comuna, fecha_hora, mp25, ROW_NUMBER() OVER (
    PARTITION BY comuna ORDER BY fecha_hora DESC, codigo_estacion) AS i FROM ds),
meta AS (SELECT comuna, fecha_hora_objetivo, {rnd('AVG(predicho)', 2)} AS v,
                COUNT(DISTINCT codigo_estacion) AS e,
                ROW_NUMBER() OVER (PARTITION BY comuna ORDER BY fecha_hora_objetivo DESC) AS i
         FROM pronostico GROUP BY comuna, fecha_hora_objetivo)
SELECT u.comuna, u.fecha_hora AS fecha_ultima, u.mp25 AS mp25_actual,
       {category('u.mp25')} AS categoria_actual, m.fecha_hora_objetivo, m.v AS mp25_esperado_24h,
       {category('m.v')} AS categoria_esperada, m.e AS estaciones_consideradas,
       {outlook('m.v')} AS mensaje
FROM ultima u LEFT JOIN meta m ON m.comuna = u.comuna AND m.i = 1 WHERE u.i = 1""")
oracle("recent_history", """
SELECT comuna, fecha_hora, codigo_estacion, mp25 FROM ds
QUALIFY ROW_NUMBER() OVER (PARTITION BY comuna ORDER BY fecha_hora DESC, codigo_estacion) <= 20""")
oracle("windowed_ica", f"""
SELECT w AS desde, w + INTERVAL 6 HOUR AS hasta, comuna, region, m AS mp25_promedio,
       n AS mediciones, {category('m')} AS categoria
FROM (SELECT time_bucket(INTERVAL 6 HOUR, fecha_hora, TIMESTAMP '2000-01-01') AS w, comuna, region,
             {rnd('AVG(mp25)', 2)} AS m, COUNT(*) AS n FROM full_med GROUP BY 1, 2, 3)""")

# --- models ---
_CLUSTER = ["mp25", "mp10", "temperatura", "humedad", "velocidad_viento",
            "emision_maxima_permitida", "indice_vulnerabilidad_respiratoria"]


def _imputed(source: str) -> str:
    """Cluster variables with the exact median in place of NULL."""
    return "SELECT id_monitoreo, " + ", ".join(
        f"COALESCE({c}, (SELECT quantile_cont({c}, 0.5) FROM {source})) AS {c}" for c in _CLUSTER
    ) + f" FROM {source}"


oracle("cluster_inputs", f"""
, h AS (SELECT * REPLACE (CASE WHEN no2 <> 9 THEN mp10 END AS mp10) FROM ds),
i AS ({_imputed('h')})
SELECT * REPLACE ({rnd('mp10')} AS mp10) FROM i""")
oracle("standardize", f", i AS ({_imputed('ds')}) SELECT id_monitoreo, " + ", ".join(
    f"{rnd(f'({c} - AVG({c}) OVER ()) / stddev_pop({c}) OVER ()')} AS {c}" for c in _CLUSTER
) + " FROM i")
oracle("risk_profile", "SELECT cluster, cantidad_registros, " + ", ".join(
    f"{rnd(c)} AS {c}" for c in [*RISK_WEIGHTS, "puntaje_riesgo"]) + " FROM puntaje")
oracle("risk_labels", """
SELECT id_monitoreo, cluster, nivel_riesgo FROM nivel JOIN (
  SELECT cluster, nivel_riesgo FROM etiqueta) USING (cluster)""")
oracle("cluster_summary", f"""
SELECT cluster, nivel_riesgo, cantidad_registros, {rnd('puntaje_riesgo')} AS puntaje_riesgo
FROM etiqueta""")
oracle("cluster_means", "SELECT cluster, nivel_riesgo, cantidad_registros, " + ", ".join(
    f"{rnd(c)} AS {c}" for c in RISK_WEIGHTS) + " FROM etiqueta")
oracle("risk_distribution", f"""
SELECT CAST(i - 1 AS INTEGER) AS orden, nivel_riesgo, CAST(n AS BIGINT) AS cantidad_registros,
       {rnd('n * CAST(100 AS DOUBLE) / SUM(n) OVER ()', 2)} AS porcentaje
FROM (SELECT ROW_NUMBER() OVER (ORDER BY puntaje_riesgo, cluster) AS i, nivel_riesgo,
             cantidad_registros AS n FROM etiqueta)""")

# --- models with one input ---
# Oldest 80 % of the rows with a target, and the least-squares line through them.
_SPLIT = f"""
, con_objetivo AS (
  SELECT *, ROW_NUMBER() OVER (ORDER BY fecha_hora, codigo_estacion, id_monitoreo) - 1 AS posicion,
         COUNT(*) OVER () AS n FROM objetivo WHERE mp25_24h IS NOT NULL),
ajuste AS (
  SELECT regr_slope(mp25_24h, mp25) AS b, regr_intercept(mp25_24h, mp25) AS a,
         stddev_pop(mp25) AS s
  FROM con_objetivo WHERE posicion < {_CUT}),
prueba AS (SELECT *, a + b * mp25 AS recta FROM con_objetivo, ajuste WHERE posicion >= {_CUT})
"""


def _errors(guess: str, real: str = "mp25_24h") -> str:
    return (f"{rnd(f'AVG(ABS({real} - {guess}))')} AS mae, "
            f"{rnd(f'SQRT(AVG(({real} - {guess}) * ({real} - {guess})))')} AS rmse, "
            f"{rnd(f'1 - AVG(({real} - {guess}) * ({real} - {guess})) / var_pop({real})')} AS r2")


oracle("linear_predictions", f"""{_SPLIT}
SELECT id_monitoreo, {rnd('recta', 2)} AS mp25_predicho FROM prueba""")
oracle("linear_24h", f"""{_SPLIT}
SELECT 'pronostico_24h' AS tipo_registro, codigo_estacion, fecha_hora_objetivo,
       mp25 AS mp25_actual, {rnd('a + b * mp25', 2)} AS mp25_predicho,
       {category('(a + b * mp25)')} AS categoria_predicha
FROM objetivo, ajuste WHERE desde_ultima = 1""")
oracle("model_choice", f"""{_SPLIT}
, m AS (SELECT 'linear_regression' AS modelo, {_errors('recta')} FROM prueba
        UNION ALL SELECT 'persistencia', {_errors('predicho')} FROM prueba)
SELECT *, rmse = MIN(rmse) OVER () AS mejor FROM m""")
oracle("cross_validation", f"""{_SPLIT}
, b AS (SELECT CAST(fold AS INTEGER) AS fold, n - 3 * (n // 4) + (fold - 1) * (n // 4) AS desde,
               n - 3 * (n // 4) + fold * (n // 4) AS hasta
        FROM (SELECT UNNEST([1, 2, 3]) AS fold), (SELECT MAX(n) AS n FROM con_objetivo)),
c AS (SELECT fold, desde, hasta, regr_slope(mp25_24h, mp25) AS p, regr_intercept(mp25_24h, mp25) AS q
      FROM con_objetivo, b WHERE posicion < desde GROUP BY fold, desde, hasta),
v AS (SELECT fold, mp25_24h, q + p * mp25 AS recta FROM con_objetivo, c
      WHERE posicion >= desde AND posicion < hasta)
SELECT fold, {_errors('recta')} FROM v GROUP BY fold""")
oracle("linear_importance", f"""{_SPLIT}
SELECT 'mp25' AS feature, {rnd('ABS(b) * s')} AS importance FROM ajuste""")
_INPUTS = {
    **{c: c for c in (*POLLUTANTS, *WEATHER, "emision_maxima_permitida",
                      "indice_vulnerabilidad_respiratoria")},
    "hora": "hour(fecha_hora)", "dia": "day(fecha_hora)", "mes": "month(fecha_hora)",
    "dia_semana": "isodow(fecha_hora) - 1", "lag_1": "lag_1", "lag_2": "lag_2", "lag_3": "lag_3",
    "delta_mp25": "mp25 - lag_1", "mp25_promedio_movil_3": "media_3", "rolling_mean_6": "media_6",
    "rolling_mean_12": "media_12",
    "direccion_viento_sin": "SIN(radians(direccion_viento_grados))",
    "direccion_viento_cos": "COS(radians(direccion_viento_grados))",
}
_LABELS = {"tipo_sensor": "tipo_sensor", "comuna": "comuna", "region": "region",
           "estacion_del_ano": """CASE WHEN month(fecha_hora) IN (12, 1, 2) THEN 'verano'
             WHEN month(fecha_hora) <= 5 THEN 'otono' WHEN month(fecha_hora) <= 8 THEN 'invierno'
             ELSE 'primavera' END"""}
oracle("preprocessor_matrix", f"""
, x AS (SELECT id_monitoreo, {', '.join(f'CAST({e} AS DOUBLE) AS {c}' for c, e in _INPUTS.items())},
               {', '.join(f'{e} AS {c}' for c, e in _LABELS.items())}
        FROM objetivo WHERE mp25_24h IS NOT NULL),
h AS (SELECT * REPLACE ({', '.join(
    f'COALESCE({c}, (SELECT quantile_cont({c}, 0.5) FROM x)) AS {c}' for c in _INPUTS)}) FROM x)
SELECT id_monitoreo, {', '.join(
    rnd(f"({c} - AVG({c}) OVER ()) / COALESCE(NULLIF(stddev_pop({c}) OVER (), 0), 1)") + f" AS {c}"
    for c in _INPUTS)},
    {', '.join(f"CAST(DENSE_RANK() OVER (ORDER BY {c}) - 1 AS INTEGER) AS {c}" for c in _LABELS)},
    CAST((SELECT {' + '.join(f'COUNT(DISTINCT {c})' for c in _LABELS)} FROM h) AS INTEGER) AS casillas,
    4 AS unos
FROM h""")
oracle("prediction_report", f"""
SELECT 'evaluacion' AS tipo_registro, fecha_hora AS fecha_hora_base, fecha_hora_objetivo,
       codigo_estacion, mp25_24h AS mp25_real_24h, predicho AS mp25_predicho_24h,
       {category('predicho')} AS categoria_alerta FROM evaluacion
UNION ALL SELECT 'pronostico_24h', fecha_hora, fecha_hora_objetivo, codigo_estacion, NULL, predicho,
       categoria FROM pronostico""")
# With squared distances, the mean distance of a point to a cluster follows from sums alone.
oracle("cluster_scores", f"""
, relleno AS (SELECT * REPLACE ({', '.join(
    f'COALESCE({c}, (SELECT quantile_cont({c}, 0.5) FROM nivel)) AS {c}' for c in _CLUSTER)}) FROM nivel),
z AS (SELECT cluster, id_monitoreo, {', '.join(
    f'({c} - AVG({c}) OVER ()) / stddev_pop({c}) OVER () AS {c}' for c in _CLUSTER)} FROM relleno),
g AS (SELECT cluster AS otro, COUNT(*) AS n, {', '.join(f'AVG({c}) AS m_{c}' for c in _CLUSTER)},
             {' + '.join(f'AVG({c} * {c})' for c in _CLUSTER)} AS q FROM z GROUP BY cluster),
d AS (SELECT id_monitoreo, cluster, otro, n,
             {' + '.join(f'{c} * {c}' for c in _CLUSTER)} + q
             - 2 * ({' + '.join(f'{c} * m_{c}' for c in _CLUSTER)}) AS lejos FROM z, g),
p AS (SELECT id_monitoreo, MAX(CASE WHEN otro = cluster THEN lejos * n / (n - 1) END) AS a,
             MIN(CASE WHEN otro <> cluster THEN lejos END) AS b FROM d GROUP BY id_monitoreo),
e AS (SELECT {' + '.join(f'var_pop({c}) * COUNT(*)' for c in _CLUSTER)} AS s FROM z GROUP BY cluster),
f AS (SELECT x.id_monitoreo, x.cluster, y.cluster AS otro, COUNT(*) AS n, SUM(sqrt({' + '.join(
        f'(x.{c} - y.{c}) * (x.{c} - y.{c})' for c in _CLUSTER)})) AS lejos
      FROM z x, z y WHERE x.id_monitoreo % 100 = 0 GROUP BY ALL),
h AS (SELECT id_monitoreo, MAX(CASE WHEN otro = cluster THEN lejos / (n - 1) END) AS a,
             MIN(CASE WHEN otro <> cluster THEN lejos / n END) AS b FROM f GROUP BY id_monitoreo)
SELECT (SELECT {rnd('SUM(s)')} FROM e) AS inercia,
       (SELECT {rnd('AVG((b - a) / GREATEST(a, b))')} FROM h) AS silhouette,
       {rnd('AVG((b - a) / GREATEST(a, b))')} AS silhouette_cuadrada
FROM p""")
oracle("kmeans_properties", """
SELECT UNNEST(['filas', 'asignadas', 'en_perfil', 'centros', 'etiquetas']) AS propiedad,
       UNNEST([COUNT(*), COUNT(*), COUNT(*), 3, 3]) AS valor FROM ds""")

# --- jobs and stored tables ---
oracle("error_rows", """
SELECT numero_fila, codigo_estacion, fecha_hora, motivo_error, 'validate' AS fase
FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY _seq) - 1 AS numero_fila FROM revisada)
WHERE motivo_error <> ''""")
oracle("stored_dataset", f"SELECT {', '.join(MODELING_COLUMNS)} FROM ds")
oracle("stored_report", """
SELECT fecha_hora, codigo_estacion, comuna, region, mp25, no2 FROM serie WHERE desde_ultima = 1""")
oracle("valid_dataset", f"""
SELECT fecha_hora, comuna, region, codigo_estacion,
       CASE WHEN fuente_dato = 'oficial' THEN 'publico_oficial' ELSE 'sensor_desconocido' END
         AS tipo_sensor, {', '.join(POLLUTANTS + WEATHER)},
       CAST(50 AS DOUBLE) AS indice_vulnerabilidad_respiratoria,
       CAST(200 AS DOUBLE) AS emision_maxima_permitida, {category('mp25')} AS categoria_ica
FROM revisada WHERE motivo_error = ''""")
oracle("load_with_store", f"""
, final AS (SELECT CASE WHEN motivo IS NULL AND id_final IN (SELECT c_custkey FROM customer)
    AND EXISTS (SELECT 1 FROM events e WHERE e.event_id % 2 = 0 AND e.user_id = id_final
                AND e.ts = fecha_hora) THEN 'medicion_ya_existente' ELSE motivo END AS motivo
  FROM carga)
SELECT 'dry-run' AS modo, COUNT(*) FILTER (WHERE motivo IS NULL) AS total_preparadas,
       COUNT(*) FILTER (WHERE motivo IS NULL OR motivo IN ('clima_requerido_por_api',
                        'medicion_ya_existente')) AS total_con_id_estacion,
       {', '.join(f"COUNT(*) FILTER (WHERE motivo = '{reason}') AS {name}"
                  for name, reason in OMISSION_COUNTS.items())},
       CAST(0 AS BIGINT) AS insertados, CAST(0 AS BIGINT) AS errores,
       'Payload preparado sin envio a API.' AS mensaje,
       'exacto_api>mapeo_manual_csv>heuristico_seguro' AS modo_mapeo, '[]' AS detalle_errores
FROM final""")
oracle("norm_columns", """
SELECT s_suppkey AS id_industria, s_name AS nombre, s_acctbal AS emision_maxima FROM supplier""",
       base=False)
oracle("select_numeric", """
SELECT mp25, CASE WHEN no2 % 4 <> 0 THEN TRUNC(no2) END AS mp10 FROM ds""")
_NUMBER = "Input should be a valid number, unable to parse string as a number"
oracle("ingest_type_errors", f"""
, campos AS (SELECT l.*, k, concat_ws('; ',
      CASE WHEN k = 21 THEN 'fecha_hora: Input should be a valid datetime' END,
      CASE WHEN k = 22 THEN 'id_estacion: Input should be a valid integer, unable to parse string as an integer' END,
      CASE WHEN k = 23 THEN 'mp25: {_NUMBER}' END, NULLIF(error, ''),
      CASE WHEN k = 24 THEN 'temperatura: {_NUMBER}' END) AS problema
  FROM lote_campos l JOIN ev ON event_id = indice // 2),
turnos AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY id_estacion, fecha_hora, problema = '' AND conocida
                                        ORDER BY indice) AS vuelta FROM campos)
SELECT indice, CASE WHEN problema <> '' THEN problema
    WHEN NOT conocida THEN 'No existe estacion con id_estacion=' || id_estacion
    ELSE 'Ya existe una medicion para esa estacion y fecha_hora.' END AS motivo
FROM turnos WHERE problema <> '' OR NOT conocida OR guardada OR vuelta > 1""")
oracle("error_details", """
SELECT motivo, COUNT(*) AS cantidad FROM (
  SELECT CASE WHEN starts_with(motivo, 'No existe estacion') THEN 'No existe estacion con id_estacion='
              ELSE motivo END AS motivo
  FROM (SELECT UNNEST(string_split(motivo, '; ')) AS motivo FROM lote_final WHERE motivo IS NOT NULL))
GROUP BY motivo""")
