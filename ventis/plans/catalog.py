"""Named queries: every operator run over the whole test tables.

Each query takes (spark, folder of Parquet tables) and returns a DataFrame. The matching SQL is
in :mod:`ventis.plans.oracles`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ventis.functions import air, dates, sensors, text
from ventis.functions.numeric import parse_number, round_half_up
from ventis.operators import cluster as C
from ventis.operators import features as X
from ventis.operators import forecast as P
from ventis.operators import ingest as G
from ventis.operators import joins as J
from ventis.operators import quality as Q
from ventis.operators import ranking as K
from ventis.operators import rollups as R
from ventis.operators import statistics as S
from ventis.operators import views as V
from ventis.operators.filters import MeasurementFilter, ViewFilter, apply_view
from ventis.operators.prepare import prepare_measurements
from ventis.plans import etl
from ventis.schemas import MODELING_COLUMNS, POLLUTANTS, WEATHER, require_columns
from ventis.session import materialize, scratch_path
from ventis.sources import adapter as A
from ventis.sources import readers, star as T
from ventis.sources.writers import payload_json, write_table
from ventis.streaming.windows import windowed_ica

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

ORDER = ["fecha_hora", "id_monitoreo"]
# Station types and regions of the test tables, for the audit of domain rules.
TEST_TYPES = ["MACHINERY", "FURNITURE", "BUILDING"]
TEST_REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE"]


def query(function: Query) -> Query:
    """Register under the function's name; a trailing underscore only avoids a name clash."""
    QUERIES[function.__name__.rstrip("_")] = function
    return function


def rounded(df: DataFrame, *columns: str, digits: int = 4) -> DataFrame:
    """Fix the digits of computed columns, so results compare exactly across engines."""
    return df.withColumns({c: round_half_up(F.col(c), digits) for c in columns})


def dataset(spark: SparkSession, root: str) -> DataFrame:
    return J.modeling_dataset(A.star(spark, root), keep=("id_monitoreo",))


def series(spark: SparkSession, root: str) -> DataFrame:
    return X.add_series_features(dataset(spark, root), ORDER)


def persistence(df: DataFrame) -> DataFrame:
    """Baseline forecast without a model: mean of the previous three readings."""
    guess = F.coalesce("mp25_promedio_movil_3", "mp25")
    return df.withColumn(P.PREDICTION, round_half_up(guess))


def evaluation(spark: SparkSession, root: str) -> DataFrame:
    scored = persistence(X.add_target(series(spark, root)))
    return P.evaluation_report(X.training_rows(scored))


def forecast(spark: SparkSession, root: str) -> DataFrame:
    newest = X.newest_with_series(dataset(spark, root), ORDER)
    return P.forecast_report(persistence(P.forecast_rows(newest, ORDER)))


def levels(spark: SparkSession, root: str) -> DataFrame:
    """Dataset with a cluster number that follows PM2.5, for profile and label queries."""
    mp25 = F.col("mp25")
    cluster = F.when(mp25 < 50, 2).when(mp25 < 110, 0).otherwise(1)
    return dataset(spark, root).withColumn("cluster", cluster)


# --- dimensions and mapping -------------------------------------------------------------------

@query
def dim_stations(spark, root):
    return T.list_dimension(A.star(spark, root).estaciones, "id_estacion")


@query
def dim_lookup(spark, root):
    return T.get_by_id(A.star(spark, root).comunas, "id_comuna", 7)


@query
def mapping_duplicates(spark, root):
    segment = F.concat(F.lit(" "), F.col("c_mktsegment"), F.lit("-"), F.col("c_nationkey"))
    mapping = A.table(spark, root, "customer").select(segment.alias("codigo_estacion_raw"))
    return readers.duplicated_codes(mapping)


# --- scalar cleaning --------------------------------------------------------------------------

def _raw(spark, root, **columns: Column) -> DataFrame:
    raw = text.normalize_columns(A.raw_text_feed(spark, root))
    return raw.select("_seq", *[c.alias(name) for name, c in columns.items()])


@query
def norm_text(spark, root):
    return _raw(spark, root, texto=text.normalize_text("comuna"))


@query
def norm_region(spark, root):
    return _raw(spark, root, region=text.normalize_region("region"))


@query
def norm_comuna(spark, root):
    return _raw(spark, root, comuna=text.normalize_comuna("comuna"))


@query
def parse_number_(spark, root):
    return _raw(spark, root, mp25=parse_number("mp25"), no2=parse_number("no2"))


# Text forms of a time, besides those of the raw feed.
DATE_FORMATS = ["dd/MM/yy HH:mm", "dd.MM.yyyy HH:mm", "yyyyMMdd", "d MMMM yyyy",
                "dd/MM/yyyy h:mm a", "dd-MMM-yyyy HH:mm:ss", "MMMM d, yyyy"]


@query
def parse_date_formats(spark, root):
    """Times of all events written in seven other forms and read again."""
    forms = F.array(*[F.date_format("ts", form) for form in DATE_FORMATS])
    text = F.get(forms, (F.col("event_id") % len(DATE_FORMATS)).cast("int"))
    return A.table(spark, root, "events").select(
        F.col("event_id").alias("_seq"), dates.parse_date_mixed(text).alias("fecha"))


@query
def parse_date(spark, root):
    return _raw(
        spark, root, iso=dates.parse_date_mixed("fecha_hora"),
        heredada=dates.parse_date_mixed("fecha_hora", "legacy_dayfirst"),
    )


@query
def repair_mojibake(spark, root):
    label = text.normalize_comuna("comuna")
    broken = F.decode(F.encode(label, "UTF-8"), "ISO-8859-1")
    return _raw(spark, root, original=label, reparado=text.repair_mojibake(broken))


@query
def prepare_measurements_(spark, root):
    """The same raw feed taken once as official and once as community."""
    raw = A.raw_text_feed(spark, root)
    return prepare_measurements(raw, "oficial").unionByName(prepare_measurements(raw, "ong"))


def _codes(spark, root) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    number = F.col("user_id").cast("string")
    code = (
        F.when(k % 7 == 0, F.concat(F.lit("of-"), number))
        .when(k % 7 == 1, F.concat(F.lit("SEN-OF-"), number))
        .when(k % 7 == 2, F.concat(number, F.lit("-OF")))
        .when(k % 7 == 3, F.concat(F.lit("ONG-"), number))
        .when(k % 7 == 4, F.concat(F.lit("SEN-ong-"), number))
        .when(k % 7 == 5, F.concat(F.lit("XONG"), number))
        .otherwise(number)
    )
    source = F.when(k % 5 == 0, "Oficial").when(k % 5 == 1, "ONG").when(k % 5 == 2, "comunitaria")
    return A.table(spark, root, "events").select(
        "event_id", code.alias("codigo_estacion"), source.alias("fuente_dato"),
        F.when(k % 3 == 0, F.col("value")).alias("emision_maxima_permitida"),
    )


@query
def sensor_type_strict(spark, root):
    return _codes(spark, root).select(
        "event_id", sensors.sensor_type_from_code("codigo_estacion").alias("tipo_sensor")
    )


@query
def sensor_type_lenient(spark, root):
    kind = sensors.infer_sensor_type(F.col("fuente_dato"), F.col("codigo_estacion"))
    return _codes(spark, root).select("event_id", kind.alias("tipo_sensor"))


@query
def fill_context(spark, root):
    return X.fill_context(_codes(spark, root)).select(
        "event_id", "tipo_sensor", "indice_vulnerabilidad_respiratoria",
        "emision_maxima_permitida",
    )


@query
def classify_ica(spark, root):
    fact = A.star(spark, root).monitoreo
    return fact.select("id_monitoreo", air.classify_ica(F.col("mp25")).alias("c")).select(
        "id_monitoreo", "c.*"
    )


@query
def citizen_outlook(spark, root):
    value = F.when(F.col("humedad") > 3, F.col("mp25"))
    return A.star(spark, root).monitoreo.select(
        "id_monitoreo", air.citizen_outlook(value).alias("mensaje")
    )


@query
def season_mean(spark, root):
    orders = A.table(spark, root, "orders")
    return orders.groupBy(dates.season_of("o_orderdate").alias("estacion_del_ano")).agg(
        F.count("*").alias("cantidad"), round_half_up(F.avg("o_totalprice")).alias("promedio")
    )


@query
def calendar_parts(spark, root):
    fact = A.star(spark, root).monitoreo
    parts = dates.calendar_parts("fecha_hora")
    number = dates.feature_calendar("fecha_hora")["dia_semana"]
    return fact.select(
        "id_monitoreo", *[c.alias(name) for name, c in parts.items()],
        number.alias("dia_semana_numero"),
    )


@query
def wind_circular(spark, root):
    fact = A.star(spark, root).monitoreo
    parts = X.wind_components(F.col("direccion_viento_grados"))
    out = fact.select("id_monitoreo", *[c.alias(name) for name, c in parts.items()])
    return rounded(out, *parts)


# --- filters and pages ------------------------------------------------------------------------

WHERE = MeasurementFilter(
    region="ASIA", fecha_inicio="2024-01-03 00:00:00", fecha_fin="2024-01-20 12:00:00",
    mp25_min=5.0, mp25_max=150.0, comuna="nation_1",
)


@query
def filter_measurements(spark, root):
    return J.measurement_details(A.star(spark, root), WHERE)


@query
def view_filters(spark, root):
    view = ViewFilter(
        regions=["ASIA", "EUROPE"], sensor_types=["BUILDING", "MACHINERY"],
        date_start="2024-01-05", date_end="2024-01-09",
    )
    return apply_view(dataset(spark, root), view, "fecha_hora")


@query
def filter_options(spark, root):
    return V.filter_options([dataset(spark, root), forecast(spark, root)])


@query
def measurement_page(spark, root):
    details = J.measurement_details(A.star(spark, root))
    return K.page(details, [("fecha_hora", False), ("id_monitoreo", False)], limit=100, offset=50)


@query
def measurement_by_id(spark, root):
    return J.measurement_by_id(A.star(spark, root), 77)


# --- joins ------------------------------------------------------------------------------------

@query
def weather_join(spark, root):
    out = J.join_weather(A.measurements(spark, root), A.weather(spark, root))
    return rounded(out, *WEATHER)


@query
def star_join(spark, root):
    return J.star_join(A.star(spark, root)).select(
        "id_monitoreo", "fecha_hora", "id_estacion", "codigo_unico", "comuna", "region", "mp25"
    )


@query
def modeling_dataset(spark, root):
    return dataset(spark, root)


@query
def resolve_stations(spark, root):
    return J.resolve_stations(
        A.unresolved_measurements(spark, root), A.station_catalog(spark, root),
        A.station_mapping(spark, root),
    ).select("_seq", "id_estacion", "codigo_unico_api", "modo_mapeo", "motivo_omision")


def _incoming(spark, root) -> DataFrame:
    return A.incoming_batch(spark, root)


@query
def new_measurements(spark, root):
    fact = A.star(spark, root).monitoreo
    return J.new_measurements(_incoming(spark, root), fact).select(
        "indice", "id_estacion", "fecha_hora"
    )


@query
def existing_measurements(spark, root):
    fact = A.star(spark, root).monitoreo
    return J.existing_measurements(_incoming(spark, root), fact).select(
        "indice", "id_estacion", "fecha_hora", "motivo_omision"
    )


@query
def region_coverage(spark, root):
    return J.region_coverage(A.star(spark, root))


@query
def missing_slots(spark, root):
    return J.missing_slots(A.star(spark, root), step_hours=6)


# --- rollups ----------------------------------------------------------------------------------

@query
def general_summary(spark, root):
    return R.general_summary(A.star(spark, root))


@query
def mp25_by_comuna(spark, root):
    return R.mp25_by_comuna(A.star(spark, root))


@query
def mp25_by_comuna_filtered(spark, root):
    return R.mp25_by_comuna(A.star(spark, root), WHERE)


@query
def critical_comunas(spark, root):
    return R.critical_comunas(A.star(spark, root))


@query
def daily_evolution(spark, root):
    return R.daily_evolution(A.star(spark, root))


@query
def ica_by_comuna(spark, root):
    return R.ica_by_comuna(A.star(spark, root))


@query
def sensor_ranking(spark, root):
    return R.sensor_ranking(A.star(spark, root))


@query
def rank_comuna(spark, root):
    return rounded(R.rank_by(A.star(spark, root), "comuna", "region"), "mp25_promedio")


@query
def rank_region(spark, root):
    return rounded(R.rank_by(A.star(spark, root), "region"), "mp25_promedio")


@query
def critical_days(spark, root):
    return rounded(R.rank_by(A.star(spark, root), "fecha"), "mp25_promedio")


@query
def rank_station(spark, root):
    ranked = R.rank_by(A.star(spark, root), "codigo_unico", "comuna", "tipo")
    return rounded(ranked, "mp25_promedio")


@query
def station_daily(spark, root):
    return rounded(R.station_daily(A.star(spark, root)), "promedio_diario_mp25")


@query
def icap_distribution(spark, root):
    return R.icap_distribution(A.star(spark, root))


@query
def coverage(spark, root):
    return R.coverage(A.star(spark, root))


@query
def episode_counts(spark, root):
    return R.episode_counts(A.star(spark, root), low_wind=4.5)


@query
def norm_exceedance(spark, root):
    return R.norm_exceedance(A.star(spark, root))


@query
def critical_share(spark, root):
    out = R.critical_share(dataset(spark, root), F.col("categoria_ica") == "Emergencia")
    return rounded(out, "mp25_promedio")


# --- statistics -------------------------------------------------------------------------------

@query
def category_counts(spark, root):
    return S.value_counts(dataset(spark, root), "categoria_ica")


@query
def describe_stats(spark, root):
    out = S.describe(dataset(spark, root))
    return rounded(out, "mean", "std", "q25", "q50", "q75")


@query
def bulk_quantiles(spark, root):
    items = A.table(spark, root, "lineitem")
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return rounded(S.exact_quantiles(items, columns, [0.05, 0.5, 0.95]), "cuantil")


@query
def quality_summary(spark, root):
    return S.quality_summary(A.faulty_measurements(spark, root).drop("_seq"))


@query
def correlation_matrix(spark, root):
    return rounded(S.correlation_matrix(dataset(spark, root)), "correlacion")


@query
def linear_trend(spark, root):
    out = S.linear_trend(dataset(spark, root), "humedad")
    return rounded(out, "pendiente", "intercepto")


@query
def resample_mean(spark, root):
    return rounded(S.resample_mean(dataset(spark, root), "day"), "mp25")


@query
def top_comunas(spark, root):
    return rounded(S.top_mean(dataset(spark, root), "comuna", 15), "mp25_promedio")


@query
def error_histogram(spark, root):
    out = S.histogram(evaluation(spark, root), "error_absoluto", 30)
    return rounded(out, "desde", "hasta")


@query
def modal_label(spark, root):
    return S.modal_label(levels(spark, root), "cluster", "tipo_sensor")


# --- windows and features ---------------------------------------------------------------------

@query
def duplicate_flag(spark, root):
    return Q.flag_duplicates(A.faulty_measurements(spark, root)).select("_seq", "duplicado")


@query
def dedupe_first(spark, root):
    return Q.dedupe_first(A.faulty_measurements(spark, root), Q.KEY).select("_seq", *Q.KEY)


@query
def target_24h(spark, root):
    return X.add_target(series(spark, root)).select(
        "id_monitoreo", "mp25_24h_estacion", "mp25_24h_comuna", "mp25_24h", "fecha_hora_objetivo"
    )


@query
def lag_features(spark, root):
    out = series(spark, root).select("id_monitoreo", "lag_1", "lag_2", "lag_3", "delta_mp25")
    return rounded(out, "delta_mp25")


@query
def rolling_features(spark, root):
    return rounded(series(spark, root).select("id_monitoreo", *X.ROLLING), *X.ROLLING)


@query
def latest_per_station(spark, root):
    return X.latest_per_station(dataset(spark, root), ORDER).select(
        "codigo_estacion", "id_monitoreo", "fecha_hora", "mp25"
    )


def _ranked(spark, root) -> DataFrame:
    rows = dataset(spark, root).select("id_monitoreo", "fecha_hora", "codigo_estacion")
    return X.rank_in_time(rows, ["id_monitoreo"])


@query
def global_rank(spark, root):
    return _ranked(spark, root).select("id_monitoreo", F.col("_rank").alias("posicion"))


@query
def temporal_split(spark, root):
    return X.label_split(_ranked(spark, root)).select("id_monitoreo", "conjunto")


@query
def split_summary(spark, root):
    return X.split_summary(X.label_split(_ranked(spark, root)))


@query
def cv_folds(spark, root):
    return X.cv_summary(_ranked(spark, root))


# --- quality and ingest -----------------------------------------------------------------------

@query
def validate_valid(spark, root):
    return Q.validate(A.faulty_measurements(spark, root))[0].select("_seq", *Q.KEY, "mp25")


@query
def validate_errors(spark, root):
    return Q.validate(A.faulty_measurements(spark, root))[1].select(
        "_seq", *Q.KEY, "motivo_error", "fase"
    )


@query
def clean_dataset(spark, root):
    return Q.clean_dataset(A.faulty_measurements(spark, root)).drop("fecha")


@query
def constraint_audit(spark, root):
    """Audit of the star with faulty copies of some rows: repeated, orphaned, absent, out of range."""
    s = A.star(spark, root)

    def with_faults(df, faulty, **changes):
        return df.unionByName(df.filter(faulty).withColumns(
            {name: F.expr(text).cast(df.schema[name].dataType) for name, text in changes.items()}))

    return Q.constraint_audit(T.Star(
        with_faults(s.comunas, "id_comuna % 5 = 0", id_comuna="id_comuna + 100", region="NULL",
                    poblacion_estimada="-1", indice_vulnerabilidad_respiratoria="100.5"),
        with_faults(s.estaciones, "id_estacion % 50 = 0", codigo_unico="NULL", tipo="'OTRO'",
                    latitud="95", id_comuna="IF(id_estacion % 100 = 0, NULL, id_comuna + 1000)"),
        with_faults(s.industrias, "id_industria % 10 = 0", id_industria="NULL",
                    rubro_industrial="NULL", emision_maxima_permitida="-1"),
        with_faults(s.monitoreo, "id_monitoreo % 100 = 0", mp10="-0.5", humedad="101",
                    temperatura="NULL", id_estacion="IF(id_monitoreo % 200 = 0, NULL, id_estacion)"),
    ), TEST_REGIONS, TEST_TYPES)


def _ingest(spark, root):
    star = A.star(spark, root)
    return G.ingest_batch(_incoming(spark, root), star.estaciones, star.monitoreo)


@query
def ingest_accepted(spark, root):
    return _ingest(spark, root)[0].select("indice", "id_estacion", "fecha_hora", "mp25")


@query
def ingest_rejected(spark, root):
    return _ingest(spark, root)[1]


@query
def ingest_orphans(spark, root):
    return G.orphan_rows(_incoming(spark, root), A.star(spark, root).estaciones).select(
        "indice", "id_estacion", "motivo"
    )


@query
def ingest_summary(spark, root):
    return G.ingest_summary(*_ingest(spark, root))


def _load(spark, root):
    return G.prepare_load(
        A.unresolved_measurements(spark, root), A.station_catalog(spark, root),
        A.station_mapping(spark, root),
    )


@query
def load_payload(spark, root):
    return _load(spark, root)[0].select(
        "_seq", "id_estacion", "codigo_unico_api", "modo_mapeo", *POLLUTANTS, *WEATHER
    )


@query
def payload_json_(spark, root):
    return payload_json(_load(spark, root)[0], keep=["_seq"])


@query
def load_omitted(spark, root):
    return _load(spark, root)[1]


@query
def load_report(spark, root):
    payload, omitted = _load(spark, root)
    return G.load_report(payload, omitted)


def _text_batch(spark, root) -> DataFrame:
    """The incoming batch as text, some of it unreadable."""
    batch = _incoming(spark, root)
    texts = batch.select("indice", *[F.col(c).cast("string").alias(c) for c in G.INGEST_COLUMNS])
    number = F.col("no2").try_cast("double")
    faults = {"fecha_hora": (21, "ayer"), "id_estacion": (22, "E-1"), "mp25": (23, "s/d"),
              "temperatura": (24, "frio")}
    return texts.withColumns({
        name: F.when(number == k, F.lit(word)).otherwise(F.col(name))
        for name, (k, word) in faults.items()
    })


@query
def ingest_type_errors(spark, root):
    """Rejected rows of a batch that arrives as text; unreadable values are named as such."""
    star = A.star(spark, root)
    batch = G.typed_payload(_text_batch(spark, root))
    return G.ingest_batch(batch, star.estaciones, star.monitoreo)[1]


@query
def error_details(spark, root):
    """How often each reason occurs among the rejected rows."""
    return G.error_details(_ingest(spark, root)[1])


@query
def upsert_absent(spark, root):
    existing = A.star(spark, root).estaciones.select(F.col("codigo_unico").alias("codigo"))
    number = (F.col("s_suppkey") - F.col("s_suppkey") % 3) * 20
    code = F.concat(F.lit("Customer#"), F.lpad(number.cast("string"), 9, "0"))
    incoming = A.table(spark, root, "supplier").select("s_suppkey", code.alias("codigo"))
    return J.insert_absent(incoming, existing, ["codigo"], ["s_suppkey"])


# --- views ------------------------------------------------------------------------------------

@query
def prediction_errors(spark, root):
    columns = ["fecha_hora_base", "codigo_estacion", "fecha_hora_objetivo", "mp25_actual",
               "mp25_real", "mp25_predicho", "error", "error_absoluto", "categoria_predicha",
               "mensaje_ciudadano", "color_referencial"]
    return rounded(evaluation(spark, root).select(*columns), "error", "error_absoluto")


@query
def regression_metrics(spark, root):
    report = evaluation(spark, root)
    return rounded(P.regression_metrics(report, "mp25_real", "mp25_predicho"), "mae", "rmse", "r2")


@query
def executive_kpis(spark, root):
    return V.executive_kpis(dataset(spark, root), forecast(spark, root))


@query
def executive_ranking(spark, root):
    return rounded(V.executive_ranking(forecast(spark, root)), "mp25_predicho_24h")


@query
def daily_trend(spark, root):
    return rounded(V.daily_trend(dataset(spark, root)), "mp25")


@query
def alert_counts(spark, root):
    return V.alert_counts(forecast(spark, root))


@query
def alert_summary(spark, root):
    return rounded(V.alert_summary(forecast(spark, root)), "mp25_predicho_24h")


@query
def citizen_status(spark, root):
    return V.citizen_status(dataset(spark, root), forecast(spark, root))


@query
def recent_history(spark, root):
    return V.recent_history(dataset(spark, root))


@query
def windowed_ica_(spark, root):
    star = A.star(spark, root)
    return windowed_ica(star.monitoreo, star.places(), "6 hours")


# --- models -----------------------------------------------------------------------------------

@query
def cluster_inputs(spark, root):
    holes = dataset(spark, root).withColumn("mp10", F.when(F.col("no2") != 9, F.col("mp10")))
    out = C.cluster_inputs(holes, keep=("id_monitoreo",))
    return rounded(out, "mp10")


@query
def standardize(spark, root):
    df = dataset(spark, root)
    scaling = C.fit_scaling(df)
    return rounded(C.standardize(df, scaling, keep=("id_monitoreo",)), *scaling.columns)


@query
def risk_profile(spark, root):
    out = C.cluster_profile(levels(spark, root))
    return rounded(out, *C.RISK_WEIGHTS, "puntaje_riesgo")


@query
def risk_labels(spark, root):
    return C.assign_labels(levels(spark, root)).select("id_monitoreo", "cluster", "nivel_riesgo")


@query
def cluster_summary(spark, root):
    out = C.summarize_clusters(levels(spark, root)).select(
        "cluster", "nivel_riesgo", "cantidad_registros", "puntaje_riesgo"
    )
    return rounded(out, "puntaje_riesgo")


@query
def cluster_means(spark, root):
    out = V.cluster_summary_from_rows(C.assign_labels(levels(spark, root)))
    return rounded(out, *C.RISK_WEIGHTS)


@query
def risk_distribution(spark, root):
    return V.risk_distribution(C.assign_labels(levels(spark, root)))


def _asked() -> Column:
    """Rows whose Euclidean silhouette is averaged; their neighbours are all rows."""
    return F.col("id_monitoreo") % 100 == 0


def _vectors(spark, root):
    df = dataset(spark, root)
    scaling = C.fit_scaling(df)
    return df, scaling, C.assemble(df, scaling)


@query
def kmeans_assign(spark, root):
    """Cluster and risk label of each measurement; the fit runs over cached vectors."""
    df, scaling, vectors = _vectors(spark, root)
    cached = vectors.select(C.FEATURES).persist()
    try:
        model = C.fit_kmeans(cached, k=3)
    finally:
        cached.unpersist()
    labelled = C.assign_labels(model.transform(vectors).drop(C.FEATURES))
    return labelled.select("id_monitoreo", "cluster", "nivel_riesgo")


@query
def k_sweep(spark, root):
    _, _, vectors = _vectors(spark, root)
    cached = C.spread(vectors.select("id_monitoreo", C.FEATURES)).persist()
    try:
        return C.k_sweep(cached, asked=_asked())[0]
    finally:
        cached.unpersist()


def _features(spark, root) -> DataFrame:
    return X.build_features(dataset(spark, root), ORDER)


# A smaller forest than the default of 300 deep trees: the fit is repeated for every check.
CHECK_FOREST = P.Forest(trees=20, depth=8, bins=32)


def _fitted(spark, root, name: str):
    """Features, newest 20 % of the labelled rows, and a model fitted on the older 80 %."""
    features = materialize(_features(spark, root), "features")
    ranked = X.rank_in_time(X.training_rows(features), ["id_monitoreo"])
    train, test = X.temporal_split(materialize(ranked, "ranked"))
    return features, test, P.fit_models(train, CHECK_FOREST, [name])[name]


@query
def forecast_eval(spark, root):
    _, test, model = _fitted(spark, root, "linear_regression")
    return P.regression_metrics(P.predict(model, test))


@query
def forest_eval(spark, root):
    _, test, model = _fitted(spark, root, "random_forest")
    return P.regression_metrics(P.predict(model, test))


@query
def forecast_24h(spark, root):
    features, _, model = _fitted(spark, root, "linear_regression")
    return P.forecast_report(P.predict(model, P.forecast_rows(features, ORDER)))


@query
def feature_importance(spark, root):
    _, test, model = _fitted(spark, root, "random_forest")
    return P.feature_importance(model, model.transform(test))


# --- models with one input, whose fit has a closed form ----------------------------------------

_PLAIN = {"names": ["linear_regression"], "numeric": ["mp25"], "categorical": []}


def _ranked_targets(spark, root) -> DataFrame:
    """Rows with a known target in time order, with the baseline's guess as ``base``.

    Stored with the columns that the line and its queries read, before the ranking reads them twice.
    """
    scored = persistence(X.add_target(series(spark, root))).withColumnRenamed(P.PREDICTION, "base")
    rows = X.training_rows(scored).select("id_monitoreo", X.TIME, X.STATION, "mp25", X.TARGET, "base")
    return materialize(X.rank_in_time(materialize(rows, "objetivo"), ["id_monitoreo"]), "ranked")


def _plain_model(train: DataFrame):
    return P.fit_models(train, **_PLAIN)["linear_regression"]


@query
def linear_predictions(spark, root):
    """Predictions of the newest 20 % by a line fitted on the oldest 80 %."""
    train, test = X.temporal_split(_ranked_targets(spark, root))
    scored = P.predict(_plain_model(train), test)
    return rounded(scored.select("id_monitoreo", P.PREDICTION), P.PREDICTION, digits=2)


@query
def linear_24h(spark, root):
    """Forecast of every station's latest row by the same line."""
    train, _ = X.temporal_split(_ranked_targets(spark, root))
    newest = X.newest_with_series(dataset(spark, root), ORDER)
    latest = P.forecast_rows(newest, ORDER).withColumn(
        X.TARGET, F.lit(None).cast("double"))
    report = P.forecast_report(P.predict(_plain_model(train), latest))
    return rounded(report.select(
        "tipo_registro", "codigo_estacion", "fecha_hora_objetivo", "mp25_actual", P.PREDICTION,
        "categoria_predicha"), P.PREDICTION, digits=2)


@query
def model_choice(spark, root):
    """Errors of the line and of the baseline on the newest rows, and which one is best."""
    train, test = X.temporal_split(_ranked_targets(spark, root))
    guesses = {"linear_regression": P.predict(_plain_model(train), test),
               "persistencia": test.withColumn(P.PREDICTION, F.col("base"))}
    found = {name: P.metrics_dict(df) for name, df in guesses.items()}
    best = P.best_model(found)
    rows = [(name, m["mae"], m["rmse"], m["r2"], name == best) for name, m in found.items()]
    out = spark.createDataFrame(rows, "modelo string, mae double, rmse double, r2 double, mejor boolean")
    return rounded(out, "mae", "rmse", "r2")


@query
def cross_validation(spark, root):
    """Errors of the line per expanding fold."""
    ranked = _ranked_targets(spark, root)
    scores = P.cross_validate(ranked, ranked.count(), **_PLAIN)["linear_regression"]["folds"]
    rows = [(s["fold"], s["mae"], s["rmse"], s["r2"]) for s in scores]
    out = spark.createDataFrame(rows, "fold int, mae double, rmse double, r2 double")
    return rounded(out, "mae", "rmse", "r2")


@query
def linear_importance(spark, root):
    train, test = X.temporal_split(_ranked_targets(spark, root))
    model = _plain_model(train)
    return rounded(P.feature_importance(model, model.transform(test)), "importance")


@query
def preprocessor_matrix(spark, root):
    """Every imputed and scaled input, category positions and size of the one-hot blocks."""
    train = materialize(X.training_rows(_features(spark, root)), "features")
    stages = P.preprocessing_stages(train)
    out = Pipeline(stages=stages).fit(train).transform(train)
    blocks = F.slice(vector_to_array(P.VECTOR), len(P.NUMERIC_FEATURES) + 1, 10_000)
    return out.select(
        "id_monitoreo",
        *[round_half_up(F.col(f"_n_{c}"), 4).alias(c) for c in P.NUMERIC_FEATURES],
        *[F.col(f"_i_{c}").cast("int").alias(c) for c in P.CATEGORICAL_FEATURES],
        F.size(blocks).alias("casillas"),
        F.aggregate(blocks, F.lit(0.0), lambda a, b: a + b).cast("int").alias("unos"),
    )


@query
def prediction_report(spark, root):
    """Evaluation rows and 24-hour forecast in one report."""
    columns = ["tipo_registro", "fecha_hora_base", "fecha_hora_objetivo", "codigo_estacion",
               "mp25_real_24h", "mp25_predicho_24h", "categoria_alerta"]
    return evaluation(spark, root).unionByName(forecast(spark, root)).select(*columns)


@query
def cluster_scores(spark, root):
    """Inertia and squared silhouette of given clusters over all rows, and the Euclidean
    silhouette of the rows with an id divisible by 100 against all rows."""
    df = levels(spark, root)
    scaling = C.fit_scaling(df)
    squares = F.lit(0.0)
    for c in scaling.columns:
        squares = squares + F.var_pop(c) * F.count("*")
    scaled = C.standardize(df, scaling, keep=("cluster",))
    inertia = scaled.groupBy("cluster").agg(squares.alias("s")).agg(F.sum("s").alias("inercia"))
    vectors = C.assemble(df, scaling)
    score = C.silhouette(vectors)
    plain = C.euclidean_silhouettes(
        vectors.withColumn("_point", vector_to_array(C.FEATURES)), "_point", ["cluster"], _asked())
    # Two numbers reach the driver.
    out = inertia.withColumns({
        "silhouette": F.lit(plain.first()["silhouette"]), "silhouette_cuadrada": F.lit(score)})
    return rounded(out, "inercia", "silhouette", "silhouette_cuadrada")


@query
def kmeans_properties(spark, root):
    """What must hold for a fit: rows with the nearest centre, labels in use, and centres whose
    original units lie within 0.05 deviations of their rows' means."""
    df, scaling, vectors = _vectors(spark, root)
    cached = vectors.select(C.FEATURES).persist()
    try:
        model = C.fit_kmeans(cached, k=3)
    finally:
        cached.unpersist()
    assigned = model.transform(vectors).drop(C.FEATURES)
    scaled = scaling.scaled()

    def distance(center) -> Column:
        total = F.lit(0.0)
        for c, z in zip(scaling.columns, center):
            total = total + (scaled[c] - float(z)) * (scaled[c] - float(z))
        return total

    away = F.array(*[distance(center) for center in model.clusterCenters()])
    rows = assigned.select(
        (F.get(away, F.col("cluster")) <= F.array_min(away) + 1e-9).alias("cerca"), "cluster")
    counted = rows.agg(F.count("*").alias("filas"), F.count_if("cerca").alias("asignadas"))

    def listed(row: DataFrame) -> DataFrame:
        pairs = [F.struct(F.lit(c).alias("propiedad"), F.col(c).alias("valor")) for c in row.columns]
        return row.select(F.explode(F.array(*pairs)).alias("p")).select("p.*")

    summary = C.summarize_clusters(assigned)
    means = assigned.groupBy("cluster").agg(
        *[F.avg(c).alias(f"_m_{c}") for c in scaling.columns])
    close = F.lit(True)
    for c in scaling.columns:
        close = close & (F.abs(F.col(c) - F.col(f"_m_{c}")) <= 0.05 * scaling.std[c])
    centers = C.centroids_with_profile(C.centroids(model, scaling, df), summary)
    checked = centers.join(means, "cluster").agg(
        F.count_if(close).alias("centros"), F.countDistinct("nivel_riesgo").alias("etiquetas"),
        F.sum("cantidad_registros").alias("en_perfil"))
    return listed(counted).unionByName(listed(checked))


# --- jobs and stored tables ---------------------------------------------------------------------

@query
def error_rows(spark, root):
    """Row numbers in reading order and reasons of the rows that validation refuses."""
    return etl.validate_measurements(A.faulty_measurements(spark, root))[1].select(
        "numero_fila", "codigo_estacion", "fecha_hora", "motivo_error", "fase")


@query
def stored_dataset(spark, root):
    """Modelling dataset exported as a table and read back under its contract."""
    path = scratch_path(spark, "dataset")
    etl.export_dataset(A.star(spark, root), path)
    back = readers.read_labeled(spark, path, "parquet")
    return require_columns(back, MODELING_COLUMNS, "dataset").select(*MODELING_COLUMNS)


@query
def stored_report(spark, root):
    """Ranking of stations written as CSV text and read back with its types."""
    path = scratch_path(spark, "reporte")
    columns = ["fecha_hora", "codigo_estacion", "comuna", "region", "mp25", "no2"]
    latest = X.latest_per_station(dataset(spark, root), ORDER).select(*columns)
    write_table(latest, path, "csv")
    return readers.read_labeled(spark, path, strict_dates=True).select(*columns)


@query
def valid_dataset(spark, root):
    """Modelling columns from validated rows alone."""
    valid = Q.validate(A.faulty_measurements(spark, root))[0]
    return etl.dataset_from_valid(valid)


@query
def load_with_store(spark, root):
    """Load report where every second measurement is already stored."""
    store = A.star(spark, root).monitoreo.filter("id_monitoreo % 2 = 0")
    payload, omitted = G.prepare_load(
        A.unresolved_measurements(spark, root), A.station_catalog(spark, root),
        A.station_mapping(spark, root), store)
    return G.load_report(payload, omitted)


@query
def norm_columns(spark, root):
    """Headers with blanks, capitals and gaps under their contract names."""
    supplier = A.table(spark, root, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    return text.normalize_columns(supplier.toDF(" Id Industria", "NOMBRE ", "Emision Maxima"))


@query
def select_numeric(spark, root):
    """Requested columns that exist, as numbers; unreadable text is NULL."""
    mixed = dataset(spark, root).withColumn("mp10", F.when(
        F.col("no2") % 4 == 0, F.lit("s/d")).otherwise(F.col("no2").cast("int").cast("string")))
    return S.select_numeric(mixed, ["mp25", "mp10", "no_existe"])
