"""Store, scoring and serving."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import tables
from checks.expressions import BIN_CALENDAR, CITY, NEIGHBOR, READINGS, TARGETS, board_figures, lags, road_speed, rounded
from checks.registry import query
from zonecast.functions.times import naive
from zonecast.operators import scoring, serving
from zonecast.operators.calendars import calendar_parts
from zonecast.operators.lags import city_demand, dedup_history, lag_features, serving_lags
from zonecast.operators.panel import hourly_targets, panel_full
from zonecast.operators.spatial import neighbor_demand
from zonecast.operators.weather import current_weather, current_weather_bin
from zonecast.plans.features import save_feature_panel
from zonecast.plans.scoring import scoring_rows
from zonecast.schemas import BIN, CITY_DEMAND, NEIGHBOR_DEMAND, ZONE
from zonecast.session import new_stage_path, stage
from zonecast.sources import store
from zonecast.sources.feeds import scan_zone_lookup

HALF = "TIMESTAMP '2024-01-16'"
FIRST = "TIMESTAMP '2024-01-10'"


def _panel(spark: SparkSession, sf: str) -> DataFrame:
    return panel_full(tables.trips(spark, sf))


def _keyed(spark: SparkSession, sf: str) -> DataFrame:
    return calendar_parts(hourly_targets(tables.trips(spark, sf)))


@query(
    "upsert_features",
    f"""SELECT bin, zone_id, {BIN_CALENDAR['parts']}, CASE WHEN bin >= {FIRST} THEN target_yellow + 100 ELSE target_yellow END AS target_yellow,
        target_green, target_hvfhv FROM panel""",
)
def upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Two overlapping halves; the later write changes the overlap, and is repeated."""
    path = new_stage_path(spark, "features")
    rows = stage(_keyed(spark, sf), "keyed")
    later = rows.where(F.col(BIN) >= naive("2024-01-10")).withColumn(
        "target_yellow", F.col("target_yellow") + 100
    )
    store.upsert_features(rows.where(F.col(BIN) < naive("2024-01-16")), path)
    store.upsert_features(later, path)
    return store.upsert_features(later, path)


@query(
    "read_features",
    f"SELECT bin, zone_id, target_yellow, target_green FROM panel WHERE bin >= {FIRST} AND bin <= {HALF}",
)
def read(spark: SparkSession, sf: str) -> DataFrame:
    path = new_stage_path(spark, "features")
    named = _keyed(spark, sf).withColumnRenamed("target_green", "store_target_green")
    save_feature_panel(named, path)
    return store.read_features(
        spark, path, [BIN, ZONE, "target_yellow", "target_green"], "2024-01-10", "2024-01-16", prefix="store_"
    )


@query(
    "read_widened",
    f"""SELECT bin, zone_id, target_yellow, CASE WHEN bin >= {HALF} THEN CAST(target_green * 2 AS DOUBLE) END AS twice FROM panel""",
)
def widened(spark: SparkSession, sf: str) -> DataFrame:
    """A column that only the later rows were written with; the middle ones come as deltas."""
    path = new_stage_path(spark, "features")
    rows = stage(_keyed(spark, sf), "keyed")
    bin = F.col(BIN)
    store.upsert_features(rows.where(bin < naive("2024-01-16")), path)
    store.append_delta(rows.where(bin >= naive("2024-01-16")).withColumn("twice", F.col("target_green") * 2.0), path)
    return store.read_features(spark, path, [BIN, ZONE, "target_yellow", "twice"])


@query(
    "append_predictions",
    f"""SELECT bin, zone_id, {READINGS}, CAST(pickup_hour AS SMALLINT) AS pickup_hour, is_rush_hour,
        CAST(pickup_month AS SMALLINT) AS pickup_month, CAST(day_of_week AS SMALLINT) AS day_of_week, is_night_hour,
        CAST(zone_congestion_index AS FLOAT) AS zone_congestion_index, CAST(city_congestion_index AS FLOAT) AS city_congestion_index,
        {', '.join(f'coalesce(f.{t}, h.{t}) AS {t}' for t in TARGETS)}, strftime(bin, '%Y-%m-%d %H:%M:%S') AS bin_str, strftime(bin, '%Y-%m-%d') AS bin_date
        FROM history_log h LEFT JOIN (SELECT bin, zone_id, {', '.join(f'CAST({t} AS DOUBLE) AS {t}' for t in TARGETS)}
        FROM forecasts WHERE bin >= {FIRST}) f USING (bin, zone_id)""",
)
def append(spark: SparkSession, sf: str) -> DataFrame:
    """The first run writes forecasts and history, the second later forecasts."""
    path = new_stage_path(spark, "log")
    pred = stage(store.prediction_schema(tables.forecasts(spark, sf)), "forecasts")
    hist = store.prediction_schema(tables.history_log(spark, sf))
    bin = F.col(BIN)
    store.append_predictions(
        pred.where((bin >= naive("2024-01-10")) & (bin < naive("2024-01-16"))), hist, path
    )
    log = store.append_predictions(pred.where(bin >= naive("2024-01-16")), hist, path)
    return log.withColumn("bin_date", F.col("bin_date").cast("string"))


@query("artifact_roundtrip", """SELECT 'panel' AS artifact, count(*) AS row_count, CAST(sum(target_yellow + target_green + target_hvfhv) AS BIGINT) AS trips,
        CAST(sum(CAST(round_even(zone_avg_speed * 100, 0) AS BIGINT)) AS BIGINT) AS reading FROM panel
        UNION ALL SELECT 'weather', count(*), count(precip), CAST(sum(CAST(round_even(humidity * 100, 0) AS BIGINT)) AS BIGINT) FROM hourly_weather""")
def artifacts(spark: SparkSession, sf: str) -> DataFrame:
    folder = new_stage_path(spark, "artifacts")
    store.save_artifacts(_panel(spark, sf), tables.hourly_weather(spark, sf), folder)
    panel, weather = store.load_artifacts(spark, folder)
    hundredths = lambda name: F.sum(F.rint(F.col(name) * 100).cast("bigint")).alias("reading")
    demand = F.sum(F.col("target_yellow") + F.col("target_green") + F.col("target_hvfhv"))
    first = panel.agg(
        F.lit("panel").alias("artifact"), F.count(F.lit(1)).alias("row_count"), demand.alias("trips"),
        hundredths("zone_avg_speed"),
    )
    second = weather.agg(
        F.lit("weather").alias("artifact"), F.count(F.lit(1)).alias("row_count"),
        F.count("precip").alias("trips"), hundredths("humidity"),
    )
    return first.unionByName(second)


@query(
    "prediction_schema",
    f"""SELECT bin, zone_id, {READINGS}, CAST(pickup_hour AS SMALLINT) AS pickup_hour,
        is_rush_hour, CAST(pickup_month AS SMALLINT) AS pickup_month, CAST(day_of_week AS SMALLINT) AS day_of_week, is_night_hour,
        CAST(zone_congestion_index AS FLOAT) AS zone_congestion_index, CAST(city_congestion_index AS FLOAT) AS city_congestion_index,
        {', '.join(f'CAST({t} AS DOUBLE) AS {t}' for t in TARGETS)}, strftime(bin, '%Y-%m-%d %H:%M:%S') AS bin_str FROM forecasts""",
)
def typed(spark: SparkSession, sf: str) -> DataFrame:
    return store.prediction_schema(tables.forecasts(spark, sf).withColumn("index", F.lit(0)))


@query("history_window", "SELECT bin, zone_id, target_yellow FROM recent")
def recent(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.history_window(tables.history_log(spark, sf), tables.AS_OF).select(
        BIN, ZONE, "target_yellow"
    )


@query(
    "history_fallback",
    "SELECT bin + INTERVAL 1 YEAR AS bin, zone_id, target_yellow FROM recent",
)
def fallback(spark: SparkSession, sf: str) -> DataFrame:
    log = tables.history_log(spark, sf).select(BIN, ZONE, "target_yellow")
    later = datetime(2025, 1, 20, 12, 10)
    return scoring.history_fallback(scoring.history_window(log, later), log, later)


_NOW = f"""(SELECT TIMESTAMP '2024-01-20 12:00:00' AS bin, {READINGS} FROM current_docs
    WHERE observed_at <= TIMESTAMP '2024-01-20 12:00:00' ORDER BY observed_at DESC LIMIT 1)"""


def _now(spark: SparkSession, sf: str) -> DataFrame:
    docs = tables.current_documents(spark, sf).where("document <> '{}'")
    return scoring.weather_before(docs, "2024-01-20 12:00:00")


@query("candidate_rows", f"SELECT zone_id, w.* FROM (SELECT DISTINCT zone_id FROM recent), {_NOW} w")
def candidates(spark: SparkSession, sf: str) -> DataFrame:
    history = scoring.history_window(tables.history_log(spark, sf), tables.AS_OF)
    now = current_weather_bin(current_weather(_now(spark, sf)), tables.AS_OF.date())
    return scoring.candidate_rows(history, now)


@query(
    "zone_lookup",
    "SELECT t.zone_id, t.bin, t.service_type, z.zone, z.borough FROM good_trips t LEFT JOIN zone_names z USING (zone_id)",
)
def named(spark: SparkSession, sf: str) -> DataFrame:
    rows = tables.trips(spark, sf).select(F.col("pulocationid").alias(ZONE), BIN, "service_type")
    return scoring.zone_lookup(rows, tables.lookup(spark, sf))


@query("scan_zone_lookup", "SELECT zone_id AS locationid, nullif(zone, '') AS zone, borough FROM zone_names")
def lookup_file(spark: SparkSession, sf: str) -> DataFrame:
    """The zone lookup as a CSV file with a header; such a file does not tell an empty name from none."""
    path = new_stage_path(spark, "lookup")
    tables.lookup(spark, sf).write.csv(path, header=True)
    return scan_zone_lookup(spark, path)


@query("latest_readings", "SELECT * FROM latest")
def newest(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.latest_readings(tables.road_readings(spark, sf), 2000)


@query(
    "borough_speed",
    f"SELECT borough, {rounded('avg(try_cast(speed AS DOUBLE))', 'borough_speed')} FROM readings GROUP BY borough",
)
def boroughs(spark: SparkSession, sf: str) -> DataFrame:
    return tables.rounded(scoring.borough_speed(tables.road_readings(spark, sf)), "borough_speed")


@query(
    "zone_road_speed",
    f"SELECT zone_id, {rounded('zone_avg_speed', 'zone_avg_speed')} FROM ({road_speed('zone_names', 'readings')})",
)
def roads(spark: SparkSession, sf: str) -> DataFrame:
    speeds = scoring.zone_road_speed(tables.zones(spark, sf), tables.road_readings(spark, sf))
    return tables.rounded(speeds, "zone_avg_speed")


def congestion_sql(source: str) -> str:
    return f"""SELECT * EXCLUDE (zone_avg_speed, c, c2, z, g, gz),
        CASE WHEN c2 > 0 THEN 1 / c2 ELSE 1 / g END AS city_congestion_index,
        CASE WHEN z > 0 THEN 1 / nullif(z, 0) ELSE 1 / gz END AS zone_congestion_index
        FROM (SELECT *, avg(z) OVER () AS gz FROM (SELECT *, coalesce(zone_avg_speed, c2) AS z
        FROM (SELECT *, coalesce(c, g) AS c2 FROM (SELECT *, avg(c) OVER () AS g
        FROM (SELECT *, avg(zone_avg_speed) OVER (PARTITION BY bin) AS c FROM {source})))))"""


_UNEVEN = """(SELECT bin, zone_id, CASE WHEN zone_id % 5 = 0 OR hour(bin) = 3 THEN NULL WHEN zone_id % 7 = 0 THEN 0 ELSE zone_avg_speed END AS zone_avg_speed
    FROM panel)"""


@query(
    "serving_congestion",
    f"""SELECT bin, zone_id, {rounded('city_congestion_index', 'city_congestion_index')},
        {rounded('zone_congestion_index', 'zone_congestion_index')} FROM ({congestion_sql(_UNEVEN)})""",
)
def congestion(spark: SparkSession, sf: str) -> DataFrame:
    missing = (F.col(ZONE) % 5 == 0) | (F.hour(BIN) == 3)
    speed = F.when(missing, None).when(F.col(ZONE) % 7 == 0, 0.0).otherwise(F.col("zone_avg_speed"))
    rows = _panel(spark, sf).select(BIN, ZONE, speed.alias("zone_avg_speed"))
    return tables.rounded(
        scoring.serving_congestion(rows), "city_congestion_index", "zone_congestion_index"
    )


_DEDUP = """SELECT bin, zone_id, max(origin) AS origin FROM (
    SELECT bin, zone_id, 'history' AS origin FROM panel WHERE hour(bin) < 20
    UNION ALL SELECT bin, zone_id, 'candidate' FROM panel WHERE hour(bin) >= 18) GROUP BY bin, zone_id"""


@query("dedup_history", _DEDUP)
def deduplicated(spark: SparkSession, sf: str) -> DataFrame:
    rows = _panel(spark, sf).select(BIN, ZONE)
    return dedup_history(
        rows.where(F.hour(BIN) < 20).withColumn("origin", F.lit("history")),
        rows.where(F.hour(BIN) >= 18).withColumn("origin", F.lit("candidate")),
    )


_SERVING_LAGS = f"""SELECT bin, zone_id, {lags(TARGETS, (1, 24))}, {lags(CITY + NEIGHBOR, (1,))}
    FROM (SELECT bin, zone_id, {', '.join(TARGETS + CITY + NEIGHBOR)} FROM neighbor_panel JOIN city_sums USING (bin)
    UNION ALL SELECT DISTINCT TIMESTAMP '2024-02-01 00:00:00', zone_id, {', '.join(['NULL'] * 9)} FROM panel)"""


@query("serving_lags", _SERVING_LAGS)
def lagged(spark: SparkSession, sf: str) -> DataFrame:
    dense = city_demand(stage(hourly_targets(tables.trips(spark, sf)), "targets"))
    history = stage(neighbor_demand(dense, tables.edges(spark, sf)), "history")
    ahead = history.select(ZONE).distinct().withColumn(BIN, naive("2024-02-01"))
    return serving_lags(history, ahead).drop(*TARGETS, *CITY_DEMAND, *NEIGHBOR_DEMAND)


@query(
    "scoring_frame",
    f"""SELECT bin, zone_id, zone_congestion_index, city_congestion_index, {', '.join(f'{t}_lag_{k}h' for t in TARGETS for k in (1, 24))}
        FROM lagged WHERE bin = TIMESTAMP '2024-01-20 12:00:00'""",
)
def frame(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.scoring_frame(lag_features(_panel(spark, sf), TARGETS), tables.SERVED_HOUR)


@query(
    "clean_forecast",
    "SELECT event_id, CAST(round_even(greatest(value * 4 - 10.5::DOUBLE, 0), 0) AS INTEGER) AS forecast FROM events",
)
def cleaned(spark: SparkSession, sf: str) -> DataFrame:
    raw = tables.table(spark, sf, "events").select(
        "event_id", (F.col("value") * 4 - 10.5).alias("forecast")
    )
    return scoring.clean_forecast(raw, ["forecast"])


_HISTORY = f"""(SELECT r.*, {', '.join(f'sum({t}) OVER (PARTITION BY bin) AS {t}_city_hour_pickups' for t in TARGETS)},
    {', '.join(f'coalesce(n_{t}, 0) AS neighbor_pickups_{t}' for t in TARGETS)}
    FROM recent r LEFT JOIN (SELECT a.zone_id, q.bin, {', '.join(f'sum(q.{t}) AS n_{t}' for t in TARGETS)}
    FROM adjacency a JOIN recent q ON q.zone_id = a.neighbor_id GROUP BY ALL) USING (zone_id, bin))"""
_CANDIDATES = f"""(SELECT * FROM ({congestion_sql(f'''(SELECT z.zone_id, w.*, s.zone_avg_speed
    FROM (SELECT DISTINCT zone_id FROM recent) z CROSS JOIN {_NOW} w LEFT JOIN
    ({road_speed('zone_names', 'readings')}) s USING (zone_id))''')}))"""
_NOTHING = ", ".join(f"NULL::DOUBLE AS {c}" for c in TARGETS + CITY + NEIGHBOR)
_LAST_ROWS = f"""SELECT bin, zone_id, {READINGS}, city_congestion_index, zone_congestion_index,
    {lags(TARGETS, (1, 24))}, {lags(CITY + NEIGHBOR, (1,))}
    FROM (SELECT bin, zone_id, {READINGS}, city_congestion_index, zone_congestion_index, {', '.join(TARGETS + CITY + NEIGHBOR)} FROM {_HISTORY}
    UNION ALL SELECT bin, zone_id, {READINGS}, city_congestion_index, zone_congestion_index, {_NOTHING} FROM {_CANDIDATES})"""
_COEFS = {
    t: {
        f"{t}_lag_1h": 40.0, f"{t}_lag_24h": 10.5, f"{t}_city_hour_pickups_lag_1h": 0.25,
        f"neighbor_pickups_{t}_lag_1h": 2.0, "intercept": -0.5,
    }
    for t in TARGETS
}


def _weighed(t: str) -> str:
    terms = " + ".join(f"{c} * {w}::DOUBLE" for c, w in _COEFS[t].items() if c != "intercept")
    return f"CAST(round_even(greatest(-0.5::DOUBLE + {terms}, 0), 0) AS INTEGER) AS {t}"


@query(
    "score_linear",
    f"""SELECT bin, zone_id, {READINGS}, {BIN_CALENDAR['serving']}, {rounded('city_congestion_index', 'city_congestion_index')},
        {rounded('zone_congestion_index', 'zone_congestion_index')}, {', '.join(_weighed(t) for t in TARGETS)}
        FROM ({_LAST_ROWS}) WHERE bin = TIMESTAMP '2024-01-20 12:00:00'""",
)
def scored(spark: SparkSession, sf: str) -> DataFrame:
    """The whole scoring job with a fixed linear model."""
    log = stage(tables.history_log(spark, sf), "log")
    rows = scoring_rows(
        log, log, _now(spark, sf), tables.road_readings(spark, sf), tables.lookup(spark, sf),
        tables.edges(spark, sf), tables.AS_OF,
    )
    result = scoring.score_linear(rows, _COEFS)
    lag_columns = [c for c in result.columns if "_lag_" in c]
    return tables.rounded(
        result.drop(*lag_columns), "city_congestion_index", "zone_congestion_index"
    )


_SERVED = f"zone_id, {READINGS}, zone_congestion_index, city_congestion_index, {', '.join(TARGETS)}"


@query("serving_rows", f"SELECT strftime(bin, '%Y-%m-%d %H:%M:%S') AS bin, {_SERVED} FROM served")
def rows(spark: SparkSession, sf: str) -> DataFrame:
    return serving.serving_rows(tables.forecasts(spark, sf), tables.SERVED_HOUR)


@query(
    "serving_document",
    f"""SELECT '2024-01-20T12:10:00' AS generated_at, (SELECT count(*) FROM served) AS total_zones,
        strftime(bin, '%Y-%m-%d %H:%M:%S') AS prediction_window, strftime(bin, '%Y-%m-%d %H:%M:%S') AS bin, {_SERVED} FROM served""",
)
def document(spark: SparkSession, sf: str) -> DataFrame:
    """The documents, read back from their JSON text."""
    pred = tables.forecasts(spark, sf)
    pages = serving.serving_document(pred, tables.SERVED_HOUR, "2024-01-20T12:10:00")
    row = ", ".join(f"{name}: {kind}" for name, kind in pred.select(*serving.SERVED).dtypes)
    schema = f"""metadata struct<generated_at: string, total_zones: bigint, prediction_window: string>,
        predictions map<string, struct<bin: string, {row}>>"""
    parsed = pages.select(F.from_json("document", schema).alias("d"))
    entries = parsed.select("d.metadata.*", F.explode("d.predictions").alias(ZONE, "row"))
    return entries.select("*", "row.*").drop("row").withColumn(ZONE, F.col(ZONE).cast("int"))


@query(
    "congestion_level",
    """SELECT bin, zone_id, zone_congestion_index, CASE WHEN zone_congestion_index <= 0.0270 THEN 'Low'
        WHEN zone_congestion_index <= 0.0421 THEN 'Medium' ELSE 'High' END AS congestion_level FROM panel""",
)
def level(spark: SparkSession, sf: str) -> DataFrame:
    return serving.congestion_level(_panel(spark, sf).select(BIN, ZONE, "zone_congestion_index"))


@query(
    "speed_estimate",
    """SELECT bin, zone_id, zone_congestion_index, floor(greatest(5.0::DOUBLE, 25.0::DOUBLE - zone_congestion_index * 200.0::DOUBLE)
        * 10.0::DOUBLE + 0.5::DOUBLE) / 10.0::DOUBLE AS speed_estimate FROM panel""",
)
def estimate(spark: SparkSession, sf: str) -> DataFrame:
    return serving.speed_estimate(_panel(spark, sf).select(BIN, ZONE, "zone_congestion_index"))


_TOTAL = "(target_yellow + target_green + target_hvfhv)"


@query(
    "profit_score",
    f"""SELECT bin, zone_id, {rounded(f'{_TOTAL} / (zone_congestion_index + 0.1::DOUBLE)', 'profit')},
        floor({_TOTAL} / (zone_congestion_index + 0.1::DOUBLE) + 0.5::DOUBLE) AS profit_score FROM panel""",
)
def profit(spark: SparkSession, sf: str) -> DataFrame:
    scores = serving.profit_score(_panel(spark, sf))
    return tables.rounded(scores.select(BIN, ZONE, "profit", "profit_score"), "profit")


@query(
    "demand_bands",
    f"""SELECT bin, zone_id, total_demand, demand_band, profit_band FROM (SELECT bin, zone_id,
        {board_figures(_TOTAL, 'zone_congestion_index')} FROM forecasts)""",
)
def bands(spark: SparkSession, sf: str) -> DataFrame:
    return serving.demand_bands(tables.forecasts(spark, sf)).select(
        BIN, ZONE, "total_demand", "demand_band", "profit_band"
    )


def _board(spark: SparkSession, sf: str) -> DataFrame:
    pred = serving.serving_rows(tables.forecasts(spark, sf), tables.SERVED_HOUR)
    return tables.rounded(serving.zone_board(tables.zones(spark, sf), pred), "profit")


_BOARD = f"SELECT * EXCLUDE (profit), {rounded('profit', 'profit')} FROM board"


@query("zone_board", _BOARD)
def board(spark: SparkSession, sf: str) -> DataFrame:
    return _board(spark, sf)


@query("zone_search", f"{_BOARD} WHERE borough = 'ASIA' AND contains(lower(zone), 'e 1')")
def search(spark: SparkSession, sf: str) -> DataFrame:
    return serving.zone_search(_board(spark, sf), "ASIA", "E 1")


@query("zone_detail", f"{_BOARD} WHERE zone_id = 17")
def detail(spark: SparkSession, sf: str) -> DataFrame:
    return serving.zone_detail(_board(spark, sf), 17)


@query("top_demand", f"{_BOARD} ORDER BY total_demand DESC, zone_id LIMIT 20")
def by_demand(spark: SparkSession, sf: str) -> DataFrame:
    return serving.top_demand(_board(spark, sf))


@query("top_profit", f"{_BOARD} ORDER BY profit_score DESC, zone_id LIMIT 20")
def by_profit(spark: SparkSession, sf: str) -> DataFrame:
    return serving.top_profit(_board(spark, sf))


@query(
    "city_header",
    f"""SELECT total_demand, city_congestion_index, feelslike, humidity,
        CASE WHEN city_congestion_index <= 0.0270 THEN 'Low' WHEN city_congestion_index <= 0.0421 THEN 'Medium' ELSE 'High' END AS congestion_level,
        floor(greatest(5.0::DOUBLE, 25.0::DOUBLE - city_congestion_index * 200.0::DOUBLE) * 10.0::DOUBLE + 0.5::DOUBLE) / 10.0::DOUBLE AS city_speed
        FROM (SELECT (SELECT CAST(sum({_TOTAL}) AS BIGINT) FROM served) AS total_demand, city_congestion_index, feelslike, humidity
        FROM served ORDER BY zone_id LIMIT 1)""",
)
def header(spark: SparkSession, sf: str) -> DataFrame:
    return serving.city_header(
        serving.serving_rows(tables.forecasts(spark, sf), tables.SERVED_HOUR)
    )
