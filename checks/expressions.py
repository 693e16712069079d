"""Table expressions of the checking SQL; each mirrors a source of ``checks.tables`` or a result."""

from __future__ import annotations

SERVICES = ("yellow", "green", "hvfhv")
TARGETS = tuple(f"target_{s}" for s in SERVICES)
CITY = tuple(f"{t}_city_hour_pickups" for t in TARGETS)
NEIGHBOR = tuple(f"neighbor_pickups_{t}" for t in TARGETS)


def rounded(expr: str, name: str, digits: int = 6) -> str:
    scale = f"1e{digits}"
    return f"round_even(({expr}) * {scale}, 0) / {scale} AS {name}"


def lags(cols, ks, window="PARTITION BY zone_id ORDER BY bin") -> str:
    return ", ".join(
        f"coalesce(lag({c}, {k}) OVER ({window}), 0) AS {c}_lag_{k}h" for c in cols for k in ks
    )


def calendar(ts: str) -> dict[str, str]:
    md = f"(month({ts}) * 100 + day({ts}))"
    dow = f"(isodow({ts}) - 1)"
    return {
        "parts": f"""CAST(year({ts}) AS INTEGER) AS pickup_year, CAST(month({ts}) AS INTEGER) AS pickup_month,
            CAST(day({ts}) AS INTEGER) AS day_of_month, CAST(hour({ts}) AS INTEGER) AS pickup_hour,
            CAST({dow} AS INTEGER) AS day_of_week, strftime({ts}, '%Y-%m-%d %H:%M:%S') AS bin_str""",
        "flags": f"""CAST({dow} >= 5 AS TINYINT) AS is_weekend,
            CAST(hour({ts}) BETWEEN 7 AND 9 OR hour({ts}) BETWEEN 16 AND 19 AS TINYINT) AS is_rush_hour,
            CAST(hour({ts}) <= 6 OR hour({ts}) >= 20 AS TINYINT) AS is_night_hour""",
        "season": f"""CASE WHEN month({ts}) IN (12, 1, 2) THEN 'winter' WHEN month({ts}) <= 5 THEN 'spring'
            WHEN month({ts}) <= 8 THEN 'summer' ELSE 'autumn' END AS season_of_year""",
        "holiday": f"""CAST({md} IN (101, 704, 1111, 619, 1225)
            OR (month({ts}) = 11 AND {dow} = 3 AND CAST({ts} AS DATE) + 7 > make_date(year({ts}), 11, 30))
            OR (month({ts}) = 5 AND {dow} = 0 AND CAST({ts} AS DATE) + 7 > make_date(year({ts}), 5, 31))
            OR (month({ts}) = 1 AND {dow} = 0 AND day({ts}) BETWEEN 15 AND 21)
            OR (month({ts}) = 9 AND {dow} = 0 AND day({ts}) <= 7)
            OR (month({ts}) = 11 AND {dow} = 1 AND day({ts}) <= 7)
            OR (month({ts}) = 10 AND {dow} = 0 AND day({ts}) BETWEEN 8 AND 14) AS INTEGER) AS is_holiday""",
        "special": f"""CAST({md} IN (317, 704, 604, 1231) OR {md} BETWEEN 605 AND 615
            OR (month({ts}) = 11 AND {dow} = 3 AND CAST({ts} AS DATE) + 7 > make_date(year({ts}), 11, 30))
            OR (month({ts}) = 6 AND {dow} = 6 AND CAST({ts} AS DATE) + 7 > make_date(year({ts}), 6, 30))
            AS INTEGER) AS is_special_event""",
        "payday": f"""CAST(CAST({ts} AS DATE) = last_day({ts}) OR day({ts}) = 15 AS INTEGER) AS is_payday""",
        "serving": f"""CAST(hour({ts}) AS INTEGER) AS pickup_hour,
            CAST(hour({ts}) BETWEEN 7 AND 9 OR hour({ts}) BETWEEN 16 AND 19 AS TINYINT) AS is_rush_hour,
            CAST(month({ts}) AS INTEGER) AS pickup_month, CAST({dow} AS INTEGER) AS day_of_week,
            CAST(NOT hour({ts}) BETWEEN 7 AND 20 AS TINYINT) AS is_night_hour""",
    }


BIN_CALENDAR = calendar("bin")
READINGS = "humidity, precip, windspeed, feelslike, visibility"
_METERED = """ts AS {p}_pickup_datetime, ts + to_minutes(event_id % 50 - 1) AS {p}_dropoff_datetime,
    CAST(user_id AS INTEGER) AS pulocationid, CAST(event_id % 25 AS INTEGER) AS dolocationid,
    value / 10 AS trip_distance"""
_NORMAL = """{p}_pickup_datetime AS pickup_datetime, {p}_dropoff_datetime AS dropoff_datetime, pulocationid,
    dolocationid, trip_distance AS trip_miles,
    (epoch_us({p}_dropoff_datetime) - epoch_us({p}_pickup_datetime)) / 3.6e9 AS trip_duration_hr"""


def forecast(t: str) -> str:
    raw = f"-0.5::DOUBLE + {t}_lag_1h * 40.0::DOUBLE + {t}_lag_24h * 10.5::DOUBLE"
    return f"CAST(round_even(greatest({raw}, 0), 0) AS INTEGER) AS {t}"


BOARD = """(CASE WHEN idx <= 0.0270 THEN 'Low' WHEN idx <= 0.0421 THEN 'Medium' ELSE 'High' END)"""


def board_figures(total: str, idx: str) -> str:
    profit = f"({total} / ({idx} + 0.1::DOUBLE))"
    band = lambda v, limits: "CASE " + " ".join(
        f"WHEN {v} > {limit} THEN {5 - i}" for i, limit in enumerate(limits)
    ) + " ELSE 0 END"
    return f"""{total} AS total_demand,
        CAST({band(total, (200, 120, 60, 20, 0))} AS INTEGER) AS demand_band,
        CAST({band(profit, (1500, 1000, 500, 200, 0))} AS INTEGER) AS profit_band,
        {profit} AS profit, floor({profit} + 0.5::DOUBLE) AS profit_score,
        CASE WHEN {idx} <= 0.0270 THEN 'Low' WHEN {idx} <= 0.0421 THEN 'Medium' ELSE 'High' END AS congestion_level,
        floor(greatest(5.0::DOUBLE, 25.0::DOUBLE - {idx} * 200.0::DOUBLE) * 10.0::DOUBLE + 0.5::DOUBLE) / 10.0::DOUBLE AS speed_estimate"""


_CELL_SUMS = ", ".join(
    f"count(*) FILTER (WHERE service_type = '{s}') AS target_{s}" for s in SERVICES
)

EXPRESSIONS = {
    "yellow_feed": f"SELECT {_METERED.format(p='tpep')} FROM events WHERE event_type IN ('view', 'signup')",
    "green_feed": f"SELECT {_METERED.format(p='lpep')} FROM events WHERE event_type = 'click'",
    "hvfhv_feed": """SELECT ts AS pickup_datetime, ts + to_minutes(event_id % 50 - 1) AS dropoff_datetime,
        CAST(user_id AS INTEGER) AS pulocationid, CAST(event_id % 25 AS INTEGER) AS dolocationid,
        value / 10 AS trip_miles, CAST((event_id % 50 - 1) * 60 AS BIGINT) AS trip_time
        FROM events WHERE event_type IN ('purchase', 'error')""",
    "norm_trips": f"""SELECT {_NORMAL.format(p='tpep')}, 'yellow' AS service_type FROM yellow_feed
        UNION ALL SELECT {_NORMAL.format(p='lpep')}, 'green' AS service_type FROM green_feed
        UNION ALL SELECT pickup_datetime, dropoff_datetime, pulocationid, dolocationid, trip_miles,
        trip_time / 3600.0::DOUBLE AS trip_duration_hr, 'hvfhv' AS service_type FROM hvfhv_feed""",
    "good_trips": """SELECT *, date_trunc('hour', pickup_datetime) AS bin, pulocationid AS zone_id FROM (
        SELECT *, trip_miles / nullif(trip_duration_hr, 0) AS mph FROM norm_trips
        WHERE trip_duration_hr > 0 AND trip_miles >= 0) WHERE mph BETWEEN 1 AND 60""",
    "trip_cell": f"""SELECT zone_id, bin, {_CELL_SUMS}, avg(mph) AS zone_mph FROM good_trips GROUP BY ALL""",
    "observed_grid": """SELECT * FROM (SELECT DISTINCT bin FROM good_trips)
        CROSS JOIN (SELECT DISTINCT zone_id FROM good_trips)""",
    "span_grid": """SELECT unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS bin, zone_id
        FROM (SELECT min(bin) AS lo, max(bin) AS hi FROM good_trips), (SELECT DISTINCT zone_id FROM good_trips)""",
    "city_mph": "SELECT bin, avg(mph) AS mean_mph FROM good_trips GROUP BY bin",
    "panel": f"""SELECT g.bin, g.zone_id, {", ".join(f"coalesce(c.{t}, 0) AS {t}" for t in TARGETS)},
        {rounded("m.mean_mph", "city_avg_speed", 2)}, {rounded("1 / m.mean_mph", "city_congestion_index", 3)},
        {rounded("coalesce(c.zone_mph, m.mean_mph)", "zone_avg_speed", 2)},
        {rounded("1 / coalesce(c.zone_mph, m.mean_mph)", "zone_congestion_index", 3)}
        FROM observed_grid g LEFT JOIN trip_cell c USING (bin, zone_id) LEFT JOIN city_mph m USING (bin)""",
    "hour_sum": """SELECT date_trunc('hour', ts) AS hr, CAST(sum(event_id) AS BIGINT) AS s,
        CAST(epoch(date_trunc('hour', ts)) AS BIGINT) // 3600 AS h FROM events GROUP BY ALL""",
    "hourly_weather": """SELECT strftime(hr, '%Y-%m-%d') AS day,
        CASE WHEN h % 113 = 7 THEN 'bad' ELSE strftime(hr, '%H:%M:%S') END AS datetime,
        CAST(NULL AS DOUBLE) AS temp, CAST(NULL AS DOUBLE) AS dew, (s * 13 % 1000) / 10.0::DOUBLE AS humidity,
        CASE WHEN h % 5 = 0 THEN NULL ELSE (s % 7) / 10.0::DOUBLE END AS precip, CAST(NULL AS DOUBLE) AS snow,
        (s * 3 % 250) / 10.0::DOUBLE AS windspeed, (s * 7 % 900) / 10.0::DOUBLE AS feelslike,
        CAST(NULL AS DOUBLE) AS snowdepth, CAST(s % 11 AS DOUBLE) AS visibility
        FROM hour_sum WHERE h % 97 <> 50""",
    "binned_weather": """SELECT * EXCLUDE (day), try_cast(day || ' ' || datetime AS TIMESTAMP) AS bin
        FROM hourly_weather""",
    "current_docs": f"""SELECT hr + INTERVAL 5 MINUTE AS observed_at, strftime(hr, '%H') || ':05:00' AS datetime,
        (s * 13 % 1000) / 10.0::DOUBLE AS humidity,
        CASE WHEN h % 5 = 0 THEN NULL ELSE (s % 7) / 10.0::DOUBLE END AS precip,
        (s * 3 % 250) / 10.0::DOUBLE AS windspeed, (s * 7 % 900) / 10.0::DOUBLE AS feelslike,
        CAST(s % 11 AS DOUBLE) AS visibility FROM hour_sum WHERE h % 97 <> 50""",
    "zone_names": """SELECT CAST(c_custkey AS INTEGER) AS zone_id,
        CASE WHEN c_custkey % 23 = 22 THEN '' ELSE 'Zone ' || c_custkey END AS zone,
        CASE WHEN c_custkey % 29 = 22 THEN 'NOWHERE' ELSE r_name END AS borough
        FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey""",
    "readings": """SELECT CASE WHEN o_custkey % 3 = 0 THEN 'bridge approach'
        WHEN o_orderkey % 2 = 0 THEN 'RAMP ZONE ' || o_custkey || ' NB' ELSE 'ramp zone ' || o_custkey || ' nb' END AS link_name,
        r_name AS borough, CASE WHEN o_orderkey % 17 = 0 OR o_custkey % 41 = 5 THEN 'n/a'
        ELSE CAST(CAST(floor(o_totalprice / 10000) AS BIGINT) AS VARCHAR) END AS speed, o_orderkey // 50 AS data_as_of
        FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
        JOIN region ON r_regionkey = n_regionkey""",
    "boxes": """SELECT zone_id, x, y, x + w AS x2, y + h AS y2 FROM (SELECT CAST(c_custkey AS INTEGER) AS zone_id,
        CASE WHEN c_custkey % 50 = 0 THEN 1000 + 3.0 * c_custkey WHEN c_custkey % 17 = 0 THEN (c_custkey - 1) % 40
             WHEN c_custkey % 13 = 0 THEN c_custkey % 40 + 0.5 ELSE c_custkey % 40 END AS x,
        CASE WHEN c_custkey % 17 = 0 AND c_custkey % 50 <> 0 THEN (c_custkey - 1) // 40
             WHEN c_custkey % 13 = 0 AND c_custkey % 50 <> 0 THEN c_custkey // 40 + 0.5 ELSE c_custkey // 40 END AS y,
        CASE WHEN c_custkey % 11 = 0 THEN 2.0 ELSE 1.0 END AS w,
        CASE WHEN c_custkey % 7 = 0 THEN 0.5 ELSE 1.0 END AS h FROM customer)""",
    "part_boxes": """SELECT CAST(k - 800 * (k // 800 % 2) AS INTEGER) AS zone_id, k % 5 = 0 AND k % 13 <> 4 AS frame, p % 40 * 3 + i AS x, p // 40 * 3 + i AS y,
        CASE WHEN k % 35 = 7 THEN 3.5 ELSE s END AS w, s AS h
        FROM (SELECT *, CASE WHEN k % 5 = 1 OR k % 13 = 4 THEN k - 1 ELSE k END AS p,
        CASE WHEN k % 5 = 1 THEN CASE WHEN k % 11 = 3 THEN 1.25 ELSE 1.0 END WHEN k % 13 = 4 THEN 0.5 ELSE 0.0 END::DOUBLE AS i,
        CASE WHEN k % 5 = 1 THEN CASE WHEN k % 11 = 3 THEN 0.5 ELSE 1.0 END WHEN k % 13 = 4 THEN 0.25 ELSE 3.0 END::DOUBLE AS s
        FROM (SELECT c_custkey AS k FROM customer))""",
    "part_pieces": """SELECT zone_id, x, y, x + w AS x2, y + h AS y2 FROM part_boxes WHERE NOT frame
        UNION ALL SELECT zone_id, x + a, y + b, x + c, y + d FROM part_boxes,
        (VALUES (0, 0, 3, 1), (0, 2, 3, 3), (0, 0, 1, 3), (2, 0, 3, 3)) AS bars(a, b, c, d) WHERE frame""",
    "adjacency": """SELECT a.zone_id, b.zone_id AS neighbor_id FROM boxes a JOIN boxes b ON a.zone_id <> b.zone_id
        AND a.x <= b.x2 AND b.x <= a.x2 AND a.y <= b.y2 AND b.y <= a.y2
        AND NOT (a.x < b.x2 AND b.x < a.x2 AND a.y < b.y2 AND b.y < a.y2)""",
    "neighbor_sums": f"""SELECT e.zone_id, p.bin, {", ".join(f"CAST(sum(p.{t}) AS BIGINT) AS neighbor_pickups_{t}" for t in TARGETS)}
        FROM adjacency e JOIN panel p ON p.zone_id = e.neighbor_id GROUP BY ALL""",
    "city_sums": f"""SELECT bin, {", ".join(f"CAST(sum({t}) AS BIGINT) AS {t}_city_hour_pickups" for t in TARGETS)}
        FROM panel GROUP BY bin""",
    "neighbor_panel": f"""SELECT p.*, {", ".join(f"coalesce(n.{c}, 0) AS {c}" for c in NEIGHBOR)}
        FROM panel p LEFT JOIN neighbor_sums n USING (zone_id, bin)""",
    "full_panel": f"""SELECT n.*, c.* EXCLUDE (bin), w.* EXCLUDE (bin), {BIN_CALENDAR["parts"]}, {BIN_CALENDAR["flags"]},
        {BIN_CALENDAR["season"]}, {BIN_CALENDAR["holiday"]}, {BIN_CALENDAR["special"]}, {BIN_CALENDAR["payday"]},
        {lags(TARGETS + CITY + NEIGHBOR, (1, 24))}
        FROM neighbor_panel n JOIN city_sums c USING (bin) LEFT JOIN binned_weather w USING (bin)""",
    "lagged": f"SELECT *, {lags(TARGETS, (1, 24))} FROM panel",
    "forecasts": f"""SELECT bin, zone_id, {READINGS}, {BIN_CALENDAR["serving"]}, zone_congestion_index,
        city_congestion_index, {", ".join(forecast(t) for t in TARGETS)}
        FROM lagged LEFT JOIN binned_weather USING (bin)""",
    "served": "SELECT * FROM forecasts WHERE bin = TIMESTAMP '2024-01-20 12:00:00'",
    "board": f"""SELECT *, {board_figures("(target_yellow + target_green + target_hvfhv)", "zone_congestion_index")}
        FROM (SELECT z.zone_id, z.zone, z.borough, {", ".join(f"coalesce(s.{t}, 0) AS {t}" for t in TARGETS)},
              coalesce(s.zone_congestion_index, 0) AS zone_congestion_index
              FROM zone_names z LEFT JOIN served s USING (zone_id))""",
    "history_log": f"""SELECT p.* EXCLUDE ({", ".join(TARGETS)}, city_avg_speed, zone_avg_speed),
        {", ".join(f"CAST({t} AS DOUBLE) AS {t}" for t in TARGETS)}, {READINGS}, {BIN_CALENDAR["serving"]}
        FROM panel p LEFT JOIN binned_weather USING (bin)""",
    "recent": """SELECT * FROM history_log
        WHERE bin >= TIMESTAMP '2024-01-19 12:00:00' AND bin < TIMESTAMP '2024-01-20 12:00:00'""",
    "latest": "SELECT * FROM readings ORDER BY data_as_of DESC, link_name, borough, speed LIMIT 2000",
}


def road_speed(zones: str, feed: str) -> str:
    return f"""SELECT z.zone_id, CASE WHEN count(l.link_name) > 0 THEN avg(try_cast(l.speed AS DOUBLE))
        ELSE max(b.borough_speed) END AS zone_avg_speed
        FROM {zones} z LEFT JOIN {feed} l ON z.zone <> '' AND contains(lower(l.link_name), lower(z.zone))
        LEFT JOIN (SELECT borough, avg(try_cast(speed AS DOUBLE)) AS borough_speed FROM {feed} GROUP BY borough) b
        ON b.borough = z.borough GROUP BY z.zone_id"""
