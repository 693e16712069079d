from __future__ import annotations

import json
from datetime import datetime

from tests.conftest import rows
from zonecast.operators.weather import (
    current_weather, current_weather_bin, dedup_weather, flatten_weather, panel_weather, weather_bin,
)
from zonecast.schemas import HOURLY_WEATHER
from zonecast.sources.feeds import extract_links, scan_zone_lookup, select_feed_files


def documents(spark, *docs):
    return spark.createDataFrame([(json.dumps(d),) for d in docs], "document string")


def test_flatten_keeps_hours_and_leaves_missing_readings_null(spark):
    doc = {
        "days": [
            {"datetime": "2024-01-01", "hours": [{"datetime": "00:00:00", "temp": 3, "other": 1}]},
            {"datetime": "2024-01-02"},
            {"datetime": "2024-01-03", "hours": []},
        ]
    }
    got = flatten_weather(documents(spark, doc, {"days": []}, {})).collect()
    assert len(got) == 1
    assert (got[0]["day"], got[0]["temp"], got[0]["humidity"]) == ("2024-01-01", 3.0, None)


def test_current_weather(spark):
    now = {"datetime": "12:05:00", "humidity": 40.5}
    got = current_weather(documents(spark, {"currentConditions": now}, {}))
    assert got.count() == 1
    row = current_weather_bin(got, "2024-01-20").first()
    assert (row["bin"], row["humidity"], row["precip"]) == (datetime(2024, 1, 20, 13), 40.5, None)


def hourly(spark, *cases):
    """(day, clock, humidity)"""
    data = [tuple({"day": d, "datetime": c, "humidity": h}.get(n) for n in HOURLY_WEATHER.names) for d, c, h in cases]
    return spark.createDataFrame(data, HOURLY_WEATHER)


def test_unparseable_hours_have_no_key(spark):
    got = weather_bin(hourly(spark, ("2024-01-01", "bad", 1.0), ("2024-01-01", "03:00:00", 2.0)))
    assert "day" not in got.columns
    assert {r["humidity"]: r["bin"] for r in got.collect()} == {1.0: None, 2.0: datetime(2024, 1, 1, 3)}


def test_repeated_hours_fan_out_unless_deduplicated(spark):
    panel = spark.createDataFrame([(datetime(2024, 11, 3, 1), 1)], "bin timestamp_ntz, zone_id int")
    twice = hourly(spark, ("2024-11-03", "01:00:00", 1.0), ("2024-11-03", "01:00:00", 2.0))
    assert panel_weather(panel, twice).count() == 2
    assert rows(panel_weather(panel, dedup_weather(twice)), "humidity") == [(2.0,)]


def test_links_come_from_anchors_only(spark):
    html = """<head><link href="/style.css"></head><!-- <a href="/hidden">x</a> -->
        <script>var a = '<a href="/code">';</script>
        <a class="b" href="/one?a=1&amp;b=2">1</a> <A HREF='/two'>2</A><a name="x">3</a><a data-href="/no">4</a>"""
    pages = spark.createDataFrame([(1, html)], "page_id bigint, html string")
    assert rows(extract_links(pages)) == [(1, 0, "/one?a=1&b=2"), (1, 1, "/two")]


def test_last_matching_file_wins(spark):
    found = [
        (1, 0, "/d/yellow_tripdata_2024-01.parquet"),
        (1, 1, "https://h/x/YELLOW_tripdata_2024-01.parquet?v=2"),
        (1, 2, "/d/yellow_tripdata_2024-02.parquet"),
        (1, 3, "/d/fhvhv_tripdata_2024-01.parquet"),
        (2, 0, "/d/yellow_tripdata_2024-01.csv"),
    ]
    links = spark.createDataFrame(found, "page_id bigint, position int, href string")
    assert rows(select_feed_files(links, "yellow", "2024-01")) == [(1, found[1][2])]
    assert rows(select_feed_files(links, "hvfhv", "2024-01", "https://h")) == [(1, "https://h" + found[3][2])]


def test_zone_lookup_scan(spark, tmp_path):
    file = tmp_path / "zones.csv"
    file.write_text('LocationID,Zone,Borough\n1,"A, B",North\n')
    assert rows(scan_zone_lookup(spark, str(file))) == [(1, "A, B", "North")]
