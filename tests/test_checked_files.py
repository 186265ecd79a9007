"""Broken records are set aside with a reason, none is lost."""

import datetime as dt
import os

from dockcast.sources import checked
from dockcast.sources.panel_files import PANEL_SCHEMA


def _file(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)
    return path


def test_csv_records(spark, tmpdir_path):
    path = _file(f"{tmpdir_path}/p/a.csv", "station_id,x,capacity,ts,bikes_available\n"
                 "1,,20,2024-01-01 00:05:00,3\n"
                 "2,,,2024-01-01T02:05:00+02:00,\n"
                 "3,,20,2024-01-01 00:05:00\n"                              # a field short
                 "4,,20,2024-01-01 00:05:00,3,9\n"                          # one too many
                 "5,,20,yesterday,3\n"
                 "6,,many,2024-01-01 00:05:00,3\n"
                 ",,20,2024-01-01 00:05:00,3\n"
                 "8,,20,,3\n")
    df = checked.read_csv(spark, path, PANEL_SCHEMA, ["ts", "station_id"])
    at = dt.datetime(2024, 1, 1, 0, 5)
    assert {tuple(r) for r in checked.good(df).select("station_id", "ts", "bikes_available", "capacity").collect()} == {("1", at, 3.0, 20.0), ("2", at, None, None)}
    assert {(r.reject, r.n) for r in checked.reject_counts(df).collect()} == {
        ("fields differ from the header", 2), ("unreadable ts", 1), ("unreadable capacity", 1), ("no station_id", 1), ("no ts", 1)}
    assert "5,,20,yesterday,3" in {r.raw for r in checked.rejects(df).collect()}


def test_weather_documents(spark, tmpdir_path):
    good = '{"hourly": {"time": ["2024-01-01T00:00", "later"], "temperature_2m": [1.5, 2.5], "precipitation": [0.0, null]}}'
    path = _file(f"{tmpdir_path}/w/a.json", "\n".join([
        good, '{"hourly": {"time": ["2024-01-01T00:00"], "temperature_2m": [1.5, 2.5]}}', '{"hourly": {"temperature_2m": [1.5]}}', '{"hourly": ', ""]))
    df = checked.read_hourly_documents(spark, path)
    assert [tuple(r) for r in checked.good(df).collect()] == [(dt.datetime(2024, 1, 1), 1.5, 0.0, None)]
    assert {(r.reject, r.n) for r in checked.reject_counts(df).collect()} == {
        ("unreadable time", 1), ("arrays of unequal length", 1), ("no times", 1), ("not a document", 1)}
    whole = _file(f"{tmpdir_path}/m/a.json", good.replace(", ", ",\n"))
    assert checked.good(checked.read_hourly_documents(spark, whole, multi_line=True)).count() == 1
