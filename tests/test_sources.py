"""File sources: zipped and plain station tables, forecasts, messages, records."""

import os
import zipfile

import pytest

from conftest import rows
from gridmill.operators.quality import malformed_rows
from gridmill.registry import feeds as files
from gridmill.schemas import FORECAST_ELEMENTS, LOAD_MESSAGE
from gridmill.session import checkpointed
from gridmill.sources import archives, climate, forecast
from gridmill.sources.lake import read_records_csv
from gridmill.sources.messages import parse_messages

HEAD = ('<?xml version="1.0"?>\n<kml:kml xmlns:dwd="d" xmlns:kml="k">\n<kml:Document><kml:ExtendedData>'
        "<dwd:ProductDefinition><dwd:ForecastTimeSteps>\n{steps}\n</dwd:ForecastTimeSteps></dwd:ProductDefinition>"
        "</kml:ExtendedData>\n")
PLACE = ("<kml:Placemark>\n<kml:name>{name}</kml:name><kml:description>{station}</kml:description>\n<kml:ExtendedData>{body}"
         "</kml:ExtendedData>\n<kml:Point><kml:coordinates>{coords}</kml:coordinates></kml:Point></kml:Placemark>\n")


def series(element, text):
    return f'<dwd:Forecast dwd:elementName="{element}">\n<dwd:value>  {text}\n  </dwd:value></dwd:Forecast>'


def kml(stations):
    steps = "".join(f"<dwd:TimeStep>2024-01-17T0{i}:00:00.000Z</dwd:TimeStep>" for i in range(3))
    return HEAD.format(steps=steps) + "".join(stations) + "</kml:Document></kml:kml>"


FIRST = PLACE.format(name="1", station="STUTTGART", coords="9.2,48.7,371.0",
                     body=series("TTT", "270.15   -   271.15") + series("FF", "1 2 3") + series("FF", "4 5 6"))
SECOND = PLACE.format(name="2", station="ULM", coords="10,48.4,500", body=series("TTT", "1 2 3"))


def as_kmz(path, text, members=1):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for i in range(members):
            z.writestr(f"forecast{i}.kml", text)


@pytest.mark.parametrize("zipped", [False, True])
def test_forecast_files(spark, work, zipped):
    os.makedirs(work)
    path = f"{work}/f.kmz" if zipped else f"{work}/f.kml"
    if zipped:
        as_kmz(path, kml([FIRST, SECOND]))
    else:
        open(path, "w").write(kml([FIRST, SECOND]))
    places = forecast.read_placemarks(spark, work, zipped)
    steps = forecast.read_steps(spark, work, zipped)
    wide = forecast.forecast_wide(places, steps, list(FORECAST_ELEMENTS), ["STUTTGART"])
    got = rows(wide.selectExpr("cast(forecast_time as string)", "TTT", "FF", "TX"))
    # A repeated element counts with its last series; an element without series is null.
    assert got == [("2024-01-17 00:00:00", 270.15, 4.0, None), ("2024-01-17 01:00:00", None, 5.0, None),
                   ("2024-01-17 02:00:00", 271.15, 6.0, None)]
    assert rows(forecast.station_table(places), "station", "lat", "lng", "ele") == [
        ("STUTTGART", 48.7, 9.2, 371.0), ("ULM", 48.4, 10.0, 500.0)]
    long = forecast.read_forecast_xml(spark, work, ["ULM"], zipped)
    assert rows(long.selectExpr("element", "step", "value", "hour(forecast_time)")) == [
        ("TTT", 0, 1.0, 0), ("TTT", 1, 2.0, 1), ("TTT", 2, 3.0, 2)]


def test_large_kmz_is_read_in_pieces(spark, work, monkeypatch):
    os.makedirs(work)
    many = [PLACE.format(name=str(i), station=f"S{i}", coords="1,2,3", body=series("TTT", "1 2 3")) for i in range(8000)]
    as_kmz(f"{work}/f.kmz", kml(many))
    places = forecast.read_placemarks(spark, f"{work}/f.kmz", True)
    assert places.select("station").distinct().count() == 8000
    assert forecast.read_steps(spark, f"{work}/f.kmz", True).count() == 1


def test_one_large_file_is_read_by_many_tasks(spark, work):
    """Records are cut at placemarks wherever a task begins; the forecast times stand in the first one."""
    os.makedirs(work)
    many = [PLACE.format(name=str(i), station=f"Süd {i}", coords="1,2,3", body=series("TTT", "1 2 3") * (1 + i % 7)) for i in range(4000)]
    open(f"{work}/f.kml", "w").write(kml(many))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        places = forecast.read_placemarks(spark, work)
        assert places.rdd.getNumPartitions() > 8
        assert sorted(r["station"] for r in places.select("station").collect()) == sorted(f"Süd {i}" for i in range(4000))
        assert forecast.read_steps(spark, work).count() == 1
        assert forecast.read_forecast_xml(spark, work).filter("forecast_time IS NOT NULL").count() == 3 * sum(1 + i % 7 for i in range(4000))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("whole", [False, True])
def test_forecast_files_are_written_whole(spark, work, whole):
    long = checkpointed(spark.range(1500 * 5 * 80).selectExpr(
        "concat('U', id % 1500) AS station", "concat('E', id div 1500 % 5) AS element", "cast(id div 7500 AS int) AS step", "cast(id AS double) AS value"))
    # The join of the series with the last steps turns out to be small only when it runs, as with tables of unknown size.
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "10m", "spark.sql.shuffle.partitions": "24"}
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        files.forecast_files(long, f"{work}/in", whole=whole)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    found = spark.read.text(f"{work}/in", wholetext=True).collect()
    assert sorted((r["bucket"], r["issue"]) for r in found) == [(b, 0) for b in range(15)]
    for r in found:
        assert r["value"].startswith("<?xml") and r["value"].endswith("</kml:kml>\n") and r["value"].count("<kml:Placemark>") == 100


def test_kmz_with_two_members_fails(spark, work):
    os.makedirs(work)
    as_kmz(f"{work}/f.kmz", kml([FIRST]), members=2)
    with pytest.raises(Exception, match="must hold one file"):
        forecast.read_placemarks(spark, work, True).collect()


def test_malformed_placemarks(spark, work):
    os.makedirs(work)
    broken = [
        FIRST, PLACE.format(name="3", station="", coords="1,2,3", body=series("TTT", "1")),
        PLACE.format(name="", station="B", coords="1,2,3", body=series("TTT", "1")),
        PLACE.format(name="4", station="C", coords="1,2", body=series("TTT", "1")),
        PLACE.format(name="5", station="D", coords="1,x,3", body=series("TTT", "1")),
        PLACE.format(name="6", station="E", coords="1,2,3", body=series("", "1")),
        PLACE.format(name="7", station="F", coords="1,2,3", body='<dwd:Forecast dwd:elementName="TTT"></dwd:Forecast>'),
    ]
    open(f"{work}/f.kml", "w").write(kml(broken))
    bad = malformed_rows(forecast.read_placemarks(spark, work))
    assert rows(bad, "coordinates", "problem") == rows(spark.createDataFrame([
        ("1,2,3", "description"), ("1,2,3", "name"), ("1,2", "coordinates"), ("1,x,3", "coordinates"),
        ("1,2,3", "element"), ("1,2,3", "values")], "a string, b string"))


TABLE = "STATIONS_ID;MESS_DATUM;QN_9;TT_TU;RF_TU;eor\r\n      44;2024011700;    3;   5.6;  90.0;eor\r\n      44;2024011701;    3;-999.0;  91.0;eor\r\n"


def test_climate_archives(spark, work):
    os.makedirs(work)
    for station, extra in (("00044", ""), ("00071", "")):
        with zipfile.ZipFile(f"{work}/stundenwerte_TU_{station}_akt.zip", "w") as z:
            z.writestr(f"Metadaten_{station}.txt", "Größe;x\n".encode("latin-1"))
            z.writestr(f"produkt_tu_stunde_20220801_20240201_{station}.txt", TABLE.replace("44", station[-2:]).encode("latin-1"))
    df = climate.read_climate_archives(spark, f"{work}/*.zip", "TU")
    assert df.columns == ["STATIONS_ID", "MESS_DATUM", "QN_9", "TT_TU", "RF_TU", "eor"]
    assert rows(df, "STATIONS_ID", "MESS_DATUM", "TT_TU", "eor") == [
        (44, "2024011700", 5.6, "eor"), (44, "2024011701", -999.0, "eor"),
        (71, "2024011700", 5.6, "eor"), (71, "2024011701", -999.0, "eor")]
    with pytest.raises(Exception, match="no member like"):
        climate.read_climate_archives(spark, f"{work}/*.zip", "SD").collect()
    with pytest.raises(ValueError):
        climate.read_climate_archives(spark, f"{work}/*.zip", "XX")


def test_small_archives_are_parsed_together(spark, work):
    """Tables that would read otherwise beside others are parsed alone; folders below are no part of the pattern."""
    def put(name, text):
        with zipfile.ZipFile(f"{work}/{name}.zip", "w") as z:
            z.writestr(f"produkt_tu_stunde_{os.path.basename(name)}.txt", text)

    os.makedirs(f"{work}/below/p=1")
    put("a_1", "A; B\r\n1;x\r\n2;y")
    put("a_2", "A; B\r\n\r\n3; z \r\n4;\r\n")
    put("a_3", "B;A\nq;5\n")
    put("a_4", 'A; B\n6;"p;\nr"\n')
    put("a_5", "A; B\n")
    put("a_6", "A; B\r7;w\r")
    put("below/a_7", "A; B\n8;v\n")
    put("below/p=1/a_8", "A; B\n9;u\n")
    found = archives.archives(spark, f"{work}/*.zip")
    assert found.count() == 6 and len(found.inputFiles()) == 8  # one listing of the folder
    assert archives.csv_headers(found, "produkt", "latin-1").count() == 6
    got = archives.csv_rows(found.coalesce(1), "produkt", ["A", "B"], "latin-1", ";")
    assert rows(got) == [("1", "x"), ("2", "y"), ("3", "z"), ("4", None), ("5", "q"), ("6", "p;\nr"), ("7", "w")]
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        archives.archives(spark, f"{work}/c*.zip").count()


def test_a_station_has_an_archive_or_two(spark, work):
    """Rows of a station that come in many tasks go to one."""
    rows_in = spark.range(0, 4000, 1, 16).selectExpr("id % 50 AS stations_id", "timestamp'2024-01-05 00:00:00' AS ts", "1.5D AS tt_tu", "'eor' AS eor")
    files.climate_archives(rows_in, f"{work}/z")
    assert 50 <= len([f for f in os.listdir(f"{work}/z") if f.endswith(".zip")]) <= 100
    assert climate.read_climate_archives(spark, f"{work}/z/*.zip", "TU").count() == 4000


def test_climate_text(spark, work):
    os.makedirs(work)
    open(f"{work}/t.txt", "wb").write(TABLE.encode("latin-1"))
    df = climate.read_climate_text(spark, work)
    assert rows(df, "STATIONS_ID", "MESS_DATUM", "QN_9", "TT_TU") == [(44, "2024011700", 3.0, 5.6), (44, "2024011701", 3.0, -999.0)]


def test_messages(spark):
    raw = spark.createDataFrame([('{"date": "2024-01-01 00:00:00+00:00", "load": 1.5, "key_id": "record_0"}',),
                                 ('{"date": "2024',), ('{"load": "many"}',)], "value string")
    parsed = parse_messages(raw, LOAD_MESSAGE)
    assert [r["key_id"] for r in parsed.where("_raw is null").collect()] == ["record_0"]
    assert parsed.where("_raw is not null").count() == 2
    with pytest.raises(Exception):
        parse_messages(raw, LOAD_MESSAGE, fail_fast=True).collect()


def test_records_csv(spark, work):
    os.makedirs(work)
    open(f"{work}/r.csv", "w").write("date,load,key_id\n2024-01-01,1.5,a\n2024-01-02,,b\n")
    assert rows(read_records_csv(spark, work, LOAD_MESSAGE)) == [("2024-01-01", 1.5, "a"), ("2024-01-02", None, "b")]
