import datetime as dt

import pytest

from thermalis.operators.ingest import clean
from thermalis.plans import build_observations
from thermalis.schema import OBSERVATIONS
from thermalis.sources import clean_export, read_obs, read_raw, write_obs

HEADER = "system:index,city,date,LST_Day_Urban,LST_Day_Rural,LST_Night_Urban,UHI_Index,.geo\n"


def write(path, text):
    path.write_text(text)
    return str(path)


def test_csv_files_of_all_cities(spark, tmp_path):
    write(tmp_path / "a.csv", HEADER + '0,Pune,2003-03-04,30.5,28.5,20,2.0,"{""type"":""X"",""c"":[1,2]}"\n')
    write(tmp_path / "b.csv", HEADER + "0,Surat,bad,30.5,28.5,,2.0,\n"
                                       "1,Surat,2003-05-06,x,28.5,,2.0,\n"
                                       "2,Surat,2003-05-07,NaN,28.5,,2.0,\n")
    got = {r.city + str(r.date): r for r in build_observations(spark, str(tmp_path / "*.csv")).collect()}
    assert set(got) == {"Pune2003-03-04", "SuratNone", "Surat2003-05-07"}
    pune = got["Pune2003-03-04"]
    assert (pune.year, pune.month, pune.day_of_year, pune.UHI_Index) == (2003, 3, 63, 2.0)
    assert got["SuratNone"].year is None and got["SuratNone"].LST_Night_Urban is None


def test_schema_of_observations(spark, tmp_path):
    path = write(tmp_path / "a.csv", HEADER + "0,Pune,2003-03-04,1,2,3,4,\n")
    got = build_observations(spark, path)
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in OBSERVATIONS]


def test_other_header_raises(spark, tmp_path):
    write(tmp_path / "a.csv", "city,date\nPune,2003-03-04\n")
    write(tmp_path / "b.csv", "date,city\n2003-03-04,Pune\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_raw(spark, str(tmp_path / "*.csv"), "city string, date string").collect()


def test_export_without_date(spark):
    raw = spark.createDataFrame([("Pune", "2003", "3", "1", "2", "3", "4"), ("Pune", "2003", "x", "1", "2", "3", "4")],
                                "city string, year string, month string, LST_Day_Urban string, "
                                "LST_Day_Rural string, LST_Night_Urban string, UHI_Index string")
    assert {r.date for r in clean(raw).collect()} == {dt.date(2003, 3, 1), None}


def test_sentinel_is_kept_unless_named(spark):
    raw = spark.createDataFrame(
        [("a", "2003-01-01", -9999.0, -9999.0, 1.0, 0.0), ("b", "2003-01-01", 30.0, 20.0, -9999.0, 10.0),
         ("c", "2003-01-01", 30.0, 20.0, 15.0, 10.0)],
        "city string, date string, LST_Day_Urban double, LST_Day_Rural double, LST_Night_Urban double, UHI_Index double")
    assert clean(raw).count() == 3
    got = {r.city: r.LST_Night_Urban for r in clean(raw, sentinel=-9999.0).collect()}
    assert got == {"b": None, "c": 15.0}


def test_typed_dates_pass(spark):
    raw = spark.sql("SELECT 'a' AS city, TIMESTAMP '2003-01-02 10:00:00' AS date, 1.0D AS LST_Day_Urban, "
                    "1.0D AS LST_Day_Rural, 1.0D AS LST_Night_Urban, 0.0D AS UHI_Index")
    assert clean(raw).first().date == dt.date(2003, 1, 2)


def test_partitioned_table(spark, obs_of, tmp_path):
    obs = obs_of([("2020", "2003-01-01", 1.0, 2.0, None, 3.0), (None, "2004-01-01", 1.0, 2.0, 3.0, 4.0)])
    write_obs(obs, str(tmp_path / "t"))
    back = read_obs(spark, str(tmp_path / "t"))
    assert back.columns[-2:] == ["city", "year"]
    assert back.select(*obs.columns).exceptAll(obs).isEmpty() and back.count() == 2


def test_hot_partition_is_written_by_several_tasks(spark, tmp_path):
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "200KB",
                "spark.sql.adaptive.coalescePartitions.minPartitionSize": "10KB"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        obs = spark.range(200000, numPartitions=16).selectExpr(
            "'hot' AS city", "DATE '2003-01-01' AS date", "2003 AS year", "1 AS month", "1 AS day_of_year",
            "rand() AS LST_Day_Urban", "rand() AS LST_Day_Rural", "rand() AS LST_Night_Urban", "rand() AS UHI_Index")
        write_obs(obs, str(tmp_path / "hot"))
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert len(list((tmp_path / "hot").glob("city=hot/year=2003/*.parquet"))) > 1
    assert read_obs(spark, str(tmp_path / "hot")).count() == 200000


def test_export_has_every_row(spark, obs_of):
    rows = [("a", "2003-01-01", 1.0, 1.0, 1.0, 1.0)] * 2 + [("c", None, 1.0, 1.0, 1.0, 1.0), (None, "2003-01-01", 1.0, 1.0, None, 1.0)]
    obs = obs_of(rows).crossJoin(spark.range(200_000).select()).select("*")
    assert clean_export(obs).count() == 800_000
    assert clean_export(obs).columns == obs.columns
