"""Landing, raw tables and the daily batch."""

import json
from uuid import uuid4

import pytest

from gustline.operators.quality import ValidationError
from gustline.plans.daily import LOADS, land_history, land_sets, run_batch
from gustline.sources import landing, tables, versions


def raw(spark, rows, layout="city STRING, temperature DOUBLE, date STRING"):
    return spark.createDataFrame(rows, layout)


def landed(spark, root):
    return spark.read.schema("city STRING, year STRING, month STRING, day STRING").json(root)


def test_one_day_is_replaced_and_its_month_stays(spark, folder):
    for date, city in [("2024-01-05", "a"), ("2024-01-06", "b"), ("2024-01-05", "c")]:
        landing.land_day(raw(spark, [(city, 1.0, date)]).drop("date"), folder, date)
    assert sorted(map(tuple, landed(spark, folder).collect())) == [
        ("b", "2024", "01", "06"), ("c", "2024", "01", "05")]


def test_many_days_at_once(spark, folder):
    landing.land_days(raw(spark, [("a", 1.0, "2024-01-05"), ("b", 1.0, "2024-02-01")]), folder)
    landing.land_days(raw(spark, [("c", 1.0, "2024-01-05")]), folder)
    assert sorted(map(tuple, landed(spark, folder).collect())) == [
        ("b", "2024", "02", "01"), ("c", "2024", "01", "05")]


def test_inventory_counts_files_and_bytes(spark, folder):
    landing.land_day(raw(spark, [("a", 1.0, "x")] * 40).repartition(4), folder, "2024-01-05")
    row = landing.inventory(spark, folder).first()
    assert (row.year, row.month, row.day, row.n_files) == ("2024", "01", "05", 4)
    assert row.n_bytes == 40 * len('{"city":"a","temperature":1.0,"date":"x"}\n')


def test_partitions_show_after_discovery(spark, folder):
    database = f"bronze_{uuid4().hex}"
    landing.land_day(raw(spark, [("a", 1.0, "x")]).drop("date"), f"{folder}/w", "2024-01-05")
    tables.create_raw_database(spark, f"{folder}/db", database)
    table = tables.create_raw_table(spark, "weather_data", f"{folder}/w", database)
    assert spark.table(table).count() == 0
    tables.discover_partitions(spark, table)
    row = spark.table(table).filter("year = '2024' and month = '01'").first()
    assert (row.city, row.year, row.month) == ("a", "2024", "01")
    assert dict(spark.table(table).dtypes)["pressure"] == "int"


def payload(city, pressure=1010):
    return json.dumps({"id": 1, "name": city, "sys": {"country": "VN"}, "dt": 1709251200,
                       "main": {"temp": 20.5, "pressure": pressure, "humidity": 50}, "visibility": 900})


def write_lines(spark, folder, name, lines):
    spark.createDataFrame([(line,) for line in lines], "v STRING").coalesce(1).write.mode("overwrite").text(f"{folder}/{name}")


def test_daily_batch_can_be_repeated(spark, folder):
    database, out = f"bronze_{uuid4().hex}", f"{folder}/out"
    write_lines(spark, f"{folder}/weather", "2024-03-01.json", [payload("a"), payload("b")])
    write_lines(spark, f"{folder}/weather", "2024-03-02.json", [payload("c")])
    stock = json.dumps({"symbol": "S", "txn_date": "2024-03-01", "open": 1.5, "volume": 9})
    write_lines(spark, f"{folder}/stock", "2024-03-01.json", [stock])
    result = run_batch(spark, folder, "2024-03-01", out, database, stock=True)
    assert (result["weather"]["records_count"], result["weather"]["status"], result["stock"]["records_count"]) == (2, "PASS", 1)
    assert run_batch(spark, folder, "2024-03-02", out, database)["weather"]["records_count"] == 1
    run_batch(spark, folder, "2024-03-01", out, database)
    rows = spark.table(f"{database}.weather_data").orderBy("city").collect()
    assert [(r.city, r.temperature, r.day) for r in rows] == [("a", 20.5, "01"), ("b", 20.5, "01"), ("c", 20.5, "02")]
    assert spark.table(f"{database}.financial_data").select("symbol", "volume", "month").first() == ("S", 9, "03")


def test_daily_batch_keeps_junk_out(spark, folder):
    database, out = f"bronze_{uuid4().hex}", f"{folder}/out"
    write_lines(spark, f"{folder}/weather", "2024-03-01.json", [payload("a"), "{broken"])
    with pytest.raises(ValidationError, match="1 of 2"):
        run_batch(spark, folder, "2024-03-01", out, database, most_rejects=0)
    assert run_batch(spark, folder, "2024-03-01", out, database)["weather"]["rejected"] == 1
    assert [r.city for r in spark.table(f"{database}.weather_data").collect()] == ["a"]


def test_daily_batch_without_records_fails(spark, folder):
    write_lines(spark, f"{folder}/weather", "2024-03-01.json", [])
    with pytest.raises(ValidationError, match="Zero Count"):
        run_batch(spark, folder, "2024-03-01", f"{folder}/out", f"bronze_{uuid4().hex}")


def weather(spark, *cities):
    return spark.createDataFrame([(c, 1.0) for c in cities], "city STRING, temperature DOUBLE")


def stock(spark, *symbols):
    return spark.createDataFrame([(s,) for s in symbols], "symbol STRING")


def names(spark, database):
    return [sorted(r[0] for r in spark.table(f"{database}.{t}").select(c).collect()) for t, c in (("weather_data", "city"), ("financial_data", "symbol"))]


def test_a_broken_reload_leaves_the_day_and_a_whole_one_replaces_both_tables(spark, folder):
    database, out = f"bronze_{uuid4().hex}", f"{folder}/o'ut"
    land_sets(spark, {"weather": weather(spark, "a"), "stock": stock(spark, "s")}, "2024-03-01", out, database)
    land_sets(spark, {"weather": weather(spark, "b")}, "2024-03-02", out, database)
    broken = stock(spark, "t").selectExpr("raise_error(symbol) AS symbol")
    with pytest.raises(Exception, match="t"):
        land_sets(spark, {"weather": weather(spark, "x"), "stock": broken}, "2024-03-01", out, database)
    assert names(spark, database) == [["a", "b"], ["s"]]
    land_sets(spark, {"weather": weather(spark, "c"), "stock": stock(spark, "u")}, "2024-03-01", out, database)
    assert names(spark, database) == [["b", "c"], ["u"]]
    # Of the first day's three versions of the weather two are garbage now.
    assert versions.remove_old(spark, f"{out}/{LOADS}", f"{out}/weather", "2024-03-01") == []
    assert len(versions.remove_old(spark, f"{out}/{LOADS}", f"{out}/weather", "2024-03-01", older_than_seconds=-60)) == 2
    assert versions.remove_old(spark, f"{out}/{LOADS}", f"{out}/weather", "1999-01-01") == []
    assert names(spark, database) == [["b", "c"], ["u"]]


def test_a_new_catalog_follows_the_log_of_loads(spark, folder):
    database, again = f"bronze_{uuid4().hex}", f"bronze_{uuid4().hex}"
    for city in "ab":
        land_sets(spark, {"weather": weather(spark, city), "stock": stock(spark, city)}, "2024-03-01", folder, database)
    land_sets(spark, {"weather": weather(spark, "c")}, "2024-03-02", folder, database)
    # A commit whose load broke off before the catalog followed.
    location = versions.write_day(weather(spark, "d"), f"{folder}/weather", "2024-03-02")
    versions.commit(spark, f"{folder}/{LOADS}", "2024-03-02", {"weather_data": location})
    assert names(spark, database) == [["b", "c"], ["b"]]
    assert versions.follow(spark, f"{folder}/{LOADS}", database) == 3
    tables.create_raw_database(spark, f"{folder}/{again}", again)
    for table, root in (("weather_data", "weather"), ("financial_data", "stock")):
        tables.create_raw_table(spark, table, f"{folder}/{root}", again)
    versions.follow(spark, f"{folder}/{LOADS}", again)
    assert names(spark, database) == names(spark, again) == [["b", "d"], ["b"]]
    assert versions.loads(spark, f"{folder}/{LOADS}").count() == 6


def dated(frame, *days):
    """The rows of a frame, each on one of the days in turn."""
    spark = frame.sparkSession
    rows = [(*row, day) for row, day in zip(frame.collect(), days)]
    return spark.createDataFrame(rows, f"{frame.schema.simpleString()[7:-1].replace(':', ' ')}, date string")


def test_many_days_are_replaced_together_or_not_at_all(spark, folder):
    database, days = f"bronze_{uuid4().hex}", ("2024-03-01", "2024-03-02", "2024-03-03")

    def load(cities, symbols, days=days):
        return land_history(spark, {"weather": dated(weather(spark, *cities), *days), "stock": dated(stock(spark, *symbols), *days)}, folder, database)

    assert load("abc", "stu") == list(days)
    assert names(spark, database) == [["a", "b", "c"], ["s", "t", "u"]]
    broken = dated(stock(spark, "x", "y"), *days).selectExpr("raise_error(symbol) AS symbol", "date")
    with pytest.raises(Exception, match="x|y"):
        land_history(spark, {"weather": dated(weather(spark, *"xyz"), *days), "stock": broken}, folder, database)
    undated = dated(weather(spark, "x", "y"), "2024-03-01", None)
    with pytest.raises(Exception, match="no ISO date"):
        land_history(spark, {"weather": undated}, folder, database)
    assert names(spark, database) == [["a", "b", "c"], ["s", "t", "u"]]
    # Two days again, and one of them as a day of its own after that.
    assert load("de", "vw", days[1:]) == list(days[1:])
    land_sets(spark, {"weather": weather(spark, "f")}, days[2], folder, database)
    assert names(spark, database) == [["a", "d", "f"], ["s", "v", "w"]]
    assert land_history(spark, {"weather": dated(weather(spark, "g"), days[0]).where("false")}, folder, database) == []

    def removed(day):
        return len(versions.remove_old(spark, f"{folder}/{LOADS}", f"{folder}/weather", day, older_than_seconds=-60))

    # The first version of the first day counts; of each later one's, those of the first, the broken and, on the third, the second load are old.
    assert (removed(days[0]), removed(days[1]), removed(days[2])) == (1, 2, 3)
    assert names(spark, database) == [["a", "d", "f"], ["s", "v", "w"]]
