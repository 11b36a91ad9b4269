"""Reading and writing: typed reference CSVs, published tables, parameters."""

import datetime as dt
import tempfile
import threading
import time
from pathlib import Path

import pytest
from conftest import rows

from brightledger.operators.checks import run_checks
from brightledger.rules import contracts
from brightledger.session import prepared, shared_folder
from brightledger.sources import published, reference
from brightledger.sources.driver_tables import _padded


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="brightledger-test-")


def write(folder, name, text):
    with open(f"{folder}/{name}.csv", "w", encoding="utf-8") as out:
        out.write(text)


def test_reference_csv_is_typed_and_trimmed(spark, folder):
    write(
        folder,
        "holiday_calendars",
        "holiday_id,holiday_name,holiday_date,is_bank_holiday,affects_processing,holiday_type\n"
        "H1,New Year's Day,2025-01-01,true,false,Federal\nH2,Some Day,2025-10-13,true,true,Federal \n",
    )
    found = rows(reference.load_reference(spark, folder, "holiday_calendars"), "holiday_id")
    assert found[0]["holiday_date"] == dt.date(2025, 1, 1) and found[0]["affects_processing"] is False
    assert found[1]["holiday_type"] == "Federal"


def test_malformed_reference_fails_instead_of_losing_rows(spark, folder):
    write(folder, "lifecycle_stages", "stage_id,stage_name,typical_duration_months,next_stage,characteristics\nL1,A,many,B,c\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        reference.load_reference(spark, folder, "lifecycle_stages").collect()


def test_every_reference_has_a_schema_starting_with_its_key():
    for table, key in contracts.REFERENCE_KEYS.items():
        assert reference.SCHEMAS[table].split()[0] == key
    assert len(contracts.REFERENCE_KEYS) == 20


def test_builtin_references_pass_their_checks_and_know_their_size(spark):
    for name, df in reference.BuiltinReferences(spark).items():
        key = reference.FIXED_VALUES[name][0][0]
        listed = [c for c in contracts.REFERENCES[name] if c.column == key]
        if listed:
            assert all(r["failures"] == 0 for r in rows(run_checks(name, df, listed)))
        assert "LocalTableScan" in df._jdf.queryExecution().executedPlan().toString()


def test_orders_demo_files(spark, folder):
    write(folder, "raw_customers", "id,first_name,last_name\n1,Ann,A\n")
    write(folder, "raw_orders", "id,user_id,order_date,status\n1,1,2018-01-01,returned\n")
    write(folder, "raw_payments", "id,order_id,payment_method,amount\n1,1,coupon,1000\n")
    frames = reference.load_orders_demo(spark, folder)
    assert rows(frames["raw_orders"])[0]["order_date"] == dt.date(2018, 1, 1)
    assert rows(frames["raw_payments"])[0]["amount"] == 1000


def test_header_decides_which_column_is_which(spark, folder):
    write(folder, "raw_customers", "id,last_name,first_name\n1,Adams,Ann\n")
    df = reference.load_reference(spark, folder, "raw_customers")
    assert df.columns == ["id", "first_name", "last_name"]
    assert rows(df) == [{"id": 1, "first_name": "Ann", "last_name": "Adams"}]
    for header in ("id,first_name", "id,first_name,surname", "id,first_name,last_name,extra", "1,Ann,Adams"):
        write(folder, "raw_customers", f"{header}\n1,Ann,Adams,x\n")
        with pytest.raises(reference.HeaderMismatch):
            reference.load_reference(spark, folder, "raw_customers")


def test_every_file_of_a_folder_must_have_the_same_header(spark, folder):
    (Path(folder) / "raw_customers.csv").mkdir()
    write(f"{folder}/raw_customers.csv", "a", "id,first_name,last_name\n1,Ann,A\n")
    write(f"{folder}/raw_customers.csv", "b", "id,last_name,first_name\n2,B,Bo\n")
    with pytest.raises(Exception, match="(?i)header"):
        reference.load_reference(spark, folder, "raw_customers").collect()


def test_stored_tables_are_replaced_whole(spark, folder):
    place = f"{folder}/t"
    df = spark.range(3).selectExpr("id", "id * 2 AS twice")
    first = published.write_table(df, place)
    assert rows(first, "id") == rows(df, "id") and published.stored_mark(spark, place) == ""
    reader = published.read_published(spark, place)
    published.write_table(df.where("id = 1"), place, "m2")
    assert published.read_published(spark, place).count() == 1 and published.stored_mark(spark, place) == "m2"
    # Who began before the replacement still has the old rows, all of them.
    assert rows(reader, "id") == rows(df, "id") == rows(first, "id")
    # A table may be rebuilt from itself.
    again = published.read_published(spark, place)
    published.write_table(again.union(again), place)
    published.write_table(published.read_published(spark, place).selectExpr("id + 1 AS id", "twice"), place)
    assert [r["id"] for r in published.read_published(spark, place).collect()] == [2, 2]
    assert len(list(Path(place).glob("v-*"))) == len(list((Path(place) / published.MARKERS).glob("0*"))) == published.KEPT


def test_a_write_that_fails_half_way_changes_nothing(spark, folder):
    place = f"{folder}/t"
    published.write_table(spark.range(5), place, "good")
    broken = spark.range(0, 40, 1, 8).selectExpr("CASE WHEN id = 37 THEN CAST(raise_error('no') AS BIGINT) ELSE id END AS id")
    with pytest.raises(Exception, match="no"):
        published.write_table(broken, place, "bad")
    assert published.read_published(spark, place).count() == 5 and published.stored_mark(spark, place) == "good"
    assert len(list(Path(place).glob("v-*"))) == 1
    # What a writer that died has left is never read.
    (Path(place) / "v-left").mkdir()
    (Path(place) / "v-left" / "part-0.parquet").write_bytes(b"half")
    assert published.read_published(spark, place).count() == 5
    with pytest.raises(Exception, match="no"):
        published.write_table(broken, f"{folder}/new")
    assert published.stored_mark(spark, f"{folder}/new") is None


def test_readers_see_one_version_while_a_table_is_replaced(spark, folder):
    place, seen, stop = f"{folder}/t", [], threading.Event()
    published.write_table(spark.range(100).selectExpr("0 AS version"), place)

    def read():
        while not stop.is_set():
            found = published.read_published(spark, place).groupBy("version").count().collect()
            seen.append([(r["version"], r["count"]) for r in found])

    reader = threading.Thread(target=read)
    reader.start()
    try:
        for version in range(1, 5):
            published.write_table(spark.range(0, 100, 1, 4).selectExpr(f"{version} AS version"), place)
            time.sleep(0.3)
    finally:
        stop.set()
        reader.join()
    assert seen and all(len(found) == 1 and found[0][1] == 100 for found in seen)
    assert [found[0][0] for found in seen] == sorted(found[0][0] for found in seen)


def test_marks_follow_files(spark, folder):
    spark.range(3).write.parquet(f"{folder}/a")
    spark.range(3).coalesce(1).write.parquet(f"{folder}/b")
    one, both = published.content_mark(spark, [f"{folder}/a"]), published.content_mark(spark, [f"{folder}/b", f"{folder}/a"])
    assert published.content_mark(spark, [f"{folder}/a"]) == one != both == published.content_mark(spark, [f"{folder}/a", f"{folder}/b"])
    spark.range(1).write.mode("append").parquet(f"{folder}/a")
    assert published.content_mark(spark, [f"{folder}/a"]) != one


def test_public_names_and_private_ones(spark):
    df = spark.range(3).selectExpr("id", "id * 2 AS twice")
    published.as_view(df, "own_view")
    published.as_view(df, "open_view", ("open_view",))
    assert spark.table("own_view").count() == spark.table("open_view").count() == 3
    assert rows(published.read_published(spark, "open_view"), "id") == rows(df, "id")
    assert "open_view" in published.public_names(spark) and "own_view" not in published.public_names(spark)
    with pytest.raises(published.PrivateTable):
        published.read_published(spark, "own_view")
    with pytest.raises(LookupError):
        published.read_published(spark, "no_such_view")
    # Another session of the application sees public names only.
    other = spark.newSession()
    assert published.read_published(other, "open_view").count() == 3
    with pytest.raises(LookupError):
        published.read_published(other, "own_view")
    published.as_view(df.where("id = 1"), "open_view", ("open_view",))
    assert published.read_published(spark, "open_view").count() == 1


def test_parameters_and_grids(spark):
    df = spark.range(3)
    assert rows(published.param_row(spark, "risk", "name")) == [{"name": "risk"}]
    assert rows(published.passthrough(df), "id") == rows(df, "id")
    grid = {(r["i"], r["j"]) for r in published.number_grid(spark, 4).collect()}
    assert grid == {(i, j) for i in range(1, 5) for j in range(1, 5)}


def test_shared_folder_is_the_clusters_or_made_once(spark):
    folder = shared_folder(spark)
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert folder == named and shared_folder(spark) == folder


def test_long_numbers_stay_whole_and_distinct(spark, folder):
    ids = [7, 999_999, 1_000_000, 123_456_789_012, 123_456_789_013, 2**31 + 1]
    df = spark.createDataFrame([(i,) for i in ids], "n long").selectExpr(f"{_padded('CUST', 'n', 6)} AS number")
    numbers = [r["number"] for r in df.collect()]
    assert numbers == [f"CUST{i:06d}" for i in ids]


def test_csv_ids_may_be_long(spark, folder):
    write(folder, "raw_customers", f"id,first_name,last_name\n{2**31 + 5},Ann,A\n")
    write(folder, "raw_orders", f"id,user_id,order_date,status\n{2**40},{2**31 + 5},2018-01-01,returned\n")
    write(folder, "raw_payments", f"id,order_id,payment_method,amount\n{2**41},{2**40},coupon,{2**33}\n")
    frames = reference.load_orders_demo(spark, folder)
    assert rows(frames["raw_payments"])[0] == {"id": 2**41, "order_id": 2**40, "payment_method": "coupon", "amount": 2**33}
    assert rows(frames["raw_orders"])[0]["user_id"] == rows(frames["raw_customers"])[0]["id"] == 2**31 + 5


def test_settings_of_the_session_are_kept(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert prepared(spark).conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
