import datetime as dt
import gzip
from pathlib import Path

import pytest

from patronlens import contract as C
from patronlens.shared import new_path, shared_dir, written
from patronlens.sources.csv_files import read_csv, write_csv
from patronlens.sources.warehouse import Warehouse, lower_case_columns
from patronlens.streaming import jobs
from tests import samples


def write_text(folder, name, text):
    path = Path(folder) / name
    with gzip.open(path, "wt") if name.endswith(".gz") else open(path, "w") as file:
        file.write(text)
    return str(path)


def test_quoted_fields_empty_fields_and_gzip(spark, tmp_path):
    path = write_text(
        tmp_path,
        "users.csv.gz",
        "user_id,email,first_name,last_name,signup_date,country,age,customer_segment\n"
        '1,"a ""q"", b",A,"",2024-01-02,"Congo, the",33,Premium\n'
        "2,b@example.invalid,,,,,,\n",
    )
    first, second = read_csv(spark, path, C.RAW_USERS).orderBy("user_id").collect()
    assert tuple(first) == (1, 'a "q", b', "A", first[3], dt.date(2024, 1, 2), "Congo, the", 33, "Premium")
    assert tuple(second) == (2, "b@example.invalid", None, None, None, None, None, None)


def test_columns_bind_by_position(spark, tmp_path):
    path = write_text(tmp_path, "p.csv", "A,B,C,D,E\n7,Thing,Books,12.5,Brand\n")
    assert read_csv(spark, path, C.RAW_PRODUCTS).first() == (7, "Thing", "Books", 12.5, "Brand")


@pytest.mark.parametrize("moment", ["2024-03-01 10:20:30", "2024-03-01T10:20:30"])
def test_timestamps(spark, tmp_path, moment):
    path = write_text(tmp_path, "t.csv", f"h\n1,2,3,4,5.5,22.0,{moment},PayPal\n")
    assert read_csv(spark, path, C.RAW_TRANSACTIONS).first()["transaction_date"] == dt.datetime(2024, 3, 1, 10, 20, 30)


@pytest.mark.parametrize("line", ["x,Thing,Books,1.0,B", "1,Thing,Books,cheap,B", "1,Thing"])
def test_bad_lines_fail_the_load(spark, tmp_path, line):
    path = write_text(tmp_path, "p.csv", f"product_id,product_name,category,price,brand\n{line}\n")
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ"):
        read_csv(spark, path, C.RAW_PRODUCTS).collect()


def test_missing_file_fails(spark):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_csv(spark, "/no/such/file.csv.gz", C.RAW_USERS)


def test_csv_round_trip(spark):
    rows = [(i, f'say "{i}", twice', "Books", i / 4, None if i % 3 else "B\\C") for i in range(50)]
    products = spark.createDataFrame(rows, C.RAW_PRODUCTS)
    path = new_path(spark, "products")
    write_csv(products.repartition(3), path, rows_per_file=10)
    back = read_csv(spark, path, C.RAW_PRODUCTS, partitions=4)
    assert sorted(back.collect(), key=lambda r: r[0]) == rows
    assert back.rdd.getNumPartitions() == 4
    files = [f for f in back.inputFiles()]
    assert len(files) >= 5 and all(f.endswith(".csv.gz") for f in files)


def test_warehouse_tables_are_replaced(spark):
    warehouse = Warehouse(spark, "sources_test_", new_path(spark, "warehouse")).create()
    warehouse.create()  # again: nothing happens
    warehouse.create_raw_tables()
    for name, layout in C.RAW_TABLES.items():
        table = warehouse.table("raw_data", name)
        assert table.schema == layout and table.count() == 0
    users = samples.users(spark, [(1, 30, "Basic"), (2, 40, "Premium")])
    path = new_path(spark, "users")
    write_csv(users, path)
    assert warehouse.load_csv("raw_users", path).count() == 2
    assert warehouse.load_csv("raw_users", path).count() == 2
    assert sorted(warehouse.table("raw_data", "raw_users").collect()) == sorted(users.collect())


def test_lower_case_columns(spark):
    assert lower_case_columns(spark.createDataFrame([(1, 2)], "USER_ID int, Age int")).columns == ["user_id", "age"]


def test_written_table_and_shared_folder(spark):
    df = spark.range(10).selectExpr("id", "id % 2 = 0 AS even")
    again = written(df, "numbers")
    assert again.schema.names == ["id", "even"] and sorted(again.collect()) == sorted(df.collect())
    assert written(df.limit(0), "none").count() == 0
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert configured is None or shared_dir(spark) == configured.rstrip("/")


def test_each_landed_file_is_ingested_once(spark, tmp_path):
    landing, target, progress = (str(tmp_path / name) for name in ("landing", "target", "progress"))
    Path(landing).mkdir()
    header = "product_id,product_name,category,price,brand\n"
    write_text(landing, "a.csv.gz", header + '1,"One, two",Books,1.5,B\n2,Two,Home,2.5,B\n')

    def ids_after_a_run():
        jobs.ingest_new_files(spark, landing, C.RAW_PRODUCTS, target, progress)
        return sorted(row["product_id"] for row in spark.read.parquet(target).collect())

    assert ids_after_a_run() == [1, 2]
    assert ids_after_a_run() == [1, 2]
    write_text(landing, "b.csv.gz", header + "3,Three,Home,3.5,C\n")
    assert ids_after_a_run() == [1, 2, 3]
    assert spark.read.parquet(target).where("product_id = 1").first()["product_name"] == "One, two"
