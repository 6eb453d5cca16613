from datetime import datetime

import pytest
from frames import LABELLED, transactions
from pyspark.errors import PySparkException

from txrisk import schema as S
from txrisk.sources import stages
from txrisk.sources.transactions import (
    load_or_build,
    load_table,
    normalize,
    read_transactions,
    write_transactions,
)


def write_text(tmp_path, *lines):
    path = tmp_path / "transactions.csv"
    path.write_text("\n".join(lines) + "\n")
    return str(path)


HEADER = ",".join(S.REQUIRED)
LINE = "T1,2026-01-05 10:30:00,C1,M1,Fuel,10.5,Boston,MA,Chip,Gold,34,50000,10,0,1,9.5,3"


def test_csv_round_trip(spark, tmp_path):
    df = transactions(
        spark,
        {"city": None, "customer_income": None},
        {"transaction_id": "T2", "city": 'a "quoted", city', "merchant_category": "Home & Co"},
        {"transaction_id": "T3", "transaction_date": datetime(2026, 3, 1)},
    )
    path = str(tmp_path / "csv")
    write_transactions(df, path, "csv")
    back = read_transactions(spark, path)
    assert back.schema == df.schema
    assert sorted(back.collect()) == sorted(df.collect())


def test_csv_missing_words_types_and_column_order(spark, tmp_path):
    names = list(reversed(S.REQUIRED))
    values = dict(zip(S.REQUIRED, LINE.split(","), strict=True))
    values |= {"city": "NA", "customer_income": "nan", "customer_age": "34.0"}
    path = write_text(tmp_path, ",".join(names), ",".join(values[c] for c in names))
    row = read_transactions(spark, path).first()
    assert row["city"] is None and row["customer_income"] is None
    assert row["customer_age"] == 34 and row["transaction_amount"] == 10.5
    assert row["transaction_date"] == datetime(2026, 1, 5, 10, 30)
    kept = read_transactions(spark, path, na_values=("", "nan")).first()
    assert kept["city"] == "NA"


def test_csv_bad_number(spark, tmp_path):
    path = write_text(tmp_path, HEADER, LINE.replace("10.5", "ten"))
    with pytest.raises(PySparkException):
        read_transactions(spark, path).collect()
    assert read_transactions(spark, path, lenient=True).first()["transaction_amount"] is None


def test_csv_malformed_rows_are_reported(spark, tmp_path):
    path = write_text(tmp_path, HEADER, LINE, "T2,2026-01-05 10:30:00,C1")
    rows = read_transactions(spark, path, corrupt_column="bad").collect()
    assert [r["bad"] for r in rows] == [None, "T2,2026-01-05 10:30:00,C1"]


def test_csv_files_with_other_headers_raise(spark, tmp_path):
    (tmp_path / "in").mkdir()
    swapped = HEADER.replace("customer_id", "x").replace("merchant_id", "customer_id").replace("x", "merchant_id", 1)
    for name, header in (("a.csv", HEADER), ("b.csv", swapped)):
        (tmp_path / "in" / name).write_text(f"{header}\n{LINE}\n")
    with pytest.raises(Exception, match="header does not conform"):
        read_transactions(spark, str(tmp_path / "in")).collect()


@pytest.mark.parametrize("more", [",extra", ',"a, b",c', ","])
def test_csv_rows_with_too_many_fields_raise(spark, tmp_path, more):
    path = write_text(tmp_path, HEADER, LINE, LINE + more)
    with pytest.raises(PySparkException, match="more fields"):
        read_transactions(spark, path).collect()
    with pytest.raises(PySparkException, match="more fields"):
        read_transactions(spark, path).count()
    assert read_transactions(spark, path, lenient=True).count() == 2


def test_csv_rows_with_too_few_fields_end_in_nulls(spark, tmp_path):
    path = write_text(tmp_path, HEADER, LINE, "T2,2026-01-05 10:30:00,C1")
    row = read_transactions(spark, path).where("transaction_id = 'T2'").first()
    assert row["customer_id"] == "C1" and row["merchant_id"] is None and row["city"] is None


def test_half_written_dataset_is_not_read(spark, tmp_path):
    path = tmp_path / "stored"
    write_transactions(transactions(spark, {}), str(path))
    assert load_or_build(spark, str(path), lambda: None).count() == 1
    (path / "_SUCCESS").unlink()
    with pytest.raises(ValueError, match="finished"):
        load_or_build(spark, str(path), lambda: None)


def test_missing_column_is_named(spark, tmp_path):
    path = write_text(tmp_path, HEADER.replace(",state", ""), LINE.replace(",MA", ""))
    with pytest.raises(ValueError, match="state"):
        read_transactions(spark, path)


def test_normalize_turns_nan_into_null(spark):
    df = transactions(spark, {"customer_income": float("nan")})
    row = normalize(df.withColumn("customer_age", df.customer_age.cast("int"))).first()
    assert row["customer_income"] is None and row["customer_age"] == 34


def test_load_table_by_month(spark, tmp_path):
    df = transactions(
        spark,
        {},
        {"transaction_id": "T2", "transaction_date": datetime(2026, 2, 1)},
        {"transaction_id": "T3", "transaction_date": None},
    )
    path = str(tmp_path / "table")
    load_table(df, path=path)
    back = spark.table("transactions")
    assert sorted(map(str, back.drop("month").collect())) == sorted(map(str, df.collect()))
    assert {p.name for p in (tmp_path / "table").glob("month=*")} >= {
        "month=2026-01",
        "month=2026-02",
    }
    load_table(df.limit(1), path=path)
    assert spark.table("transactions").count() == 1


def test_load_or_build_builds_once(spark, tmp_path):
    path, built = str(tmp_path / "stored"), []

    def build():
        built.append(1)
        return transactions(spark, {}, {"transaction_id": "T2"})

    assert load_or_build(spark, path, build).count() == 2
    assert load_or_build(spark, path, build).count() == 2
    assert len(built) == 1


def test_stage_keeps_schema_and_lies_in_the_shared_folder(spark):
    df = transactions(spark, {})
    staged = stages.materialize(df, "probe")
    assert staged.schema == df.schema and staged.columns == [
        f.split()[0] for f in LABELLED.split(", ")
    ]
    root = spark.conf.get("spark.checkpoint.dir")
    assert all(f.removeprefix("file:").lstrip("/") for f in staged.inputFiles())
    assert all(root.strip("/") in f for f in staged.inputFiles())


def test_drop_stages_deletes_only_its_folder(spark, tmp_path, monkeypatch):
    (tmp_path / "other").mkdir()
    monkeypatch.setattr(stages, "stage_root", lambda _: str(tmp_path / "txrisk-app"))
    stages.materialize(transactions(spark, {}), "probe")
    assert (tmp_path / "txrisk-app").exists()
    stages.drop_stages(spark)
    assert sorted(p.name for p in tmp_path.iterdir()) == ["other"]
