import datetime as dt
from decimal import Decimal

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from wapspark.operators.file_schemas import file_schema_drift, file_schemas


def write(folder, name, columns):
    folder.mkdir(exist_ok=True)
    pq.write_table(pa.table(columns), folder / name)


def drift(spark, folder, **kw):
    return {r.path: r for r in file_schema_drift(file_schemas(spark, str(folder), **kw)).collect()}


@pytest.fixture
def mixed(tmp_path):
    a = tmp_path / "t"
    write(a, "a.parquet", {
        "id": pa.array([1, 2], pa.int32()), "same": pa.array(["x", "y"]),
        "s": pa.array([{"k": 1, "deep": [{"v": 1.5}]}] * 2,
                      pa.struct([("k", pa.int32()), ("deep", pa.list_(pa.struct([("v", pa.float32())])))])),
        "amount": pa.array([Decimal("1.25")] * 2, pa.decimal128(5, 2)),
        "kind": pa.array(["p", "q"]), "day": pa.array([dt.date(2020, 1, 1)] * 2, pa.date32())})
    write(a / "sub", "b.parquet", {
        "id": pa.array([3, 4, 5], pa.int64()), "same": pa.array(["x", "y", None]),
        "s": pa.array([{"k": 1, "deep": [{"v": 1.5, "w": "n"}], "new": True}] * 3, pa.struct(
            [("k", pa.int32()), ("deep", pa.list_(pa.struct([("v", pa.float64()), ("w", pa.string())]))),
             ("new", pa.bool_())])),
        "amount": pa.array([Decimal("1.2500")] * 3, pa.decimal128(12, 4)),
        "kind": pa.array([1, 2, 3], pa.int32()),
        "day": pa.array([dt.datetime(2020, 1, 1)] * 3, pa.timestamp("us")), "a.b": pa.array([1, 2, 3])})
    write(a, "c.parquet", {"id": pa.array([], pa.int64()), "same": pa.array([], pa.string())})
    return a


@pytest.mark.parametrize("whole_files", [False, True])
def test_changes_of_all_kinds(spark, mixed, whole_files):
    got = drift(spark, mixed, whole_files=whole_files)
    assert {p: (r.change, r.types, r.merged_type) for p, r in got.items()} == {
        "id": ("widened", "int32,int64", "int64"),
        "s": ("missing", "struct", "struct"),
        "s.new": ("missing", "bool", "bool"),
        "s.deep.element.v": ("widened", "double,float", "double"),
        "s.deep.element.w": ("missing", "string", "string"),
        "amount": ("missing+widened", "decimal128(12, 4),decimal128(5, 2)", "decimal128(12, 4)"),
        "kind": ("missing+conflict", "int32,string", None),
        "day": ("missing+widened", "date32[day],timestamp[us]", "timestamp[us]"),
        "`a.b`": ("missing", "int64", "int64")}
    assert (got["s"].n_files, got["s"].n_rows, got["s"].lacking_files, got["s"].lacking_rows) == (2, 5, 1, 0)
    # The file without ``s`` doesn't count for what stands within it.
    assert (got["s.new"].n_files, got["s.new"].lacking_files, got["s.new"].lacking_rows) == (1, 1, 2)


def test_files_that_agree_and_too_wide_decimals(spark, tmp_path):
    for name in ("a.parquet", "b.parquet"):
        write(tmp_path / "same", name, {"x": pa.array([1]), "m": pa.array([[("k", 1)]], pa.map_(
            pa.string(), pa.int64()))})
    assert drift(spark, tmp_path / "same") == {}
    paths = {r.path for r in file_schemas(spark, str(tmp_path / "same")).collect()}
    assert paths == {"", "x", "m", "m.key", "m.value"}
    write(tmp_path / "wide", "a.parquet", {"d": pa.array([Decimal(1)], pa.decimal128(38, 0))})
    write(tmp_path / "wide", "b.parquet", {"d": pa.array([Decimal(1)], pa.decimal128(38, 10))})
    assert drift(spark, tmp_path / "wide")["d"].change == "conflict"


def test_nested_beside_plain_type(spark, tmp_path):
    write(tmp_path / "n", "a.parquet", {"c": pa.array([{"x": 1}])})
    write(tmp_path / "n", "b.parquet", {"c": pa.array(["text"])})
    got = drift(spark, tmp_path / "n")
    assert set(got) == {"c"} and got["c"].change == "conflict"
