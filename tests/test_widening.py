from datetime import datetime
from itertools import permutations

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, BooleanType, DateType, DecimalType, DoubleType, IntegerType, LongType, NullType, StringType,
    StructType, TimestampType,
)
from test_streaming import write

from tidewell.functions import lattice
from tidewell.plans import jobs
from tidewell.sources import lake, ledger
from tidewell.streaming import landing

AT = datetime(2024, 5, 1, 12)
KINDS = [NullType(), IntegerType(), LongType(), DecimalType(38, 0), DecimalType(10, 2), DoubleType(), DateType(),
         TimestampType(), BooleanType(), StringType(), ArrayType(IntegerType()), StructType().add("a", IntegerType()).add("b", StringType())]


def test_the_lattice_joins_in_any_order(spark):
    for a, b in permutations(KINDS, 2):
        assert lattice.wider(a, b) == lattice.wider(b, a)
        assert lattice.wider(a, lattice.wider(a, b)) == lattice.wider(a, b)
    for a, b, c in permutations(KINDS, 3):
        left = lattice.wider(lattice.wider(a, b), c)
        right = lattice.wider(a, lattice.wider(b, c))
        # digits of decimals may run out in one order only
        assert left == right or {type(left), type(right)} == {DecimalType, DoubleType}


def test_structs_join_by_field(spark):
    one = StructType.fromDDL("a int, b struct<x: int, y: array<date>>")
    two = StructType.fromDDL("b struct<y: array<timestamp>, z: boolean, x: double>, c string")
    assert lattice.joined(one, two) == StructType.fromDDL("a int, b struct<x: double, y: array<timestamp>, z: boolean>, c string")
    assert lattice.settled(StructType.fromDDL("a void, b array<void>")) == StructType.fromDDL("a string, b array<string>")


@pytest.mark.parametrize("values, kind", [
    (["1", "-2"], "int"), (["1", "3000000000"], "bigint"), (["1", "12345678901234567890"], "decimal(38,0)"),
    (["1", "10.75"], "double"), (["1e3", ".5", "NaN"], "double"), (["1", "X4"], "string"), (["12d"], "string"),
    (["2024"], "int"), (["2024-01-31"], "date"), (["2024-01-31", "2024-01-31 10:11:12"], "timestamp"),
    (["2024-02-31"], "string"), (["true", "False"], "boolean"), (["true", "1"], "string"), ([None, None], "void"), ([None, "7"], "int"),
])
def test_least_type_of_text(spark, values, kind):
    frame = spark.createDataFrame([(v,) for v in values], "v string")
    found = lattice.least_type(frame.agg(lattice.fits_all(F.col("v"))).first()[0])
    assert found.simpleString() == kind
    if kind != "void":
        lost = frame.filter(F.col("v").isNotNull() & lattice.read_as(F.col("v"), kind).isNull())
        assert lost.count() == 0


def drop_of(tmp_path, name="users"):
    return landing.Drop.below(str(tmp_path), name), tmp_path / "raw_files" / name


def test_a_column_widens_step_by_step(spark, tmp_path):
    drop, raw = drop_of(tmp_path)
    kinds = []
    for n, value in enumerate(["7", "", "3000000000", "10.75", "X4", "8"]):
        write(raw, f"{n}.csv", f"id,v\n{n},{value}\n")
        assert [o.status for o in landing.land_all(spark, [drop], f"r{n}", AT)] == ["loaded"]
        jobs.landing_to_bronze(spark, drop.target, f"{tmp_path}/bronze")
        kinds.append(dict(landing.read_landing(spark, drop).dtypes)["v"])
    assert kinds == ["int", "int", "bigint", "double", "string", "string"]
    want = [(0, "7"), (1, None), (2, "3000000000"), (3, "10.75"), (4, "X4"), (5, "8")]
    assert rows(landing.read_landing(spark, drop), "id", "v") == want
    assert rows(lake.read_lake(spark, f"{tmp_path}/bronze"), "id", "v") == want
    assert landing.read_landing(spark, drop).filter("dw_rescued is not null").count() == 0
    assert jobs.landing_to_bronze(spark, drop.target, f"{tmp_path}/bronze") == 0


def test_a_new_column_and_a_wider_one_at_once(spark, tmp_path):
    drop, raw = drop_of(tmp_path)
    write(raw, "a.csv", "id,v\n1,2024-01-01\n")
    landing.land_all(spark, [drop], "r1", AT)
    write(raw, "b.csv", "id,v,new\n2,2024-01-02 03:04:05,x\n")
    write(raw, "c.csv", "id,v\n3,\n")
    landing.land_all(spark, [drop], "r2", AT)
    found = landing.read_landing(spark, drop)
    assert rows(found, "id", "v", "new") == [(1, datetime(2024, 1, 1), None), (2, datetime(2024, 1, 2, 3, 4, 5), "x"), (3, None, None)]


def test_rescue_keeps_types_and_values(spark, tmp_path):
    drop, raw = drop_of(tmp_path)
    write(raw, "a.csv", "id,v,w\n1,7,true\n")
    landing.land_all(spark, [drop], "r1", AT, widen=False)
    write(raw, "b.csv", 'id,v,w\n2,10.75,maybe\n3,"X, 4",false\n4,,\n')
    landing.land_all(spark, [drop], "r2", AT, widen=False)
    assert rows(landing.read_landing(spark, drop), "id", "v", "w", "dw_rescued") == [
        (1, 7, True, None), (2, None, None, '{"v":"10.75","w":"maybe"}'), (3, None, False, '{"v":"X, 4"}'), (4, None, None, None),
    ]


def touch_later(path, seconds):
    import os

    os.utime(path, (path.stat().st_atime, path.stat().st_mtime + seconds))


def test_overwritten_files_are_read_again_once(spark, tmp_path):
    drop, raw = drop_of(tmp_path)
    write(raw, "a.csv", "id,v\n1,x\n2,y\n")
    write(raw, "b.csv", "id,v\n3,z\n")
    landing.land_all(spark, [drop], "r1", AT)
    for run, text in (("r2", "id,v\n2,new\n4,10.75\n"), ("r3", "id,v\n2,third\n")):
        write(raw, "a.csv", text)
        touch_later(raw / "a.csv", 10 * int(run[1]))
        assert [o.detail for o in landing.land_all(spark, [drop], run, AT)] == ["1 files read again"]
        assert [o.detail for o in landing.land_all(spark, [drop], "idle", AT)] == [""]
    assert rows(landing.read_landing(spark, drop), "id", "v", "dw_batch_id") == [(2, "third", "r3"), (3, "z", "r1")]
    # emptied but for its header
    write(raw, "a.csv", "id,v\n")
    touch_later(raw / "a.csv", 90)
    assert [o.detail for o in landing.land_all(spark, [drop], "r4", AT)] == ["1 files read again"]
    assert [o.detail for o in landing.land_all(spark, [drop], "idle", AT)] == [""]
    assert rows(landing.read_landing(spark, drop), "id") == [(3,)]


def test_an_interrupted_load_of_overwritten_files_is_nothing(spark, tmp_path, monkeypatch):
    drop, raw = drop_of(tmp_path)
    write(raw, "a.csv", "id,v\n1,x\n")
    landing.land_all(spark, [drop], "r1", AT)
    write(raw, "a.csv", "id,v\n1,new\n5,more\n")
    touch_later(raw / "a.csv", 10)

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(landing, "record", fail)
        assert [o.status for o in landing.land_all(spark, [drop], "r2", AT)] == ["failed"]
    assert rows(landing.read_landing(spark, drop), "id", "v") == [(1, "x")]
    # overwritten once more before the run is repeated
    write(raw, "a.csv", "id,v\n1,newer\n")
    touch_later(raw / "a.csv", 20)
    landing.land_all(spark, [drop], "r3", AT)
    assert rows(landing.read_landing(spark, drop), "id", "v") == [(1, "newer")]
    folders = [f for root in lake.data_folders(spark, drop.target) for f in lake.list_folders(spark, root, "dw_load=again")]
    assert len(folders) == 1 and ledger.read_ledger(spark, drop.target).count() >= 2


def test_bronze_takes_live_rows_only(spark, tmp_path):
    drop, raw = drop_of(tmp_path)
    write(raw, "a.csv", "id,v\n1,x\n")
    landing.land_all(spark, [drop], "r1", AT)
    write(raw, "a.csv", "id,v\n2,y\n")
    touch_later(raw / "a.csv", 10)
    landing.land_all(spark, [drop], "r2", AT)
    jobs.landing_to_bronze(spark, drop.target, f"{tmp_path}/bronze")
    table = lake.read_lake(spark, f"{tmp_path}/bronze")
    assert rows(table, "id") == [(2,)] and not {"dw_load", "dw_file_changed_at"} & set(table.columns)
