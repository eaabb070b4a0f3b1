from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql.types import StructType

from tidewell.streaming import landing, schemas

AT = datetime(2024, 5, 1, 12)


def write(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)


def test_landing_runs_to_completion_and_resumes(spark, tmp_path):
    drop = landing.Drop.below(str(tmp_path), "users")
    raw = tmp_path / "raw_files" / "users"
    write(raw, "a.csv", "id,name\n1,x\n1,x\n2,y\n")
    assert [o.status for o in landing.land_all(spark, [drop], "r1", AT)] == ["loaded"]
    assert rows(landing.read_landing(spark, drop), "id", "name") == [(1, "x"), (2, "y")]
    landing.land_all(spark, [drop], "r2", AT)
    assert landing.read_landing(spark, drop).count() == 2, "a rerun adds nothing"
    write(raw, "b.csv", "id,name,age\n3,z,44\n")
    landing.land_all(spark, [drop], "r3", AT)
    got = landing.read_landing(spark, drop)
    assert rows(got, "id", "name", "age", "dw_batch_id") == [
        (1, "x", None, "r1"), (2, "y", None, "r1"), (3, "z", 44, "r3"),
    ]
    assert got.filter("dw_source_file like '%b.csv'").count() == 1


def test_streams_fail_alone(spark, tmp_path):
    good, bad = (landing.Drop.below(str(tmp_path), n) for n in ("users", "payments"))
    write(tmp_path / "raw_files" / "users", "a.csv", "id\n1\n")
    outcomes = {o.entity: o.status for o in landing.land_all(spark, [bad, good], "r", AT)}
    assert outcomes == {"payments": "failed", "users": "loaded"}


def test_schema_grows_at_its_end_only(spark, tmp_path):
    source, store = tmp_path / "in", f"{tmp_path}/schema"
    write(source, "a.csv", "id,name\n1,x\n")
    first = schemas.current_schema(spark, str(source), store)
    assert first.simpleString() == "struct<id:int,name:string>"
    write(source, "b.csv", "id,name,price\n2,y,1.5\n")
    second = schemas.current_schema(spark, str(source), store)
    assert second.simpleString() == "struct<id:int,name:string,price:double>"
    assert schemas.load_schema(spark, store) == second
    assert schemas.current_schema(spark, str(source), store) == second
    layouts, _ = schemas.files_by_header(spark, str(source), datetime(2100, 1, 1))
    assert layouts == {}, "files already seen are not read again"
    write(source, "c.csv", "id,age,name,price\n3,4,z,2\n")
    with pytest.raises(ValueError, match="do not continue"):
        schemas.current_schema(spark, str(source), store)


def test_schema_needs_files(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    with pytest.raises(Exception):
        schemas.current_schema(spark, str(tmp_path / "empty"), f"{tmp_path}/store")
    assert schemas.load_schema(spark, f"{tmp_path}/none") is None


def test_widened():
    known = StructType.fromDDL("a int, b string")
    assert schemas.widened(known, StructType.fromDDL("a string")) == known
    assert schemas.widened(None, known) == known
    grown = schemas.widened(known, StructType.fromDDL("a string, b int, c date"))
    assert grown == StructType.fromDDL("a int, b string, c date")


def test_business_key_dedup_keeps_state_bounded(spark, tmp_path):
    schema = "event_id int, ts timestamp"
    data = [(1, AT), (2, AT)]
    out, checkpoint = f"{tmp_path}/out", f"{tmp_path}/cp"
    for _ in range(2):
        spark.createDataFrame(data, schema).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
        once = landing.first_copies(stream, ["event_id"], "ts", "1 hour")
        landing.to_table(once, out, checkpoint).awaitTermination()
    assert rows(spark.read.parquet(out), "event_id") == [(1,), (2,)]
