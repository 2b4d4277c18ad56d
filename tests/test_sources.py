"""Loader, null tokens, declared casts, versions (reference: loader tests, FIXTURES A1)."""

from __future__ import annotations

import pytest

from tessera.sources import readers as R
from tessera.sources import sinks as K

from .conftest import rows


@pytest.fixture()
def csv_dir(tmp_path):
    p = tmp_path / "data.csv"
    p.write_text("feature1,feature2,target\n1,A,100\n2,B,200\n3,C,300\n4,D,400\n5,E,500\n")
    return tmp_path


def test_read_csv_with_header(spark, csv_dir):
    df = R.read_table(spark, str(csv_dir / "data.csv"), fmt="csv")
    assert df.columns == ["feature1", "feature2", "target"]
    assert df.count() == 5


def test_read_relative_path_and_stage(spark, csv_dir):
    cfg = {"data_source": {"raw_path": "data.csv", "processed_path": "data.csv", "type": "csv",
                           "delimiter": ",", "header": 0, "encoding": "utf-8"}}
    assert R.read_stage(spark, cfg, "raw", root=str(csv_dir)).count() == 5
    assert R.read_stage(spark, cfg, "processed", root=str(csv_dir)).count() == 5
    with pytest.raises(ValueError, match="Unknown data_stage"):
        R.read_stage(spark, cfg, "staging", root=str(csv_dir))
    with pytest.raises(ValueError, match="No path configured"):
        R.read_stage(spark, {"data_source": {"type": "csv"}}, "raw")


@pytest.mark.parametrize("bad", ["", None, 3])
def test_bad_paths(spark, bad):
    with pytest.raises(ValueError):
        R.read_table(spark, bad)


def test_missing_file_and_type(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        R.read_table(spark, str(tmp_path / "nope.csv"))
    with pytest.raises(ValueError, match="Unsupported file type: txt"):
        R.read_table(spark, str(tmp_path / "x.txt"), fmt="txt")


def test_null_tokens_and_declared_casts(spark, tmp_path):
    p = tmp_path / "t.csv"
    p.write_text("id,amount,label,n\n1,2.5,NA,3.0\n2,N/A,x,4\nnull,7,,5.5\n")
    declared = [{"name": "id", "dtype": "int"}, {"name": "amount", "dtype": "float"},
                {"name": "label", "dtype": "str"}, {"name": "n", "dtype": "int"}]
    df = R.read_declared(spark, str(p), declared)
    assert [f.dataType.simpleString() for f in df.schema.fields] == ["bigint", "double", "string", "bigint"]
    got = sorted((tuple(r) for r in df.collect()), key=repr)
    # "3.0" is a whole number → 3; "5.5" is not an integer → null; every token → null.
    assert got == sorted([(1, 2.5, None, 3), (2, None, "x", 4), (None, 7.0, None, None)], key=repr)


def test_infer_types(spark):
    df = spark.createDataFrame([("1", "1.5", "a", None), ("2", "3", "b", None)],
                               "a string, b string, c string, d string")
    assert dict(rows(R.infer_types(df))) == {"a": "int", "b": "float", "c": "str", "d": "float"}


def test_publish_and_latest(spark, tmp_path):
    root = str(tmp_path / "store")
    df1 = spark.range(3)
    df2 = spark.range(5)
    assert K.publish(df1, root, "raw") == 1
    assert K.publish(df2, root, "raw") == 2
    assert R.latest(spark, root, "raw").count() == 5
    assert R.latest(spark, root, "raw", version=1).count() == 3
    with pytest.raises(FileNotFoundError):
        R.latest(spark, root, "other")


def test_feature_list_roundtrip(spark, tmp_path):
    path = str(tmp_path / "features")
    K.write_feature_list(spark, ["b", "a", "c"], path)
    assert R.read_feature_list(spark, path) == ["b", "a", "c"]


def test_csv_quotes_and_line_breaks_round_trip(spark, tmp_path):
    from tessera.sources.readers import read_table
    from tessera.sources.sinks import write_csv
    given = [(1, 'a "b", c'), (2, "two\nlines"), (3, "back\\slash"), (4, "plain")]
    df = spark.createDataFrame(given, "id int, text string")
    write_csv(df, str(tmp_path / "t"))
    back = read_table(spark, str(tmp_path / "t"), schema=df.schema, multi_line=True)
    assert sorted(map(tuple, back.collect())) == given


def test_record_integers_stay_exact(spark):
    from tessera.sources.records import parse_records
    df = spark.createDataFrame([('{"k": 9007199254740993}',), ('{"k": 7.0}',), ('{"k": 7.5}',)], "value string")
    valid, rejected = parse_records(df, [{"name": "k", "dtype": "int", "required": True}])
    assert sorted(r["k"] for r in valid.collect()) == [7, 9007199254740993] and rejected.count() == 1


def test_fingerprint_sees_which_column_is_null(spark):
    from tessera.operators.profile import fingerprint
    a = spark.createDataFrame([(1, None)], "a int, b int")
    b = spark.createDataFrame([(None, 1)], "a int, b int")
    assert fingerprint(a).first() != fingerprint(b).first()


def test_session_keeps_given_settings(spark):
    from tessera.session import get_session
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.master")}
    spark.conf.set("spark.sql.shuffle.partitions", "77")
    try:
        again = get_session()
        assert again.conf.get("spark.sql.shuffle.partitions") == "77" and again.conf.get("spark.master") == before["spark.master"]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before["spark.sql.shuffle.partitions"])
