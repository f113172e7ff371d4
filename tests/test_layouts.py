"""Files of different layouts in one folder."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from eventide.schemas import WINDOW_AT_REST
from eventide.sources import layouts
from eventide.sources import windows as store

WHOLE = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
PLAIN = [
    *WHOLE, T.FloatType(), T.DoubleType(), T.DecimalType(10, 2), T.DecimalType(20, 8), T.StringType(), T.DateType(),
    T.TimestampType(), T.TimestampNTZType(), T.BooleanType(), T.NullType(),
]
KINDS = st.recursive(
    st.sampled_from(PLAIN),
    lambda inner: st.builds(T.ArrayType, inner)
    | st.dictionaries(st.sampled_from("abc"), inner, min_size=1).map(lambda d: T.StructType([T.StructField(k, v) for k, v in sorted(d.items())])),
    max_leaves=4,
)


def joined(*kinds):
    out = T.NullType()
    try:
        for kind in kinds:
            out = layouts.supertype(out, kind)
    except ValueError:
        return None
    return out


def unordered(kind):
    """Fields of a struct in the order of their names."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, unordered(f.dataType)) for f in sorted(kind.fields, key=lambda f: f.name)])
    return T.ArrayType(unordered(kind.elementType)) if isinstance(kind, T.ArrayType) else kind


@settings(max_examples=400, deadline=None)
@given(KINDS, KINDS)
def test_supertypes_hold_both(a, b):
    one, two = joined(a, b), joined(b, a)
    assert (one is None) == (two is None)
    if one is not None:
        assert unordered(one) == unordered(two)
        assert unordered(joined(one, a)) == unordered(one) == unordered(joined(one, b))
    assert unordered(joined(a, a)) == unordered(a)


@pytest.mark.parametrize(
    ("a", "b", "expected"),
    [
        ("int", "bigint", "bigint"),
        ("bigint", "double", "double"),
        ("bigint", "float", "double"),
        ("int", "decimal(10,2)", "decimal(12,2)"),
        ("decimal(38,0)", "decimal(38,10)", "double"),
        ("bigint", "string", "string"),
        ("date", "timestamp_ntz", "timestamp_ntz"),
        ("struct<x:int>", "struct<x:double,y:string>", "struct<x:double,y:string>"),
        ("map<string,int>", "map<string,bigint>", "map<string,bigint>"),
    ],
)
def test_supertype(spark, a, b, expected):
    kinds = [spark.createDataFrame([], f"c {k}").schema["c"].dataType for k in (a, b, expected)]
    assert layouts.supertype(kinds[0], kinds[1]) == kinds[2]


def test_types_without_a_common_one():
    with pytest.raises(ValueError, match="column c: no common type of array<int> and int"):
        layouts.join_layouts(
            T.StructType([T.StructField("c", T.ArrayType(T.IntegerType()))]), T.StructType([T.StructField("c", T.IntegerType())])
        )


def frames(spark):
    return [
        spark.createDataFrame([(1, "b")], "total_events bigint, window_start string"),
        spark.createDataFrame([(2.5, "a", "x")], "total_events double, window_start string, extra string"),
        spark.createDataFrame([(3, "d")], "total_events int, window_start string"),
        spark.createDataFrame([("c", 4)], "window_start string, total_events bigint"),
    ]


def test_one_folder_of_several_layouts(spark, tmp_path):
    path = str(tmp_path / "mixed")
    for frame in frames(spark):
        frame.write.mode("append").parquet(path)
    got = store.scan_folders(spark, path)
    assert dict(got.dtypes) == {"total_events": "double", "window_start": "string", "extra": "string"}
    rows = [(r.window_start, r.total_events, r.extra) for r in got.collect()]
    assert rows == [("a", 2.5, "x"), ("b", 1.0, None), ("c", 4.0, None), ("d", 3.0, None)]
    found = layouts.read_layouts(spark, path)
    assert "" not in found and len(found) == 4


def test_files_of_one_layout_are_read_together(spark, tmp_path):
    path = str(tmp_path / "same")
    for _ in range(5):
        frames(spark)[0].coalesce(1).write.mode("append").parquet(path)
    assert [len(files) for files in layouts.read_layouts(spark, path).values()] == [5]


def test_nested_layouts(spark, tmp_path):
    path = str(tmp_path / "nested")
    spark.createDataFrame([(1, [(1, None)], {"k": 1})], "id int, l array<struct<a:int,b:string>>, m map<string,int>").write.parquet(path)
    wide = spark.createDataFrame([(2, [(1.5,)], None)], "id int, l array<struct<a:double>>, m map<string,bigint>")
    wide.write.mode("append").parquet(path)
    got = {r.id: (r.l, r.m) for r in layouts.read_mixed(spark, path).collect()}
    assert got == {1: ([(1.0, None)], {"k": 1}), 2: ([(1.5, None)], None)}


def test_folders_named_by_a_column(spark, tmp_path):
    path = str(tmp_path / "runs")
    for number, frame in enumerate(frames(spark)[:3]):
        frame.write.parquet(f"{path}/run_id=r {number}")
    got = store.scan_folders(spark, path).collect()
    assert sorted((r.run_id, r.total_events) for r in got) == [("r 0", 1.0), ("r 1", 2.5), ("r 2", 3.0)]


def test_no_files(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    got = store.scan_folders(spark, str(tmp_path / "absent"), str(tmp_path / "empty"))
    assert got.schema == WINDOW_AT_REST and got.count() == 0


def test_files_that_tasks_cannot_open_are_left_to_spark(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "far")
    for frame in (frames(spark)[0], frames(spark)[3]):
        frame.write.mode("append").parquet(path)
    files = [f for some in layouts.read_layouts(spark, path).values() for f in some]
    monkeypatch.setattr(layouts, "read_layouts", lambda spark, folder: {"": files})
    assert sorted(r.total_events for r in layouts.read_mixed(spark, path).collect()) == [1, 4]
