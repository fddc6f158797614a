"""Streams of files whose columns change."""

import json

import pytest
from pyspark.sql import types as T

from lakeops.streaming import growing


@pytest.fixture
def lake(spark, tmp_path):
    places = {name: str(tmp_path / name) for name in ("landed", "sink", "schema", "checkpoint")}

    class Lake:
        def land(self, data, schema, format="parquet"):
            spark.createDataFrame(data, schema).coalesce(1).write.mode("append").format(format).save(places["landed"])

        def run(self, **options):
            args = places["landed"], places["sink"], places["schema"], places["checkpoint"]
            return growing.drain_growing(spark, *args, **options)

        def read(self, **options):
            return growing.read_grown(spark, places["sink"], places["schema"], **options)

    return Lake()


def told(row):
    return None if row is None else json.loads(row)


def test_new_columns_and_misfits_are_kept(lake):
    lake.land([(1, "a", 5), (2, None, None)], "id int, name string, size int")
    lake.run()
    first = lake.read()
    assert first.columns == ["id", "name", "size", growing.RESCUED] and first.count() == 2
    lake.land([(3, "c", "7", 1.5), (4, "d", "wide", None)], "ID int, name string, size string, rate double")
    lake.land([(5_000_000_000, "e", 2.0), (6, "f", 2.5)], "id bigint, name string, size double")
    lake.land([(7, ["g"])], "id int, name array<string>")
    lake.run()
    got = sorted(((r.id, r.name, r.size, r.rate, told(r[growing.RESCUED])) for r in lake.read().collect()), key=repr)
    assert got == sorted(
        [
            (1, "a", 5, None, None),
            (2, None, None, None, None),
            (3, "c", 7, 1.5, None),
            (4, "d", None, None, {"size": "wide"}),
            (None, "e", 2, None, {"id": 5_000_000_000}),
            (6, "f", None, None, {"size": 2.5}),
            (7, None, None, None, {"name": ["g"]}),
        ],
        key=repr,
    )


def test_a_run_without_new_files_takes_nothing_in(lake):
    lake.land([(1,)], "id int")
    assert sum(p["numInputRows"] for p in lake.run().recentProgress) > 0
    assert sum(p["numInputRows"] for p in lake.run().recentProgress) == 0
    assert lake.read().count() == 1


def test_small_batches_and_other_formats(lake):
    for n in range(5):
        lake.land([(n, str(n))], f"id long, c{n} string", "json")
    query = lake.run(format="json", max_files_per_batch=2)
    assert len([p for p in query.recentProgress if p["numInputRows"]]) >= 3
    rows = lake.read()
    assert sorted(rows.columns) == sorted([growing.RESCUED, "id", *[f"c{n}" for n in range(5)]])
    assert sorted((r.id, [r[f"c{n}"] for n in range(5) if r[f"c{n}"] is not None]) for r in rows.collect()) == [
        (n, [str(n)]) for n in range(5)
    ]


def test_a_batch_that_comes_again_changes_nothing(lake, spark, tmp_path):
    lake.land([(1,), (2,)], "id int")
    lake.run()
    # The commit is lost, as in a crash after the write, so the same batch is handed over again.
    for commit in (tmp_path / "checkpoint" / "commits").iterdir():
        commit.unlink()
    lake.run()
    assert sorted(r.id for r in lake.read().collect()) == [1, 2]


def test_rescued_data_needs_a_free_name(lake):
    lake.land([(1, "x")], f"id int, {growing.RESCUED} string")
    with pytest.raises(Exception, match="another name"):
        lake.run()


def test_grown_keeps_types_and_order():
    a = T.StructType().add("x", T.IntegerType()).add("Y", T.StringType())
    b = T.StructType().add("y", T.DoubleType()).add("z", T.DateType(), False)
    assert growing.grown(a, b).simpleString() == "struct<x:int,Y:string,z:date>"
    assert growing.grown(T.StructType([]), b, a).simpleString() == "struct<y:double,z:date,x:int>"
