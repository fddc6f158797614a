import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.plans import metadata_ingest as mi
from lakeops.sources import footers, layout, readers, sinks
from lakeops.sources.snapshots import VersionedTable
from lakeops.streaming import file_stream


def test_corrupt_lines_are_quarantined_whole(spark, tmp_path, rows):
    (tmp_path / "gold.csv").write_text("Year,Total\n2020,100\n2021,many\nnot a line\n2022,300\n2023,5,6\n")
    parsed = readers.read_csv_permissive(spark, str(tmp_path / "gold.csv"), "Year int, Total int")
    clean, bad = sinks.split_corrupt(parsed, str(tmp_path / "split"))
    assert rows(clean) == [(2020, 100), (2022, 300)]
    assert rows(bad, readers.CORRUPT) == [("2021,many",), ("2023,5,6",), ("not a line",)]
    assert clean.count() + bad.count() == 5


def test_readers(spark, tmp_path, rows):
    (tmp_path / "apples.csv").write_text("tag,orchard,grams\na1,hill,142\na2,,97\n")
    apples = readers.read_csv(spark, str(tmp_path / "apples.csv"), "tag string, orchard string, grams int")
    assert rows(apples) == [("a1", "hill", 142), ("a2", None, 97)]
    (tmp_path / "log_1.json").write_text('{"a": 1}\n')
    (tmp_path / "log_2.json").write_text('{"a": 2}\n')
    assert rows(readers.read_json(spark, str(tmp_path / "log_*.json"))) == [(1,), (2,)]
    (tmp_path / "products.json").write_text('{"id": 1, "price": 9.5, "images": ["a", "b"], "unknown": 1}\n')
    products = readers.read_products(spark, str(tmp_path / "products.json"))
    assert rows(products, "id", "price", "images", "brand") == [(1, 9.5, ["a", "b"], None)]


def test_partition_floor_and_path_sql(spark, tmp_path, rows):
    path = str(tmp_path / "p")
    spark.range(10).coalesce(1).write.parquet(path)
    assert readers.read_with_floor(spark, path, min_partitions=4).rdd.getNumPartitions() == 4
    assert readers.read_with_floor(spark, path).rdd.getNumPartitions() == 1
    assert rows(readers.read_path_sql(spark, path, "id > 7")) == [(8,), (9,)]
    spark.read.parquet(path).createOrReplaceTempView("path_rows")
    assert rows(readers.query_table(spark, "path_rows", "id", 3)) == [(3,)]


def test_sized_write(spark, tmp_path):
    assert readers.partitions_for(500 * 1024**3) == 4000
    assert readers.partitions_for(0) == 1
    spark.range(1000).repartition(5).write.parquet(str(tmp_path / "in"))
    df = spark.read.parquet(str(tmp_path / "in"))
    sizes = sum(f.stat().st_size for f in (tmp_path / "in").glob("*.parquet"))
    assert readers.input_bytes(df) == sizes
    assert sinks.write_sized(df, str(tmp_path / "one")) == 1
    assert sinks.write_sized(df, str(tmp_path / "many"), source_bytes=3 * 128 * 1024 * 1024) == 3
    assert len(list((tmp_path / "many").glob("*.parquet"))) == 3
    sinks.write_files(df, str(tmp_path / "csv"), "csv", header="true")
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 1000


def test_ranges_match_the_files(spark, tmp_path):
    path = str(tmp_path / "f")
    df = spark.range(4000).select("id", (F.col("id") * 37 % 1000).cast("double").alias("price"),
                                  F.when(F.col("id") % 4 > 0, F.col("id")).alias("maybe"))
    layout.cluster_by_range(df, "price", 4).write.parquet(path)
    stats = footers.file_ranges(spark, path, df.columns)
    files = {f.as_uri(): pq.read_table(f).to_pandas() for f in (tmp_path / "f").glob("*.parquet")}
    assert stats.count() == 3 * len(files) == 12
    for r in stats.collect():
        held = files[r.file.replace("file:/", "file:///").replace("file://////", "file:///")]
        assert (r.rows, r.nulls) == (len(held), held[r.column].isna().sum())
        assert (float(r.min_value), float(r.max_value)) == (held[r.column].min(), held[r.column].max())
    assert footers.range_overlaps(stats, "price").where("overlaps").count() == 0
    assert footers.range_overlaps(stats, "id").where("overlaps").count() == 3


def test_overlaps_of_many_files(spark, rows):
    spans = [(f"f{i:03}", "c", i * 10, i * 10 + (500 if i == 40 else 9)) for i in range(200)] + [("none", "c", None, None)]
    ranges = spark.createDataFrame(spans, "file string, column string, min_value string, max_value string")
    found = footers.range_overlaps(ranges, "c")
    assert [r for r, in rows(found.where("overlaps"), "file")] == [f"f{i:03}" for i in range(41, 90)]
    assert found.count() == 200


def test_zorder_narrows_both_columns(spark, tmp_path, rows):
    df = spark.range(20000).select((F.col("id") * 7919 % 1000).alias("a"), (F.col("id") * 104729 % 997).alias("b"))
    path = str(tmp_path / "z")
    layout.cluster_by_zorder(df, ["a", "b"], 16).write.parquet(path)
    assert rows(spark.read.parquet(path)) == rows(df)
    stats = footers.file_ranges(spark, path, ["a", "b"])
    span = F.max(F.col("max_value").cast("double")) - F.min(F.col("min_value").cast("double"))
    spans = stats.groupBy("file", "column").agg(span.alias("span")).groupBy("column").agg(F.avg("span")).collect()
    assert all(average < 500 for _, average in spans)


def test_zorder_of_texts_times_and_missing_values(spark, tmp_path, rows):
    number = F.col("id") * 7919 % 4000
    df = spark.range(12000).select(
        F.when(F.col("id") % 3 > 0, F.format_string("name %05d", number)).alias("name"),
        F.timestamp_seconds(F.col("id") * 104729 % 99991).alias("seen"),
        F.map_from_arrays(F.array("id"), F.array("id")).alias("extra"),
    )
    path = str(tmp_path / "z")
    layout.cluster_by_zorder(df, ["name", "seen"], 16).write.parquet(path)
    assert rows(spark.read.parquet(path).drop("extra")) == rows(df.drop("extra"))
    files = spark.read.parquet(path).groupBy("_metadata.file_path").agg(
        (F.max(F.substring("name", 6, 5).cast("int")) - F.min(F.substring("name", 6, 5).cast("int"))).alias("names"),
        ((F.max("seen").cast("long") - F.min("seen").cast("long")) / 99991 * 4000).alias("times"),
    )
    wide = files.agg(F.avg("names"), F.avg("times")).first()
    assert wide[0] < 2200 and wide[1] < 2200


def feed_control(spark, path):
    return mi.ControlTables(
        spark.createDataFrame(
            [("c1", "feed", "csv", {"header": "true", "path": path}), ("c2", "other", "csv", {})],
            "source_config_id string, source_name string, source_type string, connection_details map<string, string>"),
        spark.createDataFrame(
            [("s1", "c1", "power", "FLOAT", True, 3, "power * 2"), ("s1", "c1", "timestamp", "STRING", True, 1, None),
             ("s1", "c1", "device_id", "STRING", True, 2, None), ("s2", "c2", "x", "STRING", True, 1, None)],
            "schema_id string, source_config_id string, column_name string, data_type string, nullable boolean, "
            "ordinal_position int, transformation_hint string"),
        spark.createDataFrame(
            [("s1", "device_id", "equipment_id", "reading"), ("s2", "x", "y", "elsewhere")],
            "schema_id string, source_column_name string, target_column_name string, target_table_name string"),
        spark.createDataFrame([("s1", "power > 0"), ("s2", "y > 0")], "schema_id string, validation_expression string"),
    )


def test_metadata_ingest(spark, tmp_path, rows):
    (tmp_path / "feed.csv").write_text(
        "timestamp,device_id,power\n2024-01-01T10:00:00,e1,5\nyesterday,e1,6\n2024-01-01T11:00:00,e2,7\n"
        "2024-01-01T12:00:00,e9,8\n2024-01-01T13:00:00,e1,-1\n2024-01-01T14:00:00,e1,\n")
    sensors = spark.createDataFrame(
        [("e1", "s1", 1), ("e2", "s2", 2)], "equipment_id string, sensor_id string, unit_id int"
    )
    units = spark.createDataFrame([(1, "kW")], "unit_id int, unit_type string")
    target = T.StructType.fromDDL("timestamp timestamp not null, sensor_id string not null, metric_name string")
    flagged = mi.ingest(spark, feed_control(spark, str(tmp_path / "feed.csv")), "feed", sensors, units, target)
    valid, invalid = mi.write_by_quality(flagged, str(tmp_path / "readings"))
    assert rows(valid, "equipment_id", "metric_value", "metric_name", "sensor_id") == [
        ("e1", 10.0, "kW", "s1"), ("e2", 14.0, None, "s2")]
    assert rows(invalid, "equipment_id", "metric_value") == [("e1", 12.0), ("e9", 16.0)]
    assert valid.unionByName(invalid).select("reading_id").distinct().count() == 4
    assert rows(valid, F.col("metadata")["source"])[0] == ("feed",)
    assert mi.flag_quality(valid, []).where("quality_flag = 'Valid'").count() == 2
    with pytest.raises(ValueError):
        mi.source_plan(feed_control(spark, ""), "nobody")


def test_hints_see_what_earlier_hints_made(spark, rows):
    columns = [
        {"column_name": "a", "transformation_hint": "a + 1"},
        {"column_name": "b", "transformation_hint": "a * 10"},
        {"column_name": "c", "transformation_hint": None},
    ]
    plan = mi.SourcePlan(config={}, columns=columns, mapping={"b": "renamed"}, rules=["renamed > 20"], target="t")
    raw = spark.createDataFrame([(1, 0, "x"), (4, 0, "y")], "a int, b int, c string")
    assert rows(mi.apply_plan(raw, plan)) == [(5, 50, "y")]


def test_stream_takes_each_file_once(spark, tmp_path, rows):
    landed, sink, checkpoint = (str(tmp_path / n) for n in ("landed", "sink", "checkpoint"))

    def run():
        schema = file_stream.stream_schema(spark, landed, str(tmp_path / "schema"))
        query = file_stream.drain(
            file_stream.file_stream(spark, landed, schema, max_files_per_batch=2), sink, checkpoint)
        return sum(p["numInputRows"] for p in query.recentProgress)

    spark.range(100).repartition(5).write.parquet(landed)
    assert run() == 100
    assert run() == 0
    spark.range(100, 130).write.mode("append").parquet(landed)
    assert run() == 30
    assert rows(spark.read.parquet(sink)) == rows(spark.range(130))


def test_stream_upsert(spark, tmp_path, rows):
    landed = str(tmp_path / "landed")
    versions = VersionedTable(spark, str(tmp_path / "table"))
    for batch in ([(1, "a"), (2, "b")], [(2, "B"), (3, "c")]):
        spark.createDataFrame(batch, "id int, v string").write.mode("append").parquet(landed)
        stream = file_stream.file_stream(spark, landed, spark.read.parquet(landed).schema)
        file_stream.drain_batches(stream, str(tmp_path / "checkpoint"), file_stream.upsert_into(versions, ["id"]))
    assert rows(versions.read()) == [(1, "a"), (2, "B"), (3, "c")]
    assert versions.current_version() == 1
    # A batch that comes again, as after a crash, changes nothing.
    file_stream.upsert_into(versions, ["id"])(spark.createDataFrame([(1, "z")], "id int, v string"), 1)
    assert versions.current_version() == 1


def test_a_frequent_value_is_clustered_into_many_files(spark, tmp_path):
    df = spark.range(8000).select(F.when(F.col("id") % 2 == 0, 500).otherwise(F.col("id") % 1000).alias("v"))
    layout.cluster_by_range(df, "v", 8).write.parquet(str(tmp_path / "hot"))
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in (tmp_path / "hot").glob("*.parquet")]
    assert len(sizes) == 8 and max(sizes) < 2000
    stats = footers.file_ranges(spark, str(tmp_path / "hot"), ["v"])
    assert footers.range_overlaps(stats, "v").where("overlaps").count() == 0
