"""Ingest of files and streams, quarantine, and file layouts."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.plans import metadata_ingest
from lakeops.queries.registry import query, table
from lakeops.session import parallelism, work_dir
from lakeops.sources import footers, layout, readers, sinks
from lakeops.sources.snapshots import VersionedTable
from lakeops.streaming import file_stream, growing


@query(
    "corrupt_split",
    """
    SELECT o_orderkey, o_totalprice, false AS corrupt FROM orders WHERE o_orderstatus <> 'P'
    UNION ALL SELECT o_orderkey, NULL, true FROM orders WHERE o_orderstatus = 'P'
    """,
)
def corrupt_split(spark, sf):
    """Orders as CSV, the price of pending ones being no number, split into clean and quarantined rows."""
    base = work_dir(spark, "corrupt")
    price = F.when(F.col("o_orderstatus") == "P", "pending").otherwise(F.col("o_totalprice").cast("string"))
    table(spark, sf, "orders").select("o_orderkey", price.alias("o_totalprice")).write.option("header", True).csv(
        f"{base}/csv"
    )
    parsed = readers.read_csv_permissive(spark, f"{base}/csv", "o_orderkey bigint, o_totalprice double")
    clean, quarantined = sinks.split_corrupt(parsed, f"{base}/split")
    key = F.split_part(F.col(readers.CORRUPT), F.lit(","), F.lit(1)).cast("bigint")
    return clean.withColumn("corrupt", F.lit(False)).unionByName(
        quarantined.select(key.alias("o_orderkey"), "o_totalprice", F.lit(True).alias("corrupt"))
    )


@query(
    "csv_scan",
    "SELECT o_orderkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders",
)
def csv_scan(spark, sf):
    """Orders as CSV with a header, read with a declared schema; only the columns asked for are parsed."""
    path = work_dir(spark, "csv")
    orders = table(spark, sf, "orders")
    orders.withColumn("o_orderdate", F.col("o_orderdate").cast("date")).write.option("header", True).csv(path)
    schema = ", ".join(
        f"{name} {'date' if name == 'o_orderdate' else kind}" for name, kind in orders.dtypes
    )
    return readers.read_csv(spark, path, schema).select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")


@query(
    "metadata_ingest",
    """
    SELECT device AS equipment_id, read_at,
           sha256(concat_ws('|', 'events', CAST(device AS VARCHAR), strftime(read_at, '%Y-%m-%d %H:%M:%S'))) AS reading_id,
           CAST(value AS FLOAT) AS metric_value, c_name AS sensor_id, n_name AS metric_name, 'events' AS origin,
           CASE WHEN event_type <> 'error' AND n_name IS NOT NULL THEN 'Valid' ELSE 'Invalid' END AS quality_flag,
           upper(event_type) AS kind
    FROM (
      SELECT *, CASE WHEN event_type <> 'error' THEN CAST(date_trunc('second', ts) AS TIMESTAMP) END AS read_at,
             CASE WHEN user_id % 5 = 0 THEN user_id + 1000000000 ELSE user_id END AS device
      FROM events
    ) LEFT JOIN customer ON device = c_custkey
      LEFT JOIN nation ON c_nationkey = n_nationkey
    WHERE value >= 1
    """,
)
def metadata_ingest_query(spark, sf):
    """Events as a sensor feed: customers are sensors and nations units.

    Readings of errors lack a time, and a fifth of the devices are no known sensor.
    """
    base = work_dir(spark, "feed")
    events = table(spark, sf, "events")
    time = F.when(F.col("event_type") != "error", F.date_format("ts", metadata_ingest.FEED_TIME))
    events.select(
        F.concat(F.col("event_type"), F.lit(" "), F.date_format("ts", metadata_ingest.FEED_TIME)).alias("note"),
        time.alias("timestamp"),
        F.when(F.col("user_id") % 5 == 0, F.col("user_id") + 1_000_000_000)
        .otherwise(F.col("user_id"))
        .cast("string")
        .alias("device_id"),
        F.col("value").alias("power"),
    ).write.option("header", True).csv(base)
    control = metadata_ingest.ControlTables(
        config=spark.createDataFrame(
            [("c1", "events", "csv", {"header": "true", "path": base})],
            "source_config_id string, source_name string, source_type string, "
            "connection_details map<string, string>",
        ),
        columns=spark.createDataFrame(
            [
                ("s1", "c1", "power", "FLOAT", True, 4, None),
                ("s1", "c1", "note", "STRING", True, 1, "concat_ws(' ', upper(split_part(note, ' ', 1)), "
                                                        "split_part(note, ' ', 2))"),
                ("s1", "c1", "timestamp", "STRING", True, 2, None),
                ("s1", "c1", "device_id", "IDENTIFIER", True, 3, "trim(device_id)"),
            ],
            "schema_id string, source_config_id string, column_name string, data_type string, nullable boolean, "
            "ordinal_position int, transformation_hint string",
        ),
        mapping=spark.createDataFrame(
            [("s1", "note", "remark", "reading"), ("s1", "device_id", "equipment_id", "reading")],
            "schema_id string, source_column_name string, target_column_name string, target_table_name string",
        ),
        rules=spark.createDataFrame([("s1", "power >= 1")], "schema_id string, validation_expression string"),
    )
    sensors = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("equipment_id"),
        F.col("c_name").alias("sensor_id"),
        F.col("c_nationkey").alias("unit_id"),
    )
    units = table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("unit_id"), F.col("n_name").alias("unit_type")
    )
    target = T.StructType.fromDDL("equipment_id string, timestamp timestamp not null, metric_name string not null")
    flagged = metadata_ingest.ingest(spark, control, "events", sensors, units, target)
    valid, invalid = metadata_ingest.write_by_quality(flagged, f"{base}-readings")
    return valid.unionByName(invalid).select(
        F.col("equipment_id").cast("bigint").alias("equipment_id"),
        F.col("timestamp").cast("timestamp_ntz").alias("read_at"),
        "reading_id",
        "metric_value",
        "sensor_id",
        "metric_name",
        F.col("metadata")["source"].alias("origin"),
        "quality_flag",
        F.split_part("remark", F.lit(" "), F.lit(1)).alias("kind"),
    )


@query("stream_ingest", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def stream_ingest(spark, sf):
    """Events land as files in two batches; a run after each takes in the new files only."""
    base = work_dir(spark, "stream")
    events = table(spark, sf, "events")
    landed, sink, checkpoint = f"{base}/landed", f"{base}/sink", f"{base}/checkpoint"
    is_error = F.coalesce(F.col("event_type") == "error", F.lit(False))
    for arriving in (~is_error, is_error):
        events.where(arriving).write.mode("append").parquet(landed)
        schema = file_stream.stream_schema(spark, landed, f"{base}/schema")
        file_stream.drain(file_stream.file_stream(spark, landed, schema), sink, checkpoint)
    return spark.read.schema(schema).parquet(sink)


@query(
    "stream_growing",
    """
    SELECT event_id, user_id, CASE WHEN event_type <> 'error' THEN value END AS value,
           CASE WHEN event_type IN ('error', 'click') THEN event_type END AS event_type,
           CASE WHEN event_type IN ('error', 'click') THEN ts END AS seen,
           CASE WHEN event_type = 'error' THEN '{"value":"out of range"}' END AS rescued
    FROM events
    """,
)
def stream_growing(spark, sf):
    """Later files bring two new columns, and a text for the value, which is no number in some of them."""
    base = work_dir(spark, "stream-growing")
    events = table(spark, sf, "events")
    late = F.coalesce(F.col("event_type").isin("error", "click"), F.lit(False))
    early_files = events.where(~late).select("event_id", "user_id", "value")
    text = F.when(F.col("event_type") == "error", "out of range").otherwise(F.col("value").cast("string"))
    seen = F.col("ts").alias("seen")
    late_files = events.where(late).select("event_id", "event_type", text.alias("VALUE"), "user_id", seen)
    for arriving in (early_files, late_files):
        arriving.write.mode("append").parquet(f"{base}/landed")
        growing.drain_growing(
            spark, f"{base}/landed", f"{base}/sink", f"{base}/schema", f"{base}/checkpoint", rescued="rescued"
        )
    return growing.read_grown(spark, f"{base}/sink", f"{base}/schema", rescued="rescued")


@query(
    "stream_upsert",
    """
    SELECT user_id, event_type, event_id, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) = 1
    """,
)
def stream_upsert(spark, sf):
    """Newest event per user and type, kept by merging each batch of newly landed files."""
    base = work_dir(spark, "stream-upsert")
    events = table(spark, sf, "events").select("user_id", "event_type", "event_id", "value")
    versions = VersionedTable(spark, f"{base}/table")
    middle = events.agg((F.max("event_id") / 2).cast("bigint")).first()[0]
    keys = ["user_id", "event_type"]
    early = F.coalesce(F.col("event_id") <= middle, F.lit(False))
    for arriving in (early, ~early):
        newest = events.where(arriving).groupBy(*keys).agg(
            F.max("event_id").alias("event_id"), F.max_by("value", "event_id").alias("value")
        )
        newest.write.mode("append").parquet(f"{base}/landed")
        stream = file_stream.file_stream(spark, f"{base}/landed", newest.schema)
        file_stream.drain_batches(stream, f"{base}/checkpoint", file_stream.upsert_into(versions, keys))
    return versions.read()


@query(
    "json_multi_line",
    """
    SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer
    """,
)
def json_multi_line(spark, sf):
    """Customers as lists over many lines, about a thousand to a file; the nested schema is inferred."""
    base = work_dir(spark, "documents")
    customers = table(spark, sf, "customer")
    document = F.struct(
        F.col("c_custkey").alias("id"),
        F.struct(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")).alias("account"),
        F.array("c_mktsegment").alias("segments"),
    )
    files = max(1, customers.count() // 1000)
    lists = customers.groupBy(F.pmod(F.xxhash64("c_custkey"), F.lit(files)).alias("file")).agg(
        F.collect_list(document).alias("list")
    )
    pretty = lists.select(F.to_json("list", {"pretty": "true"}).alias("value"))
    pretty.write.option("maxRecordsPerFile", 1).text(base)
    found = readers.read_json(spark, base, multi_line=True)
    return found.select("id", "account.name", "account.balance", F.col("segments")[0].alias("segment"))


@query(
    "json_glob",
    "SELECT event_id, event_type, value FROM events WHERE event_type IN ('click', 'error')",
)
def json_glob(spark, sf):
    """Events as JSON lines in a folder per type, two of which a glob reads."""
    base = work_dir(spark, "json-events")
    events = table(spark, sf, "events").select("event_id", "event_type", "value")
    events.withColumn("kind", F.coalesce("event_type", F.lit("none"))).write.partitionBy("kind").json(base)
    return readers.read_json(
        spark, f"{base}/kind={{click,error}}", "event_id bigint, event_type string, value double"
    )


LINES_SQL = "SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity FROM lineitem"


def _lines(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity"
    )


@query("compact", LINES_SQL)
def compact(spark, sf):
    """Three appends of many small files, rewritten in files of the target size."""
    versions = VersionedTable(spark, work_dir(spark, "small-files"))
    lines = table(spark, sf, "lineitem")
    # Any other flag, or none, is in the last part.
    flag = F.coalesce("l_returnflag", F.lit(""))
    for arriving in (flag == "A", flag == "N", ~flag.isin("A", "N")):
        versions.append(
            lines.where(arriving)
            .select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity")
            .repartition(parallelism(spark))
        )
    versions.compact()
    return versions.read()


@query("cluster_layout", LINES_SQL)
def cluster_layout(spark, sf):
    path = work_dir(spark, "clustered")
    layout.cluster_by_range(_lines(spark, sf), "l_extendedprice", parallelism(spark)).write.parquet(path)
    return spark.read.parquet(path)


@query("cluster_zorder", LINES_SQL)
def cluster_zorder(spark, sf):
    path = work_dir(spark, "zorder")
    lines = _lines(spark, sf)
    layout.cluster_by_zorder(lines, ["l_partkey", "l_extendedprice"], parallelism(spark)).write.parquet(path)
    return spark.read.parquet(path)


@query("sized_write", LINES_SQL)
def sized_write(spark, sf):
    path = work_dir(spark, "sized")
    sinks.write_sized(_lines(spark, sf), path)
    return spark.read.parquet(path)


@query(
    "partitioned_write",
    "SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders WHERE o_orderpriority = '1-URGENT'",
)
def partitioned_write(spark, sf):
    """A folder per priority; the filter lists only its own."""
    path = work_dir(spark, "partitioned")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    sinks.write_files(orders, path, partition_by=["o_orderpriority"])
    return readers.read_path_sql(spark, path, "o_orderpriority = '1-URGENT'")


@query(
    "parquet_footers",
    """
    SELECT 'l_extendedprice' AS column_name, count(*) AS row_count, min(l_extendedprice) AS low,
           max(l_extendedprice) AS high, CAST(0 AS BIGINT) AS overlapping FROM lineitem
    UNION ALL
    SELECT 'l_quantity', count(*), min(l_quantity), max(l_quantity), NULL FROM lineitem
    """,
)
def parquet_footers(spark, sf):
    """Bounds of two columns by clustered file, and the files whose ranges overlap."""
    path = work_dir(spark, "footers")
    layout.cluster_by_range(_lines(spark, sf), "l_extendedprice", parallelism(spark)).write.parquet(path)
    ranges = footers.file_ranges(spark, path, ["l_extendedprice", "l_quantity"])
    overlaps = (
        footers.range_overlaps(ranges, "l_extendedprice")
        .agg(F.count_if("overlaps").alias("overlapping"))
        .withColumn("column_name", F.lit("l_extendedprice"))
    )
    bounds = ranges.groupBy(F.col("column").alias("column_name")).agg(
        F.sum("rows").alias("row_count"),
        F.min(F.col("min_value").cast("double")).alias("low"),
        F.max(F.col("max_value").cast("double")).alias("high"),
    )
    return bounds.join(overlaps, "column_name", "left")


@query("cluster_zorder_text", "SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer")
def cluster_zorder_text(spark, sf):
    """Customers along a Z-curve of a text and a number."""
    path = work_dir(spark, "zorder-text")
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    layout.cluster_by_zorder(customers, ["c_name", "c_acctbal"], parallelism(spark)).write.parquet(path)
    return spark.read.parquet(path)
