import uuid

from lakeops.plans import quality_rules
from lakeops.session import materialize, parallelism, path_exists, work_dir
from lakeops.sources import sinks


def test_work_folders_are_new_and_under_the_shared_folder(spark):
    first, second = work_dir(spark, "x"), work_dir(spark, "x")
    assert first != second
    assert first.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert not path_exists(spark, first)


def test_without_a_checkpoint_folder_the_warehouse_is_used(spark):
    class Settings:
        @staticmethod
        def get(key, default=None):
            return default if key == "spark.checkpoint.dir" else spark.conf.get(key, default)

    class Session:
        conf, sparkContext, _jvm, _jsc = Settings, spark.sparkContext, spark._jvm, spark._jsc

    assert work_dir(Session(), "x").startswith(spark.conf.get("spark.sql.warehouse.dir"))


def test_materialize_keeps_rows_and_schema(spark, rows):
    df = spark.createDataFrame([(1, "a", None), (2, None, [1, 2])], "id int, v string, list array<int>")
    stored = materialize(df, "test")
    assert stored.schema == df.schema
    assert rows(stored) == rows(df)
    assert path_exists(spark, stored.inputFiles()[0])
    assert materialize(df.limit(0), "test").count() == 0


def test_parallelism_is_the_shuffle_setting(spark):
    assert parallelism(spark) == 8


def test_summaries_are_appended_to_a_table(spark):
    name = f"summary_{uuid.uuid4().hex}"
    rules = [{"id": "N", "type": "custom_sql", "expression": "id > 2", "description": "big", "category": "c"}]
    for batch in ("b1", "b2"):
        summary = quality_rules.rule_summary(spark.range(5), rules, "job", "now", batch)
        sinks.write_table(summary, name, "append")
    kept = spark.table(name)
    assert sorted((r.batch_id, r.failed_count) for r in kept.collect()) == [("b1", 2), ("b2", 2)]
    sinks.write_table(kept.limit(0), f"{name}_empty")
    assert spark.table(f"{name}_empty").count() == 0
    for table in (name, f"{name}_empty"):
        spark.sql(f"DROP TABLE {table}")
