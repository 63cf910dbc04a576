from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from maskloom.functions.secrets import fresh_secret
from maskloom.operators.leakscan import LeakError
from maskloom.operators.verify import Expectation, VerificationError
from maskloom.plans.rulebook import rulebook_from
from maskloom.plans.strategies import MaskError
from maskloom.session import scratch_dir
from maskloom.sources import tables
from maskloom.sources import bundle
from maskloom.sources.bundle import BundleError, read_bundle, read_manifest, row_counts, schema_hash, write_bundle
from maskloom.sources.snapshot import snapshot
from maskloom.streaming.stream import mask_available, mask_stream
from maskloom.workload.rules import shop_rulebook


@pytest.fixture
def data(spark):
    return {"a": spark.range(10).select("id", fresh_secret().alias("s")), "b": spark.range(0).select("id")}


def test_publish_and_read_back(spark, data, tmp_path):
    seen = {}

    def gate(staged):
        seen.update({r["id"]: r["s"] for r in staged["a"].collect()})

    book = shop_rulebook()
    manifest = write_bundle(spark, data, f"{tmp_path}/out", [f"{tmp_path}/in"], book, [gate], {"a": 10})
    assert manifest["row_counts"] == {"a": 10, "b": 0} and manifest["rulebook_hash"] == book.digest
    assert manifest["schema_hash"] == schema_hash(data) and manifest == read_manifest(spark, f"{tmp_path}/out")
    # the gate saw the very values that were published
    assert {r["id"]: r["s"] for r in read_bundle(spark, f"{tmp_path}/out")["a"].collect()} == seen
    assert sorted(os.listdir(tmp_path)) == ["out"]
    assert {"schema.json", "manifest.json"} <= set(os.listdir(tmp_path / "out"))


def test_failed_gate_publishes_nothing(spark, data, tmp_path):
    def gate(staged):
        raise ValueError("leak")

    with pytest.raises(ValueError, match="leak"):
        write_bundle(spark, data, f"{tmp_path}/out", gates=[gate])
    with pytest.raises(BundleError, match="11 rows expected, 10 written"):
        write_bundle(spark, data, f"{tmp_path}/out", expected_rows={"a": 11})
    assert os.listdir(tmp_path) == []


@pytest.mark.parametrize("target, source", [("x", "x"), ("x/y", "x"), ("x", "x/y")])
def test_source_paths_are_refused(spark, data, tmp_path, target, source):
    with pytest.raises(BundleError, match="overlaps"):
        write_bundle(spark, data, f"{tmp_path}/{target}", [f"{tmp_path}/{source}"])
    assert os.listdir(tmp_path) == []


def test_sibling_with_the_same_prefix_is_fine_and_nothing_is_overwritten(spark, data, tmp_path):
    write_bundle(spark, data, f"{tmp_path}/src-masked", [f"{tmp_path}/src"])
    with pytest.raises(BundleError, match="already exists"):
        write_bundle(spark, data, f"{tmp_path}/src-masked")


def test_schema_hash_ignores_data_and_order_of_tables(spark):
    one = {"a": spark.range(1), "b": spark.range(2).select(F.col("id").cast("string"))}
    two = {"b": spark.range(9).select(F.col("id").cast("string")), "a": spark.range(3)}
    assert schema_hash(one) == schema_hash(two) != schema_hash({"a": spark.range(1), "b": spark.range(1)})
    assert {tuple(r) for r in row_counts(two).collect()} == {("a", 3), ("b", 9)}


def test_content_is_pruned_at_the_scan(spark, shop_folder):
    pages = tables.without_content(tables.read_folder(spark, shop_folder, ["pages"])["pages"], ["html"])
    read = pages._jdf.queryExecution().executedPlan().toString().split("ReadSchema:")[1]
    assert "html" not in read and "url" in read


def test_catalog_source(spark, tmp_path):
    spark.range(3).createOrReplaceTempView("some_view")
    spark.sql(f"create table some_table (id bigint) using parquet location '{tmp_path}/t'")
    try:
        read = tables.read_catalog(spark, "default")
        assert "some_view" not in read and read["some_table"].columns == ["id"]
    finally:
        spark.catalog.dropTempView("some_view")
        spark.sql("drop table some_table")


def test_scratch_lies_in_the_shared_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first != second
    if named:
        assert first.startswith(named)


def test_stream_equals_batch_and_picks_up_new_files_once(spark, tmp_path):
    book = shop_rulebook()
    source = str(tmp_path / "events")
    rows = spark.range(40).select(
        F.col("id").alias("event_id"), F.when(F.col("id") % 2 == 0, "purchase").otherwise("click").alias("event_type"), F.lit("{}x").alias("props")
    )
    rows.where("event_id < 30").write.parquet(source)

    def run():
        mask_available(spark, source, f"{tmp_path}/out", f"{tmp_path}/progress", "events", book).awaitTermination()
        return {r["event_id"]: r["props"] for r in spark.read.parquet(f"{tmp_path}/out").collect()}

    assert len(run()) == 30
    rows.where("event_id >= 30").write.mode("append").parquet(source)
    run()
    got = run()
    assert got == {i: None if i % 2 == 0 else "{}x" for i in range(40)}
    assert spark.read.parquet(f"{tmp_path}/out").count() == 40


def test_cross_row_rules_are_refused_on_streams(spark, shop_folder):
    schema = spark.read.parquet(f"{shop_folder}/customer.parquet").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "customer.parquet").parquet(shop_folder)
    with pytest.raises(MaskError, match="batch"):
        mask_stream(stream, "customer", shop_rulebook())
    empty = rulebook_from({"00_strategies": {"strategies": {"keep": None}}})
    assert mask_stream(stream, "customer", empty).isStreaming


def test_streams_rotate_secrets(spark, tmp_path):
    spark.createDataFrame([(1, "live-secret"), (2, "live-secret")], "id int, tok string").write.parquet(f"{tmp_path}/t")
    book = rulebook_from({"00_strategies": {"strategies": {"rotate_secret": None}}, "1": {"t": {"fields": {"tok": {"strategy": "rotate_secret", "rotate": "token"}}}}})
    mask_available(spark, f"{tmp_path}/t", f"{tmp_path}/out", f"{tmp_path}/progress", "t", book).awaitTermination()
    tokens = {r.tok for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert len(tokens) == 2 and "live-secret" not in tokens


def test_the_course_always_checks_known_secrets(spark, tmp_path):
    rules = {"00_strategies": {"strategies": {"drop": None}}, "1": {"payment_token": {"fields": {"other": "drop"}}}}
    data = {"payment_token": spark.createDataFrame([(1, "tok_live", "x")], "id int, provider_ref string, other string")}
    with pytest.raises(VerificationError, match="payment_token_provider_ref_null"):
        snapshot(spark, data, rulebook_from(rules), f"{tmp_path}/out", [])
    secrets = {"00_strategies": {"strategies": {"drop": None}}, "1": {"key_value_policies": [{"table": "kv", "drop_regex": "api"}]}}
    leaky = {"kv": spark.createDataFrame([("api", "sk-123"), ("note", "see sk-123")], "key string, value string")}
    with pytest.raises(LeakError, match="sk-123"):
        snapshot(spark, leaky, rulebook_from(secrets), f"{tmp_path}/out", [])


def test_a_cluster_without_a_shared_folder_is_refused():
    class Cluster:
        class conf:
            get = staticmethod(lambda key, default: None)

        class sparkContext:
            master = "spark://host:7077"
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(ValueError, match="share"):
        scratch_dir(Cluster, "x")


def test_counts_come_from_the_writing_job(spark, tmp_path, monkeypatch):
    """No table is read again for its counts and violations; merged over writers, whatever their number."""
    monkeypatch.setattr(bundle, "row_counts", lambda *_: pytest.fail("a second scan"))
    data = {f"t{i}": spark.range(10 * i).withColumn("odd", F.col("id") % 2 == 1).repartition(3) for i in range(6)}
    checks = [Expectation(f"t{i}", "none_odd", F.col("odd"), columns=("odd",)) for i in range(6)]
    checks += [Expectation("t3", "some_big", at_least_one=F.col("id") > 28, columns=("id",)), Expectation("gone", "optional"), Expectation("gone", "needed", required=True)]
    manifest = write_bundle(spark, data, f"{tmp_path}/out", checks=checks, enforce=False, writers=4)
    assert manifest["row_counts"] == {f"t{i}": 10 * i for i in range(6)}
    assert manifest["violations"] == {**{f"t{i}.none_odd": 5 * i for i in range(6)}, "t3.some_big": 0, "gone.optional": 0, "gone.needed": 1, "*.has_tables": 0}
    with pytest.raises(VerificationError, match="needed.*none_odd"):
        write_bundle(spark, data, f"{tmp_path}/other", checks=checks)
    assert os.listdir(tmp_path) == ["out"]
    plan = data["t3"].observe("o", F.count(F.lit(1)).alias("rows"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (") == 1 and "CollectMetrics" in plan


def test_a_failed_write_counts_nothing_twice(spark, tmp_path):
    """The first attempt fails after some rows; the second one's counts are the only ones."""
    flag = f"{tmp_path}/tried"

    def once(batches):
        for batch in batches:
            if not os.path.exists(flag):
                open(flag, "w").close()
                raise RuntimeError("lost")
            yield batch

    frame = spark.range(40).repartition(4).mapInArrow(once, "id long")
    found = bundle.write_observed(spark, frame, f"{tmp_path}/t", [F.sum("id").alias("sum")], attempts=3)
    assert found == {"rows": 40, "sum": 780} and spark.read.parquet(f"{tmp_path}/t").count() == 40
    assert bundle.merged([found, {"rows": 2}]) == {"rows": 42, "sum": 780}


@pytest.mark.parametrize("name", ["events.parquet", "events*.parquet"])
def test_a_stream_of_a_table_that_is_a_folder_or_files_beside_others(spark, tmp_path, name):
    rows = spark.createDataFrame([(i, "click", "p") for i in range(6)], "event_id long, event_type string, props string")
    rows.repartition(3).write.parquet(f"{tmp_path}/folder/events.parquet")
    spark.range(4).write.parquet(f"{tmp_path}/folder/other.parquet")
    pq = pytest.importorskip("pyarrow.parquet")
    (tmp_path / "file").mkdir()
    pq.write_table(rows.toArrow(), f"{tmp_path}/file/events.parquet")
    pq.write_table(spark.range(4).toArrow(), f"{tmp_path}/file/other.parquet")
    for kind in ("file", "folder") if name == "events.parquet" else ("file",):
        mask_available(spark, f"{tmp_path}/{kind}", f"{tmp_path}/out-{kind}", f"{tmp_path}/progress-{kind}", "events", rulebook_from({"00_strategies": {"strategies": {"keep": None}}}), glob=name).awaitTermination()
        assert sorted(r.event_id for r in spark.read.parquet(f"{tmp_path}/out-{kind}").collect()) == list(range(6))
