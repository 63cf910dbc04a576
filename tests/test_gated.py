from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from maskloom.operators.verify import Expectation
from maskloom.plans.rulebook import rulebook_from
from maskloom.sources import bundle
from maskloom.streaming import gated

COLUMNS = "id long, mail string, note string"


def rules(**fields):
    fields = {"mail": "fake_email", **fields}
    return rulebook_from({"00_strategies": {"strategies": dict.fromkeys(["fake_email", "keep", "rotate_secret", "shuffle_within_column"])}, "10": {"people": {"key": ["id"], "fields": fields}}})


def batch(spark, ids, note="none"):
    return spark.createDataFrame([(i, f"person{i}@real.test", note) for i in ids], COLUMNS)


def add_file(spark, folder, ids, note="none"):
    batch(spark, ids, note).coalesce(1).write.mode("append").parquet(folder)


def run(spark, tmp_path, **options):
    stream = spark.readStream.schema(COLUMNS).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    query = gated.publish_stream(stream, "people", options.pop("book", rules()), f"{tmp_path}/out", f"{tmp_path}/progress", **options)
    query.awaitTermination()


def ids(spark, tmp_path):
    return sorted(r.id for r in gated.published(spark, f"{tmp_path}/out").collect())


def test_a_restart_neither_repeats_nor_skips(spark, tmp_path):
    add_file(spark, f"{tmp_path}/in", range(10))
    run(spark, tmp_path)
    add_file(spark, f"{tmp_path}/in", range(10, 20))
    run(spark, tmp_path)
    run(spark, tmp_path)  # nothing new
    assert ids(spark, tmp_path) == list(range(20))
    assert [tuple(r) for r in gated.ledger(spark, f"{tmp_path}/out").orderBy("batch").collect()] == [(0, "published", 10, None), (1, "published", 10, None)]
    assert not gated.published(spark, f"{tmp_path}/out").where(F.col("mail").contains("real")).count()


def test_a_batch_run_again_after_its_entry_does_nothing(spark, tmp_path):
    """The driver is lost between the ledger entry and the stream's own commit."""
    target = f"{tmp_path}/out"
    assert gated.publish_batch(batch(spark, range(5)), 0, "people", rules(), target) == "published"
    before = sorted(os.listdir(f"{target}/data/batch=0"))
    assert gated.publish_batch(batch(spark, range(5)), 0, "people", rules(), target) == "published"
    assert sorted(os.listdir(f"{target}/data/batch=0")) == before and ids(spark, tmp_path) == list(range(5))


def test_what_a_lost_attempt_wrote_is_not_read_and_written_anew(spark, tmp_path, monkeypatch):
    target = f"{tmp_path}/out"
    gated.publish_batch(batch(spark, range(3)), 0, "people", rules(), target)
    with monkeypatch.context() as patch:
        patch.setattr(bundle, "_write_text", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            gated.publish_batch(batch(spark, range(3, 9)), 1, "people", rules(), target)
    assert os.path.isdir(f"{target}/data/batch=1") and ids(spark, tmp_path) == [0, 1, 2]
    gated.publish_batch(batch(spark, range(3, 9)), 1, "people", rules(), target)
    assert ids(spark, tmp_path) == list(range(9))


def test_a_leak_stops_the_stream_and_is_tried_again(spark, tmp_path):
    add_file(spark, f"{tmp_path}/in", range(4))
    add_file(spark, f"{tmp_path}/in", range(4, 8), note="ask person5@real.test")
    with pytest.raises(Exception, match="surviving"):
        run(spark, tmp_path)
    assert ids(spark, tmp_path) == [0, 1, 2, 3] and not os.path.exists(f"{tmp_path}/out/data/batch=1")
    # With a rule for the notes the same batch goes through.
    run(spark, tmp_path, book=rules(note="fake_email"))
    assert ids(spark, tmp_path) == list(range(8))


def test_held_batches_leave_a_reason_but_no_values(spark, tmp_path):
    add_file(spark, f"{tmp_path}/in", range(4), note="ask person2@real.test")
    add_file(spark, f"{tmp_path}/in", range(4, 9))
    add_file(spark, f"{tmp_path}/in", [])
    check = Expectation("people", "few", F.col("id") > 7, columns=("id",))
    run(spark, tmp_path, hold=True, checks=[check])
    found = {r.rows: (r.status, r.reason) for r in gated.ledger(spark, f"{tmp_path}/out").collect()}
    assert found.pop(4) == ("held", "LeakError") and found.pop(5) == ("held", "checks failed: ['few']")
    assert "real.test" not in "".join(open(f"{tmp_path}/out/_ledger/{f}").read() for f in os.listdir(f"{tmp_path}/out/_ledger") if f.endswith(".json"))
    kept = {f"batch={r.batch}" for r in gated.ledger(spark, f"{tmp_path}/out").where("status = 'published'").collect()}
    assert {d for d in os.listdir(f"{tmp_path}/out/data") if d.startswith("batch=")} == kept


def test_nothing_published_is_an_error(spark, tmp_path):
    with pytest.raises(gated.GateError, match="no published batch"):
        gated.published(spark, f"{tmp_path}/out")
    assert gated.ledger(spark, f"{tmp_path}/out").count() == 0


def test_random_rotations_are_read_as_written(spark, tmp_path):
    """A rotated value differs at every evaluation; what the checks read is what is published."""
    book = rules(note={"strategy": "rotate_secret", "rotate": "token"})
    gated.publish_batch(batch(spark, range(6), note="old secret"), 0, "people", book, f"{tmp_path}/out")
    rows = [{r.note for r in gated.published(spark, f"{tmp_path}/out").collect()} for _ in range(2)]
    assert rows[0] == rows[1] and len(rows[0]) == 6 and "old secret" not in rows[0]
