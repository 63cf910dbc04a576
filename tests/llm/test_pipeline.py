"""The pipeline's stages, each on its own input, and the registered queries."""

from __future__ import annotations

import duckdb
import pytest

import corpus_pipeline
from maskloom.llm import queries
from maskloom.llm.tables import stored, table
from tests.llm.conftest import pairs
from tests.llm.test_groups import plain_hits, plain_print, roots
from tests.llm.test_texts import plain_spans


def test_each_stage_takes_effect(spark, shop_folder):
    docs = table(spark, shop_folder, "documents")
    seen = [stored(docs, "documents")]
    for _, stage in corpus_pipeline.STAGES:
        seen.append(stored(stage(spark, seen[-1], shop_folder), "stage"))
    for frame in seen[:-1]:
        assert frame.columns == docs.columns
    judged = queries.QUERIES["op3_quality_classifier"](spark, shop_folder).where("predicted = 1")
    assert pairs(seen[1], "doc_id") == pairs(judged, "doc_id") and seen[1].count() < docs.count()
    prints = {r.doc_id: plain_print(r.text) for r in seen[1].collect()}
    values = sorted(set(prints.values()))
    root = roots(values, [(a, b) for a in values for b in values if a < b and (a ^ b).bit_count() <= 2])
    assert {r.doc_id for r in seen[2].collect()} == {min(i for i, p in prints.items() if root[p] == group) for group in set(root.values())}
    items = [tuple(r) for r in table(spark, shop_folder, "benchmark").select("item_id", "text").collect()]
    hits = plain_hits([(r.doc_id, r.text) for r in seen[2].collect()], items)
    assert {r.doc_id for r in seen[3].collect()} == {h[0] for h in hits if not h[5]}
    assert pairs(seen[4], "doc_id") == pairs(seen[3], "doc_id")
    for r in seen[4].collect():
        assert not any(plain_spans(r.text)[1:]) and r.n_chars == len(r.text)
    last = seen[5].collect()
    assert all(r.round_trip for r in last) and pairs(seen[5], "doc_id", "text") == pairs(seen[4], "doc_id", "text")


def test_run_is_registered_and_ends_like_its_stages(spark, shop_folder):
    import __spark_entry__

    assert {n.split("_")[0] for n in __spark_entry__.queries() if n.startswith("op")} == {f"op{n}" for n in range(1, 14)}
    out = __spark_entry__.queries()["pipeline"](spark, shop_folder)
    assert {"doc_id", "text", "ids", "n_tokens", "round_trip"} <= set(out.columns) and 0 < out.count() < 200


@pytest.mark.parametrize("empty", [False, True])
def test_stages_take_odd_rows_and_clashing_columns(spark, odd_docs, shop_folder, empty):
    docs = odd_docs.limit(0) if empty else odd_docs
    for _, stage in corpus_pipeline.STAGES:
        before, docs = docs, stored(stage(spark, docs, shop_folder), "stage")
        assert docs.columns[: len(before.columns)] == before.columns
    assert docs.count() == docs.where("round_trip").count()


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_equal_their_sql(spark, shop_folder, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "pages", "embeddings", "conversations"):
        con.execute(f"create view {t} as select * from '{shop_folder}/{t}.parquet'")
    columns = [d[0] for d in con.execute(queries.ORACLES[name]).description]
    expected = sorted(con.execute(queries.ORACLES[name]).fetchall(), key=repr)
    assert sorted((tuple(r[c] for c in columns) for r in queries.QUERIES[name](spark, shop_folder).collect()), key=repr) == expected
