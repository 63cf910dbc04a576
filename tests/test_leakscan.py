"""The leak scan against brute force, in every form it can take."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from maskloom.operators import leakscan
from maskloom.operators.leakscan import GRAM_CLASSES, LeakError, cells, find_values, leak_scan, original_values


def brute_force(rows, needles, min_length=1):
    found = Counter()
    for table, column, value in rows:
        for needle in {n for n in needles if n}:
            if (needle in value) if len(needle) >= min_length else (needle == value):
                found[(needle, table, column)] += 1
    return {(n, t, c, k) for (n, t, c), k in found.items()}


def scan(spark, rows, needles, **options):
    frame = spark.createDataFrame(rows, "table string, column string, value string")
    wanted = spark.createDataFrame([(n,) for n in needles], "n string")
    hits = [tuple(row) for row in find_values(frame, wanted, **options).collect()]
    assert len(hits) == len(set(hits))
    return set(hits)


def sample(seed, alphabet, longest):
    """Texts from a small alphabet (so grams repeat), needles cut from them and near misses."""
    rng = random.Random(seed)

    def word(n):
        return "".join(rng.choice(alphabet) for _ in range(n))

    texts = [word(rng.randint(0, longest)) for _ in range(30)]
    texts += [texts[0]] * 5 + ["common prefix " + word(rng.randint(1, 40)) for _ in range(10)]
    needles = set()
    for _ in range(120):
        text = rng.choice(texts)
        start = rng.randint(0, max(0, len(text) - 1))
        cut = text[start : start + rng.choice([1, 2, 3, 4, 5, 7, 8, 9, 15, 16, 17, 31, 33, 64, 70, 130, 300])]
        needles |= {cut, cut[:-1] + "!"}
    needles |= {"common prefix ", "common prefix x", "", None}
    rows = [(rng.choice("TU"), rng.choice("ab"), text) for text in texts]
    return rows, list(needles)


@pytest.mark.parametrize("seed, alphabet, longest", [(1, "ab", 90), (2, "abc \n", 1500), (3, "aé漢🙂 ", 700)])
@pytest.mark.parametrize("budget", [10_000, 0])
def test_equals_brute_force(spark, seed, alphabet, longest, budget):
    rows, needles = sample(seed, alphabet, longest)
    assert scan(spark, rows, needles, max_needles=budget) == brute_force(rows, needles)


@pytest.mark.parametrize("shortest", [4, 9])
def test_rows_ruled_out_by_first_bytes(spark, monkeypatch, shortest):
    """The filter of large needle sets, switched on for a small one."""
    monkeypatch.setattr(leakscan._Finder, "LARGE_CHARS", 0)
    monkeypatch.setattr(leakscan._Finder, "BLOCK", 64)
    rows, needles = sample(7, "abé漢 ", 300)
    needles = [n for n in needles if n and len(n) >= shortest]
    finder = leakscan._Finder(needles)
    assert finder.filters
    texts = [value for _, _, value in rows]
    batch = pa.RecordBatch.from_pydict({"table": ["t"] * len(texts), "column": ["c"] * len(texts), "value": texts})
    kept = set(finder.rows(batch.column("value").slice(3)) + 3)
    assert all(i in kept for i, text in enumerate(texts) if i >= 3 and any(n in text for n in needles))
    got = finder.count(batch).to_pylist()
    assert {tuple(hit.values()) for hit in got} == brute_force([("t", "c", text) for text in texts], needles)


def test_classes_split_between_the_forms(spark):
    rows, needles = sample(4, "abc", 400)
    small = sum(1 for n in set(needles) if n and len(n) < 4)
    assert scan(spark, rows, needles, max_needles=small + 30) == brute_force(rows, needles)


def test_short_values_must_be_whole_cells(spark):
    rows = [("t", "zip", "1000"), ("t", "note", "costs 1000 units"), ("t", "note", "a longer value"), ("t", "zip", "1000")]
    needles = ["1000", "longer"]
    assert scan(spark, rows, needles, min_length=5) == {("1000", "t", "zip", 2), ("longer", "t", "note", 1)}


def test_by_joins_alone(spark):
    rows, needles = sample(5, "abcd", 200)
    assert scan(spark, rows, needles, automaton=False) == brute_force(rows, needles)


def test_only_cells_with_a_beginning_meet_the_joins(spark, monkeypatch):
    """Beyond the budget clean cells are neither cut into grams nor shuffled, and every cell is worked out once."""
    met, read, by_grams = [], spark.sparkContext.accumulator(0), leakscan._by_grams

    def counted(text_cells, *rest):
        met.append(sorted(r.value for r in text_cells.collect()))
        return by_grams(text_cells, *rest)

    def reading(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    monkeypatch.setattr(leakscan, "_by_grams", counted)
    values = [f"1998-01-01 00:00:{i:02}.{i}" for i in range(60)] + ["call Customer#000000007.", "Customer#000000008", "Customer#0000001"]
    frame = spark.createDataFrame([("t", "a", v) for v in values], "table string, column string, value string")
    wanted = spark.createDataFrame([(f"Customer#{i:09}",) for i in range(20)] + [("p" * 30 + str(i),) for i in range(20)], "n string")
    found = find_values(frame.mapInArrow(reading, frame.schema), wanted, max_needles=0).collect()
    assert {tuple(r) for r in found} == {("Customer#000000007", "t", "a", 1), ("Customer#000000008", "t", "a", 1)}
    assert met == [["Customer#000000008", "call Customer#000000007."]] * 2 and read.value == len(values)


@pytest.mark.parametrize("figures", [[], ["5.0"], ["1998-01-01", "0"]])
def test_listed_and_joined_needles_share_one_pass(spark, figures):
    """Every cell is worked out once for all needles, and cells of figures alone meet only needles of figures."""
    read = spark.sparkContext.accumulator(0)

    def reading(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    rng = random.Random(len(figures))
    values = [f"{rng.choice('+-')}{rng.randrange(10**6) / 100}" for _ in range(60)] + [f"1998-01-0{i % 9 + 1} 00:00:0{i % 10}" for i in range(30)]
    values += [f"Mr. A. Name-{i:08} é." for i in range(30)] + ["", "é", "A", "A.", "漢.A", "x" * 80, "7" * 90, "LEAK", "a LEAK é LEAK", "Name-00000099"]
    rows = [(rng.choice("TU"), rng.choice("ab"), value) for value in values]
    needles = ["A.", "é", "漢.", "LEAK", "LEA", *figures] + [f"Name-{i:08}" for i in range(0, 60, 2)] + ["x" * 70]
    frame = spark.createDataFrame(rows, "table string, column string, value string")
    wanted = spark.createDataFrame([(n,) for n in needles], "n string")
    found = find_values(frame.mapInArrow(reading, frame.schema), wanted, max_needles=12).collect()
    assert {tuple(r) for r in found} == brute_force(rows, needles) and len(found) > 10
    assert read.value == len(rows)


def test_needles_of_few_bytes_are_counted_by_words(monkeypatch):
    monkeypatch.setattr(leakscan._Finder, "BLOCK", 64)
    rows, needles = sample(11, "abé漢🙂 ", 90)
    needles = sorted({n for n in needles if n} | {"a", "b ", "é", "ab", "aba", "zz"})
    finder = leakscan._Finder(needles, filtered=True)
    assert {width for width, *_ in finder.whole} == {1, 2, 3}
    batch = pa.RecordBatch.from_pydict({c: [row[i] for row in [("x", "y", "aba"), *rows]] for i, c in enumerate(("table", "column", "value"))}).slice(1)
    assert {tuple(hit.values()) for hit in finder.count(batch).to_pylist()} == brute_force(rows, needles)
    short = leakscan._Finder(["a"], filtered=True)
    assert {tuple(hit.values()) for hit in short.count(batch).to_pylist()} == brute_force(rows, ["a"])


@pytest.mark.parametrize("most", [1_000_000, 0])
def test_only_grams_that_the_cells_hold_are_dealt_out(spark, monkeypatch, most):
    """A needle's gram costs a row only if one of the few cells holds it; the results are the same."""
    monkeypatch.setattr(leakscan, "MAX_BROADCAST_GRAMS", most)
    rng = random.Random(1)
    needles = ["".join(rng.choice("abcdefgh") for _ in range(100)) for _ in range(50)]
    rows = [("t", "a", f"-{needles[0]}-"), ("t", "a", needles[1][:99]), ("t", "b", needles[0] * 3), ("t", "b", "z" * 200)]
    found = scan(spark, rows, needles, max_needles=0)
    assert found == brute_force(rows, needles)
    near = spark.createDataFrame([(*row, None) for row in rows], "table string, column string, value string, begins array<string>")
    wanted = spark.createDataFrame([(n,) for n in needles], "needle string")
    joined = leakscan._by_grams(near, wanted, next(c for c in GRAM_CLASSES if c.low == 64), 100)
    assert {tuple(r) for r in joined.collect()} == brute_force(rows, needles)


@pytest.mark.parametrize("low, alphabet", [(4, "ab"), (8, "abé漢 "), (16, "abc"), (32, "a漢🙂"), (300, "xyz ")])
def test_no_row_with_a_needle_is_ruled_out(low, alphabet):
    rng = random.Random(low)
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 3 * low))) for _ in range(300)]
    needles = {text[i : i + low + rng.randint(0, 5)] for text in texts if len(text) > low for i in [rng.randint(0, len(text) - low)]}
    needles = sorted(n for n in rng.sample(sorted(needles), 20) if len(n) >= low)
    beginnings = leakscan._Beginnings(low, len(needles))
    beginnings.BLOCK = 64
    maps = [np.zeros(1 << (beginnings.bits - 6), np.uint64) for _ in beginnings.offsets]
    for hit in beginnings.of(pa.array(["", *needles]).slice(1)).to_pylist():
        maps[hit["word"]][hit["place"] >> 6] |= np.uint64(1 << (hit["place"] & 63))
    kept = set((beginnings.rows(pa.array(texts).slice(3), maps) + 3).tolist())
    holding = {i for i, text in enumerate(texts) if i >= 3 and any(n in text for n in needles)}
    assert holding and holding <= kept


def test_few_beginnings_are_cut_out_without_grams(spark, capsys):
    """Short needles beyond the budget: a cell with few places meets the needles at once, every cell counted once."""
    rows = [("t", "note", f"call Customer#{i % 40:09} or Customer#{i % 40:09}.") for i in range(120)]
    rows += [("t", "name", "é漢🙂Customer#000000003"), ("t", "name", "Customer#00000000"), ("u", "a", "Älteste Straße 🙂🙂🙂 7")]
    needles = [f"Customer#{i:09}" for i in range(0, 60, 3)] + ["Straße 🙂🙂🙂", "Straße 🙂🙂🙂 8", "Customer#000000003!"]
    frame = spark.createDataFrame(rows, "table string, column string, value string")
    found = find_values(frame, spark.createDataFrame([(n,) for n in needles], "n string"), max_needles=0)
    found.explain()
    assert "regexp_extract_all" not in capsys.readouterr().out
    assert {tuple(r) for r in found.collect()} == brute_force(rows, needles)


@pytest.mark.parametrize("most", [0, 2, 64])
def test_cells_with_many_and_few_beginnings_add_up(spark, monkeypatch, most):
    monkeypatch.setattr(leakscan, "MAX_BEGINNINGS", most)
    rng = random.Random(most)
    letters = "abcdefghijklmnopqrstuvwxyzäß漢🙂 "
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 400))) for _ in range(80)]
    texts += ["name-000" * n + "x🙂y" for n in (1, 5, 40)] + [texts[0]] * 3
    needles = {"name-000", "name-000name-000", "name-000x🙂", "name-000x🙂z", "name"}
    for _ in range(150):
        text = rng.choice(texts)
        start = rng.randint(0, len(text))
        needles.add(text[start : start + rng.choice([4, 5, 7, 8, 12, 15, 16, 18, 31, 32, 50, 63, 64, 90, 300])])
    rows = [("t", rng.choice("ab"), text) for text in texts]
    assert scan(spark, rows, needles, max_needles=0) == brute_force(rows, needles)


def test_texts_that_are_no_utf8_keep_their_needles(spark):
    frame = spark.sql("select 't' as table, 'c' as column, cast(value as string) as value from values (X'8080C3' || cast('Customer#000000001' as binary)), (cast('Customer#000000001ü' as binary)) as v(value)")
    wanted = spark.createDataFrame([("Customer#000000001",)], "n string")
    assert [tuple(r) for r in find_values(frame, wanted, max_needles=0).collect()] == [("Customer#000000001", "t", "c", 2)]


def test_candidates_joined_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(leakscan, "MAX_BROADCAST_PLACES", 0)
    rows, needles = sample(6, "ab ", 300)
    assert scan(spark, rows, needles, max_needles=0) == brute_force(rows, needles)


def test_hot_text_and_shared_prefixes(spark):
    """A third of the cells are one text, and all needles begin alike."""
    rows = [("t", "a", "Customer#000000001 wrote")] * 300 + [("t", "a", f"Customer#{i:09d}") for i in range(600)]
    needles = [f"Customer#{i:09d}" for i in range(0, 900, 2)] + ["Customer#000000001"]
    got = scan(spark, rows, needles, max_needles=0)
    assert got == {(n, "t", "a", 301 if n.endswith("#000000001") else 1) for n in needles if int(n[9:]) < 600}


@pytest.mark.parametrize("cls", GRAM_CLASSES)
def test_a_needle_holds_a_gram_at_every_alignment(cls):
    assert cls.size + cls.stride - 1 <= cls.low and cls.size >= 1


def test_nothing_to_find(spark):
    assert scan(spark, [("t", "a", "x")], ["", None]) == set()
    assert scan(spark, [("t", "a", "x")], ["y"]) == set()


def test_cells_of_all_types(spark):
    frame = spark.sql(
        "select 1 as i, 'txt' as s, X'BEEF' as b, array('in', null) as a, map('k', 'v') as m, named_struct('x', 'deep') as st, "
        "date'2020-01-02' as d, cast(null as string) as n, true as f"
    )
    got = {row["column"]: row["value"] for row in cells({"t": frame}).collect()}
    assert got == {
        "i": "1", "s": "txt", "b": "sha256:" + hashlib.sha256(b"\xbe\xef").hexdigest(), "a": "in", "m.{key}": "k", "m.{}": "v", "st.x": "deep",
        "d": "2020-01-02", "f": "true",
    }


def test_nested_leaves_are_scanned_as_they_are(spark):
    text = 'say "Ann Lee"\nand go'
    frame = spark.createDataFrame([((text, 1), [([text], {text: "x"})], None)], "p struct<name: string, n: int>, l array<struct<w: array<string>, m: map<string, string>>>, none array<string>")
    needles = spark.createDataFrame([('"Ann Lee"\nand',), ("Ann\\",)], "v string")
    assert {(r["column"], r["cells"]) for r in leak_scan({"t": frame}, needles).collect()} == {("p.name", 1), ("l.w", 1), ("l.m.{key}", 1)}
    values = original_values({"t": frame}, [("t", "p.name"), ("t", "l.[].w"), ("t", "l.[].m")])
    assert {tuple(r) for r in values.collect()} == {(text, "t", "p.name"), (text, "t", "l.[].w"), (text, "t", "l.[].m"), ("x", "t", "l.[].m")}


def test_only_the_canary_itself_proves_the_scan(spark, monkeypatch):
    data = {"t": spark.createDataFrame([("x",)], "v string")}
    monkeypatch.setattr(leakscan, "CANARY", "maskloom-canary")
    probe = spark.createDataFrame([("__canary__", "probe", "a canary of another kind")], "table string, column string, value string")
    monkeypatch.setattr(leakscan, "with_canary", lambda spark, text_cells: text_cells.unionByName(probe))
    with pytest.raises(LeakError, match="its canary"):
        leak_scan(data, spark.createDataFrame([("canary",)], "v string"))


def test_all_leaks_are_returned_and_counted(spark):
    data = {"t": spark.createDataFrame([(f"value{n:04}",) for n in range(250)], "v string")}
    hits = leak_scan(data, data["t"])
    assert hits.count() == 250
    with pytest.raises(LeakError, match="250 surviving values"):
        leakscan.assert_no_leak(hits)


def test_original_values_are_distinct_and_tagged(spark):
    frame = spark.createDataFrame([("a", 1), ("a", 2), (None, 2)], "s string, n int")
    got = {tuple(r) for r in original_values({"t": frame}, [("t", "s"), ("t", "n"), ("t", "absent"), ("u", "s")]).collect()}
    assert got == {("a", "t", "s"), ("1", "t", "n"), ("2", "t", "n")}
    with pytest.raises(ValueError):
        original_values({"t": frame}, [("u", "s")])


def test_gate_finds_leaks_and_checks_itself(spark, monkeypatch):
    data = {"leak": spark.createDataFrame([(1, "an UNMASKED value")], "id int, secret string")}
    needles = spark.createDataFrame([("UNMASKED",), ("unmasked",), ("ABSENT",)], "v string")
    assert leak_scan(data, needles).collect() == [("UNMASKED", "leak", "secret", 1)]
    assert leak_scan(data, needles.where(F.col("v") == "ABSENT")).count() == 0
    monkeypatch.setattr(leakscan, "with_canary", lambda spark, text_cells: text_cells)
    with pytest.raises(LeakError, match="canary"):
        leak_scan(data, needles)


@pytest.mark.parametrize("leak", [True, False])
def test_needles_longer_than_their_heads(spark, leak):
    """Long needles with a common beginning: only those that are there whole are found."""
    begin = "".join(f"{i:04d}" for i in range(200))
    needles = [begin + tail for tail in ("a" * 500, "b" * 900, "c")] + [begin[::-1] + "x" * 700]
    texts = ["p" * 50 + begin + "a" * 500 + "q", begin + "b" * 899, begin] if leak else ["y" * 3000, begin[5:200], "z"]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    wanted = spark.createDataFrame([(n,) for n in needles], "needle string")
    got = leakscan.find_values(leakscan.cells({"d": frame}), wanted, automaton=False).collect()
    assert sorted((r.needle, r.cells) for r in got) == ([(needles[0], 1)] if leak else [])
