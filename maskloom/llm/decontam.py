"""Benchmark decontamination by winnowing, with DataFrame functions alone.

Of every window of ``WINDOW - GRAM + 1`` successive word grams the smallest hash is kept, in documents and in
benchmark items. Two texts that share ``WINDOW`` words in a row keep the same hash there, so a join of the kept
hashes finds every such document. Its hits are extended word by word along the diagonal of the match, which makes
the answer exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskloom.llm.tables import ascii_lower, fresh_name, stored

WINDOW = 13
GRAM = 5
WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORDS), F.lit(0))


def _grams(column: str) -> Column:
    """Hashes of all runs of GRAM words; none if there are fewer words than WINDOW."""
    return F.expr(f"if(size({column}) >= {WINDOW}, transform(sequence(1, size({column}) - {GRAM - 1}), i -> xxhash64(slice({column}, i, {GRAM}))), array())").cast("array<bigint>")


def _kept(column: str) -> Column:
    """The smallest hash of each window of grams."""
    span = WINDOW - GRAM + 1
    return F.expr(f"if(size({column}) >= {span}, array_distinct(transform(sequence(1, size({column}) - {span - 1}), i -> array_min(slice({column}, i, {span})))), array())").cast("array<bigint>")


def _key(id_column: Column, text: Column) -> Column:
    """One value per (id, text): copies under other ids stay apart, so that they spread over the tasks."""
    return F.md5(F.concat(F.coalesce(id_column.cast("string"), F.lit("?")), F.lit(" "), F.sha2(F.coalesce(text, F.lit("")), 256)))


def _items(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(ikey, item, iwords) of the items that have words; ``anchor`` is the hash of a short item's longest word."""
    rows = benchmark.select(F.col(id_col).cast("string").alias("item"), words(F.col(text_col)).alias("iwords")).where("size(iwords) > 0").distinct()
    longest = F.expr("array_max(transform(iwords, w -> struct(length(w) as n, w as w))).w")
    anchor = F.when(F.size("iwords") < WINDOW, F.xxhash64(longest))
    return rows.select(F.md5(F.concat_ws(" ", F.coalesce("item", F.lit("?")), "iwords")).alias("ikey"), "item", "iwords", anchor.alias("anchor"))


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", share: int = 20) -> DataFrame:
    """One row per document: id, ``key`` (of id and text), ``n_words``, ``n_hit``, ``n_items``, ``items``, ``items_sha256``, ``contaminated``.

    A word is hit inside any 13 words in a row that an item has too, or inside a whole shorter item. A document is
    contaminated if some word is hit and at least one in ``share`` is. Null and empty texts have no words; items
    without words hit nothing; an item with a null id hits words but is not listed. Repeated documents stay,
    repeated items count once. Other columns are not read.
    """
    items = stored(_items(benchmark, item_col, item_text), "benchmark-items")
    short = items.where("anchor is not null").limit(1).count() > 0
    placed = items.select("ikey", F.posexplode(_grams("iwords")).alias("ipos", "hash"))
    kept = items.select("ikey", _grams("iwords").alias("g")).select("ikey", F.explode(_kept("g")).alias("hash"))
    marks = kept.join(placed, ["ikey", "hash"])
    if short:
        # Fewer words than a window: such items are looked up by their longest word.
        at = items.where("anchor is not null").select("ikey", "anchor", F.posexplode("iwords").alias("ipos", "word"))
        marks = marks.unionByName(at.where(F.xxhash64("word") == F.col("anchor")).select("ikey", F.col("anchor").alias("hash"), "ipos"))
    marks = stored(marks, "benchmark-marks")

    result = _hits(docs, items, marks, short, id_col, text_col)
    listed = F.sort_array(F.coalesce("items", F.array().cast("array<string>")))
    n_hit = F.coalesce("n_hit", F.lit(0))
    return result.select(
        F.col("id").alias(id_col), "key", "n_words", n_hit.alias("n_hit"), F.size(listed).cast("bigint").alias("n_items"), listed.alias("items"),
        F.sha2(F.array_join(listed, ","), 256).alias("items_sha256"), ((n_hit > 0) & (n_hit * share >= F.col("n_words"))).alias("contaminated"),
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    bad = contamination(docs, benchmark, id_col, text_col, **options).where("contaminated").select("key").distinct()
    name = fresh_name(docs, "key")
    marked = docs.withColumn(name, _key(F.col(id_col), F.col(text_col)))
    return marked.join(bad, marked[name] == bad["key"], "left_anti").drop(name)


def _hits(docs: DataFrame, items: DataFrame, marks: DataFrame, short: bool, id_col: str, text_col: str) -> DataFrame:
    """(id, key, n_words, n_hit, items) of every document; the last two are null where nothing is hit."""
    read = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    keyed = read.withColumn("key", _key(F.col("id"), F.col("text")))
    prints = keyed.select("id", "key", words(F.col("text")).alias("dwords")).select("id", "key", F.size("dwords").cast("bigint").alias("n_words"), "dwords", _grams("dwords").alias("g"))
    hashes = _kept("g")
    if short:
        hashes = F.concat(hashes, F.expr("transform(array_distinct(dwords), w -> xxhash64(w))"))
    prints = stored(prints.select("id", "key", "n_words", hashes.alias("hashes")), "fingerprints")

    found = prints.select("key", F.explode("hashes").alias("hash")).join(marks.select("hash").distinct(), "hash", "left_semi").select("key").distinct()
    # Texts are joined as they are and cut into words after that: words take more room.
    suspects = stored(keyed.join(found, "key", "left_semi").dropDuplicates(["key"]).select("key", words(F.col("text")).alias("dwords")), "suspects")
    anchors = suspects.select("key", F.posexplode(_grams("dwords")).alias("dpos", "hash"))
    if short:
        single = suspects.select("key", F.posexplode("dwords").alias("dpos", "word"))
        anchors = anchors.unionByName(single.select("key", "dpos", F.xxhash64("word").alias("hash")))
    diagonals = anchors.join(marks, "hash").select("key", "ikey", (F.col("dpos") - F.col("ipos")).alias("shift")).distinct()
    both = diagonals.join(suspects, "key").join(items.select("ikey", "item", "iwords"), "ikey")
    span = F.least(F.lit(WINDOW), F.size("iwords"))
    lined = both.select("key", "item", "dwords", "iwords", "shift", span.alias("span"), F.greatest(F.lit(0), "shift").alias("low"), F.least(F.size("dwords"), F.col("shift") + F.size("iwords")).alias("high"))
    same = lined.where("high - low >= span").select("key", "item", "low", "span", F.expr("zip_with(slice(dwords, low + 1, high - low), slice(iwords, low - shift + 1, high - low), (d, i) -> d = i)").alias("same"))
    starts = same.select("key", "item", "low", "span", F.expr("filter(sequence(0, size(same) - span), s -> forall(slice(same, s + 1, span), e -> e))").alias("starts"))
    hits = starts.where("size(starts) > 0").select("key", "item", F.explode(F.expr("array_distinct(flatten(transform(starts, s -> sequence(low + s, low + s + span - 1))))")).alias("place"))
    totals = hits.groupBy("key").agg(F.countDistinct("place").alias("n_hit"), F.collect_set("item").alias("items"))

    return prints.select("id", "key", "n_words").join(totals, "key", "left")


#: The same in DuckDB, by comparing all windows.
ORACLE = r"""
with d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
b as (select item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
bw as (select distinct item_id, list_aggregate(w[i:i + least(len(w), 13) - 1], 'string_agg', ' ') as g, least(len(w), 13) as n
    from (select item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) as i from b where len(w) > 0)),
dw as (select doc_id, i, n, list_aggregate(w[i:i + n - 1], 'string_agg', ' ') as g
    from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from d, (select distinct n from bw) where len(w) >= n)),
m as (select doc_id, item_id, i, dw.n from dw join bw using (n, g)),
h as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + n)) as p from m) group by doc_id),
x as (select doc_id, list_sort(list(distinct item_id::varchar)) as items from m group by doc_id)
select d.doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(len(items), 0)::bigint as n_items,
    sha256(coalesce(array_to_string(items, ','), '')) as items_sha256, coalesce(n_hit > 0 and 20 * n_hit >= len(w), false) as contaminated
from d left join h using (doc_id) left join x using (doc_id)
"""
