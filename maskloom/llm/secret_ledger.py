"""Secret scans through a ledger of blobs.

Every text is addressed by its SHA-256. The ledger remembers which versions of which rules have read which blob;
a scan reads only what is missing, and the findings of a blob are joined back to every document that holds it.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from maskloom.llm.tables import fresh_name, map_batches, stored


@dataclass(frozen=True)
class SecretRule:
    """Matches, leftmost and not overlapping; those whose ``group`` has fewer than ``least`` characters are dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    any_case: bool = False

    @property
    def version(self) -> str:
        return f"{self.kind}-{hashlib.sha256(repr(self).encode()).hexdigest()[:12]}"

    def spans(self, text: str) -> list[tuple[int, int]]:
        found = re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.any_case else 0)).finditer(text)
        return [m.span() for m in found if len(m[self.group]) >= self.least]


#: The three patterns of the contract.
BASE = (
    SecretRule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True),
    SecretRule("access", r"AKIA[A-Z0-9]+", 0, 20),
    SecretRule("hex", r"[0-9a-f]{24,}", 0, 24),
)
RULES = (
    *BASE,
    SecretRule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----[A-Za-z0-9+/=\s]*-----END [A-Z ]{0,40}PRIVATE KEY-----"),
    SecretRule("forge", r"\b(?:gh[pousr]_[A-Za-z0-9]{36,}|glpat-[A-Za-z0-9_-]{20,})"),
    SecretRule("jwt", r"\beyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
LEDGER = "blob string, scanned array<string>, spans array<struct<start: int, kind: int, version: string, end: int>>"


def _scanned(texts: DataFrame, rules: Sequence[SecretRule]) -> DataFrame:
    """Ledger rows of (blob, text, missing): each text is read by its missing rule versions only."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = []
            for text, missing in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                wanted = set(missing)
                spans.append([{"start": a, "kind": k, "version": r.version, "end": b} for k, r in enumerate(rules) if r.version in wanted for a, b in r.spans(text)])
            kind = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("version", pa.string()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(spans, kind)], ["blob", "scanned", "spans"])

    return map_batches(texts.select("blob", "text", "missing"), scan, LEDGER)


def scan(spark: SparkSession, docs: DataFrame, ledger: str, rules: Sequence[SecretRule] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``blob`` and ``found``, its spans as sorted (start, kind number, version, end).

    ``ledger`` is a folder that all machines reach; new rows are appended to it, and a second call with the same
    texts and rules scans nothing. A retried or repeated append only repeats rows, which are read as a set. Null
    text counts as empty. Null ids and repeated rows stay. Spans are code points, the end exclusive. Which document
    had which text is kept beside the ledger, for :func:`history`.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("blob", F.sha2("text", 256))
    paths = stored(rows.select("id", "blob"), "blob-paths")
    versions = [r.version for r in rules]
    _remember(spark, paths, ledger)
    known = _ledger(spark, ledger)
    done = known.select("blob", F.explode("scanned").alias("v")).groupBy("blob").agg(F.collect_set("v").alias("done"))
    # The document that stands for a blob: keyed by both, so that copies of one text spread over the tasks.
    blobs = paths.groupBy("blob").agg(F.min("id").alias("id"))
    missing = F.array_except(F.array(*map(F.lit, versions)), F.coalesce("done", F.array().cast("array<string>")))
    unseen = blobs.join(done, "blob", "left").select("id", "blob", missing.alias("missing")).where("size(missing) > 0")
    same = rows["id"].eqNullSafe(F.col("u.id")) & (rows["blob"] == F.col("u.blob"))
    texts = rows.join(unseen.alias("u"), same).select(rows["blob"], rows["text"], "u.missing")
    # A row given twice is read twice, and its blob is still written once.
    _scanned(texts, rules).dropDuplicates(["blob"]).write.mode("append").parquet(ledger)
    findings = _findings(spark, ledger, rules)
    return paths.join(findings, "blob", "left").select(F.col("id").alias(id_col), "blob", _or_none(findings))


def history(spark: SparkSession, ledger: str, kind: str = "bigint", rules: Sequence[SecretRule] = RULES) -> DataFrame:
    """Every text that any document ever had when it was scanned: ``id, blob, seen, found``, one row per pair.

    ``seen`` is when the pair was first scanned and ``kind`` the type of the ids. A document whose text has changed
    keeps the row of its earlier text, with what was found in it; a text that came back has one row. Documents without
    an id are one document here.
    """
    findings = _findings(spark, ledger, rules)
    pairs = _kept_paths(spark, ledger, kind).groupBy("id", "blob").agg(F.min("seen").alias("seen"))
    return pairs.join(findings, "blob", "left").select("id", "blob", "seen", _or_none(findings))


def _or_none(findings: DataFrame) -> F.Column:
    return F.coalesce("found", F.expr("array()").cast(findings.schema["found"].dataType)).alias("found")


def _findings(spark: SparkSession, ledger: str, rules: Sequence[SecretRule]) -> DataFrame:
    """``blob, found`` of the blobs in which these versions of the rules found something."""
    versions = [r.version for r in rules]
    spans = _ledger(spark, ledger).select("blob", F.explode("spans").alias("s")).where(F.col("s.version").isin(versions))
    # Kinds are numbered as listed here and now, whatever the list was when the blob was read.
    number = F.create_map(*(F.lit(x) for v, r in enumerate(versions) for x in (r, v)))
    numbered = spans.select("blob", F.struct(F.col("s.start").alias("start"), number[F.col("s.version")].alias("kind"), F.col("s.version").alias("version"), F.col("s.end").alias("end")).alias("s"))
    return numbered.groupBy("blob").agg(F.sort_array(F.collect_set("s")).alias("found"))


def _remember(spark: SparkSession, paths: DataFrame, ledger: str) -> None:
    """Append the pairs of document and blob that were not there yet; a repeated append only repeats rows."""
    known = _kept_paths(spark, ledger, paths.schema["id"].dataType.simpleString()).alias("k")
    new = paths.alias("p").join(known, F.col("p.id").eqNullSafe(F.col("k.id")) & (F.col("p.blob") == F.col("k.blob")), "left_anti")
    new.withColumn("seen", F.current_timestamp()).write.mode("append").parquet(f"{ledger}-paths")


def _kept_paths(spark: SparkSession, ledger: str, kind: str) -> DataFrame:
    schema = f"id {kind}, blob string, seen timestamp"
    return spark.read.schema(schema).parquet(f"{ledger}-paths") if _exists(spark, f"{ledger}-paths") else spark.createDataFrame([], schema)


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def _ledger(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LEDGER).parquet(path) if _exists(spark, path) else spark.createDataFrame([], LEDGER)


def report(found: DataFrame, rules: Sequence[SecretRule] = RULES, id_col: str = "doc_id") -> DataFrame:
    """Counts of the base kinds, the digest of the base spans, and all spans as ``kind:start:end`` joined by commas."""
    kinds = F.array(*(F.lit(r.kind) for r in rules))
    said = F.transform("found", lambda s: F.concat_ws(":", kinds[s["kind"]], s["start"].cast("string"), s["end"].cast("string")))
    base = F.filter("found", lambda s: s["kind"] < len(BASE))
    counts = [F.size(F.filter("found", _is_kind(k))).cast("bigint").alias(f"n_{r.kind}") for k, r in enumerate(BASE)]
    base_said = F.transform(base, lambda s: F.concat_ws(":", kinds[s["kind"]], s["start"].cast("string"), s["end"].cast("string")))
    return found.select(id_col, *counts, F.sha2(F.array_join(base_said, ","), 256).alias("base_sha256"), F.array_join(said, ",").alias("spans"))


def _is_kind(number: int):
    return lambda span: span["kind"] == number


def redacted(text: F.Column, found: F.Column, mark: str = "[secret]") -> F.Column:
    """The text with every span replaced; overlapping spans become one mark."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    step = lambda acc, s: F.when(s["end"] <= acc["at"], acc).otherwise(
        F.struct(
            F.when(s["start"] < acc["at"], acc["out"]).otherwise(F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark))).alias("out"),
            s["end"].alias("at"),
        )
    )
    return F.aggregate(found, start, step, lambda acc: F.concat(acc["out"], F.substr(text, acc["at"] + 1)))


def redact(spark: SparkSession, docs: DataFrame, ledger: str, rules: Sequence[SecretRule] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with their secrets replaced; all columns stay, and null texts stay null."""
    found = scan(spark, docs, ledger, rules, id_col, text_col).where("size(found) > 0").select(F.col(id_col).alias("id"), "blob", "found").dropDuplicates(["id", "blob"])
    spans, blob = fresh_name(docs, "found"), fresh_name(docs, "blob")
    marked = docs.withColumn(blob, F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256))
    found = found.withColumnsRenamed({"found": spans, "blob": f"{blob}_", "id": f"{blob}_id"})
    both = marked.join(found, marked[id_col].eqNullSafe(found[f"{blob}_id"]) & (marked[blob] == found[f"{blob}_"]), "left")
    text = F.when(F.col(spans).isNotNull(), redacted(F.col(text_col), F.col(spans))).otherwise(F.col(text_col))
    return both.withColumn(text_col, text).select(docs.columns)
