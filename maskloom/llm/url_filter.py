"""URL filter: rules first, then logistic regression on hashed character n-grams of host and path."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskloom.llm.hashing import gram_hashes
from maskloom.llm.tables import ascii_lower, map_batches

ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def rules_of(*lines: str) -> list[Rule]:
    """``"block net/"``, ``"allow example.net/en/"``: verdict, then host and path prefix."""
    rules = []
    for line in lines:
        verdict, text = line.split(" ", 1)
        host, slash, rest = text.partition("/")
        rules.append(Rule(verdict, host, slash + rest))
    return rules


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null and for a url without ``://``."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    return ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """(rule text, verdict) of the longest rule that fits, null if none does; equally long ones go by text."""
    text = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        text = F.when(fits, F.lit(rule.text)).otherwise(text)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return text, verdict


def features(addresses: list[bytes], sizes: Sequence[int], bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket, value): counts of hashed n-grams with row sums of squares of about 1; an end mark at both sides."""
    marked = [b"^" + a + b"$" for a in addresses]
    parts = [gram_hashes(marked, size) for size in sizes]
    row = np.concatenate([p[1] for p in parts])
    bucket = (np.concatenate([p[0] for p in parts]) >> np.uint64(64 - bits)).astype(np.int64)
    held = np.bincount(row, minlength=len(addresses))
    return row, bucket, 1.0 / np.sqrt(held[row])


@dataclass(frozen=True)
class UrlModel:
    weights: np.ndarray
    bias: float
    sizes: tuple[int, ...]
    bits: int

    def probability(self, addresses: list[bytes]) -> np.ndarray:
        """Chance that the address is to be blocked."""
        row, bucket, value = features(addresses, self.sizes, self.bits)
        total = np.bincount(row, self.weights[bucket] * value, len(addresses)) + self.bias
        return 1 / (1 + np.exp(-np.clip(total, -500, 500)))


def fit(addresses: list[bytes], blocked: np.ndarray, sizes: Sequence[int] = (3, 4, 5), bits: int = 18, steps: int = 150, rate: float = 2.0, decay: float = 1e-4) -> UrlModel:
    """Logistic regression by accelerated full-batch gradient steps on a small labelled table.

    With no rows, or one label alone, the bias says all there is to say.
    """
    weights, bias = np.zeros(1 << bits), 0.0
    blocked = np.asarray(blocked, float)
    if len(blocked) == 0 or blocked.min() == blocked.max():
        return UrlModel(weights, 0.0 if len(blocked) == 0 else (4.0 if blocked[0] else -4.0), tuple(sizes), bits)
    row, bucket, value = features(addresses, sizes, bits)
    used, column = np.unique(bucket, return_inverse=True)
    w, ahead, b, b_ahead = np.zeros(len(used)), np.zeros(len(used)), 0.0, 0.0
    for step in range(steps):
        margin = np.bincount(row, ahead[column] * value, len(blocked)) + b_ahead
        error = 1 / (1 + np.exp(-margin)) - blocked
        new_w = ahead - rate * (np.bincount(column, error[row] * value, len(used)) / len(blocked) + decay * ahead)
        new_b = b_ahead - rate * error.mean()
        push = step / (step + 3)
        ahead, b_ahead = new_w + push * (new_w - w), new_b + push * (new_b - b)
        w, b = new_w, new_b
    weights[used] = w
    return UrlModel(weights, float(b), tuple(sizes), bits)


def label_by_rules(pages: DataFrame, rules: Sequence[Rule], limit: int, url: str = "url") -> DataFrame:
    """A small labelled URL table: up to ``limit`` different addresses that a rule decides, by hash order.

    The bound is the size of the table a person would label; it is a sample for fitting only.
    """
    host, path = host_and_path(F.col(url))
    _, verdict = rule_of(host, path, rules)
    address = F.concat(host, path)
    known = pages.select(address.alias("address"), (verdict == BLOCK).cast("int").alias("blocked"))
    return known.where("blocked is not null").distinct().orderBy(F.xxhash64("address"), "address").limit(limit)


def fit_table(labelled: DataFrame, limit: int = 20_000, **options) -> UrlModel:
    """The model of a labelled table (address string, blocked 0/1); at most ``limit`` rows of it are fitted."""
    rows = labelled.select("address", "blocked").where("address is not null and blocked is not null").limit(limit).collect()
    return fit([r[0].encode() for r in rows], np.array([r[1] for r in rows]), **options)


def judge(pages: DataFrame, rules: Sequence[Rule], model: UrlModel, id_col: str = "page_id", url: str = "url", cut: float = 0.5) -> DataFrame:
    """One row per page: id, host, path, rule, verdict, and the model's probability.

    A rule's verdict wins over the model's. A null or malformed url has empty host and path, fits no rule and is
    scored as an empty address. Repeated rows stay repeated; other columns of ``pages`` are not read.
    """
    host, path = host_and_path(F.col(url))
    parts = pages.select(F.col(id_col), host.alias("host"), path.alias("path"))
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, paths = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            p = np.concatenate([np.zeros(0), *(shared.value.probability([(h + q).encode() for h, q in zip(hosts[s : s + 2000], paths[s : s + 2000])]) for s in range(0, len(hosts), 2000))])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p)], ["id", "host", "path", "p_block"])

    id_type = parts.schema[0].dataType.simpleString()
    found = map_batches(parts, scored, f"id {id_type}, host string, path string, p_block double")
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    by_model = F.when(F.col("p_block") >= cut, BLOCK).otherwise(ALLOW)
    return found.select(F.col("id").alias(id_col), "host", "path", rule.alias("rule"), F.coalesce(verdict, by_model).alias("verdict"), "p_block")
