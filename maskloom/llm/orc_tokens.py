"""Token ids as ORC: integer run-length encoding, row indexes, Bloom filters on document ids.

Documents are ranged and sorted by id before they are encoded, so every file and stripe covers a narrow id range:
a lookup of ids prunes files and stripes by their statistics and row groups by the Bloom filter, and a full read
is parallel by stripe.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from maskloom.llm.tables import map_batches

PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
CACHE_LIMIT = 1_000_000
#: Outside this range a letter's normal form or lower case may depend on its neighbours.
_beyond_simple = re.compile("[^\x00-įı-ɏ]").search
#: Byte-level files write some bytes, those that cannot be printed, as letters from 256 on.
_plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
BYTE_LETTERS = dict(zip([b for b in range(256) if b not in _plain], range(256, 512)))


class _Chunks(dict):
    """Ids, as bytes, of the strings between spaces; found once per worker process, then looked up."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.by_words = all(self.word(w) == self.whole(w) for w in ("a", "Wort", "zqxjk", "niñoõ", "ªłſ"))

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4").tobytes()

    def word(self, letters: str) -> bytes:
        """The same for a run of simple letters: one piece, so the model's merges are all that is left to do."""
        written = letters.lower().encode("utf-8").decode("latin-1").translate(BYTE_LETTERS)
        return np.array([token.id for token in self.model.tokenize(written)], "<u4").tobytes()

    def __missing__(self, chunk: str) -> bytes:
        if len(chunk) > 64:
            return self.whole(chunk)
        base = chunk.rstrip(PUNCTUATION)
        if base and len(base) < len(chunk) and base[-1].isalpha():
            ids = self[base] + self[chunk[len(base) :]]  # a run of letters ends where punctuation starts
        elif self.by_words and chunk.isalpha() and not _beyond_simple(chunk):
            ids = self.word(chunk)
        else:
            ids = self.whole(chunk)
        self[chunk] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """The library's ids of the text. No piece of this kind of tokenizer holds white space, so the ids are
        those of the parts between spaces; texts with anything like a special token go to the library whole."""
        if "<|" in text:
            return self.whole(text)
        if not _beyond_simple(text):
            text = text.lower()
        if len(self) > CACHE_LIMIT:
            self.clear()
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


_loaded: dict[str, _Chunks] = {}


def chunks_of(path: str) -> _Chunks:
    if path not in _loaded:
        _loaded[path] = _Chunks(path)
    return _loaded[path]


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", stride: int = 1_000) -> None:
    """Encode every whole text and write one row per document, in ascending order of id.

    Rows: the id, ``part`` and ``local_start`` (range partition, and ids before the document inside it),
    ``n_tokens``, and ``ids`` with the end id last. Null text counts as empty; null ids come first; rows with
    the same id are ordered by their text. Other columns are not read. ``tokenizer`` is a word-wise lower-casing
    BPE file that lies at this path on every executor.
    """
    # Salted by the text's hash: one id on very many rows does not land in one range.
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    ranged = rows.repartitionByRange("id", "h").sortWithinPartitions("id", "h", "text")
    end = np.array([end_id], "<u4").tobytes()

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks, part, before = chunks_of(tokenizer), TaskContext.get().partitionId(), 0
        for batch in batches:
            found = [chunks.encode(t) + end for t in batch.column(1).to_pylist()]
            sizes = np.array([len(f) // 4 for f in found], np.int64)
            offsets = np.concatenate([[0], np.cumsum(sizes)])
            ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.frombuffer(b"".join(found), "<i4")))
            columns = [batch.column(0), pa.array(np.full(len(sizes), part, np.int32)), pa.array(before + offsets[:-1]), pa.array(sizes), ids]
            yield pa.RecordBatch.from_arrays(columns, [id_col, "part", "local_start", "n_tokens", "ids"])
            before += int(offsets[-1])

    kind = rows.schema[0].dataType.simpleString()
    found = map_batches(ranged.select("id", "text"), encoded, f"{id_col} {kind}, part int, local_start bigint, n_tokens bigint, ids array<int>")
    options = {"orc.bloom.filter.columns": id_col, "orc.bloom.filter.fpp": "0.01", "orc.row.index.stride": str(stride), "orc.stripe.size": str(64 << 20), "compression": "zstd"}
    found.write.options(**options).orc(path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the files, with ``start``: the ids of all documents before. Filters on the id reach the files."""
    rows = spark.read.orc(path)
    # One row per written partition, whatever the number of documents.
    ends = rows.groupBy("part").agg(F.sum("n_tokens").alias("held"))
    offsets = ends.select("part", (F.sum("held").over(Window.orderBy("part")) - F.col("held")).alias("part_start"))
    return rows.join(F.broadcast(offsets), "part").withColumn("start", F.col("part_start") + F.col("local_start")).drop("part_start")


def with_crc32(rows: DataFrame) -> DataFrame:
    """``ids`` replaced by ``ids_crc32``, of the ids as little-endian unsigned 32-bit integers."""

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("ids"))
            values = memoryview(np.asarray(ids.values, "<i4").tobytes())
            bounds = ids.offsets.to_numpy().astype(np.int64) * 4
            found = [zlib.crc32(values[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
            keep = [i for i, name in enumerate(batch.schema.names) if name != "ids"]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in keep), pa.array(found, pa.int64())], [*(batch.schema.names[i] for i in keep), "ids_crc32"])

    kept = [f for f in rows.schema if f.name != "ids"]
    return map_batches(rows, digested, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "ids_crc32 bigint"]))
