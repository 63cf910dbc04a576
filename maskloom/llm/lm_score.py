"""Cross-entropy difference: two matched n-gram models, a target's and the background's, over one vocabulary.

Both are interpolated bigram models of the same form over the same words and pairs, told apart by 64-bit hashes. Each
block of texts sends its distinct hashes once, packed by ranges of hashes; a range adds them up and answers every block
with the counts of what it sent. No table of a whole corpus is held anywhere, so the counts grow with the input.

A block always cuts its hashes into ``RANGES`` ranges. Where a range would be too large for one task, about ``RANGES``
blocks are added up first, and what they make together is cut into ``RANGES`` finer ranges, and so on: every level has
at most two messages for each block and range, whatever the size of the corpus.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskloom.llm.hashing import mixed, word_hashes
from maskloom.llm.quality import SPACES
from maskloom.llm.tables import blocks, map_batches, stored, text_blocks


#: Bytes of text a block should have, bytes of a part of it that is hashed at once, and bytes of input for a range of hashes.
BLOCK, PART, BUCKET = 8_000_000, 2_000_000, 8_000_000
#: Ranges into which one level cuts, and blocks that a level above the last adds up.
RANGES = 256
WORD, PAIR = range(2)


@dataclass(frozen=True)
class Shape:
    """Bits of a word's and of a pair's hash; with all 64 the vocabulary is the words that were met, else all slots."""

    word_bits: int = 64
    pair_bits: int = 64


def tokens(texts: list[bytes], shape: Shape) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word slot, pair slot, text number) of every word; A-Z lower-cased; the pair of a first word is with a start mark."""
    word, row, _ = word_hashes([t.lower() for t in texts], SPACES)
    before = np.zeros(len(word), np.uint64)
    before[1:] = np.where(row[1:] == row[:-1], word[:-1], np.uint64(0))
    pair = mixed(before * np.uint64(0x9E3779B97F4A7C15) + word)
    return (word >> np.uint64(64 - shape.word_bits)).astype(np.int64), (pair >> np.uint64(64 - shape.pair_bits)).astype(np.int64), row


def _packed(counts: np.ndarray) -> bytes:
    """Whole numbers from 0 up, in the width that the largest needs."""
    width = np.min_scalar_type(int(counts.max(initial=0))).itemsize
    return bytes([width]) + zlib.compress(counts.astype(f"<u{width}").tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(memoryview(data)[1:]), f"<u{data[0]}").astype(np.int64)


def _parts(texts: list[bytes], shape: Shape) -> Iterator[tuple[int, int, tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """(first text, last text, words' keys, pairs' keys, text numbers), a part of the block at a time; keys are spread evenly."""
    for low, high in blocks(np.array([len(t) for t in texts], np.int64), PART):
        word, pair, row = tokens(texts[low:high], shape)
        yield low, high, (mixed(word.view(np.uint64)), mixed(pair.view(np.uint64)), row)


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """(different keys in order, their counts): ``parts`` are keys, each once, with rows of counts."""
    keys = np.concatenate([np.zeros(0, np.uint64), *(k for k, _ in parts)])
    keys.sort()
    keys = keys[np.diff(keys, prepend=~keys[:1]) != 0]
    sums = np.zeros((parts[0][1].shape[0] if parts else 1, len(keys)), np.int64)
    for some, counts in parts:
        sums[:, np.searchsorted(keys, some)] += counts
    return keys, sums


def _distinct(texts: list[bytes], shape: Shape) -> list[tuple[np.ndarray, np.ndarray]]:
    """(different keys in order, times) of the block's words and of its pairs."""
    met: tuple[list, list] = ([], [])
    for _, _, found in _parts(texts, shape):
        for kind in (WORD, PAIR):
            keys, times = np.unique(found[kind], return_counts=True)
            met[kind].append((keys, times[None]))
    return [_added(m) for m in met]


def _ends(keys: np.ndarray, ranges: int) -> np.ndarray:
    """Where each of the ranges begins among ordered keys, and the end of the last."""
    return np.searchsorted((keys >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32), np.arange(ranges + 1, dtype=np.uint64))


def _blocks(rows: DataFrame) -> DataFrame:
    """(block, ids, sizes, texts): the rows in blocks of texts, packed."""
    kind = rows.schema[0].dataType.simpleString()

    def row(number: int, ids: list[pa.Array], texts: list[bytes]) -> pa.RecordBatch:
        held = pa.concat_arrays(ids)
        listed = pa.ListArray.from_arrays(pa.array([0, len(held)], pa.int32()), held)
        packed = _packed(np.array([len(t) for t in texts])), zlib.compress(b"".join(texts), 1)
        return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), listed, *(pa.array([c], pa.binary()) for c in packed)], ["block", "ids", "sizes", "texts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, ids, texts, size = TaskContext.get().partitionId() << 32, [], [], 0
        for batch in batches:
            for start, part in text_blocks(batch.column(1), min(PART, BLOCK)):
                ids.append(batch.column(0).slice(start, len(part)))
                texts += part
                size += sum(map(len, part))
                if size >= BLOCK:
                    yield row(number, ids, texts)
                    number, ids, texts, size = number + 1, [], [], 0
        if texts:
            yield row(number, ids, texts)

    return map_batches(rows, run, f"block bigint, ids array<{kind}>, sizes binary, texts binary")


def _texts(sizes: bytes, texts: bytes) -> list[bytes]:
    lengths, whole = _unpacked(sizes), zlib.decompress(texts)
    return [whole[end - n : end] for end, n in zip(np.cumsum(lengths).tolist(), lengths.tolist())]


MESSAGE = "owner bigint, kind int, part int, keys binary, counts binary"


def _messages(owner: int, kind: int, keys: np.ndarray, sums: np.ndarray, ranges: int) -> dict[str, list]:
    """The messages of one owner: keys and counts (background, target) cut by ranges."""
    ends = _ends(keys, ranges)
    some = np.flatnonzero(np.diff(ends))
    cut = [slice(ends[i], ends[i + 1]) for i in some]
    return {"owner": [owner] * len(some), "kind": [kind] * len(some), "part": some, "keys": [keys[c].tobytes() for c in cut], "counts": [_packed(sums[:, c]) for c in cut]}


_MESSAGE = pa.schema([("owner", pa.int64()), ("kind", pa.int32()), ("part", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])


def _keys(held: DataFrame, shape: Shape, target: bool) -> DataFrame:
    """The messages of each block: its different words and pairs; blocks of the target expect no answer, their owner is negative."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, sizes, texts in zip(*batch.columns):
                owner = -1 - number.as_py() if target else number.as_py()
                for kind, (keys, times) in enumerate(_distinct(_texts(sizes.as_py(), texts.as_py()), shape)):
                    both = np.zeros((2, len(keys)), np.int64)
                    both[int(target)] = times[0]
                    yield pa.RecordBatch.from_pydict(_messages(owner, kind, keys, both, RANGES), _MESSAGE)

    return map_batches(held.select("block", "sizes", "texts"), run, MESSAGE)


def _read(part: pa.Table) -> list[tuple[np.ndarray, np.ndarray]]:
    """(keys, counts) of each message."""
    return [(np.frombuffer(k.as_buffer(), "<u8"), _unpacked(c.as_py()).reshape(2, -1)) for k, c in zip(part.column("keys"), part.column("counts"))]


def _places(keys: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Where each of ``asked`` stands among ordered keys, looked up in order, which is what caches like."""
    order = np.argsort(asked)
    places = np.empty(len(asked), np.int64)
    places[order] = np.searchsorted(keys, asked[order])
    return places


ANSWER = "owner bigint, kind int, part int, counts binary"
_ANSWER = pa.schema([("owner", pa.int64()), ("kind", pa.int32()), ("part", pa.int32()), ("counts", pa.binary())])


def _answers(sent: pa.Table, keys: np.ndarray, sums: np.ndarray) -> dict[str, list]:
    """To each message of the background the sums of its keys."""
    asked = ((o.as_py(), np.frombuffer(k.as_buffer(), "<u8")) for o, k in zip(sent.column("owner"), sent.column("keys")))
    found = [(owner, _packed(sums[:, np.searchsorted(keys, some)])) for owner, some in asked if owner >= 0]
    first = [sent.column(c)[0].as_py() for c in ("kind", "part")]
    return {"owner": [o for o, _ in found], "kind": first[:1] * len(found), "part": first[1:] * len(found), "counts": [c for _, c in found]}


def _summed(sent: pa.Table) -> pa.Table:
    """The answers of one range; a row without an owner holds how many different keys there are, and both totals."""
    keys, sums = _added(_read(sent))
    out = _answers(sent, keys, sums)
    for name, value in (("owner", None), ("kind", sent.column("kind")[0].as_py()), ("part", sent.column("part")[0].as_py()), ("counts", _packed(np.array([len(keys), *sums.sum(1)])))):
        out[name].append(value)
    return pa.table(out, _ANSWER)


def _counted(sent: DataFrame, blocks_sent: int, ranges: int, wanted: int) -> tuple[DataFrame, DataFrame]:
    """(answers to ``sent``, rows of totals). ``sent`` is cut into ``ranges`` by about ``blocks_sent`` owners; ``wanted`` ranges are enough."""
    if ranges >= wanted:
        met = stored(sent.groupBy("kind", "part").applyInArrow(_summed, ANSWER), "counts")
        return met.where("owner is not null"), met.where("owner is null")
    sent = stored(sent, "messages")
    groups, finer = max(1, blocks_sent // RANGES), min(RANGES, -(-wanted // ranges)) * ranges
    grouped = sent.withColumn("group", F.pmod(F.xxhash64("owner"), F.lit(groups)))

    def together(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        return _added(_read(rows))

    def merged(rows: pa.Table) -> pa.Table:
        return pa.table(_messages(rows.column("group")[0].as_py(), rows.column("kind")[0].as_py(), *together(rows), finer), _MESSAGE)

    def passed_on(rows: pa.Table, found: pa.Table) -> pa.Table:
        keys, _ = together(rows)
        in_order = sorted(zip(found.column("part").to_pylist(), found.column("counts")), key=lambda f: f[0])
        return pa.table(_answers(rows, keys, np.concatenate([_unpacked(c.as_py()).reshape(2, -1) for _, c in in_order], 1)), _ANSWER)

    found, totals = _counted(grouped.groupBy("kind", "part", "group").applyInArrow(merged, MESSAGE), groups, finer, wanted)
    above = found.withColumn("above", F.floor(F.col("part") / (finer // ranges)).cast("int"))
    return grouped.groupBy("kind", "part", "group").cogroup(above.groupBy("kind", "above", "owner")).applyInArrow(passed_on, ANSWER), totals


def losses(words: np.ndarray, context: np.ndarray, pairs: np.ndarray, total: int, vocabulary: int, weight: float) -> np.ndarray:
    """Minus log2 of each word's chance, from the counts of the word, of the word before (0 at the start) and of the pair."""
    chance = (words + 0.5) / (total + 0.5 * vocabulary)
    seen = np.minimum(pairs, np.maximum(context, 1))
    # Witten-Bell with a fixed strength: the pair counts as much as it was seen.
    return -np.log2((seen * (context > 0) + weight * chance) / (context + weight))


def score(docs: DataFrame, target: DataFrame, shape: Shape = Shape(), weight: float = 8.0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``n_words``, ``loss_target`` and ``loss_background`` (bits per word), ``score``.

    ``target`` holds the texts of the target; all ``docs`` are the background. ``score`` is the target's loss less
    the background's: the lower, the more like the target. Documents without words (null or empty text) have null
    losses and score; an empty target makes its model uniform. Repeated documents count and are scored as often
    as they come, null ids stay. Other columns are not read.
    """
    rows, wanted = docs.select(id_col, text_col), target.select(F.lit(0).alias(id_col), text_col)
    size = sum(frame.agg(F.sum(F.octet_length(text_col))).first()[0] or 0 for frame in (rows, wanted))
    whole = stored(_blocks(rows), "blocks")
    # Stored as well: a task with two Python functions in a row would need two workers at once.
    sent = _keys(whole, shape, False).unionByName(_keys(stored(_blocks(wanted), "target"), shape, True))
    answers, sums = _counted(sent, -(-size // BLOCK), RANGES, -(-size // BUCKET))

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = np.sum([np.zeros(3, np.int64), *(_unpacked(c.as_py()) for c in batch.column(0))], 0)
            yield pa.RecordBatch.from_arrays([pa.array([int(x)]) for x in sums], ["words", "background", "target"])

    met = map_batches(sums.where(F.col("kind") == WORD).select("counts"), totals, "words bigint, background bigint, target bigint")
    words, *total = (x or 0 for x in met.agg(F.sum("words"), F.sum("background"), F.sum("target")).first())
    vocabulary = words if shape.word_bits == 64 else 1 << shape.word_bits

    def scored(block: pa.Table, found: pa.Table) -> pa.Table:
        ids, sizes, packed = (block.column(c)[0] for c in ("ids", "sizes", "texts"))
        texts = _texts(sizes.as_py(), packed.as_py())
        keys = [k for k, _ in _distinct(texts, shape)]
        answers_of: tuple[list, list] = ([], [])
        for which, _, counts in sorted(zip(found.column("kind").to_pylist(), found.column("part").to_pylist(), found.column("counts")), key=lambda f: f[:2]):
            answers_of[which].append(_unpacked(counts.as_py()).reshape(2, -1))
        counts = [np.concatenate([np.zeros((2, 0), np.int64), *a], 1) for a in answers_of]
        n, lost = np.zeros(len(texts), np.int64), np.zeros((2, len(texts)))
        for low, high, (*met, at) in _parts(texts, shape):
            place = [_places(k, m) for k, m in zip(keys, met)]
            first = np.diff(at, prepend=-1) != 0
            n[low:high] = np.bincount(at, minlength=high - low)
            for m in (0, 1):
                words = counts[WORD][m][place[WORD]]
                context = np.where(first, 0, np.roll(words, 1))
                lost[m, low:high] = np.bincount(at, losses(words, context, counts[PAIR][m][place[PAIR]], total[m], vocabulary, weight), high - low)
        of_all, of_target = lost / np.maximum(n, 1)
        none = n == 0
        columns = [pa.array(n), *(pa.array(x, mask=none) for x in (of_target, of_all, of_target - of_all))]
        return pa.table([ids.values, *columns], [id_col, "n_words", "loss_target", "loss_background", "score"])

    kind = rows.schema[0].dataType.simpleString()
    return whole.groupBy("block").cogroup(answers.groupBy("owner")).applyInArrow(scored, f"`{id_col}` {kind}, n_words bigint, loss_target double, loss_background double, score double")
