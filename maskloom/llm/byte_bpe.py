"""Byte-level BPE in both directions, by DuckDB queries inside the tasks.

Encoding: token-position rows of the pieces not seen before join the merge table, and a recursive query contracts
each piece's leftmost pair of lowest rank until none is left. Decoding: token rows join the byte table, and an
ordered aggregation puts each document's bytes together.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskloom.llm.tables import blocks, fresh_name, kept_for_tasks, map_batches, schema_text

#: Fixed value: the pattern that splits a text into pieces before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Bytes of strings and ids that a worker remembers, with what Python needs to hold them.
CACHE_BYTES = 120_000_000
ENTRY_BYTES = 180
#: Rounds of one query, and token rows times rounds that it may keep.
ROUNDS, KEPT_ROWS = 64, 1_500_000
SHORT = 64
_odd_space = re.compile(r"[^\S \n]|[ \n]{2}|[\x1c-\x1f\0]").search

# Pieces of up to SHORT bytes: a token's key is piece * SHORT + place, and every row knows the next token. One round
# takes the leftmost pair of the lowest rank of each piece (rank, place and the way to the next token in one number, so that
# the least of them names all three), and looks up the two pairs that this makes.
_CONTRACT_SHORT = f"""
with recursive step(k, t, next_k, next_t, made, n) as (
    select k, t, next_k, next_t, made, 0 from pieces left join merges on l = t and r = next_t
    union all
    select k, t, next_k, next_t, case when fresh is null then old else merges.made end, n from (
        with best as (
            select k // {SHORT} as w, min((made::bigint << 40) | (k << 7) | (next_k - k)) as found from step where made is not null group by all
        ), spots as (
            select w, found >> 40 as made, (found >> 7) & 8589934591 as spot, ((found >> 7) & 8589934591) + (found & 127) as gone from best
        ), pair as (
            select w, spot, spots.made, gone, b.next_k as beyond, b.next_t as beyond_t from spots join step b on b.k = gone
        )
        select k, case when k = spot then pair.made else t end as t, case when k = spot then beyond else next_k end as next_k,
            case when k = spot then beyond_t when next_k = spot then pair.made else next_t end as next_t, step.made as old,
            case when k = spot then pair.made when next_k = spot then t end as fresh, n + 1 as n
        from step join pair on k // {SHORT} = w where k <> gone
    ) moved left join merges on l = fresh and r = next_t
), done as (
    select k // {SHORT} as w, n from step group by all having count(made) = 0
)
select w, t from step join done on k // {SHORT} = w and step.n = done.n order by k
"""

# Longer pieces: one round takes, in each piece, the leftmost pair of the lowest rank, and with it the further pairs of that rank
# as far as no contraction before them makes a pair of a still lower rank. That is the order of one leftmost pair at
# a time, with fewer rounds for long pieces. In a run of equal tokens every other pair counts.
_CONTRACT = f"""
with recursive step(w, p, t, n) as (
    select w, p, t, 0 from pieces
    union all
    select w, p, t, n from (
        with near as (
            select w, p, t, n, row_number() over by_place as i, lag(t) over by_place as before, lead(t) over by_place as after,
                lead(p) over by_place as after_p, lead(t, 2) over by_place as beyond
            from step where n < (select rounds from bounds) window by_place as (partition by w order by p)
        ), ranked as (
            select near.*, made, min(made) over (partition by w) as best from near left join merges on l = t and r = after
        ), lowest as (
            select *, i - row_number() over (partition by w order by i) as run from ranked where made = best
        ), apart as (
            select * from lowest qualify row_number() over (partition by w, run order by i) % 2 = 1
        ), checked as (
            select apart.*, coalesce(x.made < apart.made, false) or coalesce(y.made < apart.made, false) or coalesce(z.made < apart.made, false) as lower
            from apart left join merges x on x.l = before and x.r = apart.made left join merges y on y.l = apart.made and y.r = beyond
                left join merges z on z.l = apart.made and z.r = apart.made
        ), chosen as (
            select w, p, after_p, made from checked qualify i <= coalesce(min(i) filter (lower) over (partition by w), i)
        )
        select ranked.w, ranked.p, coalesce(chosen.made, ranked.t) as t, ranked.n + 1 as n
        from ranked left join chosen on chosen.w = ranked.w and chosen.p = ranked.p
        where best is not null and (ranked.w, ranked.p) not in (select (w, after_p) from chosen)
    )
)
select w, p, t, n from step qualify n = max(n) over (partition by w) order by w, p
"""


class Codec:
    """Merge and byte tables of one rank file in a DuckDB of this process, and the pieces encoded so far."""

    def __init__(self, path: str, cache_bytes: int = CACHE_BYTES):
        import duckdb
        import regex

        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "250MB", "temp_directory": ""})
        pairs = [(self.ranks[t[:k]], self.ranks[t[k:]], rank) for t, rank in self.ranks.items() for k in range(1, len(t)) if t[:k] in self.ranks and t[k:] in self.ranks]
        left, right, made = (pa.array(x, pa.int32()) for x in zip(*pairs))
        self._table("merges", {"l": left, "r": right, "made": made})
        self._table("bytes", {"t": pa.array(list(self.ranks.values()), pa.int32()), "h": pa.array([t.hex() for t in self.ranks])})
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.split = regex.compile(PATTERN).findall
        self.runs = regex.compile(r"\s*\S+|\s+").findall
        self.cache: dict[str, bytes] = {"": b""}
        self.cache_bytes, self.held = cache_bytes, 0

    def _table(self, name: str, columns: dict) -> None:
        self.db.register("given", pa.table(columns))
        self.db.execute(f"create or replace table {name} as select * from given")
        self.db.unregister("given")

    def contracted(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece, as little-endian 32-bit integers."""
        found: list[bytes] = [b""] * len(pieces)
        short = [i for i, piece in enumerate(pieces) if len(piece) <= SHORT]
        # A piece has fewer rounds than bytes, and every round's rows are kept.
        for start, end in blocks(np.array([len(pieces[i]) ** 2 for i in short], np.int64), KEPT_ROWS):
            part = short[start:end]
            sizes = np.array([len(pieces[i]) for i in part])
            w = np.repeat(np.arange(len(part)), sizes)
            k = w * SHORT + np.arange(len(w)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            t = self.single[np.frombuffer(b"".join(pieces[i] for i in part), np.uint8)]
            last = np.append(w[1:] != w[:-1], True)
            self._table("pieces", {"k": pa.array(k), "t": pa.array(t), "next_k": pa.array(k + 1, mask=last), "next_t": pa.array(np.append(t[1:], np.int32(0)), mask=last)})
            got = self.db.execute(_CONTRACT_SHORT).fetchnumpy()
            ids, bounds = np.asarray(got["t"], "<i4").tobytes(), 4 * np.searchsorted(np.asarray(got["w"]), np.arange(len(part) + 1))
            for i, low, high in zip(part, bounds[:-1].tolist(), bounds[1:].tolist()):
                found[i] = ids[low:high]
        order = sorted((i for i, piece in enumerate(pieces) if len(piece) > SHORT), key=lambda i: len(pieces[i]))
        for start, end in blocks(np.array([min(len(pieces[i]), 4_000) * max(1, len(pieces[i]) // 32) for i in order]), 200_000):
            part = order[start:end]
            sizes = np.array([len(pieces[i]) for i in part])
            w = np.repeat(np.arange(len(part), dtype=np.int32), sizes)
            p = (np.arange(len(w)) - np.repeat(np.cumsum(sizes) - sizes, sizes)).astype(np.int32)
            t = self.single[np.frombuffer(b"".join(pieces[i] for i in part), np.uint8)]
            while len(w):
                self._table("pieces", {"w": pa.array(w), "p": pa.array(p), "t": pa.array(t)})
                rounds = max(1, min(ROUNDS, KEPT_ROWS // len(w)))
                self._table("bounds", {"rounds": pa.array([rounds], pa.int32())})
                got = self.db.execute(_CONTRACT).fetchnumpy()
                w, p, t, n = (np.asarray(got[c]) for c in ("w", "p", "t", "n"))
                over = n < rounds
                bounds = np.searchsorted(w[over], np.arange(len(part) + 1))
                done = t[over].astype("<i4")
                for k in np.unique(w[over]).tolist():
                    found[part[k]] = done[bounds[k] : bounds[k + 1]].tobytes()
                w, p, t = w[~over], p[~over], t[~over]  # long pieces go on from where they are
        return found

    def learn(self, parts: set[str]) -> None:
        """Encode strings that are not in the cache; every distinct piece once."""
        new = list(parts.difference(self.cache))
        split = [self.split(p) for p in new]
        pieces = list({x for s in split for x in s}.difference(self.cache))
        known = self.cache
        # A word is often met first with a mark behind it, and then without: both are kept.
        known.update(zip(pieces, self.contracted([x.encode() for x in pieces])))
        known.update((p, b"".join([known[x] for x in s])) for p, s in zip(new, split) if len(s) > 1)
        self.held += sum(4 * len(p) + len(known[p]) + ENTRY_BYTES for p in {*pieces, *new})

    def parts(self, text: str) -> list[str]:
        """The text cut wherever white space follows something else: no piece crosses there."""
        if _odd_space(text):
            return self.runs(text)
        return text.replace(" ", "\0 ").replace("\n", "\0\n").split("\0")

    def encode(self, texts: list[str]) -> list[bytes]:
        if self.held > self.cache_bytes:
            self.cache, self.held = {"": b""}, 0
        cut = [self.parts(t) for t in texts]
        self.learn(set().union(*cut))
        return [b"".join(map(self.cache.__getitem__, c)) for c in cut]

    def decode(self, owner: np.ndarray, ids: np.ndarray, count: int) -> list[bytes]:
        """The bytes of ``count`` documents; ``owner`` has the document of each id."""
        self._table("tokens", {"d": pa.array(owner), "p": pa.array(np.arange(len(ids), dtype=np.int32)), "t": pa.array(ids)})
        got = self.db.execute("select d, string_agg(h, '' order by p) as h, count(*) filter (h is null) as unknown from tokens left join bytes using (t) group by d").fetchall()
        found = [b""] * count
        for d, text, unknown in got:
            if unknown:
                raise ValueError("an id that the rank file does not have")
            found[d] = bytes.fromhex(text)
        return found


def codec(path: str, cache_bytes: int | None = None) -> Codec:
    """The worker's codec of a file: it stays for the next task, and goes when the worker turns to other work."""
    found = kept_for_tasks("byte_bpe", path, lambda: Codec(path), lambda old: old.db.close())
    if cache_bytes is not None:
        found.cache_bytes = cache_bytes
    return found


def _encoded(batches: Iterator[pa.RecordBatch], ranks: str, out: str, cache_bytes: int) -> Iterator[pa.RecordBatch]:
    """The first column, a text, is left out, and the ids come last."""
    for batch in batches:
        texts = batch.column(0).fill_null("")
        for start, end in blocks(np.asarray(pa.compute.binary_length(texts)), 1_000_000):
            found = codec(ranks, cache_bytes).encode(texts.slice(start, end - start).to_pylist())
            offsets = np.concatenate([[0], np.cumsum([len(f) // 4 for f in found])])
            ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.frombuffer(b"".join(found), "<i4")))
            yield pa.RecordBatch.from_arrays([*batch.slice(start, end - start).columns[1:], ids], [*batch.schema.names[1:], out])


def _decoded(batches: Iterator[pa.RecordBatch], ranks: str, ids_col: str, out: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(batch.schema.get_field_index(ids_col))
        sizes = np.asarray(pa.compute.list_value_length(ids).fill_null(0)).astype(np.int64)
        found: list[bytes] = []
        for start, end in blocks(sizes, 250_000):
            values = np.asarray(ids.slice(start, end - start).flatten(), np.int32)
            found += codec(ranks).decode(np.repeat(np.arange(end - start, dtype=np.int32), sizes[start:end]), values, end - start)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.binary())], [*batch.schema.names, out])


def encode(docs: DataFrame, ranks: str, id_col: str = "doc_id", text_col: str = "text", out: str = "ids", keep: Sequence[str] = (), decoded: str | None = None, cache_bytes: int = CACHE_BYTES) -> DataFrame:
    """One row per document: id, the columns named in ``keep``, and ``ids``, array<int>; null text counts as empty, an empty text has no ids.

    ``decoded`` names a further column with the bytes that the ids decode to, made in the same task. Special tokens
    are ordinary text. Repeated rows stay; other columns are not read. ``ranks`` is a rank file that lies at this
    path on every executor. ``cache_bytes`` bounds what a worker remembers of the strings between white space; a batch
    of 1 MB of text comes on top. A piece (letters without a break) of any length is contracted, with fewer rounds a query
    the longer it is.
    """
    kept = docs.select(id_col, *keep)
    rows = docs.select(F.col(text_col).alias(fresh_name(kept, "encoded_text")), id_col, *keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = _encoded(batches, ranks, out, cache_bytes)
        return _decoded(ids, ranks, out, decoded) if decoded else ids

    return map_batches(rows, run, f"{schema_text(kept)}, `{out}` array<int>" + (f", `{decoded}` binary" if decoded else ""), owner="byte_bpe")


def decode(rows: DataFrame, ranks: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """All columns of the rows, and ``out``: the bytes of ``ids_col`` (null ids: none). An unknown id is an error."""
    return map_batches(rows, lambda batches: _decoded(batches, ranks, ids_col, out), f"{schema_text(rows)}, `{out}` binary", owner="byte_bpe")


def ids_digest(ids) -> F.Column:
    """Hex SHA-256 of the decimal ids joined by commas."""
    return F.sha2(F.concat_ws(",", ids.cast("array<string>")), 256)
