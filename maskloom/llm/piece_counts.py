"""Token counts of a unigram tokenizer, without making the tokens.

An Aho-Corasick automaton enumerates the vocabulary's matches, and dynamic programming carries the best score and
its number of pieces from place to place.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame

from maskloom.llm.tables import blocks, map_batches

MARK = "▁"
#: Fixed value: what an unknown character scores below the lowest piece.
UNKNOWN_PENALTY = 10.0
#: Words that a worker remembers, and the length of the longest of them.
CACHE_LIMIT, CACHED_LENGTH = 600_000, 64


class PieceCounter:
    """Counts by the rules of a unigram model with byte fallback whose words start with a mark.

    At each place the highest sum wins, and of equal ones the one whose last piece is longest. A character that is
    no piece by itself may also be passed at ``UNKNOWN_PENALTY`` below the lowest score; it then counts as its bytes.
    A word is a run of marks with the letters after it. Words are independent, as no piece has a mark after a
    letter, which is verified here: the scores need no text around them. Pieces of several marks are used like others.
    """

    def __init__(self, vocabulary: Sequence[tuple[str, float]]):
        import ahocorasick

        self.matches = ahocorasick.Automaton()
        for piece, score in vocabulary:
            if MARK in piece.lstrip(MARK):
                raise ValueError(f"piece {piece!r} has a mark after a letter, so texts can't be cut into words")
            if piece:
                self.matches.add_word(piece, (len(piece), score))
        self.matches.make_automaton()
        self.unknown = min((s for _, s in vocabulary), default=0.0) - UNKNOWN_PENALTY
        self.known: dict[str, int] = {}

    def word(self, word: str) -> int:
        """The number of pieces of the best path through one word."""
        at: list[list[tuple[int, float]]] = [[] for _ in word]
        for end, match in self.matches.iter(word):
            at[end].append(match)
        score, count = [0.0], [0]
        for end, found in enumerate(at):
            top, pieces, single = None, 0, False
            for length, value in sorted(found, reverse=True):
                total = value + score[end + 1 - length]
                if top is None or total > top:
                    top, pieces = total, count[end + 1 - length] + 1
                single = single or length == 1
            if not single:
                total = self.unknown + score[end]
                if top is None or total > top:
                    top, pieces = total, count[end] + len(word[end].encode())
            score.append(top)
            count.append(pieces)
        return count[-1]

    def text(self, text: str) -> int:
        if not text:
            return 0
        text = text.replace(" ", MARK)
        if text[0] != MARK:
            text = MARK + text
        if MARK + MARK in text:
            words = re.findall(f"{MARK}+[^{MARK}]*", text)
        else:
            words = [MARK + word for word in text[1:].split(MARK)]
        if len(self.known) > CACHE_LIMIT:
            self.known.clear()
        known, long = self.known, {}
        for word in set(words).difference(known):
            (known if len(word) <= CACHED_LENGTH else long)[word] = self.word(word)
        if long:
            return sum(long[word] if word in long else known[word] for word in words)
        return sum(map(known.__getitem__, words))


def vocabulary_of(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a SentencePiece file; control, unknown and byte pieces are left out, as no text spells them."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    unspelt = (model.is_control, model.is_unknown, model.is_byte, model.is_unused)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size()) if not any(of(i) for of in unspelt)]


_loaded: dict[str, PieceCounter] = {}


def counter_of(path: str) -> PieceCounter:
    if path not in _loaded:
        _loaded[path] = PieceCounter(vocabulary_of(path))
    return _loaded[path]


def count_pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id and ``n_tokens``; null and empty texts have none.

    ``path`` is a SentencePiece file that lies there on every executor; its pieces and scores are read as those of
    a unigram model. Null ids and repeated rows stay; other columns are not read.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, found = batch.column(1).fill_null(""), []
            for start, end in blocks(np.asarray(pa.compute.binary_length(texts)), 8_000_000):
                found += [counter_of(path).text(t) for t in texts.slice(start, end - start).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], [id_col, "n_tokens"])

    rows = docs.select(id_col, text_col)
    return map_batches(rows, counted, f"`{id_col}` {rows.schema[0].dataType.simpleString()}, n_tokens bigint")
