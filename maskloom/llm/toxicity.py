"""Toxicity by a weighted finite-state grammar over clauses.

A lexical transducer (an Aho-Corasick machine over word beginnings) turns words into classes, its insult arcs weighted
by what labelled documents show. Three small transducers, composed into one machine, then read a clause: negation
marks what it denies, reported speech what is only quoted, and the target machine what is aimed at somebody. Each kind of
match has a weight, and a document's score is that of its matched clauses.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskloom.llm.hashing import mixed, word_hashes
from maskloom.llm.quality import SPACES, held_out
from maskloom.llm.tables import map_batches, stored, text_blocks

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, DENIED_INSULT, DENIED_THREAT, REPORTED_INSULT, REPORTED_THREAT = range(10)
KINDS = ("insult", "aimed insult", "late aim", "denied insult", "reported insult", "threat", "aimed threat", "denied threat", "reported threat")
NOTHING = len(KINDS)

# The closed word classes, in the languages of the corpus.
WORDS = {
    TARGET: "you your yours yourself yourselves thou thee du dich dir dein deine ihr euch tu toi te ton ta vous votre tú ti usted ustedes vosotros",
    NEGATION: "not no never none nobody cannot nicht kein keine keinen nie niemals ne pas jamais aucun aucune nunca ni jamás tampoco",
    REPORT: "said says say saying told tells called calls wrote writes quoted reported sagte sagt schrieb nannte dit disait écrit appelle dijo dice llamó escribió",
    THREAT: "kill kills hurt destroy murder stab shoot strangle töten umbringen verletzen tuer frapper détruire matar golpear destruir",
}
#: Weights of the kinds before any document is seen; fitting pulls towards them.
PRIOR = np.array([2.0, 3.0, 1.0, 0.5, 0.7, 0.3, 2.0, 0.1, 0.2])
PRIOR_BIAS = -2.0
#: Words that a negation reaches, and words between a target and what is aimed at it.
REACH, NEAR = 4, 5
#: Bytes of a word beginning, and documents it must be seen in.
SHORTEST, LONGEST, SUPPORT = 3, 16, 5
#: Evidence (log-likelihood ratio) and log-odds from which a beginning is an insult.
EVIDENCE, ODDS = 24.0, 2.5
#: Least hashes by which near copies in the sample are told.
MARKS = 4

_LETTERS = bytes(i if i >= 128 or chr(i).isalnum() else 32 for i in range(256))
_clause_end = re.compile(rb"[.!?;:|\n]+")


@dataclass(frozen=True)
class Transducer:
    """A deterministic machine: ``arcs[state][symbol]`` is (next state, symbol written); it starts in state 0."""

    arcs: list[list[tuple[int, int]]]

    def then(self, other: Transducer) -> Transducer:
        """One machine that writes what ``other`` writes on reading what this one writes."""
        states, arcs, at = {(0, 0): 0}, [], 0
        order = [(0, 0)]
        while at < len(order):
            first, second = order[at]
            row = []
            for next_first, between in self.arcs[first]:
                next_second, out = other.arcs[second][between]
                pair = (next_first, next_second)
                if pair not in states:
                    states[pair] = len(order)
                    order.append(pair)
                row.append((states[pair], out))
            arcs.append(row)
            at += 1
        return Transducer(arcs)

    def run(self, symbols: Iterable[int]) -> list[int]:
        state, out = 0, []
        for symbol in symbols:
            state, written = self.arcs[state][symbol]
            out.append(written)
        return out


def negation(reach: int = REACH) -> Transducer:
    """Insults and threats at most ``reach`` words after a negation are denied. The state is the words left."""
    denied = {INSULT: DENIED_INSULT, THREAT: DENIED_THREAT}
    return Transducer([[(reach if s == NEGATION else max(left - 1, 0), denied.get(s, s) if left else s) for s in range(REPORT + 1)] for left in range(reach + 1)])


def reported_speech() -> Transducer:
    """After a verb of saying, insults and threats of the clause are reported; what is denied stays so."""
    quoted = {INSULT: REPORTED_INSULT, THREAT: REPORTED_THREAT}
    return Transducer([[(int(saying or s == REPORT), quoted.get(s, s) if saying else s) for s in range(DENIED_THREAT + 1)] for saying in (0, 1)])


def aim(near: int = NEAR) -> Transducer:
    """Kinds of matches. States: nothing near; 1 to ``near``: a target that many words from being out of reach; above: the
    same of an insult or threat that no target came before."""
    kinds = {DENIED_INSULT: 3, REPORTED_INSULT: 4, DENIED_THREAT: 7, REPORTED_THREAT: 8}

    def arc(state: int, symbol: int) -> tuple[int, int]:
        target, pending = 0 < state <= near, state > near
        passed = 0 if state in (0, 1, near + 1) else state - 1
        if symbol == TARGET:
            return near, 2 if pending else NOTHING
        if symbol in (INSULT, THREAT):
            base = 0 if symbol == INSULT else 5
            return (passed, base + 1) if target else (2 * near, base)
        return passed, kinds.get(symbol, NOTHING)

    return Transducer([[arc(state, symbol) for symbol in range(REPORTED_THREAT + 1)] for state in range(2 * near + 1)])


GRAMMAR = negation().then(reported_speech()).then(aim())


def spaced(text: bytes) -> bytes:
    """The text lower-cased, every byte that is no letter, digit or part of one a space; one space before and after."""
    return b" " + text.decode().lower().encode().translate(_LETTERS) + b" "


@dataclass
class ToxicityModel:
    """``insults``: weight of word beginnings (a final space: the whole word); ``kinds``: weight of each kind."""

    insults: dict[bytes, float]
    kinds: np.ndarray
    bias: float

    def __getstate__(self):
        return {"insults": self.insults, "kinds": self.kinds, "bias": self.bias}

    def _machine(self):
        if "machine" not in self.__dict__:
            import ahocorasick

            self.closed = {w.encode(): c for c, words in WORDS.items() for w in words.split()}
            arcs = {b" " + stem: (len(stem), INSULT, weight) for stem, weight in self.insults.items()}
            arcs |= {b" " + w + b" ": (len(w) + 1, THREAT, 1.0) for w, c in self.closed.items() if c == THREAT}
            self.machine = ahocorasick.Automaton()
            for pattern, arc in arcs.items():
                self.machine.add_word(pattern.decode("latin-1"), arc)
            self.machine.make_automaton()
        return self.machine

    def clauses(self, text: bytes) -> list[tuple[int, int, np.ndarray]]:
        """(start, end, weight by kind) of each clause with an insult or threat; places are bytes of the lower-cased text."""
        machine = self._machine()
        flat = spaced(text)
        hits: dict[int, tuple[int, float]] = {}
        if len(machine):
            for end, (size, symbol, weight) in machine.iter(flat.decode("latin-1")):
                at = end - size + 1
                if at not in hits or weight > hits[at][1]:
                    hits[at] = (symbol, weight)
        if not hits:
            return []
        ends = np.array([m.end() for m in _clause_end.finditer(text.decode().lower().encode())], np.int64) + 1
        found = []
        which = np.searchsorted(ends, sorted(hits), "right")
        for clause in np.unique(which).tolist():
            low = int(ends[clause - 1]) if clause else 0
            high = int(ends[clause]) if clause < len(ends) else len(flat)
            words = [(m.start(), m.group()) for m in re.compile(rb"[^ ]+").finditer(flat, low, high)]
            symbols = [hits.get(at, (self.closed.get(word, OTHER), 1.0)) for at, word in words]
            sums = np.zeros(len(KINDS))
            for kind, (_, weight) in zip(GRAMMAR.run(s for s, _ in symbols), symbols):
                if kind != NOTHING:
                    sums[kind] += weight
            found.append((max(low - 1, 0), min(high, len(flat) - 1) - 1, sums))
        return found

    def features(self, text: bytes) -> np.ndarray:
        return np.log1p(sum((sums for _, _, sums in self.clauses(text)), np.zeros(len(KINDS))))

    def chance(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(features @ self.kinds + self.bias, -500, 500)))


def beginnings(text: bytes) -> set[bytes]:
    """The beginnings of a text's words, and each whole word with a space after it."""
    words = set(spaced(text).split())
    return {w[:k] for w in words for k in range(SHORTEST, min(len(w), LONGEST) + 1)} | {w + b" " for w in words if SHORTEST <= len(w) <= LONGEST}


def choose_insults(counts: Iterable[tuple[bytes, int, int]], toxic: int, clean: int) -> dict[bytes, float]:
    """Weights of the beginnings that set toxic documents apart, the shortest of each chain.

    ``counts`` has how many toxic and clean documents hold a beginning. The weight is the log-odds over its largest value.
    """
    chosen: dict[bytes, float] = {}
    for stem, t, c in sorted(counts, key=lambda row: len(row[0].rstrip())):
        odds = np.log((t + 0.5) / (toxic + 1)) - np.log((c + 0.5) / (clean + 1))
        share = toxic / (toxic + clean)
        seen = t + c
        evidence = 2 * (t * np.log(t / (seen * share)) + (c * np.log(c / (seen * (1 - share))) if c else 0.0))
        if t >= SUPPORT and odds >= ODDS and evidence >= EVIDENCE and not any(stem[:k] in chosen for k in range(SHORTEST, len(stem))):
            chosen[stem] = float(odds)
    top = max(chosen.values(), default=1.0)
    return {stem: odds / top for stem, odds in chosen.items()}


def fit_kinds(features: np.ndarray, labels: np.ndarray, pull: float = 1.0, steps: int = 60) -> tuple[np.ndarray, float]:
    """Kind weights and bias by logistic regression, pulled towards the prior ones; no kind weighs against toxicity."""
    x = np.column_stack([features, np.ones(len(labels))])
    prior = np.append(PRIOR, PRIOR_BIAS)
    at = prior.copy()
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        slope = x.T @ (p - labels) + pull * (at - prior)
        at -= np.clip(np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + pull * np.eye(len(at)), slope), -2, 2)
    return np.maximum(at[:-1], 0.0), float(at[-1])


def least_hashes(text: bytes, count: int = MARKS) -> list[int]:
    """The smallest of ``count`` hashes over a text's runs of three words: near copies share most of them."""
    word, _, _ = word_hashes([spaced(text)], SPACES)
    run = word[:-2] * np.uint64(3) + word[1:-1] * np.uint64(5) + word[2:] if len(word) > 2 else word
    return [int(mixed(run + np.uint64(k)).min().view(np.int64)) if len(run) else 0 for k in range(1, count + 1)]


def _different(sample: DataFrame) -> DataFrame:
    """The sample without those rows that share one of their least hashes with a row of a smaller id hash."""
    names = [f"mark{k}" for k in range(MARKS)]

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [least_hashes(t) for _, block in text_blocks(batch.column(1)) for t in block]
            columns = [pa.array([f[k] for f in found], pa.int64()) for k in range(MARKS)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["row", *names])

    marks = stored(map_batches(sample.select(F.xxhash64("id", "text").alias("row"), "text"), marked, "row bigint, " + ", ".join(f"{n} bigint" for n in names)), "toxicity-marks")
    kept = marks
    for name in names:
        kept = kept.join(marks.groupBy(name).agg(F.min("row").alias("row")), [name, "row"], "left_semi")
    return sample.join(F.broadcast(kept.select("row").distinct()), F.xxhash64("id", "text") == F.col("row"), "left_semi")


def fit_table(docs: DataFrame, labels: DataFrame, limit: int = 20_000, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> ToxicityModel:
    """The model of the labelled rows outside the held-out fifth.

    At most ``limit`` labelled ids are used, in hash order, a fifth of them toxic as far as there are enough. Four
    in five show which beginnings are insults, the others weigh the kinds. Rows with a null id or label are
    no examples, and of near copies in the sample, which would make any of their words look toxic, one is
    kept. Without both classes there are no insults, and the kinds keep their prior weights.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where(F.col("label").isin(0, 1) & F.col("id").isNotNull() & ~held_out(F.col("id")))
    order = (F.xxhash64("id", F.lit("toxicity")), "id")
    sample = known.where("label = 1").orderBy(*order).limit(limit // 5).unionByName(known.where("label = 0").orderBy(*order).limit(limit - limit // 5))
    aside = F.pmod(F.xxhash64("id", F.lit("aside")), F.lit(5)) == 4
    given = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(sample), "id")
    texts = _different(stored(given.select("id", "label", aside.alias("aside"), "text"), "toxicity-sample"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (Counter(), Counter())

        def rows() -> pa.RecordBatch:
            stems = list(set(held[0]) | set(held[1]))
            columns = [pa.array(stems, pa.binary()), *(pa.array([held[k][s] for s in stems], pa.int64()) for k in (1, 0))]
            held[0].clear()
            held[1].clear()
            return pa.RecordBatch.from_arrays(columns, ["stem", "toxic", "clean"])

        for batch in batches:
            labelled = batch.column(0).to_pylist()
            for start, block in text_blocks(batch.column(1)):
                for at, text in enumerate(block):
                    held[labelled[start + at]].update([b"", *beginnings(text)])
            if len(held[0]) + len(held[1]) > 1_000_000:
                yield rows()
        yield rows()

    sums = map_batches(texts.where("not aside").select("label", "text"), counted, "stem binary, toxic bigint, clean bigint").groupBy("stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    # The empty beginning counts the documents. The others are as many as the bounded sample makes frequent in toxic ones.
    rows = [(bytes(r.stem), r.toxic, r.clean) for r in sums.where((F.octet_length("stem") == 0) | ((F.col("toxic") >= SUPPORT) & (F.col("toxic") > F.col("clean")))).collect()]
    toxic, clean = next(((t, c) for s, t, c in rows if not s), (0, 0))
    insults = choose_insults([r for r in rows if r[0]], toxic, clean) if toxic and clean else {}
    first = ToxicityModel(insults, PRIOR, PRIOR_BIAS)
    shared = docs.sparkSession.sparkContext.broadcast(first)

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.features(t).tolist() for _, block in text_blocks(batch.column(1)) for t in block]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.float64()))], ["label", "features"])

    rest = map_batches(texts.where("aside").select("label", "text"), featured, "label int, features array<double>").collect()
    answer = np.array([r.label for r in rest], float)
    if not insults or not 0 < answer.sum() < len(answer):
        return first
    kinds, bias = fit_kinds(np.array([r.features for r in rest]), answer)
    share, here = known.agg(F.avg("label")).first()[0], answer.mean()
    return ToxicityModel(insults, kinds, bias + float(np.log(share / (1 - share)) - np.log(here / (1 - here))))


def score(docs: DataFrame, model: ToxicityModel, cut: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``held_out``, ``score`` (chance of being toxic) and ``predicted``.

    Null and empty texts have no clause and the score of the bias. Null ids and repeated rows stay; other columns
    are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.features(t) for _, block in text_blocks(batch.column(1)) for t in block]
            p = shared.value.chance(np.array(found).reshape(-1, len(KINDS)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p)], [id_col, "score"])

    rows = docs.select(id_col, text_col)
    found = map_batches(rows, scored, f"`{id_col}` {rows.schema[0].dataType.simpleString()}, score double")
    return found.select(id_col, held_out(F.col(id_col)).alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))


def matched_clauses(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per matched clause: id, ``clause`` (lower-cased), ``score`` of the clause alone and ``kinds``, its matches."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, block in text_blocks(batch.column(1)):
                rows = [(start + i, text.decode().lower().encode()[low:high], sums) for i, text in enumerate(block) for low, high, sums in shared.value.clauses(text)]
                p = shared.value.chance(np.log1p(np.array([r[2] for r in rows]).reshape(-1, len(KINDS))))
                names = [[k for k, s in zip(KINDS, r[2]) if s] for r in rows]
                clauses = [r[1].decode("utf-8", "replace").strip(" .!?;:|\n") for r in rows]
                ids = batch.column(0).take(pa.array([r[0] for r in rows], pa.int64()))
                yield pa.RecordBatch.from_arrays([ids, pa.array(clauses, pa.string()), pa.array(p), pa.array(names, pa.list_(pa.string()))], [id_col, "clause", "score", "kinds"])

    rows = docs.select(id_col, text_col)
    return map_batches(rows, found, f"`{id_col}` {rows.schema[0].dataType.simpleString()}, clause string, score double, kinds array<string>")
