from __future__ import annotations

import math
import random
import re
import zlib

import numpy as np
import pytest

from maskloom.llm import toxicity
from maskloom.llm.tables import table
from maskloom.llm.toxicity import GRAMMAR, INSULT, KINDS, NEGATION, NOTHING, OTHER, REPORT, TARGET, THREAT
from tests.llm.conftest import ordered, pairs

SYMBOLS = {"o": OTHER, "i": INSULT, "t": THREAT, "y": TARGET, "n": NEGATION, "s": REPORT}


def kinds_of(clause: str) -> list[str]:
    return [KINDS[k] for k in GRAMMAR.run(SYMBOLS[c] for c in clause) if k != NOTHING]


def plain_kinds(clause: str) -> list[str]:
    """The grammar said word by word, by looking back and ahead in the clause."""
    found, aimed_from = [], {}
    for at, c in enumerate(clause):
        name = {"i": "insult", "t": "threat"}.get(c)
        if c == "y":
            waiting = [k for k, bare in aimed_from.items() if bare and at - k <= toxicity.NEAR and not any(x == "y" for x in clause[k + 1 : at])]
            # Only the last one waits, and a denied or reported one does not.
            if waiting and max(waiting) == max(aimed_from):
                found.append("late aim")
        if name is None:
            continue
        denied = any(x == "n" for x in clause[max(0, at - toxicity.REACH) : at])
        reported = "s" in clause[:at]
        target = [k for k in range(at) if clause[k] == "y" and at - k <= toxicity.NEAR]
        if denied:
            found.append(f"denied {name}")
        elif reported:
            found.append(f"reported {name}")
        elif target:
            found.append(f"aimed {name}")
        else:
            found.append(name)
            aimed_from[at] = True
    return found


def test_clauses():
    assert kinds_of("ooi") == ["insult"]
    assert kinds_of("yooi") == ["aimed insult"]
    assert kinds_of("iooy") == ["insult", "late aim"]
    assert kinds_of("yni") == ["denied insult"]
    assert kinds_of("n" + "o" * toxicity.REACH + "i") == ["insult"]
    assert kinds_of("osooooooi") == ["reported insult"]
    assert kinds_of("sni") == ["denied insult"]
    assert kinds_of("yt") == ["aimed threat"] and kinds_of("t") == ["threat"] and kinds_of("ooyson") == []


def test_grammar_equals_looking_back_and_ahead():
    draw = random.Random(5)
    for _ in range(3_000):
        clause = "".join(draw.choice("oooiiynst") for _ in range(draw.randint(0, 14)))
        assert kinds_of(clause) == plain_kinds(clause), clause


def test_composition_equals_one_after_the_other():
    draw = random.Random(6)
    first, second, third = toxicity.negation(), toxicity.reported_speech(), toxicity.aim()
    for _ in range(500):
        clause = [draw.randrange(REPORT + 1) for _ in range(draw.randint(0, 20))]
        assert GRAMMAR.run(clause) == third.run(second.run(first.run(clause)))


MODEL = toxicity.ToxicityModel({b"idi": 1.0, b"scum ": 0.5}, toxicity.PRIOR, toxicity.PRIOR_BIAS)


def plain_score(text: str | None) -> float:
    """The score of a text, clause by clause and word by word."""
    sums = dict.fromkeys(KINDS, 0.0)
    classes = {w: "o" if c == OTHER else {TARGET: "y", NEGATION: "n", REPORT: "s", THREAT: "t"}[c] for c, words in toxicity.WORDS.items() for w in words.split()}
    for clause in re.split(r"[.!?;:|\n]", (text or "").lower()):
        words = re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", clause)
        weights = [1.0 if w.startswith("idi") else 0.5 if w == "scum" else 1.0 for w in words]
        line = "".join("i" if w.startswith("idi") or w == "scum" else classes.get(w, "o") for w in words)
        if "i" not in line and "t" not in line:
            continue
        for kind, weight in zip(GRAMMAR.run(SYMBOLS[c] for c in line), weights):
            if kind != NOTHING:
                sums[KINDS[kind]] += weight
    margin = sum(w * math.log1p(sums[k]) for k, w in zip(KINDS, toxicity.PRIOR)) + toxicity.PRIOR_BIAS
    return 1 / (1 + math.exp(-margin))


TEXTS = [
    "You are an Idiot.", "He is not an idiot, she said.", "He said you were an idiot!\nScum", "scummy people", "IDIOCY: you! you", "I will kill you", "kill the process", "ÉIDIOT idiot x",
    "", None, "   ", "no. idiot", "du idiot|dit scum", "x" * 50_000 + " idiot " + "y " * 50_000, "not a a a a idiot", "Ämter, idiot; idiot? SCUM.",
]


def test_scores_equal_a_plain_restatement(spark):
    docs = spark.createDataFrame([(i, t, "z") for i, t in enumerate(TEXTS)], "doc_id long, text string, score string").repartition(3)
    got = {r.doc_id: r for r in toxicity.score(docs, MODEL).collect()}
    for i, text in enumerate(TEXTS):
        assert got[i].score == pytest.approx(plain_score(text)), text
        assert got[i].predicted == int(got[i].score >= 0.5) and got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
    assert got[0].score > got[1].score and got[5].score > got[6].score
    clauses = {(r.doc_id, r.clause): r.kinds for r in toxicity.matched_clauses(docs, MODEL).collect()}
    assert clauses[2, "he said you were an idiot"] == ["reported insult"] and clauses[2, "scum"] == ["insult"] and clauses[0, "you are an idiot"] == ["aimed insult"]


def corpus(copies: int = 0):
    """Documents of invented words; the toxic ones hold words that begin with one of two stems."""
    draw = random.Random(9)
    syllables = "the an re ing tion ou er st nd ha wh ly é".split()
    word = lambda: "".join(draw.choice(syllables) for _ in range(draw.randint(1, 3)))
    docs, labels = [], []
    for i in range(400):
        words, toxic = [word() for _ in range(draw.randint(10, 60))], i % 5 == 2
        if toxic:
            for _ in range(3):
                words.insert(draw.randrange(len(words)), draw.choice(["grumb", "zoltak"]) + draw.choice(["er", "st", "ly"]))
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    shared = " ".join(f"harm{word()}less" for _ in range(40))
    for i in range(copies):
        docs.append((1_000 + i, f"{shared} {word()}"))
        labels.append((1_000 + i, 1))
    return docs, labels


def test_learns_word_beginnings_and_not_the_words_of_copies(spark):
    docs, labels = corpus(copies=120)
    given, known = spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit_table(given, known)
    assert {s[:3] for s in model.insults} == {b"gru", b"zol"}
    scores = {r.doc_id: r for r in toxicity.score(given, model).collect()}
    assert all(scores[i].predicted == toxic for i, toxic in labels if i < 1_000 and scores[i].held_out)


def test_labels_of_the_held_out_fifth_are_not_read(spark):
    docs, labels = corpus()
    given = spark.createDataFrame(docs, "doc_id long, text string")
    turned = [(i, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, t in labels]
    models = [toxicity.fit_table(given, spark.createDataFrame(rows, "doc_id long, toxic int")) for rows in (labels, turned)]
    assert models[0].insults == models[1].insults and np.allclose(models[0].kinds, models[1].kinds) and models[0].bias == pytest.approx(models[1].bias)


def test_odd_rows(spark, odd_docs, odd_rows, no_docs):
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (3, None), (4, 7)], "doc_id long, toxic int")
    model = toxicity.fit_table(odd_docs, labels)
    assert not model.insults
    assert pairs(toxicity.score(odd_docs, model), "doc_id") == ordered((i,) for i, _ in odd_rows)
    assert toxicity.score(no_docs, toxicity.fit_table(no_docs, labels.limit(0))).collect() == []
    assert toxicity.matched_clauses(odd_docs, model).collect() == []


def test_held_out_documents_of_the_table(spark):
    docs, labels = (table(spark, "/root/testdata/sf0.1", n) for n in ("documents", "labels"))
    found = toxicity.score(docs, toxicity.fit_table(docs, labels)).join(labels, "doc_id").where("held_out").select("toxic", "predicted").collect()
    toxic = [r for r in found if r.toxic]
    assert sum(r.predicted for r in toxic) / len(toxic) > 0.85
    assert sum(r.predicted for r in found if not r.toxic) / (len(found) - len(toxic)) < 0.01
