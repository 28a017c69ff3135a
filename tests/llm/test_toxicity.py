from __future__ import annotations

import itertools
import random

import numpy as np

from millrace.llm.toxicity import Tagger, fit, fit_tagger, held_out, ratios, score_toxicity, toxic_spans

DOCS = "doc_id long, text string, score string, spans int, toxic int"
LABELS = "doc_id long, toxic int, id int"


def corpus(draw, n=400):
    """Clean words and, in toxic documents, inflected insults."""
    words = ["".join(draw.choice("abcdefgh") for _ in range(draw.randint(2, 8))) for _ in range(300)]
    out = []
    for i in range(n):
        text = [draw.choice(words) for _ in range(draw.randint(1, 60))]
        toxic = int(draw.random() < 0.3)
        if toxic:
            for _ in range(draw.randint(1, 3)):
                text.insert(draw.randrange(len(text) + 1), draw.choice(["zorgu", "vilka"]) + draw.choice(["m", "nta", "sch", "q"]))
        out.append((i, " ".join(text), toxic))
    return out


def test_marginals_against_all_taggings():
    draw = random.Random(1)
    step = [[1.0, 0.3], [0.5, 2.0]]
    tagger = Tagger({f"w:{c}": draw.uniform(-3, 3) for c in "abcde"}, -0.5, step)
    documents = [[draw.choice("abcdef") for _ in range(n)] for n in (0, 1, 7, 3, 7, 2)]
    for words, found in zip(documents, tagger.marginals(documents), strict=True):
        total, hits = 0.0, np.zeros(len(words))
        for tags in itertools.product((0, 1), repeat=len(words)):
            weight = np.prod([tagger.cache[w] if t else 1.0 for w, t in zip(words, tags, strict=True)])
            weight *= np.prod([step[a][b] for a, b in zip(tags, tags[1:], strict=False)])
            total += weight
            hits += weight * np.array(tags)
        if words:
            assert np.allclose(found, hits / total)
    assert ratios([np.array([2.0])], np.ones((2, 2)))[0][0] == 2.0


def test_held_out_documents_are_told_apart(spark):
    rows = corpus(random.Random(2))
    docs = spark.createDataFrame([(i, t, "s", 1, 1 - y) for i, t, y in rows], DOCS)
    labels = spark.createDataFrame([(i, y, 0) for i, _, y in rows], LABELS)
    found = score_toxicity(docs, labels).collect()
    right = sum(r.predicted == rows[r.doc_id][2] for r in found if r.held_out)
    assert right >= 0.97 * sum(r.held_out for r in found)
    for r in found:
        text = rows[r.doc_id][1]
        assert all(text[s.start:s.end].split()[0][:5] in ("zorgu", "vilka") for s in r.spans)


def test_labels_of_the_held_out_part_teach_nothing(spark):
    rows = corpus(random.Random(3), 200)
    docs = spark.createDataFrame([(i, t, "s", 1, 0) for i, t, _ in rows], DOCS)
    labels = spark.createDataFrame([(i, y, 0) for i, _, y in rows], LABELS)
    away = labels.where(~held_out(labels.doc_id))
    assert fit_tagger(docs, labels).to_json() == fit_tagger(docs, away).to_json()


def test_odd_rows(spark):
    rows = [(i, t, "s", 0, 0) for i, t in [(None, "ab"), (1, None), (1, ""), (2, "... 12"), (2, "x " * 30_000)]]
    docs = spark.createDataFrame(rows, DOCS)
    for labels in ([], [(None, 1, 0), (1, None, 0), (1, 7, 0), (9, 1, 0)], [(1, 1, 0), (1, 0, 0), (2, 0, 0)]):
        found = score_toxicity(docs, spark.createDataFrame(labels, LABELS)).collect()
        assert len(found) == 5 and all(0 <= r.score <= 1 and r.predicted == 0 for r in found)
        assert all(not r.held_out for r in found if r.doc_id is None)
    assert score_toxicity(docs.limit(0), spark.createDataFrame([], LABELS)).collect() == []


def test_spans_join_and_clean_copies_stay_clean():
    words = "one two three four five six seven eight nine ten"
    tagger = fit([("good day", 0)] * 20 + [(words, 0)] * 2 + [(words + " nasty", 1)] * 30 + [("nasty", 1), ("nasty nasty good", 1)])
    text = "Good NASTY nasty day"
    marginals, clean = tagger.marginals([text.lower().split(), words.split()])
    assert [(s["start"], s["end"]) for s in toxic_spans(text, marginals)] == [(5, 16)]
    assert clean.max() < 0.5
