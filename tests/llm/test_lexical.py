from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from millrace.llm import lexical
from millrace.llm.lexical import best_documents, search_ranked, terms


def slow_terms(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def slow_search(docs, items, k):
    """(item place, rank, id, score) by the formula alone."""
    found = [(own, Counter(slow_terms(text))) for own, text in docs]
    found = [(own, counts) for own, counts in found if counts]
    n_docs, n_terms = len(found), sum(sum(c.values()) for _, c in found)
    df = Counter(t for _, c in found for t in c)
    out = []
    for at, (_, text) in enumerate(items):
        hits = []
        for own, counts in found:
            m = 100 - 25 + 25 * sum(counts.values()) * n_docs // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * counts[t] // (1000 * counts[t] + 12 * m))
                for t in slow_terms(text) if counts[t])
            if score > 0:
                hits.append((-score, own is None, own or 0))
        out += [(at, rank, None if none else own, -score) for rank, (score, none, own) in enumerate(sorted(hits)[:k], 1)]
    return out


def test_terms():
    draw = random.Random(3)
    for _ in range(300):
        text = "".join(draw.choice("aZ09É߀\x7f\x80_-{@[`/:\x00 \n　\U0001f600") for _ in range(draw.randint(0, 40)))
        assert [t.decode() for t in terms(text.encode())] == slow_terms(text)
    assert terms(None) == [] and len(terms(b"ab " * 500_000)) == 500_000


@pytest.mark.parametrize("seed", range(30))
def test_skipping_loses_no_document(seed):
    draw = np.random.default_rng(seed)
    n_docs, k, block = int(draw.integers(1, 400)), int(draw.integers(1, 25)), int(draw.choice([1, 7, 64]))
    lists, total = [], np.zeros(n_docs, np.int64)
    for _ in range(draw.integers(0, 12)):
        docs = np.sort(draw.choice(n_docs, draw.integers(1, n_docs + 1), replace=False))
        values = draw.integers(1, draw.choice([3, 1000]), len(docs))
        total[docs] += values
        lists.append((docs, values, None))
    least = int(draw.choice([1, 500]))
    short = float(draw.choice([0.0, 0.3, 2.0]))
    places, scores = best_documents(lists, n_docs, k, least, block, short)
    assert len(set(places.tolist())) == len(places) and (total[places] == scores).all()
    order = sorted(np.flatnonzero(total >= least).tolist(), key=lambda d: (-total[d], d))[:k]
    assert set(order) <= set(places.tolist())


@pytest.mark.parametrize(("shard_docs", "search_postings", "item_bytes"), [(20_000, 4_000_000, 4_000_000), (7, 50, 60)])
def test_search_equals_brute_force(spark, monkeypatch, shard_docs, search_postings, item_bytes):
    monkeypatch.setattr(lexical, "SHARD_DOCS", shard_docs)
    monkeypatch.setattr(lexical, "SEARCH_POSTINGS", search_postings)
    draw = random.Random(5)
    words = ["the", "The", "de", "ñez", "x1", "rare", "Ünit", "kopf"] + [f"w{i}" for i in range(60)]

    def text(n):
        return "".join(draw.choice(words[:draw.choice([3, 8, 68])]) + draw.choice([" ", ", ", "\n", "--"]) for _ in range(n))

    docs = [(i * 3, text(draw.randint(0, 80))) for i in range(160)]
    docs += [(1, docs[4][1]), (2, docs[4][1]), (2, docs[4][1]), (None, docs[4][1]), (None, "the rare"), (600, None), (601, ""), (602, "?!"),
             (700, "the " * 30_000 + "rare")]
    draw.shuffle(docs)
    items = [(i, text(draw.randint(1, 20))) for i in range(12)] + [(3, "rare rare kopf"), (None, "x1"), (50, None), (51, "..."), (52, "absent")]
    frame = spark.createDataFrame([(a, t, "z", 0, 1) for a, t in docs], "doc_id long, text string, item string, id int, score int").repartition(5)
    asked = spark.createDataFrame([(a, t, 0) for a, t in items], "item_id long, text string, doc_id int")
    got = search_ranked(frame, asked, item_bytes=item_bytes).collect()
    want = [(items[at][0], *rest) for at, *rest in slow_search(docs, items, 20)]
    assert Counter(tuple(r) for r in got) == Counter(want)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b"), (2, "a")], "doc_id long, text string")
    assert search_ranked(none, items).collect() == []
    assert search_ranked(some, items.limit(0)).collect() == []
    assert search_ranked(spark.createDataFrame([(1, None)], "doc_id long, text string"), items).collect() == []
    assert sorted((r.rank, r.doc_id) for r in search_ranked(some, items).collect()) == [(1, 1), (2, 2)]
