from __future__ import annotations

import random
import re

import numpy as np
import pytest
from xxhash import xxh64_intdigest

from millrace.llm.components import connected_components
from millrace.llm.simhash import fingerprint, fingerprint_links, simhash_groups


def slow_fingerprint(text, k=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(nodes, linked):
    label = {n: n for n in nodes}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x
    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                x, y = root(a), root(b)
                label[max(x, y)] = min(x, y)
    return {n: root(n) for n in nodes}


def test_fingerprints():
    draw = random.Random(1)
    for _ in range(200):
        text = "".join(draw.choice("aAÉß \t\x0b\n b") for _ in range(draw.randint(0, 60)))
        assert fingerprint(text.encode()) == slow_fingerprint(text)
    long = "w " * 200_000
    assert fingerprint(long.encode()) == slow_fingerprint("w w w w")


@pytest.mark.parametrize(("bucket", "max_bits"), [(1024, 2), (4, 2), (2, 1), (3, 3)])
def test_links_join_what_brute_force_joins(spark, bucket, max_bits):
    draw = random.Random(bucket)
    values = {0, 2**64 - 1}
    for _ in range(4):  # clusters of near values, dense and chained
        centre = draw.getrandbits(64)
        for _ in range(40):
            values.add(centre ^ sum(1 << b for b in draw.sample(range(64), draw.randint(0, 2))))
            if draw.random() < 0.3:
                centre ^= 1 << draw.randrange(64)
    values |= {draw.getrandbits(64) for _ in range(60)}
    signed = {v: int(np.array([v], np.uint64).view(np.int64)[0]) for v in values}
    df = spark.createDataFrame([(s,) for s in signed.values()], "fingerprint long")
    links = fingerprint_links(df, max_bits, bucket)
    unsigned = {s: v for v, s in signed.items()}
    for r in links.collect():
        assert (unsigned[r.a] ^ unsigned[r.b]).bit_count() <= max_bits
    found = {r.node: r.root for r in connected_components(links).collect()}
    want = components(sorted(signed.values()), lambda a, b: (unsigned[a] ^ unsigned[b]).bit_count() <= max_bits)
    groups = lambda label: sorted(sorted(n for n in signed.values() if label(n) == r) for r in {label(n) for n in signed.values()})
    assert groups(lambda n: found.get(n, n)) == groups(want.get)


def test_components_of_long_chains_and_stars(spark):
    draw = random.Random(9)
    nodes = draw.sample(range(10**6), 300)
    edges = list(zip(nodes[:100], nodes[1:100])) + [(nodes[100], n) for n in nodes[101:200]] + [(nodes[200], nodes[200]), (nodes[201], nodes[202])] * 2
    found = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert len({found[n] for n in nodes[:100]}) == 1 and len({found[n] for n in nodes[100:200]}) == 1
    assert found[nodes[201]] == found[nodes[202]] and nodes[200] not in found and len(set(found.values())) == 3
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_groups_of_documents(spark):
    rows = [(5, "a b c d e"), (3, "A  B\tC d e"), (9, None), (8, " \n"), (None, "a b c d e"), (4, "other words here entirely"), (4, "x y")]
    df = spark.createDataFrame([(i, t, "f", 1) for i, t in rows], "doc_id long, text string, fingerprint string, root int")
    found = [(r.doc_id, r.fingerprint, r.component_id) for r in simhash_groups(df).collect()]
    assert len(found) == len(rows)
    of = lambda i: [c for d, _, c in found if d == i]
    assert of(5) == of(3) == of(None) == [3] and of(9) == of(8) == [8]
    assert {f for d, f, _ in found if d in (8, 9)} == {"0" * 16}
    assert simhash_groups(df.limit(0)).collect() == []
