from __future__ import annotations

import random

from millrace.llm.mixing import mix_sources

SCHEMA = "doc_id long, text string, source string, size string, target int"


def targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        rest = total - sum(3 * sizes[s] for s in capped)
        found = {s: 3 * sizes[s] if s in capped else rest * weight[s] / sum(weight[f] for f in free) for s in names}
        above = {s for s in free if found[s] > 3 * sizes[s]}
        if not above:
            return found
        capped |= above


def mixed(spark, rows, **options):
    df = spark.createDataFrame([(i, t, s, "x", 0) for i, t, s in rows], SCHEMA)
    return [r.asDict() for r in mix_sources(df, **options).collect()]


def documents(draw, n=900):
    out = []
    for i in range(n):
        source = draw.choice(["a", "a", "a", "b", "ç", "Z", None, "tiny"]) if i % 50 else "tiny"
        words = draw.choice([0, 1, 5, 20, 60, 400]) if source != "tiny" else 1
        out.append((i, " ".join(["w"] * words), source))
    return out


def test_sources_come_near_their_targets(spark):
    rows = documents(random.Random(5))
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(text.split())
    wanted = targets(sizes)
    assert any(abs(wanted[s] - 3 * sizes[s]) < 1e-9 for s in sizes)  # one stops at three times its size
    found = mixed(spark, rows, cell_rows=100)
    assert sorted(r["doc_id"] for r in found) == list(range(len(rows)))
    taken = {}
    for r in found:
        assert r["size"] == len(rows[r["doc_id"]][1].split()) and r["taken"] == r["copies"] * r["size"] <= 3 * r["size"]
        assert r["source_size"] == sizes[r["source"]] and abs(r["target"] - wanted[r["source"]]) < 1e-6
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    for source, target in wanted.items():
        assert abs(taken[source] - target) <= max(2, 0.01 * target), source


def test_reruns_agree(spark):
    rows = documents(random.Random(6), 300)
    key = lambda r: (r["doc_id"], r["copies"])
    assert sorted(map(key, mixed(spark, rows))) == sorted(map(key, mixed(spark, list(reversed(rows)))))


def test_odd_rows(spark):
    assert mixed(spark, []) == []
    found = mixed(spark, [(1, None, None), (1, None, None), (None, "", "a")])
    assert len(found) == 3 and all(r["taken"] == 0 and r["target"] == 0 for r in found)
    found = mixed(spark, [(1, "a b", "s")] * 4 + [(None, "a\x0bb c", "s")])
    assert len(found) == 5 and sum(r["taken"] for r in found) == 10
