from __future__ import annotations

import random

import corpus_pipeline
from millrace.session import materialise

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, extra string"


def corpus(draw):
    words = ["".join(draw.choice("abcdefgh") for _ in range(draw.randint(2, 7))) for _ in range(400)]
    prose = lambda n: " ".join(draw.choice(words) for _ in range(n))
    rows, passage = [], prose(60)
    for i in range(240):
        text = prose(draw.randint(20, 120))
        if i % 6 == 0:
            text += " zorgum"
        if i % 10 == 1:
            text = passage + " " + text
        rows.append((i, text, "en", f"s{i % 3}", len(text)))
    copies = [(1000 + k, rows[7][1], "en", "s0", 1) for k in range(5)]
    return [*rows, *copies, (2000, None, None, None, None), (2001, "", None, None, 0), (None, prose(9), "en", "s1", 3)]


def test_every_stage_takes_effect(spark, tmp_path):
    rows = corpus(random.Random(1))
    table = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    spark.createDataFrame([(i, int(i % 6 == 0)) for i in range(240)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    table.write.parquet(f"{tmp_path}/documents.parquet")
    docs, seen = table, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, str(tmp_path)), name)
        seen[name] = docs.collect()
        if name != "packing":
            assert tuple(docs.columns) == corpus_pipeline.COLUMNS
    by_id = {r[0]: r[1] for r in rows}
    calm = seen["toxicity"]
    assert {r.doc_id for r in calm} == {r[0] for r in rows if r[0] is None or r[0] >= 240 or r[0] % 6}
    assert all(r.text == by_id[r.doc_id] for r in calm)
    single = [r.doc_id for r in seen["simhash_near_dedup"]]
    assert len(single) == len(set(single)) and 7 in single and not set(single) & {1000, 1001, 1002, 1003, 1004, 2001}
    cut = {r.doc_id: r for r in seen["suffix_dedup"]}
    assert set(cut) == set(single) and all(r.n_chars == len(r.text) for r in cut.values())
    with_passage = sorted(i for i in cut if i is not None and i < 240 and i % 10 == 1)
    assert cut[with_passage[0]].text == by_id[with_passage[0]]
    assert all(len(cut[i].text) < len(by_id[i]) - 300 for i in with_passage[1:])
    copies = {}
    for r in seen["mixing"]:
        copies[r.doc_id] = copies.get(r.doc_id, 0) + 1
        assert r.text == cut[r.doc_id].text
    assert max(copies.values()) <= 3
    packed = {}
    for r in seen["packing"]:
        packed[r.doc_id] = packed.get(r.doc_id, 0) + r.length
        assert r.length <= 2048
    assert set(packed) == set(copies)
    whole = corpus_pipeline.run(spark, str(tmp_path))
    key = lambda r: (repr(r.doc_id), r.start, r.length, r.ids_crc32)
    assert sorted(map(key, whole.collect())) == sorted(map(key, seen["packing"]))


def test_no_documents(spark, tmp_path):
    docs = spark.createDataFrame([], SCHEMA)
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, str(tmp_path)), name)
        assert docs.collect() == []
