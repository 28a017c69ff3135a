from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

import millrace.llm.suffix_dedup as module
from millrace.llm.collection_bwt import build, places_by_length
from millrace.llm.suffix_dedup import SPAN, _anchors_of, remove_repeats, removed_spans

SCHEMA = "doc_id long, text string, lang string, spans int, row string, id string"


def brute(rows):
    """Kept bytes and spans, by the definition."""
    order = [i if i is not None else float("inf") for i, _ in rows]
    texts = [(t or "").encode() for _, t in rows]
    first = {}
    for i, text in zip(order, texts, strict=True):
        for k in range(len(text) - SPAN + 1):
            w = text[k:k + SPAN]
            first[w] = min(first.get(w, i), i)
    out = []
    for i, text in zip(order, texts, strict=True):
        gone = np.zeros(len(text), bool)
        for k in range(len(text) - SPAN + 1):
            if first[text[k:k + SPAN]] < i:
                gone[k:k + SPAN] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(int), [0]])))
        out.append((bytes(np.frombuffer(text, np.uint8)[~gone]), [(int(a), int(b)) for a, b in zip(edges[::2], edges[1::2], strict=True)]))
    return out


def check(spark, rows):
    df = spark.createDataFrame([(i, t, "l", 1, "r", "i") for i, t in rows], SCHEMA)
    found = remove_repeats(df, keep=("lang",)).collect()
    got = sorted(((r.doc_id, r.n_bytes, bytes(r.kept), [tuple(s) for s in r.spans], r.lang) for r in found), key=repr)
    want = sorted(((i, len((t or "").encode()), kept, spans, "l") for (i, t), (kept, spans) in zip(rows, brute(rows), strict=True)), key=repr)
    assert got == want


def passages(draw):
    return ["".join(draw.choice("abcdeé \n") for _ in range(draw.randint(40, 200))) for _ in range(6)]


def test_shared_passages(spark):
    draw = random.Random(1)
    shared = passages(draw)
    rows = []
    for i in range(60):
        parts = []
        for _ in range(draw.randint(0, 5)):
            parts.append(draw.choice(shared) if draw.random() < 0.5 else "".join(draw.choice("fghij ") for _ in range(draw.randint(0, 80))))
        rows.append((i, "".join(parts)))
    check(spark, rows)


def test_near_copies_and_exact_lengths(spark):
    draw = random.Random(2)
    base = "".join(draw.choice("abcdefgh ") for _ in range(400))
    rows = [(i, base[:k] + "X" + base[k + 1:]) for i, k in enumerate(range(0, 400, 23))]
    rows += [(50, base[:50]), (51, base[:49]), (52, base[100:150] + "#"), (53, "!" + base[100:150])]
    check(spark, rows)


def test_odd_rows(spark):
    run = "a" * 130
    check(spark, [(1, None), (2, ""), (3, run), (4, run), (4, run), (5, "ab" * 40), (None, run), (None, run + "z"), (6, "ba" * 40)])
    check(spark, [])


def test_text_output(spark):
    text = "é" * 60
    df = spark.createDataFrame([(1, text), (2, "x" + text[:30] + " ü"), (3, "y" + text[:30] + "ü")], "doc_id long, text string")
    kept = {r.doc_id: r.kept for r in remove_repeats(df, as_text=True).collect()}
    assert kept[1] == text and kept[2] == "x ü"
    assert kept[3] == "y"  # the first byte of the last letter is that of the repeated one, and alone it is no letter


def test_blocks_of_long_texts_give_the_same_anchors(monkeypatch):
    draw = random.Random(3)
    texts = ["".join(draw.choice("abc ") for _ in range(n)).encode() for n in (10, 3000, 49, 0, 5000, 50, 900)] + [b"q" * 700]
    whole = sorted(zip(*(a.tolist() for a in map(np.concatenate, zip(*_anchors_of(texts), strict=True))), strict=True))
    monkeypatch.setattr(module, "_BLOCK", 300)
    cut = sorted(zip(*(a.tolist() for a in map(np.concatenate, zip(*_anchors_of(texts), strict=True))), strict=True))
    assert cut == whole


def test_slices_keep_all_rows_in_order(monkeypatch):
    monkeypatch.setattr(module, "_SLICE", 100)
    texts = [b"a" * n for n in (0, 30, 80, 500, 0, 99, 1, 1, 400, 0)]
    batches = [pa.RecordBatch.from_arrays([pa.array(t, pa.binary())], names=["text"]) for t in (texts, [], texts[3:])]
    found = [b.column("text").to_pylist() for b in module._slices(iter(batches))]
    assert sum(found, []) == texts + texts[3:] and len(found) > 6
    assert all(sum(map(len, f[:-1])) < 100 for f in found)


def test_spans_stay_inside_the_text():
    assert removed_spans(60, np.array([0]), np.array([2 ** 35 - 1], np.uint64)).tolist() == [[0, 50]]
    assert removed_spans(60, np.array([40]), np.array([0], np.uint64)).tolist() == []


def test_transform_and_common_prefixes_against_sorting():
    draw = np.random.default_rng(0)
    for _ in range(40):
        n, width, letters, cap = draw.integers(1, 10), draw.integers(1, 25), draw.integers(1, 4), int(draw.integers(1, 30))
        lengths = draw.integers(1, width + 1, n)
        base = draw.integers(0, letters, width)
        rows, strings = np.zeros((n, width), np.uint8), []
        for i in range(n):
            own = base if draw.random() < 0.6 else draw.integers(0, letters, width)
            rows[i, width - lengths[i]:] = own[width - lengths[i]:]
            strings.append(bytes(rows[i, width - lengths[i]:]))
        bwt, common = build(rows, lengths, cap)
        places = places_by_length(bwt, n, width)
        suffix = {int(places[i, t]): (i, t) for i in range(n) for t in range(lengths[i] + 1)}
        found = [strings[i][len(strings[i]) - t:] for i, t in (suffix[k] for k in range(len(bwt)))]
        assert found == sorted(found)
        for k in range(len(bwt)):
            i, t = suffix[k]
            assert bwt[k] == (0 if t == lengths[i] else strings[i][len(strings[i]) - t - 1] + 1)
            if k:
                same = 0
                while same < min(len(found[k]), len(found[k - 1])) and found[k][same] == found[k - 1][same]:
                    same += 1
                assert common[k] == min(same, cap)


def test_copies_beside_texts_that_share_only_a_phrase(spark):
    draw = random.Random(7)
    prose = lambda n: "".join(draw.choice("abcdefghij ") for _ in range(n))
    rows = []
    for k in range(40):
        phrase = prose(draw.randint(16, 49))
        first, other = prose(60) + phrase + prose(60), prose(60) + phrase + prose(60)
        rows += [(4 * k, first), (4 * k + 1, first), (4 * k + 2, other), (4 * k + 3, other[:100])]
    check(spark, rows)


def near_one_phrase(n, draw, phrase):
    """Segments round the first bytes of a phrase: texts, begin of the anchor in each, smallest ids."""
    texts, left = [], []
    tails = ["".join(draw.choice("xy") for _ in range(40)) for _ in range(6)]
    for _ in range(n):
        before = "".join(draw.choice("ab") for _ in range(draw.choice([3, 12]))) + "abcdefghijklmnopqrst"[draw.randint(0, 19):]
        before = before[-34:]
        texts.append((before + phrase + draw.choice(tails)[:draw.choice([2, 5, 30, 40])])[:len(before) + SPAN].encode())
        left.append(len(before))
    return texts, np.array(left)


def test_a_large_group_is_split_without_losing_a_window(monkeypatch):
    draw = random.Random(11)
    for limit, phrase in ((400, "The same footer."), (3000, "The same footer of each page."), (700, "The same footer of each page of all sites")):
        monkeypatch.setattr(module, "BATCH_BYTES", limit)
        texts, left = near_one_phrase(300, draw, phrase)
        some = [i for i, t in enumerate(texts) if len(t) >= SPAN]
        texts, left = [texts[i] for i in some], left[some]
        ids = np.array(draw.sample(range(10_000), len(texts)))
        length = np.array([len(t) for t in texts])
        data = np.frombuffer(b"".join(texts), np.uint8)
        begin = np.cumsum(length) - length
        first = {}
        for i, t in zip(ids.tolist(), texts, strict=True):
            for k in range(len(t) - SPAN + 1):
                first[t[k:k + SPAN]] = min(first.get(t[k:k + SPAN], i), i)
        want = {(n, k) for n, t in enumerate(texts) for k in range(len(t) - SPAN + 1) if first[t[k:k + SPAN]] < ids[n]}
        got, sizes = set(), []
        for own, start, size, before in module._collections(data, begin, length, left, np.zeros(len(texts), np.int64)):
            sizes.append(int(size.sum()))
            for place, n in enumerate(own.tolist()):
                place = place if len(size) == len(own) else 0
                for s in range(int(start[place]), int(start[place] + size[place]) - SPAN + 1):
                    # the window as it is built, at its place in the string
                    k = int(s - start[place] + left[n] - before[place])
                    window = data[s:s + SPAN].tobytes()
                    assert window == texts[n][k:k + SPAN]
                    if min(ids[o] for o in own.tolist() if window in texts[o]) < ids[n]:
                        got.add((n, k))
        assert got == want and want
        assert len(sizes) > 1 and max(sizes) < 2 * limit + 200


def test_documents_round_one_phrase(spark, monkeypatch):
    draw = random.Random(12)
    monkeypatch.setattr(module, "BATCH_BYTES", 1000)
    monkeypatch.setattr(module, "_HELD_ANSWERS", 7)
    phrase = "All rights reserved by the authors, "
    rows = [(i, "".join(draw.choice("pq") for _ in range(draw.randint(0, 20))) + phrase + "".join(
        draw.choice("rs") for _ in range(draw.randint(0, 20)))) for i in range(400)]
    check(spark, rows)


def test_later_rows_of_equal_segments():
    segment = np.array([5, 5, 7, 5, 7, 9], np.uint64)
    gram = np.array([1, 1, 1, 2, 1, 1], np.uint64)
    key = np.array([4, 3, 8, 9, 8, 1])
    assert module._later(key, segment, gram).tolist() == [True, False, False, False, False, False]
    assert module._later(key[:0], segment[:0], gram[:0]).tolist() == []


def test_slots_follow_the_bytes(spark, monkeypatch):
    monkeypatch.setattr(module, "SLOT_BYTES", 500)
    draw = random.Random(13)
    shared = passages(draw)
    check(spark, [(i, draw.choice(shared) + draw.choice(shared)) for i in range(40)])


def test_spans_of_many_answers(monkeypatch):
    draw = np.random.default_rng(3)
    monkeypatch.setattr(module, "_HELD_MASKS", 7)
    for _ in range(50):
        n = int(draw.integers(50, 600))
        at = np.sort(draw.integers(0, n - 15, int(draw.integers(0, 30))))
        mask = draw.integers(0, 2**35, len(at), dtype=np.uint64) & draw.integers(0, 2**35, len(at), dtype=np.uint64)
        gone = np.zeros(n + 1, bool)
        for a, m in zip(at.tolist(), mask.tolist(), strict=True):
            for bit in range(35):
                if m >> bit & 1 and 0 <= a - 34 + bit <= n - SPAN:
                    gone[a - 34 + bit:a - 34 + bit + SPAN] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[False], gone]).astype(int))).reshape(-1, 2)
        assert removed_spans(n, at, mask).tolist() == edges.tolist()
