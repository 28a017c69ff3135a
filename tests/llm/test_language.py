from __future__ import annotations

import math
import random
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import regex

from millrace.llm.language import (
    Model, Scorer, count_grams, fit_models, gram_hashes, grams, identify_languages, words, WORD_LETTERS, _load, _points)

SYLLABLES = {"aa": ["ka", "mo", "ri", "tu"], "bb": ["schl", "ung", "eit", "öd"], "cc": ["ξα", "ωμ", "ρι", "το"]}


def text(draw, lang, n):
    return "".join(
        "".join(draw.choice(SYLLABLES[lang]) for _ in range(draw.randint(1, 4))) + draw.choice([" ", ". ", ", ", "\n"]) for _ in range(n))


def all_grams(word, order):
    whole = f" {word} "
    return [whole[end - n:end] for end in range(2, len(whole) + 1) for n in range(1, min(order, end) + 1)]


def slow_model(corpus, order, n_chars, share=0.0):
    """p(c | h) of the interpolated model over words, by its formula."""
    raw = Counter(g for t in corpus for w in words(t) for g in all_grams(w, order))
    total = sum(n for g, n in raw.items() if len(g) == 1)
    before = defaultdict(set)
    for g in raw:
        if len(g) > 1:
            before[g[1:]].add(g[0])
    a = {g: n if len(g) == order or (len(g) > 1 and g[0] == " ") else len(before[g]) for g, n in raw.items()}
    discount = {}
    for n in range(1, order + 1):
        once, twice = (sum(1 for g, x in a.items() if len(g) == n and x == k) for k in (1, 2))
        discount[n] = min(0.95, once / (once + 2 * twice)) if once else 0.5
    kept = {g for g, n in raw.items() if n >= share * total}
    whole, rest = defaultdict(float), {}
    for g, x in a.items():
        whole[g[:-1]] += x
    for h, x in whole.items():
        rest[h] = max(1e-12, 1 - sum(max(a[g] - discount[len(g)], 0) for g in kept if g[:-1] == h) / x)

    def p(history, c):
        if len(history) + 1 > order:
            return p(history[1:], c)
        shorter = (lambda: p(history[1:], c)) if history else (lambda: 1 / (n_chars + 1))
        known = rest.get(history, 1.0) if not history or history in kept or history == " " else 1.0
        first = max(a[history + c] - discount[len(history) + 1], 0) / whole[history] if history + c in kept else 0.0
        return first + known * shorter()

    return p


def test_words_and_grams():
    assert words("Été, l'ŒUVRE x1y 東京! १२") == ["été", "l", "œuvre", "x", "y", "東京"]
    long = "ab" * 100
    assert "".join(words(long)) == long and max(map(len, words(long))) == WORD_LETTERS
    assert grams("ab", 3) == [" a", " ab", "ab "]
    assert sorted(g[k:] for g in grams("abcd", 3) for k in range(len(g))) == sorted(all_grams("abcd", 3))
    assert words("") == [] and words("12 ½ ́ !") == []


def test_hashes_depend_on_the_gram_alone():
    draw = random.Random(1)
    seen = {}
    for _ in range(200):
        line = "".join(draw.choice("ab é") for _ in range(draw.randint(1, 12)))
        for n, found in enumerate(gram_hashes(_points(line), 5), 1):
            for end in range(n, len(line) + 1):
                assert seen.setdefault((line[end - n:end]), found[end - 1]) == found[end - 1]
    assert len(set(seen.values())) == len(seen)


@pytest.mark.parametrize(("order", "share"), [(1, 0.0), (3, 0.0), (5, 0.0), (4, 0.01)])
def test_models_equal_the_formula(spark, order, share):
    draw = random.Random(order)
    corpus = {lang: [text(draw, lang, 25) for _ in range(6)] for lang in ("aa", "bb")}
    frame = spark.createDataFrame([(lang, i == 0, t) for lang, ts in corpus.items() for i, t in enumerate(ts)], "lang string, part boolean, text string")
    counts = count_grams(frame.repartition(3), order)
    assert {r.lang: r.n for r in counts.where("gram = ' '").collect()} == {k: 150 for k in corpus}
    assert {r.lang: r.n_rest for r in counts.where("gram = ' '").collect()} == {k: 125 for k in corpus}
    models, n_chars = fit_models(counts.select("lang", "gram", "n"), order, share)
    assert n_chars == len({c for ts in corpus.values() for t in ts for w in words(t) for c in w + " "})
    loaded = _load(models, ["aa", "bb"], n_chars, order)
    probes = ["ka", "kamo", "schlung", "xyz", "ödka", "ééé", "t"]
    got = Scorer(loaded, order).score_words(probes)
    for k, lang in enumerate(("aa", "bb")):
        p = slow_model(corpus[lang], order, n_chars, share)
        for word, found in zip(probes, got[:, k], strict=True):
            whole = f" {word} "
            want = sum(math.log(p(whole[max(0, i - order + 1):i], whole[i])) for i in range(1, len(whole)))
            assert found == pytest.approx(want, abs=1e-4), (lang, word)


def test_probabilities_sum_to_one():
    corpus = ["kamo riri tuka moka ka", "mori tutu kari"]
    chars = sorted({c for t in corpus for c in t})
    p = slow_model(corpus, 4, len(chars), 0.02)
    for history in ("", "k", " ", " k", "ka", " ka", "zz"):
        assert sum(p(history, c) for c in [*chars, "?"]) == pytest.approx(1.0)


def held(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


@pytest.mark.parametrize("block_grams", [4_000_000, 10])
def test_languages_are_told_and_rows_stay(spark, block_grams):
    draw = random.Random(8)
    rows = [(i, text(draw, lang, draw.choice([3, 30, 200])), lang) for i, lang in enumerate(["aa", "bb", "cc"] * 60)]
    odd = [(500, None, "aa"), (501, "", "bb"), (502, "123 !", "cc"), (503, text(draw, "aa", 20), None), (None, text(draw, "bb", 20), "zz"),
           (504, text(draw, "cc", 20), "aa"), (504, text(draw, "cc", 20), None), (505, "ka" * 100_000, None), (506, "qqqq xxxx " * 30, None)]
    frame = spark.createDataFrame([(*r, "x", 1.0) for r in rows + odd], "doc_id long, text string, lang string, part string, score double")
    got = identify_languages(frame.repartition(4), block_grams=block_grams)
    assert got.columns[:4] == ["doc_id", "held_out", "lang_pred", "score"]
    found = got.collect()
    assert Counter(r.doc_id for r in found) == Counter(r[0] for r in rows + odd)
    by_id = {r.doc_id: r for r in found}
    assert all(r.held_out == (r.doc_id is not None and held(r.doc_id)) and 0 <= r.score <= 1 for r in found)
    assert all(by_id[i].lang_pred == lang for i, _, lang in rows)
    assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0 and by_id[i].rejected for i in (500, 501, 502))
    assert by_id[503].lang_pred == "aa" and by_id[505].lang_pred == "aa" and by_id[None].lang_pred == "bb" and by_id[504].lang_pred == "cc"
    assert by_id[506].rejected and by_id[506].score < 0.5  # letters of no language
    assert not any(r.lang_pred == "zz" for r in found)  # a null id teaches nothing


def test_labels_are_no_input(spark):
    draw = random.Random(9)
    rows = [(i, text(draw, lang, 20), lang) for i, lang in enumerate(["aa", "bb"] * 40)]
    changed = [(i, t, "bb" if held(i) else lang) for i, t, lang in rows]
    schema = "doc_id long, text string, lang string"
    first, second = (sorted(map(tuple, identify_languages(spark.createDataFrame(r, schema)).collect())) for r in (rows, changed))
    assert first == second


def test_without_rows_or_labels(spark):
    schema = "doc_id long, text string, lang string"
    assert identify_languages(spark.createDataFrame([], schema)).collect() == []
    none = identify_languages(spark.createDataFrame([(1, "abc", None), (2, None, "aa")], schema)).collect()
    assert sorted((r.doc_id, r.lang_pred, r.score) for r in none) == [(1, "und", 0.0), (2, "und", 0.0)]
    one = identify_languages(spark.createDataFrame([(i, "kamo", "aa") for i in range(9)], schema)).collect()
    assert {r.lang_pred for r in one} == {"aa"}


def test_a_model_without_grams():
    model = Model.of([], np.empty(0), np.empty(0), 9)
    assert Scorer([model]).score_words(["ab"])[0, 0] == pytest.approx(3 * math.log(1 / 10))


def test_languages_of_all_blocks_are_calibrated(spark):
    draw = random.Random(7)
    data = [(i, text(draw, lang := draw.choice(list(SYLLABLES)), draw.randint(1, 12)), lang) for i in range(400)]
    # texts of two languages, so that the temperature and the limits matter
    data += [(400 + i, f"{text(draw, 'aa', 3)} {text(draw, 'bb', 3)}", draw.choice(["aa", "bb"])) for i in range(60)]
    frame = spark.createDataFrame(data, "doc_id long, text string, lang string").repartition(4)
    one, many = ({r.doc_id: r for r in identify_languages(frame, block_grams=n, reject=0.1).collect()} for n in (4_000_000, 10))
    assert len({r.lang_pred for r in one.values()}) == 3 and any(r.rejected for r in one.values())
    for key, row in one.items():
        assert (many[key].lang_pred, many[key].rejected) == (row.lang_pred, row.rejected)
        assert many[key].score == pytest.approx(row.score, abs=1e-6)


# a word by its definition
RUN = regex.compile(r"\p{L}[\p{L}\p{M}]*+")


def slow_words(t):
    return [w[at:at + WORD_LETTERS] for w in RUN.findall(t.lower()) for at in range(0, len(w), WORD_LETTERS)]


def test_words_equal_the_definition():
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    draw = random.Random(5)
    odd = ["a", "é", "Σ", "İ", "ß", "\u0301", "क", "ि", "ำ", "𐐀", "𝒜", "\U000e0100", "²", "Ⅷ", "_", "1", " ", "\u2028", "\n", "-", "東", "\0"]
    found = ["".join(every), " ".join(every), "a" + "\u0301" * 100, "\u0301" * 3 + "a b", *("x" * n + " y" for n in (47, 48, 49, 96, 97))]
    found += ["".join(draw.choice(odd) for _ in range(draw.choice([1, 5, 300]))) for _ in range(300)]
    for t in found:
        assert words(t) == slow_words(t)


def test_entropies_of_texts_read_together():
    draw = random.Random(6)
    found = ["ka", " a", "mo", "o ", "schl", "ung", "ung "]
    model = Model.of(found, -np.arange(1.0, 8), -np.arange(1.0, 8) / 9, 30)
    texts = [None, "", "12", text(draw, "aa", 9), text(draw, "bb", 40), "x" * 100, "-", text(draw, "aa", 1), "कि ka\u0301", None]
    chars, together = Scorer([model, model]).entropies(texts)
    assert chars.tolist() == [sum(len(w) + 1 for w in slow_words(t or "")) for t in texts]
    for t, n, h in zip(texts, chars.tolist(), together, strict=True):
        want = -sum(float(Scorer([model]).score_words([w])[0, 0]) for w in slow_words(t or "")) / max(n, 1)
        assert h.tolist() == pytest.approx([want, want])


def test_words_are_read_in_bulk():
    """Reading words takes less than half the time of one match of a pattern for each."""
    draw = random.Random(7)
    long = text(draw, "bb", 100_000)
    assert words(long) == slow_words(long)
    took = {}
    for read in (slow_words, words) * 3:
        start = time.process_time()
        read(long)
        took[read] = min(took.get(read, math.inf), time.process_time() - start)
    assert took[words] < took[slow_words] / 2, took
