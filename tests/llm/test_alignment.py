from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict
from functools import reduce

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from millrace.llm.alignment import Fragment, Open, align_documents, chunk_fragments, load_tokenizers, token_groups

FILES = (public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, public_tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def own():
    return load_tokenizers(*FILES)


def byte_table():
    """The byte behind each character of a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}


def slow_document(text):
    """((start, end, id) of A, the same of B) from the JSON form and the pieces, or None."""
    import sentencepiece

    if not text:
        return None
    json_form = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    json_form.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=FILES[2])
    table = byte_table()
    sides = []
    a = [(i, bytes(table[c] for c in json_form.id_to_token(i))) for i in json_form.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in model.encode(text):
        piece = model.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()))
    for tokens in (a, b):
        if b"".join(t for _, t in tokens) != b" " + text.encode():
            return None
        at, spans = 0, []
        for i, t in tokens:
            spans.append((at, at + len(t), i))
            at += len(t)
        sides.append(spans)
    return sides


def slow_groups(sides):
    ends = sorted({e for _, e, _ in sides[0]} & {e for _, e, _ in sides[1]})
    out, start = [], 0
    for end in ends:
        out.append((start, end, *([i for s, _, i in side if start <= s < end] for side in sides)))
        start = end
    return out


def slow_links(sides):
    return [(a, b) for sa, ea, a in sides[0] for sb, eb, b in sides[1] if sa < eb and sb < ea]


def slow_align(docs):
    found = [slow_document(text) for _, text in docs]
    links = [slow_links(f) if f else [] for f in found]
    count = Counter(pair for own in links for pair in set(own))
    most = defaultdict(int)
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    rows = []
    for (doc_id, _), sides, own in zip(docs, found, links, strict=True):
        groups = slow_groups(sides) if sides else []
        spelled = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for _, _, a, b in groups)
        rows.append((
            doc_id, *((len(sides[0]), len(sides[1])) if sides else (0, 0)), len(groups), len(own),
            sum(count[p] == most[p[0]] for p in own), sum(count[p] for p in own),
            hashlib.sha256(spelled.encode()).hexdigest() if sides else ""))
    return rows


def texts(draw, n):
    words = ["the", "Zürich", "naïve", "antidisestablishment", "東京都庁", "don't", "x1y22", "<s>", "<|endoftext|>", "<0x41>", "­", "🙂🙂", "é"]
    gaps = [" ", "  ", "\n", " \t", "", ". ", " ", "　", "\r\n", "\x00"]
    return ["".join(draw.choice(words) + draw.choice(gaps[:draw.choice([1, 4, 10])]) for _ in range(draw.randint(1, 60))) for _ in range(n)]


def test_blocks_are_tokenized_as_the_whole(own):
    draw = random.Random(2)
    assert own.may_cut
    for text in texts(draw, 60):
        blocks = own.blocks(text, 20)
        assert " ".join(blocks) == text
        whole, parts = own.encode(text), [own.encode(b) for b in blocks]
        assert whole == ([i for p in parts for i in p[0]], [i for p in parts for i in p[1]])


@pytest.mark.parametrize("seed", range(12))
def test_fragments_compose_in_any_tree(own, seed):
    draw = random.Random(seed)
    text = texts(draw, 1)[0]
    a, b = (np.array(x, np.int32) for x in own.encode(text))
    chunk = draw.choice([1, 2, 5, 17, 1000])
    parts = chunk_fragments(0, a, own.a_len[a], b, own.b_len[b], chunk)
    left = reduce(Fragment.then, parts)
    tree = list(parts)
    while len(tree) > 1:
        at = draw.randrange(len(tree) - 1)
        tree[at:at + 2] = [tree[at].then(tree[at + 1])]

    def flat(runs):
        joined = reduce(Open.__add__, [r for _, r in runs])
        return joined.a.tolist(), joined.b.tolist()

    groups = slow_groups(slow_document(text))
    for whole in (left, tree[0]):
        runs = whole.finish()
        assert flat(runs) == (a.tolist(), b.tolist())
        # every run begins and ends at a boundary
        starts = {0, *(g[1] for g in groups)}
        assert all(at in starts for at, _ in runs) and [at for at, _ in runs] == sorted(at for at, _ in runs)


def documents(draw):
    docs = list(enumerate(texts(draw, 40)))
    docs += [(100, None), (101, ""), (102, "has ▁ mark"), (103, " lead"), (104, " "), (105, "trail "), (None, docs[0][1]), (7, docs[0][1]), (7, "the the")]
    docs += [(200, " ".join(texts(draw, 6))), (201, "ab" * 400), (202, "a b" * 150 + " ▁ c" + " d e" * 100), (203, "the cat " * 100)]
    return docs


@pytest.mark.parametrize(("long", "chunk", "fan", "slice_pairs"), [(1 << 16, 1 << 14, 32, 2_000_000), (150, 40, 2, 100)])
def test_alignment_equals_brute_force(spark, long, chunk, fan, slice_pairs):
    docs = documents(random.Random(4))
    frame = spark.createDataFrame([(i, t, 0, "z") for i, t in docs], "doc_id long, text string, row int, pairs string").repartition(3)
    got = align_documents(frame, *FILES, long=long, chunk=chunk, fan=fan, slice_pairs=slice_pairs)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert Counter(tuple(r) for r in got.collect()) == Counter(slow_align(docs))


@pytest.mark.parametrize("long", [1 << 16, 100])
def test_groups_are_given_whole(spark, long):
    docs = [(i, t) for i, t in documents(random.Random(6)) if i is not None and i != 7]
    got = token_groups(spark.createDataFrame(docs, "doc_id long, text string"), *FILES, long=long, chunk=30, fan=3)
    want = Counter((i, s, e, tuple(a), tuple(b)) for i, t in docs if (sides := slow_document(t)) for s, e, a, b in slow_groups(sides))
    assert Counter((r.doc_id, r.start, r.end, tuple(r.a_ids), tuple(r.b_ids)) for r in got.collect()) == want


def test_very_long_and_empty(spark, own):
    long = "word " * 60_000 + "x" * 300_000 + " " * 120_000
    docs = spark.createDataFrame([(1, long), (2, "word word")], "doc_id long, text string")
    one, two = sorted(align_documents(docs, *FILES).collect())
    a, b = own.encode(long)
    assert (one.n_a, one.n_b) == (len(a), len(b)) and one.groups_sha256 and two.n_a == 2
    assert align_documents(docs.limit(0), *FILES).collect() == []
    none = align_documents(docs.select("doc_id", docs.text.substr(1, 0).alias("text")), *FILES).collect()
    assert sorted(tuple(r) for r in none) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]
