from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from millrace.llm.packing import load_encoder, pack_documents, pack_lengths, step_groups

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def tokenizer():
    found = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found.encode_special_tokens = True
    return found


def test_the_encoder_gives_the_tokenizers_ids(tokenizer):
    encoder = load_encoder(RANKS, PATTERN)
    draw = random.Random(1)
    alphabet = "aé ß\n\t\r  　漢字🙂👩‍👩‍👧٣½'sdll,.!<|endoftext|>​\x00"
    for _ in range(400):
        text = "".join(draw.choice(alphabet) for _ in range(draw.randint(0, 40)))
        assert encoder.encode_ordinary(text) == tokenizer.encode(text, add_special_tokens=False).ids


def test_white_space_of_any_length(spark, tokenizer):
    encoder = load_encoder(RANKS, PATTERN)
    for n in (99_999, 100_000, 100_001):
        for space in (" ", "\n", "\u3000 \t"):
            run = (space * n)[:n]
            for text in (run, f"a b{run}", f"{run}c", f"a{run}'s d {run}\x1c{run}.e"):
                assert encoder.encode_ordinary(text) == tokenizer.encode(text, add_special_tokens=False).ids
    text = "a" + "\n" * 1_200_000 + "b"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    whole = len(tokenizer.encode(text, add_special_tokens=False).ids) + 1
    assert {r.doc_tokens for r in pack_documents(docs, RANKS, PATTERN, cells=2).collect()} == {whole}


def test_every_piece_lies_in_one_window_without_gaps():
    draw = random.Random(2)
    for n in (0, 1, 5, 500):
        lengths = np.array([draw.choice([1, 256, 512, 1024, 2048, draw.randint(1, 2048)]) for _ in range(n)], np.int64)
        found = pack_lengths(lengths)
        assert sorted(i for _, window in found for i in window) == list(range(n))
        for context, window in found:
            used = lengths[window].sum()
            assert used <= context and (context == 2048 or used == context)


def test_little_padding_and_even_steps():
    draw = random.Random(4)
    lengths = np.array([min(2048, int(draw.expovariate(1 / 600)) + 1) for _ in range(5000)])
    found = pack_lengths(lengths)
    padding = sum(c - lengths[w].sum() for c, w in found)
    assert padding < 0.01 * lengths.sum()
    groups = step_groups([int(lengths[w].sum()) for _, w in found], 64 * 2048)
    loads = np.bincount(groups, [lengths[w].sum() for _, w in found])
    assert loads.max() - loads.min() <= 2048


def test_documents_come_back_whole(spark, tokenizer):
    texts = [None, "", "short", "long " * 5000, "<|endoftext|>", "same", "same"]
    rows = [(i if i < 6 else 5, t, i) for i, t in enumerate(texts)] + [(None, "no id", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length int")
    found = pack_documents(docs, RANKS, PATTERN, keep_ids=True, cells=2).collect()
    whole = [tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for _, t, _ in rows]
    pieces = {}
    for r in found:
        assert len(r.ids) == r.length and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
        pieces.setdefault(r.doc_id, []).append((r.start, list(r.ids), r.doc_tokens))
    for (doc_id, _, _), ids in zip(rows, whole, strict=True):
        if doc_id == 5:
            assert sorted(p[1] for p in pieces[5]) == [ids, ids]
        else:
            own = sorted(pieces[doc_id])
            assert sum((p[1] for p in own), []) == ids and all(p[2] == len(ids) for p in own)
    for sequence in {r.sequence_id for r in found}:
        own = sorted((r.offset, r.length) for r in found if r.sequence_id == sequence)
        assert [o for o, _ in own] == list(np.cumsum([0, *[n for _, n in own]])[:-1])


def test_no_documents(spark):
    assert pack_documents(spark.createDataFrame([], "doc_id long, text string"), RANKS, PATTERN).collect() == []
