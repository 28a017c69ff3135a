"""Cross-tokenizer alignment: the tokens of two tokenizers over the same bytes, by an associative monoid of fragments.

Both token sequences tile the bytes of a space and the text. Where a token of A and one of B begin together (or the text
ends) is a boundary; the tokens between two boundaries are a group. Tokens whose byte ranges overlap are linked: every
stretch between neighbouring token ends belongs to one token of each side, so these stretches are the links.

A `Fragment` is what a range of bytes knows of its document: an open prefix (tokens before its first boundary), closed
groups, and an open suffix (tokens from its last boundary on), or, without a boundary, only open tokens.
`Fragment.then` composes neighbours: the suffix of the first and the prefix of the second close to a group. It
is associative, so fragments may be composed in any tree.

1. Documents of at most `LONG` bytes are tokenized and aligned where they are read, a batch at a time.
2. Longer ones are cut into blocks where neither tokenizer can join what stands on both sides: at a space between two
   ASCII letters, given a pattern that parts words there and no piece with a space behind other characters (the
   vocabulary is asked). Blocks are spread over the tasks and tokenized; their tokens are dealt by the byte they begin at to
   chunks of `CHUNK` bytes of the document, whatever ends there, and each chunk becomes a fragment.
3. Fragments are composed `FAN` at a time, in rounds over the whole table. Closed groups are written as soon as they
   are closed and not carried on, so a round moves open ends only. At the root the ends of the document close the rest.
4. A pair's count is the number of documents that hold it linked: tasks count their short documents before the
   shuffle; pairs of long ones are made distinct by document first.
5. The counts return to the documents: the pairs, in slices of at most `SLICE`, go to all tasks, and every slice
   passes over the distinct pairs that step 1 and 3 wrote for each document.

Defined cases
  * null or empty text, or one whose tokens of a side spell other bytes (a literal U+2581): no tokens, zeros, empty hash;
  * strings of special tokens are plain text; texts without a place to cut are one block;
  * null or repeated ids: every row is a document of its own; no rows: no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.packing import load_encoder
from millrace.session import materialise

# Bytes of a document that is aligned in one go, and of the blocks that longer ones are cut into.
LONG = 1 << 16
# Bytes of a chunk, and fragments that are composed at once.
CHUNK = 1 << 14
FAN = 32
# Pairs whose counts go to the tasks at once.
SLICE = 2_000_000
# Pairs a task gathers before it adds them up.
_HELD_PAIRS = 2_000_000
# Bytes of text that are aligned at once.
_BATCH = 1 << 21
_CUT = re.compile(r"(?<=[A-Za-z]) (?=[A-Za-z])")
_FRAGMENT, _RUN, _BAD = range(3)


# ------------------------------------------------------------------ tokenizers


class Tokenizers:
    """A: byte-level pairs from a file of ranks. B: pieces with byte fallback, which puts a space before the text."""

    def __init__(self, ranks_path: str, pattern: str, pieces_path: str):
        import sentencepiece

        with open(ranks_path, "rb") as lines:
            ranks = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, lines)}
        self.a_bytes = [ranks.get(i, b"") for i in range(max(ranks) + 1)]
        self.encode_a = load_encoder(ranks_path, pattern).encode_ordinary
        model = sentencepiece.SentencePieceProcessor(model_file=pieces_path)
        self.encode_b = model.encode
        pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_size, self.b_size = len(self.a_bytes), len(self.b_bytes)
        self.a_len, self.b_len = (np.array([len(t) for t in table], np.int64) for table in (self.a_bytes, self.b_bytes))
        # a piece with a space behind other characters could join what a cut parts
        self.may_cut = not any("▁" in p.lstrip("▁") for p in pieces)

    def encode(self, text: str) -> tuple[list[int], list[int]] | None:
        """The ids of both sides, None if a side spells other bytes than a space and the text."""
        a, b = self.encode_a(" " + text), self.encode_b(text)
        whole = b" " + text.encode()
        if b"".join([self.a_bytes[i] for i in a]) != whole or b"".join([self.b_bytes[i] for i in b]) != whole:
            return None
        return a, b

    def blocks(self, text: str, size: int = LONG) -> list[str]:
        """Parts that, joined by a space, are the text, and that are tokenized alike apart and joined."""
        parts, start = [], 0
        while self.may_cut and (cut := _CUT.search(text, start + size)):
            parts.append(text[start:cut.start()])
            start = cut.end()
        return [*parts, text[start:]]


@lru_cache(maxsize=2)
def load_tokenizers(ranks_path: str, pattern: str, pieces_path: str) -> Tokenizers:
    return Tokenizers(ranks_path, pattern, pieces_path)


# ------------------------------------------------------------------ groups and links


class Alignment:
    """Token sequences that begin and end together: their links and groups, in order.

    `link_end` and `group_end` are byte offsets; `link_a` and `link_b` places of tokens.
    """

    def __init__(self, a_len: np.ndarray, b_len: np.ndarray):
        self.a_end, self.b_end = np.cumsum(a_len), np.cumsum(b_len)
        ends = np.zeros(int(self.a_end[-1]) + 1 if len(a_len) else 1, np.uint8)
        ends[self.a_end] |= 1
        ends[self.b_end] |= 2
        self.link_end = np.flatnonzero(ends)
        sides = ends[self.link_end]
        in_a, in_b = sides & 1, sides >> 1
        self.link_a, self.link_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
        self.group_end = self.link_end[sides == 3]

    def codes(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """3 * id + separator (0 comma, 1 bar, 2 semicolon) of all tokens, each group's A before its B."""
        a_group, b_group = np.searchsorted(self.group_end, self.a_end), np.searchsorted(self.group_end, self.b_end)
        a_before = np.searchsorted(self.a_end, self.group_end, side="right")  # tokens up to the end of each group
        b_before = np.searchsorted(self.b_end, self.group_end, side="right")
        out = np.empty(len(a) + len(b), np.int64)
        out[np.arange(len(a)) + np.concatenate([[0], b_before])[a_group]] = 3 * a + (self.a_end == self.group_end[a_group])
        out[np.arange(len(b)) + a_before[b_group]] = 3 * b + 2 * (self.b_end == self.group_end[b_group])
        return out


@lru_cache(maxsize=2)
def _texts_of_codes(size: int) -> list[bytes]:
    return [str(i).encode() + mark for i in range(size) for mark in (b",", b"|", b";")]


def _spell(codes: np.ndarray, size: int) -> bytes:
    """The groups as text, each ended by a semicolon."""
    return b"".join(map(_texts_of_codes(size).__getitem__, codes.tolist()))


# ------------------------------------------------------------------ fragments


_NONE = np.empty(0, np.int32)


@dataclass
class Open:
    """Ids of tokens of both sides whose group is not closed."""

    a: np.ndarray
    b: np.ndarray

    def __add__(self, other: Open) -> Open:
        return Open(np.concatenate([self.a, other.a]), np.concatenate([self.b, other.b]))

    def __bool__(self) -> bool:
        return bool(len(self.a) or len(self.b))


@dataclass
class Fragment:
    """The tokens that begin in a range of bytes from `at` on.

    With a boundary: `prefix` before the first one (`head`), `closed` runs (offset, tokens) between boundaries, and
    `suffix` from the last one (`tail`) on. Without: all tokens are `prefix`, and `head` is None.
    """

    at: int
    prefix: Open
    closed: list[tuple[int, Open]]
    head: int | None = None
    tail: int | None = None
    suffix: Open | None = None

    def then(self, other: Fragment) -> Fragment:
        """The fragment of this range and the next."""
        if self.head is None:
            return Fragment(self.at, self.prefix + other.prefix, other.closed, other.head, other.tail, other.suffix)
        if other.head is None:
            return Fragment(self.at, self.prefix, self.closed, self.head, self.tail, self.suffix + other.prefix)
        between = [(self.tail, self.suffix + other.prefix)]
        return Fragment(self.at, self.prefix, self.closed + between + other.closed, self.head, other.tail, other.suffix)

    def finish(self) -> list[tuple[int, Open]]:
        """All runs of a whole document: both its ends are boundaries."""
        ends = [(self.at, self.prefix)], [(self.tail, self.suffix)] if self.head is not None else []
        return [run for run in ends[0] + self.closed + ends[1] if run[1]]


def fragment(at: int, a: np.ndarray, a_start: np.ndarray, b: np.ndarray, b_start: np.ndarray) -> Fragment:
    """The fragment of tokens that begin at the given offsets, of a range from `at` on."""
    common = np.intersect1d(a_start, b_start, assume_unique=True)
    if not len(common):
        return Fragment(at, Open(a, b), [])
    head, tail = int(common[0]), int(common[-1])
    a_cuts, b_cuts = np.searchsorted(a_start, [head, tail]), np.searchsorted(b_start, [head, tail])
    parts = [Open(x, y) for x, y in zip(np.split(a, a_cuts), np.split(b, b_cuts), strict=True)]
    return Fragment(at, parts[0], [(head, parts[1])] if parts[1] else [], head, tail, parts[2])


def chunk_fragments(at: int, a: np.ndarray, a_len: np.ndarray, b: np.ndarray, b_len: np.ndarray, chunk: int = CHUNK) -> list[Fragment]:
    """Fragments of a block that begins at byte `at` of its document, one for each chunk of the document it meets."""
    a_start, b_start = (at + np.cumsum(x) - x for x in (a_len, b_len))
    edges = np.arange(at // chunk * chunk + chunk, int(at + a_len.sum()), chunk)
    starts = [at, *edges.tolist()]
    a_cuts, b_cuts = np.searchsorted(a_start, edges), np.searchsorted(b_start, edges)
    return [
        fragment(start, *own) for start, *own in zip(
            starts, np.split(a, a_cuts), np.split(a_start, a_cuts), np.split(b, b_cuts), np.split(b_start, b_cuts), strict=True)]


# ------------------------------------------------------------------ short documents


class _Pairs:
    """Counts of pairs, added up when many are held."""

    def __init__(self):
        self.keys, self.counts, self.size = [], [], 0

    def add(self, keys: np.ndarray, counts: np.ndarray):
        self.keys.append(keys)
        self.counts.append(counts)
        self.size += len(keys)

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.keys:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        keys, place = np.unique(np.concatenate(self.keys), return_inverse=True)
        counts = np.bincount(place, np.concatenate(self.counts), len(keys)).astype(np.int64)
        self.keys, self.counts, self.size = [keys], [counts], len(keys)
        return keys, counts


def distinct_pairs(owner: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, key, times) of each different pair of each owner, in order."""
    if not len(key):
        return owner, key, np.empty(0, np.int64)
    order = np.lexsort((key, owner))
    owner, key = owner[order], key[order]
    first = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (key[1:] != key[:-1])]))
    return owner[first], key[first], np.diff(first, append=len(key))


def _lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(counts)])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


_DIGEST = "row bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, pairs array<bigint>, times array<int>"


def _align_short(docs: DataFrame, tokenizers: tuple[str, str, str]) -> DataFrame:
    """A row for each document, and rows without `row` that hold counts of pairs of a task's documents."""
    names = [field.split()[0] for field in _DIGEST.split(", ")]

    def digest(own: Tokenizers, rows: list[int], texts: list[str | None], pairs: _Pairs) -> pa.RecordBatch:
        found = [(own.encode(t) if t else None) or ([], []) for t in texts]
        n_a, n_b = (np.array([len(f[side]) for f in found], np.int64) for side in (0, 1))
        a, b = (np.array([i for f in found for i in f[side]], np.int64) for side in (0, 1))
        a_len, b_len = own.a_len[a], own.b_len[b]
        it = Alignment(a_len, b_len)
        ends = np.cumsum(np.bincount(np.repeat(np.arange(len(texts)), n_a), a_len, len(texts))).astype(np.int64)
        codes = it.codes(a, b)
        cuts = np.cumsum(n_a + n_b)
        hashes = [
            hashlib.sha256(_spell(codes[y - n:y], max(own.a_size, own.b_size))[:-1]).hexdigest() if n else ""
            for n, y in zip((n_a + n_b).tolist(), cuts.tolist(), strict=True)]
        owner = np.searchsorted(ends, it.link_end)
        key = a[it.link_a] * own.b_size + b[it.link_b]
        n_links = np.bincount(owner, minlength=len(texts))
        n_groups = np.bincount(np.searchsorted(ends, it.group_end), minlength=len(texts))
        owner, key, times = distinct_pairs(owner, key)
        pairs.add(*np.unique(key, return_counts=True))
        sizes = np.bincount(owner, minlength=len(texts))
        return pa.RecordBatch.from_arrays([
            *(pa.array(x, pa.int64()) for x in (rows, n_a, n_b, n_groups, n_links)), pa.array(hashes, pa.string()),
            _lists(key, sizes, pa.int64()), _lists(times, sizes, pa.int32())], names=names)

    def counted(pairs: _Pairs) -> Iterator[pa.RecordBatch]:
        keys, counts = pairs.total()
        for at in range(0, len(keys), 100_000):
            part, n = keys[at:at + 100_000], counts[at:at + 100_000]
            yield pa.RecordBatch.from_arrays([
                *(pa.nulls(1, pa.int64()) for _ in range(5)), pa.nulls(1, pa.string()),
                _lists(part, [len(part)], pa.int64()), _lists(n, [len(n)], pa.int32())], names=names)
        pairs.__init__()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, pairs = load_tokenizers(*tokenizers), _Pairs()
        for batch in batches:
            rows, texts, size = [], [], 0
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows.append(row)
                texts.append(text.as_py())
                size += len(texts[-1] or "")
                if size > _BATCH:
                    yield digest(own, rows, texts, pairs)
                    rows, texts, size = [], [], 0
            if rows:
                yield digest(own, rows, texts, pairs)
            if pairs.size > _HELD_PAIRS:
                pairs.total()
                if pairs.size > _HELD_PAIRS // 2:
                    yield from counted(pairs)
        yield from counted(pairs)

    return docs.select("row", "text").mapInArrow(run, _DIGEST)


# ------------------------------------------------------------------ long documents


_PART = "row bigint, at bigint, kind int, head bigint, tail bigint, prefix_a array<int>, prefix_b array<int>, suffix_a array<int>, suffix_b array<int>"
_PART_NAMES = [field.split()[0] for field in _PART.split(", ")]


def _parts(found: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*found, strict=True)) if found else [()] * len(_PART_NAMES)
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), *[pa.list_(pa.int32())] * 4]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=_PART_NAMES)


def _run_row(row: int, run: tuple[int, Open]) -> tuple:
    return row, run[0], _RUN, None, None, run[1].a, run[1].b, None, None


def _fragment_rows(row: int, own: Fragment) -> Iterator[tuple]:
    """The fragment with its open ends, and its closed runs."""
    suffix = own.suffix or Open(None, None)
    yield row, own.at, _FRAGMENT, own.head, own.tail, own.prefix.a, own.prefix.b, suffix.a, suffix.b
    for run in own.closed:
        yield _run_row(row, run)


def _leaves(docs: DataFrame, tokenizers: tuple[str, str, str], long: int, chunk: int) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = load_tokenizers(*tokenizers)
        for batch in batches:
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                blocks = own.blocks(text.as_py(), long)
                sizes = np.array([len(b.encode()) + 1 for b in blocks], np.int64)
                for a in range(0, len(blocks), 64):
                    part = blocks[a:a + 64]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([row] * len(part), pa.int64()), pa.array((np.cumsum(sizes) - sizes)[a:a + 64]),
                        pa.array(part, pa.string())], names=["row", "at", "text"])

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = load_tokenizers(*tokenizers)
        for batch in batches:
            for row, at, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = own.encode(text)
                if found is None:
                    yield _parts([(row, at, _BAD, *[None] * 6)])
                    continue
                a, b = (np.array(ids, np.int32) for ids in found)
                yield _parts([part for f in chunk_fragments(at, a, own.a_len[a], b, own.b_len[b], chunk) for part in _fragment_rows(row, f)])

    blocks = docs.select("row", "text").mapInArrow(cut, "row bigint, at bigint, text string")
    return blocks.repartition("row", "at").mapInArrow(tokenize, _PART)


def _compose(fragments: DataFrame, width: int, last: bool) -> DataFrame:
    """Fragments of `width` bytes of a document composed to one; the last time to runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def close() -> pa.RecordBatch:
            whole = reduce(Fragment.then, held)
            return _parts([_run_row(key[0], r) for r in whole.finish()] if last else list(_fragment_rows(key[0], whole)))

        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in ("row", "at", "head", "tail")]
            ends = [batch.column(n) for n in _PART_NAMES[5:]]
            for i, (row, at, head, tail) in enumerate(zip(*columns, strict=True)):
                if (row, at // width) != key:
                    if held:
                        yield close()
                    key, held = (row, at // width), []
                pa_, pb, sa, sb = (_NONE if not c[i].is_valid else c[i].values.to_numpy() for c in ends)
                held.append(Fragment(at, Open(pa_, pb), [], head, tail, None if head is None else Open(sa, sb)))
        if held:
            yield close()

    node = fragments.withColumn("node", F.floor(F.col("at") / width))
    dealt = node.repartition("row", "node").sortWithinPartitions("row", "node", "at")
    return dealt.select(*_PART_NAMES).mapInArrow(run, _PART)


def long_runs(
    docs: DataFrame, tokenizers: tuple[str, str, str], longest: int, long: int = LONG, chunk: int = CHUNK, fan: int = FAN,
) -> DataFrame:
    """row, at, a and b: tokens of both sides that begin at byte `at` and end together, of documents (row, text).

    Runs of a document follow one another without gaps; documents that a side spells otherwise have none.
    """
    parts = materialise(_leaves(docs, tokenizers, long, chunk), "leaves")
    bad = parts.where(F.col("kind") == _BAD).select("row").distinct()
    runs, width = parts.where(F.col("kind") == _RUN), chunk * fan
    while True:
        last = width > longest
        parts = materialise(_compose(parts.where(F.col("kind") == _FRAGMENT), width, last), "composed")
        runs = runs.unionByName(parts.where(F.col("kind") == _RUN))
        if last:
            break
        width *= fan
    return runs.join(bad, "row", "left_anti").select("row", "at", F.col("prefix_a").alias("a"), F.col("prefix_b").alias("b"))


def _align_runs(runs: DataFrame, tokenizers: tuple[str, str, str]) -> DataFrame:
    """As `_align_short`, a row for each run, without a hash."""
    names = [field.split()[0] for field in _DIGEST.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = load_tokenizers(*tokenizers)
        for batch in batches:
            for row, a, b in zip(*(batch.column(n) for n in ("row", "a", "b")), strict=True):
                a, b = (x.values.to_numpy().astype(np.int64) for x in (a, b))
                it = Alignment(own.a_len[a], own.b_len[b])
                key = a[it.link_a] * own.b_size + b[it.link_b]
                _, key, times = distinct_pairs(np.zeros(len(key), np.int64), key)
                numbers = (row.as_py(), len(a), len(b), len(it.group_end), len(it.link_end))
                yield pa.RecordBatch.from_arrays([
                    *(pa.array([x], pa.int64()) for x in numbers), pa.nulls(1, pa.string()),
                    _lists(key, [len(key)], pa.int64()), _lists(times, [len(key)], pa.int32())], names=names)

    return runs.select("row", "a", "b").mapInArrow(run, _DIGEST)


def _hash_runs(runs: DataFrame, tokenizers: tuple[str, str, str]) -> DataFrame:
    """row and groups_sha256; a document's runs stream past in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = load_tokenizers(*tokenizers)
        row, hasher = None, None

        def close() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([row], pa.int64()), pa.array([hasher.hexdigest()], pa.string())], names=["row", "groups_sha256"])

        for batch in batches:
            for this, a, b in zip(*(batch.column(n) for n in ("row", "a", "b")), strict=True):
                if this.as_py() != row:
                    if hasher is not None:
                        yield close()
                    row, hasher = this.as_py(), hashlib.sha256()
                else:
                    hasher.update(b";")
                a, b = (x.values.to_numpy().astype(np.int64) for x in (a, b))
                codes = Alignment(own.a_len[a], own.b_len[b]).codes(a, b)
                hasher.update(_spell(codes, max(own.a_size, own.b_size))[:-1])
        if hasher is not None:
            yield close()

    dealt = runs.repartition("row").sortWithinPartitions("row", "at")
    return dealt.select("row", "a", "b").mapInArrow(run, "row bigint, groups_sha256 string")


# ------------------------------------------------------------------ the whole


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """row (unique), id and text."""
    counts = docs.agg(F.count(F.lit(1)), F.countDistinct(id_col)).first()
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    if counts[0] == counts[1] and dict(docs.dtypes)[id_col] in ("bigint", "int", "smallint", "tinyint"):
        return plain.select(F.col("id").cast("bigint").alias("row"), "id", "text")
    return materialise(plain.withColumn("row", F.monotonically_increasing_id()), "keyed").select("row", "id", "text")


def _score(table: DataFrame, keys: np.ndarray, counts: np.ndarray, best: np.ndarray) -> DataFrame:
    """row, n_best and count_sum of the pairs that are among `keys`."""
    known = table.sparkSession.sparkContext.broadcast((keys, counts, best))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, best = known.value
        for batch in batches:
            pairs, times = (batch.column(n).flatten().to_numpy() for n in ("pairs", "times"))
            sizes = np.diff(batch.column("pairs").offsets.to_numpy())
            at = np.minimum(np.searchsorted(keys, pairs), len(keys) - 1)
            times = np.where(keys[at] == pairs, times, 0).astype(np.int64)
            sums = [np.concatenate([[0], np.cumsum(x)]) for x in (times * best[at], times * counts[at])]
            ends = np.cumsum(sizes)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), *(pa.array(s[ends] - s[ends - sizes], pa.int64()) for s in sums)], names=["row", "n_best", "count_sum"])

    return table.select("row", "pairs", "times").mapInArrow(run, "row bigint, n_best bigint, count_sum bigint")


def pair_counts(short: DataFrame, runs: DataFrame, b_size: int) -> DataFrame:
    """key (A id * size of B + B id), documents that hold the pair, and whether no pair of the A id has more."""
    by_task = short.where("row is null").select(F.explode(F.arrays_zip("pairs", "times")).alias("p")).select(
        F.col("p.pairs").alias("key"), F.col("p.times").cast("bigint").alias("n"))
    by_document = runs.select("row", F.explode("pairs").alias("key")).distinct().select("key", F.lit(1).cast("bigint").alias("n"))
    counts = materialise(by_task.unionByName(by_document).groupBy("key").agg(F.sum("n").alias("n")), "pairs")
    a_id = F.floor(F.col("key") / b_size).alias("a")
    most = counts.groupBy(a_id).agg(F.max("n").alias("most"))
    # one row for each A id at most
    return counts.withColumn("a", a_id).join(F.broadcast(most), "a").select("key", "n", (F.col("n") == F.col("most")).alias("best"))


def align_documents(
    docs: DataFrame, ranks_path: str, pattern: str, pieces_path: str, id_col: str = "doc_id", text_col: str = "text",
    long: int = LONG, chunk: int = CHUNK, fan: int = FAN, slice_pairs: int = SLICE,
) -> DataFrame:
    """Id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row."""
    tokenizers = (ranks_path, pattern, pieces_path)
    keyed = _keyed(docs, id_col, text_col)
    is_long = F.coalesce(F.octet_length("text") > long, F.lit(False))
    short = materialise(_align_short(keyed.where(~is_long), tokenizers), "aligned")
    longest = keyed.agg(F.max(F.octet_length("text"))).first()[0] or 0
    if longest > long:
        runs = materialise(long_runs(keyed.where(is_long), tokenizers, longest + 1, long, chunk, fan), "runs")
        of_runs = materialise(_align_runs(runs, tokenizers), "run-links")
        hashes = _hash_runs(runs, tokenizers)
        numbers = of_runs.groupBy("row").agg(*[F.sum(c).alias(c) for c in ("n_a", "n_b", "n_groups", "n_links")])
        of_long = keyed.where(is_long).select("row").join(numbers, "row", "left").join(hashes, "row", "left")
    else:
        of_runs, of_long = short.limit(0), short.limit(0)
    numbered = ["row", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    of_documents = short.where("row is not null")
    pairs = materialise(pair_counts(short, of_runs, load_tokenizers(*tokenizers).b_size), "pair-counts")
    slices = max(1, -(-pairs.count() // slice_pairs))
    table = of_documents.select("row", "pairs", "times").unionByName(of_runs.select("row", "pairs", "times"))
    scored = None
    for number in range(slices):
        part = pairs if slices == 1 else pairs.where(F.pmod(F.xxhash64("key"), F.lit(slices)) == number)
        found = part.toArrow().sort_by("key")  # about `slice_pairs` rows
        if not found.num_rows:
            continue
        own = _score(table, *(found.column(c).to_numpy() for c in ("key", "n", "best")))
        scored = own if scored is None else scored.unionByName(own)
    results = of_documents.select(*numbered).unionByName(of_long.select(*numbered))
    sums = ("n_best", "count_sum")
    if scored is not None:
        results = results.join(scored.groupBy("row").agg(*[F.sum(c).alias(c) for c in sums]), "row", "left")
    else:
        results = results.select("*", *[F.lit(0).alias(c) for c in sums])
    zero = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("n_a", "n_b", "n_groups", "n_links", *sums)]
    return keyed.select("row", "id").join(results, "row", "left").select(
        F.col("id").alias(id_col), *zero, F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))


def token_groups(
    docs: DataFrame, ranks_path: str, pattern: str, pieces_path: str, id_col: str = "doc_id", text_col: str = "text",
    long: int = LONG, chunk: int = CHUNK, fan: int = FAN,
) -> DataFrame:
    """Id, start and end (bytes of a space and the text), a_ids and b_ids: a row for each group of each document."""
    tokenizers = (ranks_path, pattern, pieces_path)
    keyed = _keyed(docs, id_col, text_col)
    is_long = F.coalesce(F.octet_length("text") > long, F.lit(False))
    schema = "row bigint, start bigint, end bigint, a_ids array<int>, b_ids array<int>"

    def groups(own: Tokenizers, row: int, at: int, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        it = Alignment(own.a_len[a], own.b_len[b])
        cuts = [np.searchsorted(ends, it.group_end, side="right") for ends in (it.a_end, it.b_end)]
        return pa.RecordBatch.from_arrays([
            pa.array(np.full(len(it.group_end), row)), pa.array(at + np.concatenate([[0], it.group_end[:-1]]).astype(np.int64)),
            pa.array(at + it.group_end), *(_lists(ids, np.diff(c, prepend=0), pa.int32()) for ids, c in zip((a, b), cuts, strict=True))],
            names=["row", "start", "end", "a_ids", "b_ids"])

    def of_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = load_tokenizers(*tokenizers)
        for batch in batches:
            for row, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = own.encode(text) if text else None
                if found:
                    yield groups(own, row, 0, *(np.array(ids, np.int64) for ids in found))

    def of_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = load_tokenizers(*tokenizers)
        for batch in batches:
            for row, at, a, b in zip(*batch.columns, strict=True):
                yield groups(own, row.as_py(), at.as_py(), *(x.values.to_numpy().astype(np.int64) for x in (a, b)))

    found = keyed.where(~is_long).select("row", "text").mapInArrow(of_texts, schema)
    longest = keyed.agg(F.max(F.octet_length("text"))).first()[0] or 0
    if longest > long:
        runs = long_runs(keyed.where(is_long), tokenizers, longest + 1, long, chunk, fan)
        found = found.unionByName(runs.select("row", "at", "a", "b").mapInArrow(of_runs, schema))
    return keyed.select("row", "id").join(found, "row").select(F.col("id").alias(id_col), "start", "end", "a_ids", "b_ids")
