"""Packing: documents of every length into sequences of a few context sizes.

Hierarchical multi-length packing in two steps.

1. `encode_pieces` turns every text into ids, ends it with one end id and cuts it at
   multiples of the longest context. What remains of a document is one piece, so a
   document that fits the longest context is never cut. Only lengths and checksums
   leave this step; with ``keep_ids`` the ids do too.
2. `pack_pieces` deals the pieces evenly to cells and packs each cell by itself. Every
   piece is routed to the smallest tier (context size) that holds it. Tiers are packed
   from the longest to the shortest: a window opens with the longest piece of its tier,
   and its gap is filled with the longest pieces that fit, from its own tier or shorter
   ones. A window of a shorter tier that comes out exactly full stays a sequence of that
   context; any other grows into a window of the longest tier. So only windows of the
   longest tier hold padding. The sequences of a cell are dealt to step groups of nearly
   equal token counts, the largest first to the lightest group.

A cell is packed in chunks of bounded size, read in key order, so memory does not grow
with the input and a repeated task gives the same sequences.

Defined cases
  * null text: an empty one; an empty text is the end id alone;
  * null or repeated ids: every row is a document of its own; no rows: no rows;
  * strings of special tokens inside a text are ordinary text.
"""

from __future__ import annotations

import base64
import heapq
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TIERS = (256, 512, 1024, 2048)
# Pieces that one task holds at once while packing.
CHUNK_PIECES = 100_000
# Tokens of a step group.
STEP_TOKENS = 64 * 2048
# White space in a row that goes past the pattern, whose look-ahead overflows its stack from 1 000 000 on.
LONG_SPACE = 100_000
# What the pattern's own white space is: Python's has four separators more.
_SPACE = re.compile(r"[^\S\x1c-\x1f]+")


class Encoder:
    """A byte-level BPE encoder from a file of ranks; equal to the JSON form of the same vocabulary."""

    def __init__(self, ranks_path: str, pattern: str):
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode_ordinary(self, text: str) -> list[int]:
        """The ids of a text of any kind; strings of special tokens are ordinary text."""
        if len(text) < LONG_SPACE:
            return self.encoding.encode_ordinary(text)
        found, done = [], 0
        for run in _SPACE.finditer(text):
            if run.end() - run.start() < LONG_SPACE:
                continue
            found += self.encoding.encode_ordinary(text[done:run.start()])
            # the pattern takes a run as one word, but for the last character if a word follows
            done = run.end() - (run.end() < len(text))
            found += self.encoding._encode_single_piece(text[run.start():done])
        return found + self.encoding.encode_ordinary(text[done:])


def load_encoder(ranks_path: str, pattern: str) -> Encoder:
    return Encoder(ranks_path, pattern)


def encode_pieces(
    docs: DataFrame, ranks_path: str, pattern: str, end_id: int = 1, context: int = TIERS[-1],
    id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False,
) -> DataFrame:
    """Pieces of every document: id, start, length, ids_crc32, doc_tokens (and ids)."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load_encoder(ranks_path, pattern)
        for batch in batches:
            ids, out, kept = batch.column(0), [], []
            for row, text in enumerate(batch.column(1)):
                tokens = encoder.encode_ordinary(text.as_py() or "")
                tokens.append(end_id)
                array = np.array(tokens, "<u4")
                for start in range(0, len(array), context):
                    piece = array[start:start + context]
                    out.append((row, start, len(piece), zlib.crc32(piece.tobytes()), len(array)))
                    if keep_ids:
                        kept.append(piece.astype(np.int32))
            numbers = np.array(out, np.int64).reshape(-1, 5)
            columns = [ids.take(pa.array(numbers[:, 0]))] + [pa.array(numbers[:, k]) for k in range(1, 5)]
            if keep_ids:
                columns.append(pa.array(kept, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    schema = f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long"
    schema += ", ids array<int>" if keep_ids else ""
    names = [field.split()[0] for field in schema.split(", ")]
    return source.mapInArrow(encode, schema).withColumnRenamed("id", id_col)


def pack_lengths(lengths: np.ndarray, tiers: tuple[int, ...] = TIERS) -> list[tuple[int, list[int]]]:
    """Sequences as (context, indexes of the pieces in order); every piece is in exactly one.

    Pieces wait by length; the bits of `waiting` say which lengths there are, so the
    longest that fits a gap is found at once.
    """
    longest = max(tiers)
    by_length: dict[int, list[int]] = {}
    waiting = 0
    for index in range(len(lengths) - 1, -1, -1):
        length = int(lengths[index])
        by_length.setdefault(length, []).append(index)
        waiting |= 1 << length

    def take(room: int) -> int:
        """The length of the longest waiting piece of at most `room`, 0 for none."""
        return (waiting & ((2 << room) - 1)).bit_length() - 1 if waiting & ((2 << room) - 1) else 0

    sequences = []
    for tier in sorted(tiers, reverse=True):
        shorter = max((t for t in tiers if t < tier), default=0)
        while (length := take(tier)) > shorter:
            window, used, size = [], 0, tier
            while length:
                window.append(by_length[length].pop())
                if not by_length[length]:
                    waiting ^= 1 << length
                used += length
                length = take(size - used)
                if not length and used < size:
                    size = longest
                    length = take(size - used)
            sequences.append((size, window))
    return sequences


def step_groups(loads: list[int], step_tokens: int) -> list[int]:
    """A group for each sequence; groups hold nearly equal token counts."""
    groups = [(0, g) for g in range(max(1, round(sum(loads) / step_tokens)))]
    found = [0] * len(loads)
    for index in sorted(range(len(loads)), key=lambda i: (-loads[i], i)):
        load, group = heapq.heappop(groups)
        found[index] = group
        heapq.heappush(groups, (load + loads[index], group))
    return found


def pack_pieces(
    pieces: DataFrame, tiers: tuple[int, ...] = TIERS, cells: int | None = None,
    chunk_pieces: int = CHUNK_PIECES, step_tokens: int = STEP_TOKENS,
) -> DataFrame:
    """The pieces with sequence_id, offset, context and step_group.

    `pieces` has a column `length` of 1 to the longest tier; all its columns are kept. A
    sequence shorter than its context is padded. `cells` is by default the session's
    number of shuffle partitions.
    """
    cells = cells or int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # ids of sequences and groups are distinct across cells and chunks
        base = TaskContext.get().partitionId() << 36
        next_sequence = next_group = base

        def packed(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            nonlocal next_sequence, next_group
            table = pa.Table.from_batches(held)
            lengths = table.column("length").to_numpy()
            sequences = pack_lengths(lengths, tiers)
            groups = step_groups([int(lengths[window].sum()) for _, window in sequences], step_tokens)
            extra = np.zeros((4, len(lengths)), np.int64)
            for number, (context, window) in enumerate(sequences):
                ends = np.cumsum(lengths[window])
                extra[0, window] = next_sequence + number
                extra[1, window] = ends - lengths[window]
                extra[2, window] = context
                extra[3, window] = next_group + groups[number]
            next_sequence += len(sequences)
            next_group += max(groups, default=-1) + 1
            for name, values in zip(("sequence_id", "offset", "context", "step_group"), extra, strict=True):
                table = table.append_column(name, pa.array(values))
            yield from table.to_batches(max_chunksize=10_000)

        held, rows = [], 0
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, chunk_pieces - rows)
                batch = batch.slice(part.num_rows)
                held.append(part)
                rows += part.num_rows
                if rows == chunk_pieces:
                    yield from packed(held)
                    held, rows = [], 0
        if rows:
            yield from packed(held)

    # the row number keeps copies of a document apart; it repeats with the task that reads them
    columns = [F.col(f"`{c}`") for c in pieces.columns]
    numbered = pieces.withColumn("_row", F.monotonically_increasing_id())
    dealt = (
        numbered.repartition(cells, F.xxhash64("_row", "length")).sortWithinPartitions("_row")
        .select(*columns)
    )
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return dealt.mapInArrow(pack, f"{schema}, sequence_id long, offset long, context long, step_group long")


def pack_documents(docs: DataFrame, ranks_path: str, pattern: str, **options) -> DataFrame:
    """`encode_pieces`, then `pack_pieces`."""
    cells = options.pop("cells", None)
    return pack_pieces(encode_pieces(docs, ranks_path, pattern, **options), cells=cells)
