"""Suffix-array dedup: bytes covered by strings that an earlier document holds too.

A byte goes if a string of `SPAN` bytes that covers it also starts in a document with a smaller
id. The suffixes of a collection are sorted by the column-wise construction of its
transform and common prefixes (collection_bwt); those that share `SPAN` bytes are then
neighbours, and the smallest id among them decides. To run as independent jobs, the
collection is cut by content:

1. Anchors. In every window of `SPAN` bytes the position whose `GRAM` bytes hash lowest is an
   anchor, so equal windows have equal anchors at equal offsets. The bytes that windows
   through an anchor can span are its segment.
2. Groups. Anchors are dealt by hash. A hash that occurs in one document only has no
   partner. Equal segments are one string of the collection, with its smallest id; in
   documents with a larger one all its windows go. That is decided in each batch of rows before
   anything moves, and then for all. A string that is alone in its group needs
   no sorting; the bytes of the others are asked for, one occurrence each.
3. Extraction. The texts stream past the requests, and segments return to their groups.
4. Construction. Strings are trimmed to what a window shared with another string of the group can
   cover. Groups are batched to collections of about `BATCH_BYTES`, built column by
   column, and each window gets the smallest id of its run of common prefixes. A group that
   is larger is split by the bytes that its windows must share (`_collections`).
5. Removal. The answers return to their documents, whose texts stream past once more.

Between the steps go compressed packets of arrays, each for one slot (a group of hashes) or
one part (a group of documents), so few rows carry many anchors. Hot passages are
many equal segments and collapse to one string before any bytes move. There are as many slots
and parts as shuffle partitions, and more if one would stand for over `SLOT_BYTES` of text.
Steps 2 and 4 leave written tables. Segments are told apart by 64 bits of a hash beside the 48 of
their anchor. The strings round one anchor's bytes meet in one slot.

Defined cases
  * null text: empty; texts shorter than `SPAN` lose nothing;
  * repeated ids: rows of their own, none of them smaller than the other, so they do not
    remove from each other; null ids count as larger than all others;
  * no rows: no rows.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.collection_bwt import build, places_by_length
from millrace.session import materialise

SPAN = 50
GRAM = 16
# Bytes of one collection.
BATCH_BYTES = 2_000_000
# Bytes of text for each slot and part, at most.
SLOT_BYTES = 64_000_000
# Bytes whose anchors are found at a time: some 30 arrays of eight times that size.
_BLOCK = 250_000
# Bytes of text, and one more text at most, of the rows that a task handles at a time.
_SLICE = 16_000_000
# Segments a task gathers before it sends them to their slots.
_HELD_PIECES = 200_000
# Occurrences of strings that are answered at a time.
_HELD_ANSWERS = 50_000
# Answers of one document that are unfolded to windows at a time.
_HELD_MASKS = 20_000
_WINDOWS = SPAN - GRAM + 1
_SIDE = (SPAN - GRAM + 1) // 2
_NO_ID = np.int64(2**63 - 1)
_ALL = np.uint64((1 << _WINDOWS) - 1)
_GROUPS, _SEGMENTS, _REQUESTS, _ANSWERS, _TEXTS = range(5)
_PACKET = "target long, kind long, packet binary"


# ------------------------------------------------------------------ packets


def _pack(*arrays) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(arrays, 5))


def _unpack(packet: bytes) -> tuple:
    return pickle.loads(zstandard.ZstdDecompressor().decompress(packet))


def _delta(values: np.ndarray) -> np.ndarray:
    return np.diff(values, prepend=values.dtype.type(0))


def _rows(targets, kind: int, packets: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(targets, pa.int64()), pa.array([kind] * len(packets), pa.int64()), pa.array(packets, pa.binary())],
        names=["target", "kind", "packet"])


def _runs(target: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each target with the places where it stands."""
    order = np.argsort(target, kind="stable")
    ordered = target[order]
    cuts = np.flatnonzero(ordered[1:] != ordered[:-1]) + 1
    for own in np.split(order, cuts):
        if len(own):
            yield int(target[own[0]]), own


def _deal(target: np.ndarray, kind: int, *arrays: np.ndarray) -> pa.RecordBatch:
    """One packet of the arrays for each target."""
    targets, packets = [], []
    for number, own in _runs(target):
        targets.append(number)
        packets.append(_pack(*(x[own] for x in arrays)))
    return _rows(targets, kind, packets)


def _answers(parts: np.ndarray, row: np.ndarray, at: np.ndarray, mask: np.ndarray) -> pa.RecordBatch:
    """Row, place and windows that go, to the parts of the rows; few bytes for rows in order."""
    targets, packets = [], []
    narrow = at.astype(np.int32) if not len(at) or at.max() < 2**31 else at
    for target, own in _runs(_spread(row, parts)):
        targets.append(target)
        packets.append(_pack(_delta(row[own]), _delta(narrow[own]), mask[own]))
    return _rows(targets, _ANSWERS, packets)


def _by_target(batches: Iterator[pa.RecordBatch], work: Callable) -> Iterator[pa.RecordBatch]:
    """`work(target, packets)` for each run of one target; packets are (kind, bytes) and stream."""
    stream = ((t, k, p) for b in batches for t, k, p in zip(
        b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True))
    row = next(stream, None)
    while row is not None:
        target = row[0]

        def packets():
            nonlocal row
            while row is not None and row[0] == target:  # noqa: B023
                kind, packet = row[1], row[2].as_py()
                row = next(stream, None)
                yield kind, packet

        run = packets()
        yield from work(target, run)
        for _ in run:  # what the work has left
            pass


def _targets(spark, partitions: int) -> np.ndarray:
    """One number for each shuffle partition, which is dealt to it: slots and parts are spread without collisions."""
    dealt = F.pmod(F.hash("id"), F.lit(partitions)).alias("partition")
    found = spark.range(30 * partitions).groupBy(dealt).agg(F.min("id").alias("id")).orderBy("partition").collect()
    return np.array([r.id for r in found], np.int64)


def _spread(values: np.ndarray, targets: np.ndarray) -> np.ndarray:
    return targets[(_mix(values.astype(np.uint64)) >> np.uint64(33)).astype(np.int64) % len(targets)]


def _gather(packets: DataFrame, targets: np.ndarray) -> DataFrame:
    """Packets of one target together, in the order of their kinds."""
    return packets.repartition(len(targets), "target").sortWithinPartitions("target", "kind")


# ------------------------------------------------------------------ anchors


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2**64, and those of its inverse."""
    base = 0x9E3779B97F4A7C15
    def powers(of: int) -> np.ndarray:
        found = np.ones(1, np.uint64)
        while len(found) < n:
            found = np.concatenate([found, found * np.uint64(pow(of, len(found), 1 << 64))])
        return found[:n]
    return powers(base), powers(pow(base, -1, 1 << 64))


_SYMBOLS = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


def _sliding(values: np.ndarray, width: int, choose) -> np.ndarray:
    """choose() over every `width` values in a row."""
    done = 1
    while 2 * done <= width:
        values = choose(values[:-done], values[done:])
        done *= 2
    return choose(values[:len(values) - (width - done)], values[width - done:]) if done < width else values


def anchors(data: bytes, lengths: np.ndarray) -> tuple[np.ndarray, ...]:
    """Document number, position, hash and segment hash of the anchors of documents laid end to end."""
    x = np.frombuffer(data, np.uint8)
    n = len(x)
    nothing = np.array([], np.int64)
    if n < SPAN:
        return nothing, nothing, nothing.astype(np.uint64), nothing.astype(np.uint64)
    size = 1 << max(12, (n + 1).bit_length())
    up, down = _powers(size)
    prefix = np.empty(n + 1, np.uint64)
    prefix[0] = 0
    np.cumsum(_SYMBOLS[x] * up[:n], out=prefix[1:])
    grams = _mix((prefix[GRAM:] - prefix[:-GRAM]) * down[:n - GRAM + 1])
    least = _sliding(grams, _WINDOWS, np.minimum)
    ends = np.cumsum(lengths)
    begins = ends - lengths
    long = lengths >= SPAN
    inside = np.zeros(n + 1, np.int32)
    inside[begins[long]] += 1
    inside[ends[long] - SPAN + 1] -= 1  # long documents that touch: +1 of the next lies further on
    least[np.cumsum(inside[:len(least)]) == 0] = 0
    edge = np.zeros(_WINDOWS - 1, np.uint64)
    most = _sliding(np.concatenate([edge, least, edge]), _WINDOWS, np.maximum)
    at = np.flatnonzero((most == grams) & (grams > 0))
    document = np.searchsorted(ends, at, side="right")
    left = np.minimum(at - begins[document], _WINDOWS - 1)
    right = np.minimum(ends[document] - at, SPAN)
    segment = (prefix[at + right] - prefix[at - left]) * down[at - left]
    segment = _mix(segment + (left * 64 + right).astype(np.uint64))
    return document, at - begins[document], grams[at], segment


def _anchors_of(texts: list[bytes]) -> Iterator[tuple[np.ndarray, ...]]:
    """`anchors` over texts of any length, in blocks."""
    held, first, size = [], 0, 0

    def flush():
        found = anchors(b"".join(held), np.array([len(t) for t in held], np.int64))
        return (found[0] + first, *found[1:])

    for number, text in enumerate(texts):
        if len(text) > _BLOCK:
            # blocks of windows, with the bytes around them that segments need
            found = []
            for start in range(0, len(text) - SPAN + 1, _BLOCK):
                low, high = max(0, start - 2 * SPAN), min(len(text), start + _BLOCK + 3 * SPAN)
                _, at, gram, segment = anchors(text[low:high], np.array([high - low]))
                at = at + low
                keep = ((at >= start) | (start == 0)) & ((at < start + _BLOCK) | (high == len(text)))
                found.append((at[keep], gram[keep], segment[keep]))
            at, order = np.unique(np.concatenate([f[0] for f in found]), return_index=True)
            gram, segment = (np.concatenate([f[k] for f in found])[order] for k in (1, 2))
            yield np.full(len(at), number), at, gram, segment
            continue
        if size + len(text) > _BLOCK and held:
            yield flush()
            held, size = [], 0
        if not held:
            first = number
        while held and first + len(held) < number:
            held.append(b"")  # a long text in between
        held.append(text)
        size += len(text)
    if held:
        yield flush()


def _later(key: np.ndarray, first: np.ndarray, *same: np.ndarray) -> np.ndarray:
    """Which rows have a larger key than another row that is equal in all of `same`; `first` brings these together."""
    order = np.argsort(first, kind="stable")
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([x[order[1:]] != x[order[:-1]] for x in (first, *same)])
    starts = np.flatnonzero(new)
    found = np.zeros(len(order), bool)
    if len(order):
        least = np.minimum.reduceat(key[order], starts)
        found[order] = key[order] > np.repeat(least, np.diff(starts, append=len(order)))
    return found


def _six(values: np.ndarray) -> np.ndarray:
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 2:].copy()


def _from_six(values: np.ndarray) -> np.ndarray:
    full = np.zeros((len(values), 8), np.uint8)
    full[:, 2:] = values
    return full.view("<u8").ravel()


# ------------------------------------------------------------------ steps


def _keyed(docs: DataFrame, id_col: str, text_col: str, keep: tuple[str, ...]) -> tuple[DataFrame, int]:
    """row (unique), id (nulls last), text as bytes and the columns to keep; and the bytes of all texts."""
    size = F.octet_length(F.col(text_col).cast("string")).cast("bigint")
    counts = docs.agg(F.count(F.lit(1)), F.countDistinct(id_col), F.coalesce(F.sum(size), F.lit(0))).first()
    order = F.coalesce(F.col(id_col).cast("bigint"), F.lit(int(_NO_ID)))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    kept = [F.col(c).alias(f"keep_{k}") for k, c in enumerate(keep)]
    if counts[0] == counts[1]:
        return docs.select(order.alias("row"), order.alias("id"), text.alias("text"), *kept), counts[2]
    keyed = materialise(docs.select(order.alias("id"), text.alias("text"), *kept).withColumn(
        "row", F.monotonically_increasing_id()), "keyed")
    return keyed.select("row", "id", "text", *[f"keep_{k}" for k in range(len(keep))]), counts[2]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in turn, in batches of bounded bytes: Spark counts rows, and 10 000 long texts are gigabytes."""
    for batch in batches:
        sizes = pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False).astype(np.int64)
        number = (np.cumsum(sizes) - sizes) // _SLICE
        bounds = [0, *(np.flatnonzero(number[1:] != number[:-1]) + 1).tolist(), len(sizes)]
        for start, end in zip(bounds, bounds[1:], strict=False):
            yield batch.slice(start, end - start)


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return batch.column("text").to_pylist()


def _numbers(batch: pa.RecordBatch, column: str) -> np.ndarray:
    return batch.column(column).to_numpy().astype(np.int64)


def _find_anchors(docs: DataFrame, slots: np.ndarray, parts: np.ndarray) -> DataFrame:
    """Anchors to their slots. Of equal segments in a batch of rows only those of its smallest id go there; the answer
    for the others is known."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            rows, ids = _numbers(batch, "row"), _numbers(batch, "id")
            found = [np.concatenate(x) for x in zip(*_anchors_of(_texts(batch)), strict=True)]
            if found:
                document, at, gram, segment = found
                later = _later(ids[document], segment, gram)
                if later.any():
                    yield _answers(parts, rows[document[later]], at[later], np.full(int(later.sum()), _ALL))
                    document, at, gram, segment = (x[~later] for x in found)
                slot = slots[(gram >> np.uint64(24)).astype(np.int64) % len(slots)]
                targets, packets = [], []
                for target, own in _runs(slot):
                    targets.append(target)
                    documents = document[own]
                    packets.append(_pack(
                        _six(gram[own]), segment[own], _delta(rows[documents]), _delta(ids[documents]),
                        _delta(at[own].astype(np.int32 if batch.nbytes < 2**31 else np.int64))))
                yield _rows(targets, _GROUPS, packets)

    return docs.select("row", "id", "text").mapInArrow(run, _PACKET)


def _find_groups(found: DataFrame, parts: np.ndarray) -> DataFrame:
    """Groups of strings to sort, requests for their bytes, and answers that need no sorting."""

    def work(slot: int, packets: Iterator) -> Iterator[pa.RecordBatch]:
        columns = [[], [], [], [], []]
        for kind, packet in packets:
            if kind == _ANSWERS:  # slots and parts have the same numbers
                yield _rows([slot], kind, [packet])
                continue
            gram, segment, row, key, at = _unpack(packet)
            for column, values in zip(columns, (
                _from_six(gram), segment, np.cumsum(row), np.cumsum(key), np.cumsum(at, dtype=np.int64)), strict=True):
                column.append(values)
        if not columns[0]:
            return
        gram, segment, row, key, at = (np.concatenate(c) for c in columns)
        order = np.argsort(gram, kind="stable")
        ordered = gram[order]
        starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        by_gram = key[order]
        shared = np.minimum.reduceat(by_gram, starts) < np.maximum.reduceat(by_gram, starts)
        keep = order[np.repeat(shared, np.diff(starts, append=len(order)))]
        if not len(keep):
            return
        gram, segment, row, key, at = (x[keep] for x in (gram, segment, row, key, at))
        order = np.lexsort((at, row, key, segment, gram))
        gram, segment, row, key, at = (x[order] for x in (gram, segment, row, key, at))
        new_group = np.concatenate([[True], gram[1:] != gram[:-1]])
        new_string = new_group | np.concatenate([[True], segment[1:] != segment[:-1]])
        group, string = np.cumsum(new_group) - 1, np.cumsum(new_string) - 1
        first = np.flatnonzero(new_string)
        alone = np.bincount(group[first])[group] == 1
        # what an earlier document holds in the same surroundings goes as a whole, sorted or not
        later = key > key[first][string]
        known = np.flatnonzero(later)
        known = known[np.lexsort((at[known], row[known]))]
        yield _answers(parts, row[known], at[known], np.full(len(known), _ALL))
        several = ~alone[first]
        number = np.cumsum(several) - 1  # of the strings that are sorted
        first = first[several]
        yield _deal(_spread(row[first], parts), _REQUESTS, row[first], at[first],
                    np.full(len(first), slot), np.arange(len(first)))
        sorted_rows = ~alone & ~later
        yield _rows([slot], _GROUPS, [_pack(
            group[first], key[first], number[string[sorted_rows]].astype(np.int32), _delta(row[sorted_rows]),
            _delta(key[sorted_rows]), at[sorted_rows])])

    return _gather(found, parts).mapInArrow(lambda batches: _by_target(batches, work), _PACKET)


def _pack_texts(docs: DataFrame, parts: np.ndarray) -> DataFrame:
    kept = [c for c in docs.columns if c.startswith("keep_")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            rows, ids, texts = _numbers(batch, "row"), _numbers(batch, "id"), _texts(batch)
            others = [batch.column(c).to_pylist() for c in kept]
            part = _spread(rows, parts)
            targets, packets = [], []
            for target in np.unique(part):
                own = np.flatnonzero(part == target)
                targets.append(int(target))
                packets.append(_pack(rows[own], ids[own], [texts[i] for i in own], [[o[i] for i in own] for o in others]))
            yield _rows(targets, _TEXTS, packets)

    return docs.mapInArrow(run, _PACKET)


def _extract(packets: DataFrame, slots: np.ndarray) -> DataFrame:
    """The bytes that are asked for, to their slots."""

    def work(part: int, found: Iterator) -> Iterator[pa.RecordBatch]:
        asked = [[], [], [], []]
        wanted = None
        slots, numbers, lefts, pieces = [], [], [], []

        def flush() -> pa.RecordBatch:
            targets, out = [], []
            for target, own in _runs(np.array(slots, np.int64)):
                targets.append(target)
                own = own.tolist()
                out.append(_pack(
                    np.array([numbers[i] for i in own], np.int32), np.array([lefts[i] for i in own], np.uint8),
                    np.array([len(pieces[i]) for i in own], np.uint8), b"".join([pieces[i] for i in own])))
            for column in (slots, numbers, lefts, pieces):
                column.clear()
            return _rows(targets, _SEGMENTS, out)

        for kind, packet in found:
            if kind == _REQUESTS:
                for column, values in zip(asked, _unpack(packet), strict=True):
                    column.append(values)
                continue
            if wanted is None:
                if not asked[0]:
                    return
                wanted = [np.concatenate(c) for c in asked]
                order = np.argsort(wanted[0], kind="stable")
                wanted = [c[order] for c in wanted]
            rows, _, texts, _ = _unpack(packet)
            low, high = np.searchsorted(wanted[0], rows), np.searchsorted(wanted[0], rows, side="right")
            for text, a, b in zip(texts, low.tolist(), high.tolist(), strict=True):
                if a == b:
                    continue
                places = wanted[1][a:b].tolist()
                slots += wanted[2][a:b].tolist()
                numbers += wanted[3][a:b].tolist()
                lefts += [at if at < _WINDOWS else _WINDOWS - 1 for at in places]
                pieces += [text[at - _WINDOWS + 1 if at >= _WINDOWS else 0:at + SPAN] for at in places]
            if len(pieces) >= _HELD_PIECES:
                yield flush()
        yield flush()

    return _gather(packets, slots).mapInArrow(lambda batches: _by_target(batches, work), _PACKET)


def smallest_ids(strings: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each string and each of its suffixes of `SPAN` bytes or more, by length (column): the smallest id of
    a string of the collection in which the first `SPAN` bytes of the suffix occur."""
    bwt, common = build(strings, lengths, SPAN)
    places = places_by_length(bwt, len(strings), strings.shape[1])
    run = np.cumsum(common < SPAN) - 1
    least = np.full(run[-1] + 1, _NO_ID)
    whole = places[:, SPAN:]
    owner, _ = np.nonzero(whole >= 0)
    np.minimum.at(least, run[whole[whole >= 0]], ids[owner])
    return np.where(whole >= 0, least[run[np.maximum(whole, 0)]], _NO_ID)


def _shared(data: np.ndarray, start: np.ndarray, there: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Whether another string of the group has the same `_SIDE` bytes from `start` on (surely not, if False)."""
    weights = _SYMBOLS[:_SIDE] | np.uint64(1)
    found = np.zeros(len(start), np.uint64)
    for k in range(_SIDE):
        found += _SYMBOLS[data[np.where(there, start + k, 0)]] * weights[k]
    _, which, count = np.unique(_mix(found) ^ _mix(group.astype(np.uint64) + np.uint64(1)), return_inverse=True, return_counts=True)
    alike = np.bincount(which[there], minlength=len(count))
    return there & (alike[which] > 1)


def _trim(data, begin, length, left, group):
    """Which strings can share a window with another, and the part of them that such a window can cover.

    A window holds the anchor and `SPAN - GRAM` bytes beside it, so at least `_SIDE` of them on one side. A
    string that is alone in its group with these bytes on one side has no shared window that goes so far there.
    """
    on_left = _shared(data, begin + left - _SIDE, left >= _SIDE, group)
    on_right = _shared(data, begin + left + GRAM, length >= left + GRAM + _SIDE, group)
    cut = np.where(on_left, 0, np.maximum(left - _SIDE + 1, 0))
    begin, length, left = begin + cut, length - cut, left - cut
    length = np.where(on_right, length, np.minimum(length, left + GRAM + _SIDE - 1))
    return (on_left | on_right) & (length >= SPAN), begin, length, left


def _refined(data: np.ndarray, start: np.ndarray, width: int, label: np.ndarray) -> np.ndarray:
    """Labels that also tell apart the `width` bytes from `start` on."""
    for k in range(0, width, 8):
        chunk = np.zeros(len(label), np.uint64)
        for step in range(k, min(k + 8, width)):
            chunk = chunk << np.uint64(8) | data[start + step].astype(np.uint64)
        order = np.lexsort((chunk, label))
        new = np.ones(len(order), bool)
        new[1:] = (label[order[1:]] != label[order[:-1]]) | (chunk[order[1:]] != chunk[order[:-1]])
        label = np.empty(len(order), np.int64)
        label[order] = np.cumsum(new) - 1
    return label


def _collections(data, begin, length, left, group) -> Iterator[tuple[np.ndarray, ...]]:
    """Collections of about `BATCH_BYTES`: numbers of strings, and begin, length and left of the part to build.

    A group that fits is built as a whole. A larger one is split by what its strings must share: all windows with
    `low` to `high` bytes before the anchor hold the `low` bytes before it and those up to `SPAN - high` behind its
    begin. Strings that differ there share none of these windows. Halving the range adds to what must be shared, until
    strings agree in a whole window; such a run is built as one string, and stays one collection of its own.
    """
    pending = [(0, _WINDOWS - 1, np.arange(len(group)), group)]
    while pending:
        low, high, own, label = pending.pop()
        cut = np.maximum(left[own] - high, 0)
        first, before = begin[own] + cut, left[own] - cut
        size = np.minimum(length[own] - cut, before + SPAN - low)
        bounds = np.flatnonzero(np.concatenate([[True], label[1:] != label[:-1]]))
        total = np.add.reduceat(size, bounds)
        counts = np.diff(bounds, append=len(own))
        large = total > BATCH_BYTES
        filled = np.cumsum(np.where(large, 0, total))
        batch = np.repeat(np.where(large, -1, (filled - total) // BATCH_BYTES), counts)
        fits = np.flatnonzero(batch >= 0)
        if len(fits):
            edges = np.flatnonzero(np.concatenate([[True], batch[fits][1:] != batch[fits][:-1]]))
            for some in np.split(fits, edges[1:]):
                yield own[some], first[some], size[some], before[some]
        some = np.flatnonzero(batch < 0)
        if not len(some):
            continue
        if low == high:  # the window is the whole string
            for run in np.split(some, np.flatnonzero(label[some][1:] != label[some][:-1]) + 1):
                yield own[run], first[run[:1]], size[run[:1]], before[run[:1]]
            continue
        own, label = own[some], label[some]
        if (low, high) == (0, _WINDOWS - 1):
            label = _refined(data, begin[own] + left[own], GRAM, label)
        middle = (low + high) // 2
        for a, b in ((low, middle), (middle + 1, high)):
            there = np.minimum(left[own], b) + np.minimum(length[own] - left[own], SPAN - a) >= SPAN
            half, name = own[there], label[there]
            anchor = begin[half] + left[half]
            if b < high:
                name = _refined(data, anchor + SPAN - high, high - b, name)
            else:
                name = _refined(data, anchor - a, a - low, name)
            shared = np.bincount(name, minlength=1)[name] > 1
            half, name = half[shared], name[shared]
            if len(half):
                order = np.argsort(name, kind="stable")
                pending.append((a, b, half[order], name[order]))


def _sort(packets: DataFrame, parts: np.ndarray) -> DataFrame:
    """Answers for all occurrences of the strings that were sorted."""

    def work(slot: int, found: Iterator) -> Iterator[pa.RecordBatch]:
        pieces = [[], [], [], []]
        for kind, packet in found:
            if kind == _GROUPS:
                group, smallest, string, row, key, at = _unpack(packet)
                row, key = np.cumsum(row), np.cumsum(key)
            else:
                for column, values in zip(pieces, _unpack(packet), strict=True):
                    column.append(values)
        if not len(group):
            return
        number, left, length = (np.concatenate(c) for c in pieces[:3])
        data = np.frombuffer(b"".join(pieces[3]), np.uint8)
        begin = (np.cumsum(length, dtype=np.int64) - length)[np.argsort(number)]
        left, length = (x[np.argsort(number)].astype(np.int64) for x in (left, length))
        keep, begin, length, left = _trim(data, begin, length, left, group)
        some = keep[string]
        string, row, key, at = (np.cumsum(keep) - 1)[string[some]], row[some], key[some], at[some]
        group, smallest, begin, length, left = (x[keep] for x in (group, smallest, begin, length, left))
        if not len(group):
            return
        occurrences = np.searchsorted(string, np.arange(len(group) + 1))
        for own, first, size, before in _collections(data, begin, length, left, group):
            width, built = int(size.max()), len(size)
            columns = np.arange(width) - (width - size)[:, None]
            strings = np.where(columns >= 0, data[np.maximum(first[:, None] + columns, 0)], 0).astype(np.uint8)
            # a run of one window is one string with the smallest id of all
            ids = smallest[own] if built == len(own) else smallest[own].min(keepdims=True)
            least = smallest_ids(strings, size, ids)
            # column k holds the suffix of SPAN + k bytes, whose window begins size - SPAN - k bytes into the string
            offset = size[:, None] - SPAN - np.arange(least.shape[1]) - before[:, None] + _WINDOWS - 1
            place = np.arange(len(own)) if built == len(own) else np.zeros(len(own), np.int64)
            counts = occurrences[own + 1] - occurrences[own]
            which = np.repeat(place, counts)
            there = np.arange(len(which)) + np.repeat(occurrences[own] - (np.cumsum(counts) - counts), counts)
            for k in range(0, len(which), _HELD_ANSWERS):
                string_of, own_rows = which[k:k + _HELD_ANSWERS], there[k:k + _HELD_ANSWERS]
                hit = least[string_of] < key[own_rows, None]
                bits = np.where(hit, np.uint64(1) << np.maximum(offset[string_of], 0).astype(np.uint64), np.uint64(0))
                mask = np.bitwise_or.reduce(bits, axis=1)
                some = own_rows[mask > 0]
                yield _answers(parts, row[some], at[some], mask[mask > 0])

    return _gather(packets, parts).mapInArrow(lambda batches: _by_target(batches, work), _PACKET)


def removed_spans(n: int, at: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Start and end of the maximal runs of bytes that go, given the answers of a document's anchors."""
    begun = np.zeros(n + 2, np.int8)  # 1 at the start of a window that goes, moved by one
    for k in range(0, len(at), _HELD_MASKS):
        bit, which = np.nonzero(mask[None, k:k + _HELD_MASKS] >> np.arange(_WINDOWS, dtype=np.uint64)[:, None] & np.uint64(1))
        starts = at[k:k + _HELD_MASKS][which] - (_WINDOWS - 1) + bit
        starts = starts[(starts >= 0) & (starts <= n - SPAN)]  # an anchor near an edge has fewer windows
        begun[starts + 1] = 1
    edges = np.flatnonzero(begun[1:] != begun[:-1])
    if not len(edges):
        return np.empty((0, 2), np.int64)
    low, high = edges[::2], edges[1::2] - 1  # first and last start of each run of starts
    new = np.concatenate([[True], low[1:] > high[:-1] + SPAN])
    last = np.append(np.flatnonzero(new)[1:], len(low)) - 1
    return np.stack([low[new], high[last] + SPAN], axis=1)


def _remove(packets: DataFrame, parts: np.ndarray, kept: list[T.StructField], as_text: bool) -> DataFrame:
    def work(part: int, found: Iterator) -> Iterator[pa.RecordBatch]:
        given, answers = [[], [], []], None
        for kind, packet in found:
            if kind == _ANSWERS:
                row, at, mask = _unpack(packet)
                for column, values in zip(given, (np.cumsum(row), np.cumsum(at, dtype=np.int64), mask), strict=True):
                    column.append(values)
                continue
            if answers is None:
                answers = [np.concatenate(c) if c else np.array([], np.int64) for c in given]
                order = np.argsort(answers[0], kind="stable")
                answers = [c[order] for c in answers]
            rows, ids, texts, others = _unpack(packet)
            low, high = np.searchsorted(answers[0], rows), np.searchsorted(answers[0], rows, side="right")
            left, spans = [], []
            for text, a, b in zip(texts, low.tolist(), high.tolist(), strict=True):
                own = removed_spans(len(text), answers[1][a:b], answers[2][a:b].astype(np.uint64)) if b > a else ()
                if len(own):
                    edges = [0, *own.ravel().tolist(), len(text)]
                    text = b"".join(text[s:e] for s, e in zip(edges[::2], edges[1::2], strict=True))
                # a cut inside a character leaves bytes that are no text
                left.append(text.decode("utf-8", "ignore") if as_text else text)
                spans.append([{"start": int(s), "end": int(e)} for s, e in own])
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, mask=ids == _NO_ID), *(pa.array(o, t) for o, t in zip(others, arrow, strict=True)),
                pa.array([len(t) for t in texts], pa.int64()), pa.array(left, pa.string() if as_text else pa.binary()),
                pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))], names=names)

    from pyspark.sql.pandas.types import to_arrow_type

    arrow = [to_arrow_type(f.dataType) for f in kept]
    span = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    schema = T.StructType([
        T.StructField("id", T.LongType()), *kept, T.StructField("n_bytes", T.LongType()),
        T.StructField("kept", T.StringType() if as_text else T.BinaryType()), T.StructField("spans", span)])
    names = schema.names
    return _gather(packets, parts).mapInArrow(lambda batches: _by_target(batches, work), schema)


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), as_text: bool = False,
) -> DataFrame:
    """Id, the columns `keep`, n_bytes, kept (the remaining bytes) and spans (start, end) of every row.

    Ids are integers. `as_text` gives what remains as text, without characters that were cut in part.
    """
    keyed, size = _keyed(docs, id_col, text_col, keep)
    partitions = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // SLOT_BYTES))
    slots = parts = _targets(docs.sparkSession, partitions)
    grouped = materialise(_find_groups(_find_anchors(keyed, slots, parts), parts), "groups")
    texts = _pack_texts(keyed, parts)
    plain = _pack_texts(keyed.select("row", "id", "text"), parts)
    segments = _extract(grouped.where(F.col("kind") == _REQUESTS).unionByName(plain), slots)
    sorted_answers = _sort(grouped.where(F.col("kind") == _GROUPS).unionByName(segments), parts)
    answers = materialise(sorted_answers, "answers").unionByName(grouped.where(F.col("kind") == _ANSWERS))
    fields = [T.StructField(f"keep_{k}", docs.schema[c].dataType) for k, c in enumerate(keep)]
    found = _remove(answers.unionByName(texts), parts, fields, as_text)
    names = [F.col("id").cast(docs.schema[id_col].dataType).alias(id_col), *(F.col(f"keep_{k}").alias(c) for k, c in enumerate(keep))]
    return found.select(*names, "n_bytes", "kept", "spans")
