"""SimHash near-duplicates: documents whose fingerprints differ in few bits.

A fingerprint sums the bits of the XXH64 hashes of a document's word shingles. All pairs
of different fingerprints within `max_bits` (t) bits are found by pigeonring filtering.
The 64 bits are a ring of t + 1 segments. If two fingerprints differ in at most t bits,
some segment starts a chain in which the first l segments differ in at most
floor(l * t / (t + 1)) = l - 1 bits, for every l. So candidates

1. agree in the first segment of a chain, the key they are partitioned by;
2. differ in at most one bit in the second;
3. and so on round the ring; what passes the whole chain is checked in full.

A bucket (first segment) with more than `BUCKET` fingerprints is dealt again by the second
segment: each fingerprint goes to its own value and to all values one bit away, so two
that keep rule 2 meet. If that is still too many, the third segment is dealt alike: the
chain leaves either two bits there and none in the second, or one in each, so pairs still
meet, and with t = 2 such a bucket cannot hold more than (1 + 22) * (1 + 22) fingerprints. No
pair is dropped at any size.

A bucket gives the links that join its parts (a spanning forest), not all pairs, so the
links grow with the fingerprints and not with their square. Equal fingerprints are one node.

Defined cases
  * null text: as empty; no words: fingerprint 0, linked like any other;
  * fewer words than a shingle: the whole sequence is one;
  * null or repeated ids: every row is a document of its own; no rows: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.components import connected_components
from millrace.session import materialise

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
# Fingerprints of a bucket that are compared with one another.
BUCKET = 1024
_HASH_ROWS = 1 << 16


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """The SimHash of a text's word shingles, repeats included; 0 without words."""
    from xxhash import xxh64_intdigest as digest

    words = text.lower().split()  # of bytes: A-Z, and the six ASCII white space characters
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(shingle_words, len(words))
    spans = zip(starts[:len(words) - k + 1].tolist(), ends[k - 1:].tolist(), strict=True)
    hashes = np.array([digest(joined[a:b], seed) for a, b in spans], "<u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _HASH_ROWS):
        part = hashes[at:at + _HASH_ROWS].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def simhash(
    docs: DataFrame, shingle_words: int = SHINGLE_WORDS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Id and fingerprint (64 bits as a signed bigint) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py() or b"", shingle_words, seed) for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=[id_col, "fingerprint"])

    kept = docs.select(F.col(id_col), F.col(text_col).cast("string").cast("binary"))
    return kept.mapInArrow(run, T.StructType([kept.schema[0], T.StructField("fingerprint", T.LongType())]))


def _segments(max_bits: int) -> list[tuple[int, int]]:
    """Shift and width of each segment of the ring."""
    edges = [round(64 * k / (max_bits + 1)) for k in range(max_bits + 2)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def _forest(found: np.ndarray, chain: np.ndarray, keys: np.ndarray, segments, max_bits: int) -> np.ndarray:
    """Links (pairs of row numbers) that join what is linked in each run of equal keys.

    Every row is compared with the row d places on, for growing d, all runs at once.
    """
    n = len(found)
    run_start = np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1)])
    run_end = np.append(np.flatnonzero(run_start)[1:], n)[np.cumsum(run_start) - 1]
    shifts, widths = np.array([s[0] for s in segments], np.uint64), np.array([s[1] for s in segments], np.uint64)
    parent, links, rows = np.arange(n), [], np.arange(n)
    for d in range(1, n):
        rows = rows[rows + d < run_end[rows]]
        if not len(rows):
            break
        # a pair that is joined already needs no check
        left = rows[parent[rows] != parent[rows + d]]
        differ = found[left] ^ found[left + d]
        budget = np.zeros(len(left), np.int64)
        for step in range(max_bits + 1):
            segment = (chain[left] + step) % (max_bits + 1)
            bits = differ >> shifts[segment] & ((np.uint64(1) << widths[segment]) - np.uint64(1))
            budget = budget + np.bitwise_count(bits)
            keep = budget <= step
            left, differ, budget = left[keep], differ[keep], budget[keep]
        left = left[np.bitwise_count(differ) <= max_bits]
        joined = False
        for a in left.tolist():
            x, y = a, a + d
            while parent[x] != x:
                x = parent[x]
            while parent[y] != y:
                y = parent[y]
            if x != y:
                parent[max(x, y)] = min(x, y)
                links.append((a, a + d))
                joined = True
        while joined and (parent[parent] != parent).any():
            parent = parent[parent]
    return np.array(links, np.int64).reshape(-1, 2)


def _bucket_links(rows: DataFrame, segments, max_bits: int) -> DataFrame:
    """Links a, b inside the buckets of (chain, key, near, far)."""
    names = ["chain", "key", "near", "far"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            keys = np.stack([held.column(k).to_numpy() for k in names], axis=1)
            same = (keys == keys[-1]).all(axis=1)
            whole = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0  # rows before the last run
            if whole:
                yield links(held.slice(0, whole), keys[:whole])
                held = held.slice(whole)
        if held is not None:
            yield links(held, np.stack([held.column(k).to_numpy() for k in names], axis=1))

    def links(table: pa.Table, keys: np.ndarray) -> pa.RecordBatch:
        signed = table.column("fingerprint").to_numpy()
        found = _forest(signed.view(np.uint64), keys[:, 0], keys, segments, max_bits)
        return pa.RecordBatch.from_arrays([pa.array(signed[found[:, 0]]), pa.array(signed[found[:, 1]])], names=["a", "b"])

    dealt = rows.select(*names, "fingerprint").repartition(*names).sortWithinPartitions(*names, "fingerprint")
    return dealt.mapInArrow(run, "a long, b long")


def _split(rows: DataFrame, names: list[str], bucket: int) -> tuple[DataFrame, DataFrame]:
    """The rows of buckets of 2 to `bucket` rows, and those of larger ones."""
    counted = materialise(rows.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "buckets")
    marked = rows.join(counted, names)
    return marked.where(F.col("n") <= bucket).drop("n"), marked.where(F.col("n") > bucket).drop("n")


def _dealt(rows: DataFrame, name: str, segments, step: int) -> DataFrame:
    """Each row at its own value of the segment `step` places on, and at all values one bit away."""
    choices = []
    for chain in range(len(segments)):
        shift, width = segments[(chain + step) % len(segments)]
        own = F.shiftrightunsigned("fingerprint", shift).bitwiseAND(F.lit((1 << width) - 1))
        near = F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda b, own=own: own.bitwiseXOR(
            F.call_function("shiftleft", F.lit(1).cast("bigint"), b)))
        choices.append(F.when(F.col("chain") == chain, F.concat(F.array(own), near)))
    return rows.withColumn(name, F.explode(F.coalesce(*choices)))


def fingerprint_links(fingerprints: DataFrame, max_bits: int = MAX_BITS, bucket: int = BUCKET) -> DataFrame:
    """Links a, b between different fingerprints; they join exactly what lies within `max_bits`.

    `fingerprints` has distinct values in the column `fingerprint`.
    """
    segments = _segments(max_bits)
    keys = [F.struct(F.lit(c).cast("bigint").alias("chain"), F.shiftrightunsigned("fingerprint", shift).bitwiseAND(
        F.lit((1 << width) - 1)).alias("key")) for c, (shift, width) in enumerate(segments)]
    empty = F.lit(-1).cast("bigint")
    rows = (
        fingerprints.select("fingerprint", F.explode(F.array(*keys)).alias("k"))
        .select("fingerprint", "k.chain", "k.key", empty.alias("near"), empty.alias("far"))
    )
    links = []
    for name, names, step in (("near", ["chain", "key"], 1), ("far", ["chain", "key", "near"], 2)):
        small, large = _split(rows, names, bucket)
        links.append(_bucket_links(small, segments, max_bits))
        rows = materialise(large, "large-buckets")
        if rows.isEmpty():
            break
        if step == len(segments):
            links.append(_bucket_links(rows, segments, max_bits))
            break
        rows = _dealt(rows, name, segments, step)
    else:
        links.append(_bucket_links(rows, segments, max_bits))
    found = links[0]
    for more in links[1:]:
        found = found.unionByName(more)
    return found


def simhash_groups(
    docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, seed: int = SEED,
    id_col: str = "doc_id", text_col: str = "text", bucket: int = BUCKET,
) -> DataFrame:
    """Id, fingerprint (16 hex digits) and component_id (smallest id reachable over links) of every row."""
    found = materialise(simhash(docs, shingle_words, seed, id_col, text_col).withColumnRenamed(id_col, "id"), "fingerprints")
    distinct = materialise(found.groupBy("fingerprint").agg(F.min("id").alias("first")), "distinct")
    roots = connected_components(fingerprint_links(distinct, max_bits, bucket))
    rooted = distinct.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").withColumn(
        "root", F.coalesce("root", "fingerprint"))
    first = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    groups = rooted.join(first, "root").select("fingerprint", "component_id")
    return found.join(groups, "fingerprint").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")
