"""Ranked lexical search: summed accumulators of short lists beside document-at-a-time skipping of long ones.

Every item (a text) is a query over all documents. Scores are sums over the item's terms, repeats included, of

    w * ((1000000000 * tf) div (1000 * tf + 12 * m))

in 64-bit integers, with w = floor(1000 * ln((2N + 2) / (2df + 1))) and m = 100 - 25 + ((25 * n * N) div L): N documents
with terms, L terms in all, n terms of the document, df documents with the term, tf its occurrences in the document.

1. `index_documents` reads every document once and writes shards: the postings of the terms that are asked for,
   of a run of documents, and what N, L and df need. Nothing is shuffled; a task's documents become its shards.
2. N, L and df are aggregates over the shards.
3. `_Shard` answers all queries. The lists of rare terms (together at most `SHORT` of the shard's documents)
   are summed term at a time; the accumulators, in document order, are then one more list with a bound of its own.
   This list and the long lists are walked document at a time in blocks of `BLOCK` documents. A block is skipped if the
   sum of its lists' largest values does not reach the k-th best score so far. In a block, the lists with the
   smallest values that together do not reach it only complete documents that other lists propose, and a
   document is given up as soon as what is left cannot lift it to the k-th best.
4. A task keeps the best k of each query over its shards; a window decides over the tasks.

Bounds are exact integers, so no document of the answer is skipped; equal scores are never skipped either, as the
smaller id wins. Items are asked in blocks of about `ITEM_BYTES` of text; the terms of one block are broadcast.

Defined cases
  * null or termless documents are not counted; null or termless items have no rows;
  * null or repeated ids: every row is a document, or an item, of its own; among equal scores nulls come last;
  * scores of 0 are left out; fewer documents than k: all of them; no documents or items: no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import materialise

TOP = 20
# Bytes of item texts that are asked at once.
ITEM_BYTES = 4_000_000
# Documents and postings of a written shard, and of the shards that are searched as one.
SHARD_DOCS = 20_000
SHARD_POSTINGS = 500_000
SEARCH_POSTINGS = 4_000_000
# Share of a shard's documents up to which the rarest terms of a query are summed term at a time.
SHORT = 0.1
# Documents of a block that is skipped or scored as one.
BLOCK = 1024

# Terms are runs of ASCII letters, digits and all that is not ASCII; only A-Z change. In UTF-8 that is a table of bytes.
_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms(text: bytes | None) -> list[bytes]:
    """The terms of a UTF-8 text in order, repeats included."""
    return text.translate(_BYTES).split() if text else []


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _utf8(column: str):
    return F.col(column).cast("string").cast("binary")


# ------------------------------------------------------------------ index


def index_documents(docs: DataFrame, wanted: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """Shards: ids and lengths (terms) of documents, n_docs and n_terms of all read, postings of the wanted terms.

    `postings` of term number terms[i] are counts[i] places in `ids`, ascending, with their `tfs`.
    """
    source = docs.select(F.col(id_col).alias("id"), _utf8(text_col).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    known = source.sparkSession.sparkContext.broadcast(wanted)
    schema = (f"ids array<{kind}>, lengths array<bigint>, n_docs bigint, n_terms bigint, "
              "terms array<int>, counts array<int>, postings array<int>, tfs array<int>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = known.value.get
        arrow, ids, lengths, hits, sizes, n_docs, n_terms = None, [], [], [], [], 0, 0

        def shard() -> pa.RecordBatch:
            nonlocal n_docs, n_terms
            order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i]))
            place = np.empty(len(ids), np.int64)
            place[order] = np.arange(len(ids))
            key, tf = np.unique(
                np.array(hits, np.int64) * max(1, len(ids)) + np.repeat(place, np.array(sizes, np.int64)), return_counts=True)
            term, posting = np.divmod(key, max(1, len(ids)))
            found, counts = np.unique(term, return_counts=True)
            row = [[ids[i] for i in order], [lengths[i] for i in order], n_docs, n_terms, found, counts, posting, tf]
            types = [pa.list_(arrow), pa.list_(pa.int64()), pa.int64(), pa.int64(), *[pa.list_(pa.int32())] * 4]
            out = pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types, strict=True)], names=names)
            for column in (ids, lengths, hits, sizes):
                column.clear()
            n_docs = n_terms = 0
            return out

        for batch in batches:
            arrow = batch.schema.field("id").type
            for own, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = terms(text.as_py())
                if not words:
                    continue
                n_docs, n_terms = n_docs + 1, n_terms + len(words)
                asked = [t for t in map(number, words) if t is not None]
                if asked:
                    ids.append(own)
                    lengths.append(len(words))
                    hits += asked
                    sizes.append(len(asked))
                if len(ids) >= SHARD_DOCS or len(hits) >= SHARD_POSTINGS:
                    yield shard()
        if n_docs:
            yield shard()

    names = [field.split()[0] for field in schema.split(", ")]
    return source.mapInArrow(run, schema)


# ------------------------------------------------------------------ search


class _List:
    """Documents in order with their values, the largest value, and the largest and the cuts of each block."""

    __slots__ = ("docs", "values", "cuts", "most")

    def __init__(self, docs: np.ndarray, values: np.ndarray, edges: np.ndarray):
        self.docs, self.values = docs, values
        self.cuts = np.searchsorted(docs, edges)
        self.most = np.zeros(len(edges) - 1, np.int64)
        some = self.cuts[1:] > self.cuts[:-1]
        if some.any():
            self.most[some] = np.maximum.reduceat(values, self.cuts[:-1][some])


def best_documents(lists: list[tuple[np.ndarray, np.ndarray, _List | None]], n_docs: int, k: int, least: int, block: int = BLOCK,
                   short: float = SHORT) -> tuple[np.ndarray, np.ndarray]:
    """Places and scores of documents of the shard, among them the best k of those that score at least `least`.

    Each list has documents in order and positive values; a list may come with its blocks worked out.
    """
    edges = np.arange(0, n_docs + block, block)
    lists = sorted(lists, key=lambda x: len(x[0]))
    total, cut = 0, 0
    while cut < len(lists) and total + len(lists[cut][0]) <= max(short * n_docs, 1):
        total += len(lists[cut][0])
        cut += 1
    iterators = []
    best_docs, best_scores = np.empty(0, np.int64), np.empty(0, np.int64)
    if cut:
        # term at a time: the short lists become one list of accumulators
        docs, place = np.unique(np.concatenate([x[0] for x in lists[:cut]]), return_inverse=True)
        sums = np.zeros(len(docs), np.int64)
        np.add.at(sums, place, np.concatenate([x[1] for x in lists[:cut]]))
        iterators.append(_List(docs, sums, edges))
        if len(sums) >= k:
            # a part of a score: the k-th best of all documents scores at least as much
            least = max(least, int(np.partition(sums, -k)[-k]))
    iterators += [known or _List(docs, values, edges) for docs, values, known in lists[cut:]]
    if not iterators:
        return best_docs, best_scores
    bounds = np.stack([x.most for x in iterators])
    reach = bounds.sum(axis=0)
    at = 0
    while True:
        open_ = np.flatnonzero((reach[at:] >= least) & (reach[at:] > 0))
        if not len(open_):
            return best_docs, best_scores
        at += int(open_[0])
        order = np.argsort(bounds[:, at], kind="stable")
        sums = np.cumsum(bounds[order, at])
        first = int(np.searchsorted(sums, least, side="left"))  # lists before it cannot propose a document by themselves
        proposing = [iterators[i] for i in order[first:]]
        parts = [(x.docs[x.cuts[at]:x.cuts[at + 1]], x.values[x.cuts[at]:x.cuts[at + 1]]) for x in proposing]
        scores = np.zeros(block, np.int64)
        held = np.zeros(block, bool)
        for docs, values in parts:
            inside = docs - at * block
            scores[inside] += values
            held[inside] = True
        own = np.flatnonzero(held)
        scores = scores[own]
        for i in range(first - 1, -1, -1):
            alive = scores + sums[i] >= least
            own, scores = own[alive], scores[alive]
            x = iterators[order[i]]
            docs = x.docs[x.cuts[at]:x.cuts[at + 1]] - at * block
            if len(docs) and len(own):
                place = np.minimum(np.searchsorted(docs, own), len(docs) - 1)
                scores = scores + np.where(docs[place] == own, x.values[x.cuts[at]:x.cuts[at + 1]][place], 0)
        good = scores >= max(least, 1)
        if good.any():
            best_docs = np.concatenate([best_docs, own[good] + at * block])
            best_scores = np.concatenate([best_scores, scores[good]])
            if len(best_scores) >= k:
                least = max(least, int(np.partition(best_scores, -k)[-k]))
                stay = best_scores >= least
                best_docs, best_scores = best_docs[stay], best_scores[stay]
        at += 1


class _Shard:
    """Postings of documents in the order of their ids, with the value of each."""

    def __init__(self, packets: list[dict], weights: np.ndarray, n_docs: int, n_terms: int):
        ids = [i for p in packets for i in p["ids"]]
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i]))
        self.ids = [ids[i] for i in order]
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        starts = np.cumsum([0, *(len(p["ids"]) for p in packets)])
        n = np.concatenate([np.array(p["lengths"], object) for p in packets])[order]
        # whole numbers of any size: n * N may be large
        self.m = np.array([75 + 25 * int(x) * n_docs // n_terms for x in n], np.int64)
        term = np.concatenate([np.repeat(p["terms"], p["counts"]) for p in packets]).astype(np.int64)
        docs = np.concatenate([place[np.asarray(p["postings"], np.int64) + s] for p, s in zip(packets, starts, strict=False)])
        tf = np.concatenate([p["tfs"] for p in packets]).astype(np.int64)
        by_term = np.lexsort((docs, term))
        term, self.docs, tf = term[by_term], docs[by_term], tf[by_term]
        self.values = weights[term] * (1_000_000_000 * tf // (1000 * tf + 12 * self.m[self.docs]))
        self.weights, self.cuts = weights, np.searchsorted(term, np.arange(len(weights) + 1))
        self.edges = np.arange(0, len(ids) + BLOCK, BLOCK)
        self.blocks: dict[int, _List] = {}

    def answer(self, query: list[tuple[int, int]], k: int, least: int) -> list[tuple[int, object]]:
        """(score, id) of documents that may be among the best k."""
        lists = []
        for term, repeats in query:
            a, b = self.cuts[term], self.cuts[term + 1]
            if a == b or not self.weights[term]:
                continue
            docs, values = self.docs[a:b], self.values[a:b]
            if repeats > 1:
                lists.append((docs, values * repeats, None))
                continue
            if term not in self.blocks and b - a > SHORT * len(self.ids):
                self.blocks[term] = _List(docs, values, self.edges)
            lists.append((docs, values, self.blocks.get(term)))
        places, scores = best_documents(lists, len(self.ids), k, least)
        return [(score, self.ids[p]) for p, score in zip(places.tolist(), scores.tolist(), strict=True)]


def _by_rank(hit: tuple[int, object]) -> tuple:
    return -hit[0], hit[1] is None, hit[1]


def _search(shards: DataFrame, queries: list[tuple[int, list[tuple[int, int]]]], weights: np.ndarray, n_docs: int, n_terms: int,
            k: int, id_type: str) -> DataFrame:
    asked = shards.sparkSession.sparkContext.broadcast((queries, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_queries, own_weights = asked.value
        best: dict[int, list[tuple[int, object]]] = {item: [] for item, _ in own_queries}
        held, size, arrow = [], 0, None

        def work():
            shard = _Shard(held, own_weights, n_docs, n_terms)
            for item, query in own_queries:
                so_far = best[item]
                least = so_far[k - 1][0] if len(so_far) >= k else 1
                found = shard.answer(query, k, least)
                if found:
                    best[item] = sorted(so_far + found, key=_by_rank)[:k]
            held.clear()

        for batch in batches:
            arrow = batch.schema.field("ids").type.value_type
            for i in range(batch.num_rows):
                packet = {name: batch.column(name)[i].values for name in ("ids", "lengths", "terms", "counts", "postings", "tfs")}
                if not len(packet["ids"]):
                    continue
                held.append({n: v.to_pylist() if n == "ids" else v.to_numpy(zero_copy_only=False) for n, v in packet.items()})
                size += len(packet["postings"])
                if size >= SEARCH_POSTINGS:
                    work()
                    size = 0
        if held:
            work()
        hits = [(item, own, score) for item, found in best.items() for score, own in found]
        if hits:
            columns = list(zip(*hits, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), arrow, pa.int64()), strict=True)],
                names=["item", "id", "score"])

    return shards.select("ids", "lengths", "terms", "counts", "postings", "tfs").mapInArrow(
        run, f"item bigint, id {id_type}, score bigint")


def _queries(items: DataFrame) -> tuple[list[tuple[int, list[tuple[int, int]]]], dict[bytes, int]]:
    """The terms, with repeats, of a block of items (item, text), and a number for each term."""
    numbers: dict[bytes, int] = {}
    queries = []
    for row in items.where("text is not null").orderBy("item").collect():  # a block has a bounded size
        counts: dict[int, int] = {}
        for term in terms(bytes(row["text"])):
            number = numbers.setdefault(term, len(numbers))
            counts[number] = counts.get(number, 0) + 1
        if counts:
            queries.append((row["item"], list(counts.items())))
    return queries, numbers


def search_ranked(
    docs: DataFrame, items: DataFrame, k: int = TOP, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", item_bytes: int = ITEM_BYTES,
) -> DataFrame:
    """Item id, rank (from 1), document id and score of the best k documents of each item."""
    asked = materialise(items.select(
        F.monotonically_increasing_id().alias("item"), F.col(item_col).alias("item_id"), _utf8(item_text_col).alias("text")), "items")
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // item_bytes))
    id_type = docs.schema[id_col].dataType.simpleString()
    found = None
    for block in range(blocks):
        queries, numbers = _queries(asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block))
        if not queries:
            continue
        shards = materialise(index_documents(docs, numbers, id_col, text_col), "shards")
        n_docs, n_terms = shards.agg(F.sum("n_docs"), F.sum("n_terms")).first()
        if not n_docs:
            break
        frequencies = shards.select(F.explode(F.arrays_zip("terms", "counts")).alias("t")).groupBy("t.terms").agg(
            F.sum("t.counts").alias("df")).collect()  # one row for each term of the block
        weights = np.zeros(len(numbers), np.int64)
        for term, df in frequencies:
            weights[term] = weight(n_docs, df)
        hits = _search(shards, queries, weights, n_docs, n_terms, k, id_type)
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        found = docs.sparkSession.createDataFrame([], f"item bigint, id {id_type}, score bigint")
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.join(asked.select("item", "item_id"), "item").select(
        F.col("item_id").alias(item_col), "rank", F.col("id").alias(id_col), "score")
