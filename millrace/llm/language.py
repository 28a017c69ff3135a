"""Language identification by interpolated Kneser-Ney character models, one for each language.

A text is read as its words: runs of letters, lower-cased, each after and before a space. A model gives the
probability of every letter, and of the space that ends a word, from up to `ORDER` - 1 characters before it in the word:

    p(c | h) = max(a(hc) - D, 0) / A(h) + g(h) * p(c | h without its first character)

a(g) counts g itself if it is of the highest order or begins a word, else the different characters before it; A(h) is
the sum of a(hc), D = n1 / (n1 + 2 n2) from the numbers of grams with a = 1 and 2, and g(h) what the first
terms leave. Below single characters lies an even share for each character and an unknown one.

1. `count_grams` reads all labelled documents. A task takes words out of many texts at once, as one Arrow array, and counts
   the longest grams of the different ones; sums over the tasks, and over the ends of these grams, are a table of
   (language, gram).
2. `fit_models` works the formula out by aggregates and joins on that table. A gram is written to the model
   if its share of the language's characters is at least `SHARE`, whatever the size of the corpus. So a language has at
   most ORDER / SHARE grams, and what is left out counts through g(h). Rarer grams still count in a, A and D.
3. A model is a pair of arrays sorted by the hash of the gram. Blocks of languages with at most `BLOCK_GRAMS` grams, counted
   before, go to all tasks.
4. The language with the lowest cross-entropy per character is chosen. A task sums up each different word once, and
   looks up each different gram of its new words once. Repeated words stay numbers: they never become Python strings.
5. Calibration. Models of all but one part of the labelled documents score that part. Its cross-entropies give, for each
   language, mean and variance (a part that falls with the length of the text and one that does not) and the
   standardised value that a share `REJECT` of them exceeds; texts beyond it are rejected. The
   score is the posterior over the languages at the temperature under which that part is likeliest, and falls
   for rejected texts with the surplus. The models that are applied then learn from all labelled documents.

Defined cases
  * null text, no letter, or no labelled documents: `und`, score 0, entropy null, rejected;
  * null labels teach nothing, nor do documents with a null id or of the held-out part; any other value is a language;
  * runs of more than `WORD_LETTERS` letters are read as words of that length; nothing is left out;
  * null or repeated ids: every row gets a result; no rows: no rows; of equal entropies the smaller name wins.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.vectors import matrix
from millrace.session import fetch_bounded, materialise

ORDER = 5
# Least share of a language's characters that a gram of the model has.
SHARE = 2e-6
# Grams of the languages that go to the tasks at once.
BLOCK_GRAMS = 4_000_000
# Share of texts of a language that may be rejected.
REJECT = 0.005
WORD_LETTERS = 48
UNKNOWN = "und"
# Characters that are read at once, unless one text has more.
_HELD_CHARS = 2_000_000
# Different grams a task holds while counting, and cells (words x languages) it remembers while scoring.
_HELD_GRAMS = 400_000
_CELLS = 2_000_000
_TEMPERATURES = 2.0 ** np.arange(-6, 8)
_SPACE = 32
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                     0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


@cache
def _kinds() -> np.ndarray:
    """1 for each code point that is a letter, 2 for a mark, else 0."""
    every, kinds = "".join(map(chr, range(0x110000))), np.zeros(0x110000, np.uint8)
    for kind, name in enumerate("LM", 1):
        for run in regex.finditer(rf"\p{{{name}}}+", every):
            kinds[run.start():run.end()] = kind
    return kinds


def word_array(texts: list[str | None]) -> tuple[pa.LargeStringArray, np.ndarray]:
    """The words of all texts, each with a space after it, and their number in each text.

    A word is a letter and the letters and marks after it, lower-cased; long ones come in parts.
    """
    lowered = [t.lower() if t else "" for t in texts]
    points = _points("\n".join([*lowered, ""]))
    kinds = _kinds()[points]
    inside = kinds > 0
    if (kinds == 2).any():
        # marks count as what stands before them
        last = np.maximum.accumulate(np.where(kinds == 2, 0, np.arange(len(kinds))))
        inside = kinds[last] == 1
    after = np.zeros(len(inside), bool)
    after[1:] = inside[:-1] & ~inside[1:]
    sizes = np.fromiter(map(len, lowered), np.int64, len(lowered)) + 1
    n_words = np.diff(np.searchsorted(np.flatnonzero(after), np.cumsum(sizes)), prepend=0)
    kept = inside | after
    points = points[kept]
    points[after[kept]] = _SPACE
    ends = np.flatnonzero(points == _SPACE)
    lengths = np.diff(ends, prepend=-1) - 1
    if lengths.max(initial=0) > WORD_LETTERS:
        place = np.arange(len(points)) - np.repeat(ends - lengths, lengths + 1)
        cuts = np.flatnonzero((place > 0) & (place % WORD_LETTERS == 0) & (points != _SPACE))
        parts = np.searchsorted(cuts, ends)  # cuts up to the end of each word
        n_words = np.diff(np.concatenate([[0], np.arange(1, len(ends) + 1) + parts])[np.cumsum(n_words)], prepend=0)
        points = np.insert(points, cuts, _SPACE)
    return _spaced(points), n_words


def _spaced(points: np.ndarray) -> pa.LargeStringArray:
    """The strings of code points that end in a space each."""
    data = points.tobytes().decode("utf-32-le").encode()
    ends = np.flatnonzero(np.frombuffer(data, np.uint8) == _SPACE) + 1
    return pa.LargeStringArray.from_buffers(len(ends), pa.py_buffer(np.concatenate([[0], ends]).astype(np.int64)), pa.py_buffer(data))


def _strings(spaced: pa.LargeStringArray) -> list[str]:
    """The strings of a whole array, without the space that ends each."""
    return spaced.buffers()[2].to_pybytes().decode().split(" ")[:-1] if len(spaced) else []


def words(text: str) -> list[str]:
    """The words of a text: lower-cased runs of letters, long ones in parts."""
    return _strings(word_array([text])[0])


def _places(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of words with one space before the first and after each: every character's place in its word, from 1 for the first
    letter to the space after it (0: the first space), and where words start."""
    ends = np.flatnonzero(points == _SPACE)
    starts = ends[:-1] + 1
    return np.concatenate([[0], np.arange(1, len(points)) - np.repeat(ends[:-1], np.diff(ends))]), starts


def gram_array(some: list[str], order: int = ORDER) -> tuple[pa.LargeStringArray, np.ndarray]:
    """The longest gram that ends at each letter and at the end of each word, one after another, and their number of each word."""
    points = _points(" ".join(["", *some, ""]) if some else " ")
    place, starts = _places(points)
    ends = np.arange(1, len(points))
    sizes = np.minimum(place[1:] + 1, order)
    offsets = np.cumsum(sizes) - sizes
    at = np.arange(int(sizes.sum())) + np.repeat(ends - sizes + 1 - offsets, sizes)
    data = points[at]
    # bytes of the code points give the places of the grams among the encoded ones
    widths = 1 + (data > 0x7F) + (data > 0x7FF) + (data > 0xFFFF)
    cuts = np.concatenate([[0], np.cumsum(widths)])[np.concatenate([offsets, [len(data)]])].astype(np.int64)
    encoded = data.tobytes().decode("utf-32-le").encode()
    return pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(cuts), pa.py_buffer(encoded)), np.diff(starts, append=len(points))


def grams(word: str, order: int = ORDER) -> list[str]:
    """The longest gram that ends at each letter of the word and at its end."""
    return gram_array([word], order)[0].to_pylist()


def _held(column: pa.Array) -> Iterator[tuple[int, list[str | None]]]:
    """The texts of a column in lists of bounded size, each with the row of its first."""
    start, size, texts = 0, 0, []
    for at, text in enumerate(column, 1):
        texts.append(text.as_py())
        size += len(texts[-1] or "")
        if size > _HELD_CHARS or at == len(column):
            yield start, texts
            start, size, texts = at, 0, []


# ------------------------------------------------------------------ counting and fitting


def remainder(id_column: Column) -> Column:
    """crc32 of the id as text, modulo 5."""
    return F.crc32(id_column.cast("string").cast("binary")) % 5


def _count(texts: list[str], order: int) -> Iterator[tuple[str, int]]:
    """The different longest grams of texts, and how often each occurs."""
    coded = word_array(texts)[0].dictionary_encode()
    found, n_grams = gram_array(_strings(coded.dictionary), order)
    each = np.bincount(coded.indices.to_numpy(), minlength=len(coded.dictionary))
    different = found.dictionary_encode()
    # doubles are whole below 2 ** 53
    total = np.bincount(different.indices.to_numpy(), np.repeat(each, n_grams), len(different.dictionary)).astype(np.int64)
    return zip(different.dictionary.to_pylist(), total.tolist(), strict=True)


def count_grams(labelled: DataFrame, order: int = ORDER) -> DataFrame:
    """lang, gram, n and n_rest (occurrences outside the part for calibration) of documents (lang, part, text).

    Tasks count the longest gram at each place; grams of lower orders are their ends.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, bool], Counter[str]] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for (lang, part), total in held.items():
                n = len(total)
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * n, pa.string()), pa.array([part] * n, pa.bool_()), pa.array(list(total), pa.string()),
                    pa.array(list(total.values()), pa.int64())], names=["lang", "part", "gram", "n"])
            held.clear()

        for batch in batches:
            langs, parts = (c.to_pylist() for c in batch.columns[:2])
            for at, texts in _held(batch.column(2)):
                groups: dict[tuple[str, bool], list[str]] = {}
                for lang, part, text in zip(langs[at:at + len(texts)], parts[at:at + len(texts)], texts, strict=True):
                    groups.setdefault((lang, part), []).append(text)
                for group, own in groups.items():
                    total = held.setdefault(group, Counter())
                    for gram, n in _count(own, order):
                        total[gram] += n
                if sum(map(len, held.values())) > _HELD_GRAMS:
                    yield from flush()
        yield from flush()

    found = labelled.select("lang", "part", "text").mapInArrow(run, "lang string, part boolean, gram string, n bigint")
    longest = found.groupBy("lang", "gram").agg(
        F.sum("n").alias("n"), F.sum(F.when(~F.col("part"), F.col("n")).otherwise(0)).alias("n_rest"))
    ends = F.transform(F.sequence(F.lit(1), F.length("gram")), lambda at: F.col("gram").substr(at, F.length("gram")))
    return longest.select("lang", F.explode(ends).alias("gram"), "n", "n_rest").groupBy("lang", "gram").agg(
        F.sum("n").alias("n"), F.sum("n_rest").alias("n_rest"))


def fit_models(counts: DataFrame, order: int = ORDER, share: float = SHARE) -> tuple[DataFrame, int]:
    """lang, gram, log_p and log_rest (of the gram as what stands before) from (lang, gram, n), and the number of characters.

    The empty gram of a language holds its log_rest alone.
    """
    size = F.length("gram")
    n_chars = counts.where(size == 1).select("gram").distinct().count()
    before = counts.where(size > 1).groupBy("lang", F.expr("substring(gram, 2)").alias("gram")).agg(F.count(F.lit(1)).alias("before"))
    own_count = (size == order) | ((size > 1) & F.col("gram").startswith(" "))
    totals = counts.where(size == 1).groupBy("lang").agg(F.sum("n").alias("total"))
    table = counts.join(before, ["lang", "gram"], "left").join(totals, "lang").select(
        "lang", "gram", size.alias("size"), F.when(own_count, F.col("n")).otherwise(F.col("before")).cast("double").alias("a"),
        (F.col("n") >= F.lit(share) * F.col("total")).alias("kept"), F.expr("substring(gram, 1, length(gram) - 1)").alias("context"))
    once, twice = (F.sum((F.col("a") == k).cast("int")) for k in (1, 2))
    discounts = table.groupBy("lang", "size").agg(F.when(once > 0, once / (once + 2 * twice)).otherwise(F.lit(0.5)).alias("d"))
    table = materialise(table.join(discounts.withColumn("d", F.least("d", F.lit(0.95))), ["lang", "size"]).withColumn(
        "above", F.greatest(F.col("a") - F.col("d"), F.lit(0.0))), "grams")
    contexts = materialise(table.groupBy("lang", "context").agg(
        F.sum("a").alias("whole"), F.sum(F.when(F.col("kept"), F.col("above")).otherwise(F.lit(0.0))).alias("taken")).select(
            "lang", "context", "whole", (F.lit(1.0) - F.col("taken") / F.col("whole")).alias("rest")), "contexts")
    grown = table.where("kept").join(contexts, ["lang", "context"]).select(
        "lang", "gram", "size", (F.col("above") / F.col("whole")).alias("first"), "rest", F.expr("substring(gram, 2)").alias("lower"))
    grown = materialise(grown, "terms")
    fitted, last = None, None
    for n in range(1, order + 1):
        own = grown.where(F.col("size") == n)
        if last is None:
            found = own.select("lang", "gram", (F.col("first") + F.col("rest") / (n_chars + 1)).alias("p"))
        else:
            lower = last.select("lang", F.col("gram").alias("lower"), F.col("p").alias("p_lower"))
            found = own.join(lower, ["lang", "lower"]).select("lang", "gram", (F.col("first") + F.col("rest") * F.col("p_lower")).alias("p"))
        last = materialise(found, f"order-{n}")
        fitted = last if fitted is None else fitted.unionByName(last)
    rests = contexts.select("lang", F.col("context").alias("gram"), F.log(F.greatest("rest", F.lit(1e-12))).alias("log_rest"))
    models = fitted.select("lang", "gram", F.log("p").alias("log_p")).join(rests, ["lang", "gram"], "left").select(
        "lang", "gram", "log_p", F.coalesce("log_rest", F.lit(0.0)).alias("log_rest"))
    empty = rests.where("gram = ''").select("lang", "gram", F.lit(None).cast("double").alias("log_p"), "log_rest")
    return materialise(models.unionByName(empty), "models"), n_chars


# ------------------------------------------------------------------ scoring


def gram_hashes(points: np.ndarray, order: int) -> list[np.ndarray]:
    """For each order the hash of the gram that ends at each code point; those that reach before the first are void."""
    points = points.astype(np.uint64) + np.uint64(1)
    total, found = np.zeros(len(points), np.uint64), []
    for n in range(order):
        shifted = np.zeros(len(points), np.uint64)
        shifted[n:] = points[:max(0, len(points) - n)]
        total = total + shifted * _FACTORS[n]
        mixed = (total ^ (total >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(n)
        found.append(mixed ^ (mixed >> np.uint64(32)))
    return found


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


@dataclass
class Model:
    """A language's grams as arrays sorted by hash; the log of what is left for single characters and of their even share."""

    hashes: np.ndarray
    log_p: np.ndarray
    log_rest: np.ndarray
    floor: float

    @staticmethod
    def of(found: list[str], log_p: np.ndarray, log_rest: np.ndarray, n_chars: int, order: int = ORDER) -> Model:
        sizes = np.array([len(g) for g in found])
        hashes = np.zeros(len(found), np.uint64)
        for n in range(1, order + 1):
            own = np.flatnonzero(sizes == n)
            if len(own):
                points = _points("".join([found[i] for i in own]))
                hashes[own] = gram_hashes(points, n)[n - 1][n - 1::n]
        empty = np.flatnonzero(sizes == 0)
        floor = float(log_rest[empty[0]]) - float(np.log(n_chars + 1)) if len(empty) else -float(np.log(n_chars + 1))
        keep = np.flatnonzero(sizes > 0)
        keep = keep[np.argsort(hashes[keep], kind="stable")]
        return Model(hashes[keep], log_p[keep].astype(np.float32), log_rest[keep].astype(np.float32), floor)

    def _find(self, wanted: np.ndarray, there: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.full(len(wanted), -1)
        at = np.minimum(np.searchsorted(self.hashes, wanted), len(self.hashes) - 1)
        return np.where(there & (self.hashes[at] == wanted), at, -1)

    def logs(self, hashes: list[np.ndarray], place: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The log probability of the characters `at`; `place` is each one's place in its word, 0 for the space before it."""
        log_p, inside = np.full(len(at), self.floor), place[at]
        for n, wanted in enumerate(hashes, 1):
            if n > 1:
                # what stands before leaves this much to the order below
                found = self._find(hashes[n - 2][at - 1], inside >= n - 1)
                log_p = log_p + np.where(found >= 0, self.log_rest[found] if len(self.log_rest) else 0.0, 0.0)
            found = self._find(wanted[at], inside >= n - 1)
            log_p = np.where(found >= 0, self.log_p[found] if len(self.log_p) else 0.0, log_p)
        return log_p


class Scorer:
    """Sums of log probabilities of words under all models of a block, remembered word by word."""

    def __init__(self, models: list[Model], order: int = ORDER):
        self.models, self.order = models, order
        self.known: dict[str, int] = {}
        self.values = np.empty((0, len(models)), np.float64)
        # the different longest grams seen so far, in order of their hashes
        self.gram_keys, self.gram_logs = np.empty(0, np.uint64), np.empty((0, len(models)))

    def score_words(self, new: list[str]) -> np.ndarray:
        points = _points(" ".join(["", *new, ""]))
        place, starts = _places(points)
        hashes = gram_hashes(points, self.order)
        # a character's probability depends on the longest gram that ends at it: each different one is looked up once
        longest = np.choose(np.minimum(place, self.order - 1), hashes) + place.clip(max=self.order).astype(np.uint64)
        coded = pa.array(longest[1:]).dictionary_encode()
        keys, which = coded.dictionary.to_numpy(), coded.indices.to_numpy()
        first = np.empty(len(keys), np.int64)
        first[which[::-1]] = np.arange(len(longest) - 1, 0, -1)
        logs = self._gram_logs(keys, first, hashes, place)
        return np.add.reduceat(logs[which], starts - 1, axis=0)

    def _gram_logs(self, keys: np.ndarray, first: np.ndarray, hashes: list[np.ndarray], place: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.gram_keys, keys), max(len(self.gram_keys) - 1, 0))
        new = self.gram_keys[at] != keys if len(self.gram_keys) else np.ones(len(keys), bool)
        if new.any():
            own = first[new]
            found = np.stack([m.logs(hashes, place, own) for m in self.models], axis=1)
            if (len(self.gram_keys) + len(own)) * max(1, len(self.models)) > _CELLS and len(self.gram_keys):
                self.gram_keys, self.gram_logs = self.gram_keys[:0], self.gram_logs[:0]
                return self._gram_logs(keys, first, hashes, place)
            every = np.concatenate([self.gram_keys, keys[new]])
            order = np.argsort(every, kind="stable")
            self.gram_keys, self.gram_logs = every[order], np.concatenate([self.gram_logs, found])[order]
            at = np.searchsorted(self.gram_keys, keys)
        return self.gram_logs[at]

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Characters of each text, and its cross-entropy per character under each model."""
        found, n_words = word_array(texts)
        coded = found.dictionary_encode()
        different = _strings(coded.dictionary)
        if len(self.known) * max(1, len(self.models)) > _CELLS:
            self.known, self.values = {}, self.values[:0]
        new = [w for w in different if w not in self.known]
        parts = [self.values]
        for at in range(0, len(new), 100_000):
            some = new[at:at + 100_000]
            self.known.update(zip(some, range(len(self.known), len(self.known) + len(some)), strict=True))
            parts.append(self.score_words(some))
        self.values = np.concatenate(parts) if len(parts) > 1 else self.values
        sums, chars = np.zeros((len(texts), len(self.models))), np.zeros(len(texts), np.int64)
        some = np.flatnonzero(n_words)
        if len(some):
            own = np.fromiter(map(self.known.__getitem__, different), np.int64, len(different))
            which, starts = coded.indices.to_numpy(), (np.cumsum(n_words) - n_words)[some]
            sums[some] = np.add.reduceat(self.values[own][which], starts, axis=0)
            # each word counts with the space after it
            chars[some] = np.add.reduceat(np.fromiter(map(len, different), np.int64, len(different))[which] + 1, starts)
        return chars, -sums / np.maximum(chars, 1)[:, None]


def _blocks(models: DataFrame, block_grams: int) -> list[list[str]]:
    """Languages in order of their names, in blocks of bounded size."""
    sizes = fetch_bounded(models.groupBy("lang").count())
    if sizes is None:
        raise ValueError("more languages than a table of names may hold")
    blocks, room = [], 0
    for lang, n in sorted(tuple(r) for r in sizes):
        if not blocks or n > room:
            blocks.append([])
            room = block_grams
        blocks[-1].append(lang)
        room -= n
    return blocks


def _load(models: DataFrame, langs: list[str], n_chars: int, order: int) -> list[Model]:
    """The models of a block; at most about `BLOCK_GRAMS` grams reach the driver at once."""
    found = models.where(F.col("lang").isin(langs)).toArrow().sort_by([("lang", "ascending"), ("gram", "ascending")])
    names = found.column("lang").to_numpy(zero_copy_only=False)
    cuts = np.searchsorted(names.astype(str), np.array(langs))
    out = []
    for a, b in zip(cuts, [*cuts[1:], len(names)], strict=True):
        part = found.slice(int(a), int(b - a))
        out.append(Model.of(part.column("gram").to_pylist(), *(
            part.column(c).to_numpy(zero_copy_only=False) for c in ("log_p", "log_rest")), n_chars, order))
    return out


def _entropies(texts: DataFrame, models: list[Model], order: int) -> DataFrame:
    """The columns of `texts` but `text`, chars and the entropies under each model."""
    known = texts.sparkSession.sparkContext.broadcast(models)
    kept = [c for c in texts.columns if c != "text"]
    schema = ", ".join(f"{c} {texts.schema[c].dataType.simpleString()}" for c in kept)
    names = [*kept, "chars", "entropies"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(known.value, order)
        for batch in batches:
            for at, held in _held(batch.column(batch.num_columns - 1)):
                chars, found = scorer.entropies(held)
                lists = pa.FixedSizeListArray.from_arrays(pa.array(found.ravel()), len(known.value)).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(at, len(held)) for c in batch.columns[:-1]), pa.array(chars), lists], names=names)

    return texts.select(*kept, "text").mapInArrow(run, f"{schema}, chars bigint, entropies array<double>")


# ------------------------------------------------------------------ calibration


@dataclass(frozen=True)
class Calibration:
    """Temperature, and for each language mean, variance (fixed part, part over the length) and limit of the entropy."""

    temperature: float
    limits: dict[str, tuple[float, float, float, float]]

    def of(self, lang: str) -> tuple[float, float, float, float]:
        pooled = list(self.limits.values())
        if lang in self.limits or not pooled:
            return self.limits.get(lang, (0.0, 1.0, 1.0, float("inf")))
        return tuple(float(np.mean([p[k] for p in pooled])) for k in range(4))


def _likelihoods(scored: DataFrame, langs: list[str]) -> DataFrame:
    """lang, chars, its entropy, and the log posterior of that language at each temperature."""
    place = {lang: k for k, lang in enumerate(langs)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            found = matrix(batch.column("entropies"))
            chars = batch.column("chars").to_numpy()
            own = np.array([place[x] for x in batch.column("lang").to_pylist()])
            gaps = (found - found.min(axis=1, keepdims=True)) * np.sqrt(chars)[:, None]
            rows = np.arange(len(own))
            logs = np.stack([-t * gaps[rows, own] - np.log(np.exp(-t * gaps).sum(axis=1)) for t in _TEMPERATURES], axis=1)
            yield pa.RecordBatch.from_arrays([
                batch.column("lang"), batch.column("chars"), pa.array(found[rows, own]),
                pa.FixedSizeListArray.from_arrays(pa.array(logs.ravel()), len(_TEMPERATURES)).cast(pa.list_(pa.float64()))],
                names=["lang", "chars", "h", "logs"])

    return scored.select("lang", "chars", "entropies").mapInArrow(run, "lang string, chars bigint, h double, logs array<double>")


def _block_likelihoods(scored: DataFrame, langs: list[str]) -> DataFrame:
    """row, lang, chars, and of a block: the entropy of that language if it is in it, the least one, and the block's share
    of the posterior's divisor at each temperature."""
    place = {lang: k for k, lang in enumerate(langs)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            found = matrix(batch.column("entropies"))
            own = np.array([place.get(x, -1) for x in batch.column("lang").to_pylist()])
            least = found.min(axis=1)
            gaps = (found - least[:, None]) * np.sqrt(batch.column("chars").to_numpy())[:, None]
            totals = np.stack([np.exp(-t * gaps).sum(axis=1) for t in _TEMPERATURES], axis=1)
            yield pa.RecordBatch.from_arrays([
                batch.column("row"), batch.column("lang"), batch.column("chars"),
                pa.array(found[np.arange(len(own)), own], mask=own < 0), pa.array(least),
                pa.FixedSizeListArray.from_arrays(pa.array(totals.ravel()), len(_TEMPERATURES)).cast(pa.list_(pa.float64()))],
                names=["row", "lang", "chars", "own", "least", "totals"])

    return scored.select("row", "lang", "chars", "entropies").mapInArrow(
        run, "row bigint, lang string, chars bigint, own double, least double, totals array<double>")


def _joint_likelihoods(blocks: list[DataFrame]) -> DataFrame:
    """The columns of `_likelihoods` over the languages of all blocks."""
    every = blocks[0]
    for more in blocks[1:]:
        every = every.unionByName(more)
    joined = every.groupBy("row", "lang", "chars").agg(
        F.max("own").alias("h"), F.min("least").alias("least"),
        F.collect_list(F.struct("least", "totals")).alias("blocks")).where(F.col("h").isNotNull())  # an entry for each block

    def log_posterior(k: int, temperature: float) -> Column:
        scale = F.lit(-temperature) * F.sqrt(F.col("chars").cast("double"))
        total = F.aggregate("blocks", F.lit(0.0), lambda s, b: s + b["totals"][k] * F.exp(scale * (b["least"] - F.col("least"))))
        return scale * (F.col("h") - F.col("least")) - F.log(total)

    logs = F.array(*[log_posterior(k, t) for k, t in enumerate(_TEMPERATURES.tolist())])
    return joined.select("lang", "chars", "h", logs.alias("logs"))


def _calibrate(likelihoods: DataFrame, reject: float) -> Calibration:
    found = materialise(likelihoods, "calibration")
    sums = found.agg(*[F.sum(F.col("logs")[k]).alias(f"t{k}") for k in range(len(_TEMPERATURES))]).first()
    if sums[0] is None:
        return Calibration(1.0, {})
    temperature = float(_TEMPERATURES[int(np.argmax(np.array(sums, float)))])
    means = found.groupBy("lang").agg(F.avg("h").alias("mean"))
    off, short = (F.col("h") - F.col("mean")) ** 2, 1.0 / F.col("chars")
    # off = a + b / chars, by least squares
    fits = found.join(F.broadcast(means), "lang").groupBy("lang").agg(
        F.first("mean").alias("mean"), F.avg(off).alias("v"), F.avg(short).alias("s"), F.avg(off * short).alias("vs"),
        F.avg(short * short).alias("ss"))  # one row for each language
    slope = F.when(F.col("ss") > F.col("s") ** 2, (F.col("vs") - F.col("v") * F.col("s")) / (F.col("ss") - F.col("s") ** 2)).otherwise(0.0)
    fits = fits.withColumn("b", F.greatest(slope, F.lit(0.0))).withColumn(
        "a", F.greatest(F.col("v") - F.col("b") * F.col("s"), F.lit(1e-4))).select("lang", "mean", "a", "b")
    z = (F.col("h") - F.col("mean")) / F.sqrt(F.col("a") + F.col("b") / F.col("chars"))
    limits = found.join(F.broadcast(fits), "lang").groupBy("lang", "mean", "a", "b").agg(
        F.percentile_approx(z, F.lit(1.0 - reject), F.lit(10_000)).alias("limit")).collect()
    return Calibration(temperature, {r["lang"]: (r["mean"], r["a"], r["b"], max(float(r["limit"]), 2.0)) for r in limits})


# ------------------------------------------------------------------ the whole


def _choose(entropies: DataFrame, langs: list[str], calibration: Calibration) -> DataFrame:
    """The best of a block: h, lang, z, limit and the block's share of the posterior's divisor, for texts with letters."""
    limits = [calibration.of(lang) for lang in langs]
    kept = [c for c in entropies.columns if c != "entropies"]
    schema = ", ".join(f"{c} {entropies.schema[c].dataType.simpleString()}" for c in kept)
    names = [*kept, "h", "lang", "surplus", "total"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mean, a, b, limit = np.array(limits).T
        for batch in batches:
            found = matrix(batch.column("entropies")) if batch.num_rows else np.empty((0, len(langs)))
            chars = batch.column("chars").to_numpy()
            best = found.argmin(axis=1) if len(found) else np.empty(0, np.int64)
            h = found[np.arange(len(best)), best]
            length = np.maximum(chars, 1)
            z = (h - mean[best]) / np.sqrt(a[best] + b[best] / length)
            total = np.exp(-calibration.temperature * np.sqrt(length)[:, None] * (found - h[:, None])).sum(axis=1)
            none = chars == 0
            yield pa.RecordBatch.from_arrays([
                *(batch.column(c) for c in kept), pa.array(h, mask=none), pa.array([langs[k] for k in best], pa.string(), mask=none),
                pa.array(z - limit[best]), pa.array(total)], names=names)

    return entropies.mapInArrow(run, f"{schema}, h double, lang string, surplus double, total double")


def identify_languages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", order: int = ORDER, share: float = SHARE,
    reject: float = REJECT, block_grams: int = BLOCK_GRAMS,
) -> DataFrame:
    """Id, held_out, lang_pred, score, rejected and entropy (nats per character) of every row."""
    plain = docs.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    part = remainder(F.col("id"))
    held_out = F.coalesce(part == 0, F.lit(False))
    labelled = plain.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & (part != 0)).select(
        "lang", (part == 1).alias("part"), "text")
    counts = materialise(count_grams(labelled, order), "counts")
    nothing = plain.select(
        F.col("id").alias(id_col), held_out.alias("held_out"), F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"),
        F.lit(True).alias("rejected"), F.lit(None).cast("double").alias("entropy"))
    if counts.isEmpty():
        return nothing
    rest, n_chars = fit_models(counts.where("n_rest > 0").select("lang", "gram", F.col("n_rest").alias("n")), order, share)
    rest_blocks = _blocks(rest, block_grams)
    calibration = Calibration(1.0, {})
    learnt = labelled.where("part").select("lang", "text")
    if len(rest_blocks) == 1:
        langs, = rest_blocks
        scored = _entropies(learnt, _load(rest, langs, n_chars, order), order)
        calibration = _calibrate(_likelihoods(scored.where((F.col("chars") > 0) & F.col("lang").isin(langs)), langs), reject)
    elif rest_blocks:
        learnt = materialise(learnt.select(F.monotonically_increasing_id().alias("row"), "lang", "text"), "calibration-rows")
        calibration = _calibrate(_joint_likelihoods([
            _block_likelihoods(_entropies(learnt, _load(rest, langs, n_chars, order), order).where("chars > 0"), langs)
            for langs in rest_blocks]), reject)
    models, n_chars = fit_models(counts.select("lang", "gram", "n"), order, share)
    blocks = _blocks(models, block_grams)

    def chosen(texts: DataFrame) -> list[DataFrame]:
        return [_choose(_entropies(texts, _load(models, langs, n_chars, order), order), langs, calibration) for langs in blocks]

    if len(blocks) == 1:
        best, = chosen(plain.select("id", "text"))
        posterior = 1.0 / F.col("total")
    else:
        rows = materialise(plain.select(F.monotonically_increasing_id().alias("row"), "id", "text"), "rows")
        found = chosen(rows)
        every = found[0]
        for more in found[1:]:
            every = every.unionByName(more)
        best = every.groupBy("row").agg(
            F.min(F.struct("h", "lang", "surplus", "chars", "id")).alias("best"),
            F.collect_list(F.struct("h", "total")).alias("blocks")).select("best.*", "blocks")  # an entry for each block
        scale = F.lit(-calibration.temperature) * F.sqrt("chars")
        posterior = 1.0 / F.aggregate(
            "blocks", F.lit(0.0), lambda total, b: total + b["total"] * F.exp(scale * (b["h"] - F.col("h"))))
    surplus = F.greatest(F.col("surplus"), F.lit(0.0))
    return best.select(
        F.col("id").alias(id_col), held_out.alias("held_out"), F.coalesce("lang", F.lit(UNKNOWN)).alias("lang_pred"),
        F.when(F.col("lang").isNull(), 0.0).otherwise(posterior * F.exp(-surplus / 2)).alias("score"),
        (F.col("lang").isNull() | (F.col("surplus") > 0)).alias("rejected"), F.col("h").alias("entropy"))
