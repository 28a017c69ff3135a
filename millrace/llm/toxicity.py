"""Toxicity: a linear-chain conditional random field tags toxic words.

Labels say only whether a document is toxic. `fit` first finds out which words make it
so: features of words (the word, its first 4, 5 and 6 letters) that hardly occur in clean
documents are chosen greedily until they cover the toxic ones, each time the feature that
covers most of those not yet covered; so are words that are frequent beside them and in no
clean document. In toxic documents, words with a chosen feature
are the positive tokens. On these labelled tokens a chain with two tags is
trained by its likelihood: weights of features, a bias and four transitions.

`score_documents` runs forward-backward over every whole text. A document's score joins
the marginals of its words as independent causes, those of at least `SPAN_FLOOR`, so
that a long text does not become toxic by many tiny marginals; without such words it is the
largest marginal. Words with a marginal of one half or more are given as spans.

The model is fitted in one task on a bounded, documented sample: at most `SAMPLE_TOXIC`
and `SAMPLE_CLEAN` labelled documents, chosen by a hash of the id. All else covers all rows.

Defined cases
  * null or wordless text: the score of an empty text, 0;
  * labels that are null or not 0/1 are left out, repeated ids count as toxic if any label
    says so; ids without a document teach nothing;
  * without labelled documents of both kinds no word is known to be toxic: all scores 0;
  * null or repeated ids in the documents: one result row for every row; no rows: no rows.
"""

from __future__ import annotations

import heapq
import json
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Labelled documents the model is fitted on.
SAMPLE_TOXIC = 1000
SAMPLE_CLEAN = 2000
THRESHOLD = 0.7
SPAN_FLOOR = 0.2
_WORD = re.compile(r"[^\W\d_]+")
_PREFIXES = (4, 5, 6)
# Share of clean documents in which a feature of toxic words may occur.
_CLEAN_SHARE = 0.002
# Share of toxic documents from which on a word counts although others cover its documents.
_BESIDE = 0.01
_WINDOW = 40
_STEPS = 100
_RIDGE = 0.02
_TOKENS = 300_000
_CACHE = 100_000
# Windows whose gradient is worked out at once.
_WINDOWS_AT_ONCE = 2000


def features(word: str) -> list[str]:
    return [f"w:{word}", *(f"{n}:{word[:n]}" for n in _PREFIXES if len(word) >= n)]


# ------------------------------------------------------------------ the chain


def ratios(odds: list[np.ndarray], step: np.ndarray) -> list[np.ndarray]:
    """Odds of the toxic tag at every place, given the whole chain.

    `odds[t]` holds the odds of the words at place t, one for each chain that is so long; the longest
    chains come first. `step` is the 2 x 2 matrix of transition factors.
    """
    forward, state = [], np.ones(0)
    for t, here in enumerate(odds):
        if t:
            before = state[:len(here)]
            state = here * (step[0, 1] + step[1, 1] * before) / (step[0, 0] + step[1, 0] * before)
        else:
            state = here.copy()
        forward.append(state)
    for t in range(len(odds) - 2, -1, -1):
        n = len(odds[t + 1])
        # forward[t + 1] already holds the product with what comes after it
        if t == len(odds) - 2:
            after = odds[t + 1]
        else:
            after = odds[t + 1].copy()
            after[:len(back)] *= back
        back = (step[1, 0] + step[1, 1] * after) / (step[0, 0] + step[0, 1] * after)
        forward[t][:n] *= back
    return forward


class Tagger:
    """Fitted weights; log-odds of a word are the sum of those of its features."""

    def __init__(self, weights: dict[str, float], bias: float, step: list[list[float]]):
        self.weights, self.bias, self.step = weights, bias, np.array(step)
        self.cache = _Odds(self)

    def to_json(self) -> str:
        return json.dumps({"weights": self.weights, "bias": self.bias, "step": self.step.tolist()})

    @staticmethod
    def from_json(text: str) -> Tagger:
        return Tagger(**json.loads(text))

    def marginals(self, documents: list[list[str]]) -> list[np.ndarray]:
        """The probability of the toxic tag for each word of each document."""
        if len(self.cache) > _CACHE:
            self.cache.clear()
        lengths = np.array([len(d) for d in documents], np.int64)
        order = np.argsort(-lengths, kind="stable")
        found = [np.fromiter(map(self.cache.__getitem__, d), float, len(d)) for d in documents]
        if not len(lengths) or not lengths.max():
            return found
        starts = np.cumsum(lengths) - lengths
        flat = np.concatenate(found)
        # how many chains reach each place
        alive = np.searchsorted(-lengths[order], -np.arange(lengths.max()), side="left")
        starts = starts[order]
        places = [starts[:n] + t for t, n in enumerate(alive)]
        joint = ratios([flat[p] for p in places], self.step)
        out = np.empty(len(flat))
        out[np.concatenate(places)] = np.concatenate(joint)
        out = out / (1 + out)
        return np.split(out, np.cumsum(lengths)[:-1])


class _Odds(dict):
    """Odds of words, worked out when first seen."""

    def __init__(self, tagger: Tagger):
        super().__init__()
        self.tagger = tagger

    def __missing__(self, word: str) -> float:
        weights = self.tagger.weights
        found = sum(weights[f] for f in features(word) if f in weights)
        odds = float(np.exp(min(max(self.tagger.bias + found, -30.0), 30.0)))
        self[word] = odds
        return odds


# ------------------------------------------------------------------ fitting


def toxic_features(toxic: list[set[str]], common: Counter[str], n_clean: int) -> set[str]:
    """Features that cover the toxic documents and hardly occur in clean ones; `common` counts the latter."""
    limit = _CLEAN_SHARE * n_clean
    covers: dict[str, set[int]] = defaultdict(set)
    for index, document in enumerate(toxic):
        for feature in document:
            if common[feature] <= limit:
                covers[feature].add(index)
    least = max(2, round(0.002 * len(toxic)))
    # a longer feature of equal cover is the more exact one
    heap = [(-len(c), common[f], -len(f), f) for f, c in covers.items() if len(c) >= least]
    heapq.heapify(heap)
    chosen: set[str] = set()
    covered: set[int] = set()
    while heap:
        gain, seen, length, feature = heapq.heappop(heap)
        now = len(covers[feature] - covered)
        if now < least:
            continue
        if now < -gain:
            heapq.heappush(heap, (-now, seen, length, feature))
            continue
        chosen.add(feature)
        covered |= covers[feature]
    # words that only occur beside chosen ones: frequent, never in clean documents, and in documents that
    # have little else in common (the words of many copies of one toxic text are no insults)
    for feature in sorted(covers, key=lambda f: (-len(covers[f]), f)):
        if len(covers[feature]) < max(5, _BESIDE * len(toxic)):
            break
        if common[feature] == 0 and not any(_overlap(feature, c) for c in chosen):
            holders = sorted(covers[feature])[:: max(1, len(covers[feature]) // 12)]
            alike = sorted(len(toxic[a] & toxic[b]) / len(toxic[a] | toxic[b]) for a, b in zip(holders, holders[1:], strict=False))
            if alike[len(alike) // 2] < 0.5:
                chosen.add(feature)
    return chosen


def _overlap(a: str, b: str) -> bool:
    """Whether two features mark words of one stem."""
    a, b = a[2:], b[2:]
    return a.startswith(b) or b.startswith(a)


def fit(rows: list[tuple[str, int]]) -> Tagger:
    """A tagger from (text, toxic) rows."""
    documents = [(_WORD.findall((text or "").lower()), toxic) for text, toxic in sorted(rows, key=lambda r: (r[0] or "", r[1]))]
    of_word: dict[str, list[str]] = {}
    for words, _ in documents:
        for word in words:
            if word not in of_word:
                of_word[word] = features(word)
    common: Counter[str] = Counter()
    in_toxic: list[set[str]] = []
    for words, toxic in documents:
        found = {f for w in set(words) for f in of_word[w]}
        if toxic:
            in_toxic.append(found)
        else:
            common.update(found)
    chosen = toxic_features(in_toxic, common, len(documents) - len(in_toxic))
    if not chosen:
        return Tagger({}, -30.0, [[1.0, 1.0], [1.0, 1.0]])
    shared = Counter(f for s in in_toxic for f in s)
    index = {f: k + 1 for k, f in enumerate(sorted(f for f, n in shared.items() if n > 1))}
    del common, in_toxic, shared
    word_ids = {w: k for k, w in enumerate(of_word)}
    table = np.zeros((len(word_ids) + 1, 1 + len(_PREFIXES)), np.int32)  # 0: no feature; the last row: padding
    for word, row in word_ids.items():
        for k, f in enumerate(of_word[word]):
            table[row, k] = index.get(f, 0)
    marked = np.array([any(f in chosen for f in of_word[w]) for w in word_ids] + [False])
    windows, tags = [], []
    for words, toxic in documents:
        ids = np.array([word_ids[w] for w in words], np.int64)
        if toxic and not marked[ids].any():
            continue  # toxic for a reason that is not known
        padded = np.full(-(-len(ids) // _WINDOW) * _WINDOW, len(word_ids), np.int32)
        padded[:len(ids)] = ids
        windows.append(padded.reshape(-1, _WINDOW))
        tags.append((marked[padded] & bool(toxic)).reshape(-1, _WINDOW))
    weights, bias, step = _maximise(np.concatenate(windows), np.concatenate(tags), table, len(index) + 1)
    names = {k: f for f, k in index.items()}
    kept = {names[k]: round(float(weights[k]), 4) for k in np.flatnonzero(np.abs(weights) > 0.01) if k}
    return Tagger(kept, float(bias), step.tolist())


def _maximise(windows: np.ndarray, tags: np.ndarray, table: np.ndarray, n_features: int):
    """Weights, bias and transition factors of the largest penalised likelihood, by Adam steps."""
    # parameters: weights, bias, log factors of (0,1), (1,0), (1,1); (0,0) is fixed at 0
    theta = np.zeros(n_features + 4)
    theta[n_features] = -4.0
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    scale = 1.0 / max(1, tags.sum())
    for turn in range(1, _STEPS + 1):
        gradient = np.zeros_like(theta)
        for at in range(0, len(windows), _WINDOWS_AT_ONCE):
            gradient += _gradient(
                theta, windows[at:at + _WINDOWS_AT_ONCE], tags[at:at + _WINDOWS_AT_ONCE], table, n_features)
        gradient[:n_features] -= _RIDGE * theta[:n_features]
        gradient[0] = 0.0
        gradient[n_features + 1:] -= _RIDGE * theta[n_features + 1:]
        gradient *= scale
        first = 0.8 * first + 0.2 * gradient
        second = 0.95 * second + 0.05 * gradient ** 2
        theta += 0.3 * (first / (1 - 0.8 ** turn)) / (np.sqrt(second / (1 - 0.95 ** turn)) + 1e-8)
        theta[n_features + 1:] = np.clip(theta[n_features + 1:], -8, 8)
    a01, a10, a11 = np.exp(theta[n_features + 1:])
    return theta[:n_features], theta[n_features], np.array([[1.0, a01], [a10, a11]])


def _gradient(theta: np.ndarray, windows: np.ndarray, tags: np.ndarray, table: np.ndarray, n_features: int) -> np.ndarray:
    """What the tags say less what the model expects, summed over the windows."""
    real = windows < len(table) - 1
    feats = table[windows]
    n, length = windows.shape
    odds = np.exp(np.clip(theta[feats].sum(axis=2) + theta[n_features], -30, 30))
    a01, a10, a11 = np.exp(theta[n_features + 1:])
    ahead, back = np.empty((length, n)), np.ones((length, n))
    ahead[0] = odds[:, 0]
    for t in range(1, length):
        ahead[t] = np.where(real[:, t], odds[:, t] * (a01 + a11 * ahead[t - 1]) / (1 + a10 * ahead[t - 1]), 0.0)
    for t in range(length - 2, -1, -1):
        after = odds[:, t + 1] * back[t + 1]
        back[t] = np.where(real[:, t + 1], (a10 + a11 * after) / (1 + a01 * after), 1.0)
    joint = (ahead * back).T
    error = np.where(real, tags - np.where(real, joint / (1 + joint), 0.0), 0.0)
    both = real[:, 1:] & real[:, :-1]
    before, after = ahead[:-1].T, odds[:, 1:] * back[1:].T
    expected = [a01 * after, a10 * before, a11 * before * after]
    total = 1 + sum(expected)
    seen = [~tags[:, :-1] & tags[:, 1:], tags[:, :-1] & ~tags[:, 1:], tags[:, :-1] & tags[:, 1:]]
    found = np.zeros_like(theta)
    found[:n_features] = np.bincount(feats.ravel(), np.repeat(error.ravel(), feats.shape[2]), minlength=n_features)
    found[n_features] = error.sum()
    found[n_features + 1:] = [(both & s).sum() - np.where(both, e / total, 0.0).sum() for s, e in zip(seen, expected, strict=True)]
    return found


def held_out(id_column: Column) -> Column:
    """Rows that no model may learn from."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit_tagger(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    sample_toxic: int = SAMPLE_TOXIC, sample_clean: int = SAMPLE_CLEAN,
) -> Tagger:
    """A tagger from the labelled documents outside the held-out part."""
    known = (
        labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic"))
        .where(F.col("id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("id")))
        .groupBy("id").agg(F.max("toxic").alias("toxic"))
    )
    order = F.xxhash64("id"), F.col("id")
    chosen = known.where("toxic = 1").orderBy(*order).limit(sample_toxic).unionByName(
        known.where("toxic = 0").orderBy(*order).limit(sample_clean))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    sample = texts.join(F.broadcast(chosen), "id").groupBy("id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(t, y) for b in batches for t, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
        yield pa.RecordBatch.from_pydict({"model": [fit(rows).to_json()]})

    found = sample.select("text", "toxic").coalesce(1).mapInArrow(run, "model string").collect()
    return Tagger.from_json(found[0].model) if found else Tagger({}, -30.0, [[1.0, 1.0], [1.0, 1.0]])


# ------------------------------------------------------------------ scoring


def document_score(marginals: np.ndarray) -> float:
    strong = marginals[marginals >= SPAN_FLOOR]
    if len(strong):
        return float(1 - np.prod(1 - strong))
    return float(marginals.max()) if len(marginals) else 0.0


def toxic_spans(text: str, marginals: np.ndarray) -> list[dict]:
    """Character spans of runs of words that are toxic rather than not, with their largest marginal.

    Offsets are those of the lower-cased text, which is as long as the text but for a few letters.
    """
    spans, last = [], -2
    for at, match in enumerate(_WORD.finditer(text.lower())):
        if marginals[at] >= 0.5:
            if last == at - 1:
                spans[-1]["end"] = match.end()
                spans[-1]["p"] = max(spans[-1]["p"], float(marginals[at]))
            else:
                spans.append({"start": match.start(), "end": match.end(), "p": float(marginals[at])})
            last = at
    return spans


def score_documents(docs: DataFrame, tagger: Tagger, id_col: str = "doc_id", text_col: str = "text",
                    keep: tuple[str, ...] = ()) -> DataFrame:
    """Id, the columns `keep`, score and spans (start, end, p) of every row."""
    model = docs.sparkSession.sparkContext.broadcast(tagger.to_json())
    source = docs.select(F.col(id_col), *(F.col(c) for c in keep if c != text_col), F.col(text_col).cast("string").alias("_text"))
    span = T.ArrayType(T.StructType([
        T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("p", T.DoubleType())]))
    with_text = text_col in keep
    schema = T.StructType([
        *source.schema.fields[:-1], *([T.StructField(text_col, T.StringType())] if with_text else []),
        T.StructField("score", T.DoubleType()), T.StructField("spans", span)])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Tagger.from_json(model.value)
        for batch in batches:
            scores, spans, held, size = [], [], [], 0

            def work(texts: list[str]):
                documents = [_WORD.findall(t.lower()) for t in texts]
                for text, marginals in zip(texts, own.marginals(documents), strict=True):
                    scores.append(document_score(marginals))
                    spans.append(toxic_spans(text, marginals) if len(marginals) and marginals.max() >= 0.5 else [])

            column = batch.column(batch.num_columns - 1)
            for text in column:
                text = text.as_py() or ""
                held.append(text)
                size += len(text)
                if size > 6 * _TOKENS:
                    work(held)
                    held, size = [], 0
            work(held)
            kept = batch.columns if with_text else batch.columns[:-1]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(scores, pa.float64()), pa.array(spans, pa.list_(pa.struct(
                    [("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())])))], names=names)

    return source.mapInArrow(run, schema)


def score_toxicity(
    docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text", **sample,
) -> DataFrame:
    """Id, held_out, score, predicted and spans of every row."""
    tagger = fit_tagger(docs, labels, id_col, text_col, **sample)
    return score_documents(docs, tagger, id_col, text_col).select(
        id_col, held_out(F.col(id_col)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"), "spans")
