"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A linear model scores each sentence; the document's score is their noisy-or,
``1 - prod(1 - p)``, and is all that training sees, since only documents are labelled. The sentence scores then locate
what is offending. Features are the words of a sentence and their beginnings, so inflected forms share weights.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stopwise.llm.common import fresh, require, with_workers

#: A-Z to a-z; marks that end a sentence to a line feed; other ASCII marks to a space. Lengths stay.
_PLAIN = bytes(
    c + 32 if 65 <= c <= 90 else 10 if c in b".!?\n\r" else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256)
)
#: Lengths, in code points, of the word beginnings that are features.
STEMS = (4, 5, 6)
#: Words whose weight a worker keeps; beyond that it starts anew.
CACHE = 300_000


@dataclass(frozen=True)
class ToxicityConfig:
    """Bounds of the training sample (documents of each label; their texts are whole) and of the model.

    A feature is used if its document counts differ between the labels by ``telling``, roughly its z value.
    """

    sample: int = 1500
    features: int = 20_000
    least_docs: int = 5
    telling: float = 6.0
    epochs: int = 60
    rate: float = 0.5
    decay: float = 1e-4
    bias: float = -6.0
    seed: int = 11


def features(word: bytes) -> list[bytes]:
    """The word and its beginnings."""
    letters = word.decode()
    return [word, *(b"^" + letters[:n].encode() for n in STEMS if len(letters) >= n)]


@dataclass(frozen=True)
class ToxicityModel:
    weights: dict[bytes, float]
    bias: float

    def word_weight(self, word: bytes) -> float:
        return sum(self.weights.get(f, 0.0) for f in features(word))

    def sentence_scores(self, parts: list[bytes], known: dict[bytes, float]) -> np.ndarray:
        """Probability of each sentence; ``known`` caches word weights."""
        telling = {}
        for word in set(b" ".join(parts).split()):
            weight = known.get(word)
            if weight is None:
                if len(known) >= CACHE:
                    known.clear()
                weight = known[word] = self.word_weight(word)
            if weight:
                telling[word] = weight
        totals = np.full(len(parts), self.bias)
        if telling:
            for i, part in enumerate(parts):
                totals[i] += sum(telling[w] for w in sorted(telling.keys() & part.split()))
        return probability(totals, self.bias)


def probability(z: np.ndarray, bias: float) -> np.ndarray:
    """Logistic above the base rate: a sentence that tells nothing scores zero, so long clean texts stay clean."""
    base = 1 / (1 + np.exp(-bias))
    return np.maximum(0.0, (1 / (1 + np.exp(-np.clip(z, -40, 40))) - base) / (1 - base))


def noisy_or(scores: np.ndarray) -> float:
    """Probability that at least one sentence offends; zero without sentences."""
    return abs(float(np.expm1(np.log1p(-np.minimum(scores, 1 - 1e-12)).sum()))) if len(scores) else 0.0


def learn(texts: list[str], toxic: np.ndarray, cfg: ToxicityConfig) -> ToxicityModel:
    """Fit on a bounded list of texts: full-batch Adagrad on the noisy-or likelihood of the documents."""
    texts, toxic = list(texts), np.asarray(toxic, float)
    if not texts or toxic.min() == toxic.max():
        return ToxicityModel({}, -cfg.bias if texts and toxic.max() else cfg.bias)
    bags = []
    counts = (Counter(), Counter())  # of documents, by label
    for text, label in zip(texts, toxic, strict=True):
        spans, plain = sentences_of(text.encode())
        bags.append([tuple(set(plain[a:b].split())) for a, b in spans])
        counts[int(label)].update({f for w in set().union(*bags[-1]) for f in features(w)})
    # The features whose document counts tell most about the label.
    names = sorted(f for f in counts[0].keys() | counts[1].keys() if counts[0][f] + counts[1][f] >= cfg.least_docs)
    table = np.array([(counts[0][f], counts[1][f]) for f in names], float).reshape(-1, 2)
    del counts
    rates = (table + 0.5) / (np.array([(toxic == 0).sum(), (toxic == 1).sum()]) + 1)
    telling = np.abs(np.log(rates[:, 1] / rates[:, 0])) * np.sqrt(table.sum(1))
    chosen = sorted(i for i in np.argsort(-telling, kind="stable")[: cfg.features] if telling[i] >= cfg.telling)
    place = {names[i]: k for k, i in enumerate(chosen)}
    known: dict[bytes, tuple[int, ...]] = {}

    rows, cols, owner = [], [], []
    for doc, bag in enumerate(bags):
        for sentence in bag:
            for w in sentence:
                if w not in known:
                    known[w] = tuple(place[f] for f in features(w) if f in place)
            got = sorted({k for w in sentence for k in known[w]})
            rows += [len(owner)] * len(got)
            cols += got
            owner.append(doc)
    rows, cols, owner = (np.array(x, np.int64) for x in (rows, cols, owner))
    w, squares = np.zeros(len(place)), np.full(len(place), 1e-6)
    balance = np.where(toxic == 1, 0.5 / toxic.mean(), 0.5 / (1 - toxic.mean())) / len(toxic)
    for _ in range(cfg.epochs):
        z = cfg.bias + np.bincount(rows, w[cols], len(owner))
        p = probability(z, cfg.bias)
        clean = np.bincount(owner, np.log1p(-np.minimum(p, 1 - 1e-12)), len(bags))  # log of the chance that none offends
        dirty = np.maximum(-np.expm1(clean), 0.05)
        # The loss by a sentence's z: for toxic documents less the more other sentences explain the label.
        slope = np.where(z >= cfg.bias, 1 / (1 + np.exp(-np.clip(z, -40, 40))), 0.0) * balance[owner]
        slope *= np.where(toxic[owner] == 1, -np.exp(clean)[owner] / dirty[owner], 1.0)
        step = np.bincount(cols, slope[rows], len(place)) + cfg.decay * w / len(toxic)
        squares += step**2
        w -= cfg.rate * step / np.sqrt(squares)
    return ToxicityModel({f: float(w[k]) for f, k in place.items() if abs(w[k]) > 1e-3}, cfg.bias)


def train(docs: DataFrame, labels: DataFrame, cfg: ToxicityConfig | None = None) -> ToxicityModel:
    """Learn from the labelled rows of ``docs`` whose ``crc32(doc_id) mod 5`` isn't zero.

    Of each label ``cfg.sample`` documents are taken, those with the smallest hash of their id: a bound, whatever the
    size of the tables. Null labels and null ids teach nothing; of several labels of an id the largest holds.
    """
    cfg = cfg or ToxicityConfig()
    told = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    told = told.where(~held_out(F.col("doc_id"))).withColumn("h", F.xxhash64("doc_id", F.lit(cfg.seed)))
    some = None
    for label in (0, 1):
        part = told.where(F.col("toxic") == label).orderBy("h").limit(cfg.sample)
        some = part if some is None else some.unionByName(part)
    rows = docs.select("doc_id", "text").join(F.broadcast(some), "doc_id")  # at most 2 * cfg.sample ids
    kept = rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic"), F.first("h").alias("h"))
    got = {r.text or "": r.toxic for r in sorted(kept.collect(), key=lambda r: (r.h, r.doc_id))}  # copies teach once
    return learn(list(got), np.array(list(got.values())), cfg)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


_RESULT = T.StructType(
    [
        T.StructField("score", T.DoubleType()),
        T.StructField("spans", T.ArrayType(T.StructType([T.StructField(n, T.IntegerType()) for n in ("start", "end")]))),
    ]
)


def _result(model: ToxicityModel, text: Column, cut: float) -> Column:
    kind = pa.struct([("score", pa.float64()), ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))])

    @F.arrow_udf(_RESULT)
    def toxicity(texts: pa.Array) -> pa.Array:
        known: dict[bytes, float] = {}
        out = []
        for one in texts:
            raw = (one.as_py() or "").encode()
            spans, plain = sentences_of(raw)
            p = model.sentence_scores([plain[a:b] for a, b in spans], known)
            worst = [spans[i] for i in np.flatnonzero(p >= cut)]
            out.append({"score": noisy_or(p), "spans": code_points(raw, worst)})
        return pa.array(out, kind)

    return toxicity.asNondeterministic()(text)  # so that no filter evaluates it once more


def sentences_of(raw: bytes) -> tuple[list[tuple[int, int]], bytes]:
    plain, start, spans = raw.translate(_PLAIN), 0, []
    for part in plain.split(b"\n"):
        if part and not part.isspace():
            spans.append((start, start + len(part)))
        start += len(part) + 1
    return spans, plain


def code_points(raw: bytes, spans: list[tuple[int, int]]) -> list[dict[str, int]]:
    """Byte spans as code-point spans."""
    if not spans:
        return []
    edges = [0, *sorted({x for s in spans for x in s})]
    lengths = np.cumsum([0, *(len(raw[a:b].decode()) for a, b in pairwise(edges))])
    at = dict(zip(edges, lengths, strict=True))
    return [{"start": int(at[a]), "end": int(at[b])} for a, b in spans]


def score_documents(docs: DataFrame, model: ToxicityModel, cut: float = 0.5, into: str = "toxicity") -> DataFrame:
    """``docs`` with a struct ``into``: ``score`` (0 to 1) and ``spans``, the code-point spans of offending sentences.

    Null, empty and wordless texts score 0 without spans. Every sentence of a text counts, however long it is. Other
    columns are passed on; one named like ``into`` is replaced. Repeated rows get equal scores.
    """
    require(docs, "text")
    with_workers(docs)
    out = fresh(docs.drop(into), "__toxicity")
    return docs.drop(into).withColumn(out, _result(model, F.col("text"), cut)).withColumnRenamed(out, into)
