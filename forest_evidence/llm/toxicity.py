"""Toxicity severity by cumulative-link ordinal regression (operator 1).

P(grade >= k) = sigmoid(w . x - threshold_k), with the same weights for all thresholds and the thresholds
in order. x counts words and word beginnings, over the root of the text's length. Expected severity is the sum of
P(grade >= k) over k. Weights are fitted by proximal gradient steps with an L1 penalty, so that few stay.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, in_batches, in_frames, in_slices

#: Labelled documents to fit on, at most; those with the smallest hash of their id.
SAMPLE = 4000
#: Words must occur in so many documents of the sample.
LEAST_DOCS = 5
PENALTY = 0.002
ROUNDS = 200
STEP = 0.1

#: Beside whole words, word beginnings of so many letters are features: inflected and joined forms share them.
BEGINNINGS = (5, 6, 7)
#: A feature's value is its count over the root of the words of the text and so many more.
MORE_WORDS = 50

_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def lettered(text: str | None) -> bytes:
    """Lower case, with a space for all ASCII but letters."""
    return (text or "").lower().encode().translate(_LETTERS)


def features(word: str) -> list[str]:
    return [word] + ["^" + word[:k] for k in BEGINNINGS if len(word) > k]


@dataclass
class Model:
    weights: dict[str, float]
    thresholds: np.ndarray

    def at_least(self, texts: list[str | None]) -> np.ndarray:
        """P(grade >= 1), P(grade >= 2), ... for each text."""
        get, z = self.weights.get, []
        for a, b in in_slices(texts):
            words = Words([lettered(t) for t in texts[a:b]])
            own = np.array([sum(get(f, 0.0) for f in features(w)) for w in words.distinct.to_pylist()] or [0.0])
            total = np.concatenate([[0.0], np.cumsum(own[words.codes])])[words.starts]
            z.append(np.diff(total) / np.sqrt(np.diff(words.starts) + MORE_WORDS))
        z = np.concatenate(z) if z else np.zeros(0)
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - z[:, None], -40, 40)))


def fit(texts: list[str], grades: np.ndarray) -> Model:
    """Fit on texts with grades 0, 1, ... up to the highest one given, which sets the severity's range; a lower grade
    that no text has still has its threshold."""
    ids: dict[str, int] = {}
    own, values = [], []
    for t in texts:
        counts: Counter[int] = Counter()
        words = Counter(lettered(t).decode().split())
        for w, n in words.items():
            for f in features(w):
                counts[ids.setdefault(f, len(ids))] += n
        own.append(np.fromiter(counts.keys(), np.int32, len(counts)))
        values.append(np.fromiter(counts.values(), np.float32, len(counts)) / np.sqrt(words.total() + MORE_WORDS))
    rows = np.repeat(np.arange(len(texts), dtype=np.int32), list(map(len, own)))
    cols = np.concatenate(own) if own else np.zeros(0, np.int32)
    value = np.concatenate(values) if own else np.zeros(0)
    often = np.bincount(cols, minlength=len(ids)) >= LEAST_DOCS
    keep = often[cols]
    place = np.cumsum(often) - 1
    words = [f for f, k in ids.items() if often[k]]
    rows, cols, value = rows[keep], place[cols[keep]], value[keep].astype(float)
    del ids, own, values, often, keep, place
    # values are scaled to a like spread for all features, so that the penalty treats rare and common ones alike
    spread = np.sqrt(np.bincount(cols, value**2, len(words)) / max(1, len(texts))) + 1e-3
    value = value / spread[cols]
    sets = texts
    levels = np.arange(1, max(2, int(grades.max(initial=0)) + 1))
    n = max(1, len(sets))
    y = (grades[:, None] >= levels[None, :]).astype(float)
    rate = np.clip(y.mean(0), 1e-4, 1 - 1e-4) if len(sets) else np.full(len(levels), 1e-4)
    w, cut = np.zeros(len(words)), np.log(1 / rate - 1)
    # grade g lies between its two thresholds: P(g) = s(z - cut_g) - s(z - cut_g+1)
    momentum_w, momentum_c, t, step = w.copy(), cut.copy(), 1.0, STEP
    for _ in range(ROUNDS):
        z = np.bincount(rows, momentum_w[cols] * value, len(sets)) if len(cols) else np.zeros(len(sets))
        p = 1 / (1 + np.exp(np.clip(momentum_c[None, :] - z[:, None], -40, 40)))
        up = np.hstack([np.ones((len(sets), 1)), p])
        down = np.hstack([p, np.zeros((len(sets), 1))])
        k = grades.astype(int)
        i = np.arange(len(sets))
        mass = np.maximum(up[i, k] - down[i, k], 1e-9)
        su, sd = up[i, k] * (1 - up[i, k]), down[i, k] * (1 - down[i, k])
        dz = (su - sd) / mass
        dc = np.zeros((len(sets), len(levels) + 2))
        dc[i, k] -= su / mass
        dc[i, k + 1] += sd / mass
        new = momentum_w + step * np.bincount(cols, dz[rows] * value, len(words)) / n
        new = np.sign(new) * np.maximum(np.abs(new) - step * PENALTY, 0)
        new_cut = np.maximum.accumulate(momentum_c + step * dc[:, 1 : len(levels) + 1].sum(0) / n)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        momentum_w, momentum_c = new + (t - 1) / t_new * (new - w), np.maximum.accumulate(new_cut + (t - 1) / t_new * (new_cut - cut))
        w, cut, t = new, new_cut, t_new
    return Model({words[j]: float(w[j] / spread[j]) for j in np.flatnonzero(w)}, cut)


def grades(labels: DataFrame) -> DataFrame:
    """doc_id, grade: 0 not toxic, 1 toxic, 2 toxic and of low quality. Rows without a toxic label go."""
    toxic = F.when(F.col("toxic") == 0, 0).when(F.col("quality") == 0, 2).otherwise(1)
    return labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max(toxic).alias("grade"))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` labelled documents, taken by the hash of their id.

    The sample's ids and texts alone reach the driver.
    """
    chosen = grades(labels).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").where("text is not null")
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(sample).select("text", "grade").toPandas()
    return fit(rows["text"].tolist(), rows["grade"].to_numpy(int))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, severity, p_toxic, grade, toxic for every row; toxic where P(grade >= 1) >= 0.5.

    Null and empty texts have no word and get the thresholds alone. Repeated rows are scored each.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            p = shared.value.at_least(batch["text"].tolist())
            yield pd.DataFrame({"doc_id": batch["doc_id"], "severity": p.sum(1), "p_toxic": p[:, 0], "grade": (p >= 0.5).sum(1), "toxic": p[:, 0] >= 0.5})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return in_frames(docs.select("doc_id", "text"), run, f"doc_id {kind}, severity double, p_toxic double, grade int, toxic boolean")


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, all columns, that aren't toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return in_batches(docs, lambda texts: shared.value.at_least(texts)[:, 0] < 0.5, "text")
