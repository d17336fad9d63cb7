"""Language identification by segmentation-marginalised unigrams (operator 3).

Each language has a probability for every piece of a fixed public vocabulary. A word's probability is the
sum over all its segmentations into pieces, by a forward pass; pieces don't span words, so a text's is the
product over its words. Piece probabilities are fitted by expectation maximisation over the same
segmentations: Spark counts words and sums expected piece counts, and only these sums, bounded by the
vocabulary, reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, in_frames, in_slices, staged
from .toxicity import lettered

#: Documents of each language to fit on, about and on average at most; taken by the hash of their id.
SAMPLE = 600
ROUNDS = 3
#: Added to each expected count.
SMOOTH = 0.05
#: Probability of a character that no piece has; the same for all languages.
UNKNOWN = 1e-8
#: Kept words in a task.
KEPT = 400_000


def vocabulary(path: str) -> list[str]:
    """Pieces of a sentencepiece model that have letters or begin words."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    usual = (i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)))
    return [model.id_to_piece(i) for i in usual]


def spelled(word: str) -> str:
    return "▁" + word


@dataclass
class Unigrams:
    """log_p: a row for each piece, a column for each language."""

    pieces: list[str]
    langs: list[str]
    log_p: np.ndarray
    prior: np.ndarray
    place: dict[str, int] = field(init=False)

    def __post_init__(self):
        self.place = {p: i for i, p in enumerate(self.pieces)}
        self.longest = max(map(len, self.pieces), default=1)
        self.p = np.exp(self.log_p)
        self.kept: dict[str, int] = {}
        self.scores = np.zeros((0, len(self.langs)))

    def of_words(self, words: list[str]) -> np.ndarray:
        """Log-probability of each word in each language, by forward passes of words of one length.

        The sums of the last places alone are held, as multiples of one of the newest, whose logarithm is
        kept apart: a word may be as long as a text.
        """
        out = np.zeros((len(words), len(self.langs)))
        by_length: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            by_length.setdefault(len(w) + 1, []).append(i)
        p = np.vstack([self.p, np.full(len(self.langs), UNKNOWN), np.zeros(len(self.langs))])
        get = self.place.get
        for n, own in by_length.items():
            for a in range(0, len(own), 4096):
                some = own[a : a + 4096]
                texts = [spelled(words[x]) for x in some]
                scale = np.zeros((len(some), len(self.langs)))
                behind = [np.ones((len(some), len(self.langs)))]  # the sums up to the places before
                for j in range(1, n + 1):
                    total = np.zeros((len(some), len(self.langs)))
                    for back in range(1, len(behind) + 1):
                        none = -2 if back == 1 else -1
                        k = np.array([get(t[j - back : j], none) for t in texts])
                        if (k != -1).any():
                            total += behind[-back] * p[k]
                    behind = [*behind[-self.longest + 1 :], total] if self.longest > 1 else [total]
                    if j % 16 == 0 or j == n:
                        scale += np.log(total)
                        behind = [x / total for x in behind]
                out[some] = scale
        return out

    def of_texts(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Log-probability of each text in each language, and which texts have a letter."""
        totals, letters = [], []
        for a, b in in_slices(texts):
            words = Words([lettered(t) for t in texts[a:b]])
            distinct = words.distinct.to_pylist()
            if len(self.kept) + len(distinct) > KEPT:
                self.kept, self.scores = {}, np.zeros((0, len(self.langs)))
            new = [w for w in distinct if w not in self.kept]
            self.kept.update(zip(new, range(len(self.scores), len(self.scores) + len(new))))
            fresh = self.of_words(new)
            fresh[[not any(map(str.isalpha, w)) for w in new]] = 0
            self.scores = np.vstack([self.scores, fresh])
            own = self.scores[[self.kept[w] for w in distinct]] if distinct else np.zeros((0, len(self.langs)))
            sums = np.vstack([np.zeros((1, len(self.langs))), np.cumsum(own[words.codes], axis=0)])[words.starts]
            totals.append(np.diff(sums, axis=0))
            has = np.array([any(map(str.isalpha, w)) for w in distinct] or [False])
            letters.append(np.diff(np.concatenate([[0], np.cumsum(has[words.codes])])[words.starts]) > 0)
        return (np.vstack(totals), np.concatenate(letters)) if totals else (np.zeros((0, len(self.langs))), np.zeros(0, bool))


def word_counts(model: Unigrams, k: int, word: str) -> dict[int, float]:
    """Expected uses of each piece over all segmentations of a word in language ``k``.

    Forward and backward sums are kept as multiples of a running scale, one for each place, so that words of
    any length can be counted.
    """
    p, get, n = model.p[:, k], model.place.get, len(word)
    into: list[list[tuple[int, int, float]]] = [[] for _ in range(n + 1)]  # (from, piece, probability)
    for j in range(1, n + 1):
        for i in range(max(0, j - model.longest), j):
            x = get(word[i:j], -1)
            if x >= 0 or i == j - 1:
                into[j].append((i, x, float(p[x]) if x >= 0 else UNKNOWN))
    ahead, log = [1.0] + [0.0] * n, [0.0] * (n + 1)  # the true sum is ahead * exp(log)
    for j in range(1, n + 1):
        base = log[j - 1]
        total = sum(ahead[i] * math.exp(log[i] - base) * v for i, _, v in into[j])
        ahead[j], log[j] = 1.0, base + math.log(total)
    # share[j]: the probability that a segmentation has a cut at j
    share, out = [0.0] * n + [1.0], {}
    for j in range(n, 0, -1):
        if share[j] == 0:
            continue
        for i, x, v in into[j]:
            use = share[j] * math.exp(log[i] - log[j]) * ahead[i] * v
            share[i] += use
            if x >= 0:
                out[x] = out.get(x, 0.0) + use
    return out


def expected_counts(model: Unigrams, words: pd.DataFrame) -> pd.DataFrame:
    """lang, piece, n: expected uses of each piece over all segmentations of (lang, word, n)."""
    total = {k: np.zeros(len(model.pieces)) for k in range(len(model.langs))}
    column = {v: k for k, v in enumerate(model.langs)}
    for lang, word, n in zip(words["lang"], words["word"], words["n"]):
        for x, use in word_counts(model, column[lang], spelled(word)).items():
            total[column[lang]][x] += n * use
    rows = [(model.langs[k], int(x), t[x]) for k, t in total.items() for x in np.flatnonzero(t > 0)]
    return pd.DataFrame(rows, columns=["lang", "piece", "n"])


def train(docs: DataFrame, vocabulary_path: str, sample: int = SAMPLE, rounds: int = ROUNDS) -> Unigrams:
    """Fit on a sample of ``docs`` with a non-null lang and text: of each language, about ``sample``
    documents, by a hash threshold on doc_id. Only text and lang are learned from."""
    spark = docs.sparkSession
    labelled = docs.where("lang is not null and text is not null").select("doc_id", "text", "lang")
    sizes = labelled.groupBy("lang").agg(F.count("*").alias("size"))
    uniform = F.crc32(F.concat(F.lit("fit"), F.col("doc_id").cast("string")).cast("binary")) / F.lit(2.0**32)
    # one row for each language
    chosen = labelled.join(F.broadcast(sizes), "lang").where(uniform < F.lit(float(sample)) / F.col("size"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, own in batch.groupby("lang"):
                words = Words([lettered(t) for t in own["text"]])
                n = np.bincount(words.codes, minlength=len(words.distinct))
                yield pd.DataFrame({"lang": lang, "word": words.distinct.to_pylist(), "n": n})

    counted = in_frames(chosen.select("lang", "text"), count, "lang string, word string, n long")
    counted = staged(counted.groupBy("lang", "word").agg(F.sum("n").alias("n")))
    pieces = vocabulary(vocabulary_path)
    rows = sizes.orderBy("lang").collect()
    langs = [r["lang"] for r in rows]
    size = np.array([r["size"] for r in rows], float)
    flat = np.full((len(pieces), len(langs)), -np.log(len(pieces)))
    model = Unigrams(pieces, langs, flat, np.log(size / size.sum()) if langs else size)
    place = {v: k for k, v in enumerate(langs)}
    for _ in range(rounds if langs else 0):
        shared = spark.sparkContext.broadcast(model)

        def expect(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            for batch in batches:
                yield expected_counts(shared.value, batch)

        found = in_frames(counted, expect, "lang string, piece int, n double").groupBy("lang", "piece").agg(F.sum("n").alias("n")).toPandas()
        total = np.full((len(pieces), len(langs)), SMOOTH)
        np.add.at(total, (found["piece"].to_numpy(int), found["lang"].map(place).to_numpy(int)), found["n"].to_numpy(float))
        model = Unigrams(pieces, langs, np.log(total / total.sum(0)), model.prior)
    return model


def predict(docs: DataFrame, model: Unigrams) -> DataFrame:
    """doc_id, lang_pred, score for every row: the likeliest language of the whole text and its posterior.

    ``und`` with score 0 if the text is null or has no letter, or if no language was learned. Repeated
    rows are predicted each; ties go to the first language by name; other columns are not read; an empty table
    gives no rows. A word may be as long as a text: all its segmentations are summed.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for batch in batches:
            total, letters = m.of_texts(batch["text"].tolist())
            if m.langs:
                total = total + m.prior
                best = total.argmax(1)
                score = 1 / np.exp(total - total.max(1)[:, None]).sum(1)
                lang = np.where(letters, np.array(m.langs, object)[best], "und")
            else:
                lang, score = np.full(len(batch), "und", object), np.zeros(len(batch))
            yield pd.DataFrame({"doc_id": batch["doc_id"], "lang_pred": lang, "score": np.where(letters, score, 0.0)})

    return in_frames(docs.select("doc_id", "text"), run, f"doc_id {kind}, lang_pred string, score double")


def held_out(doc_id):
    """Documents whose crc32 of the id as text is 2 modulo 4 are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))
