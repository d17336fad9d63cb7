"""Best-fit packing of tokenised documents into fixed-length sequences (operator 8).

Documents become pieces of at most ``capacity`` tokens. The histogram of piece lengths defines a
configuration linear program: a configuration is a multiset of lengths that fits one sequence, and the
fewest configurations that cover all pieces are sought. Multiplicative weights over the lengths price
the pieces, a knapsack dynamic program finds the best configuration at these prices, and the average of
the configurations found is a fractional cover. It is rounded down to whole sequences; for what is left
the same program prices more configurations. Only the histogram (``capacity`` bins) reaches the driver; pieces find their
place from their rank within their length.
"""

from __future__ import annotations

import functools
import os
import re
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Words, in_frames, in_slices, size_checked, staged

CAPACITY = 4096
END_ID = 1
#: Ranks within a length are dealt into groups of about so many pieces, so that a common length is no single group.
GROUP = 200_000
#: Rounds of multiplicative weights, and how strongly a round that covers a class once lowers its weight.
ROUNDS, EAGERNESS = 400, 0.3
#: Length classes that the knapsack program tells apart.
CLASSES = 256

_SIMPLE = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-/:-@\[-`{-~]*)")


def _byte_letters() -> dict[int, str]:
    """Byte -> the letter that byte-level vocabularies write for it: printable ones stand for themselves."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden) if b != 32}


class Encoder:
    """Token ids of chunks between white space, which no token of this tokenizer spans.

    Letters with trailing punctuation split between the two, so that a word is encoded once for all its
    cases and endings; such parts go to the tokenizer's model many at a time. Any other chunk is encoded
    as it is. Chunks and parts are kept until they take about LIMIT bytes. A Python worker outlives its
    task, so a task drops them at its end.
    """

    LIMIT = 80 << 20
    #: Bytes that a chunk and its parts take beside their characters and ids, about.
    EACH = 320
    AT_ONCE = 200

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        # a task has one core; threads of the tokenizer's own would each keep memory
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.encoder = Tokenizer.from_file(path)
        self.plain = Tokenizer(self.encoder.model)
        self.plain.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocabulary = self.encoder.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.letters = _byte_letters()
        self.reset()

    def reset(self) -> None:
        self.chunk: dict[str, int] = {}
        self.part: dict[str, bytes] = {"": b""}
        self.flat, self.starts = np.zeros(0, "<u4"), np.zeros(1, np.int64)
        self.held = 0

    def learn_words(self, words: list[str]) -> None:
        """Encode words of letters: each ends with the one token that bears the word's end."""
        lists = [words[i : i + self.AT_ONCE] for i in range(0, len(words), self.AT_ONCE)]
        texts = [" ".join(x).encode().decode("latin-1").translate(self.letters) for x in lists]
        for own, e in zip(lists, self.plain.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(e.ids, "<u4")
            ends = np.flatnonzero(self.ends[ids]).tolist()
            if len(ends) != len(own):
                raise ValueError("this tokenizer doesn't mark the ends of words")
            at, raw = 0, ids.tobytes()
            for w, end in zip(own, ends):
                self.part[w] = raw[at : 4 * end + 4]
                at = 4 * end + 4

    def chunks(self, texts: list[str]) -> np.ndarray:
        """The place of each chunk in ``starts``; its ids are flat[starts[k]:starts[k + 1]]."""
        if self.held > self.LIMIT:
            self.reset()
        got = list(map(self.chunk.get, texts))
        new = [t for t, k in zip(texts, got) if k is None]
        if not new:
            return np.array(got, np.int64)
        split, words, other = [], set(), set()
        for t in new:
            m = _SIMPLE.fullmatch(t)
            core, tail = (m[1].lower(), m[2]) if m else ("", t)
            split.append((core, tail))
            words.add(core)
            other.add(tail)
        self.learn_words(list(words.difference(self.part)))
        todo = list(other.difference(self.part))
        for t, e in zip(todo, self.encoder.encode_batch_fast(todo, add_special_tokens=False)):
            self.part[t] = np.array(e.ids, "<u4").tobytes()
        raw = [self.part[a] + self.part[b] for a, b in split]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw)) // 4
        self.held += self.EACH * len(new) + 2 * sum(map(len, new)) + 8 * int(sizes.sum())
        first = len(self.starts) - 1
        self.flat = np.concatenate([self.flat, np.frombuffer(b"".join(raw), "<u4")])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])
        self.chunk.update(zip(new, range(first, first + len(new))))
        fresh = iter(range(first, first + len(new)))
        return np.array([next(fresh) if k is None else k for k in got], np.int64)


@functools.cache
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def token_ids(texts: list[str | None], path: str) -> Iterator[np.ndarray]:
    """Each text's token ids, without the end id."""
    for a, b in in_slices(texts, 1_000_000):
        words = Words(texts[a:b])
        known = _encoder(path)
        place = known.chunks(words.spelled())
        where, ids = known.starts, known.flat
        first, size = where[place][words.codes], np.diff(where)[place][words.codes]
        ends = np.cumsum(size)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - size), size)
        flat, cuts = ids[at], np.concatenate([[0], ends])[words.starts]
        for x, y in zip(cuts[:-1], cuts[1:]):
            yield flat[x:y]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        try:
            yield from map(cut, batches)
        finally:
            _encoder(tokenizer).reset()

    def cut(batch: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for doc, ids in zip(batch["doc_id"].tolist(), token_ids(batch["text"].tolist(), tokenizer)):
            b = ids.tobytes() + end
            n = len(b) // 4
            for k, s in enumerate(range(0, n, capacity)):
                e = min(n, s + capacity)
                rows.append((doc, k, s, e - s, zlib.crc32(b[4 * s : 4 * e])))
        return pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"], dtype=object)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return in_frames(docs.select("doc_id", "text"), run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def best_configuration(sizes: np.ndarray, prices: np.ndarray, most: np.ndarray, capacity: int) -> dict[int, int]:
    """Index -> count of the dearest multiset of sizes within capacity: bounded knapsack by dynamic
    programming over capacity, each size in powers of two of its bound."""
    worth = np.zeros(capacity + 1)
    taken = []
    for i in np.flatnonzero((prices > 0) & (most > 0) & (sizes <= capacity)).tolist():
        size, price = int(sizes[i]), float(prices[i])
        left, k = int(min(most[i], capacity // size)), 1
        while left > 0:
            k = min(k, left)
            w = size * k
            more = worth[: capacity + 1 - w] + price * k
            better = more > worth[w:] + 1e-12
            taken.append((i, k, w, better))
            np.copyto(worth[w:], more, where=better)
            left -= k
            k *= 2
    out: dict[int, int] = {}
    at = int(worth.argmax())
    for i, k, w, better in reversed(taken):
        if at >= w and better[at - w]:
            out[i] = out.get(i, 0) + k
            at -= w
    return out


Cover = dict[tuple[tuple[int, int], ...], float]


def fractional(sizes: np.ndarray, counts: np.ndarray, capacity: int, rounds: int = ROUNDS) -> tuple[Cover, float, np.ndarray]:
    """A fractional cover of all classes, a lower bound on any, and each class's price.

    Multiplicative weights on the covering program: each round prices every class by its weight, takes the
    dearest configuration as often as its scarcest class allows, and lowers the weights of what it covers.
    Weights begin at the classes' sizes, so that the first configurations are full. Rounds go on after
    ``rounds`` until every class is covered. Prices at which no configuration is worth more than 1 bound the
    cover from below; the best of the rounds is returned.
    """
    weight = sizes * counts / (sizes * counts).sum()
    cover, found = np.zeros(len(sizes)), Counter()
    best, price = 0.0, sizes / capacity
    limit = rounds + 4 * len(sizes)
    for r in range(limit):
        if r >= rounds and cover.min() > 0:
            break
        # a class that is still bare when the rounds are over is all that counts
        own = weight / counts if r < rounds else np.where(cover == 0, sizes.astype(float), sizes * 1e-6)
        config = best_configuration(sizes, own / own.max(), counts, capacity)
        if r < rounds:
            worth = sum(own[i] * k for i, k in config.items())
            if worth > 0 and (bound := weight.sum() / worth) > best:
                best, price = bound, own / worth
        often = min(counts[i] / k for i, k in config.items())
        found[tuple(sorted(config.items()))] += often
        for i, k in config.items():
            use = k * often / counts[i]
            cover[i] += use
            weight[i] *= np.exp(-EAGERNESS * use)
        weight /= weight.max()
        weight = np.maximum(weight, 1e-9)
    low = cover.min()
    return {c: k / low for c, k in found.items()}, max(best, float((sizes * counts).sum()) / capacity), price


Plan = list[tuple[tuple[tuple[int, int], ...], int]]


def plan(histogram: dict[int, int], capacity: int = CAPACITY, rounds: int = ROUNDS) -> Plan:
    """[(((length, count), ...), sequences), ...] that holds every piece of the histogram once.

    The program runs on length classes, rounded up so that a class's configuration fits. Every sequence is
    a configuration of the program: those of the fractional cover as often as its whole part says, then
    configurations that the knapsack program prices for what is left. Gaps left by the classes' rounding are
    closed by longer pieces in place of a configuration's own, or by one more.
    """
    left = {n: c for n, c in histogram.items() if c > 0}
    whole = [(((n, 1),), left.pop(n)) for n in [n for n in left if n >= capacity]]
    if not left:
        return whole
    step = max(1, capacity // CLASSES)
    room = capacity // step
    groups: dict[int, list[int]] = {}
    for n in sorted(left, reverse=True):
        # beyond the last whole step a piece fills the room alone, whatever is left of ``capacity``
        groups.setdefault(min(-(-n // step), room), []).append(n)
    sizes = np.array(sorted(groups))

    def counts() -> np.ndarray:
        return np.array([float(sum(left.get(n, 0) for n in groups[s])) for s in sizes.tolist()])

    out: Plan = []
    order, n = sorted(left), counts()
    cover, _, _ = fractional(sizes, n, room, rounds)
    used = np.zeros(len(sizes))
    for config, often in cover.items():
        for i, k in config:
            used[i] += k * often
    scale = (used / n).max()  # so many times the cover holds the class that it holds most often
    for config, often in sorted(cover.items(), key=lambda x: (-x[1], x[0])):
        take(left, order, groups, {int(sizes[i]): k for i, k in config}, int(often / scale), capacity, out)
    # what is left: long pieces are dearer than their share, as they are harder to place later
    price = sizes / room * (1 + sizes / room)
    while left:
        config = best_configuration(sizes, price / price.max(), counts(), room)
        take(left, order, groups, {int(sizes[i]): k for i, k in config.items()}, sum(left.values()), capacity, out)
    return whole + out


def take(left: dict[int, int], order: list[int], groups: dict[int, list[int]], config: dict[int, int], often: int, capacity: int, out: Plan) -> None:
    """Fill up to ``often`` sequences by a configuration of classes, as long as there are pieces for it; ``order``
    has the lengths left, sorted."""
    while often > 0:
        pick: Counter = Counter()
        for size, k in config.items():
            for n in groups[size]:
                own = min(k, left.get(n, 0) - pick[n])
                if own > 0:
                    pick[n] += own
                    k -= own
            if k:
                return
        gap = capacity - sum(n * k for n, k in pick.items())
        while gap > 0:
            # a piece more (in place of none), or a longer one in place of one that the configuration has
            better = (0, 0, 0)
            for n in (0, *(+pick)):
                at = bisect_right(order, n + gap)
                while at and left[order[at - 1]] <= pick[order[at - 1]]:
                    at -= 1
                if at:
                    better = max(better, (order[at - 1] - n, n, order[at - 1]))
            if not better[0]:
                break
            pick[better[2]] += 1
            pick[better[1]] -= 1
            gap -= better[0]
        del pick[0]
        pick = +pick
        times = min([often, *(left[n] // k for n, k in pick.items())])
        for n, k in pick.items():
            left[n] -= times * k
            if not left[n]:
                del left[n]
                order.remove(n)
        out.append((tuple(sorted(pick.items())), times))
        often -= times


def placement(planned: Plan) -> pd.DataFrame:
    """length, first_rank, rank_end, first_sequence, per_sequence, offset: where the pieces of each rank go."""
    rank: Counter = Counter()
    rows, base = [], 0
    for contents, times in planned:
        at = 0
        for n, k in contents:
            rows.append((n, rank[n], rank[n] + k * times, base, k, at))
            rank[n] += k * times
            at += n * k
        base += times
    return pd.DataFrame(rows, columns=["length", "first_rank", "rank_end", "first_sequence", "per_sequence", "at"])


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces of all documents with sequence_id and offset.

    Null and empty texts are one end token. Longer documents are cut into pieces of ``capacity`` tokens
    and a rest. Every row of ``docs`` is packed, repeated rows too; other columns are ignored; an empty
    table packs into nothing. The plan (at most a few thousand rows, bounded by ``capacity`` and the
    number of configurations) is broadcast.
    """
    spark = docs.sparkSession
    rows = staged(pieces(docs, tokenizer, capacity, end_id))
    histogram = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect()}
    # one row for each length, of which there are ``capacity`` at most
    groups = spark.createDataFrame([(int(n), 1 + c // GROUP) for n, c in histogram.items()], "length long, groups int")
    rows = rows.join(F.broadcast(groups), "length").withColumn("deal", F.pmod(F.xxhash64("doc_id", "piece"), F.col("groups")).cast("int"))
    sizes = staged(rows.groupBy("length", "deal").agg(F.count("*").alias("n")))
    before = F.sum("n").over(W.partitionBy("length").orderBy("deal").rowsBetween(W.unboundedPreceding, -1))
    starts = sizes.select("length", "deal", F.coalesce(before, F.lit(0)).alias("ahead"))
    places = placement(plan(histogram, capacity))
    table = {n: g.to_numpy()[:, 1:] for n, g in places.groupby("length")}
    shared = spark.sparkContext.broadcast(table)
    own = F.row_number().over(W.partitionBy("length", "deal").orderBy("doc_id", "piece", "start")) - 1
    # a row for each GROUP pieces, and one for each length more
    ranked = rows.withColumn("own", own).join(size_checked(starts, 24), ["length", "deal"]).withColumn("rank", F.col("own") + F.col("ahead"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            n, rank = batch["length"].to_numpy(), batch["rank"].to_numpy()
            seq, at = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
            for length in np.unique(n):
                own, t = np.flatnonzero(n == length), shared.value[int(length)]
                t = t[np.searchsorted(t[:, 1], rank[own], "right")]
                k = rank[own] - t[:, 0]
                seq[own] = t[:, 2] + k // t[:, 3]
                at[own] = t[:, 4] + k % t[:, 3] * length
            yield batch[["doc_id", "piece", "start", "length", "ids_crc32"]].assign(sequence_id=seq, offset=at)

    kind = docs.schema["doc_id"].dataType.simpleString()
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "rank"]
    return in_frames(ranked.select(*columns), run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
