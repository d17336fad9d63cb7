"""Repeated passages by recompression (operator 9).

Words are the first symbols. A round names maximal runs of one symbol, then pairs of neighbours whose
left and right symbol fall in different halves of the alphabet. A name is a hash of what it stands for,
so that equal passages get equal symbols everywhere but near their ends, without a table of names. With
each symbol goes the stretch of words that decides it. A window of ``WINDOW`` words is represented by one
symbol of the highest level decided inside it; equal windows choose the same one. Spark counts the
symbols over the corpus; windows whose symbol occurs once are unique, the words of the others are compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, hub_join, in_frames, in_slices, mixed, staged

WINDOW = 20
LEVELS = 2
#: Occurrences of a symbol that one task verifies at once.
BLOCK = 20_000
#: Consecutive windows of one symbol in a row, at most.
STRETCH = 256
#: Characters handled at once, so that a pass's arrays stay in the processor's cache.
SLICE = 600_000

_FAR = np.int64(1) << 40
_NONE = np.iinfo(np.uint64).max
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mixed(a * _A + mixed(b) * _B + _C)


class Level:
    """Symbols of consecutive texts with the words they cover [at, to) and that decide them [low, high)."""

    def __init__(self, name, at, to, low, high, text):
        self.name, self.at, self.to, self.low, self.high, self.text = name, at, to, low, high, text

    def neighbours(self):
        """Low of the left and high of the right neighbour; out of reach beyond a text's ends."""
        same = self.text[1:] == self.text[:-1]
        left = np.concatenate([[-_FAR], np.where(same, self.low[:-1], -_FAR)])
        right = np.concatenate([np.where(same, self.high[1:], _FAR), [_FAR]])
        return left, right

    def runs(self) -> Level:
        """Maximal runs of one symbol as one symbol; what ends a run decides it too."""
        new = np.ones(len(self.name), bool)
        new[1:] = (self.name[1:] != self.name[:-1]) | (self.text[1:] != self.text[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(new)) - 1
        left, right = self.neighbours()
        n = (last - first + 1).astype(np.uint64)
        name = np.where(n > 1, joined(self.name[first], n), self.name[first])
        return Level(name, self.at[first], self.to[last], np.minimum(self.low[first], left[first]), np.maximum(self.high[last], right[last]), self.text[first])

    def pairs(self, level: int) -> Level:
        """Neighbours (left half, right half) of the alphabet as one symbol."""
        right_half = (mixed(self.name + np.uint64(level)) >> np.uint64(63)).astype(bool)
        with_next = np.zeros(len(self.name), bool)
        with_next[:-1] = ~right_half[:-1] & right_half[1:] & (self.text[1:] == self.text[:-1])
        second = np.concatenate([[False], with_next[:-1]])
        left, right = self.neighbours()
        low = np.where(right_half, np.minimum(self.low, left), self.low)
        high = np.where(right_half, self.high, np.maximum(self.high, right))
        name, to = self.name.copy(), self.to.copy()
        i = np.flatnonzero(with_next)
        name[i] = joined(self.name[i], self.name[i + 1])
        to[i] = self.to[i + 1]
        low[i] = np.minimum(self.low[i], self.low[i + 1])
        high[i] = np.maximum(self.high[i], self.high[i + 1])
        keep = ~second
        return Level(name[keep], self.at[keep], to[keep], low[keep], high[keep], self.text[keep])


def window_hashes(h: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the ``WINDOW`` words from each place; the last ones run out of the array."""
    out, width = mixed(h), 1
    # doubling: 1, 2, 4, 8, 16 and then 20 = 16 + 4
    four = None
    while width < 16:
        moved = np.zeros_like(out)
        moved[: len(out) - width] = out[width:]
        out = joined(out, moved)
        width *= 2
        if width == 4:
            four = out
    moved = np.zeros_like(out)
    if len(out) > 16:
        moved[:-16] = four[16:]
    return joined(out, moved)


def anchors(h: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place of the concatenated texts at which a window begins: the window's place, and the place
    (in the second array's pairs) of the symbol that represents it.

    Of the symbols of the highest level that are decided inside a window, the least key represents it. Where
    a key comes twice, either stands for it.
    """
    n, size = len(h), np.diff(starts)
    place = np.arange(n, dtype=np.int64)
    text = np.repeat(np.arange(len(size)), size)
    todo = place[place + WINDOW <= starts[1:][text]]
    levels = [Level(h, place, place + 1, place, place + 1, text)]
    for k in range(1, LEVELS + 1):
        levels.append(levels[-1].runs().pairs(k))
    total = np.concatenate([[np.uint64(0)], np.cumsum(mixed(h) * _powers(n), dtype=np.uint64)])
    key = np.zeros(n, np.uint64)
    at = np.full(n, -1, np.int64)
    for k in range(LEVELS, -1, -1):
        level = levels[k]
        ok = np.flatnonzero((level.high - level.low <= WINDOW) & (level.low >= 0))
        low, high = level.low[ok], level.high[ok]
        # the key is the symbol with all words that decide it, and its place among them
        name = joined(level.name[ok], (total[high] - total[low]) * _inverse(low, n))
        name = joined(name, (level.at[ok] - low + 32 * k).astype(np.uint64))
        best = least_inside(name & ~_PLACE | np.arange(len(name), dtype=np.uint64) & _PLACE, low, high - low, n)
        done = best[todo] != _NONE
        own = todo[done]
        # the rank among the level's symbols, from its low bits: the one near the window
        rank = np.searchsorted(low, own)
        rank += (((best[own] & _PLACE).astype(np.int64) - rank) & int(_PLACE))
        key[own], at[own] = name[rank], (low[rank] << 2) + k
        todo = todo[~done]
        if not len(todo):
            break
    return key, at


#: The low bits of a value that tell a symbol's place; the others are its key's.
_PLACE = np.uint64((1 << 20) - 1)


def least_inside(value: np.ndarray, low: np.ndarray, size: np.ndarray, n: int) -> np.ndarray:
    """For each window start the least value of the symbols [low, low + size) inside the window."""
    out, own = np.full(n, _NONE), np.full(n + WINDOW, _NONE)
    order = np.argsort(size, kind="stable")
    cuts = np.searchsorted(size[order], np.arange(1, WINDOW + 2))
    for k in range(1, WINDOW + 1):  # symbols of up to k words fit from the place WINDOW - k words on
        new = order[cuts[k - 1] : cuts[k]]
        if len(new):
            x, v = low[new], value[new]
            np.minimum.at(own, x, v) if len(x) > 1 and (x[1:] == x[:-1]).any() else own.__setitem__(x, np.minimum(own[x], v))
        np.minimum(out, own[WINDOW - k : WINDOW - k + n], out=out)
    return out


_P = np.uint64(0xD1342543DE82EF95)


def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([[np.uint64(1)], np.full(max(0, n - 1), _P)]), dtype=np.uint64)[:n]


def _inverse(at: np.ndarray, n: int) -> np.ndarray:
    """_P ** -at (mod 2 ** 64)."""
    inverse = np.uint64(pow(int(_P), -1, 2**64))
    return np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, inverse)]), dtype=np.uint64)[at]


def occurrences(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, Words]:
    """(text, first window, key, number of windows) of every symbol that represents consecutive windows, at
    most ``STRETCH`` of them to a row, as arrays; and the words."""
    words = Words(texts)
    h, starts = words.hashes(), words.starts
    key, at = anchors(h, starts)
    v = np.flatnonzero(at >= 0)
    doc = np.searchsorted(starts, v, "right") - 1
    new = np.ones(len(v), bool)
    new[1:] = (at[v][1:] != at[v][:-1]) | (doc[1:] != doc[:-1])
    since = np.arange(len(v)) - np.maximum.accumulate(np.where(new, np.arange(len(v)), 0))
    cut = np.flatnonzero(since % STRETCH == 0)
    return doc[cut], v[cut] - starts[doc[cut]], key[v[cut]].view(np.int64), np.diff(np.append(cut, len(v))), words


def _symbols(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        ids, texts = batch["doc_id"].to_numpy(), batch["text"].tolist()
        for a, b in in_slices(texts, SLICE):
            doc, first, key, _, _ = occurrences(texts[a:b])
            yield pd.DataFrame({"doc_id": ids[a + doc], "pos": first, "key": key})


def _repeated_windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The words of the windows of the symbols at the places listed in ``marks`` (twice the place, odd if hot)."""
    for batch in batches:
        texts, ids, marks = batch["text"].tolist(), batch["doc_id"].to_numpy(), batch["marks"].tolist()
        for a, b in in_slices(texts, SLICE):
            doc, first, key, n, words = occurrences(texts[a:b])
            size = [len(m) for m in marks[a:b]]
            wanted = np.concatenate(marks[a:b]).astype(np.int64) + (np.repeat(np.arange(b - a), size) << 33)
            place = (doc << 33) + 2 * first
            hot = np.isin(place + 1, wanted)
            keep = np.flatnonzero(hot | np.isin(place, wanted))
            begin = words.starts[doc[keep]] + first[keep]
            plain = words.spelled()
            spelled = [" ".join([plain[c] for c in words.codes[x : x + k + WINDOW - 1].tolist()]) for x, k in zip(begin.tolist(), n[keep].tolist())]
            yield pd.DataFrame({"key": key[keep], "doc_id": ids[a + doc[keep]], "pos": first[keep], "hot": hot[keep], "words": spelled})


def first_equal(words: Words, starts: np.ndarray) -> np.ndarray:
    """For the window of words from each start, the number of the first start with the same words.

    Hashes find it and the words confirm it; should hashes of different words be equal, words alone decide.
    """
    h = window_hashes(words.hashes())[starts]
    of, values = pd.factorize(h)
    first = np.zeros(len(values), np.int64)
    first[of[::-1]] = np.arange(len(h) - 1, -1, -1)  # the last one written is the first start
    least = first[of]
    late = np.flatnonzero(least != np.arange(len(starts)))
    same = np.ones(len(late), bool)
    for j in range(WINDOW):
        same &= words.codes[starts[late] + j] == words.codes[starts[least[late]] + j]
    if not same.all():
        whole = words.codes[starts[:, None] + np.arange(WINDOW)]
        _, at, of = np.unique(whole, axis=0, return_index=True, return_inverse=True)
        least = at[of.reshape(-1)]
    return least


def _not_first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Ranges [first, past) of window starts that repeat an earlier window; rows come by key in document order.

    Equal windows have one key, so the first of a batch is the first of all unless its key began in an
    earlier batch; of that key alone the windows met are kept.
    """
    seen: dict[bytes, tuple] = {}
    last = None
    for batch in batches:
        if not len(batch):
            continue
        key, doc, pos = batch["key"].to_numpy(), batch["doc_id"].to_numpy(), batch["pos"].to_numpy().astype(np.int64)
        words = Words(batch["words"].tolist())
        size = np.diff(words.starts) - (WINDOW - 1)
        row = np.repeat(np.arange(len(batch)), size)
        step = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
        at, start = words.starts[row] + step, pos[row] + step
        least = first_equal(words, at)
        again = (doc[row] != doc[row[least]]) | (start != start[least])
        spelled = words.spelled() if key[0] == last or key[-1] != last else []

        def window(i: int, at=at, words=words, spelled=spelled) -> bytes:
            return b" ".join([spelled[c].encode() for c in words.codes[at[i] : at[i] + WINDOW].tolist()])

        if key[0] == last:
            for i in np.flatnonzero(key[row] == last).tolist():
                own = (doc[row[i]], int(start[i]))
                again[i] = seen.setdefault(window(i), own) != own
        if key[-1] != last:
            last, seen = key[-1], {}
            for i in np.flatnonzero(key[row] == last).tolist():
                seen.setdefault(window(i), (doc[row[i]], int(start[i])))
        begin = again.copy()
        begin[1:] &= ~again[:-1] | (row[1:] != row[:-1])
        end = again.copy()
        end[:-1] &= ~again[1:] | (row[1:] != row[:-1])
        x, y = np.flatnonzero(begin), np.flatnonzero(end)
        yield pd.DataFrame({"doc_id": doc[row[x]], "first": start[x], "past": start[y] + 1})


def _kept(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for doc, text, again in zip(batch["doc_id"].tolist(), batch["text"], batch["again"]):
            words = (text or "").encode().split()
            n = len(words)
            if again is not None:
                gone = np.zeros(n + 1, np.int64)
                for r in again:
                    gone[min(n, r["first"])] += 1
                    gone[min(n, r["past"] - 1 + WINDOW)] -= 1
                stay = np.cumsum(gone)[:n] == 0
                words = [w for w, k in zip(words, stay.tolist()) if k]
            rows.append((doc, n, n - len(words), hashlib.sha256(b" ".join(words)).hexdigest()))
        out = pd.DataFrame(rows, columns=["doc_id", "n_words", "n_removed", "kept_sha256"], dtype=object)
        yield out


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 for every row of ``docs``.

    A window of ``WINDOW`` words goes if the same words also start earlier, in a smaller doc_id or
    earlier in the document. Null and empty texts have no word. doc_id is a key: rows that repeat it with
    the same text are judged as one document. A row with a null doc_id is left whole. Other columns are
    ignored, an empty table gives no rows. Symbols find candidates, the words themselves decide.

    Spark's rounds: the symbols of all documents are counted; documents meet the places of those that occur
    more than once, and their words are dealt by symbol and compared. A symbol with more than BLOCK places
    is compared window by window, with partial minima before the shuffle. What a thousandth of all rows
    shares is joined by broadcast, as there can't be more than a thousand such symbols or windows.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    docs = docs.select("doc_id", "text")
    symbols = staged(in_frames(docs.where("doc_id is not null"), _symbols, f"doc_id {kind}, pos int, key long"))
    often = staged(symbols.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"))
    places = hub_join(symbols, often, ["key"], symbols.count()).withColumn("hot", (F.col("n") > BLOCK).cast("int"))
    marks = places.groupBy("doc_id").agg(F.collect_list(F.col("pos") * 2 + F.col("hot")).alias("marks"))
    # grouped by doc_id as the join needs them: not written, not dealt again
    windows = in_frames(docs.join(marks, "doc_id"), _repeated_windows, f"key long, doc_id {kind}, pos int, hot boolean, words string")
    windows = staged(windows)
    cold = windows.where("not hot").select("key", "doc_id", "pos", "words").repartition("key").sortWithinPartitions("key", "doc_id", "pos")
    again = in_frames(cold, _not_first, f"doc_id {kind}, first int, past int")
    hot = windows.where("hot")
    if not hot.isEmpty():
        word = F.split("words", " ")
        each = F.transform(F.sequence(F.lit(1), F.size(word) - WINDOW + 1), lambda i: F.array_join(F.slice(word, i, WINDOW), " "))
        each = hot.select("key", "doc_id", "pos", F.posexplode(each).alias("i", "w")).select("key", "doc_id", (F.col("pos") + F.col("i")).alias("first"), "w")
        first = staged(each.groupBy("key", "w").agg(F.min(F.struct("doc_id", "first")).alias("earliest"), F.count("*").alias("n")).where("n > 1"))
        total = first.agg(F.sum("n")).first()[0] or 0
        late = hub_join(each, first, ["key", "w"], total).where(F.struct("doc_id", "first") > F.col("earliest"))
        again = again.union(late.select("doc_id", "first", (F.col("first") + 1).alias("past")))
    again = again.groupBy("doc_id").agg(F.collect_list(F.struct("first", "past")).alias("again"))
    return in_frames(docs.join(again, "doc_id", "left"), _kept, f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string")
