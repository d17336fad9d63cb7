"""Benchmark decontamination by q-gram lemma filtering (operator 6).

A passage of ``window`` characters of a benchmark item that occurs in a document with at most ``k`` edits
shares at least ``window - q + 1 - k * q`` q-grams with it, all of them on diagonals (document position
less item position) at most ``k`` apart. Shared q-grams are counted in overlapping diagonal bands; bands
that meet the bound are verified by banded alignment.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_frames, in_slices, mixed, size_checked, staged

Q = 12
WINDOW = 100
#: Edits allowed in a window, as a share of its characters.
EDIT_RATE = 0.05
#: Benchmark characters in one broadcast index; a larger benchmark is searched in several passes.
INDEX_CHARS = 4_000_000

_CLEAN = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
_PLAIN = {b: " " for b in range(128) if not chr(b).isalnum()}


def cleaned(text: str | None) -> str:
    """Lower case, with runs of white space and ASCII punctuation as one space."""
    text = text or ""
    if text.isascii():
        return b" ".join(text.encode().translate(_CLEAN).split()).decode()
    return " ".join(text.lower().translate(_PLAIN).split())


def points(text: str) -> np.ndarray:
    """The code points of a text."""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def grams(c: np.ndarray) -> np.ndarray:
    """A 64-bit hash for each q-gram of code points, by doubling: 1, 2, 4, 8, then 8 and 4 after it."""
    n = len(c) - Q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    two = (c[:-1].astype(np.uint64) << np.uint64(32)) | c[1:]
    four = mixed(two[:-2] + mixed(two[2:]))
    eight = four[:-4] + four[4:] * np.uint64(0x9E3779B97F4A7C15)
    return mixed(eight[:n] + four[8 : 8 + n] * np.uint64(0xC2B2AE3D27D4EB4F))


def budget(item: str) -> int:
    """Edits allowed in a window of the item: fewer in a short one, so that its bound stays positive."""
    n = min(WINDOW, len(item))
    return max(0, min(int(EDIT_RATE * n), (n - Q) // Q))


class Index:
    """q-gram positions of benchmark items. Items shorter than a q-gram are looked up whole."""

    BITS = 22

    def __init__(self, items: list[tuple[int, str]]):
        self.short: dict[str, list[int]] = {}
        for i, t in items:
            if 0 < len(t) < Q:
                self.short.setdefault(t, []).append(i)
        self.items = items = [(i, t) for i, t in items if len(t) >= Q]
        self.bodies = [points(t) for _, t in items]
        self.budget = [budget(t) for _, t in items]
        own = [grams(c) for c in self.bodies]
        item = np.repeat(np.arange(len(items)), [len(g) for g in own])
        pos = np.concatenate([np.arange(len(g)) for g in own]) if own else np.zeros(0, np.int64)
        h = np.concatenate(own) if own else np.zeros(0, np.uint64)
        order = np.argsort(h, kind="stable")
        self.keys, first = np.unique(h[order], return_index=True)
        self.first = np.append(first, len(h))
        self.item, self.pos = item[order], pos[order]
        self.bitmap = np.zeros(1 << self.BITS, bool)
        self.bitmap[(self.keys >> np.uint64(64 - self.BITS)).astype(np.int64)] = True

    def bound(self, k: int) -> int:
        n = len(self.items[k][1])
        return min(WINDOW, n) - Q + 1 - self.budget[k] * Q

    def hits(self, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(position in the text, item, position in item) of all shared q-grams."""
        h = grams(c)
        at = np.flatnonzero(self.bitmap[(h >> np.uint64(64 - self.BITS)).astype(np.int64)])
        h = h[at]
        k = np.searchsorted(self.keys, h)
        k[k == len(self.keys)] = 0
        real = self.keys[k] == h if len(self.keys) else np.zeros(len(h), bool)
        at, k = at[real], k[real]
        n = self.first[k + 1] - self.first[k]
        place = np.repeat(self.first[k] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return np.repeat(at, n), self.item[place], self.pos[place]


def windows_aligned(body: np.ndarray, width: int, starts: np.ndarray, text: np.ndarray, low: int, high: int, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fewest edits, and from and to where in ``text``, for ``body[s : s + width]`` of each start s, at any place
    whose diagonals stay in [low, high]; a window that takes more than ``most`` edits has ``most + 1``.

    All windows advance together: for a number of edits and a diagonal, the farthest place of the body
    reached. Past either end of ``text`` no character matches.
    """
    n, wide = len(body), high - low + 1
    over = np.zeros(n + wide - 1, "<u4")  # text from low on; no cleaned text has a zero
    a, b = max(0, low), min(len(text), n + high)
    if a < b:
        over[a - low : b - low] = text[a:b]
    same = np.lib.stride_tricks.sliding_window_view(over, n) == body
    ends = np.full((wide, n + 1), n)  # where the run of equal characters from a place ends
    ends[:, :-1] = np.minimum.accumulate(np.where(same, n, np.arange(n))[:, ::-1], 1)[:, ::-1]
    own, goal = np.arange(wide), (starts + width)[:, None]
    far = np.minimum(ends[:, starts].T, goal)
    begin = np.broadcast_to(own, far.shape)
    edits, first, last = np.full(len(starts), most + 1), np.zeros(len(starts), int), np.zeros(len(starts), int)
    for e in range(most + 1):
        if e:
            ways = np.stack([far + 1, np.full_like(far, -1), np.full_like(far, -1)])
            ways[1, :, 1:], ways[2, :, :-1] = far[:, :-1], far[:, 1:] + 1  # a character more in the text, or less
            origin = np.stack([begin, np.roll(begin, 1, 1), np.roll(begin, -1, 1)])
            best = ways.argmax(0)[None]
            far, begin = np.take_along_axis(ways, best, 0)[0], np.take_along_axis(origin, best, 0)[0]
            far = np.minimum(ends[own, np.minimum(far, goal)], goal)
        done = (far == goal).any(1) & (edits > most)
        d = (far == goal).argmax(1)[done]
        edits[done], last[done], first[done] = e, starts[done] + width + low + d, starts[done] + low + begin[done, d]
        if (edits <= most).all():
            break
    return edits, np.clip(first, 0, len(text)), np.clip(last, 0, len(text))


def leaks_of(text: np.ndarray, item: int, index: Index, at: np.ndarray, pos: np.ndarray) -> tuple[int, int, int, int] | None:
    """(windows found, first start, last end, fewest edits) in ``text`` of all windows of the item, from its
    shared q-grams; a window found at several places counts once."""
    body, k, bound = index.bodies[item], index.budget[item], index.bound(item)
    width = min(WINDOW, len(body))
    diagonal = at - pos
    reach = k + 1
    band = diagonal // reach
    every = np.arange(len(body) - width + 1)
    hit, begins, ends, fewest = np.zeros(len(every), bool), [], [], []
    for b in np.unique(np.concatenate([band, band - 1])):  # bands of two reaches overlap by one
        own = (band == b) | (band == b + 1)
        if own.sum() < bound:
            continue
        have = np.unique(pos[own])
        starts = every[np.searchsorted(have, every + width - Q + 1) - np.searchsorted(have, every) >= bound]
        if not len(starts):
            continue
        edits, first, last = windows_aligned(body, width, starts, text, int(b) * reach, int(b + 2) * reach - 1, k)
        if (good := edits <= k).any():
            hit[starts[good]] = True
            begins.append(int(first[good].min()))
            ends.append(int(last[good].max()))
            fewest.append(int(edits[good].min()))
    return (int(hit.sum()), min(begins), max(ends), min(fewest)) if begins else None


def search(texts: list[str | None], index: Index) -> Iterator[tuple[int, int, int, int, int, int]]:
    """(text number, item, windows of the item found, first start, last end, fewest edits in a window)."""
    least = min((index.bound(k) for k in range(len(index.items))), default=0)
    gap = np.zeros(Q, "<u4")  # no cleaned text has a zero
    for a, b in in_slices(texts):
        clean = [cleaned(t) for t in texts[a:b]]
        for d, t in enumerate(clean):
            for item in index.short.get(t, ()):
                yield a + d, item, 1, 0, len(t), 0
        clean = [points(t) for t in clean]
        starts = np.cumsum([0] + [len(t) + Q for t in clean])
        at, item, pos = index.hits(np.concatenate([x for t in clean for x in (t, gap)]))
        if not len(at):
            continue
        doc = np.searchsorted(starts, at, "right") - 1
        key = doc * len(index.items) + item
        order = np.argsort(key, kind="stable")
        key, at, pos = key[order], at[order], pos[order]
        cuts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))
        for x, y in zip(cuts[:-1], cuts[1:]):
            if y - x < least:
                continue
            d, k = divmod(int(key[x]), len(index.items))
            if found := leaks_of(clean[d], k, index, at[x:y] - starts[d], pos[x:y]):
                yield a + d, index.items[k][0], *found


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, windows, start, end, edits: a row for each document and item with a shared passage.

    Every window of the item is tried, at each of its characters; windows is how many of them the document
    holds. start and end are places in the cleaned text. Null and empty texts and items match nothing; an item
    of fewer than ``Q`` cleaned characters, which has no q-gram, is found where it is the whole document.
    Repeated rows give repeated results, items with equal texts one each; an empty table gives none. The benchmark is read in order of its characters in groups of INDEX_CHARS, one
    broadcast index each, so a task's memory doesn't grow with it.
    """
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    item_kind = benchmark.schema["item_id"].dataType.simpleString()
    items = benchmark.select("item_id", "text").where("item_id is not null and text is not null").dropDuplicates(["item_id", "text"])
    n_chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = -(-n_chars // INDEX_CHARS) or 1
    out = None
    for k in range(parts):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == k) if parts > 1 else items
        rows = [(r["item_id"], cleaned(r["text"])) for r in own.collect()]
        index = Index(rows)
        shared = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            for batch in batches:
                ids = batch["doc_id"].to_numpy()
                rows = list(search(batch["text"].tolist(), shared.value))
                found = pd.DataFrame(rows, columns=["doc_id", "item_id", "windows", "start", "end", "edits"])
                yield found.assign(doc_id=ids[found["doc_id"].to_numpy(int)])

        part = in_frames(docs.select("doc_id", "text"), run, f"doc_id {kind}, item_id {item_kind}, windows int, start long, end long, edits int")
        out = part if out is None else out.union(part)
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that share no passage with the benchmark."""
    found = staged(leaks(docs, benchmark).select("doc_id").distinct())
    return docs.join(size_checked(found, 16), "doc_id", "left_anti").select(docs.columns)
