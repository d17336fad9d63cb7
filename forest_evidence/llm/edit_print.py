"""Document fingerprints by randomised edit embedding (operator 7).

A walk over a text's characters repeats each one for a random time and goes on; the times come from
random bits shared by all texts, so that the walks of texts a small edit distance apart soon meet again
and their embeddings are a small Hamming distance apart. A fingerprint samples the embedding at fixed
places, spread over a scale that is a power of two near the embedding's length, and at the scales next
to it. Fingerprints agree in a share of places that follows the edit distance; bands of sampled
places find near pairs, which are then verified.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, group_links, in_frames, mixed, staged

#: Places sampled at each scale; each is a hexadecimal digit of the fingerprint.
SAMPLES = 128
#: Characters that a sample looks at from its place on.
GRAM = 4
PERIOD, CLASSES = 4096, 64
#: Samples in a band, and bands: pairs at LEAST_LIKENESS share one in 99 of 100 cases.
BAND, N_BANDS = 6, 32
LEAST_LIKENESS = 0.7
#: Rows of a band that one task compares at once.
BLOCK = 512

_RNG = np.random.default_rng(11)
_BITS = _RNG.integers(0, 2, (CLASSES, PERIOD), dtype=np.int8)
_PLACE = _RNG.random(SAMPLES)
_SALT = _RNG.integers(1, 2**63, SAMPLES, dtype=np.uint64) | np.uint64(1)


def _steps() -> list[list[int]]:
    """How long the walk stays on a character of a class from a time on: until a random bit is 1."""
    out = []
    for row in _BITS:
        row = row.copy()
        row[-1] = 1
        ones = np.flatnonzero(np.concatenate([row, row]))
        at = np.arange(PERIOD)
        out.append((ones[np.searchsorted(ones, at)] - at + 1).tolist())
    return out


_STEPS = _steps()
_OF_CHARACTER: dict[str, list[int]] = {}


def _row(c: str) -> list[int]:
    got = _OF_CHARACTER.get(c)
    if got is None:
        got = _OF_CHARACTER[c] = _STEPS[(ord(c) * 0x9E3779B1 >> 7) % CLASSES]
    return got


def walk(text: str, time: int = 0) -> np.ndarray:
    """The time at which the walk reaches each character, and the end."""
    mask, rows = PERIOD - 1, {c: _row(c) for c in set(text)}
    times = [time]
    times += [time := time + row[time & mask] for row in map(rows.__getitem__, text)]
    return np.array(times, np.int64)


def grams(text: str, at: np.ndarray) -> np.ndarray:
    """A hash for the character at each place with those after it; 0 past the end."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    c = np.append(c, np.zeros(GRAM, "<u4"))
    h = np.zeros(len(at), np.uint64)
    for k in range(GRAM):
        there = (at + k < len(text)).astype(np.uint64)
        h += (c[np.minimum(at + k, len(text))] + np.uint64(1)) * there * np.uint64((0x9E3779B97F4A7C15 * (2 * k + 1)) % 2**64 | 1)
    return (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)


#: Characters of a fingerprint; the last stands for a place past the end.
_DIGITS = np.frombuffer(b"0123456789abcdef-", np.uint8)


def fingerprint(text: str, times: np.ndarray | None = None) -> str:
    """Scale (two digits), then SAMPLES digits at half the scale, at it and at twice it."""
    times = walk(text) if times is None else times
    scale = max(1, int(times[-1]) - 1).bit_length()
    place = np.concatenate([(_PLACE * 2.0**s).astype(np.int64) for s in (scale - 1, scale, scale + 1)])
    at = np.minimum(np.searchsorted(times, place, "right") - 1, len(text))
    digit = (grams(text, at) * np.tile(_SALT, 3)) >> np.uint64(60)
    # past the end there is nothing to agree on: an empty place, told apart from any digit
    digit[at >= len(text)] = 16
    return f"{scale:02x}" + _DIGITS[digit.astype(np.intp)].tobytes().decode()


def likeness(a: str, b: str) -> float:
    """0 to 1: the share of places that agree, less what chance agrees; places that are past both ends
    don't count. Texts whose scales are more than one apart have likeness 0."""
    if a == b:
        return 1.0
    sa, sb = int(a[:2], 16), int(b[:2], 16)
    if abs(sa - sb) > 1:
        return 0.0
    s = max(sa, sb)
    x = a[2 + (s - sa + 1) * SAMPLES :][:SAMPLES]
    y = b[2 + (s - sb + 1) * SAMPLES :][:SAMPLES]
    x, y = np.frombuffer(x.encode(), np.uint8), np.frombuffer(y.encode(), np.uint8)
    seen = (x != 45) | (y != 45)
    if not seen.any():
        return 0.0
    share = (x == y)[seen].mean()
    return float(max(0.0, (share - 1 / 16) / (15 / 16)))


def edited_after(text: str, following: str) -> tuple[str, int]:
    """The text with its last third replaced by as much of the following text, and the kept length."""
    third = len(text) // 3
    kept = len(text) - third
    return text[:kept] + following[:third], kept


class Read:
    """A document with its walk and fingerprint, made once."""

    def __init__(self, doc_id, text: str):
        self.doc_id, self.text, self.times = doc_id, text, walk(text)
        self.print = fingerprint(text, self.times)

    def row(self, following: Read) -> tuple:
        """The result for this document and the one that follows it."""
        edited, kept = edited_after(self.text, following.text)
        again = np.concatenate([self.times[:kept], walk(edited[kept:], int(self.times[kept]))])
        edited_print = fingerprint(edited, again)
        sha = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
        return self.doc_id, len(self.text), sha, self.print, edited_print, likeness(self.print, edited_print), likeness(self.print, following.print)


_COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def edited_prints(docs: DataFrame) -> DataFrame:
    """The fingerprint of each text and of its text edited with the next document's (descending doc_id).

    Null texts are empty; after the smallest doc_id comes the greatest; a lone document follows itself.
    doc_id is a key: rows that repeat it come in the order of their texts. Null ids come last. Texts move
    once, into ranges of doc_id; the last row of a range is joined with the first of the next.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    order = [F.col("doc_id").desc_nulls_last(), F.col("text")]
    # ranges go by doc_id alone: their bounds are found from a sample of keys on the driver
    ranged = texts.repartitionByRange(order[0]).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = None
        for batch in batches:
            rows = []
            for doc_id, text, part in zip(batch["doc_id"].tolist(), batch["text"], batch["part"]):
                own = Read(doc_id, text)
                rows.append((None,) * 7 + (text, part, True) if last is None else (*last.row(own), None, part, None))
                last = own
            yield pd.DataFrame(rows, columns=[*_COLUMNS, "text", "part", "first"], dtype=object)
        if last is not None:
            yield pd.DataFrame([(last.doc_id, *(None,) * 6, last.text, int(part), False)], columns=[*_COLUMNS, "text", "part", "first"], dtype=object)

    digest = f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    done = staged(in_frames(ranged, run, f"{digest}, text string, part int, first boolean"))
    # two rows for each range: its first text, and its last row, which waits for the next range's first
    edges = done.where("first is not null").select("doc_id", "text", "part", "first")
    parts = [r["part"] for r in edges.where("first").select("part").orderBy("part").collect()]
    after = dict(zip(parts, parts[1:] + parts[:1]))
    turn = F.create_map(*[F.lit(x) for k in after.items() for x in k]) if after else F.create_map(F.lit(0), F.lit(0))
    waiting = edges.where("not first").withColumn("part", turn[F.col("part")]).alias("a")
    waiting = waiting.join(edges.where("first").alias("b"), "part").select("a.doc_id", F.col("a.text").alias("text"), F.col("b.text").alias("following"))

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([Read(d, t).row(Read(None, f)) for d, t, f in zip(batch["doc_id"].tolist(), batch["text"], batch["following"])], columns=_COLUMNS, dtype=object)

    return done.where("first is null").select(*_COLUMNS).union(in_frames(waiting, finish, digest))


#: The value of each hexadecimal digit's character.
_VALUE = np.array([int(chr(c), 16) if chr(c) in "0123456789abcdef" else 0 for c in range(128)])


def likenesses(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``likeness`` of the rows of two matrices of fingerprints' characters, row by row."""
    sa, sb = (_VALUE[m[:, 0]] * 16 + _VALUE[m[:, 1]] for m in (a, b))
    s, places = np.maximum(sa, sb), np.arange(SAMPLES)
    reach = np.abs(sa - sb) <= 1

    def section(m, own):
        first = 2 + np.where(reach, s - own + 1, 1) * SAMPLES
        return np.take_along_axis(m, first[:, None] + places, 1)

    x, y = section(a, sa), section(b, sb)
    seen = (x != 45) | (y != 45)
    share = ((x == y) & seen).sum(1) / np.maximum(1, seen.sum(1))
    out = np.where(reach & seen.any(1), np.maximum(0.0, (share - 1 / 16) / (15 / 16)), 0.0)
    return np.where((a == b).all(1), 1.0, out)


#: The samples of each band: places drawn at random.
_BANDS = np.stack([np.random.default_rng(100 + k).choice(SAMPLES, BAND, replace=False) for k in range(N_BANDS)])


def bands(prints: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text, key) of each band without a place past the end, at the scale below a text's own, which it fills,
    and at its own, where it meets texts of the next longer one."""
    m = np.frombuffer("".join(prints).encode(), np.uint8).reshape(len(prints), -1)
    scale = np.array([int(p[:2], 16) for p in prints], np.uint64)
    rows, keys = [], []
    for up in (0, 1):  # sections of the scale below, and of the own one
        own = m[:, 2 + up * SAMPLES :][:, :SAMPLES][:, _BANDS]
        packed = np.zeros(own.shape[:2], np.uint64)
        for k in range(BAND):
            packed = packed << np.uint64(8) | own[:, :, k]
        row, band = np.nonzero((own != 45).all(2))
        label = (scale[row] + np.uint64(up)) * np.uint64(256) + band.astype(np.uint64)
        rows.append(row)
        keys.append(mixed(packed[row, band] ^ mixed(label + np.uint64(1))).view(np.int64))
    return np.concatenate(rows), np.concatenate(keys)


def near_classes(docs: DataFrame, least: float = LEAST_LIKENESS) -> DataFrame:
    """doc_id, class_id for every row of ``docs``: the smallest doc_id reachable by links.

    Two texts are linked if they share a band of sampled places and their whole fingerprints have a
    likeness of ``least`` or more. Equal fingerprints are one class before any pair is formed. All rows of a
    band are compared, in blocks of ``BLOCK``; a pair of blocks yields a spanning forest of its links. Null
    texts are empty; a null doc_id is linked with nothing and has a null class. Other columns are ignored.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "print": [fingerprint(t or "") for t in batch["text"]]})

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                row, key = bands(batch["print"].tolist())
                yield pd.DataFrame({"id": batch["id"].to_numpy()[row], "band": key})

    def comparer(group: pd.DataFrame):
        m = np.frombuffer("".join(group["print"]).encode(), np.uint8).reshape(len(group), -1)

        def linked(x: np.ndarray, y: np.ndarray, some: bool) -> tuple[np.ndarray, np.ndarray]:
            near = [likenesses(m[x[a : a + 20_000]], m[y[a : a + 20_000]]) >= least for a in range(0, len(x), 20_000)]
            near = np.concatenate(near) if near else np.zeros(0, bool)
            return x[near], y[near]

        return linked

    rows = staged(in_frames(docs.select("doc_id", "text"), run, f"doc_id {kind}, print string"))
    nodes = staged(rows.where("doc_id is not null").groupBy("print").agg(F.min("doc_id").alias("id")))
    keys = staged(in_frames(nodes, keyed, f"id {kind}, band long"))
    shared = keys.groupBy("band").agg(F.count("*").alias("n_key")).where("n_key > 1")
    members = keys.join(shared, "band").join(nodes, "id")
    classes = components(group_links(members, "band", BLOCK, comparer, 4 * BLOCK))
    out = rows.join(nodes, "print", "left").join(classes, "id", "left")
    return out.select("doc_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "id")).alias("class_id"))
