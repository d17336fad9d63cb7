"""Near-duplicate documents by SetSketch registers (operator 5).

A document is the set of its distinct five-word shingles. Each set gets SetSketch registers:
exponentially spaced, truncated minima of exponential hash values. Registers merge by maximum and two
sets agree in a register with a probability that grows with their Jaccard similarity. Bands of register
values find pairs, the likelihood of (greater, smaller, equal) registers estimates their similarity,
and full shingle sets confirm it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import DisjointSets, Words, components, group_links, in_frames, in_slices, mixed, size_checked, staged

SHINGLE = 5
BANDS, ROWS = 21, 6
REGISTERS = BANDS * ROWS
#: Register base, rate and highest value: base**254 spans sets of 1 to over 100,000 shingles in a byte.
BASE, RATE, TOP = 1.06, 20.0, 255
#: Estimated similarity from which a pair is confirmed; five standard errors below 0.85.
ESTIMATE = 0.70
#: Rows of a bucket or family that one task compares at once.
BLOCK = 400

_RNG = np.random.default_rng(7)
_ODD = _RNG.integers(1, 2**63, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POS = _RNG.integers(1, 2**63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_GRID = np.linspace(0, 1, 101)


def shingle_sets(texts: list[str | None]) -> Iterator[np.ndarray]:
    """Each text's sorted distinct 64-bit hashes of its five-word shingles; a shorter text is one shingle."""
    for a, b in in_slices(texts):
        words = Words(texts[a:b], lower=True)
        h = mixed(words.hashes())
        for x, y in zip(words.starts[:-1].tolist(), words.starts[1:].tolist()):
            k = min(SHINGLE, y - x)
            n = y - x - k + 1
            total = np.full(n if k else 0, k, np.uint64)
            for i in range(k):
                total += h[x + i : x + i + n] * _POS[i]
            yield np.unique(mixed(total))


def registers(s: np.ndarray) -> np.ndarray:
    """SetSketch registers of a set of uniform 64-bit values."""
    least = np.full(REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    for a in range(0, len(s), 2048):
        np.minimum(least, (s[None, a : a + 2048] * _ODD[:, None]).min(1), out=least)
    h = -np.log1p(-np.minimum(least.astype(np.float64) / 2.0**64, 1 - 2.0**-53)) / RATE
    return np.clip(np.floor(1 - np.log(np.maximum(h, 1e-300)) / np.log(BASE)), 0, TOP).astype(np.uint8)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union."""
    return np.maximum(a, b)


def estimate(ra: np.ndarray, rb: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity of row pairs from their registers and set sizes."""
    up, down = (ra > rb).sum(1)[:, None], (ra < rb).sum(1)[:, None]
    same = ra.shape[1] - up - down
    u, v = (na / (na + nb))[:, None], (nb / (na + nb))[:, None]

    def p(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    j = np.minimum(_GRID[None, :], np.minimum(u / v, v / u))
    plus, minus = p(u - v * j), p(v - u * j)
    with np.errstate(divide="ignore", invalid="ignore"):
        score = sum(np.where(n > 0, n * np.log(np.maximum(x, 1e-12)), 0) for n, x in ((up, plus), (down, minus), (same, 1 - plus - minus)))
    return j[np.arange(len(j)), score.argmax(1)]


def sketch(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, digest (of the whole set; null if empty), registers."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = shingle_sets(batch["text"].tolist())
            rows = [(len(s), xxhash.xxh3_128_digest(s.tobytes()), registers(s).tobytes()) if len(s) else (0, None, None) for s in sets]
            yield pd.DataFrame(rows, columns=["n_shingles", "digest", "registers"]).assign(doc_id=batch["doc_id"].to_numpy())[["doc_id", "n_shingles", "digest", "registers"]]

    kind = docs.schema["doc_id"].dataType.simpleString()
    return in_frames(docs.select("doc_id", "text"), run, f"doc_id {kind}, n_shingles long, digest binary, registers binary")


def _likely(regs: np.ndarray, size: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pairs whose estimated similarity reaches ESTIMATE, and the estimates; compared in slices."""
    out = []
    for a in range(0, len(i), 20_000):
        x, y = i[a : a + 20_000], j[a : a + 20_000]
        near = np.minimum(size[x], size[y]) >= 0.8 * np.maximum(size[x], size[y])
        x, y = x[near], y[near]
        near = (regs[x] == regs[y]).sum(1) >= 0.5 * REGISTERS
        x, y = x[near], y[near]
        e = estimate(regs[x], regs[y], size[x], size[y]) if len(x) else np.zeros(0)
        out.append((x[e >= ESTIMATE], y[e >= ESTIMATE], e[e >= ESTIMATE]))
    return tuple(np.concatenate(c) for c in zip(*out)) if out else (i, j, np.zeros(0))


def _by_sketch(group: pd.DataFrame):
    """Likely pairs by registers."""
    size = group["n_shingles"].to_numpy().astype(float)
    regs = np.frombuffer(b"".join(group["registers"]), np.uint8).reshape(len(group), REGISTERS)
    return lambda x, y, some: _likely(regs, size, x, y)[:2]


def shared(own: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray | None:
    """Intersection sizes of the pairs of sets, as a product of incidence matrices over the values that two sets
    have; None where that takes longer than pair by pair. Both are exact."""
    rows = np.unique(np.concatenate([x, y]))
    flat = np.concatenate([own[r] for r in rows])
    values, at, n = np.unique(flat, return_inverse=True, return_counts=True)
    often = n > 1
    width = int(often.sum())
    left, right = np.unique(x), np.unique(y)
    if len(left) * len(right) * width > len(x) * 200_000:
        return None
    place, line = np.cumsum(often) - 1, np.repeat(np.arange(len(rows)), [len(own[r]) for r in rows])
    keep = often[at]
    column, line = place[at[keep]], line[keep]
    out = np.zeros((len(left), len(right)), np.float32)
    u, v = np.searchsorted(rows, left), np.searchsorted(rows, right)
    for a in range(0, width, 4096):
        here = (column >= a) & (column < a + 4096)
        m = np.zeros((len(rows), min(4096, width - a)), np.float32)
        m[line[here], column[here] - a] = 1
        out += m[u] @ m[v].T
    return out[np.searchsorted(left, x), np.searchsorted(right, y)].astype(np.int64)


def _by_sets(threshold: int):
    """Pairs confirmed on full sets; where they are taken one by one, estimates choose the order, so that few pairs of
    one class are compared."""

    def comparer(group: pd.DataFrame):
        own = list(shingle_sets(group["text"].tolist()))
        size = np.array([len(s) for s in own])
        regs: list[np.ndarray] = []

        def linked(x: np.ndarray, y: np.ndarray, some: bool) -> tuple[np.ndarray, np.ndarray]:
            near = 100 * np.minimum(size[x], size[y]) >= threshold * np.maximum(size[x], size[y])
            x, y = x[near], y[near]
            if len(x) and (both := shared(own, x, y)) is not None:
                good = 100 * both >= threshold * (size[x] + size[y] - both)
                return x[good], y[good]
            if len(x) > 30:
                if not regs:
                    regs.append(np.stack([registers(s) for s in own]))
                x, y, e = _likely(regs[0], size.astype(float), x, y)
                order = np.argsort(-e, kind="stable")
                x, y = x[order], y[order]
            sets, keep = DisjointSets(len(own)), []
            for k, (a, b) in enumerate(zip(x.tolist(), y.tolist())):
                if some and sets.find(a) == sets.find(b):
                    continue
                n = len(own[a]) + len(own[b])
                both = len(np.intersect1d(own[a], own[b], assume_unique=True))
                if 100 * both >= threshold * (n - both):
                    sets.join(a, b)
                    keep.append(k)
            return x[keep], y[keep]

        return linked

    return comparer


def _digested(docs: DataFrame) -> DataFrame:
    """doc_id, text, digest (as ``sketch`` has it)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(digest=[xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in shingle_sets(batch["text"].tolist())])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return in_frames(docs.select("doc_id", "text"), run, f"doc_id {kind}, text string, digest binary")


def _judged(docs: DataFrame, threshold: int) -> DataFrame:
    """``near_duplicates`` with the digest of each row's set. Sets are named by digest until classes are known."""
    rows = staged(sketch(docs))
    nodes = staged(
        rows.where("n_shingles > 0 and doc_id is not null").groupBy("digest").agg(F.min(F.struct("doc_id", "n_shingles", "registers")).alias("s"))
        .select(F.col("digest").alias("id"), F.col("s.doc_id"), F.col("s.n_shingles"), F.col("s.registers"))
    )
    key = F.explode(F.array(*[F.xxhash64(F.lit(k), F.expr(f"substring(registers, {k * ROWS + 1}, {ROWS})")) for k in range(BANDS)]))
    bands = nodes.select("id", key.alias("band"))
    shared = bands.groupBy("band").agg(F.count("*").alias("n_key")).where("n_key > 1")
    members = bands.join(shared, "band").join(nodes.select("id", "n_shingles", "registers"), "id")
    pairs = staged(group_links(members, "band", BLOCK, _by_sketch, 4 * BLOCK).distinct())

    family = staged(components(pairs).select("id", F.col("component").alias("family")))
    sized = family.join(family.groupBy("family").agg(F.count("*").alias("n_key")), "family")
    sized = staged(sized.join(nodes.select("id", "doc_id"), "id"))
    near = size_checked(staged(sized.select("doc_id").distinct()), 16)
    texts = _digested(docs.join(near, "doc_id", "left_semi")).withColumnRenamed("digest", "id")
    texts = texts.join(size_checked(sized, 96), ["doc_id", "id"]).drop("doc_id")
    links = group_links(texts, "family", BLOCK, _by_sets(threshold))
    classes = staged(components(links).join(nodes.select("id", "doc_id"), "id"))
    first = classes.groupBy("component").agg(F.min(F.struct("doc_id", "id")).alias("first"))
    classes = classes.join(first, "component").select(F.col("id").alias("digest"), "first")
    out = rows.join(nodes.select(F.col("id").alias("digest"), F.col("doc_id").alias("own")), "digest", "left").join(classes, "digest", "left")
    out = out.withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("first.doc_id", "own", "doc_id")))
    kept = (F.col("doc_id") == F.col("component_id")) & F.coalesce(F.col("digest") == F.col("first.id"), F.lit(True))
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(kept, F.lit(True)).alias("kept"), "digest")


def near_duplicates(docs: DataFrame, threshold: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``.

    Two documents are linked if 100 * |intersection| >= threshold * |union| of their shingle sets.
    Null or empty texts have no shingle and stand alone. Rows with equal sets are one class before any
    pair is formed. A class is named by its smallest doc_id; rows that repeat a doc_id
    are classed each by its own text, and of several sets under a class's doc_id the one with the smallest
    digest is kept. A null doc_id is linked with nothing, its
    component is null and it is kept. Other columns are ignored. Large groups are compared with a few leads and
    only what these leave with all others; a group yields a spanning forest, never all its pairs. Texts of any
    length are read whole; an empty table gives no rows.
    """
    return _judged(docs, threshold).drop("digest")


def one_of_each(docs: DataFrame, threshold: int = 85) -> DataFrame:
    """The rows of ``docs``, all columns, that stand for their class; of rows that repeat a doc_id and its
    text one stays, rows with a null doc_id all stay."""
    judged = _judged(docs, threshold).where("doc_id is not null").select("doc_id", "digest", "kept")
    judged = staged(judged.groupBy("doc_id", "digest").agg(F.min("kept").alias("kept")))
    ids = staged(judged.groupBy("doc_id").agg(F.min("kept").alias("all"), F.max("kept").alias("some")).where("not all"))
    out = docs.join(size_checked(staged(ids.where("not some").select("doc_id")), 16), "doc_id", "left_anti")
    parted = staged(ids.where("some").select("doc_id"))
    if not parted.isEmpty():  # ids with texts that stay and texts that go
        lost = _digested(docs.join(size_checked(parted, 16), "doc_id", "left_semi"))
        lost = staged(lost.join(judged.where("not kept").select("doc_id", "digest"), ["doc_id", "digest"], "left_semi").select("doc_id", "text").distinct())
        out = out.join(lost, ["doc_id", "text"], "left_anti")
    out = out.select(docs.columns)
    repeated = docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1")
    return out if repeated.isEmpty() else out.where("doc_id is not null").dropDuplicates(["doc_id", "text"]).union(out.where("doc_id is null"))
