"""Phrase collocation mining (operator 11): Rabin-Karp fingerprints, verified against the text.

Words get 64-bit values; a prefix polynomial over the words of a slice, times the inverse power of the
place, gives the fingerprint of every run of one to four words from two lookups (numpy, modulo 2**64).
Spark adds up fingerprints. A run can be frequent only if its parts are, so words are counted first,
then pairs of frequent words, then runs whose pairs are frequent; which fingerprints are frequent is
handed to the next pass as a bitmap of at most ``SLOTS`` bits. Where a bitmap gets crowded more runs
pass and are counted in vain; none is lost. The last pass reads the texts once more and writes out only
frequent fingerprints, as words and with a place each: occurrences whose words differ from those that
their fingerprint stands for are told apart there, so counts are those of phrases, not of fingerprints.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .common import free_name, in_slices, mixed, staged

LONGEST = 4
#: A phrase is a candidate from so many occurrences on.
LEAST = 30
#: A candidate goes if a longer one that holds it has at least this share (percent) of its occurrences.
HELD = 80
#: Phrases returned for each language.
MOST = 2000
#: Most bits of a bitmap of frequent fingerprints, which is broadcast: 64 MiB.
SLOTS = 1 << 29
#: Characters of a slice, whose fingerprints are added up before Spark sees them.
SLICE = 6_000_000

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)

#: What a byte is: 0 part of a word, 1 between words, 2 between pieces.
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = 2


def _values(distinct: pa.Array) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, distinct.to_pylist()), np.uint64, len(distinct))


class Runs:
    """The words of some texts and the fingerprints of their runs.

    ``codes`` numbers the ``distinct`` words, in order; ``piece`` tells pieces apart, ``doc`` texts.
    """

    def __init__(self, texts: list[str | None], langs: list[str | None]):
        lower = pc.ascii_lower(pa.array([t or "" for t in texts], pa.large_string()))
        starts = np.frombuffer(lower.buffers()[1], np.int64, len(texts) + 1)
        raw = np.frombuffer(lower.buffers()[2] or b"", np.uint8)[starts[0] : starts[-1]]
        starts = starts - starts[0]
        kind = _KIND[raw]
        inside = kind == 0
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        begins = starts[:-1][starts[:-1] < starts[1:]]
        first[begins] = inside[begins]
        at = np.flatnonzero(first)
        final = inside.copy()
        final[:-1] &= ~inside[1:] | first[1:]
        self.doc = np.searchsorted(starts, at, "right") - 1
        self.piece = np.searchsorted(np.flatnonzero(kind == 2), at) + self.doc
        offsets = np.concatenate([[0], np.cumsum(np.flatnonzero(final) - at + 1)])
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(raw[inside])])
        coded = words.dictionary_encode()
        self.distinct, self.codes = coded.dictionary, coded.indices.to_numpy()
        own = pa.array([x if x is not None else "und" for x in langs], pa.string()).dictionary_encode()
        self.langs, self.lang = own.dictionary.to_pylist(), own.indices.to_numpy()
        self.salt = mixed(_values(own.dictionary) + np.uint64(1))
        n = len(self.codes)
        values = mixed(_values(self.distinct))[self.codes] if n else np.zeros(0, np.uint64)
        self.back = np.cumprod(np.full(n, _INVERSE, np.uint64)) * np.uint64(_BASE)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * (np.cumprod(np.full(n, _BASE, np.uint64)) * np.uint64(_INVERSE)))])

    def places(self, length: int) -> np.ndarray:
        """Whether a run of ``length`` words of one piece begins at each word."""
        ok = np.zeros(len(self.codes), bool)
        n = len(ok) - length + 1
        if n > 0:
            ok[:n] = self.piece[:n] == self.piece[length - 1 :]
        return ok

    def prints(self, at: np.ndarray, length: int) -> np.ndarray:
        """Fingerprints of the runs of ``length`` words at the words ``at``; those of a language are its own."""
        run = (self.sums[at + length] - self.sums[at]) * self.back[at]
        return mixed(run * np.uint64(2 * length + 1) + self.salt[self.lang[self.doc[at]]])

    def same(self, at: np.ndarray, other: np.ndarray, length: int) -> np.ndarray:
        """Whether the runs at two lists of words are the same words of the same language."""
        ok = self.lang[self.doc[at]] == self.lang[self.doc[other]]
        for j in range(length):
            ok &= self.codes[at + j] == self.codes[other + j]
        return ok

    def text(self, at: np.ndarray, length: int) -> pa.Array:
        return pc.binary_join_element_wise(*[self.distinct.take(pa.array(self.codes[at + j])) for j in range(length)], pa.scalar(b" ", pa.large_binary())).cast(pa.large_string())


class Bitmap:
    """Which fingerprints may be frequent: a bit for each by its leading bits. Bounded by SLOTS bits."""

    def __init__(self, keys: DataFrame, column: str = "key"):
        want = 16 * keys.count()
        self.shift = 64 - max(16, min(SLOTS, 1 << max(1, want - 1).bit_length()).bit_length() - 1)
        slot = F.shiftrightunsigned(column, self.shift)
        blocks = keys.groupBy(F.bitmap_bucket_number(slot + 1).alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot + 1)).alias("bits"))
        bits = np.zeros(max(4096, (1 << (64 - self.shift)) // 8), np.uint8)
        for k, own in blocks.toLocalIterator():  # at most SLOTS bits in all
            bits[4096 * (k - 1) : 4096 * k] = np.frombuffer(own, np.uint8)
        self.bits = bits

    def has(self, keys: np.ndarray) -> np.ndarray:
        slot = keys >> np.uint64(self.shift)
        return (self.bits[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _added(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, how often and where each occurs first, and the number of each key."""
    coded = pa.array(keys).dictionary_encode()
    own = coded.indices.to_numpy()
    first = np.zeros(len(coded.dictionary), np.int64)
    first[own[::-1]] = np.arange(len(own) - 1, -1, -1)
    return coded.dictionary.to_numpy(), np.bincount(own, minlength=len(first)), first, own


def _over(docs: DataFrame, columns: list[str], f: Callable[[Runs, list], Iterator[dict]], schema: str) -> DataFrame:
    """``f`` over slices of texts; it gets their runs and ids and gives columns of ``schema``."""
    kind = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.set_cpu_count(1)
        for texts, langs, ids in _slices(batches):
            for out in f(Runs(texts, langs), ids):
                yield from pa.Table.from_arrays([pa.array(out[x.name], x.type) if not isinstance(out[x.name], pa.Array) else out[x.name].cast(x.type) for x in kind], schema=kind).to_batches(20_000)

    return docs.select(*columns).mapInArrow(run, schema)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list, list]]:
    """Texts, languages and ids of consecutive rows, in slices that may reach over batches."""
    held: list[list] = [[], [], []]
    n = 0
    for batch in batches:
        texts, langs, ids = (batch.column(k).to_pylist() for k in range(3))
        for a, b in in_slices(texts, SLICE // 4):
            for to, got in zip(held, (texts, langs, ids)):
                to += got[a:b]
            n += sum(len(t or "") for t in texts[a:b])
            if n >= SLICE:
                yield tuple(held)
                held, n = [[], [], []], 0
                pa.default_memory_pool().release_unused()
    if held[0]:
        yield tuple(held)


def _signed(keys: np.ndarray) -> np.ndarray:
    return keys.view(np.int64)


def _counted(docs: DataFrame, columns: list[str], runs: Callable[[Runs], Iterator[np.ndarray]]) -> DataFrame:
    """(key, n) of the fingerprints that ``runs`` gives, frequent ones alone."""

    def partial(own: Runs, ids: list) -> Iterator[dict]:
        for keys in runs(own):
            distinct, n, _, _ = _added(keys)
            yield {"key": _signed(distinct), "n": n}

    counted = _over(docs, columns, partial, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    return staged(counted.where(F.col("n") >= LEAST).select("key"))


def frequent(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> DataFrame:
    """(lang, length, phrase, f, first_doc_id) for every run of 1 to 4 words with LEAST or more occurrences, and
    a row of length 0 with the number of all words of a language.

    Null languages count as ``und``; first_doc_id is the least id of a document with the phrase.
    """
    columns = [text, lang, doc_id]
    sc = docs.sparkSession.sparkContext

    def all_words(own: Runs) -> Iterator[np.ndarray]:
        yield own.prints(np.arange(len(own.codes)), 1)

    words = _counted(docs, columns, all_words)
    known1 = sc.broadcast(Bitmap(words))

    def pairs(own: Runs) -> Iterator[np.ndarray]:
        ok = own.places(2)
        seen = known1.value.has(own.prints(np.arange(len(ok)), 1))
        ok[:-1] &= seen[:-1] & seen[1:]
        yield own.prints(np.flatnonzero(ok), 2)

    two = _counted(docs, columns, pairs)
    known2 = sc.broadcast(Bitmap(two))

    def longer(own: Runs) -> Iterator[np.ndarray]:
        ok = own.places(2)
        at = np.flatnonzero(ok)
        ok[at] = known2.value.has(own.prints(at, 2))
        for length in range(3, LONGEST + 1):
            run = own.places(length)
            for j in range(length - 1):
                run[: len(ok) - j] &= ok[j:]
            yield own.prints(np.flatnonzero(run), length)

    known = sc.broadcast(Bitmap(words.union(two).union(_counted(docs, columns, longer))))

    def spelt(own: Runs, ids: list) -> Iterator[dict]:
        numbers = np.arange(len(ids))
        order = sorted(range(len(ids)), key=lambda k: (ids[k] is None, ids[k] if ids[k] is not None else 0))
        place = np.zeros(len(ids), np.int64)
        place[order] = numbers
        words = np.bincount(own.lang[own.doc], minlength=len(own.langs))
        yield {"lang": own.langs, "length": np.zeros(len(words), np.int32), "phrase": [""] * len(words), "f": words, "first_doc_id": [None] * len(words)}
        for length in range(1, LONGEST + 1):
            at = np.flatnonzero(own.places(length))
            keys = own.prints(at, length)
            at = at[known.value.has(keys)]
            keys = own.prints(at, length)
            while len(at):
                _, _, first, number = _added(keys)
                ok = own.same(at, at[first[number]], length)
                n = np.bincount(number[ok], minlength=len(first))
                least = np.full(len(first), len(ids), np.int64)
                np.minimum.at(least, number[ok], place[own.doc[at[ok]]])
                yield {
                    "lang": pa.array(own.langs).take(pa.array(own.lang[own.doc[at[first]]])), "length": np.full(len(first), length, np.int32), "phrase": own.text(at[first], length),
                    "f": n, "first_doc_id": [ids[order[k]] for k in least.tolist()],
                }
                at, keys = at[~ok], keys[~ok]  # other words with the same fingerprint

    kind = docs.schema[doc_id].dataType.simpleString()
    rows = _over(docs, columns, spelt, f"lang string, length int, phrase string, f long, first_doc_id {kind}")
    out = rows.groupBy("lang", "length", "phrase").agg(F.sum("f").alias("f"), F.min("first_doc_id").alias("first_doc_id"))
    return staged(out.where(F.col("f") >= LEAST))


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", most: int | None = MOST) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score, first_doc_id): the ``most`` best phrases of each language, or all.

    A candidate of 2 to 4 words is scored at its weakest cut: floor(2000000 * a / (l + r)), the first of equal
    ones. Those that a longer candidate with 80 % of their occurrences holds are left out. Null and empty
    texts have no words, a null language is ``und``; repeated rows count each; other columns are ignored,
    words of any length are whole. Equal scores are ordered by ``a``, then by the phrase's bytes. An empty
    table gives no rows.
    """
    found = frequent(docs, text, lang, doc_id)
    sizes = found.where("length = 0").select("lang", F.col("f").alias("n"))
    split = F.split("phrase", " ")
    big = found.where("length > 1").select("lang", "phrase", "length", F.col("f").alias("a"), "first_doc_id", split.alias("ws"))
    joined = lambda a, n: F.array_join(F.slice("ws", a, n), " ")
    cuts = big.select("lang", "phrase", "length", "a", "first_doc_id", "ws", F.explode(F.expr("sequence(1, length - 1)")).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "first_doc_id", "k", joined(F.lit(1), F.col("k")).alias("left"), joined(F.col("k") + 1, F.col("length") - F.col("k")).alias("right"))
    part = found.select("lang", "phrase", "f")
    cuts = cuts.join(part.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    cuts = cuts.join(part.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    cuts = cuts.withColumn("score", F.expr("cast(a AS decimal(20, 0)) * cast(2000000 AS decimal(7, 0)) div (cast(l AS decimal(20, 0)) + r)"))
    scored = cuts.groupBy("lang", "phrase").agg(F.min("a").alias("a"), F.min("first_doc_id").alias("first_doc_id"), F.min(F.struct("score", "k", "l", "r")).alias("s"))
    inner = big.select("lang", F.col("a").alias("longer"), F.explode(F.expr("flatten(transform(sequence(2, greatest(length - 1, 2)), m -> transform(sequence(1, length - m + 1), i -> array_join(slice(ws, i, m), ' '))))")).alias("phrase"), "length")
    inner = inner.where("length > 2").groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    scored = scored.join(inner, ["lang", "phrase"], "left")
    scored = scored.where(F.expr(f"longer IS NULL OR 100 * cast(longer AS decimal(20, 0)) < {HELD} * cast(a AS decimal(20, 0))"))
    scored = scored.select("lang", "phrase", "a", "s.l", "s.r", "s.score", "first_doc_id")
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    if most is not None:  # the best of each part of a language first, so that no task gets a whole one
        salt = free_name(scored, "part")
        scored = scored.withColumn(salt, F.pmod(F.xxhash64("phrase"), F.lit(64)))
        scored = scored.withColumn("rank", F.row_number().over(W.partitionBy("lang", salt).orderBy(*best))).where(F.col("rank") <= most).drop("rank", salt)
        scored = scored.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*best)).cast("long")).where(F.col("rank") <= most)
    else:
        scored = scored.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*best)).cast("long"))
    return scored.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score", "first_doc_id")
