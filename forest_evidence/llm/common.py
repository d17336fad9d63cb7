"""Helpers shared by the training-data operators: staged tables, size-checked joins, components."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: A side of at most this many bytes is broadcast; beyond it the join shuffles.
BROADCAST_BYTES = 24 << 20
#: Bytes of rows, about, that go to a Python worker at a time and that it takes up at a time.
BATCH_BYTES = 4 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share. Only a local session, which has one machine, gets a temporary one."""
    path = spark.conf.get("spark.checkpoint.dir", None) or getattr(spark, "_forest_evidence_shared", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        # the setting itself can't be changed in a running session
        path = spark._forest_evidence_shared = tempfile.mkdtemp(prefix="spark-")
    return path


@contextlib.contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """What is planned inside hands Python workers batches of BATCH_BYTES, unless the session has less: executors
    and workers hold several copies of a batch."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    own = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(before)
    spark.conf.set(name, str(min(own, BATCH_BYTES) if own > 0 else BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def written(df: DataFrame) -> tuple[DataFrame, str]:
    """``df`` written once to the shared folder and read back, and where it is."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    with small_batches(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def staged(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts lineage, survives lost executors."""
    return written(df)[0]


def remove(spark: SparkSession, path: str) -> None:
    """Delete a staged table that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def halved(batch: pa.RecordBatch, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """A batch's rows in order, in parts of at most ``limit`` bytes or one row."""
    if batch.nbytes <= limit or batch.num_rows < 2:
        yield batch
    else:
        half = batch.num_rows // 2
        yield from halved(batch.slice(0, half), limit)
        yield from halved(batch.slice(half), limit)


def in_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All rows of a partition's batches, in parts of about BATCH_BYTES. A Python worker outlives its task, so at the
    end it gives back what Arrow holds for later batches."""
    for batch in batches:
        yield from halved(batch)
    pa.default_memory_pool().release_unused()


def in_frames(df: DataFrame, f: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str) -> DataFrame:
    """``f`` over a partition's rows as pandas frames, in which integers stay whole beside nulls (such a
    column holds Python integers and None), with rows of ``schema`` out."""
    kind = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in f(b.to_pandas(integer_object_nulls=True) for b in in_parts(batches)):
            if not len(out):
                continue
            arrays = [pa.array(out[x.name], x.type, from_pandas=True) for x in kind]
            yield from pa.Table.from_arrays(arrays, schema=kind).to_batches()

    return df.mapInArrow(run, schema)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or the first of its continuations that is no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def size_checked(df: DataFrame, row_bytes: int) -> DataFrame:
    """``df`` (staged) marked for broadcast if its rows fit BROADCAST_BYTES, else left to a shuffle join."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


class Words:
    """Words of some texts, split at ASCII white space: ``distinct`` ones, a code for each word in
    order, and ``starts`` of each text in the codes (one more than texts)."""

    def __init__(self, texts: list[str | None], lower: bool = False):
        flat = pa.array([t or "" for t in texts], pa.large_string())
        split = pc.ascii_split_whitespace(pc.ascii_lower(flat) if lower else flat)
        words, starts = split.values, split.offsets.to_numpy()
        full = pc.greater(pc.binary_length(words), 0)
        if not pc.all(full).as_py():
            ahead = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])
            words, starts = words.filter(full), ahead[starts]
        coded = words.dictionary_encode()
        self.distinct, self.codes, self.starts = coded.dictionary, coded.indices.to_numpy(), starts.astype(np.int64)

    def spelled(self) -> list[str]:
        """The distinct words; by way of numpy, which makes no Arrow scalar of each."""
        return self.distinct.to_numpy(zero_copy_only=False).tolist()

    def hashes(self) -> np.ndarray:
        """A 64-bit hash for each word."""
        own = np.fromiter(map(xxhash.xxh64_intdigest, self.spelled()), np.uint64, len(self.distinct))
        return own[self.codes] if len(own) else np.zeros(0, np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes (multiply-xorshift)."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return (h ^ (h >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)


def by_group(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Frames of one key each from batches sorted by ``keys``; holds one group at a time."""
    rest: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        new = np.zeros(len(batch), bool)
        for k in keys:
            v = batch[k].to_numpy()
            new[1:] |= v[1:] != v[:-1]
        cuts = np.flatnonzero(new).tolist()
        first = batch.iloc[: cuts[0]] if cuts else batch
        if rest and any(rest[-1][k].iat[-1] != batch[k].iat[0] for k in keys):
            yield pd.concat(rest, ignore_index=True)
            rest = []
        rest.append(first)
        if cuts:
            yield pd.concat(rest, ignore_index=True) if len(rest) > 1 else rest[0]
            for a, b in zip(cuts[:-1], cuts[1:]):
                yield batch.iloc[a:b]
            rest = [batch.iloc[cuts[-1] :]]
    if rest:
        yield pd.concat(rest, ignore_index=True)


def hub_join(rows: DataFrame, counted: DataFrame, on: list[str], total: int) -> DataFrame:
    """``rows`` joined with ``counted``, a staged table with one row for each key and the number ``n`` of its
    rows, of which there are ``total``. Keys with more than a thousandth of them, which can't be more than a
    thousand, are broadcast, so that no task gets a hub's rows; the others are dealt by key."""
    most = total // 1000 + 1
    hubs = counted.where(F.col("n") > most)
    if hubs.isEmpty():
        return rows.join(counted, on)
    few = rows.join(F.broadcast(hubs.select(*on)), on, "left_anti").join(counted.where(F.col("n") <= most), on)
    return few.unionByName(rows.join(F.broadcast(hubs), on))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(id, component) for every id in ``edges(a, b)``; component is the smallest id reachable.

    Alternating large-star and small-star rounds; each is a few shuffles on the edges and is written to the
    shared folder in place of the one before. Hubs are joined by broadcast. Ends when a round changes nothing.
    """
    spark = edges.sparkSession
    now, path = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())

    def mark(df: DataFrame):
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    def with_least(rows: DataFrame, total: int) -> tuple[DataFrame, str]:
        """Rows with the least neighbour of their ``a``."""
        least, where = written(rows.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")))
        return hub_join(rows, least, ["a"], total).drop("n"), where

    before = mark(now)
    if not before[0]:
        return now.select(F.col("a").alias("id"), F.col("b").alias("component"))
    for _ in range(max_rounds):
        both = now.select("a", "b").union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        met, old = with_least(both, 2 * before[0])
        large, own = written(met.where("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct())
        met, more = with_least(large, 2 * before[0])
        small = met.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.union(met.where("b = m").select("a", "b"))
        later, place = written(small.where("a <> b").distinct())
        for gone in (path, own, old, more):
            remove(spark, gone)
        now, path, after = later, place, mark(later)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    ids = now.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return ids.union(now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())


#: What tells how two of a group's rows compare: makes, from a group's frame, a function that takes index pairs and
#: gives those that are linked; if it may, only some that link the same rows.
Comparer = Callable[[pd.DataFrame], Callable[[np.ndarray, np.ndarray, bool], tuple[np.ndarray, np.ndarray]]]

#: Rows of a large group that all others are compared with first.
LEADS = 8
#: Rows of a small group, whose pairs are all compared at once.
PAIRED = 8


def group_links(members: DataFrame, key: str, block: int, comparer: Comparer, together: int = 1) -> DataFrame:
    """Links (a, b) between rows (``id``, ``n_key`` of them to a ``key``) of one key, so many that they reach what
    all links of the key reach.

    ``members`` is written once, as it is read again for the large keys. A key of up to ``block`` rows is one group,
    in which rows meet all that they aren't reached from yet, so that a key of near copies takes about as many
    comparisons as it has rows; small groups are handed to ``comparer`` together until they have ``together`` rows.
    In a larger one every row is compared with the same few leads,
    block by block. Leads that share a row are linked through it; of the clusters of leads, that around the lead
    with the most rows is taken. Its rows are linked already, so that comparisons are left only for the others,
    each with all rows of the key. These are done in pairs of blocks. No group holds more than two blocks; a row
    is copied once for each block of others.
    """
    kind = members.schema["id"].dataType.simpleString()
    links = f"a {kind}, b {kind}"

    members = staged(members)
    pairs_of = [np.triu_indices(n, 1) for n in range(PAIRED + 1)]

    def forest(group: pd.DataFrame, x: np.ndarray, y: np.ndarray) -> pd.DataFrame:
        ids, sets = group["id"].to_numpy(), DisjointSets(len(group))
        x, y = comparer(group)(x, y, True)
        keep = [(a, b) for a, b in zip(x.tolist(), y.tolist()) if sets.join(a, b)]
        return pd.DataFrame({"a": ids[[a for a, _ in keep]], "b": ids[[b for _, b in keep]]})

    def by_reach(group: pd.DataFrame) -> pd.DataFrame:
        """``forest`` of all pairs: 1, 2, 4, ... rows meet those behind them that aren't reached from them yet."""
        n, ids, linked = len(group), group["id"].to_numpy(), comparer(group)
        sets, root, keep, first, many = DisjointSets(n), np.arange(n), [], 0, 1
        while first < n - 1:
            x, y = np.divmod(np.arange(min(many, n - 1 - first) * n), n)
            x += first
            apart = (y > x) & (root[x] != root[y])
            first, many = first + many, 2 * many
            if apart.any():
                x, y = linked(x[apart], y[apart], True)
                keep += [(a, b) for a, b in zip(x.tolist(), y.tolist()) if sets.join(a, b)]
                root = np.array([sets.find(i) for i in range(n)])
                if not root.any():  # all are reached from the first
                    break
        return pd.DataFrame({"a": ids[[a for a, _ in keep]], "b": ids[[b for _, b in keep]]})

    def side_by_side(groups: list[pd.DataFrame]) -> pd.DataFrame:
        """``forest`` of all pairs inside each of some small groups, compared in one go."""
        ends = np.cumsum([len(g) for g in groups]).tolist()
        pairs = np.concatenate([np.array(pairs_of[len(g)]) + end - len(g) for g, end in zip(groups, ends)], 1)
        return forest(pd.concat(groups, ignore_index=True), *pairs)

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        few, rows = [], 0
        for group in by_group(batches, [key]):
            if len(group) > PAIRED:
                yield by_reach(group)
            elif len(group) > 1:
                few.append(group)
                rows += len(group)
                if rows >= together:
                    yield side_by_side(few)
                    few, rows = [], 0
        if few:
            yield side_by_side(few)

    def with_leads(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in by_group(batches, [key, "q"]):
            lead = group["lead"].to_numpy()
            leads, rows = np.flatnonzero(lead >= 0), np.flatnonzero(lead < 0)
            x, y = comparer(group)(np.repeat(leads, len(rows)), np.tile(rows, len(leads)), False)
            met = np.zeros(len(group), np.int32)
            np.bitwise_or.at(met, y, 1 << lead[x])
            yield pd.DataFrame({key: group[key].to_numpy()[rows], "id": group["id"].to_numpy()[rows], "met": met[rows]})

    def others(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in by_group(batches, [key, "p", "q"]):
            lone = group["lone"].to_numpy()
            x, y = np.flatnonzero(lone), np.flatnonzero(~lone)
            yield forest(group, np.repeat(x, len(y)), np.tile(y, len(x)))

    def dealt(df: DataFrame, *by: str) -> DataFrame:
        return df.repartition(key, *by).sortWithinPartitions(key, *by)

    out = in_frames(dealt(members.where(F.col("n_key") <= block).drop("n_key")), whole, links)
    large = members.where(F.col("n_key") > block)
    if large.isEmpty():
        return out
    blocks = F.ceil(F.col("n_key") / block).cast("int")
    own_block = lambda n: F.pmod(F.xxhash64("id", F.lit(3)), n).cast("int")
    columns = [F.col(c) for c in large.columns]
    number = F.pmod(F.xxhash64("id", F.lit(5)), F.lit(LEADS)).cast("int").alias("lead")
    leads = staged(large.groupBy(key, number).agg(F.min(F.struct(*columns)).alias("s")).select("lead", "s.*"))
    first = large.withColumn("lead", F.lit(-1)).withColumn("q", own_block(blocks))
    first = first.unionByName(leads.withColumn("q", F.explode(F.sequence(F.lit(0), blocks - 1))))
    met = staged(in_frames(dealt(first.drop("n_key"), "q"), with_leads, f"{key} {large.schema[key].dataType.simpleString()}, id {kind}, met int"))
    has = lambda bits, k: F.shiftright(bits, k).bitwiseAND(1) == 1
    rows_of = F.array(*[F.count_if(has(F.col("met"), k)) for k in range(LEADS)])
    beside = F.array(*[F.coalesce(F.bit_or(F.when(has(F.col("met"), k), F.col("met"))), F.lit(0)) for k in range(LEADS)])
    best = met.groupBy(key).agg(F.count("*").alias("n"), rows_of.alias("c"), beside.alias("beside"))
    start = F.pow(F.lit(2), F.array_position("c", F.array_max("c")) - 1).cast("int")
    step = "aggregate(sequence(0, {n}), {m}, (a, i) -> a | IF((shiftright({m}, i) & 1) = 1, beside[i], 0))"
    best = best.withColumn("start", start)
    best = best.withColumn("mask", F.expr(f"aggregate(sequence(1, {LEADS}), start, (m, r) -> {step.format(n=LEADS - 1, m='m')})"))
    best = staged(best.select(key, "n", "mask"))
    known = hub_join(met, best, [key], met.count()).withColumn("own", F.col("met").bitwiseAND(F.col("mask")))
    lead_ids = leads.select(key, "lead", F.col("id").alias("b"))
    near = known.where("own <> 0").select(key, F.col("id").alias("a"), F.explode(F.expr(f"filter(sequence(0, {LEADS - 1}), k -> (shiftright(own, k) & 1) = 1)")).alias("lead"))
    near = near.join(size_checked(lead_ids, 64), [key, "lead"]).select("a", "b")
    lone = staged(known.where("own = 0").select(key, "id", F.col("n").alias("n_all")))
    sized = staged(lone.groupBy(key).agg(F.count("*").alias("n_lone"), F.max("n_all").alias("n")))
    lone = lone.join(sized.select(key, "n_lone"), key)
    sides = F.ceil(F.col("n_lone") / block).cast("int")
    ours = large.join(lone, [key, "id"]).withColumn("p", own_block(sides)).withColumn("q", F.explode(F.sequence(F.lit(0), blocks - 1))).withColumn("lone", F.lit(True))
    all_ = hub_join(large, sized, [key], met.count()).withColumn("q", own_block(blocks)).withColumn("p", F.explode(F.sequence(F.lit(0), sides - 1))).withColumn("lone", F.lit(False))
    picked = [*[c for c in large.columns if c != "n_key"], "p", "q", "lone"]
    rest = dealt(ours.select(*picked).unionByName(all_.select(*picked)), "p", "q")
    return out.union(near.where("a <> b")).union(in_frames(rest, others, links).where("a <> b"))


class DisjointSets:
    """Disjoint sets over 0..n-1."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)
        return a != b


def in_slices(texts: list, limit: int = 1_000_000) -> Iterator[tuple[int, int]]:
    """(from, to) of consecutive texts of about ``limit`` characters, to bound a task's arrays."""
    a, n = 0, 0
    for i, t in enumerate(texts):
        n += len(t or "")
        if n >= limit:
            yield a, i + 1
            a, n = i + 1, 0
    if a < len(texts):
        yield a, len(texts)


def in_batches(df: DataFrame, keep: Callable[[list[str | None]], np.ndarray], column: str) -> DataFrame:
    """The rows of ``df``, all columns as they are, for whose texts in ``column`` ``keep`` is true."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches):
            yield batch.filter(pa.array(keep(batch.column(batch.schema.get_field_index(column)).to_pylist()), pa.bool_()))

    return df.mapInArrow(run, df.schema)
