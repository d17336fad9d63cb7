"""Alignment of two tokenizers' tokens (operator 12), as Arrow tables.

A text is cut before each space that follows a visible character: no token of either tokenizer spans such
a place (checked when the tokenizers are loaded), so both end there, and a slice's distinct segments are
tokenised and aligned once. Token lists are flattened with parent indices; cumulative sums of token bytes
give where tokens end; an Acero join on these ends finds those that both have, which cut groups; a join on
the group gives the links. ``Table.group_by`` counts pairs of ids by document, then over a slice, and
Spark adds the slices' counts. Each slice asks for the counts of its own pairs and is met by them again on
its number, so neither the pairs nor the documents are held anywhere as a whole. Texts are tokenised once.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .common import in_slices, staged

#: Characters of a slice.
SLICE = 5_000_000
#: Uses of segments by documents that are joined with their links at a time, or those of one document.
_BLOCK = 300_000

#: How the byte-level tokenizer splits texts (fixed by its vocabulary's makers).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters whose class has been the same in all editions of Unicode that the libraries may follow.
_SETTLED = re.compile("[\0-ɏ‐-‧]*")


def _byte_of_letter() -> dict[str, int]:
    """The letter that byte-level vocabularies write for a byte -> the byte: printable ones stand for themselves."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Tokens:
    """The tokens of one tokenizer: ``ids`` of segments, and each id's bytes, decimal and length."""

    def __init__(self, table: dict[int, bytes]):
        size = max(table) + 1
        self.raw = pa.array([table.get(i, b"") for i in range(size)], pa.large_binary())
        self.size = size
        self.bytes = pc.binary_length(self.raw).to_numpy().astype(np.int64)
        self.decimal = [str(i) for i in range(size)]

    def followed(self, marks: str) -> pa.Array:
        """The decimal of id i followed by marks[k] at i * len(marks) + k; "." stands for nothing."""
        return pa.array([f"{d}{'' if m == '.' else m}" for d in self.decimal for m in marks], pa.large_string())


class ByteTokens(Tokens):
    """A byte-level vocabulary (tokenizers' JSON). Its merges are those of its ranks (checked), so texts of
    settled characters are encoded by ranks, which is three times faster; others by the file itself."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        special = {t["content"] for t in model.get("added_tokens", [])}
        vocabulary, merges = model["model"]["vocab"], model["model"]["merges"]
        of = _byte_of_letter()
        super().__init__({i: t.encode() if t in special else bytes(of[c] for c in t) for t, i in vocabulary.items()})
        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        ranked = [vocabulary[a + b] for a, b in pairs] == list(range(256, 256 + len(pairs)))
        if any(re.search(rb"[^\s\x80-\xff] ", bytes(of[c] for c in t)) for t in vocabulary if t not in special):
            raise ValueError("tokens of this vocabulary reach over spaces")
        self.fast = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks={bytes(of[c] for c in t): i for t, i in vocabulary.items() if t not in special}, special_tokens={}) if ranked else None

    def ids(self, segments: list[str]) -> list[list[int]]:
        if not self.fast:
            return [e.ids for e in self.whole.encode_batch_fast(segments, add_special_tokens=False)]
        settled, fast = _SETTLED.fullmatch, self.fast.encode_ordinary
        out = [fast(s) if settled(s) else None for s in segments]
        rest = [k for k, x in enumerate(out) if x is None]
        for k, e in zip(rest, self.whole.encode_batch_fast([segments[k] for k in rest], add_special_tokens=False)):
            out[k] = e.ids
        return out


class PieceTokens(Tokens):
    """A sentencepiece model that writes U+2581 for a space and puts one in front of a text."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError("pieces of this model reach over spaces")
        byte = re.compile(r"<0x([0-9A-F]{2})>")
        super().__init__({i: bytes([int(m[1], 16)]) if (m := byte.fullmatch(p)) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)})
        self.space = self.model.piece_to_id("▁")

    def ids(self, segments: list[str]) -> list[list[int]]:
        got = self.model.encode([s[1:] for s in segments], num_threads=1)
        return [x if len(s) > 1 else [self.space] for s, x in zip(segments, got)]


@functools.cache
def tokenizers(a_path: str, b_path: str) -> tuple[ByteTokens, PieceTokens, pa.Array, pa.Array]:
    a, b = ByteTokens(a_path), PieceTokens(b_path)
    return a, b, a.followed(",|"), b.followed(",;")


def segments(texts: list[str]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct segments of the texts, a space put in front of each, which of them follow each other, and
    from where on in those each text's are (one more than texts)."""
    flat = pc.binary_join_element_wise(pa.scalar("", pa.large_string()), pa.array(texts, pa.large_string()), pa.scalar(" ", pa.large_string()))
    starts = np.frombuffer(flat.buffers()[1], np.int64, len(flat) + 1)
    raw = np.frombuffer(flat.buffers()[2] or b"", np.uint8)
    visible = (raw > 0x20) & (raw != 0x7F)
    # The last byte of white space beyond ASCII (and, harmlessly, of a few other characters).
    before = lambda k: np.concatenate([np.zeros(k, np.uint8), raw[: len(raw) - k]])
    lead, one = before(2), before(1)
    visible &= ~((one == 0xC2) & np.isin(raw, (0x85, 0xA0))) & ~(((lead == 0xE1) & (one == 0x9A)) | ((lead == 0xE2) & ((one == 0x80) | (one == 0x81))) | ((lead == 0xE3) & (one == 0x80)))
    cut = raw == 0x20
    cut[1:] &= visible[:-1]
    cut[starts[:-1]] = True
    at = np.flatnonzero(cut)
    own = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(np.append(at, len(raw)).astype(np.int64)), pa.py_buffer(raw))
    coded = own.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(), np.searchsorted(at, starts)


def _flat(lists: list[list[int]], tokens: Tokens) -> tuple[pa.Array, np.ndarray]:
    """All ids, and the list (parent) of each."""
    nested = pa.array(lists, pa.large_list(pa.int32()))
    return pc.list_flatten(nested), pc.list_parent_indices(nested).to_numpy()


def _faulty(ids: np.ndarray, parent: np.ndarray, tokens: Tokens, own: pa.Array, lengths: np.ndarray) -> np.ndarray:
    """Which segments differ from their tokens' joined bytes."""
    got = np.bincount(parent, tokens.bytes[ids], len(own)).astype(np.int64)
    bad = got != lengths
    keep = ~bad[parent]
    joined = np.frombuffer(tokens.raw.take(pa.array(ids[keep])).buffers()[2] or b"", np.uint8)
    rest = own.filter(pa.array(~bad))
    whole = np.frombuffer(rest.buffers()[2] or b"", np.uint8)
    total = int(lengths[~bad].sum())
    other = np.flatnonzero(joined[:total] != whole[:total])
    ends = np.cumsum(lengths[~bad])
    bad[np.flatnonzero(~bad)[np.unique(np.searchsorted(ends, other, "right"))]] = True
    return bad


def aligned(own: pa.Array, a_path: str, b_path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, pa.Array, pa.Table]:
    """Distinct segments' faults, token numbers of both sides, group numbers, groups as texts (each with a
    final semicolon), and links as a table (segment, a, b, n)."""
    a, b, a_marks, b_marks = tokenizers(a_path, b_path)
    texts = own.to_pylist()
    lengths = pc.binary_length(own).to_numpy().astype(np.int64)
    ids_a, parent_a = _flat(a.ids(texts), a)
    ids_b, parent_b = _flat(b.ids(texts), b)
    ids_a, ids_b = ids_a.to_numpy(), ids_b.to_numpy()
    bad = _faulty(ids_a, parent_a, a, own, lengths) | _faulty(ids_b, parent_b, b, own, lengths)
    sides = []
    starts = np.cumsum(lengths) - lengths
    for ids, parent, tokens in ((ids_a, parent_a, a), (ids_b, parent_b, b)):
        keep = ~bad[parent]
        ids, parent = ids[keep], parent[keep]
        run = pc.cumulative_sum(pa.array(tokens.bytes[ids])).to_numpy()
        # Segmented: every good segment's tokens have its bytes, so its own sums begin where the good ones before it end.
        good = np.cumsum(np.where(bad, 0, lengths)) - np.where(bad, 0, lengths)
        sides.append((ids, parent, starts[parent] + run - good[parent]))
    (ids_a, parent_a, end_a), (ids_b, parent_b, end_b) = sides
    both = pa.table({"end": end_a}).join(pa.table({"end": end_b}), "end", join_type="inner", use_threads=False)
    cuts = np.sort(both.column("end").to_numpy())
    group_a, group_b = np.searchsorted(cuts, end_a), np.searchsorted(cuts, end_b)
    owner = np.searchsorted(starts, cuts, "left") - 1  # a cut ends inside or at the end of its segment
    size = len(own)
    counts = [np.bincount(x, minlength=size) for x in (parent_a, parent_b, owner)]
    # Every token's decimal with the mark behind it, in the order of groups, first A's then B's, is one buffer of text.
    n_a, n_b = np.bincount(group_a, minlength=len(cuts)), np.bincount(group_b, minlength=len(cuts))
    place_a = np.arange(len(ids_a)) + (np.cumsum(n_b) - n_b)[group_a]
    place_b = np.arange(len(ids_b)) + np.cumsum(n_a)[group_b]
    last_a, last_b = np.append(group_a[1:] != group_a[:-1], True)[: len(ids_a)], np.append(group_b[1:] != group_b[:-1], True)[: len(ids_b)]
    pick = np.zeros(len(ids_a) + len(ids_b), np.int64)
    pick[place_a] = ids_a.astype(np.int64) * 2 + last_a
    pick[place_b] = 2 * a.size + ids_b.astype(np.int64) * 2 + last_b
    marks = pa.concat_arrays([a_marks, b_marks])
    spelt = marks.take(pa.array(pick))
    edges = np.frombuffer(spelt.buffers()[1], np.int64, len(pick) + 1)
    tokens_until = np.concatenate([[0], np.cumsum(counts[0] + counts[1])])
    groups = pa.LargeStringArray.from_buffers(size, pa.py_buffer(edges[tokens_until]), spelt.buffers()[2] or pa.py_buffer(b""))
    links = pa.table({"group": group_a, "a": ids_a}).join(pa.table({"group": group_b, "b": ids_b}), "group", join_type="inner", use_threads=False)
    pair = links.column("a").to_numpy().astype(np.int64) * b.size + links.column("b").to_numpy()
    links = pa.table({"segment": owner[links.column("group").to_numpy()] if len(cuts) else np.zeros(0, np.int64), "pair": pair})
    links = links.group_by(["segment", "pair"], use_threads=False).aggregate([([], "count_all")]).sort_by([("segment", "ascending"), ("pair", "ascending")])
    return bad, *counts, groups, links


def _packed(x: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(x, np.int32).tobytes(), "zstd", asbytes=True) if len(x) else b""


def _unpacked(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(raw, 4 * n, "zstd", asbytes=True), np.int32) if n else np.zeros(0, np.int32)


_DOC = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
#: Kinds of a slice's staged rows: its pairs of ids, its segments' pairs, its documents' segments.
_PAIRS, _SEGMENTS, _DOCUMENT = 0, 1, 2


def _slice(texts: list[str | None], ids: list, number: int, a_path: str, b_path: str) -> Iterator[dict]:
    full = [k for k, t in enumerate(texts) if t]
    own, codes, starts = segments([texts[k] for k in full]) if full else (pa.array([], pa.large_string()), np.zeros(0, np.int64), np.zeros(1, np.int64))
    bad, n_a, n_b, n_groups, groups, links = aligned(own, a_path, b_path)
    n_links = np.bincount(links.column("segment").to_numpy(), links.column("count_all").to_numpy(), len(own)).astype(np.int64)
    sums = [np.concatenate([[0], np.cumsum(x[codes])]) for x in (n_a, n_b, n_groups, n_links)]
    wrong = np.concatenate([[0], np.cumsum(bad[codes])])
    doc = pc.list_parent_indices(pa.LargeListArray.from_arrays(pa.array(starts), pa.array(codes))).to_numpy()
    use = ~((wrong[starts[1:]] > wrong[starts[:-1]])[doc])
    uses = pa.table({"doc": doc[use], "segment": codes[use].astype(np.int64)}).group_by(["doc", "segment"], use_threads=False).aggregate([([], "count_all")])
    uses = uses.sort_by([("doc", "ascending"), ("segment", "ascending")])
    pair = pc.unique(links.column("pair")).sort() if len(links) else pa.array([], pa.int64())
    pair = pair.to_numpy()
    of_link = np.searchsorted(pair, links.column("pair").to_numpy())
    held = np.zeros(len(pair), np.int64)
    link_doc = pa.table({"segment": links.column("segment"), "code": of_link})
    used = uses.select(["doc", "segment"])
    first = np.searchsorted(uses.column("doc").to_numpy(), np.arange(len(full) + 1))
    ends = np.unique(first[np.searchsorted(first, np.arange(_BLOCK, first[-1] + _BLOCK, _BLOCK)).clip(max=len(full))]).tolist()
    for at, end in zip([0, *ends[:-1]], ends):  # whole documents at a time
        block = used.slice(at, end - at).join(link_doc, "segment", join_type="inner", use_threads=False)
        seen = block.group_by(["doc", "code"], use_threads=False).aggregate([])
        held += np.bincount(seen.column("code").to_numpy(), minlength=len(pair))
    base = {"slice": number}
    yield base | {"kind": _PAIRS, "pairs": pair, "docs": held}
    segment = links.column("segment").to_numpy()
    yield base | {"kind": _SEGMENTS, "size": len(links), "codes": [_packed(x) for x in (np.diff(segment, prepend=0), of_link, links.column("count_all").to_numpy())]}
    edges = np.frombuffer(groups.buffers()[1], np.int64, len(groups) + 1) if len(groups) else np.zeros(1, np.int64)
    segment, times = uses.column("segment").to_numpy(), uses.column("count_all").to_numpy()
    place = dict(zip(full, range(len(full))))
    for k, i in enumerate(ids):
        row = base | {"kind": _DOCUMENT, "id": i, "n_a": 0, "n_b": 0, "n_groups": 0, "n_links": 0, "groups_sha256": "", "size": 0, "codes": []}
        j = place.get(k)
        if j is not None and wrong[starts[j + 1]] == wrong[starts[j]]:
            lo, hi = starts[j], starts[j + 1]
            row |= {x: int(s[hi] - s[lo]) for x, s in zip(("n_a", "n_b", "n_groups", "n_links"), sums)}
            text = groups.take(pa.array(codes[lo:hi]))
            digest = hashlib.sha256(memoryview(text.buffers()[2])[: int(edges[codes[lo:hi] + 1].sum() - edges[codes[lo:hi]].sum()) - 1])
            own_use = slice(first[j], first[j + 1])
            row |= {"groups_sha256": digest.hexdigest(), "size": int(first[j + 1] - first[j]), "codes": [_packed(np.diff(segment[own_use], prepend=0)), _packed(times[own_use])]}
        yield row


def _staged_slices(docs: DataFrame, a_path: str, b_path: str, text: str, doc_id: str) -> DataFrame:
    id_type = docs.schema[doc_id].dataType.simpleString()
    schema = f"slice long, kind int, id {id_type}, {_DOC}, size int, codes array<binary>, pairs array<long>, docs array<long>"
    kind = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pa.set_cpu_count(1)
        pa.set_io_thread_count(1)
        number = TaskContext.get().partitionId() << 32
        held: tuple[list, list] = ([], [])
        n = 0

        def out() -> Iterator[pa.RecordBatch]:
            rows: list[dict] = []
            for r in _slice(*held, number, a_path, b_path):
                rows.append(r)
                if len(rows) == 500:
                    yield pa.RecordBatch.from_pylist(rows, schema=kind)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=kind)

        for batch in batches:
            texts, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in in_slices(texts, SLICE // 4):
                held[0].extend(texts[a:b])
                held[1].extend(ids[a:b])
                n += sum(len(t or "") for t in texts[a:b])
                if n >= SLICE:
                    yield from out()
                    held, n, number = ([], []), 0, number + 1
        if held[0]:
            yield from out()

    return staged(docs.select(text, doc_id).mapInArrow(run, schema))


def pair_counts(slices: DataFrame, b_size: int) -> DataFrame:
    """(a, b, count): the number of documents that link two ids."""
    pair = slices.where(F.col("kind") == _PAIRS).select(F.explode(F.arrays_zip("pairs", "docs")).alias("x"))
    counts = pair.groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.docs").alias("count"))
    return counts.select(F.expr(f"pair div {b_size}").alias("a"), F.expr(f"pair % {b_size}").alias("b"), "pair", "count")


def align(docs: DataFrame, a_path: str, b_path: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Per row: ``doc_id``, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Texts that are null, empty or not what their tokens' bytes join to have zeros and ''. Every row is a
    document of its own, repeated ids and null ids too. Equal counts of an id are all best. Other columns are
    ignored, texts of any length are whole. An empty table gives no rows.
    """
    slices = _staged_slices(docs, a_path, b_path, text, doc_id)
    counts = pair_counts(slices, tokenizers(a_path, b_path)[1].size)
    counts = counts.withColumn("best", F.col("count") == F.max("count").over(W.partitionBy("a"))).select("pair", "count", "best")
    pairs = slices.where(F.col("kind") == _PAIRS).select("slice", F.posexplode("pairs").alias("place", "pair"))
    known = pairs.join(counts, "pair").select("slice", F.lit(_PAIRS).alias("kind"), "place", "count", "best")
    rows = slices.where(F.col("kind") != _PAIRS).drop("pairs", "docs")
    both = known.unionByName(rows, allowMissingColumns=True).repartition("slice").sortWithinPartitions("slice", "kind", "place")
    id_type = docs.schema[doc_id].dataType.simpleString()
    schema = f"id {id_type}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    kind = to_arrow_schema(StructType.fromDDL(schema))
    plain = [x.name for x in kind if x.name not in ("n_best", "count_sum")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, count, best, of_segment = None, [], [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            number, which = batch.column("slice").to_numpy(), batch.column("kind").to_numpy()
            cuts = np.flatnonzero((np.diff(number) != 0) | (np.diff(which) != 0)) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                part = batch.slice(lo, hi - lo)
                if number[lo] != now:
                    now, count, best = number[lo], [], []
                if which[lo] == _PAIRS:
                    count.append(part.column("count").to_numpy())
                    best.append(part.column("best").to_numpy(zero_copy_only=False))
                elif which[lo] == _SEGMENTS:
                    of_segment = _sums(part, count, best)
                else:
                    yield from _scored(part, of_segment, plain, kind)

    out = both.mapInArrow(run, schema)
    return out.withColumnRenamed("id", doc_id) if doc_id != "id" else out


def _sums(part: pa.RecordBatch, count: list, best: list) -> tuple[np.ndarray, np.ndarray]:
    """By segment, the sums over its links of the counts and of the best ones."""
    size, (step, code, times) = part.column("size")[0].as_py(), part.column("codes")[0].as_py()
    segment, code, times = np.cumsum(_unpacked(step, size), dtype=np.int64), _unpacked(code, size), _unpacked(times, size)
    n = int(segment[-1]) + 1 if size else 0
    count = np.concatenate(count) if count else np.zeros(0, np.int64)
    best = np.concatenate(best) if best else np.zeros(0, bool)
    total, top = np.zeros(n, np.int64), np.zeros(n, np.int64)
    np.add.at(total, segment, count[code] * times)
    np.add.at(top, segment, best[code] * times.astype(np.int64))
    return total, top


def _scored(part: pa.RecordBatch, of_segment: tuple[np.ndarray, np.ndarray], plain: list[str], kind: pa.Schema) -> Iterator[pa.RecordBatch]:
    total, top = of_segment
    sums, tops = [], []
    for size, codes in zip(part.column("size").to_pylist(), part.column("codes").to_pylist()):
        if not size:
            sums.append(0)
            tops.append(0)
            continue
        segment, times = np.cumsum(_unpacked(codes[0], size), dtype=np.int64), _unpacked(codes[1], size).astype(np.int64)
        sums.append(int(total[segment] @ times))
        tops.append(int(top[segment] @ times))
    own = {x: part.column(x) for x in plain} | {"n_best": pa.array(tops, pa.int64()), "count_sum": pa.array(sums, pa.int64())}
    yield pa.RecordBatch.from_arrays([own[x.name].cast(x.type) for x in kind], schema=kind)
