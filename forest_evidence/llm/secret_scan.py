"""Secret scans (operator 13): patterns, and a character convolutional network over every candidate.

The base kinds (an assignment to a word for a secret, access ids, hexadecimal runs) are found by patterns
and stay as they are. Besides, every run of 16 or more characters of keys with letters and digits in it is
a candidate. A small network in numpy reads its bytes and those around it: fixed descriptors of characters,
a convolution of five characters, largest and mean activations inside the candidate and largest outside, a
hidden layer. Candidates longer than a window are read in overlapping windows; the highest score counts.

It is trained on labelled findings: base findings of the corpus (secrets) and its other candidates (not),
from at most ``SAMPLE_DOCS`` documents and ``SAMPLE_ROWS`` rows, and, as real corpora hold few, findings made
by the forms that issuers publish and by those of harmless strings, set between words of the sample. A third
part calibrates scores (Platt) and sets the threshold: the highest one whose recall, by the lower Wilson
bound, is still RECALL.
"""

from __future__ import annotations

import hashlib
import random
import re
import string
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .common import in_slices

KINDS = ("assign", "access", "hex", "network")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
#: Runs are taken as long as they are, so that asking for the least length at once gives the same findings.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
#: Texts without this have no base finding.
_ANY = r"AKIA|[0-9a-f]{24}|(?i:password|passwd|secret|token|api_?key)"

SAMPLE_DOCS, SAMPLE_ROWS = 8000, 4000
MADE = 1500
RECALL = 0.95
SHORTEST = 16
#: Bytes of a window: before the candidate, of it, behind; and how far one window lies from the next.
BEFORE, INSIDE, BEHIND, STEP = 32, 64, 16, 48
SPAN = BEFORE + INSIDE + BEHIND
WIDTH, FILTERS, HIDDEN = 5, 24, 16

_RUN = np.zeros(256, bool)
_RUN[[*(string.ascii_letters + string.digits + "+/_=.~-").encode()]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[[*b"0123456789"]] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*string.ascii_letters.encode()]] = True


def _descriptors() -> np.ndarray:
    """What the network sees of a byte: seven classes and twelve fixed random numbers for the letter."""
    table = np.zeros((256, 20), np.float32)
    rng = np.random.default_rng(11)
    own = rng.normal(size=(256, 12)).astype(np.float32) / 3
    for b in range(256):
        c = chr(b)
        flags = (b == 0, c.islower(), c.isupper(), c.isdigit(), c in "abcdefABCDEF0123456789", c in " \t\n\r", b > 127, c in "\"'`=:(<{[")
        table[b] = [*flags, *own[ord(c.lower()) if b < 128 else 128]]
    return table


_SEEN = _descriptors()


def base_findings(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the base findings, code points, by start and then kind."""
    out = [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text)]
    out += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    return sorted(out, key=lambda x: (x[0], x[2]))


def with_base(flat: pa.Array) -> np.ndarray:
    """Which texts may have base findings."""
    return np.flatnonzero(pc.match_substring_regex(flat, _ANY).to_numpy(zero_copy_only=False))


class Candidates:
    """The candidates of some texts: document, byte places in their joined bytes, places in code points."""

    def __init__(self, flat: pa.Array):
        self.starts = np.frombuffer(flat.buffers()[1], np.int64, len(flat) + 1) if len(flat) else np.zeros(1, np.int64)
        self.raw = raw = np.frombuffer(flat.buffers()[2] or b"", np.uint8)[: self.starts[-1]]
        inside = np.zeros(len(raw) + 2, bool)
        inside[1:-1] = _RUN[raw]
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        begin, end = edge[::2], edge[1::2]
        # A run of one text may touch one of the next: cut it there.
        cuts = self.starts[1:-1]
        within = cuts[(np.searchsorted(begin, cuts, "left") > np.searchsorted(end, cuts, "right")) & (cuts < len(raw))]
        begin, end = np.sort(np.concatenate([begin, np.unique(within)])), np.sort(np.concatenate([end, np.unique(within)]))
        long = end - begin >= SHORTEST
        begin, end = begin[long], end[long]
        digits, letters = (np.concatenate([[0], np.cumsum(x[raw], dtype=np.int64)]) for x in (_DIGIT, _LETTER))
        keep = (digits[end] - digits[begin] >= 2) & (letters[end] - letters[begin] >= 2)
        self.begin, self.end = begin[keep], end[keep]
        self.doc = np.searchsorted(self.starts, self.begin, "right") - 1
        head = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80, dtype=np.int64)])
        self.point = lambda place, doc: head[place] - head[self.starts[doc]]

    def windows(self, begin: np.ndarray, end: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bytes of all windows, which of them are the candidate's, and the candidate of each window."""
        n = np.maximum(1, -(-(end - begin - INSIDE) // STEP) + 1)
        own = np.repeat(np.arange(len(begin)), n)
        at = begin[own] - BEFORE + STEP * (np.arange(len(own)) - (np.cumsum(n) - n)[own])
        place = at[:, None] + np.arange(SPAN)
        ok = (place >= self.starts[doc[own]][:, None]) & (place < self.starts[doc[own] + 1][:, None])
        seen = np.where(ok, self.raw[np.clip(place, 0, max(len(self.raw) - 1, 0))], 0) if len(own) else np.zeros((0, SPAN), np.uint8)
        return seen.astype(np.uint8), (place >= begin[own][:, None]) & (place < end[own][:, None]), own


@dataclass
class Network:
    """Weights, calibration and threshold."""

    weights: dict[str, np.ndarray]
    slope: float = 1.0
    shift: float = 0.0
    threshold: float = 0.5
    report: dict | None = None

    def _layers(self, seen: np.ndarray, mask: np.ndarray) -> tuple:
        w = self.weights
        x = np.concatenate([_SEEN[seen], mask[:, :, None].astype(np.float32)], 2)
        n, d = len(x), x.shape[2]
        rows = np.lib.stride_tricks.sliding_window_view(x, WIDTH, 1).transpose(0, 1, 3, 2).reshape(-1, WIDTH * d)
        h = np.maximum(rows @ w["conv"] + w["conv_b"], 0).reshape(n, SPAN - WIDTH + 1, FILTERS)
        m = mask[:, WIDTH // 2 : SPAN - WIDTH // 2]
        inner, outer = np.where(m[:, :, None], h, -1), np.where(m[:, :, None], -1, h)
        top_i, top_o = inner.argmax(1), outer.argmax(1)
        pick = lambda a, k: np.maximum(np.take_along_axis(a, k[:, None], 1)[:, 0], 0)
        size = np.maximum(m.sum(1, keepdims=True), 1)
        pooled = np.concatenate([pick(inner, top_i), pick(outer, top_o), (h * m[:, :, None]).sum(1) / size, np.log(size) / 4], 1).astype(np.float32)
        hidden = np.maximum(pooled @ w["hidden"] + w["hidden_b"], 0)
        return rows, h, m, top_i, top_o, size, pooled, hidden, hidden @ w["out"] + w["out_b"]

    def logits(self, seen: np.ndarray, mask: np.ndarray) -> np.ndarray:
        out = [self._layers(seen[a : a + 512], mask[a : a + 512])[-1][:, 0] for a in range(0, len(seen), 512)]
        return np.concatenate(out) if out else np.zeros(0, np.float32)

    def scores(self, seen: np.ndarray, mask: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * self.logits(seen, mask).astype(np.float64) + self.shift)))

    def gradients(self, seen: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        w = self.weights
        rows, h, m, top_i, top_o, size, pooled, hidden, out = self._layers(seen, mask)
        n = len(seen)
        d_out = ((1 / (1 + np.exp(-out[:, 0])) - y) / n)[:, None].astype(np.float32)
        d_hidden = d_out @ w["out"].T * (hidden > 0)
        d_pooled = d_hidden @ w["hidden"].T
        d_h = d_pooled[:, None, 2 * FILTERS : 3 * FILTERS] * m[:, :, None] / size[:, :, None]
        i, f = np.arange(n)[:, None], np.arange(FILTERS)[None]
        has_i, has_o = m.any(1)[:, None], ~m.all(1)[:, None]
        np.add.at(d_h, (i, top_i, f), d_pooled[:, :FILTERS] * has_i)
        np.add.at(d_h, (i, top_o, f), d_pooled[:, FILTERS : 2 * FILTERS] * has_o)
        d_h = (d_h * (h > 0)).reshape(-1, FILTERS).astype(np.float32)
        return {"conv": rows.T @ d_h, "conv_b": d_h.sum(0), "hidden": pooled.T @ d_hidden, "hidden_b": d_hidden.sum(0), "out": hidden.T @ d_out, "out_b": d_out.sum(0)}


def fit(seen: np.ndarray, mask: np.ndarray, y: np.ndarray, epochs: int = 8, seed: int = 1) -> Network:
    """The network by Adam on two thirds of the rows; the others calibrate it and set the threshold."""
    rng = np.random.default_rng(seed)
    shape = {"conv": (WIDTH * (_SEEN.shape[1] + 1), FILTERS), "hidden": (3 * FILTERS + 1, HIDDEN), "out": (HIDDEN, 1)}
    weights = {k: (rng.normal(size=s) * np.sqrt(2 / s[0])).astype(np.float32) for k, s in shape.items()}
    weights |= {f"{k}_b": np.zeros(s[1], np.float32) for k, s in shape.items()}
    net = Network(weights)
    order = rng.permutation(len(y))
    kept, rest = order[len(y) // 3 :], order[: len(y) // 3]
    first, second = {k: np.zeros_like(v) for k, v in weights.items()}, {k: np.zeros_like(v) for k, v in weights.items()}
    step = 0
    for epoch in range(epochs):
        rng.shuffle(kept)
        for a in range(0, len(kept), 128):
            part, step = kept[a : a + 128], step + 1
            rate = 0.004 * (1 - epoch / epochs)
            for k, g in net.gradients(seen[part], mask[part], y[part]).items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                weights[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-7)
    net.slope, net.shift = platt(net.logits(seen[rest], mask[rest]).astype(np.float64), y[rest])
    p = net.scores(seen[rest], mask[rest])
    net.threshold = threshold(p, y[rest])
    said = p >= net.threshold
    net.report = {"recall": float(said[y[rest] == 1].mean()), "precision": float(y[rest][said].mean()) if said.any() else 1.0, "rows": len(rest), "brier": float(((p - y[rest]) ** 2).mean())}
    return net


def platt(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve from logits to the share of secrets, by Newton steps."""
    n1 = y.sum()
    t = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (len(y) - n1 + 2))
    a, b = 1.0, 0.0
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
        g = np.array([((p - t) * z).sum() + 1e-3 * (a - 1), (p - t).sum()])
        v = p * (1 - p)
        hess = np.array([[(v * z * z).sum() + 1e-3, (v * z).sum()], [(v * z).sum(), v.sum() + 1e-6]])
        da, db = np.linalg.solve(hess, g)
        a, b = a - da, b - db
        if abs(da) + abs(db) < 1e-9:
            break
    return float(a), float(b)


def threshold(p: np.ndarray, y: np.ndarray, recall: float = RECALL) -> float:
    """The highest threshold whose recall has a lower Wilson bound (95 %) of ``recall``; 0 if none has."""
    hits = np.sort(p[y == 1])[::-1]
    n = len(hits)
    if not n:
        return 0.5
    share = np.arange(1, n + 1) / n
    z = 1.645
    low = (share + z * z / (2 * n) - z * np.sqrt(share * (1 - share) / n + z * z / (4 * n * n))) / (1 + z * z / n)
    ok = np.flatnonzero(low >= recall)
    return float(hits[ok[0]]) if len(ok) else 0.0


# Forms of published keys, stated as fixed values: what they begin with and the length of what follows.
_ISSUED = [("ghp_", 36), ("gho_", 36), ("glpat-", 20), ("sk_live_", 24), ("rk_live_", 24), ("AIza", 35), ("npm_", 36), ("dop_v1_", 64), ("SG.", 66), ("xoxb-", 50), ("hf_", 34), ("ya29.", 60)]
_NAMES = ["client_secret", "auth", "credential", "Authorization: Bearer", "private_key", "access_key", "signing_key", "pwd", "DB_PASS", "connection", "session", "webhook", "key"]


def made_findings(rng: random.Random, words: list[str], n: int) -> list[tuple[str, int, int, int]]:
    """(text, start, end, label) of ``n`` made secrets and ``n`` harmless strings between words of the corpus."""
    letters, digits = string.ascii_letters, string.digits
    draw = lambda alphabet, k: "".join(rng.choice(alphabet) for _ in range(k))
    some = lambda: rng.choice(words) if words else draw(string.ascii_lowercase, rng.randrange(2, 9))
    plain = lambda: re.sub("[^A-Za-z]", "", some()) or "item"

    def secret() -> str:
        kind = rng.randrange(6)
        if kind == 0:
            head, k = rng.choice(_ISSUED)
            return head + draw(letters + digits, k)
        if kind == 1:
            return ".".join(draw(letters + digits + "-_", k) for k in (rng.randrange(20, 40), rng.randrange(30, 90), 43))
        if kind == 2:
            return draw(letters + digits + "+/", rng.randrange(20, 60)) + "=" * rng.randrange(3)
        if kind == 3:
            return draw(letters + digits, rng.randrange(18, 64))
        if kind == 4:
            return draw("0123456789ABCDEF", rng.choice([32, 40, 64]))
        return draw(letters + digits + "-_.~", rng.randrange(18, 48))

    def harmless() -> str:
        kind = rng.randrange(9)
        number = str(rng.randrange(10, 10**6))
        if kind == 0:
            return f"{draw('0123456789abcdef', 8)}-{draw('0123456789abcdef', 4)}-4{draw('0123456789abcdef', 3)}-a{draw('0123456789abcdef', 3)}-{draw('0123456789abcdef', 12)}"
        if kind == 1:
            return f"www.{plain().lower()}{number}.example.com/{plain()}/{plain()}-{number}"
        if kind == 2:
            return f"{rng.randrange(1990, 2030)}-0{rng.randrange(1, 9)}-1{rng.randrange(9)}T0{rng.randrange(9)}-{draw(digits, 2)}-{draw(digits, 2)}Z"
        if kind == 3:
            return rng.choice("_-.").join([plain().lower(), plain().lower(), plain().lower(), number])
        if kind == 4:
            return "".join(plain().capitalize() for _ in range(3)) + number + plain().capitalize()
        if kind == 5:
            return f"/{plain().lower()}/{plain().lower()}/{plain().lower()}_{number}.{rng.choice(['txt', 'html', 'py', 'tar.gz', 'png'])}"
        if kind == 6:
            return f"{plain().lower()}.{plain().lower()}-{number}.{rng.randrange(20)}.{rng.randrange(20)}-beta{rng.randrange(1, 9)}"
        if kind == 7:
            return f"{plain()}={number}.{rng.randrange(100)}+{plain()}={rng.randrange(1000)}"
        return rng.choice(["-", "=", "_", "."]) * rng.randrange(8, 30) + plain() + number

    out = []
    for label in (1, 0):
        for _ in range(n):
            value = secret() if label else harmless()
            while len(value) < SHORTEST or sum(c.isdigit() for c in value) < 2:
                value += rng.choice(digits)
            quote = rng.choice(["", "", '"', "'"])
            name = f"{rng.choice(_NAMES)}{rng.choice([' = ', ': ', '=', ' '])}" if rng.random() < (0.6 if label else 0.1) else ""
            head = " ".join(some() for _ in range(8)) + " " + name.replace("=", ": ") + quote
            out.append((f"{head}{value}{quote} {some()} {some()} {some()}", len(head.encode()), len(head.encode()) + len(value), label))
    return out


def labelled(docs: DataFrame, text: str = "text") -> DataFrame:
    """(seen, inside, label): windows of base findings (1) and of other candidates (0), one for each."""
    schema = "seen binary, begin int, end int, label int"
    kind = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for a, b in in_slices(texts):
                flat = _flat(texts[a:b])
                own = Candidates(flat)
                spans = []
                for d in with_base(flat).tolist():
                    t = texts[a + d]
                    spans += [(d, len(t[:s].encode()) + own.starts[d], len(t[:e].encode()) + own.starts[d]) for s, e, _ in base_findings(t)]
                hit = _overlapping(own, [(d, x, y) for d, x, y in spans])
                d, x, y = (np.array([*old[~hit].tolist(), *[s[k] for s in spans]], np.int64) for k, old in enumerate((own.doc, own.begin, own.end)))
                seen, mask, of = own.windows(x, y, d)
                once = np.flatnonzero(np.diff(of, prepend=-1))
                ends = BEFORE + np.minimum(y - x, INSIDE + BEHIND)
                yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in seen[once]], pa.binary()), pa.array(np.full(len(x), BEFORE, np.int32)), pa.array(ends.astype(np.int32)), pa.array((np.arange(len(x)) >= (~hit).sum()).astype(np.int32))], schema=kind)

    return docs.select(text).mapInArrow(run, schema)


def _flat(texts: list[str | None]) -> pa.Array:
    return pa.array([t or "" for t in texts], pa.large_string())


def _overlapping(own: Candidates, spans: list[tuple[int, int, int]]) -> np.ndarray:
    """Which candidates share a byte with one of the spans."""
    hit = np.zeros(len(own.begin), bool)
    for _, begin, end in spans:
        hit[np.searchsorted(own.end, begin, "right") : np.searchsorted(own.begin, end, "left")] = True
    return hit


def train(docs: DataFrame, text: str = "text", seed: int = 1) -> Network:
    """The network from at most SAMPLE_DOCS documents (chosen by a hash of the text) and made findings."""
    n = docs.count()
    share = min(1.0, SAMPLE_DOCS / max(n, 1))
    sample = docs.where(F.col(text).isNotNull()).where(F.pmod(F.xxhash64(text), F.lit(1 << 20)) < share * (1 << 20))
    rows = []
    for label in (0, 1):
        found = labelled(sample, text).where(F.col("label") == label)
        rows += found.orderBy(F.xxhash64("seen"), "seen", "begin", "end").limit(SAMPLE_ROWS // 2).collect()
    seen = np.array([np.frombuffer(r.seen, np.uint8) for r in rows], np.uint8).reshape(-1, SPAN)
    spans = [(r.begin, r.end) for r in rows]
    around = sorted({w for r in rows for w in bytes(r.seen).replace(b"\0", b"").decode("utf-8", "ignore").split()[1:-1] if w.isalpha()})
    made = made_findings(random.Random(seed), around, MADE)
    own = Candidates(_flat([m[0] for m in made]))
    at = own.starts[:-1]
    begin, end = at + [m[1] for m in made], at + [m[2] for m in made]
    extra, _, of = own.windows(begin, end, np.arange(len(made)))
    once = np.flatnonzero(np.diff(of, prepend=-1))
    seen = np.concatenate([seen, extra[once]])
    spans += [(BEFORE, BEFORE + min(m[2] - m[1], INSIDE + BEHIND)) for m in made]
    y = np.array([r.label for r in rows] + [m[3] for m in made], np.float32)
    places = np.arange(SPAN)
    mask = np.array([(places >= a) & (places < b) for a, b in spans])
    return fit(seen, mask, y, seed=seed)


def found(texts: list[str | None], net: Network) -> list[list[tuple[int, int, int, float]]]:
    """(start, end, kind, score) for each text; base findings have no score (nan). By start, then kind."""
    flat = _flat(texts)
    out: list[list] = [[] for _ in texts]
    own = Candidates(flat)
    spans = []
    for d in with_base(flat).tolist():
        out[d] = [(s, e, k, float("nan")) for s, e, k in base_findings(texts[d])]
        if out[d]:
            size = np.concatenate([[0], np.cumsum([len(c.encode()) for c in texts[d]])]) if not texts[d].isascii() else np.arange(len(texts[d]) + 1)
            spans += [(d, int(own.starts[d] + size[s]), int(own.starts[d] + size[e])) for s, e, _, _ in out[d]]
    free = np.flatnonzero(~_overlapping(own, spans))
    for a in range(0, len(free), 4096):
        part = free[a : a + 4096]
        begin, end, doc = own.begin[part], own.end[part], own.doc[part]
        seen, mask, of = own.windows(begin, end, doc)
        score = np.zeros(len(part))
        np.maximum.at(score, of, net.scores(seen, mask))
        yes = np.flatnonzero(score >= net.threshold)
        for k, s, e in zip(yes.tolist(), own.point(begin[yes], doc[yes]).tolist(), own.point(end[yes], doc[yes]).tolist()):
            out[int(doc[k])].append((s, e, 3, float(score[k])))
    return [sorted(x, key=lambda r: (r[0], r[2])) for x in out]


def _over(docs: DataFrame, text: str, doc_id: str, schema: str, rows: Callable[[object, str, list], Iterator[tuple]], net: Network) -> DataFrame:
    kind = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in in_slices(texts):
                got = [r for i, t, own in zip(ids[a:b], texts[a:b], found(texts[a:b], net)) for r in rows(i, t or "", own)]
                if got:
                    yield pa.RecordBatch.from_arrays([pa.array(c, x.type) for c, x in zip(zip(*got), kind)], schema=kind)

    return docs.select(text, doc_id).mapInArrow(run, schema)


def findings(docs: DataFrame, net: Network, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row for each finding: doc_id, kind, start, end (code points), value, score (null for base kinds)."""

    def rows(i: object, t: str, own: list) -> Iterator[tuple]:
        return ((i, KINDS[k], s, e, t[s:e], None if p != p else p) for s, e, k, p in own)

    return _over(docs, text, doc_id, f"{doc_id} {docs.schema[doc_id].dataType.simpleString()}, kind string, start long, end long, value string, score double", rows, net)


def scan(docs: DataFrame, net: Network, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Per row: doc_id, n_assign, n_access, n_hex, base_sha256, spans.

    Null and empty texts have no findings (the hash is that of nothing, spans are ''). Repeated rows and ids
    give a row each; equal starts are ordered by kind; other columns are ignored; texts and candidates of any
    length are read whole. An empty table gives no rows.
    """

    def rows(i: object, t: str, own: list) -> Iterator[tuple]:
        spelt = [(k, f"{KINDS[k]}:{s}:{e}") for s, e, k, _ in own]
        base = ",".join(x for k, x in spelt if k < 3)
        yield (i, *[sum(k == j for k, _ in spelt) for j in range(3)], hashlib.sha256(base.encode()).hexdigest(), ",".join(x for _, x in spelt))

    return _over(docs, text, doc_id, f"{doc_id} {docs.schema[doc_id].dataType.simpleString()}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string", rows, net)
