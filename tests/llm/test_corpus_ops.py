"""Phrases, aligned tokenizers and secrets against brute force, planted cases and edge cases."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pytest

from forest_evidence.llm import alignment, common, packing, phrases, queries, recompression, secret_scan

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, key long, a string, n int, phrase string, slice long, kind string, start int"
EXTRA = ("s", 4, "x", 3, "y", 7, "z", 2)


def documents(spark, rows):
    """Rows (doc_id, text, lang) with columns whose names clash with inner ones."""
    return spark.createDataFrame([(*r, *EXTRA) for r in rows], DOC)


def brute_phrases(rows, least, most):
    words, n, first = Counter(), Counter(), {}
    for i, t, g in rows:
        g = g or "und"
        t = "".join(c.lower() if c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" else c for c in t or "")
        for piece in re.split("[.,;:!?\n-\r]", t):
            w = re.findall("[^ \t]+", piece)
            n[g] += len(w)
            for m in range(1, 5):
                for k in range(len(w) - m + 1):
                    p = (g, tuple(w[k : k + m]))
                    words[p] += 1
                    first[p] = min(first.get(p, i), i)
    cand = {p: c for p, c in words.items() if c >= least and len(p[1]) > 1}
    held = Counter()
    for (g, w), c in cand.items():
        for m in range(2, len(w)):
            for k in range(len(w) - m + 1):
                held[g, w[k : k + m]] = max(held[g, w[k : k + m]], c)
    out = defaultdict(list)
    for (g, w), a in cand.items():
        if 100 * held[g, w] >= 80 * a:
            continue
        cuts = [(2000000 * a // (words[g, w[:k]] + words[g, w[k:]]), k, words[g, w[:k]], words[g, w[k:]]) for k in range(1, len(w))]
        score, _, l, r = min(cuts)
        out[g].append((-score, -a, " ".join(w).encode(), a, l, r, n[g], score, first[g, w]))
    return sorted((g, k + 1, p.decode(), *rest) for g, own in out.items() for k, (_, _, p, *rest) in enumerate(sorted(own)[:most]))


@pytest.fixture(scope="module")
def phrase_rows():
    rng = random.Random(8)
    words = ["the", "Of", "été", "new", "york", "città", "a-b", "x", "日本", "\xa0", "q" * 300]
    rows = [(i, "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t ", ". ", "\n", ",", " \x0b"]) for _ in range(rng.randrange(60))), rng.choice(["en", "en", "fr", None, "und"])) for i in range(120)]
    return [*rows, (120, None, "en"), (121, "", None), (122, " \t.\n", "fr"), rows[3], rows[3], (123, "x " * 40_000, "de")]


def test_collocations_equal_brute_force(spark, phrase_rows, monkeypatch):
    for least, size, most in ((30, 8_000_000, 2000), (4, 3000, 7)):
        monkeypatch.setattr(phrases, "LEAST", least)
        monkeypatch.setattr(phrases, "SLICE", size)
        got = phrases.collocations(documents(spark, phrase_rows), most=most)
        assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score", "first_doc_id"]
        assert sorted(tuple(r) for r in got.collect()) == brute_phrases(phrase_rows, least, most)


def test_colliding_fingerprints_are_told_apart(spark, phrase_rows, monkeypatch):
    """Two bits of a fingerprint are left in the driver's process: almost all runs collide."""
    monkeypatch.setattr(phrases, "LEAST", 4)
    own = phrases.Runs([r[1] for r in phrase_rows], [r[2] for r in phrase_rows])
    at = np.flatnonzero(own.places(2))
    keys, n, first, number = phrases._added(own.prints(at, 2) & np.uint64(3))
    assert len(keys) <= 4 and n.sum() == len(at)
    seen, rest, few = Counter(), at, own.prints(at, 2) & np.uint64(3)
    while len(rest):  # as the last pass does
        _, _, first, number = phrases._added(few)
        ok = own.same(rest, rest[first[number]], 2)
        for place, c in zip(rest[first], np.bincount(number[ok])):
            seen[own.langs[own.lang[own.doc[place]]], own.text(np.array([place]), 2)[0].as_py()] += c
        rest, few = rest[~ok], few[~ok]
    true = Counter((own.langs[own.lang[own.doc[k]]], own.text(np.array([k]), 2)[0].as_py()) for k in at)
    assert seen == true


def test_no_phrases_without_documents(spark):
    assert phrases.collocations(documents(spark, [])).count() == 0


def test_collocations_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    theirs = con.sql(queries.oracle_sql()["op11_collocations"]).df()
    ours = queries.op11_collocations(spark, SF).toPandas()[list(theirs.columns)]
    assert len(theirs) and sorted(map(tuple, ours.values.tolist())) == sorted(map(tuple, theirs.values.tolist()))


A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def brute_alignment(rows):
    import sentencepiece
    from tokenizers import Tokenizer

    whole, pieces = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    whole.encode_special_tokens = True
    raw_a, raw_b = (t.raw.to_pylist() for t in alignment.tokenizers(A, B)[:2])

    def groups(t):
        if not t:
            return None
        x, y = whole.encode(" " + t, add_special_tokens=False).ids, pieces.encode(t)
        if b"".join(raw_a[i] for i in x) != (" " + t).encode() or b"".join(raw_b[i] for i in y) != (" " + t).encode():
            return None
        ends_x, ends_y = np.cumsum([len(raw_a[i]) for i in x]).tolist(), np.cumsum([len(raw_b[i]) for i in y]).tolist()
        out, i, j = [], 0, 0
        for c in sorted({*ends_x} & {*ends_y}):
            k, m = ends_x.index(c, i) + 1, ends_y.index(c, j) + 1
            out.append((x[i:k], y[j:m]))
            i, j = k, m
        return out

    own = [(i, groups(t)) for i, t in rows]
    count = Counter()
    for _, g in own:
        count.update({(a, b) for x, y in g or [] for a in x for b in y})
    best = defaultdict(int)
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    out = []
    for i, g in own:
        links = [(a, b) for x, y in g or [] for a in x for b in y]
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g or [])
        sizes = [sum(len(x[k]) for x in g or []) for k in (0, 1)]
        out.append((i, *sizes, len(g or []), len(links), sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if g else ""))
    return sorted(out, key=str)


def test_alignment_equals_brute_force(spark, monkeypatch):
    rng = random.Random(3)
    pool = [*map(chr, range(1, 0x380)), *"    \n\t\r\x0b\x0c\x85\xa0    　᠎…“”日本語한😀é▁aaathe", " the", " of", "  ", "\n ", " \n", "<s>", "<|endoftext|>", "<0x0A>", "</s>"]
    rows = [(None, None), (1, ""), (2, " "), (3, "  "), (4, "a "), (5, " a"), (6, "x▁y z"), (7, "<|endoftext|> <s> hello"), (8, "ab" * 30_000), (9, "\n"), (10, "foo \n bar"), (11, "it's  don't"), (12, "1234567 89")]
    rows += [(20 + k, "".join(rng.choice(pool) for _ in range(rng.randrange(1, 50)))) for k in range(300)]
    rows += [(r.doc_id + 1000, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").limit(40).collect()]
    rows += [rows[30], rows[30], (30, rows[31][1])]
    want = brute_alignment(rows)
    for size, block in ((5_000_000, 300_000), (20_000, 500)):
        monkeypatch.setattr(alignment, "SLICE", size)
        monkeypatch.setattr(alignment, "_BLOCK", block)
        got = alignment.align(documents(spark, [(i, t, "en") for i, t in rows]), A, B)
        assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
        assert sorted(map(tuple, got.collect()), key=str) == want
    assert alignment.align(documents(spark, []), A, B).count() == 0


@pytest.fixture(scope="module")
def network(spark):
    return secret_scan.train(spark.read.parquet(f"{SF}/documents.parquet"))


def brute_base(t):
    """Base findings from the patterns without their least lengths, which are looked at afterwards."""
    kinds = [r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?[ ]*[:=][ ]*["']?([A-Za-z0-9+/_.=-]+)""", "AKIA[A-Z0-9]+", "[0-9a-f]+"]
    out = []
    for k, (pattern, least) in enumerate(zip(kinds, (6, 20, 24))):
        out += [(m.start(), k, m.end()) for m in re.finditer(pattern, t or "") if len(m[2] if k == 0 else m[0]) >= least]
    return sorted(out)


def test_base_findings_equal_brute_force(spark, network):
    rng = random.Random(4)
    parts = ["token", "Secret", "PASSWD", "api_key", "apikey", "ſecret", "toKen", " ", "  ", "=", ":", '"', "'", "é", "AKIA", "ABCDEF0123456789", "deadbeef0123", "x.y-z", "😀", "\n", "ghij", "abc", "0" * 13]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 25))) for _ in range(800)]
    texts += [None, "", "secret: token: abcdefgh", "a" * 100_000, "token=" + "a1" * 50_000, "AKIAAKIA" + "A" * 16, "password: short"]
    rows = [(k, t, "en") for k, t in enumerate(texts)] + [(0, texts[0], "en"), (None, texts[1], "en")]
    got = secret_scan.scan(documents(spark, rows), network).collect()
    names = secret_scan.KINDS
    spelt = lambda t: ",".join(f"{names[k]}:{a}:{b}" for a, k, b in brute_base(t))
    want = sorted(str((i, *[sum(k == j for _, k, _ in brute_base(t)) for j in range(3)], hashlib.sha256(spelt(t).encode()).hexdigest())) for i, t, _ in rows)
    assert sorted(str(tuple(r)[:5]) for r in got) == want
    for r in got:
        own = [x for x in r.spans.split(",") if x and not x.startswith("network")]
        assert hashlib.sha256(",".join(own).encode()).hexdigest() == r.base_sha256
    assert secret_scan.scan(documents(spark, []), network).count() == 0


def test_network_finds_held_out_secrets(network):
    """Other made findings than those it learned from: three per cent of harmless strings at most are reported."""
    made = secret_scan.made_findings(random.Random(99), ["river", "über", "station", "le", "maison"], 300)
    found = secret_scan.found([m[0] for m in made], network)
    hit = [any(len(m[0].encode()[:m[1]].decode()) == s for s, e, k, p in own if k == 3) or any(k < 3 for _, _, k, _ in own) for m, own in zip(made, found)]
    secrets, harmless = [h for h, m in zip(hit, made) if m[3]], [any(k == 3 for _, _, k, _ in own) for own, m in zip(found, made) if not m[3]]
    assert np.mean(secrets) >= 0.9 and np.mean(harmless) <= 0.03
    assert network.report["recall"] >= secret_scan.RECALL


def test_findings_carry_their_text(spark, network):
    text = "é https://x.example.com/a-b/c_d12345 client_secret: \"ghp_" + "aB3dE5gH7jK9mN1pQ3sT5vW7yZ9bC1dF3hJ5" + "\" password = hunter22"
    rows = secret_scan.findings(documents(spark, [(1, text, "en"), (2, None, "en")]), network).collect()
    assert all(text[r.start : r.end] == r.value for r in rows)
    assert {r.kind for r in rows} >= {"assign"} and any("ghp_" in r.value for r in rows)


def test_gradients_equal_differences():
    rng = np.random.default_rng(2)
    seen, mask = rng.integers(32, 120, (6, secret_scan.SPAN)).astype(np.uint8), np.zeros((6, secret_scan.SPAN), bool)
    mask[:, secret_scan.BEFORE : secret_scan.BEFORE + 20] = True
    y = np.array([0, 1, 0, 1, 1, 0], np.float32)
    net = secret_scan.fit(np.repeat(seen, 4, 0), np.repeat(mask, 4, 0), np.repeat(y, 4), epochs=1)
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    loss = lambda: float(np.mean(np.logaddexp(0, z := net.logits(seen, mask).astype(np.float64)) - y * z))
    grads = net.gradients(seen, mask, y)
    for name, at in (("conv", (3, 2)), ("conv", (50, 7)), ("hidden", (5, 3)), ("out", (2, 0)), ("hidden_b", (4,))):
        w, old = net.weights[name], net.weights[name][at]
        w[at] = old + 1e-3
        high = loss()
        w[at] = old - 1e-3
        low = loss()
        w[at] = old
        assert abs((high - low) / 2e-3 - grads[name][at]) < 2e-3


def test_threshold_keeps_recall():
    p = np.linspace(0, 1, 400)
    y = (np.arange(400) % 2).astype(float)
    t = secret_scan.threshold(p, y)
    assert (p[y == 1] >= t).mean() >= secret_scan.RECALL > (p[y == 1] >= t + 0.06).mean()


def test_group_links_reads_members_once_and_skips_reached_pairs(spark):
    read, compared = (spark.sparkContext.accumulator(0) for _ in range(2))
    sizes = {1: 2, 2: 5, 3: 40, 4: 60, 5: 130}  # key 5 is beyond the block
    rows = [(k, 1000 * k + i, i % (2 if k == 4 else 1), n) for k, n in sizes.items() for i in range(n)]

    def counted(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    def comparer(group):
        kind = group["kind"].to_numpy()

        def linked(x, y, some):
            compared.add(len(x))
            near = kind[x] == kind[y]
            return x[near], y[near]

        return linked

    members = common.in_frames(spark.createDataFrame(rows, "k int, id long, kind int, n_key int"), counted, "k int, id long, kind int, n_key int")
    links = common.group_links(members, "k", 100, comparer, 6).collect()
    assert read.value == len(rows)  # six times as many when every use of a large key read them anew
    assert compared.value < 2561  # all pairs of the small keys and 1040 with leads came to 3601
    sets = common.DisjointSets(6000)
    for a, b in links:
        sets.join(a, b)
    root = {i: sets.find(i) for _, i, _, _ in rows}
    assert all(root[i] == 1000 * k + (kind if k == 4 else 0) for k, i, kind, _ in rows)


def test_first_equal_of_windows_and_spelled_words():
    rng = random.Random(4)
    words = common.Words([" ".join(rng.choice(["a", "é", "日本", "\U0001f600", "x" * 90]) for _ in range(24)) * 2 for _ in range(30)] * 2)
    assert words.spelled() == words.distinct.to_pylist()
    starts = np.concatenate([np.arange(a, b - recompression.WINDOW + 1) for a, b in zip(words.starts[:-1], words.starts[1:])])
    plain = [tuple(words.codes[s : s + recompression.WINDOW].tolist()) for s in starts.tolist()]
    seen = {}
    assert recompression.first_equal(words, starts).tolist() == [seen.setdefault(w, i) for i, w in enumerate(plain)]
    assert len(recompression.first_equal(words, starts[:0])) == 0


def test_packing_memory(spark):
    """The encoder's cache is bounded by bytes, and no task leaves it to the worker's next one."""
    path = public_tokenizers.path("word_bpe_49k.json")
    plain = packing.Encoder(path).encoder
    texts = [" ".join(f"w{i}x{j}y" * 40 for j in range(40)) for i in range(30)] + ["", None, "Naïve: 12% of U.S. users’ data"]
    known = packing._encoder(path)
    known.reset()
    known.LIMIT, most = 1 << 20, 0
    try:
        for t, ids in zip(texts * 4, (x for _ in range(4) for t in texts for x in packing.token_ids([t], path))):
            assert ids.tolist() == plain.encode(t or "", add_special_tokens=False).ids
            most = max(most, len(known.chunk))
    finally:
        del known.LIMIT
    assert 40 < most < 1200  # of 1200 chunks
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1)

    def held(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": [len(packing._encoder(path).chunk)]})

    assert packing.pieces(docs, path).count() >= len(texts)
    assert {r.n for r in docs.select("doc_id").mapInArrow(held, "n long").collect()} == {0}


def test_batch_memory(spark):
    """Python workers take up a few MB of rows at a time, whatever a batch holds; rows, order and the session stay."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    docs = spark.range(0, 3000, 1, 1).selectExpr("id doc_id", "if(id % 7 = 0, null, repeat(cast(id as string), 1500)) text")
    docs = docs.unionByName(spark.range(1).selectExpr("-1L doc_id", "repeat('x', 9000000) text")).coalesce(1)

    def sizes(frames):
        for f in frames:
            yield pd.DataFrame({"rows": [len(f)], "chars": [int(f["text"].str.len().sum())], "first": [f["doc_id"].iloc[0]]})

    def whole(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": [b.nbytes]})

    for own in (lambda df: df, common.staged):
        got = [r for r in own(common.in_frames(docs, sizes, "rows long, chars long, first long")).collect()]
        assert sum(r.rows for r in got) == 3001 and [r.first for r in got[:-1]] == sorted(r.first for r in got[:-1])
        assert max(r.chars for r in got if r.rows > 1) <= common.BATCH_BYTES
    kept = common.in_batches(docs, lambda texts: np.array([t is not None for t in texts]), "text")
    assert [r.doc_id for r in kept.select("doc_id").collect()] == [*(i for i in range(3000) if i % 7), -1]
    assert max(r.n for r in common.staged(docs.where("doc_id >= 0").mapInArrow(whole, "n long")).collect()) < 2 * common.BATCH_BYTES
    assert spark.conf.get(name) == before
    assert [b - a for a, b in common.in_slices(["x" * 400_000] * 6)] == [3, 3]
