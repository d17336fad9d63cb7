"""Inventories, folder signatures and the diff of runs."""

import datetime as dt
import hashlib
import random

from forest_evidence import sources
from forest_evidence.operators import evidence as E
from forest_evidence.plans import jobs


def test_large_files_are_hashed_block_by_block(spark, tmp_path):
    """One file over 2 GB (sparse), beside small ones, an empty one and names with special characters."""
    (tmp_path / "a b%20c").mkdir()
    made = {"a b%20c/x#1.json": b"{}", "empty.csv": b"", "mid.bin": b"m" * 5000, "deep.geojson": bytes(9_000_000)}
    for name, body in made.items():
        (tmp_path / name).write_bytes(body)
    big = (1 << 31) + 12345
    with open(tmp_path / "big.tif", "wb") as f:
        f.truncate(big)
    got = {r.relpath: (r.sha256, r.size_bytes) for r in sources.file_inventory(spark, str(tmp_path), 4000).collect()}
    digest, zeros = hashlib.sha256(), bytes(1 << 24)
    for _ in range(big >> 24):
        digest.update(zeros)
    digest.update(bytes(big % (1 << 24)))
    want = {n: (hashlib.sha256(b).hexdigest(), len(b)) for n, b in made.items()} | {"big.tif": (digest.hexdigest(), big)}
    assert got == want
    assert {r.relpath: (r.sha256, r.size_bytes) for r in sources.file_inventory(spark, str(tmp_path)).collect()} == want


def files(spark, rows):
    return spark.createDataFrame(rows, "b string, relpath string, sha256 string")


def test_equal_subtrees_have_equal_signatures(spark):
    rows = [("x", "p/q/1", "a"), ("x", "p/q/2", "b"), ("x", "r/q/2", "b"), ("x", "r/q/1", "a"), ("x", "s/1", "b"), ("x", "s/2", "a"), ("x", "top", None)]
    got = {r.folder: r for r in E.folder_signatures(files(spark, rows), ["b"]).collect()}
    assert {k: r.n_files for k, r in got.items()} == {"": 7, "p": 2, "p/q": 2, "r": 2, "r/q": 2, "s": 2}
    assert got["p"].signature == got["r"].signature and got["p/q"].signature == got["r/q"].signature
    assert got["s"].signature != got["p/q"].signature  # the same hashes under other names
    assert E.folder_signatures(files(spark, []), ["b"]).count() == 0


def test_diff_by_folders_equals_the_plain_one(spark):
    draw = random.Random(3)
    paths = sorted({"/".join(draw.choices("abc", k=draw.randint(1, 4))) + ".x" for _ in range(200)})
    side = lambda odds: [(b, p, "h" if draw.random() > odds else draw.choice(["h", "i", None])) for b in "xyz" for p in paths if draw.random() > odds]
    for odds in (0.0, 0.02, 0.4):
        a, b = files(spark, side(odds)), files(spark, side(odds))
        plain = E.diff_signatures(a, b, ["b", "relpath"])
        assert sorted(map(tuple, E.diff_by_folders(a, b, ["b"]).collect())) == sorted(map(tuple, plain.select("b", "relpath", "state").collect()))


def test_publishing_twice_changes_nothing(spark):
    day = dt.date(2024, 1, 1)
    runs = spark.createDataFrame([("s", f"r{i}", day + dt.timedelta(i)) for i in range(3)], "site_id string, run_name string, bundle_date date")
    kind = "site_id string, run_name string, relpath string, sha256 string, size_bytes bigint"
    mine = spark.createDataFrame([("s", f"r{i}", p, p, 2) for i in range(3) for p in ("a/1", "a/2", "b/1", "a/.env")], kind)
    nothing = spark.createDataFrame([], kind)
    index, changes, old = jobs.publish_changes(runs, mine, nothing)
    assert [(r.run_name, r["rank"], r.n_files, r.size_bytes, r.state, r.n_changes) for r in index.collect()] == [("r1", 2, 3, 6, "added", 0), ("r2", 1, 3, 6, "added", 0)]
    assert changes.count() == 0 and old.count() == 0
    index, changes, old = jobs.publish_changes(runs, mine, mine)
    assert {r.state for r in index.collect()} == {"same"} and changes.count() == 0
    assert sorted((r.run_name, r.relpath) for r in old.collect()) == [("r0", "a/1"), ("r0", "a/2"), ("r0", "b/1")]


def test_files_of_the_latest_runs_alone_are_hashed(spark, monkeypatch):
    runs = spark.createDataFrame([("s", f"r{i}", i) for i in range(9)], "site_id string, run_name string, bundle_date int")
    kind = "site_id string, run_name string, relpath string, sha256 string, size_bytes bigint"
    mine = spark.createDataFrame([("s", f"r{i}", p, p, 2) for i in range(9) for p in ("a/1", "b")], kind)
    there = spark.createDataFrame([("s", f"r{i}", p, p if i < 8 else "old", 2) for i in range(9) for p in ("a/1", "b")], kind)
    seen, plain = set(), jobs.E.folder_signatures

    def watched(files, keys, **how):
        seen.update(r.run_name for r in files.select("run_name").distinct().collect())
        return plain(files, keys, **how)

    monkeypatch.setattr(jobs.E, "folder_signatures", watched)
    index, changes, old = jobs.publish_changes(runs, mine, there)
    assert {(r.run_name, r.state, r.n_changes) for r in index.collect()} == {("r7", "same", 0), ("r8", "changed", 2)}
    assert changes.count() == 2 and old.count() == 14
    assert seen == {"r7", "r8"}
