"""The queries of the training-data operators, each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, decontaminate, edit_print, html_text, langid, licences, packing, phrases, pii, recompression, secret_scan, setsketch, toxicity


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op2_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.with_surrogates(table(spark, sf_dir, "documents").select("doc_id", "text"), pii.session_key(spark))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = langid.held_out(F.col("doc_id"))
    model = langid.train(docs.where(~out), public_tokenizers.path("piece_bpe_32k.model"))
    return langid.predict(docs, model).select("doc_id", out.alias("held_out"), "lang_pred", "score")


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setsketch.near_duplicates(table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_print.edited_prints(table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recompression.without_repeats(table(spark, sf_dir, "documents"))


def op10_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licences.scan(docs, licences.train(spark, docs))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secret_scan.scan(docs, secret_scan.train(docs))


def edit_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of near texts by banded edit fingerprints, beside operator 7's query, whose contract has no pairs."""
    return edit_print.near_classes(table(spark, sf_dir, "documents"))


def queries() -> dict:
    return {k: f for k, f in globals().items() if k.startswith("op") and callable(f)} | {"edit_classes": edit_classes}


_WORDS = "regexp_extract_all(coalesce({}, ''), '[^ \\t-\\r]+')"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: Near-duplicate classes: all pairs that share a shingle, and what can be reached over links.
NEAR_DUPLICATES = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(_LOWER)} AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i : i + 4], ' ') AS sh FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0) t),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 85 * (a.n + b.n - c)),
r AS (SELECT x AS id, x AS other FROM l UNION SELECT r.id, l.y FROM r JOIN l ON r.other = l.x),
k AS (SELECT id, min(other) AS least FROM r GROUP BY 1)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(k.least, w.doc_id) AS component_id, w.doc_id = coalesce(k.least, w.doc_id) AS kept
FROM w LEFT JOIN n ON w.doc_id = n.doc_id LEFT JOIN k ON w.doc_id = k.id"""

#: Words left when windows of 20 words that also start earlier are removed.
WITHOUT_REPEATS = f"""
WITH w AS (SELECT doc_id, {_WORDS.format('text')} AS ws FROM documents),
v AS (SELECT doc_id, i, array_to_string(ws[i : i + 19], ' ') AS k FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM w WHERE len(ws) > 19) t),
f AS (SELECT k, min((doc_id, i)) AS earliest, count(*) AS n FROM v GROUP BY 1 HAVING count(*) > 1),
g AS (SELECT DISTINCT doc_id, i + j AS i FROM (SELECT v.doc_id, v.i, unnest(range(20)) AS j FROM v JOIN f ON v.k = f.k WHERE (v.doc_id, v.i) <> f.earliest) t),
e AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM w),
q AS (SELECT e.doc_id, string_agg(e.word, ' ' ORDER BY e.i) AS kept, count(*) AS n FROM e LEFT JOIN g ON e.doc_id = g.doc_id AND e.i = g.i WHERE g.i IS NULL GROUP BY 1)
SELECT w.doc_id, len(ws) AS n_words, len(ws) - coalesce(q.n, 0) AS n_removed, sha256(coalesce(q.kept, '')) AS kept_sha256 FROM w LEFT JOIN q ON w.doc_id = q.doc_id"""

#: Phrases at their weakest cut: every run of one to four words of a piece is counted by language.
COLLOCATIONS = f"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, doc_id, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\\n-\\r]')) AS piece FROM documents WHERE text IS NOT NULL),
w AS (SELECT lang, doc_id, ws FROM (SELECT lang, doc_id, regexp_extract_all(piece, '[^ \\t]+') AS ws FROM p) t WHERE len(ws) > 0),
t AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY 1),
g AS (SELECT lang, doc_id, m, array_to_string(ws[i : i + m - 1], ' ') AS phrase FROM (SELECT lang, doc_id, ws, m, unnest(range(1, len(ws) - m + 2)) AS i FROM w, (SELECT unnest(range(1, 5)) AS m) s WHERE len(ws) >= m) u),
f AS (SELECT lang, phrase, m, count(*) AS f, min(doc_id) AS first_doc_id FROM g GROUP BY 1, 2, 3 HAVING count(*) >= 30),
c AS (SELECT lang, phrase, m, f AS a, first_doc_id, string_split(phrase, ' ') AS ws FROM f WHERE m > 1),
k AS (SELECT lang, phrase, a, first_doc_id, k, array_to_string(ws[1 : k], ' ') AS left_part, array_to_string(ws[k + 1 : m], ' ') AS right_part FROM (SELECT *, unnest(range(1, m)) AS k FROM c) u),
s AS (SELECT k.lang, k.phrase, k.a, k.first_doc_id, k.k, x.f AS l, y.f AS r, (2000000 * k.a::HUGEINT // (x.f + y.f))::BIGINT AS score
  FROM k JOIN f x ON x.lang = k.lang AND x.phrase = k.left_part JOIN f y ON y.lang = k.lang AND y.phrase = k.right_part),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
h AS (SELECT lang, a, array_to_string(ws[i : i + j - 1], ' ') AS phrase FROM (SELECT *, unnest(range(1, m - j + 2)) AS i FROM (SELECT *, unnest(range(2, m)) AS j FROM c) u) v),
d AS (SELECT b.* FROM b LEFT JOIN (SELECT lang, phrase, max(a) AS longer FROM h GROUP BY 1, 2) h ON h.lang = b.lang AND h.phrase = b.phrase WHERE longer IS NULL OR 100 * longer < 80 * b.a),
q AS (SELECT d.*, row_number() OVER (PARTITION BY d.lang ORDER BY score DESC, a DESC, phrase) AS rank FROM d)
SELECT q.lang, rank, phrase, a, l, r, n, score, first_doc_id FROM q JOIN t ON t.lang = q.lang WHERE rank <= 2000"""


def oracle_sql() -> dict[str, str]:
    """The queries whose rows are determined by their contract; the others learn, sketch or choose."""
    return {"op5_near_duplicates": NEAR_DUPLICATES, "op9_substring_dedup": WITHOUT_REPEATS, "op11_collocations": COLLOCATIONS}
