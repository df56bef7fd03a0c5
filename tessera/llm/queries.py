"""The registered queries of this subpackage: thin digests of what the operators return."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import arrow_store, bm25, bpe_shuffle, factorisation, fim, mixing, parity, piece_agenda, repetition, spelling, substring, transducer, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return keep


def _documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(*(columns or ("doc_id", "text")))


@_query()
def op2_arrow_fixed_size(spark, sf_dir):
    """Arrow files of fixed-size sequences, written and read back."""
    return arrow_store.write_and_digest(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), end_id=2)


@_query()
def op3_transducer_counts(spark, sf_dir):
    """Token counts by the compiled transducer."""
    rows = transducer.with_token_counts(_documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))
    return rows.select("row.doc_id", "n_bytes", "n_tokens", "over_limit")


@_query()
def op6_word_shuffle_bpe(spark, sf_dir):
    """BPE ids by the distinct-word shuffle, and the bytes decoded from them."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe_shuffle.digest(_documents(spark, sf_dir), path, public_tokenizers.PATTERN)


_COVERED = """cov{n} AS (SELECT doc_id, sum(sz)::BIGINT AS chars, count(*) AS words FROM (
  SELECT DISTINCT w.doc_id, w.pos, w.sz FROM word w JOIN (
    SELECT doc_id, unnest(list_sort(ps)) AS s FROM (SELECT doc_id, g, list(pos) AS ps FROM (
      SELECT doc_id, pos, list(w) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND {m} FOLLOWING) AS g FROM word)
      WHERE len(g) = {n} GROUP BY doc_id, g HAVING count(*) > 1)) d
  ON w.doc_id = d.doc_id AND w.pos BETWEEN d.s AND d.s + {m}) GROUP BY doc_id)"""


@_query(
    r"""WITH word AS (SELECT doc_id, w, CAST(length(w) AS BIGINT) AS sz, CAST(pos AS BIGINT) AS pos FROM (
  SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS pos FROM (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents))),
"""
    + ",\n".join(_COVERED.format(n=n, m=n - 1) for n in (3, 5, 7, 10))
    + r""",
line AS (SELECT doc_id, l, row_number() OVER (PARTITION BY doc_id, l ORDER BY k) AS nth FROM (
  SELECT doc_id, unnest(ls) AS l, generate_subscripts(ls, 1) AS k FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]')),
dup AS (SELECT doc_id, count(*) AS n, CAST(sum(length(l)) AS BIGINT) AS chars FROM line WHERE nth > 1 GROUP BY doc_id),
base AS (SELECT doc_id, count(*) AS n_words, CAST(sum(sz) AS BIGINT) AS word_chars FROM word GROUP BY doc_id),
stat AS (SELECT d.doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
  CAST(length(coalesce(text, '')) - length(regexp_replace(coalesce(text, ''), '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(cov5.words, 0)::BIGINT AS n_repeat_words, coalesce(dup.chars, 0) AS dc,
  coalesce(cov3.chars, 0) AS c3, coalesce(cov5.chars, 0) AS c5, coalesce(cov7.chars, 0) AS c7, coalesce(cov10.chars, 0) AS c10
  FROM documents d LEFT JOIN base USING (doc_id) LEFT JOIN dup USING (doc_id) LEFT JOIN cov3 USING (doc_id) LEFT JOIN cov5 USING (doc_id) LEFT JOIN cov7 USING (doc_id) LEFT JOIN cov10 USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND 100 * dc <= 30 * word_chars AND 100 * c3 <= 40 * word_chars AND 100 * c5 <= 20 * word_chars
  AND 100 * c7 <= 18 * word_chars AND 100 * c10 <= 16 * word_chars AS kept FROM stat"""
)
def op7_repetition_coverage(spark, sf_dir):
    """Quality rules by repetition coverage, at the operator's own limits for texts of any length."""
    rows = repetition.repetition(_documents(spark, sf_dir), rules=repetition.STRICT)
    return rows.select("row.doc_id", *[f"stats.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")], "base_failed", "kept")


@_query()
def op8_pivotal_mixing(spark, sf_dir):
    """Sources mixed to their targets by pivotal rounding."""
    rows = mixing.plan(_documents(spark, sf_dir, "doc_id", "source", "text"))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


@_query(
    r"""WITH word AS (SELECT doc_id, unnest(ws) AS w, CAST(generate_subscripts(ws, 1) AS BIGINT) AS pos FROM (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents)),
win AS (SELECT doc_id, pos, list(w) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING) AS g FROM word),
later AS (SELECT doc_id, pos AS s FROM (SELECT doc_id, pos, row_number() OVER (PARTITION BY g ORDER BY doc_id, pos) AS nth FROM win WHERE len(g) = 20) WHERE nth > 1),
gone AS (SELECT DISTINCT doc_id, s + k AS pos FROM later, range(20) t(k)),
marked AS (SELECT w.doc_id, w.pos, w.w, g.pos IS NOT NULL AS removed FROM word w LEFT JOIN gone g ON w.doc_id = g.doc_id AND w.pos = g.pos),
agg AS (SELECT doc_id, count(*) AS n_words, count(*) FILTER (removed) AS n_removed, coalesce(string_agg(w, ' ' ORDER BY pos) FILTER (NOT removed), '') AS kept FROM marked GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN agg USING (doc_id)"""
)
def op9_level_doubling(spark, sf_dir):
    """Words of repeated 20-word windows removed but for their first place."""
    return substring.dedup(_documents(spark, sf_dir)).select("row.doc_id", "n_words", "n_removed", "kept_sha256")


@_query(
    r"""WITH RECURSIVE text AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
word AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS pos FROM text WHERE len(ws) >= 4),
shingle AS (SELECT DISTINCT doc_id, g FROM (SELECT doc_id, list(w) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING) AS g FROM word) WHERE len(g) = 4
  UNION ALL SELECT doc_id, ws FROM text WHERE len(ws) BETWEEN 1 AND 3),
sizes AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM shingle a JOIN shingle b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * i >= 85 * (x.n + y.n - i)),
edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach(a, b) AS (SELECT a, b FROM edge UNION SELECT r.a, e.b FROM reach r JOIN edge e ON r.b = e.a),
least AS (SELECT a, min(b) AS m FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(m, d.doc_id)) AS component_id
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN least ON least.a = d.doc_id"""
)
def op10_parity_sketch_join(spark, sf_dir):
    """Components of documents linked by the Jaccard similarity of their 4-word shingles."""
    return parity.join(_documents(spark, sf_dir), n=4, percent=85)


@_query()
def op4_factorisation_machine(spark, sf_dir):
    """Quality scores of a factorisation machine fitted on the rows that are not held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return factorisation.classify(_documents(spark, sf_dir, "doc_id", "text", "n_chars"), labels, metadata=["n_chars"]).select("row.doc_id", "held_out", "score", "predicted")


@_query()
def op1_warc_derivatives(spark, sf_dir):
    """Metadata and conversion records of a response record of every page."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    raw = pages.select("page_id", warc.responses(F.col("url"), F.col("html")).alias("raw"))
    return warc.derivatives(raw, "raw").select(F.col("row.page_id").alias("page_id"), "record_type", "record_id", "refers_to", "target_uri", "block_digest", "source_digest", F.length("record").cast("long").alias("n_bytes"), "text")


@_query(
    r"""WITH word AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')) AS w FROM documents),
tf AS (SELECT doc_id, w, count(*) AS n FROM word GROUP BY 1, 2),
len AS (SELECT doc_id, sum(n) AS l FROM tf GROUP BY 1),
stat AS (SELECT (SELECT count(*) FROM documents) AS n, (SELECT sum(l) FROM len)::DOUBLE / (SELECT count(*) FROM documents) AS mean),
df AS (SELECT w, count(*) AS df FROM tf GROUP BY 1),
scored AS (SELECT q.doc_id AS query_id, d.doc_id, sum(q.n * ln(1 + (stat.n - df + 0.5) / (df + 0.5)) * d.n * 2.2 / (d.n + 1.2 * (0.25 + 0.75 * l / mean))) AS score
  FROM tf q JOIN tf d ON q.w = d.w JOIN df ON df.w = q.w JOIN len ON len.doc_id = d.doc_id, stat WHERE q.doc_id % 100 = 0 GROUP BY 1, 2),
best AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id) AS rank FROM scored)
SELECT query_id, doc_id, round(score, 4) AS score, rank FROM best WHERE rank <= 10"""
)
def op5_block_max_bm25(spark, sf_dir):
    """The ten best documents for each document whose id is divisible by 100, against all documents."""
    docs = _documents(spark, sf_dir)
    found = bm25.search(docs, docs.filter("doc_id % 100 = 0"), k=10)
    return found.select("query_id", "doc_id", F.round("score", 4).alias("score"), "rank")


@_query(
    r"""WITH drawn AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS s FROM documents),
number AS (SELECT doc_id, t, CAST(length(t) AS BIGINT) AS n, CAST('0x' || substr(s, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(s, 9, 8) AS BIGINT) AS h2,
  CAST('0x' || substr(s, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(s, 25, 8) AS BIGINT) AS h4 FROM drawn),
cut AS (SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
  CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM number),
made AS (SELECT *, substr(t, 1, a) AS prefix, substr(t, a + 1, b - a) AS middle, substr(t, b + 1) AS suffix FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(t) AS restored_sha256 FROM made"""
)
def op12_byte_dfa_fim(spark, sf_dir):
    """Fill-in-the-middle outputs of every text, and the texts rebuilt from them."""
    rows = fim.transform(_documents(spark, sf_dir), seed=1, percent=90, spm=20)
    back = F.sha2(fim.restore(F.col("output"), F.col("form")), 256)
    return rows.select("row.doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), back.alias("restored_sha256"))


@_query()
def op11_piece_agenda(spark, sf_dir):
    """Ids by the agenda of symbol pairs, with begin and end ids, and the text that the library decodes from them."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    rows = piece_agenda.encode(_documents(spark, sf_dir), path)
    decoded = F.sha2(piece_agenda.decode(F.col("ids"), path), 256)
    return rows.select("row.doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), decoded.alias("decoded_sha256"), "agrees")


@_query(
    r"""WITH RECURSIVE run AS (SELECT doc_id, r, count(*) AS c FROM (
  SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{C0}-\x{FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS r FROM documents)
  WHERE length(r) >= 6 GROUP BY 1, 2),
code AS (SELECT *, list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || r, ''), lambda x: CAST(unicode(x) AS BIGINT)) AS cs FROM run),
step AS (SELECT *, list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(cs, lambda x: CASE WHEN x < 128 THEN [x, -1, -1, -1, -1, -1, -1, -1, -1]
  ELSE [195, -1, -1, -1, -1, -1, -1, -1, -1, x - 64, -1, -1, -1, -1, -1, -1, -1, -1] END))) AS bs FROM code),
hashed AS (SELECT r, c, xor(4294967295, list_reduce(bs, lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) ELSE xor(a >> 1, 3988292384 * (a & 1)) END)) AS h FROM step),
slipped AS (SELECT CASE WHEN h % 199 = 0 THEN substr(r, 1, CAST(h % length(r) AS BIGINT)) || substr(r, CAST(h % length(r) AS BIGINT) + 2) ELSE r END AS w, c FROM hashed),
vocab AS (SELECT w, CAST(sum(c) AS BIGINT) AS n FROM slipped WHERE length(w) >= 6 GROUP BY w HAVING sum(c) >= 5),
gap AS (SELECT w, i, substr(w, 1, i - 1) || substr(w, i + 1) AS d FROM (SELECT w, unnest(range(1, length(w) + 1)) AS i FROM vocab)),
near AS (SELECT a.w AS w, b.w AS o FROM gap a JOIN gap b ON a.d = b.d AND a.i = b.i AND a.w <> b.w
  UNION SELECT g.w, v.w FROM gap g JOIN vocab v ON g.d = v.w UNION SELECT v.w, g.w FROM gap g JOIN vocab v ON g.d = v.w),
ranked AS (SELECT near.w, o, n AS m, row_number() OVER (PARTITION BY near.w ORDER BY n DESC, o) AS k, count(*) OVER (PARTITION BY near.w) AS n_near FROM near JOIN vocab ON vocab.w = o),
formed AS (SELECT v.w AS word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 5 * n THEN o END AS form, CASE WHEN m >= 5 * n THEN m END AS form_n FROM vocab v LEFT JOIN ranked r ON r.w = v.w AND k = 1),
chain(word, root, depth) AS (SELECT word, word, 0 FROM formed UNION ALL SELECT c.word, f.form, depth + 1 FROM chain c JOIN formed f ON f.word = c.root WHERE f.form IS NOT NULL),
ending AS (SELECT word, arg_max(root, depth) AS root FROM chain GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN ending USING (word)"""
)
def op13_letter_parity_bands(spark, sf_dir):
    """Frequent words, their frequent near words and the spelling that these lead to; one run in 199 has a slip planted."""
    return spelling.variants(spelling.words(_documents(spark, sf_dir), least=6, often=5, slip=199), ratio=5)
