"""Registered queries of the training-data operators, one per operator, each
over the whole ``documents`` (12: ``embeddings``) table, and the DuckDB SQL of those SQL can say."""

from __future__ import annotations

from ledgerlens.llm.bpe import op2_byte_level_bpe
from ledgerlens.llm.centroids import op12_centroid_clustering
from ledgerlens.llm.common import documents
from ledgerlens.llm.divergence import op13_source_divergence
from ledgerlens.llm.fingerprints import op9_document_fingerprints
from ledgerlens.llm.jaccard import op3_ngram_jaccard_join
from ledgerlens.llm.languages import op4_language_id
from ledgerlens.llm.mixing import op1_mixing_sources
from ledgerlens.llm.pieces import op11_sentencepiece
from ledgerlens.llm.pseudo_likelihood import op7_lm_scoring
from ledgerlens.llm.quality import op6_quality_rules
from ledgerlens.llm.substrings import op10_substring_dedup
from ledgerlens.llm.suffixes import op5_suffix_array_dedup
from ledgerlens.llm.token_files import op8_token_files


def _over_documents(op):
    return lambda spark, sf_dir: op(documents(spark, sf_dir))


QUERIES = {f.__name__: _over_documents(f) for f in (
    op1_mixing_sources,
    op2_byte_level_bpe,
    op3_ngram_jaccard_join,
    op4_language_id,
    op5_suffix_array_dedup,
    op6_quality_rules,
    op7_lm_scoring,
    op8_token_files,
    op9_document_fingerprints,
    op10_substring_dedup,
    op11_sentencepiece,
    op13_source_divergence,
)}
QUERIES["op12_centroid_clustering"] = lambda spark, sf_dir: op12_centroid_clustering(
    spark.read.parquet(f"{sf_dir}/embeddings.parquet"))

# op6: the same rules, spelled out over lists.
_OP6 = r"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM documents),
base AS (
  SELECT doc_id, ws, ls, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         length(t) - length(replace(t, '!', '')) AS n_marks,
         len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines
  FROM w),
win AS (
  SELECT doc_id, unnest(range(1, n_words - 6)) AS i, ws FROM base WHERE n_words >= 8),
grams AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(ws[i:i+7], ' ')) AS n FROM win),
covered AS (
  SELECT doc_id, count(*) AS n FROM (
    SELECT DISTINCT doc_id, unnest(range(i, i + 8)) AS p FROM grams WHERE n > 1) GROUP BY doc_id),
f AS (
  SELECT base.*, coalesce(covered.n, 0) AS n_repeat_words FROM base LEFT JOIN covered USING (doc_id)),
g AS (
  SELECT *, (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed FROM f)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT (base_failed OR 100 * n_symbols > 5 * word_chars OR 100 * n_marks > 5 * word_chars
            OR word_chars > 20 * n_words OR word_chars < 2 * n_words OR 2 * n_dup_lines > n_lines) AS kept
FROM g
"""

# op3: all pairs that share a shingle, then everything reachable.
_OP3 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i+4], ' ') AS sh
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
  FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM pairs JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id
  WHERE 100 * common >= 80 * (x.n + y.n - common)),
reach AS (
  SELECT a, b FROM links
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(r.low, d.doc_id)) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a, min(b) AS low FROM reach GROUP BY a) r ON d.doc_id = r.a
"""

# op5: every 200-byte string as hexadecimal text.
_OP5 = r"""
WITH h AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS hx, strlen(coalesce(text, '')) AS n FROM documents),
win AS (
  SELECT doc_id, i, md5(substr(hx, 2 * i + 1, 400)) AS k
  FROM (SELECT doc_id, hx, unnest(range(0, n - 199)) AS i FROM h WHERE n >= 200)),
hit AS (
  SELECT doc_id, i FROM win JOIN (SELECT k FROM win GROUP BY k HAVING count(*) > 1) USING (k)),
cut AS (
  SELECT doc_id, i, coalesce(i > lag(i) OVER w + 200, true) AS fresh FROM hit WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
span AS (
  SELECT doc_id, min(i) AS lo, max(i) + 200 AS hi
  FROM (SELECT *, sum(fresh::int) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM cut) GROUP BY doc_id, g),
piece AS (
  SELECT doc_id, lo, hi, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) AS since FROM span),
kept AS (
  SELECT doc_id, sum(hi - lo) AS gone, count(*) AS cuts,
         string_agg(substr(hx, 2 * since + 1, 2 * (lo - since)), '' ORDER BY lo) || substr(any_value(hx), 2 * max(hi) + 1) AS hx
  FROM piece JOIN h USING (doc_id) GROUP BY doc_id)
SELECT h.doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(cuts, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept.hx, h.hx))) AS kept_sha256
FROM h LEFT JOIN kept USING (doc_id)
"""

# op10: every 50-word window as text.
_OP10 = r"""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
win AS (
  SELECT doc_id, i, md5(array_to_string(ws[i:i+49], ' ')) AS k
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w WHERE len(ws) >= 50)),
gone AS (
  SELECT doc_id, list(DISTINCT p) AS ps
  FROM (SELECT doc_id, unnest(range(i, i + 50)) AS p
        FROM (SELECT *, min(doc_id) OVER (PARTITION BY k) AS lo FROM win) WHERE lo < doc_id)
  GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(len(ps), 0) AS BIGINT) AS n_removed,
       sha256(array_to_string(CASE WHEN ps IS NULL THEN ws ELSE
         list_filter(ws, lambda x, i: NOT list_contains(ps, i)) END, ' ')) AS kept_sha256
FROM w LEFT JOIN gone USING (doc_id)
"""

# op12: the rounds one after another, every distance computed.
def _op12(rounds: int = 10, k: int = 8) -> str:
    nearest = """
a{r} AS MATERIALIZED (
  SELECT i, vec_id, v, num, d FROM (
    SELECT vec.i, vec.vec_id, vec.v, c.num, list_sum(list_transform(range(1, 65), lambda j: (vec.v[j] - c.v[j]) * (vec.v[j] - c.v[j]))) AS d
    FROM vec, c{r} c)
  QUALIFY row_number() OVER (PARTITION BY i ORDER BY d, num) = 1)"""
    moved = """
c{n} AS MATERIALIZED (
  SELECT c.num, coalesce(m.v, c.v) AS v
  FROM c{r} c LEFT JOIN (
    SELECT num, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS v
    FROM (SELECT num, j, sum(x) AS s, count(*) AS n FROM (SELECT num, unnest(range(1, 65)) AS j, unnest(v) AS x FROM a{r}) GROUP BY num, j)
    GROUP BY num) m USING (num))"""
    steps = [(nearest + "," + moved).format(r=r, n=r + 1) for r in range(rounds)]
    return rf"""
WITH vec AS MATERIALIZED (
  SELECT row_number() OVER () AS i, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS num, v
  FROM (SELECT sha256('3:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, v FROM vec ORDER BY h, v LIMIT {k})),
{",".join(steps)},
{nearest.format(r=rounds)}
SELECT vec_id, CAST(num AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
       CAST(sum(d) OVER (PARTITION BY num) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c{rounds}.v, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} USING (num)
"""


# op13: every kept term of a language for every source of it.
_OP13 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
w AS (
  SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
n AS (SELECT lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY ALL),
size AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
grp AS (
  SELECT g.lang, g.source, coalesce(size.v, 0) AS v, coalesce(t.total, 0) AS total
  FROM (SELECT DISTINCT lang, source FROM d) g LEFT JOIN size USING (lang)
  LEFT JOIN (SELECT lang, source, sum(n) AS total FROM n GROUP BY lang, source) t USING (lang, source)),
p AS (
  SELECT grp.lang, grp.source, term, coalesce(n.n, 0) AS n,
         1 + (1000000000 * CAST(coalesce(n.n, 0) + 2 AS HUGEINT)) // (total + 2 * v) AS p
  FROM grp JOIN kept USING (lang) LEFT JOIN n USING (lang, source, term)),
q AS (
  SELECT lang, term, 1 + (1000000000 * CAST(sum(n) + 2 AS HUGEINT)) // (any_value(total) + 2 * any_value(v)) AS q
  FROM n JOIN (SELECT lang, sum(total) AS total, any_value(v) AS v FROM grp GROUP BY lang) l USING (lang) GROUP BY lang, term),
pair AS (
  SELECT x.lang, x.source, y.source AS item, coalesce(s.value, 0) AS value
  FROM grp x JOIN grp y ON x.lang = y.lang AND x.source <> y.source
  LEFT JOIN (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
             FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL) s
    ON s.lang = x.lang AND s.source = x.source AND s.item = y.source),
term AS (
  SELECT lang, source, term AS item, ((p - q) * (p - q)) // (p + q) AS value
  FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
every AS (
  SELECT *, 'pair' AS part, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pair
  UNION ALL
  SELECT *, 'term', row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) FROM term)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM every WHERE part = 'pair' OR rank <= 10
"""

ORACLE_SQL = {
    "op3_ngram_jaccard_join": _OP3,
    "op5_suffix_array_dedup": _OP5,
    "op6_quality_rules": _OP6,
    "op10_substring_dedup": _OP10,
    "op12_centroid_clustering": _op12(),
    "op13_source_divergence": _OP13,
}
