"""Registered queries of the subpackage and their DuckDB twins."""

from __future__ import annotations

from tavola.llm import (ann, class_lm, credentials, decontaminate, order_minhash, pii, quality_kn, sentencepiece_viterbi, shared_terms, style_tree,
                        substring_dedup, suffix_dedup, token_alignment)

QUERIES = {
    "op1_substring_dedup": substring_dedup.op1_substring_dedup,
    "op2_rotated_bits_ann": ann.op2_rotated_bits_ann,
    "op3_suffix_dedup": suffix_dedup.op3_suffix_dedup,
    "op4_brown_class_lm": class_lm.op4_brown_class_lm,
    "op5_style_tree_text": style_tree.op5_style_tree_text,
    "op6_sentencepiece": sentencepiece_viterbi.op6_sentencepiece,
    "op7_template_decontamination": decontaminate.op7_template_decontamination,
    "op8_order_minhash": order_minhash.op8_order_minhash,
    "op9_feistel_pii": pii.op9_feistel_pii,
    "op10_kneser_ney_quality": quality_kn.op10_kneser_ney_quality,
    "op11_shared_term_search": shared_terms.op11_shared_term_search,
    "op12_token_alignment": token_alignment.op12_token_alignment,
    "op13_multipart_secrets": credentials.op13_multipart_secrets,
}

ORACLE: dict[str, str] = {
    "op1_substring_dedup": """
WITH w AS (
  SELECT doc_id, [x FOR x IN regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+') IF x <> ''] AS words
  FROM documents),
p AS (
  SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM w WHERE len(words) >= 50),
k AS (SELECT doc_id, i, array_to_string(words[i:i + 49], ' ') AS win FROM p),
f AS (SELECT win, min(doc_id) AS first FROM k GROUP BY win),
hit AS (SELECT k.doc_id, k.i FROM k JOIN f USING (win) WHERE f.first < k.doc_id),
gone AS (SELECT doc_id, list(DISTINCT j) AS cut FROM (
  SELECT doc_id, unnest(range(i, i + 50)) AS j FROM hit) GROUP BY doc_id),
r AS (
  SELECT w.doc_id, w.words, coalesce(cut, []) AS cut FROM w LEFT JOIN gone USING (doc_id)),
e AS (
  SELECT doc_id, len(words) AS n_words, len(cut) AS n_removed,
         CASE WHEN len(cut) = 0 THEN words
              ELSE [words[j] FOR j IN range(1, len(words) + 1) IF NOT list_contains(cut, j)] END AS kept FROM r)
SELECT doc_id, n_words, n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM e
""",
    "op2_rotated_bits_ann": """
WITH v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0 AND len([x FOR x IN embedding IF x <> 0]) > 0),
s AS (
  SELECT q.vec_id AS query_id, v.vec_id, list_dot_product(q.e, v.e) AS score
  FROM v AS q JOIN v ON v.vec_id <> q.vec_id AND len(v.e) = len(q.e) WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 20
""",
    "op11_shared_term_search": r"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents),
q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark WHERE item_id IS NOT NULL),
s AS (SELECT count(*) AS N, sum(len(words))::BIGINT AS L FROM d WHERE len(words) > 0),
t AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(words) AS term FROM d) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * N + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM t, s GROUP BY term, N),
m AS (SELECT row, doc_id, 50 + (50 * len(words) * N) // L AS m FROM d, s WHERE doc_id IS NOT NULL AND len(words) > 0),
c AS (SELECT item_id, row, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
      FROM q JOIN t USING (term) JOIN w USING (term) JOIN m USING (row) GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM c WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM r WHERE rank <= 50
""",
    "op7_template_decontamination": r"""
WITH RECURSIVE d AS (
  SELECT doc_id, [x FOR x IN regexp_split_to_array(coalesce(text, ''), '[^\p{L}\p{N}]+') IF x <> ''] AS raw
  FROM documents WHERE doc_id IS NOT NULL),
b AS (
  SELECT item_id, [x FOR x IN regexp_split_to_array(coalesce(text, ''), '[^\p{L}\p{N}]+') IF x <> ''] AS raw
  FROM benchmark WHERE item_id IS NOT NULL),
df AS (SELECT *, TEMPLATE AS form FROM d),
bf AS (SELECT *, TEMPLATE AS form, least(13, len(raw)) AS length FROM b WHERE len(raw) >= 5),
bw AS (SELECT item_id, length, i AS at_, form[i:i + length - 1] AS win
       FROM (SELECT *, unnest(range(1, len(form) - length + 2)) AS i FROM bf)),
k AS (SELECT * FROM bw WHERE len([x FOR x IN win IF NOT starts_with(x, '<')]) >= 5),
dw AS (SELECT doc_id, length, pos, form[pos:pos + length - 1] AS win
       FROM (SELECT doc_id, form, length, unnest(range(1, len(form) - length + 2)) AS pos
             FROM df, (SELECT DISTINCT length FROM k) l WHERE len(form) >= length)),
f AS (SELECT doc_id, item_id, pos - at_ AS shift, count(DISTINCT at_) AS n_windows, min(at_) AS first, max(at_ + k.length - 1) AS last
      FROM dw JOIN k ON k.win = dw.win AND k.length = dw.length GROUP BY ALL),
z AS (SELECT f.*, [{'a': bf.form[i], 'o': lower(bf.raw[i]), 't': lower(df.raw[i + shift])}
                   FOR i IN range(first, last + 1) IF bf.form[i] = df.form[i + shift]] AS same
      FROM f JOIN df USING (doc_id) JOIN bf USING (item_id)),
s AS (SELECT *, [x FOR x IN same IF starts_with(x.a, '<')] AS slots FROM z WHERE len(same) >= 5),
c AS (SELECT doc_id, item_id, max({'n': n_windows, 'c': -len([x FOR x IN slots IF x.o <> x.t]), 's': len(slots)}) AS best FROM s
      WHERE len(list_distinct(slots)) = len(list_distinct([{'a': x.a, 'o': x.o} FOR x IN slots])) GROUP BY ALL)
SELECT doc_id, item_id, best.n AS n_windows, CAST(best.s AS INTEGER) AS n_slots, CAST(-best.c AS INTEGER) AS n_changed, best.c < 0 AS reparameterised FROM c
""".replace("TEMPLATE", """[CASE WHEN x >= '0' AND x < ':' THEN '<num>'
     WHEN lower(x) = x THEN CASE WHEN x IN (UNITS) THEN '<unit>' ELSE x END
     WHEN x[2:] <> '' AND lower(x[2:]) = x[2:] THEN '<name>' ELSE lower(x) END FOR x IN raw]""")
    .replace("UNITS", ", ".join(f"'{u}'" for u in decontaminate.UNITS)),
}
