"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import common


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import simhash
    return simhash.near_duplicates(common.table(spark, sf_dir, "documents"), shingle=4, distance=4)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import quality
    out = quality.classify(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))
    return out.select("doc_id", "lang", "perplexity", "threshold", "keep")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import linededup
    return linededup.clean(common.table(spark, sf_dir, "documents")).select("doc_id", "source", "text", "n_lines", "n_dropped")


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import licenses
    return licenses.scan(common.table(spark, sf_dir, "documents"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import secrets
    return secrets.scan(common.table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import toxicity
    return toxicity.classify(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import decontam
    return decontam.flags(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import topk
    return topk.top_k(common.table(spark, sf_dir, "embeddings"))


def op9_maxent(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import maxent
    return maxent.log_probability(common.table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from . import packing
    return packing.pack(common.table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import collocations
    return collocations.mine(common.table(spark, sf_dir, "documents"))


def op12_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import ruleledger
    return ruleledger.judge(common.table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import whitening
    return whitening.whiten(common.table(spark, sf_dir, "embeddings"))


QUERIES = {"op1_simhash": op1_simhash, "op2_quality": op2_quality, "op3_line_dedup": op3_line_dedup,
           "op4_licenses": op4_licenses, "op5_secrets": op5_secrets, "op6_toxicity": op6_toxicity,
           "op7_decontamination": op7_decontamination, "op8_topk": op8_topk, "op9_maxent": op9_maxent, "op10_packing": op10_packing,
           "op11_collocations": op11_collocations, "op12_rules": op12_rules, "op13_whitening": op13_whitening}

_TOKENS = "list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda w: w <> '')"

ORACLE_SQL: dict[str, str] = {
    "op3_line_dedup": """
WITH t AS (SELECT DISTINCT source, text FROM documents), p AS (SELECT source, count(*) AS pages FROM t GROUP BY source),
w AS (SELECT source, text, trim(unnest(string_split(text, chr(10)))) AS line FROM t),
b AS (SELECT w.source, line FROM w JOIN p ON w.source IS NOT DISTINCT FROM p.source WHERE line <> ''
      GROUP BY w.source, line, pages HAVING count(DISTINCT text) >= 5 AND count(DISTINCT text) > 0.1 * pages),
d AS (SELECT row_number() OVER () AS id, doc_id, source, text FROM documents),
l AS (SELECT id, doc_id, source, generate_subscripts(string_split(text, chr(10)), 1) AS i, unnest(string_split(text, chr(10))) AS line FROM d),
k AS (SELECT l.*, b.line IS NULL AS keep FROM l LEFT JOIN b ON b.source IS NOT DISTINCT FROM l.source AND b.line = trim(l.line)),
r AS (SELECT id, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (keep), '') AS text, count(*) AS n_lines,
             count(*) FILTER (NOT keep) AS n_dropped FROM k GROUP BY id)
SELECT doc_id, source, r.text, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped FROM d LEFT JOIN r USING (id)""",
    "op7_decontamination": f"""
WITH d AS (SELECT doc_id, {_TOKENS} AS w FROM documents), b AS (SELECT item_id, {_TOKENS} AS w FROM benchmark),
dp AS (SELECT doc_id, p, w FROM (SELECT doc_id, w, unnest(generate_series(1, len(w))) AS p FROM d WHERE doc_id IS NOT NULL)),
bp AS (SELECT item_id, w[p:p + 12] AS w FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 12))) AS p FROM b WHERE item_id IS NOT NULL AND len(w) > 0)),
-- of thirteen tokens with two substitutions, one of three blocks is whole; shorter items match whole
dk AS (SELECT doc_id, p - o.o AS p, o.o, array_to_string(w[p:p + o.n - 1], ' ') AS k FROM dp, (VALUES (0, 4), (4, 4), (8, 5)) AS o(o, n) WHERE len(w) >= p + o.n - 1 AND p > o.o),
bk AS (SELECT item_id, w, o.o, array_to_string(w[o.o + 1:o.o + o.n], ' ') AS k FROM bp, (VALUES (0, 4), (4, 4), (8, 5)) AS o(o, n) WHERE len(w) = 13),
h AS (SELECT DISTINCT dk.doc_id, item_id, dk.p, bk.w AS bw FROM dk JOIN bk ON dk.o = bk.o AND dk.k = bk.k),
s AS (SELECT h.doc_id, item_id, len(list_filter(range(1, 14), lambda i: bw[i] IS DISTINCT FROM d.w[p + i - 1])) AS subst
      FROM h JOIN d ON d.doc_id = h.doc_id WHERE len(d.w) >= p + 12),
x AS (SELECT DISTINCT item_id, len(w) AS n, array_to_string(w, ' ') AS k FROM bp WHERE len(w) < 13),
f AS (SELECT doc_id, item_id FROM s WHERE subst <= 2
      UNION SELECT doc_id, item_id FROM d, x WHERE doc_id IS NOT NULL AND contains(' ' || array_to_string(d.w, ' ') || ' ', ' ' || x.k || ' ')),
c AS (SELECT doc_id, count(*) AS n FROM f GROUP BY doc_id)
SELECT doc_id, n IS NOT NULL AS contaminated, coalesce(n, 0) AS n_items
FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL) LEFT JOIN c USING (doc_id)""",
    "op8_topk": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda c: floor(64 * c::DOUBLE)::BIGINT) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id,
             list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
      FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v) WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 20
""",
    "op11_collocations": r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS d,
                  string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS pieces FROM documents),
q AS (SELECT lang, regexp_extract_all(unnest(pieces), '[^\x20\x09]+') AS w FROM p),
g AS (SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase
      FROM (SELECT lang, w, m, unnest(generate_series(1, len(w) - m + 1)) AS i FROM q, (VALUES (1), (2), (3)) AS o(m))),
f AS (SELECT lang, phrase, any_value(m) AS m, count(*) AS f FROM g GROUP BY lang, phrase),
t AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE m = 1 GROUP BY lang),
e AS MATERIALIZED (SELECT lang, phrase, m, f, string_split(phrase, ' ') AS w FROM f WHERE f >= 10),
c AS (SELECT lang, phrase, m, f AS a, w, unnest(generate_series(1, m - 1)) AS k FROM e WHERE m >= 2),
x AS MATERIALIZED (SELECT c.*, e.f AS l FROM c JOIN e ON e.lang = c.lang AND e.phrase = array_to_string(c.w[1:k], ' ')),
s AS (SELECT x.*, e.f AS r, (1000000::HUGEINT * a * a) // (l::HUGEINT * e.f) AS score
      FROM x JOIN e ON e.lang = x.lang AND e.phrase = array_to_string(x.w[k + 1:], ' ')),
b AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS cut FROM s),
z AS (SELECT DISTINCT b.lang, b.phrase FROM b JOIN (SELECT lang, a, array_to_string(w[1:2], ' ') AS inside FROM b WHERE m = 3 AND cut = 1
      UNION ALL SELECT lang, a, array_to_string(w[2:3], ' ') FROM b WHERE m = 3 AND cut = 1) AS u
      ON u.lang = b.lang AND u.inside = b.phrase AND 100 * u.a >= 50 * b.a),
o AS (SELECT b.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
      FROM b ANTI JOIN z USING (lang, phrase) WHERE cut = 1)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM o JOIN t USING (lang) WHERE rank <= 2000""",
    "op12_rules": r"""
WITH d AS (SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT id, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
v AS (SELECT id, i, array_to_string(w[i:i + 7], ' ') AS v FROM (SELECT id, w, unnest(generate_series(1, len(w) - 7)) AS i FROM w)),
h AS (SELECT id, i FROM (SELECT id, i, count(*) OVER (PARTITION BY id, v) AS c FROM v) WHERE c > 1),
e AS (SELECT id, count(DISTINCT i + j)::BIGINT AS n_repeat_words FROM h, (SELECT unnest(generate_series(0, 7)) AS j) GROUP BY id),
u AS (SELECT id, max(c) AS top_word FROM (SELECT id, x, count(*) AS c FROM (SELECT id, unnest(w) AS x FROM w) GROUP BY id, x) GROUP BY id),
m AS (SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
             coalesce(n_repeat_words, 0) AS n_repeat_words, len(l)::BIGINT AS n_lines,
             len(list_filter(w, lambda x: regexp_matches(x, '[A-Za-z\x{80}-\x{10FFFF}]')))::BIGINT AS n_letter_words,
             len(list_filter(l, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•]')))::BIGINT AS n_bullet_lines,
             len(list_filter(l, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$')))::BIGINT AS n_ellipsis_lines,
             coalesce(top_word, 0) AS top_word,
             len(list_filter(generate_series(2, len(w)), lambda i: w[i] = w[i - 1]))::BIGINT AS n_stutters
      FROM w LEFT JOIN e USING (id) LEFT JOIN u USING (id)),
b AS (SELECT *, n_words < 20 AS r0, 100 * n_repeat_words > 30 * n_words AS r1, word_chars < 3 * n_words AS r2, word_chars > 10 * n_words AS r3,
             10 * n_symbols > n_words AS r4, n_dup_lines >= 3 AND 100 * n_dup_lines > 30 * n_lines AS r5, 100 * n_letter_words < 80 * n_words AS r6,
             100 * n_bullet_lines > 90 * n_lines AS r7, 100 * n_ellipsis_lines > 30 * n_lines AS r8, 100 * top_word > 30 * n_words AS r9,
             100 * n_stutters > 20 * n_words AS r10 FROM m),
f AS (SELECT *, r0::INT + r1::INT + r2::INT + r3::INT + r4::INT + r5::INT + r6::INT + r7::INT + r8::INT + r9::INT + r10::INT AS fails,
             (r0::INT + 2 * r1::INT + 4 * r2::INT + 8 * r3::INT + 16 * r4::INT + 32 * r5::INT + 64 * r6::INT + 128 * r7::INT
              + 256 * r8::INT + 512 * r9::INT + 1024 * r10::INT)::BIGINT AS fail_bits FROM b),
g AS (SELECT *, CASE WHEN fails <> 1 THEN 'none' WHEN r0 THEN 'few_words' WHEN r1 THEN 'repeated_windows' WHEN r2 THEN 'short_words'
             WHEN r3 THEN 'long_words' WHEN r4 THEN 'symbols' WHEN r5 THEN 'repeated_lines' WHEN r6 THEN 'few_letters' WHEN r7 THEN 'bullets'
             WHEN r8 THEN 'ellipses' WHEN r9 THEN 'top_word' ELSE 'stutters' END AS sole_rule FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_letter_words, n_bullet_lines, n_ellipsis_lines, top_word,
       n_stutters, fail_bits, r0 OR r1 AS base_failed, fails = 0 AS kept, sole_rule,
       CASE WHEN sole_rule = 'none' THEN 0 ELSE count(*) FILTER (fails = 0) OVER () + count(*) OVER (PARTITION BY sole_rule) END AS n_kept_without_sole
FROM g""",
}
