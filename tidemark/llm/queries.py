"""The queries of the corpus operators, one for each, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.bpe import op4_bpe
from tidemark.llm.common import table
from tidemark.llm.hamming_index import op11_hamming_index
from tidemark.llm.link_graph import op10_link_graph
from tidemark.llm.lm_score import op5_lm_score
from tidemark.llm.minhash import op7_minhash
from tidemark.llm.packing import op9_packing
from tidemark.llm.pii_crf import op1_pii
from tidemark.llm.quality_gam import op8_quality_gam
from tidemark.llm.quality_rules import op6_quality_rules
from tidemark.llm.spelling import op13_spelling
from tidemark.llm.suffix_dedup import op3_suffix_dedup
from tidemark.llm.token_links import op12_token_links
from tidemark.llm.winnowing import op2_winnowing


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    on = lambda f, name: lambda spark, sf_dir: f(table(spark, sf_dir, name))
    return {
        "op1_pii": on(op1_pii, "documents"),
        "op2_winnowing": on(op2_winnowing, "documents"),
        "op3_suffix_dedup": on(op3_suffix_dedup, "documents"),
        "op4_bpe": on(op4_bpe, "documents"),
        "op5_lm_score": on(op5_lm_score, "documents"),
        "op6_quality_rules": on(op6_quality_rules, "documents"),
        "op7_minhash": on(op7_minhash, "documents"),
        "op8_quality_gam": lambda spark, sf_dir: op8_quality_gam(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")),
        "op9_packing": on(op9_packing, "documents"),
        "op10_link_graph": on(op10_link_graph, "pages"),
        "op11_hamming_index": on(op11_hamming_index, "embeddings"),
        "op12_token_links": on(op12_token_links, "documents"),
        "op13_spelling": on(op13_spelling, "documents"),
    }


OP6_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
m AS (SELECT doc_id, words, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
             len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(lines)::BIGINT AS n_lines,
             (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines FROM w),
t AS (SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS tri
      FROM (SELECT doc_id, words, unnest(range(1, n_words - 1)) AS i FROM m)),
c AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, tri) AS n FROM t),
p AS (SELECT doc_id, count(DISTINCT j)::BIGINT AS n_repeat_words FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM c WHERE n > 1) GROUP BY doc_id),
a AS (SELECT m.doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words FROM m LEFT JOIN p USING (doc_id)),
b AS (SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
        + CASE WHEN 100 * n_symbols > 40 * n_words THEN 4 ELSE 0 END + CASE WHEN 100 * n_dup_lines > 40 * n_lines THEN 8 ELSE 0 END
        + CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END + CASE WHEN word_chars > 20 * n_words THEN 32 ELSE 0 END)::BIGINT AS fail_bits FROM a)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (fail_bits & 3) <> 0 AS base_failed, fail_bits = 0 AS kept, fail_bits FROM b
"""


OP5_SQL = r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
t AS (SELECT doc_id, i, w[i] AS a, CASE WHEN i > 1 THEN w[i - 1] || ' ' || w[i] END AS b, CASE WHEN i > 2 THEN w[i - 2] || ' ' || w[i - 1] || ' ' || w[i] END AS c,
             CASE WHEN i > 1 THEN w[i - 1] END AS ca, CASE WHEN i > 2 THEN w[i - 2] || ' ' || w[i - 1] END AS cb FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d)),
n1 AS (SELECT a, count(*) AS n FROM t GROUP BY 1), n2 AS (SELECT b, count(*) AS n FROM t WHERE b IS NOT NULL GROUP BY 1), n3 AS (SELECT c, count(*) AS n FROM t WHERE c IS NOT NULL GROUP BY 1),
s AS (SELECT doc_id, CASE WHEN n3.n >= 2 THEN 3 WHEN n2.n >= 2 THEN 2 ELSE 1 END AS l, least(i, 3) AS top,
             CASE WHEN n3.n >= 2 THEN ln(n3.n) - ln(k2.n) WHEN n2.n >= 2 THEN ln(n2.n) - ln(k1.n) ELSE ln(n1.n) - ln((SELECT count(*) FROM t)) END AS v
      FROM t JOIN n1 USING (a) LEFT JOIN n2 ON t.b = n2.b LEFT JOIN n3 ON t.c = n3.c LEFT JOIN n1 k1 ON t.ca = k1.a LEFT JOIN n2 k2 ON t.cb = k2.b),
g AS (SELECT doc_id, count(*) AS n, count(*) FILTER (WHERE l = 1) AS l1, count(*) FILTER (WHERE l = 2) AS l2, count(*) FILTER (WHERE l = 3) AS l3, sum(v + ln(0.4) * (top - l)) AS v FROM s GROUP BY 1)
SELECT d.doc_id, coalesce(n, 0) AS n_words, coalesce(l1, 0) AS level_1, coalesce(l2, 0) AS level_2, coalesce(l3, 0) AS level_3, round(v / n, 6) AS score FROM d LEFT JOIN g USING (doc_id)
"""


def oracle_sql() -> dict[str, str]:
    return {"op5_lm_score": OP5_SQL, "op6_quality_rules": OP6_SQL}
