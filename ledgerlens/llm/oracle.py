"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from ledgerlens.llm.quality import BASE_RULES, CAPITAL, RULES, SHORT_WORD, SMALL, STOP_WORDS

_WORDS = r"list_filter(regexp_split_to_array(coalesce({text}, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"


def _holds(rule) -> str:
    parts = [f"{rule.low} * {rule.whole} <= 100 * {rule.part}"] if rule.low is not None else []
    parts += [f"100 * {rule.part} <= {rule.high} * {rule.whole}"] if rule.high is not None else []
    return "(" + " AND ".join(parts) + ")"


_STOP_WORDS = ", ".join(f"'{w}'" for w in STOP_WORDS)

QUALITY = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, {_WORDS.format(text="text")} AS w FROM documents
), grams AS (
  SELECT r, i, list_slice(w, i, i + 2) AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM docs WHERE len(w) >= 3)
), twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM grams) WHERE n > 1
), repeats AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY r
), lined AS (
  SELECT r, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM docs
), counts AS (
  SELECT doc_id, 1 AS one, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
    greatest(len(list_filter(w, lambda x: lower(x) IN ({_STOP_WORDS}))),
      len(list_filter(w, lambda x: regexp_matches(x, '{SHORT_WORD}')))
      - len(list_distinct(list_filter(w, lambda x: regexp_matches(x, '{SHORT_WORD}'))))) AS n_function_words,
    len(list_filter(w, lambda x: regexp_matches(x, '{CAPITAL}') AND NOT regexp_matches(x, '{SMALL}') AND length(x) > 1)) AS n_shouted
  FROM docs JOIN lined USING (r) LEFT JOIN repeats USING (r)
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
  NOT ({" AND ".join(map(_holds, BASE_RULES))}) AS base_failed,
  ({" AND ".join(map(_holds, [*BASE_RULES, *RULES]))}) AS kept
FROM counts
"""

MIXING = rf"""
WITH sized AS (
  SELECT doc_id, source, len({_WORDS.format(text="text")})::BIGINT AS size FROM documents
), per_source AS (
  SELECT source, sum(size) AS source_size FROM sized GROUP BY source
), ranked AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM per_source
), weighted AS (
  SELECT *, [3, 1, 2][(place % 3) + 1] AS weight FROM ranked
), running AS (
  SELECT *, row_number() OVER o AS nth,
    coalesce(sum(source_size * 2) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_before,
    sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight_from,
    sum(source_size) OVER () * 150 / 100 AS total
  FROM weighted WINDOW o AS (ORDER BY source_size * 2 / weight, place)
), levels AS (
  SELECT *, (total - full_before) / weight_from AS level, (total - full_before) / weight_from * weight >= source_size * 2 AS is_full FROM running
), goal AS (
  SELECT source, source_size, CASE WHEN is_full THEN (source_size * 2)::DOUBLE
    ELSE (SELECT arg_min(level, nth) FROM levels WHERE NOT is_full) * weight END AS target FROM levels
), drawn AS (
  SELECT s.doc_id, s.size, s.source, g.source_size, g.target,
    floor(CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0 END) AS whole,
    CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0 END
      - floor(CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0 END) AS p,
    (('0x' || substr(md5(coalesce(s.doc_id::VARCHAR, '') || ':' || s.size), 1, 12))::BIGINT + 0.5::DOUBLE) / 281474976710656::DOUBLE AS u
  FROM sized s JOIN goal g ON s.source IS NOT DISTINCT FROM g.source
), placed AS (
  SELECT *, CASE WHEN p > 0 THEN u / (1 - u) / (p / (1 - p)) END AS rank FROM drawn
), ranks AS (
  SELECT source, rank, count(*) AS m, sum(size)::BIGINT AS words, max(target - whole * source_size) AS wanted FROM placed WHERE p > 0 GROUP BY source, rank
), summed AS (
  SELECT *, wanted - (sum(words) OVER (PARTITION BY source ORDER BY rank) - words) AS room FROM ranks
), shares AS (
  SELECT source, rank, CASE WHEN words = 0 THEN CASE WHEN room >= 0 THEN m ELSE 0 END ELSE least(m, floor(room / (words / m) + 0.5)) END AS n FROM summed
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY source, rank) AS k FROM placed
)
SELECT doc_id, size, source_size::BIGINT AS source_size, target,
  (size * (whole + CASE WHEN p > 0 AND k <= n THEN 1 ELSE 0 END))::BIGINT AS taken
FROM numbered t LEFT JOIN shares s ON t.source IS NOT DISTINCT FROM s.source AND t.rank = s.rank
"""

TOP_K = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), asked AS (
  SELECT DISTINCT vec_id, v FROM vectors WHERE vec_id % 20 = 0
), scored AS (
  SELECT q.vec_id AS query_id, q.v AS query, c.vec_id AS vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM asked q JOIN vectors c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id, query ORDER BY score DESC, vec_id)::INT AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""

SUBSTRINGS = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, {_WORDS.format(text="text")} AS w FROM documents
), windows AS (
  SELECT r, i, md5(array_to_string(list_slice(w, i, i + 34), ' ')) AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM docs WHERE len(w) >= 35)
), twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY g) AS n FROM windows) WHERE n > 1
), gone AS (
  SELECT DISTINCT r, p FROM (SELECT r, unnest(range(i, i + 35)) AS p FROM twice)
), placed AS (
  SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM docs
), kept AS (
  SELECT r, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n FROM placed ANTI JOIN gone USING (r, p) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (r)
"""

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

RANKED = f"""
WITH lowered AS (
  SELECT row_number() OVER () AS r, doc_id, {_LOWERED} AS t FROM documents
), terms AS (
  SELECT r, doc_id, unnest(regexp_extract_all(t, '{_TERM}')) AS term FROM lowered
), postings AS (
  SELECT r, doc_id, term, count(*) AS tf FROM terms GROUP BY ALL
), lengths AS (
  SELECT r, sum(tf)::BIGINT AS n FROM postings GROUP BY r
), total AS (
  SELECT count(*) AS nn, sum(n)::BIGINT AS ll FROM lengths
), weights AS (
  SELECT term, floor(1000 * ln((2 * nn + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM postings, total GROUP BY term, nn
), items AS (
  SELECT q, item_id, unnest(regexp_extract_all({_LOWERED}, '{_TERM}')) AS term
  FROM (SELECT row_number() OVER () AS q, item_id, text FROM (SELECT DISTINCT item_id, text FROM benchmark))
), asked AS (
  SELECT q, item_id, term, count(*) AS times FROM items GROUP BY ALL
), scored AS (
  SELECT q, item_id, r, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * nn) // ll))))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN postings USING (term) JOIN lengths USING (r), total GROUP BY ALL
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""


def _codes(rounds: int) -> str:
    """Codebooks round by round, each as a table of its own."""
    out = ["""WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST) AS r, vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pieces AS MATERIALIZED (
  SELECT r, p, list_slice(v, p * len(v) // 8 + 1, (p + 1) * len(v) // 8) AS x FROM kept, range(8) AS t(p)
), book0 AS MATERIALIZED (SELECT p, r - 1 AS e, x FROM pieces WHERE r <= 16)"""]
    near = """near{k} AS MATERIALIZED (
  SELECT r, p, min(struct_pack(d := list_dot_product(a.x, a.x) + list_dot_product(b.x, b.x) - 2 * list_dot_product(a.x, b.x), e := b.e)) AS best
  FROM pieces a JOIN book{k} b USING (p) GROUP BY r, p
)"""
    for k in range(rounds):
        out.append(near.format(k=k))
        out.append(f"""means{k} AS (
  SELECT p, e, list(m ORDER BY i) AS x FROM (
    SELECT p, best.e AS e, i, floor(sum(x[i]) / count(*)) AS m FROM near{k} JOIN pieces USING (r, p), unnest(range(1, len(x) + 1)) AS t(i) GROUP BY ALL
  ) GROUP BY p, e
), book{k + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(m.x, b.x) AS x FROM book{k} b LEFT JOIN means{k} m USING (p, e))""")
    out.append(near.format(k=rounds))
    return ",\n".join(out) + f"""
, digest AS (
  SELECT sha256(string_agg(array_to_string(list_transform(x, lambda c: c::BIGINT), ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{rounds}
), coded AS (
  SELECT r, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, sum(best.d)::BIGINT AS error FROM near{rounds} GROUP BY r
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN coded USING (r), digest"""


ORACLE = {
    "op2_substring_dedup": SUBSTRINGS,
    "op3_mixing": MIXING,
    "op5_quality_rules": QUALITY,
    "op8_exact_top_k": TOP_K,
    "op12_ranked_search": RANKED,
    "op13_orchard": _codes(6),
}
