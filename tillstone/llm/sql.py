"""SQL that gives the rows of the operators' queries, where SQL can."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_QUALITY = rf"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS words FROM documents
), spread AS (
  SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM w
), windows AS (
  SELECT doc_id, i, concat_ws(' ', word, lead(word, 1) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o, lead(word, 4) OVER o,
      lead(word, 5) OVER o, lead(word, 6) OVER o, lead(word, 7) OVER o) AS run,
    lead(i, 7) OVER o IS NOT NULL AS whole
  FROM spread WINDOW o AS (PARTITION BY doc_id ORDER BY i)
), twice AS (
  SELECT doc_id, i FROM windows WHERE whole QUALIFY count(*) OVER (PARTITION BY doc_id, run) > 1
), covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM twice, range(8) r(k) GROUP BY doc_id
), lines AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM w)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
), base AS (
  SELECT doc_id, text, words, len(words) AS n_words,
    length(array_to_string(words, '')) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM w LEFT JOIN covered USING (doc_id) LEFT JOIN lines USING (doc_id)
), judged AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM base
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT (base_failed
    OR n_symbols * 10 > n_words
    OR word_chars < 3 * n_words OR word_chars > 10 * n_words
    OR n_dup_lines * 2 > len(string_split(text, chr(10)))
    OR length(regexp_replace(text, '\P{{Lu}}', '', 'g')) * 10 > length(regexp_replace(text, '\P{{L}}', '', 'g')) * 3
    OR len(list_filter(words, lambda x: regexp_matches(x, '\p{{L}}'))) * 10 < n_words * 8
    OR len(list_filter(range(2, n_words + 1), lambda i: words[i] = words[i - 1])) * 5 > n_words) AS kept
FROM judged
"""

_MIXING = rf"""
WITH d AS (
  SELECT doc_id, source, len({_WORDS})::BIGINT AS size, md5(doc_id::VARCHAR) AS digest FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS cycle
  FROM d GROUP BY source
), r AS (
  SELECT *, CASE cycle WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight,
    3.0::DOUBLE * source_size AS room FROM s
), l AS (
  SELECT *, (sum(source_size) OVER ()
      - coalesce(sum(room) OVER (ORDER BY room / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE))
    / sum(weight) OVER (ORDER BY room / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM r
), t AS (
  SELECT source, source_size, cycle,
    least(room, coalesce(max(CASE WHEN level <= room / weight THEN level END) OVER (), 0.0::DOUBLE) * weight) AS target
  FROM l
), p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.cycle, round(t.target)::BIGINT AS due,
    (sum(size) OVER (PARTITION BY d.source ORDER BY digest ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS begin
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), c AS (
  SELECT *, CASE WHEN source_size > 0 THEN due // source_size ELSE 0 END AS whole FROM p
), e AS (
  SELECT *, greatest(0, least(size, due - whole * source_size - begin)) AS cut, begin::DOUBLE / due AS share FROM c
), f AS (
  SELECT *, 2.0 * share / (CASE cycle WHEN 0 THEN 1.5::DOUBLE + sqrt(2.25::DOUBLE - 2.0 * share)
    WHEN 1 THEN 2.0::DOUBLE ELSE 0.5::DOUBLE + sqrt(0.25::DOUBLE + 2.0 * share) END) AS position FROM e
)
SELECT doc_id, size, source_size, target, (whole * size + cut)::BIGINT AS taken,
  CASE WHEN size > 0 AND (whole > 0 OR cut > 0) THEN round(position, 6) END AS position
FROM f
"""



def _codes(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """All pairs of a part and an entry; doubles hold the integers exactly."""

    def nearest(number: int) -> str:
        """The parts with their nearest entry of the round's codebooks."""
        return f"""n{number} AS MATERIALIZED (
  SELECT row, part, any_value(x) AS x, min({{'far': list_inner_product(c, c) - 2 * list_inner_product(x, c), 'entry': entry}}) AS least
  FROM pieces JOIN book{number} USING (part) GROUP BY row, part
)"""

    def moved(number: int) -> str:
        return f"""book{number + 1} AS MATERIALIZED (
  SELECT part, entry, coalesce(m.c, b.c) AS c FROM book{number} b LEFT JOIN (
    SELECT part, entry, list(mean ORDER BY position) AS c FROM (
      SELECT part, least.entry AS entry, position, floor(sum(x[position]) / count(*)) AS mean
      FROM n{number}, (SELECT unnest(range(1, (SELECT max(len(x)) FROM pieces) + 1)) AS position) GROUP BY ALL
    ) GROUP BY part, entry
  ) m USING (part, entry)
)"""

    return f"""
WITH kept AS MATERIALIZED (
  SELECT *, row_number() OVER (ORDER BY vec_id NULLS LAST, v) AS row FROM (
    SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  )
), pieces AS MATERIALIZED (
  SELECT row, part, v[part * len(v) // {parts} + 1 : (part + 1) * len(v) // {parts}] AS x FROM kept, (SELECT unnest(range({parts})) AS part)
), book0 AS MATERIALIZED (
  SELECT part, row - 1 AS entry, x AS c FROM pieces WHERE row <= {entries}
), {", ".join(nearest(i) + ", " + moved(i) for i in range(rounds))}, {nearest(rounds)}, coded AS (
  SELECT row, string_agg(printf('%02x', least.entry), '' ORDER BY part) AS code,
    sum(least.far + list_inner_product(x, x))::BIGINT AS error
  FROM n{rounds} GROUP BY row
)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
  (SELECT sha256(string_agg(array_to_string(list_transform(c, lambda x: x::BIGINT), ','), ',' ORDER BY part, entry)) FROM book{rounds}) AS codebooks_sha256
FROM kept JOIN coded USING (row)
"""


SQL: dict[str, str] = {"op2_quality": _QUALITY, "op5_mixing": _MIXING, "op13_codes": _codes()}
