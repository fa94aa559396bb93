"""The operators that SQL can express, in SQL for DuckDB."""

SQL: dict[str, str] = {}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL["op11_divergence"] = f"""
WITH d AS (
  SELECT row_number() OVER () AS k, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents
), w AS (
  SELECT k, lang, source, {_LOWER.format("unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+'))")} AS term FROM d
), kept AS (
  SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT k) >= 30
), c AS (
  SELECT lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY ALL
), g AS (
  SELECT d.lang, d.source, (SELECT coalesce(sum(n), 0) FROM c WHERE c.lang = d.lang AND c.source = d.source) AS total,
    (SELECT count(*) FROM kept WHERE kept.lang = d.lang) AS v
  FROM (SELECT DISTINCT lang, source FROM d) AS d
), p AS (
  SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n,
    (1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (g.total + 5 * g.v))::BIGINT AS p
  FROM g JOIN kept USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term
), q AS (
  SELECT lang, term, (1 + (1000000000::HUGEINT * (sum(n) + 5)) // (SELECT sum(total) + 5 * max(v) FROM g WHERE g.lang = p.lang))::BIGINT AS q
  FROM p GROUP BY lang, term
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0) AS value
  FROM g AS a JOIN g AS b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (
    SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value
    FROM p AS x JOIN p AS y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL
  ) AS s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
), above AS (
  SELECT p.lang, p.source, p.term AS item, p.p - q.q AS value FROM p JOIN q USING (lang, term) WHERE p.n > 0 AND p.p > q.q
)
SELECT lang, source, 'pair' AS part, item, value::BIGINT AS value,
  (row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item))::INTEGER AS rank FROM pairs
UNION ALL
SELECT lang, source, 'term', item, value, rank FROM (
  SELECT *, (row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item))::INTEGER AS rank FROM above
) WHERE rank <= 50
"""

_TERMS = _LOWER.format("unnest(regexp_extract_all(coalesce(text, ''), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'))")

SQL["op12_lexical"] = f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, text FROM documents),
b AS (SELECT row_number() OVER () AS i, item_id, text FROM benchmark),
w AS (SELECT k, {_TERMS} AS term FROM d),
asked AS (SELECT i, term, count(*) AS repeats FROM (SELECT i, {_TERMS} AS term FROM b) GROUP BY ALL),
held AS (SELECT k, term, count(*) AS tf FROM w WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
sizes AS (SELECT k, count(*) AS n FROM w GROUP BY k),
whole AS (SELECT count(*) AS docs, sum(n) AS terms FROM sizes),
weights AS (SELECT term, floor(1000 * ln((2 * (SELECT docs FROM whole) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM held GROUP BY term),
parts AS (
  SELECT k, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // terms)))::BIGINT AS part
  FROM held JOIN weights USING (term) JOIN sizes USING (k), whole
),
scores AS (SELECT i, k, sum(repeats * part) AS score FROM asked JOIN parts USING (term) GROUP BY i, k HAVING sum(repeats * part) > 0)
SELECT item_id, rank, doc_id, score::BIGINT AS score FROM (
  SELECT item_id, doc_id, score, (row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST))::INTEGER AS rank
  FROM scores JOIN d USING (k) JOIN b USING (i)
) WHERE rank <= 10
"""


def _duplicated(n: int) -> str:
    """Words in windows of ``n`` words that a text holds twice: a sum of characters and a count by text."""
    window = ", ".join(f"lead(word, {j}) OVER t" for j in range(n))
    reach = f"max(twice) OVER (PARTITION BY k ORDER BY i ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"""
  SELECT k, sum(length(word)) FILTER (covered) AS chars, count(*) FILTER (covered) AS words FROM (
    SELECT k, word, {reach} AS covered FROM (
      SELECT k, i, word, lead(i, {n - 1}) OVER (PARTITION BY k ORDER BY i) IS NOT NULL AND count(*) OVER (PARTITION BY k, gram) > 1 AS twice
      FROM (SELECT k, i, word, [{window}] AS gram FROM w WINDOW t AS (PARTITION BY k ORDER BY i))
    )
  ) GROUP BY k"""


def repetition_sql(ngrams: dict[int, int], lines: int, line_chars: int, symbols: int) -> str:
    white = "'[^\\x20\\x09-\\x0D]+'"
    parts = "".join(f", r{n} AS ({_duplicated(n)})" for n in (3, *ngrams))
    joins = " ".join(f"LEFT JOIN r{n} USING (k)" for n in (3, *ngrams))
    chars = ", ".join(f"coalesce(r{n}.chars, 0)::BIGINT AS dup_{n}gram_chars" for n in ngrams)
    over = " OR ".join(f"100 * dup_{n}gram_chars > {percent} * word_chars" for n, percent in ngrams.items())
    return f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT k, unnest(range(len(words))) AS i, unnest(words) AS word FROM (SELECT k, regexp_extract_all(text, {white}) AS words FROM d)),
lines AS (
  SELECT k, sum(n) AS n_lines, sum(n - 1) AS n_dup_lines, sum((n - 1) * length(regexp_replace(line, '[\\x20\\x09-\\x0D]+', '', 'g'))) AS dup_line_chars
  FROM (SELECT k, line, count(*) AS n FROM (SELECT k, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, {white}) GROUP BY ALL) GROUP BY k
),
sizes AS (SELECT k, count(*) AS n_words, sum(length(word)) AS word_chars FROM w GROUP BY k){parts},
found AS (
  SELECT doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
    coalesce(r3.words, 0)::BIGINT AS n_repeat_words, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(dup_line_chars, 0)::BIGINT AS dup_line_chars, {chars}
  FROM d LEFT JOIN sizes USING (k) LEFT JOIN lines USING (k) {joins}
), judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM found)
SELECT *, NOT base_failed AND NOT (100 * n_symbols > {symbols} * word_chars OR 100 * n_dup_lines > {lines} * n_lines
  OR 100 * dup_line_chars > {line_chars} * word_chars OR {over}) AS kept FROM judged
"""
