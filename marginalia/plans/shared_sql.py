"""Common table expressions of the DuckDB twins."""

LINES = """lines AS (SELECT doc_id, source, lang, pos - 1 AS pos, line FROM (
  SELECT doc_id, source, lang, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents))"""

_TOKEN = r"\p{L}+(?:[''’-]\p{L}+)*"

TOKENS = (
    LINES
    + f""", tokens AS (SELECT doc_id, source, lang, pos, idx - 1 AS idx, form, lower(form) AS term FROM (
  SELECT doc_id, source, lang, pos, unnest(regexp_extract_all(line, '{_TOKEN}')) AS form,
         generate_subscripts(regexp_extract_all(line, '{_TOKEN}'), 1) AS idx FROM lines))"""
)

STATS = (
    TOKENS
    + """, stats AS (SELECT term, count(*) AS count, count(DISTINCT source) AS chapter_df, count(DISTINCT doc_id) AS page_df,
  count(DISTINCT (doc_id, pos)) AS block_df FROM tokens GROUP BY term)"""
)

SPANS = (
    LINES
    + """, spans AS (SELECT doc_id, pos, line, coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY pos
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM lines)"""
)

TURNS = """turns AS (SELECT conv_id, turn, source, target FROM (SELECT conv_id, turn, role, text AS source,
  lead(role) OVER w AS nr, lead(text) OVER w AS target FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
  WHERE role = 'user' AND nr = 'assistant')"""

#: Pairs at edit distance one, swaps included: the deletion neighbourhood.
NEAR = """dels AS (SELECT term, count, unnest(list_concat([term], list_transform(range(1, length(term) + 1),
  lambda i: substr(term, 1, i - 1) || substr(term, i + 1)))) AS form FROM pool),
met AS (SELECT DISTINCT a.term, b.term AS suggestion, b.count AS suggestion_count FROM dels a JOIN dels b ON a.form = b.form AND a.term <> b.term),
marked AS (SELECT *, list_filter(range(1, greatest(length(term), 1) + 1), lambda i: substr(term, i, 1) <> substr(suggestion, i, 1)) AS d FROM met),
near AS (SELECT term, suggestion, suggestion_count FROM marked WHERE
  (length(term) = length(suggestion) AND len(d) = 1)
  OR (abs(length(term) - length(suggestion)) = 1)
  OR (length(term) = length(suggestion) AND len(d) = 2 AND d[2] = d[1] + 1 AND substr(term, d[1], 1) = substr(suggestion, d[2], 1)
      AND substr(term, d[2], 1) = substr(suggestion, d[1], 1)))"""
