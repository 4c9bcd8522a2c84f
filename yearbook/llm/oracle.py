"""SQL for the operators that SQL can express, for DuckDB."""

from __future__ import annotations

from yearbook.llm import urls
from yearbook.llm.quality import LINE_SHARE, MIN_WORDS, NGRAM_SHARES, SYMBOL_SHARE

_SPACE = r"[ \t\n\x0B\x0C\r]"
_DOCS = f"""docs AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents
), listed AS (
  SELECT row, doc_id, list_filter(regexp_split_to_array({{text}}, '{_SPACE}+'), lambda w: w <> '') AS words FROM docs
)"""
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _run(n: int, word: str = "word", window: str = "w") -> str:
    """The next ``n`` words as one text; null near the end."""
    return " || ' ' || ".join([word, *(f"lead({word}, {k}) OVER {window}" for k in range(1, n))])


def _quality() -> str:
    lengths = tuple(NGRAM_SHARES)
    runs = ", ".join(f"{_run(n)} AS run{n}" for n in (3, *lengths))
    later = ", ".join(f"run{n} IS NOT NULL AND row_number() OVER (PARTITION BY row, run{n} ORDER BY i) > 1 AS hit{n}" for n in lengths)
    inside = ", ".join(f"bool_or(hit{n}) OVER (PARTITION BY row ORDER BY i ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS in{n}" for n in (3, *lengths))
    chars = ", ".join(f"coalesce(sum(length(word)) FILTER (in{n}), 0)::BIGINT AS dup_{n}gram_chars" for n in lengths)
    names = ", ".join(f"coalesce(dup_{n}gram_chars, 0) AS dup_{n}gram_chars" for n in lengths)
    repeats = " OR ".join([f"dup_line_chars > {LINE_SHARE} * most", f"n_symbols > {SYMBOL_SHARE} * n_words", *(f"dup_{n}gram_chars > {s} * most" for n, s in NGRAM_SHARES.items())])
    return f"""WITH {_DOCS.format(text='text')}, each AS (
  SELECT row, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM listed
), runs AS (
  SELECT row, i, word, {runs} FROM each WINDOW w AS (PARTITION BY row ORDER BY i)
), hits AS (
  SELECT row, i, word, run3 IS NOT NULL AND count(*) OVER (PARTITION BY row, run3) > 1 AS hit3, {later} FROM runs
), covered AS (
  SELECT row, word, {inside} FROM hits
), counted AS (
  SELECT row, count(*) AS n_words, sum(length(word))::BIGINT AS word_chars, count(*) FILTER (in3) AS n_repeat_words, {chars}
  FROM covered GROUP BY row
), lines AS (
  SELECT row, line, row_number() OVER (PARTITION BY row, line ORDER BY i) AS nth
  FROM (SELECT row, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM docs)
  WHERE regexp_matches(line, '[^ \\t\\n\\x0B\\x0C\\r]')
), dup AS (
  SELECT row, count(*) AS n_dup_lines, sum(length(regexp_replace(line, '{_SPACE}', '', 'g')))::BIGINT AS dup_line_chars
  FROM lines WHERE nth > 1 GROUP BY row
), measured AS (
  SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
    length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(dup_line_chars, 0) AS dup_line_chars, {names},
    greatest(coalesce(word_chars, 0), 1) AS most
  FROM docs LEFT JOIN counted USING (row) LEFT JOIN dup USING (row)
), failed AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured
)
SELECT * EXCLUDE (most), NOT base_failed AND NOT ({repeats}) AS kept FROM failed"""


def _shingles(source: str) -> str:
    """CTEs ``(row, shingle)`` of ``source (row, words)``: distinct runs of five words, or
    all words of a shorter list."""
    return f"""SELECT DISTINCT row, shingle FROM (
    SELECT row, {_run(5)} AS shingle FROM (SELECT row, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM {source} WHERE len(words) >= 5)
    WINDOW w AS (PARTITION BY row ORDER BY i)
    UNION ALL SELECT row, array_to_string(words, ' ') FROM {source} WHERE len(words) BETWEEN 1 AND 4
  ) WHERE shingle IS NOT NULL"""


_JACCARD = f"""WITH RECURSIVE {_DOCS.format(text=_LOWER)}, sets AS (
  {_shingles('listed')}
), sizes AS (
  SELECT row, count(*) AS n FROM sets GROUP BY row
), shared AS (
  SELECT a.row AS a, b.row AS b, count(*) AS common FROM sets a JOIN sets b USING (shingle) WHERE a.row < b.row GROUP BY ALL
), edges AS (
  SELECT a, b FROM shared JOIN sizes x ON x.row = a JOIN sizes y ON y.row = b WHERE 100 * common >= 80 * (x.n + y.n - common)
), sides AS (
  SELECT a, b FROM edges UNION ALL SELECT b, a FROM edges
), reach(row, other) AS (
  SELECT row, row FROM docs UNION SELECT reach.row, sides.b FROM reach JOIN sides ON sides.a = reach.other
)
SELECT docs.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(o.doc_id) AS component_id
FROM docs JOIN reach USING (row) JOIN docs o ON o.row = reach.other LEFT JOIN sizes ON sizes.row = docs.row
GROUP BY docs.row, docs.doc_id"""

# Items of fewer than five words, looked for as runs of that many words.
_LEAKS = f"""WITH {_DOCS.format(text=_LOWER)}, given AS (
  SELECT item_id, list_filter(regexp_split_to_array({_LOWER}, '{_SPACE}+'), lambda w: w <> '') AS words FROM benchmark WHERE text IS NOT NULL
), items AS (
  SELECT DISTINCT item_id, words, least(len(words), 5) AS size FROM given WHERE len(words) > 0
), numbered AS (
  SELECT row_number() OVER () AS row, * FROM items
), wanted AS (
  {_shingles('numbered')}
), runs AS (
  SELECT row, {", ".join(f"{_run(n)} AS run{n}" for n in range(1, 6))}
  FROM (SELECT row, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM listed) WINDOW w AS (PARTITION BY row ORDER BY i)
), held AS (
  SELECT DISTINCT row, n, shingle FROM (
    {" UNION ALL ".join(f"SELECT row, {n} AS n, run{n} AS shingle FROM runs" for n in range(1, 6))}
  ) WHERE shingle IN (SELECT shingle FROM wanted)
), sizes AS (
  SELECT row, count(*) AS n_item FROM wanted GROUP BY row
), hits AS (
  SELECT held.row AS doc, wanted.row AS item, count(*) AS n_shared
  FROM held JOIN wanted USING (shingle) JOIN numbered ON numbered.row = wanted.row AND numbered.size = held.n GROUP BY ALL
)
SELECT doc_id, item_id, n_shared, n_item, n_shared / n_item AS containment
FROM hits JOIN sizes ON sizes.row = item JOIN numbered ON numbered.row = item JOIN docs ON docs.row = doc
WHERE 100 * n_shared >= 80 * n_item"""



def _url_level(d: int) -> str:
    """CTEs that grow the templates by the segment at level ``d`` (from 0)."""

    def differ(a: str, of_a: str, b: str, of_b: str) -> str:
        na, nb = f"greatest({of_a}, 1)", f"greatest({of_b}, 1)"
        return f"abs({a} / {na} - ({b}) / {nb}) > {urls.BOUND} * (1 / sqrt({na}) + 1 / sqrt({nb}))"

    apart = f"{differ('b', 'l', 'bb - b', 'll - l')} OR {differ('e', 'n', 'ee - e', 'nn - n')}"
    return f"""children{d} AS (
  SELECT host, template, parts[{d + 1}] AS part, sum(n)::BIGINT AS n, sum(l)::BIGINT AS l, sum(b)::BIGINT AS b, coalesce(sum(n) FILTER (len(parts) = {d + 1}), 0)::BIGINT AS e
  FROM tree{d} WHERE len(parts) > {d} GROUP BY ALL
), beside{d} AS (
  SELECT *, count(*) OVER w AS k, (sum(n) OVER w)::BIGINT AS nn, (sum(l) OVER w)::BIGINT AS ll, (sum(b) OVER w)::BIGINT AS bb, (sum(e) OVER w)::BIGINT AS ee
  FROM children{d} WINDOW w AS (PARTITION BY host, template)
), named{d} AS (
  SELECT host, template, part, CASE WHEN (k > {urls.FANOUT} AND n * {urls.FANOUT} < nn) OR (l > 0 AND ll > l AND NOT ({apart})) THEN '?' ELSE part END AS name FROM beside{d}
), tree{d + 1} AS (
  SELECT t.host, shape, parts, n, l, b, t.template || coalesce('/' || name, '') AS template
  FROM tree{d} t LEFT JOIN named{d} c ON t.host = c.host AND t.template = c.template AND t.parts[{d + 1}] = c.part
)"""


def _url_filters(rules: list[tuple[str, str, str]]) -> str:
    def pick(field: str) -> str:
        whens = "".join(
            f" WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{v if field == 'verdict' else h + p}'"
            for v, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1])))
        )
        return f"CASE{whens} END"

    n, m = urls.DEPTH, urls.WEIGHT
    return f"""WITH rests AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), hosts AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^([^/?#]*)([^?#]*)', 2) AS path FROM rests
), ruled AS (
  SELECT *, regexp_replace(path, '[0-9]+', '#', 'g') AS shape, {pick('rule')} AS rule, {pick('verdict')} AS ruled FROM hosts
), counted AS (
  SELECT host, shape, count(*) AS n, count(ruled) AS l, count(*) FILTER (ruled = 'block') AS b,
    CASE WHEN shape = '' THEN [] ELSE string_split(substr(shape, 2), '/') END AS all_parts FROM ruled GROUP BY host, shape
), tree0 AS (
  SELECT host, shape, n, l, b, '' AS template,
    CASE WHEN len(all_parts) <= {n} THEN all_parts ELSE list_append(all_parts[1:{n - 1}], array_to_string(all_parts[{n}:], '/')) END AS parts FROM counted
), {", ".join(_url_level(d) for d in range(n))}, shares AS (
  SELECT coalesce(sum(b)::BIGINT / nullif(sum(l)::BIGINT, 0), 0) AS share FROM counted
), shapes AS (
  SELECT shape, sum(l)::BIGINT AS sl, sum(b)::BIGINT AS sb FROM counted GROUP BY shape
), pure AS (
  SELECT host, template, (sum(b)::BIGINT + {m} * ((sum(sb)::BIGINT + {m} * any_value(share)) / (sum(sl)::BIGINT + {m}))) / (sum(l)::BIGINT + {m}) AS purity
  FROM tree{n} JOIN shapes USING (shape), shares GROUP BY host, template
)
SELECT page_id, host, path, rule, coalesce(ruled, CASE WHEN purity >= {urls.REJECT} THEN 'block' ELSE 'allow' END) AS verdict, template, purity
FROM ruled JOIN tree{n} USING (host, shape) JOIN pure USING (host, template)"""


# The registered query's rules: fixed values.
_URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]

ORACLE_SQL: dict[str, str] = {
    "op5_quality": _quality(),
    "op8_jaccard_join": _JACCARD,
    "op10_decontamination": _LEAKS,
    "op12_url_filters": _url_filters(_URL_RULES),
}
