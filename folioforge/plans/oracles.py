"""DuckDB SQL with the results of the registered queries, written from the rules and not from the plans."""

from __future__ import annotations

import re

from ..functions import charclass


def _re2(java: str) -> str:
    return re.sub(r"\\u([0-9a-fA-F]{4})", r"\\x{\1}", java)


SPACE, DIGIT, BREAK = map(_re2, (charclass.SPACE, charclass.DIGIT, charclass.LINE_BREAK))
WORD = charclass.WORD


def n_of(s: str, inside: str) -> str:
    return f"length(regexp_replace({s}, '[^{inside}]+', '', 'g'))"


def strip(s: str) -> str:
    return f"regexp_replace({s}, '^[{SPACE}]+|[{SPACE}]+$', '', 'g')"


def ratio(a: str, b: str) -> str:
    return f"CASE WHEN {b} > 0 THEN round_even({a} / {b}, 6) ELSE 0.0 END"


DOCS = "docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)"
FILES = """files AS (SELECT id, rel AS txt_rel, '/lib/' || rel AS txt_abs, strlen(text)::BIGINT AS size_bytes, text FROM (
  SELECT doc_id AS id, text, 'OCR_TXT/' || CASE doc_id % 3 WHEN 0 THEN 'pdf_OCR_TXT' WHEN 1 THEN 'djvu_OCR_TXT' ELSE 'misc' END || CASE WHEN doc_id % 7 = 0 THEN '/tab' ELSE '' END || '/doc' || doc_id || '.txt' AS rel FROM docs))"""
COLLIDING = "colliding AS (SELECT doc_id AS id, text, 'OCR_TXT/f' || lpad((doc_id // 100)::VARCHAR, 12, '0') || '/doc' || (doc_id % 100) || '.txt' AS txt_rel, 'doc' || (doc_id % 100) AS stem FROM docs)"
MUTATED = r"""mutated AS (SELECT doc_id, CASE doc_id % 4 WHEN 1 THEN regexp_replace(text, '[a-z]+', '7', 'g') WHEN 2 THEN regexp_replace(text, '[a-z]', ' ', 'g')
  WHEN 3 THEN text || chr(10) || '12' || chr(10) || '12' || chr(10) || '3 4' || chr(10) || '-- 5 --' ELSE text END AS text FROM docs)"""
BOOKS = "books AS (SELECT doc_id // 20 AS book, string_agg(text, chr(12) ORDER BY doc_id) AS text FROM docs GROUP BY 1)"
TABLES = "tables AS (SELECT l_orderkey AS doc_id, string_agg(l_orderkey || ' | ' || l_partkey || ' | ' || l_suppkey || ' | ' || l_linenumber, chr(10) ORDER BY l_linenumber, l_partkey, l_suppkey) AS text FROM lineitem GROUP BY 1)"
CODED = """parts AS (SELECT doc_id AS n, text AS head,
  CASE doc_id % 5 WHEN 0 THEN '' WHEN 1 THEN chr(10) || 'УДК ' || (doc_id % 900 + 100) || '.' || (doc_id % 7) || ' Основы' WHEN 2 THEN chr(10) || 'УДК: ' || (doc_id % 90 + 610) || '.3 ' WHEN 3 THEN chr(10) || 'УДК 51 Курс'
    ELSE 'УДК 004.' || (doc_id % 10) || ' и УДК 004.' || (doc_id % 10) || ' УДК 621.3 ' END AS udc,
  CASE doc_id % 4 WHEN 0 THEN chr(10) || 'ББК ' || (doc_id % 80 + 20) || '.' || (doc_id % 9 + 1) || 'я' || (doc_id % 90 + 10) || '. Авторы' WHEN 1 THEN chr(10) || 'ББК нет' ELSE '' END AS bbk,
  CASE doc_id % 6 WHEN 0 THEN ' М., ' || (doc_id % 160 + 1862) || ' г. изд.' WHEN 1 THEN ' ' || (doc_id % 100 + 1900) || ' и 1987 год ' ELSE '' END AS yr FROM docs),
coded AS (SELECT n AS doc_id, CASE WHEN n % 2 = 0 THEN udc || bbk || yr || ' ' || head ELSE head || ' ' || udc || bbk || yr END AS text FROM parts)"""


def lines(source: str) -> str:
    """The line entries of a table (doc_id, text)."""
    s = "s"
    return rf"""split_{source} AS (SELECT doc_id, text AS page, unnest(string_split_regex(text, '{BREAK}')) AS s, generate_subscripts(string_split_regex(text, '{BREAK}'), 1) AS line_no FROM {source}),
raw_{source} AS (SELECT doc_id, line_no, s, {strip(s)} AS stripped, length(s) AS n, {n_of(s, chr(92) + 'p{L}')} AS letters, {n_of(s, DIGIT)} AS digits, {n_of(s, SPACE)} AS spaces,
  length(regexp_replace(s, '[\p{{L}}\p{{N}}{SPACE}]+', '', 'g')) AS puncts, regexp_extract_all(s, '[{WORD}]+') AS tokens FROM split_{source}),
lines_{source} AS (SELECT *, CASE WHEN letters = 0 THEN 'non_letter' WHEN table_like_score_line >= 2 THEN 'table_like' WHEN text_len_stripped <= 3 THEN 'short_text' ELSE 'text_line' END AS line_class FROM (
  SELECT *, (digit_ratio >= 0.30)::INT + (letter_ratio <= 0.50)::INT + (single_char_token_ratio >= 0.40 AND token_count_simple >= 4)::INT + (NOT has_letter)::INT + (avg_token_len > 0 AND avg_token_len < 3.0)::INT AS table_like_score_line FROM (
    SELECT doc_id, line_no, s AS text, n AS text_len, length(stripped) AS text_len_stripped, len(tokens) AS token_count_simple, letters, {ratio('letters', 'n')} AS letter_ratio, {ratio('digits', 'n')} AS digit_ratio, {ratio('puncts', 'n')} AS punct_ratio, {ratio('spaces', 'n')} AS space_ratio,
      {ratio('len(list_filter(tokens, lambda t: length(t) = 1))', 'len(tokens)')} AS single_char_token_ratio, {ratio(n_of(s, WORD), 'len(tokens)')} AS avg_token_len, letters > 0 AS has_letter, digits > 0 AS has_digit,
      count(*) OVER (PARTITION BY doc_id, stripped) > 1 AS is_duplicate_in_chunk FROM raw_{source} WHERE stripped <> '')))"""


LINE_COLUMNS = "line_no, text, text_len, text_len_stripped, token_count_simple, letter_ratio, digit_ratio, punct_ratio, space_ratio, single_char_token_ratio, avg_token_len, has_letter, has_digit, is_duplicate_in_chunk, table_like_score_line::BIGINT AS table_like_score_line, line_class"


def metrics(source: str) -> str:
    """The page metrics of a table (doc_id, text), one row per page."""
    some = lambda f: f"coalesce(count(*) FILTER ({f}), 0)"
    return rf"""about_{source} AS (SELECT doc_id, count(*) AS line_count, {some('NOT has_letter')} AS bare, {some('text_len_stripped <= 3')} AS short, {some('is_duplicate_in_chunk')} AS dup FROM lines_{source} GROUP BY 1),
base_{source} AS (SELECT p.doc_id, length(p.text) AS text_len, coalesce(line_count, 0) AS line_count, regexp_extract_all(p.text, '[{WORD}]+') AS tokens, {n_of('p.text', WORD)} AS chars, {n_of('p.text', chr(92) + 'p{L}')} AS letters, {n_of('p.text', DIGIT)} AS digits,
  length(regexp_replace(p.text, '[\p{{L}}\p{{N}}{SPACE}]+', '', 'g')) AS puncts, bare, short, dup FROM {source} p LEFT JOIN about_{source} a ON p.doc_id = a.doc_id),
flags_{source} AS (SELECT *, letter_ratio < 0.35 AS low_letters, digit_ratio > 0.30 AS high_digits, punct_ratio > 0.25 AS high_punct, single_char_token_ratio > 0.30 AS single_chars, non_letter_line_ratio > 0.40 AS non_letter_lines, avg_token_len < 3.0 AS short_tokens, short_line_ratio > 0.30 AS short_lines, duplicate_line_ratio > 0.20 AS duplicate_lines FROM (
  SELECT doc_id, text_len, line_count, len(tokens) AS token_count, {ratio('letters', 'text_len')} AS letter_ratio, {ratio('digits', 'text_len')} AS digit_ratio, {ratio('puncts', 'text_len')} AS punct_ratio, {ratio('len(list_filter(tokens, lambda t: length(t) = 1))', 'len(tokens)')} AS single_char_token_ratio,
    {ratio('bare', 'line_count')} AS non_letter_line_ratio, {ratio('chars', 'len(tokens)')} AS avg_token_len, {ratio('short', 'line_count')} AS short_line_ratio, {ratio('dup', 'line_count')} AS duplicate_line_ratio FROM base_{source})),
pages_{source} AS (SELECT *, CASE WHEN junk_score >= 5 THEN 'junk_candidate' WHEN junk_score >= 3 THEN 'suspicious' ELSE 'ok' END AS quality_class FROM (
  SELECT *, (low_letters::INT + high_digits::INT + high_punct::INT + single_chars::INT + non_letter_lines::INT + short_tokens::INT + short_lines::INT + duplicate_lines::INT)::BIGINT AS junk_score FROM flags_{source}))"""


PAGE_COLUMNS = "doc_id, text_len, line_count, token_count, letter_ratio, digit_ratio, punct_ratio, single_char_token_ratio, non_letter_line_ratio, avg_token_len, short_line_ratio, duplicate_line_ratio, junk_score, quality_class"


def normal(s: str) -> str:
    return rf"trim(regexp_replace({s}, '[^\p{{L}}{DIGIT}]+', ' ', 'g'))"


def own(s: str) -> str:
    """Metrics of a normalised line, as columns."""
    t = f"list_filter(string_split({s}, ' '), lambda t: t <> '')"
    part = lambda a, b: f"CASE WHEN {b} > 0 THEN {a} / {b} ELSE 0.0 END"
    return rf"{part(n_of(s, DIGIT), f'length({s})')} AS d, {part(n_of(s, chr(92) + 'p{L}'), f'length({s})')} AS l, {part(f'len(list_filter({t}, lambda t: length(t) = 1))', f'len({t})')} AS o, len({t}) AS k, {t} AS tokens"


CYRILLIC = r"^[\x{410}-\x{42f}\x{430}-\x{44f}\x{401}\x{451}]{4,}$"


def token_counts(t: str) -> str:
    keep = f"regexp_matches(t, '{CYRILLIC}')"
    digit, letter = f"regexp_matches(t, '[{DIGIT}]')", r"regexp_matches(t, '\p{L}')"
    latin, other = (f"NOT {keep} AND NOT {digit} AND {no} regexp_matches(t, '[A-Za-z]')" for no in ("", "NOT"))
    some = lambda f: f"len(list_filter({t}, lambda t: {f}))"
    return f"array_to_string(list_filter({t}, lambda t: {keep}), ' ') AS line, len({t}) AS tokens_seen, {some(keep)} AS tokens_kept, {some(f'NOT {keep} AND {digit} AND NOT {letter}')} AS numeric_removed, {some(f'NOT {keep} AND {digit} AND {letter}')} AS mixed_removed, {some(latin)} AS latin_removed, {some(other)} AS other_removed"


def tab_clean(source: str) -> str:
    return f"""tl_{source} AS (SELECT doc_id, i, {normal('s')} AS s FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS s, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM {source})),
tm_{source} AS (SELECT doc_id, i, s, {own('s')} FROM tl_{source}),
tk_{source} AS (SELECT doc_id, i, s, s <> '' AND (d >= 0.30 OR l <= 0.50 OR (o >= 0.40 AND k >= 4)) AS is_table, k, {token_counts('tokens')} FROM tm_{source}),
tab_{source} AS (SELECT doc_id, coalesce(string_agg(CASE WHEN is_table THEN line ELSE s END, chr(10) ORDER BY i) FILTER (s <> '' AND (NOT is_table OR line <> '')), '') AS text, count(*) AS lines_in, count(*) FILTER (s <> '' AND (NOT is_table OR line <> '')) AS lines_out, count(*) FILTER (is_table) AS table_lines, count(*) FILTER (s <> '' AND NOT is_table) AS text_lines,
  coalesce(sum(k) FILTER (s <> ''), 0)::BIGINT AS tokens_seen, coalesce(sum(CASE WHEN is_table THEN tokens_kept ELSE k END) FILTER (s <> ''), 0)::BIGINT AS tokens_kept, {', '.join(f'coalesce(sum({x}_removed) FILTER (is_table), 0)::BIGINT AS {x}_removed' for x in ('numeric', 'mixed', 'latin', 'other'))}, count(*) FILTER (NOT (s <> '' AND (NOT is_table OR line <> ''))) AS lines_removed FROM tk_{source} GROUP BY 1)"""


TECH = "['" + "', '".join(["ph", "fe", "cu", "zn", "pb", "au", "ag", "ni", "co", "al", "mg", "ca", "na", "k", "мм", "см", "м", "км", "г", "кг", "т", "с", "мс", "а", "в", "кв", "квт", "мпа", "па", "бар", "гост", "ост", "ту", "рис", "табл"]) + "']"


def decided(source: str) -> str:
    """Line decisions of the pages that aren't table pages; the duplicate rule as a window over equal lines."""
    return f"""st_{source} AS (SELECT r.doc_id, r.i AS line_no, r.s AS line, lower(r.s) AS low, p.quality_class AS q, coalesce(e.text_len_stripped, length(r.s)) AS n, coalesce(e.token_count_simple, r.k) AS k, coalesce(e.letter_ratio, r.l) AS l, coalesce(e.digit_ratio, r.d) AS d, coalesce(e.single_char_token_ratio, r.o) AS o, coalesce(e.avg_token_len, 0) AS a, coalesce(e.has_letter, false) AS h,
  coalesce(e.is_duplicate_in_chunk, false) AS dup, coalesce(e.table_like_score_line, 0) AS sc, coalesce(e.line_class, 'unknown') AS kind, list_has_any(string_split(lower(r.s), ' '), {TECH}) AS tech
  FROM tm_{source} r JOIN pages_{source} p ON r.doc_id = p.doc_id LEFT JOIN lines_{source} e ON r.doc_id = e.doc_id AND r.i = e.line_no WHERE r.doc_id % 7 <> 0),
early_{source} AS (SELECT *, CASE WHEN line = '' THEN 'empty_after_normalize' WHEN tech THEN NULL WHEN n <= 2 THEN 'too_short' WHEN NOT h AND n < 25 THEN 'short_no_letters' END AS early,
  CASE WHEN tech THEN NULL WHEN k >= 4 AND o > CASE WHEN q = 'ok' THEN 0.60 ELSE 0.50 END THEN 'single_char_ocr_noise'
    WHEN q = 'ok' AND kind = 'non_letter' AND l < 0.20 AND n < 40 OR q = 'suspicious' AND kind = 'non_letter' AND l < 0.35 OR q = 'junk_candidate' AND kind = 'non_letter' AND l < 0.40 THEN 'non_letter_line'
    WHEN q = 'ok' AND sc >= 3 AND d > 0.45 AND l < 0.30 OR q = 'suspicious' AND sc >= 2 AND l < 0.45 OR q = 'junk_candidate' AND sc >= 2 AND l < 0.50 THEN 'table_like_line'
    WHEN q = 'ok' AND d > 0.50 AND l < 0.30 OR q = 'suspicious' AND d > 0.45 AND l < 0.35 OR q = 'junk_candidate' AND d > 0.40 AND l < 0.40 THEN 'heavy_numeric' END AS late,
  CASE WHEN q = 'ok' THEN l < 0.40 OR a < 2.8 OR o > 0.35 ELSE l < 0.45 OR a < 3.0 OR o > 0.35 END AS weak FROM st_{source}),
seen_{source} AS (SELECT *, coalesce(max((length(low) <= 80 AND early IS NULL AND late IS NULL AND (tech OR NOT (n <= 80 AND dup)))::INT) OVER (PARTITION BY doc_id, low ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 1 AS seen FROM early_{source}),
why_{source} AS (SELECT *, coalesce(early, CASE WHEN NOT tech AND n <= 80 AND (dup OR seen) THEN 'duplicate_short_line' END, late) AS gone FROM seen_{source}),
decisions_{source} AS (SELECT doc_id, q AS quality_class, line_no, line, CASE WHEN gone IS NOT NULL THEN 'drop' WHEN NOT tech AND weak THEN 'normalize' ELSE 'keep' END AS action, coalesce(gone, CASE WHEN tech THEN 'tech_whitelist' WHEN weak THEN 'weak_text' ELSE 'good_text' END) AS reason FROM why_{source}),
cleaned_{source} AS (SELECT m.doc_id, m.text AS before, CASE WHEN m.doc_id % 7 = 0 THEN t.text ELSE coalesce(d.text, '') END AS after, CASE WHEN m.doc_id % 7 = 0 THEN 'tab' ELSE p.quality_class END AS clean_mode FROM {source} m JOIN pages_{source} p ON m.doc_id = p.doc_id JOIN tab_{source} t ON m.doc_id = t.doc_id
  LEFT JOIN (SELECT doc_id, string_agg(line, chr(10) ORDER BY line_no) FILTER (action <> 'drop') AS text FROM decisions_{source} GROUP BY 1) d ON m.doc_id = d.doc_id)"""


def words(s: str) -> str:
    return f"list_filter(string_split_regex({s}, '[{SPACE}]+'), lambda w: w <> '')"


def split_sql(source: str, max_words: int = 222, overlap: int = 10) -> str:
    """Parts of a table (doc_id, text): one row per part with its words."""
    return f"""ws AS (SELECT * EXCLUDE (text), {words('text')} AS ws FROM {source}),
nk AS (SELECT *, len(ws) AS n, CASE WHEN len(ws) = 0 THEN 0 WHEN len(ws) <= {max_words} THEN 1 ELSE greatest(2, ceil(len(ws) / {max_words - overlap})::BIGINT) END AS k FROM ws),
each AS (SELECT *, unnest(range(0, k)) AS i FROM nk),
bounds AS (SELECT *, i * (n // k) + least(i, n % k) AS a, (i + 1) * (n // k) + least(i + 1, n % k) AS b FROM each),
parts AS (SELECT *, CASE WHEN i = 0 THEN 0 ELSE least({overlap}, a - ((i - 1) * (n // k) + least(i - 1, n % k))) END AS back FROM bounds)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


_M = (DOCS, MUTATED, lines("mutated"), metrics("mutated"))
_C = (*_M, tab_clean("mutated"), decided("mutated"))
_BREAKS = "regexp_replace(text, '\\r\\n?', chr(10), 'g')"
_NORMAL = strip(rf"regexp_replace(regexp_replace(regexp_replace({_BREAKS}, '([{WORD}])-\n([{WORD}])', '\1\2', 'g'), '[ \t]+\n', chr(10), 'g'), '\n{{3,}}', chr(10) || chr(10), 'g')")


def text_of_page(column: str) -> str:
    """A text in normal form, as pages are."""
    return _NORMAL.replace("(text,", f"({column},")


_PAGES = f"normal AS (SELECT book, {_NORMAL} AS text FROM books), pages AS (SELECT book, {strip('s')} AS text, page_no FROM (SELECT book, unnest(string_split(text, chr(12))) AS s, generate_subscripts(string_split(text, chr(12)), 1) AS page_no FROM normal WHERE text <> ''))"
_BUCKET = "CASE WHEN length(text) BETWEEN 20 AND 49 THEN '20-49' WHEN length(text) BETWEEN 50 AND 99 THEN '50-99' WHEN length(text) BETWEEN 100 AND 499 THEN '100-499' WHEN length(text) BETWEEN 500 AND 999 THEN '500-999' ELSE '1000+' END"
_SIZES = [(0, 0, "0 B"), (1, 255, "1-255 B"), (256, 1023, "256-1023 B"), (1024, 2047, "1-2 KB"), (2048, 4095, "2-4 KB"), (4096, 8191, "4-8 KB"), (8192, 16383, "8-16 KB"), (16384, 32767, "16-32 KB"), (32768, 65535, "32-64 KB"), (65536, 131071, "64-128 KB"), (131072, 196607, "128-192 KB"), (196608, 262143, "192-256 KB"), (262144, 524287, "256-512 KB"), (524288, 1048575, "512 KB-1 MB"), (1048576, 2097151, "1-2 MB"), (2097152, 4194303, "2-4 MB"), (4194304, 8388607, "4-8 MB"), (8388608, None, "> 8 MB")]
_RANGES = ", ".join(f"({a}, {'NULL' if b is None else b}, '{label}')" for a, b, label in _SIZES)


def human(n: str) -> str:
    return f"CASE WHEN {n} < 1024 THEN {n} || ' B' WHEN {n} / 1024.0 < 1024 THEN printf('%.2f KB', {n} / 1024.0::DOUBLE) WHEN {n} / 1048576.0 < 1024 THEN printf('%.2f MB', {n} / 1048576.0::DOUBLE) ELSE printf('%.2f GB', {n} / 1073741824.0::DOUBLE) END"


_UDC_AFTER = rf"regexp_extract(substr(text, p0 + 1, 140), '(?s)^[{SPACE}]*([0-9][0-9{SPACE}./:;,+()=\[\]\-]{{1,120}})', 1)"
_BLOCK = lambda raw: f"regexp_replace(regexp_replace({strip(raw)}, '[{SPACE}]+', ' ', 'g'), '^[ ,;:-]+|[ ,;:-]+$', '', 'g')"


def hits(label: str, width: int, tag: str) -> str:
    return rf"""SELECT doc_id, text, p0 - {width} AS pos, {width} AS width, length({_UDC_AFTER}) AS used, {_BLOCK(_UDC_AFTER)} AS value, '{tag}' AS tag FROM (SELECT doc_id, text, unnest(list_transform(range(1, len(cut)), lambda i: list_sum(list_transform(cut[1:i], lambda p: length(p))) + {width} * i))::BIGINT AS p0 FROM (SELECT *, string_split_regex(text, '{label}') AS cut FROM coded)) WHERE {n_of(_BLOCK(_UDC_AFTER), '0-9')} >= 3"""


_UDC = f"""exact AS ({hits('УДК', 3, 'exact')}), marked AS ({hits('УДК[:.-]', 4, 'group1')}),
found AS (SELECT * FROM exact UNION ALL SELECT * FROM marked WHERE doc_id NOT IN (SELECT doc_id FROM exact)),
zoned AS (SELECT *, pos <= 500 AS early, bool_or(pos <= 500) OVER (PARTITION BY doc_id) AS any_early FROM found),
chosen AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS r FROM zoned WHERE early = any_early),
counted AS (SELECT doc_id, value, count(*) AS n, min(pos) AS first, any_value(any_early) AS early FROM chosen WHERE r <= 4 GROUP BY 1, 2),
best AS (SELECT * FROM counted QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, first) = 1),
udc AS (SELECT c.doc_id, coalesce(b.value, '') AS udc, CASE WHEN b.doc_id IS NULL THEN 'not_found' WHEN b.early THEN 'early' ELSE 'late' END AS udc_zone, CASE WHEN b.doc_id IS NULL THEN 'not_found' WHEN f.tag = 'group1' THEN 'found_group1' ELSE 'ok' END AS udc_status, coalesce(f.hits, 0) AS hits, f.first_pos
  FROM coded c LEFT JOIN best b ON c.doc_id = b.doc_id LEFT JOIN (SELECT doc_id, count(*) AS hits, min(pos) AS first_pos, any_value(tag) AS tag FROM found GROUP BY 1) f ON c.doc_id = f.doc_id)"""
_YEARS = r"""heads AS (SELECT doc_id, substr(text, 1, 5000) AS h, regexp_extract_all(substr(text, 1, 5000), '[^\p{Nd}]+|\p{Nd}+') AS runs FROM coded),
spots AS (SELECT doc_id, h, unnest(list_transform(list_filter(range(1, len(runs) + 1), lambda k: regexp_matches(runs[k], '^(18[6-9]\p{Nd}|19\p{Nd}\p{Nd}|20[0-1]\p{Nd}|202[0-5])$')), lambda k: coalesce(list_sum(list_transform(runs[1 : k - 1], lambda p: length(p))), 0) + 1))::BIGINT AS i FROM heads),
around AS (SELECT doc_id, i, substr(h, i, 4) AS year, substr(h, i + 4, 12) AS after, substr(h, greatest(i - 12, 1), i - greatest(i - 12, 1)) AS before, substr(h, greatest(i - 40, 1), i + 44 - greatest(i - 40, 1)) AS near FROM spots),
scored AS (SELECT doc_id, i, year, greatest(0, 2001 - i) / 2000.0::DOUBLE + CASE WHEN regexp_matches(after, '^[SP]*(([гГ]|год|ГОД)([^\p{L}\p{N}_]|$)|([гГ]|т)\.[\p{L}\p{N}_])') THEN 3.0 ELSE 0 END
  + CASE WHEN regexp_matches(before, '(^|[^\p{L}\p{N}_])([гГ]\.?|год|ГОД|т\.)[SP]*$') THEN 1.5 ELSE 0 END + CASE WHEN regexp_matches(near, '(?i)изд|издание|выпуск|тираж|печать|подписано') THEN 0.7 ELSE 0 END AS score FROM around),
years AS (SELECT c.doc_id, coalesce(arg_max(year, struct_pack(score := score, p := -i)), '') AS year FROM coded c LEFT JOIN scored s ON c.doc_id = s.doc_id GROUP BY 1)""".replace("[SP]", f"[{SPACE}]")

_BBK = "v AS (SELECT doc_id, text, CASE WHEN doc_id % 4 = 0 THEN (doc_id % 80 + 20) || '.' || (doc_id % 9 + 1) || 'я' || (doc_id % 90 + 10) WHEN doc_id % 12 = 1 THEN substr((doc_id % 100 + 1900)::VARCHAR, 1, 3) ELSE '' END AS bbk FROM coded)"
_GROUPS = "sized AS (SELECT *, count(*) OVER (PARTITION BY size_bytes) AS c FROM files), nums AS (SELECT *, dense_rank() OVER (ORDER BY size_bytes) AS sg, sha1(text) AS h FROM sized WHERE c > 1), g AS (SELECT *, count(*) OVER (PARTITION BY size_bytes, h) AS n FROM nums), gg AS (SELECT *, dense_rank() OVER (ORDER BY size_bytes, h) AS rg, row_number() OVER (PARTITION BY size_bytes, h ORDER BY lower(txt_rel)) AS k FROM g WHERE n > 1)"
# a name like doc1987 is a year and a title
_FIELDS = "substr(sha1(txt_rel), 1, 16) AS sid, substr(sha1(txt_rel), 1, 16) AS doc_id, sha1(txt_rel) AS uid, txt_rel, txt_abs, CASE WHEN contains(txt_rel, 'pdf_OCR_TXT') THEN 'pdf' WHEN contains(txt_rel, 'djvu_OCR_TXT') THEN 'djvu' END AS src_kind, false AS src_exists, txt_rel AS rel_path_stg1, CASE WHEN id BETWEEN 1500 AND 2030 THEN 'doc' ELSE 'doc' || id END AS title, CASE WHEN id BETWEEN 1500 AND 2030 THEN id::VARCHAR END AS year"

ORACLES: dict[str, str] = {
    "path_scalars": with_(DOCS, "r AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN '  a\\b' || doc_id || chr(9) WHEN 1 THEN ' ' || chr(160) || ' ' WHEN 2 THEN 'x\\y/z' END AS raw FROM docs)")
    + f"SELECT doc_id, nullif({strip("replace(raw, chr(92), '/')")}, '') AS slashes, nullif({strip('raw')}, '') AS scalar, coalesce({strip("replace(raw, chr(92), '/')")}, '') AS norm FROM r",
    "manifest_rows": with_(DOCS, FILES) + f"SELECT {_FIELDS}, '' AS src_rel, size_bytes, '' AS authors, '' AS udc, '' AS bbk FROM files",
    "page_rows": with_(DOCS, FILES, f"n AS (SELECT *, {_NORMAL} AS body FROM files)")
    + f"SELECT printf('%s::p%05d', substr(sha1(txt_rel), 1, 16), 1) AS chunk_id, {_FIELDS}, NULL::VARCHAR AS topic, NULL::VARCHAR AS txt_sha1, NULL::VARCHAR AS src_rel, 1::BIGINT AS page_start, 1::BIGINT AS page_end, sha1(body) AS text, NULL::VARCHAR AS authors, NULL::VARCHAR AS udc, NULL::VARCHAR AS bbk, size_bytes AS size_bytes_txt, 'make_manifest' AS manifest_generator_program, '1.0' AS manifest_generator_version, '2026-04-04 v4.0' AS manifest_schema_version, 'make_chunks_full' AS chunk_generator_program, '1.0' AS chunk_generator_version FROM n WHERE length(body) >= 20",
    "missing_files": with_(DOCS, FILES) + "SELECT id, CASE WHEN id % 10 = 0 THEN 'missing' ELSE 'read' END AS state FROM files",
    "consistency": with_(DOCS, FILES) + "SELECT id, false AS doc_id_ok, true AS txt_abs_ok, true AS txt_rel_ok FROM files WHERE id % 9 = 0",
    "small_files": with_(DOCS, FILES) + "SELECT count(*) AS rows_total, count(*) FILTER (size_bytes <= 65536) AS small_file_count FROM files",
    "duplicate_report": with_(DOCS, FILES, _GROUPS)
    + "SELECT '[GROUP ' || rg || '] size_group_no=' || sg || ' size_bytes=' || size_bytes || ' files=' || n || ' | content_sha1=' || h AS value FROM gg WHERE k = 1 UNION ALL SELECT '  - #' || k || ' | size_group_no=' || sg || ' | size_bytes=' || size_bytes || ' | content_sha1=' || h || ' | doc_id=' || substr(sha1(txt_rel), 1, 16) || ' | sid=' || substr(sha1(txt_rel), 1, 16) || ' | txt_abs=' || txt_abs FROM gg",
    "udc_hit_rows": with_(DOCS, CODED, _UDC)
    + f"SELECT doc_id, value, {strip(f"regexp_replace(substr(text, greatest(pos - 80, 0) + 1, least(length(text), pos + width + used + 80) - greatest(pos - 80, 0)), '[{SPACE}]+', ' ', 'g')")} AS context, pos AS pos_from_start, length(text) - pos AS pos_from_end, tag AS source_tag FROM found",
    "code_frequencies": with_(DOCS, CODED, _UDC) + "SELECT 'udc_zone' AS name, udc_zone AS value, count(*) AS n FROM udc GROUP BY 2 UNION ALL SELECT 'udc_status', udc_status, count(*) FROM udc GROUP BY 2",
    "hit_counts": with_(DOCS, CODED, _UDC) + "SELECT least(hits, 4) AS hits, count(*) AS n FROM udc GROUP BY 1",
    "hit_listing": with_(DOCS, CODED, _UDC, _BBK) + "SELECT 'UDK | ' || doc_id || ' | ' || value || ' | ' || pos AS value FROM found UNION ALL SELECT 'BBK | ' || doc_id || ' | ' || bbk || ' | ' || (strpos(text, 'ББК') - 1) FROM v WHERE bbk <> ''",
    "token_report_control": with_(DOCS, FILES, f"t AS (SELECT size_bytes AS s, len({words('text')}) >= 20 AS ok FROM files WHERE size_bytes <= 512)")
    + "SELECT count(*) AS candidate_file_count, count(*) FILTER (NOT ok) AS not_searchable_file_count, count(*) FILTER (ok) AS searchable_file_count, max(s) FILTER (NOT ok) AS max_size_bytes_not_searchable, min(s) FILTER (ok) AS min_size_bytes_searchable, '' AS tokenizer_error, coalesce(max(s) FILTER (NOT ok) >= 512, false) OR coalesce(min(s) FILTER (ok) >= 512, false) AS threshold_may_need_review FROM t",
    "doc_ids": with_(DOCS, FILES) + "SELECT id, txt_rel, sha1(txt_rel) AS uid, substr(sha1(txt_rel), 1, 16) AS doc_id, CASE WHEN contains(lower(txt_rel), 'pdf_ocr_txt') THEN 'pdf' WHEN contains(lower(txt_rel), 'djvu_ocr_txt') THEN 'djvu' END AS src_kind, 'doc' || id AS stem, 'doc' || id || '.txt' AS file_name FROM files",
    "src_kind_counts": with_(DOCS, FILES) + "SELECT 'src_kind' AS name, CASE WHEN contains(txt_rel, 'pdf_OCR_TXT') THEN 'pdf' WHEN contains(txt_rel, 'djvu_OCR_TXT') THEN 'djvu' END AS value, count(*) AS n FROM files GROUP BY 2",
    "human_sizes": with_(DOCS, FILES) + f"SELECT id, {human('size_bytes')} AS size, {human('(size_bytes * 5000)')} AS larger FROM files",
    "size_histogram": with_(DOCS, FILES) + f"SELECT r.label AS range_label, r.a::BIGINT AS start_bytes, r.b::BIGINT AS end_bytes, count(f.id) AS file_count, round_even(count(f.id) / (SELECT count(*) FROM files), 6) AS ratio FROM (VALUES {_RANGES}) r(a, b, label) LEFT JOIN files f ON f.size_bytes >= r.a AND (r.b IS NULL OR f.size_bytes <= r.b) GROUP BY 1, 2, 3",
    "exact_duplicates": with_(DOCS, FILES, "sized AS (SELECT *, count(*) OVER (PARTITION BY size_bytes) AS c FROM files), nums AS (SELECT *, dense_rank() OVER (ORDER BY size_bytes) AS size_group_no, sha1(text) AS h FROM sized WHERE c > 1), g AS (SELECT *, count(*) OVER (PARTITION BY size_bytes, h) AS group_size FROM nums)")
    + "SELECT dense_rank() OVER (ORDER BY size_bytes, h) AS report_group_no, size_group_no, group_size, row_number() OVER (PARTITION BY size_bytes, h ORDER BY lower(txt_rel)) AS group_index, size_bytes, h AS content_sha1, substr(sha1(txt_rel), 1, 16) AS doc_id, substr(sha1(txt_rel), 1, 16) AS sid, txt_rel, txt_abs, sha1(txt_rel) AS uid, 'doc' || id || '.txt' AS file_name FROM g WHERE group_size > 1",
    "size_totals": with_(DOCS, FILES) + "SELECT count(*) AS total_unique_sizes_with_duplicates, coalesce(sum(n), 0)::BIGINT AS total_files_in_size_groups FROM (SELECT count(*) AS n FROM files GROUP BY size_bytes HAVING count(*) > 1)",
    "stem_index": with_(DOCS, COLLIDING) + "SELECT stem, min(txt_rel) AS txt_rel, count(*) - 1 AS collisions FROM colliding GROUP BY 1",
    "stem_join": with_(DOCS, COLLIDING) + "SELECT c.id, c.txt_rel, f.txt_rel AS text_rel, sha1(f.text) AS text_sha1 FROM colliding c JOIN (SELECT * FROM colliding QUALIFY row_number() OVER (PARTITION BY stem ORDER BY txt_rel) = 1) f ON c.stem = f.stem",
    "udc_codes": with_(DOCS, CODED, _UDC) + "SELECT * FROM udc",
    # a label before a year takes its first three digits for a code
    "bbk_codes": with_(DOCS, CODED, _BBK)
    + "SELECT doc_id, bbk, CASE WHEN bbk = '' THEN 'not_found' WHEN strpos(text, 'ББК') - 1 <= 500 THEN 'early' ELSE 'late' END AS bbk_zone, CASE WHEN bbk <> '' THEN 'ok' ELSE 'not_found' END AS bbk_status, (bbk <> '')::BIGINT AS hits FROM v",
    "text_year": with_(DOCS, CODED, _YEARS) + "SELECT * FROM years",
    "merged_year": with_(DOCS, CODED, _YEARS) + "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN '1955' WHEN year <> '' AND year <> '1111' THEN year WHEN doc_id % 3 = 1 THEN '1111' END AS year FROM years",
    "top_codes": with_(DOCS, CODED, _UDC) + "SELECT udc AS value, count(*) AS n FROM udc WHERE udc <> '' GROUP BY 1 ORDER BY n DESC, min(doc_id) LIMIT 100",
    "normalize_pages": with_(DOCS, BOOKS) + f"SELECT book, sha1({_NORMAL}) AS sha1 FROM books",
    "page_split": with_(DOCS, BOOKS, _PAGES) + "SELECT book, page_no, length(text) AS chars, sha1(text) AS sha1 FROM pages WHERE length(text) >= 20",
    "page_length_buckets": with_(DOCS, BOOKS, _PAGES) + f"SELECT {_BUCKET} AS bucket, count(*) AS n FROM pages WHERE length(text) >= 20 GROUP BY 1",
    "page_stats": with_(DOCS, BOOKS, _PAGES, "k AS (SELECT book, count(*) AS kept FROM pages WHERE length(text) >= 20 GROUP BY 1), w AS (SELECT length(text) AS n FROM pages WHERE length(text) >= 20)")
    + "SELECT (SELECT count(*) FROM books) AS docs, (SELECT count(*) FROM pages) AS pages, count(*) AS pages_written, (SELECT count(*) FROM pages) - count(*) AS pages_short, (SELECT count(*) FROM books) - (SELECT count(*) FROM k) AS docs_without_pages, coalesce(sum(n), 0)::BIGINT AS chars, min(n) AS min_chars, max(n) AS max_chars, count(*) FILTER (n BETWEEN 20 AND 49) AS len_20, count(*) FILTER (n BETWEEN 50 AND 99) AS len_50, count(*) FILTER (n BETWEEN 100 AND 499) AS len_100, count(*) FILTER (n BETWEEN 500 AND 999) AS len_500, count(*) FILTER (n >= 1000) AS len_1000, round_even(sum(n) / count(*), 6) AS avg_chars FROM w",
    "line_metrics": with_(DOCS, MUTATED, lines("mutated")) + f"SELECT doc_id, {LINE_COLUMNS} FROM lines_mutated",
    "line_class_counts": with_(DOCS, MUTATED, TABLES, lines("mutated"), lines("tables")) + "SELECT line_class, table_like_score_line::BIGINT AS table_like_score_line, count(*) AS n FROM (SELECT line_class, table_like_score_line FROM lines_mutated UNION ALL SELECT line_class, table_like_score_line FROM lines_tables) GROUP BY 1, 2",
    "page_metrics": with_(*_M) + f"SELECT {PAGE_COLUMNS} FROM pages_mutated",
    "table_page_metrics": with_(TABLES, lines("tables"), metrics("tables")) + f"SELECT {PAGE_COLUMNS} FROM pages_tables",
    "junk_flags": with_(*_M) + "SELECT " + ", ".join(f"count(*) FILTER ({f}) AS {f}" for f in ("low_letters", "high_digits", "high_punct", "single_chars", "non_letter_lines", "short_tokens", "short_lines", "duplicate_lines")) + " FROM pages_mutated",
    "quality_class_counts": with_(*_M) + "SELECT quality_class, junk_score, count(*) AS n FROM pages_mutated GROUP BY 1, 2",
    "quality_stats": with_(*_M) + "SELECT count(*) AS total, count(*) FILTER (quality_class = 'ok') AS ok, count(*) FILTER (quality_class = 'suspicious') AS suspicious, count(*) FILTER (quality_class = 'junk_candidate') AS junk_candidate, sum(line_count)::BIGINT AS lines, round_even(sum(line_count) / count(*), 6) AS avg_lines FROM pages_mutated",
    "compact_lines": with_(DOCS, MUTATED, lines("mutated")) + "SELECT doc_id, line_no, has_digit, line_class, text_len FROM lines_mutated",
    "normalize_line": with_(DOCS, MUTATED) + f"SELECT doc_id, i - 1 AS i, {normal('s')} AS line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS s, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM mutated)",
    "table_line_filter": with_(DOCS, CODED) + f"SELECT doc_id, i - 1 AS i, {token_counts('tokens')} FROM (SELECT doc_id, i, list_filter(string_split({normal('s')}, ' '), lambda t: t <> '') AS tokens FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS s, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM coded))",
    "tab_page_clean": with_(DOCS, MUTATED, TABLES, tab_clean("mutated"), tab_clean("tables")) + "SELECT * FROM tab_mutated UNION ALL SELECT * FROM tab_tables",
    "line_decisions": with_(*_C) + "SELECT doc_id, line_no, line, action, reason FROM decisions_mutated",
    "removal_reasons": with_(*_C) + "SELECT quality_class, action, reason, count(*) AS n FROM decisions_mutated GROUP BY 1, 2, 3",
    "clean_pages": with_(*_C) + f"SELECT doc_id, clean_mode, length(before) AS text_before_clean_len, length(after) AS text_after_clean_len, before <> after AS chunk_changed, sha1(after) AS sha1 FROM cleaned_mutated WHERE {strip('after')} <> ''",
    "clean_summary": with_(*_C, f"c AS (SELECT *, {strip('after')} = '' AS e FROM cleaned_mutated), t AS (SELECT * FROM tab_mutated WHERE doc_id % 7 = 0)")
    + "SELECT count(*) AS pages_in, count(*) FILTER (NOT e) AS pages_out, count(*) FILTER (e) AS pages_empty, count(*) FILTER (before <> after) AS pages_changed, count(*) FILTER (before <> after AND clean_mode = 'tab') AS tab_changed, sum(length(before))::BIGINT AS chars_in, sum(length(after))::BIGINT AS chars_out, "
    + ", ".join(f"count(*) FILTER (clean_mode = '{m}') AS pages_{m}" for m in ("tab", "ok", "suspicious", "junk_candidate"))
    + ", (SELECT count(*) FROM decisions_mutated WHERE reason = 'tech_whitelist') AS lines_whitelist, " + ", ".join(f"(SELECT count(*) FROM decisions_mutated WHERE quality_class = '{m}'{f}) AS {m.split('_')[0]}_lines_{k}" for m in ("ok", "suspicious", "junk_candidate") for k, f in (("in", ""), ("out", " AND action <> 'drop'"), ("removed", " AND action = 'drop'")))
    + ", (SELECT count(*) FROM decisions_mutated) AS lines_in, " + ", ".join(f"(SELECT count(*) FROM decisions_mutated WHERE action = '{a}') AS lines_{a}" for a in ("keep", "normalize", "drop")) + ", "
    + ", ".join(f"(SELECT count(*) FROM decisions_mutated WHERE reason = '{r}') AS drop_{r}" for r in ("empty_after_normalize", "too_short", "short_no_letters", "duplicate_short_line", "single_char_ocr_noise", "non_letter_line", "table_like_line", "heavy_numeric")) + ", "
    + ", ".join(f"(SELECT sum({x})::BIGINT FROM t) AS tab_{x}" for x in ("lines_in", "lines_out", "table_lines", "text_lines", "tokens_seen", "tokens_kept", "numeric_removed", "mixed_removed", "latin_removed", "other_removed", "lines_removed"))
    + ", round_even(1 - sum(length(after)) / sum(length(before)), 6) AS char_reduction, (SELECT round_even(sum(tokens_kept) / sum(tokens_seen), 6) FROM t) AS tab_token_keep_ratio FROM c",
    "subchunk_texts": with_(DOCS, split_sql("docs").replace("parts AS", "cut AS")) + "SELECT printf('%s::p%05d::w%02dof%02d', doc_id::VARCHAR, 1, i + 1, k) AS chunk_id, doc_id::VARCHAR AS doc_id, array_to_string(ws[a - back + 1 : b], ' ') AS text, 1::BIGINT AS page_start, '1999' AS year, 'x' AS txt_rel FROM cut",
    "subchunk_stats": with_(DOCS, split_sql("docs").replace("parts AS", "cut AS")) + "SELECT count(*) AS pages_in, sum(k)::BIGINT AS chunks_out, count(*) FILTER (k = 1) AS pages_single, count(*) FILTER (k > 1) AS pages_split, max(k) AS max_parts, count(*) FILTER (k = 0) AS pages_empty, sum(n)::BIGINT AS words_in, (SELECT sum(b - a + back)::BIGINT FROM cut) AS words_out, round_even(sum(n) / count(*), 6) AS avg_words_in, round_even((SELECT sum(b - a + back) FROM cut) / sum(k), 6) AS avg_words_out FROM nk",
    "token_report": with_(DOCS, FILES) + f"SELECT txt_rel, size_bytes, len({words('text')}) AS token_count_e5, len({words('text')}) >= 20 AS is_searchable_e5, '' AS error, sha1({strip(_BREAKS)}) AS report_sha1 FROM files WHERE size_bytes <= 512",
}
# all five stages: documents without form feeds are one page each
_E2E = f"whole AS (SELECT doc_id, {_NORMAL} AS text FROM docs), source AS (SELECT * FROM whole WHERE length(text) >= 20)"
ORACLES["pipeline_end_to_end"] = (
    with_(DOCS, FILES, _E2E, lines("source"), metrics("source"), tab_clean("source"), decided("source"), f"kept AS (SELECT doc_id, after AS text FROM cleaned_source WHERE {strip('after')} <> '')", split_sql("kept").replace("parts AS", "cut AS"))
    + "SELECT printf('%s::p%05d::w%02dof%02d', substr(sha1(f.txt_rel), 1, 16), 1, i + 1, k) AS chunk_id, substr(sha1(f.txt_rel), 1, 16) AS doc_id, array_to_string(ws[a - back + 1 : b], ' ') AS text, 1::BIGINT AS page_start, CASE WHEN c.doc_id BETWEEN 1500 AND 2030 THEN c.doc_id::VARCHAR END AS year, f.txt_rel FROM cut c JOIN files f ON c.doc_id = f.id"
)
# names have no SQL form (the rules scan with lookahead): each form's result follows from its parts, as worked out by hand
_FORMS = [
    ("a || ' А.Б. Книга ' || w || ' (' || y || ')'", "y", "a || ' А.Б.'", "'Книга ' || w", "initials_from_right"), ("'Физика ' || w || ' ()'", "'1111'", "''", "'Физика ' || w", "no_initials"),
    ("'Химия ' || w || ' (год неизв.)'", "'1111'", "''", "'Химия ' || w", "no_initials"), ("'Сборник. Задачи ' || w || ' ' || y", "y", "'Сборник.'", "'Задачи ' || w", "noauthor_prefix"),
    ("'Без авт. Справочник ' || w || ' (12 kb)'", "NULL", "'Без авт.'", "'Справочник ' || w", "noauthor_prefix"), ("'Журнал. Радио ' || w || ' ' || y", "y", "'Журнал.'", "'Радио ' || w", "empty_author_prefix"),
    ("'Feynman_ Lectures ' || w", "NULL", "'Feynman_'", "'Lectures ' || w", "underscore_leading_word"), ("a || ' - Основы ' || w", "NULL", "a", "'Основы ' || w", "hyphen_leading_author"),
    ("a || ' Дж. Теория ' || w", "NULL", "a || ' Дж.'", "'Теория ' || w", "dj_initial_author"), ("'А.Б. ' || a || ' - Оптика ' || w || ' ' || y", "y", "a || ' А.Б.'", "'Оптика ' || w", "initials_plus_hyphen_surname"),
    ("a || ' В.Г. (ред.) Металлы ' || w || ' ' || y", "y", "a || ' В.Г. (ред.)'", "'Металлы ' || w", "initials_from_right"),
    ("a || ' А.Б. и др. Теория ' || w || ' Т. Поле'", "NULL", "a || ' А.Б. и др.'", "'Теория ' || w || ' Т. Поле'", "author_tail_after_marker_to_title"),
    ("a || ' В.Г. Основы ' || w || ' К. Том'", "NULL", "a || ' В.Г.'", "'Основы ' || w || ' К. Том'", "fix_title_tail_after_double_initials"),
    ("a || ' Д.Е. Оптика ' || w || ' Ф.'", "NULL", "a || ' Д.Е.'", "'Оптика ' || w || ' Ф.'", "move_right_sentence_from_authors_to_title_if_title_empty"),
    ("'Труды ' || w || ' ' || repeat('( ', k) || repeat(' )', k) || ' 2031'", "'1111'", "''", "'Труды ' || w || ' 2031'", "no_initials"),
]
_BY_FORM = lambda i: "CASE id % 15 " + " ".join(f"WHEN {n} THEN {form[i] if i < 4 else repr(form[i])}" for n, form in enumerate(_FORMS)) + " END"
_LIBRARY = f"""written AS (SELECT doc_id AS id, text AS whole, CASE WHEN doc_id % 50 <> 49 THEN text END AS text, translate((doc_id % 60)::VARCHAR, '0123456789', 'абвгдежзик') AS w, (doc_id % 100 + 1900)::VARCHAR AS y, ['Иванов', 'Петрова', 'Сидоров', 'Кузнецов', 'Попова'][doc_id % 5 + 1] AS a, (doc_id % 60 + 1) AS k FROM coded),
named AS (SELECT id, text, strlen(whole)::BIGINT AS size_bytes, {_BY_FORM(0)} AS name, {_BY_FORM(1)} AS name_year, {_BY_FORM(2)} AS authors, {_BY_FORM(3)} AS title, {_BY_FORM(4)} AS parse_mode FROM written),
lib AS (SELECT *, 'OCR_TXT/' || CASE id % 3 WHEN 0 THEN 'pdf_OCR_TXT' WHEN 1 THEN 'djvu_OCR_TXT' ELSE 'misc' END || CASE WHEN id % 7 = 0 THEN '/tab' ELSE '' END || '/f' || id || '/' || name || '.txt' AS txt_rel, CASE id % 3 WHEN 0 THEN 'pdf' WHEN 1 THEN 'djvu' END AS src_kind, name_year IS NOT NULL AND name_year <> '1111' AS dated FROM named),
book AS (SELECT lib.*, text IS NOT NULL AS read, CASE WHEN text IS NULL THEN '' ELSE udc END AS udc, CASE WHEN text IS NULL THEN '' ELSE bbk END AS bbk, CASE WHEN text IS NULL THEN 'read_error' ELSE udc_status END AS udc_status, CASE WHEN text IS NULL THEN 'not_found' ELSE udc_zone END AS udc_zone, CASE WHEN text IS NULL OR dated THEN '' ELSE years.year END AS late
  FROM lib JOIN udc ON id = udc.doc_id JOIN (SELECT doc_id, bbk FROM v) b ON id = b.doc_id JOIN years ON id = years.doc_id)"""
_LIB = (DOCS, CODED, _UDC, _BBK, _YEARS, _LIBRARY)
ORACLES["name_fields"] = with_(DOCS, CODED, _LIBRARY.split(",\nlib AS")[0]) + "SELECT id, name, name_year AS year, authors, title, parse_mode FROM named"
ORACLES["library_manifest"] = with_(*_LIB) + (
    "SELECT substr(sha1(txt_rel), 1, 16) AS sid, substr(sha1(txt_rel), 1, 16) AS doc_id, txt_rel, '/lib/' || txt_rel AS txt_abs, src_kind, '' AS src_rel, false AS src_exists, sha1(txt_rel) AS uid, size_bytes, txt_rel AS rel_path_stg1, authors, title, CASE WHEN dated THEN name_year WHEN late <> '' THEN late ELSE name_year END AS year, udc, bbk, "
    "parse_mode, udc_status, CASE WHEN NOT read THEN 'read_error' WHEN bbk <> '' THEN 'ok' ELSE 'not_found' END AS bbk_status, udc_zone FROM book"
)
_SOME = lambda f, name: f"count(*) FILTER ({f}) AS {name}"
ORACLES["manifest_summary"] = with_(
    *_LIB, f"t AS (SELECT *, len({words("coalesce(text, '')")}) AS tokens, sha1(text) AS h FROM book)", "by_size AS (SELECT count(*) AS n FROM t GROUP BY size_bytes HAVING count(*) > 1)", "by_content AS (SELECT count(*) AS n FROM t WHERE read GROUP BY size_bytes, h HAVING count(*) > 1)", "by_stem AS (SELECT 1 FROM t GROUP BY name HAVING count(*) > 1)",
) + (
    "SELECT 'make_manifest' AS program, '1.0' AS version, '2026-04-04 v4.0' AS manifest_schema_version, '/lib' AS lib_root, '/lib/OCR_TXT' AS scan_root, '/lib/manifest.jsonl' AS out_manifest, count(*) AS rows_total, count(*) AS doc_id_eq_stem_stg1_ok, count(*) AS txt_abs_eq_full_path_stg1_ok, count(*) AS txt_rel_eq_rel_path_stg1_ok, 0::BIGINT AS mismatch_rows_logged, "
    + ", ".join([
        _SOME("dated", "year_from_stg1"), _SOME("late <> ''", "year_from_stg2"), _SOME("NOT dated AND late = ''", "year_fallback_to_raw_stg1"), _SOME("name_year IS NOT NULL", "stage1_year_found"), _SOME("name_year IS NULL", "stage1_year_missing"), _SOME("name_year = '1111'", "stage1_year_unknown_marker_1111"),
        _SOME("authors <> ''", "stage1_authors_found"), _SOME("authors = ''", "stage1_authors_missing"), _SOME("read", "text_read_ok"), "0::BIGINT AS text_not_found", _SOME("NOT read", "text_read_error"), _SOME("late <> ''", "year_stg2_found_rows"),
        *[_SOME(f"read AND {c} {op} ''", f"{c}_{k}_rows") for c in ("udc", "bbk") for k, op in (("found", "<>"), ("not_found", "="))],
        _SOME("src_kind = 'pdf'", "src_kind_pdf_rows"), _SOME("src_kind = 'djvu'", "src_kind_djvu_rows"), _SOME("src_kind IS NULL", "src_kind_not_determined_rows"), _SOME("size_bytes <= 65536", "small_file_count"), _SOME("size_bytes <= 512", "e5_candidate_file_count"), _SOME("size_bytes <= 512", "e5_analyzed_file_count"),
        _SOME("size_bytes <= 512 AND read AND tokens < 20", "e5_not_searchable_file_count"), _SOME("size_bytes <= 512 AND read AND tokens >= 20", "e5_searchable_file_count"),
    ])
    + ", (SELECT count(*) FROM by_stem) AS unique_collision_stems, (SELECT count(*) FROM by_content) AS same_size_same_content_group_count, (SELECT coalesce(sum(n), 0)::BIGINT FROM by_content) AS same_size_same_content_file_count, (SELECT coalesce(sum(n), 0)::BIGINT FROM by_size) AS total_files_in_size_groups, (SELECT count(*) FROM by_size) AS total_unique_sizes_with_duplicates, "
    "18::BIGINT AS size_distribution_bucket_count, 65536::BIGINT AS small_file_max_bytes, 512::BIGINT AS e5_small_scan_max_bytes, 20::BIGINT AS e5_min_search_tokens FROM t"
)
_FULL = "trim(s, ' ' || chr(9) || chr(13)) <> ''"
ORACLES["line_alignment"] = with_(
    DOCS, "each AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS s, generate_subscripts(string_split(text, chr(10)), 1) AS no FROM docs)",
    f"counted AS (SELECT *, {_FULL} AS filled, doc_id % 5 AS way, sum(({_FULL})::INT) OVER (PARTITION BY doc_id ORDER BY no) AS place, count(*) OVER (PARTITION BY doc_id) AS lines, sum(({_FULL})::INT) OVER (PARTITION BY doc_id) AS n FROM each)",
    # the second way has one entry more than there are filled lines: with one blank line on the page it fits by place, backwards
    "placed AS (SELECT c.*, CASE WHEN way = 1 AND n > 0 AND n + 1 = lines THEN CASE WHEN no = lines THEN 1 ELSE n + 1 - no END WHEN way <> 3 AND filled THEN place END AS source, way = 1 AND n > 0 AND (CASE WHEN n + 1 = lines THEN no = lines ELSE place = 1 AND filled END) AS again FROM counted c)",
) + "SELECT p.doc_id, p.no - 1 AS i, CASE WHEN p.way = 4 THEN p.no * 10 WHEN again THEN -1 ELSE f.no * 10 END AS mark, CASE WHEN p.way = 4 THEN length(p.s) ELSE length(f.s) END AS tokens FROM placed p LEFT JOIN counted f ON f.doc_id = p.doc_id AND f.filled AND f.place = p.source"
ORACLES["parse_modes"] = with_(DOCS, CODED, _LIBRARY) + "SELECT 'parse_mode' AS name, parse_mode AS value, count(*) AS n FROM lib GROUP BY 2 UNION ALL SELECT 'src_kind', src_kind, count(*) FROM lib GROUP BY 2"
_TITLE = "make_manifest same-size same-content report"
ORACLES["duplicates_text"] = with_(DOCS, FILES, _GROUPS, f"top AS (SELECT unnest(['{_TITLE}', '{'=' * len(_TITLE)}', '', 'group_count: ' || count(DISTINCT rg), 'file_count: ' || count(*), '']) AS value, unnest(range(6)) AS i FROM gg)") + (
    "SELECT 0::BIGINT AS section, 0::BIGINT AS a, 0::BIGINT AS b, '' AS c, i, value FROM top UNION ALL SELECT 1, rg, 0, '', 0, '[GROUP ' || rg || '] size_group_no=' || sg || ' size_bytes=' || size_bytes || ' files=' || n || ' | content_sha1=' || h FROM gg WHERE k = 1 UNION ALL SELECT 1, rg, n + 1, '', 0, '' FROM gg WHERE k = 1 "
    "UNION ALL SELECT 1, rg, k, '', 0, '  - #' || k || ' | size_group_no=' || sg || ' | size_bytes=' || size_bytes || ' | content_sha1=' || h || ' | doc_id=' || substr(sha1(txt_rel), 1, 16) || ' | sid=' || substr(sha1(txt_rel), 1, 16) || ' | txt_abs=' || txt_abs FROM gg"
)
ORACLES["library_pages"] = with_(DOCS, CODED, _LIBRARY, BOOKS, _PAGES) + (
    "SELECT printf('%s::p%05d', substr(sha1(txt_rel), 1, 16), page_no) AS chunk_id, substr(sha1(txt_rel), 1, 16) AS doc_id, txt_rel, src_kind, page_no AS page_start, page_no AS page_end, sha1(pages.text) AS text, nullif(authors, '') AS authors, title, name_year AS year, NULL::VARCHAR AS udc, NULL::VARCHAR AS bbk, strlen(books.text)::BIGINT AS size_bytes_txt "
    "FROM pages JOIN lib ON lib.id = pages.book JOIN books ON books.book = pages.book WHERE length(pages.text) >= 20"
)
