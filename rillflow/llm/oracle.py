"""SQL counterparts (DuckDB) of the queries that SQL can express."""

from __future__ import annotations

from rillflow.llm import quality_rules, url_filter

_SPACE = r"[\x20\x09-\x0D]+"
_WORD = r"[^\x20\x09-\x0D]+"

QUALITY_JUDGED = rf"""
docs AS (SELECT row_number() OVER () rid, *, coalesce(text, '') t FROM documents),
words AS (SELECT rid, list_filter(regexp_split_to_array(t, '{_SPACE}'), lambda x: x <> '') w FROM docs),
tri AS (
  SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] g
  FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) i FROM words WHERE len(w) >= 3)),
twice AS (SELECT rid, g FROM tri GROUP BY rid, g HAVING count(*) > 1),
repeats AS (
  SELECT rid, count(DISTINCT i + o) n_repeat_words
  FROM (SELECT rid, i, unnest([0, 1, 2]) o FROM tri SEMI JOIN twice USING (rid, g)) GROUP BY rid),
lines AS (
  SELECT rid, p, x, len(list_filter(regexp_split_to_array(x, '{_SPACE}'), lambda v: v <> '')) n
  FROM (SELECT rid, unnest(string_split(t, chr(10))) x, generate_subscripts(string_split(t, chr(10)), 1) p FROM docs)),
marked AS (
  SELECT *, n > 0 AND (
      length(regexp_replace(x, '[^#*$%&|<>{{}}\[\]~^=_\\]', '', 'g')) * 2 >= n
      OR (n > 20 AND NOT regexp_matches(x, '[.!?。！？।؟…:;]'))
      OR ((length(x) - length(regexp_replace(x, '(\||»|›| > |•|·)', '', 'g'))) * 4 >= n AND n >= 4)
      OR (len(regexp_split_to_array(x, '[!?]{{2,}}')) - 1) * 3 >= n
      OR n <= 20 AND regexp_matches(lower(x), '{quality_rules.BOILERPLATE}')) bad
  FROM lines),
per AS (
  SELECT rid, count(*) FILTER (n > 0) - count(DISTINCT x) FILTER (n > 0) n_dup_lines,
    count(*) FILTER (bad) n_lines_removed, coalesce(sum(n) FILTER (bad), 0)::BIGINT n_words_removed,
    coalesce(string_agg(x, chr(10) ORDER BY p) FILTER (NOT bad), '') clean_text
  FROM marked GROUP BY rid),
counted AS (
  SELECT d.*, len(w)::BIGINT n_words, length(regexp_replace(t, '{_SPACE}', '', 'g'))::BIGINT word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT n_symbols, n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT n_repeat_words, n_lines_removed, n_words_removed, clean_text
  FROM docs d JOIN words USING (rid) JOIN per USING (rid) LEFT JOIN repeats USING (rid)),
judged AS (
  SELECT *, (n_words < 50 OR n_repeat_words > 0.5 * n_words) base_failed,
    NOT (n_words < 50 OR n_repeat_words > 0.5 * n_words) AND n_words_removed <= 0.3 * n_words kept
  FROM counted)"""

OP8 = f"""WITH {QUALITY_JUDGED}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
  n_lines_removed, n_words_removed
FROM judged"""

OP6 = rf"""
WITH sized AS (
  SELECT doc_id, coalesce('0' || source, '1') k,
    len(list_filter(regexp_split_to_array(coalesce(text, ''), '{_SPACE}'), lambda x: x <> ''))::BIGINT size,
    md5('mix' || coalesce(doc_id::VARCHAR, 'null')) h
  FROM documents),
src AS (SELECT k, sum(size)::BIGINT s FROM sized GROUP BY k),
weighted AS (SELECT k, s, [5, 2, 1][((row_number() OVER (ORDER BY k) - 1) % 3 + 1)::INT] w FROM src),
levels AS (
  SELECT *, ((SELECT sum(s) FROM src) - coalesce(sum(3 * s) OVER (ORDER BY 3 * s / w, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / (sum(w) OVER (ORDER BY 3 * s / w, k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE l
  FROM weighted),
level AS (SELECT arg_min(l, (3 * s / w, k)) l FROM levels WHERE l <= 3 * s / w),
targets AS (SELECT k, s, least((3 * s)::DOUBLE, (SELECT l FROM level) * w) target FROM weighted),
placed AS (
  SELECT *, sum(size) OVER (PARTITION BY k ORDER BY h, doc_id, size ROWS UNBOUNDED PRECEDING)::BIGINT b,
    row_number() OVER () rid
  FROM sized JOIN targets USING (k)),
copies AS (
  SELECT rid, k, size, b, p, (s * p + b)::DOUBLE / target f
  FROM placed, (SELECT unnest([0, 1, 2]) p) WHERE size > 0 AND target > 0),
run AS (SELECT rid, size, sum(size) OVER (ORDER BY f, k, p, b ROWS UNBOUNDED PRECEDING) e FROM copies),
used AS (
  SELECT rid, sum(size)::BIGINT taken FROM run WHERE e <= (SELECT sum(s) FROM src) GROUP BY rid)
SELECT doc_id, size, s source_size, target, coalesce(taken, 0)::BIGINT taken
FROM placed LEFT JOIN used USING (rid)"""

_FITS = " UNION ALL ".join(
    f"SELECT '{r}' rule, '{v}' what, '{r[:r.index('/')]}' dom, '{r[r.index('/'):]}' start"
    for v, r in url_filter.RULES)
_TWO = ", ".join(f"'{x}'" for x in url_filter.SECOND_LEVEL)



def _worth(rows: str) -> str:
    """Pages that the priors m of `rows` (n, bad, m) are worth, by moments."""
    return f"""SELECT 1 / least(greatest(coalesce(sum(n * (bad / n - m) ** 2 - m * (1 - m)) / nullif(sum((n - 1) * m * (1 - m)), 0), 0),
    0.000001), 0.5) - 1 s FROM {rows} WHERE n > 0"""


OP10 = rf"""
WITH rules AS ({_FITS}),
cut AS (
  SELECT row_number() OVER () rid, page_id,
    CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END rest FROM pages),
parts AS (
  SELECT rid, page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) path FROM cut),
fitting AS (
  SELECT rid, arg_max(rule, length(rule)) rule, arg_max(what, length(rule)) what
  FROM parts JOIN rules ON (host = dom OR ends_with(host, '.' || dom)) AND starts_with(path, start) GROUP BY rid),
known AS (SELECT doc_id page_id, count(*) n, sum((quality = 0 OR toxic = 1)::INT) bad FROM labels GROUP BY ALL),
seen AS (
  SELECT host, coalesce(sum(n), 0)::BIGINT n, coalesce(sum(bad), 0)::BIGINT bad
  FROM parts LEFT JOIN known USING (page_id) GROUP BY host),
named AS (SELECT *, regexp_replace(host, ':\d*$', '') nm, string_split(regexp_replace(host, ':\d*$', ''), '.') a FROM seen),
two AS (SELECT *, len(a) >= 3 AND length(a[-1]) = 2 AND a[-2] IN ({_TWO}) tw, regexp_matches(nm, '^[0-9.]+$') num FROM named),
lv AS (
  SELECT host, n, bad,
    CASE WHEN num THEN '' WHEN tw THEN array_to_string(a[-2:], '.') ELSE a[-1] END suffix,
    CASE WHEN num THEN nm WHEN tw THEN array_to_string(a[-3:], '.') ELSE array_to_string(a[-2:], '.') END dom FROM two),
level0 AS (SELECT coalesce(sum(n), 0) n0, coalesce(sum(bad), 0) b0 FROM lv),
level1 AS (SELECT suffix, sum(n) n1, sum(bad) b1 FROM lv GROUP BY ALL),
level2 AS (SELECT suffix, dom, sum(n) n2, sum(bad) b2 FROM lv GROUP BY ALL),
prior1 AS (SELECT *, n1 n, b1 bad, (b0 - b1 + 0.5) / (n0 - n1 + 1) m FROM level1, level0),
s1 AS ({_worth("prior1")}),
prior2 AS (
  SELECT *, n2 n, b2 bad, (b1 - b2 + s1.s * (b0 - b2 + 0.5) / (n0 - n2 + 1)) / (n1 - n2 + s1.s) m
  FROM level2 JOIN level1 USING (suffix), level0, s1),
s2 AS ({_worth("prior2")}),
prior3 AS (
  SELECT host, n, bad, (b2 - bad + s2.s * (b1 - bad + s1.s * (b0 - bad + 0.5) / (n0 - n + 1)) / (n1 - n + s1.s)) / (n2 - n + s2.s) m
  FROM lv JOIN level2 USING (suffix, dom) JOIN level1 USING (suffix), level0, s1, s2),
s3 AS ({_worth("prior3")}),
beta AS (SELECT host, n, bad, bad + s * m a, n - bad + s * (1 - m) b, (b0 + 0.5) / (n0 + 1) t FROM prior3, s3, level0),
sides AS (SELECT *, t < a / (a + b) low, CASE WHEN low THEN a ELSE b END p, CASE WHEN low THEN b ELSE a END q, CASE WHEN low THEN t ELSE 1 - t END x FROM beta),
tails AS (
  SELECT *, list_sum(list_transform(range(0, 20000), lambda i:
    exp(lgamma(p + q + i) - lgamma(p + 1 + i) - lgamma(q) + (p + i) * ln(x) + q * ln(1 - x)))) tail FROM sides),
post AS (SELECT host, n, bad, a / (a + b) mean, CASE WHEN low THEN 1 - tail ELSE tail END worse FROM tails)
SELECT page_id, host, path, rule, coalesce(what, CASE WHEN worse >= 0.95 THEN 'block' ELSE 'allow' END) verdict,
  n::BIGINT host_labelled, bad::BIGINT host_bad, floor(mean * 1000000)::BIGINT host_rate_ppm, floor(worse * 1000)::BIGINT host_worse_milli
FROM parts JOIN post USING (host) LEFT JOIN fitting USING (rid)"""

#: Lines in a run of equal consecutive lines (blank ones aside) with an earlier copy and 50 words or more.
LINES_CUT = rf"""
lines0 AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) x,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 i FROM documents),
lines1 AS (SELECT *, list_filter(regexp_split_to_array(x, '{_SPACE}'), lambda w: w <> '') ws FROM lines0),
filled AS (
  SELECT doc_id, i, array_to_string(ws, ' ') norm, len(ws) n, row_number() OVER d k
  FROM lines1 WHERE len(ws) > 0 WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
same AS (
  SELECT a.doc_id, a.i, a.n, a.k, b.doc_id other, a.k - b.k shift
  FROM filled a JOIN filled b ON a.norm = b.norm AND (b.doc_id, b.k) < (a.doc_id, a.k)),
runs AS (
  SELECT doc_id, i, sum(n) OVER (PARTITION BY doc_id, other, shift, isle) total
  FROM (SELECT *, k - row_number() OVER (PARTITION BY doc_id, other, shift ORDER BY k) isle FROM same)),
gone AS (SELECT DISTINCT doc_id, i FROM runs WHERE total >= 50),
cut AS (
  SELECT l.doc_id, count(*) n_lines, count(g.i) n_removed,
    coalesce(string_agg(g.i::VARCHAR, ',' ORDER BY l.i), '') removed,
    coalesce(string_agg(x, chr(10) ORDER BY l.i) FILTER (g.i IS NULL), '') text
  FROM lines0 l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.i = g.i GROUP BY l.doc_id)"""

OP5 = f"WITH {LINES_CUT} SELECT * FROM cut"

SQL = {"op5_winnowed_lines": OP5, "op6_fair_mix": OP6, "op8_line_first_cleaning": OP8, "op10_host_reputation": OP10}
