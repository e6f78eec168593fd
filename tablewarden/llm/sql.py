"""SQL twins of the text queries, for DuckDB: plain statements of what each result is, without the operators' steps."""

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

DECONTAMINATION = rf"""
with w as (
  select doc_id, row_number() over () as r,
    regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
  from documents),
i as (
  select item_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
  from benchmark),
iw as (
  select distinct item_id, least(len(words), 10) as n,
    array_to_string(words[s + 1:s + least(len(words), 10)], ' ') as win
  from (select item_id, words, unnest(range(len(words) - least(len(words), 10) + 1)) as s from i where len(words) > 0)),
lengths as (select distinct n from iw),
dw as (
  select r, s, n, array_to_string(words[s + 1:s + n], ' ') as win
  from (select r, words, n, unnest(range(len(words) - n + 1)) as s from w, lengths where len(words) >= n)),
hit as (select distinct d.r, d.s, d.n, iw.item_id from dw d join iw on d.win = iw.win and d.n = iw.n),
pos as (select r, count(distinct p) as n_hit from (select r, unnest(range(s, s + n)) as p from hit) group by r),
it as (
  select r, count(*) as n_items, string_agg(item, ',' order by item) as items
  from (select distinct r, cast(item_id as varchar) as item from hit where item_id is not null) group by r)
select w.doc_id, cast(len(w.words) as bigint) as n_words, coalesce(pos.n_hit, 0) as n_hit,
  coalesce(it.n_items, 0) as n_items, sha256(coalesce(it.items, '')) as items_sha256,
  coalesce(pos.n_hit, 0) > 0 as contaminated
from w left join pos using (r) left join it using (r)
"""

NGRAM_CLASSES = rf"""
with recursive w as (
  select doc_id, list_filter(regexp_split_to_array({LOWER.format("coalesce(text, '')")}, '[\x20\x09-\x0D]+'),
    lambda x: x <> '') as words
  from documents),
s as (
  select doc_id, case when len(words) = 0 then []
    when len(words) < 5 then [array_to_string(words, ' ')]
    else list_distinct(list_transform(range(len(words) - 4), lambda i: array_to_string(words[i + 1:i + 5], ' '))) end as set
  from w),
sized as (select doc_id, len(set) as n, set from s),
one as (select doc_id, n, unnest(set) as g from sized),
pairs as (
  select a.doc_id as x, b.doc_id as y, any_value(a.n) as nx, any_value(b.n) as ny, count(*) as common
  from one a join one b on a.g = b.g and a.doc_id <> b.doc_id group by 1, 2),
link as (select x, y from pairs where 100 * common >= 75 * (nx + ny - common)),
reach(x, y) as (select x, y from link union select r.x, l.y from reach r join link l on r.y = l.x),
least as (select x, min(y) as y from reach group by x)
select sized.doc_id, cast(sized.n as bigint) as n_shingles,
  least(sized.doc_id, coalesce(least.y, sized.doc_id)) as component_id
from sized left join least on least.x = sized.doc_id
"""

LINE_DEDUP = r"""
with l as (
  select doc_id, line, content, list_filter(regexp_split_to_array(content, '[\x20\x09-\x0D]+'), lambda x: x <> '') as words
  from (select doc_id, unnest(range(len(lines))) as line, unnest(lines) as content
    from (select doc_id, string_split(text, chr(10)) as lines from documents where text is not null))),
t as (
  select doc_id, line, row_number() over (order by doc_id, line) as r,
    case when len(words) < 5 then [array_to_string(words, ' ')]
      else list_distinct(list_transform(range(len(words) - 4), lambda i: array_to_string(words[i + 1:i + 5], ' '))) end
      as tokens
  from l where len(words) > 0),
u as (select min(r) as r, any_value(tokens) as tokens from (select r, tokens, list_sort(tokens) as k from t) group by k),
g as (select r, len(tokens) as n, unnest(tokens) as token from u),
m as (
  select b.r, a.r as before, any_value(a.n) as na, any_value(b.n) as nb, count(*) as common
  from g a join g b on a.token = b.token and a.r < b.r group by 1, 2),
near as (select distinct r from m where 100 * common >= 75 * (na + nb - common)),
gone as (
  select doc_id, line from t join near using (r)
  union select doc_id, line from t where r not in (select r from u)),
kept as (
  select l.doc_id, string_agg(content, chr(10) order by l.line) as kept
  from l left join gone using (doc_id, line) where gone.line is null group by l.doc_id),
n as (select doc_id, count(*) as n_lines from t group by 1),
x as (select doc_id, count(*) as n_removed from gone group by 1)
select d.doc_id, coalesce(n.n_lines, 0) as n_lines, coalesce(x.n_removed, 0) as n_removed,
  sha256(coalesce(kept.kept, '')) as kept_sha256
from documents d left join n using (doc_id) left join x using (doc_id) left join kept using (doc_id)
"""

SPELLING = """
WITH RECURSIVE marks AS (  -- crc32 of one byte, by its polynomial
    SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i::UBIGINT, range(8)::UBIGINT[]),
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END)) AS t
), runs AS (
    SELECT coalesce(doc_id::VARCHAR, '') || ':' AS head, run, count(*) AS times
    FROM (SELECT doc_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]{5,}')) AS run FROM documents)
    GROUP BY ALL
), hashed AS (
    SELECT run, times, xor(4294967295::UBIGINT, list_reduce(list_prepend(4294967295::UBIGINT,
        flatten(list_transform(string_split(head || run, ''), lambda c:
            CASE WHEN ord(c) < 128 THEN [ord(c)] ELSE [195, ord(c) - 64] END))::UBIGINT[]),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255)::BIGINT + 1]))) AS h
    FROM runs, marks
), words AS (
    SELECT CASE WHEN h % 97 = 0 THEN left(run, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2)
           ELSE run END AS word, sum(times)::BIGINT AS n
    FROM hashed GROUP BY 1 HAVING length(word) >= 5 AND n >= 3
), cuts AS (
    SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS cut
    FROM words, unnest(range(1, length(word) + 1)) AS r(i)
), pairs AS (
    SELECT a.word, b.word AS near, b.n AS near_n FROM cuts a JOIN cuts b ON a.cut = b.cut AND a.i = b.i AND a.word <> b.word
    UNION SELECT w.word, c.word, c.n FROM words w JOIN cuts c ON w.word = c.cut
    UNION SELECT c.word, w.word, w.n FROM words w JOIN cuts c ON w.word = c.cut
), best AS (
    SELECT *, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS k
    FROM pairs
), formed AS (
    SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.near_n >= 2 * w.n THEN b.near END AS form,
           CASE WHEN b.near_n >= 2 * w.n THEN b.near_n END AS form_n
    FROM words w LEFT JOIN best b ON w.word = b.word AND b.k = 1
), chains AS (
    SELECT word, word AS at FROM words
    UNION ALL SELECT c.word, f.form FROM chains c JOIN formed f ON c.at = f.word WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, c.at AS root, f.n, f.n_near, f.form_n
FROM formed f JOIN chains c USING (word) JOIN formed e ON e.word = c.at AND e.form IS NULL
"""
