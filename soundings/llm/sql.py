"""DuckDB SQL for the operators that SQL can express over whole tables."""

from .queries import LISTED_DIGIT
from .quality import STOP_WORDS

_BLANK = r"[\x20\x09-\x0D]"

_STOPS = ", ".join(f"'{w}'" for word in sorted(set(STOP_WORDS.split())) for w in (word, word.capitalize()))

OP4 = rf"""
with d as (select doc_id, coalesce(text, '') as t from documents),
w as (select doc_id, t, list_filter(regexp_split_to_array(t, '{_BLANK}+'), lambda x: x <> '') as ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_replace(x, '{_BLANK}', '', 'g') <> '') as ls from d),
g as (select doc_id, i, array_to_string(ws[i + 1:i + 5], ' ') as g
      from (select doc_id, ws, unnest(range(0, len(ws) - 4)) as i from w)),
dup as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, g) as c from g) where c > 1),
rep as (select doc_id, count(distinct i + k) as n from dup, (select unnest(range(0, 5)) as k) group by doc_id),
m as (select w.doc_id, len(ws) as n_words, length(regexp_replace(t, '{_BLANK}', '', 'g')) as word_chars,
             length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as n_symbols,
             len(ls) as n_lines, len(ls) - len(list_distinct(ls)) as n_dup_lines, coalesce(rep.n, 0) as n_repeat_words,
             len(list_filter(ws, lambda x: regexp_replace(x, '[.,;:!?"()]', '', 'g') in ({_STOPS}))) as n_stop,
             len(list_filter(ws, lambda x: length(x) > 1 and x = upper(x) and x <> lower(x))) as n_shout
      from w left join rep on rep.doc_id = w.doc_id),
v as (select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed, greatest(n_words, 1) as k from m)
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols,
       n_dup_lines::bigint as n_dup_lines, n_repeat_words::bigint as n_repeat_words, base_failed,
       not base_failed and n_words between 10 and 100000 and word_chars / k between 2 and 14 and n_symbols / k <= 0.1
       and n_dup_lines / greatest(n_lines, 1) <= 0.5 and n_stop / k >= 0.02 and n_shout / k <= 0.5 as kept
from v
"""

OP5 = rf"""
with p as (select page_id, translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
                  regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) as path from pages),
k as (select *, regexp_replace(host, '^www\.', '') || regexp_replace(path, '(?:\.html?|/+)$', '') as key from p),
listed as (select distinct key from k where md5(key)[1] = '{LISTED_DIGIT}' and key <> ''),
r as (select *, case when (host = 'example.net' or ends_with(host, '.example.net')) and starts_with(path, '/en/') then 'example.net/en/'
                     when (host = 'example.com' or ends_with(host, '.example.com')) and starts_with(path, '/de/') then 'example.com/de/'
                     when (host = 'org' or ends_with(host, '.org')) and starts_with(path, '/fr/') then 'org/fr/'
                     when (host = 'net' or ends_with(host, '.net')) and starts_with(path, '/') then 'net/' end as rule from k)
select page_id, host, path, rule,
       case when rule in ('example.net/en/', 'org/fr/') then 'allow' when rule is not null then 'block'
            when key in (select key from listed) then 'block' else 'allow' end as verdict
from r
"""

OP2 = rf"""
with l0 as (select doc_id, text, string_split(text, chr(10)) as ls from documents where text is not null),
l1 as (select doc_id, unnest(ls) as line, unnest(range(0, len(ls))) as ln from l0),
l2 as (select doc_id, ln, line, len(list_filter(regexp_split_to_array(line, '{_BLANK}+'), lambda x: x <> '')) as nw from l1),
l3 as (select *, sum(nw) over (partition by doc_id order by ln) as e from l2 where nw > 0),
l as (select *, e - nw as s from l3),
win as (select doc_id, ln as f, max(ln) over a as t, max(e) over a - s as n, 0 as side, list(line) over a as c from l
        window a as (partition by doc_id order by s range between current row and 49 following)
        union all
        select doc_id, min(ln) over b, ln, e - min(s) over b, 1, list(line) over b from l
        window b as (partition by doc_id order by e range between 49 preceding and current row)),
ranked as (select *, min((doc_id, f)) over (partition by side, c) as src from win where n >= 50),
spans as (select distinct doc_id, f, t from ranked where src <> (doc_id, f)),
gone as (select distinct doc_id, x as ln from (select doc_id, unnest(range(f, t + 1)) as x from spans)),
kept as (select l1.doc_id, string_agg(l1.line, chr(10) order by l1.ln) as text from l1 anti join gone on gone.doc_id = l1.doc_id and gone.ln = l1.ln group by l1.doc_id),
n as (select doc_id, count(*) as n from gone group by doc_id),
o as (select d.doc_id, case when d.text is null then null else coalesce(kept.text, '') end as text,
             case when d.text is null then 0 else len(string_split(d.text, chr(10))) end as n_lines, coalesce(n.n, 0) as n_deleted
      from documents d left join kept on kept.doc_id = d.doc_id left join n on n.doc_id = d.doc_id)
select doc_id, n_lines::bigint as n_lines, n_deleted::bigint as n_deleted,
       coalesce(n_deleted > 0 and regexp_replace(text, '{_BLANK}', '', 'g') = '', false) as emptied,
       length(text)::bigint as n_chars_kept, md5(text) as text_md5
from o
"""

_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP12 = rf"""
with d as (select doc_id, list_filter(regexp_split_to_array({_FOLDED}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as ws from documents),
i as (select list_filter(regexp_split_to_array({_FOLDED}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as ws from benchmark),
dw as (select doc_id, w, count(*) as n from (select doc_id, unnest(ws) as w from d) group by doc_id, w),
iw as (select w, count(*) as n from (select unnest(ws) as w from i) group by w),
t as (select list_transform(range(0, 256), lambda b: list_reduce(range(0, 8), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, b)) as t),
b as (select w, list_transform(range(0, strlen(w)), lambda k: ('0x' || hex(encode(w))[2 * k + 1:2 * k + 2])::bigint) as b from (select w from dw union select w from iw)),
h as (select w, xor(list_reduce(b, lambda c, x: xor(c >> 8, t[xor(c & 255, x) + 1]), 4294967295), 4294967295) % 10000 as k from b, t),
s as (select k, sum(n)::bigint as s from dw join h using (w) group by k),
u as (select k, sum(n)::bigint as t from iw join h using (w) group by k),
a as (select (select coalesce(sum(n), 0)::bigint from dw) as sa, (select coalesce(sum(n), 0)::bigint from iw) as ta),
g as (select s.k, floor(1000 * ln(((coalesce(t, 0) + 1)::double * (sa + 10000)::double) / ((s + 1)::double * (ta + 10000)::double)))::bigint as g from s left join u on u.k = s.k, a),
m as (select doc_id, sum(n)::bigint as n, sum(n * g)::bigint as g from dw join h using (w) join g using (k) group by doc_id),
f as (select d.doc_id, len(ws) as n_words, coalesce(n, 0) as n_features, case when n is null then 0 when g >= 0 then g // n else -((-g + n - 1) // n) end as weight,
             ('0x' || substr(sha256('2024:' || coalesce(d.doc_id::varchar, '')), 1, 8))::bigint as h
      from d left join m on m.doc_id = d.doc_id),
r as (select *, weight + floor(-1000 * ln(-ln((h + 0.5::double) / 4294967296::double)))::bigint as score from f),
o as (select doc_id, row_number() over (order by score desc, doc_id) as rank from r where n_words >= 20),
c as (select 10 * count(*) // 100 as c from r where n_words >= 20)
select r.doc_id, n_features::bigint as n_features, weight::bigint as weight, score, case when rank <= c then rank end as rank
from r left join o on o.doc_id = r.doc_id, c
"""

_TERMS = rf"regexp_split_to_array({_FOLDED}, '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

OP13 = rf"""
with d as (select doc_id, unnest({_TERMS}) as w from documents),
tf as (select doc_id, w, count(*) as tf from d where w <> '' group by doc_id, w),
n as (select doc_id, sum(tf)::bigint as n from tf group by doc_id),
a as (select count(*) as c, sum(n)::bigint as l from n),
q as (select item_id, w, count(*) as q from (select item_id, unnest({_TERMS}) as w from benchmark) where w <> '' group by item_id, w),
w as (select w, floor(1000 * ln((2 * c + 2)::double / (2 * count(*) + 1)::double))::bigint as weight from tf, a group by w, c),
s as (select q.item_id, tf.doc_id, sum(q * weight * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * c) // l))))::bigint as score
      from q join tf using (w) join w using (w) join n on n.doc_id = tf.doc_id, a group by q.item_id, tf.doc_id),
r as (select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from s where score > 0)
select item_id, rank::int as rank, doc_id, score from r where rank <= 10
"""

ORACLE = {"op12_importance": OP12, "op13_lexical_search": OP13, "op2_line_dedup": OP2, "op4_quality_rules": OP4, "op5_url_filters": OP5}
