"""SQL over the same tables that gives the same rows as a query."""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

OP5 = """
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) x
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
), scored as (
  select q.vec_id query_id, c.vec_id vec_id,
    cast(list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2])) as bigint) score
  from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 100 = 0
), ranked as (
  select *, row_number() over (partition by query_id order by score desc, vec_id) rn from scored
)
select query_id, cast(rn as integer) rank, vec_id, score from ranked where rn <= 10
"""

OP7 = f"""
with d as (select doc_id, {_WORDS} w from documents),
b as (select item_id, {_WORDS} w from benchmark),
bw as (
  select item_id, least(10, len(w)) n, unnest(range(1, len(w) - least(10, len(w)) + 2)) pos, w from b where len(w) > 0
), windows as (select distinct item_id, n, array_to_string(w[pos:pos + n - 1], ' ') t from bw),
spots as (
  select doc_id, l.n, unnest(range(1, len(w) - l.n + 2)) pos, w
  from d, (select distinct n from windows) l where len(w) >= l.n
), hits as (
  select doc_id, s.n, pos, item_id from (select doc_id, n, pos, array_to_string(w[pos:pos + n - 1], ' ') t from spots) s
  join windows x on x.n = s.n and x.t = s.t
), words_hit as (
  select doc_id, count(distinct p) n_hit from (select doc_id, unnest(range(pos, pos + n)) p from hits) group by 1
), found as (
  select doc_id, count(distinct item_id) n_items,
    string_agg(distinct cast(item_id as varchar), ',' order by cast(item_id as varchar)) ids
  from hits group by 1
)
select d.doc_id, cast(len(w) as bigint) n_words, coalesce(n_hit, 0) n_hit, coalesce(n_items, 0) n_items,
  sha256(coalesce(ids, '')) items_sha256, n_hit is not null contaminated
from d left join words_hit h on h.doc_id = d.doc_id left join found f on f.doc_id = d.doc_id
"""


def lines_gone(documents: str) -> str:
    """Common table expressions that end in `split` (lines of each document) and `gone` (lines that go)."""
    return f"""
split as (
  select doc_id, unnest(range(1, len(ls) + 1)) no, unnest(ls) line
  from (select doc_id, string_split(coalesce(text, ''), chr(10)) ls from {documents})
), worded as (
  select doc_id, no, list_sort(list_distinct(list_filter(string_split(line, ' '), lambda x: x <> ''))) w from split
), one as (
  select w, len(w) n, row_number() over () s, min(struct_pack(doc_id := doc_id, no := no)) f
  from worded where len(w) > 0 group by w
), tokens as (select s, n, unnest(w) t from one),
common as (
  select a.s a, b.s b, a.n an, b.n bn, count(*) c from tokens a join tokens b
    on a.t = b.t and a.s <> b.s and a.n * 100 >= b.n * 75 and b.n * 100 >= a.n * 75
  group by all
), bound as (
  select s, min(f) f from (
    select s, f from one
    union all
    select c.a, o.f from common c join one o on o.s = c.b where c.c * 100 >= 75 * (c.an + c.bn - c.c)
  ) group by s
), gone as (
  select x.doc_id, x.no from worded x join one o on o.w = x.w join bound b on b.s = o.s
  where struct_pack(doc_id := x.doc_id, no := x.no) > b.f
)"""


OP8 = f"""
with {lines_gone("documents")}
select s.doc_id, count(*) n_lines, count(g.no) n_removed,
  sha256(coalesce(string_agg(s.line, chr(10) order by s.no) filter (where g.no is null), '')) kept_sha256
from split s left join gone g on g.doc_id = s.doc_id and g.no = s.no group by s.doc_id
"""

OP11 = r"""
with t as (
  select doc_id, length(coalesce(text, '')) n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') k
  from documents
)
select doc_id, first_value(doc_id) over best keep_id, count(*) over (partition by k) group_size,
  row_number() over best = 1 kept, sha256(k) text_sha256
from t window best as (partition by k order by n desc, doc_id nulls last)
"""

OP12 = f"""
with d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') w, row_number() over () s from documents),
b as (
  select distinct item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) t
  from benchmark
),
totals as (select count(*) filter (len(w) > 0) n_docs, cast(sum(len(w)) as bigint) n_terms from d),
postings as (
  select s, t, count(*) tf from (select s, unnest(w) t from d) where t in (select t from b) group by s, t
),
weights as (
  select t, cast(floor(1000 * ln((2.0::double * n_docs + 2) / (2.0::double * df + 1))) as bigint) w
  from (select t, count(*) df from postings group by t), totals
),
scored as (
  select item_id, d.doc_id, s,
    cast(sum(weights.w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * len(d.w) * n_docs) // n_terms)))) as bigint) score
  from b join weights using (t) join postings using (t) join d using (s), totals
  group by item_id, d.doc_id, s
)
select item_id, cast(row_number() over best as integer) rank, doc_id, score
from scored where score > 0
window best as (partition by item_id order by score desc, doc_id nulls last)
qualify row_number() over best <= 10
"""

OP13 = f"""
with pieces as (
  select coalesce(lang, 'und') lang, unnest(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
    '[.,;:!?\\x0A-\\x0D]')) piece
  from documents
),
words as (
  select lang, row_number() over () s, regexp_extract_all(piece, '[^\\x20\\x09]+') w from pieces
),
spots as (select lang, s, w, unnest(range(1, len(w) + 1)) i from words),
f1 as (select lang, w[i] p, count(*) f from spots group by 1, 2),
f2 as (select lang, w[i] p1, w[i + 1] p2, count(*) f from spots where i + 1 <= len(w) group by 1, 2, 3 having count(*) >= 10),
f3 as (
  select lang, w[i] p1, w[i + 1] p2, w[i + 2] p3, count(*) f from spots where i + 2 <= len(w) group by 1, 2, 3, 4
  having count(*) >= 10
),
c2 as (
  select f2.lang, f2.p1, f2.p2, f2.f a, x.f l, y.f r,
    cast(1000000::hugeint * f2.f * f2.f // (x.f::hugeint * y.f) as bigint) score
  from f2 join f1 x on x.lang = f2.lang and x.p = f2.p1 join f1 y on y.lang = f2.lang and y.p = f2.p2
),
c3 as (
  select f3.lang, f3.p1, f3.p2, f3.p3, f3.f a, x.f l1, yz.f r1, xy.f l2, z.f r2,
    cast(1000000::hugeint * f3.f * f3.f // (x.f::hugeint * yz.f) as bigint) s1,
    cast(1000000::hugeint * f3.f * f3.f // (xy.f::hugeint * z.f) as bigint) s2
  from f3 join f1 x on x.lang = f3.lang and x.p = f3.p1
  join f2 yz on yz.lang = f3.lang and yz.p1 = f3.p2 and yz.p2 = f3.p3
  join f2 xy on xy.lang = f3.lang and xy.p1 = f3.p1 and xy.p2 = f3.p2
  join f1 z on z.lang = f3.lang and z.p = f3.p3
),
longest as (
  select lang, p1, p2, max(f) f
  from (select lang, p1, p2, f from f3 union all select lang, p2, p3, f from f3) group by 1, 2, 3
),
phrases as (
  select lang, p1 || ' ' || p2 phrase, a, l, r, score from c2 left join longest g using (lang, p1, p2)
  where coalesce(100 * g.f < 50 * a, true)
  union all
  select lang, p1 || ' ' || p2 || ' ' || p3, a, case when s1 <= s2 then l1 else l2 end,
    case when s1 <= s2 then r1 else r2 end, least(s1, s2)
  from c3
)
select lang, cast(row_number() over best as integer) rank, phrase, a, l, r, n, score
from phrases join (select lang, cast(sum(f) as bigint) n from f1 group by lang) using (lang)
window best as (partition by lang order by score desc, a desc, phrase)
qualify row_number() over best <= 2000
"""
