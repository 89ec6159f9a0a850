"""The queries of this package in SQL for DuckDB, where SQL can express them."""

LLM_ORACLE: dict[str, str] = {}

_BASE32 = """array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((cast('0x' || substr(digest, 1 + 5 * (i // 4)::INT, 5) as INT) >> (15 - 5 * (i % 4)::INT)) & 31), 1)), '')"""

LLM_ORACLE["op5_warc"] = f"""
with payloads as (select page_id, coalesce(html, '') as payload from pages),
known as (
    select page_id, strlen(payload) as payload_bytes, sha1(payload) as digest, max(page_id) over (partition by payload) as response
    from payloads
)
select page_id, payload_bytes, {_BASE32} as payload_digest,
    case when page_id is not distinct from response then 'response' else 'revisit' end as record_type,
    case when page_id is distinct from response then response end as refers_to
from known
"""

_SUM = "list_reduce({}, lambda a, b: a + b)"
_DOT = _SUM.format("list_transform(list_zip({0}, {1}), lambda p: p[1] * p[2])")
LLM_ORACLE["op6_nearest_neighbours"] = f"""
with usable as (
    select distinct vec_id, embedding::DOUBLE[] as v from embeddings
    where vec_id is not null and embedding is not null and len(embedding) > 0
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        and len(list_filter(embedding, lambda x: x <> 0)) > 0
),
queries as (select vec_id, min(v) as v from usable where vec_id % 50 = 0 group by vec_id),
scored as (
    select q.vec_id as query_id, c.vec_id,
        max({_DOT.format('q.v', 'c.v')} / (sqrt({_DOT.format('q.v', 'q.v')}) * sqrt({_DOT.format('c.v', 'c.v')}))) as score
    from queries q join usable c on q.vec_id <> c.vec_id and len(q.v) = len(c.v) group by 1, 2
),
ranked as (select *, row_number() over (partition by query_id order by score desc, vec_id)::INT as rank from scored)
select query_id, rank, vec_id, score from ranked where rank <= 5
"""

LLM_ORACLE["op1_ngram_jaccard_join"] = r"""
with recursive words as (
    select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') as w from documents
),
shingles as (
    select doc_id, case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
        else list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) end as s from words
),
rows_ as (select doc_id, unnest(s) as g from shingles),
pairs as (
    select a.doc_id as a, b.doc_id as b, count(*) as both_ from rows_ a join rows_ b on a.g = b.g and a.doc_id <> b.doc_id group by 1, 2
),
links as (
    select p.a, p.b from pairs p join shingles x on x.doc_id = p.a join shingles y on y.doc_id = p.b
    where 100 * both_ >= 80 * (len(x.s) + len(y.s) - both_)
),
reach as (select doc_id as a, doc_id as b from documents union select r.a, l.b from reach r join links l on r.b = l.a)
select s.doc_id, len(s.s) as n_shingles, min(r.b) as component_id from shingles s join reach r on r.a = s.doc_id group by all
"""

LLM_ORACLE["op2_line_dedup"] = """
with split as (select doc_id, string_split(text, chr(10)) as ls from documents),
lines as (select doc_id, unnest(ls) as txt, generate_subscripts(ls, 1) as pos from split),
pairs as (
    select doc_id, pos, row_number() over (partition by txt, nxt order by doc_id, pos) > 1 as is_copy
    from (select *, lead(txt) over (partition by doc_id order by pos) as nxt, lead(pos) over (partition by doc_id order by pos) as b from lines)
    where b is not null
),
gone as (select distinct doc_id, unnest([pos, pos + 1]) as pos from pairs where is_copy)
select s.doc_id, coalesce(len(ls), 0) as n_lines, count(g.pos) as n_removed,
    sha256(coalesce(string_agg(l.txt, chr(10) order by l.pos) filter (g.pos is null), '')) as kept_sha256
from split s left join lines l on l.doc_id = s.doc_id left join gone g on g.doc_id = l.doc_id and g.pos = l.pos
group by s.doc_id, ls
"""

# As op2_line_dedup, and a line of 50 words or more is a run by itself.
LLM_ORACLE["op2_line_dedup_long_lines"] = r"""
with split as (select doc_id, string_split(text, chr(10)) as ls from documents),
lines as (select doc_id, unnest(ls) as txt, generate_subscripts(ls, 1) as pos from split),
pairs as (
    select doc_id, pos, row_number() over (partition by txt, nxt order by doc_id, pos) > 1 as is_copy
    from (select *, lead(txt) over (partition by doc_id order by pos) as nxt, lead(pos) over (partition by doc_id order by pos) as b from lines)
    where b is not null
),
long as (
    select doc_id, pos, row_number() over (partition by txt order by doc_id, pos) > 1 as is_copy from lines
    where len(list_filter(string_split_regex(txt, '[\x20\x09-\x0D]+'), lambda w: w <> '')) >= 50
),
gone as (
    select doc_id, unnest([pos, pos + 1]) as pos from pairs where is_copy union select doc_id, pos from long where is_copy
)
select s.doc_id, coalesce(len(ls), 0) as n_lines, count(g.pos) as n_removed,
    sha256(coalesce(string_agg(l.txt, chr(10) order by l.pos) filter (g.pos is null), '')) as kept_sha256
from split s left join lines l on l.doc_id = s.doc_id left join gone g on g.doc_id = l.doc_id and g.pos = l.pos
group by s.doc_id, ls
"""
