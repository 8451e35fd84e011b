"""DuckDB SQL for the queries that SQL can express.

The others (a tokenizer, XXH64, learnt models, a parser) are tested against brute
force, round trips or held-out labels in tests/llm.
"""

from __future__ import annotations

from medoria.llm.chat import END, NEXT, START, TEXT
from medoria.llm.urls import LOWER, UPPER

_TOP_K = """
with v as (
    select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
    from embeddings
    where embedding is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
scored as (
    select q.vec_id as query_id, c.vec_id,
           cast(coalesce(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])), 0) as bigint) as score
    from v q join v c on q.vec_id <> c.vec_id and len(q.v) = len(c.v)
    where q.vec_id % 50 = 0
),
ranked as (
    select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank from scored
)
select query_id, rank, vec_id, score from ranked where rank <= 5
"""

_WORDS = rf"regexp_extract_all(translate({{}}, '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_CONTAMINATION = f"""
with items as (
    select item_id, {_WORDS.format("text")} as w from benchmark where text is not null
),
windows as (
    select distinct item_id, len(w[k:k + 9]) as n, array_to_string(w[k:k + 9], ' ') as s
    from (select item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) as k from items where len(w) > 0)
),
docs as (
    select doc_id, {_WORDS.format("coalesce(text, '')")} as w from documents
),
places as (
    select doc_id, w, unnest(range(1, len(w) + 1)) as k from docs
),
found as (
    select p.doc_id, p.k, l.n, x.item_id
    from places p
    join (select distinct n from windows) l on p.k + l.n - 1 <= len(p.w)
    join windows x on x.n = l.n and x.s = array_to_string(p.w[p.k:p.k + l.n - 1], ' ')
),
hits as (
    select doc_id, count(distinct h) as n_hit
    from (select doc_id, unnest(range(k, k + n)) as h from (select distinct doc_id, k, n from found))
    group by doc_id
),
names as (
    select doc_id, count(*) as n_items, string_agg(cast(item_id as varchar), ',' order by cast(item_id as varchar)) as s
    from (select distinct doc_id, item_id from found) group by doc_id
)
select d.doc_id, len(d.w) as n_words, coalesce(h.n_hit, 0) as n_hit, coalesce(n.n_items, 0) as n_items,
       sha256(coalesce(n.s, '')) as items_sha256, coalesce(h.n_hit, 0) > 0 as contaminated
from docs d left join hits h using (doc_id) left join names n using (doc_id)
"""

_ESCAPED = r"regexp_replace({}, '([<\[])(\\*)(\|[A-Za-z0-9_]+\|>|/?s>|/?INST\])', '\1\\\2\3', 'g')"

_CHAT = f"""
with turns as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all
    select -1, 0, 'user', '</s>[INST] ok [/INST]'
    union all
    select -1, 1, 'assistant', '</s>[INST] ok [/INST]'
),
placed as (
    select *,
           lag(role) over w is distinct from role as opens,
           lead(role) over w is distinct from role as closes
    from turns
    window w as (partition by conv_id order by turn nulls first, role, text)
)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
       cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint) as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (where role = 'assistant'), ''))
           as loss_sha256,
       cast(sum(case when opens then {len(START) + len(TEXT)} + length({_ESCAPED.format("role")}) else {len(NEXT)} end
                + length({_ESCAPED.format("text")})
                + case when closes then {len(END)} else 0 end) as bigint) as formatted_chars
from placed group by conv_id
"""



def _vector_codes(entries: int = 256, parts: int = 4, rounds: int = 4, scale: int = 1024) -> str:
    """Vector codes, one round after the other; list distances are sums of squares of whole numbers."""
    steps = [
        f"""kept as (
    select vec_id, label, list_transform(embedding, lambda x: cast(floor({scale} * cast(x as double)) as bigint)) as v
    from embeddings
    where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
parts as (
    select vec_id, label, p, v[p * (len(v) // {parts}) + 1:(p + 1) * (len(v) // {parts})] as x
    from kept, range({parts}) as r(p)
),
book0 as (
    select p, row_number() over (partition by p order by vec_id) - 1 as e, x as c
    from parts where vec_id in (select vec_id from kept order by vec_id limit {entries})
)"""
    ]
    apart = "list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - c[i]) * (x[i] - c[i])))"
    for k in range(rounds + 1):
        steps.append(
            f"""code{k} as materialized (
    select vec_id, label, p, any_value(x) as x, arg_min(e, (d, e)) as e, min(d) as d
    from (select vec_id, label, p, x, e, {apart} as d from parts join book{k} using (p))
    group by vec_id, label, p
)"""
        )
        if k < rounds:
            steps.append(
                f"""book{k + 1} as materialized (
    select b.p, b.e, coalesce(m.c, b.c) as c
    from book{k} b left join (
        select p, e, list(cast(floor(s / n) as bigint) order by i) as c
        from (select p, e, i, sum(x[i]) as s, count(*) as n from code{k}, range(1, len(x) + 1) as r(i) group by p, e, i)
        group by p, e
    ) m on m.p = b.p and m.e = b.e
)"""
            )
    return f"""
with {", ".join(steps)},
coded as (
    select vec_id, label, string_agg(printf('%02x', e), '' order by p) as code, cast(sum(d) as bigint) as error
    from code{rounds} group by vec_id, label
)
select vec_id, code, error,
       cast(sum(error) over (partition by label) as bigint) as label_error,
       (select sha256(string_agg(array_to_string(c, ','), ',' order by p, e)) from book{rounds}) as codebooks_sha256
from coded
"""


ORACLES: dict[str, str] = {
    "op1_topk_search": _TOP_K,
    "op6_decontamination": _CONTAMINATION,
    "op8_chat_format": _CHAT,
    "op13_vector_codes": _vector_codes(),
}
