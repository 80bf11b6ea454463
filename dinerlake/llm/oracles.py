"""DuckDB statements for the queries that SQL can express."""

from __future__ import annotations

MIX = r"""
with d as (
    select doc_id, source,
           coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
           md5('mix|' || coalesce(doc_id::varchar, '') || '|' || coalesce(md5(text), '')) as key
    from documents
),
s as (
    select source, sum(size)::bigint as source_size from d group by source
),
w as (
    select source, source_size, 2 * source_size as cap,
           case (row_number() over (order by source nulls last) - 1) % 3
                when 0 then 5 when 1 then 2 else 1 end as weight
    from s
),
-- Filling sources in the order of cap over weight raises the level as long as it must.
steps as (
    select coalesce(sum(cap) over filled, 0) as filled,
           coalesce(sum(weight) over filled, 0) as closed
    from w
    window filled as (order by cap / weight, source nulls last
                      rows between unbounded preceding and 1 preceding)
),
level as (
    select max((1.5::double * (select sum(source_size) from w)::double - filled)
               / ((select sum(weight) from w) - closed)::double) as level
    from steps
),
t as (
    select source, source_size, least(cap::double, level * weight) as target from w, level
),
placed as (
    select d.doc_id, d.size, t.source_size, t.target, floor(t.target)::bigint as budget,
           coalesce(sum(d.size) over (partition by d.source order by d.key, d.doc_id, d.size
               rows between unbounded preceding and 1 preceding), 0)::bigint as before
    from d join t on d.source is not distinct from t.source
)
select doc_id, size, source_size, target,
       case when source_size = 0 then 0::bigint
            else (budget // source_size) * size
                 + greatest(0, least(size, budget - (budget // source_size) * source_size - before))
       end::bigint as taken
from placed
"""

TOP_K = """
with v as (
    select row_number() over () as rid, vec_id,
           list_transform(embedding, lambda x: floor(256 * x::double)) as vec
    from embeddings
    where embedding is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
scored as (
    select q.rid as query_rid, q.vec_id as query_id, c.vec_id, c.rid,
           list_inner_product(q.vec, c.vec)::bigint as score
    from v q join v c on q.rid <> c.rid and len(q.vec) = len(c.vec)
    where q.vec_id % 50 = 0
)
select query_id, rank, vec_id, score
from (
    select query_id, vec_id, score,
           row_number() over (partition by query_rid
                              order by score desc, vec_id nulls last, rid)::int as rank
    from scored
)
where rank <= 5
"""

def span_list(kind: str, order: int, pattern: str, group: int, least: int) -> str:
    """Spans of one kind: matches and the pieces between them, counted up from the start."""
    return f"""
    select row_id, {order} as place, '{kind}' as kind,
           (len_until - match_len)::bigint as start, len_until::bigint as stop
    from (
        select row_id, pos, match_len, decisive,
               sum(gap + match_len) over (partition by row_id order by pos) as len_until
        from (
            select row_id, unnest(range(len(m))) as pos,
                   unnest(list_transform(m, lambda x: len(x))) as match_len,
                   unnest(list_transform(g, lambda x: len(x))) as decisive,
                   unnest(list_transform(p[1:len(m)], lambda x: len(x))) as gap
            from (
                select row_id, regexp_extract_all(text, '{pattern}') as m,
                       regexp_extract_all(text, '{pattern}', {group}) as g,
                       string_split_regex(text, '{pattern}') as p
                from d where text <> ''
            )
            where len(m) > 0
        )
    )
    where decisive >= {least}
    """


def either_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


ASSIGNED = "|".join(
    either_case(w) for w in ("password", "passwd", "secret", "token", "api_?key")
)
KINDS = [
    ("assign", f"""({ASSIGNED})["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", "AKIA[A-Z0-9]+", 0, 16),
    ("hex", "[0-9a-f]+", 0, 32),
    ("github", "gh[pousr]_[A-Za-z0-9]+", 0, 40),
    ("slack", "xox[abeprs]-[A-Za-z0-9-]+", 0, 20),
    ("google", "AIza[A-Za-z0-9_-]+", 0, 39),
    ("jwt", "eyJ[A-Za-z0-9_-]+\\.eyJ[A-Za-z0-9_-]+\\.[A-Za-z0-9_-]+", 0, 40),
    ("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
]
SECRETS = f"""
with d as (
    select row_number() over () as row_id, doc_id, coalesce(text, '') as text from documents
),
spans as ({" union all ".join(span_list(k, i, p, g, n) for i, (k, p, g, n) in enumerate(KINDS))}),
listed as (
    select row_id, count(*) filter (place = 0) as n_assign, count(*) filter (place = 1) as n_access,
           count(*) filter (place = 2) as n_hex,
           string_agg(kind || ':' || start || ':' || stop, ',' order by start, place)
               filter (place < 3) as base,
           string_agg(kind || ':' || start || ':' || stop, ',' order by start, place) as spans
    from spans group by row_id
)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access,
       coalesce(n_hex, 0) as n_hex, sha256(coalesce(base, '')) as base_sha256,
       coalesce(spans, '') as spans
from d left join listed using (row_id)
"""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TERM_LIST = (
    f"regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)
SEARCH = f"""
with d as (
    select row_number() over () as rid, doc_id, coalesce({TERM_LIST}, []) as terms from documents
),
stats as (
    select count(*) filter (len(terms) > 0)::bigint as docs, sum(len(terms))::bigint as words from d
),
i as (
    select iid, item_id, term, count(*)::bigint as times
    from (
        select row_number() over () as iid, item_id, unnest({TERM_LIST}) as term from benchmark
    )
    group by iid, item_id, term
),
p as (
    select rid, doc_id, len(terms)::bigint as n, term, count(*)::bigint as tf
    from (select rid, doc_id, terms, unnest(terms) as term from d)
    group by rid, doc_id, n, term
),
w as (
    select term, floor(1000 * ln((2 * docs + 2)::double / (2 * df + 1)))::bigint as w
    from (select term, count(*)::bigint as df from p group by term), stats
),
scored as (
    select i.iid, i.item_id, p.rid, p.doc_id,
           sum(i.times * w.w * ((1000000000 * p.tf)
               // (1000 * p.tf + 8 * (25 + ((75::hugeint * p.n * docs) // words)::bigint))))::bigint as score
    from i join p using (term) join w using (term), stats
    group by i.iid, i.item_id, p.rid, p.doc_id
)
select item_id, rank::int as rank, doc_id, score
from (
    select item_id, doc_id, score,
           row_number() over (partition by iid order by score desc, doc_id nulls last) as rank
    from scored where score > 0
)
where rank <= 10
"""

def crc32(text: str) -> str:
    """The unsigned crc32 of a text's UTF-8 bytes, byte by byte through ``table`` (see CRC_TABLE)."""
    codes = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: ('0x' || x)::bigint)"
    return (f"xor(list_reduce([4294967295::bigint] || {codes}, "
            f"lambda c, b: xor(c >> 8, crc_table[(xor(c, b) & 255) + 1])), 4294967295)")


CRC_TABLE = """
    select list(c order by b) as crc_table
    from (
        select b, list_reduce([b::bigint] || [0, 0, 0, 0, 0, 0, 0, 0]::bigint[],
                              lambda c, x: xor(c >> 1, (c & 1) * 3988292384)) as c
        from range(256) r(b)
    )
"""

# A label of the table of cheapest edits: cost in ten digits, audit, a bar, and what was given out as
# "k3;" (row 3 kept), "u3;", "a3;" (row 3 re-roled) or "U;", "A;" (inserted).  The least label is the best.
STATES = ("start", "system", "user", "assistant")
FOLLOWS = {"start": "user", "system": "user", "user": "assistant", "assistant": "user"}


def edited(label: str, cost: str, letter: str, given: str) -> str:
    return (
        f"(lpad(({label}[1:10]::bigint + {cost})::varchar, 10, '0') || split_part({label}[11:], '|', 1) "
        f"|| '{letter}|' || split_part({label}, '|', 2) || {given})"
    )


def least(options: list[str]) -> str:
    return f"least({', '.join(options)}, null::varchar)"


def inserted(labels: dict[str, str]) -> dict[str, str]:
    """Labels after at most one insertion."""
    found = {s: [labels[s]] for s in STATES}
    for s, target in FOLLOWS.items():
        found[target].append(edited(labels[s], "3", "I", f"'{target[0].upper()};'"))
    return {s: least(options) for s, options in found.items()}


def row_done(labels: dict[str, str]) -> dict[str, str]:
    """Labels after the row that is joined as ``n``."""
    more = "(case when n.fault = 3 then 3 else 0 end)"
    found = {s: [edited(labels[s], "4", "D", "''")] for s in STATES}
    for s, target in FOLLOWS.items():
        kept = edited(labels[s], more, "K", "'k' || n.pos || ';'")
        changed = edited(labels[s], f"(3 + {more})", "R", f"'{target[0]}' || n.pos || ';'")
        found[target].append(
            f"case when n.fault in (0, 3) then case when n.role[1:1] = '{target[0]}' then {kept} "
            f"else {changed} end end")
        if s == "start":
            found["system"].append(f"case when n.fault in (0, 3) and n.role[1:1] = 's' then {kept} end")
    return {s: least(options) for s, options in found.items()}


def columns(labels: dict[str, str]) -> str:
    return ", ".join(f"{x} as {s}" for s, x in labels.items())


REPAIR = f"""
with recursive damaged as (
    select conv_id, turn, case when kind = 4 then 'user' else role end as role,
           case when kind = 1 then '' when kind = 2 then regexp_replace(text, '[.!?]', '', 'g')
                else text end as text,
           unnest(range(case kind when 0 then 0 when 3 then 2 else 1 end)) as copy
    from (
        select conv_id, turn, case when coalesce(role, '') = '' then ' ' else role end as role,
               coalesce(text, ' ') as text,
               {crc32("coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ')")} % 20 as kind
        from conversations, ({CRC_TABLE})
    )
),
placed as (
    select *, md5(length(role) || ':' || role || text) as digest,
           row_number() over (partition by conv_id
                              order by turn nulls first, role, md5(length(role) || ':' || role || text)) as pos
    from damaged
),
faulty as (
    select *, case when not regexp_matches(text, '[^\\x20\\x09-\\x0D]') then 1
                   when row_number() over (partition by conv_id, role, digest order by pos) > 1 then 2
                   when not regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') then 3 else 0 end as fault,
           lead(role) over (partition by conv_id order by pos) as follower
    from placed
),
sums as (
    select conv_id, count(*) as n_rows,
           coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0)::bigint as gaps,
           count(*) filter (fault = 1) as blank, count(*) filter (fault = 2) as duplicate,
           count(*) filter (fault = 3) as truncated,
           count(*) filter (follower is not null
                            and (role[1:1] || follower[1:1]) not in ('su', 'ua', 'au')) as illegal
    from faulty group by conv_id
),
walk as (
    select conv_id, 0::bigint as pos, '0000000000|' as start, null::varchar as system,
           '0000000003I|U;' as user, null::varchar as assistant
    from sums
    union all
    select conv_id, pos, {columns(inserted({s: s for s in STATES}))}
    from (
        select w.conv_id, n.pos, {columns(row_done({s: f"w.{s}" for s in STATES}))}
        from walk w join faulty n on w.conv_id is not distinct from n.conv_id and n.pos = w.pos + 1
    )
),
ended as (
    select w.conv_id, least(w.start, w.assistant) as label
    from walk w join sums s on w.conv_id is not distinct from s.conv_id and w.pos = s.n_rows
),
given as (
    select e.conv_id, g.place, case g.code[1:1]
               when 'k' then f.role || ':' || f.text when 'u' then 'user:' || f.text
               when 'a' then 'assistant:' || f.text when 'U' then 'user:' else 'assistant:' end as line
    from (
        select conv_id, unnest(codes) as code, unnest(range(len(codes))) as place
        from (select conv_id, list_filter(string_split(split_part(label, '|', 2), ';'), lambda x: x <> '') as codes
              from ended)
    ) g
    join ended e on e.conv_id is not distinct from g.conv_id
    left join faulty f on f.conv_id is not distinct from g.conv_id and g.code[1:1] in ('k', 'u', 'a')
                      and f.pos = try_cast(g.code[2:] as bigint)
),
lines as (
    select conv_id, string_agg(line, chr(10) order by place) as repaired from given group by conv_id
)
select c.conv_id, coalesce(s.gaps, 0) as gaps, coalesce(s.blank, 0) as blank,
       coalesce(s.duplicate, 0) as duplicate, coalesce(s.truncated, 0) as truncated,
       coalesce(s.illegal, 0) as illegal, coalesce(e.label[1:10]::bigint, 0) as cost,
       coalesce(split_part(e.label[11:], '|', 1), '') as audit,
       sha256(coalesce(l.repaired, '')) as repaired_sha256
from (select distinct conv_id from conversations) c
left join sums s on s.conv_id is not distinct from c.conv_id
left join ended e on e.conv_id is not distinct from c.conv_id
left join lines l on l.conv_id is not distinct from c.conv_id
"""

def place(value: str) -> str:
    return f"('0x' || rpad(hex(encode({value}))[1:12], 12, '0'))::bigint"


SHARDS = 40
SPANS = {"source": place("source"), "lang": place("lang"), "size": "size", "id": "id"}


def tree_level(level: int, nodes: list[tuple[int, int]]) -> str:
    """One level of the k-d tree: from ``l<level>`` to the next."""
    cuts = ", ".join(f"({at}, {at + n // 2}, {n // 2}::double / {n})" for at, n in nodes if n > 1)
    ratio = [f"case when g.w_{d} > 0 then (max({x}) - min({x}))::double / g.w_{d} else 0 end" for d, x in SPANS.items()]
    widest = " ".join(f"when w{i} = greatest(w0, w1, w2, w3) then '{d}'" for i, d in enumerate(SPANS))
    return f"""
n{level} as (
    select node, tail, total, largest, case {widest} end as axis, round(total * share)::bigint as cut
    from (
        select l.node, c.tail, c.share, sum(size)::bigint as total, max(size) as largest,
               {", ".join(f"{r} as w{i}" for i, r in enumerate(ratio))}
        from l{level} l join (values {cuts}) c(node, tail, share) using (node), spans g
        group by l.node, c.tail, c.share, g.w_source, g.w_lang, g.w_size, g.w_id
    )
),
p{level} as (
    select *, coalesce(sum(size) over (partition by node order by number, label, digest, doc_id nulls first, rid
                                       rows between unbounded preceding and 1 preceding), 0)::bigint as before
    from (
        select l.*, tail, largest, cut,
               case axis when 'size' then size when 'id' then id else 0 end as number,
               case axis when 'source' then source when 'lang' then lang else '' end as label
        from l{level} l join n{level} n using (node)
    )
),
e{level} as (
    select node, case when till - since > greatest(total / {SHARDS}::double / 64, largest) then cut
                      when cut - since <= till - cut then since else till end as moved
    from (
        select p.node, p.cut, p.largest, g.total, min(p.before) as since, max(p.before + p.size) as till
        from p{level} p
        join p{level} c on p.node = c.node and p.number = c.number and p.label = c.label and p.digest = c.digest
                        and c.before < c.cut and c.cut <= c.before + c.size, spans g
        group by p.node, p.cut, p.largest, g.total
    )
),
l{level + 1} as (
    select rid, doc_id, size, text_crc32, digest, source, lang, id,
           case when 2 * before + size > 2 * coalesce(moved, cut) then tail else node end as node
    from p{level} left join e{level} using (node)
    union all by name
    select * from l{level} where node not in (select node from n{level})
),"""


def tree_levels() -> tuple[str, int]:
    nodes, level, found = [(0, SHARDS)], 0, []
    while any(n > 1 for _, n in nodes):
        found.append(tree_level(level, nodes))
        nodes = [p for at, n in nodes for p in ([(at, n // 2), (at + n // 2, n - n // 2)] if n > 1 else [(at, n)])]
        level += 1
    return "".join(found), level


LEVELS, LAST = tree_levels()
KD_SHARDS = f"""
with d as (
    select row_number() over () as rid, doc_id, octet_length(encode(coalesce(text, '')))::bigint + 16 as size,
           {crc32("coalesce(text, '')")} as text_crc32,
           case when text is null then '' else md5(text) end as digest,
           coalesce(source, '') as source, coalesce(lang, '') as lang
    from documents, ({CRC_TABLE})
),
l0 as (
    select rid, doc_id, size, text_crc32, digest, first_value(source) over w as source,
           first_value(lang) over w as lang, coalesce(first_value(doc_id) over w, 0)::bigint as id, 0 as node
    from d
    window w as (partition by digest order by doc_id nulls last, source, lang
                 rows between unbounded preceding and unbounded following)
),
spans as (
    select sum(size) as total, {", ".join(f"(max({x}) - min({x}))::double as w_{d}" for d, x in SPANS.items())} from l0
),{LEVELS}
placed as (select * from l{LAST})
select doc_id, size, text_crc32, 'bytes' as law, node::int as shard,
       row_number() over (partition by node order by digest, doc_id nulls first, rid) - 1 as slot,
       null::int as grown_shard
from placed
"""

SQL = {
    "op1_mix_sources": MIX,
    "op2_top_k": TOP_K,
    "op4_secrets": SECRETS,
    "op11_shards": KD_SHARDS,
    "op12_repair": REPAIR,
    "op13_search": SEARCH,
}
