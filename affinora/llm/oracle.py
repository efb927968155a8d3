"""DuckDB statements for the queries that SQL can express."""

from affinora.llm.mixing import SCHEDULES

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

NEAR_DUPLICATES = rf"""
with recursive worded as (
    select doc_id, regexp_extract_all(coalesce(translate(text, '{UPPER}', '{LOWER}'), ''), '[^\x20\x09-\x0D]+') as w from documents),
shingled as (
    select doc_id, list_distinct(case
        when len(w) = 0 then []::varchar[]
        when len(w) < 5 then [array_to_string(w, ' ')]
        else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as s
    from worded),
items as (select doc_id, unnest(s) as item from shingled),
common as (
    select a.doc_id as a, b.doc_id as b, count(*) as n from items a join items b on a.item = b.item and a.doc_id <> b.doc_id group by 1, 2),
links as (
    select c.a, c.b from common c join shingled x on x.doc_id = c.a join shingled y on y.doc_id = c.b
    where 100 * c.n >= 85 * (len(x.s) + len(y.s) - c.n)),
reach(doc_id, seen) as (
    select doc_id, doc_id from documents
    union
    select l.b, r.seen from reach r join links l on l.a = r.doc_id)
select s.doc_id, len(s.s)::bigint as n_shingles, r.component_id, s.doc_id = r.component_id as kept
from shingled s join (select doc_id, min(seen) as component_id from reach group by 1) r on r.doc_id = s.doc_id
"""

CONTAMINATION = rf"""
with rows as (
    select 'd' as kind, row_number() over () as row_no, doc_id as id, text from documents
    union all select 'b', row_number() over (), item_id, text from benchmark),
worded as (
    select kind, row_no, id, regexp_extract_all(coalesce(translate(text, '{UPPER}', '{LOWER}'), ''), '[^\x20\x09-\x0D]+') as w from rows),
shingled as (
    select kind, row_no, id, list_distinct(case
        when len(w) = 0 then []::varchar[]
        when len(w) < 5 then [array_to_string(w, ' ')]
        else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as s
    from worded),
items as (select row_no, id, len(s) as size, unnest(s) as item from shingled where kind = 'b'),
parts as (select row_no, unnest(s) as item from shingled where kind = 'd'),
hits as (
    select p.row_no, i.row_no as item_row, any_value(i.id) as item_id, 100.0::double * count(*) / any_value(i.size) as percent
    from parts p join items i using (item) group by 1, 2
    having 100 * count(*) >= 80 * any_value(i.size))
select d.id as doc_id, count(h.item_row)::bigint as n_items, coalesce(string_agg(h.item_id::varchar, ',' order by h.item_id), '') as item_ids,
    coalesce(max(h.percent), 0.0)::double as best_percent, count(h.item_row) > 0 as contaminated
from shingled d left join hits h on h.row_no = d.row_no where d.kind = 'd' group by d.row_no, d.id
"""


def _position(share: str) -> str:
    """Inverse of the piecewise demand of each kind of source, in SQL."""
    kinds = []
    for kind, schedule in enumerate(SCHEDULES):
        cases = []
        segments = schedule.segments()
        for n, (a, length, u, v, before) in enumerate(segments):
            area = f"({share} - {before!r}::double)"
            slope = (v - u) / length
            at = f"{a!r}::double + {area} / {u!r}::double" if u == v else (
                f"{a!r}::double + (sqrt(greatest(0.0::double, {u * u!r}::double + {2 * slope!r}::double * {area})) - {u!r}::double) / {slope!r}::double")
            cases.append(f"when {share} < {segments[n + 1][4]!r}::double then {at}" if n + 1 < len(segments) else f"else {at}")
        kinds.append(f"when {kind} then " + (f"case {' '.join(cases)} end" if len(cases) > 1 else cases[0][5:]))
    return f"least(1.0::double, greatest(0.0::double, case kind {' '.join(kinds)} end))"


MIX = rf"""
with sized as (
    select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
        md5(coalesce(doc_id::varchar, '')) as place
    from documents),
totals as (
    select source, sum(size)::bigint as source_size, (row_number() over (order by source nulls last) - 1) % 3 as kind from sized group by source),
weighed as (select *, case kind when 0 then 3 when 1 then 1 else 2 end as weight, 2 * source_size as cap from totals),
ranked as (
    select *, cap::double / weight as ratio,
        (1.5::double * sum(source_size) over () - coalesce(sum(cap) over (order by cap::double / weight, source nulls last rows between unbounded preceding and 1 preceding), 0)::double)
        / sum(weight) over (order by cap::double / weight, source nulls last rows between current row and unbounded following)::double as level
    from weighed),
targets as (
    select source, source_size, kind,
        least(coalesce(max(case when level <= ratio then level end) over () * weight, cap::double), cap::double) as target
    from ranked),
placed as (
    select s.*, t.source_size, t.kind, t.target,
        coalesce(sum(s.size) over (partition by s.source order by place, doc_id, size rows between unbounded preceding and 1 preceding), 0)::bigint as start
    from sized s join targets t on s.source is not distinct from t.source),
counted as (
    select *, case when source_size > 0 then floor(target / source_size)::bigint else 0 end as whole from placed),
filled as (
    select *, greatest(0, least(size, floor(target)::bigint - whole * source_size - start))::bigint as more from counted),
shared as (
    select *, case when whole > 0 and size > 0 then (start + size / 2.0::double) / target
        when more > 0 then (start + more / 2.0::double) / target end as share from filled),
ended as (
    select *, case when more > 0 then (whole * source_size + start + more / 2.0::double) / target
        when whole > 0 and size > 0 then ((whole - 1) * source_size + start + size / 2.0::double) / target end as last_share from shared)
select doc_id, size, source_size, target, whole * size + more as taken,
    case when share is not null then round({_position("share")}, 6) end as position,
    case when last_share is not null then round({_position("last_share")}, 6) end as last_position,
    (case when size > 0 then whole else 0 end + case when more > 0 then 1 else 0 end)::bigint as n_readings
from ended
"""

ROLLUPS = r"""
with live as (
    select source, lang, text, 1 - (doc_id in (select doc_id from labels where toxic > 0 and doc_id is not null))::int as stays from documents),
counted as (
    select source, lang, 'words-1' as tokenizer, stays, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as n from live
    union all
    select source, lang, 'pieces-2', stays, len(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x80-\x{10FFFF}]+|[0-9]|[^A-Za-z0-9\x80-\x{10FFFF}\x20\x09-\x0D]')) from live)
select source, lang, tokenizer, sum(coalesce(stays, 1))::bigint as n_docs, sum(coalesce(stays, 1) * n)::bigint as n_tokens from counted group by 1, 2, 3
"""

NEAR_VECTORS = """
with recursive vectors as (select vec_id, embedding::double[] as e from embeddings),
links as (
    select a.vec_id as a, b.vec_id as b from vectors a join vectors b on a.vec_id <> b.vec_id and list_cosine_similarity(a.e, b.e) >= 0.9),
reach(vec_id, seen) as (
    select vec_id, vec_id from vectors
    union
    select l.b, r.seen from reach r join links l on l.a = r.vec_id),
roots as (select vec_id, min(seen) as component_id from reach group by 1)
select r.vec_id, (select count(*) from links l where l.a = r.vec_id)::bigint as n_links, r.component_id, r.vec_id = r.component_id as kept from roots r
"""

INFILL = r"""
with keyed as (
    select doc_id, coalesce(text, '') as text, sha256('7:' || coalesce(doc_id::varchar, '')) as k, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') as u
    from documents),
drawn as (
    select *, len(u)::bigint as n, ('0x' || k[1:8])::bigint as h1, ('0x' || k[9:16])::bigint as h2, ('0x' || k[17:24])::bigint as h3, ('0x' || k[25:32])::bigint as h4
    from keyed),
formed as (
    select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
        case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 100 then 'plain'
            when h4 % 100 < 50 then 'spm' else 'psm' end as form
    from drawn),
parts as (
    select *, array_to_string(u[1:a], '') as p, array_to_string(u[a + 1:b], '') as m, array_to_string(u[b + 1:], '') as s from formed)
select doc_id, n, form, case when form <> 'plain' then len(p)::bigint end as prefix_chars, case when form <> 'plain' then len(m)::bigint end as middle_chars,
    sha256(case form when 'plain' then text when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
    sha256(text) as restored_sha256
from parts
"""

#: Levels of a tree that the statement spells out: sources of up to 16 ** MERKLE_LEVELS rows.
MERKLE_LEVELS = 5


def _framed(value: str) -> str:
    return f"coalesce(octet_length(encode({value}))::varchar || ':' || {value}, '-')"


def _merkle_leaf(text: str) -> str:
    return "sha256(" + " || ".join(map(_framed, ("doc_id::varchar", "source", "lang", "n_chars::varchar", text))) + ")"


def _merkle_tree(name: str, leaves: str) -> str:
    """CTEs {name}0 to {name}{MERKLE_LEVELS}: tree, rank, node; a finished tree's root stays as it is. `leaves` selects tree, rank, node."""
    out = [f"{name}0 as ({leaves})"]
    for k in range(1, MERKLE_LEVELS + 1):
        below = f"(select *, count(*) over (partition by tree) as n from {name}{k - 1})"
        out.append(f"""{name}{k} as (
    select tree, rank // 16 as rank, sha256(string_agg(node, '' order by rank)) as node from {below} where n > 1 group by 1, 2
    union all select tree, rank, node from {below} where n = 1)""")
    return ",\n".join(out)


def _merkle_siblings(name: str) -> str:
    """CTEs {name}_path0 and up: per node of an unfinished tree the texts of its siblings left and right of it, as p."""
    run = "over (partition by tree, rank // 16 order by rank rows between"
    return ",\n".join(f"""{name}_path{k} as (
    select tree, rank, {{'l': coalesce(string_agg(node, '') {run} unbounded preceding and 1 preceding), ''),
        'r': coalesce(string_agg(node, '') {run} 1 following and unbounded following), '')}} as p
    from (select *, count(*) over (partition by tree) as n from {name}{k}) where n > 1)""" for k in range(MERKLE_LEVELS))


def _merkle_join(name: str, tree: str, rank: str) -> str:
    return "\n".join(f"    left join {name}_path{k} on {name}_path{k}.tree = {tree} and {name}_path{k}.rank = {rank} // {16 ** k}" for k in range(MERKLE_LEVELS))


def _merkle_fold(start: str) -> str:
    steps = [f"{name}p{k}" for name in ("t", "s") for k in range(MERKLE_LEVELS)]
    out, last = [], start
    for k, step in enumerate(steps):
        out.append(f"fold{k} as (select *, case when {step} is null then {last} else sha256({step}.l || {last} || {step}.r) end as f{k} from {'paths' if k == 0 else f'fold{k - 1}'})")
        last = f"f{k}"
    return ",\n".join(out)


_CRC_BITS = "if(c & 1 = 1, xor(c >> 1, 3988292384::bigint), c >> 1)"

MERKLE = rf"""
with crc_table as (
    select list(v order by i) as t from (
        select i, list_reduce([i::bigint] || range(8), lambda c, _: {_CRC_BITS}) as v from range(256) r(i))),
leaves as (
    select row_number() over () as row_no, doc_id, source, {_merkle_leaf('text')} as leaf,
        coalesce(xor(list_reduce([4294967295::bigint] || list_transform(range(1, len(doc_id::varchar) + 1), lambda k: ascii(substr(doc_id::varchar, k, 1))::bigint),
            lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295::bigint) % 5 = 0, false) as hit,
        {_merkle_leaf(f"translate(text, '{UPPER}', '{LOWER}')")} as lowered
    from documents, crc_table),
ranked as (
    select *, dense_rank() over (order by source nulls first) - 1 as tree, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as rank from leaves),
{_merkle_tree('t', 'select tree, rank, leaf as node from ranked')},
{_merkle_tree('s', f'select 0 as tree, tree as rank, node from t{MERKLE_LEVELS}')},
{_merkle_siblings('t')},
{_merkle_siblings('s')},
paths as (
    select r.*, case when hit then lowered else leaf end as claimed, u.node as subroot, (select node from s{MERKLE_LEVELS}) as root,
        {", ".join(f"{name}_path{k}.p as {name}p{k}" for name in ("t", "s") for k in range(MERKLE_LEVELS))}
    from ranked r join t{MERKLE_LEVELS} u on u.tree = r.tree
{_merkle_join('t', 'r.tree', 'r.rank')}
{_merkle_join('s', '0', 'r.tree')}),
{_merkle_fold('claimed')}
select doc_id, leaf, subroot, root,
    sha256({" || ".join(f"coalesce({name}p{k}.l || {name}p{k}.r, '')" for name in ("t", "s") for k in range(MERKLE_LEVELS))}) as proof_sha256,
    f{2 * MERKLE_LEVELS - 1} as folded_root, f{2 * MERKLE_LEVELS - 1} = root as verified
from fold{2 * MERKLE_LEVELS - 1}
"""

PASSAGES = r"""
with worded as (
    select row_number() over () as row_no, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
starts as (select row_no, doc_id, w, unnest(range(1, len(w) - 48)) as i from worded where doc_id is not null),
windows as (select row_no, doc_id, i, array_to_string(w[i:i + 49], ' ') as body from starts),
judged as (select row_no, i, doc_id > min(doc_id) over (partition by body) as again from windows),
gone as (select distinct row_no, unnest(range(i, i + 50)) as k from judged where again),
lists as (select row_no, list(k) as gone from gone group by 1),
left_over as (
    select d.doc_id, d.w, coalesce(len(l.gone), 0)::bigint as n_removed,
        case when l.gone is null then d.w else list_transform(list_sort(list_filter(range(1, len(d.w) + 1), lambda k: not list_contains(l.gone, k))), lambda k: d.w[k]) end as kept
    from worded d left join lists l on l.row_no = d.row_no)
select doc_id, len(w)::bigint as n_words, n_removed, sha256(array_to_string(kept, ' ')) as kept_sha256 from left_over
"""
