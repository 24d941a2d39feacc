"""SQL twins of the queries that SQL can express, for DuckDB on the same tables."""

# Sources share by water filling: a source is full when all before it, in the order of
# their size for a unit of weight, are; the level is what is left for those that are not.
_TARGETS = r"""
sized as (
    select doc_id, source, length(regexp_replace(coalesce(text, ''), '[^\x20\x09-\x0D]+', 'x', 'g'))
             - length(regexp_replace(coalesce(text, ''), '[^\x20\x09-\x0D]+', '', 'g')) as size,
           ('0x' || left(md5(coalesce(cast(doc_id as varchar), '') || '|' || coalesce(text, '')), 15))::bigint as hash
    from documents
),
sources as (
    select source, sum(size)::bigint as source_size,
           row_number() over (order by source nulls last) as place, [5, 2, 1][1 + (place - 1) % 3] as weight
    from sized group by source
),
levels as (
    select *, sum(source_size) over () * 1.5::double as budget,
           coalesce(sum(2 * source_size) over (order by 2.0 * source_size / weight, place
               rows between unbounded preceding and 1 preceding), 0) as full_before,
           sum(weight) over (order by 2.0 * source_size / weight desc, place desc) as weight_left
    from sources
),
level as (
    select coalesce(arg_min((budget - full_before) / weight_left, 2.0 * source_size / weight)
        filter (where 2.0 * source_size / weight >= (budget - full_before) / weight_left), 1e300) as unit
    from levels
),
targets as (
    select source, source_size, least(2.0::double * source_size, weight * unit) as target from levels, level
),
budgets as (
    select *, case when source_size > 0 then floor(target / source_size) else 0 end::int as times from targets
),
running as (
    select d.doc_id, d.size, t.source_size, t.target, t.times, t.target - t.times * t.source_size as budget,
           sum(d.size) over (partition by d.source order by d.hash range unbounded preceding) as with_it,
           sum(d.size) over (partition by d.source, d.hash) as same
    from sized d join budgets t on d.source is not distinct from t.source
)
"""

ORACLES = {
    "op1_mix_sources": f"""with {_TARGETS}
select doc_id, size::bigint as size, source_size, target,
       (size * (times + case when with_it - same + with_it < 2 * budget then 1 else 0 end))::bigint as taken
from running""",
    "op5_jaccard": r"""with recursive words as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
    from documents
),
sets as (
    select doc_id, case when len(w) = 0 then [] when len(w) < 4 then [array_to_string(w, ' ')]
        else list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) end as s
    from words
),
grams as (select doc_id, unnest(s) as g from sets),
sizes as (select doc_id, len(s) as n from sets),
pairs as (
    select a.doc_id as a, b.doc_id as b, count(*) as shared
    from grams a join grams b on a.g = b.g and a.doc_id < b.doc_id group by all
),
links as (
    select a, b from pairs join sizes x on x.doc_id = a join sizes y on y.doc_id = b
    where 100 * shared >= 85 * (x.n + y.n - shared)
),
both_ways as (select a, b from links union all select b, a from links),
reach as (
    select doc_id as a, doc_id as b from documents
    union select r.a, l.b from reach r join both_ways l on r.b = l.a
)
select doc_id, n::bigint as n_shingles, (select min(b) from reach where a = doc_id) as component_id from sizes""",
    "op6_lattice": """with recursive unit as (
    select vec_id, label, embedding::double[] as v from embeddings
    where label is not null and embedding is not null and list_sum(list_transform(embedding, lambda x: abs(x))) > 0
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
links as (
    select a.vec_id as a, b.vec_id as b from unit a join unit b on a.label = b.label and a.vec_id <> b.vec_id
    where list_cosine_similarity(a.v, b.v) >= 0.98
),
reach as (
    select vec_id as a, vec_id as b from embeddings union select r.a, l.b from reach r join links l on r.b = l.a
),
named as (select a, min(b) as component_id from reach group by a),
counted as (select a, count(*) as n_links from links group by a)
select vec_id, coalesce(n_links, 0)::bigint as n_links, component_id, vec_id = component_id as kept
from embeddings join named n on n.a = vec_id left join counted c on c.a = vec_id""",
}


# ---- hard negatives and shards ---------------------------------------------------------

ORACLES["op12_hard_negatives"] = """
with usable as (
    select row_number() over () as place, vec_id,
           case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
           list_transform(embedding, lambda x: floor(256 * x::double)) as v
    from embeddings
    where label is not null and embedding is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
scored as (
    select a.place as anchor, a.vec_id as anchor_id, r.place, r.vec_id, a.label = r.label as same,
           list_inner_product(a.v, r.v)::bigint as score
    from usable a join usable r on a.vec_id % 50 = 0 and a.place <> r.place
),
positives as (
    select * from scored where same
    qualify row_number() over (partition by anchor order by score desc, vec_id nulls last, place) <= 5
)
select p.anchor_id, p.vec_id as positive_id,
       row_number() over (partition by p.anchor, p.place order by n.score desc, n.vec_id nulls last, n.place)::int as rank,
       n.vec_id as negative_id, p.score as positive_score, n.score as negative_score
from positives p join scored n
  on p.anchor = n.anchor and not n.same and 50 * p.score <= 100 * n.score and 100 * n.score <= 95 * p.score
qualify rank <= 3
"""


def _level(number: int) -> str:
    """The units of all nodes of a level, from p{number}, with their nodes on the next one.

    A cut is the key below which the bytes are nearest to half; units above 1/256 of the
    node go first, and the cut among the others makes up for them.
    """

    def cut(name: str, rows: str, target: str) -> str:
        return f"""
{name}_sums{number} as (
    select node, key, any_value({target}) as target, sum(weight)::bigint as w,
           (sum(sum(weight)) over (partition by node order by key))::bigint as upto
    from {rows} group by node, key
),
{name}{number} as (
    select node, case when any_value(target) <= 0 then 0
        else coalesce(arg_min(key + (2 * (target - upto + w) >= w)::int, key) filter (where upto >= target), 1::bigint << 60)
        end as cut
    from {name}_sums{number} group by node
),"""

    return f"""
axes{number} as (
    select node, sum(weight)::bigint as whole, max(x0) - min(x0) as d0, max(x1) - min(x1) as d1, max(x2) - min(x2) as d2
    from p{number} group by node
),
keyed{number} as (
    select p.*, whole, whole // 2 as half, weight * 256 > whole as heavy,
           ((case when d0 >= d1 and d0 >= d2 then x0 when d1 >= d2 then x1 else x2 end) << 40) + (unit >> 20) as key
    from p{number} p join axes{number} using (node)
),{cut("median", f"keyed{number}", "half")}
fixed{number} as (
    select node, sum(weight) filter (where key < cut and heavy)::bigint as took
    from keyed{number} join median{number} using (node) group by node
),
light_rows{number} as (
    select k.*, half - coalesce(took, 0) as rest from keyed{number} k join fixed{number} using (node) where not heavy
),{cut("light", f"light_rows{number}", "rest")}
p{number + 1} as (
    select unit, weight, x0, x1, x2,
           2 * k.node + case when key >= (case when heavy then m.cut else l.cut end) then 2 else 1 end as node
    from keyed{number} k join median{number} m using (node) left join light{number} l using (node)
),"""


_NAME_PLACE = "coalesce(('0x' || left(md5({0}), 5))::bigint, 0)"

ORACLES["op13_kd_shards"] = rf"""
with table_ as (  -- CRC-32 of each byte
    select list_transform(range(256), lambda i: list_reduce(list_prepend(i::bigint, range(8)),
        lambda r, k: case when r % 2 = 1 then xor(r // 2, 3988292384) else r // 2 end)) as crcs
),
slim as (
    select doc_id, strlen(coalesce(text, ''))::bigint + 1 as size,
           xor(4294967295, list_reduce(list_prepend(4294967295::bigint, list_transform(
               regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::bigint)),
               lambda c, b: xor(c >> 8, crcs[(xor(c & 255, b) + 1)::bigint])))::bigint as text_crc32,
           ('0x' || left(md5(coalesce(text, '')), 15))::bigint as digest,
           ('0x' || left(md5(coalesce(doc_id::varchar, '')), 15))::bigint as spread,
           {_NAME_PLACE.format("source")} as x0, {_NAME_PLACE.format("lang")} as x1, length(bin(size)) as digits,
           ((digits - 1) * 512 + floor(size * 1024 / pow(2.0, digits))::bigint - 512) * 32 as x2
    from documents, table_
),
large as (
    select digest, ceil(sum(size) * 32 / any_value(total)::double)::bigint as pieces
    from slim, (select sum(size) as total from slim) group by digest having sum(size) * 32 > any_value(total)
),
with_unit as (
    select s.*, (digest + coalesce(spread % pieces, 0) * 25214903917) % (1::bigint << 60) as unit
    from slim s left join large using (digest)
),
p0 as (
    select unit, sum(size)::bigint as weight, min(x0) as x0, min(x1) as x1, min(x2) as x2, 0::bigint as node
    from with_unit group by unit
),{_level(0)}{_level(1)}{_level(2)}
shards as (select unit, (node - 7)::int as shard from p3)
select doc_id, size, text_crc32, 'bytes' as law, shard,
       row_number() over (partition by shard order by doc_id nulls last, text_crc32, size, unit) - 1 as slot,
       null::int as grown_shard
from with_unit join shards using (unit)
"""
