"""SQL twins of the queries, for DuckDB, written independently of the Spark plans.

Each twin is a final SELECT over common table expressions; ``_sql`` adds those it needs.
The data tables of ``roadlark.rules`` are shared, the logic is not.
"""

import re

from checks.fixtures import (
    CITY_POINTS, DATE_TEXTS, DIM_LOCATIONS, GAZETTEER, HELD_BACK, PAGE_BLOCKS, PAGES, PART_NAMES, PART_TYPES, POSTS, SECOND_LOAD,
)
from roadlark import rules


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _values(rows, columns: str) -> str:
    lines = ", ".join("(" + ", ".join(_quote(c) for c in row) + ")" for row in rows)
    return f"select * from (values {lines}) as v({columns})"


def _respelled(column: str) -> str:
    for find, put in rules.LOCATION_RULES:
        column = f"replace({column}, {_quote(find)}, {_quote(put)})"
    return column


def _mapped(column: str, entries: dict) -> str:
    cases = " ".join(f"when {_quote(k)} then {_quote(v)}" for k, v in entries.items())
    return f"case {column} {cases} else {column} end"


def _vehicle(column: str) -> str:
    single = _mapped(f"trim({column})", rules.VEHICLE_PLURALS)
    return _mapped(
        rf"regexp_replace({single}, '(\d{{1,2}})\s*(WHEELER TRUCK)', '\1-\2', 'g')",
        rules.VEHICLE_ALIASES,
    )


def _digits(column: str) -> str:
    for word, number in rules.NUMBER_WORDS.items():
        column = rf"regexp_replace({column}, '\b{word}\b', '{number}', 'g')"
    return column


_TOKENS = rules.DIRECTION_TOKENS
_WORDS = "|".join(rules.NUMBER_WORDS)
_ENDS = f"INVOLVING|STALLED|{_TOKENS}|MORE OR|AS OF"
_FACT = "event_id, event_timestamp, location_id, event_type, event_type_details, direction_id, lanes_blocked, post, link"
_DIM = "location_id, city, location, latitude, longitude, accuracy"

# A smallest row: the column order of the table, nulls first.
_FACT_ORDER = ", ".join(f"{c} nulls first" for c in _FACT.split(", ")[1:])

_TYPE_CASES = " ".join(
    f"when type like {_quote(p)} then {_quote(n)}" for p, n in rules.EVENT_TYPE_RULES
)


def _facts(source: str) -> str:
    return f"""
select s.event_id, s.event_timestamp, s.location_id,
  case {_TYPE_CASES} else 'OTHERS' end as event_type, s.type as event_type_details,
  coalesce(d.short_name, 'UNKNOWN') as direction_id, s.lanes_blocked, s.post, s.link
from {source} as s left join dim_direction as d on s.direction in (d.short_name, d.full_name)
"""


def _smallest(source: str, key: str, order: str) -> str:
    return (
        f"select * exclude (rn) from (select *, row_number() over (partition by {key} order by {order}) as rn "
        f"from {source}) where rn = 1"
    )


CTES = {
    "posts": POSTS.replace("{events}", "events"),
    "prep": "select *, upper(trim(content)) as post, trim(tweetlinkid) as link, created_at as date from posts",
    "clocks": rf"""
select post_seq, try_cast(regexp_extract(t, '{{p}}', 1) as int) as h,
  coalesce(try_cast(nullif(regexp_extract(t, '{{p}}', 2), '') as int), 0) as m, regexp_extract(t, '{{p}}', 3) as half
from (select post_seq, replace(replace(post, ';', ':'), '.', '') as t from prep)
""".replace("{p}", r"\b(\d{1,2})(?::\s*(\d{2}))?\s*(AM|PM)\b"),
    "times": """
select post_seq, case when h between 1 and 12 and m between 0 and 59 then
  lpad(cast((h % 12 + case half when 'PM' then 12 else 0 end) as varchar), 2, '0') || ':' || lpad(cast(m as varchar), 2, '0')
  end as time from clocks
""",
    "lanes": rf"""
select post_seq, coalesce(try_cast(n as int), case n {' '.join(f"when '{w}' then {i}" for w, i in rules.NUMBER_WORDS.items())} end)
  as lanes_blocked
from (select post_seq, regexp_extract(post, '\b(\d+|{_WORDS})\s+LANES?\b', 1) as n from prep)
""",
    "types": r"select post_seq, trim(regexp_extract(post, 'MMDA ALERT:\s*(.*?)\s+(AT|ALONG|ON)\b', 1)) as type from prep",
    "directions": rf"select post_seq, regexp_extract_all(post, '\b({_TOKENS})\b', 1)[-1] as direction from prep",
    "places": rf"""
select post_seq, case when contains(post, 'RALLY') then regexp_extract(post, '(AT|ALONG|ON)\s+(.*?)\s+MORE OR\b', 2)
  else trim(regexp_replace(regexp_extract(post, '\b(AT|ALONG|ON)\s+(.*?)\s+(?:{_ENDS})', 2), '\bINVOLVING\b.*$', '')) end as place
from prep
""",
    "locations": rf"""
select post_seq, trim(replace({_respelled('words')}, 'Ñ', 'N')) as location
from (select post_seq, trim(regexp_replace(regexp_replace(place, '\b({_TOKENS})\b', ' ', 'g'), '\s+', ' ', 'g')) as words from places)
""",
    "people": r"""
select post_seq, nullif(case
  when contains(post, 'RALLY') then cast(try_cast(nullif(regexp_extract(post, 'MORE OR LESS\s+(\d+)\s+PAX\b', 1), '') as bigint) as varchar)
  when contains(post, 'STALLED') then trim(regexp_extract(post, 'STALLED\s+(.*?)\s+DUE\b', 1))
  else rtrim(trim(regexp_extract(post, 'INVOLVING\s+(.*?)\s*\s+(?:AS OF|OF|MORE OR)', 1)), ',') end, '') as participants
from prep
""",
    "people_parts": rf"""
select post_seq, unnest(string_split_regex(replace({_digits(_vehicle("regexp_replace(regexp_replace(participants, '" + chr(92) + "bA" + chr(92) + "b', '', 'g'), '" + chr(92) + "bAN" + chr(92) + "b', '', 'g')"))}, ',', ' AND '), '\bAND\b')) as part
from people where participants is not null
""",
    "people_counts": rf"""
select post_seq, {_vehicle("case when c = '' then part else name end")} as name, case when c = '' then 1 else cast(c as bigint) end as n
from (select post_seq, trim(part) as part, regexp_extract(trim(part), '^(\d+)\s+(.+)$', 1) as c,
        regexp_extract(trim(part), '^(\d+)\s+(.+)$', 2) as name from people_parts where trim(part) <> '')
""",
    "involveds": """
select p.post_seq, case when p.participants is not null then coalesce(l.line, '') end as involved
from people as p left join (
  select post_seq, string_agg(cast(n as varchar) || ' ' || name, '|' order by name) as line
  from (select post_seq, name, sum(n) as n from people_counts group by post_seq, name) group by post_seq
) as l using (post_seq)
""",
    "parsed": """
select upper(sha256(coalesce(cast(date as varchar), '') || coalesce(time, '') || location || post)) as event_id,
  date, time, cast(cast(date as varchar) || ' ' || time || ':00' as timestamp) as event_timestamp, location, direction, type,
  lanes_blocked, involved, post, link, post_seq
from prep join times using (post_seq) join lanes using (post_seq) join types using (post_seq)
  join directions using (post_seq) join locations using (post_seq) join involveds using (post_seq)
""",
    "filled": """
select * replace (cast(cast(date as varchar) || ' ' || time || ':00' as timestamp) as event_timestamp)
from (select * replace (last_value(time ignore nulls) over (order by post_seq rows between unbounded preceding and current row) as time) from parsed)
""",
    "dim_locations": DIM_LOCATIONS.replace("{location_id}", "sha256(city || location)"),
    "best_locations": _smallest("dim_locations", "location", "accuracy desc, location_id"),
    "gazetteer": GAZETTEER,
    "city_points": CITY_POINTS,
    "missing": "select distinct location from parsed where location not in (select location from dim_locations)",
    "resolved": """
select case when hit is null then '' else case
    when raw in ('PASAY', 'PASIG', 'MAKATI') then raw || ' CITY' when raw = 'KALOOKAN CITY' then 'CALOOCAN CITY'
    when regexp_full_match(raw, 'PARA.*AQUE') then 'PARANAQUE' else raw end end as city,
  location, coalesce(latitude, 0.0) as latitude, coalesce(longitude, 0.0) as longitude,
  case confidence when 'High' then 1.0 when 'Medium' then 0.5 else 0.0 end::double as accuracy
from (
  select m.location, g.location as hit, g.latitude, g.longitude, g.confidence, upper(coalesce(nullif(g.city, ''), c.city, '')) as raw
  from missing as m left join gazetteer as g using (location)
    left join city_points as c on round(g.latitude, 3) = round(c.latitude, 3) and round(g.longitude, 3) = round(c.longitude, 3)
)
""",
    "new_locations": """
select sha256(city || location) as location_id, city, location, latitude, longitude, accuracy
from resolved where city <> ''
""",
    "grown_locations": f"select {_DIM} from dim_locations union all select {_DIM} from new_locations",
    "best_grown": _smallest("grown_locations", "location", "accuracy desc, location_id"),
    "dim_direction": _values(rules.SEED_DIRECTIONS, "short_name, full_name"),
    "dim_vehicles": f"select *, 'NONE' as suggested_from, true as is_verified from ({_values(rules.SEED_VEHICLES, 'vehicle_type, vehicle_group')})",
    "vehicles": r"""
select event_id, post_seq, date, upper(case when c = '' then part else trim(name) end) as vehicle_type,
  case when c = '' then 1 else cast(c as int) end as vehicle_count
from (select event_id, post_seq, date, trim(part) as part, regexp_extract(trim(part), '^(\d+)\s+(.+)$', 1) as c,
        regexp_extract(trim(part), '^(\d+)\s+(.+)$', 2) as name
      from (select event_id, post_seq, date, unnest(string_split(involved, '|')) as part from parsed where involved <> ''))
""",
    "scores": """
select u.vehicle_type, d.vehicle_type as candidate, d.vehicle_group,
  1 - levenshtein(u.vehicle_type, d.vehicle_type) / greatest(length(u.vehicle_type), length(d.vehicle_type))::double
  + case when contains(u.vehicle_type, d.vehicle_type) or contains(d.vehicle_type, u.vehicle_type) then 0.15 else 0.0 end::double as score
from (select distinct vehicle_type from vehicles where vehicle_type not in (select vehicle_type from dim_vehicles)) as u
  cross join dim_vehicles as d
""",
    "suggestions": _smallest("scores", "vehicle_type", "score desc, candidate"),
    "classified": """
select v.event_id, v.vehicle_type, v.vehicle_count, coalesce(d.vehicle_group, s.vehicle_group, 'UNKNOWN') as vehicle_group,
  case when d.vehicle_type is not null then 'NONE' else s.candidate end as suggested_from,
  d.vehicle_type is not null as is_verified, v.date
from vehicles as v left join dim_vehicles as d using (vehicle_type) left join suggestions as s using (vehicle_type)
""",
    "located": f"select p.*, {', '.join('d.' + c for c in _DIM.split(', ') if c != 'location')} from parsed as p left join dim_locations as d using (location)",
    "located_best": f"select p.*, {', '.join('d.' + c for c in _DIM.split(', ') if c != 'location')} from parsed as p left join best_locations as d using (location)",
    "located_facts": _facts("located"),
    "first_staged": f"select * from located where date < date '{SECOND_LOAD}'",
    "first_facts": _facts("first_staged"),
    "first_events": _smallest("first_facts", "event_id", _FACT_ORDER),
    "all_events": _smallest("located_facts", "event_id", _FACT_ORDER),
    "staged_fev": "select sha256(event_id || '|' || vehicle_type) as fev_id, event_id, vehicle_type, vehicle_count, date from classified",
    "batch": f"select p.*, {', '.join('d.' + c for c in _DIM.split(', ') if c != 'location')} from filled as p left join best_grown as d using (location)",
    "day_filled": """
select * replace (fill as time, cast(cast(date as varchar) || ' ' || fill || ':00' as timestamp) as event_timestamp)
from (select *, last_value(time ignore nulls) over
        (partition by date order by post_seq rows between unbounded preceding and current row) as fill from parsed)
""",
    "day_events": f"select p.*, {', '.join('d.' + c for c in _DIM.split(', ') if c != 'location')} from day_filled as p left join best_locations as d using (location)",
    "batch_facts": _facts("batch"),
    "loaded_events": _smallest("batch_facts", "event_id", _FACT_ORDER),
    "loaded_vehicles": _smallest("staged_fev", "event_id, vehicle_type", "vehicle_count nulls first"),
    "page_blocks": PAGE_BLOCKS.replace("{posts}", "posts"),
    "timeline": PAGES.replace("{joined}", "string_agg(block, '' order by post_seq)")
    .replace("{page_blocks}", "page_blocks").replace("{pages}", "pages"),
    "part_types": PART_TYPES.replace("{part}", "part"),
    "part_names": PART_NAMES.replace("{part}", "part"),
    "part_scores": """
select n.vehicle_type, t.vehicle_type as candidate, t.vehicle_group,
  1 - levenshtein(n.vehicle_type, t.vehicle_type) / greatest(length(n.vehicle_type), length(t.vehicle_type))::double
  + case when contains(n.vehicle_type, t.vehicle_type) or contains(t.vehicle_type, n.vehicle_type) then 0.15 else 0.0 end::double as score
from part_names as n cross join part_types as t
""",
    "date_texts": DATE_TEXTS.replace("{events}", "events"),
}


def _sql(final: str) -> str:
    """The final SELECT with the table expressions it needs, in their order."""
    needed: set[str] = set()
    todo = [final]
    while todo:
        text = todo.pop()
        for name in CTES:
            if name not in needed and re.search(rf"\b(?:from|join)\s+{name}\b", text):
                needed.add(name)
                todo.append(CTES[name])
    ctes = ",\n".join(f"{name} as ({CTES[name].strip()})" for name in CTES if name in needed)
    return f"with {ctes}\n{final.strip()}"


_EVENT = (
    "event_id, date, time, event_timestamp, location_id, city, location, latitude, longitude, accuracy, "
    "direction, type, lanes_blocked, involved, post, link"
)
_STAR = [
    ("fact_events", "location_id", "located_facts", "dim_locations", "location_id"),
    ("fact_events", "direction_id", "located_facts", "dim_direction", "short_name"),
    ("fact_event_vehicles", "event_id", "staged_fev", "located_facts", "event_id"),
    ("fact_event_vehicles", "vehicle_type", "staged_fev", "dim_vehicles", "vehicle_type"),
]
_PARENT_NAMES = {"located_facts": "fact_events"}

ORACLES = {
    "posts": _sql("select * from posts"),
    "parse_time": _sql("select post_seq, time from times"),
    "parse_lanes": _sql("select post_seq, lanes_blocked from lanes"),
    "parse_type": _sql("select post_seq, type from types"),
    "parse_direction": _sql("select post_seq, direction from directions"),
    "parse_location": _sql("select post_seq, location from locations"),
    "parse_participants": _sql("select post_seq, participants from people"),
    "normalise_involved": _sql("select post_seq, involved from involveds"),
    "event_id": _sql("select post_seq, event_id from parsed"),
    "parse_dates": _sql(
        "select event_id, written, cast(try_strptime(written, ['%Y-%m-%d', '%Y-%m-%d %H:%M:%S', "
        "'%m/%d/%Y', '%m/%d/%Y %H:%M:%S']) as date) as date from date_texts"
    ),
    "parse_all_fields": _sql("select * from parsed"),
    "forward_fill_time": _sql("select post_seq, time, event_timestamp from filled"),
    "forward_fill_per_day": _sql("""
select post_seq, date, time, cast(cast(date as varchar) || ' ' || time || ':00' as timestamp) as event_timestamp
from (select post_seq, date, last_value(time ignore nulls) over
        (partition by date order by post_seq rows between unbounded preceding and current row) as time from parsed)
"""),
    "known_locations": _sql(f"select post_seq, {_DIM} from located"),
    "missing_locations": _sql("select location from missing"),
    "resolve_locations": _sql("select * from resolved"),
    "resolve_in_batches": _sql("""
select case when asked then 'PASIG CITY' end as city, location, case when asked then length(location)::double end as latitude,
  case when asked then 121.0::double end as longitude, case when asked then 0.5::double end as accuracy,
  case when place <= 95 then 2 else 1 end as attempts
from (select vehicle_type as location, row_number() over (order by vehicle_type) as place,
        place > 95 and length(vehicle_type) % 3 <> 0 as asked from part_names)
"""),
    "upsert_locations": _sql(f"""
select {_DIM}, false as inserted from dim_locations
union all select sha256(city || location), city, location, latitude, longitude, accuracy, true from resolved
"""),
    "explode_vehicles": _sql("select event_id, vehicle_type, vehicle_count, post_seq from vehicles"),
    "vehicle_suggestions": _sql(
        "select vehicle_type, candidate as suggested_from, vehicle_group, round(score, 9) as match_score from suggestions"
    ),
    "suggest_large_dimension": _sql("""
select vehicle_type, candidate as suggested_from, vehicle_group, round(score, 9) as match_score
from part_scores qualify row_number() over (partition by vehicle_type order by score desc, candidate) = 1
"""),
    "classify_vehicles": _sql("select * from classified"),
    "first_date_vehicles": _sql(
        "select * replace ((select date from parsed where date is not null order by post_seq limit 1) as date) from classified"
    ),
    "seed_coverage": _sql("""
select d.vehicle_type, any_value(d.vehicle_group) as vehicle_group, 'NONE' as suggested_from, true as is_verified,
  count(v.event_id) as mentions, cast(coalesce(sum(v.vehicle_count), 0) as bigint) as vehicles
from dim_vehicles as d left join vehicles as v using (vehicle_type) group by d.vehicle_type
"""),
    "event_type": _sql(f"select post_seq, case {_TYPE_CASES} else 'OTHERS' end as event_type from types"),
    "direction_ids": _sql("""
select post_seq, direction, coalesce(d.short_name, 'UNKNOWN') as direction_id
from directions as s left join dim_direction as d on s.direction in (d.short_name, d.full_name)
"""),
    "upsert_events": _sql("""
select *, false as inserted from first_events
union all select *, true from all_events where event_id not in (select event_id from first_events)
"""),
    "upsert_dim_vehicles": _sql("""
select vehicle_type, vehicle_group, suggested_from, is_verified, false as inserted from dim_vehicles
union all select distinct vehicle_type, vehicle_group, suggested_from, is_verified, true from classified
where vehicle_type not in (select vehicle_type from dim_vehicles)
"""),
    "upsert_event_vehicles": _sql(f"""
select fev_id, event_id, vehicle_type, min(vehicle_count) filter (where not is_new or only_new) as vehicle_count, only_new as inserted
from (select *, date >= date '{SECOND_LOAD}' as is_new, bool_and(date >= date '{SECOND_LOAD}') over (partition by fev_id) as only_new from staged_fev)
group by fev_id, event_id, vehicle_type, only_new
"""),
    "pk_violations": _sql("""
select 'dim_locations' as table_name, location_id as key_value, count(*) as copies from dim_locations group by location_id having count(*) > 1
union all select 'dim_direction', short_name, count(*) from dim_direction group by short_name having count(*) > 1
union all select 'dim_vehicles', vehicle_type, count(*) from dim_vehicles group by vehicle_type having count(*) > 1
union all select 'fact_events', event_id, count(*) from located_facts group by event_id having count(*) > 1
union all select 'fact_event_vehicles', fev_id, count(*) from staged_fev group by fev_id having count(*) > 1
"""),
    "fk_violations": _sql(
        "\nunion all ".join(
            f"select '{c}.{col}->{_PARENT_NAMES.get(p, p)}.{pcol}' as relation, {col} as key_value, count(*) as child_rows "
            f"from {src} where {col} not in (select {pcol} from {p}) group by {col}"
            for c, col, src, p, pcol in _STAR
        )
    ),
    "batch_events": _sql(f"select {_EVENT} from batch"),
    "batch_vehicles": _sql("select * from classified"),
    "fact_flow": _sql(f"select {_FACT} from ({_facts('located_best')})"),
    "load_star": _sql(f"""
select {_FACT}, vehicle_types, vehicles from loaded_events left join (
  select event_id, count(*) as vehicle_types, cast(sum(vehicle_count) as bigint) as vehicles from loaded_vehicles group by event_id
) using (event_id)
"""),
    "replay_unmarked_batch": _sql("".join(
        f"""{union}
select '{step}' as step, 'fact_events' as table_name, event_id as key, null::int as vehicle_count
from (select distinct event_id from parsed where {days})
union all
select '{step}', 'fact_event_vehicles', fev_id, vehicle_count
from (select fev_id, vehicle_count from staged_fev where {days}
      qualify row_number() over (partition by fev_id order by vehicle_count nulls first) = 1)
"""
        for union, step, days in (("", "broken", f"date < date '{SECOND_LOAD}'"), ("union all", "replayed", "true"))
    )),
    "staged_locations": _sql("""
select sha256(city || location) as location_id, city, location, latitude, longitude, accuracy,
  case when location < 'D' then 'first' else 'second' end as batch_id
from resolved
"""),
    "load_counts": _sql("""
select 'dim_direction' as table_name, null::date as event_date, count(*) as rows from dim_direction
union all select 'dim_vehicles', null, count(distinct vehicle_type) from (
  select vehicle_type from dim_vehicles union all select vehicle_type from classified)
union all select 'dim_locations', null, count(*) from grown_locations
union all select 'fact_events', date, count(distinct event_id) from parsed group by date
union all select 'fact_event_vehicles', date, count(distinct fev_id) from staged_fev group by date
"""),
    "audit_after_load": _sql("""
select 'orphan' as kind, 'fact_events.direction_id->dim_direction.short_name' as subject, direction_id as key_value, count(*) as found
from loaded_events where direction_id not in (select short_name from dim_direction) group by direction_id
union all
select 'orphan', 'fact_events.location_id->dim_locations.location_id', location_id, count(*)
from loaded_events where location_id not in (select location_id from grown_locations) group by location_id
"""),
    "daily_paths": _sql("""
select cast(d.day as date) as day, strftime(d.day, 'raw/scrape/%Y/%m/scrape_data_%Y%m%d.csv') as path, count(p.post_seq) as posts
from (select unnest(generate_series(min(created_at)::timestamp, max(created_at)::timestamp, interval 1 day)) as day from posts) as d
  left join posts as p on p.created_at = cast(d.day as date) group by d.day
"""),
    "csv_round_trip": _sql("""
select content, tweetlinkid, created_at from posts where created_at between date '2024-01-05' and date '2024-01-20'
"""),
    "historical_round_trip": _sql(
        "select event_id, date, location, direction, type, lanes_blocked, involved, post, link from parsed"
    ),
    "daily_ingest": _sql(f"select {_EVENT} from day_events where date = date '2024-01-10'"),
    "range_ingest": _sql(f"""
select {_EVENT}, event_type, direction_id
from day_events left join (select event_id, event_type, direction_id from all_events) using (event_id)
where date between date '2023-12-01' and date '2024-01-15'
"""),
    "initial_locations": _sql(
        "select sha256(city || location) as location_id, city, location, latitude, longitude, accuracy from resolved"
    ),
    "historical_parallel": _sql("""
select case when post_seq % 3 = 0 then content else 'He said "stop",' || chr(10) || content || chr(10) || '"' || post_seq end as content,
  tweetlinkid, created_at from posts
"""),
    "partition_round_trip": _sql(
        "select * from parsed where date between date '2024-01-05' and date '2024-01-20'"
    ),
    "extract_posts": _sql("""
select replace(content, 'and', '&') as content, 'https://x.com/MMDA/status/' || post_seq || '#m' as tweetlinkid, created_at
from posts where contains(content, 'MMDA ALERT') and post_seq % 50 <> 7
"""),
    "extract_day": _sql("""
select replace(content, 'and', '&') as content, 'https://x.com/MMDA/status/' || post_seq || '#m' as tweetlinkid, created_at
from posts where contains(content, 'MMDA ALERT') and post_seq % 50 <> 7 and created_at = date '2024-01-10'
"""),
    "fill_over_pages": _sql("""
select row_number() over (order by post_seq) - 1 as post_seq, 'https://x.com/MMDA/status/' || post_seq || '#m' as link,
  last_value(time ignore nulls) over (order by post_seq rows between unbounded preceding and current row) as time
from posts join times using (post_seq) where contains(content, 'MMDA ALERT') and post_seq % 50 <> 7
"""),
    "resolve_links": _sql(r"""
select page_id, link, case when link like 'http%' then link when contains(link, 'MMDA') then 'https://nitter.net' || link
  else 'https://nitter.net/MMDA' || link end as next_url
from (select page_id, replace(regexp_extract(regexp_extract_all(html, '<div class="show-more[^"]*"[^>]*>\s*(<a [^>]*>)', 1)[-1],
        'href="([^"]*)"', 1), '&amp;', '&') as link from timeline)
"""),
    "repeated_batch": _sql(
        "select event_id, date, location, direction, type, lanes_blocked, involved, post, link from parsed"
    ),
    "incremental_ingest": _sql(
        "select event_id, event_type, event_type_details, direction_id, lanes_blocked, post from all_events"
    ),
    "stream_first_of_each_event": _sql(f"""
select distinct event_id, event_timestamp, date from (
  select *, date < date '{SECOND_LOAD}' and day(date) % {HELD_BACK} <> 0 as early,
    coalesce(event_timestamp, date + interval 86399 seconds) as placed
  from parsed
)
where early or placed > (
  select max(coalesce(event_timestamp, date + interval 86399 seconds)) - interval 2 days
  from parsed where date < date '{SECOND_LOAD}' and day(date) % {HELD_BACK} <> 0
)"""),
}
