"""Inputs derived from the given tables, in SQL that Spark and DuckDB both run.

Names in braces are tables: Spark binds them to DataFrames, the SQL twins to views or
common table expressions of the same name.
"""

from pyspark.sql import DataFrame, SparkSession

from roadlark.session import spread

POSTS = """
select event_id as post_seq, cast(ts as date) as created_at,
       'https://example.com/status/' || cast(event_id as string) as tweetlinkid,
       case
         when event_id % 20 = 19 then 'Traffic is light'
         when event_type = 'signup' then 'MMDA ALERT: Rally at ' || road || ' more or less '
              || cast(10 + event_id % 90 as string) || ' pax as of ' || tm
         when event_type = 'error' then 'MMDA ALERT: Stalled ' || veh
              || ' due to mechanical problem at ' || road || ' ' || dir || ' as of ' || tm || '. ' || lanes
         else 'MMDA ALERT: ' || case event_type when 'click' then 'Road crash incident'
                                when 'view' then 'Vehicular accident' else 'Multiple collision' end
              || ' at ' || road || ' ' || dir || ' involving ' || veh || ' as of ' || tm || '. ' || lanes
       end as content
from (
  select event_id, ts, event_type,
    case when event_id % 7 = 3 then 'noon'
         else cast((extract(hour from ts) + 11) % 12 + 1 as string) || ':'
              || lpad(cast(extract(minute from ts) as string), 2, '0')
              || case when extract(hour from ts) < 12 then ' AM' else ' PM' end end as tm,
    case user_id % 5 when 0 then 'EDSA Ortigas' when 1 then 'C-5 Bagong Ilog'
         when 2 then 'Commonwealth Ave Tandang Sora' when 3 then 'Roxas Blvd Kalaw'
         else 'Marcos Highway' end as road,
    case event_id % 3 when 0 then 'NB' when 1 then 'Southbound' else 'EB' end as dir,
    case event_id % 4 when 0 then 'a car and 2 motorcycles' when 1 then 'jeepney, van and two trucks'
         when 2 then '16 wheeler truck' else 'SUV and modern jeepny' end as veh,
    case event_id % 3 when 0 then '1 lane occupied.' when 1 then 'two lanes occupied.'
         else 'Shoulder only.' end as lanes
  from {events}
) as e
"""

# One location in two cities, so that a plain location join fans out.
DIM_LOCATIONS = """
select {location_id} as location_id, city, location, cast(latitude as double) as latitude,
  cast(longitude as double) as longitude, cast(accuracy as double) as accuracy
from (values
  ('MANDALUYONG CITY', 'EDSA ORTIGAS', 14.5880, 121.0560, 1.0),
  ('PASIG CITY', 'EDSA ORTIGAS', 14.5879, 121.0565, 0.5),
  ('MARIKINA CITY', 'MARCOS HIGHWAY', 14.6190, 121.1020, 1.0)
) as v(city, location, latitude, longitude, accuracy)
"""

# Raw resolver answers; the location '' and one road have none.
GAZETTEER = """
select location, city, cast(latitude as double) as latitude, cast(longitude as double) as longitude, confidence
from (values
  ('C-5 BAGONG ILOG', 'Makati', 14.5600, 121.0650, 'High'),
  ('COMMONWEALTH AVE TANDANG SORA', 'Kalookan City', 14.6690, 121.0560, 'Medium'),
  ('ROXAS BLVD KALAW', cast(null as string), 14.5810, 120.9760, cast(null as string)),
  ('EDSA ORTIGAS', 'Pasig', 14.5880, 121.0560, 'Low')
) as v(location, city, latitude, longitude, confidence)
"""

# City by coordinates, in the upper case such a service answers in.
CITY_POINTS = """
select city, cast(latitude as double) as latitude, cast(longitude as double) as longitude
from (values ('PARAÑAQUE', 14.5810, 120.9760), ('MAKATI', 14.5600, 121.0650)) as v(city, latitude, longitude)
"""

# A large dimension of types, and names like them: shortened, stretched, misspelt, run together.
PART_TYPES = """
select name as vehicle_type, min(p_brand) as vehicle_group
from (select upper(p_name || ' ' || p_type || ' ' || p_brand || ' ' || cast(p_size as string)) as name, p_brand from {part}) as n
group by name
"""
PART_NAMES = """
select distinct case p_size % 4 when 0 then substr(name, 2) when 1 then replace(name, 'E', 'EE')
    when 2 then replace(name, 'A', 'O') else replace(name, ' ', '') end as vehicle_type
from (select p_size, upper(p_name || ' ' || p_type || ' ' || p_brand || ' ' || cast(p_size as string)) as name from {part}) as n
"""

DATE_TEXTS = """
select event_id,
  case event_id % 5
    when 0 then y || '-' || m || '-' || d
    when 1 then y || '-' || lpad(m, 2, '0') || '-' || lpad(d, 2, '0') || ' ' || h || ':' || lpad(mi, 2, '0') || ':07'
    when 2 then m || '/' || d || '/' || y
    when 3 then lpad(m, 2, '0') || '/' || lpad(d, 2, '0') || '/' || y || ' ' || h || ':' || mi || ':9'
    else 'on ' || y || '-' || m end as written
from (
  select event_id, cast(extract(year from ts) as string) as y, cast(extract(month from ts) as string) as m,
    cast(extract(day from ts) as string) as d, cast(extract(hour from ts) as string) as h,
    cast(extract(minute from ts) as string) as mi
  from {events}
) as e
"""

# Timeline pages of 25 posts each, plus the given raw pages, which hold no post.
PAGE_BLOCKS = """
select post_seq - post_seq % 25 as page_id, post_seq,
  '<div class="timeline-item "><div class="tweet-content media-body" dir="auto">'
  || replace(content, 'and', '&amp;') || '</div>'
  || case when post_seq % 50 = 7 then '' else
     '<span class="tweet-date"><a href="https://nitter.net/MMDA/status/' || cast(post_seq as string)
     || '#m" title="Jan ' || cast(extract(day from created_at) as string) || ', '
     || cast(extract(year from created_at) as string) || ' · 8:00 AM UTC">Jan '
     || cast(extract(day from created_at) as string)
     || '</a></span>' end
  || '</div>' as block
from {posts}
"""
PAGES = """
select page_id, 'https://example.org/timeline/' || cast(page_id as string) as url,
  '<html><body><div class="show-more"><a href="/MMDA">Load newest</a></div>' || blocks
  || case page_id % 4 when 0 then '<div class="show-more"><a href="/MMDA?cursor=' || cast(page_id as string) || '">more</a></div>'
     when 1 then '<div class="show-more"><a href="?cursor=' || cast(page_id as string) || '&amp;p=2">more</a></div>'
     when 2 then '<div class="show-more"><a href="https://nitter.net/x/' || cast(page_id as string) || '">more</a></div>'
     else '' end || '</body></html>' as html
from (select page_id, {joined} as blocks from {page_blocks} group by page_id) as g
union all
select -1 - page_id, url, html from {pages}
"""

# The days before this one are loaded first in the two-step load queries.
SECOND_LOAD = "2024-01-11"
# Of those, each day of the month that this divides arrives with the second load.
HELD_BACK = 5


class Inputs:
    """The derived tables of one data folder, as lazy DataFrames."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def events(self) -> DataFrame:
        return spread(self.table("events"))

    def posts(self) -> DataFrame:
        return self.spark.sql(POSTS, events=self.events())

    def date_texts(self) -> DataFrame:
        return self.spark.sql(DATE_TEXTS, events=self.events())

    def part_types(self) -> DataFrame:
        return self.spark.sql(PART_TYPES, part=self.table("part"))

    def part_names(self) -> DataFrame:
        return self.spark.sql(PART_NAMES, part=self.table("part"))

    def gazetteer(self) -> DataFrame:
        return self.spark.sql(GAZETTEER)

    def city_points(self) -> DataFrame:
        return self.spark.sql(CITY_POINTS)

    def dim_locations(self) -> DataFrame:
        return self.spark.sql(DIM_LOCATIONS.replace("{location_id}", "sha2(city || location, 256)"))

    def pages(self) -> DataFrame:
        blocks = self.spark.sql(PAGE_BLOCKS, posts=self.posts())
        joined = "listagg(block, '') within group (order by post_seq)"
        return self.spark.sql(
            PAGES.replace("{joined}", joined), page_blocks=blocks, pages=self.table("pages")
        )
