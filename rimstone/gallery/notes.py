"""Steps that the source notes describe."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rimstone.gallery.base import Registered, flat, table
from rimstone.operators.notes import (
    back_to_back,
    comment_texts,
    near_airports,
    page_verdicts,
    reference_faults,
    team_airports,
    travel,
    unresolved_codes,
    with_arena,
)


def nested_comment_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    comments = comment_texts(table(spark, sf_dir, "pages"), "page_id")
    return comments.withColumn("pos", F.col("pos").cast("bigint"))


NESTED_COMMENT_TEXT = """
select page_id, unnest(found) as comment, unnest(range(0, len(found))) as pos
from (select page_id, regexp_extract_all(html, '(?s)<!--(.*?)-->', 1) as found from pages)
"""


def page_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_verdicts(table(spark, sf_dir, "pages"), "page_id")


PAGE_QUARANTINE = """
select page_id, case when contains(html, 'cf-browser-verification') or contains(html, 'Just a moment') then 'challenge'
  when not contains(html, '<table') then 'no_table' else 'ok' end as verdict
from pages
"""


def back_to_back_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(back_to_back(table(spark, sf_dir, "orders"), "o_custkey", "o_orderdate"))


BACK_TO_BACK = """
select o_custkey, cast(game_day as varchar) as game_day
from (
  select o_custkey, game_day, lag(game_day) over (partition by o_custkey order by game_day) as before
  from (select distinct o_custkey, cast(o_orderdate as date) as game_day from orders)
)
where game_day - before = 1
"""

def _airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as airports: kind, country, code and place by their keys."""
    return table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey",
        "case s_suppkey % 4 when 0 then 'large_airport' when 1 then 'medium_airport' when 2 then 'heliport' end as type",
        "case s_nationkey % 3 when 0 then 'US' when 1 then 'CA' else 'MX' end as iso_country",
        "concat('A', lpad(cast(s_suppkey % 97 as string), 2, '0')) as iata_code",
        "cast(20 + s_suppkey * 7 % 300 / 10.0 as double) as latitude",
        "cast(-120 + s_nationkey * 13 % 500 / 10.0 as double) as longitude",
    )


AIRPORTS = """
airports as (
  select s_suppkey, case s_suppkey % 4 when 0 then 'large_airport' when 1 then 'medium_airport' when 2 then 'heliport' end as type,
    case s_nationkey % 3 when 0 then 'US' when 1 then 'CA' else 'MX' end as iso_country,
    'A' || lpad(cast(s_suppkey % 97 as varchar), 2, '0') as iata_code,
    cast(20 + s_suppkey * 7 % 300 / 10.0 as double) as latitude,
    cast(-120 + s_nationkey * 13 % 500 / 10.0 as double) as longitude
  from supplier
)"""
MARKETS = [f"A{i:02d}" for i in range(0, 97, 3)]


def market_airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return team_airports(near_airports(_airports(spark, sf_dir)), MARKETS)


MARKET_AIRPORTS = f"""with {AIRPORTS}
select * from airports
where type in ('large_airport', 'medium_airport') and iso_country in ('US', 'CA')
  and iata_code in (select 'A' || lpad(cast(i as varchar), 2, '0') from range(0, 97, 3) r(i))
"""


def airport_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reference_faults(_airports(spark, sf_dir), ["type", "iata_code"])


AIRPORT_FAULTS = f"""with {AIRPORTS}
select 'rows' as fault, count(*) as n from airports having count(*) <> 30
union all select 'null_type', count(*) from airports where type is null having count(*) > 0
union all select 'null_iata_code', count(*) from airports where iata_code is null having count(*) > 0
"""


def unresolved_markets(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = table(spark, sf_dir, "customer").selectExpr("concat('A', lpad(cast(c_custkey % 150 as string), 3, '0')) as iata_code")
    known = _airports(spark, sf_dir).withColumn("iata_code", F.concat(F.lit("A0"), F.substring("iata_code", 2, 2)))
    return unresolved_codes(codes, known, "iata_code")


UNRESOLVED_MARKETS = f"""with {AIRPORTS}
select distinct 'A' || lpad(cast(c_custkey % 150 as varchar), 3, '0') as iata_code from customer
except select 'A0' || substring(iata_code, 2, 2) from airports
"""


def _games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as games: a team, a day, and the venue by number."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "o_custkey % 30 as team", "cast(o_orderdate as date) as day", "o_custkey * 3 % 90 as venue"
    )


def game_arenas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Games with their venue; some venues are no supplier's number."""
    arenas = _airports(spark, sf_dir).selectExpr("s_suppkey as venue", "iata_code as arena")
    return with_arena(_games(spark, sf_dir).drop("day"), arenas, "venue")


GAME_ARENAS = f"""with {AIRPORTS}
select o_orderkey, o_custkey % 30 as team, o_custkey * 3 % 90 as venue, iata_code as arena
from orders left join airports on s_suppkey = o_custkey * 3 % 90
"""


def team_travel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kilometres from the venue before, one game a team and day; rounded to metres, as engines differ in the last bits."""
    games = _games(spark, sf_dir).groupBy("team", "day").agg(F.min("venue").alias("venue"))
    placed = games.withColumns({"latitude": F.expr("25 + venue / 4.0D"), "longitude": F.expr("-120 + venue / 2.0D")})
    return flat(travel(placed, "team", "day").withColumn("travel_km", F.round("travel_km", 3)).drop("latitude", "longitude"))


TEAM_TRAVEL = """
with games as (
  select o_custkey % 30 as team, cast(o_orderdate as date) as day, min(o_custkey * 3 % 90) as venue from orders group by 1, 2
),
pairs as (
  select *, radians(25 + venue / 4.0::double) as a, radians(-120 + venue / 2.0::double) as b,
    lag(radians(25 + venue / 4.0::double)) over w as a0, lag(radians(-120 + venue / 2.0::double)) over w as b0
  from games window w as (partition by team order by day)
)
select team, cast(day as varchar) as day, venue,
  round(2 * 6371.0088 * asin(sqrt(pow(sin((a - a0) / 2), 2) + cos(a0) * cos(a) * pow(sin((b - b0) / 2), 2))), 3) as travel_km
from pairs
"""

QUERIES: Registered = {
    "market_airports": (market_airports, MARKET_AIRPORTS),
    "airport_faults": (airport_faults, AIRPORT_FAULTS),
    "unresolved_markets": (unresolved_markets, UNRESOLVED_MARKETS),
    "game_arenas": (game_arenas, GAME_ARENAS),
    "team_travel": (team_travel, TEAM_TRAVEL),
    "nested_comment_text": (nested_comment_text, NESTED_COMMENT_TEXT),
    "page_quarantine": (page_quarantine, PAGE_QUARANTINE),
    "back_to_back": (back_to_back_days, BACK_TO_BACK),
}
