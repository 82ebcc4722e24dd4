"""Landed pages that are broken, lost or out of order."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import inputs
from catalog.products import FLAGS_SQL
from catalog.registry import query
from catalog.sources import fresh_folder, session_hours
from rosterlane import schemas
from rosterlane.plans import (
    attach_flags,
    inperson_participation,
    page_account,
    participation_flags,
    webinar_participation,
)
from rosterlane.schemas import FLAGS, pair
from rosterlane.sources import inperson_engagements, page_chains, read_pages

# Registrants of the fifth hour and of the thirteenth, participants of one day of the third.
BROKEN_HOURS = (5, 13)
BROKEN_UUID = "3/"
KINDS = {
    "catalogue": ("webinars", schemas.WEBINAR, []),
    "instances": ("webinars", schemas.INSTANCE, ["webinar_id"]),
    "participants": ("participants", schemas.PARTICIPANT, ["uuid"]),
    "registrants": ("registrants", schemas.REGISTRANT, ["webinar_id"]),
    "upcoming": ("registrants", schemas.REGISTRANT, ["webinar_id"]),
}


def landed(t):
    """The campaign's pages as JSON files, some of them cut off at the end, read with what is broken."""
    made = inputs.webinar_pages(t)
    frames = (made.catalogue, made.instances, made.participants, made.registrants, made.upcoming)
    hours = ", ".join(f"'{hour}'" for hour in BROKEN_HOURS)
    cut = {"registrants": f"webinar_id in ({hours})", "participants": f"uuid like '{BROKEN_UUID}%'"}
    folder, pages = fresh_folder(t.spark, "pages"), []
    for frame, (kind, (records, record, parents)) in zip(frames, KINDS.items()):
        text = F.to_json(F.struct(*frame.columns))
        broken = F.expr(cut.get(kind, "false"))
        short = F.when(broken, F.left(text, F.length(text) - 3)).otherwise(text)
        frame.select(short.alias("value")).write.text(f"{folder}/{kind}")
        pages.append(read_pages(t.spark, f"{folder}/{kind}", records, record, parents, keep_broken=True))
    return pages


def lost_flags() -> set[str]:
    places = {hour % 12 for hour in (*BROKEN_HOURS, int(BROKEN_UUID[:-1]))}
    return {flag for place in places for flag in pair(schemas.FLAG_SUFFIXES[place])}


KEPT_FLAGS = ", ".join(
    f"false as {flag}" if flag in lost_flags() else f"coalesce(f.{flag}, false) as {flag}" for flag in FLAGS
)


@query(f"with {FLAGS_SQL} select c_custkey, {KEPT_FLAGS} from customer left join flags f "
       "on f.tax_id=(100000000+c_custkey)::varchar")
def webinar_flags_broken_page(t):
    """Sessions with a broken page have no flags, all others have theirs."""
    pages = landed(t)
    participation = webinar_participation(*pages, account=page_account(*pages))
    inperson = inperson_participation(inperson_engagements(inputs.engagements(t)))
    flags = participation_flags(participation.unionByName(inperson))
    roster = t.customer.selectExpr("c_custkey", f"{inputs.tax_id('c_custkey')} as id")
    return attach_flags(roster, flags, "id", "TAX_ID").drop("id")


def counted_pages(kind: str, rows: str, parent: str, broken: str) -> str:
    """SQL of the pages of one kind and session, of which some parents are broken."""
    return f"""select '{kind}' as kind, session, count(*) as pages, sum(({broken})::int)::bigint as broken
      from (select distinct hour, {parent} as parent, event_id // {inputs.PAGE_ROWS} as page from e where {rows})
      left join {session_hours()} using (hour) group by session"""


IN_BROKEN_HOUR = f"parent in ({', '.join(map(str, BROKEN_HOURS))})"


@query(f"""with e as (select event_id, event_type, value, extract(hour from ts) as hour,
    extract(hour from ts) || '/' || strftime(ts, '%Y%m%d') as uuid from events),
  counts as (
    select 'catalogue' as kind, 'all sessions' as session, count(distinct hour) as pages, 0::bigint as broken from e
    union all select 'instances', session, count(*), 0 from (select distinct hour, uuid from e)
      left join {session_hours()} using (hour) group by session
    union all {counted_pages("participants", "event_type in ('signup', 'view')", "uuid", f"parent like '{BROKEN_UUID}%'")}
    union all {counted_pages("registrants", "event_type = 'signup'", "hour", IN_BROKEN_HOUR)}
    union all {counted_pages("upcoming", "event_type = 'click' and value > 40", "hour", "false")})
  select kind, session, pages, broken, 0::bigint as open_chains, broken = 0 as usable from counts""",
       name="page_account")
def page_account_of(t):
    return page_account(*landed(t)).select(
        *(F.col(c).alias(c.lower()) for c in ("KIND", "SESSION", "PAGES", "BROKEN", "OPEN_CHAINS")), "usable"
    )


def chained_pages(t):
    """Pages of a user's events, each with the token it was asked for and that of the next page."""
    pages = t.events.select(
        F.col("user_id").cast("string").alias("user_id"), F.expr(f"floor(event_id / {inputs.PAGE_ROWS})").alias("page")
    ).distinct()
    numbered = pages.selectExpr(
        "user_id",
        "row_number() over (partition by user_id order by page) as n",
        "count(*) over (partition by user_id) as last",
    )
    return numbered.selectExpr(
        "user_id", "n", "last", "if(n = 1, null, concat('t', n)) as page_token",
        "if(n = last, '', concat(' t', n + 1)) as next_page_token",
    )


CHAINED_SQL = f"""with pages as (select user_id, count(distinct event_id // {inputs.PAGE_ROWS}) as n
  from events group by user_id)"""


@query(f"""{CHAINED_SQL} select user_id::varchar as user_id, n as pages, n as chained, 'complete' as state,
  null::varchar as missing from pages""")
def page_chain_complete(t):
    """Every chain comes to its end; some pages landed twice are one page of it."""
    pages = chained_pages(t)
    again = pages.where("n % 2 = 0 and user_id % 2 = 0")
    chains = page_chains(pages.unionByName(again), ["user_id"])
    return chains.withColumn("pages", F.col("pages") - F.when(F.expr("user_id % 2 = 0"), F.expr("chained div 2")).otherwise(0))


@query(f"""{CHAINED_SQL}, kinds as (select *, user_id % 7 as k from pages)
  select user_id::varchar as user_id, case when k = 1 and n >= 3 or k = 3 then n - 1 else n end as pages,
    case when k = 1 and n >= 3 then 2 when k = 2 and n >= 2 then null when k = 3 then null
      when k = 4 and n >= 3 then 2 when k = 5 then null else n end as chained,
    case when k = 1 and n >= 3 then 'hole' when k = 2 and n >= 2 then 'cycle' when k = 3 then 'no first page'
      when k = 4 and n >= 3 then 'pages out of reach' when k = 5 then 'forked' else 'complete' end as state,
    case when k = 1 and n >= 3 then 't3' end as missing
  from kinds where not (k = 3 and n = 1) and k <> 5
  union all select user_id::varchar, n + 1, null, 'forked', null from kinds where k = 5""")
def page_chain_gaps(t):
    """Lost pages, first ones too, chains that come back, end too early or go on in two ways."""
    pages = chained_pages(t).withColumn("k", F.expr("user_id % 7"))
    kept = pages.where("not (k = 1 and n = 3) and not (k = 3 and n = 1)")
    bent = kept.withColumn(
        "next_page_token",
        F.expr("""case when k = 2 and n = last and n > 1 then 't2' when k = 4 and n = 2 then null
          else next_page_token end"""),
    )
    forked = pages.where("k = 5 and n = last").withColumn("next_page_token", F.lit("elsewhere"))
    return page_chains(bent.unionByName(forked), ["user_id"])
