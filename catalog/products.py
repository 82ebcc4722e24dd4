"""The composite steps and the two end products.

The first queries use the tables as they are; those on the campaign's inputs (``catalog.inputs``)
run every step of the report from pages to products, and their SQL starts from the given tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import inputs
from catalog.registry import query
from catalog.sources import session_hours
from rosterlane import fixed_values as V
from rosterlane.functions.text import trim_ws
from rosterlane.operators import (
    conditional_distinct,
    distinct_concat,
    first_per_key,
    left_join,
    marks_by_key,
    stringify_all,
)
from rosterlane.plans import (
    attach_flags,
    build_base,
    build_detail,
    build_trend,
    enrich_contacts,
    form_choice,
    inperson_participation,
    participation_flags,
    payer_list,
    portal_state,
    status_by_plan,
)
from rosterlane.schemas import FLAG_SUFFIXES, FLAGS, INGEST_SEQ, pair
from rosterlane.sources import inperson_engagements

EVENT_DATE = "01/02/2025"


# On the tables as they are.


def event_mark(kind: str) -> str:
    return f"event_type = '{kind}' and value > 20"


@query(
    """select c_custkey, coalesce(bool_or(event_type='signup' and value>20),false) as registered_a,
  coalesce(bool_or(event_type='view' and value>20),false) as attended_a,
  coalesce(bool_or(event_type='click' and value>20),false) as registered_b,
  coalesce(bool_or(event_type='purchase' and value>20),false) as attended_b
  from customer left join events on user_id=c_custkey group by 1""",
    name="participation_flags",
)
def event_flags(t):
    marks = {
        "registered_a": event_mark("signup"),
        "attended_a": event_mark("view"),
        "registered_b": event_mark("click"),
        "attended_b": event_mark("purchase"),
    }
    flags = marks_by_key(t.events, "user_id", marks)
    return attach_flags(t.customer.select("c_custkey"), flags, "c_custkey", "user_id", list(marks))


@query(
    """with f as (select * from orders where o_orderpriority in ('1-URGENT','2-HIGH')
  qualify row_number() over (partition by o_custkey,o_orderpriority order by o_orderkey)=1)
  select c_custkey, coalesce(max(case when o_orderpriority='1-URGENT' then o_orderstatus end),
    'Not Registered') as status, coalesce(max(case when o_orderpriority='2-HIGH'
    then o_orderstatus end),'Not Registered') as status_hh
  from customer left join f on o_custkey=c_custkey group by 1""",
    name="status_by_plan",
)
def order_status(t):
    enrolments = t.orders.select(
        F.col("o_custkey").alias("AGENCY_TAX_ID"),
        F.col("o_orderpriority").alias("LEARNING_PLAN_NAME"),
        F.col("o_orderstatus").alias("LEARNING_PLAN_ENROLLMENT_STATUS"),
        F.col("o_orderkey").alias(INGEST_SEQ),
    )
    plans = {"1-URGENT": "status", "2-HIGH": "status_hh"}
    return status_by_plan(t.customer.select("c_custkey"), enrolments, "c_custkey", plans)


def supplier_portals(t):
    return t.supplier.select(
        F.col("s_suppkey").alias("TAX_ID"),
        F.col("s_name").alias("PLATFORM_TAG"),
        F.col("s_suppkey").alias("PROVIDER_ID"),
        F.col("s_suppkey").alias(INGEST_SEQ),
    )


@query(
    """select c_custkey, case when s_suppkey is null then 'False' else 'True' end as portal_created,
  s_name as portal_type from customer left join supplier on s_suppkey=c_custkey""",
    name="portal_state",
)
def supplier_state(t):
    state = portal_state(t.customer.select("c_custkey"), supplier_portals(t), "c_custkey")
    return state.select(
        "c_custkey",
        F.col("PORTAL_CREATED").alias("portal_created"),
        F.col("PORTAL_TYPE").alias("portal_type"),
    )


@query("""with fl as (select user_id, bool_or(event_type='signup' and value>20) as r,
    bool_or(event_type='view' and value>20) as a from events group by 1),
  ch as (select o_custkey, o_orderstatus as choice from orders where o_orderpriority='3-MEDIUM'
    qualify row_number() over (partition by o_custkey order by o_orderkey)=1),
  py as (select o_custkey, string_agg(distinct o_orderpriority, ', ' order by o_orderpriority)
    as payers from orders where o_orderstatus='F' group by 1)
  select c_custkey::varchar as provider_tax_id, c_mktsegment as wave,
    case when coalesce(r,false) then 'True' else 'False' end as registered,
    case when coalesce(a,false) then 'True' else 'False' end as attended,
    coalesce(choice,'Missing') as choice, coalesce(payers,'nan') as payers,
    case when s_suppkey is null then 'False' else 'True' end as portal_created
  from customer left join fl on user_id=c_custkey left join ch on ch.o_custkey=c_custkey
  left join py on py.o_custkey=c_custkey left join supplier on s_suppkey=c_custkey""")
def detail_report(t):
    key = "provider_tax_id"
    roster = t.customer.select(F.col("c_custkey").alias(key), F.col("c_mktsegment").alias("wave"))
    marks = {"registered": event_mark("signup"), "attended": event_mark("view")}
    flags = marks_by_key(t.events, "user_id", marks)
    medium = t.orders.where(F.col("o_orderpriority") == "3-MEDIUM")
    choice = first_per_key(
        medium.select("o_custkey", F.col("o_orderstatus").alias("choice"), "o_orderkey"),
        ["o_custkey"],
        ["o_orderkey"],
    ).drop("o_orderkey")
    payers = distinct_concat(
        t.orders.where(F.col("o_orderstatus") == "F").withColumnRenamed("o_custkey", "payer_id"),
        "payer_id",
        {"o_orderpriority": "payers"},
    )
    rows = attach_flags(roster, flags, key, "user_id", list(marks))
    rows = left_join(rows, choice, key, "o_custkey", unique=True, even=True)
    rows = left_join(rows, payers, key, "payer_id", unique=True, even=True)
    rows = rows.drop("o_custkey", "payer_id").fillna("Missing", ["choice"])
    rows = portal_state(rows, supplier_portals(t), key)
    return stringify_all(
        rows.drop("PROVIDER_ID", "PORTAL_TYPE").withColumnRenamed(
            "PORTAL_CREATED", "portal_created"
        )
    )


@query("""with d as (select c_custkey, c_mktsegment, coalesce(o_orderstatus,'Missing') as choice,
    s_suppkey from customer left join (select distinct o_custkey, o_orderstatus from orders
    where o_orderpriority='3-MEDIUM') o on o_custkey=c_custkey
    left join supplier on s_suppkey=c_custkey)
  select count(distinct c_custkey) as provider_count,
    count(distinct case when c_mktsegment='BUILDING' then c_custkey end) as building_count,
    count(distinct case when choice<>'Missing' then c_custkey end) as completed_form,
    count(distinct case when choice='F' then c_custkey end) as choice_f,
    count(distinct case when choice='O' then c_custkey end) as choice_o,
    count(distinct case when c_mktsegment='BUILDING' and s_suppkey is not null then c_custkey end)
      as building_portals from d""")
def trend_snapshot(t):
    medium = t.orders.where(F.col("o_orderpriority") == "3-MEDIUM")
    marks = {
        "completed_form": "o_orderstatus <> 'Missing'",
        "choice_f": "o_orderstatus = 'F'",
        "choice_o": "o_orderstatus = 'O'",
    }
    choices = marks_by_key(medium, "o_custkey", marks)
    roster = t.customer.select("c_custkey", "c_mktsegment")
    rows = portal_state(roster, supplier_portals(t), "c_custkey")
    rows = left_join(rows, choices, "c_custkey", "o_custkey", unique=True, even=True)
    building = "c_mktsegment = 'BUILDING'"
    return conditional_distinct(
        rows,
        "c_custkey",
        {
            "provider_count": None,
            "building_count": building,
            **{name: name for name in marks},
            "building_portals": f"{building} and PORTAL_CREATED = 'True'",
        },
    )


# On the campaign's inputs.

WAVE_SQL = """case when c_mktsegment='BUILDING' then 'Home Help'
  when c_mktsegment='MACHINERY' then 'Home Health' else 'PCS' end"""

ROSTER_SQL = f"""twice as (
  select *, c_name as name, {WAVE_SQL} as wave, c_custkey as seq from customer
  union all
  select *, c_name||' bis', 'PCS', c_custkey+1000000000 from customer where c_nationkey<5),
roster as (
  select case when c_nationkey<24 then (100000000+c_custkey)::varchar end as tax_id, name, wave,
    c_nationkey::varchar as npi, lpad(c_nationkey::varchar,5,'0') as zip, c_mktsegment as city,
    case when c_acctbal>0 then 'MI' end as state, case when c_acctbal>5000 then 'Yes' end as known,
    case when c_acctbal>=5000 then 'c'||c_custkey||'@x.org' when c_acctbal>=2000 then '  ' end
      as email, seq from twice
  qualify row_number() over (partition by wave, tax_id order by seq)=1)"""

# Contacts are ranked over all ids: for ids with an email the pick is not used.
CONTACT_SQL = """picked as (
  select (100000000+o_custkey)::varchar as tax_id, 'o'||o_orderkey||'@crm.org' as email from orders
  where o_orderstatus<>'P' and o_orderpriority<>'4-NOT SPECIFIED'
  qualify row_number() over (partition by o_custkey order by
    case o_orderpriority when '1-URGENT' then 0 when '2-HIGH' then 1 when '3-MEDIUM' then 3 else 9
    end, 'o'||o_orderkey||'@crm.org')=1),
enriched as (
  select r.* exclude (email), case when trim(coalesce(r.email,''))='' then
    coalesce(p.email, r.email) else r.email end as email
  from roster r left join picked p on p.tax_id=r.tax_id)"""

FORM_SQL = f"""sheet as (
  select floor(o_orderkey/4)::bigint as submitter, case when o_orderpriority not in
    ('1-URGENT','4-NOT SPECIFIED') then o_custkey+100000000 end as tax_id,
    case when o_orderstatus='F' then o_orderkey end as npi,
    case o_orderstatus when 'F' then '{V.CHOICE_LABELS["YES_INTEGRATE_EDI"]}'
      when 'O' then '{V.CHOICE_LABELS["NO_EVV_SYSTEM"]}' end as choice, o_orderkey as seq
  from orders),
repaired as (
  select submitter, seq,
    coalesce(last_value(tax_id ignore nulls) over before,
      first_value(tax_id ignore nulls) over after) as tax_id,
    coalesce(last_value(npi ignore nulls) over before, first_value(npi ignore nulls) over after)
      as npi,
    coalesce(first_value(choice ignore nulls) over after,
      last_value(choice ignore nulls) over before) as choice
  from sheet window before as (partition by submitter order by seq
      rows between unbounded preceding and current row),
    after as (partition by submitter order by seq
      rows between current row and unbounded following)),
forms as (
  select submitter, tax_id::varchar as tax_id, npi, choice, seq from repaired
  where tax_id is not null
  qualify row_number() over (partition by submitter, tax_id order by seq)=1)"""

PAYER_SQL = """payer as (
  select (100000000+o_custkey)::varchar as tax_id,
    string_agg(distinct o_orderpriority, ', ' order by o_orderpriority) as payers,
    string_agg(distinct case when o_totalprice>470000 then 'Home Help' else 'PCS' end, ', '
      order by case when o_totalprice>470000 then 'Home Help' else 'PCS' end) as wave
  from orders group by o_custkey)"""


def flag_sql(suffix: str) -> str:
    attended, registered = pair(suffix)
    return (
        f"coalesce(bool_or(session='{suffix}' and attended), false) as {attended}, "
        f"coalesce(bool_or(session='{suffix}' and registered), false) as {registered}"
    )


PARTICIPATION_SQL = f"""records as (
  select (100000000+user_id)::varchar as tax_id, session, true as registered,
    event_type='signup' and value>20 as attended
  from events join {session_hours()} on hour=extract(hour from ts)
  where event_type='signup' or (event_type='click' and value>40)
  union all
  select (100000000+user_id)::varchar, '{V.INPERSON_SUFFIX}', value>100, value<5 from events
  where event_type in ('purchase','view') and (value>100 or value<5))"""

FLAGS_SQL = f"""{PARTICIPATION_SQL},
flags as (select tax_id, {", ".join(map(flag_sql, FLAG_SUFFIXES))} from records group by tax_id)"""

STATUS_SQL = """enrolment as (
  select (100000000+o_custkey)::varchar as tax_id, o_orderpriority as plan,
    case o_orderstatus when 'F' then 'Completed' when 'O' then 'In Progress' else 'Enrolled' end
      as status
  from orders where o_totalprice>50000 and o_orderpriority in ('1-URGENT','2-HIGH')
  qualify row_number() over (partition by o_custkey, o_orderpriority order by o_orderkey)=1),
status as (
  select tax_id, max(status) filter (where plan='1-URGENT') as health,
    max(status) filter (where plan='2-HIGH') as help from enrolment group by tax_id)"""

PORTAL_SQL = """portal as (
  select (100000000+s_suppkey//2)::varchar as tax_id, s_suppkey as provider_id,
    case when s_acctbal>5000 then 'Paid' else 'Free' end as portal_type
  from supplier where s_nationkey<>3 and s_nationkey<18
  qualify row_number() over (partition by s_suppkey//2 order by s_suppkey)=1)"""

ALL_FLAGS = ", ".join(f"coalesce(f.{flag}, false) as {flag}" for flag in FLAGS)

BASE_SQL = f"""with {ROSTER_SQL}, {CONTACT_SQL}, {FORM_SQL}, {PAYER_SQL}, {FLAGS_SQL},
{STATUS_SQL}, {PORTAL_SQL},
base as (
  select e.tax_id as id, e.* exclude (tax_id), {ALL_FLAGS},
    coalesce(s.health,'Not Registered') as health, coalesce(s.help,'Not Registered') as help,
    y.payers, p.tax_id is not null as has_portal, p.provider_id, p.portal_type
  from enriched e left join flags f on f.tax_id=e.tax_id left join status s on s.tax_id=e.tax_id
  left join payer y on y.tax_id=e.tax_id and y.wave=e.wave
  left join portal p on p.tax_id=e.tax_id)"""


@query(f"with {PARTICIPATION_SQL} select distinct tax_id, session, registered, attended "
       f"from records where session<>'{V.INPERSON_SUFFIX}'")
def webinar_records(t):
    """Catalogue, instances, participants and registrants, from pages to one relation."""
    return inputs.participation(t).distinct().toDF("tax_id", "session", "registered", "attended")


@query(f"with {FLAGS_SQL} select c_custkey, {ALL_FLAGS} from customer left join flags f "
       "on f.tax_id=(100000000+c_custkey)::varchar")
def webinar_flags(t):
    """All 26 flags; one session has no webinar at all and is False for everybody."""
    inperson = inperson_participation(inperson_engagements(inputs.engagements(t)))
    flags = participation_flags(inputs.participation(t).unionByName(inperson))
    roster = t.customer.selectExpr("c_custkey", f"{inputs.tax_id('c_custkey')} as id")
    return attach_flags(roster, flags, "id", "TAX_ID").drop("id")


@query(f"""with {PARTICIPATION_SQL} select c_custkey,
  coalesce(bool_or(registered), false) as registered, coalesce(bool_or(attended), false) as attended
  from customer left join records on tax_id=(100000000+c_custkey)::varchar
  and session='{V.INPERSON_SUFFIX}' group by 1""")
def inperson_flags(t):
    """The pair of the in-person event, by the name and kind of the engagement."""
    records = inperson_participation(inperson_engagements(inputs.engagements(t)))
    flags = marks_by_key(records, "TAX_ID", {"registered": "REGISTERED", "attended": "ATTENDED"})
    roster = t.customer.selectExpr("c_custkey", f"{inputs.tax_id('c_custkey')} as id")
    return attach_flags(roster, flags, "id", "TAX_ID", ["registered", "attended"]).drop("id")


@query(f"with {ROSTER_SQL}, {CONTACT_SQL} select seq, tax_id, email from enriched",
       name="enrich_contacts")
def roster_emails(t):
    roster = inputs.roster(t).withColumn(V.ROSTER_TAX_ID, trim_ws(F.col(V.ROSTER_TAX_ID)))
    roster = first_per_key(roster, [V.ROSTER_WAVE, V.ROSTER_TAX_ID], [INGEST_SEQ])
    enriched = enrich_contacts(roster, inputs.contact(t), inputs.account(t))
    return enriched.select(
        F.col(INGEST_SEQ).alias("seq"),
        F.col(V.ROSTER_TAX_ID).alias("tax_id"),
        F.col(V.ROSTER_EMAIL).alias("email"),
    )


@query(f"with {FORM_SQL} select submitter, tax_id, npi, choice, seq from forms", name="form_choice")
def form_choices(t):
    forms = form_choice(inputs.form(t))
    columns = (V.FORM_GROUP, V.FORM_TAX_ID, V.FORM_NPI, V.FORM_CHOICE, INGEST_SEQ)
    return forms.select(*columns).toDF("submitter", "tax_id", "npi", "choice", "seq")


@query(f"with {PAYER_SQL} select tax_id, payers, wave from payer", name="payer_list")
def payers_of(t):
    return payer_list(inputs.payers(t)).select(
        F.col("PAYER_TAX_ID").alias("tax_id"),
        F.col("PAYERS").alias("payers"),
        F.col("PAYER_WAVE").alias("wave"),
    )


def text_flag(flag: str) -> str:
    return f"case when {flag} then 'True' else 'False' end as {flag}"


@query(f"""{BASE_SQL},
choice as (select tax_id, choice from forms
  qualify row_number() over (partition by tax_id order by seq)=1)
select coalesce(id,'nan') as PROVIDER_TAX_ID, name as PROVIDER_NAME, npi as PROVIDER_NPI_NUMBER,
  coalesce(id||npi,'nan') as TAX_ID_NPI, 'nan' as PROVIDER_ADDRESS_1, city as PROVIDER_CITY,
  coalesce(state,'nan') as PROVIDER_STATE, zip as PROVIDER_ZIP_CODE, 'nan' as PROVIDER_CONTACT_NAME,
  coalesce(email,'nan') as PROVIDER_EMAIL_ADDRESS, 'nan' as PROVIDER_PHONE_NUMBER,
  coalesce(known,'nan') as {V.ROSTER_COLUMNS[V.ROSTER_KNOWN]}, wave as WAVE, {", ".join(map(text_flag, FLAGS))},
  health as {V.DETAIL_ENROLMENT[0]}, help as {V.DETAIL_ENROLMENT[1]},
  coalesce(choice, '{V.MISSING_FORM}') as EVV_SYSTEM_CHOICE, coalesce(payers,'nan') as PAYERS,
  case when has_portal then 'True' else 'False' end as PORTAL_CREATED, provider_id as PROVIDER_ID,
  portal_type as PORTAL_TYPE, '{EVENT_DATE}' as EVENT_DATE
from base left join choice on choice.tax_id=id""")
def campaign_detail(t):
    """The 47 columns of the detail snapshot, from raw pages and sheets."""
    campaign = inputs.campaign_inputs(t)
    return build_detail(build_base(campaign), form_choice(campaign.form), EVENT_DATE)


# The labels behind the counted forms and enrolments, as the report lists them.
COUNTED_FORMS = V.CHOICE_LABELS
COUNTED_STATES = V.ENROLMENT_LABELS


def metric_sql() -> str:
    """The 45 counts over ``rows``, group by group as the report's columns are listed: providers by
    wave, forms, a pair of flags per session, form choices, enrolments per plan, portals by wave."""

    def counted(name: str, condition: str) -> str:
        return f"count(distinct id) filter (where {condition}) as {name}"

    waves = {"HH": "Home Help", "HEALTH": "Home Health", "PCS": "PCS"}
    counts = ["count(distinct id) as PROVIDER_COUNT"]
    counts += [counted(f"{w}_PROVIDER_COUNT", f"wave='{waves[w]}'") for w in ("HH", "HEALTH")]
    counts.append(counted("COMPLETED_ONBOARDING_FORM", f"choice<>'{V.MISSING_FORM}'"))
    for suffix in FLAG_SUFFIXES:
        counts += [counted(f"{m}_{suffix}", f"{m}_{suffix}") for m in ("ATTENDED", "REGISTERED")]
    counts += [counted(name, f"choice='{label}'") for name, label in COUNTED_FORMS.items()]
    for prefix, column in (("LMS", "health"), ("LMS_HH", "help")):
        counts += [
            counted(f"{prefix}_{name}", f"{column}='{label}'")
            for name, label in COUNTED_STATES.items()
        ]
    counts += [counted(f"{w}_PORTALS_CREATED", f"has_portal and wave='{n}'") for w, n in waves.items()]
    counts.append(counted("PORTALS_CREATED", "has_portal"))
    return ", ".join(counts)


@query(f"""{BASE_SQL},
rows as (select base.*, coalesce(forms.choice,'{V.MISSING_FORM}') as choice
  from base left join forms on forms.tax_id=id)
select date '2025-01-02' as EVENT_DATE, {metric_sql()} from rows""")
def campaign_trend(t):
    """The date and the 45 counts of the trend snapshot."""
    campaign = inputs.campaign_inputs(t)
    return build_trend(build_base(campaign), form_choice(campaign.form), EVENT_DATE)
