"""The campaign's inputs, derived row by row from the given tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.registry import Tables
from rosterlane import fixed_values as V
from rosterlane.plans import CampaignInputs, webinar_participation
from rosterlane.schemas import INGEST_SEQ

PAGE_ROWS = 100

# Topic per hour of the day: the twelve sessions, six of them again, then topics that differ by a
# space at the end, which only the trimmed session overlooks. The eighth has no webinar.
NO_WEBINAR = 7


def topics() -> list[str]:
    exact = [s.topic for s in V.SESSIONS]
    exact[NO_WEBINAR] = exact[NO_WEBINAR].upper()
    return exact + exact[:6] + [t + " " for t in exact[6:]]


def tax_id(column: str) -> str:
    return f"cast({column} + 100000000 as string)"


def dashed(text: str) -> str:
    return f"concat(left({text}, 2), '-', substring({text}, 3))"


def roster(t: Tables) -> DataFrame:
    """Customers, and those of the first nations a second time in the last wave."""
    key = f"if(c_nationkey < 24, {tax_id('c_custkey')}, null)"
    wave = (
        f"case when c_mktsegment = 'BUILDING' then '{V.WAVE_HELP}'"
        f" when c_mktsegment = 'MACHINERY' then '{V.WAVE_HEALTH}' else '{V.WAVE_PCS}' end"
    )
    values = {
        "Provider TAX ID": f"if(c_mktsegment = 'BUILDING', concat(' ', {key}, '\t'), {key})",
        "Provider Name": "c_name",
        "Provider NPI Number": "cast(c_nationkey as string)",
        "Tax ID+NPI": f"concat({key}, c_nationkey)",
        "Provider Address 1": "cast(null as string)",
        "Provider City": "c_mktsegment",
        "Provider State": "if(c_acctbal > 0, 'MI', null)",
        "Provider Zip Code": "lpad(c_nationkey, 5, '0')",
        "Provider Contact Name": "cast(null as string)",
        "Provider Email Address": "case when c_acctbal >= 5000 then"
        " concat('c', c_custkey, '@x.org') when c_acctbal >= 2000 then '  ' end",
        "Provider Phone Number ": "cast(null as string)",
        V.ROSTER_KNOWN: "if(c_acctbal > 5000, 'Yes', null)",
        "Wave": wave,
        INGEST_SEQ: "c_custkey",
    }
    again = values | {
        "Provider Name": "concat(c_name, ' bis')",
        "Wave": f"'{V.WAVE_PCS}'",
        INGEST_SEQ: "c_custkey + 1000000000",
    }
    second = t.customer.where("c_nationkey < 5")
    return _columns(t.customer, values).unionByName(_columns(second, again))


def _columns(df: DataFrame, values: dict[str, str]) -> DataFrame:
    return df.selectExpr(*(f"{value} as `{name}`" for name, value in values.items()))


def form(t: Tables) -> DataFrame:
    """Four orders in a row are the forms of one submitter."""
    values = {
        V.FORM_GROUP: "floor(o_orderkey / 4)",
        V.FORM_TAX_ID: "if(o_orderpriority in ('1-URGENT', '4-NOT SPECIFIED'), null,"
        " o_custkey + 100000000)",
        V.FORM_NPI: "if(o_orderstatus = 'F', o_orderkey, null)",
        V.FORM_CHOICE: f"case o_orderstatus when 'F' then '{V.CHOICE_LABELS['YES_INTEGRATE_EDI']}'"
        f" when 'O' then '{V.CHOICE_LABELS['NO_EVV_SYSTEM']}' end",
        INGEST_SEQ: "o_orderkey",
    }
    return _columns(t.orders, values)


def payers(t: Tables) -> DataFrame:
    key = tax_id("o_custkey")
    values = {
        V.ROSTER_TAX_ID: f"if(o_orderstatus = 'F', {dashed(key)}, {key})",
        "Payer": "o_orderpriority",
        V.ROSTER_WAVE: f"if(o_totalprice > 470000, '{V.WAVE_HELP}', '{V.WAVE_PCS}')",
    }
    return _columns(t.orders, values)


def contact(t: Tables) -> DataFrame:
    values = {
        "account_id": "concat('A', o_custkey)",
        "CONTACT_ROLE_C": "case o_orderpriority when '1-URGENT' then 'Administrator'"
        " when '2-HIGH' then 'Owner' when '3-MEDIUM' then 'Care Coordinator'"
        " when '5-LOW' then 'Nurse' end",
        "email": "if(o_orderstatus <> 'P', concat('o', o_orderkey, '@crm.org'), null)",
    }
    return _columns(t.orders, values)


def account(t: Tables) -> DataFrame:
    return _columns(
        t.customer, {"ID": "concat('A', c_custkey)", "TAX_ID_C": tax_id("c_custkey")}
    )


def enrolments(t: Tables) -> DataFrame:
    labels = V.ENROLMENT_LABELS
    values = {
        "AGENCY_TAX_ID": f"if(o_totalprice > 50000, {tax_id('o_custkey')}, null)",
        "LEARNING_PLAN_NAME": f"case o_orderpriority when '1-URGENT' then '{V.PLAN_HEALTH}'"
        f" when '2-HIGH' then '{V.PLAN_HELP}' else 'Another Plan' end",
        "LEARNING_PLAN_ENROLLMENT_STATUS": f"case o_orderstatus when 'F' then"
        f" '{labels['COMPLETED']}' when 'O' then '{labels['INPROGRESS']}'"
        f" else '{labels['ENROLLED']}' end",
        INGEST_SEQ: "o_orderkey",
    }
    return _columns(t.orders, values)


def engagements(t: Tables) -> DataFrame:
    values = {
        "EVENT_NAME": "case event_type when 'purchase' then 'Detroit MI Roadshow'"
        " when 'view' then 'mi ROADSHOW north' else 'Webinar' end",
        "MARKETING_ENGAGEMENT_TYPE": f"case when value > 100 then '{V.EVENT_REGISTRATION}'"
        f" when value < 5 then '{V.EVENT_ATTENDANCE}' else 'email-open' end",
        "TAX_ID": dashed(tax_id("user_id")),
    }
    return _columns(t.events, values)


def portal_dim(t: Tables) -> DataFrame:
    """Two suppliers in a row are portals of one provider."""
    values = {
        "Federal Tax Number": tax_id("floor(s_suppkey / 2)"),
        "Platform Type": "if(s_acctbal > 5000, 'Paid', 'Free')",
        "Application Provider Id": "s_suppkey",
        "Is Demo": "if(s_nationkey = 3, 'TRUE', 'FALSE')",
        "Environemnt": "if(s_nationkey < 18, 'Cloud', 'Legacy')",
        INGEST_SEQ: "s_suppkey",
    }
    return _columns(t.supplier, values)


@dataclass(frozen=True)
class WebinarPages:
    catalogue: DataFrame
    instances: DataFrame
    participants: DataFrame
    registrants: DataFrame
    upcoming: DataFrame


def in_pages(df: DataFrame, parent: str, records: str, record: str) -> DataFrame:
    """Events put on pages of their parent; ids are unique, so a page has at most PAGE_ROWS."""
    return (
        df.groupBy(parent, F.expr(f"floor(event_id / {PAGE_ROWS})").alias("page"))
        .agg(F.expr(f"collect_list({record})").alias(records))
        .select(parent, records)
    )


def webinar_pages(t: Tables) -> WebinarPages:
    """Webinars are the hours of the day, their instances the days; signups are registrants and
    clicks those of webinars still to come; who has more than 20 was in the meeting."""
    events = t.events.selectExpr(
        "event_id",
        "event_type",
        "value",
        "user_id",
        "cast(hour(ts) as string) as webinar_id",
        "concat(hour(ts), '/', date_format(ts, 'yyyyMMdd')) as uuid",
    )
    texts = ", ".join(f"'{topic}'" for topic in topics())
    hours = events.select(F.col("webinar_id").cast("bigint").alias("id")).distinct()
    catalogue = hours.selectExpr(
        f"array(named_struct('id', id, 'topic', array({texts})[cast(id as int)])) as webinars"
    )
    # Made distinct before they are written as text.
    days = t.events.selectExpr("hour(ts) as hour", "to_date(ts) as day").distinct()
    uuid = "concat(hour, '/', date_format(day, 'yyyyMMdd'))"
    instances = days.selectExpr(
        "cast(hour as string) as webinar_id", f"array(named_struct('uuid', {uuid})) as webinars"
    )
    participant = (
        "named_struct('registrant_id', cast(event_id as string), 'status',"
        f" if(value > 20, '{V.IN_MEETING}', 'in_waiting_room'))"
    )
    question = f"'title', '{V.TAX_ID_QUESTION}', 'value'"
    registrant = (
        "named_struct('id', cast(event_id as string), 'status', 'approved', 'custom_questions',"
        " array(named_struct('title', 'Agency name', 'value', 'x'),"
        f" named_struct({question}, 'unknown'),"
        f" named_struct({question}, {dashed(tax_id('user_id'))})))"
    )
    present = events.where("event_type in ('signup', 'view')")
    signups = events.where("event_type = 'signup'")
    clicks = events.where("event_type = 'click' and value > 40")
    return WebinarPages(
        catalogue,
        instances,
        in_pages(present, "uuid", "participants", participant),
        in_pages(signups, "webinar_id", "registrants", registrant),
        in_pages(clicks, "webinar_id", "registrants", registrant),
    )


def participation(t: Tables) -> DataFrame:
    pages = webinar_pages(t)
    return webinar_participation(
        pages.catalogue, pages.instances, pages.participants, pages.registrants, pages.upcoming
    )


def campaign_inputs(t: Tables) -> CampaignInputs:
    return CampaignInputs(
        roster=roster(t),
        form=form(t),
        payers=payers(t),
        contact=contact(t),
        account=account(t),
        participation=participation(t),
        enrolments=enrolments(t),
        engagements=engagements(t),
        portal_dim=portal_dim(t),
    )
