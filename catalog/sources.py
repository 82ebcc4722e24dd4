"""Sources and sinks. What they write goes to fresh folders under the session's shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog import inputs
from catalog.registry import query
from rosterlane import schemas
from rosterlane.plans.participation import webinar_sessions
from rosterlane.sinks import export_report, shared_folder, write_snapshot
from rosterlane.sources import explode_records, parse_pages, portals, read_pages, read_table

EVENT = T.StructType().add("event_id", "long").add("event_type", "string")


def fresh_folder(spark, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def event_pages(t):
    record = "struct(event_id, event_type)"
    return inputs.in_pages(t.events, "user_id", "records", record)


@query("select user_id, event_id, event_type from events")
def pages_explode(t):
    """Pages per user land as JSON files, are read in one scan and exploded."""
    path = fresh_folder(t.spark, "pages")
    event_pages(t).write.json(path)
    pages = read_pages(t.spark, path, "records", EVENT, ["user_id"])
    records = explode_records(pages, "records", ["user_id"])
    return records.withColumn("user_id", F.col("user_id").cast("bigint"))


@query("select user_id, event_id, event_type from events")
def pages_parse(t):
    """The same pages as a text column; a page without records goes away in the explode."""
    page = F.struct("user_id", "records", F.lit("").alias("next_page_token"))
    text = event_pages(t).select(F.to_json(page).alias("page"))
    records = explode_records(
        parse_pages(text, "page", "records", EVENT, ["user_id"]), "records", ["user_id"]
    )
    return records.withColumn("user_id", F.col("user_id").cast("bigint"))


@query("""select lpad(c_custkey::varchar,9,'0') as tax_id, c_name as name,
  case when c_acctbal<0 then null else c_mktsegment end as wave from customer""")
def roster_scan(t):
    """A sheet with zero padded ids lands as CSV and is read with the ids as text."""
    path = fresh_folder(t.spark, "roster")
    segment = F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment"))
    columns = dict.fromkeys(schemas.ROSTER.names, F.lit(None).cast("string")) | {
        "Provider TAX ID": F.lpad(F.col("c_custkey").cast("string"), 9, "0"),
        "Provider Name": F.col("c_name"),
        "Wave": segment,
        "ingest_seq": F.col("c_custkey"),
    }
    t.customer.select(*(c.alias(n) for n, c in columns.items())).write.option("header", True).csv(
        path
    )
    roster = read_table(t.spark, path, schemas.ROSTER, "csv")
    return roster.select(
        F.col("Provider TAX ID").alias("tax_id"),
        F.col("Provider Name").alias("name"),
        F.col("Wave").alias("wave"),
    )


SHEET_SQL = """select lpad(c_custkey::varchar,9,'0') as tax_id, c_name as name,
  case when c_acctbal<0 then null else c_mktsegment end as wave, c_custkey as seq"""


def sheet(t, rows="true", **more):
    """The roster sheet with its columns backwards and ``more`` among them."""
    segment = F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment"))
    columns = {
        "ingest_seq": F.col("c_custkey"),
        "Wave": segment,
        "Provider Name": F.col("c_name"),
        **more,
        "Provider TAX ID": F.lpad(F.col("c_custkey").cast("string"), 9, "0"),
    }
    return t.customer.where(rows).select(*(c.alias(n) for n, c in columns.items()))


def read_back(t, path):
    roster = read_table(t.spark, path, schemas.ROSTER, "csv", required=["Provider TAX ID"])
    read = roster.select("Provider TAX ID", "Provider Name", "Wave", "ingest_seq", "Provider City")
    return read.toDF("tax_id", "name", "wave", "seq", "city")


@query(f"{SHEET_SQL}, null::varchar as city from customer")
def sheet_reordered(t):
    """A sheet with its columns in another order and without most of them."""
    path = fresh_folder(t.spark, "sheet")
    sheet(t).write.option("header", True).csv(path)
    return read_back(t, path)


@query(f"{SHEET_SQL}, 'city ' || c_nationkey as city from customer")
def sheet_extra_columns(t):
    """Columns that the schema does not name, one of them without a name."""
    path = fresh_folder(t.spark, "sheet")
    city = F.concat(F.lit("city "), "c_nationkey")
    more = {"Comment": F.col("c_acctbal"), "": F.col("c_name"), "Provider City": city}
    sheet(t, **more).write.option("header", True).csv(path)
    return read_back(t, path)


@query(f"{SHEET_SQL}, case when c_custkey % 3 = 1 then c_name end as city from customer")
def sheet_mixed_headers(t):
    """Files of three layouts in one folder, a number in one where another has text."""
    path = fresh_folder(t.spark, "sheet")
    sheet(t, "c_custkey % 3 = 0").write.option("header", True).csv(path)
    more = {"Provider City": F.col("c_name"), "x": F.lit(1)}
    sheet(t, "c_custkey % 3 = 1", **more).write.mode("append").option("header", True).csv(path)
    last = sheet(t, "c_custkey % 3 = 2")
    last = last.select(*reversed(last.columns))
    last.write.mode("append").option("header", True).csv(path)
    return read_back(t, path)


@query("""select floor(o_orderkey/4)::bigint as submitter, case when o_orderpriority not in
  ('1-URGENT','4-NOT SPECIFIED') then o_custkey+100000000 end as tax_id, o_orderkey as seq
  from orders""")
def form_scan(t):
    """The form sheet lands as Parquet; its ids are numbers."""
    path = fresh_folder(t.spark, "form")
    inputs.form(t).write.parquet(path)
    form = read_table(t.spark, path, schemas.FORM)
    return form.select(schemas.FORM.names[0], schemas.FORM.names[1], "ingest_seq").toDF(
        "submitter", "tax_id", "seq"
    )


@query("""select (100000000+s_suppkey//2)::varchar as tax_id, case when s_acctbal>5000 then 'Paid'
  else 'Free' end as platform_tag, s_suppkey as provider_id from supplier
  where s_nationkey<>3 and s_nationkey<18""")
def portal_scan(t):
    return portals(inputs.portal_dim(t)).select(
        F.col("TAX_ID").alias("tax_id"),
        F.col("PLATFORM_TAG").alias("platform_tag"),
        F.col("PROVIDER_ID").alias("provider_id"),
    )


def session_hours() -> str:
    """SQL values (hour, suffix) of the hours whose topic is a session's."""
    rows = []
    for hour in range(24):
        place = hour % 12
        # From 18 on the topic has a space at the end; only the last session trims it.
        if place != inputs.NO_WEBINAR and (hour < 18 or place == 11):
            rows.append(f"({hour},'{schemas.FLAG_SUFFIXES[place]}')")
    return "(values " + ",".join(rows) + ") as hours(hour, session)"


@query(f"""select event_id, session from events join {session_hours()}
  on hour=extract(hour from ts)""")
def topic_sessions(t):
    """Exact and trimmed topics of the catalogue, joined to the events of the webinar."""
    catalogue = explode_records(inputs.webinar_pages(t).catalogue, "webinars")
    events = t.events.select("event_id", F.hour("ts").cast("string").alias("webinar_id"))
    sessions = webinar_sessions(catalogue)
    return events.join(sessions, "webinar_id").select("event_id", F.col("SESSION").alias("session"))


@query("""select o_orderkey, o_totalprice, date_trunc('month', o_orderdate)::date as event_date
  from orders""")
def snapshot_rerun(t):
    """Every month is written, and written again: the second run replaces the first."""
    path = fresh_folder(t.spark, "snapshot")
    month = F.trunc(F.col("o_orderdate").cast("date"), "month")
    orders = t.orders.select("o_orderkey", "o_totalprice", month.alias("event_date"))
    write_snapshot(orders, path, "event_date")
    write_snapshot(orders, path, "event_date")
    return t.spark.read.schema(orders.schema).parquet(path)


@query("select c_custkey::varchar as c_custkey, c_name, c_mktsegment from customer", name="export_report")
def export_report_csv(t):
    customers = t.customer.select("c_custkey", "c_name", "c_mktsegment")
    path = export_report(customers, fresh_folder(t.spark, "export"), "Report", "2025-01-01")
    return t.spark.read.option("header", True).csv(path)
