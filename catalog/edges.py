"""Inputs as they really come: names that differ in case, repeated keys, quotes in sheets, runs
without rows, tables without a row number; and the run as a whole."""

from datetime import datetime, timezone

from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog import inputs
from catalog.products import ALL_FLAGS, FLAGS_SQL, supplier_portals
from catalog.registry import ORACLE, query
from catalog.sources import fresh_folder
from rosterlane import schemas
from rosterlane.functions.ids import normalize_id
from rosterlane.operators import distinct_concat, ensure_columns, lookup_override
from rosterlane.plans import (
    attach_flags,
    inperson_participation,
    participation_flags,
    portal_state,
    run_report,
    status_by_plan,
    webinar_participation,
)
from rosterlane.sinks import export_report, publish_day, read_published, write_snapshot
from rosterlane.sources import inperson_engagements, read_pages, read_table


@query("""select o_orderkey, o_orderstatus as "STATUS_Y", null::integer as extra from orders""")
def ensure_columns_case(t):
    """A column that is there under another case stays as it is."""
    orders = t.orders.select("o_orderkey", F.col("o_orderstatus").alias("STATUS_Y"))
    return ensure_columns(orders, {"status_y": T.StringType(), "extra": T.IntegerType()})


@query("""select c_custkey, coalesce(p, c_mktsegment) as contact from customer left join
  (select o_custkey, min(o_orderpriority) as p from orders group by 1) on o_custkey=c_custkey""")
def lookup_duplicates(t):
    """Every customer has several orders; of their values the smallest counts."""
    roster = t.customer.select("c_custkey", F.col("c_mktsegment").alias("contact"))
    return lookup_override(
        roster, t.orders, "c_custkey", "contact", "o_orderpriority", mapping_on="o_custkey"
    )


@query("""select o_orderkey, trunc(o_orderkey + 0.9999999999::decimal(30,10))::bigint::varchar as id,
  trunc(-o_orderkey - 0.9999999999::decimal(30,10))::bigint::varchar as negative from orders""")
def id_normalize_decimal(t):
    """Decimals are cut, not rounded."""
    kind = T.DecimalType(30, 10)
    part = "cast(0.9999999999 as decimal(30,10))"
    ids = t.orders.selectExpr(
        "o_orderkey",
        f"cast(o_orderkey + {part} as decimal(30,10)) as a",
        f"cast(-o_orderkey - {part} as decimal(30,10)) as b",
    )
    return ids.select(
        "o_orderkey",
        normalize_id(F.col("a"), kind).alias("id"),
        normalize_id(F.col("b"), kind).alias("negative"),
    )


@query("""select o_custkey, string_agg(distinct p, ', ' order by p) as payers from
  (select o_custkey, case when o_orderstatus='F' and o_custkey % 2 = 0 then o_orderpriority end as p
   from orders) group by 1""")
def distinct_concat_nulls(t):
    """A key without any value has no text."""
    value = "if(o_orderstatus = 'F' and o_custkey % 2 = 0, o_orderpriority, null) as p"
    return distinct_concat(t.orders.selectExpr("o_custkey", value), "o_custkey", {"p": "payers"})


@query("""select o_orderkey, date_trunc('month', o_orderdate)::date as event_date from orders
  where date_trunc('month', o_orderdate)::date <>
    (select min(date_trunc('month', o_orderdate)::date) from orders)""")
def snapshot_empty_rerun(t):
    """The first month is written again, by a run that has no rows."""
    path = fresh_folder(t.spark, "snapshot")
    month = F.trunc(F.col("o_orderdate").cast("date"), "month")
    orders = t.orders.select("o_orderkey", month.alias("event_date"))
    first = str(orders.agg(F.min("event_date")).first()[0])
    write_snapshot(orders, path, "event_date")
    write_snapshot(orders.where("false"), path, "event_date", dates=[first])
    return t.spark.read.schema(orders.schema).parquet(path)


@query("""with f as (select * from orders where o_orderpriority in ('1-URGENT','2-HIGH')
  qualify row_number() over (partition by o_custkey,o_orderpriority order by o_orderstatus)=1)
  select c_custkey, coalesce(max(case when o_orderpriority='1-URGENT' then o_orderstatus end),
    'Not Registered') as status, coalesce(max(case when o_orderpriority='2-HIGH'
    then o_orderstatus end),'Not Registered') as status_hh
  from customer left join f on o_custkey=c_custkey group by 1""")
def status_by_plan_no_seq(t):
    """Without a row number the order is that of all columns."""
    enrolments = t.orders.select(
        F.col("o_custkey").alias("AGENCY_TAX_ID"),
        F.col("o_orderpriority").alias("LEARNING_PLAN_NAME"),
        F.col("o_orderstatus").alias("LEARNING_PLAN_ENROLLMENT_STATUS"),
    )
    plans = {"1-URGENT": "status", "2-HIGH": "status_hh"}
    return status_by_plan(t.customer.select("c_custkey"), enrolments, "c_custkey", plans)


@query("""select c_custkey, case when p is null then 'False' else 'True' end as portal_created,
  p as portal_type from customer left join (select s_suppkey//2 as k, min(s_name) as p
    from supplier group by 1) on k=c_custkey""")
def portal_state_no_seq(t):
    portals = supplier_portals(t).selectExpr(
        "cast(floor(TAX_ID / 2) as bigint) as TAX_ID", "PLATFORM_TAG", "PROVIDER_ID"
    )
    state = portal_state(t.customer.select("c_custkey"), portals, "c_custkey")
    return state.select(
        "c_custkey",
        F.col("PORTAL_CREATED").alias("portal_created"),
        F.col("PORTAL_TYPE").alias("portal_type"),
    )


# Names with quotes, a comma after a quote, and line breaks.
NAME_SQL = """c_name || ' "Best", Inc' || case when c_custkey % 2 = 0 then chr(10) || 'x,"' else '' end"""
NAME = "concat(c_name, ' \"Best\", Inc', if(c_custkey % 2 = 0, '\\nx,\"', ''))"


@query(f"""select (100000000+c_custkey)::varchar as tax_id, {NAME_SQL} as payer,
  case when c_acctbal>0 then c_mktsegment end as wave from customer""")
def payer_scan(t):
    """The payer sheet as a spreadsheet saves it."""
    path = fresh_folder(t.spark, "payers")
    columns = schemas.PAYERS.names
    sheet = t.customer.selectExpr(
        "cast(c_custkey + 100000000 as string)", NAME, "if(c_acctbal > 0, c_mktsegment, null)"
    ).toDF(*columns)
    sheet.write.options(header=True, escape='"').csv(path)
    read = read_table(t.spark, path, schemas.PAYERS, "csv", line_breaks=True)
    return read.toDF("tax_id", "payer", "wave")


@query(f"""select lpad(c_custkey::varchar,9,'0') as id, {NAME_SQL} as name, c_mktsegment as city,
  case when c_acctbal>0 then c_phone end as phone, c_custkey as seq from customer"""
       .replace("c_phone", "'555 '||c_custkey"))
def roster_scan_quoted(t):
    """All columns of the roster sheet, with quotes and line breaks in the name."""
    path = fresh_folder(t.spark, "roster")
    names = schemas.ROSTER.names
    values = dict.fromkeys(names, F.lit(None).cast("string")) | {
        names[0]: F.lpad(F.col("c_custkey").cast("string"), 9, "0"),
        names[1]: F.expr(NAME),
        names[2]: F.col("c_mktsegment"),
        names[3]: F.when(F.col("c_acctbal") > 0, F.concat(F.lit("555 "), "c_custkey")),
        schemas.INGEST_SEQ: F.col("c_custkey"),
    }
    sheet = t.customer.select(*(c.alias(n) for n, c in values.items()))
    sheet.write.options(header=True, escape='"', ignoreTrailingWhiteSpace=False).csv(path)
    read = read_table(t.spark, path, schemas.ROSTER, "csv", line_breaks=True)
    empty = " and ".join(f"`{n}` is null" for n in names[4:-1])
    return read.where(empty).select(*names[:4], names[-1]).toDF("id", "name", "city", "phone", "seq")


@query(f"select c_custkey::varchar as c_custkey, {NAME_SQL} as c_name from customer")
def export_readback(t):
    """The library reads its own report."""
    customers = t.customer.selectExpr("cast(c_custkey as string) as c_custkey", f"{NAME} as c_name")
    path = export_report(customers, fresh_folder(t.spark, "export"), "Report", "2025-01-01")
    return read_table(t.spark, path, customers.schema, "csv", line_breaks=True)


@query(f"with {FLAGS_SQL} select c_custkey, {ALL_FLAGS} from customer left join flags f "
       "on f.tax_id=(100000000+c_custkey)::varchar")
def landed_webinars(t):
    """All kinds of pages land as JSON and are read back, then all flags."""
    made = inputs.webinar_pages(t)
    folder = fresh_folder(t.spark, "webinars")
    kinds = {
        "catalogue": (made.catalogue, "webinars", schemas.WEBINAR, []),
        "instances": (made.instances, "webinars", schemas.INSTANCE, ["webinar_id"]),
        "participants": (made.participants, "participants", schemas.PARTICIPANT, ["uuid"]),
        "registrants": (made.registrants, "registrants", schemas.REGISTRANT, ["webinar_id"]),
        "upcoming": (made.upcoming, "registrants", schemas.REGISTRANT, ["webinar_id"]),
    }
    pages = []
    for name, (frame, records, schema, parents) in kinds.items():
        frame.write.json(f"{folder}/{name}")
        pages.append(read_pages(t.spark, f"{folder}/{name}", records, schema, parents))
    inperson = inperson_participation(inperson_engagements(inputs.engagements(t)))
    flags = participation_flags(webinar_participation(*pages).unionByName(inperson))
    roster = t.customer.selectExpr("c_custkey", f"{inputs.tax_id('c_custkey')} as id")
    return attach_flags(roster, flags, "id", "TAX_ID").drop("id")


# The day of the products' SQL.
MOMENT = datetime(2025, 1, 2, 17, tzinfo=timezone.utc)


def run_twice(t):
    folder = fresh_folder(t.spark, "run")
    campaign = inputs.campaign_inputs(t)
    for _ in range(2):
        run_report(campaign, MOMENT, f"{folder}/store", f"{folder}/export", "Report")
    return [read_published(t.spark, f"{folder}/store", name) for name in ("detail", "trend")]


@query(ORACLE["campaign_detail"])
def run_report_detail(t):
    """Two runs of a day leave its detail rows once, with all 47 columns."""
    return run_twice(t)[0].select(*schemas.DETAIL)


@query(ORACLE["campaign_trend"])
def run_report_trend(t):
    """And one trend row, with the date and 45 counts."""
    return run_twice(t)[1]


@query("""select o_orderkey, o_totalprice, n_orders from orders,
  (select count(*) as n_orders from orders)""")
def publish_after_failure(t):
    """A run that dies between its two writes, and one whose counts disagree, change nothing."""
    store = fresh_folder(t.spark, "store")
    orders = t.orders.select("o_orderkey", "o_totalprice")
    count = F.count("*").alias("n_orders")

    def products(rows, trend):
        return {"detail": rows, "trend": trend}

    def agree(written):
        if written["detail"].count() != written["trend"].first()["n_orders"]:
            raise ValueError("counts differ")

    half = orders.where("o_orderkey % 2 = 0")
    lost = half.agg(F.expr("cast(raise_error('executor lost') as bigint)").alias("n_orders"))
    publish_day(t.spark, store, "2025-01-02", products(orders, orders.agg(count)), agree)
    for bad in (products(half, lost), products(half, orders.agg(count))):
        try:
            publish_day(t.spark, store, "2025-01-02", bad, agree)
        except Exception as error:
            if "executor lost" not in str(error) and "counts differ" not in str(error):
                raise
        else:
            raise AssertionError("published")
    rows, trend = (read_published(t.spark, store, name) for name in ("detail", "trend"))
    return rows.crossJoin(F.broadcast(trend))
