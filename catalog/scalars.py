"""Column functions and predicates."""

from pyspark.sql import functions as F

from catalog.registry import query
from rosterlane.functions import (
    any_of,
    contains_ci,
    export_stamp,
    id_as_int_text,
    is_blank,
    normalize_id,
    parse_report_date,
    python_text,
    report_date,
    role_rank,
    to_number,
    trim_ws,
)
from rosterlane.sources import inperson_engagements, learning_enrolments

PRIORITY_RANK = """case when contains(o_orderpriority,'MEDIUM') then 3
  when o_orderpriority='1-URGENT' then 0 when o_orderpriority='2-HIGH' then 1
  when o_orderpriority='5-LOW' then 2 else 9 end"""


def priority_rank():
    return role_rank(F.col("o_orderpriority"), ["1-URGENT", "2-HIGH", "5-LOW"], "MEDIUM", 9)


def padded(column: str):
    return F.lpad(F.col(column).cast("string"), 9, "0")


@query(r"""select c_custkey, regexp_replace(' '||left(lpad(c_custkey::varchar,9,'0'),2)||'-'
  ||right(lpad(c_custkey::varchar,9,'0'),7), '[-\s]', '', 'g') as tax_id from customer""")
def id_normalize(t):
    key = padded("c_custkey")
    dashed = F.concat(F.lit(" "), F.left(key, F.lit(2)), F.lit("-"), F.right(key, F.lit(7)))
    return t.customer.select("c_custkey", normalize_id(dashed).alias("tax_id"))


@query("""select l_orderkey, l_linenumber, cast(trunc(l_extendedprice)::bigint as varchar) as tax_id
  from lineitem""")
def id_normalize_number(t):
    df = t.lineitem
    kind = df.schema["l_extendedprice"].dataType
    price = normalize_id(F.col("l_extendedprice"), kind)
    return df.select("l_orderkey", "l_linenumber", price.alias("tax_id"))


@query(
    """select c_custkey, cast(cast(lpad(c_custkey::varchar,9,'0') as bigint) as varchar) as tax_id
  from customer""",
    name="id_as_int_text",
)
def id_as_int(t):
    return t.customer.select("c_custkey", id_as_int_text(padded("c_custkey")).alias("tax_id"))


@query("""select p_partkey, trim(p_name) as name, trim(p_name)='' as blank from
  (select p_partkey, '  '||case when p_size>40 then '' else p_name end||'   ' as p_name
   from part)""")
def trim_text(t):
    name = F.when(F.col("p_size") > 40, "").otherwise(F.col("p_name"))
    padded_name = F.concat(F.lit(" \t"), name, F.lit("  \n"))
    return t.part.select(
        "p_partkey", trim_ws(padded_name).alias("name"), is_blank(padded_name).alias("blank")
    )


@query("""select o_orderkey from (select o_orderkey, case when o_orderpriority='5-LOW' then '  '
  when o_orderpriority='1-URGENT' then null else o_orderpriority end as p from orders)
  where p is null or trim(p)=''""")
def blank_filter(t):
    priority = (
        F.when(F.col("o_orderpriority") == "5-LOW", "  ")
        .when(F.col("o_orderpriority") == "1-URGENT", F.lit(None))
        .otherwise(F.col("o_orderpriority"))
    )
    return t.orders.where(is_blank(priority)).select("o_orderkey")


@query("select p_partkey, p_name from part where lower(p_name) like '%red w%'")
def like_ci_filter(t):
    return t.part.where(contains_ci(F.col("p_name"), "RED W")).select("p_partkey", "p_name")


@query("""select o_orderkey, o_orderpriority from orders
  where o_orderpriority='1-URGENT' or o_orderpriority='2-HIGH'""")
def in_filter(t):
    wanted = any_of(F.col("o_orderpriority"), ["1-URGENT", "2-HIGH"])
    return t.orders.where(wanted).select("o_orderkey", "o_orderpriority")


@query("""select agency_tax_id, plan, status from (select case when o_totalprice>50000
  then o_custkey::varchar end as agency_tax_id, o_orderpriority as plan, o_orderstatus as status
  from orders where o_orderpriority='1-URGENT' or o_orderpriority='2-HIGH')
  where agency_tax_id is not null""")
def enrolment_scan(t):
    key = F.when(F.col("o_totalprice") > 50000, F.col("o_custkey").cast("string"))
    enrolments = t.orders.select(
        key.alias("AGENCY_TAX_ID"),
        F.col("o_orderpriority").alias("LEARNING_PLAN_NAME"),
        F.col("o_orderstatus").alias("LEARNING_PLAN_ENROLLMENT_STATUS"),
    )
    return learning_enrolments(enrolments, ("1-URGENT", "2-HIGH")).toDF(
        "agency_tax_id", "plan", "status"
    )


@query("""select event_id, user_id::varchar as tax_id, event_type as kind from events
  where lower(event_type) like '%r%'""")
def engagement_scan(t):
    engagements = t.events.select(
        "event_id",
        F.concat(F.lit("-"), F.col("user_id").cast("string"), F.lit(" ")).alias("TAX_ID"),
        F.upper("event_type").alias("EVENT_NAME"),
        F.col("event_type").alias("kind"),
    )
    return inperson_engagements(engagements, "R").select(
        "event_id", F.col("TAX_ID").alias("tax_id"), "kind"
    )


@query("select event_id, cast(json_extract_string(props,'$.k') as bigint) as k from events")
def json_field(t):
    return t.events.select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"))


@query(f"select o_orderkey, {PRIORITY_RANK} as role_rank from orders", name="role_rank")
def role_rank_of(t):
    return t.orders.select("o_orderkey", priority_rank().alias("role_rank"))


@query("""select p_partkey, try_cast(replace(p_brand,'Brand#','') as bigint) as n,
  try_cast(p_name as bigint) as bad from part""")
def coerce_number(t):
    digits = F.replace(F.col("p_brand"), F.lit("Brand#"), F.lit(""))
    return t.part.select(
        "p_partkey", to_number(digits).alias("n"), to_number(F.col("p_name")).alias("bad")
    )


@query("""select o_orderkey,
  strftime((o_orderdate at time zone 'UTC') at time zone 'US/Eastern','%m/%d/%Y') as event_date,
  strftime((o_orderdate at time zone 'UTC') at time zone 'US/Eastern','%Y-%m-%d') as stamp
  from orders""", name="report_date")
def report_date_text(t):
    moment = F.col("o_orderdate")
    return t.orders.select(
        "o_orderkey",
        report_date(moment, utc_wall=True).alias("event_date"),
        export_stamp(moment, utc_wall=True).alias("stamp"),
    )


@query("""select o_orderkey, cast(strptime(strftime(o_orderdate,'%m/%d/%Y'),'%m/%d/%Y') as date)
  as event_date from orders""")
def parse_date(t):
    text = F.date_format("o_orderdate", "MM/dd/yyyy")
    return t.orders.select("o_orderkey", parse_report_date(text).alias("event_date"))


@query("""select l_orderkey, l_linenumber, case when l_quantity>10 then l_quantity::varchar
  else 'nan' end as quantity, case when l_tax>0.03 then 'True' else 'False' end as taxed
  from lineitem""")
def number_text(t):
    df = t.lineitem
    quantity = F.when(F.col("l_quantity") > 10, F.col("l_quantity"))
    taxed = F.col("l_tax") > 0.03
    return df.select(
        "l_orderkey",
        "l_linenumber",
        python_text(quantity, df.schema["l_quantity"].dataType).alias("quantity"),
        python_text(taxed, df.select(taxed).schema[0].dataType).alias("taxed"),
    )
