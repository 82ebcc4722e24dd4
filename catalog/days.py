"""Several days of products: merged counts, differences; sides laid out once; contacts filtered early."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from catalog import inputs
from catalog.products import BASE_SQL, EVENT_DATE, metric_sql
from catalog.registry import ORACLE, query
from catalog.sources import fresh_folder
from rosterlane import fixed_values as V
from rosterlane.operators import bitmap_counts, metric_bitmaps, number_keys, table_changes
from rosterlane.plans import (
    build_base,
    build_detail,
    form_choice,
    lay_out_sides,
    publish_trend,
    trend_over_days,
)
from rosterlane.plans.report import ID
from rosterlane.sinks import publish_day, read_published
from rosterlane.sources import crm_contacts


@query(f"""{BASE_SQL},
rows as (select base.*, coalesce(forms.choice,'{V.MISSING_FORM}') as choice
  from base left join forms on forms.tax_id=id where id::bigint % 5 in (0, 1, 3))
select {metric_sql()} from rows""", name="trend_over_days")
def trend_of_two_days(t):
    """Three days with some providers in common; the counts of two of them, merged. One is published
    twice, with other providers the first time."""
    store = fresh_folder(t.spark, "store")
    campaign = inputs.campaign_inputs(t)
    base, forms = build_base(campaign).checkpoint(), form_choice(campaign.form).checkpoint()
    part = F.pmod(F.col(ID).cast("bigint"), F.lit(5))
    for day, parts in (("d1", [2]), ("d1", [0, 3]), ("d2", [1, 3]), ("d3", [2, 3, 4])):
        publish_trend(t.spark, store, day, base.where(part.isin(parts)), forms)
    return trend_over_days(t.spark, store, ["d1", "d2"])


@query("""select count(distinct l_suppkey) as suppliers, count(distinct case when l_returnflag='R'
  then l_suppkey end) as returned, count(distinct case when l_quantity>500 then l_suppkey end) as never
  from lineitem where l_linenumber in (1, 2)""")
def merged_distinct(t):
    """Bitmaps of the first and the second line items, merged."""
    numbers = number_keys(t.lineitem, "l_suppkey").checkpoint()
    metrics = {"suppliers": None, "returned": "l_returnflag = 'R'", "never": "l_quantity > 500"}
    days = [
        metric_bitmaps(t.lineitem.where(F.col("l_linenumber") == n), "l_suppkey", numbers, metrics) for n in (1, 2)
    ]
    return bitmap_counts(days[0].unionByName(days[1]), metrics)


@query("""select c_custkey, c_mktsegment, case when c_custkey % 10 = 0 then 'removed'
    when c_custkey % 7 = 0 or c_custkey % 11 = 0 then 'changed' end as change,
    case when c_custkey % 10 <> 0 then concat_ws(',', case when c_custkey % 11 = 0 then 'c_name' end,
      case when c_custkey % 7 = 0 then 'c_acctbal' end, case when c_custkey % 11 = 0 then 'extra' end) end as columns
  from customer where c_custkey % 10 = 0 or c_custkey % 7 = 0 or c_custkey % 11 = 0
  union all select c_custkey + 1000000, c_mktsegment, 'added', null from customer where c_custkey % 13 = 0""")
def snapshot_changes(t):
    """Two published days of a table by a key of two columns: what came, went and changed, and where."""
    store = fresh_folder(t.spark, "store")
    before = t.customer.select("c_custkey", "c_mktsegment", "c_name", "c_acctbal")
    eleventh = F.col("c_custkey") % 11 == 0
    after = before.where("c_custkey % 10 <> 0").select(
        "c_custkey", "c_mktsegment",
        F.when(~eleventh, F.col("c_name")).alias("c_name"),
        F.when(F.col("c_custkey") % 7 == 0, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal")).alias("c_acctbal"),
        F.when(eleventh, F.create_map(F.lit("new"), "c_custkey")).alias("extra"),
    )
    new = before.where("c_custkey % 13 = 0").withColumn("c_custkey", F.col("c_custkey") + 1000000)
    publish_day(t.spark, store, "d1", {"rows": before})
    publish_day(t.spark, store, "d2", {"rows": after.unionByName(new, allowMissingColumns=True)})
    one, other = (read_published(t.spark, store, "rows", [day]) for day in ("d1", "d2"))
    found = table_changes(one, other, ["c_custkey", "c_mktsegment"])
    return found.withColumn("columns", F.array_join("columns", ","))


@query(ORACLE["campaign_detail"])
def detail_from_buckets(t):
    """The detail from sides that were laid out by id before."""
    buckets = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    folder = fresh_folder(t.spark, "sides")
    campaign = lay_out_sides(inputs.campaign_inputs(t), f"sides_{uuid.uuid4().hex}", buckets, folder)
    return build_detail(build_base(campaign), form_choice(campaign.form), EVENT_DATE)


@query("""select (100000000+o_custkey)::varchar as tax_id, case o_orderpriority
    when '1-URGENT' then 'Administrator' when '2-HIGH' then 'Owner'
    when '3-MEDIUM' then 'Care Coordinator' when '5-LOW' then 'Nurse' end as role,
    'o' || o_orderkey || '@crm.org' as email
  from orders join customer on c_custkey=o_custkey where c_acctbal>9000 and o_orderstatus<>'P'""")
def contacts_prefiltered(t):
    """Contacts of few accounts, of which most others are left out before they are joined."""
    ids = t.customer.where("c_acctbal > 9000").selectExpr(f"{inputs.tax_id('c_custkey')} as id")
    found = crm_contacts(inputs.contact(t), inputs.account(t), ids, "id", prefilter=True)
    return found.toDF("tax_id", "role", "email")
