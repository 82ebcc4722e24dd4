"""Joins, existence flags and look-ups."""

from pyspark.sql import functions as F

from catalog.registry import query
from rosterlane.operators import (
    distinct_concat,
    exists_flag,
    first_per_key,
    keep_matching,
    left_join,
    lookup_override,
    merge_suffixed,
)


@query("""select c_custkey, exists(select 1 from events e where e.user_id=c_custkey
  and e.event_type='signup' and e.value>20) as registered from customer""", name="exists_flag")
def exists_flag_of(t):
    signups = t.events.where((F.col("event_type") == "signup") & (F.col("value") > 20))
    return exists_flag(
        t.customer.select("c_custkey"), signups, "c_custkey", "user_id", flag="registered"
    )


@query("""select s_suppkey, s_name from supplier where s_suppkey in
  (select l_suppkey from lineitem where l_returnflag='R' and l_quantity>49)""")
def semi_join(t):
    returned = t.lineitem.where((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 49))
    suppliers = t.supplier.select("s_suppkey", "s_name")
    return keep_matching(suppliers, returned, "s_suppkey", "l_suppkey")


@query("""select o_orderkey as id_x, o_orderstatus as status_x, l_orderkey as registrant_id,
  l_linenumber as id_y, l_linestatus as status_y from orders left join
  (select * from lineitem where l_returnflag='R') on l_orderkey=o_orderkey""")
def left_join_suffix(t):
    registrants = t.orders.select(
        F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status")
    )
    participants = t.lineitem.where(F.col("l_returnflag") == "R").select(
        F.col("l_orderkey").alias("registrant_id"),
        F.col("l_linenumber").alias("id"),
        F.col("l_linestatus").alias("status"),
    )
    return merge_suffixed(registrants, participants, "id", "registrant_id")


@query("""with f as (select * from orders where o_orderpriority in ('1-URGENT','2-HIGH')
  qualify row_number() over (partition by o_custkey,o_orderpriority order by o_orderkey)=1)
  select c_custkey as tax_id, c_mktsegment as status_roster, a.o_custkey as agency,
    a.o_orderstatus as status_plan, b.o_custkey as agency_help, b.o_orderstatus as status
  from customer left join f a on a.o_custkey=c_custkey and a.o_orderpriority='1-URGENT'
  left join f b on b.o_custkey=c_custkey and b.o_orderpriority='2-HIGH'""")
def left_join_plans(t):
    """Two merges in a row: suffixes for both sides, then an empty one for the left side."""
    enrolments = first_per_key(
        t.orders.select("o_custkey", "o_orderpriority", "o_orderstatus", "o_orderkey"),
        ["o_custkey", "o_orderpriority"],
        ["o_orderkey"],
    )

    def plan(name):
        return enrolments.where(F.col("o_orderpriority") == name).select(
            F.col("o_custkey").alias("agency"), F.col("o_orderstatus").alias("status")
        )

    roster = t.customer.select(
        F.col("c_custkey").alias("tax_id"), F.col("c_mktsegment").alias("status")
    )
    one_to_one = {"unique": True, "even": True}
    first = merge_suffixed(
        roster, plan("1-URGENT"), "tax_id", "agency", ("_roster", "_plan"), **one_to_one
    )
    return merge_suffixed(first, plan("2-HIGH"), "tax_id", "agency", ("", "_help"), **one_to_one)


@query("""select c_custkey, coalesce(o.p, c_mktsegment) as contact from customer left join
  (select o_custkey, min(o_orderpriority) as p from orders where o_orderstatus='O' group by 1) o
  on o_custkey=c_custkey""", name="lookup_override")
def lookup_override_of(t):
    mapping = (
        t.orders.where(F.col("o_orderstatus") == "O")
        .groupBy("o_custkey")
        .agg(F.min("o_orderpriority").alias("p"))
    )
    roster = t.customer.select("c_custkey", F.col("c_mktsegment").alias("contact"))
    return lookup_override(roster, mapping, "c_custkey", "contact", "p", mapping_on="o_custkey")


@query("""select c_custkey, case when trim(seg)='' or seg is null then coalesce(o.p, seg) else seg
  end as contact from (select c_custkey, case when c_mktsegment='BUILDING' then ' '
    when c_mktsegment='MACHINERY' then null else c_mktsegment end as seg from customer)
  left join (select o_custkey, min(o_orderpriority) as p from orders where o_orderstatus='O'
    group by 1) o on o_custkey=c_custkey""")
def lookup_blank_only(t):
    mapping = (
        t.orders.where(F.col("o_orderstatus") == "O")
        .groupBy("o_custkey")
        .agg(F.min("o_orderpriority").alias("p"))
    )
    segment = F.col("c_mktsegment")
    contact = F.when(segment == "BUILDING", " ").when(segment != "MACHINERY", segment)
    roster = t.customer.select("c_custkey", contact.alias("contact"))
    return lookup_override(
        roster, mapping, "c_custkey", "contact", "p", mapping_on="o_custkey", only_blank=True
    )


@query("""select c_custkey, c_mktsegment, x.names from customer left join
  (select o_custkey as k, case when o_orderstatus='F' then 'BUILDING' else 'MACHINERY' end as w,
    string_agg(distinct o_orderpriority, ', ' order by o_orderpriority) as names
   from orders group by 1, 2) x on x.k=c_custkey and x.w=c_mktsegment""")
def composite_left_join(t):
    wave = F.when(F.col("o_orderstatus") == "F", "BUILDING").otherwise("MACHINERY")
    orders = t.orders.select(F.col("o_custkey").alias("k"), wave.alias("w"), "o_orderpriority")
    side = distinct_concat(orders, ["k", "w"], {"o_orderpriority": "names"})
    roster = t.customer.select("c_custkey", "c_mktsegment")
    joined = left_join(roster, side, ["c_custkey", "c_mktsegment"], ["k", "w"], unique=True)
    return joined.drop("k", "w")


@query("""select c_custkey, o_orderkey, o_orderstatus from customer left join
  (select o_custkey, o_orderkey, o_orderstatus from orders where o_orderpriority='1-URGENT') o
  on o_custkey=c_custkey""")
def left_join_fanout(t):
    urgent = t.orders.where(F.col("o_orderpriority") == "1-URGENT").select(
        "o_custkey", "o_orderkey", "o_orderstatus"
    )
    return left_join(t.customer.select("c_custkey"), urgent, "c_custkey", "o_custkey").drop(
        "o_custkey"
    )


@query("""select c.c_custkey as account_id, o.o_orderpriority as role, o.o_orderkey as contact_id
  from orders o left join customer c on c.c_custkey=o.o_custkey
  where c.c_mktsegment in ('BUILDING','MACHINERY') and o.o_orderpriority is not null""")
def contacts_of_accounts(t):
    """A left join whose filter on the right makes it an inner one, which the optimizer sees."""
    contacts = t.orders.select(
        "o_custkey", F.col("o_orderpriority").alias("role"), F.col("o_orderkey").alias("contact_id")
    )
    accounts = t.customer.select(F.col("c_custkey").alias("account_id"), "c_mktsegment")
    joined = left_join(contacts, accounts, "o_custkey", "account_id", unique=True)
    wanted = F.col("c_mktsegment").isin("BUILDING", "MACHINERY") & F.col("role").isNotNull()
    return joined.where(wanted).select("account_id", "role", "contact_id")
