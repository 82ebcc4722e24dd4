"""Fill within groups, ranked pick, ordered de-duplication."""

from pyspark.sql import functions as F

from catalog.registry import query
from catalog.scalars import PRIORITY_RANK, priority_rank
from rosterlane.operators import fill_within_group, first_per_key, ranked_first
from rosterlane.operators.ordered import BACKWARD, FORWARD

GAPS = """with e as (select user_id, event_id, ts, case when event_type='signup' and value>60
  then event_id end as v from events)"""


def gaps(t):
    value = F.when((F.col("event_type") == "signup") & (F.col("value") > 60), F.col("event_id"))
    return t.events.select("user_id", "event_id", "ts", value.alias("v"))


@query(f"""{GAPS} select event_id, user_id, coalesce(
  last_value(v ignore nulls) over (partition by user_id order by ts,event_id
    rows between unbounded preceding and current row),
  first_value(v ignore nulls) over (partition by user_id order by ts,event_id
    rows between current row and unbounded following)) as v from e""")
def group_fill(t):
    filled = fill_within_group(gaps(t), "user_id", {"v": FORWARD}, ["ts", "event_id"])
    return filled.select("event_id", "user_id", "v")


@query(f"""{GAPS} select event_id, user_id, coalesce(
  first_value(v ignore nulls) over (partition by user_id order by ts,event_id
    rows between current row and unbounded following),
  last_value(v ignore nulls) over (partition by user_id order by ts,event_id
    rows between unbounded preceding and current row)) as v from e""")
def group_fill_back(t):
    filled = fill_within_group(gaps(t), "user_id", {"v": BACKWARD}, ["ts", "event_id"])
    return filled.select("event_id", "user_id", "v")


@query(
    """select o_custkey,o_orderstatus,o_orderkey,o_totalprice from orders
  qualify row_number() over (partition by o_custkey,o_orderstatus order by o_orderkey)=1""",
    name="first_per_key",
)
def first_per_key_of(t):
    orders = t.orders.select("o_custkey", "o_orderstatus", "o_orderkey", "o_totalprice")
    return first_per_key(orders, ["o_custkey", "o_orderstatus"], ["o_orderkey"])


@query(
    f"""select o_custkey,o_orderkey,o_orderpriority from orders
  qualify row_number() over (partition by o_custkey order by {PRIORITY_RANK}, o_orderkey)=1""",
    name="ranked_first",
)
def ranked_first_of(t):
    orders = t.orders.select("o_custkey", "o_orderkey", "o_orderpriority")
    return ranked_first(orders, "o_custkey", priority_rank(), ["o_orderkey"])
