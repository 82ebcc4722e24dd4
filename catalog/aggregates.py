"""Aggregations."""

from pyspark.sql import functions as F

from catalog.registry import query
from rosterlane.operators import conditional_distinct, distinct_concat

WIDE = {
    **{f"quantity_{n}": ("l_quantity", n) for n in range(1, 23)},
    **{f"supplier_{n}": ("l_suppkey", n) for n in range(1, 23)},
}


@query("""select o_custkey,
  string_agg(distinct o_orderpriority, ', ' order by o_orderpriority) as payers,
  string_agg(distinct o_orderstatus, ', ' order by o_orderstatus) as waves
  from orders group by o_custkey""", name="distinct_concat")
def distinct_concat_of(t):
    return distinct_concat(
        t.orders, "o_custkey", {"o_orderpriority": "payers", "o_orderstatus": "waves"}
    )


@query("""select count(distinct o_custkey) as provider_count,
  count(distinct case when o_orderstatus='F' then o_custkey end) as f_count,
  count(distinct case when o_orderpriority<>'5-LOW' then o_custkey end) as not_low,
  count(distinct case when o_orderstatus='O' and o_orderpriority='1-URGENT' then o_custkey end)
    as o_urgent from orders""", name="conditional_distinct")
def conditional_distinct_of(t):
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    return conditional_distinct(
        t.orders,
        "o_custkey",
        {
            "provider_count": None,
            "f_count": status == "F",
            "not_low": priority != "5-LOW",
            "o_urgent": (status == "O") & (priority == "1-URGENT"),
        },
    )


@query(
    "select count(distinct l_orderkey) as all_orders, "
    + ", ".join(
        f"count(distinct case when {column}={value} then l_orderkey end) as {name}"
        for name, (column, value) in WIDE.items()
    )
    + " from lineitem"
)
def conditional_distinct_wide(t):
    """As many counts as the trend has."""
    marks = {name: f"{column} = {value}" for name, (column, value) in WIDE.items()}
    return conditional_distinct(t.lineitem, "l_orderkey", {"all_orders": None, **marks})
