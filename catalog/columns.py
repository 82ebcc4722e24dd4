"""Projections, null handling, flattening of answers and unions."""

from pyspark.sql import functions as F

from catalog.registry import query
from rosterlane.operators import (
    ensure_columns,
    questions_to_columns,
    rename_columns,
    stringify_all,
    union_ragged,
)


@query("""select c_custkey as provider_id, c_name as provider_name, c_name as provider_label,
  c_mktsegment as wave, false as registered from customer""")
def select_rename_drop(t):
    df = t.customer.select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    df = df.withColumns({"provider_label": F.col("c_name"), "registered": F.lit(False)})
    names = {"c_custkey": "provider_id", "c_name": "provider_name", "c_mktsegment": "wave"}
    return rename_columns(df.drop("c_acctbal"), names)


@query(
    "select c_custkey, c_name, cast(null as varchar) as status_y from customer",
    name="ensure_columns",
)
def ensure_status(t):
    df = t.customer.select("c_custkey", "c_name")
    return ensure_columns(df, {"status_y": "string", "c_name": "string"})


@query("""select o_orderkey, coalesce(case when o_totalprice>100000 then o_orderstatus end,
  'Not Registered') as status, coalesce(case when o_totalprice>200000 then o_orderpriority end,
  'Missing') as choice from orders""")
def fill_label(t):
    df = t.orders.select(
        "o_orderkey",
        F.when(F.col("o_totalprice") > 100000, F.col("o_orderstatus")).alias("status"),
        F.when(F.col("o_totalprice") > 200000, F.col("o_orderpriority")).alias("choice"),
    )
    return df.fillna({"status": "Not Registered", "choice": "Missing"})


@query("""select o_orderkey, o_totalprice from (select o_orderkey, o_totalprice,
  case when o_orderstatus<>'P' then o_custkey end as tax_id from orders)
  where tax_id is not null""")
def drop_null_rows(t):
    key = F.when(F.col("o_orderstatus") != "P", F.col("o_custkey"))
    df = t.orders.select("o_orderkey", "o_totalprice", key.alias("tax_id"))
    return df.dropna(subset=["tax_id"]).drop("tax_id")


@query("""select c_custkey::varchar as c_custkey, case when c_nationkey>12 then 'True'
  else 'False' end as flag, coalesce(case when c_mktsegment<>'BUILDING' then c_mktsegment end,'nan')
  as seg, c_acctbal::varchar as balance from customer""", name="stringify_all")
def stringify_table(t):
    segment = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment"))
    df = t.customer.select(
        "c_custkey",
        (F.col("c_nationkey") > 12).alias("flag"),
        segment.alias("seg"),
        F.col("c_acctbal").alias("balance"),
    )
    return stringify_all(df)


@query("""select conv_id, max_by(text, turn) filter (where role='user') as user_text,
  max_by(text, turn) filter (where role='assistant') as assistant_text,
  max_by(text, turn) filter (where role='system') as system_text
  from conversations group by conv_id""", name="questions_to_columns")
def questions_to_roles(t):
    """Each turn is a record with an array of answers; the last turn with an answer counts."""
    turn = F.array(F.struct(F.col("role").alias("title"), F.col("text").alias("value")))
    df = t.conversations.select("conv_id", "turn", turn.alias("answers"))
    roles = {"user": "user_text", "assistant": "assistant_text", "system": "system_text"}
    flat = questions_to_columns(df, "answers", roles)
    last = {n: F.max_by(n, F.when(F.col(n).isNotNull(), F.col("turn"))) for n in roles.values()}
    return flat.groupBy("conv_id").agg(*(c.alias(n) for n, c in last.items()))


@query("""select o_orderkey, case when o_orderstatus='F' then null when o_orderstatus='O'
  then o_orderpriority else 'second' end as plan, case when o_orderstatus='F' then null
  else o_orderstatus end as status, cast(null as varchar) as missing from orders""")
def questions_last_answer(t):
    """Arrays with a repeated title, an empty array and a title that never occurs."""

    def answer(title, value):
        return F.struct(F.lit(title).alias("title"), value.alias("value"))

    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    both = [answer("status", status), answer("plan", priority)]
    answers = (
        F.when(status == "O", F.array(answer("plan", F.lit("first")), *both))
        .when(status == "P", F.array(*both, answer("plan", F.lit("second"))))
        .otherwise(F.slice(F.array(*both), 1, 0))
    )
    df = t.orders.select("o_orderkey", answers.alias("answers"))
    titles = {"plan": "plan", "status": "status", "never asked": "missing"}
    return questions_to_columns(df, "answers", titles)


@query("""select event_id, user_id, value, cast(null as varchar) as props from events
  where event_type<>'view' union all
  select event_id, user_id, cast(null as double) as value, props from events
  where event_type='view'""", name="union_ragged")
def union_ragged_records(t):
    others = t.events.where(F.col("event_type") != "view").select("event_id", "user_id", "value")
    views = t.events.where(F.col("event_type") == "view").select("event_id", "user_id", "props")
    return union_ragged(others, views)


@query("select distinct user_id, event_type from events")
def set_distinct(t):
    return t.events.select("user_id", "event_type").distinct()
