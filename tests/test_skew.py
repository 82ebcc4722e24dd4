"""Hot keys do not end in one task: they are salted, or adaptive execution splits them."""

import pytest
from pyspark.sql import functions as F

from rosterlane import fixed_values as V
from rosterlane.operators import left_join
from rosterlane.plans import webinar_participation
from rosterlane.sources import crm_contacts

SETTINGS = {
    "spark.sql.shuffle.partitions": "16",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def skewed(spark):
    """Settings under which small tables are treated as large ones."""
    before = {name: spark.conf.get(name, None) for name in SETTINGS}
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    yield spark
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def split_joins(df):
    """Number of split joins in the plan that has run."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("Initial Plan")[0].count("skew=true")


def test_join_that_keeps_all_matches_of_a_hot_key(skewed):
    many = skewed.range(100000).repartition(8).selectExpr("if(id % 3 = 0, 7, id % 5000) as k", "id as n")
    few = skewed.range(5000).repartition(4)
    joined = left_join(few, many, "id", "k", hot_rows=1000)
    largest = joined.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    # 33,334 rows are of one key.
    assert joined.count() == 100000 and largest < 15000


def test_contacts_of_a_hot_account(skewed):
    contact = skewed.range(100000).repartition(8).selectExpr(
        "cast(if(id % 3 = 0, 7, id % 5000) as string) as account_id",
        "'Owner' as CONTACT_ROLE_C",
        "concat('e', id) as email",
    )
    account = skewed.range(5000).selectExpr("cast(id as string) as ID", "cast(id as string) as TAX_ID_C")
    ids = skewed.range(4000).select(F.col("id").cast("string"))
    assert split_joins(crm_contacts(contact, account, ids, "id")) == 1


def test_registrants_and_participants_of_a_hot_webinar(skewed):
    topics = [s.topic for s in V.SESSIONS]
    catalogue = skewed.createDataFrame(
        [([(i, topics[i % 12])],) for i in range(200)], "webinars array<struct<id:bigint,topic:string>>"
    )
    answer = f"named_struct('title', '{V.TAX_ID_QUESTION}', 'value', cast(id % 7000 as string))"
    registrants = skewed.range(100000).repartition(8).selectExpr(
        "cast(if(id % 3 = 0, 7, id % 200) as string) as webinar_id",
        "array(named_struct('id', cast(id as string), 'status', 'approved',"
        f" 'custom_questions', array({answer}))) as registrants",
    )
    instances = skewed.range(200).selectExpr(
        "cast(id as string) as webinar_id", "array(named_struct('uuid', concat('u', id))) as webinars"
    )
    participants = skewed.range(100000).repartition(8).selectExpr(
        "concat('u', if(id % 3 = 0, 7, id % 200)) as uuid",
        "array(named_struct('registrant_id', cast(id as string), 'status', 'in_meeting'))"
        " as participants",
    )
    got = webinar_participation(catalogue, instances, participants, registrants)
    assert split_joins(got) == 3
