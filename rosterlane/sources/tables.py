"""Tables with a fixed schema, and the filtered scans of the warehouse tables.

The filters and projections are plain predicates on the scan, so they are pushed into Parquet.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterlane import fixed_values as V
from rosterlane.functions.ids import normalize_id
from rosterlane.functions.text import any_of, contains_ci, trim_ws
from rosterlane.operators.columns import quoted
from rosterlane.operators.joins import keep_matching
from rosterlane.operators.prefilter import prefiltered
from rosterlane.sources.sheets import read_sheets


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    file_format: str = "parquet",
    line_breaks: bool = False,
    required: Sequence[str] = (),
) -> DataFrame:
    """Landed sheet or table with its declared types: nothing is inferred, identifiers stay text.

    Columns are bound by name, whatever their order in the file: those the schema does not name are
    left out, those a file does not have are null, unless they are ``required``, which raises. CSV has a
    header line in every file, and quotes within quotes are doubled, as spreadsheets and this library's
    own reports write them; a value that does not fit the schema raises. ``line_breaks`` allows them
    within quotes, at the price that a file can't be split over tasks.
    """
    if file_format == "csv":
        return read_sheets(spark, path, schema, line_breaks, required)
    absent = set(required).difference(spark.read.format(file_format).load(path).columns) if required else ()
    if absent:
        raise ValueError(f"{path} has no column {', '.join(sorted(absent))}")
    return spark.read.schema(schema).format(file_format).load(path)


def learning_enrolments(enrolments: DataFrame, plans: tuple[str, ...]) -> DataFrame:
    """Enrolments of the named plans that have an agency id."""
    return enrolments.where(
        any_of(F.col("LEARNING_PLAN_NAME"), plans) & F.col("AGENCY_TAX_ID").isNotNull()
    )


def inperson_engagements(engagements: DataFrame, part: str = V.INPERSON_EVENT) -> DataFrame:
    """Marketing engagements whose event name contains ``part``, with a clean id."""
    return engagements.where(contains_ci(F.col("EVENT_NAME"), part)).withColumn(
        "TAX_ID", normalize_id(F.col("TAX_ID"), engagements.schema["TAX_ID"].dataType)
    )


def portals(portal_dim: DataFrame) -> DataFrame:
    """Real portals of the wanted environments, projected to the three report columns (and the
    row order, where the table has one)."""
    rest = [c for c in portal_dim.columns if c == "ingest_seq"]
    return portal_dim.where(
        (F.col(quoted(V.PORTAL_DEMO)) == "FALSE")
        & contains_ci(F.col(quoted(V.PORTAL_ENVIRONMENT)), V.PORTAL_ENVIRONMENT_PART)
    ).select(*(F.col(quoted(c)).alias(n) for c, n in V.PORTAL_COLUMNS.items()), *rest)


def crm_contacts(
    contact: DataFrame, account: DataFrame, ids: DataFrame, id_column: str, prefilter: bool = False
) -> DataFrame:
    """Contacts with an email whose account has one of the given ids: id, role, email.

    ``prefilter``: where few of very many contacts are wanted, most are left out by a Bloom filter of
    the wanted accounts ahead of the shuffle.
    """
    accounts = account.select(F.col("ID"), trim_ws(F.col("TAX_ID_C")).alias("TAX_ID_C"))
    wanted = keep_matching(accounts, ids, "TAX_ID_C", id_column, even=True)
    with_email = contact.where(F.col("email").isNotNull())
    if prefilter:
        with_email = prefiltered(with_email, wanted, ["account_id"], ["ID"])
    return with_email.join(wanted, with_email["account_id"] == wanted["ID"], "inner").select(
        "TAX_ID_C", "CONTACT_ROLE_C", "email"
    )
