"""The enrichment steps between the roster and the detail rows.

The roster they add to has few rows per id: ``build_base`` makes it unique per wave and id first.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterlane import fixed_values as V
from rosterlane.functions.ids import id_as_int_text, normalize_id
from rosterlane.functions.roles import role_rank
from rosterlane.functions.text import is_blank
from rosterlane.operators.aggregates import distinct_concat
from rosterlane.operators.columns import quoted
from rosterlane.operators.joins import left_join, lookup_override
from rosterlane.operators.ordered import (
    BACKWARD,
    FORWARD,
    fill_within_group,
    first_per_key,
    ranked_first,
)
from rosterlane.schemas import row_order
from rosterlane.sources.tables import crm_contacts, learning_enrolments

PAYER_ID = "PAYER_TAX_ID"


def enrich_contacts(
    roster: DataFrame, contact: DataFrame, account: DataFrame, only_blank: bool = True
) -> DataFrame:
    """Fill blank emails of the roster from the best-ranked CRM contact of the same id.

    Contacts without a role or an email do not count; among equal ranks the first email in
    alphabetical order is taken. With ``only_blank`` off, the contact replaces a present email of
    an id that has a blank one elsewhere.
    """
    blank = roster.where(is_blank(F.col(quoted(V.ROSTER_EMAIL))))
    contacts = crm_contacts(contact, account, blank, V.ROSTER_TAX_ID).where(
        F.col("CONTACT_ROLE_C").isNotNull()
    )
    rank = role_rank(F.col("CONTACT_ROLE_C"), V.ROLE_HIERARCHY, V.ROLE_PART)
    picked = ranked_first(contacts, "TAX_ID_C", rank, ["email"])
    return lookup_override(
        roster,
        picked,
        on=V.ROSTER_TAX_ID,
        column=V.ROSTER_EMAIL,
        value="email",
        mapping_on="TAX_ID_C",
        only_blank=only_blank,
        even=True,
    )


def form_choice(form: DataFrame, id_width: int | None = None) -> DataFrame:
    """Repaired onboarding forms: gaps filled among the rows of the same submitter, one row per
    submitter and tax id, rows without a tax id left out, the id as integer text."""
    filled = fill_within_group(
        form,
        V.FORM_GROUP,
        {V.FORM_TAX_ID: FORWARD, V.FORM_NPI: FORWARD, V.FORM_CHOICE: BACKWARD},
        row_order(form),
    ).dropna(subset=[V.FORM_TAX_ID])
    kept = first_per_key(filled, [V.FORM_GROUP, V.FORM_TAX_ID], row_order(form))
    return kept.withColumn(V.FORM_TAX_ID, id_as_int_text(F.col(V.FORM_TAX_ID), width=id_width))


def status_by_plan(
    df: DataFrame,
    enrolments: DataFrame,
    on: str,
    plans: Mapping[str, str],
    label: str = V.NOT_REGISTERED,
) -> DataFrame:
    """Add, per plan, the status of the id's first enrolment; ``plans`` maps plan to column.

    The first of every plan is picked in one aggregation per id, so the join is one to one. The order
    is the landed row number or, where there is none, that of all columns.
    """
    plan, status = F.col("LEARNING_PLAN_NAME"), F.col("LEARNING_PLAN_ENROLLMENT_STATUS")
    order = F.struct(*map(quoted, row_order(enrolments)), status.alias("last"))
    side_by_side = (
        learning_enrolments(enrolments, tuple(plans))
        .groupBy("AGENCY_TAX_ID")
        .agg(
            *(
                F.min_by(status, F.when(plan == name, order)).alias(column)
                for name, column in plans.items()
            )
        )
    )
    joined = left_join(df, side_by_side, on, "AGENCY_TAX_ID", unique=True, even=True)
    joined = joined.drop("AGENCY_TAX_ID")
    return joined.fillna(label, subset=list(plans.values()))


def clean_payers(payers: DataFrame) -> DataFrame:
    """(PAYER_TAX_ID, Payer, Wave): the payer sheet with clean ids."""
    kind = payers.schema[V.ROSTER_TAX_ID].dataType
    clean = normalize_id(F.col(V.ROSTER_TAX_ID), kind).alias(PAYER_ID)
    return payers.select(clean, "Payer", V.ROSTER_WAVE)


def payer_list(payers: DataFrame) -> DataFrame:
    """Per clean id its distinct payers and its distinct waves, each as one text; of the sheet, or of
    what ``clean_payers`` has made of it."""
    clean = payers if PAYER_ID in payers.columns else clean_payers(payers)
    return distinct_concat(clean, PAYER_ID, {"Payer": "PAYERS", V.ROSTER_WAVE: "PAYER_WAVE"})


def attach_payers(df: DataFrame, payers: DataFrame, on: str, wave: str) -> DataFrame:
    """Add PAYERS where id and wave agree with the payer row.

    A payer row is unique by id alone, so the join is on the id (which keeps the partitioning of
    the joins around it) and the wave is compared afterwards: the same as joining on both.
    """
    joined = left_join(df, payers, on, "PAYER_TAX_ID", unique=True, even=True)
    agree = F.col(quoted(wave)) == F.col("PAYER_WAVE")
    return joined.withColumn("PAYERS", F.when(agree, F.col("PAYERS"))).drop(
        "PAYER_TAX_ID", "PAYER_WAVE"
    )


def portal_state(
    df: DataFrame, portals: DataFrame, on: str, order: Sequence[str] | None = None
) -> DataFrame:
    """Add PORTAL_CREATED (text), PROVIDER_ID and PORTAL_TYPE of the id's first portal."""
    known = portals.where(F.col("TAX_ID").isNotNull())
    first = first_per_key(known, ["TAX_ID"], order or row_order(portals)).select(
        F.col("TAX_ID").alias("PORTAL_TAX_ID"),
        "PROVIDER_ID",
        F.col("PLATFORM_TAG").alias("PORTAL_TYPE"),
    )
    joined = left_join(df, first, on, "PORTAL_TAX_ID", unique=True, even=True)
    created = F.when(F.col("PORTAL_TAX_ID").isNotNull(), "True").otherwise("False")
    return joined.withColumn("PORTAL_CREATED", created).drop("PORTAL_TAX_ID")
