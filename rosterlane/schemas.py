"""Schemas of the landed inputs and column lists of the two products."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from rosterlane import fixed_values as V

# Explicit row order of a landed table. Order-dependent operators take it as their ``order``.
INGEST_SEQ = "ingest_seq"


def row_order(df: DataFrame) -> list[str]:
    """The order of a table's rows: the row number it landed with, else all its columns."""
    return [INGEST_SEQ] if INGEST_SEQ in df.columns else list(df.columns)


def _table(order: bool = False, **columns: str) -> T.StructType:
    schema = T.StructType()
    for name, kind in columns.items():
        schema.add(name, kind)
    if order:
        schema.add(INGEST_SEQ, "long")
    return schema


ROSTER = _table(order=True, **dict.fromkeys(V.ROSTER_COLUMNS, "string"))
FORM = _table(
    order=True,
    **{V.FORM_GROUP: "long", V.FORM_TAX_ID: "long", V.FORM_NPI: "long", V.FORM_CHOICE: "string"},
)
PAYERS = _table(**{V.ROSTER_TAX_ID: "string", "Payer": "string", V.ROSTER_WAVE: "string"})
CONTACT = _table(account_id="string", CONTACT_ROLE_C="string", email="string")
ACCOUNT = _table(ID="string", TAX_ID_C="string")
ENROLMENT = _table(
    order=True,
    AGENCY_TAX_ID="string",
    LEARNING_PLAN_NAME="string",
    LEARNING_PLAN_ENROLLMENT_STATUS="string",
)
ENGAGEMENT = _table(EVENT_NAME="string", MARKETING_ENGAGEMENT_TYPE="string", TAX_ID="string")
PORTAL = _table(
    order=True,
    **dict(zip(V.PORTAL_COLUMNS, ("string", "string", "long"))),
    **{V.PORTAL_DEMO: "string", V.PORTAL_ENVIRONMENT: "string"},
)

# Records inside landed JSON pages.
WEBINAR = _table(id="long", topic="string")
INSTANCE = _table(uuid="string")
PARTICIPANT = _table(registrant_id="string", status="string", id="string")
OCCURRENCE = _table(occurrence_id="string")
ANSWERS = T.ArrayType(_table(title="string", value="string"))
REGISTRANT = _table(id="string", status="string").add("custom_questions", ANSWERS)


def pair(suffix: str) -> list[str]:
    """The two flag columns of one session, in the detail's order."""
    return [f"ATTENDED_{suffix}", f"REGISTERED_{suffix}"]


FLAG_SUFFIXES = (*(s.suffix for s in V.SESSIONS), V.INPERSON_SUFFIX)
FLAGS = [flag for suffix in FLAG_SUFFIXES for flag in pair(suffix)]

DETAIL = [
    *V.ROSTER_COLUMNS.values(),
    *(flag for suffix in V.DETAIL_PAIRS_FIRST for flag in pair(suffix)),
    *V.DETAIL_ENROLMENT,
    *(flag for suffix in V.DETAIL_PAIRS_LAST for flag in pair(suffix)),
    *V.DETAIL_TAIL,
]
