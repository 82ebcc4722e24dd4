"""The detail snapshot (a row per wave and provider) and the trend snapshot (one row per run)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, replace
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlane import fixed_values as V
from rosterlane.functions.dates import export_stamp, report_date
from rosterlane.functions.text import trim_ws
from rosterlane.operators.aggregates import conditional_distinct, marks_by_key
from rosterlane.operators.bitmaps import NUMBER, bitmap_counts, metric_bitmaps, number_keys
from rosterlane.operators.changes import table_changes
from rosterlane.operators.columns import quoted, rename_columns, stringify_all, union_ragged
from rosterlane.operators.joins import left_join
from rosterlane.operators.ordered import first_per_key
from rosterlane.plans.participation import (
    attach_flags,
    inperson_participation,
    participation_flags,
)
from rosterlane.plans.steps import (
    PAYER_ID,
    attach_payers,
    clean_payers,
    enrich_contacts,
    form_choice,
    payer_list,
    portal_state,
    status_by_plan,
)
from rosterlane.schemas import DETAIL, FLAGS, row_order
from rosterlane.sinks.files import (
    EVENT_DATE,
    MAX_ROWS_PER_FILE,
    export_report,
    kept,
    lay_out,
    quote,
    shared_folder,
)
from rosterlane.sinks.published import publish_day, published_runs, read_published
from rosterlane.sources.tables import inperson_engagements, learning_enrolments, portals

ID = V.ROSTER_COLUMNS[V.ROSTER_TAX_ID]
WAVE = V.ROSTER_COLUMNS[V.ROSTER_WAVE]
CHOICE, PORTAL_CREATED = "EVV_SYSTEM_CHOICE", "PORTAL_CREATED"
STATUS, STATUS_HELP = V.DETAIL_ENROLMENT
FORM_KEY = "FORM_TAX_ID"

# What a day publishes.
DETAIL_PRODUCT, TREND_PRODUCT = "detail", "trend"
NUMBERS_PRODUCT, BITMAPS_PRODUCT = "numbers", "bitmaps"


@dataclass(frozen=True)
class CampaignInputs:
    """The tables of one run; ``participation`` is what ``webinar_participation`` returns.

    ``laid_out``: enrolments, payers and portals are what ``lay_out_sides`` has made of them.
    """

    roster: DataFrame
    form: DataFrame
    payers: DataFrame
    contact: DataFrame
    account: DataFrame
    participation: DataFrame
    enrolments: DataFrame
    engagements: DataFrame
    portal_dim: DataFrame
    laid_out: bool = False


def lay_out_sides(inputs: CampaignInputs, prefix: str, buckets: int, folder: str) -> CampaignInputs:
    """Write enrolments, payers and portals, cleaned and reduced to what the report reads, as tables
    bucketed by id; returns the inputs with these tables in their place.

    A report over them aggregates and joins every side where its buckets are, without a shuffle, if there
    are as many buckets as shuffle partitions or more; so they are laid out once and read every day. The
    tables lie in the folder, are named with the prefix, and replaced if they exist.
    """
    plans = (V.PLAN_HEALTH, V.PLAN_HELP)
    enrolments = learning_enrolments(inputs.enrolments, plans)
    sides = {
        "enrolments": (enrolments, "AGENCY_TAX_ID"),
        "payers": (clean_payers(inputs.payers), PAYER_ID),
        "portal_dim": (portals(inputs.portal_dim), "TAX_ID"),
    }
    tables = {name: lay_out(df, f"{prefix}_{name}", key, buckets, folder) for name, (df, key) in sides.items()}
    return replace(inputs, laid_out=True, **tables)


def build_base(inputs: CampaignInputs) -> DataFrame:
    """One row per wave and provider with everything but the form choice and the date.

    The roster is made unique first and every side that is joined is unique per id, so no join
    multiplies rows and all of them share one partitioning by id.
    """
    roster = inputs.roster.withColumn(V.ROSTER_TAX_ID, trim_ws(F.col(V.ROSTER_TAX_ID)))
    roster = first_per_key(roster, [V.ROSTER_WAVE, V.ROSTER_TAX_ID], row_order(roster))
    roster = enrich_contacts(roster, inputs.contact, inputs.account)
    base = rename_columns(roster, V.ROSTER_COLUMNS).select(*V.ROSTER_COLUMNS.values())

    inperson = inperson_participation(inperson_engagements(inputs.engagements))
    flags = participation_flags(union_ragged(inputs.participation, inperson))
    base = attach_flags(base, flags, ID, "TAX_ID")
    base = status_by_plan(
        base, inputs.enrolments, ID, {V.PLAN_HEALTH: STATUS, V.PLAN_HELP: STATUS_HELP}
    )
    base = attach_payers(base, payer_list(inputs.payers), ID, WAVE)
    return portal_state(base, inputs.portal_dim if inputs.laid_out else portals(inputs.portal_dim), ID)


def build_detail(base: DataFrame, forms: DataFrame, event_date: str) -> DataFrame:
    """The detail rows: text columns, unique per wave and provider.

    ``forms`` is what ``form_choice`` returns, of which the first per id counts.
    """
    first = first_per_key(forms, [V.FORM_TAX_ID], row_order(forms)).select(
        F.col(V.FORM_TAX_ID).alias(FORM_KEY), F.col(V.FORM_CHOICE).alias(CHOICE)
    )
    rows = left_join(base, first, ID, FORM_KEY, unique=True, even=True).fillna(
        V.MISSING_FORM, subset=[CHOICE]
    )
    # Portal columns are not labelled when missing: they keep their type and stay null.
    text = stringify_all(rows, keep=["PROVIDER_ID", "PORTAL_TYPE"])
    return text.withColumn(EVENT_DATE, F.lit(event_date)).select(*DETAIL)


def trend_metrics() -> dict[str, Column | None]:
    """The 45 counts: predicate over the base with form marks, or None for all providers."""
    wave, status, help_status = F.col(WAVE), F.col(STATUS), F.col(STATUS_HELP)
    portal = F.col(PORTAL_CREATED) == "True"
    marks = ["COMPLETED_ONBOARDING_FORM", *FLAGS, *V.CHOICE_LABELS]
    return {
        "PROVIDER_COUNT": None,
        "HH_PROVIDER_COUNT": wave == V.WAVE_HELP,
        "HEALTH_PROVIDER_COUNT": wave == V.WAVE_HEALTH,
        **{mark: F.col(quoted(mark)) for mark in marks},
        **{f"LMS_{n}": status == label for n, label in V.ENROLMENT_LABELS.items()},
        **{f"LMS_HH_{n}": help_status == label for n, label in V.ENROLMENT_LABELS.items()},
        "HH_PORTALS_CREATED": (wave == V.WAVE_HELP) & portal,
        "HEALTH_PORTALS_CREATED": (wave == V.WAVE_HEALTH) & portal,
        "PCS_PORTALS_CREATED": (wave == V.WAVE_PCS) & portal,
        "PORTALS_CREATED": portal,
    }


def form_marks(forms: DataFrame) -> DataFrame:
    """Per tax id: has any of its forms a choice, and which of the counted ones occur?"""
    choice = F.col(CHOICE)
    marks = {
        "COMPLETED_ONBOARDING_FORM": choice != V.MISSING_FORM,
        **{name: choice == label for name, label in V.CHOICE_LABELS.items()},
    }
    choices = forms.select(
        F.col(quoted(V.FORM_TAX_ID)).alias(FORM_KEY), F.col(quoted(V.FORM_CHOICE)).alias(CHOICE)
    )
    return marks_by_key(choices, FORM_KEY, marks)


def build_trend(base: DataFrame, forms: DataFrame, event_date: str) -> DataFrame:
    """One row: the date and the 45 distinct counts of providers.

    A provider with several form choices counts under each of them, unlike in the detail. The
    choices are reduced to marks per id before the join, which counts the same as joining all of
    them and keeps one row per provider and wave.
    """
    counts = conditional_distinct(_trend_rows(base, forms), ID, trend_metrics())
    return counts.select(F.to_date(F.lit(event_date), V.REPORT_DATE).alias(EVENT_DATE), "*")


def _trend_rows(base: DataFrame, forms: DataFrame) -> DataFrame:
    return left_join(base, form_marks(forms), ID, FORM_KEY, unique=True, even=True)


def trend_products(
    base: DataFrame, forms: DataFrame, known: DataFrame | None = None
) -> dict[str, DataFrame]:
    """What a day keeps so that its counts can be merged with those of other days: the numbers of ids
    that ``known`` (of all days, this one's earlier runs too) does not have, and a bitmap per metric."""
    rows = _trend_rows(base, forms)
    new = number_keys(base, ID, known).checkpoint()
    numbers = new if known is None else new.unionByName(known.select(ID, NUMBER))
    return {NUMBERS_PRODUCT: new, BITMAPS_PRODUCT: metric_bitmaps(rows, ID, numbers, trend_metrics())}


def publish_trend(
    spark: SparkSession, store: str, day: str, base: DataFrame, forms: DataFrame
) -> dict[str, DataFrame]:
    """Publish the day's numbers and bitmaps (see ``trend_products``) to a store of their own.

    A number that was given stays: a day that is published again keeps those it gave before.
    """
    days = published_runs(spark, store, NUMBERS_PRODUCT)
    known = read_published(spark, store, NUMBERS_PRODUCT) if days else None
    products = trend_products(base, forms, known)
    if quote(day) in days:
        own = read_published(spark, store, NUMBERS_PRODUCT, [day])
        products[NUMBERS_PRODUCT] = products[NUMBERS_PRODUCT].unionByName(own)
    return publish_day(spark, store, day, products)


def trend_over_days(spark: SparkSession, store: str, days: Iterable[str] | None = None) -> DataFrame:
    """One row: the 45 distinct counts over the given days together, from their bitmaps alone."""
    return bitmap_counts(read_published(spark, store, BITMAPS_PRODUCT, days), trend_metrics())


def daily_changes(
    spark: SparkSession, store: str, before: str, after: str, product: str = "detail"
) -> DataFrame:
    """What was added, removed or changed between the details of two published days, by wave and id."""
    one, other = (read_published(spark, store, product, [day]).drop(EVENT_DATE) for day in (before, after))
    return table_changes(one, other, [WAVE, ID])


def report_day(spark: SparkSession, moment: datetime) -> tuple[str, str]:
    """The date of a run in the report's zone, as the snapshots and as the report's name have it."""
    instant = F.timestamp_seconds(F.lit(moment.timestamp()))
    return tuple(spark.range(1).select(report_date(instant), export_stamp(instant)).first())


def check_pair(products: Mapping[str, DataFrame]) -> None:
    """The counts of the trend that the detail rows can show have to agree with them."""
    detail, trend = products[DETAIL_PRODUCT], products[TREND_PRODUCT].collect()
    if len(trend) != 1:
        raise ValueError(f"{len(trend)} trend rows instead of one")
    waves = {"PROVIDER_COUNT": None, "HH_PROVIDER_COUNT": V.WAVE_HELP, "HEALTH_PROVIDER_COUNT": V.WAVE_HEALTH}
    known = detail.where(F.col(ID) != V.MISSING_TEXT)
    marks = {n: None if w is None else F.col(WAVE) == w for n, w in waves.items()}
    counted = conditional_distinct(known.select(ID, WAVE), ID, marks).first()
    wrong = [f"{n}: {trend[0][n]} in the trend, {counted[n]} in the detail" for n in waves if trend[0][n] != counted[n]]
    if wrong:
        raise ValueError("; ".join(wrong))


def run_report(
    inputs: CampaignInputs, moment: datetime, store: str, export_folder: str, name: str
) -> dict[str, DataFrame]:
    """Build both products of the day of ``moment``, publish them together and export the detail.

    What both share is computed once and written, to the folder that all executors share; a
    session that names none (``spark.checkpoint.dir``) raises. The detail is written once, and checked
    and exported from what was written. A rerun replaces the day's products, also when it has no rows;
    one that dies leaves those that were there (see ``publish_day``).
    """
    spark = inputs.roster.sparkSession
    shared_folder(spark)
    event_date, stamp = report_day(spark, moment)
    base = kept(build_base(inputs), "base")
    forms = kept(form_choice(inputs.form), "forms")
    products = {
        DETAIL_PRODUCT: build_detail(base, forms, event_date),
        TREND_PRODUCT: build_trend(base, forms, event_date),
    }
    written = publish_day(spark, store, stamp, products, check_pair)
    # What is published was evened out when it was written.
    export_report(written[DETAIL_PRODUCT], export_folder, name, stamp, MAX_ROWS_PER_FILE, True)
    return written
