import datetime

import campaign
import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from rosterlane import fixed_values as V
from rosterlane import schemas
from rosterlane.plans import (
    attach_flags,
    build_base,
    build_detail,
    build_trend,
    enrich_contacts,
    form_choice,
    participation_flags,
    payer_list,
    portal_state,
    report_day,
    run_report,
    status_by_plan,
    webinar_participation,
)
from rosterlane.plans.report import trend_metrics
from rosterlane.sinks import read_published

DATE = "01/02/2025"
# Already the next day in UTC.
MOMENT = datetime.datetime(2025, 1, 3, 3, tzinfo=datetime.timezone.utc)


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("pages")
    campaign.land_pages(path)
    return path


@pytest.fixture(scope="module")
def inputs(spark, folder):
    return campaign.inputs(spark, folder)


@pytest.fixture(scope="module")
def detail(inputs):
    return build_detail(build_base(inputs), form_choice(inputs.form), DATE)


@pytest.fixture(scope="module")
def trend(inputs):
    return build_trend(build_base(inputs), form_choice(inputs.form), DATE)


def test_participation_from_pages(spark, folder):
    got = webinar_participation(*campaign.pages(spark, folder))
    assert rows(got.distinct()) == campaign.PARTICIPATION


def test_participation_without_upcoming_pages(spark, folder):
    got = webinar_participation(*campaign.pages(spark, folder)[:4])
    upcoming = {("555555555", "INFO_SESSION"), ("111111111", "PCS_GR_SESSION")}
    expected = [r for r in campaign.PARTICIPATION if r[:2] not in upcoming]
    assert rows(got.distinct()) == expected


def test_flags_of_a_session_without_records(spark):
    records = spark.createDataFrame(
        [("123", "GS_SESSION", True, True)],
        "TAX_ID string, SESSION string, REGISTERED boolean, ATTENDED boolean",
    )
    roster = spark.createDataFrame([("123",), ("456",), (None,)], "id string")
    got = attach_flags(roster, participation_flags(records), "id", "TAX_ID")
    assert got.columns == ["id", *schemas.FLAGS]
    shown = rows(got, "id", "ATTENDED_GS_SESSION", "REGISTERED_GS_SESSION", "REGISTERED_OH_SESSION")
    assert shown == [("123", True, True, False), ("456", False, False, False), (None, False, False, False)]
    nothing = attach_flags(roster, participation_flags(records.where("false")), "id", "TAX_ID")
    assert {v for r in nothing.drop("id").collect() for v in r} == {False}


def test_detail_has_the_47_columns_in_order(detail):
    assert len(schemas.DETAIL) == 47 and detail.columns == schemas.DETAIL
    kinds = dict(detail.dtypes)
    assert kinds.pop("PROVIDER_ID") == "bigint"
    assert set(kinds.values()) == {"string"}


def test_detail_values(detail):
    got = {(r.WAVE, r.PROVIDER_TAX_ID): r.asDict() for r in detail.collect()}
    assert got.keys() == campaign.DETAIL.keys()
    for key, expected in campaign.DETAIL.items():
        name, email, true, status, status_help, choice, payers, portal, number, kind = expected
        row = got[key]
        assert row["PROVIDER_NAME"] == name
        assert row["PROVIDER_EMAIL_ADDRESS"] == email, key
        assert {f for f in schemas.FLAGS if row[f] == "True"} == true, key
        assert {row[f] for f in schemas.FLAGS} <= {"True", "False"}
        assert row["LEARNING_PLAN_ENROLLMENT_STATUS"] == status
        assert row["LEARNING_PLAN_ENROLLMENT_STATUS_HH"] == status_help
        assert row["EVV_SYSTEM_CHOICE"] == choice, key
        assert row["PAYERS"] == payers, key
        assert (row["PORTAL_CREATED"], row["PROVIDER_ID"], row["PORTAL_TYPE"]) == (
            portal,
            number,
            kind,
        )
        assert row["EVENT_DATE"] == DATE
        assert row["PROVIDER_ADDRESS_1"] == "nan"


def test_trend_values(trend):
    (row,) = trend.collect()
    counts = row.asDict()
    assert len(counts) == 46 and counts.pop("EVENT_DATE") == datetime.date(2025, 1, 2)
    assert counts == dict.fromkeys(counts, 0) | campaign.TREND
    assert {kind for name, kind in trend.dtypes if name != "EVENT_DATE"} == {"bigint"}


def test_trend_equals_counting_over_all_forms_of_a_provider(inputs, trend):
    """The marks per id give what joining every form and counting rows gives."""
    base, forms = build_base(inputs), form_choice(inputs.form)
    label = f"coalesce(`{V.FORM_CHOICE}`, '{V.MISSING_FORM}')"
    rows_ = base.join(forms, base["PROVIDER_TAX_ID"] == forms[V.FORM_TAX_ID], "left")
    predicates = {
        "COMPLETED_ONBOARDING_FORM": f"{label} <> '{V.MISSING_FORM}'",
        **{name: f"{label} = '{text}'" for name, text in V.CHOICE_LABELS.items()},
    }
    counts = rows_.selectExpr(
        *(f"count(distinct if({p}, PROVIDER_TAX_ID, null)) as {n}" for n, p in predicates.items())
    )
    assert counts.first().asDict() == trend.select(*predicates).first().asDict()


def test_metrics_are_bounded_by_the_provider_count(trend):
    row = trend.first().asDict()
    assert len(trend_metrics()) == 45
    assert all(v <= row["PROVIDER_COUNT"] for n, v in row.items() if n != "EVENT_DATE")
    for part in ("HH", "HEALTH", "PCS"):
        assert row[f"{part}_PORTALS_CREATED"] <= row["PORTALS_CREATED"]
    for session in V.SESSIONS:
        assert row[f"ATTENDED_{session.suffix}"] <= row[f"REGISTERED_{session.suffix}"]


@pytest.mark.parametrize("parts", [3, 7])
def test_results_do_not_depend_on_the_partitioning(spark, folder, detail, trend, parts):
    other = campaign.inputs(spark, folder, parts)
    base, forms = build_base(other), form_choice(other.form)
    assert rows(build_detail(base, forms, DATE)) == rows(detail)
    assert rows(build_trend(base, forms, DATE)) == rows(trend)


def test_report_day(spark):
    assert report_day(spark, MOMENT) == (DATE, "2025-01-02")


def test_run_report_twice(spark, inputs, tmp_path, detail, trend):
    store, export = str(tmp_path / "store"), str(tmp_path / "export")
    for _ in range(2):
        run_report(inputs, MOMENT, store, export, "Report")
    written = read_published(spark, store, "detail", ["2025-01-02"])
    assert rows(written, *detail.columns) == rows(detail)
    assert rows(read_published(spark, store, "trend")) == rows(trend)
    exported = spark.read.option("header", True).csv(f"{export}/Report - 2025-01-02")
    assert exported.columns == schemas.DETAIL and exported.count() == len(campaign.DETAIL)


def test_a_run_joins_its_inputs_once(spark, inputs, tmp_path, monkeypatch):
    """The shared part is computed for one checkpoint; what is exported is read from what was written."""
    from rosterlane.plans import report

    built, exported = [], []
    monkeypatch.setattr(report, "build_base", lambda i, f=report.build_base: built.append(1) or f(i))
    monkeypatch.setattr(report, "export_report", lambda df, *rest: exported.append(plan(df)))
    written = run_report(inputs, MOMENT, str(tmp_path / "store"), "", "Report")
    assert built == [1]
    # The rows of the detail meet the form choices, and nothing else is joined again.
    assert len(exported) == 1 and "Join" not in exported[0] and "FileScan parquet" in exported[0]
    assert rows(written["trend"], "PROVIDER_COUNT") == [(campaign.TREND["PROVIDER_COUNT"],)]


def test_counts_that_disagree_are_not_published(spark, inputs, tmp_path, monkeypatch):
    from rosterlane.plans import report

    store = str(tmp_path / "store")
    run_report(inputs, MOMENT, store, str(tmp_path / "export"), "Report")
    wrong = lambda base, forms, date, f=report.build_trend: f(base, forms, date).withColumn("HH_PROVIDER_COUNT", F.lit(99).cast("long"))
    monkeypatch.setattr(report, "build_trend", wrong)
    with pytest.raises(ValueError, match="HH_PROVIDER_COUNT: 99 in the trend, 2 in the detail"):
        run_report(inputs, MOMENT, store, str(tmp_path / "export"), "Report")
    assert rows(read_published(spark, store, "trend"), "HH_PROVIDER_COUNT") == [(2,)]


def test_plans_are_joined_once_and_without_python(inputs):
    text = plan(build_detail(build_base(inputs), form_choice(inputs.form), DATE))
    for word in ("CartesianProduct", "NestedLoop", "PythonUDF", "EvalPython", "InPandas"):
        assert word not in text


def test_literal_override_of_emails(spark, inputs):
    roster = spark.createDataFrame(
        [campaign.provider("1", "a", " ", "PCS", 0), campaign.provider("1", "b", "b@x.org", "PCS", 1)],
        schemas.ROSTER,
    )
    account = spark.createDataFrame([("A", "1")], schemas.ACCOUNT)
    contact = spark.createDataFrame([("A", "Owner", "o@crm.org")], schemas.CONTACT)

    def emails(**options):
        got = enrich_contacts(roster, contact, account, **options)
        assert got.columns == roster.columns
        return [r[0] for r in got.orderBy("ingest_seq").select("Provider Email Address").collect()]

    assert emails() == ["o@crm.org", "b@x.org"]
    assert emails(only_blank=False) == ["o@crm.org", "o@crm.org"]


def test_form_choice(spark, inputs):
    forms = form_choice(inputs.form)
    got = rows(forms, V.FORM_GROUP, V.FORM_TAX_ID, V.FORM_CHOICE, "ingest_seq")
    assert got == sorted(
        [
            (1, "111111111", campaign.EDI, 0),
            (2, "222222222", campaign.USE, 3),
            (3, "222222222", campaign.NO_SYSTEM, 4),
            (4, "44444444", campaign.EDI, 5),
            (5, "555555555", None, 8),
        ],
        key=repr,
    )
    padded = form_choice(inputs.form, id_width=9).where(F.col(V.FORM_GROUP) == 4)
    assert rows(padded, V.FORM_TAX_ID) == [("044444444",)]


def test_payer_list(inputs):
    assert rows(payer_list(inputs.payers)) == [
        ("111111111", "Payer A, Payer B", "Home Help"),
        ("222222222", "Payer C", "Home Health, PCS"),
        ("333333333", "Payer D", "PCS"),
    ]


def test_status_by_plan_takes_the_first_enrolment(spark):
    data = [("1", "A", "Completed", 5), ("1", "A", "Enrolled", 2), ("1", "B", None, 0), ("1", "B", "x", 1)]
    enrolments = spark.createDataFrame(data, schemas.ENROLMENT)
    df = spark.createDataFrame([("1",), ("2",), (None,)], "id string")
    got = status_by_plan(df, enrolments, "id", {"A": "a", "B": "b"}, label="none")
    assert rows(got) == [("1", "Enrolled", "none"), ("2", "none", "none"), (None, "none", "none")]


def test_portal_state_takes_the_first_portal(spark):
    data = [("1", "Free", 2, 9), ("1", "Paid", 1, 3), (None, "Paid", 5, 0)]
    portals = spark.createDataFrame(data, "TAX_ID string, PLATFORM_TAG string, PROVIDER_ID long, ingest_seq long")
    df = spark.createDataFrame([("1",), (None,)], "id string")
    got = portal_state(df, portals, "id")
    assert rows(got, "id", "PORTAL_CREATED", "PROVIDER_ID", "PORTAL_TYPE") == [
        ("1", "True", 1, "Paid"),
        (None, "False", None, None),
    ]
