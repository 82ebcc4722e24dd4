"""The composite steps of the campaign report and its two products."""

from rosterlane.plans.participation import (
    attach_flags,
    inperson_participation,
    page_account,
    participation_flags,
    webinar_participation,
)
from rosterlane.plans.report import (
    CampaignInputs,
    build_base,
    build_detail,
    build_trend,
    daily_changes,
    lay_out_sides,
    publish_trend,
    report_day,
    run_report,
    trend_over_days,
)
from rosterlane.plans.steps import (
    enrich_contacts,
    form_choice,
    payer_list,
    portal_state,
    status_by_plan,
)

__all__ = [
    "CampaignInputs",
    "attach_flags",
    "build_base",
    "build_detail",
    "build_trend",
    "daily_changes",
    "enrich_contacts",
    "form_choice",
    "inperson_participation",
    "lay_out_sides",
    "page_account",
    "participation_flags",
    "payer_list",
    "portal_state",
    "publish_trend",
    "report_day",
    "run_report",
    "status_by_plan",
    "trend_over_days",
    "webinar_participation",
]
