"""Fixed values.

Everything in this module is interface: names of input and output columns, session topics, labels,
literals and formats that have to be exactly these for the results to be right. Nothing else in the
library repeats them.
"""

from __future__ import annotations

from typing import NamedTuple

# Formats and time zone.
REPORT_ZONE = "US/Eastern"
REPORT_DATE = "MM/dd/yyyy"
EXPORT_STAMP = "yyyy-MM-dd"


# Session types: flag suffix, catalogue topic, and whether the catalogue's topic is trimmed first.
class Session(NamedTuple):
    suffix: str
    topic: str
    trim_topic: bool = False


SESSIONS = (
    Session("INFO_SESSION", "Michigan Informational Session Webinar"),
    Session(
        "EDI_SESSION",
        "Michigan Department of Health and Human Services: EDI Provider Onboarding Webinar",
    ),
    Session(
        "SUT_SESSION", "Michigan Department of Health and Human Services System User Training"
    ),
    Session("GS_SESSION", "Michigan Health and Human Services Getting Started Webinar"),
    Session("OH_SESSION", "MDHHS - HHAX Open Hours - Onboarding and Adoption Training"),
    Session("HH_INFO_SESSION", "Michigan Home Help Information Session Webinar"),
    Session("HH_EDI_SESSION", " Michigan Home Help: EDI Provider Onboarding Webinar"),
    Session("HH_SUT_SESSION", "System User Training - Michigan Home Help"),
    Session(
        "HH_OH_SESSION",
        "Michigan Home Help - HHAeXchange Open Hours - Onboarding and Adoption Training",
    ),
    Session("HH_GS_SESSION", "MIchigan Home Help - Getting Started Webinar"),
    Session("PCS_GR_SESSION", "Get Ready for EVV - Michigan"),
    Session("PCS_INFO_SESSION_WEBINAR", "Michigan EVV Info Session - September Go Live", True),
)
INPERSON_SUFFIX = "PCS_INFO_SESSION_INPERSON"

# Registration records.
TAX_ID_QUESTION = "Please enter your Tax ID number (without dashes) for attendance purposes."
IN_MEETING = "in_meeting"

# In-person events.
INPERSON_EVENT = "mi roadshow"
EVENT_REGISTRATION = "event-registration"
EVENT_ATTENDANCE = "event-attendance"

# Learning plans and enrolment labels.
PLAN_HEALTH = "Michigan Home Health Provider Learning Plan"
PLAN_HELP = "Michigan Home Help Provider Learning Plan"
NOT_REGISTERED = "Not Registered"
ENROLMENT_LABELS = {
    "NOTREGISTERED": "Not Registered",
    "ENROLLED": "Enrolled",
    "INPROGRESS": "In Progress",
    "COMPLETED": "Completed",
}

# Campaign waves.
WAVE_HELP = "Home Help"
WAVE_HEALTH = "Home Health"
WAVE_PCS = "PCS"

# Contact roles.
ROLE_HIERARCHY = ("Administrator", "Owner", "Operations")
ROLE_PART = "Coordinator"

# Onboarding form.
FORM_GROUP = "MichiganDepartmentOfHealthAndHu_Id"
FORM_TAX_ID = "FederalTaxID"
FORM_NPI = "NPI"
FORM_CHOICE = "DoesYourAgencyCurrentlyUseAnEVVSystemToCaptureTheStartTimeEndTimeAndLocationOfTheMembersService"
MISSING_FORM = "Missing Cognito Form"
CHOICE_LABELS = {
    "YES_INTEGRATE_EDI": (
        "Yes - I currently have my own EVV system and would like to integrate with HHAX (EDI)"
    ),
    "YES_USE_HHAX": (
        "Yes - I currently have my own EVV system but would like to use HHAX (Free EVV)"
    ),
    "NO_EVV_SYSTEM": (
        "No - I currently do not have my own EVV system and would like to use HHAX (Free EVV)"
    ),
}

# Roster and payer sheets: input column and its name in the detail (trailing space is real).
ROSTER_TAX_ID = "Provider TAX ID"
ROSTER_EMAIL = "Provider Email Address"
ROSTER_WAVE = "Wave"
ROSTER_KNOWN = "In HHAX"
ROSTER_COLUMNS = {
    "Provider TAX ID": "PROVIDER_TAX_ID",
    "Provider Name": "PROVIDER_NAME",
    "Provider NPI Number": "PROVIDER_NPI_NUMBER",
    "Tax ID+NPI": "TAX_ID_NPI",
    "Provider Address 1": "PROVIDER_ADDRESS_1",
    "Provider City": "PROVIDER_CITY",
    "Provider State": "PROVIDER_STATE",
    "Provider Zip Code": "PROVIDER_ZIP_CODE",
    "Provider Contact Name": "PROVIDER_CONTACT_NAME",
    "Provider Email Address": "PROVIDER_EMAIL_ADDRESS",
    "Provider Phone Number ": "PROVIDER_PHONE_NUMBER",
    "In HHAX": "IN_HHAX",
    "Wave": "WAVE",
}

# Portal dimension: input column (misspelling is real) and its name after the projection.
PORTAL_COLUMNS = {
    "Federal Tax Number": "TAX_ID",
    "Platform Type": "PLATFORM_TAG",
    "Application Provider Id": "PROVIDER_ID",
}
PORTAL_DEMO = "Is Demo"
PORTAL_ENVIRONMENT = "Environemnt"
PORTAL_ENVIRONMENT_PART = "clo"

# Detail snapshot: order of the flag pairs before and after the enrolment columns.
DETAIL_PAIRS_FIRST = (
    "INFO_SESSION",
    "EDI_SESSION",
    "SUT_SESSION",
    "GS_SESSION",
    "OH_SESSION",
    "HH_INFO_SESSION",
    "HH_EDI_SESSION",
    "HH_SUT_SESSION",
    "HH_GS_SESSION",
    "HH_OH_SESSION",
    "PCS_GR_SESSION",
)
DETAIL_PAIRS_LAST = ("PCS_INFO_SESSION_INPERSON", "PCS_INFO_SESSION_WEBINAR")
DETAIL_ENROLMENT = ("LEARNING_PLAN_ENROLLMENT_STATUS", "LEARNING_PLAN_ENROLLMENT_STATUS_HH")
DETAIL_TAIL = (
    "EVV_SYSTEM_CHOICE",
    "PAYERS",
    "PORTAL_CREATED",
    "PROVIDER_ID",
    "PORTAL_TYPE",
    "EVENT_DATE",
)

# Text of a missing value after the whole-table text conversion.
MISSING_TEXT = "nan"
