"""A campaign of a few providers, with landed pages, and what its report has to say."""

import json

from rosterlane import fixed_values as V
from rosterlane import schemas
from rosterlane.plans import CampaignInputs, webinar_participation
from rosterlane.sources import read_pages

TOPIC = {s.suffix: s.topic for s in V.SESSIONS}
EDI, USE, NO_SYSTEM = V.CHOICE_LABELS.values()


def provider(tax_id, name, email, wave, seq):
    row = dict.fromkeys(schemas.ROSTER.names)
    row |= {
        "Provider TAX ID": tax_id,
        "Provider Name": name,
        "Provider NPI Number": "9" if name else None,
        "Provider Email Address": email,
        "Wave": wave,
        "ingest_seq": seq,
    }
    return tuple(row.values())


ROSTER = [
    provider(" 111111111 ", "one", "one@x.org", "Home Help", 0),
    provider("222222222", "two", "  ", "Home Health", 1),
    provider("222222222", "two again", None, "PCS", 2),
    provider("333333333", "three", None, "PCS", 3),
    provider("333333333", "three copied", "late@x.org", "PCS", 4),
    provider("044444444", "four", "four@x.org", "Home Help", 5),
    provider(None, "nobody", None, "PCS", 6),
    provider("555555555\t", None, "", "Home Health", 7),
]

FORM = [
    # One submitter over three rows: ids and choice are filled among them.
    (1, None, None, None, 0),
    (1, 111111111, 77, EDI, 1),
    (1, None, None, NO_SYSTEM, 2),
    # Two submitters for the same id with different choices.
    (2, 222222222, None, USE, 3),
    (3, 222222222, None, NO_SYSTEM, 4),
    # The id lost its leading zero, so the roster's id does not match.
    (4, 44444444, None, EDI, 5),
    # Rows without submitter belong to no group: they lose even their own values, and go away.
    (None, None, None, EDI, 6),
    (None, 333333333, None, EDI, 7),
    # A form without a choice.
    (5, 555555555, None, None, 8),
]

PAYERS = [
    ("111-111111", "Payer B", "Home Help"),
    ("111111111", "Payer A", "Home Help"),
    (" 111111111", "Payer B", "Home Help"),
    ("222222222", "Payer C", "PCS"),
    ("222222222", "Payer C", "Home Health"),
    ("333333333", "Payer D", "PCS"),
    (None, "Payer E", "PCS"),
]

ACCOUNT = [("A2", "222222222 "), ("A3", "333333333"), ("A1", "111111111"), ("A5", "555555555")]
CONTACT = [
    ("A2", "Nurse", "nurse@crm.org"),
    ("A2", "Lead Coordinator", "coordinator@crm.org"),
    ("A2", "Operations", None),
    ("A3", "Owner", "owner@crm.org"),
    ("A3", "Owner", "boss@crm.org"),
    ("A3", "Administrator", None),
    ("A1", "Administrator", "unused@crm.org"),
    ("A5", None, "norole@crm.org"),
]

ENROLMENTS = [
    ("111111111", V.PLAN_HELP, "In Progress", 5),
    ("111111111", V.PLAN_HELP, "Completed", 2),
    ("222222222", V.PLAN_HEALTH, "Enrolled", 1),
    ("222222222", V.PLAN_HELP, "Completed", 3),
    ("333333333", "Another Plan", "Completed", 0),
    (None, V.PLAN_HEALTH, "Completed", 4),
]

ENGAGEMENTS = [
    ("Lansing MI Roadshow", "event-registration", "333-333333"),
    ("lansing mi roadshow 2", "event-attendance", "222222222"),
    ("Another event", "event-attendance", "111111111"),
    ("Lansing MI Roadshow", "email-open", "111111111"),
    ("Lansing MI Roadshow", "event-registration", None),
]

PORTALS = [
    ("222222222", "Free", 21, "FALSE", "US Cloud", 4),
    ("222222222", "Paid", 22, "FALSE", "US Cloud", 1),
    ("111111111", "Paid", 11, "TRUE", "US Cloud", 2),
    ("333333333", "Paid", 31, "FALSE", "Legacy", 3),
    (None, "Paid", 99, "FALSE", "US Cloud", 0),
]

# Webinars per topic; some topics only nearly match.
CATALOGUE = [
    {"id": 100, "topic": TOPIC["INFO_SESSION"]},
    {"id": 101, "topic": TOPIC["INFO_SESSION"]},
    {"id": 102, "topic": TOPIC["INFO_SESSION"] + " "},
    {"id": 200, "topic": TOPIC["HH_EDI_SESSION"]},
    {"id": 201, "topic": TOPIC["HH_EDI_SESSION"].strip()},
    {"id": 300, "topic": "\t" + TOPIC["PCS_INFO_SESSION_WEBINAR"] + " "},
    {"id": 400, "topic": TOPIC["PCS_GR_SESSION"]},
    {"id": 500, "topic": "Something else"},
]
INSTANCES = {100: ["u/1==", "u2"], 101: ["u3"], 200: ["u4"], 300: ["u5"], 201: ["u6"], 500: ["u7"]}
PARTICIPANTS = {
    "u/1==": [("r1", "in_meeting"), ("r1", "in_waiting_room"), ("r2", "in_waiting_room")],
    "u2": [("walk-in", "in_meeting"), (None, "in_meeting")],
    "u3": [("r3", "in_meeting")],
    "u4": [("r4", "in_meeting"), ("r9", "in_meeting")],
    "u5": [("r5", "in_meeting")],
    "u6": [("r6", "in_meeting")],
    "u7": [("r7", "in_meeting")],
}
QUESTION = V.TAX_ID_QUESTION
# (registrant, answers) per webinar, of past occurrences and of webinars still to come.
REGISTRANTS = {
    100: [
        ("r1", [("Agency", "x"), (QUESTION, "old"), (QUESTION, "111-111 111")]),
        ("r2", [(QUESTION, "222222222")]),
        ("r0", None),
        ("r8", []),
    ],
    101: [("r3", [(QUESTION, " 333333333")])],
    102: [("r3", [(QUESTION, "044444444")])],
    200: [("r4", [(QUESTION, "444444444")]), ("r10", [(QUESTION, "044444444")])],
    201: [("r6", [(QUESTION, "111111111")])],
    300: [("r5", [(QUESTION, "333333333")]), ("r9", [(QUESTION, "222222222")])],
    500: [("r7", [(QUESTION, "111111111")])],
}
UPCOMING = {
    100: [("r11", [(QUESTION, "555-55-5555")])],
    400: [("r1", [(QUESTION, "111111111")])],
}


def land(folder, parent, key, *pages):
    target = folder / f"{parent}={str(key).replace('/', '%2F')}"
    target.mkdir(parents=True)
    (target / "pages.json").write_text("\n".join(map(json.dumps, pages)))


def registrant(entry):
    key, answers = entry
    record = {"id": key, "status": "approved"}
    if answers is not None:
        record["custom_questions"] = [{"title": t, "value": v} for t, v in answers]
    return record


def land_pages(folder):
    """Write the pages as the service would have answered them, two records per page."""
    (folder / "catalogue").mkdir(parents=True)
    (folder / "catalogue" / "host1.json").write_text(
        json.dumps({"webinars": CATALOGUE[:5], "next_page_token": "t"})
        + "\n"
        + json.dumps({"webinars": CATALOGUE[5:]})
    )
    (folder / "catalogue" / "host2.json").write_text(json.dumps({"webinars": CATALOGUE[:1]}))
    for webinar, uuids in INSTANCES.items():
        page = {"webinars": [{"uuid": u} for u in uuids]}
        land(folder / "instances", "webinar_id", webinar, page)
    land(folder / "instances", "webinar_id", 400, {"code": 3001})
    for uuid, people in PARTICIPANTS.items():
        records = [{"id": f"p{i}", "registrant_id": r, "status": s} for i, (r, s) in enumerate(people)]
        pages = [{"participants": records[i : i + 2]} for i in range(0, len(records), 2)]
        land(folder / "participants", "uuid", uuid, *pages)
    for name, groups in (("registrants", REGISTRANTS), ("upcoming", UPCOMING)):
        for webinar, entries in groups.items():
            pages = [{"registrants": [registrant(e)]} for e in entries]
            land(folder / name, "webinar_id", webinar, *pages)


def pages(spark, folder):
    def read(name, records, record, *parents):
        return read_pages(spark, str(folder / name), records, record, parents)

    return (
        read("catalogue", "webinars", schemas.WEBINAR),
        read("instances", "webinars", schemas.INSTANCE, "webinar_id"),
        read("participants", "participants", schemas.PARTICIPANT, "uuid"),
        read("registrants", "registrants", schemas.REGISTRANT, "webinar_id"),
        read("upcoming", "registrants", schemas.REGISTRANT, "webinar_id"),
    )


def inputs(spark, folder, parts=1):
    def table(values, schema):
        return spark.createDataFrame(values, schema).repartition(parts)

    return CampaignInputs(
        roster=table(ROSTER, schemas.ROSTER),
        form=table(FORM, schemas.FORM),
        payers=table(PAYERS, schemas.PAYERS),
        contact=table(CONTACT, schemas.CONTACT),
        account=table(ACCOUNT, schemas.ACCOUNT),
        participation=webinar_participation(*pages(spark, folder)),
        enrolments=table(ENROLMENTS, schemas.ENROLMENT),
        engagements=table(ENGAGEMENTS, schemas.ENGAGEMENT),
        portal_dim=table(PORTALS, schemas.PORTAL),
    )


PARTICIPATION = [
    ("044444444", "HH_EDI_SESSION", True, False),
    ("111111111", "INFO_SESSION", True, True),
    ("111111111", "PCS_GR_SESSION", True, False),
    ("222222222", "INFO_SESSION", True, False),
    ("222222222", "PCS_INFO_SESSION_WEBINAR", True, False),
    ("333333333", "INFO_SESSION", True, True),
    ("333333333", "PCS_INFO_SESSION_WEBINAR", True, True),
    ("444444444", "HH_EDI_SESSION", True, True),
    ("555555555", "INFO_SESSION", True, False),
]

# (wave, id) -> email, true flags, status, help status, choice, payers, portal, portal id and type.
MISSING, NONE = V.MISSING_FORM, "Not Registered"
INFO = "REGISTERED_INFO_SESSION"
DETAIL = {
    ("Home Help", "111111111"): (
        "one", "one@x.org", {INFO, "ATTENDED_INFO_SESSION", "REGISTERED_PCS_GR_SESSION"},
        NONE, "Completed", EDI, "Payer A, Payer B", "False", None, None,
    ),
    ("Home Health", "222222222"): (
        "two", "coordinator@crm.org",
        {INFO, "REGISTERED_PCS_INFO_SESSION_WEBINAR", "ATTENDED_PCS_INFO_SESSION_INPERSON"},
        "Enrolled", "Completed", USE, "nan", "True", 22, "Paid",
    ),
    ("PCS", "222222222"): (
        "two again", "coordinator@crm.org",
        {INFO, "REGISTERED_PCS_INFO_SESSION_WEBINAR", "ATTENDED_PCS_INFO_SESSION_INPERSON"},
        "Enrolled", "Completed", USE, "nan", "True", 22, "Paid",
    ),
    ("PCS", "333333333"): (
        "three", "boss@crm.org",
        {
            INFO, "ATTENDED_INFO_SESSION", "REGISTERED_PCS_INFO_SESSION_WEBINAR",
            "ATTENDED_PCS_INFO_SESSION_WEBINAR", "REGISTERED_PCS_INFO_SESSION_INPERSON",
        },
        NONE, NONE, MISSING, "Payer D", "False", None, None,
    ),
    ("Home Help", "044444444"): (
        "four", "four@x.org", {"REGISTERED_HH_EDI_SESSION"},
        NONE, NONE, MISSING, "nan", "False", None, None,
    ),
    ("PCS", "nan"): ("nobody", "nan", set(), NONE, NONE, MISSING, "nan", "False", None, None),
    ("Home Health", "555555555"): (
        "nan", "", {INFO}, NONE, NONE, MISSING, "nan", "False", None, None,
    ),
}

# Counts that are not zero. The null id is not counted; the id with two forms counts under both.
TREND = {
    "PROVIDER_COUNT": 5,
    "HH_PROVIDER_COUNT": 2,
    "HEALTH_PROVIDER_COUNT": 2,
    "COMPLETED_ONBOARDING_FORM": 2,
    "REGISTERED_INFO_SESSION": 4,
    "ATTENDED_INFO_SESSION": 2,
    "REGISTERED_HH_EDI_SESSION": 1,
    "REGISTERED_PCS_GR_SESSION": 1,
    "REGISTERED_PCS_INFO_SESSION_WEBINAR": 2,
    "ATTENDED_PCS_INFO_SESSION_WEBINAR": 1,
    "REGISTERED_PCS_INFO_SESSION_INPERSON": 1,
    "ATTENDED_PCS_INFO_SESSION_INPERSON": 1,
    **dict.fromkeys(V.CHOICE_LABELS, 1),
    "LMS_NOTREGISTERED": 4,
    "LMS_ENROLLED": 1,
    "LMS_HH_NOTREGISTERED": 3,
    "LMS_HH_COMPLETED": 2,
    "HEALTH_PORTALS_CREATED": 1,
    "PCS_PORTALS_CREATED": 1,
    "PORTALS_CREATED": 1,
}
