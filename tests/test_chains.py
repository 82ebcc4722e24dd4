"""Chains of pages, and pages that are broken."""

import json
import random

import campaign
import pytest
from helpers import rows
from pyspark.sql import types as T

from rosterlane import fixed_values as V
from rosterlane import schemas
from rosterlane.plans import page_account, participation_flags, webinar_participation
from rosterlane.plans.participation import ALL_SESSIONS
from rosterlane.sources import explode_records, page_chains, parse_pages, read_pages
from rosterlane.sources.pages import BROKEN

SCHEMA = "parent string, page_token string, next_page_token string"


def by_hand(pages):
    """(pages, chained, state, missing) of one parent's pages (token, next)."""
    ahead = {}
    for token, to in pages:
        ahead.setdefault((token or "").strip(), set()).add((to or "").strip())
    if any(len(to) > 1 for to in ahead.values()):
        return len(pages), None, "forked", None
    if "" not in ahead:
        return len(pages), None, "no first page", None
    at, seen = "", []
    while at not in seen:
        seen.append(at)
        (at,) = ahead[at]
        if at == "":
            state = "complete" if len(seen) == len(ahead) else "pages out of reach"
            return len(pages), len(seen), state, None
        if at not in ahead:
            return len(pages), len(seen), "hole", at
    return len(pages), None, "cycle", None


def test_chains_equal_following_them_one_by_one(spark):
    pick = random.Random(3)
    data, expected = [], []
    for n in range(120):
        parent = None if n == 0 else f"p{n}"
        size = pick.choice([1, 2, 3, 5, 8, 13, 40])
        pages = [("" if i == 0 else f"t{i}", f" t{i + 1}" if i < size - 1 else None) for i in range(size)]
        kind = pick.randrange(8)
        if kind == 1:
            pages.pop(pick.randrange(size))
        if kind == 6:
            pages.pop(0)
        if kind == 2:
            pages[-1] = (pages[-1][0], f"t{pick.randrange(1, size + 1)}")
        if kind == 3:
            pages.append(pick.choice(pages))
        if kind == 4:
            pages.append((pick.choice(pages)[0], "x"))
        if kind == 5:
            pages.append(("loose", pick.choice(["", "loose", "t1", "gone"])))
        if pages:
            expected.append((parent, *by_hand(pages)))
        data += [(parent, *page) for page in pages]
    pick.shuffle(data)
    found = page_chains(spark.createDataFrame(data, SCHEMA), ["parent"])
    assert found.columns == ["parent", "pages", "chained", "state", "missing"]
    assert rows(found) == sorted(expected, key=repr)
    assert {e[3] for e in expected} == {"complete", "hole", "cycle", "forked", "no first page", "pages out of reach"}


def test_chains_of_several_parents_and_of_none(spark):
    data = [("a", "x", None, "t"), ("a", "x", "t", ""), ("a", "y", None, "t"), (None, "x", "", "")]
    pages = spark.createDataFrame(data, "user string, `of. what` string, page_token string, next_page_token string")
    assert rows(page_chains(pages, ["user", "of. what"]), "user", "state", "missing") == [
        ("a", "complete", None), ("a", "hole", "t"), (None, "complete", None)
    ]
    assert rows(page_chains(pages.where("`of. what` = 'x' and user = 'a'"), [])) == [(2, 2, "complete", None)]
    assert page_chains(pages.where("false"), ["user"]).count() == 0


def test_long_chain(spark):
    pages = spark.range(3000).selectExpr(
        "'p' as parent", "if(id = 0, '', concat('t', id)) as page_token",
        "if(id = 2999, '', concat('t', id + 1)) as next_page_token",
    )
    assert rows(page_chains(pages, ["parent"])) == [("p", 3000, 3000, "complete", None)]


RECORD = T.StructType().add("id", "string").add("status", "string")
BAD = ['{"webinar_id": "7", "records": [{"id": "1"', '{"webinar_id": 8, "records": {"id": 1}, "x"', "<html>", '{"records": "none", "webinar_id": "9"}']


@pytest.mark.parametrize("as_text", [True, False])
def test_broken_pages_are_kept(spark, tmp_path, as_text):
    good = json.dumps({"webinar_id": "1", "records": [{"id": "a"}, {"id": "b"}]})
    lines = [good, *BAD]
    if as_text:
        df = spark.createDataFrame([(line,) for line in lines], "page string")
        pages = parse_pages(df, "page", "records", RECORD, ["webinar_id"], keep_broken=True)
    else:
        (tmp_path / "p.json").write_text("\n".join(lines))
        pages = read_pages(spark, str(tmp_path), "records", RECORD, ["webinar_id"], keep_broken=True)
    assert rows(pages.where(f"`{BROKEN}` is not null"), "webinar_id") == [("7",), ("8",), ("9",), (None,)]
    assert rows(explode_records(pages, "records", ["webinar_id"]), "webinar_id", "id") == [("1", "a"), ("1", "b")]
    assert pages.count() == 5


def read_all(spark, folder, **options):
    kinds = (
        ("catalogue", "webinars", schemas.WEBINAR, []),
        ("instances", "webinars", schemas.INSTANCE, ["webinar_id"]),
        ("participants", "participants", schemas.PARTICIPANT, ["uuid"]),
        ("registrants", "registrants", schemas.REGISTRANT, ["webinar_id"]),
        ("upcoming", "registrants", schemas.REGISTRANT, ["webinar_id"]),
    )
    return [read_pages(spark, str(folder / k), r, s, p, keep_broken=True, **options) for k, r, s, p in kinds]


def participation_of(pages):
    account = page_account(*pages)
    return webinar_participation(*pages, account=account), account


def test_only_sessions_with_broken_pages_lose_their_flags(spark, tmp_path):
    campaign.land_pages(tmp_path)
    got, account = participation_of(read_all(spark, tmp_path))
    assert rows(got) == campaign.PARTICIPATION
    assert account.where("not usable").count() == 0
    # A participant page of the first session, in a folder that names it, and a page of no session.
    target = tmp_path / "participants" / "uuid=u2"
    (target / "more.json").write_text('{"participants": [{"id"')
    stray = tmp_path / "registrants" / "webinar_id=__HIVE_DEFAULT_PARTITION__"
    stray.mkdir()
    (stray / "stray.json").write_text("<html>gone</html>")
    got, account = participation_of(read_all(spark, tmp_path))
    assert rows(got) == [r for r in campaign.PARTICIPATION if r[1] != "INFO_SESSION"]
    bad = account.where("not usable")
    assert rows(bad, "KIND", "SESSION", "BROKEN") == [("participants", "INFO_SESSION", 1), ("registrants", None, 1)]
    flags = participation_flags(got)
    assert flags.where("REGISTERED_INFO_SESSION or ATTENDED_INFO_SESSION").count() == 0


@pytest.mark.parametrize("page", ['{"webinars": [{"id": 1', '{"code": 124, "message": "expired"}'])
def test_a_broken_catalogue_leaves_no_session(spark, tmp_path, page):
    campaign.land_pages(tmp_path)
    (tmp_path / "catalogue" / "host3.json").write_text(page)
    got, account = participation_of(read_all(spark, tmp_path))
    assert got.count() == 0
    assert rows(account.where("not usable"), "KIND", "SESSION") == [("catalogue", ALL_SESSIONS)]


def test_a_lost_page_is_seen_by_its_chain(spark):
    topic = V.SESSIONS[0].topic, V.SESSIONS[1].topic
    catalogue = spark.createDataFrame(
        [([(1, topic[0]), (2, topic[1])], None, "", "h")],
        "webinars array<struct<id:bigint,topic:string>>, next_page_token string, page_token string, host string",
    )
    instances = spark.createDataFrame([([], "1")], "webinars array<struct<uuid:string>>, webinar_id string")
    participants = spark.createDataFrame([], "participants array<struct<registrant_id:string,status:string>>, uuid string")
    answer = [(V.TAX_ID_QUESTION, "123")]
    registrants = spark.createDataFrame(
        [([("a", answer)], "t", "", "1"), ([("b", answer)], "", "", "2")],
        "registrants array<struct<id:string,custom_questions:array<struct<title:string,value:string>>>>,"
        " next_page_token string, page_token string, webinar_id string",
    )
    account = page_account(catalogue, instances, participants, registrants)
    assert rows(account.where("not usable"), "KIND", "SESSION", "OPEN_CHAINS") == [("registrants", V.SESSIONS[0].suffix, 1)]
    got = webinar_participation(catalogue, instances, participants, registrants, account=account)
    assert rows(got, "SESSION") == [(V.SESSIONS[1].suffix,)]
