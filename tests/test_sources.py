import json

import pytest
from helpers import plan, rows
from pyspark.sql import types as T

from rosterlane import schemas
from rosterlane.sources import (
    crm_contacts,
    explode_records,
    inperson_engagements,
    learning_enrolments,
    parse_pages,
    portals,
    read_pages,
    read_table,
)

RECORD = T.StructType().add("id", "string").add("status", "string")


def land(folder, name, *pages):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(page) for page in pages))


def test_pages_of_a_folder_with_parents_in_the_path(spark, tmp_path):
    land(
        tmp_path / "uuid=a%2Fb==",
        "1.json",
        {"participants": [{"id": "1", "status": "in_meeting"}, {"id": "2"}], "next_page_token": "t"},
        {"participants": [{"id": "1", "status": "in_meeting"}], "next_page_token": ""},
    )
    land(tmp_path / "uuid=007", "1.json", {"next_page_token": ""}, {"participants": []})
    pages = read_pages(spark, str(tmp_path), "participants", RECORD, ["uuid"])
    got = explode_records(pages, "participants", ["uuid"])
    assert got.columns == ["uuid", "id", "status"]
    assert rows(got) == [
        ("a/b==", "1", "in_meeting"),
        ("a/b==", "1", "in_meeting"),
        ("a/b==", "2", None),
    ]
    outer = explode_records(pages, "participants", ["uuid"], outer=True)
    assert rows(outer)[:2] == [("007", None, None), ("007", None, None)]


def test_pages_with_parents_in_the_body_and_over_several_lines(spark, tmp_path):
    page = {"webinar_id": "0012", "registrants": [{"id": "x", "status": "approved"}]}
    (tmp_path / "page.json").write_text(json.dumps(page, indent=2))
    pages = read_pages(
        spark, str(tmp_path), "registrants", RECORD, ["webinar_id"], multi_line=True
    )
    assert rows(explode_records(pages, "registrants", ["webinar_id"])) == [
        ("0012", "x", "approved")
    ]


def test_broken_page_raises(spark, tmp_path):
    (tmp_path / "page.json").write_text('{"registrants": [')
    pages = read_pages(spark, str(tmp_path), "registrants", RECORD)
    with pytest.raises(Exception, match="MALFORMED|Malformed|FAILED_READ_FILE"):
        explode_records(pages, "registrants").collect()


def test_pages_in_a_text_column(spark):
    text = [(json.dumps({"webinar_id": "1", "records": [{"id": "a"}, {"id": "b"}]}),), ("{}",)]
    df = spark.createDataFrame(text, "page string")
    pages = parse_pages(df, "page", "records", RECORD, ["webinar_id"])
    got = explode_records(pages, "records", ["webinar_id"])
    assert rows(got, "webinar_id", "id") == [("1", "a"), ("1", "b")]


def test_sheet_as_csv_keeps_ids_as_text(spark, tmp_path):
    names = schemas.PAYERS.names
    (tmp_path / "payers.csv").write_text(f"{','.join(names)}\n001,A,PCS\n,B,PCS\n")
    assert rows(read_table(spark, str(tmp_path), schemas.PAYERS, "csv")) == [
        ("001", "A", "PCS"),
        (None, "B", "PCS"),
    ]


def test_sheet_that_does_not_fit_raises(spark, tmp_path):
    header = ",".join(f'"{name}"' for name in schemas.FORM.names)
    (tmp_path / "form.csv").write_text(f"{header}\nx,1,2,c,3\n")
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ_FILE"):
        read_table(spark, str(tmp_path), schemas.FORM, "csv").collect()


SHEET = T.StructType().add("id", "string").add("n", "long").add("note", "string")


@pytest.mark.parametrize("line_breaks", [False, True])
def test_sheets_are_bound_by_their_own_header(spark, tmp_path, line_breaks):
    """Every file in its own layout; a file name with signs that mean something in paths and URLs."""
    (tmp_path / "a.csv").write_text("id,n,note\n001,1,x\n")
    (tmp_path / "b [1] +%20.csv").write_text('note,"n","id",more\n"a, ""b""",2,002,zzz\n')
    (tmp_path / "c.csv").write_text("\ufeffid\r\n003\r\n")
    (tmp_path / "d.csv").write_text("n,id,n,,\n4,004,not a number,,\n")
    (tmp_path / "e.csv").write_text("")
    (tmp_path / "f.csv").write_text("ID,N\n005,5\n")
    (tmp_path / "g.csv").write_text("note,n,id\n")
    read = read_table(spark, str(tmp_path), SHEET, "csv", line_breaks)
    assert read.columns == ["id", "n", "note"]
    assert rows(read) == sorted(
        [("001", 1, "x"), ("002", 2, 'a, "b"'), ("003", None, None), ("004", 4, None), (None, None, None)], key=repr
    )
    assert rows(read.where("n > 1"), "id") == [("002",), ("004",)]


def test_sheet_with_line_breaks_in_its_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text('"no\nte",id,n\n"x\ny",1,2\n')
    read = read_table(spark, str(tmp_path), T.StructType().add("no\nte", "string").add("n", "long"), "csv", True)
    assert rows(read) == [("x\ny", 2)]


def test_required_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,n\n1,2\n")
    (tmp_path / "b.csv").write_text("n,note\n1,2\n")
    assert read_table(spark, str(tmp_path), SHEET, "csv", required=["n"]).count() == 2
    with pytest.raises(ValueError, match="no column id"):
        read_table(spark, str(tmp_path), SHEET, "csv", required=["id"])
    spark.range(1).write.parquet(str(tmp_path / "t"))
    with pytest.raises(ValueError, match="no column n"):
        read_table(spark, str(tmp_path / "t"), SHEET, required=["id", "n"])


def test_extra_columns_are_not_parsed(spark, tmp_path):
    (tmp_path / "a.csv").write_text("more,id,n\nx,1,2\n")
    read = read_table(spark, str(tmp_path), SHEET, "csv").select("id")
    assert "ReadSchema: struct<id:string>" in plan(read) and rows(read) == [("1",)]


def test_sheets_without_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    read = read_table(spark, str(tmp_path), SHEET, "csv")
    assert read.schema == SHEET and read.count() == 0


def test_enrolments_are_filtered_by_the_scan(spark, tmp_path):
    data = [("1", "A", "Enrolled", 0), ("2", "C", "Enrolled", 1), (None, "B", "Completed", 2)]
    spark.createDataFrame(data, schemas.ENROLMENT).write.parquet(str(tmp_path / "t"))
    table = read_table(spark, str(tmp_path / "t"), schemas.ENROLMENT)
    got = learning_enrolments(table, ("A", "B"))
    assert rows(got, "AGENCY_TAX_ID") == [("1",)]
    text = plan(got.select("AGENCY_TAX_ID"))
    assert "In(LEARNING_PLAN_NAME, [A,B])" in text and "IsNotNull(AGENCY_TAX_ID)" in text
    assert "LEARNING_PLAN_ENROLLMENT_STATUS" not in text


def test_engagements(spark):
    data = [("My MI Roadshow 1", "event-registration", "1-2 3"), ("Roadshow", "x", "4"), (None, "x", "5")]
    df = spark.createDataFrame(data, schemas.ENGAGEMENT)
    assert rows(inperson_engagements(df), "TAX_ID") == [("123",)]


def test_portals(spark):
    data = [
        ("1", "Paid", 10, "FALSE", "US-CLOUD", 0),
        ("2", "Paid", 11, "TRUE", "Cloud", 1),
        ("3", "Free", 12, "FALSE", "Legacy", 2),
        ("4", "Free", 13, None, "Cloud", 3),
    ]
    got = portals(spark.createDataFrame(data, schemas.PORTAL))
    assert got.columns == ["TAX_ID", "PLATFORM_TAG", "PROVIDER_ID", "ingest_seq"]
    assert rows(got) == [("1", "Paid", 10, 0)]


def test_contacts_of_accounts(spark):
    contact = spark.createDataFrame(
        [("a", "Owner", "o@"), ("a", None, "n@"), ("a", "Owner", None), ("b", "Owner", "b@"), ("x", "Owner", "x@")],
        schemas.CONTACT,
    )
    account = spark.createDataFrame([("a", " 1 "), ("b", "2"), ("c", None)], schemas.ACCOUNT)
    ids = spark.createDataFrame([("1",), ("1",), (None,)], "id string")
    got = crm_contacts(contact, account, ids, "id")
    assert rows(got) == [("1", "Owner", "o@"), ("1", None, "n@")]
    assert rows(crm_contacts(contact, account, ids.where("false"), "id")) == []
