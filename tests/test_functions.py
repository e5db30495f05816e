from datetime import date, datetime

import pytest
from hypothesis import given, settings, strategies as st

from lienflow.functions.dates import is_before, next_office_moment, normalize_date, within_office_hours
from lienflow.functions.filings import normalize_filings
from lienflow.functions.text import (
    clean,
    normalize_filing_type,
    normalize_name,
    normalize_state,
    normalize_status,
    normalize_zip,
    question_key,
    search_key,
)

# All shapes of the third of July 2019, then others.
DATES = dict.fromkeys(
    ["2019-07-03", " 2019-07-03\t", "2019-07-03T23:59:59", "07/03/2019", "07-03-2019", "20190703", "07/03/19", "03-JUL-2019"]
    + ["03-jul-2019", "Jul 03, 2019", "7/3/2019", "2019-7-3T00:00"],
    date(2019, 7, 3),
) | {
    "": None,
    " ": None,
    "yesterday": None,
    "2019-00-10": None,
    "2019-06-31": None,
    "13/40/2019": None,
    "Abc 03, 2019": None,
    "20191130": date(2019, 11, 30),
    "20191031": date(2019, 10, 31),
    "12/31/68": date(2068, 12, 31),
    "01/01/69": date(1969, 1, 1),
    "2019-7-3": None,
    "0000-07-03": None,
    "=2019-07-03": None,
    "2019-07-03 10:00": None,
}


def test_dates(rows):
    assert dict(zip(DATES, rows(list(DATES), normalize_date("v")))) == DATES
    assert rows([None], normalize_date("v")) == [None]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.dates(date(1900, 1, 1), date(2099, 12, 31)), min_size=20, max_size=20))
def test_printed_dates_come_back(spark, days):
    shapes = ["%Y-%m-%d", "%Y-%m-%dT%H:%M:%S", "%m/%d/%Y", "%m-%d-%Y", "%Y%m%d", "%d-%b-%Y", "%b %d, %Y"]
    pairs = [(d.strftime(shape), d) for d in days for shape in shapes]
    frame = spark.createDataFrame(pairs, "v string, d date").selectExpr("v", f"{normalize_date('v')} <=> d AS same")
    assert frame.filter("NOT same").count() == 0


def test_names(rows):
    texts = ["John Doe", "  John   Doe ", "", "   ", None, "a  b"]
    assert rows(texts, normalize_name("v")) == ["John Doe", "John Doe", None, None, None, "a b"]
    assert rows(["  john   doe  "], normalize_name("v", True)) == ["JOHN DOE"]
    assert rows([" x　", "\x1c"], clean("v")) == ["x", None]


TYPES = {
    "UCC1": "UCC-1",
    "UCC-1": "UCC-1",
    "ucc 1": "UCC-1",
    "INITIAL": "UCC-1",
    "Financing Statement": "UCC-1",
    "FS": "UCC-1",
    "ORIGINAL": "UCC-1",
    "01": "UCC-1",
    "UCC1F": "UCC-1F",
    "UCC3": "UCC-3",
    "AMENDMENT": "UCC-3",
    "03": "UCC-3",
    "UCC-3F": "UCC-3F",
    "CONTINUATION": "UCC-3-CONTINUATION",
    "TERMINATION": "UCC-3-TERMINATION",
    "ASSIGNMENT": "UCC-3-ASSIGNMENT",
    "partial-assignment": "UCC-3-PARTIAL-ASSIGNMENT",
    "UCC 5": "UCC-5",
    "CORRECTION": "UCC-5",
    "05": "UCC-5",
    "FEDERAL TAX LIEN": "FEDERAL-TAX-LIEN",
    "STATE-TAX-LIEN": "STATE-TAX-LIEN",
    "IRS": "FEDERAL-TAX-LIEN",
    "something": "SOMETHING",
    "  ": None,
}


def test_filing_types(rows):
    assert dict(zip(TYPES, rows(list(TYPES), normalize_filing_type("v")))) == TYPES


def test_statuses(rows):
    texts = ["A", "L", "T", "C", "ACTIVE", "Active", "EXPIRED", "Continued", " Odd ", " ", None]
    expected = ["active", "lapsed", "terminated", "continued", "active", "active", "lapsed", "continued", "odd", None, None]
    assert rows(texts, normalize_status("v")) == expected


def test_zips(rows):
    texts = ["12345", "123456789", "12345-6789", "K1A 0B1", "1234", "1234567890", " ", None, " 12345 "]
    assert rows(texts, normalize_zip("v")) == [
        "12345", "12345-6789", "12345-6789", "K1A 0B1", "1234", "12345", None, None, "12345",
    ]


def test_states(rows):
    assert rows(["CA", " ca ", None, " "], normalize_state("v")) == ["CA", "CA", None, None]


def test_whole_record(spark):
    record = {
        "filing_number": ("A-7", "A-7"),
        "state": ("ND", "ND"),
        "filing_type": ("continuation", "UCC-3-CONTINUATION"),
        "filing_date": ("03-JUL-2019", date(2019, 7, 3)),
        "filing_status": ("l", "lapsed"),
        "debtor_name": (" acme  gmbh", "ACME GMBH"),
        "debtor_city": ("Bad  Ems ", "Bad Ems"),
        "debtor_zip": ("58501 0042", "58501-0042"),
        "secured_party_state": (" mn", "MN"),
        "amendment_type": (" As is ", " As is "),
    }
    done = normalize_filings(spark.createDataFrame([tuple(raw for raw, _ in record.values())], list(record))).first()
    assert done.asDict() == {field: value for field, (_, value) in record.items()}


def test_final_line_breaks(rows):
    assert rows(["12345\n", "12345-6789\n", "12345"], normalize_zip("v")) == ["12345", "12345-6789", "12345"]


@pytest.mark.parametrize(
    "day, since, dropped",
    [
        ("2024-01-01", "2024-06-01", True),
        ("2024-06-01", "2024-06-01", False),
        ("2024-07-01", "2024-06-01", False),
        (None, "2024-06-01", False),
        ("", "2024-06-01", False),
        ("invalid", "2024-06-01", False),
        ("2024-01-01", "invalid", False),
    ],
)
def test_since(rows, day, since, dropped):
    assert rows([day], is_before("v", f"'{since}'")) == [dropped]


def test_question_keys(rows):
    texts = ["What is the process, to register as a searcher?", "how do i", "Fee?"]
    assert rows(texts, question_key("v")) == ["process_register_as_searcher", "unknown", "fee"]


def test_search_keys(rows):
    texts = ["The Acmé Widgets, Co., Inc.", "A.C.M.E. widgets llc", "Acme  Widgets", "The", None]
    assert rows(texts, search_key("v")) == ["ACMEWIDGETS", "ACMEWIDGETS", "ACMEWIDGETS", "THE", None]


def test_office_hours(spark):
    cases = [
        ("2024-01-15 17:00:00", "America/Los_Angeles", True, "2024-01-15 17:00:00"),
        ("2024-01-15 16:59:59", "America/Los_Angeles", False, "2024-01-15 17:00:00"),
        ("2024-01-16 00:30:00", "America/Los_Angeles", True, "2024-01-16 00:30:00"),
        ("2024-01-16 00:30:01", "America/Los_Angeles", False, "2024-01-16 17:00:00"),
        ("2024-01-13 12:00:00", "America/Los_Angeles", False, "2024-01-15 17:00:00"),
        ("2024-01-13 17:00:00", "America/Los_Angeles", False, "2024-01-15 17:00:00"),
        ("2024-03-08 23:00:00", "America/New_York", False, "2024-03-11 13:00:00"),
        ("2024-01-15 17:00:00", None, False, None),
    ]
    frame = spark.createDataFrame([c[:2] for c in cases], "t string, z string").selectExpr(
        f"{within_office_hours('timestamp(t)', 'z')} AS open", f"{next_office_moment('timestamp(t)', 'z')} AS next"
    )
    expected = [(c[2], c[3] and datetime.fromisoformat(c[3])) for c in cases]
    assert [(r.open, r.next) for r in frame.collect()] == expected
