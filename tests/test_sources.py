import json

import pytest
from pyspark.sql import functions as F

from lienflow.sources import delimited, dimension, fixed_width, json_feeds, landing, logs, three_files, xml_feeds
from lienflow.sources.records import split_keyed


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def keyed(records):
    return split_keyed(records)[0].orderBy("filing_number").collect()


KY = (
    "﻿FileNumber,FilingType,FileDate,LapseDate,Status,DebtorName,DebtorAddress,DebtorCity,DebtorState,DebtorZip,"
    "SecuredPartyName,SecuredPartyAddress,SecuredPartyCity,SecuredPartyState,SecuredPartyZip,Extra\n"
)


def test_csv(spark, tmp_path):
    text = KY + 'KY-1,UCC-1,01/15/2024,,A,"DOE, ""JD"" JOHN",1 Main,Frankfort,KY,40601,BANK,2 Elm,Lou,KY,40202,x\n'
    text += " ,UCC-1,,,,,,,,,,,,,,\nKY-2, \n"
    path = put(tmp_path / "ky.csv", text)
    first, second = keyed(delimited.read_delimited(spark, path, "KY"))
    assert (first.filing_number, first.state, first.debtor_name) == ("KY-1", "KY", 'DOE, "JD" JOHN')
    assert first.lapse_date is None and first.source_tier == "state_bulk"
    assert json.loads(first.source_raw)["Extra"] == "x" and json.loads(first.source_raw)["LapseDate"] is None
    assert (second.filing_type, second.debtor_name) == ("UCC", None)
    _, rejects = split_keyed(delimited.read_delimited(spark, path, "KY"))
    assert [r.reject_reason for r in rejects.collect()] == ["missing_filing_number"]


def test_csv_line_breaks_and_header_orders(spark, tmp_path):
    put(tmp_path / "in" / "a.csv", 'FileNumber,FilingType,DebtorName,DebtorAddress\nK1,UCC1,DOE,"1 Main\nSuite 2"\n')
    put(tmp_path / "in" / "b.csv", "DebtorName,FileNumber,FilingType\nROE,K2,UCC3\n")
    one, two = keyed(delimited.read_delimited(spark, str(tmp_path / "in"), "KY"))
    assert (one.filing_number, one.debtor_address) == ("K1", "1 Main\nSuite 2")
    assert (two.filing_number, two.filing_type, two.debtor_name, two.debtor_address) == ("K2", "UCC3", "ROE", None)


def test_three_files(spark, tmp_path):
    put(tmp_path / "WV" / "documents.csv", "DocNumber,DocType,FileDate\nW1,UCC1,01/15/2024\nW2,UCC3,\n")
    put(tmp_path / "WV" / "debtors.csv", "DocNumber,Debtor Name,Debtor City\nW1,FIRST,A\nW1,SECOND,B\n")
    put(tmp_path / "WV" / "secured_parties.csv", "DocNumber,Name,Zip\nW2,BANK,25301\n")
    one, two = keyed(landing.read_feed(spark, "WV", str(tmp_path / "WV")))
    assert (one.debtor_name, one.debtor_city, one.secured_party_name) == ("FIRST", "A", None)
    assert (two.debtor_name, two.secured_party_name, two.secured_party_zip) == (None, "BANK", "25301")
    parties = three_files.three_file_parties(spark, str(tmp_path / "WV"), "WV").orderBy("filing_number", "party_no").collect()
    assert [(p.filing_number, p.role, p.party_no, p.name) for p in parties] == [
        ("W1", "debtor", 0, "FIRST"),
        ("W1", "debtor", 1, "SECOND"),
        ("W2", "secured_party", 0, "BANK"),
    ]


def test_tab_delimited(spark, tmp_path):
    path = put(tmp_path / "id.tsv", "FileNumber\tFileType\tDebtorName\nI1\tUCC1\tA B\n\tUCC1\tC\n")
    assert [(r.filing_number, r.debtor_name) for r in keyed(landing.read_feed(spark, "ID", path))] == [("I1", "A B")]


def test_headers_by_pattern(spark, tmp_path):
    headers = "File Num,Filing Number,doc-type,Filing Date,Lapse,Status,Name of Debtor,Secured Name,Collateral Text\n"
    path = put(tmp_path / "x.csv", headers + ",F1,fs,2024-01-01,2029-01-01,A,N1,S1,all\nF2,F3,,,,,,,\n")
    one, two = keyed(delimited.read_delimited(spark, path, "VT"))
    assert (one.filing_number, one.filing_type, one.debtor_name, one.collateral_description) == ("F1", "fs", "N1", "all")
    assert (one.filing_status, one.lapse_date, one.secured_party_name) == ("A", "2029-01-01", "S1")
    assert (two.filing_number, two.filing_type) == ("F2", "UCC")
    spelt = ["filing_no", "FileType", "filingdate", "file-number"]
    assert delimited.match_headers(spelt) == {
        "filing_number": ["filing_no", "file-number"],
        "filing_type": ["FileType"],
        "filing_date": ["filingdate"],
    }


def test_arrival_keeps_file_order(spark, tmp_path):
    lines = "".join(f"{i}\n" for i in range(5000))
    put(tmp_path / "in" / "b.txt", lines)
    put(tmp_path / "in" / "a.txt", lines)
    from lienflow.sources.records import ARRIVAL

    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        found = spark.read.text(str(tmp_path / "in")).selectExpr("int(value) AS v", ARRIVAL)
        ordered = found.filter("arrival.file LIKE '%a.txt'").orderBy("arrival").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r.v for r in ordered] == list(range(5000))


TX = {"filing_number": "T1", "filing_type": "UCC-1", "file_date": "2024-01-15", "unmapped": {"a": [1]}}


def test_json_shapes(spark, tmp_path):
    shapes = {
        "array": [TX, {"filing_number": "T2"}],
        "records": {"records": [TX]},
        "filings": {"meta": 1, "filings": [TX]},
        "single": TX,
    }
    counts = {"array": 2, "records": 1, "filings": 1, "single": 1}
    for name, document in shapes.items():
        path = put(tmp_path / f"{name}.json", json.dumps(document, indent=1))
        found = keyed(json_feeds.read_bulk_documents(spark, path, "TX"))
        assert len(found) == counts[name]
        assert (found[0].filing_number, found[0].filing_date) == ("T1", "2024-01-15")
        assert json.loads(found[0].source_raw) == TX


def test_json_lines_and_empty_values(spark, tmp_path):
    records = [
        {"filing_number": "0", "filing_type": 0, "status": False, "debtor_name": "  ", "debtor_zip": 40601},
        {"filing_number": 0},
        {"filing_number": None},
        {"filing_number": 17, "collateral": []},
    ]
    path = put(tmp_path / "tx.jsonl", "".join(json.dumps(r) + "\n" for r in records))
    zero, number = keyed(json_feeds.read_bulk_lines(spark, path, "TX"))
    assert (zero.filing_number, zero.filing_type, zero.filing_status, zero.debtor_zip) == ("0", "UCC", None, "40601")
    assert (zero.debtor_name, number.filing_number, number.collateral_description) == (None, "17", None)


def test_open_data(spark, tmp_path):
    pages = [
        {"id_ucc_flng_nbr": "C1", "cd_flng_type": "ORIG", "dt_accept": "2024-01-15T00:00:00.000", "tx_lien_descript": "x"},
        {"id_lien_flng_nbr": "C2", "documenttype": "FTL"},
        {":id": "row-3"},
        {"debtor_nm_bus": "NO NUMBER"},
    ]
    path = put(tmp_path / "ct.json", json.dumps(pages))
    found = keyed(landing.read_feed(spark, "CT", path))
    assert [(r.filing_number, r.filing_type) for r in found] == [("C1", "ORIG"), ("C2", "FTL"), ("row-3", "UCC")]
    assert (found[0].filing_date, found[0].collateral_description, found[0].source_tier) == ("2024-01-15", "x", "open_api")
    path = put(tmp_path / "co.json", json.dumps([{"transactionid": 5, "filingtype": "F", "documenttype": "D", "masterdocumentid": "M"}]))
    (row,) = keyed(landing.read_feed(spark, "CO", path))
    assert (row.filing_number, row.filing_type, row.collateral_description, row.original_filing_number) == ("5", "F", None, "M")


def test_commercial(spark, tmp_path):
    nested = {
        "fileNumber": "N1",
        "debtor": {"organizationName": "ORG", "streetAddress": "1 St", "postalCode": "1"},
        "securedParty": {"name": "BANK", "city": "X"},
        "filed_date": "2024-02-01T10:00:00Z",
    }
    flat = {"filing_number": "", "documentNumber": "N2", "debtor": "PLAIN", "secured_party": "SP", "type": "UCC3"}
    for provider, envelope in [("baselayer", "data"), ("fcs", "filings"), ("lexisnexis", "Records"), ("other", "results")]:
        path = put(tmp_path / f"{provider}.json", json.dumps({envelope: [nested, flat, {"debtor": "NO NUMBER"}]}))
        one, two = keyed(json_feeds.read_commercial(spark, path, "AL", provider))
        assert (one.filing_number, one.debtor_name, one.debtor_address, one.debtor_zip) == ("N1", "ORG", "1 St", "1")
        assert (one.secured_party_name, one.secured_party_city, one.filing_date) == ("BANK", "X", "2024-02-01")
        assert (two.filing_number, two.debtor_name, two.secured_party_name, two.filing_type) == ("N2", "PLAIN", "SP", "UCC3")
    path = put(tmp_path / "wrong.json", json.dumps({"records": [flat]}))
    (lost,) = split_keyed(json_feeds.read_commercial(spark, path, "AL", "baselayer"))[1].collect()
    assert lost.reject_reason == "unreadable_document"


def test_xml(spark, tmp_path):
    text = """<?xml version="1.0"?><Root>
    <Filing><FileNumber>X1</FileNumber><FileType>UCC-1</FileType><FileDate>2024-01-15T00:00</FileDate><New>n</New>
      <Debtor><Name>JOHN</Name><OrganizationName>ORG</OrganizationName><City>LA</City><State>CA</State></Debtor>
      <Debtor><OrganizationName>SECOND</OrganizationName><PostalCode>9</PostalCode></Debtor>
      <SecuredParty><OrganizationName>BANK</OrganizationName></SecuredParty></Filing>
    <Filing><TransactionNumber>X2</TransactionNumber><CollateralDescription>all</CollateralDescription></Filing>
    <Filing><FileType>no number</FileType></Filing></Root>"""
    path = put(tmp_path / "ca.xml", text)
    one, two = keyed(xml_feeds.read_xml(spark, path, "CA"))
    assert (one.filing_number, one.filing_date, one.debtor_name, one.debtor_city) == ("X1", "2024-01-15", "JOHN", "LA")
    assert one.secured_party_name == "BANK" and '"xs_any":["n"]' in one.source_raw
    assert (two.filing_number, two.filing_type, two.collateral_description) == ("X2", "UCC", "all")
    parties = xml_feeds.xml_parties(xml_feeds.scan_xml(spark, path), "CA").orderBy("role", "party_no").collect()
    assert [(p.role, p.party_no, p.name, p.zip) for p in parties] == [
        ("debtor", 0, "JOHN", None),
        ("debtor", 1, "SECOND", "9"),
        ("secured_party", 0, "BANK", None),
    ]


def test_xml_row_tags(spark, tmp_path):
    filing, document = "<Filing><FileNumber>1</FileNumber></Filing>", "<Document><FileNumber>2</FileNumber></Document>"
    path = put(tmp_path / "d.xml", f"<Root>{document}</Root>")
    assert [r.filing_number for r in keyed(xml_feeds.read_xml(spark, path, "IN"))] == ["2"]
    mixed = put(tmp_path / "m.xml", f"<Root>{document}{filing}</Root>")
    in_order = split_keyed(xml_feeds.read_xml(spark, mixed, "IN"))[0].orderBy("arrival").collect()
    assert [r.filing_number for r in in_order] == ["2", "1"]
    assert [r.filing_number for r in keyed(xml_feeds.read_xml(spark, mixed, "IN", "Filing"))] == ["1"]


def test_mixed_xml_rows(spark, tmp_path):
    """Rows of three kinds in the order of the document, over many splits, with a namespace, attributes and line breaks."""
    kinds = ["Filing", "Filing", "Document", "FinancingStatement", "Filing", "Document"]
    rows = [
        f'<u:{kind} n="{i}">\n <u:FileNumber>{i}</u:FileNumber><u:Debtor><u:Name>a &amp; b</u:Name></u:Debtor><u:Debtor><u:Name>c{i}</u:Name></u:Debtor>\n</u:{kind}>'
        for i, kind in enumerate(kinds * 60)
    ]
    path = put(tmp_path / "all.xml", '<?xml version="1.0"?><u:Root xmlns:u="http://x/1">' + "\n".join(rows) + "</u:Root>")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        scanned = xml_feeds.scan_xml(spark, path)
        found = split_keyed(xml_feeds.map_xml(scanned, "IN"))[0].orderBy("arrival").collect()
        assert scanned.rdd.getNumPartitions() > 5
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r.filing_number for r in found] == [str(i) for i in range(len(rows))]
    assert {r.debtor_name for r in found} == {"a & b"}
    assert xml_feeds.xml_parties(scanned, "IN").count() == 2 * len(rows)


def test_xml_namespace(spark, tmp_path):
    body = '<i:Root xmlns:i="http://x/4"><i:Filing><i:FilingNumber>I1</i:FilingNumber><i:FilingType>UCC1</i:FilingType></i:Filing></i:Root>'
    assert [r.filing_number for r in keyed(xml_feeds.read_xml(spark, put(tmp_path / "in.xml", body), "IN"))] == ["I1"]


def test_fixed_width(spark, tmp_path):
    line = "FL-1".ljust(15) + "UCC1".ljust(5) + "2024-01-15" + "2029-01-15" + "A".ljust(5) + "DOE JOHN".ljust(100)
    whole = line + "1 MAIN".ljust(100) + "MIAMI".ljust(50) + "FL" + "33101".ljust(10) + "BANK".ljust(262)
    path = put(tmp_path / "fl.dat", f"HEADER\n{whole}\n{line}\n{' ' * 15}{line[15:]}\n")
    one, two = keyed(fixed_width.read_fixed_width(spark, path))
    assert (one.filing_number, one.filing_status, one.debtor_city, one.debtor_zip) == ("FL-1", "A", "MIAMI", "33101")
    assert one.secured_party_name == "BANK" and one.secured_party_zip is None
    assert (two.debtor_name, two.debtor_city) == ("DOE JOHN", None)


def test_landed_files(spark, tmp_path):
    for name in ("TX/a.json", "TX/2024-01-15/b.json", "TX/c.json.tmp", "TX/.d", "TX/_tmp/e.json", "f.json", "state=CA/g.json"):
        put(tmp_path / name, "[]")
    found = {(r.state, r.delivery, r.path.rsplit("/", 1)[-1]) for r in landing.landed_files(spark, str(tmp_path)).collect()}
    assert found == {("TX", "", "a.json"), ("TX", "2024-01-15", "b.json"), ("CA", "", "g.json")}


def test_new_files_and_newest_delivery(spark):
    files = spark.createDataFrame(
        [("TX", "1", "a", 100), ("TX", "2", "b", 200), ("TX", "2", "c", 300), ("CA", "1", "d", 50)],
        "state string, delivery string, path string, t long",
    ).selectExpr("state", "delivery", "path", "timestamp_seconds(t) AS landed_at")
    # Read before, written anew since, never seen whatever its time.
    ledger = spark.createDataFrame([("a", 1, 100), ("b", 1, 150), ("c", 2, 300)], "path string, size long, t long")
    ledger = ledger.selectExpr("path", "size", "timestamp_seconds(t) AS landed_at")
    files = files.withColumn("size", F.lit(1).cast("long"))
    assert {r.path for r in landing.new_files(files, ledger).collect()} == {"b", "c", "d"}
    assert {r.path for r in landing.newest_delivery(files).collect()} == {"b", "c", "d"}
    assert landing.phase_files(["x/master.json", "x/day.json"], True) == ["x/master.json"]
    assert landing.phase_files(["x/master.json", "x/day.json"], False) == ["x/day.json"]
    assert landing.phase_files(["x/day.json"], True) == ["x/day.json"]


def test_two_phases(spark, tmp_path):
    master = put(tmp_path / "m.json", json.dumps([{"filing_number": "1", "file_date": "01/15/2020"}]))
    update = put(
        tmp_path / "u.json",
        json.dumps([{"filing_number": str(n), "file_date": d} for n, d in enumerate(["01/14/2024", "01/15/2024", "soon"])]),
    )
    assert [r.filing_number for r in keyed(landing.read_two_phase(spark, "TX", master, update, None))] == ["1"]
    assert [r.filing_number for r in keyed(landing.read_two_phase(spark, "TX", master, update, "2024-01-15"))] == ["1", "2"]


def test_dimension(spark):
    sources = dimension.source_dimension(spark, disabled=("CT",))
    assert sources.count() == 51 and dimension.commercial_states(sources).count() == 34
    assert dimension.select_sources(sources, "open_api").count() == 1
    assert [r.state for r in dimension.select_sources(sources, states=["tx", "CT"]).collect()] == ["TX"]
    assert sources.filter("two_party_consent").count() == 12


def test_logs(spark, tmp_path):
    event = {"timestamp": "2024-01-15T18:55:00Z", "state": None, "phase": "setup", "action_type": "x", "outcome": "success"}
    assert logs.read_activity_log(spark, put(tmp_path / "a.jsonl", json.dumps(event) + "\n")).first().phase == "setup"
    calls = [{"id": "a", "questions": ["q1", "q2"], "retry_count": 0}, {"id": "b"}]
    found = logs.read_call_queue(spark, put(tmp_path / "q.json", json.dumps({"calls": calls}, indent=1))).collect()
    assert [(r.queue_no, r.id) for r in found] == [(0, "a"), (1, "b")] and found[0].questions == ["q1", "q2"]
    consent = {"states": {"CA": {"consent_type": "two_party", "statute": "s"}, "TX": {"consent_type": "one_party"}}}
    rules = logs.read_consent_rules(spark, put(tmp_path / "c.json", json.dumps(consent, indent=1)))
    assert {r.state: r.consent_type for r in rules.collect()} == {"CA": "two_party", "TX": "one_party"}
    put(tmp_path / "r" / "a.json", json.dumps({"authorization_model": {"model_type": "closed"}}, indent=1))
    put(tmp_path / "r" / "b.json", json.dumps({"other": 1}, indent=1))
    facts = logs.research_facts(logs.read_research(spark, str(tmp_path / "r")), {"model": "$.authorization_model.model_type"})
    assert sorted(str(r.model) for r in facts.collect()) == ["None", "closed"]


def test_commercial_pages_compile(spark):
    """All fields of a commercial record in generated code: with no way back, code that is too large would raise."""
    spark.conf.set("spark.sql.codegen.fallback", "false")
    try:
        records = spark.createDataFrame([('{"fileNumber": "1", "debtor": {"name": "x"}, "status": 0}',)], "record string")
        found = json_feeds.map_commercial(records.selectExpr("*", "1 AS arrival").repartition(2), "AL").collect()
    finally:
        spark.conf.unset("spark.sql.codegen.fallback")
    assert [(r.filing_number, r.debtor_name, r.filing_status) for r in found] == [("1", "x", None)]


def test_xml_files_in_one_scan(spark, tmp_path):
    paths = [put(tmp_path / f"{i}.xml", f"<Root><Filing><FilingNumber>{i}</FilingNumber></Filing></Root>") for i in range(3)]
    assert sorted(r.filing_number for r in keyed(xml_feeds.read_xml(spark, paths, "CA"))) == ["0", "1", "2"]


def test_three_files_with_stored_parties(spark, tmp_path):
    """The first parties of a stored table of parties are those of the files."""
    put(tmp_path / "documents.csv", "DocNumber,Status\nD1,A\nD2,A\nD3,A\n")
    put(tmp_path / "debtors.csv", "DocNumber,PartyName\nD2,b\nD1,z\nD1,a\n")
    put(tmp_path / "secured.csv", "DocNumber,PartyName\nD1,s\n,t\n")
    paths = [str(tmp_path / f"{n}.csv") for n in ("documents", "debtors", "secured")]
    parties = three_files.three_file_parties(spark, paths, "WV")
    names = ["filing_number", "debtor_name", "secured_party_name"]
    stored = three_files.read_three_files(spark, paths, "WV", parties).select(names)
    assert sorted(map(tuple, stored.collect())) == [("D1", "z", "s"), ("D2", "b", None), ("D3", None, None)]
    assert sorted(map(str, stored.collect())) == sorted(map(str, three_files.read_three_files(spark, paths, "WV").select(names).collect()))
