"""Staging of both sources on hand-made rows."""

import json

import pytest
import yaml

from cairnframe.operators.candidates import staged_candidates
from cairnframe.operators.resolver import constant_resolver
from cairnframe.plans import staging
from cairnframe.sinks.staging_file import write_report
from cairnframe.sources.catalog import load_catalog
from cairnframe.sources.tables import read_source_table

LAT, LON, X, Y = "49,27391671", "20,07713884", "156826,50", "578327,52"
PIG_HEAD = ["ID", "Nazwa", "Inne nazwy", "Nr inw.", "X 1992", "Y 1992", "H (wg PIG)", "B", "L", "Sektor (nazwa)", "Długość [m]", "Głębokość [m]", "Deniwelacja [m]", "Stan na rok", "Link"]
TPN_HEAD = ["NR_INWENT", "NAZWA", "DLUGOSC", "GLEBOKOSC", "DENIWELACJ", "OTWÓR", "WER_LOK", "UWAGI", "GENEZA", "CREATED_DA", "LAST_EDI_1", "GLOBALID", "Z", "X1992", "Y1992"]
NOW = "2026-01-02T03:04:05Z"


def write_csv(path, head, rows):
    quote = lambda v: '"' + v.replace('"', '""') + '"'
    path.write_text("\ufeff" + "\r\n".join(",".join(map(quote, r)) for r in [head, *rows]) + "\r\n", encoding="utf-8")
    return str(path)


def pig_row(**changes):
    base = {"ID": "11", "Nazwa": "Dziura A", "Nr inw.": "T.F-09.33", "X 1992": X, "Y 1992": Y, "H (wg PIG)": "1 020,5", "B": LAT, "L": LON, "Długość [m]": "14", "Stan na rok": "2010", "Link": "https://example.org/11"} | changes
    return [base.get(c, "") for c in PIG_HEAD]


def tpn_row(**changes):
    base = {"NR_INWENT": "T.F-09.33", "NAZWA": "Dziura A", "GLOBALID": "{AAAA}", "Z": "1000,0", "X1992": X, "Y1992": Y, "LAST_EDI_1": "2022-05-25 00:00:00"} | changes
    return [base.get(c, "") for c in TPN_HEAD]


@pytest.fixture
def empty(spark, tmp_path):
    return load_catalog(spark, str(tmp_path / "none"))


def test_pig(spark, tmp_path, empty):
    path = write_csv(tmp_path / "p.csv", PIG_HEAD, [pig_row(), pig_row(ID="12", **{"X 1992": "1", "Y 1992": "2"}), pig_row(ID="", Link="", B="bad", **{"Stan na rok": "x"}), pig_row(ID="14", **{"Stan na rok": "?"})])
    found = staging.build_pig_staging(read_source_table(spark, path), empty, constant_resolver(), NOW)
    written = write_report(found, "pig", path, NOW, str(tmp_path / "out"), "pig-staging", "PIG staging")
    data = json.loads(written[0].read_text(encoding="utf-8"))
    assert [(r["cave_id"], r["object_id"], r["status"]) for r in data["rows"]] == [("C-0001", "KSW-0001", "object_proposed"), ("C-0002", None, "cave_only"), ("C-0003", None, "cave_only"), ("C-0004", "KSW-0002", "object_proposed")]
    assert [(i["record_number"], i["code"]) for i in data["issues"]] == [(2, "PIG_COORDINATE_MISMATCH"), (3, "PIG_POINT_COORDINATES_INVALID"), (4, "PIG_SOURCE_YEAR_INVALID")]
    first = data["proposed_objects"][0]
    m = first["measurements"][0]
    assert (m["observed_date"], m["source_ref"], m["elevation_m"], m["tags"]) == ("2010-12-31", "PIG:11", 1020.5, ["pig", "staging"])
    assert m["notes"].endswith("Source: https://example.org/11") and data["proposed_objects"][1]["measurements"][0]["observed_date"] == "2026-01-02"
    assert [r["ref_type"] for r in data["proposed_caves"][0]["external_refs"]] == ["inventory_number", "catalog_id", "url"]
    assert data["proposed_caves"][0]["notes"] == "PIG morphometry: length_m=14\nPIG source state year: 2010"
    assert "| 2 |" in written[1].read_text() and data["cave_only_count"] == 2


def test_tpn(spark, tmp_path, empty):
    pig = staging.build_pig_staging(read_source_table(spark, write_csv(tmp_path / "p.csv", PIG_HEAD, [pig_row()])), empty, constant_resolver(), NOW)
    [json_path, _] = write_report(pig, "pig", "p", NOW, str(tmp_path), "pig-staging", "t")
    stored = staging.read_report(spark, str(json_path))
    candidates = staged_candidates(stored["rows"], stored["proposed_objects"])
    rows = [tpn_row(), tpn_row(NR_INWENT="Z-1", NAZWA="Sztolnia B", GLOBALID="{BBBB}", GENEZA="sztolnia", X1992="150000"), tpn_row(GLOBALID="", NR_INWENT=""), tpn_row(X1992="bad", GLOBALID="{CC}", NR_INWENT="")]
    path = write_csv(tmp_path / "t.csv", TPN_HEAD, rows)
    found = staging.build_tpn_staging(read_source_table(spark, path), empty, constant_resolver(), NOW, candidates)
    data = json.loads(write_report(found, "tpn", path, NOW, str(tmp_path), "tpn-staging", "t")[0].read_text(encoding="utf-8"))
    assert [(r["status"], r["match_strategy"], r["object_id"]) for r in data["rows"]] == [("matched", "nr_inwent", "KSW-0001"), ("new", None, "KSW-0002"), ("rejected", None, None), ("rejected", None, None)]
    assert (data["matched_count"], data["new_count"], data["rejected_count"]) == (1, 1, 2)
    update = data["matched_measurements"][0]
    assert update["measurement"]["id"] == "m-002" and update["measurement"]["observed_date"] == "2022-05-25" and update["match"]["source"] == "pig_staging"
    assert data["proposed_objects"][0]["category"] == "sztolnia" and data["proposed_caves"][0]["id"] == "C-0002"
    assert {i["code"] for i in data["issues"]} == {"TPN_GLOBALID_MISSING", "TPN_POINT_COORDINATES_INVALID"}
    assert yaml.safe_load(yaml.safe_dump(data["proposed_objects"][0]))["id"] == "KSW-0002"


def test_tpn_number_twice_and_far(spark, tmp_path, empty):
    pig = staging.build_pig_staging(read_source_table(spark, write_csv(tmp_path / "p.csv", PIG_HEAD, [pig_row()])), empty, constant_resolver(), NOW)
    candidates = staged_candidates(pig.rows, pig.objects)
    rows = [tpn_row(X1992="157600", NAZWA="Inna"), tpn_row(GLOBALID="{BB}", X1992="157700", NAZWA="Inna 2")]
    found = staging.build_tpn_staging(read_source_table(spark, write_csv(tmp_path / "t.csv", TPN_HEAD, rows)), empty, constant_resolver(), NOW, candidates)
    assert {(r.status) for r in found.rows.collect()} == {"unresolved"}
    assert [i.code for i in found.issues.collect()] == ["TPN_NR_INWENT_AMBIGUOUS"] * 2
    one = staging.build_tpn_staging(read_source_table(spark, write_csv(tmp_path / "u.csv", TPN_HEAD, rows[:1])), empty, constant_resolver(), NOW, candidates)
    assert [i.code for i in one.issues.collect()] == ["TPN_MATCH_DISTANCE_REVIEW"]
