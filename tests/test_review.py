"""Decision logs against hand-made staging files."""

import json

import pytest
import yaml

from cairnframe.operators import review
from cairnframe.plans.staging import read_report
from cairnframe.sources.catalog import load_catalog

NOW, WHO = "2026-02-03T04:05:06Z", "tester"


def measurement(mid, source="TPN", **more):
    return {"id": mid, "lat": 49.27, "lon": 20.07, "x_1992": 1.0, "y_1992": 2.0, "source": source, "source_ref": f"{source}:{{A}}", "observed_date": "2022-05-25", "method": "source_record", "tags": [source.lower(), "staging"], "verification_status": "nieweryfikowany", "notes": review.STAGED_MEASUREMENT.format(source) + " tail"} | more


def thing(oid, cave=None, mid="m-001", source="PIG", note=None):
    return {"schema_version": 1, "id": oid, "category": "jaskinia_otwor", "name_local": oid, "cave_id": cave, "external_refs": [], "measurements": [measurement(mid, source)], "best_measurement": {"mode": "auto", "measurement_id": mid, "reason": None, "updated_at": "x", "updated_by": "x"}, "attachments": [], "notes": note or review.STAGED_PROPOSAL.format(source)}


@pytest.fixture
def world(spark, tmp_path):
    data = tmp_path / "data"
    (data / "caves").mkdir(parents=True)
    (data / "objects" / "KSW").mkdir(parents=True)
    (data / "caves" / "C-0001.yml").write_text(yaml.safe_dump({"schema_version": 1, "id": "C-0001", "name": "old", "zzz": 1, "external_refs": [], "object_ids": []}, sort_keys=False))
    (data / "objects" / "KSW" / "KSW-0001.yml").write_text(yaml.safe_dump(thing("KSW-0001", "C-0001"), sort_keys=False))
    pig = {"rows": [{"record_number": 1, "cave_id": "C-0002", "object_id": "KSW-0002"}], "proposed_caves": [{"schema_version": 1, "id": "C-0002", "name": "n", "external_refs": [], "object_ids": []}], "proposed_objects": [thing("KSW-0002", "C-0002")]}
    ref = {"system": "TPN", "ref_type": "source_globalid", "external_id": "{A}", "scope": "object", "notes": "n"}
    update = {"status": "matched", "record_number": 5, "target_object_id": "KSW-0002", "target_cave_id": "C-0002", "object_external_refs": [ref, ref], "cave_external_refs": [{"system": "NR_INWENT", "ref_type": "inventory_number", "external_id": "T.1"}], "measurement": measurement("m-002")}
    tpn = {"rows": [{"record_number": 5, "globalid": "{A}"}, {"record_number": 6, "globalid": "{B}"}], "matched_measurements": [update], "proposed_caves": [], "proposed_objects": []}
    reports = {}
    for name, content in (("PIG", pig), ("TPN", tpn)):
        path = tmp_path / f"{name}.json"
        path.write_text(json.dumps(content))
        reports[name] = read_report(spark, str(path))

    def run(decisions):
        out = review.apply_review(spark, load_catalog(spark, str(data)), decisions, reports, NOW, WHO)
        written = review.write_review(out, str(data))
        return review.review_report(out, str(data), written), data

    return run


def test_create_add_and_link(world):
    report, data = world([
        {"action": "create_cave", "source": "pig", "record_number": 1},
        {"action": "create_object", "source": "PIG", "record_number": 1},
        {"action": "add_measurement", "source": "TPN", "record_number": 5},
        {"action": "link_cave", "object_id": "KSW-0001", "cave_id": "C-0002"},
        {"action": "reject", "source": "TPN", "record_number": 6},
    ])
    assert [(d["decision_index"], d["status"]) for d in report["decisions"]] == [(1, "materialized"), (2, "materialized"), (3, "materialized"), (4, "materialized"), (5, "skipped")]
    assert [i["code"] for i in report["issues"]] == ["DECISION_REASON_MISSING"] and not report["has_errors"]
    made = yaml.safe_load((data / "objects/KSW/KSW-0002.yml").read_text())
    assert [m["id"] for m in made["measurements"]] == ["m-001", "m-002"] and made["best_measurement"]["measurement_id"] == "m-002"
    assert made["measurements"][1]["tags"] == ["tpn"] and made["measurements"][1]["notes"] == review.FINAL_MEASUREMENT.format("TPN") + " tail"
    assert made["notes"] == review.FINAL_PROPOSAL.format("PIG") and len(made["external_refs"]) == 1 and made["updated_by"] == WHO
    cave = yaml.safe_load((data / "caves/C-0002.yml").read_text())
    assert cave["object_ids"] == ["KSW-0001"] and cave["external_refs"][0]["external_id"] == "T.1"
    old = yaml.safe_load((data / "objects/KSW/KSW-0001.yml").read_text())
    assert old["cave_id"] == "C-0002" and list(old)[:3] == ["schema_version", "id", "category"]


def test_errors_forbid_all_writing(world):
    report, data = world([
        "nonsense", {"action": "destroy"}, {"action": "create_cave", "source": "x", "record_number": 0},
        {"action": "add_measurement", "source": "TPN", "record_number": 5},
        {"action": "create_object", "source": "PIG", "record_number": 1}, {"action": "create_object", "source": "PIG", "record_number": 1},
        {"action": "add_measurement", "source": "TPN", "record_number": 5}, {"action": "add_measurement", "source": "TPN", "record_number": 5},
        {"action": "add_measurement", "source": "PIG", "record_number": 1}, {"action": "add_measurement", "source": "TPN", "record_number": 9},
        {"action": "link_cave", "object_id": "KSW-0001"}, {"action": "link_cave", "object_id": "Q-1", "cave_id": "C-0001"}, {"action": "link_cave", "object_id": "KSW-0001", "cave_id": "C-9"},
        {"action": "unresolved", "source": "PIG", "record_number": 77, "reason": "r"}, {"action": "create_cave", "source": "TPN", "record_number": 6},
    ])
    assert [(i["decision_index"], i["code"]) for i in report["issues"]] == [
        (1, "DECISION_INVALID"), (2, "DECISION_ACTION_INVALID"), (3, "DECISION_RECORD_INVALID"), (3, "DECISION_SOURCE_INVALID"), (4, "TARGET_OBJECT_MISSING"), (6, "OBJECT_ALREADY_EXISTS"),
        (8, "MEASUREMENT_ALREADY_EXISTS"), (9, "MEASUREMENT_SOURCE_UNSUPPORTED"), (10, "STAGING_MEASUREMENT_UPDATE_MISSING"), (11, "LINK_CAVE_TARGET_MISSING"), (12, "LINK_OBJECT_MISSING"),
        (13, "LINK_CAVE_MISSING"), (14, "STAGING_ROW_MISSING"), (15, "STAGING_CAVE_PROPOSAL_MISSING"),
    ]
    assert report["has_errors"] and report["written_paths"] == [] and not (data / "objects/KSW/KSW-0002.yml").exists()


def test_refused_files(spark, world, tmp_path):
    catalog = load_catalog(spark, str(tmp_path / "data"))
    report = review.review_report(review.review_file(spark, catalog, {"decisions": {}}, {}, NOW, WHO), "d", [])
    assert [i["code"] for i in report["issues"]] == ["DECISIONS_INVALID"] and report["has_errors"]
    (tmp_path / "data" / "caves" / "C-0003.yml").write_text("a: [")
    found = review.review_file(spark, load_catalog(spark, str(tmp_path / "data")), {"decisions": [], "reviewed_by": "x"}, {}, NOW, WHO)
    assert [r.code for r in found.issues.collect()] == ["FINAL_DATA_INVALID"] and found.reviewed_by == "x" and review.write_review(found, "d") == []
    (tmp_path / "list.json").write_text("[1]")
    with pytest.raises(ValueError, match="JSON object"):
        read_report(spark, str(tmp_path / "list.json"))
    (tmp_path / "bad.yml").write_text("- 1")
    with pytest.raises(review.DecisionFileError):
        review.read_decisions(spark, str(tmp_path / "bad.yml"))
