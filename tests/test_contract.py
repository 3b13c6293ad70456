"""The contract of profiles."""

import copy

import pytest

from quire.sources.contract import PROFILE, json_schema, violations

GOOD = {
    "schema_version": "1.0", "manual_id": "m", "manual_title": "M", "source_url": "u", "source_format": "html",
    "vehicles": [{"model": "CJ-5", "years": "1954", "drive_type": ["4WD"], "engines": [{"name": "F4", "code": "F", "aliases": ["f"]}], "transmissions": [{"name": "T", "code": "t"}]}],
    "structure": {"hierarchy": [{"level": 1, "name": "group", "id_pattern": "^(a)", "title_pattern": None, "known_ids": [{"id": "1", "title": "x"}], "min_gap_lines": 2, "require_known_id": True}], "step_patterns": ["a"], "figure_reference": {"pattern": "f", "scope": "global"}},
    "safety_callouts": [{"level": "note", "pattern": "n", "style": "block"}], "content_types": {"anything": 1}, "ocr_cleanup": {"garbage_detection": {"enabled": True, "threshold": 0.5}}, "variants": {"markets": ["x"]},
    "skip_sections": ["8W"], "cross_ref_unresolved_severity": "warning", "own_key": [1],
}


def test_a_good_profile_breaks_nothing():
    assert list(violations(GOOD)) == []


@pytest.mark.parametrize(("path", "value", "message"), [
    (("schema_version",), "2.0", "profile.schema_version is none of 1.0"), (("manual_id",), "", "profile.manual_id is empty"), (("source_url",), 3, "profile.source_url is no string"),
    (("vehicles",), [], "profile.vehicles has fewer than 1 items"), (("vehicles", 0, "drive_type"), "4WD", "profile.vehicles[0].drive_type is no list"), (("vehicles", 0, "engines", 0, "aliases", 0), 7, "profile.vehicles[0].engines[0].aliases[0] is no string"),
    (("structure", "hierarchy", 0, "level"), 0, "profile.structure.hierarchy[0].level is out of bounds"), (("structure", "hierarchy", 0, "level"), True, "profile.structure.hierarchy[0].level is no whole number"), (("structure", "hierarchy", 0, "min_gap_lines"), 1.5, "profile.structure.hierarchy[0].min_gap_lines is no whole number"),
    (("structure", "hierarchy", 0, "title_pattern"), 1, "profile.structure.hierarchy[0].title_pattern is no string or null"), (("structure", "hierarchy", 0, "known_ids", 0), "1", "profile.structure.hierarchy[0].known_ids[0] is no mapping"),
    (("structure", "figure_reference", "scope"), "page", "profile.structure.figure_reference.scope is none of global, per-section"), (("ocr_cleanup", "garbage_detection", "threshold"), 1.1, "profile.ocr_cleanup.garbage_detection.threshold is out of bounds"),
    (("ocr_cleanup", "garbage_detection", "enabled"), "yes", "profile.ocr_cleanup.garbage_detection.enabled is no boolean"), (("safety_callouts", 0, "style"), "x", "profile.safety_callouts[0].style is none of block, inline"), (("variants",), None, "profile.variants is no mapping"),
])
def test_each_breach_is_told_with_its_place(path, value, message):
    bad = copy.deepcopy(GOOD)
    at = bad
    for k in path[:-1]:
        at = at[k]
    at[path[-1]] = value
    assert list(violations(bad)) == [message]


def test_missing_keys_are_told():
    assert set(violations({})) == {f"profile.{k} is missing" for k in PROFILE.needed}
    assert list(violations([])) == ["profile is no mapping"]
    assert list(violations(GOOD | {"safety_callouts": [{"level": "note"}]})) == ["profile.safety_callouts[0].pattern is missing", "profile.safety_callouts[0].style is missing"]


def test_json_schema():
    s = json_schema()
    assert s["required"] == list(PROFILE.needed) and s["properties"]["vehicles"]["minItems"] == 1
    level = s["properties"]["structure"]["properties"]["hierarchy"]["items"]["properties"]
    assert level["level"] == {"type": "integer", "minimum": 1} and level["id_pattern"] == {"type": ["string", "null"]}
    assert s["properties"]["ocr_cleanup"]["properties"]["garbage_detection"]["properties"]["threshold"] == {"type": "number", "minimum": 0, "maximum": 1}
