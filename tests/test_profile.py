"""Profiles: defaults, errors and translation."""

import pytest

from quire.plans.samples import MANUAL, PROSE
from quire.sources.profile import from_mapping, java, java_replacement, patterns, validate


def test_samples_are_valid():
    assert validate(PROSE) == [] and validate(MANUAL) == []
    assert patterns(MANUAL)["figure_reference"] == [r"FIG\. (\w+-\d+)"]


def test_defaults_and_errors():
    empty = from_mapping({})
    assert empty.unresolved_severity == "error" and len(validate(empty)) == 7
    with pytest.raises(ValueError):
        from_mapping([])
    with pytest.raises(KeyError):
        from_mapping({"vehicles": [{"model": "x"}]})
    bad = from_mapping({"structure": {"step_patterns": ["("]}, "ocr_cleanup": {"known_substitutions": [{"from": "a"}]}})
    assert any("step_patterns[0]" in m for m in validate(bad)) and any("known_substitutions[0]" in m for m in validate(bad))


def test_java():
    assert java(r"(?P<n_1>\d)") == r"([\p{Nd}])" and java("[a-z]") == "[a-z]"
    assert java_replacement(r"\1$", "(a)") == r"$1\$"
