"""The contract of a profile's mapping: what keys there are, what they hold, and which have to be there.

The contract is Python values: a type, a tuple of types, a set of allowed texts, ``Number`` for bounds, ``Items`` for lists and ``Keys`` for
mappings. ``violations`` says each breach with its place; ``json_schema`` gives the contract as a JSON Schema for other tools.
Keys that the contract doesn't name are allowed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import Any

NULL = type(None)


@dataclass(frozen=True)
class Text:
    least: int = 0


@dataclass(frozen=True)
class Number:
    whole: bool
    least: float | None = None
    most: float | None = None


@dataclass(frozen=True)
class Items:
    of: Any
    least: int = 0


@dataclass(frozen=True)
class Keys:
    needed: dict[str, Any] = field(default_factory=dict)
    also: dict[str, Any] = field(default_factory=dict)


_TEXTS = Items(str)
_CODED = {"name": str, "code": str}
# The keys of a profile and what they may hold.
PROFILE = Keys(
    {
        "schema_version": {"1.0"}, "manual_id": Text(1), "manual_title": Text(1), "source_url": Text(1), "source_format": {"pdf-ocr", "pdf-native", "html", "epub"},
        "vehicles": Items(Keys({"model": str, "years": str, "drive_type": _TEXTS}, {"engines": Items(Keys(_CODED, {"aliases": _TEXTS})), "transmissions": Items(Keys(_CODED))}), 1),
        "structure": Keys(
            {"hierarchy": Items(Keys({"level": Number(True, 1), "name": str}, {
                "id_pattern": (str, NULL), "title_pattern": (str, NULL), "known_ids": Items(Keys({"id": str, "title": str})), "min_gap_lines": Number(True, 0), "min_content_words": Number(True, 0),
                "require_blank_before": bool, "require_known_id": bool,
            }), 1)},
            {"page_number": Keys({}, {"pattern": str, "group_prefixed": bool}), "step_patterns": _TEXTS, "figure_reference": Keys({}, {"pattern": str, "scope": {"per-section", "global"}}), "cross_reference": Keys({}, {"patterns": _TEXTS})},
        ),
        "safety_callouts": Items(Keys({"level": {"warning", "caution", "note"}, "pattern": str, "style": {"block", "inline"}})),
        "content_types": Keys({}, {"maintenance_schedule": Keys(), "wiring_diagrams": Keys(), "specification_tables": Keys()}),
        "ocr_cleanup": Keys({}, {
            "quality_estimate": str, "known_substitutions": Items(Keys({"from": str, "to": str})), "regex_substitutions": Items(Keys({"pattern": str, "replacement": str})), "header_footer_patterns": _TEXTS,
            "garbage_detection": Keys({}, {"enabled": bool, "threshold": Number(False, 0, 1)}), "collapse_spaced_chars": bool,
        }),
        "variants": Keys({}, {"has_market_variants": bool, "variant_indicator": str, "markets": _TEXTS}),
    },
    {"skip_sections": _TEXTS, "cross_ref_unresolved_severity": {"error", "warning"}},
)

_NAMES = {str: "string", bool: "boolean", NULL: "null"}


def violations(value: Any, rule: Any = PROFILE, place: str = "profile") -> Iterator[str]:
    """Each breach of the contract, with its place."""
    if isinstance(rule, Keys):
        if not isinstance(value, dict):
            yield f"{place} is no mapping"
            return
        yield from (f"{place}.{k} is missing" for k in rule.needed if k not in value)
        for k, inner in (rule.needed | rule.also).items():
            if k in value:
                yield from violations(value[k], inner, f"{place}.{k}")
    elif isinstance(rule, Items):
        if not isinstance(value, list):
            yield f"{place} is no list"
            return
        if len(value) < rule.least:
            yield f"{place} has fewer than {rule.least} items"
        for i, x in enumerate(value):
            yield from violations(x, rule.of, f"{place}[{i}]")
    elif isinstance(rule, Number):
        # what is true or false is no number, and 3.0 is whole
        if isinstance(value, bool) or not isinstance(value, (int, float)) or (rule.whole and not float(value).is_integer()):
            yield f"{place} is no {'whole ' if rule.whole else ''}number"
        elif rule.least is not None and value < rule.least or rule.most is not None and value > rule.most:
            yield f"{place} is out of bounds"
    elif isinstance(rule, Text):
        if not isinstance(value, str):
            yield f"{place} is no string"
        elif len(value) < rule.least:
            yield f"{place} is empty"
    elif isinstance(rule, set):
        if not isinstance(value, str) or value not in rule:
            yield f"{place} is none of {', '.join(sorted(rule))}"
    else:
        kinds = rule if isinstance(rule, tuple) else (rule,)
        if not isinstance(value, kinds):
            yield f"{place} is no {' or '.join(_NAMES[k] for k in kinds)}"


def json_schema(rule: Any = PROFILE) -> dict:
    """The contract as a JSON Schema."""
    if isinstance(rule, Keys):
        out: dict[str, Any] = {"type": "object"}
        if rule.needed:
            out["required"] = list(rule.needed)
        if rule.needed or rule.also:
            out["properties"] = {k: json_schema(v) for k, v in (rule.needed | rule.also).items()}
        return out
    if isinstance(rule, Items):
        return {"type": "array", "items": json_schema(rule.of)} | ({"minItems": rule.least} if rule.least else {})
    if isinstance(rule, Number):
        bounds = {"minimum": rule.least, "maximum": rule.most}
        return {"type": "integer" if rule.whole else "number"} | {k: v for k, v in bounds.items() if v is not None}
    if isinstance(rule, Text):
        return {"type": "string", "minLength": rule.least}
    if isinstance(rule, set):
        return {"type": "string", "enum": sorted(rule)}
    kinds = rule if isinstance(rule, tuple) else (rule,)
    names = [_NAMES[k] for k in kinds]
    return {"type": names if len(names) > 1 else names[0]}
