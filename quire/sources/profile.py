"""Profiles: one mapping (YAML) per manual that drives every operator."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

from quire.functions.patterns import java, java_replacement, unsayable

# What a profile may say.
VERSION = "1.0"
FORMATS = {"pdf-ocr", "pdf-native", "html", "epub"}
SEVERITIES = {"error", "warning"}
CALLOUT_LEVELS = {"warning", "caution", "note"}
CALLOUT_STYLES = {"block", "inline"}


@dataclass(frozen=True)
class Level:
    level: int
    name: str
    id_pattern: str | None = None
    title_pattern: str | None = None
    known_ids: tuple = ()
    min_gap_lines: int = 0
    min_content_words: int = 0
    require_blank_before: bool = False
    require_known_id: bool = False

    @property
    def ids(self) -> list[str]:
        return [str(k["id"]) if isinstance(k, dict) else str(k) for k in self.known_ids]


@dataclass(frozen=True)
class Callout:
    level: str
    pattern: str
    style: str


@dataclass(frozen=True)
class Engine:
    name: str
    code: str
    aliases: tuple = ()


@dataclass(frozen=True)
class Vehicle:
    model: str
    years: str
    drive_type: tuple
    engines: tuple[Engine, ...] = ()
    transmissions: tuple = ()


@dataclass(frozen=True)
class Cleanup:
    quality_estimate: str = ""
    known_substitutions: tuple = ()
    regex_substitutions: tuple = ()
    header_footer_patterns: tuple = ()
    garbage_enabled: bool = False
    garbage_threshold: float = 0.5
    collapse_spaced_chars: bool = False


@dataclass(frozen=True)
class Profile:
    schema_version: str = ""
    manual_id: str = ""
    manual_title: str = ""
    source_url: str = ""
    source_format: str = ""
    vehicles: tuple[Vehicle, ...] = ()
    hierarchy: tuple[Level, ...] = ()
    step_patterns: tuple[str, ...] = ()
    figure_pattern: str = ""
    cross_reference_patterns: tuple[str, ...] = ()
    callouts: tuple[Callout, ...] = ()
    cleanup: Cleanup = Cleanup()
    skip_sections: tuple[str, ...] = ()
    unresolved_severity: str = "error"
    #: Parts that are read and kept, but drive no operator.
    extra: dict[str, Any] = field(default_factory=dict)


def from_mapping(data: Any) -> Profile:
    """Missing parts get defaults; missing leaves of given parts raise KeyError."""
    if not isinstance(data, dict):
        raise ValueError("a profile is a mapping")
    shape, clean = data.get("structure") or {}, data.get("ocr_cleanup") or {}
    garbage = clean.get("garbage_detection") or {}
    level = lambda h: Level(h["level"], h["name"], **{k: tuple(v) if k == "known_ids" else v for k, v in h.items() if k in Level.__dataclass_fields__ and k not in ("level", "name")})
    vehicle = lambda v: Vehicle(v["model"], v["years"], tuple(v["drive_type"]), tuple(Engine(e["name"], e["code"], tuple(e.get("aliases", ()))) for e in v.get("engines", ())), tuple((t["name"], t["code"]) for t in v.get("transmissions", ())))
    return Profile(
        **{k: data.get(k, "") for k in ("schema_version", "manual_id", "manual_title", "source_url", "source_format")},
        vehicles=tuple(map(vehicle, data.get("vehicles", ()))), hierarchy=tuple(map(level, shape.get("hierarchy", ()))),
        step_patterns=tuple(shape.get("step_patterns", ())), figure_pattern=(shape.get("figure_reference") or {}).get("pattern", ""),
        cross_reference_patterns=tuple((shape.get("cross_reference") or {}).get("patterns", ())),
        callouts=tuple(Callout(c["level"], c["pattern"], c["style"]) for c in data.get("safety_callouts", ())),
        cleanup=Cleanup(clean.get("quality_estimate", ""), tuple(clean.get("known_substitutions", ())), tuple(clean.get("regex_substitutions", ())), tuple(clean.get("header_footer_patterns", ())), garbage.get("enabled", False), garbage.get("threshold", 0.5), clean.get("collapse_spaced_chars", False)),
        skip_sections=tuple(data.get("skip_sections", ())), unresolved_severity=data.get("cross_ref_unresolved_severity", "error"),
        extra={"page_number": shape.get("page_number"), "figure_scope": (shape.get("figure_reference") or {}).get("scope", ""), "content_types": data.get("content_types"), "variants": data.get("variants")},
    )


def load(path: str | Path) -> Profile:
    import yaml

    return from_mapping(yaml.safe_load(Path(path).read_text(encoding="utf-8")))


def patterns(p: Profile) -> dict[str, list[str]]:
    """Patterns by what they are for."""
    page = (p.extra.get("page_number") or {}).get("pattern")
    return {
        "hierarchy": [x for h in p.hierarchy for x in (h.id_pattern, h.title_pattern) if x],
        "step_patterns": list(p.step_patterns), "safety_callouts": [c.pattern for c in p.callouts],
        "figure_reference": [p.figure_pattern] if p.figure_pattern else [],
        "cross_reference": list(p.cross_reference_patterns), "page_number": [page] if page else [],
    }


def validate(p: Profile) -> list[str]:
    """What is wrong with a profile, one message each."""
    found = [f"{k} is missing" for k in ("schema_version", "manual_id", "manual_title", "source_url") if not getattr(p, k)]
    if p.schema_version and p.schema_version != VERSION:
        found.append(f"schema_version {p.schema_version!r} is not {VERSION}")
    if p.source_format not in FORMATS:
        found.append(f"source_format {p.source_format!r} is none of {', '.join(sorted(FORMATS))}")
    found += [f"no {k}" for k in ("vehicles", "hierarchy") if not getattr(p, k)]
    levels = [h.level for h in p.hierarchy]
    if levels != list(range(1, len(levels) + 1)):
        found.append(f"hierarchy levels {levels} don't count from 1")
    named = [(f"{kind}[{i}]", x) for kind, xs in patterns(p).items() for i, x in enumerate(xs)]
    for i, s in enumerate(p.cleanup.regex_substitutions):
        if "pattern" in s and "replacement" in s:
            named.append((f"regex_substitutions[{i}]", s["pattern"]))
        else:
            found.append(f"regex_substitutions[{i}] needs pattern and replacement")
    found += [f"known_substitutions[{i}] needs from and to" for i, s in enumerate(p.cleanup.known_substitutions) if not {"from", "to"} <= set(s)]
    for label, x in named:
        try:
            re.compile(x)
        except re.error as e:
            found.append(f"{label} is no regular expression: {e}")
        else:
            if (what := unsayable(x)) is not None:
                found.append(f"{label} can't be told to Spark: {what}")
    if p.unresolved_severity not in SEVERITIES:
        found.append(f"cross_ref_unresolved_severity {p.unresolved_severity!r} is none of {', '.join(sorted(SEVERITIES))}")
    for c in p.callouts:
        found += [f"callout {what} {x!r} is none of {', '.join(sorted(ok))}" for what, x, ok in (("level", c.level, CALLOUT_LEVELS), ("style", c.style, CALLOUT_STYLES)) if x not in ok]
    return found
