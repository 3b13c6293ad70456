"""A profile that fits the generated prose, and small texts with what the prose lacks."""

from __future__ import annotations

from quire.sources.profile import Profile, from_mapping

PROSE: Profile = from_mapping({
    "schema_version": "1.0", "manual_id": "prose", "manual_title": "Prose", "source_url": "none", "source_format": "html",
    "vehicles": [{"model": "The", "years": "-", "drive_type": ["und"], "engines": [{"name": "la", "code": "queue", "aliases": ["thing"]}]}],
    "structure": {
        "hierarchy": [
            {"level": 1, "name": "one", "id_pattern": r"^(\S+)\.$", "known_ids": [{"id": "The", "title": ""}, {"id": "A", "title": ""}, {"id": "Of", "title": ""}]},
            {"level": 2, "name": "two", "id_pattern": r"^(\S+ \S+)\.$", "min_content_words": 20},
            {"level": 3, "name": "three", "title_pattern": r"^(\S+ \S+ \S+)\.$"},
        ],
        "cross_reference": {"patterns": [r"\bthe (\w+)\."]},
    },
    "ocr_cleanup": {
        "known_substitutions": [{"from": "tion", "to": "zion"}, {"from": "zz", "to": "z"}],
        "regex_substitutions": [{"pattern": r"(\w)ing\b", "replacement": r"\1in"}],
        "header_footer_patterns": [r"^Released under the", r"^Licensed under the"], "garbage_detection": {"enabled": True, "threshold": 0.4},
    },
})

MANUAL: Profile = from_mapping({
    "schema_version": "1.0", "manual_id": "m", "manual_title": "Manual", "source_url": "none", "source_format": "pdf-ocr",
    "vehicles": [{"model": "CJ-5", "years": "1954", "drive_type": ["4WD"], "engines": [{"name": "Hurricane F4", "code": "F4-134", "aliases": ["F-head"]}]}],
    "structure": {
        "hierarchy": [{"level": 1, "name": "group", "id_pattern": r"^GROUP (\w+)"}, {"level": 2, "name": "section", "id_pattern": r"^(?:GROUP )?(\w+) [A-Z]+$"}],
        "step_patterns": [r"^\((\d+)\)\s", r"^([a-z])\.\s"],
        "figure_reference": {"pattern": r"FIG\. (\w+-\d+)", "scope": "global"},
        "cross_reference": {"patterns": [r"[Rr]efer to (\w+)"]},
    },
    "safety_callouts": [{"level": "warning", "pattern": "^WARNING", "style": "block"}, {"level": "note", "pattern": "note:", "style": "inline"}],
    "ocr_cleanup": {"collapse_spaced_chars": True},
    "skip_sections": ["8W"],
})
