"""The command line."""

import json

import pytest

from quire import cli

PROFILE = """
schema_version: "1.0"
manual_id: m
manual_title: M
source_url: none
source_format: html
vehicles: [{model: CJ-5, years: "1954", drive_type: [4WD], engines: []}]
structure:
  hierarchy: [{level: 1, name: group, id_pattern: '^GROUP (\\d+)', known_ids: [{id: "8", title: x}]}]
"""


def test_flags():
    parser = cli.build_parser()
    given = ["process", "--profile", "p", "--pages", "x"]
    assert parser.parse_args(["-v", *given]).verbose and parser.parse_args(["--quiet", *given]).quiet
    assert parser.parse_args(["validate", "--profile", "p", "--pages", "x", "--diagnostics"]).diagnostics
    for wrong in (["-v", "-q", *given], ["validate-chunks", "--profile", "p"], ["validate-chunks", "--chunks", "c"], ["nothing"]):
        with pytest.raises(SystemExit):
            parser.parse_args(wrong)


def test_no_command_shows_help(capsys):
    assert cli.main([]) == 2 and "validate-chunks" in capsys.readouterr().out


def test_missing_files(spark, tmp_path, caplog):
    (tmp_path / "p.yaml").write_text(PROFILE)
    assert cli.main(["validate-chunks", "--chunks", "x", "--profile", str(tmp_path / "none.yaml")]) == 1 and "there is no profile" in caplog.text
    assert cli.main(["validate-chunks", "--chunks", str(tmp_path / "none.jsonl"), "--profile", str(tmp_path / "p.yaml")]) == 1 and "none.jsonl" in caplog.text


def test_process_and_validate(spark, tmp_path, capsys):
    (tmp_path / "p.yaml").write_text(PROFILE)
    pages, out = str(tmp_path / "pages"), str(tmp_path / "out")
    spark.createDataFrame([("m", 0, "GROUP 8 X\n" + "word " * 250)], "manual_id string, page_number int, text string").write.parquet(pages)
    assert cli.main(["process", "--profile", str(tmp_path / "p.yaml"), "--pages", pages, "--output-dir", out]) == 0
    lines = [json.loads(x) for x in (x.value for x in spark.read.text(f"{out}/m_chunks.jsonl").collect())]
    assert [x["chunk_id"] for x in lines] == ["m::8"] and lines[0]["metadata"]["level1_id"] == "8"
    assert cli.main(["validate-chunks", "--chunks", f"{out}/m_chunks.jsonl", "--profile", str(tmp_path / "p.yaml"), "--summary-only"]) == 0
    assert "PASSED" in capsys.readouterr().out
    assert cli.main(["validate", "--profile", str(tmp_path / "p.yaml"), "--pages", pages, "--diagnostics"]) == 0
    assert cli.main(["bootstrap-profile"]) == 1
