"""What operators write for themselves goes as soon as it has been used."""

from pathlib import Path

import pytest

from quire.operators import checks
from quire.plans import corpus
from quire.sources.storage import settled, shared_dir, written


def tables(spark):
    return {f.name for f in Path(shared_dir(spark).removeprefix("file:")).iterdir()}


def new(spark, old):
    return sorted(n.rsplit("-", 1)[0] for n in tables(spark) - old)


def test_of_the_flow_only_chunks_stay(spark, tmp_path):
    rows = [(i, f"The.\n{'word ' * 30}\nof the thing.\n{i}", f"s{i % 2}") for i in range(40)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    old = tables(spark)
    made = corpus.flow(spark, str(tmp_path))
    assert new(spark, old) == ["quire-chunks"] and made.count() > 1
    old = tables(spark)
    pairs = checks.duplicate_pairs(made)
    assert new(spark, old) == ["quire-duplicate-pairs"] and pairs.count() >= 0


def test_tables_within_others_and_after_a_failure(spark):
    old = tables(spark)

    def inner():
        return written(spark.range(5), "a").join(settled(spark, lambda: written(spark.range(3), "b"), "c"), "id")

    assert settled(spark, inner, "d").count() == 3 and new(spark, old) == ["quire-d"]

    def fails():
        written(spark.range(5), "e")
        raise ValueError("no")

    with pytest.raises(ValueError, match="no"):
        settled(spark, fails, "f")
    assert new(spark, old) == ["quire-d"]
    written(spark.range(1), "g")
    assert new(spark, old) == ["quire-d", "quire-g"]
