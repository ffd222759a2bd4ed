from pathlib import Path

import pytest

from voxlake.llm import storage as S
from voxlake.settings import shared_folder


def folders(spark):
    base = Path(shared_folder(spark, "probe").removeprefix("file:")).parent
    return {p.name for p in base.iterdir()} if base.exists() else set()


def test_tables_go_with_their_scratch_and_results_stay(spark):
    before = folders(spark)

    def build():
        first = S.kept(spark.range(10), "first")
        inner = S.finished(spark, lambda: S.kept(first, "second").where("id > 3"), "inner")
        assert {n.split("-")[0] for n in folders(spark) - before} == {"first", "inner"}
        return inner.where("id < 8")

    rows = S.finished(spark, build, "result")
    assert {n.split("-")[0] for n in folders(spark) - before} == {"result"}
    assert sorted(r.id for r in rows.collect()) == [4, 5, 6, 7]


def test_an_error_leaves_nothing(spark):
    before = folders(spark)
    with pytest.raises(ZeroDivisionError), S.scratch(spark):
        S.kept(spark.range(3), "lost")
        1 / 0  # noqa: B018
    assert folders(spark) == before


def test_without_a_scratch_tables_stay(spark):
    before = folders(spark)
    assert S.kept(spark.range(3), "own").count() == 3
    assert len(folders(spark) - before) == 1
