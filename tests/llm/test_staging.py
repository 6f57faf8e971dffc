"""What an operator stages on its way is deleted when its result is written, and nothing else."""

from __future__ import annotations

from pathlib import Path

import pytest

from ledgerlens import session
from ledgerlens.llm import minhash, substrings
from ledgerlens.llm.staging import settled, staged


def _folders(spark):
    return {f.name.rpartition("-")[0] for f in Path(session.shared_dir(spark)).iterdir()}


@pytest.fixture
def shared(tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_dir", lambda spark: str(tmp_path))
    return tmp_path


def test_inner_tables_go_and_outer_ones_stay(spark, shared):
    before = staged(spark.range(10), "before")

    def build():
        inner = settled(spark, "inner", lambda: staged(spark.range(5), "innermost").filter("id > 1"))
        assert _folders(spark) == {"before", "inner"}
        return inner.join(staged(spark.range(4), "side"), "id")

    result = settled(spark, "result", build)
    assert _folders(spark) == {"before", "result"}
    assert sorted(r.id for r in result.collect()) == [2, 3] and before.count() == 10


def test_a_failure_deletes_nothing(spark, shared):
    def build():
        staged(spark.range(5), "inner")
        raise RuntimeError("stopped")

    with pytest.raises(RuntimeError):
        settled(spark, "result", build)
    staged(spark.range(1), "later")
    assert _folders(spark) == {"inner", "later"}


@pytest.mark.parametrize(
    ("operator", "left"),
    [
        (substrings.digest, {"removals"}),
        (substrings.cleaned, {"removals"}),
        (minhash.classes, {"class-rows", "text-classes"}),
        (minhash.representatives, {"texts", "leads"}),
    ],
)
def test_operators_leave_what_their_result_reads(spark, sample, shared, operator, left):
    tables = {t.name for t in spark.catalog.listTables()}
    result = operator(sample)
    assert _folders(spark) == left
    assert result.count() > 0
    new = {t.name for t in spark.catalog.listTables()} - tables
    assert len(new) == ("texts" in left)
