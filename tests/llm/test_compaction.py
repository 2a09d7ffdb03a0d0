"""The token ledger's ranges of ids and its compactions."""

import pytest
from conftest import plan_of

from faremill.llm import tokencounts
from faremill.llm.scratch import Scratch


@pytest.fixture
def ledger(spark):
    return tokencounts.TokenLedger(spark, f"{Scratch(spark).root}/ledger")


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), tokencounts.CHANGE)


def totals(ledger):
    return {(r.source, r.lang, r.version): (r.documents, r.tokens) for r in ledger.totals().collect()}


def test_totals_and_replays_survive_compactions(spark, ledger):
    load = batch(spark, *[("insert", i, "a" if i % 2 else None, "en", "v1", i) for i in range(20)])
    revised = batch(spark, ("revise", 3, "a", "en", "v1", 100), ("delete", 4, None, None, None, None))
    again = batch(spark, ("delete", 3, None, None, "v1", None), ("insert", 4, "b", "de", "v2", 9))
    ledger.commit("1", load)
    ledger.compact()
    assert totals(ledger) == {("a", "en", "v1"): (10, 100), (None, "en", "v1"): (10, 90)}
    assert not ledger.commit("1", load)
    ledger.commit("2", revised)
    after = {("a", "en", "v1"): (10, 197), (None, "en", "v1"): (9, 86)}
    assert totals(ledger) == after
    for _ in range(3):
        ledger.compact()
        assert totals(ledger) == after
    assert not ledger.commit("2", revised) and totals(ledger) == after
    ledger.commit("3", again)
    ledger.compact()
    assert totals(ledger) == {("a", "en", "v1"): (9, 97), (None, "en", "v1"): (9, 86), ("b", "de", "v2"): (1, 9)}
    assert ledger.committed() == ["1", "2", "3"]


def test_a_compaction_keeps_net_entries_only(spark, ledger):
    for n in range(4):
        ledger.commit(f"{n}", batch(spark, *[("revise", i, "a", "en", "v1", n) for i in range(10)]))
    assert ledger._read("entries", tokencounts.ENTRY).count() == 70
    ledger.compact()
    assert ledger._read("entries", tokencounts.ENTRY).count() == 10 and totals(ledger) == {("a", "en", "v1"): (10, 30)}


def test_a_broken_off_compaction_changes_nothing(spark, ledger):
    ledger.commit("1", batch(spark, ("insert", 1, "a", "en", "v1", 5)))
    stray = spark.createDataFrame([("a", "en", "v1", 77, 77)], tokencounts.SUMS)
    stray.write.parquet(f"{ledger.path}/merged/00000000/sums")
    assert totals(ledger) == {("a", "en", "v1"): (1, 5)}
    ledger.compact()
    assert totals(ledger) == {("a", "en", "v1"): (1, 5)}


def test_replaced_files_go_with_the_compaction_after(spark, ledger):
    ledger.commit("1", batch(spark, ("insert", 1, "a", "en", "v1", 5)))
    running = ledger.totals()
    ledger.compact()
    assert [tuple(r) for r in running.collect()] == [("a", "en", "v1", 1, 5)]
    ledger.compact()
    assert ledger._marked("entries") == [] and totals(ledger) == {("a", "en", "v1"): (1, 5)}


def test_an_empty_ledger_compacts(spark, ledger):
    ledger.compact()
    assert totals(ledger) == {} and ledger.commit("1", batch(spark, ("insert", 1, None, None, None, None)))
    assert totals(ledger) == {(None, None, None): (1, 0)}


def test_a_commit_reads_its_range_of_ids(spark, ledger):
    ledger.commit("1", batch(spark, *[("insert", i, "a", "en", "v1", 1) for i in range(500)]))
    ledger.compact()
    compacted = ledger._read("entries", tokencounts.ENTRY)
    assert compacted.count() == 500
    plan = plan_of(compacted.where("doc_id BETWEEN 600 AND 700"))
    assert "GreaterThanOrEqual(doc_id,600)" in plan and "LessThanOrEqual(doc_id,700)" in plan
    ledger.commit("2", batch(spark, ("revise", 0, "a", "en", "v1", 3), ("revise", 499, "a", "en", "v1", 3), ("insert", -5, "a", "en", "v1", 1)))
    assert totals(ledger) == {("a", "en", "v1"): (501, 505)}
