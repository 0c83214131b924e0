"""Tables of blocking keys, up to 114 per record, are never broadcast, however small the planner takes them for."""

import re
from pathlib import Path

import pytest

import __spark_entry__ as entry
from kinloom import session
from kinloom.operators import blocking
from kinloom.plans import comparison_queries, linkage_queries

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="no test tables")
QUERIES = [
    "q_block_topk", "q_reverse_search", "q_block_recall", "q_candidates_none", "q_candidates_v17", "q_block_log_weight", "q_missed_pairs", "q_candidates_union",
]


def _broadcasts_keys(df) -> bool:
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = [re.search(r"\w", x).start() if re.search(r"\w", x) else 0 for x in lines]
    for i, line in enumerate(lines):
        if "BroadcastExchange" in line:
            end = next((j for j in range(i + 1, len(lines)) if depth[j] <= depth[i]), len(lines))
            part = lines[i + 1 : end]  # an aggregate without keys is one row
            if any("Generate explode(concat(" in x for x in part) and not any("keys=[]" in x for x in part):
                return True
    return False


@pytest.mark.parametrize("name", QUERIES)
def test_keys_are_shuffled(spark, monkeypatch, name):
    seen = []

    def noted(df, *args):
        seen.append(df)
        return write(df, *args)

    write = session.materialize
    for module in (session, linkage_queries, comparison_queries):
        monkeypatch.setattr(module, "materialize", noted)
    seen.append(entry.queries()[name](spark, DATA))
    assert any("Generate explode(concat(" in x._jdf.queryExecution().executedPlan().toString() for x in seen)
    assert not any(map(_broadcasts_keys, seen))


def _broadcasts_texts(df) -> bool:
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = [re.search(r"\w", x).start() if re.search(r"\w", x) else 0 for x in lines]
    for i, line in enumerate(lines):
        if "BroadcastExchange" in line:
            end = next((j for j in range(i + 1, len(lines)) if depth[j] <= depth[i]), len(lines))
            if any(re.search(r"\b[na][12]#", x) for x in lines[i + 1 : end]):
                return True
    return False


@pytest.mark.parametrize("name", ["q_candidates_v17", "q_reverse_search", "q_candidates_union"])
def test_texts_of_records_are_shuffled(spark, monkeypatch, name):
    seen = []

    def noted(df, *args):
        seen.append(df)
        return write(df, *args)

    write = session.materialize
    for module in (session, linkage_queries, comparison_queries):
        monkeypatch.setattr(module, "materialize", noted)
    seen.append(entry.queries()[name](spark, DATA))
    assert any(re.search(r"\bn2#", x._jdf.queryExecution().executedPlan().toString()) for x in seen)
    assert not any(map(_broadcasts_texts, seen))


@pytest.mark.parametrize("name", ["q_block_recall", "q_missed_pairs"])
def test_slices_give_the_rows_of_the_whole(spark, monkeypatch, name):
    """Pairs of labelled records only, a slice of the clean records on disk at a time."""
    whole = sorted(map(tuple, entry.queries()[name](spark, DATA).collect()))
    names, asked = [], []

    def noted(df, name="step"):
        names.append(name)
        return write(df, name)

    def counted(queries, *args):
        asked.append(queries.count())
        return score(queries, *args)

    write, score = session.materialize, blocking._scores
    for module in (session, linkage_queries, comparison_queries):
        monkeypatch.setattr(module, "materialize", noted)
    monkeypatch.setattr(blocking, "_scores", counted)
    monkeypatch.setattr(blocking, "RECORDS_PER_SLICE", 7)
    assert sorted(map(tuple, entry.queries()[name](spark, DATA).collect())) == whole
    assert names.count("chosen") == len(asked) > 1
    assert max(asked) < 20 and sum(asked) == linkage_queries.truth(spark, DATA).count()


@pytest.mark.parametrize("name", ["q_block_recall", "q_missed_pairs"])
def test_chosen_pairs_are_shuffled(spark, name):
    plan = entry.queries()[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    kinds = re.findall(r"(\w+Join) .*cand_id#|(\w+Join) .*matched_id#", plan)
    assert kinds and {x or y for x, y in kinds} == {"SortMergeJoin"}


@pytest.mark.parametrize("name", ["q_block_log_weight", "q_candidates_none", "q_candidates_union", "q_reverse_search"])
def test_few_clean_records_at_a_time(spark, monkeypatch, name):
    """Scores of a slice of the clean records, written before the next are made; the rows are those of one slice."""
    whole = sorted(map(tuple, entry.queries()[name](spark, DATA).collect()))
    asked = []

    def counted(queries, *args):
        asked.append(queries.count())
        return score(queries, *args)

    score = blocking._scores
    monkeypatch.setattr(blocking, "_scores", counted)
    monkeypatch.setattr(blocking, "RECORDS_PER_SLICE", 40)
    assert sorted(map(tuple, entry.queries()[name](spark, DATA).collect())) == whole
    assert len(asked) > 1 and max(asked) < 80 and sum(asked) == linkage_queries.clean(spark, DATA).count()


def test_reverse_search_by_slices(spark, monkeypatch):
    """Scores of a slice are written, searched both ways and removed before the next are made; the rows are those of one slice."""
    run = lambda: sorted(map(tuple, entry.queries()["q_candidates_v17"](spark, DATA).collect()))
    whole = run()
    names, asked = [], []

    def noted(df, name="step"):
        names.append(name)
        return write(df, name)

    def counted(queries, *args):
        asked.append(queries.count())
        return score(queries, *args)

    write, score = session.materialize, blocking._scores
    monkeypatch.setattr(session, "materialize", noted)
    monkeypatch.setattr(blocking, "_scores", counted)
    monkeypatch.setattr(blocking, "RECORDS_PER_SLICE", 40)
    assert run() == whole
    assert names.count("block-scores") == names.count("best") == names.count("selected") == len(asked) > 1
    assert max(asked) < 80 and sum(asked) == linkage_queries.clean(spark, DATA).count()
