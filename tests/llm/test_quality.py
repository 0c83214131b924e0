"""Recall on known matches at several sizes: what counts as a common word must not depend on the number of rows."""

from pathlib import Path

import pytest

from kinloom.llm import queries

DATA = Path("/root/testdata")


def _groups(spark, base):
    rows = spark.read.parquet(f"{base}/known_matches.parquet").collect()
    return {i.strip(): r["source1_entity_id"] for r in rows for i in (r["matched_entity_ids"] or "").split(",") if i.strip()}


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_recall_of_names_and_matches(spark, size):
    base = str(DATA / size)
    if not Path(base).exists():
        pytest.skip("no test tables")
    group = _groups(spark, base)
    names = {r["entity_id"]: r["business_name"] for r in queries.pool(spark, base).collect()}
    members = {}
    for i, s in group.items():
        if names.get(i):
            members.setdefault(s, []).append(i)
    true = {(a, b) for ids in members.values() for a in ids for b in ids if a < b and names[a] != names[b]}
    found = {tuple(r) for r in queries.p5_found(spark, base).collect()}
    # some of the true pairs have a trade name on one side, which is no case
    assert len(found & true) >= 0.9 * len(true)
    labelled = {p for p in found if p[0] in group or p[1] in group}
    assert len({p for p in labelled if group.get(p[0]) == group.get(p[1])}) >= 0.97 * len(labelled)
    matches = {(r[0], r[1]) for r in queries.p3_matches(spark, base).select("source1_entity_id", "entity_id").collect()}
    true = {(s, i) for i, s in group.items() if i.startswith("S2")}
    assert len(matches & true) >= 0.9 * len(true)
    labelled = {p for p in matches if p[1] in group}
    assert len(labelled & true) >= 0.97 * len(labelled)
