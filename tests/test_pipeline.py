"""The pipeline end to end on files made from the smallest tables: normalise, train, predict, validate."""

import os
from pathlib import Path

import pytest

from kinloom.config import Paths
from kinloom.operators import decision, model
from kinloom.plans import pipeline
from kinloom.sources.files import read_ground_truth, read_predictions, read_source, read_tsv

DATA = os.environ.get("PIPELINE_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def paths(tmp_path_factory):
    import pandas as pd

    root = tmp_path_factory.mktemp("linkage")
    (root / "data").mkdir()
    known = pd.read_parquet(f"{DATA}/known_matches.parquet")
    for n in (1, 2, 3):
        df = pd.read_parquet(f"{DATA}/s{n}.parquet")[["entity_id", "business_name", "business_address", "country"]].drop_duplicates("entity_id").fillna("")
        if n == 1:
            df = df[df.entity_id.isin(set(known.source1_entity_id))]
        for split in ("train", "test"):
            (root / "data" / f"{split}_source{n}.tsv").write_text("\t".join(df.columns) + "\n" + "".join("\t".join(r) + "\n" for r in df.itertuples(index=False)), encoding="utf-8")
    rows = [(a, ",".join(dict.fromkeys(x.strip() for x in (b or "").split(",") if x.strip()))) for a, b in known.itertuples(index=False)]
    (root / "data" / "train_ground_truth.tsv").write_text("source1_entity_id\tmatched_entity_ids\n" + "".join(f"{a}\t{b}\n" for a, b in rows), encoding="utf-8")
    return Paths(str(root / "data"), str(root / "work"), str(root / "output"))


@pytest.fixture(scope="module")
def trained(spark, paths):
    """Report and summary of one run over all stages."""
    pipeline.normalize(spark, paths)
    options = pipeline.TrainOptions(preset="v17", n_train=10_000, n_valid=10_000, sibling_share=0.5, boosting=model.Boosting(rounds=8, depth=3))
    return pipeline.train(spark, paths, options), pipeline.predict(spark, paths, pipeline.PredictOptions(tau=0.5, assign="joint"))


def test_end_to_end(spark, paths, trained):
    report, summary = trained
    assert report["blocking"]["recall"] > 0.8
    assert sum(r["s1"] for r in summary.values()) == read_source(spark, paths.sources("test")["s1"]).count()
    # each S1 has one line, and the files were checked by the pipeline itself
    lines = read_predictions(spark, f"{paths.output}/matching_results.tsv")
    assert lines.count() == lines.select("source1_entity_id").distinct().count()
    match = spark.read.parquet(f"{paths.work}/model/test_matches")
    truth = read_ground_truth(spark, paths.ground_truth)
    assert decision.f05_macro(match, truth) > 0.7


def test_tuning_second_stage_and_patch(spark, paths, trained):
    home = f"{paths.work}/model"
    scored, clean, pool = (spark.read.parquet(f"{home}/{n}") for n in ("valid_scored", "train_clean", "train_pool"))
    truth = read_ground_truth(spark, paths.ground_truth).join(scored.select("source1_entity_id").distinct(), "source1_entity_id", "left_semi")
    rows = pipeline.tune_post(scored, clean, pool, truth, 0.5)
    assert len(rows) == 18 and rows[0]["f05"] >= rows[-1]["f05"] and {r["variant"]: r for r in rows}["none"]["removed_false"] == 0
    grid = pipeline.eval_blend(scored, scored, clean, pool, truth, weights=(0.5,), posts=("none",), taus=(0.5,))
    assert {g["joint"] for g in grid} == {True, False}
    report = pipeline.stage2_fit(spark, paths, 2, model.Boosting(rounds=3, depth=3))
    assert 0 <= report["f05"] <= 1
    assert pipeline.stage2_predict(spark, paths).count() > 0
    a, b, affected = pipeline.patched(spark, paths, ("shri", "sri"))
    assert b.count() == pipeline.load(spark, paths, "test")[1].count() and affected.count() <= a.count()
    old, new = spark.read.parquet(f"{home}/test_scored"), pipeline.rescore_patched(spark, paths, ("the", "shree"))
    assert new.count() == old.count()
    untouched = old.join(pipeline.patched(spark, paths, ("the", "shree"))[2], "source1_entity_id", "left_anti")
    assert untouched.exceptAll(new.select(*untouched.columns)).count() == 0


def test_command_line(spark, paths, trained, capsys):
    from kinloom import cli

    args = cli._parser().parse_args(["validate", f"{paths.output}/matching_results.tsv", "--candidates", f"{paths.output}/candidate_pairs.tsv", "--check-ids"])
    assert cli.run(spark, args, paths) == 0
    assert '"errors": []' in capsys.readouterr().out
    assert cli.run(spark, cli._parser().parse_args(["eda"]), paths) == 0
    assert Path(f"{paths.output}/eda_report.md").read_text(encoding="utf-8").startswith("# Sources")


def test_ragged_tsv(spark, tmp_path):
    f = tmp_path / "x.tsv"
    f.write_text('entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-1\t"A" b\t\tUS\textra\nS1-2\tshort\n', encoding="utf-8")
    rows = {r["entity_id"]: r for r in read_tsv(spark, str(f)).collect()}
    assert rows["S1-1"]["business_name"] == '"A" b' and rows["S1-1"]["business_address"] is None and rows["S1-1"]["country"] == "US"
    assert rows["S1-2"]["country"] is None
    g = tmp_path / "y.tsv"
    g.write_text("entity_id\tname\n1\ta\n", encoding="utf-8")
    with pytest.raises(ValueError, match="lacks the columns"):
        read_source(spark, str(g))
