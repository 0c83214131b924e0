"""Command line: ``python -m kinloom.cli normalize | train | predict | stage2 | validate | eda | tune-post | block-eval | patch``."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from kinloom.config import CAPS, PRESETS, Paths
from kinloom.operators import blocking, diagnostics, sampling, validate
from kinloom.plans import pipeline
from kinloom.session import ship_package
from kinloom.sources.files import explode_ground_truth, markdown_report, read_ground_truth, read_source, write_json, write_text


def _parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(description=__doc__)
    ap.add_argument("--data-dir"), ap.add_argument("--work-dir"), ap.add_argument("--output-dir")
    sub = ap.add_subparsers(dest="command", required=True)
    n = sub.add_parser("normalize")
    n.add_argument("--max-rows", type=int), n.add_argument("--force", action="store_true"), n.add_argument("--strip-prefix", default="")
    t = sub.add_parser("train")
    t.add_argument("--blocking", default="v17", choices=sorted(PRESETS)), t.add_argument("--n-train", type=int, default=300_000), t.add_argument("--n-valid", type=int, default=100_000)
    t.add_argument("--siblings", type=float, default=0.9), t.add_argument("--post", default="conflict_p90"), t.add_argument("--force", action="store_true")
    p = sub.add_parser("predict")
    p.add_argument("--tau", type=float), p.add_argument("--post", default="conflict_p90"), p.add_argument("--assign", default="joint", choices=("argmax", "joint", "strength", "explain"))
    p.add_argument("--assign-margin", type=float, default=0.02), p.add_argument("--blend", nargs="*", default=()), p.add_argument("--blend-weights")
    p.add_argument("--tau-country", nargs="*", default=(), help="COUNTRY=TAU"), p.add_argument("--blank-country", nargs="*", default=())
    p.add_argument("--blank-kmax", type=int), p.add_argument("--blank-pmax", type=float, default=0.9), p.add_argument("--blank-1src", action="store_true"), p.add_argument("--blank-numdiff", action="store_true")
    p.add_argument("--force", action="store_true"), p.add_argument("--rescore", action="store_true")
    s = sub.add_parser("stage2")
    s.add_argument("action", choices=("fit", "predict"))
    v = sub.add_parser("validate")
    v.add_argument("matches"), v.add_argument("--candidates"), v.add_argument("--check-ids", action="store_true")
    e = sub.add_parser("eda")
    e.add_argument("--max-rows", type=int)
    tp = sub.add_parser("tune-post")
    tp.add_argument("--tau", type=float, default=0.7)
    b = sub.add_parser("block-eval")
    b.add_argument("--presets", nargs="*", default=["v8", "v16", "v17"])
    pt = sub.add_parser("patch")
    pt.add_argument("--strip-prefix", required=True), pt.add_argument("--split", default="test"), pt.add_argument("--rescore", action="store_true")
    return ap


def run(spark: SparkSession, args: argparse.Namespace, paths: Paths) -> int:
    """Run one command; its report goes to standard output as JSON. The exit code is 1 if a check failed."""
    out: object = None
    if args.command == "normalize":
        made = pipeline.normalize(spark, paths, n_rows=args.max_rows, force=args.force, strip_prefix=tuple(w for w in args.strip_prefix.lower().split(",") if w))
        out = {name: df.count() for name, df in made.items()}
    elif args.command == "train":
        out = pipeline.train(spark, paths, pipeline.TrainOptions(args.blocking, args.n_train, args.n_valid, args.siblings, args.post, args.force))
    elif args.command == "predict":
        weights = tuple(float(w) for w in args.blend_weights.split(",")) if args.blend_weights else None
        by_country = {c: float(x) for c, x in (spec.split("=") for spec in args.tau_country)}
        out = pipeline.predict(spark, paths, pipeline.PredictOptions(
            args.tau, args.post, args.assign, args.assign_margin, tuple(args.blend), weights, by_country, tuple(args.blank_country),
            args.blank_kmax, args.blank_pmax, args.blank_1src, args.blank_numdiff, args.force, args.rescore,
        ))
    elif args.command == "stage2":
        if args.action == "fit":
            out = pipeline.stage2_fit(spark, paths)
        else:
            pipeline.stage2_predict(spark, paths).write.mode("overwrite").parquet(f"{paths.work}/model/stage2_scored")
    elif args.command == "validate":
        sources = {k: read_source(spark, p) for k, p in paths.sources("test").items()}
        known = sources["s2"].unionByName(sources["s3"]) if args.check_ids else None
        found = validate.validate_submission(spark, args.matches, args.candidates, sources["s1"], known)
        print(json.dumps({"errors": found.errors, "warnings": found.warnings, "rows": found.rows}, ensure_ascii=False))
        return found.exit_code
    elif args.command == "eda":
        sections = {}
        for split in ("train", "test"):
            for k, path in paths.sources(split).items():
                df = read_source(spark, path, args.max_rows)
                sections[f"{split} {k}"] = {**df.transform(diagnostics.id_stats).first().asDict(), **{f"{r['country']}": str(r.asDict()) for r in diagnostics.source_stats(df).collect()}}
        sections["truth"] = diagnostics.truth_stats(read_ground_truth(spark, paths.ground_truth)).first().asDict()
        write_json(spark, sections, f"{paths.output}/eda_report.json")
        write_text(spark, markdown_report("Sources", sections), f"{paths.output}/eda_report.md")
        out = {"written": f"{paths.output}/eda_report.json"}
    elif args.command == "tune-post":
        home = f"{paths.work}/model"
        scored = spark.read.parquet(f"{home}/valid_scored")
        truth = read_ground_truth(spark, paths.ground_truth).join(scored.select(pipeline.G).distinct(), pipeline.G, "left_semi")
        out = pipeline.tune_post(scored, spark.read.parquet(f"{home}/train_clean"), spark.read.parquet(f"{home}/train_pool"), truth, args.tau)
    elif args.command == "block-eval":
        clean, pool = pipeline.load(spark, paths, "train")
        pairs = explode_ground_truth(read_ground_truth(spark, paths.ground_truth))
        ids = clean.select(F.col("entity_id").alias(pipeline.G))
        rarest = diagnostics.rarest_shared_keys(blocking.hashed_keys(clean), blocking.pool_keys(pool, 2000), pairs)
        out = {"coverage": [r.asDict() for r in diagnostics.key_coverage(rarest, pairs, (max(CAPS.values()), 2000)).collect()]}
        for name in args.presets:
            cands = blocking.generate_candidates(clean, pool, PRESETS[name])
            missed = sampling.example_pairs(diagnostics.missed_pairs(cands, pairs), clean, pool, 20)
            out[name] = {**blocking.blocking_recall(cands, pairs, ids).first().asDict(), "missed": [r.asDict() for r in missed.collect()]}
    elif args.command == "patch":
        clean, pool, affected = pipeline.patched(spark, paths, tuple(args.strip_prefix.lower().split(",")), args.split)
        clean.write.mode("overwrite").parquet(f"{paths.work}/patched/{args.split}_clean")
        pool.write.mode("overwrite").parquet(f"{paths.work}/patched/{args.split}_pool")
        out = {"affected": affected.count()}
        if args.rescore:
            out["scored"] = pipeline.rescore_patched(spark, paths, tuple(args.strip_prefix.lower().split(",")), args.split).count()
    print(json.dumps(out, ensure_ascii=False, default=str))
    return 0


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    given = {k: v for k, v in (("data", args.data_dir), ("work", args.work_dir), ("output", args.output_dir)) if v}
    spark = SparkSession.builder.appName(f"kinloom {args.command}").getOrCreate()
    ship_package(spark)
    return run(spark, args, Paths(**given))


if __name__ == "__main__":
    sys.exit(main())
