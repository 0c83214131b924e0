"""The linkage pipeline: normalise, train, predict. Each stage is a Parquet table that is made once and read back."""

from __future__ import annotations

import functools
from dataclasses import asdict, dataclass, field, replace

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinloom.config import PRESETS, SEED, Paths
from kinloom.functions.text import add_views
from kinloom.operators import aliases, blocking, decision, diagnostics, features, model, rules, siblings, validate
from kinloom.session import materialize
from kinloom.sources.files import cached_stage, exists, explode_ground_truth, read_ground_truth, read_json, read_source, write_id_lists, write_json

G = "source1_entity_id"
RAW = ("entity_id", "business_name", "business_address", "country")


@dataclass(frozen=True)
class TrainOptions:
    preset: str = "v17"
    n_train: int = 300_000
    n_valid: int = 100_000
    sibling_share: float = 0.9
    post: str = "conflict_p90"
    force: bool = False
    seed: int = SEED
    boosting: model.Boosting = field(default_factory=model.Boosting)


@dataclass(frozen=True)
class PredictOptions:
    tau: float | None = 0.7
    post: str = "conflict_p90"
    assign: str = "joint"
    assign_margin: float = 0.02
    blend_dirs: tuple[str, ...] = ()
    blend_weights: tuple[float, ...] | None = None
    tau_country: dict[str, float] = field(default_factory=dict)
    blank_country: tuple[str, ...] = ()
    blank_k_max: int | None = None
    blank_p_max: float = 0.9
    blank_one_source: bool = False
    blank_numbers_differ: bool = False
    force: bool = False
    rescore: bool = False


def normalize(spark: SparkSession, paths: Paths, splits: tuple[str, ...] = ("train", "test"), n_rows: int | None = None, force: bool = False, strip_prefix: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """All views of every source file, as ``work/normalized/<split>_<source>``."""
    out = {}
    for split in splits:
        for source, path in paths.sources(split).items():
            name = f"{split}_{source}"
            out[name] = cached_stage(spark, f"{paths.work}/normalized/{name}", lambda path=path: add_views(read_source(spark, path, n_rows), strip_prefix=strip_prefix), force)
    return out


def load(spark: SparkSession, paths: Paths, split: str) -> tuple[DataFrame, DataFrame]:
    """(clean records, pool) of a split, with views."""
    read = lambda s: spark.read.parquet(f"{paths.work}/normalized/{split}_{s}")
    return read("s1"), read("s2").unionByName(read("s3"))


def train(spark: SparkSession, paths: Paths, options: TrainOptions = TrainOptions()) -> dict:
    """Aliases, candidates, features, model, decision rule; everything under ``work/model``. Gives the report."""
    home, cfg = f"{paths.work}/model", PRESETS[options.preset]
    clean, pool = load(spark, paths, "train")
    truth = read_ground_truth(spark, paths.ground_truth)
    pairs = explode_ground_truth(truth)
    alias_path = f"{home}/aliases.json"
    if options.force or not exists(spark, f"{alias_path}/_SUCCESS"):
        aliases.save_aliases(aliases.learn_aliases(clean, pool, pairs), alias_path)
    known = aliases.load_aliases(spark, alias_path)
    clean, pool = aliases.apply_aliases(clean, known), aliases.apply_aliases(pool, known)
    split = model.split_entities(clean.select(F.col("entity_id").alias(G)), options.n_train, options.n_valid, seed=options.seed)
    split = cached_stage(spark, f"{home}/split", lambda: split, options.force)
    if options.sibling_share > 0:
        base = clean.join(split.where("part = 'train'").select(F.col(G).alias("entity_id")), "entity_id", "left_semi")
        made = cached_stage(spark, f"{home}/siblings", lambda: add_views(siblings.make_siblings(base, pool.select(*RAW), pairs, options.sibling_share)).select(*pool.columns), options.force)
        pool = pool.unionByName(made)
    clean, pool = features.add_name_freq(clean), features.add_name_freq(pool)
    clean = cached_stage(spark, f"{home}/train_clean", lambda: clean, options.force)
    pool = cached_stage(spark, f"{home}/train_pool", lambda: pool, options.force)
    # with a reverse search all clean records compete, else only those that are used
    used = clean.join(split.select(F.col(G).alias("entity_id")), "entity_id", "left_semi")
    cands = cached_stage(spark, f"{home}/train_cands", lambda: blocking.generate_candidates(clean if cfg.reverse_k else used, pool, cfg), options.force)
    cands = cands.join(split.select(G), G, "left_semi")
    recall = blocking.blocking_recall(cands, pairs, split).first().asDict()
    feats = cached_stage(spark, f"{home}/train_feats", lambda: model.label_pairs(features.compute_features(cands, clean, pool, features.token_idf(clean, pool)), pairs), options.force)
    data = feats.join(split, G)
    fitted = model.train_classifier(data.withColumn("held", F.col("part") == "valid"), features.FEATURES, valid="held", params=options.boosting)
    fitted.write().overwrite().save(f"{home}/model")
    scored = cached_stage(spark, f"{home}/valid_scored", lambda: model.predict(fitted, data.where("part = 'valid'")).select(G, "cand_id", "country", "y", "p"), True)
    numbers = rules.numbers_frame(clean, G, "nums1"), rules.numbers_frame(pool, "cand_id", "nums2")
    ruled = rules.apply_post(scored, *numbers, options.post)
    valid_truth = truth.join(split.where("part = 'valid'").select(G), G, "left_semi")
    best = decision.tune_decision(ruled.select(G, "cand_id", "p"), valid_truth).where("rank = 1").first().asDict()
    report = {
        "blocking": recall, "preset": options.preset, "decision": {k: v for k, v in best.items() if k != "rank" and v is not None}, "valid_auc": round(model.auc(scored), 6),
        "importance": model.importance(fitted, features.FEATURES), "n_valid": valid_truth.count(),
    }
    write_json(spark, report, f"{home}/report.json")
    write_json(spark, {"decision": report["decision"], "preset": options.preset, "features": list(features.FEATURES), "boosting": asdict(options.boosting)}, f"{home}/params.json")
    return report


def predict(spark: SparkSession, paths: Paths, options: PredictOptions = PredictOptions()) -> dict:
    """Score the test split, apply the rules in order (blend, numbers, exclusivity, thresholds, no-match), check and write the results."""
    home = f"{paths.work}/model"
    params = read_json(spark, f"{home}/params.json")
    cfg = PRESETS[params["preset"]]
    clean, pool = load(spark, paths, "test")
    known = aliases.load_aliases(spark, f"{home}/aliases.json")
    prepare = lambda df: features.add_name_freq(aliases.apply_aliases(df, known))
    c0, p0 = clean, pool
    clean = cached_stage(spark, f"{home}/test_clean", lambda: prepare(c0), options.force)
    pool = cached_stage(spark, f"{home}/test_pool", lambda: prepare(p0), options.force)
    cands = cached_stage(spark, f"{home}/test_cands", lambda: blocking.generate_candidates(clean, pool, cfg), options.force)

    def score() -> DataFrame:
        feats = features.compute_features(cands, clean, pool, features.token_idf(clean, pool))
        return model.predict(PipelineModel.load(f"{home}/model"), feats).select(G, "cand_id", "country", "p")

    scored = cached_stage(spark, f"{home}/test_scored", score, options.force or options.rescore)
    if options.blend_dirs:
        others = [spark.read.parquet(f"{d}/test_scored") for d in options.blend_dirs]
        scored = rules.blend(scored, others, list(options.blend_weights) if options.blend_weights else None)
    known_rule = {k: v for k, v in params["decision"].items() if k in ("rule", "tau", "min_p", "alpha")}
    rule = decision.Rule("threshold", options.tau) if options.tau is not None else decision.Rule(**known_rule)
    numbers = rules.numbers_frame(clean, G, "nums1"), rules.numbers_frame(pool, "cand_id", "nums2")
    scored = rules.apply_post(scored, *numbers, options.post)
    scored = rules.drop_countries(scored, list(options.blank_country))
    if rule.rule == "threshold":
        if options.assign == "joint":
            scored = rules.joint_probability(scored)
        elif options.assign != "argmax":
            scored = rules.reassign(scored, rule.tau, options.assign, options.assign_margin, clean, pool)
        if options.tau_country:
            scored = rules.remap_threshold(scored, rule.tau, options.tau_country)
    scored = cached_stage(spark, f"{home}/test_final", lambda: scored, True)
    selected = decision.decide(scored, rule)
    if options.blank_k_max is not None:
        with_p = selected.join(scored.select(G, "cand_id", "p"), [G, "cand_id"])
        selected = rules.no_match_rule(with_p, *numbers, options.blank_k_max, options.blank_p_max, options.blank_one_source, options.blank_numbers_differ).select(G, "cand_id")
    ids = clean.select(F.col("entity_id").alias(G))
    match = cached_stage(spark, f"{home}/test_matches", lambda: decision.to_lists(selected, ids), True)
    lists = decision.to_lists(cands.select(G, "cand_id"), ids)
    problems = {r["check"]: r["violations"] for r in validate.output_checks(match, lists, ids, pool).where("violations > 0").collect()}
    if problems:
        raise ValueError(f"the results break their rules: {problems}")
    write_id_lists(match, f"{paths.output}/matching_results.tsv", "matched_entity_ids")
    write_id_lists(lists, f"{paths.output}/candidate_pairs.tsv", "candidate_entity_ids")
    found = validate.validate_submission(spark, f"{paths.output}/matching_results.tsv", f"{paths.output}/candidate_pairs.tsv", clean, pool)
    if found.errors:
        raise ValueError(f"the result files break their format: {found.errors}")
    per = diagnostics.prediction_counts(selected, clean.select(F.col("entity_id").alias(G), "country"))
    return {r["country"]: r.asDict() for r in diagnostics.prediction_summary(per, "test").collect()}


def patched(spark: SparkSession, paths: Paths, strip_prefix: tuple[str, ...], split: str = "test") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Views with the honorifics in front of names dropped, made anew only for the records they concern: (clean, pool, affected clean ids)."""
    clean, pool = load(spark, paths, split)
    pattern = r"^(?:" + "|".join(strip_prefix) + r")\s+\S"

    def renew(df: DataFrame) -> DataFrame:
        hit = df.where(F.array_join("name_tokens", " ").rlike(pattern)).select(*RAW)
        return add_views(hit, strip_prefix=strip_prefix).select(*df.columns)

    new_clean, new_pool = renew(clean), renew(pool)
    cands = spark.read.parquet(f"{paths.work}/model/{split}_cands")
    return aliases.patch(clean, new_clean), aliases.patch(pool, new_pool), aliases.affected_clean(cands, new_clean, new_pool)


def rescore_patched(spark: SparkSession, paths: Paths, strip_prefix: tuple[str, ...], split: str = "test") -> DataFrame:
    """Scores after a patch of names: the candidates of the affected clean records are scored again with the patched views, all other scores kept.

    All pairs of an affected record are scored anew, as their features look at each other. Written as ``work/model/<split>_scored_patched``.
    """
    home = f"{paths.work}/model"
    clean, pool, affected = patched(spark, paths, strip_prefix, split)
    known = aliases.load_aliases(spark, f"{home}/aliases.json")
    clean, pool = (features.add_name_freq(aliases.apply_aliases(df, known)) for df in (clean, pool))
    cands = spark.read.parquet(f"{home}/{split}_cands").join(affected, G, "left_semi")
    anew = features.compute_features(cands, clean, pool, features.token_idf(clean, pool))
    anew = model.predict(PipelineModel.load(f"{home}/model"), anew).select(G, "cand_id", "country", "p")
    old = spark.read.parquet(f"{home}/{split}_scored").join(affected, G, "left_anti")
    return cached_stage(spark, f"{home}/{split}_scored_patched", lambda: old.select(*anew.columns).unionByName(anew), True)


def _owned(scored: DataFrame, key: str) -> DataFrame:
    """Of the pairs of each setting, each candidate only for the clean record with its highest p (ties: the smaller id)."""
    owner = scored.groupBy(key, "cand_id").agg(F.min(F.struct((-F.col("p")).alias("np"), F.col(G).alias(G))).alias("o"))
    return owner.select(key, F.col(f"o.{G}").alias(G), "cand_id", (-F.col("o.np")).alias("p"))


def tune_post(scored: DataFrame, clean: DataFrame, pool: DataFrame, truth: DataFrame, tau: float) -> list[dict]:
    """Per variant of the number rules: macro F0.5 at the threshold and the pairs it removes, true and false ones. Two jobs for all variants."""
    numbers = rules.numbers_frame(clean, G, "nums1"), rules.numbers_frame(pool, "cand_id", "nums2")
    flagged = materialize(rules.number_flags(scored, *numbers), "number-flags")
    ruled = functools.reduce(DataFrame.unionByName, (rules.ruled(flagged, v).select(F.lit(v).alias("variant"), G, "cand_id", "p", "y") for v in rules.VARIANTS))
    ruled = materialize(ruled, "ruled")
    settings = scored.sparkSession.createDataFrame([(v,) for v in rules.VARIANTS], "variant string")
    f05 = {r["variant"]: r["f05"] for r in decision.macro_by(_owned(ruled, "variant").where(F.col("p") >= tau), truth, settings, "variant").collect()}
    gone = scored.where(F.col("p") >= tau).select(G, "cand_id").join(ruled.where(F.col("p") < tau), [G, "cand_id"]).groupBy("variant").agg(F.sum("y").alias("t"), F.count("*").alias("n"))
    removed = {r["variant"]: r for r in gone.collect()}
    out = [{"variant": v, "f05": round(f05[v], 5), "removed_true": int(removed[v]["t"]) if v in removed else 0, "removed_false": int(removed[v]["n"] - removed[v]["t"]) if v in removed else 0} for v in rules.VARIANTS]
    return sorted(out, key=lambda r: -r["f05"])


def eval_blend(scored: DataFrame, other: DataFrame, clean: DataFrame, pool: DataFrame, truth: DataFrame, weights=(0.0, 0.25, 0.5, 0.75, 1.0), posts=("none", "conflict_p90"), taus=decision.TAUS) -> list[dict]:
    """Macro F0.5 over weights of the second model, number rules, joint probability and thresholds: one job for the whole grid."""
    numbers = rules.numbers_frame(clean, G, "nums1"), rules.numbers_frame(pool, "cand_id", "nums2")
    named: dict[str, tuple] = {}
    parts = []
    for w in weights:
        mixed = rules.blend(scored, [other], [1 - w, w])
        for post in posts:
            ruled = rules.apply_post(mixed, *numbers, post)
            for joint in (False, True):
                key = f"{w}|{post}|{joint}"
                named[key] = (w, post, joint)
                parts.append((rules.joint_probability(ruled) if joint else ruled).select(F.lit(key).alias("setting"), G, "cand_id", "p"))
    owned = _owned(functools.reduce(DataFrame.unionByName, parts), "setting")
    at = F.explode(F.filter(F.array(*map(F.lit, taus)), lambda t: F.col("p") >= t)).alias("tau")
    chosen = owned.select("setting", G, "cand_id", at).select(F.concat_ws("|", "setting", "tau").alias("setting"), G, "cand_id")
    settings = scored.sparkSession.createDataFrame([(f"{key}|{tau}",) for key in named for tau in taus], "setting string")
    out = []
    for r in decision.macro_by(chosen, truth, settings, "setting").collect():
        key, _, tau = r["setting"].rpartition("|")
        w, post, joint = named[key]
        out.append({"weight": w, "post": post, "joint": joint, "tau": float(tau), "f05": round(r["f05"], 5)})
    return sorted(out, key=lambda r: (-r["f05"], r["weight"], r["post"], r["joint"], r["tau"]))


def stage2_fit(spark: SparkSession, paths: Paths, k: int = 5, params: model.Boosting = model.Boosting()) -> dict:
    """Second stage over the validation scores: grouped cross-validation, the best threshold and number rule, and the final model."""
    from kinloom.operators.stage2 import STAGE2_FEATURES, stage2_features

    home = f"{paths.work}/model"
    scored = spark.read.parquet(f"{home}/valid_scored")
    clean, pool = spark.read.parquet(f"{home}/train_clean"), spark.read.parquet(f"{home}/train_pool")
    truth = read_ground_truth(spark, paths.ground_truth).join(scored.select(G).distinct(), G, "left_semi")
    data = cached_stage(spark, f"{home}/stage2_feats", lambda: model.label_pairs(stage2_features(scored, clean, pool), explode_ground_truth(truth)), True)
    oof = cached_stage(spark, f"{home}/stage2_oof", lambda: model.cross_validated(data, STAGE2_FEATURES, k, params=params).select(G, "cand_id", "p"), True)
    numbers = rules.numbers_frame(clean, G, "nums1"), rules.numbers_frame(pool, "cand_id", "nums2")
    grid = []
    for post in ("none", "conflict_p90"):
        ruled = rules.apply_post(oof, *numbers, post)
        for tau in (0.4, 0.5, 0.6, 0.7, 0.8):
            grid.append((decision.f05_macro(decision.to_lists(decision.choose_by_threshold(ruled, tau), truth.select(G)), truth), post, tau))
    f, post, tau = max(grid)
    final = model.train_classifier(data, STAGE2_FEATURES, params=replace(params, rounds=int(params.rounds * 1.1)))
    final.write().overwrite().save(f"{home}/stage2_model")
    report = {"f05": round(f, 5), "post": post, "tau": tau, "importance": model.importance(final, STAGE2_FEATURES)}
    write_json(spark, report, f"{home}/stage2_report.json")
    return report


def stage2_predict(spark: SparkSession, paths: Paths) -> DataFrame:
    """Test pairs with the second stage's p."""
    from kinloom.operators.stage2 import stage2_features

    home = f"{paths.work}/model"
    feats = stage2_features(spark.read.parquet(f"{home}/test_scored"), spark.read.parquet(f"{home}/test_clean"), spark.read.parquet(f"{home}/test_pool"))
    return model.predict(PipelineModel.load(f"{home}/stage2_model"), feats).select(G, "cand_id", "p")
