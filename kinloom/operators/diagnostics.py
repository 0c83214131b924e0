"""Statistics of sources, truth, candidates and predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

G = "source1_entity_id"
#: Edges of probability bands.
RIGHT_CLOSED = (0.3, 0.5, 0.7, 0.8, 0.9, 0.97)
RIGHT_LABELS = ("<.3", ".3-.5", ".5-.7", ".7-.8", ".8-.9", ".9-.97", ">.97")
LEFT_CLOSED = ((0.1, 0.3), (0.3, 0.5), (0.5, 0.6), (0.6, 0.7), (0.7, 0.8), (0.8, 0.9), (0.9, 0.99), (0.99, 1.01))
INDIC = r"[\x{0900}-\x{0D7F}]"
CATEGORIES = ("singleton_fp", "missed_all", "mixed", "false_merge_only", "missed_some", "perfect")


def _share(condition: Column) -> Column:
    return F.round(100 * F.avg(condition.cast("double")), 2)


def source_stats(df: DataFrame) -> DataFrame:
    """Per country: rows, empty fields, scripts, digits, domains, mean lengths. One aggregation."""
    name, addr = F.coalesce("business_name", F.lit("")), F.coalesce("business_address", F.lit(""))
    return df.groupBy("country").agg(
        F.count("*").alias("n_rows"),
        _share(F.trim(name) == "").alias("name_empty"),
        _share(F.trim(addr) == "").alias("addr_empty"),
        _share(F.lower(addr).rlike(r"\bnull\b")).alias("addr_has_null_literal"),
        _share(name.rlike(INDIC)).alias("name_indic_script"),
        _share(addr.rlike(INDIC)).alias("addr_indic_script"),
        _share(name.rlike(r"[\x{00C0}-\x{024F}]")).alias("name_accented_latin"),
        _share(name.rlike(r"[^\x00-\x7F]")).alias("name_any_non_ascii"),
        _share(addr.rlike(r"\d")).alias("addr_has_digit"),
        _share(addr.rlike(r"(^|\D)\d{5}(\D|$)")).alias("addr_5digit_token"),
        _share(addr.rlike(r"(^|\D)\d{6}(\D|$)")).alias("addr_6digit_token"),
        _share(name.rlike(r"(?i)(\.com|\.in|\.fr|www\.)")).alias("name_has_domain"),
        F.round(F.avg(F.char_length(name)), 2).alias("name_len_mean"),
        F.round(F.avg(F.char_length(addr)), 2).alias("addr_len_mean"),
    )


def id_stats(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count("*").alias("n_rows"), F.countDistinct("entity_id").alias("unique_ids"), (F.count("*") - F.countDistinct("entity_id")).alias("duplicate_id_rows"), F.count_if(F.col("country").isNull()).alias("country_null")
    )


def truth_distribution(truth: DataFrame, most: int = 10) -> DataFrame:
    """``k, n``: clean records by number of matches, the last bin open."""
    return truth.groupBy(F.least("n_matches", F.lit(most)).alias("k")).agg(F.count("*").alias("n"))


def truth_stats(truth: DataFrame) -> DataFrame:
    """One row on the truth: singletons, matches per record and source, exclusivity, prefixes."""
    in_source = lambda s: F.size(F.filter("matched", lambda x: x.startswith(s)))
    per = truth.withColumns({"n_s2": in_source("S2-"), "n_s3": in_source("S3-")}).agg(
        F.count("*").alias("s1_rows"), (F.count("*") - F.countDistinct(G)).alias("duplicate_s1_rows"), _share(F.col("n_matches") == 0).alias("singleton_rate_pct"),
        F.round(F.avg("n_matches"), 3).alias("matches_mean"), F.median("n_matches").alias("matches_median"), F.max("n_matches").alias("matches_max"),
        F.round(F.avg("n_s2"), 3).alias("s2_per_s1_mean"), F.round(F.avg("n_s3"), 3).alias("s3_per_s1_mean"), _share(F.col("n_s2") == 0).alias("pct_no_s2"), _share(F.col("n_s3") == 0).alias("pct_no_s3"),
    )
    pairs = truth.select(F.explode("matched").alias("id")).groupBy("id").agg(F.count("*").alias("n"))
    ids = pairs.agg(
        F.sum("n").alias("positive_pairs"), F.count("*").alias("distinct_matched_ids"), F.count_if(F.col("n") > 1).alias("ids_in_more_than_one"), F.coalesce(F.sum(F.when(~F.col("id").rlike("^S[23]-"), F.col("n"))), F.lit(0)).alias("bad_prefix")
    )
    return per.crossJoin(ids)  # one row each


def matches_by_country(truth: DataFrame, clean: DataFrame) -> DataFrame:
    """Per country of the clean records with known truth: records, rate of those without match, mean matches."""
    country = clean.select(F.col("entity_id").alias(G), "country").distinct()
    return truth.join(country, G).groupBy("country").agg(F.count("*").alias("n_s1"), _share(F.col("n_matches") == 0).alias("singleton_rate_pct"), F.round(F.avg("n_matches"), 3).alias("matches_mean"))


def size_ratios(first: DataFrame, second: DataFrame) -> DataFrame:
    """Per country: rows of either table and the ratio of the second to the first, null where the first has none."""
    a, b = (df.groupBy("country").agg(F.count("*").alias(n)) for df, n in ((first, "n_first"), (second, "n_second")))
    d = a.join(b, "country", "full").fillna(0, ["n_first", "n_second"])
    return d.withColumn("ratio", F.round(F.col("n_second") / F.nullif("n_first", F.lit(0)), 4))


def coverage(pool: DataFrame, truth_pairs: DataFrame) -> DataFrame:
    """Per source and country: records and the share of them that is matched to some clean record."""
    hit = truth_pairs.select(F.col("matched_id").alias("entity_id")).distinct().withColumn("hit", F.lit(1))
    d = pool.select("entity_id", "country").join(hit, "entity_id", "left")
    return d.groupBy(F.substring("entity_id", 1, 2).alias("src"), "country").agg(F.count("*").alias("n_rows"), F.round(100 * F.count("hit") / F.count("*"), 2).alias("pct_matched"))


def country_mismatches(truth_pairs: DataFrame, clean: DataFrame, pool: DataFrame) -> DataFrame:
    c1 = clean.select(F.col("entity_id").alias(G), F.col("country").alias("c1"))
    c2 = pool.select(F.col("entity_id").alias("matched_id"), F.col("country").alias("c2"))
    return truth_pairs.join(c1, G).join(c2, "matched_id").agg(F.count("*").alias("n_pairs"), F.count_if(F.col("c1") != F.col("c2")).alias("n_mismatch"))


def band_right_closed(p: Column) -> Column:
    band = F.when(p <= RIGHT_CLOSED[0], RIGHT_LABELS[0])
    for edge, label in zip(RIGHT_CLOSED[1:], RIGHT_LABELS[1:]):
        band = band.when(p <= edge, label)
    return band.otherwise(RIGHT_LABELS[-1])


def band_shares(scored: DataFrame) -> DataFrame:
    """Per country the share of pairs in each band, as columns."""
    counts = scored.withColumn("band", band_right_closed(F.col("p"))).groupBy("country", "band").agg(F.count("*").alias("n"))
    shares = counts.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("country")), 4))
    return shares.groupBy("country").pivot("band", list(RIGHT_LABELS)).agg(F.first("share"))


def bands_left_closed(scored: DataFrame, n_entities: int) -> DataFrame:
    """Pairs per clean record and, where labelled, their precision, by band."""
    band = F.lit(None).cast("string")
    for lo, hi in reversed(LEFT_CLOSED):
        band = F.when((F.col("p") >= lo) & (F.col("p") < hi), F.lit(f"{lo:.2f}-{min(hi, 1):.2f}")).otherwise(band)
    d = scored.withColumn("band", band).where("band is not null").groupBy("band")
    return d.agg(F.round(F.count("*") / F.lit(max(n_entities, 1)), 6).alias("pairs_per_s1"), F.round(F.avg("y"), 6).alias("precision"))


def prediction_counts(selected: DataFrame, entities: DataFrame) -> DataFrame:
    """``G, country, n_pred`` for every clean record."""
    counts = selected.groupBy(G).agg(F.count("*").alias("n_pred"))
    return entities.join(counts, G, "left").withColumn("n_pred", F.coalesce("n_pred", F.lit(0)))


def prediction_summary(per: DataFrame, label: str) -> DataFrame:
    return per.groupBy("country").agg(
        F.count("*").alias("s1"), F.round(F.avg("n_pred"), 3).alias("pred_per_s1"), F.round(F.avg((F.col("n_pred") == 0).cast("double")), 4).alias("share_0"), F.round(F.avg((F.col("n_pred") >= 6).cast("double")), 4).alias("share_6plus")
    ).withColumn("split", F.lit(label))


def cell_labels(entities: DataFrame, cells: DataFrame) -> DataFrame:
    """``G, country, cell``: size of the match set, best p, sources and agreement of numbers in one label."""
    size = F.when(F.col("k") >= 3, "k3+").otherwise(F.concat(F.lit("k"), F.col("k").cast("string")))
    best = F.when(F.col("pmax") >= 0.99, "p>=.99").when(F.col("pmax") >= 0.95, "p.95-.99").otherwise("p<.95")
    label = F.concat_ws(" ", size, best, F.when(F.col("nsrc") >= 2, "2src").otherwise("1src"), F.when(F.col("num_ok"), "num_ok").otherwise("num_diff"))
    d = entities.join(cells, G, "left")
    return d.select(G, "country", F.when(F.col("k").isNull(), "k0").otherwise(label).alias("cell"))


def cell_gain(test_cells: DataFrame, valid_cells: DataFrame) -> DataFrame:
    """Per country and cell: share in test and validation and the gain of predicting nothing there. ``valid_cells`` with f05, is_singleton."""
    share = lambda: F.count("*") / F.sum(F.count("*")).over(Window.partitionBy("country"))
    t = test_cells.groupBy("country", "cell").agg(share().alias("test_share"))
    v = valid_cells.groupBy("country", "cell").agg(share().alias("val_share"), F.avg(F.col("is_singleton").cast("double")).alias("val_nomatch"), F.avg("f05").alias("val_f05"))
    d = t.join(v, ["country", "cell"], "left").fillna(0.0, ["val_share", "val_nomatch", "val_f05"])
    excess = F.greatest(1 - F.col("val_share") / F.col("test_share"), F.lit(0.0))
    return d.withColumn("gain_if_blank", F.round(F.col("test_share") * (excess + (1 - excess) * (F.col("val_nomatch") - F.col("val_f05"))), 6))


def contested(scored: DataFrame, tau: float) -> DataFrame:
    """Per clean record with pairs at or above tau: ``contested, won, lost, kept``."""
    w = Window.partitionBy("cand_id")
    hi = scored.where(F.col("p") >= tau).withColumns({"claims": F.count("*").over(w), "wins": F.col("p") == F.max("p").over(w)})
    many = F.col("claims") >= 2
    return hi.groupBy(G, "country").agg(
        F.bool_or(many).alias("contested"), F.count_if(F.col("wins") & many).alias("won"), F.count_if(~F.col("wins") & many).alias("lost"), F.count_if(F.col("wins")).alias("kept")
    )


def contest_shares(contests: DataFrame, entities: DataFrame, split: str) -> DataFrame:
    """Per country of a split: clean records, share of them in a contest, and contested claims won and lost for each such record."""
    d = entities.select(G, "country").distinct().join(contests.drop("country"), G, "left").fillna(False, ["contested"])
    mine = F.col("contested")
    return d.groupBy("country").agg(
        F.count("*").alias("n_s1"), F.round(F.avg(mine.cast("double")), 4).alias("contested"), F.round(F.avg(F.when(mine, F.col("won"))), 4).alias("won"), F.round(F.avg(F.when(mine, F.col("lost"))), 4).alias("lost")
    ).withColumn("split", F.lit(split))


def contested_pairs(scored: DataFrame, tau: float) -> DataFrame:
    """Pairs of clean records that claim the same candidates: ``G, other, country, shared, a_wins, b_wins``."""
    w = Window.partitionBy("cand_id")
    c = scored.where(F.col("p") >= tau).withColumns({"claims": F.count("*").over(w), "wins": (F.col("p") == F.max("p").over(w)).cast("int")}).where("claims >= 2")
    other = c.select("cand_id", F.col(G).alias("other"), F.col("wins").alias("other_wins"))
    return c.join(other, "cand_id").where(F.col(G) < F.col("other")).groupBy(G, "other", "country").agg(F.count("*").alias("shared"), F.sum("wins").alias("a_wins"), F.sum("other_wins").alias("b_wins"))


def lookalike_flags(clean: DataFrame, near: int = 30, most: int = 50) -> DataFrame:
    """``G, country, same_name, near, dup``: other records of the same name, with a close or the same first number. Names of more than
    ``most`` records are left out by definition."""
    d = clean.select(F.col("entity_id").alias(G), "country", "name_core", F.get("addr_numbers", F.lit(0)).try_cast("bigint").alias("n1"))
    named = d.where(F.char_length("name_core") >= 3)
    sizes = named.groupBy("country", "name_core").agg(F.count("*").alias("n")).where(F.col("n").between(2, most)).drop("n")
    named = named.join(sizes, ["country", "name_core"])
    other = named.select("country", "name_core", F.col(G).alias("other"), F.col("n1").alias("n2"))
    j = named.join(other, ["country", "name_core"]).where(F.col(G) != F.col("other")).withColumn("dn", F.abs(F.col("n1") - F.col("n2")))
    flags = j.groupBy(G).agg(F.lit(True).alias("same_name"), F.coalesce(F.bool_or(F.col("dn").between(1, near)), F.lit(False)).alias("near"), F.coalesce(F.bool_or(F.col("dn") == 0), F.lit(False)).alias("dup"))
    return d.select(G, "country").join(flags, G, "left").fillna(False, ["same_name", "near", "dup"])


def rate_by_flag(flags: DataFrame, counts: DataFrame, count_col: str) -> DataFrame:
    """Per country: share of each flag and the rate of records without match overall and within each flag."""
    d = flags.join(counts.select(G, count_col), G, "left").withColumn("none", (F.coalesce(F.col(count_col), F.lit(0)) == 0).cast("double"))
    names = ("same_name", "near", "dup")
    return d.groupBy("country").agg(
        F.count("*").alias("n_s1"), *(F.round(F.avg(F.col(n).cast("double")), 4).alias(n) for n in names), F.round(F.avg("none"), 4).alias("nomatch_all"), *(F.round(F.avg(F.when(F.col(n), F.col("none"))), 4).alias(f"nomatch_{n}") for n in names)
    )


def count_distribution(df: DataFrame, column: str, name: str, most: int = 6) -> DataFrame:
    """Per country the share of records by clipped count."""
    n = df.groupBy("country", F.least(column, F.lit(most)).alias("k")).agg(F.count("*").alias("n"))
    return n.withColumn(name, F.round(F.col("n") / F.sum("n").over(Window.partitionBy("country")), 4)).drop("n")


def token_rates(df: DataFrame, where: str) -> DataFrame:
    """``tok, per_100k``: records per 100,000 with the word first, last or anywhere."""
    tok = {"first": F.array(F.get("name_tokens", F.lit(0))), "last": F.array(F.get("name_tokens", F.size("name_tokens") - 1)), "any": F.array_distinct("name_tokens")}[where]
    n = df.agg(F.count("*").alias("n"))
    counts = df.select(F.explode(tok).alias("tok")).where("tok is not null").groupBy("tok").agg(F.count("*").alias("c"))
    return counts.crossJoin(F.broadcast(n)).select("tok", (F.col("c") * 100_000 / F.col("n")).alias("per_100k"))


def token_shift(train: DataFrame, test: DataFrame, where: str, least: float = 50.0) -> DataFrame:
    a, b = token_rates(train, where).withColumnRenamed("per_100k", "train"), token_rates(test, where).withColumnRenamed("per_100k", "test")
    d = b.join(a, "tok", "left").fillna(0.0, ["train"]).where(F.col("test") >= least)
    return d.select("tok", F.round("test", 4).alias("test"), F.round("train", 4).alias("train"), F.round(F.col("test") - F.col("train"), 4).alias("excess"), F.round(F.col("test") / (F.col("train") + 5), 6).alias("ratio"))


def error_categories(per: DataFrame, truth_pairs: DataFrame, cands: DataFrame) -> DataFrame:
    """Per clean record: category of its error, loss, false and missed pairs, and those lost before scoring. ``per`` as of ``f05_per_entity``."""
    lost = truth_pairs.join(cands.select(G, F.col("cand_id").alias("matched_id")), [G, "matched_id"], "left_anti").groupBy(G).agg(F.count("*").alias("n_block_miss"))
    d = per.withColumns({"n_fp": F.size(F.array_except("ids", "matched")), "n_fn": F.size(F.array_except("matched", "ids")), "loss": 1 - F.col("f05")})
    d = d.join(lost, G, "left").withColumn("n_block_miss", F.coalesce("n_block_miss", F.lit(0)))
    category = (
        F.when(F.col("is_singleton") & (F.col("n_fp") > 0), "singleton_fp").when(~F.col("is_singleton") & (F.size("ids") == 0), "missed_all")
        .when((F.col("n_fp") > 0) & (F.col("n_fn") > 0), "mixed").when(F.col("n_fp") > 0, "false_merge_only").when(F.col("n_fn") > 0, "missed_some").otherwise("perfect")
    )
    return d.withColumn("category", category)


def error_summary(errors: DataFrame) -> DataFrame:
    """Per category: records, share of the loss, false, missed and blocked pairs."""
    every = Window.partitionBy(F.lit(0))  # over at most six rows
    g = errors.groupBy("category").agg(F.count("*").alias("entities"), F.sum("loss").alias("loss"), F.sum("n_fp").alias("false_pairs"), F.sum("n_fn").alias("missed_pairs"), F.sum("n_block_miss").alias("missed_by_blocking"))
    return g.select(
        "category", "entities", F.round(F.col("loss") / F.sum("entities").over(every), 5).alias("points_lost"), F.round(F.col("loss") / F.greatest(F.sum("loss").over(every), F.lit(1e-12)), 3).alias("share_of_loss"), "false_pairs", "missed_pairs", "missed_by_blocking"
    )


def error_by_country(errors: DataFrame) -> DataFrame:
    """Points lost per country, one column per category."""
    per = errors.groupBy("country").agg(F.count("*").alias("n"))
    lost = errors.groupBy("country").pivot("category", list(CATEGORIES)).agg(F.sum("loss"))
    return lost.join(per, "country").select("country", *(F.round(F.coalesce(c, F.lit(0.0)) / F.col("n"), 5).alias(c) for c in CATEGORIES))


def unclaimed(pool: DataFrame, selected: DataFrame, scored: DataFrame) -> DataFrame:
    """Pool records without clean record: ``cand_id, best_p, best_s1`` (null where they are in no candidate list)."""
    free = pool.select(F.col("entity_id").alias("cand_id")).distinct().join(selected.select("cand_id"), "cand_id", "left_anti")
    best = scored.groupBy("cand_id").agg(F.max("p").alias("best_p"))
    owner = scored.join(best, "cand_id").where(F.col("p") == F.col("best_p")).groupBy("cand_id").agg(F.min(G).alias("best_s1"))
    return free.join(best, "cand_id", "left").join(owner, "cand_id", "left")


def pool_density(clean: DataFrame, pool: DataFrame) -> DataFrame:
    """Per country and source: pool records, clean records, and pool records for each clean one."""
    n = clean.groupBy("country").agg(F.countDistinct("entity_id").alias("n_s1"))
    p = pool.groupBy("country", F.substring("entity_id", 1, 2).alias("source")).agg(F.countDistinct("entity_id").alias("n_pool"))
    return p.join(n, "country", "left").fillna(0, ["n_s1"]).withColumn("per_s1", F.round(F.col("n_pool") / F.nullif("n_s1", F.lit(0)), 4))


def unclaimed_bands(free: DataFrame, pool: DataFrame) -> DataFrame:
    """Per country and source of unclaimed pool records: their number, the share in some candidate list, and shares by band of the best p."""
    d = free.join(pool.select(F.col("entity_id").alias("cand_id"), "country").distinct(), "cand_id").withColumn("band", band_right_closed(F.col("best_p")))
    bands = [F.round(F.avg((F.coalesce(F.col("band") == label, F.lit(False)) & F.col("best_p").isNotNull()).cast("double")), 4).alias(f"b{i}") for i, label in enumerate(RIGHT_LABELS)]
    return d.groupBy("country", F.substring("cand_id", 1, 2).alias("source")).agg(F.count("*").alias("n_free"), F.round(F.avg(F.col("best_p").isNotNull().cast("double")), 4).alias("in_lists"), *bands)


def key_coverage(rarest: DataFrame, truth_pairs: DataFrame, caps: tuple[int, ...]) -> DataFrame:
    """``cap, true_pairs, covered, share``: true pairs that share a block of at most ``cap`` records. ``rarest``: as of ``rarest_shared_keys``."""
    n = truth_pairs.agg(F.count("*").alias("true_pairs"))
    held = rarest.agg(*(F.count_if(F.col("df") <= cap).alias(f"c{cap}") for cap in caps)).crossJoin(n)  # one row
    rows = held.select("true_pairs", F.explode(F.array(*(F.struct(F.lit(cap).alias("cap"), F.col(f"c{cap}").alias("covered")) for cap in caps))).alias("x"))
    return rows.select("x.cap", "true_pairs", "x.covered", F.round(F.col("x.covered") / F.greatest("true_pairs", F.lit(1)), 4).alias("share"))


def missed_pairs(cands: DataFrame, truth_pairs: DataFrame) -> DataFrame:
    """True pairs that are in no candidate list: ``source1_entity_id, cand_id``."""
    # a written table of candidates is several times its file in memory: never a broadcast
    return truth_pairs.withColumnRenamed("matched_id", "cand_id").join(cands.select(G, "cand_id").hint("merge"), [G, "cand_id"], "left_anti").select(G, "cand_id").distinct()


def rarest_shared_keys(keys_clean: DataFrame, pool_keys: DataFrame, truth_pairs: DataFrame) -> DataFrame:
    """Per true pair the smallest block it shares and its type: ``G, matched_id, t, df``; absent where it shares none."""
    mine = truth_pairs.join(keys_clean.select(F.col("id").alias(G), "h"), G)
    shared = mine.join(pool_keys.withColumnRenamed("cand_id", "matched_id"), ["matched_id", "h"])
    return shared.groupBy(G, "matched_id").agg(F.min(F.struct("df", "t")).alias("m")).select(G, "matched_id", F.col("m.t").alias("t"), F.col("m.df").alias("df"))


def legal_conflicts(pairs: DataFrame, clean: DataFrame, pool: DataFrame) -> DataFrame:
    a = clean.select(F.col("entity_id").alias(G), F.col("name_legal").alias("l1"))
    b = pool.select(F.col("entity_id").alias("cand_id"), F.col("name_legal").alias("l2"))
    l1, l2 = F.coalesce("l1", F.lit("")), F.coalesce("l2", F.lit(""))
    return pairs.join(a, G, "left").join(b, "cand_id", "left").withColumn("legal_conflict", (l1 != "") & (l2 != "") & (l1 != l2)).drop("l1", "l2")


def feature_shift(valid: DataFrame, test: DataFrame, features: tuple[str, ...]) -> DataFrame:
    """``feature, valid_mean, test_mean, shift_sd`` in one aggregation per side and one over both."""
    def wide(df: DataFrame) -> DataFrame:
        return df.select(F.explode(F.array(*(F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("v")) for f in features))).alias("x")).select("x.feature", "x.v")

    both = wide(valid).withColumn("is_test", F.lit(False)).unionByName(wide(test).withColumn("is_test", F.lit(True)))
    g = both.groupBy("feature").agg(F.avg(F.when(~F.col("is_test"), F.col("v"))).alias("valid_mean"), F.avg(F.when(F.col("is_test"), F.col("v"))).alias("test_mean"), F.stddev_samp("v").alias("sd"))
    sd = F.when(F.coalesce("sd", F.lit(0.0)) == 0, 1.0).otherwise(F.col("sd"))
    return g.select("feature", F.round("valid_mean", 6).alias("valid_mean"), F.round("test_mean", 6).alias("test_mean"), F.round((F.col("test_mean") - F.col("valid_mean")) / sd, 6).alias("shift_sd"))
