"""The 61 features of a candidate pair."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinloom.functions.similarity import similarity
from kinloom.operators.skew import spread_rank
from kinloom.session import materialize

G = "source1_entity_id"
#: The features in order.
FEATURES = (
    "bscore", "n_keytypes", "src_is_s3", "rank_in_src", "n_cands", "bscore_gap",
    "name_jw", "name_tset", "name_tsort", "name_partial", "concat_ratio", "concat_partial", "skel_ratio", "alt_tset",
    "ntok_inter", "ntok_jacc", "ntok_cont1", "ntok_cont2", "idf_shared_sum", "idf_shared_max", "idf_frac1", "idf_frac2", "idf_miss1_max",
    "idf_miss2_max", "legal_eq", "legal2_empty", "handle2", "domain2", "dba2", "indic2", "len_core1", "len_core2", "name_tset_gap",
    "addr_tset", "addr_ratio", "atok_inter", "atok_jacc", "atok_cont1", "atok_cont2", "num_inter", "num_jacc", "num_first_match",
    "n_nums1", "n_nums2", "addr_empty2", "state_overlap", "state_both", "addr_tset_gap",
    "grp_same_num", "grp_same_concat", "num_conflict", "num_delta_log", "num_delta_small", "ntok_only1", "ntok_only2", "name_one_sub",
    "grp_s1num_support", "grp_num_minority", "s1_name_freq", "cand_name_freq", "addr_empty_amb",
)
_RECORD = (
    "name_core_tokens", "name_core", "name_concat", "name_skeleton", "name_alt_core", "name_legal", "name_is_handle", "name_is_domain",
    "name_has_dba", "name_has_indic", "name_freq", "addr_tokens", "addr_numbers", "addr_clean", "addr_states", "addr_empty",
)


def add_name_freq(df: DataFrame) -> DataFrame:
    """``name_freq``: records of the whole table with the same country and joined name. Joined back, so no group is held in a window."""
    sizes = df.groupBy("country", "name_concat").agg(F.count("*").alias("name_freq"))
    return df.join(sizes, (df["country"].eqNullSafe(sizes["country"])) & (df["name_concat"] == sizes["name_concat"])).drop(sizes["country"], sizes["name_concat"])


def token_idf(*frames: DataFrame) -> DataFrame:
    """``country, tok, idf``: natural logarithm of records over records that hold the word, by country."""
    rows = None
    for f in frames:
        part = f.select("country", "name_core_tokens")
        rows = part if rows is None else rows.unionByName(part)
    n = rows.groupBy("country").agg(F.count("*").alias("n_docs"))
    df = rows.select("country", F.explode("name_core_tokens").alias("tok")).groupBy("country", "tok").agg(F.count("*").alias("df"))
    return df.join(n, "country").select("country", "tok", F.log(F.col("n_docs") / F.col("df")).alias("idf"))


def with_idf(df: DataFrame, idf: DataFrame, id_col: str = "entity_id") -> DataFrame:
    """Add ``name_idf``, an array of (tok, idf) of the record's words; an unseen word has the country's largest idf.

    The idf is looked up once per record, not once per pair.
    """
    largest = F.broadcast(idf.groupBy("country").agg(F.max("idf").alias("max_idf")))  # one row per country
    words = df.select(F.col(id_col).alias("__kl_id"), "country", F.explode("name_core_tokens").alias("tok"))
    found = words.join(idf, ["country", "tok"], "left").join(largest, "country", "left").withColumn("idf", F.coalesce("idf", "max_idf"))
    per_record = found.groupBy("__kl_id").agg(F.collect_list(F.struct("tok", "idf")).alias("name_idf"))  # a record's own words
    return df.join(per_record, df[id_col] == per_record["__kl_id"], "left").drop("__kl_id")


def attach_records(pairs: DataFrame, clean: DataFrame, pool: DataFrame, columns: tuple[str, ...] = _RECORD) -> DataFrame:
    """Pairs with the views of both records, suffix ``_1`` and ``_2``, and the clean record's country."""
    a = clean.select(F.col("entity_id").alias(G), "country", *(F.col(c).alias(f"{c}_1") for c in columns))
    b = pool.select(F.col("entity_id").alias("cand_id"), *(F.col(c).alias(f"{c}_2") for c in columns))
    return pairs.join(a, G).join(b, "cand_id")


def _size(c: str) -> Column:
    return F.coalesce(F.size(c), F.lit(0)).cast("double")


def _common(a: str, b: str) -> Column:
    return F.coalesce(F.size(F.array_intersect(a, b)), F.lit(0)).cast("double")


def _overlap(prefix: str, a: str, b: str) -> dict[str, Column]:
    common = _common(a, b)
    either = F.coalesce(F.size(F.array_union(a, b)), F.lit(0)).cast("double")
    one = F.lit(1.0)
    return {
        f"{prefix}_inter": common,
        f"{prefix}_jacc": common / F.greatest(either, one),
        f"{prefix}_cont1": common / F.greatest(_size(a), one),
        f"{prefix}_cont2": common / F.greatest(_size(b), one),
    }


def _flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("double")


def overlap_features(df: DataFrame) -> DataFrame:
    """Features of shared words, numbers, states and legal forms: all without Python."""
    n1, n2 = _size("addr_numbers_1"), _size("addr_numbers_2")
    first1, first2 = F.get("addr_numbers_1", F.lit(0)), F.get("addr_numbers_2", F.lit(0))
    df = df.withColumns({
        **_overlap("ntok", "name_core_tokens_1", "name_core_tokens_2"),
        **_overlap("atok", "addr_tokens_1", "addr_tokens_2"),
        "num_inter": _common("addr_numbers_1", "addr_numbers_2"),
        "num_jacc": _overlap("num", "addr_numbers_1", "addr_numbers_2")["num_jacc"],
        "n_nums1": n1,
        "n_nums2": n2,
        "num_first_match": _flag(F.array_contains("addr_numbers_2", first1)),
        "state_overlap": _flag(_common("addr_states_1", "addr_states_2") > 0),
        "state_both": _flag((_size("addr_states_1") > 0) & (_size("addr_states_2") > 0)),
        "legal_eq": _flag(F.col("name_legal_1") == F.col("name_legal_2")),
        "legal2_empty": _flag(F.col("name_legal_2") == ""),
        "len_core1": F.char_length("name_core_1").cast("double"),
        "len_core2": F.char_length("name_core_2").cast("double"),
        "__kl_first1": first1,
        "__kl_first2": F.coalesce(first2, F.lit("")),
    })
    one = F.expr("try_cast(__kl_first1 as bigint)")
    others = F.array_compact(F.transform("addr_numbers_2", lambda x: x.try_cast("bigint")))
    delta = F.array_min(F.transform(others, lambda x: F.abs(x - one)))
    df = df.withColumns({
        "num_conflict": _flag((F.col("n_nums1") > 0) & (F.col("n_nums2") > 0) & (F.col("num_inter") == 0)),
        "ntok_only1": _size("name_core_tokens_1") - F.col("ntok_inter"),
        "ntok_only2": _size("name_core_tokens_2") - F.col("ntok_inter"),
        "__kl_delta": delta,
        "__kl_has1": F.coalesce(F.array_contains("addr_numbers_2", F.col("__kl_first1")), F.lit(False)),
    })
    return df.withColumns({
        "num_delta_log": F.coalesce(F.log10(F.col("__kl_delta") + 1), F.lit(-1.0)),
        "num_delta_small": _flag(F.col("__kl_delta").between(1, 30)),
        "name_one_sub": _flag((F.col("ntok_only1") == 1) & (F.col("ntok_only2") == 1)),
    })


def idf_features(df: DataFrame) -> DataFrame:
    """Overlap weighted by rarity, from ``name_idf_1`` and ``name_idf_2``; words of a record are distinct, so arrays suffice."""
    a, b = F.coalesce("name_idf_1", F.array().cast("array<struct<tok:string,idf:double>>")), F.coalesce("name_idf_2", F.array().cast("array<struct<tok:string,idf:double>>"))

    def held(x, words: str):
        return F.coalesce(F.array_contains(F.col(words), x["tok"]), F.lit(False))

    def total(items: Column) -> Column:
        return F.aggregate(items, F.lit(0.0), lambda acc, x: acc + x["idf"])

    def most(items: Column) -> Column:
        return F.coalesce(F.array_max(F.transform(items, lambda x: x["idf"])), F.lit(0.0))

    shared = F.filter(a, lambda x: held(x, "name_core_tokens_2"))
    least = F.lit(1e-6)
    return df.withColumns({
        "idf_shared_sum": total(shared),
        "idf_shared_max": most(shared),
        "idf_frac1": total(shared) / F.greatest(total(a), least),
        "idf_frac2": total(shared) / F.greatest(total(b), least),
        "idf_miss1_max": most(F.filter(a, lambda x: ~held(x, "name_core_tokens_2"))),
        "idf_miss2_max": most(F.filter(b, lambda x: ~held(x, "name_core_tokens_1"))),
    })


def similarity_features(df: DataFrame) -> DataFrame:
    """Features of the string kernels."""
    def sim(kernel: str, a: str, b: str, scale: float = 100.0) -> Column:
        return similarity(kernel, F.col(f"{a}_1"), F.col(f"{b}_2")) / scale

    return df.withColumns({
        "name_jw": sim("jaro_winkler", "name_core", "name_core", 1.0),
        "name_tset": sim("token_set_ratio", "name_core", "name_core"),
        "name_tsort": sim("token_sort_ratio", "name_core", "name_core"),
        "name_partial": sim("partial_ratio", "name_core", "name_core"),
        "concat_ratio": sim("ratio", "name_concat", "name_concat"),
        "concat_partial": sim("partial_ratio", "name_concat", "name_concat"),
        "skel_ratio": sim("ratio", "name_skeleton", "name_skeleton"),
        "alt_tset": sim("token_set_ratio", "name_core", "name_alt_core"),
        "addr_tset": sim("token_set_ratio", "addr_clean", "addr_clean"),
        "addr_ratio": sim("ratio", "addr_clean", "addr_clean"),
    })


def group_features(df: DataFrame) -> DataFrame:
    """Features of a candidate among all candidates of its clean record.

    What concerns a whole record is aggregated, combined before the shuffle, and joined back; no record with very many candidates is one
    task's work. Needs ``source, bscore, name_tset, addr_tset, name_concat_2`` and what ``overlap_features`` notes of numbers.
    """
    number, name = ["__kl_first2"], ["name_concat_2"]
    has1 = F.col("__kl_has1").cast("double")
    whole = df.groupBy(G).agg(F.count("*").cast("double").alias("n_cands"), F.max("bscore").alias("__kl_b"), F.max("name_tset").alias("__kl_nt"), F.max("addr_tset").alias("__kl_at"), F.sum(has1).alias("__kl_s"))
    by_number = df.where("__kl_first2 <> ''").groupBy(G, *number).agg((F.count("*") - 1).cast("double").alias("__kl_num"))
    by_name = df.groupBy(G, *name).agg((F.count("*") - 1).cast("double").alias("grp_same_concat"))
    df = spread_rank(df, [G, "source"], "bscore", "cand_id", "rank_in_src")
    df = df.join(whole, G).join(by_number, [G, *number], "left").join(by_name, [G, *name])
    df = df.withColumns({
        "bscore_gap": F.col("__kl_b") - F.col("bscore"),
        "name_tset_gap": F.col("__kl_nt") - F.col("name_tset"),
        "addr_tset_gap": F.col("__kl_at") - F.col("addr_tset"),
        "grp_s1num_support": F.col("__kl_s") - has1,
        "rank_in_src": F.col("rank_in_src").cast("double"),
        "grp_same_num": F.coalesce("__kl_num", F.lit(0.0)),
    })
    minority = ~F.col("__kl_has1") & F.col("__kl_first1").isNotNull() & (F.col("grp_s1num_support") > 0)
    return df.withColumn("grp_num_minority", _flag(minority)).drop("__kl_b", "__kl_nt", "__kl_at", "__kl_s", "__kl_num")


def compute_features(pairs: DataFrame, clean: DataFrame, pool: DataFrame, idf: DataFrame) -> DataFrame:
    """``source1_entity_id, cand_id, source, country`` and the features as doubles. ``clean`` and ``pool`` hold views and ``name_freq``."""
    columns = (*_RECORD, "name_idf")
    df = attach_records(pairs, with_idf(clean, idf), with_idf(pool, idf), columns)
    df = df.withColumns({
        "src_is_s3": _flag(F.col("source") == "S3"),
        "handle2": _flag(F.col("name_is_handle_2")),
        "domain2": _flag(F.col("name_is_domain_2")),
        "dba2": _flag(F.col("name_has_dba_2")),
        "indic2": _flag(F.col("name_has_indic_2")),
        "addr_empty2": _flag(F.col("addr_empty_2")),
        "s1_name_freq": F.log10(F.col("name_freq_1").cast("double") + 1),
        "cand_name_freq": F.log10(F.col("name_freq_2").cast("double") + 1),
        "addr_empty_amb": _flag(F.col("addr_empty_2") & (F.col("name_freq_1") > 1)),
    })
    # the string kernels are the costly part, and the group features read the pairs several times
    df = group_features(materialize(idf_features(overlap_features(similarity_features(df))), "pair-features"))
    return df.select(G, "cand_id", "source", "country", *(F.col(f).cast("double").alias(f) for f in FEATURES))
