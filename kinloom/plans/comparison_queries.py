"""Further queries that go through the operators themselves, with the SQL that must give the same rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinloom.config import CAPS, PRESETS, Blocking
from kinloom.functions.text import INDIC, VIEWS, add_views
from kinloom.functions.vocab import LEGAL_FORMS, NAME_STOPWORDS
from kinloom.operators import aliases, blocking, decision, diagnostics, features, model, rules, sampling, stage2, validate
from kinloom.plans import linkage_queries as lq
from kinloom.session import materialize, release
from kinloom.sources.files import explode_ground_truth
from kinloom.sources.tables import table

G = lq.G


# ---------------------------------------------------------------- views of the noisy sources
def _plain_pool(spark, base) -> DataFrame:
    """Pool records whose name and address are of Latin letters with a plain decomposition, which SQL folds in the same way."""
    both = F.concat_ws(" ", "business_name", "business_address")
    return lq.pool(spark, base).where(~both.rlike(_OTHER))


#: Beyond ASCII, Latin letters of the first blocks and common quotes and dashes: the rest has no equivalent in SQL.
_OTHER = r"[^\x{0000}-\x{007F}\x{00C0}-\x{00FF}\x{2013}\x{2014}\x{2018}\x{2019}]"


def q_pool_name_views(spark, base):
    v = add_views(_plain_pool(spark, base))
    return v.select("entity_id", F.array_join("name_tokens", " ").alias("tokens"), "name_core", "name_alt_core", "name_legal", "name_concat", "name_has_dba", "name_is_domain", "name_is_handle", "name_has_indic")


def q_pool_address_views(spark, base):
    v = add_views(_plain_pool(spark, base))
    return v.select("entity_id", F.array_join(F.array_sort("addr_numbers"), " ").alias("numbers"), F.array_join(F.array_sort("addr_states"), " ").alias("states"), F.array_join(F.array_sort("addr_tokens"), " ").alias("words"), "addr_empty")


def q_pool_script_flags(spark, base):
    """Rows, and rows of an Indian script in name and address, by country and source: over the views of all records."""
    v = add_views(lq.pool(spark, base))
    return v.groupBy("country", F.substring("entity_id", 1, 2).alias("source")).agg(F.count("*").alias("n_rows"), F.count_if("name_has_indic").alias("indic_names"), F.count_if("addr_has_indic").alias("indic_addresses"))


def q_views_by_type(spark, base):
    """Views of the clean source by their type: the columns of a type are found by a loop over the schema."""
    v = add_views(lq.clean(spark, base)).select(*VIEWS)
    flags = [c for c, kind in v.dtypes if kind == "boolean"]
    return v.select(F.explode(F.array(*(F.struct(F.lit(c).alias("view"), F.col(c).alias("x")) for c in flags))).alias("e")).groupBy("e.view").agg(F.count_if("e.x").alias("n_true"))


# ---------------------------------------------------------------- blocking
def q_reverse_search(spark, base):
    """The operator with both limits on: pairs that the forward search left out and that are alike in name and address by word sets."""
    a, b = lq.simple_views(lq.clean(spark, base)), lq.simple_views(lq.pool(spark, base))
    cfg = Blocking(reverse_k=2, reverse_min_rscore=0.0, reverse_min_nscore=0.0)
    best, forward = [], []
    for s in blocking.score_slices(a, b, cfg):
        s = materialize(s.withColumn("bscore", F.round("bscore", 6)), "block-scores")
        # a pool record's best clean records of all are among its best of each slice
        best.append(materialize(blocking.best_per_candidate(s, cfg.reverse_k), "best"))
        forward.append(materialize(blocking.top_per_source(s, "bscore", 3).select(G, "cand_id"), "selected"))
        release(s)
    found = blocking.reverse_search(reduce(DataFrame.unionByName, best), reduce(DataFrame.unionByName, forward), a, b, cfg)
    return found.select(G, "cand_id", "bscore", "n_keytypes")


def q_candidates_none(spark, base):
    """Generation of candidates with selection by block score alone: number and sum of scores per record and source (which of tied ones is taken may differ)."""
    a, b = lq.simple_views(lq.clean(spark, base)), lq.simple_views(lq.pool(spark, base))
    c = blocking.generate_candidates(a, b, Blocking(select="none", final_k=6))
    return c.groupBy(G, "source").agg(F.count("*").alias("n"), F.round(F.sum("bscore"), 6).alias("total"))


def _rarest(spark, base) -> tuple[DataFrame, DataFrame]:
    pairs = explode_ground_truth(lq.truth(spark, base))
    keys = blocking.hashed_keys(lq.simple_views(lq.clean(spark, base)))
    return diagnostics.rarest_shared_keys(keys, blocking.pool_keys(lq.simple_views(lq.pool(spark, base)), 2000), pairs), pairs


def q_key_coverage(spark, base):
    rarest, pairs = _rarest(spark, base)
    return diagnostics.key_coverage(rarest, pairs, (max(CAPS.values()), 2000))


def q_missed_pairs(spark, base):
    return diagnostics.missed_pairs(lq.labelled_top(spark, base), explode_ground_truth(lq.truth(spark, base)))


# ---------------------------------------------------------------- features
def q_group_features_operator(spark, base):
    """Features among the candidates of a record, by the operator itself, with the simple views."""
    a, b = lq.simple_views(lq.clean(spark, base)), lq.simple_views(lq.pool(spark, base))
    blank = {"name_legal": F.lit(""), "addr_states": F.array().cast("array<string>")}
    cols = ("name_core_tokens", "name_core", "name_concat", "addr_tokens", "addr_numbers", "name_legal", "addr_states")
    d = features.overlap_features(features.attach_records(lq._pairs(spark, base), a.withColumns(blank), b.withColumns(blank), cols))
    # any two values per pair do for the gaps
    d = d.withColumns({"name_tset": F.col("ntok_jacc"), "addr_tset": F.col("atok_jacc")})
    names = ("rank_in_src", "n_cands", "bscore_gap", "name_tset_gap", "addr_tset_gap", "grp_same_num", "grp_same_concat", "grp_s1num_support", "grp_num_minority")
    return features.group_features(d).select(G, "cand_id", *(F.round(F.col(n), 6).alias(n) for n in names))


def q_legal_state_features(spark, base):
    """Features of legal forms and states over the full views of records in plain Latin letters."""
    a, b = add_views(lq.clean(spark, base)), add_views(_plain_pool(spark, base))
    d = features.overlap_features(features.attach_records(lq._pairs(spark, base), a, b, ("name_core_tokens", "name_core", "addr_tokens", "addr_numbers", "name_legal", "addr_states")))
    return d.select(G, "cand_id", "legal_eq", "legal2_empty", "state_overlap", "state_both", "n_nums1", "n_nums2", "len_core1", "len_core2", F.round("ntok_cont2", 6).alias("ntok_cont2"), F.round("atok_jacc", 6).alias("atok_jacc"), F.round("atok_cont1", 6).alias("atok_cont1"))


def q_stage2_clusters(spark, base):
    """Number and cluster features of the second stage with the simple views."""
    a, b = lq.simple_views(lq.clean(spark, base)), lq.simple_views(lq.pool(spark, base)).withColumn("addr_empty", (F.size("addr_tokens") == 0) & (F.size("addr_numbers") == 0))
    d = stage2.number_and_cluster_features(stage2.claim_features(lq.scored(spark, base)), a, b)
    names = ("s1_num_in_cand", "cand_has_num", "s1_has_num", "num_conflict", "cand_addr_empty", "cl_num_n", "cl_num_pmean", "cl_name_n", "cl_name_pmean")
    return d.select(G, "cand_id", *(F.round(F.col(n), 11).alias(n) for n in names))


# ---------------------------------------------------------------- learning
def q_alias_pairs(spark, base):
    """Aliases learned from all names, whatever their script: the same operator on simple views, so that SQL can follow."""
    a, b = lq.simple_views(lq.clean(spark, base)), lq.simple_views(lq.pool(spark, base)).withColumn("name_has_indic", F.lit(True))
    return aliases.learn_aliases(a, b, explode_ground_truth(lq.truth(spark, base)), min_count=2, min_share=0.4)


def q_alias_applied(spark, base):
    """Names after the learned aliases."""
    b = lq.simple_views(lq.pool(spark, base)).withColumns({"name_has_indic": F.lit(True), "name_skeleton": F.lit("")})
    learned = materialize(q_alias_pairs(spark, base), "aliases")
    changed = aliases.apply_aliases(b, learned)
    return changed.select("entity_id", "name_core")


def q_adversary(spark, base):
    """AUC of telling the pairs of s3 from those of s2 by their numeric features: there is no SQL for trees."""
    d = lq._pairs(spark, base).withColumn("nk", F.col("n_keytypes").cast("double"))
    both, _ = model.adversary(d.where("source = 'S2'"), d.where("source = 'S3'"), ("bscore", "nk"), params=model.Boosting(rounds=10, depth=4))
    return model.auc_by_ranks(both, "is_test")


# ---------------------------------------------------------------- diagnostics
def q_matches_by_country(spark, base):
    return diagnostics.matches_by_country(lq.truth(spark, base), lq.clean(spark, base))


def q_size_ratios(spark, base):
    return diagnostics.size_ratios(table(spark, base, "s2"), table(spark, base, "s3"))


def q_contest_shares(spark, base):
    s = lq.scored(spark, base)
    return diagnostics.contest_shares(diagnostics.contested(s, 0.3), lq._entities(spark, base), "all")


def q_pool_density(spark, base):
    return diagnostics.pool_density(lq.clean(spark, base), lq.pool(spark, base))


def q_unclaimed_bands(spark, base):
    return diagnostics.unclaimed_bands(lq.q_unclaimed(spark, base), lq.pool(spark, base))


def q_cell_gain(spark, base):
    """Gain of predicting nothing in a cell; the labelled records stand for the validation split, all for the test."""
    cells = lq.q_cell_labels(spark, base)
    s, t = lq._labelled(spark, base)
    per = decision.f05_per_entity(decision.to_lists(decision.choose_by_threshold(s, 0.5), t), t)
    gain = diagnostics.cell_gain(cells, cells.join(per.select(G, "f05", "is_singleton"), G))
    return gain.select("country", "cell", *(F.round(F.col(c), 9).alias(c) for c in gain.columns[2:]))


def q_band_examples(spark, base):
    """Three pairs of each probability band with the raw fields: a sampling operator."""
    s = lq.scored(spark, base).withColumn("band", diagnostics.band_right_closed(F.col("p"))).drop("country")
    few = sampling.examples_by(s, "band", diagnostics.RIGHT_LABELS, 3)
    return sampling.example_pairs(few, lq.clean(spark, base), lq.pool(spark, base), 3 * len(diagnostics.RIGHT_LABELS))


def q_output_checks_pool(spark, base):
    """Checks of match and candidate lists against the whole pool, with a repeated row, an unknown id and a match outside the candidates put in."""
    s = lq.scored(spark, base)
    ids = lq.clean(spark, base).select(F.col("entity_id").alias(G)).distinct()
    lists = decision.to_lists(decision.choose_by_threshold(s, 0.6), ids)
    first = ids.agg(F.min(G).alias(G))
    lists = lists.unionByName(first.withColumn("ids", F.array(F.lit("S2-unknown"))))
    return validate.output_checks(lists, decision.to_lists(s.select(G, "cand_id"), ids), ids, lq.pool(spark, base).select("entity_id").distinct())


def q_legal_conflict_shares(spark, base):
    """Pairs by conflict of legal forms, over records in plain Latin letters."""
    d = diagnostics.legal_conflicts(lq.scored(spark, base), add_views(lq.clean(spark, base)), add_views(_plain_pool(spark, base)))
    return d.groupBy("country", "legal_conflict").agg(F.count("*").alias("n_pairs"), F.round(F.avg("p"), 6).alias("p"))


QUERIES = {k: f for k, f in list(globals().items()) if k.startswith("q_")}

_MATCHED = "m AS (SELECT source1_entity_id, unnest(matched) AS cand_id FROM truth)"
_LEGAL = lq._words(sorted(set(LEGAL_FORMS.values())))
_PLAIN = f"(SELECT * FROM (SELECT DISTINCT entity_id, business_name, business_address, country FROM {lq._POOL}) WHERE NOT regexp_matches(concat_ws(' ', business_name, business_address), '{_OTHER}'))"


def _names_sql(source: str, p: str) -> str:
    """Name views of records in plain Latin letters: ``{p}5`` with toks, core, content, alt, and the folded name f."""
    cleaned = lambda c: lq._CLEANED.replace("(f,", f"({c},")
    typed = lambda c: f"list_transform({lq._DISTINCT.format(l=c)}, lambda x: coalesce({lq._map_sql(LEGAL_FORMS)}[x], x))"
    return f"""
    {p}0 AS (SELECT entity_id, {lq._fold_sql("business_name")} AS f FROM {source}),
    {p}1 AS (SELECT *, regexp_matches(f, '{lq._DBA}') AS dba, regexp_extract(f, '{lq._DBA}') AS mk FROM {p}0),
    {p}2 AS (SELECT *, CASE WHEN dba THEN substr(f, strpos(f, mk) + length(mk)) WHEN contains(f, '|') THEN substr(f, 1, strpos(f, '|') - 1) ELSE f END AS own,
             CASE WHEN dba THEN substr(f, 1, strpos(f, mk) - 1) WHEN contains(f, '|') THEN substr(f, strpos(f, '|') + 1) ELSE '' END AS oth FROM {p}1),
    {p}3 AS (SELECT *, list_filter(string_split(trim({cleaned("own")}), ' '), lambda x: x <> '') AS w, list_filter(string_split(trim({cleaned("oth")}), ' '), lambda x: x <> '') AS v FROM {p}2),
    {p}4 AS (SELECT *, {typed("w")} AS toks, {typed("v")} AS alts FROM {p}3),
    {p}5 AS (SELECT *, list_filter(toks, lambda x: x NOT IN {_LEGAL}) AS core, list_filter(alts, lambda x: x NOT IN {_LEGAL}) AS alt,
             list_filter(toks, lambda x: x NOT IN {_LEGAL} AND x NOT IN {lq._words(NAME_STOPWORDS)}) AS content,
             array_to_string(list_sort(list_distinct(list_filter(toks, lambda x: x IN {_LEGAL}))), ' ') AS legal FROM {p}4)"""


def _addresses_sql(source: str, p: str) -> str:
    sql = lq._ADDR_SQL.replace("(SELECT DISTINCT entity_id, business_name, business_address, country FROM s1)", source)
    for n in (3, 2, 0):
        sql = sql.replace(f"a{n} AS", f"{p}{n} AS").replace(f"FROM a{n}", f"FROM {p}{n}")
    return sql


_S1 = "(SELECT DISTINCT entity_id, business_name, business_address, country FROM s1)"
_FULL_JOIN = f"""{_names_sql(_S1, "x")}, {_names_sql(_PLAIN, "y")}, {_addresses_sql(_S1, "xa")}, {_addresses_sql(_PLAIN, "ya")}"""

ORACLES = {
    "q_pool_name_views": f"""WITH {_names_sql(_PLAIN, "y")} SELECT entity_id, array_to_string(toks, ' ') AS tokens, array_to_string(core, ' ') AS name_core, array_to_string(alt, ' ') AS name_alt_core, legal AS name_legal,
        array_to_string(content, '') AS name_concat, dba AS name_has_dba, regexp_matches(f, 'www\\.|{lq._DOM}') AS name_is_domain, regexp_full_match(f, '[^\\w]*[@#][\\w.]+\\s*') AS name_is_handle, false AS name_has_indic FROM y5""",
    "q_pool_address_views": f"WITH {_addresses_sql(_PLAIN, 'ya')} SELECT entity_id, array_to_string(nums, ' ') AS numbers, array_to_string(st, ' ') AS states, array_to_string(words, ' ') AS words, len(words) + len(nums) = 0 AS addr_empty FROM ya3",
    "q_pool_script_flags": f"""SELECT country, left(entity_id, 2) AS source, count(*) AS n_rows, count(*) FILTER (regexp_matches(coalesce(business_name, ''), '{INDIC}')) AS indic_names,
        count(*) FILTER (regexp_matches(coalesce(business_address, ''), '{INDIC}')) AS indic_addresses FROM (SELECT DISTINCT * FROM {lq._POOL}) GROUP BY 1, 2""",
    "q_views_by_type": f"""WITH {_names_sql(_S1, "x")}, {_addresses_sql(_S1, "xa")}, f AS (SELECT 'name_has_dba' AS view, dba AS x FROM x5 UNION ALL SELECT 'name_is_domain', regexp_matches(f, 'www\\.|{lq._DOM}') FROM x5 UNION ALL
        SELECT 'name_is_handle', regexp_full_match(f, '[^\\w]*[@#][\\w.]+\\s*') FROM x5 UNION ALL SELECT 'addr_empty', len(words) + len(nums) = 0 FROM xa3 UNION ALL
        SELECT 'name_has_indic', regexp_matches(coalesce(business_name, ''), '{INDIC}') FROM {_S1} UNION ALL SELECT 'addr_has_indic', regexp_matches(coalesce(business_address, ''), '{INDIC}') FROM {_S1})
        SELECT view, count(*) FILTER (x) AS n_true FROM f GROUP BY 1""",
    "q_reverse_search": f"""WITH {lq._block_sql()}, r AS (SELECT *, row_number() OVER (PARTITION BY source1_entity_id, source ORDER BY bscore DESC, cand_id) AS f, row_number() OVER (PARTITION BY cand_id ORDER BY bscore DESC, source1_entity_id) AS b FROM blocks)
        SELECT source1_entity_id, cand_id, bscore, n_keytypes FROM r WHERE b <= 2 AND f > 3""",
    "q_candidates_none": f"""WITH {lq._block_sql().replace("round(sum(w), 6)", "sum(w)")}, t AS (SELECT * FROM blocks QUALIFY row_number() OVER (PARTITION BY source1_entity_id, source ORDER BY bscore DESC, cand_id) <= 6)
        SELECT source1_entity_id, source, count(*) AS n, round(sum(bscore), 6) AS total FROM t GROUP BY 1, 2""",
    "q_key_coverage": f"""WITH {lq._CLEAN_SQL}, {lq._POOL_SQL}, {lq._keys_sql("qk", "q")}, {lq._keys_sql("pk", "pl")}, {lq._TRUTH_SQL}, {_MATCHED}, sz AS (SELECT country, key, count(*) AS df FROM pk GROUP BY 1, 2),
        s AS (SELECT source1_entity_id, cand_id, min(df) AS df FROM m JOIN qk ON qk.id = source1_entity_id JOIN pk ON pk.id = cand_id AND pk.country = qk.country AND pk.key = qk.key JOIN sz ON sz.country = pk.country AND sz.key = pk.key GROUP BY 1, 2)
        SELECT CAST(cap AS INT) AS cap, (SELECT count(*) FROM m) AS true_pairs, count(*) FILTER (df <= cap) AS covered, round(count(*) FILTER (df <= cap) / greatest((SELECT count(*) FROM m), 1), 4) AS share FROM (SELECT unnest([{max(CAPS.values())}, 2000]) AS cap) LEFT JOIN s ON true GROUP BY 1""",
    "q_missed_pairs": f"""WITH {lq._block_sql()}, {lq._TRUTH_SQL}, {_MATCHED}, top AS (SELECT * FROM blocks QUALIFY row_number() OVER (PARTITION BY source1_entity_id, source ORDER BY bscore DESC, cand_id) <= 8)
        SELECT DISTINCT source1_entity_id, cand_id FROM m ANTI JOIN top USING (source1_entity_id, cand_id)""",
    "q_group_features_operator": f"""WITH {lq._JOINED_SQL}, k AS (SELECT j.*, array_to_string(t2, '') AS cc2, coalesce(n2[1], '') AS f2, coalesce(list_contains(n2, n1[1]), false) AS h1, len(list_intersect(t1, t2)) / greatest(len(list_distinct(t1 || t2)), 1) AS nj, len(list_intersect(a1, a2)) / greatest(len(list_distinct(a1 || a2)), 1) AS aj FROM j),
        s AS (SELECT *, sum(CAST(h1 AS INT)) OVER (PARTITION BY source1_entity_id) - CAST(h1 AS INT) AS sup FROM k)
        SELECT source1_entity_id, cand_id, CAST(row_number() OVER (PARTITION BY source1_entity_id, source ORDER BY bscore DESC, cand_id) AS DOUBLE) AS rank_in_src, CAST(count(*) OVER g AS DOUBLE) AS n_cands, round(max(bscore) OVER g - bscore, 6) AS bscore_gap,
          round(max(nj) OVER g - nj, 6) AS name_tset_gap, round(max(aj) OVER g - aj, 6) AS addr_tset_gap, CAST(CASE WHEN f2 <> '' THEN count(*) OVER (PARTITION BY source1_entity_id, f2) - 1 ELSE 0 END AS DOUBLE) AS grp_same_num,
          CAST(count(*) OVER (PARTITION BY source1_entity_id, cc2) - 1 AS DOUBLE) AS grp_same_concat, CAST(sup AS DOUBLE) AS grp_s1num_support, CAST(NOT h1 AND len(n1) > 0 AND sup > 0 AS DOUBLE) AS grp_num_minority FROM s WINDOW g AS (PARTITION BY source1_entity_id)""",
    "q_legal_state_features": f"""WITH {lq._PAIRS_SQL}, {_FULL_JOIN}, o AS (SELECT prs.source1_entity_id, prs.cand_id, x5.legal AS l1, y5.legal AS l2, xa3.st AS s1, ya3.st AS s2, xa3.nums AS n1, ya3.nums AS n2, x5.core AS c1, y5.core AS c2, xa3.words AS a1, ya3.words AS a2
          FROM prs JOIN x5 ON x5.entity_id = prs.source1_entity_id JOIN xa3 ON xa3.entity_id = prs.source1_entity_id JOIN y5 ON y5.entity_id = prs.cand_id JOIN ya3 ON ya3.entity_id = prs.cand_id)
        SELECT source1_entity_id, cand_id, CAST(l1 = l2 AS DOUBLE) AS legal_eq, CAST(l2 = '' AS DOUBLE) AS legal2_empty, CAST(len(list_intersect(s1, s2)) > 0 AS DOUBLE) AS state_overlap, CAST(len(s1) > 0 AND len(s2) > 0 AS DOUBLE) AS state_both, CAST(len(n1) AS DOUBLE) AS n_nums1, CAST(len(n2) AS DOUBLE) AS n_nums2,
          CAST(length(array_to_string(c1, ' ')) AS DOUBLE) AS len_core1, CAST(length(array_to_string(c2, ' ')) AS DOUBLE) AS len_core2, round(len(list_intersect(c1, c2)) / greatest(len(c2), 1), 6) AS ntok_cont2, round(len(list_intersect(a1, a2)) / greatest(len(list_distinct(a1 || a2)), 1), 6) AS atok_jacc, round(len(list_intersect(a1, a2)) / greatest(len(a1), 1), 6) AS atok_cont1 FROM o""",
    "q_stage2_clusters": f"""WITH {lq._CLEAN_SQL}, {lq._POOL_SQL}, {lq._SCORED_SQL}, d AS (SELECT s.source1_entity_id, s.cand_id, s.p, q.addr_numbers AS n1, pl.addr_numbers AS n2, coalesce(pl.name_concat, '') AS cc, coalesce(pl.addr_numbers[1], '') AS f2, pl.entity_id IS NULL OR len(pl.addr_tokens) + len(pl.addr_numbers) = 0 AS ce
          FROM scored s LEFT JOIN q ON q.entity_id = s.source1_entity_id LEFT JOIN pl ON pl.entity_id = s.cand_id WHERE s.p >= 0.01)
        SELECT source1_entity_id, cand_id, CAST(coalesce(list_contains(n2, n1[1]), false) AS DOUBLE) AS s1_num_in_cand, CAST(coalesce(len(n2), 0) > 0 AS DOUBLE) AS cand_has_num, CAST(coalesce(len(n1), 0) > 0 AS DOUBLE) AS s1_has_num,
          CAST(coalesce(len(n1), 0) > 0 AND coalesce(len(n2), 0) > 0 AND coalesce(len(list_intersect(n1, n2)), 0) = 0 AS DOUBLE) AS num_conflict, CAST(ce AS DOUBLE) AS cand_addr_empty,
          CAST(CASE WHEN f2 <> '' THEN count(*) OVER u - 1 ELSE 0 END AS DOUBLE) AS cl_num_n, round(CASE WHEN f2 <> '' THEN (sum(p) OVER u - p) / greatest(count(*) OVER u - 1, 1) ELSE 0.0 END, 11) AS cl_num_pmean,
          CAST(count(*) OVER v - 1 AS DOUBLE) AS cl_name_n, round((sum(p) OVER v - p) / greatest(count(*) OVER v - 1, 1), 11) AS cl_name_pmean FROM d WINDOW u AS (PARTITION BY source1_entity_id, f2), v AS (PARTITION BY source1_entity_id, cc)""",
    "q_alias_pairs": f"WITH {lq._CLEAN_SQL}, {lq._POOL_SQL}, {lq._TRUTH_SQL}, {_MATCHED}, __ALIAS__ SELECT src, dst, n, total FROM al",
    "q_alias_applied": f"""WITH {lq._CLEAN_SQL}, {lq._POOL_SQL}, {lq._TRUTH_SQL}, {_MATCHED}, __ALIAS__, w AS (SELECT entity_id, generate_subscripts(name_core_tokens, 1) AS i, unnest(name_core_tokens) AS src FROM (SELECT DISTINCT entity_id, name_core_tokens FROM pl)),
        n AS (SELECT entity_id, list(coalesce(dst, src) ORDER BY i) AS ws FROM w LEFT JOIN al USING (src) GROUP BY 1)
        SELECT pl.entity_id, coalesce(array_to_string({lq._DISTINCT.format(l="ws")}, ' '), pl.name_core) AS name_core FROM pl LEFT JOIN n USING (entity_id)""",
    "q_matches_by_country": f"""WITH {lq._TRUTH_SQL} SELECT country, count(*) AS n_s1, round(100 * avg(CAST(n_matches = 0 AS DOUBLE)), 2) AS singleton_rate_pct, round(avg(n_matches), 3) AS matches_mean
        FROM truth JOIN (SELECT DISTINCT entity_id, country FROM s1) ON entity_id = source1_entity_id GROUP BY 1""",
    "q_size_ratios": """SELECT country, coalesce(a.n, 0) AS n_first, coalesce(b.n, 0) AS n_second, round(coalesce(b.n, 0) / nullif(coalesce(a.n, 0), 0), 4) AS ratio
        FROM (SELECT country, count(*) AS n FROM s2 GROUP BY 1) a FULL JOIN (SELECT country, count(*) AS n FROM s3 GROUP BY 1) b USING (country)""",
    "q_contest_shares": f"""WITH {lq._SCORED_SQL}, h AS (SELECT *, count(*) OVER (PARTITION BY cand_id) AS c, p = max(p) OVER (PARTITION BY cand_id) AS w FROM scored WHERE p >= 0.3),
        g AS (SELECT source1_entity_id, bool_or(c >= 2) AS contested, count(*) FILTER (w AND c >= 2) AS won, count(*) FILTER (NOT w AND c >= 2) AS lost FROM h GROUP BY 1)
        SELECT country, count(*) AS n_s1, round(avg(CAST(coalesce(contested, false) AS DOUBLE)), 4) AS contested, round(avg(won) FILTER (contested), 4) AS won, round(avg(lost) FILTER (contested), 4) AS lost, 'all' AS split
        FROM (SELECT DISTINCT entity_id, country FROM s1) LEFT JOIN g ON source1_entity_id = entity_id GROUP BY 1""",
    "q_pool_density": f"""WITH n AS (SELECT country, count(DISTINCT entity_id) AS n_s1 FROM s1 GROUP BY 1), p AS (SELECT country, left(entity_id, 2) AS source, count(DISTINCT entity_id) AS n_pool FROM {lq._POOL} GROUP BY 1, 2)
        SELECT country, source, n_pool, coalesce(n_s1, 0) AS n_s1, round(n_pool / nullif(coalesce(n_s1, 0), 0), 4) AS per_s1 FROM p LEFT JOIN n USING (country)""",
    "q_unclaimed_bands": f"""WITH {lq._SCORED_SQL}, {lq._EXCLUSIVE_SQL}, fr AS (SELECT DISTINCT entity_id AS cand_id FROM {lq._POOL} EXCEPT SELECT cand_id FROM excl WHERE p >= 0.5), d AS (SELECT fr.cand_id, excl.p FROM fr LEFT JOIN excl USING (cand_id)),
        b AS (SELECT c.country, left(cand_id, 2) AS source, p, CASE WHEN p IS NULL THEN -1 WHEN p <= 0.3 THEN 0 WHEN p <= 0.5 THEN 1 WHEN p <= 0.7 THEN 2 WHEN p <= 0.8 THEN 3 WHEN p <= 0.9 THEN 4 WHEN p <= 0.97 THEN 5 ELSE 6 END AS b FROM d JOIN (SELECT DISTINCT entity_id, country FROM {lq._POOL}) c ON c.entity_id = cand_id)
        SELECT country, source, count(*) AS n_free, round(avg(CAST(p IS NOT NULL AS DOUBLE)), 4) AS in_lists, {", ".join(f"round(avg(CAST(b = {i} AS DOUBLE)), 4) AS b{i}" for i in range(7))} FROM b GROUP BY 1, 2""",
    "q_cell_gain": f"""WITH {lq._TRUTH_SQL}, cells AS ({lq.ORACLES["q_cell_labels"]}), {lq._SCORED_SQL}, {lq._LABELLED_SQL}, {lq._PER.replace("0.6", "0.5")},
        t AS (SELECT country, cell, count(*) / sum(count(*)) OVER (PARTITION BY country) AS test_share FROM cells GROUP BY 1, 2),
        v AS (SELECT country, cell, count(*) / sum(count(*)) OVER (PARTITION BY country) AS val_share, avg(CAST(n_matches = 0 AS DOUBLE)) AS val_nomatch, avg(f05) AS val_f05 FROM cells JOIN per USING (source1_entity_id) GROUP BY 1, 2)
        SELECT country, cell, round(test_share, 9) AS test_share, round(coalesce(val_share, 0), 9) AS val_share, round(coalesce(val_nomatch, 0), 9) AS val_nomatch, round(coalesce(val_f05, 0), 9) AS val_f05,
          round(test_share * (greatest(1 - coalesce(val_share, 0) / test_share, 0) + (1 - greatest(1 - coalesce(val_share, 0) / test_share, 0)) * (coalesce(val_nomatch, 0) - coalesce(val_f05, 0))), 6) AS gain_if_blank FROM t LEFT JOIN v USING (country, cell)""",
    "q_output_checks_pool": f"""WITH {lq._SCORED_SQL}, {lq._EXCLUSIVE_SQL}, known AS (SELECT DISTINCT entity_id FROM {lq._POOL}), x AS (SELECT count(*) FILTER (cand_id NOT IN (SELECT entity_id FROM known)) AS a FROM excl WHERE p >= 0.6), y AS (SELECT count(*) FILTER (cand_id NOT IN (SELECT entity_id FROM known)) AS b FROM scored)
        SELECT check_name AS "check", CASE check_name WHEN 'matches: ids not in the pool' THEN (SELECT a FROM x) + 1 WHEN 'candidates: ids not in the pool' THEN (SELECT b FROM y) WHEN 'matches: repeated rows' THEN 1 WHEN 'matches outside the candidates' THEN 1 ELSE 0 END AS violations
        FROM (SELECT unnest([{", ".join(f"'{n}: {w}'" for n in ("matches", "candidates") for w in ("repeated rows", "missing rows", "unknown clean ids", "ids not in the pool", "ids repeated in a list"))}, 'matches outside the candidates']) AS check_name)""",
    "q_legal_conflict_shares": f"""WITH {lq._SCORED_SQL}, {_names_sql(_S1, "x")}, {_names_sql(_PLAIN, "y")}, o AS (SELECT s.country, s.p, coalesce(x5.legal, '') AS l1, coalesce(y5.legal, '') AS l2 FROM scored s LEFT JOIN x5 ON x5.entity_id = source1_entity_id LEFT JOIN y5 ON y5.entity_id = cand_id)
        SELECT country, l1 <> '' AND l2 <> '' AND l1 <> l2 AS legal_conflict, count(*) AS n_pairs, round(avg(p), 6) AS p FROM o GROUP BY 1, 2""",
}
_ALIAS = """al0 AS (SELECT q.name_core_tokens AS t1, pl.name_core_tokens AS t2 FROM m JOIN q ON q.entity_id = m.source1_entity_id JOIN pl ON pl.entity_id = m.cand_id WHERE len(q.name_core_tokens) = len(pl.name_core_tokens) AND len(q.name_core_tokens) > 0),
        al1 AS (SELECT src, dst, count(*) AS n FROM (SELECT unnest(t2) AS src, unnest(t1) AS dst FROM al0) WHERE src <> dst GROUP BY 1, 2),
        al2 AS (SELECT *, CAST(sum(n) OVER (PARTITION BY src) AS BIGINT) AS total FROM al1 QUALIFY row_number() OVER (PARTITION BY src ORDER BY n DESC, dst) = 1),
        al AS (SELECT src, dst, n, total FROM al2 WHERE n >= 2 AND n / total >= 0.4 AND src NOT IN (SELECT tok FROM (SELECT unnest(name_core_tokens) AS tok FROM q) GROUP BY 1 HAVING count(*) >= 5))"""
ORACLES = {k: sql.replace("__ALIAS__", _ALIAS) for k, sql in ORACLES.items()}
