"""Queries of the linkage operators over the domain tables, with the SQL that must give the same rows.

``simple`` views (ASCII words and numbers of name and address) let SQL follow the whole way from the raw text to candidates; the full
views are compared where SQL can express them (the Latin-script clean source).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinloom.config import CAPS, KEY_WEIGHTS, PRESETS, Blocking
from kinloom.functions.similarity import similarity
from kinloom.functions.text import add_views, fold
from kinloom.functions.vocab import ADDRESS_SHORT, DESIGNATORS, IN_STATES, LEGAL_FORMS, NAME_STOPWORDS, STATE_CODES, US_STATES
from kinloom.operators import aliases, blocking, decision, diagnostics, features, model, rules, sampling, siblings, stage2
from kinloom.session import materialize
from kinloom.sources.files import explode_ground_truth, parse_ground_truth
from kinloom.sources.tables import table

G = "source1_entity_id"
COLUMNS = ("entity_id", "business_name", "business_address", "country")


# ---------------------------------------------------------------- tables and views
def clean(spark: SparkSession, base: str) -> DataFrame:
    return table(spark, base, "s1").select(*COLUMNS).distinct()


def pool(spark: SparkSession, base: str) -> DataFrame:
    return table(spark, base, "s2").select(*COLUMNS).unionByName(table(spark, base, "s3").select(*COLUMNS)).distinct()


def truth(spark: SparkSession, base: str) -> DataFrame:
    t = parse_ground_truth(table(spark, base, "known_matches")).select(G, F.array_distinct("matched").alias("matched"))
    return t.withColumn("n_matches", F.size("matched"))


def scored(spark: SparkSession, base: str) -> DataFrame:
    """Candidate pairs with p = b / (1 + b) of their best block score b."""
    b = F.col("bscore").cast("double")
    c = table(spark, base, "candidate_pairs").where(F.col(G).isNotNull() & b.isNotNull() & ~F.isnan(b) & (b >= 0))
    c = c.groupBy(G, "cand_id").agg(F.max(b).alias("b"))
    country = clean(spark, base).select(F.col("entity_id").alias(G), "country")
    return c.join(country, G).select(G, "cand_id", "country", F.round(F.col("b") / (1 + F.col("b")), 6).alias("p"))


def _ascii_words(c: str) -> Column:
    return F.filter(F.split(F.lower(F.regexp_replace(F.coalesce(c, F.lit("")), "[^a-zA-Z0-9]+", " ")), " "), lambda x: x != "")


def simple_views(df: DataFrame) -> DataFrame:
    df = df.withColumns({"__n": F.array_distinct(_ascii_words("business_name")), "__a": F.array_distinct(_ascii_words("business_address"))})
    return df.select(
        *COLUMNS, F.col("__n").alias("name_core_tokens"), F.array_join("__n", " ").alias("name_core"), F.array_join("__n", "").alias("name_concat"),
        F.filter("__a", lambda x: ~x.rlike("^[0-9]+$")).alias("addr_tokens"), F.filter("__a", lambda x: x.rlike("^[0-9]+$")).alias("addr_numbers"),
    ).withColumn("addr_clean", F.array_join("addr_tokens", " "))


def _words(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


_DISTINCT = "list_filter({l}, lambda x, i: list_position({l}, x) = i)"
_STREET = sorted({*ADDRESS_SHORT, *ADDRESS_SHORT.values()})


def _sql_words(c: str) -> str:
    return f"list_filter(string_split(lower(regexp_replace(coalesce({c}, ''), '[^a-zA-Z0-9]+', ' ', 'g')), ' '), lambda x: x <> '')"


def _simple_sql(name: str, source: str) -> str:
    return f"""
    {name}_0 AS (SELECT DISTINCT entity_id, business_name, business_address, country FROM {source}),
    {name}_1 AS (SELECT *, {_sql_words("business_name")} AS wn, {_sql_words("business_address")} AS wa FROM {name}_0),
    {name}_2 AS (SELECT *, {_DISTINCT.format(l="wn")} AS dn, {_DISTINCT.format(l="wa")} AS da FROM {name}_1),
    {name} AS (SELECT entity_id, country, dn AS name_core_tokens, array_to_string(dn, ' ') AS name_core, array_to_string(dn, '') AS name_concat,
               list_filter(da, lambda x: NOT regexp_full_match(x, '[0-9]+')) AS addr_tokens,
               list_filter(da, lambda x: regexp_full_match(x, '[0-9]+')) AS addr_numbers FROM {name}_2)"""


_POOL = "(SELECT entity_id, business_name, business_address, country FROM s2 UNION ALL SELECT entity_id, business_name, business_address, country FROM s3)"
_CLEAN_SQL = _simple_sql("q", "s1")
_POOL_SQL = _simple_sql("pl", _POOL)
_TRUTH_SQL = """
    truth0 AS (SELECT source1_entity_id, list_filter(list_transform(string_split(coalesce(matched_entity_ids, ''), ','), lambda x: trim(x)), lambda x: x <> '') AS m FROM known_matches),
    truth AS (SELECT source1_entity_id, list_distinct(m) AS matched, len(list_distinct(m)) AS n_matches FROM truth0)"""
_SCORED_SQL = """
    scored AS (SELECT c.source1_entity_id, c.cand_id, s.country, round(c.b / (1 + c.b), 6) AS p
               FROM (SELECT source1_entity_id, cand_id, max(CAST(bscore AS DOUBLE)) AS b FROM candidate_pairs
                     WHERE source1_entity_id IS NOT NULL AND bscore IS NOT NULL AND NOT isnan(bscore) AND bscore >= 0 GROUP BY 1, 2) c
               JOIN (SELECT DISTINCT entity_id, country FROM s1) s ON s.entity_id = c.source1_entity_id)"""
_EXCLUSIVE_SQL = """
    excl AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY cand_id ORDER BY p DESC, source1_entity_id) = 1)"""


def _keys_sql(name: str, records: str) -> str:
    return f"""
    {name}_n AS (SELECT entity_id AS id, country, unnest(list_filter(name_core_tokens, lambda x: length(x) >= 2 AND x NOT IN {_words(NAME_STOPWORDS)})[1:4]) AS w FROM {records}),
    {name}_a AS (SELECT entity_id AS id, country, unnest(list_filter(addr_tokens, lambda x: length(x) >= 3 AND x NOT IN {_words(_STREET)})[1:8]) AS w FROM {records}),
    {name}_u AS (SELECT entity_id AS id, country, unnest(addr_numbers[1:3]) AS w FROM {records}),
    {name} AS (
      SELECT id, country, 'N' AS t, 'N|' || w AS key FROM {name}_n
      UNION ALL SELECT x.id, x.country, 'P', 'P|' || x.w || '|' || y.w FROM {name}_n x JOIN {name}_n y ON x.id = y.id AND x.w < y.w
      UNION ALL SELECT x.id, x.country, 'A', 'A|' || x.w || '|' || y.w FROM {name}_n x JOIN {name}_a y ON x.id = y.id
      UNION ALL SELECT x.id, x.country, 'U', 'U|' || x.w || '|' || y.w FROM {name}_u x JOIN {name}_a y ON x.id = y.id
      UNION ALL SELECT x.id, x.country, 'W', 'W|' || x.w || '|' || y.w FROM {name}_a x JOIN {name}_a y ON x.id = y.id AND x.w < y.w
      UNION ALL SELECT entity_id, country, 'C', 'C|' || name_concat FROM {records} WHERE length(name_concat) >= 4
      UNION ALL SELECT x.id, x.country, 'B', 'B|' || x.w || '|' || y.w FROM {name}_u x JOIN {name}_n y ON x.id = y.id
      UNION ALL SELECT x.id, x.country, 'M', 'M|' || x.w || '|' || y.w FROM {name}_u x JOIN {name}_u y ON x.id = y.id AND x.w < y.w
      UNION ALL SELECT x.id, x.country, 'T', 'T|' || x.w || '|' || y.w || '|' || z.w FROM {name}_n x JOIN {name}_n y ON x.id = y.id AND x.w < y.w JOIN {name}_n z ON x.id = z.id AND y.w < z.w)"""


def _case(values: dict) -> str:
    return "CASE t " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in values.items()) + " END"


def _block_sql(weight: str = "df") -> str:
    return f"""{_CLEAN_SQL}, {_POOL_SQL}, {_keys_sql("qk", "q")}, {_keys_sql("pk", "pl")},
    sizes AS (SELECT country, key, count(*) AS df FROM pk GROUP BY 1, 2 HAVING count(*) <= {max(CAPS.values())}),
    inside AS (SELECT pk.id AS cand_id, pk.country, pk.t, pk.key, df, {_case(KEY_WEIGHTS)} / CAST({weight} AS DOUBLE) AS w FROM pk JOIN sizes USING (country, key) WHERE df <= {_case(CAPS)}),
    blocks AS (SELECT qk.id AS source1_entity_id, cand_id, left(cand_id, 2) AS source, round(sum(w), 6) AS bscore, count(DISTINCT inside.t) AS n_keytypes
               FROM qk JOIN inside USING (country, key) GROUP BY 1, 2, 3)"""


def _block_scores(spark: SparkSession, base: str, cfg: Blocking) -> DataFrame:
    s = blocking.block_scores(simple_views(clean(spark, base)), simple_views(pool(spark, base)), cfg)
    return s.withColumn("bscore", F.round("bscore", 6))


# ---------------------------------------------------------------- text
def q_accent_fold(spark, base):
    return clean(spark, base).select("entity_id", fold(F.col("business_name")).alias("name"), fold(F.col("business_address")).alias("address"))


def _full_clean(spark, base) -> DataFrame:
    return add_views(clean(spark, base))


def q_name_views(spark, base):
    v = _full_clean(spark, base)
    return v.select("entity_id", F.array_join(F.array_sort("name_tokens"), " ").alias("tokens"), F.array_join(F.array_sort("name_core_tokens"), " ").alias("core"), "name_legal", "name_has_dba", "name_is_domain", "name_is_handle")


def q_name_skeleton(spark, base):
    return _full_clean(spark, base).select("entity_id", "name_concat", "name_initials", "name_skeleton")


def q_address_views(spark, base):
    v = _full_clean(spark, base)
    return v.select("entity_id", F.array_join(F.array_sort("addr_numbers"), " ").alias("numbers"), F.array_join(F.array_sort("addr_states"), " ").alias("states"), F.array_join(F.array_sort("addr_tokens"), " ").alias("words"), "addr_empty")


def q_pool_views(spark, base):
    """The full views of the noisy pool; romanised scripts have no SQL equivalent."""
    v = add_views(pool(spark, base))
    return v.select("entity_id", "name_core", "name_legal", "name_alt_core", "name_skeleton", "addr_clean", F.array_join("addr_numbers", " ").alias("numbers"), "name_has_indic", "addr_empty")


def _sub(expr: str, *pairs: tuple[str, str]) -> str:
    for pattern, to in pairs:
        pattern = pattern.replace("'", "''")
        expr = f"regexp_replace({expr}, '{pattern}', '{to}', 'g')"
    return expr


_SPELL = [("ß", "ss"), ("æ", "ae"), ("œ", "oe"), ("ø", "o"), ("đ", "d"), ("ł", "l"), ("ı", "i"), ("’", "''"), ("‘", "''")]


def _fold_sql(c: str) -> str:
    e = f"strip_accents(coalesce({c}, ''))"
    for a, b in _SPELL:
        e = f"replace({e}, '{a}', '{b}')"
    return f"trim(lower({e}))"


_DOM = r"\.(?:co\.in|org\.in|net\.in|com|net|org|in|co|fr|biz|info|us|io)\b"
_DBA = r"(?:\bd\s*/\s*b\s*/\s*a\b|\bdba\b|\bf\s*/\s*k\s*/\s*a\b|\bfka\b|\ba\s*/\s*k\s*/\s*a\b|\baka\b|\btrading as\b|\bdoing business as\b|\bformerly known as\b)"
_CLEANED = _sub(
    "f", (r"#\s*\d+", " "), (r"^\s*m\s*/\s*s\.?\s+", " "), (r"www\.", " "), (_DOM, " "), (r"['`]", ""), (r"\.", ""), (r"[&+]", " and "),
    (r"([a-z])1([a-z])", r"\1l\2"), (r"\b1([a-z]{3,})", r"l\1"), (r"([a-z])0([a-z])", r"\1o\2"), (r"\b0([a-z]{3,})", r"o\1"), (r"([a-z])5([a-z])", r"\1s\2"), (r"\b5([a-z]{3,})", r"s\1"), (r"[^a-z0-9]+", " "),
)


def _map_sql(table_: dict[str, str]) -> str:
    return "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in table_.items()) + "}"


_NAME_SQL = f"""
    f0 AS (SELECT entity_id, {_fold_sql("business_name")} AS f FROM (SELECT DISTINCT entity_id, business_name, business_address, country FROM s1)),
    f1 AS (SELECT *, list_filter(string_split(trim({_CLEANED}), ' '), lambda x: x <> '') AS w0 FROM f0),
    f2 AS (SELECT *, {_DISTINCT.format(l="w0")} AS w1 FROM f1),
    f3 AS (SELECT entity_id, f, list_transform(w1, lambda x: coalesce({_map_sql(LEGAL_FORMS)}[x], x)) AS toks FROM f2),
    f4 AS (SELECT *, list_filter(toks, lambda x: x NOT IN {_words(sorted(set(LEGAL_FORMS.values())))}) AS core,
                  list_filter(toks, lambda x: x NOT IN {_words(sorted(set(LEGAL_FORMS.values())))} AND x NOT IN {_words(NAME_STOPWORDS)}) AS content FROM f3)"""
_DOUBLES = "regexp_replace(translate(replace(array_to_string(content, ' '), 'ph', 'f'), 'cqz', 'kks'), '([a-z0-9])[aeiouyhw]+', '\\1', 'g')"
for _ch in "bdfgklmnprstv":
    _DOUBLES = f"replace({_DOUBLES}, '{_ch}{_ch}', '{_ch}')"
_LONG = {k: v for k, v in {**US_STATES, **IN_STATES}.items() if " " in k}
_ADDR_E = "a1"
for _n, _w in enumerate(("first", "second", "third", "fourth", "fifth", "sixth", "seventh", "eighth", "ninth", "tenth"), 1):
    _ADDR_E = f"replace({_ADDR_E}, ' {_w} ', ' {_n} ')"
_ADDR_E = _sub(_ADDR_E, (r"(\d)(?:st|nd|rd|th)\b", r"\1"), (r"\b(\d+)\s*1\s*/\s*2\b", r"\1"), (r"(\d)([a-z])\b", r"\1 \2"), (r"['`]", ""), (r"\.", " "), (r"\b([a-z]+)(\d)", r"\1 \2"))
_ADDR_E = _sub(_ADDR_E, *((rf"\b{k}\b", v) for k, v in _LONG.items()), (r"[^a-z0-9]+", " "))
_EMPTY_SQL = r"<\s*null\s*>|\bnull\b|\bn\s*/\s*a\b|\bnone\b|\bnil\b"
_ADDR_SQL = f"""
    a0 AS (SELECT entity_id, {_sub(_fold_sql("business_address"), (_EMPTY_SQL, " "))} AS a1 FROM (SELECT DISTINCT entity_id, business_name, business_address, country FROM s1)),
    a2 AS (SELECT *, list_filter(string_split(trim({_ADDR_E}), ' '), lambda x: x <> '') AS w0,
                  list_filter(list_transform(string_split(a1, ','), lambda x: {_map_sql(STATE_CODES)}[trim(regexp_replace(x, '[^a-z ]', '', 'g'))]), lambda x: x IS NOT NULL) AS st FROM a0),
    a3 AS (SELECT entity_id, list_sort(list_distinct(list_filter(list_transform(list_filter(w0, lambda x: regexp_full_match(x, '\\d+')), lambda x: ltrim(x, '0')), lambda x: x <> ''))) AS nums, list_sort(list_distinct(st)) AS st,
                  list_sort(list_distinct(list_filter(list_transform(list_filter(w0, lambda x: NOT regexp_full_match(x, '\\d+')),
                       lambda x: coalesce({_map_sql({**ADDRESS_SHORT, **{k: v for k, v in STATE_CODES.items() if " " not in k and len(k) > 2}})}[x], x)),
                       lambda x: length(x) > 1 AND x NOT IN {_words(DESIGNATORS)}))) AS words FROM a2)"""


# ---------------------------------------------------------------- statistics
def q_source_stats(spark, base):
    return diagnostics.source_stats(table(spark, base, "s2"))


def q_id_stats(spark, base):
    return diagnostics.id_stats(table(spark, base, "s3"))


def q_truth_stats(spark, base):
    return diagnostics.truth_stats(truth(spark, base))


def q_truth_distribution(spark, base):
    return diagnostics.truth_distribution(truth(spark, base))


def q_coverage(spark, base):
    return diagnostics.coverage(pool(spark, base), explode_ground_truth(truth(spark, base)))


def q_country_mismatch(spark, base):
    return diagnostics.country_mismatches(explode_ground_truth(truth(spark, base)), clean(spark, base), pool(spark, base))


def q_name_freq(spark, base):
    return features.add_name_freq(simple_views(pool(spark, base))).select("entity_id", "name_freq")


def q_token_idf(spark, base):
    return features.token_idf(simple_views(clean(spark, base)), simple_views(pool(spark, base))).withColumn("idf", F.round("idf", 6))


def _with_name_tokens(df: DataFrame) -> DataFrame:
    return simple_views(df).withColumnRenamed("name_core_tokens", "name_tokens")


def q_token_shift(spark, base):
    a = _with_name_tokens(table(spark, base, "s2").select(*COLUMNS).distinct())
    b = _with_name_tokens(table(spark, base, "s3").select(*COLUMNS).distinct())
    return diagnostics.token_shift(a, b, "last")


# ---------------------------------------------------------------- blocking
def q_block_keys(spark, base):
    keys = blocking.record_keys(simple_views(pool(spark, base)))
    return keys.groupBy("country", "t", "key").agg(F.count("*").alias("df")).groupBy("country", "t").agg(F.count("*").alias("n_keys"), F.max("df").alias("largest"), F.sum("df").alias("n_rows"))


def q_block_topk(spark, base):
    s = _block_scores(spark, base, Blocking())
    return blocking.top_per_source(s, "bscore", 8).select(G, "cand_id", "source", "bscore", "n_keytypes")


def q_block_log_weight(spark, base):
    best = lambda s: blocking.top_per_source(s.withColumn("bscore", F.round("bscore", 6)), "bscore", 3)
    top = blocking.chosen_in_slices(simple_views(clean(spark, base)), simple_views(pool(spark, base)), Blocking(weight="log"), best)
    return top.select(G, "cand_id", "source", "bscore", "n_keytypes")


def labelled_top(spark: SparkSession, base: str) -> DataFrame:
    """The best eight candidates per source of the labelled clean records: blocks are counted over the whole pool, so others' candidates don't matter."""
    asked = clean(spark, base).join(truth(spark, base).select(F.col(G).alias("entity_id")), "entity_id", "left_semi")
    best = lambda s: blocking.top_per_source(s.withColumn("bscore", F.round("bscore", 6)), "bscore", 8)
    return blocking.chosen_in_slices(simple_views(asked), simple_views(pool(spark, base)), Blocking(), best)


def q_block_recall(spark, base):
    t = truth(spark, base)
    return blocking.blocking_recall(labelled_top(spark, base), explode_ground_truth(t), t)


def q_rarest_shared_key(spark, base):
    keys = blocking.hashed_keys(simple_views(clean(spark, base)))
    return diagnostics.rarest_shared_keys(keys, blocking.pool_keys(simple_views(pool(spark, base)), max(CAPS.values())), explode_ground_truth(truth(spark, base)))


def _views(spark, base) -> tuple[DataFrame, DataFrame]:
    """Full views of both sides, made once: they are read several times below."""
    return materialize(add_views(clean(spark, base)), "clean-views"), materialize(add_views(pool(spark, base)), "pool-views")


def q_candidates_v17(spark, base):
    """Candidates of the final configuration over the full views."""
    c = blocking.generate_candidates(*_views(spark, base), PRESETS["v17"])
    return c.withColumn("bscore", F.round("bscore", 6))


def q_candidates_union(spark, base):
    c = blocking.generate_candidates(*_views(spark, base), PRESETS["v8"])
    return c.withColumn("bscore", F.round("bscore", 6))


# ---------------------------------------------------------------- decisions
def q_exclusivity(spark, base):
    return decision.apply_exclusivity(scored(spark, base))


def q_threshold_lists(spark, base):
    s = scored(spark, base)
    ids = clean(spark, base).select(F.col("entity_id").alias(G)).distinct()
    return decision.to_lists(decision.choose_by_threshold(s, 0.6), ids).select(G, F.array_join("ids", ",").alias("ids"))


def q_expected_f(spark, base):
    d = decision.with_expected_f(decision.apply_exclusivity(scored(spark, base)), 1.0)
    return d.select(G, "cand_id", "k", F.round("ek", 6).alias("ek"), F.round("e0", 6).alias("e0"))


def q_expected_f_choice(spark, base):
    return decision.choose_matches(scored(spark, base), 0.3, 1.0)


def _labelled(spark, base) -> tuple[DataFrame, DataFrame]:
    t = truth(spark, base)
    return scored(spark, base).join(t.select(G), G, "left_semi"), t


def q_f05_per_entity(spark, base):
    s, t = _labelled(spark, base)
    per = decision.f05_per_entity(decision.to_lists(decision.choose_by_threshold(s, 0.6), t), t)
    return per.select(G, F.round("precision", 6).alias("precision"), F.round("recall", 6).alias("recall"), F.round("f05", 6).alias("f05"), "is_singleton")


def q_tune_grid(spark, base):
    s, t = _labelled(spark, base)
    return decision.tune_decision(s, t).select("rule", "tau", "min_p", "alpha", F.round("f05", 6).alias("f05"))


def q_joint_probability(spark, base):
    return rules.joint_probability(scored(spark, base)).select(G, "cand_id", F.round("p", 6).alias("p"))


def q_reassign_strength(spark, base):
    return rules.reassign(scored(spark, base), 0.3, "strength", 0.05).select(G, "cand_id", "p")


def q_reassign_explain(spark, base):
    return rules.reassign(scored(spark, base), 0.3, "explain", 0.05, add_views(clean(spark, base)), add_views(pool(spark, base))).select(G, "cand_id", "p")


def _numbers(spark, base) -> tuple[DataFrame, DataFrame]:
    return rules.numbers_frame(simple_views(clean(spark, base)), G, "nums1"), rules.numbers_frame(simple_views(pool(spark, base)), "cand_id", "nums2")


def q_conflict_p90(spark, base):
    return rules.apply_post(scored(spark, base), *_numbers(spark, base), "conflict_p90")


def q_number_flags(spark, base):
    f = rules.number_flags(scored(spark, base), *_numbers(spark, base)).where(F.col("p") >= rules.FLOOR)
    return f.select(G, "cand_id", "p", "conflict", "num_match", "grp_has_match", "num_cluster", F.coalesce("num_delta", F.lit(-1)).alias("num_delta"))


def q_post_variants(spark, base):
    """Pairs that each variant sets to 0, by variant and country."""
    s = materialize(scored(spark, base), "scored")
    a, b = (materialize(n, "numbers") for n in _numbers(spark, base))
    out = None
    for name in rules.VARIANTS:
        d = rules.apply_post(s, a, b, name).groupBy("country").agg(F.count_if(F.col("p") == 0).alias("n_zero"), F.round(F.sum("p"), 3).alias("sum_p")).withColumn("variant", F.lit(name))
        out = d if out is None else out.unionByName(d)
    return out


def q_blend(spark, base):
    s = scored(spark, base)
    second = s.where(F.col("p") >= 0.2).withColumn("p", F.round(F.col("p") * F.col("p"), 6))
    return rules.blend(s, [second]).select(G, "cand_id", F.round("p", 7).alias("p"))


def q_blend_weights_remap(spark, base):
    s = scored(spark, base)
    second = s.where(F.col("p") >= 0.2).withColumn("p", F.round(F.col("p") * F.col("p"), 6))
    d = rules.remap_threshold(rules.blend(s, [second], [2.0, 1.0]), 0.7, {"India": 0.5, "France": 0.8})
    return d.select(G, "cand_id", F.round("p", 9).alias("p"))


def q_no_match_rule(spark, base):
    s = scored(spark, base)
    chosen = decision.choose_by_threshold(s, 0.4).join(s.select(G, "cand_id", "p"), [G, "cand_id"])
    return rules.no_match_rule(chosen, *_numbers(spark, base), 2, 0.6, one_source=True, numbers_differ=True)


# ---------------------------------------------------------------- features
def _pairs(spark, base) -> DataFrame:
    b = F.col("bscore").cast("double")
    c = table(spark, base, "candidate_pairs").where(F.col(G).isNotNull() & b.isNotNull() & ~F.isnan(b))
    return c.groupBy(G, "cand_id").agg(F.max(b).alias("bscore"), F.max("n_keytypes").cast("long").alias("n_keytypes")).withColumn("source", F.substring("cand_id", 1, 2))


def q_overlap_features(spark, base):
    a, b = simple_views(clean(spark, base)), simple_views(pool(spark, base))
    blank = {"name_legal": F.lit(""), "addr_states": F.array().cast("array<string>")}
    cols = ("name_core_tokens", "name_core", "addr_tokens", "addr_numbers", "name_legal", "addr_states")
    d = features.overlap_features(features.attach_records(_pairs(spark, base), a.withColumns(blank), b.withColumns(blank), cols))
    names = ("ntok_inter", "ntok_jacc", "ntok_cont1", "atok_inter", "atok_cont2", "num_inter", "num_jacc", "num_first_match", "num_conflict", "ntok_only1", "ntok_only2", "name_one_sub", "num_delta_small", "num_delta_log")
    return d.select(G, "cand_id", *(F.round(F.col(n), 6).alias(n) for n in names))


def q_idf_features(spark, base):
    a, b = simple_views(clean(spark, base)), simple_views(pool(spark, base))
    idf = features.token_idf(a, b)
    d = features.idf_features(features.attach_records(_pairs(spark, base), features.with_idf(a, idf), features.with_idf(b, idf), ("name_core_tokens", "name_idf")))
    return d.select(G, "cand_id", *(F.round(F.col(n), 6).alias(n) for n in ("idf_shared_sum", "idf_shared_max", "idf_frac1", "idf_frac2", "idf_miss1_max", "idf_miss2_max")))


def q_jaro_winkler(spark, base):
    a = simple_views(clean(spark, base)).select(F.col("entity_id").alias(G), F.col("name_core").alias("n1"))
    b = simple_views(pool(spark, base)).select(F.col("entity_id").alias("cand_id"), F.col("name_core").alias("n2"))
    d = _pairs(spark, base).join(a, G).join(b, "cand_id")
    return d.select(G, "cand_id", F.round(similarity("jaro_winkler", F.col("n1"), F.col("n2")), 6).alias("jw"))


def q_fuzz_ratios(spark, base):
    a = simple_views(clean(spark, base)).select(F.col("entity_id").alias(G), F.col("name_core").alias("n1"))
    b = simple_views(pool(spark, base)).select(F.col("entity_id").alias("cand_id"), F.col("name_core").alias("n2"))
    d = _pairs(spark, base).join(a, G).join(b, "cand_id")
    return d.select(G, "cand_id", *(F.round(similarity(k, F.col("n1"), F.col("n2")), 6).alias(k) for k in ("ratio", "token_sort_ratio", "token_set_ratio", "partial_ratio")))


def _features(spark, base) -> DataFrame:
    a, b = (features.add_name_freq(v) for v in _views(spark, base))
    return features.compute_features(_pairs(spark, base), a, b, features.token_idf(a, b))


def q_features_61(spark, base):
    return _features(spark, base)


def q_stage2_claims(spark, base):
    d = stage2.claim_features(scored(spark, base))
    return d.select(G, "cand_id", *(F.round(F.col(c).cast("double"), 6).alias(c) for c in ("p1", "n_s1_claims", "is_best_s1", "p_best_other_s1", "p_rank", "grp_n", "n_anchor_other", "p_sum_other", "p_gap_top", "p_max_other")))


def q_stage2_features(spark, base):
    return stage2.stage2_features(scored(spark, base), add_views(clean(spark, base)), add_views(pool(spark, base)))


# ---------------------------------------------------------------- learning
def q_alias_learning(spark, base):
    return aliases.learn_aliases(add_views(clean(spark, base)), add_views(pool(spark, base)), explode_ground_truth(truth(spark, base)), min_count=2)


def q_siblings(spark, base):
    return siblings.make_siblings(add_views(clean(spark, base)), pool(spark, base), explode_ground_truth(truth(spark, base)), 0.9)


def _labelled_features(spark, base) -> DataFrame:
    t = truth(spark, base)
    f = _features(spark, base).join(t.select(G), G, "left_semi")
    return materialize(model.label_pairs(f, explode_ground_truth(t)), "labelled")


def q_gbt_scores(spark, base):
    """Out-of-fold probabilities of boosted trees, with the operator's own parameters, on all labelled pairs."""
    return model.cross_validated(_labelled_features(spark, base), features.FEATURES).select(G, "cand_id", "y", F.round("p", 6).alias("p"))


def q_auc_ranks(spark, base):
    s, t = _labelled(spark, base)
    return model.auc_by_ranks(model.label_pairs(s, explode_ground_truth(t)))


def q_split_entities(spark, base):
    ids = clean(spark, base).select(F.col("entity_id").alias(G))
    n = ids.distinct().count()
    return model.split_entities(ids, n // 2, n // 5)


def q_seeded_fraction(spark, base):
    return sampling.seeded_fraction(clean(spark, base), "entity_id", 0.1).select("entity_id")


def q_example_pairs(spark, base):
    """A sample of true pairs with the raw fields of both records."""
    pairs = explode_ground_truth(truth(spark, base)).withColumnRenamed("matched_id", "cand_id")
    return sampling.example_pairs(pairs, clean(spark, base), pool(spark, base), 40)


# ---------------------------------------------------------------- diagnostics
def q_band_shares(spark, base):
    return diagnostics.band_shares(scored(spark, base)).select("country", *(F.col(f"`{b}`").alias(f"b{i}") for i, b in enumerate(diagnostics.RIGHT_LABELS)))


def q_bands(spark, base):
    s, t = _labelled(spark, base)
    ex = model.label_pairs(decision.apply_exclusivity(s), explode_ground_truth(t))
    return diagnostics.bands_left_closed(ex, t.count())


def _selected(spark, base) -> DataFrame:
    s = scored(spark, base)
    return decision.choose_by_threshold(s, 0.5).join(s.select(G, "cand_id", "p"), [G, "cand_id"])


def _entities(spark, base) -> DataFrame:
    return clean(spark, base).select(F.col("entity_id").alias(G), "country").distinct()


def q_prediction_summary(spark, base):
    return diagnostics.prediction_summary(diagnostics.prediction_counts(_selected(spark, base), _entities(spark, base)), "all")


def q_cell_labels(spark, base):
    cells = rules.per_entity_cells(_selected(spark, base), *_numbers(spark, base))
    return diagnostics.cell_labels(_entities(spark, base), cells)


def q_contested(spark, base):
    return diagnostics.contested(scored(spark, base), 0.3)


def q_contested_pairs(spark, base):
    return diagnostics.contested_pairs(scored(spark, base), 0.3)


def q_lookalikes(spark, base):
    return diagnostics.lookalike_flags(simple_views(pool(spark, base)))


def q_rate_by_flag(spark, base):
    flags = diagnostics.lookalike_flags(simple_views(clean(spark, base)))
    return diagnostics.rate_by_flag(flags, truth(spark, base), "n_matches")


def q_count_distribution(spark, base):
    """Share of clean records by number of true and of predicted matches: a full outer join."""
    s, t = _labelled(spark, base)
    ent = _entities(spark, base).join(t.select(G, "n_matches"), G)
    pred = diagnostics.prediction_counts(decision.choose_by_threshold(s, 0.5), ent)
    return diagnostics.count_distribution(pred, "n_matches", "train_true").join(diagnostics.count_distribution(pred, "n_pred", "test_pred"), ["country", "k"], "full")


def _errors(spark, base) -> DataFrame:
    s, t = _labelled(spark, base)
    per = decision.f05_per_entity(decision.to_lists(decision.choose_by_threshold(s, 0.6), t), t)
    return diagnostics.error_categories(per, explode_ground_truth(t), s).join(_entities(spark, base), G)


def q_error_summary(spark, base):
    return diagnostics.error_summary(_errors(spark, base))


def q_error_by_country(spark, base):
    return diagnostics.error_by_country(_errors(spark, base))


def q_unclaimed(spark, base):
    s = scored(spark, base)
    return diagnostics.unclaimed(pool(spark, base), decision.choose_by_threshold(s, 0.5), s)


def q_diagonal_union(spark, base):
    s2 = diagnostics.source_stats(table(spark, base, "s2")).select("country", "n_rows", "name_empty").withColumn("src", F.lit("S2"))
    s3 = diagnostics.source_stats(table(spark, base, "s3")).select("country", "n_rows", "addr_empty").withColumn("src", F.lit("S3"))
    return s2.unionByName(s3, allowMissingColumns=True)


def q_patch(spark, base):
    """Views of records whose name starts with an honorific made anew, all others kept."""
    old = simple_views(pool(spark, base)).select("entity_id", "name_core").dropDuplicates(["entity_id"])
    new = old.where(F.col("name_core").startswith("m s ")).withColumn("name_core", F.expr("substring(name_core, 5)"))
    return aliases.patch(old, new)


def q_legal_conflicts(spark, base):
    d = diagnostics.legal_conflicts(_selected(spark, base), add_views(clean(spark, base)), add_views(pool(spark, base)))
    return d.groupBy("legal_conflict").agg(F.count("*").alias("n_pairs"), F.round(F.avg("p"), 6).alias("p"))


def q_feature_shift(spark, base):
    d = _pairs(spark, base).withColumn("nk", F.col("n_keytypes").cast("double"))
    return diagnostics.feature_shift(d.where("source = 'S2'"), d.where("source = 'S3'"), ("bscore", "nk"))


QUERIES = {k: f for k, f in list(globals().items()) if k.startswith("q_")}

_SHARE = "round(100 * avg(CAST({} AS DOUBLE)), 2)"


def _stats_sql(table_: str) -> str:
    n, a = "coalesce(business_name, '')", "coalesce(business_address, '')"
    s = _SHARE.format
    return f"""SELECT country, count(*) AS n_rows, {s(f"trim({n}) = ''")} AS name_empty, {s(f"trim({a}) = ''")} AS addr_empty, {s(f"regexp_matches(lower({a}), '\\bnull\\b')")} AS addr_has_null_literal,
        {s(f"regexp_matches({n}, '[\\x{{0900}}-\\x{{0D7F}}]')")} AS name_indic_script, {s(f"regexp_matches({a}, '[\\x{{0900}}-\\x{{0D7F}}]')")} AS addr_indic_script,
        {s(f"regexp_matches({n}, '[\\x{{00C0}}-\\x{{024F}}]')")} AS name_accented_latin, {s(f"regexp_matches({n}, '[^\\x00-\\x7F]')")} AS name_any_non_ascii, {s(f"regexp_matches({a}, '\\d')")} AS addr_has_digit,
        {s(f"regexp_matches({a}, '(^|\\D)\\d{{5}}(\\D|$)')")} AS addr_5digit_token, {s(f"regexp_matches({a}, '(^|\\D)\\d{{6}}(\\D|$)')")} AS addr_6digit_token,
        {s(f"regexp_matches({n}, '(?i)(\\.com|\\.in|\\.fr|www\\.)')")} AS name_has_domain, round(avg(length({n})), 2) AS name_len_mean, round(avg(length({a})), 2) AS addr_len_mean FROM {table_} GROUP BY country"""


_EK = """
    ek AS (SELECT *, row_number() OVER w AS k, 1.25 * sum(p) OVER (PARTITION BY source1_entity_id ORDER BY p DESC, cand_id ROWS UNBOUNDED PRECEDING)
               / (0.25 * sum(p) OVER (PARTITION BY source1_entity_id) + row_number() OVER w) AS ek,
               exp(sum(ln(greatest(1 - p, 1e-9))) OVER (PARTITION BY source1_entity_id)) AS e0
           FROM excl WINDOW w AS (PARTITION BY source1_entity_id ORDER BY p DESC, cand_id))"""
_LABELLED_SQL = "lab AS (SELECT s.* FROM scored s WHERE source1_entity_id IN (SELECT source1_entity_id FROM truth))"
_PER = """
    sel AS (SELECT source1_entity_id, cand_id FROM (SELECT * FROM lab QUALIFY row_number() OVER (PARTITION BY cand_id ORDER BY p DESC, source1_entity_id) = 1) WHERE p >= 0.6),
    lists AS (SELECT source1_entity_id, list(cand_id) AS ids FROM sel GROUP BY 1),
    per0 AS (SELECT t.*, coalesce(l.ids, []) AS ids, len(list_intersect(coalesce(l.ids, []), t.matched)) AS tp FROM truth t LEFT JOIN lists l USING (source1_entity_id)),
    per1 AS (SELECT *, len(ids) AS np, CAST(tp AS DOUBLE) / greatest(len(ids), 1) AS pr, CAST(tp AS DOUBLE) / greatest(n_matches, 1) AS rc FROM per0),
    per AS (SELECT *, CASE WHEN n_matches = 0 AND np = 0 THEN 1.0 WHEN n_matches = 0 OR np = 0 OR tp = 0 THEN 0.0 ELSE 1.25 * pr * rc / (0.25 * pr + rc) END AS f05 FROM per1)"""
_NUMS_SQL = f"""{_CLEAN_SQL}, {_POOL_SQL}, {_SCORED_SQL},
    flags0 AS (SELECT s.*, q.addr_numbers AS n1, pl.addr_numbers AS n2, len(list_intersect(q.addr_numbers, pl.addr_numbers)) AS shared FROM scored s
               LEFT JOIN q ON q.entity_id = s.source1_entity_id LEFT JOIN pl ON pl.entity_id = s.cand_id),
    flags1 AS (SELECT *, coalesce(len(n1), 0) > 0 AND coalesce(len(n2), 0) > 0 AND coalesce(shared, 0) = 0 AS conflict, coalesce(shared, 0) > 0 AS num_match FROM flags0)"""
_PAIRS_SQL = """
    prs AS (SELECT source1_entity_id, cand_id, left(cand_id, 2) AS source, max(CAST(bscore AS DOUBLE)) AS bscore, max(n_keytypes) AS n_keytypes FROM candidate_pairs
            WHERE source1_entity_id IS NOT NULL AND bscore IS NOT NULL AND NOT isnan(bscore) GROUP BY 1, 2)"""
_JOINED_SQL = f"""{_CLEAN_SQL}, {_POOL_SQL}, {_PAIRS_SQL},
    j AS (SELECT prs.*, q.country, q.name_core_tokens AS t1, pl.name_core_tokens AS t2, q.name_core AS c1, pl.name_core AS c2, q.addr_tokens AS a1, pl.addr_tokens AS a2, q.addr_numbers AS n1, pl.addr_numbers AS n2
          FROM prs JOIN q ON q.entity_id = prs.source1_entity_id JOIN pl ON pl.entity_id = prs.cand_id)"""
_IDF_SQL = """
    allr AS (SELECT country, name_core_tokens FROM q UNION ALL SELECT country, name_core_tokens FROM pl),
    nd AS (SELECT country, count(*) AS n FROM allr GROUP BY 1),
    idf AS (SELECT country, tok, ln(CAST(n AS DOUBLE) / df) AS idf FROM (SELECT country, tok, count(*) AS df FROM (SELECT country, unnest(name_core_tokens) AS tok FROM allr) GROUP BY 1, 2) JOIN nd USING (country))"""
_TUNE = """
    base AS (SELECT * FROM (SELECT * FROM lab) QUALIFY row_number() OVER (PARTITION BY cand_id ORDER BY p DESC, source1_entity_id) = 1),
    alphas AS (SELECT unnest([0.8, 1.0, 1.25, 1.5]) AS alpha), minps AS (SELECT unnest([0.1, 0.2, 0.3, 0.4, 0.5]) AS min_p),
    ekk AS (SELECT base.*, alpha, row_number() OVER w AS k, 1.25 * sum(p) OVER (PARTITION BY alpha, source1_entity_id ORDER BY p DESC, cand_id ROWS UNBOUNDED PRECEDING)
            / (0.25 * alpha * sum(p) OVER (PARTITION BY alpha, source1_entity_id) + row_number() OVER w) AS ek, exp(sum(ln(greatest(1 - p, 1e-9))) OVER (PARTITION BY alpha, source1_entity_id)) AS e0
            FROM base, alphas WINDOW w AS (PARTITION BY alpha, source1_entity_id ORDER BY p DESC, cand_id)),
    best AS (SELECT alpha, min_p, source1_entity_id, round(ek, 9) AS bek, k AS bk FROM ekk, minps WHERE p >= min_p QUALIFY row_number() OVER (PARTITION BY alpha, min_p, source1_entity_id ORDER BY round(ek, 9) DESC, k) = 1),
    pick AS (SELECT 'threshold' AS rule, tau, NULL::DOUBLE AS min_p, NULL::DOUBLE AS alpha, source1_entity_id, cand_id FROM base, (SELECT unnest([0.3, 0.4, 0.5, 0.6, 0.7, 0.8]) AS tau) WHERE p >= tau
             UNION ALL SELECT 'expected_f', NULL, b.min_p, b.alpha, e.source1_entity_id, e.cand_id FROM ekk e JOIN best b ON e.alpha = b.alpha AND e.source1_entity_id = b.source1_entity_id WHERE bek > e0 AND k <= bk),
    grid AS (SELECT 'threshold' AS rule, tau, NULL::DOUBLE AS min_p, NULL::DOUBLE AS alpha FROM (SELECT unnest([0.3, 0.4, 0.5, 0.6, 0.7, 0.8]) AS tau) UNION ALL SELECT 'expected_f', NULL, min_p, alpha FROM minps, alphas),
    hits AS (SELECT p.rule, p.tau, p.min_p, p.alpha, p.source1_entity_id, count(*) AS np, sum(CAST(list_contains(t.matched, p.cand_id) AS INT)) AS tp FROM pick p JOIN truth t USING (source1_entity_id) GROUP BY ALL),
    pe AS (SELECT g.*, t.n_matches AS nt, coalesce(h.np, 0) AS np, coalesce(h.tp, 0) AS tp FROM grid g CROSS JOIN truth t LEFT JOIN hits h ON h.rule = g.rule AND h.tau IS NOT DISTINCT FROM g.tau AND h.min_p IS NOT DISTINCT FROM g.min_p AND h.alpha IS NOT DISTINCT FROM g.alpha AND h.source1_entity_id = t.source1_entity_id)"""



def _variants_sql() -> str:
    """All variants of the number rules: what fires, and for some the blanking of a whole record."""
    parts = []
    for name, v in rules.VARIANTS.items():
        fire = [f"p < {v.p_max}"] + ["grp"] * v.group + [f"(delta BETWEEN 1 AND {v.near} AND p < {v.near_p})"] * bool(v.near) + ["(grp AND cluster >= 2)"] * v.sibling
        ruled = f"SELECT *, CASE WHEN conflict AND ({' OR '.join(fire)}) THEN 0.0 ELSE p END AS p1 FROM fl" if name != "none" else "SELECT *, p AS p1 FROM fl"
        if v.all_conflict:
            near = f" AND coalesce(delta BETWEEN 1 AND {v.all_near}, false)" if v.all_near else ""
            bad = f"NOT (p1 >= 0.5) OR (conflict AND p1 < {v.all_conflict}{near})"
            ruled = f"SELECT *, CASE WHEN bool_or(p1 >= 0.5) OVER g AND bool_and({bad}) OVER g THEN 0.0 ELSE p1 END AS p2 FROM ({ruled}) WINDOW g AS (PARTITION BY source1_entity_id)"
        column = "p2" if v.all_conflict else "p1"
        parts.append(f"SELECT country, count(*) FILTER ({column} = 0) AS n_zero, round(sum({column}), 3) AS sum_p, '{name}' AS variant FROM (SELECT country, {column} FROM ({ruled}) UNION ALL SELECT country, p FROM flags1 WHERE p < 0.3) GROUP BY 1")
    return f"""WITH {_NUMS_SQL}, fl AS (SELECT source1_entity_id, country, p, conflict, bool_or(p >= 0.5 AND num_match) OVER (PARTITION BY source1_entity_id) AS grp,
        CASE WHEN n2[1] IS NULL THEN 0 ELSE count(*) OVER (PARTITION BY source1_entity_id, n2[1]) END AS cluster, abs(TRY_CAST(n1[1] AS BIGINT) - TRY_CAST(n2[1] AS BIGINT)) AS delta FROM flags1 WHERE p >= 0.3)
        {" UNION ALL ".join(parts)}"""


ORACLES = {
    "q_accent_fold": f"SELECT entity_id, {_fold_sql('business_name')} AS name, {_fold_sql('business_address')} AS address FROM (SELECT DISTINCT entity_id, business_name, business_address, country FROM s1)",
    "q_name_views": f"""WITH {_NAME_SQL} SELECT entity_id, array_to_string(list_sort(toks), ' ') AS tokens, array_to_string(list_sort(core), ' ') AS core,
        array_to_string(list_sort(list_distinct(list_filter(toks, lambda x: x IN {_words(sorted(set(LEGAL_FORMS.values())))}))), ' ') AS name_legal,
        regexp_matches(f, '{_DBA}') AS name_has_dba, regexp_matches(f, 'www\\.|{_DOM}') AS name_is_domain, regexp_full_match(f, '[^\\w]*[@#][\\w.]+\\s*') AS name_is_handle FROM f4""",
    "q_name_skeleton": f"""WITH {_NAME_SQL} SELECT entity_id, array_to_string(content, '') AS name_concat, array_to_string(list_transform(content, lambda x: x[1:1]), '') AS name_initials, {_DOUBLES} AS name_skeleton FROM f4""",
    "q_address_views": f"WITH {_ADDR_SQL} SELECT entity_id, array_to_string(nums, ' ') AS numbers, array_to_string(st, ' ') AS states, array_to_string(words, ' ') AS words, len(words) + len(nums) = 0 AS addr_empty FROM a3",
    "q_source_stats": _stats_sql("s2"),
    "q_id_stats": "SELECT count(*) AS n_rows, count(DISTINCT entity_id) AS unique_ids, count(*) - count(DISTINCT entity_id) AS duplicate_id_rows, count(*) FILTER (country IS NULL) AS country_null FROM s3",
    "q_truth_stats": f"""WITH {_TRUTH_SQL}, ids AS (SELECT id, count(*) AS n FROM (SELECT unnest(matched) AS id FROM truth) GROUP BY 1),
        per AS (SELECT *, len(list_filter(matched, lambda x: starts_with(x, 'S2-'))) AS n_s2, len(list_filter(matched, lambda x: starts_with(x, 'S3-'))) AS n_s3 FROM truth)
        SELECT * FROM (SELECT count(*) AS s1_rows, count(*) - count(DISTINCT source1_entity_id) AS duplicate_s1_rows, {_SHARE.format("n_matches = 0")} AS singleton_rate_pct, round(avg(n_matches), 3) AS matches_mean,
          CAST(median(n_matches) AS DOUBLE) AS matches_median, CAST(max(n_matches) AS INT) AS matches_max, round(avg(n_s2), 3) AS s2_per_s1_mean, round(avg(n_s3), 3) AS s3_per_s1_mean, {_SHARE.format("n_s2 = 0")} AS pct_no_s2, {_SHARE.format("n_s3 = 0")} AS pct_no_s3 FROM per),
        (SELECT CAST(sum(n) AS BIGINT) AS positive_pairs, count(*) AS distinct_matched_ids, count(*) FILTER (n > 1) AS ids_in_more_than_one, CAST(coalesce(sum(n) FILTER (NOT regexp_matches(id, '^S[23]-')), 0) AS BIGINT) AS bad_prefix FROM ids)""",
    "q_truth_distribution": f"WITH {_TRUTH_SQL} SELECT CAST(least(n_matches, 10) AS INT) AS k, count(*) AS n FROM truth GROUP BY 1",
    "q_coverage": f"""WITH {_TRUTH_SQL}, m AS (SELECT DISTINCT unnest(matched) AS id FROM truth), pl AS (SELECT DISTINCT * FROM {_POOL})
        SELECT left(entity_id, 2) AS src, country, count(*) AS n_rows, round(100.0 * count(m.id) / count(*), 2) AS pct_matched FROM pl LEFT JOIN m ON m.id = entity_id GROUP BY 1, 2""",
    "q_country_mismatch": f"""WITH {_TRUTH_SQL}, m AS (SELECT source1_entity_id, unnest(matched) AS id FROM truth), pl AS (SELECT DISTINCT * FROM {_POOL}), c AS (SELECT DISTINCT entity_id, business_name, business_address, country FROM s1)
        SELECT count(*) AS n_pairs, count(*) FILTER (c.country <> pl.country) AS n_mismatch FROM m JOIN c ON c.entity_id = m.source1_entity_id JOIN pl ON pl.entity_id = m.id""",
    "q_name_freq": f"WITH {_POOL_SQL} SELECT entity_id, count(*) OVER (PARTITION BY country, name_concat) AS name_freq FROM pl",
    "q_token_idf": f"WITH {_CLEAN_SQL}, {_POOL_SQL}, {_IDF_SQL} SELECT country, tok, round(idf, 6) AS idf FROM idf",
    "q_token_shift": f"""WITH {_simple_sql("x", "s2")}, {_simple_sql("y", "s3")},
        tr AS (SELECT tok, count(*) * 100000.0 / (SELECT count(*) FROM x) AS r FROM (SELECT name_core_tokens[-1] AS tok FROM x) WHERE tok IS NOT NULL GROUP BY 1),
        te AS (SELECT tok, count(*) * 100000.0 / (SELECT count(*) FROM y) AS r FROM (SELECT name_core_tokens[-1] AS tok FROM y) WHERE tok IS NOT NULL GROUP BY 1)
        SELECT te.tok, round(te.r, 4) AS test, round(coalesce(tr.r, 0), 4) AS train, round(te.r - coalesce(tr.r, 0), 4) AS excess, round(te.r / (coalesce(tr.r, 0) + 5), 6) AS ratio FROM te LEFT JOIN tr USING (tok) WHERE te.r >= 50""",
    "q_block_keys": f"WITH {_POOL_SQL}, {_keys_sql('pk', 'pl')} SELECT country, t, count(*) AS n_keys, max(df) AS largest, CAST(sum(df) AS BIGINT) AS n_rows FROM (SELECT country, t, key, count(*) AS df FROM pk GROUP BY 1, 2, 3) GROUP BY 1, 2",
    "q_block_topk": f"WITH {_block_sql()} SELECT * FROM blocks QUALIFY row_number() OVER (PARTITION BY source1_entity_id, source ORDER BY bscore DESC, cand_id) <= 8",
    "q_block_log_weight": f"WITH {_block_sql('log2(df + 1)')} SELECT * FROM blocks QUALIFY row_number() OVER (PARTITION BY source1_entity_id, source ORDER BY bscore DESC, cand_id) <= 3",
    "q_block_recall": f"""WITH {_block_sql()}, {_TRUTH_SQL}, top AS (SELECT * FROM blocks WHERE source1_entity_id IN (SELECT source1_entity_id FROM truth) QUALIFY row_number() OVER (PARTITION BY source1_entity_id, source ORDER BY bscore DESC, cand_id) <= 8),
        m AS (SELECT source1_entity_id, unnest(matched) AS cand_id FROM truth)
        SELECT count(*) AS true_pairs, count(top.cand_id) AS found, round(count(top.cand_id) / greatest(count(*), 1), 4) AS recall, round((SELECT count(*) FROM top) / greatest((SELECT count(*) FROM truth), 1), 2) AS cands_per_query
        FROM m LEFT JOIN top USING (source1_entity_id, cand_id)""",
    "q_rarest_shared_key": f"""WITH {_block_sql()}, {_TRUTH_SQL}, m AS (SELECT source1_entity_id, unnest(matched) AS matched_id FROM truth),
        pks AS (SELECT pk.id, pk.country, pk.t, pk.key, df FROM pk JOIN sizes USING (country, key))
        SELECT source1_entity_id, matched_id, pks.t, df FROM m JOIN qk ON qk.id = source1_entity_id JOIN pks ON pks.id = matched_id AND pks.country = qk.country AND pks.key = qk.key
        QUALIFY row_number() OVER (PARTITION BY source1_entity_id, matched_id ORDER BY df, pks.t) = 1""",
    "q_exclusivity": f"WITH {_SCORED_SQL}, {_EXCLUSIVE_SQL} SELECT * FROM excl",
    "q_threshold_lists": f"""WITH {_SCORED_SQL}, {_EXCLUSIVE_SQL}, l AS (SELECT source1_entity_id, string_agg(cand_id, ',' ORDER BY cand_id) AS ids FROM excl WHERE p >= 0.6 GROUP BY 1)
        SELECT s.entity_id AS source1_entity_id, coalesce(ids, '') AS ids FROM (SELECT DISTINCT entity_id FROM s1) s LEFT JOIN l ON l.source1_entity_id = s.entity_id""",
    "q_expected_f": f"WITH {_SCORED_SQL}, {_EXCLUSIVE_SQL}, {_EK} SELECT source1_entity_id, cand_id, k, round(ek, 6) AS ek, round(e0, 6) AS e0 FROM ek",
    "q_expected_f_choice": f"""WITH {_SCORED_SQL}, {_EXCLUSIVE_SQL}, {_EK}, best AS (SELECT source1_entity_id, round(ek, 9) AS bek, k AS bk FROM ek WHERE p >= 0.3 QUALIFY row_number() OVER (PARTITION BY source1_entity_id ORDER BY round(ek, 9) DESC, k) = 1)
        SELECT source1_entity_id, cand_id FROM ek JOIN best USING (source1_entity_id) WHERE bek > e0 AND k <= bk""",
    "q_f05_per_entity": f"WITH {_TRUTH_SQL}, {_SCORED_SQL}, {_LABELLED_SQL}, {_PER} SELECT source1_entity_id, round(pr, 6) AS precision, round(rc, 6) AS recall, round(f05, 6) AS f05, n_matches = 0 AS is_singleton FROM per",
    "q_tune_grid": f"""WITH {_TRUTH_SQL}, {_SCORED_SQL}, {_LABELLED_SQL}, {_TUNE} SELECT rule, CAST(tau AS DOUBLE) AS tau, CAST(min_p AS DOUBLE) AS min_p, CAST(alpha AS DOUBLE) AS alpha,
        round(avg(CASE WHEN nt = 0 AND np = 0 THEN 1.0 WHEN nt = 0 OR np = 0 OR tp = 0 THEN 0.0 ELSE 1.25 * (CAST(tp AS DOUBLE) / np) * (CAST(tp AS DOUBLE) / nt) / (0.25 * (CAST(tp AS DOUBLE) / np) + CAST(tp AS DOUBLE) / nt) END), 6) AS f05 FROM pe GROUP BY 1, 2, 3, 4""",
    "q_joint_probability": f"""WITH {_SCORED_SQL}, o AS (SELECT *, greatest(1e-6, least(1 - 1e-6, p)) AS pc FROM scored), oo AS (SELECT *, CASE WHEN pc >= 0.05 THEN pc / (1 - pc) ELSE 0 END AS od FROM o)
        SELECT source1_entity_id, cand_id, round(CASE WHEN pc >= 0.05 THEN od / (1 + sum(od) OVER (PARTITION BY cand_id)) ELSE p END, 6) AS p FROM oo""",
    "q_reassign_strength": f"""WITH {_SCORED_SQL}, hi AS (SELECT *, round(sum(p) OVER (PARTITION BY source1_entity_id), 9) AS st, max(p) OVER (PARTITION BY cand_id) AS top, row_number() OVER (PARTITION BY cand_id ORDER BY p DESC, source1_entity_id) = 1 AS ib FROM scored WHERE p >= 0.3)
        SELECT source1_entity_id, cand_id, p FROM hi WHERE p >= top - 0.05 QUALIFY row_number() OVER (PARTITION BY cand_id ORDER BY st DESC, ib DESC, p DESC, source1_entity_id) = 1""",
    "q_conflict_p90": f"WITH {_NUMS_SQL} SELECT source1_entity_id, cand_id, country, CASE WHEN p >= 0.3 AND conflict AND p < 0.9 THEN 0.0 ELSE p END AS p FROM flags1",
    "q_number_flags": f"""WITH {_NUMS_SQL} SELECT source1_entity_id, cand_id, p, conflict, num_match, bool_or(p >= 0.5 AND num_match) OVER (PARTITION BY source1_entity_id) AS grp_has_match,
        CASE WHEN n2[1] IS NULL THEN 0 ELSE count(*) OVER (PARTITION BY source1_entity_id, n2[1]) END AS num_cluster, coalesce(abs(TRY_CAST(n1[1] AS BIGINT) - TRY_CAST(n2[1] AS BIGINT)), -1) AS num_delta FROM flags1 WHERE p >= 0.3""",
    "q_blend": f"WITH {_SCORED_SQL} SELECT source1_entity_id, cand_id, round(CASE WHEN p >= 0.2 THEN (p + round(p * p, 6)) / 2 ELSE p END, 7) AS p FROM scored",
    "q_blend_weights_remap": f"""WITH {_SCORED_SQL}, b AS (SELECT *, (2.0 * p + 1.0 * CASE WHEN p >= 0.2 THEN round(p * p, 6) ELSE p END) / 3.0 AS m, CASE country WHEN 'India' THEN 0.5 WHEN 'France' THEN 0.8 END AS tc FROM scored)
        SELECT source1_entity_id, cand_id, round(CASE WHEN tc IS NULL THEN m WHEN m < tc THEN m * 0.7 / tc ELSE 0.7 + (m - tc) * (1 - 0.7) / (1 - tc) END, 9) AS p FROM b""",
    "q_no_match_rule": f"""WITH {_NUMS_SQL}, {_EXCLUSIVE_SQL}, sel AS (SELECT f.* FROM flags1 f JOIN excl USING (source1_entity_id, cand_id) WHERE f.p >= 0.4),
        per AS (SELECT source1_entity_id, count(*) AS k, max(p) AS pmax, count(DISTINCT left(cand_id, 2)) AS ns, bool_or(num_match OR coalesce(len(n1), 0) = 0) AS ok FROM sel GROUP BY 1)
        SELECT source1_entity_id, cand_id, p FROM sel WHERE source1_entity_id NOT IN (SELECT source1_entity_id FROM per WHERE k <= 2 AND pmax < 0.6 AND ns = 1 AND NOT ok)""",
    "q_overlap_features": f"""WITH {_JOINED_SQL}, o AS (SELECT *, CAST(len(list_intersect(t1, t2)) AS DOUBLE) AS ti, CAST(len(list_intersect(a1, a2)) AS DOUBLE) AS ai, CAST(len(list_intersect(n1, n2)) AS DOUBLE) AS ni,
          list_min(list_filter(list_transform(n2, lambda x: abs(TRY_CAST(x AS BIGINT) - TRY_CAST(n1[1] AS BIGINT))), lambda x: x IS NOT NULL)) AS d FROM j)
        SELECT source1_entity_id, cand_id, ti AS ntok_inter, round(ti / greatest(len(list_distinct(t1 || t2)), 1), 6) AS ntok_jacc, round(ti / greatest(len(t1), 1), 6) AS ntok_cont1, ai AS atok_inter, round(ai / greatest(len(a2), 1), 6) AS atok_cont2,
          ni AS num_inter, round(ni / greatest(len(list_distinct(n1 || n2)), 1), 6) AS num_jacc, CAST(coalesce(list_contains(n2, n1[1]), false) AS DOUBLE) AS num_first_match, CAST(len(n1) > 0 AND len(n2) > 0 AND ni = 0 AS DOUBLE) AS num_conflict,
          len(t1) - ti AS ntok_only1, len(t2) - ti AS ntok_only2, CAST(len(t1) - ti = 1 AND len(t2) - ti = 1 AS DOUBLE) AS name_one_sub, CAST(coalesce(d BETWEEN 1 AND 30, false) AS DOUBLE) AS num_delta_small, round(coalesce(log10(d + 1), -1.0), 6) AS num_delta_log FROM o""",
    "q_idf_features": f"""WITH {_JOINED_SQL}, {_IDF_SQL}, mx AS (SELECT country, max(idf) AS m FROM idf GROUP BY 1),
        e1 AS (SELECT source1_entity_id, cand_id, x.tok, coalesce(idf, m) AS idf, list_contains(t2, x.tok) AS sh FROM (SELECT source1_entity_id, cand_id, country, t2, unnest(t1) AS tok FROM j) x LEFT JOIN idf ON idf.country = x.country AND idf.tok = x.tok LEFT JOIN mx ON mx.country = x.country),
        e2 AS (SELECT source1_entity_id, cand_id, x.tok, coalesce(idf, m) AS idf, list_contains(t1, x.tok) AS sh FROM (SELECT source1_entity_id, cand_id, country, t1, unnest(t2) AS tok FROM j) x LEFT JOIN idf ON idf.country = x.country AND idf.tok = x.tok LEFT JOIN mx ON mx.country = x.country),
        g1 AS (SELECT source1_entity_id, cand_id, sum(idf) AS s, coalesce(sum(idf) FILTER (sh), 0) AS ss, coalesce(max(idf) FILTER (sh), 0) AS sm, coalesce(max(idf) FILTER (NOT sh), 0) AS mi FROM e1 GROUP BY 1, 2),
        g2 AS (SELECT source1_entity_id, cand_id, sum(idf) AS s, coalesce(max(idf) FILTER (NOT sh), 0) AS mi FROM e2 GROUP BY 1, 2)
        SELECT j.source1_entity_id, j.cand_id, round(coalesce(g1.ss, 0), 6) AS idf_shared_sum, round(coalesce(g1.sm, 0), 6) AS idf_shared_max, round(coalesce(g1.ss, 0) / greatest(coalesce(g1.s, 0), 1e-6), 6) AS idf_frac1,
          round(coalesce(g1.ss, 0) / greatest(coalesce(g2.s, 0), 1e-6), 6) AS idf_frac2, round(coalesce(g1.mi, 0), 6) AS idf_miss1_max, round(coalesce(g2.mi, 0), 6) AS idf_miss2_max FROM j LEFT JOIN g1 USING (source1_entity_id, cand_id) LEFT JOIN g2 USING (source1_entity_id, cand_id)""",
    "q_jaro_winkler": f"WITH {_JOINED_SQL} SELECT source1_entity_id, cand_id, round(CASE WHEN c1 = c2 THEN 1.0 ELSE jaro_winkler_similarity(c1, c2) END, 6) AS jw FROM j",
    "q_stage2_claims": f"""WITH {_SCORED_SQL}, d AS (SELECT source1_entity_id, cand_id, p AS p1, row_number() OVER c AS cr, count(*) OVER (PARTITION BY cand_id) AS n, row_number() OVER g AS gr, count(*) OVER (PARTITION BY source1_entity_id) AS gn,
          nth_value(p, 1) OVER (PARTITION BY cand_id ORDER BY p DESC, source1_entity_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS c1, nth_value(p, 2) OVER (PARTITION BY cand_id ORDER BY p DESC, source1_entity_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS c2,
          nth_value(p, 1) OVER (PARTITION BY source1_entity_id ORDER BY p DESC, cand_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS g1, nth_value(p, 2) OVER (PARTITION BY source1_entity_id ORDER BY p DESC, cand_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS g2,
          sum(CAST(p >= 0.9 AS INT)) OVER (PARTITION BY source1_entity_id) AS an, sum(p) OVER (PARTITION BY source1_entity_id) AS sp, max(p) OVER (PARTITION BY source1_entity_id) AS mp
          FROM scored WHERE p >= 0.01 WINDOW c AS (PARTITION BY cand_id ORDER BY p DESC, source1_entity_id), g AS (PARTITION BY source1_entity_id ORDER BY p DESC, cand_id))
        SELECT source1_entity_id, cand_id, p1, CAST(n AS DOUBLE) AS n_s1_claims, CAST(cr = 1 AS DOUBLE) AS is_best_s1, coalesce(CASE WHEN cr = 1 THEN c2 ELSE c1 END, 0.0) AS p_best_other_s1, CAST(gr AS DOUBLE) AS p_rank, CAST(gn AS DOUBLE) AS grp_n,
          CAST(an - CAST(p1 >= 0.9 AS INT) AS DOUBLE) AS n_anchor_other, round(sp - p1, 6) AS p_sum_other, round(mp - p1, 6) AS p_gap_top, coalesce(CASE WHEN gr = 1 THEN g2 ELSE g1 END, 0.0) AS p_max_other FROM d""",
    "q_auc_ranks": f"""WITH {_TRUTH_SQL}, {_SCORED_SQL}, {_LABELLED_SQL}, y AS (SELECT lab.p, CAST(coalesce(list_contains(t.matched, cand_id), false) AS DOUBLE) AS y FROM lab JOIN truth t USING (source1_entity_id)),
        r AS (SELECT *, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0 AS rk FROM y)
        SELECT sum(y) AS n_pos, sum(1 - y) AS n_neg, round((sum(rk * y) - sum(y) * (sum(y) + 1) / 2) / greatest(sum(y) * sum(1 - y), 1.0), 9) AS auc FROM r""",
    "q_band_shares": f"""WITH {_SCORED_SQL}, b AS (SELECT country, CASE WHEN p <= 0.3 THEN 0 WHEN p <= 0.5 THEN 1 WHEN p <= 0.7 THEN 2 WHEN p <= 0.8 THEN 3 WHEN p <= 0.9 THEN 4 WHEN p <= 0.97 THEN 5 ELSE 6 END AS b, count(*) AS n FROM scored GROUP BY 1, 2),
        s AS (SELECT country, b, round(n / sum(n) OVER (PARTITION BY country), 4) AS s FROM b)
        SELECT country, {", ".join(f"max(s) FILTER (b = {i}) AS b{i}" for i in range(7))} FROM s GROUP BY 1""",
    "q_bands": f"""WITH {_TRUTH_SQL}, {_SCORED_SQL}, {_LABELLED_SQL}, ex AS (SELECT * FROM lab QUALIFY row_number() OVER (PARTITION BY cand_id ORDER BY p DESC, source1_entity_id) = 1),
        y AS (SELECT CASE {" ".join(f"WHEN p >= {lo} AND p < {hi} THEN '{lo:.2f}-{min(hi, 1):.2f}'" for lo, hi in diagnostics.LEFT_CLOSED)} END AS band, CAST(coalesce(list_contains(matched, cand_id), false) AS DOUBLE) AS y FROM ex JOIN truth USING (source1_entity_id))
        SELECT band, round(count(*) / greatest((SELECT count(*) FROM truth), 1), 6) AS pairs_per_s1, round(avg(y), 6) AS precision FROM y WHERE band IS NOT NULL GROUP BY 1""",
    "q_prediction_summary": f"""WITH {_SCORED_SQL}, {_EXCLUSIVE_SQL}, c AS (SELECT source1_entity_id, count(*) AS n FROM excl WHERE p >= 0.5 GROUP BY 1), e AS (SELECT DISTINCT entity_id, country FROM s1)
        SELECT country, count(*) AS s1, round(avg(coalesce(n, 0)), 3) AS pred_per_s1, round(avg(CAST(coalesce(n, 0) = 0 AS DOUBLE)), 4) AS share_0, round(avg(CAST(coalesce(n, 0) >= 6 AS DOUBLE)), 4) AS share_6plus, 'all' AS split FROM e LEFT JOIN c ON c.source1_entity_id = entity_id GROUP BY 1""",
    "q_cell_labels": f"""WITH {_NUMS_SQL}, {_EXCLUSIVE_SQL}, sel AS (SELECT f.* FROM flags1 f JOIN excl USING (source1_entity_id, cand_id) WHERE f.p >= 0.5),
        per AS (SELECT source1_entity_id, count(*) AS k, max(p) AS pmax, count(DISTINCT left(cand_id, 2)) AS ns, bool_or(num_match OR coalesce(len(n1), 0) = 0) AS ok FROM sel GROUP BY 1)
        SELECT entity_id AS source1_entity_id, country, CASE WHEN k IS NULL THEN 'k0' ELSE CASE WHEN k >= 3 THEN 'k3+' ELSE 'k' || k END || ' ' || CASE WHEN pmax >= 0.99 THEN 'p>=.99' WHEN pmax >= 0.95 THEN 'p.95-.99' ELSE 'p<.95' END || ' ' ||
          CASE WHEN ns >= 2 THEN '2src' ELSE '1src' END || ' ' || CASE WHEN ok THEN 'num_ok' ELSE 'num_diff' END END AS cell FROM (SELECT DISTINCT entity_id, country FROM s1) LEFT JOIN per ON source1_entity_id = entity_id""",
    "q_contested": f"""WITH {_SCORED_SQL}, h AS (SELECT *, count(*) OVER (PARTITION BY cand_id) AS c, p = max(p) OVER (PARTITION BY cand_id) AS w FROM scored WHERE p >= 0.3)
        SELECT source1_entity_id, country, bool_or(c >= 2) AS contested, count(*) FILTER (w AND c >= 2) AS won, count(*) FILTER (NOT w AND c >= 2) AS lost, count(*) FILTER (w) AS kept FROM h GROUP BY 1, 2""",
    "q_contested_pairs": f"""WITH {_SCORED_SQL}, h AS (SELECT *, count(*) OVER (PARTITION BY cand_id) AS c, CAST(p = max(p) OVER (PARTITION BY cand_id) AS INT) AS w FROM scored WHERE p >= 0.3)
        SELECT a.source1_entity_id, b.source1_entity_id AS other, a.country, count(*) AS shared, CAST(sum(a.w) AS BIGINT) AS a_wins, CAST(sum(b.w) AS BIGINT) AS b_wins FROM h a JOIN h b ON a.cand_id = b.cand_id AND a.source1_entity_id < b.source1_entity_id GROUP BY 1, 2, 3""",
    "q_lookalikes": f"""WITH {_POOL_SQL}, d AS (SELECT entity_id, country, name_core, TRY_CAST(addr_numbers[1] AS BIGINT) AS n FROM pl), ok AS (SELECT * FROM d WHERE length(name_core) >= 3 QUALIFY count(*) OVER (PARTITION BY country, name_core) BETWEEN 2 AND 50),
        f AS (SELECT a.entity_id, coalesce(bool_or(abs(a.n - b.n) BETWEEN 1 AND 30), false) AS near, coalesce(bool_or(a.n = b.n), false) AS dup FROM ok a JOIN ok b ON a.country = b.country AND a.name_core = b.name_core AND a.entity_id <> b.entity_id GROUP BY 1)
        SELECT d.entity_id AS source1_entity_id, d.country, f.entity_id IS NOT NULL AS same_name, coalesce(near, false) AS near, coalesce(dup, false) AS dup FROM d LEFT JOIN f USING (entity_id)""",
    "q_count_distribution": f"""WITH {_TRUTH_SQL}, {_SCORED_SQL}, {_LABELLED_SQL}, ex AS (SELECT * FROM lab QUALIFY row_number() OVER (PARTITION BY cand_id ORDER BY p DESC, source1_entity_id) = 1),
        e AS (SELECT s.country, t.n_matches, coalesce(c.n, 0) AS n FROM (SELECT DISTINCT entity_id, country FROM s1) s JOIN truth t ON t.source1_entity_id = s.entity_id LEFT JOIN (SELECT source1_entity_id, count(*) AS n FROM ex WHERE p >= 0.5 GROUP BY 1) c ON c.source1_entity_id = s.entity_id),
        a AS (SELECT country, least(n_matches, 6) AS k, count(*) AS n FROM e GROUP BY 1, 2), b AS (SELECT country, least(n, 6) AS k, count(*) AS n FROM e GROUP BY 1, 2),
        aa AS (SELECT country, k, round(n / sum(n) OVER (PARTITION BY country), 4) AS train_true FROM a), bb AS (SELECT country, k, round(n / sum(n) OVER (PARTITION BY country), 4) AS test_pred FROM b)
        SELECT country, CAST(k AS BIGINT) AS k, train_true, test_pred FROM aa FULL JOIN bb USING (country, k)""",
    "q_error_summary": f"""WITH {_TRUTH_SQL}, {_SCORED_SQL}, {_LABELLED_SQL}, {_PER}, miss AS (SELECT source1_entity_id, count(*) AS n FROM (SELECT source1_entity_id, unnest(matched) AS cand_id FROM truth) m ANTI JOIN lab USING (source1_entity_id, cand_id) GROUP BY 1),
        e AS (SELECT per.*, np - tp AS fp, n_matches - tp AS fn, 1 - f05 AS loss, coalesce(miss.n, 0) AS bm FROM per LEFT JOIN miss USING (source1_entity_id) WHERE source1_entity_id IN (SELECT entity_id FROM s1)),
        c AS (SELECT *, CASE WHEN n_matches = 0 AND fp > 0 THEN 'singleton_fp' WHEN n_matches > 0 AND np = 0 THEN 'missed_all' WHEN fp > 0 AND fn > 0 THEN 'mixed' WHEN fp > 0 THEN 'false_merge_only' WHEN fn > 0 THEN 'missed_some' ELSE 'perfect' END AS category FROM e)
        SELECT category, count(*) AS entities, round(sum(loss) / (SELECT count(*) FROM c), 5) AS points_lost, round(sum(loss) / greatest((SELECT sum(loss) FROM c), 1e-12), 3) AS share_of_loss, CAST(sum(fp) AS BIGINT) AS false_pairs, CAST(sum(fn) AS BIGINT) AS missed_pairs, CAST(sum(bm) AS BIGINT) AS missed_by_blocking FROM c GROUP BY 1""",
    "q_unclaimed": f"""WITH {_SCORED_SQL}, {_EXCLUSIVE_SQL}, fr AS (SELECT DISTINCT entity_id AS cand_id FROM {_POOL} EXCEPT SELECT cand_id FROM excl WHERE p >= 0.5)
        SELECT fr.cand_id, excl.p AS best_p, excl.source1_entity_id AS best_s1 FROM fr LEFT JOIN excl USING (cand_id)""",
    "q_diagonal_union": """SELECT country, count(*) AS n_rows, round(100 * avg(CAST(trim(coalesce(business_name, '')) = '' AS DOUBLE)), 2) AS name_empty, NULL AS addr_empty, 'S2' AS src FROM s2 GROUP BY 1
        UNION ALL SELECT country, count(*), NULL, round(100 * avg(CAST(trim(coalesce(business_address, '')) = '' AS DOUBLE)), 2), 'S3' FROM s3 GROUP BY 1""",
    "q_patch": f"WITH {_POOL_SQL} SELECT DISTINCT entity_id, CASE WHEN starts_with(name_core, 'm s ') THEN substr(name_core, 5) ELSE name_core END AS name_core FROM pl",
    "q_feature_shift": f"""WITH {_PAIRS_SQL}, l AS (SELECT source, 'bscore' AS feature, bscore AS v FROM prs UNION ALL SELECT source, 'nk', CAST(n_keytypes AS DOUBLE) FROM prs)
        SELECT feature, round(avg(v) FILTER (source = 'S2'), 6) AS valid_mean, round(avg(v) FILTER (source = 'S3'), 6) AS test_mean, round((avg(v) FILTER (source = 'S3') - avg(v) FILTER (source = 'S2')) / stddev_samp(v), 6) AS shift_sd FROM l GROUP BY 1""",
    "q_error_by_country": f"""WITH {_TRUTH_SQL}, {_SCORED_SQL}, {_LABELLED_SQL}, {_PER},
        e AS (SELECT per.*, s.country, np - tp AS fp, n_matches - tp AS fn, 1 - f05 AS loss FROM per JOIN (SELECT DISTINCT entity_id, country FROM s1) s ON s.entity_id = source1_entity_id),
        c AS (SELECT *, CASE WHEN n_matches = 0 AND fp > 0 THEN 'singleton_fp' WHEN n_matches > 0 AND np = 0 THEN 'missed_all' WHEN fp > 0 AND fn > 0 THEN 'mixed' WHEN fp > 0 THEN 'false_merge_only' WHEN fn > 0 THEN 'missed_some' ELSE 'perfect' END AS category FROM e)
        SELECT country, {", ".join(f"round(coalesce(sum(loss) FILTER (category = '{k}'), 0) / count(*), 5) AS {k}" for k in diagnostics.CATEGORIES)} FROM c GROUP BY 1""",
    "q_rate_by_flag": f"""WITH {_CLEAN_SQL}, {_TRUTH_SQL}, d AS (SELECT entity_id, country, name_core, TRY_CAST(addr_numbers[1] AS BIGINT) AS n FROM q), ok AS (SELECT * FROM d WHERE length(name_core) >= 3 QUALIFY count(*) OVER (PARTITION BY country, name_core) BETWEEN 2 AND 50),
        f AS (SELECT a.entity_id, coalesce(bool_or(abs(a.n - b.n) BETWEEN 1 AND 30), false) AS near, coalesce(bool_or(a.n = b.n), false) AS dup FROM ok a JOIN ok b ON a.country = b.country AND a.name_core = b.name_core AND a.entity_id <> b.entity_id GROUP BY 1),
        g AS (SELECT d.country, f.entity_id IS NOT NULL AS same_name, coalesce(near, false) AS near, coalesce(dup, false) AS dup, CAST(coalesce(n_matches, 0) = 0 AS DOUBLE) AS nm FROM d LEFT JOIN f USING (entity_id) LEFT JOIN truth ON source1_entity_id = d.entity_id)
        SELECT country, count(*) AS n_s1, round(avg(CAST(same_name AS DOUBLE)), 4) AS same_name, round(avg(CAST(near AS DOUBLE)), 4) AS near, round(avg(CAST(dup AS DOUBLE)), 4) AS dup, round(avg(nm), 4) AS nomatch_all,
          round(avg(nm) FILTER (same_name), 4) AS nomatch_same_name, round(avg(nm) FILTER (near), 4) AS nomatch_near, round(avg(nm) FILTER (dup), 4) AS nomatch_dup FROM g GROUP BY 1""",
    "q_post_variants": _variants_sql(),
}
