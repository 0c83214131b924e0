"""Checks of results: match lists against their candidates and sources, and result files against the format rules."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

G = "source1_entity_id"
EXAMPLES = 5


def output_checks(match: DataFrame, cands: DataFrame, clean_ids: DataFrame, pool_ids: DataFrame) -> DataFrame:
    """``check, violations`` for match and candidate lists (G, ids): rows, unknown ids, repeated ids, matches outside the candidates."""
    def count(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count("*").alias("violations")).select(F.lit(name).alias("check"), "violations")

    out = None
    for name, lists in (("matches", match), ("candidates", cands)):
        ids = lists.select(G, F.explode("ids").alias("id"))
        for part in (
            count(lists.groupBy(G).count().where("count > 1"), f"{name}: repeated rows"),
            count(clean_ids.select(G).distinct().join(lists, G, "left_anti"), f"{name}: missing rows"),
            count(lists.join(clean_ids, G, "left_anti"), f"{name}: unknown clean ids"),
            count(ids.join(pool_ids.select(F.col("entity_id").alias("id")), "id", "left_anti"), f"{name}: ids not in the pool"),
            count(lists.where("size(ids) <> size(array_distinct(ids))"), f"{name}: ids repeated in a list"),
        ):
            out = part if out is None else out.unionByName(part)
    outside = match.join(cands.select(G, F.col("ids").alias("cand_ids")), G).where("size(array_except(ids, cand_ids)) > 0")
    return out.unionByName(count(outside, "matches outside the candidates"))


@dataclass
class Findings:
    errors: list[str] = field(default_factory=list)
    warnings: list[str] = field(default_factory=list)
    rows: int = 0

    @property
    def exit_code(self) -> int:
        return 1 if self.errors else 0


def _examples(df: DataFrame, column: str) -> str:
    n = df.count()
    shown = ", ".join(str(r[0]) for r in df.select(column).orderBy(column).limit(EXAMPLES).collect())
    return f"{n} in all, e.g. {shown}" if n > EXAMPLES else shown


def validate_id_lists(spark: SparkSession, path: str, list_column: str, required: DataFrame, known: DataFrame | None = None) -> tuple[Findings, DataFrame | None]:
    """Format rules of a result file: header, tab, one row per clean record, ids once, prefixes, optionally known ids. Also gives (G, ids)."""
    found = Findings()
    lines = spark.read.text(path)
    first = lines.limit(1).collect()
    if not first:
        found.errors.append("the file is empty")
        return found, None
    header = first[0][0]
    expected = [G, list_column]
    if "\t" not in header and "," in header:
        found.errors.append("the file is separated by commas, not tabs")
        return found, None
    if [c.strip().lower() for c in header.split("\t")] != expected:
        found.errors.append(f"the header is not {expected}")
        return found, None
    body = lines.where((F.col("value") != header) & (F.trim("value") != ""))
    broken = body.where(~F.col("value").contains("\t"))
    if broken.limit(1).count():
        found.errors.append(f"rows without a tab: {_examples(broken, 'value')}")
    rows = body.where(F.col("value").contains("\t")).select(F.split("value", "\t", 2).alias("f"))
    rest = F.trim(F.col("f")[1])
    lists = rows.select(F.col("f")[0].alias(G), F.when(rest == "", F.array().cast("array<string>")).otherwise(F.split(rest, ",")).alias("ids"))
    found.rows = lists.count()
    ids = lists.select(G, F.explode("ids").alias("id")).distinct()
    pool_id = F.col("id").startswith("S2-") | F.col("id").startswith("S3-")
    checks = [
        (lists.groupBy(G).count().where("count > 1"), G, "repeated rows"),
        (lists.where("size(ids) <> size(array_distinct(ids))"), G, "ids repeated in a list"),
        (ids.where(F.col("id").startswith("S1-")).select("id").distinct(), "id", "clean ids among the matches"),
        (ids.where(~pool_id & ~F.col("id").startswith("S1-")).select("id").distinct(), "id", "ids without a known prefix"),
        (required.select(G).distinct().join(lists, G, "left_anti"), G, "clean records without a row"),
        (lists.join(required, G, "left_anti").select(G).distinct(), G, "rows of unknown clean records"),
    ]
    if known is not None:
        checks.append((ids.where(pool_id).join(known.select(F.col("entity_id").alias("id")), "id", "left_anti").select("id").distinct(), "id", "unknown ids"))
    for df, column, what in checks:
        if df.limit(1).count():
            found.errors.append(f"{what}: {_examples(df, column)}")
    return found, lists


def validate_submission(spark: SparkSession, matches: str, candidates: str | None, clean: DataFrame, pool: DataFrame | None = None) -> Findings:
    """Both result files; matches outside the candidates give a warning."""
    required = clean.select(F.col("entity_id").alias(G))
    found, lists = validate_id_lists(spark, matches, "matched_entity_ids", required, pool)
    if candidates is not None:
        more, cand_lists = validate_id_lists(spark, candidates, "candidate_entity_ids", required, pool)
        found.errors += more.errors
        if lists is not None and cand_lists is not None:
            outside = lists.join(cand_lists.select(G, F.col("ids").alias("c")), G).where("size(array_except(ids, c)) > 0")
            if outside.limit(1).count():
                found.warnings.append(f"matches outside the candidates: {_examples(outside, G)}")
    return found
