"""Combine sources so that each has its target share of all tokens.

Hierarchical budgeting: the total is handed down a tree of domain, language and source by weight; what a node can't hold goes to its
siblings before it goes to its ancestors' siblings. Each leaf then takes whole epochs of its documents and a token prefix
of one more, in an order seeded anew for each epoch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kinloom.llm.tokens import TOKENIZER, with_token_counts
from kinloom.session import bounded_broadcast, materialize

SEED = 20240117
#: Documents of a leaf that are ordered in one task at most, about.
BUCKET_ROWS = 4_000


def share_out(nodes: DataFrame, parent: list[str], node: str, total: Column, weight: str, capacity: str, out: str) -> DataFrame:
    """Add ``out``: the part of its parent's ``total`` that each node gets by weight, none above its capacity.

    What full nodes can't hold is spread over their open siblings by weight, again and again. Nodes fill up in the order of
    capacity per weight, so the level of the open ones follows from running sums, without rounds. Every parent is a window of its
    own, of as many rows as it has children. Nodes without weight or capacity get 0.
    """
    usable = (F.col(weight) > 0) & (F.col(capacity) > 0)
    nodes = nodes.withColumns({"__w": F.when(usable, F.col(weight)).otherwise(0.0), "__c": F.when(usable, F.col(capacity)).otherwise(0.0)})
    nodes = nodes.withColumns({"__r": F.when(usable, F.col("__c") / F.col("__w")), "__t": total.cast("double")})
    own = Window.partitionBy(*parent)
    order = own.orderBy(F.col("__r").asc_nulls_first(), node)
    nodes = nodes.withColumns({
        "__filled": F.coalesce(F.sum("__c").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)),
        "__open": F.sum("__w").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing)),
    })
    # tokens per weight if this node and all after it are open
    nodes = nodes.withColumn("__level", F.greatest(F.lit(0.0), F.col("__t") - F.col("__filled")) / F.col("__open"))
    nodes = nodes.withColumn("__full", F.col("__r") <= F.col("__level"))
    level = F.min(F.when(~F.col("__full"), F.struct("__r", node, "__level"))).over(own)["__level"]
    nodes = nodes.withColumn(out, F.when(F.col("__r").isNull(), 0.0).when(F.col("__full"), F.col("__c")).otherwise(F.col("__w") * level))
    return nodes.drop("__w", "__c", "__r", "__t", "__filled", "__open", "__level", "__full")


def budgets(leaves: DataFrame, total: Column) -> DataFrame:
    """Add ``budget`` to leaves ``domain, lang, source, weight, capacity``: ``total``, at most what all can hold, handed down the tree."""
    everything = Window.partitionBy(F.lit(1))
    domains = leaves.groupBy("domain").agg(F.sum("weight").alias("w"), F.sum("capacity").alias("c"))
    domains = share_out(domains.withColumn("root", F.lit(1)), ["root"], "domain", F.least(total, F.sum("c").over(everything)), "w", "c", "of_domain")
    langs = leaves.groupBy("domain", "lang").agg(F.sum("weight").alias("w"), F.sum("capacity").alias("c"))
    langs = share_out(langs.join(domains.select("domain", "of_domain"), "domain"), ["domain"], "lang", F.col("of_domain"), "w", "c", "of_lang")
    return share_out(leaves.join(langs.select("domain", "lang", "of_lang"), ["domain", "lang"]), ["domain", "lang"], "source", F.col("of_lang"), "weight", "capacity", "budget").drop("of_lang")


def mix(
    docs: DataFrame, id_col: str, text: str, source: str, lang: str, targets: DataFrame, domain: str | None = None,
    total_tokens: float | None = None, seed: int = SEED, tokenizer: str = TOKENIZER,
) -> tuple[DataFrame, DataFrame]:
    """(chosen documents with ``times``, report by source with target and reached shares).

    ``targets``: ``source, target_share, max_repeats`` (uses of a document in all). ``total_tokens``: size of the mixture; without it, all tokens
    of the named sources once. Chosen: ``id_col, source, lang, n_tokens, times``. Report: ``source, target_share, max_repeats, available_tokens,
    budget_tokens, reached_tokens, reached_share, most_times``.

    A leaf's weight is its source's target times the leaf's share of that source; its capacity is its tokens times the repeats.

    * Documents of a null source or one without target are not used; a source without documents is reported with 0. A null language is a
      language of its own. Null or empty texts hold no tokens and are not chosen. Rows repeated under one id are documents of their own.
    * A null share, negative share, null or non-positive repeats give the source nothing.
    * A leaf misses its budget by at most half of one document. The seeded order is that of a hash of id and text, so a rerun chooses the
      same documents however the rows are spread over files; of equal rows it does not matter which.
    * Empty tables give no documents and the targets with 0. Any number of leaves is planned; nothing is collected.
    """
    rows = with_token_counts(docs.select(F.col(id_col).alias("id"), F.col(text).cast("string").alias("t"), F.col(source).cast("string").alias("source"), F.col(lang).cast("string").alias("lang"), (F.col(domain).cast("string") if domain else F.lit("all")).alias("domain")), "t", "n", tokenizer)
    targets = targets.select(F.col("source").cast("string").alias("source"), F.col("target_share").cast("double"), F.col("max_repeats").cast("int")).where("source is not null").dropDuplicates(["source"])
    rows = rows.withColumn("text_hash", F.xxhash64("t")).drop("t").join(bounded_broadcast(targets.select("source"), 100_000), "source", "left_semi").where("n > 0")
    rows = materialize(rows.withColumn("lang", F.coalesce("lang", F.lit(""))).withColumn("domain", F.coalesce("domain", F.lit(""))), "mix-sizes")
    leaf = ["domain", "lang", "source"]
    leaves = rows.groupBy(*leaf).agg(F.sum("n").cast("double").alias("tokens"), F.count("*").alias("docs")).join(targets, "source")
    leaves = leaves.withColumns({
        "weight": F.greatest(F.lit(0.0), F.coalesce("target_share", F.lit(0.0))) * F.col("tokens") / F.sum("tokens").over(Window.partitionBy("source")),
        "capacity": F.col("tokens") * F.greatest(F.lit(0), F.coalesce("max_repeats", F.lit(0))),
    }).drop("target_share", "max_repeats")
    leaves = materialize(leaves, "mix-leaves")
    if total_tokens is None:
        total_tokens = float(leaves.agg(F.sum("tokens")).first()[0] or 0.0)
    epochs = F.floor(F.col("budget") / F.col("tokens") + 1e-9).cast("int")
    plan = budgets(leaves, F.lit(float(total_tokens))).withColumn("epochs", epochs)
    plan = materialize(plan.select(*leaf, "epochs", F.greatest(F.lit(0.0), F.col("budget") - F.col("epochs") * F.col("tokens")).alias("rest"), "budget", F.greatest(F.lit(1), F.ceil(F.col("docs") / BUCKET_ROWS)).alias("buckets")), "mix-plan")
    plan_df = bounded_broadcast(plan, 10_000)
    # the order of the last epoch: a seeded hash, cut into buckets of bounded size
    ordered = rows.join(plan_df, leaf).withColumn("h", F.pmod(F.xxhash64(F.lit(seed), "epochs", "source", "lang", "id", "text_hash"), F.lit(2**48)))
    ordered = ordered.withColumn("bucket", F.floor(F.col("h") / F.lit(float(2**48)) * F.col("buckets")))
    sums = ordered.groupBy(*leaf, "bucket").agg(F.sum("n").alias("in_bucket"), F.max("rest").alias("rest"))
    before = F.sum("in_bucket").over(Window.partitionBy(*leaf).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    starts = sums.withColumn("start", F.coalesce(before, F.lit(0))).select(*leaf, "bucket", "start", "in_bucket")
    placed = ordered.join(starts, [*leaf, "bucket"])
    inner = F.col("start") + F.coalesce(F.sum("n").over(Window.partitionBy(*leaf, "bucket").orderBy("h", "id", "text_hash").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    taken = placed.withColumn("in_prefix", (inner + F.col("n") / 2 <= F.col("rest") + 1e-6).cast("int"))
    chosen = taken.withColumn("times", F.col("epochs") + F.col("in_prefix")).where("times > 0")
    chosen = materialize(chosen.select(F.col("id").alias(id_col), "source", F.nullif("lang", F.lit("")).alias("lang"), F.col("n").alias("n_tokens"), "times", "domain"), "mixed")
    by_source = chosen.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("times")).alias("reached"), F.max("times").alias("most"))
    planned = plan.groupBy("source").agg(F.sum("budget").alias("budget"))
    available = rows.groupBy("source").agg(F.sum("n").alias("available"))
    report = targets.join(by_source, "source", "left").join(planned, "source", "left").join(available, "source", "left")
    # one row
    report = report.crossJoin(F.broadcast(by_source.agg(F.sum("reached").alias("all")))).select(
        "source", "target_share", "max_repeats",
        F.coalesce("available", F.lit(0)).alias("available_tokens"),
        F.round(F.coalesce("budget", F.lit(0.0)), 3).alias("budget_tokens"),
        F.coalesce("reached", F.lit(0)).alias("reached_tokens"),
        F.round(F.coalesce("reached", F.lit(0)) / F.greatest(F.coalesce("all", F.lit(0)), F.lit(1)), 6).alias("reached_share"),
        F.coalesce("most", F.lit(0)).alias("most_times"),
    )
    return chosen.drop("domain"), report
