"""Put texts into containers of fixed capacity with little unused room.

Hierarchical residual packing: items are spread evenly over groups, each group packs its own by best fit, nearly full bins are
final, and underfull bins go on as items to the next round with fewer groups, until one group holds what is left, nothing that is
left fits anywhere, or a round has put no two of them together.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinloom.llm.tokens import TOKENIZER, with_token_counts
from kinloom.session import bounded_broadcast, materialize

#: Items that one task packs at a time.
GROUP_ITEMS = 20_000
#: A bin with at most this share of unused room is final at once.
SLACK = 0.005


def best_fit_decreasing(sizes: list[int], capacity: int) -> list[int]:
    """Number of the bin of each size: largest first, each into the fullest bin that still has room.

    Open bins are kept by their room; a bit mask of the rooms in use gives the smallest one that suffices.
    """
    bins = [0] * len(sizes)
    by_room: dict[int, list[int]] = {}
    mask = 0
    opened = 0
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        size = sizes[i]
        fitting = mask >> size
        if fitting:
            room = size + ((fitting & -fitting).bit_length() - 1)
            stack = by_room[room]
            b = stack.pop()
            if not stack:
                del by_room[room]
                mask &= ~(1 << room)
        else:
            room, b = capacity, opened
            opened += 1
        bins[i] = b
        left = room - size
        if left:
            by_room.setdefault(left, []).append(b)
            mask |= 1 << left
    return bins


def _packer(round_: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["size", "item"], ascending=[False, True], kind="stable")
        bins = best_fit_decreasing(group["size"].tolist(), int(group["capacity"].iloc[0]))
        prefix = f"{group['kind'].iloc[0]}-{round_}-{group['slot'].iloc[0]}-"
        group = group.assign(bin=[prefix + str(b) for b in bins])
        group["filled"] = group.groupby("bin")["size"].transform("sum")
        group["first"] = ~group["bin"].duplicated()
        return group[["kind", "capacity", "item", "bin", "filled", "first"]]

    return pack


_PACKED = "kind string, capacity long, item string, bin string, filled long, first boolean"


def pack(
    docs: DataFrame, id_col: str, text: str, kinds: DataFrame, kind_col: str, capacity_col: str, tokenizer: str = TOKENIZER, group_items: int = GROUP_ITEMS, slack: float = SLACK
) -> DataFrame:
    """Pack the whole texts of ``docs`` for every kind of container: one row for each text (or part of one) and kind.

    Result: ``pack_kind, capacity, bin_id, id_col, part, token_from, token_to``. The parts of a text are consecutive token ranges (end exclusive);
    only a text longer than the capacity has several, all but the last of them fill a container each.

    * Texts without tokens (null, empty) take no room and are in no container. Every other row of ``docs`` is packed once for each kind,
      rows repeated under one id too. Null ids are allowed.
    * Kinds with a null or non-positive capacity are not packed. Empty tables give an empty result.
    * Ties are resolved by size and a hash of id and text, so a rerun gives the same containers however the rows are spread over files.
    * A task never holds more than about ``group_items`` items; the number of rounds is logarithmic in the number of items.
    """
    sized = with_token_counts(docs.select(F.col(id_col).alias("id"), F.col(text).cast("string").alias("t")), "t", "n", tokenizer).where("n > 0")
    # equal rows are told apart by a number; all else about a row is its own
    sized = sized.select("id", "n", F.xxhash64("t").alias("h")).groupBy("id", "n", "h").agg(F.count("*").alias("copies"))
    sized = sized.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    sized = materialize(sized.select("id", "n", F.concat_ws("-", F.hex(F.xxhash64("id", "h")), F.coalesce(F.col("id").cast("string"), F.lit("")), "copy").alias("row")), "token-sizes")
    kinds = kinds.select(F.col(kind_col).cast("string").alias("kind"), F.col(capacity_col).cast("long").alias("capacity")).where("kind is not null and capacity > 0").dropDuplicates(["kind"])
    # the product with the kinds of containers, of which there are few, is what is asked for
    parts = (
        sized.crossJoin(bounded_broadcast(kinds, 10_000))
        .withColumn("part", F.explode(F.expr("sequence(0L, (n - 1) div capacity)")))
        .select("kind", "capacity", "id", "part", (F.col("part") * F.col("capacity")).alias("token_from"), F.least("n", (F.col("part") + 1) * F.col("capacity")).alias("token_to"), F.concat_ws("/", "row", "part").alias("item"))
    )
    parts = materialize(parts, "parts")
    items = parts.select("kind", "capacity", "item", (F.col("token_to") - F.col("token_from")).alias("size"))
    levels: list[DataFrame] = []
    round_ = 0
    counts = {r["kind"]: r["count"] for r in items.groupBy("kind").count().collect()}
    while counts:
        slots = {k: -(-n // group_items) for k, n in counts.items()}
        slots_of = F.create_map(*[F.lit(x) for kv in slots.items() for x in kv])
        packed = materialize(
            items.withColumn("slot", F.pmod(F.xxhash64("item"), slots_of[F.col("kind")])).groupBy("kind", "slot").applyInPandas(_packer(round_), _PACKED), f"packed-{round_}"
        )
        levels.append(packed.select("item", "kind", "bin"))
        # one row per bin; a kind goes on while it had several groups and a round put bins together
        bins = packed.where("first").select("kind", "capacity", F.col("bin").alias("item"), F.col("filled").alias("size"))
        room = F.col("capacity") - F.col("size")
        unfilled = bins.where(room > F.col("capacity") * slack)
        state = {r["kind"]: r for r in unfilled.groupBy("kind").agg(F.min("size").alias("least")).join(bins.groupBy("kind").agg(F.count("*").alias("made")), "kind").collect()}
        going = {k: r["least"] for k, r in state.items() if slots[k] > 1 and r["made"] < counts[k]}
        if not going:
            break
        # a bin with less room than the emptiest one fills can take none, nor go into another
        least = F.create_map(*[F.lit(x) for kv in going.items() for x in kv])
        items = materialize(unfilled.where(F.col("kind").isin(*going)).where(room >= least[F.col("kind")]), f"open-{round_}")
        counts = {r["kind"]: r["count"] for r in items.groupBy("kind").count().collect()}
        round_ += 1
    if not levels:
        return parts.select(F.col("kind").alias("pack_kind"), "capacity", F.lit("").alias("bin_id"), F.col("id").alias(id_col), "part", "token_from", "token_to").limit(0)
    out = parts.join(levels[0], ["kind", "item"])
    for level in levels[1:]:
        out = out.join(level.select("kind", F.col("item").alias("bin"), F.col("bin").alias("merged")), ["kind", "bin"], "left").withColumn("bin", F.coalesce("merged", "bin")).drop("merged")
    return out.select(F.col("kind").alias("pack_kind"), "capacity", F.col("bin").alias("bin_id"), F.col("id").alias(id_col), "part", "token_from", "token_to")


def fill_report(packed: DataFrame) -> DataFrame:
    """For each kind: containers, tokens, and the share of room used; and the least possible number of containers."""
    bins = packed.groupBy("pack_kind", "capacity", "bin_id").agg(F.sum(F.col("token_to") - F.col("token_from")).alias("filled"), F.count("*").alias("n"))
    return bins.groupBy("pack_kind", "capacity").agg(
        F.count("*").alias("n_bins"),
        F.sum("n").alias("n_parts"),
        F.sum("filled").alias("n_tokens"),
        F.max("filled").alias("fullest"),
        F.round(F.sum("filled") / (F.count("*") * F.col("capacity")), 6).alias("fill_share"),
        F.ceil(F.sum("filled") / F.col("capacity")).alias("least_bins"),
    )
