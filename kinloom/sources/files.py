"""Files of the linkage pipeline: tab-separated sources, ground truth, id lists, reports and cached stages."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinloom.session import hadoop_path

SOURCE_COLUMNS = ("entity_id", "business_name", "business_address", "country")
TRUTH_COLUMNS = ("source1_entity_id", "matched_entity_ids")


def _header(spark: SparkSession, path: str) -> list[str]:
    first = spark.read.text(path).limit(1).collect()
    return [c.strip().removeprefix("﻿") for c in first[0][0].split("\t")] if first else []


def read_tsv(spark: SparkSession, path: str, n_rows: int | None = None) -> DataFrame:
    """Tab-separated text with a header: no quoting, all strings, empty as null; long rows are cut, short ones filled with nulls."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in _header(spark, path)])
    df = spark.read.option("sep", "\t").option("quote", "").option("header", True).option("enforceSchema", True).schema(schema).csv(path)
    return df if n_rows is None else df.limit(n_rows)


def read_source(spark: SparkSession, path: str, n_rows: int | None = None) -> DataFrame:
    """The four columns of a source file; an error names those it lacks."""
    df = read_tsv(spark, path, n_rows)
    if missing := [c for c in SOURCE_COLUMNS if c not in df.columns]:
        raise ValueError(f"{path} lacks the columns {', '.join(missing)}")
    return df.select(*SOURCE_COLUMNS)


def parse_ground_truth(df: DataFrame) -> DataFrame:
    """``source1_entity_id, matched, n_matches`` from comma lists; stray blanks and empty entries are dropped."""
    ids = F.filter(F.transform(F.split(F.coalesce("matched_entity_ids", F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != "")
    return df.select("source1_entity_id", ids.alias("matched")).withColumn("n_matches", F.size("matched"))


def read_ground_truth(spark: SparkSession, path: str) -> DataFrame:
    df = read_tsv(spark, path)
    if missing := [c for c in TRUTH_COLUMNS if c not in df.columns]:
        raise ValueError(f"{path} lacks the columns {', '.join(missing)}")
    return parse_ground_truth(df)


def explode_ground_truth(truth: DataFrame) -> DataFrame:
    return truth.select("source1_entity_id", F.explode("matched").alias("matched_id"))


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """``source1_entity_id, n_pred`` of an id-list file."""
    df = read_tsv(spark, path)
    return df.select("source1_entity_id", F.size(F.filter(F.split(F.coalesce(F.col(df.columns[1]), F.lit("")), ","), lambda x: x != "")).alias("n_pred"))


def write_id_lists(lists: DataFrame, path: str, column: str, id_col: str = "source1_entity_id", ids: str = "ids") -> None:
    """A folder of tab-separated text: a header, then one line per row; ids once each in order, an empty list as an empty field.

    Text and not CSV, as the latter quotes empty fields. The header is the first line of the first part.
    """
    body = lists.select(F.concat(F.col(id_col), F.lit("\t"), F.array_join(F.array_distinct(ids), ",")).alias("value"), F.lit(1).alias("o"))
    header = lists.sparkSession.createDataFrame([(f"{id_col}\t{column}", 0)], "value string, o int")
    # sorted by range, so the header comes first without gathering the rows in one task
    header.unionByName(body).repartitionByRange("o", "value").sortWithinPartitions("o", "value").select("value").write.mode("overwrite").text(path)


def write_examples(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("sep", "\t").option("header", True).csv(path)


def write_text(spark: SparkSession, text: str, path: str) -> None:
    """A small file on whatever file system the path names, the same one that the tables go to."""
    fs, p = hadoop_path(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def write_json(spark: SparkSession, value: dict, path: str) -> None:
    write_text(spark, json.dumps(value, ensure_ascii=False, indent=1, sort_keys=True), path)


def read_json(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop_path(spark, path)
    return fs.exists(p)


def markdown_report(title: str, sections: dict[str, dict]) -> str:
    lines = [f"# {title}"]
    for name, values in sections.items():
        lines += ["", f"## {name}", "", "| item | value |", "|---|---|", *(f"| {k} | {v} |" for k, v in values.items())]
    return "\n".join(lines) + "\n"


def cached_stage(spark: SparkSession, path: str, make: Callable[[], DataFrame], force: bool = False) -> DataFrame:
    """The Parquet table at ``path``, made first if it is missing or ``force`` is set. Reading it back cuts the lineage."""
    if force or not exists(spark, f"{path}/_SUCCESS"):
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
