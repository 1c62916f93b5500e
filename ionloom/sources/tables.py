"""CSV and TSV tables, tables below a preamble, edge lists, manifests."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from ionloom.schema import RULES


def read_csv(spark: SparkSession, path: str, schema: str | None = None, separator: str = ",") -> DataFrame:
    """With a header; NA is null; without a schema every column is text."""
    reader = spark.read.option("header", True).option("nullValue", "NA").option("sep", separator).option("quote", '"').option("escape", '"')
    return (reader.schema(schema) if schema else reader).csv(path)


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, RULES)


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    from ionloom.schema import checked_metadata

    return checked_metadata(read_csv(spark, path))


def read_below_preamble(spark: SparkSession, path: str, key: str = "msclusterID", most: int = 1000) -> DataFrame:
    """The table whose header is the first line that holds `key`; what stands above it (some lines) is left out, by place.

    path is one file. Rows that equal a line of the preamble or the header are rows like others.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    head = lines.where("block = 0").orderBy("row").limit(most).collect()
    top = next((r for r in head if key in r["value"]), None)
    if top is None:
        raise ValueError(f"none of the first {most} lines holds {key}")
    names = spark.createDataFrame([(top["value"],)], "value string").select(F.from_csv("value", ", ".join(f"_{i} string" for i in range(top["value"].count(",") + 1))).alias("r")).first()["r"]
    columns = [c for c in names if c is not None]
    schema = ", ".join(f"`{c}` string" for c in columns)
    body = lines.where((F.col("block") > 0) | (F.col("row") > top["row"])).where("value <> ''")
    return body.select(F.from_csv("value", schema, {"nullValue": "NA"}).alias("r")).select("r.*")


def read_gnps(spark: SparkSession, clusters: str, results: str) -> DataFrame:
    """Library results with the scans of the clusters that they name: cluster index and scan differ."""
    index = read_csv(spark, clusters, separator="\t").select(F.col("#ClusterIdx").cast("long").alias("cluster_index"), F.col("#Scan").cast("long").alias("scan"))
    own = read_csv(spark, results, separator="\t")
    own = own.withColumnsRenamed({"#Scan#": "cluster_index", "SpectrumID": "spectrum_id", "MQScore": "mq_score"})
    return own.withColumns({"cluster_index": F.col("cluster_index").cast("long"), "mq_score": F.col("mq_score").cast("double"), "ion_source_instrument": F.concat_ws("_", "Ion_Source", "Instrument")}).join(index, "cluster_index", "left")


MEMBERS = "cluster_id long, sample string, scan long, mz double, rt double, precursor_intensity double, peak_id string, peak_area double, base_peak_int double"


def read_members(spark: SparkSession, path: str, schema: str = MEMBERS) -> DataFrame:
    """Cluster members, one row each, as CSV with a header."""
    return read_csv(spark, path, schema)


def write_members(members: DataFrame, path: str, schema: str = MEMBERS) -> None:
    """What read_members reads: the schema's columns, null where members has none."""
    wanted = [c.strip().split() for c in schema.split(",")]
    write_csv(members.select(*[(F.col(c) if c in members.columns else F.lit(None)).cast(t).alias(c) for c, t in wanted]), path)


def write_csv(table: DataFrame, path: str, order: str | None = None) -> None:
    """With a header, null as NA, arrays joined by ';', sorted where an order is given."""
    arrays = [f.name for f in table.schema.fields if f.dataType.typeName() == "array"]
    flat = table.withColumns({c: F.array_join(F.col(c).cast("array<string>"), ";") for c in arrays}) if arrays else table
    (flat.orderBy(order) if order else flat).write.option("header", True).option("nullValue", "NA").option("quote", '"').option("escape", '"').csv(path)


def write_edges(edges: DataFrame, path: str) -> None:
    """A network's edge list, the smaller id first."""
    named = edges.withColumnsRenamed({"id_a": "msclusterID_source", "id_b": "msclusterID_target", "matched": "num_matched_peaks"})
    write_csv(named, path)


def write_attributes(nodes: DataFrame, path: str) -> None:
    """A network's nodes and what is known of them, one row each."""
    write_csv(nodes.withColumnRenamed("id", "msclusterID"), path)


def write_manifest(spark: SparkSession, path: str, parameters: dict) -> None:
    """What a run was asked for, as one line of JSON."""
    spark.createDataFrame([(json.dumps(parameters, sort_keys=True, default=str),)], "value string").write.mode("overwrite").text(path)
