"""Documents as JSON lines or Parquet, compressed by the table's codec."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from citeflow.schema import DOC


# JSON objects, plain or compressed; anything else in the folder is not a document.
_JSON_FILES = "{*.json,*.json.gz,*.json.bz2,*.json.zst}"


def write_documents_json(docs: DataFrame, path: str, codec: str = "gzip") -> None:
    """One object per line, many per file; the file count follows the input partitions.

    Null fields are written out, so a reader sees every field of every document.
    """
    docs.write.mode("overwrite").options(compression=codec, ignoreNullFields="false").json(path)


def read_documents_json(spark: SparkSession, path: str, schema: str = DOC) -> DataFrame:
    """Documents from ``.json`` objects below a folder or object-store prefix."""
    reader = spark.read.schema(schema).option("recursiveFileLookup", "true")
    return reader.option("pathGlobFilter", _JSON_FILES).json(path)


def write_table(rows: DataFrame, path: str, codec: str = "zstd") -> None:
    rows.write.mode("overwrite").option("compression", codec).parquet(path)
