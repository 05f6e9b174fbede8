"""The driver's ``documents`` table as a batch of landing files: one file
per document, named by its id, with the text's UTF-8 bytes as content.
Exact copies of a text give equal content hashes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.ingest import archive_path, content_hash
from tessera.sources.tables import read_table


def document_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read_table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    name = F.concat(F.lit("doc_"), F.lpad(F.col("doc_id").cast("string"), 8, "0"), F.lit(".txt"))
    h = content_hash(F.col("text"))
    return d.select(name.alias("filename"), h.alias("file_hash"),
                    archive_path(h, name).alias("s3_path"), "lang")
