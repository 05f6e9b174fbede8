"""From raw documents to tokens: the stages of the corpus pipeline.

Each stage is a function (spark, docs, sf_dir) -> DataFrame over all rows
its predecessor kept. All but the last return the columns of ``documents``.

1. toxicity: documents scored 0.7 or more go.
2. near_duplicates: of each group of texts linked by a similarity of 0.8 or
   more on five-word shingles one stays (the smallest doc_id).
3. pii: personal data is replaced by pseudonyms (n_chars follows the text).
4. source_mix: documents are left out or repeated, up to three times, so
   that sources come in their target shares.
5. bpe: texts become tokens; one row per document and repeat, with the
   number of tokens, their ids (decimal, joined by commas, which is what
   ids_sha256 is the digest of) and two digests.

Null and empty texts pass all stages (a text without words is no copy of
another); very long texts are handled whole; repeated rows are copies, of
which one stays; an empty table gives an empty result. Columns that a stage
does not know go through it unchanged, whatever they are called. Ties (equal
doc_ids in a group) are broken by the text's hash.

SQL cannot express the learned scores, the similarity join's components,
the keyed pseudonyms or the merges; tests/llm compares each stage with a
brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe, jaccard_join, pii, source_mix, toxicity
from tessera.llm._store import safely_named, small_batches, written
from tessera.llm.registry import PII_KEY, table, tokenizer_path

ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))

    @safely_named("doc_id", "text")
    def clean(rows: DataFrame) -> DataFrame:
        return toxicity.score(rows, model, name="_score").filter(F.col("_score") < toxicity.THRESHOLD).drop("_score")

    return clean(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.one_per_group(docs)


@safely_named("doc_id", "text", "n_chars")
def _hidden(docs: DataFrame) -> DataFrame:
    hidden = pii.pseudonymise(docs, PII_KEY, count="_found")
    if "n_chars" in docs.columns:
        hidden = hidden.withColumn("n_chars", F.when(F.col("_found") > 0, F.char_length("text")).otherwise(F.col("n_chars"))
                                   .cast(docs.schema["n_chars"].dataType))
    return hidden.select(*docs.columns)


def hide_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return _hidden(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return source_mix.repeat_to_mix(docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode(docs.select("doc_id", "text"), tokenizer_path(), ids=True, digests=True, joined=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("pii", hide_private),
    ("source_mix", mix_sources),
    ("bpe", tokenise),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; every result but the last is written as
    Parquet and read again as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
