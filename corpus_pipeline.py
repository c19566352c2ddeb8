"""A corpus pipeline of the operators in `scorekit.llm`, each stage written before the next reads it.

Every stage takes `(spark, docs, sf_dir)` and works on all rows that its predecessor kept. All but the
last return the columns of `docs`. A stage whose input has no rows returns none.
"""

from pyspark.sql import DataFrame, SparkSession

from scorekit.llm.bpe import encode_documents
from scorekit.llm.common import table
from scorekit.llm.exact_dedup import drop_exact_copies
from scorekit.llm.mixing import mix
from scorekit.llm.near_dedup import drop_near_copies
from scorekit.llm.toxicity import drop_toxic
from scorekit.sources.scratch import scratch_path


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score stays below the threshold of their language.

    Texts are scored whole, however long; a null or empty one has the score of a text without words. Rows
    that repeat are judged alike and stay as often as they were. A score at the threshold is rejected.
    """
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest id.

    Null and empty texts are equal, and so are texts that differ in white space alone, of any length. Of
    rows that repeat the id as well one stays; a null id is the smallest only where there is no other.
    """
    return drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked at 80 percent the one with the smallest id.

    A pair at exactly 80 percent is linked. Null, empty and blank texts are linked with nothing and all
    stay, texts are compared whole, and of rows that repeat id and text one stays.
    """
    return drop_near_copies(docs, percent=80)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it.

    Sizes are words of whole texts. A document without words has nothing to give and is left out; null
    sources are one source; rows that repeat are drawn each, and ties are settled by id and text.
    """
    return mix(docs)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """`doc_id, n_tokens, ids` of each document that the mix took, once for each time it did.

    Texts are encoded whole; a null or empty one has no tokens.
    """
    return encode_documents(docs).drop("decoded")


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("bpe", bpe),
]

# The classifier, the draws of the mix and the vocabulary are beyond SQL; tests hold the stages against
# brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each one's rows written as Parquet in the shared folder and read
    again as the next one's documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
