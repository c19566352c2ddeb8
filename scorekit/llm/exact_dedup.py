"""Exact duplicates by deterministic block naming.

A text is cut into blocks of a fixed size. Equal blocks get one integer name: the distinct blocks are
sorted and numbered. Then adjacent names are paired and equal pairs get one name in the same way, over
and over, until each text has a single name. Texts of as many blocks are equal if and only if their
last names are: names stand for whole blocks and pairs, not for hashes of them.

The text itself crosses the network once, for the sorting of distinct blocks. Names find their way
back to the blocks by a 128-bit digest, which the table of distinct blocks proves to be free of
collisions for this corpus; if it is not, all is done again with another salt.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorekit.llm.common import SPACE, checkpoint, whole_row, whole_text

BLOCK_CHARS = 4096


def normalised(text: Column) -> Column:
    """Every run of white space as one space."""
    return F.regexp_replace(text, f"{SPACE}+", " ")


def exact_groups(
    docs: DataFrame, text: str = "text", key: str = "doc_id", block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """One row per row of `docs`: `doc_id, keep_id, group_size, kept, text_sha256`.

    Texts are equal when they are identical with every run of white space replaced by one space; null
    counts as the empty text. Of equal texts the row with the smallest key stays. Rows that repeat a
    key are rows of their own, of which one stays; a null key comes after all others. An empty table
    gives an empty result, and further columns are not looked at.

    Texts of any length and groups of any size are handled: blocks and pairs are counted before they
    are shuffled, and a name that very many rows share is joined back under AQE's skew handling.
    """
    texts = docs.select(F.col(key).alias("doc_id"), whole_text(text).alias("text"))
    rows, names = _name_blocks(texts, block_chars)
    named = checkpoint(rows.join(names, ["h1", "h2"]).drop("h1", "h2"))
    done = []
    blocks = named.agg(F.max("n")).first()[0] or 0
    left = 1
    while left < blocks:
        done.append(named.where(F.col("n") <= left))
        named = _name_pairs(named.where(F.col("n") > left))
        left *= 2
    for finished in done:
        named = named.unionByName(finished)
    identified = named.select("doc_id", "row", "sha", "n", "name")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    groups = checkpoint(
        identified.groupBy("n", "name").agg(
            F.min(order).alias("first"), F.count("*").alias("group_size")
        )
    )
    return identified.join(groups, ["n", "name"]).select(
        "doc_id",
        F.col("first.doc_id").alias("keep_id"),
        "group_size",
        (F.col("first.row") == F.col("row")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_exact_copies(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of `docs` that stay, with all their columns.

    Of rows that repeat both key and text any one stays, as they differ in further columns at most.
    """
    kept = exact_groups(docs, text, key).where("kept").select("doc_id", "text_sha256")
    digest = F.sha2(normalised(whole_text(text)), 256)
    rows = docs.select(
        whole_row(docs).alias("row"), F.col(key).alias("key"), digest.alias("digest")
    )
    match = F.col("key").eqNullSafe(F.col("doc_id")) & (F.col("digest") == F.col("text_sha256"))
    return rows.join(kept, match, "left_semi").dropDuplicates(["key", "digest"]).select("row.*")


def _name_blocks(docs: DataFrame, block_chars: int) -> tuple[DataFrame, DataFrame]:
    """The blocks of all rows, with digests for their texts, and the name of each digest.

    Row number, key and SHA-256 of a text travel with its first block.
    """
    rows = docs.withColumns(
        {"row": F.monotonically_increasing_id(), "text": normalised(F.col("text"))}
    )
    pieces = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{block_chars}}}"), F.lit(0))
    pieces = F.when(F.col("text") == "", F.array(F.lit(""))).otherwise(pieces)
    rows = rows.select(
        "row", "doc_id", F.sha2("text", 256).alias("sha"), pieces.alias("pieces")
    ).select("row", "doc_id", "sha", F.size("pieces").alias("n"), F.posexplode("pieces"))
    salt = 0
    while True:
        digest = {
            "h1": F.xxhash64(F.lit(2 * salt), "col"),
            "h2": F.xxhash64(F.lit(2 * salt + 1), "col"),
        }
        blocks = rows.withColumns(digest)
        distinct = blocks.select("h1", "h2", "col").distinct()
        names = checkpoint(_numbered(distinct, ["col"]).select("h1", "h2", "name"))
        if names.groupBy("h1", "h2").count().where("count > 1").isEmpty():
            break
        salt += 1
    first = F.col("pos") == 0
    located = blocks.select(
        "row",
        F.col("pos").cast("long").alias("pos"),
        F.col("n").cast("long").alias("n"),
        F.when(first, F.col("doc_id")).alias("doc_id"),
        F.when(first, F.col("sha")).alias("sha"),
        "h1",
        "h2",
    )
    return located, names


def _name_pairs(named: DataFrame) -> DataFrame:
    """Half as many names for each text: one for each pair of adjacent names.

    A last name without a neighbour is paired with none.
    """
    even = F.col("pos") % 2 == 0
    pairs = checkpoint(
        named.groupBy("row", F.floor(F.col("pos") / 2).alias("pos")).agg(
            F.max("n").alias("n"),
            F.max("doc_id").alias("doc_id"),
            F.max("sha").alias("sha"),
            F.max(F.when(even, F.col("name"))).alias("a"),
            F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(-1)).alias("b"),
        )
    )
    names = checkpoint(_numbered(pairs.select("a", "b").distinct(), ["a", "b"]))
    return checkpoint(pairs.join(names, ["a", "b"]).drop("a", "b"))


def _numbered(distinct: DataFrame, order: list[str]) -> DataFrame:
    """Integer names for distinct rows: each partition is sorted and its rows are numbered."""
    return distinct.sortWithinPartitions(*order).withColumn(
        "name", F.monotonically_increasing_id()
    )
