"""Near duplicates by a multi-index Hamming join of MinHash signatures.

A signature has 64 components of 16 bits; two documents with similar sets of shingles differ in few
components. How many is set by the similarity that links: at 0.85, pairs differ in more than 23 of them
about once in 114,000. Signatures are then cut into 12 chunks. If two of them differ in at most 23
components, the pigeonhole principle leaves one chunk with at most one difference. So every chunk is
looked up with each of its components left out in turn: all ways in which one component of it may be
wrong. At 0.80 it is 28 differences and 15 chunks.

Documents that share a key form families. A family is laid out in tiles, every block of its documents
against every other, and a tile tests all its pairs: on signatures, then on the whole sets. It returns
only as many links as it takes to hold together what belongs together, so that a group of copies costs
links in proportion to its size. Documents with equal sets count as one until the end.
"""

from collections.abc import Iterator
from functools import cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorekit.llm.batches import pieces
from scorekit.llm.common import checkpoint, whole_row
from scorekit.llm.components import components
from scorekit.llm.shingles import (
    COMPONENTS,
    linked,
    mix,
    set_digest,
    shingles,
    signature,
    word_memo,
)

SIMILAR_PERCENT = 85

# The chance, at most, that a pair just similar enough is missed, and components to a chunk at least:
# with one left out, 48 bits are looked up.
MISSED = 1e-5
LEAST_CHUNK = 4


@cache
def distance_at(percent: int) -> int:
    """The least number of differences that a pair at `percent` exceeds with chance `MISSED` at most."""
    differ, distance, beyond = 1 - percent / 100, COMPONENTS, 0.0
    while distance > 0:
        beyond += comb(COMPONENTS, distance) * differ**distance * (1 - differ) ** (COMPONENTS - distance)
        if beyond > MISSED:
            break
        distance -= 1
    return distance


@cache
def chunks_for(distance: int) -> tuple[int, ...]:
    """Sizes of chunks with one error allowed: twice as many as there are exceed the distance, so that
    not all of them can hold two differences."""
    count = distance // 2 + 1
    return tuple(COMPONENTS // count + (i < COMPONENTS % count) for i in range(count))


DISTANCE = distance_at(SIMILAR_PERCENT)
CHUNKS = chunks_for(DISTANCE)

# Documents in a block of a family on average.
BLOCK = 256


def near_groups(
    docs: DataFrame, percent: int = SIMILAR_PERCENT, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """One row per row of `docs`: `doc_id, n_shingles, component_id, kept, cluster, text_key`.

    A text's set holds its distinct shingles of five words, A-Z lower-cased and words split at ASCII
    white space; with fewer words it is the whole sequence as one shingle. Rows are linked if
    `100 * common >= percent * union`, which is tested on the whole sets, and `component_id` is the
    smallest key that links lead to, the row's own included. A null, empty or blank text has no
    shingles and is linked with nothing. Rows that repeat a key are rows of their own; a null key is
    the smallest only where there is no other. `kept` says that key and `component_id` are the same.
    An empty table gives an empty result, and further columns are not looked at.

    A similar pair is missed with chance `MISSED` at most, whatever `percent` is. A `percent` for which
    signatures are too short, below 76, or one above 100 is refused.

    `cluster` names the group, null for texts without words, and `text_key` hashes the text.
    """
    if not 0 < percent <= 100 or min(chunks_for(distance_at(percent))) < LEAST_CHUNK:
        raise ValueError(f"signatures of {COMPONENTS} components cannot find pairs at {percent} %")
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    signed = checkpoint(
        rows.withColumn("text_key", F.xxhash64("text")).mapInArrow(
            _sign,
            f"doc_id {kind}, text_key bigint, n_shingles bigint, set_id binary, signature binary",
        )
    )
    classes = signed.where("set_id IS NOT NULL").groupBy("set_id").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("first"),
        F.first("signature").alias("signature"),
    )
    classes = classes.select("set_id", F.col("first.doc_id").alias("first_id"), "first.text_key", "signature")
    classes = checkpoint(classes.withColumn("id", F.monotonically_increasing_id()))
    links = _links(docs, classes, percent, text, key)
    groups = components(links)
    named = classes.join(groups, F.col("id") == F.col("node"), "left").select(
        "set_id", "first_id", F.coalesce("component", "id").alias("cluster")
    )
    named = checkpoint(named)
    smallest = named.groupBy("cluster").agg(F.min("first_id").alias("component_id"))
    named = checkpoint(named.join(smallest, "cluster").drop("first_id"))
    grouped = signed.drop("signature").join(named, "set_id", "left")
    alone = F.col("set_id").isNull()
    component = F.when(alone, F.col("doc_id")).otherwise(F.col("component_id"))
    return grouped.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        component.eqNullSafe(F.col("doc_id")).alias("kept"),
        "cluster",
        "text_key",
    )


def drop_near_copies(
    docs: DataFrame, text: str = "text", key: str = "doc_id", **options
) -> DataFrame:
    """One row of `docs` for each group, that with the smallest key, and all rows without words.

    Of rows that repeat both key and text one stays.
    """
    groups = near_groups(docs, text=text, key=key, **options)
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    stay = (
        groups.where("cluster IS NOT NULL")
        .groupBy("cluster")
        .agg(F.min(first).alias("first"))
        .select("first.doc_id", "first.text_key")
    )
    rows = docs.select(
        whole_row(docs).alias("row"),
        F.col(key).alias("key"),
        F.xxhash64(text).alias("hash"),
        F.coalesce(F.col(text), F.lit("")).rlike(r"[^\x20\x09-\x0D]").alias("worded"),
    )
    match = F.col("key").eqNullSafe(F.col("doc_id")) & (F.col("hash") == F.col("text_key"))
    kept = rows.where("worded").join(stay, match, "left_semi").dropDuplicates(["key", "hash"])
    return kept.unionByName(rows.where("NOT worded")).select("row.*")


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    memo = word_memo()
    for piece in pieces(batches):
        sizes, digests, signatures = [], [], []
        for text in piece.column("text").cast(pa.binary()).to_pylist():
            hashes = shingles(text or b"", memo)
            sizes.append(len(hashes))
            digests.append(set_digest(hashes) if len(hashes) else None)
            signatures.append(signature(hashes).tobytes() if len(hashes) else None)
        yield pa.RecordBatch.from_arrays(
            [
                piece.column("doc_id"),
                piece.column("text_key"),
                pa.array(sizes, pa.int64()),
                pa.array(digests, pa.binary()),
                pa.array(signatures, pa.binary()),
            ],
            ["doc_id", "text_key", "n_shingles", "set_id", "signature"],
        )


def _links(docs: DataFrame, classes: DataFrame, percent: int, text: str, key: str) -> DataFrame:
    """Links `a, b` that connect the ids of similar classes."""
    chunks = chunks_for(distance_at(percent))
    keys = classes.select("id", "signature").mapInArrow(
        lambda batches: _keys(batches, chunks), "key bigint, id bigint"
    )
    shared = keys.groupBy("key").agg(F.min("id").alias("hub"), F.count("*").alias("n"))
    shared = checkpoint(shared.where("n > 1").select("key", "hub"))
    edges = keys.join(shared, "key").where("id <> hub")
    families = components(edges.select(F.col("id").alias("a"), F.col("hub").alias("b")))
    sizes = families.groupBy("component").count()
    placed = families.join(sizes, "component").select(
        F.col("node").alias("id"),
        F.col("component").alias("family"),
        F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks"),
    )
    members = checkpoint(placed.join(classes.select("id", "set_id", "first_id", "text_key"), "id"))
    sets = _sets(docs, members, text, key)
    # A document goes into the tile of its block with every block, its own included.
    block = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    tiled = sets.withColumn("block", block).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    )
    tiles = tiled.select(
        "family",
        F.least("block", "other").alias("i"),
        F.greatest("block", "other").alias("j"),
        "block",
        "id",
        "hashes",
    )
    tile = ["family", "i", "j"]
    return (
        tiles.repartition(*tile)
        .sortWithinPartitions(*tile)
        .mapInArrow(lambda batches: _tiles(batches, percent), "a bigint, b bigint")
    )


def _keys(batches: Iterator[pa.RecordBatch], chunks: tuple[int, ...]) -> Iterator[pa.RecordBatch]:
    """Each chunk of each signature with each of its components left out, as one number."""
    for batch in batches:
        for start in range(0, batch.num_rows, 4096):
            part = batch.slice(start, 4096)
            data = b"".join(part.column("signature").to_pylist())
            signatures = np.frombuffer(data, "<u2").reshape(-1, COMPONENTS).astype(np.uint64)
            keys, first = [], 0
            for size in chunks:
                for dropped in range(size):
                    key = np.full(len(signatures), first * 64 + dropped, np.uint64)
                    for c in range(size):
                        if c != dropped:
                            key = mix(key * np.uint64(65537) + signatures[:, first + c])
                    keys.append(key)
                first += size
            ids = np.tile(part.column("id").to_numpy(), len(keys))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(keys).view(np.int64)), pa.array(ids)], ["key", "id"]
            )


def _sets(docs: DataFrame, members: DataFrame, text: str, key: str) -> DataFrame:
    """The whole sets of the classes in `members`, made again from one document of each.

    A document is known by key and text together, as many may have a null key or the same one."""
    rows = docs.select(F.col(key).alias("_key"), F.xxhash64(text).alias("_hash"), F.col(text).alias("text"))
    same = F.col("_key").eqNullSafe(F.col("first_id")) & (F.col("_hash") == F.col("text_key"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = word_memo()
        for piece in pieces(batches):
            found, right = [], []
            texts, digests = piece.column("text").cast(pa.binary()).to_pylist(), piece.column("set_id")
            for text, digest in zip(texts, digests.to_pylist()):
                hashes = shingles(text or b"", memo)
                right.append(len(hashes) > 0 and set_digest(hashes) == digest)
                found.append(hashes.tobytes())
            out = pa.RecordBatch.from_arrays(
                [*[piece.column(c) for c in ("id", "family", "blocks")], pa.array(found, pa.binary())],
                ["id", "family", "blocks", "hashes"],
            )
            yield out.filter(pa.array(right))

    joined = rows.join(members, same).select("id", "family", "blocks", "set_id", "text")
    return joined.mapInArrow(run, "id bigint, family bigint, blocks int, hashes binary")


def _tiles(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """The links of each tile; tiles come one after the other and one is held at a time."""
    current, ids, blocks, sets = None, [], [], []
    for batch in batches:
        links = []
        columns = (batch.column(c).to_pylist() for c in ("family", "i", "j", "block", "id", "hashes"))
        for family, i, j, block, id_, hashes in zip(*columns):
            if (family, i, j) != current:
                links += _tile_links(current, ids, blocks, sets, percent)
                current, ids, blocks, sets = (family, i, j), [], [], []
            ids.append(id_)
            blocks.append(block)
            sets.append(np.frombuffer(hashes, np.uint64))
        if links:
            yield _link_batch(links)
    links = _tile_links(current, ids, blocks, sets, percent)
    if links:
        yield _link_batch(links)


def _tile_links(tile, ids, blocks, sets, percent) -> list[tuple[int, int]]:
    """Links that hold together the documents of a tile: a pair that others connect is not tested.

    A tile of two different blocks compares those with each other; each has a tile with itself.
    """
    if len(ids) < 2:
        return []
    _, first = np.unique(ids, return_index=True)  # a class found through several rows counts once
    ids, blocks, sets = ([x[i] for i in first] for x in (ids, blocks, sets))
    signatures = np.stack([signature(s) for s in sets])
    sizes = np.array([len(s) for s in sets])
    own = np.array(blocks)
    distance = distance_at(percent)
    root = list(range(len(ids)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    lefts, rights, gaps = [], [], []
    for a in range(len(ids) - 1):
        gap = (signatures[a + 1 :] != signatures[a]).sum(axis=1)
        near = gap <= distance
        near &= 100 * np.minimum(sizes[a + 1 :], sizes[a]) >= percent * np.maximum(sizes[a + 1 :], sizes[a])
        if tile[1] != tile[2]:
            near &= own[a + 1 :] != own[a]
        b = np.flatnonzero(near)
        lefts.append(np.full(len(b), a))
        rights.append(b + a + 1)
        gaps.append(gap[b])
    lefts, rights, gaps = (np.concatenate(x) for x in (lefts, rights, gaps))
    order = np.argsort(gaps, kind="stable")
    links = []
    for a, b in zip(lefts[order].tolist(), rights[order].tolist()):
        if find(a) == find(b):
            continue
        common = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
        if linked(common, len(sets[a]), len(sets[b]), percent):
            root[find(a)] = find(b)
            links.append((ids[a], ids[b]))
    return links


def _link_batch(links: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*links)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
