"""Hard negatives by bounds along a spanning tree of the anchors.

Anchors and candidates are dealt into blocks, and a tile holds one block of either. In a tile the anchors
are joined by a minimum spanning tree over their distances. The root is scored with all candidates; for
every other anchor the scores of its parent, plus and minus the length of the edge times the length of
a candidate, bound its own. Only candidates whose bounds overlap a window that the anchor looks into are
scored again, the others hand their bounds on to the next anchor. Lengths are rounded up to integers,
so the bounds hold exactly.

Positives come first: their window reaches down to the worst of the positives found so far, in tiles of
one label. Then every positive has a window for its negatives, whose lower end rises with those found.
"""

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorekit.llm.common import checkpoint
from scorekit.llm.integers import alike, finite, floors, longs, roots_above

SCALE = 256.0

# Anchors and candidates in a block on average, and candidates that go along a tree together.
ANCHOR_BLOCK = 1024
CANDIDATE_BLOCK = 16384
STRIP = 2048


def mine_hard_negatives(
    vectors: DataFrame,
    anchors: Column,
    positives: int = 5,
    negatives: int = 3,
    window: tuple[int, int] = (50, 95),
    scale: float = SCALE,
    vector: str = "embedding",
    key: str = "vec_id",
    label: str | Column = "label",
    anchor_block: int = ANCHOR_BLOCK,
    candidate_block: int = CANDIDATE_BLOCK,
) -> DataFrame:
    """`anchor_id, positive_id, rank, negative_id, positive_score, negative_score` for the rows that
    `anchors` selects.

    The score of two rows is the inner product of their vectors, whose components x count as
    `floor(scale * x)`; higher scores come first, ties by smaller key. The first `positives` other rows
    with the anchor's label are its positives, and for each the first `negatives` rows of other labels
    whose score is from `window[0]` to `window[1]` percent of the positive's, both included, are
    returned; a positive with none has no row here. With fewer rows all of them are taken.

    Rows without key or label, and vectors that are null or hold a null or a component that is not
    finite, take no part; a vector is compared with those of its own length. A key stands for one row:
    of rows that repeat it the smallest label and then the smallest vector counts. An empty table gives an
    empty result and further columns are not looked at. Scores beyond a long are given, and ordered,
    as the long nearest to them.

    Every anchor has to meet every candidate, in tiles that no vector, label or group of copies can make
    larger, as blocks are drawn by hashed key. A tile returns only what its anchors may need.
    """
    named = F.col(label) if isinstance(label, str) else label
    kinds = vectors.select(F.col(key).alias("vec_id"), named.alias("label"))
    key_kind, label_kind = (kind for _, kind in kinds.dtypes)
    rows = vectors.where(finite(F.col(vector), scale) & F.col(key).isNotNull() & named.isNotNull()).select(
        F.col(key).alias("vec_id"),
        named.alias("label"),
        F.col(vector).alias("vector"),
        F.coalesce(anchors, F.lit(False)).alias("asked"),
    )
    first = F.min(F.struct("label", "vector", "asked")).alias("first")
    rows = checkpoint(rows.groupBy("vec_id").agg(first).select("vec_id", "first.*"))
    rows = rows.withColumn("length", F.size("vector"))
    asked = rows.where("asked").drop("asked")
    rows = rows.drop("asked")

    kept = f"anchor_id {key_kind}, vec_id {key_kind}, score bigint"
    near = _tiles(
        asked, rows, ["length", "label"], anchor_block, candidate_block,
        lambda a, c: _positives(a, c, positives, scale), kept,
    )
    order = [F.col("score").desc(), F.col("vec_id")]
    place = F.row_number().over(Window.partitionBy("anchor_id").orderBy(*order))
    chosen = checkpoint(near.withColumn("place", place).where(F.col("place") <= positives))

    # An anchor takes its few positives, in the order of their places, along.
    theirs = F.array_sort(F.collect_list(F.struct("place", F.col("vec_id").alias("id"), "score")))
    looking = chosen.groupBy("anchor_id").agg(theirs.alias("positives"))
    looking = asked.join(looking.withColumnRenamed("anchor_id", "vec_id"), "vec_id").select(
        "vec_id", "label", "vector", "length", F.col("positives.score").alias("scores")
    )
    far = _tiles(
        looking, rows, ["length"], anchor_block, candidate_block,
        lambda a, c: _negatives(a, c, negatives, window, scale),
        f"anchor_id {key_kind}, place int, vec_id {key_kind}, score bigint",
    )
    rank = F.row_number().over(Window.partitionBy("anchor_id", "place").orderBy(*order))
    found = far.withColumn("rank", rank).where(F.col("rank") <= negatives)
    of_place = chosen.select(
        "anchor_id", "place", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    return found.join(of_place, ["anchor_id", "place"]).select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )


def _tiles(asked, rows, alike_in: Sequence[str], anchor_block, candidate_block, work, schema) -> DataFrame:
    """What `work` makes of each block of anchors with each block of candidates that agree in some
    columns. Each value of these has blocks of its own, as many as its rows need."""
    left, right = asked.groupBy(*alike_in).count(), rows.groupBy(*alike_in).count()
    sizes = left.withColumnRenamed("count", "asking").join(right, list(alike_in)).select(
        *alike_in,
        F.ceil(F.col("asking") / anchor_block).cast("int").alias("anchor_blocks"),
        F.ceil(F.col("count") / candidate_block).cast("int").alias("candidate_blocks"),
    )
    draw = F.xxhash64("vec_id")

    def every(blocks: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))

    own = asked.join(sizes, list(alike_in)).withColumn("a", F.pmod(draw, "anchor_blocks").cast("int"))
    own = own.withColumn("c", every("candidate_blocks")).drop("anchor_blocks", "candidate_blocks")
    met = rows.join(sizes, list(alike_in)).withColumn("c", F.pmod(draw, "candidate_blocks").cast("int"))
    met = met.withColumn("a", every("anchor_blocks")).drop("anchor_blocks", "candidate_blocks")
    # Columns anew, as those of the two sides come from the same table.
    own, met = own.toDF(*own.columns), met.toDF(*met.columns)
    tile = [*alike_in, "a", "c"]
    return own.groupBy(*tile).cogroup(met.groupBy(*tile)).applyInPandas(work, schema)


def spanning_tree(squares: np.ndarray) -> list[tuple[int, int]]:
    """Edges `parent, child` of a minimum spanning tree from row 0, parents first, by squared distance."""
    count = len(squares)
    out = np.ones(count, bool)
    out[0] = False
    least, parent = squares[0].copy(), np.zeros(count, np.int64)
    edges = []
    for _ in range(count - 1):
        open_ = np.flatnonzero(out)
        child = int(open_[least[open_].argmin()])
        edges.append((int(parent[child]), child))
        out[child] = False
        closer = squares[child] < least
        least[closer], parent[closer] = squares[child][closer], child
    return edges


class Walk:
    """The anchors of a tile as a tree, along which bounds on the scores with some candidates go."""

    def __init__(self, anchors: np.ndarray):
        self.anchors = anchors
        own = (anchors * anchors).sum(axis=1)
        squares = own[:, None] - 2 * (anchors @ anchors.T) + own[None, :]
        self.edges = spanning_tree(squares)
        self.lengths = [roots_above(squares[p, c : c + 1])[0] for p, c in self.edges]

    def __call__(self, candidates: np.ndarray, wanted) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each anchor the candidates that were scored because they are wanted, and their scores.

        `wanted(anchor, low, high)` says which candidates matter to an anchor if scores are as bounded.
        It is asked when all anchors before have been dealt with.
        """
        sizes = roots_above((candidates * candidates).sum(axis=1))
        low = np.empty((len(self.anchors), len(candidates)), candidates.dtype)
        high = np.empty_like(low)
        low[0] = high[0] = candidates @ self.anchors[0]
        at = np.flatnonzero(wanted(0, low[0], high[0]))
        yield 0, at, low[0][at]
        for (parent, child), length in zip(self.edges, self.lengths):
            reach = sizes * length
            low[child], high[child] = low[parent] - reach, high[parent] + reach
            at = np.flatnonzero(wanted(child, low[child], high[child]))
            scores = candidates[at] @ self.anchors[child]
            low[child][at] = high[child][at] = scores
            yield child, at, scores


def _matrices(a: pd.DataFrame, c: pd.DataFrame, scale: float) -> list[np.ndarray]:
    return alike(*[floors(np.array(x["vector"].tolist(), np.float64).reshape(len(x), -1), scale) for x in (a, c)])


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The `k` first by falling score, of equal ones by id."""
    order = np.lexsort((ids, -scores))[:k] if scores.dtype != object else np.array(
        sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i]))[:k], np.int64
    )
    return ids[order], scores[order]


def _positives(a: pd.DataFrame, c: pd.DataFrame, k: int, scale: float) -> pd.DataFrame:
    """The best `k` candidates of each anchor, all of which have its label, but for itself."""
    columns = ["anchor_id", "vec_id", "score"]
    if not len(a) or not len(c):
        return pd.DataFrame({name: [] for name in columns})
    anchors, candidates = _matrices(a, c, scale)
    walk, names, ids = Walk(anchors), a["vec_id"].to_numpy(), c["vec_id"].to_numpy()
    found = [(ids[:0], candidates[:0, 0] if candidates.shape[1] else candidates.sum(axis=1)[:0])] * len(a)
    for start in range(0, len(c), STRIP):
        strip = slice(start, start + STRIP)

        def wanted(i, low, high):
            other = ids[strip] != names[i]
            have = found[i][1]
            return other & (high >= have[-1]) if len(have) == k else other

        for i, at, scores in walk(candidates[strip], wanted):
            new = np.concatenate([found[i][0], ids[strip][at]]), np.concatenate([found[i][1], scores])
            found[i] = _best(*new, k)
    return _frame(columns, [(np.full(len(i), n, names.dtype), i, s) for n, (i, s) in zip(names, found)])


def _negatives(a: pd.DataFrame, c: pd.DataFrame, k: int, window: tuple[int, int], scale: float) -> pd.DataFrame:
    """The best `k` candidates of other labels for each window of each anchor."""
    columns = ["anchor_id", "place", "vec_id", "score"]
    if not len(a) or not len(c):
        return pd.DataFrame({name: [] for name in columns})
    anchors, candidates = _matrices(a, c, scale)
    walk, names, ids = Walk(anchors), a["vec_id"].to_numpy(), c["vec_id"].to_numpy()
    labels, own = c["label"].to_numpy(), a["label"].to_numpy()
    # In whole scores: from the least that reaches window[0] percent to the greatest within window[1].
    ranges = [
        [(-(-window[0] * int(s) // 100), window[1] * int(s) // 100) for s in scores] for scores in a["scores"]
    ]
    none = ids[:0], np.zeros(0, candidates.dtype)
    found = [[none for _ in windows] for windows in ranges]
    for start in range(0, len(c), STRIP):
        strip = slice(start, start + STRIP)

        def wanted(i, low, high):
            matter = np.zeros(len(low), bool)
            for (least, most), (_, have) in zip(ranges[i], found[i]):
                if least <= most:
                    least = max(least, int(have[-1])) if len(have) == k else least
                    matter |= (high >= least) & (low <= most)
            return matter & (labels[strip] != own[i])

        for i, at, scores in walk(candidates[strip], wanted):
            for w, (least, most) in enumerate(ranges[i]):
                inside = np.flatnonzero((scores >= least) & (scores <= most))
                if len(inside):
                    ids_in, scores_in = ids[strip][at[inside]], scores[inside]
                    have = found[i][w]
                    found[i][w] = _best(np.concatenate([have[0], ids_in]), np.concatenate([have[1], scores_in]), k)
    parts = [
        (np.full(len(i), n, names.dtype), np.full(len(i), w + 1, np.int32), i, s)
        for n, of_anchor in zip(names, found)
        for w, (i, s) in enumerate(of_anchor)
    ]
    return _frame(columns, parts)


def _frame(columns: list[str], parts: list[tuple]) -> pd.DataFrame:
    parts = [p for p in parts if len(p[0])]
    if not parts:
        return pd.DataFrame({name: [] for name in columns})
    joined = [np.concatenate(column) for column in zip(*parts)]
    joined[-1] = longs(joined[-1]).to_numpy()
    return pd.DataFrame(dict(zip(columns, joined)))
