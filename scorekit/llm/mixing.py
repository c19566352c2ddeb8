"""Mixing sources to target weights by pivotal dependent rounding.

Each document of a source is wanted the same number of times, which is rarely whole. Its whole part is
taken as it is; the fractions are rounded together. Two documents put their fractions into one pot:
with the right chances one of them gets all it can hold, becoming 0 or 1, and the other keeps the
rest. In one draw every document keeps its expected number of copies, while the copies of a source add up
to what was wanted, but for the one fraction that is left at the end.

The pairing is a reduction tree. Documents of like size meet in small blocks; a block decides on all
but one of its documents and hands that one up. A block is a group of bounded size, so no source,
however large, has to come together in one place before only its last few residuals do. Those are
drawn several times, and the draw that comes nearest to the words wanted of the source is kept. That
choice favours some of the last documents a little: chances are as expected only with `tries=1`.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorekit.llm.common import WORD, checkpoint, whole_row, whole_text

# A fraction of a copy is a whole number of this many parts, so that sums are exact.
ONE = 1 << 30

# Documents to a block on average. Sizes are split in half octaves first, which makes blocks smaller;
# residuals of all sizes meet from the second level on, 8 times fewer blocks there.
BLOCK = 128
SECOND = 8

# Each source's figures are copied this often for the join, so that a large source fills many tasks.
SALTS = 32


def source_targets(sizes: DataFrame, weights: Sequence[int], most: int) -> DataFrame:
    """Per source: `source, source_size, documents, target`, from rows `source, size, count`.

    Sources by code point, null last, take the weights in turn. Targets share the total of all sizes by
    weight but stop at `most` times the source's size; what is above is shared again by weight. The
    result is the level at which all sources fill up together: with sources in the order in which they
    get full, it is the highest of what would be left per weight before each. The windows run over one
    row for each source. A null source is one like others, ties in fullness go by name, a source whose sizes
    are all 0 has the target 0, and an empty table gives an empty result.
    """
    totals = sizes.groupBy("source").agg(
        F.sum(F.col("size") * F.col("count")).alias("source_size"),
        F.sum(F.when(F.col("size") > 0, F.col("count")).otherwise(0)).alias("documents"),
    )
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = ((F.row_number().over(by_name) - 1) % len(weights)).cast("int")
    weighted = totals.withColumn("weight", F.get(F.array(*map(F.lit, weights)), turn))
    cap = F.col("source_size") * most
    full = Window.orderBy(cap / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    before = full.rowsBetween(Window.unboundedPreceding, -1)
    onwards = full.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum(cap).over(before), F.lit(0))
    level = weighted.withColumn("level", left / F.sum("weight").over(onwards))
    target = F.least(cap.cast("double"), F.max("level").over(everything) * F.col("weight"))
    return level.select("source", "source_size", "documents", target.alias("target"))


def draw_copies(
    docs: DataFrame,
    weights: Sequence[int] = (1, 2, 3),
    most: int = 3,
    seed: int = 0,
    tries: int = 32,
    text: str = "text",
    key: str = "doc_id",
    source: str = "source",
) -> DataFrame:
    """One row per row of `docs`: `doc_id, source, text_key, size, source_size, target, copies`.

    The size is the number of words, 0 for a null or empty text, which is never taken. `copies` is how
    often the mix takes the document, at most `most` times. Reruns agree: all draws follow from keys,
    texts and `seed`, not from the layout of the table. Rows that repeat key, source and text are drawn
    each on its own; null keys and sources are values like others. An empty table gives an empty
    result, and further columns are not looked at.
    """
    rows = docs.select(
        F.col(key).alias("doc_id"),
        F.col(source).alias("source"),
        F.xxhash64(whole_text(text)).alias("text_key"),
        F.regexp_count(whole_text(text), F.lit(WORD)).cast("long").alias("size"),
    )
    rows = checkpoint(rows.groupBy("doc_id", "source", "text_key", "size").count())
    units = _units(rows, checkpoint(source_targets(rows, weights, most)), most, seed)
    return _round(checkpoint(units), seed, tries).select(
        "doc_id",
        "source",
        "text_key",
        "size",
        "source_size",
        "target",
        (F.col("base") + F.col("take")).alias("copies"),
    )


def mix(
    docs: DataFrame,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
    **options,
) -> DataFrame:
    """The mixed documents: each row of `docs` as often as `draw_copies` takes it, all columns kept.

    Rows that repeat key, source and text stand for each other here: what is drawn for all of them is
    taken from one.
    """
    drawn = draw_copies(docs, key=key, source=source, text=text, **options)
    copies = drawn.groupBy("doc_id", "source", "text_key").agg(F.sum("copies").alias("copies"))
    copies = copies.where("copies > 0").toDF("doc_id", "of_source", "text_key", "copies")
    rows = docs.select(
        whole_row(docs).alias("row"),
        F.col(key).alias("key"),
        F.col(source).alias("source"),
        F.xxhash64(whole_text(text)).alias("hash"),
    ).dropDuplicates(["key", "source", "hash"])
    same = (
        (F.col("hash") == F.col("text_key"))
        & F.col("key").eqNullSafe(F.col("doc_id"))
        & F.col("source").eqNullSafe(F.col("of_source"))
    )
    every = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return rows.join(copies, same).select("row", every).select("row.*")


def _units(rows: DataFrame, targets: DataFrame, most: int, seed: int) -> DataFrame:
    """Each row with its whole copies `base`, its fraction `p` and the random number `h` it goes by."""
    occurrence = F.explode(F.sequence(F.lit(1).cast("long"), F.col("count"))).alias("occurrence")
    rows = rows.select("doc_id", "source", "text_key", "size", occurrence)
    h = F.xxhash64(F.lit(seed), "doc_id", "text_key", "occurrence")
    rows = rows.withColumns({"h": h, "salt": F.pmod(h, F.lit(SALTS)).cast("int")})
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    targets = targets.withColumn("_salt", salts).withColumnRenamed("source", "_source")
    same = (F.col("salt") == F.col("_salt")) & F.col("source").eqNullSafe(F.col("_source"))
    joined = rows.join(targets, same)
    rate = F.when(F.col("size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(most)))
    parts = F.coalesce(F.round(rate * ONE).cast("long"), F.lit(0))
    return joined.select(
        "doc_id",
        "source",
        "text_key",
        "size",
        "h",
        "source_size",
        "target",
        F.floor(parts / ONE).cast("long").alias("base"),
        (parts % ONE).alias("p"),
        F.ceil(F.col("documents") / BLOCK).cast("long").alias("blocks"),
    )


_CARRIED = ["size", "h", "p", "owed", "doc_id", "text_key", "base"]
_SOURCE = ["source", "source_size", "target"]
_UNIT = """struct<size bigint, h bigint, p bigint, owed double, doc_id {key}, text_key bigint,
    base bigint>"""
_DONE = "struct<size bigint, doc_id {key}, text_key bigint, base bigint, take bigint>"


def _round(units: DataFrame, seed: int, tries: int) -> DataFrame:
    """Whether each unit takes one copy more than `base`, as `take`.

    `owed` counts the words that a block wanted and did not take, or the other way round.
    """
    key = dict(units.dtypes)["doc_id"]
    whole = [F.col(c) for c in ("size", "doc_id", "text_key", "base")]
    decided = [units.where("p = 0").select(*_SOURCE, *whole, F.lit(0).cast("long").alias("take"))]
    open_units = units.where("p > 0").withColumn("owed", F.lit(0.0))
    blocks = open_units.agg(F.max("blocks")).first()[0] or 0
    level = 0
    while blocks:
        last = blocks == 1 and level > 0
        group = [*_SOURCE, "blocks", F.pmod(F.xxhash64(F.lit(level), "h"), "blocks").alias("block")]
        if level == 0:
            group.append(F.floor(F.log2("size") * 2).alias("octave"))
        gathered = open_units.groupBy(*group).agg(
            F.sort_array(F.collect_list(F.struct(*_CARRIED))).alias("units")
        )
        if last:
            draws = F.transform(
                F.sequence(F.lit(0), F.lit(tries - 1)),
                lambda n: _ended(_fold("units", key, level, seed, n), key, seed, n),
            )
            folded = gathered.withColumn("fold", F.array_min(draws))
        else:
            folded = gathered.withColumn("fold", _fold("units", key, level, seed, F.lit(0)))
        folded = checkpoint(folded.select(*_SOURCE, "blocks", "fold"))
        done = folded.select(*_SOURCE, F.explode("fold.done").alias("unit"))
        decided.append(done.select(*_SOURCE, "unit.*"))
        if last:
            break
        open_units = folded.select(*_SOURCE, "blocks", "fold.rest.*")
        smaller = SECOND if level == 0 else BLOCK
        open_units = open_units.withColumn("blocks", F.ceil(F.col("blocks") / smaller))
        blocks = -(-blocks // smaller)
        level += 1
    result = decided[0]
    for part in decided[1:]:
        result = result.unionByName(part)
    return result


def _decided(unit: Column, take: Column) -> Column:
    fields = [unit[c].alias(c) for c in ("size", "doc_id", "text_key", "base")]
    return F.array(F.struct(*fields, take.cast("long").alias("take")))


def _with(unit: Column, **changed: Column) -> Column:
    return F.struct(*[changed.get(c, unit[c]).alias(c) for c in _CARRIED])


def _state(rest: Column, done: Column) -> Column:
    return F.struct(rest.alias("rest"), done.alias("done"))


def _fold(units: str, key: str, level: int, seed: int, attempt: Column) -> Column:
    """The pivotal step along a block: `rest`, the unit left over, and `done`, the ones decided."""
    zero, one = F.lit(0), F.lit(1)

    def step(acc: Column, x: Column) -> Column:
        rest, done = acc["rest"], acc["done"]
        total = rest["p"] + x["p"]
        pot = F.when(total < ONE, total).otherwise(2 * ONE - total)
        random = F.xxhash64(F.lit(seed), F.lit(level), attempt, rest["h"], x["h"])
        draw = F.pmod(random, F.greatest(pot, one))
        # Below one copy together, one of them gets nothing; else one of them gets a copy.
        poor = total < ONE
        stays = F.when(poor, draw < rest["p"]).otherwise(draw >= ONE - x["p"])
        left = F.when(poor, total).otherwise(total - ONE)
        take = F.when(poor, zero).otherwise(one)
        owed = rest["owed"] + x["owed"]
        moved = F.when(
            stays, _state(_with(rest, p=left, owed=owed), F.concat(done, _decided(x, take)))
        ).otherwise(_state(_with(x, p=left, owed=owed), F.concat(done, _decided(rest, take))))
        return F.when(rest.isNull(), _state(x, done)).otherwise(moved)

    wanted = F.aggregate(units, F.lit(0.0), lambda s, u: s + u["p"] / ONE * u["size"] + u["owed"])

    def settle(acc: Column) -> Column:
        rest = acc["rest"]
        owed = wanted - _words(acc["done"]) - rest["p"] / ONE * rest["size"]
        return _state(_with(rest, owed=owed), acc["done"])

    start = _state(F.lit(None).cast(_UNIT.format(key=key)), _none_done(key))
    return F.aggregate(units, start, step, settle)


def _ended(fold: Column, key: str, seed: int, attempt: Column) -> Column:
    """A fold with its last unit decided too, after the words by which it misses what was wanted."""
    rest = fold["rest"]
    draw = F.pmod(F.xxhash64(F.lit(seed), F.lit("last"), attempt, rest["h"]), F.lit(ONE))
    take = (draw < rest["p"]).cast("long")
    missed = F.abs(rest["owed"] + (rest["p"] / ONE - take) * rest["size"])
    done = F.concat(fold["done"], _decided(rest, take))
    return F.struct(missed.alias("missed"), attempt.alias("attempt"), done.alias("done"))


def _words(done: Column) -> Column:
    return F.aggregate(done, F.lit(0.0), lambda s, d: s + d["take"] * d["size"])


def _none_done(key: str) -> Column:
    return F.array().cast(f"array<{_DONE.format(key=key)}>")
