"""URL rules judged by Bloom filter cascades.

A rule names a host and the start of a path. It is the key `host + path`, and a url has one key for
each suffix of its host and each prefix of its path that a rule could name. A cascade tells listed
keys from all other keys of the corpus without a join: its first filter holds the listed keys, the
second those other keys that the first lets through, the third the listed keys that the second lets
through, and so on until nothing is let through wrongly. Every key of the corpus has then been put to
the test, so membership is exact, although the filters take only some bits for each listed key.
"""

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorekit.llm.common import checkpoint

# Bits of a filter, at most: 64 MB in each task.
MOST_BITS = 1 << 29

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    action: str
    """`block` or `allow`."""
    host: str
    path: str

    @property
    def key(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Bloom:
    level: int
    bits: int
    hashes: int
    words: Column
    """The bits, 64 to a word, as one array: the answer of a scalar subquery, which each task gets once."""

    def has(self, key: Column) -> Column:
        tests = [
            F.getbit(F.get(self.words, F.floor(p / 64).cast("int")), (p % 64).cast("int")) == 1
            for p in _positions(key, self.level, self.bits, self.hashes)
        ]
        test = tests[0]
        for other in tests[1:]:
            test = test & other
        return test


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Bloom, ...] = field(default=())

    def has(self, key: Column) -> Column:
        """Whether `key` is listed; exact for the keys the cascade was built over."""
        answer = F.lit(len(self.levels) % 2 == 1)
        for i in reversed(range(len(self.levels))):
            answer = F.when(self.levels[i].has(key), answer).otherwise(F.lit(i % 2 == 1))
        return answer


def judge_urls(
    pages: DataFrame,
    rules: Sequence[Rule] | DataFrame,
    url: str = "url",
    default: str = "allow",
) -> DataFrame:
    """`pages` with `host`, `path`, `rule` and `verdict` of each row.

    The host is what follows the first `://` up to `/`, `?`, `#` or the end, with A-Z lower-cased, and
    the path what follows up to `?`, `#` or the end. A url that is null or has no `://` has neither.
    A rule fits its host and all subdomains if the path starts with the rule's; of several the longest
    wins, of equally long ones the one with the longer host, and `block` before `allow`. `rule` is its key,
    or null, and `verdict` its action, or `default`, as of a key that no list holds. Columns of those four
    names are replaced, repeated rows are judged each, and without rows there are no verdicts.

    `rules` may be a table `action, host, path` of any length, of which rows with a null count for
    nothing and repeated ones once. Two passes are made over the urls: one for the distinct keys, one for the
    verdicts. What is sent to the tasks are the bits, whose number follows from the rules and the logarithm
    of the keys; beyond `MOST_BITS` a list is refused. Of the rules the driver sees the actions, and which
    numbers of labels and lengths of paths go together: a url has a key for each of these.
    """
    if not isinstance(rules, DataFrame):
        rows = [(r.action, r.host, r.path) for r in rules]
        rules = pages.sparkSession.createDataFrame(rows, "action string, host string, path string")
    listed = checkpoint(
        rules.where("action IS NOT NULL AND host IS NOT NULL AND path IS NOT NULL")
        .select("action", F.concat("host", "path").alias("key"), _labels("host").alias("labels"), F.length("path").alias("length"))
        .distinct()
    )
    hosts = pages.withColumns({"host": _host(url), "path": _path(url)})
    shapes = listed.select("labels", "length").distinct().orderBy("labels", "length").collect()
    candidates = _candidates([(r.labels, r.length) for r in shapes])
    universe = _universe(hosts, candidates)
    actions = [r.action for r in listed.select("action").distinct().orderBy("action").collect()]
    cascades = {a: build_cascade(universe, listed.where(F.col("action") == a).select("key")) for a in actions}
    hits = [
        F.when(
            possible & cascade.has(key),
            F.struct(
                F.length(key).alias("length"),
                F.length(suffix).alias("host_length"),
                key.alias("key"),
                F.lit(action).alias("action"),
            ),
        )
        for key, suffix, possible in candidates
        for action, cascade in cascades.items()
    ]
    kind = "struct<length int, host_length int, key string, action string>"
    best = F.array_max(F.array(*hits)) if hits else F.lit(None).cast(kind)
    verdict = F.coalesce(best["action"], F.lit(default))
    return hosts.withColumns({"rule": best["key"], "verdict": verdict})


def build_cascade(universe: DataFrame, listed: DataFrame | Sequence[str]) -> Cascade:
    """The cascade that tells the values of `listed.key` from all others of `universe.key`.

    Keys listed twice are one; a null or repeated value of `key` changes nothing, and keys of any length
    take the same bits. With nothing listed there is no level and nothing is a member; an empty universe
    leaves one level, whose bits are those of the listed keys. Keys meet in a join only while it is built.
    """
    if not isinstance(listed, DataFrame):
        listed = universe.sparkSession.createDataFrame([(k,) for k in listed], "key string")
    # In turn: the keys a level encodes and those it must not let through.
    encoded = checkpoint(listed.where("key IS NOT NULL").select("key").distinct())
    others = checkpoint(universe.select("key").distinct().join(encoded, "key", "left_anti"))
    levels: list[Bloom] = []
    count, foreign = encoded.count(), others.count()
    while count:
        rate = math.sqrt(0.5) * count / max(foreign, count) if not levels else 0.5
        bloom = _bloom(encoded, len(levels) + 1, count, rate)
        levels.append(bloom)
        encoded, others = checkpoint(others.where(bloom.has(F.col("key")))), encoded
        count = encoded.count()
    return Cascade(tuple(levels))


def _bloom(keys: DataFrame, level: int, count: int, rate: float) -> Bloom:
    bits = max(64, math.ceil(count * -math.log(rate) / math.log(2) ** 2))
    hashes = max(1, round(-math.log2(rate)))
    if bits > MOST_BITS:
        raise ValueError(f"{count} listed keys take {bits} bits, more than {MOST_BITS}")
    position = F.explode(F.array(*_positions(F.col("key"), level, bits, hashes))).alias("position")
    held = (
        keys.select(position)
        .groupBy(F.floor(F.col("position") / 64).alias("id"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(position % 64 as int))")).alias("bits"))
    )
    every = keys.sparkSession.range(math.ceil(bits / 64)).join(held, "id", "left")
    word = F.struct("id", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))
    one = every.agg(F.array_sort(F.collect_list(word)).alias("words"))
    return Bloom(level, bits, hashes, checkpoint(one.select(F.col("words.bits").alias("words"))).scalar())


def _positions(key: Column, level: int, bits: int, hashes: int) -> list[Column]:
    """Places of a key in a filter: two halves of one hash, combined once for each place."""
    mixed = F.xxhash64(F.lit(level), key)
    low, high = mixed.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(mixed, 32)
    return [F.pmod(low + F.lit(i) * high, F.lit(bits).cast("long")) for i in range(hashes)]


def _labels(host: str) -> Column:
    return F.length(host) - F.length(F.replace(F.col(host), F.lit("."), F.lit(""))) + 1


def _candidates(shapes: Sequence[tuple[int, int]]) -> list[tuple[Column, Column, Column]]:
    """For each label count and path length that go together: the key of a url, its host and whether
    the url is long enough for it."""
    host, path = F.col("host"), F.col("path")
    found = []
    for labels, length in shapes:
        suffix = F.substring_index(host, ".", -labels)
        key = F.concat(suffix, F.substring(path, 1, length))
        found.append((key, suffix, (host != "") & (F.length(path) >= length)))
    return found


def _universe(hosts: DataFrame, candidates) -> DataFrame:
    """The distinct keys of all urls."""
    keys = F.array(*[F.when(possible, key) for key, _, possible in candidates])
    if not candidates:
        keys = F.array().cast(T.ArrayType(T.StringType()))
    exploded = hosts.select(F.explode(keys).alias("key")).where("key IS NOT NULL")
    return checkpoint(exploded.distinct())


def _host(url: str) -> Column:
    host = F.regexp_extract(F.col(url), "(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def _path(url: str) -> Column:
    return F.coalesce(F.regexp_extract(F.col(url), "(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))
