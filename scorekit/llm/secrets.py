"""Secrets in texts: fixed patterns, and strings that look drawn at random.

Two Markov models of characters, one of random strings and one of ordinary identifiers, are fitted to
samples that rules label: what the patterns match is random, words elsewhere are not, and runs that
are to be judged themselves, long ones with both letters and digits, are no sample of either. Of a run
of token characters, or a part of one that matches leave, is a secret if its mean log-likelihood ratio is
nearer to what random strings get than to chance. If it is not, its stretch with the highest cumulative
ratio is one, provided that the excess over that threshold is more than the many stretches to choose from
explain; what is left beside it is judged likewise. A stretch has `JUDGE_CHARS` characters at least:
shorter ones say too little to be told from words, and only the patterns find them.
"""

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorekit.llm.batches import pieces, texts

# The patterns, the least length of what they must match, and the order of the kinds.
ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 8, "access": 16, "hex": 32}
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
KINDS = ("assign", "access", "hex", "markov")

SYMBOLS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
STATES = len(SYMBOLS) + 1
_SYMBOL = np.zeros(256, np.uint8)
_SYMBOL[list(SYMBOLS)] = np.arange(1, STATES)
_CODES = _SYMBOL.tobytes()
_FIRST_DIGIT = SYMBOLS.index(b"0") + 1  # letters come before, other symbols after the digits
_IS_HEX = bytes(int(chr(b) in "0123456789abcdef") for b in range(256))
_HEX_RUN = b"\x01" * LEAST["hex"]

# Shortest words that the identifier model learns from, and shortest stretches that are judged.
LEARN_CHARS = 8
JUDGE_CHARS = 20

# By how much the best stretch of a run must exceed the threshold, in logarithms of the number of stretches.
SURE = 1.5

SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"


@dataclass(frozen=True)
class RandomStrings:
    """Log-likelihood ratios of two adjacent characters, and the mean from which a run is random."""

    ratio: np.ndarray
    threshold: float

    @classmethod
    def from_counts(cls, random: np.ndarray, ordinary: np.ndarray) -> "RandomStrings":
        """From counts of adjacent symbols. Random strings may be of an alphabet that their sample does
        not show, so that half of their model is the uniform one; a fifth of the other is, so that no
        single pair of symbols that no identifier has yet shown decides on a whole run."""
        uniform = np.full((STATES, STATES), 1 / (STATES - 1))
        learned = (random + 0.5) / (random + 0.5).sum(axis=1, keepdims=True)
        p = (learned + uniform) / 2
        usual = (ordinary + 0.5) / (ordinary + 0.5).sum(axis=1, keepdims=True)
        q = 0.8 * usual + 0.2 * uniform
        ratio = np.log(p) - np.log(q)
        start = p[1:, 1:].mean(axis=0)
        expected = float((start[:, None] * p[1:, 1:] * ratio[1:, 1:]).sum() / start.sum())
        return cls(ratio, max(expected / 2, 1e-6))


def fit_random_strings(docs: DataFrame, text: str = "text") -> RandomStrings:
    """Count adjacent characters of both samples over all texts and fit the models.

    Each task adds up its own counts, so that at most `2 * STATES ** 2` rows of it are shuffled and as
    many come to the driver in all. Texts without any match leave the random model uniform.
    """
    counted = (
        docs.select(F.col(text).alias("text"))
        .mapInArrow(_count_pairs, "random boolean, pair int, n bigint")
        .groupBy("random", "pair")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    counts = np.zeros((2, STATES * STATES))
    for random, pair, n in counted:
        counts[int(random), pair] = n
    ordinary, random = counts.reshape(2, STATES, STATES)
    return RandomStrings.from_counts(random, ordinary)


def find_secrets(
    docs: DataFrame, model: RandomStrings, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """One row per row of `docs`: the key and `spans`, each a kind, start and end in code points.

    Spans are in order of start, then kind. Those of the patterns are found whatever the model says;
    it adds spans of kind `markov` that overlap none of them. Null counts as the empty text, which has
    no spans; rows that repeat are scanned each, an empty table gives an empty result, and further
    columns are not looked at.
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    kind = dict(rows.dtypes)["doc_id"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            ids, starts, ends, kinds, offsets = piece.column("doc_id"), [], [], [], [0]
            for t in texts(piece):
                for start, k, end in _spans(t, model):
                    starts.append(start)
                    ends.append(end)
                    kinds.append(KINDS[k])
                offsets.append(len(starts))
            spans = pa.StructArray.from_arrays(
                [pa.array(kinds, pa.string()), pa.array(starts, pa.int64()), pa.array(ends, pa.int64())],
                ["kind", "start", "end"],
            )
            spans = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), spans)
            yield pa.RecordBatch.from_arrays([ids, spans], ["doc_id", "spans"])

    return rows.mapInArrow(scan, f"doc_id {kind}, spans {SPANS}")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Matches of the patterns as (start, kind, end), in order."""
    found = []
    lower = text.lower()
    if any(word in lower for word in KEYWORDS):
        for m in ASSIGN.finditer(text):
            if m.end(1) - m.start(1) >= LEAST["assign"]:
                found.append((m.start(), 0, m.end()))
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if m.end() - m.start() >= LEAST["access"]:
                found.append((m.start(), 1, m.end()))
    flags = text.encode("ascii", "replace").translate(_IS_HEX)
    at = flags.find(_HEX_RUN)
    while at >= 0:  # a run found from its left end is followed to its right end
        end = flags.find(b"\x00", at)
        end = len(flags) if end < 0 else end
        found.append((at, 2, end))
        at = flags.find(_HEX_RUN, end)
    return sorted(found)


def _runs(text: str, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbol codes of a text, and starts and ends of the runs of at least `least` symbols."""
    codes = np.frombuffer(text.encode("ascii", "replace").translate(_CODES), np.uint8)
    # Places of other characters: between two of them lies a run.
    other = np.flatnonzero(codes == 0)
    bounds = np.concatenate(([-1], other, [len(codes)]))
    long = np.flatnonzero(np.diff(bounds) > least)
    return codes, bounds[long] + 1, bounds[long + 1]


def _apart(starts: np.ndarray, ends: np.ndarray, base: list[tuple[int, int, int]]) -> np.ndarray:
    """Which runs overlap no match."""
    free = np.ones(len(starts), bool)
    for start, _, end in base:
        free &= (ends <= start) | (starts >= end)
    return free


def _beside(start: int, end: int, base: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """The parts of a run that matches, in order of their starts, leave."""
    for first, _, last in base:
        if last <= start or first >= end:
            continue
        if first > start:
            yield start, first
        start = max(start, last)
    if start < end:
        yield start, end


def best_stretches(above: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Stretches of at least `least` symbols, in order, that are above the threshold.

    `above` says by how much each pair of adjacent symbols exceeds it. The whole is one if that adds up to
    zero or more. Else the stretch with the highest sum is one, of equal ones the first to end, if its
    sum reaches `SURE` times the logarithm of the number of stretches; and then what is left on either
    side is looked at in the same way."""
    found, open_ = [], [(0, len(above) + 1)]
    while open_:
        start, end = open_.pop()
        choices = end - start - least + 1
        if choices < 1:
            continue
        sums = np.concatenate(([0.0], np.cumsum(above[start : end - 1])))
        if sums[-1] >= 0:
            found.append((start, end))
            continue
        gains = sums[least - 1 :] - np.minimum.accumulate(sums[:choices])
        last = int(gains.argmax())
        if gains[last] < SURE * math.log(choices * (choices + 1) / 2):
            continue
        first = int(sums[: last + 1].argmin())
        last += least - 1
        found.append((start + first, start + last + 1))
        open_ += [(start, start + first), (start + last + 1, end)]
    return sorted(found)


def _spans(text: str, model: RandomStrings) -> list[tuple[int, int, int]]:
    base = base_spans(text)
    codes, starts, ends = _runs(text, JUDGE_CHARS)
    added = []
    for start, end in zip(starts.tolist(), ends.tolist()):
        for left, right in _beside(start, end, base) if base else [(start, end)]:
            if right - left >= JUDGE_CHARS:
                part = codes[left:right]
                above = model.ratio[part[:-1], part[1:]] - model.threshold
                added += [(left + a, 3, left + b) for a, b in best_stretches(above, JUDGE_CHARS)]
    return sorted(base + added)


def _count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    size = STATES * STATES
    counts = np.zeros((2, size), np.int64)
    for piece in pieces(batches):
        for text in texts(piece):
            base = base_spans(text)
            codes, starts, ends = _runs(text, LEARN_CHARS)
            free = _apart(starts, ends, base)
            runs = [codes[s:e] for s, e in zip(starts[free].tolist(), ends[free].tolist())]
            parts = [r for r in runs if len(r) < JUDGE_CHARS or not _mixed(r)]
            if parts:
                _add_pairs(counts[0], parts)
            if base:
                _add_pairs(counts[1], [codes[s:e] for s, _, e in _values(text, base)])
    found = np.flatnonzero(counts)
    if len(found):
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(found >= size),
                pa.array((found % size).astype(np.int32)),
                pa.array(counts.ravel()[found]),
            ],
            ["random", "pair", "n"],
        )


def _mixed(run: np.ndarray) -> bool:
    """Whether a run has both letters and digits."""
    digits = (run >= _FIRST_DIGIT) & (run < _FIRST_DIGIT + 10)
    return bool(digits.any()) and bool((run < _FIRST_DIGIT).any())


def _values(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The matches with those of assignments cut down to the value assigned."""
    return [
        (ASSIGN.match(text, start).start(1), kind, end) if kind == 0 else (start, kind, end)
        for start, kind, end in base
    ]


def _add_pairs(counts: np.ndarray, parts: list[np.ndarray]) -> None:
    """Count adjacent symbols inside each part; 0 stands between parts and for other characters."""
    gap = np.zeros(1, np.uint8)
    joined = np.concatenate([x for part in parts for x in (part, gap)]).astype(np.int32)
    left, right = joined[:-1], joined[1:]
    inside = (left > 0) & (right > 0)
    counts += np.bincount(left[inside] * STATES + right[inside], minlength=len(counts))
