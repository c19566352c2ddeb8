"""Toxicity of texts by a convolutional classifier.

A word is the sum of hashed embeddings, one of the word and one of each run of four or five letters
in it, so that other forms of a word are near it. Filters of several widths slide over the whole text,
each keeps its highest answer, and a logistic layer makes a score of these. The network is trained
with numpy on a bounded sample of labelled rows, whose classes weigh what they do among all of them.
Thresholds on the score are calibrated for each language on all labelled rows that were not trained on;
the score itself knows nothing of the language.
"""

import re
import zlib
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from scorekit.llm.batches import pieces, texts
from scorekit.llm.common import checkpoint

BUCKETS = 1 << 16
DIMENSIONS = 16
WIDTHS = (1, 2, 3)
FILTERS = 8
GRAMS = (4, 5)

# Labelled rows to train on, at most, and characters that all of them may have together.
TOXIC_ROWS = 2000
CLEAN_ROWS = 4000
SAMPLE_CHARS = 64_000_000

# One labelled row in so many is never trained on. Scores are counted in so many bins, a power of two,
# so that the bounds of bins are exact.
FOLDS = 5
BINS = 1 << 14

# Languages that may have thresholds of their own.
LANGUAGES = 256

# Training makes about this many steps, over 40 rounds of the sample at most.
STEPS = 900
ROUNDS = 40
BATCH = 32
RATE = 0.01
DROPPED = 0.2

# Places of a text that are looked at together, and words whose answers a task remembers.
CHUNK = 4096
REMEMBERED = 100_000

# Longer runs of letters are words of 64 letters, one after the other.
_WORDS = re.compile(r"\w{1,64}")


@dataclass(frozen=True)
class ToxicityModel:
    embedding: np.ndarray
    filters: tuple[np.ndarray, ...]
    """For each width: place in the window x dimension x filter."""
    bias: np.ndarray
    weights: np.ndarray
    offset: float
    thresholds: Mapping[str | None, float] = field(default_factory=dict)
    """Scores from which a text is rejected, by language; that of None for all others."""

    def scorer(self) -> "Scorer":
        return Scorer(self)


class Scorer:
    """Scores texts one by one. What a word adds to each filter is worked out once for each word."""

    def __init__(self, model: ToxicityModel):
        self.model = model
        places = [f[i] for f in model.filters for i in range(len(f))]
        self.projection = np.concatenate(places, axis=1)
        self.known: dict[str, int] = {}
        self.answers = np.zeros((1024, self.projection.shape[1]), np.float32)

    def __call__(self, text: str) -> float:
        best = np.full(len(self.model.bias), -np.inf, np.float32)
        words = split_words(text)
        overlap = max(WIDTHS) - 1
        for start in range(0, len(words), CHUNK):
            np.maximum(best, self._highest(words[start : start + CHUNK + overlap]), out=best)
        pooled = np.maximum(best + self.model.bias, 0)
        return float(1 / (1 + np.exp(-(pooled @ self.model.weights + self.model.offset))))

    def _highest(self, words: list[str]) -> np.ndarray:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = {w for w in words if w not in self.known}
        if new:
            self._learn(list(new))
        rows = self.answers[np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))]
        highest, column = [], 0
        for width in WIDTHS:
            count = len(words) - width + 1
            if count < 1:
                highest.append(np.full(FILTERS, -np.inf, np.float32))
            else:
                total = rows[:count, column : column + FILTERS]
                for i in range(1, width):
                    at = column + i * FILTERS
                    total = total + rows[i : i + count, at : at + FILTERS]
                highest.append(total.max(axis=0))
            column += width * FILTERS
        return np.concatenate(highest)

    def _learn(self, words: list[str]) -> None:
        first = len(self.known)
        while first + len(words) > len(self.answers):
            self.answers = np.concatenate([self.answers, np.zeros_like(self.answers)])
        vectors = Parts.of(words).vectors(self.model.embedding)
        self.answers[first : first + len(words)] = vectors @ self.projection
        self.known.update(zip(words, range(first, first + len(words))))


def split_words(text: str) -> list[str]:
    return _WORDS.findall(text.lower())


def word_parts(word: str) -> list[int]:
    """Buckets of a word and of its runs of letters, the start of the word counting as a letter."""
    begun = "<" + word
    runs = [begun[i : i + n] for n in GRAMS for i in range(len(begun) - n + 1)]
    return [zlib.crc32(p.encode()) % BUCKETS for p in (word, *runs)]


@dataclass(frozen=True)
class Parts:
    """Buckets of many words, end to end, with the number of each word."""

    flat: np.ndarray
    sizes: np.ndarray

    @classmethod
    def of(cls, words: Iterable[str]) -> "Parts":
        flat, sizes = array("q"), array("q")  # far smaller than as many lists of numbers
        for word in words:
            parts = word_parts(word)
            flat.extend(parts)
            sizes.append(len(parts))
        return cls(np.array(flat, np.int64), np.array(sizes, np.int64))

    def take(self, words: np.ndarray) -> "Parts":
        sizes = self.sizes[words]
        ends = np.cumsum(sizes)
        shift = (np.cumsum(self.sizes) - self.sizes)[words] - (ends - sizes)
        return Parts(self.flat[np.arange(sizes.sum()) + np.repeat(shift, sizes)], sizes)

    def vectors(self, embedding: np.ndarray) -> np.ndarray:
        if not len(self.sizes):
            return np.zeros((0, embedding.shape[1]), np.float32)
        return np.add.reduceat(embedding[self.flat], np.cumsum(self.sizes) - self.sizes, axis=0)


def held_out(key: str = "doc_id") -> Column:
    """The rows whose labels are never learned from."""
    crc = F.crc32(F.col(key).cast("string").cast("binary"))
    return F.coalesce(crc % 4 == 2, F.lit(False))


@dataclass(frozen=True)
class Training:
    """A model without thresholds, and what it takes to calibrate it."""

    model: ToxicityModel
    rest: DataFrame
    """`doc_id, toxic` of the labelled rows that were not trained on."""
    trained: Mapping[tuple, int]
    """Numbers of the rows that were, by language and label."""


def train_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    toxic_rows: int = TOXIC_ROWS,
    clean_rows: int = CLEAN_ROWS,
    sample_chars: int = SAMPLE_CHARS,
    text: str = "text",
    key: str = "doc_id",
    lang: str = "lang",
) -> Training:
    """Train on the rows of `labels` (`doc_id, toxic`) that are not held out.

    One row in `FOLDS` is kept from training. Of the other toxic rows the `toxic_rows` whose keys have the
    smallest hashes are trained on, of the clean ones `clean_rows`, long texts as well as short ones, each
    as long as the texts taken have `sample_chars` characters together at most; each class has the weight
    in training that it has among all rows. Rows without key, label or document are left out, a key
    labelled twice is toxic if one label says so, and of rows that repeat a key one text is used, the
    first in order. With no row of either class there is nothing to learn: all scores are then 0. Further
    columns are not looked at.
    """
    rows = docs.select(
        F.col(key).alias("_key"), F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")
    )
    usable = labels.where(~held_out() & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    marked = usable.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    marked = checkpoint(marked.join(rows.select("_key"), F.col("_key") == F.col("doc_id"), "left_semi"))
    sizes = {r["toxic"]: r["count"] for r in marked.groupBy("toxic").count().collect()}
    order = F.xxhash64("doc_id")
    trainable = marked.where(F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS)) > 0)
    chosen = trainable.where("toxic = 1").orderBy(order, "doc_id").limit(toxic_rows)
    clean = trainable.where("toxic = 0").orderBy(order, "doc_id").limit(clean_rows)
    # At most toxic_rows + clean_rows rows, whatever the size of the table; their texts come to the
    # driver only once it is known from the lengths which of them fit.
    sample = rows.join(F.broadcast(chosen.union(clean)), F.col("_key") == F.col("doc_id"))
    first = F.min(F.struct("text", "lang", "toxic")).alias("first")
    firsts = checkpoint(sample.groupBy("doc_id").agg(first).select("doc_id", "first.*"))
    length = F.coalesce(F.length("text"), F.lit(0)).alias("chars")
    fitting = _that_fit(firsts.select("doc_id", "toxic", length).orderBy(order, "doc_id").collect(), sample_chars)
    keys = StructType([marked.schema["doc_id"]])
    known = docs.sparkSession.createDataFrame(fitting, keys)
    found = firsts.join(F.broadcast(known), "doc_id", "left_semi").collect()
    found.sort(key=lambda r: (zlib.crc32(str(r.doc_id).encode()[::-1]), r.doc_id))
    toxic = np.array([r.toxic for r in found], np.float32)
    learn = (split_words(r.text or "") for r in found)
    model = _train(learn, toxic, _class_weights(toxic, sizes))
    trained = Counter((r.lang, r.toxic) for r in found)
    return Training(model, marked.join(F.broadcast(known), "doc_id", "left_anti"), trained)


def calibrate(scored: DataFrame, training: Training, most_languages: int = LANGUAGES) -> ToxicityModel:
    """The model with thresholds, from `scored`: `doc_id, lang, hash, score` of the documents.

    All labelled rows that were not trained on count, by the scores of their whole texts; of rows that
    repeat a key that with the smallest hash. The `most_languages` languages with the most of them have
    thresholds of their own if they have enough rows of both labels, all others, and texts without a
    language, go by the one over all. Scores are counted by language, label and bin, and no more than a
    threshold for each language comes to the driver, and two rows for each bin.
    """
    if len({label for _, label in training.trained}) < 2:
        return training.model
    labelled = scored.join(training.rest, "doc_id")
    once = labelled.groupBy("doc_id").agg(F.min(F.struct("hash", "lang", "toxic", "score")).alias("first"))
    place = F.least(F.floor(F.col("first.score") * BINS), F.lit(BINS - 1)).cast("int").alias("bin")
    counts = once.groupBy("first.lang", "first.toxic", place).agg(F.count("*").alias("n"))
    counts = checkpoint(counts)
    return replace(training.model, thresholds=_thresholds(counts, training.trained, most_languages))


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    lang: str = "lang",
    **options,
) -> ToxicityModel:
    """A model with thresholds, for documents that come later: `train_toxicity`, whose `options` it
    takes, and `calibrate` on the labelled rows of `docs`. Nulls, empty tables and repeated keys are as
    there."""
    training = train_toxicity(docs, labels, text=text, key=key, lang=lang, **options)
    labelled = docs.join(training.rest.select(F.col("doc_id").alias("_key")), F.col(key) == F.col("_key"), "left_semi")
    return calibrate(_scores(labelled, training.model, text, key, lang), training)


def judge_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    lang: str = "lang",
    **options,
) -> DataFrame:
    """`doc_id, lang, hash, score, rejected` of each row of `docs`, by a model fitted on its labelled rows.

    Every document is scored once. Key, language, hash of the text and score are written to the shared
    checkpoint folder; the labels meet these, and no text is shuffled but those trained on. Nulls, empty texts,
    repeats and empty tables are as in `score_toxicity`; further columns are not looked at.
    """
    training = train_toxicity(docs, labels, text=text, key=key, lang=lang, **options)
    scored = checkpoint(_scores(docs, training.model, text, key, lang))
    model = calibrate(scored, training)
    return scored.withColumn("rejected", F.col("score") >= _threshold_of("lang", model))


def drop_toxic(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    lang: str = "lang",
    **options,
) -> DataFrame:
    """The rows of `docs` that are not rejected, all their columns as they were, whatever their names.

    As `judge_toxicity`, but the scored rows, whole, are what is written to the checkpoint folder. A null
    or empty text has the score of a text without words; each of rows that repeat is judged alike.
    """
    training = train_toxicity(docs, labels, text=text, key=key, lang=lang, **options)
    names = [f"c{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*names)
    found = {c.lower(): n for c, n in zip(docs.columns, names)}
    own_text, own_key, own_lang = (found[c.lower()] for c in (text, key, lang))
    rows = plain.withColumn("hash", F.xxhash64(own_text))
    scored = checkpoint(_with_scores(rows, training.model, own_text, rows.columns))
    small = scored.select(F.col(own_key).alias("doc_id"), F.col(own_lang).cast("string").alias("lang"), "hash", "score")
    model = calibrate(small, training)
    kept = scored.where(F.col("score") < _threshold_of(own_lang, model))
    return kept.select(*names).toDF(*docs.columns)


def _scores(docs: DataFrame, model: ToxicityModel, text: str, key: str, lang: str) -> DataFrame:
    """`doc_id, lang, hash, score` of each row."""
    rows = docs.select(
        F.col(key).alias("doc_id"),
        F.col(lang).cast("string").alias("lang"),
        F.xxhash64(text).alias("hash"),
        F.col(text).alias("text"),
    )
    return _with_scores(rows, model, "text", ["doc_id", "lang", "hash"])


def _threshold_of(lang: str, model: ToxicityModel) -> Column:
    own = {name: value for name, value in model.thresholds.items() if name is not None}
    common = F.lit(model.thresholds.get(None, 0.5))
    if not own:
        return common
    pairs = [F.lit(x) for pair in own.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.col(lang).cast("string")), common)


def _that_fit(sample: list, most: int) -> list[tuple]:
    """Keys of the rows, `doc_id, toxic, chars`, that are taken while there is room; both classes fill it
    alike. One that has no room left is passed over, so that a huge text does not keep out the others."""
    of_class = Counter(r.toxic for r in sample)
    seen: Counter = Counter()
    places = []
    for row in sample:
        places.append((seen[row.toxic] / of_class[row.toxic], len(places)))
        seen[row.toxic] += 1
    taken, room = [], most
    for _, i in sorted(places):
        if sample[i].chars <= room:
            taken.append((sample[i].doc_id,))
            room -= sample[i].chars
    return taken


def _class_weights(toxic: np.ndarray, sizes: Mapping[int, int]) -> np.ndarray:
    """Weights, 1 on average, by which a sample has the mix of classes of all rows."""
    weights = np.ones(len(toxic), np.float32)
    for label, size in sizes.items():
        own = toxic == label
        if own.any():
            weights[own] = size / own.sum()
    return weights / weights.mean() if len(weights) else weights


def score_toxicity(
    docs: DataFrame,
    model: ToxicityModel,
    text: str = "text",
    lang: str = "lang",
) -> DataFrame:
    """`docs` with `score` and `rejected`, from the whole text of each row.

    `rejected` says that the score reaches the threshold of the row's language, or the common one if
    there is none for it. Null counts as the empty text, which has the score of a text without words.
    Columns of those two names are replaced, all others stay; rows that repeat are scored each, and an
    empty table gives an empty result. Scoring has no shuffle.
    """
    columns = [c for c in docs.columns if c.lower() not in ("score", "rejected")]
    rows = docs.select(*[f"`{c}`" for c in columns])
    scored = _with_scores(rows, model, text, columns)
    return scored.withColumn("rejected", F.col("score") >= _threshold_of(lang, model))


def _with_scores(rows: DataFrame, model: ToxicityModel, text: str, columns: list[str]) -> DataFrame:
    """`columns` of `rows` and `score`."""
    schema = rows.select(*[f"`{c}`" for c in columns], F.lit(0.0).alias("score")).schema
    places = [rows.columns.index(c) for c in columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = model.scorer()
        for piece in pieces(batches, text):
            scores = pa.array([scorer(t) for t in texts(piece, text)], pa.float64())
            kept = [piece.column(i) for i in places]
            yield pa.RecordBatch.from_arrays([*kept, scores], [*columns, "score"])

    return rows.mapInArrow(run, schema)


def _thresholds(
    counts: DataFrame, trained: Mapping, most_languages: int, least: int = 10
) -> dict[str | None, float]:
    """The middle of the widest gap that gives the best F1, by language and, under None, over all.

    `counts` are rows `lang, toxic, bin, n`; those of a language and class also stand for the rows that
    were `trained` on, so that the mix of classes is that of all labelled rows. With fewer than `least`
    rows of either class in `counts` a language goes by the threshold over all, and that is 0.5 if there
    are no more of them altogether.
    """
    spark = counts.sparkSession
    # At most two rows for each row of the sample.
    seen = spark.createDataFrame([(k, t, n) for (k, t), n in trained.items()], "lang string, toxic int, trained bigint")
    sizes = counts.groupBy("lang", "toxic").agg(F.sum("n").alias("size"))
    of_class = [F.coalesce(F.sum(F.when(F.col("toxic") == t, F.col("size"))), F.lit(0)) for t in (0, 1)]
    by_lang = sizes.where("lang IS NOT NULL").groupBy("lang").agg(F.least(*of_class).alias("least"), F.sum("size").alias("size"))
    own = by_lang.where(F.col("least") >= least).orderBy(F.col("size").desc(), "lang").limit(most_languages)

    def same(other: DataFrame) -> Column:
        return sizes["lang"].eqNullSafe(other["lang"]) & (sizes["toxic"] == other["toxic"])

    share = sizes.join(F.broadcast(seen), same(seen), "left").select(
        sizes["lang"].alias("_lang"), sizes["toxic"].alias("_toxic"),
        (1 + F.coalesce("trained", F.lit(0)) / F.col("size")).alias("share"),
    )
    joined = counts.join(share, F.col("lang").eqNullSafe(F.col("_lang")) & (F.col("toxic") == F.col("_toxic")))
    weighted = checkpoint(joined.select("lang", "toxic", "bin", "n", (F.col("n") * F.col("share")).alias("weight")))
    rows = weighted.groupBy("toxic", "bin").agg(F.sum("n").alias("n"), F.sum("weight").alias("weight")).toPandas()
    found: dict[str | None, float] = {None: 0.5}
    if min(rows["n"][rows["toxic"] == t].sum() for t in (0, 1)) >= least:
        found[None] = _threshold(_by_bin(rows))
    of_each = weighted.join(own.select("lang"), "lang", "left_semi").groupBy("lang").applyInPandas(
        lambda key, part: pd.DataFrame({"lang": [key[0]], "threshold": [_threshold(_by_bin(part))]}),
        "lang string, threshold double",
    )
    found.update((r["lang"], r["threshold"]) for r in of_each.collect())
    return found


def _by_bin(rows: pd.DataFrame) -> np.ndarray:
    counts = np.zeros((2, BINS))
    np.add.at(counts, (rows["toxic"].to_numpy(), rows["bin"].to_numpy()), rows["weight"].to_numpy())
    return counts


def _threshold(counts: np.ndarray) -> float:
    """From numbers of clean and toxic rows by bin."""
    used = np.flatnonzero(counts.any(axis=0))
    lower = np.concatenate(([0], used + 1)) / BINS
    upper = np.concatenate((used, [BINS])) / BINS
    above = np.cumsum(counts[:, ::-1], axis=1)[:, ::-1]
    chosen = np.concatenate((above[:, used], np.zeros((2, 1))), axis=1)
    f1 = 2 * chosen[1] / np.maximum(chosen.sum(axis=0) + counts[1].sum(), 1)
    best = np.flatnonzero(f1 >= f1.max() - 1e-12)
    at = best[np.argmax((upper - lower)[best])]
    return float((lower[at] + upper[at]) / 2)


def _train(
    documents: Iterable[list[str]], toxic: np.ndarray, weights: np.ndarray, seed: int = 1
) -> ToxicityModel:
    """Fit the network; of the documents only numbers for their words are kept."""
    place: dict[str, int] = {}
    coded = [
        np.fromiter((place.setdefault(w, len(place)) for w in d), np.int32, len(d))
        for d in documents
    ]
    rng = np.random.default_rng(seed)
    total = FILTERS * len(WIDTHS)
    net = {
        "embedding": rng.normal(0, 0.02, (BUCKETS, DIMENSIONS)).astype(np.float32),
        **{
            f"filter{w}": rng.normal(0, 0.3, (w, DIMENSIONS, FILTERS)).astype(np.float32)
            for w in WIDTHS
        },
        "bias": np.zeros(total, np.float32),
        "weights": rng.normal(0, 0.3, total).astype(np.float32),
        "offset": np.zeros(1, np.float32),
    }
    if not coded or toxic.min() == toxic.max():
        net["weights"][:] = 0
        net["offset"][:] = -np.inf
    else:
        parts = Parts.of(place)
        place.clear()
        moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.items()}
        rounds = min(ROUNDS, -(-STEPS * BATCH // len(coded)))
        for done in range(rounds):
            order = rng.permutation(len(coded))
            rate = RATE * (1 - done / rounds)
            for start in range(0, len(order), BATCH):
                batch = order[start : start + BATCH]
                heard = [coded[i][rng.random(len(coded[i])) >= DROPPED] for i in batch]
                _step(net, moments, parts, heard, toxic[batch], weights[batch], rate)
    filters = tuple(net[f"filter{w}"] for w in WIDTHS)
    return ToxicityModel(
        net["embedding"], filters, net["bias"], net["weights"], float(net["offset"][0])
    )


def _step(net, moments, parts, documents, toxic, weights, rate) -> None:
    """One step of Adam on a batch. Only the places where filters answered highest have gradients."""
    used, codes = np.unique(np.concatenate(documents), return_inverse=True)
    vectors = parts.take(used).vectors(net["embedding"])
    bounds = np.cumsum([len(d) for d in documents])[:-1]
    documents = np.split(codes, bounds)
    pooled = np.zeros((len(documents), len(net["bias"])), np.float32)
    at = np.full((len(documents), len(WIDTHS), FILTERS), -1)
    for d, ids in enumerate(documents):
        words = vectors[ids]
        for i, width in enumerate(WIDTHS):
            count = len(ids) - width + 1
            if count < 1:
                continue
            filters = net[f"filter{width}"]
            answers = words[:count] @ filters[0]
            for p in range(1, width):
                answers += words[p : p + count] @ filters[p]
            own = slice(i * FILTERS, (i + 1) * FILTERS)
            at[d, i] = answers.argmax(axis=0)
            pooled[d, own] = answers[at[d, i], np.arange(FILTERS)] + net["bias"][own]
    active = (pooled > 0) & (at.reshape(len(documents), -1) >= 0)
    hidden = np.where(active, pooled, 0)
    scores = 1 / (1 + np.exp(-(hidden @ net["weights"] + net["offset"][0])))
    error = (scores - toxic) * weights / len(toxic)
    back = error[:, None] * net["weights"][None, :] * active
    slopes = {
        "weights": error @ hidden + 1e-4 * net["weights"],
        "offset": np.array([error.sum()], np.float32),
        "bias": back.sum(axis=0),
    }
    pushed = np.zeros_like(vectors)
    for i, width in enumerate(WIDTHS):
        d, f = np.nonzero(back[:, i * FILTERS : (i + 1) * FILTERS])
        g = back[d, i * FILTERS + f][:, None]
        filters = net[f"filter{width}"]
        slopes[f"filter{width}"] = slope = np.zeros_like(filters)
        for p in range(width):
            ids = np.array([documents[x][at[x, i, y] + p] for x, y in zip(d, f)], np.int64)
            np.add.at(pushed, ids, g * filters[p].T[f])
            np.add.at(slope[p].T, f, g * vectors[ids])
    for name, slope in slopes.items():
        _adam(net[name], moments[name], slope, rate, slice(None))
    moved = np.flatnonzero(pushed.any(axis=1))
    if len(moved):
        taken = parts.take(used[moved])
        rows, inverse = np.unique(taken.flat, return_inverse=True)
        slope = np.zeros((len(rows), DIMENSIONS), np.float32)
        np.add.at(slope, inverse, np.repeat(pushed[moved], taken.sizes, axis=0))
        _adam(net["embedding"], moments["embedding"], slope, rate, rows)


def _adam(values, moments, slope, rate, rows) -> None:
    mean, square = moments
    mean[rows] = 0.9 * mean[rows] + 0.1 * slope
    square[rows] = 0.99 * square[rows] + 0.01 * slope * slope
    values[rows] -= rate * mean[rows] / (np.sqrt(square[rows]) + 1e-6)
