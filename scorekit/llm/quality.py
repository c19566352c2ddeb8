"""Quality rules by how well public vocabularies fit a text.

Each word of a text is encoded alone with every vocabulary. Three measures come of that: characters per
token, the share of tokens that are bytes of a character and no piece of it, and the entropy of the
tokens in bits. Texts that are hard to put into tokens, or that say the same few tokens over and over,
lie far outside what is usual in their language.

What is usual is counted over the whole corpus: texts of one language (or script, where no language is
told) and of about one length make a class, and the quartiles of each measure in a class set a band
that is several times as wide as the middle half of its texts. Short texts say little and are not judged.
"""

import base64
import re
from collections.abc import Iterator, Sequence
from functools import cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorekit.llm.batches import pieces, texts
from scorekit.llm.common import WORD, checkpoint

VOCABULARIES = (
    public_tokenizers.path("piece_bpe_32k.model"),
    public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
)
MEASURES = ("chars_per_token", "byte_share", "entropy")

# Measures are counted in steps of this size. A band reaches `REACH` times the distance of the quartiles
# beyond them, and at least `LEAST_REACH` as far; a class of fewer texts than `LEAST_TEXTS` has no band of
# its own, and texts of fewer tokens than `LEAST_TOKENS` are not judged by any.
STEPS = {"chars_per_token": 0.01, "byte_share": 0.001, "entropy": 0.01}
REACH = 5.0
LEAST_REACH = {"chars_per_token": 0.6, "byte_share": 0.1, "entropy": 1.0}
LEAST_TEXTS = 100
LEAST_TOKENS = 64

# Bands for texts whose class is too small to have its own.
USUAL = {"chars_per_token": (0.5, 12.0), "byte_share": (0.0, 0.6), "entropy": (2.0, 20.0)}

# The first code points of blocks that scripts fill, and the name of what follows.
SCRIPTS = [
    (0x0000, "none"), (0x0041, "Latin"), (0x005B, "none"), (0x0061, "Latin"), (0x007B, "none"),
    (0x00C0, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"),
    (0x0590, "Hebrew"), (0x0600, "Arabic"), (0x0700, "other"), (0x0900, "Indic"), (0x0E00, "Thai"),
    (0x0E80, "other"), (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "other"),
    (0x1E00, "Latin"), (0x1F00, "Greek"), (0x2000, "none"), (0x2E80, "Han"), (0x3040, "Kana"),
    (0x3100, "Han"), (0x3130, "Hangul"), (0x3190, "Han"), (0xA000, "other"), (0xAC00, "Hangul"),
    (0xD7B0, "other"), (0xF900, "Han"), (0xFB00, "other"), (0x20000, "Han"), (0x30000, "other"),
]
SCRIPT_NAMES = list(dict.fromkeys(name for _, name in SCRIPTS))

# Words that a worker remembers between texts, characters that these may have together, and characters
# of texts whose new words are encoded together.
REMEMBERED = 150_000
REMEMBERED_CHARS = 8_000_000
TOGETHER = 250_000

_WORDS = re.compile(WORD)
_SYMBOLS = "#*$%&|<>"
_SPACES = " \t\n\v\f\r"
_STARTS = np.array([start for start, _ in SCRIPTS] + [0x110000])
_SCRIPT_OF = np.repeat([SCRIPT_NAMES.index(name) for _, name in SCRIPTS], np.diff(_STARTS)).astype(np.uint8)


class Vocabulary:
    """One vocabulary file: `.model` of sentencepiece, `.tiktoken` of byte ranks."""

    def __init__(self, path: str):
        if path.endswith(".model"):
            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.encode = lambda words: model.encode(words, num_threads=1)
            self.is_byte = np.array([model.IsByte(i) for i in range(model.get_piece_size())])
        else:
            with open(path, "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            encoding = tiktoken.Encoding(
                path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
            )
            # A word of a running text has its space before it.
            self.encode = lambda words: [encoding.encode_ordinary(" " + w) for w in words]
            self.is_byte = np.zeros(max(ranks.values()) + 1, bool)
            for token, rank in ranks.items():
                self.is_byte[rank] = not _whole(token)


@cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _whole(token: bytes) -> bool:
    try:
        token.decode()
    except UnicodeDecodeError:
        return False
    return True


class Lexicon:
    """The tokens of words, which have numbers."""

    def __init__(self, vocabularies: Sequence[Vocabulary]):
        self.vocabularies = vocabularies
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.chars = 0
        self.sizes = [np.zeros(1024, np.int64) for _ in self.vocabularies]
        self.starts = [np.zeros(1024, np.int64) for _ in self.vocabularies]
        self.flat = [np.zeros(4096, np.int32) for _ in self.vocabularies]
        self.used = [0 for _ in self.vocabularies]

    def learn(self, documents: list[list[str]]) -> None:
        """See to it that all words of some texts are known; a full lexicon is emptied before."""
        if len(self.place) > REMEMBERED or self.chars > REMEMBERED_CHARS:
            self.clear()
        new = set(chain.from_iterable(documents)).difference(self.place)
        if new:
            self._learn(list(new))

    def numbers(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))

    def _learn(self, words: list[str]) -> None:
        first, last = len(self.place), len(self.place) + len(words)
        for v, vocabulary in enumerate(self.vocabularies):
            tokens = vocabulary.encode(words)
            sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
            at, total = self.used[v], int(sizes.sum())
            self.sizes[v], self.starts[v] = _room(self.sizes[v], last), _room(self.starts[v], last)
            self.sizes[v][first:last] = sizes
            self.starts[v][first:last] = at + np.cumsum(sizes) - sizes
            self.flat[v] = _room(self.flat[v], at + total)
            self.flat[v][at : at + total] = np.fromiter(chain.from_iterable(tokens), np.int32, total)
            self.used[v] = at + total
        self.place.update(zip(words, range(first, last)))
        self.chars += sum(map(len, words))

    def tokens(self, v: int, words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of distinct words, and how often each stands in the text."""
        sizes = self.sizes[v][words]
        ends = np.cumsum(sizes)
        shift = np.repeat(self.starts[v][words] - (ends - sizes), sizes)
        return self.flat[v][np.arange(int(sizes.sum())) + shift], np.repeat(counts, sizes)


@cache
def lexicon_of(paths: tuple[str, ...]) -> Lexicon:
    """One for all tasks of a worker, so that common words are encoded once."""
    return Lexicon([vocabulary(p) for p in paths])


def _room(values: np.ndarray, size: int) -> np.ndarray:
    if size <= len(values):
        return values
    grown = np.zeros((max(size, 2 * len(values)), *values.shape[1:]), values.dtype)
    grown[: len(values)] = values
    return grown


def script_of(text: str) -> str:
    """The script that most letters of a text are of."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    letters = np.bincount(_SCRIPT_OF[points], minlength=len(SCRIPT_NAMES))
    letters[0] = 0
    return SCRIPT_NAMES[int(letters.argmax())]


def repeated_words(words: np.ndarray, window: int = 5) -> int:
    """Words in windows that are found more than once. Windows get names: those of two neighbours, of
    two such pairs and so on, so that equal names are equal windows."""
    count = len(words) - window + 1
    if count < 2:
        return 0
    names, size = words, 1
    while size < window:
        step = min(size, window - size)
        left, right = names[: len(names) - step], names[step:]
        _, names = np.unique(left * (right.max() + 1) + right, return_inverse=True)
        size += step
    often = np.bincount(names)[names] > 1
    inside = np.zeros(len(words), bool)
    for i in range(window):
        inside[i : i + count] |= often
    return int(inside.sum())


def repeated_lines(text: str) -> int:
    """Lines with a word that are equal to an earlier one."""
    lines = [line for line in text.split("\n") if line.strip(_SPACES)]
    return len(lines) - len(set(lines))


def measure(documents: list[str], lexicon: Lexicon) -> Iterator[tuple]:
    """Counts of each text, its script, and for each vocabulary its tokens and three measures.

    Vocabularies are asked for the new words of some texts together, which takes them less time."""
    some, chars = [], 0
    for i, text in enumerate(documents):
        some.append(text)
        chars += len(text)
        if chars >= TOGETHER or i == len(documents) - 1:
            words = [_WORDS.findall(t) for t in some]
            lexicon.learn(words)
            for t, w in zip(some, words):
                yield _measure(t, w, lexicon)
            some, chars = [], 0


def _measure(text: str, words: list[str], lexicon: Lexicon) -> tuple:
    codes = lexicon.numbers(words)
    distinct, counts = np.unique(codes, return_counts=True)
    chars = len(text) - sum(map(text.count, _SPACES))
    symbols = sum(map(text.count, _SYMBOLS))
    measures = []
    for v, vocabulary in enumerate(lexicon.vocabularies):
        tokens, often = lexicon.tokens(v, distinct, counts)
        total = int(often.sum())
        if not total:
            measures += [0, None, None, None]
            continue
        share = np.bincount(tokens, often)
        share = share[share > 0] / total
        in_bytes = int(often[vocabulary.is_byte[tokens]].sum())
        measures += [total, chars / total, in_bytes / total, float(-(share * np.log2(share)).sum())]
    repeats = repeated_lines(text), repeated_words(codes)
    return len(words), chars, symbols, *repeats, script_of(text), *measures


_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def measure_columns(vocabularies: int) -> list[tuple[str, str]]:
    """Names of the measures, and which each is: the first vocabulary's are `chars_per_token_0` etc."""
    return [(f"{m}_{v}", m) for v in range(vocabularies) for m in MEASURES]


def measure_texts(
    docs: DataFrame,
    vocabularies: Sequence[str] = VOCABULARIES,
    text: str = "text",
    key: str = "doc_id",
    lang: str = "lang",
) -> DataFrame:
    """`doc_id, lang`, counts, `script`, and `n_tokens_v` and measures by vocabulary of each row of `docs`.

    A null text counts as empty; a text without words has no measures and the script `none`. Texts are
    read whole, whatever their length. Rows that repeat are measured each, further columns are not
    looked at, and an empty table gives an empty result. There is no shuffle.
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    of_each = [f"n_tokens_{v} bigint, " + ", ".join(f"{m}_{v} double" for m in MEASURES) for v in range(len(vocabularies))]
    schema = f"doc_id {kind}, lang string, {', '.join(f'{c} bigint' for c in _COUNTS)}, script string, {', '.join(of_each)}"
    paths = tuple(vocabularies)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = lexicon_of(paths)
        kinds = [pa.int64()] * len(_COUNTS) + [pa.string()]
        kinds += ([pa.int64()] + [pa.float64()] * len(MEASURES)) * len(paths)
        for piece in pieces(batches):
            found = measure(texts(piece), lexicon)
            columns = [pa.array(c, k) for c, k in zip(zip(*found), kinds)]
            names = [*_COUNTS, "script", *[n for v in range(len(paths)) for n in (f"n_tokens_{v}", *[f"{m}_{v}" for m in MEASURES])]]
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), piece.column("lang"), *columns], ["doc_id", "lang", *names]
            )

    return rows.mapInArrow(run, schema)


def _language() -> Column:
    """The language of a well-formed tag in lower case, at most three letters, else null."""
    return F.nullif(F.lower(F.regexp_extract("lang", r"^([A-Za-z]{2,3})(?:[-_].*)?$", 1)), F.lit(""))


def _length_class() -> Column:
    """Texts of one class differ in tokens by a factor of four at most."""
    return F.floor(F.log2(F.col("n_tokens_0")) / 2).cast("int")


def fit_bands(
    measured: DataFrame,
    vocabularies: int = len(VOCABULARIES),
    reach: float = REACH,
    least_texts: int = LEAST_TEXTS,
    least_tokens: int = LEAST_TOKENS,
) -> DataFrame:
    """`class_name, length_class, texts, bands`, from the measures of all texts.

    Classes are named by language (`lang:en`) and by script (`script:Latin`). `bands` holds for each
    measure the lowest and the highest value that pass. Every text is counted: measures are put into
    steps, the steps are counted in each task before anything is shuffled, and the quartiles are those
    of the counts, so that they do not depend on the order of rows. There are at most 18,252 languages
    of two or three letters and the scripts, with 16 length classes each up to four billion tokens.
    """
    columns = measure_columns(vocabularies)
    steps = [
        F.struct(F.lit(i).alias("measure"), F.floor(F.col(c) / STEPS[m]).cast("long").alias("step"))
        for i, (c, m) in enumerate(columns)
    ]
    named = F.array_compact(F.array(F.concat(F.lit("lang:"), _language()), F.concat(F.lit("script:"), "script")))
    placed = measured.where(F.col("n_tokens_0") >= least_tokens).select(
        F.explode(named).alias("class_name"), _length_class().alias("length_class"), F.array(*steps).alias("steps")
    )
    placed = placed.select("class_name", "length_class", F.inline("steps"))
    counts = placed.groupBy("class_name", "length_class", "measure", "step").agg(F.count("*").alias("n"))
    one = ["class_name", "length_class", "measure"]
    upto = F.sum("n").over(Window.partitionBy(*one).orderBy("step"))
    total = F.sum("n").over(Window.partitionBy(*one))
    spread = counts.select(*one, "step", upto.alias("upto"), total.alias("texts"))
    quartile = [F.min(F.when(F.col("upto") * 4 >= F.col("texts") * q, F.col("step"))) for q in (1, 3)]
    size = F.element_at(F.array(*[F.lit(STEPS[m]) for _, m in columns]), F.col("measure") + 1)
    floor = F.element_at(F.array(*[F.lit(LEAST_REACH[m]) for _, m in columns]), F.col("measure") + 1)
    middle = spread.where(F.col("texts") >= least_texts).groupBy(*one).agg(
        F.first("texts").alias("texts"), quartile[0].alias("q1"), quartile[1].alias("q3")
    )
    wide = F.greatest(F.lit(reach) * (F.col("q3") - F.col("q1") + 1) * size, floor)
    band = F.struct(
        "measure",
        (F.col("q1") * size - wide).alias("low"),
        ((F.col("q3") + 1) * size + wide).alias("high"),
    )
    return middle.groupBy("class_name", "length_class").agg(
        F.max("texts").alias("texts"), F.array_sort(F.collect_list(band)).alias("bands")
    )


def judge_quality(
    docs: DataFrame,
    vocabularies: Sequence[str] = VOCABULARIES,
    text: str = "text",
    key: str = "doc_id",
    lang: str = "lang",
    least_tokens: int = LEAST_TOKENS,
    least_words: int = 10,
    most_repeated: int = 20,
    **bands,
) -> DataFrame:
    """`docs` measured and judged: the columns of `measure_texts`, and

    * `base_failed`: fewer than `least_words` words, or more than `most_repeated` percent of the words in
      windows of five that the text repeats;
    * `band`: the class whose bands apply, of the language if that has enough texts, else of the
      script, else `usual`, the fixed ones; null for texts of fewer than `least_tokens` tokens;
    * `outside`: the measures that lie beyond their band, which are inclusive, in order;
    * `kept`: neither has the base failed nor is any measure outside.

    Nulls, empty texts, repeated rows and empty tables are as in `measure_texts`. The measures are written to the
    shared checkpoint folder, so that no text is encoded twice; `bands` are options of `fit_bands`.
    """
    measured = checkpoint(measure_texts(docs, vocabularies, text, key, lang))
    columns = measure_columns(len(vocabularies))
    fitted = fit_bands(measured, len(vocabularies), least_tokens=least_tokens, **bands)
    judged = measured.withColumns({"_length": _length_class(), "_language": F.concat(F.lit("lang:"), _language())})
    judged = judged.withColumn("_script", F.concat(F.lit("script:"), "script"))
    # One row for each class of at least `least_texts` texts, of which there are few (see `fit_bands`).
    found = F.broadcast(checkpoint(fitted).drop("texts"))
    for name in ("_language", "_script"):
        own = found.toDF(name, "_length", f"{name}_bands")
        judged = judged.join(own, [name, "_length"], "left")
    usual = F.array(
        *[
            F.struct(F.lit(i).alias("measure"), F.lit(USUAL[m][0]).alias("low"), F.lit(USUAL[m][1]).alias("high"))
            for i, (_, m) in enumerate(columns)
        ]
    )
    long_enough = F.col("n_tokens_0") >= least_tokens
    name = (
        F.when(~long_enough, None)
        .when(F.col("_language_bands").isNotNull(), F.col("_language"))
        .when(F.col("_script_bands").isNotNull(), F.col("_script"))
        .otherwise("usual")
    )
    limits = F.coalesce("_language_bands", "_script_bands", usual)
    judged = judged.withColumns({"band": name, "_limits": limits})
    beyond = [
        F.when(~F.col(c).between(F.col("_limits")[i]["low"], F.col("_limits")[i]["high"]), F.lit(c))
        for i, (c, _) in enumerate(columns)
    ]
    outside = F.when(long_enough, F.array_compact(F.array(*beyond))).otherwise(F.array().cast("array<string>"))
    failed = (F.col("n_words") < least_words) | (
        100 * F.col("n_repeat_words") > most_repeated * F.col("n_words")
    )
    judged = judged.withColumns({"outside": outside, "base_failed": failed})
    judged = judged.withColumn("kept", ~F.col("base_failed") & (F.size("outside") == 0))
    return judged.select(*measured.columns, "base_failed", "band", "outside", "kept")
