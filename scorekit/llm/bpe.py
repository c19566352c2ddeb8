"""BPE encoding by chunks that documents share, and decoding.

A rolling hash cuts texts where their content says so, in the middle of words too, so that equal
passages make equal chunks wherever they stand. The tokenizer encodes the inside of a chunk, from its
first to its last white space, once in a task, and all documents that hold the chunk reuse the tokens. What
lies between two insides is encoded with the last word before and the first word after it; the join is
right when the tokens of these two words come out as they do alone. If they do not, the two insides and
what lies between them are encoded again as one, and the joins at its ends are tried anew, until all
agree; in the end that is the whole text.

Insides and joins in characters that some steps of the tokenizer leave as they are get the same vocabulary
without these steps: their words are found and lower-cased before, and many are merged as one sequence.
"""

import json
import pickle
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import cache
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorekit.llm.batches import pieces

if TYPE_CHECKING:
    from tokenizers import Tokenizer

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")

# A cut is where the hash of the last 16 bytes ends in this many zero bits, which makes chunks of
# about 1 KB; two cuts are at least `LEAST` bytes apart.
ZERO_BITS = 10
LEAST = 256

# Bytes of insides and joins, with their tokens, that a task remembers.
REMEMBERED = 48 << 20

# Bytes of texts that are planned, encoded and decoded together, but for single texts.
TEXTS_AT_ONCE = 1 << 20

# Insides and joins that the tokenizer is asked for together.
ENCODED_AT_ONCE = 256

# How `WORD_BPE` finds words. Below U+0300, composing changes nothing, and what is made of white space does
# not matter, as this drops it. The words of lower-cased printable ASCII and of what is below U+0300:
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PRINTABLE_WORDS = r"[a-z]+|'(?:[stmd]|re|ve|ll)|[0-9]|[^\sa-z0-9]+"
_LETTERS = r"a-z\xaa\xb5\xba\xdf-\xf6\xf8-\u02c1\u02c6-\u02d1\u02e0-\u02e4\u02ec\u02ee\u2c65\u2c66"
_NUMBERS = r"0-9\xb2\xb3\xb9\xbc-\xbe"
_WORDS_BELOW_U0300 = rf"[{_LETTERS}]+|'(?:[stmd]|re|ve|ll)|[{_NUMBERS}]|[^\t-\r \x85\xa0{_LETTERS}{_NUMBERS}]+"
_PRINTABLE = re.compile(rb"[\n\x20-\x7E]*")
_FROM_U0300 = re.compile(rb"[\xCC-\xFF]")

_SPACES = re.compile(rb"[ \n]")
_FIRST_WORD = re.compile(rb"[ \n]*[^ \n]+")
_LAST_WORD = re.compile(rb"[^ \n]+[ \n]*\Z")
_NONE = np.zeros(0, np.uint32)

# Words that are merged as one sequence, and what the last character of a word is moved by there.
WORDS_AT_ONCE = 256
_LAST = 0x200

# What an entry of a dictionary takes besides, about.
PART_BYTES = 250


def cuts(data: bytes) -> list[int]:
    """Where a text in UTF-8 is cut, its ends included; never inside a character."""
    hashes = _MIX[np.frombuffer(data, np.uint8)]
    factor, reach = np.uint32(0x01000193), 1
    while reach < 16:
        longer = hashes.copy()
        longer[reach:] += hashes[:-reach] * factor
        hashes, factor, reach = longer, np.uint32((int(factor) ** 2) & 0xFFFFFFFF), reach * 2
    found, last = [0], 0
    for place in (np.flatnonzero(hashes >> np.uint32(32 - ZERO_BITS) == 0) + 1).tolist():
        if place - last >= LEAST and place < len(data) and data[place] & 0xC0 != 0x80:
            found.append(place)
            last = place
    found.append(len(data))
    return found


_MIX = np.random.default_rng(7).integers(0, 1 << 32, 256, dtype=np.uint32)


class ChunkEncoder:
    """Encodes whole texts, in batches, with what earlier texts had in common remembered."""

    def __init__(self, path: str):
        self.tokenizer = _tokenizer(path)
        self.printable, self.below_u0300 = _shorter(path)
        self.known: dict[bytes, np.ndarray] = {}
        self.held = 0
        self.repairs = 0

    def __call__(self, documents: list[bytes]) -> list[np.ndarray]:
        plans = [_plan(d) for d in documents]
        if self.held > REMEMBERED:
            self.known.clear()
            self.held = 0
        wanted = {p: None for plan in plans for p in plan.insides}
        for plan in plans:
            for left, join, right in plan.joins():
                wanted.update(dict.fromkeys((left, left + join + right, right)))
        self._encode(wanted)
        return [self._put_together(plan) for plan in plans]

    def _encode(self, wanted: Iterable[bytes]) -> None:
        by_tokenizer = defaultdict(list)
        for part in wanted:
            if part not in self.known:
                by_tokenizer[self._enough_for(part)].append(part)
        for tokenizer, new in by_tokenizer.items():
            for start in range(0, len(new), ENCODED_AT_ONCE):
                parts = new[start : start + ENCODED_AT_ONCE]
                encoded = tokenizer.encode_batch_fast([p.decode() for p in parts], add_special_tokens=False)
                for part, one in zip(parts, encoded):
                    ids = self.known[part] = np.array(one.ids, np.uint32)
                    self.held += len(part) + ids.nbytes + PART_BYTES

    def _enough_for(self, part: bytes) -> "Tokenizer | SpelledWords":
        """The tokenizer with the fewest steps that makes of `part` what all of them do."""
        if _PRINTABLE.fullmatch(part):
            return self.printable
        return self.tokenizer if _FROM_U0300.search(part) else self.below_u0300

    def _ids(self, part: bytes) -> np.ndarray:
        if part not in self.known:
            self._encode([part])
        return self.known[part]

    def _put_together(self, plan: "Plan") -> np.ndarray:
        """The tokens of a text, from those of its insides and joins."""
        # Pieces whose joins agree: bytes and tokens, with what lies before each and the tokens of that.
        pieces_, joins = [(b"", _NONE)], []
        for i, join in enumerate(plan.between):
            inside = plan.inside(i)
            pieces_.append((inside, self._ids(inside)))
            joins.append((join, None))
            while joins and joins[-1][1] is None:
                (left, _), (right, _), (join, _) = pieces_[-2], pieces_[-1], joins[-1]
                middle = self._between(last_word(left), join, first_word(right))
                if middle is not None:
                    joins[-1] = (join, middle)
                    break
                self.repairs += 1
                merged = left + join + right
                pieces_[-2:] = [(merged, self._whole(merged))]
                joins.pop()
                if joins:  # the piece before has a new neighbour
                    joins[-1] = (joins[-1][0], None)
        tokens = [pieces_[0][1]]
        for (_, middle), (_, ids) in zip(joins, pieces_[1:]):
            tokens += [middle, ids]
        return np.concatenate(tokens)

    def _whole(self, data: bytes) -> np.ndarray:
        encoded = self.tokenizer.encode(data.decode(), add_special_tokens=False)
        return np.array(encoded.ids, np.uint32)

    def _between(self, left: bytes, join: bytes, right: bytes) -> np.ndarray | None:
        """Tokens of `join` between its neighbours, unless it changes the tokens of these."""
        before, after, all_ids = self._ids(left), self._ids(right), self._ids(left + join + right)
        end = len(all_ids) - len(after)
        if end < len(before):
            return None
        if (all_ids[: len(before)] != before).any() or (all_ids[end:] != after).any():
            return None
        return all_ids[len(before) : end]


def last_word(part: bytes) -> bytes:
    """The last word of a part and the white space after it; empty if it has none."""
    found = _LAST_WORD.search(part[part.rstrip(b" \n").rfind(b" ") + 1 :]) if part else None
    return found[0] if found else b""


def first_word(part: bytes) -> bytes:
    """The first word of a part and the white space before it; empty if it has none."""
    found = _FIRST_WORD.match(part)
    return found[0] if found else b""


class Plan:
    """A text as insides of chunks and what lies before, between and after them."""

    def __init__(self, insides: list[bytes], between: list[bytes]):
        self.insides, self.between = insides, between

    def inside(self, i: int) -> bytes:
        return self.insides[i] if 0 <= i < len(self.insides) else b""

    def joins(self) -> Iterator[tuple[bytes, bytes, bytes]]:
        """Each join with the last word before it and the first word after it."""
        for i, join in enumerate(self.between):
            yield last_word(self.inside(i - 1)), join, first_word(self.inside(i))


def _plan(data: bytes) -> Plan:
    insides, between, open_join = [], [], b""
    places = cuts(data)
    for start, end in zip(places[:-1], places[1:]):
        chunk = data[start:end]
        first = _SPACES.search(chunk)
        last = max(chunk.rfind(b" "), chunk.rfind(b"\n"))
        if first is None or not chunk[first.start() : last].strip(b" \n"):
            open_join += chunk  # an inside has a word, so that joins have neighbours
            continue
        between.append(open_join + chunk[: first.start()])
        insides.append(chunk[first.start() : last])
        open_join = chunk[last:]
    between.append(open_join)
    return Plan(insides, between)


@cache
def _tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


class SpelledWords:
    """Encodes as the tokenizer does, for texts whose words `pattern` finds once they are lower-cased.

    The words are handed over one behind the other, the last character of each written as another one that
    only ends words. As no merge goes on after that, many words are one sequence, which spares the tokenizer
    what it does word by word.
    """

    def __init__(self, tokenizer: "Tokenizer", sequences: "Tokenizer", pattern: str):
        self.tokenizer, self.sequences = tokenizer, sequences
        self.words = re.compile(pattern)
        special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, special)) or r"(?!)")

    def encode(self, text: str, add_special_tokens: bool = False):
        return self.encode_batch_fast([text], add_special_tokens)[0]

    def encode_batch_fast(self, texts: list[str], add_special_tokens: bool = False) -> list:
        special = [self.special.search(t) is not None for t in texts]
        spelled = self._spelled([t for t, s in zip(texts, special) if not s])
        encoded = iter(self.sequences.encode_batch_fast(spelled, add_special_tokens=add_special_tokens))
        return [
            self.tokenizer.encode(t, add_special_tokens=add_special_tokens) if s else next(encoded)
            for t, s in zip(texts, special)
        ]

    def _spelled(self, texts: list[str]) -> list[str]:
        """Bytes as characters, as the vocabulary has them, and a line for so many words."""
        if not texts:
            return []
        codes = _CODES[np.frombuffer("\r".join(map(self._lines, texts)).encode(), np.uint8)]
        ends = codes == ord(" ")
        codes[np.flatnonzero(ends) - 1] += _LAST
        return codes[~ends].tobytes().decode("utf-16-le").split("\r")

    def _lines(self, text: str) -> str:
        words = self.words.findall(text.lower())
        lines = [words[i : i + WORDS_AT_ONCE] for i in range(0, len(words), WORDS_AT_ONCE)]
        return "\n".join([" ".join(line) + " " for line in lines])


def _byte_codes() -> np.ndarray:
    """The character that stands for a byte in a vocabulary of bytes; spaces and ends of lines are kept."""
    codes = np.arange(256, dtype="<u2")
    shown = (codes > 0x20) & (codes < 0x7F) | (codes > 0xA0) & (codes != 0xAD)
    codes[~shown] = 0x100 + np.arange(256 - shown.sum())
    codes[list(b" \n\r")] = list(b" \n\r")
    return codes


_CODES = _byte_codes()


def _spelled_tokenizer(tokenizer: "Tokenizer") -> "Tokenizer | None":
    """A tokenizer for the sequences of `SpelledWords`; none if the vocabulary is not one of words of bytes."""
    from tokenizers import Tokenizer, models, pre_tokenizers

    model = json.loads(tokenizer.to_str())["model"]
    vocabulary, merges, suffix = model["vocab"], model["merges"], model["end_of_word_suffix"]
    off = ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges")
    letters = pre_tokenizers.ByteLevel.alphabet()
    if model["type"] != "BPE" or not suffix or suffix in vocabulary or any(model[k] for k in off):
        return None
    if any(c not in vocabulary or c + suffix not in vocabulary for c in letters):
        return None
    if any(x.endswith(suffix) or (x + y).endswith(suffix) != y.endswith(suffix) for x, y in merges):
        return None

    def spelled(token: str) -> str:
        rest = token.removesuffix(suffix)
        return token if rest == token else rest[:-1] + chr(ord(rest[-1]) + _LAST)

    one = Tokenizer(
        models.BPE(
            {spelled(t): i for t, i in vocabulary.items()},
            [(spelled(x), spelled(y)) for x, y in merges],
            cache_capacity=0,
        )
    )
    one.pre_tokenizer = pre_tokenizers.CharDelimiterSplit("\n")
    one.post_processor = tokenizer.post_processor
    return one


@cache
def _shorter(path: str) -> tuple["Tokenizer | SpelledWords", "Tokenizer | SpelledWords"]:
    """The tokenizer for printable ASCII and for characters below U+0300, without the steps that change
    nothing there. They share a vocabulary. One with other steps has all of them in both."""
    from tokenizers import Regex, normalizers, pre_tokenizers

    tokenizer = _tokenizer(path)
    spaces = normalizers.Replace(Regex(r"\s+"), " ")
    known = (
        normalizers.Sequence([normalizers.NFC(), spaces, normalizers.Lowercase()]),
        pre_tokenizers.Sequence(
            [
                pre_tokenizers.Split(Regex(_WORDS), "removed", invert=True),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
            ]
        ),
    )
    steps = (tokenizer.normalizer, tokenizer.pre_tokenizer)
    if None in steps or [pickle.dumps(s) for s in steps] != [pickle.dumps(s) for s in known]:
        return tokenizer, tokenizer
    added = tokenizer.get_added_tokens_decoder().values()
    sequences = _spelled_tokenizer(tokenizer)
    if sequences is None or any(t.normalized or t.lstrip or t.rstrip for t in added):
        return tokenizer, tokenizer
    return tuple(SpelledWords(tokenizer, sequences, p) for p in (_PRINTABLE_WORDS, _WORDS_BELOW_U0300))


@cache
def _tokens(path: str) -> list[str]:
    """Every token by id, as decoding writes it."""
    tokenizer = _tokenizer(path)
    return [tokenizer.id_to_token(i) for i in range(tokenizer.get_vocab_size(with_added_tokens=True))]


def decode(ids: np.ndarray, path: str = WORD_BPE) -> str:
    """What the decoder of the vocabulary makes of `ids`; without one, as for `WORD_BPE`, the tokens with
    a space between, as the tokenizer has it."""
    if _tokenizer(path).decoder is not None:
        return _tokenizer(path).decode(ids.tolist(), skip_special_tokens=False)
    return " ".join(map(_tokens(path).__getitem__, ids.tolist()))


def encode_documents(
    docs: DataFrame, path: str = WORD_BPE, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """One row per row of `docs`: the key, `n_tokens`, `ids` and `decoded`.

    `ids` are little-endian unsigned 32-bit integers, as the tokenizer at `path` makes them of the whole
    text without adding special tokens, and `decoded` is what it makes of them again. Null counts as
    the empty text, which has no ids. Rows that repeat are encoded each, an empty table gives an empty
    result, and further columns are not looked at. There is no shuffle: each task reuses the chunks it
    has seen itself, so that no group of copies meets in one place. A vocabulary whose tokens depend on
    more than the words around a place needs more repairs, and in the worst case has whole texts encoded.
    """
    rows = docs.select(
        F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text")
    )
    kind = dict(rows.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ChunkEncoder(path)
        for piece in pieces(batches, most_bytes=TEXTS_AT_ONCE):
            ids = encoder(piece.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("doc_id"),
                    pa.array([len(i) for i in ids], pa.int64()),
                    pa.array([i.astype("<u4").tobytes() for i in ids], pa.binary()),
                    pa.array([decode(i, path) for i in ids], pa.string()),
                ],
                ["doc_id", "n_tokens", "ids", "decoded"],
            )

    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens bigint, ids binary, decoded string")
