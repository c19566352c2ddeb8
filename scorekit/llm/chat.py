"""Chat formatting on the level of tokens.

Each segment of a conversation (a role, a text) is encoded on its own by a byte-level vocabulary, and
ids above that vocabulary are put between segments as marks, so that no text can pass for a mark in
the ids. In the written form a mark is a control string; where a text holds one itself, a backslash is
put after its first character, and one more if there are some already, which is undone when reading.

Marks stand one by one, and where loss counts is a prefix sum over them: the mark before the text of an
assistant counts up, the mark after it counts down.
"""

import hashlib
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorekit.llm.batches import pieces

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")

# The marks in order of their ids, which follow the vocabulary.
MARKS = ("[INST]", "[/INST]", "<s>", "</s>", "<|system|>", "<|/system|>", "<|role|>", "<|text|>", "<|end|>")
# The marks before and after the text of a role. Other roles are written out between two marks.
ROLES = {
    "user": ("[INST]", "[/INST]"),
    "assistant": ("<s>", "</s>"),
    "system": ("<|system|>", "<|/system|>"),
}
LOSS_ROLE = "assistant"

# No mark holds `[` or `<` after its first character, so that marks in a text never overlap.
_BODIES = "|".join(re.escape(m[1:]) for m in sorted(MARKS, key=len, reverse=True))
_MARK = re.compile("|".join(f"{re.escape(f)}(?:{_BODIES})" for f in "[<"))
_PLAIN = re.compile(rf"([\[<])(\\*)({_BODIES})")
_ESCAPED = re.compile(rf"([\[<])\\(\\*)({_BODIES})")

TURNS = "ids array<int>, loss array<boolean>, formatted string"


def escape(text: str) -> str:
    """A text in which no control string occurs; `unescape` gives it back."""
    return _PLAIN.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


@cache
def _tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True  # their strings are ordinary text in a segment
    return tokenizer, tokenizer.get_vocab_size(with_added_tokens=True)


@cache
def _token_bytes(path: str) -> list[bytes]:
    """What each id stands for, nothing for the marks. A byte-level vocabulary writes a byte that prints
    as the character of that number and all others, in order, as the characters from 256 on."""
    tokenizer, first = _tokenizer(path)
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in prints]
    byte = {chr(b): b for b in prints} | {chr(256 + i): b for i, b in enumerate(others)}
    written = (tokenizer.id_to_token(i) or "" for i in range(first))
    return [bytes(byte[c] for c in token) for token in written] + [b""] * len(MARKS)


def _text(tokens: list[bytes]) -> str:
    return unescape(b"".join(tokens).decode())


class Template:
    """Formats turns, and reads them back from their ids."""

    def __init__(self, path: str = BYTE_BPE):
        self.tokenizer, self.first = _tokenizer(path)
        self.bytes = _token_bytes(path)
        self.mark = {m: self.first + i for i, m in enumerate(MARKS)}

    def format(self, turns: list[tuple[str, str]]) -> list[tuple[np.ndarray, np.ndarray, str]]:
        """Ids, loss mask and written form of each (role, text)."""
        segments = [self._segments(role, text) for role, text in turns]
        plain = [s for parts in segments for s in parts if s not in self.mark]
        encoded = iter(self.tokenizer.encode_batch_fast(plain, add_special_tokens=False))
        out = []
        for (role, _), parts in zip(turns, segments):
            ids: list[int] = []
            for part in parts:
                ids += [self.mark[part]] if part in self.mark else next(encoded).ids
            coded = np.array(ids, np.int32)
            out.append((coded, self._loss(coded), "".join(parts)))
        return out

    def _segments(self, role: str, text: str) -> list[str]:
        if role in ROLES:
            before, after = ROLES[role]
            return [before, escape(text), after]
        return ["<|role|>", escape(role), "<|text|>", escape(text), "<|end|>"]

    def _loss(self, ids: np.ndarray) -> np.ndarray:
        """Ids between the marks of the role that loss counts for, the marks left out."""
        before, after = (ids == self.mark[m] for m in ROLES[LOSS_ROLE])
        return (np.cumsum(before.astype(np.int32) - after) > 0) & ~before

    def read(self, ids: np.ndarray, loss: np.ndarray) -> tuple[str, str, str | None]:
        """Role and text of a turn, and the text under the mask if there is any."""
        tokens = [self.bytes[i] for i in ids.tolist()]
        marks = np.flatnonzero(ids >= self.first).tolist()
        parts = [_text(tokens[a + 1 : b]) for a, b in zip(marks[:-1], marks[1:])]
        under = np.flatnonzero(loss)
        masked = _text([tokens[i] for i in under.tolist()]) if len(under) else None
        for role, (before, _) in ROLES.items():
            if ids[0] == self.mark[before]:
                return role, parts[0], masked
        return parts[0], parts[1], masked


def format_turns(conversations: DataFrame, path: str = BYTE_BPE) -> DataFrame:
    """`conversations` (`conv_id, turn, role, text`) with `ids`, `loss` and `formatted` of each turn.

    A conversation is its turns in order of `turn`, then role and text, nulls first; one after the
    other they are its ids, mask and written form. It is kept in turns because it may be longer than
    any task could hold. A null role or text counts as empty. Rows that repeat are turns of their own,
    turns without a conversation belong to that of null, and an empty table gives an empty result.
    Other columns are left out. There is no shuffle.
    """
    rows = conversations.select("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template = Template(path)
        for piece in pieces(batches):
            roles, texts = (piece.column(c).to_pylist() for c in ("role", "text"))
            turns = template.format([(r or "", t or "") for r, t in zip(roles, texts)])
            ids, loss, written = zip(*turns)
            yield pa.RecordBatch.from_arrays(
                [
                    *piece.columns,
                    _lists(ids, pa.int32()),
                    _lists(loss, pa.bool_()),
                    pa.array(written, pa.string()),
                ],
                [*piece.schema.names, "ids", "loss", "formatted"],
            )

    kinds = ", ".join(f"{name} {kind}" for name, kind in rows.dtypes)
    return rows.mapInArrow(run, f"{kinds}, {TURNS}")


def read_turns(formatted: DataFrame, path: str = BYTE_BPE) -> DataFrame:
    """`conv_id, turn, role, text, loss_text, formatted_chars`, read back from `format_turns`.

    `loss_text` is null for turns without loss, also for an empty text that loss would count for. Rows
    that repeat are read each, null conversations and turns stay null, texts are of any length, and an
    empty table gives an empty result; further columns are not looked at. Ids are read once, through a
    table of the bytes of each token, and there is no shuffle.
    """
    rows = formatted.select("conv_id", "turn", "ids", "loss", "formatted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template = Template(path)
        for piece in pieces(batches, "formatted"):
            both = zip(_arrays(piece.column("ids")), _arrays(piece.column("loss")))
            read = [template.read(ids, loss) for ids, loss in both]
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("conv_id"),
                    piece.column("turn"),
                    *[pa.array(column, pa.string()) for column in zip(*read)],
                    pa.compute.utf8_length(piece.column("formatted")).cast(pa.int64()),
                ],
                ["conv_id", "turn", "role", "text", "loss_text", "formatted_chars"],
            )

    kinds = dict(rows.dtypes)
    return rows.mapInArrow(
        run,
        f"conv_id {kinds['conv_id']}, turn {kinds['turn']}, role string, text string, "
        "loss_text string, formatted_chars bigint",
    )


def digest_conversations(turns: DataFrame) -> DataFrame:
    """One row per conversation of `read_turns`: counts, and hashes over its turns in order.

    A hash over a conversation has to see it in order, so a conversation is one task's work here; it
    streams through in sorted rows, of which no more than a batch is held. All that costs more than
    hashing was done turn by turn before. Turns that tie in `turn` follow by role and text, nulls first, and
    repeated turns count each; those without a conversation are one, named null; an empty table gives an
    empty result.
    """
    kind = dict(turns.dtypes)["conv_id"]
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.mapInArrow(
        _digest,
        f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, "
        "loss_sha256 string, formatted_chars bigint",
    )


class _Digest:
    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.formatted_chars = 0

    def add(self, role: str, text: str, loss: str | None, chars: int) -> None:
        self.n_turns += 1
        self.formatted_chars += chars
        self.turns.update(f"{role}\n{text}\n".encode())
        if loss is not None:
            self.loss_chars += len(loss)
            self.loss.update(loss.encode())

    def row(self) -> tuple:
        return (
            self.conv_id,
            self.n_turns,
            self.turns.hexdigest(),
            self.loss_chars,
            self.loss.hexdigest(),
            self.formatted_chars,
        )


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [None, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    current: _Digest | None = None
    for batch in batches:
        kinds[0] = batch.schema.field("conv_id").type
        done = []
        columns = [batch.column(c).to_pylist() for c in ("role", "text", "loss_text", "formatted_chars")]
        for conv_id, *turn in zip(batch.column("conv_id").to_pylist(), *columns):
            if current is None or current.conv_id != conv_id:
                if current is not None:
                    done.append(current.row())
                current = _Digest(conv_id)
            current.add(*turn)
        if done:
            yield _rows(done, names, kinds)
    if current is not None:
        yield _rows([current.row()], names, kinds)


def _rows(rows: list[tuple], names: list[str], kinds: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)], names
    )


def _lists(arrays, kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(a) for a in arrays]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(arrays), kind))


def _arrays(column: pa.Array) -> Iterator[np.ndarray]:
    """The lists of a column, as slices of one array."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum([0, *(s or 0 for s in pa.compute.list_value_length(column).to_pylist())])
    return (values[a:b] for a, b in zip(ends[:-1], ends[1:]))
