"""Arrow batches of rows with a text, taken apart into pieces of bounded size."""

from collections.abc import Iterator

import pyarrow as pa

PIECE_ROWS = 2048
PIECE_BYTES = 8 << 20


def pieces(
    batches: Iterator[pa.RecordBatch], column: str = "text", most_bytes: int = PIECE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The same rows in order, `PIECE_ROWS` at most and, but for single texts, `most_bytes` at most.

    What Arrow has freed goes back to the machine before each piece. Its pool would keep that, and a
    worker, which stays when its task is done, would go on holding the most it ever took.
    """
    for piece in _cut(batches, column, most_bytes):
        pa.default_memory_pool().release_unused()
        yield piece


def _cut(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = pa.compute.binary_length(batch.column(column)).to_pylist()
        start = total = 0
        for i, size in enumerate(sizes):
            size = size or 0
            if i > start and (total + size > most_bytes or i - start >= PIECE_ROWS):
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += size
        if len(sizes) > start:
            yield batch.slice(start)


def texts(piece: pa.RecordBatch, column: str = "text") -> list[str]:
    return [t or "" for t in piece.column(column).to_pylist()]


class Memo(dict):
    """Results of a function by argument, emptied when there are too many of them."""

    def __init__(self, function, most: int = 500_000):
        super().__init__()
        self.function, self.most = function, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        value = self[key] = self.function(key)
        return value
