"""Arrow batches in slices, so that what Python makes of one fits into memory."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa

ROWS = 1000


def sliced(batches: Iterable[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def word_blocks(data: bytes, most: int = 1 << 22) -> Iterator[list[bytes]]:
    """The space-separated words of ``data`` in parts of about ``most`` bytes, in order."""
    start = 0
    while start < len(data):
        end = data.find(b" ", start + most) if len(data) - start > most else -1
        end = len(data) if end < 0 else end
        yield data[start:end].split()
        start = end
