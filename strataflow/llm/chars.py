"""Texts as code points, many at a time, and classes of characters."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

PIECE_CHARS = 1 << 20
CHUNK_DOCS = 512


def chunks(texts, most_chars: int = PIECE_CHARS, most_docs: int = CHUNK_DOCS):
    """Runs of texts (null as empty) with bounded characters in all, as (first index, [text]).

    An Arrow array is turned into strings run by run, so one run is in memory at a time.
    """
    first, held, size = 0, [], 0
    for i, text in enumerate(texts):
        text = text.as_py() if isinstance(text, pa.Scalar) else text
        held.append(text if isinstance(text, str) else "")
        size += len(held[-1])
        if size >= most_chars or len(held) >= most_docs:
            yield first, held
            first, held, size = i + 1, [], 0
    if held:
        yield first, held


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def class_table(test) -> np.ndarray:
    """For every code point whether ``test`` (a str method) holds."""
    table = np.zeros(0x110000, dtype=bool)
    for block in range(0, 0x110000, 0x1000):
        if 0xD000 <= block < 0xF900 or 0x40000 <= block < 0xE0000 or block >= 0xF0000:
            span = range(block, min(block + 0x1000, 0xD800)) if block == 0xD000 else ()
        else:
            span = range(block, block + 0x1000)
        for c in span:
            table[c] = test(chr(c))
    return table


_TABLES: dict[str, np.ndarray] = {}


def is_class(points: np.ndarray, name: str) -> np.ndarray:
    """Whether each code point is of a class: the name of a str method such as ``isalpha``."""
    if name not in _TABLES:
        _TABLES[name] = class_table(getattr(str, name))
    return _TABLES[name][points]
