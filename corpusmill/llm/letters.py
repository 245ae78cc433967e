"""Code points of a whole Arrow string column at once."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa

from corpusmill.llm.wordcodes import text_bytes


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Lower-case letter of each code point, 0 where it is no letter."""
    out = np.zeros(0x110000, dtype=np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            out[i] = ord(low) if len(low) == 1 else i
    return out


def code_points(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts and where each text begins. Null texts are empty."""
    raw, at = text_bytes(column)
    points = np.frombuffer(raw.tobytes().decode("utf-8", "replace").encode("utf-32-le", "surrogatepass"), np.uint32)
    begins = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    return points, begins[at]


def lower_letters(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The same with letters in lower case and everything else as 0."""
    points, at = code_points(column)
    return _letters()[points], at
