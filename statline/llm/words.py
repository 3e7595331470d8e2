"""Words of Arrow text columns as dictionary codes, so that Python works once on each distinct word of a slice."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def split_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Split at ASCII white space: ``[^\\x20\\x09-\\x0D]+`` are the words.

    Returns (offsets, codes, dictionary): text ``i`` has the words
    ``dictionary[codes[offsets[i]:offsets[i + 1]]]``. Empty texts have none.
    """
    lists = pc.ascii_split_whitespace(texts)
    flat = lists.flatten()
    offsets = lists.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    full = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    if not full.all():
        offsets = np.concatenate(([0], np.cumsum(full)))[offsets]
        flat = flat.filter(pa.array(full))
    coded = flat.dictionary_encode()
    return offsets, coded.indices.to_numpy(zero_copy_only=False), coded.dictionary


def per_text_sum(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``values`` (rows by word) between offsets; texts without words get 0."""
    total = np.zeros((len(values) + 1, *values.shape[1:]), dtype=np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, axis=0, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]
