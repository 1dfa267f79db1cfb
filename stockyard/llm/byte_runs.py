"""Words of whole texts as runs of bytes, in numpy: no Python object per word."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from stockyard.llm.common import binary_parts

#: Bytes as they are, with A-Z lower-cased.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class Runs:
    """Maximal runs of bytes of one kind within each text: ``kind`` maps bytes to kinds, 0 being
    none. Arrays by run: row, kind, cut (how many bytes of kind ``cut`` come before it in the
    slice), word (index into ``words``, the distinct runs as bytes)."""

    def __init__(self, texts: pa.Array, kind: np.ndarray, words: tuple[int, ...], cut: int | None = None):
        off, raw = binary_parts(pc.fill_null(texts, ""))
        raw = LOWER[raw]
        kinds = kind[raw]
        first = np.empty(len(raw), bool)
        first[:1] = True
        np.not_equal(kinds[1:], kinds[:-1], out=first[1:])
        first[off[:-1][off[:-1] < len(raw)]] = True
        starts = np.flatnonzero(first)
        ends = np.r_[starts[1:], len(raw)][: len(starts)]
        kept = np.isin(kinds[starts], words)
        if cut is not None:
            self.cut = np.cumsum(kinds[starts] == cut)[kept]
        starts, ends = starts[kept], ends[kept]
        self.kind = kinds[starts]
        self.row = np.searchsorted(off[1:], starts, side="right")
        self.length = ends - starts
        data = raw[np.isin(kinds, words)] if len(raw) else raw
        offsets = np.r_[0, np.cumsum(self.length)].astype(np.int64)
        values = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        coded = values.dictionary_encode()
        self.word = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.words = coded.dictionary.to_pylist()
