"""Distinct words of a block of texts, found by Arrow, and ragged values gathered by word number."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 4 << 20                              # bytes of text whose words are looked up together


class Ragged:
    """Unsigned 32-bit ids of many items, end to end."""

    def __init__(self, values: np.ndarray, sizes: np.ndarray):
        self.values, self.sizes = values, sizes
        self.starts = np.cumsum(sizes) - sizes

    @classmethod
    def of(cls, items: list[bytes]) -> Ragged:
        return cls(np.frombuffer(b"".join(items), "<u4"), np.array([len(i) // 4 for i in items], np.int64))

    @classmethod
    def concat(cls, parts: Iterable[Ragged]) -> Ragged:
        parts = list(parts)
        return cls(np.concatenate([p.values for p in parts]), np.concatenate([p.sizes for p in parts]))

    def take(self, at: np.ndarray) -> Ragged:
        sizes = self.sizes[at]
        ends = np.cumsum(sizes)
        shift = np.repeat(self.starts[at] - (ends - sizes), sizes)
        return Ragged(self.values[shift + np.arange(len(shift))], sizes)


class LastBlock:
    """Values of distinct words; those that the block before had too are looked up, only the others computed."""

    def __init__(self, values_of: Callable[[list[str]], Ragged]):
        self.values_of, self.words, self.values = values_of, pa.array([], pa.string()), Ragged.of([])

    def of(self, words: pa.Array) -> Ragged:
        at = pc.index_in(words, value_set=self.words)
        new = at.is_null()
        both = Ragged.concat([self.values, self.values_of(words.filter(new).to_pylist())])
        new = new.to_numpy(zero_copy_only=False)
        self.values = both.take(np.where(new, len(self.words) + np.cumsum(new) - 1, at.fill_null(0).to_numpy()))
        self.words = words
        return self.values


def blocks(texts: pa.Array, max_bytes: int = BLOCK) -> Iterator[tuple[int, int]]:
    """(first row, number of rows) of runs of rows with at most ``max_bytes`` of text, or one row."""
    total = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy().astype(np.int64))
    lo = 0
    while lo < len(total):
        before = total[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(total, before + max_bytes, "right")))
        yield lo, hi - lo
        lo = hi


def words_of(texts: pa.Array, first: str = "") -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Word numbers, words of each text, distinct words: texts cut at each space and before each newline.

    ``first`` goes in front of each text's first word.
    """
    lists = pc.split_pattern(pc.binary_join_element_wise(first, pc.replace_substring(texts, "\n", " \n"), ""), " ")
    words = lists.flatten().dictionary_encode()
    return words.indices.to_numpy(), np.diff(lists.offsets.to_numpy()).astype(np.int64), words.dictionary


def joined(values: Ragged, codes: np.ndarray, words: np.ndarray, texts: int = 256) -> Iterator[bytes]:
    """The values of each text's words, end to end; a few texts are gathered at a time."""
    ends = np.concatenate([[0], np.cumsum(words)])
    for lo in range(0, len(words), texts):
        at = ends[lo:lo + texts + 1]
        got = values.take(codes[at[0]:at[-1]])
        cut = (np.concatenate([[0], np.cumsum(got.sizes)])[at - at[0]] * 4).tolist()
        raw = got.values.tobytes()
        yield from (raw[a:b] for a, b in zip(cut, cut[1:]))
