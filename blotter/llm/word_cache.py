"""Token ids of repeated words, kept per Python worker and bounded."""

from __future__ import annotations

from collections.abc import Callable, Iterable

_ENTRY = 200                                 # bytes a dictionary entry takes besides its text


class WordCache(dict):
    """word -> ids as little-endian 32-bit bytes; emptied when it exceeds ``max_bytes``.

    ``encode`` maps a list of distinct words to their ids.  A cached value
    never changes, so emptying only costs time.
    """

    def __init__(self, encode: Callable[[list[str]], Iterable[bytes]], max_bytes: int = 160 << 20):
        super().__init__()
        self._encode, self._max, self._held = encode, max_bytes, 0

    def need(self, words: set[str]) -> None:
        """Make every word of the set present."""
        new = [w for w in words if w not in self]
        if self._held > self._max:
            self.clear()
            self._held, new = 0, list(words)
        for w, ids in zip(new, self._encode(new) if new else ()):
            self[w] = ids
            self._held += _ENTRY + len(w) + len(ids)

    def join(self, words: Iterable[str]) -> bytes:
        return b"".join(map(self.__getitem__, words))
