"""SentencePiece encoding and decoding with shared-prefix Viterbi.

A text becomes marked words: spaces turn into the mark, one more mark goes in
front, and a word is a run of marks with what follows it.  No piece of the
model holds a mark after another character, so words are encoded on their own.

The distinct words of a block are sorted, which is the depth-first order of
their trie: the forward states of the common prefix with the word before are
reused, and only the new part is computed.  The pieces that may end at a
character are read off an automaton of all pieces, made as far as words need it.  The forward state of a prefix is
its best segmentation.  The model ranks merges, so a segmentation is admissible
exactly when every adjacent pair of pieces is left alone by the merges; the
forward score of an admissible path is 0, of any other minus infinity, and one
path survives at every prefix.  Its state is the last piece; the path is read
back from the last state.  A word that starts with several marks has merges of
equal rank; the merges themselves encode it.
"""

from __future__ import annotations

import heapq
import math
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.llm.common import few_rows
from blotter.llm.word_cache import WordCache
from blotter.llm.word_table import LastBlock, Ragged, blocks, joined, words_of

MARK = "▁"
_WORD = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
NEVER = math.inf                              # the rank of a pair that is no piece
_PAIRS = 1_000_000                            # remembered pairs of pieces, and steps of the automaton
_LONG = 1 << 26                               # longer texts are cut into words by Python


class Codec:
    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.vocab_size()
        self.rank, self.raw, self.bytes_of, self.byte_id = {}, {}, [], {}
        for i in range(size):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_id[int(piece[3:5], 16)] = i
                self.bytes_of.append(bytes([int(piece[3:5], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.bytes_of.append(" ⁇ ".encode() if sp.is_unknown(i) else b"")
            else:
                self.rank[piece] = -sp.get_score(i)
                self.raw[piece] = i.to_bytes(4, "little")
                self.bytes_of.append(piece.replace(MARK, " ").encode())
        self.unknown = sp.unk_id()
        self.heads = {p[:k] for p in self.rank for k in range(1, len(p) + 1)}  # starts of pieces
        self._forget()
        if any(MARK in p.lstrip(MARK) for p in self.rank):
            raise ValueError("a piece holds a mark inside: words cannot be encoded on their own")
        # no piece holds a newline, so the merges never cross one
        self.line = None if any("\n" in p for p in self.rank) else self._fallback("\n")
        self._alone: dict = {}
        self.pieces = pa.array(self.bytes_of, pa.large_binary())
        self.words = LastBlock(self._plain)           # key: the word without its mark
        cut = f"^$|^ | $|  | \n|{MARK}"               # texts that spaces do not cut into words with one mark each
        self.uneven = cut if self.line is not None else cut + "|\n"
        self.marked = WordCache(self.encode_words)    # key: the word as marked

    # -- one word ---------------------------------------------------------------------------------
    def merge(self, word: str) -> list[str]:
        """The pieces that the ranked merges leave (best rank first, leftmost first)."""
        if len(word) > 64:
            return self._merge_long(word)
        piece, rank = list(word), self.rank.get
        pairs = [rank(a + b, NEVER) for a, b in zip(piece, piece[1:])]
        while pairs:
            best = min(pairs)
            if best is NEVER:
                break
            i = pairs.index(best)
            piece[i:i + 2] = [piece[i] + piece[i + 1]]
            del pairs[i]
            if i:
                pairs[i - 1] = rank(piece[i - 1] + piece[i], NEVER)
            if i < len(pairs):
                pairs[i] = rank(piece[i] + piece[i + 1], NEVER)
        return piece

    def _merge_long(self, word: str) -> list[str]:
        """The same with a heap over linked pieces, for words of any length."""
        piece, left, right = list(word), list(range(-1, len(word) - 1)), list(range(1, len(word) + 1))
        heap = []

        def push(i: int) -> None:
            j = right[i]
            if j < len(piece) and (r := self.rank.get(piece[i] + piece[j])) is not None:
                heapq.heappush(heap, (r, i, j, piece[i], piece[j]))

        for i in range(len(word) - 1):
            push(i)
        while heap:
            _, i, j, a, b = heapq.heappop(heap)
            if piece[i] != a or right[i] != j or piece[j] != b:
                continue
            piece[i], piece[j], right[i] = a + b, None, right[j]
            if right[j] < len(piece):
                left[right[j]] = i
            if left[i] >= 0:
                push(left[i])
            push(i)
        return [p for p in piece if p is not None]

    def _admissible(self, pair: tuple[str | None, str]) -> bool:
        """Whether the merges leave the two pieces (or the one at the start) as they are; remembered."""
        if len(self._alone) >= _PAIRS:
            self._alone.clear()
        want = [p for p in pair if p is not None]
        found = self._alone[pair] = self.merge("".join(want)) == want
        return found

    def _forget(self) -> None:
        """Start the automaton anew.  A node: nodes by the next character, 0: the end of the text read, 1: pieces there."""
        self.nodes, self.steps = {"": {0: "", 1: ()}}, 0

    def _step(self, node: dict, char: str) -> dict:
        """The node after a character: the longest end of the text read that starts a piece; pieces longest first."""
        if self.steps >= _PAIRS:
            self._forget()
        self.steps += 1
        end = node[0] + char
        while end and end not in self.heads:
            end = end[1:]
        if end not in self.nodes:
            self.nodes[end] = {0: end, 1: tuple((end[i:], len(end) - i) for i in range(len(end)) if end[i:] in self.rank)}
        node[char] = self.nodes[end]
        return node[char]

    def _ids(self, pieces: list[str]) -> bytes:
        return b"".join([self.raw.get(p) or self._fallback(p) for p in pieces])

    def _fallback(self, piece: str) -> bytes:
        """A character outside the model: its bytes, or the unknown id in a model without byte pieces."""
        ids = [self.byte_id[b] for b in piece.encode()] if self.byte_id else [self.unknown]
        return np.array(ids, "<i4").tobytes()

    # -- many words -------------------------------------------------------------------------------
    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of distinct marked words, in their order; states are shared along common prefixes."""
        out, last, before = {}, [None], ""           # last[i]: the last piece of word[:i]
        nodes, known = [self.nodes[""]], self._alone.get
        for word in sorted(words):
            if word.startswith(MARK * 2) or len(word) > 1 << 12:
                out[word] = self._ids(self.merge(word))
                continue
            k, top = 0, min(len(word), len(before))
            while k < top and word[k] == before[k]:
                k += 1
            del last[k + 1:], nodes[k + 1:]
            node, end = nodes[k], k
            for char in word[k:]:
                node, end = node.get(char) or self._step(node, char), end + 1
                nodes.append(node)
                for piece, size in node[1]:
                    pair = last[end - size], piece
                    alone = known(pair)
                    if alone or alone is None and self._admissible(pair):
                        last.append(piece)
                        break
                else:                                 # a character outside the model
                    last.append(char)
            before = word
            path, at = [], len(word)
            while at:
                path.append(last[at])
                at -= len(last[at])
            out[word] = self._ids(path[::-1])
        return [out[w] for w in words]

    def _plain(self, words: list[str]) -> Ragged:
        """Words as they stand between spaces; one that starts a line has its newline in front, and no mark."""
        ids = self.encode_words([MARK + w if w[:1] != "\n" else w[1:] for w in words])
        return Ragged.of([self.line + i if w[:1] == "\n" else i for w, i in zip(words, ids)])

    # -- texts ------------------------------------------------------------------------------------
    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        if isinstance(texts, list):
            texts = pa.array(texts, pa.string())
        simple = pc.and_(pc.invert(pc.match_substring_regex(texts, self.uneven)), pc.less(pc.binary_length(texts), _LONG))
        codes, sizes, words = words_of(texts.filter(simple))
        plain = joined(self.words.of(words), codes, sizes)
        simple = simple.to_pylist()
        other = [_WORD.findall(MARK + t.replace(" ", MARK)) if t else []
                 for t in texts.filter(pa.array([not s for s in simple], pa.bool_())).to_pylist()]
        self.marked.need(set().union(*other))
        rest = iter(other)
        return [next(plain) if s else self.marked.join(next(rest)) for s in simple]

    def decode(self, ids) -> str:
        return self._text(b"".join(map(self.bytes_of.__getitem__, ids)))

    def _text(self, raw: bytes) -> str:
        return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace")

    def decode_lists(self, ids: pa.ListArray) -> list[str | None]:
        """:meth:`decode` of each list; a null list gives None."""
        flat = ids.flatten()
        if flat.null_count:
            raise ValueError("a list of ids holds a null")
        got = self.pieces.take(flat)
        raw, at = got.buffers()[2], np.frombuffer(got.buffers()[1], np.int64)
        sizes = pc.list_value_length(ids).fill_null(0).to_numpy()
        cut = at[np.concatenate([[0], np.cumsum(sizes)])].tolist()
        raw = raw.to_pybytes() if raw is not None else b""
        return [self._text(raw[a:b]) if ok else None for a, b, ok in zip(cut, cut[1:], ids.is_valid().to_pylist())]


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One codec a Python worker; its bounded caches live as long as the worker."""
    return Codec(path)


def _encode(path: str):
    def run(batches):
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            for lo, rows in blocks(texts):
                some = texts.slice(lo, rows)
                ids = codec(path).encode(some.fill_null(""))
                for first in range(0, rows, 256):
                    part = ids[first:first + 256]
                    ends = np.cumsum([0] + [len(i) // 4 for i in part]).astype(np.int32)
                    lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(part), "<i4")))
                    none = some.slice(first, len(part)).is_null()
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(lo + first, len(part)), pc.if_else(none, pa.scalar(None, lists.type), lists)],
                        names=["id", "ids"])

    return run


def _decode(path: str):
    def run(batches):
        for some in few_rows(batches):
            texts = codec(path).decode_lists(some.column(1))
            yield pa.RecordBatch.from_arrays([*some.columns, pa.array(texts, pa.string())], names=["id", "ids", "text"])

    return run


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids) for every row: the ids of :class:`sentencepiece.SentencePieceProcessor` on the whole text.

    Null text gives null ids, empty text an empty list; repeated rows and null
    ids are kept as they are; an empty table gives no rows.  Words of any
    length are encoded; other columns are not read.
    """
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string")).mapInArrow(
        _encode(model_path), f"id {docs.schema[id_col].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, model_path: str, id_col: str = "id", ids_col: str = "ids") -> DataFrame:
    """(id, ids, text) for every row; a null list gives null text.  Ids outside the model are an error.

    The mark itself in a text comes back as a space, as the library gives it.
    """
    return encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids")).mapInArrow(
        _decode(model_path), f"id {encoded.schema[id_col].dataType.simpleString()}, ids array<int>, text string")
