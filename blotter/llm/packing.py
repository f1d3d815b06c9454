"""Harmonic packing of tokenized documents into fixed-capacity sequences.

A piece of length L belongs to class i = capacity // L, and a bin of class i
takes exactly i pieces, so a worker fills the bins of each class on its own,
in one pass, without looking at other pieces.  A document is cut into full
sequences and a remainder; a remainder whose class would leave more than
``max_waste`` of each bin empty is cut to the largest length of the next class,
and so is the rest.  What a worker's open bins hold at the end is dealt by class
(in groups of workers, as often as needed) and filled by the same rule; the
last open bin of each class, a number of pieces that only the capacity bounds,
is packed first-fit by decreasing length.
"""

from __future__ import annotations

import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.llm.common import Scratch
from blotter.llm.word_cache import WordCache
from blotter.llm.word_table import LastBlock, Ragged, blocks, joined, words_of

END = (1).to_bytes(4, "little")              # id 1 ends every document
# White space as Unicode has it (fixed values).
_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_CHUNK = re.compile(f"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+")
_UNEVEN = f"^$|^[ \n]|[ \n]$|[ \n][ \n]|[\t\x0b-\r\x1c-\x1f{_SPACE.lstrip(chr(9) + '-' + chr(13) + ' ')}]"
_LETTERS, _SIGNS = "A-Za-zÀ-ÖØ-öø-ɏ", r"!-&(-/:-@\[-`{-~"                # of words that are two pre-tokens
_LONG = 1 << 26                              # longer texts are cut into words by Python
_LINES = 1 << 15                             # words the tokenizer encodes at once
_GROUP = 512                                 # workers whose open bins meet in one task
_SHUT = 64                                   # shorter remainders are never cut


class ByteBpe:
    """Whole-text ids of a byte-level BPE file, by cached words.

    Its pre-tokenizer never joins white space to the character before it, and
    only a space to the character after it, so a text may be cut before each
    run of white space.  The distinct words of a block of texts are encoded
    together, one a line; those of plain letters and signs go to the model in
    its own byte alphabet, which spares them the pre-tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True            # their strings in a text are ordinary text
        self.tok.no_truncation()
        self.tok.no_padding()
        (self.line,) = np.frombuffer(self._raw(["\n"])[0], "<u4")
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        # the byte alphabet, read off the pre-tokenizer: bytes below 128 as characters, the others after a prefix
        self.alphabet = {b: level.pre_tokenize_str(chr(b))[0][0] for b in range(128)}
        for b in range(128, 192):
            self.alphabet[b] = level.pre_tokenize_str(bytes([0xC4, b]).decode())[0][0][1]
        for b in range(0xC3, 0xCA):
            self.alphabet[b] = level.pre_tokenize_str(bytes([b, 0x80]).decode())[0][0][0]
        self.direct = Tokenizer(self.tok.model)
        self.direct.pre_tokenizer = pre_tokenizers.Split(self.alphabet[10], "isolated")
        self.plain = LastBlock(lambda words: self._apart(words, True))      # key: the letters, with a space in front
        self.mixed = LastBlock(lambda words: self._apart(words, False))     # key: the word, with a space in front
        self.other = WordCache(self._raw)                # key: the word with all white space before it

    def _raw(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes()
                for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _apart(self, words: list[str], plain: bool) -> Ragged:
        """Ids of words that hold no white space but one space in front."""
        out = [Ragged.of([])]
        for lo in range(0, len(words), _LINES):
            text = "\n".join(words[lo:lo + _LINES])
            if plain:
                tok, text = self.direct, text.encode().decode("latin-1").translate(self.alphabet)
            else:
                tok = self.tok
            ids = np.array(tok.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            ends = np.append(np.flatnonzero(ids == self.line), len(ids))
            out.append(Ragged(ids[ids != self.line], np.diff(ends, prepend=-1) - 1))
        return Ragged.concat(out)

    def _words(self, words: pa.Array) -> Ragged:
        """Ids of distinct words, each with its newline if it starts a line: line, letters, signs or the whole word."""
        starts = pc.starts_with(words, "\n")
        bare = pc.utf8_ltrim(words, "\n")
        simple = pc.match_substring_regex(bare, f"^[{_LETTERS}]+[{_SIGNS}]*$")
        signs = pc.if_else(simple, pc.replace_substring_regex(bare, f"^[{_LETTERS}]+", ""), "").dictionary_encode()
        core = pc.if_else(simple, pc.replace_substring_regex(bare, f"[{_SIGNS}]+$", ""), bare)
        key = pc.binary_join_element_wise(pc.if_else(starts, "", " "), core, "")
        plain, mixed = key.filter(simple).dictionary_encode(), key.filter(pc.invert(simple))
        parts = [Ragged.of([b"", np.array([self.line], "<u4").tobytes()]), Ragged.of(self._raw(signs.dictionary.to_pylist())),
                 self.plain.of(plain.dictionary), self.mixed.of(mixed)]
        first = np.cumsum([0] + [len(p.sizes) for p in parts])
        at = np.empty((len(words), 3), np.int64)
        is_simple = simple.to_numpy(zero_copy_only=False)
        at[:, 0] = starts.to_numpy(zero_copy_only=False)
        at[is_simple, 1] = first[2] + plain.indices.to_numpy()
        at[~is_simple, 1] = first[3] + np.arange(len(mixed))
        at[:, 2] = first[1] + signs.indices.to_numpy()
        got = Ragged.concat(parts).take(at.ravel())
        return Ragged(got.values, got.sizes.reshape(-1, 3).sum(axis=1))

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        if isinstance(texts, list):
            texts = pa.array(texts, pa.string())
        # single spaces and newlines between words, nothing else
        even = pc.and_(pc.invert(pc.match_substring_regex(texts, _UNEVEN)), pc.less(pc.binary_length(texts), _LONG))
        # a text's first word has no space in front, like one that starts a line; its newline's id is cut off again
        codes, sizes, words = words_of(texts.filter(even), first="\n")
        even = even.to_pylist()
        other = [_CHUNK.findall(t) for t in texts.filter(pa.array([not e for e in even], pa.bool_())).to_pylist()]
        self.other.need(set().union(*other))
        plain = joined(self._words(words), codes, sizes)
        rest = iter(other)
        return [next(plain)[4:] if e else self.other.join(next(rest)) for e in even]


@lru_cache(maxsize=2)
def byte_bpe(path: str) -> ByteBpe:
    """One encoder a Python worker; its cache lives as long as the worker."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"       # Spark's tasks are the parallelism
    return ByteBpe(path)


def cuts(n: int, capacity: int, max_waste: float) -> list[int]:
    """Lengths that a document of n tokens is cut into, in order."""
    out = [capacity] * (n // capacity)
    rest = n % capacity
    while rest:
        i = capacity // rest
        if rest < _SHUT or capacity - i * rest <= max_waste * capacity:
            out.append(rest)
            break
        out.append(capacity // (i + 1))
        rest -= out[-1]
    return out


class Bins:
    """Open bins, one a class: ``add`` returns the pieces of a bin that became full."""

    def __init__(self, capacity: int, first_id: int):
        self.capacity, self.next_id, self.open = capacity, first_id, {}

    def add(self, piece: tuple, length: int) -> list[tuple]:
        i = self.capacity // length
        bin_ = self.open.setdefault(i, [])
        bin_.append((piece, length))
        return self.close(self.open.pop(i)) if len(bin_) == i else []

    def close(self, bin_: list) -> list[tuple]:
        out, offset = [], 0
        for piece, length in bin_:
            out.append((*piece, self.next_id, offset))
            offset += length
        self.next_id += 1
        return out


_FIELDS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "sequence_id", "offset"]
_TYPES = ", ".join(f"{f} long" for f in _FIELDS)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [()] * len(_FIELDS)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=_FIELDS)


def _fill(path: str, capacity: int, max_waste: float):
    def run(batches):
        bpe, part = byte_bpe(path), TaskContext.get().partitionId()
        bins = Bins(capacity, part << 32)
        for batch in batches:
            for lo, rows in blocks(batch.column(1)):
                some = batch.slice(lo, rows)
                out = []
                for doc, ids in zip(some.column(0).to_pylist(), bpe.encode(some.column(1).fill_null(""))):
                    ids, start = ids + END, 0
                    total = len(ids) // 4
                    for length in cuts(total, capacity, max_waste):
                        crc = zlib.crc32(ids[4 * start:4 * (start + length)])
                        out += bins.add((doc, start, length, crc, total, part), length)
                        start += length
                yield _rows(out)
        yield _rows(_open(bins))

    return run


def _refill(capacity: int, level: int):
    """Rows sorted by (class, group): fill bins by class; what stays open leaves without a sequence."""
    def run(batches):
        at, bins = None, None
        for batch in batches:
            out = []
            for cls, group, *piece in zip(*(c.to_pylist() for c in batch.columns)):
                if at != (cls, group):
                    out += _open(bins)
                    at, bins = (cls, group), Bins(capacity, level << 56 | cls << 44 | group << 20)
                out += bins.add((*piece, group), piece[2])
            yield _rows(out)
        yield _rows(_open(bins))

    return run


def _open(bins: Bins | None) -> list[tuple]:
    return [(*p, None, None) for b in (bins.open.values() if bins else ()) for p, _ in b]


def _finish(capacity: int, level: int):
    """The last open bin of each class, packed together first-fit by decreasing length."""
    def run(batches):
        pieces = [row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns))]
        fit, shut = [], Bins(capacity, level << 56)
        for p in sorted(pieces, key=lambda p: (-p[2], str(p))):
            home = next((b for b in fit if b[0] + p[2] <= capacity), None)
            if home is None:
                fit.append(home := [0, []])
            home[0] += p[2]
            home[1].append(((*p, 0), p[2]))
        yield _rows([r for _, b in fit for r in shut.close(b)])

    return run


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, max_waste: float = 0.02,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Null text counts as empty; an empty document has its end id only, so it
    is one piece of length 1.  Repeated rows are packed as often as they
    occur, and a null id stays null.  An empty table gives no rows; other
    columns are not read.
    """
    scratch = Scratch(docs.sparkSession, "packing")
    placed = scratch.stage(docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
                           .mapInArrow(_fill(tokenizer_path, capacity, max_waste), _TYPES), "level-0")
    done = placed.filter("sequence_id is not null")
    groups, level = (placed.agg(F.max("part")).first()[0] or 0) + 1, 0
    while True:
        level, groups = level + 1, -(-groups // _GROUP)
        left = (placed.filter("sequence_id is null")
                .select(F.expr(f"{capacity} div length").alias("cls"),
                        F.expr(f"part div {_GROUP}").alias("grp"), *_FIELDS[:5]))
        placed = scratch.stage(left.repartition("cls", "grp").sortWithinPartitions("cls", "grp", "doc_id", "start")
                               .mapInArrow(_refill(capacity, level), _TYPES), f"level-{level}")
        done = done.union(placed.filter("sequence_id is not null"))
        if groups == 1:                      # fewer than i open pieces of each class i are left
            last = placed.filter("sequence_id is null").select(*_FIELDS[:5]).coalesce(1)
            return done.union(last.mapInArrow(_finish(capacity, level + 1), _TYPES)).drop("part")


def _cut_ids(path: str):
    def run(batches):
        bpe = byte_bpe(path)
        for batch in batches:
            out = []
            for lo, rows in blocks(batch.column(0)):
                some = batch.slice(lo, rows)
                for ids, pieces in zip(bpe.encode(some.column(0).fill_null("")), some.column(1).to_pylist()):
                    ids += END
                    out += [(p["sequence_id"], p["offset"], ids[4 * p["start"]:4 * (p["start"] + p["length"])])
                            for p in pieces]
            s, o, b = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(s, pa.int64()), pa.array(o, pa.int64()),
                                              pa.array(b, pa.binary())], names=["sequence_id", "offset", "ids"])

    return run


def sequences(docs: DataFrame, pieces: DataFrame, tokenizer_path: str, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """The packed sequences themselves: sequence_id, ids (unsigned 32-bit, little-endian binary).

    Needs unique ids in ``docs``.  Padding is left to the reader, who knows its pad id.
    """
    of = pieces.groupBy("doc_id").agg(
        F.collect_list(F.struct("start", "length", "sequence_id", "offset")).alias("pieces"))
    cut = (docs.join(of, docs[id_col].cast("long") == of.doc_id).select(text_col, "pieces")
           .mapInArrow(_cut_ids(tokenizer_path), "sequence_id long, offset long, ids binary"))
    return (cut.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("p"))
            .select("sequence_id", F.expr("aggregate(p, cast('' as binary), (a, x) -> concat(a, x.ids))").alias("ids")))
