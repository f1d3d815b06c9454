import random
import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from blotter.llm.packing import ByteBpe, cuts, pack, sequences

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string"
TOK = Tokenizer.from_file(PATH)
TOK.encode_special_tokens = True


def ids_of(text):
    return TOK.encode(text or "", add_special_tokens=False).ids + [1]


def check(rows, pieces, capacity=2048):
    whole, taken, seqs = {}, {}, {}
    for d, t in rows:
        whole[d] = ids_of(t)
    for p in pieces:
        assert p.doc_tokens == len(whole[p.doc_id])
        part = np.array(whole[p.doc_id][p.start:p.start + p.length], "<u4")
        assert len(part) == p.length > 0 and zlib.crc32(part.tobytes()) == p.ids_crc32
        taken.setdefault(p.doc_id, []).append((p.start, p.length))
        seqs.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for d, ids in whole.items():
        at = 0
        for start, length in sorted(taken[d]):
            assert start == at
            at += length
        assert at == len(ids)
    for parts in seqs.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return sum(map(len, whole.values())) / (len(seqs) * capacity)


def test_pack_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    pieces = pack(docs.repartition(4), PATH)
    assert check(rows, pieces.collect()) > 0.97
    whole = {}
    for r in sequences(docs, pieces, PATH).collect():
        whole[r.sequence_id] = np.frombuffer(r.ids, "<u4")
    for p in pieces.collect():
        assert zlib.crc32(whole[p.sequence_id][p.offset:p.offset + p.length].tobytes()) == p.ids_crc32


def test_edges(spark):
    rng = random.Random(2)
    rows = [(0, None), (1, ""), (2, "a" * 50_000), (3, " " * 9000), (4, "<|endoftext|> x"), (5, "é\n\n b  c \t d ")]
    rows += [(10 + i, " ".join("ab" for _ in range(rng.randint(0, 5000)))) for i in range(40)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA + ", length int, part int").repartition(3)
    check(rows, pack(df, PATH).collect())
    check(rows, pack(df, PATH, capacity=64).collect(), 64)
    assert pack(spark.createDataFrame([], SCHEMA), PATH).count() == 0


def test_cuts_cover_and_fit():
    for n in range(1, 9000, 7):
        parts = cuts(n, 2048, 0.02)
        assert sum(parts) == n and max(parts) <= 2048


BPE = ByteBpe(PATH)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=" \n\t\r  ab1.'sé😀<|>", max_size=40))
def test_ids_equal_the_library(text):
    assert BPE.encode([text])[0] == np.array(TOK.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(max_size=12), max_size=6))
def test_ids_of_any_words_equal_the_library(words):
    text = " ".join(words)
    assert BPE.encode([text])[0] == np.array(TOK.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_byte_alphabet_of_latin_letters():
    text = " ".join(chr(c) + chr(c) for c in range(33, 0x250))
    assert BPE.encode([text])[0] == np.array(TOK.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
