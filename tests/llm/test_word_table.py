import numpy as np
import public_tokenizers
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from blotter.llm.packing import ByteBpe
from blotter.llm.word_table import LastBlock, Ragged, blocks, joined, words_of

PATH = public_tokenizers.path("byte_bpe_50k.json")
BPE, TOK = ByteBpe(PATH), Tokenizer.from_file(PATH)
TOK.encode_special_tokens = True


def test_blocks_are_bounded_and_hold_every_row():
    texts = pa.array(["a" * 40, None, "b" * 70, "", "c" * 300, "d" * 10, "e" * 90])
    got = list(blocks(texts, 100))
    assert [r for lo, n in got for r in range(lo, lo + n)] == list(range(7))
    assert got == [(0, 2), (2, 2), (4, 1), (5, 2)]
    assert list(blocks(texts.slice(0, 0), 100)) == []


def test_words_go_back_to_their_texts():
    texts = pa.array(["a b\na", "b", "c a", ""])
    codes, sizes, words = words_of(texts, first="\n")
    values = Ragged.of([(w + "|").encode().ljust(8, b".") for w in words.to_pylist()])
    assert sorted(words.to_pylist()) == sorted(["\na", "b", "\nb", "\nc", "a", "\n"])
    assert list(joined(values, codes, sizes, texts=3)) == [
        b"\na|.....b|......\na|.....", b"\nb|.....", b"\nc|.....a|......", b"\n|......"]


def test_a_word_of_the_block_before_is_not_computed_again():
    asked = []

    def values_of(words):
        asked.append(list(words))
        return Ragged.of([bytes([len(w)]) * 4 * len(w) for w in words])

    table = LastBlock(values_of)
    for words, new in ([["a", "bb"], ["a", "bb"]], [["bb", "ccc", ""], ["ccc", ""]], [[], []], [["bb"], ["bb"]]):
        got = table.of(pa.array(words, pa.string()))
        assert asked[-1] == new and got.sizes.tolist() == [len(w) for w in words]
        assert got.values.tobytes() == b"".join(bytes([len(w)]) * 4 * len(w) for w in words)


def test_letters_are_encoded_once_whatever_signs_follow(monkeypatch):
    asked, apart = [], BPE._apart
    monkeypatch.setattr(BPE, "_apart", lambda words, plain: asked.extend(words) or apart(words, plain))
    texts = [f"A thing{s} thing\nthing" for s in (".", ",", "!?", "")] * 50
    want = [np.array(TOK.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert BPE.encode(texts) == want
    assert sorted(asked) == sorted(["A", " thing", "thing"])


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(max_size=20) | st.text(alphabet=" \n\tab'é.,1中\x1c\xa0", max_size=30), max_size=6))
def test_ids_of_any_block_equal_the_library(texts):
    want = [np.array(TOK.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert BPE.encode(texts) == want
