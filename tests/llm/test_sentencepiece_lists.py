import public_tokenizers
import pyarrow as pa

from blotter.llm.sentencepiece_codec import Codec


def test_lists_are_decoded_without_a_step_an_id():
    codec = Codec(public_tokenizers.path("piece_bpe_32k.model"))
    texts = ["Two words", "", None, " ▁ x\n\ny", "😀"]
    ids = [None if t is None else memoryview(codec.encode([t])[0]).cast("i").tolist() for t in texts]
    lists = pa.array(ids, pa.list_(pa.int32()))
    assert codec.decode_lists(lists) == [None if i is None else codec.decode(i) for i in ids]
    assert codec.decode_lists(lists.slice(2, 2)) == [None, "   x\n\ny"]


def test_the_automaton_may_start_anew(monkeypatch):
    monkeypatch.setattr("blotter.llm.sentencepiece_codec._PAIRS", 20)
    codec, whole = (Codec(public_tokenizers.path("piece_bpe_32k.model")) for _ in range(2))
    texts = ["Some words here, somewhere", "and others there", "élan 中文 words"]
    got = codec.encode(texts)
    monkeypatch.undo()
    assert codec.steps <= 20 and got == whole.encode(texts)
