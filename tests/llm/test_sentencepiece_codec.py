import random

import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from blotter.llm.sentencepiece_codec import MARK, Codec, decode, encode

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIB = sentencepiece.SentencePieceProcessor(model_file=PATH)
OWN = Codec(PATH)


def own(text):
    return memoryview(OWN.encode([text])[0]).cast("i").tolist()


@settings(max_examples=1500, deadline=None)
@given(st.text(max_size=60) | st.text(alphabet=" \n\n abcdeinorst\n▁", max_size=60))
def test_ids_equal_the_library(text):
    assert own(text) == LIB.encode(text)
    assert OWN.decode(LIB.encode(text)) == text.replace(MARK, " ")


def test_documents_equal_the_library(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in decode(encode(docs, PATH), PATH).collect():
        assert r.ids == LIB.encode(texts[r.id]) and r.text == texts[r.id]


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, " "), (4, "  a  b "), (5, "x" * 30_000), (5, "x" * 30_000), (None, "é\u0000\t😀"),
            (7, " " * 5000), (8, "</s> <s> <unk> <0x0A>")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, ids int")
    got = decode(encode(df, PATH), PATH).collect()
    assert sorted(((r.id, r.text) for r in got), key=str) == sorted(rows, key=str)
    assert all(r.ids == (None if r.text is None else LIB.encode(r.text)) for r in got)
    assert encode(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


def test_shared_prefixes_do_not_depend_on_the_block():
    rng = random.Random(1)
    words = list({MARK + "".join(rng.choice("aeinrst") for _ in range(rng.randint(0, 12))) for _ in range(3000)})
    together = dict(zip(words, OWN.encode_words(words)))
    assert all(OWN.encode_words([w])[0] == together[w] for w in words[::7])
