"""What a Python worker holds while it counts and encodes is bounded by steps of text, not by the words of its task."""

import random

from dealsieve.llm import bpe_lexicon as B
from dealsieve.llm.queries import BYTE_BPE, tokenizer_file


def test_a_row_encoder_keeps_a_bounded_number_of_words(spark, monkeypatch):
    tokenizer = B.Tokenizer(tokenizer_file(BYTE_BPE))
    rng = random.Random(3)
    words = sorted({" " + "".join(rng.choices("abcdefgh", k=5)) for _ in range(400)})
    lexicon = B.Lexicon(B.compile_lexicon((w.encode(), tokenizer.encode_word(w)) for w in words))
    encoder = B.Encoder(tokenizer, lexicon, 50, False)
    for at in range(0, len(words), 20):
        texts = ["".join(words[at:at + 20]), " other" + str(at)]
        found = [encoder.ids(x).tolist() for x in encoder.entries(texts)]
        assert found == [[i for w in tokenizer.cut(t) for i in tokenizer.encode_word(w)] for t in texts]
        assert len(encoder.index) <= 50 + 24 and not encoder.decimals


def test_counts_are_those_of_whole_texts_in_any_slices(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"one two{i % 7} three one one") for i in range(60)], "doc_id long, text string").repartition(3)
    plain = B.frequent_words(docs, tokenizer_file(BYTE_BPE))
    monkeypatch.setattr(B, "STEP_BYTES", 30)
    monkeypatch.setattr(B, "COUNTER_WORDS", 2)
    assert B.frequent_words(docs, tokenizer_file(BYTE_BPE)) == plain == sorted({"one", " one", " three", *[f" two{i}" for i in range(7)]})
