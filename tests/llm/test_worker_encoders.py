"""Encoders are kept from task to task of a worker, and words are cut and merged many at a time."""

import random

import numpy as np

from dealsieve.llm import bpe_lexicon as B
from dealsieve.llm import token_files as T
from dealsieve.llm.common import from_worker, to_worker
from dealsieve.llm.queries import BYTE_BPE, WORD_BPE, tokenizer_file

PARTS = [*"ab cD'\n\t .,19\u00e9\u20ac\xa0\u2003\u3000\x1c\x1f\u180e\u200b\ufeff\x85\r\x0b\u6f22", "'ll", " the", " word", "<|endoftext|>"]


def awkward_texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choices(PARTS, k=rng.randint(0, 40))) for _ in range(n)] + ["", " ", "\n"]


def test_words_cut_on_arrays_are_those_of_the_pattern():
    tokenizer = B.Tokenizer(tokenizer_file(BYTE_BPE))
    for texts in (awkward_texts(2000, 5), ["plain words", "", "of  two\n texts "], []):
        words, number = tokenizer.cut_arrays(texts)
        cut = [tokenizer.cut(t) for t in texts]
        assert [w.decode() for w in words.to_pylist()] == [w for c in cut for w in c]
        assert number.tolist() == [len(c) for c in cut]


def test_words_merged_together_are_those_merged_alone():
    tokenizer = B.Tokenizer(tokenizer_file(BYTE_BPE))
    words = sorted({w for t in awkward_texts(2000, 6) for w in tokenizer.cut(t)} - set(tokenizer.special))
    ids, sizes = tokenizer.encode_words([w.encode() for w in words])
    assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == [tokenizer.encode_word(w) for w in words]
    assert [len(x) for x in tokenizer.encode_words([])] == [0, 0]


def test_a_worker_gives_what_it_kept_once_and_for_one_key():
    to_worker("test", "a", [1])
    assert from_worker("test", "b") is None and from_worker("test", "a") is None
    to_worker("test", "a", [2])
    assert from_worker("test", "a") == [2] and from_worker("test", "a") is None


def test_forgetting_keeps_the_pieces_met_again(monkeypatch):
    monkeypatch.setattr(T, "WORD_MEMORY", 40)
    encoder, fresh = T.WordEncoder(tokenizer_file(WORD_BPE)), T.WordEncoder(tokenizer_file(WORD_BPE))
    for step in range(12):
        texts = ["the same words " + " ".join(f"word{chr(97 + step)}{chr(97 + k)}x" for k in range(15)), "don't \u00e9t\u00e9"]
        ids, sizes = encoder.encode(texts)
        plain = [[*fresh.library.encode(t, add_special_tokens=False).ids, T.END_ID] for t in texts]
        assert ids.tolist() == plain[0] + plain[1] and sizes.tolist() == [len(p) for p in plain]
        assert len(encoder.index) <= 40 + 25 and len(encoder.calls) == len(encoder.index) == len(encoder.sizes)
        if step > 3:
            assert b"same" in encoder.index
