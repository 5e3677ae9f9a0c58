"""Token files and the BPE lexicon against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from dealsieve.llm import bpe_lexicon as B
from dealsieve.llm import token_files as T
from dealsieve.llm.queries import BYTE_BPE, WORD_BPE, tokenizer_file

from .helpers import awkward_rows, clashing, prose

ODD = "abDL '\n\t\r  é1²!<|>\x1c\x85\xa0　​’sSÀßÿ×÷\x7f\x0bİΣς́北𝔘"


def odd_texts(n, seed):
    rng = random.Random(seed)
    texts = ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 40))) for _ in range(n)]
    return texts + ["", "a<|endoftext|> b", "<|endoftext|><|startoftext|>", "don't WE'LL I'm", "x" * 400, "é" * 300]


@pytest.fixture(scope="module")
def byte_library():
    return Tokenizer.from_file(tokenizer_file(BYTE_BPE))


@pytest.fixture(scope="module")
def word_library():
    return Tokenizer.from_file(tokenizer_file(WORD_BPE))


# ---------------------------------------------------------------- lexicon

def test_encoding_equals_the_library(byte_library):
    tokenizer = B.Tokenizer(tokenizer_file(BYTE_BPE))
    known = [" the", " of", " an", "tion", " don't", "\n"]
    lexicon = B.Lexicon(B.compile_lexicon(sorted((w.encode(), tokenizer.encode_word(w)) for w in known)))
    encoder = B.Encoder(tokenizer, lexicon)
    for text in [*odd_texts(1500, 1), prose(random.Random(1), 500)]:
        ids = byte_library.encode(text, add_special_tokens=False).ids
        assert encoder.encode(text) == ids
        assert tokenizer.decode(ids) == byte_library.decode(ids, skip_special_tokens=False)


def test_automaton_accepts_exactly_its_words_and_shares_endings(tmp_path):
    rng = random.Random(4)
    words = {("".join(rng.choice("abc") for _ in range(rng.randint(1, 6))) + "ation").encode(): [k, k + 1][:1 + k % 2]
             for k in range(300)}
    words["é".encode()] = [7, 8, 9]
    data = B.compile_lexicon(sorted(words.items()))
    path = tmp_path / "lexicon.bin"
    path.write_bytes(data)
    lexicon = B.Lexicon.map_file(str(path))
    assert all(lexicon.get(w) == ids for w, ids in words.items())
    others = {("".join(rng.choice("abc") for _ in range(rng.randint(0, 7))) + rng.choice(["", "ation", "atio"])).encode()
              for _ in range(2000)}
    assert all((lexicon.get(w) is not None) == (w in words) for w in others)
    assert len(lexicon.finals) < len({w[:k] for w in words for k in range(len(w) + 1)}) / 3    # far fewer than a trie's
    assert B.Lexicon(B.compile_lexicon([])).get(b"a") is None
    assert B.Lexicon(B.compile_lexicon([(b"", [5]), (b"a", [])])).places([b"", b"a", b"b"]).tolist() == [0, 1, -1]
    with pytest.raises(ValueError):
        B.compile_lexicon([(b"b", []), (b"a", [])])


def test_a_minimal_automaton_has_no_two_equal_states():
    lexicon = B.Lexicon(B.compile_lexicon((w, [1]) for w in sorted(b"tap taps top tops stop stops".split())))
    states = set()
    for s in range(len(lexicon.finals)):
        own = lexicon.keys >> 8 == s
        states.add((lexicon.finals[s], tuple(lexicon.keys[own] & 255), tuple(lexicon.targets[own])))
    assert len(states) == len(lexicon.finals) == 7


@pytest.mark.parametrize("limit", [0, 20, 5000])
def test_digests_do_not_depend_on_the_lexicon(spark, byte_library, limit):
    rows = awkward_rows() + [(4000 + i, t, "en", "a", 1) for i, t in enumerate(odd_texts(60, 2))]
    out = B.token_digests(clashing(spark, rows), tokenizer_file(BYTE_BPE), limit=limit).collect()
    want = []
    for r in rows:
        ids = byte_library.encode(r[1] or "", add_special_tokens=False).ids
        text = byte_library.decode(ids, skip_special_tokens=False)
        want.append((r[0], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(text.encode()).hexdigest()))
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, out), key=key) == sorted(want, key=key)


def test_token_columns_replace_clashing_names(spark):
    docs = clashing(spark, awkward_rows()).withColumnRenamed("copy", "n_tokens")
    out = B.with_tokens(docs, tokenizer_file(BYTE_BPE), limit=50)
    assert out.columns == [c for c in docs.columns if c not in ("text", "n_tokens")] + ["token_ids", "n_tokens", "decodes"]
    assert all(r.decodes and r.n_tokens == len(r.token_ids) for r in out.collect())


def test_counting_and_caching_in_small_steps(spark, monkeypatch):
    monkeypatch.setattr(B, "COUNTER_WORDS", 3)
    rows = [(i, "b b a c a b", "en", "a", 1) for i in range(5)]
    assert B.frequent_words(clashing(spark, rows), tokenizer_file(BYTE_BPE), limit=2) == [" a", " b"]
    tokenizer = B.Tokenizer(tokenizer_file(BYTE_BPE))
    encoder = B.Encoder(tokenizer, B.Lexicon(B.compile_lexicon([(b" two", tokenizer.encode_word(" two"))])))
    for _ in range(2):
        assert encoder.encode("one two three one two") == [i for w in ("one", " two", " three", " one", " two")
                                                           for i in tokenizer.encode_word(w)]
    encoder.entries([""])
    assert list(encoder.index) == [" two"] and len(encoder.raw) == len(encoder.decimals) == len(encoder.sizes) == 1
    monkeypatch.setattr(B, "STEP_BYTES", 4)
    batch = pa.RecordBatch.from_pydict({"t": ["a", "bcd", "", "efghij", "k"]})
    assert [t for _, t in B.steps(batch, 0)] == [["a"], ["bcd", ""], ["efghij", "k"]]


# ---------------------------------------------------------------- files

def test_word_encoding_equals_the_library(word_library):
    encoder = T.WordEncoder(tokenizer_file(WORD_BPE))
    texts = [*odd_texts(1500, 3), prose(random.Random(2), 400)]
    for at in range(0, len(texts), 100):
        some = texts[at:at + 100]
        ids, sizes = encoder.encode(some)
        want = [word_library.encode(t, add_special_tokens=False).ids + [T.END_ID] for t in some]
        assert sizes.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


@pytest.mark.parametrize("alphabet,length", [(2, 4000), (40, 20000), (3000, 5000)])
def test_grammar_round_trip_and_random_access(alphabet, length):
    rng = np.random.default_rng(alphabet)
    phrases = [rng.integers(0, alphabet, rng.integers(2, 9)) for _ in range(30)]
    ids = np.concatenate([phrases[k] for k in rng.integers(0, 30, length // 5)]).astype(np.uint32)
    cuts = np.sort(rng.choice(np.arange(1, len(ids)), 40, replace=False))
    lengths = np.diff(np.concatenate(([0], cuts, [len(ids)])))
    docs = [*range(len(lengths) - 1), None]
    shard = T.Shard(T.build_shard(docs, ids, lengths))
    found = list(shard.documents())
    assert [d for d, _ in found] == docs and np.array_equal(np.concatenate([x for _, x in found]), ids)
    assert len(shard.symbols) < len(ids) / 2 and len(shard.rules)
    for k in (0, 7, len(docs) - 1):
        whole = found[k][1]
        for a, b in ((0, None), (1, 3), (len(whole) - 1, len(whole)), (3, 3), (len(whole), None)):
            assert np.array_equal(shard.document(k, a, b), whole[a:b])


def test_one_symbol_runs_and_single_ids():
    ids = np.zeros(1000, np.uint32)
    shard = T.Shard(T.build_shard([1, 2], ids, np.array([999, 1])))
    assert [len(x) for _, x in shard.documents()] == [999, 1] and len(shard.symbols) < 200
    one = T.Shard(T.build_shard([5], np.array([49407], np.uint32), np.array([1])))
    assert one.document(0).tolist() == [49407]


@pytest.mark.parametrize("shard_ids", [50, 1 << 19])
def test_files_hold_every_document_in_order(spark, word_library, tmp_dir, shard_ids):
    rows = awkward_rows() + [(4000 + i, t, "en", "a", 1) for i, t in enumerate(odd_texts(40, 5))]
    T.write_tokens(clashing(spark, rows), tokenizer_file(WORD_BPE), f"{tmp_dir}/t", shard_ids=shard_ids)
    out = sorted(T.read_tokens(spark, f"{tmp_dir}/t").collect(), key=lambda r: r.start)
    assert [(r.doc_id is None, r.doc_id) for r in out] == sorted(((r[0] is None, r[0]) for r in rows),
                                                                key=lambda x: (x[0], x[1] or 0))
    assert [r.start for r in out] == np.concatenate(([0], np.cumsum([r.n_tokens for r in out])[:-1])).tolist()
    want = sorted((str(r[0]), zlib.crc32(np.array(word_library.encode(r[1] or "", add_special_tokens=False).ids
                                                  + [T.END_ID], "<u4").tobytes())) for r in rows)
    assert sorted((str(r.doc_id), r.ids_crc32) for r in out) == want


def test_empty_tables(spark):
    empty = clashing(spark, awkward_rows()).limit(0)
    assert B.token_digests(empty, tokenizer_file(BYTE_BPE)).count() == 0
    assert T.token_files(empty, tokenizer_file(WORD_BPE)).count() == 0


def test_rules_expand_in_runs():
    # Rules 2 and 3 use rules 0 and 1, rule 4 uses rule 3: three runs.
    rules = np.array([[0, 1], [1, 2], [3, 4], [3, 0], [6, 6]], np.uint32)
    assert list(T.rule_runs(3, rules)) == [(0, 2), (2, 4), (4, 5)]
    assert list(T.rule_runs(3, rules[:0])) == []
    assert T.expansions(3, rules).tolist() == [1, 1, 1, 2, 2, 4, 3, 6]


def test_byte_strings_of_a_slice():
    values = [b"", b"ab", b"\xc3\xa9", b"", b"c"]
    array = pa.array(values, pa.large_binary())
    assert T.byte_strings(array) == values
    assert T.byte_strings(array[1:4]) == values[1:4]
    assert T.byte_strings(array[:0]) == T.byte_strings(pa.array([], pa.large_binary())) == []
