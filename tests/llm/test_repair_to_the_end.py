"""Re-Pair goes on until no pair pays for its rule."""

import numpy as np

from dealsieve.llm import token_files as T


def test_no_pair_that_pays_is_left():
    rng = np.random.default_rng(5)
    phrases = [rng.integers(0, 400, rng.integers(2, 40)) for _ in range(300)]
    docs = [np.concatenate([phrases[i] for i in rng.integers(0, 300, rng.integers(1, 30))]).astype(np.uint32) for _ in range(400)]
    docs.append(np.full(1000, 7, np.uint32))
    lengths = np.array([len(d) for d in docs])
    ids = np.concatenate(docs)
    ends = np.zeros(len(ids), bool)
    ends[np.cumsum(lengths) - 1] = True
    symbols, ends, rules = T.compress(ids, ends, 400)
    keys = ((symbols[:-1].astype(np.uint64) << np.uint64(32)) | symbols[1:])[~ends[:-1] & (symbols[:-1] != symbols[1:])]
    assert np.unique(keys, return_counts=True)[1].max() <= 6      # twelve bytes a rule, two bytes a symbol
    blob = T.build_shard(list(range(len(docs))), ids, lengths)
    assert all(np.array_equal(a, b) for (_, a), b in zip(T.Shard(blob).documents(), docs))
