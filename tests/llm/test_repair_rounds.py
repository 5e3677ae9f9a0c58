"""Later rounds of Re-Pair look only at places whose pair may still pay for a rule."""

import numpy as np

from dealsieve.llm import token_files as T


def test_rounds_do_not_look_at_every_place_again(monkeypatch):
    rng = np.random.default_rng(7)
    phrases = [rng.integers(0, 400, rng.integers(2, 40)) for _ in range(300)]
    docs = [np.concatenate([phrases[i] for i in rng.integers(0, 300, rng.integers(1, 30))] + [rng.integers(400, 9000, 200)])
            .astype(np.uint32) for _ in range(400)]
    lengths = np.array([len(d) for d in docs])
    ids = np.concatenate(docs)
    ends = np.zeros(len(ids), bool)
    ends[np.cumsum(lengths) - 1] = True
    seen, plain = [], T._frequent_pairs

    def counted(keys, *more):
        seen.append(len(keys))
        return plain(keys, *more)
    monkeypatch.setattr(T, "_frequent_pairs", counted)
    symbols, ends, rules = T.compress(ids, ends, 9000)
    assert sum(seen) < 3 * len(ids) and seen[-1] * 20 < len(symbols)
    keys = ((symbols[:-1].astype(np.uint64) << np.uint64(32)) | symbols[1:])[~ends[:-1] & (symbols[:-1] != symbols[1:])]
    assert np.unique(keys, return_counts=True)[1].max() <= 6      # twelve bytes a rule, two bytes a symbol
    blob = T.build_shard(list(range(len(docs))), ids, lengths)
    assert all(np.array_equal(a, b) for (_, a), b in zip(T.Shard(blob).documents(), docs))
