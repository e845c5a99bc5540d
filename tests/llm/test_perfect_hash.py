import numpy as np

from sideline.llm.perfect_hash import PerfectHash, Shard


def _keys(n, seed=0):
    return np.random.default_rng(seed).integers(0, 2**64, (2, n), np.uint64)


def test_every_key_has_its_own_number():
    for n in (0, 1, 2, 1000, 50_000):
        h1, h2 = _keys(n)
        made = PerfectHash.build(h1, h2)
        assert sorted(made.find(h1, h2)) == list(range(n)) and made.n == n
        assert sum(len(w) for w in made.words) * 64 < 4.5 * n + 64 * 20


def test_keys_that_share_a_half():
    h1 = np.zeros(500, np.uint64)
    h2 = np.arange(500, dtype=np.uint64)
    assert sorted(PerfectHash.build(h1, h2).find(h1, h2)) == list(range(500))
    assert sorted(PerfectHash.build(h2, h1).find(h2, h1)) == list(range(500))


def test_shard_knows_its_keys_only():
    h1, h2 = _keys(2000)
    count, last = np.arange(2000) + 3, np.arange(2000) * 7
    shard = Shard.from_bytes(Shard.build(h1, h2, count, last).to_bytes())
    got = shard.probe(h1, h2)
    assert (got[0] == count).all() and (got[1] == last).all()
    assert (shard.probe(*_keys(2000, 1))[0] == 0).all()
    empty = Shard.from_bytes(Shard.build(*[x[:0] for x in (h1, h2, count, last)]).to_bytes())
    assert (empty.probe(h1, h2)[0] == 0).all()
