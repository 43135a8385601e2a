import numpy as np
import pytest

from churnspark.llm.bwt import back_steps, merge, repeats, transform


def collection(rng, n, letters=3, most=90):
    return [bytes(rng.integers(97, 97 + letters, rng.integers(1, most)).tolist()) for _ in range(n)]


def naive(strings):
    """Sorted (suffix, string, place) of strings with terminators ordered as the strings."""
    return sorted(((s[i:], k, i) for k, s in enumerate(strings) for i in range(len(s) + 1)), key=lambda x: (x[0] + b"\0", x[1]))


def built(strings, group):
    data = np.frombuffer(b"".join(strings), np.uint8)
    return transform(data, np.array([len(s) for s in strings]), np.array(group))


@pytest.mark.parametrize("seed", range(4))
def test_transform_is_the_sorted_one(seed):
    rng = np.random.default_rng(seed)
    parts = [collection(rng, rng.integers(1, 30), letters=1 + seed) for _ in range(3)]
    got = built([s for p in parts for s in p], [k for k, p in enumerate(parts) for _ in p]).tobytes()
    want = b"".join(bytes(p[k][i - 1] if i else 0 for _, k, i in naive(p)) for p in parts)
    assert got == want


@pytest.mark.parametrize("seed", range(4))
def test_merge_orders_by_the_first_bytes_and_finds_common_prefixes(seed):
    rng = np.random.default_rng(seed)
    common = collection(rng, 6, letters=4)
    parts = [[*collection(rng, 5), *[common[i] for i in rng.permutation(6)[:3]]] for _ in range(4)]
    bwts = [built(p, [0] * len(p)) for p in parts]
    sizes = np.array([len(b) for b in bwts])
    flat = [s for p in parts for s, _, _ in naive(p)]
    bwt = np.concatenate(bwts)
    for length in (1, 7, 30):
        rows, block, prefix = merge(bwt, back_steps(bwt, sizes), length)
        assert sorted(rows.tolist()) == list(range(len(flat)))
        heads = [flat[r][:length] for r in rows]
        long = [k for k, r in enumerate(rows) if len(flat[r]) >= length]
        assert [heads[k] for k in long] == sorted(heads[k] for k in long)
        first = {}
        for k in long:
            assert first.setdefault(heads[k], block[k]) == block[k]
        assert len(set(first.values())) == len(first)
        for k in long:
            if k and k - 1 in long:
                a, b = flat[rows[k - 1]], flat[rows[k]]
                assert prefix[k] == next((i for i in range(length) if a[i] != b[i]), length)


@pytest.mark.parametrize("seed", range(6))
def test_repeats_are_the_blocks_of_several_owners(seed):
    rng = np.random.default_rng(seed)
    common = collection(rng, 8, letters=4)
    parts = [[*collection(rng, 5, letters=2), *[common[i] for i in rng.permutation(8)[:4]]] for _ in range(4)]
    bwts = [built(p, [0] * len(p)) for p in parts]
    flat = [(s, (k * 7 + string) % 5) for k, p in enumerate(parts) for s, string, _ in naive(p)]
    owner = np.array([o for _, o in flat], np.int32)
    bwt = np.concatenate(bwts)
    for length in (3, 20, 50):
        rows, block = repeats(bwt, back_steps(bwt, np.array([len(b) for b in bwts])), length, owner)
        got = {}
        for r, b in zip(rows.tolist(), block.tolist()):
            got.setdefault(b, set()).add(r)
        want = {}
        for r, (s, _) in enumerate(flat):
            if len(s) >= length:
                want.setdefault(s[:length], set()).add(r)
        want = [w for w in want.values() if len({owner[r] for r in w}) > 1]
        assert sorted(map(sorted, got.values())) == sorted(map(sorted, want))
