import random
import re
from collections import Counter, defaultdict

import pytest

from standbyspark.llm import ngram_join as nj

WORD = re.compile(r"[^\x20\x09-\x0d]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def shingles(text, width):
    w = WORD.findall(lower(text or ""))
    return frozenset(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset()


def brute(rows, width, num, den):
    sets = [shingles(t, width) for _, t in rows]
    holders, parent = defaultdict(list), list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in enumerate(sets):
        seen = Counter(j for g in s for j in holders[g])
        for j, both in seen.items():
            if den * both >= num * (len(s) + len(sets[j]) - both):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
        for g in s:
            holders[g].append(i)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(sets[i]), least.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)), key=str)


def corpus(seed, families, copies, edits, words=60):
    rng, rows = random.Random(seed), []
    for _ in range(families):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(3, words))]
        for _ in range(rng.randrange(1, copies)):
            own = base[:]
            for _ in range(rng.randrange(edits)):
                own[rng.randrange(len(own))] = f"e{rng.randrange(50)}"
            rows.append((len(rows), " ".join(own).title() if rng.random() < 0.3 else "\n".join(own)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("seed", "families", "copies", "edits", "width", "num"), [(1, 40, 6, 3, 3, 90), (2, 6, 60, 4, 3, 90), (3, 30, 10, 4, 5, 80), (4, 3, 150, 3, 3, 90)])
def test_equals_brute_force(spark, make, monkeypatch, seed, families, copies, edits, width, num):
    monkeypatch.setattr(nj, "BLOCK", 16)
    rows = corpus(seed, families, copies, edits)
    got = nj.linked(make(rows), width, num, 100).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, width, num, 100)


def test_cells_never_miss_a_link():
    import numpy as np

    rng = random.Random(9)
    for _ in range(300):
        n = rng.randrange(1, 400)
        a = {rng.getrandbits(63) for _ in range(n)}
        b = set(a)
        for _ in range(rng.randrange(0, max(1, n // 8) + 1)):
            if rng.random() < 0.5 and len(b) > 1:
                b.discard(rng.choice(sorted(b)))
            else:
                b.add(rng.getrandbits(63))
        if 10 * len(a & b) >= 9 * len(a | b):
            keys = [set(np.concatenate(nj.cell_keys(np.array(sorted(s), dtype=np.uint64), len(s), 90, 100)).tolist()) for s in (a, b)]
            assert keys[0] & keys[1], (len(a), len(b))


def test_overlap_bound_is_above():
    import numpy as np

    rng = random.Random(3)
    for _ in range(50):
        sets = [np.array(sorted(rng.sample(range(3000), rng.randrange(1, 900))), dtype=np.uint64) for _ in range(2)]
        bits = nj.matrix([nj.bitmap(s) for s in sets])
        assert nj.overlap_bound(np.array([len(sets[0])]), np.array([len(sets[1])]), bits[:1], bits[1:])[0] >= len(np.intersect1d(*sets))
        wide = [nj.wide_bitmap(s) for s in sets]
        assert min(map(len, sets)) >= nj.wide_bound(len(sets[0]), len(sets[1]), *wide) >= len(np.intersect1d(*sets))


def test_odd_rows(odd):
    got = sorted((tuple(r) for r in nj.linked(odd).collect()), key=str)
    assert len(got) == 10
    assert (4, 1, 4, 2) in got and (2, 0, 2, 1) in got and (1, 0, 1, 1) in got and (None, 0, None, 1) in got and (None, 2, None, 1) in got
    assert nj.linked(odd.limit(0)).count() == 0


def test_one_of_each_group_stays(odd, make):
    kept = nj.one_of_each(odd)
    assert kept.columns == odd.columns and kept.count() == 9  # of the repeated row one stays
    rows = corpus(5, 12, 8, 2)
    comps = {d: c for d, _, c in brute(rows, 5, 80, 100)}
    assert sorted(r["doc_id"] for r in nj.one_of_each(make(rows)).collect()) == sorted(set(comps.values()))
    assert nj.one_of_each(odd.limit(0)).count() == 0
