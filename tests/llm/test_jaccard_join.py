"""The prefix-tree join against all pairs."""

import itertools
import random

import numpy as np
import pytest

from dialstat.llm import jaccard_join as J
from dialstat.llm.components import connected_components
from odd import odd_documents, rows_of


def sets_of(texts, n):
    out = []
    for t in texts:
        w = (t or "").lower().split()
        out.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set()))
    return out


def components(sets, num, den):
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(sets)), 2):
        x, y = sets[a], sets[b]
        if x and y and den * len(x & y) >= num * len(x | y):
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    return [root(i) for i in range(len(sets))]


def near_copies(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(2000)]
    out = []
    for _ in range(25):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 5, 8, 12, 20, 40, 90, 400]))]
        for _ in range(rng.randint(1, 9)):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(copy) // 25))):
                i = rng.randrange(len(copy))
                if rng.random() < 0.5:
                    copy[i] = rng.choice(vocabulary)
                else:
                    copy.insert(i, rng.choice(vocabulary))
            out.append(" ".join(copy))
    return out + ["", "a", "a b", "A b"]


@pytest.mark.parametrize("n,num,block", [(3, 90, None), (3, 90, 1500), (5, 80, None), (5, 80, 1500)])
def test_components_match_all_pairs(spark, monkeypatch, n, num, block):
    """Also with blocks so small that most clusters are taken key by key."""
    if block:
        monkeypatch.setattr(J, "BLOCK_ELEMENTS", block)
    texts = near_copies(n)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    rows, links = J.jaccard_components(df, n=n, num=num, den=100)
    sets = sets_of(texts, n)
    want = components(sets, num, 100)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows_of(rows)}
    assert got == {i: (len(s), want[i]) for i, s in enumerate(sets)}
    assert links.count() >= 1


def test_heavy_keys_are_summed_where_they_are_read(spark, monkeypatch):
    """The same components when many keys are taken for heavy ones."""
    asked = []

    def many(df, key):
        found = {r[0]: 2 for r in df.groupBy(key).count().filter("count > 2").orderBy(key).limit(300).collect()}
        asked.append(len(found))
        return found

    monkeypatch.setattr(J, "heavy_keys", many)
    texts = near_copies(3)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    rows, _ = J.jaccard_components(df)
    want = components(sets_of(texts, 3), 90, 100)
    assert {r["doc_id"]: r["component_id"] for r in rows_of(rows)} == dict(enumerate(want)) and asked[0] > 100


def test_tree_finds_every_link():
    rng = np.random.default_rng(3)
    base = np.unique(rng.integers(0, 2**63, 300, dtype=np.uint64))
    sets = []
    for _ in range(60):
        kept = base[rng.random(len(base)) > rng.random() * 0.2]
        sets.append(np.unique(np.concatenate([kept, rng.integers(0, 2**63, rng.integers(0, 20), dtype=np.uint64)])))
    sets = [sets[i] for i in J.tree_order(sets)]
    for probe in sets[::7]:
        want = [i for i, s in enumerate(sets) if 10 * len(np.intersect1d(probe, s)) >= 9 * len(np.union1d(probe, s))]
        assert sorted(J.trie_links(probe, sets, 90, 100)) == want
    assert J.trie_links(base, [], 90, 100) == []


def test_linked_sets_share_a_key():
    rng = np.random.default_rng(5)
    classes = J.size_classes(80, 100)
    for size in [5, 6, 9, 10, 11, 19, 40, 300, 3000]:
        for _ in range(40):
            a = np.unique(rng.integers(0, 2**64, size, dtype=np.uint64))
            b = np.unique(np.concatenate([a[rng.random(len(a)) > 0.1], rng.integers(0, 2**64, size // 12, dtype=np.uint64)]))
            if len(b) and 100 * len(np.intersect1d(a, b)) >= 80 * len(np.union1d(a, b)) and len(a) != len(np.intersect1d(a, b)):
                one, two = J.range_keys(a, classes), J.range_keys(b, classes)
                common = {(i, j): len(np.intersect1d(x, y)) for i, (x, _) in enumerate(one) for j, (y, _) in enumerate(two)}
                # in the scheme of the smaller set's class both have as many keys in common as they need
                assert any(k and k >= max(one[i][1], two[j][1]) for (i, j), k in common.items())


def test_odd_rows(spark, odd, nothing):
    rows, _ = J.jaccard_components(odd)
    got = sorted(((r["doc_id"] or 0, r["n_shingles"], r["component_id"]) for r in rows_of(rows)), key=str)
    sets = sets_of([r[1] for r in odd_documents()], 3)
    assert len(got) == len(sets)
    by_id = {}
    for i, n, c in got:
        by_id.setdefault(i, []).append((n, c))
    assert by_id[1][0][1] == by_id[2][0][1] == by_id[3][0][1] == 1
    assert by_id[4] == [(0, 4)] and by_id[5] == [(0, 5)] and by_id[6] == [(0, 6)]
    assert by_id[7] == [(1, 7)] and len(by_id[15]) == 3 and {c for _, c in by_id[15]} == {15}
    assert (0, None) in by_id[0]
    rows, links = J.jaccard_components(nothing)
    assert rows.count() == 0 and links.count() == 0
    with pytest.raises(ValueError):
        J.jaccard_components(odd, num=50)


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(30)] + [(100, x) for x in range(101, 140)] + [(7, 7), (None, 3)]
    got = {r["node"]: r["label"] for r in rows_of(connected_components(spark.createDataFrame(links, "a long, b long")))}
    assert got == {**{i: 0 for i in range(31)}, **{x: 100 for x in range(100, 140)}}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def near_and_far_sets(count, seed):
    """Random sets, some of them near copies of others."""
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(count):
        if out and rng.random() < 0.4:
            base = out[rng.integers(len(out))]
            drop = rng.integers(0, max(1, len(base) // 6), 1)[0]
            kept = np.delete(base, rng.choice(len(base), drop, replace=False))
            out.append(np.unique(np.concatenate([kept, rng.integers(0, 2**63, rng.integers(0, 6)).astype(np.uint64)])))
        else:
            out.append(np.unique(rng.integers(0, 2**63, rng.integers(1, 300)).astype(np.uint64) * np.uint64(2)))
    return out


@pytest.mark.parametrize("num", [80, 90])
def test_listed_candidates_hold_every_link(num):
    sets = near_and_far_sets(300, num)
    near = J.Agreement(sets, J.size_classes(num, 100), num, 100)
    links = 0
    for p, own in enumerate(sets):
        got = set(near.candidates(p).tolist())
        for q, other in enumerate(sets):
            both = len(np.intersect1d(own, other, assume_unique=True))
            if both < max(len(own), len(other)) and 100 * both >= num * (len(own) + len(other) - both):
                assert q in got
                links += 1
    assert links > 100


def test_sets_that_do_not_link_are_hardly_compared():
    """Four times the sets are about four times the work: nobody is a candidate of anybody."""
    rng = np.random.default_rng(3)
    for count in (500, 2000):
        sets = [np.unique(rng.integers(0, 2**63, 40).astype(np.uint64) * np.uint64(2)) for _ in range(count)]
        near = J.Agreement(sets, J.size_classes(90, 100), 90, 100)
        ranges = [postings for rows, postings in near.schemes.values() if len(rows) == count]
        listed = [len(postings.candidates(r, 5)[0]) for postings in ranges for r in range(0, count, 50)]
        assert ranges and max(listed) < 0.02 * count
