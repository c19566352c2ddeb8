import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from scorekit.llm.components import components
from scorekit.llm.exact_dedup import drop_exact_copies, exact_groups
from scorekit.llm.near_dedup import (
    CHUNKS,
    DISTANCE,
    chunks_for,
    distance_at,
    drop_near_copies,
    near_groups,
)
from scorekit.llm.shingles import COMPONENTS, shingles, signature, word_memo
from tests.llm.corpus import documents, prose, texts


def plain(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def last(key):
    return (key is None, key or 0)


@pytest.mark.parametrize("block_chars", [1, 7, 4096])
def test_exact_groups_equal_brute_force(spark, block_chars):
    rows = texts()[-40:] + texts()[10:16] if block_chars == 1 else texts()
    groups = defaultdict(list)
    for key, text in rows:
        groups[plain(text)].append(key)
    expected = Counter(
        (key, min(group, key=last), len(group), hashlib.sha256(text.encode()).hexdigest())
        for text, group in groups.items()
        for key in group
    )
    found = exact_groups(documents(spark, rows), block_chars=block_chars).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found) == expected
    kept = [(r.doc_id, r.text_sha256) for r in found if r.kept]
    assert len(kept) == len(groups) == len(set(kept))
    assert all(r.doc_id == r.keep_id for r in found if r.kept)


def test_dropping_exact_copies_keeps_columns_and_one_of_each(spark):
    docs = documents(spark)
    out = drop_exact_copies(docs)
    assert out.dtypes == docs.dtypes
    assert sorted(plain(r.text) for r in out.collect()) == sorted({plain(t) for _, t in texts()})
    assert {(r.row, r.name, r._k) for r in out.collect()} == {("r", "n", 9)}


def shingle_set(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return frozenset({tuple(words)} if words else ())
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute_force(rows):
    """The smallest key of each row's component, every pair compared."""
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= 85 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    keys = defaultdict(list)
    for i, (key, _) in enumerate(rows):
        keys[find(i)].append(key)
    smallest = {r: min((k for k in ks if k is not None), default=None) for r, ks in keys.items()}
    return Counter((rows[i][0], len(sets[i]), smallest[find(i)]) for i in range(len(rows)))


def test_near_groups_equal_brute_force(spark):
    found = near_groups(documents(spark)).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == brute_force(texts())
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_families_of_many_tiles(spark, monkeypatch):
    import scorekit.llm.near_dedup as near_dedup

    monkeypatch.setattr(near_dedup, "BLOCK", 4)
    found = near_groups(documents(spark)).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == brute_force(texts())


@pytest.mark.parametrize("percent", [80, 85])
def test_chains_and_pairs_beside_the_hub(spark, monkeypatch, percent):
    """Groups whose members are linked over others only, in which a hub knows few of them."""
    rng = random.Random(21)
    rows = []
    for _ in range(12):
        words = prose(rng, 150).split()
        for step in range(10):
            rows.append((len(rows), " ".join(words)))
            for _ in range(rng.choice((1, 2, 3))):
                words[rng.randrange(len(words))] = f"new{len(rows)}x{rng.randrange(1 << 20)}"
    sets = [shingle_set(t) for _, t in rows]
    found = {r.doc_id: r.component_id for r in near_groups(documents(spark, rows), percent=percent).collect()}
    own = {i: i for i in range(len(rows))}
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(i):
                common = len(sets[i] & sets[j])
                if own[i] != own[j] and 100 * common >= percent * len(sets[i] | sets[j]):
                    low, high = sorted((own[i], own[j]))
                    own = {k: low if v == high else v for k, v in own.items()}
                    changed = True
    assert found == own and 12 <= len(set(own.values())) < len(rows)


def _counted(monkeypatch, name):
    """How many rows the frames have that a function of the module returns."""
    import scorekit.llm.near_dedup as near_dedup

    counts, plain_function = [], getattr(near_dedup, name)

    def counting(*args):
        frame = plain_function(*args)
        counts.append(frame.count())
        return frame

    monkeypatch.setattr(near_dedup, name, counting)
    return counts


@pytest.mark.parametrize("key", [lambda i: i, lambda i: None, lambda i: 7])
def test_rows_of_one_key_cost_as_much_as_others(spark, monkeypatch, key):
    rng = random.Random(22)
    base = [prose(rng, 60) for _ in range(150)]
    rows = [(key(i), f"{base[i % 150]} {'x' * (i // 150)}") for i in range(300)]
    counts = _counted(monkeypatch, "_sets")
    groups = near_groups(documents(spark, rows))
    assert groups.count() == 300 and groups.select("cluster").distinct().count() == 150
    assert counts == [300]


def test_one_document_of_each_group_stays(spark):
    docs = documents(spark)
    out = drop_near_copies(docs)
    assert out.dtypes == docs.dtypes
    groups = {(c, key) for (key, n, c) in brute_force(texts()) if n and key == c}
    worded = [r for r in out.collect() if shingle_set(r.text)]
    assert len(worded) >= len(groups)
    assert {r.doc_id for r in worded if r.doc_id is not None} == {key for _, key in groups if key is not None}
    assert sum(not shingle_set(r.text) for r in out.collect()) == sum(
        not shingle_set(t) for _, t in texts()
    )


def test_every_pair_within_the_distance_shares_a_key():
    """The pigeonhole: that many differences leave a chunk with one at most."""
    assert sum(CHUNKS) == COMPONENTS and 2 * len(CHUNKS) > DISTANCE


def test_distance_and_chunks_follow_from_the_similarity(spark):
    assert (DISTANCE, CHUNKS) == (23, (6, 6, 6, 6, 5, 5, 5, 5, 5, 5, 5, 5))
    assert [distance_at(p) for p in (76, 80, 85, 90)] == [31, 28, 23, 19]
    for percent in range(76, 101):
        distance = distance_at(percent)
        chunks = chunks_for(distance)
        assert sum(chunks) == COMPONENTS and 2 * len(chunks) > distance and min(chunks) >= 4
    for percent in (0, 50, 75, 101):
        with pytest.raises(ValueError):
            near_groups(documents(spark, []), percent=percent)


def test_a_similar_pair_of_far_signatures_is_found_at_80(spark):
    """A pair at 0.80 or more that differs in more components than the distance of 85 % allows."""
    memo, rng = word_memo(), np.random.default_rng(3)
    for trial in range(20_000):
        words = [f"w{trial}x{i}" for i in range(100)]
        other = list(words)
        for place in (10, 50):  # 10 of 96 shingles: 86 / 106 are common
            other[place] = f"changed{rng.integers(1 << 30)}"
        texts_of = [" ".join(w) for w in (words, other)]
        a, b = (shingles(t.encode(), memo) for t in texts_of)
        gap = (signature(a) != signature(b)).sum()
        if DISTANCE < gap <= distance_at(80):
            break
    common = len(np.intersect1d(a, b))
    assert DISTANCE < gap and 100 * common >= 80 * (len(a) + len(b) - common)
    found = near_groups(documents(spark, list(enumerate(texts_of))), percent=80).collect()
    assert {r.component_id for r in found} == {0}


def test_signatures_agree_as_often_as_sets_are_similar():
    memo = word_memo()
    words = [f"w{i}" for i in range(2000)]
    a = shingles(" ".join(words).encode(), memo)
    b = shingles(" ".join(words[:1000] + ["x"] + words[1001:]).encode(), memo)
    assert len(a) == len(b) == 1996
    same = (signature(a) == signature(b)).mean()
    assert same > 0.95
    assert (signature(a) == signature(shingles(b"a b c d e f g", memo))).mean() < 0.1
    assert np.array_equal(a, shingles(" ".join(words).upper().encode(), memo))


def test_components_equal_union_find(spark):
    chain = [(i, i + 1) for i in range(200)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    pairs = [(3000 + 2 * i, 3001 + 2 * i) for i in range(20)] + [(1, 1), (7, 3), (7, 3), (9000, 9000)]
    rows = components(spark.createDataFrame(chain + star + pairs, "a long, b long")).collect()
    groups = defaultdict(set)
    for node, component in rows:
        groups[component].add(node)
    assert len(rows) == len({r.node for r in rows})
    assert sorted(len(g) for g in groups.values()) == [2] * 20 + [201, 300]
    assert all(c in g for c, g in groups.items())


@pytest.mark.parametrize("operator", [exact_groups, drop_exact_copies, near_groups, drop_near_copies])
def test_empty_tables(spark, operator):
    assert operator(documents(spark, [])).collect() == []
