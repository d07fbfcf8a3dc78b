import random
from itertools import combinations

import pytest
import xxhash

from candleworks.llm import simhash
from candleworks.llm.components import components


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        low = low.replace(c, " ")
    words = [w for w in low.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(nodes, near):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in combinations(sorted(nodes), 2):
        if near(a, b):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def distance(a, b):
    return ((a ^ b) & (2**64 - 1)).bit_count()


def test_fingerprints(small, awkward):
    texts = awkward + ["A b C d", "A\vb", "É é Z"] + [r[0] for r in small("documents").select("text").limit(50).collect()]
    for text in texts:
        assert simhash.fingerprint(text) & (2**64 - 1) == plain_fingerprint(text)


def test_masks_cover_every_pair_within_the_radius():
    masks = simhash.covering_masks(2)
    assert len(masks) == 7
    for a, b in combinations(range(64), 2):
        assert any(not m >> a & 1 and not m >> b & 1 for m in masks)


@pytest.mark.parametrize("radius", [0, 1, 2])
def test_links_have_the_components_of_all_near_pairs(spark, radius):
    """Small buckets, and one with far more near copies than are compared one by one."""
    rng = random.Random(3)
    centres = [rng.getrandbits(64) for _ in range(20)]
    found = set(centres)
    for c in centres:
        found |= {c ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(6)}
    crowd = {centres[0] ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(1, 5))) for _ in range(400)}
    signed = sorted({simhash._signed(f) for f in found | crowd})
    edges = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"), radius)
    pairs = [(r.a, r.b) for r in edges.collect()]
    assert all(distance(a, b) <= radius for a, b in pairs)
    want = plain_components(signed, lambda a, b: distance(a, b) <= radius)
    got = {f: f for f in signed} | {r.node: r.root for r in components(edges).collect()}
    assert got == want


def test_radii_without_a_split_are_refused(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(1,)], "fp long"), 3)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(200, 240)] + [(7, 7), (240, 5)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 100 for i in range(101, 161)} | {i: 5 for i in range(200, 241)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_groups_against_brute_force(spark, small):
    docs = small("documents")
    got = {r.doc_id: (r.fp & (2**64 - 1), r.component_id) for r in simhash.groups(docs).collect()}
    prints = {r.doc_id: plain_fingerprint(r.text) for r in docs.collect()}
    want = plain_components(list(prints), lambda a, b: distance(prints[a], prints[b]) <= 2)
    assert got == {i: (prints[i], want[i]) for i in prints}


def test_one_document_of_each_group_stays(documents, awkward):
    text = " ".join(f"w{i}" for i in range(400))
    docs = documents([(3, text), (1, text), (2, text + " end"), (9, "other words here"), (9, "other words here"), (4, None), (5, "")])
    kept = simhash.deduplicated(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 4, 9]
    assert simhash.deduplicated(documents([])).count() == 0
    assert simhash.groups(documents(awkward)).count() == len(awkward)
    assert simhash.deduplicated(documents([(None, "a b c d"), (None, "e f g")])).count() == 2


def test_one_row_of_each_group_stays_without_ids(documents):
    """Copies without ids, and an id that two texts share."""
    text, far = " ".join(f"w{i}" for i in range(400)), " ".join(f"v{i}" for i in range(400))
    kept = simhash.deduplicated(documents([(None, text), (None, text), (None, far), (8, far), (None, "a b c d")])).collect()
    assert sorted(((r.doc_id, r.text) for r in kept), key=str) == [(8, far), (None, "a b c d"), (None, text)]
    both = simhash.deduplicated(documents([(1, text), (2, text), (2, far)])).collect()
    assert sorted((r.doc_id, r.text) for r in both) == [(1, text), (2, far)]
