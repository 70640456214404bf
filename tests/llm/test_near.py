"""Jaccard join on the trie, and components."""

from __future__ import annotations

import random
import re
import sys
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from llm_helpers import SF_DIR

from authwatch.llm import jaccard_trie as jt
from authwatch.llm.components import components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[n:n + 5]) for n in range(len(words) - 4)}


def roots(pairs, items):
    parent = {x: x for x in items}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in items}


def brute_pairs(rows):
    sets = {key: shingles(text) for key, text in rows}
    holders = defaultdict(list)
    for key, own in sets.items():
        for shingle in own:
            holders[shingle].append(key)
    pairs = []
    for key, own in sets.items():
        common = Counter(other for s in own for other in holders[s] if other < key)
        pairs += [(key, other) for other, n in common.items()
                  if 100 * n >= 75 * (len(own) + len(sets[other]) - n)]
    return sets, pairs


def brute(rows):
    sets, pairs = brute_pairs(rows)
    found = roots(pairs, sets)
    return {key: (len(own), found[key]) for key, own in sets.items()}


def brute_counts(rows):
    sets, pairs = brute_pairs(rows)
    found, links = roots(pairs, sets), Counter(key for pair in pairs for key in pair)
    copies = defaultdict(list)
    for key, own in sets.items():
        copies[frozenset(own) or key].append(key)
    return {key: (len(own), found[key], min(copies[frozenset(own) or key]), links[key])
            for key, own in sets.items()}


def linked(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in jt.link_documents(df).collect()}


def counted(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.class_id, r.n_links)
            for r in jt.link_counts(df).collect()}


def near_copies(seed, count, bases):
    rng = random.Random(seed)
    base = [[f"{rng.choice('abcdefgh')}{rng.randint(0, 40)}"
             for _ in range(rng.choice([4, 8, 30, 120]))] for _ in range(bases)]
    texts = []
    for _ in range(count):
        words = list(rng.choice(base))
        for _ in range(rng.choice([0, 1, 1, 2, 3, 5])):
            if len(words) > 2:
                words[rng.randrange(len(words))] = f"X{rng.randint(0, 9)}"
        texts.append(" ".join(words))
    return texts


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert counted(docs) == brute_counts([(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize("frequent, block", [(64, 2048), (2, 9)])
def test_near_copies_in_blocks(frame, monkeypatch, frequent, block):
    monkeypatch.setattr(jt, "FREQUENT", frequent)
    monkeypatch.setattr(jt, "BLOCK", block)
    rows = list(enumerate(near_copies(3, 300, 6)))
    rows += [(900, None), (901, ""), (902, " \n"), (903, "a b"), (904, "A B"), (905, "Ä b"),
             (906, "ä b")]
    assert linked(frame(rows)) == brute(rows)
    assert counted(frame(rows)) == brute_counts(rows)


def test_a_large_group_of_unlike_classes_stays_in_bounds(frame, monkeypatch):
    """Texts of one frequent beginning that are not similar, and a few that are."""
    rng = random.Random(8)
    common = "shared beginning of very many texts here"
    texts = [f"{common} " + " ".join(f"w{rng.randint(0, 9)}{n}x{m}" for m in range(20))
             for n in range(120)]
    texts += [text + " tail" for text in texts[::7]]
    most, join = [], jt.join_sets
    monkeypatch.setattr(jt, "PAIRED", 4)
    monkeypatch.setattr(jt, "BLOCK", 10)
    # The rows of a task are counted where it is called here, in blocks and chunks of ten.
    sets = hash_sets(texts)
    rows = [(0, b, c, 0, i, i, s.tobytes()) for b in range(3) for c in range(2)
            for i, s in list(enumerate(sets))[10 * b:10 * b + 10]]
    rows += [(0, b, c, 1, i, i, s.tobytes()) for b in range(3) for c in range(2)
             for i, s in list(enumerate(sets))[120 + 9 * c:120 + 9 * c + 9]]
    names = ["group", "block", "chunk", "probe", "sign", "label", "shingles"]
    batch = pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in sorted(rows)],)
    monkeypatch.setattr(jt, "join_sets", lambda sets, *a: most.append(len(sets)) or join(sets, *a))
    got = {tuple(sorted(pair)) for out in jt._join_groups([batch])
           for pair in zip(out["a"].to_pylist(), out["b"].to_pylist(), strict=True)}
    assert got == {(7 * n, 120 + n) for n in range(5)} and max(most) <= 20
    assert linked(frame(list(enumerate(texts)))) == brute(list(enumerate(texts)))


def test_very_long_texts_and_ties(frame):
    long = " ".join(f"w{n}" for n in range(60_000))
    rows = [(5, long), (3, long + " end"), (9, "x" * 300_000), (4, "a b c d e"), (2, "A b c d e"),
            (7, "a b c d f"), (8, " ".join(["same"] * 5000)), (6, "same " * 7)]
    assert linked(frame(rows)) == brute(rows)


def test_odd_rows(frame, odd_rows):
    rows = jt.link_documents(frame(odd_rows)).collect()
    assert len(rows) == len(odd_rows)
    assert {r.component_id for r in rows if r.doc_id in (4, 5)} == {4}
    assert jt.link_documents(frame([])).count() == 0
    rows = jt.link_counts(frame(odd_rows)).collect()
    assert len(rows) == len(odd_rows)
    # Both rows of 4, rows 5 and 8, and the row without an id with the same line have one set.
    assert [r.n_links for r in rows if r.doc_id in (4, 5, 8)] == [4, 4, 4, 4]
    assert {r.class_id for r in rows if r.doc_id in (4, 5)} == {4}
    assert {(r.class_id, r.n_links) for r in rows if r.doc_id in (1, 2, 3)} == {
        (1, 0), (2, 0), (3, 0)}
    assert jt.link_counts(frame([])).count() == 0


def hash_sets(texts):
    hashes, bounds = jt.shingle_sets(pa.array(texts))
    return [hashes[a:b] for a, b in zip(bounds[:-1], bounds[1:])]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_trie_connects_what_is_similar(seed):
    texts = near_copies(seed, 120, 4)
    sets = hash_sets(texts)
    want = roots([(a, b) for a in range(120) for b in range(a) if jaccard(sets[a], sets[b])],
                 range(120))
    assert roots(jt.join_sets(sets), range(120)) == want
    # In two blocks, with probes of all of one block into the other.
    labels = [*range(120)]
    across = [*jt.join_sets(sets, labels, 60)]
    own = [*jt.join_sets(sets[:60])] + [(60 + a, 60 + b) for a, b in jt.join_sets(sets[60:])]
    assert roots(across + own, range(120)) == want


@pytest.mark.parametrize("seed, probes", [(1, None), (2, 50), (3, 119), (4, 1)])
def test_trie_counts_what_is_similar(seed, probes):
    """Weights of similar sets, within one block and between two, whole subtrees included."""
    sets = hash_sets(near_copies(seed, 120, 4))
    weights = [n % 5 + 1 for n in range(120)]
    cut = 120 - (probes or 0)
    want = [sum(weights[b] for b in range(120) if (probes is None or (a < cut) != (b < cut))
                and jaccard(sets[a], sets[b])) for a in range(120)]
    assert jt.count_sets(sets, weights, probes) == want
    assert jt.count_sets(sets, weights, 0) == jt.count_sets(sets, weights, 120) == [0] * 120


def steps(run):
    """Calls that are made while ``run`` runs."""
    seen = Counter()
    sys.setprofile(lambda frame, event, arg: seen.update([event]))
    try:
        run()
    finally:
        sys.setprofile(None)
    return seen["call"] + seen["c_call"]


@pytest.mark.parametrize("alike", [True, False])
def test_steps_grow_with_the_sets_and_not_with_their_pairs(alike):
    """Sets of one frequent beginning: all similar to each other, or none."""
    def sets(count):
        rng, own = np.random.default_rng(3), 8 if alike else 60
        return [np.sort(np.concatenate([np.arange(100), rng.integers(1000, 1 << 60, own)]).astype(
            np.uint64)) for _ in range(count)]

    few, many = sets(100), sets(400)
    for run in (lambda x: jt.count_sets(x, [1] * len(x), None),
                lambda x: jt.count_sets(x, [1] * len(x), len(x) // 2),
                lambda x: [*jt.join_sets(x)],
                lambda x: [*jt.join_sets(x, [*range(len(x))], len(x) // 2)]):
        assert steps(lambda: run(many)) < 8 * steps(lambda: run(few))
    assert set(jt.count_sets(many, [1] * 400, None)) == {400 if alike else 1}


def jaccard(a, b):
    common = len(np.intersect1d(a, b))
    return 100 * common >= 75 * (len(a) + len(b) - common)


@pytest.mark.parametrize("paired, size", [(64, 7), (3, 7), (3, 1000)])
def test_pairs_of_a_shingle_or_links_to_one_of_them(monkeypatch, paired, size):
    monkeypatch.setattr(jt, "PAIRED", paired)
    rng = np.random.default_rng(0)
    rows = np.unique(rng.integers(0, 12, (200, 2)), axis=0)
    names = ["shingle", "sign", "n", "last", "place"]
    batches = [pa.RecordBatch.from_arrays(
        [pa.array(part[:, 0]), pa.array(part[:, 1])] + [pa.array(np.full(len(part), v))
                                                        for v in (10, 5, 1)], names)
               for part in np.array_split(rows, -(-len(rows) // size)) if len(part)]
    got = [tuple(pair) for batch in jt._pairs(iter(batches))
           for pair in zip(batch["a"].to_pylist(), batch["b"].to_pylist())]
    for shingle in np.unique(rows[:, 0]):
        own = rows[rows[:, 0] == shingle][:, 1].tolist()
        want = roots([(own[0], x) for x in own], own)
        inside = [(a, b) for a, b in got if a in own and b in own]
        assert len(own) < 2 or roots(inside, own) == want


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randint(0, 400), rng.randint(0, 400)) for _ in range(250)]
    edges += [(n, n + 1) for n in range(1000, 1100)] + [(2000, n) for n in range(2001, 2300)]
    df = spark.createDataFrame(edges, "a long, b long")
    want = roots(edges, {x for edge in edges for x in edge})
    got = {r.node: r.root for r in components(df, "a", "b").collect()}
    assert got == {node: root for node, root in want.items() if node != root}
    assert components(df.filter("a = b"), "a", "b").count() == 0
