"""Operator 7 against all pairs in plain Python."""

import random

import numpy as np
import pytest

from eddy.llm import near_dups as N
from eddy.llm.common import Scratch
from eddy.llm.components import components, merged

from . import helpers as H


def sets(text):
    w = H.spaced(text)
    return {tuple(w[i:i + 5]) for i in range(max(len(w) - 5, 0) + 1)} if w else set()


def brute(rows):
    """(doc_id, n_shingles, component_id, kept); ids are unique."""
    s = {i: sets(t) for i, t in rows}
    label = {i: i for i in s}

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    ids = sorted(s)
    for x, a in enumerate(ids):
        for b in ids[x + 1:]:
            both = len(s[a] & s[b])
            if both and 100 * both >= 85 * len(s[a] | s[b]):
                p, q = sorted((find(a), find(b)))
                label[q] = p
    return sorted((i, len(s[i]), find(i), find(i) == i) for i in ids)


def result(df):
    return sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect())


def test_table(spark):
    docs = H.documents(spark)
    assert result(N.find(docs)) == brute([(r.doc_id, r.text) for r in docs.collect()])


def family(seed, members, edits, words=60):
    """Copies of one text with single words replaced."""
    r = random.Random(seed)
    base = [f"w{r.randrange(10**6)}" for _ in range(words)]
    out = []
    for _ in range(members):
        w = list(base)
        for _ in range(r.randrange(edits + 1)):
            w[r.randrange(words)] = f"e{r.randrange(10**6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("leaf, levels", [(64, 8), (4, 2), (4, 0 + 1)])
def test_large_groups(spark, leaf, levels):
    """Small leaves and few levels send groups through branching and blocks."""
    texts = family(1, 60, 3) + family(2, 40, 1) + ["passage " * 3 + t for t in family(3, 10, 8)] + family(2, 5, 0)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert result(N.find(docs, leaf=leaf, levels=levels, trees=(3, 20))) == brute(list(enumerate(texts)))


def test_odd_rows(spark):
    docs = H.odd_documents(spark, [(30, "One  two\nTHREE", "en", "s", 1, "", "", ""),
                                   (31, " ", "en", "s", 1, "", "", "")])
    got = {}
    for r in N.find(docs).collect():
        got.setdefault(r.doc_id, set()).add((r.n_shingles, r.component_id, r.kept))
    assert got[1] == {(0, 1, True)} and got[2] == {(0, 2, True)} and got[3] == {(0, 3, True)}
    assert got[4] == {(1, 4, True)} and got[30] == {(1, 4, False)}
    assert got[6] == {(7, 6, True)} and len(got[7]) == 2
    assert got[None] == {(9, None, True)} and got[31] == {(1, 31, True)}
    assert N.find(H.empty_documents(spark)).count() == 0


def test_components(spark):
    r = random.Random(5)
    links = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1100)]
    label = {i: i for e in links for i in e}
    for _ in range(400):
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    got = components(spark.createDataFrame(links, "a bigint, b bigint"), Scratch(spark, "test"))
    want = {n: c for n, c in label.items() if any(a != b and n in (a, b) for a, b in links)}
    assert {x.node: x.label for x in got.collect()} == want
    assert components(spark.createDataFrame([], "a bigint, b bigint"), Scratch(spark, "test")) is None


def brute_at(rows, percent):
    """As brute(), at a threshold of ``percent``; distinct texts of few links."""
    s, label = {i: sets(t) for i, t in rows}, {i: i for i, _ in rows}
    for a in sorted(s):
        for b in sorted(s):
            both = len(s[a] & s[b])
            if a < b and both and 100 * both >= percent * len(s[a] | s[b]):
                old, new = max(label[a], label[b]), min(label[a], label[b])
                label = {i: new if c == old else c for i, c in label.items()}
    return sorted((i, len(s[i]), label[i], label[i] == i) for i in s)


def test_recall_by_calculation():
    assert N.agree(0.85) == 44 and N.agree(0.8) == 39
    assert N.miss(0.8, N.TREES_80[1], 2 * N.LEVELS - 1) < 0.001
    assert [N.ratio(x) for x in (0.85, 0.8)] == [(17, 20), (4, 5)]


def test_threshold(spark):
    """Groups at 0.8, by small leaves and few levels, against all pairs."""
    rows = list(enumerate(family(4, 40, 3, 100) + family(5, 40, 3, 150) + family(6, 30, 2, 60)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = brute_at(rows, 80)
    assert want != brute_at(rows, 85) == brute(rows)
    assert result(N.find(docs, leaf=4, levels=2, trees=N.TREES_80, threshold=0.8)) == want


def test_one_id_of_two_texts(spark):
    """Either text of an id has its own links, whichever the order."""
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(60)) for x in "abcd")
    rows = [(3, a + " end"), (7, a), (7, b), (8, b + " end"), (9, c), (9, d), (11, d + " end"), (11, a + " too")]
    got = {}
    for r in N.find(spark.createDataFrame(rows, "doc_id bigint, text string")).collect():
        got.setdefault(r.doc_id, []).append((r.n_shingles, r.component_id, r.kept))
    assert {i: sorted(x) for i, x in got.items()} == {
        3: [(57, 3, True)], 7: [(56, 3, False), (56, 7, True)], 8: [(57, 7, False)],
        9: [(56, 9, True), (56, 9, True)], 11: [(57, 3, False), (57, 9, False)]}


def test_recall_in_the_deepest_nodes():
    """Phase two alone meets the stated miss of at most 0.1 %."""
    assert N.miss(N.THRESHOLD, N.TREES[1], 2 * N.LEVELS - 1) < 0.001


def passage(seed, members, words=60, own=11):
    """Texts that share a long passage, each with an end of its own: below
    the threshold, but near it."""
    r = random.Random(seed)
    base = " ".join(f"w{r.randrange(10**6)}" for _ in range(words))
    return [base + " " + " ".join(f"p{r.randrange(10**9)}" for _ in range(own)) for _ in range(members)]


def test_rare_keys_meet():
    """Any two sets at the threshold share a key."""
    r = random.Random(3)
    freq = np.ones(1 << N.FREQ_BITS, np.int32) * 2
    for _ in range(300):
        n = r.randrange(1, 200)
        a = np.unique(np.array([r.getrandbits(64) for _ in range(n)], np.uint64))
        b = np.unique(np.concatenate([r.sample(list(a), r.randrange(int(0.8 * n), n + 1)),
                                      [r.getrandbits(64) for _ in range(r.randrange(n // 6 + 1))]]).astype(np.uint64))
        both, union = len(np.intersect1d(a, b)), len(np.union1d(a, b))
        for part, whole in ((17, 20), (4, 5)):
            if both and whole * both >= part * union:
                of = [dict(zip(*map(np.ndarray.tolist, N.rare_keys(x, freq, part, whole)))) for x in (a, b)]
                assert any(of[0][k] | of[1][k] in (0, 3) for k in of[0].keys() & of[1].keys())


@pytest.mark.parametrize("make", [lambda n: family(5, n, 6), lambda n: passage(6, n)])
def test_work_follows_the_group(spark, monkeypatch, make):
    """Twice the group gives about twice the members compared on full sets."""
    seen, confirm = [], N.confirm

    def counted(members, *rest):
        seen[-1] += members.count()
        return confirm(members, *rest)

    monkeypatch.setattr(N, "confirm", counted)
    for n in (150, 300):
        texts = make(n)
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
        seen.append(0)
        got = result(N.find(docs, leaf=32, levels=2, trees=(3, 16)))
        if n == 150:
            assert got == brute(list(enumerate(texts)))
    assert seen[1] <= 3 * seen[0] + 200, seen


def test_a_group_is_compared_once(spark, monkeypatch):
    """What many trees and both phases find again is not compared again."""
    seen, confirm = [], N.confirm

    def kept(members, *rest):
        by = {}
        for r in members.collect():
            by.setdefault(r.path, set()).add(r.rep)
        seen.extend(frozenset(x) for x in by.values())
        return confirm(members, *rest)

    monkeypatch.setattr(N, "confirm", kept)
    texts = passage(6, 40) + family(9, 20, 2)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert result(N.find(docs)) == brute(list(enumerate(texts)))
    assert seen and len(seen) == len(set(seen))


def test_nodes_of_met_members_end(spark):
    """A large node of met members and one that has not met is not branched
    on and on, and its members come back to meet by rare shingles."""
    rows = [(i, 100, bytes(4 * N.COORDS)) for i in range(200)]
    classes = spark.createDataFrame(rows, "rep bigint, n bigint, sketch binary")
    met = spark.createDataFrame([(i,) for i in range(199)], "rep bigint")
    leaves, large = N.grow(classes, None, met, range(8), Scratch(spark, "test"), 16, 6)
    assert {r.rep for r in large.select("rep").distinct().collect()} == set(range(200))
    assert leaves.isEmpty() and large.count() <= 3 * 8 * 200


def test_sized(spark):
    rows = [(1, 10, 10, 100), (1, 11, 11, 117), (1, 12, 12, 30), (2, 10, 10, 100), (2, 12, 12, 30),
            (3, 10, 7, 100), (3, 11, 7, 100), (3, 12, 12, 30), (4, 13, 13, 17), (4, 14, 14, 20)]
    got = N.sized(spark.createDataFrame(rows, "path bigint, rep bigint, comp bigint, n bigint"))
    assert sorted((r.path, r.rep) for r in got.collect()) == [(1, 10), (1, 11), (4, 13), (4, 14)]


def test_merged(spark):
    """Links in portions give the components of all links."""
    r = random.Random(8)
    links, scratch = [(r.randrange(120), r.randrange(120)) for _ in range(90)], Scratch(spark, "test")
    stored = lambda x: scratch.save(spark.createDataFrame(x, "a bigint, b bigint"), "part")
    comp = None
    for i in (0, 45, 90):
        comp = merged(comp, stored(links[i:i + 45]), scratch)
    want = components(stored(links), scratch)
    assert sorted(comp.collect()) == sorted(want.select("node", "label").collect())
    assert merged(None, stored([]), scratch) is None
