"""Operator 3 against a plain search for the base phrases."""

from eddy.llm import licenses as L

from . import helpers as H


def brute(text):
    w, places, labels = H.words(text), [], set()
    for phrase, label in L.PHRASES:
        p = phrase.split()
        for i in range(len(w) - len(p) + 1):
            if w[i:i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return (len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)))


def check(spark, docs):
    got = sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)
                  for r in L.scan(docs).collect()), key=str)
    assert got == sorted(((r.doc_id, *brute(r.text)) for r in docs.collect()), key=str)


EXTRA = [
    (20, "MIT License mit license, MIT license; gpl: General Public License", "en", "s", 1, "", "", ""),
    (21, "the Apache\nLicense. general public licens", "en", "s", 1, "", "", ""),
    (22, "mit", "en", "s", 1, "", "", ""),
    (23, "mit license", "en", "s", 1, "", "", ""),
    (23, "mit license", "en", "s", 1, "", "", ""),
]


def test_base(spark):
    check(spark, H.documents(spark))
    check(spark, H.odd_documents(spark, EXTRA))
    assert L.scan(H.empty_documents(spark)).count() == 0


def test_notices_with_changes(spark):
    text = dict(L.NOTICES)["bsd-text"]
    changed = text.replace("with or without", "with, or perhaps without").replace("are met", "hold")
    docs = spark.createDataFrame([(1, f"some words before {text} and after"), (2, f"before {changed} after"),
                                  (3, " ".join(reversed(text.split()))), (4, "All rights reserved."),
                                  (5, "Licensed under CC BY-NC 4.0.")], "doc_id bigint, text string")
    got = {r.doc_id: (r.labels, r.score) for r in L.scan(docs).collect()}
    assert got[1] == ("bsd-text", 1.0)
    assert got[2][0] == "bsd-text" and 0.6 <= got[2][1] < 1
    assert got[3] == ("", 0.0) and got[4][0] == "all-rights-reserved" and got[5][0] == "cc"


def test_long_template(spark):
    words = [f"w{i}" for i in range(200)]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words[:100]))], "doc_id bigint, text string")
    got = {r.doc_id: r for r in L.scan(docs, [(" ".join(words), "long", False)]).collect()}
    assert got[1].labels == "long" and got[1].score == 1.0 and got[2].labels == ""


def plain(text):
    """``(labels, score)``: the method's rules, template by template."""
    w, found = H.words(text), []
    for template, label, base in L.TEMPLATES:
        t = H.words(template)
        k = 4 if len(t) >= 4 else 2
        grams, need = [tuple(t[i:i + k]) for i in range(len(t) - k + 1)], len(t) - k + 1
        diags = {}
        for i in range(len(w) - k + 1):
            for j, g in enumerate(grams):
                if g == tuple(w[i:i + k]):
                    diags.setdefault(i - j, []).append((i, j))
        count = lambda hits: len({j for _, j in hits})
        left = {}
        for d, hits in diags.items():
            if count(hits) == need if base else count(hits) >= L.COVER * need:
                found.append((label, count(hits) / need))
            elif not base:
                left[d] = hits
        width = max(L.DRIFT + 1, -(-need // 2))
        for shift in (0, width // 2):
            groups, last, island = {}, None, 0
            for d in sorted(left):
                island += last is not None and d - last > L.DRIFT
                last = d
                groups.setdefault((island, (d + shift) // width), []).extend(left[d])
            for hits in groups.values():
                span = max(i for i, _ in hits) - min(i for i, _ in hits)
                if count(hits) >= L.COVER * need and span < 1.5 * need + L.DRIFT:
                    found.append((label, count(hits) / need))
    return ",".join(sorted({x for x, _ in found})), max((c for _, c in found), default=0.0)


def test_labels_and_score_equal_plain(spark):
    text = dict(L.NOTICES)["bsd-text"]
    extra = ["All rights reserved. All rights reserved. All rights reserved.", "rights reserved rights reserved",
             text.replace("with or without", "with, or perhaps without").replace("are met", "hold"), f"{text} {text}",
             " ".join(x for i, x in enumerate(text.split()) if i % 5), "all rights " * 30, "rights reserved " * 30]
    docs = H.documents(spark).select("doc_id", "text").union(
        spark.createDataFrame([(10**6 + i, t) for i, t in enumerate(extra)], "doc_id bigint, text string"))
    got = {r.doc_id: (r.labels, r.score) for r in L.scan(docs).collect()}
    assert got[10**6] == ("all-rights-reserved", 1.0) and got[10**6 + 1] == ("", 0.0)
    for r in docs.collect():
        want = plain(r.text)
        assert got[r.doc_id][0] == want[0] and abs(got[r.doc_id][1] - want[1]) < 1e-9, r.doc_id
