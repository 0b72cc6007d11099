"""Operator 13 against whole-text encoding in plain Python."""

import hashlib
import os
from collections import Counter, defaultdict

import numpy as np
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from eddy.llm import alignment as A
from eddy.llm.common import Scratch, table

from . import helpers as H

TEXTS = ["plain words, twice plain", "Ünï 你好 x　  y é😀 😀", "two  spaces and\n\nlines \t tab ", " leading", "", None,
         "<|endoftext|> <s> </s>", "a▁b", "it's we'll 123 1e5 --- ...", "no break thin ​zero", "\n",
         " ", "x\x1cy \x1c z", "é combining ́ mark", "日本語のテキスト " * 5, "word " * 200, "\u0000 nul", "q" * 300]


def brute(rows):
    """``rows``: (doc_id, text); whole texts, no chunks."""
    t = Tokenizer.from_file(os.path.join(A.FOLDER, A.A_FILE))
    t.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=os.path.join(A.FOLDER, A.B_FILE))
    at = A.byte_chars()
    out, docs_of = [], Counter()
    for i, text in rows:
        raw = (" " + (text or "")).encode()
        a = t.encode(raw.decode(), add_special_tokens=False).ids
        b = sp.encode(text or "")
        ab = [bytes(at[c] for c in t.id_to_token(x)) for x in a]
        bb = [bytes([int(sp.id_to_piece(x)[3:5], 16)]) if sp.is_byte(x) else sp.id_to_piece(x).replace("▁", " ").encode()
              for x in b]
        if not text or b"".join(ab) != raw or b"".join(bb) != raw:
            out.append([i, 0, 0, 0, 0, [], ""])
            continue
        ends = lambda ts: [sum(map(len, ts[:k + 1])) for k in range(len(ts))]
        ea, eb = ends(ab), ends(bb)
        links = [(x, y) for x, p, q in zip(a, [0, *ea], ea) for y, r, s in zip(b, [0, *eb], eb) if max(p, r) < min(q, s)]
        groups, lo = [], 0
        for cut in sorted(set(ea) & set(eb)):
            pick = lambda ids, e: ",".join(str(x) for x, y in zip(ids, e) if lo < y <= cut)  # noqa: B023, E731
            groups.append(pick(a, ea) + "|" + pick(b, eb))
            lo = cut
        docs_of.update(set(links))
        out.append([i, len(a), len(b), len(groups), len(links), links, hashlib.sha256(";".join(groups).encode()).hexdigest()])
    best = defaultdict(int)
    for (x, _), n in docs_of.items():
        best[x] = max(best[x], n)
    return sorted(((i, na, nb, ng, nl, sum(docs_of[k] == best[k[0]] for k in ls), sum(docs_of[k] for k in ls), sha)
                   for i, na, nb, ng, nl, ls, sha in out), key=str)


def result(df):
    return sorted(((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256)
                   for r in df.collect()), key=str)


def test_odd_texts(spark):
    rows = list(enumerate(TEXTS)) + [(None, "plain words"), (3, "other text of an id"), (0, TEXTS[0])]
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id bigint, text string, rid string, keys int")
    assert result(A.align(docs)) == brute(rows)
    assert A.align(H.empty_documents(spark)).count() == 0


def test_table(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents").where(F.length("text") < 4000)
    assert result(A.align(docs)) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_shuffled_counts(spark, monkeypatch):
    """Beyond the bound of a broadcast the counts come by shuffle."""
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string")
    monkeypatch.setattr(A, "join_counted", lambda big, small, on: big.join(small, on))
    assert result(A.align(docs)) == brute(list(enumerate(TEXTS)))


def test_ends(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string")
    for r in Scratch(spark, "test").save(A.groups(docs, ends=True), "ends").collect():
        raw = (" " + (TEXTS[r.doc_id] or "")).encode()
        assert (r.a_ends[-1], r.b_ends[-1]) == (len(raw), len(raw)) if r.n_a else not r.a_ends
        assert len(r.a_ends) == r.n_a and len(r.b_ends) == r.n_b and sorted(set(r.a_ends)) == r.a_ends


def test_vocabulary_bytes():
    p = A.Pair(os.path.join(A.FOLDER, A.A_FILE), os.path.join(A.FOLDER, A.B_FILE))
    assert p.cut and len(A.byte_chars()) == 256 and sorted(A.byte_chars().values()) == list(range(256))
    assert p.chunks("a b  c\n d ") == ["a", "b  c\n d "]
    assert A.cuts("é".encode(), np.array([(0, 2), (0, 2)]), [b"\xc3", b"\xa9"]).tolist() == [1, 2]
    assert A.cuts(b"ab", np.array([(0, 1), (1, 2)]), [b"a", b"c"]) is None
    whole = p.align(["one", "two", "a▁b", "three é"])
    assert whole[2] is None and whole[:2] + whole[3:] == [p.align([c])[0] for c in ("one", "two", "three é")]


def test_byte_offsets_of_characters_of_any_width():
    text = "aé€\U0001f600​ b"
    want = [len(text[:i].encode()) for i in range(len(text) + 1)]
    assert A.byte_offsets(text).tolist() == want
    assert A.byte_offsets("").tolist() == [0]
    assert [A._blank(c) for c in (" ", " ", "᠎", "​", "﻿", "\x1c", "x")] == [True] * 6 + [False]


def test_groups_as_text():
    """Tokens of both sides in their groups, A's first, with their marks."""
    p = A.Pair(f"{A.FOLDER}/{A.A_FILE}", f"{A.FOLDER}/{A.B_FILE}")
    at = p.in_groups(np.array([5, 6, 7, 8]), np.array([1, 2, 3]), np.array([2, 3, 4]), np.array([1, 2, 3]))
    assert "".join(p.marked[i] for i in at.tolist()) == "5,6|1;7|2;8|3;"
    at = p.in_groups(np.array([5]), np.array([1, 2, 3]), np.array([1]), np.array([3]))
    assert "".join(p.marked[i] for i in at.tolist()) == "5|1,2,3;"
