"""Phrase collocations against plain counting."""

import re
from collections import Counter

import pytest
from llm_cases import clashing, documents, odd_documents, prose

from storepulse.llm import collocations


def plain(rows, least, top, covered=50):
    f = {}
    for text, lang in rows:
        of = f.setdefault(lang or "und", Counter())
        lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            w = re.findall(r"[^\x20\x09]+", piece)
            of.update(tuple(w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    out = []
    for lang, of in f.items():
        n = sum(c for g, c in of.items() if len(g) == 1)
        found = []
        for g, a in of.items():
            if len(g) < 2 or a < least:
                continue
            longer = [c for h, c in of.items() if len(h) == 3 and len(g) == 2 and c >= least and g in (h[:2], h[1:])]
            if any(100 * c >= covered * a for c in longer):
                continue
            score, cut = min((1_000_000 * a * a // (of[g[:k]] * of[g[k:]]), k) for k in range(1, len(g)))
            found.append((-score, -a, " ".join(g).encode(), cut, of[g[:cut]], of[g[cut:]]))
        for rank, (s, a, phrase, cut, le, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, cut, le, r, n, -s))
    return sorted(out)


def rows_of(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("trigger", [1, 3, collocations.TRIGGER, 1 << 40])
def test_equals_plain_counting(spark, trigger):
    rows = [*odd_documents(), (20, "A a A a, a a\ta  a. B! " * 40, "und"), (21, "x y z;x y z:x y\nx y z\r\nz\x0by\x0c" * 9, None)]
    rows += [(30 + i, "the same shared line of words stands here, " + prose(i % 4, 25), "en") for i in range(40)]
    docs = clashing(documents(spark, rows)).repartition(5)
    want = plain([(r[1], r[2] if len(r) > 2 else None) for r in rows], 5, 60)
    assert rows_of(collocations.collocations(docs, 5, 60, trigger=trigger)) == want
    assert {r[0] for r in want} >= {"en", "und"} and any(r[2].count(" ") == 2 for r in want)


def test_parts_overlap_in_one_window_and_cover_each_place_once():
    words = prose(3, 500).encode().split()
    for trigger in (1, 2, 7):
        at, cut = 0, list(collocations.parts(words, trigger))
        for part, own in cut:
            assert words[at : at + len(part)] == part and (len(part) == own + 2 or at + own == len(words))
            at += own
        assert at == len(words)
    ended = {b" ".join(p) for p, own in collocations.parts(words, 2) if len(p) > own}
    assert not any(a != b and b.startswith(a + b" ") for a in ended for b in ended)


def test_copies_meet_in_the_dictionary(spark):
    text = prose(9, 400)
    docs = documents(spark, [(i, text, "en") for i in range(50)])
    one = documents(spark, [(0, text, "en")])
    once = {(r.part, r.own): r.n for r in collocations.dictionary(one).collect()}
    assert {(r.part, r.own): r.n for r in collocations.dictionary(docs).collect()} == {k: 50 * n for k, n in once.items()}


def test_counts_beyond_64_bits_stay_exact(spark):
    big = 9_000_000_000_000
    grams = spark.createDataFrame([("en", "a", 1, big), ("en", "b", 1, big + 1), ("en", "a b", 2, big - 1)], "lang string, gram string, k int, n long")
    row = collocations.scored(grams).first()
    assert row.score == 1_000_000 * (big - 1) ** 2 // (big * (big + 1))


def test_empty(spark):
    assert collocations.collocations(documents(spark, [])).collect() == []
    assert collocations.collocations(documents(spark, [(1, None, None), (2, "", "en"), (3, " .\n", "de")])).collect() == []
