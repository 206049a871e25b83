"""Language ID: probabilities against a plain Kneser-Ney, predictions by held-out accuracy."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_cases import clashing, documents, odd_documents, prose

from storepulse.llm import langid


def plain_grams(text):
    kept = "".join(c.lower() if c.isalpha() else " " for c in text)
    chars = " ".join(kept.split()) + " " if kept.strip() else " " if text else ""
    chars = (" " if kept[:1] == " " and kept.strip() else "") + chars
    padded = "   " + chars
    return [padded[i : i + 4] for i in range(len(chars))]


def key(gram):
    k = 0
    for ch in gram:
        k = k << 16 | ord(ch)
    return k


class PlainModel:
    def __init__(self, texts):
        self.tables = {}
        counts = Counter(g for t in texts for g in plain_grams(t))
        for size in (4, 3, 2, 1):
            n1, n2 = (sum(c == k for c in counts.values()) for k in (1, 2))
            d = min(max(n1 / max(1, n1 + 2 * n2), 0.1), 0.95)
            total, kinds = Counter(), Counter()
            for g, c in counts.items():
                total[g[:-1]] += c
                kinds[g[:-1]] += 1
            self.tables[size] = (counts, total, kinds, d)
            before = defaultdict(set)
            for g in counts:
                before[g[1:]].add(g[0])
            counts = Counter({g: len(s) for g, s in before.items()})

    def probability(self, gram, size=4):
        if size == 0:
            return 1 / 65536
        g = gram[-size:]
        counts, total, kinds, d = self.tables[size]
        lower = self.probability(gram, size - 1)
        if not total[g[:-1]]:
            return lower
        return max(counts[g] - d, 0) / total[g[:-1]] + d * kinds[g[:-1]] / total[g[:-1]] * lower


def test_grams_of_texts():
    texts = ["Ab, c", "", None, "  x", "ÉÀ-1", "a" * 10]
    found = {}
    for row, grams, bounds, letters in langid.gram_blocks(texts):
        for i in range(len(letters)):
            found[row + i] = (grams[bounds[i] : bounds[i + 1]].tolist(), int(letters[i]))
    for i, t in enumerate(texts):
        grams, letters = found[i]
        assert letters == sum(c.isalpha() for c in t or "")
        if letters and t[0].isalpha():
            assert grams == [key(g) for g in plain_grams(t)]


def test_long_text_goes_on_over_blocks(monkeypatch):
    text = prose(3, 400) + " end."
    whole = [g for _, g, _, _ in langid.gram_blocks([text])]
    monkeypatch.setattr(langid, "BLOCK", 100)
    parts = [g for _, g, _, _ in langid.gram_blocks([text])]
    assert len(parts) > 3
    assert np.concatenate(parts).tolist() == np.concatenate(whole).tolist()


def test_probabilities_match_plain_model(spark):
    texts = {"aa": [prose(i, 30) for i in range(4)], "bb": ["der die das " * 3 + prose(50, 20)]}
    rows = [(la, t) for la, ts in texts.items() for t in ts]
    df = spark.createDataFrame(rows, "lang string, text string")
    counts = df.mapInArrow(langid._count, "lang string, gram long, n long").groupBy("lang", "gram").sum("n")
    model = langid.build_model(langid.kneser_ney(counts.toDF("lang", "gram", "n")), ["aa", "bb"], 40)
    asked = sorted({g for ts in texts.values() for t in ts for g in plain_grams(t)} | {"xyzq", " zzz", "babü"})
    got = model.probability(np.array([key(g) for g in asked], np.uint64))
    for j, lang in enumerate(("aa", "bb")):
        plain = PlainModel(texts[lang])
        want = [plain.probability(g) for g in asked]
        assert got[:, j] == pytest.approx(want, rel=1e-9)
    shares = sum(PlainModel(texts["aa"]).probability("aba" + chr(c)) for c in range(65536))
    assert math.isclose(shares, 1, abs_tol=1e-6)


def language(seed, alphabet, n):
    return prose(seed, n).translate(str.maketrans("aeioubcdfg", alphabet))


def test_held_out_accuracy_and_roles(spark):
    alphabets = {"en": "aeioubcdfg", "de": "uaeiotkpbd", "fr": "éàôêèlmnrs"}
    rows = [(i, language(i, a, 25), la) for k, (la, a) in enumerate(alphabets.items()) for i in range(k * 200, k * 200 + 200)]
    rows += [(1001, "漢字かな交じり文" * 20, "en"), (1002, "12 .. 34", "en")]
    out = {r.doc_id: r for r in langid.identify(documents(spark, rows)).collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out.values())
    held = [(out[i].lang_pred, la) for i, _, la in rows[:600] if out[i].held_out]
    assert sum(a == b for a, b in held) / len(held) > 0.97
    assert not any(out[i].rejected for i, _, _ in rows[:600])
    assert out[1002].lang_pred == "und" and out[1002].score == 0 and out[1002].rejected
    assert all(0 <= r.score <= 1 for r in out.values())


def test_foreign_script_is_rejected(spark):
    rows = [(i, prose(i, 40), "en") for i in range(120)] + [(5000, "漢字かな交じり文を書く" * 30, None), (5001, None, "en")]
    kept = {r.doc_id for r in langid.recognised(documents(spark, rows)).collect()}
    assert kept == set(range(120))


def test_odd_and_clashing(spark):
    df = clashing(documents(spark, odd_documents()))
    out = langid.identify(df)
    assert out.count() == len(odd_documents())
    blank = {r.doc_id: r.lang_pred for r in out.collect() if r.doc_id in (1, 2, 3)}
    assert blank == {1: "und", 2: "und", 3: "und"}
    kept = langid.recognised(df)
    assert kept.columns == df.columns and {r.score for r in kept.collect()} <= {"own score"}


def test_empty_and_unlabelled(spark):
    assert langid.identify(documents(spark, [])).collect() == []
    out = langid.identify(documents(spark, [(1, "some text", None), (2, "more", None)])).collect()
    assert {r.lang_pred for r in out} == {"und"} and all(r.rejected for r in out)


def test_model_is_bounded_and_equal_under_other_partitionings(spark, monkeypatch):
    monkeypatch.setattr(langid, "MAX_CELLS", 300)
    monkeypatch.setattr(langid, "MIN_BITS", 4)
    rng = random.Random(3)
    counts = [(la, key("".join(rng.choice("abcdefgh") for _ in range(4))), rng.randint(1, 9)) for la in ("aa", "bb") for _ in range(400)]
    frame = spark.createDataFrame(sorted(set(counts)), "lang string, gram long, n long").groupBy("lang", "gram").sum("n")
    table = langid.kneser_ney(frame.toDF("lang", "gram", "n"))
    one, two = (langid.build_model(table.repartition(n), ["aa", "bb"]) for n in (1, 13))
    assert 4 <= one.bits < 24 and one.bits == two.bits
    for a, b in ((one.shares, two.shares), (one.weights, two.weights)):
        for size in a:
            assert (a[size][0] == b[size][0]).all() and (a[size][1] == b[size][1]).all()
    assert sum(v.size for part in (one.shares, one.weights) for _, v in part.values()) <= 300


def test_kneser_ney_groups_each_order_once(spark):
    """One exchange an order and no join, however few contexts there are: the driver plans and gathers little."""
    from storepulse.plans.session import explain_text

    counts = spark.createDataFrame([("aa", 0x61006200630064, 2), ("aa", 0x61006200630065, 1), ("bb", 0x61006200630064, 1)], "lang string, gram long, n long")
    table = langid.kneser_ney(counts)
    plan = explain_text(table, "simple")
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") <= langid.ORDER
    top = {(r.lang, r.kind, r.gram): r.value for r in table.filter("size = 4").collect()}
    # aa: counts 2 and 1, discount 1 / 3; bb: a single count of one, discount 0.95 at most
    assert top["aa", "a", 0x61006200630064] == pytest.approx((2 - 1 / 3) / 3) and top["aa", "a", 0x61006200630065] == pytest.approx((1 - 1 / 3) / 3)
    assert top["aa", "b", 0x6100620063] == pytest.approx(2 / 9) and top["bb", "b", 0x6100620063] == pytest.approx(0.95) and len(top) == 5
    assert langid.kneser_ney(counts.limit(0)).count() == 0
