"""The rule ledger against plain Python."""

import re
from collections import Counter

from llm_cases import clashing, documents, odd_documents, prose

from storepulse.llm import quality_rules as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    count = Counter(windows)
    hit = {p for i, w in enumerate(windows) if count[w] > 1 for p in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    letters = [c for c in text if c > "\x7f" or c.isalpha()]
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(hit),
        "n_letters": len(letters), "n_capitals": sum("A" <= c <= "Z" for c in letters), "n_shouts": text.count("!") + text.count("?"),
        "n_plain_words": sum(any(c > "\x7f" or c.isalpha() for c in w) for w in words),
    }


def cases():
    line = "one two three four five six seven eight nine"
    return [
        *odd_documents(), (20, "\n".join([line] * 6) + "\r\n" + line + "\x0b\x0c\x1c x"), (21, "a b c d e f g h " * 9), (22, "# $ | < > & % * " * 30),
        (23, "ALL!! IN CAPITALS!! AND!! LOUD!! " * 30), (24, "1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16 17 18 19 20 21"), (25, "x " * 19), (26, prose(6, 20)),
        (27, prose(6, 100) + " " + " ".join(prose(6, 100).split()[:40])), (28, "Word word Word word Word word Word word Word Word"), (29, "ä" * 400),
    ]


def test_ledger_equals_plain_python(spark):
    rows = cases()
    out = Q.apply_policy(Q.ledger(clashing(documents(spark, rows)).drop("keep").withColumn("N_WORDS", Q.F.lit("own")))).collect()
    key = lambda v: sorted(map(str, v))
    assert len(out) == len(rows)
    want = []
    for doc_id, text, *_ in rows:
        m = plain(text)
        fails = sum(Q.BIT[r.name] for r in Q.RULES if eval(r.fails, {}, m))  # the rules' SQL is Python too
        hard = fails & sum(Q.BIT[r] for r in Q.CURRENT.must)
        soft = fails & sum(Q.BIT[r] for r in Q.CURRENT.may)
        want.append((doc_id, *m.values(), fails, not hard and soft.bit_count() <= Q.CURRENT.spare))
    assert key((r.doc_id, *(r[m] for m in Q.MEASURES), r.fails, r.kept) for r in out) == key(want)
    assert all(r.taken == "own taken" for r in out)
    seen = 0
    for w in want:
        seen |= w[-2]
    assert seen.bit_count() == len(Q.RULES)


def test_base_follows_the_first_policy(spark):
    out = Q.ledger(documents(spark, cases())).select("*", Q.base_failed().alias("base")).collect()
    assert all(r.base == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words) for r in out)
    assert {r.base for r in out} == {True, False}


def test_ablations_equal_policies_without_the_rule(spark):
    rows = Q.ledger(documents(spark, cases())).select("fails")
    bits = [r.fails for r in rows.collect()]

    def goes(f, policy, off=0):
        f &= ~off
        return bool(f & policy.mask(policy.must)) or (f & policy.mask(policy.may)).bit_count() > policy.spare

    out = Q.ablations(rows).collect()
    assert len(out) == sum(len(p.must | p.may) for p in Q.POLICIES)
    by = {p.version: p for p in Q.POLICIES}
    for r in out:
        p, off = by[r.policy], Q.BIT[r.rule]
        stay = [not goes(f, p) for f in bits]
        stay_off = [not goes(f, p, off) for f in bits]
        assert (r.n_rows, r.n_failing, r.n_kept) == (len(bits), sum(bool(f & off) for f in bits), sum(stay))
        assert (r.n_kept_without, r.n_alone) == (sum(stay_off), sum(b and not a for a, b in zip(stay, stay_off, strict=True)))


def test_policies_of_ever_more_rules_keep_ever_fewer(spark):
    rows = Q.ledger(documents(spark, cases()))
    kept = [Q.apply_policy(rows, p).filter("kept").count() for p in Q.POLICIES]
    assert kept == sorted(kept, reverse=True) and kept[0] > kept[-1]


def test_empty(spark):
    rows = Q.ledger(documents(spark, []))
    assert Q.apply_policy(rows).collect() == [] and Q.ablations(rows).collect() == []
