"""Conversation repair against exhaustive search and a program over whole strings."""

import hashlib
import random
import zlib
from itertools import product

import pytest

from storepulse.llm import conversations as C

SCHEMA = "conv_id long, turn long, role string, text string"
BLANKS = " \t\n\x0b\x0c\r"


def faults(rows):
    """(blank, duplicate, truncated) of each (role, text) in order."""
    seen, out = set(), []
    for role, text in rows:
        bare = text.rstrip(BLANKS)
        blank = not bare
        again = not blank and (role, text) in seen
        seen.add((role, text))
        out.append((blank, again, not blank and not again and bare[-1] not in ".!?"))
    return out


def legal(initials):
    body = initials.removeprefix("s")
    return not initials or (len(body) >= 2 and len(body) % 2 == 0 and set(zip(body[::2], body[1::2])) == {("u", "a")})


def exhaustive(rows):
    """(cost, audit) by trying every sequence of edits with up to two insertions in a gap."""
    marks, best = faults(rows), None
    inserts = [(), ("u",), ("a",), ("u", "a"), ("a", "u")]
    edits = [[("D", "")] if b or d else [("D", ""), ("K", r[:1] or "?"), ("R", "u"), ("R", "a")] for (r, _), (b, d, _) in zip(rows, marks, strict=True)]
    for gaps in product(inserts, repeat=len(rows) + 1):
        for chosen in product(*edits):
            cost, audit, initials = 2 * len(gaps[0]), "I" * len(gaps[0]), "".join(gaps[0])
            for (e, role), (_, _, cut), gap in zip(chosen, marks, gaps[1:], strict=True):
                cost += {"D": 3, "K": 0, "R": 2}[e] + (cut and e != "D") + 2 * len(gap)
                audit += e + "I" * len(gap)
                initials += role + "".join(gap)
            if (best is None or (cost, audit) <= best) and legal(initials):
                best = cost, audit
    return best


def over_strings(rows):
    """(cost, audit) by a program whose states hold whole strings."""
    def close(b):
        for to, frm in ((2, (0, 1, 3)), (3, (2,))):
            b[to] = min([x for x in (b.get(to), *((b[s][0] + 2, b[s][1] + "I") for s in frm if s in b)) if x])
        return b

    best = close({0: (0, "")})
    for (role, _), (blank, again, cut) in zip(rows, faults(rows), strict=True):
        new = {s: [(c + 3, a + "D")] for s, (c, a) in best.items()}
        if not blank and not again:
            for s, (c, a) in best.items():
                if s == 0 and role[:1] == "s":
                    new.setdefault(1, []).append((c + cut, a + "K"))
                to = 3 if s == 2 else 2
                keep = role[:1] == ("a" if s == 2 else "u")
                new.setdefault(to, []).append((c + cut, a + "K") if keep else (c + cut + 2, a + "R"))
        best = close({s: min(v) for s, v in new.items()})
    return min(best[0], best[3])


def some_rows(rng, n):
    texts = ["Yes.", "No", "", " \n", "Why?", "cut off", "Well! ", "ok."]
    return [(rng.choice(["user", "assistant", "system", "user", "assistant", "tool", " "]), rng.choice(texts)) for _ in range(n)]


def repaired(rows):
    r, edits, seen = C.Repair(), [], set()
    for i, (role, text) in enumerate(rows):
        edits += r.add(i, role, text, (role, text) in seen)
        seen.add((role, text))
    edits += r.end()
    return r, edits


@pytest.mark.parametrize("mod", [C._MOD, 3])
def test_cheapest_edits_by_exhaustive_search(monkeypatch, mod):
    monkeypatch.setattr(C, "_MOD", mod)  # with three hashes, nearly all collide
    rng = random.Random(4)
    for n in (0, 1, 1, 2, 2, 2, 3, 3, 3, 3, 3):
        rows = some_rows(rng, n)
        r, edits = repaired(rows)
        audit = "".join(e[0] for e in edits)
        assert (r.cost, audit) == exhaustive(rows), rows
        assert legal("".join(role[:1] for e, _, role, _ in edits if e != "D"))
        marks = faults(rows)
        assert (r.blank, r.duplicate, r.truncated) == tuple(sum(m[i] for m in marks) for i in range(3))


@pytest.mark.parametrize("mod", [C._MOD, 5])
@pytest.mark.parametrize("pending", [1, 7, 256])
def test_long_conversations_with_prefixes_put_out_early(monkeypatch, mod, pending):
    monkeypatch.setattr(C, "_MOD", mod)
    monkeypatch.setattr(C, "_PENDING", pending)
    rng = random.Random(8)
    for n in (5, 60, 700):
        for flaw in (0.1, 0.6):
            rows = [
                (("user", "assistant")[i % 2], f"t{i}.") if rng.random() > flaw else (rng.choice(["user", "assistant", "system", "tool"]), rng.choice([f"c{i}", f"d{i}.", ""]))
                for i in range(n)
            ]
            r, edits = repaired(rows)
            assert (r.cost, "".join(e[0] for e in edits)) == over_strings(rows)


def test_texts_are_held_for_undecided_rows_only():
    r, most = C.Repair(), 0
    for i in range(20_000):
        r.add(i, ("user", "assistant")[i % 2], f"t{i}.", False)
        most = max(most, len(r._pending))
    assert most <= C._PENDING


def by_hand(rows):
    """conv_id -> result columns of op12 after the damage, in plain Python."""
    out = {}
    for conv in {r[0] for r in rows}:
        left, turns = [], []
        for c, turn, role, text in rows:
            if c != conv:
                continue
            role, text = " " if role is None else role, " " if text is None else text
            h = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
            if h:
                text = "" if h == 1 else text.translate({ord(x): None for x in ".!?"}) if h == 2 else text
                left += [(turn, "user" if h == 4 else role, text)] * (1 + (h == 3))
        left.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        turns = {t for t, _, _ in left if t is not None}
        pairs = [r[1:] for r in left]
        cost, audit = over_strings(pairs)
        i, last, said = 0, "", []
        for e in audit:
            role, text = ("", "") if e == "I" else pairs[i]
            i += e != "I"
            if e != "D":
                role = role if e == "K" else "assistant" if last == "u" else "user"
                last = role[0]
                said.append(f"{role}:{text}")
        marks = faults(pairs)
        ill = sum((a[0][:1] + b[0][:1]) not in ("su", "ua", "au") for a, b in zip(pairs, pairs[1:]))
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out[conv] = (gaps, *(sum(m[k] for m in marks) for k in range(3)), ill, cost, audit, hashlib.sha256("\n".join(said).encode()).hexdigest())
    return out


def odd_conversations():
    rng = random.Random(2)
    rows = [(c, t, *some_rows(rng, 1)[0]) for c in range(60) for t in rng.sample(range(12), rng.randint(1, 9))]
    rows += [(70, None, "user", "Hi."), (70, None, "user", "Hi."), (70, 3, None, None), (70, 9, "assistant", "Ünï 😀.")]
    rows += [(None, 0, "user", "Null."), (None, None, "assistant", "Null.")]
    rows += [(71, 0, "user", "Copy."), (71, 0, "user", "Copy."), (71, 1, "assistant", "x" * 300_000), (72, -5, "assistant", "One."), (72, 9, "user", "Two.")]
    rows += [(73, t, ("user", "assistant")[t % 2], f"t{t % 40}.") for t in range(900)]  # repeats earlier rows
    return rows


def test_query_form_equals_plain_python(spark):
    rows = odd_conversations()
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as present", "1 as kind", "2 as copy", "3 as repeated").repartition(7)
    out = C.repair(C.damaged(df), C.F.col("present"))
    got = {r.conv_id: tuple(r)[1:] for r in out.collect()}
    assert got == by_hand(rows)


def test_every_row_dropped_leaves_its_conversation(spark):
    turn = next(t for t in range(500) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    out = C.repair(C.damaged(spark.createDataFrame([(5, turn, "user", "Hi.")], SCHEMA)), C.F.col("present")).collect()
    assert [tuple(r) for r in out] == [(5, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_repaired_turns_are_what_the_summary_digests(spark):
    rows = odd_conversations()
    df = spark.createDataFrame(rows, SCHEMA)
    turns = C.repaired_turns(df).collect()
    for r in C.repair(df).collect():
        mine = sorted((t for t in turns if t.conv_id == r.conv_id), key=lambda t: t.step)
        assert [t.step for t in mine] == list(range(len(r.audit))) and "".join(t.edit for t in mine) == r.audit
        whole = "\n".join(f"{t.role}:{t.text}" for t in mine if t.edit != "D")
        assert hashlib.sha256(whole.encode()).hexdigest() == r.repaired_sha256


def test_other_keys_and_empty_table(spark):
    df = spark.createDataFrame([("x", 0, "user", "Hi.")], SCHEMA.replace("conv_id long", "conv_id string"))
    assert [(r.conv_id, r.audit) for r in C.repair(df).collect()] == [("x", "KI")]
    assert C.repair(C.damaged(spark.createDataFrame([], SCHEMA)), C.F.col("present")).collect() == []
