"""N-gram Jaccard join against all pairs in plain Python."""

import random

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from llm_cases import clashing, documents, odd_documents, prose, shingle_set

from storepulse.llm import ngram_join as nj
from storepulse.llm import shingles
from storepulse.llm.components import components


def brute(rows, percent=90):
    """{(row number): (n, component)} by comparing all pairs."""
    sets = [shingle_set(r[1]) for r in rows]
    label = list(range(len(rows)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                label[find(i)] = find(j)
    lowest = {}
    for i, r in enumerate(rows):
        k = find(i)
        if r[0] is not None:
            lowest[k] = min(r[0], lowest.get(k, r[0]))
    return sorted(((r[0], len(sets[i]), lowest.get(find(i))) for i, r in enumerate(rows)), key=str)


def joined(df, **params):
    out = nj.ngram_join(df, **params).select("doc_id", "n_shingles", "component_id").collect()
    return sorted((tuple(r) for r in out), key=str)


def near_copies(seed, groups=6, copies=12, words=120):
    rng, rows, doc = random.Random(seed), [], 0
    for g in range(groups):
        base = prose(1000 * seed + g, rng.randint(9, words)).split()
        for _ in range(copies):
            words_ = list(base)
            for _ in range(rng.randint(0, 4)):
                words_[rng.randrange(len(words_))] = f"edit{rng.randrange(30)}"
            rows.append((doc, " ".join(words_)))
            doc += 1
    rng.shuffle(rows)
    return rows


def test_odd_documents(spark):
    rows = odd_documents()
    assert joined(documents(spark, rows)) == brute(rows)


@pytest.mark.parametrize("rare,few", [(8, 8), (0.01, 8), (8, 1)])
def test_near_copies_with_and_without_combinations(spark, monkeypatch, rare, few):
    # rare=0.01 puts every shingle into the frequent classes, so that only combinations are indexed
    # few=1 sends every signature by its pivot first
    monkeypatch.setattr(nj, "FEW", few)
    rows = near_copies(3) + [(900 + i, prose(i, 200)) for i in range(20)]
    assert joined(documents(spark, rows), rare=rare, very=4, sketch_bits=12) == brute(rows)


def test_other_threshold(spark):
    rows = near_copies(5, groups=4)
    assert joined(documents(spark, rows), percent=80, rare=0.1, sketch_bits=10) == brute(rows, 80)


def test_chain_of_links(spark):
    base = prose(77, 100).split()
    rows = []
    for i in range(12):  # each changes one more word, so only neighbours link
        base[5 * i] = f"new{i}"
        rows.append((100 - i, " ".join(base)))
    want = brute(rows)
    assert len({c for _, _, c in want}) == 1
    assert joined(documents(spark, rows)) == want


def test_empty_table(spark):
    assert joined(documents(spark, [])) == []


def test_signatures_meet_for_every_linked_pair():
    rng = np.random.default_rng(2)
    levels = rng.integers(0, 12, 1 << 10).astype(np.uint8)
    for n in (9, 10, 25, 60, 64, 127, 400):
        for _ in range(60):
            x = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2) + np.uint64(1))
            y = x.copy()
            lose = rng.integers(0, max(1, n // 19) + 1)
            y = np.unique(np.concatenate((rng.permutation(y)[lose:], rng.integers(0, 1 << 63, rng.integers(0, n // 20 + 1)).astype(np.uint64))))
            both = len(np.intersect1d(x, y))
            if 100 * both < 90 * (len(x) + len(y) - both) or len(x) == both == len(y):
                continue
            for limits in ((4, 8), (0, 99), (0, 0)):
                a = nj.signatures(x, levels, limits, 90)
                b = nj.signatures(y, levels, limits, 90)
                assert len(np.intersect1d(a[0], b[0])), (n, limits)


def test_shingle_hashes_follow_words():
    texts = ["A b  c d", "a B c\td", None, "", "a b", "A  B", "one", prose(9, 90_000) + " Tail end here", "a b c d"]
    found = {}
    for row, hashes, starts, ends in shingles.shingle_blocks(pa.array(texts)):
        for i, (a, b) in enumerate(zip(starts, ends)):
            found[row + i] = set(hashes[a:b].tolist())
    sizes = [len(found[i]) for i in range(len(texts))]
    assert sizes == [len(shingle_set(t)) for t in texts]
    assert found[0] == found[1] == found[8] and found[4] == found[5] and found[4] != found[6]


def test_components(spark):
    rng = random.Random(4)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(0, i) for i in range(300, 600)] + [(i, i + 1) for i in range(1000, 1060)]
    label = {x: x for e in links for x in e}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    got = dict(components(spark.createDataFrame(links, "u long, v long")).collect())
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: label[x] for x in linked}


def test_pipeline_stage_drops_copies_between_the_thresholds(spark):
    rows = []
    for g in range(8):  # one word of 55 changed: 0.82 on five words, 0.89 on three; two far apart: 0.67 on five
        base = prose(500 + g, 55).split()
        one, two = list(base), list(base)
        one[27] = f"edit{g}"
        two[13], two[41] = f"left{g}", f"right{g}"
        rows += [(10 * g, " ".join(base)), (10 * g + 1, " ".join(one)), (10 * g + 2, " ".join(two))]
    rows += [(100, prose(600, 40)), (101, prose(600, 40).replace(prose(600, 40).split()[20], "other", 1))]
    jaccard = lambda a, b: len(a & b) / len(a | b)
    sets, thin = ({i: shingle_set(t, width) for i, t in rows} for width in (5, 3))
    near = [(a, b) for a in sets for b in sets if a < b and jaccard(sets[a], sets[b]) >= 0.8]
    between = [(a, b) for a, b in near if jaccard(thin[a], thin[b]) < 0.9]
    assert len(between) >= 8
    kept = {r.doc_id for r in corpus_pipeline.keep_one_of_each(spark, documents(spark, rows), "").collect()}
    assert kept == set(sets) - {b for _, b in near} and {2, 100, 101} <= kept


def test_one_of_each_keeps_columns(spark):
    # 7 equals 6, 8 stands twice and links with 9
    df = clashing(documents(spark, odd_documents()))
    kept = nj.one_of_each(df)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, [None, 1, 2, 3, 4, 5, 6, 8, 10]))


def fillings(seed, members, words, edits):
    """One template with so many words replaced by ones of its own in each member, and some copies of members."""
    rng, base, rows = random.Random(seed), prose(seed, words).split(), []
    for doc in range(members):
        own = list(base)
        for at in rng.sample(range(words), edits):
            own[at] = f"own{doc}x{at}"
        rows.append((doc, " ".join(own)))
    for doc in range(0, members, 9):  # within reach of one member only
        rows.append((members + doc, rows[doc][1] + " tail"))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("edits", [2, 4, 5])
def test_templates_around_the_threshold(spark, monkeypatch, edits):
    monkeypatch.setattr(nj, "SMALL", 8)
    rows = fillings(edits, 80, 150, edits)
    assert joined(documents(spark, rows)) == brute(rows)


def test_template_below_the_threshold_offers_few_pairs(spark, monkeypatch):
    offered = []
    plain = nj._across_large
    monkeypatch.setattr(nj, "_across_large", lambda *a: offered.append(plain(*a)) or offered[-1])
    rows = fillings(5, 120, 150, 5)
    assert joined(documents(spark, rows)) == brute(rows)
    assert offered[0].count() <= 2 * len(rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_fillings_of_one_template_that_share_some(spark, monkeypatch, seed):
    """Members lie around the threshold; all signatures are large, so links off the pivot are found by differences alone."""
    monkeypatch.setattr(nj, "FEW", 1)
    monkeypatch.setattr(nj, "SMALL", 1)
    rng, base = random.Random(seed), prose(seed, 150).split()
    pool, rows = [(at, f"fill{k}") for k, at in enumerate(rng.sample(range(150), 30))], []
    for doc in range(90):
        own = list(base)
        for at, word in rng.sample(pool, rng.choice((2, 3, 4))):
            own[at] = word
        rows.append((doc, " ".join(own)))
    assert joined(documents(spark, rows)) == brute(rows)
    without = nj._across_large
    monkeypatch.setattr(nj, "_across_large", lambda *a: without(*a).limit(0))
    assert joined(documents(spark, rows)) != brute(rows)


@pytest.mark.parametrize("percent", [80, 90])
def test_signatures_of_frequent_shingles_grow_with_what_a_partner_may_lack(percent):
    # a large group of near copies makes all its shingles very frequent; combinations of all of a long prefix were several times as many
    rng = np.random.default_rng(3)
    levels = np.full(1 << 10, 9, np.uint8)
    for n in (60, 64, 127, 146, 250, 400, 1000):
        most, n_of = n - nj._needed(n, percent), []
        for _ in range(5):
            x = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2) + np.uint64(1))
            lose = rng.integers(0, most // 2 + 1)
            y = np.unique(np.concatenate((rng.permutation(x)[lose:], rng.integers(0, 1 << 63, lose).astype(np.uint64))))
            for limits in ((4, 99), (4, 8)):
                a, b = (nj.signatures(s, levels, limits, percent)[0] for s in (x, y))
                n_of.append(len(a))
                both = len(np.intersect1d(x, y))
                if 100 * both >= percent * (len(x) + len(y) - both):
                    assert len(np.intersect1d(a, b)), (n, limits)
        assert np.mean(n_of) <= 30 * (most + 1), n


def test_members_off_the_pivot_find_each_other_and_the_pivots_component(spark, monkeypatch):
    """Half of the members link with the pivot; others link only with members, of the pivot's component or of none."""
    monkeypatch.setattr(nj, "FEW", 1)
    monkeypatch.setattr(nj, "SMALL", 1)
    base, rows = prose(41, 150).split(), []
    for doc in range(60):
        own = list(base)
        for at in range(0, 150, 50 if doc % 3 else 30):
            own[at + doc % 7] = f"fill{doc % 5}x{at}"
        own[149 - doc % 11] = f"last{doc}"
        rows.append((doc, " ".join(own)))
    homes = []
    plain = nj.staged
    monkeypatch.setattr(nj, "staged", lambda df, name: (out := plain(df, name), homes.append(out) if name == "join-lists" else None)[0])
    want = brute(rows)
    assert joined(documents(spark, rows)) == want and 1 < len({c for _, _, c in want}) < 60
    assert {r.home for r in homes[0].select("home").distinct().collect()} == {True, False}


def test_postings_are_written_once_and_packed(spark, monkeypatch):
    """Texts of their own share hardly a signature: these are written once, and no row a signature is."""
    plain, written = nj.staged, {}
    monkeypatch.setattr(nj, "staged", lambda df, name: written.setdefault(name, plain(df, name)))
    rows = [(i, prose(5000 + i, 300)) for i in range(60)] + [(60 + i, prose(5000 + i, 300)) for i in range(20)]
    assert joined(documents(spark, rows)) == brute(rows)
    signed = [df for df in written.values() if "sigs" in df.columns]
    assert len(signed) == 1 and 60 <= signed[0].count() < 80  # exact copies don't come again, but for those the filter lets through
    postings = sum(len(r.sigs) for r in signed[0].select("sigs").collect())
    assert written["join-met"].count() < postings / 10


def test_packed_postings_meet_as_they_are():
    rng = np.random.default_rng(9)
    nodes, n, parts, percent, few = 80, rng.integers(60, 100, 80).astype(np.int32), 3, 80, 4
    pool = rng.integers(0, 1 << 63, 300).astype(np.uint64) * np.uint64(2)
    sigs = [np.unique(np.append(rng.choice(pool, 12), pool[:1] if i % 2 else pool[1:2])) for i in range(nodes)]
    places = [rng.integers(0, 20, len(s)).astype(np.int32) for s in sigs]
    ids = np.arange(nodes) + (np.arange(nodes) % 3 << 33)
    lists = [nj._lists(sigs, np.int64, pa.int64()), nj._lists(places, np.int32, pa.int32())]
    batch = pa.RecordBatch.from_arrays([pa.array(ids), pa.array(n), *lists], names=["node", "n", "sigs", "places"])
    dealt = pa.Table.from_batches(nj._dealt(parts)(iter([batch.slice(0, 30), batch.slice(30)])))
    met = pa.concat_tables(nj._met(percent, few)(dealt.filter(pa.array(dealt["part"].to_numpy() == p))) for p in range(parts)).to_pylist()

    members = {}
    for i in range(nodes):
        for s, place in zip(sigs[i].tolist(), places[i].tolist()):
            members.setdefault(s, []).append((int(ids[i]), int(n[i]), place))
    pairs, many = set(), []
    for s, of in members.items():
        if len(of) > few:
            many += [(len(of), *m) for m in of]
            continue
        for x in of:
            for y in of:
                need = -(-(x[1] + y[1]) * percent // (100 + percent))
                near = 100 * min(x[1], y[1]) >= percent * max(x[1], y[1]) and min(x[1] - x[2], y[1] - y[2]) >= need
                pairs |= {(x[0], y[0])} if x[0] < y[0] and near else set()
    assert pairs and {(r["node"], r["other"]) for r in met if r["sig"] is None} == pairs
    assert many and sorted((r["k"], r["node"], r["n"], r["place"]) for r in met if r["sig"] is not None) == sorted(many)
    assert len({r["sig"] for r in met} - {None}) == sum(len(of) > few for of in members.values())
