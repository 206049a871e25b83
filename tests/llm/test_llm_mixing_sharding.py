"""Water-filling and the external shuffle against plain Python."""

import hashlib
import re
import zlib
from collections import Counter

import pytest
from llm_cases import clashing, documents, odd_documents, prose
from pyspark.sql import functions as F

from storepulse.llm import mixing, sharding


def size_of(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def plain_targets(sizes, weights=(5, 2, 1), epochs=3):
    """Clamp the sources above their cap and share the rest again, until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, clamped = sum(sizes.values()), set()
    while True:
        left = total - sum(epochs * sizes[s] for s in clamped)
        share = sum(weight[s] for s in names if s not in clamped)
        target = {s: epochs * sizes[s] if s in clamped else left * weight[s] / share for s in names}
        over = {s for s in names if s not in clamped and target[s] > epochs * sizes[s]}
        if not over:
            return target
        clamped |= over


def rows_of(seed=0):
    rows = odd_documents()
    for i in range(200):
        rows.append((100 + i, prose(seed + i, 1 + i % 37), "en", f"s{i % 11 if i % 3 else 0}"))
    return rows


def test_targets_and_taken(spark):
    rows = rows_of()
    sizes = Counter()
    for _, t, _, s in rows:
        sizes[s] += size_of(t)
    want = plain_targets(sizes)
    out = mixing.mix(documents(spark, rows)).collect()
    assert len(out) == len(rows)
    taken = Counter()
    for r in out:
        assert r.size == size_of(r.text) and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source], rel=1e-12)
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.copies * r.size + r.part
        taken[r.source] += r.taken
    assert all(abs(taken[s] - want[s]) <= 2 for s in sizes)
    again = mixing.mix(documents(spark, rows[::-1]).repartition(5)).collect()
    assert sorted((str(r.doc_id), r.taken) for r in out) == sorted((str(r.doc_id), r.taken) for r in again)


def test_taken_follows_the_hash_order(spark):
    rows = [(i, prose(i, 3 + i % 5), "en", "only" if i % 4 else "tiny") for i in range(60)]
    for source in ("only", "tiny"):
        own = [r for r in mixing.mix(documents(spark, rows)).collect() if r.source == source]
        rest = int(own[0].target) % own[0].source_size
        order = sorted(own, key=lambda r: int(hashlib.md5(f"20:{r.doc_id}".encode()).hexdigest()[:15], 16))
        for r in order:
            extra = r.taken - int(own[0].target) // own[0].source_size * r.size
            assert extra == min(r.size, rest)
            rest -= extra


def test_repeated_rows_share_the_threshold(spark):
    rows = [(1, "a b c", "en", "x")] * 50 + [(2, "d e", "en", "y")] * 10
    out = mixing.mix(documents(spark, rows)).collect()
    assert {(r.source, r.taken) for r in out if r.source == "x"} and all(r.taken <= 3 * r.size for r in out)
    for s in ("x", "y"):
        own = [r for r in out if r.source == s]
        assert abs(sum(r.taken for r in own) - own[0].target) <= len(own)


def test_corpus_rows(spark):
    df = clashing(documents(spark, rows_of()))
    mixed = mixing.repeated(df)
    assert mixed.columns == df.columns
    counts = Counter(str(r.doc_id) for r in mixed.collect())
    plan = {}
    for r in mixing.mix(documents(spark, rows_of())).collect():
        plan.setdefault(str(r.doc_id), []).append((r.copies, r.copies + (r.part > 0), r.size))
    for i, own in plan.items():
        low = sum(1 if size == 0 else a for a, _, size in own)
        assert low <= counts[i] <= sum(1 if size == 0 else b for _, b, size in own)


def test_documents_without_ids_are_drawn_each_for_itself(spark):
    rows = [(None, f"{prose(i, 30)} end{i}", "en", "hot") for i in range(300)]
    rows += [(i, prose(1000 + i, 30), "en", f"s{i % 2}") for i in range(600)]
    df = documents(spark, rows)
    target = next(r.target for r in mixing.mix(df).select("source", "target").distinct().collect() if r.source == "hot")
    taken = sum(size_of(r.text) for r in mixing.repeated(df).filter("source = 'hot'").collect())
    assert abs(taken - target) <= 0.05 * target


def test_mix_of_nothing(spark):
    assert mixing.mix(documents(spark, [])).collect() == []
    out = mixing.mix(documents(spark, [(1, None, None, None), (2, "", "en", "a")])).collect()
    assert [(r.size, r.target, r.taken) for r in out] == [(0, 0.0, 0)] * 2


def check_law(out, n):
    by = {}
    for r in out:
        by.setdefault(r.shard, []).append(r.slot)
    assert sum(map(len, by.values())) == n
    if n >= 24:
        assert set(by) == set(range(24))
    sizes = [len(by.get(s, [])) for s in range(24)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(x) == list(range(len(x))) for x in by.values())


@pytest.mark.parametrize("bucket", [500, 1 << 25])
def test_shards(spark, bucket):
    rows = rows_of()
    out = sharding.shard_rows(documents(spark, rows), ["doc_id", "text"], bucket_bytes=bucket).collect()
    check_law(out, len(rows))
    for r in out:
        raw = r.text.encode() if r.text is not None else b""
        assert r["size"] == len(raw) + 8
        assert r.text_crc32 == (None if r.text is None else zlib.crc32(raw))
        assert r.law == "rows" and r.grown_shard is None
    again = sharding.shard_rows(documents(spark, rows[::-1]).repartition(7), ["doc_id", "text"], bucket_bytes=bucket).collect()
    key = lambda x: sorted((str(r.doc_id), str(r.text_crc32), r.shard, r.slot) for r in x)
    assert key(out) == key(again)


def test_order_is_shuffled(spark):
    rows = [(i, "same text") for i in range(500)]
    out = sharding.shard_rows(documents(spark, rows), ["doc_id"], bucket_bytes=3000).collect()
    check_law(out, 500)
    order = [r.doc_id for r in sorted(out, key=lambda r: (r.shard, r.slot))]
    assert sum(a < b for a, b in zip(order, order[1:])) in range(200, 300)
    other = sharding.shard_rows(documents(spark, rows), ["doc_id"], seed=99, bucket_bytes=3000).collect()
    assert order != [r.doc_id for r in sorted(other, key=lambda r: (r.shard, r.slot))]


def test_repeated_rows_spread_over_buckets(spark):
    out = sharding.shard_rows(documents(spark, [(1, "x" * 92)] * 300), ["doc_id"], bucket_bytes=1000)
    check_law(out.collect(), 300)


def test_equal_rows_are_dealt_in_parts(spark, monkeypatch):
    monkeypatch.setattr(sharding, "COPIES", 7)
    rows = [(1, "the same", "en", "a")] * 50 + [(i, prose(i, 5), "en", "a") for i in range(2, 100)]
    out = sharding.shard_rows(documents(spark, rows), ["doc_id"], shards=5, bucket_bytes=200).collect()
    assert Counter(r.doc_id for r in out) == Counter(r[0] for r in rows)
    assert sorted(Counter(r.shard for r in out).values()) == [29, 29, 30, 30, 30]


@pytest.mark.parametrize("hot", [None, 7])
def test_texts_of_one_key_spread_over_buckets(spark, hot):
    rows = [(hot if i % 3 == 0 else 1000 + i, prose(i, 20)) for i in range(900)]
    out = sharding.shard_rows(documents(spark, rows), ["doc_id"], bucket_bytes=1000).collect()
    check_law(out, 900)
    of_key = [sum(r.doc_id == hot for r in out if r.shard == s) for s in range(24)]  # 12.5 on average
    assert sum(of_key) == 300 and min(of_key) >= 1 and max(of_key) <= 26


def test_shards_of_nothing_and_clashes(spark):
    assert sharding.shard_rows(documents(spark, []), ["doc_id"]).collect() == []
    df = clashing(documents(spark, odd_documents()))
    out = sharding.shard_rows(df, df.columns)
    assert {"doc_id", "text", "size", "shard", "slot"} <= set(out.columns)
    check_law(out.collect(), len(odd_documents()))


def test_no_python_in_the_plan(spark):
    plan = sharding.shard_rows(documents(spark, rows_of()).filter("doc_id > 0"), ["doc_id"])._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|MapIn", plan)


def test_written_shards(spark, tmp_out):
    rows = [(i, prose(i, 5)) for i in range(100)]
    sharded = sharding.shard_rows(documents(spark, rows), ["doc_id", "text"])
    sharding.write_shards(sharded, f"{tmp_out}/shards")
    back = spark.read.parquet(f"{tmp_out}/shards")
    assert sorted(r.doc_id for r in back.collect()) == list(range(100))
    one = back.filter("shard = 3").withColumn("f", F.input_file_name()).collect()
    assert [r.slot for r in sorted(one, key=lambda r: (r.f, one.index(r)))] == sorted(r.slot for r in one)
