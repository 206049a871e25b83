"""Registered queries: SQL, whole results at a small size, and the pipeline against its parts."""

import os
from collections import Counter

import corpus_pipeline
import duckdb
import pytest
import tools.check_oracle as checker
from conftest import SF001, SF01
from llm_cases import clashing, documents, odd_documents, prose, shingle_set

import __spark_entry__ as entry
from storepulse.llm import decontamination, langid, mixing, oracle, queries


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in checker.TABLES:
        if os.path.exists(path := f"{SF01}/{t}.parquet"):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return c


def test_registered():
    assert set(queries.QUERIES) <= set(entry.queries()) and set(oracle.SQL) <= set(entry.oracle_sql())
    assert [q.split("_")[0] for q in queries.QUERIES] == [f"op{n}" for n in range(1, 14)] + ["pipeline"]


@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_query_matches_sql(spark, con, name):
    checker.EXACT = True
    assert checker.compare(spark, con, name, queries.QUERIES[name], oracle.SQL[name], SF01)


def tables_of(spark, path, docs):
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, prose(70, 25))], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")


def test_pipeline_against_its_parts(spark, tmp_out):
    rows = [*odd_documents(), (50, "pre " + prose(70, 25)), (51, "漢字かな交じり文を書く" * 30, "en", "a")]
    rows += [(100 + i, prose(i, 60), "en", f"s{i % 3}") for i in range(90)] + [(300 + i, prose(i, 60), "en", "s9") for i in range(30)]
    docs = clashing(documents(spark, rows))
    tables_of(spark, tmp_out, docs)
    out = corpus_pipeline.run(spark, tmp_out).collect()

    known = langid.recognised(docs).collect()
    seen, first = set(), {}
    for r in sorted(known, key=lambda r: (r.doc_id is None, r.doc_id or 0)):
        key = frozenset(shingle_set(r.text))
        if key not in seen:
            seen.add(key)
            first[str(r.doc_id)] = r
    first.pop("9")  # links with 8
    automaton = decontamination.build_automaton([("1", prose(70, 25))])
    clean = [r for r in first.values() if not decontamination.scan(r.text or "", automaton)[1]]
    left = documents(spark, [(r.doc_id, r.text, r.lang, r.source) for r in clean])
    want = Counter(str(r.doc_id) for r in mixing.repeated(left).collect())
    assert Counter(str(r.doc_id) for r in out) == want
    assert "50" not in want and "51" not in want
    by_shard = Counter(r.shard for r in out)
    assert max(by_shard.values()) - min(by_shard.values()) <= 1 and len(by_shard) == 24
    assert all(r.keep == "own keep" and r.taken == "own taken" for r in out)


def test_pipeline_of_nothing(spark, tmp_out):
    tables_of(spark, tmp_out, documents(spark, []))
    assert corpus_pipeline.run(spark, tmp_out).collect() == []


def test_stages_return_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF001)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_language_accuracy_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "lang")
    out = queries.op7_language_id(spark, SF01).join(docs, "doc_id").filter("held_out and lang_pred <> 'und'").collect()
    assert sum(r.lang == r.lang_pred for r in out) / len(out) > 0.97


def test_quality_agrees_with_labels(spark):
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    out = queries.op1_weak_label_quality(spark, SF01).join(labels, "doc_id").collect()
    assert sum(r.keep == (r.quality == 1) for r in out) / len(out) > 0.97
    assert sum(not r.keep for r in out if r.quality == 1) <= 0.01 * len(out)


def test_sql_and_join_agree_on_every_kind_of_white_space(spark):
    from storepulse.llm import ngram_join

    base = prose(31, 60).split()
    rows = [(i, sep.join(base[: 60 - (i > 4)])) for i, sep in enumerate([" ", "\r\n", "\x0b", "\x0c", "\r", "\t", " \r\n "])]
    docs = documents(spark, [*rows, (50, prose(32, 60)), (51, None), (52, "\r\n")])
    c = duckdb.connect()
    c.register("documents", docs.toPandas())
    got = sorted(map(tuple, ngram_join.ngram_join(docs).select("doc_id", "n_shingles", "component_id").collect()))
    assert got == sorted(c.sql(oracle.SQL["op10_ngram_join"]).fetchall())
    assert [g[2] for g in got[:7]] == [0] * 7
