"""One large JSON document read by many tasks."""

import json
import os
import random

import pytest

from storepulse.sources import json_split, readers, schemas


def odd_text(rng):
    return "".join(rng.choice(['{', '}', '[', ']', '"', '\\', ',', 'a', 'ü', '}{', '\\"', '\n', ' ']) for _ in range(rng.randint(0, 12)))


def records(n, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lines = [
            {"soldqty": float(k), "purchaseProductDetails": {"category": {"name": odd_text(rng)}}, "lotDetails": {"rate": 1.5 * k, "subqty": None}}
            for k in range(rng.randint(0, 4))
        ]
        out.append({"_id": str(i), "invoicedate": "2001-07-25T10:00:00.000Z", "storeDetails": {"name": odd_text(rng)}, "product": lines})
    return out


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)
    return path


@pytest.fixture()
def small_blocks(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1000")
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def seen(df):
    return sorted((r._id, r.storeDetails.name, [(p.soldqty, p.purchaseProductDetails.category.name) for p in r["product"]]) for r in df.collect())


def want(rows):
    return sorted(
        (r["_id"], r["storeDetails"]["name"], [(p["soldqty"], p["purchaseProductDetails"]["category"]["name"]) for p in r["product"]]) for r in rows
    )


@pytest.mark.parametrize("layout", ["compact", "indented", "escaped"])
@pytest.mark.parametrize("result", [None, "sales"])
def test_document_in_many_blocks_equals_json(small_blocks, tmp_out, layout, result):
    rows = records(600)
    body = {"data": {"sales": rows, "more": [{"a": [{"b": "}]"}]}]}, "tail": [[{"_id": "no record"}]]} if result else rows
    text = json.dumps(body, indent=2 if layout == "indented" else None, ensure_ascii=layout == "escaped", separators=(",", ":") if layout == "compact" else None)
    path = write(f"{tmp_out}/in/doc.json", text)
    assert json_split._text(small_blocks, path).rdd.getNumPartitions() > 20
    assert seen(readers.read_sales(small_blocks, path, multiline=True, result=result)) == want(rows)


def test_several_files_and_records_larger_than_blocks(small_blocks, tmp_out):
    rows = records(40, seed=3)
    for r in rows[::7]:
        r["storeDetails"]["name"] = odd_text(random.Random(5)) + "x}" * 9_000
    for i in range(3):
        write(f"{tmp_out}/in/{i}.json", json.dumps(rows[i::3]))
    assert seen(readers.read_sales(small_blocks, f"{tmp_out}/in", multiline=True)) == want(rows)


@pytest.mark.parametrize("text", ["[]", " [ ]\n", '{"data": {"sales": []}}', '{"data": {"sales": [ ]}, "x": [{}]}'])
def test_no_records(small_blocks, tmp_out, text):
    path = write(f"{tmp_out}/in/doc.json", text)
    assert readers.read_sales(small_blocks, path, multiline=True, result="sales" if "data" in text else None).collect() == []


@pytest.mark.parametrize(
    "text",
    ['{"errors": [{"message": "no"}]}', '{"data": null}', '{"data": {"sales": null}}', '{"data": {"other": [{"_id": "1"}]}}', "", "no"],
)
def test_failed_responses_stop_the_job(small_blocks, tmp_out, text):
    write(f"{tmp_out}/in/ok.json", json.dumps({"data": {"sales": records(3)}}))
    write(f"{tmp_out}/in/failed.json", text)
    if not text:  # an empty file has no rows at all
        assert len(readers.read_sales(small_blocks, f"{tmp_out}/in", multiline=True, result="sales").collect()) == 3
        return
    with pytest.raises(Exception, match="the fetch failed"):
        readers.read_sales(small_blocks, f"{tmp_out}/in", multiline=True, result="sales").collect()


def test_cut_off_document_is_an_error(small_blocks, tmp_out):
    text = json.dumps(records(300))
    for cut in (len(text) // 2, len(text) - 1):
        path = write(f"{tmp_out}/cut{cut}/doc.json", text[:cut])
        with pytest.raises(Exception, match="ends within its list|MALFORMED|Malformed"):
            readers.read_sales(small_blocks, path, multiline=True).collect()


def test_states_do_not_depend_on_where_blocks_begin(spark, tmp_out):
    rows = records(150, seed=9)
    path = write(f"{tmp_out}/in/doc.json", json.dumps(rows, ensure_ascii=False))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("700", "1111", "20000", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            assert seen(json_split.read_records(spark, path, schemas.SALES)) == want(rows)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
