import hashlib

import pytest
from pyspark.sql import functions as F

from registrylake.llm import fixity
from registrylake.tables.work import staged


def replica(spark, rows):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    return fixity.laid_out(fixity.hashed(pages))


ROWS = [(i, f"http://h{i % 7}.org/{i}", "x" * (i * 37 % 900)) for i in range(300)]


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(fixity, "RANGE_BYTES", 1 << 10)
    monkeypatch.setattr(fixity, "FILE_RECORDS", 4)


def test_audit_finds_what_differs(spark, small):
    first = replica(spark, ROWS)
    bad, gone = {5, 77, 78, 250}, {10, 299}
    changed = F.when(F.col("page_id").isin(*bad), F.sha2("digest", 256)).otherwise(F.col("digest"))
    second = first.where(~F.col("page_id").isin(*gone)).withColumn("digest", changed)
    names = {(r["file"], r["offset"]): r["page_id"] for r in first.collect()}
    found = {names[r["file"], r["offset"]]: r["status"] for r in fixity.audit(first, second).collect()}
    assert found == {i: fixity.DAMAGED for i in bad} | {i: fixity.LOST for i in gone}
    back = {r["status"] for r in fixity.audit(second, first).collect()}
    assert back == {fixity.DAMAGED, fixity.EXTRA}


def test_equal_and_empty_replicas(spark, small):
    first = replica(spark, ROWS[:40])
    assert fixity.audit(first, first).collect() == []
    none = first.limit(0)
    assert fixity.audit(none, none).collect() == []
    assert {r["status"] for r in fixity.audit(first, none).collect()} == {fixity.LOST}
    assert fixity.audit(first, none).count() == 40


def test_tree_has_one_root_that_changes_with_any_record(spark, small):
    first = replica(spark, ROWS[:120])
    shape = fixity.shape_of(first)
    assert shape.ranges > 0 and shape.files > 0
    levels = fixity.merkle_levels(first, shape)
    assert levels[-1].count() == 1
    other = first.withColumn("digest", F.when(F.col("page_id") == 3, "0").otherwise(F.col("digest")))
    assert levels[-1].first() != fixity.merkle_levels(other, shape)[-1].first()


def test_records_offsets_and_odd_rows(spark):
    rows = [(1, "u", "é"), (1, "u", "é"), (None, None, None), (2, "", "")]
    laid = replica(spark, rows).collect()
    text = "WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:1>\r\nWARC-Target-URI: u\r\nContent-Type: text/html\r\nContent-Length: 2\r\n\r\né\r\n\r\n"
    assert [r["digest"] for r in laid if r["page_id"] == 1] == [hashlib.sha256(text.encode()).hexdigest()] * 2
    ends = {}
    for row in sorted(laid, key=lambda r: (r["file"], r["offset"])):
        assert row["offset"] == ends.get(row["file"], 0)
        ends[row["file"]] = row["offset"] + row["length"]


def test_many_equal_records_are_dealt_to_several_files(spark, small):
    rows = [(None, None, "same")] * 40 + [(i, f"u{i}", "x") for i in range(10)]
    laid = staged(replica(spark, rows))
    per_file = {}
    for row in laid.collect():
        per_file.setdefault(row["file"], []).append(row["page_id"])
    assert max(map(len, per_file.values())) <= 12
    assert fixity.audit(laid, laid).collect() == []
    gone = laid.where("page_id IS NULL").orderBy("file", "offset").limit(1)
    rest = staged(laid.join(gone, ["file", "offset"], "left_anti"))
    found = fixity.audit(laid, rest).collect()
    assert {r["status"] for r in found} == {fixity.LOST} and len(found) == 1


def test_long_pages_and_other_columns(spark):
    pages = spark.createDataFrame([(1, "u", "é" * 3_000_000, "own")], "page_id long, url string, html string, file string")
    [row] = fixity.laid_out(fixity.hashed(pages)).collect()
    assert row["length"] > 6_000_000 and row["file"] in range(16) and row["offset"] == 0
