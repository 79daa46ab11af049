import io
import zipfile
import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from registrylake.schemas import DATASETS, Dataset
from registrylake.sources import archives
from registrylake.sources.archives import manifest, record_batches, record_blocks, scan_records
from registrylake.sources.delimited import (
    accepted,
    rejected,
    scan_archives,
    scan_delimited,
    scan_inferred,
    strict,
)
from registrylake.sources.routing import load, route

SMALL = Dataset.of("small", "k text, n u16, v f64")


def scan(spark, folder, pattern="T*.zip", dataset=SMALL, **options):
    return scan_archives(spark, folder, pattern, dataset, **options)


def rows(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


def test_one_record_per_form(spark, pack):
    text = (
        "x;y;z\n"
        '"k";"5";"1000,50"\n'
        "dot;5;1000.00\n"
        'blank;"";""\n'
        '"";;\n'
        "short;7\n"
        '"a ""q"" b";1;1\n'
        '"l1\nl2;x";2;2,5\n'
        '"A \\ B";3;,5\n'
        "SÃO PAULO;4;1,0E7"
    )
    got = strict(scan(spark, pack("T0", text.encode("latin-1")))).collect()
    assert {tuple(r) for r in got} == {
        ("k", 5, 1000.5), ("dot", 5, 1000.0), ("blank", None, None), ("", None, None),
        ("short", 7, None), ('a "q" b', 1, 1.0), ("l1\nl2;x", 2, 2.5), ("A \\ B", 3, 0.5),
        ("SÃO PAULO", 4, 1e7),
    }


def test_blank_lines_are_skipped_in_archives_and_plain_files(spark, pack, tmp_path):
    text = b"x;y;z\nk;5;1\n\nj;6;2\n"
    got = rows(strict(scan(spark, pack("T0", text))))
    (tmp_path / "t.csv").write_bytes(text)
    assert got == rows(strict(scan_delimited(spark, str(tmp_path / "t.csv"), SMALL)))
    assert got == [("j", 6, 2.0), ("k", 5, 1.0)]


def test_line_ends(spark, pack):
    text = b'x;y;z\r\nk;5;1\r\nj;6;2\r"a\r\nb";7;3\n'
    got = rows(strict(scan(spark, pack("T0", text))))
    assert got == [("a\nb", 7, 3.0), ("j", 6, 2.0), ("k", 5, 1.0)]


BAD = [
    ("long;1;2;3", "malformed record"),
    ("long;1;2;", "malformed record"),
    ("k;zz;1", "bad value: n"),
    ("k;-3;1", "bad value: n"),
    ("k;65536;1", "bad value: n"),
    ("k;5.0;1", "bad value: n"),
    ("k; 5 ;1", "bad value: n"),
    ("k;5;1.000,50", "bad value: v"),
    ("k;5;1d", "bad value: v"),
    ("k;x;y", "bad value: n"),
]


def test_malformed_records_are_set_apart(spark, pack):
    text = "x;y;z\ngood;5;1\n" + "".join(f"{record}\n" for record, _ in BAD) + "fine;6;2\n"
    scanned = scan(spark, pack("T0", text.encode()))
    assert rows(accepted(scanned)) == [("fine", 6, 2.0), ("good", 5, 1.0)]
    assert rows(rejected(scanned).select("_record", "_reason")) == sorted(BAD)


@pytest.mark.parametrize("record", [record for record, _ in BAD])
def test_strict_fails_on_a_malformed_record(spark, pack, record):
    scanned = strict(scan(spark, pack("T0", f"x;y;z\n{record}\n".encode())))
    with pytest.raises(Exception, match="malformed record|bad value"):
        scanned.where("n IS NOT NULL").collect()


def test_stray_quotes_are_text(spark, pack):
    text = 'x;y;z\na 5" b;1;1\nnext;2;6" c\n"q" r;3;3\nlast;4;4\n'
    scanned = scan(spark, pack("T0", text.encode()))
    assert rows(accepted(scanned).select("n")) == [(1,), (3,), (4,)]
    assert accepted(scanned).where("n = 1").first().k == 'a 5" b'
    assert rejected(scanned).first()._record == 'next;2;6" c'


def test_one_stray_quote_among_many_quoted_records(spark, pack):
    lines = [f'"company {i}";"{i}";"1,5"' for i in range(1000)]
    lines[100] = 'Pipes 5" wide;100;1'
    folder = pack("T0", ("x;y;z\n" + "\n".join(lines)).encode())
    whole = strict(scan(spark, folder))
    assert whole.count() == 1000
    assert whole.where("n = 100").first().k == 'Pipes 5" wide'
    assert rows(strict(scan(spark, folder, task_bytes=100))) == rows(whole)


def test_stray_quote_before_more_than_a_record_may_hold():
    text = b'a 5" b;1\n' + b'"k";2\n' * 1000
    got = list(record_batches(record_blocks(io.BytesIO(text), chunk=64, max_record=200)))
    assert sum(len(texts) for _, texts in got) == 1001


def test_unpaired_quote_to_the_end(spark, pack):
    scanned = scan(spark, pack("T0", b'x;y;z\nk;5;1\n"open;6;2\nj;7;3\n'))
    assert rows(accepted(scanned)) == [("j", 7, 3.0), ("k", 5, 1.0)]
    assert rejected(scanned).first()._record == '"open;6;2'


def test_a_field_that_never_closes_costs_its_line_only():
    text = b'k;1\n"open;2\n' + b"x;3\n" * 2000
    for chunk in (5, 100, 4000):
        got = []
        for _, texts in record_batches(record_blocks(io.BytesIO(text), chunk, 1000)):
            got += texts.to_pylist()
        assert got == ["k;1", '"open;2', *["x;3"] * 2000]


@pytest.mark.parametrize(
    ("record", "whole"),
    [
        ('"a;b";c', True), ('""', True), ('a;""', True), ('"";b', True), ('"a""b"', True),
        ('"""a"', True), ('a"b', True), ('a;b"', True), ('"a"b;c', True), ('"a""', False),
        ('"', False), ('a;"', False), ('"a";"b', False),
    ],
)
def test_where_a_quoted_field_ends(record, whole):
    text = f'{record}\nnext";x\nlast\n'.encode()
    [(_, texts)] = list(record_batches(record_blocks(io.BytesIO(text))))
    first = record if whole else f'{record}\nnext";x'
    assert texts.to_pylist()[0] == first and texts.to_pylist()[-1] == "last"


def test_a_worker_holds_about_a_megabyte_of_a_member_at_a_time():
    text = b'"abc";"def"\n' * (1 << 19)
    sizes = [len(raw) for _, raw, _ in record_blocks(io.BytesIO(text))]
    assert sum(sizes) == len(text) and max(sizes) < (1 << 20) + 100


def test_a_field_that_is_never_closed_is_scanned_a_few_times():
    class Stream(io.BytesIO):
        reads = 0

        def read(self, *size):
            self.reads += 1
            return super().read(*size)

    stream = Stream(b'"open;1\n' + b"line;2\n" * 10_000)
    lines = sum(len(texts) for _, texts in record_batches(record_blocks(stream, 100, 64_000)))
    assert lines == 10_001 and stream.reads < 100


def test_manifest_is_read_by_tasks(spark, pack, monkeypatch):
    pack("T0", b"x;y;z\nk;5;1\n")
    folder = pack("T1", members={"dir/": b"", "dir/a.csv": b"abc" * 100, "b.csv": b""})
    monkeypatch.setattr(zipfile, "ZipFile", None)  # on the driver
    listed = manifest(spark, folder).select("archive", "member", "number", "members", "size", "crc")
    assert rows(listed) == [
        (f"file:{folder}/T0.zip", "T0.csv", 0, 1, 12, zlib.crc32(b"x;y;z\nk;5;1\n")),
        (f"file:{folder}/T1.zip", "b.csv", 1, 2, 0, 0),
        (f"file:{folder}/T1.zip", "dir/a.csv", 0, 2, 300, zlib.crc32(b"abc" * 100)),
    ]
    assert rows(strict(scan(spark, folder, "T0*"))) == [("k", 5, 1.0)]
    assert manifest(spark, folder, "None*").count() == 0


def test_many_small_archives_are_planned_without_opening_one(spark, bronze, monkeypatch):
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        archive.writestr("m.csv", "x;y;z\nk;5;1\n")
    for i in range(2000):
        (bronze / f"T{i}.zip").write_bytes(packed.getvalue())
    monkeypatch.setattr(zipfile, "ZipFile", None)
    scanned = strict(scan(spark, str(bronze)))
    assert scanned.rdd.getNumPartitions() == 2 * spark.sparkContext.defaultParallelism
    per_task = scanned.groupBy(F.spark_partition_id()).count().collect()
    assert sorted(r["count"] for r in per_task) == [250] * 8


def test_members_are_dealt_by_their_bytes(spark, pack):
    for i in range(40):
        folder = pack(f"T{i}", b"x;y;z\n" + b"k;5;1\n" * (1000 if i == 7 else 10))
    scanned = scan(spark, folder, "T*")
    assert accepted(scanned).count() == 1000 + 39 * 10
    per_task = accepted(scanned).groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in per_task) <= 1020


class CountingZip(zipfile.ZipFile):
    read_bytes = 0

    def open(self, *args, **kwargs):
        stream = super().open(*args, **kwargs)
        read = stream.read

        def counted(n=-1):
            data = read(n)
            CountingZip.read_bytes += len(data)
            return data

        stream.read = counted
        return stream


def test_a_spooled_member_is_inflated_once(pack, monkeypatch):
    text = b'x;y;z\n' + b'"k\nl";5;1\n' * 5000
    folder = pack("T0", text)
    monkeypatch.setattr(archives.zipfile, "ZipFile", CountingZip)
    monkeypatch.setattr(archives, "_CHUNK", 1000)
    monkeypatch.setattr(CountingZip, "read_bytes", 0)
    reader = archives._Records(True, ";", 3, [1, 2], 1 << 20)
    listed = pa.RecordBatch.from_pydict({"archive": [f"{folder}/T0.zip"], "member": ["T0.csv"]})
    spooled = list(reader.spool(iter([listed])))
    assert CountingZip.read_bytes == len(text) and len(spooled) > 50
    assert b"".join(b.column("block")[0].as_py() for b in spooled) == text
    direct = pa.Table.from_batches(reader.of_members(iter([listed])))
    assert CountingZip.read_bytes == 2 * len(text)
    assert pa.Table.from_batches(reader.of_blocks(iter(spooled))).to_pylist() == direct.to_pylist()
    assert CountingZip.read_bytes == 2 * len(text) and direct.num_rows == 5000


def test_header_option(spark, pack):
    folder = pack("T0", b"k;5;1\nj;6;2\n")
    assert rows(strict(scan(spark, folder, header=False))) == [("j", 6, 2.0), ("k", 5, 1.0)]
    with pytest.raises(Exception, match="header looks like a record"):
        scan(spark, folder).collect()
    assert rows(strict(scan(spark, pack("T0", b'"x;y";n;v\n"a;b";1;2\n')))) == [("a;b", 1, 2.0)]


def test_header_with_another_number_of_fields_fails(spark, pack):
    with pytest.raises(Exception, match="header has 2 fields, 3 are declared"):
        scan(spark, pack("T0", b"x;y\nk;5\n")).collect()


def test_archive_members(spark, pack):
    members = {"dir/": b"", "dir/a.csv": b"x;y;z\na;1;1\n", "b.csv": b"x;y;z\nb;2;2\n"}
    folder = pack("T0", members=members)
    assert rows(strict(scan(spark, folder))) == [("a", 1, 1.0)]
    assert rows(strict(scan(spark, folder, members="all"))) == [("a", 1, 1.0), ("b", 2, 2.0)]


def test_many_archives_are_one_table(spark, pack):
    for i in range(5):
        folder = pack(f"T{i}", f"x;y;z\nk{i};{i};1\n".encode())
    pack("Other0", b"x;y;z\nno;9;9\n")
    assert strict(scan(spark, folder)).count() == 5


def test_missing_archive_is_an_empty_typed_frame(spark, bronze):
    df = strict(scan(spark, str(bronze), "None*.zip"))
    assert df.schema == SMALL.struct and df.count() == 0


def test_empty_member(spark, pack):
    assert scan(spark, pack("T0", b"")).count() == 0


@pytest.mark.parametrize("compression", [zipfile.ZIP_DEFLATED, zipfile.ZIP_STORED])
def test_spooled_members_give_the_same_records(spark, pack, monkeypatch, tmp_path, compression):
    lines = [f'"k{i}{"é" * (i % 3)}";{i % 100};"{i},5"' for i in range(500)]
    lines[100] = '"line\nbreak;""q""";7;1'
    lines[400] = '"' + "x\n" * 300 + '";8;2'
    text = ("x;y;z\n" + "\n".join(lines)).encode("latin-1")
    folder = pack("T0", members={"a.csv": text}, compression=compression)
    pack("T1", b"x;y;z\nsmall;1;1\n")
    whole = rows(strict(scan(spark, folder)))
    monkeypatch.setattr(archives, "_CHUNK", 200)
    spooled = strict(scan(spark, folder, task_bytes=100, spool=str(tmp_path / "spool")))
    assert len(list((tmp_path / "spool").glob("*/*.parquet"))) > 2
    assert len(whole) == 501 and rows(spooled) == whole


@pytest.mark.parametrize("chunk", [1, 2, 3, 7, 64])
@pytest.mark.parametrize("end", ["\n", "\r\n", "\r"])
def test_chunks_of_any_size_give_the_same_records(chunk, end):
    records = ['a;"x\ny";é', "", "b", '"q""q"', 'c;"\n"', "d"]
    text = end.join(records).encode("latin-1")
    got, offsets = [], []
    for starts, texts in record_batches(record_blocks(io.BytesIO(text), chunk)):
        got += texts.to_pylist()
        offsets += starts.tolist()
    assert got == records
    assert [text[o:].decode("latin-1")[:1] for o in offsets if o < len(text)][0] == "a"


def test_record_offsets(spark, pack):
    folder = pack("T0", b"x;y;z\nk;5;1\nj;6;2\n")
    records = scan_records(spark, folder, "T*.zip")
    assert rows(records.select("record_offset", "value", "member")) == [
        (12, "j;6;2", "T0.csv"), (6, "k;5;1", "T0.csv"),
    ]


def test_the_record_is_parsed_once_below_any_filter(spark, pack):
    scanned = strict(scan(spark, pack("T0", b"x;y;z\nk;5;1\n"))).where("n > 3 AND v < 5")
    plan = scanned._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_csv(") == 1


def test_delimited_by_position_and_by_name(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('a;b;c\n"k";5;1,5\n"";6;\nbad;x;1\n', encoding="utf-8")
    scanned = scan_delimited(spark, str(path), SMALL)
    assert rows(accepted(scanned)) == [("", 6, None), ("k", 5, 1.5)]
    assert rejected(scanned).first()._record == "bad;x;1"
    path.write_text("v;k\n1,5;á\n", encoding="utf-8")
    assert rows(strict(scan_delimited(spark, str(path), SMALL, by_name=True))) == [("á", None, 1.5)]
    path.write_text("k;other\n1;2\n", encoding="utf-8")
    with pytest.raises(ValueError, match="not declared"):
        scan_delimited(spark, str(path), SMALL, by_name=True)


def test_delimited_short_and_long_rows_and_line_breaks(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("a;b;c\nk;5\nj;6;1;2\n")
    scanned = scan_delimited(spark, str(path), SMALL)
    assert rows(accepted(scanned)) == [("k", 5, None)]
    assert rejected(scanned).first()._record == "j;6;1;2"
    path.write_bytes('a;b;c\n"é\nf";5;1\n'.encode("latin-1"))
    read = scan_delimited(spark, str(path), SMALL, multiline=True, encoding="ISO-8859-1")
    assert rows(strict(read)) == [("é\nf", 5, 1.0)]


def test_inferred_types(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("code;name;f;b;d;v\n001;a;1.5;true;2020-01-01;1,5\n2;b;2;false;2020-01-02;2\n")
    df = scan_inferred(spark, str(path))
    assert [kind for _, kind in df.dtypes] == [
        "bigint", "string", "double", "boolean", "string", "string",
    ]
    assert rows(df)[0] == (1, "a", 1.5, True, "2020-01-01", "1,5")


def test_route(spark, bronze):
    for name in ["Empresas0.zip", "Empresas01.zip", "Cnaes.zip", "123.zip", "note.txt"]:
        (bronze / name).write_bytes(b"")
    assert {tuple(r) for r in route(spark, str(bronze)).collect()} == {
        ("Empresas0.zip", "empresas", "0"), ("Empresas01.zip", "empresas", "01"),
        ("Cnaes.zip", "cnaes", None), ("123.zip", "", "123"),
    }


def test_load_leaves_out_listed_legal_forms(spark, pack, bronze):
    (bronze / "naturezas_nao_empresas.csv").write_text("natureza_code\n8885\n1015\n")
    names = DATASETS["empresas"].names
    lines = [f"{i:08d};Firma {i};{code};5;{i},25;1;" for i, code in enumerate([2305, 8885, "", 1015, 4120])]
    folder = pack("Empresas7", "\n".join([";".join(names), *lines]).encode())
    companies = load(spark, folder, "Empresas7")
    assert companies.schema == DATASETS["empresas"].struct
    assert rows(companies.select("cnpj_base", "capital_social")) == [("00000000", 0.25), ("00000004", 4.25)]
    pack("Motivos3", b"c;d\n1;sem\n2;com\n3;outro\n")
    assert load(spark, folder, "Motivos3").count() == 3
    assert load(spark, folder, "Cnaes9").count() == 0


def test_load_fails_on_a_bad_legal_form_rather_than_dropping_it(spark, pack, bronze):
    (bronze / "naturezas_nao_empresas.csv").write_text("natureza_code;nome\n3999;x\n")
    header = ";".join(DATASETS["empresas"].names)
    folder = pack("Empresas0", f"{header}\n1;A;zz;49;1;5;\n".encode())
    with pytest.raises(Exception, match="bad value: natureza_code"):
        load(spark, folder, "Empresas0").collect()
