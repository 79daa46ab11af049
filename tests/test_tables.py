import uuid
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from registrylake.schemas import DATASETS
from registrylake.sources.files import Files, pyarrow_uri, resolve
from registrylake.tables.layer import Build, ConcurrentWrite, Layer
from registrylake.tables.layout import hashed_paths
from registrylake.tables.work import staged, work_folder

LANDS = [{"pais_code": 13, "pais_name": "Afeganistao"}, {"pais_code": 531}, {"pais_code": 639, "pais_name": ""}]


def lands(spark, *codes):
    """Rows of the country table."""
    return spark.createDataFrame([(c, f"pais {c}") for c in codes], DATASETS["paises"].struct)


@pytest.fixture
def layer(spark, tmp_path):
    return Layer(spark, f"silver_{uuid.uuid4().hex}", str(tmp_path / "silver"))


def rows(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


def test_create_insert_count_distinct(layer):
    assert not layer.exists("paises")
    layer.create("paises", DATASETS["paises"])
    assert layer.exists("paises") and layer.row_count("paises").first().n == 0
    assert layer.append_records("paises", LANDS) == 3
    assert layer.row_count("paises").first().n == 3
    assert rows(layer.distinct("paises", "pais_name")) == [("",), ("Afeganistao",)]
    assert layer.columns("paises") == {"pais_code": "bigint", "pais_name": "string"}


def test_create_again_keeps_the_rows(layer):
    layer.create("paises", DATASETS["paises"])
    layer.append_records("paises", LANDS)
    layer.create("paises", DATASETS["paises"].struct)
    assert layer.read("paises").count() == 3


def test_no_records_is_zero(layer):
    assert layer.append_records("paises", []) == 0


def test_partial_records_are_null(layer):
    layer.create("simples", DATASETS["simples"])
    assert layer.append_records("simples", [{"opcao_pelo_mei": "S"}, {}]) == 2
    width = len(DATASETS["simples"].names)
    filled = [[x for x in row if x is not None] for row in layer.read("simples").collect()]
    assert sorted(filled) == [[], ["S"]] and len(layer.read("simples").columns) == width


@pytest.mark.parametrize("name", ["two words", "a;b", "", "x`y", "../up"])
def test_bad_table_names(layer, name):
    for call in [
        lambda: layer.create(name, DATASETS["paises"]),
        lambda: layer.append_records(name, LANDS),
        lambda: layer.row_count(name),
        lambda: layer.drop(name),
    ]:
        with pytest.raises(ValueError, match="Not a name for a table"):
            call()


def test_bad_column_names(layer):
    layer.create("motivos", DATASETS["motivos"])
    for table, column in [("motivos", "1 + 1"), ("no table", "motivo_code")]:
        with pytest.raises(ValueError, match="Not names of a table and a column"):
            layer.distinct(table, column)
    with pytest.raises(ValueError, match="not in table"):
        layer.append_records("motivos", [{"other": 1}])


def test_stored_types_are_enforced(spark, layer):
    layer.create("paises", DATASETS["paises"])
    wrong = spark.createDataFrame([("x", "y")], "pais_code string, pais_name string")
    with pytest.raises(Exception, match="INCOMPATIBLE_DATA_FOR_TABLE|Cannot safely cast"):
        layer.append("paises", wrong)


def test_append_by_name(spark, layer):
    layer.create("paises", DATASETS["paises"])
    layer.append("paises", spark.createDataFrame([("A", 1)], "pais_name string, pais_code int"))
    layer.append("paises", spark.createDataFrame([(2,)], "pais_code int"))
    assert rows(layer.read("paises")) == [(1, "A"), (2, None)]


def test_replace_twice_and_empty(spark, layer):
    for codes in [(1, 2, 3, 4), (7,), ()]:
        layer.replace("paises", lands(spark, *codes), ["pais_code"])
        assert rows(layer.read("paises")) == [(c, f"pais {c}") for c in codes]
    # The last version and the one before, for queries that still read it.
    assert len(layer.files.directories(f"{layer.location}/paises")) == 2


def test_a_failed_replace_keeps_the_table(spark, layer):
    layer.replace("paises", lands(spark, *range(10)))
    bad = lands(spark, 1, 2).withColumn(
        "pais_name", F.when(F.col("pais_code") == 2, F.raise_error(F.lit("broken"))).otherwise("x")
    )
    with pytest.raises(Exception, match="broken"):
        layer.replace("paises", bad)
    assert layer.read("paises").count() == 10
    reopened = Layer(spark, f"again_{uuid.uuid4().hex}", layer.location)
    assert reopened.read("paises").count() == 10
    assert len(layer.files.directories(f"{layer.location}/paises")) == 1


class Stopped(BaseException):
    """A process that ends: nothing is cleaned up."""


@pytest.mark.parametrize("step", ["rows", "marker", "after marker", "catalog", "clean"])
@pytest.mark.parametrize("first", [True, False])
def test_a_stop_at_any_step_leaves_old_or_new_rows(spark, layer, monkeypatch, step, first):
    if not first:
        layer.replace("paises", lands(spark, 1))
    layer.replace("motivos", spark.createDataFrame([(1, "x")], DATASETS["motivos"].struct))
    created = Files.create_new

    def stop(*_):
        raise Stopped

    def stop_after(self, path, text):
        created(self, path, text)
        raise Stopped

    where = {
        "rows": (Files, "create_new", stop), "marker": (Files, "_name", stop),
        "after marker": (Files, "create_new", stop_after), "catalog": (Layer, "_follow", stop),
        "clean": (Layer, "_clean", stop),
    }
    monkeypatch.setattr(Build, "_remove", lambda self: None)
    with monkeypatch.context() as patched, pytest.raises(Stopped):
        patched.setattr(*where[step])
        layer.replace("paises", lands(spark, 5, 6))
    again = Layer(spark, f"again_{uuid.uuid4().hex}", layer.location)
    new = step not in ("rows", "marker")
    assert again.tables() == (["motivos"] if first and not new else ["motivos", "paises"])
    if "paises" in again.tables():
        assert rows(again.read("paises").select("pais_code")) == ([(5,), (6,)] if new else [(1,)])
    assert again.read("motivos").count() == 1
    # Nothing left behind is in the way of the next write.
    again.replace("paises", lands(spark, 7))
    third = Layer(spark, f"third_{uuid.uuid4().hex}", layer.location)
    assert rows(third.read("paises").select("pais_code")) == [(7,)]


def test_two_writers_of_one_table_end_in_one_failure(spark, layer):
    layer.replace("paises", lands(spark, 1))
    other = Layer(spark, f"other_{uuid.uuid4().hex}", layer.location)
    slow = layer.build()
    slow.replace("paises", lands(spark, 2))
    other.replace("paises", lands(spark, 3))
    with pytest.raises(ConcurrentWrite, match="paises"), slow:
        pass
    again = Layer(spark, f"again_{uuid.uuid4().hex}", layer.location)
    assert rows(again.read("paises").select("pais_code")) == [(3,)]
    assert len(layer.files.directories(f"{layer.location}/paises")) == 2


def test_writers_of_different_tables_do_not_disturb_each_other(spark, layer):
    other = Layer(spark, f"other_{uuid.uuid4().hex}", layer.location)
    with layer.build() as new:
        new.replace("paises", lands(spark, 2))
        other.replace("motivos", spark.createDataFrame([(1, "x")], DATASETS["motivos"].struct))
    again = Layer(spark, f"again_{uuid.uuid4().hex}", layer.location)
    assert again.tables() == ["motivos", "paises"]


def test_one_of_many_creates_a_file(spark, tmp_path):
    files = Files(spark)
    with ThreadPoolExecutor(8) as pool:
        for i in range(10):
            path = files.qualified(str(tmp_path / f"m{i}"))
            made = list(pool.map(lambda n: files.create_new(path, f"writer {n}"), range(8)))
            assert made.count(True) == 1 and files.read_text(path) == f"writer {made.index(True)}"
    assert not [n for n in files.names(str(tmp_path)) if n.endswith(".new")]


def test_the_highest_valid_marker_counts(spark, layer):
    layer.replace("paises", lands(spark, 1))
    layer.files.create_new(f"{layer.location}/_log/{9:012d}.json", '{"tables": {"pai')
    again = Layer(spark, f"again_{uuid.uuid4().hex}", layer.location)
    assert rows(again.read("paises").select("pais_code")) == [(1,)]
    again.replace("paises", lands(spark, 2))
    third = Layer(spark, f"third_{uuid.uuid4().hex}", layer.location)
    assert rows(third.read("paises").select("pais_code")) == [(2,)]


def test_a_query_on_the_previous_version_can_end(spark, layer):
    layer.replace("paises", lands(spark, 1, 2, 3))
    reading = layer.read("paises").select("pais_code")
    layer.replace("paises", lands(spark, 9))
    assert rows(reading) == [(1,), (2,), (3,)]
    for _ in range(12):
        layer.replace("paises", lands(spark, 4))
    assert len(layer.files.names(f"{layer.location}/_log")) <= 8
    assert len(layer.files.directories(f"{layer.location}/paises")) == 2


def test_tables_of_a_build_are_published_together(spark, layer):
    for table in "abcdefgh":
        layer.replace(table, lands(spark, 1))
    bad = lands(spark, 2).withColumn("pais_name", F.raise_error(F.lit("broken")))
    with pytest.raises(Exception, match="broken"), layer.build() as new:
        for i, table in enumerate("abcdefgh"):
            new.replace(table, bad if i == 4 else lands(spark, 2))
            assert rows(new.read(table).select("pais_code")) == [(2,)]
            assert rows(layer.read(table).select("pais_code")) == [(1,)]
    again = Layer(spark, f"again_{uuid.uuid4().hex}", layer.location)
    assert all(rows(again.read(t).select("pais_code")) == [(1,)] for t in "abcdefgh")
    assert all(len(layer.files.directories(f"{layer.location}/{t}")) == 1 for t in "abcdefgh")
    with layer.build() as new:
        new.drop("a")
        new.drop("no such table")
        new.replace("b", lands(spark, 3))
        assert not new.exists("a") and layer.exists("a")
    assert layer.tables() == list("bcdefgh")
    assert rows(layer.read("b").select("pais_code")) == [(3,)]


def test_a_batch_is_added_once(spark, layer, monkeypatch):
    layer.create("paises", DATASETS["paises"])
    assert layer.append("paises", lands(spark, 1, 2), "monday") is True
    assert layer.append("paises", lands(spark, 1, 2), "monday") is False
    assert layer.append_records("paises", LANDS, "tuesday") == 3
    assert layer.append_records("paises", LANDS, "tuesday") == 0
    assert layer.read("paises").count() == 5
    bad = lands(spark, 7, 8).withColumn("pais_name", F.raise_error(F.col("pais_name")))
    with pytest.raises(Exception, match="pais 7|pais 8"):
        layer.append("paises", bad, "wednesday")

    def stop(*_):
        raise Stopped

    with monkeypatch.context() as patched, pytest.raises(Stopped):
        patched.setattr(Files, "rename_new", stop)
        patched.setattr(Files, "delete", lambda *_: None)
        layer.append("paises", lands(spark, 7, 8), "wednesday")
    again = Layer(spark, f"again_{uuid.uuid4().hex}", layer.location)
    assert again.read("paises").count() == 5 and again.tables() == ["paises"]
    assert again.append("paises", lands(spark, 7, 8), "wednesday") is True
    assert again.append("paises", lands(spark, 7, 8), "wednesday") is False
    assert again.read("paises").count() == 7


def test_an_append_to_a_replaced_version_is_an_error(spark, layer, monkeypatch):
    layer.replace("paises", lands(spark, 1))
    other = Layer(spark, f"other_{uuid.uuid4().hex}", layer.location)
    renamed = Files.rename_new

    def late(self, source, target):
        monkeypatch.setattr(Files, "rename_new", renamed)
        other.replace("paises", lands(spark, 2))
        return renamed(self, source, target)

    monkeypatch.setattr(Files, "rename_new", late)
    with pytest.raises(ConcurrentWrite):
        layer.append("paises", lands(spark, 3))
    assert rows(other.read("paises").select("pais_code")) == [(2,)]


def test_a_table_can_be_replaced_by_a_query_on_itself(spark, layer):
    layer.replace("paises", lands(spark, 1, 2, 3))
    layer.replace("paises", layer.read("paises").where("pais_code > 1"))
    assert layer.read("paises").count() == 2


def test_only_committed_tables_are_found(spark, layer):
    layer.create("paises", DATASETS["paises"])
    spark.range(3).write.parquet(f"{layer.location}/halfway/part")
    again = Layer(spark, f"again_{uuid.uuid4().hex}", layer.location)
    assert again.tables() == ["paises"]
    assert again.read("paises").schema == DATASETS["paises"].struct
    again.append_records("paises", LANDS)
    assert layer.location == again.location and again.read("paises").count() == 3


def test_a_name_belongs_to_one_folder(spark, layer, tmp_path):
    with pytest.raises(ValueError, match="not at"):
        Layer(spark, layer.name, str(tmp_path / "other"))
    assert Layer(spark, layer.name, layer.location).location == layer.location


def test_an_older_catalog_follows_the_committed_version(spark, layer):
    layer.replace("paises", lands(spark, 1))
    other = Layer(spark, f"other_{uuid.uuid4().hex}", layer.location)
    other.replace("paises", lands(spark, 5, 6))
    again = Layer(spark, layer.name, layer.location)
    assert rows(again.read("paises").select("pais_code")) == [(5,), (6,)]


def test_quoted_location(spark, tmp_path):
    layer = Layer(spark, f"q_{uuid.uuid4().hex}", str(tmp_path / "it's here"))
    layer.replace("paises", lands(spark, 4))
    assert layer.read("paises").count() == 1


def test_clustered_table_is_pruned_by_its_leading_columns(spark, layer):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(0, 20_000, 1, 6).selectExpr("id AS k", "concat('u', id % 5) AS uf", "id % 40 AS city")
        layer.replace("t", df, ["k", "uf"], ["uf", "city", "k"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    stored = layer.read("t").withColumn("file", F.input_file_name())
    assert stored.count() == 20_000
    files = stored.select("file").distinct().count()
    per_state = stored.groupBy("uf").agg(F.count_distinct("file").alias("n")).collect()
    assert files >= 4 and all(r.n <= files // 2 for r in per_state)
    per_file = stored.groupBy("file").agg(F.collect_list(F.struct("uf", "city", "k")).alias("order"))
    assert all(row.order == sorted(row.order) for row in per_file.collect())


def test_lookups_become_bloom_filters(spark, layer, tmp_path):
    df = spark.range(0, 300_000, 1, 1).selectExpr("sha2(cast(id AS string), 256) AS k", "id AS n")
    layer.replace("t", df, [["k", "n"]])
    jvm = spark._jvm
    [file] = (tmp_path / "silver" / "t").glob("*/*.parquet")
    path = jvm.org.apache.hadoop.fs.Path(str(file))
    source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(
        path, spark._jsc.hadoopConfiguration()
    )
    footer = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source).getFooter()
    with_bloom = [
        column.getPath().toDotString()
        for column in footer.getBlocks().get(0).getColumns()
        if column.getBloomFilterOffset() > 0
    ]
    assert with_bloom == ["k", "_key_k_n"]
    with pytest.raises(ValueError, match="Empty lookup path"):
        layer.replace("t", df, ["k", []])


def rows_scanned(df):
    """Rows that the scan of a plan without shuffles gave, row groups passed over left out."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return leaves.apply(0).metrics().get("numOutputRows").get().value()


def test_composite_lookups_pass_over_row_groups(spark, layer):
    df = spark.range(0, 200_000, 1, 1).selectExpr(
        "id", "concat('c', id % 5000) AS city", "concat('a', (id * 7919) % 6007) AS activity", "id % 3 AS x"
    )
    lookups = ["id", ["city", "activity"], ["id", "city"]]
    small = {"parquet.block.size": str(256 << 10), "parquet.bloom.filter.max.bytes": str(64 << 10)}
    for key, value in small.items():
        spark._jsc.hadoopConfiguration().set(key, value)
    try:
        layer.replace("t", df, lookups)
    finally:
        for key in small:
            spark._jsc.hadoopConfiguration().unset(key)
    assert layer.columns("t") == {"id": "bigint", "city": "string", "activity": "string", "x": "bigint"}
    want = df.where("id = 123456").first()
    found = layer.lookup("t", city=want.city, activity=want.activity)
    assert rows(found) == rows(df.where((F.col("city") == want.city) & (F.col("activity") == want.activity)))
    by_hash, by_column = rows_scanned(found), rows_scanned(layer.lookup("t", activity=want.activity))
    assert 0 < by_hash * 5 < by_column
    # Appended rows are found by the same path.
    layer.append("t", spark.createDataFrame([(-1, want.city, want.activity)], "id long, city string, activity string"))
    assert layer.lookup("t", city=want.city, activity=want.activity).count() == found.count() + 1
    assert rows(layer.lookup("t", id=-1, x=None)) == [(-1, want.city, want.activity, None)]
    assert layer.lookup("t", city=want.city, activity=None).count() == 0
    with pytest.raises(ValueError, match="not in table"):
        layer.lookup("t", other=1)
    with pytest.raises(ValueError, match="No table"):
        layer.lookup("none", other=1)


def test_which_paths_are_hashed():
    assert list(hashed_paths("t", ["k", ["k", "a"], ["a", "b"], ["a", "c"]], ["a", "b", "k"]).values()) == [["a", "c"]]


def test_interleaved_layout_serves_every_column(spark, layer):
    df = spark.range(0, 60_000, 1, 4).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'SP' ELSE concat('U', hash(id) % 25) END AS uf",
        "pmod(hash(id, 1), 5000) AS city", "sha2(cast(id AS string), 256) AS k",
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        layer.replace("t", df, ["k", "uf", "city"], interleaving=["uf", "city", "k"])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    stored = layer.read("t").withColumn("file", F.input_file_name())
    assert rows(stored.drop("file")) == rows(df)
    ranges = stored.groupBy("file").agg(*[f(c).alias(f"{n}_{c}") for c in df.columns for n, f in (("lo", F.min), ("hi", F.max))])
    ranges = ranges.collect()
    assert len(ranges) > 50
    probes = df.sample(0.002, seed=3).collect()
    # Of n files a lookup by one of three columns meets about n ** (2 / 3); twice as many at
    # most, as a range of the order may lie across the border of two cells.
    bound = 2 * len(ranges) ** (2 / 3)
    for column in ("city", "k"):
        met = [sum(r[f"lo_{column}"] <= p[column] <= r[f"hi_{column}"] for r in ranges) for p in probes]
        assert sum(met) / len(met) <= bound
    rare = [p for p in probes if p.uf != "SP"]
    met = [sum(r.lo_uf <= p.uf <= r.hi_uf for r in ranges) for p in rare]
    assert sum(met) / len(met) <= bound


def test_profile_is_measured_with_the_write(spark, layer):
    df = spark.createDataFrame([(1, "", 1.5), (None, "b", None), (3, None, -2.0)], "n int, s string, v double")
    layer.replace("t", df.repartition(3), profile=True)
    want = [("n", 3, 1, 0, "1", "3"), ("s", 3, 1, 1, "", "b"), ("v", 3, 1, 0, "-2.0", "1.5")]
    assert rows(layer.profile("t")) == want
    again = Layer(spark, f"again_{uuid.uuid4().hex}", layer.location)
    assert rows(again.profile("t")) == want
    layer.replace("t", df)
    assert layer.profile("t").count() == 0


def test_functions_that_return_tables(spark, layer):
    df = spark.createDataFrame([(1, "", "x"), (1, "a", None), (2, "b", "y"), (None, "c", "")], "k int, s string, t string")
    layer.replace("t", df)
    assert rows(layer.query("SELECT * FROM t_first_per('k')")) == [(1, "", "x"), (2, "b", "y"), (None, "c", "")]
    assert rows(layer.query("SELECT s, t FROM t_blank_to_null() WHERE k = 1")) == [("a", None), (None, "x")]
    joined = layer.query("SELECT a.k FROM t_first_per('k') a LEFT SEMI JOIN t_blank_to_null() b ON a.s = b.s")
    assert rows(joined) == [(2,), (None,)]
    plan = layer.query("SELECT * FROM t_first_per('k')")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    layer.replace("t", df.select("k", "s"))
    assert layer.query("SELECT * FROM t_first_per('s')").columns == ["k", "s"]
    with pytest.raises(Exception, match="not a column"):
        layer.query("SELECT * FROM t_first_per('t')").collect()


def test_created_tables_are_written_for_their_lookups(spark, layer):
    layer.create("socios", DATASETS["socios"])
    options = spark.sql(f"SHOW CREATE TABLE {layer.name}.socios").first()[0]
    assert "zstd" in options and "bloom.filter.enabled#cnpj_base" in options


def test_drop_is_idempotent(spark, layer):
    layer.replace("paises", lands(spark, 8))
    layer.drop("paises")
    layer.drop("paises")
    assert layer.tables() == [] and not layer.exists("paises")
    assert Layer(spark, f"again_{uuid.uuid4().hex}", layer.location).tables() == []


def test_query_sees_the_layer_and_only_reads(spark, layer):
    layer.replace("paises", lands(spark, 3, 4, 5))
    before = spark.catalog.currentDatabase()
    assert rows(layer.query("SELECT pais_name FROM paises WHERE pais_code > 3;")) == [
        ("pais 4",), ("pais 5",)
    ]
    assert rows(layer.query("WITH p AS (SELECT * FROM paises) SELECT count(*) FROM p")) == [(3,)]
    for statement in ["DROP TABLE paises", "INSERT INTO paises VALUES (3, 'C')"]:
        with pytest.raises(Exception, match="SYNTAX"):
            layer.query(statement)
    assert layer.read("paises").count() == 3
    assert spark.catalog.currentDatabase() == before


def test_staged_reads_back_the_rows(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b")], "n int, s string")
    assert rows(staged(df)) == rows(df)
    assert staged(df.where("false")).count() == 0


def test_work_folder_follows_the_session(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert work_folder(spark).startswith(shared) and work_folder(spark) != work_folder(spark)


def test_one_resolver_for_paths(spark, tmp_path):
    files = Files(spark)
    assert files.qualified(str(tmp_path)) == files.qualified(f"file:{tmp_path}") == f"file:{tmp_path}"
    assert pyarrow_uri("s3a://b/k") == "s3://b/k" and pyarrow_uri("hdfs:/x") == "hdfs:///x"
    assert pyarrow_uri("/plain") == "/plain" and pyarrow_uri("hdfs://n:1/x") == "hdfs://n:1/x"
    assert resolve(f"file:{tmp_path}")[1] == resolve(str(tmp_path))[1] == str(tmp_path)
    assert files.create_new(files.qualified(f"{tmp_path}/note"), "è")
    assert not files.create_new(files.qualified(f"{tmp_path}/note"), "é")
    assert files.read_text(f"{tmp_path}/note") == "è" and files.read_text(f"{tmp_path}/none") is None
    assert files.names(str(tmp_path)) == ["note"] and files.directories(f"{tmp_path}/no") == []
