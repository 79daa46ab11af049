"""

The given tables play registry roles. Customers are companies (two customers share a key,
some have none), orders are establishments, events are partners, suppliers the tax regime,
nations the cities and regions the activity codes. The tables hold no NULL and no blank, so
the roles add both.
"""

from __future__ import annotations

import logging
import sys
from collections.abc import Callable
from functools import cache, reduce
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession, functions as F

from registrylake.corpus import conform, write_archives, write_text
from registrylake.functions.text import name_number, name_prefix
from registrylake.operators.joins import enrich_with_max, full_outer_using, keep_known_keys
from registrylake.operators.keys import distinct_keys, distinct_values, first_per_key, row_count
from registrylake.operators.rows import blank_to_null, drop_columns, exclude_codes, in_or_null
from registrylake.plans.gold import build_gold
from registrylake.plans.silver import ingest_silver
from registrylake.schemas import DATASETS, Dataset
from registrylake.sources.delimited import (
    accepted,
    rejected,
    scan_archives,
    scan_delimited,
    scan_inferred,
    strict,
)
from registrylake.tables.layer import Layer
from registrylake.tables.work import work_folder

log = logging.getLogger(__name__)

SMOKE_DIR = "/root/testdata/sf0.001"

CUSTOMER = Dataset.of(
    "customer",
    "c_custkey u64, c_name text, c_nationkey u16, c_acctbal f64, c_mktsegment text",
)
ORDERS = Dataset.of(
    "orders",
    "o_orderkey u64, o_custkey u64, o_orderstatus text, o_totalprice f64, o_orderpriority text",
)
SUPPLIER = Dataset.of("supplier", "s_suppkey u64, s_name text, s_nationkey u16, s_acctbal f64")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _new_layer(spark: SparkSession, folder: str, kind: str) -> Layer:
    """A layer in a new folder; the folder name makes the database name unique."""
    return Layer(spark, f"{kind}_{folder.rsplit('/', 1)[-1]}", f"{folder}/{kind}")


# Registry roles


def _companies(spark, sf_dir):
    segment = F.col("c_mktsegment")
    return _table(spark, sf_dir, "customer").select(
        F.expr("CASE WHEN c_nationkey <> 7 THEN nullif((c_custkey div 2) * 3, 0) END").alias("cust"),
        "c_name",
        F.when(segment == "BUILDING", "").otherwise(segment).alias("seg"),
        "c_nationkey",
    )


def _establishments(spark, sf_dir):
    priority = F.col("o_orderpriority")
    return _table(spark, sf_dir, "orders").select(
        F.when(priority != "1-URGENT", F.col("o_custkey")).alias("cust"),
        "o_orderkey",
        F.nullif("o_orderstatus", F.lit("P")).alias("st"),
        F.when(priority == "2-HIGH", "").otherwise(priority).alias("pri"),
        "o_totalprice",
    )


def _gold(spark, sf_dir):
    joined = full_outer_using(
        first_per_key(_companies(spark, sf_dir), "cust"), _establishments(spark, sf_dir), "cust"
    )
    kept = joined.where(in_or_null("c_nationkey", [1, 2, 3, 4, 5]) & in_or_null("st", ["F"]))
    return blank_to_null(kept)


_ROLES = """
WITH emp_raw AS (
  SELECT CASE WHEN c_nationkey <> 7 THEN nullif((c_custkey // 2) * 3, 0) END AS cust, c_name,
         CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE c_mktsegment END AS seg, c_nationkey
  FROM customer),
emp AS (SELECT DISTINCT ON (cust) * FROM emp_raw
        ORDER BY cust, c_name NULLS LAST, seg NULLS LAST, c_nationkey NULLS LAST),
est AS (
  SELECT CASE WHEN o_orderpriority <> '1-URGENT' THEN o_custkey END AS cust, o_orderkey,
         nullif(o_orderstatus, 'P') AS st,
         CASE WHEN o_orderpriority = '2-HIGH' THEN '' ELSE o_orderpriority END AS pri, o_totalprice
  FROM orders),
gold AS (
  SELECT cust, c_name, nullif(seg, '') AS seg, c_nationkey, o_orderkey, st,
         nullif(pri, '') AS pri, o_totalprice
  FROM emp FULL OUTER JOIN est USING (cust)
  WHERE (c_nationkey IN (1, 2, 3, 4, 5) OR c_nationkey IS NULL)
    AND (st IN ('F') OR st IS NULL))
"""


# Transforms


def dedup_first_per_key(spark, sf_dir):
    return first_per_key(_companies(spark, sf_dir), "cust")


def full_outer_using_filter(spark, sf_dir):
    return _gold(spark, sf_dir)


def semi_join_gold(spark, sf_dir):
    events = _table(spark, sf_dir, "events").select(
        "event_id", F.col("user_id").alias("cust"), "event_type"
    )
    known = distinct_values(_gold(spark, sf_dir), "cust")
    kept = blank_to_null(keep_known_keys(events, known, "cust"))
    return kept.withColumnRenamed("cust", "user_id")


def semi_join_using(spark, sf_dir):
    supplier = _table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("cust"), "s_name", "s_acctbal"
    )
    known = distinct_values(_gold(spark, sf_dir), "cust")
    return blank_to_null(keep_known_keys(supplier, known, "cust"))


def dim_enrich_max(spark, sf_dir):
    nation = _table(spark, sf_dir, "nation")
    facts = _gold(spark, sf_dir).withColumnRenamed("c_nationkey", "n_nationkey")
    return enrich_with_max(nation, facts, "n_nationkey", "seg")


def exclude_codes_query(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders").select(
        "o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("st")
    )
    return exclude_codes(orders, spark.createDataFrame([("F",)], "st string"), "st")


def union_distinct_keys(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders").select(F.expr("nullif(o_custkey, 1)").alias("k"))
    customers = _table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"))
    return distinct_keys([orders, customers], "k")


def semi_join_key_union(spark, sf_dir):
    events = _table(spark, sf_dir, "events").select("event_id", "user_id")
    orders = _table(spark, sf_dir, "orders").select((F.col("o_custkey") * 3).alias("user_id"))
    customers = _table(spark, sf_dir, "customer").select((F.col("c_custkey") * 5).alias("user_id"))
    return keep_known_keys(
        events, distinct_keys([orders, customers], "user_id"), "user_id"
    ).select("event_id", "user_id")


def distinct_non_null(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders")
    return distinct_values(orders.select(F.nullif("o_orderstatus", F.lit("P")).alias("st")), "st")


def blank_to_null_query(spark, sf_dir):
    kind = F.col("event_type")
    events = _table(spark, sf_dir, "events")
    return blank_to_null(
        events.withColumn("event_type", F.when(kind == "click", "").otherwise(kind))
    )


def dim_copy(spark, sf_dir):
    return blank_to_null(_table(spark, sf_dir, "region"))


def row_count_query(spark, sf_dir):
    return row_count(_table(spark, sf_dir, "lineitem"))


def split_name_number(spark, sf_dir):
    name = F.col("c_name")
    return _table(spark, sf_dir, "customer").select(
        "c_name", name_prefix(name).alias("prefix"), name_number(name).alias("num")
    )


# Sources


def typed_csv_scan(spark, sf_dir):
    path = f"{work_folder(spark)}/customer"
    write_text(_table(spark, sf_dir, "customer").select(CUSTOMER.names), path)
    return strict(scan_delimited(spark, path, CUSTOMER, encoding="ISO-8859-1"))


def archive_ingest(spark, sf_dir):
    folder = work_folder(spark)
    orders = _table(spark, sf_dir, "orders").select(ORDERS.names)
    write_archives(orders, folder, "Orders")
    return strict(scan_archives(spark, folder, "Orders*.zip", ORDERS))


def archive_stray_quotes(spark, sf_dir):
    """Names with a lone inch mark, in files that quote nothing."""
    folder = work_folder(spark)
    inch = F.when(F.col("c_nationkey") % 3 == 0, F.concat("c_name", F.lit(' 5" wide')))
    customers = _table(spark, sf_dir, "customer").select(CUSTOMER.names)
    named = customers.withColumn("c_name", F.coalesce(inch, "c_name"))
    write_archives(named, folder, "Customer", quoted=False)
    return accepted(scan_archives(spark, folder, "Customer*.zip", CUSTOMER))


def inferred_csv_scan(spark, sf_dir):
    path = f"{work_folder(spark)}/nation"
    write_text(_table(spark, sf_dir, "nation"), path)
    return scan_inferred(spark, path)


def missing_archive_empty(spark, sf_dir):
    folder = work_folder(spark)
    write_archives(_table(spark, sf_dir, "supplier").select(SUPPLIER.names), folder, "Supplier")
    present = strict(scan_archives(spark, folder, "Supplier*.zip", SUPPLIER))
    missing = strict(scan_archives(spark, folder, "Formersupplier*.zip", SUPPLIER))
    return present.union(missing).select("s_suppkey", "s_name")


def quarantine_bad_rows(spark, sf_dir):
    folder = work_folder(spark)
    # Customers in debt get an unreadable nation number.
    nation = F.when(F.col("c_acctbal") < 0, "zz").otherwise(F.col("c_nationkey").cast("string"))
    customers = _table(spark, sf_dir, "customer").select(CUSTOMER.names)
    write_archives(customers.withColumn("c_nationkey", nation), folder, "Customer")
    scanned = scan_archives(spark, folder, "Customer*.zip", CUSTOMER)
    outcome = accepted(scanned).select("c_custkey", F.lit("kept").alias("outcome"))
    return outcome.union(rejected(scanned).select("c_custkey", F.col("_reason")))


TYPES = Dataset.of(
    "types",
    "key u64, small_count u16, count u32, short i16, number i32, amount f64, flag bool, day date, "
    "moment datetime, name text",
)


def declared_types(spark, sf_dir):
    """A column of every declared type, written as text into archives and read back."""
    folder, n = work_folder(spark), F.col("event_id")
    second = n % 86400
    text = _table(spark, sf_dir, "events").select(
        n.alias("key"),
        (n % 60000).alias("small_count"),
        (n % 4000000000).alias("count"),
        (n % 100 - 50).alias("short"),
        (n - 500).alias("number"),
        (n / 4).alias("amount"),
        (n % 2 == 0).cast("string").alias("flag"),
        F.date_add(F.lit("2020-01-01").cast("date"), (n % 1000).cast("int")).cast("string").alias("day"),
        F.format_string(
            "2020-01-01 %02d:%02d:%02d",
            F.floor(second / 3600), F.floor(second / 60) % 60, second % 60,
        ).alias("moment"),
        F.col("event_type").alias("name"),
    )
    write_archives(text, folder, "Types")
    read = strict(scan_archives(spark, folder, "Types*.zip", TYPES))
    if read.schema != TYPES.struct:
        raise AssertionError(f"{read.schema}")
    whole = {name: F.col(name).cast("long") for name in ("small_count", "short", "number")}
    texts = {name: F.col(name).cast("string") for name in ("day", "moment")}
    return read.withColumns(whole | texts)


def drop_columns_query(spark, sf_dir):
    return drop_columns(_table(spark, sf_dir, "supplier"), ["s_nationkey", "s_acctbal"])


# Tables


def read_table(spark, sf_dir):
    layer = _new_layer(spark, work_folder(spark), "silver")
    layer.replace("supplier", _table(spark, sf_dir, "supplier"), ["s_suppkey"])
    return layer.read("supplier")


def rerun_overwrite(spark, sf_dir):
    layer = _new_layer(spark, work_folder(spark), "gold")
    for _ in range(2):
        layer.replace("part", _table(spark, sf_dir, "part"), ["p_partkey"])
    return layer.read("part")


def replace_failure_keeps_table(spark, sf_dir):
    layer = _new_layer(spark, work_folder(spark), "gold")
    part = _table(spark, sf_dir, "part")
    layer.replace("part", part, ["p_partkey"])
    # One writer stops before its rows are published, another fails while it writes them.
    layer.build().replace("part", part.where("p_partkey % 2 = 0"))
    try:
        layer.replace("part", part.withColumn("p_name", F.raise_error(F.col("p_name"))))
    except Exception:  # noqa: BLE001  the failure is the point
        return Layer(spark, f"again_{layer.name}", layer.location).read("part")
    raise AssertionError("the write should have failed")


_PUBLISHED = ["region", "nation", "supplier", "customer", "part", "orders", "events", "lineitem"]


def publish_as_a_whole(spark, sf_dir):
    """The fifth table of a second build fails; all eight are those of the first."""
    layer = _new_layer(spark, work_folder(spark), "gold")
    tables = {name: _table(spark, sf_dir, name) for name in _PUBLISHED}
    with layer.build() as new:
        for name, df in tables.items():
            new.replace(name, df)
    try:
        with layer.build() as new:
            for i, (name, df) in enumerate(tables.items()):
                first = df.columns[0]
                bad = F.raise_error(F.lit(name)).cast(df.schema[first].dataType)
                new.replace(name, df.withColumn(first, bad) if i == 4 else df.where(f"{first} % 2 = 0"))
    except Exception:  # noqa: BLE001  the failure is the point
        return _counts(Layer(spark, f"again_{layer.name}", layer.location), _PUBLISHED)
    raise AssertionError("the build should have failed")


def append_retry(spark, sf_dir):
    """Two batches of customers; each is tried twice, and counts once."""
    layer = _new_layer(spark, work_folder(spark), "silver")
    layer.create("customer", CUSTOMER)
    customers = _table(spark, sf_dir, "customer").select(CUSTOMER.names)
    for batch in ("even", "odd", "even", "odd"):
        layer.append("customer", customers.where(f"c_custkey % 2 = {int(batch == 'odd')}"), batch)
    return layer.read("customer")


def reopen_layer(spark, sf_dir):
    folder = work_folder(spark)
    layer = _new_layer(spark, folder, "gold")
    layer.create("customer", CUSTOMER)
    layer.replace("supplier", _table(spark, sf_dir, "supplier"), ["s_suppkey"])
    again = Layer(spark, f"again_{folder.rsplit('/', 1)[-1]}", layer.location)
    again.append("customer", _table(spark, sf_dir, "customer").select("c_custkey", "c_name"))
    return again.read("customer").join(
        again.read("supplier").withColumnRenamed("s_suppkey", "c_custkey"), "c_custkey"
    ).select("c_custkey", "c_name", "c_acctbal", "s_name")


def table_exists(spark, sf_dir):
    layer = _new_layer(spark, work_folder(spark), "silver")
    layer.replace("nation", _table(spark, sf_dir, "nation"))
    layer.replace("region", _table(spark, sf_dir, "region"))
    layer.drop("region")
    found = [F.when(F.lit(layer.exists(t)), F.lit(t)) for t in ("nation", "region", "no table")]
    return layer.read("nation").select("n_nationkey", F.array_join(F.array(*found), ",").alias("tables"))


def append_records(spark, sf_dir):
    layer = _new_layer(spark, work_folder(spark), "silver")
    layer.create("customer", CUSTOMER)
    layer.append("customer", _table(spark, sf_dir, "customer"))
    layer.append_records("customer", [{"c_custkey": -1, "c_name": "EXTRA"}, {"c_custkey": -2}])
    return layer.read("customer")


def layout_roundtrip(spark, sf_dir):
    layer = _new_layer(spark, work_folder(spark), "gold")
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    layer.replace("orders", orders, ["o_orderkey", ["o_custkey", "o_orderkey"]], ["o_custkey"])
    return layer.read("orders")


def lookup_composite(spark, sf_dir):
    """Lineitems of one part and supplier, by the hash of both."""
    layer = _new_layer(spark, work_folder(spark), "gold")
    items = _table(spark, sf_dir, "lineitem")
    layer.replace("lineitem", items, ["l_orderkey", ["l_partkey", "l_suppkey"]])
    key = items.agg(F.max(F.struct("l_partkey", "l_suppkey")).alias("k")).first().k
    found = layer.lookup("lineitem", l_partkey=key.l_partkey, l_suppkey=key.l_suppkey)
    return found.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")


def interleaved_roundtrip(spark, sf_dir):
    layer = _new_layer(spark, work_folder(spark), "silver")
    customers = _table(spark, sf_dir, "customer").select(CUSTOMER.names)
    layer.replace("customer", customers, interleaving=["c_nationkey", "c_mktsegment", "c_custkey"])
    return layer.read("customer")


def contract_report(spark, sf_dir):
    """NULLs, blanks and ends of all columns, measured while the table was written."""
    layer = _new_layer(spark, work_folder(spark), "silver")
    customers = _table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    segment = F.when(F.col("c_nationkey") % 3 == 0, "").when(F.col("c_nationkey") % 3 == 1, F.col("c_mktsegment"))
    layer.replace("customer", customers.withColumn("c_mktsegment", segment), profile=True)
    return layer.profile("customer")


def adhoc_sql_functions(spark, sf_dir):
    """One customer per nation with blanks as NULL, by the layer's own functions."""
    layer = _new_layer(spark, work_folder(spark), "gold")
    segment = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).otherwise("")
    customers = _table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    layer.replace("customer", customers.withColumn("c_mktsegment", segment))
    return layer.query("""
        SELECT f.c_nationkey, f.c_custkey, b.c_mktsegment
        FROM customer_first_per('c_nationkey') f
        JOIN customer_blank_to_null() b ON f.c_custkey = b.c_custkey""")


def list_tables(spark, sf_dir):
    layer = _new_layer(spark, work_folder(spark), "silver")
    for name in ["customer", "supplier", "nation"]:
        layer.replace(name, _table(spark, sf_dir, name))
    counts = [
        layer.row_count(name).select(F.lit(name).alias("table_name"), "n")
        for name in layer.tables()
    ]
    return counts[0].union(counts[1]).union(counts[2])


def describe_columns(spark, sf_dir):
    layer = _new_layer(spark, work_folder(spark), "silver")
    layer.replace("customer", _table(spark, sf_dir, "customer"))
    stored = layer.columns("customer")
    filled = layer.read("customer").agg(*[F.count(name).alias(name) for name in stored])
    described = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.lit(kind).alias("data_type"),
            F.col(name).alias("filled"),
        )
        for name, kind in stored.items()
    ]
    return filled.select(F.inline(F.array(*described)))


def adhoc_sql(spark, sf_dir):
    layer = _new_layer(spark, work_folder(spark), "gold")
    for name in ["nation", "region", "customer"]:
        layer.replace(name, _table(spark, sf_dir, name))
    return layer.query(
        """
        SELECT r_name, count(*) AS n, count(DISTINCT n_nationkey) AS nations
        FROM customer
        JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey
        GROUP BY r_name
        """
    )


# Jobs


def _registry_tables(spark, sf_dir) -> dict[str, DataFrame]:
    """The given tables in the shape of the registry datasets."""
    text = {
        "empresas": _table(spark, sf_dir, "customer").select(
            ((F.col("c_custkey") - F.col("c_custkey") % 2) * 5).cast("string").alias("cnpj_base"),
            F.col("c_name").alias("razao_social"),
            F.col("c_nationkey").alias("natureza_code"),
            F.col("c_acctbal").alias("capital_social"),
            F.when(F.col("c_mktsegment") == "BUILDING", "")
            .otherwise(F.col("c_mktsegment"))
            .alias("ente_federativo_responsavel"),
        ),
        "estabelecimentos": _table(spark, sf_dir, "orders").select(
            (F.col("o_custkey") * 3).cast("string").alias("cnpj_base"),
            F.col("o_orderkey").cast("string").alias("cnpj_ordem"),
            F.when(F.col("o_orderstatus") == "F", 2)
            .when(F.col("o_orderstatus") == "O", 8)
            .alias("situacao_cadastral"),
            F.when(F.col("o_orderpriority") == "1-URGENT", 249)
            .when(F.col("o_orderpriority") != "2-HIGH", 105)
            .alias("pais_code"),
            F.when(F.col("o_orderpriority") == "5-LOW", "")
            .otherwise(F.substring("o_orderpriority", 1, 1))
            .alias("uf"),
            (F.col("o_custkey") % 25).alias("municipio_code"),
        ),
        "socios": _table(spark, sf_dir, "events").select(
            F.col("user_id").cast("string").alias("cnpj_base"),
            F.col("event_type").alias("nome_socio"),
            F.col("event_id").alias("faixa_etaria"),
        ),
        "simples": _table(spark, sf_dir, "supplier").select(
            F.col("s_suppkey").cast("string").alias("cnpj_base"),
            F.col("s_name").alias("opcao_pelo_simples"),
        ),
        "municipios": _table(spark, sf_dir, "nation").select(
            F.col("n_nationkey").alias("municipio_code"), F.col("n_name").alias("municipio_nome")
        ),
        "cnaes": _table(spark, sf_dir, "region").select(
            F.col("r_regionkey").cast("string").alias("cnaes_code"),
            F.col("r_name").alias("description"),
        ),
        "naturezas": _table(spark, sf_dir, "nation").select(
            F.col("n_nationkey").alias("natureza_code"),
            F.when(F.col("n_regionkey") == 1, "")
            .otherwise(F.col("n_name"))
            .alias("natureza_juridica_descricao"),
        ),
        "qualificacoes": _table(spark, sf_dir, "part").select(
            F.col("p_partkey").alias("qualificacao_code"),
            F.col("p_name").alias("qualificacao_descricao"),
        ),
    }
    return {name: conform(df, DATASETS[name].struct) for name, df in text.items()}


_REGISTRY = """
WITH empresas AS (
  SELECT CAST((c_custkey - c_custkey % 2) * 5 AS VARCHAR) AS cnpj_base, c_name AS razao_social,
         c_nationkey AS natureza_code, c_acctbal AS capital_social,
         CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE c_mktsegment END
           AS ente_federativo_responsavel
  FROM customer WHERE c_nationkey NOT IN (0, 1, 2)),
estabelecimentos AS (
  SELECT CAST(o_custkey * 3 AS VARCHAR) AS cnpj_base, CAST(o_orderkey AS VARCHAR) AS cnpj_ordem,
         CASE o_orderstatus WHEN 'F' THEN 2 WHEN 'O' THEN 8 END AS situacao_cadastral,
         CAST(CASE WHEN o_orderpriority = '1-URGENT' THEN 249
                   WHEN o_orderpriority <> '2-HIGH' THEN 105 END AS BIGINT) AS pais_code,
         CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE substr(o_orderpriority, 1, 1) END AS uf,
         o_custkey % 25 AS municipio_code
  FROM orders),
socios AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS cnpj_base, event_type AS nome_socio FROM events
  WHERE CAST(user_id AS VARCHAR) IN
    (SELECT cnpj_base FROM empresas UNION SELECT cnpj_base FROM estabelecimentos)),
simples AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS cnpj_base, s_name AS opcao_pelo_simples FROM supplier),
gold AS (
  SELECT cnpj_base, razao_social, natureza_code, capital_social,
         nullif(ente_federativo_responsavel, '') AS ente_federativo_responsavel,
         cnpj_ordem, situacao_cadastral, pais_code, nullif(uf, '') AS uf, municipio_code
  FROM (SELECT DISTINCT ON (cnpj_base) * FROM empresas
        ORDER BY cnpj_base, razao_social, natureza_code)
  FULL OUTER JOIN estabelecimentos USING (cnpj_base)
  WHERE (pais_code IN (105, 106, 997, 998, 999) OR pais_code IS NULL)
    AND (situacao_cadastral IN (2) OR situacao_cadastral IS NULL))
"""


def write_bronze(spark, sf_dir, folder: str, skip: str = "") -> str:
    """The archives and lists that the jobs start from, made of the given tables."""
    bronze = f"{folder}/bronze"
    for name, df in _registry_tables(spark, sf_dir).items():
        if name != skip:
            write_archives(df, bronze, name.capitalize())
    excluded = spark.createDataFrame([(0,), (1,), (2,)], "natureza_code long")
    write_text(excluded, f"{bronze}/naturezas_nao_empresas.csv")
    food = _table(spark, sf_dir, "region").select(
        F.col("r_name").alias("categoria"), F.col("r_regionkey").cast("string").alias("cnaes_code")
    )
    write_text(food, f"{bronze}/cnae_alimenticio.csv")
    return bronze


def jobs(spark, sf_dir) -> tuple[Layer, Layer]:
    """Silver and gold of the given tables; once per session and folder, while they are there."""
    layers = _jobs(spark, sf_dir)
    if not all(layer.files.exists(layer.location) for layer in layers):
        _jobs.cache_clear()
        layers = _jobs(spark, sf_dir)
    return layers


@cache
def _jobs(spark, sf_dir) -> tuple[Layer, Layer]:
    folder = work_folder(spark)
    bronze = write_bronze(spark, sf_dir, folder)
    silver, gold = (_new_layer(spark, folder, kind) for kind in ("silver", "gold"))
    ingest_silver(spark, bronze, silver)
    build_gold(silver, gold)
    return silver, gold


def ingest_silver_counts(spark, sf_dir):
    silver, _ = jobs(spark, sf_dir)
    return _counts(silver, sorted(DATASETS))


def ingest_silver_estabelecimentos(spark, sf_dir):
    return jobs(spark, sf_dir)[0].read("estabelecimentos").select(
        "cnpj_base", "cnpj_ordem", "situacao_cadastral", "pais_code", "uf", "municipio_code"
    )


def ingest_silver_socios(spark, sf_dir):
    return jobs(spark, sf_dir)[0].read("socios").select("cnpj_base", "nome_socio", "faixa_etaria")


def ingest_silver_rejected(spark, sf_dir):
    """Partners whose age band does not fit are set aside, the others are kept."""
    folder = work_folder(spark)
    bronze = f"{folder}/bronze"
    tables = _registry_tables(spark, sf_dir)
    partners = tables.pop("socios").withColumn(
        "faixa_etaria",
        F.when(F.col("faixa_etaria") % 10 == 0, "x").otherwise(F.col("faixa_etaria").cast("string")),
    )
    for name in ("empresas", "estabelecimentos"):
        write_archives(tables[name], bronze, name.capitalize())
    write_archives(partners, bronze, "Socios")
    excluded = spark.createDataFrame([(0,), (1,), (2,)], "natureza_code long")
    write_text(excluded, f"{bronze}/naturezas_nao_empresas.csv")
    silver = _new_layer(spark, folder, "silver")
    ingest_silver(spark, bronze, silver, quarantine=True)
    reasons = silver.read("socios_rejected").groupBy(F.col("_reason").alias("tbl"))
    return _counts(silver, ["socios"]).union(reasons.agg(F.count(F.lit(1)).alias("n")))


def ingest_incremental(spark, sf_dir):
    """Half of the establishments' archives change between two ingests; the rest is not read."""
    folder = work_folder(spark)
    bronze = write_bronze(spark, sf_dir, folder, skip="estabelecimentos")
    rows = _registry_tables(spark, sf_dir)["estabelecimentos"]
    odd = F.col("cnpj_ordem").cast("long") % 2 == 1
    write_archives(rows.where(~odd), bronze, "Estabelecimentos1")
    write_archives(rows.where(odd), bronze, "Estabelecimentos2")
    silver = _new_layer(spark, folder, "silver")
    ingest_silver(spark, bronze, silver, incremental=True)
    changed = rows.where(odd).withColumn("nome_fantasia", F.lit("changed"))
    write_archives(changed, bronze, "Estabelecimentos2")
    ingest_silver(spark, bronze, silver, incremental=True)
    return silver.read("estabelecimentos").select(
        "cnpj_base", "cnpj_ordem", "nome_fantasia", "situacao_cadastral", "pais_code", "uf", "municipio_code"
    )


def build_gold_counts(spark, sf_dir):
    _, gold = jobs(spark, sf_dir)
    return _counts(gold, sorted(gold.tables()))


def build_gold_empresas(spark, sf_dir):
    """All columns; those that the given tables do not fill are NULL."""
    return jobs(spark, sf_dir)[1].read("empresas")


def build_gold_socios(spark, sf_dir):
    return jobs(spark, sf_dir)[1].read("socios").select("cnpj_base", "nome_socio", "faixa_etaria")


def build_gold_simples(spark, sf_dir):
    return jobs(spark, sf_dir)[1].read("simples").select("cnpj_base", "opcao_pelo_simples")


def build_gold_municipios(spark, sf_dir):
    return jobs(spark, sf_dir)[1].read("municipios")


def build_gold_food(spark, sf_dir):
    return jobs(spark, sf_dir)[1].read("cnae_alimenticio").select("cnaes_code", "categoria")


def build_gold_codes(spark, sf_dir):
    """The rows of the four copied tables."""
    _, gold = jobs(spark, sf_dir)
    columns = {
        "cnaes": ("cnaes_code", "description"),
        "cnae_alimenticio": ("cnaes_code", "categoria"),
        "naturezas": ("natureza_code", "natureza_juridica_descricao"),
        "qualificacoes": ("qualificacao_code", "qualificacao_descricao"),
    }
    copied = [
        gold.read(table).select(
            F.lit(table).alias("tbl"), F.col(code).cast("string").alias("code"), F.col(text).alias("description")
        )
        for table, (code, text) in columns.items()
    ]
    return reduce(DataFrame.union, copied)


def _gold_columns() -> str:
    """The 36 columns of gold companies; most are not filled here."""
    filled = {
        "cnpj_base", "razao_social", "natureza_code", "capital_social",
        "ente_federativo_responsavel", "cnpj_ordem", "situacao_cadastral", "pais_code", "uf",
        "municipio_code",
    }
    names = {**DATASETS["empresas"].columns, **DATASETS["estabelecimentos"].columns}
    kinds = {"text": "VARCHAR", "f64": "DOUBLE"}
    return ", ".join(
        f"CAST({name if name in filled else 'NULL'} AS {kinds.get(kind, 'BIGINT')}) AS {name}"
        for name, kind in names.items()
    )


def _counts(layer: Layer, tables: list[str]) -> DataFrame:
    counts = [layer.row_count(t).select(F.lit(t).alias("tbl"), "n") for t in tables]
    result = counts[0]
    for count in counts[1:]:
        result = result.union(count)
    return result


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: companies and establishments joined, filtered and cleaned."""
    return full_outer_using_filter(spark, SMOKE_DIR)


def _llm():
    """The queries of the subpackage for training data, if it and all it needs is there."""
    try:
        from registrylake.llm import queries as llm
    except ModuleNotFoundError as error:
        log.warning("no queries for training data: %s", error)
        return None
    return llm


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    llm = _llm()
    return lake_queries() | (llm.queries() if llm else {})


def oracle_sql() -> dict[str, str]:
    llm = _llm()
    return lake_sql() | (llm.oracle_sql() if llm else {})


def lake_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "dedup_first_per_key": dedup_first_per_key,
        "full_outer_using_filter": full_outer_using_filter,
        "semi_join_gold": semi_join_gold,
        "semi_join_using": semi_join_using,
        "dim_enrich_max": dim_enrich_max,
        "exclude_codes": exclude_codes_query,
        "union_distinct_keys": union_distinct_keys,
        "semi_join_key_union": semi_join_key_union,
        "distinct_non_null": distinct_non_null,
        "blank_to_null": blank_to_null_query,
        "dim_copy": dim_copy,
        "row_count": row_count_query,
        "split_name_number": split_name_number,
        "typed_csv_scan": typed_csv_scan,
        "archive_ingest": archive_ingest,
        "archive_stray_quotes": archive_stray_quotes,
        "inferred_csv_scan": inferred_csv_scan,
        "missing_archive_empty": missing_archive_empty,
        "quarantine_bad_rows": quarantine_bad_rows,
        "drop_columns": drop_columns_query,
        "read_table": read_table,
        "rerun_overwrite": rerun_overwrite,
        "replace_failure_keeps_table": replace_failure_keeps_table,
        "lookup_composite": lookup_composite,
        "interleaved_roundtrip": interleaved_roundtrip,
        "contract_report": contract_report,
        "adhoc_sql_functions": adhoc_sql_functions,
        "declared_types": declared_types,
        "build_gold_codes": build_gold_codes,
        "publish_as_a_whole": publish_as_a_whole,
        "append_retry": append_retry,
        "ingest_incremental": ingest_incremental,
        "reopen_layer": reopen_layer,
        "table_exists": table_exists,
        "append_records": append_records,
        "layout_roundtrip": layout_roundtrip,
        "list_tables": list_tables,
        "describe_columns": describe_columns,
        "adhoc_sql": adhoc_sql,
        "ingest_silver_counts": ingest_silver_counts,
        "ingest_silver_estabelecimentos": ingest_silver_estabelecimentos,
        "ingest_silver_socios": ingest_silver_socios,
        "ingest_silver_rejected": ingest_silver_rejected,
        "build_gold_counts": build_gold_counts,
        "build_gold_empresas": build_gold_empresas,
        "build_gold_socios": build_gold_socios,
        "build_gold_simples": build_gold_simples,
        "build_gold_food": build_gold_food,
        "build_gold_municipios": build_gold_municipios,
    }


def lake_sql() -> dict[str, str]:
    return {
        "dedup_first_per_key": _ROLES + "SELECT * FROM emp",
        "full_outer_using_filter": _ROLES + "SELECT * FROM gold",
        "semi_join_gold": _ROLES
        + """
            SELECT e.event_id, e.user_id, nullif(e.event_type, '') AS event_type
            FROM events e SEMI JOIN gold g ON e.user_id = g.cust""",
        "semi_join_using": _ROLES
        + """
            SELECT cust, s_name, s_acctbal
            FROM (SELECT s_suppkey AS cust, nullif(s_name, '') AS s_name, s_acctbal FROM supplier) s
            SEMI JOIN gold USING (cust)""",
        "dim_enrich_max": _ROLES
        + """
            SELECT n_nationkey, n_name, n_regionkey, seg FROM nation
            LEFT JOIN (SELECT c_nationkey AS n_nationkey, max(seg) AS seg FROM gold
                       WHERE seg IS NOT NULL GROUP BY c_nationkey) m USING (n_nationkey)""",
        "exclude_codes": """
            SELECT * FROM (SELECT o_orderkey, nullif(o_orderstatus, 'P') AS st FROM orders)
            WHERE st NOT IN ('F')""",
        "union_distinct_keys": """
            SELECT nullif(o_custkey, 1) AS k FROM orders UNION SELECT c_custkey FROM customer""",
        "semi_join_key_union": """
            SELECT event_id, user_id FROM events WHERE user_id IN
              (SELECT o_custkey * 3 FROM orders UNION SELECT c_custkey * 5 FROM customer)""",
        "distinct_non_null": """
            SELECT DISTINCT st FROM (SELECT nullif(o_orderstatus, 'P') AS st FROM orders)
            WHERE st IS NOT NULL""",
        "blank_to_null": """
            SELECT event_id, ts, user_id,
                   nullif(CASE WHEN event_type = 'click' THEN '' ELSE event_type END, '')
                     AS event_type,
                   value, nullif(props, '') AS props
            FROM events""",
        "dim_copy": "SELECT r_regionkey, nullif(r_name, '') AS r_name FROM region",
        "row_count": "SELECT count(*) AS n FROM lineitem",
        "split_name_number": """
            SELECT c_name, regexp_replace(lower(c_name), '[0-9]+$', '') AS prefix,
                   nullif(regexp_extract(lower(c_name), '([0-9]+)$', 1), '') AS num
            FROM customer""",
        "typed_csv_scan": """
            SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer""",
        "archive_ingest": """
            SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority
            FROM orders""",
        "archive_stray_quotes": """
            SELECT c_custkey, CASE WHEN c_nationkey % 3 = 0 THEN c_name || ' 5" wide' ELSE c_name END
                     AS c_name, c_nationkey, c_acctbal, c_mktsegment
            FROM customer""",
        "inferred_csv_scan": """
            SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, n_name,
                   CAST(n_regionkey AS BIGINT) AS n_regionkey
            FROM nation""",
        "missing_archive_empty": "SELECT s_suppkey, s_name FROM supplier",
        "quarantine_bad_rows": """
            SELECT c_custkey,
                   CASE WHEN c_acctbal < 0 THEN 'bad value: c_nationkey' ELSE 'kept' END AS outcome
            FROM customer""",
        "drop_columns": "SELECT s_suppkey, s_name FROM supplier",
        "read_table": "SELECT * FROM supplier",
        "rerun_overwrite": "SELECT * FROM part",
        "replace_failure_keeps_table": "SELECT * FROM part",
        "reopen_layer": """
            SELECT c_custkey, c_name, CAST(NULL AS DOUBLE) AS c_acctbal, s_name
            FROM customer JOIN supplier ON s_suppkey = c_custkey""",
        "table_exists": "SELECT n_nationkey, 'nation' AS tables FROM nation",
        "append_records": """
            SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
            UNION ALL SELECT -1, 'EXTRA', NULL, NULL, NULL
            UNION ALL SELECT -2, NULL, NULL, NULL, NULL""",
        "layout_roundtrip": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders",
        "list_tables": """
            SELECT 'customer' AS table_name, count(*) AS n FROM customer
            UNION ALL SELECT 'nation', count(*) FROM nation
            UNION ALL SELECT 'supplier', count(*) FROM supplier""",
        "describe_columns": """
            SELECT 'c_custkey' AS column_name, 'bigint' AS data_type, count(c_custkey) AS filled
            FROM customer
            UNION ALL SELECT 'c_name', 'string', count(c_name) FROM customer
            UNION ALL SELECT 'c_nationkey', 'int', count(c_nationkey) FROM customer
            UNION ALL SELECT 'c_acctbal', 'double', count(c_acctbal) FROM customer
            UNION ALL SELECT 'c_mktsegment', 'string', count(c_mktsegment) FROM customer""",
        "adhoc_sql": """
            SELECT r_name, count(*) AS n, count(DISTINCT n_nationkey) AS nations
            FROM customer
            JOIN nation ON c_nationkey = n_nationkey
            JOIN region ON n_regionkey = r_regionkey
            GROUP BY r_name""",
        "ingest_silver_counts": _REGISTRY
        + """
            SELECT 'empresas' AS tbl, count(*) AS n FROM empresas
            UNION ALL SELECT 'estabelecimentos', count(*) FROM estabelecimentos
            UNION ALL SELECT 'socios', count(*) FROM socios
            UNION ALL SELECT 'simples', count(*) FROM simples
            UNION ALL SELECT 'municipios', count(*) FROM nation
            UNION ALL SELECT 'cnaes', count(*) FROM region
            UNION ALL SELECT 'cnae_alimenticio', count(*) FROM region
            UNION ALL SELECT 'naturezas', count(*) FROM nation
            UNION ALL SELECT 'qualificacoes', count(*) FROM part
            UNION ALL SELECT unnest(['motivos', 'paises']), 0""",
        "ingest_silver_estabelecimentos": _REGISTRY
        + """
            SELECT cnpj_base, cnpj_ordem, CAST(situacao_cadastral AS BIGINT) AS situacao_cadastral,
                   pais_code, uf, municipio_code
            FROM estabelecimentos""",
        "publish_as_a_whole": " UNION ALL ".join(
            f"SELECT '{name}' AS tbl, count(*) AS n FROM {name}" for name in _PUBLISHED
        ),
        "lookup_composite": """
            SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem
            WHERE l_partkey = (SELECT max(l_partkey) FROM lineitem) AND l_suppkey =
              (SELECT max(l_suppkey) FROM lineitem
               WHERE l_partkey = (SELECT max(l_partkey) FROM lineitem))""",
        "interleaved_roundtrip": """
            SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer""",
        "contract_report": """
            WITH c AS (
              SELECT c_custkey, c_name, c_nationkey,
                     CASE c_nationkey % 3 WHEN 0 THEN '' WHEN 1 THEN c_mktsegment END AS c_mktsegment
              FROM customer)
            SELECT 'c_custkey' AS column_name, count(*) AS n, count(*) - count(c_custkey) AS nulls,
                   0 AS blanks, CAST(min(c_custkey) AS VARCHAR) AS least,
                   CAST(max(c_custkey) AS VARCHAR) AS most FROM c
            UNION ALL SELECT 'c_name', count(*), count(*) - count(c_name),
                   count(*) FILTER (c_name = ''), min(c_name), max(c_name) FROM c
            UNION ALL SELECT 'c_nationkey', count(*), count(*) - count(c_nationkey), 0,
                   CAST(min(c_nationkey) AS VARCHAR), CAST(max(c_nationkey) AS VARCHAR) FROM c
            UNION ALL SELECT 'c_mktsegment', count(*), count(*) - count(c_mktsegment),
                   count(*) FILTER (c_mktsegment = ''), min(c_mktsegment), max(c_mktsegment)
            FROM c""",
        "adhoc_sql_functions": """
            SELECT c_nationkey, min(c_custkey) AS c_custkey,
                   nullif(arg_min(CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE c_mktsegment END,
                                  c_custkey), '') AS c_mktsegment
            FROM customer GROUP BY c_nationkey""",
        "declared_types": """
            SELECT event_id AS "key", CAST(event_id % 60000 AS BIGINT) AS small_count,
                   CAST(event_id % 4000000000 AS BIGINT) AS count,
                   CAST(event_id % 100 - 50 AS BIGINT) AS short,
                   CAST(event_id - 500 AS BIGINT) AS number, event_id / 4 AS amount,
                   event_id % 2 = 0 AS flag,
                   CAST(CAST('2020-01-01' AS DATE) + CAST(event_id % 1000 AS INTEGER) AS VARCHAR) AS day,
                   strftime(CAST('2020-01-01' AS TIMESTAMP) + to_seconds(event_id % 86400),
                            '%Y-%m-%d %H:%M:%S') AS moment, event_type AS name
            FROM events""",
        "build_gold_codes": """
            SELECT 'cnaes' AS tbl, CAST(r_regionkey AS VARCHAR) AS code,
                   nullif(r_name, '') AS description FROM region
            UNION ALL SELECT 'cnae_alimenticio', CAST(r_regionkey AS VARCHAR), r_name FROM region
            UNION ALL SELECT 'naturezas', CAST(n_nationkey AS VARCHAR),
                   nullif(CASE WHEN n_regionkey = 1 THEN '' ELSE n_name END, '') FROM nation
            UNION ALL SELECT 'qualificacoes', CAST(p_partkey AS VARCHAR), p_name FROM part""",
        "append_retry": """
            SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer""",
        "ingest_incremental": _REGISTRY
        + """
            SELECT cnpj_base, cnpj_ordem,
                   CASE WHEN CAST(cnpj_ordem AS BIGINT) % 2 = 1 THEN 'changed' END AS nome_fantasia,
                   CAST(situacao_cadastral AS BIGINT) AS situacao_cadastral, pais_code, uf,
                   municipio_code
            FROM estabelecimentos""",
        "ingest_silver_socios": _REGISTRY
        + "SELECT cnpj_base, nome_socio, event_id AS faixa_etaria FROM socios",
        "ingest_silver_rejected": _REGISTRY
        + """
            SELECT 'socios' AS tbl, count(*) AS n FROM socios WHERE event_id % 10 <> 0
            UNION ALL SELECT 'bad value: faixa_etaria', count(*) FROM events WHERE event_id % 10 = 0
            """,
        "build_gold_counts": _REGISTRY
        + """
            SELECT 'empresas' AS tbl, count(*) AS n FROM gold
            UNION ALL SELECT 'socios', count(*) FROM socios
              WHERE cnpj_base IN (SELECT cnpj_base FROM gold)
            UNION ALL SELECT 'simples', count(*) FROM simples
              WHERE cnpj_base IN (SELECT cnpj_base FROM gold)
            UNION ALL SELECT 'municipios', count(*) FROM nation
            UNION ALL SELECT 'cnaes', count(*) FROM region
            UNION ALL SELECT 'cnae_alimenticio', count(*) FROM region
            UNION ALL SELECT 'naturezas', count(*) FROM nation
            UNION ALL SELECT 'qualificacoes', count(*) FROM part""",
        "build_gold_empresas": _REGISTRY + f"SELECT {_gold_columns()} FROM gold",
        "build_gold_socios": _REGISTRY
        + """
            SELECT cnpj_base, nome_socio, event_id AS faixa_etaria FROM socios
            WHERE cnpj_base IN (SELECT cnpj_base FROM gold)""",
        "build_gold_simples": _REGISTRY
        + """
            SELECT cnpj_base, opcao_pelo_simples FROM simples
            WHERE cnpj_base IN (SELECT cnpj_base FROM gold)""",
        "build_gold_food": """
            SELECT CAST(r_regionkey AS VARCHAR) AS cnaes_code, r_name AS categoria FROM region""",
        "build_gold_municipios": _REGISTRY
        + """
            SELECT CAST(n_nationkey AS BIGINT) AS municipio_code, n_name AS municipio_nome, uf
            FROM nation LEFT JOIN (
              SELECT municipio_code, max(uf) AS uf FROM gold WHERE uf IS NOT NULL
              GROUP BY municipio_code) ON municipio_code = n_nationkey""",
    }
