"""Sources, sinks, stage cache."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrier.catalog.registry import query
from terrier.schemas import TRANSACTIONS_RAW
from terrier.sources import stages, tables

_NAMES = """region nation customer supplier part orders lineitem events documents embeddings pages
benchmark labels conversations""".split()

_CUSTOMERS = "select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer"


@query("load_tables", " union all ".join(f"select '{n}_df' as name, count(*) as n from {n}" for n in _NAMES))
def load_tables(t):
    loaded = tables.load_tables(t.spark, t.folder)
    counts = [
        df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
        for name, df in loaded.items()
        if name.removesuffix("_df") in _NAMES
    ]
    return tables.union_batches(*counts)


@query("load_csv_tables", _CUSTOMERS)
def load_csv_tables(t):
    folder, customer = t.scratch("csv"), t["customer"]
    tables.write_csv(customer, f"{folder}/customer.csv")
    return tables.load_csv_tables(t.spark, folder, {"customer": customer.schema})["customer_df"]


@query("csv_to_parquet", _CUSTOMERS)
def csv_to_parquet(t):
    folder, customer = t.scratch("convert"), t["customer"]
    tables.write_csv(customer, f"{folder}/customer.csv")
    return tables.csv_to_parquet(t.spark, folder, {"customer": customer.schema})["customer_df"]


_AWKWARD_SQL = {"adresse": """'RUE "' || id_transaction || '", 5' || chr(10) || 'BIS' as adresse"""}


@query(
    "ingest_chunks",
    f"select {', '.join(_AWKWARD_SQL.get(c, c) for c in TRANSACTIONS_RAW.names)} from raw",
    "raw",
)
def ingest_chunks(t):
    """Chunks whose addresses hold quotes, commas and line breaks, one with its columns in another order."""
    folder = t.scratch("chunks")
    raw = t.raw.select(*TRANSACTIONS_RAW.names).withColumn(
        "adresse", F.concat(F.lit('RUE "'), F.col("id_transaction"), F.lit('", 5\nBIS'))
    )
    for i, kind in enumerate(("Maison", "Appartement")):
        part = raw.filter(F.col("type_batiment") == kind)
        tables.write_csv(part.select(*raw.columns[:: -1 if i else 1]), f"{folder}/transactions_chunk_{i}.csv")
    return tables.ingest_chunks(t.spark, folder, f"{folder}/transactions.parquet")


@query(
    "read_batches",
    "select l_returnflag, count(*) as n, cast(sum(l_quantity) as bigint) as quantity from lineitem group by l_returnflag",
)
def read_batches(t):
    lines = tables.read_batches(t.spark, f"{t.folder}/lineitem.parquet")
    return lines.groupBy("l_returnflag").agg(
        F.count("*").alias("n"), F.sum(F.col("l_quantity").cast("bigint")).alias("quantity")
    )


@query(
    "read_csv_typed",
    """select o_orderkey as a, o_custkey as b, case when o_orderkey % 10 = 3 then null else o_orderpriority end as c
    from orders where o_orderkey % 10 <> 7""",
)
def read_csv_typed(t):
    path = t.scratch("typed")
    line = F.concat_ws(
        ",",
        F.col("o_orderkey").cast("string"),
        F.col("o_custkey").cast("string"),
        # NULL parts vanish from the line: a short line where the third field is left out.
        F.expr("if(o_orderkey % 10 = 3, null, o_orderpriority)"),
        F.expr("if(o_orderkey % 10 = 7, 'surplus', null)"),
    )
    t["orders"].select(line.alias("value")).write.text(path)
    schema = T.StructType.fromDDL("a bigint, b bigint, c string")
    return tables.read_csv_typed(t.spark, path, schema, header=False)


@query("write_parquet", "select o_orderkey, o_orderdate, o_totalprice from orders")
def write_parquet(t):
    path = t.scratch("orders")
    tables.write_parquet(t["orders"].select("o_orderkey", "o_orderdate", "o_totalprice"), path)
    return t.spark.read.parquet(path)


@query("write_csv", "select s_suppkey, s_name, s_acctbal from supplier union all select s_suppkey, s_name, s_acctbal from supplier")
def write_csv(t):
    path, rows = t.scratch("supplier"), t["supplier"].select("s_suppkey", "s_name", "s_acctbal")
    tables.write_csv(rows, path)
    tables.write_csv(rows, path, mode="append")
    return tables.read_csv_typed(t.spark, path, rows.schema)


@query("materialize", "select o_orderpriority, count(*) as n from orders group by o_orderpriority")
def materialize(t):
    path = t.scratch("stage")

    def build():
        return t["orders"].groupBy("o_orderpriority").agg(F.count("*").alias("n"))

    def never():
        raise AssertionError("a finished stage must be reused")

    stages.materialize(t.spark, path, build)
    return stages.materialize(t.spark, path, never, require_rows=True)


@query("expect_row_count", "select l_linestatus, count(*) as n from lineitem group by l_linestatus")
def expect_row_count(t):
    """Bounds that hold by one row on either side; the gate has to refuse those one row narrower."""
    lines = t["lineitem"].count()
    for low, high in ((lines, lines + 1), (lines - 1, lines)):
        try:
            stages.expect_row_count(t["lineitem"], low, high)
        except ValueError:
            continue
        raise AssertionError(f"{lines} rows passed the bounds {low} to {high}")
    checked = stages.expect_row_count(t["lineitem"], lines - 1, lines + 1)
    return checked.groupBy("l_linestatus").agg(F.count("*").alias("n"))


@query("row_count", "select 'lineitem' as name, count(*) as n from lineitem")
def row_count(t):
    return t["lineitem"].agg(F.count("*").alias("n")).select(F.lit("lineitem").alias("name"), "n")


@query(
    "union_batches",
    "select l_orderkey, l_linenumber from lineitem union all select o_orderkey, 0 from orders",
)
def union_batches(t):
    orders = t["orders"].select(F.lit(0).alias("l_linenumber"), F.col("o_orderkey").alias("l_orderkey"))
    return tables.union_batches(t["lineitem"].select("l_orderkey", "l_linenumber"), orders)


_PAIRS = "select concat('VILLE ', {k} // 3) as ville, concat('(', 1 + {k} % 99, ',', {k}, ')') as unique_city_id from {t}"


@query("union_distinct", _PAIRS.format(k="l_suppkey", t="lineitem") + " union " + _PAIRS.format(k="s_suppkey", t="supplier"))
def union_distinct(t):
    def pairs(df, key):
        return df.select(
            F.expr(f"concat('VILLE ', {key} div 3)").alias("ville"),
            F.expr(f"concat('(', 1 + {key} % 99, ',', {key}, ')')").alias("unique_city_id"),
        )

    return tables.union_distinct(pairs(t["lineitem"], "l_suppkey"), pairs(t["supplier"], "s_suppkey"))
