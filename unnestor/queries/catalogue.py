"""Query catalogue: one entry per operator group, each with a DuckDB oracle.

Every query reads the driver tables at ``sf_dir`` in full, derives documents
from them, and runs the engine; ``ORACLE`` holds the equivalent SQL over the
same tables. Column names are aliased identically on both sides, floats are
widened to double, timestamps are rendered as text.
"""

from __future__ import annotations

from functools import reduce
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.values import apply_null_policy, null_policy_exprs, sanitize_name, sanitize_name_col, strip_control
from ..layouts import catalog
from ..operators.checks import column_profile, reconcile, reconcile_content, row_counts, schema_drift, schema_matches
from ..operators.drift import path_drift
from ..operators.unnest import unnest_values
from ..operators.upsert import latest_per_key, split_bad_rows
from ..plans.catalog import Catalog
from ..plans.normalize import normalize, normalize_staged
from ..plans.pipeline import load_database, run_databases
from ..plans.staging import stage, stage_text, staging_path
from ..sinks.tables import REJECT_COLUMN, ParquetStore, load_table
from ..sinks.tables import REJECT_REASON as ROW_REASON
from ..sources.documents import REJECT, parse_documents, read_document_lines, read_envelope, scan_lines, unreadable_documents, unwrap_envelope
from ..sources.tables import PAGE_SIZE, group_positions
from .documents import (
    CONVERSATIONS, CUSTOMERS, EVENTS, LINE_ORDER, PARTS, QUIRKS, SHOP, SHOP_TYPED, TURN_ORDER,
    order_documents, table, with_field,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

TS = "yyyy-MM-dd HH:mm:ss"
TS_US = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def query(name: str, oracle: str | None):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle.strip()
        return fn
    return register


def _d(c: str) -> F.Column:
    return F.col(c).cast("double").alias(c)


def tables_of(docs: DataFrame, catalog, root: str, **kw) -> dict[str, DataFrame]:
    return dict(normalize(docs, catalog, root, **kw))


def staged_tables_of(docs: DataFrame, catalog, root: str) -> list[tuple[str, DataFrame]]:
    """Several tables of one tree: parse once, stage, fan out (as the load
    pipeline does)."""
    return normalize_staged(docs, catalog, root)


# -- SQL building blocks -----------------------------------------------------
_ORDER_SQL = ", ".join(LINE_ORDER)
_RANKED = f"""ranked AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {_ORDER_SQL}) - 1 AS rn
  FROM lineitem)"""
_PAGE = f"CAST(l_orderkey AS VARCHAR) || '-' || CAST(rn // {PAGE_SIZE} AS VARCHAR)"
_SLOT = f"CAST(rn % {PAGE_SIZE} AS VARCHAR)"
_F2D = "CAST(CAST({} AS FLOAT) AS DOUBLE)"
# documents (order, page) and their shapes
_DOCS = f"""docs AS (
  SELECT o.*, CAST(o.o_orderkey AS VARCHAR) || '-' || CAST(coalesce(p.page, 0) AS VARCHAR) AS doc_id
  FROM orders o LEFT JOIN (SELECT DISTINCT l_orderkey, rn // {PAGE_SIZE} AS page FROM ranked) p
    ON p.l_orderkey = o.o_orderkey)"""
_ARRAY_SHAPE = """NOT (o_orderpriority = '1-URGENT' OR o_orderpriority = '2-HIGH'
        OR (o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'F')
        OR (o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'O'))"""


# -- S3 P2 G2 P3 P7 P8 V4: flagship ------------------------------------------
@query("order_lines", f"""
WITH {_RANKED}
SELECT {_PAGE} || '_' || {_SLOT} AS nested_id,
       {_PAGE} AS order_id,
       CAST(l_partkey AS INTEGER) AS partkey,
       CAST(l_suppkey AS INTEGER) AS suppkey,
       l_linenumber AS linenumber,
       {_F2D.format('l_quantity')} AS quantity,
       {_F2D.format('l_extendedprice')} AS extendedprice,
       {_F2D.format('l_discount')} AS discount,
       {_F2D.format('l_tax')} AS tax,
       l_returnflag AS returnflag,
       l_linestatus AS linestatus,
       CAST(l_shipdate AS VARCHAR) AS shipdate
FROM ranked
""")
def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables_of(order_documents(spark, sf_dir), SHOP, "shop_order")["shop_order_lines"]
    return t.select(
        "nested_id", "order_id", "partkey", "suppkey", "linenumber",
        _d("quantity"), _d("extendedprice"), _d("discount"), _d("tax"),
        "returnflag", "linestatus", "shipdate",
    )


# -- S3 P1 P2 V2 V3: main table ----------------------------------------------
@query("order_main", f"""
WITH {_RANKED}, {_DOCS}
SELECT doc_id AS relationship_id,
       CAST(o_custkey AS INTEGER) AS custkey,
       o_orderstatus AS status,
       {_F2D.format('o_totalprice')} AS totalprice,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS orderdate,
       o_orderpriority AS priority,
       CAST(NULL AS VARCHAR) AS note
FROM docs
""")
def order_main(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables_of(order_documents(spark, sf_dir), SHOP, "shop_order")["shop_order"]
    return t.select(
        "relationship_id", "custkey", "status", _d("totalprice"),
        F.date_format("orderdate", TS).alias("orderdate"), "priority",
        F.col("fabric.note").alias("note"),
    )


# -- S1 S2: dump readers -----------------------------------------------------
_DELETED = "o_orderstatus = 'P' AND o_orderpriority = '5-LOW'"


def _order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelope rows ``{"id":..,"doc":{..}}`` per order; deleted orders carry
    ``"doc": null``."""
    o = table(spark, sf_dir, "orders")
    doc = F.struct(
        F.col("o_orderkey").cast("string").alias("_id"),
        F.col("o_custkey").alias("custkey"),
        F.col("o_orderstatus").alias("status"),
    )
    deleted = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW")
    doc_v = F.when(deleted, F.parse_json(F.lit("null"))).otherwise(F.parse_json(F.to_json(doc)))
    row = F.to_json(F.struct(F.col("o_orderkey").cast("string").alias("id"), doc_v.alias("doc")))
    return o.select("o_orderkey", row.alias("row"))


_SCAN_ORACLE = f"""
SELECT CAST(o_orderkey AS VARCHAR) AS id,
       CAST(o_orderkey AS VARCHAR) AS relationship_id,
       CAST(o_custkey AS INTEGER) AS custkey,
       o_orderstatus AS status
FROM orders WHERE NOT ({_DELETED})
"""


def _scan_result(pairs: DataFrame) -> DataFrame:
    parsed = parse_documents(pairs, SHOP["shop_order"], keep=["id"])
    return parsed.select("id", "relationship_id", "custkey", "status")


@query("order_scan_envelope", _SCAN_ORACLE)
def order_scan_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders packed into envelopes of at most PAGE_SIZE rows each (by global
    position), then read back with the envelope reader."""
    rows = group_positions(_order_rows(spark, sf_dir), [], ["o_orderkey"])
    env = rows.groupBy(F.expr(f"pos div {PAGE_SIZE}").alias("env")).agg(
        F.array_sort(F.collect_list(F.struct(F.col("pos").alias("_slot"), "row"))).alias("rows")
    )
    text = F.concat(
        F.lit('{"total_rows":'), F.size("rows").cast("string"), F.lit(',"offset":0,"rows":[\n'),
        F.array_join(F.transform("rows", lambda r: r["row"]), ",\n"), F.lit("\n]}"),
    )
    return _scan_result(unwrap_envelope(env.select(text.alias("value"))))


@query("envelope_file", _SCAN_ORACLE)
def envelope_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders as envelope files without line breaks, of at most about half
    a million rows, read back by splits."""
    rows = _order_rows(spark, sf_dir)
    n = 2 + rows.count() // 500_000
    lines = rows.select(
        F.pmod("o_orderkey", F.lit(n)).alias("part"), F.lit(1).alias("at"), F.col("o_orderkey").alias("key"), F.concat(F.lit(","), "row").alias("value"))
    frame = spark.range(n).select(F.col("id").alias("part"), F.explode(F.array(
        F.struct(F.lit(0).alias("at"), F.lit('{"total_rows":0,"rows":[{"id":"","doc":null}').alias("value")),
        F.struct(F.lit(2).alias("at"), F.lit("]}").alias("value")))).alias("f")).select("part", "f.at", F.lit(0).alias("key"), "f.value")
    path = staging_path(spark, "envelopes")
    (lines.unionByName(frame).repartition(n, "part").sortWithinPartitions("part", "at", "key").select("part", "value")
     .write.partitionBy("part").option("lineSep", " ").text(path))
    return _scan_result(read_envelope(spark, path))


@query("order_scan_lines", _SCAN_ORACLE)
def order_scan_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A line dump (one envelope row per line, trailing commas, the envelope's
    head and tail lines) written as text files, read back with the file
    reader."""
    rows = _order_rows(spark, sf_dir).select(F.concat("row", F.lit(",")).alias("value"))
    frame = spark.range(1).select(F.explode(F.array(
        F.lit('{"total_rows":0,"offset":0,"rows":['), F.lit("]}"))).alias("value"))
    path = stage_text(rows.unionByName(frame), "order_dump")
    return _scan_result(read_document_lines(spark, path))


@query("dump_rejects", """
SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'not a JSON object' WHEN '5-LOW' THEN 'doc is not an object'
         WHEN '2-HIGH' THEN 'document without a key' ELSE 'document' END AS kind,
       count(*) AS rows, count(*) FILTER (o_orderpriority = '3-MEDIUM') AS with_doc_field
FROM orders GROUP BY 1
""")
def dump_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A line dump of the orders with lines that are cut short, documents
    without a key, bare documents that have a field ``doc`` and rows whose
    ``doc`` isn't an object, written as text files and read back: every line
    is a document or rejected with its reason."""
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey").cast("string")
    whole = F.to_json(F.struct(key.alias("id"), F.struct(key.alias("_id"), F.col("o_orderstatus").alias("status")).alias("doc")))
    line = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.expr("left(whole, length(whole) - 2)"))
        .when(F.col("o_orderpriority") == "2-HIGH", F.to_json(F.struct(F.col("o_orderstatus").alias("status"))))
        .when(F.col("o_orderpriority") == "3-MEDIUM", F.to_json(F.struct(key.alias("_id"), F.lit("free text").alias("doc"))))
        .when(F.col("o_orderpriority") == "5-LOW", F.to_json(F.struct(key.alias("id"), F.lit("free text").alias("doc"))))
        .otherwise(F.col("whole"))
    )
    path = stage_text(o.withColumn("whole", whole).select(F.concat(line, F.lit(",")).alias("value")), "order_dump_rejects")
    found = scan_lines(spark.read.text(path))
    kind = F.coalesce(F.col(REJECT), F.when(F.col("id").isNull(), "document without a key").otherwise("document"))
    return found.groupBy(kind.alias("kind")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.coalesce(F.get_json_object("doc", "$.doc") == "free text", F.lit(False))).alias("with_doc_field"),
    )


# -- G1 P9 -------------------------------------------------------------------
@query("embedding_values", """
SELECT CAST(vec_id AS VARCHAR) || '_' || CAST(i - 1 AS VARCHAR) AS id,
       CAST(vec_id AS VARCHAR) AS vec_id,
       CAST(embedding[i] AS DOUBLE) AS value
FROM (SELECT vec_id, embedding, generate_subscripts(embedding, 1) AS i FROM embeddings)
""")
def embedding_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("string").alias("vec"), "embedding"
    )
    return unnest_values(emb, "vec", "embedding", "vec_id", "value", T.DoubleType())


# -- F1 F2 G1: null elements -------------------------------------------------
@query("null_element_rule", f"""
WITH {_RANKED}
SELECT 'primitive' AS kind, {_PAGE} || '_' || {_SLOT} AS key, {_PAGE} AS order_id,
       CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_linenumber END AS linenumber
FROM ranked
UNION ALL
SELECT 'records', {_PAGE} || '_' || {_SLOT}, {_PAGE}, l_linenumber
FROM ranked WHERE l_returnflag <> 'R'
""")
def null_element_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = order_documents(spark, sf_dir, numbers=True, null_when_returned=True)
    t = dict(staged_tables_of(docs, SHOP, "shop_order"))
    prim = t["shop_order_linenos"].select(
        F.lit("primitive").alias("kind"), F.col("id").alias("key"), "order_id", "linenumber"
    )
    recs = t["shop_order_lines"].select(
        F.lit("records").alias("kind"), F.col("nested_id").alias("key"), "order_id", "linenumber"
    )
    return prim.unionByName(recs)


# -- G3 P4 -------------------------------------------------------------------
@query("customer_contact", f"""
SELECT CAST(c_custkey AS VARCHAR) || '_contact' AS id,
       CAST(c_custkey AS VARCHAR) AS customer_id,
       CASE WHEN c_acctbal < 0 THEN NULL ELSE c_name END AS name,
       CASE WHEN c_acctbal < 0 THEN NULL ELSE c_nationkey END AS nationkey,
       CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END AS segment,
       CASE WHEN c_acctbal < 0 THEN NULL ELSE {_F2D.format('c_acctbal')} END AS acctbal
FROM customer
""")
def customer_contact(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    contact = F.when(
        F.col("c_acctbal") >= 0,
        F.struct(
            F.col("c_name").alias("name"), F.col("c_nationkey").alias("nationkey"),
            F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("acctbal"),
        ),
    )
    doc = F.struct(
        F.col("c_custkey").cast("string").alias("_id"), F.col("c_name").alias("name"),
        F.coalesce(F.parse_json(F.to_json(contact)), F.parse_json(F.lit("null"))).alias("contact"),
    )
    docs = c.select(F.to_json(doc).alias("doc"))
    t = tables_of(docs, CUSTOMERS, "customer")["customer_contact"]
    return t.select("id", "customer_id", "name", "nationkey", "segment", _d("acctbal"))


# -- G2 ----------------------------------------------------------------------
@query("conversation_turns", f"""
SELECT CAST(conv_id AS VARCHAR) || '-' || CAST(rn // {PAGE_SIZE} AS VARCHAR) || '_' || CAST(rn % {PAGE_SIZE} AS VARCHAR) AS nested_id,
       CAST(conv_id AS VARCHAR) || '-' || CAST(rn // {PAGE_SIZE} AS VARCHAR) AS conv_id,
       CAST(turn AS INTEGER) AS turn, role, text
FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS rn
      FROM conversations)
""")
def conversation_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..sources.tables import doc_id, pack_pages

    conv = table(spark, sf_dir, "conversations")

    def item(x):  # one packed turn -> its map in the document
        return F.create_map(
            F.lit("turn"), x["turn"].cast("string"), F.lit("role"), x["role"], F.lit("text"), x["text"],
        )

    pages = pack_pages(conv, ["conv_id"], TURN_ORDER, item)
    docs = pages.select(
        F.to_json(F.struct(doc_id("conv_id").alias("_id"), F.col("items").alias("turns"))).alias("doc")
    )
    return tables_of(docs, CONVERSATIONS, "conversation")["conversation_turns"]


# -- G4 F3-F6 P7 P10 V1 ------------------------------------------------------
_ITEMS_SQL = f"""WITH {_RANKED},
items AS (
  SELECT r.*, o.o_orderpriority, o.o_orderstatus,
         CASE l_linestatus WHEN 'O' THEN 'S' || CAST(l_suppkey AS VARCHAR)
                           ELSE CAST(l_suppkey AS VARCHAR) END AS pid
  FROM ranked r JOIN orders o ON o.o_orderkey = r.l_orderkey
  WHERE l_returnflag = 'N' AND NOT (l_linestatus = 'F' AND l_suppkey = 0) AND {_ARRAY_SHAPE})"""


@query("path_items", f"""
{_ITEMS_SQL}
SELECT 'shop_order_fabric_items_' || pid || '_' || {_PAGE} || '_' || {_SLOT} AS nested_id,
       'footprint_' || {_PAGE} || '_' || {_SLOT} AS id,
       pid AS parent_id,
       CAST(l_quantity AS VARCHAR) AS qty,
       CASE WHEN l_linestatus = 'O' THEN l_returnflag ELSE '' END AS flag,
       '{{"w":' || CAST(l_linenumber AS VARCHAR) || '}}' AS dims,
       CAST(l_linenumber AS VARCHAR) AS w,
       '' AS note
FROM items
""")
def path_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = order_documents(spark, sf_dir, lines=False, fabric=True)
    return tables_of(docs, SHOP, "shop_order")["shop_order_fabric_items"]


_QUIRK_ID = "CAST(o_custkey AS VARCHAR) || '_' || CAST(o_orderkey AS VARCHAR)"


@query("path_rejects", f"""
SELECT CAST(o_orderkey AS VARCHAR) || '_d' AS document_id,
       CASE o_orderpriority WHEN '1-URGENT' THEN NULL ELSE 'quirk_items_' || replace({_QUIRK_ID}, '_', '%5F') || '_'
         || CAST(o_orderkey AS VARCHAR) || '%5Fd_1' END AS nested_id,
       CASE o_orderpriority WHEN '1-URGENT' THEN NULL ELSE {_QUIRK_ID} END AS parent_id,
       CASE o_orderpriority WHEN '1-URGENT' THEN NULL WHEN '2-HIGH' THEN '17.0' ELSE '1000' END AS price,
       CASE o_orderpriority WHEN '1-URGENT' THEN NULL WHEN '4-NOT SPECIFIED' THEN '{{"ID":"x"}}' ELSE o_orderstatus END AS note,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'not a JSON object' END AS reason
FROM orders WHERE o_orderpriority <> '3-MEDIUM'
""")
def path_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Path items of documents with a repeated key, a number with a fraction of
    zero, texts that look like objects, items that are a text (no rows), ids
    that hold the sign between the parts of a key, and documents that are cut
    short (rejected with their reason)."""
    o = table(spark, sf_dir, "orders")
    key = F.concat(F.col("o_orderkey").cast("string"), F.lit("_d"))
    ident = F.concat(F.col("o_custkey").cast("string"), F.lit("_"), F.col("o_orderkey").cast("string"))
    pr = F.col("o_orderpriority")
    looks = F.to_json(F.struct(F.lit("x").alias("ID")))
    item = F.concat(
        F.lit('{"ID":"'), ident, F.lit('","price":3,"note":'), F.when(pr == "4-NOT SPECIFIED", F.lit('"{\\"ID\\":\\"x\\"}"'))
        .otherwise(F.concat(F.lit('"'), F.col("o_orderstatus"), F.lit('"'))),
        F.lit(',"price" : '), F.when(pr == "2-HIGH", "17.0").otherwise("1000"), F.lit("}"))
    first = F.when(pr == "4-NOT SPECIFIED", F.concat(F.lit('"'), F.replace(looks, F.lit('"'), F.lit('\\"')), F.lit('"'))).otherwise("null")
    items = F.when(pr == "3-MEDIUM", F.lit('"[{\\"ID\\":1}]"')).otherwise(F.concat(F.lit("["), first, F.lit(","), item, F.lit("]")))
    doc = F.concat(F.lit('{"_id":"'), key, F.lit('","f":{"items":'), items, F.when(pr == "1-URGENT", "").otherwise("}}"))
    docs = o.select(doc.alias("doc"))
    found = tables_of(docs, QUIRKS, "quirk", mode="permissive", with_document_id=True)["quirk_items"]
    lost = unreadable_documents(docs).select(
        F.regexp_extract("doc", '"_id":"([^"]*)"', 1).alias("document_id"),
        *[F.lit(None).cast("string").alias(c) for c in ("nested_id", "parent_id", "price", "note")], F.col(REJECT).alias("reason"))
    return found.select(
        "document_id", "nested_id", "parent_id", "price", "note", F.lit(None).cast("string").alias("reason")).unionByName(lost)


# -- G6 R1 A1 ----------------------------------------------------------------
@query("tree_row_counts", f"""
{_ITEMS_SQL}, {_DOCS}
SELECT 'shop_order' AS table_name, count(*) AS rows FROM docs
UNION ALL SELECT 'shop_order_fabric', count(*) FROM docs
UNION ALL SELECT 'shop_order_fabric_items', count(*) FROM items
UNION ALL SELECT 'shop_order_lines', count(*) FROM lineitem
UNION ALL SELECT 'shop_order_linenos', count(*) FROM lineitem
""")
def tree_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = order_documents(spark, sf_dir, numbers=True, fabric=True)
    return row_counts(staged_tables_of(docs, SHOP, "shop_order"))


# -- V2 ----------------------------------------------------------------------
@query("float_coercion", f"""
SELECT CAST(p_partkey AS VARCHAR) AS relationship_id,
       {_F2D.format('p_size')} AS size,
       {_F2D.format('p_retailprice')} AS retail,
       {_F2D.format('p_retailprice')} AS retail_num
FROM part
""")
def float_coercion(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    doc = F.struct(
        F.col("p_partkey").cast("string").alias("_id"),
        F.col("p_size").alias("size"),                       # JSON integer
        F.col("p_retailprice").cast("string").alias("retail"),  # numeric text
        F.col("p_retailprice").alias("retail_num"),          # JSON number
    )
    t = tables_of(p.select(F.to_json(doc).alias("doc")), PARTS, "part")["part"]
    return t.select("relationship_id", _d("size"), _d("retail"), _d("retail_num"))


# -- V3 (permissive) ---------------------------------------------------------
@query("timestamp_parse", """
SELECT CAST(event_id AS VARCHAR) AS relationship_id,
       CASE WHEN event_type = 'error' THEN NULL ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END AS ts,
       event_type = 'error' AS rejected
FROM events
""")
def timestamp_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    ts = F.when(F.col("event_type") == "error", F.concat(F.lit("bad-"), F.col("event_id").cast("string"))) \
        .otherwise(F.col("ts").cast("string"))
    doc = F.struct(F.col("event_id").cast("string").alias("_id"), ts.alias("ts"))
    parsed = parse_documents(e.select(F.to_json(doc).alias("doc")), EVENTS["event"], "permissive")
    return parsed.select(
        "relationship_id", F.date_format("ts", TS_US).alias("ts"), F.col(REJECT).isNotNull().alias("rejected")
    )


# -- P3 V4 -------------------------------------------------------------------
@query("typed_map_cast", f"""
WITH {_RANKED}
SELECT {_PAGE} || '_' || {_SLOT} AS nested_id,
       {_PAGE} AS order_id,
       l_linenumber AS linenumber,
       CAST(l_partkey AS INTEGER) AS partkey,
       CAST(NULL AS INTEGER) AS returnflag,
       CAST(NULL AS INTEGER) AS warehouse
FROM ranked
""")
def typed_map_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables_of(order_documents(spark, sf_dir), SHOP_TYPED, "shop_order")["shop_order_lines_typed"]


# -- V7 V9 -------------------------------------------------------------------
@query("json_encode", """
SELECT CAST(event_id AS VARCHAR) AS relationship_id,
       CASE WHEN event_type = 'view' THEN '{}'
            ELSE '{"k":"' || json_extract_string(props, '$.k') || '"}' END AS props,
       CASE WHEN event_type = 'click' THEN '[]'
            ELSE '[{"type":"' || event_type || '"}]' END AS tags
FROM events
""")
def json_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    doc = F.struct(
        F.col("event_id").cast("string").alias("_id"),
        F.when(F.col("event_type") != "view", F.parse_json("props")).alias("props"),
        F.when(F.col("event_type") != "click",
               F.array(F.struct(F.col("event_type").alias("type")))).alias("tags"),
    )
    main = tables_of(e.select(F.to_json(doc).alias("doc")), EVENTS, "event")["event"]
    return apply_null_policy(main.select("relationship_id", "props", "tags"))


# -- V9 ----------------------------------------------------------------------
@query("null_policy", """
SELECT 'c' || CAST(c_custkey AS VARCHAR) AS id,
       CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_name END AS name,
       coalesce(CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL ELSE c_acctbal > 0 END, false) AS active,
       coalesce(CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN NULL ELSE c_custkey END, 0) AS custkey,
       CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN NULL ELSE c_nationkey END AS nationkey
FROM customer
""")
def null_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    seg = F.col("c_mktsegment")
    df = c.select(
        F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("id"),
        F.when(seg == "BUILDING", F.lit("")).otherwise(F.col("c_name")).alias("name"),
        F.when(seg != "MACHINERY", F.col("c_acctbal") > 0).alias("active"),
        F.when(seg != "AUTOMOBILE", F.col("c_custkey")).alias("custkey"),
        F.when(seg != "HOUSEHOLD", F.col("c_nationkey")).alias("nationkey"),
    )
    return apply_null_policy(df)


# -- V6 ----------------------------------------------------------------------
@query("strip_control", """
SELECT doc_id, replace(replace(text, chr(11), ''), chr(0), '') AS text FROM documents
""")
def strip_control_chars(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    dirty = F.regexp_replace(F.regexp_replace("text", r"\.", ".\u000b"), ",", "\u0000,")
    return d.select("doc_id", strip_control(dirty).alias("text"))


# -- V8 ----------------------------------------------------------------------
@query("sanitize_names", """
SELECT DISTINCT o_orderpriority AS source_name, lower(replace(o_orderpriority, '-', '_')) AS table_name
FROM orders
UNION
SELECT DISTINCT p_type, lower(replace(p_type, '-', '_')) FROM part
""")
def sanitize_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("source_name"))
    p = table(spark, sf_dir, "part").select(F.col("p_type").alias("source_name"))
    names = o.unionByName(p).distinct()
    return names.select("source_name", sanitize_name_col("source_name").alias("table_name"))


# -- K4 ----------------------------------------------------------------------
_DEDUPE_ORDER = [c for c in LINE_ORDER if c != "l_linenumber"]


@query("upsert_dedupe", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
       l_discount, l_tax, l_returnflag, l_linestatus, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                   ORDER BY l_shipdate DESC, {', '.join(c + ' DESC' for c in _DEDUPE_ORDER if c != 'l_shipdate')}) AS rn
      FROM lineitem)
WHERE rn = 1
""")
def upsert_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    order = ["l_shipdate"] + [c for c in _DEDUPE_ORDER if c != "l_shipdate"]
    out = latest_per_key(li, ["l_orderkey", "l_linenumber"], order)
    return out.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus",
        F.date_format("l_shipdate", TS).alias("l_shipdate"),
    )


@query("upsert_merge", """
SELECT o_orderkey, o_orderstatus, o_orderpriority, o_totalprice FROM orders WHERE o_orderstatus = 'F'
UNION ALL
SELECT o_orderkey, o_orderstatus, o_orderpriority || '*', o_totalprice + 1 FROM orders
WHERE o_orderstatus IN ('O', 'P')
""")
def upsert_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored table: orders F and P. Arriving: orders O and P, each in two
    versions; the later version wins, O orders are inserts."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    target = o.where(F.col("o_orderstatus").isin("F", "P"))
    arriving = o.where(F.col("o_orderstatus").isin("O", "P"))
    v1 = arriving.select("o_orderkey", "o_orderstatus", F.lit("stale").alias("o_orderpriority"),
                         "o_totalprice", F.lit(1).alias("version"))
    v2 = arriving.select("o_orderkey", "o_orderstatus",
                         F.concat("o_orderpriority", F.lit("*")).alias("o_orderpriority"),
                         (F.col("o_totalprice") + 1).alias("o_totalprice"), F.lit(2).alias("version"))
    store = ParquetStore(staging_path(spark, "orders"), buckets=16)
    load_table(target, store, "orders", "o_orderkey", dedupe=False)
    load_table(latest_per_key(v1.unionByName(v2), "o_orderkey", "version").drop("version"), store, "orders", "o_orderkey",
               mode="upsert", dedupe=False)
    return store.read(spark, "orders")


def _tree_sql(name: str, lines: str, orders: str) -> str:
    """Rows of the order tree, with the document they are of, made of some orders and lines."""
    return f"""{name}_r AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {_ORDER_SQL}) - 1 AS rn FROM lineitem WHERE {lines}),
{name}_d AS (
  SELECT o.*, CAST(o.o_orderkey AS VARCHAR) || '-' || CAST(coalesce(p.page, 0) AS VARCHAR) AS doc
  FROM orders o LEFT JOIN (SELECT DISTINCT l_orderkey, rn // {PAGE_SIZE} AS page FROM {name}_r) p ON p.l_orderkey = o.o_orderkey
  WHERE {orders}),
{name}_l AS (
  SELECT r.*, o_orderpriority, o_orderstatus, {_PAGE} AS doc, {_SLOT} AS slot,
         CASE l_linestatus WHEN 'O' THEN 'S' || CAST(l_suppkey AS VARCHAR) ELSE CAST(l_suppkey AS VARCHAR) END AS pid
  FROM {name}_r r JOIN orders ON o_orderkey = l_orderkey WHERE {orders}),
{name} AS (
  SELECT doc, 'shop_order' AS table_name, doc AS key, o_orderpriority AS value FROM {name}_d
  UNION ALL SELECT doc, 'shop_order_fabric', doc || '_fabric', doc FROM {name}_d
  UNION ALL SELECT doc, 'shop_order_lines', doc || '_' || slot, CAST(l_partkey AS VARCHAR) FROM {name}_l
  UNION ALL SELECT doc, 'shop_order_linenos', doc || '_' || slot, CAST(l_linenumber AS VARCHAR) FROM {name}_l
  UNION ALL SELECT doc, 'shop_order_fabric_items', 'shop_order_fabric_items_' || pid || '_' || doc || '_' || slot, pid FROM {name}_l
    WHERE l_returnflag = 'N' AND NOT (l_linestatus = 'F' AND l_suppkey = 0) AND {_ARRAY_SHAPE})"""


# -- K4 G6: a tree ------------------------------------------------------------
@query("upsert_tree", f"""
WITH {_tree_sql('stored', 'true', 'true')},
{_tree_sql('arriving', "l_returnflag = 'N'", "o_orderstatus <> 'F'")}
SELECT table_name, key, value FROM stored WHERE doc NOT IN (SELECT doc FROM arriving_d)
UNION ALL SELECT table_name, key, value FROM arriving
""")
def upsert_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order tree is loaded into buckets; then the orders that aren't
    finished arrive again with some lines less. Nothing of their first version
    remains, in any of the five tables, and all else stays."""
    store = ParquetStore(staging_path(spark, "tree"), buckets=8)
    load_database(order_documents(spark, sf_dir, numbers=True, fabric=True), SHOP, "shop_order", store)
    later = order_documents(spark, sf_dir, numbers=True, fabric=True, of_orders=F.col("o_orderstatus") != "F",
                            with_lines=F.col("l_returnflag") == "N")
    load_database(later, SHOP, "shop_order", store, load_mode="upsert")
    shown = {"shop_order": ("relationship_id", "priority"), "shop_order_fabric": ("id", "order_id"), "shop_order_lines": ("nested_id", "partkey"),
             "shop_order_linenos": ("id", "linenumber"), "shop_order_fabric_items": ("nested_id", "parent_id")}
    parts = [store.read(spark, n).select(F.lit(n).alias("table_name"), F.col(k).alias("key"), F.col(v).cast("string").alias("value"))
             for n, (k, v) in shown.items()]
    return reduce(DataFrame.unionByName, parts)


# -- R1: versions of a document -------------------------------------------------
def _customer_documents(spark: SparkSession, sf_dir: str, version: int) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    name = F.concat("c_name", F.lit(f" v{version}"))
    return c.select("c_mktsegment", F.to_json(F.struct(
        F.col("c_custkey").cast("string").alias("_id"), name.alias("name"), F.lit(version).alias("version"),
        F.struct(name.alias("name"), F.col("c_nationkey").alias("nationkey")).alias("contact"))).alias("doc"))


@query("load_versions", """
SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name || ' v' || v AS name, CAST(v AS INTEGER) AS version,
       c_name || ' v' || v AS contact_name, c_nationkey AS nationkey
FROM (SELECT *, CASE c_mktsegment WHEN 'BUILDING' THEN 3 WHEN 'MACHINERY' THEN 2 ELSE 1 END AS v FROM customer)
""")
def load_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dump with up to three versions of a document: the latest supplies the
    main row and the child row."""
    seg = F.col("c_mktsegment")
    docs = _customer_documents(spark, sf_dir, 1).unionByName(
        _customer_documents(spark, sf_dir, 2).where(seg.isin("BUILDING", "MACHINERY"))).unionByName(
        _customer_documents(spark, sf_dir, 3).where(seg == "BUILDING"))
    store = ParquetStore(staging_path(spark, "versions"))
    load_database(docs.select("doc"), CUSTOMERS, "customer", store, order_by="version")
    main = store.read(spark, "customer").select(F.col("relationship_id").alias("customer_id"), "name", "version")
    child = store.read(spark, "customer_contact").select("customer_id", F.col("name").alias("contact_name"), "nationkey")
    return main.join(child.hint("merge"), "customer_id", "full_outer")


# -- R1 R2: databases at the same time --------------------------------------------
@query("run_all", """
SELECT 'customers' AS database, 'ok' AS status, 'customer' AS table_name, count(*) AS loaded FROM customer
UNION ALL SELECT 'customers', 'ok', 'customer_contact', count(*) FROM customer
UNION ALL SELECT 'events', 'ok', 'event', count(*) FROM events
UNION ALL SELECT 'cut_short', 'failed', NULL, NULL
""")
def run_all_databases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three dumps loaded at the same time, one of which can't be read: one
    report a database, and the others are loaded."""
    e = table(spark, sf_dir, "events")
    events = F.to_json(F.struct(F.col("event_id").cast("string").alias("_id"), F.col("ts").cast("string").alias("ts"), F.col("event_type").alias("kind")))
    customers = _customer_documents(spark, sf_dir, 1).select(F.col("doc").alias("value"))
    dumps = {
        "customers": stage_text(customers, "customers"), "events": stage_text(e.select(events.alias("value")), "events"),
        "cut_short": stage_text(customers.select(F.expr("left(value, length(value) - 1)").alias("value")), "cut"),
    }
    catalog = Catalog({**CUSTOMERS.tables, **EVENTS.tables})
    store = ParquetStore(staging_path(spark, "databases"))
    runs = run_databases(spark, dumps, catalog, store, {"customers": "customer", "events": "event", "cut_short": "customer"},
                         parallel=3, on_error="report", dedupe=False)
    found = [(db, r.status, t.table if t else None, t.loaded if t else None) for db, r in zip(dumps, runs) for t in r.tables or [None]]
    return spark.createDataFrame(found, "database string, status string, table_name string, loaded long")


# -- A3: content --------------------------------------------------------------
@query("reconcile_content", """
SELECT 'as loaded' AS table_name, count(*) AS expected, count(*) AS loaded, 'ok' AS status FROM part
UNION ALL SELECT 'a value changed', count(*), count(*), 'changed' FROM part
UNION ALL SELECT 'a row lost', count(*), count(*) - 1, 'mismatch' FROM part
UNION ALL SELECT 'report', count(*), count(*), 'ok ok' FROM part
""")
def reconcile_content_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table loaded with its content verified, and compared with what it was
    made of: as it is, with one price changed, and with one row lost."""
    p = table(spark, sf_dir, "part").withColumn("key", F.col("p_partkey").cast("string"))
    store = ParquetStore(staging_path(spark, "parts"))
    r = load_table(p, store, "part", "key", dedupe=False, verify="content")
    stored, one = store.read(spark, "part"), F.col("p_partkey") == p.agg(F.min("p_partkey")).first()[0]
    expected = p.select(*null_policy_exprs(p.schema))
    report = spark.createDataFrame([("report", r.written, r.loaded, f"{r.status} {r.content}")], "table_name string, expected long, loaded long, status string")
    return reconcile_content([
        ("as loaded", expected, stored),
        ("a value changed", expected, stored.withColumn("p_retailprice", F.when(one, F.col("p_retailprice") + 1).otherwise(F.col("p_retailprice")))),
        ("a row lost", expected, stored.where(~one)),
    ]).unionByName(report)


# -- K6: rejected rows ----------------------------------------------------------
@query("load_rejects", """
SELECT c_mktsegment AS segment, count(*) AS rows, CASE c_mktsegment WHEN 'BUILDING' THEN 'key' WHEN 'MACHINERY' THEN 'key' END AS reject_column,
       CASE c_mktsegment WHEN 'BUILDING' THEN 'blank key' WHEN 'MACHINERY' THEN 'null key' END AS reject_reason
FROM customer GROUP BY 1
""")
def load_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good and rejected rows, written to the store and to the quarantine by one pass."""
    c = table(spark, sf_dir, "customer")
    seg = F.col("c_mktsegment")
    key = F.when(seg == "BUILDING", F.lit("\x0b")).when(seg != "MACHINERY", F.col("c_custkey").cast("string"))
    store, aside = (ParquetStore(staging_path(spark, n)) for n in ("good", "rejected"))
    load_table(c.select(key.alias("key"), seg.alias("segment"), "c_name"), store, "customers", "key", dedupe=False, quarantine=aside)
    none = F.lit(None).cast("string")
    good = store.read(spark, "customers").select("segment", none.alias("reject_column"), none.alias("reject_reason"))
    bad = aside.read(spark, "customers__rejected").select(
        "segment", F.col(REJECT_COLUMN).alias("reject_column"), F.col(ROW_REASON).alias("reject_reason"))
    return good.unionByName(bad).groupBy("segment", "reject_column", "reject_reason").agg(F.count(F.lit(1)).alias("rows"))


# -- K6 Q16 ------------------------------------------------------------------
@query("bad_rows", """
SELECT c_mktsegment AS segment,
       CASE WHEN c_mktsegment IN ('HOUSEHOLD', 'MACHINERY', 'FURNITURE') THEN 'rejected' ELSE 'kept' END AS status,
       count(*) AS rows
FROM customer GROUP BY 1, 2
""")
def bad_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of blanks are kept; empty ones, ones of control characters alone and nulls are rejected."""
    c = table(spark, sf_dir, "customer")
    seg = F.col("c_mktsegment")
    key = F.when(seg == "BUILDING", F.lit("  ")).when(seg == "MACHINERY", F.lit(None)).when(seg == "HOUSEHOLD", F.lit("")) \
        .when(seg == "FURNITURE", F.lit("\x00\x0b")).otherwise(F.col("c_custkey").cast("string"))
    df = c.select(key.alias("key"), seg.alias("segment"))
    good, bad = split_bad_rows(df, "key")
    both = good.select("segment", F.lit("kept").alias("status")).unionByName(
        bad.select("segment", F.lit("rejected").alias("status")))
    return both.groupBy("segment", "status").agg(F.count(F.lit(1)).alias("rows"))


# -- A3 ----------------------------------------------------------------------
@query("reconcile", f"""
WITH {_RANKED}, {_DOCS}
SELECT 'shop_order' AS table_name, count(*) AS expected, count(*) AS loaded, 'ok' AS status FROM docs
UNION ALL SELECT 'shop_order_lines', count(*), count(*), 'ok' FROM lineitem
UNION ALL SELECT 'shop_order_linenos', count(*), count(*), 'ok' FROM lineitem
""")
def reconcile_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows expected from the raw documents (independent JSON functions) vs
    rows produced by normalisation, per table."""
    docs = stage(order_documents(spark, sf_dir, numbers=True), "order_docs")
    t = dict(staged_tables_of(docs, SHOP, "shop_order"))
    size = lambda k: F.coalesce(F.json_array_length(F.get_json_object("doc", f"$.{k}")), F.lit(0))
    exp = docs.agg(
        F.count(F.lit(1)).alias("shop_order"),
        F.sum(size("orderLines")).alias("shop_order_lines"),
        F.sum(size("lineNumbers")).alias("shop_order_linenos"),
    )
    expected = exp.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("table_name"), F.col(n).cast("long").alias("rows"))
        for n in ("shop_order", "shop_order_lines", "shop_order_linenos")
    ])))
    loaded = row_counts([(n, t[n]) for n in ("shop_order", "shop_order_lines", "shop_order_linenos")])
    return reconcile(expected, loaded)


# -- R1 K1 K6 A3: the load itself --------------------------------------------
@query("load_tables", f"""
{_ITEMS_SQL}, {_DOCS}
SELECT 'shop_order' AS table_name, count(*) AS written, count(*) AS loaded, CAST(0 AS BIGINT) AS rejected, 'ok' AS status FROM docs
UNION ALL SELECT 'shop_order_fabric', count(*), count(*), 0, 'ok' FROM docs
UNION ALL SELECT 'shop_order_fabric_items', count(*), count(*), 0, 'ok' FROM items
UNION ALL SELECT 'shop_order_lines', count(*), count(*), 0, 'ok' FROM lineitem
UNION ALL SELECT 'shop_order_linenos', count(*), count(*), 0, 'ok' FROM lineitem
""")
def load_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R1 end to end: order documents parsed once, staged, and every table of
    the tree written to a Parquet store in the checkpoint folder (null policy,
    key checks, dedupe by key, observed and read-back counts); the result is
    the load report, one row per table."""
    docs = order_documents(spark, sf_dir, numbers=True, fabric=True)
    store = ParquetStore(staging_path(spark, "store"))
    run = load_database(docs, SHOP, "shop_order", store)
    return spark.createDataFrame(
        [(r.table, r.written, r.loaded, r.rejected, r.status) for r in run.tables],
        "table_name string, written long, loaded long, rejected long, status string",
    )


# -- A2 ----------------------------------------------------------------------
@query("column_profile", """
SELECT 'nested_id' AS column_name, count(*) AS non_null, count(*) AS total FROM lineitem
UNION ALL SELECT 'order_id', count(*), count(*) FROM lineitem
UNION ALL SELECT 'linenumber', count(*), count(*) FROM lineitem
UNION ALL SELECT 'partkey', count(*), count(*) FROM lineitem
UNION ALL SELECT 'returnflag', 0, count(*) FROM lineitem
UNION ALL SELECT 'warehouse', 0, count(*) FROM lineitem
""")
def column_profile_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables_of(order_documents(spark, sf_dir), SHOP_TYPED, "shop_order")["shop_order_lines_typed"]
    return column_profile(t)


# -- C5 ----------------------------------------------------------------------
@query("schema_drift", """
SELECT '_id' AS key, count(*) AS documents, 'ok' AS status FROM events
UNION ALL SELECT 'ts', count(*), 'ok' FROM events
UNION ALL SELECT 'kind', count(*) FILTER (WHERE event_type <> 'signup'), 'ok' FROM events
UNION ALL SELECT 'props', 0, 'missing' FROM (SELECT 1)
UNION ALL SELECT 'tags', 0, 'missing' FROM (SELECT 1)
UNION ALL SELECT 'value', count(*), 'extra' FROM events
UNION ALL SELECT 'user', count(*) FILTER (WHERE event_type = 'purchase'), 'extra' FROM events
""")
def schema_drift_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    doc = F.struct(
        F.col("event_id").cast("string").alias("_id"),
        F.col("ts").cast("string").alias("ts"),
        F.when(F.col("event_type") != "signup", F.col("event_type")).alias("kind"),
        F.col("value").alias("value"),
        F.when(F.col("event_type") == "purchase", F.col("user_id")).alias("user"),
    )
    return schema_drift(e.select(F.to_json(doc).alias("doc")), EVENTS["event"])


@query("path_drift", """
WITH e AS (SELECT * FROM events)
SELECT '_id' AS path, 'STRING' AS kind, count(*) AS documents, 'string' AS declared, 'ok' AS status FROM e
UNION ALL SELECT 'ts', 'STRING', count(*) FILTER (event_type <> 'error'), 'timestamp', 'ok' FROM e
UNION ALL SELECT 'ts', 'BIGINT', count(*) FILTER (event_type = 'error'), 'timestamp', 'type' FROM e
UNION ALL SELECT 'kind', 'STRING', count(*), 'string', 'ok' FROM e
UNION ALL SELECT 'props', 'OBJECT', count(*), 'map<string,string>', 'ok' FROM e
UNION ALL SELECT 'props.user', 'BIGINT', count(*), NULL, 'ok' FROM e
UNION ALL SELECT 'tags', NULL, 0, 'array<map<string,string>>', 'missing'
UNION ALL SELECT 'more', 'OBJECT', count(*) FILTER (event_type = 'purchase'), NULL, 'extra' FROM e
UNION ALL SELECT 'more.list', 'ARRAY', count(*) FILTER (event_type = 'purchase'), NULL, 'extra' FROM e
UNION ALL SELECT 'more.list[]', 'OBJECT', count(*) FILTER (event_type = 'purchase'), NULL, 'extra' FROM e
UNION ALL SELECT 'more.list[].`a.b`', 'BOOLEAN', count(*) FILTER (event_type = 'purchase'), NULL, 'extra' FROM e
""")
def path_drift_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with a time that is sometimes a number, a map, and an object that no layout names."""
    e = table(spark, sf_dir, "events")
    key, error = F.col("event_id").cast("string"), F.col("event_type") == "error"
    doc = F.to_json(F.struct(key.alias("_id"), F.col("event_type").alias("kind"), F.struct(F.col("user_id").alias("user")).alias("props")))
    time = F.when(error, F.lit("17")).otherwise(F.concat(F.lit('"'), F.col("ts").cast("string"), F.lit('"')))
    more = F.when(F.col("event_type") == "purchase", F.lit('{"list":[{"a.b":true},{"a.b":false}]}'))
    return path_drift(e.select(with_field(with_field(doc, "ts", time), "more", more).alias("doc")), EVENTS, "event")


# -- R3 C2: layouts of the bound databases -----------------------------------------
_ID = "CAST(c_custkey AS VARCHAR)"


@query("company_tree", f"""
SELECT 'channel1_company' AS table_name, {_ID} AS key, {_ID} AS parent, c_name || '|' || CAST(c_nationkey AS VARCHAR) || '|' || CASE WHEN c_acctbal < 0 THEN 'true' ELSE 'false' END AS value FROM customer
UNION ALL SELECT 'channel1_company_categories', {_ID} || '_0', {_ID}, CAST(c_nationkey AS VARCHAR) FROM customer
UNION ALL SELECT 'channel1_company_categories', {_ID} || '_1', {_ID}, CAST(c_nationkey + 1 AS VARCHAR) FROM customer
UNION ALL SELECT 'channel1_company_productGroups', {_ID} || '_0', {_ID}, NULL FROM customer
UNION ALL SELECT 'channel1_company_sustainability', {_ID} || '_1', {_ID}, c_mktsegment || '|3|true' FROM customer
UNION ALL SELECT 'channel1_company_officeAddresses', {_ID} || '_0', {_ID}, 'Main St|12' FROM customer WHERE c_acctbal >= 0
UNION ALL SELECT 'channel1_company_factoryAddresses', {_ID} || '_0', {_ID}, 'Mill Rd|' FROM customer
UNION ALL SELECT 'channel1_company_profilePics', {_ID} || '_0', {_ID}, 'a.png|7' FROM customer WHERE c_mktsegment = 'BUILDING'
UNION ALL SELECT 'channel1_company_topBrands', {_ID} || '_0', {_ID}, c_name FROM customer
UNION ALL SELECT 'channel1_company_admin', {_ID} || '_admin', {_ID}, c_name FROM customer
UNION ALL SELECT 'channel1_company_contact', {_ID} || '_contact', {_ID}, CASE WHEN c_acctbal >= 0 THEN c_mktsegment END FROM customer
UNION ALL SELECT 'channel1_user', {_ID}, {_ID}, c_name || '|' || '{{"segment":"' || c_mktsegment || '"}}' FROM customer
UNION ALL SELECT 'channel1_user_topbrands', {_ID} || '_0', {_ID}, c_name FROM customer
UNION ALL SELECT 'channel1_orderline_steps', {_ID}, {_ID}, c_name FROM customer
UNION ALL SELECT 'channel1_orderline_steps_evidencephotos', {_ID} || '_0', {_ID}, '|1.5' FROM customer
""")
def company_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Company documents with all eleven kinds of children, users and order
    line steps, made of the customers: rows of all their tables."""
    c = table(spark, sf_dir, "customer")
    text, none = (lambda name: F.col(name).cast("string")), F.lit(None).cast("string")
    f = lambda **fields: F.struct(*[v.alias(k) for k, v in fields.items()])
    s, seg, named = F.lit, F.col("c_mktsegment"), F.array(F.struct(F.col("c_name").alias("brandName")))
    company = F.to_json(f(
        _id=text("c_custkey"), name=F.col("c_name"), companyType=F.col("c_nationkey"), isBlocked=F.col("c_acctbal") < 0,
        categories=F.array("c_nationkey", F.col("c_nationkey") + 1), productGroups=F.array(F.lit(None).cast("int")), companySubtypes=F.array().cast("array<int>"),
        sustainability=F.array(F.lit(None).cast("struct<title:string,type:string,Doc:string,other:string>"),
                               f(title=seg, type=s("3"), Doc=s("true"), other=s("x"))),
        officeAddresses=F.when(F.col("c_acctbal") >= 0, F.array(f(line1=s("Main St"), employees=s("12")))),
        factoryAddresses=F.array(f(line1=s("Mill Rd"), employees=s("a dozen"))),
        profilePics=F.when(seg == "BUILDING", F.array(f(fileName=s("a.png"), sequence=s("7")))),
        topBrands=named, admin=f(firstName=F.col("c_name")), contact=F.when(F.col("c_acctbal") >= 0, f(city=seg))))
    user = F.to_json(f(_id=text("c_custkey"), firstName=F.col("c_name"), company=f(segment=seg), topBrands=named))
    steps = F.to_json(f(_id=text("c_custkey"), displayName=F.col("c_name"), evidencePhotos=F.array(f(geoLat=s("1.5")))))
    made = catalog()
    shown = {
        "channel1_company": [F.col("name"), F.col("companyType"), F.coalesce("isBlocked", F.lit(False))],
        "categories": ["category"], "productGroups": ["productGroup"], "companySubtypes": ["companySubtype"],
        "sustainability": ["title", "type", "Doc"], "social": ["title"], "officeAddresses": ["line1", "employees"], "factoryAddresses": ["line1", "employees"],
        "profilePics": ["fileName", "sequence"], "topBrands": ["brandName"], "admin": ["firstName"], "contact": ["city"],
        "channel1_user": [F.col("firstName"), F.to_json("company")], "topbrands": ["brandName"],
        "channel1_orderline-steps": [F.col("displayName")], "evidencePhotos": ["fileName", "geoLat"],
    }
    parts = []
    for root, doc in (("channel1_company", company), ("channel1_user", user), ("channel1_orderline-steps", steps)):
        for name, df in normalize_staged(c.select(doc.alias("doc")), made, root):
            own = shown.get(name) or shown[name[len(root) + 1 :]]
            value = [F.coalesce((F.col(x) if isinstance(x, str) else x).cast("string"), F.lit("")) for x in own]
            value = F.concat_ws("|", *value) if len(own) > 1 else (F.col(own[0]) if isinstance(own[0], str) else own[0]).cast("string")
            parts.append(df.select(F.lit(name if root == "channel1_company" else sanitize_name(name)).alias("table_name"), F.col(df.columns[0]).alias("key"),
                                   F.col(df.columns[0 if name == root else 1]).alias("parent"), value.alias("value")))
    return reduce(DataFrame.unionByName, parts)


# -- C4 S5 G6 ---------------------------------------------------------------------
@query("schema_checks", f"""
WITH {_RANKED}, {_DOCS}
SELECT 'shop_order_fabric' AS table_name, doc_id || '_fabric' AS key, doc_id AS parent,
       CASE WHEN o_orderpriority = '2-HIGH' THEN o_orderpriority END AS note, true AS as_declared FROM docs
UNION ALL
SELECT 'no_items', NULL, NULL, 'nested_id string, id string, parent_id string, qty string, flag string, dims string, w string, note string', true
""")
def schema_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the fabric table, whose schema is the declared one, and the
    path table of documents without any items, which has no rows but its schema."""
    t = tables_of(order_documents(spark, sf_dir, lines=False, fabric=True), SHOP, "shop_order")["shop_order_fabric"]
    declared = T.StructType([T.StructField(n, T.StringType()) for n in ("id", "order_id", "items", "note")])
    fabric = t.select(F.lit("shop_order_fabric").alias("table_name"), F.col("id").alias("key"), F.col("order_id").alias("parent"), "note",
                      F.lit(schema_matches(t, declared)).alias("as_declared"))
    none = tables_of(order_documents(spark, sf_dir, lines=False), SHOP, "shop_order")["shop_order_fabric_items"]
    said = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in none.schema.fields)
    empty = none.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("no_items").alias("table_name"), F.lit(None).cast("string").alias("key"), F.lit(None).cast("string").alias("parent"),
        F.lit(said).alias("note"), (F.col("n") == 0).alias("as_declared"))
    return fabric.unionByName(empty)


# -- Q19 ---------------------------------------------------------------------
@query("default_fill", """
SELECT CAST(event_id AS VARCHAR) AS relationship_id,
       CASE WHEN event_type = 'signup' THEN 'unknown' ELSE event_type END AS kind
FROM events
""")
def default_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    doc = F.struct(
        F.col("event_id").cast("string").alias("_id"),
        F.when(F.col("event_type") != "signup", F.col("event_type")).alias("kind"),
    )
    main = tables_of(e.select(F.to_json(doc).alias("doc")), EVENTS, "event", with_defaults=True)["event"]
    return main.select("relationship_id", "kind")


# -- P10 ---------------------------------------------------------------------
@query("source_fields", """
SELECT 'part_specs_P' || CAST(p_partkey AS VARCHAR) || '_' || CAST(p_partkey AS VARCHAR) || '_0' AS nested_id,
       'footprint_' || CAST(p_partkey AS VARCHAR) || '_0' AS id,
       'P' || CAST(p_partkey AS VARCHAR) AS parent_id,
       CASE WHEN p_size < 10 THEN '' ELSE p_brand END AS brand,
       CASE WHEN p_size < 10 THEN '' ELSE '{"name":"' || p_brand || '"}' END AS brand_obj,
       CAST(p_size AS VARCHAR) AS size,
       p_type AS type,
       '' AS missing
FROM part
""")
def source_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    info = F.when(F.col("p_size") >= 10, F.struct(F.struct(F.col("p_brand").alias("name")).alias("brand")))
    item = F.struct(
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("ID"),
        info.alias("info"), F.col("p_size").alias("size"), F.col("p_type").alias("type"),
    )
    doc = F.struct(
        F.col("p_partkey").cast("string").alias("_id"),
        F.struct(F.array(item).alias("items")).alias("specs"),
    )
    return tables_of(p.select(F.to_json(doc).alias("doc")), PARTS, "part")["part_specs"]


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
