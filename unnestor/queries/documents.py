"""Document databases derived from the driver tables, and their layouts.

The catalogue queries turn relational tables into JSON documents (the shape a
document store exports) and run the engine over them, so the scan, parse and
unnest paths all do their real work, and the work grows with the tables.
Edge cases are chosen by data attributes (priority, status, flags, segment),
never by sampling or dropping rows.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.catalog import Catalog
from ..sources.tables import PAGE_SIZE, attach_pages, doc_id, pack_rows, spread


def table(spark: SparkSession, sf_dir: str, name: str, spread_rows: bool = True) -> DataFrame:
    """A driver table, spread over the cluster's cores when it is stored as
    fewer splits than that (see ``spread``)."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread(df) if spread_rows else df


# every lineitem column, so array order is a total order (rows are distinct)
LINE_ORDER = [
    "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]
TURN_ORDER = ["turn", "role", "text"]

SHOP = Catalog.from_yaml_text(
    """
shop_order:
  table_name: shop_order
  primary_key: relationship_id
  nested_tables:
    - {field: fabric, target_table: shop_order_fabric, foreign_key: order_id}
    - {field: orderLines, target_table: shop_order_lines, foreign_key: order_id}
    - {field: lineNumbers, target_table: shop_order_linenos, foreign_key: order_id}
  fields:
    - {name: relationship_id, type: string, source_field: _id}
    - {name: custkey, type: integer}
    - {name: status, type: string}
    - {name: totalprice, type: float}
    - {name: orderdate, type: timestamp}
    - {name: priority, type: string}
    - {name: lineNumbers, type: "array<integer>"}
    - {name: orderLines, type: "array<map<string,string>>"}
    - name: fabric
      type: struct
      fields:
        - {name: items, type: string}
        - {name: note, type: string}
shop_order_lines:
  table_name: shop_order_lines
  primary_key: nested_id
  is_array: true
  fields:
    - {name: nested_id, type: string, generated: true}
    - {name: partkey, type: integer}
    - {name: suppkey, type: integer}
    - {name: linenumber, type: integer}
    - {name: quantity, type: float}
    - {name: extendedprice, type: float}
    - {name: discount, type: float}
    - {name: tax, type: float}
    - {name: returnflag, type: string}
    - {name: linestatus, type: string}
    - {name: shipdate, type: string}
shop_order_linenos:
  table_name: shop_order_linenos
  primary_key: id
  is_array: true
  fields:
    - {name: id, type: string, generated: true}
    - {name: linenumber, type: integer}
shop_order_fabric:
  table_name: shop_order_fabric
  primary_key: id
  foreign_key: order_id
  nested_tables:
    - {field: items, target_table: shop_order_fabric_items, foreign_key: parent_id, use_nested_transformer: true}
  fields:
    - {name: id, type: string, generated: true}
    - {name: order_id, type: string}
    - {name: items, type: string}
    - {name: note, type: string}
shop_order_fabric_items:
  table_name: shop_order_fabric_items
  primary_key: nested_id
  is_array: true
  path: [{field: fabric}, {field: items}]
  source_id_field: ID
  fields:
    - {name: nested_id, type: string, generated: true}
    - {name: id, type: string, generated: true}
    - {name: parent_id, type: string, source_field: id}
    - {name: qty, type: string}
    - {name: flag, type: string}
    - {name: dims, type: string}
    - {name: w, type: string, source_field: dims.w}
    - {name: note, type: string}
"""
)

# Same documents, order lines read with integer casts that fit, do not fit
# (letters) or find no key.
SHOP_TYPED = Catalog.from_yaml_text(
    """
shop_order:
  table_name: shop_order
  primary_key: relationship_id
  nested_tables:
    - {field: orderLines, target_table: shop_order_lines_typed, foreign_key: order_id}
  fields:
    - {name: relationship_id, type: string, source_field: _id}
    - {name: orderLines, type: "array<map<string,string>>"}
shop_order_lines_typed:
  table_name: shop_order_lines_typed
  is_array: true
  fields:
    - {name: nested_id, type: string, generated: true}
    - {name: linenumber, type: integer}
    - {name: partkey, type: integer}
    - {name: returnflag, type: integer}
    - {name: warehouse, type: integer}
"""
)

CUSTOMERS = Catalog.from_yaml_text(
    """
customer:
  table_name: customer
  primary_key: relationship_id
  nested_tables:
    - {field: contact, target_table: customer_contact, foreign_key: customer_id}
  fields:
    - {name: relationship_id, type: string, source_field: _id}
    - {name: name, type: string}
    - {name: version, type: integer}
    - name: contact
      type: struct
      fields:
        - {name: name, type: string}
        - {name: nationkey, type: integer}
        - {name: segment, type: string}
        - {name: acctbal, type: float}
customer_contact:
  table_name: customer_contact
  primary_key: id
  is_array: false
  fields:
    - {name: id, type: string, generated: true}
    - {name: customer_id, type: string}
    - {name: name, type: string}
    - {name: nationkey, type: integer}
    - {name: segment, type: string}
    - {name: acctbal, type: float}
"""
)

CONVERSATIONS = Catalog.from_yaml_text(
    """
conversation:
  table_name: conversation
  primary_key: relationship_id
  nested_tables:
    - {field: turns, target_table: conversation_turns, foreign_key: conv_id}
  fields:
    - {name: relationship_id, type: string, source_field: _id}
    - {name: turns, type: "array<map<string,string>>"}
conversation_turns:
  table_name: conversation_turns
  is_array: true
  fields:
    - {name: nested_id, type: string, generated: true}
    - {name: turn, type: integer}
    - {name: role, type: string}
    - {name: text, type: string}
"""
)

PARTS = Catalog.from_yaml_text(
    """
part:
  table_name: part
  primary_key: relationship_id
  nested_tables:
    - {field: specs, target_table: part_specs, foreign_key: parent_id}
  fields:
    - {name: relationship_id, type: string, source_field: _id}
    - {name: size, type: float}
    - {name: retail, type: float}
    - {name: retail_num, type: float}
    - name: specs
      type: struct
      fields:
        - {name: items, type: string}
part_specs:
  table_name: part_specs
  is_array: true
  use_nested_transformer: true
  path: [{field: specs}, {field: items}]
  source_id_field: ID
  fields:
    - {name: nested_id, type: string, generated: true}
    - {name: id, type: string, generated: true}
    - {name: parent_id, type: string}
    - {name: brand, type: string, source_field: info.brand.name}
    - {name: brand_obj, type: string, source_field: info.brand}
    - {name: size, type: string}
    - {name: type, type: string}
    - {name: missing, type: string, source_field: extra.x.y}
"""
)

# Orders whose items have the quirks of hand-made JSON.
QUIRKS = Catalog.from_yaml_text(
    """
quirk:
  table_name: quirk
  primary_key: relationship_id
  nested_tables:
    - {field: f, target_table: quirk_items, foreign_key: parent_id, use_nested_transformer: true}
  fields:
    - {name: relationship_id, type: string, source_field: _id}
quirk_items:
  table_name: quirk_items
  primary_key: nested_id
  is_array: true
  path: [{field: f}, {field: items}]
  source_id_field: ID
  fields:
    - {name: nested_id, type: string, generated: true}
    - {name: id, type: string, generated: true}
    - {name: parent_id, type: string}
    - {name: price, type: string}
    - {name: note, type: string}
"""
)

EVENTS = Catalog.from_yaml_text(
    """
event:
  table_name: event
  primary_key: relationship_id
  fields:
    - {name: relationship_id, type: string, source_field: _id}
    - {name: ts, type: timestamp}
    - {name: kind, type: string, default: unknown}
    - {name: props, type: "map<string,string>"}
    - {name: tags, type: "array<map<string,string>>"}
"""
)


Row = Callable[[str], Column]


def _text(c: str, r: Row = F.col) -> Column:
    return r(c).cast("string")


def line_map(null_when_returned: bool = False, r: Row = F.col) -> Column:
    """The order line as a text map; ``r`` resolves a lineitem column (a
    plain column, or a field of a packed row)."""
    _text = lambda c: r(c).cast("string")
    F_col = r  # noqa: N806
    m = F.create_map(
        F.lit("partkey"), _text("l_partkey"),
        F.lit("suppkey"), _text("l_suppkey"),
        F.lit("linenumber"), _text("l_linenumber"),
        F.lit("quantity"), _text("l_quantity"),
        F.lit("extendedprice"), _text("l_extendedprice"),
        F.lit("discount"), _text("l_discount"),
        F.lit("tax"), _text("l_tax"),
        F.lit("returnflag"), F_col("l_returnflag"),
        F.lit("linestatus"), F_col("l_linestatus"),
        F.lit("shipdate"), _text("l_shipdate"),
    )
    if null_when_returned:
        m = F.when(F_col("l_returnflag") != "R", m)
    return m


def fabric_item(r: Row = F.col) -> Column:
    """JSON text of one fabric item, its kind picked by the line's return flag
    and status: R -> a bare number; A/F -> a blank id; A/O -> a zero id;
    N/O -> a text id; N/F -> a numeric id (falsy when the supplier key is 0)."""
    flag, status = r("l_returnflag"), r("l_linestatus")
    qty = r("l_quantity").alias("qty")
    dims = F.struct(r("l_linenumber").alias("w"))
    proper_text = F.to_json(F.struct(
        F.concat(F.lit("S"), _text("l_suppkey", r)).alias("ID"),
        qty, r("l_returnflag").alias("flag"), dims.alias("dims"),
    ))
    proper_num = F.to_json(F.struct(
        r("l_suppkey").alias("ID"), qty, dims.alias("dims"),
        F.parse_json(F.lit("null")).alias("note"),
    ))
    return (
        F.when(flag == "R", _text("l_linenumber", r))
        .when((flag == "A") & (status == "F"), F.to_json(F.struct(F.lit("").alias("ID"), qty)))
        .when(flag == "A", F.to_json(F.struct(F.lit(0).alias("ID"), qty)))
        .when(status == "O", proper_text)
        .otherwise(proper_num)
    )


# JSON text of the ``fabric`` value per order, by priority and status:
# no fabric, items as text, fabric null, items an object, items an array.
def fabric_value(items: Column) -> Column:
    pr, st = F.col("o_orderpriority"), F.col("o_orderstatus")
    return (
        F.when(pr == "1-URGENT", F.lit(None))
        .when(pr == "2-HIGH", F.to_json(F.struct(F.lit("text").alias("items"), F.col("o_orderpriority").alias("note"))))
        .when((pr == "3-MEDIUM") & (st == "F"), F.lit("null"))
        .when((pr == "4-NOT SPECIFIED") & (st == "O"), F.lit('{"items":{"ID":"x"}}'))
        .otherwise(F.concat(F.lit('{"items":['), F.coalesce(F.array_join(items, ","), F.lit("")), F.lit("]}")))
    )


def with_field(doc: Column, name: str, value: Column) -> Column:
    """A JSON object with another field, given as JSON text (null: without)."""
    more = F.concat(F.substring(doc, F.lit(1), F.length(doc) - 1), F.lit(f',"{name}":'), value, F.lit("}"))
    return F.when(value.isNotNull(), more).otherwise(doc)


def order_documents(
    spark: SparkSession,
    sf_dir: str,
    lines: bool = True,
    numbers: bool = False,
    fabric: bool = False,
    null_when_returned: bool = False,
    page_size: int = PAGE_SIZE,
    of_orders: Column | None = None,
    with_lines: Column | None = None,
) -> DataFrame:
    """Order documents ``{_id, custkey, status, totalprice, orderdate,
    priority, orderLines?, lineNumbers?, fabric?}``, one per order and page
    of at most ``page_size`` lines. ``of_orders`` and ``with_lines`` choose the
    orders that become documents, and the lines that they have."""
    # both go straight into the shuffle of their join, so they are not spread
    orders = table(spark, sf_dir, "orders", spread_rows=False)
    li = table(spark, sf_dir, "lineitem", spread_rows=False)
    if with_lines is not None:
        li = li.where(with_lines)
    if of_orders is not None:
        orders = orders.where(of_orders)

    pages, single = pack_rows(li, ["l_orderkey"], LINE_ORDER, page_size)
    docs = attach_pages(orders, "o_orderkey", pages, "l_orderkey", "_items", single)

    def of_each(build: Callable[[Row], Column]) -> Column:  # an array of what is made of each packed line
        return F.transform("_items", lambda x: build(lambda c: x[c]))

    def number(r: Row) -> Column:
        n = r("l_linenumber")
        return F.when(r("l_returnflag") != "R", n) if null_when_returned else n

    fields = [
        doc_id("o_orderkey").alias("_id"),
        F.col("o_custkey").alias("custkey"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("totalprice"),
        _text("o_orderdate").alias("orderdate"),
        F.col("o_orderpriority").alias("priority"),
    ]
    if lines:
        fields.append(of_each(lambda r: line_map(null_when_returned, r)).alias("orderLines"))
    if numbers:
        fields.append(of_each(number).alias("lineNumbers"))
    doc = F.to_json(F.struct(*fields))
    if not fabric:
        return docs.select(doc.alias("doc"))
    # spliced in as text, so that its numbers stay as they are written; above
    # generators, so that both texts are built once
    texts = docs.select(F.explode_outer(F.array(F.struct(
        doc.alias("doc"), fabric_value(of_each(fabric_item)).alias("fabric")))).alias("t"))
    return texts.select(with_field(F.col("t.doc"), "fabric", F.col("t.fabric")).alias("doc"))
