"""Sources, sinks, projections, filters and ordering."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.registry import check
from classmap.operators import enrich, ordering, profile, rows
from classmap.operators.joins import require_columns
from classmap.plans.rerank import pick_model_name
from classmap.plans.settle import new_path
from classmap.functions import text
from classmap.sources import sinks, tables


@check("scan_table", "select row_number() over () - 1 row_pos, p_partkey, p_name from part")
def scan_table(spark, sf):
    return tables.scan_table(spark, f"{sf}/part.parquet", columns=["p_partkey", "p_name"])


@check(
    "scan_sheets",
    """select 'customers' sheet, 0 sheet_pos, row_number() over () - 1 row_pos, c_name, null s_name from customer
       union all select 'suppliers', 1, row_number() over () - 1, null, s_name from supplier""",
)
def scan_sheets(spark, sf):
    sheets = {"customers": f"{sf}/customer.parquet", "suppliers": f"{sf}/supplier.parquet"}
    return tables.scan_sheets(spark, sheets).select("sheet", "sheet_pos", "row_pos", "c_name", "s_name")


def raw_grid(spark, sf):
    """Parts as a headerless grid below two sparse title rows and a header row."""
    part = fx.table(spark, sf, "part")
    data = part.select(
        (F.col("p_partkey") + 3).alias("row_pos"), F.col("p_name").alias("_c0"),
        F.col("p_brand").alias("_c1"), F.col("p_type").alias("_c2"),
        F.col("p_size").cast("string").alias("_c3"),
    )
    titles = spark.createDataFrame(
        [(0, "Items", None, None, None), (1, None, None, None, None),
         (2, "Item Name", "Brand", None, "Size")],
        data.schema,
    )
    return titles.unionByName(data)


@check(
    "guess_header_row",
    """with g as (select 0 row_pos, 1 filled union all select 1, 0 union all select 2, 3
         union all select p_partkey+3, (p_name is not null)::int + (p_brand is not null)::int
           + (p_type is not null)::int + (p_size is not null)::int from part)
       select min(row_pos)::bigint header_row_index from g where row_pos < 10 and filled >= 2""",
)
def guess_header_row(spark, sf):
    return tables.guess_header_row(raw_grid(spark, sf))


@check(
    "promote_header",
    """select p_partkey+3 row_pos, p_name "Item Name", p_brand "Brand", p_type "_c2", p_size::varchar "Size" from part""",
)
def promote_header(spark, sf):
    return tables.promote_header(raw_grid(spark, sf))


@check(
    "scan_embeddings",
    f"select vec_id id, {fx.VECTOR_SQL} from embeddings",
)
def scan_embeddings(spark, sf):
    df = tables.scan_embeddings(spark, f"{sf}/embeddings.parquet", id="vec_id")
    return df.select("id", fx.vector_text("embedding"))


@check("sink_table", "select p_partkey, p_name, p_retailprice from part")
def sink_table(spark, sf):
    part = fx.table(spark, sf, "part").select("p_partkey", "p_name", "p_retailprice")
    path = sinks.sink_table(part, new_path(spark, "parts"), fmt="csv")
    return spark.read.schema(part.schema).option("header", True).csv(path)


@check("sink_sheets", """select p_partkey row_pos, p_name, p_type sheet,
    (dense_rank() over (order by p_type) - 1)::int sheet_pos from part""")
def sink_sheets(spark, sf):
    part = fx.table(spark, sf, "part").select(
        F.col("p_partkey").alias("row_pos"), "p_name", F.col("p_type").alias("sheet")
    )
    path = sinks.sink_sheets(part, new_path(spark, "sheets"), files_per_sheet=4)
    return tables.scan_sheets(spark, path)


@check("sink_embeddings", f"select vec_id id, {fx.VECTOR_SQL} from embeddings")
def sink_embeddings(spark, sf):
    path = new_path(spark, "embeddings")
    sinks.sink_embeddings(fx.vectors(spark, sf), path)
    return tables.scan_embeddings(spark, path).select("id", fx.vector_text("embedding"))


@check(
    "embeddings_to_json",
    f"select vec_id id, {fx.VECTOR_SQL} from embeddings",
)
def embeddings_to_json(spark, sf):
    out = sinks.embeddings_to_json(fx.vectors(spark, sf))
    back = out.select(F.from_json("json", "id bigint, embedding array<float>").alias("j"))
    return back.select("j.id", fx.vector_text("j.embedding"))


@check("normalize_columns", 'select p_partkey "part key", p_name "name" from part')
def normalize_columns(spark, sf):
    part = fx.table(spark, sf, "part").select("p_partkey", "p_name")
    return rows.normalize_columns(part.toDF(" Part KEY", "NAME\t"))


@check("normalize_columns_nbsp", 'select p_partkey "Part KEY", p_name "NAME" from part')
def normalize_columns_nbsp(spark, sf):
    part = fx.table(spark, sf, "part").select("p_partkey", "p_name")
    return rows.normalize_columns_nbsp(part.toDF(" Part\u00a0KEY ", "\u00a0NAME"))


@check(
    "filter_leaf_classes",
    f"with {fx.NODES_SQL} select id, name, level from nodes where lowest_level_class",
)
def filter_leaf_classes(spark, sf):
    return rows.filter_leaf_classes(fx.classes(spark, sf)).select("id", "name", "level")


@check(
    "filter_nonblank",
    f"""with {fx.ITEMS_SQL} select item_id, "Type" from items where trim("Type") <> ''""",
)
def filter_nonblank(spark, sf):
    return rows.filter_nonblank(fx.items(spark, sf), "Type").select("item_id", "Type")


# A level sheet with gaps: level 1 on some rows, blanks and nulls below it.
RAGGED_SQL = """
sheet as (select p_partkey row_pos,
  case when p_partkey%9=3 then p_type end l1,
  case when p_partkey%15=9 then '  ' when p_partkey>0 and p_partkey%2=1 then p_brand end l2,
  case when p_partkey=0 then null when p_partkey%15=12 then '  ' when p_partkey%15=6 then null else p_name end l3
  from part),
fl as (select row_pos, last_value(l1 ignore nulls) over w l1, last_value(l2 ignore nulls) over w l2,
  last_value(l3 ignore nulls) over w l3 from sheet
  window w as (order by row_pos rows between unbounded preceding and current row))"""
RAGGED_CELLS_SQL = """
x as (select row_pos,1 lvl,trim(l1) nm from fl union all select row_pos,2,trim(l2) from fl union all select row_pos,3,trim(l3) from fl),
y as (select *, lag(lvl) over v plvl, lag(nm) over v pnm from x where nm is not null and nm<>''
  window v as (partition by row_pos order by lvl))"""
RAGGED_NODES_SQL = """
f as (select lvl,nm,min(row_pos*10+lvl) k, arg_min({'l': plvl, 'n': pnm}, row_pos*10+lvl) p from y group by 1,2),
n as (select row_number() over (order by k) id, nm as name, lvl as level, p.l plvl, p.n pnm from f),
nd as (select a.id,a.name,a.level,'Level '||a.level level_label,b.id parent_id from n a left join n b on b.level=a.plvl and b.name=a.pnm)"""


def ragged_sheet(spark, sf):
    k, part = F.col("p_partkey"), fx.table(spark, sf, "part")
    blank, none = F.lit("  "), F.lit(None).cast("string")
    return part.select(
        k.alias("row_pos"),
        F.when(k % 9 == 3, F.col("p_type")).alias("Level 1"),
        F.when(k % 15 == 9, blank).when((k > 0) & (k % 2 == 1), F.col("p_brand")).alias("Level 2"),
        F.when(k == 0, none).when(k % 15 == 12, blank).when(k % 15 == 6, none)
        .otherwise(F.col("p_name")).alias("Level 3"),
    )


LEVELS = ["Level 1", "Level 2", "Level 3"]


@check(
    "drop_all_null_rows",
    f"""with {RAGGED_SQL} select row_pos, l1 "Level 1", l2 "Level 2", l3 "Level 3" from sheet
        where l1 is not null or l2 is not null or l3 is not null""",
)
def drop_all_null_rows(spark, sf):
    return rows.drop_all_null_rows(ragged_sheet(spark, sf), LEVELS)


@check(
    "forward_fill_levels",
    f"""with {RAGGED_SQL} select row_pos, l1 "Level 1", l2 "Level 2", l3 "Level 3" from fl""",
)
def forward_fill_levels(spark, sf):
    return ordering.forward_fill(ragged_sheet(spark, sf), LEVELS, ranges=5)


@check(
    "select_level_columns",
    f"""with {RAGGED_SQL} select l1 "Level 1", l2 "Level 2", l3 "Level 3" from sheet""",
)
def select_level_columns(spark, sf):
    sheet = ragged_sheet(spark, sf)
    return sheet.select(*rows.select_level_columns(sheet.columns))


@check(
    "project_columns",
    "select p_brand, p_type from (select distinct p_name, p_brand, p_type from part)",
)
def project_columns(spark, sf):
    unique = enrich.extract_unique_rows(part_rows(spark, sf), columns=["p_brand", "p_type"], add_id=False)
    return unique.select("p_brand", "p_type")


@check(
    "prefix_columns",
    f"with {fx.NODES_SQL} select id class_id, name class_name, parent_id class_parent_id from nodes",
)
def prefix_columns(spark, sf):
    return rows.prefix_columns(fx.classes(spark, sf).select("id", "name", "parent_id"))


@check("add_missing_columns", 'select p_partkey, p_name, null::varchar "Coating" from part')
def add_missing_columns(spark, sf):
    part = fx.table(spark, sf, "part").select("p_partkey", "p_name")
    return rows.add_missing_columns(part, ["p_name", "Coating"])


@check(
    "build_context",
    f"""with {fx.ITEMS_SQL} select item_id, concat_ws(';', 'Brand='||"Brand", 'Type='||nullif(trim("Type"),''),
        'Size='||"Size") context from items""",
)
def build_context(spark, sf):
    df = fx.items(spark, sf)
    context = rows.context_map(df, exclude=["ITEM_ID", "Item_Name"])
    entries = F.transform(F.map_entries(context), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return df.select("item_id", F.array_join(entries, ";").alias("context"))


@check(
    "pick_first_nonblank",
    f"""with {fx.ITEMS_SQL} select item_id, coalesce(nullif(trim("Type"),''), trim(item_name)) picked from items""",
)
def pick_first_nonblank(spark, sf):
    return fx.items(spark, sf).select("item_id", text.pick_first_nonblank("Type", "item_name").alias("picked"))


@check("fallback_id", "select p_partkey row_pos, p_partkey*2 given, p_partkey absent from part")
def fallback_id(spark, sf):
    part = part_rows(spark, sf).withColumn("no", F.col("row_pos") * 2)
    return part.select(
        "row_pos", rows.fallback_id(part, "no").alias("given"), rows.fallback_id(part, "id").alias("absent")
    )


@check("replace_missing_text", f"""with {fx.ITEMS_SQL} select item_id, coalesce("Brand", '') brand from items""")
def replace_missing_text(spark, sf):
    return fx.items(spark, sf).select("item_id", text.replace_missing_text("Brand").alias("brand"))


@check("pick_model_name", f"""with {fx.ITEMS_SQL} select item_id, "Brand" shown, item_name otherwise from items""")
def pick_model_name_(spark, sf):
    df = fx.items(spark, sf)
    return df.select(
        "item_id",
        F.col(pick_model_name(df, "Brand", "item_name")).alias("shown"),
        F.col(pick_model_name(df, "description", "item_name")).alias("otherwise"),
    )


@check("require_columns", f"with {fx.ITEMS_SQL} select item_id, item_name from items")
def require_columns_(spark, sf):
    return require_columns(fx.items(spark, sf), "item_id", "item_name").select("item_id", "item_name")


def part_rows(spark, sf):
    return fx.table(spark, sf, "part").select(
        F.col("p_partkey").alias("row_pos"), "p_name", "p_brand", "p_type"
    )


@check("dedupe_rows", "select min(p_partkey) row_pos, p_name, p_brand, p_type from part group by 2,3,4")
def dedupe_rows(spark, sf):
    return rows.dedupe_rows(part_rows(spark, sf))


@check(
    "duplicate_report",
    """select p_partkey row_pos, p_name, p_brand, p_type from part
       qualify count(*) over (partition by p_name, p_brand, p_type) > 1""",
)
def duplicate_report(spark, sf):
    return rows.duplicate_report(part_rows(spark, sf))


@check(
    "dedupe_lineitem",
    """select min(p) row_pos, l_partkey, l_quantity, l_returnflag from
       (select l_orderkey*10+l_linenumber p, * from lineitem) group by 2,3,4""",
)
def dedupe_lineitem(spark, sf):
    line = fx.table(spark, sf, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("row_pos"),
        "l_partkey", "l_quantity", "l_returnflag",
    )
    return rows.dedupe_rows(line)


@check(
    "assign_unique_id",
    """select row_number() over (order by o_orderkey) "Unique_ID", o_orderkey row_pos, o_custkey from orders""",
)
def assign_unique_id(spark, sf):
    orders = fx.table(spark, sf, "orders").select(F.col("o_orderkey").alias("row_pos"), "o_custkey")
    return ordering.number_rows(orders, ranges=5)


@check(
    "extract_unique_rows",
    """select row_number() over (order by row_pos) "Unique_ID", row_pos, p_brand, p_type from
       (select min(p_partkey) row_pos, p_name, p_brand, p_type from part group by 2,3,4)""",
)
def extract_unique_rows(spark, sf):
    return enrich.extract_unique_rows(part_rows(spark, sf), columns=["p_brand", "p_type"], ranges=5)


@check("head_limit", "select p_partkey row_pos, p_name, p_brand, p_type from part order by 1 limit 50")
def head_limit(spark, sf):
    return ordering.head_limit(part_rows(spark, sf), 50)


@check(
    "sample_items",
    f"""with {fx.ITEMS_SQL} select item_id, item_name from with_vec
        order by md5('42:' || item_id), item_id limit 40""",
)
def sample_items(spark, sf):
    drawn = ordering.sample_items(fx.items(spark, sf), fx.item_emb(spark, sf), 40, id="item_id")
    return drawn.select("item_id", "item_name")


@check(
    "stable_item_order",
    "select row_pos, p_name from (select p_partkey row_pos, p_name from part) order by row_pos",
)
def stable_item_order(spark, sf):
    return ordering.stable_item_order(part_rows(spark, sf).select("row_pos", "p_name"))


@check(
    "union_sheets",
    """select 'A' sheet, 0 sheet_pos, p_partkey id, p_brand "Type Code", null "Coating" from part
       union all select 'B', 1, s_suppkey, null, s_name from supplier""",
)
def union_sheets(spark, sf):
    a = fx.table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("Type Code"))
    b = fx.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("Coating"))
    unusable = fx.table(spark, sf, "region").select("r_name")
    return rows.union_sheets({"A": a, "B": b, "C": unusable}, key="id")


@check(
    "embedding_profile",
    """select count(*) "items", min(len(embedding))::int min_dim, max(len(embedding))::int max_dim from embeddings""",
)
def embedding_profile(spark, sf):
    return profile.embedding_profile(fx.vectors(spark, sf))


@check(
    "embedding_preview",
    "select vec_id id, len(embedding)::int dim from embeddings order by 1 limit 3",
)
def embedding_preview(spark, sf):
    return profile.embedding_preview(fx.vectors(spark, sf))
