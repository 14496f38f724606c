"""Text rules, abbreviations, enrichment."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.registry import check
from classmap.functions import replies, text
from classmap.operators import abbreviations as ab
from classmap.operators import enrich, joins, rows
from classmap.plans import cleanup

WS = text.WHITESPACE
SPACES = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def sql_strip(x: str) -> str:
    return f"trim({x}, '{WS}')"


def docs(spark, sf):
    return fx.table(spark, sf, "documents").select("doc_id", "text")


# --- lines, numbers, names over whole documents

WRAPPED = "case doc_id % 4 when 0 then '`' || text || '` ' when 1 then ' \"' || text || '\"' when 2 then '''' || text || '''' else text end"


def clean_sql(x: str) -> str:
    ticks = sql_strip(f"trim({sql_strip(f'coalesce({x}, chr(32))')}, '`')")
    quotes = sql_strip(f"trim(trim({ticks}, '\"'), '''')")
    lines = rf"string_split_regex({quotes}, '[\n\r\x0b\x0c\x1c\x1d\x1e\x{{85}}\x{{2028}}\x{{2029}}]+')"
    kept = f"list_filter(list_transform({lines}, lambda p: {sql_strip('p')}), lambda p: p <> '')"
    return f"coalesce({kept}[1], '')"


@check(
    "clean_single_line",
    f"select doc_id, {clean_sql('w')} line from (select doc_id, {WRAPPED} w from documents)",
)
def clean_single_line(spark, sf):
    wrapped = docs(spark, sf).withColumn("w", F.expr(WRAPPED.replace("''''", '"\'"')))
    return wrapped.select("doc_id", text.clean_single_line("w").alias("line"))


@check(
    "numbers_preserved",
    r"""select doc_id, list_bool_and(list_transform(regexp_extract_all(text, '\p{Nd}+(?:\.\p{Nd}+)?'), lambda n: contains(replace(text, '3', '4'), n)) || [true]) kept,
        true same from documents""",
)
def numbers_preserved(spark, sf):
    return docs(spark, sf).select(
        "doc_id",
        text.numbers_preserved("text", F.replace("text", F.lit("3"), F.lit("4"))).alias("kept"),
        text.numbers_preserved("text", "text").alias("same"),
    )


LINES_SQL = """(select doc_id, unnest(string_split(text, chr(10))) t,
    generate_subscripts(string_split(text, chr(10)), 1) line from documents)"""
VALID_SQL = rf"""(t <> '' and not regexp_matches(t, '\p{{Nd}}') and length(t) <= 60
    and len(list_filter(string_split_regex(t, '{SPACES}+'), lambda w: w <> '')) <= 8)"""


@check("is_valid_main_name", f"select doc_id, line, {VALID_SQL} valid from {LINES_SQL}")
def is_valid_main_name(spark, sf):
    """Every line of every document."""
    lines = docs(spark, sf).select("doc_id", F.posexplode(F.split("text", "\n")).alias("at", "t"))
    return lines.select(
        "doc_id", (F.col("at") + 1).cast("bigint").alias("line"), text.is_valid_main_name("t").alias("valid")
    )


def fallback_sql(x: str) -> str:
    parts = rf"string_split_regex({sql_strip(x)}, '(?:{SPACES}|[,;/])+')"
    kept = rf"list_filter({parts}, lambda w: length(w) > 1 and not regexp_matches(w, '\p{{Nd}}'))"
    return f"coalesce(nullif(array_to_string(list_slice({kept}, 1, 3), ' '), ''), {sql_strip(x)})"


@check("fallback_main_name", f"select doc_id, {fallback_sql('text')} main_name from documents")
def fallback_main_name(spark, sf):
    return docs(spark, sf).select("doc_id", text.fallback_main_name("text").alias("main_name"))


# A reply per document: refused, wrapped, or with its numbers changed.
REPLY = "case doc_id % 4 when 0 then 'ERROR: quota' when 1 then replace(text, 'e', 'E') when 2 then replace(text, '1', 'one') else '  ' end"


@check(
    "accept_or_fallback",
    rf"""select doc_id, case when line <> '' and not starts_with(line, 'ERROR:')
          and list_bool_and(list_transform(regexp_extract_all(text, '\p{{Nd}}+(?:\.\p{{Nd}}+)?'), lambda n: contains(line, n)) || [true])
          then line else text end expanded,
        case when line <> '' and not starts_with(line, 'ERROR:') and {VALID_SQL.replace('t <>', 'line <>').replace('(t,', '(line,').replace('(t)', '(line)')}
          then line else {fallback_sql('text')} end main_name
        from (select doc_id, text, {clean_sql('r')} line from (select *, {REPLY} r from documents))""",
)
def accept_or_fallback(spark, sf):
    replied = docs(spark, sf).withColumn("r", F.expr(REPLY))
    return replied.select(
        "doc_id",
        text.accept_expansion("text", "r").alias("expanded"),
        text.accept_main_name("text", "r").alias("main_name"),
    )


DIMS = r"(?i)(\d+(?:\.\d+)?(?:\s*(?:MM|CM|KM|M)?\s*X\s*\d+(?:\.\d+)?)*)\s*(MM|CM|KM|M\b)"
DIM_TEXT = "p_name || ' ' || p_size || 'MM X ' || p_size*10 || 'MM L= ' || p_size/4 || 'm ' || p_size || ' GSM'"


@check(
    "extract_dimensions",
    rf"""select p_partkey, array_to_string(list_transform(regexp_extract_all(t, '{DIMS}', 1),
          lambda v: regexp_replace(regexp_replace(lower(v), '\s+', '', 'g'), '[a-z]+x', 'x', 'g')), '; ') extracted_values,
        array_to_string(list_transform(regexp_extract_all(t, '{DIMS}', 2), lambda u: lower(u)), '; ') extracted_units
        from (select p_partkey, p_name || ' ' || p_size || 'MM X ' || p_size*10 || 'MM L= ' || (p_size/4)::double || 'm ' || p_size || ' GSM' t from part)""",
)
def extract_dimensions(spark, sf):
    part = fx.table(spark, sf, "part").select("p_partkey", F.expr(DIM_TEXT).alias("t"))
    return cleanup.extract_dimensions(part, text="t").drop("t")


@check("join_key", "select c_custkey, c_acctbal_key from (select c_custkey, case when c_acctbal = floor(c_acctbal) then c_acctbal::bigint::varchar else c_acctbal::varchar end c_acctbal_key from customer)")
def join_key(spark, sf):
    df = fx.table(spark, sf, "customer")
    return df.select("c_custkey", text.join_key("c_acctbal", "double").alias("c_acctbal_key"))


# --- model replies: one shape per item

RAW = """case item_id % 7
  when 0 then '{"choice_id": "' || item_id || '", "reasoning": " fits "}'
  when 1 then 'Sure: {"choice_id": ' || item_id || ', "reasoning": "inside prose"} done'
  when 2 then '{"choice_id": "none such", "reasoning": ""}'
  when 3 then '[1, 2]'
  when 4 then 'ERROR: quota'
  when 5 then '{"choice_id": null, "reasoning": "unsure"}'
  else '{"choice_id": 1} and {"choice_id": 2}' end"""
PARSED = r"""parsed as (select item_id, item_name, raw, case
    when json_valid(raw) then raw when json_valid(regexp_extract(raw, '(?s)\{.*\}')) then regexp_extract(raw, '(?s)\{.*\}') end js from
    (select item_id, item_name, %s raw from items))""" % RAW


@check(
    "parse_json_reply",
    f"""with {fx.ITEMS_SQL}, {PARSED} select item_id,
        case when json_type(js) = 'OBJECT' then json_extract_string(js, '$.choice_id') end choice,
        case when json_type(js) = 'OBJECT' then json_extract_string(js, '$.reasoning') end reason from parsed""",
)
def parse_json_reply(spark, sf):
    raw = fx.items(spark, sf).select("item_id", F.expr(RAW).alias("raw"))
    got = raw.withColumn("m", replies.parse_json_reply("raw"))
    return got.select(
        "item_id", F.element_at("m", "choice_id").alias("choice"), F.element_at("m", "reasoning").alias("reason")
    )


def offered(df):
    both = F.array(
        *[F.struct((F.col("item_id") + i).alias("class_id"), F.concat("item_name", F.lit(f" {i}")).alias("class_name")) for i in (0, 1)]
    )
    return df.select("item_id", F.expr(RAW).alias("raw"), both.alias("c"))


@check(
    "validate_choice",
    f"""with {fx.ITEMS_SQL}, {PARSED}, v as (select *, json_extract_string(js, '$.choice_id') choice,
          coalesce(trim(json_extract_string(js, '$.reasoning')), '') why from parsed)
        select item_id, case when json_type(js) = 'OBJECT' and choice in (item_id::varchar, (item_id+1)::varchar) then choice end choice_id,
        case when raw like 'ERROR:%' then raw
             when js is null or json_type(js) <> 'OBJECT' then 'Unparseable LLM output: ' || raw[:400]
             when choice in (item_id::varchar, (item_id+1)::varchar) then why
             else coalesce(nullif(why, ''), 'Invalid choice_id: ' || coalesce(choice, 'None')) end reasoning from v""",
)
def validate_choice(spark, sf):
    judged = offered(fx.items(spark, sf)).withColumn("v", replies.validate_choice("raw", "c"))
    return judged.select("item_id", "v.choice_id", "v.reasoning")


@check(
    "resolve_choice",
    f"""with {fx.ITEMS_SQL}, {PARSED} select item_id,
        case when json_extract_string(js, '$.choice_id') = item_id::varchar then item_name || ' 0'
             when json_extract_string(js, '$.choice_id') = (item_id+1)::varchar then item_name || ' 1' end chosen from parsed""",
)
def resolve_choice(spark, sf):
    judged = offered(fx.items(spark, sf)).withColumn("v", replies.validate_choice("raw", "c"))
    return judged.select("item_id", replies.resolve_choice("v.choice_id", "c").alias("chosen"))


VALUES = """case item_id % 6
  when 0 then '{"values": ["' || item_id || '", "2.1"], "units": ["mm", "m"]}'
  when 1 then '[{"values": [' || item_id || '], "units": ["mm"]}, {"values": ["9"]}]'
  when 2 then 'no json at all' when 3 then '{"values": "abc", "units": ["m"]}'
  when 4 then '[]' else '{"values": []} trailing' end"""
EXPECTED_VALUES = """case item_id % 6 when 0 then item_id || '; 2.1' when 1 then item_id::varchar else '' end"""
EXPECTED_UNITS = """case item_id % 6 when 0 then 'mm; m' when 1 then 'mm' when 3 then 'm' else '' end"""
VALUES_SQL = f"with {fx.ITEMS_SQL} select item_id, {EXPECTED_VALUES} extracted_values, {EXPECTED_UNITS} extracted_units from items"


def parsed_values(spark, sf):
    raw = fx.items(spark, sf).select("item_id", F.expr(VALUES).alias("raw"))
    return raw.withColumn("p", replies.parse_extraction("raw"))


@check("parse_extraction", VALUES_SQL)
def parse_extraction(spark, sf):
    p = parsed_values(spark, sf)
    return p.select(
        "item_id", F.array_join("p.values", "; ").alias("extracted_values"),
        F.array_join("p.units", "; ").alias("extracted_units"),
    )


@check("join_extraction", VALUES_SQL)
def join_extraction(spark, sf):
    p = parsed_values(spark, sf)
    return p.select(
        "item_id", replies.join_extraction("p.values").alias("extracted_values"),
        replies.join_extraction("p.units").alias("extracted_units"),
    )


# --- abbreviations: each part type is a sheet with codes taken from its parts, and one
# sheet of codes has no items

LIST_SQL = """lists as (select p_partkey row_pos, p_brand || '=' || p_name || ', ' || split_part(p_name, ' ', 1) || ' = ' || p_brand
    || ' / ' || p_size || ', BAD' || p_size || ', =x, A=b=c,' cell, p_type sheet from part
  union all select s_suppkey, s_name || '=' || s_suppkey || ' ltd', 'SPARE' from supplier)"""
ENTRIES_SQL = LIST_SQL + r""",
entries as (select row_pos, sheet, unnest(string_split(cell, ',')) entry, unnest(range(len(string_split(cell, ',')))) entry_pos from lists),
codes as (select row_pos, entry_pos::int entry_pos, sheet "Sheet", trim(case when contains(entry, '=') then substr(entry, 1, instr(entry, '=')-1) else entry end) "Code",
  case when contains(entry, '=') then trim(substr(entry, instr(entry, '=')+1)) else '' end "Description" from entries)"""


def code_lists(spark, sf):
    part = fx.table(spark, sf, "part")
    cell = F.expr(
        "p_brand || '=' || p_name || ', ' || split_part(p_name, ' ', 1) || ' = ' || p_brand "
        "|| ' / ' || p_size || ', BAD' || p_size || ', =x, A=b=c,'"
    )
    lists = part.select(F.col("p_partkey").alias("row_pos"), cell.alias("_c0"), F.col("p_type").alias("_c1"))
    spare = fx.table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("row_pos"), F.expr("s_name || '=' || s_suppkey || ' ltd'").alias("_c0"),
        F.lit("SPARE").alias("_c1"),
    )
    return lists.unionByName(spare)


@check("parse_abbreviations", f"with {ENTRIES_SQL} select * from codes")
def parse_abbreviations(spark, sf):
    return ab.parse_abbreviations(code_lists(spark, sf))


@check("abbreviation_table", f'with {ENTRIES_SQL} select "Code", "Description", "Sheet" from codes')
def abbreviation_table(spark, sf):
    return ab.abbreviation_table(code_lists(spark, sf))


TRIMMED_SQL = ENTRIES_SQL + """,
trimmed as (select "Code" code, nullif("Description", '') descr, "Sheet" sheet, row_pos*10+entry_pos row_pos
  from codes where "Code" <> '' and "Sheet" <> ''),
firsts as (select sheet, code, arg_min({'d': descr}, row_pos).d descr, min(row_pos) row_pos from trimmed group by 1, 2),
pairs as (select sheet, list({'code': code, 'descr': descr} order by length(code) desc, row_pos) pairs from firsts
  where descr is not null group by 1)"""


def code_table(spark, sf):
    parsed = ab.parse_abbreviations(code_lists(spark, sf))
    return parsed.withColumn("row_pos", F.col("row_pos") * 10 + F.col("entry_pos")).drop("entry_pos")


def trimmed(spark, sf):
    return ab.trim_fields(code_table(spark, sf))


@check("trim_fields", f"with {TRIMMED_SQL} select * from trimmed")
def trim_fields(spark, sf):
    return trimmed(spark, sf)


@check(
    "ambiguous_codes",
    f"with {TRIMMED_SQL} select sheet, code, count(distinct descr) descriptions from trimmed group by 1, 2 having count(distinct descr) > 1",
)
def ambiguous_codes(spark, sf):
    return ab.ambiguous_codes(trimmed(spark, sf))


@check(
    "replacement_map",
    f"""with {TRIMMED_SQL} select sheet, array_to_string(list_transform(pairs, lambda p: p.code || '>' || p.descr), '|') pairs from pairs""",
)
def replacement_map(spark, sf):
    shown = F.transform("pairs", lambda p: F.concat(p["code"], F.lit(">"), p["descr"]))
    return ab.replacement_map(trimmed(spark, sf)).select("sheet", F.array_join(shown, "|").alias("pairs"))


def sheet_items(spark, sf):
    """Parts as sheets by type; suppliers are a sheet without replacements."""
    part, supplier = fx.table(spark, sf, "part"), fx.table(spark, sf, "supplier")
    a = part.select(
        F.col("p_type").alias("sheet"), F.col("p_partkey").alias("row_pos"),
        F.expr("p_brand || ' ' || p_name || ' x' || p_brand || ' A BAD' || p_size").alias("text"), "p_size",
    )
    b = supplier.select(
        F.lit("SUPPLIERS").alias("sheet"), F.col("s_suppkey").alias("row_pos"),
        F.col("s_name").alias("text"), F.lit(7).alias("p_size"),
    )
    return a.unionByName(b)


SHEETS_SQL = """sheets as (select p_type sheet, p_partkey row_pos, p_brand || ' ' || p_name || ' x' || p_brand || ' A BAD' || p_size as text, p_size from part
  union all select 'SUPPLIERS', s_suppkey, s_name, 7 from supplier)"""


@check(
    "sheet_lookup",
    f"""with {TRIMMED_SQL}, {SHEETS_SQL} select s.sheet, s.row_pos, len(p.pairs)::int n_pairs
        from sheets s left join pairs p using (sheet)""",
)
def sheet_lookup(spark, sf):
    codes = ab.first_descriptions(trimmed(spark, sf))
    looked = ab.sheet_lookup(sheet_items(spark, sf), codes, sheet="sheet", spread_by="row_pos")
    return looked.select("sheet", "row_pos", "n_pairs")


UNMATCHED_SQL = f"""with {TRIMMED_SQL}, {SHEETS_SQL} select sheet from pairs
    where sheet not in (select sheet from sheets)"""


@check("unmatched_sheets", UNMATCHED_SQL)
def unmatched_sheets(spark, sf):
    return ab.unmatched_sheets(sheet_items(spark, sf), ab.first_descriptions(trimmed(spark, sf)), sheet="sheet")


# Without lookaround, neighbours are captured; applying twice catches touching codes.
ESCAPED = r"regexp_escape(p.code)"
ONE = r"regexp_replace({0}, '(^|[^A-Za-z0-9_])' || " + ESCAPED + r" || '($|[^A-Za-z0-9_])', '\1' || p.descr || '\2', 'g')"
REPLACED_SQL = f"""{TRIMMED_SQL}, {SHEETS_SQL},
replaced as (select s.sheet, s.row_pos, s.p_size, case when q.pairs is null then s.text else
    list_reduce(q.pairs, lambda a, p: {{'code': a.code, 'descr': {ONE.format(ONE.format('a.descr'))}}},
      {{'code': '', 'descr': s.text}}).descr end as text
  from sheets s left join pairs q using (sheet))"""


@check("replace_abbreviations", f"with {REPLACED_SQL} select sheet, row_pos, text from replaced")
def replace_abbreviations(spark, sf):
    items = sheet_items(spark, sf).withColumn("id", F.struct("sheet", "row_pos"))
    codes = ab.first_descriptions(trimmed(spark, sf))
    found = ab.matched_pairs(items, codes, row="id", texts=["text"])
    looked = items.join(found, "id", "left")
    return looked.select("sheet", "row_pos", ab.replace_abbreviations("text", F.col("pairs")["text"]).alias("text"))


NUMBER_SQL = """numbers as (select distinct p_type sheet, p_size::varchar code, p_size || ' units' descr from part),
cells as (select p_partkey row_pos, p_type sheet, p_size, p_retailprice from part)"""


def number_codes(spark, sf):
    part = fx.table(spark, sf, "part")
    codes = part.groupBy("p_type", "p_size").agg(F.min("p_partkey").alias("row_pos"))
    return codes.select(
        F.col("p_type").alias("Sheet"), F.col("p_size").alias("Code"),
        F.concat(F.col("p_size").cast("string"), F.lit(" units")).alias("Description"), "row_pos",
    )


@check(
    "replace_numeric_cell",
    f"""with {NUMBER_SQL} select c.row_pos, coalesce(a.descr, c.p_size::varchar) size_text,
        coalesce(b.descr, case when p_retailprice = floor(p_retailprice) then p_retailprice::bigint::varchar
           else p_retailprice::varchar end) price_text from cells c
        left join numbers a on a.sheet = c.sheet and a.code = c.p_size::varchar
        left join numbers b on b.sheet = c.sheet and b.code = case when p_retailprice = floor(p_retailprice)
           then p_retailprice::bigint::varchar else p_retailprice::varchar end""",
)
def replace_numeric_cell(spark, sf):
    codes = ab.first_descriptions(ab.trim_fields(number_codes(spark, sf)))
    cells = fx.table(spark, sf, "part").select(
        F.col("p_partkey").alias("row_pos"), F.col("p_type").alias("sheet"), "p_size", "p_retailprice"
    )
    found = ab.matched_pairs(cells, codes, row="row_pos", numbers=["p_size", "p_retailprice"])
    looked = cells.join(found, "row_pos", "left")
    return looked.select(
        "row_pos", ab.replace_numeric_cell("p_size", "int", F.col("pairs")["p_size"]).alias("size_text"),
        ab.replace_numeric_cell("p_retailprice", "double", F.col("pairs")["p_retailprice"]).alias("price_text"),
    )


@check("replace_in_sheets", f"with {REPLACED_SQL} select sheet, row_pos, text, p_size::varchar p_size from replaced")
def replace_in_sheets(spark, sf):
    return ab.replace_in_sheets(sheet_items(spark, sf), code_table(spark, sf))[0]


@check(
    "replace_in_sheets_warnings",
    f"""with {TRIMMED_SQL}, {SHEETS_SQL} select 'ambiguous code' warning, sheet, code from trimmed
        group by 2, 3 having count(distinct descr) > 1
        union all select 'sheet not found', sheet, null from pairs where sheet not in
          (select sheet from sheets)""",
)
def replace_in_sheets_warnings(spark, sf):
    return ab.replace_in_sheets(sheet_items(spark, sf), code_table(spark, sf))[1]


# --- enrichment: two source sheets and a target with gaps

SOURCES_SQL = """src as (
  select 0 sheet_pos, p_partkey row_pos, (p_partkey - p_partkey % 2)::varchar id, p_brand tc, null coat from part
  union all select 1, p_partkey, (p_partkey // 3 * 3)::varchar, null, case when p_size < 10 then '' else p_type end from part),
look as (select id, arg_min(tc, sheet_pos*1000000000+row_pos) filter (tc is not null and tc <> '') tc,
  arg_min(coat, sheet_pos*1000000000+row_pos) filter (coat is not null and coat <> '') coat from src group by 1),
tgt as (select p_partkey row_pos, p_partkey no, case p_partkey % 4 when 0 then 'x' when 1 then '' end coat, p_name from part)"""
COLUMNS = ("Type Code", "Coating")


def source_sheets(spark, sf):
    k, part = F.col("p_partkey"), fx.table(spark, sf, "part")
    a = part.select(k.alias("row_pos"), (k - k % 2).alias("Id"), F.col("p_brand").alias("Type Code"))
    b = part.select(
        k.alias("row_pos"), (F.floor(k / 3) * 3).alias("Id"),
        F.when(F.col("p_size") < 10, "").otherwise(F.col("p_type")).alias("Coating"),
    )
    return rows.union_sheets({"A": a, "B": b}, key="Id")


def target(spark, sf):
    k, part = F.col("p_partkey"), fx.table(spark, sf, "part")
    return part.select(
        k.alias("row_pos"), k.alias("No."), F.when(k % 4 == 0, "x").when(k % 4 == 1, "").alias("Coating"), "p_name"
    )


def lookup(spark, sf):
    return enrich.enrichment_lookup(source_sheets(spark, sf), id="Id", columns=COLUMNS)


@check(
    "first_non_empty",
    f"""with {SOURCES_SQL} select id lookup_key, tc "Type Code", coat "Coating" from look""",
)
def first_non_empty(spark, sf):
    return lookup(spark, sf)


FILLED_SQL = """with {0} select row_pos, no "No.", {1} "Coating", p_name, l.tc "Type Code"
    from tgt t left join look l on l.id = t.no::varchar"""


@check("enrich_fill", FILLED_SQL.format(SOURCES_SQL, "coalesce(t.coat, l.coat)"))
def enrich_fill(spark, sf):
    return enrich.enrich_items(target(spark, sf), lookup(spark, sf), key="No.", columns=COLUMNS)


@check("enrich_overwrite", FILLED_SQL.format(SOURCES_SQL, "coalesce(l.coat, t.coat)"))
def enrich_overwrite(spark, sf):
    return enrich.enrich_items(target(spark, sf), lookup(spark, sf), key="No.", columns=COLUMNS, overwrite=True)


@check(
    "enrich_items",
    f"""with {SOURCES_SQL} select 'parts' sheet, row_pos, coalesce(t.coat, l.coat) coating, l.tc type_code
        from tgt t left join look l on l.id = t.no::varchar
        union all select 'unnumbered', row_pos, coat, null from tgt""",
)
def enrich_items(spark, sf):
    """Two target sheets; the one without the key column stays as it is."""
    parts = target(spark, sf)
    sheets = enrich.enrich_sheets(
        {"parts": parts, "unnumbered": parts.drop("No.")}, lookup(spark, sf), key="No.", columns=COLUMNS
    )
    code = {n: F.col("Type Code") if "Type Code" in df.columns else F.lit(None).cast("string") for n, df in sheets.items()}
    rows = [df.select(F.lit(n).alias("sheet"), "row_pos", F.col("Coating").alias("coating"), code[n].alias("type_code")) for n, df in sheets.items()]
    return rows[0].unionByName(rows[1])


@check(
    "filter_by_mapping",
    """with listed as (select nullif(o_custkey, 1) id from orders),
       rows as (select c_custkey, nullif(c_custkey, 2) no from customer)
       select c_custkey, no from rows where no in (select id from listed where id is not null)
         or (no is null and exists (select 1 from listed where id is null))""",
)
def filter_by_mapping(spark, sf):
    listed = fx.table(spark, sf, "orders").select(F.nullif("o_custkey", F.lit(1)).alias("no."))
    customers = fx.table(spark, sf, "customer").select("c_custkey", F.nullif("c_custkey", F.lit(2)).alias("no"))
    return joins.filter_by_mapping(customers, listed, left="no", right="no.", spread_by="c_custkey")
