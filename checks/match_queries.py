"""Class trees, fuzzy join, cosine ranking, assignment, validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.registry import check
from checks.table_queries import (
    LEVELS,
    RAGGED_CELLS_SQL,
    RAGGED_NODES_SQL,
    RAGGED_SQL,
    ragged_sheet,
)
from classmap.functions import fuzzy, text, vector
from classmap.operators import hierarchy, matching, ordering, profile, rows, similarity, validation
from classmap.operators.joins import intersect_ids, item_embedding_join
from classmap.plans import assign

BASE = f"with recursive {fx.ITEMS_SQL}, {fx.NODES_SQL}, {fx.CLOSURE_SQL}"
SCORED = f"{BASE}, {fx.fuzzy_sql('items', 'nodes')}"


def assign_base(threshold: float, policy: str) -> str:
    scored = fx.fuzzy_sql("with_vec", "nodes")
    return f"{BASE}, {scored}, {fx.assign_sql(threshold, policy)}"


TOP_COLUMNS = ", ".join(
    f"top_{r}_{c}" for r in (1, 2, 3) for c in ("class_id", "class_name", "similarity")
)


def side(spark, sf):
    return fx.once(spark, sf, "class_side", lambda: matching.class_table(fx.classes(spark, sf)))


def leaves(spark, sf):
    return fx.once(
        spark, sf, "leaf_side",
        lambda: similarity.class_embedding_join(side(spark, sf), fx.class_emb(spark, sf)),
    )


def with_vec(spark, sf):
    return item_embedding_join(fx.items(spark, sf), fx.item_emb(spark, sf), id="item_id")


# --- class tree

CELLS = f"with {RAGGED_SQL}, {RAGGED_CELLS_SQL}"


def ragged_cells(spark, sf):
    filled = ordering.forward_fill(ragged_sheet(spark, sf), LEVELS)
    return hierarchy.previous_level_key(rows.drop_all_null_rows(filled, LEVELS), LEVELS)


@check(
    "previous_level_key",
    f"""{CELLS} select row_pos, lvl "level", 'Level '||lvl level_label, nm "name",
        plvl parent_level, pnm parent_name from y""",
)
def previous_level_key(spark, sf):
    return ragged_cells(spark, sf)


@check("assign_node_ids", f'{CELLS}, {RAGGED_NODES_SQL} select id, "name", "level" from n')
def assign_node_ids(spark, sf):
    return hierarchy.assign_node_ids(ragged_cells(spark, sf)).select("id", "name", "level")


@check("link_parents", f"{CELLS}, {RAGGED_NODES_SQL} select * from nd")
def link_parents(spark, sf):
    return hierarchy.link_parents(hierarchy.assign_node_ids(ragged_cells(spark, sf)))


@check(
    "mark_leaf_nodes",
    f"with {fx.NODES_SQL} select id, lowest_level_class from nodes",
)
def mark_leaf_nodes(spark, sf):
    nodes = fx.classes(spark, sf).drop("lowest_level_class")
    return hierarchy.mark_leaf_nodes(nodes).select("id", "lowest_level_class")


@check(
    "build_hierarchy",
    f"""{CELLS}, {RAGGED_NODES_SQL} select *, id not in (select parent_id from nd where parent_id is not null)
        lowest_level_class from nd""",
)
def build_hierarchy(spark, sf):
    return hierarchy.build_hierarchy(ragged_sheet(spark, sf))


@check("hierarchy_closure", f"with recursive {fx.NODES_SQL}, {fx.CLOSURE_SQL} select * from closure")
def hierarchy_closure(spark, sf):
    return hierarchy.hierarchy_closure(fx.classes(spark, sf))


# --- fuzzy


@check(
    "fuzzy_join",
    f"""{SCORED} select i.item_id, n.id class_id, round(s.sc, 9) score from items i
        join scores s on s.a = lower(i.item_name) join nodes n on s.b = lower(n.name) where s.sc >= 0.6""",
)
def fuzzy_join(spark, sf):
    joined = matching.fuzzy_join(
        fx.items(spark, sf), fx.classes(spark, sf), item_id="item_id", item_name="item_name", threshold=0.6
    )
    return joined.withColumn("score", F.round("score", 9))


@check(
    "fuzzy_join_strict",
    f"""{SCORED} select i.item_id, n.id class_id, round(s.sc, 9) score from items i
        join scores s on s.a = lower(i.item_name) join nodes n on s.b = lower(n.name) where s.sc >= 0.85""",
)
def fuzzy_join_strict(spark, sf):
    joined = matching.fuzzy_join(
        fx.items(spark, sf), fx.classes(spark, sf), item_id="item_id", item_name="item_name", threshold=0.85
    )
    return joined.withColumn("score", F.round("score", 9))


LONG_SQL = "items as (select p_partkey item_id, p_name||' '||p_brand||' '||p_type item_name from part)"


@check(
    "fuzzy_join_long_names",
    f"""with recursive {LONG_SQL}, {fx.NODES_SQL}, {fx.fuzzy_sql('items', 'nodes')}
        select i.item_id, n.id class_id, round(s.sc, 9) score from items i
        join scores s on s.a = lower(i.item_name) join nodes n on s.b = lower(n.name) where s.sc >= 0.85""",
)
def fuzzy_join_long_names(spark, sf):
    name = F.concat_ws(" ", "p_name", "p_brand", "p_type")
    long = fx.table(spark, sf, "part").select(F.col("p_partkey").alias("item_id"), name.alias("item_name"))
    joined = matching.fuzzy_join(
        long, fx.classes(spark, sf), item_id="item_id", item_name="item_name", threshold=0.85
    )
    return joined.withColumn("score", F.round("score", 9))


# Scalar scores are shown on pairs that an equality brings together: a part's own words.
PAIR_SQL = """with recursive items as (select p_partkey, p_name||' '||p_type item_name, p_type||' '||p_brand other from part),
one as (select distinct item_name, other from items)"""
PAIR_SCORES = PAIR_SQL + ", " + fx.fuzzy_sql("one", "(select other as name from one)").replace(
    "from one i, (select other as name from one) c", "from one i join (select item_name own, other as name from one) c on c.own = i.item_name"
)


def pair_query(spark, sf, fn, fold: bool):
    part = fx.table(spark, sf, "part")
    a = F.concat_ws(" ", "p_name", "p_type")
    b = F.concat_ws(" ", "p_type", "p_brand")
    a, b = (F.lower(a), F.lower(b)) if fold else (a, b)
    return part.select("p_partkey", F.round(fn(a, b), 9).alias("score"))


def pair_sql(value: str) -> str:
    return f"""{PAIR_SCORES} select i.p_partkey, round(s.{value}, 9) score from items i
        join scores s on s.a = lower(i.item_name) and s.b = lower(i.other)"""


@check("fuzzy_score", pair_sql("sc"))
def fuzzy_score(spark, sf):
    return pair_query(spark, sf, fuzzy.fuzzy_score, False)


@check("partial_ratio", pair_sql("pr"))
def partial_ratio(spark, sf):
    return pair_query(spark, sf, fuzzy.partial_ratio, True)


@check("token_set_ratio", pair_sql("tr"))
def token_set_ratio(spark, sf):
    return pair_query(spark, sf, fuzzy.token_set_ratio, True)


@check(
    "hit_names",
    f"{assign_base(0.6, 'none')} select item_id, fuzzy_candidate_names from per_item",
)
def hit_names(spark, sf):
    hits = matching.fuzzy_hits(
        with_vec(spark, sf).select("item_id", "item_name"), side(spark, sf), threshold=0.6, **fx.NAMES
    )
    return hits.select("item_id", matching.hit_names().alias("fuzzy_candidate_names"))


@check("level_label", f"""with {fx.NODES_SQL} select id, "name"||' (L'||"level"||')' label, "name" bare from nodes""")
def level_label(spark, sf):
    return fx.classes(spark, sf).select(
        "id", text.level_label("name", "level").alias("label"), text.level_label("name").alias("bare")
    )


@check(
    "group_counts",
    f"""{assign_base(0.6, 'none')} select case when n_hits > 0 then 'fuzzy' else 'no fuzzy match' end branch,
        count(*) "items" from per_item group by 1""",
)
def group_counts(spark, sf):
    hits = matching.fuzzy_hits(
        with_vec(spark, sf).select("item_id", "item_name"), side(spark, sf), threshold=0.6, **fx.NAMES
    )
    return profile.group_counts(hits)


# --- joins of the assignment


@check("item_embedding_join", f"with {fx.ITEMS_SQL} select item_id, item_name, {fx.VECTOR_SQL} from with_vec")
def item_embedding_join_(spark, sf):
    return with_vec(spark, sf).select("item_id", "item_name", fx.vector_text("embedding"))


@check("intersect_ids", f"with {fx.ITEMS_SQL} select item_id from with_vec")
def intersect_ids_(spark, sf):
    return intersect_ids(fx.items(spark, sf), fx.item_emb(spark, sf), id="item_id").select("item_id")


@check(
    "class_embedding_join",
    f"""with {fx.NODES_SQL} select row_number() over (order by id) - 1 leaf_pos, id - 1 class_pos,
        id class_id, "name" class_name from leaf_emb""",
)
def class_embedding_join(spark, sf):
    joined = similarity.class_embedding_join(side(spark, sf), fx.class_emb(spark, sf))
    return joined.select("leaf_pos", "class_pos", "class_id", "class_name")


def candidates(spark, sf):
    def build():
        pairs = matching.fuzzy_join(
            with_vec(spark, sf), fx.classes(spark, sf), threshold=0.85, **fx.NAMES
        )
        closure = hierarchy.hierarchy_closure(fx.classes(spark, sf))
        return matching.expand_candidates(pairs, closure, leaves(spark, sf), item_id="item_id")

    return fx.once(spark, sf, "candidates", build)


CANDS = assign_base(0.85, "none")
FALLBACK = assign_base(0.85, "all")


@check("expand_candidates", f"{CANDS} select item_id, leaf_id class_id from cands")
def expand_candidates(spark, sf):
    return candidates(spark, sf)


@check("distinct_candidates", f"{CANDS} select distinct item_id, leaf_id class_id from cands")
def distinct_candidates(spark, sf):
    return matching.distinct_candidates(candidates(spark, sf), item_id="item_id")


@check("candidate_count", f"{CANDS} select item_id, count(*) fuzzy_candidates_count from cands group by 1")
def candidate_count(spark, sf):
    return matching.candidate_count(candidates(spark, sf), item_id="item_id")


@check(
    "cosine_candidates",
    f"""{CANDS} select s.item_id, s.class_id, round(s.sim, 4) similarity from sims s
        join cands c on c.item_id = s.item_id and c.leaf_id = s.class_id""",
)
def cosine_candidates(spark, sf):
    scored = similarity.cosine_candidates(
        candidates(spark, sf), with_vec(spark, sf), leaves(spark, sf), item_id="item_id"
    )
    return scored.withColumn("similarity", F.round("similarity", 4))


ALL_SQL = f"""with {fx.ITEMS_SQL}, {fx.NODES_SQL},
sims as (select i.item_id, l.id class_id, l.name class_name,
  list_cosine_similarity(i.embedding::double[], l.embedding::double[]) sim from with_vec i, leaf_emb l),
ranked as (select *, row_number() over (partition by item_id order by round(sim, 12) desc, class_id) rk from sims)"""


def all_ranked(spark, sf, k):
    return similarity.cosine_top_k(
        with_vec(spark, sf).select("item_id", "embedding"), leaves(spark, sf), k=k, id="item_id"
    )


@check(
    "cosine_all",
    f"""{FALLBACK} select item_id, rk::int rank, class_id, class_name, round(sim, 4) similarity
        from ranked join per_item using (item_id) where n_hits = 0 and rk <= 3""",
)
def cosine_all(spark, sf):
    """The best three of all leaves for the items whose name matches no class."""
    found = matching.fuzzy_hits(with_vec(spark, sf), side(spark, sf), threshold=0.85, **fx.NAMES)
    unmatched = found.where("n_hits is null").select("item_id", "embedding")
    ranked = similarity.cosine_top_k(unmatched, leaves(spark, sf), k=3, id="item_id")
    return similarity.top_n_classes(ranked, 3, id="item_id")


@check("cosine_similarity", f"{ALL_SQL} select item_id, class_id, round(sim, 4) similarity from ranked where rk = 1")
def cosine_similarity(spark, sf):
    best = similarity.top_n_classes(all_ranked(spark, sf, 1), 1, id="item_id").select("item_id", "class_id")
    joined = best.join(with_vec(spark, sf).select("item_id", F.col("embedding").alias("a")), "item_id").join(
        leaves(spark, sf).select("class_id", F.col("embedding").alias("b")), "class_id"
    )
    return joined.select(
        "item_id", "class_id", text.round_similarity(vector.cosine_similarity("a", "b")).alias("similarity")
    )


@check(
    "top_n_classes",
    f"""{ALL_SQL} select item_id, rk::int rank, class_id, class_name, round(sim, 4) similarity
        from ranked where rk <= 3""",
)
def top_n_classes(spark, sf):
    return similarity.top_n_classes(all_ranked(spark, sf, 3), 3, id="item_id")


@check(
    "top_k_candidates",
    f"{ALL_SQL} select item_id, string_agg(class_id::varchar, ',' order by rk) class_ids from ranked where rk <= 5 group by 1",
)
def top_k_candidates(spark, sf):
    return all_ranked(spark, sf, 5).select("item_id", F.array_join(F.col("topk.class_id").cast("array<string>"), ",").alias("class_ids"))


@check(
    "pivot_top_n",
    f"""{ALL_SQL} select item_id, max(case when rk=1 then class_id end) top_1_class_id,
        max(case when rk=1 then class_name end) top_1_class_name,
        max(case when rk=1 then round(sim, 4) end) top_1_similarity,
        max(case when rk=2 then class_id end) top_2_class_id,
        max(case when rk=2 then class_name end) top_2_class_name,
        max(case when rk=2 then round(sim, 4) end) top_2_similarity from ranked group by 1""",
)
def pivot_top_n(spark, sf):
    return similarity.pivot_top_n(all_ranked(spark, sf, 2), 2, keep=["item_id"])


@check(
    "margin",
    f"""{ALL_SQL} select item_id, round(max(case when rk=1 then sim end) - max(case when rk=2 then sim end), 6) margin
        from ranked group by 1""",
)
def margin(spark, sf):
    return all_ranked(spark, sf, 2).select("item_id", F.round(similarity.margin(), 6).alias("margin"))


@check(
    "margin_gate",
    f"""{ALL_SQL} select item_id from ranked group by 1
        having coalesce(max(case when rk=1 then sim end) - max(case when rk=2 then sim end) < 0.05, true)""",
)
def margin_gate(spark, sf):
    return all_ranked(spark, sf, 2).where(similarity.margin_gate("topk", 0.05)).select("item_id")


@check(
    "round_similarity",
    f"{ALL_SQL} select item_id, round(sim, 4) similarity from ranked where rk = 1",
)
def round_similarity(spark, sf):
    best = all_ranked(spark, sf, 1).select("item_id", F.get("topk", F.lit(0))["sim"].alias("s"))
    return best.select("item_id", text.round_similarity("s").alias("similarity"))


# --- end to end


def run_assign(spark, sf, **options):
    return assign.assign_classes(
        fx.items(spark, sf), fx.classes(spark, sf), fx.item_emb(spark, sf), fx.class_emb(spark, sf),
        **fx.NAMES, **options,
    )


def assign_select(threshold: float, policy: str) -> str:
    return f"""{assign_base(threshold, policy)}
        select p.item_id, p.item_name, fuzzy_candidates_count, fuzzy_candidate_names, {TOP_COLUMNS}
        from per_item p left join tops using (item_id)"""


@check("assign_classes", assign_select(0.6, "none"))
def assign_classes(spark, sf):
    return run_assign(spark, sf, threshold=0.6)


TEXT_ID = "'C-' || lpad({}::varchar, 6, '0')"


def text_id(c: str):
    return F.format_string("C-%06d", F.col(c)).alias(c)


@check(
    "assign_classes_text_ids",
    "select * replace ("
    + ", ".join(f"{TEXT_ID.format(c)} as {c}" for c in (f"top_{r}_class_id" for r in (1, 2, 3)))
    + f") from ({assign_select(0.85, 'none')})",
)
def assign_classes_text_ids(spark, sf):
    """Class ids may be texts; ties then follow their order."""
    nodes, vectors = fx.classes(spark, sf), fx.class_emb(spark, sf)
    parent = F.when(F.col("parent_id").isNotNull(), text_id("parent_id")).alias("parent_id")
    named = nodes.select(text_id("id"), "name", "level", "level_label", parent, "lowest_level_class")
    return assign.assign_classes(
        fx.items(spark, sf), named, fx.item_emb(spark, sf), vectors.select(text_id("id"), "embedding"),
        threshold=0.85, **fx.NAMES,
    )


@check("assign_classes_strict", assign_select(0.85, "none"))
def assign_classes_strict(spark, sf):
    return run_assign(spark, sf, threshold=0.85)


@check("assign_classes_fallback", assign_select(0.85, "all"))
def assign_classes_fallback(spark, sf):
    return run_assign(spark, sf, threshold=0.85, on_no_candidates="all")



@check(
    "attach_items",
    f"""{FALLBACK} select p.item_id, p.item_name, i.item_name item_item_name, i."Brand", i."Size", t.top_1_class_id
        from per_item p join items i using (item_id) left join tops t using (item_id)""",
)
def attach_items(spark, sf):
    result = fx.assigned(spark, sf).select("item_id", "item_name", "top_1_class_id")
    items = fx.items(spark, sf).drop("Type")
    return assign.attach_items(result, items, **fx.NAMES)


@check(
    "attach_top1_class",
    f"""{FALLBACK} select p.item_id, t.top_1_class_id, n.id class_id, n.name class_name, n.level::int class_level
        from per_item p left join tops t using (item_id) left join nodes n on n.id = t.top_1_class_id""",
)
def attach_top1_class(spark, sf):
    result = fx.assigned(spark, sf).select("item_id", "top_1_class_id")
    return assign.attach_top1_class(result, fx.classes(spark, sf).select("id", "name", "level"))


@check(
    "assign_and_attach",
    f"""{FALLBACK} select p.item_id, p.item_name, i.item_name item_item_name, i."Brand", t.top_1_class_id,
        t.top_1_similarity, n.name class_name, n.parent_id class_parent_id
        from per_item p join items i using (item_id) left join tops t using (item_id)
        left join nodes n on n.id = t.top_1_class_id""",
)
def assign_and_attach(spark, sf):
    attached = assign.assign_and_attach(
        fx.items(spark, sf), fx.classes(spark, sf), fx.item_emb(spark, sf), fx.class_emb(spark, sf),
        **fx.NAMES, threshold=0.85, on_no_candidates="all",
    )
    return attached.select(
        "item_id", "item_name", "item_item_name", "Brand", "top_1_class_id", "top_1_similarity",
        "class_name", "class_parent_id",
    )


# --- validation: unmapped, empty and known mappings by item

MAPPING_SQL = """case item_id % 10 when 0 then null when 2 then '' when 4 then top_2_class_name
    when 6 then top_3_class_name when 8 then 'something else' else top_1_class_name end"""
BUCKET_SQL = f"""{FALLBACK}, mapped as (select p.item_id, t.*, {MAPPING_SQL.replace('item_id', 'p.item_id')} mapping
    from per_item p left join tops t using (item_id)),
bucketed as (select *, case when coalesce(mapping, '') = '' then 'no_mapping'
    when top_1_class_name = mapping then 'top1' when top_2_class_name = mapping then 'top2'
    when top_3_class_name = mapping then 'top3' else 'mismatch' end match_bucket from mapped)"""


def mapped(spark, sf):
    return fx.assigned(spark, sf).withColumn("mapping", F.expr(MAPPING_SQL))


@check(
    "match_bucket",
    f"""{BUCKET_SQL} select item_id, mapping, match_bucket, case match_bucket when 'top1' then 'C6EFCE'
        when 'top2' then 'FFEB9C' when 'top3' then 'F8CBAD' when 'mismatch' then 'FFC7CE' end match_colour
        from bucketed""",
)
def match_bucket(spark, sf):
    return validation.match_bucket(mapped(spark, sf), mapping="mapping").select(
        "item_id", "mapping", "match_bucket", "match_colour"
    )


COUNTS_SQL = f"""{BUCKET_SQL}, counts as (select count(*) total, count(*) filter (match_bucket <> 'no_mapping') mapped,
    count(*) filter (match_bucket = 'top1') t1, count(*) filter (match_bucket = 'top2') t2,
    count(*) filter (match_bucket = 'top3') t3 from bucketed)"""


@check(
    "validation_counts",
    f"""{COUNTS_SQL} select total, mapped, t1 top1, t2 top2, t3 top3, round(t1/mapped, 9) top1_share,
        round((t1+t2+t3)/mapped, 9) match_share, round(1-(t1+t2+t3)/mapped, 9) false_share from counts""",
)
def validation_counts(spark, sf):
    counts = validation.validation_counts(validation.match_bucket(mapped(spark, sf), mapping="mapping"))
    return counts.select(
        "total", "mapped", "top1", "top2", "top3",
        *[F.round(c, 9).alias(c) for c in ("top1_share", "match_share", "false_share")],
    )


SUMMARY_SQL = f"""{COUNTS_SQL} select unnest([1,2,3,4,5,6,7]) "line",
    unnest(['Total Items','Total with Mapping','Top-1 Match %','Top-2 Match %','Top-3 Match %',
            'Total Match % (Top1-3)','False Match / No Match %']) metric,
    unnest([total::varchar, mapped::varchar, printf('%.2f%%', t1/mapped*100), printf('%.2f%%', t2/mapped*100),
            printf('%.2f%%', t3/mapped*100), printf('%.2f%%', (t1+t2+t3)/mapped*100),
            printf('%.2f%%', (1-(t1+t2+t3)/mapped)*100)]) "value" from counts"""


@check("validation_summary", SUMMARY_SQL)
def validation_summary(spark, sf):
    return validation.validation_summary(validation.match_bucket(mapped(spark, sf), mapping="mapping"))


@check(
    "validate_assignments",
    f"""select 'row' part, item_id::varchar name, match_bucket "value" from ({BUCKET_SQL} select * from bucketed)
        union all select 'summary', metric, "value" from ({SUMMARY_SQL})""",
)
def validate_assignments(spark, sf):
    """Both results: the rows with their buckets and the lines of the summary."""
    rows, summary = validation.validate_assignments(mapped(spark, sf), mapping="mapping")
    shown = rows.select(F.lit("row").alias("part"), F.col("item_id").cast("string").alias("name"), F.col("match_bucket").alias("value"))
    return shown.unionByName(summary.select(F.lit("summary").alias("part"), F.col("metric").alias("name"), "value"))


@check(
    "format_percent",
    "select p_partkey, printf('%.2f%%', p_size/51*100) percent from part",
)
def format_percent(spark, sf):
    part = fx.table(spark, sf, "part")
    return part.select("p_partkey", text.format_percent(F.col("p_size") / 51).alias("percent"))
