"""Query inputs derived from the given tables, always over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from classmap.operators.hierarchy import build_hierarchy
from classmap.plans.assign import assign_classes_fallback
from classmap.plans.settle import lasting, settle


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def items(spark, sf_dir) -> DataFrame:
    """Parts and suppliers as one item table; supplier names match no class."""
    part, supplier = table(spark, sf_dir, "part"), table(spark, sf_dir, "supplier")
    parts = part.select(
        (F.col("p_partkey") * 2).alias("item_id"), F.col("p_name").alias("item_name"),
        F.col("p_brand").alias("Brand"), F.col("p_type").alias("Type"),
        F.col("p_size").alias("Size"),
    )
    suppliers = supplier.select(
        (F.col("s_suppkey") * 2 + 1).alias("item_id"), F.col("s_name").alias("item_name"),
        F.lit(None).cast("string").alias("Brand"), F.lit(" ").alias("Type"),
        F.lit(None).cast("int").alias("Size"),
    )
    return parts.unionByName(suppliers)


def vectors(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding")


def item_emb(spark, sf_dir) -> DataFrame:
    """A vector for every item: vectors are given out in turn, by a join that sends neither
    side to the driver."""
    given = vectors(spark, sf_dir).hint("merge")
    turn = F.pmod("item_id", F.lit(given.count())).alias("turn")
    ids = items(spark, sf_dir).select("item_id", turn)
    return ids.join(given, ids["turn"] == given["id"]).select(F.col("item_id").alias("id"), "embedding")


def vector_text(embedding) -> Column:
    """A whole vector as text, in millionths."""
    whole = F.transform(embedding, lambda x: F.round(x.cast("double") * 1_000_000).cast("bigint").cast("string"))
    return F.array_join(whole, ",").alias("vector")


VECTOR_SQL = "array_to_string(list_transform(embedding, lambda x: round(x::double * 1000000)::bigint), ',') vector"


def class_sheet(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("row_pos"), F.col("p_type").alias("Level 1"),
        F.col("p_brand").alias("Level 2"), F.col("p_name").alias("Level 3"),
    )


_KEPT: dict = {}


def once(spark, sf_dir, name: str, build) -> DataFrame:
    """An input shared by many queries, written once per application and folder."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _KEPT:
        with lasting():
            _KEPT[key] = settle(build(), name)
    return _KEPT[key]


def classes(spark, sf_dir) -> DataFrame:
    return once(spark, sf_dir, "class_nodes", lambda: build_hierarchy(class_sheet(spark, sf_dir)))


def class_emb(spark, sf_dir) -> DataFrame:
    """Vectors of classes; late classes fall outside the vector table and have none."""

    def build():
        ids = classes(spark, sf_dir).select(F.col("id").alias("class"), (F.col("id") * 7).alias("id"))
        joined = ids.join(vectors(spark, sf_dir), "id")
        return joined.select(F.col("class").alias("id"), "embedding")

    return once(spark, sf_dir, "class_vectors", build)


NAMES = {"item_id": "item_id", "item_name": "item_name"}


def assigned(spark, sf_dir) -> DataFrame:
    """The assignment at 0.85 with every item ranked and five candidates kept."""
    return once(
        spark, sf_dir, "assigned",
        lambda: assign_classes_fallback(
            items(spark, sf_dir), classes(spark, sf_dir), item_emb(spark, sf_dir),
            class_emb(spark, sf_dir), threshold=0.85, keep_top_k=5, **NAMES,
        ),
    )


# DuckDB counterparts, as common table expressions.
ITEMS_SQL = """
items as (
  select p_partkey*2 item_id, p_name item_name, p_brand "Brand", p_type "Type", p_size "Size" from part
  union all
  select s_suppkey*2+1, s_name, null, ' ', null from supplier),
with_vec as (select i.*, e.embedding from items i join embeddings e
  on e.vec_id = i.item_id % (select count(*) from embeddings))"""

NODES_SQL = """
lv as (
  select p_partkey pos, 1 lvl, p_type nm, null::varchar pn from part
  union all select p_partkey, 2, p_brand, p_type from part
  union all select p_partkey, 3, p_name, p_brand from part),
fs as (select lvl, nm, min(pos) fp, arg_min({'pn': pn}, pos).pn pn from lv group by 1, 2),
nn as (select row_number() over (order by fp, lvl) id, nm as name, lvl as level, pn from fs),
np as (select a.id, a.name, a.level, 'Level ' || a.level level_label, b.id parent_id
       from nn a left join nn b on b.level = a.level-1 and b.name = a.pn),
nodes as (select *, id not in (select parent_id from np where parent_id is not null) lowest_level_class from np),
class_emb as (select n.id, e.embedding from nodes n join embeddings e on e.vec_id = n.id*7),
leaf_emb as (select n.id, n.name, c.embedding from nodes n join class_emb c using (id) where n.lowest_level_class)"""

CLOSURE_SQL = """
clo(anc_id, leaf_id, stop) as (
  select id, id, lowest_level_class from nodes
  union all
  select c.anc_id, n.id, n.lowest_level_class from clo c join nodes n on n.parent_id = c.leaf_id where not c.stop),
closure as (select distinct anc_id, leaf_id from clo where stop)"""


def fuzzy_sql(items_from: str, classes_from: str) -> str:
    """CTEs ending in ``scores(a, b, pr, tr)`` for distinct lower-cased name pairs."""
    return r"""
nm as (select distinct lower(i.item_name) a, lower(c.name) b from %s i, %s c),
o as (select a,b, case when len(a)<=len(b) then a else b end s, case when len(a)<=len(b) then b else a end l from nm),
o2 as (select a,b,s,l from o union all select a,b,l,s from o where len(a)=len(b)),
win as (select distinct a,b,s, substr(l, greatest(k,1)::int, (least(k+len(s)-1,len(l))-greatest(k,1)+1)::int) w
        from (select *, unnest(range(2-len(s), len(l)+1)) k from o2)),
toks as (select a,b, list_distinct(list_filter(string_split_regex(a,'\s+'),lambda t:t<>'')) ta, list_distinct(list_filter(string_split_regex(b,'\s+'),lambda t:t<>'')) tb from nm),
sp as (select a,b, array_to_string(list_sort(list_filter(ta,lambda t:not list_contains(tb,t))),' ') x, array_to_string(list_sort(list_filter(tb,lambda t:not list_contains(ta,t))),' ') y,
       len(array_to_string(list_sort(list_filter(ta,lambda t:list_contains(tb,t))),' ')) s, len(ta) na, len(tb) nb from toks),
prs as (select distinct s p,w q from win union select distinct x,y from sp where x<>'' and y<>''),
d(p,q,i,rw) as (
 select p,q,0, list_transform(range(0,len(q)+1), lambda x: 0::bigint) from prs
 union all
 select d.p,d.q,i+1, list_reduce(list_transform(range(1,len(q)+1), lambda j: [j]::bigint[]),
   lambda acc,jj: acc || [case when p[i+1]=q[jj[1]] then rw[jj[1]]+1 else greatest(rw[jj[1]+1], acc[len(acc)]) end], [0]::bigint[])
 from d where i<len(p)),
ll as (select p,q,rw[len(rw)] lcs from d where i=len(p)),
pa as (select a,b,max(2.0::double*lcs/(len(s)+len(w))) pr from win join ll on p=s and q=w group by 1,2),
ts as (select a,b, case when na=0 or nb=0 then 0.0::double when s>0 and (x='' or y='') then 1.0::double
   else (with_r) end tr from (select sp.*,
     case when s=0 then 1.0::double-(len(x)+len(y)-2*coalesce(lcs,0))::double/(len(x)+len(y))
     else greatest(1.0::double-(len(x)+len(y)-2*coalesce(lcs,0))::double/(s+1+len(x)+s+1+len(y)), 1.0::double-(1+len(x))::double/(s+s+1+len(x)), 1.0::double-(1+len(y))::double/(s+s+1+len(y))) end with_r
     from sp left join ll on p=x and q=y)),
scores as (select pa.a, pa.b, pa.pr, ts.tr, greatest(pa.pr, ts.tr) sc from pa join ts using (a,b))""" % (items_from, classes_from)


def assign_sql(threshold: float, policy: str) -> str:
    """CTEs ending in ``ranked`` and ``per_item`` for the assignment fixture."""
    return f"""
hits as (select i.item_id, n.id class_id, n.name, n.level from with_vec i join nodes n on true
         join scores s on s.a = lower(i.item_name) and s.b = lower(n.name) where s.sc >= {threshold}),
cands as (select distinct h.item_id, c.leaf_id from hits h join closure c on c.anc_id = h.class_id
          join leaf_emb l on l.id = c.leaf_id),
per_item as (select i.item_id, i.item_name, coalesce(h.n, 0) n_hits, coalesce(c.n, 0)::int fuzzy_candidates_count,
    case when h.n is null then 'No fuzzy match' when h.n > 20 then h.nm || '; ...(+' || (h.n-20) || ' more)' else h.nm end fuzzy_candidate_names
  from with_vec i
  left join (select item_id, count(*) n, array_to_string(list_slice(list(name || ' (L' || level || ')' order by class_id), 1, 20), '; ') nm from hits group by 1) h using (item_id)
  left join (select item_id, count(*) n from cands group by 1) c using (item_id)),
wide as (select item_id from per_item where n_hits = 0 {"or fuzzy_candidates_count = 0" if policy == "all" else ""}),
pairs as (select item_id, leaf_id from cands union all select w.item_id, l.id from wide w, leaf_emb l),
sims as (select p.item_id, l.id class_id, l.name class_name,
    list_cosine_similarity(i.embedding::double[], l.embedding::double[]) sim
  from pairs p join with_vec i using (item_id) join leaf_emb l on l.id = p.leaf_id),
ranked as (select *, row_number() over (partition by item_id order by round(sim, 12) desc, class_id) rk from sims),
tops as (select item_id, {', '.join(f"max(case when rk={r} then {c} end) top_{r}_{a}" for r in (1,2,3) for c, a in (("class_id","class_id"),("class_name","class_name"),("round(sim,4)","similarity")))}
  from ranked group by 1)"""
