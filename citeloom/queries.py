"""Queries of the engine's operators over the tables of a folder, each with the SQL that states its result.

Orders stand for publications, their ordered parts for references, parts for cited works, customers and brands for
authors, documents and embeddings for texts and vectors.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.functions import columns as fc
from citeloom.functions import text as ft
from citeloom.operators import curation, density, filters, identities, layout, networks, providers, quality, reports, topics, viz
from citeloom.sources import corpus, sinks
from citeloom.streaming import arrivals

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with its SQL if there is one."""

    def add(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql:
            SQL[function.__name__] = sql
        return function

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def publications(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    item = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    lists = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["l_partkey"].cast("string")).alias("References"))
    rows = orders.join(customer, orders["o_custkey"] == customer["c_custkey"], "left").join(lists, orders["o_orderkey"] == lists["l_orderkey"], "left")
    return rows.select(
        F.col("o_orderkey").alias("ord"), F.col("o_orderkey").cast("string").alias("Bibcode"), F.year("o_orderdate").alias("Year"), F.array("c_name").alias("Author"),
        F.coalesce("References", F.array().cast("array<string>")).alias("References"), F.col("o_orderpriority").alias("Title"))


def cited_works(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("ord"), F.col("p_partkey").cast("string").alias("Bibcode"), (F.col("p_size") + 1950).alias("Year"), F.array("p_brand").alias("Author"),
        F.col("p_name").alias("Title"), F.col("p_type").alias("Journal"))


MENTIONS = """
pubs as (select o_orderkey as ord, o_orderkey::varchar as paper, year(o_orderdate)::int as year, c_name as author, o_orderpriority as title from orders left join customer on o_custkey = c_custkey),
m as (select o_orderkey as ord, o_orderkey::varchar as paper, year(o_orderdate)::int as year, l_partkey::varchar as ref, c_name as author,
  row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_quantity) - 1 as pos
  from lineitem join orders on l_orderkey = o_orderkey left join customer on o_custkey = c_custkey)
"""
CO_DETAIL = "co as (select a.year, a.ref as source, b.ref as target, a.paper from m a join m b on a.paper = b.paper and a.pos < b.pos and a.ref <> b.ref)"
CO_PAIRS = "cp as (select least(source, target) as lo, greatest(source, target) as hi, count(distinct paper) as n from co group by 1, 2)"
COUPLING = """
u as (select distinct paper, ord, year, ref from m),
bc as (select a.year, a.paper as source, b.paper as target, a.ref as shared_ref from u a join u b on a.ref = b.ref and a.ord < b.ord)"""


@query(f"with {MENTIONS} select paper as source, ref as target, pos::int as ref_index, year from m")
def direct_citations(spark, d):
    return networks.direct_citations(publications(spark, d))


@query(f"with {MENTIONS} select paper as source, ref as target, pos::int as ref_index, year from m where ref in (select ref from m group by ref having count(*) >= 35)")
def direct_citations_min_count(spark, d):
    return networks.direct_citations(publications(spark, d), min_count=35)


@query(f"with {MENTIONS} select paper as source, ref as target, min(year)::int as year, count(*) as weight from m group by 1, 2")
def direct_graph_edges(spark, d):
    return networks.direct_edges(publications(spark, d))


@query(f"with {MENTIONS}, {CO_DETAIL}, {CO_PAIRS} select year, source, target, paper as cocit_source from co join cp on lo = least(source, target) and hi = greatest(source, target) and n >= 2")
def co_citation_detail(spark, d):
    return networks.co_citations(publications(spark, d), min_count=2)


@query(f"with {MENTIONS}, {CO_DETAIL} select least(source, target) as source, greatest(source, target) as target, min(year)::int as year, count(*) as weight from co group by least(source, target), greatest(source, target)")
def cocitation_edges(spark, d):
    return networks.graph_edges(networks.co_citations(publications(spark, d)))


@query(f"with {MENTIONS}, {CO_DETAIL}, {CO_PAIRS} select lo as source, hi as target, min(year)::int as year, count(*) as weight from co join cp on lo = least(source, target) and hi = greatest(source, target) and n >= 2 group by lo, hi")
def co_citation_min2(spark, d):
    return networks.graph_edges(networks.co_citations(publications(spark, d), min_count=2))


@query(f"with {MENTIONS}, {COUPLING} select least(source, target) as source, greatest(source, target) as target, min(year)::int as year, count(*) as weight from bc group by least(source, target), greatest(source, target)")
def coupling_graph(spark, d):
    return networks.coupling_edges(publications(spark, d))


@query(f"""with {MENTIONS}, {COUPLING}, k as (select source as s, target as t from bc group by 1, 2 having count(distinct shared_ref) >= 2)
select least(source, target) as source, greatest(source, target) as target, min(year)::int as year, count(*) as weight from bc join k on s = source and t = target group by least(source, target), greatest(source, target)""")
def coupling_min_shared2(spark, d):
    return networks.coupling_edges(publications(spark, d), min_shared=2)


AUTHORS = "ca as (select distinct paper, year, p_brand as author from m join part on ref = p_partkey::varchar), ac as (select a.year, a.author as source, b.author as target, a.paper from ca a join ca b on a.paper = b.paper and a.author < b.author)"


@query(f"with {MENTIONS}, {AUTHORS} select source, target, source as source_label, target as target_label, min(year)::int as year, count(*) as weight from ac group by source, target")
def author_co_citation_graph(spark, d):
    return networks.graph_edges(networks.author_co_citations(publications(spark, d), cited_works(spark, d)))


def brand_entities(spark: SparkSession, d: str) -> DataFrame:
    brands = table(spark, d, "part").select("p_brand").distinct()
    return brands.where("p_brand not like '%1'").select(F.col("p_brand").alias("author_uid"), F.concat(F.lit("Maker "), F.lower("p_brand")).alias("author_display_name"))


BRAND = "case when {0} like '%1' then {0} else 'Maker ' || lower({0}) end"


@query(f"with {MENTIONS}, {AUTHORS} select year, source, target, paper as source_citation, {BRAND.format('source')} as source_label, {BRAND.format('target')} as target_label from ac where (source, target) in (select (source, target) from ac group by source, target having count(distinct paper) >= 5)")
def author_co_citation_labels(spark, d):
    return networks.author_co_citations(publications(spark, d), cited_works(spark, d), 5, brand_entities(spark, d))


@query(f"""with {MENTIONS} select paper as id, title as "Title", year as "Year", 0 as from_refs from pubs
union all select p_partkey::varchar, p_name, p_size + 1950, 1 from part where p_partkey::varchar not in (select paper from pubs)""")
def graph_nodes(spark, d):
    nodes = networks.graph_nodes(publications(spark, d), cited_works(spark, d))
    return nodes.select("id", "Title", "Year", F.col("Journal").isNotNull().cast("int").alias("from_refs"))


@query(f"with {MENTIONS}, e as (select paper as id from m where ref in (select ref from m group by ref having count(*) >= 35) union select ref from m group by ref having count(*) >= 35) select id from e")
def nodes_in_edges(spark, d):
    pubs = publications(spark, d)
    edges = networks.graph_edges(networks.direct_citations(pubs, 35), directed=True)
    return networks.nodes_in_edges(networks.graph_nodes(pubs, cited_works(spark, d)), edges).select("id")


@query(f"with {MENTIONS}, {AUTHORS}, e as (select source as id from ac union select target from ac) select id, id as author_uid, {BRAND.format('id')} as label from e")
def author_nodes(spark, d):
    edges = networks.graph_edges(networks.author_co_citations(publications(spark, d), cited_works(spark, d)))
    return networks.author_nodes(edges, brand_entities(spark, d)).select("id", "author_uid", "label")


@query(f"""with {MENTIONS} select paper as "Bibcode" from pubs where regexp_matches(author, '(?i)#0+1[0-9]$|#0*77$')""")
def filter_authors_regex(spark, d):
    return publications(spark, d).where(filters.authors_match(F.col("Author"), ["#0+1[0-9]$", "#0*77$"])).select("Bibcode")


@query(f"""with {MENTIONS} select paper as source, ref as target, pos::int as ref_index, year from m where contains(lower(author), '00000001') or contains(lower(author), '#000000002')""")
def filter_authors_literal(spark, d):
    return networks.direct_citations(publications(spark, d), authors=["00000001", "#000000002"])


@query("""select p_partkey::varchar as "Bibcode" from part where p_brand in ('Brand#11', 'Brand#23') and p_partkey % 7 <> 0""")
def filter_uid_overlap(spark, d):
    refs = cited_works(spark, d).withColumn("author_uids", F.when(F.col("ord") % 7 == 0, F.array(F.lit(None).cast("string"))).otherwise(F.col("Author")))
    return refs.where(filters.citing_filter(None, ["Brand#11", "Brand#23"], refs.columns)).select("Bibcode")


@query(f"""with {MENTIONS} select paper as "Bibcode", coalesce(string_agg(ref, ',' order by pos) filter (where p_brand is not null and p_brand not like '%#1%'), '') as refs
from pubs left join m using (paper) left join part on ref = p_partkey::varchar group by paper""")
def exclude_cited_authors(spark, d):
    out = filters.filter_corpus(publications(spark, d), cited_works(spark, d), exclude_authors=["#1"])
    return out.select("Bibcode", F.array_join("References", ",").alias("refs"))


@query(f"""with {MENTIONS}, l as (select paper, string_agg(ref, ',' order by pos) as refs from m group by paper)
select 10000000 - ord as ord, paper as "Bibcode", coalesce(refs, '') as refs from pubs left join l using (paper)""")
def align_citation_inputs(spark, d):
    pubs = publications(spark, d)
    listed = pubs.select((F.lit(10_000_000) - F.col("ord")).alias("ord"), "Bibcode", "References")
    again = listed.withColumn("ord", F.col("ord") + 50_000_000)
    return networks.align(pubs, listed.withColumn("References", F.array(F.lit("x"))).unionByName(again)).select("ord", "Bibcode", F.array_join("References", ",").alias("refs"))


@query(f"with {MENTIONS} select ref, count(*) as n from m group by ref having count(*) >= 5 order by n desc, min(ord * 1000 + pos) limit 50")
def reference_top_n(spark, d):
    return filters.top_references(publications(spark, d), least=5, most=50)


def topic_docs(spark: SparkSession, d: str) -> DataFrame:
    topic = F.when(F.col("doc_id") % 17 == 0, F.lit(None)).when(F.col("doc_id") % 10 == 0, -1).when(F.col("lang") == "de", 0).when(F.col("lang") == "en", 1).when(F.col("lang") == "es", 2).otherwise(3)
    return table(spark, d, "documents").select(
        F.col("doc_id").alias("ord"), F.col("doc_id").cast("string").alias("Bibcode"), topic.cast("int").alias("topic_id"), F.concat(F.lit("Topic "), "lang").alias("Name"), "text", "source", "lang")


TOPICS = """docs as (select doc_id as ord, doc_id::varchar as bibcode, case when doc_id % 17 = 0 then null when doc_id % 10 = 0 then -1 when lang = 'de' then 0 when lang = 'en' then 1 when lang = 'es' then 2 else 3 end::int as topic_id,
 'Topic ' || lang as name, text, source, lang from documents)"""


@query(f"""with {TOPICS} select topic_id as cluster, arg_min(name, ord) as label, count(*) as "Count", round_even(100.0::double * count(*) / (select count(*) from docs), 1)::double as "Percentage" from docs where topic_id is not null group by 1""")
def cluster_summary(spark, d):
    return curation.cluster_summary(topic_docs(spark, d))


def layered(spark: SparkSession, d: str) -> DataFrame:
    nation, region = table(spark, d, "nation"), table(spark, d, "region")
    rows = table(spark, d, "customer").join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey")).join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey"))  # fixed small tables
    return rows.select(
        F.col("c_custkey").alias("ord"), F.col("c_custkey").cast("string").alias("Bibcode"), F.when(F.col("c_custkey") % 11 == 0, F.lit(None)).otherwise(F.col("n_nationkey")).alias("topic_layer_0_id"),
        F.col("n_name").alias("topic_layer_0_label"), F.col("r_regionkey").alias("topic_layer_1_id"), F.col("r_name").alias("topic_layer_1_label"))


LAYERED = """lay as (select c_custkey as ord, case when c_custkey % 11 = 0 then null else n_nationkey end as id0, n_name as label0, r_regionkey as id1, r_name as label1
 from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey)"""


@query(f"""with {LAYERED}, l as (select ord, 0 as layer, id0 as cluster, label0 as label from lay union all select ord, 1, id1, label1 from lay)
select layer::int as layer, cluster, arg_min(label, ord) as label, count(*) as "Count", round_even(100.0::double * count(*) / (select count(*) from lay), 1)::double as "Percentage", layer = 1 as is_working_layer from l where cluster is not null group by layer, cluster""")
def hierarchy_summary(spark, d):
    return curation.hierarchy_summary(layered(spark, d), [0, 1], working=curation.working_layer(2))


@query(f"""with {TOPICS} select bibcode as "Bibcode", topic_id from docs where topic_id is null or topic_id not in (-1, 1)""")
def remove_clusters(spark, d):
    return filters.remove_clusters(topic_docs(spark, d), filters.flat_selection(["-1", 1])).select("Bibcode", "topic_id")


@query(f"""with {LAYERED} select ord::varchar as "Bibcode" from lay where not (coalesce(id0 in (3, 7), false) or coalesce(id1 = 2, false))""")
def remove_layered_clusters(spark, d):
    targets = [{"layer": 0, "cluster_id": 3}, {"layer": 0, "cluster_id": 7}, {"layer": 1, "cluster_id": "2"}]
    return filters.remove_layered_clusters(layered(spark, d), targets).select("Bibcode")


@query(f"""with {TOPICS} select bibcode as "Bibcode" from docs where ord % 13 = 0 or lower(source) not in ('src0', 'src1')""")
def filter_by_field(spark, d):
    rows = topic_docs(spark, d).withColumn("source", F.when(F.col("ord") % 13 != 0, F.col("source")))
    return filters.filter_by_field(rows, "source", ["SRC0", "Src1"], keep=False).select("Bibcode")


def untidy(spark: SparkSession, d: str) -> DataFrame:
    """Publications with padded, repeated and empty keys, and lists with blanks, repeats and unknown keys."""
    pubs = publications(spark, d)
    refs = F.concat("References", F.array(F.lit(" "), F.concat(F.lit(" "), F.coalesce(F.try_element_at("References", F.lit(1)), F.lit("x")), F.lit(" ")), F.concat(F.lit("gone"), (F.col("ord") % 7).cast("string"))))
    first = pubs.withColumns({"Bibcode": F.when(F.col("ord") % 50 == 0, F.lit(" ")).otherwise(F.concat(F.lit(" "), "Bibcode")), "References": refs})
    again = pubs.where("ord % 4 = 0").withColumns({"ord": F.col("ord") + 10_000_000, "Title": F.lit(" "), "References": F.when(F.col("ord") % 8 == 0, F.concat(refs, F.array(F.lit("more")))).otherwise(refs)})
    return first.unionByName(again)


UNTIDY = f"""{MENTIONS}, l as (select paper, list(ref order by pos) as refs from m group by paper),
base as (select ord, paper, title, coalesce(refs, []) as refs from pubs left join l using (paper)),
more as (select ord, paper, title, refs || [' ', ' ' || coalesce(refs[1], 'x') || ' ', 'gone' || (ord % 7)] as refs from base),
dirty as (select ord, case when ord % 50 = 0 then ' ' else ' ' || paper end as key, title, refs, len(refs) as n from more
 union all select ord + 10000000, paper, ' ', case when ord % 8 = 0 then refs || ['more'] else refs end, len(refs) + (ord % 8 = 0)::int from more where ord % 4 = 0),
best as (select *, trim(key) as k from dirty where trim(key) <> '' qualify row_number() over (partition by trim(key) order by n desc, (trim(title) <> '')::int desc, ord) = 1),
items as (select k, ord, trim(unnest(refs)) as ref, unnest(range(len(refs))) as pos from best)"""


@query(f"""with {UNTIDY} select k as "Bibcode", ord, n as n_refs from best""")
def dedupe_best_row(spark, d):
    return quality.best_rows(untidy(spark, d)).select("Bibcode", "ord", F.size("References").cast("long").alias("n_refs"))


@query(f"""with {UNTIDY}, o as (select k, ref, min(pos) as pos from items where ref in (select p_partkey::varchar from part) group by 1, 2), g as (select k, string_agg(ref, ',' order by pos) as refs from o group by k)
select k as "Bibcode", coalesce(g.refs, '') as refs from best left join g using (k)""")
def clean_references(spark, d):
    out = quality.clean_references(quality.best_rows(untidy(spark, d)), cited_works(spark, d))
    return out.select("Bibcode", F.array_join("References", ",").alias("refs"))


@query(f"""with {UNTIDY} select ref, count(distinct k) as mentions from items where ref <> '' and ref not in (select p_partkey::varchar from part) group by ref order by 2 desc, 1 limit 20""")
def missing_references_top(spark, d):
    return quality.missing_references(quality.reference_mentions(quality.best_rows(untidy(spark, d)), cited_works(spark, d)))


def keys_sql(name: str, table: str, key: str) -> str:
    return f"""(select count(*) from {table}) as {name}_rows, (select count(*) from {table} where trim({key}) = '') as {name}_empty_keys,
 (select count(*) - count(distinct trim({key})) from {table} where trim({key}) <> '') as {name}_duplicate_rows,
 (select count(*) from (select trim({key}) from {table} where trim({key}) <> '' group by 1 having count(*) > 1)) as {name}_duplicate_keys,
 (select count(distinct trim({key})) from {table} where trim({key}) <> '') as {name}_output_rows, (select count(*) from {table} where trim({key}) <> {key}) as {name}_padded_keys"""


@query(f"""with {UNTIDY}, r as (select k, ref, row_number() over (partition by k, ref order by pos) as n, ref in (select p_partkey::varchar from part) as known from items),
works as (select p_partkey::varchar as key, ['uid:' || p_size, 'Unknown', 'uid:' || (p_partkey % 50), 'a::no author', 'uid:' || p_size] as u from part),
ids as (select list_filter(u, lambda x: lower(x) not in ('unknown', 'a::no author')) as valid, u from works)
select {keys_sql('publications', 'dirty', 'key')}, {keys_sql('references', 'works', 'key')},
 count(*) filter (where ref = '') as empty_mentions, count(*) filter (where ref <> '' and n > 1) as duplicate_mentions,
 count(*) filter (where ref <> '' and n = 1 and not known) as missing_mentions, count(distinct ref) filter (where ref <> '' and not known) as missing_keys,
 (select sum(len(u) - len(valid))::bigint from ids) as references_placeholder_uids, (select sum(len(valid) - len(list_distinct(valid)))::bigint from ids) as references_duplicate_uids,
 (select count(*) from ids where len(u) <> len(list_distinct(valid))) as references_uid_changed_rows from r""")
def cleaning_report(spark, d):
    uid = lambda c: F.concat(F.lit("uid:"), c.cast("string"))
    size = uid(F.col("Year") - 1950)
    refs = cited_works(spark, d).withColumn("author_uids", F.array(size, F.lit("Unknown"), uid(F.col("ord") % 50), F.lit("a::no author"), size))
    return quality.cleaning_report(untidy(spark, d), refs.withColumn("Year", F.lit(None).cast("int")))


@query(f"""with {UNTIDY}, u as (select k, ord, ref from items where ref <> ''), dup as (select trim(key) as value, count(*) as n, min(ord) as first from dirty where trim(key) <> '' group by 1 having count(*) > 1)
select * from (select 'publications_duplicate_key' as kind, value, n from dup order by first, value limit 20)
union all select * from (select 'missing_reference', ref, count(distinct k) from u where ref not in (select p_partkey::varchar from part) group by ref order by 3 desc, 2 limit 20)""")
def cleaning_examples(spark, d):
    return quality.cleaning_examples(untidy(spark, d), cited_works(spark, d))


@query("""with s as (select s_suppkey, s_name, ['uid:' || s_nationkey, case s_suppkey % 8 when 0 then 'unknown' when 1 then 'NaN' when 2 then 'no author' when 3 then 'N.Author' when 4 then 'x::' when 5 then 'x::unknown::y' when 6 then 'x::none' else 'null' end, ' uid:' || s_nationkey || ' ', 'uid:' || s_suppkey] as u from supplier),
t as (select s_suppkey, s_name, u[1] as a, case when s_suppkey % 8 >= 6 then u[2] end as b, u[4] as c from s)
select s_suppkey, concat_ws(',', a, b, case when c <> a then c end) as uids, s_name || case when b is null then '' else ',x' end || case when c <> a then ',' else '' end as names from t""")
def clean_author_uids(spark, d):
    nation, own = (F.concat(F.lit("uid:"), F.col(c).cast("string")) for c in ("s_nationkey", "s_suppkey"))
    odd = F.get(F.array(*map(F.lit, ["unknown", "NaN", "no author", "N.Author", "x::", "x::unknown::y", "x::none", "null"])), (F.col("s_suppkey") % 8).cast("int"))
    rows = table(spark, d, "supplier").select("s_suppkey", F.array(nation, odd, F.concat(F.lit(" "), nation, F.lit(" ")), own).alias("author_uids"), F.array(F.col("s_name"), F.lit("x"), F.lit("y")).alias("author_display_names"))
    return quality.clean_identities(rows).select("s_suppkey", F.array_join("author_uids", ",").alias("uids"), F.array_join("author_display_names", ",").alias("names"))


@query(f"""with {TOPICS}, i as (select unnest([-1, 0, 1, 2, 3, 99])::int as "Topic") select "Topic", count(topic_id) as "Count" from i left join docs on topic_id = "Topic" group by 1""")
def topic_count_sync(spark, d):
    info = spark.createDataFrame([(k, 0) for k in (-1, 0, 1, 2, 3, 99)], "Topic int, Count long")
    return quality.sync_topic_counts(info, topic_docs(spark, d))


@query("""select page_id, md5(regexp_replace(replace(replace(replace(replace(replace(html, '&copy;', '©'), '&middot;', '·'), '&quot;', '"'), '&amp;', '&'), '&amp', '&'), '<[^\n\r]*?>', '', 'g')) as clean_md5 from pages""")
def clean_html_pages(spark, d):
    return table(spark, d, "pages").select("page_id", F.md5(ft.clean_html(F.col("html")).cast("binary")).alias("clean_md5"))


@query("""select p_partkey, trim(split_part(p_partkey || ' - ' || (p_partkey + 9), '-', 1)) as first_part, (p_size + p_partkey % 3)::varchar as first_page,
 case p_partkey % 4 when 3 then '' else (p_size + p_partkey % 90)::varchar end as last_page, case when p_partkey % 4 <> 3 and p_size + p_partkey % 3 <> 0 and p_size + p_partkey % 90 <> 0 then p_partkey % 90 - p_partkey % 3 + 1 end::int as pages from part""")
def clean_ranges(spark, d):
    sign = F.get(F.array(*map(F.lit, [" – ", "-", "—", ""])), (F.col("p_partkey") % 4).cast("int"))
    last = F.when(F.col("p_partkey") % 4 == 3, F.lit("")).otherwise((F.col("p_size") + F.col("p_partkey") % 90).cast("string"))
    both = F.concat((F.col("p_size") + F.col("p_partkey") % 3).cast("string"), sign, last)
    rows = table(spark, d, "part").select("p_partkey", ft.clean_range(F.concat_ws(" - ", F.col("p_partkey").cast("string"), (F.col("p_partkey") + 9).cast("string"))).alias("first_part"), ft.page_range(both).alias("r"))
    return rows.select("p_partkey", "first_part", F.col("r.first").alias("first_page"), F.col("r.last").alias("last_page"), fc.page_count(F.col("r.first"), F.col("r.last")).alias("pages"))


@query("""with c as (select c_custkey, c_name || case c_custkey % 7 when 0 then '; ' when 1 then ' and ' when 2 then ' & ' when 3 then ' AND ' when 4 then ', et al.; ' when 5 then '; 12 Colleagues.;' else ';; & ' end || c_mktsegment
 || case c_custkey % 5 when 0 then ' et al' when 1 then '; and 3 colleagues' when 2 then ' ,;' when 3 then '; et al.' else '' end as written from customer),
x as (select c_custkey, unnest(regexp_split_to_array(written, ';')) as chunk, unnest(range(len(regexp_split_to_array(written, ';')))) as i from c),
y as (select c_custkey, i, unnest(regexp_split_to_array(trim(chunk), '\\s+(?:and|&)\\s+')) as part, unnest(range(len(regexp_split_to_array(trim(chunk), '\\s+(?:and|&)\\s+')))) as j from x where trim(chunk) <> ''),
z as (select c_custkey, i, j, trim(regexp_replace(regexp_replace(part, '^(?:and|&)\\s+', '', 'i'), ',?\\s*et\\s*al\\.?$', '', 'i'), ' ,;') as name from y),
k as (select * from z where name <> '' and not regexp_full_match(name, '(?:and\\s+)?\\d+\\s+colleagues\\.?', 'i'))
select c_custkey, string_agg(name, '|' order by i, j) as names, count(*)::int as n, max_by(regexp_extract(name, '[^ ]+$'), -(i * 100 + j)) as first_surname from k group by 1""")
def parse_authors(spark, d):
    pick = lambda n, *signs: F.get(F.array(*map(F.lit, signs)), (F.col("c_custkey") % n).cast("int"))
    written = F.concat("c_name", pick(7, "; ", " and ", " & ", " AND ", ", et al.; ", "; 12 Colleagues.;", ";; & "), "c_mktsegment", pick(5, " et al", "; and 3 colleagues", " ,;", "; et al.", ""))
    names = table(spark, d, "customer").select("c_custkey", ft.parse_authors(written).alias("a"))
    return names.select("c_custkey", F.array_join("a", "|").alias("names"), F.size("a").alias("n"), ft.surname(F.col("a")[0]).alias("first_surname"))


@query("""select o_orderkey::varchar as "Bibcode", 'T ' || o_orderpriority as "Title", year(o_orderdate)::varchar as "Year", 2::int as authors from orders where o_orderkey % 5 <> 0""")
def parse_export_records(spark, d):
    o = table(spark, d, "orders")
    fields = [F.concat(F.lit(" "), F.col("o_orderkey").cast("string"), F.lit(" ")), F.lit("Doe, J and Roe, K"), F.concat(F.lit("T\n"), "o_orderpriority"), F.year("o_orderdate").cast("string"), *([F.lit("")] * 12)]
    short = F.when(F.col("o_orderkey") % 5 == 0, F.lit("onlyxOxthreexOxfields")).otherwise(F.concat(F.concat_ws("xOx", *fields), F.lit("xOx")))
    return corpus.parse_export(o.select(short.alias("value"))).select("Bibcode", "Title", "Year", F.size("Author").alias("authors"))


@query("""select p_partkey, 'Brand' || '#' || substr(p_brand, 7) as name from part""")
def first_author_surname(spark, d):
    rows = table(spark, d, "part").select("p_partkey", F.array(F.when(F.col("p_partkey") % 2 == 0, F.concat("p_brand", F.lit(", A B"))).otherwise(F.concat(F.lit("A B "), "p_brand"))).alias("Author"))
    return rows.select("p_partkey", networks.first_author_id(rows.columns).alias("name"))


@query(f"""with {MENTIONS}, o as (select paper, ref, min(pos) as pos from m where ref::bigint % 5 <> 0 group by 1, 2), l as (select paper, string_agg(ref, ';' order by pos) as refs from o group by paper)
select paper as "Bibcode", year as "Year", title as "Title", author as authors, coalesce(refs, '') as refs from pubs left join l using (paper)""")
def normalize_source_input(spark, d):
    pubs = publications(spark, d).select("ord", F.concat(F.lit(" "), "Bibcode").alias("Bibcode"), F.concat(F.col("Year").cast("string"), F.lit(".0")).alias("Year"), F.array_join("Author", " ; ").alias("Author"), F.concat_ws("", "Title", F.lit(" \n")).alias("Title"), F.lit(None).cast("string").alias("Abstract"), F.concat("References", F.array(F.lit(" "))).alias("References"))
    refs = cited_works(spark, d).where("ord % 5 <> 0").withColumnRenamed("Journal", "venue")
    out, _ = corpus.normalize_source(pubs, refs)
    return out.select("Bibcode", "Year", "Title", F.array_join("Author", ";").alias("authors"), F.array_join("References", ";").alias("refs"))


@query("select (select count(*) from orders) as expected, (select count(*) from orders where o_orderkey % 9 <> 0) as parsed, (select count(*) from orders where o_orderkey % 9 = 0) as missing")
def export_coverage(spark, d):
    pubs = table(spark, d, "orders").select(F.col("o_orderkey").alias("Bibcode"))
    return reports.export_coverage(pubs, pubs.where("Bibcode % 9 <> 0"))


@query(f"""with {MENTIONS} select round(avg((paper in (select paper from m))::int), 4)::double as "References_coverage", round(avg((ord % 3 <> 0 and ord % 7 <> 1)::int), 4)::double as "Title_coverage", round(avg((ord % 11 <> 0)::int), 4)::double as "Year_coverage" from pubs""")
def source_coverage(spark, d):
    title = F.when(F.col("ord") % 3 == 0, F.lit(None)).when(F.col("ord") % 7 == 1, F.lit(" ")).otherwise(F.col("Title"))
    pubs = publications(spark, d).withColumns({"Title": title, "Year": F.when(F.col("ord") % 11 != 0, F.col("Year"))})
    return reports.source_coverage(pubs, ["References", "Title", "Year"])


@query("select count(*) as raw_links, count(*) filter (where l_partkey % 5 <> 0) as retained_links, count(distinct l_partkey) as unique_references, round(count(*) filter (where l_partkey % 5 <> 0) / count(*), 4)::double as retention from lineitem")
def link_retention(spark, d):
    return reports.link_retention(publications(spark, d), cited_works(spark, d).where("ord % 5 <> 0"))


@query("""select o_orderkey::varchar as "Bibcode", year(o_orderdate)::int as "Year" from orders qualify row_number() over (partition by year(o_orderdate) order by o_orderkey) <= 25""")
def yearly_quota(spark, d):
    return corpus.yearly_quota(publications(spark, d), 25).select("Bibcode", "Year")


@query("""select o_orderkey::varchar as "Bibcode", year(o_orderdate)::int as "Year", c_name as author, 'x:author:' || c_custkey as uid, 'x:1' as refs, '10' as first_page, '19' as last_page from orders join customer on o_custkey = c_custkey""")
def parse_nested_records(spark, d):
    o = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    author = F.array(F.struct(F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name")), F.struct(F.lit("9").alias("id"), F.lit(" ").alias("name")))
    cited = F.array(F.struct(F.lit("1").alias("id")), F.struct(F.lit("1").alias("id")), F.struct(F.lit(None).cast("string").alias("id")))
    record = F.to_json(F.struct(F.col("o_orderkey").cast("string").alias("id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), F.lit("10—19").alias("pages"), author.alias("authors"), cited.alias("references")))
    rows = corpus.parse_records(o.select(record.alias("value")), "x")
    return rows.select(F.substring("Bibcode", 3, 30).alias("Bibcode"), "Year", F.col("Author")[0].alias("author"), F.col("author_uids")[0].alias("uid"), F.array_join("References", ",").alias("refs"), F.col("First Page").alias("first_page"), F.col("Last Page").alias("last_page"))


@query("select doc_id, md5(coalesce(case when doc_id % 3 <> 0 then source end, '') || '. ' || text) as full_md5 from documents")
def full_text(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(ft.full_text(F.when(F.col("doc_id") % 3 != 0, F.col("source")), F.col("text")).cast("binary")).alias("full_md5"))


STOP = ", ".join(f"'{w}'" for w in topics.STOP_WORDS)
TOKENS = f"tok as (select doc_id, lang, list_filter(regexp_extract_all(lower(text), '\\p{{L}}+'), lambda w: length(w) >= 3 and w not in ({STOP})) as tokens from documents)"


@query(f"with {TOKENS} select doc_id, len(tokens)::int as n_tokens, md5(array_to_string(tokens, ' ')) as tokens_md5 from tok")
def tokens(spark, d):
    rows = table(spark, d, "documents").select("doc_id", topics.tokens(F.col("text")).alias("t"))
    return rows.select("doc_id", F.size("t").alias("n_tokens"), F.md5(F.array_join("t", " ").cast("binary")).alias("tokens_md5"))


GRAMS = f"""{TOKENS}, g as (select lang as topic, unnest(list_concat(tokens, [tokens[i] || ' ' || tokens[i + 1] for i in range(1, len(tokens))], [tokens[i] || ' ' || tokens[i + 1] || ' ' || tokens[i + 2] for i in range(1, len(tokens) - 1)])) as term from tok),
tc as (select topic, term, count(*) as tf from g group by 1, 2)"""


def term_counts(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select(F.col("lang").alias("topic_id"), topics.tokens(F.col("text")).alias("tokens"))
    return topics.term_counts(rows)


@query(f"with {GRAMS} select topic, term, tf from tc where tf >= 3")
def ngram_counts(spark, d):
    return term_counts(spark, d).where("tf >= 3")


@query(f"""with {GRAMS}, f as (select term, sum(tf) as f from tc group by term), a as (select avg(n) as a from (select sum(tf) as n from tc group by topic)),
w as (select topic, term, tf, tf * ln(1 + a / f) as weight from tc join f using (term), a)
select topic, term, tf, round(weight, 6)::double as weight from w qualify row_number() over (partition by topic order by weight desc, term) <= 20""")
def ctfidf_top_terms(spark, d):
    return topics.class_tfidf(term_counts(spark, d)).withColumn("weight", F.round("weight", 6))


@query("select count(*) filter (where coalesce(l <> 'en', true) and text <> '')::bigint as text_other from (select text, case when doc_id % 19 <> 0 then lang end as l from documents)")
def language_tally(spark, d):
    return reports.language_tally(table(spark, d, "documents").withColumn("text_lang", F.when(F.col("doc_id") % 19 != 0, F.col("lang"))), ["text"])


@query("select doc_id from documents where (doc_id % 19 = 0 or lang <> 'en') and text <> ''")
def translation_targets(spark, d):
    return filters.translation_targets(table(spark, d, "documents").withColumn("text_lang", F.when(F.col("doc_id") % 19 != 0, F.col("lang"))), "text").select("doc_id")


def vectors(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").select(F.col("vec_id").cast("string").alias("Bibcode"), F.when(F.col("vec_id") % 5 == 0, -1).otherwise(F.col("label")).cast("int").alias("topic_id"), "embedding")


VECTORS = """v as (select vec_id, case when vec_id % 5 = 0 then -1 else label end::int as topic_id, embedding from embeddings),
e as (select topic_id, unnest(embedding)::double as x, unnest(range(len(embedding))) as pos from v where topic_id <> -1),
c as (select topic_id, list(m order by pos) as centroid from (select topic_id, pos, avg(x) as m from e group by 1, 2) group by 1),
s as (select vec_id, c.topic_id, list_cosine_similarity(v.embedding::double[], c.centroid) as sim from v, c where v.topic_id = -1),
b as (select vec_id, topic_id from s where sim >= 0.1 and sim > 0 qualify row_number() over (partition by vec_id order by sim desc, topic_id) = 1)"""


@query(f"with {VECTORS} select topic_id as cluster, round(list_sum(centroid), 4)::double as total, (select count(*) from v where v.topic_id = c.topic_id) as n from c")
def centroids(spark, d):
    out = topics.centroids(vectors(spark, d))
    return out.select("cluster", F.round(F.aggregate("centroid", F.lit(0.0), lambda a, x: a + x), 4).alias("total"), "n")


@query(f"""with {VECTORS} select v.vec_id::varchar as "Bibcode", coalesce(b.topic_id, v.topic_id)::int as topic_id from v left join b using (vec_id)""")
def outlier_reassign(spark, d):
    return topics.reassign_outliers(vectors(spark, d), threshold=0.1).select("Bibcode", "topic_id")


@query(f"""with {VECTORS}, f as (select v.vec_id, coalesce(b.topic_id, v.topic_id)::int as topic_id, v.embedding from v left join b using (vec_id)),
w as (select vec_id, case when label % 2 = 0 and vec_id % 7 <> 0 then label % 3 else -1 end::int as coarse, embedding from embeddings),
e1 as (select coarse, unnest(embedding)::double as x, unnest(range(len(embedding))) as pos from w where coarse <> -1),
c1 as (select coarse, list(m order by pos) as centroid from (select coarse, pos, avg(x) as m from e1 group by 1, 2) group by 1),
s1 as (select vec_id, c1.coarse, list_cosine_similarity(w.embedding::double[], c1.centroid) as sim from w, c1 where w.coarse = -1),
b1 as (select vec_id, coarse from s1 where sim >= 0.1 and sim > 0 qualify row_number() over (partition by vec_id order by sim desc, coarse) = 1)
select vec_id::varchar as "Bibcode", 0::int as layer, topic_id as cluster_id from f
union all select vec_id::varchar, 1, case when w.coarse <> -1 then w.coarse when f.topic_id <> -1 then f.topic_id % 3 else coalesce(b1.coarse, -1) end::int from f join w using (vec_id) left join b1 using (vec_id)""")
def hierarchical_outliers(spark, d):
    v = vectors(spark, d).join(table(spark, d, "embeddings").select(F.col("vec_id").cast("string").alias("Bibcode"), "label", "vec_id"), "Bibcode")
    coarse = F.when((F.col("label") % 2 == 0) & (F.col("vec_id") % 7 != 0), F.col("label") % 3).otherwise(-1)
    assigned = v.select("Bibcode", F.lit(0).alias("layer"), F.col("topic_id").alias("cluster_id")).union(v.select("Bibcode", F.lit(1).alias("layer"), coarse.cast("int").alias("cluster_id")))
    tree = spark.createDataFrame([(0, k, 1, k % 3) for k in range(10)], "child_layer int, child_id int, parent_layer int, parent_id int")
    return topics.reassign_layers(assigned, v.select("Bibcode", "embedding"), tree, 2, threshold=0.1)


@query(f"""with {TOPICS} select topic_id as "Topic", count(*) as "Count", case when topic_id = -1 then 'Outlier Topic' when topic_id = 1 then 'English' else 'Topic ' || topic_id end as "Name" from docs where topic_id is not null group by 1""")
def topic_info(spark, d):
    return topics.topic_info(topic_docs(spark, d), spark.createDataFrame([(1, "English")], "topic int, name string"))


@query("""select vec_id::varchar as "Bibcode", case when vec_id % 5 = 0 then -1 else label end::int as topic_id, case when vec_id % 5 = 0 then null else 'T' || label end as "Name", round(embedding[1]::double, 4)::double as x from embeddings""")
def topic_dataframe(spark, d):
    info = spark.createDataFrame([(k, f"T{k}") for k in range(10)], "Topic int, Name string")
    docs = vectors(spark, d).withColumn("reduced_2d", F.slice("embedding", 1, 2)).drop("embedding")
    return topics.topic_frame(docs, info).select("Bibcode", "topic_id", "Name", F.round(F.col("embedding_2d_x").cast("double"), 4).alias("x"))


@query(f"""with {MENTIONS}, r as (select paper, string_agg(p_brand || ', ' || (p_size + 1950) || ', ' || replace(p_type, '.', '') || case when p_size > 25 then ', V' || p_size else '' end, chr(10) || '   ' order by pos) as cr from m join part on ref = p_partkey::varchar group by paper)
select paper as "Bibcode", md5('PT J' || chr(10) || 'AU ' || author || chr(10) || 'TI ' || case when ord % 3 = 0 then 'English ' || ord else title end || chr(10) || 'SO ' || chr(10) || 'DT article' || chr(10) || 'DE a' || (ord % 4) || '; b' || chr(10)
 || case when ord % 4 = 0 then 'AB Of ' || ord || chr(10) else '' end || coalesce('CR ' || cr || chr(10), '') || 'PY ' || year || chr(10) || case when ord % 5 <> 0 then 'TC ' || (ord % 5) || chr(10) else '' end || 'BI ' || paper || chr(10) || 'ER') as record_md5 from pubs left join r using (paper)""")
def citation_records(spark, d):
    number = F.col("ord").cast("string")
    pubs = publications(spark, d).withColumns({
        "Title_en": F.when(F.col("ord") % 3 == 0, F.concat(F.lit("English\n "), number)).when(F.col("ord") % 3 == 1, F.lit(" ")), "Category": F.lit("article"), "Keywords": F.array(F.concat(F.lit("a"), (F.col("ord") % 4).cast("string")), F.lit("b")),
        "Abstract": F.when(F.col("ord") % 4 == 0, F.concat(F.lit("Of  "), number)), "Citation Count": (F.col("ord") % 5).cast("int")})
    refs = cited_works(spark, d).withColumn("Volume", F.when(F.col("Year") - 1950 > 25, (F.col("Year") - 1950).cast("string")))
    return sinks.citation_records(pubs, refs).select("Bibcode", F.md5(F.col("value").cast("binary")).alias("record_md5"))


@query(f"""with {MENTIONS}, e as (select paper as source, ref as target, min(year)::int as year, count(*) as weight from m where ref in (select ref from m group by ref having count(*) >= 35) group by 1, 2),
ends as (select source as id from e union select target from e),
n as (select paper as id, '"Year":"' || year || '","Author":"[\\"' || author || '\\"]","Title":"' || title || '"' as attributes from pubs
 union all select p_partkey::varchar, '"Year":"' || (p_size + 1950) || '","Author":"[\\"' || p_brand || '\\"]","Title":"' || p_name || '","Journal":"' || p_type || '"' from part where p_partkey::varchar not in (select paper from pubs))
select id as key, '{{"key":"' || id || '","attributes":{{' || attributes || '}}}}' as value from n where id in (select id from ends)
union all select source || chr(31) || target, '{{"source":"' || source || '","target":"' || target || '","attributes":{{"year":' || year || ',"weight":' || weight || '}}}}' from e""")
def graph_json(spark, d):
    pubs = publications(spark, d)
    edges = networks.graph_edges(networks.direct_citations(pubs, 35), directed=True)
    nodes, rows = sinks.graph_json_rows(edges, networks.nodes_in_edges(networks.graph_nodes(pubs, cited_works(spark, d)), edges))
    return nodes.union(rows)


@query("""select event_type as step, 'p' || (user_id % 3) as provider, 'm' as model, count(*) as calls, sum(event_id % 100)::bigint as prompt_tokens, sum(event_id % 10)::bigint as completion_tokens, sum(event_id % 100 + event_id % 10)::bigint as total_tokens,
 round(sum(case when user_id % 3 = 0 then null else value end), 4)::double as cost_usd from events group by 1, 2""")
def cost_summary(spark, d):
    e = table(spark, d, "events").select(F.col("event_type").alias("step"), F.concat(F.lit("p"), (F.col("user_id") % 3).cast("string")).alias("provider"), F.lit("m").alias("model"), (F.col("event_id") % 100).alias("prompt_tokens"), (F.col("event_id") % 10).alias("completion_tokens"), (F.col("event_id") % 100 + F.col("event_id") % 10).alias("total_tokens"), F.when(F.col("user_id") % 3 != 0, F.col("value")).alias("cost_usd"))
    return reports.cost_summary(e).withColumn("cost_usd", F.round("cost_usd", 4))


@query("""select count(*) as calls, count(*) filter (where event_id % 3 <> 2) as priced, count(*) filter (where event_id % 3 = 2) as missing, count(*) filter (where event_id % 3 = 0) as direct, count(*) filter (where event_id % 3 = 1) as fetched from events""")
def cost_resolution(spark, d):
    e = table(spark, d, "events").select(F.col("event_id").alias("generation_id"), F.when(F.col("event_id") % 3 == 0, F.col("value")).alias("cost_usd"))
    fetched = table(spark, d, "events").where("event_id % 3 = 1").select(F.col("event_id").alias("generation_id"), F.col("value").alias("cost_usd"))
    return reports.cost_resolution(reports.with_fetched_costs(e, fetched))


@query(f"with {TOPICS} select count(*) as rows, count(distinct topic_id) as topics_nunique, count(*) filter (where topic_id = -1) as outliers, round(count(*) filter (where topic_id = -1) / count(*), 4)::double as outlier_rate from docs")
def run_counts(spark, d):
    return reports.run_counts(topic_docs(spark, d))


@query("select (select count(*) from orders) as publications, count(*) as total_references, count(distinct l_partkey) as unique_references from lineitem")
def search_stats(spark, d):
    return reports.search_stats(publications(spark, d))


@query("select make_date(min(year(o_orderdate)), 1, 1) as first_day, make_date(max(year(o_orderdate)) + 1, 1, 1) as end_day from orders")
def histogram_years(spark, d):
    return reports.histogram_years(publications(spark, d))


@query("""select doc_id::varchar as bibcode, 'W' || source as title, case when length(text) > 200 then substr(text, 1, 200) || '...' else text end as abstract, case when doc_id % 4 = 0 then 0 else doc_id % 100 end::int as citation_count,
 make_date(1990 + (doc_id % 30), 12, 31) as date, round(ln(1 + case when doc_id % 4 = 0 then 0 else doc_id % 100 end) + 1, 6)::double as size from documents""")
def point_payload(spark, d):
    rows = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("Bibcode"), F.lit(0.0).alias("embedding_2d_x"), F.lit(0.0).alias("embedding_2d_y"), F.lit(0).alias("topic_id"), F.concat(F.lit("W"), "source").alias("Title_en"), (F.col("doc_id") % 30 + 1990).cast("int").alias("Year"), F.col("text").alias("Abstract_en"), F.when(F.col("doc_id") % 4 == 0, F.lit("many")).otherwise((F.col("doc_id") % 100).cast("string")).alias("Citation Count"))
    return viz.point_payload(rows).select("bibcode", "title", "abstract", "citation_count", "date", F.round("size", 6).alias("size"))


@query(f"""with {TOPICS} select case when topic_id = -1 then 'flat::noise::' when topic_id is null then 'flat::label::' || name else 'flat::' || topic_id end as key, arg_min(name, ord) as label, count(*) as "count", min(ord) as first from docs group by 1""")
def topic_panel_rows(spark, d):
    return viz.panel_rows(topic_docs(spark, d))


@query(f"""with {LAYERED} select 1::int as layer, 'layer_1::' || id1 as key, null::varchar as parent, arg_min(label1, ord) as label, count(*) as "count", lpad(min(ord)::varchar, 12, '0') as path from lay group by id1
union all select 0, key, 'layer_1::' || arg_min(id1, ord), arg_min(label0, ord), count(*), (select lpad(min(z.ord)::varchar, 12, '0') from lay z where z.id1 = arg_min(k.id1, k.ord)) || '/' || lpad(min(ord)::varchar, 12, '0') from (select *, case when id0 is null then 'layer_0::label::' || label0 else 'layer_0::' || id0 end as key from lay) k group by key""")
def hierarchical_panel(spark, d):
    return viz.hierarchical_panel(layered(spark, d), [0, 1])


@query(f"""with {TOPICS}, f as (select name as label, min(ord) as first from docs where topic_id <> -1 group by 1) select label, ['#111111', '#222222', '#333333'][(row_number() over (order by first, label) - 1) % 3 + 1] as colour from f""")
def label_colours(spark, d):
    return curation.colours(topic_docs(spark, d).where("topic_id <> -1"), ["#111111", "#222222", "#333333"])


@query(f"""with {LAYERED} select ord::varchar as "Bibcode", id0 as topic_layer_0_id, label0 as topic_layer_0_label, id1 as topic_layer_1_id, label1 as topic_layer_1_label, 1::int as topic_primary_layer_index, 2::int as topic_layer_count from lay""")
def wide_layers(spark, d):
    rows = curation.layer_rows(layered(spark, d), [0, 1]).select(F.col("ord").cast("string").alias("Bibcode"), "layer", F.col("cluster").alias("cluster_id"), "label")
    return curation.wide_layers(rows, [0, 1], 1)


@query("select date_trunc('hour', ts)::timestamp as start, event_type, count(*) as n, round(sum(value), 4)::double as total from events group by 1, 2")
def windowed_event_counts(spark, d):
    out = arrivals.windowed_counts(table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp")))
    return out.select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))


@query(f"with {MENTIONS} select ref as target, count(*) as mentions, min(year)::int as first_year from m group by ref")
def arriving_citation_counts(spark, d):
    return arrivals.citation_counts(publications(spark, d))


@query(f"with {TOPICS} select coalesce(arg_min(name, ord), 'Unlabelled') as noise_label from docs where topic_id = -1")
def noise_label(spark, d):
    return viz.noise_label(topic_docs(spark, d))


@query(f"""with {TOPICS}, f as (select name as label, min(ord) as first from docs where topic_id <> -1 group by 1), c as (select label, ['#111111', '#222222', '#333333'][(row_number() over (order by first, label) - 1) % 3 + 1] as colour from f)
select bibcode as "Bibcode", case when topic_id = -1 then '#999999' else coalesce(colour, '#999999') end as colour from docs left join c on name = label""")
def marker_colours(spark, d):
    return viz.marker_colours(topic_docs(spark, d), ["#111111", "#222222", "#333333"]).select("Bibcode", "colour")


@query("""select o_orderkey::varchar as "Bibcode", (o_orderkey % 4)::int as n_refs, case o_orderkey % 3 when 0 then 'https://example.org/' || o_orderkey || '?from=ADS_PDF' when 1 then 'https://example.org/' || o_orderkey || '?from=PUB_PDF' end as "PDF_URL" from orders""")
def search_pages(spark, d):
    key = F.col("o_orderkey").cast("string")
    cited = F.when(F.col("o_orderkey") % 4 > 0, F.array_repeat(key, (F.col("o_orderkey") % 4).cast("int")))
    source = F.when(F.col("o_orderkey") % 3 == 0, F.array(F.lit("EPRINT_HTML"), F.lit("ADS_PDF"), F.lit("PUB_PDF"))).when(F.col("o_orderkey") % 3 == 1, F.array(F.lit("PUB_PDF"), F.lit("ADS_PDF"))).otherwise(F.array(F.lit("PUB_HTML")))
    page = F.to_json(F.struct(F.struct(F.array(F.struct(key.alias("bibcode"), cited.alias("reference"), source.alias("esources"))).alias("docs")).alias("response")))
    rows = corpus.search_rows(table(spark, d, "orders").select(page.alias("value")), link="https://example.org/{bibcode}?from={resource}")
    return rows.select("Bibcode", F.size("References").alias("n_refs"), "PDF_URL")


@query(f"with {MENTIONS} select row_number() over (order by paper, pos) - 1 as id, paper as source, ref as target, pos::int as ref_index, year from m")
def evidence_ids(spark, d):
    return networks.with_edge_ids(networks.direct_citations(publications(spark, d)), ["source", "ref_index"])


@query("select doc_id, md5(case when lang = 'en' or doc_id % 19 = 0 and text = '' then text else upper(text) end) as text_md5 from (select doc_id, text, case when doc_id % 19 <> 0 then lang end as lang from documents)")
def translated_texts(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text", F.when(F.col("doc_id") % 19 != 0, F.col("lang")).alias("text_lang"))
    out = providers.translate(docs, "doc_id", "text", lambda texts, languages: [t.replace("ß", "ẞ").upper() for t in texts])
    return out.select("doc_id", F.md5(F.col("text_en").cast("binary")).alias("text_md5"))


@query("select doc_id, md5(text) as joined_md5, true as within, length(text) > 500 as several from documents where text <> ''")
def chunked_and_joined(spark, d):
    # chunks that do not overlap are the text again; what overlapping ones repeat is cut by rules that pytest holds
    rows = table(spark, d, "documents").where("text <> ''").select("doc_id", ft.chunks(F.col("text"), 500, 0).alias("c"))
    return rows.select("doc_id", F.md5(F.array_join("c", "").cast("binary")).alias("joined_md5"), F.forall("c", lambda x: F.length(x) <= 500).alias("within"), (F.size("c") > 1).alias("several"))


@query()
def overlapping_chunks_merged(spark, d):
    rows = table(spark, d, "documents").select("doc_id", ft.chunks(F.col("text"), 500, 120).alias("c"))
    return rows.select("doc_id", F.size("c").alias("chunks"), ft.merged(F.col("c")).alias("merged"))


@query("""select o_orderkey::varchar as "Bibcode", 'uid:' || substr(sha256(lower(c_name) || '|c'), 1, 16) as uids, c_name as names from orders join customer on o_custkey = c_custkey""")
def author_identities(spark, d):
    pubs = publications(spark, d)
    named = providers.block_authors(pubs.select("Bibcode", F.posexplode("Author").alias("pos", "name")))
    out = providers.attach_identities(pubs, named)
    providers.check_identities(out)
    return out.select("Bibcode", F.array_join("author_uids", ";").alias("uids"), F.array_join("author_display_names", ";").alias("names"))


def written_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as papers and their suppliers as authors; two suppliers share a surname and an initial, some papers give the initial alone."""
    given = F.when(F.col("l_orderkey") % 3 == 0, F.lit("A.")).when(F.col("l_suppkey") % 2 == 0, F.lit("Alan")).otherwise(F.lit("Anna"))
    rows = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.select(
        F.col("o_orderkey").cast("string").alias("Bibcode"), F.col("l_linenumber").cast("long").alias("pos"), F.year("o_orderdate").alias("Year"), F.col("o_orderpriority").alias("Journal"),
        F.concat(F.lit("Name"), F.floor(F.col("l_suppkey") / 2).cast("string"), F.lit(", "), given).alias("name"))


@query()
def evident_authors(spark, d):
    return identities.evident_authors(written_names(spark, d)).select("Bibcode", "pos", "name", "author_uid", "author_display_name")


@query("""with t as (select doc_id, lang, ' ' || lower(text) || ' ' as t from documents),
g as (select doc_id, lang, substr(t, i, 3) as g from (select doc_id, lang, t, unnest(range(1, length(t) - 1)) as i from t)),
b as (select lang, g, count(*) as n from g group by 1, 2 qualify row_number() over (partition by lang order by n desc, g) <= 300),
p as (select lang, g, ln(n / sum(n) over (partition by lang)) as share from b),
c as (select doc_id, g, count(*) as times from g group by 1, 2), l as (select distinct lang from documents),
s as (select doc_id, l.lang, sum(times * coalesce(share, -12)) as score from c cross join l left join p on p.lang = l.lang and p.g = c.g group by 1, 2)
select doc_id, case when regexp_matches(text, '\\p{L}') then lang end as text_lang from documents join (select doc_id, arg_max(lang, score) as lang from s group by 1) using (doc_id)""".replace("join (select doc_id, arg_max(lang, score) as lang", "join (select doc_id, arg_max(lang, score) as guessed").replace("then lang end as text_lang", "then guessed end as text_lang"))
def language_id(spark, d):
    docs = table(spark, d, "documents")
    return providers.identify_language(docs, "text", providers.train_language_profiles(docs, "text", "lang")).select("doc_id", "text_lang")


def reduced_embeddings(spark: SparkSession, d: str) -> DataFrame:
    return providers.reduce_dimensions(vectors(spark, d), "Bibcode")


def fine_clusters(spark: SparkSession, d: str) -> DataFrame:
    """Vectors in 70 small clusters, as many as a corpus has topics."""
    return table(spark, d, "embeddings").select((F.col("label") * 7 + F.col("vec_id") % 7).cast("int").alias("topic_id"), "embedding")


@query()
def pca_reduction(spark, d):
    return providers.reduce_dimensions(vectors(spark, d), "Bibcode")


@query()
def spectral_layout(spark, d):
    return layout.spectral_layout(vectors(spark, d), "Bibcode")


@query()
def cluster_documents(spark, d):
    return providers.cluster_kmeans(vectors(spark, d), "Bibcode", "embedding", 10, noise_quantile=0.95)


@query()
def density_clusters(spark, d):
    points = reduced_embeddings(spark, d)
    return density.cluster_density(points, "Bibcode", "reduced_5d", min_cluster_size=15)


@query()
def nearest_neighbours(spark, d):
    points = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.transform("embedding", lambda x: x.cast("double")).alias("vector"))
    return density.neighbours(points, 10)


@query()
def layer_tree(spark, d):
    means = topics.centroids(fine_clusters(spark, d))
    return density.coarser_layers(means, 4, branch=3)


@query("""with n as (select c_custkey as mention, 'Author' || (c_custkey % 97) || ', ' || substr(c_mktsegment, 1, 3) as name from customer),
b as (select *, lower(split_part(name, ',', 1)) || '|' || lower(substr(trim(split_part(name, ',', 2)), 1, 1)) as block from n),
w as (select block, max(name) as display from b where (block, length(name)) in (select (block, max(length(name))) from b group by block) group by block)
select mention, name, display as author_display_name, 'uid:' || substr(sha256(block), 1, 16) as author_uid from b join w using (block)""")
def author_blocking(spark, d):
    return providers.block_authors(table(spark, d, "customer").select(F.col("c_custkey").alias("mention"), F.concat(F.lit("Author"), (F.col("c_custkey") % 97).cast("string"), F.lit(", "), F.substring("c_mktsegment", 1, 3)).alias("name")))


@query("""select doc_id, sha256(case when trim(coalesce(t, '')) = '' then '(empty text)' else t end) as text_sha256, 32::int as dimensions from (select doc_id, case when doc_id % 23 = 0 then null when doc_id % 29 = 0 then '  ' else text end as t from documents)""")
def embed_documents(spark, d):
    text = F.when(F.col("doc_id") % 23 == 0, F.lit(None)).when(F.col("doc_id") % 29 == 0, F.lit("  ")).otherwise(F.col("text"))
    docs = table(spark, d, "documents").withColumn("text", text)
    return providers.embed_documents(docs, "doc_id", "text", providers.hash_embedder(32)).select("doc_id", "text_sha256", F.size("embedding").alias("dimensions"))


@query("select c_custkey, case when c_custkey % 5 = 0 then null else (1950 + c_custkey % 60) end::int as year, case when c_custkey % 5 = 0 then null else make_date((1950 + c_custkey % 60)::int, 12, 31) end as date, case c_custkey % 3 when 0 then 1987 when 1 then 2001 end::int as first_year from customer")
def dates_and_years(spark, d):
    year = F.when(F.col("c_custkey") % 5 == 0, F.lit("n.d.")).when(F.col("c_custkey") % 2 == 0, F.concat((F.col("c_custkey") % 60 + 1950).cast("string"), F.lit(".0"))).otherwise((F.col("c_custkey") % 60 + 1950).cast("string"))
    text = F.when(F.col("c_custkey") % 3 == 0, F.lit("from 1887, 1987 or 2003")).when(F.col("c_custkey") % 3 == 1, F.lit("MMI2001x")).otherwise(F.lit("in 1799"))
    rows = table(spark, d, "customer").select("c_custkey", fc.numeric_year(year).alias("year"), fc.year_in_text(text).alias("first_year"))
    return rows.select("c_custkey", "year", fc.publication_date(F.col("year")).alias("date"), "first_year")


@query("select c_custkey, least(400, greatest(96, ceil(c_custkey * 1.5) + 64))::int as ceiling, round(list_cosine_similarity([c_custkey % 7, 1]::double[], [1, c_custkey % 5]::double[]), 6)::double as similarity, greatest(1, round_even(100.0::double * (c_custkey % 13) / 13, 1))::double as share from customer")
def numbers(spark, d):
    c = F.col("c_custkey")
    cosine = fc.cosine(F.array((c % 7).cast("double"), F.lit(1.0)), F.array(F.lit(1.0), (c % 5).cast("double")))
    return table(spark, d, "customer").select("c_custkey", fc.token_ceiling(c, 400).cast("int").alias("ceiling"), F.round(cosine, 6).alias("similarity"), F.greatest(F.lit(1.0), fc.percentage(c % 13, F.lit(13))).alias("share"))


@query("select c_custkey, sha256(c_name || chr(31) || coalesce(case when c_custkey % 4 <> 0 then c_mktsegment end, '')) as fingerprint from customer")
def document_fingerprints(spark, d):
    segment = F.when(F.col("c_custkey") % 4 != 0, F.col("c_mktsegment"))
    return table(spark, d, "customer").select("c_custkey", fc.document_fingerprint(F.col("c_name"), segment).alias("fingerprint"))


@query(f"with {MENTIONS}, f as (select ref, min(ord * 1000 + pos) as first from m group by ref) select ref as \"Bibcode\", row_number() over (order by first) - 1 as ord from f")
def unique_references(spark, d):
    return corpus.all_references(publications(spark, d))


@query(f"""with {MENTIONS} select ord, ord::varchar as "Bibcode", year as "Year", 'Title & of ' || ord as "Title", author || '|Roe, K' as authors, coalesce((select string_agg(ref, ',' order by pos) from m where m.paper = pubs.paper), '') as refs, 'link/' || ord as "PDF_URL"
from pubs where ord % 6 <> 0""")
def resolved_dataset(spark, d):
    """A search result and what was exported for it: parsed, merged by key and cleaned."""
    pubs = publications(spark, d)
    found = pubs.select("ord", "Bibcode", "References", F.concat(F.lit("link/"), "Bibcode").alias("PDF_URL"))
    number = F.col("ord").cast("string")
    year = F.when(F.col("ord") % 6 == 0, F.lit("no year")).otherwise(F.col("Year").cast("string"))
    fields = [F.concat(F.lit(" "), number), F.concat(F.col("Author")[0], F.lit(" and Roe, K et al.")), F.concat(F.lit("Title &amp; of <i>"), number, F.lit("</i>")), year, *([F.lit("")] * 12)]
    cited = cited_works(spark, d).select(F.concat_ws("xOx", "Bibcode", F.lit("A"), "Title", F.col("Year").cast("string"), *([F.lit("")] * 12)).alias("value"))
    out, _ = corpus.resolve_dataset(found, corpus.export_records(pubs.select(F.concat(F.concat_ws("xOx", *fields), F.lit("xOx\nshortxOx\n")).alias("value"))), cited)
    return out.select("ord", "Bibcode", "Year", "Title", F.array_join("Author", "|").alias("authors"), F.array_join("References", ",").alias("refs"), "PDF_URL")


@query("select doc_id, substr(text, 1, 200) as a, case when doc_id % 3 = 0 then 'Dark matter' when doc_id % 3 = 1 then 'plain' else '' end as label, '<span class=\"badge\">' || replace(replace(source || ' & co', '&', '&amp;'), '<', '&lt;') || '</span>' as badges, case when doc_id % 2 = 0 then source else 'x' end as first from documents")
def answers_and_labels(spark, d):
    answer = F.when(F.col("doc_id") % 3 == 0, F.lit("<think>a\nb</think>\nTopic: \"Dark matter\"\nmore")).when(F.col("doc_id") % 3 == 1, F.lit("plain")).otherwise(F.lit(" "))
    return table(spark, d, "documents").select(
        "doc_id", F.substring("text", 1, 200).alias("a"), ft.topic_label(ft.without_thinking(answer)).alias("label"), ft.badges(F.array(F.concat("source", F.lit(" & co")), F.lit(None).cast("string"))).alias("badges"),
        ft.first_text(F.when(F.col("doc_id") % 2 == 0, F.col("source")).otherwise(F.lit(" ")), F.lit("x")).alias("first"))


@query(f"with {LAYERED}, l as (select 0 as layer, id0 as id from lay union all select 1, id1 from lay) select layer::int as layer, count(distinct case when id <> -1 then id end) as clusters from l group by 1")
def clusters_per_layer(spark, d):
    rows = curation.layer_rows(layered(spark, d), [0, 1]).select(F.col("ord").alias("Bibcode"), "layer", F.col("cluster").alias("cluster_id"))
    return curation.clusters_per_layer(rows)


@query(f"""with {TOPICS} select bibcode as "Bibcode" from docs where ord % 4 = 0 order by ord limit 3""")
def first_failures(spark, d):
    rows = topic_docs(spark, d).withColumn("error", F.when(F.col("ord") % 4 == 0, F.lit("x")))
    return reports.failures(rows).select("Bibcode")


@query(f"""with {TOPICS} select topic_id as cluster, count(*) as "Count", row_number() over (order by count(*) desc, topic_id) as place from docs where topic_id is not null group by 1""")
def summary_by_count(spark, d):
    return curation.by_count(curation.cluster_summary(topic_docs(spark, d))).select("cluster", "Count", "place")


@query(f"with {MENTIONS}, c as (select distinct paper, ord, year, ref from m), h as (select count(*) as n, count(distinct ref) as refs from c) select n, refs from h")
def distinct_mentions(spark, d):
    rows = networks.distinct_mentions(publications(spark, d))
    return rows.agg(F.count("*").alias("n"), F.countDistinct("ref").alias("refs"))


@query("""select o_orderkey::varchar as "Bibcode", year(o_orderdate)::int as "Year" from orders where o_orderkey % 3 <> 0""")
def numeric_years(spark, d):
    year = F.when(F.col("ord") % 3 == 0, F.lit("19xx")).otherwise(F.concat(F.col("Year").cast("string"), F.lit(".0")))
    return filters.numeric_years(publications(spark, d).withColumn("Year", year)).select("Bibcode", "Year")


@query("""select o_orderkey::varchar as "Bibcode", case when o_orderkey % 2 = 0 then 'Doe, J' else 'Plain' end as names, 'Title of it' as title from orders""")
def clean_ingested_rows(spark, d):
    rows = publications(spark, d).withColumns({"Author": F.array(F.when(F.col("ord") % 2 == 0, F.lit("D-oe, J")).otherwise(F.lit("Pla-in")), F.lit(" ")), "Title": F.lit("Title <sub>of</sub> i&#116;"), "Abstract": F.lit(None).cast("string")})
    return corpus.clean_ingest(rows).select("Bibcode", F.array_join("Author", "|").alias("names"), F.col("Title").alias("title"))


@query("""select c_custkey, 'Name: ' || c_mktsegment || ', k of' || chr(10) || '- ' || substr(c_name, 1, 10) || chr(10) || '- x' as prompt, 'system' as first_role,
 'Translate from ' || case when c_custkey % 2 = 0 then 'de' else 'the detected language' end || ' to en. Return only the translation.' as first_content, c_name as second_content from customer""")
def prompts(spark, d):
    prompt = ft.fill_prompt("Name: [KEYWORDS] of\n[DOCUMENTS]", F.array(F.col("c_mktsegment"), F.lit("k")), F.array(F.col("c_name"), F.lit("x")), 10)
    messages = ft.translation_messages(F.col("c_name"), F.when(F.col("c_custkey") % 2 == 0, F.lit("de")), "en")
    rows = table(spark, d, "customer").select("c_custkey", prompt.alias("prompt"), messages.alias("m"))
    return rows.select("c_custkey", "prompt", F.col("m")[0]["role"].alias("first_role"), F.col("m")[0]["content"].alias("first_content"), F.col("m")[1]["content"].alias("second_content"))


@query("""select page_id, md5(regexp_replace(replace(replace(replace(replace(replace(replace(html, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)), '&nbsp;', chr(160)), '&amp;', '&'), '<[^\n\r]*?>', '', 'g')) as plain_md5 from pages""")
def strip_tags_pages(spark, d):
    return table(spark, d, "pages").select("page_id", F.md5(ft.strip_tags(F.col("html")).cast("binary")).alias("plain_md5"))


@query("""select c_custkey, case when c_custkey % 9 = 0 then '' else c_name || '|' || c_mktsegment end as names, case when c_custkey % 9 = 0 then 0 else 2 end::int as n, case when c_custkey % 9 = 0 then '' else c_name || '; ' || c_mktsegment end as joined, '' as uids from customer""")
def split_author_names(spark, d):
    written = F.when(F.col("c_custkey") % 9 != 0, F.concat(F.lit(" ; "), "c_name", F.lit(" ;;\t"), "c_mktsegment", F.lit(" ")))
    rows = table(spark, d, "customer").select("c_custkey", ft.split_authors(written).alias("Author"))
    out = providers.passthrough_identities(rows)
    return out.select("c_custkey", F.array_join("author_display_names", "|").alias("names"), F.size("Author").alias("n"), ft.authors_text(F.col("Author")).alias("joined"), F.array_join("author_uids", "|").alias("uids"))


@query("select 0::int as child_layer, n_nationkey as child_id, 1::int as parent_layer, n_regionkey as parent_id from nation")
def tree_parents(spark, d):
    child = F.struct(F.lit(0).alias("layer"), F.col("n_nationkey").alias("id"))
    tree = table(spark, d, "nation").groupBy(F.col("n_regionkey").alias("parent_id")).agg(F.collect_list(child).alias("children")).select(F.lit(1).alias("parent_layer"), "parent_id", "children")
    return curation.parents(tree)


@query(f"""with {MENTIONS}, l as (select paper, list(ref order by pos) as refs from m group by paper)
select paper as "Bibcode", '["' || author || '"]' as author, case when refs is not null then '["' || array_to_string(refs, '","') || '"]' end as refs, refs is not null as has_refs, case when ord % 5 <> 0 then title end as title, ord % 5 <> 0 as has_title from pubs left join l using (paper)""")
def attributes(spark, d):
    pubs = publications(spark, d).withColumn("Title", F.when(F.col("ord") % 5 != 0, F.col("Title")))
    return pubs.select("Bibcode", sinks.attribute(pubs, "Author").alias("author"), sinks.attribute(pubs, "References").alias("refs"), filters.exportable(pubs, "References").alias("has_refs"), sinks.attribute(pubs, "Title").alias("title"), filters.exportable(pubs, "Title").alias("has_title"))


@query(f"""with {MENTIONS} select paper as "Bibcode", author as authors, title as "Title", year as "Year" from pubs""")
def topic_columns(spark, d):
    framed = topics.topic_columns(publications(spark, d).withColumns({"scratch": F.lit(1), "embedding": F.array(F.lit(1.0))}))
    return framed.select(*(F.array_join(c, ";").alias("authors") if c == "Author" else F.col(c) for c in framed.columns if c != "References"))


@query(f"""with {TOPICS} select case when topic_id = -1 then 1 else 0 end::int as unmatched, count(*) as n from docs where topic_id = -1 group by 1 union all select 2, count(*) from docs where topic_id is not null and topic_id not in (0, 3)""")
def unmatched_clusters(spark, d):
    """How many rows the matched part of a selection takes, and what stays without the noise that it does not name."""
    rows = topic_docs(spark, d)
    gone = filters.unmatched_clusters(rows, [-1, 77])
    noise = rows.where("topic_id = -1").agg(F.count("*").alias("n")).select(F.lit(len(gone)).alias("unmatched"), "n")
    return noise.union(filters.remove_clusters(rows.where("topic_id is not null"), [0, 3]).agg(F.count("*").alias("n")).select(F.lit(2), "n"))


@query("select (select count(*) from orders) as rows, (select count(*) from orders where o_orderkey % 2 = 0) as mentions_of_even, 0::bigint as changed")
def snapshot_round_trip(spark, d):
    """A table that goes to a snapshot, to JSON lines and to a bundle comes back as it was, and other metadata find nothing."""
    from citeloom.plans.written import table_path

    pubs = publications(spark, d).select("ord", "Bibcode", "Year", "References")
    path = table_path(spark, "snapshot")
    corpus.save_snapshot(pubs, path, {"of": fc.params_fingerprint({"a": 1})})
    held = corpus.load_snapshot(spark, path, {"of": fc.params_fingerprint({"a": 1})})
    assert corpus.load_snapshot(spark, path, {"of": "other"}) is None
    sinks.write_json_lines(held, f"{path}/lines")
    again = corpus.read_json_lines(spark, f"{path}/lines", "ord long, Bibcode string, Year int, References array<string>")
    changed = int(fc.frame_fingerprint(again, again.columns) != fc.frame_fingerprint(pubs, again.columns))
    return again.agg(F.count("*").alias("rows"), F.count_if(F.col("ord") % 2 == 0).alias("mentions_of_even"), F.lit(changed).cast("long").alias("changed"))


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
