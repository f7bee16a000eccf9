"""Citation networks: direct citation, co-citation, bibliographic coupling and first-author co-citation.

Evidence tables hold a row for each supporting observation, in the orientation in which it was seen; graphs aggregate
them over canonical pairs.  Thresholds count distinct papers (mentions, for direct citation), weights count evidence rows.
With a threshold, pairs are counted first, after works too rarely cited to reach it are gone, and only the counted pairs are
joined to their evidence, from the rarer end.  A paper or work with very many mentions is paired in blocks, over many tasks.  Input tables
carry `ord`, a stable row order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citeloom.functions.columns import references
from citeloom.functions.text import strip, surname
from citeloom.operators import filters
from citeloom.plans.written import materialize, numbered


def citation_inputs(pubs: DataFrame) -> DataFrame:
    """(ord, Bibcode, References) with clean lists."""
    return pubs.select("ord", "Bibcode", references(F.col("References")).alias("References"))


def align(pubs: DataFrame, inputs: DataFrame) -> DataFrame:
    """Publications in the order of an explicit (ord, Bibcode, References) table, with its lists.

    A key that the table repeats has its first place and its last list; keys that pubs lacks are dropped.
    """
    once = inputs.groupBy("Bibcode").agg(F.min("ord").alias("_ord"), F.max_by("References", "ord").alias("_refs"))
    rest = [c for c in pubs.columns if c not in ("ord", "References", "Bibcode")]
    last = pubs.groupBy("Bibcode").agg(F.max_by(F.struct(*rest), "ord").alias("_p")) if rest else pubs.select("Bibcode").distinct()
    joined = last.join(once, "Bibcode")
    return joined.select(F.col("_ord").alias("ord"), "Bibcode", references(F.col("_refs")).alias("References"), *(F.col(f"_p.`{c}`").alias(c) for c in rest))


def _lists(pubs: DataFrame) -> DataFrame:
    """(paper, r): the ord, year and refs of each publication; of repeated keys the last row counts."""
    rows = pubs.select("Bibcode", "ord", F.col("Year").alias("year"), references(F.col("References")).alias("refs"))
    return rows.groupBy(F.col("Bibcode").alias("paper")).agg(F.max_by(F.struct("ord", "year", "refs"), "ord").alias("r"))


def mentions(pubs: DataFrame) -> DataFrame:
    """(ord, paper, year, pos, ref): a row for each reference of each publication; of repeated keys the last row counts."""
    return _lists(pubs).select("r.ord", "paper", "r.year", F.posexplode("r.refs").alias("pos", "ref"))


def distinct_mentions(pubs: DataFrame) -> DataFrame:
    """(paper, ref), each once: a paper is one row, so its list is made distinct where it is."""
    return _lists(pubs).select("paper", F.explode(F.array_distinct("r.refs")).alias("ref"))


def direct_edges(pubs: DataFrame) -> DataFrame:
    """graph_edges(direct_citations(pubs), directed=True), counted in each paper's sorted list, so that no task holds its edges."""
    rows = _lists(pubs).select(F.col("paper").alias("source"), F.col("r.year").alias("year"), F.array_sort("r.refs").alias("_refs")).where(F.size("_refs") > 0)
    new = lambda i: (i == 0) | (F.get("_refs", i) != F.get("_refs", i - 1))
    rows = rows.select("source", "year", "_refs", F.filter(F.sequence(F.lit(0), F.size("_refs") - 1), new).alias("_at"))
    ends = F.concat(F.slice("_at", F.lit(2), F.size("_at")), F.array(F.size("_refs")))
    runs = F.zip_with("_at", ends, lambda i, end: F.struct(F.get("_refs", i).alias("target"), (end - i).cast("long").alias("weight")))
    return rows.select("source", "year", F.explode(runs).alias("_e")).select("source", "_e.target", "year", "_e.weight")


#: Rows of a paper or work that are paired in one task; a group with more is cut into blocks of about so many.
BLOCK = 1000
#: Most tasks over which pairs of blocks are dealt.
MOST_TASKS = 20_000


def large_groups(rows: DataFrame, group: str) -> DataFrame | None:
    """(group, _blocks) of the groups of more than BLOCK rows, if there are any; rows should be cheap to read."""
    sizes = rows.groupBy(group).agg(F.count("*").alias("_n")).where(F.col("_n") > BLOCK)
    large = materialize(sizes.select(group, F.ceil(F.col("_n") / BLOCK).cast("int").alias("_blocks")), "large-groups")
    return None if large.isEmpty() else large


def pairs(left: DataFrame, right: DataFrame, group: str, condition: str, large: DataFrame | None) -> DataFrame:
    """left and right joined on a group, where a condition holds.

    A pair of rows of a large group is made by the task of their two blocks, so a group of any size is spread over as
    many tasks as it needs; other groups are joined as they are.
    """
    if large is None:
        return left.join(right, group).where(condition)
    own = lambda df: F.pmod(F.xxhash64(*(c for c in df.columns if c != "_blocks")), F.col("_blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
    a, b = left.join(large, group), right.join(large, group)
    # a number of its own, as few rows make many pairs and partitions would be joined again by their bytes
    tasks = min(MOST_TASKS, large.agg(F.sum(F.col("_blocks") * F.col("_blocks"))).first()[0])
    keys = [group, "_i", "_j"]
    a = a.select(*left.columns, own(a).alias("_i"), other.alias("_j")).repartition(tasks, *keys)
    b = b.select(*right.columns, own(b).alias("_j"), other.alias("_i")).repartition(tasks, *keys)
    blocked = a.join(b, keys).where(condition).drop("_i", "_j")
    rest = left.join(large, group, "left_anti").join(right.join(large, group, "left_anti"), group).where(condition)
    return rest.unionByName(blocked.select(rest.columns))


def _prune(edges: DataFrame, group: str, item: str, least: int) -> DataFrame:
    """Edges whose item occurs in at least so many distinct groups; rarer items cannot be in a qualifying pair."""
    if least <= 1:
        return edges
    often = edges.select(group, item).distinct().groupBy(item).agg(F.count("*").alias("_n")).where(F.col("_n") >= least).select(item)
    return edges.join(often, item, "left_semi")


def pair_counts(edges: DataFrame, group: str, item: str, least: int, large: DataFrame | None) -> DataFrame:
    """(source, target, n): canonical pairs of items that at least so many distinct groups share."""
    once = _prune(edges.select(group, item).distinct(), group, item, least)
    left, right = once.select(group, F.col(item).alias("source")), once.select(group, F.col(item).alias("target"))
    counts = pairs(left, right, group, "source < target", large).groupBy("source", "target").agg(F.count("*").alias("n"))
    return counts.where(F.col("n") >= least)


def _evidence(counts: DataFrame, edges: DataFrame, group: str, item: str, place: str) -> DataFrame:
    """(group, first, second): for each counted pair the edges of its items that share a group, as structs in the order of place.

    A pair starts from its rarer item, so the work follows the mentions of that item and not all pairs of a group.
    """
    sizes = edges.groupBy(F.col(item).alias("_i")).agg(F.count("*").alias("_n"))
    side = lambda name: sizes.select(F.col("_i").alias(name), F.col("_n").alias(f"_{name}"))
    rare = F.col("_source") <= F.col("_target")
    ends = counts.join(side("source"), "source").join(side("target"), "target").select(F.when(rare, F.col("source")).otherwise(F.col("target")).alias("_rare"), F.when(rare, F.col("target")).otherwise(F.col("source")).alias("_other"))
    whole = F.struct(*(F.col(c) for c in edges.columns))
    rows = ends.join(edges.select(F.col(item).alias("_rare"), F.col(group).alias("_g"), whole.alias("_x")), "_rare")
    rows = rows.join(edges.select(F.col(item).alias("_other"), F.col(group).alias("_g"), whole.alias("_y")), ["_g", "_other"])
    ahead = F.col(f"_x.{place}") < F.col(f"_y.{place}")
    return rows.select(F.col("_g").alias(group), F.when(ahead, F.col("_x")).otherwise(F.col("_y")).alias("first"), F.when(ahead, F.col("_y")).otherwise(F.col("_x")).alias("second"))


def _fewer_in_groups(counts: DataFrame, edges: DataFrame, group: str, item: str) -> bool:
    """Whether all pairs within groups are fewer rows than what counted pairs fetch from their rarer ends: so with few items of very many mentions."""
    within = edges.groupBy(group).count().agg(F.sum(F.col("count") * (F.col("count") - 1) / 2)).first()[0] or 0
    sizes = edges.groupBy(F.col(item).alias("_i")).agg(F.count("*").alias("_n"))
    side = lambda name: sizes.select(F.col("_i").alias(name), F.col("_n").alias(f"_{name}"))
    fetched = counts.join(side("source"), "source").join(side("target"), "target").agg(F.sum(F.least("_source", "_target"))).first()[0] or 0
    return within <= fetched


def direct_citations(pubs: DataFrame, min_count: int = 1, authors: list[str] | None = None) -> DataFrame:
    """(source, target, ref_index, year): a row for each mention of a work that is mentioned at least min_count times."""
    pubs = pubs.where(filters.authors_contain(F.col("Author"), authors)) if authors else pubs
    rows = mentions(pubs).select(F.col("paper").alias("source"), F.col("ref").alias("target"), F.col("pos").alias("ref_index"), "year")
    if min_count <= 1:
        return rows
    often = rows.groupBy("target").agg(F.count("*").alias("_n")).where(F.col("_n") >= min_count).select("target")
    return rows.join(often, "target", "left_semi").select("source", "target", "ref_index", "year")


def co_citations(pubs: DataFrame, min_count: int = 1) -> DataFrame:
    """(year, source, target, cocit_source): two works in one list, the earlier first; at least min_count papers cite both."""
    edges = materialize(mentions(pubs), "mentions")
    large = large_groups(edges, "paper")
    if min_count > 1:
        found = _evidence(pair_counts(edges, "paper", "ref", min_count, large), edges, "paper", "ref", "pos")
        return found.select("first.year", F.col("first.ref").alias("source"), F.col("second.ref").alias("target"), F.col("paper").alias("cocit_source"))
    left = edges.select("paper", "year", F.col("pos").alias("_a"), F.col("ref").alias("source"))
    right = edges.select("paper", F.col("pos").alias("_b"), F.col("ref").alias("target"))
    return pairs(left, right, "paper", "_a < _b and source != target", large).select("year", "source", "target", F.col("paper").alias("cocit_source"))


def coupling(pubs: DataFrame, min_shared: int = 1) -> DataFrame:
    """(year, source, target, shared_ref): two papers that cite a work, the earlier row first; the year is its year."""
    once = materialize(mentions(pubs).groupBy("paper", "ref").agg(F.min("ord").alias("ord"), F.first("year").alias("year")), "mentions")
    large = large_groups(once, "ref")
    if min_shared > 1:
        found = _evidence(pair_counts(once, "ref", "paper", min_shared, large), once, "ref", "paper", "ord")
        return found.select("first.year", F.col("first.paper").alias("source"), F.col("second.paper").alias("target"), F.col("ref").alias("shared_ref"))
    left = once.select("ref", F.col("ord").alias("_a"), F.col("paper").alias("source"), "year")
    right = once.select("ref", F.col("ord").alias("_b"), F.col("paper").alias("target"))
    return pairs(left, right, "ref", "_a < _b", large).select("year", "source", "target", F.col("ref").alias("shared_ref"))


#: Between names that travel as one text, and what stands before the number of a sign that a name itself holds.
_BETWEEN, _SIGN = "\x1f", "\x1b"


def _packed(names: Column) -> Column:
    """Names as one text; a name's own separators are written otherwise."""
    safe = lambda n: F.replace(F.replace(n, F.lit(_SIGN), F.lit(_SIGN + "1")), F.lit(_BETWEEN), F.lit(_SIGN + "0"))
    return F.array_join(F.transform(names, safe), _BETWEEN)


def _name(packed: Column) -> Column:
    """A name as it was before _packed."""
    plain = F.replace(F.replace(packed, F.lit(_SIGN + "0"), F.lit(_BETWEEN)), F.lit(_SIGN + "1"), F.lit(_SIGN))
    return F.when(F.contains(packed, F.lit(_SIGN)), plain).otherwise(packed)


def coupling_edges(pubs: DataFrame, min_shared: int = 1) -> DataFrame:
    """graph_edges(coupling(pubs, min_shared)), without a row for each piece of evidence on the way.

    Each paper is sent, for each work it cites, the names, as one text, of the later rows that cite it; a paper's lists meet
    in one place and are counted there.  The year of a pair is that of its earlier row, so years do not travel with names.  The
    number of works that two papers share is the weight of their edge, so a threshold needs no evidence.  A work's list is
    made once, where its mentions meet; one of very many mentions is listed in blocks, over many tasks.
    """
    rows = _lists(pubs).where("paper is not null").select("paper", "r.ord", "r.year", F.explode(F.array_distinct("r.refs")).alias("ref"))
    once = materialize(rows, "mentions")
    large = large_groups(once, "ref")
    small = once if large is None else once.join(large, "ref", "left_anti")
    all_ = F.array_sort(F.collect_list(F.struct("ord", "paper", "year"))).alias("_all")
    after = F.slice("_all", F.col("_at") + 2, F.size("_all"))
    each = small.groupBy("ref").agg(all_).where(F.size("_all") > 1).select("_all", F.posexplode("_all").alias("_at", "_own"))  # lists of at most BLOCK rows
    sent = each.select("_own.*", after.alias("_later"))
    if large is not None:
        sized = once.join(large, "ref")
        lists = sized.withColumn("_block", F.pmod(F.xxhash64("paper"), F.col("_blocks")).cast("int")).groupBy("ref", "_block").agg(all_.alias("_later"))  # about BLOCK rows
        spread = sized.withColumn("_block", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
        sent = sent.unionByName(spread.join(lists, ["ref", "_block"]).select("ord", "paper", "year", "_later"))
    later = F.filter("_later", lambda x: x["ord"] > F.col("ord"))
    sent = sent.select(F.col("paper").alias("source"), "year", later.alias("_later")).where(F.size("_later") > 0)
    sent = sent.select("source", "year", _packed(F.col("_later.paper")).alias("_to")).repartition(_tasks(once), "source")
    met = sent.select("source", "year", F.explode(F.split("_to", _BETWEEN, -1)).alias("target"))
    edges = met.groupBy("source", "target").agg(F.min("year").alias("year"), F.count("*").alias("weight"))
    edges = edges.where(F.col("weight") >= min_shared) if min_shared > 1 else edges
    target = _name(F.col("target"))
    return edges.select(F.least("source", target).alias("source"), F.greatest("source", target).alias("target"), "year", "weight")


def _tasks(once: DataFrame) -> int:
    """Tasks for what works send to papers: one for every 2 million pairs."""
    pairs_ = once.groupBy("ref").count().agg(F.sum(F.col("count") * (F.col("count") - 1) / 2)).first()[0] or 0
    return int(min(MOST_TASKS, max(1, -(-pairs_ // 2_000_000))))


def first_author_id(columns: list[str]) -> Column:
    """The first author id that is not blank, or else the first author's surname."""
    uid = F.try_element_at(F.filter("author_uids", lambda u: F.coalesce(strip(u), F.lit("")) != ""), F.lit(1)) if "author_uids" in columns else F.lit(None).cast("string")
    return F.coalesce(uid, surname(F.try_element_at("Author", F.lit(1))))


def first_author_label(columns: list[str]) -> Column:
    """The first display name that is not blank, or else the first author as written."""
    names = F.filter("author_display_names", lambda u: F.coalesce(strip(u), F.lit("")) != "") if "author_display_names" in columns else F.array().cast("array<string>")
    return F.coalesce(F.try_element_at(names, F.lit(1)), F.try_element_at("Author", F.lit(1)))


def reference_authors(refs: DataFrame) -> DataFrame:
    """(ref, author, label, ord) of each cited work; of repeated keys the last row counts."""
    rows = refs.select("ord", F.col("Bibcode").alias("ref"), first_author_id(refs.columns).alias("author"), first_author_label(refs.columns).alias("label"))
    return rows.groupBy("ref").agg(F.max_by(F.struct("author", "label", "ord"), "ord").alias("r")).select("ref", "r.*").where("author is not null")


def author_labels(refs: DataFrame, entities: DataFrame | None = None) -> DataFrame:
    """(author, label): the entity's name, the first label among the works, or the id."""
    seen = reference_authors(refs).groupBy("author").agg(F.min_by("label", "ord").alias("_seen"))
    if entities is None:
        return seen.select("author", F.coalesce("_seen", "author").alias("label"))
    named = entities.dropDuplicates(["author_uid"]).select(F.col("author_uid").alias("author"), F.col("author_display_name").alias("_name"))
    return seen.join(named, "author", "left").select("author", F.coalesce("_name", "_seen", "author").alias("label"))


def author_co_citations(pubs: DataFrame, refs: DataFrame, min_count: int = 1, entities: DataFrame | None = None) -> DataFrame:
    """(year, source, target, source_citation, source_label, target_label): two first authors whom one paper cites."""
    cited = mentions(pubs).where("year is not null").join(reference_authors(refs).select("ref", "author"), "ref").select("paper", "year", "author").distinct()
    cited = materialize(cited, "cited-authors")
    large = large_groups(cited, "paper")
    if min_count > 1:
        counts = materialize(pair_counts(cited, "paper", "author", min_count, large), "pair-counts")
        if _fewer_in_groups(counts, cited, "paper", "author"):
            left, right = cited.select("paper", F.struct(cited.columns).alias("first"), F.col("author").alias("source")), cited.select("paper", F.struct(cited.columns).alias("second"), F.col("author").alias("target"))
            found = pairs(left, right, "paper", "source < target", large).join(counts, ["source", "target"], "left_semi")
        else:
            found = _evidence(counts, cited, "paper", "author", "author")
        detail = found.select("first.year", F.col("first.author").alias("source"), F.col("second.author").alias("target"), F.col("paper").alias("source_citation"))
    else:
        left, right = cited.select("paper", "year", F.col("author").alias("source")), cited.select("paper", F.col("author").alias("target"))
        detail = pairs(left, right, "paper", "source < target", large).select("year", "source", "target", F.col("paper").alias("source_citation"))
    labels = author_labels(refs, entities)
    detail = detail.join(labels.select(F.col("author").alias("source"), F.col("label").alias("source_label")), "source")
    detail = detail.join(labels.select(F.col("author").alias("target"), F.col("label").alias("target_label")), "target")
    return detail.select("year", "source", "target", "source_citation", "source_label", "target_label")


def canonical(detail: DataFrame) -> DataFrame:
    """Undirected pairs with the smaller end first; labels swap with their ends, the year stays."""
    swap = F.col("source") > F.col("target")
    out = {"source": F.least("source", "target"), "target": F.greatest("source", "target")}
    if "source_label" in detail.columns:
        out["source_label"] = F.when(swap, F.col("target_label")).otherwise(F.col("source_label"))
        out["target_label"] = F.when(swap, F.col("source_label")).otherwise(F.col("target_label"))
    return detail.withColumns(out)


def graph_edges(detail: DataFrame, directed: bool = False) -> DataFrame:
    """(source, target[, labels], year, weight): evidence rows and least year of each pair."""
    rows = detail if directed else canonical(detail)
    keys = ["source", "target", *(c for c in ("source_label", "target_label") if c in rows.columns)]
    return rows.groupBy(*keys).agg(F.min("year").alias("year"), F.count("*").alias("weight"))


def graph_nodes(pubs: DataFrame, refs: DataFrame) -> DataFrame:
    """Rows of both tables under `id`; of repeated keys the first, publications before cited works."""
    both = pubs.withColumn("_src", F.lit(0)).unionByName(refs.withColumn("_src", F.lit(1)), allowMissingColumns=True)
    first = Window.partitionBy("Bibcode").orderBy("_src", "ord")
    rows = both.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n", "_src", "ord")
    return rows.withColumnRenamed("Bibcode", "id")


def endpoints(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("source").alias("id")).union(edges.select(F.col("target").alias("id"))).distinct()


def nodes_in_edges(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    return nodes.join(endpoints(edges), "id", "left_semi")


def author_nodes(edges: DataFrame, entities: DataFrame | None = None) -> DataFrame:
    """A node for each author in the edges, with what is known of the author; label: entity, edge label or id."""
    ends = edges.select(F.col("source").alias("id"), F.col("source_label").alias("_l")).union(edges.select(F.col("target").alias("id"), F.col("target_label").alias("_l")))
    ends = ends.groupBy("id").agg(F.min("_l").alias("_label"))
    if entities is None:
        return ends.select("id", F.col("id").alias("author_uid"), F.coalesce("_label", "id").alias("label"))
    known = entities.dropDuplicates(["author_uid"])
    joined = ends.join(known, ends["id"] == known["author_uid"], "left")
    rest = [c for c in known.columns if c not in ("author_uid", "label")]
    return joined.select("id", F.col("id").alias("author_uid"), *rest, F.coalesce("author_display_name", "_label", "id").alias("label"))


def with_edge_ids(detail: DataFrame, order: list[str]) -> DataFrame:
    """detail with `id`, 0, 1, ... in an order."""
    return numbered(detail, order)


def has_distinct_evidence(detail: DataFrame, edges: DataFrame) -> bool:
    """Whether evidence says more than the graph: other columns, or another number of rows."""
    return set(detail.columns) - {"id"} != set(edges.columns) - {"id"} or detail.count() != edges.count()


METRICS = ("direct", "co_citation", "bibliographic_coupling", "author_co_citation")


def citation_networks(pubs: DataFrame, refs: DataFrame, metrics: tuple[str, ...] = METRICS, min_counts: dict[str, int] | None = None,
                      entities: DataFrame | None = None, inputs: DataFrame | None = None, **selection) -> dict[str, dict[str, DataFrame]]:
    """For each metric with edges its evidence, graph edges and nodes, after alignment and filters; nothing is written."""
    unknown = set(metrics) - set(METRICS)
    if unknown:
        raise ValueError(f"unknown metrics: {', '.join(sorted(unknown))}")
    least = {m: 1 for m in METRICS} | (min_counts or {})
    if inputs is not None:
        pubs = align(pubs, inputs)
    pubs = filters.filter_corpus(pubs, refs, **selection)
    build = {
        "direct": lambda: direct_citations(pubs, least["direct"]), "co_citation": lambda: co_citations(pubs, least["co_citation"]),
        "bibliographic_coupling": lambda: coupling(pubs, least["bibliographic_coupling"]),
        "author_co_citation": lambda: author_co_citations(pubs, refs, least["author_co_citation"], entities),
    }
    nodes, out = graph_nodes(pubs, refs), {}
    for metric in metrics:
        detail = build[metric]()
        if detail.isEmpty():
            continue
        edges = graph_edges(detail, directed=metric == "direct")
        own = author_nodes(edges, entities) if metric == "author_co_citation" else nodes_in_edges(nodes, edges)
        out[metric] = {"evidence": detail, "edges": edges, "nodes": own}
    return out
