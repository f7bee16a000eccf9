"""Citation networks on small tables: thresholds, nulls, repeats, orders and filters."""

import pytest
from pyspark.sql import functions as F

from citeloom.operators import filters, networks

PUBS = "ord int, Bibcode string, Year int, Author array<string>, References array<string>, author_uids array<string>"
REFS = "ord int, Bibcode string, Author array<string>, author_uids array<string>, author_display_names array<string>"


def pubs(spark, rows):
    return spark.createDataFrame(rows, PUBS)


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


@pytest.fixture(scope="module")
def three(spark):
    return pubs(spark, [
        (1, "p1", 2020, ["Hawking, S"], ["r1", "r2"], ["u1"]), (2, "p2", 2021, ["Penrose, R"], ["r1", "r2", "", None], [None]), (3, "p3", 2022, ["Borz, A"], ["r3"], None)])


def test_direct_positions_and_threshold(three):
    assert rows(networks.direct_citations(three), "source", "target", "ref_index") == [("p1", "r1", 0), ("p1", "r2", 1), ("p2", "r1", 0), ("p2", "r2", 1), ("p3", "r3", 0)]
    assert {r[1] for r in rows(networks.direct_citations(three, 2), "source", "target")} == {"r1", "r2"}
    assert rows(networks.direct_citations(three, authors=["hawk"]), "source", "target") == [("p1", "r1"), ("p1", "r2")]


def test_co_citation_needs_distinct_papers(spark, three):
    assert rows(networks.co_citations(three, 2), "source", "target", "cocit_source") == [("r1", "r2", "p1"), ("r1", "r2", "p2")]
    assert rows(networks.graph_edges(networks.co_citations(three)), "source", "target", "year", "weight") == [("r1", "r2", 2020, 2)]
    twice = pubs(spark, [(1, "p", 2000, [], ["b", "a", "b"], None)])
    assert rows(networks.co_citations(twice), "source", "target") == [("a", "b"), ("b", "a")]  # never with itself
    assert networks.co_citations(twice, 2).count() == 0
    assert rows(networks.graph_edges(networks.co_citations(twice)), "source", "target", "weight") == [("a", "b", 2)]


def test_coupling_orientation(spark, three):
    assert rows(networks.graph_edges(networks.coupling(three, 2)), "source", "target", "year", "weight") == [("p1", "p2", 2020, 2)]
    late = pubs(spark, [(1, "z", 2005, [], ["r"], None), (2, "a", 1999, [], ["r"], None)])
    assert rows(networks.coupling(late), "source", "target", "year") == [("z", "a", 2005)]
    assert rows(networks.graph_edges(networks.coupling(late)), "source", "target", "year") == [("a", "z", 2005)]


def test_author_co_citation_labels(spark, three):
    refs = spark.createDataFrame([(1, "r1", ["Borz, A"], [], []), (2, "r2", ["Ann Miller"], ["", "u9"], ["", "A. Miller"])], REFS)
    detail = networks.author_co_citations(three, refs)
    assert rows(networks.graph_edges(detail), "source", "target", "source_label", "target_label", "weight") == [("Borz", "u9", "Borz, A", "A. Miller", 2)]
    entities = spark.createDataFrame([("u9", "Miller")], "author_uid string, author_display_name string")
    assert rows(networks.author_co_citations(three, refs, entities=entities), "target_label") == [("Miller",), ("Miller",)]
    nodes = networks.author_nodes(networks.graph_edges(detail), entities)
    assert rows(nodes, "id", "label") == [("Borz", "Borz, A"), ("u9", "Miller")]
    no_year = pubs(spark, [(1, "p", None, [], ["r1", "r2"], None)])
    assert networks.author_co_citations(no_year, refs).count() == 0 and networks.co_citations(no_year).count() == 1


def test_empty_tables_keep_their_columns(spark):
    none = pubs(spark, [])
    refs = spark.createDataFrame([], REFS)
    for df in (networks.direct_citations(none), networks.co_citations(none, 2), networks.coupling(none, 2), networks.author_co_citations(none, refs, 2)):
        assert df.count() == 0 and {"source", "target", "year"} <= set(df.columns)


def test_exclusion_comes_before_pairs(spark):
    p = pubs(spark, [(1, "p1", 2020, ["A"], ["r1", "r2", "r3"], None)])
    refs = spark.createDataFrame([(1, "r1", ["Hawking, S"], ["x"], []), (2, "r2", ["B"], [], []), (3, "r3", ["C"], [], [])], REFS)
    out = networks.citation_networks(p, refs, ("direct", "co_citation", "bibliographic_coupling"), exclude_authors=["hawking"])
    assert rows(out["co_citation"]["edges"], "source", "target", "year", "weight") == [("r2", "r3", 2020, 1)]
    assert set(out) == {"direct", "co_citation"}  # metrics without edges are left out
    assert {r[0] for r in rows(out["direct"]["nodes"], "id")} == {"p1", "r2", "r3"}


def test_filters_by_id(spark, three):
    assert rows(three.where(filters.citing_filter(None, ["u1"], three.columns)), "Bibcode") == [("p1",)]
    assert rows(three.where(filters.citing_filter(["^pen", "borz"], ["u1"], three.columns)), "Bibcode") == [("p1",), ("p2",), ("p3",)]
    with pytest.raises(ValueError, match="author_uids"):
        filters.citing_filter(None, ["u1"], ["Author"])


def test_align_takes_first_place_and_last_list(spark, three):
    given = spark.createDataFrame([(0, "p3", ["a"]), (1, "p1", ["b"]), (2, "p3", ["c"]), (3, "gone", ["d"])], "ord int, Bibcode string, References array<string>")
    out = networks.align(three, given).orderBy("ord").collect()
    assert [(r["Bibcode"], r["References"]) for r in out] == [("p3", ["c"]), ("p1", ["b"])]


def test_edge_ids(spark, three):
    out = networks.with_edge_ids(networks.direct_citations(three), ["source", "ref_index"]).orderBy("id").collect()
    assert [(r["id"], r["source"], r["ref_index"]) for r in out] == [(0, "p1", 0), (1, "p1", 1), (2, "p2", 0), (3, "p2", 1), (4, "p3", 0)]


def test_row_order_and_partitions_do_not_matter(spark, small):
    from citeloom import queries as q

    p = q.publications(spark, small)
    one = rows(networks.graph_edges(networks.coupling(p, 2)), "source", "target", "year", "weight")
    assert one == rows(networks.graph_edges(networks.coupling(p.repartition(7, "Year"), 2)), "source", "target", "year", "weight")
    assert all(r[3] >= 2 for r in one)


def test_pushdown_and_pruning(spark, small):
    from citeloom import queries as q

    plan = q.table(spark, small, "orders").where("o_orderkey > 10").select("o_orderkey")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderkey), GreaterThan(o_orderkey,10)]" in plan and "ReadSchema: struct<o_orderkey:bigint>" in plan


def test_large_groups_are_paired_in_blocks(spark, monkeypatch):
    """One work that very many papers cite, and one paper with very many references, give the same rows in blocks."""
    monkeypatch.setattr(networks, "BLOCK", 7)
    papers = [(i, f"p{i:03d}", 2000 + i % 3, [f"A{i % 4}, B"], ["hot"] + [f"r{i % 9}", f"r{(i * 5) % 11}"]) for i in range(60)]
    papers.append((60, "p060", 2000, ["Z"], [f"r{k}" for k in range(30)] + ["hot", "hot"]))
    pubs = spark.createDataFrame(papers, "ord int, Bibcode string, Year int, Author array<string>, References array<string>")
    refs = spark.createDataFrame([(k, f"r{k}", [f"C{k % 6}, D"]) for k in range(30)] + [(99, "hot", ["Hot, H"])], "ord int, Bibcode string, Author array<string>")
    rows = lambda df: sorted(map(str, df.select(sorted(df.columns)).collect()))
    build = [lambda n: networks.co_citations(pubs, n), lambda n: networks.coupling(pubs, n), lambda n: networks.author_co_citations(pubs, refs, n)]
    for make in build:
        for least in (1, 2):
            blocked = rows(make(least))
            monkeypatch.setattr(networks, "BLOCK", 10**6)
            assert blocked == rows(make(least)) and blocked
            monkeypatch.setattr(networks, "BLOCK", 7)
    once = networks.mentions(pubs).select("paper", "ref").distinct()
    large = networks.large_groups(once, "ref")
    assert {r["ref"]: r["_blocks"] for r in large.where("ref = 'hot'").collect()} == {"hot": 9}


def test_a_work_in_very_many_papers_is_spread_over_tasks(spark):
    pubs = spark.range(4000).selectExpr("id as ord", "cast(id as string) as Bibcode", "2000 as Year", "array('A') as Author", "array('hot', cast(id as string)) as References")
    detail = networks.coupling(pubs)
    made = detail.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()
    counts = sorted(r["n"] for r in made)
    assert sum(counts) == 4000 * 3999 // 2 and len(counts) > 2 and counts[-1] <= 5 * counts[len(counts) // 2]


def test_numbering_is_gapless_in_order(spark):
    from citeloom.plans.written import numbered

    df = spark.range(1000).selectExpr("id % 37 as a", "id as b").repartition(7)
    out = [(r["a"], r["b"], r["id"]) for r in numbered(df, ["a", "b"]).collect()]
    assert sorted(out) == [(a, b, k) for k, (a, b) in enumerate(sorted((i % 37, i) for i in range(1000)))]
    assert numbered(df.limit(0), ["a", "b"]).count() == 0


def test_coupling_edges_are_the_graph_of_the_evidence(spark, small, monkeypatch):
    from citeloom import queries as own

    pubs = own.publications(spark, small)
    for least in (1, 2):
        want = sorted(map(tuple, networks.graph_edges(networks.coupling(pubs, least)).collect()))
        for block in (1000, 5):
            monkeypatch.setattr(networks, "BLOCK", block)
            assert sorted(map(tuple, networks.coupling_edges(pubs, least).collect())) == want and want
        monkeypatch.setattr(networks, "BLOCK", 1000)


def test_coupling_edges_send_lists_and_not_pairs(spark, small):
    from citeloom import queries as own

    plan = own.queries()["coupling_min_shared2"](spark, small)._jdf.queryExecution().executedPlan().toString()
    counted = plan[: plan.index("Generate explode")]  # pairs do not move once they are rows
    assert "HashAggregate(keys=[source" in counted and "Exchange" not in counted


def test_edges_and_distinct_mentions_of_lists(spark):
    """Counted in each list, they are those of all mentions; no grouping holds the edges of a task."""
    rows = [(1, "a", 2000, ["x", "y", "x", None, "", "z", "x"]), (2, "b", None, ["y"]), (3, "c", 2001, []), (4, "d", 2002, None), (5, "a", 2003, ["y", "q", "y"]), (6, None, 2004, ["é", "z", "é"])]
    pubs = spark.createDataFrame(rows, "ord long, Bibcode string, Year int, References array<string>")
    got, want = networks.direct_edges(pubs), networks.graph_edges(networks.direct_citations(pubs), directed=True)
    assert got.columns == want.columns and dict(got.dtypes) == dict(want.dtypes)
    assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str) and ("a", "y", 2003, 2) in {tuple(r) for r in got.collect()}
    assert sorted(networks.distinct_mentions(pubs).collect(), key=str) == sorted(networks.mentions(pubs).select("paper", "ref").distinct().collect(), key=str)
    assert "HashAggregate(keys=[source" not in got._jdf.queryExecution().executedPlan().toString()


def test_few_authors_of_many_mentions_are_paired_within_papers(spark, monkeypatch):
    pubs = spark.createDataFrame([(k, f"p{k}", 2000 + k % 3, [f"w{k % 4}", f"w{(k + 1) % 4}", f"w{k % 3}"]) for k in range(60)], "ord long, Bibcode string, Year int, References array<string>")
    works = spark.createDataFrame([(k, f"w{k}", [f"Name{k % 3}, A."]) for k in range(4)], "ord long, Bibcode string, Author array<string>")
    asked, fewer = [], networks._fewer_in_groups
    monkeypatch.setattr(networks, "_fewer_in_groups", lambda *a: asked.append(fewer(*a)) or asked[-1])
    got = sorted(networks.author_co_citations(pubs, works, 2).collect())
    monkeypatch.setattr(networks, "_fewer_in_groups", lambda *a: False)
    assert asked == [True] and got and got == sorted(networks.author_co_citations(pubs, works, 2).collect())


def test_coupling_edges_send_names_as_one_text(spark, monkeypatch):
    """Names of any signs, years that are missing, and rows of one ord give the graph of the evidence; a work's list meets no join."""
    odd = ["", "\x1f", "\x1b0", "\x1b1", "a\x1fb", "\x1b\x1f", "é", "z", "10", "9"]
    rows = [(k % 7, name, None if k % 4 == 1 else 2000 - k, [f"r{j}" for j in range(k % 5 + 2)] + ["r0", ""]) for k, name in enumerate(odd)]
    pubs = spark.createDataFrame(rows, "ord long, Bibcode string, Year int, References array<string>")
    for block in (1000, 3):
        monkeypatch.setattr(networks, "BLOCK", block)
        for least in (1, 2, 4):
            want = networks.graph_edges(networks.coupling(pubs)).where(F.col("weight") >= least)
            got = networks.coupling_edges(pubs, least)
            assert got.columns == want.columns and dict(got.dtypes) == dict(want.dtypes)
            assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str) and got.count() > 5
    monkeypatch.setattr(networks, "BLOCK", 1000)
    plan = networks.coupling_edges(pubs)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "split(_to" in plan
