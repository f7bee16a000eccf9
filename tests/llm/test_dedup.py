"""Exact, near and suffix dedup, fingerprints, chat windows and the pipeline against brute force."""

import hashlib
import math
import os
import random
import re

import duckdb
import pytest

from citeloom.llm import chat, exact_dedup, fingerprints, graph, near_dedup, queries, suffix_dedup
from citeloom.llm.suffix_array import suffix_array

SPACES = re.compile(r"[\x20\x09-\x0D]+")


def documents(spark, folder="/root/testdata/sf0.01"):
    return spark.read.parquet(f"{folder}/documents.parquet")


def first(doc):
    return (doc is not None, doc or 0)


def test_exact_against_sql(spark):
    folder = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{folder}/documents.parquet'")
    rel = con.sql(queries.oracle_sql()["op10_exact_dedup"])
    order = sorted(rel.columns)
    df = queries.queries()["op10_exact_dedup"](spark, folder)
    assert sorted(map(tuple, df.select(order).collect())) == sorted(tuple(r[rel.columns.index(c)] for c in order) for r in rel.fetchall())


def test_exact_on_odd_rows(spark, odd, none):
    rows = exact_dedup.exact_dedup(odd).collect()
    assert len(rows) == odd.count()
    by = {(r["doc_id"], r["text_sha256"]): r for r in rows}
    empty = hashlib.sha256(b"").hexdigest()
    # null, empty and blank texts are one group; the longest stays
    assert {by[k, empty]["keep_id"] for k in (0, 1, 2)} == {2} and by[0, empty]["group_size"] == 3
    same = [r for r in rows if r["doc_id"] in (13, 14, 15)]
    assert {r["keep_id"] for r in same} == {15} and {r["group_size"] for r in same} == {3}
    assert [r["group_size"] for r in rows if r["doc_id"] == 3] == [3, 3, 3]
    assert exact_dedup.exact_dedup(none).count() == 0
    assert exact_dedup.keep_first_copies(odd).columns == odd.columns


def test_cuckoo_index():
    rng = random.Random(4)
    index, live = exact_dedup.CuckooIndex(buckets=4), {}
    for step in range(6000):
        digest = hashlib.sha256(str(rng.randint(0, 1500)).encode()).digest()
        if digest in live and rng.random() < 0.5:
            assert index.delete(digest)
            del live[digest]
        elif digest not in live:
            index.insert(digest, [step])
            live[digest] = [step]
    assert index.resizes > 3 and index.size == len(live)
    assert dict(index.items()) == live and all(index.get(d) == v for d, v in live.items())
    assert not index.delete(b"\0" * 32) and index.get(b"\1" * 32) is None


def shingle_set(text):
    low = (text or "").translate({i: i + 32 for i in range(65, 91)})
    w = [x for x in SPACES.split(low) if x]
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_components(rows, per_cent=85):
    sets = {i: shingle_set(t) for i, t in rows}
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    holders = {}
    for i in ids:
        seen = {}
        for s in sets[i]:
            for j in holders.setdefault(s, []):
                seen[j] = seen.get(j, 0) + 1
            holders[s].append(i)
        for j, n in seen.items():
            if 100 * n >= per_cent * (len(sets[i]) + len(sets[j]) - n) and root(i) != root(j):
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), root(i), root(i) == i) for i in ids}


def test_near_against_brute_force(spark):
    docs = documents(spark)
    want = brute_components([(r["doc_id"], r["text"]) for r in docs.collect()])
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in near_dedup.near_dedup(docs).collect()}
    assert got == want


def test_near_finds_planted_chains_and_long_lists(spark, monkeypatch):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("bcdfgaeiou") for _ in range(6))
    base = [word() for _ in range(120)]
    rows = []
    for i in range(60):  # each copy differs from the base in another place: many links, some pairs below the threshold
        own = list(base)
        for at in rng.sample(range(120), rng.choice([1, 1, 2, 3])):
            own[at] = word()
        rows.append((i, " ".join(own)))
    rows += [(100 + i, " ".join(word() for _ in range(80))) for i in range(20)]
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for per_cent in (85, 92):
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in near_dedup.near_dedup(df, per_cent).collect()}
        assert got == brute_components(rows, per_cent)


def test_near_thresholds_set_the_matches():
    assert near_dedup.matches(85) == (41, 40)  # the form that the registered query was measured with
    for per_cent in range(17, 101):
        least, tokens = near_dedup.matches(per_cent)
        share = per_cent / 100
        missed = sum(math.comb(64, k) * share**k * (1 - share) ** (64 - k) for k in range(least))
        assert missed <= 1e-5 and 1 <= least - (64 - tokens) and tokens <= 64
    for per_cent in (0, 16, 101):
        with pytest.raises(ValueError):
            near_dedup.matches(per_cent)


def test_near_against_brute_force_at_lower_thresholds(spark):
    rng = random.Random(60)
    rows = []
    for k in range(150):  # pairs of sets with a similarity at the threshold, or just above it
        base = [f"w{rng.randint(0, 10**9)}" for _ in range(604)]
        rows += [(2 * k + side, " ".join(base + [f"v{rng.randint(0, 10**9)}" for _ in range(200)])) for side in (0, 1)]
    docs = documents(spark)
    for per_cent, df in ((60, spark.createDataFrame(rows, "doc_id long, text string")), (80, docs)):
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in near_dedup.near_dedup(df, per_cent).collect()}
        assert got == brute_components([(r["doc_id"], r["text"]) for r in df.collect()], per_cent)
    assert sum(kept for _, _, kept in brute_components(rows, 60).values()) == 150


def test_another_text_under_the_id_of_a_copy_stays(spark):
    copied, alone = (" ".join(f"{letter}{k}" for k in range(40)) for letter in "bc")
    rows = [(3, copied), (5, alone), (5, copied), (7, None), (7, copied)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = {(3, copied), (5, alone), (7, None)}  # texts without words are no copies of each other in the near stage
    assert set(map(tuple, exact_dedup.keep_first_copies(df).collect())) == want
    assert set(map(tuple, near_dedup.keep_one_of_each(df).collect())) == want
    # both texts of 5 are the first of their class, and one of them is a near copy of 3's
    near = copied.rsplit(" ", 1)[0]
    df = spark.createDataFrame([(3, near), (5, alone), (5, copied), (9, alone + " x")], "doc_id long, text string")
    assert set(map(tuple, near_dedup.keep_one_of_each(df).collect())) == {(3, near), (5, alone)}


def untidy_rows(seed):
    """Rows with repeated and missing ids, repeated rows, copies, near copies and texts without words."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("bcdfgaeiou") for _ in range(5))
    bases = [[word() for _ in range(60)] for _ in range(6)]
    rows = []
    for _ in range(120):
        own = list(rng.choice(bases))
        for at in rng.sample(range(60), rng.choice([0, 0, 1, 1, 2])):
            own[at] = word()
        text = rng.choice([" ".join(own), " ".join(own) + " ", "  ".join(own[:30]) + " " + " ".join(own[30:]), "", " ", None, " ".join(own[:3])])
        rows.append((rng.choice([None, *range(1, 40)]), text))
    return rows + rows[:15] + [(None, "some text"), (None, "some text"), (7, "some text"), (7, "some text")]


def named_rows(spark, rows):
    """The rows as a table with clashing columns, and the hash of the text of each."""
    from citeloom.llm import common

    df = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "doc_id long, text string, own long")
    own = {(r["doc_id"], r["text"]): r["h"] for r in df.select("doc_id", "text", common.own_text(df).alias("h")).collect()}
    return df.selectExpr("doc_id", "text", "own", "'x' as kept", "1 as rep", "2 as _gone", "3 as single", "4 as lead"), own


def test_exact_stage_keeps_one_row_of_each_text(spark):
    rows = untidy_rows(1)
    df, own = named_rows(spark, rows)
    groups = {}
    for r in rows:
        groups.setdefault(SPACES.sub("", r[1] or ""), []).append(r)
    rank = lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0, own[r])
    want = sorted((min(g, key=rank) for g in groups.values()), key=str)
    out = exact_dedup.keep_first_copies(df)
    assert out.columns == df.columns
    assert sorted(map(tuple, out.select("doc_id", "text").collect()), key=str) == want


def test_exact_groups_are_whole_where_indexes_flush_and_texts_are_hot(spark, monkeypatch):
    rows = untidy_rows(2)
    df, _ = named_rows(spark, rows)
    want = as_rows(exact_dedup.exact_dedup(df))
    monkeypatch.setattr(exact_dedup, "HOT_COPIES", 3)
    monkeypatch.setattr(exact_dedup, "INDEX_DIGESTS", 5)
    assert as_rows(exact_dedup.exact_dedup(df)) == want
    sizes = {}
    for _, t in rows:
        sizes[SPACES.sub("", t or "")] = sizes.get(SPACES.sub("", t or ""), 0) + 1
    assert max(sizes.values()) > 3 and sorted(r["group_size"] for r in exact_dedup.exact_dedup(df).collect()) == sorted(n for n in sizes.values() for _ in range(n))


@pytest.mark.parametrize("per_cent", [80, 85])
def test_near_stage_keeps_one_row_of_each_component(spark, per_cent):
    rows = untidy_rows(3)
    df, own = named_rows(spark, rows)
    found = brute_components(list(enumerate(t for _, t in rows)), per_cent)
    rank = lambda k: (rows[k][0] is None, rows[k][0] or 0, own[rows[k]])
    components = {}
    for k, (n, component, _) in found.items():
        components.setdefault(component if n else (k,), []).append(k)
    want = sorted((rows[min(c, key=rank)] for c in components.values()), key=str)
    out = near_dedup.keep_one_of_each(df, per_cent)
    assert out.columns == df.columns
    assert sorted(map(tuple, out.select("doc_id", "text").collect()), key=str) == want


def test_near_lists_are_joined_by_their_own_index(monkeypatch):
    """Postings give the same pairs as comparing each with each, and compare far fewer that agree in one token alone."""
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(3)
    n, least = 300, 41
    signature = rng.integers(0, 1 << 32, (n, 64), dtype=np.uint32)
    signature[:, 5] = 7  # one token that all hold
    for k in range(0, 60, 3):  # and some that agree in 38 to 50 coordinates
        at = rng.choice(64, rng.integers(38, 51), replace=False)
        signature[k + 1, at] = signature[k, at]
        signature[k + 2, at] = signature[k, at]
    for side in (np.zeros(n, np.int32), np.where(np.arange(n) % 2, 1, -1).astype(np.int32)):
        table = pa.table({"n_shingles": np.full(n, 100), "side": side, "signature": pa.array([s.tobytes() for s in signature], pa.binary())})
        found = []
        for dense in (10**6, 0):
            monkeypatch.setattr(near_dedup, "DENSE", dense)
            found.append({tuple(sorted((i, int(j)))) for i, others in near_dedup._candidates(table, 85, least, near_dedup.Forest(n)) for j in others})
        want = {(i, j) for i in range(n) for j in range(i + 1, n) if (signature[i] == signature[j]).sum() >= least and (not side.any() or side[i] != side[j])}
        assert found[0] == found[1] == want and want
    holders, at, tokens, own = near_dedup._postings(signature, least)
    assert sum(len(holders[at[t] : at[t + 1]]) for t in tokens.tolist()) < n * 5


def test_near_on_odd_rows(spark, odd, none):
    rows = {(r["doc_id"], r["n_shingles"]): r for r in near_dedup.near_dedup(odd).collect()}
    assert all(rows[k, 0]["component_id"] == k and rows[k, 0]["kept"] for k in (0, 1, 2))
    assert rows[4, 1]["kept"] and rows[13, 5]["kept"] and not rows[14, 5]["kept"] and rows[15, 5]["component_id"] == 13
    assert near_dedup.near_dedup(none).count() == 0
    assert near_dedup.keep_one_of_each(odd).columns == odd.columns


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 4), (10, 11), (11, 12), (12, 10), (5, 5), (20, 4)] + [(100 + i, 101 + i) for i in range(40)]
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 20: 1, 10: 10, 11: 10, 12: 10} | {100 + i: 100 for i in range(41)}


def test_components_with_nodes_of_many_edges(spark):
    edges = [(1, 100 + i) for i in range(60)] + [(500, 200 + i) for i in range(60)] + [(130, 230), (700 + 1, 700), (701, 702)]
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {1: 1, 500: 1} | {100 + i: 1 for i in range(60)} | {200 + i: 1 for i in range(60)} | {700: 700, 701: 700, 702: 700}


def test_components_are_never_left_unfinished(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(100)], "a long, b long")
    with pytest.raises(RuntimeError):
        graph.components(edges, rounds=1)
    assert {r["component"] for r in graph.components(edges).collect()} == {0}


def brute_repeats(rows, width=100):
    seen, out = set(), []
    for doc, text in sorted(rows, key=lambda r: (first(r[0]), r[1] or "")):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - width + 1):
            w = raw[p : p + width]
            if w in seen:
                gone[p : p + width] = b"\1" * width
            else:
                seen.add(w)
        kept = bytes(c for c, g in zip(raw, gone) if not g)
        spans = sum(1 for k in range(len(gone)) if gone[k] and not (k and gone[k - 1]))
        out.append((doc, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def as_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_written_tables_can_be_cleared(spark):
    from citeloom.llm import common

    held = common.materialize(spark.range(3).toDF("x"), "test")
    assert held.count() == 3 and common.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    path = held.inputFiles()[0].removeprefix("file://").removeprefix("file:")
    common.clear(spark)
    assert not os.path.exists(path)


def test_suffix_array_is_sorted():
    rng = random.Random(0)
    for _ in range(1500):
        s = [rng.randint(1, rng.choice([1, 2, 3, 9])) for _ in range(rng.randint(0, 40))] + [0]
        assert suffix_array(s) == sorted(range(len(s)), key=lambda i: s[i:])


def test_suffix_against_brute_force(spark):
    docs = documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert as_rows(suffix_dedup.remove_repeats(docs)) == brute_repeats(rows)


def test_suffix_on_odd_rows_and_edges(spark, odd, none, monkeypatch):
    rng = random.Random(9)
    text = lambda n: "".join(rng.choice("abc é") for _ in range(n))
    shared, once = text(300), text(130)
    rows = [(i, text(rng.randint(0, 90)) + shared[rng.randint(0, 60) : rng.randint(150, 300)] + text(rng.randint(0, 40)) + once[: rng.randint(90, 130)]) for i in range(60)]
    rows += [(100, "xyz" * 200), (101, "a" * 700), (102, shared + shared), (None, shared), (5, shared), (5, shared), (103, text(9000) + shared)]
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 4096)
    monkeypatch.setattr(suffix_dedup, "PASS", 2048)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_repeats(rows)
    assert as_rows(suffix_dedup.remove_repeats(df)) == want
    for hot in (1, 3):
        monkeypatch.setattr(suffix_dedup, "HOT_CONTEXTS", hot)
        assert as_rows(suffix_dedup.remove_repeats(df)) == want
    monkeypatch.setattr(suffix_dedup, "MANY_BLOCKS", 2)  # larger blocks beyond a number of them
    assert as_rows(suffix_dedup.remove_repeats(df)) == want
    assert as_rows(suffix_dedup.remove_repeats(odd)) == brute_repeats([(r["doc_id"], r["text"]) for r in odd.collect()])
    assert suffix_dedup.remove_repeats(none).count() == 0
    out = suffix_dedup.without_repeats(odd)
    assert out.columns == odd.columns and out.count() == odd.count() and suffix_dedup.without_repeats(none).count() == 0


def test_suffix_stage_keeps_every_row_with_what_is_left_of_its_text(spark):
    rng = random.Random(12)
    text = lambda n: "".join(rng.choice("abcdefé ") for _ in range(n))
    shared = text(250)
    rows = [(i, text(20) + shared[rng.randint(0, 50) :] + text(30)) for i in range(20)] + [(30, shared), (30, shared), (31, None), (32, ""), (None, shared + text(5)), (5, text(300))]
    df = spark.createDataFrame([(*r, f"s{k}", len(r[1] or "")) for k, r in enumerate(rows)], "doc_id long, text string, source string, n_chars long").selectExpr("*", "1 as block", "2 as has_id", "3 as place", "'x' as kept")
    out = suffix_dedup.without_repeats(df)
    assert out.columns == df.columns and out.schema["n_chars"].dataType == df.schema["n_chars"].dataType
    seen, want = set(), []
    for doc, t in sorted(rows, key=lambda r: (first(r[0]), r[1] or "")):
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - 99):
            if raw[p : p + 100] in seen:
                gone[p : p + 100] = b"\1" * 100
            seen.add(raw[p : p + 100])
        left = bytes(c for c, g in zip(raw, gone) if not g).decode("utf-8", "ignore")
        want.append((str(doc), left, len(left)))
    assert sorted((str(r["doc_id"]), r["text"], r["n_chars"]) for r in out.collect()) == sorted(want)
    assert sorted(r["source"] for r in out.collect()) == sorted(f"s{k}" for k in range(len(rows)))


def test_fingerprints(spark, odd, none):
    import xxhash

    rows = [(r["doc_id"], r["text"] or "") for r in odd.collect()]
    order = sorted(rows, key=lambda r: (first(r[0]), r[1]))
    got = sorted(fingerprints.fingerprint_documents(odd).collect(), key=lambda r: (first(r["doc_id"]), r["n_chars"]))
    assert len(got) == len(rows)
    nexts = {k: order[(k + 1) % len(order)][1] for k in range(len(order))}
    want = {}
    for k, (doc, text) in enumerate(order):
        q = len(text) // 4
        edited = text[: len(text) - q] + nexts[k][:q]
        want.setdefault(doc, []).append((len(text), hashlib.sha256(edited.encode()).hexdigest()))
    for r in got:
        assert (r["n_chars"], r["edited_sha256"]) in want[r["doc_id"]] and 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    def brute(text):
        w = [x for x in SPACES.split(text.lower()) if x]
        runs = [w[i : i + 5] for i in range(max(len(w) - 4, 1))] if w else []
        out = set()
        for run in runs:
            h = 42
            for x in run:
                h = xxhash.xxh64_intdigest(x.encode(), seed=h)
            out.add(h & 0xFFFFFFFF)
        small = sorted(h for h in out if h < (1 << 32) // 8)
        return small if len(small) >= 16 else sorted(out)[:16]
    by = {(r["doc_id"], r["n_chars"]): r["fingerprint"] for r in got}
    for doc, text in rows:
        if text.isascii():
            assert by[doc, len(text)] == "".join(f"{h:08x}" for h in brute(text))
    assert by[13, 43] == by[14, 43]
    assert fingerprints.fingerprint_documents(none).count() == 0


def test_neighbours_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "RANGE_ROWS", 20)
    ids = sorted({i * 7 % 1009 * (3 if i % 5 else 1) for i in range(400)})
    text = lambda i: f"{i} is a text of {i % 13} words " + "and more " * (i % 13)
    df = spark.createDataFrame([(i, text(i)) for i in ids], "doc_id long, text string")
    got = {r["doc_id"]: r["next_start"] for r in fingerprints.with_next(df).collect()}
    assert got == {a: text(b)[: len(text(a)) // 4] for a, b in zip(ids, ids[1:] + ids[:1])}


def test_likeness_of_neighbours_and_edits(spark):
    """near_edited and near_next are near the Jaccard similarity of the whole shingle sets, and exact for short texts."""
    rows = [(r["doc_id"], r["text"] or "") for r in documents(spark, "/root/testdata/sf0.001").collect()]
    rows = sorted(rows)[:120]
    rows += [(rows[-1][0] + 1, rows[-1][1]), (rows[-1][0] + 1, rows[-1][1]), (None, "one two three four five six")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = fingerprints.fingerprint_documents(df).collect()
    assert len(out) == len(rows)
    order = sorted(((r[0] is not None, r[0] or 0), r[1]) for r in rows)
    jaccard = lambda a, b: len(shingle_set(a) & shingle_set(b)) / len(shingle_set(a) | shingle_set(b)) if shingle_set(a) | shingle_set(b) else 1.0
    by, digests = {}, {}
    for k, (key, text) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        q = len(text) // 4
        edited = text[: len(text) - q] + after[:q]
        digests.setdefault(key[1] if key[0] else None, []).append(hashlib.sha256(edited.encode()).hexdigest())
        by[hashlib.sha256(edited.encode()).hexdigest()] = (jaccard(text, edited), jaccard(text, after), len(shingle_set(text)))
    off = []
    for r in out:
        assert r["edited_sha256"] in digests[r["doc_id"]]
        near_edited, near_next, size = by[r["edited_sha256"]]
        off.append(abs(r["near_edited"] - near_edited))
        if size <= 16 and near_edited == 1:
            assert r["near_edited"] == 1
        assert near_next or r["near_next"] == 0
    assert sum(off) / len(off) < 0.1
    same = [r for r in out if r["doc_id"] == rows[-2][0]]
    assert len(same) == 2 and {r["near_next"] for r in same} >= {1.0}
    assert fingerprints.fingerprint_documents(df.limit(1)).first()["near_next"] == 1.0


def test_texts_move_once_to_meet_their_neighbours(spark, small):
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as on large tables
    try:
        df = queries.queries()["op3_document_fingerprints"](spark, small)
        df.collect()
        assert "ReusedExchange" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)


def test_sketches_merge_and_contain(spark):
    rng = random.Random(2)
    words = [f"w{rng.randint(0, 10**6)}" for _ in range(3000)]
    parts = spark.createDataFrame([(" ".join(words[:1500]), " ".join(words[1496:]), " ".join(words), " ".join(words[200:330]))], "a string, b string, whole string, piece string")
    f = fingerprints
    row = parts.select(f.merge(f.sketch(parts.a), f.sketch(parts.b)).alias("m"), f.sketch(parts.whole).alias("w"), f.containment(f.sketch(parts.piece), f.sketch(parts.whole)).alias("c"), f.containment(f.sketch(parts.whole), f.sketch(parts.piece)).alias("d"), f.likeness(f.sketch(parts.a), f.sketch(parts.whole)).alias("l")).first()
    assert row["m"] == row["w"] and row["c"] == 1.0 and row["d"] < 0.15 and abs(row["l"] - 0.5) < 0.1


def conversation_digest(turns):
    return hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()


def test_chat_windows(spark):
    rng = random.Random(6)
    text = lambda: " ".join(rng.choice(["<turn user>", "</turn>\n", "\\l", "\\", "plain", "words", "é>", "\n"]) for _ in range(rng.randint(0, 120)))
    rows = []
    for c in range(12):
        n = rng.randint(1, 40)
        for k in range(n):
            role = "system" if k == 0 and c % 2 else ("user", "assistant")[k % 2]
            rows.append((c, k, role, text()))
    rows += [(50, 0, "assistant", "word " * 5000), (50, 1, "user", "x"), (51, None, None, None), (52, 0, "system", "only"), (None, 1, "user", "a"), (None, 2, "assistant", "b"), (53, 1, "assistant", "same"), (53, 1, "assistant", "same")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as start", "2 as window")
    windows = chat.chat_windows(df, budget=600, history=100)
    out = {r["conv_id"]: r for r in chat.conversation_digests(windows).collect()}
    by = {}
    for c, k, r, t in sorted(rows, key=lambda x: (first(x[0]), first(x[1]), x[2] or "", x[3] or "")):
        by.setdefault(c, []).append((r or "", t or ""))
    assert set(out) == set(by)
    for c, turns in by.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        assert out[c]["n_turns"] == len(turns) and out[c]["turns_sha256"] == conversation_digest(turns)
        assert out[c]["loss_chars"] == len(loss) and out[c]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    held = windows.collect()
    assert sum(out[c]["formatted_chars"] for c in out) == sum(len(w["formatted"]) for w in held)
    several = [w for w in held if w["n_repeated"]]
    assert several and all(w["formatted"].startswith("<turn system>") for w in held if w["conv_id"] in (1, 3, 5, 7, 9, 11))
    for w in held:
        tokens = sum(len(re.findall(r"[^\W\d_]+|\d+|[^\s\w]|_", p.split(">\n", 1)[1].replace("\\b", "\\").replace("\\l", "<").replace("\\g", ">"))) + 4 for p in w["formatted"].split("</turn>\n")[:-1])
        assert tokens <= 600 or w["formatted"].count("</turn>\n") - w["n_repeated"] == 1
    assert chat.chat_windows(df.limit(0)).count() == 0


def test_chat_query(spark):
    """Every conversation of the table comes back whole, though windows are cut, turns repeated and repeated targets masked."""
    folder = "/root/testdata/sf0.01"
    text = "\\### Assistant: </turn> ok"
    by = {-7: [("user", text), ("assistant", text)]}
    for r in spark.read.parquet(f"{folder}/conversations.parquet").orderBy("conv_id", "turn").collect():
        by.setdefault(r["conv_id"], []).append((r["role"] or "", r["text"] or ""))
    out = {r["conv_id"]: r for r in queries.queries()["op9_chat_formatting"](spark, folder).collect()}
    assert set(out) == set(by)
    for c, turns in by.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        assert (out[c]["n_turns"], out[c]["turns_sha256"], out[c]["loss_chars"], out[c]["loss_sha256"]) == (len(turns), conversation_digest(turns), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    windows = chat.chat_windows(spark.read.parquet(f"{folder}/conversations.parquet")).collect()
    assert len(windows) > 1.3 * len(by) and sum(w["n_repeated"] for w in windows) > 50
    # an assistant's turn is repeated, and is not under the mask there
    assert any("<turn assistant>" in "</turn>\n".join(w["formatted"].split("</turn>\n")[: w["n_repeated"]]) for w in windows)
    plan = queries.queries()["op9_chat_formatting"](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") < 20


def test_pipeline_against_brute_force(spark):
    """Each stage decides on what the one before kept; quality is taken from the classifier, the rest from plain Python."""
    import public_tokenizers
    import tiktoken

    import corpus_pipeline as p
    from citeloom.llm.bpe import read_ranks
    from tests.llm.test_texts import PATTERN, check_packing

    folder = "/root/testdata/sf0.001"
    docs = documents(spark, folder)
    assert [n for n, _ in p.STAGES] == ["quality classifier", "exact dedup", "near dedup", "suffix-array dedup", "best-fit packing"]
    kept = p.quality_stage(spark, docs, folder)
    assert kept.columns == docs.columns
    rows = {r["doc_id"]: r["text"] for r in kept.collect()}
    groups = {}
    for i, t in rows.items():
        groups.setdefault(SPACES.sub("", t or ""), []).append(i)
    rows = {i: rows[i] for g in groups.values() for i in [min(g, key=lambda i: (-len(rows[i] or ""), i))]}
    rows = {i: rows[i] for i, (_, _, stay) in brute_components(list(rows.items()), 80).items() if stay}
    seen, final = set(), {}
    for i in sorted(rows):
        raw = rows[i].encode()
        gone = bytearray(len(raw))
        for k in range(len(raw) - 99):
            if raw[k : k + 100] in seen:
                gone[k : k + 100] = b"\1" * 100
            seen.add(raw[k : k + 100])
        final[i] = bytes(c for c, g in zip(raw, gone) if not g).decode("utf-8", "ignore")
    enc = tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), special_tokens={})
    check_packing(p.run(spark, folder).collect(), {i: [[*enc.encode_ordinary(t), 2]] for i, t in final.items()}, 1024)


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.001"), reason="no tables")
def test_every_operator_has_its_query():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.queries())
    assert numbers == list(range(1, 11))
