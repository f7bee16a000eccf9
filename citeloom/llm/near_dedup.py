"""MinHash near-dedup: an inverted join on signature coordinates.

Every class of equal shingle sets has a signature of K minima.  Each (coordinate, minimum) of the first P is a token; a
pair that agrees in T of K coordinates agrees in T' = T - (K - P) tokens at least, and so it must share one of the first
P - T' + 1 tokens of both in any common order.  Ordered by how many classes hold them, the tokens that only one class
holds come first, so a class with fewer than T' shared tokens has no partner and is skipped at once, and a token of a
frequent passage is posted only by classes that consist mostly of it.

A posting list is joined by its members' own inverted index over all K coordinates.  Tokens that one member holds are
skipped, and so are members with fewer than T others; ordered by frequency within the list, the first postings of a
member (a prefix of all but T - 1) are merged, which gives its candidates, and collisions are counted for those alone.
Members that are already joined, or whose sizes are too far apart, are not counted.

No list emits its pairs.  A list sends only links that join its candidates; the components of these links hold every
candidate pair, and each class goes with its whole set to the one component that it is in.  There all candidate pairs are
confirmed exactly, and again only links that join are sent.  Lists and components too large for one task are cut into
blocks, and each pair of blocks is compared by a task of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.llm import textvec as tv
from citeloom.llm.common import keep_rows, materialize, own_text
from citeloom.llm.graph import components

#: Coordinates of a signature, and the most that a pair at the threshold may be missed as a candidate with.
COORDINATES, MISS = 64, 1e-5
#: The fewest coordinates that are tokens, and the fewest tokens that a candidate pair should agree in.
TOKENS, TOKEN_MATCHES = 40, 8
SHINGLE = 5
#: About the most members, and shingles, of a block.
BLOCK, BLOCK_SHINGLES = 1024, 1 << 21
#: The members that are compared each with each at once; more are joined by an inverted index.
DENSE = 48


def matches(per_cent: int) -> tuple[int, int]:
    """(T, P) for a threshold: coordinates that a candidate pair agrees in at least, and coordinates that are tokens.

    T is the largest number that a pair exactly at the threshold falls short of with a probability of at most MISS; at
    0.85 it is 41 of 64, with 9e-6.  P leaves some tokens that such a pair must share.  A threshold for which no
    coordinate is sure enough to agree, below 17, is refused.
    """
    if not 0 < per_cent <= 100:
        raise ValueError(f"per_cent must be in 1 to 100, not {per_cent}")
    share, short, least = per_cent / 100, 0.0, 0
    while least < COORDINATES and (short := short + comb(COORDINATES, least) * share**least * (1 - share) ** (COORDINATES - least)) <= MISS:
        least += 1
    if not least:
        raise ValueError(f"{COORDINATES} coordinates can't find pairs at a similarity of {per_cent} per cent")
    return least, min(COORDINATES, max(TOKENS, COORDINATES - least + TOKEN_MATCHES))


_PROFILE = "doc_id long, own long, n_shingles long, s1 long, s2 long, signature binary"


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, int]]:
    for batch in batches:
        for i, j, raw, at in tv.slices(batch.column(2)):
            hashed, row, _, _ = tv.words(raw, at)
            hashed, row = tv.distinct(*tv.shingles(hashed, row, j - i, SHINGLE))
            yield batch.slice(i, j - i), hashed, row, j - i


def _sums(hashed: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(size, rows with a shingle, where their shingles start, two sums) of each row's set; the size and sums name its class."""
    count = np.bincount(row, minlength=n)
    has, sums = np.flatnonzero(count), np.zeros((2, n), np.uint64)
    at = np.concatenate(([0], np.cumsum(count)))[has]
    if len(has):
        for k, seed in enumerate((101, 202)):
            sums[k, has] = np.add.reduceat(tv.mix(hashed + np.uint64(seed)), at)
    return count, has, at, sums.view(np.int64)


def _profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    keys = tv.salt(COORDINATES, 5)
    for rows, hashed, row, n in _sets(batches):
        count, has, at, sums = _sums(hashed, row, n)
        minima = np.zeros((n, COORDINATES), np.uint32)
        if len(has):
            for k in range(COORDINATES):
                minima[has, k] = (np.minimum.reduceat(hashed * keys[k], at) >> np.uint64(32)).astype(np.uint32)
        signature = pa.array([minima[i].tobytes() for i in range(n)], pa.binary())
        found = [rows.column(0), rows.column(1), pa.array(count.astype(np.int64)), pa.array(sums[0]), pa.array(sums[1]), signature]
        yield pa.RecordBatch.from_arrays(found, ["doc_id", "own", "n_shingles", "s1", "s2", "signature"])


def _tokens(count: int):
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            minima = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32).reshape(len(ids), COORDINATES)
            token = minima[:, :count].astype(np.int64) << np.int64(6) | np.arange(count, dtype=np.int64)
            for k in range(0, len(ids), 2000):
                yield pa.RecordBatch.from_arrays([pa.array(token[k : k + 2000].ravel()), pa.array(np.repeat(ids[k : k + 2000], count))], ["token", "rep"])

    return over


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, hashed, row, n in _sets(batches):
        at = np.searchsorted(row, np.arange(n + 1))
        sums = _sums(hashed, row, n)[3]
        members = pa.array([hashed[at[i] : at[i + 1]].tobytes() for i in range(n)], pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(sums[0]), pa.array(sums[1]), members], ["s1", "s2", "members"])


class Forest:
    """The trees of the members of a group, by the smallest member of each."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def apart(self, i: int, others: np.ndarray) -> np.ndarray:
        """Those that are not in the tree of i."""
        return others[self.label[others] != self.label[i]]

    def join(self, i: int, others: np.ndarray) -> Iterator[tuple[int, int]]:
        """The pairs of i and others that were apart, each joined in turn."""
        for j in others.tolist():
            a, b = sorted((int(self.label[i]), int(self.label[j])))
            if a != b:
                self.label[self.label == b] = a
                yield i, j


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each key and pair of a partition sorted by them; what goes on in the next batch is held back."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b = batch.column("key").to_numpy(), batch.column("pair").to_numpy()
        edge = (np.flatnonzero((a[1:] != a[:-1]) | (b[1:] != b[:-1])) + 1).tolist()
        if held and (held[-1].column("key")[0] != batch.column("key")[0] or held[-1].column("pair")[0] != batch.column("pair")[0]):
            yield pa.Table.from_batches(held)
            held = []
        for i, j in zip([0, *edge], edge):
            yield pa.Table.from_batches([*held, batch.slice(i, j - i)])
            held = []
        held.append(batch.slice(edge[-1] if edge else 0))
    if held:
        yield pa.Table.from_batches(held)


def _postings(signature: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """An inverted index over the prefixes of signatures: (holders by token, ends of tokens, tokens by member, ends of members).

    Tokens are ordered by how many members hold them; those that one holds are skipped, and so is a member with fewer
    than `least` others.  Of a member's n others the first n - least + 1 are its prefix: two members that agree in
    `least` coordinates have a token in the prefixes of both.
    """
    n = len(signature)
    keys = signature.astype(np.uint64) << np.uint64(6) | np.arange(COORDINATES, dtype=np.uint64)
    _, token, times = np.unique(keys, return_inverse=True, return_counts=True)
    token = token.reshape(n, COORDINATES)
    rank = np.empty(len(times), np.int64)
    rank[np.argsort(times, kind="stable")] = np.arange(len(times))
    alone = int((times == 1).sum())  # tokens of lower rank are held by one member
    order = np.sort(rank[token], axis=1)
    begin = (order < alone).sum(1)
    place = np.arange(COORDINATES)
    inside = (place >= begin[:, None]) & (place <= COORDINATES - least)
    member, held = np.nonzero(inside)[0], order[inside]
    by_token = np.argsort(held, kind="stable")
    return member[by_token], np.searchsorted(held[by_token], np.arange(len(times) + 1)), held, np.searchsorted(member, np.arange(n + 1))


def _candidates(table: pa.Table, per_cent: int, least_matches: int, forest: Forest) -> Iterator[tuple[int, np.ndarray]]:
    """(i, others): pairs of a group whose signatures agree enough and whose sizes allow the similarity, each once at most.

    side 0 are members of a block that is compared with itself; -1 and 1 are those of two blocks that are compared.  Pairs
    that the forest has joined by the time they come are left out.
    """
    size, side = table.column("n_shingles").to_numpy(), table.column("side").to_numpy()
    signature = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint32).reshape(-1, COORDINATES)
    n, between = len(size), bool((side != 0).any())

    def fitting(i: int, others: np.ndarray) -> np.ndarray:
        others = forest.apart(i, others)
        return others[100 * np.minimum(size[others], size[i]) >= per_cent * np.maximum(size[others], size[i])]

    if n <= DENSE:
        agree = (signature[:, None, :] == signature[None, :, :]).sum(2) >= least_matches
        agree &= side[:, None] < side[None, :] if between else np.arange(n)[:, None] < np.arange(n)[None, :]
        for i in np.flatnonzero(agree.any(1)).tolist():
            if len(others := fitting(i, np.flatnonzero(agree[i]))):
                yield i, others
        return
    holders, at, tokens, own = _postings(signature, least_matches)
    marked = np.zeros(n, bool)
    for i in np.flatnonzero(side <= 0).tolist():
        for t in tokens[own[i] : own[i + 1]].tolist():
            marked[holders[at[t] : at[t + 1]]] = True
        others = np.flatnonzero(marked)
        marked[others] = False
        others = fitting(i, others[side[others] == 1] if between else others[others > i])
        others = others[(signature[others] == signature[i]).sum(1) >= least_matches]
        if len(others):
            yield i, others


def _links(rep: np.ndarray, found: list[tuple[int, int]]) -> pa.RecordBatch:
    i, j = (np.array(x, np.int64) for x in zip(*found))
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(rep[i], rep[j])), pa.array(np.maximum(rep[i], rep[j]))], ["a", "b"])


def _join_candidates(per_cent: int):
    """Links that join the candidates of each list."""
    least_matches, _ = matches(per_cent)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches):
            forest, found = Forest(table.num_rows), []
            for i, others in _candidates(table, per_cent, least_matches, forest):
                found += forest.join(i, others)
            if found:
                yield _links(table.column("rep").to_numpy(), found)

    return over


def _confirm(per_cent: int):
    """Links that join the classes of each group whose whole sets reach the similarity."""
    least_matches, _ = matches(per_cent)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches):
            forest, found = Forest(table.num_rows), []
            size = table.column("n_shingles").to_numpy()
            shingle = np.unique(np.frombuffer(b"".join(table.column("members").to_pylist()), np.uint64), return_inverse=True)[1]
            at = np.concatenate(([0], np.cumsum(size)))
            own = np.zeros(len(shingle) + 1, bool)
            for i, others in _candidates(table, per_cent, least_matches, forest):
                mine = shingle[at[i] : at[i + 1]]
                own[mine] = True
                while len(others := forest.apart(i, others)):
                    part, others = others[:256], others[256:]
                    ends = np.cumsum(size[part])
                    index = np.arange(ends[-1]) + np.repeat(at[part] - (ends - size[part]), size[part])
                    shared = np.add.reduceat(own[shingle[index]].astype(np.int64), ends - size[part])
                    found += forest.join(i, part[100 * shared >= per_cent * (size[i] + size[part] - shared)])
                own[mine] = False
            if found:
                yield _links(table.column("rep").to_numpy(), found)

    return over


def _blocked(members: DataFrame) -> DataFrame:
    """(rep, key, pair, side) of (rep, key, blocks): members meet once, in the pair of their blocks."""
    block = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("long")
    spread = members.select("rep", "key", "blocks", block.alias("block"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
    lo, hi = F.least("block", "other"), F.greatest("block", "other")
    side = F.when(F.col("block") == F.col("other"), 0).when(F.col("block") < F.col("other"), -1).otherwise(1)
    return spread.select("rep", "key", (lo * F.col("blocks") + hi).alias("pair"), side.cast("int").alias("side"))


def _lead():
    """The place of a row in the order: by id, a missing one last, then by the hash of its text as it stands."""
    return F.struct(F.col("doc_id").isNull().alias("missing"), F.col("doc_id"), F.col("own"))


def _classes(profiles: DataFrame, *more) -> DataFrame:
    """Classes of equal sets with their first row; rep names a class, as several may have one id."""
    classes = profiles.where("n_shingles > 0").groupBy("n_shingles", "s1", "s2").agg(F.min(_lead()).alias("lead"), *more)
    return classes.withColumn("rep", F.xxhash64("n_shingles", "s1", "s2"))


def _by_group(rows: DataFrame) -> DataFrame:
    return rows.repartition("key", "pair").sortWithinPartitions("key", "pair", "rep")


def near_links(rows: DataFrame, per_cent: int = 85) -> tuple[DataFrame, DataFrame]:
    """(profiles, links) of rows(doc_id, own, text): a row for each document with its class, and confirmed links that join
    each component of classes."""
    least_matches, count = matches(per_cent)
    shared_least = least_matches - (COORDINATES - count)
    profiles = materialize(rows.mapInArrow(_profiles, _PROFILE), "near-profiles")
    facts = materialize(_classes(profiles, F.first("signature").alias("signature")), "near-classes")

    tokens = facts.select("rep", "signature").mapInArrow(_tokens(count), "token long, rep long")
    frequent = tokens.groupBy("token").agg(F.count("*").alias("n")).where("n > 1")
    shared = tokens.join(frequent, "token").groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("n", "token"))).alias("held"))
    posted = shared.where(F.size("held") >= shared_least).select("rep", F.explode(F.slice("held", F.lit(1), F.size("held") - (shared_least - 1))).alias("t"))
    posted = materialize(posted.select("rep", F.col("t.token").alias("key")), "near-posted")
    lists = posted.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key", F.ceil(F.col("n") / BLOCK).cast("long").alias("blocks"))
    listed = _by_group(_blocked(posted.join(lists, "key")).join(facts.select("rep", "n_shingles", "signature"), "rep"))
    joined = components(listed.mapInArrow(_join_candidates(per_cent), "a long, b long"))

    groups = materialize(facts.join(joined.select(F.col("node").alias("rep"), F.col("component").alias("key")), "rep"), "near-groups")
    blocks = F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)).cast("long")
    sizes = groups.groupBy("key").agg(blocks.alias("blocks"))
    # texts are dealt by id and own hash at every size; the names are the side that is hashed, so texts need no sort
    named = groups.select(F.col("lead.doc_id").alias("_doc"), F.col("lead.own").alias("_own")).hint("shuffle_hash")
    texts = rows.join(named, rows["doc_id"].eqNullSafe(named["_doc"]) & (rows["own"] == named["_own"]), "left_semi")
    sets = texts.mapInArrow(_full_sets, "s1 long, s2 long, members binary")
    sets = sets.select(F.xxhash64(F.expr("octet_length(members) div 8"), "s1", "s2").alias("rep"), "members")
    # a row that repeats id and text gives its set again
    full = groups.drop("lead").join(sets, "rep").where(F.octet_length("members") == F.col("n_shingles") * 8).dropDuplicates(["rep"])
    full = materialize(full.select("rep", "n_shingles", "signature", "members"), "near-sets")
    spread = _blocked(groups.select("rep", "key").join(sizes, "key")).join(full, "rep")
    return profiles, materialize(_by_group(spread).mapInArrow(_confirm(per_cent), "a long, b long"), "near-links")


def near_dedup(docs: DataFrame, per_cent: int = 85, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id, n_shingles, component_id, kept.

    Two documents are linked when 100 * |intersection| >= per_cent * |union| of their sets of five-word shingles; a
    component is named by its smallest id, the one document that is kept.  A text of fewer words has its whole sequence
    as its only shingle; a null, empty or white-space text has none, is its own component and is kept.  Rows repeated
    under one id are judged each by its own text: of several that are first in a component, that with the smallest hash
    of its text is kept, and rows that repeat it are too.  A row without id comes after all others, so it is kept only
    in a component without ids, whose component_id is null.

    A pair exactly at the threshold is missed with a probability of at most 1e-5; thresholds below 17, at which
    signatures can't promise that, raise an error.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return _judged(rows, per_cent).select("doc_id", "n_shingles", "component_id", "kept")


def _judged(rows: DataFrame, per_cent: int) -> DataFrame:
    """near_dedup of rows(doc_id, text), and own."""
    profiles, links = near_links(rows.select("doc_id", own_text(rows).alias("own"), "text"), per_cent)
    nodes, classes = materialize(components(links), "near-components").withColumnRenamed("node", "rep"), _classes(profiles)
    named = nodes.join(classes.select("rep", "lead"), "rep").groupBy("component").agg(F.min("lead").alias("first"))
    names = materialize(nodes.join(named, "component").select("rep", "first"), "near-names")
    classes = classes.join(names, "rep", "left").select("n_shingles", "s1", "s2", F.coalesce("first", "lead").alias("first"))
    out = profiles.select("doc_id", "own", "n_shingles", "s1", "s2").join(classes, ["n_shingles", "s1", "s2"], "left")
    kept = F.col("first").isNull() | F.col("first").eqNullSafe(_lead())
    return out.select("doc_id", "own", "n_shingles", F.when(F.col("first").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("component_id"), kept.alias("kept"))


def keep_one_of_each(docs: DataFrame, per_cent: int = 85) -> DataFrame:
    """One row of docs for each component of near_dedup, with all its columns: the row that it keeps.

    A row goes by its id and text, so another text under the same id stays unless it is near too.  Of rows that repeat id
    and text one stays, with the other columns of any of them; rows without a word all stay.
    """
    judged = _judged(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), per_cent)
    return keep_rows(docs, judged.select("doc_id", "own", "kept", (F.col("n_shingles") > 0).alias("single")))
