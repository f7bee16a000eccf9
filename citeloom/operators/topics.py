"""Topics: tokens, class-based term weights, topic tables, centroids and outlier reassignment."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citeloom.functions.columns import dot
from citeloom.plans.written import materialize

#: A short list of English words without content.
STOP_WORDS = ["a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "has", "have", "in", "is", "it", "its", "not", "of", "on", "or", "that", "the", "their", "this", "to", "was", "we", "were", "which", "with"]
OUTLIER = "Outlier Topic"
#: About the words of a task whose runs are counted at a time.
RUN_WORDS = 1 << 22


def tokens(c: Column, least: int = 3, stop_words: list[str] = STOP_WORDS, lemma=None) -> Column:
    """Words of letters in lower case, not stop words and not short; lemma may map each word to another column."""
    words = F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(r"\p{L}+"), F.lit(0))
    words = F.transform(words, lemma) if lemma else words
    return F.filter(words, lambda w: (F.length(w) >= least) & ~w.isin(stop_words))


def _runs(topics: pa.Array, words: pa.ListArray, most: int) -> Iterator[pa.Table]:
    """(topic, term, tf) over the runs of one to `most` words of some rows; a run is the shorter run at its place and the next word."""
    sizes = pc.fill_null(pc.list_value_length(words), 0).to_numpy()
    flat = words.flatten().dictionary_encode("encode")
    word, names = flat.indices.to_numpy().astype(np.int64), flat.dictionary
    topic = topics.dictionary_encode("encode")
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(word))  # words from here to the end of the row
    run, terms = np.repeat(topic.indices.to_numpy().astype(np.int64), sizes), None
    owner = np.arange(len(topic.dictionary))
    for n in range(1, most + 1):
        at = np.flatnonzero(left >= n)
        found = pa.array(run[at] * len(names) + word[at + n - 1]).dictionary_encode()
        if not len(at):
            return
        keys, held = found.dictionary.to_numpy(), found.indices.to_numpy()
        before, last = keys // len(names), names.take(pa.array(keys % len(names)))
        owner, terms = owner[before], last if n == 1 else pc.binary_join_element_wise(terms.take(pa.array(before)), last, " ")
        yield pa.table([topic.dictionary.take(pa.array(owner)), terms, pa.array(np.bincount(held, minlength=len(keys)).astype(np.int64))], ["topic", "term", "tf"])
        run[at] = held


def _counted(most: int, limit: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function that counts the runs of rows (topic, words), about `limit` words at a time."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def counted() -> Iterator[pa.RecordBatch]:
            rows = pa.Table.from_batches(held)
            for found in _runs(rows.column(0).combine_chunks(), rows.column(1).combine_chunks(), most):
                yield from found.to_batches(max_chunksize=1 << 16)

        for batch in batches:
            ends = np.cumsum(pc.fill_null(pc.list_value_length(batch.column(1)), 0).to_numpy())
            begin = 0
            while begin < len(batch):
                done = ends[begin - 1] if begin else 0
                end = max(begin + 1, int(np.searchsorted(ends, done + limit - size, "right")))
                held.append(batch.slice(begin, end - begin))
                size += int(ends[end - 1] - done)
                begin = end
                if size >= limit or begin < len(batch):
                    yield from counted()
                    held, size = [], 0
        if held:
            yield from counted()

    return over


def term_counts(docs: DataFrame, topic: str = "topic_id", words: str = "tokens", most: int = 3) -> DataFrame:
    """(topic, term, tf) over n-grams; counted in the tasks, by numbers of words, before anything moves."""
    rows = docs.select(F.col(topic).alias("topic"), F.col(words).alias("words"))
    kind = rows.schema["topic"].dataType.simpleString()
    counts = rows.mapInArrow(_counted(most, RUN_WORDS), f"topic {kind}, term string, tf long")
    # dealt first: few counts of a task can be added up there, and its maps would spill
    return counts.repartition("topic", "term").groupBy("topic", "term").agg(F.sum("tf").alias("tf"))


def class_tfidf(counts: DataFrame, top: int | None = 20) -> DataFrame:
    """(topic, term, tf, weight): tf * ln(1 + A / f), A the mean number of terms of a class and f a term's total.

    Counts are written once.  As f is no less than tf, a term weighs at most tf * ln(1 + A / tf), which grows with tf: terms that
    stay below the weight of a topic's last one among those of most mentions cannot be among its best, so totals are made of
    the others only.
    """
    counts = materialize(counts, "term-counts")
    mean = counts.groupBy("topic").agg(F.sum("tf").alias("_n")).agg(F.avg("_n").alias("_a"))

    def weighed(rows: DataFrame, total: DataFrame) -> DataFrame:
        held = rows.join(total, "term").crossJoin(F.broadcast(mean))  # the mean is one row
        return held.select("topic", "term", "tf", (F.col("tf") * F.log1p(F.col("_a") / F.col("_f"))).alias("weight"))

    def totals(rows: DataFrame) -> DataFrame:
        return counts.join(rows.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("tf").alias("_f"))

    if top is None:
        return weighed(counts, counts.groupBy("term").agg(F.sum("tf").alias("_f")))

    def best(rows: DataFrame, order: list[Column | str], n: int) -> DataFrame:
        return rows.withColumn("_n", F.row_number().over(Window.partitionBy("topic").orderBy(*order))).where(F.col("_n") <= n)

    often = materialize(best(counts, [F.desc("tf"), "term"], 10 * top).drop("_n"), "frequent-terms")
    last = best(weighed(often, totals(often)), [F.desc("weight"), "term"], top).groupBy("topic").agg(F.min("weight").alias("_least"), F.count("*").alias("_m"))
    # a topic of fewer terms has no least weight; the bound leaves room for rounding
    least = F.when(F.col("_m") == top, F.col("_least") * (1 - 1e-9)).otherwise(0.0)
    may = counts.join(F.broadcast(last.select(F.col("topic").alias("_t"), least.alias("_least"))), F.col("topic").eqNullSafe(F.col("_t"))).crossJoin(F.broadcast(mean))
    few = materialize(may.where(F.col("tf") * F.log1p(F.col("_a") / F.col("tf")) >= F.col("_least")).select(counts.columns), "terms-of-weight")
    return best(weighed(few, totals(few)), [F.desc("weight"), "term"], top).drop("_n")


def topic_names(terms: DataFrame, most: int = 4) -> DataFrame:
    """(topic, name): the heaviest terms, joined."""
    best = Window.partitionBy("topic").orderBy(F.desc("weight"), "term")
    ranked = terms.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= most)
    return ranked.groupBy("topic").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_n", "term"))), lambda x: x["term"]), ", ").alias("name"))


def topic_info(docs: DataFrame, names: DataFrame | None = None, topic: str = "topic_id") -> DataFrame:
    """(Topic, Count, Name): noise has a fixed name, others their own or a number."""
    counts = docs.where(F.col(topic).isNotNull()).groupBy(F.col(topic).alias("Topic")).agg(F.count("*").alias("Count"))
    if names is None:
        counts = counts.withColumn("_name", F.lit(None).cast("string"))
    else:
        counts = counts.join(names.select(F.col("topic").alias("Topic"), F.col("name").alias("_name")), "Topic", "left")
    return counts.select("Topic", "Count", F.when(F.col("Topic") == -1, F.lit(OUTLIER)).otherwise(F.coalesce("_name", F.concat(F.lit("Topic "), F.col("Topic").cast("string")))).alias("Name"))


def check_names(info: DataFrame) -> None:
    if info.where(F.coalesce(F.trim("Name"), F.lit("")) == "").limit(1).count():
        raise ValueError("a topic has no name")


#: The columns of the topic frame.
TOPIC_COLUMNS = ["Bibcode", "References", "Author", "author_uids", "author_display_names", "Title", "Title_en", "Year", "Abstract", "Abstract_en", "Journal", "Volume", "Issue", "First Page", "Last Page", "DOI", "Keywords", "Category", "Affiliation", "Citation Count", "full_text", "tokens", "Title_lang", "Abstract_lang"]


def topic_columns(df: DataFrame) -> DataFrame:
    return df.select([c for c in TOPIC_COLUMNS if c in df.columns])


def topic_frame(docs: DataFrame, info: DataFrame) -> DataFrame:
    """docs with the name (and main terms, joined) of their topics, and coordinates as columns; unknown topics have null."""
    facts = info.select(F.col("Topic").alias("topic_id"), "Name", *([F.array_join("Main", ", ").alias("Main")] if dict(info.dtypes).get("Main", "").startswith("array") else ["Main"] if "Main" in info.columns else []))
    out = docs.join(facts, "topic_id", "left")
    for name, size, axes in (("reduced_5d", 5, "01234"), ("reduced_2d", 2, "xy")):
        if name in docs.columns:
            out = out.withColumns({f"embedding_{size}d_{axes[k]}": F.get(F.col(name), F.lit(k)).cast("float") for k in range(size)}).drop(name)
    return out


def centroids(docs: DataFrame, cluster: str = "topic_id", vector: str = "embedding") -> DataFrame:
    """(cluster, centroid, n): mean vectors of clusters, noise left out; sums are combined in the tasks."""
    rows = docs.where((F.col(cluster) != -1) & F.col(vector).isNotNull()).select(F.col(cluster).alias("cluster"), F.posexplode(vector).alias("pos", "v"))
    means = rows.groupBy("cluster", "pos").agg(F.avg(F.col("v").cast("double")).alias("m"), F.count("*").alias("n"))
    return means.groupBy("cluster").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "m"))), lambda x: x["m"]).alias("centroid"), F.max("n").alias("n"))


#: Most bytes of centroids that may be sent to every executor; beyond it they are dealt out like the vectors.
BROADCAST_BYTES = 64 << 20


def nearest(vectors: DataFrame, means: DataFrame, key: str, vector: str, threshold: float) -> DataFrame:
    """(key, cluster, similarity) of the most similar centroid at or above the threshold and above 0; the lowest id wins ties.

    Centroids are broadcast only up to a checked size.  Beyond it each vector meets blocks of centroids one after the
    other, and the maxima of the blocks are combined.
    """
    size = means.agg(F.sum(F.size("centroid") * 8)).first()[0] or 0
    blocks = max(1, -(-int(size) // BROADCAST_BYTES))
    norm = lambda c: F.transform(F.array(F.sqrt(dot(c, c))), lambda n: F.transform(c, lambda x: F.when(n > 0, x.cast("double") / n).otherwise(F.lit(0.0))))[0]
    unit = means.select("cluster", norm(F.col("centroid")).alias("_c"), F.pmod(F.xxhash64("cluster"), F.lit(blocks)).alias("_block"))
    listed = unit.groupBy("_block").agg(F.collect_list(F.struct("cluster", "_c")).alias("_all"))
    rows = vectors.select(F.col(key), norm(F.col(vector)).alias("_v"))
    best = None
    for k in range(blocks):
        part = F.broadcast(listed.where(F.col("_block") == k).select("_all"))  # one row of a bounded size
        scored = F.transform("_all", lambda c: F.struct(dot(F.col("_v"), c["_c"]).alias("s"), (-c["cluster"]).alias("neg")))
        own = rows.crossJoin(part).select(key, F.array_max(F.filter(scored, lambda x: (x["s"] >= threshold) & (x["s"] > 0))).alias("b"))
        best = own if best is None else best.union(own)
    found = best.where("b is not null").groupBy(key).agg(F.max("b").alias("b"))
    return found.select(key, (-F.col("b.neg")).alias("cluster"), F.col("b.s").alias("similarity"))


def reassign_outliers(docs: DataFrame, key: str = "Bibcode", topic: str = "topic_id", vector: str = "embedding", threshold: float = 0.5) -> DataFrame:
    """docs whose noise rows join the topic of the most similar centroid, if it is similar enough."""
    moved = nearest(docs.where(F.col(topic) == -1), centroids(docs, topic, vector), key, vector, threshold)
    joined = docs.join(moved.select(F.col(key).alias("_k"), F.col("cluster").alias("_to")), docs[key] == F.col("_k"), "left")
    return joined.withColumn(topic, F.coalesce("_to", topic)).select(docs.columns)


def reassign_layers(assigned: DataFrame, vectors: DataFrame, tree: DataFrame, n_layers: int, threshold: float = 0.8) -> DataFrame:
    """(Bibcode, layer, cluster_id) without needless noise, from fine layers to coarse ones.

    A noise row takes the parent of its cluster in the layer below if the tree has one, or else the most similar centroid
    of its own layer at or above the threshold.
    """
    below, out = None, None
    for layer in range(n_layers):
        rows = assigned.where(F.col("layer") == layer).select("Bibcode", "cluster_id")
        noise = rows.where("cluster_id = -1").select("Bibcode")
        means = centroids(rows.join(vectors, "Bibcode"), "cluster_id", "embedding")
        found = nearest(noise.join(vectors, "Bibcode"), means, "Bibcode", "embedding", threshold).select("Bibcode", F.col("cluster").alias("_near"))
        rows = rows.join(found, "Bibcode", "left")
        if below is None:
            rows = rows.withColumn("_parent", F.lit(None).cast("int"))
        else:
            up = tree.where((F.col("child_layer") == layer - 1) & (F.col("parent_layer") == layer)).select(F.col("child_id").alias("_below"), F.col("parent_id").alias("_parent"))
            rows = rows.join(below.select("Bibcode", F.col("cluster_id").alias("_below")), "Bibcode", "left").join(up, "_below", "left")
        fixed = F.when(F.col("cluster_id") != -1, F.col("cluster_id")).otherwise(F.coalesce("_parent", "_near", "cluster_id")).cast("int")
        below = rows.select("Bibcode", fixed.alias("cluster_id"))
        here = below.select("Bibcode", F.lit(layer).alias("layer"), "cluster_id")
        out = here if out is None else out.union(here)
    return out


def sample_documents(docs: DataFrame, n: int, seed: int = 0, key: str = "Bibcode") -> DataFrame:
    """n documents that depend only on their keys and the seed."""
    return docs.orderBy(F.xxhash64(F.lit(seed), key), key).limit(n)
