"""Boundaries to models: language, translation, embedding, reduction, clustering and author identities.

Each boundary is a plain function over batches that runs in the executors' Python; the defaults need no downloads.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citeloom.functions.text import fill_prompt, surname, topic_label, without_thinking
from citeloom.operators.filters import translation_targets
from citeloom.plans.written import materialize

Translate = Callable[[list[str], list[str]], list[str]]
Embed = Callable[[list[str]], np.ndarray]


#: What a provider says of its calls, a struct for each.
USAGE = "array<struct<model:string,prompt_tokens:bigint,completion_tokens:bigint,cost_usd:double,generation_id:string>>"


class Answered(list):
    """A provider's answers and what its calls used: a dict for each call, with any of the fields of USAGE.

    A function that has nothing to say of its use returns a plain list (or matrix).  Use is written with the answers, row by
    row, so that a task that is tried again counts its calls once: those whose answers are kept.
    """

    def __init__(self, answers, usage: list[dict] = ()):
        super().__init__(answers)
        self.usage = [dict(u) for u in usage]


def _used(answers) -> list[dict]:
    names = ("model", "prompt_tokens", "completion_tokens", "cost_usd", "generation_id")
    return [{n: u.get(n) for n in names} for u in getattr(answers, "usage", [])]


def calls(answered: DataFrame, step: str, provider: str) -> DataFrame:
    """(step, provider, model, prompt_tokens, completion_tokens, total_tokens, cost_usd, generation_id): a row for each call that answered says of."""
    rows = answered.select(F.explode("_usage").alias("u")).select("u.*")
    total = F.when(F.col("prompt_tokens").isNotNull() | F.col("completion_tokens").isNotNull(), F.coalesce("prompt_tokens", F.lit(0)) + F.coalesce("completion_tokens", F.lit(0)))
    return rows.select(F.lit(step).alias("step"), F.lit(provider).alias("provider"), "model", "prompt_tokens", "completion_tokens", total.alias("total_tokens"), "cost_usd", "generation_id")


@dataclass
class Registry:
    """Providers by task and name."""

    known: dict[str, dict[str, Callable]] = field(default_factory=dict)

    def add(self, task: str, name: str, provider: Callable) -> None:
        self.known.setdefault(task, {})[name] = provider

    def get(self, task: str, name: str) -> Callable:
        own = self.known.get(task, {})
        if name not in own:
            raise ValueError(f"{task} has no provider {name!r}; known: {', '.join(sorted(own)) or 'none'}")
        return own[name]


#: Bytes of text whose trigrams a task counts at a time.
COUNTED_BYTES = 4 << 20


def train_language_profiles(labelled: DataFrame, text: str, lang: str, size: int = 300) -> dict[str, dict[str, float]]:
    """The most frequent character trigrams of each language, as log shares; bounded by languages times size.

    Rows without a text or a language teach nothing.  Trigrams are cut and counted in slices of a batch's texts, in time that
    grows with their length; only counts leave a task.
    """

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: dict[str, list[np.ndarray]] = {}
            waiting = 0
            for name, t in zip(batch.column(0), batch.column(1)):
                held.setdefault(name.as_py(), []).append(_trigram_codes(t.as_py()))
                waiting += len(t.as_buffer())
                if waiting >= COUNTED_BYTES:
                    yield from counted(held)
                    held, waiting = {}, 0
            yield from counted(held)

    def counted(held: dict[str, list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for name, codes in held.items():
            code, times = np.unique(np.concatenate(codes), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(code), pa.string()), pa.array(code), pa.array(times)], ["lang", "code", "n"])

    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).cast("string").alias("lang"), F.concat(F.lit(" "), F.lower(F.col(text)), F.lit(" ")).alias("t"))
    counts = rows.mapInArrow(over, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    # codes are in the order of the trigrams
    best = counts.withColumn("_r", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code"))).where(F.col("_r") <= size)
    out: dict[str, dict[str, float]] = {}
    for r in best.collect():  # languages times size
        out.setdefault(r["lang"], {})["".join(chr(r["code"] >> k & 0x1FFFFF) for k in (42, 21, 0))] = float(r["n"])
    return {k: {g: float(np.log(n / sum(v.values()))) for g, n in v.items()} for k, v in out.items()}


def identify_language(df: DataFrame, column: str, profiles: dict[str, dict[str, float]]) -> DataFrame:
    """df with `<column>_lang`; a null text counts as empty and, as one without letters, has no language.

    Texts of a batch are scored together: each trigram is looked up once in a table of the profiles' shares.
    """
    names = sorted(profiles)
    known = sorted({g for p in profiles.values() for g in p if len(g) == 3})
    places = np.array([_trigram_codes(g)[0] for g in known], np.int64)
    order = np.argsort(places)
    places = places[order]
    # a trigram that a profile lacks has a share of exp(-12); the last row is for trigrams that all lack
    table = np.array([[profiles[k].get(known[i], -12.0) for k in names] for i in order] + [[-12.0] * len(names)]).reshape(len(known) + 1, len(names))

    @F.pandas_udf("string")
    def guess(texts: pd.Series) -> pd.Series:
        own = [f" {t.lower()} " if t and any(map(str.isalpha, t)) else "" for t in texts]
        out: list[str | None] = [None] * len(own)
        if names:
            for i, low in enumerate(own):
                if low:
                    code, times = np.unique(_trigram_codes(low), return_counts=True)
                    at = np.minimum(np.searchsorted(places, code), max(len(places) - 1, 0))
                    row = np.where(places[at] == code, at, len(places)) if len(places) else np.zeros(len(code), int)
                    out[i] = names[int((times @ table[row]).argmax())]
        return pd.Series(out)

    return df.withColumn(f"{column}_lang", guess(F.col(column)))


def _trigram_codes(text: str) -> np.ndarray:
    """A number for each run of three characters."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    return c[:-2] << 42 | c[1:-1] << 21 | c[2:]


def translate(df: DataFrame, key: str, column: str, provider: Translate, target: str = "en", ledger: list[DataFrame] | None = None) -> DataFrame:
    """df with `<column>_en` and `<column>_error`: texts in other languages pass the provider, others are copied.

    Only rows to translate reach Python, longest first within a task; a failure keeps the source text.  With a ledger the
    answers are written, so that no text is sent twice, and the table of them with their use (`_usage`) is put there.
    """

    def over(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            texts, errors, used = rows["text"].tolist(), [None] * len(rows), [[] for _ in range(len(rows))]
            try:
                out = provider(texts, rows["lang"].tolist())
                if used:  # the first row of a batch holds the use of all
                    used[0] = _used(out)
            except Exception:  # one by one, so that one bad text does not cost the batch
                out = []
                for k, (t, lang) in enumerate(zip(texts, rows["lang"])):
                    try:
                        one = provider([t], [lang])
                        out += one
                        used[k] = _used(one)
                    except Exception as e:
                        out.append(t)
                        errors[k] = str(e)[:300]
            yield pd.DataFrame({"_k": rows["_k"], "_out": list(out), "_error": errors, "_usage": used})

    kind = df.schema[key].dataType.simpleString()
    todo = translation_targets(df, column, target).select(F.col(key).alias("_k"), F.col(column).alias("text"), F.coalesce(f"{column}_lang", F.lit("")).alias("lang"))
    done = todo.sortWithinPartitions(F.desc(F.length("text"))).mapInPandas(over, f"_k {kind}, _out string, _error string, _usage {USAGE}")
    if ledger is not None:
        done = materialize(done, "translated")
        ledger.append(done)
    joined = df.join(done, df[key] == done["_k"], "left")
    return joined.withColumns({f"{column}_en": F.coalesce("_out", column), f"{column}_error": F.col("_error")}).drop("_k", "_out", "_error", "_usage")


def identity_translator(texts: list[str], languages: list[str]) -> list[str]:
    return list(texts)


def hash_embedder(dim: int = 64) -> Embed:
    """Signed hashing of words, normalised; needs no model."""

    def embed(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), dim), np.float32)
        for i, t in enumerate(texts):
            for w in t.lower().split():
                h = int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "little")
                out[i, h % dim] += 1 if h >> 63 else -1
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)

    return embed


def _digested(df: DataFrame, key: str, column: str) -> DataFrame:
    text = F.when(F.trim(F.coalesce(column, F.lit(""))) == "", F.lit("(empty text)")).otherwise(F.col(column))
    return df.select(F.col(key), text.alias("_t")).withColumn("text_sha256", F.sha2("_t", 256))


def new_vectors(df: DataFrame, key: str, column: str, provider: Embed, cache: DataFrame | None = None, batch: int = 64) -> DataFrame:
    """(text_sha256, embedding, _usage) of the different texts whose digest the cache lacks; the first row of a batch holds its use."""

    def over(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            for k in range(0, len(part), batch):
                own = part.iloc[k : k + batch]
                made = provider(own["_t"].tolist())
                vectors = np.asarray(made, np.float32)
                yield pd.DataFrame({"text_sha256": own["text_sha256"].values, "embedding": list(vectors), "_usage": [_used(made)] + [[]] * (len(own) - 1)})

    todo = _digested(df, key, column).select("text_sha256", "_t").dropDuplicates(["text_sha256"])
    if cache is not None:
        todo = todo.join(cache.select("text_sha256"), "text_sha256", "left_anti")
    return todo.mapInPandas(over, f"text_sha256 string, embedding array<float>, _usage {USAGE}")


def embed_documents(df: DataFrame, key: str, column: str, provider: Embed, cache: DataFrame | None = None, batch: int = 64, fresh: DataFrame | None = None) -> DataFrame:
    """(key, text_sha256, embedding); texts whose digest the cache holds are not embedded again, blank ones are `(empty text)`.

    fresh holds new_vectors where they were made and written before.  A digest that a cache holds several times, as two runs
    may have put it there, counts once.
    """
    rows = _digested(df, key, column)
    fresh = (new_vectors(df, key, column, provider, cache, batch) if fresh is None else fresh).select("text_sha256", "embedding")
    known = fresh if cache is None else fresh.unionByName(cache.select("text_sha256", "embedding").dropDuplicates(["text_sha256"]))
    return rows.select(key, "text_sha256").join(known, "text_sha256").select(key, "text_sha256", "embedding")


def _in_order(df: DataFrame, key: str) -> DataFrame:
    """df dealt and sorted by key, so that what is fitted does not depend on where rows come from."""
    return df.repartition(key).sortWithinPartitions(key)


def reduce_dimensions(df: DataFrame, key: str, vector: str = "embedding", sizes: tuple[int, ...] = (5, 2)) -> DataFrame:
    """(key, reduced_<k>d...) by principal components; signs are set by each component's largest loading."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector, vector_to_array

    rows = _in_order(df, key).select(key, array_to_vector(F.transform(vector, lambda x: x.cast("double"))).alias("_v"))
    model = PCA(k=max(sizes), inputCol="_v", outputCol="_p").fit(rows)
    loadings = model.pc.toArray()
    signs = [float(np.sign(loadings[np.abs(loadings[:, k]).argmax(), k]) or 1.0) for k in range(max(sizes))]
    out = model.transform(rows).select(key, vector_to_array("_p").alias("_a"))
    return out.select(key, *(F.array(*((F.col("_a")[k] * signs[k]).cast("float") for k in range(n))).alias(f"reduced_{n}d") for n in sizes))


def validate_reduction(method: str, params: dict) -> dict:
    """Parameters of a reduction: one name for the distance, cosine as angular where the method knows only that."""
    own = dict(params)
    if method == "pacmap":
        own.pop("min_dist", None)
        if "metric" in own:
            own["distance"] = own.pop("metric")
        own["distance"] = {"cosine": "angular"}.get(own.get("distance"), own.get("distance", "euclidean"))
    elif method not in ("umap", "pca"):
        raise ValueError(f"unknown method {method!r}")
    return own


def cluster_kmeans(df: DataFrame, key: str, vector: str, k: int, seed: int = 0, noise_quantile: float | None = None) -> DataFrame:
    """(key, topic_id) by k-means; with a quantile, rows farther from their centre than it are noise (-1)."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    rows = _in_order(df, key).select(key, vector, array_to_vector(F.transform(vector, lambda x: x.cast("double"))).alias("features"))
    model = KMeans(k=k, seed=seed).fit(rows)
    out = model.transform(rows).withColumnRenamed("prediction", "topic_id")
    if noise_quantile is None:
        return out.select(key, "topic_id")
    centres = [c.tolist() for c in model.clusterCenters()]
    middle = F.get(F.array(*(F.array(*map(F.lit, c)) for c in centres)), F.col("topic_id"))
    far = out.withColumn("_d", F.aggregate(F.zip_with(vector, middle, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v))
    edge = far.agg(F.percentile_approx("_d", noise_quantile)).first()[0]
    return far.select(key, F.when(F.col("_d") > F.lit(edge), -1).otherwise(F.col("topic_id")).alias("topic_id"))


def diverse_terms(terms: list[str], vectors: np.ndarray, centre: np.ndarray, top: int = 10, balance: float = 0.3) -> list[str]:
    """Terms near a centre that are not near each other (maximal marginal relevance)."""
    unit = lambda x: x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-12)
    vectors, near = unit(vectors), unit(vectors) @ unit(centre)
    chosen = [int(near.argmax())] if len(terms) else []
    while len(chosen) < min(top, len(terms)):
        value = (1 - balance) * near - balance * (vectors @ vectors[chosen].T).max(1)
        value[chosen] = -np.inf
        chosen.append(int(value.argmax()))
    return [terms[i] for i in chosen]


#: What a provider of labels is asked for a topic.
LABEL_PROMPT = "Name the topic of these documents in a few words.\nKeywords: [KEYWORDS]\nDocuments:\n[DOCUMENTS]\nAnswer with the name only."


def label_topics(terms: DataFrame, docs: DataFrame, provider: Callable[[list[str]], list[str]], most: int = 10, examples: int = 4, prompt: str = LABEL_PROMPT) -> DataFrame:
    """(topic, name, error, _usage): a provider's name for each topic, or its heaviest terms where it fails or has nothing to say.

    terms is (topic, term, weight), docs (ord, topic_id, text); a prompt holds the heaviest terms and the first documents.
    """
    heavy = terms.withColumn("_n", F.row_number().over(Window.partitionBy("topic").orderBy(F.desc("weight"), "term"))).where(F.col("_n") <= most)
    words = heavy.groupBy("topic").agg(F.transform(F.array_sort(F.collect_list(F.struct("_n", "term"))), lambda x: x["term"]).alias("words"))
    first = docs.withColumn("_n", F.row_number().over(Window.partitionBy("topic_id").orderBy("ord"))).where(F.col("_n") <= examples)
    texts = first.groupBy(F.col("topic_id").alias("topic")).agg(F.transform(F.array_sort(F.collect_list(F.struct("_n", "text"))), lambda x: F.coalesce(x["text"], F.lit(""))).alias("texts"))
    asked = words.join(texts, "topic", "left").select("topic", "words", fill_prompt(prompt, F.col("words"), F.coalesce("texts", F.array().cast("array<string>"))).alias("prompt"))

    def over(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            answers, errors, used = [], [], []
            for p in rows["prompt"]:
                used.append([])
                try:
                    one = provider([p])
                    answers += one
                    used[-1] = _used(one)
                    errors.append(None)
                except Exception as e:  # one topic without an answer has its terms for a name
                    answers.append(None)
                    errors.append(str(e)[:300])
            yield pd.DataFrame({"topic": rows["topic"], "words": rows["words"], "answer": answers, "error": errors, "_usage": used})

    kind = terms.schema["topic"].dataType.simpleString()
    named = asked.mapInPandas(over, f"topic {kind}, words array<string>, answer string, error string, _usage {USAGE}")
    label = topic_label(without_thinking(F.col("answer")))
    return named.select("topic", F.when(F.coalesce(label, F.lit("")) != "", label).otherwise(F.array_join(F.slice("words", 1, 4), ", ")).alias("name"), "error", "_usage")


def block_authors(mentions: DataFrame) -> DataFrame:
    """Mentions (name) with author_uid and author_display_name: one identity for each surname and first initial.

    The default of the disambiguation boundary; the id is a digest of the block, the name the block's longest.
    """
    name = F.lower(F.col("name"))
    given = F.when(F.contains("name", F.lit(",")), F.trim(F.split_part("name", F.lit(","), F.lit(2)))).otherwise(F.col("name"))
    block = F.concat_ws("|", F.lower(surname(F.col("name"))), F.lower(F.substring(given, 1, 1)))
    rows = mentions.withColumn("_block", F.coalesce(block, name, F.lit("")))
    longest = rows.groupBy("_block").agg(F.max_by("name", F.struct(F.length("name"), "name")).alias("author_display_name"))
    return rows.join(longest, "_block").withColumn("author_uid", F.concat(F.lit("uid:"), F.substring(F.sha2("_block", 256), 1, 16))).drop("_block")


def attach_identities(df: DataFrame, mentions: DataFrame) -> DataFrame:
    """df with identity arrays from (Bibcode, pos, author_uid, author_display_name), in the order of authors."""
    pairs = F.array_sort(F.collect_list(F.struct("pos", "author_uid", "author_display_name")))
    lists = mentions.groupBy(F.col("Bibcode").alias("_k")).agg(pairs.alias("_p"))
    empty = F.array().cast("array<string>")
    out = df.join(lists, df["Bibcode"] == lists["_k"], "left")
    return out.withColumns({"author_uids": F.coalesce(F.transform("_p", lambda x: x["author_uid"]), empty), "author_display_names": F.coalesce(F.transform("_p", lambda x: x["author_display_name"]), empty)}).drop("_k", "_p")


def passthrough_identities(df: DataFrame) -> DataFrame:
    """No ids, and the authors' names as written."""
    return df.withColumns({"author_uids": F.array().cast("array<string>"), "author_display_names": F.col("Author")})


def check_mentions(asked: DataFrame, named: DataFrame, keys: tuple[str, ...] = ("table", "Bibcode", "pos")) -> None:
    """Raise unless a provider named each asked mention once, and no others; the counts of what it did not are in the message."""
    side = lambda df, name: df.groupBy(*keys).agg(F.count("*").alias(name))
    # a mention without a key is held against one without a key
    both = side(asked, "_asked").withColumn("_n", F.lit(0)).withColumnRenamed("_asked", "_times").unionByName(side(named, "_times").withColumn("_n", F.lit(1)))
    met = both.groupBy(*keys).agg(F.sum(F.when(F.col("_n") == 0, F.col("_times")).otherwise(0)).alias("asked"), F.sum(F.when(F.col("_n") == 1, F.col("_times")).otherwise(0)).alias("named"))
    bad = met.agg(*(F.count(F.when(F.expr(c), 1)).alias(n) for n, c in (("missing", "named < asked"), ("unknown", "asked = 0"), ("repeated", "named > asked and asked > 0")))).first()
    if any(bad):
        raise ValueError(f"the provider of identities left {bad['missing']} mentions without one, named {bad['unknown']} that were not asked and repeated {bad['repeated']}")


def check_identities(df: DataFrame) -> None:
    """Raise where identity arrays do not match the authors, or hold nulls."""
    bad = (F.size("Author") != F.size("author_uids")) | F.exists("author_uids", lambda u: u.isNull())
    n = df.where(F.coalesce(bad, F.lit(True))).count()
    if n:
        raise ValueError(f"{n} rows have identities that do not match their authors")
