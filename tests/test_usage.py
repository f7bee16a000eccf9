"""What providers use is counted once, also where tasks are tried again; vectors that a cache has are not made again."""

import json
import subprocess
import sys
from pathlib import Path

import numpy as np
from pyspark.sql import functions as F

from citeloom.operators import providers
from citeloom.plans import config as cfg
from citeloom.plans import stages

RETRIED = '''
import json, os, sys
from pyspark import TaskContext
from pyspark.sql import SparkSession, functions as F
from citeloom.operators import providers, reports

spark = (SparkSession.builder.master("local[2,3]").config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false")
         .config("spark.sql.execution.arrow.maxRecordsPerBatch", "2").getOrCreate())
spark.sparkContext.setLogLevel("OFF")
log = sys.argv[1]

def provider(texts, languages):
    with open(log, "a") as out:
        out.write("call\\n")
    with open(log) as held:
        made = len(held.readlines())
    if TaskContext.get().attemptNumber() == 0 and made >= 2:
        os._exit(1)  # the worker is lost after it has answered
    return providers.Answered([t.upper() for t in texts], [{"model": "m", "prompt_tokens": sum(map(len, texts)), "completion_tokens": 1, "cost_usd": 0.5}])

df = spark.range(20).repartition(1).select("id", F.lit("ab").alias("t"), F.lit("de").alias("t_lang"))
ledger = []
out = providers.translate(df, "id", "t", provider, "en", ledger)
kept = out.where("t_en = 'AB'").count()
print(json.dumps([kept, reports.cost_summary(providers.calls(ledger[0], "translate", "p")).first().asDict()]))
'''


def test_a_task_that_is_tried_again_counts_once(tmp_path):
    log = tmp_path / "log"
    done = subprocess.run([sys.executable, "-c", RETRIED, str(log)], capture_output=True, text=True, timeout=200, cwd=Path(__file__).parent.parent)
    assert done.returncode == 0, done.stderr[-2000:]
    kept, sums = json.loads(done.stdout.strip().splitlines()[-1])
    assert kept == 20 and sums == {"step": "translate", "provider": "p", "model": "m", "calls": 10, "prompt_tokens": 40, "completion_tokens": 10, "total_tokens": 50, "cost_usd": 5.0}
    assert len(log.read_text().splitlines()) > 10  # more calls were made than are kept


def _texts(spark, n):
    rows = [(k, f"p{k:03d}", f"text {k // 2}") for k in range(n)]  # each text twice
    return spark.createDataFrame(rows, "ord long, Bibcode string, full_text string")


def test_a_cache_grows_by_new_vectors_alone(spark, tmp_path):
    def embedder(texts):
        made = np.array([[len(t), float(t.split()[-1])] for t in texts])
        return providers.Answered(made, [{"model": "e", "prompt_tokens": len(texts)}])

    c = cfg.with_overrides(cfg.Config(), {"topic.embedder": "own", "topic.dimensions": 2, "topic.embedding_cache": str(tmp_path / "cache")})

    def run(n):
        ctx = stages.Context(spark, c, str(tmp_path / f"run{n}"), {"pubs_authors": _texts(spark, n)})
        ctx.providers.add("embed", "own", embedder)
        stages.work(ctx, "embeddings")
        got = {r["Bibcode"]: list(r["embedding"]) for r in ctx.tables["vectors"].collect()}
        assert got == {f"p{k:03d}": [len(f"text {k // 2}"), k // 2] for k in range(n)}
        return stages.costs(ctx), {p.name for p in (tmp_path / "cache/data").glob("*.parquet")}

    first, files = run(20)
    assert first["by_model"][0]["prompt_tokens"] == 10 and first["calls"]["missing"] == first["calls"]["calls"]
    second, more = run(30)
    assert second["by_model"][0]["prompt_tokens"] == 5 and files < more  # what was there was not written again
    third, same = run(30)
    assert third is None and same == more
    twice = spark.read.parquet(str(tmp_path / "cache/data"))
    doubled = providers.embed_documents(_texts(spark, 30), "Bibcode", "full_text", embedder, twice.union(twice))
    assert doubled.count() == 30  # a digest that two runs have put there counts once


def test_labels_say_what_they_used(spark):
    terms = spark.createDataFrame([(0, "star", 2.0), (1, "halo", 1.0)], "topic int, term string, weight double")
    docs = spark.createDataFrame([(1, 0, "a star"), (2, 1, None)], "ord long, topic_id int, text string")

    def labeler(prompts):
        if "halo" in prompts[0]:
            raise ValueError("no")
        return providers.Answered(["Stars"], [{"model": "l", "cost_usd": 0.25}, {"model": "l"}])  # an answer of two calls

    rows = providers.label_topics(terms, docs, labeler)
    assert {r["topic"]: (r["name"], len(r["_usage"])) for r in rows.collect()} == {0: ("Stars", 2), 1: ("halo", 0)}
    used = providers.calls(rows, "topic_dataframe", "l")
    assert [tuple(r) for r in used.agg(F.count("*"), F.sum("cost_usd"), F.max("total_tokens")).collect()] == [(2, 0.25, None)]
