"""Packing, BPE, token counts, language and quality against libraries, brute force and held-out rows."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from citeloom.llm import bpe, byte_bpe, language, packing, quality, token_counts

PATTERN = public_tokenizers.PATTERN
MULTI, PLAIN = (public_tokenizers.path(n) for n in ("byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.tiktoken"))


def library(path):
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("test", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def multi():
    return library(MULTI)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("aeiou nst's\n\t.,19é ß日  \x1c🎉"), max_size=80))
def test_bpe_is_exact(multi, text):
    assert np.frombuffer(bpe.encoder(MULTI, PATTERN)[1].encode(text), "<u4").tolist() == multi.encode_ordinary(text)


def test_bpe_of_long_matches_is_linear(multi):
    exact, texts = bpe.encoder(MULTI, PATTERN)
    for text in ("x" * 20_000, "abab" * 3000, " " * 5000, "\n" * 300 + "x"):
        ids = np.frombuffer(texts.encode(text), "<u4").tolist()
        assert exact.decode(ids) == text.encode() and ids == multi.encode_ordinary(text)


def test_round_trip_over_documents(spark, small, multi, odd, none):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    for df in (docs, odd):
        texts = sorted((r["doc_id"] is None, r["doc_id"], r["text"] or "") for r in df.collect())
        got = sorted((r["doc_id"] is None, r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in byte_bpe.round_trip(df, MULTI, PATTERN).collect())
        want = []
        for missing, doc, text in texts:
            ids = multi.encode_ordinary(text)
            want.append((missing, doc, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
        assert got == sorted(want)
    assert byte_bpe.round_trip(none, MULTI, PATTERN).count() == 0


def check_packing(rows, want, capacity):
    """Every piece is there once with the right ids, and sequences are gapless and within the capacity."""
    pieces, bins = {}, {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    for doc, texts in want.items():
        got = sorted((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in pieces[doc])
        expected = []
        for ids in texts:
            cuts = [0, *range((len(ids) - 1) % capacity + 1, len(ids) + 1, capacity)]
            expected += [(k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
        assert got == sorted(expected)
    assert set(pieces) == set(want)
    return len(bins)


def test_packing_against_the_library(spark, small, odd, none):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    for df in (spark.read.parquet(f"{small}/documents.parquet"), odd):
        want, total = {}, 0
        for r in df.collect():
            ids = [*t.encode(r["text"] or "", add_special_tokens=False).ids, 2]
            want.setdefault(r["doc_id"], []).append(ids)
            total += len(ids)
        n = check_packing(packing.pack(df, PLAIN, PATTERN, 1024, 2).collect(), want, 1024)
        assert n <= 1.05 * -(-total // 1024) + 1
    assert packing.pack(none, PLAIN, PATTERN).count() == 0


def test_packing_has_the_added_tokens_of_the_library(spark, tmp_path):
    from tokenizers import Tokenizer

    from citeloom.llm import queries

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    end = "<|endoftext|>"
    texts = [f"hello {end} world", end, f"{end}{end}\n{end}", f"a{end}b <|endoftext| >", "no token, <|endoftext|", f"{'x' * 30_000}{end} y", f"{'word ' * 1500}{end}{' word' * 1500}", ""]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    want = {i: [[*t.encode(x, add_special_tokens=False).ids, 2]] for i, x in enumerate(texts)}
    assert want[0] == [[31373, 220, 50256, 995, 2]]
    check_packing(queries.queries()["op1_best_fit_packing"](spark, str(tmp_path)).collect(), want, 1024)


def test_plans_use_each_piece_once_and_are_tight():
    rng = np.random.default_rng(1)
    for n, capacity in ((0, 32), (1, 32), (500, 64), (20_000, 128)):
        counts = np.bincount(np.minimum(rng.geometric(4 / capacity, n), capacity), minlength=capacity + 1)
        chosen = packing.plan(counts, capacity)
        used = np.zeros(capacity + 1, int)
        for contents, times in chosen:
            assert sum(contents) <= capacity and times > 0
            for v in contents:
                used[v] += times
        assert (used == counts).all()
        assert sum(t for _, t in chosen) <= 1.02 * -(-int(counts @ np.arange(capacity + 1)) // capacity) + 1


def brute_pieces(model, word):
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        found = [(best[k][0] + model.score[word[k:end]], -(best[k][1] + 1)) for k in range(end) if word[k:end] in model.score]
        top = max(found)
        best.append((top[0], -top[1]))
    return best[-1][1]


def test_token_counts(spark, small, odd, none):
    model, cut = token_counts.trie(MULTI), bpe.compile_pattern(PATTERN)
    rng = random.Random(3)
    words = {"".join(rng.choice("abcdeé ") for _ in range(rng.randint(1, 30))).encode() for _ in range(500)}
    model.clear()
    assert model.counts(list(words)) == {w: brute_pieces(model, w) for w in words}
    # a node for each distinct prefix, scored once: words that are there already add none
    assert len(model.best) == len({w[:k] for w in words for k in range(len(w) + 1)})
    model.counts([w[:k] for w in words for k in (1, len(w))])
    assert len(model.best) == len({w[:k] for w in words for k in range(len(w) + 1)})
    assert model.counts([b""]) == {b"": 0}
    for df in (odd, spark.read.parquet(f"{small}/documents.parquet").limit(40)):
        want = sorted((str(r["doc_id"]), len(p := cut.findall(r["text"] or "")), sum(brute_pieces(model, x.encode()) for x in p if len(x) < 300)) for r in df.collect() if len(r["text"] or "") < 4000)
        got = {(str(r["doc_id"]), r["n_pretokens"], r["n_tokens"]) for r in token_counts.token_counts(df, MULTI, PATTERN).collect()}
        assert set(want) <= got
    assert token_counts.token_counts(none, MULTI, PATTERN).count() == 0


def test_viterbi_against_brute_force():
    from itertools import product

    rng = np.random.default_rng(2)
    sizes = [1, 4, 2, 5, 1, 3]
    row = np.repeat(np.arange(len(sizes)) * 2, sizes)
    score = rng.normal(size=(len(row), 3)).astype(np.float32) * 3
    got, at = language.viterbi(score, row, 2.0), 0
    for n in sizes:
        own = score[at : at + n].astype(float)
        value = lambda p: sum(own[i, x] for i, x in enumerate(p)) - 2.0 * sum(a != b for a, b in zip(p, p[1:]))  # noqa: E731, B023
        assert value(tuple(got[at : at + n])) == pytest.approx(max(map(value, product(range(3), repeat=n))))
        at += n


def test_very_many_languages(spark):
    """Labels of more than 127 languages are kept apart, and beyond the bound the most frequent are learnt."""
    rng = random.Random(8)
    alphabet = "abcdefghijklmnopqrstuvwxyz"
    rows = []
    for k in range(300):
        letters = "".join(rng.sample(alphabet, 5))
        for copy in range(6 if k < 200 else 2):
            rows.append((len(rows), " ".join("".join(rng.choice(letters) for _ in range(6)) for _ in range(60)), f"l{k:03d}"))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(df)
    assert len(model.names) == 256 and {f"l{k:03d}" for k in range(200)} <= set(model.names)
    wide = language.train(df, languages=200)
    assert wide.names == [f"l{k:03d}" for k in range(200)]
    out = {r["doc_id"]: r["lang_pred"] for r in language.label_spans(df, wide).collect()}
    known = [(d, lang) for d, _, lang in rows if lang in wide.names]
    assert sum(out[d] == lang for d, lang in known) / len(known) > 0.9 and all(x in wide.names for x in out.values())
    assert language.train(df.withColumn("lang", df.lang.substr(1, 2))).names == ["l0", "l1", "l2"]


def test_labelled_rows_that_repeat_an_id(spark):
    """Of labels under one id the worse counts, and texts repeated under it are learnt each."""
    rows = [(i, f"{'good text of words' if i % 2 else '###  $$ click here'} {i} " * 5) for i in range(60)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'en' as lang", "1 as quality")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(1, 0), (None, 1), (2, None)], "doc_id long, quality int")
    model = quality.train(docs, labels)
    assert model.learnt
    out = quality.score_quality(docs, model).collect()
    assert len(out) == 120 and all((r["score"] > 0.5) == bool(r["doc_id"] % 2) for r in out if r["doc_id"] != 1)
    assert language.train(docs).names == ["en"]


def test_language_held_out(spark, small, odd, none):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    model = language.train(docs)
    rows = language.label_spans(docs, model).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert len(held) > 20 and np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.97
    got = {r["doc_id"]: r for r in language.label_spans(odd, model).collect()}
    for k in (0, 1, 2, 3):
        assert got[k]["lang_pred"] == "und" and got[k]["score"] == 0 and got[k]["spans"] == []
    assert all(0 <= r["score"] <= 1 and (r["lang_pred"] in model.names or r["lang_pred"] == "und") for r in got.values())
    assert got[8]["lang_pred"] != "und"
    mixed = spark.createDataFrame([(1, "the and of this that with there " * 5 + "und der die nicht ist sich verlichkeit " * 5)], "doc_id long, text string")
    assert [s["lang"] for s in language.label_spans(mixed, model).first()["spans"]] == ["en", "de"]
    assert language.label_spans(none, model).count() == 0
    assert language.label_spans(odd, language.train(none)).where("lang_pred != 'und'").count() == 0


def test_quality_held_out(spark, odd, none):
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    model = quality.train(docs, labels)
    rows = quality.score_quality(docs, model).join(labels, "doc_id").where("held_out").collect()
    good, bad = [r["score"] for r in rows if r["quality"] == 1], [r["score"] for r in rows if r["quality"] == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.97
    assert np.mean([g >= 0.7 for g in good]) > 0.97
    out = quality.score_quality(odd, model).collect()
    assert len(out) == odd.count() and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in out)
    assert quality.score_quality(none, model).count() == 0
    kept = quality.keep_good(odd, labels)
    assert kept.columns == odd.columns
    assert quality.keep_good(none, labels.limit(0)).count() == 0


def test_quality_is_fitted_in_a_task(spark, monkeypatch):
    rows = [(i, f"text {i} is {'good and sound' if i % 2 else 'bad or poor'} as {i % 7} says") for i in range(80)]
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(i, i % 2) for i in range(80)], "doc_id long, quality int")
    learnt = [(i, t) for i, t in rows if zlib.crc32(str(i).encode()) % 4 != 2]
    held = [quality.features(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t)]))[0] for _, t in learnt]
    want = quality.fit(held, np.array([i % 2 for i, _ in learnt]))
    monkeypatch.setattr(quality, "fit", None)  # the driver's; tasks have their own
    got = quality.train(docs, labels)
    assert got.learnt and (got.bias, got.slope, got.shift) == (want.bias, want.slope, want.shift)
    assert (got.ratio == want.ratio).all() and (got.weight == want.weight).all()


def test_quality_filter_keeps_all_where_nothing_is_learnt(spark, odd):
    held_out = [i for i in range(200) if zlib.crc32(str(i).encode()) % 4 == 2]
    for rows in ([], [(i, i % 2) for i in held_out], [(4, 0), (5, 0), (6, 0)]):
        labels = spark.createDataFrame(rows, "doc_id long, quality int")
        assert quality.keep_good(odd, labels).count() == odd.count()


def test_quality_filter_keeps_the_rows_that_score_well(spark, odd):
    """Against the model applied to one text at a time, with repeated rows, null ids and null texts."""
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    every = docs.unionByName(docs.limit(40)).unionByName(odd.select(docs.columns))
    model = quality.train(every, labels)

    def score(text):
        raw = np.frombuffer((text or "").encode(), np.uint8)
        return model.scores(model.margins(*quality.features(raw, np.array([0, len(raw)])), 1))[0]

    rows = [(str(r["doc_id"]), str(r["text"]), score(r["text"])) for r in every.collect()]
    assert all(abs(s - 0.7) > 1e-9 for _, _, s in rows)
    want = sorted((d, t) for d, t, s in rows if s >= 0.7)
    got = quality.keep_good(every, labels)
    assert got.columns == every.columns and sorted((str(r["doc_id"]), str(r["text"])) for r in got.collect()) == want
    assert 0 < len(want) < len(rows) and len(set(want)) < len(want)


def test_features_for_the_driver_are_bounded(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    whole, some = quality.train(docs, labels), quality.train(docs, labels, sample_bytes=200_000)
    assert some.learnt and not np.array_equal(whole.weight, some.weight)
    assert not quality.train(docs, labels, sample_bytes=0).learnt


def test_dual_descent_separates():
    rng = np.random.default_rng(5)
    rows = [np.sort(rng.choice(50, 8, replace=False)) + (100 if i % 2 else 0) for i in range(60)]
    label = np.array([i % 2 for i in range(60)])
    model = quality.fit(rows, label)
    margins = [model.margins(x, np.zeros(len(x), int), 1)[0] for x in rows]
    assert all((m > 0) == bool(y) for m, y in zip(margins, label))
    weight, bias = quality.dual_descent(rows, label, model.ratio.astype(float), cost=1.0, epochs=200)
    # at the optimum no single dual step helps: the hinge loss is near the best of small moves of the bias
    loss = lambda b: sum(max(0, 1 - s * (weight[x] @ (v := model.ratio[x].astype(float) / np.linalg.norm(model.ratio[x])) + b)) for x, s in zip(rows, 2 * label - 1)) + 0.5 * (weight @ weight + b * b)
    assert loss(bias) <= min(loss(bias + 0.05), loss(bias - 0.05)) + 1e-3
