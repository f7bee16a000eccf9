"""Alignment of two tokenizers against the libraries' own tokens, cut and linked by brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer, pre_tokenizers

from citeloom.llm import alignment, queries

RANKS, MODEL = P.path("byte_bpe_50k.tiktoken"), P.path("piece_bpe_32k.model")


def _bytes_of_characters():
    """The byte that each character of a byte-level vocabulary stands for, taken from the library."""
    level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    out = {}
    for code in range(0x110000):
        if 0xD800 <= code < 0xE000:
            continue
        raw = chr(code).encode()
        shown = level.pre_tokenize_str(chr(code))[0][0]
        out.update(zip(shown, raw))
        if len(out) >= 243:  # the bytes that UTF-8 uses
            return out
        if code > 0x500:
            for high in (0x800, 0x1000, 0x2000, *range(0x3000, 0xD000, 0x1000), 0xE000, 0xF000, 0x10000, 0x40000, 0x80000, 0xC0000, 0x100000):
                shown = level.pre_tokenize_str(chr(high))[0][0]
                out.update(zip(shown, chr(high).encode()))
            for low in range(0x500, 0x800):
                out.update(zip(level.pre_tokenize_str(chr(low))[0][0], chr(low).encode()))
            return out


def brute_force(texts):
    byte_level = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    byte_level.encode_special_tokens = True  # their strings in texts are plain text, by the contract
    pieces = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    byte_of, held = _bytes_of_characters(), []
    for text in texts:
        a, b = (byte_level.encode(" " + text, add_special_tokens=False).ids, pieces.encode(text)) if text else ([], [])
        raw_a = [bytes(byte_of[c] for c in byte_level.id_to_token(i)) for i in a]
        raw_b = [bytes([int(pieces.id_to_piece(i)[3:5], 16)]) if pieces.is_byte(i) else pieces.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not text or b"".join(raw_a) != (" " + text).encode() or b"".join(raw_b) != (" " + text).encode():
            held.append((0, 0, [], Counter()))
            continue
        ends_a, ends_b = np.cumsum([len(x) for x in raw_a]), np.cumsum([len(x) for x in raw_b])
        cuts = sorted({*ends_a.tolist()} & {*ends_b.tolist()})
        groups = [([], []) for _ in cuts]
        for ids, ends, side in ((a, ends_a, 0), (b, ends_b, 1)):
            for i, g in zip(ids, np.searchsorted(cuts, ends)):
                groups[g][side].append(i)
        held.append((len(a), len(b), groups, Counter((i, j) for x, y in groups for i in x for j in y)))
    count = Counter(pair for *_, links in held for pair in links)
    best: dict = {}
    for (i, _), n in count.items():
        best[i] = max(best.get(i, 0), n)
    for n_a, n_b, groups, links in held:
        name = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        digest = hashlib.sha256(name.encode()).hexdigest() if groups else ""
        yield n_a, n_b, len(groups), sum(links.values()), digest, sum(n for p, n in links.items() if count[p] == best[p[0]]), sum(n * count[p] for p, n in links.items())


def _rows(df):
    return [tuple(r) for r in df.collect()]


def test_statistics_against_brute_force(spark, small, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK_DOCUMENTS", 90)
    rng = random.Random(4)
    letters = " \n\t\xa0　aàé日本語ﬁ́'s.,!19zZ<|>\x85\x1c🙂   the ing"
    texts = [r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").select("text").collect()]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(400)]
    texts += [None, "", " ", "a" * 30_000, "日本" * 3000, " " * 500, "▁ literal", "a ▁", "<|endoftext|> hi <s> <0x0A>", "the same", "the same"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r[0]: r[1:] for r in _rows(alignment.link_statistics(df, RANKS, P.PATTERN, MODEL))}
    want = list(brute_force(texts))
    assert [got[i] for i in range(len(texts))] == want
    assert want[-5][:4] == want[-4][:4] == (0, 0, 0, 0)


def test_forgetting_and_parts_change_nothing(spark, small, monkeypatch):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").limit(60)
    before = sorted(_rows(alignment.align_tokens(docs, RANKS, P.PATTERN, MODEL)))
    own = alignment.Aligner(RANKS, P.PATTERN, MODEL)
    for name, least in (("STEPS_KEPT", 40), ("PART", 30), ("MANY_LINKS", 1)):
        monkeypatch.setattr(alignment, name, least)
    assert own.text("a longer text " * 9)[0][:2] == alignment.Aligner(RANKS, P.PATTERN, MODEL).text("a longer text " * 9)[0][:2]
    assert [(r["doc_id"], *own.text(r["text"])[0], own.text(r["text"])[1]) for r in docs.orderBy("doc_id").collect()] == before


def test_ends_of_groups_of_a_transducer():
    own = alignment.Transducer([b"ab", b"c", b"de", b"f"], [b"a", b"bcd", b"ef", b"abc", b"def"])
    assert own.ends([0, 1, 2, 3], [0, 1, 2]).tolist() == [[4, 3]]
    assert own.ends([0, 1, 2, 3], [3, 4]).tolist() == [[2, 1], [4, 2]]
    assert own.ends([], []).tolist() == []


def test_odd_rows(spark, odd, none):
    rows = _rows(alignment.link_statistics(odd, RANKS, P.PATTERN, MODEL))
    assert len(rows) == odd.count() and sum(r[0] is None for r in rows) == 1 and sum(r[0] == 3 for r in rows) == 3
    assert all(r[1:] == (0, 0, 0, 0, "", 0, 0) for r in rows if r[0] in (0, 1))
    assert alignment.link_statistics(none, RANKS, P.PATTERN, MODEL).count() == alignment.align_tokens(none, RANKS, P.PATTERN, MODEL).count() == 0


@pytest.mark.parametrize("name", ["op12_tokenizer_alignment"])
def test_query_has_a_row_for_each_document(spark, small, name):
    rows = queries.queries()[name](spark, small)
    assert rows.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]
    assert rows.count() == spark.read.parquet(f"{small}/documents.parquet").count()


def test_the_piece_model_gets_stretches_and_ordinary_texts_are_not_cut_by_the_pattern(monkeypatch):
    from citeloom.llm import packing

    own = alignment.Aligner(RANKS, P.PATTERN, MODEL)
    rng = random.Random(5)
    text = " ".join("".join(rng.choices("abcdeé ü1.,\n", k=rng.randint(1, 9))) for _ in range(6000))
    seen = []

    class Pieces:
        def encode(self, x, held=own.pieces):
            seen.append(len(x))
            return held.encode(x)

    cut = []
    monkeypatch.setattr(packing, "compile_pattern", lambda pattern: cut.append(pattern))
    own.pieces = Pieces()
    got = own.text(text)
    assert max(seen) < 3 * alignment.STRETCH and not cut and len(text) > packing.LONG_TEXT
    monkeypatch.setattr(alignment, "STRETCH", 10**9)
    whole = own.text(text)
    assert got[:2] == whole[:2] and (got[2] == whole[2]).all() and (got[3] == whole[3]).all() and got[0][0] > 0
    for long in ("x" * packing.LONG_WORD, "a" + " " * packing.LONG_WORD, "y " + "é" * (packing.LONG_WORD - 1)):
        assert packing.long_runs("word " * 9 + long)
