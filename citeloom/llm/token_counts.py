"""Token counts by a unigram model, with the forward scores of shared prefixes computed once.

The vocabulary files state an order of pieces and no probabilities, and none may be trained, so the piece of rank r has the
Zipf probability of its rank, in proportion to 1 / (r + 1): frequent pieces come first in such files.  The distinct
pre-tokens of a task's texts are inserted in a trie, whose nodes are scored once; the counts at the ends of pre-tokens
are stored, and a document's count is their sum.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.llm.bpe import compile_pattern, read_ranks, simple_spacing
from citeloom.llm.byte_bpe import texts_of


class UnigramTrie:
    """A trie of pre-tokens, with the best split of each prefix into pieces; of equally probable splits, the shortest.

    A node is a prefix.  It is scored once, when the first pre-token through it is inserted, from the nodes above it on
    the path; a pre-token whose path is there already only reads the count stored at its end.
    """

    def __init__(self, ranks: dict[bytes, int]):
        total = math.log(sum(1 / (r + 1) for r in ranks.values()))
        self.score = {piece: -math.log(rank + 1) - total for piece, rank in ranks.items()}
        #: by the last three bytes of a prefix, or all of a shorter one, the lengths of pieces that may end there
        ends: dict[bytes, set[int]] = {}
        for piece in ranks:
            ends.setdefault(piece[-3:], set()).add(len(piece))
        short = {tail: {n for k in range(1, len(tail) + 1) for n in ends.get(tail[-k:], ()) if n <= k} for tail in {p[-k:] for p in ranks for k in (1, 2, 3)}}
        self.ends = {tail: tuple(sorted(short[tail] | ends.get(tail, set()))) for tail in short}
        self.clear()

    def clear(self) -> None:
        """Leave the root alone."""
        #: children by 256 * node + byte, and by node the score of its best split and that split's number of pieces
        self.children: dict[int, int] = {}
        self.best, self.size = [0.0], [0]

    def lengths(self, tail: bytes) -> tuple[int, ...]:
        """Lengths of pieces that may end with these three bytes, or that these fewer bytes may be split at."""
        while tail not in self.ends:
            tail = tail[1:]
        return self.ends[tail]

    def counts(self, words: list[bytes]) -> dict[bytes, int]:
        """Insert pre-tokens; the number of pieces of the best split of each."""
        out: dict[bytes, int] = {}
        children, best, size, score, ends = self.children, self.best, self.size, self.score, self.ends
        for word in words:
            node, path, end = 0, [0], 0
            for byte in word:
                below = children.get(node << 8 | byte)
                if below is None:
                    break
                path.append(below)
                node = below
                end += 1
            for end in range(end + 1, len(word) + 1):
                top, pieces = -math.inf, 0
                tail = word[end - 3 : end] if end > 2 else word[:end]
                for n in ends.get(tail) or self.lengths(tail):
                    if n > end:
                        break
                    value = score.get(word[end - n : end])
                    if value is not None:
                        above = path[end - n]
                        value += best[above]
                        if value > top or value == top and size[above] + 1 < pieces:
                            top, pieces = value, size[above] + 1
                below = len(best)
                children[node << 8 | word[end - 1]] = below
                node = below
                path.append(node)
                best.append(top)
                size.append(pieces)
            out[word] = size[node]
        return out


@lru_cache(maxsize=4)
def trie(vocabulary: str) -> UnigramTrie:
    return UnigramTrie(read_ranks(vocabulary))


#: Texts that are counted at once: at most so many characters, or one longer text.
SLICE_CHARS = 4_000_000
#: The trie is kept from slice to slice until it has so many nodes.
MOST_NODES = 600_000
#: The counts of parts of texts are kept from slice to slice until there are so many.
MOST_PARTS = 300_000


def token_counts(docs: DataFrame, vocabulary: str, pattern: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id, n_pretokens, n_tokens.

    Pre-tokens are the matches of the pattern.  A null or empty text counts 0.  Ids may be null or repeat; further
    columns are not read.
    """

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, cut = trie(vocabulary), compile_pattern(pattern)
        stored: dict[str, int] = {}  # 2**32 times the pre-tokens of a part of a text and their pieces

        def count(texts: list[str]) -> list[tuple[int, int]]:
            parts, seen = [], set()
            for text in texts:
                if simple_spacing(text):
                    lines = [line.split(" ") for line in text.split("\n")]
                    own = [w if k == 0 else " " + w for words in lines for k, w in enumerate(words)] + ["\n"] * (len(lines) - 1)
                else:
                    own = cut.findall(text)
                parts.append(own)
                seen.update(own)
            if len(model.best) > MOST_NODES:
                model.clear()
            if len(stored) > MOST_PARTS:
                stored.clear()
            fresh = {part: [part] if part.strip(" ").isalpha() else cut.findall(part) for part in seen.difference(stored)}
            known = model.counts(list({piece.encode() for pieces in fresh.values() for piece in pieces}))
            stored.update((part, len(pieces) << 32 | sum([known[piece.encode()] for piece in pieces])) for part, pieces in fresh.items())
            sums = [sum(map(stored.__getitem__, own)) for own in parts]
            return [(x >> 32, x & 0xFFFFFFFF) for x in sums]

        for batch in batches:
            texts, held, found = [], 0, []
            for _, text in texts_of(batch):
                if texts and held + len(text) > SLICE_CHARS:
                    found += count(texts)
                    texts, held = [], 0
                texts.append(text)
                held += len(text)
            found += count(texts)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([x[k] for x in found], pa.int64()) for k in (0, 1))], ["doc_id", "n_pretokens", "n_tokens"])

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(over, "doc_id long, n_pretokens long, n_tokens long")
