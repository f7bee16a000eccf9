"""Byte-level BPE over a fixed rank vocabulary.

A text is cut into the matches of the vocabulary's pattern; a match is encoded by backtracking from longest tokens, which
an Aho-Corasick automaton over the tokens (bytes written as Latin-1 characters) finds in one pass.  A token may follow
another only if merging their bytes in rank order would leave the border between them untouched; that is decided once for
each pair and remembered.  A position from which no continuation exists is marked, so each match takes linear time.
"""

from __future__ import annotations

import base64
import struct
from functools import lru_cache

import ahocorasick
import regex

#: Fixed value: the Unicode White_Space characters, which \s means in the vocabulary's pattern.
WHITE_SPACE = "\t\n\x0b\x0c\r\x20\x85\xa0                　"
_OTHER_SPACE = [c for c in WHITE_SPACE if c not in " \n"]
_GLUED = ["  ", "\n\n", " \n", "\n "]


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def compile_pattern(pattern: str) -> regex.Pattern:
    """The pattern, with \\s and \\S standing for Unicode white space exactly."""
    chars = regex.escape(WHITE_SPACE, special_only=False)
    return regex.compile(pattern.replace(r"[^\s", f"[^{chars}").replace(r"\S", f"[^{chars}]").replace(r"\s", f"[{chars}]"))


def simple_spacing(text: str) -> bool:
    """Whether white space is single blanks and line feeds between other characters; then each blank starts a new match."""
    return not any(c in text for c in _GLUED) and not any(c in text for c in _OTHER_SPACE)


class BytePairEncoder:
    """Exact encoding of single pattern matches under byte-pair merges in rank order."""

    PAIRS = 1 << 19

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.length = {rank: len(token) for rank, token in self.tokens.items()}
        self.made: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        self.shorter: dict[int, int | None] = {}
        self.pairs: dict[int, bool] = {}
        self.automaton = ahocorasick.Automaton()
        for rank in sorted(self.tokens):
            token = self.tokens[rank]
            if len(token) == 1 or self._find_merge(rank, token):
                self.automaton.add_word(token.decode("latin-1"), rank)
        self.automaton.make_automaton()
        for rank, token in self.tokens.items():
            shorter = (ranks.get(token[:k]) for k in range(len(token) - 1, 0, -1))
            self.shorter[rank] = next((x for x in shorter if x is not None and (self.length[x] == 1 or x in self.made)), None)

    def _find_merge(self, rank: int, token: bytes) -> bool:
        """Record the two tokens whose merge makes this one; False where no order of merges reaches it."""
        for k in range(len(token) - 1, 0, -1):
            left, right = self.ranks.get(token[:k]), self.ranks.get(token[k:])
            if left is None or right is None or left >= rank or right >= rank:
                continue
            if all(self.length[x] == 1 or x in self.made for x in (left, right)) and self._border(left, right, rank):
                self.made[rank] = (left, right)
                self.merged[left, right] = rank
                return True
        return False

    def _border(self, left: int, right: int, limit: int) -> bool:
        """Whether merges below `limit` leave the border between two tokens.

        The tokens are taken apart in the reverse order of their merges; on the way, a merge of the pieces that touch
        the border must not come before the merge that took either piece away.
        """
        while True:
            joined = self.merged.get((left, right))
            if joined is not None and joined < limit:
                return False
            if left > right:
                limit = left
                part = self.made.get(left)
                if part is not None:
                    left = part[1]
                    continue
                limit = right + 1
                part = self.made.get(right)
                if part is None:
                    return True
                right = part[0]
            else:
                limit = right + 1
                part = self.made.get(right)
                if part is not None:
                    right = part[0]
                    continue
                limit = left
                part = self.made.get(left)
                if part is None:
                    return True
                left = part[1]

    def compatible(self, left: int, right: int) -> bool:
        key = left << 32 | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= self.PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self._border(left, right, 1 << 62)
        return known

    def encode(self, piece: bytes) -> list[int]:
        """The ids of one match; a match that is a token is that token."""
        if piece in self.ranks:
            return [self.ranks[piece]]
        n = len(piece)
        longest: list[int | None] = [None] * (n + 1)
        length, shorter, pairs = self.length, self.shorter, self.pairs
        for end, rank in self.automaton.iter(piece.decode("latin-1")):
            longest[end + 1 - length[rank]] = rank  # ends come in order, so a later one from the same start is longer
        alive = bytearray(b"\1") * (n + 1)
        out: list[int] = []
        at, token = 0, longest[0]
        while token is not None:
            last = out[-1] if out else None
            while token is not None:
                end = at + length[token]
                if alive[end] and (last is None or (ok := pairs.get(last << 32 | token)) or ok is None and self.compatible(last, token)):
                    break
                token = shorter[token]
            if token is None:
                alive[at] = 0
                if not out:
                    raise ValueError("the vocabulary lacks a byte")
                token = out.pop()
                at -= length[token]
            else:
                out.append(token)
                at = end
                token = longest[at]
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class Memo(dict):
    """A function's results by argument; emptied when it has too many, so memory stays bounded."""

    def __init__(self, function, most: int):
        super().__init__()
        self.function, self.most = function, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        value = self[key] = self.function(key)
        return value


def _packed(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit integers."""
    return struct.pack(f"<{len(ids)}I", *ids)


class TextEncoder:
    """Ids of whole texts, as little-endian unsigned 32-bit integers.

    encode_piece gives the ids of one match of the pattern.  Where a text's white space is simple, it is cut at blanks
    and line feeds, which are borders of matches; the ids of each part are remembered.
    """

    WORDS, LONGEST = 250_000, 64

    def __init__(self, pattern: regex.Pattern, encode_piece):
        self.pattern, self.encode_piece = pattern, encode_piece
        self.first = Memo(lambda word: self._part(word), self.WORDS // 5)
        self.after_blank = Memo(lambda word: self._part(" " + word), self.WORDS)
        self.line_feed = self._part("\n")

    def _ids(self, piece: str) -> bytes:
        return _packed(self.encode_piece(piece.encode()))

    def _part(self, part: str) -> bytes:
        if part.strip(" ").isalpha():
            return self._ids(part)
        return b"".join(map(self._ids, self.pattern.findall(part)))

    def encode(self, text: str) -> bytes:
        if not simple_spacing(text):
            return b"".join(self._part(piece) if len(piece) > self.LONGEST else self.first[piece] for piece in self.pattern.findall(text))
        lines = []
        for line in text.split("\n"):
            words = line.split(" ")
            if len(line) > self.LONGEST * len(words):  # do not remember very long words
                lines.append(b"".join(self._part(" " * (k > 0) + w) for k, w in enumerate(words)))
            else:
                lines.append(self.first[words[0]] + b"".join(map(self.after_blank.__getitem__, words[1:])))
        return self.line_feed.join(lines)


@lru_cache(maxsize=4)
def encoder(path: str, pattern: str) -> tuple[BytePairEncoder, TextEncoder]:
    """One encoder for each vocabulary in a worker."""
    exact = BytePairEncoder(read_ranks(path))
    return exact, TextEncoder(compile_pattern(pattern), exact.encode)
