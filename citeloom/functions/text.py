"""Text columns: cleaning, author strings, ranges, labels, prompts and keys."""

from __future__ import annotations

import functools
import json
from html.entities import html5

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Unicode white space, as Python's str methods know it.
SPACE = r"(?U)\s+"
#: Rows whose chunks are held as Python objects at a time.
SLICE = 64


def bind(value: Column, use) -> Column:
    """use(value), with value computed once."""
    return F.transform(F.array(value), use)[0]


def squeeze(c: Column) -> Column:
    """One line: every run of white space is one blank, none at the ends."""
    return F.regexp_replace(F.regexp_replace(c, SPACE, " "), r"^ | $", "")


def strip(c: Column) -> Column:
    """Without white space at the ends, including other than blanks."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


@functools.cache
def _folded() -> str:
    """Characters whose case folding is not their small letter, with it, as JSON."""
    return json.dumps({c: c.casefold() for c in map(chr, [*range(0xD800), *range(0xE000, 0x20000)]) if c.casefold() != c.lower()})


def casefold(c: Column) -> Column:
    """For comparison whatever the case: small letters, and what Unicode folds further, such as sharp s."""
    table = F.from_json(F.lit(_folded()), "map<string,string>")
    folded = F.array_join(F.transform(F.split(c, ""), lambda x: F.coalesce(F.try_element_at(table, x), F.lower(x))), "")
    return F.when(c.rlike(r"[^\x00-\x7F]"), folded).otherwise(F.lower(c))


def key(c: Column) -> Column:
    """A key as text: null is empty, no white space around."""
    return F.coalesce(strip(c.cast("string")), F.lit(""))


#: Numbers of characters that references give for numbers that name none, from 128 on in order.
_C1 = [0x20AC, 0x81, 0x201A, 0x192, 0x201E, 0x2026, 0x2020, 0x2021, 0x2C6, 0x2030, 0x160, 0x2039, 0x152, 0x8D, 0x17D, 0x8F, 0x90, 0x2018, 0x2019, 0x201C, 0x201D, 0x2022, 0x2013, 0x2014, 0x2DC, 0x2122, 0x161, 0x203A, 0x153, 0x9D, 0x17E, 0x178]
_REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"


def _numbered(c: Column) -> Column:
    """The character of a numeric reference, by the rules of HTML 5: none for numbers that stand for nothing."""
    digits = F.regexp_replace(F.regexp_extract(c, r"^&#[xX]?([0-9a-fA-F]+)", 1), "^0+", "")
    value = F.when(F.lower(F.substring(c, 3, 1)) == "x", F.conv(digits, 16, 10)).otherwise(F.conv(digits, 10, 10))
    # numbers of more than eight digits are beyond all characters
    number = F.when(F.length(digits) > 8, F.lit(1 << 32)).otherwise(F.coalesce(value, F.lit("0")).cast("long"))

    def of(n: Column) -> Column:
        mapped = F.when(n.between(128, 159), F.get(F.array(*map(F.lit, _C1)), (n - 128).cast("int")).cast("long")).otherwise(n)
        bad = (n == 0) | n.between(0xD800, 0xDFFF) | (n > 0x10FFFF)
        nothing = n.between(1, 8) | (n == 11) | n.between(14, 31) | (n == 127) | n.between(0xFDD0, 0xFDEF) | (n % 65536 >= 65534)
        sign = F.decode(F.unhex(F.lpad(F.hex(F.when(bad, F.lit(32).cast("long")).otherwise(mapped)), 8, "0")), "UTF-32")
        return F.when(bad, F.lit("\ufffd")).when(nothing, F.lit("")).otherwise(sign)

    return bind(number, of)


@functools.cache
def _entities() -> tuple[str, str]:
    """(names with their characters as JSON, an expression of the names that need no semicolon, longer ones first)."""
    bare = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
    return json.dumps({f"&{n}": sign for n, sign in html5.items()}), "^&(?:" + "|".join(bare) + ")"


def unescape(c: Column) -> Column:
    """Character references as the characters that they stand for, in the JVM: numbers, names, and names that begin others."""
    table, bare = _entities()
    names = F.from_json(F.lit(table), "map<string,string>")

    def one(ref: Column) -> Column:
        begins = F.regexp_extract(ref, bare, 0)
        named = F.coalesce(F.try_element_at(names, ref), F.concat(F.try_element_at(names, begins), F.substr(ref, F.length(begins) + 1)), ref)
        return F.when(F.startswith(ref, F.lit("&#")), _numbered(ref)).otherwise(named)

    between = F.split(c, _REFERENCE, -1)
    found = F.concat(F.transform(F.regexp_extract_all(c, F.lit(_REFERENCE), F.lit(0)), one), F.array(F.lit("")))
    return F.array_join(F.zip_with(between, found, lambda a, b: F.concat(a, b)), "")


def clean_html(c: Column) -> Column:
    """Character references first, then tags on one line are deleted, so an escaped tag goes as well."""
    plain = F.when(F.contains(c, F.lit("&")), unescape(c)).otherwise(c)
    return F.regexp_replace(plain, r"<[^\n\r]*?>", "")


#: The entities that strip_tags decodes without Python.
BASIC_ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&nbsp;": "\xa0", "&amp;": "&"}


def strip_tags(c: Column) -> Column:
    """clean_html for texts whose only entities are BASIC_ENTITIES; stays in the JVM."""
    for entity, sign in BASIC_ENTITIES.items():
        c = F.replace(c, F.lit(entity), F.lit(sign))
    return F.regexp_replace(c, r"<[^\n\r]*?>", "")


def clean_range(c: Column) -> Column:
    """What stands before the first hyphen."""
    return strip(F.split_part(c, F.lit("-"), F.lit(1)))


def page_range(c: Column) -> Column:
    """struct(first, last) of a page range on a hyphen, en dash or em dash; missing parts are empty."""
    parts = F.split(strip(F.coalesce(c, F.lit(""))), r"(?U)\s*[-–—]\s*", 2)
    return bind(parts, lambda p: F.struct(strip(p[0]).alias("first"), F.coalesce(strip(F.try_element_at(p, F.lit(2))), F.lit("")).alias("last")))


def flatten_newlines(c: Column) -> Column:
    """Line feeds, real ones and written as backslash and n, become blanks."""
    return F.replace(F.replace(c, F.lit("\\n"), F.lit(" ")), F.lit("\n"), F.lit(" "))


def without_hyphens(authors: Column) -> Column:
    """Author names without hyphens; blank names go."""
    return F.transform(F.filter(authors, lambda a: strip(a) != ""), lambda a: F.replace(a, F.lit("-"), F.lit("")))


def parse_authors(c: Column) -> Column:
    """The names of an author string; null has none.

    Cut at semicolons and at `and` or `&` between blanks; a leading `and` or `&` and a closing `et al` go, then blanks,
    commas and semicolons at the ends; `12 colleagues` is nobody.
    """
    chunks = F.filter(F.transform(F.split(c, ";"), strip), lambda p: p != "")
    parts = F.flatten(F.transform(chunks, lambda p: F.split(p, r"(?U)\s+(?:and|&)\s+")))
    parts = F.transform(parts, lambda p: F.regexp_replace(p, r"(?iU)^(?:and|&)\s+", ""))
    parts = F.transform(parts, lambda p: F.regexp_replace(p, r"(?iU),?\s*et\s*al\.?$", ""))
    parts = F.transform(parts, lambda p: F.regexp_replace(p, r"^[ ,;]+|[ ,;]+$", ""))
    named = F.filter(parts, lambda p: (p != "") & ~p.rlike(r"(?iU)^(?:and\s+)?\d+\s+colleagues\.?$"))
    return F.coalesce(named, F.array().cast("array<string>"))


def authors_text(authors: Column) -> Column:
    return F.array_join(authors, "; ")


def split_authors(c: Column) -> Column:
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ";"), strip), lambda a: a != "")


def surname(author: Column) -> Column:
    """Before the comma, or else the last word; null for blank names."""
    words = F.split(strip(author), SPACE)
    name = F.when(F.contains(author, F.lit(",")), strip(F.split_part(author, F.lit(","), F.lit(1)))).otherwise(F.try_element_at(words, F.lit(-1)))
    return F.nullif(name, F.lit(""))


def first_text(*columns: Column) -> Column:
    """The first text that is neither null nor blank."""
    return F.coalesce(*(F.when(strip(c) != "", c) for c in columns), F.lit(""))


def full_text(title: Column, abstract: Column) -> Column:
    """Title, a full stop and the abstract; missing ones are empty and the stop stays."""
    return F.concat(F.coalesce(title, F.lit("")), F.lit(". "), F.coalesce(abstract, F.lit("")))


def without_thinking(c: Column) -> Column:
    """What follows a model's closed thinking block."""
    tail = F.when(F.contains(c, F.lit("</think>")), F.regexp_extract(c, r"(?s)</think>(.*)$", 1)).otherwise(c)
    return strip(tail)


def topic_label(c: Column) -> Column:
    """The first line of a model's answer without a `topic:` prefix or quotes."""
    line = F.split_part(strip(c), F.lit("\n"), F.lit(1))
    return F.regexp_replace(strip(F.regexp_replace(line, r"(?i)^\s*topic\s*:", "")), r"^[\"'*]+|[\"'*.]+$", "")


def shorten(c: Column, most: int = 200) -> Column:
    return F.when(F.length(c) > most, F.concat(F.substring(c, 1, most), F.lit("..."))).otherwise(c)


def escape_html(c: Column) -> Column:
    for sign, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        c = F.replace(c, F.lit(sign), F.lit(entity))
    return c


def badges(labels: Column) -> Column:
    """A row of escaped labels as HTML badges."""
    return F.array_join(F.transform(F.filter(labels, lambda x: F.coalesce(x, F.lit("")) != ""), lambda x: F.concat(F.lit('<span class="badge">'), escape_html(x), F.lit("</span>"))), "")


def fill_prompt(template: str, keywords: Column, documents: Column, most: int = 255) -> Column:
    """A template with [KEYWORDS] and [DOCUMENTS], the documents cut to a length and listed."""
    listed = F.array_join(F.transform(documents, lambda d: F.concat(F.lit("- "), F.substring(d, 1, most))), "\n")
    return F.replace(F.replace(F.lit(template), F.lit("[KEYWORDS]"), F.array_join(keywords, ", ")), F.lit("[DOCUMENTS]"), listed)


def translation_messages(c: Column, source: Column, target: str) -> Column:
    """The chat messages that ask for a translation."""
    system = F.concat(F.lit("Translate from "), F.coalesce(source, F.lit("the detected language")), F.lit(f" to {target}. Return only the translation."))
    return F.array(F.struct(F.lit("system").alias("role"), system.alias("content")), F.struct(F.lit("user").alias("role"), c.alias("content")))


def chunk_text(text: str, most: int = 12_000, overlap: int = 1_500) -> list[str]:
    """Chunks of at most `most` characters that end at paragraphs, sentences or words where they can, and overlap."""
    chunks, start = [], 0
    while start < len(text):
        end = min(len(text), start + most)
        if end < len(text):
            for sign in ("\n\n", ". ", " "):
                cut = text.rfind(sign, start + most // 2, end)
                if cut > 0:
                    end = cut + len(sign)
                    break
        chunks.append(text[start:end])
        if end >= len(text):
            break
        start = max(end - overlap, start + 1)
    return chunks


def merge_chunks(chunks: list[str], words: int = 24) -> str:
    """Chunks joined, without the words, up to a number, that a chunk repeats from the end of the one before."""
    out: list[str] = []
    for chunk in chunks:
        own = chunk.split()
        low, held = [w.casefold() for w in own], [w.casefold() for w in out]
        repeat = next((n for n in range(min(words, len(own), len(out)), 0, -1) if held[-n:] == low[:n]), 0)
        out += own[repeat:]
    return " ".join(out)


def _sliced(values: pa.Array, function, kind: pa.DataType) -> pa.Array:
    """function of each value; of only a few values at a time are there Python objects."""
    parts = [pa.array([function(x) for x in values.slice(k, SLICE).to_pylist()], kind) for k in range(0, len(values), SLICE)]
    return pa.concat_arrays(parts) if parts else pa.array([], kind)


def chunks(c: Column, most: int = 12_000, overlap: int = 1_500) -> Column:
    """chunk_text of each text; null gives no chunks."""

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def cut(texts: pa.Array) -> pa.Array:
        return _sliced(texts, lambda t: chunk_text(t or "", most, overlap), pa.list_(pa.string()))

    return cut(c)


@F.arrow_udf(T.StringType())
def merged(parts: pa.Array) -> pa.Array:
    """merge_chunks of each array of chunks."""
    return _sliced(parts, lambda p: merge_chunks([x for x in p if x is not None]) if p is not None else None, pa.string())
