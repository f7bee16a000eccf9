"""Typed configuration with strict keys, dotted overrides, presets and redaction of secrets."""

from __future__ import annotations

import copy
import dataclasses
import re
from dataclasses import dataclass, field
from typing import Any

import yaml


@dataclass(frozen=True)
class RunSection:
    name: str = "run"
    start_stage: str = "search"
    stop_stage: str = "citations"
    seed: int = 42


@dataclass(frozen=True)
class SearchSection:
    query: str = ""
    url: str = ""
    rows: int = 2000
    token: str | None = None
    link: str = "{bibcode}/{resource}"
    transport: str = ""
    cache: str | None = None
    pause: float = 0.0


@dataclass(frozen=True)
class ExportSection:
    url: str = ""
    format: str = ""
    chunk: int = 2000
    workers: int = 5
    transport: str = ""
    cache: str | None = None


@dataclass(frozen=True)
class SourceSection:
    publications: str | None = None
    references: str | None = None


@dataclass(frozen=True)
class TranslateSection:
    enabled: bool = True
    provider: str = "identity"
    target: str = "en"
    columns: tuple[str, ...] = ("Title", "Abstract")
    profiles: str | None = None


@dataclass(frozen=True)
class TokenizeSection:
    min_length: int = 3


@dataclass(frozen=True)
class AuthorSection:
    enabled: bool = True
    provider: str = "blocking"
    cache: str | None = None


@dataclass(frozen=True)
class TopicSection:
    embedder: str = "hash"
    dimensions: int = 64
    embedding_cache: str | None = None
    reduction_cache: str | None = None
    reduction: str = "pca"
    reduction_params: dict = field(default_factory=dict)
    clusterer: str = "kmeans"
    clusters: int = 10
    sample_size: int | None = None
    outlier_threshold: float = 0.5
    top_terms: int = 20
    labeler: str = "keywords"
    layers: int = 1
    working_layer: int | str = "auto"


@dataclass(frozen=True)
class VisualizeSection:
    enabled: bool = True
    title: str = "{n_documents} documents, {n_topics} topics"


@dataclass(frozen=True)
class CurationSection:
    clusters_to_remove: tuple = ()
    layered_clusters_to_remove: tuple = ()


@dataclass(frozen=True)
class CitationSection:
    metrics: tuple[str, ...] = ("direct", "co_citation", "bibliographic_coupling", "author_co_citation")
    min_counts: dict = field(default_factory=dict)
    output_format: str = "csv"
    authors: tuple[str, ...] = ()
    author_uids: tuple[str, ...] = ()
    exclude_authors: tuple[str, ...] = ()
    exclude_uids: tuple[str, ...] = ()


@dataclass(frozen=True)
class Config:
    run: RunSection = RunSection()
    search: SearchSection = SearchSection()
    export: ExportSection = ExportSection()
    source: SourceSection = SourceSection()
    translate: TranslateSection = TranslateSection()
    tokenize: TokenizeSection = TokenizeSection()
    authors: AuthorSection = AuthorSection()
    topic: TopicSection = field(default_factory=TopicSection)
    visualize: VisualizeSection = VisualizeSection()
    curation: CurationSection = CurationSection()
    citations: CitationSection = field(default_factory=CitationSection)

    def __post_init__(self):
        if self.citations.output_format not in ("csv", "gexf", "graphology", "all"):
            raise ValueError(f"unknown output format {self.citations.output_format!r}")
        if not 0 <= self.topic.outlier_threshold <= 1:
            raise ValueError("topic.outlier_threshold lies between 0 and 1")
        for name, value in (("search.rows", self.search.rows), ("export.chunk", self.export.chunk), ("export.workers", self.export.workers), ("topic.clusters", self.topic.clusters),
                            ("topic.dimensions", self.topic.dimensions), ("topic.layers", self.topic.layers), ("tokenize.min_length", self.tokenize.min_length)):
            if isinstance(value, bool) or not isinstance(value, int) or value < 1:
                raise ValueError(f"{name} must be a positive whole number, not {value!r}")
        if unknown := set(self.citations.metrics) - {"direct", "co_citation", "bibliographic_coupling", "author_co_citation"}:
            raise ValueError(f"unknown metrics: {', '.join(sorted(unknown))}")


PRESETS: dict[str, dict] = {
    "offline": {},
    "flat": {"topic": {"clusterer": "kmeans", "clusters": 20}},
    "citations_only": {"translate": {"enabled": False}, "visualize": {"enabled": False}, "authors": {"enabled": False}},
    "density": {"topic": {"clusterer": "density"}},
    "hierarchy": {"topic": {"clusters": 27, "layers": 3}},
}


def as_dict(config: Config) -> dict:
    return dataclasses.asdict(config)


def from_dict(values: dict) -> Config:
    """A configuration from nested mappings; unknown keys are errors that name what is known."""
    sections = {}
    known = {f.name: f for f in dataclasses.fields(Config)}
    for name, own in values.items():
        if name not in known:
            raise ValueError(f"unknown section {name!r}; known: {', '.join(known)}")
        kind = type(getattr(Config(), name))
        keys = {f.name for f in dataclasses.fields(kind)}
        if bad := sorted(set(own) - keys):
            raise ValueError(f"unknown keys in {name}: {', '.join(bad)}; known: {', '.join(sorted(keys))}")
        sections[name] = kind(**{k: tuple(v) if isinstance(v, list) else v for k, v in own.items()})
    return Config(**sections)


def merge(base: dict, over: dict) -> dict:
    out = copy.deepcopy(base)
    for k, v in over.items():
        out[k] = merge(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) and k in dataclasses.asdict(Config()) else copy.deepcopy(v)
    return out


def parse_override(text: str) -> tuple[str, Any]:
    """`section.key=value`, the value as a YAML scalar or list."""
    path, sign, value = text.partition("=")
    if not sign or path.count(".") != 1:
        raise ValueError(f"an override is section.key=value: {text!r}")
    return path.strip(), yaml.safe_load(value)


def with_overrides(config: Config, overrides: dict[str, Any]) -> Config:
    values = as_dict(config)
    for path, value in overrides.items():
        section, key = path.split(".", 1)
        if section not in values or key not in values[section]:
            raise ValueError(f"unknown setting {path!r}")
        values[section][key] = value
    return from_dict(values)


def load(preset: str = "offline", path: str | None = None, overrides: list[str] | None = None) -> Config:
    if preset not in PRESETS:
        raise ValueError(f"unknown preset {preset!r}; known: {', '.join(PRESETS)}")
    values = merge(as_dict(Config()), PRESETS[preset])
    if path:
        with open(path, encoding="utf-8") as text:
            values = merge(values, yaml.safe_load(text) or {})
    return with_overrides(from_dict(values), dict(map(parse_override, overrides or [])))


def changed_settings(old: Config, new: Config) -> list[str]:
    a, b = as_dict(old), as_dict(new)
    return sorted(f"{s}.{k}" for s in a for k in a[s] if a[s][k] != b[s][k])


_SECRET_KEY = re.compile(r"(?i)(token|secret|password|api_?key|credential)")
_SECRET_VALUE = re.compile(r"(?i)\b(bearer\s+\S+|sk-[a-z0-9-]{8,}|hf_[a-z0-9]{8,})")


def redact(value: Any, key: str = "") -> Any:
    """A copy without secrets, by names of keys and shapes of values."""
    if isinstance(value, dict):
        return {k: redact(v, str(k)) for k, v in value.items()}
    if isinstance(value, (list, tuple)):
        return [redact(v, key) for v in value]
    if value not in (None, "") and _SECRET_KEY.search(key):
        return "***"
    return _SECRET_VALUE.sub("***", value) if isinstance(value, str) else value


def fill_title(template: str, values: dict[str, Any]) -> str:
    """Known placeholders filled; unknown ones stay as they are."""
    return re.sub(r"\{(\w+)\}", lambda m: str(values[m[1]]) if m[1] in values else m[0], template)
