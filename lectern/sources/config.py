"""Settings of the stages: frozen values, a YAML-like file of scalars, and key=value overrides."""

from __future__ import annotations

from dataclasses import dataclass, fields, replace
from typing import Any, TypeVar


@dataclass(frozen=True)
class Transcode:
    src: str = "data/video"
    dst: str = "data/audio"
    quality: int = 2


@dataclass(frozen=True)
class Transcribe:
    src: str = "data/audio"
    dst: str = "data/transcriptions"
    max_clip_seconds: float = 28.0
    max_no_speech_prob: float = 0.6
    min_avg_logprob: float = -1.0
    max_compression_ratio: float = 2.4


@dataclass(frozen=True)
class Preprocess:
    src: str = "data/transcriptions"
    dst: str = "data/preprocessed"
    max_ngram: int = 6
    min_count: int = 3
    remove_mixed_script: bool = True
    remove_fillers: bool = True


@dataclass(frozen=True)
class Summarize:
    src: str = "data/preprocessed"
    dst: str = "data/summaries"
    digest: str = "data/corpus_digest.txt"
    stats: str = "data/corpus_stats.json"
    words_per_minute: float = 140.0
    map_max_tokens: int = 1024
    reduce_max_tokens: int = 12000
    refresh: bool = False


@dataclass(frozen=True)
class Export:
    transcripts: str = "data/preprocessed"
    summaries: str = "data/summaries"
    digest: str = "data/corpus_digest.txt"
    dst: str = "data/corpus_markdown"
    sentences_per_paragraph: int = 5


@dataclass(frozen=True)
class Distribute:
    src: str = "data/corpus_markdown"
    digest: str = "data/corpus_markdown/corpus_digest.md"
    manifest: str = "data/topics_manifest.json"
    model: str = ""
    topics_max_tokens: int = 8192
    classify_max_tokens: int = 2048
    failed_only: bool = False


Settings = TypeVar("Settings")


def _scalar(text: str) -> Any:
    text = text.strip()
    if text[:1] in "'\"" and text[-1:] == text[:1] and len(text) > 1:
        return text[1:-1]
    if text.lower() in ("true", "false"):
        return text.lower() == "true"
    for kind in (int, float):
        try:
            return kind(text)
        except ValueError:
            pass
    return text


def parse(text: str) -> dict[str, Any]:
    """Scalars of a flat file of ``key: value`` lines; comments from # on."""
    out = {}
    for line in text.splitlines():
        line = line.split(" #")[0] if not line.lstrip().startswith("#") else ""
        key, colon, value = line.partition(":")
        if colon and value.strip():
            out[key.strip()] = _scalar(value)
    return out


def load(kind: type[Settings], text: str = "", overrides: tuple[str, ...] = ()) -> Settings:
    """Defaults, then the file, then ``key=value`` overrides; an unknown override raises."""
    names = {f.name for f in fields(kind)}
    given = {k: v for k, v in parse(text).items() if k in names}
    for o in overrides:
        key, _, value = o.partition("=")
        if key not in names:
            raise KeyError(f"unknown setting: {key}")
        given[key] = _scalar(value)
    return replace(kind(), **given)
