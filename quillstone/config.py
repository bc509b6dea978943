"""Settings: frozen dataclasses read from YAML, with validation."""

from __future__ import annotations

import os
import re
from dataclasses import dataclass, field, replace
from pathlib import Path


class ConfigError(ValueError):
    """A setting that can't be used."""


PROVIDERS = ("openai", "claude", "gemini")
API_TYPES = ("openai", "anthropic", "gemini")
API_TYPE_OF = {"openai": "openai", "claude": "anthropic", "gemini": "gemini"}


@dataclass(frozen=True)
class Endpoint:
    name: str
    api_url: str
    api_key: str
    api_type: str = "openai"
    model: str = ""

    def __repr__(self) -> str:
        return f"Endpoint(name={self.name!r}, api_type={self.api_type!r}, model={self.model!r}, api_key='***')"


@dataclass(frozen=True)
class RuntimeConfig:
    timeout_seconds: int = 120
    max_retries: int = 3
    retry_delay_seconds: float = 2.0


@dataclass(frozen=True)
class ProviderLimits:
    gemini: float = 100
    claude: float = 200
    openai: float = 150

    def table(self) -> dict[str, float]:
        return {"gemini": self.gemini, "claude": self.claude, "openai": self.openai}


@dataclass(frozen=True)
class BatchingConfig:
    max_files_per_batch: int = 50
    max_batch_kb: float = 200
    max_file_kb: float = 200
    synthesize_kb: float = 200
    safety_margin: float = 0.85
    providers: ProviderLimits = field(default_factory=ProviderLimits)


@dataclass(frozen=True)
class ConcurrencyConfig:
    max_workers: int = 3


@dataclass(frozen=True)
class SimilarityConfig:
    threshold: float = 0.70
    ngram_size: int = 3
    llm_batch_size: int = 8
    max_file_size_kb: int = 100
    method: str = "embedding"
    embedding_model: str = ""
    embedding_batch_size: int = 100
    embedding_api_url: str = ""
    embedding_api_key: str = ""

    def __repr__(self) -> str:
        return f"SimilarityConfig(method={self.method!r}, threshold={self.threshold!r}, embedding_model={self.embedding_model!r}, embedding_api_key='***')"


@dataclass(frozen=True)
class StageConfig:
    name: str
    provider: str
    model: str
    system_prompt: str = ""
    api_type: str = "openai"
    endpoints: tuple[Endpoint, ...] = ()

    def __repr__(self) -> str:
        return f"StageConfig(name={self.name!r}, provider={self.provider!r}, model={self.model!r}, endpoints={len(self.endpoints)})"


@dataclass(frozen=True)
class PipelineConfig:
    input_dir: str = "input"
    output_dir: str = "output"
    mapping: dict[str, list[str]] = field(default_factory=dict)
    similarity: SimilarityConfig = field(default_factory=SimilarityConfig)
    batching: BatchingConfig = field(default_factory=BatchingConfig)
    concurrency: ConcurrencyConfig = field(default_factory=ConcurrencyConfig)
    runtime: RuntimeConfig = field(default_factory=RuntimeConfig)
    stages: dict[str, StageConfig] = field(default_factory=dict)


def _need(ok: bool, message: str) -> None:
    if not ok:
        raise ConfigError(message)


def parse_api_keys(raw: str | None) -> list[str]:
    """Keys parted by ASCII or full-width commas."""
    return [k.strip() for k in re.split("[,，]", raw or "") if k.strip()]


def api_keys(own: str | None, shared: str | None, provider: str, environ=os.environ) -> list[str]:
    """The first source that holds keys: the stage, the file, the environment."""
    for raw in (own, shared, environ.get(f"{provider.upper()}_API_KEY")):
        if keys := parse_api_keys(raw):
            return keys
    raise ConfigError(f"no API key for provider {provider}")


def build_stage(name: str, raw: dict, shared_key: str | None = None, environ=os.environ) -> StageConfig:
    provider = str(raw.get("provider", "")).lower()
    _need(provider in PROVIDERS, f"stage {name}: provider must be one of {', '.join(PROVIDERS)}")
    model = str(raw.get("model", "")).strip()
    _need(bool(model), f"stage {name}: model is missing")
    api_type = str(raw.get("api_type") or API_TYPE_OF[provider]).lower()
    _need(api_type in API_TYPES, f"stage {name}: api_type must be one of {', '.join(API_TYPES)}")
    points = []
    for k, e in enumerate(raw.get("endpoints") or [], 1):
        url = str(e.get("api_url", "")).strip()
        _need(url.startswith(("http://", "https://")), f"stage {name}, endpoint {k}: api_url must be an http(s) URL")
        _need(bool(e.get("api_key")), f"stage {name}, endpoint {k}: api_key is missing")
        kind = str(e.get("api_type") or api_type).lower()
        _need(kind in API_TYPES, f"stage {name}, endpoint {k}: unknown api_type")
        points.append(Endpoint(str(e.get("name") or f"endpoint-{k}"), url, str(e["api_key"]), kind, str(e.get("model") or model)))
    if not points:
        url = str(raw.get("api_url", "")).strip()
        _need(url.startswith(("http://", "https://")), f"stage {name}: api_url must be an http(s) URL")
        keys = api_keys(raw.get("api_key"), shared_key, provider, environ)
        points = [Endpoint(f"key-{k}", url, key, api_type, model) for k, key in enumerate(keys, 1)]
    return StageConfig(name, provider, model, str(raw.get("system_prompt") or ""), api_type, tuple(points))


def from_dict(raw: dict, environ=os.environ) -> PipelineConfig:
    similarity = SimilarityConfig(**(raw.get("similarity") or {}))
    _need(0 < similarity.threshold <= 1, "similarity.threshold must be in (0, 1]")
    _need(similarity.ngram_size >= 2, "similarity.ngram_size must be at least 2")
    _need(similarity.llm_batch_size >= 1, "similarity.llm_batch_size must be at least 1")
    _need(similarity.max_file_size_kb >= 1, "similarity.max_file_size_kb must be at least 1")
    _need(similarity.embedding_batch_size >= 1, "similarity.embedding_batch_size must be at least 1")
    _need(similarity.method in ("embedding", "ngram"), "similarity.method must be embedding or ngram")
    batching = dict(raw.get("batching") or {})
    limits = ProviderLimits(**(batching.pop("providers", None) or {}))
    batch = replace(BatchingConfig(**batching), providers=limits)
    for name in ("max_files_per_batch", "max_batch_kb", "max_file_kb", "synthesize_kb"):
        _need(getattr(batch, name) > 0, f"batching.{name} must be positive")
    _need(all(v > 0 for v in limits.table().values()), "batching.providers must be positive")
    workers = ConcurrencyConfig(max(1, int((raw.get("concurrency") or {}).get("max_workers", 3))))
    mapping = {str(k): [str(t) for t in v or []] for k, v in ((raw.get("grouping") or {}).get("mapping") or {}).items()}
    stages = {n: build_stage(n, s, raw.get("api_key"), environ) for n, s in (raw.get("stages") or {}).items()}
    return PipelineConfig(str(raw.get("input_dir", "input")), str(raw.get("output_dir", "output")), mapping, similarity, batch, workers, RuntimeConfig(**(raw.get("runtime") or {})), stages)


def load_config(path: str, environ=os.environ) -> PipelineConfig:
    try:
        import yaml
    except ImportError as e:
        raise ConfigError("reading a YAML file needs PyYAML; from_dict() takes a dictionary") from e
    return from_dict(yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {}, environ)
