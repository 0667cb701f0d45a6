"""Settings with their defaults; the environment overrides what names a service."""

from __future__ import annotations

import os
from dataclasses import dataclass, field


def _env(name: str, default: str):
    return field(default_factory=lambda: os.environ.get(name, default))


@dataclass(frozen=True)
class Settings:
    # fixed values: the thresholds that results depend on
    fetch_state: str = "closed"
    fetch_limit: int = 100
    page_size: int = 100
    min_confidence: float = 0.5
    default_confidence: float = 0.7
    chunk_size: int = 2000
    chunk_overlap: int = 200
    entity_similarity: float = 0.82
    claim_similarity: float = 0.78
    top_k_chunks: int = 8
    top_k_claims: int = 5
    prompt_chars: int = 3000
    evidence_chars: int = 500
    mention_min_chars: int = 4
    score_floor: float = 1e-6
    min_df: int = 2
    max_df: float = 0.95
    max_features: int = 50_000
    # strict repeats behaviour that looks unintended: exact alias case, two-valued query weights, drifting offsets
    strict: bool = False
    token: str = _env("GITHUB_TOKEN", "")
    owner: str = _env("REPO_OWNER", "")
    repo: str = _env("REPO_NAME", "")
    model_url: str = _env("OLLAMA_URL", "http://localhost:11434/api/generate")
    model: str = _env("OLLAMA_MODEL", "llama3:latest")
    model_timeout_s: int = 120
    model_max_tokens: int = 600


DEFAULT = Settings()
