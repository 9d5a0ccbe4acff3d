"""Typed settings. Every threshold of the chunker is a parameter, none is hidden in an operator."""

from __future__ import annotations

import os
from dataclasses import dataclass


@dataclass(frozen=True)
class ChunkConfig:
    """Sizes and gaps of turn merging and chunk packing, in words and seconds."""

    target_words: int = 1400
    max_words: int = 2200
    max_gap_s: float = 5.0
    tail_merge_words: int = 450

    def __post_init__(self):
        if self.target_words < 1 or self.target_words > self.max_words:
            raise ValueError("target_words must lie between 1 and max_words")
        if self.max_gap_s < 0 or self.tail_merge_words < 0:
            raise ValueError("max_gap_s and tail_merge_words can't be negative")

    @classmethod
    def from_env(cls, env: dict[str, str] | None = None, prefix: str = "PARLANCE_") -> "ChunkConfig":
        """Reads PARLANCE_TARGET_WORDS and so on; an unset or blank name keeps its default."""
        env = os.environ if env is None else env
        casts = {"target_words": int, "max_words": int, "max_gap_s": float, "tail_merge_words": int}
        found = {k: cast(env[prefix + k.upper()]) for k, cast in casts.items() if (env.get(prefix + k.upper()) or "").strip()}
        return cls(**found)


@dataclass(frozen=True)
class ModelConfig:
    """How the summarising model is called; num_ctx None leaves the server's own context size."""

    url: str = "http://localhost:11434"
    model: str = "extractive"
    keep_alive: str = "30m"
    temperature: float = 0.2
    num_ctx: int | None = None
    timeout_s: int = 3600

    @classmethod
    def from_env(cls, env: dict[str, str] | None = None, prefix: str = "PARLANCE_MODEL_") -> "ModelConfig":
        env = os.environ if env is None else env
        casts = {"url": str, "model": str, "keep_alive": str, "temperature": float, "num_ctx": int, "timeout_s": int}
        found = {k: cast(env[prefix + k.upper()]) for k, cast in casts.items() if (env.get(prefix + k.upper()) or "").strip()}
        return cls(**found)


def require(**given: str | None) -> None:
    """Raises ValueError naming every argument that is missing or blank, before any work is done."""
    missing = sorted(k for k, v in given.items() if not (v or "").strip())
    if missing:
        raise ValueError("missing: " + ", ".join(missing))


def exit_code(error: BaseException | None) -> int:
    """0 without an error, 2 for what was asked wrongly or is missing, such as arguments, files, templates and
    chunks, 1 for what failed on the way."""
    return 0 if error is None else 2 if isinstance(error, (ValueError, FileNotFoundError)) else 1
