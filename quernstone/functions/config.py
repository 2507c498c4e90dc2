"""Settings of the pipeline, from defaults, a file of KEY=VALUE lines and the environment."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, fields


def load_env_file(path: str, env: dict[str, str] | None = None) -> dict[str, str]:
    """KEY=VALUE lines into env, without overriding what is set; blank lines and # are skipped, quotes stripped."""
    env = os.environ if env is None else env  # type: ignore[assignment]
    if os.path.exists(path):
        with open(path, encoding="utf-8") as f:
            for line in f:
                line = line.strip()
                if line and not line.startswith("#") and "=" in line:
                    key, _, value = line.partition("=")
                    env.setdefault(key.strip(), value.strip().strip("\"'"))
    return env  # type: ignore[return-value]


def as_bool(value: str | None, default: bool) -> bool:
    return default if value is None else value.strip().lower() in ("1", "true", "yes", "y", "on")


@dataclass(frozen=True)
class Settings:
    """Names of fields are environment variables with the prefix QUERNSTONE_ in upper case."""

    use_header_filter: bool = True
    use_text_clean: bool = True
    use_merge_assist: bool = True
    flatten_lists: bool = True
    group_similarity: float = 0.92
    assist_similarity: float = 0.86
    same_anchor_only: bool = True
    targets: str = "canonical"
    neighbours: int = 20
    merge_ranks: int = 6
    max_merge: int = 3
    min_len: int = 8
    max_len: int = 512
    rpm: int = 10
    rpm_floor: int = 2
    rpm_header: int = 10
    rpm_text: int = 10
    rpm_classify: int = 10
    rpm_merge: int = 10
    header_max_retries: int = 5
    header_retry_budget_sec: float = 120.0
    max_retries: int = 5
    retry_budget_sec: float = 180.0
    base_backoff_sec: float = 1.0
    jitter_sec: float = 0.35
    slowdown: float = 1.4
    cache_ttl_sec: int = 86_400
    version: str = "v1"

    @staticmethod
    def from_env(env: Mapping[str, str] | None = None) -> Settings:
        """A value that can't be read falls back to its default."""
        env = os.environ if env is None else env
        got = {}
        for f in fields(Settings):
            raw = env.get(f"QUERNSTONE_{f.name.upper()}")
            if raw is None:
                continue
            if isinstance(f.default, bool):
                got[f.name] = as_bool(raw, f.default)
            elif isinstance(f.default, str):
                got[f.name] = raw
            else:
                try:
                    got[f.name] = type(f.default)(raw)
                except ValueError:
                    pass
        return Settings(**got)
