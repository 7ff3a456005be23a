"""The crops config (YAML) and run settings."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any


def _simple_yaml(text: str) -> dict[str, Any]:
    """Mappings, lists and plain scalars by indentation: what a crops config holds. Used where PyYAML isn't installed."""
    lines = [(len(x) - len(x.lstrip()), x.strip()) for x in text.splitlines() if x.strip() and not x.lstrip().startswith("#")]

    def scalar(s: str):
        s = s.strip().strip("\"'")
        return int(s) if s.isdigit() else s

    def block(i: int, indent: int):
        if lines[i][1].startswith("- "):
            out = []
            while i < len(lines) and lines[i][0] == indent and lines[i][1].startswith("- "):
                rest = lines[i][1][2:]
                if ":" in rest and not rest.startswith(("'", '"')):
                    lines[i] = (indent + 2, rest)
                    item, i = block(i, indent + 2)
                else:
                    item, i = scalar(rest), i + 1
                out.append(item)
            return out, i
        out = {}
        while i < len(lines) and lines[i][0] == indent and not lines[i][1].startswith("- "):
            key, _, rest = lines[i][1].partition(":")
            i += 1
            if rest.strip() in (">", "|"):
                words = []
                while i < len(lines) and lines[i][0] > indent:
                    words.append(lines[i][1])
                    i += 1
                out[key] = " ".join(words)
            elif rest.strip():
                out[key] = scalar(rest)
            elif i < len(lines) and (lines[i][0] > indent or lines[i][0] == indent and lines[i][1].startswith("- ")):
                out[key], i = block(i, lines[i][0])
            else:
                out[key] = None
        return out, i

    return block(0, lines[0][0])[0] if lines else {}


def load_config(path: str) -> dict[str, Any]:
    """crops and crop_groups from a YAML file; ValueError if there are no crops."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    try:
        import yaml

        config = yaml.safe_load(text) or {}
    except ImportError:
        config = _simple_yaml(text)
    if not config.get("crops"):
        raise ValueError(f"{path} has no crops")
    return config


@dataclass(frozen=True)
class RunConfig:
    """Settings of a discovery run; limits must be at least 1."""

    live: bool = False
    selection_limit: int = 96
    query_limit: int = 8
    results_per_query: int = 5
    channels: tuple[str, ...] = ("web", "scholarly")
    timeout: float = 20.0
    sleep_seconds: float = 1.0
    attempts: int = 2
    backoff_seconds: float = 0.5
    max_fallbacks: int = 3
    min_hit_rate: float = 0.60

    def __post_init__(self):
        for name in ("selection_limit", "query_limit", "results_per_query", "attempts"):
            if getattr(self, name) < 1:
                raise ValueError(f"{name} must be at least 1")
        if set(self.channels) - {"web", "scholarly"}:
            raise ValueError("channels are web and scholarly")
