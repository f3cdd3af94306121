"""Settings with the defaults of the flow; the command line overrides the file, the file overrides the defaults."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields, replace
from pathlib import Path


@dataclass(frozen=True)
class Config:
    allowed_licenses: tuple[str, ...] = ("MIT", "Apache-2.0", "BSD-3-Clause")
    languages: tuple[str, ...] = ("python",)
    min_stars: int = 100
    max_repos: int = 5
    semantic_query: str = "graph algorithms"
    topk: int = 200
    threshold: float = 0.70
    keyword_query: str = "graph algorithm python"
    min_loc: int = 5
    max_loc: int = 400
    shingle_size: int = 5
    num_perm: int = 128
    lsh_threshold: float = 0.80
    completion_lines: tuple[int, ...] = (1, 3, 10)
    skip_security: bool = False

    def merged(self, values: dict) -> "Config":
        """Takes over the known, non-null keys; comma-separated strings become tuples where a tuple is due."""
        out = {}
        for f in fields(self):
            if (v := values.get(f.name)) is not None:
                now = getattr(self, f.name)
                if isinstance(now, tuple):
                    v = tuple(type(now[0])(x) for x in (split_option(v) if isinstance(v, str) else v))
                out[f.name] = v
        return replace(self, **out)


def split_option(text: str) -> list[str]:
    """'a, b,,c' -> ['a', 'b', 'c']"""
    return [x for x in (part.strip() for part in text.split(",")) if x]


def load(path: str | Path | None, **overrides) -> Config:
    """Reads a JSON or (if a YAML library is there) YAML file of settings, nested sections flattened by key."""
    values: dict = {}
    if path:
        text = Path(path).read_text(encoding="utf-8")
        try:
            import yaml  # not in every image

            tree = yaml.safe_load(text)
        except ImportError:
            import json

            tree = json.loads(text)
        values = _flat(tree or {})
    return Config().merged(values).merged({k: v for k, v in overrides.items() if v is not None})


def _flat(tree: dict) -> dict:
    out: dict = {}
    for k, v in tree.items():
        if isinstance(v, dict):
            out |= _flat(v)
        else:
            out[k] = v
    return out


def load_env(path: str | Path) -> dict[str, str]:
    """KEY=VALUE lines of an env file into os.environ (existing names win); a missing file gives {}."""
    found: dict[str, str] = {}
    p = Path(path)
    if p.is_file():
        for line in p.read_text(encoding="utf-8", errors="replace").splitlines():
            key, eq, value = line.strip().partition("=")
            if eq and key and not key.startswith("#"):
                found[key.strip()] = value.strip().strip("'\"")
                os.environ.setdefault(key.strip(), found[key.strip()])
    return found
