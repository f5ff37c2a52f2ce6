"""Settings: defaults, a YAML file over them, the folder that they belong to."""

from __future__ import annotations

import os
from copy import deepcopy
from pathlib import Path
from typing import Any

DEFAULTS: dict[str, Any] = {
    "paths": {"knowledge": "knowledge", "sprints": "knowledge/sprints", "artifacts": "artifacts", "metadata": "force-app"},
    "stories": {"id_pattern": r"[A-Z][A-Z0-9]+-\d+", "html_glob": "*.html"},
    "extraction": {"batch_size": 30, "model": "model", "max_tokens": 4096, "max_retries": 3},
}
MARKS = ("workspace.config.yaml", "workspace.config.yml")


def find_root(start: str | None = None) -> Path:
    """The first folder upwards with a settings file, or else with a folder ``knowledge``; else ``start``."""
    here = Path(os.environ.get("STORYLOOM_ROOT") or start or os.getcwd()).resolve()
    for test in (lambda p: any((p / m).exists() for m in MARKS), lambda p: (p / "knowledge").is_dir()):
        for p in (here, *here.parents):
            if test(p):
                return p
    return here


def merged(base: dict, over: dict) -> dict:
    """``over`` on top of ``base``, dict by dict."""
    out = deepcopy(base)
    for k, v in over.items():
        out[k] = merged(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else deepcopy(v)
    return out


def load(start: str | None = None) -> dict:
    root = find_root(start)
    for mark in MARKS:
        if (root / mark).exists():
            import yaml  # settings files need it, nothing else does

            found = yaml.safe_load((root / mark).read_text(encoding="utf-8")) or {}
            return merged(DEFAULTS, found) | {"root": str(root)}
    return deepcopy(DEFAULTS) | {"root": str(root)}


def sprint_folders(root: str) -> list[str]:
    """Folders with "sprint" in their names, by number and then name."""
    digits = lambda n: int("".join(c for c in n if c.isdigit()) or 0)
    return sorted((p.name for p in Path(root).iterdir() if p.is_dir() and "sprint" in p.name.lower()), key=lambda n: (digits(n), n))
