"""Configuration: YAML files, .env files and one precedence rule."""

from __future__ import annotations

import os
from collections.abc import Mapping
from pathlib import Path


def load_config(path: str | Path) -> dict:
    """A YAML mapping; a missing file and anything but a mapping are errors."""
    import yaml

    path = Path(path)
    if not path.exists():
        raise FileNotFoundError(f"no configuration file {path}")
    out = yaml.safe_load(path.read_text())
    if not isinstance(out, dict):
        raise ValueError(f"{path} holds no mapping")
    return out


def load_env(path: str | Path) -> dict[str, str]:
    """KEY=VALUE lines of a .env file (quotes and comments dropped); set in os.environ unless already there."""
    out = {}
    if Path(path).exists():
        for line in Path(path).read_text().splitlines():
            key, sep, value = line.strip().partition("=")
            if sep and key.strip() and not key.startswith("#"):
                out[key.strip()] = value.strip().strip("'\"")
                os.environ.setdefault(key.strip(), out[key.strip()])
    return out


def merge_overrides(base: Mapping, *overrides: Mapping) -> dict:
    """Later mappings have lower rank than earlier ones; blank values never override.

    merge_overrides(file, cli, params, env) lets the command line win over parameters, those over the
    environment, and that over the file.
    """
    out = dict(base)
    for layer in reversed(overrides):
        out |= {k: v for k, v in layer.items() if v is not None and str(v).strip() != ""}
    return out


def parameters(spark, names: list[str], prefix: str = "brindle.param.") -> dict[str, str]:
    """Job parameters from the session's configuration; blank ones are left out."""
    found = {n: spark.conf.get(prefix + n, "") for n in names}
    return {n: v for n, v in found.items() if v.strip()}


def project_root(config_path: str | Path, marker: str = "config") -> Path:
    """The folder that holds the `config` folder of a configuration file, else the file's own folder."""
    path = Path(config_path).resolve()
    return next((p.parent for p in path.parents if p.name == marker), path.parent)


def resolve_path(root: str | Path, path: str | Path) -> Path:
    return Path(path) if Path(path).is_absolute() else Path(root) / path
