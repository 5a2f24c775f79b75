"""Settings from the environment and from files of ``NAME=value`` lines."""

from __future__ import annotations

import os
from collections.abc import MutableMapping
from pathlib import Path


def number_or(text: str | None, default: float) -> float:
    """The number a text holds, of the kind of ``default``, or ``default``."""
    try:
        return type(default)(float(text)) if isinstance(default, int) and float(text).is_integer() else type(default)(text) if not isinstance(default, int) else default  # type: ignore[arg-type]
    except (TypeError, ValueError, OverflowError):
        return default


def float_or_none(value: object) -> float | None:
    """A number or a text that holds one, as a float; truth values are no numbers."""
    if isinstance(value, bool):
        return None
    try:
        return float(value)  # type: ignore[arg-type]
    except (TypeError, ValueError):
        return None


def read_settings(path: str) -> dict[str, str]:
    """``NAME=value`` lines, also after ``export``; comments and blank lines are left out, quotes around a value too. A missing file is empty."""
    try:
        lines = Path(path).read_text().splitlines()
    except OSError:
        return {}
    out = {}
    for line in lines:
        name, sign, value = line.strip().removeprefix("export ").partition("=")
        if sign and name.strip() and not name.lstrip().startswith("#"):
            value = value.strip()
            out[name.strip()] = value[1:-1] if len(value) > 1 and value[0] == value[-1] and value[0] in "'\"" else value
    return out


def load_settings(folder: str, environment: MutableMapping[str, str] | None = None) -> None:
    """Put the settings of ``.env`` into the environment where they are not set yet, and those of ``.env.local`` in any case."""
    environment = os.environ if environment is None else environment
    for name, value in read_settings(f"{folder}/.env").items():
        environment.setdefault(name, value)
    environment.update(read_settings(f"{folder}/.env.local"))
