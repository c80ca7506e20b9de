"""Settings of a run: a flat settings file, then a .env file, then the environment, then explicit ones."""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, field, fields, replace
from pathlib import Path


@dataclass(frozen=True)
class Settings:
    """Limits of 0 mean none."""

    base_url: str = "https://www.example.com"
    source: str = "example"
    max_listings: int = 100
    max_pages: int = 20
    max_requests: int = 0
    retry_count: int = 3
    backoff_base_seconds: float = 5.0
    backoff_max_seconds: float = 300.0
    stop_on_block: bool = True
    max_block_events: int = 3
    max_connection_failures: int = 6
    max_url_attempts: int = 3
    cooldown_seconds: float = 900.0
    categories: tuple[str, ...] = field(default=())
    category_depth: int = 1
    page_size: int = 48
    max_pages_per_category: int = 0
    fetch_details: bool = True
    save_raw: bool = False
    download_images: bool = False
    data_dir: str = "data"

    def __post_init__(self) -> None:
        for name, (low, high) in RANGES.items():
            value = getattr(self, name)
            if value < low or high is not None and value > high:
                raise ValueError(f"{name} must be {low} or more" + (f" and {high} or less" if high is not None else ""))

    def path(self, *parts: str) -> str:
        return "/".join([self.data_dir.rstrip("/"), *parts])


RANGES = {
    "max_listings": (0, None), "max_pages": (0, None), "max_requests": (0, None), "retry_count": (0, 10), "backoff_base_seconds": (0, None),
    "backoff_max_seconds": (0, None), "max_block_events": (1, None), "max_connection_failures": (1, None), "max_url_attempts": (1, None),
    "cooldown_seconds": (0, None), "category_depth": (1, 2), "page_size": (1, 100), "max_pages_per_category": (0, None),
}


def read_pairs(path: Path) -> dict[str, str]:
    """KEY=value lines, with quotes around values taken off; comments and other lines are skipped."""
    if not path.exists():
        return {}
    lines = (line.strip() for line in path.read_text(encoding="utf-8").splitlines())
    pairs = (line.partition("=") for line in lines if line and not line.startswith("#") and "=" in line)
    return {k.strip(): v.strip().strip('"').strip("'") for k, _, v in pairs}


def read_file(path: Path) -> dict:
    """Settings of a JSON file or of one with a `name: value` a line, whose values are read as JSON where they are JSON."""
    if not path.exists():
        return {}
    text = path.read_text(encoding="utf-8")
    if path.suffix == ".json":
        return json.loads(text)
    out, last = {}, None
    for raw in text.splitlines():
        line = raw.split(" #")[0].rstrip()
        if not line.strip() or line.lstrip().startswith("#"):
            continue
        if line.lstrip().startswith("- ") and last:
            out[last] = [*(out[last] or []), _value(line.lstrip()[2:])]
            continue
        name, _, value = line.partition(":")
        last = name.strip()
        out[last] = _value(value)
    return out


def _value(text: str):
    text = text.strip()
    try:
        return json.loads(text)
    except ValueError:
        return text.strip("'") or None


def _typed(name: str, value):
    kind = type(getattr(Settings(), name))
    if kind is tuple:
        return tuple(c.strip() for c in value.split(",") if c.strip()) if isinstance(value, str) else tuple(value or ())
    if kind is bool and isinstance(value, str):
        if value.lower() not in ("true", "false", "1", "0", "yes", "no", "on", "off"):
            raise ValueError(f"{name} must be true or false")
        return value.lower() in ("true", "1", "yes", "on")
    return kind(value)


def load_settings(path: str | None = None, overrides: dict | None = None, environ: dict[str, str] | None = None) -> Settings:
    """Unknown names in the file are an error; elsewhere they belong to others. Blank values of the environment don't count."""
    file = Path(path) if path else None
    known = {f.name for f in fields(Settings)}
    data = dict(read_file(file)) if file else {}
    if "save_raw_html" in data:
        data["save_raw"] = data.pop("save_raw_html")
    if unknown := set(data) - known:
        raise ValueError(f"unknown settings: {', '.join(sorted(unknown))}")
    root = file.resolve().parent.parent if file and file.exists() else Path.cwd()
    for key, value in {**read_pairs(root / ".env"), **(os.environ if environ is None else environ)}.items():
        if key.lower() in known and value != "":
            data[key.lower()] = value
    data |= {k: v for k, v in (overrides or {}).items() if v is not None}
    return replace(Settings(), **{k: _typed(k, v) for k, v in data.items()})
