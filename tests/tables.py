"""Small helpers to make inputs and to look at results."""

from __future__ import annotations

from pathlib import Path


def rows(df, *columns):
    """Sorted plain tuples of a DataFrame."""
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(row) for row in chosen.collect()), key=repr)


def write_text(path: Path, *lines: str) -> Path:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return path
