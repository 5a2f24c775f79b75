"""Changes of files from a version control system, read on the driver through its command; where there is none, nothing is known."""

from __future__ import annotations

import subprocess
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

COMMIT = "file_path string, commit_hash string, author string, commit_timestamp string, commit_message string"
_FIELDS = "%H%x1f%an%x1f%ad%x1f%s"


def _run(root: str, *words: str) -> str:
    try:
        done = subprocess.run(["git", "-C", root, *words], capture_output=True, text=True, timeout=60, check=False)
    except (OSError, subprocess.SubprocessError):
        return ""
    return done.stdout if done.returncode == 0 else ""


def read_log(text: str, path: str) -> tuple | None:
    """The first change of a log whose fields are parted by the unit separator."""
    parts = text.splitlines()[0].split("\x1f") if text.strip() else []
    return (path, *parts) if len(parts) == 4 else None


def last_changes(spark: SparkSession, root: str, paths: Sequence[str], days: int = 14) -> DataFrame:
    """The last change of each file within ``days``; a file without one, or no repository, gives no row."""
    rows = [read_log(_run(root, "log", "-1", "--follow", f"--since={days} days ago", "--date=iso", f"--format={_FIELDS}", "--", p), p) for p in paths]
    return spark.createDataFrame([r for r in rows if r], COMMIT)


def line_commits(spark: SparkSession, root: str, path: str, first: int, last: int) -> DataFrame:
    """``file_path, line, commit_hash``: where the lines of a range come from, by whole hashes."""
    text = _run(root, "blame", "-l", "--root", "-L", f"{first},{last}", "--", path)
    rows = [(path, first + i, line.split(" ", 1)[0].lstrip("^")) for i, line in enumerate(text.splitlines())]
    return spark.createDataFrame([r for r in rows if len(r[2]) == 40], "file_path string, line int, commit_hash string")


def project_root(path: str) -> str | None:
    """The folder of the repository that holds ``path``."""
    at = Path(path).resolve()
    return next((str(p) for p in (at, *at.parents) if (p / ".git").exists()), None)
