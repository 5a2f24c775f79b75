"""Small documents on the driver: contracts, registries, schema snapshots, stored reports, file inventories."""

from __future__ import annotations

import json
import os
from datetime import datetime, timezone
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

try:
    import yaml
except ImportError:  # JSON documents can still be read
    yaml = None


def read_document(path: str):
    """A YAML or JSON document."""
    text = Path(path).read_text()
    if path.endswith(".json"):
        return json.loads(text)
    if yaml is None:
        raise RuntimeError("PyYAML is needed to read YAML")
    return yaml.safe_load(text)


def write_document(path: str, document) -> None:
    """A document as YAML, in its own order, or as JSON where the name says so or YAML cannot be written. The file is replaced as a whole."""
    target = Path(path)
    target.parent.mkdir(parents=True, exist_ok=True)
    plain = path.endswith(".json") or yaml is None
    part = target.with_suffix(".part")
    part.write_text(json.dumps(document, indent=2, default=str) if plain else yaml.safe_dump(json.loads(json.dumps(document, default=str)), sort_keys=False))
    os.replace(part, target)


def registry(spark: SparkSession, path: str) -> DataFrame:
    """A row for each subscription as it is declared, numbered from 0; see :func:`millrace.operators.matching.invalid_subscriptions`. A missing file is empty."""
    try:
        document = read_document(path)
    except OSError:
        document = None
    entries = document.get("subscriptions") if isinstance(document, dict) else None
    text = lambda v: None if v is None else str(v)
    rows = []
    for i, s in enumerate(entries if isinstance(entries, list) else []):
        s = s if isinstance(s, dict) else {}
        fields, breaking = s.get("fields_consumed"), s.get("breaking_fields")
        rows.append((
            i, *(text(s.get(k)) for k in ("contract_id", "subscriber_id", "subscriber_team")), [x if isinstance(x, str) else None for x in fields] if isinstance(fields, list) else None, text(s.get("validation_mode")), text(s.get("contact")),
            [(text(b.get("field")), text(b.get("reason"))) if isinstance(b, dict) else (None, None) for b in breaking] if isinstance(breaking, list) else None,
        ))
    schema = "subscription int, contract_id string, subscriber_id string, subscriber_team string, fields_consumed array<string>, validation_mode string, contact string, breaking_fields array<struct<field:string,reason:string>>"
    return spark.createDataFrame(rows, schema)


def explain_subscription(subscription: dict) -> str:
    """A subscription in words."""
    fields = ", ".join(str(b.get("field")) for b in subscription.get("breaking_fields") or [] if isinstance(b, dict)) or "nothing"
    return f"{subscription.get('subscriber_id', '?')} of {subscription.get('subscriber_team', '?')} is told when {fields} of {subscription.get('contract_id', '?')} breaks ({subscription.get('validation_mode', '?')}, {subscription.get('contact', 'no contact')})."


def known_contracts(folder: str) -> list[str]:
    """The ids of the contract documents in a folder."""
    out = set()
    for p in [*Path(folder).glob("*.yaml"), *Path(folder).glob("*.json")]:
        try:
            document = read_document(str(p))
        except ValueError:
            continue
        if isinstance(document, dict) and document.get("id"):
            out.add(str(document["id"]))
    return sorted(out)


def subscriptions(spark: SparkSession, path: str) -> DataFrame:
    """``contract_id, subscriber_id, subscriber_team, field, reason, validation_mode, contact``: one row for each registered field.

    A missing file or one of another form is an empty registry.
    """
    try:
        document = read_document(path)
    except OSError:
        document = None
    entries = document.get("subscriptions") if isinstance(document, dict) else None
    rows = [
        tuple(s.get(k) for k in ("contract_id", "subscriber_id", "subscriber_team")) + (b.get("field"), b.get("reason"), s.get("validation_mode"), s.get("contact"))
        for s in (entries if isinstance(entries, list) else []) if isinstance(s, dict) for b in s.get("breaking_fields") or [{}] if isinstance(b, dict)
    ]
    return spark.createDataFrame(rows, "contract_id string, subscriber_id string, subscriber_team string, field string, reason string, validation_mode string, contact string")


def schema_versions(folder: str) -> list[str]:
    """Version folders that hold a schema, in order of their names, which are times."""
    root = Path(folder)
    return sorted(p.name for p in root.iterdir() if (p / "schema.yaml").is_file() or (p / "schema.json").is_file()) if root.is_dir() else []


def write_schema_version(folder: str, schema: dict, contract_id: str, now: datetime | None = None) -> str:
    """Store a schema under the time it was captured; returns the version."""
    now = now or datetime.now(timezone.utc)
    version = now.strftime("%Y%m%d_%H%M%S_%f")
    at = Path(folder) / version
    at.mkdir(parents=True)
    (at / "schema.json").write_text(json.dumps({"contract_id": contract_id, "captured_at": now.isoformat(), "schema": schema}, indent=2))
    return version


def read_schema_version(folder: str, version: str) -> dict:
    at = Path(folder) / version
    found = at / "schema.json" if (at / "schema.json").is_file() else at / "schema.yaml"
    document = read_document(str(found))
    return (document or {}).get("schema") or {}


def contract_versions(folder: str) -> list[str]:
    """Versions whose schema is declared; where these are fewer than two, all of them."""
    all_ = schema_versions(folder)
    declared = [v for v in all_ if not is_inferred(read_schema_version(folder, v))]
    return declared if len(declared) >= 2 else all_


def is_inferred(schema: dict) -> bool:
    """Whether a stored schema only lists kinds seen (``{field: {"types": [...]}}``) and declares nothing."""
    return bool(schema) and all(isinstance(v, dict) and set(v) <= {"types"} for v in schema.values())


def versions_since(versions: list[str], days: float, now: datetime) -> list[str]:
    """The versions of the last ``days``; where they are fewer than two, the last two there are."""
    start = (now.timestamp() - days * 86400)
    recent = [v for v in versions if datetime.strptime(v[:15], "%Y%m%d_%H%M%S").replace(tzinfo=timezone.utc).timestamp() >= start]
    return recent if len(recent) >= 2 else versions[-2:]


def latest_document(folder: str, pattern: str) -> tuple[object, str | None]:
    """The newest matching file by time of change and what it holds, None where it cannot be read."""
    found = sorted(Path(folder).glob(pattern), key=lambda p: (p.stat().st_mtime, p.name))
    if not found:
        return None, None
    try:
        return read_document(str(found[-1])), str(found[-1])
    except (OSError, ValueError):
        return None, str(found[-1])


def stored_results(spark: SparkSession, pattern: str, without: tuple[str, ...] = ()) -> DataFrame:
    """All results of stored reports, with ``file_name`` and ``position``; documents without results give none, nor those whose name matches a pattern of ``without``."""
    schema = "results array<struct<check_id:string,column_name:string,check_type:string,status:string,actual_value:string,expected:string,severity:string,records_failing:bigint,sample_failing:array<string>,message:string>>"
    docs = spark.read.schema(schema).option("multiLine", True).json(pattern).select(F.col("_metadata.file_name").alias("file_name"), F.posexplode("results").alias("position", "r"))
    for name in without:
        docs = docs.where(~F.col("file_name").like(name.replace("_", "\\_").replace("*", "%")))
    return docs.select("file_name", "position", "r.*")


def file_inventory(spark: SparkSession, root: str) -> DataFrame:
    """``path``: files under ``root``, relative to it, listed on the driver."""
    base = Path(root)
    return spark.createDataFrame([(str(p.relative_to(base)),) for p in sorted(base.rglob("*")) if p.is_file()], "path string")


def staleness(captured: datetime, now: datetime, days: int = 14) -> str | None:
    """A warning if what was captured is older than ``days``; 0 never warns."""
    age = (now - captured).total_seconds() / 86400
    return f"captured {age:.1f} days ago" if days and age > days else None
