"""Descriptions of a contract's fields by services of the caller's, and a plain one where none answers."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

#: Given the fields and their profile, a description of each; anything raised means that it does not answer.
Provider = Callable[[Mapping[str, dict], Mapping[str, dict]], Mapping[str, str]]


def plain(schema: Mapping[str, dict], profile: Mapping[str, dict]) -> dict[str, str]:
    """What the contract itself says of each field."""
    out = {}
    for name, spec in schema.items():
        words = [str(spec.get("type", "value")), "required" if spec.get("required") else "optional"]
        words += [f"{k} {spec[k]}" for k in ("format", "pattern", "minimum", "maximum") if k in spec] + ([f"one of {', '.join(map(str, spec['enum']))}"] if "enum" in spec else [])
        p = profile.get(name)
        words += [f"from {p['min']} to {p['max']}, mean {p['mean']}"] if p and p.get("min") is not None else []
        out[name] = "; ".join(words)
    return out


def annotate(schema: Mapping[str, dict], profile: Mapping[str, dict] | None = None, providers: Sequence[Provider] = ()) -> dict[str, str]:
    """Descriptions from the first provider that answers; fields it leaves out, or all where none answers, are described plainly."""
    described = plain(schema, profile or {})
    for p in providers:
        try:
            found = p(schema, profile or {})
        except Exception:  # a service that does not answer is no error
            continue
        if found:
            return described | {k: str(v) for k, v in found.items() if k in schema}
    return described
