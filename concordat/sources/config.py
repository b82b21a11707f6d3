"""Settings from JSON, YAML where the parser is there, and environment files."""

from __future__ import annotations

import json
import os
import re
from pathlib import Path
from typing import Any

from concordat.functions.text import split_name
from concordat.model import Incremental, TableSpec

_UNREAD = {"build_indexes_on_staging", "keep_old_after_swap", "copy_null", "exact_count_after_load", "skip_on_structure_mismatch", "delete_detection", "stream_batch_size", "bytea_format"}


def environment(path: str) -> dict[str, str]:
    """NAME=value lines, with or without `export` and quotes; # begins a comment line."""
    out = {}
    for line in Path(path).read_text().splitlines():
        m = re.match(r"\s*(?:export\s+)?([A-Za-z_]\w*)\s*=\s*(.*?)\s*$", line)
        if m:
            out[m[1]] = m[2][1:-1] if len(m[2]) > 1 and m[2][0] == m[2][-1] and m[2][0] in "'\"" else m[2]
    return out


def expanded(value: Any, env: dict[str, str]) -> Any:
    """${NAME} and ${NAME:-default} in every text of a tree; an unset name without default is an error."""
    if isinstance(value, dict):
        return {k: expanded(v, env) for k, v in value.items()}
    if isinstance(value, list):
        return [expanded(v, env) for v in value]
    if not isinstance(value, str):
        return value

    def one(m: re.Match) -> str:
        if m[1] in env:
            return env[m[1]]
        if m[2] is None:
            raise KeyError(f"environment variable {m[1]} is not set")
        return m[2]

    return re.sub(r"\$\{(\w+)(?::-([^}]*))?\}", one, value)


def load(path: str, env_file: str | None = None) -> dict[str, Any]:
    text = Path(path).read_text()
    if path.endswith((".yml", ".yaml")):
        import yaml

        tree = yaml.safe_load(text)
    else:
        tree = json.loads(text)
    return expanded(tree or {}, os.environ | (environment(env_file) if env_file else {}))


def table_specs(tree: dict[str, Any]) -> dict[str, TableSpec]:
    """The tables of a settings tree. Settings that would have no effect are refused, not ignored."""
    out = {}
    for raw in tree.get("tables", []):
        given = {"name": raw} if isinstance(raw, str) else dict(raw)
        if ignored := _UNREAD & set(given):
            raise ValueError(f"not supported: {', '.join(sorted(ignored))}")
        inc = given.get("incremental")
        name = ".".join(split_name(given["name"], tree.get("schema", "public")))
        out[name] = TableSpec(
            name, tuple(given.get("keys", ())), {k.lower(): v.lower() for k, v in given.get("rename", {}).items()}, given.get("where"), given.get("mode", "truncate"),
            Incremental(inc["column"], inc.get("strategy", "updated_at"), int(inc.get("overlap_minutes", 5)), inc.get("initial")) if inc else None,
            given.get("lob", {}), given.get("lob_default", "error"), tuple(given.get("exclude", ())), int(given.get("chunk_size", 50_000)), given.get("on_duplicate", "error"), tuple(given.get("order_by", ())), bool(given.get("skip_failed", False)),
        )
    return out


def chosen(specs: dict[str, TableSpec], names: list[str] | None = None, limit: int | None = None) -> list[TableSpec]:
    """Tables by name: as given, with the schema, without it, in any case; two that fit equally well are an error."""
    if not names:
        found = list(specs.values())
    else:
        found = []
        for name in names:
            ways = (lambda n: n == name, lambda n: n.lower() == name.lower(), lambda n: n.rpartition(".")[2] == name, lambda n: n.rpartition(".")[2].lower() == name.rpartition(".")[2].lower())
            hits = next((h for way in ways if (h := [n for n in specs if way(n)])), [])
            if len(hits) != 1:
                raise KeyError(f"{name}: {'no such table' if not hits else 'fits ' + ', '.join(hits)}")
            found.append(specs[hits[0]])
    return found[:limit] if limit else found
