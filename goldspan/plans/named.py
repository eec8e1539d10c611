"""Stored query templates with ``{{name}}`` placeholders."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from goldspan.plans.filters import Search

_PLACEHOLDER = re.compile(r"\{\{(.*?)\}\}")
_QUOTED = re.compile(r"('(?:[^'\\]|\\.)*')")


def parameters(template) -> list[str]:
    """Placeholder names of a JSON or SQL template, in order, each once."""
    text = template if isinstance(template, str) else json.dumps(template, ensure_ascii=False)
    return list(dict.fromkeys(name.strip() for name in _PLACEHOLDER.findall(text)))


def _checked(template, params: Mapping[str, Any]) -> None:
    wanted, given = set(parameters(template)), set(params)
    if wanted != given:
        raise ValueError(f"parameters differ: missing {sorted(wanted - given)}, unknown {sorted(given - wanted)}")


def _bound(node, params):
    if isinstance(node, dict):
        return {k: _bound(v, params) for k, v in node.items()}
    if isinstance(node, list):
        return [_bound(v, params) for v in node]
    if isinstance(node, str):
        whole = _PLACEHOLDER.fullmatch(node)
        if whole:
            return params[whole.group(1).strip()]
        return _PLACEHOLDER.sub(lambda m: str(params[m.group(1).strip()]), node)
    return node


def bind_search(template: Mapping, params: Mapping[str, Any]) -> Search:
    """A filter template with its values filled in.

    A value that is one placeholder takes the parameter with its type, so a
    parameter can change a value but never the shape of the query.
    """
    _checked(template, params)
    return Search.from_wire(_bound(template, params))


def _marked_literal(literal: str) -> str:
    """A quoted text with its placeholders as a concatenation of texts and parameters."""
    parts = _PLACEHOLDER.split(literal[1:-1])  # text, name, text, name, ..., text
    pieces = [f"CAST(:{part.strip()} AS STRING)" if i % 2 else f"'{part}'" for i, part in enumerate(parts) if i % 2 or part]
    return pieces[0] if len(pieces) == 1 else f"concat({', '.join(pieces)})"


def run_sql_template(spark: SparkSession, template: str, params: Mapping[str, Any]) -> DataFrame:
    """A SQL template: placeholders become Spark's named parameter markers, also those inside quoted texts."""
    _checked(template, params)
    parts = _QUOTED.split(template)
    marked = "".join(
        (_marked_literal(part) if _PLACEHOLDER.search(part) else part) if i % 2
        else _PLACEHOLDER.sub(lambda m: f":{m.group(1).strip()}", part) for i, part in enumerate(parts))
    return spark.sql(marked, args=dict(params))
