"""Validation of JSON texts against a JSON schema, as an Arrow UDF."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TYPES = {"string": str, "object": dict, "array": list, "boolean": bool, "null": type(None)}
_FORMATS = {"date": r"\d{4}-\d{2}-\d{2}", "date-time": r"\d{4}-\d{2}-\d{2}[Tt ]\d{2}:\d{2}:\d{2}(\.\d+)?([Zz]|[+-]\d{2}:\d{2})?", "uuid": r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"}


def _is(value, kind: str) -> bool:
    if kind == "integer":
        return isinstance(value, int) and not isinstance(value, bool)
    if kind == "number":
        return isinstance(value, (int, float)) and not isinstance(value, bool)
    return isinstance(value, _TYPES[kind]) and not (kind != "boolean" and isinstance(value, bool))


def errors(value, schema: dict, root: dict, at: str = "$") -> list[str]:
    """Paths and rules that a value breaks."""
    if "$ref" in schema:
        target = root
        for part in schema["$ref"].lstrip("#/").split("/"):
            target = target[part]
        return errors(value, target, root, at)
    out: list[str] = []
    kinds = schema.get("type")
    if kinds is not None and not any(_is(value, k) for k in ([kinds] if isinstance(kinds, str) else kinds)):
        return [f"{at}: type"]
    if "enum" in schema and value not in schema["enum"]:
        out.append(f"{at}: enum")
    if "const" in schema and value != schema["const"]:
        out.append(f"{at}: const")
    for word, test in (("oneOf", lambda n: n == 1), ("anyOf", lambda n: n >= 1), ("allOf", lambda n: n == len(schema.get("allOf", [])))):
        if word in schema and not test(sum(not errors(value, s, root, at) for s in schema[word])):
            out.append(f"{at}: {word}")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{at}.{k}: required" for k in schema.get("required", []) if k not in value]
        for k, v in value.items():
            if k in known:
                out += errors(v, known[k], root, f"{at}.{k}")
            elif schema.get("additionalProperties") is False:
                out.append(f"{at}.{k}: additional")
            elif isinstance(schema.get("additionalProperties"), dict):
                out += errors(v, schema["additionalProperties"], root, f"{at}.{k}")
    if isinstance(value, list):
        if len(value) < schema.get("minItems", 0):
            out.append(f"{at}: minItems")
        if isinstance(schema.get("items"), dict):
            for i, v in enumerate(value):
                out += errors(v, schema["items"], root, f"{at}[{i}]")
    if isinstance(value, str):
        if not schema.get("minLength", 0) <= len(value) <= schema.get("maxLength", len(value)):
            out.append(f"{at}: length")
        if "pattern" in schema and not re.search(schema["pattern"], value):
            out.append(f"{at}: pattern")
        if schema.get("format") in _FORMATS and not re.fullmatch(_FORMATS[schema["format"]], value):
            out.append(f"{at}: format")
    if _is(value, "number") and not schema.get("minimum", value) <= value <= schema.get("maximum", value):
        out.append(f"{at}: range")
    return out


def schema_errors(col: Column, schema: dict) -> Column:
    """Sorted errors of each JSON text; unreadable text is one error, null is none."""

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def run(texts: pd.Series) -> pd.Series:
        def one(text):
            if text is None:
                return []
            try:
                value = json.loads(text)
            except ValueError:
                return ["$: unreadable"]
            return sorted(errors(value, schema, schema))

        return texts.map(one)

    return run(col)
