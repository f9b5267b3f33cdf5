"""Chat transcripts with tools and media.

Plain turns are native (``render.chat``).  Declarations, calls and responses of tools
are nested values of any shape, so a conversation that has them is rendered from
JSON by one Arrow function.
"""
from __future__ import annotations

import json
import re
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import functions as F

# Marks of a transcript.
QUOTE = '<|"|>'
MEDIA = {"image": "\n\n<|image|>\n\n", "audio": "<|audio|>", "video": "\n\n<|video|>\n\n"}
# Keys of a schema that are no names of parameters.
SCHEMA_KEYS = ("description", "type", "properties", "required", "nullable")


def _quoted(value) -> str:
    return f"{QUOTE}{value}{QUOTE}"


def _sorted(mapping: dict) -> list[tuple]:
    """Items by key, whatever its case."""
    return sorted(mapping.items(), key=lambda item: str(item[0]).lower())


def _braced(parts: Iterable[str]) -> str:
    return "{" + ",".join(parts) + "}"


def _names(values) -> str:
    return "[" + ",".join(map(_quoted, values)) + "]"


def literal(value, quoted_keys: bool = True) -> str:
    """A JSON value: texts between quote marks, keys too if asked."""
    if isinstance(value, str):
        return _quoted(value)
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, dict):
        return _braced(f"{_quoted(k) if quoted_keys else k}:{literal(v, quoted_keys)}" for k, v in _sorted(value))
    if isinstance(value, list):
        return "[" + ",".join(literal(v, quoted_keys) for v in value) + "]"
    return str(value)


def _item(key: str, value, required) -> str:
    """One entry of the ``items`` of an array."""
    if key == "properties":
        return "properties:{" + (parameters(value) if isinstance(value, dict) else "") + "}"
    if key == "required":
        return f"required:{_names(value)}"
    if key == "type":
        return "type:" + literal(value.upper() if isinstance(value, str) else [v.upper() for v in value])
    return f"{key}:{literal(value)}"


def _parameter(schema: dict) -> str:
    kind = str(schema.get("type", "")).upper()
    told = [f"description:{_quoted(schema['description'])}"] if schema.get("description") else []
    if schema.get("nullable"):
        told.append("nullable:true")
    if kind == "STRING" and schema.get("enum"):
        told.append(f"enum:{literal(schema['enum'])}")
    nested = ""
    if kind == "OBJECT":
        inner = schema.get("properties")
        nested = ",properties:{" + parameters(inner if isinstance(inner, dict) else schema) + "}"
        if schema.get("required"):
            nested += f",required:{_names(schema['required'])}"
    elif kind == "ARRAY" and isinstance(schema.get("items"), dict) and schema["items"]:
        items = schema["items"]
        nested = ",items:" + _braced(_item(k, v, items.get("required")) for k, v in _sorted(items) if v is not None)
    # A comma stands before the type only if something of its own row was told.
    return ",".join(told) + nested + ("," if told else "") + f"type:{_quoted(kind)}"


def parameters(properties: dict) -> str:
    return ",".join(f"{name}:{{{_parameter(schema)}}}" for name, schema in _sorted(properties) if name not in SCHEMA_KEYS)


def declaration(tool: dict) -> str:
    """A function's name, description, parameters and response."""
    function = tool["function"]
    out = f"declaration:{function['name']}{{description:{_quoted(function.get('description', ''))}"
    known = function.get("parameters")
    if known:
        out += ",parameters:{"
        if known.get("properties"):
            out += f"properties:{{{parameters(known['properties'])}}},"
        if known.get("required"):
            out += f"required:{_names(known['required'])},"
        if known.get("type"):
            out += f"type:{_quoted(known['type'].upper())}}}"
    if "response" in function:
        response = function["response"]
        out += ",response:{"
        if response.get("description"):
            out += f"description:{_quoted(response['description'])},"
        if str(response.get("type", "")).upper() == "OBJECT":
            out += f"type:{_quoted('OBJECT')}}}"
    return out + "}"


def call(function: dict) -> str:
    arguments = function.get("arguments")
    if isinstance(arguments, dict):
        arguments = ",".join(f"{k}:{literal(v, False)}" for k, v in _sorted(arguments))
    return f"<|tool_call>call:{function['name']}{{{arguments if isinstance(arguments, str) else ''}}}<tool_call|>"


def response(answer: dict) -> str:
    value = answer.get("response")
    fields = value if isinstance(value, dict) else {"value": value}
    return f"<|tool_response>response:{answer.get('name', 'unknown')}{_braced(f'{k}:{literal(v, False)}' for k, v in _sorted(fields))}<tool_response|>"


def _unthought(text: str) -> str:
    return re.sub(r"<\|channel>.*?(<channel\|>|\Z)", "", text, flags=re.S).replace("<channel|>", "").strip()


def transcript(messages: list[dict], tools: list[dict] = (), generation: bool = False, thinking: bool = False) -> str:
    """The whole conversation; content may be a text or a list of texts and media."""
    leads = bool(messages) and messages[0]["role"] in ("system", "developer")
    out = ["<bos>"]
    if leads or thinking or tools:
        out += ["<|turn>system\n", "<|think|>" * thinking, messages[0]["content"].strip() if leads else "", *(f"<|tool>{declaration(t)}<tool|>" for t in tools), "<turn|>\n"]
    last = None
    for message in messages[leads:]:
        role = "model" if message["role"] == "assistant" else message["role"]
        content, answers, calls = message.get("content"), message.get("tool_responses") or [], message.get("tool_calls") or []
        parts = [{"type": "text", "text": content}] if isinstance(content, str) else content or []
        media = [p["type"] for p in parts if p["type"] in MEDIA]
        last = "media" if media else "response" if answers else None
        shown = (MEDIA[p["type"]] if p["type"] in MEDIA else (_unthought if role == "model" else str.strip)(p["text"]) for p in parts if p["type"] in (*MEDIA, "text"))
        out += [f"<|turn>{role}\n", *(call(c["function"]) for c in calls), *map(response, answers), *shown, "" if answers and not content else "<turn|>\n"]
    if generation and last != "response":
        out.append("<|turn>model\n")
    return "".join(out)


def rich_chat(generation: bool = False, thinking: bool = False):
    """An Arrow function: JSON of the messages, JSON of the tools (or null) -> transcript; null: null."""

    @F.arrow_udf("string")
    def rendered(messages: pa.Array, tools: pa.Array) -> pa.Array:
        rows = zip(messages.to_pylist(), tools.to_pylist())
        return pa.array([None if m is None else transcript(json.loads(m), json.loads(t) if t else (), generation, thinking) for m, t in rows], pa.string())

    return rendered
