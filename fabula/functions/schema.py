"""JSON schemas as a model service takes them: without references, with few keywords. Driver-side, schemas are small."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

# Keywords that are kept, and the fields of an arc.
KEYWORDS = ("type", "properties", "required", "additionalProperties", "items", "enum", "const", "anyOf", "description", "minItems")
ARC_FIELDS = ("t00", "t01", "t02", "t03", "t04", "t05", "t06", "t07", "t08", "t09", "t10")
_LOCAL = "#/$defs/"


def expanded(node: Any, defs: Mapping[str, Any], inside: tuple[str, ...] = ()) -> Any:
    """The schema with each local reference replaced by what it names; keywords beside a reference win. Raises on a reference that leads to itself."""
    if isinstance(node, Mapping):
        ref = node.get("$ref")
        if ref is None:
            return {k: expanded(v, defs, inside) for k, v in node.items()}
        if ref in inside:
            raise ValueError(f"{ref} refers to itself")
        beside = {k: v for k, v in node.items() if k != "$ref"}
        return expanded(defs[ref.removeprefix(_LOCAL)], defs, (*inside, ref)) | expanded(beside, defs, inside)
    return [expanded(v, defs, inside) for v in node] if isinstance(node, (list, tuple)) else node


def reduced(schema: Any) -> Any:
    """The schema with the kept keywords alone. Names of properties are no keywords, and of minItems only 0 and 1 are known to the service."""
    if isinstance(schema, list):
        return [reduced(s) for s in schema]
    if not isinstance(schema, dict):
        return schema
    kept = {k: v for k, v in schema.items() if k in KEYWORDS and not (k == "minItems" and v > 1)}
    values = {k: v for k, v in kept.items() if k in ("enum", "const", "required")}
    below = {k: {name: reduced(s) for name, s in v.items()} if k == "properties" else reduced(v) for k, v in kept.items() if k not in values}
    return {k: below[k] if k in below else values[k] for k in kept}


def model_output(schema: Mapping[str, Any]) -> dict[str, Any]:
    """The schema of a model's answer, out of that of stored records: an arc is eleven named numbers and a confidence, every
    field of the skeleton is required, and an answer may abstain with a reason in place of its layers and beat tags."""
    defs = schema["$defs"]
    part = lambda name: reduced(expanded({"$ref": _LOCAL + name}, defs))
    layers, beats = part("layers"), part("beat_tags_block")
    skeleton = layers["properties"]["structural_skeleton"]
    number = {"type": "number"}
    points = {"description": "The protagonist's fortune from -1 to 1 at eleven even steps, as told.", "type": "object", "additionalProperties": False, "required": list(ARC_FIELDS), "properties": {k: dict(number) for k in ARC_FIELDS}}
    others = {k: v for k, v in skeleton["properties"].items() if k not in ("emotional_arc", "arc_points")}
    skeleton["properties"] = {"arc_points": points, "arc_confidence": {"description": "From 0 to 1: how well the points give the story's shape.", **number}} | others
    skeleton["required"] = list(skeleton["properties"])
    or_null = lambda s: {"anyOf": [s, {"type": "null"}]}
    fields = {
        "outcome": {"enum": list(defs["outcome"]["enum"])},
        "abstain_reason": {"description": "Null if the outcome is 'annotated'.", "enum": [*defs["abstain_reason"]["enum"], None]},
        "layers": or_null(layers), "beat_tags": or_null(beats),
    }
    return {"type": "object", "additionalProperties": False, "required": list(fields), "properties": fields}
