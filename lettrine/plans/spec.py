"""The specification file of the enrichment: taxonomy, output schema, instructions. Runs on the driver."""

from __future__ import annotations

import copy
import hashlib
import json
import re
from dataclasses import dataclass

from lettrine.schemas import IMPORTANCE

#: Headings under which the parts are looked for.
TAXONOMY_HEADINGS = ("Folder Taxonomy", "Classification Taxonomy", "Allowed Folder Taxonomy")
SCHEMA_HEADINGS = ("Output JSON Schema", "JSON Schema", "Output Schema")
INSTRUCTION_HEADINGS = ("Goal", "Output Rules", "Summary Rules", "Attachment Summary Rules", "Importance Rules", "Classification Rules", "Failure And Uncertainty Rules")
ITEM = "attachment_summaries"
FOLDERS = ("main_folder", "sub_folder")


class SpecError(ValueError):
    """The specification can't be used."""


@dataclass
class Spec:
    instructions: str
    schema: dict
    taxonomy: dict[str, list[str]]
    fingerprint: str


def section(markdown: str, headings: tuple[str, ...]) -> str | None:
    """The text below the first of the headings, up to the next line that begins with ``##``."""
    lines = markdown.splitlines()
    for i, line in enumerate(lines):
        m = re.match(r"#{2,}\s*(.*?)\s*#*\s*$", line)
        if m and m[1] in headings:
            body = []
            for x in lines[i + 1 :]:
                if x.startswith("##"):
                    break
                body.append(x)
            return "\n".join(body).strip()
    return None


def json_block(markdown: str, headings: tuple[str, ...]) -> object | None:
    text = section(markdown, headings)
    m = re.search(r"```(?:json)?\s*\n(.*?)```", text or "", re.S)
    return json.loads(m[1]) if m else None


def taxonomy(markdown: str) -> dict[str, list[str]]:
    found = json_block(markdown, TAXONOMY_HEADINGS)
    if found is None:
        raise SpecError("the specification has no folder taxonomy")
    if not isinstance(found, dict) or not all(isinstance(v, list) for v in found.values()):
        raise SpecError("the folder taxonomy must map folders to lists")
    clean = {k.strip(): [s.strip() for s in v if isinstance(s, str) and s.strip()] for k, v in found.items()}
    if not clean or not all(clean.values()):
        raise SpecError("the folder taxonomy is empty or has an empty entry")
    return dict(sorted(clean.items()))


def all_sub_folders(tax: dict[str, list[str]]) -> list[str]:
    return sorted({s for v in tax.values() for s in v})


def default_schema(tax: dict[str, list[str]]) -> dict:
    text, level = {"type": "string"}, {"type": "string", "enum": list(IMPORTANCE)}
    item = {
        "file_name": text, "mime_type": {"type": ["string", "null"]}, "summary": text, "importance": level, "proposed_file_name": text,
        "main_folder": {"type": "string", "enum": list(tax)}, "sub_folder": {"type": "string", "enum": all_sub_folders(tax)},
    }
    items = {"type": "object", "additionalProperties": False, "required": list(item), "properties": item}
    top = {"email_summary": text, "email_importance": level, ITEM: {"type": "array", "items": items}}
    return copy.deepcopy({"type": "object", "additionalProperties": False, "required": list(top), "properties": top})


def migrated(schema: dict) -> dict:
    """Folders moved from the top level to the items; no confidence."""
    out = copy.deepcopy(schema)
    top = out.get("properties", {})
    moved = {f: top.pop(f, None) for f in FOLDERS}
    out["required"] = [r for r in out.get("required", []) if r not in FOLDERS]
    items = top.get(ITEM, {}).get("items")
    if isinstance(items, dict) and isinstance(items.get("properties"), dict):
        items["properties"].pop("confidence", None)
        for f in FOLDERS:
            items["properties"].setdefault(f, moved[f] or {"type": "string"})
        if "required" in items:
            items["required"] = [r for r in items["required"] if r != "confidence"]
            items["required"] += [f for f in FOLDERS if f not in items["required"]]
    return out


def _nullable(schema: dict) -> dict:
    kind = schema.get("type")
    if isinstance(kind, str) and kind != "null":
        schema["type"] = [kind, "null"]
    elif isinstance(kind, list) and "null" not in kind:
        schema["type"] = [*kind, "null"]
    elif kind is None and "anyOf" in schema:
        schema["anyOf"] = [*schema["anyOf"], {"type": "null"}]
    if "enum" in schema and None not in schema["enum"]:
        schema["enum"] = [*schema["enum"], None]
    return schema


def hardened(schema: object) -> object:
    """Objects closed, all their properties required, what was optional nullable."""
    if isinstance(schema, list):
        return [hardened(x) for x in schema]
    if not isinstance(schema, dict):
        return schema
    out = {k: hardened(v) if k != "properties" else {n: hardened(p) for n, p in v.items()} for k, v in schema.items()}
    if "properties" in out:
        needed = set(schema.get("required", []))
        out["properties"] = {n: p if n in needed or not isinstance(p, dict) else _nullable(p) for n, p in out["properties"].items()}
        out["additionalProperties"] = False
        out["required"] = list(out["properties"])
    return out


def constrained(schema: dict, tax: dict[str, list[str]]) -> dict:
    """Closed, with the allowed folders and levels, and one branch for each main folder."""
    out = hardened(schema)
    top = out.get("properties", {})
    items = top.get(ITEM, {}).get("items", {})
    inner = items.get("properties", {})
    for where, name, values in ((top, "email_importance", IMPORTANCE), (inner, "importance", IMPORTANCE), (inner, "main_folder", tax), (inner, "sub_folder", all_sub_folders(tax))):
        if isinstance(where.get(name), dict):
            where[name]["enum"] = list(values)
    if inner:
        shape = {"type": "object", "additionalProperties": False, "required": items.get("required", [])}
        items["anyOf"] = [copy.deepcopy(shape | {"properties": inner | {"main_folder": {"enum": [m]}, "sub_folder": {"enum": subs}}}) for m, subs in tax.items()]
        items.pop("allOf", None)
    return out


def instructions(markdown: str, tax: dict[str, list[str]]) -> str:
    parts = [f"## {h}\n{text}" for h in INSTRUCTION_HEADINGS if (text := section(markdown, (h,))) is not None]
    return "\n\n".join([*parts, "## Folder Taxonomy\n```json\n" + json.dumps(tax, indent=2, ensure_ascii=False) + "\n```"])


def read(markdown: str) -> Spec:
    tax = taxonomy(markdown)
    given = json_block(markdown, SCHEMA_HEADINGS)
    schema = constrained(migrated(given if isinstance(given, dict) else default_schema(tax)), tax)
    return Spec(instructions(markdown, tax), schema, tax, hashlib.sha256(markdown.encode()).hexdigest())


def load(path: str) -> Spec:
    with open(path, encoding="utf-8") as f:
        return read(f.read())


def cache_key(prefix: str, model: str, fingerprint: str, repair: bool = False) -> str:
    return ":".join([prefix, model, fingerprint[:16], *["repair"] * repair])


def schema_errors(value: object, schema: dict, at: str = "$") -> list[str]:
    """Violations of the parts of JSON Schema that the specification uses."""
    kinds = {"string": str, "object": dict, "array": list, "boolean": bool, "null": type(None), "integer": int, "number": (int, float)}
    wanted = schema.get("type")
    names = [wanted] if isinstance(wanted, str) else wanted or []
    if names and not any(isinstance(value, kinds[n]) and not (isinstance(value, bool) and n in ("integer", "number")) for n in names):
        return [f"{at}: not of type {' or '.join(names)}"]
    out = [f"{at}: not one of the allowed values"] if "enum" in schema and value not in schema["enum"] else []
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{at}: `{r}` is missing" for r in schema.get("required", []) if r not in value]
        if schema.get("additionalProperties") is False:
            out += [f"{at}: `{k}` is not allowed" for k in value if k not in known]
        for k, s in known.items():
            if k in value:
                out += schema_errors(value[k], s, f"{at}.{k}")
    if isinstance(value, list) and isinstance(schema.get("items"), dict):
        for i, x in enumerate(value):
            out += schema_errors(x, schema["items"], f"{at}[{i}]")
    if "anyOf" in schema and not out and all(schema_errors(value, s, at) for s in schema["anyOf"]):
        out.append(f"{at}: no allowed combination")
    return out
