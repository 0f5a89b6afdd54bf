"""Data contracts: a JSON-Schema subset, for one payload on the driver and for many captures as column expressions.

Keywords: type, required, properties, items, minLength, minItems, minimum, const. additionalProperties: true and format say
nothing here; any other keyword is an error when a contract is loaded.
"""

from __future__ import annotations

import json
from functools import lru_cache
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEYWORDS = {"type", "required", "properties", "items", "minLength", "minItems", "minimum", "const", "additionalProperties", "format"}
NOTES = {"$schema", "$id", "title", "description"}
SHOWN = 5

#: The two feeds' contracts.
WEATHER_CONTRACT = {
    "type": "object",
    "required": ["dt", "name", "main", "weather", "wind", "clouds", "cod"],
    "properties": {
        "dt": {"type": "integer"},
        "name": {"type": "string", "minLength": 1},
        "cod": {"type": "integer"},
        "main": {"type": "object", "required": ["temp", "feels_like", "humidity"], "properties": {"temp": {"type": "number"}, "feels_like": {"type": "number"}, "humidity": {"type": "number"}}},
        "weather": {"type": "array", "minItems": 1, "items": {"type": "object", "required": ["main", "description"], "properties": {"main": {"type": "string"}, "description": {"type": "string"}}}},
        "wind": {"type": "object", "required": ["speed"], "properties": {"speed": {"type": "number"}}},
        "clouds": {"type": "object", "required": ["all"], "properties": {"all": {"type": "number"}}},
    },
}
ENERGY_CONTRACT = {
    "type": "object",
    "required": ["help", "success", "result"],
    "properties": {
        "help": {"type": "string"},
        "success": {"type": "boolean", "const": True},
        "result": {
            "type": "object",
            "required": ["resource_id", "records", "limit", "total"],
            "properties": {
                "resource_id": {"type": "string", "minLength": 1},
                "records": {"type": "array", "items": {"type": "object", "required": ["_id"], "properties": {"_id": {"type": "integer"}}}},
                "limit": {"type": "integer", "minimum": 1},
                "total": {"type": "integer", "minimum": 0},
            },
        },
    },
}
CONTRACTS = {"weather": WEATHER_CONTRACT, "energy": ENERGY_CONTRACT}


class ContractError(ValueError):
    """A payload breaks its contract."""


def check_contract(contract: dict) -> dict:
    """The contract, if it uses only known keywords."""
    unknown = set(contract) - KEYWORDS - NOTES
    if unknown:
        raise ValueError(f"unsupported contract keywords: {', '.join(sorted(unknown))}")
    for sub in [*contract.get("properties", {}).values(), *([contract["items"]] if "items" in contract else [])]:
        check_contract(sub)
    return contract


def resolve_contract(name: str, roots: list[str]) -> Path:
    """The first <root>/<name> that exists, roots in order and without repeats."""
    tried = [Path(r, name) for r in dict.fromkeys(roots)]
    for path in tried:
        if path.is_file():
            return path
    raise FileNotFoundError(f"contract {name} not found; searched: {', '.join(map(str, tried))}")


@lru_cache(maxsize=8)
def load_contract(path: str) -> dict:
    return check_contract(json.loads(Path(path).read_text()))


def _is(kind: str, value) -> bool:
    number = isinstance(value, (int, float)) and not isinstance(value, bool)
    return {"object": isinstance(value, dict), "array": isinstance(value, list), "string": isinstance(value, str), "boolean": isinstance(value, bool), "number": number, "integer": number and float(value).is_integer()}[kind]


def violations(value, contract: dict, path: str = "$") -> list[tuple[str, str]]:
    """(path, what is wrong) of every violation, sorted by path."""
    out = []
    kind = contract.get("type")
    if kind and not _is(kind, value):
        out.append((path, f"is not of type {kind}"))
    if "const" in contract and value != contract["const"]:
        out.append((path, f"is not {json.dumps(contract['const'])}"))
    if isinstance(value, dict):
        out += [(path, f"lacks the required field '{k}'") for k in contract.get("required", []) if k not in value]
        for k, sub in contract.get("properties", {}).items():
            if k in value:
                out += violations(value[k], sub, f"{path}.{k}")
    if isinstance(value, list):
        if len(value) < contract.get("minItems", 0):
            out.append((path, f"has fewer than {contract['minItems']} items"))
        for i, item in enumerate(value):
            out += violations(item, contract.get("items", {}), f"{path}[{i}]")
    if isinstance(value, str) and len(value) < contract.get("minLength", 0):
        out.append((path, f"is shorter than {contract['minLength']}"))
    if "minimum" in contract and _is("number", value) and value < contract["minimum"]:
        out.append((path, f"is below {contract['minimum']}"))
    return sorted(out)


def validate(payload, contract: dict, name: str) -> None:
    """Raise a ContractError that names the contract and shows the first violations and how many more there are."""
    found = violations(payload, contract)
    if found:
        raise ContractError(message(found, name))


def message(found: list[tuple[str, str]], name: str) -> str:
    """What is wrong with a payload, in one line: the first SHOWN violations and how many more there are."""
    more = f"; ... {len(found) - SHOWN} additional" if len(found) > SHOWN else ""
    return f"payload breaks {name}: " + "; ".join(f"{p} {w}" for p, w in found[:SHOWN]) + more


_TYPES = {"string": "^STRING$", "boolean": "^BOOLEAN$", "array": "^ARRAY<", "object": "^(OBJECT|STRUCT)<", "number": "^(BIGINT|DOUBLE|DECIMAL|FLOAT|INT|SMALLINT|TINYINT)"}
_FOUND = "array<struct<path: string, what: string>>"


def _found(v: Column, contract: dict, path: Column) -> Column:
    """Violations (path, what) of a VARIANT, null where it isn't there, with those of its fields and of its items at their places."""
    kind, out = F.schema_of_variant(v), []

    def unless(ok: Column, text: str) -> None:
        out.append(F.when(v.isNotNull() & ~F.coalesce(ok, F.lit(False)), F.struct(path.alias("path"), F.lit(text).alias("what"))))

    want = contract.get("type")
    if want == "integer":
        whole = F.try_variant_get(v, "$", "double")
        unless(kind.rlike(_TYPES["number"]) & (whole == F.floor(whole)), "is not of type integer")
    elif want:
        unless(kind.rlike(_TYPES[want]), f"is not of type {want}")
    if "const" in contract:
        unless(F.to_json(v) == json.dumps(contract["const"]), f"is not {json.dumps(contract['const'])}")
    if "minLength" in contract:
        unless(~kind.rlike("^STRING$") | (F.length(F.try_variant_get(v, "$", "string")) >= contract["minLength"]), f"is shorter than {contract['minLength']}")
    if "minimum" in contract:
        unless(~kind.rlike(_TYPES["number"]) | (F.try_variant_get(v, "$", "double") >= contract["minimum"]), f"is below {contract['minimum']}")
    items = F.try_variant_get(v, "$", "array<variant>")
    if "minItems" in contract:
        unless(~kind.rlike("^ARRAY<") | (F.size(items) >= contract["minItems"]), f"has fewer than {contract['minItems']} items")
    for k in contract.get("required", []):
        there = F.try_variant_get(v, f"$['{k}']", "variant")
        unless(~kind.rlike(_TYPES["object"]) | there.isNotNull(), f"lacks the required field '{k}'")
    parts = [F.array_compact(F.array(*out)).cast(_FOUND)] if out else []
    parts += [_found(F.try_variant_get(v, f"$['{k}']", "variant"), sub, F.concat(path, F.lit(f".{k}"))) for k, sub in contract.get("properties", {}).items()]
    if "items" in contract:
        each = F.transform(F.coalesce(items, F.array().cast("array<variant>")), lambda x, i: _found(x, contract["items"], F.concat(path, F.lit("["), i.cast("string"), F.lit("]"))))
        parts.append(F.flatten(each))
    return F.concat(*parts) if parts else F.array().cast(_FOUND)


def with_violations(captures: DataFrame, contract: dict, text: str = "value", name: str | None = None) -> DataFrame:
    """captures (a JSON text a row) with `violations`, an array of messages sorted by path; a text that isn't JSON has one.

    Paths name the places of array items, as in violations(). With the contract's name, `message` says the same in one line,
    as message() does; it is null for a text that breaks nothing.
    """
    check_contract(contract)
    v = F.try_parse_json(F.col(text))
    bad = F.array(F.struct(F.lit("$").alias("path"), F.lit("is not JSON").alias("what")))
    sorted_ = F.sort_array(F.when(F.col("__v").isNull(), bad).otherwise(_found(F.col("__v"), contract, F.lit("$"))))
    out = captures.withColumn("__v", v).withColumn("violations", F.transform(sorted_, lambda x: F.concat_ws(" ", x["path"], x["what"]))).drop("__v")
    if name is None:
        return out
    n = F.size("violations")
    more = F.when(n > SHOWN, F.concat(F.lit("; ... "), (n - SHOWN).cast("string"), F.lit(" additional"))).otherwise("")
    shown = F.array_join(F.slice("violations", 1, SHOWN), "; ")
    return out.withColumn("message", F.when(n > 0, F.concat(F.lit(f"payload breaks {name}: "), shown, more)))
