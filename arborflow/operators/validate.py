"""Event contract as column rules over parsed JSON: every broken rule of an event, by name.

Types come from the VARIANT parse, so an extra key, a missing key and a wrong type are told apart without a
schema that would silently coerce or drop them. A `violations` array that is empty means valid.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arborflow.constants import ENVELOPE_FIELDS, METADATA_COUNTERS, SCHEMA_VERSION

# Payload of each event type as {field: (type, required)}.
NODE_UPSERT = {
    "node_id": ("string", True),
    "node_type": ("string", True),
    "name": ("string or null", False),
    "qualified_name": ("string or null", False),
    "ast_path": ("string", True),
    "line_start": ("integer or null", False),
    "column_start": ("integer or null", False),
    "line_end": ("integer or null", False),
    "column_end": ("integer or null", False),
    "properties": ("object", False),
}
EDGE_UPSERT = {
    "edge_id": ("string", True),
    "source_id": ("string", True),
    "target_id": ("string", True),
    "edge_type": ("string", True),
    "properties": ("object", False),
}
METADATA = {name: ("integer", True) for name in METADATA_COUNTERS} | {
    "parse_status": ("string", True),
    "parser": ("string", True),
}
ERROR = {
    "error_type": ("string", True),
    "message": ("string", True),
    "line": ("integer or null", False),
    "column": ("integer or null", False),
    "retryable": ("boolean", True),
}
_VARIANT_TYPE = {"string": "STRING", "integer": "BIGINT", "boolean": "BOOLEAN", "object": "OBJECT", "null": "VOID"}
CONTRACTS = {
    "NODE_UPSERT": ("node", NODE_UPSERT),
    "NODE_DELETE": ("node", {"node_id": ("string", True)}),
    "EDGE_UPSERT": ("edge", EDGE_UPSERT),
    "EDGE_DELETE": ("edge", {"edge_id": ("string", True)}),
    "FILE_METADATA_UPSERT": ("metadata", METADATA),
    "PARSER_ERROR": ("error", ERROR),
}


def _base_type(document: Column, path: str) -> Column:
    """JSON type of the value at a path without its inner types; empty when it is absent."""
    found = F.schema_of_variant(F.try_variant_get(document, path, "variant"))
    return F.coalesce(F.substring_index(F.substring_index(found, "<", 1), "(", 1), F.lit(""))


NOT_FINITE = r'[:\[,]\s*(?:NaN|-?Infinity)\s*[,}\]]'


def _type_at(document: Column, path: str, wanted: str) -> Column:
    found = _base_type(document, path)
    if not wanted.startswith("integer"):
        return found
    # 1.0 is an integer in JSON; it arrives as a decimal or a double.
    number = F.try_variant_get(document, path, "double")
    return F.when((number % 1 == 0) & found.isin("DECIMAL", "DOUBLE"), "BIGINT").otherwise(found)


def _field_rules(document: Column, prefix: str, fields: dict) -> list[Column]:
    """One text per field below a path, empty if its rule holds. A constant map turns the type into the verdict,
    so each type is looked up once and the rules stay compiled (lambdas would be interpreted)."""
    rules = []
    for name, (wanted, required) in fields.items():
        label = f"{prefix}.{name}"[2:]
        verdicts = {_VARIANT_TYPE[t]: "" for t in wanted.split(" or ")} | {"": f"missing {label}" if required else ""}
        lookup = F.create_map(*[F.lit(part) for pair in verdicts.items() for part in pair])
        verdict = F.try_element_at(lookup, _type_at(document, f"{prefix}.{name}", wanted))
        rules.append(F.coalesce(verdict, F.lit(f"type {label}")))
    return rules


def _extra_keys(text: Column, allowed: list[str], where: str) -> Column:
    """One line per key outside the contract."""
    keys = F.array_except(F.json_object_keys(text), F.array(*[F.lit(a) for a in allowed]))
    return F.regexp_replace(F.array_join(keys, "\n"), "(?m)^(?=.)", f"extra {where}")


def _contract_violations(document: Column, text: Column, event_type: str) -> Column:
    """Broken rules, one per line."""
    payload, fields = CONTRACTS[event_type]
    envelope = {name: ("string", True) for name in ENVELOPE_FIELDS} | {payload: ("object", True)}
    version = F.try_variant_get(document, "$.schema_version", "string")
    inner = _field_rules(document, f"$.{payload}", fields)
    inner.append(_extra_keys(F.get_json_object(text, f"$.{payload}"), list(fields), f"{payload}."))
    # Rules of the payload's fields only mean something when the payload is an object.
    is_object = _base_type(document, f"$.{payload}") == "OBJECT"
    return F.concat_ws(
        "\n",
        *_field_rules(document, "$", envelope),
        F.when(version != SCHEMA_VERSION, "const schema_version"),
        F.when(is_object, F.concat_ws("\n", *inner)),
        _extra_keys(text, list(envelope), ""),
    )


def violations(text: Column, document: Column | None = None, event_types=tuple(CONTRACTS)) -> Column:
    """Sorted names of the broken rules of one event document.

    `event_types` narrows the rules compiled into the plan to those a stream can carry.
    """
    document = F.try_parse_json(text) if document is None else document
    kind = F.try_variant_get(document, "$.event_type", "string")
    # Writers that let NaN and infinities through make text that is no JSON; such an event is held back as well.
    dispatch = F.when(document.isNull() & text.rlike(NOT_FINITE), "non-finite number").when(document.isNull(), "not JSON")
    for event_type in event_types:
        dispatch = dispatch.when(kind == event_type, _contract_violations(document, text, event_type))
    lines = F.split(dispatch.otherwise("unknown event_type"), "\n")
    return F.sort_array(F.array_remove(lines, ""))


def validate_events(events: DataFrame, value_col="value", event_types=tuple(CONTRACTS)) -> DataFrame:
    """Add `violations`; the document is parsed once per row."""
    parsed = events.withColumn("_document", F.try_parse_json(F.col(value_col)))
    checked = parsed.withColumn("violations", violations(F.col(value_col), F.col("_document"), event_types))
    return checked.drop("_document")


def non_finite(*columns: Column) -> Column:
    """True where a number cannot be written as JSON (NaN or infinity)."""
    found = F.lit(False)
    for column in columns:
        found = found | F.coalesce(F.isnan(column) | (F.abs(column) == float("inf")), F.lit(False))
    return found
