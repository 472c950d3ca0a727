"""Stable identifiers as Column expressions (JVM-side sha2, no Python per row)."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from arborflow.constants import PARSER_VERSION, SCHEMA_VERSION
from arborflow.functions.paths import normalize_path


def _column(value) -> Column:
    """A plain string is a literal here; columns pass through."""
    return value if isinstance(value, Column) else F.lit(value)


def _digest(*parts) -> Column:
    # concat_ws drops NULLs, which would shift the fields, so they become ''.
    return F.sha2(F.concat_ws("|", *[F.coalesce(_column(p).cast("string"), F.lit("")) for p in parts]), 256)


def file_id(repository_id, path) -> Column:
    return _digest(repository_id, normalize_path(_column(path)))


def content_hash(content) -> Column:
    """sha256 of the raw bytes (a string column hashes its UTF-8 bytes)."""
    return F.sha2(_column(content), 256)


def node_id(file, node_type, qualified_scope, semantic_key, ast_path) -> Column:
    return _digest(file, node_type, qualified_scope, semantic_key, ast_path)


def edge_id(source_id, edge_type, target_id, role="") -> Column:
    return _digest(source_id, edge_type, target_id, role)


def event_id(event_type, entity_id, content, parser_version=PARSER_VERSION, schema_version=SCHEMA_VERSION) -> Column:
    return _digest(schema_version, parser_version, event_type, entity_id, content)


def generation_id(file, content, parser_version=PARSER_VERSION, schema_version=SCHEMA_VERSION) -> Column:
    """NULL as soon as one part is NULL."""
    colon = F.lit(":")
    return F.concat(_column(file), colon, _column(content), colon, _column(parser_version), colon, _column(schema_version))
