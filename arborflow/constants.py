"""They must equal the published event contract, so they are stated as they are."""

from typing import NamedTuple

# Versions stamped on every event and state row.
PARSER_VERSION = "1.0.0"
SCHEMA_VERSION = "1.0"
PARSER_NAME = "python.ast"

# Event type -> topic it is published on. Every topic is keyed by file_id.
TOPIC_BY_EVENT = {
    "NODE_UPSERT": "cpg.nodes",
    "NODE_DELETE": "cpg.nodes",
    "EDGE_UPSERT": "cpg.edges",
    "EDGE_DELETE": "cpg.edges",
    "FILE_METADATA_UPSERT": "source.metadata",
    "PARSER_ERROR": "parser.errors",
}
DEAD_LETTER_TOPIC = "connector.errors"

# Order in which one file's events are published.
EVENT_ORDER = ["EDGE_DELETE", "NODE_DELETE", "NODE_UPSERT", "EDGE_UPSERT", "FILE_METADATA_UPSERT"]

ENVELOPE_FIELDS = [
    "schema_version",
    "event_id",
    "event_type",
    "event_time",
    "repository_id",
    "commit_sha",
    "file_id",
    "file_path",
    "content_hash",
    "parser_version",
]
METADATA_COUNTERS = [
    "size_bytes",
    "line_count",
    "function_count",
    "class_count",
    "import_count",
    "node_count",
    "edge_count",
    "parse_duration_ms",
]
METADATA_FIELDS = METADATA_COUNTERS + ["parse_status", "parser"]

# Fixed values of the source scan and of discovery: they must equal the published scopes.
PRUNED_DIRECTORIES = [".git", ".mypy_cache", ".pytest_cache", ".ruff_cache"]
ALL_PYTHON = ("**/*.py",)
NOT_INCLUDED_REASON = "Excluded by scope include pattern"


class Scope(NamedTuple):
    """What a discovery scope states itself; None is left to its parent."""

    include: tuple | None = None
    exclude: tuple | None = None  # (pattern, reason), the first match counts
    parent: str | None = None
    max_files: int | None = None


SCOPES = {
    "raw": Scope(include=ALL_PYTHON, exclude=()),
    "eligible": Scope(
        include=ALL_PYTHON,
        exclude=(
            ("**/tests/**", "Excluded test file"),
            ("tests/**", "Excluded test file"),
            ("**/test_*.py", "Excluded test file"),
            ("**/*_test.py", "Excluded test file"),
            ("**/conftest.py", "Excluded test support file"),
            ("setup.py", "Excluded setup/build file"),
            ("**/setup.py", "Excluded setup/build file"),
            ("**/setup_*.py", "Excluded setup/build file"),
            ("**/build/**", "Excluded setup/build output"),
            ("**/__pycache__/**", "Excluded generated cache file"),
            ("**/generated/**", "Excluded generated file"),
            ("**/*_pb2.py", "Excluded generated protobuf file"),
            ("**/*_pb2_grpc.py", "Excluded generated protobuf file"),
            ("**/vendor/**", "Excluded vendored dependency file"),
            ("**/.venv/**", "Excluded virtual environment file"),
        ),
    ),
    "final": Scope(parent="eligible"),
    "smoke": Scope(parent="eligible", include=("src/**/*.py",), max_files=5),
}
