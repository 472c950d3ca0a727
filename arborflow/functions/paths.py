"""Path and glob expressions."""

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def glob_regex(pattern: str) -> str:
    """Anchored regular expression of a shell glob in which `*` also crosses `/`."""
    out, i = [], 0
    while i < len(pattern):
        char = pattern[i]
        close = pattern.find("]", i + 2) if char == "[" else -1
        if char == "*":
            out.append(".*")
        elif char == "?":
            out.append(".")
        elif close > 0:
            body = pattern[i + 1 : close].replace("\\", "\\\\").replace("[", "\\[").replace("&&", "&\\&")
            out.append("[^" + body[1:] + "]" if body.startswith("!") else "[" + body + "]")
            i = close
        else:
            out.append(re.escape(char))
        i += 1
    return "(?s)^" + "".join(out) + "\\z"


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def matches_glob(path: Column, pattern: str) -> Column:
    """Full path or base name matches the pattern, its `**/`-less form or its `/**/` -> `/` form."""
    variants = {pattern, pattern.removeprefix("**/"), pattern.replace("/**/", "/")}
    regex = "|".join(f"(?:{glob_regex(v)})" for v in sorted(variants))
    return path.rlike(regex) | base_name(path).rlike(regex)


def path_problem(path: Column) -> Column:
    """Why a path is not a relative path inside the repository; NULL when it is fine."""
    slashed = F.regexp_replace(path, r"\\", "/")
    return (
        F.when(slashed.startswith("../") | slashed.contains("/../"), "leaves the repository")
        .when(slashed.startswith("/"), "starts at the root")
    )


def clean_path(path: Column) -> Column:
    """POSIX form without repeated slashes or `.` segments."""
    squeezed = F.regexp_replace(path, r"/(?:\./|/)*", "/")
    trimmed = F.regexp_replace(F.regexp_replace(squeezed, r"^(?:\./)+", ""), r"(?<=[^/])/\.?$", "")
    return F.regexp_replace(trimmed, r"\\", "/")


def normalize_path(path: Column) -> Column:
    """clean_path that fails the job on a path outside the repository."""
    problem = path_problem(path)
    return F.when(problem.isNotNull(), F.raise_error(F.concat_ws(": ", problem, path)).cast("string")).otherwise(
        clean_path(path)
    )
