"""Text measures as Column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every boundary str.splitlines() honours.
LINE_BREAK = "\\r\\n|[\\n\\r\\u000b\\u000c\\u001c-\\u001e\\u0085\\u2028\\u2029]"


def line_count(text: Column) -> Column:
    """Number of lines; a trailing break opens no further line and empty text has none."""
    pieces = F.split(text, LINE_BREAK)
    open_tail = F.when(F.element_at(pieces, -1) == "", 1).otherwise(0)
    return (F.size(pieces) - open_tail).cast("bigint")
