"""Row filter."""

from __future__ import annotations

from rowloom.frame import Frame, quoted
from rowloom.functions.predicates import predicate
from rowloom.guards import require_column, require_frame
from rowloom.streaming.steps import on_streams


@on_streams()
def filter_rows(frame: Frame, column: str, operator: str, value: str = "") -> Frame:
    """Keep the rows whose ``column`` satisfies ``operator`` against the text ``value``."""
    require_frame(frame)
    name = require_column(frame, column)
    dtype = frame.df.schema[name].dataType
    return frame.filtered(predicate(quoted(name), dtype, name, operator, value), uses=[name])
