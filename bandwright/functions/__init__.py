from .audit import LOAD_COLUMNS, LOAD_DATE, with_load_columns
from .checks import (
    EmptyFrameError,
    MissingColumnsError,
    require_choice,
    require_columns,
    require_duration,
    require_frame,
    require_positive,
    require_rows,
)
from .missing import is_complete, is_incomplete, nan_to_null

__all__ = [
    "EmptyFrameError",
    "LOAD_COLUMNS",
    "LOAD_DATE",
    "MissingColumnsError",
    "is_complete",
    "is_incomplete",
    "nan_to_null",
    "require_choice",
    "require_columns",
    "require_duration",
    "require_frame",
    "require_positive",
    "require_rows",
    "with_load_columns",
]
