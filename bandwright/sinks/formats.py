"""Options that writing and reading must agree on."""

from __future__ import annotations
# Spark's default CSV formats keep milliseconds only; these keep microseconds. Quotes inside a quoted field
# are doubled, so that a backslash before a quote survives. NULL is an empty field, as Spark writes it by
# default, and an empty string reads back as NULL; set `nullValue` in a contract's options to tell them apart.
CSV_TIME_FORMATS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "escape": '"',
}

