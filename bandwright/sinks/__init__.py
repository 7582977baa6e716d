from .tables import ManagedTable
from .writers import (
    MODES,
    UnavailableFormatError,
    write_contract,
    write_csv,
    write_delta,
    write_jdbc,
    write_parquet,
)

__all__ = [
    "MODES",
    "ManagedTable",
    "UnavailableFormatError",
    "write_contract",
    "write_csv",
    "write_delta",
    "write_jdbc",
    "write_parquet",
]
