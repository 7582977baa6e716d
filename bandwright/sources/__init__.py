from .files import admit_late_files, read_contract, read_csv, read_table, stream_csv

__all__ = ["admit_late_files", "read_contract", "read_csv", "read_table", "stream_csv"]
