from dayshape.sources.tables import (
    key_hash,
    read_named,
    register,
    row_counts,
    sample_rows,
    scan_periods,
    smallest_hashes,
    write_by_period,
    write_tables,
)

__all__ = [
    "key_hash",
    "read_named",
    "register",
    "row_counts",
    "sample_rows",
    "scan_periods",
    "smallest_hashes",
    "write_by_period",
    "write_tables",
]
