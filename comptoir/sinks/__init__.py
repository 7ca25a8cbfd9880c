"""Writers of the lake's zones."""

from comptoir.sinks.tables import read_keyed, read_pieces, read_table, replace_partition, replace_table, run, upsert, write_new

__all__ = ["read_keyed", "read_pieces", "read_table", "replace_partition", "replace_table", "run", "upsert", "write_new"]
