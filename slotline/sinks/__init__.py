"""Writers of the extract files."""

from slotline.sinks.files import clip_records, read_files, split_result, write_files
from slotline.sinks.relation import positions, read_relation, write_relation

__all__ = ["clip_records", "positions", "read_files", "read_relation", "split_result", "write_files", "write_relation"]
