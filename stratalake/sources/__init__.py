from .files import (
    query_json_path,
    read_binary_files,
    read_evolving,
    read_json,
    read_xml_rows,
    with_source_path,
)
from .schemas import kept_xml_schema, merge_schemas
from .streams import (
    stream_binary_files,
    stream_envelopes,
    stream_table,
    stream_text_lines,
    stream_xml_rows,
)

__all__ = [
    "kept_xml_schema",
    "merge_schemas",
    "query_json_path",
    "read_binary_files",
    "read_evolving",
    "read_json",
    "read_xml_rows",
    "stream_binary_files",
    "stream_envelopes",
    "stream_table",
    "stream_text_lines",
    "stream_xml_rows",
    "with_source_path",
]
