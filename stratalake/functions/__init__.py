from .decode import (
    bytes_to_text,
    infer_xml_files,
    infer_xml_schema,
    narrow_schema,
    parse_json,
    parse_xml,
)
from .elements import parse_elements, split_elements
from .timing import stamp_arrival, utc_instant, utc_wall_clock

__all__ = [
    "bytes_to_text",
    "infer_xml_files",
    "infer_xml_schema",
    "narrow_schema",
    "parse_elements",
    "parse_json",
    "parse_xml",
    "split_elements",
    "stamp_arrival",
    "utc_instant",
    "utc_wall_clock",
]
