"""Column functions: text, time and shape helpers built from Spark's own expressions."""

from pipekit.functions.shape import (band, classify, flatten, map_values, mark_status, pick,
                                     rename_by_position, schema_rows)
from pipekit.functions.text import (base_name, coded_label, decode_key, extension, first_segment,
                                    json_fields, last_segment, plain_path, relative_path, row_digest,
                                    safe_name, size_kb, split_fields, stem, tolerant_number)
from pipekit.functions.times import (add_time, local_clock, local_date, local_time, parse_date,
                                     second_diff, stamp, year_diff)

__all__ = [
    "add_time", "band", "base_name", "classify", "coded_label", "decode_key", "extension",
    "first_segment", "flatten", "json_fields", "last_segment", "local_clock", "local_date",
    "local_time", "map_values", "mark_status", "parse_date", "pick", "plain_path", "relative_path",
    "rename_by_position",
    "row_digest", "safe_name", "schema_rows", "second_diff", "size_kb", "split_fields", "stamp",
    "stem", "tolerant_number", "year_diff",
]
