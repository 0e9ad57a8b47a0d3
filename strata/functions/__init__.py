"""Column-level helpers (all built-in Spark expressions, no UDFs)."""

from strata.functions.docs import (  # noqa: F401
    decode_body, document_type, stamp_document, json_key, format_stamp,
    parse_stamp, raw_document_path, parse_object, stamp_object, object_type,
    object_map, unique_keys,
)
from strata.functions.ids import key_bucket, row_uid  # noqa: F401
from strata.functions.paths import folder_of  # noqa: F401
