"""JSON document expressions: decode, stamp, read keys, derive the landing path.

All of these run inside the JVM (``from_json`` to ``map<string,variant>``,
``map_filter``/``map_concat``, ``to_json``, ``try_variant_get``), so a micro-batch
is stamped by the executors, never row by row on the driver.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must match the reference's output.
STAMP_KEY = "BronzeCreatedAt"          # key added to every raw document
STAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"  # its text format
DATE_PATH_FORMAT = "yyyy/MM/dd"         # date folders of the raw layout
TYPE_KEY = "Type"                       # document key naming the entity type
UNKNOWN_TYPE = "unknown"                # type folder when the key is absent
FILE_PREFIX = "event_"                  # raw file name: event_{partition}_{seq}.json


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def decode_body(body="body") -> Column:
    """Binary message body -> UTF-8 string."""
    return _c(body).cast("string")


def format_stamp(ts) -> Column:
    return F.date_format(_c(ts), STAMP_FORMAT)


def object_map(doc) -> Column:
    """JSON object text -> ``map<string,variant>`` as parsed (NULL when the
    text is not an object; a repeated key appears twice)."""
    return F.from_json(_c(doc), "map<string,variant>")


def unique_keys(m) -> Column:
    """A parsed object with unique keys: a repeated key keeps its first
    position and its last value, as a JSON loader reads it. Only objects that
    do repeat a key pay for the de-duplication (``CASE`` evaluates one
    branch). Give it a column, not the parse itself, so the parse runs once."""
    m = _c(m)
    keys, vals = F.map_keys(m), F.map_values(m)
    idx = F.sequence(F.lit(1), F.size(keys))
    firsts = F.filter(idx, lambda i: F.array_position(keys, F.element_at(keys, i)) == i)

    def last_value(i):
        same = F.filter(idx, lambda j: F.element_at(keys, j) == F.element_at(keys, i))
        return F.element_at(vals, F.element_at(same, -1))

    deduped = F.map_from_arrays(F.transform(firsts, lambda i: F.element_at(keys, i)),
                                F.transform(firsts, last_value))
    return F.when(F.size(F.array_distinct(keys)) == F.size(keys), m).otherwise(deduped)


def parse_object(doc) -> Column:
    """``unique_keys(object_map(doc))`` in one expression (for ad-hoc use;
    pipelines project ``object_map`` first so the text is parsed once)."""
    return unique_keys(object_map(doc))


def stamp_object(obj, stamp, key: str = STAMP_KEY) -> Column:
    """Serialise a parsed object with ``key`` set to the stamp text (replacing
    an existing ``key``; other keys keep their order)."""
    # string -> JSON string value (escaped by to_json), as a variant
    value = F.variant_get(F.parse_json(F.to_json(F.array(_c(stamp)))), "$[0]", "variant")
    kept = F.map_filter(_c(obj), lambda k, v: k != F.lit(key))
    return F.to_json(F.map_concat(kept, F.create_map(F.lit(key), value)))


def object_type(obj, key: str = TYPE_KEY, default: str = UNKNOWN_TYPE) -> Column:
    """Lower-case entity type of a parsed object, ``default`` when absent or null."""
    value = F.try_element_at(_c(obj), F.lit(key))
    return F.lower(F.coalesce(F.try_variant_get(value, "$", "string"), F.lit(default)))


def stamp_document(doc, stamp, key: str = STAMP_KEY) -> Column:
    """Set ``key`` in a JSON object text to the stamp text; other keys keep order.

    An existing ``key`` is replaced; a body that is not a JSON object gives NULL.
    ``stamp`` is a string column: use ``format_stamp(ts)`` for timestamps.
    """
    return stamp_object(parse_object(doc), stamp, key)


def json_key(doc, path: str, type_: str = "string") -> Column:
    """Read one key of a JSON text; NULL when the text or the key is bad."""
    return F.try_variant_get(F.try_parse_json(_c(doc)), path, type_)


def document_type(doc, key: str = TYPE_KEY, default: str = UNKNOWN_TYPE) -> Column:
    """Lower-case entity type of a JSON object text, ``default`` when absent or null."""
    return object_type(parse_object(doc), key, default)


def raw_document_path(root: str, doc_type, stamp, partition, seq) -> Column:
    """``{root}/{type}/{yyyy/MM/dd}/event_{partition}_{seq}.json`` as a column."""
    return F.concat(F.lit(root.rstrip("/") + "/"), _c(doc_type), F.lit("/"),
                    F.date_format(_c(stamp), DATE_PATH_FORMAT), F.lit("/" + FILE_PREFIX),
                    _c(partition).cast("string"), F.lit("_"), _c(seq).cast("string"),
                    F.lit(".json"))


def parse_stamp(text) -> Column:
    """Parse a text stamp to a timestamp: ISO forms with any number of fraction
    digits, offsets, minutes only, dates only, unpadded parts; bad -> NULL (a text
    without a date is bad too)."""
    t = _c(text)
    return F.when(F.rlike(t, F.lit(r"^\s*\d{4}-")), t.try_cast("timestamp"))
