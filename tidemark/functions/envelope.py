"""Column expressions over one JSON envelope held as text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from tidemark.functions import text
from tidemark.schemas import ENVELOPE, EVENT_TYPES

# Strict JSON, as both readers parse it.
STRICT_JSON = {"mode": "PERMISSIVE", "allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
FIELDS = ("user_id", "item_id", "event_type", "created_at")
# Fixed texts of the gateway's validation report, in report order.
USER_REQUIRED = "user_id is required"
ITEM_REQUIRED = "item_id is required"
TYPE_UNKNOWN = "event_type must be one of: impression, click, dwell, like, share"
MAX_BODY_BYTES = 65536

# An ordinary body: one flat object without escapes, the known names in lower case with text or null, and plain
# scalars under all other names. Possessive, so that a long body is read once.
_SPACE = r"[ \t\n\r]*+"
_TEXT = r'[^"\\\x00-\x1f]*+"'
_KNOWN = "|".join(FIELDS)
_MEMBER = (
    rf'"(?:(?:{_KNOWN})"{_SPACE}:{_SPACE}(?:"{_TEXT}|null)'
    rf'|(?!(?i:{_KNOWN})"){_TEXT}{_SPACE}:{_SPACE}(?:"{_TEXT}|-?+(?:0|[1-9]\d*+)|true|false|null))'
)
_ORDINARY = rf"^{_SPACE}\{{{_SPACE}(?:{_MEMBER}{_SPACE}(?:,{_SPACE}(?=\")|(?=\}})))*+\}}{_SPACE}\z"


def computed_once(struct: Column) -> Column:
    """The struct as a generated column, which the optimizer does not copy into filters above it.

    A plain projection would be substituted into each condition on its fields, and the text parsed again
    for every one of them.
    """
    return F.explode(F.array(struct))


def decode(value: Column) -> Column:
    """Struct of the four text fields, all NULL unless the text starts with one JSON object.

    Unknown fields and text after the object are ignored. A top-level array is refused here because
    ``from_json`` would take its first element.
    """
    parsed = F.from_json(value, ENVELOPE, STRICT_JSON)
    return F.when(value.rlike(r"^\s*\{"), parsed)


def is_scalar_id(value: Column, name: str, decoded: Column) -> Column:
    """False when the id was an object or array, which ``from_json`` renders as text.

    Only ids that look like nested JSON pay for the second parse.
    """
    looks_nested = decoded.rlike(r"^[\[{]")
    kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json(value), f"$.{name}", "variant"))
    return F.when(looks_nested, F.coalesce(kind == "STRING", F.lit(False))).otherwise(True)


def is_valid_event(user_id: Column, item_id: Column, event_type: Column, created_at: Column) -> Column:
    return (
        user_id.isNotNull()
        & ~text.is_blank(user_id)
        & item_id.isNotNull()
        & ~text.is_blank(item_id)
        & event_type.isin(*EVENT_TYPES)
        & created_at.isNotNull()
    )


def decode_ordinary(value: Column) -> Column:
    """Struct of the four text fields of an ordinary body, NULL for any other text.

    Such a body needs no second look: it is one valid document, its known fields have the right JSON types, and
    none of them is given twice.
    """
    once = reduce(
        lambda a, b: a & b,
        [F.length(value) - F.length(F.replace(value, F.lit(f'"{n}"'))) <= len(n) + 2 for n in FIELDS],
    )
    return F.when(value.rlike(_ORDINARY) & once, F.from_json(value, ENVELOPE, STRICT_JSON))


def sole_document(value: Column) -> Column:
    """Entries of the single JSON object in the text.

    The text is wrapped in brackets, so that anything after the first value breaks the parse. Text that
    closes the bracket itself is caught by a second wrapping in braces. Returned as an array: empty text
    gives ``[]``, JSON null ``[null]``, one object ``[map]``, and everything else NULL or a longer array.
    """
    wrapped = F.from_json(
        F.concat(F.lit("["), value, F.lit("]")), "array<map<string,variant>>", STRICT_JSON
    )
    braced = F.from_json(F.concat(F.lit('{"d":'), value, F.lit("}")), "map<string,variant>", STRICT_JSON)
    return F.when(~value.contains("]") | braced.isNotNull(), wrapped)


def known_fields(document: Column) -> Column:
    """The known fields of a document map, in document order: lower-case name, JSON type and value."""
    known = F.map_filter(document, lambda key, _: F.lower(key).isin(*FIELDS))

    def describe(entry: Column) -> Column:
        value = entry["value"]
        return F.struct(
            F.lower(entry["key"]).alias("name"), F.schema_of_variant(value).alias("kind"), value.alias("value")
        )

    return F.transform(F.map_entries(known), describe)


def has_wrong_type(fields: Column) -> Column:
    """A known field that is neither text nor null, or a ``created_at`` that is no RFC 3339 time."""

    def wrong(field: Column) -> Column:
        at = field["value"].cast("string")
        bad_time = ~text.is_rfc3339(at)
        return ~field["kind"].isin("STRING", "VOID") | (
            (field["name"] == "created_at") & (field["kind"] == "STRING") & bad_time
        )

    return F.exists(fields, wrong)


def text_field(fields: Column, name: str) -> Column:
    """Last text value under the name; empty when absent or null."""
    hits = F.filter(fields, lambda field: (field["name"] == name) & (field["kind"] == "STRING"))
    return F.coalesce(F.try_element_at(hits, F.lit(-1))["value"].cast("string"), F.lit(""))


def problems(user_id: Column, item_id: Column, event_type: Column) -> Column:
    """All validation problems in fixed order, joined by ``"; "``; empty text when there is none."""
    checks = (
        (text.trim_space(user_id) == "", USER_REQUIRED),
        (text.trim_space(item_id) == "", ITEM_REQUIRED),
        (~event_type.isin(*EVENT_TYPES), TYPE_UNKNOWN),
    )
    # concat_ws skips NULLs, which is what a passed check leaves.
    return F.concat_ws("; ", *[F.when(failed, F.lit(message)) for failed, message in checks])


def wire_text(user_id: Column, item_id: Column, event_type: Column, created_at: Column) -> Column:
    """The JSON envelope, fields in wire order, angle brackets and ampersand escaped."""
    document = F.to_json(
        F.struct(
            user_id.alias("user_id"),
            item_id.alias("item_id"),
            event_type.alias("event_type"),
            text.instant_text(created_at).alias("created_at"),
        )
    )
    # Characters the wire format writes as escapes.
    escapes = {"<": "\\u003c", ">": "\\u003e", "&": "\\u0026", "\u2028": "\\u2028", "\u2029": "\\u2029"}
    return reduce(lambda c, kv: F.replace(c, F.lit(kv[0]), F.lit(kv[1])), escapes.items(), document)
