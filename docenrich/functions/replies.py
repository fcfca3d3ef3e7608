"""Requests to the model and the JSON it answers with."""

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What a reply body can be.
OBJECT = "object"
NULL = "null"
MALFORMED = "malformed"
OTHER = "other"

_KEEP_NULLS = {"ignoreNullFields": "false"}
_STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
_BLANKS = " \t\r\n"


def request_payload(text: Column, field: str = "text") -> Column:
    """The request body: one JSON object with the whole text in one field."""
    return F.to_json(F.struct(text.alias(field)), _KEEP_NULLS)


def to_json_row(*columns: Column) -> Column:
    """A JSON object of the columns; a NULL column stays as an explicit null."""
    return F.to_json(F.struct(*columns), _KEEP_NULLS)


def is_json(body: Column) -> Column:
    """Whether the whole body is one JSON value, by the standard's own grammar.

    Spark's parsers stop after the first value. Inside a list nothing but that
    value may come before the end; a body that ends the list itself is no value
    of an object.
    """
    in_list = F.from_json(F.concat(F.lit("["), body, F.lit("]")), "array<string>", _STRICT)
    in_object = F.from_json(
        F.concat(F.lit('{"v":'), body, F.lit("}")), "map<string,string>", _STRICT
    )
    return in_list.isNotNull() & in_object.isNotNull()


def reply_kind(body: Column) -> Column:
    """object, null, malformed or other (array, string, number); NULL if no body."""
    bare = F.btrim(body, F.lit(_BLANKS))
    return (
        F.when(body.isNull(), F.lit(None).cast("string"))
        .when(~is_json(body), F.lit(MALFORMED))
        .when(bare.startswith("{"), F.lit(OBJECT))
        .when(bare == "null", F.lit(NULL))
        .otherwise(F.lit(OTHER))
    )


def get_or_default(body: Column, key: str, default: str) -> Column:
    """The default only where the key is absent: an explicit null stays NULL."""
    return F.when(reply_kind(body) == OBJECT, object_field(body, key, default)).otherwise(F.lit(default))


def object_field(body: Column, key: str, default: str) -> Column:
    """``get_or_default`` of a body that is known to be one JSON value."""
    named = F.array_contains(F.json_object_keys(body), key)
    return F.when(named, _field(body, key)).otherwise(F.lit(default))


def _field(body: Column, key: str) -> Column:
    return F.from_json(body, T.StructType([T.StructField(key, T.StringType())])).getField(key)


def is_empty_reply(body: Column) -> Column:
    """Bodies that say nothing: ``{}  []  ""  0  false  null`` and no body at all."""
    scalar = F.btrim(body, F.lit(_BLANKS)).rlike(r'^(null|false|""|-?0(\.0+)?([eE][+-]?[0-9]+)?)$')
    return (
        F.when(body.isNull(), F.lit(True))
        .when(F.json_object_keys(body).isNotNull(), F.size(F.json_object_keys(body)) == 0)
        .when(F.json_array_length(body).isNotNull(), F.json_array_length(body) == 0)
        .otherwise(scalar)
    )
