"""Payload codecs: bytes to message and message to bytes.

A message is ``STRUCT<kind, json, text, raw>``. ``kind`` is ``null``, ``bytes``,
``string`` or ``json``, and only the member of that kind is set.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from culvert.functions.results import Fallible, value_and_error

JSON_SPACE = " \t\r\n"

# Fixed value: start of the error text of a payload that cannot be encoded.
SERIALIZE_ERROR = "kafka producer: serialize payload: "


def message(
    kind: str | Column,
    json: Column | None = None,
    text: Column | None = None,
    raw: Column | None = None,
) -> Column:
    """A message of ``kind`` with its members."""
    nothing = F.lit(None)
    return F.struct(
        (F.lit(kind) if isinstance(kind, str) else kind).alias("kind"),
        (nothing.cast("variant") if json is None else json).alias("json"),
        (nothing if text is None else text).cast("string").alias("text"),
        (nothing if raw is None else raw).cast("binary").alias("raw"),
    )


@dataclass(frozen=True)
class Codec:
    """A wire format as a pair of Column functions.

    ``decode`` takes the value bytes (never null) and gives a message, or null
    when the bytes do not decode. ``encode`` takes a message and gives the
    bytes, or a pair ``(bytes, error)``. ``finish`` is an optional second step
    after ``decode``, for formats whose parse result is needed several times:
    it gets the bytes and what ``decode`` gave, and gives the message.
    """

    name: str
    decode: Callable[[Column], Column]
    encode: Callable[[Column], Fallible]
    finish: Callable[[Column, Column], Column] | None = None


def json_values(value: Column) -> Column:
    """The JSON values of a text, ARRAY<VARIANT>: one for a whole JSON text, several if commas stand between.

    Null unless the text is valid up to its end. ``try_parse_json`` stops after
    the first value and ignores what follows, so the text is parsed inside
    brackets. A text that closes them early, and so hides what follows, has a
    ``]`` of its own. Only such a text is also tried as the one member of an
    object: whatever closes the array breaks the object.
    """
    text = value.cast("string")
    only_member = F.size(F.json_object_keys(F.concat(F.lit('{"v":'), text, F.lit("}")))) == 1
    in_array = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    return F.when(~text.contains("]") | only_member, F.variant_get(in_array, "$", "array<variant>"))


def _is_json_string(value: Column) -> Column:
    """Whether bytes known to be JSON hold a string."""
    return F.ltrim(value.cast("string"), F.lit(JSON_SPACE)).startswith('"')


def _json_message(value: Column, values: Column) -> Column:
    parsed, is_string = F.get(values, F.lit(0)), _is_json_string(value)
    return F.when(
        F.size(values) == 1,
        message(
            F.when(is_string, "string").otherwise("json"),
            json=F.when(~is_string, parsed),
            text=F.when(is_string, F.variant_get(parsed, "$", "string")),
        ),
    )


def _auto_message(value: Column, values: Column) -> Column:
    return F.coalesce(_json_message(value, values), message("string", text=value.cast("string")))


def _json_text(msg: Column) -> Column:
    return F.to_json(msg["json"])


def _quoted_text(msg: Column) -> Column:
    """The text as a JSON string: a one-element array without its brackets."""
    return F.btrim(F.to_json(F.array(msg["text"])), F.lit("[]"))


def _encode_verbatim(msg: Column) -> Fallible:
    return (
        F.when(msg["kind"] == "bytes", msg["raw"])
        .when(msg["kind"] == "string", msg["text"].cast("binary"))
        .when(msg["kind"] == "json", _json_text(msg).cast("binary"))
    )


def _encode_json(msg: Column) -> Fallible:
    return F.when(msg["kind"] == "string", _quoted_text(msg).cast("binary")).otherwise(_encode_verbatim(msg))


def _encode_bytes(msg: Column) -> Fallible:
    value = F.when(msg["kind"] == "bytes", msg["raw"]).when(msg["kind"] == "string", msg["text"].cast("binary"))
    return value, F.when(msg["kind"] == "json", F.lit("bytes format needs bytes or string"))


CODECS = {
    codec.name: codec
    for codec in (
        Codec("auto", json_values, _encode_verbatim, _auto_message),
        Codec("json", json_values, _encode_json, _json_message),
        Codec("string", lambda value: message("string", text=value), _encode_verbatim),
        Codec("bytes", lambda value: message("bytes", raw=value), _encode_bytes),
    )
}


def codec_for(fmt: str | Codec) -> Codec:
    """The codec itself, or the built-in one of that name."""
    if isinstance(fmt, Codec):
        return fmt
    if fmt not in CODECS:
        raise ValueError(f"unknown wire format name: {fmt!r}")
    return CODECS[fmt]


def decode_payload(df: DataFrame, fmt: str | Codec = "auto") -> DataFrame:
    """Add ``msg`` and ``decode_failed`` from ``value``.

    A null value is a null message. Bytes that do not decode pass through as a
    message of kind ``bytes`` with ``decode_failed`` set; that is no error.
    """
    codec = codec_for(fmt)
    value = F.col("value")
    # What is used several times is a column of its own, so that it is computed once per row.
    df = df.withColumn("_parsed", F.when(value.isNotNull(), codec.decode(value)))
    if codec.finish is not None:
        df = df.withColumn("_parsed", codec.finish(value, F.col("_parsed")))
    parsed = F.col("_parsed")
    return df.withColumns({
        "decode_failed": value.isNotNull() & parsed.isNull(),
        "msg": F.when(value.isNull(), message("null"))
        .when(parsed.isNull(), message("bytes", raw=value))
        .otherwise(parsed),
    }).drop("_parsed")


def encode_payload(df: DataFrame, fmt: str | Codec = "auto") -> DataFrame:
    """Add ``value`` from ``msg``; set ``status`` and ``error`` where that fails.

    Where the rows carry a ``status`` already, only those that are ``ok`` are encoded.
    """
    codec = codec_for(fmt)
    msg = F.col("msg")
    if "status" in df.columns:
        live, status, error = F.col("status") == "ok", F.col("status"), F.col("error")
    else:
        live, status, error = F.lit(True), F.lit("ok"), F.lit(None).cast("string")
    value, reason = value_and_error(codec.encode(msg))
    encodes = live & (msg["kind"] != "null")
    df = df.withColumn("_reason", F.when(encodes, reason))
    failed = F.col("_reason").isNotNull()
    return df.withColumns({
        "value": F.when(encodes & ~failed, value).cast("binary"),
        "status": F.when(failed, F.lit("serialize_error")).otherwise(status),
        "error": F.when(failed, F.concat(F.lit(SERIALIZE_ERROR), F.col("_reason"))).otherwise(error),
    }).drop("_reason")
