"""Tagged-union JSON messages (F-j .. F-m) as Column expressions.

A sealed family of record types becomes one struct: a discriminator field
plus the superset of all fields, each nullable.  Encoding writes only the
fields of the row's own type; decoding parses the superset once
(``from_json``) and dispatches on the discriminator with ``when``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

TYPE_FIELD = "type"
CORRUPT = "_corrupt_record"
# Timestamps keep their microseconds through a round trip.
TS_OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
              "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def encode(tag: Column | str, fields: Mapping[str, Column], type_field: str = TYPE_FIELD) -> Column:
    """F-j: JSON text of ``{type: tag, field: value, ...}``.  Null fields
    are left out, so each type writes only its own fields."""
    tag_col = F.lit(tag) if isinstance(tag, str) else tag
    return F.to_json(F.struct(tag_col.alias(type_field), *[c.alias(n) for n, c in fields.items()]),
                     TS_OPTIONS)


def superset_schema(types: Mapping[str, Sequence[tuple[str, T.DataType]]],
                    type_field: str = TYPE_FIELD, corrupt: bool = True) -> T.StructType:
    """The read schema of a family of types: discriminator, every field of
    every type (a field name with two types is read as string), and the
    raw text of malformed messages."""
    seen: dict[str, T.DataType] = {}
    for fields in types.values():
        for name, dtype in fields:
            if name in seen and seen[name] != dtype:
                seen[name] = T.StringType()
            else:
                seen.setdefault(name, dtype)
    out = [T.StructField(type_field, T.StringType())]
    out += [T.StructField(n, d) for n, d in seen.items()]
    if corrupt:
        out.append(T.StructField(CORRUPT, T.StringType()))
    return T.StructType(out)


def decode(text: Column, schema: T.StructType) -> Column:
    """F-k: parse with the superset schema.  Malformed text gives a struct
    whose ``_corrupt_record`` holds the raw text (PERMISSIVE mode)."""
    opts = {"mode": "PERMISSIVE", **TS_OPTIONS}
    if CORRUPT in schema.fieldNames():
        opts["columnNameOfCorruptRecord"] = CORRUPT
    return F.from_json(text, schema, opts)


def is_valid(parsed: Column, known: Sequence[str], type_field: str = TYPE_FIELD,
             has_corrupt: bool = True) -> Column:
    """F-k/T19: the message parsed and has a known subtype.  Unknown
    subtypes and parse errors are skipped (but still committed)."""
    ok = F.coalesce(parsed[type_field].isin(*known), F.lit(False))
    return ok & parsed[CORRUPT].isNull() if has_corrupt else ok


# Fixed values of the nested message format (F-m): discriminator field
# "$type", message type "add_table", table name prefix "table - Foo Fighters ".
NESTED_TYPE_FIELD = "$type"
NESTED_TYPE = "add_table"
NESTED_NAME_PREFIX = "table - Foo Fighters "


def nested_message(i: Column) -> Column:
    """F-m: the nested ``add_table`` message for row ``i``: after_id i+1,
    table id i+2, name prefix followed by i*i, participants 4*i."""
    table = F.struct((i + 2).cast("int").alias("id"),
                     F.concat(F.lit(NESTED_NAME_PREFIX), (i * i).cast("string")).alias("name"),
                     (i * 4).cast("int").alias("participants"))
    return F.to_json(F.struct(F.lit(NESTED_TYPE).alias(NESTED_TYPE_FIELD), (i + 1).cast("int").alias("after_id"),
                              table.alias("table")))


NESTED_SCHEMA = T.StructType([
    T.StructField("$type", T.StringType()),
    T.StructField("after_id", T.IntegerType()),
    T.StructField("table", T.StructType([
        T.StructField("id", T.IntegerType()),
        T.StructField("name", T.StringType()),
        T.StructField("participants", T.IntegerType()),
    ])),
])
