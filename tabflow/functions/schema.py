"""Declared schemas: ``name:TYPE`` text and registry field lists."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import types as T

# The type names a declared schema may use.
FIELD_TYPES: dict[str, T.DataType] = {
    "STRING": T.StringType(),
    "INT64": T.LongType(),
    "FLOAT64": T.DoubleType(),
    "DATE": T.DateType(),
    "DATETIME": T.TimestampNTZType(),
    "TIMESTAMP": T.TimestampType(),
}

# The declared schemas of the account, count and scenario tables.
ACCOUNT_SCHEMA_TEXT = (
    "name:STRING, address:STRING, country_code:STRING, city:STRING, bank_iban:STRING, "
    "company:STRING, credit_card:INT64, credit_card_provider:STRING, "
    "credit_card_expires:STRING, date_record_created:DATETIME, employement:STRING, "
    "emp_id:STRING, name_prefix:STRING, phone_number:STRING"
)
COUNT_SCHEMA_TEXT = "country_name:STRING, num_cc_card:INT64"
SCENARIO_SCHEMA_TEXT = "jobid:STRING, scenarioid:INT64, migration_pl:FLOAT64, default_pl:FLOAT64"


def field_type(name: str) -> T.DataType:
    try:
        return FIELD_TYPES[name.strip().upper()]
    except KeyError:
        raise ValueError(f"unknown field type {name!r}; known: {sorted(FIELD_TYPES)}") from None


def schema_from_text(text: str) -> T.StructType:
    """``"id:INT64, name:STRING"`` as a schema; every column is nullable."""
    schema = T.StructType()
    for part in text.split(","):
        name, colon, kind = part.strip().partition(":")
        if not colon or not name.strip():
            raise ValueError(f"expected name:TYPE, got {part.strip()!r}")
        schema.add(name.strip(), field_type(kind), nullable=True)
    return schema


def schema_from_fields(fields: Iterable[Mapping[str, str]]) -> T.StructType:
    """Registry fields (``name``, ``type``, ``mode``) as a schema. Only NULLABLE exists."""
    schema = T.StructType()
    for field in fields:
        mode = (field["mode"] or "NULLABLE").upper()
        if mode != "NULLABLE":
            raise ValueError(f"field {field['name']!r} has unsupported mode {mode}")
        schema.add(field["name"], field_type(field["type"]), nullable=True)
    return schema


def schema_to_text(schema: T.StructType) -> str:
    """The ``name:TYPE`` text of a schema made of declared types."""
    names = {kind.typeName(): name for name, kind in FIELD_TYPES.items()}
    return ", ".join(f"{f.name}:{names[f.dataType.typeName()]}" for f in schema.fields)


ACCOUNT_SCHEMA = schema_from_text(ACCOUNT_SCHEMA_TEXT)
COUNT_SCHEMA = schema_from_text(COUNT_SCHEMA_TEXT)
SCENARIO_SCHEMA = schema_from_text(SCENARIO_SCHEMA_TEXT)
