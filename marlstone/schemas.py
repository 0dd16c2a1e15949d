"""Landing schemas, business keys and stored columns of the seven entities."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Entity names, their columns and file formats.
_DDL = {
    "customers": "customer_id string, customer_name string, email string, city string, "
                 "state string, signup_date string",
    "products": "product_id string, product_category string, product_name string, "
                "base_price double, weight_grams int",
    "sellers": "seller_id string, seller_name string, seller_city string, seller_state string",
    "orders": "order_id string, customer_id string, order_status string, order_date string, "
              "order_total double",
    "order_items": "order_id string, item_seq int, product_id string, seller_id string, "
                   "quantity int, unit_price double",
    "payments": "order_id string, payment_type string, "
                "installments array<struct<installment_no: bigint, amount: double, paid: boolean>>",
    "reviews": "review_id string, order_id string, score bigint, comment string, "
               "review_date string, meta struct<verified: boolean, helpful_votes: bigint>",
}


@dataclass(frozen=True)
class Entity:
    """One landing feed: how it arrives and what identifies a row."""

    name: str
    format: str
    ddl: str

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.ddl)

    @property
    def bronze(self) -> str:
        return f"br_{self.name}"

    @property
    def silver(self) -> str:
        return f"slv_{self.name}"


ENTITIES = {
    name: Entity(
        name,
        "json" if name in ("payments", "reviews") else "csv",
        ddl,
    )
    for name, ddl in _DDL.items()
}

# Columns every bronze table carries besides the landed ones.
RESCUED = "_rescued_data"
INGEST_METADATA = T.StructType([
    # The line as it came, where a value does not fit its column or a field has none.
    T.StructField(RESCUED, T.StringType()),
    T.StructField("_source_file", T.StringType()),
    T.StructField("_source_file_ts", T.TimestampType()),
    T.StructField("_ingested_at", T.TimestampType()),
])


def bronze_schema(landed: T.StructType) -> T.StructType:
    return T.StructType(landed.fields + INGEST_METADATA.fields)


def merge_schemas(known: T.StructType, seen: T.StructType) -> T.StructType:
    """``known`` plus the columns only ``seen`` has, also inside nested structs.

    A column both have keeps its known type: files only ever add columns.
    """
    def merged(old: T.DataType, new: T.DataType) -> T.DataType:
        if isinstance(old, T.StructType) and isinstance(new, T.StructType):
            return merge_schemas(old, new)
        if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
            return T.ArrayType(merged(old.elementType, new.elementType), True)
        return old

    by_name = {field.name.lower(): field for field in seen.fields}
    fields = [
        T.StructField(
            field.name,
            merged(field.dataType, by_name[field.name.lower()].dataType)
            if field.name.lower() in by_name else field.dataType,
            True,
            field.metadata,
        )
        for field in known.fields
    ]
    have = {field.name.lower() for field in known.fields}
    fields += [
        T.StructField(field.name, field.dataType, True)
        for field in seen.fields if field.name.lower() not in have
    ]
    return T.StructType(fields)
