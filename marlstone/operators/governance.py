"""Governed reads: layer access, row filters, column masks and tag policies.

These shape what a DataFrame shows to a caller whose groups are known.  They do
not replace the access control of a catalog.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.functions.masks import (
    ANALYSTS, BI_READER, ENGINEERS, mask_email, mask_tagged_pii, region_visible,
)

Groups = Iterable[str]

# Which groups may read which layer.
LAYER_READERS = {
    "bronze": frozenset({ENGINEERS}),
    "silver": frozenset({ENGINEERS}),
    "gold": frozenset({ENGINEERS, ANALYSTS, BI_READER}),
}


@dataclass(frozen=True)
class TagPolicy:
    """Mask every column that carries a tag, for all but the exempt groups."""

    tag: str
    value: str
    mask: Callable[[Column, Groups], Column]
    exempt: frozenset[str] = frozenset()

    def matches(self, metadata: Mapping) -> bool:
        return metadata.get(self.tag) == self.value


PII_POLICY = TagPolicy("sensitivity", "pii", mask_tagged_pii, frozenset({ENGINEERS}))


@dataclass(frozen=True)
class Guard:
    """What protects one table."""

    column_masks: Mapping[str, Callable[[Column, Groups], Column]] = field(default_factory=dict)
    row_filter: tuple[str, Callable[[Column, Groups], Column]] | None = None
    tag_policies: tuple[TagPolicy, ...] = ()


# The protected tables.
GUARDS = {
    "dim_customer": Guard({"email": mask_email}, tag_policies=(PII_POLICY,)),
    "dim_customer_keyed": Guard({"email": mask_email}),
    "mv_sales_by_state": Guard(row_filter=("state", region_visible)),
}


def tag_column(df: DataFrame, column: str, tag: str, value: str) -> DataFrame:
    """Attach a tag to a column; it is stored with the table's schema."""
    return df.withMetadata(column, {**df.schema[column].metadata, tag: value})


def list_column_tags(df: DataFrame, table: str) -> DataFrame:
    """One row per tag: table, column, tag name and value.

    The rows come from the schema alone, so their number is the number of tags.
    """
    rows = [
        (table, f.name, str(tag), str(value))
        for f in df.schema.fields for tag, value in sorted(f.metadata.items())
    ]
    return df.sparkSession.createDataFrame(
        rows, "table_name string, column_name string, tag_name string, tag_value string"
    )


def may_read_layer(layer: str, groups: Groups) -> bool:
    return bool(LAYER_READERS[layer] & set(groups))


def apply_tag_policies(df: DataFrame, groups: Groups, policies: Iterable[TagPolicy]) -> tuple[DataFrame, set[str]]:
    """Masked DataFrame and the columns a policy applied to."""
    masked: dict[str, Column] = {}
    for policy in policies:
        if policy.exempt & set(groups):
            continue
        for f in df.schema.fields:
            if policy.matches(f.metadata) and f.name not in masked:
                masked[f.name] = policy.mask(F.col(f.name), groups)
    return df.withColumns(masked) if masked else df, set(masked)


def secure_read(df: DataFrame, table: str, groups: Groups, layer: str = "gold",
                guards: Mapping[str, Guard] = GUARDS) -> DataFrame:
    """The table as this caller may see it.

    The row filter reads unmasked values.  Tag policies come before the column
    masks, which apply only where no policy did.
    """
    groups = frozenset(groups)
    if not may_read_layer(layer, groups):
        raise PermissionError(f"no group of the caller may read the {layer} layer")
    guard = guards.get(table, Guard())
    if guard.row_filter:
        column, visible = guard.row_filter
        df = df.where(visible(F.col(column), groups))
    df, done = apply_tag_policies(df, groups, guard.tag_policies)
    masks = {c: mask(F.col(c), groups) for c, mask in guard.column_masks.items() if c not in done}
    return df.withColumns(masks) if masks else df


def visible_layers(df: DataFrame, table: str, groups: Groups) -> DataFrame:
    """Per layer: whether the caller may read it, and the rows of ``df`` seen there."""
    rows_seen = df.agg(F.count(F.lit(1)).alias("row_count"))
    layers = F.explode(F.array(*[
        F.struct(F.lit(layer).alias("layer"), F.lit(may_read_layer(layer, groups)).alias("readable"))
        for layer in LAYER_READERS
    ]))
    return rows_seen.select(F.lit(table).alias("table_name"), layers.alias("l"), "row_count").select(
        "table_name", "l.layer", "l.readable",
        F.when(F.col("l.readable"), F.col("row_count")).otherwise(0).alias("row_count"),
    )
