"""Skew-safe key lookup: probe distinct keys first, then attach to the rows once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

# A resolved table up to this many bytes is broadcast; they are added up first.
BROADCAST_BYTES = 96 << 20
# Beyond that, keys with at least one row in HOT_SHARE are joined by broadcast, and all
# other keys by shuffle. By arithmetic there are at most HOT_SHARE such keys.
HOT_SHARE = 1_000
HOT_SALTS = 256


def keyed_lookup(rows: DataFrame, keys: dict[str, Column],
                 resolve: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Add to ``rows`` the columns that ``resolve`` finds for each distinct key.

    ``keys`` maps key names to non-NULL expressions over ``rows``. ``resolve`` receives
    one row per distinct key (columns named as in ``keys``) and returns those keys with
    more columns. However often a key occurs, ``resolve`` sees it once, so its joins
    carry no skew and none of the wide row columns.
    """
    names = {k: f"_key_{k}" for k in keys}
    keyed = rows.withColumns({names[k]: c for k, c in keys.items()})
    distinct = keyed.groupBy(*[F.col(names[k]).alias(k) for k in keys]).agg(
        F.count(F.lit(1)).alias("_rows"))
    resolved = resolve(distinct)
    added = [c for c in resolved.columns if c not in keys and c != "_rows"]
    table = materialize(resolved.select(
        *[F.col(k).alias(names[k]) for k in keys], "_rows", F.struct(*added).alias("_found")))
    joined = attach(keyed, table, list(names.values()))
    return joined.select(*rows.columns, *[F.col(f"_found.{c}").alias(c) for c in added])


def _width(name: str, kind: T.DataType) -> Column:
    """Bytes of a column in a broadcast row, about."""
    value = F.col(name)
    if isinstance(kind, T.StructType):
        parts = [_width(f"{name}.{f.name}", f.dataType) for f in kind.fields]
        return sum(parts, F.lit(24))
    return F.coalesce(F.octet_length(value), F.lit(0)) + 16 if isinstance(kind, T.StringType) else F.lit(16)


def table_bytes(table: DataFrame) -> int:
    """What a table takes when it is broadcast, about: its columns and a hash entry for each row."""
    widths = [_width(f"`{f.name}`", f.dataType) for f in table.schema.fields]
    return table.agg(F.sum(sum(widths, F.lit(32)).cast("long"))).first()[0] or 0


def attach(rows: DataFrame, table: DataFrame, on: list[str]) -> DataFrame:
    """Left join of ``rows`` with ``table`` (one row per key; columns on, _rows, _found).

    ``_rows`` is the number of rows expected per key.
    """
    slim = table.select(*on, "_found")
    if table_bytes(slim) <= BROADCAST_BYTES:
        return rows.join(F.broadcast(slim), on, "left")

    total = table.agg(F.sum("_rows").alias("n")).scalar()
    hot = (table.where(F.col("_rows") * HOT_SHARE >= total)
           .select(*on, F.col("_found").alias("_hot")))
    salt = F.when(F.col("_hot").isNull(), 0).otherwise(
        1 + F.pmod(F.xxhash64(*rows.columns), F.lit(HOT_SALTS)))
    split = rows.join(F.broadcast(hot), on, "left").withColumn("_salt", salt)
    return (split.join(slim.withColumn("_salt", F.lit(0).cast("long")), on + ["_salt"], "left")
            .withColumn("_found", F.coalesce("_hot", "_found")).drop("_hot", "_salt"))
