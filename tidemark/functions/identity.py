"""Identity columns: salted pseudonyms, year generalisation, content fingerprints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, MapType, StructType


class MissingSalt(RuntimeError):
    """Raised before anything is read or written when no usable salt is set."""


def require_salt(salt: str | None) -> str:
    if not salt or salt.startswith("change-me"):
        raise MissingSalt("set a secret salt: identities must be hidden before any write")
    return salt


def pseudonym(identifier: Column, salt: str) -> Column:
    """First 16 hex digits of sha256(salt:identifier); equal ids stay joinable."""
    digest = F.sha2(F.concat(F.lit(require_salt(salt) + ":"), F.coalesce(identifier, F.lit(""))), 256)
    return F.substring(digest, 1, 16)


def year_prefix(text: Column) -> Column:
    """The year of a date text (its first four characters), '' when blank."""
    return F.coalesce(F.substring(F.trim(text), 1, 4), F.lit(""))


def content_hash(content: Column) -> Column:
    return F.sha2(content, 256)


def fingerprint_groups(rows: DataFrame, group: str, columns: Sequence[str]) -> DataFrame:
    """One content fingerprint and row count per group, whatever the row order.

    Two independent 64-bit row hashes are summed and xor-ed inside each task before
    the shuffle, so a single huge file spreads over all its splits and is never
    loaded whole. Hashes skip NULLs, so each column adds whether it is NULL, and nested
    columns are hashed as JSON that spells their NULLs out.
    """
    nested = {field.name for field in rows.schema if isinstance(field.dataType, (ArrayType, MapType, StructType))}

    def hashed(name: str) -> Column:
        return F.to_json(name, {"ignoreNullFields": "false"}) if name in nested else F.col(name)

    parts = [part for name in columns for part in (hashed(name), F.col(name).isNull())]
    first, second = F.xxhash64(F.lit(1), *parts), F.xxhash64(F.lit(2), *parts)
    return (
        rows.select(group, first.cast("decimal(20,0)").alias("_h1"), second.alias("_h2"))
        .groupBy(group)
        .agg(
            F.count("*").alias("rows"),
            F.sum("_h1").alias("_sum"),
            F.bit_xor("_h2").alias("_xor"),
        )
        .select(
            group,
            F.sha2(
                F.concat_ws(":", F.lit(",".join(columns)), "rows", "_sum", "_xor"), 256
            ).alias("sha256"),
            "rows",
        )
    )
