"""Joins against a side that is unique on the key."""

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 32 << 20
SALTS = 16
NULL_SALTS = 1024
#: Bytes of a sieve: at least and at most, and how many for each value.
SIEVE_LEAST, SIEVE_MOST, SIEVE_ROOM = 1 << 12, 1 << 20, 16
_SALT = "__salt"
_ROW_OVERHEAD = 32


def measured_bytes(df: DataFrame) -> int:
    """Size of the rows, by a distributed sum; one number reaches the driver."""
    width = F.lit(_ROW_OVERHEAD)
    for name, kind in df.dtypes:
        if kind == "string":
            width = width + F.coalesce(F.octet_length(F.col(name)), F.lit(0))
        elif kind.startswith(("array", "struct", "map")):
            width = width + F.octet_length(F.coalesce(F.to_json(F.struct(name)), F.lit("")))
        else:
            width = width + F.lit(16)
    return df.agg(F.sum(width)).first()[0] or 0


def salt_of(columns: Sequence[str | Column], salts: int) -> Column:
    """A repeatable salt, so that a retried task sends its rows where they went before.

    Without columns to tell rows apart there is nothing to salt by.
    """
    if not columns:
        return F.lit(0)
    return F.pmod(F.xxhash64(*columns), F.lit(salts)).cast("int")


def sieve(table: DataFrame, column: str, most: int = SIEVE_MOST) -> Callable[[Column], Column]:
    """A test inside the row that every value of the column passes, and few others.

    The values' hashes mark places in a bitmap of at most ``most`` bytes, which travels with the
    plan; one number per marked place reaches the driver. It only saves rows ahead of an exact
    join: with very many values it lets more through, never less.
    """
    values = table.select(column).where(F.col(column).isNotNull()).distinct()
    size = min(most, max(SIEVE_LEAST, 1 << (SIEVE_ROOM * values.count()).bit_length()))
    place = F.pmod(F.xxhash64(column), F.lit(size)).cast("int")
    marked = bytearray(b"0" * size)
    for row in values.select(place.alias("place")).distinct().collect():
        marked[row.place] = ord("1")
    bitmap = F.lit(bytes(marked))

    def passes(value: Column) -> Column:
        at = F.pmod(F.xxhash64(value), F.lit(size)).cast("int") + 1
        return F.substring(bitmap, at, F.lit(1)) == F.lit(b"1")

    return passes


def lookup(
    facts: DataFrame,
    table: DataFrame,
    on: str | Sequence[str],
    how: str = "left",
    spread: Sequence[str] | None = None,
    limit_bytes: int = BROADCAST_BYTES,
    salts: int = SALTS,
    size: int | None = None,
) -> DataFrame:
    """Join ``facts`` to ``table``, which holds each key at most once.

    The table is measured first. Up to ``limit_bytes`` it is broadcast and the facts stay
    where they are. Beyond that both sides are shuffled on the key and a salt taken from
    the ``spread`` columns, so the rows of one hot key, or of NULL, fill many tasks.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if (measured_bytes(table) if size is None else size) <= limit_bytes:
        return facts.join(F.broadcast(table), keys, how)
    others = list(spread) if spread else [c for c in facts.columns if c not in keys]
    salted = facts.withColumn(_SALT, salt_of(others, salts))
    copies = table.withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, [*keys, _SALT], how).drop(_SALT)


def attach(facts: DataFrame, table: DataFrame, on: str, how: str = "left") -> DataFrame:
    """Join ``facts`` to a derived table that holds each key at most once.

    Measuring a derived table would compute it twice, so Spark picks the join at run time
    from the shuffled sizes, and its adaptive skew join splits a hot key. Rows with a
    NULL key match nothing; a salt keeps them from meeting in one task. The salt of every
    other row is 0, taken from the key: as a constant it would be dropped from the join.
    """
    others = [c for c in facts.columns if c != on]
    zero = salt_of([on], 1)
    salt = F.when(F.col(on).isNull(), salt_of(others, NULL_SALTS)).otherwise(zero)
    keyed = table.where(F.col(on).isNotNull()).withColumn(_SALT, zero)
    return facts.withColumn(_SALT, salt).join(keyed, [on, _SALT], how).drop(_SALT)
