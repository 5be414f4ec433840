"""Schema-checked readers for the declared source tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaar import schemas


class SchemaDriftError(ValueError):
    """A declared column is missing or has an incompatible type."""


_INTEGERS = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
_DIGITS = {T.ByteType(): 3, T.ShortType(): 5, T.IntegerType(): 10, T.LongType(): 19}


def widens(have: T.DataType, want: T.DataType) -> bool:
    """Whether every value of one type is a value of the other."""
    if have == want or isinstance(have, T.NullType):
        return True
    if have in _INTEGERS and want in _INTEGERS:
        return _INTEGERS.index(have) <= _INTEGERS.index(want)
    if isinstance(want, T.DecimalType):
        whole = want.precision - want.scale
        if have in _INTEGERS:
            return _DIGITS[have] <= whole
        return isinstance(have, T.DecimalType) and have.precision - have.scale <= whole and have.scale <= want.scale
    if isinstance(want, T.DoubleType):
        return isinstance(have, (T.FloatType, T.ByteType, T.ShortType, T.IntegerType))
    if isinstance(want, T.TimestampType):
        return isinstance(have, (T.DateType, T.TimestampNTZType))
    return False


def _check_columns(actual: T.StructType, declared: T.StructType, what: str) -> None:
    have = {f.name: f.dataType for f in actual.fields}
    missing = [f.name for f in declared.fields if f.name not in have]
    if missing:
        raise SchemaDriftError(f"{what}: missing declared column(s) {missing}")
    drift = [f"{f.name} is {have[f.name].simpleString()}, declared {f.dataType.simpleString()}"
             for f in declared.fields if not widens(have[f.name], f.dataType)]
    if drift:
        raise SchemaDriftError(f"{what}: {'; '.join(drift)}")


def conform(df: DataFrame, declared: T.StructType, what: str = "source", keep: Sequence[str] = ()) -> DataFrame:
    """Select the declared columns in declared order, cast to the declared types.

    Fails when a declared column is absent or of a type whose values the declared one may not hold. Extra columns are dropped (column pruning
    then keeps them out of the scan), but for those in `keep`, which follow as they are.
    """
    _check_columns(df.schema, declared, what)
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in declared.fields] + [F.col(c) for c in keep])


def read_source(spark: SparkSession, path: str, declared: T.StructType, what: str = "source") -> DataFrame:
    """Read a Parquet source and conform it to its declared schema."""
    return conform(spark.read.parquet(path), declared, what)


def read_items_raw(spark: SparkSession, path: str) -> DataFrame:
    return read_source(spark, path, schemas.ITEMS_RAW, "items_raw")


def read_item_price_history_raw(spark: SparkSession, path: str) -> DataFrame:
    return read_source(spark, path, schemas.ITEM_PRICE_HISTORY_RAW, "item_price_history_raw")
