from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructType


def complete_case(schema: StructType) -> Column:
    """True where no field of `schema` is null or NaN.

    The rows kept are those of `DataFrame.na.drop()`, but each null test stands alone, so Spark can
    hand it to the parquet reader; `na.drop` counts non-nulls in one expression that stays in Spark.
    """
    present = [F.col(f.name).isNotNull() for f in schema]
    numbers = [~F.isnan(f.name) for f in schema if isinstance(f.dataType, (FloatType, DoubleType))]
    return reduce(and_, present + numbers, F.lit(True))


def ratio(top: Column, bottom: Column, otherwise: float = 0.0) -> Column:
    """`top / bottom`, or `otherwise` where `bottom` is zero."""
    return F.when(bottom == 0, F.lit(otherwise)).otherwise(top / bottom)


def or_fail(value: Column, message: str) -> Column:
    """`value`, failing the job with `message` on the first null."""
    return F.coalesce(value, F.raise_error(F.lit(message)).cast("double"))
