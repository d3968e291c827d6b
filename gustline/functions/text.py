"""Numbers and notification text as columns."""

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructType


def number_text(df_schema: StructType, name: str) -> Column:
    """A number as readers expect it: `0.0005` and `12000000.0`, not `5.0E-4` and `1.2E7`.

    Exponents stay only below 1e-4 and from 1e16 on, written like `5e-05`.
    """
    text = F.col(name).cast("string")
    if not isinstance(df_schema[name].dataType, (DoubleType, FloatType)):
        return text
    size = F.abs(F.col(name).cast("double"))
    power_text = F.split_part(text, F.lit("E"), F.lit(2))
    power = F.coalesce(power_text.try_cast("int"), F.lit(0))
    mantissa = F.regexp_replace(F.split_part(text, F.lit("E"), F.lit(1)), r"\.0$", "")
    # The point is moved in the digits as they are, so none is lost.
    sign = F.when(F.startswith(text, F.lit("-")), "-").otherwise("")
    digits = F.regexp_replace(mantissa, "[-.]", "")
    small = F.concat(sign, F.lit("0."), F.repeat(F.lit("0"), F.greatest(F.lit(0), -power - 1)), digits)
    filled = F.rpad(digits, F.greatest(F.length(digits), power + 1), "0")
    rest = F.coalesce(F.nullif(F.substr(filled, power + 2), F.lit("")), F.lit("0"))
    large = F.concat(sign, F.substr(filled, F.lit(1), power + 1), F.lit("."), rest)
    exponent_sign = F.when(power < 0, "-").otherwise("+")
    exponent_digits = F.lpad(F.abs(power).cast("string"), F.greatest(F.lit(2), F.length(F.abs(power).cast("string"))), "0")
    return (
        F.when(~F.contains(text, F.lit("E")), text)
        .when((size >= 1e-4) & (size < 1), small)
        .when((size >= 1) & (size < 1e16), large)
        .otherwise(F.concat(mantissa, F.lit("e"), exponent_sign, exponent_digits))
    )
