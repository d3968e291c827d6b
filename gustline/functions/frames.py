"""The five-byte frame in front of a registered value: a zero byte and the schema id."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# One magic byte, then a big-endian four-byte schema id.
MAGIC = "00"
FRAME_BYTES = 5


def add_frame(body: str | Column, schema_id: int) -> Column:
    head = F.unhex(F.lit(MAGIC + format(schema_id, "08X")))
    return F.concat(head, F.col(body) if isinstance(body, str) else body)


def strip_frame(value: str | Column = "value") -> Column:
    """The body after the frame; empty when the value is shorter than a frame."""
    return F.substring(value, FRAME_BYTES + 1, 2**31 - 1)


def frame_schema_id(value: str | Column = "value") -> Column:
    """Schema id of a well framed value, null for another magic byte or a short value."""
    framed = (F.hex(F.substring(value, 1, 1)) == MAGIC) & (F.octet_length(value) >= FRAME_BYTES)
    return F.when(framed, F.conv(F.hex(F.substring(value, 2, 4)), 16, 10).cast("bigint"))
