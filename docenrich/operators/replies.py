"""Replies and requests as tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docenrich.functions.replies import OBJECT, reply_kind


def parse_reply(df: DataFrame, body_col: str = "body") -> DataFrame:
    """Adds ``reply_kind, type, jurisdiction``; both values NULL unless an object."""
    # the body is judged once, and read once more if it is an object
    judged = df.withColumn("reply_kind", reply_kind(F.col(body_col)))
    is_object = F.col("reply_kind") == OBJECT
    values = F.from_json(body_col, "type string, jurisdiction string")
    return judged.withColumns(
        {name: F.when(is_object, values.getField(name)) for name in ("type", "jurisdiction")}
    )
