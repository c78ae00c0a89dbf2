"""Visit-log sources: a parquet/Hive table, or the generator's delimited text.

The production layout is a table partitioned by ``datestr``, so the date range
becomes partition pruning; every reader returns the VISIT_ACTION schema.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.functions.dates import parse_time
from visitlens.schema import VISIT_ACTION, VISIT_ACTION_TEXT, VISIT_COLUMNS, VISIT_TEXT_NULL, VISIT_TEXT_SEPARATOR

NULL_TEXT = VISIT_TEXT_NULL
FIELD_SEP = VISIT_TEXT_SEPARATOR


def conform(df: DataFrame, lenient_times: bool = False) -> DataFrame:
    """Cast a visit log whose columns carry the VISIT_ACTION names to its types.

    Columns already of the right type pass through untouched, so filters on
    them (``datestr`` partition pruning, ``session_id`` semi joins) still
    reach the scan.  Text ids that are not numbers become NULL
    (``try_cast``); time text is parsed with an unpadded-hour pattern, with
    ``lenient_times`` as the reference reads it (``functions.dates.parse_time``).
    """
    missing = [c for c in VISIT_COLUMNS if c not in df.columns]
    if missing:
        raise ValueError(f"visit log lacks columns {missing}")
    cols = []
    for field in VISIT_ACTION.fields:
        c = F.col(field.name)
        src = df.schema[field.name].dataType
        if src != field.dataType:
            c = parse_time(c, lenient_times) if field.name == "action_time" and src.simpleString() == "string" else c.try_cast(
                field.dataType
            )
        cols.append(c.alias(field.name))
    return df.select(*cols)


def read_visit_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A columnar visit-log table (optionally partitioned by ``datestr``)."""
    return conform(spark.read.format(fmt).load(path))


def read_hive_visits(spark: SparkSession, table: str = "user_visit_action") -> DataFrame:
    return conform(spark.table(table))


def read_visit_text(spark: SparkSession, path: str, lenient_times: bool = False) -> DataFrame:
    """``\\001``-separated text, 12 fields per line, the text ``null`` = missing
    (the CSV reader turns it into NULL; non-numeric id text becomes NULL).  Lines with
    another number of fields are filled up or cut; ``checked_visits`` reports them."""
    raw = (
        spark.read.schema(VISIT_ACTION_TEXT)
        .option("sep", FIELD_SEP)
        .option("nullValue", NULL_TEXT)
        .option("quote", "")  # the format has no quotes; a leading " is data
        .option("mode", "PERMISSIVE")
        .csv(path)
    )
    return conform(raw, lenient_times)


REASON, LINE, N_FIELDS = "reason", "line", "n_fields"
_NUMBERS = [f.name for f in VISIT_ACTION.fields if f.dataType.simpleString() == "bigint"]


def read_visit_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of the text format, unparsed (one column, ``value``)."""
    return spark.read.option("lineSep", "\n").text(path)


def _split_lines(lines: DataFrame, lenient_times: bool, strict_values: bool) -> DataFrame:
    """The 12 text fields of every line, the line, its number of fields and why it is rejected."""
    line = F.regexp_replace("value", "\r$", "")
    parts = F.split(line, FIELD_SEP, -1)
    split = lines.where(F.length(line) > 0).select(line.alias(LINE), parts.alias("_parts"))
    split = split.withColumn(N_FIELDS, F.size("_parts"))
    whole = F.col(N_FIELDS) == len(VISIT_COLUMNS)
    fields = {}
    for place, name in enumerate(VISIT_COLUMNS):
        text = F.get("_parts", F.lit(place))
        fields[name] = F.when(whole & ~text.isin("", NULL_TEXT), text)
    split = split.withColumns(fields)
    reasons = [F.when(~whole, F.lit("field count"))]
    if strict_values:
        for name in _NUMBERS:
            reasons.append(F.when(F.col(name).isNotNull() & F.col(name).try_cast("bigint").isNull(), F.lit(name)))
        time = F.col("action_time")
        reasons.append(F.when(time.isNotNull() & parse_time(time, lenient_times).isNull(), F.lit("action_time")))
    return split.withColumn(REASON, F.coalesce(*reasons)).drop("_parts")


def checked_visits(
    lines: DataFrame, lenient_times: bool = False, strict_values: bool = False
) -> tuple[DataFrame, DataFrame]:
    """``(visits, rejects)`` of the text format's lines, batch or streaming.

    A line with more or fewer than 12 fields is rejected ("field count"); with
    ``strict_values`` so is one whose ids or action time are given but cannot be read (the
    first such column is the reason), which otherwise become NULL.  Rejects hold reason,
    n_fields and the line itself.  Every line that is not empty is in exactly one of the two.
    """
    split = _split_lines(lines, lenient_times, strict_values)
    good = split.where(F.col(REASON).isNull()).select(*VISIT_COLUMNS)
    return conform(good, lenient_times), split.where(F.col(REASON).isNotNull()).select(REASON, N_FIELDS, LINE)


def reject_counts(rejects: DataFrame) -> DataFrame:
    """``reason, n_fields, n_lines``, the report of a reject channel."""
    return rejects.groupBy(REASON, N_FIELDS).agg(F.count(F.lit(1)).alias("n_lines"))

