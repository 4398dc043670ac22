"""Category labels, flags and the month number.  All are total on null."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from cartsight.schema import MONTHS

# Category labels and the text of a set flag.
OS_OTHER = "OS_Other"
REGION_LABEL = "Region_1"
REGION_OTHER = "Region_Other"
TRAFFIC_LABEL = "TrafficType_1_3"
TRAFFIC_OTHER = "TrafficType_Other"
FLAG_SET = "True"


def operating_system_label(code: Column) -> Column:
    return F.when(code == 1, "OS_1").when(code == 2, "OS_2").when(code == 3, "OS_3").otherwise(OS_OTHER)


def region_label(code: Column) -> Column:
    return F.when(code == 1, REGION_LABEL).otherwise(REGION_OTHER)


def traffic_label(code: Column) -> Column:
    return F.when(code.between(1, 3), TRAFFIC_LABEL).otherwise(TRAFFIC_OTHER)


def special_date(closeness: Column) -> Column:
    return closeness > 0


def month_number(name: Column, strict: bool = False) -> Column:
    """1..12; an unknown name is null, or an error when ``strict``."""
    position = F.array_position(F.array(*map(F.lit, MONTHS)), name)
    number = F.nullif(position, F.lit(0)).cast("int")
    if not strict:
        return number
    complaint = F.concat(F.lit("unknown month: "), F.coalesce(name, F.lit("null")))
    return F.coalesce(number, F.raise_error(complaint).cast("int"))


def text_flag(text: Column) -> Column:
    """1 for the text ``True``, 0 for anything else."""
    return F.when(text == FLAG_SET, 1).otherwise(0)


def indicator(condition: Column) -> Column:
    """1.0 or 0.0; a null condition counts as not met."""
    return F.when(condition, 1.0).otherwise(0.0)
