"""Session records as text: all columns as strings, or one comma-separated line each."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartsight.schema import KEY, SESSION_FIELDS


def text_of(name: str) -> Column:
    """The text of a field; booleans are spelled ``True`` and ``False``."""
    if isinstance(SESSION_FIELDS[name], T.BooleanType):
        return F.when(F.col(name), "True").when(~F.col(name), "False").alias(name)
    return F.col(name).cast("string").alias(name)


def session_texts(sessions: DataFrame) -> DataFrame:
    return sessions.select(KEY, *map(text_of, SESSION_FIELDS))


def session_lines(sessions: DataFrame) -> DataFrame:
    return sessions.select(KEY, F.concat_ws(",", *map(text_of, SESSION_FIELDS)).alias("value"))


def damaged_lines(sessions: DataFrame) -> DataFrame:
    """Lines of which some are broken, by browser code, to exercise the parsers.

    13: the last field is missing.  12: there is a field too many.  11: two
    numbers are garbage and one is blank.  10: the flags are in lower case.
    """
    browser = F.col("Browser")
    broken = {"BounceRates": "x", "OperatingSystems": "n/a", "Administrative": ""}
    texts = []
    for name in SESSION_FIELDS:
        text = text_of(name)
        if name in broken:
            text = F.when(browser == 11, broken[name]).otherwise(text)
        if name in ("Weekend", "Revenue"):
            text = F.when(browser == 10, F.lower(text)).otherwise(text)
        texts.append(text)
    texts[-1] = F.when(browser != 13, texts[-1])
    texts.append(F.when(browser == 12, "extra"))
    return sessions.select(KEY, F.concat_ws(",", *texts).alias("value"))
