"""Feature tables, each one projection over the session records: no shuffle, no Python workers."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartsight import functions as fn
from cartsight.operators.quality import fill_null_ratios
from cartsight.schema import BATCH_COLUMNS, KEY, LABEL, ONLINE_FEATURES, PAGE_GROUPS, RATIOS, SESSION_FIELDS


def _carried(df: DataFrame, keys: tuple[str, ...]) -> list[str]:
    return [k for k in keys if k in df.columns]


def category_labels(sessions: DataFrame) -> dict[str, Column]:
    return {
        "OperatingSystems": fn.operating_system_label(F.col("OperatingSystems")),
        "Region": fn.region_label(F.col("Region")),
        "TrafficType": fn.traffic_label(F.col("TrafficType")),
    }


def label_categories(sessions: DataFrame) -> DataFrame:
    """Replace the three category codes by their labels."""
    return sessions.withColumns(category_labels(sessions))


def batch_features(sessions: DataFrame, keys: tuple[str, ...] = (KEY, "slice")) -> DataFrame:
    """The modelling columns from typed records; a ratio without visits is null.

    Key columns that the input has are carried along.
    """
    derived = {
        **{
            ratio: fn.duration_per_visit(F.col(group), F.col(f"{group}_Duration"))
            for ratio, group in zip(RATIOS, PAGE_GROUPS)
        },
        **category_labels(sessions),
        "Is_Special_Date": fn.special_date(F.col("SpecialDay")),
        "Month_Number": fn.month_number(F.col("Month")),
    }
    return sessions.withColumns(derived).select(*_carried(sessions, keys), *BATCH_COLUMNS)


def flags_to_int(features: DataFrame) -> DataFrame:
    flags = ("Weekend", "Is_Special_Date", LABEL)
    return features.withColumns({c: F.col(c).cast("int") for c in flags})


def model_features(sessions: DataFrame, keys: tuple[str, ...] = (KEY, "slice")) -> DataFrame:
    """Batch features ready for training: ratios filled with 0, flags as 0/1."""
    return flags_to_int(fill_null_ratios(batch_features(sessions, keys)))


def parse_lines(lines: DataFrame, keys: tuple[str, ...] = (KEY,), complete_only: bool = True) -> DataFrame:
    """The 18 texts of each line.  Lines with too few fields are dropped unless told otherwise.

    Each line unfolds into one record, or none.  Filters on the fields stop at the
    unfolding; below it they would split the line again for every condition.
    """
    carried = _carried(lines, keys)
    parts = lines.select(*carried, fn.line_parts(F.col("value")).alias("parts"))
    record = F.array(F.struct(*fn.line_fields(F.col("parts")).values()))
    if complete_only:
        record = F.when(_is_complete(F.col("parts")), record)
    return parts.select(*carried, F.inline(record))


def _is_complete(parts: Column) -> Column:
    return F.size(parts) >= len(SESSION_FIELDS)


def drop_short_lines(lines: DataFrame) -> DataFrame:
    return lines.where(_is_complete(fn.line_parts(F.col("value"))))


def typed_fields(texts: DataFrame, keys: tuple[str, ...] = (KEY,)) -> DataFrame:
    """Numbers parsed, null where the text is not one; names and flags stay text."""
    parsers = {"int": fn.lenient_int, "double": fn.lenient_double}
    columns = []
    for name, dtype in SESSION_FIELDS.items():
        parse = parsers.get(dtype.simpleString(), lambda text: text)
        columns.append(parse(F.col(name)).alias(name))
    return texts.select(*_carried(texts, keys), *columns)


def stream_features(texts: DataFrame, keys: tuple[str, ...] = (KEY,)) -> DataFrame:
    """The 11 columns of the micro-batch tree from text fields; never fails on bad input."""
    number = {n: fn.lenient_double(F.col(n)) for n in SESSION_FIELDS}
    code = {n: fn.lenient_int(F.col(n)) for n in SESSION_FIELDS}
    ratio = {
        group: fn.lenient_duration_per_visit(number[group], number[f"{group}_Duration"])
        for group in PAGE_GROUPS
    }
    return texts.select(
        *_carried(texts, keys),
        fn.text_flag(F.col(LABEL)).alias(LABEL),
        ratio["Administrative"].alias(RATIOS[0]),
        ratio["ProductRelated"].alias(RATIOS[2]),
        *(number[n].alias(n) for n in ("BounceRates", "ExitRates", "PageValues")),
        fn.operating_system_label(code["OperatingSystems"]).alias("OperatingSystems"),
        fn.region_label(code["Region"]).alias("Region"),
        fn.traffic_label(code["TrafficType"]).alias("TrafficType"),
        fn.text_flag(F.col("Weekend")).alias("Weekend"),
        "VisitorType",
    )


def parsed_with_defaults(texts: DataFrame, keys: tuple[str, ...] = (KEY,)) -> DataFrame:
    """The numeric fields of the online path, 0 where the text is not a number."""
    doubles = (
        "Administrative", "Administrative_Duration", "ProductRelated", "ProductRelated_Duration",
        "BounceRates", "ExitRates", "PageValues",
    )
    codes = ("OperatingSystems", "Region", "TrafficType")
    return texts.select(
        *_carried(texts, keys),
        *(fn.double_or_default(F.col(n)).alias(n) for n in doubles),
        *(fn.int_or_default(F.col(n)).alias(n) for n in codes),
        *(F.col(n) for n in ("Weekend", LABEL)),
    )


def online_features(texts: DataFrame, keys: tuple[str, ...] = (KEY,)) -> DataFrame:
    """Label and the 11 doubles of the online model, one column each, in vector order."""
    n = parsed_with_defaults(texts, keys)
    values = [
        *(
            fn.lenient_duration_per_visit(F.col(g), F.col(f"{g}_Duration"), "double")
            for g in ("Administrative", "ProductRelated")
        ),
        F.col("BounceRates"), F.col("ExitRates"), F.col("PageValues"),
        *(fn.indicator(F.col("OperatingSystems") == code) for code in (1, 2, 3)),
        fn.indicator(F.col("Region") == 1),
        fn.indicator(F.col("TrafficType").between(1, 3)),
        fn.indicator(F.col("Weekend") == "True"),
    ]
    return n.select(
        *_carried(texts, keys),
        fn.text_flag(F.col(LABEL)).cast("double").alias("label"),
        *(value.alias(name) for name, value in zip(ONLINE_FEATURES, values)),
    )
