from cartsight.functions.keys import bucket, content_key, key_hash
from cartsight.functions.labels import (
    indicator, month_number, operating_system_label, region_label, special_date, text_flag,
    traffic_label,
)
from cartsight.functions.parsing import (
    FLOAT_TEXT, INTEGER_TEXT, double_or_default, int_or_default, lenient_double, lenient_int,
    line_fields, line_parts,
)
from cartsight.functions.ratios import duration_per_visit, lenient_duration_per_visit
from cartsight.functions.scores import logistic

__all__ = [
    "FLOAT_TEXT", "INTEGER_TEXT", "bucket", "content_key", "double_or_default",
    "duration_per_visit", "indicator", "int_or_default", "key_hash", "lenient_double",
    "lenient_duration_per_visit", "lenient_int", "line_fields", "line_parts", "logistic", "month_number",
    "operating_system_label", "region_label", "special_date", "text_flag", "traffic_label",
]
