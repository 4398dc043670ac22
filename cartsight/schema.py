"""The session record: one row per web session."""

from pyspark.sql import types as T

KEY = "session_id"
LABEL = "Revenue"

# Names, order and types of the fields of a session record.
SESSION_FIELDS = {
    "Administrative": T.IntegerType(),
    "Administrative_Duration": T.DoubleType(),
    "Informational": T.IntegerType(),
    "Informational_Duration": T.DoubleType(),
    "ProductRelated": T.IntegerType(),
    "ProductRelated_Duration": T.DoubleType(),
    "BounceRates": T.DoubleType(),
    "ExitRates": T.DoubleType(),
    "PageValues": T.DoubleType(),
    "SpecialDay": T.DoubleType(),
    "Month": T.StringType(),
    "OperatingSystems": T.IntegerType(),
    "Browser": T.IntegerType(),
    "Region": T.IntegerType(),
    "TrafficType": T.IntegerType(),
    "VisitorType": T.StringType(),
    "Weekend": T.BooleanType(),
    "Revenue": T.BooleanType(),
}

# Month names in calendar order as the records spell them.
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "June", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")

# Feature lists of the three models.
PAGE_GROUPS = ("Administrative", "Informational", "ProductRelated")
RATIOS = tuple(f"{group}_Duration_Per_Visit" for group in PAGE_GROUPS)
BATCH_COLUMNS = (
    LABEL, *RATIOS, "BounceRates", "ExitRates", "PageValues", "Is_Special_Date", "Month_Number",
    "OperatingSystems", "Region", "TrafficType", "Weekend", "VisitorType",
)
BATCH_NUMERIC = (*RATIOS, "BounceRates", "ExitRates", "PageValues", "Month_Number")
STREAM_NUMERIC = (RATIOS[0], RATIOS[2], "BounceRates", "ExitRates", "PageValues")
CATEGORICAL = ("VisitorType", "OperatingSystems", "Region", "TrafficType")
ONLINE_FEATURES = (
    *STREAM_NUMERIC, "OS_is_1", "OS_is_2", "OS_is_3", "Region_is_1", "Traffic_1_3", "Weekend_int",
)

SESSION_SCHEMA = T.StructType([T.StructField(n, t) for n, t in SESSION_FIELDS.items()])
KEYED_SCHEMA = T.StructType([T.StructField(KEY, T.LongType()), *SESSION_SCHEMA.fields])
