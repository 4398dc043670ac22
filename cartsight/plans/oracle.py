"""The same results in plain SQL, for a second engine to check the registered queries."""

from itertools import product

from cartsight.operators.nodes import BANDS, FEW_VALUED, PAGES
from cartsight.plans.queries import SCORE_WEIGHTS, SIDE, STUMP_GRID
from cartsight.schema import (
    BATCH_COLUMNS, BATCH_NUMERIC, CATEGORICAL, KEY, LABEL, MONTHS, ONLINE_FEATURES, PAGE_GROUPS,
    RATIOS, SESSION_FIELDS,
)

ORACLES: dict[str, str] = {}


def _list(items) -> str:
    return ", ".join(items)


def _quoted(names, prefix: str = "") -> str:
    return _list(f'{prefix}"{n}"' for n in names)


# Session records

_GROUPS = dict(zip(PAGE_GROUPS, "ANR"))
_MONTH_LIST = _list(f"'{m}'" for m in MONTHS)

_VISITS = f"""visits AS (
  SELECT l_orderkey, count(*) AS n,
    {_list(f'''count(*) FILTER (WHERE l_returnflag = '{f}') AS "{g}",
    coalesce(sum(l_quantity) FILTER (WHERE l_returnflag = '{f}'), 0) AS "{g}_Duration"'''
           for g, f in _GROUPS.items())},
    CAST(sum(CAST(round(l_discount * 100) AS BIGINT)) AS DOUBLE) AS discount,
    CAST(sum(CAST(round(l_tax * 100) AS BIGINT)) AS DOUBLE) AS tax,
    coalesce(sum(l_quantity) FILTER (WHERE l_linestatus = 'F'), 0) AS filled
  FROM lineitem GROUP BY l_orderkey)"""

_SESSIONS = f"""sessions AS (
  SELECT o_orderkey AS session_id,
    {_list(f'CAST("{g}" AS INTEGER) AS "{g}", CAST("{g}_Duration" AS DOUBLE) AS "{g}_Duration"'
           for g in PAGE_GROUPS)},
    discount / (100 * n) AS "BounceRates", tax / (100 * n) AS "ExitRates",
    filled / n AS "PageValues",
    CAST(day(o_orderdate) % 6 AS DOUBLE) / 5 AS "SpecialDay",
    ([{_MONTH_LIST}])[month(o_orderdate)] AS "Month",
    CAST(o_custkey % 8 + 1 AS INTEGER) AS "OperatingSystems",
    CAST(o_orderkey % 13 + 1 AS INTEGER) AS "Browser",
    CAST(c_nationkey % 9 + 1 AS INTEGER) AS "Region",
    CAST((o_orderkey + o_custkey) % 20 + 1 AS INTEGER) AS "TrafficType",
    CASE o_orderpriority WHEN '1-URGENT' THEN 'New_Visitor' WHEN '5-LOW' THEN 'Other'
      ELSE 'Returning_Visitor' END AS "VisitorType",
    dayofweek(o_orderdate) IN (0, 6) AS "Weekend",
    o_totalprice > 400000 - 4000 * (filled / n) AS "Revenue"
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN visits ON o_orderkey = l_orderkey)"""

# Keys and splits

_HASH = "((session_id{}) * 2654435761 % 4294967296)"
_TRAIN = f"{_HASH.format('')} % 100 < 80"
_FOLD = f"CAST({_HASH.format('')} // 100 % 5 AS INTEGER)"

_HALVES = f"""halves AS (
  SELECT *, CASE WHEN row_number() OVER (ORDER BY {_HASH.format(' + 1')}, session_id)
    <= count(*) OVER () // 2 THEN 1 ELSE 2 END AS slice FROM sessions)"""

# Batch features


def _float_ratio(group: str) -> str:
    return f'CAST(CASE WHEN "{group}" <> 0 THEN "{group}_Duration" / "{group}" END AS FLOAT)'


def _label_sql(os: str, region: str, traffic: str) -> dict[str, str]:
    return {
        "OperatingSystems": f"CASE {os} WHEN 1 THEN 'OS_1' WHEN 2 THEN 'OS_2' WHEN 3 THEN 'OS_3' ELSE 'OS_Other' END",
        "Region": f"CASE WHEN {region} = 1 THEN 'Region_1' ELSE 'Region_Other' END",
        "TrafficType": f"CASE WHEN {traffic} BETWEEN 1 AND 3 THEN 'TrafficType_1_3' ELSE 'TrafficType_Other' END",
    }


_LABELS = _label_sql('"OperatingSystems"', '"Region"', '"TrafficType"')


def _month_sql(text: str) -> str:
    return f"CAST(nullif(coalesce(list_position([{_MONTH_LIST}], {text}), 0), 0) AS INTEGER)"


_DERIVED = {
    **{r: _float_ratio(g) for r, g in zip(RATIOS, PAGE_GROUPS)},
    **_LABELS,
    "Is_Special_Date": '"SpecialDay" > 0',
    "Month_Number": _month_sql('"Month"'),
}


def _features(source: str, name: str = "features", extra: str = "") -> str:
    columns = _list(
        f'{_DERIVED[c]} AS "{c}"' if c in _DERIVED else f'"{c}"' for c in BATCH_COLUMNS
    )
    return f"{name} AS (SELECT session_id{extra}, {columns} FROM {source})"


def _model(source: str = "features", extra: str = "") -> str:
    flags = ("Weekend", "Is_Special_Date", LABEL)
    columns = []
    for c in BATCH_COLUMNS:
        if c in RATIOS:
            columns.append(f'coalesce("{c}", CAST(0 AS FLOAT)) AS "{c}"')
        elif c in flags:
            columns.append(f'CAST("{c}" AS INTEGER) AS "{c}"')
        else:
            columns.append(f'"{c}"')
    return f"model AS (SELECT session_id{extra}, {_list(columns)} FROM {source})"


_FRACTIONS = {*RATIOS, "BounceRates", "ExitRates", "PageValues"}


def _rounded(names) -> str:
    return _list(
        f'round(CAST("{c}" AS DOUBLE), 6) AS "{c}"' if c in _FRACTIONS else f'"{c}"' for c in names
    )


# Lines

_TEXT = {
    n: f'''CASE WHEN "{n}" THEN 'True' ELSE 'False' END''' if n in ("Weekend", LABEL) else f'CAST("{n}" AS VARCHAR)'
    for n in SESSION_FIELDS
}
_TEXTS = "texts AS (SELECT session_id, {} FROM sessions)".format(
    _list(f'{text} AS "{name}"' for name, text in _TEXT.items())
)
_LINES = f"lines AS (SELECT session_id, concat_ws(',', {_list(_TEXT.values())}) AS value FROM sessions)"


def _damaged_text(name: str) -> str:
    text = _TEXT[name]
    broken = {"BounceRates": "x", "OperatingSystems": "n/a", "Administrative": ""}
    if name in broken:
        return f"""CASE WHEN "Browser" = 11 THEN '{broken[name]}' ELSE {text} END"""
    if name in ("Weekend", LABEL):
        text = f'CASE WHEN "Browser" = 10 THEN lower({text}) ELSE {text} END'
    return f'CASE WHEN "Browser" <> 13 THEN {text} END' if name == LABEL else text


_DAMAGED = f"""lines AS (
  SELECT session_id, concat_ws(',', {_list(map(_damaged_text, SESSION_FIELDS))},
    CASE WHEN "Browser" = 12 THEN 'extra' END) AS value FROM sessions)"""

_ALL_FIELDS = "fields AS (SELECT session_id, {} FROM lines)".format(
    _list(f"string_split(value, ',')[{i}] AS \"{n}\"" for i, n in enumerate(SESSION_FIELDS, 1))
)
_COMPLETE_FIELDS = _ALL_FIELDS.replace("FROM lines", "FROM lines WHERE len(string_split(value, ',')) >= 18")


def _typed(name: str) -> str:
    kind = SESSION_FIELDS[name].simpleString()
    if kind in ("int", "double"):
        return f'TRY_CAST("{name}" AS {"INTEGER" if kind == "int" else "DOUBLE"}) AS "{name}"'
    return f'"{name}"'


_TYPED = _list(map(_typed, SESSION_FIELDS))
_TYPED_DOUBLES = _list(
    f'CAST(TRY_CAST("{n}" AS INTEGER) AS DOUBLE) AS "{n}"' if t.simpleString() == "int" else _typed(n)
    for n, t in SESSION_FIELDS.items()
)


def _number(name: str) -> str:
    return f'TRY_CAST("{name}" AS DOUBLE)'


def _lenient_ratio(v: str, d: str, kind: str) -> str:
    return f"CAST(CASE WHEN {v} IS NULL OR {d} IS NULL OR {v} = 0 THEN 0 ELSE {d} / {v} END AS {kind})"


_FLAG = "CASE WHEN \"{0}\" = 'True' THEN 1 ELSE 0 END"
_STREAM_LABELS = _label_sql(*(f'TRY_CAST("{n}" AS INTEGER)' for n in ("OperatingSystems", "Region", "TrafficType")))
_STREAM = "stream AS (SELECT session_id, {} FROM fields)".format(_list([
    f'{_FLAG.format(LABEL)} AS "{LABEL}"',
    *(f'{_lenient_ratio(_number(g), _number(g + "_Duration"), "FLOAT")} AS "{g}_Duration_Per_Visit"'
      for g in ("Administrative", "ProductRelated")),
    *(f'{_number(n)} AS "{n}"' for n in ("BounceRates", "ExitRates", "PageValues")),
    *(f'{sql} AS "{n}"' for n, sql in _STREAM_LABELS.items()),
    f'{_FLAG.format("Weekend")} AS "Weekend"', '"VisitorType"',
]))
_STREAM_COLUMNS = (
    LABEL, RATIOS[0], RATIOS[2], "BounceRates", "ExitRates", "PageValues",
    "OperatingSystems", "Region", "TrafficType", "Weekend", "VisitorType",
)

_DEFAULT_DOUBLES = (
    "Administrative", "Administrative_Duration", "ProductRelated", "ProductRelated_Duration",
    "BounceRates", "ExitRates", "PageValues",
)
_DEFAULTS = "defaults AS (SELECT session_id, {}, \"Weekend\", \"Revenue\" FROM fields)".format(_list([
    *(f'coalesce({_number(n)}, 0) AS "{n}"' for n in _DEFAULT_DOUBLES),
    *(f'coalesce(TRY_CAST("{n}" AS BIGINT), 0) AS "{n}"' for n in ("OperatingSystems", "Region", "TrafficType")),
]))

_ONLINE_SQL = [
    *(_lenient_ratio(f'"{g}"', f'"{g}_Duration"', "DOUBLE") for g in ("Administrative", "ProductRelated")),
    '"BounceRates"', '"ExitRates"', '"PageValues"',
    *(f'CAST("OperatingSystems" = {i} AS INTEGER)::DOUBLE' for i in (1, 2, 3)),
    'CAST("Region" = 1 AS INTEGER)::DOUBLE',
    'CAST("TrafficType" BETWEEN 1 AND 3 AS INTEGER)::DOUBLE',
    _FLAG.format("Weekend") + "::DOUBLE",
]
_ONLINE = "online AS (SELECT session_id, CAST({} AS DOUBLE) AS label, {} FROM defaults)".format(
    _FLAG.format(LABEL), _list(f'CAST({sql} AS DOUBLE) AS "{n}"' for n, sql in zip(ONLINE_FEATURES, _ONLINE_SQL))
)

# Scores

_MARGIN = " + ".join(f'"{x}" * ({w})' for x, w in zip(ONLINE_FEATURES, SCORE_WEIGHTS))
_SCORED = f"""scored AS (
  SELECT session_id, score, CAST(label AS INTEGER) AS label,
    CASE WHEN score > 0.5 THEN 1 ELSE 0 END AS prediction
  FROM (SELECT session_id, label, round(1 / (1 + exp(-({_MARGIN}))), 2) AS score FROM online))"""


def _with(*tables: str) -> str:
    return "WITH " + ",\n".join(tables) + "\n"


_S = (_VISITS, _SESSIONS)
_F = (*_S, _features("sessions"))
_M = (*_F, _model())
_BROKEN = (*_S, _DAMAGED, _COMPLETE_FIELDS)
_BROKEN_ALL = (*_S, _DAMAGED, _ALL_FIELDS)
_O = (*_S, _LINES, _COMPLETE_FIELDS, _DEFAULTS, _ONLINE)
_Q = (*_O, _SCORED)
_H = (*_S, _HALVES)

_SESSION_COLUMNS = f"session_id, {_quoted(SESSION_FIELDS)}"

# Sources, preparation

ORACLES["scan_csv_sessions"] = _with(*_S) + f"SELECT {_SESSION_COLUMNS} FROM sessions"
ORACLES["union_slices"] = ORACLES["scan_csv_sessions"]
ORACLES["write_slices_csv"] = _with(*_H) + f"SELECT {_SESSION_COLUMNS}, slice FROM halves"
ORACLES["preview_top_rows"] = (
    _with(*_Q) + "SELECT session_id, label, prediction, score FROM scored ORDER BY session_id LIMIT 20"
)
ORACLES["join_features_target"] = ORACLES["scan_csv_sessions"]
ORACLES["split_exact_halves"] = _with(*_H) + "SELECT session_id, slice FROM halves"
ORACLES["split_train_test"] = _with(*_M) + f"""SELECT session_id, "Revenue",
  CASE WHEN {_TRAIN} THEN 'train' ELSE 'test' END AS part FROM model"""
ORACLES["cap_rows"] = _with(*_M) + f"""SELECT session_id, {_rounded(BATCH_COLUMNS)} FROM model
  ORDER BY {_HASH.format('')}, session_id LIMIT 200"""
ORACLES["cv_folds"] = _with(*_M) + f"""SELECT {_FOLD} AS fold, "Revenue", count(*) AS count
  FROM model WHERE {_TRAIN} GROUP BY ALL"""

# Projections, predicates, scalar functions

_INT_FLAGS = ("Weekend", "Is_Special_Date", LABEL)
ORACLES["features_batch"] = _with(*_F) + "SELECT session_id, {} FROM features".format(_list(
    f'CAST("{c}" AS INTEGER) AS "{c}"' if c in _INT_FLAGS else _rounded([c]) for c in BATCH_COLUMNS
))
ORACLES["features_stream_static"] = _with(*_BROKEN, _STREAM) + f"SELECT session_id, {_rounded(_STREAM_COLUMNS)} FROM stream"
ORACLES["features_online"] = _with(*_BROKEN, _DEFAULTS, _ONLINE) + "SELECT session_id, label, {} FROM online".format(
    _list(f'round("{c}", 6) AS "{c}"' for c in ONLINE_FEATURES)
)
ORACLES["parse_csv_lines"] = _with(*_BROKEN_ALL) + f"SELECT session_id, {_TYPED_DOUBLES} FROM fields"
ORACLES["stream_parse_sessions"] = _with(*_S, _LINES, _COMPLETE_FIELDS) + f"SELECT {_TYPED} FROM fields"
ORACLES["parse_numeric_default"] = _with(*_BROKEN_ALL, _DEFAULTS) + "SELECT * FROM defaults"
ORACLES["filter_malformed_lines"] = (
    _with(*_S, _DAMAGED) + "SELECT session_id, value FROM lines WHERE len(string_split(value, ',')) >= 18"
)
ORACLES["label_categories"] = _with(*_F) + f"SELECT session_id, {_quoted(CATEGORICAL)} FROM features"
ORACLES["month_number"] = _with(*_S) + f"""SELECT session_id, "Month", {_month_sql('"Month"')} AS "Month_Number",
  CAST({_month_sql('"Month"[1:3]')} AS DOUBLE) AS "Short_Name_Number" FROM sessions"""
_ANY_NULL = " OR ".join(f'"{c}" IS NULL' for c in BATCH_COLUMNS)
ORACLES["rows_with_nulls"] = _with(*_F) + f"SELECT session_id, {_rounded(BATCH_COLUMNS)} FROM features WHERE {_ANY_NULL}"
ORACLES["drop_null_rows"] = _with(*_BROKEN_ALL, _STREAM) + "SELECT session_id, {} FROM stream WHERE {}".format(
    _rounded(_STREAM_COLUMNS), " AND ".join(f'"{c}" IS NOT NULL' for c in _STREAM_COLUMNS)
)
ORACLES["fill_null_ratios"] = _with(*_M) + f"SELECT session_id, {_rounded(RATIOS)} FROM model"

# Aggregates

ORACLES["class_distribution"] = _with(*_M) + f'SELECT "Revenue", count(*) AS count FROM model WHERE {_TRAIN} GROUP BY ALL'
ORACLES["conversion_by_visitor"] = _with(*_M) + 'SELECT "VisitorType", "Revenue", count(*) AS count FROM model GROUP BY ALL'
ORACLES["split_counts"] = _with(*_F) + f"""SELECT count(*) AS n_rows,
  count(*) FILTER (WHERE {_ANY_NULL}) AS n_null_rows,
  count(*) FILTER (WHERE {_TRAIN}) AS n_train, count(*) FILTER (WHERE NOT {_TRAIN}) AS n_test FROM features"""
_COUNTED = (KEY, *BATCH_COLUMNS)
ORACLES["null_counts"] = _with(*_F) + "SELECT {} FROM features".format(
    _list(f'count(*) FILTER (WHERE "{c}" IS NULL) AS "{c}"' for c in _COUNTED)
)
ORACLES["null_columns"] = _with(*_F) + "SELECT * FROM ({}) WHERE null_count > 0".format(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE \"{c}\" IS NULL) AS null_count FROM features"
    for c in _COUNTED
))


def _profile(name: str) -> str:
    whole = r"'^\s*[+-]?[0-9]+\s*$'"
    number = r"'^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$'"
    return f"""SELECT '{name}' AS column_name,
      CASE WHEN n_integer > n_rows * 0.8 THEN 'integer' WHEN n_float > n_rows * 0.8 THEN 'float' ELSE 'string' END AS main_type,
      n_rows, n_integer, n_float, n_rows - n_integer - n_float - n_empty AS n_string, n_empty,
      shown AS sample_values
    FROM (SELECT count(*) AS n_rows, count(*) FILTER (WHERE regexp_matches(v, {whole})) AS n_integer,
        count(*) FILTER (WHERE regexp_matches(v, {number}) AND NOT regexp_matches(v, {whole})) AS n_float,
        count(*) FILTER (WHERE v = '') AS n_empty
      FROM (SELECT "{name}" AS v FROM texts)),
      (SELECT string_agg(v, ', ' ORDER BY session_id) AS shown
       FROM (SELECT session_id, "{name}" AS v FROM texts ORDER BY session_id LIMIT 3))"""


ORACLES["profile_columns"] = _with(*_S, _TEXTS) + " UNION ALL ".join(map(_profile, SESSION_FIELDS))
ORACLES["slice_class_distribution"] = (
    _with(*_H) + 'SELECT slice, CAST("Revenue" AS INTEGER) AS "Revenue", count(*) AS count FROM halves GROUP BY ALL'
)

# Fitted transformers

_INDEXES = tuple(
    f"""idx_{c} AS (SELECT "{c}" AS v, CAST(row_number() OVER (ORDER BY count(*) DESC, "{c}") - 1 AS INTEGER) AS i
    FROM model WHERE {_TRAIN} GROUP BY "{c}")""" for c in CATEGORICAL
)
ORACLES["string_index"] = _with(*_M, *_INDEXES) + "SELECT session_id, {}, {} FROM model {}".format(
    _quoted(CATEGORICAL), _list(f'idx_{c}.i AS "{c}_index"' for c in CATEGORICAL),
    " ".join(f'JOIN idx_{c} ON model."{c}" = idx_{c}.v' for c in CATEGORICAL),
)

# The labels that occur in each category.
_KNOWN = {
    "VisitorType": ("New_Visitor", "Other", "Returning_Visitor"),
    "OperatingSystems": ("OS_1", "OS_2", "OS_3", "OS_Other"),
    "Region": ("Region_1", "Region_Other"),
    "TrafficType": ("TrafficType_1_3", "TrafficType_Other"),
}


def _slots(kind: str) -> str:
    return _list(
        f"CAST(\"{c}\" = '{label}' AS INTEGER)::{kind} AS \"{c}_{label}\""
        for c, labels in _KNOWN.items() for label in labels
    )


_MOMENTS = "moments AS (SELECT {} FROM model WHERE {})".format(
    _list(f'avg(CAST("{c}" AS DOUBLE)) AS "m_{c}", stddev_samp(CAST("{c}" AS DOUBLE)) AS "s_{c}"'
          for c in BATCH_NUMERIC), _TRAIN
)
_SCALED = _list(f'round((CAST("{c}" AS DOUBLE) - "m_{c}") / "s_{c}", 6) AS "{c}"' for c in BATCH_NUMERIC)
ORACLES["one_hot"] = _with(*_M) + f"SELECT session_id, {_slots('INTEGER')} FROM model"
ORACLES["standardize"] = _with(*_M, _MOMENTS) + f"SELECT session_id, {_SCALED} FROM model, moments"
ORACLES["assemble_features"] = (
    _with(*_M, _MOMENTS) + f"SELECT session_id, {_SCALED}, {_slots('DOUBLE')} FROM model, moments"
)

# Scores and quality measures

ORACLES["score_label_pairs"] = _with(*_Q) + "SELECT session_id, score, label, prediction FROM scored"
ORACLES["confusion_matrix"] = _with(*_Q) + "SELECT label, prediction, count(*) AS count FROM scored GROUP BY ALL"
_CELLS = """cells AS (SELECT
    count(*) FILTER (WHERE label = 1 AND prediction = 1)::DOUBLE AS tp,
    count(*) FILTER (WHERE label = 0 AND prediction = 1)::DOUBLE AS fp,
    count(*) FILTER (WHERE label = 1 AND prediction = 0)::DOUBLE AS fn,
    count(*) FILTER (WHERE label = 0 AND prediction = 0)::DOUBLE AS tn FROM scored)"""
ORACLES["classification_metrics"] = _with(*_Q, _CELLS) + """SELECT
  round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy,
  round(((tp + fn) * tp / (tp + fp) + (tn + fp) * tn / (tn + fn)) / (tp + fp + fn + tn), 6) AS precision,
  round(((tp + fn) * tp / (tp + fn) + (tn + fp) * tn / (tn + fp)) / (tp + fp + fn + tn), 6) AS recall,
  round(((tp + fn) * 2 * tp / (2 * tp + fp + fn) + (tn + fp) * 2 * tn / (2 * tn + fn + fp)) / (tp + fp + fn + tn), 6) AS f1
FROM cells"""
ORACLES["class1_metrics"] = _with(*_Q, _CELLS) + """SELECT
  round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy, round(tp / (tp + fp), 6) AS precision,
  round(tp / (tp + fn), 6) AS recall, round(2 * tp / (2 * tp + fp + fn), 6) AS f1 FROM cells"""
ORACLES["auc_roc"] = _with(*_Q) + """SELECT
  round((sum(mid_rank) FILTER (WHERE label = 1) - p * (p + 1) / 2) / (p * n), 6) AS auc_roc
FROM (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2 AS mid_rank,
    sum(label) OVER ()::DOUBLE AS p, sum(1 - label) OVER ()::DOUBLE AS n FROM scored)
GROUP BY p, n"""
ORACLES["auc_pr"] = _with(*_Q) + """, points AS (
  SELECT score, sum(label)::DOUBLE AS pos, count(*)::DOUBLE AS rows FROM scored GROUP BY score),
curve AS (
  SELECT score, sum(pos) OVER w / sum(pos) OVER () AS recall, sum(pos) OVER w / sum(rows) OVER w AS prec
  FROM points WINDOW w AS (ORDER BY score DESC)),
steps AS (
  SELECT recall - coalesce(lag(recall) OVER w, 0) AS width, prec, coalesce(lag(prec) OVER w, prec) AS prec_before
  FROM curve WINDOW w AS (ORDER BY score DESC))
SELECT round(sum(width * (prec + prec_before) / 2), 6) AS auc_pr FROM steps"""
ORACLES["sgd_gradient_step"] = _with(*_O) + "SELECT {} FROM online".format(
    _list(f'round(-0.1 * avg((0.5 - label) * "{c}"), 6) AS "{c}"' for c in ONLINE_FEATURES)
)
ORACLES["sgd_mini_batch_step"] = ORACLES["sgd_gradient_step"] + f" WHERE {_HASH.format(' + 1')} % 10000 < 2500"
ORACLES["view_sessions"] = ORACLES["scan_csv_by_header"] = ORACLES["scan_csv_sessions"]
_PLAIN = (*_O, f"scored AS (SELECT label, round(1 / (1 + exp(-({_MARGIN}))), 12) AS score FROM online)")
ORACLES["auc_unrounded"] = _with(*_PLAIN) + """, points AS (
  SELECT score, sum(label)::DOUBLE AS pos, sum(1 - label)::DOUBLE AS neg FROM scored GROUP BY score),
curve AS (
  SELECT *, sum(pos) OVER w AS pos_upto, sum(pos + neg) OVER w AS all_upto, sum(pos) OVER () AS p, sum(neg) OVER () AS n
  FROM points WINDOW w AS (ORDER BY score DESC))
SELECT round(sum(neg * (pos_upto - pos / 2)) / any_value(p * n), 6) AS auc_roc,
  round(sum(pos * (pos_upto / all_upto + coalesce((pos_upto - pos) / nullif(all_upto - pos - neg, 0), pos_upto / all_upto)) / 2) / any_value(p), 6) AS auc_pr
FROM curve"""



def _dictionary(name: str, column: str, source: str, where: str) -> str:
    return f"""{name} AS (SELECT {column} AS label, row_number() OVER (ORDER BY count(*) DESC, {column}) - 1 AS place
  FROM {source} WHERE {where} GROUP BY {column})"""


ORACLES["one_hot_slots"] = _with(
    *_M, *(_dictionary(f"d{i}", f'"{c}"', "model", f"{_TRAIN} AND \"OperatingSystems\" <> 'OS_3'") for i, c in enumerate(CATEGORICAL))
) + "SELECT session_id, {} FROM model {}".format(
    _list(f'coalesce(d{i}.place, -1) AS "{c}_slot"' for i, c in enumerate(CATEGORICAL)),
    " ".join(f'LEFT JOIN d{i} ON d{i}.label = "{c}"' for i, c in enumerate(CATEGORICAL)),
)
_ORDERS = 'placed AS (SELECT o_orderkey AS session_id, CAST(o_custkey AS VARCHAR) AS "Customer" FROM orders)'
ORACLES["index_customers"] = _with(_ORDERS, _dictionary("d", '"Customer"', "placed", _TRAIN)) + """SELECT session_id, "Customer",
  coalesce(place, (SELECT count(*) FROM d)) AS "Customer_index" FROM placed LEFT JOIN d ON label = "Customer" """

# Trees: every split of a number with few values is listed

_FEW = {
    **{name: f'floor(round(CAST("{c}" AS DOUBLE) / {width!r}::DOUBLE, 9))' for name, (c, width) in BANDS.items()},
    **{c: f'"{c}"' for c in FEW_VALUED if c not in BANDS},
}
_LONG = f"""few AS (SELECT session_id, "{LABEL}" AS label, {_TRAIN} AS is_train, {_FOLD} AS fold, unnest([
  {_list(f"{{'slot': {i}, 'feature': '{name}', 'value': CAST({value} AS DOUBLE)}}" for i, (name, value) in enumerate(_FEW.items()))}]) AS x FROM model),
long AS (SELECT session_id, label, is_train, fold, x.slot AS slot, x.feature AS feature, x.value AS value FROM few)"""


def _gini(n: str, pos: str) -> str:
    return f"(1 - (({pos}) / ({n})::DOUBLE) ** 2 - (1 - ({pos}) / ({n})::DOUBLE) ** 2)"


_GAIN = f"{_gini('tn', 'tp')} - ln / tn::DOUBLE * {_gini('ln', 'lp')} - (tn - ln) / tn::DOUBLE * {_gini('tn - ln', 'tp - lp')}"


def _splits(name: str, counts: str, by: str) -> str:
    """Every split of every node or fold (``by``): rows and positive rows on the left and in all, and the gain."""
    return f"""{name}_sides AS (
  SELECT {by}, slot, feature, (value + lead(value) OVER w) / 2 AS threshold, sum(n) OVER w AS ln, sum(pos) OVER w AS lp,
    sum(n) OVER p AS tn, sum(pos) OVER p AS tp
  FROM {counts} WHERE n > 0 WINDOW w AS (PARTITION BY {by}, slot ORDER BY value), p AS (PARTITION BY {by}, slot)),
{name} AS (SELECT *, {_GAIN} AS gain FROM {name}_sides WHERE threshold IS NOT NULL AND ln < tn)"""


def _best(name: str, splits: str) -> str:
    return f"""{name} AS (SELECT * FROM {splits} WHERE ln >= {SIDE} AND tn - ln >= {SIDE} AND round(gain, 12) > 0
  QUALIFY row_number() OVER (PARTITION BY path ORDER BY round(gain, 12) DESC, slot, threshold) = 1)"""


_PAGES = f", {' + '.join(_quoted([g]) for g in PAGE_GROUPS)} AS \"{PAGES}\""
_N = (*_S, _features("sessions", extra=_PAGES), _model(extra=f', "{PAGES}"'))
_GROWN = (
    _LONG,
    "counts0 AS (SELECT '' AS path, slot, feature, value, count(*) AS n, sum(label) AS pos FROM long WHERE is_train GROUP BY ALL)",
    _splits("splits0", "counts0", "path"), _best("best0", "splits0"),
    "sides AS (SELECT session_id, CASE WHEN value <= threshold THEN 'L' ELSE 'R' END AS path FROM long JOIN best0 USING (slot))",
    """counts1 AS (SELECT sides.path, slot, feature, value, count(*) AS n, sum(label) AS pos
  FROM long JOIN sides USING (session_id) WHERE is_train GROUP BY ALL)""",
    _splits("splits1", "counts1", "path"), _best("best1", "splits1"),
    # Leaves of one node that predict the same class are one leaf.
    "kept1 AS (SELECT * FROM best1 WHERE (2 * lp > ln) <> (2 * (tp - lp) > tn - ln))",
    "kept0 AS (SELECT * FROM best0 WHERE (2 * lp > ln) <> (2 * (tp - lp) > tn - ln) OR EXISTS (FROM kept1))",
)
_TOTALS = "SELECT '' AS path, sum(n) AS n, sum(pos) AS pos FROM counts0 WHERE slot = 0"
_CHILDREN = """SELECT path || 'L' AS path, ln AS n, lp AS pos FROM {0} UNION ALL SELECT path || 'R', tn - ln, tp - lp FROM {0}"""
_NODES = f"""nodes AS ({_TOTALS} UNION ALL {_CHILDREN.format('kept0')} UNION ALL {_CHILDREN.format('(FROM kept1 WHERE EXISTS (FROM kept0))')})"""
ORACLES["tree_nodes"] = _with(*_N, *_GROWN, _NODES) + """SELECT path, feature, round(threshold, 6) AS threshold, round(gain, 6) AS gain,
  CAST(a.n AS BIGINT) AS n, CAST(a.pos AS BIGINT) AS n_positive, CAST(2 * a.pos > a.n AS INTEGER)::DOUBLE AS prediction
FROM nodes a LEFT JOIN (FROM kept0 UNION ALL FROM kept1) USING (path)"""
_STEP = """SELECT p.session_id, p.label, p.path || CASE WHEN k.slot IS NULL THEN '' WHEN v.value <= threshold THEN 'L' ELSE 'R' END AS path
  FROM {0} p LEFT JOIN {1} k ON k.path = p.path LEFT JOIN long v ON v.session_id = p.session_id AND v.slot = k.slot"""
ORACLES["tree_node_scores"] = _with(
    *_N, *_GROWN, _NODES,
    "place0 AS (SELECT session_id, label, '' AS path FROM long WHERE slot = 0 AND NOT is_train)",
    f"place1 AS ({_STEP.format('place0', 'kept0')})", f"place2 AS ({_STEP.format('place1', 'kept1')})",
) + f"""SELECT session_id, label AS "{LABEL}", CAST(2 * pos > n AS INTEGER)::DOUBLE AS prediction,
  round(pos / n::DOUBLE, 6) AS probability, CAST(pos AS DOUBLE) AS score FROM place2 JOIN nodes USING (path)"""
ORACLES["tree_stump"] = _with(*_N, *_GROWN[:4]) + f"""SELECT session_id, label AS "{LABEL}", CAST(2 * pos > rows AS INTEGER)::DOUBLE AS prediction,
  round(pos / rows::DOUBLE, 6) AS probability, CAST(pos AS DOUBLE) AS score
FROM (SELECT session_id, label, CASE WHEN same THEN tn WHEN value <= threshold THEN ln ELSE tn - ln END AS rows,
    CASE WHEN same THEN tp WHEN value <= threshold THEN lp ELSE tp - lp END AS pos
  FROM long JOIN (SELECT *, (2 * lp > ln) = (2 * (tp - lp) > tn - ln) AS same FROM best0) USING (slot) WHERE NOT is_train)"""
_POINTS = _list(f"({i}, {depth}, {side})" for i, (depth, side) in enumerate(product(*STUMP_GRID.values()), 1))
ORACLES["cv_stump_results"] = _with(
    *_N, _LONG,
    "held AS (SELECT fold, slot, feature, value, count(*) AS n, sum(label) AS pos FROM long WHERE is_train GROUP BY ALL)",
    "total AS (SELECT slot, feature, value, sum(n) AS n, sum(pos) AS pos FROM held GROUP BY ALL)",
    # The training side of a fold is all rows without its own.
    """seen AS (SELECT f.fold, t.slot, t.feature, t.value, t.n - coalesce(h.n, 0) AS n, t.pos - coalesce(h.pos, 0) AS pos
  FROM total t, (SELECT DISTINCT fold FROM held) f LEFT JOIN held h ON h.fold = f.fold AND h.slot = t.slot AND h.value = t.value)""",
    _splits("splits", "seen", "fold"),
    f"points(configuration, depth, side) AS (VALUES {_POINTS})",
    """chosen AS (SELECT * FROM points JOIN splits ON ln >= side AND tn - ln >= side AND round(gain, 12) > 0
  QUALIFY row_number() OVER (PARTITION BY configuration, fold ORDER BY round(gain, 12) DESC, slot, threshold) = 1)""",
    # The second level is counted under the first split of each configuration and fold.
    """halves AS (SELECT configuration, side, c.fold, l.session_id, CASE WHEN l.value <= threshold THEN 'L' ELSE 'R' END AS path
  FROM chosen c JOIN long l ON l.slot = c.slot AND l.is_train WHERE depth = 2)""",
    """seen2 AS (SELECT configuration, side, h.fold, path, slot, feature, value, count(*) AS n, sum(label) AS pos
  FROM halves h JOIN long l ON l.session_id = h.session_id AND l.fold <> h.fold GROUP BY ALL)""",
    _splits("splits2", "seen2", "configuration, side, fold, path"),
    """chosen2 AS (SELECT * FROM splits2 WHERE ln >= side AND tn - ln >= side AND round(gain, 12) > 0
  QUALIFY row_number() OVER (PARTITION BY configuration, fold, path ORDER BY round(gain, 12) DESC, slot, threshold) = 1)""",
    """guessed AS (SELECT p.configuration, p.depth, p.side, s.fold, s.label, CASE
    WHEN d.slot IS NOT NULL THEN CASE WHEN w.value <= d.threshold THEN 2 * d.lp > d.ln ELSE 2 * (d.tp - d.lp) > d.tn - d.ln END
    WHEN c.slot IS NOT NULL THEN CASE WHEN v.value <= c.threshold THEN 2 * c.lp > c.ln ELSE 2 * (c.tp - c.lp) > c.tn - c.ln END
    ELSE 2 * r.pos > r.n END AS guess
  FROM points p JOIN long s ON s.slot = 0 AND s.is_train
  JOIN (SELECT fold, sum(n) AS n, sum(pos) AS pos FROM seen WHERE slot = 0 GROUP BY fold) r ON r.fold = s.fold
  LEFT JOIN chosen c ON c.configuration = p.configuration AND c.fold = s.fold LEFT JOIN long v ON v.session_id = s.session_id AND v.slot = c.slot
  LEFT JOIN chosen2 d ON d.configuration = p.configuration AND d.fold = s.fold AND d.path = CASE WHEN v.value <= c.threshold THEN 'L' ELSE 'R' END
  LEFT JOIN long w ON w.session_id = s.session_id AND w.slot = d.slot)""",
    """measured AS (SELECT configuration, depth, side, avg(accuracy) AS accuracy FROM (
  SELECT configuration, depth, side, fold, avg(CAST(guess = (label = 1) AS INTEGER)) AS accuracy FROM guessed GROUP BY ALL) GROUP BY ALL)""",
) + """SELECT CAST(configuration AS BIGINT) AS configuration, CAST(depth AS BIGINT) AS "maxDepth", CAST(side AS BIGINT) AS "minInstancesPerNode",
  round(accuracy, 6) AS avg_accuracy, row_number() OVER (ORDER BY round(accuracy, 12) DESC, configuration) = 1 AS best FROM measured"""

# Streams: the four arrivals are chosen by key, one micro-batch each

_ARRIVAL = f"CAST({_HASH.format('')} % 4 AS BIGINT)"
ORACLES["stream_batch_log"] = _with(*_S) + f"SELECT {_ARRIVAL} AS batch_id, count(*) AS n_lines FROM sessions GROUP BY ALL"
ORACLES["stream_batch_progress"] = _with(*_S) + f"SELECT {_ARRIVAL} AS batch_id, count(*) AS n_input FROM sessions GROUP BY ALL"
ORACLES["stream_tree_guards"] = _with(*_BROKEN, _STREAM) + f"""SELECT batch_id, n_rows, n_clean, CASE WHEN n_rows = 0 THEN 'empty'
    WHEN n_clean < 20 THEN 'too_few_rows' WHEN classes = 1 THEN 'one_class' ELSE 'ok' END AS status
FROM (SELECT CASE s."Browser" WHEN 13 THEN 0 WHEN 11 THEN 1 WHEN 10 THEN 2 ELSE 3 END::BIGINT AS batch_id, count(t.session_id) AS n_rows,
    count(t.session_id) FILTER (WHERE clean) AS n_clean, count(DISTINCT t."{LABEL}") FILTER (WHERE clean) AS classes
  FROM sessions s LEFT JOIN (
    SELECT *, "BounceRates" IS NOT NULL AND "ExitRates" IS NOT NULL AND "PageValues" IS NOT NULL AS clean FROM stream) t USING (session_id)
  GROUP BY ALL)"""

# The key of a line is the start of its MD5 sum, its upper half folded in before it is hashed.
_LINE_KEYS = """line_keys AS (SELECT session_id, ('0x' || left(md5(value), 15))::BIGINT AS line_key FROM lines),
parts AS (SELECT session_id, ((line_key % 4294967296 + (line_key >> 32) * 1540483477) % 4294967296)::HUGEINT * 2654435761 % 4294967296 % 100 < 80 AS is_train
  FROM line_keys)"""
ORACLES["stream_tree_splits"] = _with(*_BROKEN, _STREAM, _LINE_KEYS) + """SELECT batch_id, 'ok' AS status, count(*) AS n_rows, count(*) FILTER (WHERE clean) AS n_clean,
  {} FROM (SELECT {} AS batch_id, is_train, "{}" = 1 AS positive,
    "BounceRates" IS NOT NULL AND "ExitRates" IS NOT NULL AND "PageValues" IS NOT NULL AS clean FROM stream JOIN parts USING (session_id))
GROUP BY batch_id""".format(
    _list(f"count(*) FILTER (WHERE clean AND {side}{classes}) AS {name}" for side, part in (("is_train", "n_train"), ("NOT is_train", "n_test"))
          for classes, name in (("", part), (" AND positive", f"{part}_positive"))), _ARRIVAL, LABEL
)

_STEPS = 5
_AT = " + ".join(f'w[{i}] * "{x}"' for i, x in enumerate(ONLINE_FEATURES, 1))
_NEXT = _list(
    f'w[{i}] - 0.1 / sqrt(k % {_STEPS} + 1) * avg((1 / (1 + exp(-({_AT}))) - label) * "{x}")' for i, x in enumerate(ONLINE_FEATURES, 1)
)
_DESCENT = f"""arrived AS (SELECT *, {_ARRIVAL} AS batch_id FROM online),
descent AS (
  SELECT 0 AS k, {[0.0] * len(ONLINE_FEATURES)}::DOUBLE[] AS w
  UNION ALL
  SELECT k + 1, [{_NEXT}] FROM descent JOIN arrived ON batch_id = k // {_STEPS} WHERE k < {4 * _STEPS} GROUP BY k, w),
guessed AS (
  SELECT a.batch_id, w, label, CAST(1 / (1 + exp(-({_AT}))) > 0.5 AS INTEGER) AS guess
  FROM descent JOIN arrived a ON k = (a.batch_id + 1) * {_STEPS}),
hits AS (
  SELECT batch_id, w, count(*) AS n_rows, sum(guess * label)::DOUBLE AS tp, sum(guess)::DOUBLE AS guesses, sum(label)::DOUBLE AS actual,
    count(*) FILTER (WHERE guess = label)::DOUBLE AS right_ones FROM guessed GROUP BY batch_id, w)"""
ORACLES["stream_online_weights"] = _with(*_O, _DESCENT).replace("WITH ", "WITH RECURSIVE ", 1) + """SELECT batch_id, n_rows,
  round(right_ones / n_rows, 6) AS accuracy, round(coalesce(tp / nullif(guesses, 0), 0), 6) AS precision,
  round(coalesce(tp / nullif(actual, 0), 0), 6) AS recall, round(coalesce(2 * tp / nullif(guesses + actual, 0), 0), 6) AS f1, {}
FROM hits""".format(_list(f'round(w[{i}], 6) AS "w_{x}"' for i, x in enumerate(ONLINE_FEATURES, 1)))
