"""The registered queries as plain SQL over the same tables, for checking by another engine.

These follow the definitions directly (ordered windows, range joins, unions), not the way the
Spark operators are built.
"""

# Fixed values, written out here and not taken from the code under test: the limits' names, labels
# and codes, and the percentiles of the reports.
RULES = [
    ("expected_range", "OutOfRange", "RealRngL", "RealRngU", "outofrange"),
    ("LOQ_anom", "BelowLOQ", "LOQ_limit", None, "BelowLOQ"),
    ("ambient_01", "Lowest1%AmbientValues", "amb01L", None, "ambient_99"),
    ("ambient_05", "Lowest5%AmbientValues", "amb05L", None, "ambient_95"),
    ("ambient_95", "Highest95%AmbientValues", None, "amb95U", "ambient_95"),
    ("ambient_99", "Highest99%AmbientValues", None, "amb99U", "ambient_99"),
    ("WQS", "ViolatesWQStandard", "stdL", "stdU", "ViolateWQS"),
    ("WQS_LP", "ViolatesLessProtectiveWQStandard", "stdLlp", "stdUlp", "ViolateWQS"),
    ("sub_5", "Lowest5%SubmValues", "percen_5th", None, "submit_95"),
    ("sub_10", "Lowest10%SubmValues", "percen_10th", None, "submit_90"),
    ("sub_90", "Highest90%SubmValues", None, "percen_90th", "submit_90"),
    ("sub_95", "Highest95%SubmValues", None, "percen_95th", "submit_95"),
    ("station_5", "Lowest5%SubmStnValues", "S_percen_5th", None, "station_95"),
    ("station_95", "Highest95%SubmStnValues", None, "S_percen_95th", "station_95"),
]
DATA_PERCENTILES = {"5th %": 0.05, "10th %": 0.1, "20th %": 0.2, "25th %": 0.25, "Median": 0.5, "75th %": 0.75, "80th %": 0.8,
                    "90th %": 0.9, "95th %": 0.95}
QC_PERCENTILES = {"5th %": 0.05, "10th %": 0.1, "25th %": 0.25, "Median": 0.5, "75th %": 0.75, "90th %": 0.9, "95th %": 0.95}

N = range(1, 8)
TIME = "strftime({0}, '%Y-%m-%d %H:%M:%S') AS {0}"
AT = TIME.format('"DateTime"')

READINGS = """
li AS (
  SELECT l_orderkey AS order_key, CAST(place // 2 AS BIGINT) AS pair,
    l_orderkey + CAST(place // 2 AS BIGINT) * 1000000000000 AS row_ID, l_linenumber AS num, place % 2 + 1 AS rn, CAST(l_quantity AS DOUBLE) AS Result,
    CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS RsltQual,
    CASE WHEN l_linestatus = 'F' THEN 'late' END AS Res_comment,
    CASE WHEN l_tax < 0.03 THEN 'A' WHEN l_tax < 0.06 THEN 'B' END AS OG_ACC,
    CASE WHEN l_discount < 0.04 THEN 'A' WHEN l_discount < 0.08 THEN 'B' END AS OG_PREC,
    CASE WHEN l_tax < 0.02 THEN 'A' WHEN l_discount < 0.05 THEN 'B' END AS OG_DQL
  FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey,
          l_extendedprice, l_quantity, l_discount, l_tax, l_shipdate, l_returnflag, l_linestatus) - 1 AS place
        FROM lineitem)),
vis AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS subid, o_orderkey AS row_ID, 10000 + o_custkey % 100 AS LASAR_ID,
    o_orderdate + to_minutes(CAST(o_orderkey % 1440 AS BIGINT)) AS "DateTime",
    'S' || CAST(o_custkey % 5 AS VARCHAR) AS samplers, CAST(o_orderkey % 10 AS VARCHAR) AS SampleDepth,
    CASE o_orderkey % 3 WHEN 0 THEN 'meters' WHEN 1 THEN 'feet' END AS SampleDepthUnit,
    CASE WHEN o_orderpriority = '1-URGENT' THEN 'urgent' END AS Org_Comment,
    CASE WHEN o_custkey % 10 = 0 THEN 'check' END AS DEQ_Comment
  FROM orders)"""


def _ids(source, batch_type):
    return f"""
  SELECT *, concat_ws('-', CAST(subid AS VARCHAR), Date4Id, CAST(LASAR_ID AS VARCHAR), TypeIDText) AS act_id,
    concat_ws('-', CAST(subid AS VARCHAR), Date4Id, CAST(LASAR_ID AS VARCHAR), TypeIDText, CharIDText) AS result_id,
    concat_ws('-', CAST(subid AS VARCHAR), CharIDText) AS sub_char, act_group || '-' || CharIDText AS actgrp_char
  FROM (SELECT *, CASE DupBatchType
          WHEN 449 THEN concat_ws('-', CAST(subid AS VARCHAR), Date4group, samplers)
          WHEN 450 THEN concat_ws('-', CAST(subid AS VARCHAR), samplers)
          WHEN 448 THEN concat_ws('-', CAST(subid AS VARCHAR), Date4group) ELSE 'ERROR' END AS act_group
        FROM (SELECT *, 'c' || CAST(num AS VARCHAR) AS CharIDText,
                'c' || CAST(num AS VARCHAR) || CASE rn WHEN 2 THEN 'd_r' ELSE '_r' END AS Char,
                CASE rn WHEN 2 THEN 'dup' ELSE 'sample' END AS sample_type,
                CAST(num + 1 AS DOUBLE) AS LOQ, CASE WHEN num <> 7 THEN CAST(20 + num AS DOUBLE) END AS Low_QC,
                CASE WHEN num % 2 = 1 THEN 'Field' ELSE 'Lab' END AS FieldOrLab,
                'u' || CAST(num % 3 AS VARCHAR) AS UNITS, 'M' || CAST(num AS VARCHAR) AS method,
                CASE WHEN num % 2 = 0 THEN 'as N' END AS MethodSpeciation,
                CASE WHEN num % 2 = 1 THEN CASE rn WHEN 2 THEN 158 ELSE 149 END
                     ELSE CASE rn WHEN 2 THEN 313 ELSE 233 END END AS act_type,
                CASE WHEN num % 2 = 1 THEN CASE rn WHEN 2 THEN 'FD' ELSE 'FM' END
                     ELSE CASE rn WHEN 2 THEN 'LD' ELSE 'LM' END END AS TypeIDText,
                {batch_type} AS DupBatchType, 100 + subid % 3 AS SubOrganizationID,
                strftime("DateTime", '%Y%m%d%H%M') AS Date4Id, strftime("DateTime", '%Y%m%d') AS Date4group
              FROM (SELECT v.* EXCLUDE (row_ID, "DateTime"), v."DateTime" + to_minutes(l.pair) AS "DateTime", l.* EXCLUDE (order_key, pair)
                    FROM {source} l JOIN vis v ON v.row_ID = l.order_key)))"""


BATCH_TYPE = "CASE subid % 4 WHEN 1 THEN 449 WHEN 2 THEN 450 ELSE 448 END"
RES = READINGS + ",\nres AS (" + _ids("li", BATCH_TYPE) + ")"

PREC = RES + """,
crit AS (SELECT 'c' || CAST(n AS VARCHAR) AS CharIDText,
    CASE n % 3 WHEN 0 THEN 'RPD' WHEN 1 THEN 'AbsDiff' ELSE 'LogDiff' END AS QCcalc,
    CAST(CASE n % 3 WHEN 0 THEN 0.3 WHEN 1 THEN 5 ELSE 0.2 END AS DOUBLE) AS DQLA,
    CAST(CASE n % 3 WHEN 0 THEN 0.8 WHEN 1 THEN 15 ELSE 0.5 END AS DOUBLE) AS DQLB
  FROM range(1, 8) t(n)),
paired AS (
  SELECT r.*, QCcalc, DQLA, DQLB, count(*) OVER pair AS n_pair, avg(Result) OVER pair AS m,
    coalesce(lag(Result) OVER (PARTITION BY subid, row_ID, CharIDText ORDER BY sample_type DESC), Result) AS prv
  FROM res r JOIN crit USING (CharIDText) WINDOW pair AS (PARTITION BY subid, row_ID, CharIDText)),
prec AS (
  SELECT *, abs(signed_val) AS prec_val,
    CASE WHEN abs(signed_val) <= DQLA THEN 'A' WHEN abs(signed_val) <= DQLB THEN 'B' ELSE 'C' END AS prec_DQL,
    CASE WHEN signed_val <= DQLA THEN 'A' WHEN signed_val <= DQLB THEN 'B' ELSE 'C' END AS signed_DQL
  FROM (SELECT *, CASE QCcalc WHEN 'LogDiff' THEN log10(Result) - log10(prv) WHEN 'AbsDiff' THEN Result - prv
                  WHEN 'RPD' THEN (Result - prv) / m END AS signed_val
        FROM paired WHERE n_pair > 1)
  WHERE sample_type = 'dup')"""

BATCH = PREC + """,
batch AS (
  SELECT *, CASE WHEN pctQCtononQC < 0.1 THEN 'QC ' || CAST(CAST(trunc(pctQCtononQC * 100) AS INTEGER) AS VARCHAR) || '%'
      WHEN pctA = 1 THEN 'A' WHEN pctB = 1 THEN 'B' WHEN pctC = 1 THEN 'C'
      WHEN pctA < 1 OR pctB < 1 OR pctC < 1 THEN 'Mixed' END AS prelim_dql
  FROM (SELECT *, sumofQC / grp_count AS pctQC, sumofQC / nullif(sumofNonQC, 0) AS pctQCtononQC,
          sumofA / nullif(sumofQC, 0) AS pctA, sumofB / nullif(sumofQC, 0) AS pctB, sumofC / nullif(sumofQC, 0) AS pctC
        FROM (SELECT r.subid, r.actgrp_char, count(*) AS grp_count,
                count(*) FILTER (r.sample_type = 'dup') AS sumofQC,
                count(*) FILTER (r.sample_type = 'sample') AS sumofNonQC,
                count(*) FILTER (p.prec_DQL = 'A') AS sumofA, count(*) FILTER (p.prec_DQL = 'B') AS sumofB,
                count(*) FILTER (p.prec_DQL = 'C') AS sumofC
              FROM res r LEFT JOIN prec p ON p.subid = r.subid AND p.row_ID = r.row_ID
                AND p.CharIDText = r.CharIDText AND p.sample_type = r.sample_type
              GROUP BY r.subid, r.actgrp_char)))"""

WINDOWS = BATCH + """,
win AS (
  SELECT subid, actgrp_char, row_ID, "DateTime", prec_DQL,
    CASE WHEN "DateTime" = first_at THEN "DateTime" - INTERVAL 1 YEAR
         WHEN prec_DQL < pg THEN "DateTime" WHEN prec_DQL > pg THEN pt + INTERVAL 2 SECOND
         WHEN prec_DQL = pg THEN "DateTime" ELSE "DateTime" + INTERVAL 1000 YEAR END AS ApplicableStart,
    CASE WHEN "DateTime" = last_at THEN "DateTime" + INTERVAL 1 YEAR
         WHEN prec_DQL < ng THEN "DateTime" + INTERVAL 1 SECOND WHEN prec_DQL >= ng THEN nt - INTERVAL 1 SECOND
         ELSE "DateTime" + INTERVAL 1000 YEAR END AS ApplicableEnd
  FROM (SELECT p.subid, p.actgrp_char, p.row_ID, p."DateTime", p.prec_DQL,
          lag(p.prec_DQL) OVER o AS pg, lag(p."DateTime") OVER o AS pt,
          lead(p.prec_DQL) OVER o AS ng, lead(p."DateTime") OVER o AS nt,
          min(p."DateTime") OVER (PARTITION BY p.subid, p.actgrp_char) AS first_at,
          max(p."DateTime") OVER (PARTITION BY p.subid, p.actgrp_char) AS last_at
        FROM prec p JOIN batch b ON b.subid = p.subid AND b.actgrp_char = p.actgrp_char AND b.prelim_dql = 'Mixed'
        WINDOW o AS (PARTITION BY p.subid, p.actgrp_char ORDER BY p."DateTime", p.row_ID, p.result_id))),
hit AS (
  SELECT r.subid, r.row_ID, r.CharIDText, r.sample_type, r.actgrp_char, w.prec_DQL, w.row_ID AS by_row
  FROM res r JOIN batch b ON b.subid = r.subid AND b.actgrp_char = r.actgrp_char AND b.prelim_dql = 'Mixed'
  LEFT JOIN win w ON w.subid = r.subid AND w.actgrp_char = r.actgrp_char
    AND r."DateTime" >= w.ApplicableStart AND r."DateTime" <= w.ApplicableEnd),
worst AS (SELECT subid, row_ID, CharIDText, sample_type, actgrp_char, max(prec_DQL) AS prec_DQL FROM hit GROUP BY ALL),
graded AS (
  SELECT r.*, b.grp_count, b.sumofQC, b.prelim_dql
  FROM res r JOIN batch b ON b.subid = r.subid AND b.actgrp_char = r.actgrp_char AND b.prelim_dql <> 'Mixed'
  UNION ALL
  SELECT r.*, b.grp_count, b.sumofQC, w.prec_DQL AS prelim_dql
  FROM res r JOIN batch b ON b.subid = r.subid AND b.actgrp_char = r.actgrp_char AND b.prelim_dql = 'Mixed'
  JOIN worst w ON w.subid = r.subid AND w.row_ID = r.row_ID AND w.CharIDText = r.CharIDText AND w.sample_type = r.sample_type)"""


def _percentile(p, value="Result"):
    """Weighted value at place 1 + (n - 1) p of the sorted values."""
    values, place = f"list_sort(list({value}))", f"(1 + (count({value}) - 1) * CAST({p} AS DOUBLE))"
    low, high = (f"{values}[CAST({end}({place}) AS BIGINT)]" for end in ("floor", "ceil"))
    part = f"({place} - floor({place}))"
    return f"CASE WHEN {low} = {high} THEN {low} ELSE (1 - {part}) * {low} + {part} * {high} END"


def _percentiles(names):
    return ", ".join(f'{_percentile(p)} AS "{name}"' for name, p in names.items())


SUB = {"percen_5th": 0.05, "percen_10th": 0.1, "percen_90th": 0.9, "percen_95th": 0.95}
STATION = {"S_percen_5th": 0.05, "S_percen_95th": 0.95}


def _violates(low, high):
    return " OR ".join(([f"Result < {low}"] if low else []) + ([f"Result > {high}"] if high else []))


def _with_flags(prior, source):
    """CTEs computing percentiles of ``source`` and flagging each of its rows."""
    flags = ", ".join(f"CASE WHEN {_violates(low, high)} THEN '{label}' END AS f_{flag}"
                      for flag, label, low, high, _ in RULES)
    melted = " UNION ALL ".join(
        f"SELECT subid, row_ID, CharIDText, sample_type, result_id, Result, AnomCritID, '{flag}' AS Anom_type, "
        f"f_{flag} AS Anom, '{code}' AS AnomTypeCode FROM flagged WHERE f_{flag} IS NOT NULL"
        for flag, _, _, _, code in RULES)
    return prior + f""",
sub_pct AS (SELECT subid, CharIDText, {_percentiles(SUB)} FROM {source} GROUP BY subid, CharIDText),
stn_pct AS (SELECT subid, LASAR_ID, CharIDText, {_percentiles(STATION)} FROM {source} GROUP BY subid, LASAR_ID, CharIDText),
anom_crit AS (SELECT CAST(n + 500 AS INTEGER) AS AnomCritID, 'c' || CAST(n AS VARCHAR) AS CharIDText,
    CASE WHEN n <> 7 THEN 2.0::DOUBLE END AS RealRngL, 49.0::DOUBLE AS RealRngU, 2.0::DOUBLE AS amb01L,
    4.0::DOUBLE AS amb05L, 46.0::DOUBLE AS amb95U, 49.0::DOUBLE AS amb99U,
    CASE WHEN n % 2 = 0 THEN 3.0::DOUBLE END AS stdL, CAST(44 + n AS DOUBLE) AS stdU,
    CAST(NULL AS DOUBLE) AS stdLlp, CAST(47 + n % 3 AS DOUBLE) AS stdUlp FROM range(1, 8) t(n)),
flagged AS (SELECT *, {flags} FROM (
  SELECT *, LOQ - LOQ * 0.1::DOUBLE AS LOQ_limit FROM {source}
  LEFT JOIN anom_crit USING (CharIDText) LEFT JOIN sub_pct USING (subid, CharIDText)
  LEFT JOIN stn_pct USING (subid, LASAR_ID, CharIDText))),
raised AS ({melted}),
codes AS (SELECT DISTINCT subid, row_ID, CharIDText, sample_type, AnomTypeCode FROM raised),
counted AS (SELECT subid, row_ID, CharIDText, sample_type, count(*) AS num_anom,
    count(*) FILTER (AnomTypeCode = 'submit_95') AS anom_sub_95,
    count(*) FILTER (AnomTypeCode = 'ambient_99') AS anom_amb_99,
    count(*) FILTER (AnomTypeCode = 'ambient_95') AS anom_amb_95,
    count(*) FILTER (AnomTypeCode = 'ViolateWQS') AS anom_WQS,
    count(*) FILTER (AnomTypeCode = 'BelowLOQ') AS anom_BelowLOQ FROM codes GROUP BY ALL)"""


FLAGS = _with_flags(RES, "res")
FINAL = _with_flags(WINDOWS, "graded") + """,
final AS (
  SELECT *, CASE WHEN prelim_dql < 'C' AND anom_amb_99 > 0 THEN 'Anom'
      WHEN prelim_dql < 'C' AND anom_sub_95 > 0 AND anom_amb_95 > 0 THEN 'Anom'
      WHEN prelim_dql < 'C' AND anom_amb_95 > 0 AND anom_WQS > 0 THEN 'Anom'
      WHEN prelim_dql < 'C' AND anom_WQS > 0 THEN 'Anom'
      WHEN prelim_dql > 'H' THEN 'Anom' ELSE prelim_dql END AS final_DQL, '' AS DQLCmt
  FROM graded LEFT JOIN counted USING (subid, row_ID, CharIDText, sample_type))"""

KEY = "subid, row_ID, CharIDText"
COUNTS = "num_anom, anom_sub_95, anom_amb_99, anom_amb_95, anom_WQS, anom_BelowLOQ"
TEXT_COUNTS = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in COUNTS.split(", "))


def _with(ctes, select):
    return f"WITH {ctes.strip()}\n{select}"


def _r(expression, name=None):
    return f'round({expression}, 6) AS "{name or expression}"'


def _wide():
    columns = []
    for i in N:
        columns += [f"max(Result) FILTER (num = {i} AND rn = 1) AS c{i}_r",
                    f"max(Result) FILTER (num = {i} AND rn = 2) AS c{i}d_r"]
        for suffix, source in (("qual", "RsltQual"), ("cmnt", "Res_comment"), ("ACC", "OG_ACC"), ("PREC", "OG_PREC"),
                               ("DQL", "OG_DQL")):
            columns.append(f"max({source}) FILTER (num = {i} AND rn = 1) AS c{i}_{suffix}")
    return READINGS + f""",
wide AS (SELECT v.* EXCLUDE (row_ID, "DateTime"), v."DateTime" + to_minutes(g.pair) AS "DateTime", g.* EXCLUDE (order_key, pair)
  FROM (SELECT order_key, pair, row_ID, {', '.join(columns)} FROM li GROUP BY ALL) g JOIN vis v ON v.row_ID = g.order_key)"""


WIDE = _wide()
FAMILIES = {"Res_comment": "cmnt", "RsltQual": "qual", "OG_ACC": "ACC", "OG_PREC": "PREC", "OG_DQL": "DQL"}
CELLS = [(i, f"c{i}{mark}", kind) for i in N for mark, kind in (("_r", "sample"), ("d_r", "dup"))]


def _melt(extra):
    return " UNION ALL ".join(f"SELECT {extra(i, column, kind)} FROM wide WHERE {column} IS NOT NULL"
                              for i, column, kind in CELLS)


def _metadata_cells(condition):
    return " UNION ALL ".join(
        f"SELECT subid, row_ID, 'c{i}_{suffix}' AS \"column\", 'c{i}' AS CharIDText, '{family}' AS family, "
        f"c{i}_{suffix} AS value FROM wide WHERE c{i}_{suffix} IS NOT NULL{condition(i)}"
        for family, suffix in FAMILIES.items() for i in N)


GAPS = f"CASE WHEN subid % 5 <> 0 THEN {BATCH_TYPE} END"
IDENTIFIED = READINGS + ",\nres AS (" + _ids("li", GAPS) + ")"
RAW = READINGS + """,
raw AS (SELECT row_ID, 'c' || CAST(l_linenumber AS VARCHAR) AS CharIDText,
    CASE WHEN l_returnflag = 'R' THEN 'dup' ELSE 'sample' END AS sample_type, CAST(l_quantity AS DOUBLE) AS Result,
    subid, LASAR_ID, "DateTime"
  FROM lineitem JOIN vis ON row_ID = l_orderkey)"""


def _repeats(keys):
    return _with(RAW, f"SELECT * EXCLUDE (n) REPLACE ({AT}) FROM (SELECT *, count(*) OVER (PARTITION BY {keys}) AS n FROM raw) WHERE n > 1")


READING = 'subid, LASAR_ID, "DateTime", CharIDText, sample_type'

# Both difference rules are on offer for two kinds of characteristic; the third has its own.
LEVELS = RES + """,
crit2 AS (SELECT 'c' || CAST(n AS VARCHAR) AS CharIDText, * FROM range(1, 8) t(n) JOIN (VALUES
    ('RPD', 0.3::DOUBLE, 0.8::DOUBLE), ('AbsDiff', 5::DOUBLE, 15::DOUBLE), ('LogDiff', 0.2::DOUBLE, 0.5::DOUBLE))
    v(QCcalc, DQLA, DQLB) ON (n % 3 = 2) = (QCcalc = 'LogDiff')),
rule AS (SELECT subid, row_ID, CharIDText, QCcalc, DQLA, DQLB, 1 AS USE
  FROM res JOIN crit2 USING (CharIDText)
  WHERE sample_type = 'sample' AND CASE
    WHEN QCcalc = 'RPD' AND Result < Low_QC THEN false
    WHEN QCcalc = 'AbsDiff' AND (Result >= Low_QC OR Low_QC IS NULL) THEN false ELSE true END)"""

DIFFERENCE = "CASE QCcalc WHEN 'LogDiff' THEN log10(d.Result) - log10(s.Result) WHEN 'AbsDiff' THEN d.Result - s.Result " \
             "ELSE (d.Result - s.Result) / ((d.Result + s.Result) / 2) END"

DATA_COLUMNS = ", ".join(f'round({_percentile(p)}, 6) AS "{n}"' for n, p in DATA_PERCENTILES.items())
QC_COLUMNS = ", ".join(f'round({_percentile(p, "signed_val")}, 6) AS "{n}"' for n, p in QC_PERCENTILES.items())

BOX = RES + f""",
box AS (SELECT subid, LASAR_ID, CharIDText, count(*) AS n, {_percentile(0.25)} AS lower, {_percentile(0.5)} AS middle,
    {_percentile(0.75)} AS upper FROM res GROUP BY subid, LASAR_ID, CharIDText),
fenced AS (SELECT *, Result BETWEEN lower - 1.5 * (upper - lower) AND upper + 1.5 * (upper - lower) AS inside
  FROM res JOIN box USING (subid, LASAR_ID, CharIDText))"""

GROUPS = """SELECT DISTINCT act_group AS ActGrpIDText, CASE WHEN DupBatchType = 450
    THEN 'batched through calendar year by sampler' ELSE Date4group END AS ActGrpComment, 311 AS ActGrpTypeID FROM res"""
ACTIVITY = """
stn AS (SELECT DISTINCT 10000 + c_custkey % 100 AS LASAR_ID, CAST(c_custkey % 100 + 1 AS INTEGER) AS StnID,
    'Station ' || CAST(c_custkey % 100 AS VARCHAR) AS StationDes, 'ML-' || CAST(c_custkey % 100 AS VARCHAR) AS MLocID
  FROM customer)"""


def _activities(zone):
    return f"""SELECT DISTINCT act_id AS ActivityIDText, act_type AS ActivityTypeId, subid AS SubID,
    StationDes AS SiteDescription, "DateTime" AS StartDateTime, {zone} AS StartDateTimeZoneID, 8 AS MediaID,
    SubOrganizationID AS ActivityOrgID, SampleDepth AS SmplDepth,
    CASE SampleDepthUnit WHEN 'meters' THEN 146 WHEN 'feet' THEN 72 END AS SmplDepthUnitID, Org_Comment, DEQ_Comment,
    samplers AS Samplers, StnID AS fkStnID FROM res LEFT JOIN stn USING (LASAR_ID)"""


# US daylight saving in the years of the test data: first Sunday of April (1987 to 2006), last
# Sunday of October, at 2:00 local time, which is 10:00 and 9:00 UTC on the Pacific coast.
PACIFIC = """CASE WHEN "DateTime" >= make_timestamp(year("DateTime"), 4, 1, 10, 0, 0)
      + to_days(CAST((7 - dayofweek(make_date(year("DateTime"), 4, 1))) % 7 AS INTEGER))
    AND "DateTime" < make_timestamp(year("DateTime"), 10, 31, 9, 0, 0)
      - to_days(CAST(dayofweek(make_date(year("DateTime"), 10, 31)) AS INTEGER)) THEN 22 ELSE 23 END"""

NUMBER = "regexp_replace(CAST({} AS VARCHAR), '\\.0$', '')"
RESULT_ROWS = """
out AS (SELECT f.*, CASE WHEN f.sample_type = 'dup' THEN p.prec_val END AS prec_val,
    CASE WHEN f.sample_type = 'dup' THEN p.prec_DQL END AS prec_DQL
  FROM final f LEFT JOIN (SELECT subid, row_ID, CharIDText, sample_type, prec_val, prec_DQL FROM prec) p
    USING (subid, row_ID, CharIDText, sample_type))"""


def _identity(*columns):
    """The key of a row: the digest of its values, each written with its length."""
    return "md5(" + " || ".join(f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in columns) + ")"


BATCH_COMMENT = "CASE WHEN DupBatchType = 450 THEN 'batched through calendar year by sampler' ELSE Date4group END"
ACT_KEY = _identity("act_id", "act_type", "subid", "LASAR_ID", '"DateTime"', "SubOrganizationID", "samplers", "SampleDepth",
                    "SampleDepthUnit", "DEQ_Comment", "Org_Comment")
RESULT_KEY = _identity("subid", "row_ID", "CharIDText", "sample_type", "Char")
GROUP_KEY = _identity("subid", "act_group", BATCH_COMMENT)


def _row_ids(source, key, name):
    return f"SELECT k, row_number() OVER (ORDER BY k) AS {name} FROM (SELECT DISTINCT {key} AS k FROM {source})"


def _blank(*columns):
    return ", ".join(f"'' AS {c}" for c in columns)


def _keys(source, column, key, name, start=0):
    return (f"SELECT {column} AS {key}, {start} + row_number() OVER (ORDER BY substr(md5({column}), 1, 4), {column}) "
            f"AS {name} FROM (SELECT DISTINCT {column} FROM {source})")


def oracle_sql():
    labels = ", ".join(f"({401 + i}, '{label}')" for i, (_, label, *_) in enumerate(RULES))
    flags = _with(FLAGS, f"SELECT {KEY}, result_id, Result, AnomCritID, Anom_type, Anom, AnomTypeCode FROM raised")
    summary = ("SELECT subid, actgrp_char, grp_count, sumofQC, sumofNonQC, sumofA, sumofB, sumofC, "
               + ", ".join(_r(c) for c in ("pctQC", "pctQCtononQC", "pctA", "pctB", "pctC")) + ", prelim_dql FROM batch")
    scatter = _with(PREC, f"""SELECT {KEY}, LASAR_ID, {AT}, act_group, actgrp_char, {_r('signed_val', 'prec_val')},
      DQLA, DQLB, Result AS dup, prv AS sample, {_r('prv + DQLA', 'A_QC_U')}, {_r('prv - DQLA', 'A_QC_L')},
      {_r('prv + DQLB', 'B_QC_U')}, {_r('prv - DQLB', 'B_QC_L')} FROM prec""")
    series = """SELECT {key}, {at}, QCcalc, round(signed_val, 6) AS prec_val, DQLA, DQLB, {grade} AS prec_DQL,
      -DQLA AS DQLA_Low, -DQLB AS DQLB_Low FROM prec"""
    clock = "strftime(\"DateTime\", '%H:%M')"
    both = _with(RES, f"""SELECT subid, Station, Characteristic, Count, Mean, Min, "{'", "'.join(DATA_PERCENTILES)}", Max FROM (
      SELECT subid, 'All' AS Station, CharIDText AS Characteristic, count(*) AS Count, round(avg(Result), 6) AS Mean,
        round(min(Result), 6) AS Min, {DATA_COLUMNS}, round(max(Result), 6) AS Max FROM res GROUP BY subid, CharIDText
      UNION ALL
      SELECT subid, CAST(LASAR_ID AS VARCHAR), CharIDText, count(*), round(avg(Result), 6), round(min(Result), 6),
        {DATA_COLUMNS}, round(max(Result), 6) FROM res GROUP BY subid, LASAR_ID, CharIDText)""")
    text_result = NUMBER.format("Result")
    sql = {
        "template_melt_results": _with(WIDE, _melt(lambda i, c, k: f"""subid, row_ID, LASAR_ID, {AT}, '{c}' AS Char,
            'c{i}' AS CharIDText, '{k}' AS sample_type, {c} AS Result""")),
        "template_metadata_join": _with(WIDE, _melt(lambda i, c, k: f"subid, row_ID, '{c}' AS Char, " + ", ".join(
            f"c{i}_{s} AS {f}" for f, s in FAMILIES.items()) + ", Org_Comment, DEQ_Comment")),
        "template_metadata_long": _with(WIDE, _metadata_cells(lambda i: "")),
        "template_visit_comments": _with(READINGS, """SELECT subid, row_ID, DEQ_Comment, Org_Comment FROM vis
            WHERE Org_Comment IS NOT NULL OR DEQ_Comment IS NOT NULL"""),
        "row_numbering": _with(READINGS, """SELECT subid, row_ID AS entry, LASAR_ID,
            row_number() OVER (PARTITION BY subid ORDER BY row_ID) AS row_ID FROM vis WHERE row_ID % 11 <> 0"""),
        "sample_timestamp": _with(READINGS, f"""SELECT row_ID,
            CASE WHEN row_ID % 4 = 2 THEN strftime("DateTime", '%Y/%m/%d') ELSE strftime("DateTime", '%Y-%m-%d') END AS StartDate,
            CASE WHEN row_ID % 7 = 0 THEN NULL WHEN row_ID % 4 = 0 THEN {clock}
              WHEN row_ID % 4 = 1 THEN '1899-12-31 ' || {clock} || ':00' ELSE {clock} || ':00' END AS StartTime,
            CASE WHEN row_ID % 7 <> 0 THEN strftime("DateTime", '%Y-%m-%d %H:%M:%S') END AS "DateTime",
            CASE WHEN row_ID % 7 <> 0 THEN strftime("DateTime", '%Y%m%d%H%M') END AS Date4Id,
            CASE WHEN row_ID % 7 <> 0 THEN strftime("DateTime", '%Y%m%d') END AS Date4group FROM vis"""),
        "identifiers": _with(IDENTIFIED, """SELECT subid, row_ID, Char, act_type, CAST(DupBatchType AS VARCHAR) AS DupBatchType, LOQ, Low_QC, act_id,
            act_group, result_id, sub_char, actgrp_char FROM res"""),
        "audit_unbatched": _with(IDENTIFIED, "SELECT subid, row_ID, Char, Result, actgrp_char FROM res WHERE act_group = 'ERROR'"),
        "audit_repeat_results": _repeats(f"row_ID, {READING}, Result"),
        "audit_repeat_keys": _repeats(f"row_ID, {READING}"),
        "audit_repeat_keys_across_rows": _repeats(READING).replace("FROM raw)", """FROM (SELECT * FROM raw UNION ALL
            SELECT * REPLACE (row_ID + 1000000000000 AS row_ID) FROM raw WHERE row_ID % 16 = 0))"""),
        "audit_unreadable": _with(WIDE, """SELECT subid, row_ID, 'c1_r' AS Char, 'c1' AS CharIDText, '<' || CAST(c1_r AS VARCHAR) AS text
            FROM wide WHERE row_ID % 13 = 0 AND c1_r IS NOT NULL"""),
        "audit_unknown_char": _with(RES, "SELECT subid, row_ID, Char, CharIDText, Result FROM res WHERE CharIDText = 'c7'"),
        "audit_required_nulls": _with(RES + ",\nkeyed AS (" + _row_ids("(SELECT * FROM res WHERE subid <> 1995)", ACT_KEY, "ActivityID") + ")",
            f"""SELECT result_id AS ResultIDText, CAST(ActivityID AS VARCHAR) AS ActivityID, num * 10 AS CharID,
            CASE WHEN num <> 4 THEN CAST(num + 200 AS VARCHAR) END AS MethodID, {text_result} AS Result
            FROM res LEFT JOIN keyed ON k = {ACT_KEY} WHERE num = 4 OR ActivityID IS NULL"""),
        "audit_orphan_metadata": _with(WIDE, _metadata_cells(lambda i: f" AND coalesce(c{i}_r, 0) < 10 AND c{i}d_r IS NULL")),
        "precision_rule_choice": _with(LEVELS, f"SELECT {KEY}, QCcalc, DQLA, DQLB, USE FROM rule"),
        "replicate_precision": _with(PREC, f"SELECT {KEY}, result_id, QCcalc, {_r('prec_val')}, DQLA, DQLB, prec_DQL FROM prec"),
        "replicate_precision_by_level": _with(LEVELS, f"""SELECT {KEY}, result_id, QCcalc, {_r('prec_val')}, DQLA, DQLB,
            CASE WHEN prec_val <= DQLA THEN 'A' WHEN prec_val <= DQLB THEN 'B' ELSE 'C' END AS prec_DQL
            FROM (SELECT {KEY}, d.result_id, QCcalc, DQLA, DQLB, abs({DIFFERENCE}) AS prec_val
              FROM (SELECT * FROM res WHERE sample_type = 'dup') d JOIN (SELECT * FROM res WHERE sample_type = 'sample') s
              USING ({KEY}) JOIN rule USING ({KEY}))"""),
        "replicate_precision_of_many": _with(PREC.replace("prec AS (", "unused AS (") + "," + RAW.removeprefix(READINGS + ",") + """,
            many AS (SELECT *, row_ID || '-' || CharIDText || '-dup' AS result_id, avg(Result) OVER k AS m, count(*) FILTER (sample_type = 'sample') OVER k AS n,
                lag(Result) OVER (PARTITION BY subid, row_ID, CharIDText ORDER BY sample_type DESC, Result) AS prv
              FROM raw WINDOW k AS (PARTITION BY subid, row_ID, CharIDText))""", f"""SELECT {KEY}, result_id, QCcalc, {_r('prec_val')}, DQLA, DQLB,
            CASE WHEN prec_val <= DQLA THEN 'A' WHEN prec_val <= DQLB THEN 'B' ELSE 'C' END AS prec_DQL
            FROM (SELECT {KEY}, result_id, QCcalc, DQLA, DQLB, abs(CASE QCcalc WHEN 'LogDiff' THEN log10(Result) - log10(prv)
                WHEN 'AbsDiff' THEN Result - prv ELSE (Result - prv) / m END) AS prec_val
              FROM many JOIN crit USING (CharIDText) WHERE sample_type = 'dup' AND n > 0)"""),
        "replicate_precision_signed": _with(PREC, series.format(key=KEY, at=AT, grade="prec_DQL")),
        "control_chart_series": _with(PREC, series.format(key=KEY, at=AT, grade="signed_DQL")),
        "batch_summary": _with(BATCH, summary),
        "report_roundtrip": _with(BATCH, summary),
        "qc_applicability": _with(WINDOWS, f"""SELECT subid, actgrp_char, row_ID, prec_DQL,
            {AT}, {TIME.format('ApplicableStart')}, {TIME.format('ApplicableEnd')} FROM win"""),
        "interval_grade": _with(WINDOWS, f"SELECT {KEY}, sample_type, actgrp_char, prec_DQL FROM worst"),
        "interval_grade_overlaps": _with(WINDOWS, f"SELECT {KEY}, sample_type, actgrp_char, prec_DQL FROM hit"),
        "graded_results": _with(WINDOWS, f"""SELECT {KEY}, sample_type, actgrp_char, Result, grp_count, sumofQC, prelim_dql
            FROM graded"""),
        "submission_percentiles": _with(FLAGS, "SELECT subid, CharIDText, " + ", ".join(_r(c) for c in SUB) + " FROM sub_pct"),
        "station_percentiles": _with(FLAGS, "SELECT subid, LASAR_ID, CharIDText, " + ", ".join(_r(c) for c in STATION) + " FROM stn_pct"),
        "anomaly_flags": flags,
        "anomaly_counts": _with(FLAGS, f"SELECT {KEY}, sample_type, {COUNTS} FROM counted"),
        "final_grade": _with(FINAL, f"""SELECT {KEY}, sample_type, result_id, Result, prelim_dql, {TEXT_COUNTS},
            final_DQL, DQLCmt FROM final"""),
        "data_summary": both,
        "qc_summary": _with(PREC, f"""SELECT subid, CharIDText AS charid, QCcalc, count(*) AS Count, round(avg(signed_val), 6) AS Mean,
            round(min(signed_val), 6) AS Min, {QC_COLUMNS}, round(max(signed_val), 6) AS Max,
            count(*) FILTER (signed_DQL = 'A') AS CountA, count(*) FILTER (signed_DQL = 'B') AS CountB,
            count(*) FILTER (signed_DQL = 'C') AS CountCorE, count(*) AS Count_QC,
            round(count(*) FILTER (signed_DQL = 'A') / count(*), 6) AS PercentA,
            round(count(*) FILTER (signed_DQL = 'B') / count(*), 6) AS PercentB,
            round(count(*) FILTER (signed_DQL = 'C') / count(*), 6) AS PercentCorE,
            count(*) FILTER (signed_val IS NULL) AS Count_Missing FROM prec GROUP BY subid, CharIDText, QCcalc"""),
        "box_plot_stats": _with(BOX, """SELECT subid, LASAR_ID, CharIDText, max(n) AS n, min(Result) FILTER (inside) AS ymin,
            round(max(lower), 6) AS lower, round(max(middle), 6) AS middle, round(max(upper), 6) AS upper,
            max(Result) FILTER (inside) AS ymax, count(*) FILTER (NOT inside) AS n_outliers FROM fenced GROUP BY ALL"""),
        "box_plot_outliers": _with(BOX, """SELECT subid, LASAR_ID, CharIDText, Result AS value, count(*) AS occurs
            FROM fenced WHERE NOT inside GROUP BY ALL"""),
        "characteristics_present": _with(RES, "SELECT DISTINCT subid, CharIDText FROM res"),
        "pair_scatter_bands": scatter,
        "stage_resume": scatter,
        "table_activity_group": _with(RES, GROUPS),
        "table_activity": _with(RES + "," + ACTIVITY, f"""SELECT * REPLACE ({TIME.format('StartDateTime')},
            CAST(SmplDepthUnitID AS VARCHAR) AS SmplDepthUnitID),
            {_blank("EndDateTime", "EndDateTimeZoneID", "SmplColMthdID", "SmplColEquip", "SmplEquipID", "SmplColEquipComment")}
            FROM ({_activities(PACIFIC)})"""),
        "table_result": _with(FINAL + "," + RESULT_ROWS, f"""SELECT result_id AS ResultIDText, act_id, num * 10 AS CharID,
            {text_result} AS Result, RsltQual, num % 3 + 1 AS UnitID, num + 200 AS MethodID, MethodSpeciation,
            19 AS RsltTypeID, {NUMBER.format('LOQ')} AS LOQ, num % 3 + 1 AS LOQ_UnitID, OG_ACC AS QCorigACC,
            OG_PREC AS QCorigPREC, OG_DQL AS QCorigDQL, prec_DQL AS DEQ_PREC, {_r('prec_val', 'PrecisionValue')},
            final_DQL AS ORDEQ_DQL, num + 1000 AS StoretQualID, Res_comment AS Org_RsltComment, 7 AS RsltStatusID,
            {_blank("AnalyticalLaboratoryID", "AnalyticalStartTime", "AnalyticalStartTimeZoneID", "AnalyticalEndTime", "AnalyticalEndTimeZoneID",
                    "LabCommentCode", "DEQ_ACC", "BiasValue", "StatisticalBasisID", "RsltTimeBasisID", "DEQ_RsltComment")} FROM out"""),
        "table_anomaly": _with(FLAGS, f"""SELECT result_id, '' AS AnomalyComment, AnomalyTypeID FROM raised
            LEFT JOIN (VALUES {labels}) t(AnomalyTypeID, Anom) USING (Anom)"""),
        "table_group_activity": _with(
            RES + f",\ng AS ({_row_ids('res', GROUP_KEY, 'ActGrpID')}),\na AS ({_row_ids('res', ACT_KEY, 'ActivityID')})",
            f"""SELECT DISTINCT ActGrpID, ActivityID, Date4group AS AG2AComment FROM res JOIN g ON g.k = {GROUP_KEY}
            JOIN a ON a.k = {ACT_KEY}"""),
        "surrogate_keys": _with(RES, _keys("res", "act_id", "ActivityIDText", "ActivityID", 100)),
        "keyed_readback": _with(RES, GROUPS + " WHERE act_group IN (SELECT act_group FROM res WHERE RsltQual = 'R')"),
        "template_source_roundtrip": _with(WIDE + """,
            read AS (SELECT * REPLACE (row_number() OVER (PARTITION BY subid ORDER BY row_ID) AS row_ID) FROM wide WHERE row_ID % 11 <> 0)""",
            " UNION ALL ".join(f"""SELECT subid, row_ID, LASAR_ID, {AT}, '{c}' AS Char, {c} AS Result, {q} AS RsltQual
                FROM read WHERE {c} IS NOT NULL""" for c, q in (("c1_r", "c1_qual"), ("c1d_r", "c1_qual"), ("c2_r", "NULL")))),
        "project_source_roundtrip": _with(RES, """SELECT DISTINCT subid, CharIDText AS CharID, LOQ, Low_QC, UNITS, FieldOrLab
            FROM res WHERE CharIDText <> 'c3'"""),
        "publish_again": _with(RES + f",\ng AS ({GROUPS})", """SELECT 't_ActGrp' AS target, count(*) AS source_rows, count(*) AS batch_rows,
            count(*) FILTER (CAST(substr(ActGrpIDText, 1, 4) AS INTEGER) % 2 = 0) AS already_present,
            count(*) FILTER (CAST(substr(ActGrpIDText, 1, 4) AS INTEGER) % 2 = 1) AS loaded_rows,
            count(*) AS matched_rows, true AS verified FROM g"""),
        "publish_keeps_ids": _with(RES + f",\nk AS (SELECT DISTINCT subid, {ACT_KEY} AS k FROM res)", """SELECT subid AS submission, count(*) AS activities,
            count(*) AS ids, count(*) FILTER (substr(k, 1, 1) < '8') AS kept_ids FROM k GROUP BY subid"""),
        "table_review": _with(FINAL + "," + RESULT_ROWS + f""",\na AS ({_row_ids('res', ACT_KEY, 'ActivityID')}),
            r AS ({_row_ids('res', RESULT_KEY, 'ResultID')})""", f"""SELECT ResultID, ActivityID,
            subid AS SubmissionID, num * 10 AS CharID, {AT.replace('AS "DateTime"', 'AS StartDateTime')},
            Result, RsltQual, num % 3 + 1 AS UnitID, num + 1000 AS StoretQualID, OG_DQL AS QCorigDQL, prec_DQL AS DEQ_PREC,
            prelim_dql AS prelim_DQL, final_DQL, {TEXT_COUNTS.split(', ', 1)[1]}, DQLCmt
            FROM out JOIN a ON a.k = {ACT_KEY} JOIN r ON r.k = {RESULT_KEY}"""),
        "exchange_export": _with(FINAL + "," + RESULT_ROWS + "," + ACTIVITY, f"""SELECT CAST(act_type AS VARCHAR) AS ActivityTypeId,
            MLocID, strftime("DateTime", '%Y-%m-%d') AS StartDate, strftime("DateTime", '%H:%M:%S') AS StartTime,
            '23' AS StartDateTimeZoneID, SampleDepth AS SmplDepth,
            CASE SampleDepthUnit WHEN 'meters' THEN '146' WHEN 'feet' THEN '72' END AS SmplDepthUnitID, Org_Comment,
            'Char ' || CAST(num AS VARCHAR) AS CharAbbr, coalesce(RsltQual, '') || {text_result} AS result,
            UNITS AS UnitIdText, method AS ShortName, MethodSpeciation, '19' AS RsltTypeID, {NUMBER.format('LOQ')} AS LOQ,
            {_r('prec_val', 'PrecisionValue')}, final_DQL AS ORDEQ_DQL,
            CASE WHEN Res_comment IS NOT NULL THEN Res_comment || ':NA' END AS comment,
            {_blank("EndDate", "EndTime", "EndDateTimeZoneID", "SmplColEquipComment", "OrgName", "AnStartDate", "AnStartTime",
                    "AnalyticalStartTimeZoneID", "AnEndDate", "AnEndTime", "AnalyticalEndTimeZoneID", "LabCommentCode", "BiasValue",
                    "StatisticalBasisID", "RsltTimeBasisID")}
            FROM out LEFT JOIN stn USING (LASAR_ID)"""),
        "publish_reconciliation": _with(FINAL + "," + ACTIVITY + f""",
            sizes AS (SELECT 't_ActGrp' AS target, count(*) AS n FROM ({GROUPS})
              UNION ALL SELECT 't_Activity', count(*) FROM (SELECT DISTINCT {ACT_KEY} FROM res)
              UNION ALL SELECT 'tjct_ActGrp2Act', count(*) FROM (SELECT DISTINCT {GROUP_KEY}, {ACT_KEY} FROM res)
              UNION ALL SELECT 't_Result', count(*) FROM res UNION ALL SELECT 't_Anomaly', count(*) FROM raised
              UNION ALL SELECT 'grabdataforreview', count(*) FROM res)""", """SELECT target, n AS source_rows, n AS batch_rows,
            CAST(0 AS BIGINT) AS already_present, n AS loaded_rows, n AS matched_rows, true AS verified FROM sizes"""),
    }
    sql |= {
        "audit_unreadable_stations": _with(READINGS, """SELECT subid, CASE WHEN row_ID % 29 = 0 THEN 'A-' || CAST(LASAR_ID AS VARCHAR) ELSE 'read' END AS text,
            count(*) AS n_rows FROM vis GROUP BY ALL"""),
        "audit_unreadable_limits": _with(RES, """SELECT DISTINCT subid, CharIDText AS CharID, 'LOQ' AS "limit", '<' || CAST(LOQ AS VARCHAR) AS text FROM res WHERE (subid + num) % 3 = 0
            UNION ALL SELECT DISTINCT subid, CharIDText, 'Low_QC', 'none' FROM res WHERE subid % 2 = 0"""),
        "report_data_summary": sql["data_summary"],
        "report_qc_summary": sql["qc_summary"],
        "report_pair_scatter": sql["pair_scatter_bands"],
        "lookup_columns": "WITH " + ACTIVITY.strip() + " SELECT LASAR_ID AS STATION_KEY, StnID, MLocID FROM stn",
        "format_data_results": _with(IDENTIFIED, """SELECT subid, row_ID, Char, CharIDText, sample_type, Result,
            first_value(RsltQual) OVER w AS RsltQual, first_value(Res_comment) OVER w AS Res_comment, UNITS, act_type,
            CAST(DupBatchType AS VARCHAR) AS DupBatchType, LOQ, act_id, act_group, result_id, actgrp_char
            FROM res WINDOW w AS (PARTITION BY subid, row_ID, CharIDText ORDER BY rn)"""),
        "format_data_audits": _with(IDENTIFIED + ",\nwide AS (" + WIDE.split("wide AS (", 1)[1], f"""
            SELECT 'bad_batch' AS audit, count(*) FILTER (act_group = 'ERROR') AS n_rows FROM res
            UNION ALL SELECT 'redundant_result', coalesce(sum(n) FILTER (n > 1), 0)::BIGINT FROM (SELECT count(*) AS n FROM res GROUP BY row_ID, {READING}, Result)
            UNION ALL SELECT 'redundant_act_char', coalesce(sum(n) FILTER (n > 1), 0)::BIGINT FROM (SELECT count(*) AS n FROM res GROUP BY row_ID, {READING})
            UNION ALL SELECT 'name_check', count(*) FILTER (CharIDText = 'c7') FROM res
            UNION ALL SELECT 'orphan_metadata', count(*) FROM ({_metadata_cells(lambda i: f" AND c{i}_r IS NULL AND c{i}d_r IS NULL")})"""),
        "summarise_outputs": "SELECT * FROM (" + " UNION ALL ".join(
            f"SELECT '{name}' AS output, count(*) AS n_rows, CAST(sum({column}) AS BIGINT) AS total FROM ({sql[query]})"
            for name, column, query in (("data_summary", "Count", "data_summary"), ("qc_summary", "Count_QC", "qc_summary"), ("box_plot_stats", "n", "box_plot_stats"),
                                        ("box_plot_outliers", "occurs", "box_plot_outliers"), ("control_chart_series", "row_ID", "control_chart_series"),
                                        ("pair_scatter", "row_ID", "pair_scatter_bands"))) + ")",
    }
    return sql
