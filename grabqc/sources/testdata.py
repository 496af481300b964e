"""The order and line-item test tables read as grab-sample submissions.

Line items that share an order and a line number act as primary and replicate readings of one
characteristic; the order is the visit. See FIXTURES.md for the mapping.
"""

import os

from pyspark.sql import Window
from pyspark.sql import functions as F

from grabqc.operators.anomalies import RULES
from grabqc.operators.identity import with_identifiers
from grabqc.sources.tables import spread

CHARACTERISTICS = 7
NEXT_VISIT = 1_000_000_000_000  # added to an order's number for each further visit
TIE_BREAK = ["l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_shipdate",
             "l_returnflag", "l_linestatus"]


def table(spark, sf_dir, name):
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def visits(spark, sf_dir):
    """One row per order: the attributes a visit has whatever is measured there."""
    return table(spark, sf_dir, "orders").selectExpr(
        "year(o_orderdate) AS subid", "o_orderkey AS row_ID", "10000 + o_custkey % 100 AS LASAR_ID",
        "timestampadd(MINUTE, o_orderkey % 1440, o_orderdate) AS DateTime",
        "concat('S', cast(o_custkey % 5 AS string)) AS samplers", "cast(o_orderkey % 10 AS string) AS SampleDepth",
        "CASE o_orderkey % 3 WHEN 0 THEN 'meters' WHEN 1 THEN 'feet' END AS SampleDepthUnit",
        "CASE WHEN o_orderpriority = '1-URGENT' THEN 'urgent' END AS Org_Comment",
        "CASE WHEN o_custkey % 10 = 0 THEN 'check' END AS DEQ_Comment")


def readings(spark, sf_dir):
    """Every line item. Those of one order and line number make pairs: primary, then replicate.

    The first pair belongs to the order's visit. Each further pair is a later visit, a minute
    after the one before, with a row number of its own. Rows are dealt out by order once, which serves the join with the
    visits too.
    """
    key = Window.partitionBy("l_orderkey", "l_linenumber").orderBy(*TIE_BREAK)
    return (spread(table(spark, sf_dir, "lineitem"), "l_orderkey").withColumn("place", F.row_number().over(key) - 1)
            .withColumn("pair", F.expr("place div 2"))
            .selectExpr(
                "l_orderkey AS order_key", "pair", f"l_orderkey + pair * {NEXT_VISIT} AS row_ID", "l_linenumber AS num",
                "place % 2 + 1 AS rn", "cast(l_quantity AS double) AS Result",
                "CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS RsltQual",
                "CASE WHEN l_linestatus = 'F' THEN 'late' END AS Res_comment",
                "CASE WHEN l_tax < 0.03D THEN 'A' WHEN l_tax < 0.06D THEN 'B' END AS OG_ACC",
                "CASE WHEN l_discount < 0.04D THEN 'A' WHEN l_discount < 0.08D THEN 'B' END AS OG_PREC",
                "CASE WHEN l_tax < 0.02D THEN 'A' WHEN l_discount < 0.05D THEN 'B' END AS OG_DQL"))


def _at_visits(rows, spark, sf_dir):
    """Rows of readings with the attributes and the time of their visit."""
    visit = visits(spark, sf_dir).withColumnRenamed("row_ID", "order_key")
    return (rows.join(visit, "order_key").withColumn("DateTime", F.expr("timestampadd(MINUTE, pair, DateTime)"))
            .drop("order_key", "pair"))


def _batch_type(subid):
    return F.when(subid % 4 == 1, 449).when(subid % 4 == 2, 450).otherwise(448)


def results(spark, sf_dir):
    """Long, identified results of all submissions."""
    return with_identifiers(plain_results(spark, sf_dir))


def plain_results(spark, sf_dir):
    """Long results before their identifiers, which follow from the other columns."""
    rows = _at_visits(readings(spark, sf_dir), spark, sf_dir)
    kept = [c for c in rows.columns if c not in ("num", "rn")]
    return rows.selectExpr(
        *kept, "concat('c', cast(num AS string)) AS CharIDText",
        "concat('c', cast(num AS string), if(rn = 2, 'd_r', '_r')) AS Char", "if(rn = 2, 'dup', 'sample') AS sample_type",
        "cast(num + 1 AS double) AS LOQ", "CASE WHEN num <> 7 THEN cast(20 + num AS double) END AS Low_QC",
        "if(num % 2 = 1, 'Field', 'Lab') AS FieldOrLab", "concat('u', cast(num % 3 AS string)) AS UNITS",
        "concat('M', cast(num AS string)) AS `Method Short Name`", "CASE WHEN num % 2 = 0 THEN 'as N' END AS MethodSpeciation",
        "if(num % 2 = 1, if(rn = 2, 158, 149), if(rn = 2, 313, 233)) AS act_type",
        "if(num % 2 = 1, if(rn = 2, 'FD', 'FM'), if(rn = 2, 'LD', 'LM')) AS TypeIDText",
        "CASE subid % 4 WHEN 1 THEN 449 WHEN 2 THEN 450 ELSE 448 END AS DupBatchType",
        "100 + subid % 3 AS SubOrganizationID")


def template(spark, sf_dir):
    """Wide template: one row per visit, one column per characteristic, class and metadata."""
    columns = []
    for i in range(1, CHARACTERISTICS + 1):
        columns += [f"max(if(num = {i} AND rn = 1, Result, NULL)) AS c{i}_r",
                    f"max(if(num = {i} AND rn = 2, Result, NULL)) AS c{i}d_r"]
        columns += [f"max(if(num = {i} AND rn = 1, {source}, NULL)) AS c{i}_{suffix}"
                    for suffix, source in (("qual", "RsltQual"), ("cmnt", "Res_comment"), ("ACC", "OG_ACC"),
                                           ("PREC", "OG_PREC"), ("DQL", "OG_DQL"))]
    columns = [F.expr(c) for c in columns]
    return _at_visits(readings(spark, sf_dir).groupBy("order_key", "pair", "row_ID").agg(*columns), spark, sf_dir)


def raw_readings(spark, sf_dir):
    """Every line item as a reading, so that some visits hold the same reading several times."""
    li = spread(table(spark, sf_dir, "lineitem"), "l_orderkey").select(
        F.col("l_orderkey").alias("row_ID"), F.concat(F.lit("c"), F.col("l_linenumber").cast("string")).alias("CharIDText"),
        F.when(F.col("l_returnflag") == "R", "dup").otherwise("sample").alias("sample_type"),
        F.col("l_quantity").cast("double").alias("Result"))
    return li.join(visits(spark, sf_dir).select("row_ID", "subid", "LASAR_ID", "DateTime"), "row_ID")


def raw_results(spark, sf_dir):
    """Raw readings as results: a visit may hold any number of primaries and replicates."""
    return raw_readings(spark, sf_dir).selectExpr(
        "*", "concat_ws('-', subid, CharIDText) AS actgrp_char", "cast(NULL AS double) AS Low_QC",
        "concat_ws('-', row_ID, CharIDText, sample_type) AS result_id")


def _numbers(spark):
    return spark.range(1, CHARACTERISTICS + 1).select(F.col("id").cast("int").alias("n"))


def _code():
    return F.concat(F.lit("c"), F.col("n").cast("string"))


def characteristics(spark):
    return _numbers(spark).select((F.col("n") * 10).alias("CharID"), _code().alias("CharIDText"),
                                  F.concat(F.lit("Char "), F.col("n").cast("string")).alias("CharAbbr"),
                                  (1000 + F.col("n")).alias("StoretUniqueID"))


def precision_criteria(spark, several=False):
    """One rule per characteristic; with ``several``, both difference rules where either applies."""
    kind = F.col("n") % 3
    relative = F.struct(F.lit("RPD").alias("QCcalc"), F.lit(0.3).alias("DQLA"), F.lit(0.8).alias("DQLB"))
    absolute = F.struct(F.lit("AbsDiff").alias("QCcalc"), F.lit(5.0).alias("DQLA"), F.lit(15.0).alias("DQLB"))
    log = F.struct(F.lit("LogDiff").alias("QCcalc"), F.lit(0.2).alias("DQLA"), F.lit(0.5).alias("DQLB"))
    both = F.array(relative, absolute)
    rules = (F.when(kind == 0, both if several else F.array(relative))
             .when(kind == 1, both if several else F.array(absolute)).otherwise(F.array(log)))
    return (_numbers(spark).select((F.col("n") * 10).alias("charid"), _code().alias("charidText"), F.explode(rules).alias("r"))
            .select("charid", "charidText", "r.*"))


def anomaly_criteria(spark):
    n = F.col("n")
    return _numbers(spark).select(
        (n + 500).alias("AnomCritID"), (n * 10).alias("charid"), _code().alias("charidText"),
        F.when(n != 7, F.lit(2.0)).alias("RealRngL"), F.lit(49.0).alias("RealRngU"),
        F.lit(2.0).alias("amb01L"), F.lit(4.0).alias("amb05L"), F.lit(46.0).alias("amb95U"), F.lit(49.0).alias("amb99U"),
        F.when(n % 2 == 0, F.lit(3.0)).alias("stdL"), (44 + n).cast("double").alias("stdU"),
        F.lit(None).cast("double").alias("stdLlp"), (47 + n % 3).cast("double").alias("stdUlp"))


def types(spark):
    activity = [(158, "FD"), (149, "FM"), (313, "LD"), (233, "LM")]
    labels = [(401 + i, label) for i, (_, label, *_) in enumerate(RULES)]
    rows = ", ".join(f"({i}, '{text}', 'short {i}')" for i, text in activity + labels)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(TypeID, TypeIDText, TypeShortName)")


def submissions(spark, sf_dir, gaps=False):
    """One row per year of orders; with ``gaps``, every fifth has no batch type."""
    years = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("SubID")).distinct()
    kind = _batch_type(F.col("SubID"))
    return years.select("SubID", (F.when(F.col("SubID") % 5 != 0, kind) if gaps else kind).alias("DupBatchType"),
                                    (100 + F.col("SubID") % 3).alias("SubOrganizationID"))


def project(spark, sf_dir):
    """Project info: the characteristics of each submission."""
    n = F.col("n")
    return (
        submissions(spark, sf_dir)
        .select(F.col("SubID").alias("subid"), F.explode(F.sequence(F.lit(1), F.lit(CHARACTERISTICS))).alias("n"))
        .select("subid", _code().alias("CharID"), (n + 1).cast("double").alias("LOQ"),
                F.when(n != 7, (20 + n).cast("double")).alias("Low_QC"),
                F.when(n % 2 == 1, "Field").otherwise("Lab").alias("FieldOrLab"),
                F.concat(F.lit("u"), (n % 3).cast("string")).alias("UNITS"),
                F.concat(F.lit("M"), n.cast("string")).alias("Method Short Name"),
                F.when(n % 2 == 0, "as N").alias("MethodSpeciation")))


def stations(spark, sf_dir):
    """Stations met in the customer table: at most one hundred, by construction of the key."""
    k = F.col("c_custkey") % 100
    return table(spark, sf_dir, "customer").select(k.cast("int").alias("k")).distinct().select(
        (10000 + F.col("k")).cast("bigint").alias("STATION_KEY"), (F.col("k") + 1).alias("StnID"),
        F.concat(F.lit("Station "), F.col("k").cast("string")).alias("StationDes"),
        F.concat(F.lit("ML-"), F.col("k").cast("string")).alias("MLocID"),
        F.concat(F.lit("ctx"), (F.col("k") % 4).cast("string")).alias("ContextID"))


def context(spark):
    return spark.range(4).select(F.concat(F.lit("ctx"), F.col("id").cast("string")).alias("CntextIdText"))


def units(spark):
    return spark.range(3).select((F.col("id") + 1).cast("int").alias("UnitID"),
                                 F.concat(F.lit("u"), F.col("id").cast("string")).alias("UnitIdText"))


def methods(spark, complete=True):
    rows = _numbers(spark).select((F.col("n") + 200).alias("MethodID"), F.concat(F.lit("M"), F.col("n").cast("string")).alias("ShortName"))
    return rows if complete else rows.where(F.col("MethodID") != 204)


def organisations(spark):
    return _numbers(spark).select(F.col("n").alias("OrgID"), F.concat(F.lit("Org "), F.col("n").cast("string")).alias("OrgName"))


def lookups(spark, sf_dir):
    return {"characteristics": characteristics(spark), "types": types(spark), "stations": stations(spark, sf_dir),
            "context": context(spark), "units": units(spark), "methods": methods(spark),
            "organisations": organisations(spark)}
