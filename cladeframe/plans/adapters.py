"""Domain tables made from the driver's tables, and the same as SQL for the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import cigars as C
from ..functions import sequences as S


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def allele_depths(spark: SparkSession, d: str) -> DataFrame:
    """(site, sample, ad, lens): depths of three alleles, the third of length 3."""
    n = lambda f: F.sum(F.when(F.col("l_returnflag") == f, 1).otherwise(0)).cast("int")
    li = table(spark, d, "lineitem")
    return li.groupBy(F.col("l_partkey").alias("site"), (F.col("l_suppkey") % 4).cast("int").alias("sample")).agg(F.array(n("A"), n("N"), n("R")).alias("ad")).withColumn("lens", F.array(F.lit(1), F.lit(1), F.lit(3)))


AD = """ad AS (SELECT l_partkey AS site, CAST(l_suppkey % 4 AS INTEGER) AS sample, CAST(count(*) FILTER (l_returnflag = 'A') AS INTEGER) AS a0,
  CAST(count(*) FILTER (l_returnflag = 'N') AS INTEGER) AS a1, CAST(count(*) FILTER (l_returnflag = 'R') AS INTEGER) AS a2 FROM lineitem GROUP BY 1, 2)"""


def reads(spark: SparkSession, d: str) -> DataFrame:
    """Aligned reads of order lines; the CIGAR is clip, match, insertion, deletion, match."""
    q, n = F.col("l_quantity").cast("int"), F.col("l_linenumber").cast("int")
    li = table(spark, d, "lineitem").withColumn("q", q).withColumn("n", n)
    text = F.concat(F.col("n") % 3, F.lit("S"), F.col("q"), F.lit("M"), F.col("n"), F.lit("I"), F.col("q") % 7, F.lit("D"), F.col("q"), F.lit("M"))
    return li.select(
        (F.col("l_orderkey") * 10 + F.col("n")).alias("rid"), F.col("l_orderkey").alias("qname"), F.col("n").alias("mate"), (F.col("l_suppkey") % 4).cast("int").alias("sample"), (F.col("l_suppkey") % 5).cast("int").alias("tid"),
        ((F.col("l_partkey") * 3 + F.col("l_linenumber")) % 5).cast("int").alias("mtid"), (F.col("l_partkey") * 10 + F.col("l_linenumber")).alias("start"), (F.col("l_partkey") * 10 + F.col("l_linenumber") + F.col("q")).alias("end"),
        ((F.col("l_orderkey") * 7 + F.col("l_linenumber") * 13 + F.col("l_suppkey")) % 4096).cast("int").alias("flag"), (F.col("l_partkey") % 61).cast("int").alias("mapq"), C.parse(text).alias("cigar"), text.alias("cigar_text"),
        (F.col("n") % 3 + 2 * F.col("q") + F.col("n")).alias("length"), F.round(F.col("l_discount") * 100).cast("int").alias("nm"), F.round(F.col("l_tax") * 500).cast("int").alias("qual"),
        F.when(F.col("l_linestatus") == "O", "Long").otherwise("Short").alias("read_type"), F.col("l_returnflag").alias("allele"),
    )


READS = """reads AS (SELECT l_orderkey * 10 + n AS rid, l_orderkey AS qname, n AS mate, CAST(l_suppkey % 4 AS INTEGER) AS sample, CAST(l_suppkey % 5 AS INTEGER) AS tid,
  CAST((l_partkey * 3 + n) % 5 AS INTEGER) AS mtid, l_partkey * 10 + n AS s, l_partkey * 10 + n + q AS e, CAST((l_orderkey * 7 + n * 13 + l_suppkey) % 4096 AS INTEGER) AS flag, CAST(l_partkey % 61 AS INTEGER) AS mapq,
  (n % 3) || 'S' || q || 'M' || n || 'I' || (q % 7) || 'D' || q || 'M' AS cigar_text, n % 3 + 2 * q + n AS length, CAST(round(l_discount * 100) AS INTEGER) AS nm, CAST(round(l_tax * 500) AS INTEGER) AS qual,
  CASE WHEN l_linestatus = 'O' THEN 'Long' ELSE 'Short' END AS read_type, l_returnflag AS allele, n, q
  FROM (SELECT *, CAST(l_quantity AS INTEGER) AS q, CAST(l_linenumber AS INTEGER) AS n FROM lineitem))"""


def regions(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    return p.select(F.col("p_partkey").alias("region"), (F.col("p_size") % 5).cast("int").alias("r_tid"), (F.col("p_partkey") * 10).alias("r_start"), (F.col("p_partkey") * 10 + F.col("p_size")).alias("r_end"))


REGIONS = "regions AS (SELECT p_partkey AS region, CAST(p_size % 5 AS INTEGER) AS r_tid, p_partkey * 10 AS r_start, p_partkey * 10 + p_size AS r_end FROM part)"


def activity(spark: SparkSession, d: str) -> DataFrame:
    """(tid, pos, prob): per user class and minute the mean of values over 100, at most 1; minutes count from the first."""
    e = table(spark, d, "events").select((F.col("user_id") % 3).cast("int").alias("tid"), F.floor(F.unix_timestamp("ts") / 600).alias("m"), "value")
    low = e.agg(F.min("m").alias("m0"))
    return e.crossJoin(F.broadcast(low)).groupBy("tid", (F.col("m") - F.col("m0")).alias("pos")).agg(F.round(F.least(F.avg(F.abs("value")) / 100, F.lit(1.0)), 6).alias("prob"))


ACTIVITY = """act AS (SELECT tid, m - (SELECT min(CAST(floor(epoch(ts) / 600) AS BIGINT)) FROM events) AS pos, round(least(avg(abs(value)) / 100, 1.0), 6) AS prob
  FROM (SELECT CAST(user_id % 3 AS INTEGER) AS tid, CAST(floor(epoch(ts) / 600) AS BIGINT) AS m, value FROM events) GROUP BY 1, 2)"""


def sequences(spark: SparkSession, d: str) -> DataFrame:
    """(doc_id, seq): whole texts as bases."""
    return table(spark, d, "documents").select("doc_id", S.as_dna(F.col("text")).alias("seq"))


SEQS = "seqs AS (SELECT doc_id, translate(regexp_replace(lower(text), '[^a-z]', '', 'g'), 'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTACGTACGTACGTAC') AS seq FROM documents)"


def alleles(spark: SparkSession, d: str) -> DataFrame:
    """(key, ref, alt): short alleles from part names and types."""
    p = table(spark, d, "part")
    base = lambda c: S.as_dna(F.col(c))
    return p.select(F.col("p_partkey").alias("key"), F.substr(F.concat(F.lit("A"), base("p_brand"), base("p_type")), F.lit(1), (F.col("p_size") % 4 + 1).cast("int")).alias("ref"), F.substr(F.concat(F.lit("A"), base("p_type"), base("p_brand")), F.lit(1), (F.col("p_partkey") % 4 + 1).cast("int")).alias("alt"))


_DNA = "translate(regexp_replace(lower({}), '[^a-z]', '', 'g'), 'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTACGTACGTACGTAC')"
ALLELES = f"""alleles AS (SELECT p_partkey AS key, substr('A' || {_DNA.format("p_brand")} || {_DNA.format("p_type")}, 1, CAST(p_size % 4 + 1 AS INTEGER)) AS ref,
  substr('A' || {_DNA.format("p_type")} || {_DNA.format("p_brand")}, 1, CAST(p_partkey % 4 + 1 AS INTEGER)) AS alt FROM part)"""


def likelihoods(spark: SparkSession, d: str) -> DataFrame:
    """(site, sample, read, lks): log10 likelihoods of three alleles."""
    li = table(spark, d, "lineitem")
    return li.select(F.col("l_partkey").alias("site"), (F.col("l_suppkey") % 4).cast("int").alias("sample"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("read"), F.array(-F.round(F.col("l_discount") * 10, 2), -F.round(F.col("l_tax") * 10, 2), -F.round(F.col("l_quantity") / 25, 2)).alias("lks"))


LKS = """lk AS (SELECT l_partkey AS site, CAST(l_suppkey % 4 AS INTEGER) AS sample, l_orderkey * 10 + l_linenumber AS read,
  -round(l_discount * 10, 2) AS k0, -round(l_tax * 10, 2) AS k1, -round(l_quantity / 25, 2) AS k2 FROM lineitem)"""
