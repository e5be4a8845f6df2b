"""Hospital-table roles over the driver's test tables.

The test data has no hospital tables, so each raw table is a view over the
order/customer tables, built with deterministic expressions that also inject
the dirty values the cleaning stages must handle (bad dates, blank and
tab-padded codes, unparsable numbers, missing ids).  The same views are
written as SQL for the oracle in ``plans/oracle.py``.

Roles: patients = customer; admissions = orders; diagnoses, prescriptions and
lab events = line items of an order (with the part for names and brands);
ICU stays = orders that are not open.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow.session import Lazy


def _read(spark: SparkSession, sf_dir: str, name: str, cols: list[str]) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*cols)


def _s(c: str):
    return F.col(c).cast("string")


def _lpad_num(c, width: int, pad: str):
    return F.lpad(c.cast("string"), width, pad)


def subject(key: str):
    """Patient id text of a customer key: some ids are not numbers, and every
    twentieth customer's orders belong to patient 1, whose history is long."""
    c = F.col(key)
    return F.when(c % 41 == 7, F.concat(F.lit("P"), c.cast("string"))).when(c % 20 == 1, F.lit("1")).otherwise(c.cast("string"))


def plain_code(pk):
    return _lpad_num(pk % 10000, 5, "0")


def role_tables(spark: SparkSession, sf_dir: str, hold=None) -> Lazy:
    """The six raw tables (all columns string) derived from ``sf_dir``.

    Tables are built on first access.  The three line-item roles share one join
    of line items with their order and part; ``hold`` (e.g. ``session.materialize``)
    is applied to that one wide table when the first of them is read.
    """
    null = F.lit(None).cast("string")

    def orders():
        return _read(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"])

    def patients():
        # Some cohort patients have no patient row (events without a label).
        customer = _read(spark, sf_dir, "customer", ["c_custkey", "c_acctbal"]).filter(F.col("c_custkey") % 37 != 5)
        sid = F.when(F.col("c_custkey") % 41 == 7, F.concat(F.lit("P"), _s("c_custkey"))).otherwise(_s("c_custkey"))
        return customer.select(sid.alias("SUBJECT_ID"), F.when(F.col("c_acctbal") < 0, F.lit("x")).alias("DOD_HOSP"))

    def admissions():
        key = F.col("o_orderkey")
        # Impossible dates, and patients all of whose dates are partial.
        partial = F.when(key % 2 == 0, F.date_format("o_orderdate", "yyyy")).otherwise(F.date_format("o_orderdate", "yyyy-MM"))
        whole = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(" "), _lpad_num(key % 24, 2, "0"), F.lit(":00:00"))
        admit = (
            F.when(key % 199 == 0, F.concat(F.date_format("o_orderdate", "yyyy"), F.lit("-13-45 00:00:00")))
            .when(F.col("o_custkey") % 31 == 3, partial)
            .otherwise(whole)
        )
        # Every 101st admission is listed twice.
        times = F.explode(F.when(key % 101 == 9, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("times")
        rows = orders().select(subject("o_custkey").alias("SUBJECT_ID"), _s("o_orderkey").alias("HADM_ID"), admit.alias("ADMITTIME"), times)
        return rows.drop("times")

    def icustays():
        return orders().select(
            subject("o_custkey").alias("SUBJECT_ID"),
            _s("o_orderkey").alias("HADM_ID"),
            F.when(F.col("o_orderstatus") == "O", null).otherwise(_s("o_orderkey")).alias("ICUSTAY_ID"),
            F.when(F.col("o_orderkey") % 11 == 0, null).otherwise((F.col("o_totalprice") / F.lit(10000)).cast("string")).alias("LOS"),
        )

    def wide():
        # Line items of an order, with their part (left join: a line item without
        # a part still is a diagnosis row; medication and lab rows need the part).
        lineitem = _read(spark, sf_dir, "lineitem", ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity"])
        part = _read(spark, sf_dir, "part", ["p_partkey", "p_name", "p_brand"])
        # Parts are hashed after the shuffle, so that only the orders sort the line items: an
        # order's rows stay side by side, which packs their ids well here and in later shuffles.
        lip = lineitem.join(part.hint("shuffle_hash"), F.col("l_partkey") == F.col("p_partkey"), "left")
        lip = lip.join(orders().select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        # Held as texts: a filter that moves down to a read would make each of them again
        # at every mention.
        texts = with_texts(lip)
        texts = hold(texts) if hold is not None else texts
        return texts.withColumn("LAB_HADM_ID", F.when(F.col("HAS_LAB_HADM"), F.col("HADM_ID")))

    def with_texts(lip: DataFrame) -> DataFrame:
        pk, ok, sk = F.col("l_partkey"), F.col("l_orderkey"), F.col("l_suppkey")
        plain = plain_code(pk)
        code = (
            F.when(pk % 61 == 0, null)
            .when(pk % 53 == 0, F.lit("   "))
            .when(pk % 59 == 0, F.concat(F.lit("\t"), plain, F.lit(" ")))
            .when(pk % 10 == 0, F.concat(F.lit("E"), _lpad_num(pk % 1000, 4, "8")))
            .otherwise(plain)
        )
        # A drug of one patient only (unknown outside its split), a drug named
        # like a diagnosis category, and an empty name.
        drug = (
            F.when(ok % 97 == 5, F.concat(F.lit("rare "), _s("o_custkey")))
            .when(ok % 89 == 7, F.substring(plain, 1, 3))
            .when((F.col("l_linenumber") == 3) & (pk % 7 == 0), F.lit(""))
            .when(F.col("l_linenumber") % 2 == 0, F.concat(F.lit("  "), F.upper("p_name"), F.lit(" ")))
            .otherwise(F.col("p_name"))
        )
        value = F.when(sk % 13 == 0, F.lit("n/a")).when(sk % 17 == 0, F.lit("")).otherwise(_s("l_quantity"))
        return lip.select(
            subject("o_custkey").alias("SUBJECT_ID"),
            _s("l_orderkey").alias("HADM_ID"),
            code.alias("ICD9_CODE"),
            F.col("p_partkey").isNotNull().alias("HAS_PART"),
            drug.alias("DRUG"),
            F.coalesce(sk % 19 != 0, F.lit(True)).alias("HAS_LAB_HADM"),
            F.when(pk % 43 == 0, null).otherwise(F.col("p_brand")).alias("ITEMID"),
            value.alias("VALUENUM"),
        )

    shared = Lazy({"wide": wide})

    def with_part():
        return shared["wide"].filter(F.col("HAS_PART"))

    return Lazy(
        {
            "admissions": admissions,
            "diagnoses": lambda: shared["wide"].select("SUBJECT_ID", "HADM_ID", "ICD9_CODE"),
            "icustays": icustays,
            "labevents": lambda: with_part().select("SUBJECT_ID", F.col("LAB_HADM_ID").alias("HADM_ID"), "ITEMID", "VALUENUM"),
            "patients": patients,
            "prescriptions": lambda: with_part().select("SUBJECT_ID", "HADM_ID", "DRUG"),
        }
    )


def event_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as a direct event source: patient = user, token = event type,
    visit = calendar day of the event time, value = event value."""
    ev = _read(spark, sf_dir, "events", ["user_id", "ts", "event_type", "value"])
    day_ms = (F.unix_date(F.to_date("ts")).cast("bigint") * F.lit(86_400_000)).cast("bigint")
    return ev.select(
        F.col("user_id").cast("bigint").alias("patient_id"),
        day_ms.alias("admit_ms"),
        F.col("event_type").alias("event_type"),
        F.col("value").cast("double").alias("value"),
    )
