"""Settlement inputs derived from the driver's TPC-H-style tables.

The reference ships no data, so its inputs (payments, chargeback cases, fraud
advice, the other system's audit counts, the reconciliation history and the
control table) are derived from ``orders`` and ``lineitem`` by the fixed rules
of FIXTURES.md section B. Every derived frame is lazy and grows with the
driver's tables; nothing here is sampled or capped.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PAYMENT_COLUMNS = [
    "merchant_id", "merchant_name", "organization_id", "organization_name", "method_of_payment_code",
    "settlement_currency_code", "settlement_currency_desc", "payment_id", "settlement_amount",
    "settlement_rpt_precision", "parent_id", "complete_date", "action_type", "ot_start_ts",
    "ot_start_ts_ts", "amount", "txn_reference_number", "created_date", "batch_post_day",
    "transaction_status",
]

CONTROL_SCHEMA = T.StructType([
    T.StructField("table_id", T.IntegerType(), False),
    T.StructField("table_name", T.StringType(), True),
    T.StructField("date_column_name", T.StringType(), True),
    T.StructField("num_days", T.IntegerType(), True),
    T.StructField("count_ind", T.StringType(), True),
    T.StructField("failed_rerun", T.StringType(), True),
    T.StructField("table_type", T.StringType(), True),
    T.StructField("sql", T.StringType(), True),
])

# Fixed values (FIXTURES.md B7): the control rows of the test setup.
CONTROL_ROWS = [
    (1, "orders", "o_orderdate", 1, "Y", "Y", "TRAN", None),
    (2, "lineitem", "l_shipdate", None, "Y", "Y", "TRAN", None),
    (3, "events", "ts", 2, "Y", "N", "DIM", None),
    (4, "customer", None, 0, "N", "N", "DIM", None),
    (5, "no_such_table", "d", 0, "Y", "N", "TRAN", None),
    (6, "Lineitem", "l_shipdate", 1, "Y", "N", "DIM", None),
]

# Tables of the driver that the control rows may name.
COUNTABLE_TABLES = ("orders", "lineitem", "events", "customer")


def _days(col: Column, n: Column) -> Column:
    """``col + n days`` for a timestamp column."""
    return col + F.make_dt_interval(days=n.cast("int"))


def _case(key: Column, mapping: dict, default=None) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(key == k, F.lit(v)) if expr is None else expr.when(key == k, F.lit(v))
    return expr.otherwise(F.lit(default)) if default is not None else expr


@dataclass
class SettlementInputs:
    spark: SparkSession
    sf_dir: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def deposits_raw(self) -> DataFrame:
        o = self.table("orders")
        key = F.col("o_orderkey")
        merchant = F.col("o_custkey") % 20
        day = F.col("o_orderdate").cast("date")
        q = key % 4
        return o.select(
            merchant.alias("merchant_id"),
            F.concat(F.lit("Merchant "), merchant.cast("string")).alias("merchant_name"),
            (merchant % 5).alias("organization_id"),
            F.concat(F.lit("Org "), (merchant % 5).cast("string")).alias("organization_name"),
            F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "VI")
            .when(F.col("o_orderpriority").isin("3-MEDIUM", "4-NOT SPECIFIED"), "MC")
            .otherwise("AX").alias("method_of_payment_code"),
            _case(q, {0: "USD", 1: "JPY", 2: "KWD"}).alias("settlement_currency_code"),
            _case(q, {0: "US Dollar", 1: "Yen", 2: "Kuwaiti Dinar"}).alias("settlement_currency_desc"),
            (key + 1).alias("payment_id"),
            F.when(q == 1, F.round("o_totalprice").cast("bigint"))
            .when(q == 2, F.round(F.col("o_totalprice") * 1000).cast("bigint"))
            .otherwise(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("settlement_amount"),
            F.when(q == 1, 0).when(q == 2, 3).otherwise(2).alias("settlement_rpt_precision"),
            F.lit(None).cast("bigint").alias("parent_id"),
            F.when(key % 13 == 0, F.lit(None).cast("date")).otherwise(day).alias("complete_date"),
            _case(F.col("o_orderstatus"), {"F": "D", "O": "S"}, "A").alias("action_type"),
            day.alias("ot_start_ts"),
            (F.col("o_orderdate") + F.make_dt_interval(hours=F.lit(8))).alias("ot_start_ts_ts"),
            F.round(F.col("o_totalprice") * 100).cast("bigint").alias("amount"),
            F.concat(F.lit("ARN"), key.cast("string")).alias("txn_reference_number"),
            day.alias("created_date"),
            F.date_add(day, (key % 3).cast("int")).alias("batch_post_day"),
            F.when(key % 11 == 0, "0").otherwise("1").alias("transaction_status"),
        )

    def _lines_with_deposit(self, flag: str) -> DataFrame:
        li = self.table("lineitem").where(F.col("l_returnflag") == flag)
        d = self.deposits_raw.alias("d")
        return li.join(d, F.col("d.payment_id") == F.col("l_orderkey") + 1)

    @cached_property
    def refunds_raw(self) -> DataFrame:
        j = self._lines_with_deposit("R")
        line = F.col("l_linenumber")
        shift = (F.col("l_partkey") % 45).cast("int")
        moved = F.date_add(F.col("d.created_date"), shift)
        return j.select(
            *[F.col(f"d.{c}") for c in PAYMENT_COLUMNS[:7]],
            (F.lit(10000000) + F.col("l_orderkey") * 10 + line).alias("payment_id"),
            F.when(line <= 4, F.col("d.settlement_amount"))
            .otherwise(F.round("l_extendedprice").cast("bigint")).alias("settlement_amount"),
            F.col("d.settlement_rpt_precision"),
            F.when(line == 7, F.lit(0).cast("bigint")).otherwise(F.col("d.payment_id")).alias("parent_id"),
            F.when(F.col("l_partkey") % 17 == 0, F.lit(None).cast("date")).otherwise(moved).alias("complete_date"),
            F.when(F.col("l_linestatus") == "F", "R").otherwise("T").alias("action_type"),
            moved.alias("ot_start_ts"),
            _days(F.col("d.ot_start_ts_ts"), shift).alias("ot_start_ts_ts"),
            F.when(line <= 4, F.col("d.amount"))
            .otherwise(F.round("l_extendedprice").cast("bigint")).alias("amount"),
            F.lit(None).cast("string").alias("txn_reference_number"),
            moved.alias("created_date"),
            moved.alias("batch_post_day"),
            F.lit("1").alias("transaction_status"),
        )

    @cached_property
    def payments(self) -> DataFrame:
        """Deposits and refunds in one table, as the reference's payments table."""
        return self.deposits_raw.unionByName(self.refunds_raw)

    @cached_property
    def chargebacks(self) -> DataFrame:
        j = self._lines_with_deposit("A")
        line = F.col("l_linenumber")
        shift = ((F.col("l_partkey") + F.col("l_suppkey")) % 45).cast("int")
        moved = F.date_add(F.col("d.created_date"), shift)
        return j.select(
            F.col("d.payment_id").alias("deposit_id"),
            F.col("l_extendedprice").cast("decimal(18,2)").alias("chargeback_amount"),
            F.col("d.method_of_payment_code"),
            _case(line, {1: "0057", 3: "4837", 4: "0083", 6: "4863"}, "9999").alias("reason_code"),
            moved.alias("issuing_bank_day"),
            _days(F.col("d.ot_start_ts_ts"), shift).alias("issuing_bank_day_ts"),
            moved.alias("open_date"),
            F.when(F.col("l_linestatus") == "F", "D").otherwise("C").alias("type"),
            _case(line % 3, {0: "FIRST_CHARGEBACK", 1: "REPRESENTMENT"}, "ARBITRATION").alias("current_cycle"),
        )

    @cached_property
    def advice(self) -> DataFrame:
        o = self.table("orders").where(F.col("o_orderkey") % 3 != 1)
        shift = (F.col("o_custkey") % 20).cast("int")
        return o.select(
            F.concat(F.lit("ARN"), F.col("o_orderkey").cast("string")).alias("acquirer_ref_number"),
            F.date_add(F.col("o_orderdate").cast("date"), shift).alias("create_date"),
            (_days(F.col("o_orderdate"), shift) + F.make_dt_interval(hours=F.lit(21))).alias("create_date_ts"),
        )

    @cached_property
    def daily_counts(self) -> DataFrame:
        """(t, d, n): rows per day of orders and lineitem."""
        o = (self.table("orders").groupBy(F.col("o_orderdate").cast("date").alias("d"))
             .agg(F.count(F.lit(1)).alias("n")).withColumn("t", F.lit("ORDERS")))
        li = (self.table("lineitem").groupBy(F.col("l_shipdate").cast("date").alias("d"))
              .agg(F.count(F.lit(1)).alias("n")).withColumn("t", F.lit("LINEITEM")))
        return o.unionByName(li)

    def _versions(self) -> DataFrame:
        return self.daily_counts.withColumn("v", F.explode(F.array(F.lit(1), F.lit(2))))

    @cached_property
    def audit(self) -> DataFrame:
        c = self._versions()
        day = F.dayofmonth("d")
        return c.select(
            F.col("t").alias("table_name"),
            F.col("d").alias("target_date"),
            F.when(F.col("v") == 1, F.col("n") + 7).when(day == 15, F.lit(0).cast("bigint"))
            .when(day % 5 == 0, F.col("n") + 1).otherwise(F.col("n")).alias("record_count"),
            F.date_add("d", 1).alias("extract_date"),
            F.concat(F.col("d").cast("string"),
                     F.when(F.col("v") == 1, " 01:00:00").otherwise(" 02:00:00")).alias("inserted_date"),
        )

    @cached_property
    def history(self) -> DataFrame:
        day = F.dayofmonth("d")
        c = self._versions().where((F.col("v") == 1) | (day == 10))
        vap = (F.when(F.col("v") == 2, F.col("n")).when(day == 15, F.lit(0).cast("bigint"))
               .when(day % 5 == 0, F.col("n") + 1).otherwise(F.col("n")))
        return c.select(
            F.lit(1).cast("bigint").alias("gdg_position"),
            F.lit(1).cast("bigint").alias("gdg_txoppos"),
            *[F.lit("1").alias(n) for n in ("gdg_txind", "gdg_opcode", "gdg_timestamp", "gdg_schema", "gdg_table")],
            F.lit(0).cast("bigint").alias("id"),
            F.col("t").alias("table_name"),
            F.col("d").cast("string").alias("count_date"),
            F.col("n").alias("bda_count"),
            vap.alias("vap_count"),
            F.when(F.col("v") == 2, "Y").when(day == 25, "F").when(day % 5 == 0, "N").otherwise("Y").alias("matched"),
            (F.col("n") - vap).alias("count_diff"),
            F.lit("").alias("date_column_name"),
            F.concat(F.col("d").cast("string"), F.lit(" 03:00:00")).alias("inserted_date"),
            F.concat(F.lit("count of "), F.col("t")).alias("runtime_sql"),
            F.when(F.col("v") == 2, F.date_add("d", 3)).otherwise(F.date_add("d", 1)).alias("extract_date"),
        )

    @cached_property
    def control(self) -> DataFrame:
        return self.spark.createDataFrame(CONTROL_ROWS, CONTROL_SCHEMA)

    def countable_tables(self) -> dict[str, DataFrame]:
        return {name.upper(): self.table(name) for name in COUNTABLE_TABLES}


class SharedReferenceInputs(SettlementInputs):
    """The same inputs made awkward (FIXTURES.md B8): one placeholder reference on a third
    of the deposits, two deposits and several advice rows per other reference, two
    descriptions per currency code, '' beside NULL codes, fractional amounts as
    decimal(38,18) with precisions from -1 to 18."""

    @property
    def _order_key(self) -> Column:
        own = F.col("payment_id")
        return F.when(F.col("action_type").isin("R", "T"), F.floor((own - 10000000) / 10) + 1).otherwise(own)

    @staticmethod
    def _reference(k: Column) -> Column:
        return F.when(k % 3 == 0, F.lit("0")).otherwise(F.concat(F.lit("ARN"), (k - k % 2).cast("string")))

    @cached_property
    def payments(self) -> DataFrame:
        base = super().payments.withColumn("k", self._order_key)
        k = F.col("k")
        precision = (k % 20 - 1).cast("int")
        cents = F.col("amount").cast("decimal(18,0)")
        made = {
            "settlement_rpt_precision": precision,
            "settlement_amount": F.when(precision <= 16, cents * F.lit("0.01").cast("decimal(3,2)")).otherwise(cents).cast("decimal(38,18)"),
            "settlement_currency_code": F.when(F.col("settlement_currency_code").isNull() & (k % 2 == 1), F.lit("")).otherwise(
                F.col("settlement_currency_code")),
            "settlement_currency_desc": F.when(k % 5 == 0, F.concat("settlement_currency_desc", F.lit(" (old)"))).otherwise(
                F.col("settlement_currency_desc")),
            "txn_reference_number": F.when(F.col("txn_reference_number").isNotNull(), self._reference(k)),
        }
        return base.select(*[made[c].alias(c) if c in made else F.col(c) for c in PAYMENT_COLUMNS])

    @cached_property
    def chargebacks(self) -> DataFrame:
        return super().chargebacks.withColumn("chargeback_amount", F.col("chargeback_amount").cast("decimal(38,18)"))

    @cached_property
    def advice(self) -> DataFrame:
        base = super().advice
        k = F.substring("acquirer_ref_number", 4, 20).cast("bigint") + 1
        return base.where((k % 3 != 0) | (k % 300 == 0)).withColumn("acquirer_ref_number", self._reference(k))


def settlement_inputs(spark: SparkSession, sf_dir: str, shared_references: bool = False) -> SettlementInputs:
    kind = SharedReferenceInputs if shared_references else SettlementInputs
    return kind(spark, sf_dir.rstrip("/"))
