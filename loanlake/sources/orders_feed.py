"""The four source tables derived from an ``orders`` table, for tests and measurements.

Customers are the customers of orders in each month they order in, loans are orders with one ledger row for each of
eleven months. Loans start on the day of the order, so months on book and installments differ. The values include
every defect the cleaning steps handle: unclean, blank and missing ids, repeated customer rows, numbers with
underscores, decimal tails or nothing before the point, missing values, unmatched keys, zero due amounts, overdue
amounts just above a whole number of installments, and negative amounts.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlake import schemas as s

INSTALLMENTS = 10


def _every(c: Column, n: int, rest: int = 0) -> Column:
    return c % n == rest


def _pick(c: Column, n: int, values: dict, otherwise: Column) -> Column:
    """The value listed for the remainder of ``c`` by ``n``; a Python None means NULL."""
    chosen = None
    for rest, value in values.items():
        value = value if isinstance(value, Column) else F.lit(value).cast("string")
        chosen = F.when(c % n == rest, value) if chosen is None else chosen.when(c % n == rest, value)
    return chosen.otherwise(otherwise)


def _text(c: Column, tail: str = "", head: str = "") -> Column:
    return F.concat(F.lit(head), c.cast("string"), F.lit(tail))


def _customer_id(c: Column) -> Column:
    return (
        F.when(_every(c, 499, 8), F.lit("   "))
        .when(_every(c, 7), _text(c, " ", " cus_"))
        .when(_every(c, 101), F.lit(None))
        .otherwise(_text(c, head="CUS_"))
    )


def _customer_months(orders: DataFrame, skip: int) -> DataFrame:
    """Each customer and month with an order, but for one in ``skip`` so that some loans find no match.

    One customer in 53 has every row twice.
    """
    month = F.trunc(F.col("o_orderdate").cast("date"), "MM")
    keys = orders.select(F.col("o_custkey").alias("c"), month.alias(s.SNAPSHOT)).distinct()
    keys = keys.withColumn("m", F.month(s.SNAPSHOT)).where((F.col("c") + F.col("m")) % skip != 0)
    times = F.when(_every(F.col("c"), 53), F.lit(2)).otherwise(F.lit(1))
    return keys.withColumn("copy", F.explode(F.array_repeat(F.lit(True), times))).drop("copy")


def _finish(df: DataFrame, columns: dict[str, Column], table: str) -> DataFrame:
    columns = {s.CUSTOMER: _customer_id(F.col("c")), s.SNAPSHOT: F.col(s.SNAPSHOT), **columns}
    return df.select(*[columns[name].alias(name) for name in s.BRONZE[table].names])


def _share(c: Column, n: int) -> Column:
    """Some features have decimals, and some are larger than a 32-bit number."""
    return F.when(_every(c + n, 31), F.lit(0.75)).when(_every(c + n, 29), F.lit(3e9)).otherwise(F.lit(0.0))


def clickstream(orders: DataFrame) -> DataFrame:
    c, m = F.col("c"), F.col("m")
    features = {
        f"fe_{n}": F.when(~_every(c + n, 23), ((c * 31 + m * 7 + 17 * n) % 400 - 100 + _share(c, n)).cast("double"))
        for n in range(1, 21)
    }
    return _finish(_customer_months(orders, 10), features, "clickstream")


def attributes(orders: DataFrame) -> DataFrame:
    c = F.col("c")
    years = 18 + c % 60
    return _finish(
        _customer_months(orders, 12),
        {
            "Name": F.when(~_every(c, 13), _text(c, " ", "  Customer ")),
            "Age": _pick(c, 10, {0: _text(years, "_"), 1: "-500", 2: "8698", 3: None, 4: _text(years, ".0")}, _text(years)),
            "SSN": _pick(c, 5, {0: "#F%$D@*&8"}, _text(1000 + c, head="000-00-")),
            "Occupation": _pick(c, 4, {0: "_______", 1: "Media_Manager", 2: None}, F.lit(" Teacher ")),
        },
        "attributes",
    )


def financials(orders: DataFrame) -> DataFrame:
    c, m = F.col("c"), F.col("m")

    def dirty(value: Column, null_every: int, mark_every: int, head: str = "", tail: str = "_") -> Column:
        return (
            F.when(_every(c + m, null_every), F.lit(None))
            .when(_every(c + m, mark_every), _text(value, tail, head))
            .otherwise(_text(value))
        )

    return _finish(
        _customer_months(orders, 14),
        {
            "Annual_Income": dirty(7000 + c % 200 * 1000, 17, 5),
            "Monthly_Inhand_Salary": _pick(c, 6, {0: None, 1: ".5"}, _text(500 + c % 90 * 10, ".25")),
            "Num_Bank_Accounts": _text(c % 11 - 1),
            "Num_Credit_Card": _text(c % 12, ".0"),
            "Interest_Rate": _pick(c, 19, {0: None}, _text(1 + c % 34)),
            "Num_of_Loan": dirty(c % 9 - 1, 15, 4),
            "Type_of_Loan": _pick(c, 3, {0: None, 1: " Auto Loan, and Student Loan "}, F.lit("Payday Loan")),
            "Delay_from_due_date": _text(c % 67 - 5),
            "Num_of_Delayed_Payment": dirty(c % 28 - 2, 14, 6),
            "Changed_Credit_Limit": _pick(c, 8, {0: "_"}, _text(c % 40 - 5, ".5")),
            "Num_Credit_Inquiries": _pick(c, 18, {0: None}, _text(c % 17, ".0")),
            "Credit_Mix": _pick(c, 6, {0: "_", 1: "Bad", 2: "Good", 3: "Standard", 4: None}, F.lit("good")),
            "Outstanding_Debt": dirty(c % 5000, 21, 9),
            "Credit_Utilization_Ratio": _pick(c, 29, {0: None}, _text(20 + c % 70, ".5")),
            "Credit_History_Age": _pick(
                c,
                5,
                {0: None, 1: "NA", 2: "1 Year and 3 Months"},
                F.concat(_text(c % 33, " Years and "), _text(m, " Months")),
            ),
            "Payment_of_Min_Amount": _pick(c, 4, {0: "NM", 1: "Yes", 2: " no "}, F.lit(None)),
            "Total_EMI_per_month": _pick(c, 31, {0: None}, _text(c % 300, ".75")),
            "Amount_invested_monthly": dirty(c % 1000, 16, 7, "__", "__"),
            "Payment_Behaviour": _pick(
                c, 9, {0: None, 1: "!@9#%8"}, F.lit(" High_spent_Small_value_payments ")
            ),
            "Monthly_Balance": _pick(
                c, 50, {0: "__-333333333333333333333333333__"}, _text(c % 900, ".125")
            ),
        },
        "financials",
    )


def loans(orders: DataFrame) -> DataFrame:
    """One row per order and installment, built row by row without a join."""
    key, k = F.col("o_orderkey"), F.col("k")
    thousands = F.floor(F.col("o_totalprice") / 1000) + 1
    amount, due = (thousands * 1000).cast("double"), (thousands * 100).cast("double")
    missed = F.when(_every(key * 7 + k * 3, 11), F.least(k, (1 + key % 3).cast("int"))).otherwise(F.lit(0))
    zero = F.lit(0.0)
    return _finish(
        orders.select(
            "o_orderkey",
            "o_totalprice",
            F.col("o_custkey").alias("c"),
            F.col("o_orderdate").cast("date").alias("start"),
            F.explode(F.sequence(F.lit(0), F.lit(INSTALLMENTS))).alias("k"),
        ).withColumn(s.SNAPSHOT, F.add_months(F.trunc("start", "MM"), k)),
        {
            s.LOAN: _text(key, " ", " L"),
            "loan_start_date": F.col("start"),
            "tenure": F.lit(INSTALLMENTS),
            "installment_num": k,
            "loan_amt": F.when(_every(key, 37), -amount).when(~_every(key, 41), amount),
            "due_amt": F.when((k == 0) | _every(key, 43), zero).otherwise(due),
            "paid_amt": F.when((k == 0) | (missed > 0), zero).otherwise(due),
            "overdue_amt": F.when(k == 0, zero)
            .when(_every(key, 47), -due)
            .when(_every(key, 59) & (missed > 0), due * missed + 0.01)
            .otherwise(due * missed),
            "balance": due * (INSTALLMENTS - k),
        },
        "loans",
    )


BUILDERS = {"clickstream": clickstream, "attributes": attributes, "financials": financials, "loans": loans}


def source_table(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """One of the four source tables from ``<folder>/orders.parquet``."""
    return BUILDERS[table](spark.read.parquet(f"{folder.rstrip('/')}/orders.parquet"))


def source_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {table: source_table(spark, folder, table) for table in BUILDERS}
