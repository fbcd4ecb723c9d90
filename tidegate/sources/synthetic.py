"""Synthetic employee and payroll deliveries, as text, with blanks and dirt.

Every value is a function of the row's ``id``, its column and the seed: the same ids give the
same rows whatever the partitioning, and no random state is involved.  Amounts are computed in
whole cents, so sums and percentages are exact.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.catalog import (
    DEPARTMENTS,
    EMPLOYEE_MASTER,
    EMPLOYMENT_STATUSES,
    EMPLOYMENT_TYPES,
    GENDERS,
    PAYMENT_MODES,
    PAYMENT_STATUSES,
)

# What the generated columns are drawn from.
FIRST_NAMES = [
    "Arjun", "Priya", "Rahul", "Sunita", "Vikram", "Kavitha", "Ravi", "Meena", "Suresh", "Deepa",
    "Karthik", "Lakshmi", "Arun", "Nisha", "Mohan",
]
LAST_NAMES = [
    "Kumar", "Sharma", "Patel", "Singh", "Rao", "Nair", "Menon", "Iyer", "Joshi", "Reddy",
]
DESIGNATIONS = [
    "Analyst", "Senior Analyst", "Manager", "Senior Manager", "Director", "VP", "AVP", "Associate",
]
LOCATIONS = ["Mumbai", "Bangalore", "Chennai", "Hyderabad", "Delhi", "Pune"]
EMAIL_DOMAINS = ["example.com", "example.org", "example.net"]
MIDDLE_NAMES = ["A", "B", "C", ""]
PAYROLL_MONTHS = ["2024-01", "2024-02", "2024-03"]
DIRT_TOKENS = ["NA", "N/A", "NULL", "none", "  "]
BLANK_SHARE = 0.03
DIRT_SHARE = 0.02
MANDATORY_BLANK_SHARE = 0.01
PAYROLL_COLUMNS = [
    "transaction_id", "employee_id", "payroll_month", "payroll_year", "basic_salary", "hra",
    "special_allowance", "conveyance_allowance", "medical_allowance", "incentive_amount",
    "overtime_pay", "gross_salary", "pf_deduction", "esi_deduction", "income_tax_deduction",
    "loan_deduction", "other_deductions", "net_salary", "payment_mode", "payment_date",
    "payment_status", "created_ts",
]

DEFAULT_SEED = 42
_RANGE = 2**32


def _digest(name: str, seed: int) -> Column:
    return F.md5(F.concat_ws("|", F.col("id").cast("string"), F.lit(str(seed)), F.lit(name)))


def _draw(name: str, part: int) -> Column:
    """One of four independent numbers below 2**32 in a column's digest."""
    return F.conv(F.substring(F.col(f"_d_{name}"), 1 + 8 * part, 8), 16, 10).cast("bigint")


def _pick(name: str, part: int, values: Sequence[str]) -> Column:
    options = F.array(*[F.lit(v) for v in values])
    return F.element_at(options, (_draw(name, part) % len(values) + 1).cast("int"))


def _between(name: str, part: int, low: int, high: int) -> Column:
    return F.lit(low) + _draw(name, part) % (high - low + 1)


def _day(name: str, part: int, first: str, days: int) -> Column:
    offset = (_draw(name, part) % days).cast("int")
    return F.date_format(F.date_add(F.lit(first).cast("date"), offset), "yyyy-MM-dd")


def _letter(name: str, part: int) -> Column:
    return F.chr((_draw(name, part) % 26 + 65).cast("int"))


def dirty(value: Column, name: str, blank: float = BLANK_SHARE, dirt: float = DIRT_SHARE) -> Column:
    """``value``, or with the given shares a blank or a token that stands for no value."""
    u = _draw(name, 0)
    # The likeliest case first: most rows draw once.
    return (
        F.when(u >= int((blank + dirt) * _RANGE), value)
        .when(u < int(blank * _RANGE), "")
        .otherwise(_pick(name, 1, DIRT_TOKENS))
    )


def _digests(ids: DataFrame, names: Sequence[str], seed: int, *keep: str) -> DataFrame:
    return ids.select("id", *keep, *[_digest(n, seed).alias(f"_d_{n}") for n in names])


def _spread(ids: DataFrame) -> DataFrame:
    """The ids dealt over all tasks: a row is a few bytes when read, but costs dozens of digests to
    generate, so what fits one scan task is far too much for one.  In order, so that a task that is run
    again sees the same rows in the same places."""
    spark = ids.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return ids.repartition(tasks, "id").sortWithinPartitions("id")


def employees(ids: DataFrame, generated_at: str, seed: int = DEFAULT_SEED) -> DataFrame:
    """One delivered employee row, 25 text columns, per row of ``ids`` (column ``id``)."""
    names = EMPLOYEE_MASTER.names
    first, last = _pick("first_name", 2, FIRST_NAMES), _pick("last_name", 2, LAST_NAMES)
    domain = _pick("email", 2, EMAIL_DOMAINS)
    emp_id: Callable[[str], Column] = lambda n: F.concat(
        F.lit("EMP"), _between(n, 2, 100_000, 999_999).cast("string")
    )
    left_company = _draw("date_of_exit", 3) < int(0.1 * _RANGE)
    pan = F.concat(
        *[_letter("pan_number", 2), _letter("pan_number", 3)],
        *[_letter("grade", 2), _letter("country", 2), _letter("country", 3)],
        _between("nationality", 2, 1000, 9999).cast("string"),
        _letter("grade", 1),
    )
    low = MANDATORY_BLANK_SHARE
    values: dict[str, Column] = {
        "employee_id": emp_id("employee_id"),
        "first_name": dirty(first, "first_name", low),
        "last_name": dirty(last, "last_name", low),
        "department": dirty(_pick("department", 2, DEPARTMENTS), "department", low),
        "employment_status": dirty(
            _pick("employment_status", 2, EMPLOYMENT_STATUSES), "employment_status", low
        ),
        "middle_name": dirty(_pick("middle_name", 2, MIDDLE_NAMES), "middle_name", 0.30),
        "date_of_birth": dirty(_day("date_of_birth", 2, "1970-01-01", 10_592), "date_of_birth"),
        "date_of_joining": dirty(_day("date_of_joining", 2, "2005-01-01", 6_939), "date_of_joining"),
        "date_of_exit": dirty(
            F.when(left_company, _day("date_of_exit", 2, "2020-01-01", 1_827)).otherwise(""),
            "date_of_exit",
            0.0,
        ),
        "designation": dirty(_pick("designation", 2, DESIGNATIONS), "designation"),
        "employment_type": dirty(_pick("employment_type", 2, EMPLOYMENT_TYPES), "employment_type"),
        "cost_center": dirty(
            F.concat(F.lit("CC"), _between("cost_center", 2, 1001, 1019).cast("string")), "cost_center"
        ),
        "location": dirty(_pick("location", 2, LOCATIONS), "location"),
        "gender": dirty(_pick("gender", 2, GENDERS), "gender"),
        "nationality": dirty(F.lit("Indian"), "nationality"),
        "email": dirty(F.concat(F.lower(first), F.lit("."), F.lower(last), F.lit("@"), domain), "email"),
        "phone": dirty(
            F.concat(F.lit("+91-"), (F.lit(7_000_000_000) + _draw("phone", 2) % 3_000_000_000).cast("string")),
            "phone",
        ),
        "manager_id": dirty(emp_id("manager_id"), "manager_id", 0.10),
        "grade": dirty(F.concat(F.lit("G"), _between("grade", 3, 1, 8).cast("string")), "grade"),
        "ssn": dirty(
            F.concat_ws(
                "-",
                _between("ssn", 2, 100, 999).cast("string"),
                _between("ssn", 3, 10, 99).cast("string"),
                _between("location", 3, 1000, 9999).cast("string"),
            ),
            "ssn",
        ),
        "bank_account_number": dirty(
            (F.lit(10**9) + (_draw("bank_account_number", 2) * 4096 + _draw("bank_account_number", 3) % 4096) % (10**12 - 10**9)).cast("string"),
            "bank_account_number",
        ),
        "pan_number": dirty(pan, "pan_number"),
        "aadhar_number": dirty(
            (F.lit(10**11) + (_draw("aadhar_number", 2) * 4096 + _draw("aadhar_number", 3) % 4096) % (9 * 10**11)).cast("string"),
            "aadhar_number",
        ),
        "country": dirty(F.lit("India"), "country"),
        "created_ts": F.lit(generated_at),
    }
    drawn = [n for n in names if n != "created_ts"]
    # Plain columns: those that nobody asks for are not generated.
    return _digests(_spread(ids.select("id")), drawn, seed).select("id", *[values[n].alias(n) for n in names])


def payroll(employee_ids: DataFrame, generated_at: str, seed: int = DEFAULT_SEED) -> DataFrame:
    """One delivered payroll row, 22 text columns, per row of ``employee_ids`` (columns ``id``
    and ``employee_id``)."""
    drawn = [c for c in PAYROLL_COLUMNS if c not in ("payroll_year", "created_ts")]
    start = _digests(employee_ids, drawn, seed, "employee_id")

    def sometimes(name: str, share: float, high: int) -> Column:
        return F.when(_draw(name, 3) < int(share * _RANGE), _between(name, 2, 0, high)).otherwise(0)

    def percent(c: Column, ten_thousandths: Column | int) -> Column:
        """A share of an amount in cents, rounded half up."""
        return F.floor((c * ten_thousandths + 5_000) / 10_000)

    cents = start.select(
        "*",
        _between("basic_salary", 2, 2_000_000, 20_000_000).alias("basic"),
        _between("conveyance_allowance", 2, 80_000, 320_000).alias("conveyance"),
        _between("medical_allowance", 2, 50_000, 200_000).alias("medical"),
        sometimes("incentive_amount", 0.5, 5_000_000).alias("incentive"),
        sometimes("overtime_pay", 0.3, 1_000_000).alias("overtime"),
        sometimes("loan_deduction", 0.3, 2_000_000).alias("loan"),
        _between("other_deductions", 2, 0, 200_000).alias("other"),
        _between("income_tax_deduction", 2, 500, 3_000).alias("tax_rate"),
        _pick("payroll_month", 2, PAYROLL_MONTHS).alias("month"),
    )
    cents = cents.withColumns(
        {"house": percent(F.col("basic"), 4_000), "special": percent(F.col("basic"), 2_000)}
    )
    gross = sum((F.col(c) for c in ("house", "special", "conveyance", "medical", "incentive", "overtime")), F.col("basic"))
    cents = cents.withColumn("gross", gross)
    cents = cents.withColumns(
        {
            "pf": percent(F.col("basic"), 1_200),
            "esi": F.when(F.col("gross") <= 2_100_000, percent(F.col("gross"), 75)).otherwise(0),
            "tax": percent(F.col("gross"), F.col("tax_rate")),
        }
    )
    net = F.col("gross") - F.col("pf") - F.col("esi") - F.col("tax") - F.col("loan") - F.col("other")
    cents = cents.withColumn("net", net)

    def amount(name: str) -> Column:
        return F.when(F.col(name) == 0, "0").otherwise((F.col(name) / 100).cast("string"))

    values: dict[str, Column] = {
        "transaction_id": F.concat(F.lit("TXN"), _between("transaction_id", 2, 10_000_000, 99_999_999).cast("string")),
        "employee_id": dirty(F.col("_employee_id"), "employee_id", 0.005),
        "payroll_month": F.col("month"),
        "payroll_year": F.substring("month", 1, 4),
        "basic_salary": dirty(amount("basic"), "basic_salary"),
        "hra": dirty(amount("house"), "hra"),
        "special_allowance": dirty(amount("special"), "special_allowance"),
        "conveyance_allowance": dirty(amount("conveyance"), "conveyance_allowance"),
        "medical_allowance": dirty(amount("medical"), "medical_allowance"),
        "incentive_amount": amount("incentive"),
        "overtime_pay": amount("overtime"),
        "gross_salary": dirty(amount("gross"), "gross_salary"),
        "pf_deduction": amount("pf"),
        "esi_deduction": amount("esi"),
        "income_tax_deduction": dirty(amount("tax"), "income_tax_deduction"),
        "loan_deduction": amount("loan"),
        "other_deductions": amount("other"),
        "net_salary": dirty(amount("net"), "net_salary"),
        "payment_mode": dirty(_pick("payment_mode", 2, PAYMENT_MODES), "payment_mode"),
        "payment_date": dirty(
            F.concat("month", F.lit("-"), _between("payment_date", 2, 25, 28).cast("string")), "payment_date"
        ),
        "payment_status": dirty(_pick("payment_status", 2, PAYMENT_STATUSES), "payment_status"),
        "created_ts": F.lit(generated_at),
    }
    paid = cents.withColumnRenamed("employee_id", "_employee_id")
    return paid.select("id", *[values[c].alias(c) for c in PAYROLL_COLUMNS])
