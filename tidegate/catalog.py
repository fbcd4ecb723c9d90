"""The two contracts that ship with the package.

Everything in this file is a fixed value: column names and their order, types, value lists and
patterns are those of the delivered datasets and must not change.
"""

from __future__ import annotations

from tidegate.contract import HARD, SOFT, Contract, Rule

DEPARTMENTS = [
    "Engineering", "Finance", "HR", "Operations", "Legal",
    "Sales", "Marketing", "IT", "Compliance", "Risk",
]
EMPLOYMENT_STATUSES = ["Active", "Inactive"]
EMPLOYMENT_TYPES = ["Permanent", "Contract", "Intern"]
GENDERS = ["M", "F", "Other"]
PAYMENT_MODES = ["NEFT", "IMPS", "Cheque"]
PAYMENT_STATUSES = ["Processed", "Pending", "Failed"]

EMPLOYEE_ID_PATTERN = "^EMP[0-9]{6}$"
EMAIL_PATTERN = r"^[\w.+-]+@[\w-]+\.[a-zA-Z]{2,}$"
PAN_PATTERN = "^[A-Z]{5}[0-9]{4}[A-Z]$"

DATE_FORMAT = "yyyy-MM-dd"
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"

EMPLOYEE_MASTER = Contract.define(
    "employee_master",
    mandatory="""
        employee_id STRING, first_name STRING, last_name STRING, department STRING,
        employment_status STRING
    """,
    optional="""
        middle_name STRING, date_of_birth DATE, date_of_joining DATE, date_of_exit DATE,
        designation STRING, employment_type STRING, cost_center STRING, location STRING,
        gender STRING, nationality STRING, email STRING, phone STRING, manager_id STRING,
        grade STRING, ssn STRING, bank_account_number STRING, pan_number STRING,
        aadhar_number STRING, country STRING, created_ts TIMESTAMP
    """,
    details={
        "department": {"allowed_values": DEPARTMENTS},
        "employment_status": {"allowed_values": EMPLOYMENT_STATUSES},
        "employment_type": {"allowed_values": EMPLOYMENT_TYPES},
        "gender": {"allowed_values": GENDERS},
        "email": {"regex": EMAIL_PATTERN},
        "pan_number": {"regex": PAN_PATTERN},
        "phone": {"cleansing": "strip_non_numeric_except_plus"},
        "ssn": {"cleansing": "remove_dashes_and_spaces"},
        "date_of_birth": {"format": DATE_FORMAT},
        "date_of_joining": {"format": DATE_FORMAT},
        "date_of_exit": {"format": DATE_FORMAT},
        "created_ts": {"format": TIMESTAMP_FORMAT},
    },
    rules=[
        Rule("employee_id", "not_null", HARD),
        Rule("employee_id", "regex_match", HARD, {"pattern": EMPLOYEE_ID_PATTERN}),
        Rule("first_name", "not_null", HARD),
        Rule("last_name", "not_null", HARD),
        Rule("department", "not_null", HARD),
        Rule("department", "allowed_values", SOFT, {"allowed": DEPARTMENTS}),
        Rule("employment_status", "not_null", HARD),
        Rule("employment_status", "allowed_values", HARD, {"allowed": EMPLOYMENT_STATUSES}),
        Rule("date_of_birth", "date_format", SOFT, {"format": DATE_FORMAT}),
        Rule("email", "regex_match", SOFT, {"pattern": EMAIL_PATTERN}),
        Rule("pan_number", "regex_match", SOFT, {"pattern": PAN_PATTERN}),
    ],
    table="raw_employee_master",
)

PAYROLL_TRANSACTIONS = Contract.define(
    "payroll_transactions",
    mandatory="""
        transaction_id STRING, employee_id STRING, payroll_month STRING, gross_salary DOUBLE,
        net_salary DOUBLE
    """,
    optional="""
        payroll_year STRING, basic_salary DOUBLE, hra DOUBLE, special_allowance DOUBLE,
        conveyance_allowance DOUBLE, medical_allowance DOUBLE, incentive_amount DOUBLE,
        overtime_pay DOUBLE, pf_deduction DOUBLE, esi_deduction DOUBLE,
        income_tax_deduction DOUBLE, loan_deduction DOUBLE, other_deductions DOUBLE,
        payment_mode STRING, payment_date DATE, payment_status STRING, created_ts TIMESTAMP
    """,
    details={
        "payment_mode": {"allowed_values": PAYMENT_MODES},
        "payment_status": {"allowed_values": PAYMENT_STATUSES},
        "payment_date": {"format": DATE_FORMAT},
        "created_ts": {"format": TIMESTAMP_FORMAT},
    },
    rules=[
        Rule("transaction_id", "not_null", HARD),
        Rule("employee_id", "not_null", HARD),
        Rule("payroll_month", "not_null", HARD),
        Rule("gross_salary", "not_null", HARD),
        Rule("gross_salary", "positive_number", HARD),
        Rule("net_salary", "not_null", HARD),
        Rule("payment_mode", "allowed_values", SOFT, {"allowed": PAYMENT_MODES}),
        Rule("payment_status", "allowed_values", SOFT, {"allowed": PAYMENT_STATUSES}),
    ],
    table="raw_payroll_transactions",
)

BUILT_IN = {c.name: c for c in (EMPLOYEE_MASTER, PAYROLL_TRANSACTIONS)}
