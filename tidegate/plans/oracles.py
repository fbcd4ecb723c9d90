"""What every query must return, as SQL over the same tables.

Written from the semantics of the operators, not from their implementation: plain joins,
``CASE`` and window functions; a fit is unrolled pass by pass.
"""

from __future__ import annotations

from tidegate import catalog
from tidegate.sources import synthetic as S

TOKENS = "('NA','N/A','N/a','n/a','null','NULL','None','none','')"


def _clean(c: str) -> str:
    return f"case when trim({c}, ' ') in {TOKENS} then null else {c} end"


def _integer(c: str, kind: str) -> str:
    return f"case when regexp_full_match({c}, '[+-]?[0-9]+') then try_cast({c} as {kind}) end"


def _date(c: str) -> str:
    shape = r"\d{4}-\d{2}-\d{2}"
    return f"case when regexp_full_match({c}, '{shape}') then try_cast(try_strptime({c}, '%Y-%m-%d') as date) end"


# -- customers -------------------------------------------------------------------------------

DELIVERED = """
delivered as (
  select c_custkey as k, c_custkey::varchar as c_custkey, c_name,
    case when c_custkey % 11 = 0 then 'NA' when c_custkey % 13 = 0 then '  '
         when c_custkey % 17 = 0 then 'none' else c_mktsegment end as c_mktsegment,
    case when c_custkey % 19 = 0 then '12abc' when c_custkey % 23 = 0 then ''
         else c_acctbal::varchar end as c_acctbal,
    case when c_custkey % 29 = 0 then '2024-13-01' when c_custkey % 31 = 0 then '2024-1-5'
         else strftime(date '2020-01-01' + (c_custkey % 1000)::int, '%Y-%m-%d') end as joined
  from customer
)"""

JUDGED = f"""{DELIVERED},
cleaned as (
  select k, c_custkey as raw_key, c_name as raw_name, c_mktsegment as raw_segment,
    c_acctbal as raw_balance, joined as raw_joined,
    {_clean('c_custkey')} as t_key, {_clean('c_name')} as c_name,
    {_clean('c_mktsegment')} as c_mktsegment, {_clean('c_acctbal')} as t_balance,
    {_clean('joined')} as t_joined
  from delivered
),
typed as (
  select *, {_integer('t_key', 'bigint')} as c_custkey, try_cast(t_balance as double) as c_acctbal,
    {_date('t_joined')} as joined
  from cleaned
),
judged as (
  select *,
    case when c_custkey is null then 'NULL_MANDATORY:c_custkey'
         when c_name is null then 'NULL_MANDATORY:c_name'
         when c_mktsegment is null then 'NULL_MANDATORY:c_mktsegment'
         when t_balance is not null and c_acctbal is null then 'TYPE_CAST_FAIL:c_acctbal'
         when t_joined is not null and joined is null then 'TYPE_CAST_FAIL:joined' end as reason
  from typed
)"""

SEGMENTS = "('BUILDING','FURNITURE','HOUSEHOLD','MACHINERY')"
NAME_FAILS = "not regexp_matches(c_name, '^Customer#[0-9]{8}[0-8]$')"


def _dq(hard: list[tuple[str, str]], soft: list[tuple[str, str]]) -> str:
    """The three DQ columns from failing conditions and check names."""

    def listed(checks: list[tuple[str, str]]) -> str:
        return ", ".join(f"case when {cond} then '{name}' end" for cond, name in checks)

    def any_of(checks: list[tuple[str, str]]) -> str:
        return " or ".join(f"coalesce({cond}, false)" for cond, _ in checks) or "false"

    return f"""
    case when {any_of(hard)} then 'FAIL' when {any_of(soft)} then 'WARN' else 'PASS' end as dq_status,
    concat_ws('|', {listed([*hard, *soft])}) as dq_failed_checks,
    case when {any_of(hard)} then 0 else 1 end as validation_flag"""


CUSTOMER_DQ = _dq(
    [(NAME_FAILS, "c_name__regex")],
    [
        (f"c_mktsegment not in {SEGMENTS}", "c_mktsegment__allowed_values"),
        ("not c_acctbal > 0", "c_acctbal__positive"),
    ],
)

ANNOTATED = f"""{JUDGED},
checked as (select *, {CUSTOMER_DQ} from judged),
annotated as (
  select * replace (
      case when reason is null then dq_status end as dq_status,
      case when reason is null then dq_failed_checks end as dq_failed_checks,
      case when reason is null then validation_flag end as validation_flag),
    coalesce(reason, case when validation_flag = 0 then dq_failed_checks end) as rejection_reason,
    case when reason is not null then 'SCHEMA_ENFORCEMENT'
         when validation_flag = 0 then 'DQ_CHECK' end as rejection_layer
  from checked
)"""

RAW_CUSTOMER = (
    """'{"c_custkey":"' || raw_key || '","c_name":"' || raw_name || '","c_mktsegment":"' || raw_segment || """
    """'","c_acctbal":"' || raw_balance || '","joined":"' || raw_joined || '"}'"""
)

CHECKED_CLEAN = f"checked as (select *, {CUSTOMER_DQ} from customer)"

# -- orders ----------------------------------------------------------------------------------

ORDERS_DELIVERED = """
delivered as (
  select o_orderkey as k,
    case when o_orderkey % 41 = 0 then '1.5' else o_orderkey::varchar end as r_key,
    case when o_orderkey % 37 = 0 then strftime(o_orderdate, '%Y-%m-%d')
         when o_orderkey % 43 = 0 then ' NULL '
         else strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') end as r_placed,
    case when o_orderkey % 47 = 0 then '99999999999' else o_custkey::varchar end as r_cust,
    (['true', 'F', 'yes', '0', 'maybe', 'n/a'])[(o_orderkey % 6 + 1)::int] as r_urgent,
    case when o_orderkey % 53 = 0 then '2024-02-30' else strftime(o_orderdate, '%Y-%m-%d') end as r_day,
    case when o_orderkey % 59 = 0 then 'N/a' else (o_orderkey % 1000)::varchar end as r_price
  from orders
)"""

ORDERS_JUDGED = f"""{ORDERS_DELIVERED},
typed as (
  select *,
    {_integer('r_key', 'bigint')} as o_orderkey,
    case when regexp_full_match(r_placed, '.{{19}}') then r_placed end as o_placed,
    {_integer('r_cust', 'integer')} as o_custkey,
    case r_urgent when 'true' then true when 'yes' then true when 'F' then false when '0' then false end as o_urgent,
    {_date('r_day')} as o_day,
    try_cast({_clean('r_price')} as double) as o_totalprice,
    k % 41 <> 0 and (k % 61 = 0 or k % 67 = 0) as uneven
  from delivered
),
judged as (
  select *,
    case when o_orderkey is null then 'NULL_MANDATORY:o_orderkey'
         when o_placed is null then 'NULL_MANDATORY:o_placed'
         when o_custkey is null then 'TYPE_CAST_FAIL:o_custkey'
         when r_urgent = 'maybe' then 'TYPE_CAST_FAIL:o_urgent'
         when o_day is null then 'TYPE_CAST_FAIL:o_day' end as reason
  from typed
)"""

ORDERS_DQ = _dq(
    [("not o_totalprice > 0", "o_totalprice__positive")],
    [("not o_day between date '1996-01-01' and date '2003-12-31'", "o_day__date_range")],
)

ORDERS_FILES = f"""{ORDERS_JUDGED},
filed as (select * replace (case when uneven then 'CORRUPT_CSV_ROW' else reason end as reason) from judged),
checked as (select *, {ORDERS_DQ} from filed),
annotated as (
  select *,
    coalesce(reason, case when validation_flag = 0 then dq_failed_checks end) as rejection_reason,
    case when reason is not null then 'SCHEMA_ENFORCEMENT'
         when validation_flag = 0 then 'DQ_CHECK' end as rejection_layer,
    concat_ws(',', r_key, r_placed, r_cust, r_urgent, r_day) as short_line,
    '{{"o_orderkey":"' || r_key || '","o_placed":"' || r_placed || '","o_custkey":"' || r_cust ||
      '","o_urgent":"' || r_urgent || '","o_day":"' || r_day || '","o_totalprice":"' || r_price || '"}}' as texts
  from checked
)"""

# -- lineitem, documents ---------------------------------------------------------------------

LINEITEM_GAPS = """
gaps as (
  select l_orderkey, l_returnflag, case when l_orderkey % 97 <> 0 then l_linestatus end as l_linestatus,
    l_quantity - 5 as net, case when l_orderkey % 89 <> 0 then l_shipdate end as l_shipdate,
    l_extendedprice, case when l_orderkey % 83 <> 0 then l_quantity * 1200 end as floor_price
  from lineitem
)"""

LINEITEM_DQ = _dq(
    [("l_linestatus is null", "l_linestatus__not_null"), ("not net > 0", "net__positive")],
    [
        ("not regexp_matches(l_returnflag, '^[AN]$')", "l_returnflag__regex"),
        ("not regexp_matches(l_returnflag, '[NR]')", "l_returnflag__regex_2"),
        ("l_linestatus not in ('O')", "l_linestatus__allowed_values"),
        ("not l_shipdate between date '1996-01-01' and date '2000-12-31'", "l_shipdate__date_range"),
        ("not l_extendedprice >= floor_price", "l_extendedprice__ge_floor_price"),
    ],
)

_HASHED_LINEITEM = ", ".join(
    f"coalesce({c}::varchar, 'NULL')"
    for c in (
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
    )
)
LINEITEM_MD5 = f"md5(concat_ws('|', {_HASHED_LINEITEM}))"

# -- slowly changing dimension ----------------------------------------------------------------


def _versions(days: list[tuple[str, str, str]]) -> str:
    """Versions from daily observations: a version starts where a key appears or its segment
    changes and ends at the next such break or disappearance."""
    observed = " union all ".join(
        f"select c_custkey, c_name, date '{day}' as d, {present} as present, {segment} as seg from customer"
        for day, present, segment in days
    )
    return f"""
with observed as ({observed}),
before as (
  select *, lag(present, 1, false) over w as was, lag(seg) over w as was_seg from observed
  window w as (partition by c_custkey order by d)
),
breaks as (
  select *, present <> was or (present and was and seg <> was_seg) as broken from before
)
select c_custkey, c_name, seg as c_mktsegment, d as effective_from,
  (select min(l.d) from breaks l where l.c_custkey = b.c_custkey and l.d > b.d and l.broken) as effective_to,
  not exists (select 1 from breaks l where l.c_custkey = b.c_custkey and l.d > b.d and l.broken) as is_current
from breaks b where present and broken"""


DAY_1 = ("2024-01-01", "c_custkey % 10 <> 0", "c_mktsegment")
DAY_2 = ("2024-01-02", "c_custkey % 13 <> 0", "case when c_custkey % 7 = 0 then 'CHANGED' else c_mktsegment end")
DAY_3 = ("2024-01-03", "c_custkey % 17 <> 0", "c_mktsegment")


def _hot(key: str, row: str) -> str:
    return f"case when {row} % 3 = 0 then 1 when {row} % 6 = 1 then null else {key} end"


# -- loans -------------------------------------------------------------------------------------

FEATURES = """
history as (
  select l_orderkey as loan_id, avg(dpd) as avg_days_past_due, max(dpd) as max_days_past_due,
    count(*) filter (dpd > 0) as late_payment_count, count(*) filter (dpd >= 30) as missed_payment_count,
    count(l_linenumber) as total_payments
  from (select *, l_quantity::int * 3 - 45 as dpd from lineitem) group by l_orderkey
),
features as (
  select h.*, late_payment_count / total_payments as late_payment_ratio, o_custkey as borrower_id,
    o_totalprice as loan_amount, (o_orderkey % 48 + 12)::int as tenure, o_totalprice / 12 as emi_amount,
    c_acctbal as income, (c_custkey % 551 + 300)::int as credit_score,
    (o_totalprice / 12) / nullif(c_acctbal, 0) as emi_income_ratio,
    case when max_days_past_due >= 90 then 1 else 0 end as default_flag
  from history h join orders on loan_id = o_orderkey left join customer on o_custkey = c_custkey
)"""

FEATURE_COLUMNS = (
    "loan_id, avg_days_past_due, max_days_past_due, late_payment_count, missed_payment_count, total_payments, "
    "late_payment_ratio, borrower_id, loan_amount, tenure, emi_amount, income, credit_score, emi_income_ratio, "
    "default_flag"
)
MATRIX_COLUMNS = (
    "loan_id, late_payment_ratio, missed_payment_count, emi_income_ratio, income, credit_score, loan_amount, "
    "tenure, default_flag"
)
DRIVERS = ["late_payment_ratio", "missed_payment_count", "emi_income_ratio", "income", "credit_score"]

SCORED = f"""{FEATURES},
probable as (
  select *, 1.0::double / (1.0::double + exp(-(-2.5::double + 2.0::double * late_payment_ratio
    + 0.35::double * missed_payment_count + 0.001::double * emi_income_ratio
    + (-0.00002)::double * income + (-0.001)::double * credit_score))) as p
  from features
),
numbered as (select *, trunc((1 - p) * 600 + 300)::int as risk_score from probable),
scored as (
  select *,
    case when risk_score >= 750 then 'A - Low Risk' when risk_score >= 650 then 'B - Medium Risk'
         when risk_score >= 550 then 'C - High Risk' when risk_score is not null then 'D - Very High Risk' end as risk_tier,
    case when risk_score >= 750 then 'Approve' when risk_score >= 650 then 'Approve with conditions'
         when risk_score >= 550 then 'Manual review' when risk_score is not null then 'Reject' end as decision
  from numbered
)"""

IS_TEST = "('0x' || substr(md5({0}::varchar || '|42'), 1, 8))::bigint % 10 < 2"

LABELLED = f"""{FEATURES},
correlations as (
  {" union all ".join(f"select '{d}' as feature, corr({d}, default_flag) as r from features" for d in DRIVERS)}
)"""

RANKED = f"""{LABELLED},
ranked as (
  select feature, r, row_number() over (order by r desc, feature) as top,
    row_number() over (order by r, feature) as bottom
  from correlations where r is not null
)"""

# -- synthetic deliveries --------------------------------------------------------------------------


def _draw(name: str, part: int) -> str:
    return f"('0x' || substr(md5(id::varchar || '|42|{name}'), {1 + 8 * part}, 8))::bigint"


def _pick(name: str, part: int, values: list[str]) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"([{listed}])[({_draw(name, part)} % {len(values)} + 1)::int]"


def _between(name: str, part: int, low: int, high: int) -> str:
    return f"({low} + {_draw(name, part)} % {high - low + 1})"


def _dirty(value: str, name: str, blank: float = 0.03) -> str:
    u = _draw(name, 0)
    return (
        f"case when {u} < {int(blank * 2**32)} then '' "
        f"when {u} < {int((blank + 0.02) * 2**32)} then {_pick(name, 1, ['NA', 'N/A', 'NULL', 'none', '  '])} "
        f"else {value} end"
    )


def _day(name: str, first: str, days: int) -> str:
    return f"strftime(date '{first}' + ({_draw(name, 2)} % {days})::int, '%Y-%m-%d')"


def _letter(name: str, part: int) -> str:
    return f"chr(({_draw(name, part)} % 26 + 65)::int)"


def _number(name: str, part: int, low: int, high: int) -> str:
    return f"{_between(name, part, low, high)}::varchar"


def _wide(name: str, low: int, high: int) -> str:
    return f"({low} + ({_draw(name, 2)} * 4096 + {_draw(name, 3)} % 4096) % {high - low})::varchar"


_FIRST, _LAST = _pick("first_name", 2, S.FIRST_NAMES), _pick("last_name", 2, S.LAST_NAMES)
_EXIT = (
    f"case when {_draw('date_of_exit', 3)} < {int(0.1 * 2**32)} "
    f"then {_day('date_of_exit', '2020-01-01', 1827)} else '' end"
)
_PAN = " || ".join(
    [
        _letter("pan_number", 2), _letter("pan_number", 3), _letter("grade", 2),
        _letter("country", 2), _letter("country", 3), _number("nationality", 2, 1000, 9999),
        _letter("grade", 1),
    ]
)
EMPLOYEE_VALUES = {
    "employee_id": "'EMP' || " + _number("employee_id", 2, 100000, 999999),
    "first_name": _dirty(_FIRST, "first_name", 0.01),
    "last_name": _dirty(_LAST, "last_name", 0.01),
    "department": _dirty(_pick("department", 2, catalog.DEPARTMENTS), "department", 0.01),
    "employment_status": _dirty(_pick("employment_status", 2, ["Active", "Inactive"]), "employment_status", 0.01),
    "middle_name": _dirty(_pick("middle_name", 2, ["A", "B", "C", ""]), "middle_name", 0.30),
    "date_of_birth": _dirty(_day("date_of_birth", "1970-01-01", 10592), "date_of_birth"),
    "date_of_joining": _dirty(_day("date_of_joining", "2005-01-01", 6939), "date_of_joining"),
    "date_of_exit": _dirty(_EXIT, "date_of_exit", 0.0),
    "designation": _dirty(_pick("designation", 2, S.DESIGNATIONS), "designation"),
    "employment_type": _dirty(_pick("employment_type", 2, catalog.EMPLOYMENT_TYPES), "employment_type"),
    "cost_center": _dirty("'CC' || " + _number("cost_center", 2, 1001, 1019), "cost_center"),
    "location": _dirty(_pick("location", 2, S.LOCATIONS), "location"),
    "gender": _dirty(_pick("gender", 2, catalog.GENDERS), "gender"),
    "nationality": _dirty("'Indian'", "nationality"),
    "email": _dirty(
        f"lower({_FIRST}) || '.' || lower({_LAST}) || '@' || {_pick('email', 2, S.EMAIL_DOMAINS)}", "email"
    ),
    "phone": _dirty("'+91-' || " + _number("phone", 2, 7_000_000_000, 9_999_999_999), "phone"),
    "manager_id": _dirty("'EMP' || " + _number("manager_id", 2, 100000, 999999), "manager_id", 0.10),
    "grade": _dirty("'G' || " + _number("grade", 3, 1, 8), "grade"),
    "ssn": _dirty(
        f"{_number('ssn', 2, 100, 999)} || '-' || {_number('ssn', 3, 10, 99)} || '-' || "
        f"{_number('location', 3, 1000, 9999)}",
        "ssn",
    ),
    "bank_account_number": _dirty(_wide("bank_account_number", 10**9, 10**12), "bank_account_number"),
    "pan_number": _dirty(_PAN, "pan_number"),
    "aadhar_number": _dirty(_wide("aadhar_number", 10**11, 10**12), "aadhar_number"),
    "country": _dirty("'India'", "country"),
    "created_ts": "'2024-01-15 08:00:00'",
}
EMPLOYEES = "people as (select id, {} from (select c_custkey as id from customer))".format(
    ", ".join(f"{v} as {n}" for n, v in EMPLOYEE_VALUES.items())
)


def _sometimes(name: str, share: float, high: int) -> str:
    return f"case when {_draw(name, 3)} < {int(share * 2**32)} then {_between(name, 2, 0, high)} else 0 end"


def _share(c: str, ten_thousandths: str) -> str:
    return f"(({c} * {ten_thousandths} + 5000) // 10000)"


def _amount(c: str) -> str:
    return f"case when {c} = 0 then '0' else ({c} / 100)::varchar end"


PAYROLL = f"""
cents as (
  select id, employee_id,
    {_between('basic_salary', 2, 2_000_000, 20_000_000)} as basic,
    {_between('conveyance_allowance', 2, 80_000, 320_000)} as conveyance,
    {_between('medical_allowance', 2, 50_000, 200_000)} as medical,
    {_sometimes('incentive_amount', 0.5, 5_000_000)} as incentive,
    {_sometimes('overtime_pay', 0.3, 1_000_000)} as overtime,
    {_sometimes('loan_deduction', 0.3, 2_000_000)} as loan,
    {_between('other_deductions', 2, 0, 200_000)} as other,
    {_between('income_tax_deduction', 2, 500, 3_000)} as rate,
    {_pick('payroll_month', 2, S.PAYROLL_MONTHS)} as month
  from people
),
parts as (select *, {_share('basic', '4000')} as house, {_share('basic', '2000')} as special from cents),
grossed as (select *, basic + house + special + conveyance + medical + incentive + overtime as gross from parts),
taxed as (
  select *, {_share('basic', '1200')} as pf,
    case when gross <= 2100000 then {_share('gross', '75')} else 0 end as esi, {_share('gross', 'rate')} as tax
  from grossed
),
netted as (select *, gross - pf - esi - tax - loan - other as net from taxed),
payslips as (
  select id, 'TXN' || {_number('transaction_id', 2, 10_000_000, 99_999_999)} as transaction_id,
    {_dirty('employee_id', 'employee_id', 0.005)} as employee_id, month as payroll_month,
    substr(month, 1, 4) as payroll_year,
    {_dirty(_amount('basic'), 'basic_salary')} as basic_salary, {_dirty(_amount('house'), 'hra')} as hra,
    {_dirty(_amount('special'), 'special_allowance')} as special_allowance,
    {_dirty(_amount('conveyance'), 'conveyance_allowance')} as conveyance_allowance,
    {_dirty(_amount('medical'), 'medical_allowance')} as medical_allowance,
    {_amount('incentive')} as incentive_amount, {_amount('overtime')} as overtime_pay,
    {_dirty(_amount('gross'), 'gross_salary')} as gross_salary, {_amount('pf')} as pf_deduction,
    {_amount('esi')} as esi_deduction, {_dirty(_amount('tax'), 'income_tax_deduction')} as income_tax_deduction,
    {_amount('loan')} as loan_deduction, {_amount('other')} as other_deductions,
    {_dirty(_amount('net'), 'net_salary')} as net_salary,
    {_dirty(_pick('payment_mode', 2, catalog.PAYMENT_MODES), 'payment_mode')} as payment_mode,
    {_dirty("month || '-' || " + _number('payment_date', 2, 25, 28), 'payment_date')} as payment_date,
    {_dirty(_pick('payment_status', 2, catalog.PAYMENT_STATUSES), 'payment_status')} as payment_status,
    '2024-01-15 08:00:00' as created_ts
  from netted
)"""

_MANDATORY_PEOPLE = "employee_id first_name last_name department employment_status".split()
_MANDATORY_PAY = "transaction_id employee_id payroll_month gross_salary net_salary".split()


def _first_null(columns: list[str]) -> str:
    cases = " ".join(f"when trim({c}, ' ') in {TOKENS} then 'NULL_MANDATORY:{c}'" for c in columns)
    return f"case {cases} end"


# -- files ---------------------------------------------------------------------------------------

VERIFIED = """
nations as (
  select n_nationkey as n, n <> 11 and exists (select 1 from customer where c_nationkey = n_nationkey) as arrived,
    n % 7 <> 6 and exists (select 1 from customer where c_nationkey = n_nationkey) as claimed
  from nation
),
checks as (
  select 'nation_' || lpad(n::varchar, 8, '0') || '.csv' as file_name,
    case when arrived then 'PASS' else 'FAIL' end as file_arrived,
    case when arrived then 'PASS' end as filename_pattern,
    case when arrived then case when claimed then 'PASS' else 'FAIL' end end as manifest_present,
    case when arrived and claimed then 'PASS' end as manifest_parseable,
    case when arrived and claimed then case when n % 5 = 0 then 'FAIL' else 'PASS' end end as checksum_match,
    case when arrived and claimed then case when n % 4 = 0 then 'FAIL' else 'PASS' end end as row_count_match,
    case when arrived and claimed then case when n % 3 = 0 then 'FAIL' else 'PASS' end end as file_size_match
  from nations
),
counted as (
  select *, (case when file_arrived = 'FAIL' then 1 else 0 end + case when manifest_present = 'FAIL' then 1 else 0 end
    + case when checksum_match = 'FAIL' then 1 else 0 end + case when row_count_match = 'FAIL' then 1 else 0 end
    + case when file_size_match = 'FAIL' then 1 else 0 end)::int as error_count
  from checks
)"""


def _pairs() -> str:
    columns = [*DRIVERS, "default_flag"]
    return " union all ".join(
        f"select '{a}' as feature_a, '{b}' as feature_b, round(corr({a}, {b}), 6) as correlation from features"
        for a in columns
        for b in columns
    )


#: Rows of each delivered dataset, and those whose id is a number.
_DELIVERED_ROWS = "rows as (" + " union all ".join(
    f"select '{t}' as dataset, count(*)::bigint as n, count_if({k} % 10 <> 3)::bigint as good from {t}"
    for t, k in (("customer", "c_custkey"), ("part", "p_partkey"), ("supplier", "s_suppkey"), ("region", "r_regionkey"))
) + " union all select 'nation', 0, 0)"


def _daily(run: int, taken: str, errors: str) -> str:
    return f"""select {run} as run, dataset, case when dataset = '{taken}' then case when good = n then 'SUCCESS' else 'PARTIAL' end
                else 'FAILED' end as status, case when dataset = '{taken}' then n else 0 end as read,
              case when dataset = '{taken}' then good else 0 end as valid, case when dataset = '{taken}' then good else 0 end as held,
              case dataset {errors} when 'supplier' then 'manifest_parseable' when 'region' then 'manifest_present'
                when 'nation' then 'file_arrived' else '' end as errors from rows"""


def _fitted(passes: int = 12) -> str:
    """Newton's method pass by pass, as in textbooks: sums over the training rows, then elimination
    without exchange of rows (the matrix is positive definite), then substitution backwards."""
    names = ["1.0::double", *[f"{c}::double" for c in MATRIX_COLUMNS.split(", ")[1:-1]]]
    n = len(names)
    parts = [
        f"train as materialized (select {', '.join(f'{x} as x{i}' for i, x in enumerate(names))}, default_flag::double as y "
        f"from features where not {IS_TEST.format('loan_id')})",
        f"beta0 as materialized (select {', '.join(f'0.0::double as b{i}' for i in range(n))})",
    ]
    for k in range(passes):
        z = " + ".join(f"b{i} * x{i}" for i in range(n))
        sums = [f"sum(w * x{i} * x{j}) + {int(i == j and i > 0)} as a{i}_{j}" for i in range(n) for j in range(n)]
        sums += [f"sum((p - y) * x{i}) + {int(i > 0)} * any_value(b{i}) as a{i}_{n}" for i in range(n)]
        parts.append(
            f"pass{k} as materialized (select {', '.join(sums)} from (select *, p * (1 - p) as w from "
            f"(select *, 1 / (1 + exp(-({z}))) as p from train, beta{k})))"
        )
        before = f"pass{k}"
        for c in range(n):
            rows = [
                f"a{i}_{j} - a{i}_{c} / a{c}_{c} * a{c}_{j} as a{i}_{j}" if i > c and j > c else f"a{i}_{j}"
                for i in range(n)
                for j in range(n + 1)
            ]
            parts.append(f"pass{k}_{c} as materialized (select {', '.join(rows)} from {before})")
            before = f"pass{k}_{c}"
        for c in reversed(range(n)):
            known = " ".join(f"- a{c}_{j} * s{j}" for j in range(c + 1, n))
            parts.append(f"step{k}_{c} as materialized (select *, (a{c}_{n} {known}) / a{c}_{c} as s{c} from {before})")
            before = f"step{k}_{c}"
        moved = ", ".join(f"b{i} - s{i} as b{i}" for i in range(n))
        parts.append(f"beta{k + 1} as materialized (select {moved} from beta{k}, {before})")
    z = " + ".join(f"b{i} * {x}" for i, x in enumerate(names))
    return ",\n".join(parts) + f""",
fitted as materialized (select features.*, 1 / (1 + exp(-({z}))) as p from features, beta{passes}),
scored as materialized (
  select *, case when risk_score >= 750 then 'A - Low Risk' when risk_score >= 650 then 'B - Medium Risk'
      when risk_score >= 550 then 'C - High Risk' else 'D - Very High Risk' end as risk_tier,
    case when risk_score >= 750 then 'Approve' when risk_score >= 650 then 'Approve with conditions'
      when risk_score >= 550 then 'Manual review' else 'Reject' end as decision
  from (select *, trunc((1 - p) * 600 + 300)::int as risk_score from fitted))"""


def all_oracles() -> dict[str, str]:
    return {
        "enforce_customer": f"""with {JUDGED}
            select c_custkey, c_name, c_mktsegment, c_acctbal, joined, reason as rejection_reason from judged""",
        "enforce_orders": f"""with {ORDERS_JUDGED}
            select o_orderkey, o_placed, o_custkey, o_urgent, o_day, o_totalprice, reason as rejection_reason
            from judged""",
        "enforce_additive": f"""with {JUDGED}
            select c_custkey, c_name, c_mktsegment, c_acctbal, null::date as joined,
              case when k % 7 = 0 then null else ' x' || raw_key end as loyalty,
              case when reason = 'TYPE_CAST_FAIL:joined' then null else reason end as rejection_reason
            from judged""",
        "enforce_refused": f"""with {DELIVERED}
            select c_custkey::bigint as c_custkey, 'MISSING_MANDATORY_COLUMNS:c_name' as rejection_reason,
              '{{"c_custkey":"' || c_custkey || '","c_mktsegment":"' || c_mktsegment || '","c_acctbal":"' ||
              c_acctbal || '","joined":"' || joined || '"}}' as raw_record
            from delivered""",
        "enforce_reasons": f"""with {JUDGED}
            select 'SCHEMA_ENFORCEMENT' as rejection_layer, reason as rejection_reason, count(*) as rows
            from judged where reason is not null group by reason""",
        "reject_records": f"""with {ANNOTATED}
            select rejection_layer, rejection_reason, {RAW_CUSTOMER} as raw_record
            from annotated where rejection_layer is not null""",
        "dq_customer": f"with {CHECKED_CLEAN} select c_custkey, dq_status, dq_failed_checks, validation_flag from checked",
        "dq_profile": f"""with {CHECKED_CLEAN},
            counts as (select count(*) as total, count(*) filter (dq_status = 'PASS') as passed,
              count(*) filter (dq_status = 'WARN') as warned, count(*) filter (dq_status = 'FAIL') as failed from checked)
            select *, (failed + warned) / total as finding_share, (failed + warned) / total > 0.05 as breach from counts""",
        "dq_per_check": f"""
            select 'c_mktsegment__allowed_values' as check_name, 'SOFT_FAIL' as severity,
              count(*) filter (c_mktsegment not in {SEGMENTS}) as failed_rows from customer
            union all select 'c_name__regex', 'HARD_FAIL', count(*) filter ({NAME_FAILS}) from customer
            union all select 'c_acctbal__positive', 'SOFT_FAIL', count(*) filter (not c_acctbal > 0) from customer""",
        "dq_split": f"""with {CHECKED_CLEAN}
            select c_custkey, dq_failed_checks as rejection_reason, 'DQ_CHECK' as rejection_layer, validation_flag
            from checked where dq_status = 'FAIL'""",
        "dq_valid": f"with {CHECKED_CLEAN} select * exclude (validation_flag) from checked where validation_flag = 1",
        "dq_lineitem": f"""with {LINEITEM_GAPS}, checked as (select *, {LINEITEM_DQ} from gaps)
            select dq_status, dq_failed_checks, validation_flag, count(*) as rows, sum(l_orderkey)::bigint as key_sum
            from checked group by all""",
        "dq_dates": "select o_orderkey, "
        + _dq(
            [("not o_orderdate <= date '1999-06-30'", "o_orderdate__not_future")],
            [("not o_orderdate between date '1994-01-01' and date '1997-12-31'", "o_orderdate__date_range")],
        )
        + " from orders",
        "dq_columns": "select doc_id, "
        + _dq(
            [("not n_chars >= length(text)", "n_chars__ge_text_chars")],
            [("not length(text) >= 300", "text__min_length"), ("lang not in ('en', 'fr')", "lang__allowed_values")],
        )
        + " from documents",
        "dq_declared": "select c_custkey, "
        + _dq(
            [("c_mktsegment not in ('BUILDING','MACHINERY','HOUSEHOLD')", "c_mktsegment__allowed_values")],
            [("not regexp_matches(c_name, '[02468]$')", "c_name__regex")],
        )
        + " from customer",
        "unique_key": """select l_orderkey, l_linenumber, count(*) as key_rows from lineitem
            where l_orderkey is not null and l_linenumber is not null group by all having count(*) > 1""",
        "dq_unique": "with counted as (select *, count(*) over (partition by l_orderkey, l_linenumber) as n from lineitem), "
        "checked as (select *, "
        + _dq(
            [("n > 1", "l_orderkey_l_linenumber__unique")],
            [("l_returnflag not in ('A', 'N')", "l_returnflag__allowed_values")],
        )
        + """ from counted)
            select dq_status, dq_failed_checks, validation_flag, count(*) as rows, sum(l_orderkey)::bigint as key_sum
            from checked group by all""",
        "fk_orphans": """select o.* from orders o anti join (select * from customer where c_custkey % 7 <> 0) c
            on o.o_custkey = c.c_custkey where o.o_custkey is not null""",
        "orphans_hot": f"""with o as (select o_orderkey, ({_hot("o_custkey", "o_orderkey")})::int as o_custkey from orders)
            select o.* from o anti join (select * from customer where c_custkey % 7 <> 0) c
            on o.o_custkey = c.c_custkey where o.o_custkey is not null""",
        "unique_hot": f"""with l as (select l_orderkey, l_linenumber, {_hot("l_orderkey", "l_orderkey")} as k from lineitem),
            counted as (select *, k is not null and count(*) over (partition by k, l_linenumber) > 1 as r from l)
            select r as _is_repeated, count(*) as rows, sum(l_orderkey)::bigint as key_sum from counted group by all""",
        "features_hot": f"""with late as (select l_orderkey, max(l_quantity::int * 3 - 45) as worst from lineitem group by all),
            o as (select o_orderkey as loan_id, ({_hot("o_custkey", "o_orderkey")})::int as borrower_id from orders)
            select loan_id, borrower_id, c_acctbal as income, (c_custkey % 551 + 300)::int as credit_score,
              case when worst >= 90 then 1 else 0 end as default_flag
            from o join late on loan_id = l_orderkey left join customer on borrower_id = c_custkey""",
        "dq_exists": "with o as (select o_orderkey, case when o_orderkey % 5 <> 0 then o_custkey end as fk from orders), "
        "j as (select o.*, c_custkey from o left join customer on fk = c_custkey and c_custkey % 7 <> 0) select o_orderkey, "
        + _dq([], [("fk is not null and c_custkey is null", "o_custkey__exists")])
        + " from j",
        "quarantine_summary": f"""with {ANNOTATED} select rejection_layer, rejection_reason, count(*) as rows
            from annotated where rejection_layer is not null group by all""",
        "batch_counts": f"""with {ANNOTATED} select count(*) as read,
              count(*) filter (rejection_layer = 'SCHEMA_ENFORCEMENT') as schema_rejected,
              count(*) filter (rejection_layer = 'DQ_CHECK') as dq_failed,
              count(*) filter (rejection_layer is null) as valid,
              count(*) filter (dq_status = 'WARN') as warned from annotated""",
        "row_hash_customer": """select c_custkey, md5(concat_ws('|', coalesce(c_custkey::varchar, 'NULL'),
              coalesce(c_name, 'NULL'), coalesce(c_nationkey::varchar, 'NULL'), coalesce(c_acctbal::varchar, 'NULL'),
              coalesce(c_mktsegment, 'NULL'))) as _row_md5 from customer""",
        "row_hash_lineitem": f"select l_orderkey, l_linenumber, {LINEITEM_MD5} as _row_md5 from lineitem",
        "raw_rows": f"""with {ANNOTATED}
            select c_custkey, c_name, c_mktsegment, c_acctbal, joined, dq_status, dq_failed_checks, validation_flag,
              'run-1' as _pipeline_run_id, 'customer' as _source_dataset, '2024-01-15' as _dt,
              md5(raw_key || '|' || c_name) as _row_md5
            from annotated where rejection_layer is null""",
        "dedup_hash": f"""
            with loads as (select l_orderkey, l_linenumber, {LINEITEM_MD5} as _row_md5 from lineitem),
            doubled as (select *, 1 as _raw_load_ts, 'a' as _pipeline_run_id from loads
              union all select *, 2, 'b' from loads)
            select * from doubled
            qualify row_number() over (partition by _row_md5 order by _raw_load_ts, _pipeline_run_id) = 1""",
        "cleanse": r"""select c_custkey, regexp_replace('+91-' || c_name || chr(32) || chr(9) || '9-', '[-\s]', '', 'g') as compact,
              regexp_replace('+91-' || c_name || ' 9-', '[^0-9+]', '', 'g') as phone from customer""",
        "scd2_customer": _versions([DAY_1, DAY_2]),
        "scd2_rerun": _versions([DAY_1, DAY_2]),
        "scd2_three_days": _versions([DAY_1, DAY_2, DAY_3]),
        "reconcile_customer": """
            with raw as (select c_custkey, case when c_custkey % 9 <> 0 then c_mktsegment end as c_mktsegment from customer),
            a as (select c_mktsegment, count(*) as n from raw group by all),
            b as (select c_mktsegment, count(*) as n from raw where c_custkey % 13 <> 0 or c_mktsegment = 'BUILDING' group by all)
            select coalesce(a.c_mktsegment, b.c_mktsegment) as c_mktsegment, coalesce(a.n, 0) as raw_rows,
              coalesce(b.n, 0) as staging_rows, coalesce(a.n, 0) - coalesce(b.n, 0) as diff,
              case when coalesce(a.n, 0) = coalesce(b.n, 0) then 'MATCH' else 'MISMATCH' end as status
            from a full join b on a.c_mktsegment is not distinct from b.c_mktsegment""",
        "evolution_refused": f"""with {ANNOTATED}, refused as (
              select coalesce(rejection_layer, 'SCHEMA_ENFORCEMENT') as rejection_layer,
                coalesce(rejection_reason, 'INCOMPATIBLE_SCHEMA:TYPE_CHANGE:c_acctbal,COLUMN_REMOVED:c_nationkey')
                  as rejection_reason from annotated)
            select rejection_layer, rejection_reason, count(*) as rows from refused group by all""",
        "loan_features": f"with {FEATURES} select {FEATURE_COLUMNS} from features",
        "loan_matrix": f"with {FEATURES} select {MATRIX_COLUMNS} from features",
        "loan_features_export": f"with {FEATURES} select {MATRIX_COLUMNS} from features",
        "loan_preview": f"""with {FEATURES} select loan_id, max_days_past_due, default_flag from features
            order by loan_id limit 5""",
        "default_counts": f"with {FEATURES} select default_flag, count(*) as rows from features group by all",
        "default_rate": f"with {FEATURES} select round(avg(default_flag), 9) as default_rate from features",
        "correlation_matrix": f"with {FEATURES} {_pairs()}",
        "label_correlations": f"""with {LABELLED} select feature, round(r, 6) as correlation from correlations
            union all select 'default_flag', round(corr(default_flag, default_flag), 6) from features""",
        "risk_drivers": f"""with {RANKED} select 'risk' as driver, feature, round(r, 6) as correlation from ranked where top <= 3
            union all select 'protective', feature, round(r, 6) from ranked where bottom <= 3""",
        "driver_narration": f"""with {RANKED} select feature, 'Higher ' || feature ||
              case when r >= 0 then ' increases' else ' decreases' end || ' default risk (correlation ' ||
              round(r, 2)::varchar || ')' as narration from ranked where top <= 3""",
        "loan_split": f"""select o_orderkey as loan_id,
              case when {IS_TEST.format('o_orderkey')} then 'test' else 'train' end as split from orders""",
        "loan_scores": f"""with {SCORED} select loan_id, round(p, 9) as default_probability, risk_score, risk_tier, decision
            from scored""",
        "tier_counts": f"with {SCORED} select risk_tier, count(*) as rows from scored where risk_tier is not null group by all",
        "score_quality": f"""with {SCORED},
            test as (select p, default_flag as y from scored where {IS_TEST.format('loan_id')}),
            ranks as (select *, rank() over (order by p) + (count(*) over (partition by p) - 1) / 2 as r from test),
            sums as (select sum(r) filter (y = 1) as s, count(*) filter (y = 1) as n1, count(*) filter (y = 0) as n0,
              avg(case when (p > 0.5)::int = y then 1.0::double else 0 end) as accuracy from ranks)
            select round(accuracy, 9) as accuracy, round((s - n1 * (n1 + 1) / 2) / (n1 * n0), 6) as area_under_roc from sums""",
        "incomplete_loans": f"""with {FEATURES} select count(*) filter (loan_id % 6 = 0 or income is null or
              emi_income_ratio is null or credit_score is null) as incomplete_rows, count(*) as rows from features""",
        "loan_features_csv": """
            with paid as (select l_orderkey::varchar as loan_id, l_linenumber,
                case when l_orderkey % 50 <> 0 then l_quantity::int * 3 - 45 end as dpd from lineitem),
            history as (select loan_id, max(dpd)::double as max_days_past_due, count(*) filter (dpd > 0) as late_payment_count,
                count(l_linenumber) as total_payments from paid group by all)
            select loan_id, max_days_past_due, late_payment_count, total_payments, o_custkey::varchar as borrower_id,
              case when o_custkey % 40 <> 0 then c_acctbal end as income, (c_custkey % 551 + 300)::int as credit_score,
              (o_orderkey % 48 + 12)::int as tenure, case when max_days_past_due >= 90 then 1 else 0 end as default_flag
            from history join orders on loan_id = o_orderkey::varchar left join customer on o_custkey = c_custkey""",
        "synthetic_employees": f"with {EMPLOYEES} select * from people",
        "synthetic_payroll": f"with {EMPLOYEES}, {PAYROLL} select * from payslips",
        "synthetic_employee_counts": f"""with {EMPLOYEES}, judged as (select {_first_null(_MANDATORY_PEOPLE)} as reason from people)
            select case when reason is not null then 'SCHEMA_ENFORCEMENT' end as rejection_layer,
              reason as rejection_reason, count(*) as rows from judged group by all""",
        "synthetic_payroll_counts": f"""with {EMPLOYEES}, {PAYROLL},
            judged as (select p.*, {_first_null(_MANDATORY_PAY)} as reason from payslips p),
            joined as (select reason, e.employee_id is null as orphan from judged j left join
              (select distinct employee_id from people where id % 3 <> 0) e on e.employee_id = j.employee_id)
            select case when reason is null then case when orphan then 'WARN' else 'PASS' end end as dq_status,
              case when reason is null then case when orphan then 'employee_id__exists' else '' end end as dq_failed_checks,
              reason as rejection_reason, count(*) as rows from joined group by all""",
        "csv_valid": f"""with {ORDERS_FILES}
            select o_orderkey, o_placed, o_custkey, o_urgent, o_day, o_totalprice, dq_status, dq_failed_checks,
              'run-1' as _pipeline_run_id, 'orders' as _source_dataset, '2024-01-15' as _dt
            from annotated where rejection_layer is null""",
        "csv_quarantine": f"""with {ORDERS_FILES}
            select rejection_layer, rejection_reason,
              case when not uneven then texts when k % 61 = 0 then short_line else short_line || ',' || r_price || ',x' end
                as raw_record, 'run-1' as pipeline_run_id
            from annotated where rejection_layer is not null""",
        "csv_summary": f"""with {ORDERS_FILES}
            select 'orders' as dataset, 'run-1' as pipeline_run_id, rejection_layer, rejection_reason, count(*) as rows
            from annotated where rejection_layer is not null group by all""",
        "csv_audit": f"""with {ORDERS_FILES}, counts as (select count(*) as read,
              count(*) filter (rejection_layer = 'SCHEMA_ENFORCEMENT') as schema_rejected,
              count(*) filter (rejection_layer = 'DQ_CHECK') as dq_failed,
              count(*) filter (rejection_layer is null) as valid,
              count(*) filter (reason is null and dq_status = 'WARN') as warned from annotated)
            select 'orders' as dataset, '2024-01-15' as run_date, 'run-1' as run_id, 'PARTIAL' as status, *,
              (dq_failed + warned) / (read - schema_rejected) > 0.05 as breach, false as escalated from counts""",
        "quarantine_escalated": f"""with {ANNOTATED} select t_key as raw_key,
              coalesce(rejection_layer, 'DQ_CHECK') as rejection_layer, coalesce(rejection_reason, dq_failed_checks) as rejection_reason
            from annotated where rejection_layer is not null or dq_status = 'WARN'""",
        "evolution_three_days": """with n as (select count(*) as n from part), d as (select unnest([1, 2, 3, 4]) as d)
            select '2024-01-0' || d as run_date, case when d in (2, 3) then 'FAILED' else 'SUCCESS' end as status,
              case when d in (2, 3) then 0 else n end as valid, case when d in (2, 3) then n else 0 end as schema_rejected
            from d, n""",
        "quarantine_evolution": """select p_partkey, 'SCHEMA_ENFORCEMENT' as rejection_layer,
              'INCOMPATIBLE_SCHEMA:TYPE_CHANGE:p_size' as rejection_reason from part""",
        "partitioned_two_days": "select lpad((o_orderkey % 2)::varchar, 3, '0') as half, count(*) as rows from orders group by all",
        "scd2_new_column": """
            with a as (select * from customer where c_custkey % 10 <> 0), b as (select * from customer where c_custkey % 13 <> 0),
            pairs as (select coalesce(a.c_custkey, b.c_custkey) as c_custkey, a.c_custkey is not null as old,
                b.c_custkey is not null as new, coalesce(a.c_name, b.c_name) as name,
                coalesce(a.c_mktsegment, b.c_mktsegment) as segment, coalesce(a.c_custkey, b.c_custkey) % 7 = 0 as changed
              from a full join b on a.c_custkey = b.c_custkey)
            select c_custkey, name as c_name, segment as c_mktsegment, null::bigint as grade, date '2024-01-01' as effective_from,
              case when not new or changed then date '2024-01-02' end as effective_to, new and not changed as is_current
            from pairs where old
            union all
            select c_custkey, null, case when changed then 'CHANGED' else segment end, c_custkey % 4, date '2024-01-02', null, true
            from pairs where new and (not old or changed)""",
        "landing_folder": f"""with {DELIVERED},
            c as (select k, c_name, case when trim(c_mktsegment, ' ') in {TOKENS} then null else c_mktsegment end as s from delivered)
            select k as c_custkey, c_name, case when k % 3 <> 2 then s end as c_mktsegment,
              case when k % 3 = 0 then 'x' end as loyalty, null::varchar as rejection_reason from c""",
        "stream_summary": f"""with {ORDERS_FILES},
            outcomes as (select case when reason is not null then 'SCHEMA_ENFORCEMENT' else 'DQ_CHECK' end as rejection_layer,
                coalesce(reason, case when not o_totalprice > 0 then 'o_totalprice__positive' end) as rejection_reason from annotated)
            select 'orders' as dataset, rejection_layer, rejection_reason, count(*) as rows
            from outcomes where rejection_reason is not null group by all""",
        "stream_audit": f"""with {ORDERS_FILES},
            outcomes as (select reason is not null as s, reason is null and coalesce(not o_totalprice > 0, false) as d from annotated)
            select 'orders' as dataset, 'PARTIAL' as status, count(*) as read, count_if(s)::bigint as schema_rejected,
              count_if(d)::bigint as dq_failed, count_if(not s and not d)::bigint as valid from outcomes""",
        "contract_table": f"""with {DELIVERED}, c as (select {_clean("c_mktsegment")} as c_mktsegment from delivered)
            select c_mktsegment, count(*) as rows from c where c_mktsegment is not null group by all""",
        "stream_unique": """with r as (
              select 1 as wave, o_orderkey as k, false as again from orders where o_orderkey % 4 <> 0
              union all select 2, o_orderkey, o_orderkey % 5 = 1 from orders where o_orderkey % 4 = 0
              union all select 2, o_orderkey, true from orders where o_orderkey % 5 = 1
              union all select 3, o_orderkey, true from orders where o_orderkey % 7 = 2)
            select wave, case when again then 'o_orderkey__unique' else '' end as dq_failed_checks, count(*) as rows,
              sum(k)::bigint as key_sum from r group by all""",
        "stream_evolution": """with n as (select count(*)::bigint as n from part)
            select '2024-01-01' as run_date, 'SUCCESS' as status, n as valid, 0::bigint as schema_rejected from n
            union all select '2024-01-02', 'FAILED', 0, n from n""",
        "stream_verified": """with nations as (
              select c_nationkey as n, c_nationkey % 7 <> 6 and c_nationkey % 4 <> 1 as claimed, c_nationkey % 11 <> 3 as sound
              from customer group by all),
            checks as (
              select 'nation_' || lpad(n::varchar, 8, '0') || '.csv' as file_name, 'PASS' as file_arrived, 'PASS' as filename_pattern,
                case when claimed then 'PASS' else 'FAIL' end as manifest_present,
                case when claimed then case when sound then 'PASS' else 'FAIL' end end as manifest_parseable,
                case when claimed and sound then case when n % 5 = 0 then 'FAIL' else 'PASS' end end as checksum_match,
                case when claimed and sound then 'PASS' end as row_count_match,
                case when claimed and sound then 'PASS' end as file_size_match
              from nations)
            select *, error_count = 0 as passed from (select *, ((manifest_present = 'FAIL')::int
              + coalesce((manifest_parseable = 'FAIL')::int, 0) + coalesce((checksum_match = 'FAIL')::int, 0))::int as error_count from checks)""",
        "loan_model": f"""with {FEATURES}, {_fitted()}
            select loan_id, round(p, 8) as default_probability, (p > 0.5)::int::double as prediction, risk_score, risk_tier, decision
            from scored""",
        "loan_assessment": f"""with {FEATURES}, {_fitted()},
            test as (select p, default_flag as y from scored where {IS_TEST.format('loan_id')}),
            ranks as (select *, rank() over (order by p) + (count(*) over (partition by p) - 1) / 2 as r from test),
            sums as (select sum(r) filter (y = 1) as s, count(*) filter (y = 1) as n1, count(*) filter (y = 0) as n0,
              avg(case when (p > 0.5)::int = y then 1.0::double else 0 end) as accuracy from ranks)
            select decision, count(*) as rows, round(any_value(accuracy), 9) as accuracy,
              round(any_value((s - n1 * (n1 + 1) / 2) / (n1 * n0)), 6) as area_under_roc from scored, sums group by decision""",
        "delivery_checks": """with nations as (
              select n, n % 6 <> 0 as named, n % 7 <> 3 as claimed, n % 5 <> 4 as sound
              from (select c_nationkey as n from customer union select 8)),
            checks as (
              select 'nation_' || case when named then lpad(n::varchar, 8, '0') else n::varchar end || '.csv' as file_name,
                'PASS' as file_arrived, case when named then 'PASS' else 'FAIL' end as filename_pattern,
                case when claimed then 'PASS' else 'FAIL' end as manifest_present,
                case when claimed then case when sound then 'PASS' else 'FAIL' end end as manifest_parseable,
                case when claimed and sound then 'PASS' end as checksum_match, case when claimed and sound then 'PASS' end as row_count_match,
                case when claimed and sound then 'PASS' end as file_size_match
              from nations)
            select *, error_count = 0 as passed from (select *, ((filename_pattern = 'FAIL')::int + (manifest_present = 'FAIL')::int
              + coalesce((manifest_parseable = 'FAIL')::int, 0))::int as error_count from checks)""",
        "deliveries_job": f"""with {_DELIVERED_ROWS}
            {_daily(1, "customer", "when 'part' then 'row_count_match'")} union all
            {_daily(2, "part", "when 'customer' then 'row_count_match'")}""",
        "delivery_job": f"""with {_DELIVERED_ROWS} {_daily(1, "customer", "when 'part' then 'row_count_match'")}""",
        "contract_table_dates": """select make_date(2024, 1, d::bigint) as load_date, count(*) as rows, sum(o_orderkey)::bigint as key_sum
            from orders, (select unnest([1, 2, 3]) as d) where o_orderkey % 4 >= d group by all""",
        "scd2_backfill": _versions([DAY_1, DAY_2, DAY_3]),
        "loan_fit": f"""with {FEATURES},
            n as (select count(*) as train_rows from features where not {IS_TEST.format('loan_id')})
            select unnest(['intercept', 'late_payment_ratio', 'missed_payment_count', 'emi_income_ratio', 'income', 'credit_score',
              'loan_amount', 'tenure']) as feature, train_rows, true as optimal from n""",
        "file_rows": "select c_nationkey, count(*) as data_rows, 1::bigint as files from customer group by all",
        "file_verification": f"with {VERIFIED} select *, error_count = 0 as passed from counted",
        "raw_partition": """select o_orderkey, o_orderstatus, year(o_orderdate)::int as y from orders
            where year(o_orderdate) = 1997""",
        "raw_table": """select make_date(year(o_orderdate)::bigint, 1::bigint, 1::bigint) as dt, count(*) as rows,
              sum(o_orderkey)::bigint as key_sum
            from orders where year(o_orderdate) >= 1997 group by all""",
        "stream_ingest": f"""with {ORDERS_FILES},
            outcomes as (select coalesce(reason, case when not o_totalprice > 0 then 'o_totalprice__positive' end) as rejection_reason
              from annotated)
            select case when rejection_reason is null then 'valid' else 'quarantine' end as zone, rejection_reason,
              count(*) as rows from outcomes group by all""",
        "staging_dimension": _versions([DAY_1, DAY_2]),
        "staging_reconciled": """
            with day as (select case when c_custkey % 7 = 0 then 'CHANGED' else c_mktsegment end as c_mktsegment
              from customer where c_custkey % 13 <> 0)
            select c_mktsegment, count(*) as raw_rows, count(*) as staging_rows, 0::bigint as diff, 'MATCH' as status
            from day group by all""",
        "landing_files": f"""with {JUDGED},
            undated as (select * replace (case when k % 3 = 2 and reason = 'TYPE_CAST_FAIL:joined' then null else reason end as reason)
              from judged),
            checked as (select *, {CUSTOMER_DQ} from undated)
            select coalesce(reason, case when validation_flag = 0 then dq_failed_checks else 'valid' end) as outcome,
              k % 3 = 2 as has_loyalty, count(*) as rows from checked group by all""",
    }
