"""Data-quality checks.  A check is a name, a severity and a Column that is false where the row
fails.  True and NULL pass, so a predicate over a NULL value needs no special case: NULL passes
every check but ``not_null``."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidegate.contract import HARD, SOFT, Rule


@dataclass(frozen=True)
class Check:
    name: str
    column: str
    severity: str
    passed: Column
    kind: str = ""

    @property
    def failure(self) -> Column:
        """The check's name where the row fails, else NULL."""
        return F.when(~self.passed, F.lit(self.name))


@dataclass(frozen=True)
class CheckKind:
    """How one kind of rule becomes a predicate.  ``label`` is what the check name ends with."""

    label: str
    predicate: Callable[[Column, Mapping[str, Any]], Column]


def _day(value: Any) -> Column:
    return F.lit(value).cast("date")


def _not_future(c: Column, p: Mapping[str, Any]) -> Column:
    today = F.current_date() if p.get("as_of") is None else _day(p["as_of"])
    return c <= today


def _positive(c: Column, p: Mapping[str, Any]) -> Column:
    number = c.try_cast("double")
    return (number > 0) & (number != float("nan"))


def _column_ge(c: Column, p: Mapping[str, Any]) -> Column:
    return c >= F.col(p["other"])


KINDS: dict[str, CheckKind] = {
    "not_null": CheckKind("not_null", lambda c, p: c.isNotNull()),
    "allowed_values": CheckKind("allowed_values", lambda c, p: c.isin(list(p["allowed"]))),
    "regex_match": CheckKind("regex", lambda c, p: c.rlike(p["pattern"])),
    "min_length": CheckKind("min_length", lambda c, p: F.length(c) >= int(p["min_length"])),
    "positive_number": CheckKind("positive", _positive),
    "date_not_future": CheckKind("not_future", _not_future),
    "date_range": CheckKind(
        "date_range", lambda c, p: c.between(_day(p["min_date"]), _day(p["max_date"]))
    ),
    "column_ge": CheckKind("ge", _column_ge),
}

# Rules that need no check of their own: the typed cast has already judged the format.
COVERED_BY_CAST = frozenset({"date_format"})


def register_kind(rule: str, label: str, predicate: Callable[[Column, Mapping[str, Any]], Column]) -> None:
    """Add a kind of check: ``predicate(column, params)`` is false where the row fails."""
    if rule in KINDS or rule in COVERED_BY_CAST:
        raise ValueError(f"check {rule!r} is already registered")
    KINDS[rule] = CheckKind(label, predicate)


def build_checks(rules: Iterable[Rule], as_of: Any = None) -> list[Check]:
    """Rules to checks, in rule order.

    ``as_of`` stands in for today in ``date_not_future`` so that a rerun judges rows alike.
    A repeated name gets an ordinal, so no check hides another.
    """
    seen: Counter[str] = Counter()
    checks = []
    for r in rules:
        if r.check in COVERED_BY_CAST:
            continue
        if r.check not in KINDS:
            raise ValueError(f"rule on {r.column!r}: unknown check {r.check!r}")
        kind = KINDS[r.check]
        params = dict(r.params)
        if as_of is not None:
            params.setdefault("as_of", as_of)
        name = params.get("name") or f"{r.column}__{kind.label}"
        if r.check == "column_ge" and "name" not in params:
            name = f"{name}_{params['other']}"
        seen[name] += 1
        if seen[name] > 1:
            name = f"{name}_{seen[name]}"
        passed = kind.predicate(F.col(r.column), params)
        checks.append(Check(name, r.column, r.severity, passed, r.check))
    return checks


def not_null(column: str, severity: str = HARD) -> Rule:
    return Rule(column, "not_null", severity)


def allowed_values(column: str, allowed: Iterable[Any], severity: str = SOFT) -> Rule:
    return Rule(column, "allowed_values", severity, {"allowed": list(allowed)})


def regex_match(column: str, pattern: str, severity: str = SOFT) -> Rule:
    return Rule(column, "regex_match", severity, {"pattern": pattern})


def min_length(column: str, length: int, severity: str = SOFT) -> Rule:
    return Rule(column, "min_length", severity, {"min_length": length})


def positive_number(column: str, severity: str = SOFT) -> Rule:
    return Rule(column, "positive_number", severity)


def date_not_future(column: str, severity: str = SOFT) -> Rule:
    return Rule(column, "date_not_future", severity)


def date_range(column: str, min_date: str, max_date: str, severity: str = SOFT) -> Rule:
    return Rule(column, "date_range", severity, {"min_date": min_date, "max_date": max_date})


def column_ge(column: str, other: str, severity: str = SOFT, name: str | None = None) -> Rule:
    params = {"other": other} if name is None else {"other": other, "name": name}
    return Rule(column, "column_ge", severity, params)


def gross_salary_consistency(severity: str = SOFT) -> Rule:
    return column_ge("gross_salary", "basic_salary", severity, name="gross_salary__ge_basic")
