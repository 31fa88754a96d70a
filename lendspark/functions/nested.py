"""Aggregates inside one bureau report: arrays in, one value out, no explode and no shuffle."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lendspark.functions.text import compact_date_to_iso, element_text, float_or_zero

SEVERE = "1"
CLOSED_CASE = "90"
ACTUAL = "1"


def _rows(c: Column, element_type: str) -> Column:
    return F.coalesce(c, F.array().cast(f"array<{element_type}>"))


def payment_orders(c: Column) -> Column:
    return _rows(c, "struct<Severity:string,Amount:string>")


def court_cases(c: Column) -> Column:
    return _rows(c, "struct<CaseStatusCode:string,InitialTotalClaimAmount:string>")


def employments(c: Column) -> Column:
    return _rows(
        c,
        "struct<UpdateInfo:array<struct<DateOfUpdate:string>>,"
        "EmploymentInfo:struct<GrossAnnualIncome:string,ActualFlag:string>>",
    )


def _total(amounts: Column) -> Column:
    return F.aggregate(amounts, F.lit(0.0), lambda acc, x: acc + x)


def _severe(orders: Column) -> Column:
    return F.filter(payment_orders(orders), lambda o: element_text(o["Severity"]).eqNullSafe(SEVERE))


def bounced_cheque_count(orders: Column) -> Column:
    return F.size(_severe(orders))


def bounced_cheque_total(orders: Column) -> Column:
    return _total(F.transform(_severe(orders), lambda o: float_or_zero(element_text(o["Amount"]))))


def case_count(cases: Column) -> Column:
    return F.size(court_cases(cases))


def open_case_count(cases: Column) -> Column:
    """Cases not marked closed; a case without a status counts as open."""
    closed = lambda c: element_text(c["CaseStatusCode"]).eqNullSafe(CLOSED_CASE)
    return F.size(F.filter(court_cases(cases), lambda c: ~closed(c)))


def claim_total(cases: Column) -> Column:
    return _total(
        F.transform(court_cases(cases), lambda c: float_or_zero(element_text(c["InitialTotalClaimAmount"])))
    )


def latest_income(history: Column) -> Column:
    """Income of the actual employment with the latest update; the first one wins a tie."""
    dates = lambda e: F.transform(
        F.filter(
            F.coalesce(e["UpdateInfo"], F.array().cast("array<struct<DateOfUpdate:string>>")),
            lambda u: F.coalesce(element_text(u["DateOfUpdate"]), F.lit("")) != "",
        ),
        lambda u: compact_date_to_iso(element_text(u["DateOfUpdate"])),
    )
    dated = F.transform(
        employments(history),
        lambda e, i: F.struct(
            F.array_max(dates(e)).alias("updated"),
            (-i).alias("earlier_first"),
            float_or_zero(element_text(e["EmploymentInfo"]["GrossAnnualIncome"])).alias("income"),
            element_text(e["EmploymentInfo"]["ActualFlag"]).alias("flag"),
        ),
    )
    usable = F.filter(dated, lambda d: d["flag"].eqNullSafe(ACTUAL) & d["updated"].isNotNull())
    return F.array_max(usable)["income"]
