"""Decision rule packs as Catalyst expressions: no Python runs per row.

A pack is an ordered list of gates. The first closed gate decides: a gate over several signals gives
every reason that applies, a single one its own reason. If none is closed, the answer is APPROVE. Packs read
no personal fields, so they decide alike on tokenised vectors.

Fixed values: pack versions, thresholds, reason codes and the order of the gates appear in stored decisions and
must not change within a version.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from lendspark.config import BNPL, CREDIT_CARD_ALT, PERSONAL_FINANCE

Field = Callable[[str], Column]


def _holds(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def _listed(conditions: Iterable[tuple[Column, str]]) -> Column:
    texts = [F.when(c, F.lit(text)) for c, text in conditions]
    return F.filter(F.array(*texts), lambda t: t.isNotNull())


def _hard_signals(v: Field) -> list[tuple[Column, str]]:
    return [
        (v("aml_status") == "HIT", "AML_HIT"),
        (v("fraud_decision") == "FAIL", "FRAUD_FAIL"),
        (v("payment_order_flag") & (v("num_bounced_cheques") >= 3), "MULTIPLE_BOUNCED_CHEQUES"),
        (v("num_open_court_cases") > 0, "OPEN_COURT_CASE"),
    ]


def _review_signals(v: Field) -> list[tuple[Column, str]]:
    return [
        (~v("aecb_available"), "AECB_MISSING"),
        (~v("aml_available"), "AML_PENDING"),
        (v("aml_status") == "REVIEW", "AML_REVIEW"),
        (v("fraud_decision") == "REVIEW", "FRAUD_REVIEW"),
    ]


def hard_declines(v: Field) -> Column:
    """Every reason that declines whatever the product."""
    return _listed(_hard_signals(v))


def refer_signals(v: Field) -> Column:
    """Every reason for manual review that is common to the products."""
    return _listed(_review_signals(v))


class Gate(NamedTuple):
    closed: Column
    outcome: str
    reasons: Column


def _any(outcome: str, signals: list[tuple[Column, str]]) -> Gate:
    """Closed if any signal holds; the reasons are all that hold. The list is built only then."""
    closed = reduce(or_, [_holds(c) for c, _ in signals])
    return Gate(closed, outcome, _listed(signals))


def decline_if(condition: Column, reason: str) -> Gate:
    return Gate(_holds(condition), "DECLINE", F.array(F.lit(reason)))


def refer_if(condition: Column, reason: str) -> Gate:
    return Gate(_holds(condition), "REFER", F.array(F.lit(reason)))


def first_closed(gates: Iterable[Gate]) -> Column:
    """struct(outcome, reason_codes) of the first closed gate, or approval."""

    def answer(outcome: str, reasons: Column) -> Column:
        return F.struct(F.lit(outcome).alias("outcome"), reasons.alias("reason_codes"))

    chain = reduce(lambda done, gate: done.when(gate.closed, answer(gate.outcome, gate.reasons)), gates, F)
    return chain.otherwise(answer("APPROVE", F.array(F.lit("ALL_CHECKS_PASSED"))))


@dataclass(frozen=True)
class RulePack:
    product: str
    version: str
    gates: Callable[[Field], list[Gate]]

    def evaluate(self, v: Field) -> Column:
        return first_closed(self.gates(v))


def _personal_finance(v: Field) -> list[Gate]:
    return [
        _any("DECLINE", _hard_signals(v)),
        decline_if(v("had_overdue_before"), "INTERNAL_OVERDUE_HISTORY"),
        decline_if(v("credit_score").isNull() | (v("credit_score") < 650), "CREDIT_SCORE_BELOW_650"),
        decline_if(v("num_bounced_cheques") >= 1, "BOUNCED_CHEQUE_HISTORY"),
        decline_if(v("gross_annual_income") < 60000, "INCOME_BELOW_60000"),
        refer_if(v("kyc_age_days") < 60, "KYC_TOO_NEW"),
        refer_if(v("is_new_user"), "NEW_USER_ON_PLATFORM"),
        refer_if(v("fraud_score") > 400, "FRAUD_SCORE_ABOVE_400"),
        _any("REFER", _review_signals(v)),
    ]


def _bnpl(v: Field) -> list[Gate]:
    bureau = v("aecb_available")
    return [
        _any("DECLINE", _hard_signals(v)),
        refer_if(~v("aml_available"), "AML_PENDING"),
        refer_if(v("aml_status") == "REVIEW", "AML_REVIEW"),
        refer_if(v("fraud_score") > 600, "FRAUD_SCORE_ABOVE_600"),
        decline_if(bureau & (v("credit_score") < 550), "CREDIT_SCORE_BELOW_550"),
        decline_if(bureau & (v("num_bounced_cheques") >= 2), "MULTIPLE_BOUNCED_CHEQUES"),
        refer_if(v("fraud_decision") == "REVIEW", "FRAUD_REVIEW"),
    ]


def _credit_card_alt(v: Field) -> list[Gate]:
    return [
        _any("DECLINE", _hard_signals(v)),
        refer_if(~v("aecb_available"), "AECB_MISSING"),
        decline_if(v("credit_score") < 600, "CREDIT_SCORE_BELOW_600"),
        decline_if(v("num_bounced_cheques") >= 2, "MULTIPLE_BOUNCED_CHEQUES"),
        refer_if(v("kyc_age_days") < 30, "KYC_TOO_NEW"),
        refer_if(v("fraud_score") > 500, "FRAUD_SCORE_ABOVE_500"),
        _any("REFER", _review_signals(v)),
    ]


# The last pack of a product is its current one; earlier ones stay for replay.
PACKS: tuple[RulePack, ...] = (
    RulePack(PERSONAL_FINANCE, "pf_v1.1.0", _personal_finance),
    RulePack(BNPL, "bnpl_v1.1.0", _bnpl),
    RulePack(CREDIT_CARD_ALT, "cca_v1.1.0", _credit_card_alt),
)


def current_packs(packs: Iterable[RulePack] = PACKS) -> dict[str, RulePack]:
    return {pack.product: pack for pack in packs}


def _choose(cases: Iterable[tuple[Column, Column]]) -> Column:
    """The value of the first case whose condition holds."""
    return reduce(lambda chain, case: chain.when(*case), cases, F)


def evaluate_current(product: Column, v: Field, packs: Iterable[RulePack] = PACKS) -> Column:
    """struct(outcome, reason_codes, rule_pack_version) of the product's current pack."""

    def answer(pack: RulePack) -> Column:
        decided = pack.evaluate(v)
        return F.struct(
            decided["outcome"].alias("outcome"),
            decided["reason_codes"].alias("reason_codes"),
            F.lit(pack.version).alias("rule_pack_version"),
        )

    return _choose((product == p.product, answer(p)) for p in current_packs(packs).values())


def evaluate_version(
    product: Column, version: Column, v: Field, packs: Iterable[RulePack] = PACKS
) -> Column:
    """struct(outcome, reason_codes) of the pack named by product and version.

    A version that is no longer registered is judged by the product's current pack.
    """
    packs = list(packs)
    exact = [((product == p.product) & (version == p.version), p.evaluate(v)) for p in packs]
    current = [(product == p.product, p.evaluate(v)) for p in current_packs(packs).values()]
    return _choose(exact + current)
