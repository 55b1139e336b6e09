"""Every business threshold in one place; operators take a `Rules` instance."""
from __future__ import annotations

from dataclasses import dataclass, field
from decimal import Decimal

# Countries, currency zone, currencies and entity types of the data contract.
COUNTRIES = ("CI", "SN", "ML", "BF", "GN", "TG", "BJ", "GH")
XOF_ZONE = ("CI", "SN", "ML", "BF", "GN", "TG", "BJ")
CURRENCIES = ("XOF", "GHS")
ENTITY_TYPES = ("BANK", "INSURANCE", "MOBILE_MONEY", "MICROFINANCE")
# Fixed value: the euro peg of the CFA franc.
XOF_PER_EUR = Decimal("655.957")


def xof_in_eur(amount: int) -> Decimal:
    return (Decimal(amount) / XOF_PER_EUR).quantize(Decimal("0.01"))


@dataclass(frozen=True)
class Rules:
    high_value_xof: int = 10_000_000
    aberrant_eur: Decimal = Decimal(1_000_000)
    future_tolerance: str = "1 day"
    npl_overdue_days: int = 90
    npl_limit: Decimal = Decimal("0.05")
    loss_ratio_limit: Decimal = Decimal("0.70")
    large_txn_xof: int = 500_000
    burst_min_count: int = 2
    window: str = "5 minutes"
    slide: str = "1 minute"
    watermark: str = "10 minutes"
    dedup_window: str = "10 minutes"
    aml_limits: dict[str, Decimal] = field(
        default_factory=lambda: {"XOF": Decimal(1_000_000), "GHS": Decimal(5_000)})
    claim_premium_multiple: int = 3
    premium_days: int = 365
    reserve_ratio: Decimal = Decimal("0.03")
    liquidity_share: Decimal = Decimal("0.5")
    repeat_seconds: int = 300
    repeat_history_minutes: int = 60
    claim_sla_days: int = 30

    @property
    def high_value_eur(self) -> Decimal:
        return xof_in_eur(self.high_value_xof)

    @property
    def large_txn_eur(self) -> Decimal:
        return xof_in_eur(self.large_txn_xof)


DEFAULT_RULES = Rules()
