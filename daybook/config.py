"""Everything a business may want to change, in one immutable object."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass, field
from types import MappingProxyType

# Canonical column -> column of the raw table, for raw exports whose headers went through
# ``functions.headers.clean_headers``.
MEMBER_EXPORT = MappingProxyType({
    "card_no": "card_no",
    "channel": "enrollment_channel_code",
    "enrollment_date": "enrollment_date",
    "dob": "dob",
    "anniversary": "anniversary",
    "point_balance": "point_balance",
})
TRANSACTION_EXPORT = MappingProxyType({
    "card_no": "card_no",
    "invoice_date": "invoice_date",
    "channel": "channel",
    "category": "category",
    "amount": "eligible_amt",
})
CAMPAIGN_EXPORT = MappingProxyType({
    "deployment_date": "deployment_date",
    "target_count": "target_count",
    "buyers": "buyers",
    "incremental_rev": "incremental_rev",
    "sale_value_1": "sale_value_1",
    "conversion_1": "conversion_1",
    "channel": "channel",
    "brand": "brand",
    "region": "region",
})

# The same for tables that follow the declared schemas of ``sources.schemas``.
MEMBER_DECLARED = MappingProxyType({
    **MEMBER_EXPORT,
    "channel": "enrollmentchannelcode",
    "enrollment_date": "enrollmentdate",
    "point_balance": "pointbalance",
})
TRANSACTION_DECLARED = MappingProxyType({
    **TRANSACTION_EXPORT,
    "card_no": "cardno",
    "amount": "eligible_amount",
})
CAMPAIGN_DECLARED = MappingProxyType({
    "deployment_date": "Deployment_date",
    "target_count": "Target_Count",
    "buyers": "Buyers",
    "incremental_rev": "Incremental_rev",
    "sale_value_1": "Sale_Value1",
    "conversion_1": "Conversion1",
    "channel": "Channel",
    "brand": "Brand",
    "region": "Region",
})


@dataclass(frozen=True)
class Config:
    """Business settings of the daily measures.

    ``semantics="corrected"`` (default) computes what each measure is meant to be;
    ``"reference"`` keeps the literal results of the job this library replaces, on a lenient
    (non-ANSI) Spark. The README lists where the two differ.
    """

    focus_channel: str
    program_channels: tuple[str, ...]
    category_keyword: str
    # Defaults of the daily job.
    spine_start: dt.date = dt.date(2021, 4, 1)
    event_window_days: int = 15
    archive_months: int = 36
    dormant_months: int = 6
    point_threshold: int = 50
    # Day -> value of ``previousmonthbase``; every other day is 0.
    base_overrides: Mapping[dt.date, int] = field(default_factory=dict)
    semantics: str = "corrected"
    # Also match an event of the neighbouring year (28 December against 3 January).
    wrap_year_end: bool = False
    # Which purchases decide on a day whether a card is dormant or archived: "all" of the data, as in the replaced job (a card
    # never leaves either state), or those "so_far", up to the day (a card leaves when it buys).
    state_purchases: str = "all"
    # What an unreadable campaign number becomes: "zero" or "null".
    bad_number: str = "zero"
    # What amounts and campaign figures are added up in. Doubles lose no value and are added up exactly, rounded once
    # (``functions.exact``); a decimal type adds up exactly as well, but cells that it cannot hold become null.
    amount_type: str = "double"
    figure_type: str = "double"
    # Texts that an all-text export writes for a blank cell.
    null_tokens: tuple[str, ...] = ("", "None", "nan", "NaT")
    member_columns: Mapping[str, str] = MEMBER_EXPORT
    transaction_columns: Mapping[str, str] = TRANSACTION_EXPORT
    campaign_columns: Mapping[str, str] = CAMPAIGN_EXPORT

    def __post_init__(self) -> None:
        if self.semantics not in ("corrected", "reference"):
            raise ValueError(f"semantics must be 'corrected' or 'reference', not {self.semantics!r}")
        if self.bad_number not in ("zero", "null"):
            raise ValueError(f"bad_number must be 'zero' or 'null', not {self.bad_number!r}")
        if self.state_purchases not in ("all", "so_far"):
            raise ValueError(f"state_purchases must be 'all' or 'so_far', not {self.state_purchases!r}")
        if self.state_purchases == "so_far" and self.literal:
            raise ValueError("the literal results know no states by the purchases so far")
        if not self.program_channels:
            raise ValueError("program_channels must name at least one channel")
        # All channel and keyword tests ignore case.
        object.__setattr__(self, "focus_channel", self.focus_channel.lower())
        object.__setattr__(self, "program_channels", tuple(c.lower() for c in self.program_channels))
        object.__setattr__(self, "category_keyword", self.category_keyword.lower())

    @property
    def exact_amounts(self) -> bool:
        """Whether amounts are doubles to be added up without regard to their order. The literal job adds them as they come."""
        return not self.literal and self.amount_type == "double"

    @property
    def exact_figures(self) -> bool:
        return not self.literal and self.figure_type == "double"

    @property
    def leaving(self) -> bool:
        """Whether cards leave the states of dormant and archived ones when they buy."""
        return self.state_purchases == "so_far"

    @property
    def literal(self) -> bool:
        """True when the literal results of the replaced job are wanted."""
        return self.semantics == "reference"
