"""Report parameters.

The reference hard-codes its dates, label patterns and URL fragments in the
SQL text. Here they are one frozen dataclass: ``ReportParams()`` carries the
reference's production values, ``ReportParams.for_testdata()`` moves the dates
onto the calendar of the generated test tables (January 2024 events, 1995-96
orders) and leaves every pattern unchanged.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field, replace

# ---------------------------------------------------------------------------
# These strings must equal the reference's for equal results.
# ---------------------------------------------------------------------------
SECTION = "nedvizhimost"                     # landing-page section fragment
TEST_HOST = "test.example"                   # test traffic excluded by host: set your own
DIRECT_SOURCE = "(direct)"
NO_MEDIUM = "(none)"
NO_CAMPAIGN = "(no campaign)"                # type of sessions without a campaign
NOT_AUTHORIZED = "not_authorized"
PHONE_CLICK_LABELS = (
    "(ClCardSellPhoneClickTop|ClSerpSellSecondVasPhoneClick|ClCardSellPhoneClickBottom"
    "|ClCardSellSecondVasPhoneClickAll|ClSerpCardSellNewDevPaidPhoneClick)"
)
PHONE_CLICK_EXCLUDED = "ClCardSellPhoneClickAll"
CALL_LABELS = "^Cl.*PhoneClick.*"
VAS_LABELS = ("ClCardSellSecondVasPhoneClickAll", "ClSerpSellSecondVasPhoneClick")
VAS_CITY_LABELS = "ClCardSellSecondVasPhoneClickAll|ClSerpSellSecondVasPhoneClick"
MORTGAGE_LABELS = "^(ClCardSellMortgageClick|ClSerpSellMortgageClick)"
CLAIM_LABELS = "^claim_completed"
REGISTRATION_LABELS = "(NewRegSuccess)"
REGISTRATION_CATEGORIES = "(FL|P_AGENT)"
REGISTRATION_PAGE_EXCLUDED = "link-registration"
DEAL_CLICK_LABEL = "lk_onlinebuy_lp_header_buy_click"
GUARANTEE_CLICK_LABEL = "gd_start"
DEAL_PAGE = "services/deal"
GUARANTEE_PAGE = "guaranteed-deal"
# Report-API request for the banner table: dimensions, metrics, filter, page size.
BANNER_DIMENSIONS = ("ga:isoweek", "ga:date", "ga:eventLabel", "ga:eventCategory", "ga:eventAction")
BANNER_METRICS = ("ga:totalevents", "ga:users")
BANNER_FILTER = "ga:pagepath=~/nedvizhimost;ga:eventLabel=~banner"
API_PAGE_SIZE = 10000
# Metric names the connector casts to integers (exact, case-sensitive match).
INTEGER_METRICS = ("totalEvents", "uniqueEvents", "users", "sessions")
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class ReportParams:
    """Every constant a report reads. Defaults are the reference's values."""

    # common session-side bounds
    start_date: str = "2022-01-03"
    # weeks without a year, as the reference; True adds ``isoyear`` to R3-R7, R12 and R15
    with_iso_year: bool = False
    # exact COUNT(DISTINCT) by default; True switches to HyperLogLog++ (opt-in)
    approx_distinct: bool = False
    section: str = SECTION
    test_host: str = TEST_HOST
    # R1
    phone_click_labels: str = PHONE_CLICK_LABELS
    phone_click_excluded: str = PHONE_CLICK_EXCLUDED
    # R2
    call_labels: str = CALL_LABELS
    # R3
    vas_labels: tuple[str, ...] = VAS_LABELS
    vas_from_ts: str = "2022-01-03 00:00:01"
    # R4 / R5
    mortgage_labels: str = MORTGAGE_LABELS
    claim_labels: str = CLAIM_LABELS
    lead_from_ts: str = "2022-01-03 16:26:00"
    # R6 / R7
    registration_labels: str = REGISTRATION_LABELS
    registration_categories: str = REGISTRATION_CATEGORIES
    registration_page_excluded: str = REGISTRATION_PAGE_EXCLUDED
    registration_from_ts: str = "2022-01-19 00:00:01"
    # R8 / R9 / R10
    deal_click_label: str = DEAL_CLICK_LABEL
    guarantee_click_label: str = GUARANTEE_CLICK_LABEL
    deal_page: str = DEAL_PAGE
    guarantee_page: str = GUARANTEE_PAGE
    deal_from_ts: str = "2022-01-03 00:00:01"
    combine_how: str = "position"
    # R11
    uniques_year: int = 2022
    # The reference dates each week in the current calendar year; here
    # the year must be given.
    cost_from: str = "2022-01-03"
    cost_week_year: int | None = None
    # R13
    retention_after: str = "2021-08-09"
    retention_week52_year: int = 2021
    retention_max_age: int = 52
    retention_exact_weeks: bool = False  # ages counted over the years, no wrap at 52
    # R14 and the incremental banner load
    banners_from: str = "2022-01-03"
    banner_dimensions: tuple[str, ...] = BANNER_DIMENSIONS
    banner_metrics: tuple[str, ...] = BANNER_METRICS
    banner_filter: str = BANNER_FILTER
    page_size: int = API_PAGE_SIZE
    window_step_days: int = 1
    load_default_start: str = "2022-01-03"
    load_today: str = field(default_factory=lambda: dt.date.today().isoformat())
    # R15
    vas_city_labels: str = VAS_CITY_LABELS
    vas_city_from: str = "2021-12-27"

    @classmethod
    def for_testdata(cls) -> "ReportParams":
        """Dates moved onto the generated tables' calendar; patterns unchanged."""
        return cls(
            start_date="2024-01-03",
            vas_from_ts="2024-01-03 00:00:01",
            lead_from_ts="2024-01-03 16:26:00",
            registration_from_ts="2024-01-19 00:00:01",
            deal_from_ts="2024-01-03 00:00:01",
            uniques_year=2024,
            cost_from="1996-01-01",
            cost_week_year=1996,
            retention_after="1995-08-09",
            retention_week52_year=1995,
            banners_from="2024-01-03",
            load_default_start="2024-01-01",
            load_today="2024-01-31",
            vas_city_from="2024-01-03",
        )

    def with_(self, **changes) -> "ReportParams":
        return replace(self, **changes)


# Cut-off used by the registered incremental-load query: rows before it form the
# already-loaded target, the load fills the rest.
TESTDATA_LOADED_UNTIL = "2024-01-15"
