"""Engine parameters.

Everything that the original pipeline hard-codes (countries, zones, weekend
days, bounding boxes, service-area ids, name patterns, event names, distance
thresholds) lives here as data, so operators take it as an argument instead of
embedding literals.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values that must equal the original pipeline's for equal results.
# ---------------------------------------------------------------------------

# Product names excluded from ride bookings: lower(name) LIKE '%<p>%'.
EXCLUDED_PRODUCT_PATTERNS = (
    "food", "quik", "box", "b2b", "order", "shop", "test", "bot", "hrs",
)

# Super-app event names kept for unbooked sessions.
EVENT_NAMES = (
    "launch_mini_app",
    "tap_widget_primary_cta",
    "tap_widget_carousel_item",
    "tap_profile_banner_primary_cta",
    "tap_banner_card_primary_cta",
    "tap_hold_banner_card",
    "tap_service_tile",
)

# Service content ids kept for unbooked sessions (after suffix stripping).
SERVICES = (
    "food", "quik", "pay_bills", "justmop", "dineout", "laundryshoes",
    "send_money", "wellness", "shop", "bike", "swapp_monthlydaily",
    "tickets_and_passes", "donations", "pharmacies", "flowers", "school",
    "delivery", "send_abroad_remittance", "request_money",
)

# Content-id suffixes removed, in this order ('_rebranded' before '_rebrand').
CONTENT_ID_SUFFIXES = ("_rebranded", "_rebrand")

# Country (event spelling) -> IANA zone.
TZ_BY_COUNTRY = {
    "United Arab Emirates": "Asia/Dubai",
    "Jordan": "Asia/Amman",
}

# Country (booking-table spelling) -> IANA zone.
TZ_BY_BOOKING_COUNTRY = {
    "UAE": "Asia/Dubai",
    "Jordan": "Asia/Amman",
}

# ISO weekday numbers (1 = Monday) treated as weekend; default (6, 7).
WEEKEND_BY_COUNTRY = {
    "United Arab Emirates": (6, 7),
    "Jordan": (5, 7),
}
DEFAULT_WEEKEND = (6, 7)

# Inclusive (lat_min, lat_max), (long_min, long_max) per country.
BOUNDS_BY_COUNTRY = {
    "United Arab Emirates": ((22.5, 27.0), (52.2, 56.5)),
    "Jordan": ((30.0, 33.0), (34.0, 37.0)),
}

# Service types of home-services appointments that count as wellness (LIKE).
WELLNESS_PATTERNS = ("%premium men%salon%", "%women%spa%", "%women%salon%", "%men%spa%")

# Car-rental statuses that are no transaction.
MONTHLY_RENTAL_OFF = ("failed", "cancelled")
DAILY_RENTAL_OFF = ("pending_payment", "cancelled", "pending_approval")

VALID_SERVICE_AREA_IDS = (1, 21, 64, 68, 111, 87, 49, 47)

D_THRESHOLD_KM = 0.2          # "same place" radius for all distance features
MAX_KNOWN_LOCATION_KM = 40.0  # training rows farther than this are dropped
EARTH_RADIUS_KM = 6371.009    # mean earth radius of the great-circle formula

# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class EngineConfig:
    """Parameters of one extraction / dataset build."""

    history_horizon: int = 60
    percentile: float = 0.8
    booking_countries: tuple = ("UAE", "Jordan")
    event_countries: tuple = ("United Arab Emirates", "Jordan")
    platforms: tuple = ("ICMA", "ACMA")
    business_types: tuple = ("Ride Hailing", "jv")
    excluded_customers: tuple = ()
    excluded_patterns: tuple = EXCLUDED_PRODUCT_PATTERNS
    event_names: tuple = EVENT_NAMES
    services: tuple = SERVICES
    min_bookings_per_location: int = 3
    min_locations_ride: int = 2
    min_locations_food: int = 1
    food_service_area_ids: tuple = VALID_SERVICE_AREA_IDS
    tz_by_country: dict = field(default_factory=lambda: dict(TZ_BY_COUNTRY))
    tz_by_booking_country: dict = field(default_factory=lambda: dict(TZ_BY_BOOKING_COUNTRY))
    weekend_by_country: dict = field(default_factory=lambda: dict(WEEKEND_BY_COUNTRY))
    bounds_by_country: dict = field(default_factory=lambda: dict(BOUNDS_BY_COUNTRY))
    valid_service_area_ids: tuple = VALID_SERVICE_AREA_IDS
    d_threshold_km: float = D_THRESHOLD_KM
    max_known_location_km: float = MAX_KNOWN_LOCATION_KM
    # Work place is only looked at when no home place is saved.
    work_requires_no_home: bool = True


DEFAULT = EngineConfig()
