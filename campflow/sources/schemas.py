"""Raw table schemas, and the value domains of their columns."""

from __future__ import annotations

from pyspark.sql import types as T

# The domains that the raw columns are drawn from.
ACTION_TYPES = ("impression", "click", "dismiss", "swipe", "deep_link", "conversion")
CHANNELS = ("push", "in_app_banner", "in_app_modal", "story")
CATEGORIES = ("credito", "investimentos", "seguros", "cartoes", "conta_digital")
SEGMENTS = ("varejo", "alta_renda", "private", "pj")
AB_GROUPS = ("control", "variant_a", "variant_b")
DEVICE_SYSTEMS = ("iOS", "Android")


def _schema(*columns: tuple[str, T.DataType, str]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True, {"comment": text}) for name, kind, text in columns])


_TEXT, _INT, _DOUBLE, _BOOL = T.StringType(), T.IntegerType(), T.DoubleType(), T.BooleanType()

BRONZE_CLICKS = _schema(
    ("event_id", _TEXT, "Unique id of the interaction"),
    ("event_timestamp", _TEXT, "ISO-8601 time of the interaction, UTC, no offset"),
    ("customer_id", _TEXT, "Pseudonymous customer"),
    ("session_id", _TEXT, "App session"),
    ("device_id", _TEXT, "Device"),
    ("device_os", _TEXT, "Operating system: iOS or Android"),
    ("app_version", _TEXT, "Version of the app"),
    ("campaign_id", _TEXT, "Campaign shown"),
    ("campaign_name", _TEXT, "Name of the campaign when it was shown"),
    ("campaign_channel", _TEXT, "Channel: push, in_app_banner, in_app_modal or story"),
    ("campaign_category", _TEXT, "Product category of the campaign"),
    ("offer_id", _TEXT, "Offer within the campaign"),
    ("action_type", _TEXT, "impression, click, dismiss, swipe, deep_link or conversion"),
    ("action_element", _TEXT, "Element of the screen acted on"),
    ("screen_name", _TEXT, "Screen of the interaction"),
    ("referrer_screen", _TEXT, "Screen before it"),
    ("geo_region", _TEXT, "Region"),
    ("geo_city", _TEXT, "City"),
    ("is_personalized", _BOOL, "Whether the campaign was personalised"),
    ("ab_test_group", _TEXT, "Experiment group: control, variant_a or variant_b"),
    ("response_time_ms", _INT, "Server response time in milliseconds"),
    ("conversion_value", _DOUBLE, "Value of the conversion"),
    ("conversion_product", _TEXT, "Product of the conversion"),
)

BRONZE_CAMPAIGNS = _schema(
    ("campaign_id", _TEXT, "Campaign"),
    ("campaign_name", _TEXT, "Name"),
    ("campaign_description", _TEXT, "Description"),
    ("campaign_category", _TEXT, "Product category"),
    ("campaign_channel", _TEXT, "Channel it runs on"),
    ("campaign_start_date", _TEXT, "First day, ISO-8601"),
    ("campaign_end_date", _TEXT, "Last day, ISO-8601"),
    ("target_segment", _TEXT, "Customer segment it addresses"),
    ("budget_brl", _DOUBLE, "Budget"),
    ("is_active", _BOOL, "Whether it is running"),
    ("created_by", _TEXT, "Owner"),
)

BRONZE_SESSIONS = _schema(
    ("session_id", _TEXT, "App session"),
    ("customer_id", _TEXT, "Pseudonymous customer"),
    ("device_id", _TEXT, "Device"),
    ("device_os", _TEXT, "Operating system"),
    ("app_version", _TEXT, "Version of the app"),
    ("session_start", _TEXT, "First event, ISO-8601"),
    ("session_end", _TEXT, "Last event, ISO-8601"),
    ("geo_region", _TEXT, "Region"),
    ("geo_city", _TEXT, "City"),
    ("total_events", _INT, "Events in the session"),
    ("total_clicks", _INT, "Clicks in the session"),
)
