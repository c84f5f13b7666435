from feedfold.functions.classify import NETWORK_TYPES, UNKNOWN_NETWORK, classify_url
from feedfold.functions.dates import compact_date, date_span, days_before, run_label, text_to_date
from feedfold.functions.keys import url_key

__all__ = [
    "NETWORK_TYPES",
    "UNKNOWN_NETWORK",
    "classify_url",
    "compact_date",
    "date_span",
    "days_before",
    "run_label",
    "text_to_date",
    "url_key",
]
