"""Network type of a URL."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# URL fragment -> network type id.
NETWORK_TYPES: dict[str, int] = {
    "telegram.me": 17,
    "t.me": 17,
    "vk.com": 7,
    "facebook.com": 3,
    "fb.com": 3,
    "youtube.com": 4,
    "youtu.be": 4,
    "instagram.com": 10,
    "linkedin.com": 31,
    "tiktok.com": 27,
    "viber.com": 24,
    "whatsapp.com": 25,
    "twitter.com": 2,
    "x.com": 2,
    "livejournal.com": 6,
    "yandex.ru": 1,
    "yandex.com": 1,
    "zen.yandex.ru": 23,
    "dzen.ru": 23,
    "yandex.maps": 22,
    "maps.yandex.ru": 22,
    "google.com/maps": 21,
    "google.com": 12,
    "plus.google.com": 12,
    "icq.com": 28,
    "itunes.apple.com": 36,
    "apple.com/podcasts": 29,
    "google.com/podcasts": 30,
    "samsungapps.com": 44,
    "appgallery.huawei.com": 45,
    "twitch.tv": 47,
    "likee.video": 38,
    "yappy.media": 39,
    "play.google.com": 35,
}
UNKNOWN_NETWORK = 32


def classify_url(
    column: Column | str,
    types: Mapping[str, int] = NETWORK_TYPES,
    default: int = UNKNOWN_NETWORK,
) -> Column:
    """Type of the longest fragment found in the URL (equal lengths: by text).

    Fragments overlap (``google.com`` sits inside ``google.com/maps``), so the
    most specific one has to be asked first for the answer to be stable.
    """
    url = F.col(column) if isinstance(column, str) else column
    chain = None
    for fragment in sorted(types, key=lambda f: (-len(f), f)):
        found = url.contains(fragment)
        chain = F.when(found, types[fragment]) if chain is None else chain.when(found, types[fragment])
    return F.lit(default) if chain is None else chain.otherwise(default)
