"""Field policies and the five-way split of a post."""

from __future__ import annotations

import json
import logging
from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedfold.operators.reshape import (
    KEYS,
    drop_fields,
    explode_struct_array,
    exclude_then_keep,
    flat_name,
    flatten_struct,
    flatten_structs,
    rebuild_array,
)
from feedfold.operators.schema import dedupe_columns, find_field, find_path, quoted

log = logging.getLogger(__name__)

PRIMARY, OTHER = "Posts", "PostsOther"
ATTACHMENTS, GEO, MODIFICATION = "PostsAttachments", "PostsGeoData", "PostsModificationInfo"
CHILD_PARTS = (OTHER, ATTACHMENTS, GEO, MODIFICATION)

# Parents whose fields are flattened into the parts with their name in front.
PREFIXED = ("Author", "Blog")

# Columns that tell one message from another.
MESSAGE_COLUMNS = ("CurrentTimestamp", "kafkapartition", "kafkaoffset")


@dataclass(frozen=True)
class FieldPolicy:
    """Which fields a feed drops, and which it keeps as primary columns.

    ``excludes`` maps a top-level field to nested names to drop; an empty list
    drops the whole field. ``primary`` lists dotted paths.
    """

    excludes: dict[str, list[str]] = field(default_factory=dict)
    primary: tuple[str, ...] = ()

    @classmethod
    def parse(cls, excludes: str = "{}", primary: str = "") -> FieldPolicy:
        """From the text forms: a JSON object and a comma-separated list."""
        nested = {name: list(value) for name, value in json.loads(excludes).items()}
        paths = [p.strip() for p in primary.split(",")]
        return cls(nested, tuple(p for p in paths if p))

    def nested(self, name: str) -> list[str]:
        return next((v for k, v in self.excludes.items() if k.lower() == name.lower()), [])

    def whole_fields(self, prefixed: Sequence[str] = PREFIXED) -> list[str]:
        kept = {p.lower() for p in prefixed}
        return [name for name in self.excludes if name.lower() not in kept]


def apply_policy(df: DataFrame, policy: FieldPolicy, mode: str = "exclude") -> DataFrame:
    """Drop the excluded columns; ``mode="primary"`` then keeps only primary paths."""
    if mode == "exclude":
        return drop_fields(df, policy.excludes)
    if mode == "primary":
        return exclude_then_keep(df, policy.primary, policy.excludes)
    raise ValueError(f"unknown policy mode {mode!r}")


def transform_blogs(df: DataFrame, policy: FieldPolicy, mode: str = "exclude") -> DataFrame:
    """Policy applied, load time added unless the messages carry theirs."""
    loaded = find_field(df.schema, "CurrentTimestamp")
    stamp = F.current_timestamp() if loaded is None else quoted(loaded.name)
    stamped = df.withColumn("CurrentTimestamp", stamp)
    kept = policy if mode == "exclude" else replace(
        policy, primary=(*policy.primary, "CurrentTimestamp", "kafkapartition", "kafkaoffset")
    )
    return apply_policy(stamped, kept, mode)


def match_primary(df: DataFrame, policy: FieldPolicy) -> tuple[dict[str, list[str]], list[str]]:
    """Flat name -> real path for primary paths the data has, and the paths it lacks.

    A path below a wholly excluded field counts as lacking; the field itself
    named as primary is kept. A path also matches a column already flat.
    """
    hidden = {n.lower() for n in policy.whole_fields()}
    matched: dict[str, list[str]] = {}
    missing: list[str] = []
    for path in policy.primary:
        top, _, below = path.partition(".")
        found = None if below and top.lower() in hidden else find_path(df.schema, path)
        found = found or find_path(df.schema, flat_name(path))
        if found is None:
            missing.append(path)
        else:
            matched[flat_name(path)] = found[0]
    return matched, missing


def primary_part(df: DataFrame, policy: FieldPolicy, keys: Sequence[str] = KEYS) -> DataFrame:
    """Keys and primary columns."""
    matched, missing = match_primary(df, policy)
    if missing:
        log.warning("primary paths without data: %s", ", ".join(missing))
    own = {k.lower() for k in keys}
    columns = [quoted(*path).alias(name) for name, path in matched.items() if name.lower() not in own]
    return df.select(*(quoted(k) for k in keys), *columns)


def other_part(
    df: DataFrame, policy: FieldPolicy, keys: Sequence[str] = KEYS, prefixed: Sequence[str] = PREFIXED
) -> DataFrame:
    """Everything the primary part and the policy leave, with the keys kept."""
    flat = flatten_structs(df, prefixed)
    gone = [parent + name for parent in prefixed for name in policy.nested(parent)]
    gone += policy.whole_fields(prefixed)
    gone += match_primary(df, policy)[0]
    own = {k.lower() for k in keys}
    rest = drop_fields(flat, [*gone, *keys])
    return flat.select(*(quoted(k) for k in keys), *(quoted(c) for c in rest.columns if c.lower() not in own))


def attachments_part(
    df: DataFrame, policy: FieldPolicy, keys: Sequence[str] = KEYS, match: str = "path"
) -> DataFrame:
    """One row per attachment, elements rebuilt by the policy."""
    column = find_field(df.schema, "Attachments")
    nested = column is not None and isinstance(column.dataType, T.ArrayType)
    if not nested or not isinstance(column.dataType.elementType, T.StructType):
        return explode_struct_array(df, "Attachments", keys)
    slim = df.select(*(quoted(k) for k in keys), rebuild_array(df, "Attachments", policy.nested("Attachments"), match=match))
    return explode_struct_array(slim, "Attachments", keys)


def geo_part(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """One row per place."""
    return explode_struct_array(df, "GeoData", keys)


def modification_part(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """The modification struct, flat."""
    return flatten_struct(df, "ModificationInfo", keys)


def split_posts(
    posts: DataFrame,
    policy: FieldPolicy,
    exec_date: str,
    message_columns: Sequence[str] = MESSAGE_COLUMNS,
    match: str = "path",
) -> dict[str, DataFrame]:
    """Five frames over one input, each with the keys and ``ExecDate``.

    Message columns the input has travel with the keys, so a merge can tell
    the rows of one message version from those of another.
    """
    posts = dedupe_columns(posts)
    carried = [f.name for c in message_columns if (f := find_field(posts.schema, c)) is not None]
    keys = (*KEYS, *carried)
    parts = {
        PRIMARY: primary_part(posts, policy, keys),
        OTHER: other_part(posts, policy, keys),
        ATTACHMENTS: attachments_part(posts, policy, keys, match),
        GEO: geo_part(posts, keys),
        MODIFICATION: modification_part(posts, keys),
    }
    return {name: part.withColumn("ExecDate", F.lit(exec_date)) for name, part in parts.items()}
