"""Projections over nested records: drop, flatten, rebuild, explode."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedfold.operators.schema import (
    METRICS_SCHEMA,
    align_rescuing,
    align_to,
    find_field,
    find_path,
    leaf_paths,
    quoted,
)

log = logging.getLogger(__name__)

KEYS = ("Id", "PostCreateDate", "PartDate")

# Nested metrics message -> flat metrics column.
METRICS_FIELDS: dict[str, str] = {
    "blogtype": "Blog.Type",
    "blogurl": "Blog.Url",
    "partdate": "CreateDate",
    "comments": "Metrics.CommentCount",
    "likes": "Metrics.LikeCount",
    "reposts": "Metrics.RepostCount",
    "views": "Metrics.ViewCount",
    "commentnegativecount": "Metrics.CommentNegativeCount",
    "commentpositivecount": "Metrics.CommentPositiveCount",
    "metricstimestamp": "Metrics.Timestamp",
    "metricstype": "Type",
    "metricsurl": "Url",
    "currenttimestamp": "CurrentTimestamp",
    "kafkapartition": "kafkapartition",
    "kafkaoffset": "kafkaoffset",
}

# Flat metrics column -> name used by the merge.
METRICS_NAMES: dict[str, str] = {
    "blogtype": "BlogType",
    "blogurl": "BlogUrl",
    "partdate": "PartDate",
    "comments": "Comments",
    "likes": "Likes",
    "reposts": "Reposts",
    "views": "Views",
    "commentnegativecount": "CommentNegativeCount",
    "commentpositivecount": "CommentPositiveCount",
    "metricstimestamp": "MetricsTimestamp",
    "metricstype": "MetricsType",
    "metricsurl": "MetricsUrl",
    "currenttimestamp": "CurrentTimestamp",
    "kafkapartition": "KafkaPartition",
    "kafkaoffset": "KafkaOffset",
    "id": "Id",
    "execdate": "ExecDate",
}


def _folded(names: Iterable[str]) -> set[str]:
    return {n.lower() for n in names}


# --- top-level columns -----------------------------------------------------

def drop_fields(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop top-level columns, ignoring case and unknown names."""
    gone = _folded(names)
    return df.select(*(quoted(c) for c in df.columns if c.lower() not in gone))


def flat_name(path: str) -> str:
    """``A.b.c`` -> ``Abc``."""
    return path.replace(".", "")


def flatten_path(path: str) -> Column:
    """A dotted path as a flat column."""
    return quoted(*path.split(".")).alias(flat_name(path))


def keep_paths(df: DataFrame, paths: Sequence[str]) -> DataFrame:
    """Keep only the given dotted paths, flat; unmatched ones are logged."""
    columns = []
    for path in paths:
        found = find_path(df.schema, path)
        if found is None:
            log.warning("no column for %s", path)
        else:
            columns.append(quoted(*found[0]).alias(flat_name(path)))
    return df.select(*columns)


def exclude_then_keep(df: DataFrame, paths: Sequence[str], excludes: Iterable[str]) -> DataFrame:
    return keep_paths(drop_fields(df, excludes), paths)


def project_fields(df: DataFrame, fields: Mapping[str, str], types: T.StructType, rescue: bool = False) -> DataFrame:
    """Nested paths to flat columns; a path the data lacks becomes a typed null.

    With ``rescue`` one more column keeps the text of values that their declared type cannot take.
    """
    columns = []
    for name, path in fields.items():
        found = find_path(df.schema, path)
        value = F.lit(None).cast(types[name].dataType) if found is None else quoted(*found[0])
        columns.append(value.alias(name))
    flat = df.select(*columns)
    target = T.StructType([types[name] for name in fields])
    return align_rescuing(flat, target) if rescue else align_to(flat, target)


def project_metrics(messages: DataFrame, rescue: bool = False) -> DataFrame:
    """Flat metrics columns of a nested metrics feed."""
    return project_fields(messages, METRICS_FIELDS, METRICS_SCHEMA, rescue)


def canonical_metrics(delta: DataFrame) -> DataFrame:
    """A metrics delta of any age under the merge's column names."""
    return align_to(delta, METRICS_SCHEMA).withColumnsRenamed(METRICS_NAMES)


def suffix_collisions(df: DataFrame, others: Iterable[str], suffix: str) -> DataFrame:
    """Rename only the columns the other side has too."""
    taken = _folded(others)
    return df.withColumnsRenamed({c: c + suffix for c in df.columns if c.lower() in taken})


def derive_post_dates(df: DataFrame, created: str = "CreateDate") -> DataFrame:
    """``PartDate`` is the creation day (null if unreadable), ``PostCreateDate`` the text."""
    stamp = F.try_to_timestamp(quoted(created).cast("string"))
    return df.withColumns({"PartDate": F.to_date(stamp), "PostCreateDate": quoted(created)})


# --- structs ---------------------------------------------------------------

def _free_name(name: str, prefix: str, taken: set[str]) -> str:
    """The name, with as many prefixes as it takes to be new."""
    while name.lower() in taken:
        name = prefix + name
    taken.add(name.lower())
    return name


def flatten_struct(df: DataFrame, name: str, keys: Sequence[str] = KEYS) -> DataFrame:
    """Keys plus the struct's fields; a field named like a key gets the struct's name in front."""
    field = find_field(df.schema, name)
    taken = _folded(keys)
    inner = field.dataType.fields if field is not None and isinstance(field.dataType, T.StructType) else []
    columns = [quoted(field.name, f.name).alias(_free_name(f.name, name, taken)) for f in inner]
    return df.select(*(quoted(k) for k in keys), *columns)


def flatten_structs(
    df: DataFrame, names: Sequence[str], keys: Sequence[str] | None = None
) -> DataFrame:
    """Structs one level down as ``<struct><field>``.

    All other columns stay in front; with ``keys`` only those do. Frames
    without one of the structs pass it over.
    """
    wanted = _folded(names)
    structs = [
        f for n in names if (f := find_field(df.schema, n)) is not None and isinstance(f.dataType, T.StructType)
    ]
    rest = list(keys) if keys is not None else [c for c in df.columns if c.lower() not in wanted]
    taken = _folded(rest)
    flat = [
        quoted(s.name, f.name).alias(_free_name(s.name + f.name, s.name, taken))
        for s in structs
        for f in s.dataType.fields
    ]
    return df.select(*(quoted(c) for c in rest), *flat)


# --- arrays of structs -----------------------------------------------------

def _excluded(path: tuple[str, ...], excludes: set[str], match: str) -> bool:
    if match == "leaf":
        return path[-1].lower() in excludes
    return any(".".join(path[: i + 1]).lower() in excludes for i in range(len(path)))


def rebuilt_element(
    element: Column,
    struct: T.StructType,
    excludes: Iterable[str],
    keep_nested: Sequence[str] = ("Logo", "Ocr"),
    match: str = "path",
) -> Column:
    """The element without excluded fields, its nested leaves one level up.

    Structs named in ``keep_nested`` stay structs, with their own leaves
    hoisted inside them. ``match="path"`` excludes a field by its full dotted
    path and everything below it, ``match="leaf"`` by its last name wherever
    it occurs. Hoisted leaves with the same name get their parents in front.
    """
    gone, nested = _folded(excludes), _folded(keep_nested)
    groups: dict[tuple[str, ...], list[tuple[str, ...]]] = {}
    for path in leaf_paths(struct):
        if not _excluded(path, gone, match):
            depth = next((i for i, p in enumerate(path[:-1], 1) if p.lower() in nested), 0)
            groups.setdefault(path[:depth], []).append(path)

    def value(path: tuple[str, ...]) -> Column:
        column = element
        for part in path:
            column = column.getField(part)
        return column

    def hoisted(paths: list[tuple[str, ...]], depth: int, taken: set[str]) -> list[Column]:
        # plain fields take their names first, then hoisted ones
        columns = {}
        for path in sorted(paths, key=len):
            tail = path[depth:]
            name = next(
                (n for i in range(len(tail) - 1, -1, -1) if (n := "".join(tail[i:])).lower() not in taken),
                None,
            )
            name = _free_name(name or tail[-1], "_", taken)
            columns[path] = value(path).alias(name)
        return [columns[p] for p in paths]

    taken = {g[-1].lower() for g in groups if g}
    columns = hoisted(groups.pop((), []), 0, taken)
    for parent, paths in groups.items():
        columns.append(F.struct(*hoisted(paths, len(parent), set())).alias(parent[-1]))
    return F.struct(*columns) if columns else F.lit(None).cast("struct<>")


def rebuild_array(
    df: DataFrame,
    name: str,
    excludes: Iterable[str],
    keep_nested: Sequence[str] = ("Logo", "Ocr"),
    match: str = "path",
) -> Column:
    """The array column with every element rebuilt."""
    field = find_field(df.schema, name)
    element = field.dataType.elementType
    return F.transform(
        quoted(field.name), lambda x: rebuilt_element(x, element, excludes, keep_nested, match)
    ).alias(field.name)


def explode_struct_array(df: DataFrame, name: str, keys: Sequence[str] = KEYS) -> DataFrame:
    """Keys plus the fields of each element.

    A record with a null or empty array gives one row with null fields, so a
    newer version without children still replaces an older one with some.
    """
    field = find_field(df.schema, name)
    if field is None or not isinstance(field.dataType, T.ArrayType):
        return df.select(*(quoted(k) for k in keys))
    if not isinstance(field.dataType.elementType, T.StructType):
        return df.select(*(quoted(k) for k in keys), F.explode_outer(quoted(field.name)).alias(field.name))
    item = f"_{field.name}_item"
    rows = df.select(*(quoted(k) for k in keys), F.explode_outer(quoted(field.name)).alias(item))
    taken = _folded(keys)
    columns = [
        quoted(item, f.name).alias(_free_name(f.name, field.name, taken))
        for f in field.dataType.elementType.fields
    ]
    return rows.select(*(quoted(k) for k in keys), *columns)
