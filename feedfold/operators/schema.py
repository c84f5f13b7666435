"""Schemas that drift: inference, comparison, widening and alignment."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The declared columns of a metrics delta.
METRICS_SCHEMA = T.StructType(
    [
        T.StructField("blogtype", T.LongType()),
        T.StructField("blogurl", T.StringType()),
        T.StructField("partdate", T.StringType()),
        T.StructField("comments", T.LongType()),
        T.StructField("likes", T.LongType()),
        T.StructField("reposts", T.LongType()),
        T.StructField("views", T.LongType()),
        T.StructField("commentnegativecount", T.LongType()),
        T.StructField("commentpositivecount", T.LongType()),
        T.StructField("metricstimestamp", T.StringType()),
        T.StructField("metricstype", T.LongType()),
        T.StructField("metricsurl", T.StringType()),
        T.StructField("currenttimestamp", T.TimestampType()),
        T.StructField("kafkapartition", T.IntegerType()),
        T.StructField("kafkaoffset", T.LongType()),
        T.StructField("id", T.StringType()),
        T.StructField("execdate", T.StringType()),
    ]
)

UNPARSED = "_unparsed_text"
_NUMBER_ORDER = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)


# --- names -----------------------------------------------------------------

def backquoted(*parts: str) -> str:
    """A nested field's name parts as SQL takes them."""
    return ".".join("`" + p.replace("`", "``") + "`" for p in parts)


def quoted(*parts: str) -> Column:
    """Column of a nested field given by its name parts."""
    return F.col(backquoted(*parts))


def find_field(struct: T.StructType, name: str) -> T.StructField | None:
    """Field by name, exact spelling first, then ignoring case."""
    folded = name.lower()
    exact = [f for f in struct.fields if f.name == name]
    loose = [f for f in struct.fields if f.name.lower() == folded]
    return (exact or loose or [None])[0]


def find_path(struct: T.StructType, path: str) -> tuple[list[str], T.DataType] | None:
    """Real names and type behind a dotted path through structs."""
    names: list[str] = []
    dtype: T.DataType = struct
    for part in path.split("."):
        field = find_field(dtype, part) if isinstance(dtype, T.StructType) else None
        if field is None:
            return None
        names.append(field.name)
        dtype = field.dataType
    return names, dtype


def struct_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StructType)]


def leaf_paths(struct: T.StructType, prefix: tuple[str, ...] = ()) -> Iterator[tuple[str, ...]]:
    """Paths of all leaves, through structs and one level of array of struct.

    An array of struct below another one is a leaf: reading a field through
    two arrays would nest the values and lose their element.
    """
    yield from _leaves(struct, prefix, in_array=False)


def _leaves(struct: T.StructType, prefix: tuple[str, ...], in_array: bool) -> Iterator[tuple[str, ...]]:
    for field in struct.fields:
        path, dtype = (*prefix, field.name), field.dataType
        if isinstance(dtype, T.StructType):
            yield from _leaves(dtype, path, in_array)
        elif isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StructType) and not in_array:
            yield from _leaves(dtype.elementType, path, in_array=True)
        else:
            yield path


def dedupe_columns(df: DataFrame) -> DataFrame:
    """Keep the first of columns whose names differ in nothing but case."""
    seen: set[str] = set()
    keep = []
    for i, name in enumerate(df.columns):
        if name.lower() not in seen:
            seen.add(name.lower())
            keep.append((i, name))
    if len(keep) == len(df.columns):
        return df
    numbered = df.toDF(*(f"_{i}" for i in range(len(df.columns))))
    return numbered.select(*(F.col(f"_{i}").alias(name) for i, name in keep))


# --- types -----------------------------------------------------------------

def same_type(a: T.DataType, b: T.DataType) -> bool:
    """Deep equality that ignores nullability and compares lengths."""
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return len(a) == len(b) and all(
            x.name == y.name and same_type(x.dataType, y.dataType) for x, y in zip(a.fields, b.fields)
        )
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return same_type(a.elementType, b.elementType)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return same_type(a.keyType, b.keyType) and same_type(a.valueType, b.valueType)
    return a == b


def widen(a: T.DataType, b: T.DataType, exact: bool = False) -> T.DataType:
    """Smallest type both fit in; types with nothing in common become text.

    Whole numbers of 64 bits meet fractions in a double, which holds them up to 2**53. With ``exact`` numbers that no
    number type holds for sure become text as well.
    """
    if same_type(a, b):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(b, T.NullType):
        return a
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        fields = []
        for f in a.fields:
            other = find_field(b, f.name)
            fields.append(T.StructField(f.name, widen(f.dataType, other.dataType, exact) if other else f.dataType))
        fields += [T.StructField(f.name, f.dataType) for f in b.fields if find_field(a, f.name) is None]
        return T.StructType(fields)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(widen(a.elementType, b.elementType, exact))
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(widen(a.keyType, b.keyType, exact), widen(a.valueType, b.valueType, exact))
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        return _widen_numbers(a, b, exact)
    if isinstance(a, T.DatetimeType) and isinstance(b, T.DatetimeType):
        return T.TimestampType()
    return T.StringType()


_FRACTIONS = (T.FloatType, T.DoubleType)
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}


def _widen_numbers(a: T.DataType, b: T.DataType, exact: bool) -> T.DataType:
    unsure = T.StringType() if exact else T.DoubleType()
    if isinstance(a, T.DecimalType) or isinstance(b, T.DecimalType):
        if isinstance(a, _FRACTIONS) or isinstance(b, _FRACTIONS):
            return unsure
        shape = lambda t: (t.precision - t.scale, t.scale) if isinstance(t, T.DecimalType) else (_DIGITS[type(t)], 0)
        (whole_a, scale_a), (whole_b, scale_b) = shape(a), shape(b)
        whole, scale = max(whole_a, whole_b), max(scale_a, scale_b)
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else unsure
    wider = max(a, b, key=lambda t: _NUMBER_ORDER.index(type(t)))
    if not isinstance(wider, _FRACTIONS):
        return wider
    if isinstance(a, T.LongType) or isinstance(b, T.LongType):
        return unsure
    # a float cannot hold every int, a double can
    return T.DoubleType()


def merged_schema(schemas: Sequence[T.StructType], exact: bool = False) -> T.StructType:
    return reduce(lambda a, b: widen(a, b, exact), schemas)


def exact_schema(*frames: DataFrame) -> T.StructType:
    """Merged schema of frames in which every value of theirs survives.

    Where a type could lose digits (long and fraction, wide decimals), the columns at hand are looked at: the number type is
    taken if all their values fit, else text. Frames without such a clash cost nothing; others one aggregation over the clashing columns.
    """
    loose, strict = (merged_schema([f.schema for f in frames], exact) for exact in (False, True))
    unsure = {f.name.lower() for f, g in zip(loose.fields, strict.fields) if not same_type(f.dataType, g.dataType)}
    lossy: set[str] = set()
    for frame in frames if unsure else ():
        tests = {}
        for f in loose.fields:
            own = find_field(frame.schema, f.name) if f.name.lower() in unsure else None
            lost = None if own is None else loses(quoted(own.name), own.dataType, f.dataType)
            if lost is not None:
                tests[f.name.lower()] = lost
        if tests:
            found = frame.agg(*(F.bool_or(F.coalesce(c, F.lit(False))) for c in tests.values())).first()
            lossy |= {name for name, hit in zip(tests, found) if hit}
    return T.StructType([g if f.name.lower() in lossy else f for f, g in zip(loose.fields, strict.fields)])


# --- alignment -------------------------------------------------------------

def _convertible(have: T.DataType, want: T.DataType) -> bool:
    number = (T.NumericType, T.BooleanType)
    if isinstance(want, T.StringType) or isinstance(have, T.NullType):
        return True
    if isinstance(have, T.StringType):
        return isinstance(want, (*number, T.DatetimeType, T.BinaryType))
    if isinstance(have, number) and isinstance(want, number):
        return True
    return isinstance(have, T.DatetimeType) and isinstance(want, T.DatetimeType)


def number_text(column: Column) -> Column:
    """Text of a fraction without an exponent, whatever its size: a value reads alike among small and large ones."""
    text = column.cast("string")
    part = lambda i: F.regexp_extract(text, r"^(-?)(\d)\.(\d+)E(-?\d+)$", i)
    sign, power = part(1), part(4).try_cast("int")
    digits = F.concat(part(2), part(3))
    padded = F.rpad(digits, F.greatest(F.length(digits), power + 2), F.lit("0"))
    large = F.concat(sign, F.substring(padded, F.lit(1), power + 1), F.lit("."), F.substring(padded, power + 2, F.length(padded)))
    small = F.concat(sign, F.lit("0."), F.repeat(F.lit("0"), -power - 1), part(2), F.when(part(3) == "0", "").otherwise(part(3)))
    return F.when(~text.contains("E"), text).when(power >= 0, large).when(power < 0, small).otherwise(text)


def align_column(column: Column, have: T.DataType, want: T.DataType) -> Column:
    """The column reshaped from one type to another.

    Structs are matched by field name, arrays element by element. A null
    struct stays null, a missing field becomes a typed null, scalars are
    converted where they can be, anything else becomes null.
    """
    if same_type(have, want):
        return column
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        fields = []
        for f in want.fields:
            own = find_field(have, f.name)
            value = F.lit(None).cast(f.dataType) if own is None else align_column(
                column.getField(own.name), own.dataType, f.dataType
            )
            fields.append(value.alias(f.name))
        return F.when(column.isNotNull(), F.struct(*fields))
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(column, lambda x: align_column(x, have.elementType, want.elementType))
    if isinstance(have, T.MapType) and isinstance(want, T.MapType):
        keys = F.transform(F.map_keys(column), lambda x: align_column(x, have.keyType, want.keyType))
        values = F.transform(F.map_values(column), lambda x: align_column(x, have.valueType, want.valueType))
        return F.map_from_arrays(keys, values)
    if isinstance(have, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(column) if isinstance(want, T.StringType) else F.lit(None).cast(want)
    if isinstance(have, _FRACTIONS) and isinstance(want, T.StringType):
        return number_text(column)
    if _convertible(have, want) and not isinstance(want, (T.StructType, T.ArrayType, T.MapType)):
        return column.try_cast(want)
    return F.lit(None).cast(want)


def loses(column: Column, have: T.DataType, want: T.DataType) -> Column | None:
    """Whether ``align_column`` would lose what the column holds; None where no value can be lost.

    A field the target lacks is dropped by design and does not count.
    """
    if same_type(have, want):
        return None
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        found = [
            lost for f in have.fields
            if (g := find_field(want, f.name)) is not None and (lost := loses(column.getField(f.name), f.dataType, g.dataType)) is not None
        ]
        return reduce(Column.__or__, [F.coalesce(x, F.lit(False)) for x in found]) if found else None
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return _any_lost(column, have.elementType, want.elementType)
    if isinstance(have, T.MapType) and isinstance(want, T.MapType):
        parts = [_any_lost(F.map_keys(column), have.keyType, want.keyType), _any_lost(F.map_values(column), have.valueType, want.valueType)]
        parts = [p for p in parts if p is not None]
        return reduce(Column.__or__, parts) if parts else None
    if isinstance(want, T.StringType) or isinstance(have, T.NullType):
        return None
    made = align_column(column, have, want)
    if isinstance(have, T.StringType) or not _convertible(have, want):
        return column.isNotNull() & made.isNull()
    # back in its own type it must be what it was
    return column.isNotNull() & ~made.try_cast(have).eqNullSafe(column)


def _any_lost(array: Column, have: T.DataType, want: T.DataType) -> Column | None:
    if loses(F.lit(None).cast(have), have, want) is None:
        return None
    return F.exists(array, lambda x: F.coalesce(loses(x, have, want), F.lit(False)))


RESCUED = "_rescued"


def align_rescuing(df: DataFrame, target: T.StructType) -> DataFrame:
    """``align_to`` with one more column: a map from column name to the text of a value its declared type cannot take, or null."""
    aligned = align_to(df, target).columns
    entries = []
    for f in target.fields:
        own = find_field(df.schema, f.name)
        lost = None if own is None else loses(quoted(own.name), own.dataType, f.dataType)
        if lost is not None:
            nested = isinstance(own.dataType, (T.StructType, T.ArrayType, T.MapType))
            text = F.to_json(quoted(own.name)) if nested else align_column(quoted(own.name), own.dataType, T.StringType())
            entries += [F.lit(f.name), F.when(F.coalesce(lost, F.lit(False)), text)]
    kind = "map<string,string>"
    held = F.map_filter(F.create_map(*entries), lambda _, v: v.isNotNull()) if entries else F.lit(None).cast(kind)
    held = F.when(F.size(held) > 0, held).cast(kind) if entries else held
    columns = []
    for name, f in zip(aligned, target.fields):
        own = find_field(df.schema, f.name)
        value = F.lit(None).cast(f.dataType) if own is None else align_column(quoted(own.name), own.dataType, f.dataType)
        columns.append(value.alias(name))
    return df.select(*columns, held.alias(RESCUED))


def align_to(df: DataFrame, target: T.StructType) -> DataFrame:
    """The frame with exactly the target's columns, in its order and types."""
    schema = df.schema
    if same_type(schema, target):
        return df
    columns = []
    for f in target.fields:
        own = find_field(schema, f.name)
        if own is not None and own.name == f.name and same_type(own.dataType, f.dataType):
            columns.append(backquoted(f.name))
            continue
        value = F.lit(None).cast(f.dataType) if own is None else align_column(
            quoted(own.name), own.dataType, f.dataType
        )
        columns.append(value.alias(f.name))
    return df.select(*columns)


def union_drift(*frames: DataFrame) -> DataFrame:
    """Union by name of frames whose columns and types may differ; every value survives."""
    target = exact_schema(*frames)
    return reduce(DataFrame.unionByName, [align_to(f, target) for f in frames])


# --- JSON ------------------------------------------------------------------

SPELLINGS = "spellings"


def _storable(dtype: T.DataType) -> T.DataType | None:
    """Type as kept in tables.

    Fractions are doubles, clashing and unknown types text. Empty structs go. Names that differ in nothing but case are one field
    of a type all of them fit in, whose metadata list the spellings.
    """
    if isinstance(dtype, T.StructType):
        kept: dict[str, list[T.StructField]] = {}
        for f in dtype.fields:
            inner = _storable(f.dataType)
            if inner is not None:
                kept.setdefault(f.name.lower(), []).append(T.StructField(f.name, inner))
        fields = []
        for same in kept.values():
            kind = reduce(_widen_spelled, (f.dataType for f in same))
            fields.append(T.StructField(same[0].name, kind, True, {SPELLINGS: [f.name for f in same]} if len(same) > 1 else None))
        return T.StructType(fields) if fields else None
    if isinstance(dtype, T.ArrayType):
        element = _storable(dtype.elementType)
        return None if element is None else T.ArrayType(element)
    if isinstance(dtype, T.DecimalType):
        return T.DecimalType(38, 0) if dtype.scale == 0 else T.DoubleType()
    if isinstance(dtype, (T.VariantType, T.NullType)):
        return T.StringType()
    return dtype


def _spellings(field: T.StructField) -> list[str]:
    return (field.metadata or {}).get(SPELLINGS) or [field.name]


def _widen_spelled(a: T.DataType, b: T.DataType) -> T.DataType:
    """``widen`` that keeps the spellings of nested fields."""
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        fields = []
        for f in a.fields:
            g = find_field(b, f.name)
            names = list(dict.fromkeys(_spellings(f) + (_spellings(g) if g else [])))
            kind = _widen_spelled(f.dataType, g.dataType) if g else f.dataType
            fields.append(T.StructField(f.name, kind, True, {SPELLINGS: names} if len(names) > 1 else None))
        return T.StructType(fields + [g for g in b.fields if find_field(a, g.name) is None])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(_widen_spelled(a.elementType, b.elementType))
    return widen(a, b, exact=True)


def _spelled_out(dtype: T.DataType, number: bool = False) -> T.DataType:
    """The type with a field for each spelling, in order; or the same with the fields' numbers for names."""
    if isinstance(dtype, T.StructType):
        each = [(n, f.dataType) for f in dtype.fields for n in _spellings(f)]
        return T.StructType([T.StructField(f"_{i}" if number else n, _spelled_out(d, number)) for i, (n, d) in enumerate(each)])
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(_spelled_out(dtype.elementType, number))
    return dtype


def _folded_spellings(values: list[Column], dtype: T.DataType) -> Column:
    """One value of the type from several spelled out by number: the first that is not null, in structs field by field."""
    if isinstance(dtype, T.StructType):
        at, fields = 0, []
        for f in dtype.fields:
            n = len(_spellings(f))
            own = [v.getField(f"_{i}") for v in values for i in range(at, at + n)]
            fields.append(_folded_spellings(own, f.dataType).alias(f.name))
            at += n
        return F.when(F.coalesce(*values).isNotNull(), F.struct(*fields))
    first = F.coalesce(*values)
    if isinstance(dtype, T.ArrayType) and not same_type(dtype, _spelled_out(dtype, True)):
        return F.transform(first, lambda x: _folded_spellings([x], dtype.elementType))
    return first


def infer_json_schema(df: DataFrame, column: str = "value") -> T.StructType:
    """Schema holding every JSON object in a text or binary column.

    One aggregation inside the JVM: each task folds its own rows and only the
    schemas are shuffled. Text that is no JSON object is left out here; the
    parser hands it back as unreadable. Fields of clashing types become text.
    """
    return survey_json(df, column)[0]


def survey_json(df: DataFrame, column: str = "value") -> tuple[T.StructType, bool]:
    """The schema that ``infer_json_schema`` gives, and whether every text is sound JSON, in which no object repeats a key."""
    text = quoted(column).cast("string")
    read = df.select(F.try_parse_json(text).alias("v"), text.rlike(r"^\s*\{").alias("o"), text.isNotNull().alias("t"))
    # objects whose names are alike but for case must not pass for one type: tasks of this thread's jobs tell case apart
    context, setting = df.sparkSession.sparkContext, "spark.sql.caseSensitive"
    before = context.getLocalProperty(setting)
    context.setLocalProperty(setting, "true")
    try:
        ddl, odd = read.agg(F.schema_of_variant_agg(F.when(F.col("o"), F.col("v"))), F.count_if(F.col("t") & F.col("v").isNull())).first()
    finally:
        context.setLocalProperty(setting, before)
    if ddl is None or not ddl.startswith("OBJECT<"):
        return T.StructType([]), odd == 0
    # back-quoted names are passed over, so a field called OBJECT< is safe
    ddl = re.sub(r"`(?:[^`]|``)*`|OBJECT<", lambda m: "STRUCT<" if m.group() == "OBJECT<" else m.group(), ddl)
    return _storable(T.DataType.fromDDL(ddl)) or T.StructType([]), odd == 0


def parse_json_rows(df: DataFrame, schema: T.StructType, column: str = "value", sound: bool = False) -> DataFrame:
    """Adds ``_json`` with the parsed fields and the text of unreadable rows.

    A row counts as unreadable when its text is null, is no JSON object,
    holds a value its field cannot take, or repeats a key within an object, of whose values only one could be kept. Names that
    differ in nothing but case, where the schema was inferred from such rows, are one field: its first spelling that is not null.
    Where ``survey_json`` has found the rows ``sound``, their keys are not looked at once more.
    """
    text = quoted(column).cast("string")
    with_text = T.StructType([*schema.fields, T.StructField(UNPARSED, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": UNPARSED}
    spelled, numbered = _spelled_out(with_text), _spelled_out(with_text, True)
    # each step is a column of its own, so that the text is parsed once
    marked = df.withColumn("_json", F.from_json(text, spelled, options))
    if not same_type(spelled, with_text):
        marked = marked.withColumn("_json", F.col("_json").cast(numbered))
        marked = marked.withColumn("_json", _folded_spellings([F.col("_json")], with_text))
    if sound:
        return marked
    repeats = F.col(f"_json.{UNPARSED}").isNull() & F.try_parse_json(text).isNull()
    return marked.withColumn("_json", F.when(repeats, F.col("_json").withField(UNPARSED, text)).otherwise(F.col("_json")))
