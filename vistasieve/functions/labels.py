"""Label decoding, translation and class extraction as column expressions.

All of it is built from higher-order array functions (``transform``,
``filter``, ``array_intersect``), so it stays inside the JVM.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: a label token is an integer the way Python's int() reads a
# plain ASCII token: optional sign, digits, single underscores between digits.
INT_TOKEN = r"^[+-]?[0-9]+(_[0-9]+)*$"
# the same token as the first whitespace-separated field of a line
FIRST_INT_TOKEN = r"^\s*([+-]?[0-9]+(?:_[0-9]+)*)(?:\s|$)"


def _str_array(values: Sequence[str] | None) -> Column:
    if not values:
        return F.array().cast("array<string>")
    return F.array(*[F.lit(v) for v in values])


def _str_map(m: Mapping[str, str] | None) -> Column | None:
    if not m:
        return None
    return F.create_map(*[F.lit(x) for kv in m.items() for x in kv])


def decode(value: Column, dtype: T.DataType, names: Sequence[str] | None) -> Column:
    """strings pass; booleans are null; integer ids index ``names`` (0-based, null when out of range)."""
    if isinstance(dtype, T.StringType):
        return value
    if isinstance(dtype, T.BooleanType):
        return F.lit(None).cast("string")
    if isinstance(dtype, T.IntegralType):
        if not names:
            return F.lit(None).cast("string")
        # get() is 0-based and null for negative or past-the-end ids (element_at would raise)
        return F.get(_str_array(names), value.try_cast("int"))
    return F.lit(None).cast("string")


def translate(value: Column, class_map: Mapping[str, str] | None) -> Column:
    """source spelling -> registry name, identity when absent."""
    m = _str_map(class_map)
    if m is None:
        return value
    return F.coalesce(F.try_element_at(m, value), value)


def _decoder(dtype: T.DataType, names: Sequence[str] | None):
    # a one-argument lambda: transform() reads a second parameter as the element index
    return lambda x: decode(x, dtype, names)


def _category_array(df: DataFrame, key: str) -> tuple[Column, T.DataType] | None:
    """The category ids of ``key`` for both nesting shapes, with their element type."""
    if key not in df.columns:
        return None
    dtype = df.schema[key].dataType
    if isinstance(dtype, T.StructType) and "category" in dtype.fieldNames():
        cat_t = dtype["category"].dataType
        if isinstance(cat_t, T.ArrayType):
            return F.col(key)["category"], cat_t.elementType
        return F.array(F.col(key)["category"]), cat_t
    if isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StructType):
        el = dtype.elementType
        if "category" in el.fieldNames():
            return F.transform(F.col(key), lambda o: o["category"]), el["category"].dataType
    return None


def extract_classes(
    df: DataFrame,
    allowed: Sequence[str] | Column,
    class_map: Mapping[str, str] | None = None,
    names: Sequence[str] | None = None,
    label_names: Sequence[str] | None = None,
    label_col: str = "label",
) -> Column:
    """Union of ``label``, ``objects`` and ``annotations`` classes,
    decoded, translated, kept if allowed, distinct and sorted.
    """
    parts: list[Column] = []
    if label_col in df.columns:
        lt = df.schema[label_col].dataType
        parts.append(F.array(decode(F.col(label_col), lt, label_names)))
    for key in ("objects", "annotations"):
        found = _category_array(df, key)
        if found is None:
            continue
        arr, et = found
        parts.append(F.transform(F.coalesce(arr, F.array().cast(T.ArrayType(et))), _decoder(et, names)))
    if not parts:
        return F.array().cast("array<string>")
    allowed_col = allowed if isinstance(allowed, Column) else _str_array(allowed)
    raw = F.concat(*parts) if len(parts) > 1 else parts[0]
    mapped = F.transform(raw, lambda x: translate(x, class_map))
    kept = F.filter(mapped, lambda x: x.isNotNull() & F.array_contains(allowed_col, x))
    return F.array_sort(F.array_distinct(kept))


BOX = "array<struct<class_name: string, box: array<double>>>"


def row_boxes(df: DataFrame, class_map: Mapping[str, str] | None = None, names: Sequence[str] | None = None) -> Column:
    """The boxes (x, y, width, height in pixels) of ``objects`` and ``annotations``, in row order, with their class names
    decoded and translated; both nesting shapes. An annotation without a box of four numbers has none."""
    parts: list[Column] = []
    for key in ("objects", "annotations"):
        found = _category_array(df, key)
        dtype = df.schema[key].dataType if found else None
        inner = dtype.elementType if isinstance(dtype, T.ArrayType) else dtype
        if found is None or "bbox" not in inner.fieldNames():
            continue
        cats, et = found
        box = F.col(key)["bbox"]
        if isinstance(dtype, T.StructType) and not isinstance(inner["category"].dataType, T.ArrayType):
            box = F.array(box)  # a single annotation
        decoder = _decoder(et, names)
        named = F.transform(cats, lambda c: translate(decoder(c), class_map))
        zipped = F.arrays_zip(named.alias("class_name"), box.cast("array<array<double>>").alias("box"))
        parts.append(F.coalesce(zipped.cast(BOX), F.array().cast(BOX)))
    if not parts:
        return F.array().cast(BOX)
    return F.concat(*parts) if len(parts) > 1 else parts[0]


def parse_yolo_line(line: Column, names: Sequence[str]) -> Column:
    """The class name of one YOLO label line, or null when the line is
    blank, its first token is not an integer, or the id is outside ``names``.

    One anchored regex takes the first whitespace-separated token only when it
    is an integer token (so a line is scanned once, not stripped, split and
    matched separately).
    """
    if not names:
        return F.lit(None).cast("string")
    tok = F.regexp_extract(line, FIRST_INT_TOKEN, 1)
    as_int = F.when(tok != "", F.replace(tok, F.lit("_"), F.lit("")).try_cast("int"))
    return F.get(_str_array(names), as_int)


def classes_from_yolo_lines(
    lines: DataFrame,
    key_cols: Sequence[str],
    names: Sequence[str],
    allowed: Sequence[str],
    class_map: Mapping[str, str] | None = None,
) -> DataFrame:
    """Per image key: distinct sorted allowed classes found in its label lines.

    The group is one image's lines, so its size is bounded by the boxes of one
    image; a partial ``collect_set`` runs before the shuffle.
    """
    named = lines.select(*key_cols, translate(parse_yolo_line(F.col("line"), names), class_map).alias("class"))
    kept = named.where(F.col("class").isNotNull() & F.col("class").isin(list(allowed)))
    return kept.groupBy(*key_cols).agg(F.array_sort(F.collect_set("class")).alias("classes"))


def names_from_schema(schema: T.StructType) -> tuple[list[str] | None, list[str] | None]:
    """Class-name tables carried in field metadata (``{"names": [...]}``).

    The category names come from ``objects`` (else ``annotations``), found by
    walking array elements and struct fields down to ``category`` (bounded to
    10 levels); label names from ``label``. Unresolved tables are ``None``.
    """

    def walk(field_or_type, depth=0):
        if depth > 10 or field_or_type is None:
            return None
        if isinstance(field_or_type, T.StructField):
            names = (field_or_type.metadata or {}).get("names")
            if names:
                return list(names)
            return walk(field_or_type.dataType, depth + 1)
        if isinstance(field_or_type, T.ArrayType):
            return walk(field_or_type.elementType, depth + 1)
        if isinstance(field_or_type, T.StructType):
            if "category" in field_or_type.fieldNames():
                return walk(field_or_type["category"], depth + 1)
            return None
        return None

    fields = {f.name: f for f in schema.fields}
    obj = fields.get("objects") or fields.get("annotations")
    cat_names = None
    if obj is not None:
        meta = (obj.metadata or {}).get("names")
        cat_names = list(meta) if meta else walk(obj.dataType)
    label = fields.get("label")
    return cat_names, (walk(label) if label is not None else None)
