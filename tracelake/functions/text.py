"""String rules: index lines, names, attributes, URLs, list literals, encodings."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def index_line(line: Column) -> Column:
    """``struct<path,factor>`` of ``path@duplicateN``; null for blank or malformed lines."""
    line = F.trim(line)
    parts = F.split(line, "@")
    factor = F.regexp_replace(F.get(parts, F.lit(1)), "duplicate", "").try_cast("int")
    return F.when((F.size(parts) == 2) & (F.get(parts, F.lit(0)) != "") & factor.isNotNull(), F.struct(F.get(parts, F.lit(0)).alias("path"), factor.alias("factor")))


def subdataset_name(path: Column) -> Column:
    """Name in a storage path: after ``/god/`` and before ``/train_god_``; else the first part with GOD_E2E below ``god``; else the parent folder."""
    first = F.regexp_extract(path, r"/god/([^/]+)/train_god_", 1)
    second = F.regexp_extract(path, r"/god/(?:[^/]*/)*?([^/]*GOD_E2E[^/]*)", 1)
    parent = F.regexp_extract(path, r"([^/]+)/[^/]*$", 1)
    return F.coalesce(F.nullif(first, F.lit("")), F.nullif(second, F.lit("")), F.nullif(parent, F.lit("")))


def normal_name(name: Column) -> Column:
    """Sub-dataset name without prefix, cut tails, trailing timestamp and outer underscores."""
    n = F.regexp_replace(name, "^GOD_E2E_", "")
    n = F.regexp_replace(n, r"_sub_ddi_.*$", "")
    n = F.regexp_replace(n, r"_277[^_]*e2e_.*$", "")
    n = F.regexp_replace(n, r"_\d{4}_\d{2}_\d{2}_\d{2}_\d{2}_\d{2}$", "")
    n = F.regexp_replace(n, r"^_+|_+$", "")
    return F.when(n == "", "unnamed_dataset").otherwise(n)


def table_name(name: Column, prefix: str = "clips_bbox_") -> Column:
    """Partition-table name: lower-case words joined by underscores, cut at 38 and with prefix at 50 characters."""
    n = F.lower(F.regexp_replace(normal_name(name), "[^A-Za-z0-9_]", "_"))
    n = F.regexp_replace(F.regexp_replace(n, "_+", "_"), "^_+|_+$", "")
    return F.substring(F.concat(F.lit(prefix), F.regexp_replace(F.substring(n, 1, 38), "_+$", "")), 1, 50)


def url_parameter(url: Column, name: str) -> Column:
    return F.nullif(F.regexp_extract(url, f"[?&]{name}=([^&#]+)", 1), F.lit(""))


def attributes(line: Column) -> Column:
    """Map of ``url|k=v|flag``'s attributes; a flag is ``true``; of a repeated key the last value counts."""
    parts = F.filter(F.split(line, r"\|"), lambda p: F.trim(p) != "")
    rest = F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0)))
    pair = lambda p: F.struct(F.trim(F.substring_index(p, "=", 1)).alias("key"), F.when(p.contains("="), F.trim(F.regexp_replace(p, "^[^=]*=", ""))).otherwise("true").alias("value"))
    pairs = F.transform(rest, pair)
    last = lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda q: q["key"] == p["key"])
    return F.map_from_entries(F.filter(pairs, last))


def field_type(value: Column) -> Column:
    """boolean, integer, numeric or text, the first that a value's text fits; null for null."""
    v = F.lower(F.trim(value))
    return (
        F.when(value.isNull(), None)
        .when(v.isin("true", "false"), "boolean")
        .when(v.rlike(r"^[+-]?[0-9]+$"), "integer")
        .when(v.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?$"), "numeric")
        .otherwise("text")
    )


#: Priority of field types, least general first (fixed values).
TYPE_ORDER = ("boolean", "integer", "numeric", "text")


def merged_type(types: Column) -> Column:
    """Most general of the types in a group."""
    order = F.array(*[F.lit(t) for t in TYPE_ORDER])
    return F.get(order, F.max(F.array_position(order, types)).cast("int") - 1)


def list_literal(value: Column, of: str) -> Column:
    """Array of a list literal such as ``['a', 'b']`` or ``[[0, 2]]``; null if malformed."""
    return F.from_json(F.regexp_replace(value, "'", '"'), f"array<{of}>")


def time_ranges(value: Column) -> Column:
    """Valid ``[start, end]`` pairs (start before end) of a list literal."""
    return F.filter(list_literal(value, "array<double>"), lambda r: (F.size(r) == 2) & (F.get(r, F.lit(0)) < F.get(r, F.lit(1))))


def merged_labels(a: Column, b: Column) -> Column:
    """Trimmed, distinct, sorted labels of two arrays; blank ones go."""
    both = F.concat(F.coalesce(a, F.array().cast("array<string>")), F.coalesce(b, F.array().cast("array<string>")))
    return F.array_sort(F.array_distinct(F.filter(F.transform(both, lambda x: F.trim(x)), lambda x: x != "")))


@F.pandas_udf(StringType())
def from_gbk(raw: pd.Series) -> pd.Series:
    """GBK bytes as text; null where they aren't GBK (Spark's own decoding knows no GBK)."""

    def read(x: bytes | None) -> str | None:
        try:
            return None if x is None else bytes(x).decode("gbk")
        except UnicodeDecodeError:
            return None

    return raw.map(read)


def repaired(text: Column) -> Column:
    """UTF-8 or else GBK text that was read as Latin-1, where that gives Chinese characters and nothing undecodable; else the text itself."""
    raw = F.when(text.rlike("^[\\x00-\\xFF]*$") & text.rlike("[\\x80-\\xFF]"), F.encode(text, "ISO-8859-1"))
    han = "[一-龥]"
    utf = F.try_validate_utf8(raw)
    gbk = from_gbk(F.when(utf.isNull(), raw))
    return F.when(text.rlike(han), text).when(utf.rlike(han), utf).when(gbk.rlike(han), gbk).otherwise(text)


def image_format(content: Column) -> Column:
    """Format by leading bytes (fixed values), or ``unknown``."""
    head = F.hex(F.substring(content, 1, 12))
    return (
        F.when(head.startswith("FFD8"), "jpeg")
        .when(head.startswith("89504E470D0A1A0A"), "png")
        .when(head.startswith("47494638"), "gif")
        .when(head.startswith("52494646") & (F.substring(head, 17, 8) == "57454250"), "webp")
        .when(head.startswith("424D"), "bmp")
        .otherwise("unknown")
    )


def camera(collection: Column) -> Column:
    """Camera of a collection name ``camera_encoded_N``; camera 1 by default."""
    n = F.regexp_extract(collection, r"camera_encoded_(\d+)", 1)
    return F.concat(F.lit("camera_"), F.when(n == "", "1").otherwise(n))
