"""Strict JSON on Spark (FN-1 .. FN-5 and a canonical form).

Spark's lenient parsers (``try_parse_json``, ``from_json``,
``get_json_object``) accept trailing text such as ``{"a":1} tail``.  Strict
validity is obtained by wrapping the text in an array together with a
value-dependent sentinel and requiring that exactly two elements come back and
that the second one is the sentinel: any trailing text either breaks the parse
or changes the element count.

Parsed values are VARIANT.  VARIANT keeps the difference between an absent key
and a JSON ``null`` and the exact JSON type of every value, which a typed
``from_json`` would coerce away.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _wrapped(s: Column) -> Column:
    """``[s, xxhash64(s)]`` parsed leniently (VARIANT, null when unparsable)."""
    sentinel = F.xxhash64(s)
    return F.try_parse_json(F.concat(F.lit("["), s, F.lit(","), sentinel.cast("string"), F.lit("]")))


def _ok_from_wrapped(w: Column, s: Column) -> Column:
    """Exactly two elements and the second is the sentinel.

    Element probes by path (``$[1]``, ``$[2]``) avoid materialising the
    wrapper as ``array<variant>`` (which would copy the whole document).
    """
    return F.coalesce(
        (F.try_variant_get(w, "$[1]", "bigint") == F.xxhash64(s)) & F.try_variant_get(w, "$[2]", "variant").isNull(),
        F.lit(False),
    )


def strict_json(s: Column) -> tuple[Column, Column]:
    """(is_valid, parsed VARIANT or null) for a string column.

    Both expressions share the same sub-expression; keep them in one
    projection (or use ``with_strict_json``) so the parse runs once per row.
    """
    w = _wrapped(s)
    ok = _ok_from_wrapped(w, s)
    return ok, F.when(ok, F.try_variant_get(w, "$[0]", "variant"))


def is_strict_json(s: Column) -> Column:
    return strict_json(s)[0]


#: the parser gives up on values of more bytes, and on more nested levels, than these
PARSER_BYTES, PARSER_DEPTH = 1 << 24, 1000


def beyond_parser(s: Column, max_bytes: int = PARSER_BYTES, max_depth: int = PARSER_DEPTH) -> Column:
    """Whether a text that failed to parse is one that the parser may refuse by size or depth,
    so that nothing is known about it.  The brackets are counted only for texts that could nest so deep.

    The limits are parameters: the defaults are the parser's own, lower ones put more texts in this class, never fewer."""
    if max_bytes > PARSER_BYTES or max_depth > PARSER_DEPTH:
        raise ValueError("limits above the parser's own would call texts invalid that it cannot judge")
    n = F.octet_length(s)
    opened = F.char_length(F.regexp_replace(s, r"[^\[{]", ""))
    return F.when(n > max_bytes, True).when(n >= max_depth, opened >= max_depth - 1).otherwise(False)


def with_strict_json(df: DataFrame, src: str, prefix: str) -> DataFrame:
    """Add ``{prefix}_ok`` (boolean) and ``{prefix}_v`` (variant) columns.

    The wrapped parse is materialised in its own projection and referenced
    twice, so the plan contains a single ``try_parse_json`` per row.  A
    repeated key is accepted whatever the session says (the setting is made here).
    """
    df.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    tmp = f"__{prefix}_w"
    s = F.col(src)
    keep = [F.col(f"`{c}`") for c in df.columns]
    w = df.select(*keep, _wrapped(s).alias(tmp))
    # two projections: the parse, then both results (the shared ``ok`` test is one
    # common sub-expression of that projection)
    ok = _ok_from_wrapped(F.col(tmp), s)
    return w.select(*keep, ok.alias(f"{prefix}_ok"),
                    F.when(ok, F.try_variant_get(F.col(tmp), "$[0]", "variant")).alias(f"{prefix}_v"))


def json_type(v: Column) -> Column:
    """JSON type name of a VARIANT: object, array, string, number, boolean, null.

    Null input (absent) gives null, JSON null gives 'null'.
    """
    t = F.schema_of_variant(v)
    return (
        F.when(v.isNull(), F.lit(None).cast("string"))
        .when(t.startswith("OBJECT"), "object")
        .when(t.startswith("ARRAY"), "array")
        .when(t == "STRING", "string")
        .when(t == "BOOLEAN", "boolean")
        .when(t == "VOID", "null")
        .otherwise("number")
    )


def _path(key: str) -> str:
    return "$['" + key.replace("'", "\\'") + "']"


def get_field(v: Column, key: str) -> Column:
    """Value under ``key`` as VARIANT; null when absent or ``v`` is not an object."""
    return F.try_variant_get(v, _path(key), "variant")


def has_key(v: Column, key: str) -> Column:
    """``key in obj`` for a JSON object (a JSON null value counts as present)."""
    return F.coalesce(get_field(v, key).isNotNull(), F.lit(False))


def get_string(v: Column, key: str) -> Column:
    """String value under ``key`` only when it *is* a JSON string, else null."""
    f = get_field(v, key)
    return F.when(F.schema_of_variant(f) == "STRING", F.try_variant_get(f, "$", "string"))


def variant_string(v: Column) -> Column:
    """The text of a VARIANT that is a JSON string, else null."""
    return F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string"))


def canonical_json(v: Column) -> Column:
    """Canonical text of a VARIANT (object keys sorted, compact)."""
    return F.to_json(v)


def object_size(v: Column) -> Column:
    """Number of keys of a JSON object; null for non-objects."""
    return F.size(F.try_variant_get(v, "$", "map<string,variant>"))
