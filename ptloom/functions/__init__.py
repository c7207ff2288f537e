"""Column-level building blocks (all JVM-side expressions, no Python UDFs)."""

from ptloom.functions.jsonx import (  # noqa: F401
    canonical_json,
    has_key,
    json_type,
    strict_json,
    with_strict_json,
)
from ptloom.functions.text import strip_ws, is_blank  # noqa: F401
from ptloom.functions.hashing import seeded_hash, seeded_hex  # noqa: F401
