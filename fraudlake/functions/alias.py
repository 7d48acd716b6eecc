"""Keyed account alias (HMAC-SHA256) as a JVM column expression.

HMAC(k, m) = H((k' xor opad) || H((k' xor ipad) || m)), with k' the key
zero-padded to the 64-byte block (hashed first when longer). Spark has no hmac
function, but ``sha2`` over ``concat`` of binaries computes it inside whole-stage
codegen: no Python UDF, no per-row serialization. Only the two 64-byte pads
are computed on the driver.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

from fraudlake.schemas import ALIAS_HEX_CHARS, ALIAS_PREFIX

_BLOCK = 64


def hmac_pads(pepper: str | bytes) -> tuple[str, str]:
    """Return (ipad_hex, opad_hex) for a pepper; raises when it is empty."""
    if pepper is None or len(pepper) == 0:
        raise ValueError("a pepper is required to compute account aliases")
    key = pepper.encode("utf-8") if isinstance(pepper, str) else bytes(pepper)
    if len(key) > _BLOCK:
        key = hashlib.sha256(key).digest()
    key = key.ljust(_BLOCK, b"\x00")
    ipad = bytes(b ^ 0x36 for b in key).hex()
    opad = bytes(b ^ 0x5C for b in key).hex()
    return ipad, opad


def hmac_sha256_hex(col: Column | str, pepper: str | bytes) -> Column:
    """Hex HMAC-SHA256 of the UTF-8 bytes of ``col`` under ``pepper``."""
    ipad, opad = hmac_pads(pepper)
    c = F.col(col) if isinstance(col, str) else col
    inner = F.sha2(F.concat(F.unhex(F.lit(ipad)), F.encode(c, "UTF-8")), 256)
    return F.sha2(F.concat(F.unhex(F.lit(opad)), F.unhex(inner)), 256)


def account_alias(col: Column | str, pepper: str | bytes) -> Column:
    """``ANON_`` + first 16 hex characters of HMAC-SHA256(pepper, id)."""
    return F.concat(F.lit(ALIAS_PREFIX), F.substring(hmac_sha256_hex(col, pepper), 1, ALIAS_HEX_CHARS))


def account_alias_duckdb(col_sql: str, pepper: str | bytes) -> str:
    """The same alias as a DuckDB SQL expression (used by the oracle)."""
    ipad, opad = hmac_pads(pepper)
    inner = f"sha256(unhex('{ipad}') || encode({col_sql}))"
    return f"('{ALIAS_PREFIX}' || substr(sha256(unhex('{opad}') || unhex({inner})), 1, {ALIAS_HEX_CHARS}))"


def account_alias_py(account_id: str, pepper: str | bytes) -> str:
    """Driver-side twin for tests and single lookups."""
    import hmac

    key = pepper.encode("utf-8") if isinstance(pepper, str) else bytes(pepper)
    digest = hmac.new(key, account_id.encode("utf-8"), hashlib.sha256).hexdigest()
    return ALIAS_PREFIX + digest[:ALIAS_HEX_CHARS]
