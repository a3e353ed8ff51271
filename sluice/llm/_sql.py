"""crc32 in DuckDB SQL, for the queries' oracles."""

from __future__ import annotations

# One row: the 256 register values of the reflected polynomial, from its rule.
CRC_TABLE_SQL = """
tab AS (SELECT list(c ORDER BY i) AS t FROM (
  SELECT i, list_reduce(list_concat([i], range(8)), lambda c, k:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i)))"""


def crc_sql(text: str) -> str:
    """DuckDB expression: unsigned crc32 of the UTF-8 bytes of ``text``; needs ``tab`` in scope."""
    # The bytes come from the hexadecimal form of the blob.
    byte = (f"list_transform(range(octet_length(encode({text}))), lambda b: "
            f"('0x' || substr(hex(encode({text})), 2 * b + 1, 2))::BIGINT)")
    return (f"xor(list_reduce(list_concat([4294967295::BIGINT], {byte}), "
            "lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295)")
