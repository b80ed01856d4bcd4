"""Parts of the SQL twins that several operators share."""

from __future__ import annotations


def crc32_sql(name: str) -> str:
    """CTEs ``name``: (v, crc), the unsigned crc32 of the UTF-8 bytes of each ``v`` of ``<name>_of``.

    The usual table of 256 entries follows from the reversed polynomial 0xEDB88320.
    """
    return f"""
{name}_table AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(range(8), lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i) AS c
    FROM range(256) AS r(i))
), {name}_bytes AS (
  SELECT v, list_transform(range(octet_length(encode(v))), lambda j: ('0x' || substr(hex(encode(v)), 2 * j + 1, 2))::BIGINT) AS b
  FROM {name}_of
), {name} AS (
  SELECT v, xor(list_reduce(b, lambda c, x: xor(c // 256, t[1 + xor(c % 256, x)]), 4294967295), 4294967295) AS crc
  FROM {name}_bytes, {name}_table
)"""
