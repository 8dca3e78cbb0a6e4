"""CRC-32 in DuckDB SQL: a table of 256 remainders, then one step per byte."""

# One row (t): the remainders as a list.
CRC_TABLE = """
  SELECT list(r ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_concat([CAST(i AS BIGINT)], CAST(range(8) AS BIGINT[])),
             lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS r
    FROM (SELECT unnest(range(256)) AS i))"""


def crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of a text's UTF-8 bytes, where ``t`` is in scope."""
    return (f"xor(list_reduce(list_concat([4294967295], list_transform(regexp_extract_all(hex(encode({text})), '..'), "
            "lambda x: CAST('0x' || x AS BIGINT))), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295)")
