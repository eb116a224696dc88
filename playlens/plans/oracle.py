"""DuckDB SQL for the oracle side of the query registry.

The fixture views of FIXTURES.md are emitted as CTEs in dependency order, so each oracle string is
one self-contained SELECT over the pre-registered test tables.
"""

from __future__ import annotations

import re

FIXTURE_SQL: dict[str, str] = {
    "interactions": """
        SELECT o_custkey AS user_id, l_partkey AS track_id, CAST(SUM(l_quantity) AS BIGINT) AS count
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey
        GROUP BY o_custkey, l_partkey""",
    "train": """
        SELECT o_custkey AS user_id, l_partkey AS track_id, CAST(SUM(l_quantity) AS BIGINT) AS count
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey
        WHERE o_orderkey % 5 <> 0
        GROUP BY o_custkey, l_partkey""",
    "val": """
        SELECT o_custkey AS user_id, l_partkey AS track_id, CAST(SUM(l_quantity) AS BIGINT) AS count
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey
        WHERE o_orderkey % 5 = 0
        GROUP BY o_custkey, l_partkey""",
    "songs": """
        SELECT p_partkey AS track_id, CONCAT(p_brand, '/', p_type) AS artist_id,
               CASE WHEN p_partkey % 97 = 0 THEN NULL ELSE p_retailprice END AS duration,
               CAST((p_partkey * 37) % 1000 AS DOUBLE) / 1000 AS artist_familiarity,
               CAST((p_partkey * 91) % 1000 AS DOUBLE) / 1000 AS artist_hotttnesss,
               1960 + p_size AS year
        FROM part""",
    "artist_term": """
        SELECT DISTINCT artist_id, term
        FROM (SELECT CONCAT(p_brand, '/', p_type) AS artist_id, CASE WHEN p_brand <> 'Brand#11' THEN p_name END AS term FROM part) x
        WHERE term IS NOT NULL""",
    "user_factors": "SELECT vec_id AS id, embedding AS features FROM embeddings WHERE vec_id % 4 = 0",
    "item_factors": "SELECT vec_id AS id, embedding AS features FROM embeddings WHERE vec_id % 4 <> 0",
    "val_users": "SELECT DISTINCT vec_id AS id FROM embeddings WHERE vec_id % 8 = 0",
    "tids": "SELECT p_partkey AS tid_key, CONCAT('TR', CAST(p_partkey AS VARCHAR)) AS tid FROM part",
    "tags": """
        SELECT CAST(DENSE_RANK() OVER (ORDER BY p_name) AS BIGINT) AS tag_key, p_name AS tag
        FROM (SELECT DISTINCT p_name FROM part) x""",
    "tid_tag": """
        SELECT p_partkey AS tid_key, tag_key, CAST(p_size AS DOUBLE) AS val FROM part JOIN tags ON p_name = tag""",
    "lyrics": """
        SELECT doc_id AS track_id, word, COUNT(*) AS count
        FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS word FROM documents) x
        WHERE word <> '' GROUP BY doc_id, word""",
}

FIXTURE_DEPS = {"tid_tag": ["tags"]}


def with_fixtures(body: str, ctes: list[tuple[str, str]] | None = None) -> str:
    """Prefix ``body`` with the fixture CTEs it names (by word match) plus extra named CTEs.

    ``ctes`` are (name, sql) pairs that may themselves use fixtures; they are emitted after the
    fixtures, in the given order.
    """
    ctes = ctes or []
    text = body + " ".join(sql for _, sql in ctes)
    used: list[str] = []

    def need(name: str) -> None:
        for dep in FIXTURE_DEPS.get(name, []):
            need(dep)
        if name not in used:
            used.append(name)

    for name in FIXTURE_SQL:
        if re.search(rf"\b{name}\b", text):
            need(name)
    parts = [f"{name} AS ({FIXTURE_SQL[name]})" for name in used]
    parts += [f"{name} AS ({sql})" for name, sql in ctes]
    if not parts:
        return body
    return "WITH " + ",\n".join(parts) + "\n" + body


# Spark's hash() of a BIGINT: Murmur3 x86 32-bit, seed 42, over the two 32-bit halves of the value
# (low word first), finalised with length 8. Fixed constants of the algorithm:
_M32 = 4294967296
_C1, _C2 = 0xCC9E2D51, 0x1B873593
_MIX_ADD = 0xE6546B64
_FMIX1, _FMIX2 = 0x85EBCA6B, 0xC2B2AE35
_SEED = 42


def murmur3_of(value: int, seed: int = _SEED) -> int:
    """Spark's ``hash`` of a BIGINT value as an unsigned number (the start of a hash over more columns)."""
    h = seed % _M32
    for word in (value % _M32, value % 2**64 // _M32):
        k = word * _C1 % _M32
        k = (k << 15 | k >> 17) % _M32 * _C2 % _M32
        h ^= k
        h = ((h << 13 | h >> 19) % _M32 * 5 + _MIX_ADD) % _M32
    h ^= 8
    h = (h ^ h >> 16) * _FMIX1 % _M32
    h = (h ^ h >> 13) * _FMIX2 % _M32
    return h ^ h >> 16


def seeded_unit_bigint(expr: str, seed: int) -> str:
    """DuckDB form of ``keys.seeded_unit`` for a BIGINT key."""
    return f"((CAST({murmur3_bigint(expr, murmur3_of(seed))} AS BIGINT) + 2147483648) / 4294967296.0)"


def murmur3_bigint(expr: str, seed: int = _SEED) -> str:
    """DuckDB expression equal to Spark's ``hash(expr)`` for a BIGINT ``expr`` (INTEGER result).

    Built as nested scalar steps; every value stays in [0, 2^32) and products go through HUGEINT.
    """

    def mul(a: str, c: int) -> str:
        return f"CAST((CAST({a} AS HUGEINT) * {c}) % {_M32} AS BIGINT)"

    def rotl(a: str, r: int) -> str:
        return f"(CAST((CAST({a} AS HUGEINT) * {2 ** r}) % {_M32} AS BIGINT) + ({a}) // {2 ** (32 - r)})"

    def xor(a: str, b: str) -> str:
        return f"xor({a}, {b})"

    unsigned = f"(CASE WHEN ({expr}) < 0 THEN CAST({expr} AS HUGEINT) + {2 ** 64} ELSE CAST({expr} AS HUGEINT) END)"
    lo = f"CAST({unsigned} % {_M32} AS BIGINT)"
    hi = f"CAST({unsigned} // {_M32} AS BIGINT)"

    # The expression tree is shallow enough when each step is wrapped in a scalar subquery that
    # names its input once (DuckDB evaluates it per row).
    def step(var: str, body: str, inner: str) -> str:
        return f"(SELECT {body} FROM (SELECT {inner} AS {var}))"

    def block(h: str, k: str) -> str:
        k1 = step("k", rotl(mul("k", _C1), 15), k)
        k2 = mul(k1, _C2)
        h1 = step("h", rotl("h", 13), xor(h, k2))
        return f"CAST(({h1}) * 5 + {_MIX_ADD} AS BIGINT) % {_M32}"

    h = block(str(seed), lo)
    h = block(h, hi)
    h = step("h", xor("h", "h // 65536"), xor(h, "8"))
    h = step("h", xor("h", "h // 8192"), mul(h, _FMIX1))
    h = step("h", xor("h", "h // 65536"), mul(h, _FMIX2))
    return f"CAST({step('h', f'CASE WHEN h >= 2147483648 THEN h - {_M32} ELSE h END', h)} AS INTEGER)"
