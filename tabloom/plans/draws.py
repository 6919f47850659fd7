"""Integer draws and permutations that columns, NumPy, plain Python and SQL compute alike.

All arithmetic stays below 2^63, so the functions work on integers, arrays and columns; ``draw_sql`` and ``permutation_sql`` write the same
steps as SQL.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import IntegralType

# fixed values: two primes below 2^31, and multipliers below them
PRIME_A, PRIME_B = 2147483647, 2147483629
MULTIPLIERS = (16807, 48271, 69621, 630360016, 950706376, 742938285, 1226874159, 62089911)
ROUNDS = 4
#: Walks before a position outside the table counts as an error. The domain exceeds n by less than its root, so each walk ends
#: with a probability of 1 - 1 / sqrt(n) at least.
WALKS = 48


def mix(x, salt: int):
    """A number below 2^31 from a number below 2^31: two linear steps modulo different primes."""
    m1, m2 = MULTIPLIERS[salt % 8], MULTIPLIERS[(salt // 8 + 3) % 8]
    return ((x * m1 + (salt * 40014 + 1013904223) % PRIME_A) % PRIME_A * m2 + (salt * 40692 + 12345) % PRIME_B) % PRIME_B


def mix_sql(x: str, salt: int) -> str:
    m1, m2 = MULTIPLIERS[salt % 8], MULTIPLIERS[(salt // 8 + 3) % 8]
    return f"(((({x})::bigint * {m1} + {(salt * 40014 + 1013904223) % PRIME_A}) % {PRIME_A}) * {m2} + {(salt * 40692 + 12345) % PRIME_B}) % {PRIME_B}"


def uniform(seed: int, *parts):
    """A share in [0, 1) from whole numbers below 2^31."""
    x = seed % PRIME_A
    for i, part in enumerate(parts):
        x = mix((x + part) % PRIME_A, i + 1)
    return mix(mix(x, 7), 27) / float(PRIME_B)


def uniform_sql(seed: int, *parts: str) -> str:
    x = str(seed % PRIME_A)
    for i, part in enumerate(parts):
        x = mix_sql(f"({x} + {part}) % {PRIME_A}", i + 1)
    return f"({mix_sql(mix_sql(x, 7), 27)})::double / {PRIME_B}.0::double"


def whole(df: DataFrame, name: str) -> Column:
    """Whole numbers that stand for a column's values in ``uniform``: themselves for whole numbers, else a hash; null is 0."""
    col = F.col(f"`{name}`")
    number = col.cast("long") if isinstance(df.schema[name].dataType, IntegralType) else F.xxhash64(col)
    return F.coalesce(F.pmod(number, F.lit(PRIME_A).cast("long")), F.lit(0).cast("long"))


def _sides(n: int) -> tuple[int, int]:
    a = math.isqrt(max(n - 1, 0)) + 1
    return a, -(-max(n, 1) // a)


def _salts(seed: int) -> list[int]:
    return [(seed * ROUNDS + k) * 2 + 1 for k in range(ROUNDS)]


def _network(v, a: int, b: int, seed: int, div):
    """A Feistel network on the two digits of a number below a x b: each round adds a function of one digit to the other."""
    left, right = div(v, b), v % b
    for k, salt in enumerate(_salts(seed)):
        if k % 2 == 0:
            left = (left + mix(right, salt)) % a
        else:
            right = (right + mix(left, salt)) % b
    return left * b + right


def permuted_position(position: Column, n: int, seed: int) -> Column:
    """A permutation of 0 .. n-1: the network's cycle is followed from a position until it is below n again. A batch of positions takes its steps
    together, and only those that are still outside take the next one."""
    a, b = _sides(n)
    if a * b == n:
        return _network(position, a, b, seed, lambda x, by: F.call_function("div", x, F.lit(by)))

    def walk(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        once = lambda v: _network(v, a, b, seed, lambda x, by: x // by)
        for batch in batches:
            v = once(batch.to_numpy(zero_copy_only=False))
            outside = np.flatnonzero(v >= n)
            for _ in range(WALKS):
                if not len(outside):
                    break
                v[outside] = once(v[outside])
                outside = outside[v[outside] >= n]
            if len(outside):
                raise ValueError("a permutation walk did not end: take another seed")
            yield pa.array(v, pa.int64())

    return F.arrow_udf(walk, "long")(position.cast("long"))


def permutation(n: int, seed: int) -> list[int]:
    """The same permutation as a list, for small n."""
    a, b = _sides(n)
    out = []
    for v in range(n):
        v = _network(v, a, b, seed, lambda x, by: x // by)
        while v >= n:
            v = _network(v, a, b, seed, lambda x, by: x // by)
        out.append(v)
    return out


def permutation_sql(name: str, n: str, seed: int) -> str:
    """Common table expressions ``{name}(p, v)``: position p of 0 .. n-1 goes to v; for ``WITH RECURSIVE``."""
    salts = _salts(seed)
    steps = f"v // b as l0, v % b as r0, (l0 + {mix_sql('r0', salts[0])}) % a as l1, (r0 + {mix_sql('l1', salts[1])}) % b as r1, " \
            f"(l1 + {mix_sql('r1', salts[2])}) % a as l2, (r1 + {mix_sql('l2', salts[3])}) % b as r2"
    return f"""{name}_n as (select n, a, (n + a - 1) // a as b from (select n, ceil(sqrt(n))::bigint as a from (select ({n})::bigint as n))),
        {name}_w(p, v) as (select p, l2 * b + r2 from (select p, b, {steps} from (select p, p as v, a, b from {name}_n, range((select n from {name}_n)) x(p)))
            union all select p, l2 * b + r2 from (select p, b, {steps} from (select p, v, a, b from {name}_w, {name}_n where v >= n))),
        {name} as (select p, v from {name}_w where v < (select n from {name}_n))"""
