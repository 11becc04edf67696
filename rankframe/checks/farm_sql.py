"""FarmHash's 64-bit fingerprint of short ASCII keys, in plain SQL on 128-bit integers."""

from __future__ import annotations

from rankframe.functions.fingerprint import K0, K1, K2

_WORD = str(1 << 64)


def _product(a: str, b: str) -> str:
    return f"(({a})::uhugeint * ({b})::uhugeint % {_WORD}::uhugeint)"


def _sum(*parts: str) -> str:
    return f"(({' + '.join(f'({p})::uhugeint' for p in parts)}) % {_WORD}::uhugeint)"


def _turn(value: str, bits: int) -> str:
    low, high = 1 << bits, 1 << (64 - bits)
    return f"({value} // {low}::uhugeint + ({value} % {low}::uhugeint) * {high}::uhugeint)"


def _mix(value: str) -> str:
    return f"xor({value}, {value} // {1 << 47}::uhugeint)"


def _read(at: str, n: int) -> str:
    """``n`` bytes from the zero-based position ``at``, the first one lowest; 0 before the start."""
    return " + ".join(
        f"(case when {at} + {i} between 0 and n - 1 then ascii(substr(k, ({at} + {i} + 1)::int, 1))"
        f" else 0 end)::uhugeint * {1 << 8 * i}::uhugeint"
        for i in range(n)
    )


def fingerprint_ctes(name: str, source: str, key: str) -> str:
    """CTE ``name``: the rows of ``source`` plus ``fp``, the unsigned fingerprint of ``key``.

    ``key`` may have 1 to 32 characters; a null has a null fingerprint.
    """
    read = ", ".join(
        f"{_read(at, n)} as {out}"
        for out, at, n in (
            ("q0", "0", 8), ("q8", "8", 8), ("y8", "n - 8", 8), ("y16", "n - 16", 8),
            ("d0", "0", 4), ("y4", "n - 4", 4), ("b0", "0", 1), ("bm", "n // 2", 1), ("bz", "n - 1", 1),
        )
    )
    by_length = "case when n >= 17 then {} when n >= 8 then {} else {} end"
    first = by_length.format(_product("q0", str(K1)), _sum("q0", str(K2)), "d0")
    last = by_length.format(_product("y8", "mul"), "y8", "y4")
    left = by_length.format(
        _sum(_turn("a8", 43), _turn("z", 30), _product("y16", str(K2))),
        _sum(_product(_turn("z", 37), "mul"), "a"),
        "n::uhugeint + a * 8",
    )
    right = by_length.format(
        _sum("a", _turn("q8k", 18), "z"), _product(_sum(_turn("a", 25), "z"), "mul"), "z"
    )
    tiny = f"xor({_product('b0 + bm * 256', str(K2))}, {_product('n::uhugeint + bz * 4', str(K0))})"
    return f"""{name}_0 as (select *, {key} as k, length({key}) as n from {source}),
{name}_1 as (select *, {_sum(str(K2), 'n * 2')} as mul, {read} from {name}_0),
{name}_2 as (select *, {first} as a, {last} as z, {_sum('q8', str(K2))} as q8k, {tiny} as tiny from {name}_1),
{name}_3 as (select *, {_sum('a', 'q8')} as a8 from {name}_2),
{name}_4 as (select *, {left} as l, {right} as r from {name}_3),
{name}_5 as (select *, {_product('xor(l, r)', 'mul')} as j from {name}_4),
{name}_6 as (select *, {_product(f'xor(r, {_mix("j")})', 'mul')} as j2 from {name}_5),
{name} as (select * exclude (k, n, mul, q0, q8, y8, y16, d0, y4, b0, bm, bz, a, z, q8k, tiny, a8, l, r, j, j2),
  case when n >= 4 then {_product(_mix('j2'), 'mul')} else {_product(_mix('tiny'), str(K2))} end as fp
  from {name}_6)"""


def fingerprint_bucket(n: int) -> str:
    """The size of ``fp`` as a signed number, modulo ``n``."""
    size = f"(case when fp >= {1 << 63}::uhugeint then {_WORD}::uhugeint - fp else fp end)"
    return f"({size} % {n}::uhugeint)::bigint"
