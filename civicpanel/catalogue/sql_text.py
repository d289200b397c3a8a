"""SQL fragments for the oracle side: the report formats in DuckDB's own functions."""

from __future__ import annotations


def int_br(x: str, mark: str = ".") -> str:
    return f"replace(format('{{:,}}', CAST({x} AS BIGINT)), ',', '{mark}')"


def dec_br(x: str, digits: int) -> str:
    return f"replace(CAST(CAST({x} AS DECIMAL(38,{digits})) AS VARCHAR), '.', ',')"


def cents(x: str) -> str:
    """Rounded once, after the sum."""
    return f"CAST(SUM(CAST({x} AS DECIMAL(28,10))) AS DECIMAL(28,2))"


def times(x: str, power: int) -> str:
    """``x / 10^power`` exactly, for a decimal ``x``."""
    return f"(CAST({x} AS DECIMAL(20,2)) * CAST(0.{'0' * (power - 1)}1 AS DECIMAL({power + 1},{power})))"


def millions(x: str) -> str:
    return f"{dec_br(times(x, 6), 2)} || ' milhões'"


def billions(x: str) -> str:
    return f"{dec_br(times(x, 9), 2)} || ' bilhões'"


def money(x: str, below: str) -> str:
    return (
        f"CASE WHEN {x} >= 1000000000 THEN {billions(x)} WHEN {x} >= 1000000 THEN {millions(x)} "
        f"ELSE {below} END"
    )


def ratio(a: str, b: str, digits: int) -> str:
    """``100 * a / b`` as text with ``digits`` decimals, in whole-number arithmetic."""
    scale = 10**digits
    whole = f"((CAST({a} AS HUGEINT) * {200 * scale} + CAST({b} AS HUGEINT)) // (2 * CAST({b} AS HUGEINT)))"
    text = (
        f"(CAST({whole} // {scale} AS VARCHAR) || ',' || lpad(CAST({whole} % {scale} AS VARCHAR), {digits}, '0'))"
    )
    return f"CASE WHEN {b} <> 0 THEN {text} END"


