"""Log-linear bucketing of integers."""

from __future__ import annotations


def bucket_shift(value: str, bits: int) -> str:
    """SQL: power of two of the bucket width; 0 while the value fits in ``bits`` bits."""
    return f"greatest(0, length(bin(abs({value}))) - {bits})"


def bucket_low(value: str, bits: int) -> str:
    """SQL: lowest value of the bucket that holds ``value``, a bigint.

    Values below ``2**bits`` have a bucket of their own; above, every power of two is cut into
    ``2**(bits-1)`` equal buckets. So there are at most ``2**bits + 63 * 2**(bits-1)`` buckets,
    whatever the data, and the order of buckets is the order of values.
    """
    shift = bucket_shift(value, bits)
    return f"shiftleft(shiftright({value}, {shift}), {shift})"


def bucket_high(low: str, bits: int) -> str:
    """SQL: highest value of the bucket that starts at ``low`` (not negative)."""
    return f"{low} + shiftleft(1L, {bucket_shift(low, bits)}) - 1"
