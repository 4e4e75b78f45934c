"""Sample-array functions (ARR10-ARR13, JSN2, MTH1) as native array expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FADE_SECONDS = 0.005        # fixed value: cross-fade length after a forward shift
EQUAL_ENERGY_K = 1.4186     # fixed value: equal-energy cross-fade coefficient
EQUAL_GAIN_K = -0.70912     # fixed value: equal-gain cross-fade coefficient


def duration_seconds(samples: Column, rate: int) -> Column:
    """MTH1: samples / rate."""
    return F.size(samples).cast("double") / F.lit(float(rate))


def fade_masks(length: int, equal_energy: bool = True) -> tuple[Column, Column]:
    """ARR11: (fade_in, fade_out) arrays of ``length`` points on [0, 1]."""
    k = EQUAL_ENERGY_K if equal_energy else EQUAL_GAIN_K
    if length <= 0:
        empty = F.array().cast("array<double>")
        return empty, empty
    denom = float(max(length - 1, 1))
    xs = F.transform(F.sequence(F.lit(0), F.lit(length - 1)), lambda i: i.cast("double") / denom)

    def curve(x, rising):
        a = x * (1 - x)
        b = a * (1 + F.lit(k) * a)
        c = b + (x if rising else (1 - x))
        return c * c
    return F.transform(xs, lambda x: curve(x, True)), F.transform(xs, lambda x: curve(x, False))


def shift_forward(samples: Column, seconds: Column, rate: int, equal_energy: bool = True) -> Column:
    """ARR10 + ARR11: prepend ``rint(seconds * rate)`` zeros, then fade in the first
    ``int(rate * 0.005)`` shifted samples."""
    n = F.rint(seconds * F.lit(float(rate))).cast("int")
    fade_len = int(rate * FADE_SECONDS)
    fade_in, _ = fade_masks(fade_len, equal_energy)
    shifted = F.concat(F.array_repeat(F.lit(0.0), n), F.transform(samples, lambda v: v.cast("double")))
    return F.transform(shifted, lambda v, i: F.when((i >= n) & (i < n + fade_len),
                                                    v * F.element_at(fade_in, (i - n + 1).cast("int")))
                                              .otherwise(v))


def encode_int16(samples: Column) -> Column:
    """ARR12 encode: truncate ``v * 32767`` to SMALLINT."""
    return F.transform(samples, lambda v: (v.cast("double") * 32767).cast("smallint"))


def decode_int16(pcm: Column) -> Column:
    """ARR12 decode: ``v / 32768``."""
    return F.transform(pcm, lambda v: v.cast("double") / 32768.0)


def chunks(samples: Column, size: int) -> Column:
    """ARR13: consecutive chunks of ``size`` (the last may be shorter)."""
    n = F.size(samples)
    starts = F.when(n > 0, F.sequence(F.lit(0), n - 1, F.lit(size))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.slice(samples, i + 1, size))


def base64_payload(payload: Column) -> Column:
    """JSN2: base64 text of a binary payload, unchunked (Spark may break base64 into
    76-character MIME lines depending on session settings)."""
    return F.regexp_replace(F.base64(payload), r"[\r\n]", "")
