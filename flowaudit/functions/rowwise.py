"""Row-local feature and score expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

EPS = 1e-6


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def engineered_features(cols: set) -> dict[str, Column]:
    """The six row-wise engineered features, for the inputs present.

    ``cols`` uses snake_case names.  Ratios are ``x / (y + 1e-6)``."""
    out: dict[str, Column] = {}
    fw, bw = "total_fwd_packets", "total_backward_packets"
    lf, lb = "total_length_of_fwd_packets", "total_length_of_bwd_packets"
    if fw in cols and bw in cols:
        out["eng_total_packets"] = F.col(fw) + F.col(bw)
        out["eng_fwd_bwd_pkt_ratio"] = F.col(fw) / (F.col(bw) + EPS)
    if lf in cols and lb in cols:
        out["eng_total_bytes"] = F.col(lf) + F.col(lb)
        out["eng_fwd_bwd_byte_ratio"] = F.col(lf) / (F.col(lb) + EPS)
        if "eng_total_packets" in out:
            out["eng_bytes_per_packet"] = (F.col(lf) + F.col(lb)) / (F.col(fw) + F.col(bw) + EPS)
    flags = ["fin_flag_count", "syn_flag_count", "rst_flag_count",
             "psh_flag_count", "ack_flag_count", "urg_flag_count"]
    if set(flags) <= set(cols):
        total = F.col(flags[0])
        for f in flags[1:]:
            total = total + F.col(f)
        out["eng_combined_flags"] = total
    return out


def port_bucket(c) -> Column:
    """Well-known / registered / dynamic port range, else '0'."""
    c = _c(c)
    return (F.when((c >= 1) & (c <= 1023), "1-1023")
             .when((c >= 1024) & (c <= 49151), "1024-49151")
             .when((c >= 49152) & (c <= 65535), "49152-65535")
             .otherwise("0"))


def iqr_outlier(c, q1: Column | float, q3: Column | float, k: float = 1.5) -> Column:
    """Value outside [Q1 - k*IQR, Q3 + k*IQR] (bounds fitted elsewhere)."""
    c = _c(c)
    q1, q3 = F.lit(q1) if not isinstance(q1, Column) else q1, F.lit(q3) if not isinstance(q3, Column) else q3
    iqr = q3 - q1
    return (c < q1 - F.lit(k) * iqr) | (c > q3 + F.lit(k) * iqr)


def negative(c) -> Column:
    """P17."""
    return _c(c) < 0


def at_threshold(score, t) -> Column:
    """``score >= t`` as 0/1."""
    return (_c(score) >= (t if isinstance(t, Column) else F.lit(t))).cast("int")


def argmax(arr) -> Column:
    """0-based position of the first maximum of an array."""
    a = _c(arr)
    return (F.array_position(a, F.array_max(a)) - 1).cast("int")


def softmax(arr) -> Column:
    """P20: row-wise softmax, max-shifted for stability."""
    a = _c(arr).cast("array<double>")
    m = F.array_max(a)
    e = F.transform(a, lambda x: F.exp(x - m))
    s = F.aggregate(e, F.lit(0.0), lambda acc, x: acc + x)
    return F.transform(e, lambda x: x / s)


def sig_round(c, digits: int = 6) -> Column:
    """Round to ``digits`` significant digits (stable comparisons of large sums).

    SQL twin: ``CASE WHEN x = 0 OR NOT isfinite(x) THEN x ELSE
    round(x / 10^(floor(log10(abs(x))) - (digits-1))) * 10^(floor(log10(abs(x))) - (digits-1)) END``"""
    x = _c(c).cast("double")
    e = F.pow(F.lit(10.0), F.floor(F.log10(F.abs(x))) - F.lit(digits - 1))
    return F.when((x == 0) | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))) | x.isNull(), x) \
            .otherwise(F.round(x / e) * e)


def sig_round_sql(x: str, digits: int = 6) -> str:
    x = f"({x})"
    e = f"pow(10.0, floor(log10(abs({x}))) - {digits - 1})"
    return f"(CASE WHEN {x} = 0 OR NOT isfinite({x}) THEN {x} ELSE round({x} / {e}) * {e} END)"
