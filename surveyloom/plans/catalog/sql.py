"""Pieces of reference SQL."""


def erfc(x: str) -> str:
    """Complementary error function by its positive series; 0 or 2 beyond |x| = 6 to 16 digits."""
    series = (f"list_sum(list_transform(range(0, 150), lambda n: exp((2 * n + 1) * ln(abs({x})) "
              f"- lgamma(n + cast(1.5 as double)) - ({x}) * ({x}))))")
    return (f"(case when ({x}) is null then null when ({x}) = 0 then 1.0 when ({x}) > 6 then 0.0 "
            f"when ({x}) < -6 then 2.0 when ({x}) > 0 then 1 - {series} else 1 + {series} end)")


def normal_p(z: str) -> str:
    return erfc(f"abs({z}) / sqrt(2.0)")


def chi_p(s: str, df: str) -> str:
    z = f"((pow({s} / {df}, 1.0 / 3) - (1 - 2.0 / (9 * {df}))) / sqrt(2.0 / (9 * {df})))"
    return f"(case when {df} <= 0 then null when {s} <= 0 then 1.0 else 0.5 * {erfc(z + ' / sqrt(2.0)')} end)"


def r6(x: str) -> str:
    return f"round(cast({x} as double), 6) + 0.0"


def contains_any(text: str, needles) -> str:
    return "(" + " or ".join(f"contains({text}, '{n.lower()}')" for n in needles) + ")"


def union_all(parts) -> str:
    return "\nunion all\n".join(parts)
