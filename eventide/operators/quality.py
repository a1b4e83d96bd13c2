"""Row quality score: stateless, all input columns passed through."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.functions.columns import not_blank, require_columns

# Fixed values that must equal the reference's (points per check, limits).
AMOUNT_POINTS, USERID_POINTS, COUNTRY_POINTS, MERCHANT_POINTS = 20.0, 30.0, 25.0, 25.0
PASSING_SCORE = 80.0
MIN_AMOUNT, MAX_AMOUNT = 0.0, 10000.0
MIN_USERID_LENGTH = 3
MIN_COUNTRY_LENGTH, MAX_COUNTRY_LENGTH = 2, 3
OUTPUT = ("quality_score", "quality_issues", "is_valid")


def quality_score(df: DataFrame, *, user: str = "userId", amount: str = "amount",
                  country: str = "country", merchant: str = "merchant",
                  rules: str = "code", country_codes=None) -> DataFrame:
    """Input columns ++ quality_score DOUBLE, quality_issues STRING, is_valid BOOLEAN.

    rules='code': 0 <= amount <= 10000 (the reference code);
    rules='readme': 0 < amount < 1000000 (the documented variant).
    ``country_codes``: optional list of allowed codes (e.g. ISO 3166)."""
    require_columns(df, [user, amount, country, merchant], "quality_score")
    clash = [c for c in OUTPUT if c in df.columns]
    if clash:
        raise ValueError(f"quality_score: input already has column(s) {clash}")
    a = F.col(amount).cast("double")
    if rules == "code":
        amount_ok = a.isNotNull() & (a >= MIN_AMOUNT) & (a <= MAX_AMOUNT)
    elif rules == "readme":
        amount_ok = a.isNotNull() & (a > 0.0) & (a < 1_000_000.0)
    else:
        raise ValueError("rules must be 'code' or 'readme'")
    u, c, m = F.col(user).cast("string"), F.col(country), F.col(merchant)
    country_ok = c.isNotNull() & (F.length(c) >= MIN_COUNTRY_LENGTH) & \
        (F.length(c) <= MAX_COUNTRY_LENGTH)
    if country_codes is not None:
        country_ok = country_ok & c.isin(list(country_codes))
    checks = [
        (amount_ok & ~F.isnan(a), AMOUNT_POINTS, "INVALID_AMOUNT"),
        (u.isNotNull() & (F.length(u) >= MIN_USERID_LENGTH), USERID_POINTS, "INVALID_USERID"),
        (country_ok, COUNTRY_POINTS, "INVALID_COUNTRY"),
        (m.isNotNull() & not_blank(m), MERCHANT_POINTS, "INVALID_MERCHANT"),
    ]
    score = F.lit(0.0)
    issues = []
    for ok, pts, name in checks:
        ok = F.coalesce(ok, F.lit(False))
        score = score + F.when(ok, F.lit(pts)).otherwise(F.lit(0.0))
        issues.append(F.when(~ok, F.lit(name)))
    return df.withColumns({"quality_score": score,
                           "quality_issues": F.concat_ws(",", *issues),
                           "is_valid": score >= F.lit(PASSING_SCORE)})
