"""Derived attributes: pure Column expressions, one per business rule."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def chain(cases: list[tuple[Column, str]], otherwise: str | None = None) -> Column:
    """First matching case wins."""
    expr = F.when(cases[0][0], cases[0][1])
    for condition, label in cases[1:]:
        expr = expr.when(condition, label)
    return expr if otherwise is None else expr.otherwise(otherwise)


# --- calendar parts ---------------------------------------------------------

def month_name(d: Column) -> Column:
    return F.date_format(d, "MMMM")


def day_name(d: Column) -> Column:
    return F.date_format(d, "EEEE")


def quarter_label(d: Column) -> Column:
    return F.concat(F.lit("Q"), F.quarter(d))


def year_month(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM")


def fiscal_quarter(d: Column) -> Column:
    return F.concat(F.lit("FY"), F.year(d), F.lit("-"), quarter_label(d))


def is_weekend(d: Column) -> Column:
    return F.dayofweek(d).isin(1, 7)


def order_date_parts(d: Column) -> dict[str, Column]:
    return {
        "order_year": F.year(d),
        "order_month": F.month(d),
        "order_month_name": month_name(d),
        "order_quarter": quarter_label(d),
        "order_day_of_week": day_name(d),
        "order_week_number": F.weekofyear(d),
    }


# The labels and edges of all rules below.

# --- order line -------------------------------------------------------------

def shipping_performance(delay: Column) -> Column:
    return chain([(delay < 0, "Early"), (delay == 0, "On Time")], "Late")


def fraud_label(status: Column) -> Column:
    return chain([(F.upper(status) == "SUSPECTED_FRAUD", "Fraud")], "Legitimate")


def fraud_flag(label: Column) -> Column:
    """1 for a fraud line, whatever the case of the label; NULL counts as not fraud."""
    return F.when(F.lower(label) == "fraud", 1).otherwise(0)


def profit_category(ratio: Column) -> Column:
    return chain([(ratio > 0.2, "High Profit"), (ratio > 0, "Low Profit")], "Loss")


def profit_tier(ratio: Column) -> Column:
    return chain([(ratio > 0.3, "High"), (ratio > 0.1, "Medium"), (ratio > 0, "Low")], "Loss")


def right_closed(c: Column, edges: list[float], labels: list[str]) -> Column:
    """Label of the bin (edge[i], edge[i+1]] that holds the value; NULL outside."""
    return chain([((c > lo) & (c <= hi), label)
                  for lo, hi, label in zip(edges, edges[1:], labels)])


# Discount tiers of the fact table and discount bands of the report.
DISCOUNT_TIER_EDGES = [-0.01, 0.0, 0.1, 0.2, 1.0]
DISCOUNT_TIERS = ["No Discount", "Low (1-10%)", "Medium (11-20%)", "High (>20%)"]
DISCOUNT_BAND_EDGES = [0.0, 0.05, 0.10, 0.15, 0.20, 0.25, 1.0]
DISCOUNT_BANDS = ["0-5%", "5-10%", "10-15%", "15-20%", "20-25%", "25%+"]


def discount_tier(rate: Column) -> Column:
    return right_closed(rate, DISCOUNT_TIER_EDGES, DISCOUNT_TIERS)


def discount_band(rate: Column) -> Column:
    return right_closed(rate, DISCOUNT_BAND_EDGES, DISCOUNT_BANDS)


# --- web log ----------------------------------------------------------------

def add_to_cart_flag(url: Column) -> Column:
    return F.coalesce(F.contains(url, F.lit("add_to_cart")), F.lit(False)).cast("int")


def action_type(flag: Column) -> Column:
    return chain([(flag == 1, "Add to Cart")], "Product View")


def hour_group(hour: Column) -> Column:
    return chain([(hour < 6, "Night (0-5)"), (hour < 12, "Morning (6-11)"),
                  (hour < 18, "Afternoon (12-17)")], "Evening (18-23)")


# --- dimensions -------------------------------------------------------------

def full_location(city: Column, country: Column) -> Column:
    return F.concat(city, F.lit(", "), country)


def stock_status(status: Column) -> Column:
    return chain([(status == 0, "In Stock")], "Out of Stock")


def price_range(price: Column) -> Column:
    return chain([(price < 50, "Budget (<$50)"), (price < 200, "Mid ($50-$200)"),
                  (price < 500, "Premium ($200-$500)")], "Luxury (>$500)")


def status_group(status: Column) -> Column:
    upper = F.upper(status)
    return chain([(F.contains(upper, F.lit(word)), label) for word, label in [
        ("COMPLETE", "Completed"), ("CANCEL", "Cancelled"),
        ("FRAUD", "Fraud"), ("PENDING", "Pending")]], "Other")


def delivery_risk_flag(status: Column) -> Column:
    return chain([(F.contains(status, F.lit("Late")), "At Risk")], "Normal")


# --- scores and report bands ------------------------------------------------

def rfm_segment(score: Column) -> Column:
    return chain([(score >= 10, "Champions"), (score >= 8, "Loyal"),
                  (score >= 6, "Potential"), (score >= 4, "At Risk")], "Lost")


def above(c: Column, threshold: float | Column) -> Column:
    """Two-way report band; NULL is not above."""
    return chain([(c > threshold, "above")], "below")


def risk_level(rate: Column, high: float, medium: float) -> Column:
    """Three-way report band for rates in percent."""
    return chain([(rate > high, "high"), (rate > medium, "medium")], "low")
