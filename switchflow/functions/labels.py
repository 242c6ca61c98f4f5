"""Classification expressions: offer classes, price bands, movement classes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from switchflow.schema import SIZES

# Offer classes, line break included.
CONDITIONAL = "Market offers with\nconditional discounts"
GUARANTEED = "Market offers with\nguaranteed discounts"
NO_DISCOUNT = "Market offers without\ndiscounts"

# Price bands from cheapest to dearest.
BANDS = (
    "Much lower (<-10%)",
    "Moderately lower (5-10%)",
    "Near average (±5%)",
    "Moderately higher (5-10%)",
    "Much higher (>10%)",
)
BASELINE_BAND = "Near average (±5%)"
TOP_BAND = "Much higher (>10%)"

# Lag labels by number of weeks.
LAG_LABELS = {
    0: "Current Week (Lag 0)",
    2: "2 Weeks Ago (Lag 2w)",
    4: "4 Weeks Ago (Lag 4w)",
    8: "8 Weeks Ago (Lag 8w)",
}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _ladder(c: Column, steps: list[tuple[float, str]], last: str, inclusive: tuple[str, ...] = ()) -> Column:
    """Classes by ascending upper limit: `<` unless the class is inclusive."""
    out = None
    for limit, name in steps:
        test = c <= limit if name in inclusive else c < limit
        out = F.when(test, name) if out is None else out.when(test, name)
    return out.otherwise(last)


def offer_category(discount: Column | str, conditional: Column | str) -> Column:
    """Offer class from the two 0/1 flags; a null flag falls through to Other."""
    d, c = _col(discount), _col(conditional)
    return (
        F.when((d == 1) & (c == 1), CONDITIONAL)
        .when((d == 1) & (c == 0), GUARANTEED)
        .when((d == 0) & (c == 0), NO_DISCOUNT)
        .otherwise("Other")
    )


def price_band(c: Column | str) -> Column:
    """Band of a % distance to the market; edges belong to the lower band."""
    c = _col(c)
    lower, mid_low, near, mid_high, upper = BANDS
    return (
        F.when(c > 10, upper).when(c > 5, mid_high).when(c > -5, near).when(c > -10, mid_low).otherwise(lower)
    )


def band_order(c: Column | str) -> Column:
    """1-based position of a band label."""
    return F.array_position(F.array(*map(F.lit, BANDS)), _col(c)).cast("int")


def movement_type(a: Column | str, b: Column | str) -> Column:
    """Same Size / Moving Up / Moving Down between two size classes."""
    a, b = _col(a), _col(b)
    up = ((a == "Small") & (b != "Small")) | ((a == "Medium") & (b == "Large"))
    return F.when(a == b, "Same Size").when(up, "Moving Up").otherwise("Moving Down")


def size_index(c: Column | str, side: str = "from") -> Column:
    """Node index of a size: 0-2 on the losing side, 3-5 on the gaining side.

    An unknown size has no node and gives null.
    """
    at = F.array_position(F.array(*map(F.lit, SIZES)), _col(c)).cast("int")
    return F.when(at > 0, at - 1 + (0 if side == "from" else len(SIZES)))


def contract_class(c: Column | str) -> Column:
    c = _col(c)
    return F.when(c == 0, "No fixed term").otherwise(
        _ladder(
            c,
            [(0.75, "Short-term / flexible"), (1.25, "1-year typical")],
            "Longer term (1.5–2 yrs)",
            inclusive=("1-year typical",),
        )
    )


def solar_class(c: Column | str) -> Column:
    return _ladder(_col(c), [(10, "No solar options"), (50, "Some solar options")], "Mostly solar-friendly offers")


def incentive_class(c: Column | str) -> Column:
    return _ladder(_col(c), [(10, "No incentives"), (50, "Some incentives")], "Most offers include incentives")


def contract_detail_class(c: Column | str) -> Column:
    return _ladder(
        _col(c),
        [(0.1, "No fixed term (0)"), (0.5, "Mostly flexible (<0.5)"), (1.5, "Mostly 1-year (0.5-1.5)")],
        "Long term (>1.5)",
    )


def contract_years(c: Column | str) -> Column:
    """Contract term text as years; unknown and missing terms are 0."""
    c = _col(c)
    return F.when(c == "1 year", 1.0).when(c == "2 year", 2.0).otherwise(0.0)
