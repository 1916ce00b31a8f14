"""Nutrient parsing, plausibility bounds, salt and sodium."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Plausible range per 100 g, both ends included.
NUTRIENT_BOUNDS = {
    "sugars_100g": (0.0, 100.0),
    "salt_100g": (0.0, 25.0),
    "fat_100g": (0.0, 100.0),
    "proteins_100g": (0.0, 100.0),
    "energy_100g": (0.0, 1300.0),
    "energy-kcal_100g": (0.0, 800.0),
}

# Measures that count towards completeness.
CORE_NUTRIENTS = ("energy-kcal_100g", "sugars_100g", "salt_100g", "proteins_100g", "fat_100g")

SALT_PER_SODIUM = 2.5


def parse_number(c: Column) -> Column:
    """Text with decimal point or comma to double; NULL for anything else, NaN included."""
    # ``replace`` looks for bytes; ``translate`` would look up every character.
    number = F.replace(c.cast("string"), F.lit(","), F.lit(".")).try_cast("double")
    return F.when(~F.isnan(number), number)


def clamp(number: Column, low: float, high: float) -> Column:
    """NULL when negative or outside the bounds."""
    return F.when(number.between(max(low, 0.0), high), number)


def harmonise_salt(numbers: dict[str, Column], mode: str = "column") -> dict[str, Column]:
    """Derive sodium from salt or salt from sodium.

    ``column`` fills only when one of the two columns is missing altogether; ``row`` also fills
    single missing values.
    """
    if mode not in ("column", "row"):
        raise ValueError(f"unknown salt mode: {mode}")
    salt, sodium = numbers.get("salt_100g"), numbers.get("sodium_100g")
    filled = dict(numbers)
    if salt is not None and sodium is None:
        filled["sodium_100g"] = salt / SALT_PER_SODIUM
    elif sodium is not None and salt is None:
        filled["salt_100g"] = sodium * SALT_PER_SODIUM
    elif salt is not None and mode == "row":
        filled["salt_100g"] = F.coalesce(salt, sodium * SALT_PER_SODIUM)
        filled["sodium_100g"] = F.coalesce(sodium, salt / SALT_PER_SODIUM)
    return filled
