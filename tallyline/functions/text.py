"""Text, number and label rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyline.functions.times import col_of

# Text parts that name a brand, in the order in which they are tried.
BRAND_RULES = [
    ("iphone", "Apple"),
    ("huawei", "Huawei"),
    ("honor", "Honor"),
    ("mi", "Xiaomi"),
    ("oppo", "OPPO"),
    ("vivo", "Vivo"),
    ("samsung", "Samsung"),
    ("realme", "Realme"),
]
PLATFORMS = ["iOS", "Android"]
COUNTED_BRANDS = ["Apple", "Huawei", "Xiaomi", "OPPO", "Vivo", "Samsung"]

# Pages that take part in path analysis, and the behaviour groups.
KEY_PAGES = ["home", "product_list", "product_detail", "search", "payment", "login", "cart"]
PURCHASE_PAGES = ["payment"]
SEARCH_PAGES = ["search"]
BROWSE_PAGES = ["product_list", "product_detail", "home"]


def lenient_number(c: Column | str, kind: str) -> Column:
    """Cast that gives NULL for text which is no such number."""
    return col_of(c).try_cast(kind)


def filled(c: Column | str) -> Column:
    """Neither NULL nor empty."""
    return col_of(c).isNotNull() & (col_of(c) != "")


def clean_id(c: Column | str) -> Column:
    """Id without newlines (real or written as backslash-n) and outer blanks."""
    return F.trim(F.regexp_replace(col_of(c), r"\\n|\n", ""))


def comma_count(c: Column | str) -> Column:
    """Number of entries in a comma list."""
    return F.size(F.split(col_of(c), ","))


def percent_text(share: Column) -> Column:
    """Share as percent with two digits, e.g. ``40.0%``."""
    return F.concat(F.round(share * 100, 2).cast("string"), F.lit("%"))


def json_words(c: Column | str) -> Column:
    """JSON array text as comma text; empty if it is not an array; NULL and '' stay."""
    c = col_of(c)
    words = F.array_join(F.from_json(c, "array<string>"), ",")
    return F.when(c.isNull() | (c == ""), c).otherwise(F.coalesce(words, F.lit("")))


def word_array(c: Column | str) -> Column:
    """Trimmed non-empty words of a text separated by ASCII or full-width commas."""
    return F.filter(F.transform(F.split(col_of(c), "[,，]"), lambda w: F.trim(w)), lambda w: w != "")


def platform_label(c: Column | str) -> Column:
    plat = F.lower(col_of(c))
    return (
        F.when(plat.contains("iphone") | plat.contains("ios"), "iOS")
        .when(plat.contains("android"), "Android")
        .otherwise("unknown")
    )


def brand_label(c: Column | str) -> Column:
    brand = F.lower(col_of(c))
    label = F.when(brand.isNull(), "unknown")
    for part, name in BRAND_RULES:
        label = label.when(brand.contains(part), name)
    return label.otherwise("Other")


def region_text(*parts: Column | str) -> Column:
    """Non-empty parts joined by one blank."""
    return F.concat_ws(" ", *[F.nullif(col_of(p), F.lit("")) for p in parts])


def region_part(c: Column | str, n: int) -> Column:
    """n-th part (from 1) of a ``province|city|operator`` text; NULL if it has fewer."""
    return F.nullif(F.split_part(col_of(c), F.lit("|"), F.lit(n)), F.lit(""))


def is_key_page(c: Column | str) -> Column:
    return F.coalesce(col_of(c).isin(KEY_PAGES), F.lit(False))


def yes_no(flag: Column, yes: str = "是", no: str = "否") -> Column:
    return F.when(flag, yes).otherwise(no)


def ratio(part: Column, whole: Column) -> Column:
    """Quotient as double; NULL where the base is zero."""
    return F.try_divide(part.cast("double"), whole.cast("double"))
