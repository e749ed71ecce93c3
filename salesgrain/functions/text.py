"""Rules that read names, codes and numbers out of text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from salesgrain.functions import fixed_values as fv
from salesgrain.params import Rules


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def is_free_item(code: Column, name: Column, rules: Rules) -> Column:
    """Give-aways: kept out of every unit count, never out of money."""
    return text_or_empty(code).isin(*rules.free_codes) | text_or_empty(name).contains(
        rules.free_name_part
    )


def choice_key(choice: Column) -> Column:
    """An option choice as the option map spells it: trailing asterisks removed."""
    return F.trim(F.regexp_replace(choice, r"\*+\s*$", ""))


def drink_tier(price: Column, rules: Rules) -> Column:
    return (
        F.when(price <= F.lit(rules.water_max), "water")
        .when(price <= F.lit(rules.paid_bev_max), "paid")
        .otherwise("premium")
    )


def topping_key(name: Column, rules: Rules) -> Column:
    """One key for a topping, whether picked as an option or ordered from the menu.

    A menu code and the word for "add" count only where the name begins with them, before any remark or
    marker; of the words that follow, remarks and markers go and then a weight at the end.
    """
    rest = F.regexp_extract(name, rf"(?s)^(?:\s*[A-Z]\d+)?\s*(?:{fv.TOPPING_ADD_WORD})?(.*)$", 1)
    plain = F.regexp_replace(rest, r"\([^)]*\)|\*", "")
    weight = rf"(?:\d+\s*(?:{'|'.join(fv.TOPPING_GRAM_WORDS)})?)?"
    words = F.regexp_extract(plain, rf"(?s)^(.*?){weight}\s*$", 1)
    key = F.array_join(F.split(words, r"\s+"), "")
    aliased = key
    for short, full in rules.topping_aliases.items():
        aliased = F.when(key == short, F.lit(full)).otherwise(aliased)
    return aliased


def variant_pattern(rules: Rules) -> str:
    return r"\s(" + "|".join(rules.variant_words) + r")\s*$"


def dish_family(name: Column, rules: Rules) -> Column:
    """Dish name without its menu code and without a trailing variant word."""
    uncoded = F.regexp_replace(name, r"^\s*[A-Za-z]+\d+\s*", "")
    return F.trim(F.regexp_replace(uncoded, variant_pattern(rules), ""))


def dish_variant(name: Column, rules: Rules) -> Column:
    """The trailing variant word, NULL when there is none."""
    return F.nullif(F.regexp_extract(name, variant_pattern(rules), 1), F.lit(""))


def pad_number(digits: Column) -> Column:
    """Short numbers get leading zeros up to three digits; longer ones are never cut."""
    return F.when(F.length(digits) <= 3, F.lpad(digits, 3, "0")).otherwise(digits)


def keyed_order_number(text: Column, rules: Rules) -> Column:
    """A platform order number typed into a till field, NULL when the text is something else."""
    return F.nullif(F.regexp_extract(text, rules.order_number_re, 1), F.lit(""))


def export_order_number(text: Column) -> Column:
    """First run of digits of a platform order id."""
    return pad_number(F.nullif(F.regexp_extract(text, r"(\d+)", 1), F.lit("")))


def lenient_number(text: Column) -> Column:
    """Digits, dot and minus only; anything that still is no number counts as zero."""
    kept = F.regexp_replace(text_or_empty(text), r"[^0-9.\-]", "")
    return F.coalesce(kept.try_cast("decimal(18,4)"), F.lit(0).cast("decimal(18,4)"))


def lenient_int(text: Column) -> Column:
    return lenient_number(text).cast("int")


def store_location(store: Column, store_names: dict[str, str]) -> Column:
    """Location of a platform store name, NULL when no known name part occurs in its tail."""
    tail = F.lower(F.trim(F.substring_index(text_or_empty(store), " - ", -1)))
    found = F.lit(None).cast("string")
    for part, location in reversed(list(store_names.items())):
        found = F.when(tail.contains(part.lower()), F.lit(location)).otherwise(found)
    return found
