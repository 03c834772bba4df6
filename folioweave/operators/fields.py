"""A model's field values as a typed record, and images as data addresses, as Column builders."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .decide import optional

# Spellings of genders and relations.
GENDERS = {"male": "male", "female": "female", "पुरुष": "male", "महिला": "female"}
RELATIONS = {"father": "father", "husband": "husband"}


def _one_of(value: Column, known: dict[str, str]) -> tuple[Column, Column]:
    """The value's plain name, and whether it is neither known nor empty."""
    low = F.lower(optional(value))
    out = F.lit(None).cast("string")
    for spelling, plain in known.items():
        out = F.when(low == spelling, F.lit(plain)).otherwise(out)
    return out, low.isNotNull() & out.isNull()


def typed(p: dict[str, Column]) -> Column:
    """struct of the normal fields and ``error``: the first invalid field's message, else null. p: text columns by field."""
    age = optional(p["age"])
    gender, bad_gender = _one_of(p["gender"], GENDERS)
    relation, bad_relation = _one_of(p["relation_type"], RELATIONS)
    bad_age = age.isNotNull() & ~age.rlike(r"^-?\d+$")
    told = lambda field, value: F.concat(F.lit(f"Invalid {field}: "), value)
    error = F.when(bad_relation, told("relation_type", p["relation_type"])).when(bad_age, told("age", age)).when(bad_gender, told("gender", p["gender"]))
    plain = [optional(p[n]).alias(n) for n in ("serial_number", "epic_number", "elector_name", "relation_name", "house_number")]
    return F.struct(*plain, relation.alias("relation_type"), F.when(~bad_age, age.try_cast("int")).alias("age"), gender.alias("gender"), error.alias("error"))


def data_address(image: Column, mime: str = "image/png") -> Column:
    """data:...;base64,... without line ends."""
    return F.concat(F.lit(f"data:{mime};base64,"), F.regexp_replace(F.base64(image), r"\s", ""))
