"""Column expressions: flags, rules, guards, rounding, hashes, vector access."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def select_as(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Project `names` (new name -> source column)."""
    return df.select(*[F.col(src).alias(new) for new, src in names.items()])


def flag(condition: Column) -> Column:
    """Condition to 0/1; an unknown condition stays null."""
    return condition.cast("int")


def first_match(rules: Sequence[tuple[Column, str]], default: str) -> Column:
    """Label of the first rule that holds, else `default`; an unknown rule falls through."""
    (cond, label), *rest = rules
    out = F.when(cond, F.lit(label))
    for cond, label in rest:
        out = out.when(cond, F.lit(label))
    return out.otherwise(F.lit(default))


def per_positive(num: Column, den: Column) -> Column:
    """num / den, dividing by 1 where den is not above zero (or unknown)."""
    return num / F.when(den > 0, den).otherwise(F.lit(1))


def per_at_least_one(num: Column, den: Column) -> Column:
    """num / max(den, 1), null where den is null."""
    return num / at_least(den, 1)


def at_least(x: Column, bound: float) -> Column:
    """max(x, bound) that keeps null as null (`greatest` alone would skip it)."""
    return F.when(x.isNotNull(), F.greatest(x, F.lit(bound)))


def half_up(x: Column, digits: int) -> Column:
    """Round half up on the double itself, the same in every engine."""
    scale = float(10**digits)
    return F.floor(x * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def half_even(x: Column, digits: int) -> Column:
    return F.bround(x, digits)


def logistic(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def log_odds(p: Column) -> Column:
    return F.log(p / (F.lit(1.0) - p))


def member_id(key: Column) -> Column:
    """Subscriber id text of a numeric key."""
    return F.format_string("SUB%05d", key)


def member_number(member: Column) -> Column:
    """Numeric part of a subscriber id; null when the text is not a number."""
    return F.substring(member, 4, 20).try_cast("bigint")


def class_probability(vector: Column, index: int = 1) -> Column:
    """Element of a probability (or raw prediction) vector; class 1 sits at index 1."""
    return vector_to_array(vector).getItem(index)


def threshold_label(p: Column, threshold: Column | float, above: str, below: str) -> Column:
    t = threshold if isinstance(threshold, Column) else F.lit(threshold)
    return F.when(p >= t, F.lit(above)).otherwise(F.lit(below))


def recode(x: Column, mapping: dict) -> Column:
    """Look x up in a small fixed mapping; a value outside it becomes null."""
    pairs = [F.lit(v) for kv in mapping.items() for v in kv]
    return F.try_element_at(F.create_map(*pairs), x)


def key_hash(key: Column | str, seed: int = 0) -> Column:
    """Hex hash of a key. Uniform and overflow-free at any key size, equal across engines."""
    k = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(k.cast("string"), F.lit(f"|{seed}")))


def hash_fraction(key: Column | str, seed: int = 0) -> Column:
    """The first 32 bits of the key hash as a fraction in [0, 1)."""
    head = F.substring(key_hash(key, seed), 1, 8)
    return F.conv(head, 16, 10).cast("double") / F.lit(4294967296.0)
