"""Readable text for promotion rules."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

# Rule kinds by type code.
COUPON_KINDS = {"3201": "amount_off", "3202": "discount_on_count", "3203": "plain_off"}
ACTIVITY_KINDS = {"3101": "amount_off", "3102": "discount_on_count", "3103": "plain_discount"}


def _templates(cond_amount: Column, cond_num: Column, amount: Column, discount: Column):
    # The wording of the four rule kinds.
    return {
        "amount_off": F.concat(F.lit("满"), cond_amount, F.lit("元减"), amount, F.lit("元")),
        "discount_on_count": F.concat(F.lit("满"), cond_num, F.lit("件打"), discount, F.lit(" 折")),
        "plain_off": F.concat(F.lit("减"), amount, F.lit("元")),
        "plain_discount": F.concat(F.lit("打"), discount, F.lit("折")),
    }


def rule_text(type_code: Column, kinds: Mapping[str, str], cond_amount: Column, cond_num: Column,
              amount: Column, discount: Column) -> Column:
    """Text of a promotion rule; unknown type codes give NULL."""
    wording = _templates(*[c.cast("string") for c in (cond_amount, cond_num, amount, discount)])
    text = F.lit(None).cast("string")
    for code, kind in kinds.items():
        text = F.when(type_code == code, wording[kind]).otherwise(text)
    return text
