"""Business rules, held as data so that the report and the filter agree."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """``keep`` is a SQL condition on the normalised layer; NULL means drop.

    ``needs`` names raw columns without which no row is kept: where one of them
    is NULL the condition is NULL or false. They are tested at the scan.
    """

    name: str
    keep: str
    needs: tuple[str, ...] = ()

    def kept(self) -> Column:
        return F.expr(self.keep)


# The limits of a valid order, cheapest test first.
ORDER_RULES = (
    Rule("bad_hour", "hour_of_day BETWEEN 0 AND 23", ("hour_of_day",)),
    Rule("bad_return_flag", "is_return IN (0, 1)", ("is_return",)),
    Rule("bad_cost", "cost > 0", ("cost",)),
    Rule("bad_amount", "order_amount_old >= 5.0D", ("order_amount_old",)),
    Rule("bad_date", "parsed_dt IS NOT NULL", ("date",)),
)


def columns_read(rules: tuple[Rule, ...], columns: list[str]) -> tuple[str, ...]:
    """Those of ``columns`` that a rule names."""
    text = " ".join(rule.keep for rule in rules)
    return tuple(name for name in columns if re.search(rf"\b{re.escape(name)}\b", text, re.IGNORECASE))


def columns_needed(rules: tuple[Rule, ...]) -> tuple[str, ...]:
    """Raw columns that must not be NULL for a row to be kept."""
    return tuple(dict.fromkeys(name for rule in rules for name in rule.needs))



def violations(rules: tuple[Rule, ...] = ORDER_RULES) -> list[Column]:
    """One count per rule of the rows it would drop (NULL over no rows)."""
    return [F.sum(F.when(rule.kept(), 0).otherwise(1)).alias(rule.name) for rule in rules]


def passes_all(rules: tuple[Rule, ...] = ORDER_RULES) -> Column:
    """True where every rule keeps the row."""
    condition = F.lit(True)
    for rule in rules:
        condition = condition & rule.kept()
    return condition
