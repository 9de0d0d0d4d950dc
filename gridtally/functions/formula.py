"""Formulas of virtual meters: compiled once per definition, evaluated natively per row.

A formula is text whose parts are separated by spaces: all digits is the id of an item,
``d`` and a number is a constant, anything else is operators and parentheses. ``-`` (or
``#``) is the binary minus; there is no unary sign. The compiled form is an array in
postfix order, so evaluating needs no Python: a fold over the array with a stack.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtally.functions import numbers

PRIORITY = {"+": 1, "#": 1, "*": 2, "/": 2}
REFERENCE = "@"
_LEXEME = re.compile(r"[-+*/#()]|[^-+*/#()]+")
_NUMBER = re.compile(r"(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][0-9]+)?")


def _lexemes(formula: str) -> list[str]:
    """Operators, parentheses, ``@id`` references and constant texts, left to right."""
    pieces: list[str] = []
    literal = ""
    for part in formula.replace("-", "#").split(" "):
        part = part.strip()
        if part.isascii() and part.isdigit():
            pieces += [*_LEXEME.findall(literal), REFERENCE + str(int(part))]
            literal = ""
        else:
            literal += part.replace("d", "") if part.startswith("d") else part
    return pieces + _LEXEME.findall(literal)


def to_postfix(formula: str | None) -> list[str] | None:
    """Postfix symbols of a formula, or None when it is malformed."""
    if formula is None:
        return None
    output: list[str] = []
    waiting: list[str] = []
    want_operand = True
    for lexeme in _lexemes(formula):
        if lexeme == "(":
            if not want_operand:
                return None
            waiting.append(lexeme)
        elif lexeme == ")":
            if want_operand:
                return None
            while waiting and waiting[-1] != "(":
                output.append(waiting.pop())
            if not waiting:
                return None
            waiting.pop()
        elif lexeme in PRIORITY:
            if want_operand:
                return None
            while waiting and PRIORITY.get(waiting[-1], 0) >= PRIORITY[lexeme]:
                output.append(waiting.pop())
            waiting.append(lexeme)
            want_operand = True
        else:
            if not want_operand:
                return None
            if not lexeme.startswith(REFERENCE):
                if not _NUMBER.fullmatch(lexeme):
                    return None
                lexeme = repr(float(lexeme))
            output.append(lexeme)
            want_operand = False
    if want_operand or "(" in waiting:
        return None
    return output + waiting[::-1]


@F.pandas_udf(T.ArrayType(T.StringType()))
def compile_formula(formulas: pd.Series) -> pd.Series:
    """Postfix form of each formula; meant for the small table of definitions."""
    return formulas.map(to_postfix)


def referenced_items(postfix: Column) -> Column:
    """Distinct item ids a compiled formula reads; one that is no 64-bit number names no item."""
    refs = F.filter(postfix, lambda s: s.startswith(REFERENCE))
    return F.filter(F.array_distinct(F.transform(refs, _item_id)), lambda i: i.isNotNull())


def _item_id(symbol: Column) -> Column:
    return F.substring(symbol, len(REFERENCE) + 1, 2147483647).try_cast("long")


def evaluate(postfix: Column, inputs: Column) -> Column:
    """Value of a compiled formula over a map of item id to double.

    An item missing from the map counts as 0. A division by zero makes the whole
    result 0, and so does a formula that did not compile.
    """

    def step(stack: Column, symbol: Column) -> Column:
        rest = F.slice(stack, F.lit(1), F.greatest(F.size(stack) - 2, F.lit(0)))
        a = F.get(stack, F.size(stack) - 2)
        b = F.get(stack, F.size(stack) - 1)

        def push(base: Column, x: Column) -> Column:
            return F.concat(base, F.array(x.cast("double")))

        reference = _item_id(symbol)
        return (
            F.when(symbol == "+", push(rest, a + b))
            .when(symbol == "#", push(rest, a - b))
            .when(symbol == "*", push(rest, a * b))
            .when(symbol == "/", push(rest, F.try_divide(a, b)))
            .when(
                symbol.startswith(REFERENCE),
                push(stack, F.coalesce(F.try_element_at(inputs, reference), F.lit(0.0))),
            )
            .otherwise(push(stack, symbol.try_cast("double")))
        )

    empty = F.array().cast("array<double>")
    result = F.aggregate(postfix, empty, step, lambda stack: F.get(stack, F.lit(0)))
    return F.coalesce(result, F.lit(0.0))


def result(postfix: Column, inputs: Column, places: int = 2, mode: str = "half_up") -> Column:
    """The value of a formula as an exact amount with some places, cut off in any rounding mode."""
    return numbers.rounded(evaluate(postfix, inputs), places, mode)
