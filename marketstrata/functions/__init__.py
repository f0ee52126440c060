"""Small SQL expressions shared by the operators.

They are text: a whole aggregate or row of a report is handed to Spark in one call, instead of
one call per operator and literal.
"""

from marketstrata.functions.exact import MONEY, PERCENT, PRICE, exact_avg, exact_sum, percent_of, percentage
from marketstrata.functions.parsing import iso_instant, number
from marketstrata.functions.text import quoted, text_literal

__all__ = [
    "MONEY",
    "PERCENT",
    "PRICE",
    "exact_avg",
    "exact_sum",
    "iso_instant",
    "number",
    "percent_of",
    "percentage",
    "quoted",
    "text_literal",
]
