"""Brazilian tax numbers, by digit arithmetic on columns."""

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weights of the two check digits, for persons (11 digits) and
# companies (14 digits).
PERSON_WEIGHTS = ([10, 9, 8, 7, 6, 5, 4, 3, 2], [11, 10, 9, 8, 7, 6, 5, 4, 3, 2])
COMPANY_WEIGHTS = (
    [5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2],
    [6, 5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2],
)

# Digits of a state registration, by state.
STATE_LENGTHS = {
    "AC": [13], "AL": [9], "AM": [9], "AP": [9], "BA": [8, 9], "CE": [9], "DF": [13],
    "ES": [9], "GO": [9], "MA": [9], "MG": [13], "MS": [9], "MT": [11], "PA": [9],
    "PB": [9], "PE": [9, 14], "PI": [9], "PR": [10], "RJ": [8], "RN": [9, 10],
    "RO": [14], "RR": [9], "RS": [10], "SC": [9], "SE": [9], "SP": [12], "TO": [9, 11],
}


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _digit(number: Column, place: int) -> Column:
    return F.ascii(F.substr(number, F.lit(place), F.lit(1))) - 48


def _check_digit(number: Column, weights: list[int]) -> Column:
    """11 minus the weighted sum's remainder, where 10 and 11 give 0."""
    total = reduce(add, [_digit(number, i + 1) * w for i, w in enumerate(weights)])
    rest = F.pmod(total, F.lit(11))
    return F.when(rest < 2, 0).otherwise(11 - rest)


def _right_digits(number: Column, weights) -> Column:
    first, second = weights
    return (_digit(number, len(first) + 1) == _check_digit(number, first)) & (
        _digit(number, len(second) + 1) == _check_digit(number, second))


def tax_id_ok(value: Column) -> Column:
    number = digits(value)
    return F.when(F.length(number) == 11, _right_digits(number, PERSON_WEIGHTS)).when(
        F.length(number) == 14, _right_digits(number, COMPANY_WEIGHTS)).otherwise(False)


def state_tax_id_length_ok(value: Column, state: Column) -> Column:
    """Only the number of digits is tested; states differ in their check digits."""
    allowed = F.create_map(*[
        part for name, lengths in STATE_LENGTHS.items()
        for part in (F.lit(name), F.array(*[F.lit(n) for n in lengths]))])
    return F.coalesce(F.array_contains(F.element_at(allowed, F.upper(state)), F.length(digits(value))), F.lit(False))
