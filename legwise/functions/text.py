"""Number-to-text in the shortest round-trip form used by Python's ``repr``
(and DuckDB): ``0.0005``, ``1e-05``, ``10000000.0``, ``1e+16``, ``inf``, ``nan``.

Spark's own cast prints the digits of the running Java's ``Double.toString``,
which before Java 19 are now and then longer than the shortest form. So the text
is looked for: 15, 16 and 17 significant digits are printed in turn, and the
first that parses back to the same double is taken. The text then depends on the
double alone. (Doubles below 2.3e-308 have fewer digits and may be printed longer.)
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _substr(s: Column, pos: Column, length: Column) -> Column:
    return F.call_function("substring", s, pos, length)


def _bound(value: Column, use) -> Column:
    """``use(value)``, with the value computed once for all its uses."""
    return F.element_at(F.transform(F.array(value), use), 1)


def shortest_scientific(x: Column) -> Column:
    """``d.ddde+xx`` with the fewest digits (15 to 17) that give back ``x``."""
    def shown(n: int) -> Column:
        return F.format_string(f"%.{n - 1}e", x)

    def first_of(s: Column, *rest: int) -> Column:
        # a lambda argument, so that a text is printed once for its test and its use
        return _bound(s, lambda v: F.when(v.try_cast("double") == x, v).otherwise(
            first_of(shown(rest[0]), *rest[1:]) if len(rest) > 1 else shown(rest[0])))
    return first_of(shown(15), 16, 17)


def py_number_text(x) -> Column:
    """Text of a double as Python ``repr`` prints it; null stays null."""
    x = (F.col(x) if isinstance(x, str) else x).cast("double")
    # lambda arguments, so that the search and its parts are not repeated for each of their uses
    return _bound(F.struct(x.alias("x"), shortest_scientific(x).alias("s")), lambda v: _bound(
        F.struct(v["x"].alias("x"), v["s"].alias("s"),
                 F.rtrim(F.translate(F.substring_index(v["s"], "e", 1), "-.", ""), F.lit("0")).alias("digits"),
                 F.substring_index(v["s"], "e", -1).try_cast("int").alias("e")),
        lambda p: _python_form(p["x"], p["s"], p["digits"], p["e"])))


def _python_form(x: Column, s: Column, digits: Column, e: Column) -> Column:
    sign = F.when(s.startswith("-"), F.lit("-")).otherwise(F.when(x < 0, F.lit("-")).otherwise(F.lit("")))
    n, one = F.length(digits), F.lit(1)
    below_one = F.concat(F.lit("0."), F.repeat(F.lit("0"), -e - 1), digits)
    from_one = F.concat(F.rpad(_substr(digits, one, e + 1), e + 1, "0"), F.lit("."),
                        F.coalesce(F.nullif(_substr(digits, e + 2, n), F.lit("")), F.lit("0")))
    mantissa = F.concat(_substr(digits, one, one),
                        F.when(n > 1, F.concat(F.lit("."), _substr(digits, F.lit(2), n))).otherwise(F.lit("")))
    power = F.concat(F.when(e < 0, F.lit("e-")).otherwise(F.lit("e+")),
                     F.when(F.abs(e) < 10, F.lit("0")).otherwise(F.lit("")), F.abs(e).cast("string"))
    text = F.when((e < -4) | (e >= 16), F.concat(mantissa, power)).when(e < 0, below_one).otherwise(from_one)
    return (F.when(F.isnan(x), F.lit("nan"))
            .when(x == float("inf"), F.lit("inf"))
            .when(x == float("-inf"), F.lit("-inf"))
            .when(x == 0, F.concat(sign, F.lit("0.0")))
            .when(x.isNotNull(), F.concat(sign, text)))
