"""Numeric expressions with the rounding and null rules of the contracts.

Every function takes and returns the text of a Spark SQL expression, for ``selectExpr`` and
``F.expr``. The formulas have hundreds of operators; as text they reach the parser in one call.
"""

from functools import reduce

MAX_DOUBLE = "1.7976931348623157E308D"


def lit(value: float) -> str:
    """A number as a double literal; a bare 0.2 would be a decimal."""
    text = f"{float(value)!r}D"
    return f"({text})" if text.startswith("-") else text


def is_finite(x: str) -> str:
    """True for a number that is neither null, NaN nor infinite (Spark sorts NaN above all)."""
    return f"coalesce(abs({x}) <= {MAX_DOUBLE}, false)"


def is_integer(x: str) -> str:
    """True for a finite number without a fractional part."""
    return f"coalesce(abs({x}) <= {MAX_DOUBLE} AND floor({x}) = {x}, false)"


def clamp(x: str, low: float = 0.0, high: float = 100.0) -> str:
    """Limit to [low, high]; a non-finite value becomes ``low``."""
    return (
        f"CASE WHEN abs({x}) <= {MAX_DOUBLE} "
        f"THEN least({lit(high)}, greatest({lit(low)}, {x})) ELSE {lit(low)} END"
    )


def safe_number(x: str, fallback: float = 0.0) -> str:
    return f"CASE WHEN abs({x}) <= {MAX_DOUBLE} THEN {x} ELSE {lit(fallback)} END"


def normalize(x: str, low: float, high: float, inverse: bool = False) -> str:
    """Min-max scale to 0-100. A non-finite value is 0, also when the scale is inverse."""
    if low == high:
        return lit(0)
    ratio = f"least(100D, greatest(0D, ({x} - {lit(low)}) / {lit(high - low)} * 100D))"
    ratio = f"100D - {ratio}" if inverse else ratio
    return f"CASE WHEN abs({x}) <= {MAX_DOUBLE} THEN {ratio} ELSE 0D END"


def weighted_average(components: dict[str, str], weights: dict[str, float]) -> str:
    """Sum of value * weight over the sum of the weights, both folded in declared order.

    A component without a value counts as 0. The components are finite by construction
    (``normalize``, ``clamp``); wrap any other input in ``safe_number``.
    """
    total = reduce(lambda acc, w: acc + w, weights.values(), 0.0)
    if total <= 0:
        return lit(0)
    terms = [f"{components[n]} * {lit(w)}" for n, w in weights.items() if n in components]
    folded = " + ".join(["0D", *terms])
    return f"least(100D, greatest(0D, ({folded}) / {lit(total)}))"


def exact_round(x: str, digits: int) -> str:
    """Round half away from zero on the exact binary value of a double.

    Spark's ``round`` works on the shortest decimal text instead (1.005 to two digits is 1.01
    there, and 1.0 here: the double is a little below 1.005). Splitting the value into two halves
    (2^27 + 1) makes both products exact, so the comparison with the tie is exact too. ``x`` should
    be a plain column: it is used several times. Adding 0 turns a negative zero into a plain one.
    """
    m, a = f"1E{digits}D", f"abs({x})"
    high = f"({a} * 134217729D - ({a} * 134217729D - {a}))"
    whole = f"({a} * {m} - {a} * {m} % 1D)"
    up = f"({high} * {m} - {whole} - 0.5D) + ({a} - {high}) * {m} >= 0D"
    return f"({whole} + CAST({up} AS DOUBLE)) / {m} * signum({x}) + 0D"


def fixed_text(x: str, digits: int) -> str:
    """Fixed-point text of a double, rounded as in ``exact_round`` and keeping the sign of -0.00."""
    size = exact_round(f"abs({x})", digits)
    return f"concat(CASE WHEN {x} < 0 THEN '-' ELSE '' END, format_string('%.{digits}f', {size}))"


def number_text(x: str) -> str:
    """Shortest text of a number: 6 for 6.0, 3.5 for 3.5."""
    return f"CASE WHEN floor({x}) = {x} THEN string(bigint({x})) ELSE string({x}) END"


def rounded(names, digits: int, prefix: str = "") -> list[str]:
    """Select items that round columns under their own names."""
    return [f"{exact_round(prefix + n, digits)} AS {n}" for n in names]
