"""Row quality rules as columns.

A rule is (condition of a bad row, message), both SQL expressions. All rules of a table are checked
in one projection; ``violations`` lists what is wrong and ``require_clean`` stops at the first.
"""

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from sideline import config, schemas
from sideline.functions.numeric import MAX_DOUBLE, is_finite, is_integer, lit, number_text
from sideline.functions.text import locale_order


class QualityError(ValueError):
    """Data that a strict job refuses."""


class Rule(NamedTuple):
    bad: str
    message: str


def text(message: str) -> str:
    """A constant message as a SQL string."""
    return "'" + message.replace("\\", "\\\\").replace("'", "\\'") + "'"


def shown(x: str) -> str:
    """A value inside a message."""
    return f"CASE WHEN {x} IS NULL THEN 'null' ELSE {number_text(x)} END"


def violations(df: DataFrame, rules: Sequence[Rule], locate: Sequence[str]) -> DataFrame:
    """One row per broken rule: the locating columns, the rule number and the message."""
    found = ", ".join(
        f"CASE WHEN {r.bad} THEN named_struct('rule', {i}, 'message', {r.message}) END"
        for i, r in enumerate(rules)
    )
    # the outer form: the planner copies the argument of a plain inline into a filter below it
    return df.selectExpr(*locate, f"inline_outer(array_compact(array({found})))").where(
        "rule IS NOT NULL"
    )


def first_violations(found: DataFrame, locate: Sequence[str]) -> DataFrame:
    """Only the first broken rule of each row, as a fail-fast check would report it."""
    return found.groupBy(*locate).agg(
        F.min("rule").alias("rule"), F.min_by("message", "rule").alias("message")
    )


def require_clean(found: DataFrame, order: Sequence[str] = ()) -> None:
    """Raise with the first message in row order."""
    keys = [locale_order(F.col(c)) if c == "sourceFile" else F.col(c) for c in order]
    first = found.orderBy(*keys, "rule").limit(1).collect()
    if first:
        raise QualityError(first[0]["message"])


class Watch:
    """Counts rows that break a rule while a frame is being written, so that the check costs no pass of its own.

    ``watch`` marks the frame; filters that follow do not move below the mark, so rows they drop count
    too. Once the frame has been written, ``require_clean`` looks for the messages only if a row was counted,
    or if the plan has lost the count.
    """

    def __init__(self, rules: Sequence[Rule], locate: Sequence[str]):
        self.rules, self.locate, self.seen = rules, locate, Observation()

    def watch(self, df: DataFrame) -> DataFrame:
        bad = " OR ".join(f"coalesce({r.bad}, false)" for r in self.rules)
        return df.observe(self.seen, F.count_if(F.expr(bad)).alias("bad"))

    def clean(self) -> bool:
        return self.seen.get.get("bad", 1) == 0

    def require_clean(self, df: DataFrame) -> None:
        """Raise with the first message of the rows, which may be read again for it."""
        if not self.clean():
            require_clean(violations(df, self.rules, self.locate), self.locate)


RATE_FIELDS = ("passRate", "neutralPassRate", "rushRate", "successRate", "explosivePlayRate",
               "redZoneTdRate", "pressureRateAllowed")
COUNT_FIELDS = ("pointsFor", "pointsAgainst", "offensivePlays", "neutralPlays", "secondsPerPlay",
                "drives", "pointsPerDrive", "redZoneTrips", "sacksAllowed", "turnovers",
                *schemas.FANTASY_FIELDS)


def canonical_rules() -> list[Rule]:
    """Rules of canonical rows. The three EPA fields only have to be there."""
    rules = [Rule(f"{f} IS NULL", text(f"Missing required field: {f}")) for f in schemas.REQUIRED]
    rules += [
        Rule(f"season IS NOT NULL AND NOT ({is_integer('season')} AND season >= 1999)",
             f"concat('Invalid season: ', {shown('season')})"),
        Rule(f"week IS NOT NULL AND NOT ({is_integer('week')} AND week BETWEEN 1 AND 22)",
             f"concat('Invalid week: ', {shown('week')})"),
        Rule("trim(team) = '' OR trim(opponent) = ''", text("Team and opponent must be non-empty strings.")),
    ]
    rules += [
        Rule(f"NOT coalesce({f} BETWEEN 0 AND 1, true)",
             f"concat('Invalid rate field {f}: ', {shown(f)})")
        for f in RATE_FIELDS
    ]
    rules += [
        Rule(f"NOT coalesce({f} BETWEEN 0 AND {MAX_DOUBLE}, true)",
             f"concat('Invalid non-negative field {f}: ', {shown(f)})")
        for f in COUNT_FIELDS
    ]
    rules.append(
        Rule(f"abs(passRate + rushRate - 1) > {lit(0.08)}",
             f"concat('passRate + rushRate must be near 1.0. Received ', {shown('(passRate + rushRate)')})")
    )
    rules += [
        Rule(f"NOT coalesce({f} BETWEEN 0 AND {MAX_DOUBLE}, true)",
             f"concat('Invalid optional split field {f}: ', {shown(f)})")
        for f in schemas.SPLITS
    ]
    return rules


def _blank(column: str) -> str:
    return f"coalesce(trim({column}), '') = ''"


def _keyed(kind: str, message: str) -> str:
    return f"concat('Invalid {kind} row at index ', rowIndex, ': {message}')"


def envelope_rules() -> list[Rule]:
    """Rules of envelope rows: every metric a finite number, splits finite or absent."""
    kind = config.ARTIFACT_RAW
    rules = [Rule("NOT isObject", _keyed(kind, "expected object."))]
    rules += [Rule(f"isObject AND {_blank(raw)}", _keyed(kind, f"{raw} must be a non-empty string."))
              for raw in ("teamCode", "opponentCode")]
    rules += [Rule(f"isObject AND NOT {is_finite(f)}", _keyed(kind, f"{f} must be a finite number."))
              for f in ("season", "week", *schemas.METRICS)]
    rules += [Rule(f"raw['{f}'] IS NOT NULL AND NOT {is_finite(f)}",
                   f"concat('Invalid optional split field value: ', raw['{f}'])")
              for f in schemas.SPLITS]
    return rules


def raw_array_rules() -> list[Rule]:
    """Rules of array files: the key has to be there, its value may be null."""
    at = "concat('Invalid raw row in ', sourceFile, ' at index ', rowIndex, ': {}')"
    rules = [Rule("NOT isObject", at.format("expected object."))]
    rules += [Rule(f"isObject AND NOT map_contains_key(raw, '{key}')",
                   at.format(f"missing required key {key}."))
              for key in schemas.RAW_REQUIRED]
    return rules


def _identity_rules(kind: str) -> list[Rule]:
    rules = [Rule(f"isObject AND NOT {is_integer(f)}", _keyed(kind, f"{f} must be an integer."))
             for f in ("season", "week")]
    rules += [Rule(f"isObject AND {_blank(raw)}", _keyed(kind, f"{raw} must be a non-empty string."))
              for raw in ("teamCode", "opponentCode")]
    return rules


def _not_finite_or_null(field: str) -> str:
    return f"raw['{field}'] IS NOT NULL AND NOT {is_finite(field)}"


def candidate_rules() -> list[Rule]:
    """Rules of candidate rows: 28 fields present, each a finite number or null."""
    kind = f"{config.ARTIFACT_RAW} candidate"
    rules = [Rule("NOT isObject", _keyed(kind, "expected object.")), *_identity_rules(kind)]
    for f in schemas.METRICS:
        rules.append(Rule(f"isObject AND NOT map_contains_key(raw, '{f}')",
                          _keyed(kind, f"missing required field {f}.")))
        rules.append(Rule(_not_finite_or_null(f), _keyed(kind, f"{f} must be a finite number or null.")))
    return rules


def governed_rules() -> list[Rule]:
    """Rules of governed rows: fantasy fields null, 19 fields finite or null, pressure present and null."""
    kind = f"governed {config.ARTIFACT_RAW}"
    rules = [Rule("NOT isObject", _keyed(kind, "expected object."))]
    rules += [Rule(f"raw['{f}'] IS NOT NULL", _keyed(kind, f"fantasy split field {f} must be null when "
                                                     "present and is stripped from the output."))
              for f in schemas.FANTASY_FIELDS]
    rules += _identity_rules(kind)
    rules += [Rule(f"isObject AND (NOT map_contains_key(raw, '{f}') OR {_not_finite_or_null(f)})",
                   _keyed(kind, f"{f} must be a finite number or null."))
              for f in schemas.GOVERNED_METRICS if f != config.PRESSURE_FIELD]
    p = config.PRESSURE_FIELD
    rules.append(Rule(f"isObject AND (NOT map_contains_key(raw, '{p}') OR raw['{p}'] IS NOT NULL)",
                      _keyed(kind, f"{p} must be null/deferred, never inferred or zero-filled.")))
    return rules
