"""Team-week rows derived from a sales star schema.

A nation plays a team, a ship month a week and a ship year a season. Every aggregate is a sum of
whole numbers, so the rows are the same whatever order a shuffle delivers them in.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sideline import config, schemas

SEASON_OFFSET = 10
LEAGUE_SIZE = 25
RED_ZONE_QUANTITY = 45


_schemas: dict[tuple[str, str], StructType] = {}


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A parquet table; its footer is read once per application, not once per query."""
    path = f"{folder}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    if key not in _schemas:
        _schemas[key] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[key]).parquet(path)


# sum column -> expression over one line
_LINE_SUMS = {
    "n": "count(1)",
    "quantity": "sum(bigint(l_quantity))",
    "size": "sum(p_size)",
    "discount": "sum(bigint(round(l_discount * 100D)))",
    "tax": "sum(bigint(round(l_tax * 100D)))",
    "r": "count_if(l_returnflag = 'R')",
    "a": "count_if(l_returnflag = 'A')",
    "x": "count_if(l_returnflag = 'N')",
    "f": "count_if(l_linestatus = 'F')",
    "u": "count_if(urgent)",
    "z": f"count_if(l_quantity >= {RED_ZONE_QUANTITY})",
    "zr": f"count_if(l_quantity >= {RED_ZONE_QUANTITY} AND l_returnflag = 'R')",
}


def _shipped(season: int | None, last_week: int | None) -> str:
    """The slice as a range of ship dates, which the scan can compare with its statistics."""
    if season is None:
        return "true"
    year, month = season - SEASON_OFFSET, last_week if last_week and last_week < 12 else 12
    until = f"{year + 1}-01-01" if month == 12 else f"{year}-{month + 1:02d}-01"
    return f"l_shipdate >= DATE '{year}-01-01' AND l_shipdate < DATE '{until}'"


def weekly_sums(spark: SparkSession, folder: str, season: int | None = None, last_week: int | None = None) -> DataFrame:
    """Whole-number sums per (team, season, week), of one season up to a week if asked.

    Lines are summed per supplier and month before the supplier join, so that a supplier table too
    large to broadcast is joined to sums and not to lines. No side is forced to broadcast: the
    planner broadcasts a side only when its measured size allows it.
    """
    line = read_table(spark, folder, "lineitem").where(_shipped(season, last_week)).selectExpr(
        "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus",
        f"year(l_shipdate) + {SEASON_OFFSET} AS season", "month(l_shipdate) AS week",
    )
    part = read_table(spark, folder, "part").selectExpr("p_partkey AS l_partkey", "p_size")
    orders = read_table(spark, folder, "orders").selectExpr(
        "o_orderkey AS l_orderkey", "o_orderpriority IN ('1-URGENT', '2-HIGH') AS urgent"
    )
    supplier = read_table(spark, folder, "supplier").selectExpr(
        "s_suppkey AS l_suppkey", "s_nationkey AS n_nationkey"
    )
    nation = read_table(spark, folder, "nation").selectExpr("n_nationkey", "n_name AS team")

    per_supplier = (
        line.join(part, "l_partkey")
        .join(orders, "l_orderkey")
        .groupBy("l_suppkey", "season", "week")
        .agg(*[F.expr(f"{sql} AS {name}") for name, sql in _LINE_SUMS.items()])
    )
    return (
        per_supplier.join(supplier, "l_suppkey")
        .join(nation, "n_nationkey")
        .groupBy("team", "n_nationkey", "season", "week")
        .agg(*[F.expr(f"sum({name}) AS {name}") for name in _LINE_SUMS])
    )


_SHARES = {
    "q": "double(quantity) / n",
    "s": "double(size) / n",
    "d": "double(discount) / (n * 100)",
    "t": "double(tax) / (n * 100)",
    "rs": "double(r) / n",
    "ax": "double(a) / n",
    "xs": "double(x) / n",
    "fs": "double(f) / n",
    "us": "double(u) / n",
}
_PLAYS = "(45D + 35D * q / 50D)"
_PASS = "(0.35D + 0.3D * fs)"
_EPA = "(-0.3D + 7D * d)"
_POINTS = "(1D + 2.5D * us)"
_DRIVES = "double(8 + n % 5)"
_METRICS = {
    "pointsFor": f"{_POINTS} * {_DRIVES}",
    "pointsAgainst": "10D + 20D * ax",
    "offensivePlays": _PLAYS,
    "neutralPlays": f"0.7D * {_PLAYS}",
    "secondsPerPlay": "22D + 12D * s / 50D",
    "passRate": _PASS,
    "neutralPassRate": "0.35D + 0.35D * least(1D, 1.5D * rs)",
    "rushRate": f"1D - {_PASS}",
    "epaPerPlay": _EPA,
    "passEpaPerPlay": f"{_EPA} + t - 0.04D",
    "rushEpaPerPlay": f"{_EPA} - t + 0.04D",
    "successRate": "0.3D + 0.3D * fs",
    "explosivePlayRate": "0.04D + 0.16D * ax",
    "drives": _DRIVES,
    "pointsPerDrive": _POINTS,
    "redZoneTrips": "double(z)",
    "redZoneTdRate": "if(z > 0, double(zr) / z, NULL)",
    "sacksAllowed": "double(n % 7)",
    "pressureRateAllowed": "0.12D + 0.33D * xs",
    "turnovers": "double(z % 5)",
    "fantasyPointsForQB": "8D + 22D * us",
    "fantasyPointsForRB": "8D + 27D * fs",
    "fantasyPointsForWR": "12D + 33D * rs",
    "fantasyPointsForTE": "2D + 18D * ax",
    "fantasyPointsAllowedQB": "8D + 22D * (1D - us)",
    "fantasyPointsAllowedRB": "8D + 30D * (1D - fs)",
    "fantasyPointsAllowedWR": "12D + 38D * (1D - rs)",
    "fantasyPointsAllowedTE": "3D + 21D * (1D - ax)",
    "qbPassAllowed": "15D * us",
    "qbRushAllowed": "5D * fs",
    "rbRushAllowed": "12D * ax",
    "rbRecAllowed": "double(NULL)",
    "wrSlotAllowed": "if(n % 3 = 0, NULL, 22D * rs)",
    "wrWideAllowed": "if(n % 3 = 0, NULL, 22D * ax)",
    "teInlineAllowed": "8D * fs",
    "teSplitAllowed": "if(n % 4 = 0, NULL, 8D * (1D - fs))",
}


def candidate_weeks(spark: SparkSession, folder: str, season: int | None = None, last_week: int | None = None) -> DataFrame:
    """Team-week rows in which a week without red-zone trips has a null redZoneTdRate."""
    slot = f"(n_nationkey + week) % {LEAGUE_SIZE}"
    return (
        weekly_sums(spark, folder, season, last_week)
        .selectExpr("team", "season", "week", "n_nationkey", "n", "z", "zr",
                    *[f"{sql} AS `{name}`" for name, sql in _SHARES.items()])
        .selectExpr(
            "season", "week", "team",
            f"concat('NATION_', if({slot} = n_nationkey, ({slot} + 1) % {LEAGUE_SIZE}, {slot}))"
            " AS opponent",
            *[f"{sql} AS {name}" for name, sql in _METRICS.items()],
        )
    )


def team_weeks(spark: SparkSession, folder: str, season: int | None = None, last_week: int | None = None) -> DataFrame:
    """Canonical rows: complete, so they can be scored."""
    rate = F.expr("coalesce(redZoneTdRate, 0.5D)")
    return candidate_weeks(spark, folder, season, last_week).withColumn("redZoneTdRate", rate)


def governed_weeks(spark: SparkSession, folder: str, season: int | None = None) -> DataFrame:
    """Null-preserving rows without fantasy fields and with pressure withheld."""
    kept = [m for m in schemas.GOVERNED_METRICS if m != config.PRESSURE_FIELD]
    return candidate_weeks(spark, folder, season).selectExpr(
        *schemas.KEYS, *kept, f"double(NULL) AS {config.PRESSURE_FIELD}"
    )
