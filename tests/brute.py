"""Plain Python formulas that the Spark results are checked against."""

from decimal import ROUND_HALF_UP, Decimal

from sideline import config, schemas


def half_up(x: float, digits: int) -> float:
    """Exact rounding of the binary value, half away from zero."""
    return float(Decimal(x).quantize(Decimal(1).scaleb(-digits), rounding=ROUND_HALF_UP)) + 0.0


def norm(v, low, high, inverse=False):
    ratio = min(100.0, max(0.0, (v - low) / (high - low) * 100))
    return 100 - ratio if inverse else ratio


def scores(r: dict) -> dict:
    b = config.BOUNDS

    def comp(name):
        if name == "redZoneSustainability":
            return min(100.0, max(0.0, 100 - abs(r["redZoneTdRate"] - 0.62) * 200))
        if name == "splitAllowanceBoost":
            present = [r[s] for s in schemas.SPLITS if r[s] is not None]
            return norm(sum(present) / len(present) if present else 0.0, *b["splitAllowance"])
        field, inverse = config.COMPONENT_INPUTS.get(name, (name, False))
        return norm(r[field], *b[field], inverse)

    def average(weights):
        acc = total = 0.0
        for name, w in weights.items():
            acc, total = acc + comp(name) * w, total + w
        return min(100.0, max(0.0, acc / total))

    out = {
        "teamPowerScore": average(config.TEAM_POWER_WEIGHTS),
        "fantasyEnvironmentScore": average(config.FANTASY_WEIGHTS),
        "matchupEnvironmentScore": average(config.MATCHUP_WEIGHTS),
        "stabilityScore": average(config.STABILITY_WEIGHTS),
    }
    out["volatilityScore"] = min(100.0, max(0.0, (100 - out["stabilityScore"]) * 0.7
                                 + norm(r["explosivePlayRate"], *b["explosivePlayRate"]) * 0.2
                                 + norm(r["redZoneTdRate"], *b["redZoneTdRate"]) * 0.1))
    return out
