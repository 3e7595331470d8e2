"""SQL text of the rule-based labels, generated from their limits, for the oracles."""

from __future__ import annotations

# The limits of each rule as (at least, below) by statistic, first match first.
POSITIONS = (
    ("Point Guard", {"ast": (5, None), "reb": (None, 8), "pts": (None, 25)}),
    ("Shooting Guard", {"pts": (18, None), "ast": (None, 5), "reb": (None, 7)}),
    ("Small Forward", {"pts": (12, None), "reb": (5, 10), "ast": (None, 6)}),
    ("Power Forward", {"reb": (8, None), "pts": (10, None), "ast": (None, 5)}),
    ("Center", {"reb": (10, None), "pts": (8, None), "ast": (None, 4)}),
    ("Combo Forward/Guard", {"ast": (6, None), "reb": (6, None)}),
)
POSITION_ELSE = "Utility Player"
ZONES = {"Backcourt": ("Point Guard", "Shooting Guard"), "Frontcourt": ("Small Forward", "Power Forward"), "Big Man": ("Center",)}
ZONE_ELSE = "Utility"
# A tier needs one of its sets of least values.
TIERS = (
    ("Elite", ({"per": 25, "pts": 20}, {"per": 30})),
    ("All-Star", ({"per": 20, "pts": 15}, {"per": 25, "pts": 12})),
    ("Starter", ({"per": 15, "pts": 10}, {"per": 18, "min": 20})),
    ("Rotation Player", ({"per": 10, "min": 10},)),
)
TIER_ELSE = "Bench Player"

MART_NAMES = {"pts": "points_per_game", "reb": "rebounds_per_game", "ast": "assists_per_game",
              "min": "minutes_per_game", "per": "player_efficiency_rating"}


def _case(branches, otherwise: str) -> str:
    return "CASE " + " ".join(f"WHEN {test} THEN '{label}'" for label, test in branches) + f" ELSE '{otherwise}' END"


def position_case(names: dict[str, str] = MART_NAMES) -> str:
    def test(limits):
        low = [f"{names[k]} >= {a}E0" for k, (a, _) in limits.items() if a is not None]
        return " AND ".join(low + [f"{names[k]} < {b}E0" for k, (_, b) in limits.items() if b is not None])

    return _case([(label, test(limits)) for label, limits in POSITIONS], POSITION_ELSE)


def zone_case(position: str) -> str:
    tests = [(zone, f"{position} IN ({', '.join(repr(p) for p in names)})") for zone, names in ZONES.items()]
    return _case(tests, ZONE_ELSE)


def tier_case(names: dict[str, str] = MART_NAMES) -> str:
    def test(sets):
        return " OR ".join("(" + " AND ".join(f"{names[k]} >= {v}E0" for k, v in one.items()) + ")" for one in sets)

    return _case([(label, test(sets)) for label, sets in TIERS], TIER_ELSE)
