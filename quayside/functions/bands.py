"""Banding of metrics into named levels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: band edges and names --------------------------------------
ARCHETYPES = [  # (largest mean dwell in days, label, colour)
    (1, "Fast Movers", "#1D9E75"),
    (3, "Efficient Operators", "#378ADD"),
    (7, "Standard Dwellers", "#BA7517"),
    (14, "Extended Stay", "#D85A30"),
    (30, "Overstayers", "#E24B4A"),
    (999, "Chronic Blockers", "#791F1F"),
]
RECOMMENDATIONS = {
    "Fast Movers": "Optimize gate scheduling to reduce wait times. Pre-position near berth for transhipment efficiency.",
    "Efficient Operators": "Maintain current processes. Consider loyalty incentives for shipping lines with consistently low dwell.",
    "Standard Dwellers": "Monitor for drift toward Extended Stay. Send automated pickup reminders at day 3-4.",
    "Extended Stay": "Investigate root causes (customs holds, documentation gaps). Engage with freight forwarders for improved clearance timelines.",
    "Overstayers": "Escalate demurrage notices. Relocate to overflow areas to free prime yard space. Engage shipping lines directly for container clearance.",
    "Chronic Blockers": "Initiate formal clearance procedures. Assess legal options for abandoned cargo. Relocate to peripheral blocks immediately to free operational capacity.",
}
OTHER_ADVICE = "Review segment characteristics and develop targeted strategy."
FORTY_FOOT_NOTE = " Note: these are predominantly 40ft (2-TEU) containers — each one blocks double the yard capacity of a 20ft unit."
PORT_BENCHMARKS = [  # (port, mean import dwell in days, median or none)
    ("LA/Long Beach (truck)", 2.73, None),
    ("Singapore", 4.2, 3.1),
    ("Hamburg", 3.7, None),
    ("LA/Long Beach (rail)", 4.98, None),
    ("Colombo", 7.8, 5.4),
    ("Shanghai", 6.5, None),
    ("Rotterdam", 9.3, 7.8),
    ("Antwerp", 11.4, 8.9),
]
RESHUFFLE_BANDS = [  # (stack height below, low and high reshuffle probability)
    (2.5, 0.05, 0.10),
    (3.5, 0.15, 0.20),
    (4.5, 0.25, 0.35),
    (float("inf"), 0.40, 0.55),
]
RESHUFFLE_COST_USD = (5.0, 15.0)
SILHOUETTE_NAMES = [  # (above, name)
    (0.70, "Strong structure"), (0.50, "Reasonable structure"), (0.25, "Weak but usable"),
    (None, "No meaningful structure"),
]
MAPE_NAMES = [(10, "Excellent"), (20, "Good"), (30, "Acceptable"), (None, "Limited")]  # (below, name)
UTILIZATION_NAMES = [  # (below, name); 85 itself is still congested
    (40, "Under-utilized"), (65, "Healthy"), (75, "High"), (85, "Congested"), (None, "Critical"),
]
# -----------------------------------------------------------------------------


def archetype(mean_days: Column) -> Column:
    label = None
    for edge, name, _ in ARCHETYPES:
        label = (F.when if label is None else label.when)(mean_days <= edge, name)
    return label.otherwise(ARCHETYPES[-1][1])


def archetype_colour(label: Column) -> Column:
    colour = None
    for _, name, value in ARCHETYPES:
        colour = (F.when if colour is None else colour.when)(label == name, value)
    return colour


def recommendation(label: Column) -> Column:
    text = None
    for name, advice in RECOMMENDATIONS.items():
        text = (F.when if text is None else text.when)(label.contains(name), advice)
    return text.otherwise(OTHER_ADVICE)


def silhouette_quality(score: Column) -> Column:
    *steps, (_, rest) = SILHOUETTE_NAMES
    name = F.when(score > steps[0][0], steps[0][1])
    for edge, value in steps[1:]:
        name = name.when(score > edge, value)
    return name.otherwise(rest)


def mape_quality(mape: Column) -> Column:
    *steps, (_, rest) = MAPE_NAMES
    name = F.when(mape < steps[0][0], steps[0][1])
    for edge, value in steps[1:]:
        name = name.when(mape < edge, value)
    return name.otherwise(rest)


def utilization_band(pct: Column) -> Column:
    *steps, (last, congested), (_, critical) = UTILIZATION_NAMES
    name = F.when(pct < steps[0][0], steps[0][1])
    for edge, value in steps[1:]:
        name = name.when(pct < edge, value)
    return name.when(pct <= last, congested).when(pct > last, critical)


def reshuffle_probability(stack_height: Column, bound: int) -> Column:
    """``bound`` 0 is the low end of the band, 1 the high end."""
    p = None
    for edge, *ends in RESHUFFLE_BANDS:
        p = (F.when if p is None else p.when)(stack_height < edge, ends[bound])
    return p
