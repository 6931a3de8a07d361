"""What the figures mean, and the month's evidence as Markdown."""

from __future__ import annotations

#: name, formula, population, reading, limit
_TEXT = {
    "kpi_1_median_request_to_pickup_min": ("Median wait", "median of pickup - request, minutes", "rides whose times are present and in order", "how long a rider typically waits", "a booked slot may stand for the request; completed trips only"),
    "kpi_2_p90_request_to_pickup_min": ("Long wait", "90th percentile of pickup - request, minutes", "as for the median", "one rider in ten waits at least this long", "the tail is most exposed to booked rides"),
    "kpi_3_driver_arrival_share_of_wait_pct": ("Arrival share of the wait", "100 * sum(on scene - request) / sum(pickup - request)", "those rides with an arrival seen between request and pickup", "whether the wait is for the car or at the curb", "a lower bound: rides without a curb wait aren't in it"),
    "kpi_4_p90_request_to_pickup_by_zone": ("Long wait by zone", "90th percentile of pickup - request by pickup zone", "those rides with a known zone; small zones aren't ranked", "where long waits gather", "zones differ in much else too"),
    "kpi_5_passenger_311_complaints_per_100k_rides": ("Complaints per 100,000 rides", "100000 * passenger complaints / pickups", "complaints placed in a zone; all pickups there", "where riders turn to the city", "complaints name no ride; unplaced ones are missing"),
}
DEFINITIONS = {k: dict(zip(("name", "formula", "population", "interpretation", "limitation"), v, strict=True)) for k, v in _TEXT.items()}


def table(head: list[str], rows: list[list]) -> list[str]:
    line = lambda cells: "| " + " | ".join(str(c) for c in cells) + " |"
    return [line(head), line(["---"] * len(head)), *[line(r) for r in rows]]


def shown(k: dict) -> str:
    v = k["value"]
    if v is None:
        return f"withheld: {k['reason']}"
    if not isinstance(v, dict):
        return str(v)
    return ", ".join(f"{a.replace('_', ' ')} {b}" for a, b in v.items() if not isinstance(b, (dict, list)))


def markdown(month: str, mode: str, kpis: dict, support: dict, checks: list[dict], gate: dict, sizes: dict, decided: dict) -> str:
    out = [f"# Evidence for {month}" + (" (sample, not the whole data)" if mode == "sample" else ""), ""]
    out += [f"Published; complaint figure {'published' if gate['publish_friction_kpi'] else 'withheld'}, weather {'published' if gate['publish_weather_analysis'] else 'withheld'}; checks {gate['status_counts']}.", "", "## Figures", ""]
    out += table(["figure", "value", "formula", "rides", "status", "limit"], [[k["definition"]["name"], shown(k), k["definition"]["formula"], k.get("population_rides", "-"), k["validation_status"], k["definition"]["limitation"]] for k in kpis.values()])
    zones = kpis["kpi_4_p90_request_to_pickup_by_zone"]["value"]
    listed = [(s, z) for s in ("worst_5", "best_5") for z in zones[s]]
    if listed:
        out += ["", "## Zones", "", *table(["list", "zone", "borough", "rides", "median", "p90"], [[s, z["pickup_zone"], z["pickup_borough"], z["rides"], z["median_min"], z["p90_min"]] for s, z in listed])]
    rate = kpis["kpi_5_passenger_311_complaints_per_100k_rides"]["value"]
    if rate:
        out += ["", "## Boroughs", "", *table(["borough", "complaints", "pickups", "per 100,000", "p90"], [[b, *v.values()] for b, v in rate["by_borough"].items()])]
    out += ["", "## Beside the figures", ""] + [f"- {k.replace('_', ' ')}: {v}" for k, v in support.items()]
    out += ["", "## Checks", "", *table(["check", "status", "scope", "detail"], [[c["check"], c["status"], c["scope"], c["detail"]] for c in checks])]
    grid = next((c for c in checks if c["check"] == "weather.grid_point_offset"), None)
    if grid:
        out += ["", "## Weather", "", f"- {grid['detail']}"]
    placed = next((c for c in checks if c["check"] == "nyc311.zone_mapping_coverage"), None)
    if placed:
        out += ["", "## Placing complaints", "", f"- {placed['detail']}"]
    out += ["", "## Decisions", "", *[f"- {k.replace('_', ' ')}: {v}" for k, v in decided.items()]]
    return "\n".join([*out, "", "## Populations", "", *[f"- {k.replace('_', ' ')}: {v}" for k, v in sizes.items()], ""])
