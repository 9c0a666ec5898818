"""The definitions in plain Python, quadratic on purpose."""

from __future__ import annotations

import math
from datetime import timedelta

from riskweave.constants import CITIES, RuleSettings

COORDS = {c: (lat, lon) for c, lat, lon in CITIES}


def km_between(a, b):
    (lat1, lon1), (lat2, lon2) = COORDS[a], COORDS[b]
    p1, p2 = math.radians(lat1), math.radians(lat2)
    h = (
        math.sin((p2 - p1) / 2) ** 2
        + math.cos(p1) * math.cos(p2) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    )
    return 2 * 6371.0 * math.asin(math.sqrt(min(1.0, h)))


def histories(rows):
    by_account = {}
    for row in rows:
        by_account.setdefault(row[1], []).append(row)
    for mine in by_account.values():
        mine.sort(key=lambda r: (r[5], r[0]))
        for i, row in enumerate(mine):
            yield row, mine[:i]


def flags(rows, settings: RuleSettings | None = None):
    s = settings or RuleSettings()
    out = {}
    for row, prior in histories(rows):
        key, _, _, category, city, when = row
        texts = []
        start = when - timedelta(seconds=s.window_seconds)
        n = 1 + sum(1 for p in prior if p[5] >= start)
        if n >= s.velocity_threshold:
            texts.append(f"velocity: {n} transactions within {s.window_seconds}s")
        if len(prior) >= s.min_history and category not in {p[3] for p in prior}:
            texts.append(f"mcc_drift: first time this account has used category {category}")
        if prior and city in COORDS and prior[-1][4] in COORDS:
            there = prior[-1][4]
            km = km_between(there, city)
            gap = abs(math.floor(when.timestamp()) - math.floor(prior[-1][5].timestamp()))
            trip = f"geo_impossible: {there} -> {city} implies traveling"
            if km >= s.min_km and gap == 0:
                texts.append(f"{trip} instantaneously")
            elif km >= s.min_km and km / (gap / 3600) > s.max_kmh:
                texts.append(f"{trip} {round(km / (gap / 3600))} km/h")
        if texts:
            out[key] = "\n".join(texts)
    return out


def features(rows, window_seconds=120):
    out = {}
    for row, prior in histories(rows):
        key, _, _, category, city, when = row
        second = math.floor(when.timestamp())
        velocity = sum(
            1 for p in prior if math.floor(p[5].timestamp()) >= second - window_seconds
        )
        speed = 0.0
        if prior and city in COORDS and prior[-1][4] in COORDS:
            km = km_between(prior[-1][4], city)
            hours = (when - prior[-1][5]).total_seconds() / 3600
            if km >= 1.0:
                speed = km / hours if hours > 0 else km * 1e6
        out[key] = (velocity, int(category in {p[3] for p in prior}), speed)
    return out
