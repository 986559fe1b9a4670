"""Definitions on Python sets and loops, for small random inputs."""

from __future__ import annotations

import datetime as dt
import random

DAY = dt.timedelta(days=1)
START = dt.date(2025, 1, 1)


def random_days(seed: int, users: int = 25, span: int = 120, rate: float = 0.12):
    """user -> (signup day, set of active days); some activity lies before signup, some users have
    none, and the gaps cover all lifecycle edges."""
    rng = random.Random(seed)
    out = {}
    for user in range(users):
        signup = START + DAY * rng.randrange(0, span // 2)
        own_rate = rng.choice([0, 0.02, rate, 0.6])
        days = {START + DAY * d for d in range(span) if rng.random() < own_rate}
        last = START
        for gap in rng.sample([6, 7, 8, 29, 30, 31, 32], 4) if rng.random() < 0.5 else []:
            last += DAY * gap
            days.add(last)
        out[user] = (signup, {d for d in days if d < START + DAY * span})
    return out


def calendar(first, last):
    return [first + DAY * i for i in range((last - first).days + 1)]


def trailing_users(active: dict, window: int):
    """day -> users active in the window ending that day, from the first to the last active day."""
    every = sorted(set().union(*active.values()))
    return {
        t: sum(any(t - DAY * k in days for k in range(window)) for days in active.values())
        for t in calendar(every[0], every[-1])
    } if every else {}


def state(t, signup, days):
    def seen(first, last):
        return any(t - DAY * k in days for k in range(last, first + 1))

    if t == signup:
        return "New"
    if t in days:
        return "Current" if seen(7, 1) else "Reactivated" if seen(30, 1) else "Resurrected"
    return "AtRiskWAU" if seen(6, 0) else "AtRiskMAU" if seen(29, 0) else "Dormant"
