"""Plain one-row-at-a-time rewrites of the rules, to hold the distributed results against."""

from __future__ import annotations

import math
from statistics import median

CPU, MEMORY = "system.cpu.utilization", "system.memory.usage"

# (minimum deviation, minimum relative deviation) of the two detectors per kind of metric.
FLOORS = {CPU: (10.0, 0.0), MEMORY: (0.0, 0.02)}


def floors(name):
    if name.startswith("nab."):
        return (0.0, 0.0)
    return FLOORS.get(name)


def mad(window, least, relative):
    middle = median(window)
    distances = [abs(v - middle) for v in window]
    spread = 1.4826 * median(distances) or 1.253314 * sum(distances) / len(distances)
    scale = max(spread, max(least, relative * abs(middle)) / 3.5)
    return middle, middle - 3.5 * scale, middle + 3.5 * scale, scale > 0 and distances[-1] / scale >= 3.5


def followed(past, alpha, damping, is_out):
    """Level and spread after the `past` values; `is_out(i, value, level, spread)` says which are damped."""
    states = [(past[0], 0.0)]
    for i, value in enumerate(past):
        if i == 0:
            continue
        level, spread = states[-1]
        weight = alpha * damping if is_out(i, value, level, spread) else alpha
        step = value - level
        states.append((level + weight * step, (1 - weight) * (spread + weight * (step * step))))
    return states


def ewma(window, least, relative):
    def scale(level, spread):
        return max(3.0 * math.sqrt(spread), least, relative * abs(level))

    def beyond(value, level, spread):
        width = scale(level, spread)
        return (value - level) / width > 1.0 if width else value > level

    *past, newest = window
    level, spread = followed(past, 0.1, 0.1, lambda i, *at: i >= 10 and beyond(*at))[-1]
    return level, None, level + scale(level, spread), beyond(newest, level, spread)


def evaluations(series):
    """`series` maps (machine, name) to values in order; yields (machine, name, index, algorithm, band...)."""
    for (machine, name), values in series.items():
        floor = floors(name)
        if floor is None:
            continue
        for i in range(len(values)):
            window = values[max(0, i - 359) : i + 1]
            if len(window) >= 20:
                yield (machine, name, i, "mad", *mad(window, *floor))
            if len(window) >= 11:
                yield (machine, name, i, "ewma", *ewma(window, *floor))


def trajectory(values, alpha=0.1, multiplier=3.0, least=10.0, damping=0.1):
    def bound(level, spread):
        return level + max(multiplier * math.sqrt(spread), least)

    states = followed(values, alpha, damping, lambda i, v, *at: i >= 10 and v > bound(*at))
    rows = [(values[0], None, False)]
    for i in range(1, len(values)):
        held = bound(*states[i - 1]) if i >= 10 else None
        rows.append((states[i][0], held, held is not None and values[i] > held))
    return rows
