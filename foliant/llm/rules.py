"""Ordered rule lists by incremental reduced-error pruning, and their SQL form."""

from __future__ import annotations

import numpy as np

Condition = tuple[str, str, float]


def covers(rule: list[Condition], x: dict[str, np.ndarray], n: int) -> np.ndarray:
    ok = np.ones(n, bool)
    for f, op, t in rule:
        ok &= x[f] <= t if op == "<=" else x[f] > t
    return ok


def _grow(x: dict[str, np.ndarray], y: np.ndarray, most: int = 5) -> list[Condition]:
    """Adds the condition of the greatest information gain until no negative is covered."""
    rule: list[Condition] = []
    inside = np.ones(len(y), bool)
    while len(rule) < most and (inside & ~y).any():
        p0, n0 = (inside & y).sum(), (inside & ~y).sum()
        best, gain = None, 1e-9
        for f, v in x.items():
            values = np.unique(v[inside])
            for t in (values[:-1] + values[1:]) / 2 if len(values) <= 64 else np.unique(np.quantile(values, np.linspace(0.01, 0.99, 64))):
                low = v <= t
                for op, side in (("<=", low), (">", ~low)):
                    p = (inside & side & y).sum()
                    if not p:
                        continue
                    n = (inside & side & ~y).sum()
                    g = p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0)))
                    if g > gain:
                        best, gain = (f, op, float(t)), g
        if best is None:
            break
        rule.append(best)
        inside &= covers([best], x, len(y))
    return rule


def _prune(rule: list[Condition], x: dict[str, np.ndarray], y: np.ndarray) -> list[Condition]:
    """Drops final conditions while that raises (p - n) / (p + n) on the pruning set."""

    def worth(r: list[Condition]) -> float:
        c = covers(r, x, len(y))
        p, n = (c & y).sum(), (c & ~y).sum()
        return (p - n) / (p + n) if p + n else -1.0

    while len(rule) > 1 and worth(rule[:-1]) > worth(rule):
        rule = rule[:-1]
    return rule


def induce(x: dict[str, np.ndarray], y: np.ndarray, order: list[str], seed: int = 5) -> list[tuple[list[Condition], str]]:
    """Rules for the classes in the given order; what no rule covers is of none of them."""
    rng, rules = np.random.default_rng(seed), []
    left = np.ones(len(y), bool)
    for name in order:
        while (left & (y == name)).any():
            rows = np.flatnonzero(left)
            rng.shuffle(rows)
            cut = [part for c in (True, False) for part in [rows[(y[rows] == name) == c]]]
            grow = np.concatenate([p[: -(-2 * len(p) // 3)] for p in cut])
            prune = np.concatenate([p[-(-2 * len(p) // 3) :] for p in cut])
            take = lambda r: {f: v[r] for f, v in x.items()}
            rule = _grow(take(grow), y[grow] == name)
            if not rule:
                break
            if len(prune):
                rule = _prune(rule, take(prune), y[prune] == name)
                c = covers(rule, take(prune), len(prune))
                if c.any() and (y[prune][c] == name).mean() < 0.5:
                    break
            c = covers(rule, x, len(y)) & left
            if not (c & (y == name)).any():
                break
            rules.append((rule, name))
            left &= ~c
    return rules


def to_sql(rules: list[tuple[list[Condition], str]], default: str) -> str:
    """A CASE expression of the rule list."""
    when = " ".join(f"WHEN {' AND '.join(f'{f} {op} {t:.6f}D' for f, op, t in rule)} THEN '{name}'" for rule, name in rules)
    return f"CASE {when} ELSE '{default}' END" if rules else f"'{default}'"
