"""Days of a run and what users may ask for: windows, periods, pages, buckets, groups."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta
from math import gcd

HOLD_BACK = 2
MOST_DAYS = 31
MOST_SLA = 30 * 86_400


@dataclass(frozen=True)
class Window:
    """Consecutive days, both ends included."""

    since: date
    until: date

    def __post_init__(self) -> None:
        if self.since > self.until:
            raise ValueError("a window ends before it begins")

    @classmethod
    def daily(cls, run_date: date, lookback: int) -> Window:
        """The last `lookback` days that are complete on the run's date: up to two days before it."""
        if lookback < 1:
            raise ValueError("lookback is at least 1")
        until = run_date - timedelta(days=HOLD_BACK)
        return cls(until - timedelta(days=lookback - 1), until)

    @property
    def days(self) -> list[date]:
        return [self.since + timedelta(days=i) for i in range((self.until - self.since).days + 1)]

    def check(self, run_date: date) -> Window:
        if self.until > run_date - timedelta(days=HOLD_BACK):
            raise ValueError("the window holds days that aren't complete yet")
        return self


def period(since: str | None, until: str | None, first: date, last: date) -> Window:
    """A user's days, strictly yyyy-mm-dd; by default the last seven there are."""

    def day(text: str) -> date:
        if len(text) != 10:
            raise ValueError(f"not a day: {text}")
        return datetime.strptime(text, "%Y-%m-%d").date()  # noqa: DTZ007

    end = day(until) if until else last
    w = Window(day(since) if since else max(first, end - timedelta(days=6)), end)
    if len(w.days) > MOST_DAYS:
        raise ValueError(f"more than {MOST_DAYS} days")
    return w


def sla_seconds(value: int | None) -> int:
    return min(1_800 if value is None else value, MOST_SLA)


def bucket_edges(text: str | None, default: tuple[int, ...]) -> tuple[int, ...]:
    """Comma-separated, strictly ascending, at most 32."""
    if not (text or "").strip():
        return default
    edges = tuple(int(x) for x in text.split(","))
    if len(edges) > 32 or min(edges) < 0 or max(edges) >= 1 << 32 or any(a >= b for a, b in zip(edges, edges[1:], strict=False)):
        raise ValueError(f"bucket edges {text}")
    return edges


def groups(text: str | None) -> list[list[str]]:
    """`a|b,c` is two groups; an empty one is an error."""
    if not (text or "").strip():
        return []
    out = [[x.strip() for x in g.split("|") if x.strip()] for g in text.split(",")]
    if not all(out) or sum(map(len, out)) > 1_000:
        raise ValueError(f"groups {text}")
    return out


def stride(n: int) -> int:
    """A step near 0.618 n that has no divisor in common with n."""
    k = max(1, round(n * 0.6180339887498949))
    while n > 1 and gcd(k, n) != 1:
        k += 1
    return k


def rotated(index: int, n: int, day: int) -> int:
    """Place of the room at `index` among n in the order of a day, so that no room is always last."""
    return (index - day * stride(n)) % n if n else 0


def lag_note(last_day: date, today: date) -> tuple[str, bool]:
    """How far the data lags behind, and whether that is more than the hold-back."""
    lag = (today - last_day).days
    return f"data up to {last_day}", lag > HOLD_BACK
