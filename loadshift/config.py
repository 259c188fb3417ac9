"""Default parameters of every stage."""

from __future__ import annotations

from dataclasses import asdict, dataclass, field, replace


@dataclass(frozen=True)
class Config:
    shiftable_devices: tuple[str, ...]
    activity_devices: tuple[str, ...]
    threshold: float
    training_days: int = 60
    # The usage table's activity flag may use all active devices instead of the shiftable ones.
    usage_activity_from: str = "shiftable"
    activity_lags: tuple[int, ...] = (24, 48, 72)
    usage_lags: tuple[int, ...] = (1, 2, 3)
    time_features: tuple[str, ...] = ("hour", "day_name")
    truncation_factor: float = 1.5
    model_type: str = "random forest"
    activity_threshold: float = 0.6
    usage_threshold: float = 0.5
    # A relative training start never reaches back before this day.
    train_floor: str = "2022-12-31"
    activity_train_days: int = 30
    timezone: str = "Europe/Brussels"
    weather: bool = False
    extra: dict = field(default_factory=dict)

    def with_thresholds(self, activity: float, usage: float) -> Config:
        return replace(self, activity_threshold=activity, usage_threshold=usage)

    def as_dict(self) -> dict:
        return asdict(self)


def geometric_grid(first: float, last: float, n: int) -> list[float]:
    """0 followed by n candidates with constant ratio."""
    ratio = (last / first) ** (1 / (n - 1)) if n > 1 else 1.0
    return [0.0] + [first * ratio**i for i in range(n)]


def eighths() -> list[float]:
    return [i / 8 for i in range(1, 8)]
