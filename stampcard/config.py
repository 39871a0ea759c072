"""Job settings. One frozen object is passed to every plan and stream."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field, replace

# Default ladder, quota, state lifetime, checkpoint interval and
# parallelism. Results depend on the first three.
DEFAULT_LADDER = (1, 2, 3, 5, 8, 13, 21)
DEFAULT_MAX_PER_MONTH = 7
DEFAULT_STATE_TTL_MS = 7 * 24 * 60 * 60 * 1000
DEFAULT_CHECKPOINT_INTERVAL_MS = 60_000
DEFAULT_PARALLELISM = 4

_INTEGER = re.compile(r"[+-]?[0-9]+")


def parse_points_sequence(text: str) -> tuple[int, ...]:
    """Turn ``"1, 2,3"`` into a ladder; trailing empty items are ignored.

    A ladder without any step is refused here, when the job is configured,
    and not when the first check-in needs its points.
    """
    items = text.split(",")
    while items and items[-1] == "":
        items.pop()
    if not items:
        raise ValueError("points sequence is empty")
    bad = [item for item in items if not _INTEGER.fullmatch(item.strip())]
    if bad:
        raise ValueError(f"points sequence holds a non-integer: {bad[0]!r}")
    ladder = tuple(int(item) for item in items)
    large = [points for points in ladder if not -(1 << 31) <= points < 1 << 31]
    if large:
        raise ValueError(f"points sequence holds a number beyond 32 bits: {large[0]}")
    return ladder


@dataclass(frozen=True)
class EngineConfig:
    kafka_bootstrap_servers: str = "localhost:9092"
    kafka_topic: str = "checkin.raw"
    kafka_group_id: str = "checkin-rewards"
    kafka_output_topic: str = "point.transaction"

    jdbc_url: str = "jdbc:mysql://localhost:3306/checkins"
    jdbc_username: str = ""
    jdbc_password: str = field(default="", repr=False)

    checkpoint_interval_ms: int = DEFAULT_CHECKPOINT_INTERVAL_MS
    parallelism: int = DEFAULT_PARALLELISM

    points_ladder: tuple[int, ...] = DEFAULT_LADDER
    max_per_month: int = DEFAULT_MAX_PER_MONTH

    # Not settable in the reference job: how long an event id is remembered,
    # how orders are given out, and how transaction ids are built.
    state_ttl_ms: int = DEFAULT_STATE_TTL_MS
    order_mode: str = "snapshot"
    id_mode: str = "reference"

    # Most records one micro-batch takes from the source; a first start from
    # the earliest offset is then cut into batches. None: no bound.
    max_offsets_per_trigger: int | None = None

    # Copies of the month counts made so that one user's rows spread over
    # this many join keys (see operators/lookups.py).
    count_salts: int = 2

    def __post_init__(self) -> None:
        if not self.points_ladder:
            raise ValueError("points ladder is empty")
        if self.order_mode not in ("snapshot", "sequential"):
            raise ValueError(f"unknown order mode: {self.order_mode!r}")
        if self.id_mode not in ("reference", "deterministic"):
            raise ValueError(f"unknown id mode: {self.id_mode!r}")

    def with_(self, **changes) -> EngineConfig:
        return replace(self, **changes)

    @classmethod
    def from_options(cls, options: Mapping[str, str]) -> EngineConfig:
        """Build from the job's command-line names; unset names keep defaults."""
        values = {}
        for name, (field, convert) in OPTION_FIELDS.items():
            if name in options:
                values[field] = convert(options[name])
        return cls(**values)


# Option names a job is started with, the field each one sets,
# and how its text is read.
OPTION_FIELDS = {
    "kafka.bootstrap.servers": ("kafka_bootstrap_servers", str),
    "kafka.topic": ("kafka_topic", str),
    "kafka.group.id": ("kafka_group_id", str),
    "kafka.output.topic": ("kafka_output_topic", str),
    "mysql.url": ("jdbc_url", str),
    "mysql.username": ("jdbc_username", str),
    "mysql.password": ("jdbc_password", str),
    "checkpoint.interval": ("checkpoint_interval_ms", int),
    "parallelism": ("parallelism", int),
    "points.sequence": ("points_ladder", parse_points_sequence),
    "max.checkin.per.month": ("max_per_month", int),
}
