"""Dashboard slicers and the per-agent restriction."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverloom.operators.staging import Staged
from coverloom.session import written_small


def in_dates(frame: DataFrame, column: str, start: date | None = None, end: date | None = None) -> DataFrame:
    """Rows with ``start <= column <= end``, as plain comparisons that reach the Parquet scan."""
    if start is not None:
        frame = frame.filter(F.col(column) >= F.lit(start))
    if end is not None:
        frame = frame.filter(F.col(column) <= F.lit(end))
    return frame


# What the slicers are called in each table; a table is cut by those it has.
SLICER_COLUMNS = {
    "fct_payments": {"date": "due_date", "carrier": "carrier", "plan_type": "plan_type", "tier": "agent_tier", "state": "state"},
    "fct_member_churn": {
        "date": "cancellation_date", "carrier": "carrier", "plan_type": "plan_type", "tier": "agent_tier", "state": "state",
    },
    "dim_agents": {"tier": "tier", "state": "state"},
    "agent_commission_summary": {"date": "period", "carrier": "carrier", "tier": "agent_tier"},
    "agent_commission_summary_monthly": {"date": "period", "tier": "agent_tier"},
}


@dataclass(frozen=True)
class Slicers:
    """The dashboard's slicers; what is not set does not cut."""

    start: date | None = None
    end: date | None = None
    carriers: Sequence[str] | None = None
    plan_types: Sequence[str] | None = None
    tiers: Sequence[str] | None = None
    states: Sequence[str] | None = None

    def cut(self, frame: DataFrame, table: str) -> DataFrame:
        """``frame``, which has the columns of ``table``, cut by every slicer the table has."""
        columns = SLICER_COLUMNS[table]
        when = columns.get("date")
        if when == "period":  # whole months
            for day, keep in ((self.start, F.col(when).__ge__), (self.end, F.col(when).__le__)):
                frame = frame if day is None else frame.filter(keep(f"{day:%Y-%m}"))
        elif when:
            frame = in_dates(frame, when, self.start, self.end)
        choices = {"carrier": self.carriers, "plan_type": self.plan_types, "tier": self.tiers, "state": self.states}
        for slicer, wanted in choices.items():
            if wanted is not None and slicer in columns:
                frame = frame.filter(F.col(columns[slicer]).isin(*wanted))
        return frame

    def is_set(self) -> bool:
        return any(v is not None for v in vars(self).values())


def slice_by(
    frame: DataFrame,
    date_column: str | None = None,
    start: date | None = None,
    end: date | None = None,
    carriers: Sequence[str] | None = None,
    plan_types: Sequence[str] | None = None,
    tiers: Sequence[str] | None = None,
    states: Sequence[str] | None = None,
) -> DataFrame:
    """Applies the slicers that are set to any frame with the payment fact's column names."""
    if date_column:
        frame = in_dates(frame, date_column, start, end)
    choices = {"carrier": carriers, "plan_type": plan_types, "agent_tier": tiers, "state": states}
    for column, wanted in choices.items():
        if wanted is not None:
            frame = frame.filter(F.col(column).isin(*wanted))
    return frame


def agent_book(frame: DataFrame, agents: DataFrame, viewer_email: str) -> DataFrame:
    """The rows of a stored table with agent_id that belong to the agent looking at it."""
    return frame.join(_viewer(agents, viewer_email), "agent_id", "left_semi").select(*frame.columns)


def payments_of_agent(s: Staged, viewer_email: str) -> Staged:
    """The staged tables with the viewer's payments only, and of members and policies what these
    refer to. The viewer's members are worked out and written first: a mart of payments built from
    the result then joins one agent's payments, not everyone's, and shuffles none but theirs."""
    viewer = written_small(_viewer(s.agents, viewer_email), "viewer")
    own = s.members.select("member_id", "agent_id").join(viewer, "agent_id", "left_semi")
    return s.of_members(written_small(own.select("member_id"), "own-members"))


def _viewer(agents: DataFrame, email: str) -> DataFrame:
    return agents.filter(F.col("email") == email.lower()).select("agent_id")


def calendar_year(s: Staged, day: date) -> Staged:
    """The staged tables with the payments of one calendar year. A plain date range reaches
    the scan, which a filter on the derived year does not."""
    return s.with_payments(in_dates(s.payments, "due_date", date(day.year, 1, 1), date(day.year, 12, 31)))
