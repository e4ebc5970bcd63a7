"""The two loads as compositions of operators: training and live."""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import features as X
from tidemark.operators.merge import STANDARD_METRICS, Bundle, merge_sources
from tidemark.operators.relational import drop_existing
from tidemark.operators.scale import settled

_WEEKLY = ["account_id", "month", "yyyywk", *X.METRICS]
_STATIC = ["account_id", "month", *X.STATIC_COLUMNS, *X.TRAIN_STATIC, *X.LIVE_STATIC]
#: Columns of the merge that each table of a load is made of.
MADE_OF = {
    "weekly": _WEEKLY,
    "rollup": _WEEKLY,
    "features": [*_WEEKLY, "final_earliest_date"],
    "static": _STATIC,
    "table": [*_WEEKLY, *_STATIC],
}


@dataclass(frozen=True)
class Load:
    """The tables of a load, each planned when it is first asked for.

    The accounts and the merge are written once, as the steps that all others read; they
    are lazy and each asks only for the columns it needs.
    """

    accounts: DataFrame
    merged: DataFrame
    since: str
    live: bool

    @cached_property
    def weekly(self) -> DataFrame:
        weekly = X.weekly_features(self.merged, self.since)
        return weekly if self.live else X.leak_guard(weekly, self.accounts)

    @cached_property
    def static(self) -> DataFrame:
        return X.static_features(self.merged, X.LIVE_STATIC, fill_missing=False) if self.live else X.static_features(self.merged, X.TRAIN_STATIC)

    @cached_property
    def rollup(self) -> DataFrame:
        return X.entity_rollup(self.weekly)

    @cached_property
    def metadata(self) -> DataFrame:
        metadata = X.account_metadata(self.accounts)
        return drop_existing(metadata, ["churn_date"]) if self.live else metadata

    @cached_property
    def table(self) -> DataFrame:
        return X.training_table(self.static, self.rollup, self.metadata)

    @cached_property
    def features(self) -> DataFrame:
        if not self.live:
            return X.feature_dataset(self.weekly, self.metadata)
        first = self.merged.groupBy("account_id").agg(F.min("final_earliest_date").alias("final_earliest_date"))
        return X.feature_dataset(self.weekly, self.metadata, first)


def with_settled_accounts(bundle: Bundle) -> Bundle:
    """The bundle with its accounts written as a table.

    A load meets them in many joins on the account, which share a stage: what the accounts
    are derived from would be sorted and grouped again in each task for every one of them.
    """
    return replace(bundle, account=settled(bundle.account, "account"))


def _merged(bundle: Bundle, since: str, as_of: str | None, tables: list[str] | None) -> DataFrame:
    columns = None if tables is None else list(dict.fromkeys(c for t in tables for c in MADE_OF[t]))
    return settled(merge_sources(bundle, since, as_of=as_of, metrics=STANDARD_METRICS, columns=columns, written=True), "merged")


def training_load(bundle: Bundle, since: str = "2020-01-01", tables: list[str] | None = None) -> Load:
    """All accounts; weeks after a churn are guarded out; statics hold the time to churn.

    ``tables`` names the tables that will be asked for, if not all may be: the merge is
    written with the columns that they are made of.
    """
    bundle = with_settled_accounts(bundle)
    return Load(bundle.account, _merged(bundle, since, None, tables), since, live=False)


def live_load(bundle: Bundle, since: str = "2020-01-01", as_of: str = "2020-01-01", tables: list[str] | None = None) -> Load:
    """Accounts that have not churned; time is measured up to ``as_of``; nothing is filled in.  ``tables`` as in a training load."""
    live = with_settled_accounts(bundle).live()
    return Load(live.account, _merged(live, since, as_of, tables), since, live=True)
