"""Feature tables from raw billing tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from lapsewise import schemas as S
from lapsewise.operators import behaviour as B

Tables = Mapping[str, DataFrame]


def build_feature_table(tables: Tables) -> DataFrame:
    return B.feature_table(tables[S.POLICIES], tables[S.INVOICE], tables[S.PAYHISTORY])


def build_active_feature_table(tables: Tables) -> DataFrame:
    """Features of the active policies only.

    Every feature belongs to one policy, so invoices of other policies are
    dropped before they are summed up instead of after.
    """
    active = B.active_policies(tables[S.POLICIES])
    invoices = tables[S.INVOICE].join(active.select("policy_num"), "policy_num", "left_semi")
    return B.feature_table(active, invoices, tables[S.PAYHISTORY])
