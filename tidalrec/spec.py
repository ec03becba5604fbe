"""Column roles of the user, item and interaction tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class FeatureSpec:
    user_id: str
    item_id: str
    inter_user: str
    inter_item: str
    user_cat: tuple[str, ...] = ()
    item_cat: tuple[str, ...] = ()
    user_dense: tuple[str, ...] = ()
    item_dense: tuple[str, ...] = ()
    time_col: str | None = None
    label_col: str | None = None
    # per categorical column minimum count; absent columns use ``default_min_count``
    min_counts: dict = field(default_factory=dict)
    default_min_count: int = 5

    @property
    def user_cols(self) -> list[str]:
        return [self.user_id, *self.user_cat, *self.user_dense]

    @property
    def item_cols(self) -> list[str]:
        return [self.item_id, *self.item_cat, *self.item_dense]

    def min_count(self, column: str) -> int:
        return int(self.min_counts.get(column, self.default_min_count))

    def validate(self, users: DataFrame | None = None, items: DataFrame | None = None,
                 interactions: DataFrame | None = None) -> None:
        """Fail before any job when a configured column is missing."""
        problems = []
        checks = [
            (users, "users", self.user_cols),
            (items, "items", self.item_cols),
            (interactions, "interactions",
             [c for c in (self.inter_user, self.inter_item, self.time_col) if c]),
        ]
        for df, name, cols in checks:
            if df is None:
                continue
            have = set(df.columns)
            missing = [c for c in cols if c not in have]
            if missing:
                problems.append(f"{name}: missing columns {missing}")
        if problems:
            raise ValueError("; ".join(problems))


def tpch_spec(**overrides) -> FeatureSpec:
    """Roles on the supplied test tables: customer = users, part = items,
    orders joined to lineitem = interactions."""
    base = dict(
        user_id="c_custkey", item_id="p_partkey",
        inter_user="o_custkey", inter_item="l_partkey",
        user_cat=("c_mktsegment", "c_nationkey"), item_cat=("p_brand", "p_type", "p_size"),
        user_dense=("c_acctbal",), item_dense=("p_retailprice",),
        time_col="o_orderdate", label_col="l_quantity",
    )
    base.update(overrides)
    return FeatureSpec(**base)
