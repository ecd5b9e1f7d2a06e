"""What a run may vary: tables, dates, score bands, goods vocabularies, models."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from tagweave.functions.columns import Band
from tagweave.operators.cluster import RFE_BANDS, RFM_BANDS
from tagweave.operators.metrics import AsOf
from tagweave.operators.recommend import REGULARISATION
from tagweave.operators.shopping import GoodsCoding


@dataclass(frozen=True)
class Settings:
    """``model_root`` is where models are kept; without one they are fitted anew.

    ``visit_lag_days`` moves the day that engagement counts visits to, for logs
    that lag behind the other tables. ``half_open`` names range tags whose bands are
    stretched to the next integer; ``to_midnight`` drops the time of day in repairs.
    ``condensed_scores`` fits price sensitivity on weighted points of bounded number.
    """

    users: str = "tbl_users"
    orders: str = "tbl_orders"
    logs: str = "tbl_logs"
    goods: str = "tbl_goods"
    orders_as_of: AsOf = None
    logs_as_of: AsOf = None
    visit_lag_days: int = 0
    rfm_bands: Mapping[str, list[Band]] = field(default_factory=lambda: RFM_BANDS)
    rfe_bands: Mapping[str, list[Band]] = field(default_factory=lambda: RFE_BANDS)
    coding: GoodsCoding = GoodsCoding()
    regularisation: float = REGULARISATION
    recommender_blocks: int = 10
    model_root: str | None = None
    retrain: bool = False
    try_all_iterations: bool = True
    skip_unscored: bool = False
    half_open: frozenset[str] = frozenset()
    to_midnight: bool = False
    condensed_scores: bool = False

    def as_of(self, entity: str) -> AsOf:
        return self.logs_as_of if entity == "logs" else self.orders_as_of

    def model_path(self, name: str) -> str | None:
        return f"{self.model_root.rstrip('/')}/{name}" if self.model_root else None
